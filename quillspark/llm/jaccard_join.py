"""Exact Jaccard self-join of documents' shingle sets by universe partition and pigeonhole.

Two sets r, s with a Jaccard similarity of 0.75 or more differ in at most (|r| + |s|) / 7 shingles.  For a band of sizes,
a scheme hashes the universe of shingles into m segments; two similar sets have equal content in all but
that many segments.  So a set indexes, in its own band's scheme and in the next one, a signature per non-empty segment.
Cost-based allocation drops, per set and scheme, its most frequent signatures as far as the pigeonhole leaves slack:
with at most H differing segments, the H + 1 rarest (in one order for all sets) still meet.  A set
with too many empty segments for that emits the one-deletion neighbourhood of each segment as well: to leave no signature
in common, a similar set must then lose the shingle of every segment of one and differ twice in every larger one.  Where H
allows even that (small sets whose shingles fall into few segments), the set also emits its first shingles in an order for all,
as many as must hold a shared one.  The candidates left are compared by parity sketches (their
distance never exceeds the true difference) and verified exactly on the shingle sets.

What moves: documents are written once as compressed blocks; equal sets become one class first; signatures travel
as packed arrays; sets only move for pairs that pass the sketch.  A signature that still has more than ``HOT`` sets is
not joined: its sets meet again with the universe cut as finely as can be, a segment per shingle, where each keeps only its
rarest shared shingles.  If many sets share even one of these (a large group of near copies), they are
first joined to their smallest only; pairs across are compared if the links found leave them apart.  Links are found between
classes; components and labels are computed in Spark.

Defined cases: null and empty texts, and texts without words, have an empty set and no links; null or repeated
``doc_id`` rows take part like others (a null id never names a component unless all its ids are null); an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.blocks import dealt, unpack_columns
from quillspark.llm.common import Scratch, mix, shuffle_partitions, slices, text_bytes
from quillspark.llm.components import components
from quillspark.llm.shingles import shingle_sets

BLOCK_BYTES = 2 << 20
FLUSH = 600_000  # signatures that a task gathers before it deals them out
HOT = 16
_SALT = np.uint64(0xA0761D6478BD642F)
_FIRSTS = np.uint64(0xE7037ED1A0B428DB)  # the space of single shingles
_BANDS = [1]
while _BANDS[-1] < 10**9:
    _BANDS.append(max(_BANDS[-1] + 1, _BANDS[-1] * 4 // 3))
BANDS = np.array(_BANDS)  # the largest size of each band


def segments_of(band: np.ndarray) -> np.ndarray:
    return BANDS[band] * 42 // 100 + 1


def worst_difference(size: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Most shingles in which a set can differ from a similar one whose pair belongs to the band."""
    return (size + np.minimum(BANDS[band], size * 4 // 3)) // 7


# --- blocks of documents -------------------------------------------------------


def _blocks(docs: DataFrame) -> DataFrame:
    def build(batches):
        compress = zstandard.ZstdCompressor(level=3).compress
        number = TaskContext.get().partitionId() << 20
        for whole in batches:
            for part in slices(whole, BLOCK_BYTES):
                data, offsets = text_bytes(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number], pa.int64()),
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        pa.array([np.diff(offsets).astype(np.int32).tobytes()], pa.binary()),
                        pa.array([compress(data.tobytes())], pa.binary()),
                    ],
                    names=["block", "doc_ids", "lengths", "texts"],
                )
                number += 1

    kept = docs.select(F.col("doc_id").cast("long"), "text")
    return kept.mapInArrow(build, "block long, doc_ids array<long>, lengths binary, texts binary")


def _sets(lengths: bytes, texts: bytes):
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(texts), np.uint8)
    return shingle_sets(data, np.concatenate([[0], np.cumsum(np.frombuffer(lengths, np.int32))]).astype(np.int64))


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles' hash buckets, as many as a power of two from the set's size on."""
    bits = max(64, 1 << int(len(shingles) - 1).bit_length())
    at = (mix(shingles ^ _SALT) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """A lower bound of the number of shingles in which two sets differ."""
    if len(a) > len(b):
        a, b = b, a
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(y) > len(x):  # buckets modulo a smaller power of two
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int.from_bytes((x ^ y).tobytes(), "little").bit_count()


def _classes(blocks: DataFrame) -> DataFrame:
    """A row per document: its handle (block and place), id, set size, digest and sketch."""

    def build(batches):
        for batch in batches:
            for block, ids, lengths, texts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                flat, at = _sets(lengths, texts)
                own = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((block << 16) + np.arange(len(own))),
                        pa.array(ids, pa.int64()),
                        pa.array(np.diff(at)),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in own], pa.binary()),
                        pa.array([sketch(s) for s in own], pa.binary()),
                    ],
                    names=["handle", "doc_id", "n", "digest", "sketch"],
                )

    return blocks.mapInArrow(build, "handle long, doc_id long, n long, digest binary, sketch binary")


# --- signatures ----------------------------------------------------------------


def signatures(flat: np.ndarray, at: np.ndarray):
    """Signature, document number, band and slack of every non-empty segment in every scheme a set belongs to."""
    sizes = np.diff(at)
    docs = np.repeat(np.arange(len(sizes)), sizes)
    content = mix(flat ^ _SALT)
    lowest, highest = np.searchsorted(BANDS, sizes), np.searchsorted(BANDS, sizes * 4 // 3)
    out = []
    for step in range(int((highest - lowest).max(initial=-1)) + 1):
        band = np.minimum(lowest + step, highest)
        active = (lowest + step <= highest) & (sizes > 0)
        count = np.where(active, segments_of(band), 0)
        base = np.cumsum(count) - count
        mine = active[docs]
        own = docs[mine]
        segment = base[own] + ((flat[mine] >> np.uint64(20)) % count[own].astype(np.uint64)).astype(np.int64)
        total = np.zeros(int(count.sum()), np.uint64)
        np.add.at(total, segment, content[mine])
        load = np.bincount(segment, minlength=len(total))
        owner = np.repeat(np.arange(len(sizes)), count)
        label = mix((band[owner].astype(np.uint64) << np.uint64(40)) + (np.arange(len(total)) - base[owner]).astype(np.uint64))
        slack = np.bincount(owner[load > 0], minlength=len(sizes)) - worst_difference(sizes, band) - 1
        full = load > 0
        out.append((mix(total[full] + label[full]), owner[full], band[owner[full]], np.maximum(slack, 0)[owner[full]]))
        short = active & (slack < 0)  # too many empty segments: one-deletion neighbourhoods, in a space of their own
        near = mix(label ^ _SALT)
        some = full & short[owner]
        out.append((mix(total[some] + near[some]), owner[some], band[owner[some]], np.zeros(int(some.sum()), np.int64)))
        each = short[own] & (load[segment] > 1)
        s, o = segment[each], own[each]
        out.append((mix(total[s] - content[mine][each] + near[s]), o, band[o], np.zeros(len(o), np.int64)))
        # differences that break every segment of a set; similar sets share 3/4 of either, so one of n // 4 + 1 shingles
        breaks = np.bincount(owner, np.minimum(load, 2), len(sizes)).astype(np.int64)
        frail = active & (breaks <= worst_difference(sizes, band))
        f, o = content[mine][frail[own]], own[frail[own]]
        order = np.lexsort((f, o))
        f, o = f[order], o[order]
        first = np.arange(len(o)) - np.searchsorted(o, o) <= sizes[o] // 4
        f, o = f[first], o[first]
        out.append((mix(f ^ mix(band[o].astype(np.uint64) ^ _FIRSTS)), o, band[o], np.zeros(len(o), np.int64)))
    if not out:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*out))


def _pack(columns: list[np.ndarray]) -> bytes:
    """Records as one compressed array of byte columns; handles as differences."""
    sig, handle, band, slack = columns
    order = np.argsort(handle, kind="stable")
    low5 = sig[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    step = np.diff(handle[order], prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T
    body = [low5.tobytes(), step.tobytes(), band[order].astype(np.uint8).tobytes(), np.minimum(slack[order], 2**31).astype("<u4").tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def _unpack(blob: bytes):
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // 18
    sig = np.zeros((n, 8), np.uint8)
    sig[:, :5] = np.frombuffer(raw, np.uint8, 5 * n).reshape(n, 5)
    step = np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, 5 * n).reshape(8, n).T).view("<i8").ravel()
    band = np.frombuffer(raw, np.uint8, n, 13 * n).astype(np.int64)
    return sig.view("<u8").ravel(), np.cumsum(step), band, np.frombuffer(raw, "<u4", n, 14 * n).astype(np.int64)


def _signature_blobs(blocks: DataFrame, parts: int) -> DataFrame:
    """Signatures of all classes' first documents, dealt into ``parts`` by the signature's upper bits."""

    def deal(columns):
        columns = [np.concatenate(c) for c in zip(*columns)]
        part = ((columns[0] >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(edges))
        for some in np.array_split(full, max(1, len(full) // 256)):
            blobs = [_pack([c[order[edges[p] : edges[p + 1]]] for c in columns]) for p in some]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(blobs, pa.binary())], names=["part", "blob"])

    def build(batches):
        held, count = [], 0
        for batch in batches:
            for block, lengths, texts, copies in zip(*(batch.column(i).to_pylist() for i in range(4))):
                flat, at = _sets(lengths, texts)
                if copies:
                    keep = np.ones(len(at) - 1, bool)
                    keep[np.array(copies)] = False
                    flat = flat[np.repeat(keep, np.diff(at))]
                    at = np.concatenate([[0], np.cumsum(np.diff(at) * keep)])
                sig, doc, band, slack = signatures(flat, at)
                held.append((sig, (block << 16) + doc, band, slack))
                count += len(sig)
                if count >= FLUSH:
                    yield from deal(held)
                    held, count = [], 0
        if count:
            yield from deal(held)

    return blocks.select("block", "lengths", "texts", "copies").mapInArrow(build, "part int, blob binary")


def _whole_partition(blocks: DataFrame, flagged: DataFrame, parts: int) -> DataFrame:
    """All shingles of flagged sets, dealt by shingle: the universe cut as finely as can be."""
    wanted = flagged.groupBy(F.shiftright("handle", 16).alias("block")).agg(
        F.collect_list(F.col("handle").bitwiseAND(0xFFFF).cast("int")).alias("places")
    )

    def deal(held):
        flat, handle = (np.concatenate(c) for c in zip(*held))
        yield from dealt((flat % np.uint64(parts)).astype(np.int64), "shingles", shingle=flat, handle=handle)

    def build(batches):
        held, count = [], 0
        for batch in batches:
            for block, lengths, texts, places in zip(*(batch.column(i).to_pylist() for i in range(4))):
                flat, at = _sets(lengths, texts)
                keep = np.zeros(len(at) - 1, bool)
                keep[np.array(places)] = True
                owner = np.repeat(np.arange(len(keep)), np.diff(at))
                held.append((flat[keep[owner]], (block << 16) + owner[keep[owner]]))
                count += len(held[-1][0])
                if count >= FLUSH:
                    yield from deal(held)
                    held, count = [], 0
        if count:
            yield from deal(held)

    fed = blocks.join(wanted, "block").select("block", "lengths", "texts", "places")
    return fed.mapInArrow(build, "kind string, key long, blob binary")


def _frequent(key, table, parts):
    """Shingles that several flagged sets hold, with their number of sets, on their way back to the sets."""
    shingle, handle = unpack_columns(table.column("blob").to_pylist(), "ui")
    order = np.argsort(shingle, kind="stable")
    shingle, handle = shingle[order], handle[order]
    first = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]])) if len(shingle) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(shingle)))
    freq = np.repeat(size, size)
    shared = freq > 1
    shingle, handle, freq = shingle[shared], handle[shared], freq[shared]
    part = (mix(handle.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    schema = pa.schema([("kind", pa.string()), ("key", pa.int64()), ("blob", pa.binary())])
    made = list(dealt(part, "shared", shingle=shingle, handle=handle, freq=freq))
    return pa.Table.from_batches([b.cast(schema) for b in made], schema)


def _rarest(key, table, sizes, threshold_percent):
    """Of each set's shared shingles, the ones left when as many frequent ones are dropped as similarity allows.

    Two similar sets share ``threshold`` of the larger one at least; so they share one even without the
    ``ceil(threshold * size) - 1`` most frequent shingles of either, in one order for all.
    """
    shingle, handle, freq = unpack_columns(table.column("blob").to_pylist(), "uii")
    own, n = unpack_columns(sizes.column("blob").to_pylist(), "ii") if sizes.num_rows else (handle[:0], handle[:0])
    by = np.argsort(own)
    n = n[by][np.searchsorted(own[by], handle)]
    order = np.lexsort((shingle, -freq, handle))
    shingle, handle, n = shingle[order], handle[order], n[order]
    rank = np.arange(len(handle)) - np.searchsorted(handle, handle)
    keep = rank >= -(-threshold_percent * n // 100) - 1
    return pa.table({"sig": shingle[keep].view(np.int64), "handle": handle[keep]})


def _sizes(flagged: DataFrame, parts: int) -> DataFrame:
    def build(batches):
        for batch in batches:
            handle, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            part = (mix(handle.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            yield from dealt(part, "sizes", handle=handle, n=n)

    return flagged.select("handle", "n").mapInArrow(build, "kind string, key long, blob binary")


GROUPS = "hot boolean, a long, b long, freq long, band int, slack long"


def _shared_signatures(key, table, hot_size):
    """Pairs under signatures with few sets; members of hot signatures with frequency, band and slack."""
    sig, handle, band, slack = (np.concatenate(c) for c in zip(*map(_unpack, table.column("blob").to_pylist())))
    order = np.lexsort((handle, sig))
    sig, handle, band, slack = sig[order], handle[order], band[order], slack[order]
    first = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    size = np.diff(np.concatenate([first, [len(sig)]]))
    a, b = [], []
    for n in range(2, hot_size + 1):
        members = handle[first[size == n][:, None] + np.arange(n)]
        i, j = np.triu_indices(n, 1)
        a.append(members[:, i].ravel())
        b.append(members[:, j].ravel())
    a, b = np.concatenate(a), np.concatenate(b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = a != b
    new[1:] &= (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    pairs = np.stack([a[new], b[new]])
    hot = np.flatnonzero(size > hot_size)
    rows = np.repeat(first[hot] - np.concatenate([[0], np.cumsum(size[hot])[:-1]]), size[hot]) + np.arange(size[hot].sum())
    name = mix(sig[rows] + (np.uint64(key[0].as_py()) << np.uint64(44))).astype(np.int64)
    none, freq = np.zeros(pairs.shape[1], np.int64), np.repeat(size[hot], size[hot])
    return pa.table(
        {
            "hot": pa.array(np.repeat([False, True], [len(none), len(rows)])),
            "a": np.concatenate([pairs[0], name]),
            "b": np.concatenate([pairs[1], handle[rows]]),
            "freq": np.concatenate([none, freq]),
            "band": np.concatenate([none, band[rows]]).astype(np.int32),
            "slack": np.concatenate([none, slack[rows]]),
        }
    )


def _allocate(hot: DataFrame) -> DataFrame:
    """Drop each set's most frequent signatures, as many as its slack; ``sig, handle, size`` of the rest."""
    own = Window.partitionBy("handle", "band").orderBy(F.desc("freq"), "sig")
    named = hot.select(F.col("a").alias("sig"), F.col("b").alias("handle"), "freq", "band", "slack").distinct()
    return _sized(named.withColumn("rank", F.row_number().over(own)).filter("rank > slack").select("sig", "handle"))


def _sized(kept: DataFrame) -> DataFrame:
    """Rows of signatures with several sets, with their number and a hub: the set that shares most signatures.

    In a group of near copies that is one with few edits of its own, to which most others are similar.
    """
    degree = kept.groupBy("handle").agg((-F.count("*")).alias("few"))
    kept = kept.join(degree, "handle")
    hub = F.min(F.struct("few", "handle"))["handle"]
    sizes = kept.groupBy("sig").agg(F.count("*").alias("size"), hub.alias("first")).filter("size > 1")
    return kept.join(sizes, "sig")


def _star(rows: DataFrame) -> DataFrame:
    """Each signature's hub with its other sets."""
    a, b = F.least("first", "handle"), F.greatest("first", "handle")
    return rows.filter("handle <> first").select(a.alias("a"), b.alias("b")).distinct()


def _apart(many: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of signatures whose sets the links so far leave apart, with their labels."""
    named = many.join(labels.withColumnRenamed("node", "handle"), "handle", "left").withColumn(
        "label", F.coalesce("label", "handle")
    )
    split = named.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y").select("sig")
    return named.join(split, "sig")


def _near(few: DataFrame) -> DataFrame:
    """All pairs under signatures with few sets."""
    other = few.select("sig", F.col("handle").alias("b"))
    return few.select("sig", F.col("handle").alias("a")).join(other, "sig").filter("a < b").select("a", "b").distinct()


# --- verification --------------------------------------------------------------


def _close_enough(pairs: DataFrame, classes: DataFrame, threshold_percent: int) -> DataFrame:
    """Pairs that sizes and sketches cannot tell apart."""
    left = classes.select(F.col("handle").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    right = classes.select(F.col("handle").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    sized = pairs.join(left, "a").join(right, "b").filter(100 * small >= threshold_percent * large)

    def build(batches):
        for batch in batches:
            a, b, n_a, s_a, n_b, s_b = (batch.column(i).to_pylist() for i in range(6))
            keep = [
                sketch_distance(x, y) * (100 + threshold_percent) <= (100 - threshold_percent) * (n + m)
                for n, m, x, y in zip(n_a, n_b, s_a, s_b)
            ]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return sized.select("a", "b", "n_a", "s_a", "n_b", "s_b").mapInArrow(build, "a long, b long")


def _links(pairs: DataFrame, blocks: DataFrame, threshold_percent: int) -> DataFrame:
    """Pairs whose sets, made again from their blocks, are similar; a set goes once to each ``a`` it is paired with."""
    wanted = pairs.select("a", F.col("b").alias("handle")).union(pairs.select("a", "a").distinct().toDF("a", "handle"))
    per_block = wanted.groupBy(F.shiftright("handle", 16).alias("block")).agg(
        F.collect_list(F.struct(F.col("handle").bitwiseAND(0xFFFF).cast("int").alias("i"), "a")).alias("asked")
    )

    def build(batches):
        for batch in batches:
            for block, lengths, texts, asked in zip(*(batch.column(i).to_pylist() for i in range(4))):
                flat, at = _sets(lengths, texts)
                for k in range(0, len(asked), 256):
                    some = asked[k : k + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x["a"] for x in some], pa.int64()),
                            pa.array([(block << 16) + x["i"] for x in some], pa.int64()),
                            pa.array([flat[at[x["i"]] : at[x["i"] + 1]].tobytes() for x in some], pa.binary()),
                        ],
                        names=["a", "handle", "shingles"],
                    )

    sets = blocks.join(per_block, "block").select("block", "lengths", "texts", "asked").mapInArrow(
        build, "a long, handle long, shingles binary"
    )
    hubs = sets.filter("a = handle").select("a", F.col("shingles").alias("hub"))
    others = sets.filter("a <> handle")

    def verify(batches):
        for batch in batches:
            a, b, own, hub = (batch.column(i).to_pylist() for i in range(4))
            keep = []
            for x, y in zip(own, hub):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                keep.append(100 * both >= threshold_percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_())
            )

    joined = others.join(hubs, "a").select("a", "handle", "shingles", "hub")
    return joined.mapInArrow(verify, "a long, b long")


def link_documents(docs: DataFrame, threshold_percent: int = 75, parts: int | None = None, hot_size: int = HOT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; linked sets are similar by the threshold.

    The segment numbers above hold for 75 %; a higher threshold only filters the same candidates.
    """
    if threshold_percent < 75:
        raise ValueError("the segment numbers are for a similarity of 0.75 or more")
    spark = docs.sparkSession
    parts = parts or 3 * shuffle_partitions(spark)
    with Scratch(spark, "jaccard") as scratch:
        blocks = scratch.store(_blocks(docs), "blocks")
        every = scratch.store(_classes(blocks), "classes")
        # one class per set; a copy points to its class's first document
        firsts = every.filter("n > 0").groupBy("digest").agg(F.min("handle").alias("first"), F.count("*").alias("copies"))
        shared = firsts.filter("copies > 1").select("digest", "first")
        copies = scratch.store(
            every.filter("n > 0").select("handle", "digest").join(shared, "digest").filter("handle <> first").select("handle", "first"),
            "copies",
        )
        by_block = copies.groupBy(F.shiftright("handle", 16).alias("block")).agg(
            F.collect_list(F.col("handle").bitwiseAND(0xFFFF).cast("int")).alias("copies")
        )
        dealt = _signature_blobs(blocks.join(by_block, "block", "left"), parts)
        groups = scratch.store(dealt.groupBy("part").applyInArrow(lambda k, t: _shared_signatures(k, t, hot_size), GROUPS), "groups")
        hot = scratch.store(_allocate(groups.filter("hot")), "hot")
        near = _near(hot.filter(F.col("size") <= hot_size))
        # sets that depend on signatures which stay hot meet again, one segment per shingle, by their rarest ones
        flagged = hot.filter(F.col("size") > hot_size).select("handle").distinct()
        flagged = scratch.store(flagged.join(every.select("handle", "n"), "handle"), "flagged")
        counted = _whole_partition(blocks, flagged, parts).groupBy("key")
        back = counted.applyInArrow(lambda k, t: _frequent(k, t, parts), "kind string, key long, blob binary")
        kept = back.groupBy("key").cogroup(_sizes(flagged, parts).groupBy("key")).applyInArrow(
            lambda k, t, s: _rarest(k, t, s, threshold_percent), "sig long, handle long"
        )
        rare = scratch.store(_sized(scratch.store(kept, "rarest")), "rare")
        near = near.union(_near(rare.filter(F.col("size") <= hot_size)))
        many = rare.filter(F.col("size") > hot_size)
        star = _star(many)
        pairs = scratch.store(groups.filter("NOT hot").select("a", "b").union(near).union(star).distinct(), "pairs")
        close = scratch.store(_close_enough(pairs, every, threshold_percent), "close")
        links = scratch.store(_links(close, blocks, threshold_percent), "links")
        labels = scratch.store(components(links, scratch, "first-components"), "first-labels")
        # signatures that stay hot: a second hub for what the first left apart, then all pairs across
        apart = scratch.store(_apart(many, labels), "apart")
        largest = apart.groupBy("sig", "label").agg(F.count("*").alias("c")).groupBy("sig").agg(
            F.max(F.struct("c", "label"))["label"].alias("main")
        )
        left = apart.join(largest, "sig")
        second = left.filter("label <> main").groupBy("sig").agg(F.min(F.struct("few", "handle"))["handle"].alias("first"))
        again = scratch.store(_star(left.drop("first").join(second, "sig")).join(pairs, ["a", "b"], "left_anti"), "again")
        found = scratch.store(_links(_close_enough(again, every, threshold_percent), blocks, threshold_percent), "second-links")
        links = links.union(found)
        labels = scratch.store(components(links, scratch, "second-components"), "second-labels")
        apart = _apart(many, labels).select("sig", "handle", "label")
        across = (
            apart.select("sig", F.col("handle").alias("a"), F.col("label").alias("l"))
            .join(apart.select("sig", F.col("handle").alias("b"), F.col("label").alias("k")), "sig")
            .filter("a < b AND l <> k")
            .select("a", "b")
            .distinct()
            .join(pairs.union(again), ["a", "b"], "left_anti")
        )
        across = scratch.store(_close_enough(across, every, threshold_percent), "across")
        if not across.isEmpty():
            more = scratch.store(_links(across, blocks, threshold_percent), "more-links")
            labels = scratch.store(components(links.union(more), scratch, "components"), "labels")
        # every document: its class's first, that one's label, the smallest id under the label
        placed = (
            every.select("handle", "doc_id", F.col("n").alias("n_shingles"))
            .join(copies, "handle", "left")
            .withColumn("node", F.coalesce("first", "handle"))
            .join(labels, "node", "left")
            .withColumn("label", F.coalesce("label", "node"))
        )
        least = placed.groupBy("label").agg(F.min("doc_id").alias("component_id"))
        return scratch.keep(placed.join(least, "label").select("doc_id", "n_shingles", "component_id"))
