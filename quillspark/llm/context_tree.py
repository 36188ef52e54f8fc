"""Scoring texts with a context-tree-weighted model of bytes.

A text is its bytes (A-Z lower-cased) and an end symbol, the byte 0xFF, which no text holds; a text's start counts as
preceded by zero bytes.  A byte is eight binary decisions.  For each context of 0 to ``DEPTH`` bytes and each prefix of
the next byte's bits, a node counts zeros and ones in all training texts; its Krichevsky-Trofimov probability is mixed
with the product over its longer contexts, half and half, from the leaves to the root.  Frozen, the
weights along a path say how far to trust each depth: ``p_d = (w kt_d + p_(d+1)) / (w + 1)`` with
``w = KT block probability / product of the longer contexts' weighted ones``.  A path ends at the last
context that the training texts hold.

Counts are gathered from all training texts: strings of ``DEPTH + 1`` bytes are counted per task, dealt by the two bytes
next to the symbol (so that a whole subtree meets in one task) and made into nodes there; only the 65,280 nodes
of depths 0 and 1 are finished on the driver.  Nodes are broadcast in chunks of whole subtrees, at most about
``CHUNK_NODES`` each; with several chunks the texts are scored once per chunk and the parts are added up.

The base score needs each word's count over all training texts.  Per block of texts, distinct word hashes travel to the part
that owns them, and the total counts travel back in the same order; no vocabulary is held whole anywhere.

Defined cases: a null text is empty and scored for its end; a null ``doc_id`` is neither learned from nor held
out; without training texts every byte takes eight bits and the base score's count and vocabulary are 0 (the score
is then log10(1) = 0 per token); repeated rows count each; further columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.blocks import PLACE_BITS, as_blocks, block_rows, dealt, pack_columns, unpack_columns
from quillspark.llm.common import BYTE_CODES, LOWER, Scratch, mix, prefix_hashes, shuffle_partitions, substring_hashes, text_bytes, word_spans

DEPTH = 5
END = 0xFF
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 19
FLUSH = 1_000_000
CHUNK_NODES = 6_000_000
KNOWN_COSTS = 3_000_000
_ROWS = "kind string, key long, blob binary"


def _mask(size: int) -> np.uint64:
    return np.uint64(2 ** (8 * size) - 1)


def strings(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with the ``depth`` bytes before it as one number, ends included; and where each text begins."""
    size = np.diff(offsets) + 1 + depth  # zero bytes before, the end after
    begin = np.concatenate([[0], np.cumsum(size)])
    flat = np.zeros(int(begin[-1]), np.uint64)
    place = np.arange(len(data)) + np.repeat(begin[:-1] + depth - offsets[:-1], np.diff(offsets))
    flat[place] = LOWER[data]
    flat[begin[1:] - 1] = END
    out = flat.copy()
    for back in range(1, depth + 1):
        out[back:] |= flat[:-back] << np.uint64(8 * back)
    real = np.ones(len(flat), bool)
    for i in range(depth):
        real[begin[:-1] + i] = False
    return out[real], begin - depth * np.arange(len(begin))


def _merge(keys: np.ndarray, *sums: np.ndarray):
    """Distinct keys, and each column summed up over them."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(s[order], first) if len(first) else s[:0] for s in sums)


# --- the tree ------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """By Stirling's series, eight places up."""
    shift = np.zeros_like(x)
    for i in range(8):
        shift += np.log(x + i)
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def leaf_nodes(grams: np.ndarray, counts: np.ndarray):
    """Nodes of the longest context: key (context, then 1 and the bits so far) and counts of zeros and ones."""
    symbol = grams & np.uint64(255)
    keys, zeros, ones = [], [], []
    for level in range(8):
        keys.append((grams & ~np.uint64(255)) | ((symbol | np.uint64(256)) >> np.uint64(8 - level)))
        bit = ((symbol >> np.uint64(7 - level)) & np.uint64(1)).astype(float)
        zeros.append(counts * (1 - bit))
        ones.append(counts * bit)
    return _merge(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones))


def shorten(keys: np.ndarray, size: int) -> np.ndarray:
    """Keys of the nodes one context byte shorter, ``size`` context bytes being left."""
    return keys & _mask(size + 1)


def weigh(zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray | None):
    """Log weight of a node against its longer contexts, and its log weighted probability."""
    own = log_kt(zeros, ones)
    if longer is None:
        return np.full(len(own), np.inf), own
    return own - longer, np.logaddexp(own, longer) - np.log(2)


@dataclass
class Nodes:
    """Per depth: sorted keys, the probability of a one, and the log weight against longer contexts."""

    keys: list[np.ndarray]
    one: list[np.ndarray]
    weight: list[np.ndarray]

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each string takes after the bytes before it."""
        total = np.zeros(len(grams))
        symbol = grams & np.uint64(255)
        for level in range(8):
            prefix = (symbol | np.uint64(256)) >> np.uint64(8 - level)
            bit = (symbol >> np.uint64(7 - level)) & np.uint64(1)
            p = np.full(len(grams), 0.5)
            ended = np.zeros(len(grams), bool)  # whether some longer context is known already
            for depth in range(len(self.keys) - 1, -1, -1):
                keys = self.keys[depth]
                if not len(keys):
                    continue
                wanted = (grams & _mask(depth + 1) & ~np.uint64(255)) | prefix
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                known = keys[at] == wanted
                kt = np.where(bit == 1, self.one[depth][at], 1 - self.one[depth][at])
                trust = 1 / (1 + np.exp(-np.clip(self.weight[depth][at], -700, 700)))
                p = np.where(known, np.where(ended, trust * kt + (1 - trust) * p, kt), p)
                ended |= known
            total -= np.log2(p)
        return total


def _counted(blocks: DataFrame, parts: int, depth: int) -> DataFrame:
    """Strings of all training texts with their counts, by the two bytes before the symbol."""

    def settle(held):
        grams, n = _merge(*(np.concatenate(c) for c in zip(*held)))
        owner = mix((grams >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(parts)
        return grams, n, owner.astype(np.int64)

    def build(batches):
        held, size = [], 0
        for batch in batches:
            for payload in batch.column(1).to_pylist():
                rows = block_rows(payload)
                data, offsets = text_bytes(rows)
                learn = rows.column("train").to_numpy(zero_copy_only=False)
                grams, begin = strings(data, offsets, depth)
                grams = grams[np.repeat(learn, np.diff(begin))]
                for low in range(0, len(grams), SLICE_BYTES):
                    own, n = np.unique(grams[low : low + SLICE_BYTES], return_counts=True)
                    held.append((own, n))
                    size += len(own)
                if size >= FLUSH:
                    held = [_merge(*(np.concatenate(c) for c in zip(*held)))]
                    size = len(held[0][0])
                    if size >= FLUSH:
                        grams, n, owner = settle(held)
                        yield from dealt(owner, "grams", gram=grams, n=n)
                        held, size = [], 0
        if size:
            grams, n, owner = settle(held)
            yield from dealt(owner, "grams", gram=grams, n=n)

    return blocks.mapInArrow(build, _ROWS)


def _subtrees(key, table, depth):
    """Nodes of contexts of two bytes and more, and what depth 1 needs of them."""
    grams, n = _merge(*unpack_columns(table.column("blob").to_pylist(), "ui"))
    keys, zeros, ones = leaf_nodes(grams, n.astype(float))
    kinds, depths, blobs, sizes, longer = [], [], [], [], None
    for size in range(depth, 1, -1):
        weight, weighted = weigh(zeros, ones, longer)
        kinds.append("nodes")
        depths.append(size)
        blobs.append(pack_columns(key=keys, value=_paired((ones + 0.5) / (zeros + ones + 1), weight)))
        sizes.append(len(keys))
        keys, zeros, ones, longer = _merge(shorten(keys, size - 1), zeros, ones, weighted)
    kinds.append("root")
    depths.append(1)
    blobs.append(pack_columns(key=keys, zeros=_bits_of(zeros), ones=_bits_of(ones), longer=_bits_of(longer)))
    sizes.append(len(keys))
    return pa.table(
        {
            "kind": kinds,
            "depth": pa.array(depths, pa.int32()),
            "blob": pa.array(blobs, pa.binary()),
            "part": pa.array([key[0].as_py()] * len(kinds), pa.int64()),
            "size": pa.array(sizes, pa.int64()),
        }
    )


def _paired(one: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Two single-precision numbers as one 64-bit column."""
    return np.ascontiguousarray(np.stack([one, weight], axis=1).astype(np.float32)).view(np.uint64).ravel()


def _bits_of(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.float64).view(np.int64)


def _float_of(x: np.ndarray) -> np.ndarray:
    return x.view(np.float64)


def _groups(nodes: DataFrame, chunk_nodes: int) -> list[list[int]]:
    """Parts (whole subtrees) in groups of about ``chunk_nodes`` nodes; a row per part is read."""
    sizes = nodes.filter("kind = 'nodes'").groupBy("part").agg(F.sum("size").alias("n")).orderBy("part").collect()
    groups, taken = [[]], 0
    for s in sizes:
        if groups[-1] and taken + s["n"] > chunk_nodes:
            groups.append([])
            taken = 0
        groups[-1].append(s["part"])
        taken += s["n"]
    return groups


def _top(nodes: DataFrame) -> list[tuple]:
    """Depths 0 and 1, at most 256 contexts and 255 nodes each, from what the subtrees left."""
    root = nodes.filter("kind = 'root'").select("blob").toArrow().column("blob").to_pylist()
    keys, zeros, ones, longer = unpack_columns(root, "uiii")
    keys, zeros, ones, longer = _merge(keys, _float_of(zeros), _float_of(ones), _float_of(longer))
    out = []
    for _ in range(2):
        weight, weighted = weigh(zeros, ones, longer)
        out.insert(0, (keys, (ones + 0.5) / (zeros + ones + 1), weight))
        keys, zeros, ones, longer = _merge(shorten(keys, 0), zeros, ones, weighted)
    return out


def _tree(nodes: DataFrame, top: list[tuple], group: list[int], depth: int) -> Nodes:
    """The nodes that answer for a group of parts."""
    found = nodes.filter("kind = 'nodes'").filter(F.col("part").isin(group)).select("depth", "blob").toArrow()
    of_depth, blobs = found.column("depth").to_pylist(), found.column("blob").to_pylist()
    levels = list(top)
    for size in range(2, depth + 1):
        keys, values = unpack_columns([b for d, b in zip(of_depth, blobs) if d == size], "uu")
        order = np.argsort(keys, kind="stable")
        pairs = values[order].view(np.float32).reshape(-1, 2)
        levels.append((keys[order], np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])))
        del keys, values, order, pairs
    return Nodes(*(list(c) for c in zip(*levels)))


_COSTS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _costs(nodes: Nodes, chunk: int, grams: np.ndarray) -> np.ndarray:
    """Costs of sorted distinct strings; a worker works each out once, as long as they fit."""
    if chunk not in _COSTS:
        _COSTS.clear()
        _COSTS[chunk] = np.zeros(0, np.uint64), np.zeros(0)
    known, bits = _COSTS[chunk]
    at = np.minimum(np.searchsorted(known, grams), max(len(known) - 1, 0))
    have = known[at] == grams if len(known) else np.zeros(len(grams), bool)
    out = np.zeros(len(grams))
    out[have] = bits[at[have]]
    new = grams[~have]
    if len(new):
        out[~have] = nodes.bits(new)
        if len(known) + len(new) > KNOWN_COSTS:
            known, bits = known[:0], bits[:0]
        at = np.searchsorted(known, new)
        _COSTS[chunk] = np.insert(known, at, new), np.insert(bits, at, out[~have])
    return out


def _code_lengths(blocks: DataFrame, shared, owned: np.ndarray, depth: int) -> DataFrame:
    """Bits of those symbols of every text that a chunk of the tree answers for."""
    chunk, parts = uuid.uuid4().int, len(owned)

    def build(batches):
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data, offsets = text_bytes(block_rows(payload))
                grams, begin = strings(data, offsets, depth)
                bits = np.zeros(len(grams))
                for low in range(0, len(grams), SLICE_BYTES):
                    own, where = np.unique(grams[low : low + SLICE_BYTES], return_inverse=True)
                    cost = np.zeros(len(own))
                    mine = owned[(mix((own >> np.uint64(8)) & np.uint64(0xFFFF)) % np.uint64(parts)).astype(np.int64)]
                    cost[mine] = _costs(shared.value, chunk, own[mine])
                    bits[low : low + SLICE_BYTES] = cost[where]
                upto = np.concatenate([[0.0], np.cumsum(bits)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array((block << PLACE_BITS) + np.arange(len(begin) - 1)), pa.array(upto[begin[1:]] - upto[begin[:-1]])],
                    names=["handle", "bits"],
                )

    return blocks.select("block", "payload").mapInArrow(build, "handle long, bits double")


# --- the base score ------------------------------------------------------------


def _words(rows: pa.RecordBatch, parts: int):
    """Distinct word hashes of a block ordered by part and hash, each word's place among them, and its text."""
    data, offsets = text_bytes(rows)
    low = LOWER[data]
    starts, stops = word_spans(low, offsets)
    hashes = mix(substring_hashes(prefix_hashes(BYTE_CODES[low]), starts, stops))
    own, where = np.unique(hashes, return_inverse=True)
    part = (own % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(own), np.int64)
    place[order] = np.arange(len(own))
    return own[order], part[order], place[where], np.searchsorted(offsets, starts, "right") - 1


def _word_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """Each block's distinct words with their counts in training texts, by the part that owns them."""

    def build(batches):
        for batch in batches:
            for block, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = block_rows(payload)
                own, part, place, owner = _words(rows, parts)
                learn = rows.column("train").to_numpy(zero_copy_only=False)
                n = np.bincount(place[learn[owner]], minlength=len(own))
                for made in dealt(part, "words", word=own, n=n):
                    yield made.set_column(0, "kind", pa.array([block] * made.num_rows, pa.int64()))

    return blocks.select("block", "payload").mapInArrow(build, "block long, part long, blob binary")


_REPLIES = "block long, part long, blob binary, words long, total long"


def _reply(key, table):
    """Total counts back to each block, in the order of its words; and the part's vocabulary and token count."""
    blocks, blobs = table.column("block").to_pylist(), table.column("blob").to_pylist()
    asked = [unpack_columns([b], "ui") for b in blobs]
    words, where = np.unique(np.concatenate([w for w, _ in asked]), return_inverse=True)
    total = np.bincount(where, np.concatenate([n for _, n in asked]), len(words)).astype(np.int64)
    edges = np.cumsum([0] + [len(w) for w, _ in asked])
    made = [pack_columns(n=total[where[a:b]]) for a, b in zip(edges[:-1], edges[1:])]
    none = [0] * (len(made) - 1)
    return pa.table(
        {
            "block": pa.array(blocks, pa.int64()),
            "part": pa.array([key[0].as_py()] * len(made), pa.int64()),
            "blob": pa.array(made, pa.binary()),
            "words": pa.array([int((total > 0).sum()), *none], pa.int64()),
            "total": pa.array([int(total.sum()), *none], pa.int64()),
        }
    )


def _base_scores(blocks: DataFrame, replies: DataFrame, parts: int, train_docs: int, words: int, total: int) -> DataFrame:
    vocabulary, n = words + (train_docs > 0), total + train_docs
    whole = n + 0.5 * (vocabulary + 1)

    def cost(counts):
        return np.log10((counts + 0.5) / whole)

    def build(batches):
        for batch in batches:
            for block, payload, answers in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = block_rows(payload)
                own, _, place, owner = _words(rows, parts)
                answers = sorted(answers or [], key=lambda a: a["part"])
                counts = unpack_columns([a["blob"] for a in answers], "i")[0]
                size = rows.num_rows
                mine = counts[place]
                tokens = np.bincount(owner, minlength=size) + 1
                known = np.bincount(owner[mine > 0], minlength=size) + (train_docs > 0)
                base = np.bincount(owner, cost(mine), size) + cost(float(train_docs))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((block << PLACE_BITS) + np.arange(size)),
                        rows.column("doc_id"),
                        rows.column("held_out"),
                        pa.array(tokens.astype(np.int64)),
                        pa.array(known.astype(np.int64)),
                        pa.array([n] * size, pa.int64()),
                        pa.array(base),
                    ],
                    names=["handle", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"],
                )

    asked = replies.groupBy("block").agg(F.collect_list(F.struct("part", "blob")).alias("answers"))
    fed = blocks.join(asked, "block", "left").select("block", "payload", "answers")
    return fed.mapInArrow(
        build, "handle long, doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double"
    )


def score_texts(
    docs: DataFrame, folds: int = 5, fold: int = 1, depth: int = DEPTH, parts: int | None = None, chunk_nodes: int = CHUNK_NODES
) -> DataFrame:
    """Learn from all documents outside of the fold, score all: base and context-tree log10 probabilities."""
    spark = docs.sparkSession
    parts = parts or shuffle_partitions(spark)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold
    flagged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.coalesce(held, F.lit(False)).alias("held_out"),
        F.coalesce(~held, F.lit(False)).alias("train"),
    )
    with Scratch(spark, "context-tree") as scratch:
        blocks = scratch.store(as_blocks(flagged, ["doc_id", "text", "held_out", "train"], BLOCK_BYTES), "blocks")
        train_docs = flagged.filter("train").count()
        # the base score
        replies = scratch.store(_word_counts(blocks, parts).groupBy("part").applyInArrow(_reply, _REPLIES), "replies")
        sums = replies.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("w"), F.coalesce(F.sum("total"), F.lit(0)).alias("t")).first()
        base = scratch.store(_base_scores(blocks, replies, parts, train_docs, sums["w"], sums["t"]), "base")
        # the tree
        schema = "kind string, depth int, blob binary, part long, size long"
        counted = _counted(blocks, parts, depth).groupBy("key")
        nodes = scratch.store(counted.applyInArrow(lambda k, t: _subtrees(k, t, depth), schema), "nodes")
        groups, top, bits = _groups(nodes, chunk_nodes), _top(nodes), None
        for chunk, group in enumerate(groups):
            shared = spark.sparkContext.broadcast(_tree(nodes, top, group, depth))
            owned = np.zeros(parts, bool)
            owned[group] = True
            if not chunk:  # what no subtree answers for takes the top of the tree, which every chunk holds
                owned[list(set(range(parts)) - {p for g in groups for p in g})] = True
            own = scratch.store(_code_lengths(blocks, shared, owned, depth), f"bits-{chunk}")
            shared.destroy()  # the driver's copy too
            bits = own if bits is None else bits.union(own)
        summed = bits.groupBy("handle").agg(F.sum("bits").alias("bits"))
        score = (-F.col("bits") * float(np.log10(2))).alias("score")
        columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
        return scratch.keep(base.join(summed, "handle").select(*columns, score))
