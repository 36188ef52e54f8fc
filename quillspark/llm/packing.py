"""Packing tokenised documents into sequences of a fixed length, by swap-based local search.

A document's ids (and an end id) are cut into pieces only if they are longer than a sequence.  Pieces are dealt
at random into groups of about ``GROUP_ROWS``; each group is packed in its own task: best fit in descending
length makes the first bins, then documents are moved and exchanged (one for one, two for one) from the
emptiest underfull bins into fuller ones.  Each step raises the sum of squared fills, so the search ends, and bins
empty one after another until the group's lower bound is met or no step is left.  A group wastes about one
sequence at most, so the groups' size bounds both memory and waste, whatever the corpus.

Defined cases: a null or empty text is one piece of the end id; null or repeated ``doc_id`` values are rows like
others; an empty table packs into nothing; further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch, slices
from quillspark.llm.tokenise import encoder

CAPACITY = 2048
END_ID = 0
GROUP_ROWS = 16_384
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
PACKED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids (little-endian unsigned 32-bit bytes) with their checksum."""

    def build(batches):
        encode = encoder(tokenizer_path).encode
        for whole in batches:
            for part in slices(whole, 4 << 20):
                ids, at = encode(part.column(1).to_pylist(), END_ID)
                counts = -(-np.diff(at) // capacity)
                owner = np.repeat(np.arange(len(counts)), counts)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(capacity, np.diff(at)[owner] - start)
                plain = ids.astype("<u4").tobytes()
                cut = [plain[4 * a : 4 * (a + n)] for a, n in zip(at[owner] + start, length)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.array([zlib.crc32(c) for c in cut], pa.int64()),
                        pa.array(cut if with_ids else [None] * len(cut), pa.binary()),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers, longest items first, each into the fullest bin that takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with room r is open
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[item]
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            chosen = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
            bins[chosen].append(item)
        else:
            room, chosen = capacity, len(bins)
            bins.append([item])
        by_room[room - need].append(chosen)
        if room > need:
            rooms |= 1 << (room - need)
    return bins


def _step(donor: list[int], target: list[int], room: int, lengths: list[int]):
    """The exchange that fills the target most: items that leave the donor, item that comes back (or None).

    Items of one length are as good as each other, so lengths are searched, not items: a bin of ``c`` places
    holds fewer than ``sqrt(2 c)`` different ones, whatever its number of items.
    """
    by_length: dict[int, list[int]] = {}
    for x in donor:
        by_length.setdefault(lengths[x], []).append(x)
    singles = {a: (own[0],) for a, own in by_length.items()}
    known = sorted(by_length)
    pairs = {a + b: (by_length[a][0], by_length[b][-1]) for i, a in enumerate(known) for b in known[:i]}
    pairs |= {2 * a: tuple(own[:2]) for a, own in by_length.items() if len(own) > 1}
    best, found = 0, None
    for back, y in {0: None, **{lengths[y]: y for y in target}}.items():
        offers = singles if y is None else pairs | singles
        sizes = known if y is None else sorted(offers)
        k = bisect_right(sizes, room + back) - 1
        if k >= 0 and sizes[k] - back > best:
            best, found = sizes[k] - back, (offers[sizes[k]], y)
        if best == room:
            break
    return best, found


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Empty the emptiest bins into fuller ones as long as the squared fill rises."""
    fill = [sum(lengths[i] for i in b) for b in bins]
    least = -(-sum(fill) // capacity)
    alive = len(bins)
    stuck: set[int] = set()
    while alive > least:
        open_bins = sorted((b for b in range(len(bins)) if 0 < fill[b] < capacity), key=fill.__getitem__)
        donor = next((b for b in open_bins if b not in stuck), None)
        if donor is None:
            break
        moved = False
        for target in reversed(open_bins):
            while fill[target] < capacity and fill[target] >= fill[donor] and target != donor:
                gain, change = _step(bins[donor], bins[target], capacity - fill[target], lengths)
                if not gain:
                    break
                give, back = change
                for x in give:
                    bins[donor].remove(x)
                    bins[target].append(x)
                if back is not None:
                    bins[target].remove(back)
                    bins[donor].append(back)
                fill[target] += gain
                fill[donor] -= gain
                moved = True
                if not bins[donor]:
                    break
            if not bins[donor]:
                alive -= 1
                break
        if moved:
            stuck.clear()
        else:
            stuck.add(donor)
    return [b for b in bins if b]


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Give every piece a ``sequence_id`` and its ``offset`` there.  ``row`` must tell stored pieces apart."""
    groups = max(1, round(pieces.count() / group_rows))
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("row", F.lit(17)), F.lit(groups)))

    def solve(key, group):
        lengths = group.column("length").to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for number, items in enumerate(pack(lengths, capacity)):
            at = 0
            for i in items:
                sequence[i], offset[i] = (key[0].as_py() << 32) + number, at
                at += lengths[i]
        out = group.drop_columns(["g"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    names = [n.split()[0] for n in PACKED.split(", ")][:-2]
    return dealt.select(*names, "g").groupBy("g").applyInArrow(solve, PACKED)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Where each piece of each document goes; one row per piece."""
    with Scratch(docs.sparkSession, "packing") as scratch:
        pieces = tokenised_pieces(docs, tokenizer_path, capacity, with_ids=False).drop("ids")
        stored = scratch.store(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
        return scratch.keep(pack_pieces(stored, capacity, group_rows).drop("row"))


def sequences(plan: DataFrame, pieces: DataFrame) -> DataFrame:
    """The packed sequences' ids, from a plan and the pieces with ids; ``doc_id`` and ``piece`` must be unique."""
    placed = plan.select("doc_id", "piece", "sequence_id", "offset").join(
        pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"]
    )
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts"), F.lit(b""), lambda acc, p: F.concat(acc, p["ids"]))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))
