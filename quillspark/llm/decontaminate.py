"""Benchmark decontamination: an FM-index over each shard of documents, searched for every benchmark window.

A window is 13 consecutive words of a benchmark item; an item of fewer words, but not none, is one window.  Words are
runs of ASCII digits, ASCII letters (lower-cased) and bytes from 0x80 on.

A shard is a run of whole documents.  Words become numbers of the benchmark's vocabulary; a word outside of it,
like a document's end, parts the shard into runs, and runs shorter than the shortest window cannot hold
one.  The rest gets a suffix order (prefix doubling, only unresolved groups are sorted again), a Burrows-Wheeler
transform in a wavelet matrix, and every eighth text position as a sample.  All windows are searched backwards at once
by ranks; the rows found walk back to a sampled position; the words that occurrences cover merge into spans, and
each covered word is compared with the vocabulary byte by byte: one that only shares a hash counts as a word outside of the
vocabulary, and its shard is searched again.  No document leaves its task.

The benchmark is cut into chunks of about ``chunk_bytes`` of text, collected and broadcast one at a time; with several chunks
the documents are stored once with a row number and the chunks' spans are merged by it.

Defined cases: null and empty texts have no words and are clean; items without words have no windows; the
windows of items with a null id hit like others, but name no item; items that share an id count once; repeated
documents are judged each; an empty benchmark hits nothing; extra columns that the caller names stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.llm.common import BYTE_CODES, LOWER, Scratch, mix, prefix_hashes, slices, substring_hashes, text_bytes, word_spans

WINDOW = 13
SAMPLE = 8
SHARD_BYTES = 2 << 20
CHUNK_BYTES = 16 << 20
SLOTS_LOG2 = 18
NOT_WORD = np.zeros(256, bool)
NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
FOUND = "n_words long, spans array<struct<start:long,stop:long>>, item_ids array<string>"


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, starts, stops and 64-bit hashes of the words of some texts."""
    low = LOWER[data]
    starts, stops = word_spans(low, offsets, NOT_WORD)
    return low, starts, stops, substring_hashes(prefix_hashes(BYTE_CODES[low]), starts, stops)


@dataclass
class Windows:
    """The distinct windows of some items as rows of word numbers, by length, and the items of each."""

    words: list[bytes]
    hashes: np.ndarray  # of the words, sorted; words[i] has number i + 1
    slots: np.ndarray
    by_length: dict[int, tuple[np.ndarray, list[np.ndarray]]]
    item_ids: list[str]

    @classmethod
    def of(cls, items: list[tuple[str | None, str | None]]) -> Windows:
        names = sorted({i for i, _ in items if i is not None})
        number = {n: k for k, n in enumerate(names)}
        texts = [(t or "").encode() for _, t in items]
        offsets = np.cumsum([0] + [len(t) for t in texts])
        low, starts, stops, hashes = words_of(np.frombuffer(b"".join(texts), np.uint8), offsets)
        distinct, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
        spelled = [low[starts[i] : stops[i]].tobytes() for i in first]
        found: dict[int, dict[tuple, set[int]]] = {}
        edges = np.searchsorted(starts, offsets)
        for k, (item, _) in enumerate(items):
            own = (ids[edges[k] : edges[k + 1]] + 1).tolist()
            size = min(WINDOW, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                of_window = found.setdefault(size, {}).setdefault(tuple(own[i : i + size]), set())
                if item is not None:
                    of_window.add(number[item])
        by_length = {
            size: (np.array(list(rows), np.int64), [np.array(sorted(s), np.int64) for s in rows.values()]) for size, rows in found.items()
        }
        slots = np.zeros(1 << SLOTS_LOG2, np.int32)
        slots[(mix(distinct) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)] = np.arange(1, len(distinct) + 1)
        return cls(spelled, distinct, slots, by_length, names)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, 0 for words that no window has."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = self.slots[(mix(hashes) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)].astype(np.int64)
        at[self.hashes[at - 1] != hashes] *= -1  # an empty slot stays 0; another word may share the slot
        unsure = np.flatnonzero(at < 0)
        place = np.minimum(np.searchsorted(self.hashes, hashes[unsure]), len(self.hashes) - 1)
        at[unsure] = np.where(self.hashes[place] == hashes[unsure], place + 1, 0)
        return at


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling; settled suffixes are not sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = _group_starts(text[order], np.zeros(n, np.int64), order, n)
    open_ = order
    step = 1
    while True:
        sizes = np.bincount(rank, minlength=n)
        open_ = open_[sizes[rank[open_]] > 1]
        if not len(open_):
            break
        after = np.where(open_ + step < n, rank[np.minimum(open_ + step, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + after
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        old = rank[open_]
        new_group = np.ones(len(old), bool)
        new_group[1:] = old[1:] != old[:-1]
        new_key = np.ones(len(old), bool)
        new_key[1:] = key[1:] != key[:-1]
        at = np.arange(len(old))
        rank[open_] = old + np.maximum.accumulate(np.where(new_key, at, 0)) - np.maximum.accumulate(np.where(new_group, at, 0))
        step *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def _group_starts(sorted_keys, rank, order, n):
    first = np.ones(n, bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    return rank


class FMIndex:
    """Counts and places of patterns in a text of numbers from 0 on; 0 must not stand in a pattern."""

    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        sequence = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.levels = []
        self.depth = max(1, int(symbols - 1).bit_length())
        for level in range(self.depth - 1, -1, -1):  # a wavelet matrix: zeros of each level first
            bits = (sequence >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bits)]).astype(np.int32)
            self.levels.append((level, ones, len(text) - int(ones[-1])))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])
        every = np.arange(symbols)
        self.begin = self._descend(every, np.zeros(symbols, np.int64))
        sampled = order % SAMPLE == 0
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = order[sampled]
        self.n = len(text)

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, ones, zeros in self.levels:
            upto = ones[at]
            at = np.where((symbol >> level) & 1, zeros + upto, at - upto)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often a symbol stands in the first ``at`` places of the transform."""
        return self._descend(symbol, at) - self.begin[symbol]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The row of the suffix one place to the left of each row's suffix."""
        at, symbol = row, np.zeros(len(row), np.int64)
        for _, ones, zeros in self.levels:
            upto = ones[at]
            bit = ones[at + 1] - upto
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, zeros + upto, at - upto)
        return self.before[symbol] + at - self.begin[symbol]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of patterns of one length (a row each), by backward search."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n)
        for column in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[:, column]
            low = self.before[symbol] + self.rank(symbol, low)
            high = self.before[symbol] + self.rank(symbol, high)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows: walk back to a sampled suffix, count the steps."""
        out, open_, at = np.zeros(len(rows), np.int64), np.arange(len(rows)), rows
        for steps in range(SAMPLE):
            done = self.sampled[at]
            out[open_[done]] = self.samples[self.sample_rank[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            if not len(open_):
                break
            at = self.back(at)
        return out


def search_shard(data: np.ndarray, offsets: np.ndarray, windows: Windows, outside: tuple[int, ...] = ()):
    """Per document: number of words, merged spans of hit words (numbers of first and last + 1), items.

    ``outside``: numbers of words that are known to share no more than a hash with the vocabulary.
    """
    docs = len(offsets) - 1
    low, starts, stops, hashes = words_of(data, offsets)
    edges = np.searchsorted(starts, offsets)
    n_words = np.diff(edges)
    nothing = [[] for _ in range(docs)], [[] for _ in range(docs)]
    if not windows.by_length:
        return n_words, *nothing
    ids = windows.numbers(hashes)
    ids[list(outside)] = 0
    joined = np.zeros(len(ids) + 1, bool)  # a word in the vocabulary that goes on in the run before it
    joined[1:-1] = (ids[1:] > 0) & (ids[:-1] > 0)
    joined[edges[:-1]] = False
    run = np.cumsum(~joined[:-1]) - 1
    length = np.bincount(run, minlength=1)
    keep = np.flatnonzero((ids > 0) & (length[run] >= min(windows.by_length))) if len(ids) else np.zeros(0, np.int64)
    if not len(keep):
        return n_words, *nothing
    first = np.ones(len(keep), bool)
    first[1:] = run[keep][1:] != run[keep][:-1]
    place = np.arange(len(keep)) + np.cumsum(first)  # a 0 stands before each run and at the end
    text = np.zeros(int(place[-1]) + 2, np.int64)
    text[place] = ids[keep]
    word = np.full(len(text), -1)
    word[place] = keep
    index = FMIndex(text, len(windows.hashes) + 1)
    cover = np.zeros(len(text) + 1, np.int64)
    doc_items = []
    owner = np.searchsorted(edges, np.arange(len(ids)), "right") - 1
    for size, (patterns, items) in windows.by_length.items():
        lows, highs = index.search(patterns)
        found = highs - lows
        which = np.repeat(np.arange(len(patterns)), found)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(found) - found, found) + np.repeat(lows, found)
        at = index.locate(rows)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + size, -1)
        pairs = np.unique(owner[word[at]] * len(patterns) + which)
        doc_items += [(d, items[p]) for d, p in zip((pairs // len(patterns)).tolist(), (pairs % len(patterns)).tolist())]
    hit = np.sort(word[np.flatnonzero(np.cumsum(cover)[:-1] > 0)])
    # 64-bit hashes stood for words so far
    unlike = tuple(w for w in hit.tolist() if low[starts[w] : stops[w]].tobytes() != windows.words[ids[w] - 1])
    if unlike:
        return search_shard(data, offsets, windows, outside + unlike)
    spans, names = nothing
    cut = np.flatnonzero(np.diff(hit) > 1) + 1 if len(hit) else []
    doc_of = owner[hit]
    cut = np.union1d(cut, np.flatnonzero(np.diff(doc_of)) + 1).astype(int)
    for part in np.split(hit, cut) if len(hit) else []:
        d = owner[part[0]]
        spans[d].append((int(part[0] - edges[d]), int(part[-1] + 1 - edges[d])))
    gathered: dict[int, set] = {}
    for d, items in doc_items:
        gathered.setdefault(d, set()).update(items.tolist())
    for d, found in gathered.items():
        names[d] = sorted(windows.item_ids[i] for i in found)
    return n_words, spans, names


def _chunks(benchmark: DataFrame, chunk_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in pieces of about ``chunk_bytes``, each collected on its own."""
    items = benchmark.filter("text IS NOT NULL").select(F.col("item_id").cast("string").alias("i"), "text")
    size = items.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    parts = max(1, -(-size // chunk_bytes))
    for k in range(parts):
        own = items if parts == 1 else items.filter(F.pmod(F.xxhash64("i", "text"), F.lit(parts)) == k)
        yield [(r["i"], r["text"]) for r in own.collect()]


def _search(docs: DataFrame, items: list[tuple[str | None, str]], columns: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Windows.of(items))
    schema = StructType([docs.schema[c] for c in columns])
    for field in StructType.fromDDL(FOUND).fields:
        schema.add(field)
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def build(batches):
        for whole in batches:
            for part in slices(whole, SHARD_BYTES):
                n_words, spans, names = search_shard(*text_bytes(part), shared.value)
                made = [[{"start": a, "stop": b} for a, b in s] for s in spans]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(len(columns))),
                        pa.array(n_words, pa.int64()),
                        pa.array(made, span),
                        pa.array(names, pa.list_(pa.string())),
                    ],
                    names=schema.names,
                )

    text = [] if "text" in columns else ["text"]
    return docs.select(*columns, *text).mapInArrow(build, schema)


def find_benchmark(docs: DataFrame, benchmark: DataFrame, columns: tuple[str, ...] = ("doc_id",), chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The given columns of every document, its number of words, merged spans of hit words, and items found.

    ``contaminated``: some word is hit, and the hit ones are a twentieth of all words at least.
    """
    made = ("n_words", "spans", "item_ids", "n_hit", "contaminated")
    columns = [c for c in columns if c not in made]
    pieces = _chunks(benchmark, chunk_bytes)
    first, second = next(pieces), next(pieces, None)
    if second is None:
        found = _search(docs, first, columns)
    else:
        with Scratch(docs.sparkSession, "decontaminate") as scratch:
            stored = scratch.store(docs.withColumn("row_number_", F.monotonically_increasing_id()), "docs")
            parts = [scratch.store(_search(stored, p, ["row_number_"]), f"part-{k}") for k, p in enumerate(chain((first, second), pieces))]
            every = parts[0]
            for part in parts[1:]:
                every = every.unionByName(part)
            merged = every.groupBy("row_number_").agg(
                F.max("n_words").alias("n_words"),
                merge_spans(F.flatten(F.collect_list("spans"))).alias("spans"),
                F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            )
            found = scratch.keep(stored.select(*columns, "row_number_").join(merged, "row_number_").drop("row_number_"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def merge_spans(spans):
    """Overlapping or touching spans as one, in order."""
    kind = "array<struct<start:bigint,stop:bigint>>"

    def add(done, span):
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))
        return F.when((F.size(done) > 0) & (last["stop"] >= span["start"]), joined).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), F.array().cast(kind), add)


def item_digest(item_ids):
    """SHA-256 of the items, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(item_ids), ","), 256)

