"""A quality classifier: histogram gradient-boosted trees over statistics of whole documents.

Each document becomes a fixed row of statistics (letters, cases, marks, words, repetitions), computed for whole batches of
texts.  Trees are fitted on a bounded sample of labelled rows: at most ``sample_rows``, chosen by a digest of
``doc_id``.  Values fall into at most 64 quantile bins; a tree grows level by level from histograms of gradients and
second derivatives; all trees lie in flat arrays, so that a batch walks through all of them by numpy indexing.

Defined cases: null and empty texts have all statistics zero and get a score like others; rows with a null ``doc_id``
are scored, not learned from; a document with several labels counts once per label; without labels of both
classes every score is the known share (0.5 if none); repeated rows are scored each; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import BYTE_CODES, LOWER, mix, prefix_hashes, slices, substring_hashes, text_bytes, word_spans

BINS = 64
STATISTICS = (
    "log_bytes log_words word_length upper digit wide space line stop_mark comma bang other_mark pipe no_letter_word upper_word title_word "
    "marked_word distinct_word top_word same_next same_pair distinct_line longest_line short_word long_word letter_entropy"
).split()

_UPPER, _LOWER, _DIGIT, _WIDE, _SPACE, _LINE, _STOP, _COMMA, _BANG, _PIPE, _OTHER = range(11)
_CLASS = np.full(256, _OTHER, np.int64)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _WIDE
for _char, _kind in ((" ", _SPACE), ("\t", _SPACE), ("\r", _SPACE), ("\n", _LINE), (".", _STOP), (",", _COMMA), ("!", _BANG), ("|", _PIPE)):
    _CLASS[ord(_char)] = _kind


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(owner: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, the number of distinct keys and the count of the most frequent one."""
    order = np.lexsort((keys, owner))
    o, k = owner[order], keys[order]
    first = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (k[1:] != k[:-1])])) if len(o) else np.zeros(0, np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, o[first], np.diff(np.append(first, len(o))))
    return np.bincount(o[first], minlength=n), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``STATISTICS`` for every text."""
    n, size = len(offsets) - 1, np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    kinds = np.bincount(doc * 11 + _CLASS[data], minlength=11 * n).reshape(n, 11).astype(float)
    letters = kinds[:, _UPPER] + kinds[:, _LOWER] + kinds[:, _WIDE]
    starts, stops = word_spans(data, offsets)
    owner = np.searchsorted(offsets, starts, "right") - 1
    words, length = np.bincount(owner, minlength=n), stops - starts
    upto = lambda kind: np.concatenate([[0], np.cumsum(_CLASS[data] == kind)])
    upper, lower, wide = (u[stops] - u[starts] for u in map(upto, (_UPPER, _LOWER, _WIDE)))
    letter = upper + lower + wide
    count = lambda mask: np.bincount(owner[mask], minlength=n)
    low = LOWER[data]
    hashes = mix(substring_hashes(prefix_hashes(BYTE_CODES[low]), starts, stops))
    distinct, top = _distinct(owner, hashes, n)
    next_ = np.zeros(len(hashes), bool)
    next_[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    beside = np.zeros(len(hashes), bool)
    beside[1:] = owner[1:] == owner[:-1]
    pair_keys = mix(hashes[1:] * np.uint64(3) + hashes[:-1])[beside[1:]] if len(hashes) else hashes
    pairs = np.bincount(owner[beside], minlength=n)
    distinct_pairs, _ = _distinct(owner[beside], pair_keys, n)
    not_line = np.zeros(256, bool)
    not_line[10] = True
    line_starts, line_stops = word_spans(low, offsets, not_line)
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    lines = np.bincount(line_owner, minlength=n)
    distinct_lines, _ = _distinct(line_owner, substring_hashes(prefix_hashes(BYTE_CODES[low]), line_starts, line_stops), n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, line_owner, line_stops - line_starts)
    table = np.bincount(doc * 32 + (low & 31), minlength=32 * n).reshape(n, 32)
    p = _share(table, size[:, None])
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(1)
    last = _CLASS[data[stops - 1]] if len(stops) else stops
    marked = (last == _OTHER) | (last == _BANG)
    columns = [
        np.log1p(size), np.log1p(words), _share(np.bincount(owner, length, n), words), _share(kinds[:, _UPPER], letters), _share(kinds[:, _DIGIT], size),
        _share(kinds[:, _WIDE], size), _share(kinds[:, _SPACE], size), _share(kinds[:, _LINE], size), _share(kinds[:, _STOP], words), _share(kinds[:, _COMMA], words),
        _share(kinds[:, _BANG], words), _share(kinds[:, _OTHER], size), _share(kinds[:, _PIPE], words), _share(count(letter == 0), words), _share(count((upper == letter) & (upper > 1)), words),
        _share(count((upper == 1) & (letter > 1)), words), _share(count(marked), words), _share(distinct, words), _share(top, words), _share(count(next_), words),
        _share(pairs - distinct_pairs, pairs), _share(distinct_lines, lines), np.log1p(longest), _share(count(length <= 3), words), _share(count(length >= 12), words), entropy,
    ]
    return np.stack([np.asarray(c, float) for c in columns], axis=1)


@dataclass
class Forest:
    """Complete trees of one depth in flat arrays: node i has the children 2i + 1 and 2i + 2."""

    base: float
    depth: int
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        """All rows walk through all trees, a level at a time."""
        total = np.full(len(x), self.base)
        if len(self.feature):
            inner = self.feature.shape[1]
            feature, threshold = self.feature.ravel(), self.threshold.ravel()
            root = np.arange(len(self.feature))[None, :] * inner
            node = np.zeros((len(x), len(self.feature)), np.int64)
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = root + node
                node = 2 * node + 1 + (x[rows, feature[at]] > threshold[at])
            total += self.leaf.ravel()[np.arange(len(self.leaf))[None, :] * self.leaf.shape[1] + node - inner].sum(1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, least: float = 5.0, ridge: float = 1.0) -> Forest:
    """Boosted trees for a 0/1 target from histograms over quantile bins."""
    share = y.mean() if len(y) else 0.5
    if not len(y) or share in (0.0, 1.0):
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Forest(float(np.log(share / (1 - share))), depth)
    cuts = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS, method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1)  # bin b: cuts[b-1] < v <= cuts[b]
    n, features = x.shape
    flat = binned + np.arange(features) * BINS
    score = np.full(n, np.log(share / (1 - share)))
    forest = Forest(float(score[0]), depth)
    inner = 2**depth - 1
    all_f, all_t, all_l = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-12)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 2**level
            key = ((node - (width - 1))[:, None] * features * BINS + flat).ravel()
            shape = (width, features, BINS)
            sum_g, sum_h, sum_n = (
                np.bincount(key, np.repeat(w, features), width * features * BINS).reshape(shape).cumsum(2) for w in (g, h, np.ones(n))
            )
            all_g, all_h, all_n = (s[:, :1, -1:] for s in (sum_g, sum_h, sum_n))
            gain = sum_g**2 / (sum_h + ridge) + (all_g - sum_g) ** 2 / (all_h - sum_h + ridge) - all_g**2 / (all_h + ridge)
            gain = np.where((sum_n >= least) & (all_n - sum_n >= least), gain, 0.0).reshape(width, -1)
            best = gain.argmax(1)
            for i in range(width):
                f, b = divmod(int(best[i]), BINS)
                if gain[i, best[i]] > 1e-9 and b < len(cuts[f]):
                    feature[width - 1 + i], threshold[width - 1 + i] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + ridge)
        score += leaf[at]
        all_f.append(feature)
        all_t.append(threshold)
        all_l.append(leaf)
    forest.feature, forest.threshold, forest.leaf = np.array(all_f), np.array(all_t), np.array(all_l)
    return forest


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Forest:
    """Trees from at most ``sample_rows`` labelled documents; which ones, a digest of their ids says."""
    marked = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", F.col("quality").cast("double").alias("y"))
    total = marked.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_003)) / 1_000_003.0
    chosen = marked.filter(draw < min(1.0, 0.97 * sample_rows / max(total, 1))).limit(sample_rows)
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")

    def build(batches):
        for whole in batches:
            for part in slices(whole, 1 << 20):
                x = statistics(*text_bytes(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["y", "x"]
                )

    found = rows.select("text", "y").mapInArrow(build, "y double, x array<double>").toArrow()
    x = np.array(found.column("x").to_pylist(), float).reshape(-1, len(STATISTICS))
    order = np.lexsort((*x.T, found.column("y").to_numpy()))  # the rows' arrival must not matter
    return fit(x[order], found.column("y").to_numpy()[order])


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id, score`` of every row: the share of good ones that the trees expect."""
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def build(batches):
        for whole in batches:
            for part in slices(whole, 1 << 20):
                found = shared.value.probability(statistics(*text_bytes(part)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample_rows: int = 20_000) -> DataFrame:
    """Learn from labels outside of the held-out quarter, score all documents."""
    forest = learn(docs, labels.filter(~held_out()), sample_rows)
    found = score(docs, forest)
    return found.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
