"""Word vectors by skip-gram with hierarchical softmax, as ``pyspark.ml``'s ``Word2Vec`` fits them, without a vocabulary on the driver.

Words are known by 64-bit hashes.  Their counts are a table; one task, which holds two numbers a word, makes the Huffman tree of them and
gives each word its path.  Texts are dealt into parts of about as many tokens.  A part gets the paths of its own words by a join, and trains
its own copy of their vectors, from starting values that follow from the word's hash.  A word's vector is the mean over the parts in which
it occurs.  Means of texts are made in the same parts, which get the vectors of their words by the same join.  So a task's memory is bounded
by its part's words and tokens, and only three sums reach the driver.

A step is over some hundred neighbouring tokens at once.  What a row of a step's vectors is moved by is a sum over its uses; beyond
``MOST_USES`` it is that many times their mean, as one word (or an inner node near the root) may be used by all tokens of a step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import drop_stored, stored

WINDOW = 5
RATE = 0.025
LEAST_RATE = 1e-4  # of RATE, at a part's end
LARGEST_SENTENCE = 1_000
PART_TOKENS = 1_000_000
STEP_TOKENS = 256
MOST_USES = 16
CODED_AT_ONCE = 1 << 16
ADDED_AT_ONCE = 1 << 16


# --- the tree --------------------------------------------------------------------


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent and side of all nodes but the root; ``counts`` fall, leaves come before inner nodes."""
    v = len(counts)
    count = counts.tolist() + [0] * (v - 1)
    parent, side = [0] * (2 * v - 2), [0] * (2 * v - 2)
    leaf, inner = v - 1, v
    for new in range(v, 2 * v - 1):
        for which in (0, 1):
            if leaf >= 0 and (inner >= new or count[leaf] < count[inner]):
                least, leaf = leaf, leaf - 1
            else:
                least, inner = inner, inner + 1
            count[new] += count[least]
            parent[least], side[least] = new, which
    return np.array(parent, np.int64), np.array(side, np.int64)


def paths(parent: np.ndarray, side: np.ndarray, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each leaf the inner nodes above it, numbered from 0, twice the number and the side taken there; and how many there are."""
    root, here, found = len(parent), leaves.copy(), []
    first = (root + 2) // 2  # the number of leaves
    while True:
        below = here < root
        if not below.any():
            break
        step = np.full(len(leaves), -1, np.int64)
        step[below] = 2 * (parent[here[below]] - first) + side[here[below]]
        found.append(step)
        here[below] = parent[here[below]]
    table = np.stack(found, axis=1) if found else np.zeros((len(leaves), 0), np.int64)
    return table[table >= 0].astype(np.int32), (table >= 0).sum(axis=1)


def coded(words: DataFrame) -> DataFrame:
    """``(word, path)`` from ``(word, n)``."""

    def code(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        word, counts = table["word"].to_numpy(), table["n"].to_numpy()
        parent, side = huffman(counts)
        for low in range(0, len(word), CODED_AT_ONCE):
            leaves = np.arange(low, min(low + CODED_AT_ONCE, len(word)))
            flat, lengths = paths(parent, side, leaves)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            path = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(word[leaves]), path], names=["word", "path"])

    one = words.repartition(1).sortWithinPartitions(F.desc("n"), "word")  # two numbers a word
    return stored(one.mapInArrow(code, "word long, path array<int>"), "paths")


# --- a part ----------------------------------------------------------------------


def initial(words: np.ndarray, size: int) -> np.ndarray:
    """Uniform within half of ``1 / size`` of zero, by the word."""
    x = words.astype(np.uint64)[:, None] + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    unit = ((x ^ (x >> np.uint64(31))) >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)
    return (unit - np.float32(0.5)) / np.float32(size)


def add_rows(target: np.ndarray, rows: np.ndarray, moves: np.ndarray, uses: np.ndarray) -> None:
    """Adds the moves of each row, or ``MOST_USES`` times the mean of its uses."""
    if not len(rows):
        return
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    moved = np.add.reduceat(moves[order], first, axis=0)
    used = np.add.reduceat(uses[order], first).astype(np.float32)
    target[rows[first]] += moved / np.maximum(1, used / MOST_USES)[:, None]


def trained(
    vectors: np.ndarray, starts: np.ndarray, nodes: np.ndarray, sides: np.ndarray, tokens: np.ndarray, sentence: np.ndarray, seed: int
) -> np.ndarray:
    """One pass over a part's tokens, places in ``vectors``; word ``i`` has the path ``nodes[starts[i]:starts[i + 1]]``."""
    n = len(tokens)
    if not n or not len(nodes):
        return vectors
    inner = np.zeros((int(nodes.max()) + 1, vectors.shape[1]), np.float32)
    reach = np.random.default_rng(seed).integers(1, WINDOW + 1, n)
    steps = np.array([k for k in range(-WINDOW, WINDOW + 1) if k])
    lengths, wanted = np.diff(starts), (1 - sides).astype(np.float32)
    for low in range(0, n, STEP_TOKENS):
        at = np.arange(low, min(low + STEP_TOKENS, n))
        rate = np.float32(RATE * max(LEAST_RATE, 1 - low / n))
        spot = at[:, None] + steps
        near = np.clip(spot, 0, n - 1)
        met = (spot == near) & (np.abs(steps) <= reach[at][:, None]) & (sentence[near] == sentence[at][:, None])
        center, near = tokens[at], tokens[near]
        deep = lengths[center]
        there = np.arange(deep.max()) < deep[:, None]
        path = np.where(there, starts[center][:, None] + np.arange(deep.max()), 0)
        x, y = vectors[near], inner[nodes[path]]
        f = x @ y.transpose(0, 2, 1)
        pull = wanted[path][:, None, :] - 1 / (1 + np.exp(-f))
        pull *= rate * (np.abs(f) < 6) * (met[:, :, None] & there[:, None, :])
        add_rows(vectors, near[met], (pull @ y)[met], np.ones(int(met.sum()), np.int64))
        uses = np.broadcast_to(met.sum(axis=1)[:, None], there.shape)[there]
        add_rows(inner, nodes[path][there], (pull.transpose(0, 2, 1) @ x)[there], uses)
    return vectors


def _flat(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists, and the lists' lengths; a null is an empty list."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind), lengths.astype(np.int64)


def _places(words: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places of words in a sorted array, -1 for those that are not in it."""
    if not len(words):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(words, asked), len(words) - 1)
    return np.where(words[at] == asked, at, -1)


def _train(texts: pa.Table, codes: pa.Table, size: int, seed: int) -> pa.Table:
    if not texts.num_rows or not codes.num_rows:
        return pa.table({"word": pa.array([], pa.int64())} | {f"v{k}": pa.array([], pa.float32()) for k in range(size)})
    texts, codes = texts.sort_by("number"), codes.sort_by("word")  # rows come in any order
    words = codes["word"].to_numpy()
    path, deep = _flat(codes["path"], np.int64)
    starts = np.concatenate([[0], np.cumsum(deep)])
    _, nodes = np.unique(path >> 1, return_inverse=True)
    asked, lengths = _flat(texts["hashes"], np.int64)
    place, text = _places(words, asked), np.repeat(np.arange(len(lengths)), lengths)
    kept = place >= 0
    place, text = place[kept], text[kept]
    begins = np.searchsorted(text, np.arange(len(lengths)))
    chunk = (np.arange(len(text)) - begins[text]) // LARGEST_SENTENCE
    sentence = np.cumsum(np.concatenate([[0], (np.diff(text) != 0) | (np.diff(chunk) != 0)])) if len(text) else text
    vectors = trained(initial(words, size), starts, nodes, path & 1, place, sentence, seed)
    return pa.table({"word": words} | {f"v{k}": vectors[:, k] for k in range(size)})


def _mean(texts: pa.Table, known: pa.Table, row_id: str, size: int) -> pa.Table:
    known = known.sort_by("word")
    vectors = np.zeros((known.num_rows + 1, size))
    for k in range(size):
        vectors[:-1, k] = known[f"v{k}"].to_numpy()
    asked, lengths = _flat(texts["hashes"], np.int64)
    place = _places(known["word"].to_numpy(), asked)  # an unknown word counts as zero
    out, some = np.zeros((len(lengths), size)), np.flatnonzero(lengths)
    begins = (np.cumsum(lengths) - lengths)[some]
    cuts = np.unique([*np.searchsorted(begins, np.arange(0, len(place), ADDED_AT_ONCE)), len(some)])
    for low, high in zip(cuts, cuts[1:]):
        first, last = begins[low], begins[high] if high < len(some) else len(place)
        out[some[low:high]] = np.add.reduceat(vectors[place[first:last]], begins[low:high] - first, axis=0)
    out /= np.maximum(lengths, 1)[:, None]
    mean = pa.ListArray.from_arrays(pa.array(np.arange(len(lengths) + 1) * size, pa.int32()), pa.array(out.ravel()))
    return pa.table([texts[row_id], mean], names=[row_id, "mean"])


# --- all parts -------------------------------------------------------------------


def mean_vectors(
    tokens: DataFrame, row_id: str, size: int = 32, min_count: int = 5, parts: int | None = None, seed: int = 42
) -> DataFrame:
    """``(row_id, mean)`` from ``(row_id, tokens)``: the sum of a text's word vectors over the number of its tokens."""
    hashes = F.transform("tokens", lambda w: F.xxhash64(w))
    texts = stored(tokens.select(F.monotonically_increasing_id().alias("number"), row_id, hashes.alias("hashes")), "hashes")
    every = texts.select(F.explode("hashes").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = stored(every.filter(F.col("n") >= min_count), "words")
    if parts is None:
        parts = (texts.agg(F.sum(F.size("hashes"))).first()[0] or 0) // PART_TOKENS + 1
        parts = max(parts, min(texts.rdd.getNumPartitions(), texts.sparkSession.sparkContext.defaultParallelism))
    dealt = texts.withColumn("part", F.pmod(F.xxhash64("number"), F.lit(parts)))
    tasks = 2 * parts  # given, so that parts are not put together, which are long tasks by few bytes
    used = dealt.select("part", F.explode(F.array_distinct("hashes")).alias("word")).distinct()
    used = stored(used.join(words.select("word"), "word", "left_semi"), "used")
    codes = coded(words)
    columns = [f"v{k}" for k in range(size)]

    def train(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _train(left, right, size, seed + key[0].as_py())

    def mean(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return _mean(left, right, row_id, size)

    mine = dealt.select("part", "number", "hashes").repartition(tasks, "part").groupBy("part")
    copies = mine.cogroup(used.join(codes, "word").repartition(tasks, "part").groupBy("part")).applyInArrow(train, "word long, " + ", ".join(f"{c} float" for c in columns))
    vectors = stored(copies.groupBy("word").agg(*[F.avg(c).cast("float").alias(c) for c in columns]), "vectors")
    out = texts.select(row_id).withColumn("mean", F.lit(None).cast("array<double>")).schema
    mine = dealt.select("part", row_id, "hashes").repartition(tasks, "part").groupBy("part")
    found = stored(mine.cogroup(used.join(vectors, "word").repartition(tasks, "part").groupBy("part")).applyInArrow(mean, out), "means")
    for table in (texts, words, used, codes, vectors):
        drop_stored(table)
    return found
