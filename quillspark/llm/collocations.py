"""Phrase collocations by top-order marginalisation: only longest windows are counted, shorter phrases are their sums.

A word's window is the word and the ones that follow it in its piece, ``order`` columns with empty words as padding.  Counts of all
phrases up to ``order`` words come from these lead columns alone: ROLLUP over the columns sums windows over successively shorter
prefixes, and a prefix that does not end in padding is a phrase.

Windows of the whole corpus would nearly all be distinct, so they are first cut where no phrase can go on: a phrase of
``min_count`` occurrences has only words, pairs and triples of ``min_count`` occurrences or more.  Texts are read once, into
streams of word numbers per block of text.  A block's distinct words go, packed, to the parts that own them, which answer with
counts and numbers of the frequent ones; then its distinct pairs and triples of frequent words do.  No list of
words or pairs is held whole anywhere.

Words are told apart by 64 bits of language and word until they are numbered; pairs and triples are exact.  Scores are
decimals of 38 digits.

Defined cases: a null text is empty; a null ``lang`` is ``und``; repeated rows count each; empty texts, texts without
words and empty tables give no phrases; a very long text is a block of its own; ``doc_id`` and further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.blocks import block_rows, dealt, pack_columns, serialised, unpack_columns
from quillspark.llm.common import BYTE_CODES, LOWER, Scratch, mix, prefix_hashes, shuffle_partitions, slices, substring_hashes, text_bytes, word_spans

ORDER = 5
MIN_COUNT = 100
TOP = 2000
INSIDE_PERCENT = 100
BLOCK_BYTES = 4 << 20

_PIECE_END = np.zeros(256, bool)
_PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BETWEEN = _PIECE_END.copy()
_BETWEEN[[0x20, 0x09]] = True


# --- texts to streams of word numbers ------------------------------------------------


def _hashes(words: pa.StringArray) -> np.ndarray:
    if words.offset or not words.buffers()[1]:
        words = pa.array(words.to_pylist() or [""], pa.string())[: len(words)]
    ends = np.frombuffer(words.buffers()[1], np.int32)[: len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
    return mix(substring_hashes(prefix_hashes(BYTE_CODES[data[: ends[-1]]]), ends[:-1], ends[1:]))


def word_hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    coded = langs.dictionary_encode()
    return mix(_hashes(words) + _hashes(coded.dictionary)[coded.indices.to_numpy()] * np.uint64(3))


def number_words(rows: pa.RecordBatch):
    """Distinct (lang, word) of a block with counts, and all words in order as numbers from 0, -1 where a piece ends."""
    data, offsets = text_bytes(rows)
    low = LOWER[data]
    starts, stops = word_spans(low, offsets, _BETWEEN)
    owner = np.searchsorted(offsets, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(_PIECE_END[low]), starts)
    ends = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    inner = low[~_BETWEEN[low]]
    coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends.tobytes()), pa.py_buffer(inner.tobytes())).dictionary_encode()
    langs = rows.column("lang").dictionary_encode()
    size = max(1, len(coded.dictionary))
    key = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner] * size + coded.indices.to_numpy(zero_copy_only=False)
    own, number, n = np.unique(key, return_inverse=True, return_counts=True)
    parted = np.ones(len(starts), bool)
    parted[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
    stream = np.full(len(starts) + int(parted.sum()), -1)
    stream[np.arange(len(starts)) + np.cumsum(parted)] = number
    return langs.dictionary.take(pa.array(own // size)), coded.dictionary.take(pa.array(own % size)), n, stream


# --- frequent words, pairs and triples -----------------------------------------------------


#: Rows with part -1 are a block's own, for its next step; the others ask a part for counts.
_ASKED_ARROW = pa.schema(
    [("block", pa.int64()), ("part", pa.int64())]
    + [(name, pa.binary()) for name in ("blob", "vocabulary", "ids", "follows", "told_words", "told_pairs")]
    + [("totals", pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())])))]
)
_ASKED = (
    "block long, part long, blob binary, vocabulary binary, ids binary, follows binary, told_words binary, told_pairs binary, "
    "totals array<struct<lang: string, n: long>>"
)


def _packed_words(langs: pa.Array, words: pa.Array) -> bytes:
    rows = pa.RecordBatch.from_arrays([langs, words], names=["lang", "word"])
    return zstandard.ZstdCompressor(level=3).compress(serialised(rows))


def _part(ids: list[np.ndarray], parts: int) -> np.ndarray:
    out = np.zeros(len(ids[0]), np.uint64)
    for column in ids:
        out = mix(out + column.astype(np.uint64))
    return (out % np.uint64(parts)).astype(np.int64)


def _asked(block: int, own: dict, ids: list[np.ndarray], n: np.ndarray, parts: int) -> pa.Table:
    values = {"block": block, "part": -1, **own}
    out = [pa.table([pa.array([values.get(f.name)], f.type) for f in _ASKED_ARROW], schema=_ASKED_ARROW)]
    for made in dealt(_part(ids, parts), "", **{f"i{k}": c for k, c in enumerate(ids)}, n=n):
        rest = [pa.nulls(made.num_rows, f.type) for f in _ASKED_ARROW][3:]
        out.append(pa.table([pa.array([block] * made.num_rows, pa.int64()), made.column("key"), made.column("blob"), *rest], schema=_ASKED_ARROW))
    return pa.concat_tables(out)


def _answer(size: int, min_count: int, parts: int):
    """For each run of words a block asked for: its count over all blocks, 0 if rare; whether the block is the first to ask; a number.

    Numbers are the lower, the more frequent a run is in its part.
    """

    def build(key, table):
        kinds = ("u" if size == 1 else "i") * size + "i"
        asked = [unpack_columns([b], kinds) for b in table.column("blob").to_pylist()]
        *ids, n = (np.concatenate([x[i] for x in asked]) for i in range(size + 1))
        order = np.lexsort(ids)
        new = np.ones(len(n), bool)
        new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in ids], axis=0)
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order], first)
        total[total < min_count] = 0
        number = np.empty(len(first), np.int64)
        number[np.argsort(-total, kind="stable")] = np.arange(len(first)) * parts + key[0].as_py()
        number[total == 0] = 0
        repeat = np.diff(np.append(first, len(n)))
        own = np.empty((3, len(n)), np.int64)
        own[:, order] = np.repeat(total, repeat), new, np.repeat(number, repeat)
        edges = np.cumsum([0] + [len(x[0]) for x in asked])
        blobs = [pack_columns(count=own[0, i:j], told=own[1, i:j], number=own[2, i:j]) for i, j in zip(edges[:-1], edges[1:])]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "blob": pa.array(blobs, pa.binary())})

    return build


def _answers(table: pa.Table, ids: list[np.ndarray], parts: int) -> np.ndarray:
    """Counts, first-to-ask flags and numbers in the order in which the block has its runs of words."""
    part = _part(ids, parts)
    own = np.zeros((3, len(part)), np.int64)
    if len(part):
        blobs = [b for _, b in sorted(zip(table.column("part").to_pylist(), table.column("blob").to_pylist()))]
        own[:, np.argsort(part, kind="stable")] = unpack_columns(blobs, "iii")
    return own


def _grams(stream: np.ndarray, usable: np.ndarray, words: int, size: int):
    """Distinct runs of ``size`` words (a column per place) at usable places, with counts and each place's run (-1: none)."""
    start = np.flatnonzero(usable)
    key = stream[start]
    for k in range(1, size):
        _, key = np.unique(key * max(words, 1) + stream[start + k], return_inverse=True)
    _, first, where, n = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    at = np.full(len(stream), -1)
    at[start] = where
    return [stream[start[first] + k] for k in range(size)], n, at


def _pair_places(stream: np.ndarray) -> np.ndarray:
    usable = np.zeros(len(stream), bool)
    usable[:-1] = (stream[:-1] >= 0) & (stream[1:] >= 0)
    return usable


def _triple_places(follows: np.ndarray) -> np.ndarray:
    usable = np.zeros(len(follows), bool)
    usable[:-1] = follows[:-1] & follows[1:]
    return usable


def _kept_places(usable: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places inside of usable runs, and these with the one place after each."""
    inside = usable.copy()
    for k in range(1, size):
        inside[k:] |= usable[:-k]
    kept = inside.copy()
    kept[1:] |= inside[:-1]
    return inside, kept


def _ask_words(docs: DataFrame, block_bytes: int, parts: int) -> DataFrame:
    def build(batches):
        block = TaskContext.get().partitionId() << 24
        for whole in batches:
            for rows in slices(whole, block_bytes):
                langs, words, n, stream = number_words(rows)
                if not len(words):
                    continue
                by_lang = langs.dictionary_encode()
                sums = np.bincount(by_lang.indices.to_numpy(), n).astype(np.int64).tolist()
                totals = [{"lang": lang, "n": size} for lang, size in zip(by_lang.dictionary.to_pylist(), sums)]
                own = {"blob": pack_columns(s=stream), "vocabulary": _packed_words(langs, words), "totals": totals}
                yield from _asked(block, own, [word_hashes(langs, words)], n, parts).to_batches()
                block += 1

    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(build, _ASKED)


def _ask_pairs(parts: int):
    def build(key, left, answers):
        (stream,) = unpack_columns(left.column("blob").to_pylist(), "i")
        known = block_rows(left.column("vocabulary")[0].as_py())
        count, told, number = _answers(answers, [word_hashes(known.column("lang"), known.column("word"))], parts)
        often = np.flatnonzero(count)
        often = often[np.argsort(number[often])]
        if not len(often):
            return _ASKED_ARROW.empty_table()
        ids = number[often]
        place = np.full(len(count) + 1, -1)  # the last one is for piece ends
        place[often] = np.arange(len(often))
        stream = place[stream]
        usable = _pair_places(stream)
        inside, kept = _kept_places(usable, 2)
        grams, n, _ = _grams(stream, usable, len(ids), 2)
        tell = np.flatnonzero(told[often])
        langs, words = (known.column(c).take(pa.array(often)) for c in ("lang", "word"))
        own = {"blob": pack_columns(s=np.where(inside, stream, -1)[kept]), "vocabulary": _packed_words(langs, words), "ids": pack_columns(i=ids)}
        own |= {"told_words": pack_columns(a=tell, n=count[often][tell])}
        return _asked(key[0].as_py(), own, [ids[g] for g in grams], n, parts)

    return build


def _ask_triples(parts: int):
    def build(key, left, answers):
        (stream,), (ids,) = unpack_columns(left.column("blob").to_pylist(), "i"), unpack_columns(left.column("ids").to_pylist(), "i")
        (a, b), _, at = _grams(stream, _pair_places(stream), len(ids), 2)
        count, told, _ = _answers(answers, [ids[a], ids[b]], parts)
        tell = (told > 0) & (count > 0)
        follows = np.append(count > 0, False)[at]
        usable = _triple_places(follows)
        inside, kept = _kept_places(usable, 3)
        grams, n, _ = _grams(stream, usable, len(ids), 3)
        own = {c: left.column(c)[0].as_py() for c in ("vocabulary", "ids", "told_words")}
        follows[:-1] &= inside[:-1] & inside[1:]
        own |= {"blob": pack_columns(s=np.where(inside, stream, -1)[kept]), "follows": pack_columns(f=follows[kept].astype(np.int64))}
        own |= {"told_pairs": pack_columns(a=a[tell], b=b[tell], n=count[tell])}
        return _asked(key[0].as_py(), own, [ids[g] for g in grams], n, parts)

    return build


# --- windows -------------------------------------------------------------------


def windows_of(stream: np.ndarray, goes_on: np.ndarray, words: int, order: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows (a column per place, -1 as padding) that start with a frequent run of ``size`` words, and their counts."""
    start = np.flatnonzero(goes_on)
    lead = np.full((len(start), order), -1)
    for k in range(size):
        lead[:, k] = stream[start + k]
    alive = np.ones(len(start), bool)
    for k in range(size, order):
        at = start + k - size + 1
        alive &= (at < len(stream)) & goes_on[np.minimum(at, len(stream) - 1)]
        lead[alive, k] = stream[at[alive] + size - 1]
    key = lead[:, 0].copy()
    for k in range(1, order):
        _, key = np.unique(key * (words + 1) + lead[:, k] + 1, return_inverse=True)
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return lead[first], n


def _windows(parts: int, order: int):
    """Windows of a block.

    Those that end after a word or a pair are told once for all blocks, by the first block that has it, from the owner's
    count; so windows that go on are taken off where they would have ended.
    """
    names = ["lang", *(f"w{k}" for k in range(1, order + 1))]
    schema = pa.schema([*((name, pa.string()) for name in names), ("n", pa.int64())])

    def build(key, left, answers):
        column = lambda name, kinds: unpack_columns(left.column(name).to_pylist(), kinds)
        (stream,), (ids,), (follows,) = column("blob", "i"), column("ids", "i"), column("follows", "i")
        one, one_n = column("told_words", "ii")
        a, b, two_n = column("told_pairs", "iii")
        pad = lambda *places: np.column_stack([*places, *[np.full(len(places[0]), -1)] * (order - len(places))])
        lead, n = [pad(one), pad(a, b), pad(a)], [one_n, two_n, -two_n]
        if order > 2:
            usable = _triple_places(follows > 0)
            grams, _, at = _grams(stream, usable, len(ids), 3)
            count, _, _ = _answers(answers, [ids[g] for g in grams], parts)
            longer, more = windows_of(stream, np.append(count > 0, False)[at], len(ids), order, 3)
            ends, where = np.unique(longer[:, 0] * len(ids) + longer[:, 1], return_inverse=True)
            off = np.bincount(where, more, len(ends)).astype(np.int64)
            lead, n = [*lead, longer, pad(ends // max(1, len(ids)), ends % max(1, len(ids)))], [*n, more, -off]
        lead, n = np.concatenate(lead), np.concatenate(n)
        known = block_rows(left.column("vocabulary")[0].as_py())
        words = pa.concat_arrays([known.column("word"), pa.array([""], pa.string())])
        langs = known.column("lang")
        columns = [words.take(pa.array(np.where(c < 0, len(ids), c))) for c in lead.T]
        return pa.table([langs.take(pa.array(lead[:, 0])), *columns, pa.array(n.astype(np.int64))], schema=schema)

    return build


def count_phrases(docs: DataFrame, scratch: Scratch, order: int = ORDER, min_count: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES):
    """Tables of ``lang, words, f`` (all phrases of ``min_count`` occurrences, single words too) and of ``lang, n`` (all words)."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)

    def own(asked, *columns):
        return asked.filter("part < 0").select(F.col("block").alias("at"), "blob", "vocabulary", *columns).groupBy("at")

    def answered(asked, size):
        told = asked.filter("part >= 0").select("part", "block", "blob").groupBy("part")
        return told.applyInArrow(_answer(size, min_count, parts), "block long, part long, blob binary").groupBy("block")

    words = scratch.store(_ask_words(docs, block_bytes, parts), "words")
    each = words.filter("part < 0").select(F.inline("totals"))
    totals = scratch.store(each.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    pairs = scratch.store(own(words).cogroup(answered(words, 1)).applyInArrow(_ask_pairs(parts), _ASKED), "pairs")
    scratch.drop("words")
    triples = own(pairs, "ids", "told_words").cogroup(answered(pairs, 2)).applyInArrow(_ask_triples(parts), _ASKED)
    triples = scratch.store(triples, "triples")
    scratch.drop("pairs")

    columns = [f"w{k}" for k in range(1, order + 1)]
    schema = ", ".join(f"{c} string" for c in ("lang", *columns)) + ", n long"
    left = own(triples, "ids", "follows", "told_words", "told_pairs")
    windows = left.cogroup(answered(triples, 3)).applyInArrow(_windows(parts, order), schema)
    summed = spark.sql(
        f"SELECT lang, {', '.join(columns)}, sum(n) AS f FROM {{windows}} "
        f"GROUP BY lang, w1, ROLLUP ({', '.join(columns[1:])}) HAVING sum(n) >= {int(min_count)}",
        windows=windows,
    )
    unpadded = summed.filter(~F.exists(F.array(*columns), lambda w: F.coalesce(w, F.lit("-")) == ""))
    phrases = unpadded.select("lang", F.filter(F.array(*columns), lambda w: w.isNotNull()).alias("words"), "f")
    return scratch.store(phrases, "phrases"), totals


def find_collocations(
    docs: DataFrame,
    order: int = ORDER,
    min_count: int = MIN_COUNT,
    top: int = TOP,
    inside_percent: int = INSIDE_PERCENT,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``order`` words by the score of their weakest cut.

    A phrase goes if a longer one that holds it has ``inside_percent`` of its occurrences or more.
    """
    with Scratch(docs.sparkSession, "collocations") as scratch:
        counted, totals = count_phrases(docs, scratch, order, min_count, block_bytes)
        joined = lambda words: F.array_join(words, " ")  # noqa: E731  no word holds a blank
        counts = counted.select("lang", joined("words").alias("phrase"), "f")
        phrases = counted.filter(F.size("words") > 1)

        spans = F.flatten(
            F.transform(
                F.sequence(F.lit(2), F.size("words") - 1),
                lambda size: F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: joined(F.slice("words", i, size))),
            )
        )
        held = phrases.filter(F.size("words") > 2).select("lang", "f", F.explode(spans).alias("phrase"))
        held = held.groupBy("lang", "phrase").agg(F.max("f").alias("held"))

        cuts = phrases.select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
        cuts = cuts.select(
            "lang",
            joined("words").alias("phrase"),
            "a",
            "k",
            joined(F.slice("words", F.lit(1), F.col("k"))).alias("head"),
            joined(F.slice("words", F.col("k") + 1, F.size("words"))).alias("rest"),
        )
        heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
        rests = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
        scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(totals, "lang")
        wide = {c: f"CAST({c} AS DECIMAL(19, 0))" for c in "anlr"}
        score = F.expr(f"(CAST(1000 AS DECIMAL(4, 0)) * {wide['a']} * {wide['n']}) DIV ({wide['l']} * {wide['r']})")
        weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        kept = weakest.join(held, ["lang", "phrase"], "left").filter(
            F.col("held").isNull() | (100 * F.col("held") < inside_percent * F.col("a"))
        )
        best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
        ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
        return scratch.keep(
            ranked.select(
                "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
            )
        )
