"""Language identification by prediction by partial matching over bytes.

Per language, a tree of byte contexts up to three bytes long (ASCII letters lower-cased, a text's start padded
with zero bytes) holds symbol counts.  A byte costs ``-log2(count / (total + distinct))`` in the longest known
context; where the context never saw it, an escape ``-log2(distinct / (total + distinct))`` is paid and the
next shorter context is asked, down to a uniform byte.  Statistics are frozen after learning, so a byte's cost
depends on four bytes alone: costs of all learned four-byte strings are tabulated per language, others
are worked out once per batch and distinct string.  The language with the shortest code wins.

Learning reads a bounded sample of every language: its rows in order of a digest of ``doc_id`` until ``sample_bytes`` of
text are met, but ``MIN_DOCS`` rows at least.  A text counts with its first ``LEARN_CHARS`` characters when learning; rows that
share an id are taken together.  Every ``lang`` that is not null is learned, so the model grows with their number.
Prediction reads whole texts of all rows.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing could
be learned (``has_letter`` tells the two apart); a null ``doc_id`` is neither learned from nor held out; rows with null ``lang`` are predicted, not
learned from; repeated rows count each; further columns stay outside.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.llm.common import LOWER, mix, slices, text_bytes

ORDER = 3
UNKNOWN = "und"
SLOTS_LOG2 = 21
MIN_DOCS = 20
LEARN_CHARS = 1_000_000
TABLE_CELLS = 1 << 24  # tabulated costs; what is not tabulated is worked out per batch


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)) == fold


def four_grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The last four bytes up to each position as one number; bytes before a text's start are zero."""
    data = LOWER[data].astype(np.uint32)
    out = data.copy()
    starts = offsets[:-1][np.diff(offsets) > 0]
    for back in range(1, ORDER + 1):
        earlier = np.zeros_like(data)
        earlier[back:] = data[:-back]
        for i in range(back):  # the first bytes of a text see nothing of the text before
            at = starts + i
            earlier[at[at < len(data)]] = 0
        out |= earlier << np.uint32(8 * back)
    # short texts: a position may have been cleared on behalf of a later text's start, which is right as well
    return out


@dataclass
class Statistics:
    """Counts of one language: per order the sorted strings and contexts."""

    grams: list[np.ndarray]
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]
    distinct: list[np.ndarray]

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray) -> Statistics:
        out = cls([], [], [], [], [])
        for order in range(ORDER + 1):
            mask = np.uint64(2 ** (8 * (order + 1)) - 1)
            own, where = np.unique(grams.astype(np.uint64) & mask, return_inverse=True)
            n = np.bincount(where, counts, len(own))
            contexts, where = np.unique(own >> np.uint64(8), return_inverse=True)
            out.grams.append(own)
            out.counts.append(n)
            out.contexts.append(contexts)
            out.totals.append(np.bincount(where, n, len(contexts)))
            out.distinct.append(np.bincount(where, minlength=len(contexts)).astype(float))
        return out

    def costs(self, grams: np.ndarray) -> np.ndarray:
        """Bits that the last byte of each four-byte string takes after the three before it."""
        bits = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        for order in range(ORDER, -1, -1):
            own = grams[open_].astype(np.uint64) & np.uint64(2 ** (8 * (order + 1)) - 1)
            at = _find(self.contexts[order], own >> np.uint64(8))
            known = at >= 0
            whole = self.totals[order][at] + self.distinct[order][at]
            seen = _find(self.grams[order], own)
            hit = known & (seen >= 0)
            bits[open_[hit]] += np.log2(whole[hit] / self.counts[order][seen[hit]])
            escape = known & ~hit
            bits[open_[escape]] += np.log2(whole[escape] / self.distinct[order][at[escape]])
            open_ = open_[~hit]
        bits[open_] += 8.0
        return bits


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of keys in a sorted array, -1 where absent."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, at, -1)


@dataclass
class LanguageModel:
    languages: list[str]
    statistics: list[Statistics]
    grams: np.ndarray  # learned strings, most frequent first
    table: np.ndarray  # their costs, a row per language
    slots: np.ndarray  # hash slot -> place in grams

    @classmethod
    def of(cls, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> LanguageModel:
        languages = sorted(counts)
        statistics = [Statistics.of(*counts[name]) for name in languages]
        everything = [counts[name] for name in languages]
        grams, where = np.unique(np.concatenate([g for g, _ in everything] or [[]]).astype(np.uint32), return_inverse=True)
        weight = np.bincount(where, np.concatenate([n for _, n in everything] or [[]]), len(grams))
        grams = grams[np.argsort(-weight, kind="stable")[: max(1, TABLE_CELLS // max(1, len(languages)))]]
        table = np.array([s.costs(grams) for s in statistics]).reshape(len(languages), len(grams))
        slots = np.full(1 << SLOTS_LOG2, -1, np.int32)
        slots[_slot(grams[::-1])] = np.arange(len(grams), dtype=np.int32)[::-1]  # the most frequent stays
        return cls(languages, statistics, grams, table, slots)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language: a row per language."""
        grams = four_grams(data, offsets)
        at = self.slots[_slot(grams)]
        slow = np.flatnonzero((at < 0) | (self.grams[at] != grams)) if len(self.grams) else np.arange(len(grams))
        new, where = np.unique(grams[slow], return_inverse=True)
        out = np.zeros((len(self.languages), len(offsets) - 1))
        for i, statistics in enumerate(self.statistics):
            bits = self.table[i][at] if len(self.grams) else np.zeros(len(grams))
            bits[slow] = statistics.costs(new)[where]
            upto = np.concatenate([[0.0], np.cumsum(bits)])
            out[i] = upto[offsets[1:]] - upto[offsets[:-1]]
        return out


def _slot(grams: np.ndarray) -> np.ndarray:
    return mix(grams.astype(np.uint64)) >> np.uint64(64 - SLOTS_LOG2)


def _sample(rows: DataFrame, sample_bytes: int) -> DataFrame:
    """Each language's first rows by digest: bytes per digest prefix, then a running total inside the prefix with the cut."""
    sized = rows.select("lang", "digest", F.octet_length("text").alias("b"), F.shiftright("digest", 52).alias("prefix"))
    counts = sized.groupBy("lang", "prefix").agg(F.sum("b").alias("b"), F.count("*").alias("n"))

    def needed(df, order):
        """Rows before which neither bound is met."""
        before = Window.partitionBy("lang").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sums = {f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) + F.col(f"{c}_0") for c in ("b", "n")}
        return df.withColumns(sums).filter((F.col("b_before") < sample_bytes) | (F.col("n_before") < MIN_DOCS))

    whole = needed(counts.withColumns({"b_0": F.lit(0), "n_0": F.lit(0)}), "prefix")
    last = whole.groupBy("lang").agg(F.max_by(F.struct("prefix", F.col("b_before").alias("b_0"), F.col("n_before").alias("n_0")), "prefix").alias("l"))
    last = F.broadcast(last.select("lang", "l.*"))
    inside = sized.join(last, ["lang", "prefix"]).groupBy("lang", "digest").agg(
        F.sum("b").alias("b"), F.count("*").alias("n"), F.first("b_0").alias("b_0"), F.first("n_0").alias("n_0")
    )
    cut = needed(inside, "digest").groupBy("lang").agg(F.max("digest").alias("cut"))
    return rows.join(F.broadcast(cut), "lang").filter(F.col("digest") <= F.col("cut"))


def learn(rows: DataFrame, sample_bytes: int = 2_000_000) -> LanguageModel:
    """Statistics from a bounded sample of (doc_id, text, lang) rows."""
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    head = F.substring("text", 1, LEARN_CHARS).alias("text")
    sample = _sample(rows.select(F.xxhash64("doc_id").alias("digest"), head, "lang"), sample_bytes)

    def count(batches):
        for batch in batches:
            names = batch.column(1).to_pylist()
            data, offsets = text_bytes(batch)
            grams, owner = four_grams(data, offsets), np.repeat(np.arange(len(names)), np.diff(offsets))
            for name in sorted(set(names)):
                mine = np.array([n == name for n in names])
                own, n = np.unique(grams[mine[owner]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(own), pa.string()), pa.array(own.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
                )

    counted = sample.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return LanguageModel.of(
        {name: (own["gram"].to_numpy(), own["n"].to_numpy().astype(float)) for name, own in found.groupby("lang")}
    )


def has_letter(texts: list[str | None]) -> np.ndarray:
    return np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)


def predict(docs: DataFrame, model: LanguageModel, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The given columns of every row with ``lang_pred``, ``score``, the language's share of all likelihoods, and ``has_letter``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in columns if c not in ("lang_pred", "score", "has_letter")]
    schema = StructType([docs.schema[c] for c in columns]).add("lang_pred", "string").add("score", "double").add("has_letter", "boolean")
    text = "text" if "text" in columns else None
    texts_at = columns.index("text") if text else len(columns)

    def build(batches):
        model = shared.value
        names = np.array([*model.languages, UNKNOWN], object)
        for whole in batches:
            for part in slices(whole, 1 << 20):
                data, offsets = text_bytes(part)
                best, score = np.full(part.num_rows, len(names) - 1), np.zeros(part.num_rows)
                letters = has_letter(part.column(texts_at).to_pylist())
                if model.languages:
                    bits = model.code_lengths(data, offsets)
                    best[letters] = bits.argmin(0)[letters]
                    odds = np.exp2(np.maximum(bits.min(0) - bits, -1000.0)).sum(0)
                    score[letters] = (1 / odds)[letters]
                passed = [part.column(i) for i in range(len(columns))]
                made = [pa.array(names[best], pa.string()), pa.array(score), pa.array(letters)]
                yield pa.RecordBatch.from_arrays([*passed, *made], names=schema.names)

    return docs.select(*columns, *([] if text else ["text"])).mapInArrow(build, schema)


def identify_languages(docs: DataFrame, sample_bytes: int = 2_000_000, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Learn from three quarters of the documents, predict all; ``held_out`` marks the fourth."""
    held = held_out()
    model = learn(docs.filter(~held), sample_bytes)
    found = predict(docs, model, ("doc_id", *(c for c in columns if c != "doc_id")))
    return found.withColumn("held_out", F.coalesce(held, F.lit(False)))
