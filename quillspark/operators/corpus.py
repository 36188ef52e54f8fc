"""Building one clean corpus out of several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.text import clean_text, record_text, squash, strip, word_count
from quillspark.operators.joins import hot_key_join
from quillspark.operators.running import in_ranges
from quillspark.session import stored

CORPUS_RANK = {"human": 0, "ai": 1}


def _field(df: DataFrame, *names: str) -> Column:
    """First non-null among the columns (or ``struct.field`` paths) that exist."""
    found = []
    for name in names:
        head, _, tail = name.partition(".")
        if head in df.columns and (not tail or tail in df.select(f"{head}.*").columns):
            found.append(F.col(name).cast("string"))
    return F.coalesce(*found, F.lit(None).cast("string"))


def normalise_rows(df: DataFrame, label: str) -> DataFrame:
    """Text, label, source and id with the defaults of either corpus."""
    if label == "human":
        source = F.coalesce(_field(df, "source"), F.lit("arxiv"))
        row_id = _field(df, "id", "metadata.arxiv_id")
    else:
        source = F.coalesce(_field(df, "source", "source_llm"), F.lit("generated"))
        row_id = _field(df, "original_id")
    return df.select(
        F.coalesce(_field(df, "text"), F.lit("")).alias("text"),
        F.lit(label).alias("label"),
        source.alias("source"),
        F.coalesce(row_id, F.lit("")).alias("id"),
    )


def union_corpora(human: DataFrame, ai: DataFrame) -> DataFrame:
    """Human rows, then generated rows; ``corpus_rank`` keeps that order."""
    return human.withColumn("corpus_rank", F.lit(CORPUS_RANK["human"])).unionByName(
        ai.withColumn("corpus_rank", F.lit(CORPUS_RANK["ai"]))
    )


def build_record(papers: DataFrame) -> DataFrame:
    """One training record per paper; short ones are dropped."""
    records = papers.select(
        record_text(F.col("title"), F.col("abstract")).alias("text"),
        "source",
        F.struct(
            F.coalesce("arxiv_id", F.lit("")).alias("arxiv_id"),
            "title",
            "authors",
            "categories",
            "published",
            F.length(record_text(F.col("title"), F.col("abstract"))).alias("text_length"),
        ).alias("metadata"),
    )
    return filter_min_record_len(records)


def filter_complete_records(papers: DataFrame) -> DataFrame:
    return papers.filter((strip(F.col("title")) != "") & (strip(F.col("abstract")) != ""))


def filter_min_record_len(records: DataFrame, least: int = fv.MIN_RECORD_CHARS) -> DataFrame:
    return records.filter(F.length("text") >= least)


def filter_sample_len(df: DataFrame, above: int = fv.MIN_SAMPLE_CHARS) -> DataFrame:
    return df.filter(F.length("text") > above)


def filter_generation_input(df: DataFrame, least: int = fv.MIN_GENERATION_CHARS) -> DataFrame:
    return df.filter(F.length(strip(F.col("text"))) >= least)


def filter_scorable(df: DataFrame, least: int = fv.MIN_SCORABLE_CHARS) -> DataFrame:
    return df.filter(F.length("clean_text") >= least)


def filter_length_band(df: DataFrame, low: int = fv.CLEAN_MIN_CHARS, high: int = fv.CLEAN_MAX_CHARS) -> DataFrame:
    """Texts whose length, white space collapsed but marks still in, lies in the band."""
    return df.filter(F.length(squash(F.col("text"))).between(low, high))


def filter_nonempty_clean(df: DataFrame) -> DataFrame:
    return df.filter(F.col("clean_text") != "")


def with_clean_text(df: DataFrame) -> DataFrame:
    return df.withColumn("clean_text", clean_text(F.col("text")))


def clean_nonempty(df: DataFrame) -> DataFrame:
    """``clean_text`` in place of ``text``, without the rows that clean to nothing.

    A filter on a computed column would be pushed below the projection and clean
    every text twice; a generator that yields zero or one text cleans it once.
    """
    kept = F.filter(F.array(clean_text(F.col("text"))), lambda t: t != "")
    others = [c for c in df.columns if c != "text"]
    return df.select(*others, F.explode(kept).alias("clean_text"))


def with_text_stats(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "text_length": F.length("clean_text").cast("bigint"),
            "word_count": word_count(F.col("clean_text")).cast("bigint"),
        }
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the lowest by ``order``.

    An aggregate rather than a window: each map task keeps one row per key, so a
    key that holds a third of the table still sends one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def text_digest(text: str = "clean_text") -> Column:
    """Stands for a text as a key: 256 bits and the length, whatever the text's size."""
    return F.struct(F.unhex(F.sha2(F.col(text).cast("binary"), 256)).alias("sha"), F.length(text).alias("chars"))


def dedupe_keep_first(df: DataFrame, order: list[str], text: str = "clean_text") -> DataFrame:
    """Drop repeated texts, keeping the first by ``order``; its columns may be null or shared by rows.

    The input is stored once with a row number, which settles ties and alone says which rows go.  Only digests, order
    columns and row numbers are grouped and shuffled.  Texts that have a copy are few beside all: their later rows are
    looked up by digest and taken out by number, so a text moves at most once after it is stored, or not at all if the
    rows to drop are few enough to be broadcast.
    """
    row = "_row"
    while row in df.columns:
        row += "_"
    numbered = stored(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    place = F.struct(*order, row)
    narrow = numbered.select(text_digest(text).alias("_digest"), place.alias("_place"))
    groups = narrow.groupBy("_digest").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    repeated = groups.filter(F.col("_n") > 1).drop("_n")
    number = F.col("_place")[row]
    later = narrow.join(repeated, "_digest").filter(number != F.col("_first")[row]).select(number.alias(row))
    return numbered.join(later, row, "left_anti").select(*df.columns)


def antijoin_new_ids(
    incoming: DataFrame, stored_ids: DataFrame, key: str, order: list[str]
) -> DataFrame:
    """Rows whose id is neither stored yet nor seen earlier in the same run."""
    first_seen = first_per_key(incoming, [key], order)
    return first_seen.join(stored_ids.select(key), key, "left_anti")


def pair_original_generated(originals: DataFrame, generated: DataFrame, key: str) -> DataFrame:
    """Generated texts beside the original they came from (one original per key)."""
    return hot_key_join(generated, originals, [key])


def cap_total(df: DataFrame, order: list[str], most: int = fv.TARGET_TOTAL) -> DataFrame:
    """Stop at a target size: the first ``most`` rows by ``order``, which must be unique.

    Only the order columns are sorted, in ranges; the row at which to stop is
    looked up in the one range that holds it, and the table is then filtered in
    place instead of sending every task's first ``most`` rows to a single one.
    """
    columns = [F.col(c) for c in order]
    ranged = in_ranges(df.select(*order), columns)
    before = 0
    # one row per range: bounded by the number of shuffle partitions
    for part in ranged.groupBy("_range").count().orderBy("_range").toLocalIterator():
        if before + part["count"] >= most:
            break
        before += part["count"]
    else:
        return df
    place = F.row_number().over(W.partitionBy("_range").orderBy(*columns))
    last = (
        ranged.filter(F.col("_range") == part["_range"])
        .withColumn("_place", place)
        .filter(F.col("_place") == most - before)
        .first()
    )
    stop = F.struct(*[F.lit(last[c]).cast(df.schema[c].dataType).alias(c) for c in order])
    return df.filter(F.struct(*columns) <= stop)


def _digest_of(text: Column) -> Column:
    return F.struct(F.sha2(text.cast("binary"), 256).alias("sha"), F.length(text).alias("chars"))


def cleaning_report(df: DataFrame) -> DataFrame:
    """How many texts came in, survived cleaning, and repeated.

    Copies collapse map-side before the totals are taken, and only digests are shuffled.
    """
    digest = F.explode(F.transform(F.array(clean_text(F.col("text"))), _digest_of)).alias("_digest")
    per_text = df.select(digest).groupBy("_digest").count()
    kept = F.col("_digest.chars") > 0
    return per_text.agg(
        F.sum("count").alias("original_texts"),
        F.sum(F.when(kept, F.col("count")).otherwise(0)).alias("nonempty_texts"),
        F.sum(F.when(kept, F.col("count") - 1).otherwise(0)).alias("duplicates_removed"),
        F.count(F.when(kept, F.lit(1))).alias("final_texts"),
    )
