"""Readers with fixed schemas; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.functions.text import id_after_abs, last_segment, strip
from quillspark.operators.corpus import normalise_rows
from quillspark.session import broadcast_if_small

HUMAN_SCHEMA = """
    text string, source string, id string,
    metadata struct<arxiv_id string, title string, authors array<string>,
                    categories array<string>, published string, text_length int>
"""
AI_SCHEMA = """
    text string, label string, source string, source_llm string, temperature double,
    prompt_template string, original_id string, original_title string,
    original_categories array<string>, original_length int, generated_length int,
    length_ratio double, generation_attempt int,
    quality_checks struct<length_valid boolean, topic_consistent boolean, not_empty boolean,
                          not_too_short boolean, no_prompt_leakage boolean,
                          no_repetition boolean, scientific_style boolean>,
    generated_at string
"""
SAMPLE_SCHEMA = "text string, label string, length int, source string, original_id int"
PROCESSED_SCHEMA = "text string, label string, source string, text_length int, word_count int"
FEED_SCHEMA = """
    id string, title string, summary string, published string,
    category array<struct<_term string>>, author array<struct<name string>>
"""


def read_corpus_jsonl(spark: SparkSession, path: str, label: str) -> DataFrame:
    """Strict: a malformed line or a missing file fails the job."""
    schema = HUMAN_SCHEMA if label == "human" else AI_SCHEMA
    return normalise_rows(spark.read.schema(schema).option("mode", "FAILFAST").json(path), label)


def read_jsonl_tolerant(
    spark: SparkSession, path: str, schema: str = SAMPLE_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the lines that could not be parsed."""
    lines = spark.read.text(path).filter(strip(F.col("value")) != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.select("value", F.from_json("value", schema + ", _bad string", options).alias("row"))
    good = parsed.filter(F.col("row._bad").isNull()).select("row.*").drop("_bad")
    rejected = parsed.filter(F.col("row._bad").isNotNull()).select(F.col("value").alias("line"))
    return good, rejected


def read_processed_splits(spark: SparkSession, path: str) -> DataFrame:
    """All splits of a processed corpus; filters on ``split`` prune directories."""
    return spark.read.schema(PROCESSED_SCHEMA + ", split string").json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(text_id, text)``: non-blank lines numbered from zero in file order.

    Blank lines go first; the others of a file split then have consecutive ids.  A line's number is its distance from
    its split's first id, plus the lines in the splits before, so texts stay where they are read and only one
    row per split moves.
    """
    lines = spark.read.text(path).select(
        "_metadata.file_path", "_metadata.file_block_start", strip(F.col("value")).alias("text")
    )
    lines = lines.filter(F.col("text") != "").withColumn("_at", F.monotonically_increasing_id())
    split = ["file_path", "file_block_start"]
    counts = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_lines"), F.min("_at").alias("_first"))
    before = F.sum("_lines").over(W.orderBy(*split)) - F.col("_lines")  # one row per file split
    offsets = counts.select(*split, (before - F.col("_first")).alias("_shift"))
    return lines.join(broadcast_if_small(offsets), split).select(
        (F.col("_at") + F.col("_shift")).alias("text_id"), "text"
    )


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Each file is one text."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))


def parse_feed_xml(spark: SparkSession, path: str, keep_archive: bool = True) -> DataFrame:
    """Atom entries as paper rows; entries without title or abstract are dropped.

    ``keep_archive`` keeps prefixes such as ``cond-mat/`` in ids; without it the
    id is the last path segment.
    """
    entries = (
        spark.read.format("xml")
        .schema(FEED_SCHEMA)
        .option("rowTag", "entry")
        .option("mode", "DROPMALFORMED")
        .load(path)
    )
    entry_id = id_after_abs(F.col("id")) if keep_archive else last_segment(F.col("id"))
    empty = F.array().cast("array<string>")
    terms = F.transform("category", lambda c: c["_term"])
    names = F.transform("author", lambda a: strip(a["name"]))
    papers = entries.select(
        F.coalesce(entry_id, F.lit("")).alias("arxiv_id"),
        strip(F.coalesce("title", F.lit(""))).alias("title"),
        strip(F.coalesce("summary", F.lit(""))).alias("abstract"),
        F.coalesce(F.filter(names, lambda n: n.isNotNull()), empty).alias("authors"),
        F.coalesce(F.filter(terms, lambda t: t != ""), empty).alias("categories"),
        F.coalesce("published", F.lit("")).alias("published"),
        F.lit("arxiv").alias("source"),
    )
    return papers.filter((F.col("title") != "") & (F.col("abstract") != ""))


def malformed_feed_entries(spark: SparkSession, path: str) -> DataFrame:
    """The entries that ``parse_feed_xml`` cannot read, as they stand."""
    return (
        spark.read.format("xml")
        .schema(FEED_SCHEMA + ", _bad string")
        .option("rowTag", "entry")
        .option("columnNameOfCorruptRecord", "_bad")
        .load(path)
        .filter(F.col("_bad").isNotNull())
        .select(F.col("_bad").alias("entry"))
    )


def read_processed_ids(spark: SparkSession, path: str, kind: str = "checkpoint") -> DataFrame:
    """Distinct ids from a checkpoint file (one per line) or from a stored corpus."""
    if kind == "checkpoint":
        ids = spark.read.text(path).select(F.trim("value").alias("id"))
    else:
        ids = spark.read.schema(HUMAN_SCHEMA).json(path).select(F.col("metadata.arxiv_id").alias("id"))
    return ids.filter(F.col("id") != "").distinct()
