"""Round trips through every source and sink, over whole tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from quillspark.catalog import base as b
from quillspark.catalog.base import query, table
from quillspark.catalog.corpus_queries import SPLIT
from quillspark.operators import metrics, profile
from quillspark.operators.splits import stratified_split
from quillspark.plans import prepare
from quillspark.session import scratch_path
from quillspark.sources import readers, writers
from quillspark.sources.snapshots import SnapshotTable


def human_records(spark, sf):
    """Documents in the shape a collector writes: the id lives in the metadata only."""
    return table(spark, sf, "documents").select(
        "text",
        "source",
        F.struct(
            F.col("doc_id").cast("string").alias("arxiv_id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            F.array(F.col("lang")).alias("categories"),
        ).alias("metadata"),
    )


@query(
    "read_corpus_jsonl",
    "SELECT CAST(doc_id AS VARCHAR) AS id, text, 'human' AS label, source FROM documents",
)
def _read_corpus(spark, sf):
    path = scratch_path(spark, "human")
    human_records(spark, sf).write.json(path)
    return readers.read_corpus_jsonl(spark, path, "human")


@query(
    "read_jsonl_tolerant",
    """WITH l AS (SELECT doc_id, text, source, to_json({'text': text, 'label': 'human', 'source': source})::VARCHAR AS line
                  FROM documents)
       SELECT 'good' AS kind, text, 'human' AS label, source, NULL AS line FROM l WHERE doc_id % 7 <> 0
       UNION ALL SELECT 'rejected', NULL, NULL, NULL, line[:length(line) // 2] FROM l WHERE doc_id % 7 = 0""",
)
def _tolerant(spark, sf):
    """Every seventh line is cut in half before reading."""
    path = scratch_path(spark, "broken")
    line = F.to_json(F.struct("text", F.lit("human").alias("label"), "source"))
    half = F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))
    table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 7 == 0, half).otherwise(line).alias("value")
    ).write.text(path)
    good, rejected = readers.read_jsonl_tolerant(spark, path)
    fields = good.select(F.lit("good").alias("kind"), "text", "label", "source")
    return fields.unionByName(rejected.select(F.lit("rejected").alias("kind"), "line"), allowMissingColumns=True)


def written_splits(spark, sf):
    path = scratch_path(spark, "processed")
    corpus = prepare.prepare_corpus(b.labelled(spark, sf), "doc_id")
    writers.write_splits(corpus, path)
    return path


SPLIT_ROWS = f"""WITH {b.PREPARED}, {b.split_sql('prepared', 'doc_id', 'label', 0.2, 0.2)}
    SELECT split, label, source, clean_text AS text, text_length, word_count FROM split_rows"""


@query("read_processed_splits", SPLIT_ROWS)
def _read_splits(spark, sf):
    return readers.read_processed_splits(spark, f"{written_splits(spark, sf)}/json")


@query("write_splits", SPLIT_ROWS)
def _write_splits(spark, sf):
    """The CSV side of the sink, read back."""
    schema = "clean_text string, label string, source string, text_length int, word_count int, split string"
    path = f"{written_splits(spark, sf)}/csv"
    rows = spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)
    return rows.withColumnRenamed("clean_text", "text")


@query(
    "append_records",
    "SELECT doc_id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark",
)
def _append(spark, sf):
    path = scratch_path(spark, "appended")
    writers.append_records(table(spark, sf, "documents").select("doc_id", "text"), path)
    writers.append_records(
        table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text"), path
    )
    return spark.read.schema("doc_id long, text string").json(path)


COMMITS = 12


def appended(spark, sf):
    """Documents in many small commits, some of them sent twice; then the benchmark as one more.

    Gives the table, and the version that holds the documents alone.
    """
    docs = table(spark, sf, "documents").select("doc_id", "text")
    made = SnapshotTable(spark, scratch_path(spark, "snapshots"), docs.schema)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(COMMITS))
    for batch in range(COMMITS):
        for _ in range(1 + batch % 2):
            made.append(docs.filter(place == batch), "documents", batch)
    before = made.manifest().version
    made.append(table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text"), "benchmark", 0)
    return made, before


@query("append_snapshots", "SELECT doc_id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def _snapshots(spark, sf):
    return appended(spark, sf)[0].read()


@query("snapshot_as_of", "SELECT doc_id, text FROM documents")
def _as_of(spark, sf):
    """The version before the last commit."""
    made, before = appended(spark, sf)
    return made.read(before)


@query(
    "write_run_stats",
    f"""WITH {b.PREPARED}, {b.split_sql('prepared', 'doc_id', 'label', 0.2, 0.2)} SELECT count(*) AS total_texts,
      count(*) FILTER (split = 'train') AS train_size, count(*) FILTER (split = 'val') AS val_size,
      count(*) FILTER (split = 'test') AS test_size,
      count(*) FILTER (label = 'human') AS human_texts, count(*) FILTER (label = 'ai') AS ai_texts,
      round(avg(text_length), 6) AS avg_text_length, round(avg(word_count), 6) AS avg_word_count,
      true AS dated FROM split_rows""",
)
def _run_stats(spark, sf):
    """All statistics of the prepared corpus, after the round trip."""
    path = scratch_path(spark, "stats")
    writers.write_run_stats(profile.corpus_stats(prepare.prepare_corpus(b.labelled(spark, sf), "doc_id")), path)
    counts = ("total_texts", "train_size", "val_size", "test_size", "human_texts", "ai_texts")
    averages = ("avg_text_length", "avg_word_count")
    fields = ", ".join([*(f"{c} long" for c in counts), *(f"{c} double" for c in averages), "preprocessing_date timestamp"])
    return spark.read.schema(fields).json(path).select(
        *counts, *(F.round(c, 6).alias(c) for c in averages), F.col("preprocessing_date").isNotNull().alias("dated")
    )


@query(
    "write_metrics",
    f"""WITH {b.SCORED}, c AS (SELECT model, avg((label = predicted)::INT) AS accuracy,
      avg(score) AS mean_score FROM scored GROUP BY model)
    SELECT model, round(accuracy, 4) AS accuracy, round(mean_score, 4) AS mean_score FROM c""",
)
def _write_metrics(spark, sf):
    path = scratch_path(spark, "metrics")
    right = (F.col("label") == F.col("predicted")).cast("int")
    writers.write_metrics(
        b.scored(spark, sf).groupBy("model").agg(
            F.avg(right).alias("accuracy"), F.avg("score").alias("mean_score")
        ),
        path,
    )
    schema = "model string, accuracy double, mean_score double"
    return spark.read.schema(schema).option("header", True).csv(f"{path}/csv")


@query(
    "read_text_lines",
    f"""WITH l AS (SELECT doc_id, {b.squash('text')} AS text FROM documents)
    SELECT row_number() OVER (ORDER BY doc_id) - 1 AS text_id, text FROM l WHERE text <> ''""",
)
def _lines(spark, sf):
    """One document per line; every second line is followed by a blank one."""
    from quillspark.functions.text import squash

    path = scratch_path(spark, "lines")
    flat = squash(F.col("text"))
    blank = F.when(F.col("doc_id") % 2 == 0, F.lit("\n   ")).otherwise(F.lit(""))
    lines = table(spark, sf, "documents").select("doc_id", F.concat(flat, blank).alias("value"))
    # files in id order, as many as there are ranges
    lines.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    return readers.read_text_lines(spark, path)


@query("read_whole_text", "SELECT doc_id, text FROM documents")
def _whole(spark, sf):
    """Files of up to 500 documents each come back as single texts, which are taken apart again."""
    path = scratch_path(spark, "whole")
    marked = F.concat(F.lit("\x1e"), F.col("doc_id").cast("string"), F.lit("\x1f"), "text", F.lit("\x1e"))
    table(spark, sf, "documents").select(marked.alias("value")).write.option("maxRecordsPerFile", 500).text(path)
    entry = F.explode(F.regexp_extract_all("text", F.lit("\x1e([0-9]+\x1f[^\x1e]*)\x1e"), F.lit(1))).alias("entry")
    entries = readers.read_whole_text(spark, path).select(entry)
    at = F.instr("entry", "\x1f")
    return entries.select(
        F.expr("substr(entry, 1, instr(entry, '\x1f') - 1)").cast("long").alias("doc_id"),
        F.col("entry").substr(at + 1, F.length("entry")).alias("text"),
    )




def as_feed(batches):
    """A partition's entries as one feed, so that a written file is one page."""
    yield pa.RecordBatch.from_pydict({"value": ['<feed xmlns="http://www.w3.org/2005/Atom">']})
    yield from batches
    yield pa.RecordBatch.from_pydict({"value": ["</feed>"]})


def feed_pages(spark, sf):
    """Documents as Atom feed files of a hundred entries each."""
    path = scratch_path(spark, "feed")

    def safe(c):
        for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(char), F.lit(entity))
        return c

    title = F.split_part("text", F.lit("\n"), F.lit(1))
    rest = F.expr("substring(text, length(split_part(text, '\n', 1)) + 2)")
    entry = F.concat(
        F.lit("<entry><id>http://feed.example.org/abs/"), F.col("source"), F.lit("/"),
        F.col("doc_id").cast("string"), F.lit("v1</id><title>"), safe(title), F.lit("</title><summary>"),
        safe(rest), F.lit("</summary><published>2024-01-01T00:00:00Z</published><author><name>"),
        F.col("source"), F.lit("</name></author><author><name>"), F.col("lang"),
        F.lit('</name></author><category term="'), F.col("lang"), F.lit('"/><category term="x"/></entry>'),
    )
    entries = table(spark, sf, "documents").select(entry.alias("value"))
    entries.mapInArrow(as_feed, "value string").write.text(path)
    return path


@query(
    "parse_feed_xml",
    f"""WITH t AS (SELECT doc_id, source, lang, {b.strip("string_split(text, chr(10))[1]")} AS title,
      {b.strip("substr(text, length(string_split(text, chr(10))[1]) + 2)")} AS abstract FROM documents)
    SELECT source || '/' || doc_id || 'v1' AS arxiv_id, title, abstract, source || '|' || lang AS authors,
      lang || '|x' AS categories, '2024-01-01T00:00:00Z' AS published FROM t WHERE title <> '' AND abstract <> ''""",
)
def _feed(spark, sf):
    papers = readers.parse_feed_xml(spark, feed_pages(spark, sf))
    return papers.select(
        "arxiv_id", "title", "abstract", F.array_join("authors", "|").alias("authors"),
        F.array_join("categories", "|").alias("categories"), "published",
    )


@query(
    "read_processed_ids",
    """SELECT id, count(*) AS kinds FROM (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS id, 'c' AS k FROM labels
       UNION SELECT DISTINCT CAST(doc_id AS VARCHAR), 'd' FROM documents) GROUP BY id""",
)
def _ids(spark, sf):
    """Ids from a checkpoint file and from a stored corpus."""
    listed, corpus = scratch_path(spark, "ids"), scratch_path(spark, "human")
    table(spark, sf, "labels").select(F.col("doc_id").cast("string")).write.text(listed)
    human_records(spark, sf).write.json(corpus)
    both = readers.read_processed_ids(spark, listed).unionByName(
        readers.read_processed_ids(spark, corpus, "corpus")
    )
    return both.groupBy("id").agg(F.count(F.lit(1)).alias("kinds"))
