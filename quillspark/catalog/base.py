"""Registry, shared inputs, and shared SQL fragments (DuckDB dialect)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.functions.style import distinct_word_share
from quillspark.functions.text import clean_generated
from quillspark.operators.corpus import clean_nonempty
from quillspark.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_WIDER = {"int": "bigint", "smallint": "bigint", "tinyint": "bigint", "float": "double"}


def query(name: str, oracle: str | None = None):
    """Register a query; small number types widen so that both engines agree on them."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = build(spark, sf_dir)
            wide = {c: F.col(c).cast(_WIDER[t]) for c, t in out.dtypes if t in _WIDER}
            return out.withColumns(wide) if wide else out

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


TEXT_TABLES = ("documents", "conversations")

# --- inputs --------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a class: quality 1 stands for human, 0 for ai."""
    label = F.when(F.col("quality") == 1, "human").otherwise("ai")
    rank = F.when(F.col("quality") == 1, 0).otherwise(1)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return docs.join(
        table(spark, sf_dir, "labels").select(
            "doc_id", label.alias("label"), rank.alias("corpus_rank")
        ),
        "doc_id",
    )


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return clean_nonempty(docs)


def clean_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_nonempty(labelled(spark, sf_dir))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn as original, the assistant turn after it as generated text."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("original")
    )
    answered = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), clean_generated(F.col("text")).alias("generated")
    )
    title = F.element_at(F.split("original", r"[.!?]"), 1)
    return asked.join(answered, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("pair_id"),
        F.trim(title).alias("title"),
        "original",
        "generated",
    )


SCORERS = ("length", "punctuation", "variety")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rule-based scores per labelled document, as a long table."""
    docs = clean_labelled(spark, sf_dir)
    text = F.col("clean_text")
    marks = F.regexp_count(text, F.lit(r"[.,;:!?\-()]")) * 20.0 / F.length(text)
    scores = F.array(
        F.struct(F.lit("length").alias("model"), F.least(F.lit(1.0), F.length(text) / 3000).alias("s")),
        F.struct(F.lit("punctuation").alias("model"), F.least(F.lit(1.0), marks).alias("s")),
        F.struct(F.lit("variety").alias("model"), distinct_word_share(text).alias("s")),
    )
    long = docs.select(
        "doc_id", "lang", "source", F.when(F.col("label") == "ai", 1).otherwise(0).alias("label"),
        F.inline(scores),
    )
    return long.select(
        "model", "doc_id", "lang", "source", "label", F.round("s", 4).alias("score")
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def judged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log read as a prediction log: what happened against what a value rule said."""
    events = table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        "ts",
        F.col("event_type").isin("error", "purchase").cast("int").alias("label"),
        (F.col("value") > 10).cast("int").alias("predicted"),
    )


# --- SQL fragments -------------------------------------------------------------

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def clean(x: str) -> str:
    flat = squash(f"coalesce({x}, '')")
    return (
        f"CASE WHEN length({flat}) BETWEEN 50 AND 5000 THEN "
        + squash(rf"regexp_replace({flat}, '[^\p{{L}}\p{{N}}_ .,;:!?()\-]', ' ', 'g')")
        + " ELSE '' END"
    )


def words(x: str) -> str:
    return f"list_filter(string_split({squash(x)}, ' '), lambda w: w <> '')"


def tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def sentences(x: str) -> str:
    pieces = f"regexp_split_to_array({x}, '[.!?]+')"
    return f"list_filter(list_transform({pieces}, lambda s: {strip('s')}), lambda s: s <> '')"


def draw(row_id: str, step: str, seed: int = 42) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || {row_id} || ':{step}'), 1, 7) AS BIGINT)"


def order_key(row_id: str, seed: int = 42) -> str:
    return f"md5('{seed}:' || {row_id})"


def clean_generated_sql(x: str) -> str:
    for pattern in fv.GENERATED_NOISE:
        p = pattern.replace("{S}", SPACE).replace("{L}", r"[^\n]*").replace("'", "''")
        x = f"regexp_replace({x}, '(?im){p}', '', 'g')"
    return x


LABELLED = """labelled AS (
  SELECT d.doc_id, d.text, d.lang, d.source,
         CASE WHEN l.quality = 1 THEN 'human' ELSE 'ai' END AS label,
         CASE WHEN l.quality = 1 THEN 0 ELSE 1 END AS corpus_rank
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

CLEAN_LABELLED = f"""{LABELLED},
clean_labelled AS (
  SELECT * FROM (SELECT *, {clean('text')} AS clean_text FROM labelled) WHERE clean_text <> '')"""

PREPARED = f"""{CLEAN_LABELLED},
prepared AS (
  SELECT *, length(clean_text) AS text_length, len({words('clean_text')}) AS word_count
  FROM (SELECT *, row_number() OVER (PARTITION BY clean_text ORDER BY corpus_rank, doc_id) AS rn
        FROM clean_labelled) WHERE rn = 1)"""

CLEAN_DOCS = f"""clean_docs AS (
  SELECT * FROM (SELECT doc_id, lang, source, {clean('text')} AS clean_text FROM documents)
  WHERE clean_text <> '')"""

PAIRS = f"""raw_pairs AS (
  SELECT u.conv_id || '-' || u.turn AS pair_id, u.text AS original,
         {clean_generated_sql('a.text')} AS stripped
  FROM conversations u JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
squashed AS (SELECT *, {squash('stripped')} AS s1 FROM raw_pairs),
unquoted AS (
  SELECT *, CASE WHEN starts_with(s1, '"') AND ends_with(s1, '"')
                 THEN substr(s1, 2, greatest(length(s1) - 2, 0)) ELSE s1 END AS s2 FROM squashed),
pairs AS (
  SELECT pair_id, trim(regexp_split_to_array(original, '[.!?]')[1]) AS title, original,
         trim(CASE WHEN starts_with(s2, '''') AND ends_with(s2, '''')
                   THEN substr(s2, 2, greatest(length(s2) - 2, 0)) ELSE s2 END) AS generated
  FROM unquoted)"""

SCORED = f"""{CLEAN_LABELLED},
bits AS (
  SELECT doc_id, lang, source, CASE WHEN label = 'ai' THEN 1 ELSE 0 END AS label,
         least(1.0::DOUBLE, length(clean_text) / 3000.0::DOUBLE) AS s_length,
         least(1.0::DOUBLE, len(regexp_extract_all(clean_text, '[.,;:!?\\-()]')) * 20.0::DOUBLE
               / length(clean_text)) AS s_marks,
         CAST(len(list_distinct({words('lower(clean_text)')})) AS DOUBLE)
               / len({words('clean_text')}) AS s_variety
  FROM clean_labelled),
scored AS (
  SELECT model, doc_id, lang, source, label, round(s, 4) AS score,
         CASE WHEN round(s, 4) >= 0.5 THEN 1 ELSE 0 END AS predicted
  FROM (SELECT 'length' AS model, doc_id, lang, source, label, s_length AS s FROM bits
        UNION ALL SELECT 'punctuation', doc_id, lang, source, label, s_marks FROM bits
        UNION ALL SELECT 'variety', doc_id, lang, source, label, s_variety FROM bits))"""


def split_sql(source: str, row_id: str, strata: str, test: float, val: float) -> str:
    """A split by full sort: rank in digest order, then compare with the quotas."""
    return f"""ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY {order_key(row_id)}, {row_id}) AS rk,
         count(*) OVER (PARTITION BY {strata}) AS n FROM {source}),
split_rows AS (
  SELECT *, CASE WHEN rk <= round(n * {test}::DOUBLE) THEN 'test'
                 WHEN rk <= round(n * {test}::DOUBLE) + round(n * {val}::DOUBLE) THEN 'val'
                 ELSE 'train' END AS split FROM ranked)"""
