"""Building, filtering, splitting and profiling the corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.catalog import base as b
from quillspark.catalog.base import query, table
from quillspark.catalog.text_queries import titled
from quillspark.functions import generation, quality, tokens
from quillspark.functions.text import sentences
from quillspark.operators import corpus, permute, profile, splits
from quillspark.plans import prepare
from quillspark.session import stored

# --- projections and filters -----------------------------------------------------


@query(
    "normalise_rows",
    """SELECT text, 'human' AS label, source, CAST(doc_id AS VARCHAR) AS id FROM documents
       UNION ALL SELECT text, 'ai', 'generated', conv_id || '-' || turn
       FROM conversations WHERE role = 'assistant'""",
)
def _normalise(spark, sf):
    docs = table(spark, sf, "documents").select(
        "text", "source", F.struct(F.col("doc_id").cast("string").alias("arxiv_id")).alias("metadata")
    )
    answers = table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    answers = answers.select("text", F.concat_ws("-", "conv_id", "turn").alias("original_id"))
    return corpus.normalise_rows(docs, "human").unionByName(corpus.normalise_rows(answers, "ai"))


@query(
    "union_corpora",
    """SELECT doc_id AS id, text, 'human' AS label, 0::BIGINT AS corpus_rank FROM documents
       UNION ALL SELECT item_id, text, 'ai', 1::BIGINT FROM benchmark""",
)
def _union(spark, sf):
    human = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), "text", F.lit("human").alias("label")
    )
    ai = table(spark, sf, "benchmark").select(
        F.col("item_id").alias("id"), "text", F.lit("ai").alias("label")
    )
    return corpus.union_corpora(human, ai)


TITLED_SQL = """titled AS (
  SELECT doc_id, string_split(text, chr(10))[1] AS title,
         substr(text, length(string_split(text, chr(10))[1]) + 2) AS abstract, text FROM documents)"""


@query(
    "filter_complete_records",
    f"""WITH {TITLED_SQL} SELECT doc_id, title, abstract FROM titled
        WHERE {b.strip('title')} <> '' AND {b.strip('abstract')} <> ''""",
)
def _complete(spark, sf):
    return corpus.filter_complete_records(titled(spark, sf).select("doc_id", "title", "abstract"))


def _filter_query(name, where, function):
    @query(name, f"SELECT doc_id FROM documents WHERE {where}")
    def run(spark, sf):
        return function(table(spark, sf, "documents").select("doc_id", "text")).select("doc_id")


_filter_query("filter_min_record_len", "length(text) >= 200", corpus.filter_min_record_len)
_filter_query("filter_sample_len", "length(text) > 100", corpus.filter_sample_len)
_filter_query(
    "filter_generation_input", f"length({b.strip('text')}) >= 50", corpus.filter_generation_input
)
_filter_query(
    "filter_length_band",
    f"length({b.squash('text')}) BETWEEN 50 AND 5000",
    corpus.filter_length_band,
)
_filter_query(
    "filter_nonempty_clean",
    f"{b.clean('text')} <> ''",
    lambda df: corpus.filter_nonempty_clean(corpus.with_clean_text(df)),
)
_filter_query(
    "filter_scorable",
    "length("
    + b.squash(rf"regexp_replace({b.squash('text')}, '[^\p{{L}}\p{{N}}_ .,;:!?()\-]', ' ', 'g')")
    + ") >= 10",
    lambda df: corpus.filter_scorable(
        df.withColumn("clean_text", generation_clean(F.col("text")))
    ),
)


def generation_clean(text):
    from quillspark.functions.text import clean_for_scoring

    return clean_for_scoring(text)


@query(
    "cap_total",
    "SELECT doc_id, n_chars FROM documents WHERE length(text) >= 200 ORDER BY doc_id LIMIT 500",
)
def _cap(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "text")
    return corpus.cap_total(corpus.filter_min_record_len(docs), ["doc_id"], 500).drop("text")


@query(
    "corpus_filter",
    f"""SELECT doc_id, len({b.words('text')}) AS words FROM documents
        WHERE lang = 'en' AND len({b.words('text')}) BETWEEN 100 AND 500""",
)
def _corpus_filter(spark, sf):
    from quillspark.functions.text import word_count

    docs = prepare.corpus_filter(table(spark, sf, "documents"))
    return docs.select("doc_id", word_count(F.col("text")).alias("words"))


# --- joins and set operations ----------------------------------------------------


@query(
    "antijoin_new_ids",
    """SELECT min(event_id) AS event_id, user_id FROM events
       WHERE user_id NOT IN (SELECT doc_id FROM labels) GROUP BY user_id""",
)
def _antijoin(spark, sf):
    incoming = table(spark, sf, "events").select("event_id", "user_id")
    known = table(spark, sf, "labels").select(F.col("doc_id").alias("user_id"))
    return corpus.antijoin_new_ids(incoming, known, "user_id", ["event_id"])


@query(
    "pair_original_generated",
    """SELECT u.conv_id || '-' || u.turn AS original_id, u.text AS original, a.text AS generated
       FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
       WHERE u.role = 'user' AND a.role = 'assistant'""",
)
def _pair(spark, sf):
    turns = table(spark, sf, "conversations")
    originals = turns.filter(F.col("role") == "user").select(
        F.concat_ws("-", "conv_id", "turn").alias("original_id"), F.col("text").alias("original")
    )
    generated = turns.filter(F.col("role") == "assistant").select(
        F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("original_id"),
        F.col("text").alias("generated"),
    )
    return corpus.pair_original_generated(originals, generated, "original_id")


def _keyword_sets_sql(column: str) -> str:
    from quillspark.catalog.text_queries import keywords_sql

    return f"(SELECT pair_id, list(w) AS k FROM {keywords_sql('pairs', 'pair_id', column, 10)} GROUP BY pair_id)"


@query(
    "keyword_overlap",
    f"""WITH {b.PAIRS}
    SELECT p.pair_id, round(CASE WHEN o.k IS NULL THEN NULL ELSE
      len(list_intersect(o.k, coalesce(g.k, []))) / len(o.k)::DOUBLE END, 6) AS overlap
    FROM pairs p LEFT JOIN {_keyword_sets_sql('original')} o ON p.pair_id = o.pair_id
    LEFT JOIN {_keyword_sets_sql('generated')} g ON p.pair_id = g.pair_id""",
)
def _overlap(spark, sf):
    share = quality.keyword_overlap(
        tokens.keywords(F.col("original")), tokens.keywords(F.col("generated"))
    )
    return b.pairs(spark, sf).select("pair_id", F.round(share, 6).alias("overlap"))


@query(
    "distinct_sentences",
    f"""WITH s AS (SELECT doc_id, {b.sentences('text')} AS s FROM documents)
    SELECT doc_id, len(s) AS sentences, len(list_distinct(s)) AS distinct_sentences,
           round(CASE WHEN len(s) = 0 THEN NULL ELSE len(list_distinct(s))::DOUBLE / len(s) END, 6)
             AS distinct_share FROM s""",
)
def _distinct_sentences(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.size(sentences(F.col("text"))).alias("sentences"),
        F.size(F.array_distinct(sentences(F.col("text")))).alias("distinct_sentences"),
        F.round(quality.distinct_sentence_share(F.col("text")), 6).alias("distinct_share"),
    )


@query(
    "dedupe_keep_first",
    f"""WITH {b.CLEAN_DOCS} SELECT doc_id, lang, clean_text FROM (SELECT *, row_number() OVER (PARTITION BY clean_text
        ORDER BY doc_id) AS rn FROM clean_docs) WHERE rn = 1""",
)
def _dedupe(spark, sf):
    kept = corpus.dedupe_keep_first(b.clean_documents(spark, sf), ["doc_id"])
    return kept.select("doc_id", "lang", "clean_text")


@query(
    "mixed_documents",
    f"""WITH {b.PAIRS},
    p AS (SELECT pair_id, string_split(original, '. ') AS h, string_split(generated, '. ') AS g FROM pairs)
    SELECT pair_id, array_to_string(list_concat(h[1:(len(h) + 1) // 2], g[len(g) // 2 + 1:]), '. ') AS mixed
    FROM p""",
)
def _mixed(spark, sf):
    mixed = generation.mixed_document(F.col("original"), F.col("generated"))
    return b.pairs(spark, sf).select("pair_id", mixed.alias("mixed"))


# --- splits and samples ----------------------------------------------------------


def keys(spark, sf):
    """Ids and strata only: what a split needs to see."""
    return stored(b.clean_labelled(spark, sf).select("doc_id", "label", "lang", "source"), "keys")


SPLIT = b.split_sql("clean_labelled", "doc_id", "label", 0.2, 0.2)


@query("stratified_split", f"WITH {b.CLEAN_LABELLED}, {SPLIT} SELECT doc_id, label, split FROM split_rows")
def _split(spark, sf):
    return splits.stratified_split(keys(spark, sf), "doc_id", ["label"]).select("doc_id", "label", "split")


@query(
    "stratified_holdout",
    f"""WITH {b.CLEAN_LABELLED}, {b.split_sql('clean_labelled', 'doc_id', 'label', 0.2, 0.0)}
        SELECT doc_id, label, split FROM split_rows""",
)
def _holdout(spark, sf):
    return splits.stratified_holdout(keys(spark, sf), "doc_id", ["label"]).select("doc_id", "label", "split")


FOLD_SQL = "(SELECT count(*) FROM range(1, 5) t(j) WHERE rk > round(n * j / 5.0::DOUBLE))"


@query(
    "stratified_kfold",
    f"""WITH {b.CLEAN_LABELLED}, {SPLIT}
        SELECT doc_id, label, (rk > round(n * 1 / 5.0::DOUBLE))::BIGINT + (rk > round(n * 2 / 5.0::DOUBLE))::BIGINT
          + (rk > round(n * 3 / 5.0::DOUBLE))::BIGINT + (rk > round(n * 4 / 5.0::DOUBLE))::BIGINT AS fold
        FROM split_rows""",
)
def _kfold(spark, sf):
    return splits.stratified_kfold(keys(spark, sf), "doc_id", ["label"]).select("doc_id", "label", "fold")


@query(
    "domain_stratified_split",
    f"""WITH {b.CLEAN_LABELLED}, {b.split_sql('clean_labelled', 'doc_id', 'label, lang, source', 0.15, 0.15)}
        SELECT doc_id, label, lang, source, split FROM split_rows""",
)
def _domain_split(spark, sf):
    strata = ["label", "lang", "source"]
    return splits.stratified_split(keys(spark, sf), "doc_id", strata, 0.15, 0.15).select(
        "doc_id", *strata, "split"
    )


@query(
    "balanced_sample",
    f"""WITH {b.CLEAN_LABELLED}, {SPLIT}
        SELECT doc_id, label FROM (SELECT *, min(n) OVER () AS least FROM split_rows)
        WHERE rk <= least(1000, least)""",
)
def _balanced(spark, sf):
    return splits.balanced_sample(keys(spark, sf), "doc_id", "label", 1000).select("doc_id", "label")


DOMAIN_QUOTAS = {"en": 0.25, "fr": 0.25, "de": 0.25, "es": 0.15}


@query(
    "domain_quota_sample",
    f"""SELECT doc_id, lang FROM (SELECT doc_id, lang,
          row_number() OVER (PARTITION BY lang ORDER BY {b.order_key('doc_id')}, doc_id) AS rk
        FROM documents) WHERE rk <= CASE lang WHEN 'en' THEN 100 WHEN 'fr' THEN 100 WHEN 'de' THEN 100
          WHEN 'es' THEN 60 ELSE 0 END""",
)
def _quota(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return splits.domain_quota_sample(docs, "doc_id", "lang", DOMAIN_QUOTAS, 400)


@query(
    "shuffle_seeded",
    f"SELECT doc_id, {b.order_key('doc_id')} AS shuffle_key FROM documents ORDER BY 2, 1",
)
def _shuffle(spark, sf):
    return splits.shuffle_seeded(table(spark, sf, "documents").select("doc_id"), "doc_id")


def permuted_sql(seed: int = 42) -> str:
    """Places by the same rounds; numbers whose place is too high go round again."""

    def rounds(source: str) -> str:
        inner = f"SELECT * REPLACE (v % a AS x, v // a AS y) FROM {source}"
        for i, (p, q, r, s) in enumerate(permute.factors(seed)):
            half, other, side = ("y", "x", "b") if i % 2 else ("x", "y", "a")
            digest = f"(({other} * {p} + {q}) % {permute.FIRST_PRIME} * {r} + {s}) % {permute.SECOND_PRIME}"
            inner = f"SELECT * REPLACE (({half} + {digest}) % {side} AS {half}) FROM ({inner})"
        return f"SELECT doc_id, n, a, b, y * a + x AS v, x, y FROM ({inner})"

    return f"""WITH RECURSIVE size AS (SELECT count(*) AS n, ceil(sqrt(count(*)::DOUBLE))::BIGINT AS root FROM documents),
    sides AS (SELECT n, unnest(range(root, root + 1000 + 4 * floor(sqrt(root))::BIGINT)) AS a FROM size),
    best AS (SELECT n, a, (n + a - 1) // a AS b FROM sides ORDER BY (n + a - 1) // a * a - n, a LIMIT 1),
    start AS (SELECT doc_id, n, a, b, row_number() OVER (ORDER BY doc_id) - 1 AS v, 0::BIGINT AS x, 0::BIGINT AS y
      FROM documents, best),
    walk AS ({rounds('start')} UNION ALL {rounds('(SELECT * FROM walk WHERE v >= n)')})
    SELECT doc_id, v AS place FROM walk WHERE v < n"""


@query("shuffle_places", permuted_sql())
def _places(spark, sf):
    return permute.shuffle_places(table(spark, sf, "documents").select("doc_id"), ["doc_id"])


@query(
    "assign_provider",
    f"""SELECT event_id, CASE WHEN rk <= round(n * 0.7::DOUBLE) THEN 'groq'
          WHEN rk <= round(n * 0.9::DOUBLE) THEN 'firework' ELSE 'openrouter' END AS provider
        FROM (SELECT event_id, row_number() OVER (ORDER BY {b.order_key('event_id')}, event_id) AS rk,
              count(*) OVER () AS n FROM events)""",
)
def _assign(spark, sf):
    return splits.assign_provider(table(spark, sf, "events").select("event_id"), "event_id")


# --- profiles --------------------------------------------------------------------


def prepared(spark, sf):
    return prepare.clean_corpus(b.labelled(spark, sf), "doc_id")


@query(
    "stats_by_label",
    f"""WITH {b.PREPARED}
    SELECT label, count(*) AS texts,
      round_even(avg(text_length), 2) AS text_length_mean,
      round_even(stddev_samp(text_length), 2) AS text_length_std,
      round_even(avg(word_count), 2) AS word_count_mean,
      round_even(stddev_samp(word_count), 2) AS word_count_std FROM prepared GROUP BY label""",
)
def _stats(spark, sf):
    """Load, clean, deduplicate and profile: the whole preparation in one plan."""
    return profile.stats_by_label(prepared(spark, sf))


@query(
    "corpus_stats",
    f"""WITH {b.PREPARED}, {b.split_sql('prepared', 'doc_id', 'label', 0.2, 0.2)}
    SELECT count(*) AS total_texts, count(*) FILTER (split = 'train') AS train_size,
      count(*) FILTER (split = 'val') AS val_size, count(*) FILTER (split = 'test') AS test_size,
      count(*) FILTER (label = 'human') AS human_texts, count(*) FILTER (label = 'ai') AS ai_texts,
      round(avg(text_length), 6) AS avg_text_length, round(avg(word_count), 6) AS avg_word_count
    FROM split_rows""",
)
def _corpus_stats(spark, sf):
    out = profile.corpus_stats(prepare.prepare_corpus(b.labelled(spark, sf), "doc_id"))
    return out.withColumns(
        {c: F.round(c, 6) for c in ("avg_text_length", "avg_word_count")}
    )


@query(
    "class_shares",
    f"""WITH {b.LABELLED} SELECT label, count(*) AS texts,
        round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 4) AS percent FROM labelled GROUP BY label""",
)
def _class_shares(spark, sf):
    return profile.class_shares(b.labelled(spark, sf))


@query(
    "cleaning_report",
    f"""WITH c AS (SELECT {b.clean('text')} AS c FROM documents)
    SELECT count(*) AS original_texts, count(*) FILTER (c <> '') AS nonempty_texts,
      count(*) FILTER (c <> '') - count(DISTINCT c) FILTER (c <> '') AS duplicates_removed,
      count(DISTINCT c) FILTER (c <> '') AS final_texts FROM c""",
)
def _cleaning_report(spark, sf):
    return corpus.cleaning_report(table(spark, sf, "documents"))


@query(
    "split_label_counts",
    f"""WITH {b.CLEAN_LABELLED}, {SPLIT}
    SELECT split, count(*) FILTER (label = 'human') AS human, count(*) FILTER (label = 'ai') AS ai
    FROM split_rows GROUP BY split""",
)
def _split_counts(spark, sf):
    return profile.split_label_counts(
        splits.stratified_split(keys(spark, sf), "doc_id", ["label"])
    )


@query(
    "balance_report",
    f"""WITH {b.LABELLED}
    SELECT count(*) AS total_samples, count(*) FILTER (label = 'human') AS human_samples,
      count(*) FILTER (label = 'ai') AS ai_samples,
      round(count(*) FILTER (label = 'human') / count(*) FILTER (label = 'ai')::DOUBLE, 6) AS balance_ratio,
      round(avg(length(text)), 6) AS avg_text_length FROM labelled WHERE length(text) > 100""",
)
def _balance(spark, sf):
    return profile.balance_report(corpus.filter_sample_len(b.labelled(spark, sf)))


@query(
    "length_histogram",
    f"""WITH {b.PREPARED},
    r AS (SELECT label, min(text_length) AS low, max(text_length) AS high FROM prepared GROUP BY label),
    j AS (SELECT p.label, p.text_length AS v, low, high FROM prepared p JOIN r ON p.label = r.label),
    h AS (SELECT label, low, high, CASE WHEN high = low THEN 25 ELSE
            least(floor((v - low) * 50 / (high - low)::DOUBLE), 49) END::BIGINT AS bin FROM j)
    SELECT label, bin, round(low + bin * ((high - low) / 50.0::DOUBLE), 6) AS bin_start, count(*) AS texts
    FROM h GROUP BY ALL""",
)
def _histogram(spark, sf):
    return profile.length_histogram(stored(prepared(spark, sf).select("label", "text_length"), "lengths"))
