"""Vocabularies, TF-IDF, n-gram counts and the SQL-form models."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.catalog import base as b
from quillspark.catalog.base import query
from quillspark.functions.text import let
from quillspark.functions.tokens import bigrams, term_counts
from quillspark.operators import bayes, vocabulary
from quillspark.operators.splits import stratified_holdout
from quillspark.plans.features import KEPT as KEPT_WORDS
from quillspark.plans.features import tfidf_table, tokenised
from quillspark.session import stored

KEPT = f"list_filter({b.tokens('clean_text')}, lambda t: t NOT IN ({b.quoted(fv.ENGLISH_STOP_WORDS)}))"


def terms_sql(source: str, bigrams: bool = True) -> str:
    """``terms (doc_id, label, term, n)`` from ``source``."""
    pairs = (
        "UNION ALL SELECT doc_id, label, term || ' ' || following FROM follow WHERE following IS NOT NULL"
        if bigrams
        else ""
    )
    return f"""kept AS (SELECT doc_id, label, {KEPT} AS k FROM {source}),
spread AS (SELECT doc_id, label, unnest(k) AS term, generate_subscripts(k, 1) AS pos FROM kept),
follow AS (SELECT *, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM spread),
terms AS (SELECT doc_id, label, term, count(*) AS n FROM (SELECT doc_id, label, term FROM follow {pairs})
          GROUP BY ALL)"""


DOCS = f"{b.CLEAN_DOCS}, docs AS (SELECT *, '' AS label FROM clean_docs)"
FREQ = "freq AS (SELECT term, sum(n)::BIGINT AS corpus_count, count(*) AS doc_freq FROM terms GROUP BY term)"


def vocab_sql(size: int, source: str, min_df: int = 1, max_df: float = 1.0) -> str:
    return f"""vocab AS (SELECT * FROM freq WHERE doc_freq >= {min_df}
      AND doc_freq <= {max_df}::DOUBLE * (SELECT count(*) FROM {source})
      ORDER BY corpus_count DESC, term LIMIT {size})"""


def tfidf_sql(source: str) -> str:
    return f"""raw AS (SELECT t.doc_id, t.label, t.term,
  t.n * (ln((1 + (SELECT count(*) FROM {source}))::DOUBLE / (1 + v.doc_freq)) + 1) AS raw
  FROM terms t JOIN vocab v ON t.term = v.term),
weights AS (SELECT doc_id, label, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def documents(spark, sf):
    """Clean texts written once: the term pass and the document count both read them."""
    return stored(b.clean_documents(spark, sf).select("doc_id", "clean_text"), "clean")


def doc_terms(docs, keep=(), bigrams=True):
    return vocabulary.document_terms(docs, "doc_id", "clean_text", bigrams, keep=keep)


@query("term_doc_freq", f"WITH {DOCS}, {terms_sql('docs')}, {FREQ} SELECT * FROM freq")
def _freq(spark, sf):
    return vocabulary.term_doc_freq(doc_terms(b.clean_documents(spark, sf)))


@query(
    "vocabulary",
    f"WITH {DOCS}, {terms_sql('docs')}, {FREQ}, {vocab_sql(3000, 'docs', 2, 0.95)} SELECT * FROM vocab",
)
def _vocabulary(spark, sf):
    return fitted_vocabulary(*tokenised_documents(spark, sf))


def tokenised_documents(spark, sf):
    """The documents' kept words, written once because several steps read them, and the corpus size."""
    tokens = tokenised(b.clean_documents(spark, sf).select("doc_id", "clean_text"))
    return tokens, tokens.count()


def fitted_vocabulary(tokens, n_docs):
    limits = (3000, 2, 0.95)
    return vocabulary.vocabulary(vocabulary.candidate_frequencies(tokens, KEPT_WORDS, [limits]), n_docs, *limits)


@query(
    "vocab_lookup",
    f"""WITH {DOCS}, {terms_sql('docs')}, {FREQ}, {vocab_sql(3000, 'docs', 2, 0.95)}
    SELECT doc_id, t.term, n FROM terms t JOIN vocab v ON t.term = v.term""",
)
def _lookup(spark, sf):
    tokens, n_docs = tokenised_documents(spark, sf)
    both = let(F.col(KEPT_WORDS), lambda t: term_counts(F.concat(t, bigrams(t))))
    terms = tokens.select("doc_id", F.inline(both)).withColumn("n", F.col("n").cast("bigint"))
    return vocabulary.vocab_lookup(terms, fitted_vocabulary(tokens, n_docs)).select("doc_id", "term", "n")


def weights(spark, sf):
    tokens, n_docs = tokenised_documents(spark, sf)
    return tfidf_table(tokens, "doc_id", "", fitted_vocabulary(tokens, n_docs), n_docs), n_docs


@query(
    "tfidf",
    f"""WITH {DOCS}, {terms_sql('docs')}, {FREQ}, {vocab_sql(3000, 'docs', 2, 0.95)}, {tfidf_sql('docs')}
    SELECT doc_id, term, round(weight, 8) AS weight FROM weights""",
)
def _tfidf(spark, sf):
    return weights(spark, sf)[0].select("doc_id", "term", F.round("weight", 8).alias("weight"))


@query(
    "scale_sparse",
    f"""WITH {DOCS}, {terms_sql('docs')}, {FREQ}, {vocab_sql(3000, 'docs', 2, 0.95)}, {tfidf_sql('docs')},
    s AS (SELECT term, sum(weight * weight) / (SELECT count(*) FROM docs)
            - (sum(weight) / (SELECT count(*) FROM docs)) ** 2 AS v FROM weights GROUP BY term)
    SELECT doc_id, w.term, round(weight / CASE WHEN v > 0 THEN sqrt(v) ELSE 1 END, 6) AS scaled
    FROM weights w JOIN s ON w.term = s.term""",
)
def _scale(spark, sf):
    table, n_docs = weights(spark, sf)
    table = stored(table, "weights")
    scaled = vocabulary.scale_sparse(table, vocabulary.fit_scale(table, n_docs))
    return scaled.select("doc_id", "term", F.round("scaled", 6).alias("scaled"))


def _word_grams(n: int) -> str:
    parts = ["term", "lead(term, 1) OVER o", "lead(term, 2) OVER o"][:n]
    return f"SELECT {n} AS size, {' || chr(32) || '.join(parts)} AS gram FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY pos)"


@query(
    "ngram_frequencies",
    f"""WITH {b.CLEAN_DOCS}, t AS (SELECT doc_id, unnest({b.tokens('clean_text')}) AS term,
      generate_subscripts({b.tokens('clean_text')}, 1) AS pos FROM clean_docs),
    g AS ({_word_grams(1)} UNION ALL {_word_grams(2)} UNION ALL {_word_grams(3)}),
    c AS (SELECT size, gram, count(*) AS n FROM g WHERE gram IS NOT NULL GROUP BY ALL)
    SELECT size::BIGINT AS size, gram, n, place FROM (SELECT *, row_number() OVER
      (PARTITION BY size ORDER BY n DESC, gram) AS place FROM c) WHERE place <= 100""",
)
def _ngram_frequencies(spark, sf):
    return vocabulary.ngram_frequencies(b.clean_documents(spark, sf), "clean_text", 100)


@query(
    "char_ngrams",
    f"""WITH {b.CLEAN_DOCS}, g AS (SELECT clean_text, unnest(range(1, length(clean_text) - 1)) AS i FROM clean_docs)
    SELECT substr(clean_text, i, 3) AS gram, count(*) AS n FROM g GROUP BY gram""",
)
def _char_ngrams(spark, sf):
    return vocabulary.char_ngram_counts(b.clean_documents(spark, sf), "clean_text", 3)


@query(
    "bigram_lm_score",
    f"""WITH {b.CLEAN_DOCS}, t AS (SELECT doc_id, unnest({b.tokens('clean_text')}) AS w,
      generate_subscripts({b.tokens('clean_text')}, 1) AS pos FROM clean_docs),
    p AS (SELECT doc_id, w, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS z FROM t),
    u AS (SELECT w, count(*) AS c FROM t GROUP BY w),
    m AS (SELECT w, z, count(*) AS c FROM p WHERE z IS NOT NULL GROUP BY w, z),
    cost AS (SELECT m.w, m.z, -ln((m.c + 1)::DOUBLE / (u.c + (SELECT count(*) FROM u))) AS cost
             FROM m JOIN u ON m.w = u.w)
    SELECT doc_id, count(*) AS pairs, round(avg(cost), 6) AS cross_entropy
    FROM p JOIN cost ON p.w = cost.w AND p.z = cost.z GROUP BY doc_id""",
)
def _bigram_lm(spark, sf):
    return bayes.bigram_lm_score(b.clean_documents(spark, sf), "doc_id", "clean_text")


MI_CELL = "CASE WHEN {c} > 0 THEN {c}::DOUBLE / n * ln({c}::DOUBLE * n / ({r}::DOUBLE * {k})) ELSE 0 END"


@query(
    "select_features",
    f"""WITH {b.CLEAN_LABELLED}, {terms_sql('clean_labelled', False)},
    tot AS (SELECT count(*) AS n, count(*) FILTER (label = 'ai') AS na FROM clean_labelled),
    c AS (SELECT term, count(*) FILTER (label = 'ai') AS a, count(*) FILTER (label <> 'ai') AS h
          FROM terms GROUP BY term),
    f AS (SELECT term, a, h, n, na, n - na AS nh, a + h AS present, n - a - h AS absent, na - a AS xa,
          n - na - h AS xh FROM c, tot)
    SELECT term, round({MI_CELL.format(c='a', r='present', k='na')} + {MI_CELL.format(c='h', r='present', k='nh')}
      + {MI_CELL.format(c='xa', r='absent', k='na')} + {MI_CELL.format(c='xh', r='absent', k='nh')}, 9)
      AS information FROM f ORDER BY information DESC, term LIMIT 200""",
)
def _select(spark, sf):
    docs = stored(b.clean_labelled(spark, sf).select("doc_id", "label", "clean_text"), "clean")
    return vocabulary.mutual_information(doc_terms(docs, ("label",), False), docs.select("label"), 200)


@query(
    "select_features_anova",
    f"""WITH {b.CLEAN_LABELLED}, {terms_sql('clean_labelled', False)}, {FREQ}, {vocab_sql(10000, 'clean_labelled')},
    {tfidf_sql('clean_labelled')}, c AS (SELECT label, count(*) AS size FROM clean_labelled GROUP BY label),
    s AS (SELECT term, label, sum(weight) AS s, sum(weight * weight) AS q FROM weights GROUP BY ALL),
    t AS (SELECT term, sum(s) AS s, sum(q) AS q, sum(s * s / size) AS m FROM s JOIN c USING (label) GROUP BY term),
    n AS (SELECT sum(size) AS n, count(*) AS k FROM c),
    f AS (SELECT term, round((greatest(m - s * s / n, 0) / (k - 1)) / nullif(greatest(q - m, 0) / (n - k), 0), 6) AS f FROM t, n)
    SELECT term, f FROM f WHERE f IS NOT NULL ORDER BY f DESC, term LIMIT 200""",
)
def _anova(spark, sf):
    docs = stored(b.clean_labelled(spark, sf).select("doc_id", "label", "clean_text"), "clean")
    n_docs = docs.count()
    vocab = vocabulary.vocabulary(vocabulary.term_doc_freq(doc_terms(docs, (), False)), n_docs, 10_000)
    weights_ = tfidf_table(docs, "doc_id", "clean_text", vocab, n_docs, False, ("label",))
    return vocabulary.anova_f(weights_, docs.select("label"), 200)


# --- naive Bayes -----------------------------------------------------------------------

NB = f"""{b.CLEAN_LABELLED}, {b.split_sql('clean_labelled', 'doc_id', 'label', 0.2, 0.0)},
train AS (SELECT * FROM split_rows WHERE split = 'train'), test AS (SELECT * FROM split_rows WHERE split = 'test'),
{terms_sql('train', False)}, {FREQ}, {vocab_sql(10000, 'train')}, {tfidf_sql('train')},
per AS (SELECT term, sum(CASE WHEN label = 'human' THEN weight ELSE 0 END) AS wh,
               sum(CASE WHEN label = 'ai' THEN weight ELSE 0 END) AS wa FROM weights GROUP BY term),
model AS (SELECT term, ln((wh + 1) / ((SELECT sum(wh) FROM per) + (SELECT count(*) FROM per))) AS lh,
                 ln((wa + 1) / ((SELECT sum(wa) FROM per) + (SELECT count(*) FROM per))) AS la FROM per),
prior AS (SELECT ln(count(*) FILTER (label = 'human') / count(*)::DOUBLE) AS ph,
                 ln(count(*) FILTER (label = 'ai') / count(*)::DOUBLE) AS pa FROM train)"""


def bayes_parts(spark, sf):
    docs = b.clean_labelled(spark, sf).select("doc_id", "label", "clean_text")
    split = stratified_holdout(stored(docs, "clean"), "doc_id", ["label"])
    split = stored(split, "holdout")
    train, test = (split.filter(F.col("split") == s) for s in ("train", "test"))
    n_docs = train.count()
    frequencies = vocabulary.term_doc_freq(doc_terms(train, ("label",), False))
    vocab = stored(vocabulary.vocabulary(frequencies, n_docs, 10_000), "vocabulary")
    weights_ = tfidf_table(train, "doc_id", "clean_text", vocab, n_docs, False, ("label",))
    log_prob, priors = bayes.fit_naive_bayes(weights_, train)
    return test, vocab, n_docs, stored(log_prob, "bayes"), priors


@query(
    "nb_log_ratio_features",
    f"""WITH {NB}, r AS (SELECT term, lh - la AS d FROM model)
    SELECT term, round(d, 8) AS log_ratio, 'human' AS side FROM (SELECT * FROM r ORDER BY round(d, 8) DESC, term LIMIT 15)
    UNION ALL SELECT term, round(d, 8), 'ai' FROM (SELECT * FROM r ORDER BY round(d, 8), term LIMIT 15)""",
)
def _nb_features(spark, sf):
    log_prob = bayes_parts(spark, sf)[3]
    return bayes.nb_log_ratio_features(log_prob, 15)


@query(
    "train_naive_bayes",
    f"""WITH {NB},
    tk AS (SELECT doc_id, unnest({KEPT}) AS term FROM test),
    tt AS (SELECT doc_id, term, count(*) AS n FROM tk GROUP BY ALL),
    tr AS (SELECT t.doc_id, t.term, t.n * (ln((1 + (SELECT count(*) FROM train))::DOUBLE / (1 + v.doc_freq)) + 1) AS r
           FROM tt t JOIN vocab v ON t.term = v.term),
    tw AS (SELECT doc_id, term, r / sqrt(sum(r * r) OVER (PARTITION BY doc_id)) AS w FROM tr),
    e AS (SELECT doc_id, sum(w * lh) AS eh, sum(w * la) AS ea FROM tw JOIN model USING (term) GROUP BY doc_id)
    SELECT t.doc_id, (label = 'ai')::BIGINT AS label,
      round(1 / (1 + exp(-(coalesce(ea, 0) + pa - coalesce(eh, 0) - ph))), 6) AS score
    FROM test t LEFT JOIN e ON t.doc_id = e.doc_id, prior""",
)
def _train_bayes(spark, sf):
    test, vocab, n_docs, log_prob, priors = bayes_parts(spark, sf)
    weights_ = tfidf_table(test, "doc_id", "clean_text", vocab, n_docs, False)
    scored = bayes.score_naive_bayes(weights_, test.select("doc_id", "label"), log_prob, priors, "doc_id")
    return scored.select(
        "doc_id", (F.col("label") == "ai").cast("bigint").alias("label"), F.round("score", 6).alias("score")
    )
