"""Row transforms and per-text features."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark import fixed_values as fv
from quillspark.catalog import base as b
from quillspark.catalog.base import query, table
from quillspark.functions import generation, labels, style, text, tokens
from quillspark.functions.style import linguistic_features, style_features

DOCS = "documents"
TITLE_SQL = "string_split(text, chr(10))[1]"


def titled(spark, sf):
    """Documents read as papers: first line as title, the rest as abstract."""
    docs = table(spark, sf, DOCS)
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return docs.select(
        "doc_id",
        title.alias("title"),
        F.expr("substring(text, length(split_part(text, '\n', 1)) + 2)").alias("abstract"),
        "lang",
        "source",
    )


@query(
    "build_record",
    f"""SELECT doc_id, text, length(text) AS text_length FROM (
          SELECT doc_id, {TITLE_SQL} || chr(10) || chr(10)
                 || substr(text, length({TITLE_SQL}) + 2) AS text FROM documents)
        WHERE length(text) >= 200""",
)
def _build_record(spark, sf):
    from quillspark.operators.corpus import build_record

    papers = titled(spark, sf).select(
        F.col("doc_id").cast("string").alias("arxiv_id"),
        "title",
        "abstract",
        F.array("source").alias("authors"),
        F.array("lang").alias("categories"),
        F.lit("").alias("published"),
        "source",
    )
    return build_record(papers).select(
        F.col("metadata.arxiv_id").cast("bigint").alias("doc_id"),
        "text",
        F.col("metadata.text_length").alias("text_length"),
    )


@query(
    "entry_id_from_url",
    r"""SELECT page_id, regexp_extract(url, '[^/]*$') AS entry_id FROM pages""",
)
def _entry_id(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.last_segment(F.col("url")).alias("entry_id")
    )


@query("clean_text", f"SELECT doc_id, {b.clean('text')} AS clean_text FROM documents")
def _clean_text(spark, sf):
    return table(spark, sf, DOCS).select("doc_id", text.clean_text(F.col("text")).alias("clean_text"))


@query(
    "clean_for_scoring",
    "SELECT doc_id, "
    + b.squash(rf"regexp_replace({b.squash('text')}, '[^\p{{L}}\p{{N}}_ .,;:!?()\-]', ' ', 'g')")
    + " AS clean_text FROM documents",
)
def _clean_for_scoring(spark, sf):
    return table(spark, sf, DOCS).select(
        "doc_id", text.clean_for_scoring(F.col("text")).alias("clean_text")
    )


RAW_ANSWERS_SQL = """answers AS (
  SELECT conv_id, turn, CASE conv_id % 5
    WHEN 0 THEN 'Rewritten Abstract:  ' || text WHEN 1 THEN '"' || text || '"'
    WHEN 2 THEN text || chr(10) || '--- ' || chr(10) || 'As an AI, I cannot say more.'
    WHEN 3 THEN '[AI-Generated draft] ' || text || ' Note: this is a draft' || chr(10) || '####'
    ELSE text END AS text FROM conversations)"""


@query(
    "clean_generated",
    f"""WITH {RAW_ANSWERS_SQL},
    a AS (SELECT conv_id, turn, {b.squash(b.clean_generated_sql('text'))} AS s FROM answers),
    u AS (SELECT conv_id, turn, CASE WHEN starts_with(s, '"') AND ends_with(s, '"')
            THEN substr(s, 2, greatest(length(s) - 2, 0)) ELSE s END AS s FROM a)
    SELECT conv_id, turn, trim(CASE WHEN starts_with(s, '''') AND ends_with(s, '''')
            THEN substr(s, 2, greatest(length(s) - 2, 0)) ELSE s END) AS cleaned FROM u""",
)
def _clean_generated(spark, sf):
    said, kind = F.col("text"), F.col("conv_id") % 5
    raw = (
        F.when(kind == 0, F.concat(F.lit("Rewritten Abstract:  "), said))
        .when(kind == 1, F.concat(F.lit('"'), said, F.lit('"')))
        .when(kind == 2, F.concat(said, F.lit("\n--- \nAs an AI, I cannot say more.")))
        .when(
            kind == 3,
            F.concat(F.lit("[AI-Generated draft] "), said, F.lit(" Note: this is a draft\n####")),
        )
        .otherwise(said)
    )
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", text.clean_generated(raw).alias("cleaned")
    )


@query(
    "text_stats",
    f"""WITH {b.CLEAN_DOCS}
    SELECT doc_id, length(clean_text) AS text_length, len({b.words('clean_text')}) AS word_count
    FROM clean_docs""",
)
def _text_stats(spark, sf):
    from quillspark.operators.corpus import with_text_stats

    return with_text_stats(b.clean_documents(spark, sf)).select("doc_id", "text_length", "word_count")


@query(
    "encode_label",
    f"""WITH {b.LABELLED}
    SELECT doc_id, CASE label WHEN 'human' THEN 0 WHEN 'ai' THEN 1 END::BIGINT AS label_binary
    FROM labelled""",
)
def _encode_label(spark, sf):
    return b.labelled(spark, sf).select(
        "doc_id", labels.encode_label(F.col("label")).alias("label_binary")
    )


LENGTHS_SQL = """floor(length(text) * 0.7::DOUBLE)::BIGINT AS min_length,
  floor(length(text) * 1.3::DOUBLE)::BIGINT AS max_length,
  floor(floor(length(text) * 1.3::DOUBLE) / 5)::BIGINT AS target_words"""


@query(
    "length_targets",
    f"""SELECT doc_id, {LENGTHS_SQL},
          least(floor(length(text) * 1.5::DOUBLE), 1000)::BIGINT AS max_tokens FROM documents""",
)
def _length_targets(spark, sf):
    targets = generation.length_targets(F.length("text"))
    return table(spark, sf, DOCS).select("doc_id", *[c.alias(k) for k, c in targets.items()])


def keywords_sql(source: str, row_id: str, column: str, top: int, prompt: bool = False) -> str:
    """One row per (row, keyword) with its place."""
    stop = b.quoted(fv.PROMPT_STOP_WORDS if prompt else fv.CHECK_STOP_WORDS)
    if prompt:
        found = (
            r"regexp_extract_all(array_to_string(list_transform(regexp_extract_all(lower("
            + column
            + r"), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+'), lambda r: CASE WHEN regexp_full_match(r, "
            r"'[\p{L}\p{N}_]+') AND NOT regexp_full_match(r, '[a-z0-9]+') THEN ' ' ELSE r END), ''), "
            r"'\b[a-z][a-z0-9]*(?:-+[a-z0-9]+)*')"
        )
        keep = "length(w) >= 4"
    else:
        found = rf"regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}_]+')"
        keep = "regexp_full_match(w, '[a-z]{4,}')"
    return f"""(SELECT {row_id}, w, place FROM (
      SELECT {row_id}, w, row_number() OVER (PARTITION BY {row_id}
             ORDER BY count(*) DESC, min(pos)) AS place
      FROM (SELECT {row_id}, unnest(l) AS w, generate_subscripts(l, 1) AS pos
            FROM (SELECT {row_id}, {found} AS l FROM {source}))
      WHERE {keep} AND w NOT IN ({stop}) GROUP BY {row_id}, w) WHERE place <= {top})"""


def _keyword_query(name, prompt, top, function):
    sql = f"""SELECT d.doc_id, coalesce(k.keywords, '') AS keywords FROM documents d LEFT JOIN (
      SELECT doc_id, string_agg(w, ', ' ORDER BY place) AS keywords
      FROM {keywords_sql('documents', 'doc_id', 'text', top, prompt)} GROUP BY doc_id) k
      ON d.doc_id = k.doc_id"""

    @query(name, sql)
    def run(spark, sf):
        found = F.array_join(function(F.col("text"), top), ", ")
        return table(spark, sf, DOCS).select("doc_id", found.alias("keywords"))


_keyword_query("extract_keywords_check", False, 10, tokens.keywords)
_keyword_query("extract_keywords_prompt", True, 10, tokens.prompt_keywords)


def _prompt_sql() -> str:
    names = list(fv.PROMPT_TEMPLATES)
    cases = " ".join(
        f"WHEN {i} THEN '{fv.PROMPT_TEMPLATES[n].replace(chr(39), chr(39) * 2)}'"
        for i, n in enumerate(names)
    )
    numbers = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    filled = "template"
    for slot, value in (
        ("min_length", "min_length::VARCHAR"),
        ("max_length", "max_length::VARCHAR"),
        ("target_length", "target_words::VARCHAR"),
        ("categories", "lang"),
        ("keywords", "keywords"),
        ("title", "title"),
        ("text", "text"),
    ):
        filled = f"replace({filled}, '{{{slot}}}', {value})"
    return f"""WITH picked AS (
      SELECT doc_id, text, lang, {TITLE_SQL} AS title, {LENGTHS_SQL},
             {b.draw('doc_id', 'template')} % {len(names)} AS pick FROM documents),
    k AS (SELECT doc_id, string_agg(w, ', ' ORDER BY place) AS keywords
          FROM {keywords_sql('documents', 'doc_id', 'text', 8, True)} GROUP BY doc_id),
    worded AS (
      SELECT p.*, coalesce(k.keywords, '{fv.DEFAULT_KEYWORDS}') AS keywords,
             CASE pick {cases} END AS template, CASE pick {numbers} END AS template_name
      FROM picked p LEFT JOIN k ON p.doc_id = k.doc_id)
    SELECT doc_id, template_name, {filled} AS prompt FROM worded"""


@query("build_prompt", _prompt_sql())
def _build_prompt(spark, sf):
    docs = table(spark, sf, DOCS).withColumn("template_name", generation.template_name(F.col("doc_id")))
    prompt = generation.build_prompt(
        F.col("template_name"), F.split_part("text", F.lit("\n"), F.lit(1)), F.col("text"), F.array("lang")
    )
    return docs.select("doc_id", "template_name", prompt.alias("prompt"))


@query(
    "length_ratio",
    f"""WITH {b.PAIRS}
    SELECT pair_id, CASE WHEN length(original) = 0 THEN 0.0::DOUBLE ELSE
           round_even(length(generated)::DOUBLE / length(original), 2) END AS length_ratio
    FROM pairs""",
)
def _length_ratio(spark, sf):
    ratio = generation.length_ratio(F.col("generated"), F.col("original"))
    return b.pairs(spark, sf).select("pair_id", ratio.alias("length_ratio"))




def _rewrite_source(groups, most: int) -> str:
    draws = ", ".join(
        f"{b.draw('doc_id', f'group{g}')} * 16 + {g} AS d{g}" for g in range(len(groups))
    )
    names = ", ".join(f"d{g}" for g in range(len(groups)))
    steps, previous = [], "text"
    for g, group in enumerate(groups):
        changed = previous
        for old, new in group:
            changed = f"replace({changed}, '{old}', '{new}')"
        steps.append(
            f"t{g} AS (SELECT *, CASE WHEN d{g} <= last_draw THEN {changed} ELSE {previous} END "
            f"AS text{g} FROM {'drawn' if g == 0 else f't{g - 1}'})"
        )
        previous = f"text{g}"
    return f"""WITH flags AS (SELECT doc_id, text, {draws} FROM documents),
    drawn AS (SELECT *, list_sort([{names}])[2 + {b.draw('doc_id', 'how_many')} % {most - 1}]
              AS last_draw FROM flags), {', '.join(steps)},
    changed AS (SELECT doc_id, {previous} AS text FROM t{len(groups) - 1})"""


@query(
    "synthetic_rewrite_basic",
    _rewrite_source(fv.BASIC_REWRITES, 3) + " SELECT doc_id, text AS rewritten FROM changed",
)
def _rewrite_basic(spark, sf):
    return table(spark, sf, DOCS).select(
        "doc_id",
        generation.synthetic_rewrite_basic(F.col("text"), F.col("doc_id")).alias("rewritten"),
    )


SWAP_BELOW, CUT_BELOW = int(fv.SWAP_SHARE * 16**7), int(fv.TRUNCATE_SHARE * 16**7)


@query(
    "synthetic_rewrite_full",
    _rewrite_source(fv.FULL_REWRITES, 4)
    + f""",
    pieces AS (SELECT doc_id, string_split(text, '. ') AS s FROM changed),
    placed AS (SELECT *, 1 + {b.draw('doc_id', 'swap_at')} % greatest(len(s) - 1, 1) AS place FROM pieces),
    swapped AS (SELECT doc_id, CASE WHEN len(s) > 2 AND {b.draw('doc_id', 'swap')} < {SWAP_BELOW}
        THEN array_to_string(list_concat(list_concat(s[1:place - 1], [s[place + 1], s[place]]), s[place + 2:]), '. ')
        ELSE array_to_string(s, '. ') END AS text FROM placed),
    w AS (SELECT doc_id, text, {b.words('text')} AS w FROM swapped)
    SELECT doc_id, CASE WHEN {b.draw('doc_id', 'cut')} < {CUT_BELOW}
        THEN array_to_string(w[1:greatest(len(w) - 10, floor(len(w) * 0.9::DOUBLE)::BIGINT)], ' ') || '...'
        ELSE text END AS rewritten FROM w""",
)
def _rewrite_full(spark, sf):
    return table(spark, sf, DOCS).select(
        "doc_id",
        generation.synthetic_rewrite_full(F.col("text"), F.col("doc_id")).alias("rewritten"),
    )


@query(
    "confidence_band",
    f"""WITH {b.SCORED}
    SELECT model, doc_id, CASE WHEN c >= 0.9 THEN 'Very High' WHEN c >= 0.8 THEN 'High'
           WHEN c >= 0.7 THEN 'Moderate' ELSE 'Low' END AS band
    FROM (SELECT *, greatest(score, 1 - score) AS c FROM scored)""",
)
def _confidence_band(spark, sf):
    from quillspark.operators.metrics import confidence

    return b.scored(spark, sf).select("model", "doc_id", labels.confidence_band(confidence()).alias("band"))


@query(
    "linguistic_features",
    rf"""SELECT doc_id, length(text) AS char_length, len({b.words('text')}) AS word_total,
      len(list_filter(string_split(text, '.'), lambda s: {b.strip('s')} <> '')) AS sentence_total,
      round(CASE WHEN length(text) = 0 THEN 0 ELSE
        (length(text) - length(replace(text, ',', '')))::DOUBLE / length(text) END * 1000, 6) AS comma_density,
      len(regexp_extract_all(text, '[!?]')) AS exclaim_question,
      round(CASE WHEN length(text) = 0 THEN 0 ELSE
        len(regexp_extract_all(text, '\p{{Lu}}'))::DOUBLE / length(text) END * 100, 6) AS uppercase_share,
      (len(string_split(text, 'the')) - 1) + (len(string_split(text, 'and')) - 1)
        + (len(string_split(text, 'of')) - 1) AS common_words,
      round(CASE WHEN len({b.words('text')}) = 0 THEN 0 ELSE
        len(list_distinct({b.words('lower(text)')}))::DOUBLE / len({b.words('text')}) END, 6)
        AS vocabulary_diversity FROM documents""",
)
def _linguistic(spark, sf):
    features = linguistic_features(F.col("text"))
    whole = ("char_length", "word_total", "sentence_total", "exclaim_question", "common_words")
    return table(spark, sf, DOCS).select(
        "doc_id",
        *[(c if k in whole else F.round(c, 6)).alias(k) for k, c in features.items()],
    )


@query(
    "strip_urls_emails",
    r"SELECT doc_id, "
    + b.squash(
        r"regexp_replace(regexp_replace(text, '(?:https?://|www\.)[^\s\x{85}\p{Z}]+', ' ', 'g'), "
        r"'[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)+', ' ', 'g')"
    )
    + " AS stripped FROM documents",
)
def _strip_urls(spark, sf):
    return table(spark, sf, DOCS).select("doc_id", text.strip_urls_emails(F.col("text")).alias("stripped"))


def _squeeze_sql(x: str) -> str:
    for mark in ("!", "?", ".", ",", ";", ":"):
        x = f"regexp_replace({x}, '[{mark}]{{2,}}', '{mark}', 'g')"
    return x


@query(
    "squeeze_punctuation",
    f"SELECT doc_id, {_squeeze_sql('text')} AS squeezed FROM documents",
)
def _squeeze(spark, sf):
    return table(spark, sf, DOCS).select("doc_id", text.squeeze_punctuation(F.col("text")).alias("squeezed"))


@query(
    "style_features",
    rf"""WITH m AS (SELECT doc_id, text, len({b.words('text')}) AS w, len({b.sentences('text')}) AS s
                    FROM documents)
    SELECT doc_id,
      round(CASE WHEN s = 0 THEN 0 ELSE w::DOUBLE / s END, 6) AS mean_sentence_words,
      round(CASE WHEN w = 0 THEN 0 ELSE
        length(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g'))::DOUBLE / w END, 6) AS mean_word_chars,
      round(CASE WHEN w = 0 THEN 0 ELSE len(list_distinct({b.words('lower(text)')}))::DOUBLE / w END, 6)
        AS type_token_ratio,
      round(CASE WHEN length(text) = 0 THEN 0 ELSE
        len(regexp_extract_all(text, '[.,;:!?\-()]'))::DOUBLE / length(text) END, 6) AS punctuation_density
    FROM m""",
)
def _style(spark, sf):
    features = style_features(F.col("text"))
    return table(spark, sf, DOCS).select("doc_id", *[F.round(c, 6).alias(k) for k, c in features.items()])


@query(
    "readability",
    rf"""WITH m AS (SELECT doc_id, len({b.words('text')})::DOUBLE AS w, len({b.sentences('text')}) AS s,
                    len(regexp_extract_all(lower(text), '[aeiouy]+')) AS v FROM documents)
    SELECT doc_id, round(CASE WHEN w = 0 OR s = 0 THEN 0::DOUBLE ELSE
      0.39::DOUBLE * (w / s) + 11.8::DOUBLE * (v / w) - 15.59::DOUBLE END, 6) AS grade FROM m""",
)
def _readability(spark, sf):
    return table(spark, sf, DOCS).select(
        "doc_id", F.round(style.flesch_kincaid(F.col("text")), 6).alias("grade")
    )


@query(
    "burstiness",
    f"""WITH s AS (SELECT doc_id, unnest({b.sentences('text')}) AS sentence FROM documents),
    n AS (SELECT doc_id, len({b.words('sentence')})::DOUBLE AS n FROM s)
    SELECT d.doc_id, round(coalesce(b.v, 0), 6) AS burstiness FROM documents d LEFT JOIN (
      SELECT doc_id, sqrt(greatest(avg(n * n) - avg(n) * avg(n), 0)) / avg(n) AS v
      FROM n GROUP BY doc_id) b ON d.doc_id = b.doc_id""",
)
def _burstiness(spark, sf):
    return table(spark, sf, DOCS).select(
        "doc_id", F.round(style.burstiness(F.col("text")), 6).alias("burstiness")
    )


@query(
    "tokenize",
    f"SELECT doc_id, array_to_string({b.tokens('text')}, ' ') AS tokens FROM documents",
)
def _tokenize(spark, sf):
    return table(spark, sf, DOCS).select(
        "doc_id", F.array_join(tokens.tokenize(F.col("text")), " ").alias("tokens")
    )


KEPT_SQL = f"list_filter({b.tokens('text')}, lambda t: t NOT IN ({b.quoted(fv.ENGLISH_STOP_WORDS)}))"


@query(
    "remove_stopwords",
    f"SELECT doc_id, array_to_string({KEPT_SQL}, ' ') AS tokens FROM documents",
)
def _remove_stopwords(spark, sf):
    kept = tokens.remove_stopwords(tokens.tokenize(F.col("text")))
    return table(spark, sf, DOCS).select("doc_id", F.array_join(kept, " ").alias("tokens"))


@query(
    "ngrams",
    f"""WITH k AS (SELECT doc_id, {KEPT_SQL} AS k FROM documents),
    e AS (SELECT doc_id, unnest(k) AS a, generate_subscripts(k, 1) AS pos FROM k),
    p AS (SELECT doc_id, pos, a, lead(a) OVER (PARTITION BY doc_id ORDER BY pos) AS z FROM e),
    g AS (SELECT doc_id, 1 AS part, pos, a AS gram FROM p
          UNION ALL SELECT doc_id, 2, pos, a || ' ' || z FROM p WHERE z IS NOT NULL)
    SELECT d.doc_id, coalesce(x.grams, '') AS grams FROM documents d LEFT JOIN
      (SELECT doc_id, string_agg(gram, '|' ORDER BY part, pos) AS grams FROM g GROUP BY doc_id) x
      ON d.doc_id = x.doc_id""",
)
def _ngrams(spark, sf):
    terms = tokens.unigrams_and_bigrams(F.col("text"))
    return table(spark, sf, DOCS).select("doc_id", F.array_join(terms, "|").alias("grams"))
