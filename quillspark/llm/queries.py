"""The registered queries of the training-data operators: thin calls with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import chat, collocations, context_tree, decontaminate, hilbert, jaccard_join, knn_join, language_id, packing, quality, spelling, suffix_dedup, token_files
from quillspark.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents without passages of 100 bytes that start earlier."""

    def digests(found: DataFrame) -> DataFrame:
        return found.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "n_bytes",
            "n_removed",
            F.size("spans").cast("long").alias("n_spans"),
            F.sha2("kept", 256).alias("kept_sha256"),
        )

    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), digests)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 5-word shingles are similar by 0.75 or more."""
    return jaccard_join.link_documents(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i:i + least(5, len(w)) - 1] AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
                            FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) l
          JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * l.c >= 75 * (p.n + q.n - l.c)),
reach AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(c) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)"""


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Context-tree and base log10 probabilities of all documents, learned from four fifths of them."""
    return context_tree.score_texts(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        decontaminate.item_digest("item_ids").alias("items_sha256"),
        "contaminated",
    )


OP4_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS size, w[i:i + least(13, len(w)) - 1] AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
grams AS (SELECT doc_id, size, i, w[i:i + size - 1] AS g
          FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, grams.size AS size, item_id FROM grams JOIN win USING (size, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""


def op5_knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector against all others."""
    return knn_join.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
      FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    found = language_id.identify_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal row counts along a Hilbert curve."""
    return hilbert.shard_rows(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from three quarters of the labels."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seekable token files of all documents, written and read back."""
    docs = table(spark, sf_dir, "documents")
    return token_files.token_file_digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of two to five words."""
    return collocations.find_collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
totals AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
f AS (SELECT lang, g, count(*) AS f
      FROM (SELECT lang, w[i:i + k - 1] AS g
            FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 6) r(k) WHERE len(w) >= k))
      GROUP BY lang, g HAVING count(*) >= 100),
cuts AS (SELECT lang, g, f, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
scored AS (SELECT c.lang AS lang, c.g AS g, c.f AS a, k, x.f AS l, y.f AS r, n,
                  ((1000::HUGEINT * c.f * n::HUGEINT) // (x.f::HUGEINT * y.f))::BIGINT AS score
           FROM cuts c JOIN totals USING (lang)
           JOIN f x ON x.lang = c.lang AND x.g = c.g[1:k] JOIN f y ON y.lang = c.lang AND y.g = c.g[k + 1:]),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
held AS (SELECT lang, g[i:i + s - 1] AS g, max(f) AS held
         FROM (SELECT lang, g, f, s, unnest(range(1, len(g) - s + 2)) AS i FROM f, range(2, 5) z(s) WHERE len(g) > s) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
       array_to_string(g, ' ') AS phrase, a, l, r, n::BIGINT AS n, score
FROM weakest LEFT JOIN held USING (lang, g) WHERE held IS NULL OR 100 * held < 100 * a QUALIFY rank <= 2000"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with the forms that they are variants of."""
    return spelling.group_variants(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE codes AS (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
           FROM range(256) t(i)),
lookup AS (SELECT list(c ORDER BY i) AS t FROM codes),
runs AS (SELECT doc_id, run, count(*) AS n
         FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{6,}')),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents) GROUP BY ALL),
bytes AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295, [('0x' || substr(x, i, 2))::BIGINT FOR i IN range(1, length(x), 2)]),
                     lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM bytes, lookup),
words AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM hashed),
v AS (SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS key FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
near AS (SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.key = b.key AND a.word <> b.word
         UNION SELECT c.word, v.word, v.n FROM cut c JOIN v ON v.word = c.key
         UNION SELECT v.word, c.word, c.n FROM cut c JOIN v ON v.word = c.key),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form,
                  CASE WHEN other_n >= 5 * n THEN other_n END AS form_n FROM v LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root FROM v UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, told as event logs, folded, rendered and read back."""
    own = r"\### Assistant: </turn> ok"
    trial = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(*trial.columns).union(trial)
    return chat.format_digests(chat.conversation_log(rows))


OP13_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, i, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
e AS (SELECT *, role = 'assistant' AS loss, length(replace(replace(replace(role, '\', '\\'), '</', '<\/'), '##', '#\#'))
        + length(replace(replace(replace(text, '\', '\\'), '</', '<\/'), '##', '#\#')) + 4 + 5 + 8 AS size FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (loss), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (loss), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_jaccard_join, op3_context_tree, op4_decontamination, op5_knn_join, op6_language_id, op7_hilbert_sharding, op8_quality, op9_packing, op10_token_files, op11_collocations, op12_spelling_variants, op13_chat_formatting)}


def oracles() -> dict[str, str]:
    return {"op2_jaccard_join": OP2_SQL, "op4_decontamination": OP4_SQL, "op5_knn_join": OP5_SQL, "op11_collocations": OP11_SQL, "op12_spelling_variants": OP12_SQL, "op13_chat_formatting": OP13_SQL}
