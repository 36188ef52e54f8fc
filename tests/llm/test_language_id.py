"""Language identification: costs against a plain recursion, held-out accuracy, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from quillspark.llm import language_id as li
from quillspark.llm.queries import op6_language_id


def plain_cost(counts, text, i):
    """Bits of byte i by dictionaries: the longest context first, escapes on the way."""
    bits = 0.0
    padded = b"\0\0\0" + text
    for order in range(3, -1, -1):
        context, symbol = padded[i + 3 - order : i + 3], padded[i + 3]
        own = {g[-1]: n for g, n in counts[order].items() if g[:-1] == context}
        if not own:
            continue
        whole = sum(own.values()) + len(own)
        if symbol in own:
            return bits + math.log2(whole / own[symbol])
        bits += math.log2(whole / len(own))
    return bits + 8.0


def test_costs_equal_a_plain_recursion():
    learned = [b"the cat", b"a", b"", b"the hat that", "ä ö".encode()]
    counts = [Counter() for _ in range(4)]
    for t in learned:
        for i in range(len(t)):
            for order in range(4):
                counts[order][(b"\0\0\0" + t)[i + 3 - order : i + 4]] += 1
    offsets = np.cumsum([0] + [len(t) for t in learned])
    grams, n = np.unique(li.four_grams(np.frombuffer(b"".join(learned), np.uint8), offsets), return_counts=True)
    model = li.LanguageModel.of({"x": (grams, n.astype(float)), "y": (grams[:3], n[:3].astype(float))})
    asked = [b"that cat", b"q", b"", b"zz the", b"a", b"ab"]
    got = model.code_lengths(np.frombuffer(b"".join(asked), np.uint8), np.cumsum([0] + [len(t) for t in asked]))
    want = [sum(plain_cost(counts, t, i) for i in range(len(t))) for t in asked]
    assert np.allclose(got[0], want)


def test_query_is_right_on_held_out_documents(spark, sf_dir):
    rows = op6_language_id(spark, sf_dir).collect()
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_odd_rows(spark):
    rows = [(i, "the cat sat on the mat", "en", 1.0) for i in range(30)] + [(i, "der hund und die katze", "de", 1.0) for i in range(30, 60)]
    rows += [(60, None, "en", 1.0), (61, "", "en", 1.0), (62, "12 34 !!", None, 1.0), (63, "und die", None, 1.0), (None, "the cat", "en", 1.0)]
    rows += [(64, "the mat " * 9000, None, 1.0), (63, "und die", None, 1.0), (65, "日本", None, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = {(r.doc_id, r.lang_pred) for r in li.identify_languages(docs).collect()}
    assert {(60, "und"), (61, "und"), (62, "und"), (63, "de"), (None, "en"), (64, "en")} <= got
    assert (65, "und") not in got
    kept = li.identify_languages(docs, columns=docs.columns).filter("lang_pred <> 'und'")
    assert kept.count() == len(rows) - 3 and set(docs.columns) <= set(kept.columns)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in li.identify_languages(docs).collect()] == ["und"]
    assert li.identify_languages(docs.limit(0)).count() == 0


def test_every_language_is_learned_within_bounds(spark):
    rows = [(i, "der hund und die katze " * (100_000 if i == 7 else 1), "de") for i in range(20)]  # rare and very long
    rows += [(100 + i, f"text of language {i % 70}", f"l{i % 70}") for i in range(140)]  # more than 64 of them
    rows += [(1000 + i, "the cat sat on the mat", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = li.learn(docs, sample_bytes=2200)
    assert model.languages == sorted({lang for _, _, lang in rows})
    learned = dict(zip(model.languages, (s.totals[0].sum() for s in model.statistics)))
    assert learned["en"] == 2200 and learned["l3"] == 2 * len("text of language 3")
    assert learned["de"] == 19 * 23 + li.LEARN_CHARS
    found = {r.doc_id: r.lang_pred for r in li.predict(docs, model).collect()}
    assert found[3] == found[7] == "de" and found[1000] == "en"


def test_a_small_table_of_costs_changes_nothing(spark, monkeypatch):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat sat", "en"), ("der hund", "de")] * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    data, offsets = np.frombuffer(b"the hund sat", np.uint8), np.array([0, 12])
    whole = li.learn(docs).code_lengths(data, offsets)
    monkeypatch.setattr(li, "TABLE_CELLS", 6)
    small = li.learn(docs)
    assert len(small.grams) == 3 and np.allclose(small.code_lengths(data, offsets), whole)


def test_stage_keeps_letters_if_nothing_is_learned(spark):
    rows = [(1, "words", None), (2, "12 !", None), (3, None, None), (4, "日本", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 4]
