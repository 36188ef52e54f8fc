"""Token files against the library itself on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm import token_files
from quillspark.llm.queries import op10_token_files
from quillspark.llm.tokenise import ChunkEncoder

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", None, " ", "a", " a", "a ", "a  b", "a \n b", "a\nb c", "\n\n", "it's  o'clock 's", "x\x0b y", "x\x1c y\x85 z",
    "é è é ́x", "<|endoftext|> and <|startoftext|>", "ＡＢ 12 345", "İstanbul ΣΑΣ", "a b 　c", "😀 😀😀  \t",
    "mot " * 5000, "​ ​", "a\r\n\r\n b",
]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_chunks_give_the_ids_of_whole_texts(spark, sf_dir, path):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    mine = ChunkEncoder(path, max_chunks=2000)
    for some in (texts[:30], texts[30:], texts[:7]):
        ids, at = mine.encode(some, end_id=0)
        for i, text in enumerate(some):
            assert ids[at[i] : at[i + 1]].tolist() == whole.encode(text or "", add_special_tokens=False).ids + [0]


def expected(rows):
    whole, start, out = Tokenizer.from_file(BYTE), 0, []
    whole.encode_special_tokens = True
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_brute_force(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    mine = op10_token_files(spark, sf_dir)
    assert sorted(map(tuple, mine.collect())) == sorted(expected(rows))


def test_odd_rows_and_single_documents(spark, tmp_path):
    rows = [(i * 3 if i else None, t, i) for i, t in enumerate(TEXTS)] + [(6, "again", 1)] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string, file int")
    manifest = token_files.write_token_files(docs, f"file://{tmp_path}/t", BYTE, files=5)
    back = token_files.document_offsets(manifest, token_files.read_token_files(manifest))
    got = back.select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    want = expected([r[:2] for r in rows])
    assert sorted((r[0] or -1, r[2], r[3]) for r in got) == sorted((r[0] or -1, r[2], r[3]) for r in want)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [r[0] for r in want]
    assert [r.start for r in in_order] == np.cumsum([0] + [r.n_tokens for r in in_order])[:-1].tolist()
    one = token_files.read_token_files(manifest, doc_ids=[9, 12]).select("doc_id", "ids").collect()
    assert sorted(r.doc_id for r in one) == [9, 12]


def test_the_smallest_id_is_no_null(spark, tmp_path):
    least = -(2**63)
    docs = spark.createDataFrame([(least, "the least id"), (None, "no id"), (0, "zero"), (least, "again")], "doc_id long, text string")
    manifest = token_files.write_token_files(docs, f"file://{tmp_path}/n", BYTE, files=1)
    got = token_files.document_offsets(manifest, token_files.read_token_files(manifest)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, least, least, 0]
    assert token_files.read_token_files(manifest, doc_ids=[least]).count() == 2


def test_files_follow_the_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_BYTES", 1000)
    docs = spark.createDataFrame([(i, "word " * 20) for i in range(95)], "doc_id long, text string")
    files = token_files.write_token_files(docs, f"file://{tmp_path}/b", BYTE).collect()
    assert len(files) == 10 and sum(f.n_docs for f in files) == 95 and max(f.n_docs for f in files) <= 12


def test_damage_is_noticed(spark, tmp_path):
    docs = spark.createDataFrame([(i, "some words " * 20) for i in range(4)], "doc_id long, text string")
    path = token_files.write_token_files(docs, f"file://{tmp_path}/d", BYTE, files=1).first()["path"]
    local = path.removeprefix("file://")
    data = bytearray(open(local, "rb").read())
    data[12] ^= 255
    open(local, "wb").write(data)
    with pytest.raises(Exception):
        list(token_files.read_file(path))


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_file_digests(docs, BYTE).count() == 0
    assert token_files.write_token_files(docs, f"file://{tmp_path}/e", BYTE).agg(F.sum("n_docs")).first()[0] is None


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_words_are_asked_for_together(path):
    """One string to the library for hundreds of new words, whatever stops, line ends and capitals stand beside them."""
    words = [a + b + c for a in ("Wa", "thé", "or") for b in "bcdfglmnprst" for c in ("en", "ing", "Tion", "œu")]
    text = "x " + " ".join(w + ("", ".", "$$$", ",\nAnd", "\nor")[i % 5] for i, w in enumerate(words))
    mine, asked = ChunkEncoder(path), []
    for name in ("tokenizer", "letters"):
        library = getattr(mine, name)
        spy = type("Spy", (), {"encode_batch_fast": lambda self, t, library=library, **k: asked.extend(t) or library.encode_batch_fast(t, **k)})
        setattr(mine, name, spy())
    whole = Tokenizer.from_file(path)
    assert mine.encode([text])[0].tolist() == whole.encode(text, add_special_tokens=False).ids
    assert len(asked) < 10
