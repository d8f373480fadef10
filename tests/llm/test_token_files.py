import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from windrose.llm import token_files
from windrose.llm.token_files import Encoder, TokenFile, TokenFiles, public_tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    found = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ATOMS = ["a", "b", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "é", " é", "ß", "%", "1", "²", "中", "ж", "\x1c", "\xa0", "<|endoftext|>", "️", "🙂", "the", " the"]


def test_encoder_equals_library(library, monkeypatch):
    rng = random.Random(2)
    texts = ["", " ", "a", " a", "a ", "<|endoftext|>"]
    texts += ["".join(rng.choices(ATOMS, k=rng.randrange(1, 60))) for _ in range(3000)]
    encoder = Encoder(public_tokenizer())
    assert encoder.cuttable
    for limits in ((1 << 20, 600_000), (20, 600_000), (20, 50)):
        for name, value in zip(("_PIECE", "_KEPT_PIECES"), limits, strict=True):
            monkeypatch.setattr(token_files, name, value)
        for text in texts:
            assert np.frombuffer(encoder.encoded(text), encoder.type).tolist() == ids_of(library, text), text


@pytest.fixture(scope="module")
def untouched():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_added_tokens_equal_the_untouched_library(untouched, monkeypatch):
    rng = random.Random(5)
    texts = ["one <|endoftext|> two", "<|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext|>  a", "a  <|endoftext|>", "<|endoftext"]
    texts += ["".join(rng.choices([*ATOMS, "<|endoftext|>", "<|"], k=rng.randrange(1, 60))) for _ in range(2000)]
    encoder = token_files._encoder(public_tokenizer())
    assert encoder.cuttable
    for piece in (1 << 20, 20):
        monkeypatch.setattr(token_files, "_PIECE", piece)
        for text in texts:
            assert np.frombuffer(encoder.encoded(text), encoder.type).tolist() == ids_of(untouched, text), text


def test_groups_of_texts_equal_the_untouched_library(untouched, monkeypatch):
    """White space of all kinds at spaces, ends of texts, cuts of long texts, and no room for pieces."""
    rng = random.Random(6)
    atoms = [*ATOMS, " ", " ", "<|endoftext|>", "ab\n", " ab", "\n\n", "\u2028", "\x85", "word "]
    texts = ["", " ", "  ", "a", " a", "a ", "a b\n", "a b\n\n", "\na b", "a\n b", "a \nb", "one <|endoftext|> two", " <|endoftext|>"]
    texts += ["".join(rng.choices(atoms, k=rng.randrange(0, 60))) for _ in range(3000)]
    expected = [ids_of(untouched, text) for text in texts]
    for piece, kept, group, joined in ((1 << 20, 600_000, 1 << 20, 500), (20, 50, 200, 7), (20, 600_000, 1, 1)):
        for name, value in (("_PIECE", piece), ("_KEPT_PIECES", kept), ("_GROUP", group), ("_JOINED", joined)):
            monkeypatch.setattr(token_files, name, value)
        encoder = Encoder(public_tokenizer(), added_tokens=True)
        for text, ids, right in zip(texts, encoder.encoded_each(iter(texts)), expected, strict=True):
            assert np.frombuffer(ids, encoder.type).tolist() == right, text


def test_query_encodes_added_tokens(spark, tmp_path, untouched):
    texts = {1: "one <|endoftext|> two", 2: "three"}
    spark.createDataFrame([*texts.items()], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    start = 0
    for row in sorted(token_files.op6_token_files(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        ids = np.array([*ids_of(untouched, texts[row.doc_id]), 0], "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_other_tokenizers_are_not_cut():
    encoder = Encoder(public_tokenizer("word_bpe_49k.json"))
    assert not encoder.cuttable
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = "It's  a test.\nOf two"
    assert np.frombuffer(encoder.encoded(text), encoder.type).tolist() == ids_of(library, text)


def test_query_equals_plain_encoding(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    rows = {r.doc_id: r for r in token_files.op6_token_files(spark, SF).collect()}
    start = 0
    for doc in docs:
        ids = np.array([*ids_of(library, doc.text), 0], "<u4")
        row = rows.pop(doc.doc_id)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not rows


SCHEMA = "doc_id long, text string, start string, tokens int"
ROWS = [
    (3, "three three", "x", 1), (1, None, "x", 1), (1, "", "x", 1), (None, "none", "x", 1), (2, "word " * 300_000, "x", 1),
    (3, "three three", "x", 1), (7, "a\n b", "x", 1),
]


@pytest.mark.parametrize("how", [TokenFiles(), TokenFiles(length=7, sequences_per_batch=3, part_bytes=40, end_id=50256)])
def test_files_hold_all_tokens_and_masks(spark, tmp_path, library, how):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    manifest = token_files.write_token_files(docs, public_tokenizer(), str(tmp_path / "tokens"), how)
    parts = sorted(manifest.collect(), key=lambda r: r.part)
    expected = {}
    for doc_id, text, *_ in ROWS:
        expected.setdefault(doc_id, []).append([*ids_of(library, text), how.end_id])
    order = []
    for part in parts:
        file = TokenFile(part.path)
        documents = pa.Table.from_batches(list(file.documents())).to_pylist()
        assert part.documents == len(documents)
        flat = np.concatenate([file.sequence(i)[file.mask(i) == 1] for i in range(len(file))])
        assert len(flat) == part.tokens
        assert all(len(file.sequence(i)) == len(file.mask(i)) == how.length for i in range(len(file)))
        place = 0
        for d in documents:
            ids = file.tokens(d["start"], d["n_tokens"]).tolist()
            assert d["start"] == place
            assert flat[place : place + d["n_tokens"]].tolist() == ids
            expected[d["doc_id"]].remove(ids)
            order.append(-1 if d["doc_id"] is None else d["doc_id"])
            place += d["n_tokens"]
        assert place == part.tokens
    assert order == sorted(order)
    assert not any(expected.values())
    assert not list((tmp_path / "tokens").glob("*.tmp"))
    read = token_files.read_documents(manifest).collect()
    assert sum(r.n_tokens for r in read) == sum(p.tokens for p in parts)
    assert sorted(r.start for r in read)[0] == 0


def test_sequences_are_views_of_the_file(spark, tmp_path):
    docs = spark.createDataFrame(ROWS[:1], SCHEMA)
    manifest = token_files.write_token_files(docs, public_tokenizer(), str(tmp_path / "tokens"))
    file = TokenFile(manifest.first().path)
    assert file.sequence(0).base is not None
    assert not file.sequence(0).flags.owndata


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert token_files.tokenised(docs, public_tokenizer()).collect() == []


def test_an_encoder_keeps_little_of_texts_with_ever_new_words():
    encoder = Encoder(public_tokenizer())
    tracemalloc.start()
    for first in range(0, 600_000, 50_000):
        text = " ".join(f"w{i:x}" for i in range(first, first + 50_000))
        assert len(list(encoder.encoded_each([text]))) == 1
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 40e6
