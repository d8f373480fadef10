import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from windrose.llm import packing
from windrose.llm.packing import Packing, Search, WordIds, best_fit, packed, packed_block, token_pieces
from windrose.llm.token_files import public_tokenizer

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
ATOMS = ["a", "It's", " ", "  ", "\n", "\t", ".", "é", "é", "́", "İ", "Σ", "1", "²", "中", "\x0b", "\x85", "\xa0", "<|endoftext|>", "🙂", "the", "'S"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("kept", [500_000, 5])
def test_ids_equal_the_library(library, monkeypatch, kept):
    monkeypatch.setattr(packing, "_KEPT_RUNS", kept)
    monkeypatch.setattr(packing, "_KEPT_OTHERS", kept)
    rng = random.Random(3)
    texts = [None, "", " ", *("".join(rng.choices(ATOMS, k=rng.randrange(50))) for _ in range(2000))]
    encoder = WordIds(public_tokenizer("word_bpe_49k.json"))
    assert encoder.by_word and encoder.by_run
    ids, counts = encoder.column(pa.array(texts))
    assert np.split(ids, np.cumsum(counts))[-1].size == 0
    for text, found in zip(texts, np.split(ids, np.cumsum(counts)), strict=False):
        assert found.tolist() == ids_of(library, text), text


def test_other_tokenizers_are_given_whole_texts():
    encoder = WordIds(public_tokenizer("byte_bpe_50k.json"))
    assert not encoder.by_word
    other = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids, counts = encoder.column(pa.array(["Two  words", None]))
    assert ids.tolist() == ids_of(other, "Two  words") and counts.tolist() == [len(ids), 0]


def fills(lengths, bins):
    found = defaultdict(int)
    for length, b in zip(lengths.tolist(), bins.tolist(), strict=True):
        found[b] += length
    return found


def test_best_fit_takes_the_tightest_bin():
    assert len(set(best_fit(np.array([6, 5, 4, 3, 2]), 10).tolist())) == 2
    assert len(set(best_fit(np.array([6, 6, 6]), 10).tolist())) == 3


@pytest.mark.parametrize(
    ("lengths", "bins", "needed"),
    [
        ([4, 3, 3], [0, 1, 1], 1),  # moves
        ([7, 4, 6, 3], [0, 1, 2, 1], 2),  # one for one and moves
        ([5, 4, 2, 2, 4, 3], [0, 0, 1, 1, 1, 2], 2),
        ([3, 3, 5, 4, 5], [0, 0, 1, 1, 2], 2),  # two for one
    ],
)
def test_search_empties_bins(lengths, bins, needed):
    lengths, before = np.array(lengths), None
    search = Search(lengths, np.array(bins), 10)
    squares = int((search.fill**2).sum())
    found = search.run()
    after = fills(lengths, found)
    assert max(after.values()) <= 10
    assert sum(v * v for v in after.values()) >= squares
    assert len(after) == needed


@pytest.mark.parametrize("seed", range(6))
def test_blocks_are_never_worse_than_best_fit(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, [2048, 900, 1400, 2048, 300, 2000][seed], 1500)
    bins = packed_block(lengths, None, 2048)
    used = fills(lengths, bins)
    assert max(used.values()) <= 2048
    bound = -(-int(lengths.sum()) // 2048)
    assert bound <= len(used) <= len(set(best_fit(lengths, 2048).tolist()))
    scattered = packed_block(lengths, np.arange(len(lengths)), 2048)
    assert len(fills(lengths, scattered)) <= 1.03 * len(used)


def test_many_tiny_pieces():
    lengths = np.array([1] * 3000 + [2047, 2046, 1000, 1500] * 3)
    bins = packed_block(lengths, np.arange(len(lengths)) % 60 + 100 * (lengths > 1) * np.arange(len(lengths)), 2048)
    used = fills(lengths, bins)
    assert max(used.values()) <= 2048
    assert len(used) <= -(-int(lengths.sum()) // 2048) + 2


def check(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("block", [40, 8192])
def test_rounds_keep_all_pieces(spark, block):
    rng = random.Random(block)
    lengths = [rng.choice([1, 7, 64, rng.randrange(65)]) for _ in range(600)]
    pieces = spark.createDataFrame([(i, n, "x", 5) for i, n in enumerate(lengths)], "doc_id long, length long, text string, offset int")
    rows = packed(pieces, Packing(length=64, pieces_per_block=block, open_gap=1)).collect()
    assert sorted((r.doc_id, r.length, r.text) for r in rows) == [(i, n, "x") for i, n in enumerate(lengths)]
    assert check(rows, 64) <= 1.02 * sum(lengths) / 64 + 2


def test_pieces_of_half_a_sequence_and_more_end(spark):
    pieces = spark.range(500).select(F.lit(33).cast("long").alias("length"))
    assert check(packed(pieces, Packing(length=64, pieces_per_block=50)).collect(), 64) == 500


ROWS = [(3, "three three", "x", 1), (1, None, "x", 1), (1, "", "x", 1), (None, "none", "x", 1), (2, "word " * 30_000, "x", 1), (3, "three three", "x", 1)]
SCHEMA = "doc_id long, text string, start string, sequence_id int"


def test_pieces_hold_the_documents(spark, library):
    how = Packing(length=7, end_id=49407)
    rows = token_pieces(spark.createDataFrame(ROWS, SCHEMA), public_tokenizer("word_bpe_49k.json"), how).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.piece):
        assert r.start == 7 * r.piece
        assert r.length == len(r.ids) // 4 <= 7
        found[r.doc_id].append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()))
    for doc_id in {r[0] for r in ROWS}:
        expected = [[*ids_of(library, t), 49407] for i, t, *_ in ROWS if i == doc_id]
        pieces = [(s, ids[s : s + 7]) for ids in expected for s in range(0, len(ids), 7)]
        assert sorted(found[doc_id]) == sorted(pieces)


def test_no_rows(spark):
    pieces = token_pieces(spark.createDataFrame([], SCHEMA), public_tokenizer("word_bpe_49k.json"))
    assert packed(pieces).collect() == []


def test_query_against_plain_encoding(spark, library):
    rows = packing.op11_best_fit_packing(spark, SF).collect()
    expected = {}
    for doc in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = np.array([*ids_of(library, doc.text), 0], "<u4")
        for start in range(0, len(ids), 2048):
            part = ids[start : start + 2048]
            expected[doc.doc_id, start // 2048] = (start, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    used = check(rows, 2048)
    bound = -(-sum(n for _, n, _ in expected.values()) // 2048)
    assert used <= bound + 1
