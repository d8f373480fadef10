import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrose.llm import language_id
from windrose.llm.language_id import Filters, Training

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int, _found int"


def test_held_out_accuracy_and_split(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = language_id.op10_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    right = total = 0
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.held_out and docs[r.doc_id].lang:
            total += 1
            right += r.lang_pred == docs[r.doc_id].lang
    assert total > 200
    assert right / total >= 0.99


def test_labels_ids_and_sources_do_not_matter_for_a_prediction(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    filters = language_id.trained(docs)
    changed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("?"), "id": -F.col("doc_id")})
    plain = {r.doc_id: (r.lang_pred, r.score) for r in language_id.with_language(docs, filters).collect()}
    other = {r.doc_id: (r.lang_pred, r.score) for r in language_id.with_language(changed, filters).collect()}
    assert plain == other


def trigrams(text):
    """Every trigram of words between ends, by definition."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    return [f" {w} "[i : i + 3] for w in letters.split() for i in range(len(w))]


def number(gram):
    codes = [0 if c == " " else ord(c) for c in gram]
    return codes[0] << 42 | codes[1] << 21 | codes[2]


TEXTS = ["", "a", "Ab, cd!", "  x  ", "1 2", "_a_b", "ÄÖ ß日本", "don't stop", "a" * 9, "a,,,b...c d"]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 18])
def test_trigrams_against_definition(monkeypatch, piece):
    monkeypatch.setattr(language_id, "_PIECE", piece)
    found = [[] for _ in TEXTS]
    for parts in language_id._pieces(TEXTS):
        for gram, owner in zip(*language_id._trigrams(parts), strict=True):
            found[owner].append(int(gram))
    assert [sorted(f) for f in found] == [sorted(map(number, trigrams(t))) for t in TEXTS]


def test_filters_hold_all_and_little_else():
    rng = np.random.default_rng(1)
    languages = [f"l{i:03}" for i in range(70)]
    own = [np.unique(rng.integers(0, 1 << 62, 3000)) for _ in languages]
    filters = Filters.of(languages, own, 16)
    others = rng.integers(0, 1 << 62, 20_000)
    for i in (0, 63, 64, 69):
        for grams, least, most in ((own[i], 1.0, 1.0), (others, 0.0, 3 * filters.by_chance[i])):
            masks = np.bitwise_and.reduce(filters.slices[i // 64][language_id._rows_of(grams, 16)], axis=0)
            share = ((masks >> np.uint64(i % 64)) & np.uint64(1)).mean()
            assert least <= share <= most


def test_odd_rows(spark):
    clash = ("s", 1, 2)
    rows = [
        (1, "the cat and the dog", "en", *clash), (3, "der hund und die katze", "de", *clash), (4, None, "en", *clash),
        (5, "123 !!", "en", *clash), (None, "the dog", None, *clash), (6, "xyzzy", None, *clash),
        (7, "the cat " * 300_000, None, *clash), (1, "the cat and the dog", "en", *clash),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    filters = language_id.trained(docs)
    judged = language_id.with_language(docs, filters)
    assert judged.columns == [*docs.columns, "_lang_pred", "_score"]
    found = {(r.doc_id, r.text): (r["_lang_pred"], r["_score"]) for r in judged.collect()}
    assert found[4, None] == found[5, "123 !!"] == ("und", 0.0)
    assert found[1, "the cat and the dog"][0] == found[None, "the dog"][0] == "en"
    assert found[7, "the cat " * 300_000][0] == "en"
    assert found[6, "xyzzy"][1] < 0.5
    kept = language_id.recognised(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1, 3, 7]
    untaught = language_id.trained(docs.where("lang = 'none'"))
    assert {r["_lang_pred"] for r in language_id.with_language(docs, untaught).collect()} == {"und"}
    assert language_id.recognised(docs.limit(0)).collect() == []


def test_bounds(spark):
    docs = spark.createDataFrame([(i, "a b", f"l{i}") for i in range(4)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language_id.trained(docs, Training(most_languages=3))
    many = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.lit("ab").alias("text"), F.lit("x").alias("lang")
    )
    assert language_id.trained(many, Training(rows_per_language=10)).languages == ["x"]
