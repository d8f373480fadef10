import random
import re
from collections import Counter, defaultdict

import compare
import numpy as np
import pyarrow as pa
import pytest

from windrose.llm import collocations
from windrose.llm.collocations import Mining, Scanner, frequent_phrases, holds, word_hashes
from windrose.llm.words import word_chunks

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, phrase string, n int, rank string"


def pieces_of(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [re.findall(r"[^ \t]+", piece) for piece in re.split(r"[.,;:!?\n-\r]", lowered)]


def plain(rows, how):
    """The definition, by counting everything."""
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for w in pieces_of(text):
            n[lang] += len(w)
            for size in range(1, how.longest + 1):
                f[lang].update(" ".join(w[i : i + size]) for i in range(len(w) - size + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if a >= how.least and " " in p}
        found = []
        for p, a in candidates.items():
            if any(f" {p} " in f" {q} " and len(q) > len(p) and 100 * b >= how.covered_percent * a for q, b in candidates.items()):
                continue
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                left, right = counts[" ".join(w[:k])], counts[" ".join(w[k:])]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            found.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[: how.top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


def result(spark, rows, how):
    df = collocations.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), how)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def corpus(seed, docs):
    rng = random.Random(seed)
    words = ["the", "of", "Of", "été", "中文", "|", "new", "york", "a-b", "rare"]
    weights = [30, 20, 5, 4, 3, 3, 8, 8, 2, 1]
    rows = []
    for i in range(docs):
        text = "".join(rng.choice([" ", " ", "  ", "\t", ", ", ".\n"]) + w for w in rng.choices(words, weights, k=rng.randrange(40)))
        rows.append((i, text, rng.choice(["en", "en", "de", None]), "x", 1, "y"))
    return rows


@pytest.mark.parametrize(
    "how",
    [
        Mining(bits=1 << 16),
        Mining(shards=1, least=5, bits=1 << 16),
        Mining(shards=2, least=3, bits=64, covered_percent=60),
        Mining(shards=4, least=8, longest=5, bits=1 << 10, top=7),
    ],
)
def test_against_the_definition(spark, how):
    rows = corpus(how.shards, 90)
    rows += [(1, None, "en", None, 1, "y"), (None, "", "fr", "x", 1, "y"), (1, "new york " * 200, "und", "x", 1, "y")]
    rows += [(1, "copy of a copy of", "en", "x", 1, "y")] * 60
    assert result(spark, rows, how) == plain(rows, how)


@pytest.mark.parametrize("limit", [1, 9, 30, 1 << 20])
def test_long_texts_are_counted_across_chunks(limit):
    rng = random.Random(limit)
    texts = [" ".join(rng.choices(["a", "bb", "c.", "dd,", " "], k=200)) for _ in range(3)]
    full = np.full(16, np.uint64(2**64 - 1))
    found, scanner = Counter(), Scanner("en", 4, True, full, full)
    for chunk in word_chunks(pa.array(texts), collocations.PIECES, limit):
        for size, phrases, n in scanner.counts(chunk):
            # Words carried over from the chunk before have numbers of their own, so a phrase may come twice.
            for phrase, count in zip(phrases.to_pylist(), n.tolist(), strict=True):
                found[phrase] += count if size else 0
    expected = Counter()
    for text in texts:
        for w in pieces_of(text):
            for size in range(1, 5):
                expected.update(" ".join(w[i : i + size]) for i in range(len(w) - size + 1))
    assert +found == expected


def test_phrases_are_counted_from_the_step_after_their_parts(spark):
    """A phrase whose parts get frequent in the last shard only still has its whole cycle."""
    rows = [(i, "early bird", "en", "x", 1, "y") for i in range(6)] + [(9, "late " * 4 + "riser. late riser", "en", "x", 1, "y")]
    rows += [(7, "late riser", "en", "x", 1, "y")] * 3
    frequent = frequent_phrases(spark.createDataFrame(rows, SCHEMA).coalesce(1), Mining(shards=5, least=4, bits=1 << 12))
    found = {r.phrase: r.n for r in frequent.collect()}
    assert found == {"": 25, "early": 6, "bird": 6, "late": 8, "riser": 5, "early bird": 6, "late riser": 5}


def test_bit_maps_hold_what_was_marked(spark):
    phrases = [("en", f"w{i} v{i % 7}") for i in range(300)] + [("de", "w1")]
    bitmap = collocations._marked(spark.createDataFrame(phrases, "lang string, phrase string"), Mining(bits=1 << 14))
    for lang, phrase in phrases:
        hashes = word_hashes(lang, phrase.encode().split())
        assert holds(bitmap, collocations.joined(*[hashes[i : i + 1] for i in range(len(hashes))])).all()
    others = word_hashes("en", [f"x{i}".encode() for i in range(2000)])
    assert holds(bitmap, others).mean() < 0.02


def test_no_rows(spark):
    assert result(spark, [], Mining(bits=64)) == set()
    assert result(spark, [(1, None, None, "x", 1, "y")], Mining(bits=64)) == set()


def test_query_equals_sql(spark):
    name = "op13_phrase_collocations"
    df = collocations.QUERIES[name](spark, SF)
    assert compare.differences(df, compare.connect(SF), collocations.ORACLE_SQL[name]) == []


def test_counts_of_many_phrases_are_kept_in_few_rows(spark, monkeypatch):
    """Ever new phrases cost bytes, not rows."""
    rows = [(i, " ".join(f"w{i}x{j} of" for j in range(50)), "en", "x", 1, "y") for i in range(90)]
    sizes, plainly = [], collocations.stored

    def stored(df, label):
        found = plainly(df, label)
        if label == "phrase-counts":
            sizes.append(found[0].count())
        return found

    monkeypatch.setattr(collocations, "stored", stored)
    how = Mining(bits=1 << 16)
    assert result(spark, rows, how) == plain(rows, how)
    assert sizes and max(sizes) < 50


def test_a_phrase_has_one_bucket():
    phrases = pa.array([f"été {i} {'x' * (i % 300)}" for i in range(2000)] + [""], pa.large_string())
    found = collocations.buckets_of(phrases, 16)
    assert np.bincount(found, minlength=16).min() > 60
    assert (collocations.buckets_of(phrases[700:], 16) == found[700:]).all()
    assert (collocations.buckets_of(phrases.take(pa.array(range(0, 2001, 7))), 16) == found[::7]).all()


def test_texts_are_cut_into_words_once(spark, monkeypatch):
    """All cycles scan the numbers of words that the texts were cut into at first."""
    rows, scanned, plainly = corpus(5, 90), [], collocations._scan

    def scan(shard, *more):
        scanned.append(set(shard.columns))
        return plainly(shard, *more)

    monkeypatch.setattr(collocations, "_scan", scan)
    how = Mining(least=5, bits=1 << 16)
    assert result(spark, rows, how) == plain(rows, how)
    assert len(scanned) > how.shards and all("numbers" in columns for columns in scanned)


@pytest.mark.parametrize("limit", [9, 1 << 20])
def test_numbers_of_words_count_as_the_texts(limit):
    texts = ["a b c. d, e f a b " * 9, None, "a b,c " * 5, "é " + "a b c d " * 30]
    full = np.full(16, np.uint64(2**64 - 1))
    scanner, other = (Scanner("en", 4, True, full, full) for _ in range(2))
    coder, again = collocations.Coder("en", 4), []
    for chunk in word_chunks(pa.array(texts), collocations.PIECES, limit):
        row = collocations._coded_row("en", 0, coder.coded(chunk))
        for _ in range(2):
            again.append([(s, p.to_pylist(), n.tolist()) for s, p, n in other.coded_counts(collocations._decoded(row))])
        assert again[-1] == again[-2] == [(s, p.to_pylist(), n.tolist()) for s, p, n in scanner.counts(chunk)]
    assert again


@pytest.mark.parametrize("terms", [3, 300, 70_000])
@pytest.mark.parametrize("size", [2, 3, 4, 5])
def test_distinct_phrases_of_few_and_many_words(terms, size):
    rng = np.random.default_rng(terms)
    numbers = rng.integers(1, terms + 1, 400)
    numbers[200:] = numbers[:200]
    words, at = pa.array([f"w{i}" for i in range(terms)], pa.large_string()), np.arange(0, 400 - size, 3)
    phrases, n = Scanner._phrases(words, numbers, at, size)
    expected = Counter(" ".join(f"w{x - 1}" for x in numbers[i : i + size]) for i in at)
    assert dict(zip(phrases.to_pylist(), n.tolist(), strict=True)) == expected


def test_phrases_are_hashed_together():
    phrases = [f"w{i} v{i % 7}" for i in range(50)] + ["w1", "é", "a b c", "", "w1 v1"]
    found = np.concatenate(list(collocations._phrase_hashes("de", pa.array(phrases))))
    each = [collocations.joined(*word_hashes("de", p.encode().split(b" "))[:, None]) for p in phrases]
    assert sorted(found.tolist()) == sorted(np.concatenate(each).tolist())
    bitmap = np.zeros(64, np.uint64)
    probes = collocations._probes(found[:60], 64 * 64)
    np.bitwise_or.at(bitmap, (probes >> np.uint64(6)).astype(int), np.uint64(1) << (probes & np.uint64(63)))
    assert holds(bitmap, found).all()
    others = word_hashes("fr", [f"x{i}".encode() for i in range(500)])
    hit = [all(int(bitmap[p >> 6]) >> (p & 63) & 1 for p in collocations._probes(others[i : i + 1], 64 * 64).tolist()) for i in range(500)]
    assert holds(bitmap, others).tolist() == hit
