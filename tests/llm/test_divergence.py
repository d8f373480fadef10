import random
import re
from collections import Counter, defaultdict

import compare
import numpy as np
import pyarrow as pa
import pytest

from windrose.llm import divergence, words
from windrose.llm.divergence import Audit, consed, divergences, node_pairs, shares

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, n int, value string"


def plain(rows, how):
    """The definition, without trees."""
    docs = [(r[2] or "", r[3] or "", re.findall(r"[A-Za-z\u0080-\U0010ffff]+", r[1] or "")) for r in rows]
    docs = [(lang, source, [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in found]) for lang, source, found in docs]
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for lang, source, found in docs:
        counts[lang, source].update(found)
        seen[lang].update(set(found))
    out = set()
    for lang in {d[0] for d in docs}:
        kept = sorted(t for t, n in seen[lang].items() if n >= how.documents)
        sources = {s for x, s in counts if x == lang}
        whole = sum((counts[lang, s] for s in sources), Counter())

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def price(a, b):
            return (a - b) ** 2 // (a + b)

        by_source, overall = {s: p(counts[lang, s]) for s in sources}, p(whole)
        for s, mine in by_source.items():
            pairs = [(sum(price(mine[t], other[t]) for t in kept), o) for o, other in by_source.items() if o != s]
            terms = [(price(mine[t], overall[t]), t) for t in kept if counts[lang, s][t] and mine[t] > overall[t]]
            for part, found, top in (("pair", pairs, len(pairs)), ("term", terms, how.top_terms)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:top]
                out.update((lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1))
    return out


def result(spark, rows, how):
    df = divergences(spark.createDataFrame(rows, SCHEMA), how)
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def corpus(seed, sources, docs):
    rng = random.Random(seed)
    vocabulary = ["the", "Of", "and", "été", "中文", "x", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))]
    weights = [100 / (i + 1) for i in range(len(vocabulary))]
    return [
        (i, " ".join(rng.choices(vocabulary, weights, k=rng.randrange(40))) + ". 12", rng.choice(["en", "de", None]), f"s{rng.randrange(sources)}", "t", 1, "v")
        for i in range(docs)
    ]


@pytest.mark.parametrize(
    "how", [Audit(), Audit(documents=2, terms_per_block=4, sources_per_tile=2), Audit(documents=1, terms_per_block=16, sources_per_tile=3, top_terms=2)]
)
def test_against_the_definition(spark, how):
    rows = corpus(1, 7, 150)
    rows += [(1, None, "en", "s0", "t", 1, "v"), (None, "", "en", "empty", "t", 1, "v"), (None, "the the the", None, None, "t", 1, "v")]
    rows += [(9, "one of a kind", "it", "only", "t", 1, "v"), (9, "-- 7", "pt", "a", "t", 1, "v"), (9, None, "pt", "b", "t", 1, "v")]
    assert result(spark, rows, how) == plain(rows, how)


def test_hot_source_and_repeated_rows(spark):
    rows = corpus(2, 3, 40) + [(7, "the copy of a copy", "en", "hot", "t", 1, "v")] * 300
    assert result(spark, rows, Audit(documents=3)) == plain(rows, Audit(documents=3))


def test_a_long_text_counts_as_one_document():
    counter = divergence._Counter()
    column = pa.array(["x", "aa bb " * 50, " " * 40, "aa", None, "bb aa aa"])
    group = np.array([counter.number("l", "s")] * 6)
    for chunk in words.word_chunks(column, divergence.TERMS, 16):
        counter.add(chunk, group)
    rows = {r["term"]: (r["n"], r["docs"]) for b in counter.drain() for r in b.to_pylist()}
    assert rows == {"x": (1, 1), "aa": (53, 3), "bb": (51, 2)}


def test_no_rows(spark):
    assert result(spark, [], Audit()) == set()


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 2, 1, 2, 0, 0, 0, 0], [0, 0, 1, 2, 1, 2, 0, 0]])
    values, levels, roots = consed(counts)
    assert values.tolist() == [0, 1, 2]
    assert [len(lefts) for lefts, _ in levels] == [2, 4, 3]
    assert roots.tolist() == [2, 1]
    pair, left, right, times = node_pairs(levels, roots[[0]], roots[[1]])
    found = {(int(values[a]), int(values[b])): int(n) for a, b, n in zip(left, right, times, strict=True)}
    assert found == {(1, 0): 1, (2, 0): 1, (1, 1): 1, (2, 2): 1, (0, 1): 1, (0, 2): 1}


def test_shares_beyond_64_bits():
    counts, totals = np.array([10**15, 0]), np.array([2 * 10**15, 7])
    assert shares(counts, totals, 3).tolist() == [1 + 10**9 * (10**15 + 2) // (2 * 10**15 + 6), 1 + 10**9 * 2 // 13]


def test_query_equals_sql(spark):
    name = "op12_source_divergence"
    df = divergence.QUERIES[name](spark, SF)
    assert compare.differences(df, compare.connect(SF), divergence.ORACLE_SQL[name]) == []
