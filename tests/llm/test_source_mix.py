import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrose.llm import source_mix
from windrose.llm.source_mix import Mix

SF = "/root/testdata/sf0.001"


def water_level(sizes, weights, share, most):
    """Targets by the definition: cap, share out the excess by weight, repeat."""
    left, open_ = share * sum(sizes), set(range(len(sizes)))
    targets = [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        above = {i for i in open_ if left * weights[i] / total >= most * sizes[i]}
        if not above:
            for i in open_:
                targets[i] = left * weights[i] / total
            break
        for i in above:
            targets[i] = most * sizes[i]
            left -= targets[i]
        open_ -= above
    return targets


def test_query_against_definition(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = source_mix.op3_source_mix(spark, SF).collect()
    assert Counter(r.doc_id for r in rows) == Counter(d.doc_id for d in docs)
    size = {d.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", d.text or "")) for d in docs}
    source = {d.doc_id: d.source for d in docs}
    names = sorted({d.source for d in docs})
    sizes = [sum(size[i] for i in size if source[i] == n) for n in names]
    weights = [(3, 1, 2)[i % 3] for i in range(len(names))]
    targets = dict(zip(names, water_level(sizes, weights, 1.5, 2), strict=True))
    taken = Counter()
    for r in rows:
        assert r["size"] == size[r.doc_id]
        assert r.target == pytest.approx(targets[source[r.doc_id]], rel=1e-12)
        assert r.source_size == sizes[names.index(source[r.doc_id])]
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[source[r.doc_id]] += r.taken
    for name in names:
        largest = max(size[i] for i in size if source[i] == name)
        assert abs(taken[name] - targets[name]) <= largest / 2 + 1
    again = source_mix.op3_source_mix(spark, SF).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("sizes", [[5, 100, 7, 0, 40], [1], [0, 0], [10, 10, 10], [1, 1000]])
@pytest.mark.parametrize("share", [0.5, 1.5, 2.0])
def test_targets(spark, sizes, share):
    mix = Mix(share=share)
    df = spark.createDataFrame([(f"s{i:02}", n) for i, n in enumerate(sizes)], "source string, source_size long")
    found = [r.target for r in source_mix.source_targets(df, mix).orderBy("source").collect()]
    weights = [mix.weights[i % 3] for i in range(len(sizes))]
    assert found == pytest.approx(water_level(sizes, weights, share, 2), abs=1e-9)


def test_hypergeometric_distribution(spark):
    n = 4000
    for marked, total, drawn in [(5, 12, 6), (300, 1000, 500), (0, 9, 4), (9, 9, 4), (3, 7, 7), (1, 2, 1)]:
        column = source_mix.hypergeometric(
            F.lit(marked).cast("long"), F.lit(total).cast("long"), F.lit(drawn).cast("long"), F.col("id")
        )
        counts = np.array([r[0] for r in spark.range(n).select(column).collect()])
        assert counts.min() >= max(0, drawn + marked - total)
        assert counts.max() <= min(marked, drawn)
        share = marked / total
        variance = drawn * share * (1 - share) * (total - drawn) / (total - 1)
        assert abs(counts.mean() - drawn * share) <= 5 * (variance / n) ** 0.5 + 1e-9
        assert abs(counts.var() - variance) <= 0.15 * variance + 1e-9


@pytest.mark.parametrize("shards", [1, 2, 5, 16])
def test_shards_share_out_all_blocks(spark, shards):
    quotas = [70, 0, 33, 1]
    df = spark.createDataFrame(list(enumerate(quotas)), "place int, quota long")
    found = {r.place: r.shards for r in source_mix.shard_quotas(df, shards).collect()}
    assert [len(found[i]) for i in range(4)] == quotas
    assert all(list(s) == sorted(s) for s in found.values())
    sizes = Counter(s for run in found.values() for s in run)
    assert max(sizes.values()) - min(sizes.get(i, 0) for i in range(shards)) <= 5


SCHEMA = "doc_id long, text string, source string, size int, copies int, _key string, _goals int"


def test_odd_rows_and_clashing_columns(spark):
    rows = [
        (1, "a b c", "x", 1, 1, "k", 1),
        (1, "a b c", "x", 1, 1, "k", 1),
        (None, None, None, 1, 1, "k", 1),
        (2, "", None, 1, 1, "k", 1),
        (3, "w " * 100_000, "y", 1, 1, "k", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = source_mix.mix_sources(docs)
    assert found.columns == [*docs.columns, "_size", "source_size", "target", "taken", "_copies"]
    assert sorted(r["_size"] for r in found.collect()) == [0, 0, 3, 3, 100_000]
    mixed = source_mix.mixed(docs)
    assert mixed.columns == docs.columns
    assert {r.source for r in mixed.collect()} >= {"x", "y"}
    assert source_mix.mix_sources(docs.limit(0)).collect() == []
    assert source_mix.mixed(docs.limit(0)).collect() == []


def test_shards_are_disjoint_runs_of_blocks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mix = Mix(words_per_shard=5000, blocks_per_shard=8)
    rows = source_mix.mix_sources(docs, mix).collect()
    total = sum(r.taken for r in rows)
    blocks, words = {}, Counter()
    for r in rows:
        for copy in r.copies:
            blocks.setdefault((r.source, copy.block), set()).add(copy.shard)
            words[copy.shard] += r["size"]
    assert all(len(shards) == 1 for shards in blocks.values())
    assert len(words) > 5
    assert max(words.values()) < 3 * total / len(words)
    for source in {s for s, _ in blocks}:
        shards = [min(blocks[key]) for key in sorted(k for k in blocks if k[0] == source)]
        assert shards == sorted(shards)


def test_mixed_repeats_rows_as_often_as_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = Counter({r.doc_id: len(r.copies) for r in source_mix.mix_sources(docs).collect()})
    assert Counter(r.doc_id for r in source_mix.mixed(docs).collect()) == +expected
