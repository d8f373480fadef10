import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrose.llm import vector_search
from windrose.llm.vector_search import Graph, Search, nearest

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, rank string, node int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2) for r in rows], SCHEMA)


def exact(rows, queries, top):
    """Per query the nearest by definition, ties to smaller ids."""
    found = {}
    for query_id in queries:
        own = np.array(rows[query_id], float)
        others = [
            (-float((np.array(v, float) * own).sum()), i)
            for i, v in rows.items()
            if i != query_id and len(v) == len(own)
        ]
        found[query_id] = [(i, -s) for s, i in sorted(others)[:top]]
    return found


def results(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def test_query_recall(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    truth = exact(rows, [i for i in rows if i % 20 == 0], 20)
    found = results(vector_search.op1_vector_search(spark, SF))
    assert found.keys() == truth.keys()
    hits = sum(len({i for i, _ in truth[q]} & {i for i, _ in found[q]}) for q in truth)
    assert hits >= 0.99 * 20 * len(truth)
    for q, near in found.items():
        own = np.array(rows[q], float)
        assert len(near) == 20
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        for i, score in near:
            assert score == pytest.approx(float((np.array(rows[i], float) * own).sum()), abs=1e-15)


@pytest.mark.parametrize("longest", [(3000.0,), (1e20,), (3000.0, 1e20, 1e-20, 1e150)])
def test_recall_beside_long_vectors(spark, longest):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(2000, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    for i, length in enumerate(longest):
        base[i + 1] *= length
    rows = {i: v.tolist() for i, v in enumerate(base)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    truth = exact(rows, [i for i in rows if i % 40 == 0], 20)
    found = results(nearest(df, F.col("vec_id") % 40 == 0, Search(least_shards=1)))
    hits = sum(len({i for i, _ in truth[q]} & {i for i, _ in found[q]}) for q in truth)
    assert hits >= 0.95 * 20 * len(truth)


def test_unequal_lengths_and_copies(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 8)) * rng.lognormal(size=(300, 1))
    rows = {i: [float(np.float32(x)) for x in base[i]] for i in range(300)}
    rows |= {i: rows[17] for i in range(300, 600)} | {i: [float(i), 1.0] for i in range(600, 610)}
    df = frame(spark, list(rows.items()))
    how = Search(least_shards=3, search_beam=128)
    truth = exact(rows, [i for i in rows if i % 5 == 0], 20)
    found = results(nearest(df, F.col("vec_id") % 5 == 0, how))
    assert found.keys() == truth.keys()
    hits = sum(len({i for i, _ in truth[q]} & {i for i, _ in found[q]}) for q in truth)
    assert hits >= 0.99 * sum(map(len, truth.values()))
    assert [i for i, _ in found[605]] == [609, 608, 607, 606, 604, 603, 602, 601, 600]


def test_rows_that_take_no_part(spark):
    good = [(1, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (40, [0.0, 1.0]), (41, [1.0, 0.0])]
    bad = [(0, None), (60, []), (80, [0.0, 0.0]), (100, [None, 1.0]), (120, [math.nan, 1.0]), (140, [math.inf, 1.0]), (None, [1.0, 1.0]), (160, [1.0])]
    found = results(nearest(frame(spark, good + bad), F.col("vec_id") % 20 == 0))
    assert found == {20: [(1, 0.5), (40, 0.5), (41, 0.5)], 40: [(20, 0.5), (1, 0.0), (41, 0.0)]}
    assert results(nearest(frame(spark, bad[:3]), F.col("vec_id") % 20 == 0)) == {}
    assert results(nearest(frame(spark, []), F.col("vec_id") % 20 == 0)) == {}


@pytest.mark.parametrize("count", [1, 2, 3, 40, 1500])
def test_graph_is_connected_and_flat(count):
    rng = np.random.default_rng(count)
    vectors = rng.normal(size=(count, 12)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    how = Search()
    graph = Graph.built(vectors, how)
    assert [len(x) for x in graph.layers] == Graph.sizes(count, how)
    for level, layer in enumerate(graph.layers):
        assert layer.shape[1] == how.links * (2 if level == 0 else 1)
        assert layer.max() < len(layer)
        for node, row in enumerate(layer):
            real = row[row >= 0].tolist()
            assert node not in real
            assert len(real) == len(set(real))
    found = graph.search(vectors[: min(count, 200)], 64)
    assert (found[:, 0] == np.arange(min(count, 200))).mean() >= 0.99
