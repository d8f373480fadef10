"""Approximate nearest neighbours by inner product: a small-world graph per shard, results merged.

Equal vectors are one graph node with the smallest ids that carry them, so a vector with a third of all
rows is one node, and equal scores come out in the order of ids. Nodes are dealt to shards by their length
in bands of a factor of 16, and by a hash within a band, so that no long vector blurs a shard of short ones.
Each shard is one hierarchical navigable small-world graph, kept as flat arrays: nodes are numbered from
the highest layer down, so layer l is a matrix of neighbour numbers for its first n_l nodes. The graphs
are written to the shared folder; then every query visits every shard, a shard's task loading its graph
once and taking queries in blocks, and the best of all shards are kept. Searching and building advance
many vectors at once, one step of the beam for all of them.

Largest inner product becomes nearest neighbour by one more component that gives all vectors of a shard
equal length (zero for queries). For the graph, a shard's vectors and each query are scaled to lengths of
1 at most. Reported scores are inner products of the given vectors in doubles.

Bounds: a shard holds about `rows_per_shard` nodes, at most `top` + 1 ids are kept for a node (more
cannot be reported), queries come in batches. The number of shards grows with the rows; lengths over the
whole range of doubles add some 540 small ones at most.

Defined results: rows whose id or vector is null, and vectors that are empty, zero or hold null or
non-finite components take no part; vectors meet only vectors of their length; repeated rows count once,
an id with several vectors by the smallest; with fewer candidates all are returned; no rows give no rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrose.llm.common import discard, prepare, stored, table


@dataclass(frozen=True)
class Search:
    """`links` neighbours per node and layer, twice as many in the lowest one."""

    top: int = 20
    rows_per_shard: int = 65_536
    least_shards: int = 16
    links: int = 16
    build_beam: int = 64
    search_beam: int = 96
    batch: int = 512
    seed: int = 11


PRODUCTION = Search()
#: Beam entries that are expanded in one step, and new links a node takes from one batch.
_WIDTH = 4
#: Lengths in one shard differ by less than two to this; lengths near 1 lie in the middle of a band.
_BAND_DOUBLINGS = 4
_MOST_SHARDS = 1_000_000_000
_NEW_LINKS = 16


def beam_search(
    vectors: np.ndarray, layer: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The `beam` best nodes found from `entry` for each query and their products, best first.

    Empty places have node -1 and product -inf. A query ends when all nodes in its beam are expanded.
    """
    count, nodes = len(queries), len(layer)
    found = np.full((count, beam), -1, np.int32)
    products = np.full((count, beam), -np.inf, np.float32)
    open_ = np.zeros((count, beam), bool)
    seen = np.zeros(count * nodes, bool)
    found[:, 0], open_[:, 0] = entry, True
    products[:, 0] = np.einsum("ij,ij->i", queries, vectors[entry])
    seen[np.arange(count) * nodes + entry] = True
    while open_.any():
        chosen = open_ & (np.cumsum(open_, axis=1) <= _WIDTH)
        open_ &= ~chosen
        query, place = np.nonzero(chosen)
        near = layer[found[query, place]]
        key = np.unique((query[:, None] * nodes + near)[near >= 0])
        key = key[~seen[key]]
        seen[key] = True
        query, node = np.divmod(key, nodes)
        product = np.einsum("ij,ij->i", queries[query], vectors[node])
        better = product > products[query, -1]
        query, node, product = query[better], node[better], product[better]
        if not len(query):
            continue
        # The new nodes of a query as a row, beside its beam.
        first = np.searchsorted(query, np.arange(count))
        column = np.arange(len(query)) - first[query]
        width = int(column.max()) + 1
        new = np.full((count, width), -1, np.int32)
        new_products = np.full((count, width), -np.inf, np.float32)
        new[query, column], new_products[query, column] = node, product
        all_products = np.concatenate([products, new_products], axis=1)
        order = np.argsort(-all_products, axis=1, kind="stable")[:, :beam]
        products = np.take_along_axis(all_products, order, axis=1)
        found = np.take_along_axis(np.concatenate([found, new], axis=1), order, axis=1)
        open_ = np.take_along_axis(np.concatenate([open_, new >= 0], axis=1), order, axis=1)
    return found, products


def _diverse(vectors: np.ndarray, nodes: np.ndarray, products: np.ndarray, links: int) -> np.ndarray:
    """Of each row of nodes, best first, those nearer to the row's owner than to any kept before.

    Rows are filled up with the best of the others.
    """
    size = nodes.shape[1]
    own = vectors[np.maximum(nodes, 0)]
    between = own @ own.transpose(0, 2, 1)
    real = nodes >= 0
    kept = np.zeros(nodes.shape, bool)
    for i in range(size):
        close = (kept & (between[:, i, :] >= products[:, i, None])).any(axis=1)
        kept[:, i] = real[:, i] & ~close & (kept.sum(axis=1) < links)
    order = np.argsort(np.where(kept, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :links]
    return np.take_along_axis(nodes, order, axis=1)


class Graph:
    """Vectors of equal length in a hierarchy of layers; `layers[l]` holds neighbours, -1 for none."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]) -> None:
        self.vectors, self.layers = vectors, layers

    @staticmethod
    def sizes(count: int, how: Search) -> list[int]:
        """Nodes of each layer, lowest first: each node climbs on with a chance of 1 / links."""
        drawn = np.random.default_rng(how.seed).random(count)
        levels = np.floor(-np.log(1 - drawn) / np.log(how.links)).astype(int)
        return [int((levels >= level).sum()) for level in range(int(levels.max()) + 1)]

    @staticmethod
    def built(vectors: np.ndarray, how: Search) -> "Graph":
        sizes = Graph.sizes(len(vectors), how)
        widths = [2 * how.links if level == 0 else how.links for level in range(len(sizes))]
        layers = [np.full((n, w), -1, np.int32) for n, w in zip(sizes, widths, strict=True)]
        graph = Graph(vectors, layers)
        start = 1
        while start < len(vectors):
            end = min(len(vectors), start + min(how.batch, start))
            graph._insert(start, end, how)
            start = end
        return graph

    def _insert(self, start: int, end: int, how: Search) -> None:
        entry = np.zeros(end - start, np.int32)
        batch = self.vectors[start:end]
        for layer in reversed(self.layers):
            active = max(0, min(end, len(layer)) - start)
            if active < end - start:
                found, _ = beam_search(self.vectors, layer, batch[active:], entry[active:], 1)
                entry[active:] = found[:, 0]
            if active:
                found, products = beam_search(
                    self.vectors, layer, batch[:active], entry[:active], how.build_beam
                )
                entry[:active] = found[:, 0]
                self._link(layer, start, active, found, products, how)

    def _link(self, layer, start, active, found, products, how: Search) -> None:
        """Ties nodes start..start+active to nodes found in the graph and to each other."""
        own = self.vectors[start : start + active]
        among = own @ own.T
        np.fill_diagonal(among, -np.inf)
        best = np.argsort(-among, axis=1)[:, : how.build_beam]
        both = np.concatenate([found, (best + start).astype(np.int32)], axis=1)
        near = np.concatenate([products, np.take_along_axis(among, best, axis=1)], axis=1)
        both[~np.isfinite(near)] = -1
        order = np.argsort(-near, axis=1, kind="stable")[:, : how.build_beam]
        both, near = (np.take_along_axis(x, order, axis=1) for x in (both, near))
        chosen = _diverse(self.vectors, both, near, how.links)
        layer[start : start + active, : chosen.shape[1]] = chosen

        owner = np.repeat(np.arange(start, start + active, dtype=np.int32), chosen.shape[1])
        target, real = chosen.ravel(), chosen.ravel() >= 0
        self._link_back(layer, target[real], owner[real])

    def _link_back(self, layer: np.ndarray, target: np.ndarray, owner: np.ndarray) -> None:
        """Adds owner to the neighbours of target; full rows keep a diverse choice."""
        known = (layer[target] == owner[:, None]).any(axis=1)
        target, owner = target[~known], owner[~known]
        product = np.einsum("ij,ij->i", self.vectors[target], self.vectors[owner])
        order = np.lexsort((-product, target))
        target, owner = target[order], owner[order]
        nodes, first = np.unique(target, return_index=True)
        row = np.searchsorted(nodes, target)
        column = np.arange(len(target)) - first[row]
        taken = column < _NEW_LINKS
        new = np.full((len(nodes), _NEW_LINKS), -1, np.int32)
        new[row[taken], column[taken]] = owner[taken]
        width = layer.shape[1]
        for at in range(0, len(nodes), 512):
            some = nodes[at : at + 512]
            both = np.concatenate([layer[some], new[at : at + 512]], axis=1)
            near = np.einsum("ij,ikj->ik", self.vectors[some], self.vectors[np.maximum(both, 0)])
            near[both < 0] = -np.inf
            order = np.argsort(-near, axis=1, kind="stable")
            both, near = (np.take_along_axis(x, order, axis=1) for x in (both, near))
            full = (both >= 0).sum(axis=1) > width
            layer[some[~full]] = both[~full, :width]
            if full.any():
                layer[some[full]] = _diverse(self.vectors, both[full], near[full], width)

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        entry = np.zeros(len(queries), np.int32)
        for layer in reversed(self.layers[1:]):
            entry = beam_search(self.vectors, layer, queries, entry, 1)[0][:, 0]
        return beam_search(self.vectors, self.layers[0], queries, entry, beam)[0]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Divided by powers of two to lengths of 1 at most, one power for each row."""
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    lengths = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return np.ldexp(vectors, -np.frexp(lengths)[1][:, None])


def _levelled(vectors: np.ndarray) -> np.ndarray:
    """Scaled alike, and one more component, so that all have the length of the longest."""
    vectors = np.ldexp(vectors, -np.frexp(np.abs(vectors).max())[1])
    squares = np.einsum("ij,ij->i", vectors, vectors)
    longest = np.sqrt(squares.max())
    rest = np.sqrt(np.maximum(0, squares.max() - squares))
    return (np.concatenate([vectors, rest[:, None]], axis=1) / longest).astype(np.float32)


_INDEX = "dim int, shard long, vectors binary, layers array<binary>, ids binary, owners binary"


def _build(how: Search):
    def build(group: pa.Table) -> pa.Table:
        dim, shard = group.column("dim")[0].as_py(), group.column("shard")[0].as_py()
        lists = group.column("vector").combine_chunks()
        vectors = lists.flatten().to_numpy().reshape(-1, dim)
        members = group.column("ids").combine_chunks()
        order = np.argsort(group.column("node").to_numpy(), kind="stable")
        vectors = vectors[order]
        lengths = members.value_lengths().to_numpy()
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        flat = members.flatten().to_numpy()
        ids = np.concatenate([flat[offsets[i] : offsets[i + 1]] for i in order])
        owners = np.repeat(np.arange(len(order), dtype=np.int32), lengths[order])
        graph = Graph.built(_levelled(vectors), how)
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "shard": pa.array([shard], pa.int64()),
                "vectors": pa.array([vectors.astype(np.float64).tobytes()], pa.binary()),
                "layers": pa.array([[x.tobytes() for x in graph.layers]], pa.list_(pa.binary())),
                "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                "owners": pa.array([owners.tobytes()], pa.binary()),
            }
        )

    return build


class _Shard:
    """A shard's graph, read from its flat arrays."""

    def __init__(self, row: dict, how: Search) -> None:
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
        layers = [
            np.frombuffer(data, np.int32).reshape(-1, how.links * (2 if level == 0 else 1))
            for level, data in enumerate(row["layers"])
        ]
        self.graph = Graph(_levelled(self.vectors), layers)
        self.ids = np.frombuffer(row["ids"], np.int64)
        owners = np.frombuffer(row["owners"], np.int32)
        self.bounds = np.searchsorted(owners, np.arange(len(self.vectors) + 1))

    def best(self, queries: np.ndarray, how: Search) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the best top + 1 of each query (one of them may be the query itself)."""
        levelled = np.concatenate([_scaled(queries), np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        found = self.graph.search(levelled, max(how.search_beam, 2 * how.top))
        results = []
        for query, nodes in zip(queries, found, strict=True):
            nodes = nodes[nodes >= 0]
            scores = (self.vectors[nodes] * query).sum(axis=1)
            spans = [self.ids[self.bounds[n] : self.bounds[n + 1]] for n in nodes]
            ids = np.concatenate(spans)
            scores = np.repeat(scores, [len(s) for s in spans])
            order = np.lexsort((ids, -scores))[: how.top + 1]
            results.append((ids[order], scores[order]))
        return results


def _visit(how: Search):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, key = None, None
        for batch in batches:
            rows = batch.to_pylist()
            at = 0
            while at < len(rows):
                row = rows[at]
                if row["vectors"] is not None:
                    shard, key = _Shard(row, how), (row["dim"], row["shard"])
                    at += 1
                    continue
                end = at
                while end < len(rows) and rows[end]["vectors"] is None and end - at < how.batch:
                    if (rows[end]["dim"], rows[end]["shard"]) != (row["dim"], row["shard"]):
                        break
                    end += 1
                some, at = rows[at:end], end
                if key != (row["dim"], row["shard"]):
                    continue  # a shard without any node
                best = shard.best(np.array([r["query"] for r in some], np.float64), how)
                sizes = [len(ids) for ids, _ in best]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([r["query_id"] for r in some], sizes), pa.int64()),
                        pa.array(np.concatenate([ids for ids, _ in best]), pa.int64()),
                        pa.array(np.concatenate([scores for _, scores in best]), pa.float64()),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return visit


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, vector array<double>) of the rows that take part, one for each id."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.where(F.col("vec_id").isNotNull() & finite & F.exists(vector, lambda x: x != 0.0))
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min(vector).alias("vector"))
    )


def _band(vector: Column) -> Column:
    """The band of a vector's length, from logarithms that no length exceeds."""
    most = F.array_max(F.transform(vector, F.abs))
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + (x / most) * (x / most))
    doublings = F.log2(most) + F.log2(squares) / 2
    return F.floor(doublings / _BAND_DOUBLINGS + 0.5).cast("long")


def nearest(rows: DataFrame, is_query: Column, how: Search = PRODUCTION) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` nearest rows found for each query row.

    `rows` has vec_id and embedding; `is_query` is a condition on vec_id. Candidates are all rows but the
    query's own.
    """
    spark = prepare(rows.sparkSession)
    vectors, vectors_path = stored(usable(rows), "vectors")
    # Spark keeps the first ids of a vector before the shuffle.
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = (
        vectors.withColumn("rank", rank)
        .where(F.col("rank") <= how.top + 1)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(
            F.size("vector").alias("dim"), _band(F.col("vector")).alias("band"), F.col("ids")[0].alias("node"), "ids", "vector"
        )
    )
    nodes, nodes_path = stored(nodes, "nodes")
    bands = nodes.groupBy("dim", "band").agg(F.count("*").alias("count"))
    share = F.least(F.lit(float(how.rows_per_shard)), F.sum("count").over(Window.partitionBy("dim")) / how.least_shards)
    dims = bands.select("dim", "band", F.ceil(F.col("count") / share).alias("shards"))
    dims, dims_path = stored(dims, "shards")
    tasks = min(20_000, 4 * (dims.agg(F.sum("shards")).first()[0] or 1))
    first = F.col("band") * F.lit(_MOST_SHARDS)
    dealt = nodes.join(dims, ["dim", "band"]).select(
        "dim", (first + F.pmod(F.xxhash64("node"), "shards")).alias("shard"), "node", "ids", "vector"
    )
    index = dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInArrow(_build(how), _INDEX)
    index, _ = stored(index, "graphs")
    discard(spark, nodes_path)

    queries = (
        vectors.where(is_query)
        .select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.size("vector").alias("dim"))
        .join(dims, "dim")
        .select("dim", F.explode(F.sequence(first, first + F.col("shards") - 1)).alias("shard"), "query_id", "query")
    )
    visits = (
        index.unionByName(queries, allowMissingColumns=True)
        .repartition(tasks, "dim", "shard")
        .sortWithinPartitions("dim", "shard", F.col("vectors").isNull(), "query_id")
        .mapInArrow(_visit(how), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = (
        visits.where("query_id <> vec_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= how.top)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
    result, _ = stored(best, "nearest")
    discard(spark, vectors_path, dims_path)
    return result


def op1_vector_search(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(embeddings, F.col("vec_id") % 20 == 0)


QUERIES = {"op1_vector_search": op1_vector_search}
ORACLE_SQL: dict[str, str] = {}
