"""How far the sources of a language differ in their use of words, by hash-consed segment trees.

The kept terms of a language (those in at least `documents` of its documents) are dealt over blocks:
classes of similar frequency, split by hash into about `terms_per_block` terms. In a block the terms are
numbered by falling frequency, and each source's counts are the leaves of a binary segment tree over those
numbers. Nodes are hash-consed level by level: subtrees of equal counts, of whatever source or place, are
one node, and the subtree without occurrences is node 0. Two sources are compared by a simultaneous
traversal from their roots that goes on once for each distinct pair of nodes, with the number of places
where the pair occurs; pairs of empty subtrees are left at once. At the leaves each distinct pair of counts
is priced once. The trees of the blocks are the lower parts of a language's trees: their totals are added
up by Spark, which also prices the terms that neither source has, all alike, in one step.

A block's task holds the counts of its terms for two tiles of about `sources_per_tile` sources each; a
language with more sources has a row of each block for each pair of tiles. Occurrences are counted and
merged within each task before they are shuffled by (language, term), so no term or source is a hot key.

A term's share in a group is p = 1 + floor(SCALE * (count + 2) / (N + 2 V)) with N the group's occurrences
of kept terms and V their number, and the price of a term is floor((p - q)^2 / (p + q)). All of it is exact:
Spark uses decimals, the tasks 64-bit integers and Python's own where those do not suffice.

Defined results: null text, language and source are ''. Each row of the table is a document, also if its
doc_id is repeated or null. A group without terms has count 0 for all terms; in a language without kept
terms all pairs have value 0. A source alone in its language has no pairs. Equal values are ranked by item
in byte order. An empty table gives no rows. `docs` may have more columns.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrose.llm.common import prepare, stored, table
from windrose.llm.words import ByteRule, Words, merged_keys, word_chunks

SCALE = 1_000_000_000
_LETTERS = {*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)}
#: Terms are runs of ASCII letters and of characters beyond ASCII.
TERMS = ByteRule(bytes(b for b in range(128) if b not in _LETTERS))
_KEPT_ROWS = 1_000_000
_PAIRS = 256


@dataclass(frozen=True)
class Audit:
    documents: int = 10
    terms_per_block: int = 2048
    sources_per_tile: int = 64
    top_terms: int = 10


PRODUCTION = Audit()

_COUNTED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


class _Counter:
    """Occurrences and documents of (group, term), merged whenever many rows have come together."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[pa.Table] = []
        self.rows = 0
        self.seen: set[str] = set()
        self.open_row = -1

    def number(self, lang: str | None, source: str | None) -> int:
        return self.groups.setdefault((lang or "", source or ""), len(self.groups))

    def add(self, words: Words, group: np.ndarray) -> None:
        size = len(words.terms)
        in_row, counts = np.unique(words.rows * size + words.ids, return_counts=True)
        row, term = np.divmod(in_row, size)
        new = np.ones(len(row), np.int64)
        first, last = row[0], row[-1]
        if not words.continued or first != self.open_row:
            self.seen = set()
        if self.seen or first == last:
            self._once(words.terms, row == first, term, new)
        if first != last:
            # Only the last row may go on in the next chunk, where its terms do not count again.
            self.seen = set()
            self._once(words.terms, row == last, term, new)
        self.open_row = last
        keys, n, docs = merged_keys(group[row] * size + term, counts, new)
        owner, term = np.divmod(keys, size)
        self.parts.append(
            pa.table([pa.array(owner), words.terms.take(pa.array(term)), pa.array(n), pa.array(docs)], ["group", "term", "n", "docs"])
        )
        self.rows += len(keys)

    def _once(self, terms: pa.Array, mine: np.ndarray, term: np.ndarray, new: np.ndarray) -> None:
        at = np.flatnonzero(mine)
        for i, word in zip(at, terms.take(pa.array(term[at])).to_pylist(), strict=True):
            if word in self.seen:
                new[i] = 0
            self.seen.add(word)

    def merge(self) -> None:
        whole = pa.concat_tables(self.parts)
        found = pa.TableGroupBy(whole, ["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
        self.parts = [found.select(["group", "term", "n_sum", "docs_sum"]).rename_columns(["group", "term", "n", "docs"])]
        self.rows = found.num_rows

    def drain(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self.merge()
            langs, sources = (pa.array(values, pa.string()) for values in zip(*self.groups, strict=True))
            found = self.parts[0]
            rows = pa.table(
                [langs.take(found["group"]), sources.take(found["group"]), found["term"].cast(pa.string()), found["n"], found["docs"]],
                schema=_COUNTED,
            )
            yield from rows.to_batches(max_chunksize=50_000)
        self.parts, self.rows = [], 0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counter, merge_at = _Counter(), _KEPT_ROWS
    for batch in batches:
        langs, sources = (batch.column(c).to_pylist() for c in ("lang", "source"))
        group = np.array([counter.number(*pair) for pair in zip(langs, sources, strict=True)], np.int64)
        for words in word_chunks(batch.column("text"), TERMS):
            counter.add(words, group)
            if counter.rows >= merge_at:
                counter.merge()
                if counter.rows > _KEPT_ROWS // 2:
                    yield from counter.drain()
    yield from counter.drain()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, several rows for a key."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"))
    return texts.mapInArrow(_count, "lang string, source string, term string, n long, docs long")


def _share(count: str, total: str, terms: str) -> Column:
    """The scaled share of a term, exact for all 64-bit counts; null if there are no terms."""
    scaled = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS DECIMAL(20,0))"
    return F.expr(f"1 + ({scaled}) DIV CAST(NULLIF({total} + 2 * {terms}, 0) AS DECIMAL(20,0))")


def _price(p: str, q: str) -> Column:
    """Shares are at most SCALE + 1, so the square fits 64 bits."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def shares(counts: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """The same in tasks; Python integers if a product may pass 64 bits."""
    if len(counts) and int(counts.max()) + 2 > (1 << 62) // SCALE:
        counts, total = counts.astype(object), total.astype(object)
    return (1 + SCALE * (counts + 2) // (total + 2 * terms)).astype(np.int64)


def consed(counts: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Trees over the rows of `counts`, whose number of columns is a power of two, with shared nodes.

    Returns the distinct counts, which are the nodes of level 0; for each level above the left and right
    children of its nodes; and the root of each row. Node 0 of a level is the subtree without occurrences.
    """
    values, nodes = np.unique(np.append(0, counts.ravel()), return_inverse=True)
    nodes, size, levels = nodes[1:].reshape(counts.shape), len(values), []
    while nodes.shape[1] > 1:
        pairs = nodes[:, 0::2] * size + nodes[:, 1::2]
        distinct, above = np.unique(np.append(0, pairs.ravel()), return_inverse=True)
        levels.append(np.divmod(distinct, size))
        nodes, size = above[1:].reshape(pairs.shape), len(distinct)
    return values, levels, nodes[:, 0]


def node_pairs(
    levels: list[tuple[np.ndarray, np.ndarray]], left: np.ndarray, right: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Traverses the trees of root pairs at once, down to the leaves.

    Returns pair number, leaf of the left tree, leaf of the right one, and at how many places; each such
    pair once, without pairs of empty leaves. On the way equal pairs of nodes are gone through once.
    """
    pair, times = np.arange(len(left)), np.ones(len(left), np.int64)
    some = (left > 0) | (right > 0)
    pair, left, right, times = pair[some], left[some], right[some], times[some]
    places = len(levels) + 1
    for level in reversed(range(len(levels))):
        lefts, rights = levels[level]
        pair, times = np.concatenate([pair, pair]), np.concatenate([times, times])
        left = np.concatenate([lefts[left], rights[left]])
        right = np.concatenate([lefts[right], rights[right]])
        some = (left > 0) | (right > 0)
        pair, left, right, times = pair[some], left[some], right[some], times[some]
        nodes = int(max(left.max(initial=0), right.max(initial=0))).bit_length()
        if len(pair) and int(pair.max()).bit_length() + 2 * nodes + places <= 63:
            # Pair, nodes and times in one number: sorted, equal pairs lie side by side.
            key = np.sort((((pair << nodes | left) << nodes | right) << places) | times)
            first = np.flatnonzero(np.concatenate([[True], (key[1:] >> places) != (key[:-1] >> places)]))
            times = np.add.reduceat(key & ((1 << places) - 1), first)
            key = key[first] >> places
            pair, left, right = key >> (2 * nodes), key >> nodes & ((1 << nodes) - 1), key & ((1 << nodes) - 1)
    return pair, left, right, times


_DISTANCES = "lang string, a string, b string, value long, visited long"


def _distances(block: pa.Table) -> pa.Table:
    """The parts of all distances between sources that a block's terms make up."""
    heads, rows = block.filter(pc.is_null(block["term"])), block.filter(pc.is_valid(block["term"]))
    head = heads.slice(0, 1).to_pylist()[0]
    members = sorted(head["entries"], key=lambda m: m["source"].encode())
    names = pa.array([m["source"] for m in members], pa.string())
    totals = np.array([m["n"] for m in members], np.int64)
    tiles = np.array([m["tile"] for m in members])
    rows = rows.sort_by([("total", "descending"), ("term", "ascending")]).combine_chunks()
    entries = rows["entries"].combine_chunks()
    place = np.repeat(np.arange(len(rows)), pc.list_value_length(entries).to_numpy(zero_copy_only=False))
    flat = entries.flatten()
    owner = pc.index_in(flat.field("source"), names).to_numpy(zero_copy_only=False)
    counts = np.zeros((len(members), 1 << max(0, len(rows) - 1).bit_length()), np.int64)
    counts[owner, place] = flat.field("n").to_numpy(zero_copy_only=False)
    values, levels, roots = consed(counts)
    a, b = np.triu_indices(len(members), 1)
    if head["tile_a"] != head["tile_b"]:
        across = tiles[a] != tiles[b]
        a, b = a[across], b[across]
    value, visited = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for start in range(0, len(a), _PAIRS):
        pa_, pb_ = a[start : start + _PAIRS], b[start : start + _PAIRS]
        pair, left, right, times = node_pairs(levels, roots[pa_], roots[pb_])
        p = shares(values[left], totals[pa_][pair], head["terms"])
        q = shares(values[right], totals[pb_][pair], head["terms"])
        np.add.at(value, start + pair, (p - q) ** 2 // (p + q) * times)
        np.add.at(visited, start + pair, times)
    return pa.table(
        {
            "lang": pa.array([head["lang"]] * len(a), pa.string()),
            "a": names.take(pa.array(a)),
            "b": names.take(pa.array(b)),
            "value": value,
            "visited": visited,
        }
    )


def _blocks(terms: DataFrame, langs: DataFrame, groups: DataFrame, how: Audit) -> DataFrame:
    """The rows of the blocks' tasks: terms with their counts by source, and a head with all sources."""
    level = F.floor(2 * F.log2(F.col("total"))).cast("int")
    classed = terms.withColumn("class", level)
    slices = classed.groupBy("lang", "class").agg(F.ceil(F.count("*") / how.terms_per_block).alias("slices"))
    tiles = F.col("tiles").cast("int")

    def tile(source: Column) -> Column:
        return F.pmod(F.xxhash64(source), F.col("tiles")).cast("int")

    def tile_pairs(df: DataFrame) -> DataFrame:
        numbers = F.sequence(F.lit(0), tiles - 1)
        paired = F.flatten(
            F.transform(
                numbers,
                lambda i: F.transform(F.sequence(i, tiles - 1), lambda j: F.struct(i.alias("a"), j.alias("b"))),
            )
        )
        return df.select("*", F.explode(paired).alias("_pair")).select(
            "*", F.col("_pair.a").alias("tile_a"), F.col("_pair.b").alias("tile_b")
        )

    def within(entry: Column) -> Column:
        return (entry["tile"] == F.col("tile_a")) | (entry["tile"] == F.col("tile_b"))

    shape = langs.select("lang", "terms", "tiles")
    dealt = classed.join(slices, ["lang", "class"]).join(shape, "lang")
    dealt = tile_pairs(dealt.withColumn("slice", F.pmod(F.xxhash64("term"), F.col("slices"))))
    tiled = F.transform(
        "by_source",
        lambda e: F.struct(e["source"].alias("source"), e["n"].alias("n"), tile(e["source"]).alias("tile")),
    )
    key = ["lang", "class", "slice", "tile_a", "tile_b"]
    leaves = dealt.select(*key, "terms", "total", "term", F.filter(tiled, within).alias("entries"))
    members = groups.join(shape, "lang").select("lang", "terms", "tiles", "source", "n", tile(F.col("source")).alias("tile"))
    members = members.groupBy("lang", "terms", "tiles").agg(F.collect_list(F.struct("source", "n", "tile")).alias("by_tile"))
    whole = slices.select("lang", "class", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    heads = tile_pairs(members).join(whole, "lang")
    heads = heads.select(
        *key, "terms", F.lit(None).cast("long").alias("total"), F.lit(None).cast("string").alias("term"),
        F.filter("by_tile", within).alias("entries"),
    )
    return leaves.unionByName(heads)


def divergences(docs: DataFrame, how: Audit = PRODUCTION) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module."""
    spark = prepare(docs.sparkSession)
    named = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    # One shuffle by (lang, term) serves both groupings.
    counted = (
        term_counts(named)
        .repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .groupBy("lang", "term")
        .agg(
            F.sum("n").alias("total"),
            F.sum("docs").alias("docs"),
            F.collect_list(F.struct("source", "n")).alias("by_source"),
        )
        .filter(F.col("docs") >= how.documents)
        .select("lang", "term", "total", "by_source")
    )
    terms, _ = stored(counted, "audit-terms")
    by_source = terms.select("lang", F.explode("by_source").alias("_e")).select("lang", "_e.source", "_e.n")
    groups = (
        named.select("lang", "source", F.lit(0).cast("long").alias("n"))
        .unionByName(by_source)
        .groupBy("lang", "source")
        .agg(F.sum("n").alias("n"))
    )
    groups, _ = stored(groups, "audit-groups")
    kept = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("total"))
    langs = (
        groups.groupBy("lang")
        .agg(F.ceil(F.count("*") / how.sources_per_tile).alias("tiles"))
        .join(kept, "lang", "left")
        .fillna(0, ["terms", "total"])
    )
    langs, _ = stored(langs, "audit-languages")

    found = (
        _blocks(terms, langs, groups, how)
        .groupBy("lang", "class", "slice", "tile_a", "tile_b")
        .applyInArrow(_distances, _DISTANCES)
        .groupBy("lang", "a", "b")
        .agg(F.sum("value").alias("value"), F.sum("visited").alias("visited"))
    )
    one = groups.join(langs.select("lang", "terms"), "lang").withColumn("empty", _share("0", "n", "terms"))
    other = groups.join(langs.select("lang", "terms"), "lang").select(
        "lang", F.col("source").alias("b"), _share("0", "n", "terms").alias("other_empty")
    )
    paired = (
        one.select("lang", F.col("source").alias("a"), "terms", "empty")
        .join(other, "lang")
        .filter(F.col("a") < F.col("b"))
        .join(found, ["lang", "a", "b"], "left")
        .fillna(0, ["value", "visited"])
        .withColumn("rest", (F.col("terms") - F.col("visited")) * _price("empty", "other_empty"))
        .select("lang", "a", "b", (F.col("value") + F.coalesce("rest", F.lit(0))).cast("long").alias("value"))
    )
    pairs = paired.select(
        "lang",
        F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("_p"),
        "value",
    ).select("lang", "_p.source", F.lit("pair").alias("part"), "_p.item", "value")

    overall = terms.join(langs.select("lang", "terms", F.col("total").alias("occurrences")), "lang")
    used = (
        overall.select("lang", "term", "terms", _share("total", "occurrences", "terms").alias("q"), F.explode("by_source").alias("_e"))
        .select("lang", "term", "terms", "q", "_e.source", F.col("_e.n").alias("count"))
        .join(groups, ["lang", "source"])
        .withColumn("p", _share("count", "n", "terms"))
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _price("p", "q").alias("value"))
    )

    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(by_value)) for df in (pairs, used)]
    return ranked[0].unionByName(ranked[1].filter(F.col("rank") <= how.top_terms))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergences(table(spark, folder, "documents"))


_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*)::HUGEINT AS c FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 10
), sizes AS (
  SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM kept GROUP BY lang
), sources AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT w.lang, w.source, w.term, count(*)::HUGEINT AS c
  FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY w.lang, w.source, w.term
), totals AS (
  SELECT s.lang, s.source, coalesce(sum(c.c), 0)::HUGEINT AS n
  FROM sources s LEFT JOIN counts c ON s.lang = c.lang AND s.source = c.source GROUP BY s.lang, s.source
), p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.c, 0) AS c,
         1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (t.n + 2 * z.v) AS p,
         1 + (1000000000::HUGEINT * (k.c + 2)) // (z.n + 2 * z.v) AS q
  FROM totals t JOIN kept k ON t.lang = k.lang JOIN sizes z ON t.lang = z.lang
  LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), compared AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(c.value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM p WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

QUERIES = {"op12_source_divergence": op12_source_divergence}
ORACLE_SQL = {"op12_source_divergence": _SQL}
