"""Mixing sources to target weights: exact block quotas split over output shards by a tree.

Each source gets a target number of words. Its documents are put in a hash order and laid end to end
on a line of words; the mix takes the documents whose middle lies before the target, the line being
walked again from its start for what goes beyond one pass. The line is cut into blocks of equal
length, so a target is an exact number of blocks (the last one cut at the target). A binary tree over
the output shards splits those quotas: at each node the left half's blocks are drawn from the node's
blocks without replacement, so the counts by source are multivariate hypergeometric. The shards then
take consecutive, hence disjoint, blocks of the permuted lines and order their rows by a hash.

Everything is expressions and joins. The only per-source tables (weights, targets, the shard of each
block) hold at most sources + shards * blocks_per_shard entries. Lines are measured by running sums in
two steps, over short hash ranges within a source and over the ranges, so no task holds a source.

Defined results: a null text has size 0; null sources form a source of their own, which comes last;
documents without words are taken or left like others and add nothing; rows that repeat an id are
documents of their own; an empty table gives no rows. The same rows give the same mix. Added columns
replace no column: they carry underscores in front if `docs` has one of that name.
"""

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from windrose.llm.common import WORD, discard, free_name, prepare, stored, table

_UNIT = float(1 << 63)
_LEAST_RANGE_ROWS = 64


@dataclass(frozen=True)
class Mix:
    """Sources by code point take `weights` in turn; together they give `share` of all words.

    No source gives more than `most` times its words. The mix has a shard for each
    `words_per_shard` words; as many times `blocks_per_shard` blocks are planned.
    """

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: int = 2
    words_per_shard: int = 1 << 22
    blocks_per_shard: int = 64
    seed: int = 7


PRODUCTION = Mix()


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """Never null, so that rows without a source meet in joins and windows."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


def _position(seed: int, *columns: Column) -> Column:
    """A pseudo-random place from 0 to 2^63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def _uniform(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def source_targets(sources: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """Adds place, weight and target to rows of (source, source_size).

    With caps c and weights w the targets are min(c, x * w) for the one x that uses up the share.
    Sources reach their cap in the order of c / w, so x follows from running sums in that order.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    everything = Window.partitionBy()
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    capped_before = F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1))
    weight_left = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    return (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.get(weights, F.col("place") % len(mix.weights)))
        .withColumn("cap", F.col("source_size") * float(mix.most))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("share", F.sum("source_size").over(everything) * mix.share)
        .withColumn("x", (F.col("share") - F.coalesce(capped_before, F.lit(0.0))) / weight_left)
        # The first source that stays at or below its cap decides.
        .withColumn("decides", F.when(F.col("x") <= F.col("ratio"), F.struct("ratio", "place", "x")))
        .withColumn("x", F.min("decides").over(everything)["x"])
        .withColumn(
            "target",
            F.coalesce(F.least("cap", F.col("x") * F.col("weight")), F.col("cap")),
        )
        .drop("cap", "ratio", "share", "x", "decides")
    )


def hypergeometric(marked: Column, total: Column, drawn: Column, *seed: Column) -> Column:
    """How many of `marked` among `total` items are in a random draw of `drawn` items.

    Walks the probabilities from the most likely count outwards, each as a multiple of its
    neighbour, and keeps each count with its share of the sum so far. Counts beyond twelve standard
    deviations, below the precision of a double, are not walked.
    """
    least = F.greatest(F.lit(0), drawn + marked - total)
    most = F.least(marked, drawn)
    mode = F.greatest(
        least, F.least(most, F.floor((marked + 1.0) * (drawn + 1.0) / (total + 2.0)))
    )
    share = marked / F.greatest(total, F.lit(1)).cast("double")
    variance = drawn * share * (1.0 - share)
    reach = F.ceil(F.sqrt(F.greatest(variance, F.lit(0.0))) * 12.0) + 20
    rest = total - marked - drawn

    def walk(start: Column, counts: Column, ratio) -> Column:
        def step(state: Column, count: Column) -> Column:
            weight = state["weight"] * ratio(count)
            sum_ = state["sum"] + weight
            kept = _uniform(*seed, count) * sum_ < weight
            return F.struct(
                weight.alias("weight"),
                sum_.alias("sum"),
                F.when(kept, count).otherwise(state["count"]).alias("count"),
            )

        return F.aggregate(counts, start, step)

    def counts(first: Column, last: Column, step: int) -> Column:
        some = first <= last if step > 0 else first >= last
        return F.when(some, F.sequence(first, last, F.lit(step).cast("long"))).otherwise(
            F.expr("CAST(array() AS array<bigint>)")
        )

    one = F.lit(1.0)
    upwards = walk(
        F.struct(one.alias("weight"), one.alias("sum"), mode.alias("count")),
        counts(mode + 1, F.least(most, mode + reach), 1),
        lambda c: (marked - c + 1.0) * (drawn - c + 1.0) / (c * (rest + c)),
    )
    return walk(
        F.struct(one.alias("weight"), upwards["sum"].alias("sum"), upwards["count"].alias("count")),
        counts(mode - 1, F.greatest(least, mode - reach), -1),
        lambda c: (c + 1.0) * (rest + c + 1.0) / ((marked - c) * (drawn - c)),
    )["count"]


def _left_quotas(quotas: Column, total: Column, left: Column, *seed: Column) -> Column:
    """Draws `left` of all blocks without replacement; the counts by source."""

    def step(state: Column, quota: Column) -> Column:
        place = F.size(state["counts"])
        count = hypergeometric(quota, state["total"], state["left"], *seed, place)
        return F.struct(
            F.concat(state["counts"], F.array(count)).alias("counts"),
            (state["total"] - quota).alias("total"),
            (state["left"] - count).alias("left"),
        )

    start = F.struct(
        F.expr("CAST(array() AS array<bigint>)").alias("counts"),
        total.alias("total"),
        left.alias("left"),
    )
    return F.aggregate(quotas, start, step)["counts"]


def shard_quotas(sources: DataFrame, count: int, mix: Mix = PRODUCTION) -> DataFrame:
    """(place, shards): for each source the shard, of `count` ones, of each of its blocks in order.

    `sources` has place and quota. One row per tree node, one level after the other.
    """
    quota = F.sort_array(F.collect_list(F.struct("place", "quota")))
    nodes = sources.agg(F.transform(quota, lambda q: q["quota"]).alias("quotas")).select(
        F.lit(0).alias("first"), F.lit(count).alias("end"), "quotas"
    )
    zero = F.lit(0).cast("long")
    for _ in range((count - 1).bit_length()):
        total = F.aggregate("quotas", zero, lambda a, b: a + b)
        middle = F.floor((F.col("first") + F.col("end")) / 2).cast("int")
        nodes = nodes.withColumn("total", total).withColumn("middle", middle)
        share = (F.col("middle") - F.col("first")) / (F.col("end") - F.col("first"))
        nodes = nodes.withColumn("left", F.round(F.col("total") * share).cast("long"))
        seed = (F.lit(mix.seed), F.col("first"), F.col("end"))
        nodes = nodes.withColumn(
            "drawn", _left_quotas(F.col("quotas"), F.col("total"), F.col("left"), *seed)
        )
        halves = F.array(
            F.struct("first", F.col("middle").alias("end"), F.col("drawn").alias("quotas")),
            F.struct(
                F.col("middle").alias("first"),
                "end",
                F.zip_with("quotas", "drawn", lambda a, b: a - b).alias("quotas"),
            ),
        )
        whole = F.array(F.struct("first", "end", "quotas"))
        one = F.col("end") - F.col("first") == 1
        nodes = nodes.select(F.explode(F.when(one, whole).otherwise(halves)).alias("node"))
        nodes = nodes.select("node.*")
    leaves = nodes.select("first", F.posexplode("quotas").alias("place", "quota"))
    runs = F.sort_array(F.collect_list(F.struct("first", "quota")))
    return leaves.groupBy("place").agg(
        F.flatten(
            F.transform(runs, lambda r: F.array_repeat(r["first"], r["quota"].cast("int")))
        ).alias("shards")
    )


def _planned(docs: DataFrame, mix: Mix) -> tuple[DataFrame, int]:
    """`docs` with size, source_size, target, taken and copies array<struct<pass, block, shard>>.

    Also the number of shards.
    """
    spark = prepare(docs.sparkSession)
    own = {n: free_name(docs, n) for n in ("size", "source_size", "target", "taken", "copies")}
    at = {n: free_name(docs, n) for n in ("_key", "_spot", "_range", "_start")}
    size, key, spot, range_ = (F.col(n) for n in (own["size"], at["_key"], at["_spot"], at["_range"]))
    sized = docs.withColumn(own["size"], words(F.col("text"))).withColumn(
        at["_key"], _source_key(F.col("source"))
    )

    totals = sized.groupBy(F.col("source").alias("source"), key.alias("key")).agg(
        F.count("*").alias("rows"), F.sum(size).alias("source_size")
    )
    goals, goals_path = stored(source_targets(totals, mix), "mix-goals")
    total = goals.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, ceil(total / mix.words_per_shard))
    length = max(1.0, float(ceil(total / (shards * mix.blocks_per_shard))))
    goals = goals.withColumn("length", F.lit(length)).withColumn(
        "quota", F.ceil(F.col("target") / F.col("length"))
    )
    ranges = F.greatest(F.lit(float(_LEAST_RANGE_ROWS)), F.sqrt("rows"))
    goals = goals.join(shard_quotas(goals, shards, mix), "place").select(
        F.col("key").alias("_goal"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        F.col("length").alias("_length"),
        F.col("shards").alias("_shards"),
        F.ceil(F.col("rows") / ranges).alias("_ranges"),
    )
    goals, plan_path = stored(goals, "mix-plan")
    discard(spark, goals_path)
    # A table of its own names, so that no column of `docs` clashes with it.
    goals = goals.select(F.struct(*goals.columns).alias(goal := free_name(docs, "_goals")))
    of = lambda name: F.col(f"{goal}._{name}")

    placed = (
        sized.join(goals, key == of("goal"))
        .withColumn(at["_spot"], _position(mix.seed, F.col("doc_id"), size))
        .withColumn(at["_range"], F.floor(spot / F.lit(_UNIT) * of("ranges")))
    )
    within = Window.partitionBy(key, range_).orderBy(spot, "doc_id", size)
    lengths = placed.groupBy(key.alias("_k"), range_.alias("_r")).agg(F.sum(size).alias("_n"))
    before = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = lengths.select(
        F.struct("_k", "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n")).alias(
            begin := free_name(docs, "_starts")
        )
    )
    inside = F.sum(size).over(within.rowsBetween(Window.unboundedPreceding, -1))
    placed = placed.join(
        starts, (key == F.col(f"{begin}._k")) & (range_ == F.col(f"{begin}._r"))
    ).withColumn(
        at["_start"], F.col(f"{begin}._n") + F.coalesce(inside, F.lit(0)) + size / F.lit(2.0)
    )

    def copy(turn: Column) -> Column:
        middle = F.col(at["_start"]) + turn * of("source_size")
        block = F.floor(middle / of("length"))
        return F.struct(
            turn.alias("pass"),
            block.alias("block"),
            F.when(middle < of("target"), F.get(of("shards"), block.cast("int"))).alias("shard"),
        )

    copies = F.filter(
        F.array(*[copy(F.lit(turn)) for turn in range(mix.most)]), lambda c: c["shard"].isNotNull()
    )
    planned = placed.withColumn(own["copies"], copies).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        size,
        of("source_size").alias(own["source_size"]),
        of("target").alias(own["target"]),
        (size * F.size(own["copies"])).alias(own["taken"]),
        own["copies"],
    )
    return planned, shards


def mix_sources(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """`docs` with size, source_size, target, taken and copies array<struct<pass, block, shard>>.

    `taken` counts the words of all copies. Needs doc_id, text and source.
    """
    return _planned(docs, mix)[0]


def mixed(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """The rows of the mix with the columns of `docs`, a row for each copy, shard by shard."""
    chosen, shards = _planned(docs, mix)
    copies = chosen.columns[-1]
    copy = free_name(chosen, "_copy")
    order = _position(mix.seed + 1, F.col("doc_id"), F.col(f"{copy}.pass"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return (
        chosen.select(*columns, F.explode(copies).alias(copy))
        .repartition(shards, F.col(f"{copy}.shard"))
        .sortWithinPartitions(F.col(f"{copy}.shard"), order)
        .select(*columns)
    )


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mix_sources(documents).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        F.transform("copies", lambda c: c["shard"]).alias("shards"),
    )


QUERIES = {"op3_source_mix": op3_source_mix}
ORACLE_SQL: dict[str, str] = {}
