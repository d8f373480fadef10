"""Best interval covering each point, without forming point-interval pairs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Seconds of a block at each level; each length divides the next. Blocks of half hours and more keep
# intervals on the usual window grid short, smaller ones serve any second.
_BLOCKS = [1, 10, 60, 300, 1800, 28_800, 460_800, 7_372_800, 117_964_800]


def _span(first: Column, stop: Column) -> Column:
    """first .. stop-1 as an array, empty when there is nothing between."""
    return F.when(first < stop, F.sequence(first, stop - 1)).otherwise(
        F.array().cast("array<bigint>")
    )


def _at_level(level: int):
    return lambda block: F.struct(F.lit(level).alias("level"), block.alias("block"))


def _covering_blocks(start: Column, stop: Column) -> Column:
    """The largest aligned blocks that together make up the seconds start .. stop-1."""
    first = [F.ceil(start / length) for length in _BLOCKS]
    last = [F.floor(stop / length) for length in _BLOCKS]
    pieces = []
    for level in range(len(_BLOCKS)):
        whole = _span(first[level], last[level])
        if level + 1 < len(_BLOCKS):
            fanout = _BLOCKS[level + 1] // _BLOCKS[level]
            up_first, up_last = first[level + 1] * fanout, last[level + 1] * fanout
            edges = F.concat(_span(first[level], up_first), _span(up_last, last[level]))
            whole = F.when(up_first < up_last, edges).otherwise(whole)
        pieces.append(F.transform(whole, _at_level(level)))
    return F.concat(*pieces)


def _blocks_around(second: Column) -> Column:
    return F.array(
        *[_at_level(level)(F.floor(second / length)) for level, length in enumerate(_BLOCKS)]
    )


def best_covering(
    points: DataFrame,
    intervals: DataFrame,
    *,
    point_keys: Sequence[str],
    point_match: Column,
    point_second: Column,
    interval_match: Column,
    first_second: Column,
    last_second: Column,
    best: Sequence[Column],
) -> DataFrame:
    """For each point covered by a matching interval: the greatest `best` tuple, as columns.

    Both ends are inclusive and count whole epoch seconds. Each interval is cut into aligned
    blocks, some for each level at both ends, so their number grows with the logarithm of its
    length whatever the points are. The best interval per (match, block) is kept, so the lookup
    table has one row per block. A point lies in one block per level, hence one unique lookup per
    level replaces the join with every overlapping interval: work grows with points + intervals,
    also when one match value owns most of both. Spark decides by size whether the table is
    broadcast. Intervals are first cut to the time range of the points.
    """
    earliest, latest = (points.agg(edge(point_second)).scalar() for edge in (F.min, F.max))
    block_table = (
        intervals.filter((first_second <= latest) & (last_second >= earliest))
        .select(
            interval_match.alias("_match"),
            F.greatest(first_second, earliest).alias("_from"),
            (F.least(last_second, latest) + 1).alias("_stop"),
            F.struct(*best).alias("_best"),
        )
        .filter(F.col("_from") < F.col("_stop"))
        .select(
            "_match",
            F.explode(_covering_blocks(F.col("_from"), F.col("_stop"))).alias("_at"),
            "_best",
        )
        .groupBy("_match", "_at.level", "_at.block")
        .agg(F.max("_best").alias("_best"))
    )
    lookups = (
        points.select(
            *point_keys,
            point_match.alias("_match"),
            F.explode(_blocks_around(point_second)).alias("_at"),
        )
        .select(*point_keys, "_match", "_at.*")
    )
    return (
        lookups.join(block_table, ["_match", "level", "block"])
        .groupBy(*point_keys)
        .agg(F.max("_best").alias("_best"))
        .select(*point_keys, "_best.*")
    )
