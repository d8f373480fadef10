"""Trailing row frames by running sums, and the newest rows per key."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrose.functions.numeric import exact

# Six digits after the point; a million rows of values below the limit sum up, squared, exactly.
_VALUE, _LIMIT = "decimal(14,6)", 1e8
_RUNNING, _RUNNING_SQUARES = "decimal(24,6)", "decimal(36,12)"
_FRAME, _FRAME_SQUARES = "decimal(18,6)", "decimal(33,12)"


@dataclass(frozen=True)
class Trailing:
    """Mean, and on demand deviation, of a measure over `rows` rows that end `skip` rows back."""

    measure: str
    rows: int
    skip: int = 0
    deviation: str | None = None


def with_trailing(
    df: DataFrame, key: str | Sequence[str], order: str, frames: dict[str, Trailing]
) -> DataFrame:
    """Adds the mean of each frame under its name, and its sample deviation under `deviation`.

    One growing frame per key carries exact decimal sums; a frame is the difference of two of them,
    so a row costs the same whatever the frame's length, and a key's rows stream through its task
    without being held. Sums are exact, hence a constant history has deviation zero, and the result
    does not depend on where the history starts. Frames may hold up to 1000 rows; nulls do not count.
    """
    keys = [key] if isinstance(key, str) else list(key)
    by_key = Window.partitionBy(*keys).orderBy(order)
    grown = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    measures = sorted({f.measure for f in frames.values()})
    squared = {f.measure for f in frames.values() if f.deviation}
    running = {}
    for m in measures:
        value = exact(F.col(m), _VALUE, _LIMIT)
        running[f"_n_{m}"] = F.count(m).over(grown)
        running[f"_s_{m}"] = F.sum(value).over(grown).cast(_RUNNING)
        if m in squared:
            running[f"_q_{m}"] = F.sum(value * value).over(grown).cast(_RUNNING_SQUARES)
    sums = df.select("*", *[c.alias(n) for n, c in running.items()])

    def before(column: str, back: int) -> Column:
        """The running sum `back` rows earlier; zero before the first row."""
        zero = F.lit(0).cast(sums.schema[column].dataType)
        earlier = F.col(column) if back == 0 else F.lag(column, back).over(by_key)
        return F.coalesce(earlier, zero)

    parts = {}
    for name, f in frames.items():
        for kind, sized in (("n", "long"), ("s", _FRAME), ("q", _FRAME_SQUARES)):
            column = f"_{kind}_{f.measure}"
            if column in running and (kind != "q" or f.deviation):
                last, first = before(column, f.skip), before(column, f.skip + f.rows)
                parts[f"{column}_{name}"] = (last - first).cast(sized)
    framed = sums.select("*", *[c.alias(n) for n, c in parts.items()])

    results = {}
    for name, f in frames.items():
        n, s = (F.col(f"_{kind}_{f.measure}_{name}") for kind in "ns")
        results[name] = s.cast("double") / F.nullif(n, F.lit(0))
        if f.deviation:
            q = F.col(f"_q_{f.measure}_{name}")
            spread = (q * n.cast("decimal(3,0)") - s * s).cast("double")
            results[f.deviation] = F.when(n > 1, F.sqrt(spread / (n * (n - 1))))
    return framed.withColumns(results).drop(*running, *parts)


#: Days of one block: about 3000 half-hourly rows of a key, and a halo of a day or two before them.
DAYS_PER_BLOCK = 64
_FIRST_BLOCK = -(1 << 31)


def with_trailing_by_block(
    df: DataFrame,
    key: str,
    order: str,
    day: str,
    frames: dict[str, Trailing],
    days_per_block: int = DAYS_PER_BLOCK,
) -> DataFrame:
    """`with_trailing` for histories that are too long for one task: a key is cut into blocks of days.

    Frames reach back a fixed number of rows, so a block needs the rows before it only as far as that:
    its halo, the last days before it that together hold as many rows. Which days those are follows from
    the rows per key and day, a table that is counted first (one column is read), summed up along each
    key, and joined back by day. Rows are shuffled once, by (key, block), those of a halo to the blocks
    they serve as well; a block's own rows get their frames, the halo's copies are dropped. A key with a
    third of all rows is so worked on by as many tasks as it has blocks. Sums are exact, hence the
    result is that of `with_trailing` to the bit.

    `day` must not decrease as `order` grows; rows without a day count as the earliest.
    """
    reach = max(f.skip + f.rows for f in frames.values())
    block = F.floor(F.coalesce(F.unix_date(F.col(day)), F.lit(_FIRST_BLOCK)) / days_per_block)
    along = Window.partitionBy(key).orderBy(day)
    counts = df.groupBy(key, day).agg(F.count("*").alias("_rows"))
    counted = counts.select(
        key,
        day,
        block.alias("_own"),
        F.sum("_rows").over(along).alias("_seen"),
        F.lead(block).over(along).alias("_next"),
    )
    # The last day of a block knows the next block, which starts after `_seen` rows of the key.
    served = F.collect_list(F.when(F.col("_next") != F.col("_own"), F.col("_next")))
    ahead = Window.partitionBy(key).orderBy("_seen").rangeBetween(0, reach - 1)
    blocks = F.concat(F.array("_own"), served.over(ahead))
    places = counted.select(
        F.col(key).alias("_key"), F.col(day).alias("_day"), "_own", blocks.alias("_blocks")
    )
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col(day).eqNullSafe(F.col("_day"))
    dealt = df.join(places, same).select(*df.columns, "_own", F.explode("_blocks").alias("_block"))
    framed = with_trailing(dealt, [key, "_block"], order, frames)
    return framed.filter(F.col("_block") == F.col("_own")).drop("_own", "_block")


def newest_rows(df: DataFrame, key: str, order: str, rows: int) -> DataFrame:
    """The last `rows` rows per key with their recency rank `rn` (1 = newest).

    Spark limits the groups before the shuffle, so each map task sends at most `rows` per key.
    """
    by_recency = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("rn", F.row_number().over(by_recency)).filter(F.col("rn") <= rows)


def parts_of_newest(df: DataFrame, keys: Sequence[str], part: str, rows: int) -> DataFrame:
    """(key, part): for each key the newest parts that together hold its last `rows` rows.

    `part` must not decrease as rows get newer. Only the key and part columns are read.
    """
    newer = (
        Window.partitionBy(*keys)
        .orderBy(F.desc(part))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    counts = df.groupBy(*keys, part).agg(F.count("*").alias("_rows"))
    seen = F.coalesce(F.sum("_rows").over(newer), F.lit(0))
    return counts.withColumn("_seen", seen).filter(F.col("_seen") < rows).select(*keys, part)
