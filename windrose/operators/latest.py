"""Keep the latest row per key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], kept: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the one with the greatest `order` values, nulls smallest.

    Of the other columns only those in `kept`, if given, go through the aggregate.

    An aggregate instead of a ranking window: each map task sends at most one row per key, so
    many copies of one key never meet in a single task.
    """
    rest = [c for c in df.columns if c not in keys and (kept is None or c in kept)]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_latest"))
        .select(*keys, "_latest.*")
    )
