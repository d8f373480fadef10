"""Input checks that fail a load before anything is written."""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NoRows(ValueError):
    """The input has nothing to load; the tables stay as they are."""


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")
    return df


def require_keyed(df: DataFrame, key: Sequence[str], not_null: Sequence[str]) -> int:
    """Number of rows, if `key` is unique and the `not_null` columns are filled; else an error."""
    nulls_in = {c: f"_nulls_{c}" for c in not_null}
    found = (
        df.groupBy(*key)
        .agg(
            F.count("*").alias("_copies"),
            *[F.count_if(F.col(c).isNull()).alias(n) for c, n in nulls_in.items()],
        )
        .agg(
            F.count("*").alias("_keys"),
            F.max("_copies").alias("_copies"),
            *[F.sum(n).alias(n) for n in nulls_in.values()],
        )
        .first()
    )
    if found["_keys"] and found["_copies"] > 1:
        raise ValueError(f"Rows are not unique on {list(key)}")
    nulls = [c for c, n in nulls_in.items() if found[n]]
    if nulls:
        raise ValueError(f"Null values in required columns: {nulls}")
    return found["_keys"]
