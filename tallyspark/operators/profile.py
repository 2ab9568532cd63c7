"""A profile of every column in one pass, from mergeable sketches.

Distinct counts are HyperLogLog++ estimates (``error`` is their relative standard
deviation), quantiles have a rank error of at most ``1 / accuracy`` of the rows, and
heavy hitters come from a frequent-items sketch; NULLs, minimum and maximum are
exact. Each is a partial aggregate, so a task sends one row. What an estimate
cannot settle is counted exactly for the columns in question only: a column is a
key if all its values differ, and only one whose estimate comes within ``KEY_ERRORS``
standard deviations of its number of values can be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

ERROR = 0.02
ACCURACY = 10_000
QUANTILES = (0.25, 0.5, 0.75)
KEY_ERRORS = 6
TOP = 5
PROFILE = ("column string, rows bigint, nulls bigint, distinct bigint, least string, greatest string, "
           "quantiles array<double>, top array<struct<value: string, n: bigint>>")


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def profile(df: DataFrame, error: float = ERROR, quantiles: Sequence[float] = QUANTILES,
            accuracy: int = ACCURACY, top: int = TOP) -> DataFrame:
    """PROFILE, a row per column; quantiles of numbers only. Columns must be comparable."""
    def one(field) -> Column:
        column = _quoted(field.name)
        number = isinstance(field.dataType, NumericType)
        hitters = F.expr(f"approx_top_k(CAST(`{field.name.replace('`', '``')}` AS string), {top})")
        return F.struct(
            F.lit(field.name).alias("column"), F.count("*").alias("rows"),
            F.count_if(column.isNull()).alias("nulls"), F.approx_count_distinct(column, error).alias("distinct"),
            F.min(column).cast("string").alias("least"), F.max(column).cast("string").alias("greatest"),
            (F.percentile_approx(column.cast("double"), list(quantiles), accuracy) if number
             else F.lit(None).cast("array<double>")).alias("quantiles"),
            F.transform(F.filter(hitters, lambda x: x["item"].isNotNull()),
                        lambda x: F.struct(x["item"].alias("value"), x["count"].alias("n"))).alias("top"))

    row = df.agg(F.array(*[one(f) for f in df.schema.fields]).alias("columns"))
    return row.select(F.explode("columns").alias("x")).select("x.*")


def key_suspects(profiled: DataFrame, error: float = ERROR) -> list[str]:
    """Columns that may be keys by their estimates; a row per column is collected."""
    values = F.col("rows") - F.col("nulls")
    near = F.col("distinct") >= values * (1 - KEY_ERRORS * error)
    return [r[0] for r in profiled.where((values > 0) & near).select("column").collect()]


def keys(df: DataFrame, suspects: Sequence[str]) -> list[str]:
    """Those of the suspects whose values all differ, counted exactly."""
    found = []
    for name in suspects:
        value = _quoted(name)
        if df.where(value.isNotNull()).groupBy(value).count().where("count > 1").isEmpty():
            found.append(name)
    return found
