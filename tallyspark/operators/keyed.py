"""Keyed operators: deterministic de-duplication and duplicate profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

KeySpec = str | Sequence[str]


def key_list(key: KeySpec) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _orderable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def _sort_col(o: str | Column) -> Column:
    return F.col(o).asc_nulls_first() if isinstance(o, str) else o


def _free_name(df: DataFrame, base: str) -> str:
    name = base
    while name in df.columns:
        name = "_" + name
    return name


def remove_duplicate_keys(df: DataFrame, key_column: KeySpec,
                          order_by: Sequence[str | Column] | None = None,
                          keep: str = "first", declare_unique: bool = False) -> DataFrame:
    """Keep one row per key.

    ``keep="first"`` (default) keeps the first row in ``order_by`` order, with
    every other orderable column appended as a tie-breaker, so the same input
    always yields the same rows. Catalyst plans ``row_number() == 1`` as a
    window group limit on both sides of the shuffle: each map task forwards at
    most one row per key, so even a key holding a third of the table sends
    only one row per input partition across the network.

    ``keep="any"`` is a plain hash aggregate (``dropDuplicates``): cheaper, no
    sort, but which row survives is unspecified.

    ``declare_unique=True`` ends the plan with a ``dropDuplicates`` on the
    key. The rows are already unique, so nothing changes, and the input is
    already partitioned by the key, so no exchange is added. What it buys is
    that Catalyst now *knows* the key is unique: a left join to this table
    whose columns a query never uses is removed from the plan. Off by
    default: on Spark 4.1.2, ``exceptAll`` over a plan that joins such a
    table after a semi join failed with an internal attribute-binding error
    (see tests/test_plans.py), so turn it on only for report-only plans.
    """
    keys = key_list(key_column)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"Unknown key columns: {missing}")
    if keep == "any":
        return df.dropDuplicates(keys)
    if keep != "first":
        raise ValueError("keep must be 'first' or 'any'")
    order = [_sort_col(o) for o in (order_by or [])]
    named = set(keys) | {o for o in (order_by or []) if isinstance(o, str)}
    order += [F.col(f.name).asc_nulls_first() for f in df.schema.fields
              if f.name not in named and _orderable(f.dataType)]
    if not order:  # only key columns: rows sharing a key are identical
        return df.dropDuplicates(keys)
    rank = _free_name(df, "_row_num")
    window = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)
    return out.dropDuplicates(keys) if declare_unique else out


def duplicate_summary(df: DataFrame, key_column: KeySpec) -> DataFrame:
    """(key..., count) for every key that occurs more than once.

    A grouped count with map-side partial aggregation, so a hot key costs one
    partial row per input partition before the shuffle. NULL keys form one
    group, as in SQL ``GROUP BY``."""
    keys = key_list(key_column)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)
