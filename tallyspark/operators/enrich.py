"""Star enrichment: a fact table widened with attributes of its dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tallyspark.operators.keyed import KeySpec, key_list


@dataclass(frozen=True)
class Dimension:
    """A dimension table, its key, and the attributes to bring to the fact."""

    table: DataFrame
    key: KeySpec
    attributes: Sequence[str] = field(default_factory=tuple)


def enrich(fact: DataFrame, dimensions: Sequence[Dimension], how: str = "left") -> DataFrame:
    """Left-join each dimension on its key; every fact row is kept.

    Dimensions are pruned to key + attributes before the join. Join strategy
    is left to Spark: a side is broadcast only when the planner's size
    estimate (``spark.sql.autoBroadcastJoinThreshold``) or AQE's runtime size
    (``spark.sql.adaptive.autoBroadcastJoinThreshold``) is under the limit;
    otherwise it is a sort-merge join on the key, with AQE splitting skewed
    partitions. A unique dimension key (see ``quality.unique_key_rule``) is
    what guarantees the row count is preserved.

    Output columns: the fact's columns in their order, then the attributes.
    """
    out = fact
    added: list[str] = []
    for dim in dimensions:
        keys = key_list(dim.key)
        attrs = [a for a in dim.attributes if a not in keys]
        clash = [a for a in attrs if a in fact.columns or a in added]
        if clash:
            raise ValueError(f"Attributes already present on the fact: {clash}")
        out = out.join(dim.table.select(*keys, *attrs), on=keys, how=how)
        added += attrs
    return out.select(*fact.columns, *added)
