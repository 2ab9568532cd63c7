"""Functional dependencies: does a value of some columns fix that of another?

The error of ``X -> Y`` is g3, the least share of rows that would have to go for
it to hold: of each value of X all rows but those with its most frequent Y.
All dependencies are read from one table of counts over the columns they name,
made in a single pass with partial aggregation, so a value that holds a third of
the rows costs a row per task. NULL is a value like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.operators.quality import RULE_COLUMNS
from tallyspark.session import shared_dir


@dataclass(frozen=True)
class Dependency:
    determinant: tuple[str, ...]
    dependent: str

    @property
    def name(self) -> str:
        return f"{', '.join(self.determinant)} -> {self.dependent}"


def dependency_errors(df: DataFrame, dependencies: Sequence[Dependency]) -> DataFrame:
    """A row per dependency: (dependency, rows, groups, violating_groups,
    violating_rows, removed_rows, g3). Groups are values of the determinant; an
    empty table has g3 0."""
    columns = sorted({c for d in dependencies for c in (*d.determinant, d.dependent)})
    path = shared_dir(df.sparkSession, "dependencies")
    df.groupBy(*columns).agg(F.count("*").alias("_n")).write.parquet(path)  # read once per dependency
    counts = df.sparkSession.read.parquet(path)
    return reduce(DataFrame.unionByName, [_error(counts, d) for d in dependencies])


def _error(counts: DataFrame, dependency: Dependency) -> DataFrame:
    pairs = counts.groupBy(*dependency.determinant, dependency.dependent).agg(F.sum("_n").alias("_n"))
    groups = pairs.groupBy(*dependency.determinant).agg(
        F.sum("_n").alias("all"), F.max("_n").alias("most"), F.count("*").alias("values"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    bad = F.col("values") > 1
    return groups.agg(
        F.lit(dependency.name).alias("dependency"), count("all").alias("rows"), F.count("*").alias("groups"),
        F.count_if(bad).alias("violating_groups"), count(F.when(bad, F.col("all"))).alias("violating_rows"),
        count(F.col("all") - F.col("most")).alias("removed_rows")).withColumn(
        "g3", F.when(F.col("rows") > 0, F.col("removed_rows") / F.col("rows")).otherwise(0.0))


def dependency_rules(df: DataFrame, dependencies: Sequence[Dependency], max_g3: float = 0.0) -> DataFrame:
    """The errors as a rule table: a dependency passes if at most ``max_g3`` of the rows violate it."""
    return dependency_errors(df, dependencies).select(
        F.lit("functional_dependency").alias("rule"), F.col("dependency").alias("subject"),
        F.col("rows").alias("checked"), F.col("removed_rows").alias("failed"),
        (F.col("g3") <= max_g3).alias("passed")).select(*RULE_COLUMNS)
