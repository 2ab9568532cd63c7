"""Functional dependencies, and checksums of stored tables."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import quality as qa
from tallyspark.operators.dependencies import Dependency, dependency_errors, dependency_rules
from tallyspark.session import shared_dir
from tallyspark.sources import checksums as C


def plain(rows, determinant, dependent):
    counts = Counter((tuple(r[c] for c in determinant), r[dependent]) for r in rows)
    groups = {}
    for (x, _), n in counts.items():
        groups.setdefault(x, []).append(n)
    bad = [g for g in groups.values() if len(g) > 1]
    removed = sum(sum(g) - max(g) for g in groups.values())
    return (len(rows), len(groups), len(bad), sum(map(sum, bad)), removed, removed / len(rows))


def test_errors_against_plain_counts(spark):
    rng = random.Random(1)
    rows = [{"a": rng.choice([None, 1, 2, 3]), "b": rng.choice("xyz"), "c": rng.choice([None, "u", "v"])}
            for _ in range(200)]
    rows += [{"a": 7, "b": "x", "c": "u"}] * 100
    df = spark.createDataFrame(rows, "a int, b string, c string")
    some = [Dependency(("a",), "c"), Dependency(("a", "b"), "c"), Dependency(("c",), "b")]
    got = {r["dependency"]: tuple(r)[1:] for r in dependency_errors(df, some).collect()}
    assert got == {d.name: plain(rows, d.determinant, d.dependent) for d in some}


def test_rules_and_empty_table(spark):
    df = spark.createDataFrame([("p1", "A")] * 9 + [("p1", "B"), ("p2", "B")], "id string, kind string")
    one = [Dependency(("id",), "kind")]
    (row,) = dependency_rules(df, one).collect()
    assert (row["subject"], row["checked"], row["failed"], row["passed"]) == ("id -> kind", 11, 1, False)
    assert len(qa.gate(dependency_rules(df, one, max_g3=0.1))) == 1
    with pytest.raises(AssertionError, match="functional_dependency"):
        qa.gate(dependency_rules(df, one))
    assert dependency_errors(df.limit(0), one).first()["g3"] == 0.0


def table(spark):
    return spark.range(1000).selectExpr(
        "id", "IF(id % 7 = 0, NULL, id / 3) AS value", "concat('k', id % 10) AS kind", "id % 3 AS part",
        "map('m', id) AS tags", "named_struct('x', array(id)) AS deep")


def test_checksum_does_not_depend_on_order_and_sees_every_change(spark):
    df = table(spark)
    want = C.checksum(df)
    assert want.rows == 1000
    assert C.checksum(df.repartition(7).orderBy(F.desc("value"))) == want
    assert C.checksum(df.select(*reversed(df.columns))) == want
    swapped = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert C.checksum(swapped) != C.checksum(swapped.select(F.col("b").alias("a"), F.col("a").alias("b")))
    for changed in (df.where("id < 999"), df.unionByName(df.limit(1)),
                    df.withColumn("value", F.when(F.col("id") == 7, 0.0).otherwise(F.col("value"))),
                    df.withColumn("tags", F.when(F.col("id") == 5, F.create_map(F.lit("m"), F.lit(6).cast("long")))
                                  .otherwise(F.col("tags")))):
        assert C.checksum(changed).total != want.total


def test_the_changed_partition_is_named(spark):
    path, by = shared_dir(spark, "t-sums"), ["kind", "part"]
    df = table(spark)
    want = C.write_observed(df, path, by)
    stored = spark.read.schema(df.schema).parquet(path)  # folder names do not tell a bigint from an int
    assert C.verify(stored, want, by).matched
    one = stored.withColumn("value", F.when(F.col("id") == 123, -1.0).otherwise(F.col("value")))
    verdict = C.verify(one, want, by)
    assert not verdict.matched and verdict.partition == {"kind": "k3", "part": 0}
    assert verdict.stored.rows == want.rows  # equal counts
    several = stored.withColumn("value", F.when(F.col("id").isin(11, 22), -1.0).otherwise(F.col("value")))
    assert C.verify(several, want, by) == C.Verdict(False, None, C.checksum(several, by))
    plain_path = shared_dir(spark, "t-sums")
    whole = C.write_observed(df, plain_path)
    assert C.verify(spark.read.parquet(plain_path), whole).matched
    assert not C.verify(stored.where("id > 0").select(df.columns), whole).matched
    empty = C.write_observed(df.limit(0), shared_dir(spark, "t-sums"))
    assert empty == C.Checksum(0, 0, 0)
