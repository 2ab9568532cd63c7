"""Data-quality rules that return their verdicts as DataFrames.

Every rule yields rows of ``RULE_SCHEMA``: (rule, subject, checked, failed,
passed). Row-level conditions on one table are counted in a single pass;
key uniqueness rides in the same pass (a grouped count with map-side partial
aggregation, then a one-row total), so a table is read once for all of them.
Only the small rule table ever reaches the driver, in ``gate``.

The ``assert_*`` functions are the raising forms, with the messages callers
match on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.functions.names import standardized_name
from tallyspark.functions.parsing import total
from tallyspark.operators.keyed import KeySpec, duplicate_summary, key_list

RULE_SCHEMA = "rule string, subject string, checked bigint, failed bigint, passed boolean"
RULE_COLUMNS = ["rule", "subject", "checked", "failed", "passed"]


def _spark(df: DataFrame) -> SparkSession:
    return df.sparkSession


def _unpivot(totals: DataFrame, subject: str, rules: Sequence[tuple]) -> DataFrame:
    """One-row ``totals`` → one row per rule: (name, checked, failed) or
    (name, checked, failed, subject)."""
    entries = []
    for rule in rules:
        name, checked, failed = rule[:3]
        entries.append(F.struct(
            F.lit(name).alias("rule"),
            F.lit(rule[3] if len(rule) > 3 else subject).alias("subject"),
            F.coalesce(checked.cast("bigint"), F.lit(0).cast("bigint")).alias("checked"),
            F.coalesce(failed.cast("bigint"), F.lit(0).cast("bigint")).alias("failed")))
    return (totals.select(F.inline(F.array(*entries)))
            .withColumn("passed", F.col("failed") == 0)
            .select(*RULE_COLUMNS))


def row_rules(df: DataFrame, subject: str, failing: Mapping[str, Column] | None = None,
              key: KeySpec | None = None,
              match_rows: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``not_empty``, optional ``unique_key`` / ``null_key``, and one rule per
    entry of ``failing`` (name → condition true on a bad row), in one pass.

    Without a key this is a single global aggregate (partials per task, no
    shuffle of rows). With a key, rows are first counted per key (partial
    aggregation before the shuffle), then summed. ``match_rows`` (label →
    frame) adds a ``row_count_match`` rule per frame whose row count must
    equal this table's, reusing this pass's count instead of a second one."""
    failing = dict(failing or {})
    conds = list(failing.items())
    if key is None:
        totals = df.agg(F.count(F.lit(1)).alias("_rows"),
                        *[F.count_if(c).alias(f"_f{i}") for i, (_, c) in enumerate(conds)])
        rules = [("not_empty", F.col("_rows"), F.when(F.col("_rows") == 0, 1).otherwise(0))]
    else:
        keys = key_list(key)
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        per_key = df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(any_null).alias("_null_key"),
            *[F.count_if(c).alias(f"_f{i}") for i, (_, c) in enumerate(conds)])
        totals = per_key.agg(
            F.sum("_n").alias("_rows"),
            F.count(F.lit(1)).alias("_keys"),
            F.count_if(F.col("_n") > 1).alias("_dup_keys"),
            F.sum("_null_key").alias("_null_key"),
            *[F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(conds))])
        rows = F.coalesce(F.col("_rows"), F.lit(0))
        rules = [
            ("not_empty", rows, F.when(rows == 0, 1).otherwise(0)),
            ("unique_key", F.col("_keys"), F.col("_dup_keys")),
            ("null_key", rows, F.col("_null_key")),
        ]
    rows = F.coalesce(F.col("_rows"), F.lit(0))
    rules += [(name, rows, F.col(f"_f{i}")) for i, (name, _) in enumerate(conds)]
    if match_rows:
        # one-row totals of every frame, side by side through a union (no join)
        combined = totals
        for i, other in enumerate(match_rows.values()):
            combined = combined.unionByName(other.agg(F.count(F.lit(1)).alias(f"_m{i}")),
                                            allowMissingColumns=True)
        totals = combined.agg(*[F.max(c).alias(c) for c in combined.columns])
        rules += [("row_count_match", F.col(f"_m{i}"), F.abs(F.col(f"_m{i}") - rows), label)
                  for i, label in enumerate(match_rows)]
    return _unpivot(totals, subject, rules)


def _side_totals(left: DataFrame, right: DataFrame, left_measure: Column,
                 right_measure: Column | None = None) -> DataFrame:
    """Both sides' one-row totals as one row (``_l``, ``_r``), via a union:
    no join, one stage per side."""
    right_measure = left_measure if right_measure is None else right_measure
    sides = (left.agg(left_measure.alias("_v")).withColumn("_side", F.lit("l"))
             .unionByName(right.agg(right_measure.alias("_v")).withColumn("_side", F.lit("r"))))
    return sides.agg(F.max(F.when(F.col("_side") == "l", F.col("_v"))).alias("_l"),
                     F.max(F.when(F.col("_side") == "r", F.col("_v"))).alias("_r"))


def row_count_match(left: DataFrame, right: DataFrame, subject: str,
                    rule: str = "row_count_match") -> DataFrame:
    """``checked`` = rows of ``left``, ``failed`` = |left − right|."""
    totals = _side_totals(left, right, F.count(F.lit(1)))
    return _unpivot(totals, subject, [(rule, F.col("_l"), F.abs(F.col("_l") - F.col("_r")))])


def money_totals(source: DataFrame, agg: DataFrame, source_col: str = "profit",
                 agg_col: str = "total_profit", scale: int = 2) -> DataFrame:
    """One row: both totals (exact decimal sums rounded to ``scale``, as
    double) and whether they agree. Both NULL (two empty tables) agree."""
    totals = _side_totals(source, agg, F.round(total(source_col), scale), F.round(total(agg_col), scale))
    return totals.select(
        F.col("_l").cast("double").alias("source_total"),
        F.col("_r").cast("double").alias("aggregate_total"),
        F.col("_l").eqNullSafe(F.col("_r")).alias("matched"),
    )


def reconciliation_rule(source: DataFrame, agg: DataFrame, subject: str,
                        source_col: str = "profit", agg_col: str = "total_profit") -> DataFrame:
    totals = money_totals(source, agg, source_col, agg_col)
    return _unpivot(totals, subject, [
        ("totals_reconcile", F.lit(1), F.when(F.col("matched"), 0).otherwise(1))])


def accepted_values(df: DataFrame, column: str, allowed: Sequence, subject: str) -> DataFrame:
    """The distinct values of ``column`` must be exactly ``allowed``.

    ``accepted_values``: distinct values not in the list (NULL counts as not
    accepted); ``expected_values_present``: listed values never seen. One
    aggregate over the column's distinct values (partial aggregation before
    the shuffle), testing membership in the literal list, which Catalyst
    turns into a hash set; nothing is collected and nothing joined."""
    allowed = list(dict.fromkeys(allowed))
    value = F.col(column)
    member = value.isin(allowed)
    totals = df.select(column).distinct().agg(
        F.count(F.lit(1)).alias("_seen"),
        F.count_if(value.isNull() | ~member).alias("_bad"),
        F.count_if(member).alias("_hit"))
    return _unpivot(totals, subject, [
        ("accepted_values", F.col("_seen"), F.col("_bad")),
        ("expected_values_present", F.lit(len(allowed)), F.lit(len(allowed)) - F.col("_hit")),
    ])


def _metadata_rule(df: DataFrame, rule: str, subject: str, checked: int, failed: int) -> DataFrame:
    return _spark(df).createDataFrame([(rule, subject, checked, failed, failed == 0)], RULE_SCHEMA)


def required_columns_rule(df: DataFrame, required: Sequence[str], subject: str) -> DataFrame:
    """Schema only, no job: how many required columns are missing."""
    present = set(df.columns)
    return _metadata_rule(df, "required_columns", subject, len(required),
                          sum(c not in present for c in required))


def column_types_rule(df: DataFrame, expected: Mapping[str, str], subject: str) -> DataFrame:
    """Schema only: columns whose type differs from ``expected`` (simple names)."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return _metadata_rule(df, "column_types", subject, len(expected),
                          sum(actual.get(c) != t for c, t in expected.items()))


def column_naming_rule(df: DataFrame, subject: str) -> DataFrame:
    """Schema only: names that are not already in standard form."""
    return _metadata_rule(df, "column_naming", subject, len(df.columns),
                          sum(standardized_name(c) != c for c in df.columns))


def known_rule(spark: SparkSession, rule: str, subject: str, checked: int, failed: int,
               allowed: int = 0) -> DataFrame:
    """A rule whose counts are already known (observed while a table was
    written, or read from a schema): no job. Up to ``allowed`` failures pass."""
    return spark.createDataFrame(
        [(rule, subject, int(checked), int(failed), int(failed) <= allowed)], RULE_SCHEMA)


def count_match_rule(spark: SparkSession, left: int, right: int, subject: str,
                     rule: str = "row_count_match") -> DataFrame:
    """``row_count_match`` from counts already known: no job."""
    return known_rule(spark, rule, subject, left, abs(int(left) - int(right)))


def known_total_rule(source_total, agg: DataFrame, subject: str, agg_col: str = "total_profit",
                     scale: int = 2) -> DataFrame:
    """``totals_reconcile`` against a source total already known (observed
    while the source was written): only the aggregate table is read."""
    agg_total = agg.agg(F.round(total(agg_col), scale).alias("_a"))
    expected = (F.lit(None).cast(f"decimal(38,{scale})") if source_total is None
                else F.lit(str(Decimal(source_total))).cast(f"decimal(38,{scale})"))
    return _unpivot(agg_total, subject, [
        ("totals_reconcile", F.lit(1),
         F.when(F.col("_a").cast(f"decimal(38,{scale})").eqNullSafe(expected), 0).otherwise(1))])


def combine(*rule_frames: DataFrame) -> DataFrame:
    out = rule_frames[0]
    for frame in rule_frames[1:]:
        out = out.unionByName(frame)
    return out


def gate(rules: DataFrame) -> list:
    """Collect the rule table (one row per rule) and raise if any failed."""
    rows = rules.collect()
    bad = [r for r in rows if not r["passed"]]
    if bad:
        listed = "; ".join(f"{r['rule']}({r['subject']}): {r['failed']} of {r['checked']}"
                           for r in bad)
        raise AssertionError(f"Quality gate failed: {listed}")
    return rows


# --- profiling -------------------------------------------------------------

def null_summary(df: DataFrame) -> DataFrame:
    """One row: the number of NULLs in every column (0 on an empty table)."""
    return df.select([F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


# --- raising forms ---------------------------------------------------------

def assert_not_empty(df: DataFrame) -> None:
    assert not df.isEmpty(), "the table holds no row: it is empty."


def assert_unique_key(df: DataFrame, key_column: KeySpec) -> None:
    assert duplicate_summary(df, key_column).isEmpty(), (
        f"Duplicate values found: several rows share a value of {key_column}")


def assert_required_columns(df: DataFrame, required_columns: Sequence[str]) -> None:
    verdict = required_columns_rule(df, required_columns, "table").first()
    if not verdict["passed"]:
        absent = sorted(set(required_columns).difference(df.columns))
        raise AssertionError(f"Missing columns: {verdict['failed']} of {verdict['checked']} "
                             f"required ones ({', '.join(absent)})")


def assert_row_count_match(df1: DataFrame, df2: DataFrame, label: str = "") -> None:
    row = _side_totals(df1, df2, F.count(F.lit(1))).first()
    a, b = row["_l"], row["_r"]
    where = f" ({label})" if label else ""
    assert a == b, f"Row count mismatch{where}: {a} rows on one side, {b} on the other"


def assert_profit_reconciliation(source_df: DataFrame, agg_df: DataFrame,
                                 source_col: str = "profit",
                                 agg_col: str = "total_profit") -> None:
    row = money_totals(source_df, agg_df, source_col, agg_col).first()
    assert row["matched"], (
        f"Profit mismatch: the rows add up to {row['source_total']}, the table of totals to "
        f"{row['aggregate_total']}")
