"""Rows that break a rule, set aside while the others are written.

Every row gets a bit mask of the rules it fails. Good and bad rows are written in
one pass, to two folders of one table, and the number of rows that fail each rule
is observed on the way: the rule table needs no scan of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallyspark.operators import quality as qa

MASK, BAD, REASONS = "_failed", "_quarantined", "failed_rules"
MAX_RULES = 62


def failure_mask(failing: Mapping[str, Column]) -> Column:
    """Bit i is set where the i-th condition holds; an unknown condition (NULL) does not fail."""
    if not 0 < len(failing) <= MAX_RULES:
        raise ValueError(f"1 to {MAX_RULES} rules are needed, not {len(failing)}")
    bits = [F.when(condition, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
            for i, condition in enumerate(failing.values())]
    return reduce(Column.bitwiseOR, bits)


def reasons(mask: Column, failing: Mapping[str, Column]) -> Column:
    """The names behind a mask, in the order of the rules."""
    names = [F.when(mask.bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, name) for i, name in enumerate(failing)]
    return F.array_compact(F.array(*names))


@dataclass(frozen=True)
class Split:
    good: DataFrame
    bad: DataFrame  # with the names of the rules each row fails, in REASONS
    rows: int
    quarantined: int
    failed: Mapping[str, int]  # rows by rule

    def rules(self, subject: str) -> DataFrame:
        """The counts as a rule table."""
        spark = self.good.sparkSession
        return qa.combine(*[qa.known_rule(spark, name, subject, self.rows, n) for name, n in self.failed.items()])


def write_split(df: DataFrame, failing: Mapping[str, Column], path: str) -> Split:
    taken = {MASK, BAD, REASONS} & set(df.columns)
    if taken:
        raise ValueError(f"Columns {sorted(taken)} are in the way")
    marked = df.withColumn(MASK, failure_mask(failing))
    seen = Observation(f"quarantine_{uuid.uuid4().hex}")
    fails = lambda i: F.count_if(F.col(MASK).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0)
    (marked.observe(seen, F.count("*").alias("rows"), F.count_if(F.col(MASK) != 0).alias("bad"),
                    *[fails(i).alias(f"rule_{i}") for i in range(len(failing))])
     .withColumn(BAD, F.col(MASK) != 0).write.partitionBy(BAD).parquet(path))
    got = seen.get

    def part(bad: bool) -> DataFrame:
        if not (got["bad"] if bad else got["rows"] - got["bad"]):
            return df.sparkSession.createDataFrame([], marked.schema)
        return df.sparkSession.read.schema(marked.schema).parquet(f"{path}/{BAD}={str(bad).lower()}")

    return Split(part(False).drop(MASK), part(True).withColumn(REASONS, reasons(F.col(MASK), failing)).drop(MASK),
                 int(got["rows"]), int(got["bad"]), {name: int(got[f"rule_{i}"]) for i, name in enumerate(failing)})
