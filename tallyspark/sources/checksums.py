"""Content checksums of stored tables, and where they differ.

A row is hashed to a number below the prime 2^61 - 1; the sum of all rows' hashes
modulo it does not depend on their order, their files or the tasks that wrote
them, and is observed while the rows are written. A second sum weights each
hash by a number made from the row's partition values. If one partition of the
stored table differs, both sums are off, and the quotient of the two differences
is that partition's number: it is found without a sum per partition. What
several partitions do to the sums is not taken apart, only detected.

NULLs are hashed as such, by a mask of their places; maps and variants as JSON.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

PRIME = (1 << 61) - 1
_FIELD = "decimal(38,0)"


@dataclass(frozen=True)
class Checksum:
    rows: int
    total: int
    located: int


def _plain(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _plain(kind.elementType)
    return not isinstance(kind, StructType) or all(_plain(f.dataType) for f in kind.fields)


def _quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def row_hash(df: DataFrame) -> Column:
    """A number from 1 to PRIME - 1, by the columns in the order of their names."""
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    missing = F.concat(F.lit(""), *[F.when(_quoted(f.name).isNull(), "1").otherwise("0") for f in fields])
    values = [_quoted(f.name) if _plain(f.dataType) else F.to_json(F.struct(_quoted(f.name).alias("x")))
              for f in fields]
    return (F.pmod(F.xxhash64(missing, *values).cast(_FIELD), F.lit(PRIME - 1).cast(_FIELD)) + 1).cast(_FIELD)


def partition_number(partition_by: Sequence[str]) -> Column:
    """From 1 to 2^31; 1 without partitions."""
    if not partition_by:
        return F.lit(1).cast(_FIELD)
    values = [F.coalesce(_quoted(c).cast("string"), F.lit("\0")) for c in partition_by]
    return (F.pmod(F.xxhash64(*values), F.lit(1 << 31)) + 1).cast(_FIELD)


def measures(df: DataFrame, partition_by: Sequence[str] = ()) -> list[Column]:
    h, prime = row_hash(df), F.lit(PRIME).cast(_FIELD)
    return [F.count("*").alias("rows"), F.sum(h).alias("total"),
            F.sum(F.pmod((h * partition_number(partition_by)).cast(_FIELD), prime)).alias("located")]


def _checksum(row) -> Checksum:
    return Checksum(int(row["rows"]), int(row["total"] or 0) % PRIME, int(row["located"] or 0) % PRIME)


def checksum(df: DataFrame, partition_by: Sequence[str] = ()) -> Checksum:
    return _checksum(df.agg(*measures(df, partition_by)).first().asDict())


def write_observed(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Checksum:
    """Writes Parquet; the checksum of the rows is observed on the way."""
    seen = Observation(f"checksum_{uuid.uuid4().hex}")
    writer = df.observe(seen, *measures(df, partition_by)).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return _checksum(seen.get)


@dataclass(frozen=True)
class Verdict:
    matched: bool
    #: values of the partition that differs; None if that is not one partition
    partition: dict | None = None
    stored: Checksum | None = None


def verify(stored: DataFrame, wanted: Checksum, partition_by: Sequence[str] = ()) -> Verdict:
    """Compares a stored table with the checksum of what was written, and names the
    partition that differs. A partition that is gone altogether has no name left."""
    found = checksum(stored, partition_by)
    if found == wanted:
        return Verdict(True, None, found)
    off = (found.total - wanted.total) % PRIME
    if not partition_by or not off:
        return Verdict(False, None, found)
    number = (found.located - wanted.located) * pow(off, -1, PRIME) % PRIME
    named = (stored.where(partition_number(partition_by) == F.lit(number).cast(_FIELD))
             .select(*[_quoted(c) for c in partition_by]).distinct().limit(2).collect())
    return Verdict(False, named[0].asDict() if len(named) == 1 else None, found)
