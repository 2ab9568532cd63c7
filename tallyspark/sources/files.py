"""File sources and sinks.

Schemas are explicit by default: inference costs an extra pass over the
input and guesses types from whatever rows it sees. ``infer=True`` opts in.
Malformed records never fail the read; with ``corrupt_column`` they are kept
with the raw text in that column (``PERMISSIVE`` mode).

Scale notes: Spark reads a ``multi_line`` CSV or JSON file in one task. With
``split=True`` such a file is read by as many tasks as it has blocks
(``sources.records`` finds the records, Spark's ``from_csv`` / ``from_json``
parse them). Line-delimited CSV and NDJSON split by block by themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyspark.session import ship_package
from tallyspark.sources import records

# Spark's charset lookup rejects the Python-style alias.
_ENCODING_ALIASES = {"latin1": "ISO-8859-1", "latin-1": "ISO-8859-1", "utf8": "UTF-8"}


def _encoding(name: str) -> str:
    return _ENCODING_ALIASES.get(name.lower(), name)


def _with_corrupt(schema: StructType | str | None, corrupt_column: str | None):
    if corrupt_column is None or schema is None:
        return schema
    if isinstance(schema, str):
        return f"{schema}, `{corrupt_column}` string"
    return StructType(list(schema.fields) + [StructField(corrupt_column, StringType())])


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
             *, header: bool = True, multi_line: bool = False, encoding: str = "UTF-8",
             corrupt_column: str | None = None, infer: bool = False, split: bool = False,
             **options) -> DataFrame:
    """``split`` reads files with quoted newlines in parallel: it needs a schema,
    line ends of LF or CRLF, doubled quotes, and an encoding that extends ASCII
    by single bytes or is UTF-8; a pass over files of several blocks runs at
    once. The end of a file is taken without its line end: after a quote that
    nothing closes it is missing from the value, and CRLF in the values of a
    last line without a line end stays as it is.

    With a header, columns of ``schema`` are found by name: the first file's
    header gives their order (a read of its first line), a missing one raises
    ``ValueError``, columns not in the schema are left out, and Spark raises if
    another file has them in another order. Without a header they go by
    position."""
    reader = (spark.read.option("header", header).option("multiLine", multi_line)
              .option("encoding", _encoding(encoding)).option("mode", "PERMISSIVE")
              .option("escape", '"'))
    for k, v in options.items():
        reader = reader.option(k, v)
    wanted = None
    if schema is not None:
        if isinstance(schema, str):
            schema = StructType.fromDDL(schema)
        wanted = [f.name for f in schema.fields] + ([corrupt_column] if corrupt_column else [])
        if header:
            schema = _in_header_order(reader.csv(path).columns, schema, path)
            reader = reader.option("enforceSchema", False)
    elif infer:
        reader = reader.option("inferSchema", True)
    if corrupt_column:
        # whole records are parsed, so that a wrong number of fields shows
        reader = (reader.option("columnNameOfCorruptRecord", corrupt_column)
                  .option("columnPruning", False))
    schema = _with_corrupt(schema, corrupt_column)
    if split and multi_line:
        if schema is None:
            raise ValueError("split=True needs a schema")
        if options.keys() & {"quote", "escape", "lineSep", "comment"}:
            raise ValueError(f"split=True reads doubled quotes and line ends of LF or CRLF only, not {options}")
        out = _split_csv(spark, path, schema, wanted, header, _encoding(encoding), corrupt_column, options)
        return out.select(*[F.col(f"`{c}`") for c in wanted])
    if schema is not None:
        reader = reader.schema(schema)
    out = reader.csv(path)
    return out.select(*[F.col(f"`{c}`") for c in wanted]) if wanted else out


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def _split_csv(spark: SparkSession, path, schema: StructType, wanted: list[str], header: bool, encoding: str,
               corrupt_column: str | None, options: dict) -> DataFrame:
    sep = options.get("sep", options.get("delimiter", ","))
    effects = records.with_csv_effects(records.pieces(spark, path, "\n", encoding), sep)
    rows = records.records(effects, "\n", "", records.start_states(effects, arrays=False))
    # where lines end in CRLF, Spark's reader takes it for LF within values too
    text = F.when(F.endswith("record", F.lit("\r")), F.regexp_replace(
        F.regexp_replace("record", r"\r\z", ""), "\r\n", "\n")).otherwise(F.col("record"))
    rows = rows.select("first", "record", text.alias("text")).where("text <> ''")
    parsing = {**options, "sep": sep, "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    if header:
        given = [c for c in schema.names if c != corrupt_column]
        names = F.from_csv("text", ", ".join(f"c{i} string" for i in range(len(given))), parsing)
        moved = F.lit(False)
        for i, name in enumerate(given):
            if name in wanted:
                moved = moved | ~names[f"c{i}"].eqNullSafe(F.lit(name))
        message = F.concat(F.lit(f"Column {wanted} not at the same places in the header: "), F.col("text"))
        rows = (rows.withColumn("text", F.when(F.col("first") & moved, F.raise_error(message))
                                .otherwise(F.col("text"))).where("NOT first OR text IS NULL"))
    if corrupt_column:
        parsing["columnNameOfCorruptRecord"] = corrupt_column
    out = rows.select("record", F.from_csv("text", _ddl(schema), parsing).alias("row")).select("record", "row.*")
    if corrupt_column:
        out = out.withColumn(corrupt_column, F.when(F.col(f"`{corrupt_column}`").isNotNull(),
                                                    F.regexp_replace("record", r"\r\z", "")))
    return out


def _in_header_order(names: list[str], schema: StructType, path) -> StructType:
    """The schema of a file whose header is ``names``; what is not wanted is text."""
    fields = {f.name: f for f in schema.fields}
    missing = [c for c in fields if c not in names]
    if missing:
        raise ValueError(f"No column {missing} in the header of {path}: {names}")
    return StructType([fields.get(c, StructField(c, StringType())) for c in names])


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None,
              *, multi_line: bool = False, encoding: str | None = None,
              corrupt_column: str | None = None, split: bool = False, **options) -> DataFrame:
    """NDJSON by default; ``multi_line=True`` reads a JSON array (or one
    document) per file. With ``split`` arrays of objects, pretty-printed or
    not, are read in parallel; it needs a schema, and a pass over files of
    several blocks runs at once. A malformed element or a file that is broken
    off then spoils that element only, not its whole file."""
    reader = spark.read.option("multiLine", multi_line).option("mode", "PERMISSIVE")
    if encoding:
        reader = reader.option("encoding", _encoding(encoding))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    schema = _with_corrupt(schema, corrupt_column)
    if split and multi_line:
        if schema is None:
            raise ValueError("split=True needs a schema")
        return _split_json(spark, path, schema, _encoding(encoding or "UTF-8"), corrupt_column, options)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.json(path)


def _split_json(spark: SparkSession, path, schema: StructType | str, encoding: str, corrupt_column: str | None,
                options: dict) -> DataFrame:
    effects = records.with_json_effects(records.pieces(spark, path, "}", encoding))
    rows = records.records(effects, "}", "}", records.start_states(effects, arrays=True))
    element = F.regexp_replace("record", r"^[\s,\[\uFEFF]+", "")
    rows = rows.select(element.alias("record")).where(~F.col("record").rlike(r"^\]?\s*$"))
    parsing = {**options, "mode": "PERMISSIVE"}
    if corrupt_column:
        parsing["columnNameOfCorruptRecord"] = corrupt_column
    return rows.select(F.from_json("record", schema, parsing).alias("row")).select("row.*")


def write_csv(df: DataFrame, path: str, *, header: bool = True, encoding: str = "UTF-8",
              mode: str = "overwrite", **options) -> None:
    """Quoted fields may hold separators, quotes (doubled) and newlines; read
    such files back with ``multi_line=True``. White space at either end of a
    value is kept. A character that the encoding lacks fails the write."""
    charset = _encoding(encoding)
    if charset.upper() != "UTF-8":
        df = df.select(*[_encodable(f.name, charset) if isinstance(f.dataType, StringType)
                         else F.col(f"`{f.name}`") for f in df.schema.fields])
    writer = (df.write.mode(mode).option("header", header).option("encoding", charset)
              .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False))
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.csv(path)


def _encodable(name: str, charset: str) -> Column:
    """The column itself, which raises on a character that the charset lacks."""
    column = F.col(f"`{name}`")
    return F.decode(F.encode(column, charset), charset).alias(name)


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite", **options) -> None:
    writer = df.write.mode(mode)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.json(path)


# Files that land are kept small on disk, and each is small enough for one task to read.
COMPACT = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}
# gzip's fastest level: a third of its time, files that are a quarter to a third larger
COMPACT_FAST = {**COMPACT, "zlib.compress.level": "BEST_SPEED"}

ARRAY_ROWS = 5000


def write_json_arrays(df: DataFrame, path: str, *, mode: str = "overwrite",
                      array_rows: int = ARRAY_ROWS, **options) -> None:
    """Pretty-printed JSON arrays of at most ``array_rows`` rows, one per file, as
    exports deliver them. A task writes its own rows in the order it reads them,
    so nothing is shuffled or stored on the way, and a task that is run again
    replaces all that it wrote. With ``compression`` a file is one block."""
    ship_package(df.sparkSession)
    rows = df.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("row"))
    writer = rows.mapInArrow(partial(_arrays, array_rows), "value string").write.mode(mode)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.option("maxRecordsPerFile", 1).text(path)


def _arrays(array_rows: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of an array for every ``array_rows`` rows of a task, and for the rest."""
    def array() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"value": ["[\n" + ",\n".join(held) + "\n]"]})

    held: list[str] = []
    for batch in batches:
        rows = batch.column(0).to_pylist()
        while rows:
            taken = array_rows - len(held)
            held += rows[:taken]
            rows = rows[taken:]
            if len(held) == array_rows:
                yield array()
                held = []
    if held:
        yield array()
