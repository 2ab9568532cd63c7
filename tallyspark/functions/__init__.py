"""Row-local Column builders. Each returns a ``pyspark.sql.Column`` made of
built-in expressions only, so it stays inside whole-stage codegen and works
unchanged on batch and streaming DataFrames."""

from tallyspark.functions.codes import (
    REFERENCE_CATEGORY_CODES,
    REFERENCE_SUB_CATEGORY_CODES,
    code_lookup,
    decode_segment,
)
from tallyspark.functions.names import standardized_name
from tallyspark.functions.parsing import money, parse_date, round_money, try_double
from tallyspark.functions.text import clean_person_name, join_lines, trimmed

__all__ = [
    "REFERENCE_CATEGORY_CODES",
    "REFERENCE_SUB_CATEGORY_CODES",
    "clean_person_name",
    "code_lookup",
    "decode_segment",
    "join_lines",
    "money",
    "parse_date",
    "round_money",
    "standardized_name",
    "trimmed",
    "try_double",
]
