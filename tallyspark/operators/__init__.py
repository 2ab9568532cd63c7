"""DataFrame → DataFrame operators (transforms, keyed ops, joins, reports,
quality rules).

The cleaning transforms and quality checks keep the call signatures a user
of the reference already has (``remove_duplicate_keys(df, key)``,
``assert_unique_key(df, key)``, ...), so one import covers them."""

from tallyspark.operators.keyed import duplicate_summary, remove_duplicate_keys
from tallyspark.operators.quality import (
    assert_not_empty,
    assert_profit_reconciliation,
    assert_required_columns,
    assert_row_count_match,
    assert_unique_key,
    null_summary,
)
from tallyspark.operators.transforms import (
    cast_price_column,
    clean_customer_name,
    derive_category_from_product_id,
    normalize_address,
    parse_date_column,
    round_profit,
    standardize_column_names,
    trim_string_columns,
)

__all__ = [
    "assert_not_empty",
    "assert_profit_reconciliation",
    "assert_required_columns",
    "assert_row_count_match",
    "assert_unique_key",
    "cast_price_column",
    "clean_customer_name",
    "derive_category_from_product_id",
    "duplicate_summary",
    "normalize_address",
    "null_summary",
    "parse_date_column",
    "remove_duplicate_keys",
    "round_profit",
    "standardize_column_names",
    "trim_string_columns",
]
