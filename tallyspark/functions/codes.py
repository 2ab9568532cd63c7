"""Decoding attributes that are embedded in a coded identifier."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference catalog's code tables. A product id reads
# CAT-SU-NUMBER; characters 1-3 code the category, characters 5-6 the
# sub-category. An unknown code decodes to NULL.
REFERENCE_CATEGORY_CODES = {
    "FUR": "Furniture",
    "OFF": "Office Supplies",
    "TEC": "Technology",
}
REFERENCE_SUB_CATEGORY_CODES = {
    "AC": "Accessories",
    "AP": "Appliances",
    "AR": "Art",
    "BI": "Binders",
    "BO": "Bookcases",
    "CH": "Chairs",
    "CO": "Copiers",
    "EN": "Envelopes",
    "FA": "Fasteners",
    "FU": "Furnishings",
    "LA": "Labels",
    "MA": "Machines",
    "PA": "Paper",
    "PH": "Phones",
    "ST": "Storage",
    "SU": "Supplies",
    "TA": "Tables",
}
CATEGORY_SPAN = (1, 3)
SUB_CATEGORY_SPAN = (5, 2)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decode_segment(code_source: str | Column, start: int, length: int,
                   codes: Mapping[str, str]) -> Column:
    """Label for the code at 1-based ``start`` (``length`` chars); NULL if unknown.

    The table is a literal map, so the lookup is a constant-folded hash probe
    inside codegen: no join, nothing broadcast that grows with the data."""
    if not codes:
        return F.lit(None).cast("string")
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in codes.items()))
    return F.try_element_at(table, F.substring(_col(code_source), start, length))


def code_lookup(current: str | Column, code_source: str | Column, start: int, length: int,
                codes: Mapping[str, str]) -> Column:
    """Keep ``current`` where present; otherwise decode it from ``code_source``."""
    return F.coalesce(_col(current), decode_segment(code_source, start, length, codes))
