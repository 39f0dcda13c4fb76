"""Recommendation-list text formats as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a recommended item is a quoted run of letters, digits, '.' and '_'.
QUOTED_ITEM_PATTERN = r"""["']+([a-zA-Z._0-9]+)["']+"""


def strip_quotes(c: Column) -> Column:
    """remove both quote characters, then surrounding spaces."""
    return F.trim(F.translate(c, "\"'", ""))


def parse_rec_line(value: Column):
    """S9 on one line -> (key, has_comma, recs ARRAY<STRING>)."""
    parts = F.split(value, ",", 2)
    has_comma = F.size(parts) == 2
    recs = F.when(has_comma, F.regexp_extract_all(parts.getItem(1), F.lit(QUOTED_ITEM_PATTERN), F.lit(1))
                  ).otherwise(F.array().cast("array<string>"))
    return strip_quotes(parts.getItem(0)), has_comma, recs


def format_rec_line(key: Column, items: Column, score_format: str = "%d") -> Column:
    """K3: ``"key",("a",s1),("b",s2)...`` from an ordered ARRAY<STRUCT<other, score>>."""
    entries = F.transform(items, lambda x: F.format_string('("%s",' + score_format + ")", x["other"], x["score"]))
    return F.concat(F.lit('"'), key, F.lit('",'), F.array_join(entries, ","))


def format_scored_line(key: Column, items: Column, score_format: str = "%.6f") -> Column:
    """``"key",("a",s1),...`` from an ordered ARRAY<STRUCT<other, score>>; ``"key"`` alone without items.

    Keys and items may be numbers or names.
    """
    entries = F.transform(items, lambda x: F.format_string('("%s",' + score_format + ")", x["other"].cast("string"), x["score"]))
    return F.concat(F.lit('"'), key.cast("string"), F.lit('"'),
                    F.when(F.size(items) > 0, F.concat(F.lit(","), F.array_join(entries, ","))).otherwise(F.lit("")))


def format_tsv_line(key: Column, others: Column) -> Column:
    """K3e: ``key<TAB>o1,o2,...`` (ids only)."""
    return F.concat(key.cast("string"), F.lit("\t"), F.array_join(others, ","))


def parse_validation_line(value: Column):
    """``key,a; b; c`` -> (key, has_comma, ARRAY<STRING> of trimmed distinct entries)."""
    parts = F.split(F.trim(value), ",")
    items = F.array_distinct(F.transform(F.split(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), ";"), lambda x: F.trim(x)))
    return F.get(parts, F.lit(0)), F.size(parts) >= 2, F.filter(items, lambda x: x != "")


def parse_basket_line(value: Column) -> Column:
    """Whitespace-separated items -> distinct ARRAY<STRING>."""
    stripped = F.regexp_replace(value, r"^\s+|\s+$", "")
    return F.when(stripped == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.split(stripped, r"\s+")))
