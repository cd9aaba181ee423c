"""Text cleaning as JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstrata.schemas import OTHER_CATEGORY, UNKNOWN_CATEGORY

# Blank characters below U+0100 (fixed values): plain SQL trim removes spaces only.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"


def trim_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def is_blank(text: Column) -> Column:
    """True for the empty text; null for null."""
    return trim_blanks(text) == ""


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, r"\D+", "")


def alnum_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9]+", "")


def clean_org_number(text: Column) -> Column:
    """Leading digits and hyphens without the hyphens; null when nothing is left."""
    leading = F.regexp_extract(text, r"^([\d-]+)", 1)
    return F.nullif(F.replace(leading, F.lit("-"), F.lit("")), F.lit(""))


def customer_key(org: Column, parent_org: Column, customer_id: Column, name: Column) -> Column:
    """Own organisation number, else the parent's, else the customer id, else the name."""
    return F.coalesce(
        clean_org_number(org),
        clean_org_number(parent_org),
        F.concat(F.lit("CUSTID_"), trim_blanks(customer_id.cast("string"))),
        F.concat(F.lit("NAME_"), alnum_only(name)),
    )


def explode_list(df: DataFrame, column: str) -> DataFrame:
    """One row per non-empty, trimmed member of a comma list."""
    return (
        df.withColumn(column, F.explode(F.split(F.col(column), ",")))
        .withColumn(column, trim_blanks(F.col(column)))
        .where(F.col(column) != "")
    )


def status_is(status: Column, wanted: str) -> Column:
    """Case-insensitive equality; a missing status is simply not equal."""
    return F.coalesce(F.lower(status) == wanted.lower(), F.lit(False))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when the lower-cased text holds one of the words."""
    lowered = F.lower(text)
    hit = F.lit(False)
    for word in words:
        hit = hit | lowered.contains(word)
    return F.coalesce(hit, F.lit(False))


def keyword_category(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``kategori`` from keyword patterns on ``Name``; the last matching category wins."""
    if "Name" not in df.columns:
        return df.withColumn("kategori", F.lit(UNKNOWN_CATEGORY))
    chosen = F.lit(OTHER_CATEGORY)
    for category, words in categories.items():
        pattern = "|".join(words)
        if pattern:
            hit = F.coalesce(F.col("Name").rlike(f"(?iu)(?:{pattern})"), F.lit(False))
            chosen = F.when(hit, F.lit(category)).otherwise(chosen)
    return df.withColumn("kategori", chosen)


def has_parent(parent_id: Column) -> Column:
    """1 for a subsidiary: the parent id is present, not empty and not zero."""
    number = parent_id.try_cast("bigint")
    return F.coalesce((number != 0).cast("int"), F.lit(0))
