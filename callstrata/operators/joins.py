"""Lookups of a smaller table from a fact table whose keys may be badly skewed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callstrata.settings import Settings

_ROW_OVERHEAD = 16
_SALT = "_salt"
#: A key is heavy when it holds more than this share of the rows; so there are at most 1,000.
_HEAVY = 0.001
#: So many rows of one key are no burden for a task, whatever their share.
_HEAVY_ROWS = 10_000


def measured_bytes(df: DataFrame) -> int:
    """Bytes a table takes in memory, by one aggregate: fixed widths by type, texts as long as they are."""
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 8
        if isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)) else F.lit(8)
        for f in df.schema.fields
    ]
    row = reduce(lambda a, b: a + b, widths, F.lit(_ROW_OVERHEAD)).cast("bigint")
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def heavy_values(df: DataFrame, value: Column) -> list:
    """The non-null values that more than a thousandth of all rows, and _HEAVY_ROWS of them, hold.

    One pass over the column keeps a thousand candidates in bounded memory, among them every such
    value; a second counts the candidates exactly.
    """
    values = df.select(value.alias("value"))
    listed = values.where(F.col("value").isNotNull()).stat.freqItems(["value"], _HEAVY).first()["value_freqItems"]
    if not listed:
        return []
    counts = values.groupBy(F.when(F.col("value").isin(listed), F.col("value")).alias("value")).count().collect()
    least = max(_HEAVY_ROWS, _HEAVY * sum(r["count"] for r in counts))
    return [r["value"] for r in counts if r["value"] is not None and r["count"] > least]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    spread_by: Sequence[str | Column] = (),
    settings: Settings | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Join ``facts`` to a lookup table: ``left``, ``inner``, ``left_semi`` or ``left_anti``.

    The lookup is broadcast when its measured size is within ``settings.broadcast_bytes``, or
    unmeasured when ``bounded`` says that settings and calendar limit it. Beyond that both sides
    are shuffled. Fact rows of a heavy key then carry a salt derived from their own columns
    (``spread_by``, normally the row id), and only the lookup rows of heavy keys are repeated once
    per salt; all other rows stay single on both sides. Rows with a null key match nothing and are
    spread as well. The salt is a hash rather than a random number, so a task that is run again
    after a lost executor sends its rows to the same place.
    """
    settings = settings or Settings()
    keys = [on] if isinstance(on, str) else list(on)
    if bounded or measured_bytes(lookup) <= settings.broadcast_bytes:
        return facts.join(F.broadcast(lookup), keys, how)

    salts = settings.join_salts
    spread = list(spread_by) or [c for c in facts.columns if c not in keys] or [F.monotonically_increasing_id()]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    key = F.when(whole, F.xxhash64(*keys))
    heavy = heavy_values(facts, key)
    is_heavy = key.isin(heavy) if heavy else F.lit(False)
    salted = facts.withColumn(
        _SALT, F.when(whole & ~is_heavy, 0).otherwise(F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")))
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = lookup.where(whole).withColumn(_SALT, F.explode(copies))
    return salted.join(repeated, [*keys, _SALT], how).drop(_SALT)


def map_values(
    facts: DataFrame, key: str, mapping: dict, value: str, default: str
) -> DataFrame:
    """Add ``value`` looked up by ``key`` in a settings dictionary, else ``default``.

    The dictionary is part of the settings, so it is held by the driver anyway and its size is
    that of the settings file; the literal map below does not grow with the data.
    """
    if not mapping:
        return facts.withColumn(value, F.lit(default))
    entries = [F.lit(str(x)) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), F.col(key).cast("string"))
    return facts.withColumn(value, F.coalesce(found, F.lit(default)))
