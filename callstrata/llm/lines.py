"""Boilerplate lines, judged by how many of a host's pages carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callstrata.llm.common import packed, stored

#: Copies of a host's list of boilerplate lines when that list is too big to broadcast.
SALTS = 32
#: Lists of so many lines in all may be broadcast (8 bytes a line).
BROADCAST_LINES = 1_000_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, host: str = "source", max_ratio: float = 0.08, min_pages: int = 5) -> DataFrame:
    """(host, line, pages, total): lines on more than max_ratio of a host's distinct pages.

    A page is a distinct text of a host, so exact copies of one page are no evidence. A line counts
    once per page, compared without outer spaces; blank lines never count. min_pages keeps small
    hosts from having boilerplate at all. Hot hosts and hot lines are counted before the shuffle.
    """
    pages = docs.select(F.col(host).alias("host"), _lines(F.col("text")).alias("lines"), F.xxhash64("text").alias("page"))
    return _boilerplate(pages, max_ratio, min_pages)


def _boilerplate(pages: DataFrame, max_ratio: float, min_pages: int) -> DataFrame:
    hashed = pages.select(
        "host", "page",
        F.array_distinct(F.transform(F.filter("lines", lambda x: F.trim(x) != ""), _hash)).alias("lines"),
    )
    # copies of a page agree on all columns, so one row per page is left before lines are spread
    once = stored(hashed.groupBy("host", "page").agg(F.first("lines").alias("lines")))
    totals = once.groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    counts = once.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    hosts = totals.select(F.col("host").alias("__host"), "total")
    # a host has at most (mean lines per page / max_ratio) such lines, whatever its size
    return counts.join(hosts, counts["host"].eqNullSafe(hosts["__host"])).where(
        F.col("pages") > F.lit(max_ratio) * F.col("total")).select("host", "line", "pages", "total")


def drop_boilerplate(
    docs: DataFrame, host: str = "source", max_ratio: float = 0.08, min_pages: int = 5,
    count: str | None = "__lines_dropped",
) -> DataFrame:
    """docs with boilerplate lines cut out of `text`; `n_chars`, if there, is the new length.

    Adds the number of lines cut as column `count` (None: no such column). Rows stay rows: a text of
    boilerplate only becomes empty, a null text stays null, an empty one empty. A null host is a host
    of its own. Repeated rows have equal results; copies count as one page. Other columns, whatever
    their names, pass unchanged. The main path is DataFrame functions only.
    """
    listed = stored(boilerplate(docs, host, max_ratio, min_pages))
    per_host = stored(listed.groupBy(F.col("host").alias("of")).agg(F.collect_set("line").alias("listed")))
    # collect_set: bounded per host, see boilerplate(); counted below before it is broadcast
    own = packed(docs, F.col(f"`{host}`").alias("host"), "text")
    if listed.count() <= BROADCAST_LINES:
        joined = own.join(F.broadcast(per_host), own["host"].eqNullSafe(per_host["of"]), "left")
    else:
        salted = per_host.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = own.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
        joined = own.join(salted, own["host"].eqNullSafe(salted["of"]) & (own["salt"] == salted["copy"]), "left")
    lines = _lines(F.col("text"))
    # first the few listed lines of this text, then each line against those few
    bad = F.array_intersect(F.transform(lines, _hash), F.col("listed"))
    marked = joined.withColumn("bad", F.when(F.col("listed").isNotNull(), bad))
    keep = F.filter(lines, lambda x: ~F.array_contains(F.col("bad"), _hash(x)) | (F.trim(x) == ""))
    touched = F.coalesce(F.size("bad") > 0, F.lit(False)) & F.col("text").isNotNull()
    cut = marked.select(
        "row", F.when(touched, F.array_join(keep, "\n")).otherwise(F.col("text")).alias("text"),
        F.when(touched, F.size(lines) - F.size(keep)).otherwise(F.lit(0)).alias("dropped"))
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField(
            "n_chars", F.when(F.col("dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars")))
    more = [F.col("dropped").alias(count)] if count else []
    return cut.select(row.alias("row"), *more).select("row.*", *([count] if count else []))
