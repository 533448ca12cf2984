"""Line de-duplication by site-relative frequency (operator 8), DataFrame functions only.

A line's frequency on a site is the number of the site's pages that hold it over the number of its pages. Lines above
the ratio are boilerplate of that site and leave all its pages. Digests of lines are counted first: only a line whose
digest is frequent enough can be, so texts of lines are counted for those alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourline.llm.common import unused
from hourline.session import stage

RATIO, LEAST_PAGES = 0.05, 3


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _keys(text: Column) -> Column:
    """The distinct lines of a page, without blanks at their ends; empty lines are none."""
    return F.filter(F.array_distinct(F.transform(lines_of(text), lambda x: F.trim(x))), lambda x: x != "")


def _text_key(text: Column) -> Column:
    return F.sha2(F.coalesce(F.concat(F.lit("="), text), F.lit("")), 256)


def boilerplate(
    pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES, once: bool = False
) -> DataFrame:
    """host, line, pages (that hold the line), total (pages of the host), for the lines above the ratio.

    A page counts a line once; a line on fewer than ``least_pages`` pages is never boilerplate. Pages without a host
    belong to no site and are not counted; a page with a null text is a page of its host without lines. A host has at
    most (mean distinct lines of its pages / ratio) such lines, however many pages it has.

    Copies of a page are pages like others: where they make up more than ``ratio`` of a host (and ``least_pages`` at
    least), all their lines are above it. With ``once``, every distinct text of a host is one page, so that copies alone
    make no line boilerplate; copies that differ in a character still are pages of their own.
    """
    rows = pages.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.col(text).alias("text"))
    own = rows.select("host", _text_key(F.col("text")).alias("page")).distinct() if once else rows
    totals = own.groupBy("host").agg(F.count("*").alias("total"))
    page = [_text_key(F.col("text")).alias("page")] if once else []
    lines = rows.select("host", *page, F.explode(_keys(F.col("text"))).alias("line"))
    above = (F.col("pages") > ratio * F.col("total")) & (F.col("pages") >= least_pages)
    hashed = rows.select("host", F.explode(F.transform(_keys(F.col("text")), lambda x: F.xxhash64(x))).alias("h"))
    likely = hashed.groupBy("host", "h").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages)
    likely = stage(likely.join(totals, "host").where(above).select("host", "h", "total"), "likely-lines")
    counted = lines.withColumn("h", F.xxhash64("line")).join(likely, ["host", "h"])
    if once:  # digests were counted with copies, which only lets more lines through to here
        counted = counted.select("host", "line", "page", "total").distinct()
    counted = counted.groupBy("host", "line").agg(F.count("*").alias("pages"), F.max("total").alias("total"))
    return counted.where(above)


def _listed(pages: DataFrame, host: str, text: str, ratio: float, least_pages: int, once: bool = False) -> DataFrame:
    """One row per host with boilerplate; written, so that Spark knows its size when it plans the join with the pages."""
    found = boilerplate(pages, host, text, ratio, least_pages, once)
    return stage(found.groupBy("host").agg(F.collect_list("line").alias("_boilerplate")), "boilerplate").withColumnRenamed("host", "_host")


def _kept_lines(text: Column, boilerplate_lines: str = "_boilerplate") -> Column:
    return F.filter(lines_of(text), lambda x: ~F.array_contains(F.col(boilerplate_lines), F.trim(x)))


def line_report(pages: DataFrame, id: str, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per page: id, host, n_lines, n_dropped, text without the boilerplate of its site (null stays null). Copies
    count as pages of their own, so a group of copies above the ratio loses every line."""
    rows = pages.select(F.col(id).alias(id), F.col(host).alias("host"), F.col(text).alias("text"))
    held = rows.join(_listed(rows, "host", "text", ratio, least_pages), F.col("host") == F.col("_host"), "left")
    kept = F.when(F.col("_boilerplate").isNull(), lines_of(F.col("text"))).otherwise(_kept_lines(F.col("text")))
    held = held.select(id, "host", F.coalesce(F.size(lines_of(F.col("text"))), F.lit(0)).alias("n_lines"), kept.alias("kept"), F.col("text").isNull().alias("none"))
    dropped = F.when(F.col("none"), 0).otherwise(F.col("n_lines") - F.size("kept"))
    return held.select(
        id, "host", F.when(F.col("none"), 0).otherwise(F.col("n_lines")).alias("n_lines"), dropped.alias("n_dropped"), F.array_join("kept", "\n").alias("text")
    )


def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """All rows and columns, ``text`` without the boilerplate of its site. Only texts that lose a line change. Copies of a
    page count once, so that a group of copies is not emptied for being one."""
    site, gone = unused(pages, "_host"), unused(pages, "_boilerplate")
    listed = _listed(pages, host, text, ratio, least_pages, once=True).withColumnsRenamed({"_host": site, "_boilerplate": gone})
    held = pages.join(listed, F.col(f"`{host}`") == F.col(site), "left")
    clean = F.when(F.col(gone).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(_kept_lines(F.col(f"`{text}`"), gone), "\n"))
    return held.select(*[clean.alias(c) if c == text else F.col(f"`{c}`") for c in pages.columns])
