"""Line deduplication by site-relative frequency; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, packed

BROADCAST_BYTES = 8 << 20


def _print(text) -> Column:
    """60 bits of the text's MD5: copies of a page have the same, and it picks the page that keeps a line."""
    return F.conv(F.substring(F.md5(F.encode(text, "UTF-8")), 1, 15), 16, 10).cast("long")


def boilerplate_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.1, min_pages: int = 2, certain: int = 20) -> DataFrame:
    """Rows (host, line, pages, host_pages, keeper): lines on more than `ratio` of a host's pages, and on `min_pages` at least.

    Pages of equal text are one page, so copies are no evidence. A line counts once per page, without surrounding
    blanks; blank lines never count. Of a line on fewer than `certain` pages, which may also be a passage of a few near
    copies, `keeper` is the print of the one text that keeps it; else it is null. Partial sums run before the shuffle, so
    a hot host reaches its task as one row per map task, and a hot line as one per map task and text. At most (lines of
    the host) / max(min_pages, ratio * pages) rows can come out per host.
    """
    rows = docs.select(F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), F.col(text_col).alias("text"), _print(F.coalesce(text_col, F.lit(""))).alias("page"))
    trimmed = F.filter(F.array_distinct(F.transform(F.split("text", "\n"), lambda x: F.trim(x))), lambda x: x != "")
    totals = materialize(rows.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages")))
    # Counted by hashes first, in a few bytes a line; lines that may be boilerplate are then counted by themselves.
    hashed = rows.select(F.xxhash64("host").alias("h"), "page", F.explode(F.transform(trimmed, lambda x: F.xxhash64(x))).alias("l")).distinct()
    least = totals.groupBy(F.xxhash64("host").alias("h")).agg(F.min("host_pages").alias("n"))
    often = hashed.groupBy("h", "l").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages).join(least, "h").where(F.col("pages") > ratio * F.col("n"))
    often = materialize(often.select("h", "l"))
    known = F.broadcast(often) if often.count() * 16 <= BROADCAST_BYTES else often
    lines = rows.select("host", "page", F.explode(trimmed).alias("line")).withColumns({"h": F.xxhash64("host"), "l": F.xxhash64("line")})
    lines = lines.join(known, ["h", "l"], "left_semi").select("host", "page", "line").distinct()
    pages = lines.groupBy("host", "line").agg(F.count("*").alias("pages"), F.min("page").alias("keeper")).where(F.col("pages") >= min_pages)
    out = pages.join(totals, "host").where(F.col("pages") > ratio * F.col("host_pages"))
    return out.select("host", "line", "pages", "host_pages", F.when(F.col("pages") < certain, F.col("keeper")).alias("keeper"))


def drop_boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.1, min_pages: int = 2, certain: int = 20) -> DataFrame:
    """`docs` with the boilerplate lines of their host cut out of `text_col`, and columns __n_lines and __n_dropped.

    The other lines stay as they are, in their order, joined by line feeds. No text loses its last copy: a line on fewer
    than `certain` pages of a host stays on one of them (`keeper`), and a page that would have no line left but blank
    ones stays whole. A null text stays null and has no line; an
    empty text is one blank line; null hosts are one host. All columns and rows pass through, but for columns named as
    the new ones, which are replaced; an empty table gives none. The lines to drop are
    gathered per host into one array: it goes to every task if all arrays together are below 8 MB, as measured after
    they are written; beyond that rows and arrays meet in a join by host whose hot keys AQE splits.
    """
    found = boilerplate_lines(docs, host_col, text_col, ratio, min_pages, certain)
    bad = materialize(found.groupBy(F.col("host").alias("__host")).agg(F.collect_list(F.struct("line", "keeper")).alias("__all")))
    size = bad.agg(F.sum(F.octet_length(F.array_join("__all.line", "")) + 24 * F.size("__all") + F.octet_length("__host") + 64)).first()[0] or 0
    known = F.broadcast(bad) if size <= BROADCAST_BYTES else bad
    rows, back = packed(docs, *{text_col: 0, host_col: 0}, drop=("__n_lines", "__n_dropped"))
    rows = rows.select(F.col(text_col).alias("__text"), F.col(host_col).alias("__of"), "__rest").withColumn("__host", F.coalesce(F.col("__of").cast("string"), F.lit(""))).join(known, "__host", "left")
    lines = F.split("__text", "\n")
    touched = F.col("__all").isNotNull() & F.arrays_overlap(F.transform(lines, lambda x: F.trim(x)), F.col("__all.line"))
    mine = F.transform(F.filter("__all", lambda x: ~F.coalesce(x["keeper"] == F.col("__page"), F.lit(False))), lambda x: x["line"])
    rows = rows.withColumn("__page", F.when(touched, _print(F.col("__text")))).withColumn("__bad", F.when(F.col("__page").isNotNull(), mine))
    rows = rows.withColumn("__left", F.when(F.col("__page").isNotNull(), F.filter(lines, lambda x: ~F.array_contains(F.col("__bad"), F.trim(x)))))
    rows = rows.withColumn("__kept", F.when(F.exists("__left", lambda x: F.trim(x) != ""), F.col("__left")))
    rows = rows.select(
        F.when(F.col("__kept").isNotNull(), F.array_join("__kept", "\n")).otherwise(F.col("__text")).alias(text_col),
        *([F.col("__of").alias(host_col)] if host_col != text_col else []),
        "__rest",
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("__n_lines"),
        F.coalesce(F.size(lines) - F.size("__kept"), F.lit(0)).cast("long").alias("__n_dropped"),
    )
    return rows.select(*back, "__n_lines", "__n_dropped")
