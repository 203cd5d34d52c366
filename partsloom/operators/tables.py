"""Structural cleanup and validation of extracted tables, over many pages at once.

A table row is (pdf_id, page_number, row_idx, names, values): arrays of the page's column
names and the row's values. Column statistics are one aggregate by page, combined before its
shuffle; which columns stay is decided on the page's one row. No row is spread over tasks, joined
back or read twice to validate a page, and no window is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsloom.functions.text import DESCRIPTION_COLUMN, ITEM_COLUMN, null_if_na
from partsloom.schemas import COLUMNS

PAGE = ["pdf_id", "page_number"]
NULL_SHARE, SAME_SHARE = 0.95, 0.90


def table_rows(parts: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Wide part rows to table rows; null spellings become null.

    A row delivered again (same page and index) counts once, by its earliest delivery.
    """
    values = F.array(*[null_if_na(F.col(c)) for c in columns])
    first = parts.groupBy(*PAGE, "row_idx").agg(F.min(F.struct("extracted_at", "row_id", values.alias("values"))).alias("r"))
    return first.select(*PAGE, "row_idx", F.array(*map(F.lit, columns)).alias("names"), "r.values")


def rows_of_cells(cells: DataFrame) -> DataFrame:
    """Long cells (col_idx, col_name, value) to table rows."""
    cell = F.struct("col_idx", "col_name", "value")
    out = cells.groupBy(*PAGE, "row_idx").agg(F.array_sort(F.collect_list(cell)).alias("c"))
    return out.select(*PAGE, "row_idx", F.transform("c", lambda c: c["col_name"]).alias("names"), F.transform("c", lambda c: c["value"]).alias("values"))


def cells_of_rows(rows: DataFrame) -> DataFrame:
    zipped = F.arrays_zip("names", "values")
    return rows.select(*PAGE, "row_idx", F.posexplode(zipped).alias("col_idx", "c")).select(*PAGE, "row_idx", "col_idx", F.col("c.names").alias("col_name"), F.col("c.values").alias("value"))


def page_profiles(rows: DataFrame, width: int | None = None) -> DataFrame:
    """(page, n, names, nulls, same): one row a page from one aggregate.

    `nulls[i]` counts the nulls of column i, `same[i * width + j]` (i < j) the rows in which columns
    i and j are equal (two nulls are). So what is left of a column's left neighbours can be
    decided on the page's row, and the table rows are read once and never joined back. A page has one
    header. `width` is the most columns a page has; it is counted where it isn't given.
    """
    if width is None:
        width = rows.agg(F.max(F.size("names"))).first()[0] or 0
    value = [F.get("values", F.lit(i)) for i in range(width)]
    tally = lambda c: F.sum(c.cast("int"))
    nulls = [tally(value[i].isNull()).alias(f"n{i}") for i in range(width)]
    same = [tally(value[i].eqNullSafe(value[j])).alias(f"s{i}_{j}") for i in range(width) for j in range(i + 1, width)]
    out = rows.groupBy(*PAGE).agg(F.count("*").alias("n"), F.first("names").alias("names"), *nulls, *same)
    grid = [F.col(f"s{i}_{j}") if i < j else F.lit(0).cast("bigint") for i in range(width) for j in range(width)]
    empty = F.array().cast("array<bigint>")
    return out.select(*PAGE, "n", "names", (F.array(*[f"n{i}" for i in range(width)]) if width else empty).alias("nulls"), (F.array(*grid) if width else empty).alias("same"), F.lit(width).alias("width"))


def _judged(profiles: DataFrame, null_share: float, same_share: float) -> DataFrame:
    """Adds `cols`: index, name, null ratio, whether it is filled, ratio of equality with the filled column to the left, whether it stays."""
    share = lambda c: c.cast("double") / F.col("n")
    ratio = F.transform("nulls", lambda x: share(x))
    with_ratio = profiles.withColumn("_r", F.slice(ratio, 1, F.size("names")))
    filled = F.filter(F.transform("_r", lambda r, i: F.when(r < null_share, i)), lambda i: i.isNotNull())
    with_filled = with_ratio.withColumn("_f", filled)

    def column(r, i):
        at = F.array_position("_f", i)
        left = F.get("_f", (at - 2).cast("int"))
        same = F.when(at > 1, share(F.get("same", (left * F.col("width") + i).cast("int"))))
        stays = (at > 0) & (same.isNull() | (same < same_share))
        return F.struct(i.alias("col_idx"), F.get("names", i).alias("col_name"), r.alias("null_ratio"), (at > 0).alias("filled"), same.alias("same_ratio"), stays.alias("stays"))

    return with_filled.withColumn("cols", F.transform("_r", column)).drop("_r", "_f")


def _columns(rows: DataFrame, null_share: float, same_share: float, width: int | None) -> DataFrame:
    judged = _judged(page_profiles(rows, width), null_share, same_share)
    return judged.select(*PAGE, F.explode("cols").alias("c")).select(*PAGE, "c.*")


def null_ratios(rows: DataFrame, width: int | None = None) -> DataFrame:
    """(page, col_idx, col_name, null_ratio)"""
    return _columns(rows, NULL_SHARE, SAME_SHARE, width).select(*PAGE, "col_idx", "col_name", "null_ratio")


def same_ratios(rows: DataFrame, null_share: float = NULL_SHARE, width: int | None = None) -> DataFrame:
    """(page, col_idx, col_name, same_ratio): how often a kept column equals its left neighbour (null for the first)."""
    return _columns(rows, null_share, SAME_SHARE, width).where("filled").select(*PAGE, "col_idx", "col_name", "same_ratio")


def cleaned_columns(rows: DataFrame, null_share: float = NULL_SHARE, same_share: float = SAME_SHARE, width: int | None = None) -> DataFrame:
    """(page, col_idx, col_name) of the columns that stay. A column is held against its left
    neighbour even if that one is dropped itself."""
    return _columns(rows, null_share, same_share, width).where("stays").select(*PAGE, "col_idx", "col_name")


def valid_pages(rows: DataFrame, null_share: float = NULL_SHARE, same_share: float = SAME_SHARE, width: int | None = None) -> DataFrame:
    """(page, n_rows) of pages with rows whose remaining columns name an item number and a description."""
    judged = _judged(page_profiles(rows, width), null_share, same_share)
    named = lambda pattern: F.exists("cols", lambda c: c["stays"] & c["col_name"].rlike(pattern))
    return judged.where(named(ITEM_COLUMN) & named(DESCRIPTION_COLUMN)).select(*PAGE, F.col("n").alias("n_rows"))


def cleaned_tables(rows: DataFrame, width: int | None = None) -> DataFrame:
    """Cells of the remaining columns."""
    judged = _judged(page_profiles(rows, width), NULL_SHARE, SAME_SHARE)
    stay = judged.select(*PAGE, F.transform(F.filter("cols", lambda c: c["stays"]), lambda c: c["col_idx"]).alias("_stay"))
    kept = rows.join(stay, PAGE)
    cell = lambda i: F.struct(i.alias("col_idx"), F.get("names", i).alias("col_name"), F.get("values", i).alias("value"))
    return kept.select(*PAGE, "row_idx", F.explode(F.transform("_stay", cell)).alias("c")).select(*PAGE, "row_idx", "c.*")
