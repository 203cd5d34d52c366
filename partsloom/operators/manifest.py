"""Manifests: which figure image belongs to which table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsloom.functions.text import relativize
from partsloom.schemas import MANIFEST_PATHS
from partsloom.session import cut_lineage

THRESHOLD = 5


def _path(folder: str, page: str, suffix: str):
    return F.format_string(f"{folder}/page_%d.{suffix}", page)


def manifest_rows(pair_tables: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows of pairs that have a figure page, for valid table pages only."""
    rows = pair_tables.where(F.col("figure_page").isNotNull())
    pages = valid.select("pdf_id", F.col("page_number").alias("table_page"))
    rows = rows.join(pages, ["pdf_id", "table_page"], "left_semi")
    return rows.select(
        "pdf_id",
        "pair_ordinal",
        "first_index",
        _path("figures", "figure_page", "png").alias("figure_path"),
        _path("tables", "table_page", "png").alias("table_path"),
        _path("table_data", "table_page", "tsv").alias("tsv_path"),
        F.col("key").alias("figure"),
    )


def within_threshold(rows: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Without figures that have more rows than `threshold`; captions on one page share the budget."""
    rows = cut_lineage(rows)  # counted and filtered: planned and evaluated once
    few = rows.groupBy("pdf_id", "figure_path").agg(F.count("tsv_path").alias("_n")).where(F.col("_n") <= threshold)
    return rows.join(few, ["pdf_id", "figure_path"], "left_semi")


def local_manifest(pair_tables: DataFrame, valid: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Manifest rows of all manuals. No pair with a valid table, or none after the threshold, is a manifest without
    rows; the command line reports manuals of the first kind and writes nothing for them."""
    return within_threshold(manifest_rows(pair_tables, valid), threshold)


def relative_paths(manifest: DataFrame) -> DataFrame:
    for c in MANIFEST_PATHS:
        if c in manifest.columns:
            manifest = manifest.withColumn(c, relativize(F.col(c), F.col("pdf_id")))
    return manifest


def with_pdf_id_after_figure(manifest: DataFrame) -> DataFrame:
    cols = [c for c in manifest.columns if c != "pdf_id"]
    at = cols.index("figure") + 1 if "figure" in cols else len(cols)
    return manifest.select(*cols[:at], "pdf_id", *cols[at:])


def global_manifest(manifests: list[DataFrame] | DataFrame) -> DataFrame:
    """Union by name of manifests (missing columns are null), or rows of many read at once; paths relative, `pdf_id` after `figure`."""
    manifests = [manifests] if isinstance(manifests, DataFrame) else manifests
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), manifests)
    return with_pdf_id_after_figure(relative_paths(merged))
