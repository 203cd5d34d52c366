"""Run and corpus summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(status: DataFrame) -> DataFrame:
    """Succeeded, skipped and failed items by manual, with a grand total (null manual)."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    return status.rollup("pdf_id").agg(count("succeeded"), count("skipped"), count("failed"))


def corpus_summary(manifest: DataFrame) -> DataFrame:
    """(pdf_id, n_rows, n_figures, n_figure_paths)"""
    return manifest.groupBy("pdf_id").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("figure").alias("n_figures"),
        F.countDistinct("figure_path").alias("n_figure_paths"),
    )


def manuals_in_order(rows: DataFrame, place: str) -> DataFrame:
    """(pdf_id, place): each manual once with its first place, in the order in which manuals first appear."""
    return rows.groupBy("pdf_id").agg(F.min(place).alias("place")).orderBy("place", "pdf_id")


def element_summary(classified: DataFrame) -> DataFrame:
    """(pdf_id, n_figures, n_tables, n_elements)"""
    count = lambda c: F.count_if(F.col("class") == c)
    return classified.groupBy("pdf_id").agg(count("figure").alias("n_figures"), count("table").alias("n_tables"), F.count("*").alias("n_elements"))
