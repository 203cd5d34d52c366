"""Which page images are needed, and which are missing."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DPI = 200


def required_pages(classified: DataFrame, only_paired: DataFrame | None = None) -> DataFrame:
    """(pdf_id, kind, page_number) of figures and tables with a page, once each.

    With `only_paired` (pair tables), tables that no surviving pair reaches are left out.
    """
    out = classified.where((F.col("class") != "other") & F.col("page_number").isNotNull())
    out = out.select("pdf_id", F.col("class").alias("kind"), "page_number").distinct()
    if only_paired is not None:
        reached = only_paired.select("pdf_id", F.lit("table").alias("kind"), F.col("table_page").alias("page_number"))
        out = out.where("kind = 'figure'").unionByName(out.where("kind = 'table'").join(reached, ["pdf_id", "kind", "page_number"], "left_semi"))
    return out


def missing_pages(required: DataFrame, present: DataFrame) -> DataFrame:
    """Required pages without an image."""
    return required.join(present, ["pdf_id", "kind", "page_number"], "left_anti")


def all_present(required: DataFrame, present: DataFrame) -> bool:
    return missing_pages(required, present).isEmpty()


Renderer = Callable[[str, Iterable[tuple[str, int]], int], Iterable[tuple[str, int, bytes]]]


def default_renderer(tolerate_truncated: bool = True) -> Renderer | None:
    """The installed PDF renderer, or None. Damaged embedded images are drawn as far as they go."""
    try:
        from pdf2image import convert_from_path
    except ImportError:
        return None

    def run(path: str, todo, dpi: int):
        import io

        if tolerate_truncated:
            from PIL import ImageFile

            ImageFile.LOAD_TRUNCATED_IMAGES = True
        for kind, page in todo:
            images = convert_from_path(path.removeprefix("file:"), dpi=dpi, first_page=page, last_page=page)
            if images:
                out = io.BytesIO()
                images[0].save(out, "PNG")
                yield kind, page, out.getvalue()

    return run


def render(pages: DataFrame, pdfs: DataFrame, renderer: Renderer, dpi: int = DPI, batch: int = 50) -> DataFrame:
    """(pdf_id, kind, page_number, png): pages rendered in batches of one manual.

    `renderer(path, [(kind, page)], dpi)` yields (kind, page, png). A large manual is split
    into batches of pages, so it spreads over tasks; a file is opened once a batch.
    """
    work = pages.join(pdfs.select("pdf_id", "path"), "pdf_id").withColumn("_b", F.floor(F.col("page_number") / batch))

    def run(pdf):
        import pandas as pd

        todo = sorted(zip(pdf["kind"], pdf["page_number"].astype(int)), key=lambda x: (x[1], x[0]))
        rows = [(pdf["pdf_id"].iloc[0], k, p, png) for k, p, png in renderer(pdf["path"].iloc[0], todo, dpi)]
        return pd.DataFrame(rows, columns=["pdf_id", "kind", "page_number", "png"])

    return work.groupBy("pdf_id", "_b").applyInPandas(run, "pdf_id string, kind string, page_number int, png binary")
