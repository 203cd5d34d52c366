"""Document elements: one delivery each, and their classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsloom.functions.text import caption_number, clean_text
from partsloom.operators.nested import valid_json


def elements_of(metadata: DataFrame) -> DataFrame:
    """(pdf_id, element_index, type, element_id, page_number, text) from delivered element rows.

    An element delivered again (same manual and index) counts once: the earliest delivery,
    ties by element id. Unreadable metadata gives a null page. Rows without index are out.
    """
    page = F.try_variant_get(valid_json(F.col("metadata")), "$.page_number", "int")
    rows = metadata.where(F.col("element_index").isNotNull()).select(
        "pdf_id", "element_index", F.struct("loaded_at", "element_id", "type", "text", page.alias("page_number")).alias("e")
    )
    first = rows.groupBy("pdf_id", "element_index").agg(F.min("e").alias("e"))
    return first.select("pdf_id", "element_index", "e.type", "e.element_id", "e.page_number", "e.text")


def classify(elements: DataFrame, mode: str = "lenient") -> DataFrame:
    """Adds `text` trimmed, `figure_number` and `class`: a caption comes before a table."""
    out = elements.withColumn("text", clean_text(F.col("text")))
    out = out.withColumn("figure_number", caption_number(F.col("text"), mode))
    kind = F.when(F.col("figure_number").isNotNull(), "figure").when(F.col("type") == "Table", "table").otherwise("other")
    return out.withColumn("class", kind)
