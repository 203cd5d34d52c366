"""Figures paired with the tables of their figure block.

The scan over a manual is done in two levels, so that a manual of any length is never one
task: elements are cut by their index into chunks, every chunk is scanned alone, and the
chunks' summaries (one row each) carry figure number, group number and sheet counts on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from partsloom.operators.elements import classify
from partsloom.session import cut_lineage

#: Elements of a manual scanned by one window.
CHUNK = 20_000


def sheets(classified: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Figure records with `sheet_index`: the running count of the figure number in the manual."""
    figs = classified.where(F.col("class") == "figure").withColumn("_c", F.floor(F.col("element_index") / chunk))
    key = ["pdf_id", "figure_number"]
    local = F.row_number().over(Window.partitionBy(*key, "_c").orderBy("element_index"))
    counts = figs.groupBy(*key, "_c").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*key).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*key, "_c", F.coalesce(before, F.lit(0)).alias("_b"))
    out = figs.withColumn("_l", local).join(counts, [*key, "_c"])
    return out.select("pdf_id", "figure_number", (F.col("_l") + F.col("_b")).cast("int").alias("sheet_index"), "text", "page_number", "element_index")


def groups(classified: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Captions and tables with `group_id`: 0 before the first caption, else the number of the
    block, which begins where the figure number differs from the caption before it."""
    # Captions and tables are read twice, for the chunks' summaries and to carry these on.
    rows = cut_lineage(classified.where(F.col("class") != "other").withColumn("_c", F.floor(F.col("element_index") / chunk)))
    w = Window.partitionBy("pdf_id", "_c").orderBy("element_index")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    fig = F.when(F.col("class") == "figure", F.col("figure_number"))
    rows = rows.withColumn("_f", fig).withColumn("_p", F.last("_f", ignorenulls=True).over(past))
    changed = (F.col("_f").isNotNull() & F.col("_p").isNotNull() & (F.col("_f") != F.col("_p"))).cast("int")
    rows = rows.withColumn("_x", changed).withColumn("_run", F.sum("_x").over(so_far)).withColumn("_in", F.max(F.col("_f").isNotNull()).over(so_far))
    caption = F.col("_f").isNotNull()
    chunks = rows.groupBy("pdf_id", "_c").agg(
        F.min_by("_f", F.when(caption, F.col("element_index"))).alias("_first"),
        F.max_by("_f", F.when(caption, F.col("element_index"))).alias("_last"),
        F.sum("_x").alias("_inner"),
    )
    up = Window.partitionBy("pdf_id").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("_prev", F.last("_last", ignorenulls=True).over(up))
    opens = F.col("_first").isNotNull() & (F.col("_prev").isNull() | (F.col("_prev") != F.col("_first")))
    chunks = chunks.withColumn("_opens", opens.cast("int")).withColumn("_before", F.coalesce(F.sum(F.col("_opens") + F.col("_inner")).over(up), F.lit(0)))
    out = rows.join(chunks.select("pdf_id", "_c", "_opens", "_before"), ["pdf_id", "_c"])
    group = F.col("_before") + F.when(F.col("_in"), F.col("_opens") + F.col("_run")).otherwise(0)
    return out.select("pdf_id", "element_index", "class", "figure_number", "text", "page_number", "element_id", group.cast("int").alias("group_id"))


def group_table_pages(grouped: DataFrame) -> DataFrame:
    """(pdf_id, group_id, table_page, first_index): a block's table pages, once, by first place."""
    tables = grouped.where((F.col("class") == "table") & (F.col("group_id") > 0) & F.col("page_number").isNotNull())
    return tables.groupBy("pdf_id", "group_id", F.col("page_number").alias("table_page")).agg(F.min("element_index").alias("first_index"))


def pairs(grouped: DataFrame) -> DataFrame:
    """One row per pair key: the last sheet of that key, at the place of its first.

    The key is the figure number, with the sheet's place in its block if that has several.
    """
    figs = grouped.where(F.col("class") == "figure")
    w = Window.partitionBy("pdf_id", "group_id")
    n, place = F.count("*").over(w), F.row_number().over(w.orderBy("element_index"))
    figs = figs.withColumn("_n", n).withColumn("_s", place)
    key = F.when(F.col("_n") == 1, F.col("figure_number").cast("string")).otherwise(F.concat_ws("_", "figure_number", "_s"))
    last = F.max(F.struct("element_index", "group_id", "page_number", "text")).alias("e")
    out = figs.withColumn("key", key).groupBy("pdf_id", "key").agg(last, F.min("element_index").alias("pair_ordinal"))
    return out.select("pdf_id", "key", "pair_ordinal", "e.group_id", F.col("e.page_number").alias("figure_page"), F.col("e.text").alias("figure_text"))


def pairing(grouped: DataFrame) -> DataFrame:
    """Pairs with their arrays: `figure_pages` (0 or 1), `figure_texts`, `table_pages` in order."""
    grouped = cut_lineage(grouped)
    pages = group_table_pages(grouped).groupBy("pdf_id", "group_id")
    ordered = F.array_sort(F.collect_list(F.struct("first_index", "table_page")))
    pages = pages.agg(F.transform(ordered, lambda p: p["table_page"]).alias("table_pages"))
    out = pairs(grouped).join(pages, ["pdf_id", "group_id"], "left")
    none = F.array().cast("array<int>")
    return out.select(
        "pdf_id",
        "key",
        "pair_ordinal",
        F.when(F.col("figure_page").isNotNull(), F.array("figure_page")).otherwise(none).alias("figure_pages"),
        F.array("figure_text").alias("figure_texts"),
        F.coalesce("table_pages", none).alias("table_pages"),
    )


def pair_tables(grouped: DataFrame) -> DataFrame:
    """(pdf_id, key, pair_ordinal, figure_page, first_index, table_page): pairs times their block's tables."""
    grouped = cut_lineage(grouped)
    return pairs(grouped).join(group_table_pages(grouped), ["pdf_id", "group_id"]).drop("group_id", "figure_text")


def pair_order(key: Column) -> Column:
    """Numeric sort value of a pair key: figure, then sheet."""
    parts = F.split(key, "_")
    return F.struct(F.get(parts, F.lit(0)).try_cast("int").alias("figure"), F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.lit(0)).alias("sheet"))


def pairing_entries(elements: DataFrame, mode: str = "lenient") -> DataFrame:
    """(pdf_id, section, place, item): the entries of a manual's figures, tables and pairing as JSON, in order of place.

    Every manual has an entry in each section, null where it has none, so a sink can stream documents.
    """
    c = cut_lineage(classify(elements, mode).where(F.col("class") != "other"))
    json = lambda x: F.to_json(x, {"ignoreNullFields": "false"})
    figure = json(F.struct("element_index", "figure_number", "sheet_index", "text", "page_number"))
    figs = sheets(c).select("pdf_id", F.lit("figures").alias("section"), F.col("element_index").alias("place"), figure.alias("item"))
    table = json(F.struct("element_index", "page_number", "element_id"))
    tabs = c.where(F.col("class") == "table").select("pdf_id", F.lit("tables").alias("section"), F.col("element_index").alias("place"), table.alias("item"))
    value = F.concat(F.lit('"'), F.col("key"), F.lit('":'), json(F.struct("figure_pages", "figure_texts", "table_pages")))
    prs = pairing(groups(c)).select("pdf_id", F.lit("pairing").alias("section"), F.col("pair_ordinal").alias("place"), value.alias("item"))
    sections = F.explode(F.array(*map(F.lit, ("figures", "tables", "pairing")))).alias("section")
    none = elements.select("pdf_id").distinct().select("pdf_id", sections, F.lit(-1).alias("place"), F.lit(None).cast("string").alias("item"))
    return figs.unionByName(tabs).unionByName(prs).unionByName(none)


def pairing_documents(elements: DataFrame, mode: str = "lenient") -> DataFrame:
    """(pdf_id, document): one JSON text a manual. For manuals that fit a row; `pairing_entries` is streamed to files instead."""
    rows = pairing_entries(elements, mode).where("item is not null").groupBy("pdf_id", "section").agg(F.array_sort(F.collect_list(F.struct("place", "item"))).alias("e"))
    joined = F.array_join(F.transform("e", lambda e: e["item"]), ",")
    parts = rows.groupBy("pdf_id").agg(*[F.max(F.when(F.col("section") == s, joined)).alias(s) for s in ("figures", "tables", "pairing")])
    text = F.concat(F.lit('{"figures":['), F.coalesce("figures", F.lit("")), F.lit('],"tables":['), F.coalesce("tables", F.lit("")), F.lit('],"pairing":{'), F.coalesce("pairing", F.lit("")), F.lit("}}"))
    return elements.select("pdf_id").distinct().join(parts, "pdf_id", "left").select("pdf_id", text.alias("document"))
