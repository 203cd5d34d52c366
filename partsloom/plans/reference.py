"""Queries of figure-table pairing, sanitising, validation and manifests, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsloom.config import Config
from partsloom.functions import text as X
from partsloom.operators import elements as E
from partsloom.operators import extract as EX
from partsloom.operators import manifest as M
from partsloom.operators import pages as PG
from partsloom.operators import pairing as P
from partsloom.operators import stats as S
from partsloom.operators import tables as T
from partsloom.schemas import COLUMNS, NA_SPELLINGS
from partsloom.session import cut_lineage, stage_folder, table
from partsloom.sources import readers, sinks
from partsloom.streaming.pages import arrivals_run

# -- inputs


def _elements(s: SparkSession, d: str) -> DataFrame:
    return E.elements_of(table(s, d, "images_tables_metadata"))


def _classified(s, d, mode="lenient") -> DataFrame:
    return E.classify(_elements(s, d), mode)


def _grouped(s, d) -> DataFrame:
    return P.groups(_classified(s, d))


def _raw(s, d) -> DataFrame:
    """Raw page text: the lines of a page in order, fenced on every fourth page."""
    line = F.struct("line_no", "line_id", "line")
    pages = table(s, d, "page_lines").groupBy("pdf_id", "page_number").agg(F.array_sort(F.collect_list(line)).alias("l"))
    body = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    fenced = F.concat(F.lit("```tsv\n"), body, F.lit("\n```"))
    return pages.select("pdf_id", "page_number", F.when(F.col("page_number") % 4 == 0, fenced).otherwise(body).alias("raw"))


_WIDE = """
    WITH b AS (SELECT concat('data-', CAST(l_orderkey % 10 AS STRING)) AS pdf_id, CAST(1 + floor(l_orderkey / 10) % 260 AS INT) AS page_number,
       l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, p_name, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY pdf_id, page_number ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INT) AS row_idx FROM b),
    w AS (SELECT pdf_id, page_number, row_idx, CAST(l_linenumber AS STRING) AS item_no, p_brand AS part_no,
       CASE WHEN page_number % 9 = 0 THEN NULL WHEN page_number % 11 = 0 THEN p_brand ELSE p_name END AS description,
       CASE WHEN l_partkey % 40 = 0 THEN concat('U', CAST(l_suppkey % 5 AS STRING)) ELSE NULL END AS uoc,
       CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity FROM r)
"""
_CELLS = (
    _WIDE
    + """, cells AS (SELECT pdf_id, page_number, row_idx, 0 AS col_idx, 'item_no' AS col_name, item_no AS value FROM w
      UNION ALL SELECT pdf_id, page_number, row_idx, 1, 'part_no', part_no FROM w
      UNION ALL SELECT pdf_id, page_number, row_idx, 2, CASE WHEN page_number % 7 = 0 THEN 'nomenclature' ELSE 'description' END, description FROM w
      UNION ALL SELECT pdf_id, page_number, row_idx, 3, 'uoc', uoc FROM w
      UNION ALL SELECT pdf_id, page_number, row_idx, 4, 'quantity', quantity FROM w)
"""
)
#: Columns of the tables in these queries.
_WIDTH = 5


def _cell_rows(s, d) -> DataFrame:
    for name in ("lineitem", "part"):
        table(s, d, name).createOrReplaceTempView(name)
    third = "CASE WHEN page_number % 7 = 0 THEN 'nomenclature' ELSE 'description' END"
    return s.sql(
        _WIDE
        + f"""SELECT pdf_id, page_number, row_idx, array('item_no', 'part_no', {third}, 'uoc', 'quantity') AS names,
             array(item_no, part_no, description, uoc, quantity) AS values FROM w"""
    )


def _part_rows(s, d) -> DataFrame:
    return T.table_rows(table(s, d, "page_n"))


def _manifest_rows(s, d) -> DataFrame:
    return M.manifest_rows(P.pair_tables(_grouped(s, d)), T.valid_pages(_part_rows(s, d), width=_WIDTH))


def _local(s, d) -> DataFrame:
    return M.within_threshold(_manifest_rows(s, d))


def _extracted(s, d) -> DataFrame:
    """Pages that have their table: those of the manifest."""
    pages = table(s, d, "dataset_manifest_global").select("pdf_id", X.page_of_name(F.col("tsv_path")).alias("page_number"))
    return pages.where("page_number is not null").distinct()


def _present(s, d) -> DataFrame:
    tabs = _extracted(s, d).select("pdf_id", F.lit("table").alias("kind"), "page_number")
    figs = table(s, d, "figures").select("pdf_id", F.lit("figure").alias("kind"), "page_number")
    return tabs.unionByName(figs).distinct()


def _work(s, d) -> DataFrame:
    need = PG.required_pages(_classified(s, d)).where("kind = 'table'")
    return need.select("pdf_id", "page_number", F.format_string("%s/table_data/page_%d.tsv", "pdf_id", "page_number").alias("out_path"))


def _existing(s, d) -> DataFrame:
    return _extracted(s, d).select(F.format_string("%s/table_data/page_%d.tsv", "pdf_id", "page_number").alias("out_path"))


def _run(s, d) -> DataFrame:
    """An extraction run over the raw page text as images; pages with a manifest row are done already."""
    images = _raw(s, d).select("pdf_id", "page_number", F.encode("raw", "UTF-8").alias("png"))
    return EX.extraction_run(images, Config(delay_seconds=0.0, calls=8), f"{stage_folder(s)}/{uuid.uuid4().hex}", _extracted(s, d))


# -- a result tree, written and read back


def _tree(s) -> str:
    return f"{stage_folder(s)}/tree-{uuid.uuid4().hex}"


def element_files(s, d):
    root = _tree(s)
    sinks.write_elements(_elements(s, d), root)
    return readers.read_elements(s, f"{root}/*/images_tables_metadata.json")


def pairing_files(s, d):
    root = _tree(s)
    sinks.write_pairing(P.pairing_entries(_elements(s, d)), root)
    join = lambda c: F.array_join(c, ",").alias(c)
    return readers.read_pairing(s, f"{root}/*/figures_tables_pages.json").select("pdf_id", "key", "pair_ordinal", join("figure_pages"), join("figure_texts"), join("table_pages"))


def page_files(s, d):
    """Sanitised pages written as files and read back as table rows."""
    root = _tree(s)
    sinks.write_page_tables(_raw(s, d).select("pdf_id", "page_number", X.sanitize(F.col("raw")).alias("tsv")), root)
    return readers.wide_tables(readers.read_tables(s, f"{root}/*/table_data"))


def image_files(s, d):
    root = _tree(s)
    png = F.encode("raw", "UTF-8").alias("png")
    sinks.write_images(_raw(s, d).select("pdf_id", F.lit("table").alias("kind"), "page_number", png), root)
    images = readers.page_images(s, f"{root}/*/tables")
    return images.select("pdf_id", "kind", "page_number", F.decode("png", "UTF-8").alias("body"))


def existing_files(s, d):
    root = _tree(s)
    sinks.write_page_tables(_raw(s, d).select("pdf_id", "page_number", X.sanitize(F.col("raw")).alias("tsv")), root)
    return readers.existing_outputs(s, f"{root}/*/table_data").select("pdf_id", "page_number")


def manifest_files(s, d):
    """Local manifests written a manual, read at once and merged."""
    root = _tree(s)
    sinks.write_local_manifests(_local(s, d), root)
    found, _ = readers.manifests(s, root)
    return M.global_manifest(found).drop("line")


def _global(s, d) -> DataFrame:
    rows = cut_lineage(_local(s, d).drop("pair_ordinal", "first_index"))
    return M.global_manifest([rows.where("pdf_id <> 'data-1'"), rows.where("pdf_id = 'data-1'").drop("table_path")])


# -- queries


def classify_elements(s, d):
    return _classified(s, d).select("pdf_id", "element_index", "class", "figure_number", "page_number")


def caption_strict_vs_lenient(s, d):
    e = _elements(s, d).withColumn("text", X.clean_text(F.col("text")))
    count = lambda mode: F.count(X.caption_number(F.col("text"), mode)).alias(f"n_{mode}")
    return e.groupBy("pdf_id").agg(count("strict"), count("lenient"), F.count("*").alias("n_elements"))


def figure_table_pairing(s, d):
    join = lambda c: F.array_join(c, ",").alias(c)
    return P.pairing(_grouped(s, d)).select("pdf_id", "key", "pair_ordinal", join("figure_pages"), join("figure_texts"), join("table_pages"))


def group_table_pages(s, d):
    pages = P.group_table_pages(_grouped(s, d)).groupBy("pdf_id", "group_id")
    ordered = F.array_sort(F.collect_list(F.struct("first_index", "table_page")))
    return pages.agg(F.array_join(F.transform(ordered, lambda p: p["table_page"]), ",").alias("table_pages"))


def header_synonyms(s, d):
    words = table(s, d, "page_lines").select(F.explode(F.split("line", "\t")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).withColumn("column_name", X.canonical_header(F.col("word"))).where("column_name is not null")


def extract_stub(s, d):
    images = _raw(s, d).select("pdf_id", "page_number", F.encode("raw", "UTF-8").alias("png"))
    return EX.sanitized(EX.extract(images, Config(delay_seconds=0.0))).select("pdf_id", "page_number", "status", "tsv")


def pairing_documents(s, d):
    return P.pairing_documents(_elements(s, d))


def pair_order(s, d):
    pairs = P.pairs(_grouped(s, d))
    return pairs.select("pdf_id", "key", P.pair_order(F.col("key")).alias("o")).select("pdf_id", "key", "o.*")


def output_paths(s, d):
    """Where the table of each page image goes, in the three layouts."""
    png = F.concat(F.lit("/results/"), X.relativize(F.col("table_path"), F.col("pdf_id"))).alias("png")
    images = table(s, d, "dataset_manifest_global").select(png).where("png is not null").distinct()
    return images.select("png", *[X.output_path(F.col("png"), layout, "/out").alias(layout) for layout in ("beside", "apart", "flat")])


def wrapped_lines(s, d):
    line = F.struct("line_no", "line_id", "line")
    pages = table(s, d, "page_lines").where("line is not null").groupBy("pdf_id", "page_number").agg(F.array_sort(F.collect_list(line)).alias("l"))
    return pages.select("pdf_id", "page_number", X.join_wrapped(F.transform("l", lambda x: x["line"])).alias("joined"))


def cell_uocs(s, d):
    cell = F.concat(F.coalesce("description", F.lit("")), F.lit("\nUOC: "), F.coalesce("uoc", F.lit("")), F.lit("\nuoc:"), F.coalesce("item_no", F.lit("")))
    return table(s, d, "page_n").select("row_id", X.uoc_of_cell(cell).alias("uoc"))


def line_arrivals(s, d):
    path = f"{d}/page_lines.parquet"
    # A pattern, so that a table may be one file or a folder of files.
    lines = s.readStream.schema(s.read.parquet(path).schema).parquet(path.replace(".parquet", ".parque[t]"))
    root = _tree(s)
    return arrivals_run(lines.select("received_at", "source"), f"{root}/counts", f"{root}/mark")


def _mapped(col):
    """A query that maps the raw text of every page."""
    return lambda s, d: _raw(s, d).select("pdf_id", "page_number", col(F.col("raw")).alias("out"))


QUERIES = {
    "classify_elements": classify_elements,
    "caption_strict_vs_lenient": caption_strict_vs_lenient,
    "element_summary": lambda s, d: S.element_summary(_classified(s, d)),
    "figure_sheet_index": lambda s, d: P.sheets(_classified(s, d)),
    "figure_groups": lambda s, d: _grouped(s, d).select("pdf_id", "element_index", "class", "figure_number", "group_id"),
    "group_table_pages": group_table_pages,
    "figure_table_pairing": figure_table_pairing,
    "pairing_documents": pairing_documents,
    "pair_order": pair_order,
    "pages_to_render": lambda s, d: PG.required_pages(_classified(s, d)),
    "missing_pages": lambda s, d: PG.missing_pages(PG.required_pages(_classified(s, d)), _present(s, d)),
    "sanitize_fences": _mapped(X.strip_fences),
    "sanitize_numeric_o": _mapped(X.fix_numeric_o),
    "sanitize_rows": _mapped(X.sanitize),
    "sanitize_uoc": lambda s, d: table(s, d, "page_n").select("row_id", X.clean_uoc(F.col("uoc")).alias("uoc")),
    "null_spellings": lambda s, d: table(s, d, "page_n").select("row_id", X.null_if_na(F.col("quantity")).alias("quantity")),
    "dot_leader_clean": lambda s, d: table(s, d, "page_n").select("row_id", X.strip_bullets(X.strip_dot_leaders(F.col("description"))).alias("description")),
    "part_number_filter": lambda s, d: table(s, d, "page_n").select("row_id", X.part_number(F.col("part_no")).alias("part_no")),
    "header_synonyms": header_synonyms,
    "column_null_ratio": lambda s, d: T.null_ratios(_cell_rows(s, d), width=_WIDTH),
    "column_adjacent_dup": lambda s, d: T.same_ratios(_cell_rows(s, d), width=_WIDTH),
    "cleaned_columns": lambda s, d: T.cleaned_columns(_cell_rows(s, d), width=_WIDTH),
    "cleaned_tables": lambda s, d: T.cleaned_tables(_cell_rows(s, d), width=_WIDTH),
    "valid_pages": lambda s, d: T.valid_pages(_cell_rows(s, d), width=_WIDTH),
    "valid_part_pages": lambda s, d: T.valid_pages(_part_rows(s, d), width=_WIDTH),
    "local_manifest": _manifest_rows,
    "manifest_threshold": _local,
    "relativize_paths": lambda s, d: M.relative_paths(table(s, d, "dataset_manifest_global")),
    "global_manifest": _global,
    "work_pending": lambda s, d: EX.pending(_work(s, d), _existing(s, d)),
    "run_summary": lambda s, d: S.run_summary(_run(s, d)),
    "extraction_run": lambda s, d: _run(s, d).select("pdf_id", "page_number", "status", "attempts", "tsv"),
    "rate_limit_errors": lambda s, d: table(s, d, "documents").select("doc_id", EX.rate_limited_column(F.col("text")).alias("limited")),
    "manuals_in_order": lambda s, d: S.manuals_in_order(table(s, d, "page_n"), "row_id"),
    "page_numbers": lambda s, d: table(s, d, "dataset_manifest_global").select("tsv_path", X.page_of_name(F.col("tsv_path")).alias("page_number")).distinct(),
    "output_paths": output_paths,
    "sub_components": lambda s, d: table(s, d, "page_lines").select("line_id", X.is_sub_component(F.regexp_extract("line", "[0-9]\\) ?[0-9].*$", 0)).alias("sub")),
    "wrapped_lines": wrapped_lines,
    "cell_uocs": cell_uocs,
    "quantity_values": lambda s, d: table(s, d, "page_n").select("row_id", EX.quantity_value(F.col("quantity")).alias("quantity")),
    "element_files": element_files,
    "pairing_files": pairing_files,
    "page_files": page_files,
    "image_files": image_files,
    "existing_files": existing_files,
    "manifest_files": manifest_files,
    "corpus_summary": lambda s, d: S.corpus_summary(M.relative_paths(table(s, d, "dataset_manifest_global"))),
    "extract_stub": extract_stub,
    "image_base64": _mapped(lambda raw: X.base64_text(F.encode(raw, "UTF-8"))),
    "line_arrivals": line_arrivals,
}

# -- SQL

_W = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_STRIP = rf"'^{_W}+|{_W}+$', '', 'g'"
_E = rf"""
    WITH d AS (SELECT *, row_number() OVER (PARTITION BY pdf_id, element_index ORDER BY loaded_at NULLS FIRST, element_id NULLS FIRST) AS rn
      FROM images_tables_metadata WHERE element_index IS NOT NULL),
    e AS (SELECT pdf_id, element_index, type, element_id, regexp_replace(coalesce(text, ''), {_STRIP}) AS text,
        CASE WHEN json_valid(metadata) THEN TRY_CAST(json_extract_string(metadata, '$.page_number') AS INTEGER) END AS page_number FROM d WHERE rn = 1),
    n AS (SELECT *, TRY_CAST(regexp_extract(text, '(?i)^(?:Figure|FIG\.?){_W}*(\d+){_W}*(?:\.|{_W})', 1) AS INTEGER) AS figure_number,
        TRY_CAST(regexp_extract(text, '(?i)^Figure{_W}+(\d+){_W}*(?:\.|{_W})', 1) AS INTEGER) AS strict_number FROM e),
    c AS (SELECT *, CASE WHEN figure_number IS NOT NULL THEN 'figure' WHEN type = 'Table' THEN 'table' ELSE 'other' END AS class FROM n)
"""
_G = (
    _E
    + """, ct AS (SELECT *, last_value(f IGNORE NULLS) OVER (PARTITION BY pdf_id ORDER BY element_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p
      FROM (SELECT *, CASE WHEN class = 'figure' THEN figure_number END AS f FROM c WHERE class <> 'other')),
    g AS (SELECT *, CAST(sum(CASE WHEN f IS NOT NULL AND p IS DISTINCT FROM f THEN 1 ELSE 0 END) OVER (PARTITION BY pdf_id ORDER BY element_index) AS INTEGER) AS group_id FROM ct),
    tp AS (SELECT pdf_id, group_id, page_number AS table_page, min(element_index) AS first_index FROM g
      WHERE class = 'table' AND group_id > 0 AND page_number IS NOT NULL GROUP BY ALL),
    sh AS (SELECT *, count(*) OVER (PARTITION BY pdf_id, group_id) AS n, row_number() OVER (PARTITION BY pdf_id, group_id ORDER BY element_index) AS s FROM g WHERE class = 'figure'),
    k AS (SELECT *, CASE WHEN n = 1 THEN CAST(figure_number AS VARCHAR) ELSE figure_number || '_' || s END AS key FROM sh),
    pr AS (SELECT pdf_id, key, min(element_index) AS pair_ordinal, max_by(group_id, element_index) AS group_id,
        arg_max_null(page_number, element_index) AS figure_page, max_by(text, element_index) AS figure_text FROM k GROUP BY pdf_id, key)
"""
)
_P = """
    t0 AS (SELECT *, row_number() OVER (PARTITION BY pdf_id, page_number, row_idx ORDER BY extracted_at NULLS FIRST, row_id) AS rn FROM page_n),
    cells AS (SELECT pdf_id, page_number, row_idx, col_idx, col_name, CASE WHEN value NOT IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan',
        '1.#IND', '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN value END AS value FROM (
      SELECT pdf_id, page_number, row_idx, 0 AS col_idx, 'item_no' AS col_name, item_no AS value FROM t0 WHERE rn = 1
      UNION ALL SELECT pdf_id, page_number, row_idx, 1, 'part_no', part_no FROM t0 WHERE rn = 1
      UNION ALL SELECT pdf_id, page_number, row_idx, 2, 'description', description FROM t0 WHERE rn = 1
      UNION ALL SELECT pdf_id, page_number, row_idx, 3, 'uoc', uoc FROM t0 WHERE rn = 1
      UNION ALL SELECT pdf_id, page_number, row_idx, 4, 'quantity', quantity FROM t0 WHERE rn = 1))
"""
_V = r"""
    , nr AS (SELECT pdf_id, page_number, col_idx, col_name, avg(CASE WHEN value IS NULL THEN 1.0::DOUBLE ELSE 0.0 END) AS null_ratio FROM cells GROUP BY ALL),
    kept AS (SELECT c.* FROM cells c JOIN nr USING (pdf_id, page_number, col_idx, col_name) WHERE null_ratio < 0.95),
    lg AS (SELECT *, lag(value) OVER w AS prev, lag(col_idx) OVER w AS pc FROM kept WINDOW w AS (PARTITION BY pdf_id, page_number, row_idx ORDER BY col_idx)),
    sr AS (SELECT pdf_id, page_number, col_idx, col_name, avg(CASE WHEN pc IS NULL THEN NULL WHEN value IS NOT DISTINCT FROM prev THEN 1.0::DOUBLE ELSE 0.0 END) AS same_ratio FROM lg GROUP BY ALL),
    cc AS (SELECT pdf_id, page_number, col_idx, col_name FROM sr WHERE same_ratio IS NULL OR same_ratio < 0.9),
    nm AS (SELECT pdf_id, page_number FROM cc GROUP BY ALL HAVING bool_or(regexp_matches(col_name, '(?i)\bitem[\s_]*no\.?\b|\bitem[\s_]*num'))
        AND bool_or(regexp_matches(col_name, '(?i)\bdescription\b|\bdesc\.?\b'))),
    vp AS (SELECT pdf_id, page_number, count(DISTINCT row_idx) AS n_rows FROM cells JOIN nm USING (pdf_id, page_number) GROUP BY ALL)
"""
_M = (
    _G
    + ", "
    + _P
    + _V
    + """, mf AS (SELECT pdf_id, pair_ordinal, first_index, 'figures/page_' || figure_page || '.png' AS figure_path, 'tables/page_' || table_page || '.png' AS table_path,
        'table_data/page_' || table_page || '.tsv' AS tsv_path, key AS figure
      FROM pr JOIN tp USING (pdf_id, group_id) WHERE figure_page IS NOT NULL AND EXISTS (SELECT 1 FROM vp WHERE vp.pdf_id = pr.pdf_id AND vp.page_number = tp.table_page)),
    lm AS (SELECT * EXCLUDE (cnt) FROM (SELECT *, count(tsv_path) OVER (PARTITION BY pdf_id, figure_path) AS cnt FROM mf) WHERE cnt <= 5)
"""
)
_R = """
    WITH l AS (SELECT pdf_id, page_number, string_agg(line, chr(10) ORDER BY line_no NULLS FIRST, line_id) AS body FROM page_lines GROUP BY ALL),
    r AS (SELECT pdf_id, page_number, CASE WHEN page_number % 4 = 0 THEN '```tsv' || chr(10) || coalesce(body, '') || chr(10) || '```' ELSE coalesce(body, '') END AS raw FROM l)
"""
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def _lines(x: str) -> str:
    parts = f"regexp_split_to_array({x}, '{_BREAK}')"
    return f"CASE WHEN {parts}[-1] = '' THEN {parts}[:-2] ELSE {parts} END"


_S = (
    _R
    + rf""", s1 AS (SELECT pdf_id, page_number, {_lines(f"regexp_replace(raw, {_STRIP})")} AS ls FROM r),
    s2 AS (SELECT pdf_id, page_number, CASE WHEN ls[1] LIKE '```%' THEN ls[2:] ELSE ls END AS ls FROM s1),
    s3 AS (SELECT pdf_id, page_number, CASE WHEN ls[-1] LIKE '```%' THEN ls[:-2] ELSE ls END AS ls FROM s2),
    s4 AS (SELECT pdf_id, page_number, coalesce(array_to_string(ls, chr(10)), '') AS fenceless FROM s3),
    o AS (SELECT pdf_id, page_number, regexp_replace(regexp_replace(fenceless, '([0-9.])O([0-9.])', '\10\2', 'g'), '([0-9.])O([0-9.])', '\10\2', 'g') AS x FROM s4),
    t AS (SELECT pdf_id, page_number, list_filter({_lines(f"regexp_replace(x, {_STRIP})")}, lambda l: contains(l, chr(9))) AS ls FROM o),
    h AS (SELECT *, 'item_no' || chr(9) || 'part_no' || chr(9) || 'description' || chr(9) || 'uoc' || chr(9) || 'quantity' AS header FROM t),
    b AS (SELECT *, CASE WHEN regexp_replace(ls[1], {_STRIP}) = header THEN ls[1] ELSE header END AS first,
        CASE WHEN regexp_replace(ls[1], {_STRIP}) = header THEN ls[2:] ELSE ls END AS body FROM h),
    f AS (SELECT pdf_id, page_number, first, list_transform(list_filter(list_transform(body, lambda l: string_split(l, chr(9))),
          lambda c: regexp_replace(c[1], {_STRIP}) <> '' OR regexp_replace(c[2], {_STRIP}) <> ''),
          lambda c: array_to_string(CASE WHEN len(c) > 3 THEN list_concat(c[1:3], [regexp_replace(regexp_replace(c[4], {_STRIP}), '(?i)^UOC:{_W}*', '')], c[5:]) ELSE c END, chr(9))) AS rows FROM b)
"""
)
_DONE = r"""done AS (SELECT DISTINCT pdf_id, TRY_CAST(regexp_extract(tsv_path, '(?:^|/)page_(.+)\.tsv$', 1) AS INTEGER) AS page_number FROM dataset_manifest_global
        WHERE TRY_CAST(regexp_extract(tsv_path, '(?:^|/)page_(.+)\.tsv$', 1) AS INTEGER) IS NOT NULL)"""
_WORK = (
    _E
    + f""", {_DONE},
    rq AS (SELECT DISTINCT pdf_id, class AS kind, page_number FROM c WHERE class <> 'other' AND page_number IS NOT NULL),
    ps AS (SELECT pdf_id, 'table' AS kind, page_number FROM done UNION SELECT pdf_id, 'figure', page_number FROM figures),
    wk AS (SELECT pdf_id, page_number, pdf_id || '/table_data/page_' || page_number || '.tsv' AS out_path FROM rq WHERE kind = 'table'),
    ex AS (SELECT DISTINCT pdf_id || '/table_data/page_' || page_number || '.tsv' AS out_path FROM done)
"""
)


def _relative(column: str) -> str:
    p = f"replace({column}, chr(92), '/')"
    at = f"strpos({p}, '/' || pdf_id || '/')"
    return f"CASE WHEN {at} > 0 THEN substr({p}, {at} + 1) WHEN starts_with({p}, pdf_id || '/') THEN {p} ELSE pdf_id || '/' || {p} END AS {column}"


_REL = ", ".join(map(_relative, ("figure_path", "table_path", "tsv_path")))
_RUN = (
    _S
    + f""", {_DONE},
    st AS (SELECT r.pdf_id, r.page_number, CASE WHEN done.pdf_id IS NOT NULL THEN 'skipped' WHEN raw = '' THEN 'failed' ELSE 'succeeded' END AS status,
        CASE WHEN done.pdf_id IS NULL AND raw <> '' THEN array_to_string(list_concat([first], rows), chr(10)) END AS tsv
      FROM r LEFT JOIN f USING (pdf_id, page_number) LEFT JOIN done USING (pdf_id, page_number))
"""
)
_SYNONYMS = ", ".join(f"('{w}', '{c}')" for c, words in X.HEADER_SYNONYMS.items() for w in words)

ORACLE = {
    "classify_elements": _E + "SELECT pdf_id, element_index, class, figure_number, page_number FROM c",
    "caption_strict_vs_lenient": _E + "SELECT pdf_id, count(strict_number) AS n_strict, count(figure_number) AS n_lenient, count(*) AS n_elements FROM c GROUP BY pdf_id",
    "element_summary": _E + "SELECT pdf_id, count(*) FILTER (class = 'figure') AS n_figures, count(*) FILTER (class = 'table') AS n_tables, count(*) AS n_elements FROM c GROUP BY pdf_id",
    "figure_sheet_index": _E
    + """SELECT pdf_id, figure_number, CAST(row_number() OVER (PARTITION BY pdf_id, figure_number ORDER BY element_index) AS INTEGER) AS sheet_index,
         text, page_number, element_index FROM c WHERE class = 'figure'""",
    "figure_groups": _G.replace("arg_max_null", "max_by") + "SELECT pdf_id, element_index, class, figure_number, group_id FROM g",
    "group_table_pages": _G + "SELECT pdf_id, group_id, string_agg(table_page, ',' ORDER BY first_index) AS table_pages FROM tp GROUP BY ALL",
    "figure_table_pairing": _G
    + """, ta AS (SELECT pdf_id, group_id, string_agg(table_page, ',' ORDER BY first_index) AS table_pages FROM tp GROUP BY ALL)
         SELECT pdf_id, key, pair_ordinal, coalesce(CAST(figure_page AS VARCHAR), '') AS figure_pages, figure_text AS figure_texts, coalesce(table_pages, '') AS table_pages
         FROM pr LEFT JOIN ta USING (pdf_id, group_id)""",
    "pages_to_render": _WORK + "SELECT * FROM rq",
    "missing_pages": _WORK + "SELECT * FROM rq WHERE NOT EXISTS (SELECT 1 FROM ps WHERE ps.pdf_id = rq.pdf_id AND ps.kind = rq.kind AND ps.page_number = rq.page_number)",
    "sanitize_fences": _S + "SELECT pdf_id, page_number, fenceless AS out FROM s4",
    "sanitize_numeric_o": _R
    + r"""SELECT pdf_id, page_number, regexp_replace(regexp_replace(raw, '([0-9.])O([0-9.])', '\10\2', 'g'), '([0-9.])O([0-9.])', '\10\2', 'g') AS out FROM r""",
    "sanitize_rows": _S + "SELECT pdf_id, page_number, array_to_string(list_concat([first], rows), chr(10)) AS out FROM f",
    "sanitize_uoc": rf"SELECT row_id, regexp_replace(regexp_replace(uoc, {_STRIP}), '(?i)^UOC:{_W}*', '') AS uoc FROM page_n",
    "null_spellings": """SELECT row_id, CASE WHEN quantity NOT IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>', 'N/A',
        'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN quantity END AS quantity FROM page_n""",
    "dot_leader_clean": r"""SELECT row_id, regexp_replace(trim(regexp_replace(regexp_replace(description, '\.{3,}', ' ', 'g'), '[\s\x0b]+', ' ', 'g')), '^[.•\s]+', '') AS description FROM page_n""",
    "part_number_filter": r"""SELECT row_id, CASE WHEN NOT (regexp_matches(part_no, '^[A-Z]{5}$') OR regexp_matches(part_no, '^\d{4}-?\d{2}-?\d{3}-?\d{4}$')
        OR (regexp_matches(part_no, '^[0-9A-Z]{5}$') AND regexp_matches(part_no, '\d'))) THEN part_no END AS part_no FROM page_n""",
    "header_synonyms": rf"""WITH w AS (SELECT unnest(string_split(line, chr(9))) AS word FROM page_lines),
        n AS (SELECT word, count(*) AS n, regexp_replace(regexp_replace(upper(trim(word)), '[_\s\x0b]+', ' ', 'g'), '\.$', '') AS k FROM w GROUP BY word)
        SELECT word, n, column_name FROM n JOIN (VALUES {_SYNONYMS}) v(k, column_name) USING (k)""",
    "column_null_ratio": _CELLS + _V + "SELECT * FROM nr",
    "column_adjacent_dup": _CELLS + _V + "SELECT * FROM sr",
    "cleaned_columns": _CELLS + _V + "SELECT * FROM cc",
    "cleaned_tables": _CELLS + _V + "SELECT c.* FROM cells c JOIN cc USING (pdf_id, page_number, col_idx, col_name)",
    "valid_pages": _CELLS + _V + "SELECT * FROM vp",
    "valid_part_pages": "WITH " + _P + _V + "SELECT * FROM vp",
    "local_manifest": _M + "SELECT * FROM mf",
    "manifest_threshold": _M + "SELECT * FROM lm",
    "relativize_paths": f"SELECT pdf_id, figure, {_REL} FROM dataset_manifest_global",
    "global_manifest": _M + f", u AS (SELECT pdf_id, figure_path, CASE WHEN pdf_id <> 'data-1' THEN table_path END AS table_path, tsv_path, figure FROM lm) SELECT pdf_id, figure, {_REL} FROM u",
    "work_pending": _WORK + "SELECT * FROM wk WHERE out_path NOT IN (SELECT out_path FROM ex)",
    "run_summary": _RUN
    + """SELECT pdf_id, count(*) FILTER (status = 'succeeded') AS succeeded, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'failed') AS failed
         FROM st GROUP BY ROLLUP (pdf_id)""",
    "extraction_run": _RUN + "SELECT pdf_id, page_number, status, CAST(CASE WHEN status = 'skipped' THEN 0 ELSE 1 END AS INTEGER) AS attempts, tsv FROM st",
    "rate_limit_errors": "SELECT doc_id, contains(lower(text), 'rate') OR contains(text, '429') AS limited FROM documents",
    "manuals_in_order": "SELECT pdf_id, min(row_id) AS place FROM page_n GROUP BY pdf_id",
    "page_numbers": r"""SELECT DISTINCT tsv_path, TRY_CAST(CASE WHEN regexp_matches(tsv_path, '(?:^|/)page_(.+)\.tsv$') THEN regexp_extract(tsv_path, '(?:^|/)page_(.+)\.tsv$', 1) END AS INTEGER)
        AS page_number FROM dataset_manifest_global""",
    "output_paths": f"""WITH m AS (SELECT DISTINCT '/results/' || table_path AS png FROM (SELECT pdf_id, {_relative("table_path")} FROM dataset_manifest_global) WHERE table_path IS NOT NULL),
        p AS (SELECT png, regexp_extract(png, '([^/]+)\\.[Pp][Nn][Gg]$', 1) || '.tsv' AS f, regexp_extract(png, '([^/]+)/[^/]+/[^/]+$', 1) AS folder,
          regexp_extract(png, '^(.*)/[^/]+/[^/]+$', 1) AS root FROM m)
        SELECT png, root || '/table_data/' || f AS beside, '/out/' || folder || '/' || f AS apart, '/out/' || f AS flat FROM p""",
    "pair_order": _G
    + """SELECT pdf_id, key, TRY_CAST(string_split(key, '_')[1] AS INTEGER) AS figure, coalesce(TRY_CAST(string_split(key, '_')[2] AS INTEGER), 0) AS sheet FROM pr""",
    "pairing_documents": _G
    + """, fg AS (SELECT pdf_id, string_agg(to_json({'element_index': element_index, 'figure_number': figure_number, 'sheet_index': CAST(si AS INTEGER), 'text': text, 'page_number': page_number}), ','
           ORDER BY element_index) AS figures FROM (SELECT *, row_number() OVER (PARTITION BY pdf_id, figure_number ORDER BY element_index) AS si FROM c WHERE class = 'figure') GROUP BY pdf_id),
         tb AS (SELECT pdf_id, string_agg(to_json({'element_index': element_index, 'page_number': page_number, 'element_id': element_id}), ',' ORDER BY element_index) AS tables
           FROM c WHERE class = 'table' GROUP BY pdf_id),
         ta AS (SELECT pdf_id, group_id, list(table_page ORDER BY first_index) AS table_pages FROM tp GROUP BY ALL),
         pg AS (SELECT pdf_id, string_agg('"' || key || '":' || to_json({'figure_pages': CASE WHEN figure_page IS NULL THEN [] ELSE [figure_page] END, 'figure_texts': [figure_text],
           'table_pages': coalesce(table_pages, [])}), ',' ORDER BY pair_ordinal) AS pairing FROM pr LEFT JOIN ta USING (pdf_id, group_id) GROUP BY pdf_id)
         SELECT DISTINCT pdf_id, '{"figures":[' || coalesce(figures, '') || '],"tables":[' || coalesce(tables, '') || '],"pairing":{' || coalesce(pairing, '') || '}}' AS document
         FROM c LEFT JOIN fg USING (pdf_id) LEFT JOIN tb USING (pdf_id) LEFT JOIN pg USING (pdf_id)""",
    "sub_components": r"""SELECT line_id, regexp_matches(regexp_extract(line, '[0-9]\) ?[0-9].*$', 0), '{SUB}') AS sub FROM page_lines""".replace("{SUB}", X.SUB_COMPONENT),
    "wrapped_lines": rf"""SELECT pdf_id, page_number, coalesce(string_agg(trim(line), ' ' ORDER BY line_no NULLS FIRST, line_id) FILTER (NOT regexp_matches(line, '(?i)^[\s\x0b]*UOC:')
        AND NOT regexp_matches(line, '{X.SUB_COMPONENT}')), '') AS joined FROM page_lines WHERE line IS NOT NULL GROUP BY ALL""",
    "cell_uocs": r"""SELECT row_id, array_to_string(list_transform(regexp_extract_all(coalesce(description, '') || chr(10) || 'UOC: ' || coalesce(uoc, '') || chr(10) || 'uoc:' || coalesce(item_no, ''),
        '(?im)^UOC:[ \t]*(.*)$', 1), lambda x: trim(x)), ' ') AS uoc FROM page_n""",
    "quantity_values": r"""SELECT row_id, CASE WHEN regexp_full_match(trim(quantity), '[0-9]{1,9}') THEN CAST(trim(quantity) AS INTEGER) END AS quantity FROM page_n""",
    "element_files": _E
    + """SELECT pdf_id, CAST(row_number() OVER (PARTITION BY pdf_id ORDER BY element_index) - 1 AS INTEGER) AS element_index, type, element_id, page_number,
           (SELECT d.text FROM d WHERE d.rn = 1 AND d.pdf_id = e.pdf_id AND d.element_index = e.element_index) AS text FROM e""",
    "pairing_files": _G
    + """, ta AS (SELECT pdf_id, group_id, string_agg(table_page, ',' ORDER BY first_index) AS table_pages FROM tp GROUP BY ALL)
         SELECT pdf_id, key, CAST(row_number() OVER (PARTITION BY pdf_id ORDER BY pair_ordinal) - 1 AS INTEGER) AS pair_ordinal, coalesce(CAST(figure_page AS VARCHAR), '') AS figure_pages,
           figure_text AS figure_texts, coalesce(table_pages, '') AS table_pages FROM pr LEFT JOIN ta USING (pdf_id, group_id)""",
    "page_files": _S
    + """, wf AS (SELECT pdf_id, page_number, string_split(first, chr(9)) AS names, list_transform(rows, lambda x: string_split(x, chr(9))) AS rs FROM f),
         ro AS (SELECT pdf_id, page_number, names, i - 1 AS row_idx, rs[i] AS v FROM (SELECT *, unnest(range(1, len(rs) + 1)) AS i FROM wf WHERE len(list_filter(rs, lambda x: len(x) > len(names))) = 0))
         SELECT pdf_id, page_number, CAST(row_idx AS INTEGER) AS row_idx, """
    + ", ".join(f"CASE WHEN v[{i}] NOT IN ({', '.join(repr(x) for x in NA_SPELLINGS)}) THEN v[{i}] END AS {c}" for i, c in enumerate(COLUMNS, 1))
    + " FROM ro",
    "image_files": _R + "SELECT pdf_id, 'table' AS kind, page_number, raw AS body FROM r",
    "existing_files": _R + "SELECT pdf_id, page_number FROM r",
    "manifest_files": _M + f"SELECT pdf_id, figure, {_REL} FROM lm",
    "corpus_summary": f"""WITH m AS (SELECT pdf_id, figure, {_REL} FROM dataset_manifest_global)
        SELECT pdf_id, count(*) AS n_rows, count(DISTINCT figure) AS n_figures, count(DISTINCT figure_path) AS n_figure_paths FROM m GROUP BY pdf_id""",
    "extract_stub": _S + "SELECT pdf_id, page_number, 'succeeded' AS status, array_to_string(list_concat([first], rows), chr(10)) AS tsv FROM f",
    "image_base64": _R + "SELECT pdf_id, page_number, base64(encode(raw)) AS out FROM r",
    "line_arrivals": "SELECT date_trunc('hour', received_at) AS hour, source, count(*) AS n FROM page_lines GROUP BY ALL",
}
