"""Queries of the general training-data problems (1, 2 and 5) and their SQL."""

from __future__ import annotations

from partsloom.operators import malformed, nested, packed
from partsloom.session import table


def _elements(spark, d):
    return table(spark, d, "images_tables_metadata")


def _lines(spark, d):
    return table(spark, d, "page_lines")


QUERIES = {
    "p1_found": lambda s, d: nested.element_rows(_elements(s, d)),
    "p1_elements": lambda s, d: nested.flat_tables(_elements(s, d)).elements,
    "p1_regions": lambda s, d: nested.flat_tables(_elements(s, d)).regions,
    "p1_lines": lambda s, d: nested.flat_tables(_elements(s, d)).lines,
    "p1_spans": lambda s, d: nested.flat_tables(_elements(s, d)).spans,
    "p1_refs": lambda s, d: nested.flat_tables(_elements(s, d)).refs,
    "p1_languages": lambda s, d: nested.flat_tables(_elements(s, d)).languages,
    "p1_points": lambda s, d: nested.flat_tables(_elements(s, d)).points,
    "p1_steps": lambda s, d: nested.flat_tables(_elements(s, d)).steps,
    "p1_linked_spans": lambda s, d: nested.flat_tables(_elements(s, d)).subtype("span_font_refs"),
    "p1_boxed_regions": lambda s, d: nested.flat_tables(_elements(s, d)).subtype("region_list_boxed"),
    "p1_variants": lambda s, d: nested.variant_counts(_elements(s, d)),
    "p2_found": lambda s, d: malformed.rejects(_lines(s, d)),
    "p2_loaded": lambda s, d: malformed.loaded_rows(_lines(s, d)),
    "p2_rates": lambda s, d: malformed.fault_rates(_lines(s, d)),
    "p5_found": lambda s, d: packed.explode_codes(table(s, d, "page_n")),
    "p5_all_codes": lambda s, d: packed.explode_codes(table(s, d, "page_n"), least=1),
}


def _tree(out: str) -> str:
    present = "coalesce(json_type({0}, '$.{1}'), 'NULL') <> 'NULL'"
    single = "coalesce(json_type({0}, '$.{1}'), 'NULL') NOT IN ('ARRAY', 'NULL')"
    items = "CASE json_type({0}) WHEN 'ARRAY' THEN CAST({0} AS JSON[]) WHEN 'NULL' THEN [] ELSE [{0}] END"
    return f"""
    WITH m AS (SELECT pdf_id, element_id, CAST(metadata AS JSON) AS j FROM images_tables_metadata WHERE json_valid(metadata)),
    l AS (SELECT pdf_id, element_id, j, coalesce(json_type(j, '$.coordinates'), 'NULL') <> 'NULL' AS placed, CASE json_type(j, '$.layout') WHEN 'VARCHAR' THEN
            CASE WHEN json_valid(json_extract_string(j, '$.layout')) THEN CAST(json_extract_string(j, '$.layout') AS JSON) END
            ELSE json_extract(j, '$.layout') END AS lay FROM m),
    f AS (SELECT pdf_id, element_id, j, lay, placed, CASE WHEN coalesce(json_type(j, '$.regions'), 'NULL') <> 'NULL' THEN json_extract(j, '$.regions')
            ELSE json_extract(lay, '$.regions') END AS rs FROM l),
    r0 AS (SELECT pdf_id, element_id, {items.format("rs")} AS a FROM f WHERE rs IS NOT NULL),
    r AS (SELECT pdf_id, element_id, i - 1 AS region_no, a[i] AS r FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM r0) WHERE json_type(a[i]) <> 'NULL'),
    l0 AS (SELECT pdf_id, element_id, region_no, json_extract(r, '$.lines') AS ls FROM r),
    l1 AS (SELECT pdf_id, element_id, region_no, {items.format("ls")} AS a FROM l0 WHERE ls IS NOT NULL),
    ln AS (SELECT pdf_id, element_id, region_no, i - 1 AS line_no, a[i] AS l FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM l1) WHERE json_type(a[i]) <> 'NULL'),
    s0 AS (SELECT pdf_id, element_id, region_no, line_no, json_extract(l, '$.spans') AS ss FROM ln),
    s1 AS (SELECT pdf_id, element_id, region_no, line_no, {items.format("ss")} AS a FROM s0 WHERE ss IS NOT NULL),
    sp AS (SELECT pdf_id, element_id, region_no, line_no, i - 1 AS span_no, a[i] AS s FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM s1) WHERE json_type(a[i]) <> 'NULL'),
    ss_ AS (SELECT *, {present.format("s", "font")} AS has_font, {present.format("s", "refs")} AS has_refs, CASE WHEN json_type(s) <> 'OBJECT' THEN 'span_text'
            WHEN {present.format("s", "font")} THEN CASE WHEN {present.format("s", "refs")} THEN 'span_font_refs' ELSE 'span_font' END
            WHEN {present.format("s", "refs")} THEN 'span_refs' ELSE 'span_plain' END AS state FROM sp),
    lk AS (SELECT pdf_id, element_id, region_no, line_no, count(*) AS n, bool_or(state = 'span_text') AS texts, bool_or(state IN ('span_refs', 'span_font_refs')) AS links
          FROM ss_ GROUP BY ALL),
    ls_ AS (SELECT ln.*, CASE WHEN n IS NULL THEN 'line_bare' WHEN {single.format("l", "spans")} THEN 'line_of_one' WHEN texts THEN 'line_mixed'
            WHEN links THEN 'line_linked' ELSE 'line_list' END AS base, base || CASE WHEN {present.format("l", "line_id")} THEN '_marked' ELSE '' END AS state
          FROM ln LEFT JOIN lk USING (pdf_id, element_id, region_no, line_no)),
    rk AS (SELECT pdf_id, element_id, region_no, count(*) AS n, bool_and(base = 'line_bare') AS blank, bool_or(base = 'line_mixed') AS mixed FROM ls_ GROUP BY ALL),
    rs_ AS (SELECT r.*, CASE WHEN n IS NULL THEN 'region_bare' WHEN {single.format("r", "lines")} THEN 'region_of_one' WHEN blank THEN 'region_blank'
            WHEN mixed THEN 'region_mixed' ELSE 'region_list' END AS base, base || CASE WHEN {present.format("r", "bbox")} THEN '_boxed' ELSE '' END AS state
          FROM r LEFT JOIN rk USING (pdf_id, element_id, region_no)),
    es_ AS (SELECT f.pdf_id, f.element_id, f.j, f.lay, CASE WHEN count(r.region_no) = 0 THEN 'element_bare' WHEN json_type(f.rs) NOT IN ('ARRAY', 'NULL') THEN 'element_of_one'
            ELSE 'element_list' END || CASE WHEN f.placed THEN '_placed' ELSE '' END AS state
          FROM f LEFT JOIN r USING (pdf_id, element_id) GROUP BY f.pdf_id, f.element_id, f.j, f.lay, f.rs, f.placed)
    {out}"""


def _list(source: str, at: str, field: str, number: str, values: str) -> str:
    """Entries of a list below a node, with their places."""
    a = f"json_extract({at}, '{field}')"
    keys = "pdf_id, element_id, region_no, line_no, span_no" if source == "sp" else "pdf_id, element_id"
    places = "pdf_id, element_id, CAST(region_no AS INTEGER) AS region_no, CAST(line_no AS INTEGER) AS line_no, CAST(span_no AS INTEGER) AS span_no" if source == "sp" else keys
    return f""", x0 AS (SELECT {keys}, CASE json_type({a}) WHEN 'ARRAY' THEN CAST({a} AS JSON[]) WHEN 'NULL' THEN [] ELSE [{a}] END AS a FROM {source} WHERE {a} IS NOT NULL),
    x AS (SELECT {keys}, i - 1 AS {number}, a[i] AS v FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM x0) WHERE json_type(a[i]) <> 'NULL')
    SELECT DISTINCT {places}, CAST({number} AS INTEGER) AS {number}, {values} FROM x"""


#: RE2 forms of the rules of problem 2.
_QUOTED = '"(?:[^"]|"")*"'
_FIELD = rf'(?:{_QUOTED}|[^"\t][^\t]*|)'
_BROKEN = rf'^(?:{_FIELD}\t)*"(?:[^"]|"")*(?:$|"[^"\t])'
_FAULTS = rf"""
    WITH q AS (SELECT *, coalesce(line, '') AS x, regexp_matches(coalesce(line, ''), '^(?s:{_FIELD}(?:\t{_FIELD})*)$') AS quoting_ok FROM page_lines),
    f AS (SELECT *, CASE WHEN quoting_ok THEN list_transform(regexp_extract_all(chr(9) || x, '(?s)\t({_FIELD})', 1),
            lambda v: CASE WHEN v LIKE '"%' THEN replace(v[2:-2], '""', '"') ELSE v END) END AS fs FROM q),
    why AS (SELECT *, CASE WHEN line IS NULL THEN 'columns' WHEN NOT quoting_ok THEN 'quoting' WHEN len(fs) <> 5 THEN 'columns'
        WHEN NOT (CASE WHEN trim(fs[1]) = '' THEN trim(fs[2]) <> '' ELSE regexp_full_match(trim(fs[1]), '[0-9]{{1,4}}[A-Z]?') END
                  AND regexp_full_match(trim(fs[5]), '(?:AR|[0-9]{{1,4}})?')) THEN 'value' END AS reason FROM f)
"""

_CODES = r"""
    WITH t AS (SELECT row_id, list_filter(list_transform(
          regexp_extract_all(uoc, '\b[Uu][Oo][Cc]:|"(?:[^"]|"")*"|''[^'']*''|“[^”]*”|‘[^’]*’|«[^»]*»|„[^“”]*[“”]|[A-Z0-9-]+'),
          lambda x: CASE WHEN regexp_full_match(x, '[Uu][Oo][Cc]:') THEN '' WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"')
               WHEN regexp_matches(x, '^[''“‘«„]') THEN x[2:-2] ELSE regexp_replace(x, '^-+|-+$', '', 'g') END), lambda x: x <> '') AS codes
      FROM page_n WHERE uoc IS NOT NULL)
    SELECT row_id, CAST(i AS INTEGER) AS pos, codes[i] AS code FROM (SELECT *, unnest(range(1, len(codes) + 1)) AS i FROM t WHERE len(codes) >= {least})
"""

_HEAD = "WITH m AS (SELECT pdf_id, element_id, CAST(metadata AS JSON) AS j FROM images_tables_metadata WHERE json_valid(metadata))"
_REGION = """pdf_id, element_id, CAST(region_no AS INTEGER) AS region_no, json_extract_string(r, '$.region_id') AS region_id, json_extract_string(r, '$.kind') AS kind,
    CAST(json_extract(r, '$.score') AS DOUBLE) AS score"""
_BOX = ", ".join(f"CAST(json_extract(r, '$.bbox.{k}') AS DOUBLE) AS bbox_{k}" for k in "xywh")
_SPAN = """pdf_id, element_id, CAST(region_no AS INTEGER) AS region_no, CAST(line_no AS INTEGER) AS line_no, CAST(span_no AS INTEGER) AS span_no,
    CASE json_type(s) WHEN 'OBJECT' THEN json_extract_string(s, '$.text') ELSE json_extract_string(s, '$') END AS text,
    CAST(json_extract(s, '$.conf') AS DOUBLE) AS conf, json_extract_string(s, '$.font.name') AS font_name, CAST(json_extract(s, '$.font.size') AS DOUBLE) AS font_size"""

ORACLE = {
    "p1_found": _tree(
        """SELECT DISTINCT pdf_id, element_id, CAST(region_no AS INTEGER) AS region_no, CAST(coalesce(line_no, -1) AS INTEGER) AS line_no,
             CAST(coalesce(span_no, -1) AS INTEGER) AS span_no
           FROM r LEFT JOIN ln USING (pdf_id, element_id, region_no) LEFT JOIN sp USING (pdf_id, element_id, region_no, line_no)"""
    ),
    "p1_elements": _tree(
        """SELECT DISTINCT pdf_id, element_id, state, CAST(trunc(TRY_CAST(json_extract_string(j, '$.page_number') AS DOUBLE)) AS INTEGER) AS page_number,
             json_extract_string(j, '$.parent_id') AS parent_id, json_extract_string(j, '$.filename') AS filename,
             json_extract_string(j, '$.coordinates.system.name') AS system_name, CAST(json_extract(j, '$.coordinates.system.width') AS DOUBLE) AS system_width,
             CAST(json_extract(j, '$.coordinates.system.height') AS DOUBLE) AS system_height, json_extract_string(j, '$.provenance.engine') AS engine,
             json_extract_string(lay, '$.version') AS layout_version FROM es_"""
    ),
    "p1_regions": _tree(f"SELECT DISTINCT {_REGION}, state, {_BOX} FROM rs_"),
    "p1_boxed_regions": _tree(f"SELECT DISTINCT {_REGION}, {_BOX} FROM rs_ WHERE state = 'region_list_boxed'"),
    "p1_lines": _tree(
        """SELECT DISTINCT pdf_id, element_id, CAST(region_no AS INTEGER) AS region_no, CAST(line_no AS INTEGER) AS line_no, state,
             json_extract_string(l, '$.line_id') AS line_id, CAST(json_extract(l, '$.baseline') AS DOUBLE) AS baseline FROM ls_"""
    ),
    "p1_spans": _tree(f"SELECT DISTINCT {_SPAN}, state FROM ss_"),
    "p1_linked_spans": _tree(f"SELECT DISTINCT {_SPAN} FROM ss_ WHERE state = 'span_font_refs'"),
    "p1_refs": _tree("") + _list("sp", "s", "$.refs", "ref_no", "CAST(json_extract(v, '$.fig') AS INTEGER) AS fig, CAST(json_extract(v, '$.item') AS INTEGER) AS item"),
    "p1_languages": _HEAD + _list("m", "j", "$.languages", "language_no", "json_extract_string(v, '$') AS language"),
    "p1_points": _HEAD + _list("m", "j", "$.coordinates.points", "point_no", "CAST(json_extract(v, '$[0]') AS DOUBLE) AS x, CAST(json_extract(v, '$[1]') AS DOUBLE) AS y"),
    "p1_steps": _HEAD + _list("m", "j", "$.provenance.steps", "step_no", "json_extract_string(v, '$.name') AS name, CAST(json_extract(v, '$.ms') AS DOUBLE) AS ms"),
    "p1_variants": _tree(
        """, every AS (SELECT DISTINCT 'elements' AS level, state, pdf_id, element_id, -1 AS a, -1 AS b, -1 AS c FROM es_
             UNION ALL SELECT DISTINCT 'regions', state, pdf_id, element_id, region_no, -1, -1 FROM rs_
             UNION ALL SELECT DISTINCT 'lines', state, pdf_id, element_id, region_no, line_no, -1 FROM ls_
             UNION ALL SELECT DISTINCT 'spans', state, pdf_id, element_id, region_no, line_no, span_no FROM ss_)
           SELECT level, state, count(*) AS n FROM every GROUP BY ALL"""
    ),
    "p2_found": _FAULTS + "SELECT line_id, reason FROM why WHERE reason IS NOT NULL",
    "p2_loaded": _FAULTS
    + """SELECT line_id, pdf_id, page_number, line_no, fs[1] AS item_no, fs[2] AS part_no, fs[3] AS description, fs[4] AS uoc, fs[5] AS quantity, source, received_at
         FROM why WHERE reason IS NULL""",
    "p2_rates": _FAULTS + "SELECT source, coalesce(reason, 'ok') AS reason, count(*) AS n FROM why GROUP BY ALL",
    "p5_found": _CODES.replace("{least}", "2"),
    "p5_all_codes": _CODES.replace("{least}", "1"),
}
