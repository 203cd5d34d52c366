"""Text rules as column expressions: all of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from partsloom.schemas import HEADER, NA_SPELLINGS

# Patterns of captions, columns and repairs.
CAPTIONS = {
    "lenient": r"(?iU)^(?:Figure|FIG\.?)\s*(\d+)\s*[.\s]",
    "strict": r"(?iU)^Figure\s+(\d+)\s*[.\s]",
}
ITEM_COLUMN = r"(?i)\bitem[\s_]*no\.?\b|\bitem[\s_]*num"
DESCRIPTION_COLUMN = r"(?i)\bdescription\b|\bdesc\.?\b"
NUMERIC_O = r"(?<=[0-9.])O(?=[0-9.])"
UOC_PREFIX = r"(?iU)^UOC:\s*"
STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
FENCE = "```"
SUB_COMPONENT = r"^\s*\d+\)\s*\d+-\d+"

#: Header words by canonical column.
HEADER_SYNONYMS = {
    "item_no": ("ITEM NO", "ITEM NUMBER", "ITEM", "(B)"),
    "part_no": ("PART NUMBER", "PART NO", "P/N", "NSN", "STOCK NO", "SMR"),
    "description": ("DESCRIPTION", "NOMENCLATURE", "DESC"),
    "uoc": ("UOC", "USABLE ON CODE"),
    "quantity": ("QTY", "Q", "QUANTITY"),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, however often `body` uses it."""
    return F.transform(F.array(value), body)[0]


def strip(text: Column) -> Column:
    """Unicode-aware trim; null stays null."""
    return F.regexp_replace(text, STRIP, "")


def clean_text(text: Column) -> Column:
    """Trimmed text, null as empty."""
    return strip(F.coalesce(text, F.lit("")))


def split_lines(text: Column) -> Column:
    """Lines without their breaks; a final break opens no line, an empty text has none."""
    cut = lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, 1, F.size(x) - 1)).otherwise(x)
    return let(F.split(text, LINE_BREAK, -1), cut)


def caption_number(text: Column, mode: str = "lenient") -> Column:
    """Figure number of a caption text, null where it is none. Non-ASCII digits give null."""
    digits = F.regexp_extract(text, CAPTIONS[mode], 1)
    return F.when(digits != "", digits.try_cast("int"))


def null_if_na(value: Column) -> Column:
    return F.when(~value.isin(*NA_SPELLINGS), value)


def strip_fences(raw: Column) -> Column:
    """Without one code-fence line at the start and one at the end."""
    less = lambda x: F.greatest(F.size(x) - 1, F.lit(0))
    head = lambda x: F.when(F.get(x, F.lit(0)).startswith(FENCE), F.slice(x, F.lit(2), less(x))).otherwise(x)
    tail = lambda x: F.when(F.try_element_at(x, F.lit(-1)).startswith(FENCE), F.slice(x, F.lit(1), less(x))).otherwise(x)
    return F.array_join(let(let(split_lines(strip(raw)), head), tail), "\n")


def fix_numeric_o(text: Column) -> Column:
    """Letter O between digits or dots becomes zero."""
    return F.regexp_replace(text, NUMERIC_O, "0")


def clean_uoc(field: Column) -> Column:
    return F.regexp_replace(strip(field), UOC_PREFIX, "")


def enforce_rows(text: Column) -> Column:
    """Lines with tabs below exactly one header line; rows without item and part number dropped."""

    def row(fields: Column) -> Column:
        return F.array_join(F.transform(fields, lambda f, i: F.when(i == 3, clean_uoc(f)).otherwise(f)), "\t")

    def keyed(fields: Column) -> Column:
        return (strip(F.get(fields, F.lit(0))) != "") | (strip(F.get(fields, F.lit(1))) != "")

    def table(lines: Column) -> Column:
        headed = F.when(strip(F.get(lines, F.lit(0))) == HEADER, lines).otherwise(F.concat(F.array(F.lit(HEADER)), lines))
        return F.when(F.size(lines) == 0, F.lit(HEADER)).otherwise(let(headed, body))

    def body(lines: Column) -> Column:
        fields = F.transform(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.split(x, "\t", -1))
        rows = F.transform(F.filter(fields, keyed), row)
        return F.array_join(F.concat(F.slice(lines, 1, 1), rows), "\n")

    return let(F.filter(split_lines(strip(text)), lambda x: x.contains("\t")), table)


def sanitize(raw: Column) -> Column:
    """Model output to clean tab-separated text."""
    return enforce_rows(fix_numeric_o(strip_fences(raw)))


def relativize(path: Column, pdf_id: Column) -> Column:
    """Path below the results folder, with forward slashes, beginning with the manual."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    mark = F.concat(F.lit("/"), pdf_id, F.lit("/"))
    found = F.call_function("locate", mark, p)
    prefix = F.concat(pdf_id, F.lit("/"))
    return F.when(found > 0, F.call_function("substring", p, found + 1)).when(p.startswith(prefix), p).otherwise(F.concat(prefix, p))


def page_of_name(name: Column, suffix: str = "tsv") -> Column:
    """Page number of `page_<int>.<suffix>`; other names give null."""
    return F.regexp_extract(name, rf"(?:^|/)page_(.+)\.{suffix}$", 1).try_cast("int")


def output_path(png: Column, layout: str, base: str = "", subdir: str = "table_data") -> Column:
    """Where the table of a page image goes. Layouts: `beside` <set>/<subdir>, `apart` <base>/<set>, `flat` <base>."""
    stem = F.regexp_extract(png, r"([^/]+)\.[Pp][Nn][Gg]$", 1)
    folder = F.regexp_extract(png, r"([^/]+)/[^/]+/[^/]+$", 1)
    root = F.regexp_extract(png, r"^(.*)/[^/]+/[^/]+$", 1)
    out = {"beside": F.concat(root, F.lit(f"/{subdir}/")), "apart": F.concat(F.lit(f"{base}/"), folder, F.lit("/")), "flat": F.lit(f"{base}/")}[layout]
    return F.concat(out, stem, F.lit(".tsv"))


def strip_dot_leaders(text: Column) -> Column:
    """Runs of three dots or more become one blank; blanks collapse."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\.{3,}", " "), r"\s+", " "))


def strip_bullets(text: Column) -> Column:
    return F.regexp_replace(text, r"^[.•\s]+", "")


def canonical_header(name: Column) -> Column:
    """Canonical column of a header cell, null for an unknown one."""
    key = F.regexp_replace(F.regexp_replace(F.upper(F.trim(name)), r"[_\s]+", " "), r"\.$", "")
    table = F.create_map(*[F.lit(x) for c, words in HEADER_SYNONYMS.items() for w in words for x in (w, c)])
    return F.try_element_at(table, key)


def part_number(value: Column) -> Column:
    """The value unless it is a source code, a 13-digit stock number or a 5-character maker code."""
    code = value.rlike(r"^[A-Z]{5}$") | value.rlike(r"^\d{4}-?\d{2}-?\d{3}-?\d{4}$") | value.rlike(r"^(?=.*\d)[0-9A-Z]{5}$")
    return F.when(~code, value)


def is_sub_component(line: Column) -> Column:
    return line.rlike(SUB_COMPONENT)


def uoc_of_cell(cell: Column) -> Column:
    """Codes of the `UOC:` lines of a description cell, joined by blanks."""
    return F.array_join(F.transform(F.regexp_extract_all(cell, F.lit(r"(?im)^UOC:[ \t]*(.*)$"), 1), lambda x: F.trim(x)), " ")


def join_wrapped(lines: Column) -> Column:
    """Description lines joined by a blank, without `UOC:` lines and sub-components."""
    kept = F.filter(lines, lambda x: ~x.rlike(r"(?i)^\s*UOC:") & ~is_sub_component(x))
    return F.array_join(F.transform(kept, lambda x: F.trim(x)), " ")


def base64_text(content: Column) -> Column:
    return F.regexp_replace(F.base64(content), "[\r\n]", "")
