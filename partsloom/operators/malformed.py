"""Problem 2: split raw lines into rows and rejects with a reason.

A block of lines goes through a columnar path: one vectorised test of the whole block sets
lines aside that can't have five fields, an Arrow CSV read parses the others in bulk, and
vectorised tests of the values set aside those whose values can't be. A block whose read
fails (a line break inside a line, say) is halved until the parts pass or one line is left. Only
lines set aside and such single lines go to the strict parser, which names the reason
or finds the line good after all: it sees the bad lines and hardly any other. It is a narrow
map: no shuffle, any number of bad lines, any skew of sources.

Reasons, tested in this order
    quoting  a field that starts with `"` isn't closed, or its close isn't followed by a tab or the end
    columns  not five fields; so is a null line
    value    item_no or quantity can't be one (see `good_values`); surrounding blanks are ignored

Other columns pass through untouched; input columns named like a new one are replaced. A null
line id stays null.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FIELDS = ("item_no", "part_no", "description", "uoc", "quantity")

#: What an item number and a quantity look like.
ITEM = r"[0-9]{1,4}[A-Z]?"
QUANTITY = r"(?:AR|[0-9]{1,4})?"

_ITEM = re.compile(ITEM)
_QUANTITY = re.compile(QUANTITY)
_FIELD = r'(?:"(?:[^"]|"")*"|[^"\t][^\t]*|)'
#: A line of exactly five fields whose quoted ones close before a tab or the end.
_FIVE = rf"(?s)^{_FIELD}(?:\t{_FIELD}){{4}}$"

#: Lines and bytes of a block.
BLOCK, BLOCK_BYTES = 4096, 4_000_000


def strict_fields(line: str) -> list[str] | None:
    """The fields of one line, or None where its quoting is broken."""
    out, at, n = [], 0, len(line)
    while True:
        if at < n and line[at] == '"':
            parts, at = [], at + 1
            while True:
                close = line.find('"', at)
                if close < 0:
                    return None
                parts.append(line[at:close])
                if line.startswith('""', close):
                    parts.append('"')
                    at = close + 2
                    continue
                at = close + 1
                break
            if at < n and line[at] != "\t":
                return None
            out.append("".join(parts))
        else:
            tab = line.find("\t", at)
            end = n if tab < 0 else tab
            out.append(line[at:end])
            at = end
        if at >= n:
            return out
        at += 1  # past the tab


def good_values(fields: list[str]) -> bool:
    item, part, quantity = fields[0].strip(), fields[1].strip(), fields[4].strip()
    item_ok = bool(part) if not item else _ITEM.fullmatch(item) is not None
    return item_ok and _QUANTITY.fullmatch(quantity) is not None


def diagnose(line: str | None) -> tuple[str | None, list[str] | None]:
    """(reason, fields) of one line by the strict rules; fields only where it is good."""
    fields = strict_fields(line) if line is not None else []
    if fields is None:
        return "quoting", None
    if len(fields) != 5:
        return "columns", None
    return (None, fields) if good_values(fields) else ("value", None)


def bulk_fields(lines):
    """The five columns of an Arrow array of lines that should hold five fields each, or None if the read fails.

    An unquoted line break leaves a piece with fewer fields, so it always fails the read.
    """
    import pyarrow as pa
    from pyarrow import csv

    # A first line of five fields keeps the reader's column count and row count fixed.
    text = "a\tb\tc\td\te\n" + "\n".join(lines.to_pylist()) + "\n"
    try:
        got = csv.read_csv(
            pa.BufferReader(text.encode()),
            read_options=csv.ReadOptions(use_threads=False, block_size=len(text) * 4 + 64),
            parse_options=csv.ParseOptions(delimiter="\t", quote_char='"', double_quote=True, newlines_in_values=True, ignore_empty_lines=False),
            convert_options=csv.ConvertOptions(column_types=dict.fromkeys("abcde", pa.string()), strings_can_be_null=False, quoted_strings_can_be_null=False),
        )
    except pa.ArrowInvalid:
        return None
    if got.num_rows != len(lines):
        return None
    return [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in got.columns]


def well_valued(columns):
    """Which rows of five columns have an item number and a quantity that can be one."""
    import pyarrow.compute as pc

    item, part, quantity = (pc.utf8_trim_whitespace(columns[i]) for i in (0, 1, 4))
    item_ok = pc.if_else(pc.equal(item, ""), pc.not_equal(part, ""), pc.match_substring_regex(item, f"^(?:{ITEM})$"))
    return pc.and_(item_ok, pc.match_substring_regex(quantity, f"^(?:{QUANTITY})$"))


def split_block(lines):
    """(reasons, five columns, lines the strict parser saw) of an Arrow array of lines."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    count = len(lines)
    fits = pc.fill_null(pc.match_substring_regex(lines, _FIVE), False)
    places = pc.indices_nonzero(fits)
    strict = [pc.indices_nonzero(pc.invert(fits)).to_numpy()]
    good, parsed = [], []
    stack = [places] if len(places) else []
    while stack:
        at = stack.pop()
        part = lines.take(at)
        columns = bulk_fields(part) if len(at) == 1 or part.nbytes <= BLOCK_BYTES else None
        if columns is not None:
            ok = well_valued(columns)
            good.append(at.filter(ok).to_numpy())
            parsed.append([c.filter(ok) for c in columns])
            strict.append(at.filter(pc.invert(ok)).to_numpy())
        elif len(at) > 1:
            half = len(at) // 2
            stack += [at.slice(half), at.slice(0, half)]
        else:
            strict.append(at.to_numpy())
    doubtful = np.sort(np.concatenate(strict)).astype(np.int64)
    found = [diagnose(x) for x in lines.take(pa.array(doubtful)).to_pylist()]
    # Where each line's row stands: behind the rows parsed in bulk come those of the strict parser.
    order = np.concatenate([*good, doubtful]).astype(np.int64)
    place = np.empty(count, dtype=np.int64)
    place[order] = np.arange(count)
    reasons = pa.array([None] * (count - len(found)) + [r for r, _ in found], pa.string()).take(pa.array(place))
    columns = []
    for i in range(5):
        rest = pa.array([f[i] if f else None for _, f in found], pa.string())
        columns.append(pa.concat_arrays([*[p[i] for p in parsed], rest]).take(pa.array(place)))
    return reasons, columns, len(found)


def split_lines_by_fault(df: DataFrame, line: str = "line", block: int = BLOCK) -> DataFrame:
    """`df` with `reason` (null for a good line) and the five fields (null for a bad one)."""
    keep = [c for c in df.columns if c not in {"reason", *FIELDS}]
    source = df.select(*keep)
    schema = StructType(source.schema.fields[:])
    for c in ("reason", *FIELDS):
        schema = schema.add(c, "string")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            lines = batch.column(keep.index(line)).cast(pa.string())
            parts = [split_block(lines.slice(start, block)) for start in range(0, len(lines), block)]
            new = [pa.concat_arrays([p[0] for p in parts] or [pa.array([], pa.string())])]
            new += [pa.concat_arrays([p[1][i] for p in parts] or [pa.array([], pa.string())]) for i in range(5)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*keep, "reason", *FIELDS])

    return source.mapInArrow(run, schema)


def rejects(df: DataFrame) -> DataFrame:
    return split_lines_by_fault(df.select("line_id", "line")).where(F.col("reason").isNotNull()).select("line_id", "reason")


def loaded_rows(df: DataFrame) -> DataFrame:
    """The good lines as parts rows."""
    good = split_lines_by_fault(df).where(F.col("reason").isNull())
    return good.select("line_id", "pdf_id", "page_number", "line_no", *FIELDS, "source", "received_at")


def fault_rates(df: DataFrame) -> DataFrame:
    """Lines by source and reason (`ok` for good ones)."""
    out = split_lines_by_fault(df.select("source", "line"))
    return out.groupBy("source", F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))
