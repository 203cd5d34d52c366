import random
import re

from partsloom.functions.text import DESCRIPTION_COLUMN, ITEM_COLUMN
from partsloom.operators import tables as T

SCHEMA = "pdf_id string, page_number int, row_idx int, col_idx int, col_name string, value string"
NAMES = ["item_no", "ITEM NO.", "part_no", "description", "DESC.", "uoc", "quantity", "item_no_2", "descr"]


def model(names, rows):
    n = len(rows)
    kept = [c for c in range(len(names)) if sum(r[c] is None for r in rows) / n < 0.95]
    out = []
    for k, c in enumerate(kept):
        if k and sum(r[c] == r[kept[k - 1]] for r in rows) / n >= 0.90:
            continue
        out.append(c)
    text = [names[c] for c in out]
    ok = any(re.search(ITEM_COLUMN, x) for x in text) and any(re.search(DESCRIPTION_COLUMN, x) for x in text)
    return out, ok


def test_against_a_plain_model(spark):
    rng = random.Random(7)
    pages, cells = {}, []
    for page in range(120):
        names = rng.sample(NAMES, rng.randrange(2, 6))
        rows = []
        for _ in range(rng.choice([1, 10, 20])):
            row = [None if rng.random() < rng.choice([0.1, 0.95]) else rng.choice("ab") for _ in names]
            if rng.random() < 0.85 and page % 3 == 0:
                row[1] = row[0]
            rows.append(row)
        pages[page] = (names, rows)
        cells += [("d", page, i, c, names[c], v) for i, r in enumerate(rows) for c, v in enumerate(r)]
    rng.shuffle(cells)
    rows = T.rows_of_cells(spark.createDataFrame(cells, SCHEMA).repartition(4)).cache()
    got = {}
    for r in T.cleaned_columns(rows).collect():
        got.setdefault(r.page_number, set()).add(r.col_idx)
    valid = {r.page_number: r.n_rows for r in T.valid_pages(rows).collect()}
    for page, (names, data) in pages.items():
        cols, ok = model(names, data)
        assert got.get(page, set()) == set(cols)
        assert (page in valid) == ok
        assert not ok or valid[page] == len(data)
    assert T.cleaned_tables(rows).count() == sum(len(model(n, d)[0]) * len(d) for n, d in pages.values())


def test_bounds(spark):
    def page(values):
        return [("d", 1, i, c, n, v) for i, r in enumerate(values) for c, (n, v) in enumerate(zip(["item_no", "description"], r))]

    drop = page([(None, "x")] * 19 + [("1", "y")])
    keep = page([(None, "x")] * 18 + [("1", "y")] * 2)
    assert T.valid_pages(T.rows_of_cells(spark.createDataFrame(drop, SCHEMA))).count() == 0
    assert T.valid_pages(T.rows_of_cells(spark.createDataFrame(keep, SCHEMA))).count() == 1
    same = page([("a", "a")] * 9 + [("a", "b")])
    assert T.valid_pages(T.rows_of_cells(spark.createDataFrame(same, SCHEMA))).count() == 0
    assert T.valid_pages(T.rows_of_cells(spark.createDataFrame([], SCHEMA))).count() == 0


def test_rows_delivered_again(spark):
    schema = "row_id bigint, pdf_id string, page_number int, row_idx int, item_no string, part_no string, description string, uoc string, quantity string, extracted_at timestamp_ntz, names string"
    from datetime import datetime as t

    rows = [(2, "d", 1, 0, "1", "P", "D", "NaN", "2", t(2024, 1, 2), "c"), (1, "d", 1, 0, "9", "P", "D", "", "2", t(2024, 2, 2), "c")]
    got = T.table_rows(spark.createDataFrame(rows, schema)).collect()
    assert [r["values"] for r in got] == [["1", "P", "D", None, "2"]]
