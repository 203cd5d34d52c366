import random
from bisect import bisect
from collections import Counter
from itertools import groupby

from partsloom.operators import pairing as P
from partsloom.operators.elements import classify, elements_of

SCHEMA = "pdf_id string, element_index int, type string, element_id string, page_number int, text string"


def document(rng, n):
    out = []
    for i in range(n):
        kind = rng.choice("CCTTTNX")
        page = None if rng.random() < 0.1 else rng.randrange(1, 8)
        text = f"Figure {rng.randrange(1, 4)}. A" if kind in "CX" else None if kind == "N" else "t"
        out.append((i, "Table" if kind in "TX" else "Text", f"e{i}", page, text))
    return out


def model(rows):
    """(pairs in order, sheet numbers), by cutting the list of captions into runs of one number."""
    captions = [(i, int(text[7]), page, text) for i, _, _, page, text in rows if text and text.startswith("Figure")]
    runs = [list(g) for _, g in groupby(captions, key=lambda c: c[1])]
    starts = [run[0][0] for run in runs]
    tables = [{} for _ in runs]
    for i, kind, _, page, text in rows:
        at = bisect(starts, i) - 1
        if kind == "Table" and text in (None, "t") and page is not None and at >= 0:
            tables[at].setdefault(page)
    pairs = {
        f"{num}_{s}" if len(run) > 1 else str(num): ([page] if page is not None else [], [text], list(pages))
        for run, pages in zip(runs, tables)
        for s, (_, num, page, text) in enumerate(run, 1)
    }
    seen = Counter()
    numbers = []
    for i, num, *_ in captions:
        seen[num] += 1
        numbers.append((i, num, seen[num]))
    return pairs, numbers


def test_against_runs_of_captions(spark):
    rng = random.Random(11)
    docs = {f"d{k}": document(rng, rng.randrange(0, 40)) for k in range(60)}
    rows = [(d, *e) for d, es in docs.items() for e in es]
    rng.shuffle(rows)
    c = classify(spark.createDataFrame(rows, SCHEMA).repartition(5)).cache()
    for chunk in (3, 20_000):
        got, sheets = {}, {}
        for r in P.pairing(P.groups(c, chunk)).orderBy("pdf_id", "pair_ordinal").collect():
            got.setdefault(r.pdf_id, {})[r.key] = (r.figure_pages, r.figure_texts, r.table_pages)
        for r in P.sheets(c, chunk).orderBy("element_index").collect():
            sheets.setdefault(r.pdf_id, []).append((r.element_index, r.figure_number, r.sheet_index))
        for d, es in docs.items():
            want, numbers = model(es)
            assert got.get(d, {}) == want
            assert list(got.get(d, {})) == list(want)
            assert sheets.get(d, []) == numbers


def test_documents_and_empty(spark):
    import json

    rows = [("d", 0, "Text", "a", 2, "Figure 1. x"), ("d", 1, "Table", "b", 3, None), ("e", 0, "Text", "c", None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    docs = {r.pdf_id: json.loads(r.document) for r in P.pairing_documents(df).collect()}
    assert docs["d"]["pairing"] == {"1": {"figure_pages": [2], "figure_texts": ["Figure 1. x"], "table_pages": [3]}}
    assert docs["e"] == {"figures": [], "tables": [], "pairing": {}}
    empty = classify(df.limit(0))
    assert P.pairing(P.groups(empty)).count() == 0


def test_elements_delivered_again(spark):
    from datetime import datetime as t

    schema = "pdf_id string, element_index int, type string, element_id string, text string, metadata string, loaded_at timestamp_ntz"
    rows = [("d", 0, "Table", "a", "x", '{"page_number": 4}', t(2024, 1, 2)), ("d", 0, "Table", "a", "x", '{"page_number":4}', t(2024, 1, 3)), ("d", None, "Table", "q", "x", None, None), ("d", 1, None, None, None, "{bad", None)]
    got = sorted(tuple(r) for r in elements_of(spark.createDataFrame(rows, schema)).collect())
    assert got == [("d", 0, "Table", "a", 4, "x"), ("d", 1, None, None, None, None)]


def test_pair_order(spark):
    keys = spark.createDataFrame([("10",), ("2_2",), ("2_1",), ("1",)], "k string")
    assert [r.k for r in keys.orderBy(P.pair_order(keys.k)).collect()] == ["1", "2_1", "2_2", "10"]
