import json
import random

from partsloom.operators import nested as N

SCHEMA = "pdf_id string, element_id string, metadata string, state string, r string"


def as_list(v):
    return [] if v is None else v if isinstance(v, list) else [v]


def brute(rows):
    out = set()
    for pdf, element, text, *_ in rows:
        try:
            m = json.loads(text, parse_constant=lambda c: 1 / 0)
        except (TypeError, ValueError, ZeroDivisionError):
            continue
        if not isinstance(m, dict):
            continue
        regions = m.get("regions")
        if regions is None:
            layout = m.get("layout")
            if isinstance(layout, str):
                try:
                    layout = json.loads(layout)
                except ValueError:
                    layout = None
            regions = layout.get("regions") if isinstance(layout, dict) else None
        for i, r in enumerate(as_list(regions)):
            if r is None:
                continue
            lines = [(j, x) for j, x in enumerate(as_list(r.get("lines") if isinstance(r, dict) else None)) if x is not None]
            if not lines:
                out.add((pdf, element, i, -1, -1))
            for j, line in lines:
                spans = [k for k, s in enumerate(as_list(line.get("spans") if isinstance(line, dict) else None)) if s is not None]
                out |= {(pdf, element, i, j, k) for k in spans or [-1]}
    return out


def random_meta(rng):
    def some(make):
        n = rng.randrange(4)
        items = [make() if rng.random() < 0.85 else None for _ in range(n)]
        return rng.choice([items, items, items, make(), None, []])

    span = lambda: rng.choice(["bare", {"text": "x", "conf": 0.5}, {"text": "y", "font": {"name": "F", "size": 9}}, {"text": "z", "refs": [{"fig": 1}]}])
    line = lambda: {"baseline": 3} | ({"spans": some(span)} if rng.random() < 0.8 else {})
    region = lambda: {"kind": "text"} | ({"lines": some(line)} if rng.random() < 0.8 else {})
    top = {"page_number": 1}
    where = rng.randrange(4)
    if where == 0:
        top["regions"] = some(region)
    elif where == 1:
        top["layout"] = {"regions": some(region)}
    elif where == 2:
        top["layout"] = json.dumps({"regions": some(region)})
    text = json.dumps(top, indent=rng.choice([None, 1]))
    return rng.choice([text] * 8 + [text[:-3], text + " x", None])


def test_rows_match_a_plain_walk(spark):
    rng = random.Random(1)
    rows = [(f"d{i % 3}", f"e{i}", random_meta(rng), "s", "x") for i in range(250)]
    rows += rows[:40]  # delivered again
    got = N.element_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert set(map(tuple, got)) == brute(rows)


def test_json_must_be_one_value(spark):
    texts = ['{"a":1}', ' {"a":1}\n', '{"a":1} x', '{"a":1}],[2', '{"a":1}]},{"b":[2', '{"a":1}],"' + N._BEHIND + '":0}', '{"' + N._BEHIND + '":1}', '{"' + N._BEHIND + '":1} x', '{"a":1}}', "", "{'a':1}", "NaN", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ok = {r[0] for r in df.where(N.valid_json(N.F.col("t")).isNotNull()).select("i").collect()}
    assert {texts[i] for i in ok} == {texts[0], texts[1], '{"' + N._BEHIND + '":1}'}


def test_states_and_subtypes(spark):
    meta = {"regions": [{"kind": "k", "lines": [{"spans": ["a", {"text": "b"}]}, {"spans": {"text": "c", "font": {"name": "N", "size": 7}}}, None, {}]}, {"lines": None}]}
    df = spark.createDataFrame([("d", "e", json.dumps(meta), "clash", "clash"), (None, None, json.dumps(meta), None, None)], SCHEMA)
    t = N.flat_tables(df)
    assert {(r.region_no, r.state) for r in t.regions.where("pdf_id = 'd'").collect()} == {(0, "region_mixed"), (1, "region_bare")}
    assert {(r.line_no, r.state) for r in t.lines.where("pdf_id = 'd'").collect()} == {(0, "line_mixed"), (1, "line_of_one"), (3, "line_bare")}
    font = t.subtype("span_font").where("pdf_id = 'd'").collect()
    assert [(r.line_no, r.span_no, r.text, r.font_name, r.font_size) for r in font] == [(1, 0, "c", "N", 7.0)]
    assert t.elements.count() == 2  # null keys are a manual of their own


def test_rows_come_from_the_subtype_tables(spark, monkeypatch):
    """The leaves' subtype tables hold the rows; another automaton gives other rows."""
    rng = random.Random(2)
    df = spark.createDataFrame([(f"d{i % 3}", f"e{i}", random_meta(rng), "s", "x") for i in range(120)], SCHEMA)
    t = N.flat_tables(df, stage=True)
    got = set()
    for level in ("span", "line", "region"):
        for state in N.states(level, leaf=True):
            names = t.subtype(state).columns
            got |= {(r.pdf_id, r.element_id, *[r[c] if c in names else -1 for c in ("region_no", "line_no", "span_no")]) for r in t.subtype(state).collect()}
    before = {tuple(r) for r in N.element_rows(df).collect()}
    assert got == before
    monkeypatch.setattr(N, "TRANSITIONS", tuple(x for x in N.TRANSITIONS if x.state != "line_bare"))
    after = {tuple(r) for r in N.element_rows(df).collect()}
    assert after < before and before - after == {r for r in before if r[3] >= 0 and r[4] < 0}


def test_lists_and_optional_fields(spark):
    meta = {
        "languages": ["eng", None, "deu"],
        "coordinates": {"points": [[1, 2], [3.5, 4]], "system": {"name": "P", "width": 10}},
        "provenance": {"engine": "fast", "steps": {"name": "ocr", "ms": 5}},
        "layout": json.dumps({"version": "2", "regions": [{"bbox": {"x": 1}, "lines": [{"line_id": "L", "spans": [{"text": "a", "refs": [{"fig": 1, "item": 2}, None, {"fig": 3}]}]}]}]}),
    }
    t = N.flat_tables(spark.createDataFrame([("d", "e", json.dumps(meta), None, None)] * 2, SCHEMA))
    rows = lambda df: sorted(tuple(r)[2:] for r in df.collect())
    assert rows(t.languages) == [(0, "eng"), (2, "deu")]
    assert rows(t.points) == [(0, 1.0, 2.0), (1, 3.5, 4.0)]
    assert rows(t.steps) == [(0, "ocr", 5.0)]
    assert rows(t.refs) == [(0, 0, 0, 0, 1, 2), (0, 0, 0, 2, 3, None)]
    e = t.elements.first()
    assert (e.state, e.system_name, e.engine, e.layout_version) == ("element_list_placed", "P", "fast", "2")
    assert t.subtype("region_list_boxed").first().bbox_x == 1.0 and "bbox_x" not in t.subtype("region_list").columns
    assert t.subtype("line_linked_marked").first().line_id == "L"


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert N.element_rows(df).count() == 0
    assert N.variant_counts(df).count() == 0
