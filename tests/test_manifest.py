import pytest

from partsloom.operators import manifest as M
from partsloom.operators import pages as PG
from partsloom.operators import stats as S

PAIRS = "pdf_id string, key string, pair_ordinal int, figure_page int, first_index int, table_page int"


def test_shared_page_shares_the_budget(spark):
    rows = [("d", f"34_{k}", k, 9, i, 10 * k + i) for k in (1, 2) for i in range(3)] + [("d", "35", 5, 11, 1, 10), ("d", "36", 6, None, 1, 10)]
    pairs = spark.createDataFrame(rows, PAIRS)
    valid = spark.createDataFrame([("d", p, 1) for p in range(60)], "pdf_id string, page_number int, n_rows long")
    every = M.manifest_rows(pairs, valid)
    assert every.count() == 7  # no figure page, no row
    assert [r.figure for r in M.within_threshold(every).collect()] == ["35"]
    assert M.local_manifest(pairs, valid.where("page_number < 12")).count() == 3
    assert M.manifest_rows(pairs, valid.limit(0)).count() == 0


def test_merge(spark):
    a = spark.createDataFrame([("/x/d/figures/p.png", None, "t.tsv", "1", "d")], "figure_path string, table_path string, tsv_path string, figure string, pdf_id string")
    b = spark.createDataFrame([("q\\x\\f.png", "2", "e", "more")], "figure_path string, figure string, pdf_id string, extra string")
    out = M.global_manifest([a, b])
    assert out.columns == ["figure_path", "table_path", "tsv_path", "figure", "pdf_id", "extra"]
    assert sorted(tuple(r) for r in out.collect()) == [("d/figures/p.png", None, "d/t.tsv", "1", "d", None), ("e/q/x/f.png", None, None, "2", "e", "more")]


def test_pages(spark):
    c = spark.createDataFrame([("d", "figure", 1), ("d", "table", 1), ("d", "table", 1), ("d", "table", None), ("d", "other", 3), ("d", "table", 2)], "pdf_id string, class string, page_number int")
    need = PG.required_pages(c)
    assert need.count() == 3
    present = need.where("page_number = 1")
    assert [tuple(r) for r in PG.missing_pages(need, present).collect()] == [("d", "table", 2)]
    assert PG.all_present(present, need) and not PG.all_present(need, present)
    reached = spark.createDataFrame([("d", 2)], "pdf_id string, table_page int")
    assert PG.required_pages(c, reached).count() == 2
    pdfs = spark.createDataFrame([("d", "/d.pdf")], "pdf_id string, path string")
    images = PG.render(need, pdfs, lambda path, todo, dpi: [(k, p, f"{path}{k}{p}{dpi}".encode()) for k, p in todo])
    assert {bytes(r.png) for r in images.collect()} == {b"/d.pdffigure1200", b"/d.pdftable1200", b"/d.pdftable2200"}


def test_summaries(spark):
    status = spark.createDataFrame([("a", "succeeded"), ("a", "failed"), ("b", "skipped")], "pdf_id string, status string")
    assert {tuple(r) for r in S.run_summary(status).collect()} == {("a", 1, 0, 1), ("b", 0, 1, 0), (None, 1, 1, 1)}


@pytest.mark.parametrize("threshold", [0, 1])
def test_threshold_can_leave_nothing(spark, threshold):
    pairs = spark.createDataFrame([("d", "1", 0, 1, i, i + 2) for i in range(2)], PAIRS)
    valid = spark.createDataFrame([("d", p, 1) for p in range(9)], "pdf_id string, page_number int, n_rows long")
    assert M.local_manifest(pairs, valid, threshold).count() == 0
