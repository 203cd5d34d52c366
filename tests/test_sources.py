import json

import pytest

from partsloom import cli
from partsloom.config import Config
from partsloom.functions.text import relativize  # noqa: F401
from partsloom.operators import extract as X
from partsloom.sources import readers, sinks
from partsloom.streaming import pages as stream

HEADER = "item_no\tpart_no\tdescription\tuoc\tquantity"


@pytest.fixture
def tree(tmp_path):
    elements = [
        {"type": "Text", "text": "Figure 1. Pump", "element_id": "a", "metadata": {"page_number": 1, "image": "x"}},
        {"type": "Table", "text": None, "element_id": "b", "metadata": {"page_number": 2}},
        {"type": "Table", "element_id": "c", "metadata": None},
    ]
    for name in ("data-1", "data-2", "other"):
        d = tmp_path / name
        (d / "table_data").mkdir(parents=True)
        (d / "tables").mkdir()
        (d / "images_tables_metadata.json").write_text(json.dumps(elements))
        (d / "table_data/page_2.tsv").write_text(HEADER + "\n1\tP\tBOLT\t\t2\n2\tQ\tNUT\tNaN")
        (d / "table_data/page_x.tsv").write_text(HEADER)
        (d / "table_data/page_3.tsv").write_text(HEADER + "\n1\tP\tB\t\t2\textra\n2\tQ\tB\t\t2")
        (d / "tables/page_2.png").write_bytes(b"1\tP\tBOLT\t\t2")
        (d / "tables/page_4.PNG").write_bytes(b"none")
    return tmp_path


def test_readers(spark, tree):
    e = readers.read_elements(spark, f"{tree}/*/images_tables_metadata.json").where("pdf_id = 'data-1'").orderBy("element_index").collect()
    assert [(r.element_index, r.type, r.page_number, r.text) for r in e] == [(0, "Text", 1, "Figure 1. Pump"), (1, "Table", 2, None), (2, "Table", None, None)]
    for read in (readers.read_tables, readers.read_tables_strict):
        rows = read(spark, f"{tree}/data-1/table_data").orderBy("row_idx").collect()
        assert [(r.page_number, r.row_idx, r["values"]) for r in rows] == [(2, 0, ["1", "P", "BOLT", None, "2"]), (2, 1, ["2", "Q", "NUT", None, None])]
    wide = readers.wide_tables(readers.read_tables(spark, f"{tree}/data-1/table_data")).where("row_idx = 0").first()
    assert (wide.item_no, wide.uoc, wide.quantity) == ("1", None, "2")
    images = readers.page_images(spark, f"{tree}/*/tables")
    assert images.count() == 6 and {r.kind for r in images.collect()} == {"table"}
    assert readers.datasets(spark, str(tree)) == (["data-1", "data-2"], [])
    assert readers.datasets(spark, str(tree), ["data-2", "gone"], strict=False) == (["data-2"], ["gone"])
    with pytest.raises(FileNotFoundError):
        readers.datasets(spark, str(tree), ["gone"])
    assert readers.usable_sets(spark, str(tree), ["data-2", "gone"]) == (["data-2"], [("gone", "not found")])
    with pytest.raises(FileNotFoundError):
        readers.manifests(spark, str(tree))


def test_sinks_and_round_trip(spark, tree):
    elements = readers.read_elements(spark, f"{tree}/*/images_tables_metadata.json")
    before = sorted(map(tuple, elements.collect()), key=str)
    sinks.write_elements(elements, str(tree / "copy"))
    again = readers.read_elements(spark, f"{tree}/copy/*/images_tables_metadata.json")
    assert sorted(map(tuple, again.collect()), key=str) == before
    images = readers.page_images(spark, f"{tree}/data-1/tables").where("page_number = 2")
    out = X.sanitized(X.extract(images, Config(delay_seconds=0)))
    sinks.write_page_tables(out, str(tree / "copy"))
    assert (tree / "copy/data-1/table_data/page_2.tsv").read_text() == HEADER + "\n1\tP\tBOLT\t\t2"
    sinks.write_images(images, str(tree / "copy"))
    assert (tree / "copy/data-1/tables/page_2.png").read_bytes() == b"1\tP\tBOLT\t\t2"
    done = readers.existing_outputs(spark, f"{tree}/copy/*/table_data").collect()
    assert [(r.pdf_id, r.page_number) for r in done] == [("data-1", 2)]


def test_steps_chain(spark, tree, capsys):
    """Pair, tables, local and global manifest: each step reads what the one before wrote."""
    cli.main(["pair", str(tree)])
    doc = json.loads((tree / "data-1/figures_tables_pages.json").read_text())
    assert list(doc) == ["figures", "tables", "pairing"] and len(doc["figures"]) == 1 and len(doc["tables"]) == 2
    assert doc["pairing"] == {"1": {"figure_pages": [1], "figure_texts": ["Figure 1. Pump"], "table_pages": [2]}}
    p = readers.read_pairing(spark, f"{tree}/*/figures_tables_pages.json").where("pdf_id = 'data-1'").first()
    assert (p.key, p.pair_ordinal, p.figure_pages, p.table_pages) == ("1", 0, [1], [2])
    one = tree / "one.json"
    cli.main(["pair", str(tree / "data-1/images_tables_metadata.json"), "-o", str(one)])
    assert json.loads(one.read_text()) == doc and "1: figure pages [1], table pages [2]" in capsys.readouterr().out

    (tree / "data-3/tables").mkdir(parents=True)
    (tree / "data-4").mkdir()
    (tree / "data-1/table_data/page_2.tsv").unlink()
    (tree / "data-1/tables/page_2.png").write_bytes(b"1\tP\tBOLT\t\t2\n2\tQ\tNUT\t\t1")
    with pytest.raises(FileNotFoundError):
        cli.main(["tables", str(tree), "--datasets", "gone"])
    cfg = tree / "cfg.yaml"
    cfg.write_text("provider: stub\npipeline: {delay_seconds: 0}\n")
    cli.main(["tables", str(tree), "--lenient", "--datasets", "data-1", "data-2", "data-3", "data-4", "gone", "--config", str(cfg)])
    said = capsys.readouterr().out
    assert "gone: not found" in said and "data-3: no images in tables/" in said and "data-4: no tables/ folder" in said
    assert "succeeded 3, skipped 1, failed 0" in said
    assert (tree / "data-1/table_data/page_2.tsv").read_text() == HEADER + "\n1\tP\tBOLT\t\t2\n2\tQ\tNUT\t\t1"
    assert (tree / "data-2/table_data/page_4.tsv").read_text() == HEADER
    raw = spark.read.parquet(f"{tree}/_raw/*")
    assert raw.count() == 3 and {r.status for r in raw.collect()} == {"succeeded"}

    cli.main(["local-manifest", str(tree)])
    for d in ("data-1", "data-2", "other"):
        assert (tree / d / "dataset_manifest_local.tsv").read_text() == "figure_path\ttable_path\ttsv_path\tfigure\nfigures/page_1.png\ttables/page_2.png\ttable_data/page_2.tsv\t1\n"
    cli.main(["global-manifest", str(tree)])
    lines = (tree / "dataset_manifest_global.tsv").read_text().splitlines()
    assert lines[0].split("\t") == ["figure_path", "table_path", "tsv_path", "figure", "pdf_id"]
    assert [x.split("\t")[-1] for x in lines[1:]] == ["data-1", "data-2", "other"]
    assert lines[1] == "data-1/figures/page_1.png\tdata-1/tables/page_2.png\tdata-1/table_data/page_2.tsv\t1\tdata-1"
    assert "without manifest: _raw, data-3, data-4" in capsys.readouterr().out


def test_layouts_and_overwrite(spark, tree):
    cfg = tree / "cfg.yaml"
    cfg.write_text(f"provider: stub\npipeline: {{delay_seconds: 0, results_dir: {tree}, datasets: [data-1]}}\n")
    cli.main(["tables", "--config", str(cfg), "--output-dir", str(tree / "apart"), "--lenient"])
    assert (tree / "apart/data-1/page_2.tsv").read_text() == HEADER + "\n1\tP\tBOLT\t\t2"
    assert (tree / "apart/data-1/page_4.tsv").exists() and not (tree / "apart/data-2").exists()
    cli.main(["tables", "--config", str(cfg), "--subdir", "fresh"])
    assert (tree / "data-1/fresh/page_2.tsv").exists() and not (tree / "data-1/fresh/page_4.tsv").exists()  # suffix case matters here
    (tree / "data-1/fresh/page_2.tsv").write_text("old")
    cli.main(["tables", "--config", str(cfg), "--subdir", "fresh"])
    assert (tree / "data-1/fresh/page_2.tsv").read_text() == "old"
    cli.main(["tables", "--config", str(cfg), "--subdir", "fresh", "--overwrite"])
    assert (tree / "data-1/fresh/page_2.tsv").read_text() != "old"


def test_manifests_of_several_shapes(spark, tree):
    (tree / "data-1/dataset_manifest_local.tsv").write_text("figure_path\ttable_path\ttsv_path\tfigure\nb.png\tNaN\tt.tsv\t2\na.png\t\t\"q\"\"x\"\t1\n")
    (tree / "data-2/dataset_manifest_local.tsv").write_text("figure\tfigure_path\textra\r\n7\tf.png\te\r\n")
    (tree / "other/dataset_manifest_local.tsv").write_text("")
    found, skipped = readers.manifests(spark, str(tree))
    assert found.columns == ["figure_path", "table_path", "tsv_path", "figure", "extra", "pdf_id", "line"] and skipped == ["other"]
    rows = [tuple(r) for r in found.orderBy("pdf_id", "line").collect()]
    assert rows == [("b.png", None, "t.tsv", "2", None, "data-1", 0), ("a.png", None, 'q"x', "1", None, "data-1", 1), ("f.png", None, None, "7", "e", "data-2", 0)]
    cli.main(["global-manifest", str(tree), "-o", str(tree / "all.tsv")])
    assert [x.split("\t")[3] for x in (tree / "all.tsv").read_text().splitlines()[1:]] == ["2", "1", "7"]  # order kept


def fakes():
    def fake_partitioner(path, content):
        if b"bad" in content:
            raise ValueError("unreadable")
        return [
            {"type": "Text", "text": "Figure 1. Pump", "element_id": "a", "metadata": {"page_number": 1}},
            {"type": "Image", "text": None, "element_id": "i", "metadata": {"page_number": 1}},
            {"type": "Table", "text": "t", "element_id": "b", "metadata": {"page_number": 2}},
        ]


    def fake_renderer(path, todo, dpi):
        for kind, page in todo:
            yield kind, page, f"1\tP{page}\tBOLT\t\t2".encode()

    return fake_partitioner, fake_renderer


def test_pipeline_from_pdf_to_tables(spark, tmp_path, capsys):
    fake_partitioner, fake_renderer = fakes()
    (tmp_path / "in").mkdir()
    (tmp_path / "in/data-1.pdf").write_bytes(b"%PDF good")
    (tmp_path / "in/data-2.PDF").write_bytes(b"%PDF bad")
    root = tmp_path / "results"
    args = cli._parser().parse_args(["pipeline", str(tmp_path / "in"), "--results", str(root), "--extract-pages", "--run-extraction"])
    args.calls = 2
    with pytest.raises(SystemExit):
        cli.pipeline(spark, args)  # nothing is installed that reads PDFs
    cli.pipeline(spark, args, fake_partitioner, fake_renderer)
    out = capsys.readouterr()
    assert "data-2: no elements" in out.err
    assert "page images: 2 rendered" in out.out and "succeeded 1, skipped 0, failed 0" in out.out and "figures 1, tables 1, pairs 1" in out.out
    assert (root / "data-1/table_data/page_2.tsv").read_text() == HEADER + "\n1\tP2\tBOLT\t\t2"
    assert json.loads((root / "data-1/figures_tables_pages.json").read_text())["pairing"]["1"]["table_pages"] == [2]
    (root / "data-1/figures/page_1.png").unlink()
    again = cli._parser().parse_args(["pipeline", "--from-metadata", str(root / "data-1/images_tables_metadata.json"), "--pdf", str(tmp_path / "in/data-1.pdf"), "--extract-pages"])
    cli.pipeline(spark, again, fake_partitioner, fake_renderer)
    assert "page images: 1 rendered" in capsys.readouterr().out
    cli.pipeline(spark, again, fake_partitioner, fake_renderer)
    assert "page images: all there" in capsys.readouterr().out
    pdfs = spark.read.format("binaryFile").load(str(tmp_path / "in"))
    assert [tuple(r) for r in readers.failed_documents(pdfs, fake_partitioner).collect()] == [("data-2", "unreadable")]
    assert readers.figure_blocks(readers.partition_documents(pdfs, fake_partitioner)).count() == 1


def test_stream_continues_where_it_stopped(spark, tree):
    out, mark = str(tree / "stream"), str(tree / "mark")
    for _ in range(2):
        stream.start(spark, f"{tree}/*/tables", out, mark, Config(delay_seconds=0)).awaitTermination()
        assert spark.read.parquet(out).count() == 3
    (tree / "data-1/tables/page_9.png").write_bytes(b"9\tP\tD\t\t1")
    stream.start(spark, f"{tree}/*/tables", out, mark, Config(delay_seconds=0)).awaitTermination()
    assert {r.page_number for r in spark.read.parquet(out).collect()} == {2, 9}


def test_arrivals_with_late_rows(spark):
    from datetime import datetime as t

    rows = spark.createDataFrame([(t(2024, 1, 1, 5, 7), "a"), (t(2024, 1, 1, 5, 50), "a"), (t(2024, 1, 1, 6, 0), None)], "received_at timestamp, source string")
    got = {(r.window.start.hour, r.source, r.n) for r in stream.arrivals(rows).collect()}
    assert got == {(5, "a", 2), (6, None, 1)}


def test_arrivals_go_on_where_they_stopped(spark, tmp_path):
    from datetime import datetime as t

    source, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    schema = "received_at timestamp, source string"

    def bring(*rows):
        spark.createDataFrame(list(rows), schema).write.mode("append").parquet(source)
        lines = spark.readStream.schema(schema).parquet(source)
        return {(r.hour.day, r.hour.hour, r.source): r.n for r in stream.arrivals_run(lines, out, mark).collect()}

    assert bring((t(2024, 1, 1, 5, 7), "a"), (t(2024, 1, 1, 5, 9), "a")) == {(1, 5, "a"): 2}
    assert bring((t(2024, 1, 1, 5, 50), "a"), (t(2024, 1, 3, 8), "b")) == {(1, 5, "a"): 3, (3, 8, "b"): 1}
    # Two days behind the newest row is beyond the watermark of a day.
    assert bring((t(2024, 1, 1, 5, 55), "a"), (t(2024, 1, 3, 7), "b")) == {(1, 5, "a"): 3, (3, 8, "b"): 1, (3, 7, "b"): 1}
