"""Command line: PDF to elements, pairing, page images, tables and manifests.

    pipeline        a PDF file or folder (or existing element files) through all steps
    pair            element files to pairing documents
    tables          page images to page tables, all sets or some
    local-manifest  page tables and pairing to one manifest a manual
    global-manifest the manifests of all manuals to one
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsloom.config import Config, load_config
from partsloom.functions.text import output_path
from partsloom.operators import extract as X
from partsloom.operators import manifest as M
from partsloom.operators import pages as PG
from partsloom.operators import pairing as P
from partsloom.operators import stats as S
from partsloom.operators import tables as T
from partsloom.operators.elements import classify
from partsloom.session import cut_lineage
from partsloom.sources import readers, sinks

RESULTS = "data/results"
ELEMENTS = "images_tables_metadata.json"


def _say(*words) -> None:
    print(*words, flush=True)


def _config(args: argparse.Namespace) -> Config:
    cfg = load_config(args.config) if args.config else Config()
    return replace(cfg, calls=args.calls) if args.calls else cfg


def _report(elements: DataFrame, captions: str, pairs: bool) -> None:
    """Counts of figures, tables and pairs, and each pair of a single manual in the order of its number."""
    c = classify(elements, captions)
    n = c.agg(F.count_if(F.col("class") == "figure").alias("f"), F.count_if(F.col("class") == "table").alias("t")).first()
    found = cut_lineage(P.pairing(P.groups(c)))
    _say(f"figures {n.f}, tables {n.t}, pairs {found.count()}")
    if pairs:
        for r in found.orderBy(P.pair_order(F.col("key"))).toLocalIterator():
            _say(f"  {r.key}: figure pages {r.figure_pages}, table pages {r.table_pages}")


def _ended(run: DataFrame) -> None:
    """Totals of an extraction run and the pages that failed."""
    total = S.run_summary(run).where("pdf_id is null").first()
    _say(f"succeeded {total.succeeded}, skipped {total.skipped}, failed {total.failed}")
    for r in run.where("status = 'failed'").orderBy("pdf_id", "page_number").toLocalIterator():
        print(f"{r.pdf_id}/page_{r.page_number}: {r.error}", file=sys.stderr)


def _extracted(spark: SparkSession, images: DataFrame, cfg: Config, results: str, existing: DataFrame | None) -> DataFrame:
    return cut_lineage(X.extraction_run(images, cfg, f"{results}/_raw/{uuid.uuid4().hex}", existing))


def pipeline(spark: SparkSession, args: argparse.Namespace, partitioner=None, renderer=None) -> None:
    """All steps. Elements that are there are not made again; only missing page images are rendered."""
    source = args.from_metadata or args.pdf_path
    if not source:
        raise SystemExit("give a PDF or --from-metadata")
    if args.from_metadata:
        root, one = os.path.split(os.path.dirname(os.path.abspath(args.from_metadata)))
    elif args.output_dir:
        root, one = os.path.split(os.path.abspath(args.output_dir))
    else:
        root, one = args.results, None
    pdf = args.pdf or args.pdf_path
    pdfs = readers.read_pdfs(spark, pdf, content=False) if pdf else None
    if pdfs is not None:
        pdfs = pdfs.withColumn("pdf_id", F.lit(one)) if one else pdfs
        if pdfs.isEmpty():
            raise SystemExit(f"no PDF at {pdf}")
    if args.from_metadata:
        ids = [one]
    else:
        ids = sorted(r[0] for r in pdfs.select("pdf_id").toLocalIterator())
        have = [i for i in ids if readers.exists(spark, f"{root}/{i}/{ELEMENTS}")]
        todo = pdfs.where(~F.col("pdf_id").isin(have)) if have else pdfs
        _say(f"elements: {len(have)} manuals have them, {len(ids) - len(have)} to partition")
        if len(have) < len(ids):
            partitioner = partitioner or readers.default_partitioner()
            if partitioner is None:
                raise SystemExit("no PDF partitioner is installed; use --from-metadata")
            content = spark.read.format("binaryFile").load(pdf).select("path", "content").join(todo, "path")
            made = cut_lineage(readers.partition_documents(content, partitioner))
            sinks.write_elements(made, root)
            for i in [i for i in ids if i not in have and not readers.exists(spark, f"{root}/{i}/{ELEMENTS}")]:
                print(f"{i}: no elements", file=sys.stderr)
            ids = [i for i in ids if readers.exists(spark, f"{root}/{i}/{ELEMENTS}")]
            if not ids:
                raise SystemExit("no manual could be partitioned")
    elements = readers.read_elements(spark, [f"{root}/{i}/{ELEMENTS}" for i in ids])
    sinks.write_pairing(P.pairing_entries(elements, args.captions), root)
    if args.extract_pages:
        if pdfs is None:
            raise SystemExit("--extract-pages needs the PDF; give --pdf")
        need = PG.required_pages(classify(elements, args.captions))
        folders = [f"{root}/{i}/{k}" for i in ids for k in ("figures", "tables") if readers.exists(spark, f"{root}/{i}/{k}")]
        missing = cut_lineage(PG.missing_pages(need, readers.page_images(spark, folders, content=False)) if folders else need)
        if missing.isEmpty():
            _say("page images: all there")
        else:
            renderer = renderer or PG.default_renderer()
            if renderer is None:
                raise SystemExit("no PDF renderer is installed")
            sinks.write_images(PG.render(missing, pdfs, renderer), root)
            _say(f"page images: {missing.count()} rendered")
    if args.run_extraction:
        folders = [f"{root}/{i}/tables" for i in ids if readers.exists(spark, f"{root}/{i}/tables")]
        if not folders:
            raise SystemExit("no tables/ folder; use --extract-pages first")
        run = _extracted(spark, readers.page_images(spark, folders), _config(args), root, None)
        sinks.write_page_tables(run, root)
        _ended(run)
    _report(elements, args.captions, pairs=len(ids) == 1)


def pair(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pairing documents of all manuals below a folder, or of one element file (to `-o`, else beside it)."""
    if args.results.endswith(".json"):
        folder = os.path.dirname(os.path.abspath(args.results))
        elements = readers.read_elements(spark, args.results)
        root, name = os.path.split(folder)
        if args.output:
            doc = P.pairing_documents(elements, args.captions).first()
            out = sinks._Folder(os.path.dirname(os.path.abspath(args.output))).open(os.path.basename(args.output))
            out.write(doc.document if doc else "{}")
            out.close()
        else:
            sinks.write_pairing(P.pairing_entries(elements, args.captions), root)
        _report(elements, args.captions, pairs=True)
        return
    elements = readers.read_elements(spark, f"{args.results}/*/{ELEMENTS}")
    sinks.write_pairing(P.pairing_entries(elements, args.captions), args.results)
    _report(elements, args.captions, pairs=False)


def tables(spark: SparkSession, args: argparse.Namespace) -> None:
    """Page tables of all sets or some. `--lenient` leaves unusable sets out with a reason; else a missing one ends the run."""
    cfg = _config(args)
    results = args.results or cfg.results_dir
    if not results:
        raise SystemExit("give the results folder, or results_dir in the configuration")
    cfg = replace(cfg, results_dir=results, output_subdir=args.subdir or cfg.output_subdir)
    names = args.datasets if args.datasets and args.datasets != ["*"] else None
    names = names or (list(cfg.datasets) if cfg.datasets else None)
    if not args.lenient:
        readers.datasets(spark, results, names)
    found, reasons = readers.usable_sets(spark, results, names, cfg.tables_subdir)
    for n, why in reasons:
        _say(f"{n}: {why}, left out")
    if not found:
        raise SystemExit("no set has page images")
    images = readers.page_images(spark, [f"{results}/{d}/{cfg.tables_subdir}" for d in found], any_case=args.lenient)
    layout, base = cfg.layout(args.output_dir or "")
    images = cut_lineage(images.select("pdf_id", "page_number", "png", output_path(F.col("path"), layout, base, cfg.output_subdir).alias("out_path")).where("page_number is not null"))
    existing = None
    if cfg.skip_existing and not args.overwrite:
        pattern = f"{base}/*/{cfg.output_subdir}" if layout == "beside" else f"{base}/*"
        if readers.exists(spark, f"{pattern}/page_*.tsv"):
            existing = readers.existing_outputs(spark, pattern, above=2 if layout == "beside" else 1)
    _say(f"sets {len(found)}, images {images.count()}, provider {cfg.provider}")
    run = _extracted(spark, images, cfg, results, existing)
    sinks.write_page_tables(run, base, cfg.output_subdir, layout)
    _ended(run)


def local(spark: SparkSession, args: argparse.Namespace) -> None:
    """One manifest a manual, beside its tables; manuals without a valid pair are named and get none."""
    subdir = args.subdir or "table_data"
    elements = readers.read_elements(spark, f"{args.results}/*/{ELEMENTS}")
    valid = T.valid_pages(cut_lineage(readers.read_tables_strict(spark, f"{args.results}/*/{subdir}")))
    rows = cut_lineage(M.manifest_rows(P.pair_tables(P.groups(classify(elements, args.captions))), valid))
    if rows.isEmpty():
        raise SystemExit("no pair has a valid table page")
    kept = cut_lineage(M.within_threshold(rows, args.threshold))
    sinks.write_local_manifests(kept, args.results, args.manifest_name)
    n = kept.agg(F.count("*").alias("n"), F.countDistinct("pdf_id").alias("m")).first()
    _say(f"rows {n.n} of {rows.count()} in {n.m} manuals; threshold {args.threshold}")
    for r in elements.select("pdf_id").distinct().join(kept.select("pdf_id").distinct(), "pdf_id", "left_anti").orderBy("pdf_id").toLocalIterator():
        _say(f"{r.pdf_id}: no rows")


def merge(spark: SparkSession, args: argparse.Namespace) -> None:
    """One manifest of all manuals, paths below the results folder."""
    found, skipped = readers.manifests(spark, args.results, args.manifest_name)
    merged = cut_lineage(M.global_manifest(found))
    out = args.output or f"{args.results}/dataset_manifest_global.tsv"
    sinks.write_manifest(merged, out, single_file=True)
    total = merged.agg(F.count("*").alias("n"), F.countDistinct("figure").alias("f"), F.countDistinct("pdf_id").alias("m")).first()
    _say(f"rows {total.n}, figures {total.f}, manuals {total.m}")
    if skipped:
        _say("without manifest:", ", ".join(skipped))


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="partsloom")
    sub = parser.add_subparsers(required=True)

    def command(name, run):
        p = sub.add_parser(name, help=run.__doc__.split(".")[0])
        p.set_defaults(run=run)
        p.add_argument("--captions", choices=["lenient", "strict"], default="lenient")
        p.add_argument("--config")
        p.add_argument("--calls", type=int, default=0)
        return p

    p = command("pipeline", pipeline)
    p.add_argument("pdf_path", nargs="?")
    p.add_argument("--from-metadata", metavar="JSON")
    p.add_argument("--output-dir", "-o")
    p.add_argument("--results", default=RESULTS)
    p.add_argument("--extract-pages", action="store_true")
    p.add_argument("--run-extraction", action="store_true")
    p.add_argument("--pdf")
    p = command("pair", pair)
    p.add_argument("results")
    p.add_argument("--output", "-o")
    p = command("tables", tables)
    p.add_argument("results", nargs="?")
    p.add_argument("--subdir", default="")
    p.add_argument("--datasets", nargs="*")
    p.add_argument("--output-dir")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--lenient", action="store_true")
    p = command("local-manifest", local)
    p.add_argument("results")
    p.add_argument("--subdir", default="")
    p.add_argument("--threshold", "-t", type=int, default=M.THRESHOLD)
    p.add_argument("--manifest-name", default="dataset_manifest_local.tsv")
    p = command("global-manifest", merge)
    p.add_argument("results")
    p.add_argument("--output", "-o")
    p.add_argument("--manifest-name", default="dataset_manifest_local.tsv")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    args.run(SparkSession.builder.appName("partsloom").getOrCreate(), args)


if __name__ == "__main__":
    main()
