"""Readers of the result tree: element and pairing JSON, table text, manifests, images, sets.

Layout: <results>/<pdf_id>/{images_tables_metadata.json, figures_tables_pages.json,
figures/page_N.png, tables/page_N.png, table_data/page_N.tsv, dataset_manifest_local.tsv}.
Manual and page come from the path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partsloom.functions.text import null_if_na, page_of_name
from partsloom.schemas import COLUMNS, ELEMENTS, PAIRING


def _path() -> Column:
    return F.col("_metadata.file_path")


def _folder(path: Column, above: int) -> Column:
    """Name of the folder `above` levels over the file."""
    return F.url_decode(F.replace(F.element_at(F.split(path, "/"), -1 - above), F.lit("+"), F.lit("%2B")))


def read_elements(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(pdf_id, element_index, type, element_id, page_number, text); the array index is kept."""
    docs = spark.read.text(path, wholetext=True).select(_folder(_path(), 1).alias("pdf_id"), F.from_json("value", ELEMENTS).alias("e"))
    rows = docs.select("pdf_id", F.posexplode("e").alias("element_index", "e"))
    return rows.select("pdf_id", "element_index", "e.type", "e.element_id", F.col("e.metadata.page_number").alias("page_number"), "e.text")


def read_pairing(spark: SparkSession, path: str) -> DataFrame:
    """(pdf_id, key, pair_ordinal, figure_pages, figure_texts, table_pages) in document order."""
    schema = f"pairing {PAIRING.simpleString()}"
    docs = spark.read.text(path, wholetext=True).select(_folder(_path(), 1).alias("pdf_id"), F.from_json("value", schema).alias("d"))
    rows = docs.select("pdf_id", F.posexplode("d.pairing").alias("pair_ordinal", "key", "v"))
    return rows.select("pdf_id", "key", "pair_ordinal", "v.*")


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """Table rows (pdf_id, page_number, row_idx, names, values) of engine-written page text.

    Text this engine wrote has no quoting. Short rows are padded with null; a page with a row
    wider than its header, without lines or without a page number in its name gives no rows.
    """
    docs = spark.read.text(path, wholetext=True).select(
        _folder(_path(), 2).alias("pdf_id"), page_of_name(_folder(_path(), 0)).alias("page_number"), F.filter(F.split("value", "\r\n|\n|\r"), lambda x: F.trim(x) != "").alias("l")
    )
    docs = docs.where(F.col("page_number").isNotNull() & (F.size("l") > 0)).withColumn("names", F.split(F.get("l", F.lit(0)), "\t", -1))
    rows = F.transform(F.slice("l", 2, F.greatest(F.size("l") - 1, F.lit(0))), lambda x: F.split(x, "\t", -1))
    docs = docs.withColumn("rows", rows).where(~F.exists("rows", lambda r: F.size(r) > F.size("names")))
    out = docs.select("pdf_id", "page_number", "names", F.posexplode("rows").alias("row_idx", "r"))
    values = F.transform("names", lambda n, i: null_if_na(F.get("r", i)))
    return out.select("pdf_id", "page_number", "row_idx", "names", values.alias("values"))


def read_tables_strict(spark: SparkSession, path: str) -> DataFrame:
    """As `read_tables`, for foreign files: quoting, duplicate headers and ragged rows by pandas' own rules."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches):
        import io
        import re

        import pandas as pd

        for pdf in batches:
            rows = []
            for name, content in zip(pdf["path"], pdf["content"]):
                m = re.search(r"([^/]+)/[^/]+/page_(\d+)\.tsv$", name)
                if not m:
                    continue
                try:
                    # index_col=False: a first row wider than the header makes the page unreadable, not an index
                    table = pd.read_csv(io.BytesIO(content), sep="\t", dtype=str, index_col=False, on_bad_lines="error")
                    if any(line.count("\t") >= len(table.columns) for line in content.decode().splitlines()[1:2] if '"' not in line):
                        continue
                except (pd.errors.ParserError, pd.errors.EmptyDataError, UnicodeDecodeError):
                    continue
                names = [str(c) for c in table.columns]
                for i, r in enumerate(table.itertuples(index=False)):
                    rows.append((m[1], int(m[2]), i, names, [None if pd.isna(v) else v for v in r]))
            yield pd.DataFrame(rows, columns=["pdf_id", "page_number", "row_idx", "names", "values"])

    return files.mapInPandas(run, "pdf_id string, page_number int, row_idx int, names array<string>, values array<string>")


def wide_tables(rows: DataFrame) -> DataFrame:
    """Table rows to the canonical five columns; a missing column is null."""
    at = lambda c: F.get("values", F.array_position("names", F.lit(c)).cast("int") - 1)
    return rows.select("pdf_id", "page_number", "row_idx", *[F.when(F.array_contains("names", c), at(c)).alias(c) for c in COLUMNS])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One manifest file, all strings, null spellings as null, with `pdf_id` from its folder."""
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    df = df.select(*[null_if_na(F.col(c)).alias(c) for c in df.columns], _folder(_path(), 1).alias("_p"))
    return df.drop("pdf_id").withColumnRenamed("_p", "pdf_id")


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) in a folder, by the file system the path names."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(folder))


def datasets(spark: SparkSession, results: str, names: list[str] | None = None, strict: bool = True) -> tuple[list[str], list[str]]:
    """(found, missing) sets: all `data-*` folders by name, or the named ones in the given order."""
    folders = [n for n, is_dir in _children(spark, results) if is_dir]
    if names is None:
        return [n for n in folders if n.startswith("data-")], []
    found, missing = [n for n in names if n in folders], [n for n in names if n not in folders]
    if missing and strict:
        raise FileNotFoundError(f"sets not found in {results}: {', '.join(missing)}")
    return found, missing


def manifests(spark: SparkSession, results: str, name: str = "dataset_manifest_local.tsv") -> tuple[DataFrame, list[str]]:
    """(rows of all manifests, folders skipped because they have none or an empty one). Raises if there is none at all.

    One listing and one scan, whatever the number of manuals: each file is cut into lines and
    matched with its own header inside the JVM; a column that a file lacks is null. `line` is the
    row's place in its file. Columns come in the order of the first manual that has them.
    """
    files = spark.read.text(f"{results}/*/{name}", wholetext=True) if exists(spark, f"{results}/*/{name}") else None
    if files is None:
        raise FileNotFoundError(f"no {name} below {results}")
    lines = F.split(F.regexp_replace("value", "(?:\r\n|\n|\r)$", ""), "\r\n|\n|\r")
    docs = files.select(_folder(_path(), 1).alias("pdf_id"), lines.alias("l"))
    docs = docs.where(F.trim(F.get("l", F.lit(0))) != "").withColumn("names", F.split(F.get("l", F.lit(0)), "\t", -1))
    heads = docs.select("pdf_id", "names").groupBy("names").agg(F.min("pdf_id").alias("p"))
    # Distinct headers: as many as there are kinds of manifest, not as there are manuals.
    columns = list(dict.fromkeys(c for r in heads.orderBy("p").toLocalIterator() for c in r.names if c != "pdf_id"))
    rows = docs.select("pdf_id", "names", F.posexplode(F.slice("l", 2, F.greatest(F.size("l") - 1, F.lit(0)))).alias("line", "text")).where("text <> ''")
    rows = rows.withColumn("v", F.split("text", "\t", -1))
    at = lambda c: F.get("v", F.array_position("names", F.lit(c)).cast("int") - 1)
    cells = [null_if_na(F.when(F.array_contains("names", c), _unquoted(at(c)))).alias(c) for c in columns]
    held = [r[0] for r in docs.select("pdf_id").toLocalIterator()]
    skipped = sorted({n for n, is_dir in _children(spark, results) if is_dir} - set(held))
    return rows.select(*cells, "pdf_id", "line"), skipped


def _unquoted(cell: Column) -> Column:
    inner = F.regexp_replace(F.regexp_replace(cell, '^"|"$', ""), '""', '"')
    return F.when(cell.rlike('(?s)^".*"$'), inner).otherwise(cell)


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def usable_sets(spark: SparkSession, results: str, names: list[str] | None = None, subdir: str = "tables") -> tuple[list[str], list[tuple[str, str]]]:
    """(sets with page images, (set, reason) of the others): missing, without the image folder, without images."""
    found, missing = datasets(spark, results, names, strict=False)
    skipped, good = [(n, "not found") for n in missing], []
    for n in found:
        inside = _children(spark, f"{results}/{n}/{subdir}")
        if subdir not in [x for x, is_dir in _children(spark, f"{results}/{n}") if is_dir]:
            skipped.append((n, f"no {subdir}/ folder"))
        elif not any(x.lower().endswith(".png") for x, _ in inside):
            skipped.append((n, f"no images in {subdir}/"))
        else:
            good.append(n)
    return good, skipped


def page_images(spark: SparkSession, path: str | list[str], content: bool = True, any_case: bool = True) -> DataFrame:
    """(pdf_id, kind, page_number, path[, png]) of PNG files; `any_case` takes suffixes like `.PNG`, too."""
    files = spark.read.format("binaryFile").load(path)
    files = files.where((F.lower("path") if any_case else F.col("path")).endswith(".png"))
    cols = [
        _folder(F.col("path"), 2).alias("pdf_id"),
        F.regexp_replace(_folder(F.col("path"), 1), "s$", "").alias("kind"),
        page_of_name(F.lower(_folder(F.col("path"), 0)), "png").alias("page_number"),
        "path",
    ]
    return files.select(*cols, *([F.col("content").alias("png")] if content else []))


def existing_outputs(spark: SparkSession, path: str, above: int = 2) -> DataFrame:
    """(out_path, pdf_id, page_number) of page tables there are; the manual's folder is `above` levels over the file."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "page_*.tsv").load(path)
    return files.select(F.col("path").alias("out_path"), _folder(F.col("path"), above).alias("pdf_id"), page_of_name(_folder(F.col("path"), 0)).alias("page_number"))


def default_partitioner(tables: bool = False):
    """The installed PDF partitioner, or None: `partitioner(path, content) -> [dict]`. With `tables`, table structure is inferred."""
    try:
        from unstructured.partition.pdf import partition_pdf
    except ImportError:
        return None

    def run(path: str, content: bytes) -> list[dict]:
        import io

        options = {"infer_table_structure": True} if tables else {"extract_image_block_types": ["Table"], "extract_image_block_to_payload": True}
        return [e.to_dict() for e in partition_pdf(file=io.BytesIO(content), strategy="hi_res", **options)]

    return run


_ELEMENTS = "pdf_id string, element_index int, type string, element_id string, page_number int, text string"


def partition_documents(pdfs: DataFrame, partitioner) -> DataFrame:
    """Elements of PDF files (path, content) by a plugged-in `partitioner(path, content) -> [dict]`.

    A file that can't be read gives no rows; `failed_documents` names it.
    """
    return _partitioned(pdfs, partitioner, failures=False)


def failed_documents(pdfs: DataFrame, partitioner) -> DataFrame:
    """(pdf_id, error) of the PDF files the partitioner can't read."""
    return _partitioned(pdfs, partitioner, failures=True)


def _partitioned(pdfs: DataFrame, partitioner, failures: bool) -> DataFrame:
    src = pdfs.select(stem_of(F.col("path")).alias("pdf_id"), "path", "content")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows, errors = [], []
            for pdf_id, path, content in zip(pdf["pdf_id"], pdf["path"], pdf["content"]):
                try:
                    found = partitioner(path, bytes(content))
                except Exception as error:  # noqa: BLE001 - one unreadable file must not end the batch
                    errors.append((pdf_id, str(error)))
                    continue
                for i, e in enumerate(found):
                    rows.append((pdf_id, i, e.get("type"), e.get("element_id"), (e.get("metadata") or {}).get("page_number"), e.get("text")))
            if failures:
                yield pd.DataFrame(errors, columns=["pdf_id", "error"])
            else:
                yield pd.DataFrame(rows, columns=["pdf_id", "element_index", "type", "element_id", "page_number", "text"]).astype({"page_number": "Int32"})

    return src.mapInPandas(run, "pdf_id string, error string" if failures else _ELEMENTS)


def stem_of(path: Column) -> Column:
    """Name of a PDF file without folder and suffix: the manual, and the default folder of its results."""
    return F.regexp_replace(_folder(path, 0), r"(?i)\.pdf$", "")


def read_pdfs(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """(pdf_id, path[, content]) of a PDF file or of those in a folder."""
    files = spark.read.format("binaryFile").load(path).where(F.lower("path").endswith(".pdf"))
    return files.select(stem_of(F.col("path")).alias("pdf_id"), "path", *(["content"] if content else []))


def figure_blocks(elements: DataFrame) -> DataFrame:
    """Image blocks among elements: what a figure extraction keeps."""
    return elements.where(F.col("type") == "Image")
