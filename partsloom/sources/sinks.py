"""Writers of the result tree. Executors write the files of their own partition to the file system the
path names (a local or shared folder, HDFS, an object store); nothing is collected.

Files of one manual that hold many rows (manifest, pairing) are streamed: rows are brought
together by manual, sorted inside the partition and written one by one, so no manual is
ever held in memory. A file that is cut off is never seen: it is written beside and moved.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def file_system(root: str):
    """(file system, path in it) of a folder, by pyarrow; paths without a scheme are local or mounted."""
    from pyarrow import fs

    if re.match(r"[A-Za-z][A-Za-z0-9+.\-]+:", root):
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), os.path.abspath(root)


class _Folder:
    """Writes files below a folder; one is visible when it is complete."""

    def __init__(self, root: str):
        self.fs, self.root = file_system(root)

    def open(self, name: str):
        path = f"{self.root}/{name}"
        self.fs.create_dir(path.rpartition("/")[0], recursive=True)
        part = f"{path}.{os.getpid()}.part"
        return _File(self.fs, self.fs.open_output_stream(part), part, path)


class _File:
    def __init__(self, fs, out, part: str, path: str):
        self.fs, self.out, self.part, self.path = fs, out, part, path

    def write(self, data: str | bytes) -> None:
        self.out.write(data if isinstance(data, bytes) else data.encode("utf-8"))

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def _each(df: DataFrame, results: str, place, content) -> None:
    def write(rows):
        folder = _Folder(results)
        for r in rows:
            out = folder.open(place(r))
            data = content(r)
            out.write(bytes(data) if isinstance(data, (bytes, bytearray)) else data)
            out.close()

    df.foreachPartition(write)


def _streamed(df: DataFrame, order: list[Column | str], results: str, name: str, head, line, tail=lambda last: "") -> None:
    """One file a manual: `head(first row)`, `line(row, row before or None)` for every row in order, `tail(last row)`."""

    def write(rows):
        folder, out, before = _Folder(results), None, None
        for r in rows:
            if before is None or before.pdf_id != r.pdf_id:
                if out:
                    out.write(tail(before))
                    out.close()
                out, before = folder.open(f"{r.pdf_id}/{name}"), None
                out.write(head(r))
            out.write(line(r, before))
            before = r
        if out:
            out.write(tail(before))
            out.close()

    df.where(F.col("pdf_id").isNotNull()).repartition("pdf_id").sortWithinPartitions("pdf_id", *order).foreachPartition(write)


def write_images(images: DataFrame, results: str) -> None:
    """(pdf_id, kind, page_number, png) to <pdf_id>/<kind>s/page_N.png."""
    _each(images, results, lambda r: f"{r.pdf_id}/{r.kind}s/page_{r.page_number}.png", lambda r: r.png)


def write_page_tables(tables: DataFrame, results: str, subdir: str = "table_data", layout: str = "beside") -> None:
    """(pdf_id, page_number, tsv) to page_N.tsv; pages without text write none.

    Layouts: `beside` <pdf_id>/<subdir>, `apart` <pdf_id>, `flat` the folder itself (one manual's pages).
    """
    folder = {"beside": lambda r: f"{r.pdf_id}/{subdir}/", "apart": lambda r: f"{r.pdf_id}/", "flat": lambda r: ""}[layout]
    _each(tables.where(F.col("tsv").isNotNull()), results, lambda r: f"{folder(r)}page_{r.page_number}.tsv", lambda r: r.tsv)


def write_pairing(entries: DataFrame, results: str) -> None:
    """Entries of pairing documents (see `pairing_entries`) to <pdf_id>/figures_tables_pages.json."""
    sections = ("figures", "tables", "pairing")
    opened = {"figures": "[", "tables": "[", "pairing": "{"}
    closed = {"figures": "]", "tables": "]", "pairing": "}"}

    def line(r, before):
        at = sections.index(before.section) if before else -1
        to = sections.index(r.section)
        out = ""
        for k in range(at, to):
            out += (f"{closed[sections[k]]}," if k >= 0 else "") + f'"{sections[k + 1]}":{opened[sections[k + 1]]}'
        return out + ("," if at == to and before.item is not None else "") + (r.item or "")

    _streamed(entries, [F.expr("array_position(array('figures', 'tables', 'pairing'), section)"), "place"], results, "figures_tables_pages.json", lambda r: "{", line, lambda r: f"{closed[r.section]}}}")


def write_elements(elements: DataFrame, results: str, name: str = "images_tables_metadata.json") -> None:
    """Elements to <pdf_id>/images_tables_metadata.json."""
    entry = F.struct("type", "element_id", "text", F.struct("page_number").alias("metadata"))
    rows = elements.select("pdf_id", "element_index", F.to_json(entry, {"ignoreNullFields": "false"}).alias("item"))
    _streamed(rows, ["element_index"], results, name, lambda r: "[", lambda r, before: ("," if before else "") + r.item, lambda r: "]")


def write_store(df: DataFrame, path: str) -> None:
    """The engine's own storage: Parquet by manual."""
    df.write.mode("overwrite").partitionBy("pdf_id").parquet(path)


def _cells(r, columns: list[str]) -> str:
    """A line of tab-separated values, quoted only where a value needs it."""
    cell = lambda v: "" if v is None else f'"{v.replace(chr(34), chr(34) * 2)}"' if re.search('["\t\r\n]', v) else v
    return "\t".join(cell(None if r[c] is None else str(r[c])) for c in columns) + "\n"


def write_local_manifests(manifest: DataFrame, results: str, name: str = "dataset_manifest_local.tsv") -> None:
    """Rows to <pdf_id>/<name>, in manifest order: a header, null as empty. A manual without rows has no file."""
    columns = [c for c in manifest.columns if c not in {"pdf_id", "pair_ordinal", "first_index"}]
    _streamed(manifest, ["pair_ordinal", "first_index"], results, name, lambda r: "\t".join(columns) + "\n", lambda r, before: _cells(r, columns))


def write_manifest(manifest: DataFrame, path: str, single_file: bool = False) -> None:
    """Tab-separated with a header, null as empty, in manifest order: manuals by name, then the order inside each
    (`pair_ordinal`, `first_index`, or the `line` of a merged one). `single_file` streams the parts into the file `path`."""
    order = [c for c in ("pdf_id", "pair_ordinal", "first_index", "line") if c in manifest.columns]
    rows = manifest.orderBy(*order) if order else manifest
    out = rows.drop("pair_ordinal", "first_index", "line")
    if not single_file:
        out.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="", emptyValue="")
        return
    folder, _, name = path.rpartition("/")
    target = _Folder(folder or ".").open(name)
    target.write("\t".join(out.columns) + "\n")
    for r in out.toLocalIterator():  # a partition at a time, in order
        target.write(_cells(r, out.columns))
    target.close()
