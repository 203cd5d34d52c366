"""Problem 4: records that differ only in formatting.

Code points are streamed through one skip-and-fold table into rolling polynomial hashes: the
table skips what is neither letter nor digit, folds letter case and marks the piece
delimiters, so no canonical string is made. A piece's hash is a polynomial in its kept
characters; a column's hash sums mixed piece hashes (piece order drops out); a row's key
sums the mixed hashes of its two columns (which column holds which value drops out). Two
independent 64-bit hashes make the key.

The first pass shuffles counts of first keys only. Keys that occur twice go into a Bloom
filter of bounded size; the second pass hashes again and lets only rows through it whose key
may occur twice, so the texts of all other rows stay where they are. Rows of one key are then
held against the key's first row by a two-pointer comparison: the pieces of both rows are
matched by their hashes, and two pointers walk the characters of each matched pair, skipping
and folding by the table. A row that differs (a collision) is regrouped exactly, by its canonical
text, so a collision never merges rows.

Skew: keys are pre-aggregated before their shuffle, and the join of rows with the first rows of their
groups salts every key that holds more than a thousandth of them (`join_hot`).

Defined results: rows with a null or without any letter or digit in either column are out;
repeated row ids count as one row each; ties go to the smallest `row_id`.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsloom.llm.gates import gate_of, shared_gate
from partsloom.session import cut_lineage, join_hot

DELIMITERS = ",;"
#: Code points hashed or compared at once, in whole rows.
CHUNK = 1_000_000
_SKIP, _CUT = 0, 1
_SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

_tables: dict[str, np.ndarray] = {}


def fold_table() -> np.ndarray:
    """Code point -> 0 (skip), 1 (piece delimiter) or the folded code point. Built once a worker."""
    if "fold" not in _tables:
        table = np.zeros(0x110000, dtype=np.uint32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalnum():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        for c in DELIMITERS:
            table[ord(c)] = _CUT
        _tables["fold"] = table
    return _tables["fold"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Stream:
    """Kept characters of a list of strings, with the piece and string each belongs to."""

    def __init__(self, texts: list[str]):
        #: All folded codes; for each place the next kept one; where pieces begin and end.
        self.n = len(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=self.n)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = fold_table()[points]
        string = np.repeat(np.arange(self.n), lengths)
        piece = np.cumsum(code == _CUT) + string
        kept = np.flatnonzero(code > _CUT)
        self.folded = code
        self.next = np.append(kept, len(code))[np.cumsum(code > _CUT) - (code > _CUT)] if len(code) else np.zeros(0, dtype=np.int64)
        self.code, self.string = code[kept], string[kept]
        piece = piece[kept]
        first = np.ones(len(kept), dtype=bool)
        # Pieces are numbered over all strings, so a new number starts a new piece.
        first[1:] = (piece[1:] != piece[:-1]) | (self.string[1:] != self.string[:-1])
        self.starts = np.flatnonzero(first)
        self.begin = kept[self.starts]
        self.end = kept[np.append(self.starts[1:], len(kept)) - 1] + 1 if len(kept) else kept
        self.piece = np.cumsum(first) - 1
        self.position = np.arange(len(kept)) - self.starts[self.piece] if len(kept) else np.zeros(0, dtype=np.int64)

    def piece_hashes(self, which: int) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        value = _mix(self.code.astype(np.uint64) + np.uint64(_SEEDS[which]))
        terms = value * _powers(_BASES[which], int(self.position.max()) + 1)[self.position]
        return _mix(np.add.reduceat(terms, self.starts))

    def string_hashes(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash, whether the string has a kept character) of every string."""
        out, some = np.zeros(self.n, dtype=np.uint64), np.zeros(self.n, dtype=bool)
        owner = self.string[self.starts]
        np.add.at(out, owner, self.piece_hashes(which))
        some[owner] = True
        return _mix(out + np.uint64(_SEEDS[which])), some


def row_keys(parts: list[str], descriptions: list[str], bits: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first key, second key, usable) of rows; `bits` weakens the keys, for tests of collisions."""
    n, keys, usable = len(parts), [], None
    stream = Stream(parts + descriptions)
    for which in (0, 1):
        h, some = stream.string_hashes(which)
        key = _mix(h[:n]) + _mix(h[n:])
        keys.append((key >> np.uint64(64 - bits)).astype(np.int64))
        usable = some[:n] & some[n:]
    return keys[0], keys[1], usable


def _pieces(parts: list[str], descriptions: list[str]) -> tuple[Stream, np.ndarray, np.ndarray]:
    """(stream, pieces by row in the order of their column's and their own hashes, pieces a row)."""
    n, s = len(parts), Stream(parts + descriptions)
    column = s.string_hashes(0)[0]
    swap = column[:n] > column[n:]
    rank = np.concatenate([swap, ~swap]).astype(np.int64)
    string = s.string[s.starts]
    row = string % n if n else string
    order = np.lexsort((s.piece_hashes(1), s.piece_hashes(0), rank[string], row))
    return s, order, np.bincount(row, minlength=n)


def equal_pieces(a: Stream, pa: np.ndarray, b: Stream, pb: np.ndarray) -> np.ndarray:
    """Whether pieces `pa` of stream `a` and `pb` of stream `b` have the same kept, folded characters, pair by pair.

    Two pointers walk each pair; all pairs that are still open take a step at a time.
    """
    same = np.ones(len(pa), dtype=bool)
    live = np.arange(len(pa))
    i, j, ia, jb = a.begin[pa], b.begin[pb], a.end[pa], b.end[pb]
    while len(live):
        differ = a.folded[i] != b.folded[j]
        i, j = i + 1, j + 1
        # Skip to the next kept character, or past the piece.
        i = np.where(i < ia, a.next[np.minimum(i, len(a.next) - 1)], ia)
        j = np.where(j < jb, b.next[np.minimum(j, len(b.next) - 1)], jb)
        done = (i >= ia) & (j >= jb)
        differ |= ((i >= ia) | (j >= jb)) & ~done
        same[live[differ]] = False
        go = ~differ & ~done
        live, i, j, ia, jb = live[go], i[go], j[go], ia[go], jb[go]
    return same


def same_rows(a: tuple[list[str], list[str]], b: tuple[list[str], list[str]]) -> np.ndarray:
    """Whether rows `a` and `b` are copies, pair by pair.

    Columns and pieces of both rows are matched in the order of their hashes and compared.
    """
    (sa, oa, na), (sb, ob, nb) = _pieces(*a), _pieces(*b)
    same = na == nb
    count = np.where(same, na, 0)
    pair = np.repeat(np.arange(len(na)), count)
    step = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
    pa, pb = oa[(np.cumsum(na) - na)[pair] + step], ob[(np.cumsum(nb) - nb)[pair] + step]
    # Both columns of a row must hold as many pieces as their match.
    column = lambda s, p, n: s.string[s.starts[p]] >= n
    flip = column(sa, pa, len(na)) != column(sb, pb, len(nb))
    first = np.r_[True, pair[1:] != pair[:-1]] if len(pair) else np.zeros(0, dtype=bool)
    lead = flip[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(pair) else flip
    ok = equal_pieces(sa, pa, sb, pb) & (flip == lead)
    same[pair[~ok]] = False
    return same


def _chunks(*columns: list[str]):
    """(start, end) of runs of rows, bounded by code points."""
    start = size = 0
    for n, row in enumerate(zip(*columns)):
        size += sum(map(len, row))
        if size >= CHUNK:
            yield start, n + 1
            start, size = n + 1, 0
    if columns and start < len(columns[0]):
        yield start, len(columns[0])


def canonical(part: str, description: str) -> str:
    """The canonical text of a row; made only for rows that failed the comparison."""
    fold = fold_table()

    def column(text: str) -> str:
        pieces = "".join(chr(x) for x in (int(fold[ord(c)]) for c in text) if x).split("\x01")
        return "\x01".join(sorted(p for p in pieces if p))

    return "\x02".join(sorted((column(part), column(description))))


def _source(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    return df.select(F.col(key).alias("row_id"), F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())


def first_keys(df: DataFrame, a: str, b: str, bits: int = 64) -> DataFrame:
    """(k1): the first key of every usable row."""
    src = df.select(F.col(a).alias("a"), F.col(b).alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull())

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for x, y in _chunks(a, b):
                k1, _, usable = row_keys(a[x:y], b[x:y], bits)
                yield pa.RecordBatch.from_arrays([pa.array(k1[usable])], names=["k1"])

    return src.mapInArrow(run, "k1 bigint")


def likely_copies(df: DataFrame, key: str, a: str, b: str, gate, bits: int = 64) -> DataFrame:
    """(row_id, a, b, k1, k2) of the usable rows whose first key passes the filter."""

    def run(batches):
        import pyarrow as pa

        asked = gate.get()
        for batch in batches:
            a, b = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for x, y in _chunks(a, b):
                k1, k2, usable = row_keys(a[x:y], b[x:y], bits)
                out = pa.RecordBatch.from_arrays([*batch.slice(x, y - x).columns, pa.array(k1), pa.array(k2)], names=["row_id", "a", "b", "k1", "k2"])
                yield out.filter(pa.array(usable & asked.holds(k1)))

    return _source(df, key, a, b).mapInArrow(run, "row_id bigint, a string, b string, k1 bigint, k2 bigint")


def _verified(pairs: DataFrame) -> DataFrame:
    """(row_id, keep_id, k1, k2, rest): `rest` is the canonical text of a row that isn't a copy after all."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            c = {f: batch.column(i) for i, f in enumerate(batch.schema.names)}
            a, b, a0, b0 = (c[x].to_pylist() for x in ("a", "b", "a0", "b0"))
            rest = []
            for x, y in _chunks(a, b, a0, b0):
                same = same_rows((a[x:y], b[x:y]), (a0[x:y], b0[x:y]))
                rest += [None if s else canonical(p, q) for s, p, q in zip(same, a[x:y], b[x:y])]
            yield pa.RecordBatch.from_arrays([c["row_id"], c["keep_id"], c["k1"], c["k2"], pa.array(rest, pa.string())], names=["row_id", "keep_id", "k1", "k2", "rest"])

    return pairs.mapInArrow(run, "row_id bigint, keep_id bigint, k1 bigint, k2 bigint, rest string")


def copies(df: DataFrame, key: str = "row_id", a: str = "part_no", b: str = "description", bits: int = 64) -> DataFrame:
    """(keep_id, row_id): every copy and the smallest row id of its class."""
    twice = first_keys(df, a, b, bits).groupBy("k1").agg(F.count("*").alias("n")).where("n > 1").select("k1")
    gate = shared_gate(df.sparkSession, gate_of(cut_lineage(twice)))
    rows = cut_lineage(likely_copies(df, key, a, b, gate, bits))
    first = F.min_by(F.struct("a", "b"), "row_id")
    groups = rows.groupBy("k1", "k2").agg(F.min("row_id").alias("keep_id"), first.alias("f"), F.count("*").alias("n")).where("n > 1")
    groups = cut_lineage(groups.select("k1", "k2", "keep_id", F.col("f.a").alias("a0"), F.col("f.b").alias("b0")))
    pairs = join_hot(rows, groups, ["k1", "k2"], ["row_id"]).where(F.col("row_id") != F.col("keep_id"))
    checked = cut_lineage(_verified(pairs.select("row_id", "keep_id", "k1", "k2", "a", "b", "a0", "b0")))
    good = checked.where("rest is null").select("keep_id", "row_id")
    # Collisions: rare rows, grouped exactly. Copies of one text could be many, so aggregate, then join.
    odd = checked.where("rest is not null").select("row_id", "k1", "k2", "rest")
    heads = odd.groupBy("k1", "k2", "rest").agg(F.min("row_id").alias("keep_id"))
    again = odd.join(heads, ["k1", "k2", "rest"]).where(F.col("row_id") != F.col("keep_id")).select("keep_id", "row_id")
    return good.unionByName(again)


def copy_counts(df: DataFrame, key: str = "row_id", a: str = "part_no", b: str = "description") -> DataFrame:
    """(keep_id, copies): one record a class of two rows or more, with its number of rows."""
    return copies(df, key, a, b).groupBy("keep_id").agg((F.count("*") + 1).alias("copies"))


def collapsed(df: DataFrame, key: str = "row_id", a: str = "part_no", b: str = "description") -> DataFrame:
    """The rows that stand for their class, with `copies` (1 where there are no others; a column
    of that name is replaced)."""
    df = df.drop("copies")
    found = cut_lineage(copies(df, key, a, b))
    counts = found.groupBy(F.col("keep_id").alias(key)).agg((F.count("*") + 1).alias("copies"))
    kept = df.join(found.select(F.col("row_id").alias(key)), key, "left_anti")
    return kept.join(counts, key, "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
