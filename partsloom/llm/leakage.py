"""Problem 7: evaluation passages inside training text, found by pigeonhole edit matching.

A case is a stretch of at least `WORDS` words of a passage that stands in a text with at
most one error (a word changed, left out or added) in `PER` words. A passage is cut into
pieces of three words on a fixed grid. A stretch of n words holds at least (n-2)//3 whole
pieces and n//5 errors break at most as many of them, so for every n >= 20 at least two
pieces stand in the text unchanged: the error budget plus one, and one to spare. Texts are
searched for exact pieces; a text with fewer than two hits of an item is done with. For the
rest Myers' bit-parallel distance (over words) is run for those stretches of the passage that
hold enough hits on diagonals no further apart than the budget. Lengths that are no
multiple of 5 need no test of their own: without its last words such a stretch has the same
error budget. So the search is exact, not a heuristic.

The corpus is read once, whatever the number of items. Items measured to be few (`BLOCK` rows,
`BLOCK_BYTES` bytes) are broadcast with their piece index, and texts are searched where they
are. More items stay a table: a Bloom filter of bounded size tells which pieces of a text may be
an item's, the pieces that pass are joined with the piece table (hot pieces salted), texts
and items with two common pieces are brought together and verified. Both ways give the same
rows.

Defined results: null texts and passages match nothing; passages under 20 words match
nothing; layout (case, line breaks, white space, soft hyphens, zero-width characters, HTML
tags and entities, punctuation) is ignored; a pair of text and item gives one row a text row.
"""

from __future__ import annotations

import html
import re
import unicodedata

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from partsloom.llm.gates import Shared, gate_of, shared_gate
from partsloom.session import cut_lineage, join_hot, measured

WORDS, PER, PIECE = 20, 5, 3
#: Rows and bytes of items up to which their index is broadcast.
BLOCK, BLOCK_BYTES = 5_000, 16_000_000

#: A tag is anything short; beyond 80 characters only what can't be prose after a stray `<`: names of attributes and one
#: with a value, no white space at all, a closing tag, or a doctype. No part goes past the next `<`, so the search is linear.
_TAG = re.compile(
    r"<(?:[/!a-zA-Z][^<>]{0,80}"
    r"|[a-zA-Z][\w:-]*+(?:\s++[\w:@.-]++(?![\w:@.-]))*?\s++[\w:@.-]++\s*+=[^<>]*+"
    r"|/[a-zA-Z][^<>]*+"
    r"|/?[a-zA-Z][!-;=?-~]*+"
    r"|!(?:--|(?i:doctype)\b)[^<>]*+)>"
)
_BROKEN = re.compile(r"(?<=\w)-[ \t]*\r?\n[ \t]*(?=\w)")
_WORD = re.compile(r"[^\W_]+")
_ODD = re.compile(r"[^\x00-\x7f]")
_INVISIBLE = re.compile("[­͏؜᠎​-‏‪-‮⁠-⁤﻿]")


def words(text: str) -> list[str]:
    """The words of a text, whatever its layout."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if _ODD.search(text):
        text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
    if "\n" in text:
        text = _BROKEN.sub("", text)
    return _WORD.findall(text.casefold())


def myers(masks: dict[int, int], m: int, text: list[int], budget: int) -> bool:
    """Whether some substring of `text` is within `budget` edits of the pattern of `m` symbols."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up), up & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        if score <= budget:
            return True
        ph, mh = ph << 1, mh << 1
        up = (mh | ~(xv | ph)) & full
        down = ph & xv & full
    return False


class Index:
    """Pieces of a block of passages and what is needed to verify a hit."""

    def __init__(self, items: list[tuple]):
        self.vocabulary: dict[str, int] = {}
        self.ids, self.passages = [], []
        self.pieces: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for test_id, passage in items:
            w = [self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in words(passage or "")]
            if len(w) < WORDS:
                continue
            k = len(self.ids)
            self.ids.append(test_id)
            self.passages.append(w)
            for at in range(0, len(w) - PIECE + 1, PIECE):
                self.pieces.setdefault(tuple(w[at : at + PIECE]), []).append((k, at))

    def hits(self, text: list[int]) -> dict[int, list[tuple[int, int]]]:
        """Item -> (place in the text, place in the passage) of every exact piece."""
        out: dict[int, list[tuple[int, int]]] = {}
        get = self.pieces.get
        for i, piece in enumerate(zip(text, text[1:], text[2:])):
            if piece[0] and (found := get(piece)):
                for k, at in found:
                    out.setdefault(k, []).append((i, at))
        return out

    def stretches(self, k: int, n: int, hits: list[tuple[int, int]]) -> set[tuple[int, int, int]]:
        """(start in the passage, first and last text place) of stretches of n words to verify.

        In an alignment within the budget the diagonals of the unbroken pieces differ by at
        most the budget, and at least (n-2)//3 - n//5 pieces of the stretch are unbroken.
        """
        budget, passage = n // PER, self.passages[k]
        need = (n - PIECE + 1) // PIECE - budget
        out = set()
        lines = sorted({(i - at, at) for i, at in hits})
        high = 0
        for low, (d, _) in enumerate(lines):
            if low and lines[low - 1][0] == d:
                continue
            high = max(high, low)
            while high < len(lines) and lines[high][0] <= d + budget:
                high += 1
            near = sorted({at for _, at in lines[low:high]})
            for x in range(len(near) - need + 1):
                a, b = near[x], near[x + need - 1]
                for start in range(max(0, b + PIECE - n), min(a, len(passage) - n) + 1):
                    out.add((start, max(0, start + d - budget), max(0, start + d + n + 2 * budget)))
        return out

    def verify(self, text: list[int], k: int, hits: list[tuple[int, int]]) -> bool:
        passage = self.passages[k]
        for n in range(WORDS, len(passage) + 1, PER):
            for start, low, high in self.stretches(k, n, hits):
                masks: dict[int, int] = {}
                for j, c in enumerate(passage[start : start + n]):
                    masks[c] = masks.get(c, 0) | 1 << j
                if myers(masks, n, text[low:high], n // PER):
                    return True
        return False

    def search(self, text: str) -> list:
        get = self.vocabulary.get
        w = [get(x, 0) for x in words(text)]
        if len(w) < WORDS - WORDS // PER:
            return []
        return [self.ids[k] for k, h in self.hits(w).items() if len({at for _, at in h}) > 1 and self.verify(w, k, h)]


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "test_id", passage: str = "passage", block: int = BLOCK) -> DataFrame:
    """(key, item_key): texts and the items whose passages they give away."""
    src = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    wanted = cut_lineage(items.select(F.col(item_key).alias("i"), F.col(passage).alias("p")).where(F.col("p").isNotNull()).dropDuplicates())
    rows, size = measured(wanted)
    found = _searched(src, wanted) if rows <= block and size <= BLOCK_BYTES else _joined(src, wanted)
    return found.select(F.col("k").alias(key), F.col("i").alias(item_key))


def _searched(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k, i) by an index of all items, which are few."""
    shared = Shared(src.sparkSession, [tuple(r) for r in wanted.collect()], Index)
    kind = to_arrow_type(wanted.schema["i"].dataType)

    def run(batches):
        import pyarrow as pa

        index = shared.get()
        for batch in batches:
            rows, found = [], []
            for n, t in enumerate(batch.column(1).to_pylist()):
                for i in index.search(t):
                    rows.append(n)
                    found.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, kind)], names=["k", "i"])

    return src.mapInArrow(run, _schema(src, wanted))


def _schema(src: DataFrame, wanted: DataFrame) -> StructType:
    return StructType([StructField("k", src.schema["k"].dataType), StructField("i", wanted.schema["i"].dataType)])


def _code(piece) -> int:
    """A signed 64-bit code of a piece of words."""
    return xxhash.xxh64_intdigest(" ".join(piece)) - (1 << 63)


def _grid(found: list[str]):
    return {tuple(found[at : at + PIECE]) for at in range(0, len(found) - PIECE + 1, PIECE)}


def _joined(src: DataFrame, wanted: DataFrame) -> DataFrame:
    """(k, i) for any number of items, by joins of pieces."""
    from pyspark import TaskContext

    wanted = cut_lineage(wanted.withColumn("item", F.monotonically_increasing_id()))

    def pieces_of_items(batches):
        import pyarrow as pa

        for batch in batches:
            owners, codes = [], []
            for item, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(p)
                if len(found) >= WORDS:
                    grid = [_code(x) for x in _grid(found)]
                    codes += grid
                    owners += [item] * len(grid)
            yield pa.RecordBatch.from_arrays([pa.array(owners, pa.int64()), pa.array(codes, pa.int64())], names=["item", "piece"])

    pieces = cut_lineage(wanted.select("item", "p").mapInArrow(pieces_of_items, "item bigint, piece bigint"))
    gate = shared_gate(src.sparkSession, gate_of(pieces.select("piece").distinct()))
    kind = src.schema["k"].dataType.simpleString()

    def pieces_of_texts(batches):
        import numpy as np
        import pyarrow as pa

        asked, row = gate.get(), TaskContext.get().partitionId() << 40
        for batch in batches:
            places, hits = [], []
            for n, t in enumerate(batch.column(1).to_pylist()):
                found = words(t)
                if len(found) < WORDS - WORDS // PER:
                    continue
                codes = np.array(list({_code(x) for x in zip(found, found[1:], found[2:])}), dtype=np.int64)
                codes = codes[asked.holds(codes.view(np.uint64))]
                if len(codes) > 1:
                    places.append(n)
                    hits.append(codes.tolist())
            at = pa.array(places, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([row + n for n in places], pa.int64()), batch.column(0).take(at), batch.column(1).take(at), pa.array(hits, pa.list_(pa.int64()))], names=["rid", "k", "t", "pieces"])
            row += batch.num_rows

    texts = cut_lineage(src.mapInArrow(pieces_of_texts, f"rid bigint, k {kind}, t string, pieces array<bigint>"))
    hits = cut_lineage(texts.select("rid", F.explode("pieces").alias("piece")))
    both = join_hot(hits, pieces, ["piece"], ["rid"]).groupBy("rid", "item").agg(F.count("*").alias("n")).where("n > 1").select("rid", "item")
    pairs = both.join(texts.select("rid", "k", "t"), "rid")
    # An item may be in a third of all texts, a text may hold many items: texts come by their own row, items salted.
    pairs = join_hot(cut_lineage(pairs), wanted, ["item"], ["rid"])

    def verify(batches):
        import pyarrow as pa

        for batch in batches:
            ok = [bool(Index([(0, p)]).search(t)) for t, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["k", "i"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("k", "i", "t", "p").mapInArrow(verify, _schema(src, wanted))


def leaked_items(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """(item_key, n_docs): in how many texts each leaked item stands."""
    item_key = names.get("item_key", "test_id")
    return leaks(docs, items, **names).groupBy(item_key).agg(F.countDistinct(names.get("key", "doc_id")).alias("n_docs"))
