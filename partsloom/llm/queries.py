"""Queries of the training-data text operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from partsloom.llm import duplicates, encoding, leakage, pii, truncation
from partsloom.session import table


def _page_n(spark, d):
    return table(spark, d, "page_n")


def _documents(spark, d):
    return table(spark, d, "documents")


def p6_decoded(spark, d):
    return encoding.decode(encoding.encode(_documents(spark, d)))


QUERIES = {
    "p3_found": lambda s, d: truncation.truncated(_page_n(s, d).select("row_id", "source", "description")).select("row_id"),
    "p3_rates": lambda s, d: truncation.truncation_rates(_page_n(s, d)),
    "p4_found": lambda s, d: duplicates.copies(_page_n(s, d)),
    "p4_counts": lambda s, d: duplicates.copy_counts(_page_n(s, d)),
    "p4_collapsed": lambda s, d: duplicates.collapsed(_page_n(s, d)).select("row_id", "part_no", "description", "copies"),
    "p6_ids": lambda s, d: encoding.encode(_documents(s, d)),
    "p6_decoded": p6_decoded,
    "p7_found": lambda s, d: leakage.leaks(_documents(s, d), table(s, d, "eval_items")),
    "p7_items": lambda s, d: leakage.leaked_items(_documents(s, d), table(s, d, "eval_items")),
    "p8_found": lambda s, d: pii.personal_spans(_documents(s, d)),
    "p8_redacted": lambda s, d: pii.redacted(_documents(s, d)),
    "p8_counts": lambda s, d: pii.personal_spans(_documents(s, d)).groupBy("pii_type").agg(F.count("*").alias("n")),
}

_KEYS = r"""
    WITH c AS (SELECT row_id, part_no, description,
        [list_sort(list_filter(list_transform(regexp_split_to_array(x, '[,;]'),
            lambda p: regexp_replace(lower(p), '[^\p{L}\p{N}]', '', 'g')), lambda p: p <> '')) FOR x IN [part_no, description]] AS sides
      FROM page_n WHERE part_no IS NOT NULL AND description IS NOT NULL),
    k AS (SELECT row_id, part_no, description, list_sort(list_transform(sides, lambda s: list_aggregate(s, 'string_agg', chr(1)))) AS key
      FROM c WHERE len(sides[1]) > 0 AND len(sides[2]) > 0),
    g AS (SELECT row_id, part_no, description, min(row_id) OVER (PARTITION BY key) AS keep_id, count(*) OVER (PARTITION BY key) AS n FROM k)
"""

ORACLE = {
    "p4_found": _KEYS + "SELECT keep_id, row_id FROM g WHERE row_id <> keep_id",
    "p4_counts": _KEYS + "SELECT keep_id, n AS copies FROM g WHERE row_id = keep_id AND n > 1",
    "p4_collapsed": _KEYS
    + """SELECT p.row_id, p.part_no, p.description, coalesce(g.n, 1) AS copies FROM page_n p LEFT JOIN g USING (row_id)
         WHERE g.row_id IS NULL OR g.row_id = g.keep_id""",
    "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
}
