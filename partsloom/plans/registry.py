"""All queries of the core and their SQL."""

from __future__ import annotations

from partsloom.plans import problems, reference

QUERIES = {**reference.QUERIES, **problems.QUERIES}
ORACLE = {**reference.ORACLE, **problems.ORACLE}
