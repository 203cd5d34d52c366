import os
import random

import pytest

from partsloom.operators import malformed as M

DATA = "/root/testdata/sf0.01"
SCHEMA = "line_id bigint, line string, reason string, source string"


def test_strict_rules():
    cases = {
        "1\tP\tD\tU\t2": None,
        "1\t\"P\"\t\"D \"\"x\"\"\ty\"\tU\tAR": None,
        "\tP\tD\tU\t": None,
        " 12A \tP\tD\tU\t 4 ": None,
        '1\tP 1/2"\tD\tU\t2': None,
        '1\tP\t"D\tU\t2': "quoting",
        '1\tP\t"D"x\tU\t2': "quoting",
        '1\tP\tD\tU\t"': "quoting",
        "1\tP\tD\tU": "columns",
        "1\tP\tD\tU\t2\t": "columns",
        "": "columns",
        "12345\tP\tD\tU\t2": "value",
        "1a\tP\tD\tU\t2": "value",
        "\t\tD\tU\t2": "value",
        "1\tP\tD\tU\tar": "value",
        "٣\tP\tD\tU\t1": "value",
    }
    for line, why in cases.items():
        assert M.diagnose(line)[0] == why, line
    assert M.diagnose(None)[0] == "columns"


def test_blocks_agree_with_the_strict_parser(spark):
    rng = random.Random(3)
    parts = ["1", "12A", "", " 7 ", "x", "AR", '"q"', '"a\tb"', '"a', '"a"b', 'a"b', '""', "é", "\t", "a\rb", "a\nb", "٣", '"1"']
    lines = ["\t".join(rng.choice(parts) for _ in range(rng.choice([5, 5, 5, 5, 4, 6, 1]))) for _ in range(3000)]
    lines += [None, "", "x" * 300_000, "1\tP\t" + "y" * 300_000 + "\t\t2"]
    rows = [(i, x, "clash", None) for i, x in enumerate(lines)]
    for block in (M.BLOCK, 64, 1):
        out = M.split_lines_by_fault(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block).collect()
        assert len(out) == len(rows)
        for r in out:
            why, fields = M.diagnose(lines[r.line_id])
            assert r.reason == why
            assert [r[f] for f in M.FIELDS] == (fields or [None] * 5)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_strict_parser_sees_few_good_lines():
    import pyarrow as pa
    import pyarrow.parquet as pq

    lines = pq.read_table(f"{DATA}/page_lines.parquet", columns=["line"])["line"].combine_chunks().cast(pa.string())
    reasons, _, strict = M.split_block(lines)
    bad = len(lines) - reasons.null_count
    assert 0 < bad <= strict <= 2 * bad and strict < len(lines) / 4


def test_bisection_isolates_a_broken_line():
    import pyarrow as pa

    good = ["1\tP\tD\tU\t2"] * 1000
    for odd in ("1\tP\tD\nx\tU\t2", "1\tP\tD\tU\t2\n", "\r1\tP\tD\tU\t2", '1\tP\t"a\nb"\tU\t2'):
        lines = good[:333] + [odd] + good + [odd]
        reasons, columns, strict = M.split_block(pa.array(lines, pa.string()))
        assert strict <= 2
        assert reasons.to_pylist() == [M.diagnose(x)[0] for x in lines]
        assert list(zip(*[c.to_pylist() for c in columns])) == [tuple(M.diagnose(x)[1] or (None,) * 5) for x in lines]


def test_empty_table_and_rates(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert M.rejects(df).count() == 0
    df = spark.createDataFrame([(1, "1\tP\tD\tU\t2", None, None), (1, "bad", None, None), (None, "bad", None, "s")], SCHEMA)
    assert {tuple(r) for r in M.fault_rates(df).collect()} == {(None, "ok", 1), (None, "columns", 1), ("s", "columns", 1)}
