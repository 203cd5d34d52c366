import pytest
from pyspark.sql import functions as F

from partsloom.functions import text as X
from partsloom.schemas import HEADER


def run(spark, values, col, extra=None):
    df = spark.createDataFrame([(i, v, extra) for i, v in enumerate(values)], "i int, v string, e string")
    return [r[1] for r in df.select("i", col(F.col("v")).alias("o")).orderBy("i").collect()]


def test_captions(spark):
    texts = ["Figure 3. Turbine", "Figure3. X", "FIG 4 x", "fig.5. y", "Figure 3 shows", "Figure 3", "Figure 3-2. Z", "Figure 3.2 q", "Figures 3. a", "Figure 3: x", "Fig 1\xa0 S", None, ""]
    assert run(spark, texts, lambda c: X.caption_number(c, "strict")) == [3, None, None, None, 3, None, None, 3, None, None, None, None, None]
    assert run(spark, texts, X.caption_number) == [3, 3, 4, 5, 3, None, None, 3, None, None, 1, None, None]


def test_strip_and_lines_agree_with_python(spark):
    texts = [" a ", "\x1c\xa0a　", "a\r\nb\n", "a\x0bb\x85c d", "", "\n", "a\n\n", "x\x1fy"]
    assert run(spark, texts, X.strip) == [t.strip() for t in texts]
    assert run(spark, texts, X.split_lines) == [t.splitlines() for t in texts]


SANITIZED = [
    ("", []),
    ("No parts list here", []),
    ("```", []),
    ("```\n```", []),
    ("```tsv\n1\tP1\tBOLT\tUOC: AB\t2\n```", ["1\tP1\tBOLT\tAB\t2"]),
    (HEADER + "\n\t\torphan\t\t1\n2\t\tNUT\t\t4", ["2\t\tNUT\t\t4"]),
    ("1\t1O2\t1OO2\t\t", ["1\t102\t1OO2"]),  # the outer trim takes the last tabs
    ("prose\n" + HEADER + "\nmore prose\n1\tP\r\n2\tQ\n", ["1\tP", "2\tQ"]),
    ("Item\tPart\n1\tP", ["Item\tPart", "1\tP"]),  # another header is data
    (HEADER + "\n" + HEADER, [HEADER]),
    ("a\tb\tc\t uoc:\xa0D \te\tf\x0b3\tP\tD\tE", ["a\tb\tc\tD\te\tf", "3\tP\tD\tE"]),
    ("x\ty\n \t \tz", ["x\ty"]),
    ("\t\tfirst line loses its tabs\n1\tP", ["1\tP"]),
    ("```\n```\n1\tP\n```\n```", ["1\tP"]),  # one fence a side; the others hold no tab
]


def test_sanitizer(spark):
    got = run(spark, [raw for raw, _ in SANITIZED], X.sanitize)
    assert got == ["\n".join([HEADER, *rows]) for _, rows in SANITIZED]


def test_sanitized_text_stays_as_it_is(spark):
    import random

    rng = random.Random(2)
    bits = ["```tsv\n", HEADER + "\n", "1\tP\tD\tUOC: A\t2\n", "\t\torphan\t\t1\n", "prose\n", "1O2\t1OO2\n", "2\tQ\tN\t uoc:B\t4\r\n", "\n", "\x0b", "a\tb\tc\td\te\tf\n"]
    raw = ["".join(rng.choice(bits) for _ in range(rng.randrange(8))) + "z\tz" for _ in range(300)]
    once = run(spark, raw, X.sanitize)
    assert run(spark, once, X.sanitize) == once
    assert all(t.startswith(HEADER + "\n") and all("\t" in x for x in t.split("\n")) for t in once)


def test_relativize(spark):
    paths = ["/a/data-1/figures/p.png", "C:\\d\\data-1\\f.png", "f.png", "data-1/f.png", "/q/data-1/x/data-1/y", None, ""]
    got = run(spark, paths, lambda c: X.relativize(c, F.col("e")), "data-1")
    assert got == ["data-1/figures/p.png", "data-1/f.png", "data-1/f.png", "data-1/f.png", "data-1/x/data-1/y", None, "data-1/"]


@pytest.mark.parametrize(
    ("fn", "given", "want"),
    [
        (X.null_if_na, ["", "NaN", "<NA>", "x", None, "nan "], [None, None, None, "x", None, "nan "]),
        (X.page_of_name, ["page_3.tsv", "a/page_03.tsv", "page_1_2.tsv", "page_x.tsv", "p.tsv"], [3, 3, None, None, None]),
        (X.strip_dot_leaders, ["P/N 1............417 010", "a..b", "....x", None], ["P/N 1 417 010", "a..b", "x", None]),
        (X.strip_bullets, ["..• x", "x."], ["x", "x."]),
        (X.canonical_header, ["Part No.", "part_no", "QTY", "?", None], ["part_no", "part_no", "quantity", None, None]),
        (X.part_number, ["PAHZZ", "1234-56-789-0123", "1A2B3", "417 010 008"], [None, None, None, "417 010 008"]),
        (X.uoc_of_cell, ["BOLT\nUOC: AB\nuoc:CD ", "BOLT"], ["AB CD", ""]),
        (X.is_sub_component, ["2) 208-14 NUT", "NUT 2) 208-14"], [True, False]),
        (X.fix_numeric_o, ["1O2", "1OO2", ".O5", "O1"], ["102", "1OO2", ".05", "O1"]),
    ],
)
def test_small_rules(spark, fn, given, want):
    assert run(spark, given, fn) == want


def test_base64_and_paths(spark):
    import base64

    texts = ["x" * 200, ""]
    assert run(spark, texts, lambda c: X.base64_text(F.encode(c, "UTF-8"))) == [base64.b64encode(t.encode()).decode() for t in texts]
    png = ["/r/data-1/tables/page_4.png"]
    assert run(spark, png, lambda c: X.output_path(c, "beside")) == ["/r/data-1/table_data/page_4.tsv"]
    assert run(spark, png, lambda c: X.output_path(c, "flat", "/o")) == ["/o/page_4.tsv"]
    assert run(spark, png, lambda c: X.output_path(c, "apart", "/o")) == ["/o/data-1/page_4.tsv"]
