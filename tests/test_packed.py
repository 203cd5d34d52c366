import random
import re

from partsloom.operators import packed as P


def brute(text):
    out, i = [], 0
    while i < len(text):
        m = re.compile(r"(?<![A-Za-z0-9])uoc:", re.I).match(text, i)
        if m:
            i = m.end()
            continue
        c = text[i]
        if c in P.QUOTES:
            body = r'((?:[^"]|"")*)"' if c == '"' else f"([^{P.QUOTES[c]}]*)[{P.QUOTES[c]}]"
            m = re.compile(re.escape(c) + body).match(text, i)
            if m:
                if m[1]:
                    out.append(m[1].replace('""', '"') if c == '"' else m[1])
                i = m.end()
                continue
        m = re.compile(r"(?:(?!(?<![A-Za-z0-9])(?i:uoc:))[A-Z0-9-])+").match(text, i)
        if m:
            if m[0].strip("-"):
                out.append(m[0].strip("-"))
            i = m.end()
            continue
        i += 1
    return out


def test_random_fields(spark):
    rng = random.Random(5)
    bits = ["AB", "L-17", "-", "--", " ", ", ", ";", "/", "and", "UOC:", "uoc: ", '"', '""', "'", "“", "”", "‘", "’", "X9", "after", "\n", "é", "A-", "-B", "„", "«", "»"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(9))) for _ in range(1500)] + [None, "", "A," * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id bigint, uoc string").selectExpr("*", "'x' AS skel", "1 AS rule")
    for bound in (P.BROADCAST_ROWS, 40, 0):  # broadcast, frequent ones broadcast, shuffled
        got = {}
        for r in P.explode_codes(df, least=1, max_broadcast=bound).orderBy("row_id", "pos").collect():
            got.setdefault(r.row_id, []).append((r.pos, r.code))
        for i, t in enumerate(texts):
            want = brute(t) if t else []
            assert got.get(i, []) == [(k + 1, c) for k, c in enumerate(want)], repr(t)


def test_fields_with_one_code_are_left_out(spark):
    df = spark.createDataFrame([(1, "AB"), (2, "AB AB"), (2, "AB AB"), (None, "A B")], "row_id bigint, uoc string")
    got = sorted(tuple(r) for r in P.explode_codes(df).where("row_id is not null").collect())
    assert got == [(2, 1, "AB"), (2, 1, "AB"), (2, 2, "AB"), (2, 2, "AB")]
    assert P.explode_codes(df.limit(0)).count() == 0
