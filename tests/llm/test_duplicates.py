import random
from collections import defaultdict

import numpy as np
import pytest

from partsloom.llm import duplicates as D

SCHEMA = "row_id bigint, part_no string, description string, copies string, k1 string, salt string"


def key(part, description):
    def column(t):
        out = []
        for p in t.replace(";", ",").split(","):
            p = "".join(c.lower() if len(c.lower()) == 1 else c for c in p if c.isalnum())
            if p:
                out.append(p)
        return tuple(sorted(out))

    if part is None or description is None:
        return None
    a, b = column(part), column(description)
    return tuple(sorted([a, b])) if a and b else None


def rows_of(rng, n):
    parts = ["QF-1 2", "qf12", "7/8", "É1"]
    pieces = ["BOLT", "bolt.", "Hex Head", "HEX-HEAD", "é x", "É_X", "1/2", "12", "ab", "a b", "", " ", "ß", "漢字"]
    out = []
    for i in range(n):
        d = rng.choice([", ", ";", ","]).join(rng.choice(pieces) for _ in range(rng.randrange(4)))
        p = rng.choice(parts)
        if rng.random() < 0.2:
            p, d = d, p
        out.append((i, rng.choice([p, p, p, p, p, None]), d, "c", "k", "s"))
    return out


def expected(rows):
    groups = defaultdict(set)
    for i, p, d, *_ in rows:
        if (k := key(p, d)) is not None:
            groups[k].add(i)
    return {(min(g), i) for g in groups.values() for i in g if i != min(g)}


@pytest.mark.parametrize("bits", [64, 4])  # 4: nearly every key collides
def test_against_brute_force(spark, bits):
    rows = rows_of(random.Random(bits), 700)
    got = D.copies(spark.createDataFrame(rows, SCHEMA).repartition(3), bits=bits).collect()
    assert len(got) == len(set(map(tuple, got)))
    assert {tuple(r) for r in got} == expected(rows)


def test_hot_group_and_counts(spark):
    rows = [(i, "P-1", "A, B" if i % 2 else "b;a", "c", "k", "s") for i in range(3000)] + [(i, f"P{i}", "x", "c", "k", "s") for i in range(3000, 3100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert D.copies(df).count() == 2999
    assert [tuple(r) for r in D.copy_counts(df).collect()] == [(0, 3000)]
    kept = D.collapsed(df)
    assert kept.count() == 101 and kept.where("row_id = 0").first().copies == 3000


def test_hash_reads_kept_characters_only():
    same = [("a b", "X,Y"), ("A-B", "y ;x"), ("X, y", "(ab)")]
    k1, k2, ok = D.row_keys([a for a, _ in same], [b for _, b in same])
    assert len(set(k1)) == 1 and len(set(k2)) == 1 and ok.all()
    different = [("ab", "xy"), ("ab", "x,y"), ("ab", "xyz"), ("ba", "x,y"), ("ab", "x,yy"), ("ab", "x,y,y")]
    assert len(set(zip(*D.row_keys([a for a, _ in different], [b for _, b in different])[:2]))) == len(different)
    assert not D.row_keys(["-"], ["x"])[2].any()
    a, b = zip(*same)
    assert D.same_rows((list(a), list(b)), ([a[0]] * 3, [b[0]] * 3)).all()
    assert not D.same_rows((["ab"], ["xy"]), (["ab"], ["x,y"])).any()
    assert np.array_equal(D.same_rows(([], []), ([], [])), [])


def test_long_and_empty(spark):
    long = "a, " * 60_000
    rows = [(1, "p", long + "b", "", "", ""), (2, "P", "B;" + long, "", "", ""), (3, "p", long + "c", "", "", "")]
    assert [tuple(r) for r in D.copies(spark.createDataFrame(rows, SCHEMA)).collect()] == [(1, 2)]
    assert D.copies(spark.createDataFrame([], SCHEMA)).count() == 0
