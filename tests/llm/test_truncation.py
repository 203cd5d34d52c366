from partsloom.llm import truncation as T

SCHEMA = "row_id bigint, source string, description string, s string, phrase string, v string"
WORDS = ["STAINLESS STEEL", "HEX HEAD", "ZINC PLATED", "SUPPLIED WITHOUT FASTENERS", "M8 X 45", "12 X 30 MM", "NO. 8-32", "1/4 IN", '1/2"', "LEFT HAND", "STYLE MÉRIDOR"]


def corpus():
    rows = []
    for i in range(3000):
        a, b, c = WORDS[i % 11], WORDS[(i // 11 + i) % 11], WORDS[(i // 121 + 5 + i) % 11]
        end = f" (USE WITH ITEM {i % 60 + 10})" if i % 4 == 0 else ". Discard after every removal." if i % 4 == 1 else ""
        rows.append(f"BOLT, {a}, {b}, {c}{end}")
    return rows


COMPLETE = ["BOLT", "Bolt,hex head", "BOLT, M8 X 45", 'BOLT, 1/2"', "BOLT , HEX_HEAD . .", "BOLT, ZINC PLATED.........", "bolt ; left-hand  ", "BOLT, NO. 8-32", "(BOLT), HEXHEAD", "BOLT, HEX HEAD. Discard after every removal", "Z-1234"]
CUT = ["BOLT, STAINLESS STE", "BOLT, STAINLESS", "BOLT, SUPPLIED WITHOUT", "BOLT, 77 X 3", "BOLT, 12 X 30", "BOLT, NO. 8-", "BOLT, 1/4", "BOLT, HEX HEAD (USE WITH ITE", "BOLT, HEX HEAD (USE WITH ITEM 1", "BOLT,", "BOLT (", "BOLT, HEX HEAD. Discard after ev", "BOLT, LEFT HA…", "BOLT, STYLE MÉ", "BOLT, HEX HE�"]
NOTHING = [None, "", "   ", "...", "-"]


def test_cut_and_complete_values(spark):
    every = corpus() + COMPLETE + CUT + CUT[:2] + NOTHING
    rows = [(i, None if i % 2 else "s", d, "x", "y", "z") for i, d in enumerate(every)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = T.truncated(df)
    assert out.columns == df.columns
    got = sorted(r.description for r in out.collect())
    assert got == sorted(CUT + CUT[:2])
    rates = {r.source: (r.n_rows, r.n_cut) for r in T.truncation_rates(df).collect()}
    assert sum(c for _, c in rates.values()) == len(CUT) + 2
    assert sum(n for n, _ in rates.values()) == sum(d is not None for d in every)


def test_long_values(spark):
    long = "A" * 200 + "B" * 50_000
    rows = [(i, "s", "X, " + long + ", Y", "", "", "") for i in range(60)] + [(99, "s", "X, " + long[:40_000], "", "", ""), (100, "s", "X, " + "A" * 30, "", "", "")]
    got = {r.row_id for r in T.truncated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {99, 100}


def test_frequent_cut_values(spark):
    """Copies of a row don't hide that it was cut."""
    cut = ["PIN, STAINLESS STE"] * 300 + ["PIN, STAINLESS"] * 300 + [f"{w}, STYLE MÉRI" for w in WORDS for _ in range(90)]
    every = corpus() + ["BOLT, LEFT HAND"] * 300 + cut
    df = spark.createDataFrame([(i, "s" if d in cut else "t", d, "", "", "") for i, d in enumerate(every)], SCHEMA)
    assert sorted(r.description for r in T.truncated(df).collect()) == sorted(cut)
    assert {r.source: r.n_cut for r in T.truncation_rates(df).collect()} == {"s": len(cut), "t": 0}


def test_whole_words_that_begin_others(spark):
    """A phrase seen where values go on is complete, though other words begin with it."""
    every = [f"{a}, {b}, {c}" for a in ("CAP", "BOLT", "SEAL ASSY") for b in ("CAPTIVE", "LEFT HAND", "ZINC PLATED") for c in WORDS]
    every += ["CAP", "BOLT", "BOLT, WITH SEALS"] + [f"BOLT, {w}, WITH SEAL" for w in WORDS]
    df = spark.createDataFrame([(i, "s", d, "", "", "") for i, d in enumerate(every)], SCHEMA)
    assert T.truncated(df).count() == 0


def test_cut_values_of_a_rare_vocabulary(spark):
    """One longer copy is enough where a phrase ends inside a word; the size of the corpus changes nothing."""
    rare = ["YOKE, INSULATED, LEFT HAND", "CLEVIS, HYDRAULIC, 12 X 30 MM", "BEARING ASSY, M3 X 50, CADMIUM PLATED", "Relay. Lubricate the threads before fitting."]
    cut = ["YOKE; INSULA", "CLEVIS, HYD", "BEARING ASSY, CADMI", "BEARING ASSY, CADMIUM PLA", "Relay. Lubricate the thre"]
    for more in ([], corpus()):
        df = spark.createDataFrame([(i, "s", d, "", "", "") for i, d in enumerate(rare + cut + more)], SCHEMA)
        assert sorted(r.description for r in T.truncated(df).collect()) == sorted(cut)


def test_common_cuts_at_a_field_limit(spark, monkeypatch):
    """A source's field limit explains cuts at a word boundary, however common they are."""
    names = ["BOLT " + "ABCDEFGHIJKLMNOPQRST"[: i % 20 + 1] + str(i % 7) for i in range(140)]
    full = [f"{n}, {w}" for n in names for w in ("STAINLESS STEEL", "SUPPLIED WITHOUT FASTENERS")]
    cut = sorted({x[:22] for x in full if len(x) > 22 and x[21] != " " and x[20:22].strip(",")})
    whole = ["PIN, 12 MM LONG HEAD X1"[:22]] + ["NUT, STAINLESS STEEL"]
    rows = [(x, "t") for x in full] + [(x, "s") for x in cut] + [(x, "s") for x in whole]
    df = spark.createDataFrame([(i, s, d, "", "", "") for i, (d, s) in enumerate(rows)], SCHEMA)
    got = {r.description for r in T.truncated(df).collect()}
    at_boundary = {x for x in cut if x.endswith((" STAINLESS", " SUPPLIED", " WITHOUT"))}
    assert len(at_boundary) > 10 and at_boundary <= got and not got & set(full)
    monkeypatch.setattr(T, "SPIKE", 2)
    assert not at_boundary & {r.description for r in T.truncated(df).collect()}
    monkeypatch.undo()
    many = spark.createDataFrame([(i, "s", d, "", "", "") for i, d in enumerate([f"BOLT {i}, STAINLESS STEEL" for i in range(1000)] + [f"BOLT {i}, STAINLESS STE" for i in range(50)])], SCHEMA)
    assert T.truncated(many).count() == 50


def test_hot_phrase_beyond_the_broadcast(spark, monkeypatch):
    every = corpus() + COMPLETE + CUT * 3
    df = spark.createDataFrame([(i, "s", d, "", "", "") for i, d in enumerate(every)], SCHEMA)
    monkeypatch.setattr(T, "BROADCAST_ROWS", 1)
    assert sorted(r.description for r in T.truncated(df).collect()) == sorted(CUT * 3)


def test_empty_table(spark):
    assert T.truncated(spark.createDataFrame([], SCHEMA)).count() == 0
    assert T.truncation_rates(spark.createDataFrame([], SCHEMA)).count() == 0
