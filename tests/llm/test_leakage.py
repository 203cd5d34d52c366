import random

from partsloom.llm import leakage as L

VOCABULARY = [f"w{i}" for i in range(40)]


def distance(pattern, text):
    """Least edits between the pattern and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i] + [0] * len(text)
        for j, x in enumerate(text, 1):
            new[j] = min(row[j - 1] + (c != x), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def brute(passage, text):
    p, t = L.words(passage), L.words(text)
    return any(distance(p[s : s + n], t) <= n // L.PER for n in range(L.WORDS, len(p) + 1) for s in range(len(p) - n + 1))


def spoiled(rng, words, errors):
    out = list(words)
    for _ in range(errors):
        i = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[i] = "zz"
        elif kind == 1 and len(out) > 1:
            del out[i]
        else:
            out.insert(i, "yy")
    return out


def test_search_is_exact():
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice(VOCABULARY) for _ in range(rng.choice([19, 20, 24, 33, 45])))) for k in range(25)]
    index, hits = L.Index(items), 0
    for _ in range(400):
        k = rng.randrange(25)
        p = items[k][1].split()
        n = min(len(p), rng.choice([8, 18, 20, 22, 27, 40]))
        s = rng.randrange(len(p) - n + 1)
        body = spoiled(rng, p[s : s + n], rng.choice([0, 2, 4, 5, 6, 8]))
        text = " ".join([rng.choice(VOCABULARY) for _ in range(6)] + body + [rng.choice(VOCABULARY) for _ in range(6)])
        want = {i for i, q in items if brute(q, text)}
        hits += len(want)
        assert set(index.search(text)) == want
    assert hits > 100


def test_tags_of_any_length():
    passage = [f"w{i}" for i in range(24)]
    index = L.Index([(1, " ".join(passage))])
    url = "https://example.org/" + "/".join(f"part{i}" for i in range(40))
    style = "; ".join(f"margin-{i}: {i}px" for i in range(40))
    for tag in (f'<a href="{url}">', f'<input disabled title="a &quot;b&quot;" style="{style}">', f"<{url}>", f"<span\n class=x style = '{style}'>", f'<!DOCTYPE html PUBLIC "{url}">'):
        assert L.words("a " + tag + " b") == ["a", "b"]
        assert set(index.search(" ".join(passage[:12]) + tag + " ".join(passage[12:]))) == {1}
    prose = " ".join(passage)
    assert set(index.search(f"if a <b then {prose}\n> so")) == {1}
    assert len(L.words("<a href=" * 100_000 + "<a b c " * 100_000)) == 500_000


def test_layout_does_not_matter():
    passage = "Die müden Boten verließen die alten Gärten, weil ein schmaler Weg ohne ein Wort über die hellen Felder bis zum Ufer der fernen Quelle führte."
    index = L.Index([(1, passage)])
    shapes = [
        passage.upper(),
        passage.replace(" ", "\n> "),
        passage.replace(" ", "\xa0"),
        passage.replace("e", "e​"),
        passage.replace("schmaler", "schma-\nler"),
        "<p>" + passage.replace(" ", "<br/>") + "</p>",
        passage.replace(",", "&#44;"),
        passage.replace("ü", "ü"),
    ]
    for text in shapes:
        assert index.search(text) == [1], text
    assert index.search(" ".join(passage.split()[:9])) == []


def test_frame(spark):
    rng = random.Random(6)
    passages = [" ".join(rng.choice(VOCABULARY) for _ in range(30)) for _ in range(7)]
    items = spark.createDataFrame([(i, p, "x") for i, p in enumerate(passages)] + [(99, None, "x"), (98, "short one", "x"), (0, passages[0], "x")], "test_id int, passage string, text string")
    docs = spark.createDataFrame([(1, passages[0] + " " + passages[3], 0), (2, None, 0), (3, "", 0), (None, passages[1], 0), (4, "x " * 100_000, 0), (5, passages[0], 0)], "doc_id bigint, text string, test_id int")
    want = {(1, 0), (1, 3), (None, 1), (5, 0)}
    for block in (L.BLOCK, 2):
        assert {tuple(r) for r in L.leaks(docs, items, block=block).collect()} == want
    assert {tuple(r) for r in L.leaked_items(docs, items).collect()} == {(0, 2), (3, 1), (1, 0)}
    assert L.leaks(docs.limit(0), items).count() == 0
    assert L.leaks(docs, items.limit(0)).count() == 0


def test_many_items_are_joined_to_the_same_rows(spark):
    """Beyond the broadcast bound the joins find what the index finds, hot items and pieces included."""
    rng = random.Random(9)
    passages = [" ".join(["w0 w1 w2"] + [rng.choice(VOCABULARY) for _ in range(rng.choice([15, 18, 27]))]) for _ in range(40)]
    texts = []
    for n in range(300):
        p = passages[0 if n % 3 == 0 else rng.randrange(40)].split()
        body = spoiled(rng, p[rng.randrange(3) :], rng.choice([0, 3, 4, 6]))
        texts.append((n, " ".join(["w0 w1 w2 x"] + body + [rng.choice(VOCABULARY) for _ in range(9)])))
    items = spark.createDataFrame(list(enumerate(passages)), "test_id int, passage string")
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    near, far = ({tuple(r) for r in L.leaks(docs, items, block=b).collect()} for b in (L.BLOCK, 3))
    assert near == far and len(near) > 60


def test_repeats_stay_cheap():
    passage = " ".join(VOCABULARY)
    index = L.Index([(1, passage)])
    text = "w0 w1 w2 x x x w6 w7 w8 " * 20_000
    assert index.search(text) == []
