import base64
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from partsloom.llm import encoding as E

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def codec():
    return E.Codec(E.serialise_model(E.read_ranks(E.vocabulary_path())))


@pytest.fixture(scope="module")
def other():
    lines = open(E.vocabulary_path(), "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=E.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_same_ids_and_round_trip(codec, other, text):
    ids = codec.encode_batch([text])[0]
    assert ids == other.encode_ordinary(text)
    assert codec.decode(ids) == text


def test_odd_texts(codec, other):
    rng = random.Random(1)
    texts = ["<|endoftext|>", " " * 3000, "a" * 50_000, "\n\n \t", "▁ ⁇", "\x00\x01", "naïve café 漢字 😀👍🏽", "'s 'll don't", "1" * 999]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD7FF), rng.randrange(0xE000, 0x10FFFF), 32, 10])) for _ in range(40)) for _ in range(300)]
    for t, ids in zip(texts, codec.encode_batch(texts)):
        assert ids == other.encode_ordinary(t)
        assert codec.decode(ids) == t


def test_cache_changes_nothing(codec, monkeypatch):
    texts = [f"word{i} and more" for i in range(50)]
    want = codec.encode_batch(texts)
    monkeypatch.setattr(E, "CACHE", 0)
    assert codec.encode_batch(texts) == want


def test_frame(spark):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, "", "x"), (3, None, "x"), (None, "a", None), (1, "Hello world", "x")], "doc_id bigint, text string, ids string")
    rows = E.encode(df).collect()
    assert len(rows) == 5 and {r.doc_id: r.ids for r in rows}[2] == [] and {r.doc_id: r.ids for r in rows}[3] == []
    assert sorted(r.text for r in E.decode(E.encode(df)).collect()) == ["", "", "Hello world", "Hello world", "a"]
    assert E.encode(df.limit(0)).count() == 0
