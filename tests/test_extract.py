import sys
from types import SimpleNamespace

import pytest

from partsloom.config import Config
from partsloom.operators import extract as X


def test_retry_only_on_rate_limits():
    cfg, waits = Config(delay_seconds=0.3), []
    replies = iter([RuntimeError("429"), RuntimeError("Rate limit"), "ok"])

    def call(_):
        r = next(replies)
        if isinstance(r, Exception):
            raise r
        return r

    assert X.call_with_retry(call, b"", cfg, waits.append) == ("ok", "succeeded", None, 3)
    assert waits == [0.3, 0.6]

    def broken(_):
        raise RuntimeError("bad image")

    assert X.call_with_retry(broken, b"", cfg, waits.append) == (None, "failed", "bad image", 1)

    def limited(_):
        raise RuntimeError("429")

    waits.clear()
    assert X.call_with_retry(limited, b"", cfg, waits.append)[3] == 4
    assert waits == pytest.approx([0.3, 0.6, 1.2])


def test_stub_batch_and_pending(spark):
    images = spark.createDataFrame([("d", 1, bytearray(b"1\tP\tD\tUOC: A\t2")), ("d", 2, bytearray(b"prose"))], "pdf_id string, page_number int, png binary")
    out = {r.page_number: r for r in X.sanitized(X.extract(images, Config(delay_seconds=0), calls=2)).collect()}
    assert out[1].tsv.split("\n")[1] == "1\tP\tD\tA\t2" and out[1].status == "succeeded"
    assert "\n" not in out[2].tsv
    work = spark.createDataFrame([("a",), ("b",)], "out_path string")
    assert [r[0] for r in X.pending(work, work.where("out_path = 'a'")).collect()] == ["b"]
    assert X.pending(work, work, skip_existing=False).count() == 2


def test_config():
    cfg = Config.of({"provider": "stub", "anthropic": {"model": "m"}, "pipeline": {"datasets": ["data-1"], "max_retries": 1}})
    assert cfg.datasets == ("data-1",) and cfg.max_retries == 1 and cfg.providers == {"anthropic": {"model": "m"}}
    assert Config.of({"pipeline": {"datasets": "*"}}).datasets is None
    with pytest.raises(ValueError):
        Config.of({"pipeline": {"datasets": "data-1"}})
    with pytest.raises(ValueError):
        Config.of({"pipeline": {"unheard_of": 1}})
    with pytest.raises(X.UnknownProvider):
        X.build_extractor(Config(provider="nobody"))


def test_rate_limit_test_is_the_same_over_columns(spark):
    messages = ["HTTP 429", "Rate limit", "too accurate", "bad image", ""]
    df = spark.createDataFrame([(m,) for m in messages], "m string")
    assert [r[0] for r in df.select(X.rate_limited_column(df.m)).collect()] == [X.rate_limited(m) for m in messages]


class Sink:
    """Stands in for a vendor's client: remembers how it was made and called."""

    def __init__(self, reply, **made):
        self.made, self.called, self.reply = made, [], reply
        self.messages = self.chat = self.completions = self

    def create(self, **asked):
        self.called.append(asked)
        return self.reply


def test_messages_requests(monkeypatch):
    made = []
    reply = SimpleNamespace(content=[SimpleNamespace(text="tsv"), SimpleNamespace(text="more")])
    monkeypatch.setitem(sys.modules, "anthropic", SimpleNamespace(Anthropic=lambda **k: made.append(Sink(reply, **k)) or made[-1]))
    call = X.build_extractor(Config(provider="anthropic", providers={"anthropic": {"model": "m", "max_tokens": 77}}))
    assert call(b"\x89PNG") == "tsv" and made[0].made == {}
    asked = made[0].called[0]
    assert (asked["model"], asked["max_tokens"]) == ("m", 77)
    assert asked["system"][0]["cache_control"] == {"type": "ephemeral"} and "UOC:" in asked["system"][0]["text"]
    image, text = asked["messages"][0]["content"]
    assert image["source"] == {"type": "base64", "media_type": "image/png", "data": "iVBORw=="} and text["type"] == "text"
    monkeypatch.setenv("SOME_KEY", "k")
    options = {"api_key_env": "SOME_KEY", "endpoint": "https://e/x", "deployment": "d"}
    call = X.build_extractor(Config(provider="claude_azure", providers={"claude_azure": options}))
    assert call(b"x") == "tsv" and made[1].made == {"api_key": "k", "base_url": "https://e/x"} and made[1].called[0]["model"] == "d"
    monkeypatch.delenv("SOME_KEY")
    with pytest.raises(RuntimeError, match="SOME_KEY"):
        X.build_extractor(Config(provider="claude_azure", providers={"claude_azure": options}))


def test_chat_requests(monkeypatch):
    made = []
    reply = SimpleNamespace(choices=[SimpleNamespace(message=SimpleNamespace(content="tsv"))])
    monkeypatch.setitem(sys.modules, "openai", SimpleNamespace(OpenAI=lambda **k: made.append(Sink(reply, **k)) or made[-1]))
    monkeypatch.setenv("SOME_KEY", "k")
    options = {"api_key_env": "SOME_KEY", "endpoint": "https://e/v1", "deployment": "d"}
    assert X.build_extractor(Config(provider="azure_openai", providers={"azure_openai": options}))(b"\x89PNG") == "tsv"
    asked = made[0].called[0]
    assert made[0].made == {"api_key": "k", "base_url": "https://e/v1"} and (asked["model"], asked["max_tokens"]) == ("d", 8192)
    assert asked["messages"][0]["role"] == "system"
    assert asked["messages"][1]["content"][0]["image_url"] == {"url": "data:image/png;base64,iVBORw==", "detail": "high"}


def test_run_keeps_raw_answers_and_names_failures(spark, tmp_path):
    images = spark.createDataFrame([("d", 1, bytearray(b"1\tP\tD\tA\t2")), ("d", 2, bytearray(b"")), ("d", 3, bytearray(b"x"))], "pdf_id string, page_number int, png binary")
    done = spark.createDataFrame([("d", 3), ("d", 3)], "pdf_id string, page_number int")
    got = {r.page_number: r for r in X.extraction_run(images, Config(delay_seconds=0), str(tmp_path / "raw"), done).collect()}
    assert {p: r.status for p, r in got.items()} == {1: "succeeded", 2: "failed", 3: "skipped"}
    assert got[2].error == "empty image" and got[2].tsv is None and got[1].tsv.endswith("1\tP\tD\tA\t2")
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2


def test_layouts():
    assert Config(results_dir="/r").layout() == ("beside", "/r")
    assert Config(results_dir="/r", output_subdir="", output_dir="/o").layout() == ("apart", "/o")
    assert Config(results_dir="/r").layout("/x") == ("apart", "/x")
