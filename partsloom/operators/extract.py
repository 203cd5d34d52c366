"""Table text from page images behind a pluggable extractor.

Extractors are built once a partition and called an image at a time, with retries and
pacing. Their raw output is kept apart from the sanitised text, so that a change of the
sanitiser never calls a model again. External calls are not exactly-once under task retry:
write the raw output, then leave finished work out by `pending`.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partsloom.config import Config
from partsloom.functions.text import sanitize

Extractor = Callable[[bytes], str]


class UnknownProvider(ValueError):
    pass


def stub(_: Config) -> Extractor:
    """Deterministic stand-in: the image's bytes, read as text, are the answer; an image without bytes is an error."""

    def call(png: bytes) -> str:
        if not png:
            raise ValueError("empty image")
        return png.decode("utf-8", "replace")

    return call


def _key(variable: str) -> str:
    value = os.environ.get(variable, "")
    if not value:
        raise RuntimeError(f"environment variable {variable} is not set")
    return value


def _messages(cfg: Config, options: dict, model: str) -> Extractor:
    from base64 import standard_b64encode

    import anthropic

    own = {"api_key": _key(options["api_key_env"]), "base_url": options["endpoint"]} if "endpoint" in options else {}
    client = anthropic.Anthropic(**own)

    def call(png: bytes) -> str:
        image = {"type": "image", "source": {"type": "base64", "media_type": "image/png", "data": standard_b64encode(png).decode()}}
        reply = client.messages.create(
            model=model,
            max_tokens=int(options.get("max_tokens", 8192)),
            system=[{"type": "text", "text": cfg.system_prompt, "cache_control": {"type": "ephemeral"}}],
            messages=[{"role": "user", "content": [image, {"type": "text", "text": cfg.user_prompt}]}],
        )
        return reply.content[0].text

    return call


def messages_api(cfg: Config) -> Extractor:
    options = cfg.providers.get("anthropic", {})
    return _messages(cfg, options, options.get("model", "claude-sonnet-4-5"))


def messages_deployment(cfg: Config) -> Extractor:
    options = cfg.providers["claude_azure"]
    return _messages(cfg, options, options["deployment"])


def chat_deployment(cfg: Config) -> Extractor:
    from base64 import standard_b64encode

    from openai import OpenAI

    options = cfg.providers["azure_openai"]
    client = OpenAI(api_key=_key(options["api_key_env"]), base_url=options["endpoint"])

    def call(png: bytes) -> str:
        url = f"data:image/png;base64,{standard_b64encode(png).decode()}"
        reply = client.chat.completions.create(
            model=options["deployment"],
            max_tokens=int(options.get("max_tokens", 8192)),
            messages=[
                {"role": "system", "content": cfg.system_prompt},
                {"role": "user", "content": [{"type": "image_url", "image_url": {"url": url, "detail": "high"}}, {"type": "text", "text": cfg.user_prompt}]},
            ],
        )
        return reply.choices[0].message.content

    return call


#: Provider name -> factory; register others here.
PROVIDERS: dict[str, Callable[[Config], Extractor]] = {
    "stub": stub,
    "anthropic": messages_api,
    "claude_azure": messages_deployment,
    "azure_openai": chat_deployment,
}


def build_extractor(cfg: Config) -> Extractor:
    if cfg.provider not in PROVIDERS:
        raise UnknownProvider(f"unknown provider {cfg.provider!r}; choose one of {', '.join(PROVIDERS)}")
    return PROVIDERS[cfg.provider](cfg)


def rate_limited(message: str) -> bool:
    return "rate" in message.lower() or "429" in message


def rate_limited_column(message):
    """The same test over a column of error messages, for reports."""
    return F.lower(message).contains("rate") | message.contains("429")


def call_with_retry(extractor: Extractor, png: bytes, cfg: Config, sleep=time.sleep, is_rate_limit=rate_limited) -> tuple[str | None, str, str | None, int]:
    """(raw, status, error, attempts). Only rate limits are tried again, after a wait that grows."""
    wait = cfg.delay_seconds
    for attempt in range(1, cfg.max_retries + 2):
        try:
            return extractor(png), "succeeded", None, attempt
        except Exception as error:  # noqa: BLE001 - a failed page must not end the batch
            if attempt > cfg.max_retries or not is_rate_limit(str(error)):
                return None, "failed", str(error), attempt
            sleep(wait)
            wait *= cfg.retry_backoff
    raise AssertionError


def pending(work: DataFrame, existing: DataFrame, skip_existing: bool = True) -> DataFrame:
    """Work whose output isn't there yet. `out_path` identifies it."""
    return work.join(existing.select("out_path"), "out_path", "left_anti") if skip_existing else work


def extract(images: DataFrame, cfg: Config, calls: int | None = None, is_rate_limit=rate_limited) -> DataFrame:
    """(pdf_id, page_number, raw, status, error, attempts) of (pdf_id, page_number, png).

    `calls` (else the configuration's) bounds the partitions that call at once; with a delay, the
    global rate is calls / delay. `is_rate_limit` tells which errors are tried again.
    """
    src = images.select("pdf_id", "page_number", "png").repartition(calls or cfg.calls)

    def run(batches):
        import pandas as pd

        extractor, first = build_extractor(cfg), True
        for pdf in batches:
            rows = []
            for pdf_id, page, png in zip(pdf["pdf_id"], pdf["page_number"], pdf["png"]):
                if not first and cfg.delay_seconds:
                    time.sleep(cfg.delay_seconds)
                first = False
                rows.append((pdf_id, page, *call_with_retry(extractor, bytes(png), cfg, is_rate_limit=is_rate_limit)))
            yield pd.DataFrame(rows, columns=["pdf_id", "page_number", "raw", "status", "error", "attempts"])

    return src.mapInPandas(run, "pdf_id string, page_number int, raw string, status string, error string, attempts int")


def sanitized(raw: DataFrame) -> DataFrame:
    """Adds `tsv`, the clean table text, to raw extractions that succeeded."""
    return raw.withColumn("tsv", F.when(F.col("raw").isNotNull(), sanitize(F.col("raw"))))


def extraction_run(images: DataFrame, cfg: Config, raw_path: str, existing: DataFrame | None = None) -> DataFrame:
    """One run over page images: (pdf_id, page_number, status, error, attempts, tsv), with the pages that were skipped.

    The extractor's answers are written to `raw_path` before anything reads them, so neither a retry of a later
    step nor a new sanitiser calls the extractor again. `existing` pages (pdf_id, page_number) are skipped.
    """
    keys = ["pdf_id", "page_number"]
    todo = images.join(existing.select(*keys).distinct(), keys, "left_anti") if existing is not None else images
    extract(todo, cfg).write.mode("overwrite").parquet(raw_path)
    done = sanitized(images.sparkSession.read.parquet(raw_path)).select(*keys, "status", "error", "attempts", "tsv")
    if existing is None:
        return done
    skipped = images.select(*keys).join(existing.select(*keys).distinct(), keys, "left_semi")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return done.unionByName(skipped.select(*keys, F.lit("skipped").alias("status"), none("string", "error"), F.lit(0).alias("attempts"), none("string", "tsv")))


def quantity_value(value):
    """A quantity as a number, null where it is blank or no whole number of up to nine digits."""
    return F.when(F.trim(value).rlike("^[0-9]{1,9}$"), F.trim(value).cast("int"))
