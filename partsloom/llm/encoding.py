"""Problem 6: the whole corpus as token ids of a public byte-level BPE.

The vocabulary file is serialised into a sentencepiece BPE model: one piece a token, its
bytes mapped to printable characters, scored by negative rank, identity normalisation, no
white space handling. sentencepiece then merges exactly the pair of lowest rank, as the
vocabulary's own encoder does. Texts are cut into pre-tokens by the vocabulary's pattern,
pre-tokens are encoded in bulk, and decoding maps pieces back to bytes.

The model (about 1 MB, fixed by the vocabulary) is broadcast; texts stay in their
partitions, so there is no shuffle. A worker keeps the ids of pre-tokens it has seen and
forgets all of them when `CACHE` is reached, which bounds memory and changes no result.

Defined results: a null or empty text gives an empty list; special-token strings inside a
text are ordinary text.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE = 400_000
#: Pre-tokens beyond this length are not kept.
LONG = 200

#: Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    try:
        import public_tokenizers

        return str(public_tokenizers.path(name))
    except ImportError:
        return f"/opt/tokenizers/{name}"


def byte_alphabet() -> list[str]:
    """Printable character of each byte: itself where printable, else the next of U+0100 and on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b) if b in plain else chr(spare))
        spare += b not in plain
    return out


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank."""
    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line.strip():
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    assert sorted(ranks) == list(range(len(ranks))), "ranks have gaps"
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto in which piece i is token i; one unknown piece follows the last."""
    alphabet, out = byte_alphabet(), bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(alphabet[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, 1))
    out += _field(1, _field(1, "⁇".encode()) + _field(2, 0.0) + _field(3, 2))
    # trainer: BPE, sizes, ids (unknown last; -1 is written as 64 bits); normaliser: identity, all switches off
    absent = (1 << 64) - 1
    out += _field(2, _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(41, absent) + _field(42, absent) + _field(43, absent))
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


class Codec:
    """Encoder and decoder around one serialised model."""

    def __init__(self, model: bytes):
        import regex
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(PATTERN).findall
        alphabet = byte_alphabet()
        self.to_chars = {b: c for b, c in enumerate(alphabet)}
        self.to_byte = {c: b for b, c in enumerate(alphabet)}
        self.seen: dict[str, list[int]] = {}

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        cut = [self.find(t) if t else [] for t in texts]
        if len(self.seen) > CACHE:
            self.seen = {}
        seen = self.seen
        new = list({w for words in cut for w in words if w not in seen})
        if new:
            mapped = [w.encode().decode("latin-1").translate(self.to_chars) for w in new]
            seen.update(zip(new, self.sp.encode(mapped, num_threads=1)))
        out = [[i for w in words for i in seen[w]] for words in cut]
        for w in new:
            if len(w) > LONG:
                del seen[w]
        return out

    def decode(self, ids: list[int]) -> str:
        return bytes(self.to_byte[c] for i in ids for c in self.sp.id_to_piece(int(i))).decode("utf-8", "replace")


#: The codec a worker holds, by the token of its model.
_codecs: dict[str, Codec] = {}


def _codec(token: str, model) -> Codec:
    if token not in _codecs:
        _codecs.clear()
        _codecs[token] = Codec(model.value)
    return _codecs[token]


def _shared(spark, vocabulary: str | None):
    """(token, broadcast model) of a vocabulary file."""
    model = serialise_model(read_ranks(vocabulary or vocabulary_path()))
    return hashlib.sha256(model).hexdigest(), spark.sparkContext.broadcast(model)


def encode(df: DataFrame, key: str = "doc_id", column: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids): the token ids of every row."""
    token, model = _shared(df.sparkSession, vocabulary)
    src = df.select(F.col(key).alias("k"), F.col(column).alias("t"))
    kind = src.schema["k"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        codec = _codec(token, model)
        for batch in batches:
            ids = codec.encode_batch(batch.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=int(ends[-1]))
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    return src.mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(df: DataFrame, key: str = "doc_id", column: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """(key, text): ids back to text; null ids give an empty text."""
    token, model = _shared(df.sparkSession, vocabulary)
    src = df.select(F.col(key).alias("k"), F.col(column).alias("i"))
    kind = src.schema["k"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        codec = _codec(token, model)
        for batch in batches:
            texts = [codec.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return src.mapInArrow(run, f"`{key}` {kind}, text string")
