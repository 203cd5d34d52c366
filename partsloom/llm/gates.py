"""A Bloom filter over 64-bit codes, built in Spark and asked in Python workers.

What is collected and broadcast is a bitmap of at most `MOST` bits, whatever the number of
codes; more codes only let more false hits through, which an exact join removes afterwards.
"""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each code, and at most in all (32 MB).
PER_CODE, MOST = 16, 1 << 28
_SHIFTS = (0, 28)


class Gate:
    def __init__(self, size: int, bits: np.ndarray):
        self.size, self.bits = size, bits

    def holds(self, codes: np.ndarray) -> np.ndarray:
        """Whether each code may be among those the filter was built of; never false for one that is."""
        codes = codes.astype(np.uint64, copy=False)
        out = np.ones(len(codes), dtype=bool)
        for shift in _SHIFTS:
            bit = (codes >> np.uint64(shift)) & np.uint64(self.size - 1)
            out &= (self.bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def gate_here(codes: np.ndarray) -> Gate:
    """The filter of codes that are at hand."""
    codes, size = codes.astype(np.int64).view(np.uint64), 1 << 15
    while size < min(len(codes) * PER_CODE, MOST):
        size *= 2
    bits = np.zeros(size, dtype=np.uint8)
    for shift in _SHIFTS:
        bits[((codes >> np.uint64(shift)) & np.uint64(size - 1)).astype(np.int64)] = 1
    return Gate(size, np.packbits(bits, bitorder="little"))


def gate_of(codes: DataFrame) -> Gate:
    """The filter of a frame's first column (bigint); nulls are left out."""
    codes = codes.toDF("code").where("code is not null")
    size, wanted = 1 << 15, codes.count() * PER_CODE
    while size < min(wanted, MOST):
        size *= 2
    places = [F.shiftrightunsigned("code", s).bitwiseAND(F.lit(size - 1).cast("bigint")) + 1 for s in _SHIFTS]
    places = codes.select(F.explode(F.array(*places)).alias("p"))
    maps = places.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    bits = np.zeros(size // 8, dtype=np.uint8)
    for row in maps.toLocalIterator():
        part = np.frombuffer(bytes(row.m), dtype=np.uint8)
        bits[(row.b - 1) * 4096 :][: len(part)] = part
    return Gate(size, bits)


class Shared:
    """A broadcast value that workers turn into an object once and keep while it is in use."""

    def __init__(self, spark, value, build):
        self.token, self.value, self.build = uuid.uuid4().hex, spark.sparkContext.broadcast(value), build

    def get(self):
        if self.token not in _held:
            _held.clear()
            _held[self.token] = self.build(self.value.value)
        return _held[self.token]


_held: dict[str, object] = {}


def shared_gate(spark, gate: Gate) -> Shared:
    return Shared(spark, (gate.size, gate.bits), lambda v: Gate(*v))
