"""A table of bits of fixed size: which 64-bit hashes may be in a set.

A hash sets the bit of its first ``bits`` bits. What isn't in the set may have
its bit set too, so a table only spares work; whatever it lets through is
counted or joined exactly. Its size is the bound of what is broadcast."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F


class BitTable:
    def __init__(self, bits: int, table: np.ndarray | None = None):
        self.bits = bits
        self.table = np.zeros(1 << max(0, bits - 6), np.uint64) if table is None else table
        self.shared = None

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)

    def share(self, spark):
        """The table as a broadcast."""
        if self.shared is None:
            self.shared = spark.sparkContext.broadcast((self.bits, self.table))
        return self.shared

    def release(self) -> None:
        """Drop the broadcast: what was read through it is written."""
        if self.shared is not None:
            self.shared.destroy()
            self.shared = None

    def with_hashes(self, hashes: DataFrame) -> BitTable:
        """Also the hashes of a frame (h); what comes to the driver is at most
        the table."""
        at = F.shiftrightunsigned("h", 64 - self.bits)
        bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - self.bits}) & 63 AS int))")
        rows = (hashes.select(F.shiftright(at, 6).alias("word"), bit.alias("bit"))
                .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
        table = self.table.copy()
        table[rows.column("word").to_numpy()] |= rows.column("bits").to_numpy().view(np.uint64)
        return BitTable(self.bits, table)
