"""Hashes of words and word sequences of many texts at once, and a filter of hashes that all tasks hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are hashed at a time.
BLOCK = 1 << 20
#: Bits of a filter: 16 for each key, and so many at most.  What it lets through wrongly, later steps drop.
BITS_EACH, BITS_MOST = 16, 1 << 28

U = np.uint64
BASE = 0x9E3779B97F4A7C15
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


LETTERS = mix(np.arange(1, 257, dtype=U) * U(BASE))
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64, at least n of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK + 1)
        _POWERS[:] = []
        for b in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(size, b, U)
            x[0] = 1
            _POWERS.append(np.cumprod(x, dtype=U))
    return _POWERS[0], _POWERS[1]


class Words:
    """The words of some texts, one after another, and hashes of sequences of them."""

    def __init__(self, texts: pa.Array):
        """Of texts or bytes; null is empty."""
        blob = [b"" if x is None else x for x in texts.cast(pa.large_binary()).to_pylist()]
        ends = np.cumsum([0, *map(len, blob)])
        self.data = np.frombuffer(b"".join(blob), np.uint8)
        n, gap = len(self.data), SPACE[self.data]
        edge = np.zeros(n + 1, bool)
        edge[ends] = True
        before, after = edge[:-1].copy(), edge[1:].copy()
        before[1:] |= gap[:-1]
        after[:-1] |= gap[1:]
        self.start, self.end = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
        self.first = np.searchsorted(self.start, ends)  # of each text, and the end
        self.n = len(self.start)
        hashes = np.zeros(self.n, U)
        at = 0
        while at < self.n:  # blocks of whole words
            to = max(at + 1, int(np.searchsorted(self.end, self.start[at] + BLOCK, "right")))
            lo, hi = self.start[at], self.end[to - 1]
            up, down = powers(hi - lo)
            sums = np.zeros(hi - lo + 1, U)
            np.cumsum(LETTERS[self.data[lo:hi]] * up[:hi - lo], out=sums[1:])
            hashes[at:to] = mix((sums[self.end[at:to] - lo] - sums[self.start[at:to] - lo]) * down[self.start[at:to] - lo])
            at = to
        up, self.down = powers(self.n + 1)
        self.sums = np.zeros(self.n + 1, U)
        np.cumsum(hashes * up[:self.n], out=self.sums[1:])
        self.text = np.repeat(np.arange(len(blob)), np.diff(self.first))
        self.from_, self.to = self.first[:-1][self.text], self.first[1:][self.text]  # of each word's text

    def hashes(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """Of the sequences of ``length`` words from ``at``."""
        return mix((self.sums[at + length] - self.sums[at]) * self.down[at] + np.asarray(length, U))


def small_batches(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches of a few texts, of about BLOCK bytes or one text."""
    for batch in batches:
        sizes = np.cumsum([0, *(x or 0 for x in pc.binary_length(batch.column(column)).to_pylist())])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + BLOCK, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def bits_of(keys: DataFrame) -> np.ndarray:
    """A filter of the distinct values of the column key: bits of which those that a key chooses are set."""
    bits = 1 << min(BITS_MOST.bit_length() - 1, max(10, (BITS_EACH * max(1, keys.count())).bit_length()))
    part = min(bits // 8, 1 << 16)

    def build(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        on = np.zeros(part * 8, bool)
        on[group.column("bit").to_numpy()] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bytes": pa.array([np.packbits(on).tobytes()], pa.binary())})

    spot = F.expr(f"key & {bits - 1}L")
    parts = keys.select((spot / (part * 8)).cast("int").alias("part"), (spot % (part * 8)).cast("int").alias("bit")).distinct()
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.groupBy("part").applyInArrow(build, "part int, bytes binary").toLocalIterator():
        out[r["part"] * part:(r["part"] + 1) * part] = np.frombuffer(r["bytes"], np.uint8)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be among the filter's keys; all of its keys are."""
    spot = hashes & U(len(bits) * 8 - 1)
    return (bits[spot >> U(3)] >> (U(7) - (spot & U(7))).astype(np.uint8)) & 1 > 0
