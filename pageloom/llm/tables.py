"""Tables of a query and small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet").select(*columns)


def chunks(batches: Iterator[pa.RecordBatch], key: str, text: str, limit: int = CHUNK_BYTES, extra: str | None = None):
    """Lists of keys and of whole texts, a list holding about ``limit`` bytes or one longer text.

    ``text`` is a binary column; a null text is empty. With ``extra`` a third list has that column.
    """
    names = [key, *([extra] if extra else [])]
    held, texts, size = [[] for _ in names], [], 0
    for batch in batches:
        for *own, t in zip(*(batch.column(c).to_pylist() for c in names), batch.column(text), strict=True):
            t = t.as_py() or b""
            if texts and size + len(t) > limit:
                yield held[0], texts, *held[1:]
                held, texts, size = [[] for _ in names], [], 0
            for column, value in zip(held, own, strict=True):
                column.append(value)
            texts.append(t)
            size += len(t)
    if texts:
        yield held[0], texts, *held[1:]


def give_back() -> None:
    """Hand freed memory back to the system, as a Python worker lives on for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words, runs of bytes other than ASCII white space, of joined texts: place and 64-bit hash."""

    def __init__(self, texts: list[bytes]):
        self.buffer = b"\n".join(texts)
        raw = np.frombuffer(self.buffer, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.text_start = np.concatenate([[0], np.cumsum(lengths + 1)])[: len(texts)]
        inside = np.zeros(len(raw) + 2, np.int8)
        inside[1:-1] = ~SPACES[raw]
        edges = np.diff(inside)
        self.start = np.flatnonzero(edges == 1)
        self.end = np.flatnonzero(edges == -1)
        self.first = np.searchsorted(self.start, self.text_start)
        self.last = np.append(self.first[1:], len(self.start))
        self.text = np.repeat(np.arange(len(texts)), self.last - self.first)
        self.hash = self._hashes(raw)

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        n = len(raw)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        power.fill(_INVERSE)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        return mixed((total[self.end] - total[self.start]) * power[self.start])
