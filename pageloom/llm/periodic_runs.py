"""Stretches of a text that repeat with a short period, and the text with one period of each.

Two words that are ``q`` apart lie on the diagonal of lag ``q``; a run of period ``q`` is a stretch of equal
words on it. A run that counts guarantees a stretch of some words, so runs of the periods of a class
``(low, high]`` all hold a seed, two equal k-grams ``q`` apart, with the class's least stretch as ``k``. That is
never below ``high``, so inside a run the next place of a gram is one smallest period on: of the places
of a gram only neighbours are paired, never all with all. Seeds are extended along their
diagonal to both sides; the furthest word covered on each lag passes over the seeds that a stretch holds already.

Only grams that repeat inside one text go on to the next class, whose grams are longer. Every text is
one row's work, linear in its words but for sorting; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.tables import chunks, mixed

LEAST_WORDS = 6
LEAST_PERIODS = 4
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def least_length(period: int) -> int:
    return max(LEAST_WORDS, LEAST_PERIODS * period)


def classes(longest: int):
    """``low``, ``high`` and the guaranteed stretch of the classes of periods that a text of ``longest`` words may have."""
    low, high = 0, 1
    while least_length(low + 1) <= longest:
        yield low, high, min(least_length(q) - q for q in range(low + 1, min(high, low + LEAST_WORDS) + 1))
        low, high = high, 2 * high


class Grams:
    """Hashes of the k-grams of joined texts, for any k."""

    def __init__(self, ids: np.ndarray, text: np.ndarray):
        n = len(ids)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mixed(ids.astype(np.uint64) + np.uint64(1)) * power[:n], out=self.total[1:])
        power.fill(_INVERSE)
        power[0] = 1
        self.back = np.multiply.accumulate(power, out=power)
        # Equal grams of different texts differ.
        self.salt = mixed(text.astype(np.uint64) + np.uint64(1))

    def of(self, at: np.ndarray, k: int) -> np.ndarray:
        return mixed((self.total[at + k] - self.total[at]) * self.back[at]) ^ self.salt[at]


def seeds(ids: np.ndarray, text: np.ndarray, end: np.ndarray, longest: int):
    """Places and lags of the seeds of all classes, in order of place.

    ``text`` is the text of each word and ``end`` where that text ends; ``longest`` is the most words of a text.
    """
    grams = Grams(ids, text)
    at = np.arange(len(ids))
    places, lags = [], []
    for low, high, k in classes(longest):
        at = at[at + k <= end[at]]
        if len(at) < 2:
            break
        value = grams.of(at, k)
        order = np.argsort(value, kind="stable")
        value, at = value[order], at[order]
        again = value[1:] == value[:-1]
        lag = np.diff(at)
        found = np.flatnonzero(again & (lag > low) & (lag <= high))
        places.append(at[found])
        lags.append(lag[found])
        repeated = np.zeros(len(at), bool)
        repeated[1:] = again
        repeated[:-1] |= again
        at = np.sort(at[repeated])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, lag = np.concatenate(places), np.concatenate(lags)
    order = np.argsort(place, kind="stable")
    return place[order], lag[order]


def _upto(ids: np.ndarray, place: int, lag: int, end: int) -> int:
    """The first place from ``place`` on whose word differs from the one ``lag`` on, or has none in the text."""
    step = 32
    while place + lag < end:
        n = min(step, end - lag - place)
        differs = ids[place : place + n] != ids[place + lag : place + lag + n]
        first = int(differs.argmax())
        if differs[first]:
            return place + first
        place, step = place + n, 2 * step
    return place


def _downto(ids: np.ndarray, place: int, lag: int, start: int) -> int:
    """The first place of the stretch of equal words on the diagonal that ends before ``place``."""
    step = 32
    while place > start:
        n = min(step, place - start)
        differs = (ids[place - n : place] != ids[place - n + lag : place + lag])[::-1]
        last = int(differs.argmax())
        if differs[last]:
            return place - last
        place, step = place - n, 2 * step
    return place


def runs(ids: np.ndarray, sizes: list[int]) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of every run of each text, by start and period.

    ``ids`` are the numbers of the words of the joined texts, ``sizes`` the words of each. Hashes pick
    the seeds, the words themselves decide how far a stretch goes.
    """
    size = np.asarray(sizes, np.int64)
    last = np.cumsum(size)
    text = np.repeat(np.arange(len(size)), size)
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    place, lag = seeds(ids, text, np.repeat(last, size), max(sizes, default=0))
    covered: dict[int, int] = {}
    for i, q, t in zip(place.tolist(), lag.tolist(), text[place].tolist(), strict=True):
        if i < covered.get(q, 0):
            continue
        end = int(last[t])
        start = end - sizes[t]
        until = covered[q] = _upto(ids, i, q, end)
        first = _downto(ids, i, q, start)
        if until - first + q >= least_length(q):
            found[t].append((first - start, until - first + q, q))
    return [sorted(own, key=lambda run: (run[0], run[2])) for own in found]


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the most periods; of equal ones the first, then that of the smallest period."""
    return min(found, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not found:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        cover[start + period] += 1
        cover[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)])


RUN = "struct<start: long, length: long, period: long>"


def periodic_runs(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None
) -> DataFrame:
    """``key``, ``n_words``, ``runs`` (array of start, length, period), ``strongest`` (one of them) and ``collapsed`` (binary).

    Words are runs of bytes other than ASCII white space. A run is a stretch of words of smallest period
    ``q``, ``LEAST_PERIODS`` periods and ``LEAST_WORDS`` words long at least, that no neighbouring word extends.
    ``collapsed`` holds the words that no run contains after its first period. A null text is empty; it and texts
    without runs have an empty array and a null ``strongest``. Repeated rows come out as often as they came in. A
    text of any length is taken whole, in memory linear in it. ``rewrite`` may change the words of a row first.
    """

    def judged(batches):
        kinds = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        for keys, texts in chunks(batches, "key", "text"):
            words = [t.split() for t in texts]
            if rewrite:
                words = [rewrite(k, w) for k, w in zip(keys, words, strict=True)]
            numbers: dict[bytes, int] = {}
            ids = np.fromiter((numbers.setdefault(w, len(numbers)) for own in words for w in own), np.int64)
            found = runs(ids, [len(own) for own in words])
            names = ("start", "length", "period")
            best = [strongest(own) for own in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([len(own) for own in words], pa.int64()),
                    pa.array([[dict(zip(names, run, strict=True)) for run in own] for own in found], pa.list_(kinds)),
                    pa.array([run and dict(zip(names, run, strict=True)) for run in best], kinds),
                    pa.array([collapsed(w, own) for w, own in zip(words, found, strict=True)], pa.binary()),
                ],
                ["key", "n_words", "runs", "strongest", "collapsed"],
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    out = rows.mapInArrow(judged, f"key long, n_words long, runs array<{RUN}>, strongest {RUN}, collapsed binary")
    return out.withColumnRenamed("key", key)
