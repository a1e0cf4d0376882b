"""Benchmark decontamination by spaced-seed hashing.

A mask picks some of the words in a short run and ignores the others, so that a run hashes alike
whatever words stand at the ignored places. Hashes of the benchmark's runs under each mask are
looked up for every run of every text; around a hit, the benchmark item is laid over the text at
that place and compared word by word. Together the masks hit every stretch of ``OVERLAP`` words
with up to a fifth of them substituted, which a test checks for all patterns.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.tables import Words, chunks, mixed

# Places of a run that are compared.
MASKS = ((0, 1, 2, 4, 6, 7), (0, 1, 3, 6, 7, 8))
OVERLAP = 13
SIMILAR = 0.8
# Words of benchmark text that a task holds at once; more are taken in as many passes as it needs.
WORDS_AT_ONCE = 1 << 20
FILTER_BITS = 22
# Pairs of places of one seed above which diagonals are marked in place of listing the pairs, and pairs listed at once.
PAIRED, AT_ONCE = 50_000, 1 << 20
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def normal(text: bytes) -> bytes:
    """ASCII letters in lower case, ASCII punctuation and controls as spaces."""
    return text.translate(_LETTERS)


def _under(hashes: np.ndarray, mask: tuple[int, ...], n: int) -> np.ndarray:
    total = np.zeros(n, np.uint64)
    for i in mask:
        total += hashes[i : i + n] * (mixed(np.array([i + 1], np.uint64)) | np.uint64(1))
    return mixed(total)


class Seeds:
    """Benchmark items by the hashes of their runs under each mask."""

    def __init__(self, items: list[int], texts: list[bytes], overlap: int = OVERLAP, similar: float = SIMILAR, paired: int = PAIRED):
        self.items, self.overlap, self.paired = items, overlap, paired
        self.least = int(np.ceil(similar * overlap - 1e-9))
        words = Words([normal(t) for t in texts])
        self.hash, self.first, self.last = words.hash, words.first, words.last
        size = self.last - self.first
        # An item of fewer words must stand in the text as a whole: one mask for each such length.
        self.masks = [*MASKS, *(tuple(range(n)) for n in sorted({int(n) for n in size if 0 < n < overlap}))]
        self.tables = []
        for k, mask in enumerate(self.masks):
            n = max(len(self.hash) - mask[-1], 0)
            at = np.arange(n)
            own = words.text[:n]
            fits = (at + mask[-1] < self.last[own]) & ((size[own] >= overlap) if k < len(MASKS) else (size[own] == len(mask)))
            at = at[fits]
            seed = _under(self.hash, mask, n)[fits]
            order = np.argsort(seed, kind="stable")
            bits = np.zeros(1 << FILTER_BITS, bool)
            bits[(seed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.tables.append((seed[order], at[order], own[at[order]] if len(at) else at, bits))

    def hits(self, words: Words):
        """Item and the place of its first word in ``words`` for every hit, each pair once; the text of the hit."""
        found = []
        for mask, (seed, at, own, bits) in zip(self.masks, self.tables, strict=True):
            n = max(len(words.hash) - mask[-1], 0)
            if not n or not len(seed):
                continue
            run = _under(words.hash, mask, n)
            near = np.flatnonzero(bits[(run >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            near = near[words.text[near] == words.text[near + mask[-1]]]
            low = np.searchsorted(seed, run[near])
            count = np.searchsorted(seed, run[near], side="right") - low
            # A seed that a repetitive text and a repetitive item have very often: its places are not paired one by one.
            first, nth, times = np.unique(low, return_inverse=True, return_counts=True)
            hot = (times[nth] * count > self.paired) & (count > 0)
            for start in first[np.unique(nth[hot])].tolist():
                mine = near[(low == start) & hot]
                entries = slice(start, start + int(count[np.flatnonzero((low == start) & hot)[0]]))
                found += self._diagonals(own[entries], at[entries], words.text[mine], mine)
            near, low, count = near[~hot], low[~hot], count[~hot]
            ends = np.cumsum(count)
            begin = 0
            while begin < len(near):
                end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + AT_ONCE, side="right")))
                some = slice(begin, end)
                total = np.cumsum(count[some])
                take = np.repeat(low[some] - np.append(0, total[:-1]), count[some]) + np.arange(total[-1])
                where = np.repeat(near[some], count[some])
                pairs = np.stack([own[take], words.text[where], where - (at[take] - self.first[own[take]])])
                found.append(pairs if end == len(near) and not begin else np.unique(pairs, axis=1))
                begin = end
        if not found:
            return np.zeros((3, 0), np.int64)
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def _diagonals(self, items, at, texts, places):
        """As ``hits`` for the places of one seed in items and in texts, in time of their product but memory of their span."""
        for item in np.unique(items).tolist():
            inner = at[items == item] - self.first[item]
            for text in np.unique(texts).tolist():
                outer = places[texts == text]
                base = int(outer.min() - inner.max())
                mark = np.zeros(int(outer.max() - inner.min()) - base + 1, bool)
                few, many, sign = (inner, outer, -1) if len(inner) < len(outer) else (outer, -inner, 1)
                for one in few.tolist():
                    mark[many + sign * one - base] = True
                place = np.flatnonzero(mark) + base
                yield np.stack([np.full(len(place), item), np.full(len(place), text), place])

    def leaks(self, words: Words):
        """(text, item, first word, words covered, words equal) of each hit that holds out, one per text and item."""
        item, text, place = self.hits(words)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for i, t, p in zip(item.tolist(), text.tolist(), place.tolist(), strict=True):
            if best.get((t, i), (0,))[0] == int(self.last[i] - self.first[i]):
                # The whole item stands there already, and further left.
                continue
            a, b = max(p, int(words.first[t])), min(p + int(self.last[i] - self.first[i]), int(words.last[t]))
            same = words.hash[a:b] == self.hash[self.first[i] + a - p : self.first[i] + b - p]
            size = int(self.last[i] - self.first[i])
            if size < self.overlap:
                ok, span, start = b - a == size and bool(same.all()), (size, size), a
            else:
                run = np.append(0, np.cumsum(same))
                good = np.flatnonzero(run[self.overlap :] - run[: -self.overlap] >= self.least) if b - a >= self.overlap else []
                ok = len(good) > 0
                if ok:
                    cover = np.zeros(b - a + 1, np.int64)
                    np.add.at(cover, good, 1)
                    np.add.at(cover, good + self.overlap, -1)
                    inside = np.cumsum(cover[:-1]) > 0
                    span, start = (int(inside.sum()), int((same & inside).sum())), a + int(good[0])
            if ok:
                new = (span[1], span[0], -(start - int(words.first[t])))
                best[t, i] = max(best.get((t, i), new), new)
        return [(t, i, -s, covered, equal) for (t, i), (equal, covered, s) in best.items()]


SCHEMA = "key long, item long, first_word long, n_words long, n_equal long"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    words_at_once: int = WORDS_AT_ONCE,
) -> DataFrame:
    """A row per text and benchmark item that overlap: ``key``, ``item``, ``first_word``, ``n_words``, ``n_equal``.

    They overlap if, laid over each other at some place, at least ``SIMILAR`` of ``OVERLAP`` words in
    a row are equal; ``n_words`` are those in such stretches, at the place where most are equal. An
    item of fewer words must stand in the text whole. Case and ASCII punctuation do not count. Null and
    empty texts and items overlap with nothing; repeated rows are judged each; rows with a null item
    id are reported with a null item.
    """
    passages = benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("binary").alias("text")).where("text is not null")
    words = passages.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    # Two bytes a word at least.
    passes = -(-words // (2 * words_at_once)) or 1
    part = F.pmod(F.xxhash64("item", "text"), F.lit(passes))
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text")).where("text is not null")
    out = None
    for n in range(passes):
        rows = passages.where(part == n).collect()
        sent = docs.sparkSession.sparkContext.broadcast(([r.item for r in rows], [bytes(r.text) for r in rows]))
        found = texts.mapInArrow(_found(sent), SCHEMA)
        out = found if out is None else out.unionAll(found)
    return out.withColumnsRenamed({"key": key, "item": item})


def _found(sent):
    def found(batches):
        seeds = Seeds(*sent.value)
        for keys, texts in chunks(batches, "key", "text"):
            rows = seeds.leaks(Words([normal(t) for t in texts])) if seeds.items else []
            columns = [list(c) for c in zip(*rows)] or [[]] * 5
            columns[0] = [keys[t] for t in columns[0]]
            columns[1] = [seeds.items[i] for i in columns[1]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "item", "first_word", "n_words", "n_equal"])

    return found
