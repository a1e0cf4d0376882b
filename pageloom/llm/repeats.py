"""Windows of ``length`` tokens that stand in more than one place: what exact substring dedup shares.

Only texts around repeated *anchors* are compared. Each window of tokens is filed under the least
hash of the ``gram``-token runs in it, so equal windows have equal anchors, and neighbouring
windows mostly share one. Five steps, each over all texts:

1. texts are packed into blocks of a few MB, written once;
2. each block sends 32 bits per distinct anchor, and a hash per text, to a bucket, which answers whether
   the anchor stands elsewhere, and whether the text is a copy of one of a smaller key, which goes whole;
3. blocks send the passages around repeated anchors, each different one once, to shards by anchor;
4. a shard finds the windows that stand earlier in another passage: the operator's own method;
   its answers are written;
5. blocks drop what the answers cover.

A group in a task is bounded: anchors of more than ``hot`` passages are filed window by window under
the hash of the whole window instead, where all passages are equal, and an equal passage comes at
most once from each block.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.tables import Words, chunks, give_back, mixed
from pageloom.session import shared_table

BLOCK_BYTES = 2 << 20
SEGMENT = 1 << 17
# Blocks whose anchors, or passages, fill one bucket or shard.
BLOCKS_TOGETHER = 8
HOT = 2_000
RUN = 1_024
# Bytes of passages that are judged at once, and windows that are laid over a block's texts at once.
PORTION, WINDOWS = 2 << 20, 1 << 17
LAST = np.iinfo(np.int64).max
SCHEMA = "block long, kind int, bucket int, data binary"


def packed(arrays: list[np.ndarray | bytes], level: int = 3) -> bytes:
    """Arrays and byte strings in one compressed byte string."""
    raw = [x if isinstance(x, bytes) else x.tobytes() for x in arrays]
    return zstandard.ZstdCompressor(level).compress(b"".join([np.array([len(x) for x in raw], "<i8").tobytes(), *raw]))


def unpacked(data: bytes, kinds: list) -> list:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, "<i8", len(kinds))
    ends = 8 * len(kinds) + np.cumsum(sizes)
    return [
        raw[e - s : e] if k is bytes else np.frombuffer(raw[e - s : e], k)
        for e, s, k in zip(ends.tolist(), sizes.tolist(), kinds, strict=True)
    ]


class Block:
    """Keys and texts of one block, and their tokens: bytes or words."""

    def __init__(self, data: bytes, words: bool):
        keys, nulls, lengths, joined, extra = unpacked(data, ["<i8", bool, "<i8", bytes, bytes])
        self.extra = json.loads(extra)
        self.keys, self.nulls, self.order_keys = keys, nulls, np.where(nulls, LAST, keys)
        ends = np.cumsum(lengths)
        self.texts = [joined[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
        self.words = None
        if words:
            self.words = Words(self.texts)
            self.tokens, self.first, self.last = self.words.hash, self.words.first, self.words.last
        else:
            self.joined = joined
            self.tokens, self.first, self.last = np.frombuffer(joined, np.uint8), ends - lengths, ends

    def passage(self, start: int, end: int) -> bytes:
        if self.words is None:
            return self.joined[start:end]
        w = self.words
        return b" ".join(w.buffer[w.start[start] : w.end[end - 1]].split())

    def anchors(self, length: int, gram: int):
        """Anchor, first window and number of windows of each run of windows with one anchor, in order.

        The fourth array says, for words, whether the anchor stands more than once in the run's
        passage, as it must if the passage holds a window twice.
        """
        out = []
        # A window of each position that has one, by text.
        for lo, hi in self._stretches(length):
            width = length - gram + 1
            grams = _grams(self.tokens[lo : hi + length - 1], gram)
            least = _least(grams, width)
            new = np.ones(hi - lo, bool)
            new[1:] = least[1:] != least[:-1]
            inner = self.first[np.searchsorted(self.first, lo) : np.searchsorted(self.first, hi)]
            new[inner - lo] = True
            new[::RUN] = True
            at = np.flatnonzero(new)
            ends = np.append(at[1:], hi - lo)
            # Windows end with their text.
            text = np.searchsorted(self.first, lo + at, side="right") - 1
            ends = np.minimum(ends, self.last[text] - length + 1 - lo)
            keep = ends > at
            at, size = at[keep], (ends - at)[keep]
            twice = np.zeros(len(at), bool)
            if self.words is not None and len(at):
                spread = size + width - 1
                first = np.cumsum(spread) - spread
                inside = np.arange(spread.sum()) + np.repeat(at - first, spread)
                twice = np.add.reduceat((grams[inside] == np.repeat(least[at], spread)).astype(np.int64), first) > 1
            out.append((least[at], lo + at, size, twice))
        if not out:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        anchor, start, count, twice = (np.concatenate(x) for x in zip(*out))
        # Least hashes are mostly small; scrambled ones fall evenly into buckets.
        return mixed(anchor ^ np.uint64(0x5555555555555555)), start, count, twice

    def _stretches(self, length: int):
        stop = len(self.tokens) - length + 1
        for lo in range(0, stop, SEGMENT):
            yield lo, min(lo + SEGMENT, stop)


def _grams(tokens: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every run of ``gram`` tokens, by doubling."""
    base = np.uint64(0x9E3779B97F4A7C15)
    one, span = tokens.astype(np.uint64) + np.uint64(1), 1
    total, have, power = None, 0, base
    left = gram
    while left:
        if left & 1:
            if total is None:
                total, have = one, span
            else:
                total = total[: len(one) - have] * power + one[have : have + len(total)] if len(one) > have else one[:0]
                have += span
        left >>= 1
        if left:
            one = one[:-span] * power + one[span:]
            power, span = np.uint64(int(power) ** 2 % (1 << 64)), 2 * span
    return mixed(total[: len(tokens) - gram + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    span, now = 1, values
    while 2 * span <= width:
        now = np.minimum(now[:-span], now[span:])
        span *= 2
    return np.minimum(now[: len(values) - width + 1], now[width - span : len(values) - span + 1])


@dataclass
class Shard:
    """Different passages of one shard, sorted by anchor, then by where they stand first."""

    anchor: np.ndarray
    key: np.ndarray
    start: np.ndarray
    texts: list[bytes]


@dataclass(frozen=True)
class Repeats:
    """``earlier(shard)`` gives, for each passage, its windows that stand earlier in the shard, as an array of bool.

    With ``words`` the tokens are words and an earlier place in the same text counts; else they are
    bytes and only texts of a smaller key count.
    """

    length: int
    gram: int
    words: bool
    earlier: Callable[[Shard], list[np.ndarray]]
    hot: int = HOT
    block_bytes: int = BLOCK_BYTES

    def blocks(self, docs: DataFrame, key: str, text: str, extra: str | None) -> DataFrame:
        size = self.block_bytes

        def made(batches):
            number = TaskContext.get().partitionId() << 32
            for keys, texts, more in chunks(batches, "key", "text", size, "extra"):
                data = packed([
                    np.array([0 if k is None else k for k in keys], "<i8"), np.array([k is None for k in keys], bool),
                    np.array([len(t) for t in texts], "<i8"), b"".join(texts), json.dumps(more).encode(),
                ], 5)
                yield _batch([(number, 0, 0, data)])
                number += 1

        rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"), (F.col(extra) if extra else F.lit(None).cast("string")).alias("extra"))
        return shared_table(rows.mapInArrow(made, SCHEMA))

    def _values(self, block: Block, buckets: int):
        """Anchors of the block, each once, with the number of its places, its bucket, and the place of each run's anchor."""
        anchor, start, count, twice = block.anchors(self.length, self.gram)
        values, place = np.unique(anchor, return_inverse=True)
        runs = np.bincount(place, 1 + twice, len(values)).astype(np.int64)
        bucket = ((values >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
        return start, count, values, place, runs, bucket

    def _texts(self, block: Block, buckets: int):
        """Texts that have a window, by bucket of their hash, where each bucket begins, and the hashes."""
        own = np.flatnonzero(block.last - block.first >= self.length)
        hashes = np.array([divmod(xxhash.xxh3_128_intdigest(block.texts[i]), 1 << 64) for i in own], np.uint64).reshape(-1, 2)
        bucket = (hashes[:, 0] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return own[order], np.searchsorted(bucket[order], np.arange(buckets + 1)), hashes[order]

    def _ask(self, blocks: DataFrame, buckets: int) -> DataFrame:
        def asked(batches):
            for number, _, _, data in _rows(batches):
                block = Block(data, self.words)
                _, _, values, _, runs, bucket = self._values(block, buckets)
                cut = np.searchsorted(bucket, np.arange(buckets + 1)).tolist()
                low = values.astype(np.uint32)
                many = np.minimum(runs, 255).astype(np.uint8)
                own, text_cut, hashes = self._texts(block, buckets)
                key = block.order_keys[own]
                yield _batch([
                    (number, 0, i, packed([low[a:b], many[a:b], hashes[c:d, 0], hashes[c:d, 1], key[c:d]]))
                    for i, (a, b, c, d) in enumerate(zip(cut[:-1], cut[1:], text_cut[:-1], text_cut[1:])) if b > a or d > c
                ])
            give_back()

        return blocks.mapInArrow(asked, SCHEMA)

    def _answer(self, asked: DataFrame, buckets: int) -> DataFrame:
        """A row per asking row: is the anchor in several places, is it hot."""
        hot = self.hot

        def answered(batches):
            for bucket, rows in _groups(_rows(batches), 2):
                parts = [unpacked(data, ["<u4", "u1", "<u8", "<u8", "<i8"]) for _, _, _, data in rows]
                low = np.concatenate([p[0] for p in parts])
                order = np.argsort(low, kind="stable")
                begin = np.flatnonzero(np.append(True, np.diff(low[order]) != 0)) if len(low) else np.zeros(0, np.int64)
                runs = np.concatenate([p[1] for p in parts])[order].astype(np.int64)
                total = np.repeat(np.add.reduceat(runs, begin), np.diff(np.append(begin, len(low))))
                found = np.zeros(len(low), np.uint8)
                found[order] = (total > 1).astype(np.uint8) + (total > hot)
                upper, lower, key = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
                order = np.lexsort((key, lower, upper))
                new = np.ones(len(key), bool)
                new[1:] = (upper[order][1:] != upper[order][:-1]) | (lower[order][1:] != lower[order][:-1])
                copy = np.zeros(len(key), np.uint8)
                copy[order] = key[order] > key[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
                ends, text_ends = np.cumsum([len(p[0]) for p in parts]), np.cumsum([len(p[4]) for p in parts])
                yield _batch([
                    (number, 1, bucket, packed([found[e - len(p[0]) : e], copy[t - len(p[4]) : t]]))
                    for (number, _, _, _), p, e, t in zip(rows, parts, ends.tolist(), text_ends.tolist(), strict=True)
                ])
            give_back()

        return asked.repartitionById(buckets, "bucket").mapInArrow(answered, SCHEMA)

    def _passages(self, blocks: DataFrame, answers: DataFrame, buckets: int, shards: int) -> DataFrame:
        """Kind 2: passages for a shard. Kind 3: where the block has them, on the way through any shard."""

        def sent(batches):
            for number, rows in _groups(_rows(batches), 0):
                block = Block(rows[0][3], self.words)
                start, count, values, place, _, bucket = self._values(block, buckets)
                state = np.zeros(len(values), np.uint8)
                cut = np.searchsorted(bucket, np.arange(buckets + 1))
                own, text_cut, _ = self._texts(block, buckets)
                copy = np.zeros(len(block.texts), bool)
                for _, _, i, data in rows[1:]:
                    state[cut[i] : cut[i + 1]], copy[own[text_cut[i] : text_cut[i + 1]]] = unpacked(data, ["u1", "u1"])
                # A copy goes whole, and what it holds stands earlier elsewhere.
                open_ = ~copy[np.searchsorted(block.first, start, side="right") - 1]
                yield _batch(self._sent(number, block, copy, start[open_], count[open_], values[place[open_]], state[place[open_]], shards))
            give_back()

        joined = blocks.unionByName(answers)
        return joined.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(sent, SCHEMA)

    def _sent(self, number, block, copy, start, count, anchor, state, shards):
        single = np.flatnonzero(state == 2)
        pick = np.flatnonzero(state == 1)
        start, count, anchor = (
            np.concatenate([start[pick], np.repeat(start[single] - np.cumsum(np.append(0, count[single][:-1])), count[single]) + np.arange(count[single].sum())]),
            np.concatenate([count[pick], np.ones(count[single].sum(), np.int64)]),
            np.concatenate([anchor[pick], np.zeros(count[single].sum(), np.uint64)]),
        )
        texts: dict[bytes, int] = {}
        which = np.empty(len(start), np.int64)
        for i, (a, n) in enumerate(zip(start.tolist(), count.tolist(), strict=True)):
            which[i] = texts.setdefault(block.passage(a, a + n + self.length - 1), len(texts))
        names = list(texts)
        text = np.searchsorted(block.first, start, side="right") - 1
        key = block.order_keys[text]
        at = start - block.first[text]
        order = np.lexsort((at, key, which))
        lead = order[np.append(True, np.diff(which[order]) != 0)] if len(order) else order
        first = key == key[lead][which]
        if self.words:
            first &= at == at[lead][which]
        order = np.argsort(start, kind="stable")
        steps = np.diff(start[order], prepend=0).astype("<u4")
        yield number, 3, number % shards, packed([
            which[order].astype("<u4"), steps, count[order].astype("<u2"), first[order], np.flatnonzero(copy).astype("<u4"),
        ])
        value = anchor[lead]
        hot = np.flatnonzero(value == 0)
        if len(hot):
            value[hot] = np.array([xxhash.xxh64_intdigest(names[i]) for i in hot], np.uint64)
        shard = (value % np.uint64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
            if b > a:
                own = order[a:b]
                mine = [names[j] for j in own]
                data = packed([
                    np.diff(own, prepend=0).astype("<u4"), value[own].astype("<u4"), key[lead][own],
                    at[lead][own].astype("<u4") if self.words else b"", np.array([len(t) for t in mine], "<u4"), b"".join(mine),
                ])
                yield number, 2, i, data

    def _judged(self, passages: DataFrame, shards: int) -> DataFrame:
        """Kind 4: for a block, the windows of its passages that stand earlier than all it has of them."""

        def judged(batches):
            for _, rows in _groups(_rows(batches), 2):
                yield _batch([row for row in rows if row[1] == 3])
                if rows[0][1] == 2:
                    yield _batch(self._shard([row for row in rows if row[1] == 2]))
                    give_back()

        return passages.repartitionById(shards, "bucket").sortWithinPartitions("kind").mapInArrow(judged, SCHEMA)

    def _shard(self, rows):
        parts = [unpacked(data, ["<u4", "<u4", "<i8", "<u4", "<u4", bytes]) for _, _, _, data in rows]
        sizes = [len(p[0]) for p in parts]
        part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        end = np.concatenate([np.cumsum(p[4], dtype=np.int64) for p in parts])
        own = np.concatenate([np.cumsum(p[0], dtype=np.int64) for p in parts])
        anchor, key, start, length = (np.concatenate([p[i] for p in parts]) for i in range(1, 5))
        if not self.words:
            start = np.zeros(len(key), np.int64)
        joined = [p[5] for p in parts]
        del parts
        # Equal windows have equal anchors, so a few anchors at a time are judged.
        by_anchor = np.argsort(anchor, kind="stable")
        begin = np.flatnonzero(np.append(True, np.diff(anchor[by_anchor]) != 0))
        begin = np.append(begin, len(anchor))
        found = []
        for a, b in _portions(np.add.reduceat(length[by_anchor].astype(np.int64), begin[:-1]), PORTION):
            some = by_anchor[begin[a] : begin[b]]
            texts = (joined[i][e - n : e] for i, e, n in zip(part[some].tolist(), end[some].tolist(), length[some].tolist(), strict=True))
            row, *windows = self._portion(texts, anchor[some], key[some], start[some])
            found.append((some[row], *windows))
        row, begin, many = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(row, kind="stable")
        row, begin, many = row[order], begin[order], many[order]
        ends = np.searchsorted(row, np.cumsum(sizes))
        last = 0
        for (number, _, bucket, _), end in zip(rows, ends.tolist(), strict=True):
            if end > last:
                cut = slice(last, end)
                yield number, 4, bucket, packed([own[row[cut]].astype("<u4"), begin[cut], many[cut]])
            last = end

    def _portion(self, passages, anchor, key, start):
        """Place of the passage, first window and number of the runs of windows that stand earlier."""
        names: dict[bytes, int] = {}
        which = np.array([names.setdefault(text, len(names)) for text in passages])
        order = np.lexsort((start, key, which))
        lead = order[np.append(True, np.diff(which[order]) != 0)]
        rank = np.lexsort((start[lead], key[lead], anchor[lead]))
        texts = list(names)
        shard = Shard(anchor[lead][rank], key[lead][rank], start[lead][rank], [texts[i] for i in rank])
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        windows = self.earlier(shard)
        # Runs of windows that stand earlier, by passage.
        owner, begin, many = _runs(windows)
        size = np.array([len(w) for w in windows])
        at = place[which]
        if self.words:
            later = (key != shard.key[at]) | (start != shard.start[at])
        else:
            later = key > shard.key[at]
        low, high = np.searchsorted(owner, at), np.searchsorted(owner, at, side="right")
        high = np.where(later, low, high)
        n = high - low
        take = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        row = np.concatenate([np.repeat(np.arange(len(at)), n), np.flatnonzero(later)])
        begin = np.concatenate([begin[take], np.zeros(later.sum(), np.int64)])
        many = np.concatenate([many[take], size[at[later]]])
        # The widest fit two bytes, as passages have at most RUN windows.
        return row, begin.astype("<u2"), many.astype("<u2")

    def kept(self, docs: DataFrame, key: str = "doc_id", text: str = "text", extra: str | None = None) -> DataFrame:
        """``key``, ``n_tokens``, ``n_removed``, ``n_spans``, ``kept`` (binary) and ``extra`` of every row of ``docs``.

        ``extra`` may name a string column to carry along, in place of a join of the texts afterwards.
        """
        blocks = self.blocks(docs, key, text, extra)
        buckets = shards = max(8, blocks.count() // BLOCKS_TOGETHER)
        answers = self._answer(self._ask(blocks, buckets), buckets)
        judged = shared_table(self._judged(self._passages(blocks, answers, buckets, shards), shards))

        def cut(batches):
            for _, rows in _groups(_rows(batches), 0):
                yield from self._cut(Block(rows[0][3], self.words), rows[1:])
                give_back()

        out = blocks.unionByName(judged).repartition("block").sortWithinPartitions("block", "kind").mapInArrow(
            cut, "key long, n_tokens long, n_removed long, n_spans long, kept binary, extra string"
        )
        return (out if extra else out.drop("extra")).withColumnRenamed("key", key)

    def _cut(self, block: Block, rows):
        which, steps, count, first, copy = unpacked(rows[0][3], ["<u4", "<u4", "<u2", bool, "<u4"])
        start, count = np.cumsum(steps, dtype=np.int64), count.astype(np.int64)
        passages = int(which.max()) + 1 if len(which) else 0
        size = np.zeros(passages, np.int64)
        size[which] = count
        base = np.cumsum(size) - size
        gone = np.zeros(int(size.sum()) + 1, np.int32)
        for _, _, _, data in rows[1:]:
            own, begin, many = unpacked(data, ["<u4", "<u2", "<u2"])
            np.add.at(gone, base[own] + begin, 1)
            np.add.at(gone, base[own] + begin + many, -1)
        gone = np.cumsum(gone[:-1], dtype=np.int32) > 0
        cover = np.zeros(len(block.tokens) + 1, np.int32)
        # Every window of every place, some places at a time.
        for a, b in _portions(count, WINDOWS):
            many = count[a:b]
            shift = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            drop = gone[np.repeat(base[which[a:b]], many) + shift] | np.repeat(~first[a:b], many)
            window = (np.repeat(start[a:b], many) + shift)[drop]
            np.add.at(cover, window, 1)
            np.add.at(cover, window + self.length, -1)
        np.add.at(cover, block.first[copy], 1)
        np.add.at(cover, block.last[copy], -1)
        covered = np.cumsum(cover[:-1], dtype=np.int32) > 0
        del cover
        removed = _sums(covered)
        begins = covered.copy()
        begins[1:] &= ~covered[:-1]
        inner = block.first[(block.first > 0) & (block.first < len(covered))]
        begins[inner] = covered[inner]
        spans = _sums(begins)
        kept = []
        raw = None if self.words else np.frombuffer(block.joined, np.uint8)
        for t, (a, b) in enumerate(zip(block.first.tolist(), block.last.tolist(), strict=True)):
            if self.words:
                words = block.texts[t].split()
                kept.append(b" ".join(words if removed[a] == removed[b] else [words[i] for i in np.flatnonzero(~covered[a:b])]))
            else:
                kept.append(block.texts[t] if removed[a] == removed[b] else raw[a:b][~covered[a:b]].tobytes())
        ends, starts = block.last, block.first
        keys = pa.array(block.keys, pa.int64(), mask=block.nulls)
        numbers = (ends - starts, removed[ends] - removed[starts], spans[ends] - spans[starts])
        yield pa.RecordBatch.from_arrays(
            [keys, *(pa.array(x, pa.int64()) for x in numbers), pa.array(kept, pa.binary()), pa.array(block.extra, pa.string())],
            ["key", "n_tokens", "n_removed", "n_spans", "kept", "extra"],
        )


def _portions(sizes: np.ndarray, limit: int):
    """Ranges of neighbours that make up about ``limit``, or one larger neighbour."""
    part = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    return zip(edges[:-1], edges[1:], strict=True)


def _sums(flags: np.ndarray) -> np.ndarray:
    """How many are true before each place, and in all."""
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def _runs(flags: list[np.ndarray]):
    """Owner, first place and length of each run of true values."""
    sizes = np.array([len(f) for f in flags], np.int64)
    joined = np.concatenate(flags) if len(flags) else np.zeros(0, bool)
    first = np.cumsum(sizes) - sizes
    begins = joined.copy()
    begins[1:] &= ~joined[:-1]
    begins[first] = joined[first]
    ends = joined.copy()
    ends[:-1] &= ~joined[1:]
    ends[first + sizes - 1] = joined[first + sizes - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = np.searchsorted(first, begin, side="right") - 1
    return owner, begin - first[owner], end - begin


def _batch(rows) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)] or [[], [], [], []]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "kind", "bucket", "data"])


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in ("block", "kind", "bucket", "data"))


def _groups(rows, by: int):
    """Rows in order of a column, in lists of equal values."""
    held: list = []
    for row in rows:
        if held and held[0][by] != row[by]:
            yield held[0][by], held
            held = []
        held.append(row)
    if held:
        yield held[0][by], held
