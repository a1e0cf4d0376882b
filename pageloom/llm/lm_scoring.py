"""Log-probabilities of texts under a smoothed n-gram model of the corpus, by a weighted backoff automaton.

States are the contexts, up to ``ORDER - 1`` words, that the training texts hold. A state has an arc for each
word seen after it, weighted with the smoothed log-probability, to the longest suffix of context and word that is a state,
and a failure arc to its own suffix without the first word, weighted with the mass kept for unseen words. A text is scored by one
traversal from left to right that carries the state: take the failure arcs until there is an arc for the word.

Probabilities are smoothed with the next lower order as prior. With ``c`` the training counts,

    p(w | h) = (c(h w) + B * p(w | h without its first word)) / (c(h) + B)

where ``B`` is the mean number of different words after a context of that length, and without a context p is the
base model, (c(w) + 1) / (N + V + 1). The model is all n-grams of all training texts, without a cut-off, and as large as
the corpus, so no task holds it. Five steps:

1. texts are packed into blocks of some MB, written once;
2. each block sends its n-grams, each once, as 60-bit hashes with their counts in its training texts, to shards, each of
   which has a range of the hashes: evenly filled, however frequent an n-gram is;
3. a shard sums the counts and answers each block in the order in which it asked, so that no hash goes back;
4. the numbers of words and of different n-grams are summed over the shards;
5. a block lays out the part of the automaton that its texts reach and traverses it, with many texts side by side.

Two n-grams of equal hash and order, one pair in some 10^18, would be taken as one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.repeats import packed, unpacked
from pageloom.llm.tables import chunks, give_back, mixed
from pageloom.session import shared_table

ORDER = 3
BLOCK_BYTES = 8 << 20
# Tokens of a text that one lane of the traversal scores.
LANE = 1_024
# The last bits of an n-gram's hash hold its order; 0 is the start of a text.
TAG = 3
START, END = (np.uint64(x) for x in (0x8F1BBCDC5A827999, 0xCA62C1D66ED9EBA1))
SCHEMA = "block long, kind int, bucket int, data binary, stats array<long>"
NAMES = ["block", "kind", "bucket", "data", "stats"]


def planes(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second ones, so that equal bytes pack well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def unplanes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(np.frombuffer(raw, np.uint8).reshape(width, -1).T.tobytes(), kind)


class Block:
    """Tokens of the texts of a block, each text with a start before it, and their n-grams."""

    def __init__(self, data: bytes, order: int):
        self.keys, self.nulls, self.train, lengths, joined = unpacked(data, ["<i8", bool, bool, "<i8", bytes])
        ends = np.cumsum(lengths)
        names: dict[bytes, int] = {}
        ids = [
            np.array([names.setdefault(w, len(names)) for w in joined[e - n : e].split()], np.int32)
            for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)
        ]
        known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
        #: Words of each text and its end.
        self.sizes = np.fromiter(map(len, ids), np.int64, len(ids)) + 1
        last = np.cumsum(self.sizes + 1)
        self.first = last - self.sizes - 1
        n = int(last[-1]) if len(last) else 0
        value = np.empty(n, np.uint64)
        inner = np.ones(n, bool)
        inner[self.first] = inner[last - 1] = False
        value[inner] = known[np.concatenate(ids)] if ids else 0
        value[self.first] = START
        value[last - 1] = END
        value = mixed(value)
        self.text = np.repeat(np.arange(len(ids), dtype=np.int32), self.sizes + 1)
        self.place = (np.arange(n) - self.first[self.text]).astype(np.int32)
        #: Hash of the n-gram that ends at each place, by order; a text of fewer tokens before the place has none.
        self.grams = [value]
        for k in range(2, order + 1):
            gram = np.empty_like(value)
            gram[:1] = 0
            np.multiply(self.grams[-1][:-1], np.uint64(0x9E3779B97F4A7C15), out=gram[1:])
            gram[1:] += value[1:]
            self.grams.append(mixed(gram))

    def places(self, k: int) -> np.ndarray:
        """Where an n-gram of ``k`` tokens, the start among them, ends."""
        return np.flatnonzero(self.place >= k - 1)

    def tagged(self) -> np.ndarray:
        """Hashes of all n-grams, 63 bits with their order in the last ones, order by order and place by place."""
        at = [self.places(k) for k in range(1, len(self.grams) + 1)]
        values = np.empty(sum(map(len, at)), np.uint64)
        end = 0
        for k, (gram, own) in enumerate(zip(self.grams, at, strict=True), 1):
            part = values[end : end + len(own)]
            end += len(own)
            np.take(gram, own, out=part)
            part >>= np.uint64(1)
            part &= ~np.uint64((1 << TAG) - 1)
            part |= np.where(self.place[own] > 0, k, 0).astype(np.uint8)
        return values

    def asked(self):
        """The different n-grams in order, and how often each stands in the training texts."""
        values = self.tagged()
        train = self.train[self.text].view(np.uint8)
        train = np.concatenate([train[self.places(k)] for k in range(1, len(self.grams) + 1)])
        self.grams.clear()
        # Sorted with a last bit that says whether the place is in a training text.
        values <<= np.uint64(1)
        values |= train
        values.sort()
        train = (values & np.uint64(1)).astype(np.uint8)
        values >>= np.uint64(1)
        begin = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
        counts = np.add.reduceat(train, begin, dtype=np.int64) if len(begin) else np.zeros(0, np.int64)
        return values[begin], counts.astype("<u4")


def buckets_of(values: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hashes, which are 63 bits long."""
    return ((values >> np.uint64(39)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """Tokens ``N``, different tokens ``V`` and the prior's weight of each order from 2 on."""

    tokens: int
    types: int
    priors: tuple[float, ...]


class Automaton:
    """The states and arcs that the texts of a block reach, by the place where the text reaches them."""

    def __init__(self, block: Block, counts: np.ndarray, model: Model):
        """``counts``: training counts of the n-grams that end at each place, by order; 0 where there is none."""
        self.block, self.counts = block, counts
        order, n = self.counts.shape
        p = (self.counts[0] + 1) / (model.tokens + model.types + 1)
        self.base = np.log10(p)
        self.arc = np.empty((order, n))
        self.arc[0] = self.base
        #: Of the state of k words that ends at a place, at k - 1.
        self.fail = np.zeros((max(order - 1, 1), n))
        for k in range(1, order):
            context = np.append(0, self.counts[k - 1][:-1])
            prior = model.priors[k - 1]
            p = (self.counts[k] + prior * p) / (context + prior)
            self.arc[k] = np.log10(p)
            self.fail[k - 1] = np.log10(prior / (self.counts[k - 1] + prior))

    def lanes(self, width: int):
        """First place to read, last one, places to read before scoring, and whether the text begins there.

        After ``order - 1`` words a state depends on these words alone, so a long text is taken in lanes, each of which
        reads the words before it to reach the state that the lane before leaves.
        """
        width = max(width, len(self.counts))
        sizes, first = self.block.sizes, self.block.first + 1
        number = -(-sizes // width)
        owner = np.repeat(np.arange(len(sizes)), number)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        begin = nth * width
        skip = np.where(nth > 0, np.minimum(begin, len(self.counts) - 1), 0)
        end = np.minimum(begin + width, sizes[owner])
        return owner, first[owner] + begin - skip, first[owner] + end, skip, nth == 0

    def scores(self, width: int = LANE) -> np.ndarray:
        """Log-probability of each text."""
        owner, begin, end, skip, starts = self.lanes(width)
        order = np.argsort(begin - end, kind="stable")
        owner, begin, skip, starts, size = owner[order], begin[order], skip[order], starts[order], (end - begin)[order]
        top = len(self.counts)
        total = np.zeros(len(owner))
        # The state: so many words before the place, of which the start of the text is one.
        state = np.where(starts & (self.counts[0][begin - 1] > 0), min(1, top - 1), 0) if len(owner) else np.zeros(0, np.int64)
        # At step t the first lanes, the longest, still have tokens.
        alive = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")
        for t, n in enumerate(alive.tolist()):
            at, arc = begin[:n] + t, state[:n]
            weight = np.zeros(n)
            for _ in range(top - 1):
                stuck = np.flatnonzero((arc > 0) & (self.counts[arc, at] == 0))
                if not len(stuck):
                    break
                weight[stuck] += self.fail[arc[stuck] - 1, at[stuck] - 1]
                arc[stuck] -= 1
            weight += self.arc[arc, at]
            total[:n] += np.where(t >= skip[:n], weight, 0.0)
            state[:n] = np.minimum(np.where(self.counts[arc, at] > 0, arc + 1, 0), top - 1)
        found = np.zeros(len(self.block.sizes))
        np.add.at(found, owner, total)
        return found


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in ("block", "kind", "bucket", "data"))


def _groups(rows, by: int):
    held: list = []
    for row in rows:
        if held and held[0][by] != row[by]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held
    give_back()


def _batch(rows) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows, strict=True)] or [[], [], [], [], []]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def _blocks(docs: DataFrame, train: Column, key: str, text: str, size: int) -> DataFrame:
    def made(batches):
        number = TaskContext.get().partitionId() << 32
        for keys, texts, learnt in chunks(batches, "key", "text", size, "train"):
            data = packed([
                np.array([0 if k is None else k for k in keys], "<i8"), np.array([k is None for k in keys], bool), np.array(learnt, bool),
                np.array([len(t) for t in texts], "<i8"), b"".join(texts).lower(),
            ], 6)
            yield _batch([(number, 0, 0, data, None)])
            number += 1

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    return shared_table(rows.mapInArrow(made, SCHEMA))


def _ask(blocks: DataFrame, buckets: int, order: int) -> DataFrame:
    def asked(batches):
        for ((number, _, _, data),) in _groups(_rows(batches), 0):
            values, counts = Block(data, order).asked()
            cut = np.searchsorted(buckets_of(values, buckets), np.arange(buckets + 1)).tolist()
            steps = np.diff(values, prepend=np.uint64(0))
            first = [a for a in cut[:-1] if a < len(values)]
            steps[first] = values[first]
            yield _batch([
                (number, 0, i, packed([planes(steps[a:b]), planes(counts[a:b])], 1), None)
                for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if b > a
            ])

    return blocks.mapInArrow(asked, SCHEMA)


def _answer(asked: DataFrame, buckets: int, order: int) -> DataFrame:
    """A row per asking row with the sums of its n-grams, and one with the shard's tokens and different n-grams by order."""

    def answered(batches):
        for rows in _groups(_rows(batches), 2):
            parts, counts = [], []
            for _, _, _, data in rows:
                steps, own = unpacked(data, [bytes, bytes])
                parts.append(np.cumsum(unplanes(steps, "<u8"), dtype=np.uint64))
                counts.append(unplanes(own, "<u4"))
            values = np.concatenate(parts)
            by = np.argsort(values)
            values = values[by]
            begin = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
            sums = np.add.reduceat(np.concatenate(counts)[by].astype(np.int64), begin)
            tag = (values[begin] & np.uint64((1 << TAG) - 1)).astype(np.int64)
            seen = sums > 0
            types = np.bincount(tag[seen], minlength=order + 1)
            found = np.empty(len(values), np.int64)
            found[by] = np.repeat(sums, np.diff(np.append(begin, len(values))))
            ends = np.cumsum([len(part) for part in parts]).tolist()
            out = [(-1, 2, rows[0][2], None, [int(sums[tag == 1].sum()), *types.tolist()])]
            for (number, _, bucket, _), part, end in zip(rows, parts, ends, strict=True):
                own = found[end - len(part) : end]
                out.append((number, 1, bucket, packed([planes(own.astype("<u8"))], 3), None))
            yield _batch(out)

    return shared_table(asked.repartitionById(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(answered, SCHEMA))


def _model(answers: DataFrame, order: int) -> Model:
    sums = answers.where("kind = 2").agg(*(F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0)) for i in range(order + 2))).first()
    tokens, types = sums[0], sums[2:]
    # Starts of texts are contexts too, of one word.
    lower = [types[0] + sums[1], *types[1:]]
    return Model(tokens, types[0], tuple(max(1.0, types[k] / max(1, lower[k - 1])) for k in range(1, order)))


def _scored(block: Block, rows, model: Model, order: int, lane: int) -> pa.RecordBatch:
    sums = np.concatenate([unplanes(unpacked(data, [bytes])[0], "<u8") for _, _, _, data in rows] or [np.zeros(0, "<u8")])
    values = block.tagged()
    block.grams.clear()
    by = np.argsort(values)
    values = values[by]
    nth = np.cumsum(np.append(False, values[1:] != values[:-1]) if len(values) else [], dtype=np.int32)
    if len(sums) != (int(nth[-1]) + 1 if len(nth) else 0):
        raise RuntimeError("the answers do not fit the block that asked")
    found = np.empty(len(values), np.int64)
    found[by] = sums[nth]
    del values, by, nth, sums
    counts, end = np.zeros((order, len(block.place)), np.int64), 0
    for k in range(order):
        at = block.places(k + 1)
        counts[k, at] = found[end : end + len(at)]
        end += len(at)
    del found
    automaton = Automaton(block, counts, model)
    token = block.place > 0
    base = np.bincount(block.text[token], automaton.base[token], len(block.sizes))
    known = np.bincount(block.text[token], counts[0][token] > 0, len(block.sizes)).astype(np.int64)
    arrays = [
        pa.array(block.keys, pa.int64(), mask=block.nulls), pa.array(block.sizes, pa.int64()), pa.array(known, pa.int64()),
        pa.array(base, pa.float64()), pa.array(automaton.scores(lane), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["key", "n_tokens", "n_known", "base_score", "score"])


def score(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", order: int = ORDER, block_bytes: int = BLOCK_BYTES,
    shards: int | None = None, lane: int = LANE,
) -> DataFrame:
    """``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every whole text.

    ``train`` says which rows the model is learned from. Tokens are the runs of bytes other than ASCII white space, with A-Z
    in lower case, and one end per text, so a null or empty text has one token. ``n_known`` tokens stand in the
    training texts, which have ``train_tokens``. ``base_score`` is the log10 probability without context,
    ``score`` with up to ``order - 1`` tokens of it. Repeated rows are learned from, and come out, as often as they came in.
    With nothing to learn from every token has probability 1. A text of any length is scored whole.
    """
    if not 1 <= order < 1 << TAG:
        raise ValueError(f"order is 1 to {(1 << TAG) - 1}")
    blocks = _blocks(docs, train, key, text, block_bytes)
    # A block has some three n-grams per word and a shard answers for about as many different ones.
    buckets = shards or max(8, blocks.count())
    answers = _answer(_ask(blocks, buckets, order), buckets, order)
    model = _model(answers, order)

    def scored(batches):
        for rows in _groups(_rows(batches), 0):
            yield _scored(Block(rows[0][3], order), rows[1:], model, order, lane)

    joined = blocks.unionByName(answers.where("kind = 1")).repartition("block").sortWithinPartitions("block", "kind", "bucket")
    out = joined.mapInArrow(scored, "key long, n_tokens long, n_known long, base_score double, score double")
    return out.select(F.col("key").alias(key), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
