"""SimHash fingerprints, linked by a self-join of a binary trie.

Two nodes of the trie are walked down together, the differing bits of their paths add up, and a
pair of nodes is left once the bits pass the error budget. The trie is cut into subtrees that
tasks walk on their own: fingerprints with at most ``budget`` differing bits are equal in one of
``budget + 1`` blocks of bits at least, so each fingerprint stands in as many tries, one with each
block on top, and only subtrees below one value of that block are walked. Subtrees that hold more
than ``LEAF`` fingerprints are walked further down by Spark first, so that no task gets more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.graph import components, forest
from pageloom.llm.tables import chunks
from pageloom.session import shared_table

WORDS = 3
SEED = 42
LEAF = 50_000
STEP = 6
SHINGLES = 1 << 15
FRONTIER = 1 << 20


def fingerprint(text: bytes) -> int:
    """A bit is 1 if it is set in over half of the hashes of the word shingles; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    total, count = np.zeros(64, np.int64), max(len(words) - WORDS + 1, 1)
    for start in range(0, count, SHINGLES):
        part = words[start : start + SHINGLES + WORDS - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(WORDS)))) if len(part) >= WORDS else [b" ".join(part)]
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``bits`` (the fingerprint as BIGINT) of every whole text; a null text is empty."""

    def made(batches):
        for keys, texts in chunks(batches, "key", "text"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([fingerprint(t) for t in texts], pa.int64())], ["key", "bits"]
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(made, "key long, bits long").withColumnRenamed("key", key)


def _blocks(budget: int) -> list[tuple[int, int]]:
    """First bit from the top, and width, of each block."""
    edges = [64 * i // (budget + 1) for i in range(budget + 2)]
    return list(zip(edges, np.diff(edges).tolist()))


def turned(bits: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Unsigned numbers rotated to the left."""
    by = by.astype(np.uint64)
    return (bits << by) | (bits >> ((np.uint64(64) - by) & np.uint64(63)))


def walk(values: np.ndarray, nodes: tuple[np.ndarray, ...], depth: int, budget: int):
    """Pairs of places in ``values`` with at most ``budget`` differing bits, in arrays.

    ``values`` are unsigned numbers, sorted within each subtree. ``nodes`` are pairs of trie nodes,
    as (low, high) places of each, and the bits that differ above ``depth``; a node is paired with
    itself or with another one.
    """
    todo = [(depth, *nodes)]
    while todo:
        depth, a, a_end, b, b_end, differ = todo.pop()
        single = (a_end - a == 1) & (b_end - b == 1)
        if single.any() or depth == 64:
            pick = single & (a != b)
            x, y = a[pick], b[pick]
            near = np.bitwise_count(values[x] ^ values[y]) <= budget
            yield x[near], y[near]
            a, a_end, b, b_end, differ = (v[~single] for v in (a, a_end, b, b_end, differ))
        if not len(a):
            continue
        if len(a) > FRONTIER:
            half = len(a) // 2
            todo += [(depth, *(v[:half] for v in (a, a_end, b, b_end, differ))), (depth, *(v[half:] for v in (a, a_end, b, b_end, differ)))]
            continue
        zeros = np.zeros(len(values) + 1, np.int64)
        np.cumsum((values >> np.uint64(63 - depth)) & np.uint64(1) ^ np.uint64(1), out=zeros[1:])
        a_mid = a + zeros[a_end] - zeros[a]
        b_mid = b + zeros[b_end] - zeros[b]
        other = a != b
        below = [
            (a, a_mid, b, b_mid, differ),
            (a_mid, a_end, b_mid, b_end, differ),
            (a, a_mid, b_mid, b_end, differ + 1),
            tuple(v[other] for v in (a_mid, a_end, b, b_mid, differ + 1)),
        ]
        a, a_end, b, b_end, differ = (np.concatenate(x) for x in zip(*below))
        keep = (a < a_end) & (b < b_end) & (differ <= budget) & ((a != b) | (a_end - a > 1))
        todo.append((depth + 1, *(v[keep] for v in (a, a_end, b, b_end, differ))))


def _under(bits: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, 64 - first - width).bitwiseAND(F.lit((1 << width) - 1))


def _subtrees(prints: DataFrame, budget: int, leaf: int) -> DataFrame:
    """``id, bits, block, depth, low, high``: pairs of trie nodes of one block's trie, with what they hold.

    The nodes are named by their bits from the top of the block on.
    """
    tries = [
        F.struct(F.lit(i).alias("block"), F.lit(w).alias("depth"), _under(F.col("bits"), f, w).alias("own"))
        for i, (f, w) in enumerate(_blocks(budget))
    ]
    state = prints.select("id", "bits", F.explode(F.array(*tries)).alias("t")).select("id", "bits", "t.*", F.col("t.own").alias("other"))
    pair = ["block", "depth", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    state = shared_table(state.select("id", "bits", "own", "other", *pair))
    done = []
    steps = [x for x in range(1 << STEP) if bin(x).count("1") <= budget]
    while True:
        hot = state.groupBy(*NODES).count().where((F.col("count") > leaf) & (F.col("depth") + STEP <= 62))
        hot = shared_table(hot.drop("count"))
        if hot.isEmpty():
            return state.unionByName(done[0]) if done else state
        cool = state.join(hot, [*NODES], "left_anti")
        done = [cool.unionByName(done[0]) if done else cool]
        # The bits below the node, in the order of the block's trie.
        top = F.element_at(F.array(*(F.lit(f) for f, _ in _blocks(budget))), F.col("block") + 1)
        at = (top + F.col("depth")) % 64
        ahead = F.shiftrightunsigned(_rotated(F.col("bits"), at), 64 - STEP)
        own = F.shiftleft(F.col("own"), STEP).bitwiseOR(ahead)
        wide = state.join(hot, [*NODES], "left_semi").withColumn("x", F.explode(F.array(*(F.lit(x).cast("long") for x in steps))))
        wide = wide.select(
            "id", "bits", "block", (F.col("depth") + STEP).alias("depth"), own.alias("own"),
            F.shiftleft(F.col("other"), STEP).bitwiseOR(ahead.bitwiseXOR(F.col("x"))).alias("other"),
        )
        wide = wide.where(F.bit_count(F.col("own").bitwiseXOR(F.col("other"))) <= budget)
        state = shared_table(wide.select("id", "bits", "own", "other", *pair))


def _rotated(bits: Column, by: Column) -> Column:
    """Shifts count modulo 64, so that a turn by 0 gives the same bits."""
    left = F.call_function("shiftleft", bits, by.cast("int"))
    return left.bitwiseOR(F.call_function("shiftrightunsigned", bits, (64 - by).cast("int")))


NODES = ("block", "depth", "low", "high")


def _arrays(batches):
    for batch in batches:
        if batch.num_rows:
            yield {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}


def _ends(rows: dict[str, np.ndarray]) -> np.ndarray:
    """Where the rows of each pair of nodes end."""
    change = np.zeros(len(rows["block"]) - 1, bool)
    for c in NODES:
        change |= rows[c][1:] != rows[c][:-1]
    return np.append(np.flatnonzero(change) + 1, len(rows["block"]))


def links(prints: DataFrame, budget: int = 2, leaf: int = LEAF, all_pairs: bool = False) -> DataFrame:
    """Links ``a`` - ``b`` between ids whose distinct fingerprints differ in at most ``budget`` bits.

    ``prints`` has ``id`` and ``bits``, each distinct. With ``all_pairs`` every pair comes out once;
    else each task keeps as many of its links as join the same ids, at most one per id.
    """
    blocks = _blocks(budget)
    first = np.array([f for f, _ in blocks])
    mask = np.array([((1 << w) - 1) << (64 - f - w) for f, w in blocks], np.uint64)

    def walked(batches):
        held = None
        for batch in _arrays(batches):
            held = batch if held is None else {c: np.concatenate([held[c], batch[c]]) for c in held}
            ends = _ends(held)
            if len(ends) < 2:
                continue
            cut = ends[-2]
            yield from found({c: v[:cut] for c, v in held.items()})
            held = {c: v[cut:] for c, v in held.items()}
        if held is not None:
            yield from found(held)

    def found(rows):
        ends = _ends(rows)
        starts = np.append(0, ends[:-1])
        many = ends - starts > 1
        starts, ends = starts[many], ends[many]
        if not len(starts):
            return
        take = np.repeat(starts - np.append(0, np.cumsum(ends - starts)[:-1]), ends - starts) + np.arange((ends - starts).sum())
        ends = np.cumsum(ends - starts)
        starts = np.append(0, ends[:-1])
        rows = {c: v[take] for c, v in rows.items()}
        group = np.repeat(np.arange(len(starts)), ends - starts)
        bits = rows["bits"].astype(np.int64).view(np.uint64)
        spun = turned(bits, first[rows["block"]])
        order = np.lexsort((spun, group))
        spun, bits, ids = spun[order], bits[order], rows["id"][order]
        own = rows["own"][order]
        low, high, block, depth = (rows[c][starts] for c in ("low", "high", "block", "depth"))
        # Where the second node of a pair begins.
        ones = np.add.reduceat((own != low[group]).astype(np.int64), starts)
        middle = np.where(low == high, starts, ends - ones)
        a, a_end = starts, np.where(low == high, ends, middle)
        b, b_end = middle, ends
        differ = np.bitwise_count((low ^ high).astype(np.uint64)).astype(np.int64)
        full = (a < a_end) & (b < b_end) & ((a != b) | (a_end - a > 1))
        xs, ys = [], []
        for d in np.unique(depth[full]):
            pick = full & (depth == d)
            for x, y in walk(spun, tuple(v[pick] for v in (a, a_end, b, b_end, differ)), int(d), budget):
                # A pair equal in an earlier block has been found there.
                apart = bits[x] ^ bits[y]
                new = np.ones(len(x), bool)
                for j in range(len(mask) - 1):
                    new &= ((apart & mask[j]) != 0) | (block[group[order]][x] <= j)
                xs.append(ids[x[new]])
                ys.append(ids[y[new]])
                if not all_pairs and sum(map(len, xs)) > FRONTIER:
                    xs, ys = ([v] for v in forest(np.concatenate(xs), np.concatenate(ys)))
        if xs:
            x, y = np.concatenate(xs), np.concatenate(ys)
            x, y = (x, y) if all_pairs else forest(x, y)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    state = _subtrees(prints, budget, leaf)
    return state.repartition(*NODES).sortWithinPartitions(*NODES).mapInArrow(walked, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = 2) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    Fingerprints of at most ``budget`` differing bits are linked; a component is named by its
    smallest key. Texts without words, null ones included, have fingerprint zero and are
    linked like any other. Repeated rows come out as often as they came in; rows without a key
    have a component only through other rows of the same fingerprint.
    """
    prints = shared_table(fingerprints(docs, key, text))
    first = shared_table(prints.groupBy("bits").agg(F.min(key).alias("id")))
    joined = components(links(first.where("id is not null"), budget))
    named = first.join(joined, F.col("id") == F.col("node"), "left").select(
        "bits", F.coalesce("component", "id").alias("component_id")
    )
    return prints.join(named, "bits").select(key, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
