"""Near copies of texts: every pair whose sets of word shingles have a Jaccard similarity of ``SIMILAR`` at least.

Pairs are found by the prefix filter. With the shingles of every text in one common order, the first
fifth of the shingles of two such texts have a shingle in common, so only texts that meet there are
compared. The order decides what is compared and never what is found: a sketch of all texts counts their
shingles, and frequent ones stand last, so that texts with a passage in common meet only if little else is
in them. Candidates whose parities of shingles differ in more bits than similar sets can are dropped, the
others are confirmed by their whole sets. The texts of a meeting place are compared with a few of them, in
some turns; what this links is not compared with each other again. The texts of one group mostly meet at many places,
and the same few are picked at all of them.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.graph import components
from pageloom.llm.tables import Words, chunks, give_back, mixed
from pageloom.session import Scratch, shared_table

WORDS = 5
# Four fifths; shares are compared in whole numbers.
SIMILAR = (4, 5)
# Counters of shingles, whose 16 bits each go to all tasks. A counter holds the shingles that fall into it, so on
# more text only passages of more documents stand out.
CELLS = 1 << 23
PART = 1 << 16
# Counts are told apart to within about an eighth of their standard deviation.
STEPS = 8
# 64-bit words of a set's parities, and of those of larger classes that go with its shingles.
PARITY, FOLD = 16, 4
# Texts of a meeting place that its others are compared with, and turns of this, before what is left is compared pair by pair.
PIVOTS, TURNS = 4, 2


def shingle_sets(texts: list[bytes]):
    """Sorted distinct 64-bit hashes of the shingles of each text; fewer words than a shingle has are one shingle."""
    words = Words([t.lower() for t in texts])
    odd = mixed(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)
    for a, b in zip(words.first.tolist(), words.last.tolist(), strict=True):
        h, n = words.hash[a:b], max(b - a - WORDS + 1, min(b - a, 1))
        total = np.zeros(n, np.uint64)
        for i in range(min(b - a, WORDS)):
            total += h[i : i + n] * odd[i]
        yield np.unique(mixed(total))


def _node(found: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True)


def _packed(counts: np.ndarray) -> bytes:
    """16-bit numbers, low bytes first, compressed: the high ones are mostly zero."""
    return pa.compress(counts.view(np.uint8).reshape(-1, 2).T.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 2 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(2, n).T).reshape(-1).view(np.uint16)


def _crowding(texts: DataFrame, cells: int) -> np.ndarray:
    """How often the shingles of a cell occur, in steps of the root: ``cells`` numbers, a power of two, of 16 bits.

    Tasks count into an array each and send it in parts, which are summed where they meet.
    """
    part = min(cells, PART)

    def counted(batches):
        counts = np.zeros(cells, np.uint32)
        for _, texts_ in chunks(batches, "key", "text"):
            for found in shingle_sets(texts_):
                np.add.at(counts, (found & np.uint64(cells - 1)).astype(np.int64), 1)
        for i in range(cells // part):
            own = counts[i * part : (i + 1) * part]
            if own.any():
                sent = _packed(np.minimum(own, 65535).astype(np.uint16))
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([sent], pa.binary())], ["part", "counts"])
        del counts
        give_back()

    def summed(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, sent in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = _unpacked(sent.as_py(), part)
                total[i] = total[i] + counts if i in total else counts.astype(np.uint64)
        for i, counts in total.items():
            level = np.minimum(np.sqrt(counts) * STEPS, 65535).astype(np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([_packed(level)], pa.binary())], ["part", "counts"])
        give_back()

    schema = "part int, counts binary"
    levels = np.zeros(cells, np.uint16)
    for i, sent in texts.mapInArrow(counted, schema).repartition("part").mapInArrow(summed, schema).collect():
        levels[i * part : (i + 1) * part] = _unpacked(bytes(sent), part)
    return levels


def _parity(found: np.ndarray) -> np.ndarray:
    """The parity of the number of shingles in each of ``64 * PARITY`` classes of hashes.

    Two sets' parities differ in no more bits than there are shingles in one set alone.
    """
    held = np.bincount((found >> np.uint64(32)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(held.astype(np.uint8)).view(np.int64)


def _prefixes(texts: DataFrame, sent: Broadcast) -> DataFrame:
    """``key``, ``mark``, ``node`` (a hash of the set of shingles), ``n`` of them, the first ones in the common order, ``parity``."""

    def made(batches):
        levels = sent.value
        for keys, part, marks in chunks(batches, "key", "text", extra="mark"):
            nodes, sizes, first, parity = [], [], [], []
            for found in shingle_sets(part):
                n = len(found)
                level = levels[(found & np.uint64(len(levels) - 1)).astype(np.int64)]
                nodes.append(_node(found))
                sizes.append(n)
                most = n - -(-SIMILAR[0] * n // SIMILAR[1]) + 1 if n else 0
                first.append(found[np.lexsort((found, level))[:most]].view(np.int64))
                parity.append(_parity(found))
            columns = [pa.array(x, pa.int64()) for x in (keys, marks, nodes, sizes)] + [pa.array(x, pa.list_(pa.int64())) for x in (first, parity)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "mark", "node", "n", "first", "parity"])
        give_back()

    return texts.mapInArrow(made, "key long, mark long, node long, n long, first array<long>, parity array<long>")


def _sets(texts: DataFrame) -> DataFrame:
    def made(batches):
        for _, part in chunks(batches, "key", "text"):
            found = list(shingle_sets(part))
            columns = [pa.array([_node(x) for x in found], pa.int64()), pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])
        give_back()

    return texts.mapInArrow(made, "node long, shingles array<long>").dropDuplicates(["node"])


def _may_be_similar() -> Column:
    """False if the sets are too unlike even if all after the places of a first common shingle agree, or by their parities."""
    n, m = F.col("n"), F.col("m")
    bits = sum(F.bit_count(F.col("fold")[i].bitwiseXOR(F.col("other_fold")[i])) for i in range(FOLD))
    enough = F.least(n - F.col("at"), m - F.col("other_at")) * sum(SIMILAR) >= (n + m) * SIMILAR[0]
    return enough & (bits * sum(SIMILAR) <= (n + m) * (SIMILAR[1] - SIMILAR[0]))


def _near(pairs: DataFrame, one: DataFrame) -> DataFrame:
    """``pairs`` without those whose parities tell that the sets differ in more shingles than similar sets do."""
    x, y = (one.select(F.col("node").alias(at), F.col("n").alias(f"n_{at}"), F.col("parity").alias(f"parity_{at}")) for at in "ab")
    bits = sum(F.bit_count(F.col("parity_a")[i].bitwiseXOR(F.col("parity_b")[i])) for i in range(PARITY))
    few = bits * sum(SIMILAR) <= (F.col("n_a") + F.col("n_b")) * (SIMILAR[1] - SIMILAR[0])
    return pairs.join(x, "a").join(y, "b").where(few).select("a", "b")


def _links(texts: DataFrame, keys: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Those of the pairs ``a`` - ``b`` of nodes that are similar."""
    own = Scratch()
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = own.table(keys.join(nodes, "node", "left_semi").select("key").distinct())
    sets = own.table(_sets(texts.join(wanted, "key", "left_semi")))
    both = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    common = F.size(F.array_intersect("x", "y"))
    found = scratch.table(both.where(common * sum(SIMILAR) >= (F.size("x") + F.size("y")) * SIMILAR[0]).select("a", "b"))
    own.drop()
    return found


OWN, OTHER = ("node", "n", "at", "c", "fold"), ("other", "m", "other_at", "other_c", "other_fold")


def _pivots(turn: int) -> Column:
    """Some of the texts that meet at a shingle, others in each turn. The order of texts is the same at every shingle."""
    text = F.struct(*(F.col(x).alias(y) for x, y in zip(OWN, OTHER, strict=True)))
    return F.array_distinct(F.array(*(F.min_by(text, F.xxhash64("node", F.lit(turn * PIVOTS + i))) for i in range(PIVOTS)))).alias("pivots")


def _apart(rows: DataFrame) -> DataFrame:
    """Texts that meet at a shingle and are in different components: those outside its largest component, with all others."""
    largest = rows.groupBy("shingle", "c").count().groupBy("shingle").agg(F.max_by("c", F.struct("count", "c")).alias("largest"))
    rest = rows.join(largest, "shingle").where("c <> largest")
    other = [F.col(x).alias(y) for x, y in zip(OWN, OTHER, strict=True)]
    met = rest.join(rows.select("shingle", *other), "shingle")
    return met.where("c <> other_c and (other_c = largest or node < other)")


def _pairs(found: DataFrame) -> DataFrame:
    """Distinct pairs ``a`` - ``b``."""
    return found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _grouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct pairs ``a`` - ``b`` of one node of each group and each of its others."""
    members = rows.join(groups.select("mark", "group").distinct(), "mark").select("group", "node").distinct()
    least = members.groupBy("group").agg(F.min("node").alias("a"))
    return members.join(least, "group").where("a < node").select("a", F.col("node").alias("b")).distinct()


def near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", cells: int = CELLS, mark: Column | None = None, groups: DataFrame | None = None
) -> DataFrame:
    """``key`` and ``component_id`` of every row of ``docs``.

    Texts are linked if their sets of shingles of ``WORDS`` words have a Jaccard similarity of
    ``SIMILAR`` at least, compared as 64-bit hashes; ASCII case does not count. A component is named
    by its smallest key. Texts without words, null ones included, are linked with each other. Repeated
    rows come out as often as they came in; rows without a key have a component only through
    other rows of the same set. With a BIGINT ``mark``, which tells rows of one key apart, the rows carry it and
    ``component_mark``, the smallest mark of the component's rows of the smallest key. ``cells`` is a power of two.
    ``groups`` may bring ``mark`` and ``group`` of rows that another method found alike, such as SimHash: their sets are
    compared first, each with one of its group. What this links is not compared again.
    """
    scratch = Scratch()
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    marked = docs.select(
        F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"), (F.lit(None).cast("long") if mark is None else mark).alias("mark")
    )
    whole = Scratch()
    sent = docs.sparkSession.sparkContext.broadcast(_crowding(texts, cells))
    prints = whole.table(_prefixes(marked, sent))
    sent.destroy()
    named_rows = scratch.table(prints.select("key", "mark", "node"))
    # All rows of a node have the same set.
    one = prints.where("key is not null").groupBy("node").agg(
        F.min(F.struct("key", "mark")).alias("low"), F.first("n").alias("n"), F.first("first").alias("first"), F.first("parity").alias("parity")
    )
    one = scratch.table(one)
    whole.drop()
    keys = one.select("node", "low.key")
    words = [F.col("parity")[i] for i in range(PARITY)]
    folds = one.select("node", F.array(*(reduce(Column.bitwiseXOR, words[i::FOLD]) for i in range(FOLD))).alias("fold"))
    tried = links = joined = None
    if groups is not None:
        tried = scratch.table(_near(_grouped(named_rows, groups), one))
        links = _links(texts, keys, tried, scratch)
        joined = shared_table(components(links))
    alike = one.withColumn("component", F.col("node")) if joined is None else one.join(joined, "node", "left")
    rows = alike.select("node", "n", F.posexplode("first").alias("at", "shingle"), F.coalesce("component", "node").alias("c"))
    rows = rows.repartition("shingle")
    several = rows.groupBy("shingle").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("shingle")
    rows = scratch.table(rows.join(several, "shingle").join(folds, "node"))
    may = _may_be_similar()
    for turn in range(TURNS + 1):
        # Places where all are in one component are done with.
        rows = rows.repartition("shingle")
        open_ = rows.groupBy("shingle").agg(F.min("c").alias("low"), F.max("c").alias("high"), _pivots(turn)).where("low < high")
        if turn < TURNS:
            rows = scratch.table(rows.join(open_.select("shingle", "pivots"), "shingle"))
            met = rows.select(*OWN, F.explode("pivots").alias("pivot")).select("*", "pivot.*")
            pairs = _pairs(met.where("c <> other_c").where(may))
        else:
            rows = scratch.table(rows.join(open_.select("shingle"), "shingle"))
            pairs = _pairs(_apart(rows).where(may))
        pairs = _near(pairs.join(tried, ["a", "b"], "left_anti") if tried else pairs, one)
        pairs = scratch.table(pairs)
        tried = tried.unionByName(pairs) if tried else pairs
        found = _links(texts, keys, pairs, scratch)
        links = links.unionByName(found) if links else found
        if joined is None or not found.isEmpty():
            joined = shared_table(components(links))
        rows = rows.drop("c", "pivots").join(joined, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    named = one.select("node", "low").join(joined, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = named.groupBy("c").agg(F.min("low").alias("least"))
    named = scratch.table(named.join(least, "c").select("node", F.col("least.key").alias("component_id"), F.col("least.mark").alias("component_mark")))
    out = named_rows.join(named, "node", "left").select(F.col("key").alias(key), "component_id", *([] if mark is None else ["mark", "component_mark"]))
    out = shared_table(out)
    scratch.drop()
    return out
