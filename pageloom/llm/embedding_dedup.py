"""Embedding near-dedup by an epsilon grid order join.

Unit vectors are laid on a grid over their leading principal directions, with cells as wide as the
largest distance of a linked pair, and sorted by cell. The sorted sequence is cut into intervals, and
intervals are joined recursively: two of them are left if the boxes around them lie farther apart
than that distance. Spark joins intervals of blocks, then blocks; a task goes on with the rows of two
blocks. Equal vectors are one row with a count from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.graph import components, forest
from pageloom.session import shared_table

COSINE = 0.93
DIRECTIONS = 4
# Rows that the principal directions are fitted on; they steer the order, never the result.
SAMPLE = 4_000
BLOCK = 2_048
LEAF = 256
# Bits of a block's number within its partition, which has fewer rows than that, and bits that a step of the recursion takes.
WITHIN = 33
STEP = 6


def _directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions for each length of vector, from a bounded sample."""
    total = rows.count()
    part = max(1, total // SAMPLE)
    found: dict[int, list] = {}
    for r in rows.where(F.pmod(F.xxhash64("id"), F.lit(part)) == 0).select("embedding").limit(SAMPLE).collect():
        found.setdefault(len(r.embedding), []).append(r.embedding)
    out = {}
    for size, vectors in found.items():
        x = np.array(vectors, np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        _, directions = np.linalg.eigh(np.cov(x, rowvar=False, bias=True).reshape(size, size))
        out[size] = directions[:, ::-1][:, :DIRECTIONS].T.copy()
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares of very large or small components stay finite.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _placed(unit: np.ndarray, directions: np.ndarray | None) -> np.ndarray:
    """Coordinates that never lie farther apart than the vectors: leading directions and the length of the rest."""
    size = unit.shape[1]
    basis = np.eye(size)[:DIRECTIONS] if directions is None else directions
    lead = np.zeros((len(unit), DIRECTIONS))
    lead[:, : len(basis)] = unit @ basis.T
    rest = np.sqrt(np.maximum(0, 1 - (lead**2).sum(axis=1)))
    return np.column_stack([lead, rest])


def _apart(low_a, high_a, low_b, high_b) -> float:
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float((gap**2).sum())


def joined(a: np.ndarray, place_a: np.ndarray, b: np.ndarray, place_b: np.ndarray, cosine: float, reach: float, same: bool):
    """Places of linked pairs of two sorted sequences, by recursion over their halves; of one sequence, each pair once."""
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if same and k + m < i + j:
            continue
        if _apart(place_a[i:j].min(0), place_a[i:j].max(0), place_b[k:m].min(0), place_b[k:m].max(0)) > reach:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            x, y = np.nonzero(a[i:j] @ b[k:m].T >= cosine)
            x, y = x + i, y + k
            if same:
                x, y = x[x < y], y[x < y]
            if len(x):
                yield x, y
            continue
        rows = [(i, j)] if j - i <= LEAF else [(i, (i + j) // 2), ((i + j) // 2, j)]
        columns = [(k, m)] if m - k <= LEAF else [(k, (k + m) // 2), ((k + m) // 2, m)]
        todo += [(*r, *c) for r in rows for c in columns]


def _blocks(rows: DataFrame, directions: dict[int, np.ndarray], reach: float, block: int) -> DataFrame:
    """Blocks of the sorted sequence: number, label, length of vector, box, and the rows."""
    width = float(np.sqrt(reach))

    def placed(batches):
        for batch in batches:
            values = batch.column("embedding")
            sizes = np.diff(values.offsets.to_numpy())
            flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            cells: list = [None] * len(sizes)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                unit = _unit(flat[(ends[own] - size)[:, None] + np.arange(size)])
                grid = np.floor(_placed(unit, directions.get(int(size)))[:, :DIRECTIONS] / width).astype(np.int32)
                for i, cell in zip(own.tolist(), grid.tolist(), strict=True):
                    cells[i] = cell
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "cell"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    sequence = rows.mapInArrow(placed, f"{kinds}, cell array<int>")
    order = ["label", "size", *(F.col("cell")[i] for i in range(DIRECTIONS)), "id"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches):
        number, held = TaskContext.get().partitionId() << WITHIN, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("label", "size", "id", "many", "embedding")), strict=True):
                if held and (held[0][:2] != row[:2] or len(held) == block):
                    yield _block(number, held)
                    number += 1
                    if not number % (1 << WITHIN):
                        raise OverflowError("a partition has too many blocks")
                    held = []
                held.append(row)
        if held:
            yield _block(number, held)

    def _block(number, held):
        label, size = held[0][:2]
        unit = _unit(np.array([r[4] for r in held], np.float64))
        place = _placed(unit, directions.get(size))
        columns = [[number], [label], [size], [place.min(0).tolist()], [place.max(0).tolist()], [[r[2] for r in held]], [[r[3] for r in held]], [unit.tobytes()]]
        kinds = (pa.int64(), pa.int64(), pa.int32(), *[pa.list_(pa.float64())] * 2, *[pa.list_(pa.int64())] * 2, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], BLOCK_NAMES)

    return shared_table(sequence.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(cut, BLOCK_SCHEMA))


BLOCK_NAMES = ["block", "label", "size", "low", "high", "ids", "many", "unit"]
BLOCK_SCHEMA = "block long, label long, size int, low array<double>, high array<double>, ids array<long>, many array<long>, unit binary"


def _near(reach: float) -> Column:
    gaps = [F.greatest(F.lit(0.0), F.col("a.low")[i] - F.col("b.high")[i], F.col("b.low")[i] - F.col("a.high")[i]) for i in range(DIRECTIONS + 1)]
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= reach


def _block_pairs(blocks: DataFrame, reach: float) -> DataFrame:
    """Pairs of blocks, smaller number first, whose boxes are near: intervals of 64 times fewer blocks are joined first."""
    narrow = blocks.select("block", "label", "size", "low", "high")
    most = narrow.agg(F.max("block")).first()[0] or 0
    shift = -(-most.bit_length() // STEP) * STEP
    pairs = narrow.select("label", "size").distinct().select("label", "size", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    while shift:
        shift -= STEP
        low, high = (F.array(*(f(F.col(c)[i]) for i in range(DIRECTIONS + 1))).alias(c) for f, c in ((F.min, "low"), (F.max, "high")))
        level = narrow.groupBy("label", "size", F.shiftright("block", shift).alias("node")).agg(low, high)
        level = level.withColumn("up", F.shiftright("node", STEP))
        a, b = (
            level.select("label", "size", F.col("up").alias(up), F.struct("node", "low", "high").alias(side))
            for side, up in (("a", "x"), ("b", "y"))
        )
        pairs = pairs.join(a, ["label", "size", "x"]).join(b, ["label", "size", "y"])
        pairs = pairs.where(F.col("a.node") <= F.col("b.node")).where(_near(reach))
        pairs = shared_table(pairs.select("label", "size", F.col("a.node").alias("x"), F.col("b.node").alias("y")))
    return pairs.select("x", "y")


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE, block: int = BLOCK
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    Rows of equal label whose vectors have a cosine of at least ``cosine``, in double precision,
    are linked; ``n_links`` counts the other rows linked directly, copies included. A component is named
    by its smallest key, whose row is kept. Rows with a null key or label, or a vector that is null, empty,
    zero or holds a null or non-finite component, are linked with nothing, as are vectors of
    different lengths. Repeated rows are copies of each other.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine must lie in (0, 1]")
    # The largest squared distance of linked unit vectors, and room for rounding.
    reach = 2 - 2 * cosine + 1e-9
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(embedding, lambda x: x != 0)
    fit = F.coalesce(F.col(key).isNotNull() & F.col(label).isNotNull() & whole, F.lit(False))
    e = F.col(embedding).cast("array<double>")
    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), e.alias("embedding"), fit.alias("fit")
    ).withColumns({"h": F.xxhash64("embedding"), "g": F.xxhash64(F.lit(7), F.reverse("embedding"))})
    same = ["label", "h", "g"]
    classes = rows.where("fit").groupBy(*same).agg(
        F.min("id").alias("id"), F.count("*").alias("many"), F.any_value("embedding").alias("embedding")
    )
    classes = shared_table(classes.withColumn("size", F.size("embedding")))
    vectors = classes.select("label", "size", "id", "many", "embedding")
    directions = _directions(vectors)
    blocks = _blocks(vectors, directions, reach, block)
    pairs = _block_pairs(blocks, reach)
    columns = ("size", "ids", "many", "unit")
    x, y = (blocks.select(F.col("block").alias(p), *(F.col(c).alias(f"{c}_{p}") for c in columns)) for p in "xy")
    both = pairs.join(x, "x").join(y, "y")
    found = shared_table(both.mapInArrow(_linked(cosine, reach, directions), "a long, b long, n long"))
    links = found.where("b is not null").select("a", "b")
    counts = found.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    named = classes.select(*same, "id", "many").join(counts, "id", "left")
    named = named.join(components(links), F.col("id") == F.col("node"), "left").select(
        *same, (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    alone = rows.select("id", "fit", *(F.when(F.col("fit"), F.col(c)).alias(c) for c in same))
    out = alone.join(named, same, "left").select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _linked(cosine: float, reach: float, directions: dict[int, np.ndarray]):
    """Links kept by a block pair (as a forest), and links counted, of the rows of two blocks."""

    def linked(batches):
        for batch in batches:
            for r in batch.to_pylist():
                a, b = (np.frombuffer(r[f"unit_{p}"], np.float64).reshape(-1, r["size_x"]) for p in "xy")
                leading = directions.get(r["size_x"])
                same = r["x"] == r["y"]
                ids, many = [np.array(r[f"ids_{p}"]) for p in "xy"], [np.array(r[f"many_{p}"]) for p in "xy"]
                count = [np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)]
                if same:
                    count[1] = count[0]
                xs, ys = [], []
                for x, y in joined(a, _placed(a, leading), b, _placed(b, leading), cosine, reach, same):
                    np.add.at(count[0], x, many[1][y])
                    np.add.at(count[1], y, many[0][x])
                    x, y = forest(ids[0][x], ids[1][y])
                    xs.append(x)
                    ys.append(y)
                if not xs:
                    continue
                x, y = forest(np.concatenate(xs), np.concatenate(ys))
                hit = [np.flatnonzero(c) for c in (count[:1] if same else count)]
                who = np.concatenate([ids[k][h] for k, h in enumerate(hit)])
                n = np.concatenate([count[k][h] for k, h in enumerate(hit)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([x, who]), pa.int64()),
                        pa.array(np.concatenate([y, np.zeros(len(who), np.int64)]), pa.int64(), mask=np.arange(len(x) + len(who)) >= len(x)),
                        pa.array(np.concatenate([np.zeros(len(x), np.int64), n]), pa.int64()),
                    ],
                    ["a", "b", "n"],
                )

    return linked
