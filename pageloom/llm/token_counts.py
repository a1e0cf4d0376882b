"""Token counts of documents in flat token files, which hold ids and end-of-document ids and no index.

Files are scanned in blocks of fixed size that know nothing of documents. A vectorised search finds
the separators of a block; a prefix scan over the blocks' short summaries, the tokens and
separators before each block and the place of the last separator, gives what a document that began in
an earlier block has there.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.tables import chunks

SEPARATOR = 50_256
DTYPE = "<u2"
BLOCK_TOKENS = 1 << 19


def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    with open(ranks, "rb") as lines:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("flat", pat_str=pattern, mergeable_ranks=found, special_tokens={})


def token_files(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", separator: int = SEPARATOR,
    dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``file``, ``block``, ``tokens`` (binary) and ``keys``: a flat token file for each partition of ``docs``.

    Every document's ids are followed by the separator; a null text has none of its own. Blocks are cut
    after ``block_tokens`` ids wherever that is. ``keys`` names the documents that end in the block and
    is not read by the scan.
    """

    def encoded(batches):
        coder = encoding(ranks, pattern)
        file, block, held, size, keys = TaskContext.get().partitionId(), 0, [], 0, []

        def row(tokens, names):
            columns = [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([tokens.tobytes()], pa.binary()), pa.array([names], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["file", "block", "tokens", "keys"])

        for names, texts in chunks(batches, "key", "text"):
            for name, raw in zip(names, texts, strict=True):
                ids = np.array([*coder.encode_ordinary(raw.decode()), separator], dtype)
                while size + len(ids) > block_tokens:
                    cut = block_tokens - size
                    yield row(np.concatenate([*held, ids[:cut]]), keys)
                    block, held, size, keys, ids = block + 1, [], 0, [], ids[cut:]
                # The rest is empty if the block was cut right after the separator; its document ended there.
                if len(ids):
                    held.append(ids)
                    size += len(ids)
                keys.append(name)
                if size == block_tokens:
                    yield row(np.concatenate(held), keys)
                    block, held, size, keys = block + 1, [], 0, []
        if size:
            yield row(np.concatenate(held), keys)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(encoded, "file long, block long, tokens binary, keys array<long>")


def read_token_files(spark: SparkSession, path: str, dtype: str = DTYPE, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``path``, ``file``, ``block`` and ``tokens`` of flat token files in any store that Spark reads.

    A file is one row of Spark's binary source, which takes up to 2 GB.
    """
    size = block_tokens * np.dtype(dtype).itemsize
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    blocks = files.select("path", "content", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int"))).alias("block"))
    return blocks.select(
        "path", F.xxhash64("path").alias("file"), F.col("block").cast("long").alias("block"),
        F.expr(f"substring(content, block * {size} + 1, {size})").alias("tokens"),
    )


def document_counts(blocks: DataFrame, separator: int = SEPARATOR, dtype: str = DTYPE) -> DataFrame:
    """``file``, ``document`` (from 0, in file order), ``n_tokens``, ``ended`` and, if ``blocks`` has ``keys``, ``key``.

    The separator is not counted. Tokens after a file's last separator are a document with ``ended``
    false. Null or empty blocks hold nothing; blocks may come in any order and partitioning.
    """

    def scanned(batches):
        for batch in batches:
            found = {"n": [], "last": [], "counts": []}
            for raw in batch.column("tokens"):
                ids = np.frombuffer(raw.as_py() or b"", dtype)
                at = np.flatnonzero(ids == separator)
                found["n"].append(len(ids))
                found["last"].append(int(at[-1]) if len(at) else None)
                found["counts"].append(np.diff(at, prepend=-1) - 1)
            kinds = {"n": pa.int64(), "last": pa.int64(), "counts": pa.list_(pa.int64())}
            columns = [pa.array(found[c], k) for c, k in kinds.items()]
            own = [c for c in batch.schema.names if c != "tokens"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *columns], [*own, *kinds])

    keyed = "keys" in blocks.columns
    own = ["file", "block", *(["keys"] if keyed else [])]
    kinds = "file long, block long, " + ("keys array<long>, " if keyed else "") + "n long, last long, counts array<long>"
    rows = blocks.select(F.col("file").cast("long"), F.col("block").cast("long"), *own[2:], "tokens").mapInArrow(scanned, kinds)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rows = rows.withColumns({
        "first": F.coalesce(F.sum(F.size("counts")).over(before), F.lit(0)),
        "open": F.col("start") - F.coalesce(F.max(F.col("start") + F.col("last")).over(before) + 1, F.lit(0)),
        "final": F.lead("block").over(Window.partitionBy("file").orderBy("block")).isNull(),
    })
    rest = F.when(F.size("counts") > 0, F.col("n") - F.col("last") - 1).otherwise(F.col("n") + F.col("open"))
    # The document left open at the end of the file comes last.
    whole = F.when(F.col("final") & (rest > 0), F.concat("counts", F.array(rest))).otherwise(F.col("counts"))
    out = rows.select("*", F.posexplode(whole).alias("i", "count"))
    key = [F.when(F.col("i") < F.size("counts"), F.get("keys", F.col("i"))).alias("key")] if keyed else []
    return out.select(
        "file",
        (F.col("first") + F.col("i")).alias("document"),
        (F.col("count") + F.when((F.col("i") == 0) & (F.size("counts") > 0), F.col("open")).otherwise(0)).alias("n_tokens"),
        (F.col("i") < F.size("counts")).alias("ended"),
        *key,
    )
