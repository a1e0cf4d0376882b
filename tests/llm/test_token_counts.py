import numpy as np
import public_tokenizers
import pytest

from pageloom.llm import token_counts as t

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("size", [1, 7, 64, 1 << 19])
def test_files_of_documents(spark, size):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60 if size == 1 else 200).collect()]
    rows = [(k, x[:200] if size == 1 else x) for k, x in rows]
    rows += [(9_000, None), (9_001, ""), (9_002, "<|endoftext|>"), (9_003, "a" * 5_000), (9_003, "b"), (None, "c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr("*", "1 as key", "2 as file")
    files = t.token_files(docs, RANKS, PATTERN, block_tokens=size).cache()
    assert all(len(r.tokens) <= 2 * size for r in files.collect())
    got = sorted((-1 if r.key is None else r.key, r.n_tokens) for r in t.document_counts(files.repartition(7)).collect())
    coder = t.encoding(RANKS, PATTERN)
    assert got == sorted((-1 if k is None else k, len(coder.encode_ordinary(x or ""))) for k, x in rows)


def test_flat_files(spark, tmp_path):
    sep = t.SEPARATOR
    made = {"a": [1, 2, sep, sep, 3, sep, 4, 5], "b": [sep], "c": [7] * 50, "d": [], "e": [7] * 20 + [sep]}
    for name, ids in made.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    for size in (1, 3, 4, 1 << 19):
        blocks = t.read_token_files(spark, str(tmp_path), block_tokens=size)
        names = {r.file: r.path[-1] for r in blocks.select("file", "path").distinct().collect()}
        got = sorted((names[r.file], r.document, r.n_tokens, r.ended) for r in t.document_counts(blocks.drop("path")).collect())
        assert got == [
            ("a", 0, 2, True), ("a", 1, 0, True), ("a", 2, 1, True), ("a", 3, 2, False), ("b", 0, 0, True), ("c", 0, 50, False), ("e", 0, 20, True),
        ]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert t.document_counts(t.token_files(docs, RANKS, PATTERN)).collect() == []
