import codecs
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from pageloom.llm import queries
from pageloom.llm.sentencepiece_bpe import PrefixTable, _each_byte, encode_decode

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    codecs.register_error("each_byte", _each_byte)
    return PrefixTable(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)


def check(ours, library, text):
    ids = np.frombuffer(ours.encode(text), np.int32).tolist()
    assert ids == library.encode(text), text
    assert ours.decode(ids) == library.decode(ids), text


def test_the_model_fits_the_method(both):
    """Every piece is what its own merges give, and none scores better than its parts."""
    ours, _ = both
    for piece in ours.ids:
        parts = ours.split(piece)
        assert parts is not None
        assert all(len(p) < 2 or ours.scores[p] >= ours.scores[piece] for p in parts)


def test_random_texts(both):
    ours, library = both
    rnd = random.Random(1)
    pieces = list(ours.ids)
    for k in range(6_000):
        if k % 4 == 0:
            text = "".join(rnd.choice("abcdeth nrs\n ") for _ in range(rnd.randint(0, 30)))
        elif k % 4 == 1:
            text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6)))
        elif k % 4 == 2:
            ranges = [(32, 127), (0x80, 0x2FFF), (0x4E00, 0x9FFF), (0x1F300, 0x1F6FF), (0x20, 0x20), (0x2581, 0x2581), (0, 31)]
            text = "".join(chr(rnd.randint(*rnd.choice(ranges))) for _ in range(rnd.randint(0, 15)))
        else:
            text = rnd.choice("aeo ▁") * rnd.randint(0, 60) + rnd.choice(["", "=", "a", "."]) * rnd.randint(0, 40)
        check(ours, library, text)


def test_random_ids(both):
    ours, library = both
    rnd = random.Random(2)
    for _ in range(4_000):
        ids = [rnd.choice([rnd.randint(0, 258), rnd.randint(0, 31_999), 35]) for _ in range(rnd.randint(0, 6))]
        assert ours.decode(ids) == library.decode(ids), ids


def test_long_texts(both):
    for text in ("x" * 20_000, " " * 20_000 + "y", "日本" * 5_000, "ab" * 10_000 + "\n" * 500):
        check(*both, text)


def test_every_document(spark, both):
    """The query's rows on whole tables, against the library."""
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op6_sentencepiece(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = both[1].encode(docs[r.doc_id] or "")
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), both[1].decode(ids) if ids else "")]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), *digest)


def test_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, " ")], "doc_id long, text string").selectExpr("*", "1 as ids", "2 as key")
    got = sorted((r.doc_id or 0, len(r.ids), r.decoded) for r in encode_decode(docs, MODEL).collect())
    assert got == [(0, 1, " "), (1, 0, ""), (2, 0, ""), (3, 2, "a b"), (3, 2, "a b")]
    assert encode_decode(docs.limit(0), MODEL).collect() == []
