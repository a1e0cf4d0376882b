import random
import zlib

from pageloom.llm import language_id as lang
from pageloom.llm import queries

SF = "/root/testdata/sf0.01"


def phrases(text, learned):
    """Greedy phrases by substring search."""
    text, learned = lang.squeezed(text).tobytes(), learned
    count = 0
    for a in range(0, len(text), lang.LANE):
        part, at = text[a : a + lang.LANE], 0
        while at < len(part):
            end = at
            while end < len(part) and part[at : end + 1] in learned:
                end += 1
            # A whole phrase and the byte that broke it; the rest of a lane is part of the last phrase.
            count += end < len(part)
            at = end + 1
    return count + 1 if text else 0


def test_phrases_against_search():
    rnd = random.Random(4)
    learned = [lang.squeezed("".join(rnd.choice(a) for _ in range(700)).encode()).tobytes() for a in ("abc d", "xyzé ", "abxy")]
    parser = lang.CrossParser([lang.automaton(x) for x in learned])
    texts = ["".join(rnd.choice("abcxyz é!") for _ in range(rnd.choice([0, 1, 5, 300, 3_000]))).encode() for _ in range(40)]
    got, length = parser.phrases(texts)
    assert got.tolist() == [[phrases(t, x) for x in learned] for t in texts]
    assert length.tolist() == [len(lang.squeezed(t)) for t in texts]


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op8_language_id(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 4 == 2}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_unreadable_and_unlearned(spark):
    docs = spark.createDataFrame(
        [(1, None, "en"), (2, "", "en"), (3, "12 !? 7", None), (4, "the cat", "en"), (4, "the cat", "en"), (None, "le chat", "fr"), (6, "日本語", None)],
        "doc_id long, text string, lang string",
    ).selectExpr("*", "1 as key", "2 as score", "3 as lang_pred")
    model = lang.learned(docs)
    assert model[0] == ["en", "fr"]
    got = {r.doc_id: r.lang_pred for r in lang.predict(docs, model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", 4: "en", None: "fr", 6: "en"}
    assert {r.lang_pred for r in lang.predict(docs, lang.learned(docs.limit(0))).collect()} == {"und"}
    assert lang.predict(docs.limit(0), model).collect() == []
