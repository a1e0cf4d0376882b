import random

from pyspark.sql import functions as F

from pageloom.llm import warc_fixity as w


def frame(spark, rows):
    return spark.createDataFrame(rows, "file string, offset long, record binary").selectExpr("*", "1 as node", "2 as length")


def test_damage_is_located(spark):
    rnd = random.Random(6)
    ours, offset = [], 0
    for file in ("a", "b", "c", "same"):
        offset = 0
        for _ in range(300):
            record = rnd.randbytes(rnd.choice([0, 10, 500, 90_000 if file == "a" else 20]))
            ours.append((file, offset, record))
            offset += len(record) + 1
    theirs, expected = [], []
    for file, at, record in ours:
        kind = rnd.randrange(60) if file != "same" else 1
        if kind == 0:
            expected.append((file, at, "missing"))
            continue
        if kind == 2:
            record += b"!"
            expected.append((file, at, "changed"))
        theirs.append((file, at, record))
    theirs += [("new", 5, b"x"), ("a", 1 << 40, b"far"), ("c", 10**6, None)]
    expected += [("new", 5, "extra"), ("a", 1 << 40, "extra"), ("c", 10**6, "extra")]
    rnd.shuffle(theirs)
    ours += [(None, 1, b"q"), ("a", None, b"q")]
    a, b = w.hashed(frame(spark, ours)), w.hashed(frame(spark, theirs))
    assert sorted(tuple(r) for r in w.audit(a, b).collect()) == sorted(expected)
    assert w.audit(a, a).collect() == []


def test_empty_and_repeated(spark):
    none, one = frame(spark, []), frame(spark, [("a", 0, b"x")])
    assert w.audit(w.hashed(none), w.hashed(none)).collect() == []
    assert [tuple(r) for r in w.audit(w.hashed(one), w.hashed(none)).collect()] == [("a", 0, "missing")]
    assert [tuple(r) for r in w.audit(w.hashed(one), w.hashed(one.unionAll(one))).collect()] == [("a", 0, "changed")]


def test_records_are_warc(spark, tmp_path):
    from pageloom.sources.warc import html_responses, read_warc

    pages = spark.createDataFrame([(1, "http://x.org/ä", "<p>é</p>"), (2, "http://y.org", "")], "page_id long, url string, html string")
    record = w.response_record(F.col("url"), F.lit("<urn:x>"), F.lit("2026-01-01T00:00:00Z"), F.col("html"))
    made = w.laid_out(pages.select("page_id", F.lit("f").alias("file"), record.alias("record")).withColumn("length", F.octet_length("record")), "page_id")
    rows = made.orderBy("page_id").collect()
    assert [r.offset for r in rows] == [0, len(rows[0].record)]
    (tmp_path / "f.warc").write_bytes(b"".join(bytes(r.record) for r in rows))
    assert html_responses(read_warc(spark, str(tmp_path / "f.warc"))).count() == 2
