"""What the stage that cuts repeated strings leaves of texts and of other columns."""

import datetime

import corpus_pipeline


def _cut(spark, rows, schema):
    docs = spark.createDataFrame(rows, schema)
    out = corpus_pipeline.without_repeats(spark, docs, "")
    assert out.columns == docs.columns
    return {r.doc_id: r for r in out.collect()}


def test_replacement_characters_of_the_text_stay(spark):
    run = "é" + "every word of this long line stands in two of the texts here" + "é"
    rows = [(1, "a � b"), (2, f"one �\x01 {run}"), (3, f"two \x01b�\x01a è{run[1:-1]}è end �"), (4, "�")]
    got = _cut(spark, rows, "doc_id long, text string")
    assert got[1].text == "a � b"
    assert got[2].text == rows[1][1]
    assert got[3].text == "two \x01b�\x01a è end �"
    assert 4 not in got


def test_broken_characters_go(spark):
    # The two letters begin with the same byte, which belongs to the repeated string.
    run = "every word of this long line stands in two of the texts here"
    got = _cut(spark, [(1, f"� {run}é one"), (2, f"x� {run}è two")], "doc_id long, text string")
    assert got[2].text == "x two"


def test_other_columns_stay(spark):
    when = datetime.datetime(2026, 1, 2, 3, 4, 5, 678901)
    schema = "url string, doc_id long, text string, n_chars long, lang string, marks array<double>, at timestamp"
    got = _cut(spark, [("u", 1, "some words", 0, None, [1.5, None], when), (None, 2, "others", 0, "en", None, None)], schema)
    assert tuple(got[1]) == ("u", 1, "some words", 10, None, [1.5, None], when)
    assert tuple(got[2]) == (None, 2, "others", 6, "en", None, None)
