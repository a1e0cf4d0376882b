import string

from pageloom.llm import language_id as lang


def sampled(spark, rows, monkeypatch, **more):
    monkeypatch.setattr(lang, "automaton", lambda codes: codes)
    return dict(zip(*lang.learned(spark.createDataFrame(rows, "text string, lang string"), **more), strict=True))


def test_a_language_of_copies_keeps_its_text(spark, monkeypatch):
    rows = [(f"only text {c} of this language", c) for c in string.ascii_lowercase for _ in range(2_000)]
    got = sampled(spark, rows, monkeypatch)
    assert got == {c: lang.squeezed(f"only text {c} of this language".encode()).tobytes() for c in string.ascii_lowercase}


def test_short_and_copied_texts_fill_the_sample(spark, monkeypatch):
    short = ["".join(string.ascii_lowercase[int(d)] for d in str(i)) for i in range(20_000)]
    rows = [(x, "a") for x in short] + [("a copy", "a")] * 5_000 + [("1 2", "b"), ("one -- text", "c"), (None, "c"), ("x", None)]
    got = sampled(spark, rows, monkeypatch)
    assert len(got["a"]) == lang.SAMPLE_BYTES and got["a"].count(b"a\0copy") <= 1
    assert set(got) == {"a", "c"} and got["c"] == b"one\0text"
