import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from pageloom.functions.urls import canonical_url, split_url
from pageloom.operators import urls as O

# url, canonical, reject reason
CASES = [
    ("HTTP://WWW.Ex.com:80/a/index.html?b=2&a=1&a=3&utm_source=x&blank=&q#f", "http://ex.com:80/a?a=1&b=2", None),
    ("http://e.com//a//", "http://e.com//a/", None),
    ("http://e.com/a;p=1?x=a%20b+c", "http://e.com/a?x=a b c", None),
    ("https://e.com/index.html", "https://e.com/", None),
    ("http://e.com?s=1", "http://e.com/?s=1", "search"),
    ("http://e.com/?%71=1", "http://e.com/?q=1", "search"),
    ("http://e.com/?s=", "http://e.com/", None),
    ("http://www.www.e.com/", "http://www.e.com/", None),
    ("http://e.com/b?x=%ZZ%41&%78=2", "http://e.com/b?x=%ZZA", None),
    ("http://e.com/badminton", "http://e.com/badminton", "path_keyword"),
    ("http://e.com/CARToon", "http://e.com/CARToon", "path_keyword"),
    ("http://e.com/x;login", "http://e.com/x", None),
    ("http://bit.ly/x", "http://bit.ly/x", "shortener"),
    ("http://bit.ly:80/x", "http://bit.ly:80/x", None),
    ("http://BIT.LY/y", "http://bit.ly/y", None),
    ("http://e.com/a.pdf", "http://e.com/a.pdf", None),
    ("mailto:x@y", "mailto:x@y", "scheme"),
    ("//e.com/a", "//e.com/a", "scheme"),
    ("http://[bad/", None, "invalid_url"),
    ("http://[::1]/z", "http://[::1]/z", None),
    ("http://[1.2.3.4]/", None, "invalid_url"),
    (None, None, "scheme"),
]


def frame(spark, urls, parts=3):
    return spark.createDataFrame(list(enumerate(urls)), "seq long, url string").repartition(parts)


def test_cases(spark):
    got = {r.seq: r for r in O.url_decision(frame(spark, [c[0] for c in CASES])).collect()}
    for seq, (url, canonical, reason) in enumerate(CASES):
        row = got[seq]
        assert (row.reject_reason, row.accepted) == (reason, reason is None), url
        if reason != "scheme":
            assert row.canonical_url == canonical, url


PIECES = [
    "http://", "HTTPS://", "www.", "a.com", "/", "//", "/index.html", "?", "&", "=", "a", "q",
    "utm_x", "%41", "%zz", "%", "+", ";p=1", "#", "é", "%C3%A9", "%FF", " ", "\t", "\n", ":80",
    "[::1]", "[", "@", "http:",
]


def random_urls(seed, n):
    rnd = random.Random(seed)
    return ["http://" + "".join(rnd.choice(PIECES) for _ in range(rnd.randint(1, 10))) for _ in range(n)]


def test_random_urls_split_like_the_standard_library(spark):
    urls = random_urls(5, 3000)
    for row in frame(spark, urls).select("seq", split_url(F.col("url")).alias("p")).collect():
        try:
            u = urlparse(urls[row.seq])
        except ValueError:
            continue
        assert tuple(row.p) == (u.scheme, u.netloc, u.path, u.params, u.query, u.fragment), urls[row.seq]


def test_what_does_not_change_the_canonical_url(spark):
    """The fragment, tracking keys, the order of keys, the case of the host and one ``www.``."""
    rnd = random.Random(6)
    urls = []
    for _ in range(300):
        host = rnd.choice(["a.com", "b.org:80", "x.y.net"])
        path = rnd.choice(["", "/", "/p", "/p/q.html", "/p/index.html", "/%41"])
        keys = rnd.sample(["a", "b", "c=", "d", "e"], rnd.randint(0, 4))
        query = [f"{k}={rnd.randint(0, 9)}" for k in keys]
        shuffled = rnd.sample(query, len(query)) + ["utm_" + rnd.choice("xyz") + "=1"]
        urls.append((f"http://{host}{path}?{'&'.join(query)}", f"HTTP://www.{host.upper()}{path}?{'&'.join(shuffled)}#f"))
    df = spark.createDataFrame(urls, "u string, v string")
    got = df.select("u", "v", canonical_url(F.col("u")).alias("a"), canonical_url(F.col("v")).alias("b")).collect()
    assert all(r.a == r.b and r.a is not None for r in got)


def test_canonical_is_idempotent(spark):
    urls = ["HTTP://WWW.A.com/x/?b=2&a=1&utm_a=1", "https://a.com", "http://a.com/b/index.html#x"]
    urls += [f"http://a.com/{x}?b={y}&a={y}" for x in ("x", "x/y/", "index.html") for y in ("1", "é", "z")]
    once = frame(spark, urls).select(canonical_url(F.col("url")).alias("c"))
    assert once.where(canonical_url(F.col("c")) != F.col("c")).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_first_seen_takes_the_smallest_seq_among_passing_rows(spark, parts):
    urls = ["http://a.com/?q=1", "http://a.com/x/", "http://www.a.com/x", "http://a.com/x#f", "http://b.com"] * 3
    df = frame(spark, urls, parts).withColumn("html", F.lit("h"))
    for write in (False, True):
        kept = O.first_seen(df, write_repeats=write)
        assert sorted(r.seq for r in kept.collect()) == [1, 4]
        assert kept.columns == ["seq", "url", "html", "canonical_url"]


def test_one_hot_url_keeps_its_first_row(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, "http://hot.com/").otherwise(F.concat(F.lit("http://c.com/"), "id")).alias("url"),
    )
    kept = O.first_seen(df)
    assert kept.count() == 20_000 - 6667 + 1
    assert kept.where("url = 'http://hot.com/'").first().seq == 0


def test_history_counts_as_seen(spark):
    history = spark.createDataFrame([("http://a.com/x",), (None,)], "canonical_url string")
    kept = O.first_seen(frame(spark, ["http://a.com/x/", "http://a.com/y"]), history=history)
    assert [r.url for r in kept.collect()] == ["http://a.com/y"]


def test_rules_and_limit(spark):
    df = frame(spark, ["http://a.com/v.mp4", "http://a.com/v.JPG", "http://a.com/p.jpeg?x", "http://a.com/x", None])
    assert O.block_rules(df).count() == 3
    assert O.block_rules(df, ()).count() == 5
    assert [r.url for r in O.scope_include(df, ["a\\.com/x$"]).collect()] == ["http://a.com/x"]
    assert sorted(r.seq for r in O.page_limit(df, 2).collect()) == [0, 1]


def test_strict_pages(spark):
    urls = ["http://a.com/x.html", "http://a.com/y", "http://a.com/z.pdf", "http://a.com"]
    got = {r.url: r.reject_reason for r in O.screen_urls(frame(spark, urls), strict_pages=True).collect()}
    assert got == {urls[0]: None, urls[1]: None, urls[2]: "extension", urls[3]: None}


def test_tracking_summary(spark, rows):
    df = frame(spark, ["http://www.a.com/?utm_a=1&utm_b=2&utm_a=3", "http://a.com/?utm_a=9", "http://a.com/?utm_c="])
    assert rows(O.tracking_summary(df)) == [("a.com", "utm_a", 2), ("a.com", "utm_b", 1)]
