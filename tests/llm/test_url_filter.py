import random

from pageloom.llm.queries import URL_RULES
from pageloom.llm.url_filter import DigestArray, filter_urls


def judge(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fits, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_against_a_loop(spark):
    rnd = random.Random(3)
    rules = [*URL_RULES, ("block", "x", ""), ("allow", "a.x", "/p?"), ("block", "é.org", "/ü")]
    urls = [None, "", "://", "http://", "no scheme", "http://COM/", "http://com", "ftp://.com/", "http://a.com://b/", "x://é.org/üb", "http://É.org/ü", "http://a\nb.com/\nx?q", "http://acom/"]
    for _ in range(800):
        host = ".".join(rnd.choices(["www", "example", "com", "net", "x", "COM", "a", ""], k=rnd.randint(1, 5)))
        urls.append(f"http://{host}{rnd.choice(['', '/', '/en/', '/en', '/fr/1', '/es/?a', '#/en/', '?/en/', '/p', '//'])}")
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[5]), (None, "http://com/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as rule", "3 as key")
    got = sorted(((r.page_id or -1, r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, rules).collect()), key=str)
    assert got == sorted(((k or -1, *judge(u, rules)) for k, u in rows), key=str)
    assert filter_urls(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in filter_urls(pages, []).collect()} == {"allow"}


def test_equal_digests_are_told_apart(tmp_path):
    texts = [f"t{i}".encode() for i in range(50)]
    digest = lambda t: len(t)
    (tmp_path / "rules").write_bytes(DigestArray.built([*texts, texts[0]], digest))
    array = DigestArray.opened(str(tmp_path / "rules"))
    found = array.find([*texts, b"zz", b"zzz", b"zzzz"], digest)
    assert [array.text(i) for i in found[:50]] == texts and list(found[50:]) == [-1, -1, -1]


def test_very_long_urls_and_ties(spark):
    """Hosts of many labels cost no more than their length; of equally long rules the longest host's wins."""
    rules = [*URL_RULES, ("block", "b.com", "/x"), ("allow", "com", "/xyz")]
    dots, word, path = "." * 200_000 + "example.com", "a" * 300_000 + ".net", "/en/" + "p" * 300_000
    urls = [f"http://{dots}/en/", f"http://{word}/es/", f"http://example.com{path}", "http://a.b.com/xyz", "http://b.com/xyz", "http://c.com/xyz"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in filter_urls(pages, rules).collect()}
    assert got[0] == (dots, "/en/", "example.com/en/", "block") and got[1] == (word, "/es/", "net/es/", "block")
    assert got[2] == ("example.com", path, "example.com/en/", "block")
    assert [got[i][2:] for i in (3, 4, 5)] == [("b.com/x", "block"), ("b.com/x", "block"), ("com/xyz", "allow")]
