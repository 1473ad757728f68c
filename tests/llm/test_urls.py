import numpy as np
import xxhash

from tributary.llm import urls
from tributary.llm.queries import URL_RULES

URLS = [None, "", "no scheme", "http://", "://", "http://x.net", "http://x.net/", "HTTP://A.EXAMPLE.NET/en/1?x#y",
        "https://example.net/en/", "https://notexample.net/en/", "ftp://example.com/de/1", "http://a.org/fr/9",
        "http://org/fr/", "http://a.org?/fr/", "http://b.net#/", "http://ÄÖ.net/", "http://a.b://c.net/x",
        "http://" + "a." * 50_000 + "net/" + "p" * 50_000, "http://net./", "http://x.org/FR/"]


def brute(url):
    host, path = urls.split_url(url)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def test_hosts_and_paths():
    assert urls.split_url("HTTP://A.eXample.NET/En/1?x#y") == ("a.example.net", "/En/1")
    assert urls.split_url("a://b?c/d") == ("b", "") and urls.split_url("a://b#/d") == ("b", "")
    assert urls.split_url("nothing") == urls.split_url(None) == ("", "")
    assert urls.split_url("a://b/c://d/e?f://g") == ("b", "/c://d/e")


def test_verdicts_equal_brute_force(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string")
    out = urls.judge(pages, "url", URL_RULES)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    rows = out.collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        assert (r.host, r.path) == urls.split_url(r.url)
        assert (r.rule, r.verdict) == brute(r.url), r.url and r.url[:60]
    assert urls.blocked(out).count() == sum(r.verdict == "block" for r in rows)


def test_empty_table_and_empty_list(spark):
    empty = spark.createDataFrame([], "url string")
    assert urls.judge(empty, "url", URL_RULES).count() == 0
    one = spark.createDataFrame([("http://x.net/",)], "url string")
    assert urls.judge(one, "url", []).first().verdict == "allow"


def test_equal_hashes_are_confirmed_by_the_string(tmp_path, monkeypatch):
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda s: len(s) % 3)
    path = str(tmp_path / "list")
    urls.write_list([("a.com", "/", "block"), ("b.com", "/", "allow"), ("c.com", "/", "block")], path)
    listed = urls.DigestList(path)
    assert isinstance(listed.keys, np.memmap)
    found = listed.find([("b.com", "/x"), ("c.com", "/"), ("d.com", "/"), ("sub.a.com", "/y")])
    assert [None if i < 0 else listed.string(i) for i in found] == [b"b.com/", b"c.com/", None, b"a.com/"]
