"""URL filter: hosts, paths and rules against a plain version; the model decides the rest."""

from __future__ import annotations

from estatelake.llm.url_filter import filter_urls, labelled_urls
from tests.llm import brute
from tests.llm.conftest import as_rows, clashing, expected

URLS = [
    None, "", "no scheme", "http://", "http://COM/", "http://a.com", "http://a.com/", "HTTPS://Www.Example.COM/en/x?q#f",
    "http://example.com/en", "http://example.com/en/", "http://b.example.com/en/1", "http://www.example.com/en/1",
    "http://xexample.com/en/1", "http://a.net/es/", "http://net/fr/x", "http://anet/fr/x", "http://a.net/fr?x", "http://a.net/fr/?x",
    "x://y://z.com/a", "http://a.com:80/x", "http://u@a.com/x#/en/", "http://É.com/É", "http://a.org/p?u=http://b.net/es/",
    "http://a.com\n/x", "http://a.com?x/", "http://a.com#x/", "http://" + "a" * 5000 + ".net/es/" + "b" * 5000, "http://a.com/", "http://a.com/",
]


def test_hosts_paths_and_rules(spark):
    rows = [(i if i != 5 else None, u) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    for df in (pages, clashing(pages)):
        out = filter_urls(df)
        assert as_rows(out, "id", "host", "path", "rule") == expected([(i, *brute.url_rule(u)[:3]) for i, u in rows])
        verdicts = {(r["host"], r["path"]): r for r in out.collect()}
        for _, u in rows:
            host, path, _, verdict = brute.url_rule(u)
            got = verdicts[host, path]
            assert got["verdict"] == (verdict or ("block" if got["score"] >= 0.5 else "allow"))
            assert 0 <= got["score"] <= 1


def test_model_learns_from_the_decided(spark):
    rows = [(i, f"http://h{i}.com/good/{i}") for i in range(60)] + [(100 + i, f"http://h{i}.net/es/bad{i}") for i in range(60)]
    rows += [(900, "http://z.org/good/77"), (901, "http://z.org/es/bad88")]
    got = {r["id"]: r for r in filter_urls(spark.createDataFrame(rows, "page_id long, url string")).where("id >= 900").collect()}
    assert got[900]["verdict"] == "allow" and got[901]["verdict"] == "block"


def test_without_labels_and_empty(spark):
    out = filter_urls(spark.createDataFrame([(1, "http://x.org/"), (2, None)], "page_id long, url string")).collect()
    assert {r["score"] for r in out} == {0.5} and {r["verdict"] for r in out} == {"block"}
    assert filter_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_repeated_urls_do_not_fill_the_labelled_table(spark):
    rows = [(f"h{i}.com", f"/{i}", "allow") for i in range(20) for _ in range(30)] + [("a.net", "/es/", "block")] * 50
    got = labelled_urls(spark.createDataFrame(rows, "host string, path string, verdict string"), 10).collect()
    assert len({(r["host"], r["path"]) for r in got if r["label"] == 0}) == 10
    assert [(r["host"], r["path"]) for r in got if r["label"] == 1] == [("a.net", "/es/")]
