import re

import pytest
from pyspark.sql import functions as F

from paramo.llm import queries
from paramo.llm import urlfilter as U
from tests.llm.helpers import SMALL

URLS = [
    "http://a.Example.ORG/es/1", "https://example.org/en/1x?q#f", "https://example.org/en/2", "http://www.example.com/fr/1", "http://example.com/de/", "http://example.com/de",
    "http://examplecom/de/", "http://com/de/x", "no scheme", None, "", "://", "://HOST", "http://h?x/y", "http://h#a://b/c", "ftp://x//y?z", "http://é.example.org/ä?ö", "http://A\nB/c\nd#e", "http://notorg/", "http://u:p@x.org:80/es/",
]


def plain(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h) + len(p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fit)[1:] if fit else (None, None))


def test_rules(spark):
    frame = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = U.host_of(F.col("url")), U.path_of(F.col("url"))
    fit = U.matched_rule(host, path, queries.URL_RULES)
    got = frame.select("url", host.alias("h"), path.alias("p"), fit["rule"].alias("r"), fit["verdict"].alias("v")).collect()
    assert [(r["h"], r["p"], r["r"], r["v"]) for r in got] == [plain(u) for u in URLS]


def test_query(spark):
    got = queries.op8_url_filter(spark, SMALL).collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["p_block"] > 0.5 else "allow"))


def test_learns_from_a_small_table(spark):
    rows = [(f"http://{'casino' if i % 2 else 'museum'}{i}.example/{'win' if i % 2 else 'art'}/{i}", i % 2) for i in range(200)] + [(None, 1), ("http://x/", None)]
    model = U.fit(spark.createDataFrame(rows, "url string, label int"), most=100)
    asked = spark.createDataFrame([(1, "http://bigcasino.example/win"), (2, "http://a-museum.example/art/x"), (3, None)], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in U.judge(asked.withColumn("features", F.lit(1)).withColumn("host", F.lit("clash")), model).collect()}
    assert got[1] == "block" and got[2] == "allow" and got[3] in ("allow", "block")
    assert U.judge(asked.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        U.fit(spark.createDataFrame([], "url string, label int"))


def test_grams_cover_whole_urls(spark):
    long = "x" * 3000 + "end"
    got = spark.createDataFrame([(long,)], "u string").select(U.grams(F.lit("ab"), F.col("u")).alias("g")).first()["g"]
    want = [m + s[i : i + n] for m, s in (("h", "^ab$"), ("p", f"^{long}$")) for n in U.GRAMS for i in range(max(1, len(s) - n + 1))]
    assert got == want


def test_query_without_a_labelled_page(spark, tmp_path):
    """An empty table gives no rows, urls outside all rules their rows, with the default verdict."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    other = pages.limit(3).withColumn("url", F.lit("http://a.example.net/x"))
    for name, frame, n in (("none", pages.limit(0), 0), ("other", other, 3)):
        frame.write.parquet(f"{tmp_path}/{name}/pages.parquet")
        got = queries.op8_url_filter(spark, f"{tmp_path}/{name}").collect()
        assert [(r["host"], r["path"], r["rule"], r["verdict"], r["p_block"]) for r in got] == [("a.example.net", "/x", None, "allow", None)] * n
    assert queries.op8_url_filter(spark, f"{tmp_path}/other").schema == queries.op8_url_filter(spark, SMALL).schema


def test_verdicts_of_the_model_against_a_plain_sum(spark):
    """Every page that no rule judges: the logistic function of the weights of its distinct n-grams, added up one by one."""
    import math

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    model = U.fit(queries.labelled_urls(pages))
    hashing, weights, start = model.stages[0], model.stages[1].coefficients, model.stages[1].intercept
    for r in U.judge(pages, model, queries.URL_RULES).join(pages.select("page_id", "url"), "page_id").limit(120).collect():
        host, path, _, ruled = plain(r["url"])
        own = {m + s[i : i + n] for m, s in (("h", f"^{host}$"), ("p", f"^{path}$")) for n in U.GRAMS for i in range(max(1, len(s) - n + 1))}
        p = 1 / (1 + math.exp(-start - sum(weights[i] for i in {hashing.indexOf(g) for g in own})))
        assert r["p_block"] == pytest.approx(p, abs=1e-9)
        assert r["verdict"] == (ruled or ("block" if p > 0.5 else "allow"))


def test_repeated_rows_and_clashing_names(spark):
    rows = [(i % 7 if i % 5 else None, URLS[i % len(URLS)], "x") for i in range(40)] + [(1, URLS[0], "x")] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for extra in ("id", "host", "path", "grams", "features", "probability", "fit", "rule", "c0", "a.b", "URL_", "p_block"):
        frame = frame.withColumn(extra, F.lit(1))
    model = U.fit(queries.labelled_urls(spark.read.parquet(f"{SMALL}/pages.parquet")))
    got = U.judge(frame, model, queries.URL_RULES).collect()
    assert sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"])) for r in got) == sorted((str(i), *plain(u)[:2], str(plain(u)[2])) for i, u, _ in rows)
    assert len({(r["host"], r["path"], r["verdict"], r["p_block"]) for r in got}) == len({plain(u)[:2] for _, u, _ in rows})
