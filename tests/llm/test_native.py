"""Mixing and URL filter against SQL, on rows that are hard."""

from __future__ import annotations

import random

import duckdb
import pytest
from compare import differences

from stayledger.llm import mixing, oracle, url_filter


def run_sql(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toPandas().convert_dtypes())
    return con, sql


def mixed_rows():
    rng = random.Random(1)
    rows = []
    for k in range(600):
        source = rng.choice(["a"] * 6 + ["b", "c", "é", "Z", None, "d", "e"])
        rows.append((k, " ".join(["w"] * rng.choice([0, 1, 5, 50, 400])), source))
    return rows + [(600, None, "a"), (601, "", None), (601, "", None), (None, "x y", "b"), (602, "p\x0bq", "only")]


def test_mixing(spark, make_docs):
    docs = make_docs(mixed_rows())
    con, sql = run_sql(oracle.MIX_SOURCES, documents=docs)
    assert differences(mixing.mix_digest(docs), con, sql) == []


def test_mix_emits_what_the_digest_says(spark, make_docs):
    docs = make_docs(mixed_rows()).selectExpr("*", "1 AS size", "2 AS target", "3 AS rate")
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    words = out.agg({"doc_id": "count"}).first()[0]
    taken = mixing.mix_digest(docs).where("size = 1").selectExpr("sum(taken)").first()[0]
    assert words and taken == out.where("text = 'w'").count() + out.where("text = 'p\x0bq'").count() * 0
    assert max(r["count"] for r in out.where("doc_id < 600").groupBy("doc_id").count().collect()) <= 2
    assert mixing.mix_documents(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        mixing.mix_documents(docs.withColumnRenamed("rate", "_mix_rate"))


def test_rows_without_ids_meet_the_target(spark, make_docs):
    """A third of the rows and one source whole have no id, and one id stands on many rows."""
    rows = [(k, f"own {k} " + "w " * 20, "a") for k in range(3000)]
    rows += [(None, f"none {k} " + "w " * 20, "b") for k in range(3000)]
    rows += [(7, f"same {k} " + "w " * 20, "c") for k in range(3000)]
    docs = make_docs(rows)
    con, sql = run_sql(oracle.MIX_SOURCES, documents=docs)
    digest = mixing.mix_digest(docs)
    assert differences(digest, con, sql) == []
    per_source = digest.groupBy("target").agg({"taken": "sum"}).collect()
    assert len(per_source) == 3
    assert all(abs(r["sum(taken)"] - r["target"]) <= 0.02 * r["target"] for r in per_source)


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 10), ("c", 1000), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # a and b stop at twice their size; c has what is left; an empty source has nothing
    assert got == {"a": 200.0, "b": 20.0, "c": 1445.0, None: 0.0}
    # one is capped, the others share the rest by weight
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 1000), ("d", 0)], sizes.schema)
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 200.0, "b": pytest.approx(2950 * 2 / 3), "c": pytest.approx(2950 / 3), "d": 0.0}


def test_targets_by_resharing(spark):
    """The closed form against resharing the excess in turns."""
    rng = random.Random(7)
    for _ in range(12):
        sizes = [(f"s{k:02d}", rng.choice([0, 1, 10, 100, 1000]) * rng.randrange(1, 9)) for k in range(rng.randrange(1, 9))]
        weight = {s: mixing.WEIGHTS[k % 3] for k, (s, _) in enumerate(sizes)}
        total = 1.5 * sum(n for _, n in sizes)
        target, full = {}, {}
        while True:
            free = [s for s, _ in sizes if s not in full]
            left = total - sum(full.values())
            target = full | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
            above = {s: 2.0 * n for s, n in sizes if s not in full and target[s] > 2 * n}
            if not above:
                break
            full |= above
        frame = spark.createDataFrame(sizes, "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
        assert got == {s: pytest.approx(target[s]) for s in target}


def page_rows():
    rng = random.Random(2)
    hosts = ["m.x.example.net", "Example.COM", "www.example.com", "a.www.example.com", "q.example.org", "net", "examplenet", "com"]
    parts = ["en", "fr", "es", "de", "7", "id9x", "deep", "abc", "%C3%A9"]
    rows = []
    for k in range(900):
        path = "".join("/" + rng.choice(parts) for _ in range(rng.randrange(5))) + rng.choice(["", "/", "?q=/en/", "#x", "//"])
        if rng.random() < 0.2:
            path = f"/user/name{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k % 6]}/home"
        rows.append((k, rng.choice(["http://", "https://", "x://"]) + rng.choice(hosts) + path, ""))
    odd = [None, "", "no scheme", "://", "http://", "http:///en/", "http://h?x", "http://a://b/c", "http://HOST/" + "s/" * 300, "http://example.com/en/"]
    return rows + [(1000 + k, u, None) for k, u in enumerate(odd)] + [(1000, None, None)]


def test_urls(spark):
    pages = spark.createDataFrame(page_rows(), "page_id long, url string, html string").repartition(3)
    con, sql = run_sql(oracle.URL_TEMPLATES, pages=pages.drop("html"))
    assert differences(url_filter.url_digest(pages), con, sql) == []
    assert url_filter.url_digest(pages.where("false")).collect() == []


def test_templates_learn_and_generalise(spark):
    """A site whose spam pages are known by rule: a template of them is rejected where no rule reaches."""
    rules = (("block", "site.org", "/shop/sale"), ("allow", "site.org", "/news/"))
    rows = [(k, f"http://site.org/shop/sale{k}/x") for k in range(60)] + [(100 + k, f"http://site.org/news/{k}") for k in range(60)]
    rows += [(200, "http://site.org/shop/other/x"), (201, "http://site.org/about"), (202, "http://site.org/news")]
    found = {r.page_id: r for r in url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert found[0].template == "/shop/*/x" and found[100].template == "/news/*"
    assert [found[k].verdict for k in (0, 100, 201, 202)] == ["block", "allow", "allow", "allow"]
    # a template without labels of its own follows its branch
    assert found[200].template == "/shop/other/x" and found[200].verdict == "block"
