import random

import duckdb
import pytest
from pyspark.sql import functions as F

from check import TABLES, differences
from rentrank.llm import url_filter
from rentrank.llm.url_filter import RULES, Rule, Trie

SF_DIR = "/root/testdata/sf0.001"


def plain(rules, host, path):
    fits = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    if not fits:
        return None
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.verdict == "block"))
    return best.verdict, best.host + best.path


def test_trie_equals_trying_every_rule():
    rng = random.Random(2)
    hosts = ["com", "a.com", "b.a.com", "org", "a.org", "co.uk"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/x/y/", "/xx", "//"]
    for _ in range(300):
        rules = [Rule(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(rng.randint(0, 8))]
        trie = Trie(rules)
        for _ in range(20):
            host = rng.choice(hosts + ["c." + h for h in hosts] + ["xcom", "", "a..com"])
            path = rng.choice(paths + ["/x/yz/q", "/xx/y", "///"])
            assert trie.match(host, path) == plain(rules, host, path), (rules, host, path)


def test_odd_urls(spark):
    urls = [
        (1, None, ""), (2, "", ""), (3, "no scheme.com/en/", ""), (4, "HTTP://WWW.Example.COM/en/a?b#c", ""),
        (5, "http://example.com", ""), (6, "http://x.example.com/en/", ""), (7, "http://É.net/es/q", ""),
        (8, "a://b://example.com/", ""), (9, "http://.net/fr/", ""), (10, "http://x.net?/fr/", ""), (10, "http://x.net?/fr/", ""),
        (None, "http://a.org/" + "z/" * 50_000, ""),
    ]
    frame = spark.createDataFrame(urls, "page_id long, url string, verdict string").withColumn("host", F.lit(1))
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judged(frame, RULES).collect()}
    assert got[1] == got[2] == got[3] == ("", "", None, "allow")
    assert got[4] == ("www.example.com", "/en/a", "www.example.com/en/", "allow")
    assert got[5] == ("example.com", "", None, "allow")
    assert got[6] == ("x.example.com", "/en/", "example.com/en/", "block")
    assert got[7] == ("É.net", "/es/q", "net/es/", "block")
    assert got[8] == ("b:", "//example.com/", None, "allow")
    assert got[9] == (".net", "/fr/", "net/fr/", "block")
    assert got[10] == ("x.net", "", None, "allow")
    assert got[None][0] == "a.org" and len(got[None][1]) == 100_001
    assert url_filter.judged(frame, RULES).count() == 12
    assert url_filter.judged(frame.limit(0), RULES).collect() == []


def test_too_many_rules_are_refused(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "RULE_BYTES", 10)
    with pytest.raises(ValueError):
        url_filter.judged(spark.createDataFrame([], "page_id long, url string"), RULES)


def test_query_equals_sql(spark):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    got = url_filter.op3_url_filter(spark, SF_DIR).toPandas()
    assert differences(got, db.sql(url_filter.ORACLE).df()) is None
