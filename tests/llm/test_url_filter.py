"""Cascade against set membership; rules against a plain walk; the query against its SQL."""

import random

from oracle import compare, connect
from tidemark.llm.queries import op3_url_filter
from tidemark.llm.sql import ORACLES
from tidemark.llm.url_filter import RULES, build_cascade, judge
from pyspark.sql import functions as F


def test_cascade_is_exact(spark):
    rng = random.Random(0)
    keys = [(f"k{i}", rng.random() < 0.3) for i in range(6000)]
    df = spark.createDataFrame(keys + keys[:50] + [(None, True)], "key string, listed boolean").repartition(3)
    for size in (1 << 16, 500):
        cascade = build_cascade(df, size)
        assert cascade.depth > 1 and (cascade.shards > 1) == (size == 500)
        rows = cascade.mark(df.withColumn("level", F.lit(1)), F.col("key"), "found").collect()
        assert len(rows) == len(keys) + 51
        assert all(r.found == r.listed for r in rows if r.key is not None)
    for part in (df.where("listed"), df.where("NOT listed"), df.where("false")):
        assert all(r.found == r.listed for r in build_cascade(part).mark(part.dropna(), F.col("key"), "found").collect())


def walk(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cuts = [rest.find(c) for c in "/?#" if c in rest]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:min(cuts, default=len(rest))])
    path = rest[len(host):]
    path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(r, v) for v, r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith(r[r.index("/"):])]
    return host, path, *max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_planted(spark):
    urls = [None, "", "no scheme", "http://", "http://ORG", "http://a.org/", "https://A.Example.ORG/es/1?x#y", "x://example.org/en/12",
            "http://example.org/en/2", "http://notexample.org/es/", "http://b.com/de/1", "http://b.com/de/2", "http://b.com/en/",
            "http://b.com/fr/", "http://c.com/fr/", "http://c.com", "http://c.com?de/", "http://d.net/a://b", "http://É.com/DE/", "a://b://c/d"]
    rows = [(i, u, "h") for i, u in enumerate(urls)] + [(3, urls[3], "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string").repartition(2)
    want = [(i, *walk(u)) for i, u, _ in rows]
    lead = {}
    for _, host, _, _, verdict in want:
        lead[host] = lead.get(host, 0) + {"block": 1, "allow": -1, None: 0}[verdict]
    want = sorted((i, h, p, r or "", v or ("block" if lead[h] > 0 else "allow")) for i, h, p, r, v in want)
    assert sorted((r.page_id, r.host, r.path, r.rule or "", r.verdict) for r in judge(df).collect()) == want
    assert ("b.com", "/en/", "block") in {(h, p, v) for _, h, p, _, v in want}
    assert judge(df.where("false")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    assert compare(spark, connect(sf), "op3", op3_url_filter, ORACLES["op3_url_filter"], sf) is None
