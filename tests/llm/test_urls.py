"""URL rules and the filter cascade against plain versions."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolag.llm import urls

URLS = [
    None, "", "no scheme", "http://EXAMPLE.org/es/x", "https://sub.example.org/en/12?x#y", "http://example.org/en/2",
    "http://notexample.org/es/", "ftp://a.COM/fr/", "http://a.com/de/1", "http://a.com/de", "http://a.com", "http://org/x",
    "http://x.org?/es/", "http://x.org#/es/", "http://casino-win.net/x", "http://www.cheap-pills.com/fr/1", "a://b://c/d",
    "http:///p", "://h/p", "HTTP://Ünï.ORG/x", "http://m.ads.track.io/", "http://adsy.io/", "http://h.net/a\nb?c",
]


def plain(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url[url.index("://") + 3:]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        rule = max(fits, key=lambda r: len(r.name))
        return host, path, rule.name, rule.verdict
    return host, path, None, "block" if re.search(urls.LISTED, host) else "allow"


@pytest.mark.parametrize("limit", [urls.CASCADE_BYTES, 8])
def test_awkward_urls(spark, limit):
    rows = [(i, u, "h", "x") for i, u in enumerate(URLS)] + [(0, None, "h", "x"), (None, "http://spam.net/", "h", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = urls.judge(pages, limit=limit).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((i, *plain(u))) for i, u, *_ in rows)
    assert urls.judge(pages.where("false")).count() == 0


@pytest.mark.parametrize("limit,share", [(urls.CASCADE_BYTES, 0.01), (2000, 0.3), (urls.CASCADE_BYTES, 0.97)])
def test_cascade_is_exact(spark, limit, share):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    listed = F.pmod(F.xxhash64("id"), F.lit(1000)) < int(share * 1000)
    cascades = urls.build_cascades(keys.unionByName(keys), "key", listed, limit)
    assert (len(cascades) > 1) == (limit == 2000)
    wrong = urls.with_listed(keys, "key", cascades, "found").where(F.col("found") != listed).count()
    assert wrong == 0
    size = sum(lv.words.nbytes for c in cascades for lv in c.levels)
    assert size < 20_000 * 2


def test_nothing_listed(spark):
    keys = spark.createDataFrame([("a",), (None,)], "key string")
    cascades = urls.build_cascades(keys, "key", F.lit(False))
    assert [r.found for r in urls.with_listed(keys, "key", cascades, "found").collect()] == [False, False]
    assert urls.Cascade(0).listed(np.zeros(2, np.int64), np.zeros(2, np.int64)).tolist() == [False, False]
