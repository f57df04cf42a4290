"""Url rules and the two character models against plain loops."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SAMPLE_DIR
from eventlake.llm import queries, url_filter
from eventlake.llm.url_filter import Rule, Settings

RULES = queries.URL_RULES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def plain_rule(host, path):
    fits = [r for r in RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def plain_score(url, counts, order):
    """Witten-Bell from the longest context down, one byte after another."""
    if not url:
        return 0.0
    data = bytes([2]) * order + url.encode() + bytes([3])
    total = 0.0
    for i in range(order, len(data)):
        p = [1 / 256, 1 / 256]
        for k in range(order + 1):
            context = data[i - k : i]
            for m in (0, 1):
                after = counts[m].get((k, context), {})
                if after:
                    p[m] = (after.get(data[i], 0) + len(after) * p[m]) / (sum(after.values()) + len(after))
        total += math.log(p[0]) - math.log(p[1])
    return total / (len(data) - order)


def plain_counts(examples, order):
    counts = ({}, {})
    for url, accepted in examples:
        data = bytes([2]) * order + url.encode() + bytes([3])
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[0 if accepted else 1].setdefault((k, data[i - k : i]), Counter())[data[i]] += 1
    return counts


URLS = [
    "http://a.com/x", "HTTP://A.COM/en/1?q=/es/", "https://www.example.com/en/1", "https://m.www.example.com/en/2", "https://example.com/en",
    "https://x.example.com/en/", "http://b.net/es/1", "http://b.net/fr/", "http://b.net/de/9#/es/", "http://com", "http://com/", "http://com?x/",
    "http://dotcom/", "http://ü.COM/ß", "no scheme", "", None, "://", "http:///en/", "ftp://u.net/es/a/b?c#d", "x://y.org/z://a.com/", "a\nb://n.net/es/\n",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id LONG, url STRING")
    host, path = url_filter.url_parts(F.col("url"))
    got = df.select("url", host.alias("h"), path.alias("p"), url_filter.fitting_rule(host, path, RULES).alias("r")).collect()
    for row in got:
        h, p = plain_parts(row["url"])
        rule = plain_rule(h, p)
        assert (row["h"], row["p"]) == (h, p)
        assert (row["r"] and tuple(row["r"])) == (rule and (rule.name, rule.verdict))


def test_scores_equal_plain_loops(spark):
    rows = spark.read.parquet(f"{SAMPLE_DIR}/pages.parquet").select("page_id", "url").collect()
    pages = spark.createDataFrame(rows + [(None, u) for u in URLS], "page_id LONG, url STRING").repartition(3)
    settings = Settings(order=4, least_share=0.0)
    model = url_filter.fit(pages, RULES, settings)
    urls = [r["url"] for r in rows] + URLS
    examples = []
    for u in urls:
        rule = plain_rule(*plain_parts(u))
        if rule and zlib.crc32(u.encode()) % settings.held_back:
            examples.append((u, rule.verdict == "allow"))
    counts = plain_counts(examples, 4)
    for r in url_filter.judge(pages, RULES, model).collect():
        host, path = plain_parts(r["url"])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None)
        assert r["score"] == pytest.approx(plain_score(r["url"], counts, 4), abs=1e-9)
        own = "allow" if r["score"] >= model.cut else "block"
        assert r["verdict"] == (rule.verdict if rule else own)


def labelled(spark, folder, seed):
    """Hosts of two kinds of spelling; a third of all rows is one url."""
    rng = np.random.default_rng(seed)
    kinds = ["news library museum garden".split(), "cheap pills casino bonus".split()]
    rows = []
    for i in range(1500):
        bad = i % 2
        words = rng.choice(kinds[bad], 2)
        end = ["com/de/", "net/es/"][bad] if i % 3 else "org/en/"
        rows.append((i, f"https://{words[0]}{words[1]}.example.{end}{rng.integers(1000)}", f"{bad}"))
    rows += [(2000 + i, "https://newslibrary.example.com/de/1", "0") for i in range(750)]
    spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING").repartition(4).write.parquet(f"{folder}/pages.parquet")
    return rows


def test_urls_without_a_rule_are_told_apart(spark, tmp_path):
    rows = labelled(spark, tmp_path, 3)
    got = {r["page_id"]: r for r in queries.op12_urls(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    free = [(got[i], bad) for i, _, bad in rows if got[i]["rule"] is None]
    assert len(free) == 500
    assert np.mean([(r["verdict"] == "block") == (bad == "1") for r, bad in free]) > 0.97


def test_pruned_contexts_bound_the_model(spark, tmp_path):
    labelled(spark, tmp_path, 4)
    pages = spark.read.parquet(f"{tmp_path}/pages.parquet")
    small = url_filter.fit(pages, RULES, Settings(least_share=1e-3))
    assert len(small.grams) <= 6 * 2 / 1e-3 and len(small.grams) < len(url_filter.fit(pages, RULES).grams)
    urls = [r["url"] for r in pages.where("url like '%.org%'").collect()]
    found = small.scores(urls)
    assert np.mean([(s < small.cut) == ("news" not in u and "library" not in u and "museum" not in u and "garden" not in u) for s, u in zip(found, urls)]) > 0.95


def test_one_kind_of_examples_or_none(spark):
    schema = "page_id LONG, url STRING, host INT, score INT, verdict INT, rule INT, path INT"
    for urls in ([(1, "http://a.com/")], [(1, "http://a.org/"), (None, None)], []):
        pages = spark.createDataFrame([(i, u, 1, 1, 1, 1, 1) for i, u in urls], schema)
        got = url_filter.judge(pages, RULES, url_filter.fit(pages, RULES)).collect()
        assert [r["verdict"] for r in got] == ["allow"] * len(urls)
    assert url_filter.judge(pages, [], url_filter.fit(pages, [])).count() == 0
    with_empty = [Rule("block", "", "")]  # no host ends in a dot
    one = spark.createDataFrame([(1, "http:///x")], "page_id LONG, url STRING")
    assert url_filter.judge(one, with_empty, url_filter.fit(one, with_empty)).first()["verdict"] == "block"
