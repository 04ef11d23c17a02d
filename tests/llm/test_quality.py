"""Quality scores: held-out accuracy, shrinkage, odd tables."""

from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from fleetspark.llm import quality
from fleetspark.llm.quality import FEATURES, quality_scores, text_features

DATA = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, site string, score double, n int"


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    fitted = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0)
    scores = quality_scores(docs, fitted)
    assert scores.count() == docs.count()
    rows = labels.join(fitted, "doc_id", "left_anti").join(scores, "doc_id").collect()
    assert sum(r.keep == (r.quality == 1) for r in rows) >= 0.98 * len(rows)
    assert all(r.keep for r in rows if r.quality == 1)


def test_sparse_sections_shrink_toward_their_site(spark):
    good, bad = "the cat sat on the mat, and the dog saw it. " * 5, "AAAA!! BBBB!! " * 20
    rows = [(i, good if i % 2 else bad, f"p{i % 2}", "big", "x", 0.0, 1) for i in range(200)]
    rows += [(1000, good, "p", "lone", "x", 0.0, 1)]
    labels = spark.createDataFrame([(i, i % 2, 7) for i in range(100)], "doc_id long, quality int, score int")
    got = {r.doc_id: r for r in quality_scores(spark.createDataFrame(rows, SCHEMA), labels).collect()}
    assert got[1].section_posterior > got[1].site_posterior > got[0].section_posterior
    assert got[1].section_posterior > got[1000].section_posterior  # 100 documents say more than one
    assert got[1].keep and not got[0].keep and got[1000].keep


def test_odd_tables(spark):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (77, 0)], "doc_id long, quality int")
    rows = [(1, "good words here", "en", "s", "", 0.0, 1), (2, None, None, None, "", 0.0, 1), (2, "", None, None, "", 0.0, 1),
            (None, "x" * 100_000, "en", "s", "", 0.0, 1), (4, "w " * 50_000, "en", None, "", 0.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert quality_scores(df, labels).count() == 5
    unknown = quality_scores(df, labels.limit(0)).collect()
    assert [(r.score, r.keep) for r in unknown] == [(0.5, True)] * 5
    assert quality_scores(df.limit(0), labels).collect() == []
    pages = spark.createDataFrame([(1, "text", "http://a.b/c/d")], "doc_id long, text string, url string")
    by_host = quality_scores(pages, labels, F.regexp_extract("url", "//([^/]*)", 1), F.regexp_extract("url", "//[^/]*(/[^/]*)", 1))
    assert [(r.site, r.section) for r in by_host.collect()] == [("a.b", "/c")]


def test_features_are_bounded():
    for text in (None, "", " ", "a", "é" * 10, "!!! ???", "a b c d e f " * 1000):
        got = text_features(text)
        assert len(got) == len(FEATURES) and all(0 <= x <= 12 for x in got)


def _plain_fit(features, labels):
    """Logistic regression by Newton steps: mean loss plus 1e-3 / 2 times the
    squared weights of the features in units of their deviation."""
    x = np.array(features, float)
    scale = x.std(axis=0, ddof=1)
    scale[scale == 0] = np.inf
    z = np.hstack([x / scale, np.ones((len(x), 1))])
    penalty = np.diag([1e-3] * x.shape[1] + [0.0])
    w = np.zeros(z.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-z @ w))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(z) + penalty + 1e-12 * np.eye(len(w)),
                               z.T @ (p - labels) / len(z) + penalty @ w)
        w -= step
    return w[:-1] / scale, w[-1]


def _strength(groups):
    """groups: (mean, n, prior)."""
    miss = sum(n * (m - q) ** 2 for m, n, q in groups)
    noise, own = sum(q * (1 - q) for _, _, q in groups), sum(n * q * (1 - q) for _, n, q in groups)
    return min(1e4, max(1.0, own / max(miss - noise, own * 1e-4)))


def _plain_scores(rows, threshold):
    """rows: (id, site, section, evidence) -> id: (site posterior, section posterior, score, keep)."""
    sure = quality.SURE
    odds = lambda p: np.log(min(max(p, sure), 1 - sure) / (1 - min(max(p, sure), 1 - sure)))
    prior = sum(r[3] for r in rows) / len(rows)
    site, section = {}, {}
    for _, a, b, e in rows:
        for table, key in ((site, a), (section, (a, b))):
            n, s = table.get(key, (0, 0.0))
            table[key] = (n + 1, s + e)
    k = _strength([(s / n, n, prior) for n, s in site.values()])
    site_p = {a: (s + k * prior) / (n + k) for a, (n, s) in site.items()}
    k = _strength([(s / n, n, site_p[a]) for (a, _), (n, s) in section.items()])
    section_p = {(a, b): (s + k * site_p[a]) / (n + k) for (a, b), (n, s) in section.items()}
    out = {}
    for i, a, b, e in rows:
        score = 1 / (1 + np.exp(-(odds(e) + odds(section_p[a, b]) - odds(prior))))
        out[i] = (site_p[a], section_p[a, b], score, score >= threshold)
    return out


def _against_plain(got, threshold=quality.THRESHOLD):
    want = _plain_scores([(r.doc_id, r.site, r.section, r.evidence) for r in got], threshold)
    for r in got:
        plain = want[r.doc_id]
        assert (r.site_posterior, r.section_posterior, r.score) == pytest.approx(plain[:3], rel=1e-9, abs=1e-12)
        assert r.keep == plain[3] or abs(r.score - threshold) < 1e-9


def test_query_against_plain_version(spark):
    """Evidence by an own fit, all posteriors and decisions by plain loops."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality is not null").collect()}
    got = quality.op9_quality(spark, SMALL).collect()
    assert len(got) == len(docs)
    _against_plain(got)
    known = sorted(d for d in labels if d in docs)
    weights, base = _plain_fit([quality.text_features(docs[d]) for d in known], np.array([labels[d] for d in known], float))
    for r in got:
        plain = 1 / (1 + np.exp(-(np.dot(quality.text_features(docs[r.doc_id]), weights) + base)))
        assert r.evidence == pytest.approx(plain, abs=0.03)


def test_posteriors_of_sparse_sites_hosts_and_paths(spark):
    """Sites of one document and of many, null sites, host and path of a page's address."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").where("url is not null")
    docs = pages.select(F.col("page_id").alias("doc_id"), F.regexp_replace("html", "<[^>]*>", " ").alias("text"), "url")
    docs = docs.withColumn("source", F.lit("x")).withColumn("lang", F.lit("y"))
    labels = docs.select("doc_id", (F.pmod(F.xxhash64("doc_id"), F.lit(2))).cast("int").alias("quality"))
    host, path = F.parse_url("url", F.lit("HOST")), F.regexp_extract(F.parse_url("url", F.lit("PATH")), "^/([^/]*)", 1)
    got = quality.quality_scores(docs, labels, site=F.when(F.length(host) % 5 > 0, host), section=path).collect()
    assert len({r.site for r in got}) > 1 and len(got) == docs.count()
    _against_plain(got)


def test_ties_at_the_threshold(spark):
    docs = spark.createDataFrame([(i, t, "s", "l") for i, t in enumerate(["a good text", "bad bad bad"] * 6)],
                                 "doc_id long, text string, source string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    first = quality.quality_scores(docs, labels).collect()
    tie = first[0].score
    again = quality.quality_scores(docs, labels, threshold=tie).collect()
    assert all(r.keep == (r.score >= tie) for r in again) and any(r.score == tie and r.keep for r in again)
