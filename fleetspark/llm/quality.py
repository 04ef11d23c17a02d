"""Quality scores by hierarchical empirical Bayes.

A logistic classifier on text statistics gives each document's evidence. Its
scores, summed per site (host) and per section of a site (path) in one grouped
aggregation, give posterior means: a section is shrunk toward its site and a
site toward the corpus, the less text it has the more. How strongly comes from
the corpus itself (moments of the site means). A document's final log odds are
its evidence plus what its section says beyond the corpus prior.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, column_names, map_rows, table

#: Labelled rows that the classifier is fitted on, at most (those with the least
#: hashes of their doc_id); the rest of the labels is not needed.
MAX_LABELLED = 20_000
THRESHOLD = 0.5
SURE = 1e-4
FEATURES = ("log_words", "word_length", "upper", "symbols", "digits", "distinct", "commonest", "odd_endings",
            "lone_signs", "repeated_lines", "letters", "five_word_repeats", "long_words")
_ODD_END = re.compile(r"[^\w\s.,;:?!'\")\]][^\w\s]*$|!!+$")


def text_features(text: str | None) -> list[float]:
    """Statistics of a whole text, each between 0 and about 10; all 0 without words."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), sum(map(len, words))
    joined = "".join(words)
    counts = Counter(words)
    letters = sum(map(str.isalpha, joined))
    lines = [x for x in text.split("\n") if x.strip()]
    fives = list(zip(*(words[i:] for i in range(5)), strict=False))
    endings = sum(c for w, c in counts.items() if _ODD_END.search(w))
    signs = sum(c for w, c in counts.items() if not any(map(str.isalnum, w)))
    return [float(x) for x in (
        np.log1p(n), min(chars / n, 50) / 5, sum(map(str.isupper, joined)) / max(1, letters),
        sum(not ch.isalnum() for ch in joined) / chars, sum(map(str.isdigit, joined)) / chars,
        len(counts) / n, counts.most_common(1)[0][1] / n, endings / n, signs / n,
        1 - len(set(lines)) / max(1, len(lines)), letters / chars,
        1 - len(set(fives)) / len(fives) if fives else 0.0, sum(c for w, c in counts.items() if len(w) > 25) / n)]


def _with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with ``features`` in place of ``text``."""
    others = [c for c in docs.columns if c != "text"]
    kinds = dict(docs.dtypes)
    return map_rows(docs, lambda cols: {c: cols[c] for c in others} | {"features": [text_features(t) for t in cols["text"]]},
                    "".join(f"`{c}` {kinds[c]}, " for c in others) + "features array<double>")


def fit_classifier(texts: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[list[float], float] | None:
    """Weights and intercept of a logistic regression fitted on at most ``most``
    labelled documents; None where the labels hold fewer than two classes."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    chosen = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    one = texts.join(chosen, "doc_id").select("doc_id", "quality", "features")
    known = one.select(F.col("quality").cast("double").alias("label"), array_to_vector("features").alias("features")).cache()
    try:
        if known.select("label").distinct().count() < 2:
            return None
        fit = LogisticRegression(maxIter=60, regParam=1e-3).fit(known)
        return [float(x) for x in fit.coefficients], float(fit.intercept)
    finally:
        known.unpersist()


def _clamped(p: Column) -> Column:
    return F.greatest(F.lit(SURE), F.least(F.lit(1 - SURE), p))


def _log_odds(p: Column) -> Column:
    return F.log(_clamped(p) / (1 - _clamped(p)))


def _strength(groups: DataFrame) -> float:
    """How many documents a prior counts for, by moments: the variance of group
    means (column mean, n documents, prior) beyond what n documents explain."""
    spread = F.col("prior") * (1 - F.col("prior"))
    miss, noise, own = groups.where("n > 0").agg(
        F.sum(F.col("n") * (F.col("mean") - F.col("prior")) ** 2), F.sum(spread), F.sum(F.col("n") * spread)).first()
    if not own:
        return 1e4
    return float(min(1e4, max(1.0, own / max(miss - noise, own * 1e-4))))


def quality_scores(docs: DataFrame, labels: DataFrame, site: Column | None = None, section: Column | None = None,
                   threshold: float = THRESHOLD, most_labelled: int = MAX_LABELLED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, site, section, evidence (the classifier's probability of good
    quality), site_posterior, section_posterior, score, keep (score >=
    ``threshold``), then the ``carry`` columns, one row per row of ``docs``
    (doc_id, text, source, lang).

    ``site`` and ``section`` default to the source and the language within it;
    for pages, give host and path. Nulls in them are groups of their own. A
    null or wordless text gets the classifier's verdict on empty text. With
    labels of fewer than two classes nothing is known: all scores 0.5, all
    kept. Repeated rows are scored alike; an empty table gives no rows."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    if site is None:
        site = F.col("source")
    if section is None:
        section = F.col("lang")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), site.cast("string").alias("site"), section.cast("string").alias("section"), "text", *carry)
    measured = scratch.save(_with_features(texts))
    fitted = fit_classifier(measured, column_names(labels, "doc_id", "quality"), most_labelled)
    weights, base = fitted or ([0.0] * len(FEATURES), 0.0)
    odds = sum((F.col("features")[i] * w for i, w in enumerate(weights)), F.lit(base))
    scored = measured.select("doc_id", "site", "section", *carry, _clamped(1 / (1 + F.exp(-odds))).alias("evidence"))

    sections = scratch.save(scored.groupBy("site", "section").agg(F.count(F.lit(1)).alias("n"), F.sum("evidence").alias("s")))
    prior = sections.agg(F.sum("s") / F.sum("n")).first()[0]
    prior = 0.5 if prior is None else float(prior)
    sites = sections.groupBy("site").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).withColumn("prior", F.lit(prior))
    k = _strength(sites.withColumn("mean", F.col("s") / F.col("n")))
    sites = scratch.save(sites.select(F.col("site").alias("a"), ((F.col("s") + k * F.lit(prior)) / (F.col("n") + k)).alias("site_posterior")))
    within = sections.join(sites, F.col("site").eqNullSafe(F.col("a"))).withColumn("prior", F.col("site_posterior"))
    k = _strength(within.withColumn("mean", F.col("s") / F.col("n")))
    posterior = scratch.save(within.select(
        "a", F.col("section").alias("b"), "site_posterior",
        ((F.col("s") + k * F.col("site_posterior")) / (F.col("n") + k)).alias("section_posterior")))
    score = 1 / (1 + F.exp(-(_log_odds(F.col("evidence")) + _log_odds(F.col("section_posterior")) - _log_odds(F.lit(prior)))))
    return (scored.join(posterior, F.col("site").eqNullSafe(F.col("a")) & F.col("section").eqNullSafe(F.col("b")))
            .select("doc_id", "site", "section", "evidence", "site_posterior", "section_posterior",
                    (score if fitted else F.lit(0.5)).alias("score"), *carry)
            .withColumn("keep", F.col("score") >= threshold if fitted else F.lit(True)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
