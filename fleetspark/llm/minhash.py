"""MinHash near-duplicate documents (five-word shingles, Jaccard).

1. One pass over the texts gives each document's shingle set digest, its size
   and 128 universal-hash minima. Documents with equal sets form a class; from
   here on only the class's least ``doc_id`` works.
2. Banding: 32 bands of 4 minima. Buckets with one class go. In each other
   bucket every member is paired with one leader, the member that meets most
   others, so a bucket of any size costs one pair a member.
3. Signature verification drops pairs far below the threshold (an estimate
   under 0.5 at 0.75 is 6 standard deviations off); full shingle sets confirm
   the rest. Large-star/small-star joins confirmed links.
4. Pairs that a leader did not settle: buckets of three and more that still
   hold several components are compared exhaustively, in blocks of bounded rows and
   bytes and only across components; tasks return links, at most one per document, never all
   pairs. A last large-star/small-star run joins them.

A pair at the threshold meets in no band with probability (1 - 0.75^4)^32,
about 5e-6. No bucket, class or document is dropped or cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm import shingles as S
from fleetspark.llm.common import Scratch, column_names, is_empty, map_rows, table
from fleetspark.llm.components import connected_components

PERCENT = 75
MIN_ESTIMATE = 0.5
BLOCK = 1024
BLOCK_BYTES = 8 << 20


def _signatures(cols: dict[str, list]) -> dict[str, list]:
    S.KNOWN.claim()
    out: dict[str, list] = {k: [] for k in ("doc_id", "n_shingles", "size", "digest", "sig", "bands")}
    for doc, text in zip(cols["doc_id"], cols["text"], strict=True):
        h = S.shingle_set(text)
        sig = S.signature(h) if len(h) else None
        out["doc_id"].append(doc)
        out["n_shingles"].append(len(h))
        out["size"].append(len(text or ""))
        out["digest"].append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
        out["sig"].append(None if sig is None else sig.tobytes())
        out["bands"].append(None if sig is None else S.band_keys(sig))
    return out


def _estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([float(np.mean(np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)))
                      for x, y in zip(a, b, strict=True)], dtype="float64")


def _confirm(cols: dict[str, list], percent: int) -> dict[str, list]:
    sets: dict[str, np.ndarray] = {}

    def shingled(text: str) -> np.ndarray:
        if text not in sets:
            if len(sets) >= 64:
                sets.clear()
            sets[text] = S.shingle_set(text)
        return sets[text]

    ok = [S.similar(shingled(b), S.shingle_set(a), percent)
          for a, b in zip(cols["text_u"], cols["text_v"], strict=True)]
    return {k: [x for x, good in zip(cols[k], ok, strict=True) if good] for k in ("u", "v")}


def _links_between(percent: int):
    """Compares the documents of two blocks of a bucket and returns links that
    span them: pairs in different components whose first common band is this
    bucket's, verified by signature and then by full sets."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sigs = np.stack([np.frombuffer(s, np.uint32) for s in pdf["sig"]])
        bands = sigs.reshape(len(pdf), S.BANDS, S.ROWS)
        comp, doc = pdf["component"].to_numpy(), pdf["doc"].to_numpy()
        block, band = pdf["block"].to_numpy(), int(key[1])
        sets: dict[int, np.ndarray] = {}
        root = {c: c for c in comp}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def shingled(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = S.shingle_set(pdf["text"].iat[i])
            return sets[i]

        found = []
        left = np.flatnonzero(block == key[2])
        right = np.flatnonzero(block == key[3])
        for i in left:
            js = right[right > i] if key[2] == key[3] else right
            js = js[comp[js] != comp[i]]
            if not len(js):
                continue
            est = (sigs[js] == sigs[i]).mean(axis=1)
            js, est = js[est >= MIN_ESTIMATE], est[est >= MIN_ESTIMATE]
            if not len(js):
                continue
            first = (bands[js] == bands[i]).all(axis=2).argmax(axis=1)
            js, est = js[first == band], est[first == band]
            for j in js[np.argsort(-est, kind="stable")]:
                if find(comp[i]) != find(comp[j]) and S.similar(shingled(i), shingled(j), percent):
                    root[find(comp[i])] = find(comp[j])
                    found.append((doc[i], doc[j]))
        return pd.DataFrame(found, columns=["u", "v"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (least doc_id that can be reached over links, itself
    included), kept (doc_id = component_id).

    Links: 100 * intersection >= ``percent`` * union of the sets of distinct
    five-word shingles. Null or wordless texts have an empty set and link with
    nothing. Repeated rows come back as often as they came; rows that share a
    doc_id count as one document. A null doc_id takes no part: component_id is
    null and kept false. Further columns are ignored."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    texts = column_names(docs, "doc_id", "text")
    every = scratch.save(map_rows(texts, _signatures,
                                  "doc_id long, n_shingles long, size long, digest binary, sig binary, bands array<long>"))

    # (written first, so that joins with it have exchanges of their own, whose large partitions can be split)
    classes = scratch.save(every.where("doc_id is not null and digest is not null").groupBy("digest").agg(F.min("doc_id").alias("doc")))
    member = scratch.save(every.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
                          .select("doc_id", "n_shingles", F.col("doc")))
    # One row per class: the row of its least doc_id (rows of equal sets have equal signatures).
    firsts = (every.where("digest is not null")
              .join(classes, (every.digest == classes.digest) & (every.doc_id == classes.doc), "left_semi")
              .dropDuplicates(["doc_id", "digest"]))

    in_band = firsts.select(F.col("doc_id").alias("doc"), "size", F.posexplode("bands").alias("band", "key"))
    several = scratch.save(in_band.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = scratch.save(in_band.join(several, "key"))
    if is_empty(shared):
        components = member.select(F.col("doc").alias("node"), F.col("doc").alias("component")).limit(0)
    else:
        components = scratch.save(_components(scratch, texts, firsts, shared, percent, block))
    return (member.join(components, member.doc == components.node, "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc", "doc_id").alias("component_id"))
            .select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept")))


def _components(scratch: Scratch, texts: DataFrame, firsts: DataFrame, shared: DataFrame,
                percent: int, block: int) -> DataFrame:
    """(node, component) over verified links that connect what all pairs would connect."""
    estimate = F.pandas_udf(_estimate, "double")
    meets = shared.groupBy("doc").agg(F.sum("n").alias("meets"))
    best = (shared.join(meets, "doc").groupBy("key")
            .agg(F.max(F.struct("meets", (-F.col("doc")).alias("doc"))).alias("lead"))
            .select("key", (-F.col("lead.doc")).alias("v")))
    pairs = shared.join(best, "key").where("doc <> v").select(F.col("doc").alias("u"), "v").distinct()

    involved = shared.select("doc").distinct()
    carried = scratch.save(firsts.select(F.col("doc_id").alias("doc"), "sig").join(involved, "doc"))
    sig_u = carried.select(F.col("doc").alias("u"), F.col("sig").alias("sig_u"))
    sig_v = carried.select(F.col("doc").alias("v"), F.col("sig").alias("sig_v"))
    likely = scratch.save(pairs.join(sig_u, "u").join(sig_v, "v")
                          .where(estimate("sig_u", "sig_v") >= MIN_ESTIMATE).select("u", "v"))

    whole = scratch.save(texts.join(involved, F.col("doc_id") == F.col("doc"), "left_semi"))
    text_u = whole.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    text_v = whole.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    sure = scratch.save(map_rows(likely.join(text_u, "u").join(text_v, "v"),
                                 lambda cols: _confirm(cols, percent), "u long, v long"))
    components = scratch.save(connected_components(sure, scratch))

    placed = (shared.join(components, shared.doc == components.node, "left")
              .select("key", "band", "doc", "size", F.coalesce("component", "doc").alias("component")))
    open_keys = (placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b"),
                                           F.count(F.lit(1)).alias("m"), F.sum("size").alias("size")).where("a <> b and m > 2")
                 .select("key", F.ceil(F.greatest(F.col("m") / block, F.col("size") / BLOCK_BYTES)).cast("int").alias("blocks")))
    rest = (placed.join(open_keys, "key")
            .withColumn("block", F.pmod(F.xxhash64("doc"), "blocks").cast("int"))
            .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            .select("key", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "doc", "component", "block"))
    rest = scratch.save(rest)
    if is_empty(rest):
        return components
    loaded = rest.join(carried, "doc").join(whole.select(F.col("doc_id").alias("doc"), "text"), "doc")
    late = scratch.save(loaded.groupBy("key", "band", "i", "j").applyInPandas(_links_between(percent), "u long, v long"))
    if is_empty(late):
        return components
    # The late links join whole components: a second, much smaller graph.
    of_u, of_v = (components.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in ("u", "v"))
    upper = scratch.save(connected_components(
        late.join(of_u, "u", "left").join(of_v, "v", "left")
        .select(F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v")), scratch))
    moved = upper.select(F.col("node").alias("low"), F.col("component").alias("top"))
    raised = components.join(moved, F.col("component") == F.col("low"), "left").select("node", F.coalesce("top", "component").alias("component"))
    return raised.union(upper.join(components, "node", "left_anti"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
