"""Approximate nearest neighbours by a permutation index.

Each vector is represented by its nearest pivots in order. The index is dealt
into shards; a shard posts its vectors in one inverted file per pivot, with
their places. A query adds up over its own pivots' files what brings the
footrule distance of the two orders down, keeps the share of the shard with
the least distance, and reranks it by the true measure; the shards' best are
merged. Pivots (PIVOTS vectors) are chosen from a bounded sample, each the
farthest from those before, so that a dense group gets few of them however
many rows it has; every vector is indexed.

The share is measured, not assumed: about MEASURED of the queries are first
compared with every row, and the share is the least that keeps RECALL of the
neighbours found so. Vectors that lie in groups need a thousandth of a shard,
vectors without any structure in hundreds of dimensions near a half.

The queries (a stated set) meet the shards in blocks of queries, so a task
holds one shard and one block whatever the size of either table. Measured
recall on the given tables is in the README.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, map_rows, table
from fleetspark.llm.vectors import matrix, sample, unit, usable_vectors

PIVOTS = 512
PLACES = 64
AT_LEAST = 16
#: Rows of a shard: the first for small tables, the second at most.
SHARDS = 8192, 65_536
QUERIES = 16_384
#: Queries (at most twice as many) that measure the share, and the part of
#: their neighbours that it keeps. Fewer neighbours than EVIDENCE tell nothing:
#: vectors of such a length are all reranked.
MEASURED = 128
RECALL = 0.97
EVIDENCE = 100
QUERY_STEP = 50


def _apart(x: np.ndarray, pivots: int) -> np.ndarray:
    """Up to ``pivots`` of the unit vectors, farthest first."""
    chosen = [int(np.random.default_rng(5).integers(len(x)))]
    nearest_one = x @ x[chosen[0]]
    while len(chosen) < min(pivots, len(x)):
        chosen.append(int(nearest_one.argmin()))
        nearest_one = np.maximum(nearest_one, x @ x[chosen[-1]])
        nearest_one[chosen] = np.inf
    return x[chosen]


def _places(x: np.ndarray, pivots: np.ndarray, places: int) -> np.ndarray:
    """Numbers of each row's nearest pivots, nearest first."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :places].astype(np.int16)


class _Shard:
    """The vectors of a shard and their inverted files."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("vec_id")
        self.ids = rows["vec_id"].to_numpy()
        self.x = np.stack([np.frombuffer(v) for v in rows["vec"]])
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        orders = np.stack([np.frombuffer(o, np.int16) for o in rows["near"]])
        self.places = orders.shape[1]
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable").astype(np.int32)
        self.bounds = np.searchsorted(flat[by_pivot], np.arange(flat.max(initial=-1) + 2))
        self.posted = by_pivot // max(1, self.places)
        self.weight = (self.places - by_pivot % max(1, self.places)).astype(np.int32)

    def shared(self, near: bytes) -> np.ndarray:
        """What the pivots of an order take from the footrule distance to each
        vector, which is a constant less twice the sum over shared pivots of
        the lesser nearness."""
        shared = np.zeros(len(self.ids), np.int32)
        for place, pivot in enumerate(np.frombuffer(near, np.int16)):
            if pivot + 1 < len(self.bounds):
                file = slice(self.bounds[pivot], self.bounds[pivot + 1])
                shared[self.posted[file]] += np.minimum(self.weight[file], self.places - place)
        return shared

    def best(self, q: np.ndarray, query: int, among: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of some rows the k with the largest cosine, the query itself left out."""
        among = among[self.ids[among] != query]
        score = (self.x[among] * q).sum(axis=1) / (self.norm[among] * np.sqrt((q * q).sum()))
        top = np.lexsort((self.ids[among], -score))[:k]
        return among[top], score[top]


def _asked(rows: pd.DataFrame):
    return zip(rows["vec_id"], (np.frombuffer(v) for v in rows["vec"]), rows["near"], strict=True)


def _search(k: int, shares: dict[int, float], at_least: int):
    """The k best of a shard for each query of a block."""
    def run(key: tuple, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        shard = _Shard(rows) if len(rows) and len(asked) else None
        for query, q, near in _asked(asked) if shard else ():
            n = len(shard.ids)
            wanted = max(at_least, int(np.ceil(shares.get(int(key[0]), 1.0) * n))) + 1
            among = np.arange(n)
            if wanted < n and shard.places:
                among = np.sort(np.argpartition(-shard.shared(near), wanted - 1)[:wanted])
            found, score = shard.best(q, query, among, k)
            out += zip([query] * len(found), shard.ids[found], score, strict=True)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def _measure(k: int):
    """The k truly best of a shard for each query, with the share of the shard
    that has to be reranked to meet them."""
    def run(key: tuple, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        shard = _Shard(rows) if len(rows) and len(asked) else None
        for query, q, near in _asked(asked) if shard else ():
            found, score = shard.best(q, query, np.arange(len(shard.ids)), k)
            shared = shard.shared(near)
            out += [(key[0], query, shard.ids[i], s, float((shared >= shared[i]).mean())) for i, s in zip(found, score, strict=True)]
        return pd.DataFrame(out, columns=["dim", "query_id", "vec_id", "score", "share"]).astype(
            {"dim": "int32", "query_id": "int64", "vec_id": "int64", "score": "float64", "share": "float64"})

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS, places: int = PLACES,
            share: float | None = None, recall: float = RECALL, at_least: int = AT_LEAST, shard: int | None = None,
            block: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine, in double precision) of
    the ``k`` nearest found of each query: the rows of ``embeddings`` (vec_id,
    embedding) that ``is_query`` names, each against all other rows, ties to
    the lesser vec_id.

    ``share`` of a shard is reranked for each query (1.0 is exact); without it,
    it is measured so that about ``recall`` of the neighbours are found, for
    vectors of each length by itself.

    Vectors that are null, empty, zero or hold null or non-finite components
    take no part; vectors of different lengths are no neighbours. Rows that
    share a vec_id count once; null ids are left out; further columns are
    ignored. A query without any other row gives no rows."""
    spark: SparkSession = embeddings.sparkSession
    scratch = Scratch(spark, "pivots")
    every = scratch.save(usable_vectors(embeddings).where("usable").select("vec_id", "embedding"))
    count = every.count()
    chosen: dict[int, list] = {}
    for r in sample(every, count, 4 * pivots):
        chosen.setdefault(len(r.embedding), []).append(r.embedding)
    tables = spark.sparkContext.broadcast({
        d: _apart(unit(matrix(v)), pivots) for d, v in chosen.items()})

    def represented(cols: dict[str, list]) -> dict[str, list]:
        dims = np.array([len(v) for v in cols["embedding"]], np.int32)
        near, vecs = [b""] * len(dims), [b""] * len(dims)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = matrix([cols["embedding"][i] for i in at])
            orders = _places(unit(x), tables.value[int(d)], places) if int(d) in tables.value else np.empty((len(at), 0), np.int16)
            for i, v, o in zip(at, x, orders, strict=True):
                vecs[i], near[i] = v.tobytes(), o.tobytes()
        return {"vec_id": cols["vec_id"], "dim": dims.tolist(), "vec": vecs, "near": near}

    index = scratch.save(map_rows(every, represented, "vec_id long, dim int, vec binary, near binary"))
    queries = index.where(is_query)
    asked = queries.count()
    shards = max(1, -(-count // (shard or min(SHARDS[1], max(SHARDS[0], count // 64)))))

    def met(queries: DataFrame, blocks: int, compare, schema: str) -> DataFrame:
        """Every block of the queries with every shard of the index."""
        def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
            return df.withColumns({own: F.pmod(F.xxhash64("vec_id", F.lit(n)), F.lit(n)).cast("int"),
                                   other: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))})

        return (dealt(index, "shard", shards, "block", blocks).groupBy("dim", "shard", "block")
                .cogroup(dealt(queries, "block", blocks, "shard", shards).groupBy("dim", "shard", "block"))
                .applyInPandas(compare, schema))

    shares: dict[int, float] = {}
    if share is None and asked:
        measuring = queries.where(F.pmod(F.xxhash64("vec_id", F.lit("measure")), F.lit(max(1, asked // MEASURED))) == 0).limit(2 * MEASURED)
        needed: dict[int, list[float]] = {}
        for r in _best(met(measuring, 1, _measure(k), "dim int, query_id long, vec_id long, score double, share double"), k).collect():
            needed.setdefault(r.dim, []).append(r.share)
        shares = {d: float(np.quantile(v, recall, method="higher")) for d, v in needed.items() if len(v) >= EVIDENCE}
    elif share is not None:
        shares = dict.fromkeys(tables.value, share)
    found = met(queries, max(1, -(-asked // block)), _search(k, shares, at_least), "query_id long, vec_id long, score double")
    return _best(found, k).select("query_id", "rank", "vec_id", "score")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(QUERY_STEP)) == 0)
