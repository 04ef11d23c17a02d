"""Near-duplicate embeddings by a forest of random projection trees.

Dense groups come first. A sampled vector that links with several others of
the sample is dense; leaders, more than the link angle apart, are chosen among
the dense ones so that each has one within that angle. A vector within twice
the angle of a leader has the nearest such leader as its home, and meets all
vectors within three times the angle of it: whatever a vector with a home
links with is among these, so its links are found without chance. A vector
that links with a dense one always has a home.

The vectors without a home go through the forest. A tree splits recursively at the median of a random projection; vectors near a
split go to both sides (spill). Equal vectors are one class and travel once.
Vectors that share a leaf of any tree are compared, in blocks of bounded size
for leaves that hold many; a pair is counted in the first leaf it shares only,
so tasks return sums and a spanning set of links, never all pairs. Links are
then joined by large-star/small-star.

The splits are fitted on a bounded sample (SAMPLE vectors, the same for the
leaders); every vector without a home is routed through every tree. Recall comes from the number of trees: vectors at
cosine 0.95 lie 0.32 apart, a split parts them with a probability of a few
hundredths, and TREES trees miss a pair together far more rarely than one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, map_rows, table
from fleetspark.llm.components import connected_components
from fleetspark.llm.vectors import matrix, sample, unit, usable_vectors

COSINE = 0.95
TREES = 16
LEAF = 512
SPILL = 0.04
SAMPLE = 16_384
#: Vectors routed through the trees at a time (fewer if they are long).
ROUTED = 8192
BLOCK = 2048
LEAVES = 1 << 20
#: Sampled vectors that a dense one links with, at least: as many as a group of an
#: eighth of a leaf has in the sample, and never fewer than FEWEST.
FEWEST = 3


def dense_leaders(x: np.ndarray, least: int, cosine: float) -> np.ndarray:
    """Of unit vectors, some that link with ``least`` others or more, the ones
    with most links first, none linked with another; each such vector is one of
    them or links with one."""
    degree = np.concatenate([(x[i:i + BLOCK] @ x.T >= cosine).sum(axis=1) for i in range(0, len(x), BLOCK)] or [np.empty(0, int)]) - 1
    open_ = degree >= least
    chosen = []
    for i in np.argsort(-degree, kind="stable"):
        if open_[i]:
            chosen.append(i)
            open_ &= x @ x[i] < cosine
            open_[i] = False
    return x[chosen]


def homes(x: np.ndarray, leaders: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """For unit vectors: the number of each one's home (-1 without), and which
    leaders' vectors it meets (one column a leader)."""
    if not len(leaders):
        return np.full(len(x), -1), np.zeros((len(x), 0), bool)
    angle = np.arccos(np.clip(cosine, -1, 1))
    near = x @ leaders.T
    best = near.argmax(axis=1)
    within = near[np.arange(len(x)), best] >= np.cos(min(np.pi, 2 * angle)) - 1e-6
    return np.where(within, best, -1), near >= np.cos(min(np.pi, 3 * angle + 1e-2)) - 1e-6


class Forest:
    """Trees as nested tuples (direction, low, high, left, right); None is a leaf."""

    def __init__(self, rows: np.ndarray, count: int, trees: int, leaf: int, spill: float, seed: int):
        rng = np.random.default_rng(seed)
        depth = max(0, int(np.ceil(np.log2(max(1, count) / leaf))))
        self.trees = [self._grow(rng, rows, depth, spill) for _ in range(trees)]

    def _grow(self, rng, rows: np.ndarray, depth: int, spill: float):
        if depth <= 0 or len(rows) < 16:
            return None
        direction = rng.standard_normal(rows.shape[1])
        at = rows @ direction
        middle, low, high = np.quantile(at, [0.5, 0.5 - spill / 2, 0.5 + spill / 2])
        if at.min() >= middle or at.max() <= middle:
            return None
        return (direction, low, high, self._grow(rng, rows[at <= middle], depth - 1, spill),
                self._grow(rng, rows[at > middle], depth - 1, spill))

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row number, code) for every leaf a row falls in; a code is the
        tree's number times LEAVES plus the leaf's."""
        found = []
        for t, tree in enumerate(self.trees):
            n = 0
            stack = [(tree, np.arange(len(rows)))]
            while stack:
                node, members = stack.pop()
                if node is None:
                    found.append((members, np.full(len(members), t * LEAVES + n)))
                    n += 1
                    continue
                direction, low, high, left, right = node
                at = rows[members] @ direction
                stack += [(left, members[at <= high]), (right, members[at > low])]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _hits(x: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool, cosine: float) -> np.ndarray:
    """Which rows ``a`` of unit vectors link with which rows ``b`` (``same``:
    the same rows). Pairs at the threshold are added up in one fixed order."""
    score = x[a] @ x[b].T
    hit = score >= cosine - 1e-9
    i, j = np.nonzero(hit & (score <= cosine + 1e-9))
    hit[i, j] = (x[a[i]] * x[b[j]]).sum(axis=1) >= cosine
    if same:
        np.fill_diagonal(hit, False)
    return hit


def _sums_and_spanning(ids: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, same: bool, hit: np.ndarray,
                       counted: np.ndarray) -> pd.DataFrame:
    """For links ``hit`` between rows ``a`` and ``b``: the vectors linked with
    each ``counted`` row (kind 0), and links that span them (kind 1)."""
    linked = np.zeros(len(ids), np.int64)
    linked[a] = hit @ size[b]
    if not same:
        linked[b] = size[a] @ hit
    rows = [(0, ids[i], linked[i]) for i in np.flatnonzero((linked > 0) & counted)]
    # A spanning set: from each vector on to those it links with that no one came to yet.
    side, across = (a, b), (hit, hit.T)
    todo = [np.ones(len(a), bool)]
    todo.append(todo[0] if same else np.ones(len(b), bool))
    for start in np.flatnonzero(hit.any(axis=1)):
        stack = [(0, start)] if todo[0][start] else []
        todo[0][start] = False
        while stack:
            s, i = stack.pop()
            fresh = np.flatnonzero(across[s][i] & todo[1 - s])
            todo[1 - s][fresh] = False
            stack += [(1 - s, j) for j in fresh]
            rows += [(1, ids[side[s][i]], ids[side[1 - s][j]]) for j in fresh]
    return pd.DataFrame(rows, columns=["kind", "u", "v"], dtype="int64")


NO_LINKS = pd.DataFrame({c: np.empty(0, np.int64) for c in ("kind", "u", "v")})


def _met_before(codes: list[bytes], i: np.ndarray, j: np.ndarray, code: int, pairs: int = 4096) -> np.ndarray:
    """Whether rows i and j (pair by pair) share a leaf that comes before ``code``."""
    who, flat = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = flat[:len(i)], flat[len(i):]
    own = [np.frombuffer(codes[w], np.int32) for w in who]
    before = np.full((len(own), max(map(len, own))), -1, np.int32)
    for row, c in zip(before, own, strict=True):
        c = c[c < code]
        row[:len(c)] = c
    return np.concatenate([
        ((before[i[s:s + pairs], :, None] == before[j[s:s + pairs], None, :]) & (before[i[s:s + pairs], :, None] >= 0)).any(axis=(1, 2))
        for s in range(0, len(i), pairs)])


def _compare(cosine: float):
    """Links between two blocks of a leaf whose first common leaf it is, as in
    :func:`_sums_and_spanning`."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.frombuffer(b"".join(pdf["vec"])).reshape(len(pdf), -1))
        block = pdf["block"].to_numpy()
        a, b, same = np.flatnonzero(block == key[2]), np.flatnonzero(block == key[3]), key[2] == key[3]
        hit = _hits(x, a, b, same, cosine)
        i, j = np.nonzero(hit)
        if not len(i):
            return NO_LINKS
        hit[i, j] = ~_met_before(pdf["codes"].tolist(), a[i], b[j], int(key[1]))
        return _sums_and_spanning(pdf["rep"].to_numpy(), pdf["n"].to_numpy(), a, b, same, hit, np.ones(len(pdf), bool))

    return run


def _compare_dense(cosine: float):
    """Links between two blocks of a leader's vectors of which one end has its
    home here (role 2). Ends with a home elsewhere (role 0) count theirs there,
    ends without any (role 1) here. Rows as in :func:`_sums_and_spanning`."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.frombuffer(b"".join(pdf["vec"])).reshape(len(pdf), -1))
        block, role = pdf["block"].to_numpy(), pdf["role"].to_numpy()
        a, b, same = np.flatnonzero(block == key[2]), np.flatnonzero(block == key[3]), key[2] == key[3]
        hit = _hits(x, a, b, same, cosine) & ((role[a] == 2)[:, None] | (role[b] == 2))
        return _sums_and_spanning(pdf["rep"].to_numpy(), pdf["n"].to_numpy(), a, b, same, hit, role > 0)

    return run


def near_duplicate_vectors(embeddings: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF,
                           spill: float = SPILL, sample_rows: int = SAMPLE, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """One row per vec_id of ``embeddings`` (vec_id, embedding): vec_id, n_links
    (other vectors linked directly: cosine >= ``cosine``, in double
    precision), component_id (least vec_id that can be reached), kept (vec_id
    = component_id).

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, as do vectors of different lengths with each other.
    Rows that share a vec_id count once (the least vector); null ids are left
    out; further columns are ignored."""
    spark: SparkSession = embeddings.sparkSession
    scratch = Scratch(spark, "forest")
    every = scratch.save(usable_vectors(embeddings))
    classes = scratch.save(every.where("usable").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    count = classes.count()
    picked: dict[int, list] = {}
    for r in sample(classes.select(F.col("rep").alias("vec_id"), "embedding"), count, sample_rows):
        picked.setdefault(len(r.embedding), []).append(r.embedding)
    sampled = sum(map(len, picked.values()))
    least = max(FEWEST, int(np.ceil(leaf / 8 * sampled / max(1, count))))
    leaders, fitted = {}, {}
    for d, v in picked.items():
        x = unit(matrix(v))
        leaders[d] = dense_leaders(x, least, cosine)
        rest = x[homes(x, leaders[d], cosine)[0] < 0]
        fitted[d] = Forest(rest, round(count * len(rest) / sampled), trees, leaf, spill, seed)
    dense, forests = spark.sparkContext.broadcast(leaders), spark.sparkContext.broadcast(fitted)

    def routed(cols: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {k: [] for k in ("rep", "n", "dim", "vec", "codes", "own", "home", "met")}
        dims = np.array([len(v) for v in cols["embedding"]])
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = matrix([cols["embedding"][i] for i in at])
            forest = forests.value.get(int(d)) or Forest(x[:0], 0, 1, leaf, spill, seed)
            home, meets = homes(unit(x), dense.value.get(int(d), x[:0]), cosine)
            lone = np.flatnonzero(home < 0)
            who, code = forest.leaves(unit(x[lone])) if len(lone) else (lone, lone)
            who = lone[who]
            order = np.lexsort((code, who))
            who, code = who[order], code[order].astype(np.int32)
            bounds = np.searchsorted(who, np.arange(len(at) + 1))
            for k, i in enumerate(at):
                own = code[bounds[k]:bounds[k + 1]]
                for c, v in zip(out, (cols["rep"][i], cols["n"][i], int(d), x[k].tobytes(), own.tobytes(), own.tolist(), int(home[k]),
                                     np.flatnonzero(meets[k]).tolist()), strict=True):
                    out[c].append(v)
        return out

    placed = scratch.save(map_rows(classes, routed, "rep long, n long, dim int, vec binary, codes binary, own array<int>, home int, met array<int>",
                                   ROUTED))

    def compared(members: DataFrame, columns: list[str], compare) -> DataFrame:
        """Members of each (dim, code) with at least two, in pairs of blocks.
        The pairs are dealt out anew, so that one large group is not one task's."""
        sizes = (members.groupBy("dim", "code").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
                 .select("dim", "code", F.ceil(F.col("m") / block).cast("int").alias("blocks")))
        spread = (members.join(sizes, ["dim", "code"])
                  .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
                  .select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
                  .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
                  .select("dim", "code", "i", "j", "rep", "n", "vec", *columns, "block").repartition("dim", "code", "i", "j"))
        return scratch.save(spread.groupBy("dim", "code", "i", "j").applyInPandas(compare, "kind long, u long, v long"))

    in_leaves = placed.select("rep", "n", "dim", "vec", "codes", F.explode("own").alias("code"))
    role = F.when(F.col("home") == F.col("code"), 2).when(F.col("home") < 0, 1).otherwise(0)
    at_leaders = placed.select("rep", "n", "dim", "vec", "home", F.explode("met").alias("code")).withColumn("role", role)
    found = (compared(in_leaves, ["codes"], _compare(cosine))
             .union(compared(at_leaders, ["role"], _compare_dense(cosine))))
    links = found.where("kind = 0").groupBy("u").agg(F.sum("v").alias("links"))
    components = scratch.save(connected_components(found.where("kind = 1").select("u", "v"), scratch))
    members = (every.where("usable").join(classes, "embedding").select("vec_id", "rep", "n")
               .join(links, F.col("rep") == F.col("u"), "left").join(components, F.col("rep") == F.col("node"), "left")
               .select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"),
                       F.coalesce("component", "rep").alias("component_id")))
    alone = every.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return members.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
