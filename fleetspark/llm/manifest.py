"""Merkle manifest of a table: every row a leaf, one tree per group, one root.

Where a leaf stands in its tree is a rank query, not a sort: each task gathers
the keys it meets into 64-bit words (``bit_or`` merges the words of all tasks;
words without keys are not stored), the words' popcounts go into directories
of at most 64 entries a node, level by level, and a leaf's place is what stands
before its word plus the popcount of the smaller bits in it. Blocks of
``FAN ** LEVELS`` places then fold into one node each: a task sets a block's
digests into slots by place and reduces several levels at once. The second
walk, from the root down, gives every leaf its siblings. No task holds more
than a block or a directory node, whatever the size of a tree.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, column_names, table
from fleetspark.llm.mixing import running_sums

FAN = 8
LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of one leaf that one task writes out.
COPIES = 65_536


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(values: list[Column]) -> Column:
    """sha256 of the values, each ``-`` if null, else byte count, colon, value."""
    return F.sha2(F.concat(*(F.when(v.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in (v.cast("string") for v in values))), 256)


# --- places by rank -------------------------------------------------------------

def _bit(key: str) -> str:
    return f"cast(`{key}` & 63 AS INT)"


def bitmap_words(keys: DataFrame, group: str, key: str) -> DataFrame:
    """``keys`` (group, key, n: rows of this key; keys unique in a group) as
    words: group, node (key >> 6), bits, n (rows in all), more (bit, further
    rows) of keys with several rows."""
    return (keys.groupBy(group, F.shiftright(key, 6).alias("node"))
            .agg(F.expr(f"bit_or(shiftleft(1L, {_bit(key)}))").alias("bits"), F.sum("n").alias("n"),
                 F.expr(f"collect_list(CASE WHEN n > 1 THEN named_struct('bit', {_bit(key)}, 'extra', n - 1) END)").alias("more")))


def rank_words(words: DataFrame, group: str, start: DataFrame, scratch: Scratch) -> DataFrame:
    """``words`` plus ``before``: the rows of the group's smaller words and of
    ``start`` (group, first). A directory node has at most 64 entries."""
    low, high = words.agg(F.min("node"), F.max("node")).first()
    levels = [words.select(group, "node", "n")]
    kids = F.collect_list(F.struct("node", "n")).alias("kids")
    while low is not None and high - low >= 64:
        levels.append(scratch.save(levels[-1].groupBy(group, F.shiftright("node", 6).alias("parent"))
                                   .agg(F.sum("n").alias("n"), kids).withColumnRenamed("parent", "node")))
        low, high = low >> 6, high >> 6

    def entries(nodes: DataFrame) -> DataFrame:
        def entry(k: Column) -> Column:
            smaller = F.filter("kids", lambda o: o["node"] < k["node"])
            return F.struct(k["node"].alias("node"), F.aggregate(smaller, F.col("before"), lambda s, o: s + o["n"]).alias("before"))
        return nodes.select(group, F.explode(F.transform("kids", entry)).alias("e")).select(group, "e.*")

    top = levels[-1].groupBy(group).agg(kids).join(start, group, "left")
    known = entries(top.select(group, "kids", F.coalesce("first", F.lit(0)).cast("long").alias("before")))
    for nodes in reversed(levels[1:]):
        known = entries(scratch.save(nodes.select(group, "node", "kids").join(known, [group, "node"])))
    return scratch.save(words.join(known, [group, "node"]))


def place_keys(rows: DataFrame, words: DataFrame, group: str, key: str) -> DataFrame:
    """``rows`` plus ``before``: how many rows of the group have a smaller key."""
    found = words.select(group, "node", "bits", "more", F.col("before").alias("word_before"))
    return (rows.withColumn("node", F.shiftright(key, 6)).join(found, [group, "node"])
            .withColumn("before", F.expr(
                f"word_before + bit_count(bits & ~shiftleft(-1L, {_bit(key)}))"
                f" + aggregate(filter(more, m -> m.bit < {_bit(key)}), 0L, (s, m) -> s + m.extra)"))
            .drop("node", "bits", "more", "word_before"))


def _no_start(spark: SparkSession, group: str) -> DataFrame:
    return spark.createDataFrame([], f"`{group}` string, first long")


def place_leaves(leaves: DataFrame, scratch: Scratch, copies: int = COPIES) -> DataFrame:
    """tree, key, leaf, claim of every row of ``leaves`` plus ``pos``, its place
    in its tree: by key (null first), then by leaf digest. Rows that are equal
    in all columns take successive places."""
    spark = leaves.sparkSession
    counted = scratch.save(leaves.groupBy("tree", "key", "leaf", "claim").agg(F.count("*").alias("n")))
    keys = scratch.save(counted.groupBy("tree", "key").agg(F.sum("n").alias("n")))
    start = keys.where("key IS NULL").select("tree", F.col("n").alias("first"))
    words = scratch.save(bitmap_words(keys.where("key IS NOT NULL"), "tree", "key"))
    ranked = rank_words(words, "tree", start, scratch)
    known = counted.where("key IS NOT NULL")
    placed = place_keys(known, ranked, "tree", "key")
    most, unnamed = keys.agg(F.max("n"), F.count_if(F.col("key").isNull())).first()
    if unnamed:
        placed = placed.unionByName(counted.where("key IS NULL").withColumn("before", F.lit(0).cast("long")))
    if (most or 0) > 1:
        # several rows of one key: ranked among themselves by the first 60 bits of their digests
        placed = scratch.save(placed.withColumn("same", F.concat("tree", F.lit("\0"), F.coalesce(F.col("key").cast("string"), F.lit(""))))
                              .withColumn("head", F.conv(F.substring("leaf", 1, 15), 16, 10).cast("long")))
        several = (keys.where("n > 1").select(F.concat("tree", F.lit("\0"), F.coalesce(F.col("key").cast("string"), F.lit(""))).alias("same")))
        among = scratch.save(placed.join(several, "same", "left_semi").drop("before"))
        heads = rank_words(scratch.save(bitmap_words(among.groupBy("same", "head").agg(F.sum("n").alias("n")), "same", "head")),
                           "same", _no_start(spark, "same"), scratch)
        inner = place_keys(among.select("same", "head").distinct(), heads, "same", "head").withColumnRenamed("before", "inner")
        placed = (placed.join(inner, ["same", "head"], "left")
                  .withColumn("before", F.col("before") + F.coalesce("inner", F.lit(0))).drop("same", "head", "inner"))
        if most > copies:
            placed = (placed.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(copies).cast("long"))))
                      .withColumn("before", F.col("before") + F.col("at")).withColumn("n", F.least(F.col("n") - F.col("at"), F.lit(copies)))
                      .repartition("tree", "before").drop("at"))
        placed = (placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
                  .withColumn("before", F.col("before") + F.col("copy")).drop("copy"))
    return scratch.save(placed.select("tree", "key", "leaf", "claim", F.col("before").alias("pos")))


# --- folding blocks ---------------------------------------------------------------

def slots(pos: pd.Series, digests: pd.Series, size: int) -> list[str]:
    """The digests of a block by place."""
    out: list = [None] * len(pos)
    for p, d in zip(pos % size, digests, strict=True):
        out[p] = d
    if None in out:
        raise ValueError("places of a block are not gapless")
    return out


def block_levels(nodes: list[str], alone: bool, levels: int, fan: int) -> list[list[str]]:
    """A block's nodes level by level. A block that may have neighbours folds
    ``levels`` times, the first block of a tree until one node is left (if it
    has neighbours it is full, which is the same)."""
    out = [nodes]
    while len(out[-1]) > 1 if alone else len(out) <= levels:
        below = out[-1]
        out.append([digest("".join(below[i:i + fan])) for i in range(0, len(below), fan)])
    return out


def block_paths(levels: list[list[str]], above: str, fan: int) -> list[str]:
    """Of each node of the lowest level the siblings on the way up, ``left:right``
    for each level, each ended by a comma; ``above`` is the block's own path."""
    paths = [above]
    for nodes in reversed(levels[:-1]):
        paths = [f"{''.join(nodes[i - i % fan:i])}:{''.join(nodes[i + 1:i - i % fan + fan])}," + paths[i // fan]
                 for i in range(len(nodes))]
    return paths


def fold(node: str, path: str) -> str:
    """The root that a node and its path give."""
    for level in path.split(",")[:-1]:
        left, right = level.split(":")
        node = digest(left + node + right)
    return node


class Forest:
    """Folds trees block by block. ``nodes``: tree, pos, digest, of all trees;
    afterwards ``tops``: tree, digest."""

    def __init__(self, nodes: DataFrame, scratch: Scratch, levels: int = LEVELS, fan: int = FAN):
        self.scratch, self.levels, self.fan, self.size = scratch, levels, fan, fan ** levels
        self.rounds = [nodes]
        while (self.rounds[-1].agg(F.max("pos")).first()[0] or 0) > 0:
            self.rounds.append(scratch.save(self._blocks(self.rounds[-1]).applyInPandas(self._up(), "tree string, pos long, digest string")))
        self.tops = self.rounds[-1].select("tree", "digest")

    def _blocks(self, nodes: DataFrame):
        return nodes.groupBy("tree", F.expr(f"pos div {self.size}").alias("block"))

    def _up(self):
        levels, fan, size = self.levels, self.fan, self.size

        def up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            top = block_levels(slots(rows["pos"], rows["digest"], size), key[1] == 0, levels, fan)[-1][0]
            return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "digest": [top]})
        return up

    def paths(self, tops: DataFrame, leaves: DataFrame, finish, schema: str) -> DataFrame:
        """``finish(rows of a block, paths by place)`` over ``leaves`` (the nodes
        with further columns), given the paths (tree, path, note) of the trees' tops."""
        known = tops.select("tree", F.lit(0).cast("long").alias("pos"), "path", "note")
        for k in reversed(range(len(self.rounds) - 1)):
            last = k == 0
            below = leaves if last else self.rounds[k]
            known = (self._blocks(below).cogroup(known.groupBy("tree", "pos"))
                     .applyInPandas(self._down(finish if last else _pass), schema if last else "tree string, pos long, path string, note string"))
            if not last:
                known = self.scratch.save(known)
        if len(self.rounds) == 1:  # every tree is a lone leaf
            known = self._blocks(leaves).cogroup(known.groupBy("tree", "pos")).applyInPandas(self._down(finish), schema)
        return known

    def _down(self, finish):
        levels, fan, size = self.levels, self.fan, self.size

        def down(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            nodes = block_levels(slots(rows["pos"], rows["digest"], size), key[1] == 0, levels, fan)
            by_place = block_paths(nodes, known["path"][0], fan)
            return finish(rows, [by_place[p] for p in rows["pos"] % size], known["note"][0])
        return down


def _pass(rows: pd.DataFrame, paths: list[str], note: str) -> pd.DataFrame:
    return pd.DataFrame({"tree": rows["tree"], "pos": rows["pos"], "path": paths, "note": note})


def merkle_manifest(docs: DataFrame, claims: dict[str, Column] | None = None, columns: tuple[str, ...] = COLUMNS,
                    key: str = "doc_id", group: str = "lang", levels: int = LEVELS, fan: int = FAN,
                    copies: int = COPIES) -> DataFrame:
    """One row per row of ``docs``: key, leaf, subroot, root, proof_sha256,
    folded_root, verified, path (its siblings: ``left:right,`` a level), position.

    A leaf hashes ``columns``; the leaves of one ``group`` value, by ascending
    ``key`` (null first, then by leaf digest), make a tree of runs of ``fan``;
    the trees' tops, by group (null first, UTF-8 bytewise), make the root.
    ``claims`` gives other contents of columns, as a verifier would see them:
    folded_root is what they and the row's siblings give, verified whether that
    is the root. Without siblings proof_sha256 is that of an empty text. Empty
    texts differ from nulls; repeated rows are leaves of their own; an empty
    table gives no rows; further columns are ignored, whatever their names.
    Rows of one key whose different leaves share their first 60 bits would
    share a place and stop the job."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "manifest")
    picked = column_names(docs, *dict.fromkeys((*columns, key, group)))
    asked = [(claims or {}).get(c, F.col(f"`{c}`")) for c in columns]
    changed = F.lit(False)
    for c, claim in (claims or {}).items():
        changed = changed | ~F.col(f"`{c}`").eqNullSafe(claim)
    leaves = picked.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-")).alias("tree"), F.col(f"`{key}`").alias("key"),
        leaf_digest([F.col(f"`{c}`") for c in columns]).alias("leaf"), F.when(changed, leaf_digest(asked)).alias("claim"))
    # (the key as text: pandas has no null in a column of whole numbers)
    placed = place_leaves(leaves, scratch, copies).withColumn("digest", F.col("leaf")).withColumn("key", F.col("key").cast("string"))
    trees = Forest(placed.select("tree", "pos", "digest"), scratch, levels, fan)
    tops = scratch.save(running_sums(trees.tops.select("tree", "digest", F.lit("").alias("all"), F.lit(1).alias("one")),
                                     ["all"], ["tree"], "one", scratch)
                        .select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("before").cast("long").alias("pos"), "digest"))
    root = Forest(tops.select("tree", "pos", "digest"), scratch, levels, fan)
    found = root.tops.first()
    at_root = root.tops.select("tree", F.lit("").alias("path"), F.lit("").alias("note"))

    def name_paths(rows: pd.DataFrame, paths: list[str], note: str) -> pd.DataFrame:
        return pd.DataFrame({"tree": rows["name"], "path": paths, "note": rows["digest"]})

    named = scratch.save(root.paths(at_root, tops, name_paths, "tree string, path string, note string"))
    top = found["digest"] if found else ""

    def prove(rows: pd.DataFrame, paths: list[str], note: str) -> pd.DataFrame:
        claim = rows["claim"].where(rows["claim"].notna(), rows["leaf"])
        folded = [fold(c, p) for c, p in zip(claim, paths, strict=True)]
        return pd.DataFrame({
            "key": rows["key"], "leaf": rows["leaf"], "subroot": note, "root": top,
            "proof_sha256": [digest(p.replace(":", "").replace(",", "")) for p in paths], "folded_root": folded,
            "verified": [f == top for f in folded], "path": paths, "position": rows["pos"]})

    out = trees.paths(named, placed, prove, "key string, leaf string, subroot string, root string, proof_sha256 string, "
                                            "folded_root string, verified boolean, path string, position long")
    return out.select(F.col("key").cast(dict(docs.dtypes)[key]).alias(key), *out.columns[1:])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle_manifest(table(spark, sf_dir, "documents"), {"text": F.when(tampered, lowered).otherwise(F.col("text"))}).drop("path")
