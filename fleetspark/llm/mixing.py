"""Mixing sources to target weights, with DataFrame operations only.

Documents get hash-random keys and are range-sorted within their source; the
running sum of words comes from sums per range partition carried forward, so a
source of any size spreads over many tasks. Each source is cut at its budget:
whole epochs first, then the documents (the last one in part) that the rest of
the budget reaches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, column_names, table, words_pattern

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"


def running_sums(df: DataFrame, group: list[str], order: list, value: str, scratch: Scratch) -> DataFrame:
    """``df`` plus ``before``: the sum of ``value`` over the rows of the same
    group that come earlier in ``order``. Only one sum per range partition and
    group is carried between partitions."""
    parts = scratch.save(df.repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()))
    sums = parts.groupBy("part", *group).agg(F.sum(value).alias("part_sum"))
    carried = sums.select("part", *group, F.coalesce(F.sum("part_sum").over(
        Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carried"))
    inside = F.sum(value).over(Window.partitionBy("part", *group).orderBy(*order)
                               .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(value)
    return (parts.withColumn("inside", inside).join(carried, ["part", *group])
            .withColumn("before", F.col("inside") + F.col("carried")).drop("part", "inside", "carried"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int, scratch: Scratch) -> DataFrame:
    """``sizes`` (source, source_size: one row a source) plus ``rank`` (by code
    point, null last), ``weight`` (repeating) and ``target``. The targets share
    the sum of all sizes by weight; those above ``max_epochs`` times their
    source stop there and the excess is shared again until none is above.
    Only sums over the sources reach the driver."""
    ranked = running_sums(sizes.select("source", "source_size", F.lit(1).alias("one"), F.lit(0).alias("all")), ["all"],
                          [F.col("source").asc_nulls_last()], "one", scratch)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    ranked = scratch.save(ranked.select("source", "source_size", F.col("before").alias("rank"), weight.alias("weight"),
                                        (F.col("source_size") * max_epochs).alias("most")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, stopped = 0.0, -1
    while total:
        above = F.lit(share) * F.col("weight") > F.col("most") if stopped >= 0 else F.lit(False)
        n, used, free = ranked.agg(F.coalesce(F.sum(above.cast("int")), F.lit(0)), F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0)),
                                   F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if n == stopped or not free:
            break
        share, stopped = (total - used) / free, n
    return ranked.withColumn("target", F.least(F.lit(share) * F.col("weight"), F.col("most").cast("double")))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                seed: str = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, text): doc_id, source,
    size (words; null text: 0), source_size, target (its source's), taken
    (words the mix takes, repeats counted). A source's taken words are its
    target rounded to a whole word; taken // size is the number of whole
    passes, the rest a beginning of the document.

    A null source is a source of its own, the last. Ties of the random key go
    by doc_id and size, so repeated rows and null ids are placed alike in every
    run. Sources of size 0 and an empty table take nothing."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    sized = scratch.save(column_names(docs, "doc_id", "source", "text").select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(words_pattern())), F.lit(0)).cast("long").alias("size")))
    targets = scratch.save(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")),
                                          weights, max_epochs, scratch))
    keyed = (sized.join(targets.select(F.col("source").alias("name"), "rank"), F.col("source").eqNullSafe(F.col("name")))
             .select("doc_id", "rank", "size", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
                     .alias("key")))
    placed = running_sums(keyed, ["rank"], ["key", "doc_id", "size"], "size", scratch)
    budget = F.floor(F.col("target") + 0.5)
    rest = F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0)
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return (placed.join(targets, "rank")
            .select("doc_id", "source", "size", "source_size", "target", (passes * F.col("size") + part).cast("long").alias("taken")))


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken,
    a last part as the text's first words. Rows that share a doc_id share the
    share of the one taken most; a null doc_id is an id like any other here.
    Documents without words are never taken."""
    words = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    picked = (mix_sources(docs, **how).where("taken > 0").groupBy("doc_id")
              .agg(F.max(F.struct("taken", "size")).alias("mix"))
              .select(F.col("doc_id").alias("mix_id"), F.col("mix.size").alias("mix_size"), F.col("mix.taken").alias("mix_taken")))
    copies = (docs.join(picked, docs["doc_id"].eqNullSafe(F.col("mix_id")))
              .withColumn("mix_pass", F.explode(F.sequence(F.lit(0), F.ceil(F.col("mix_taken") / F.col("mix_size")).cast("long") - 1))))
    left = F.col("mix_taken") - F.col("mix_pass") * F.col("mix_size")
    cut = F.array_join(F.slice(words, 1, left.cast("int")), "")
    out = copies.withColumn("text", F.when(left < F.col("mix_size"), cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(left < F.col("mix_size"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3) + 1] AS weight, 3 * source_size AS most
  FROM sources
), stops AS (
  SELECT *, coalesce(sum(most) OVER before, 0) AS used, sum(weight) OVER after AS free, sum(source_size) OVER () AS total
  FROM weighed
  WINDOW before AS (ORDER BY CAST(most AS DOUBLE) / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after AS (ORDER BY CAST(most AS DOUBLE) / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), shared AS (
  SELECT max(CAST(total - used AS DOUBLE) / CAST(free AS DOUBLE)) FILTER (CAST(total - used AS DOUBLE) / CAST(free AS DOUBLE) * weight <= most) AS share
  FROM stops
), targets AS (
  SELECT source, source_size, least(share * weight, CAST(most AS DOUBLE)) AS target,
         CAST(floor(least(share * weight, CAST(most AS DOUBLE)) + 0.5) AS BIGINT) AS budget
  FROM weighed, shared
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.budget,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0
                 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
FROM placed
"""
