"""Personal data by bootstrapped contextual extraction, with DataFrame
operations only.

Base patterns give the seed entities. Their lexical contexts (the words around
them) are patterns; identifiers that no base pattern knows (tokens with an @
or with several digits) are instances met in the same contexts, whatever they
look like. Patterns and instances form a graph, which Spark
scores in rounds: a pattern's confidence is the share of its distinct
instances known to be of one kind, an instance's score comes from the
patterns it is met in, and is less where no seed of the kind has its form.
Instances that confident patterns reach are spans too,
wherever they stand.

Offsets come from splitting a text at the matches: the lengths of the pieces
and of the matches add up to code point positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.llm.common import Scratch, column_names, table

KINDS = ("email", "ip", "card", "phone")
#: Stands for a dot between two label characters, so that a domain is one
#: character class (groups repeated without bound overflow the regex engine's stack).
DOT, OTHER = "\ue000", "\ue001"
LOCAL = rf"A-Za-z0-9._%+{DOT}-"
EMAIL = rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
DIGIT_RUN = r"[0-9][0-9 \-]{14,}[0-9]"
GAP = r"[ \-]{2,}"
PHONE = r"\+[0-9][ ().0-9\-]+[0-9]"
#: What may be an identifier: begins and ends like a token and holds a digit or @.
TOKEN = r"(?<![A-Za-z0-9_@.%+\-])(?=[^\s0-9@]*+[0-9@])[A-Za-z0-9_@.%+\-]{5,}[A-Za-z0-9]"
LEAST_DIGITS = 5
WINDOW = 80
CONFIDENCE = 0.9
SUPPORT = 5
ROUNDS = 3
#: What an instance's score is multiplied by if no seed of its kind has its form.
STRANGE = 0.9

SPANS = "array<struct<kind:int,start:int,end:int>>"


def _found(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` as array<struct<start,end,value>>, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        hit = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(hit)).alias("out"))

    pairs = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches,
                       lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")))
    folded = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda s: s["out"])
    return F.coalesce(folded, none)


def _spans(hits: Column, kind: str, valid=None) -> Column:
    kept = F.filter(hits, valid) if valid else hits
    return F.transform(kept, lambda h: F.struct(F.lit(KINDS.index(kind)).alias("kind"), h["start"].alias("start"), h["end"].alias("end")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid_card(hit: Column) -> Column:
    digits = _digits(hit["value"])
    return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with a column text) plus ``base``: the base spans, by kind in
    the order of KINDS and start, ends exclusive; empty for a null text."""
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    dotted = F.regexp_replace(F.translate(text, DOT, OTHER), r"(?<=[A-Za-z0-9\-])\.(?=[A-Za-z0-9\-])", DOT)
    hits = docs.withColumns({
        "hit_email": F.when(F.contains(text, F.lit("@")), _found(dotted, EMAIL)).otherwise(none),
        "hit_ip": F.when(text.rlike(IP), _found(text, IP)).otherwise(none),
        "hit_run": F.when(text.rlike(DIGIT_RUN), _found(text, DIGIT_RUN)).otherwise(none),
        "hit_phone": F.when(F.contains(text, F.lit("+")), _found(text, PHONE)).otherwise(none)})
    cards = F.flatten(F.transform("hit_run", lambda run: F.transform(
        _between(run["value"], GAP), lambda h: F.struct(
            (run["start"] + h["start"]).alias("start"), (run["start"] + h["end"]).alias("end"), h["value"].alias("value")))))
    return (hits.withColumn("hit_card", cards).withColumn("base", F.concat(
        _spans(F.col("hit_email"), "email"),
        _spans(F.col("hit_ip"), "ip", lambda h: h["value"].rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")),
        _spans(F.col("hit_card"), "card", _valid_card),
        _spans(F.col("hit_phone"), "phone", lambda h: F.length(_digits(h["value"])).between(8, 15))))
        .drop("hit_email", "hit_ip", "hit_run", "hit_card", "hit_phone"))


def _between(value: Column, gap: str) -> Column:
    """What stands between the matches of ``gap``, like :func:`_found`."""
    pieces, gaps = F.split(value, gap, -1), F.regexp_extract_all(value, F.lit(gap), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def add(state: Column, pair: Column) -> Column:
        end = state["at"] + F.length(pair["piece"])
        hit = F.struct(state["at"].alias("start"), end.alias("end"), pair["piece"].alias("value"))
        return F.struct((end + F.coalesce(F.length(pair["gap"]), F.lit(0))).alias("at"),
                        F.concat(state["out"], F.array(hit)).alias("out"))

    pairs = F.zip_with(pieces, gaps, lambda piece, g: F.struct(piece.alias("piece"), g.alias("gap")))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), add, lambda s: s["out"])


def _form(value: Column) -> Column:
    """What an identifier looks like: letters a, digits 9, runs as one."""
    return F.regexp_replace(F.regexp_replace(value, "[A-Za-z]+", "a"), "[0-9]+", "9")


def _met(text: Column, spans: Column) -> Column:
    """Each span's value and the contexts it is met in."""
    def context(s: Column) -> Column:
        start = F.greatest(s["start"] - WINDOW, F.lit(0))
        before = F.lower(F.substring(text, start + 1, s["start"] - start))
        after = F.lower(F.substring(text, s["end"] + 1, F.lit(WINDOW)))
        value = F.substring(text, s["start"] + 1, s["end"] - s["start"])
        one = F.regexp_extract(before, r"(\S+)\s*$", 1)
        two = F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1)
        nxt = F.regexp_extract(after, r"^\S*\s*(\S+)", 1)
        near = F.array(F.when((one != "") & (two != ""), F.concat_ws("\t", F.lit("l2"), two)),
                       F.when((one != "") & (nxt != ""), F.concat_ws("\t", F.lit("lr"), one, nxt)))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), value.alias("value"),
                        F.array_compact(near).alias("contexts"))

    return F.transform(spans, context)


def personal_data(docs: DataFrame, confidence: float = CONFIDENCE, support: int = SUPPORT,
                  rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, mark (a hash of the
    text, with doc_id the row's name), base and spans (array of kind number,
    start, end; base spans and discovered ones, by kind and start).

    Null and empty texts have no spans. Rows repeated or with null ids are
    searched like any other; rows equal in id and text get equal spans.
    Without seeds nothing is discovered. Further columns are ignored."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "pii")
    none = F.array().cast(SPANS)
    text = F.coalesce("text", F.lit(""))
    rows = column_names(docs, "doc_id", "text").withColumn("mark", F.xxhash64(text))
    hopeful = base_spans(rows.where(text.rlike("[0-9@]")))
    tokens = F.filter(_found(text, TOKEN), lambda h: h["value"].contains("@") | (F.length(_digits(h["value"])) >= LEAST_DIGITS))
    fresh = F.filter(F.col("tokens"), lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    unknown = F.transform(fresh, lambda t: F.struct(F.lit(-1).alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    searched = scratch.save(
        hopeful.withColumn("tokens", tokens).withColumn("all", F.concat("base", unknown))
        .select("doc_id", "mark", "base", _met(text, F.col("all")).alias("met")))

    met = searched.select("doc_id", "mark", F.explode("met").alias("m")).select("doc_id", "mark", "m.*")
    edges = scratch.save(met.select("kind", "value", F.explode("contexts").alias("pattern")).distinct())
    known = scratch.save(edges.where("kind >= 0").select("value", "kind", F.lit(1.0).alias("score")).distinct())
    links = scratch.save(edges.select("value", "pattern").distinct())
    forms = scratch.save(known.select(_form(F.col("value")).alias("form"), "kind").distinct()
                         .withColumn("weight", F.lit(1.0)))
    for _ in range(rounds):
        patterns = _score_patterns(links, known, confidence, support)
        reached = (links.join(patterns, "pattern").join(known.select("value").distinct(), "value", "left_anti")
                   .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence") * 0.999)))).alias("score"))
                   .withColumn("form", _form(F.col("value"))).join(forms, ["form", "kind"], "left")
                   .withColumn("score", F.col("score") * F.coalesce("weight", F.lit(STRANGE)))
                   .groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
                   .select("value", (-F.col("best.k")).alias("kind"), F.col("best.score").alias("score")))
        new = scratch.save(reached)
        if not new.take(1):
            break
        known = known.union(new)
    found = known.where("score < 1").select(F.col("value").alias("new_value"), F.col("kind").alias("new_kind"))
    discovered = (met.where("kind < 0").join(found, F.col("value") == F.col("new_value"))
                  .groupBy("doc_id", "mark")
                  .agg(F.collect_set(F.struct(F.col("new_kind").alias("kind"), "start", "end")).alias("new"))
                  .select(F.col("doc_id").alias("d"), F.col("mark").alias("t"), "new"))
    with_new = (searched.select("doc_id", "mark", "base")
                .join(discovered, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("t")), "left")
                .select("doc_id", "mark", "base", F.array_sort(F.concat("base", F.coalesce("new", none))).alias("spans")))
    rest = rows.where(~text.rlike("[0-9@]")).select("doc_id", "mark", none.alias("base"), none.alias("spans"))
    return with_new.union(rest)


def _score_patterns(links: DataFrame, known: DataFrame, confidence: float, support: int) -> DataFrame:
    """pattern, kind, confidence of the patterns that may discover: of their
    distinct instances, the share known to be of the kind, weighed by score."""
    of_kind = [F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(f"s{k}") for k in range(len(KINDS))]
    seen = (links.join(known, "value", "left").groupBy("pattern")
            .agg(F.countDistinct("value").alias("n"), *of_kind))
    best = F.greatest(*[F.struct(F.col(f"s{k}").alias("s"), F.lit(-k).alias("k")) for k in range(len(KINDS))])
    return (seen.withColumn("best", best).where((F.col("best.s") >= support) & (F.col("best.s") >= confidence * F.col("n")))
            .select("pattern", (-F.col("best.k")).alias("kind"), (F.col("best.s") / F.col("n")).alias("confidence")))


def _named(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_report(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and all spans as text."""
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_named(F.col("base")), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans"))


def mask_personal_data(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and
    n_chars, where there is one, counted anew. Overlapping spans give one mark,
    that of the first. Columns, rows and repeats stay."""
    text = F.coalesce("text", F.lit(""))
    spans = (personal_data(docs.where(text.rlike("[0-9@]")), **how).where(F.size("spans") > 0).dropDuplicates(["doc_id", "mark"])
             .select(F.col("doc_id").alias("pii_doc"), F.col("mark").alias("pii_mark"), F.col("spans").alias("pii_spans")))
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    ordered = F.array_sort(F.transform("pii_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        more = F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), F.element_at(names, s["kind"] + 1))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(fresh, more).otherwise(state["out"]).alias("out"))

    masked = F.aggregate(ordered, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                         lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    changed = (docs.where(text.rlike("[0-9@]"))
               .join(spans, docs["doc_id"].eqNullSafe(F.col("pii_doc")) & (F.xxhash64(text) == F.col("pii_mark")), "left")
               .withColumn("text", F.when(F.col("pii_spans").isNotNull(), masked).otherwise(F.col("text"))))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col("pii_spans").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(docs.columns).union(docs.where(~text.rlike("[0-9@]")))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_report(personal_data(table(spark, sf_dir, "documents")))
