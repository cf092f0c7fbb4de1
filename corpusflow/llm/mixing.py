"""Mixing sources to target weights by capped water-filling (operator 4).

Each source's share of the budget follows its weight; sources that would pass
``max_epochs`` times their size are clamped there and what they leave is dealt
out again by weight, until no source is above its clamp. Documents are then
repeated: all of a source's documents the whole number of times that fits the
target, and once more those that come first in a seeded order, the last of
them in part, so that the words taken meet the target.

Size: number of words ``[^\\x20\\x09-\\x0D]+``; null text: 0. Sources in code
point order, null last. Defined cases: a null doc_id is ordered as the text
'null'; rows with the same doc_id are ordered by size and then by text digest; repeated rows share what they take to within a word; a source
without words gets target 0; other columns are ignored by ``mix_plan`` and
kept by ``mixed_documents``; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpusflow.llm.common import saved

SEED, BUCKETS = 17, 4096


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded(seed: int, doc_id: str = "doc_id") -> Column:
    """60 bits of MD5 of seed and doc_id: the same order in every run and engine."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))), 1, 15), 16, 10).cast("long")


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """(source, source_size, weight) -> plus target.

    Sorted by clamp / weight, the clamped sources are a prefix; the level that
    the others share is (budget - clamps so far) / (weights left) at the first
    source that stays below its clamp. One row a source.
    """
    order = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sources.withColumn("clamp", F.col("source_size") * F.lit(float(max_epochs))).withColumn("ratio", F.col("clamp") / F.col("weight"))
    s = s.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    s = s.withColumn("level", (F.col("budget") - F.coalesce(F.sum("clamp").over(order), F.lit(0.0)))
                     / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(order), F.lit(0))))
    s = s.withColumn("line", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(everything)["level"])
    return s.withColumn("target", F.when(F.col("line").isNull() | (F.col("ratio") <= F.col("line")), F.col("clamp")).otherwise(F.col("weight") * F.col("line")))


def mix_plan(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = SEED) -> DataFrame:
    """doc_id, source, digest, size, source_size, target, taken; one row a document.

    Sums over (source, bucket of the seeded order) are aggregated before the
    shuffle; the bucket in which a source's extra words end is found from
    them, and only its documents are ordered one by one. A source with a third
    of all rows is thus never in one task.
    """
    sized = saved(docs.select("doc_id", F.col("source").cast("string").alias("source"), words_in().alias("size"), seeded(seed).alias("u"),
                              F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"))
                  .withColumn("bucket", F.shiftright("u", 48).cast("int")), "mix-sizes")
    sums = saved(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-sums")
    per = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    plan = water_fill(per.withColumn("rank", rank).withColumn("weight", turn), share, max_epochs).select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("times"))
    plan = saved(plan.withColumn("extra", F.round(F.col("target") - F.col("times") * F.col("source_size")).cast("long")), "mix-plan")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
               .join(plan, sums["source"].eqNullSafe(plan["source"]))
               .select(sums["source"], "bucket", "before", "words", "extra", "times", "source_size", "target"))
    buckets = saved(buckets.withColumn("kind", F.when(F.col("before") + F.col("words") <= F.col("extra"), 1).when(F.col("before") >= F.col("extra"), 0).otherwise(2)), "mix-buckets")
    d, b = sized.alias("d"), buckets.alias("b")
    on = F.col("d.source").eqNullSafe(F.col("b.source")) & (F.col("d.bucket") == F.col("b.bucket"))
    joined = d.join(b, on).select("d.doc_id", "d.source", "digest", "size", "u", "before", "extra", "times", "source_size", "target", "kind")
    plain = joined.where("kind < 2").withColumn("taken", F.col("times") * F.col("size") + F.when(F.col("kind") == 1, F.col("size")).otherwise(0))
    inner = Window.partitionBy("source").orderBy("u", "doc_id", "size", "digest").rowsBetween(Window.unboundedPreceding, -1)
    edge = joined.where("kind = 2").withColumn("at", F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    edge = edge.withColumn("taken", F.col("times") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), F.col("extra") - F.col("at"))))
    cols = ["doc_id", "source", "digest", "size", "source_size", "target", "taken"]
    return plain.select(*cols).union(edge.select(*cols))


def _rest_to_first(rows: DataFrame, group: list[str]) -> DataFrame:
    """``__t`` raised by one in the first ``__rest`` rows of each group.

    Rows are counted per group and partition, so a large group is in no single task."""
    some = rows.where("__rest > 0")
    if some.isEmpty():
        return rows
    some = saved(some.withColumn("__part", F.spark_partition_id()).withColumn("__pos", F.monotonically_increasing_id()), "mix-repeated")
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"{c}_k") for c in group] + [F.col(c).isNull().alias(f"{c}_n") for c in group]
    names = [f"{c}_k" for c in group] + [f"{c}_n" for c in group]
    some = some.select("*", *keys)
    sizes = some.groupBy(*names, "__part").agg(F.count("*").alias("__c"))
    before = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__before", F.coalesce(F.sum("__c").over(before), F.lit(0))).drop("__c")
    own = F.row_number().over(Window.partitionBy(*names, "__part").orderBy("__pos"))
    some = some.withColumn("__own", own).join(sizes, [*names, "__part"])
    some = some.withColumn("__t", F.col("__t") + (F.col("__before") + F.col("__own") <= F.col("__rest")).cast("long"))
    return rows.where("__rest = 0").unionByName(some.select(*rows.columns))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row as often as taken, the last time with its first words only."""
    plan = mix_plan(docs, **options).select(F.col("doc_id").alias("__id"), F.col("source").alias("__src"), F.col("digest").alias("__dig"), F.col("size").alias("__size"), F.col("taken").alias("__taken"))
    per = plan.groupBy("__id", "__src", "__dig", "__size").agg(F.sum("__taken").alias("__taken"), F.count("*").alias("__rows"))
    d = docs.withColumn("__dig", F.xxhash64(F.coalesce("text", F.lit(""))))
    j = d.join(per, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").cast("string").eqNullSafe(F.col("__src")) & (d["__dig"] == per["__dig"])).drop(per["__dig"])
    # Repeated rows share what their group takes evenly; the rest of the division goes to the first rows, one word each.
    j = j.withColumn("__t", F.expr("__taken div __rows")).withColumn("__rest", F.expr("__taken % __rows"))
    j = _rest_to_first(j, ["__id", "__src", "__dig", "__size"])
    whole = F.when(F.col("__size") > 0, F.floor(F.col("__t") / F.col("__size"))).otherwise(0).cast("int")
    part = (F.col("__t") - whole * F.col("__size")).cast("int")
    j = j.withColumn("__w", whole).withColumn("__p", part).withColumn("__n", F.col("__w") + F.when(F.col("__p") > 0, 1).otherwise(0))
    j = j.where("__n > 0").withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    cut = F.expr(r"regexp_substr(text, concat('(?s)^[\\x20\\x09-\\x0D]*+(?:[^\\x20\\x09-\\x0D]++[\\x20\\x09-\\x0D]*+){', cast(greatest(__p, 1) as string), '}+'))")
    j = j.withColumn("text", F.when(F.col("__k") <= F.col("__w"), F.col("text")).otherwise(cut))
    if "n_chars" in docs.columns:
        j = j.withColumn("n_chars", F.when(F.col("__k") <= F.col("__w"), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return j.select(*docs.columns)
