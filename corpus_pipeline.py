"""A training-data pipeline over documents: score, deduplicate, decontaminate, mix, write token ids.

Each stage is one operator of ``corpusflow.llm`` applied to all rows the stage
before kept; all but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from corpusflow.llm import decontam, jaccard_join, mixing, token_output, toxicity
from corpusflow.llm.common import saved, table
from corpusflow.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.filtered(docs, model)


# Names of the columns that the stages add to the documents; other names are the table's own.
PRIVATE = "__pipeline_"
KEY = PRIVATE + "key"


def row_keys(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(keyed, hashed, rest): rows with a key of their own, (key, doc_id) of those keyed by a hash, rows that no key is for.

    The key is the doc_id where only one row has it; else (null or repeated) a
    64-bit hash of doc_id and the text's SHA-256. Of rows with one doc_id and
    one text a single one is keyed, the least by its other columns; texts
    without a word have no key and stay.
    """
    once = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    several = saved(once, "pipeline-several")
    plain = docs.where("doc_id is not null").join(several, "doc_id", "left_anti").select(*docs.columns)
    odd = docs.where("doc_id is null").unionByName(docs.join(several, "doc_id", "left_semi").select(*docs.columns))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    has_word = F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    others = F.to_json(F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")], F.lit(0).alias(PRIVATE + "0")))
    least = F.row_number().over(Window.partitionBy("doc_id", PRIVATE + "digest").orderBy(PRIVATE + "others"))
    unique = odd.where(has_word).withColumn(PRIVATE + "digest", digest).withColumn(PRIVATE + "others", others).withColumn(PRIVATE + "n", least).where(F.col(PRIVATE + "n") == 1)
    unique = unique.withColumn(KEY, F.xxhash64(F.col("doc_id").isNull(), "doc_id", PRIVATE + "digest")).select(*docs.columns, KEY)
    unique = saved(unique, "pipeline-odd")
    keyed = plain.withColumn(KEY, F.col("doc_id").cast("long")).unionByName(unique)
    return keyed, unique.select(F.col(KEY).alias("key"), "doc_id"), odd.where(~has_word)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar rows, one with the smallest doc_id (a null id only if no row has another); texts without a word stay."""
    keyed, hashed, rest = row_keys(docs)
    rows = saved(jaccard_join.jaccard_components(keyed, doc_id=KEY).where("n_shingles > 0").select(F.col("doc_id").alias("key"), "component_id"), "pipeline-groups")
    # component_id is the smallest key; where rows keyed by a hash take part, another may have the smallest doc_id.
    ids = rows.join(hashed.withColumn("hashed", F.lit(True)), "key", "left").withColumn("doc_id", F.expr("if(hashed, doc_id, key)"))
    first = ids.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("f"))
    other = saved(first.where("f.key <> component_id").select("component_id", "f.key"), "pipeline-firsts")
    found = (rows.where("key <> component_id").select("key").join(other.select("key"), "key", "left_anti")
             .union(other.select("component_id")))
    found = saved(found.withColumnRenamed("key", KEY), "pipeline-copies")
    return keyed.join(found, KEY, "left_anti").select(*docs.columns).unionByName(rest)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.filtered(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them; a source's last one in part."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the written records: doc_id, start, n_tokens, ids_crc32 and their place."""
    return token_output.token_records(docs, tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard_join", one_of_each_group), ("benchmark_decontamination", drop_contaminated),
          ("source_mix", mix_sources), ("token_records", write_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a Parquet table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The tokenizer and the nearest examples cannot be stated in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
