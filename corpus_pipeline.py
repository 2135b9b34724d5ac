"""A corpus pipeline of five stages; each reads what its predecessor kept.

1. toxicity: documents scored as toxic go.  2. SimHash near-dedup: of each component the document with the
smallest doc_id stays.  3. Decontamination: documents in which a benchmark window occurs go.
4. Mixing: a document is repeated as often as the mix takes it.  5. Sharding: every row gets a shard and a slot.

A row is known by its doc_id, null being one more, and the SHA-256 of its text, so stages 1 to 3 reject rows, not ids: another row with the
same doc_id, or without one, stays.  Stage 2 keeps of each component the row with the smallest doc_id (null last), then the smallest
digest, and of rows equal in both the first by source, lang and n_chars.  Stage 4 repeats each row of an id as often as the
most taken one; the repeats get slots of their own in stage 5.  Extra columns of the input are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm import decontaminate as benchmark_search
from quirework.llm import mixing, sharding, simhash, toxicity
from quirework.llm.common import SETTINGS, stored, table, text_digest

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _prepared(spark: SparkSession, docs: DataFrame) -> DataFrame:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return docs.select(*COLUMNS)


def _match(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` that are, or are not, among ``rows(doc_id, digest)``."""
    keys = rows.select(F.struct("doc_id", "digest").alias("__row"))
    return docs.withColumn("__row", F.struct("doc_id", text_digest().alias("digest"))).join(keys, "__row", how).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _prepared(spark, docs)
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return _match(docs, scored.filter("predicted = 1"), "left_anti")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _prepared(spark, docs)
    found = simhash.near_duplicates(docs)
    last = F.lit((1 << 63) - 1)
    rows = found.groupBy("root", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", last).alias("id"), "digest").agg(F.count("*").alias("n"))
    stays = rows.groupBy("root").agg(F.min(F.struct("none", "id", "digest", "n")).alias("s")).select(F.when(~F.col("s.none"), F.col("s.id")).alias("doc_id"), "s.digest", "s.n")
    stays = stored(stays)
    single = _match(docs, stays.filter("n = 1"), "left_semi")
    # Rows that repeat id and text: one of them, without a window over all their copies.
    again = _match(docs, stays.filter("n > 1"), "left_semi").groupBy("doc_id", text_digest().alias("digest"))
    first = again.agg(F.min(F.struct("source", "lang", "n_chars", "text")).alias("s")).select("doc_id", "s.text", "s.lang", "s.source", "s.n_chars")
    return single.unionByName(first)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _prepared(spark, docs)
    found = benchmark_search.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return _match(docs, found.filter("n_hit > 0").select("doc_id", F.sha2("bytes", 256).alias("digest")), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _prepared(spark, docs)
    mixed = mixing.mix(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    taken = mixed.groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").cast("int").alias("__copies")).filter("__copies > 0")
    joined = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("__id")))
    return joined.select(*COLUMNS, F.explode(F.sequence(F.lit(1), "__copies")).alias("__copy")).select(*COLUMNS)


def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = _prepared(spark, docs)
    same = Window.partitionBy("__id", "__digest")
    placed = sharding.shard(docs).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("digest").alias("__digest"), "size", "shard", "slot"
    )
    placed = placed.withColumn("__copy", F.row_number().over(same.orderBy("slot")))
    rows = docs.select(
        *COLUMNS, F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("__digest")
    )
    rows = rows.withColumn("__copy", F.row_number().over(same.orderBy("source", "lang", "n_chars")))
    return rows.join(placed, ["__id", "__digest", "__copy"]).select(*COLUMNS, "size", "shard", "slot")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard_rows),
]

#: The first stage is trained, so SQL cannot express the result.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs)
    return docs
