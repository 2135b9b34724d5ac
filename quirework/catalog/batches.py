"""Packing, caching, retry and progress queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quirework.catalog.registry import query
from quirework.operators import batches
from quirework.plans.ordered import id_bucket
from quirework.session import materialize
from quirework.sources.tables import table
from quirework.streaming import ledger


@query(
    """WITH RECURSIVE d AS (SELECT source, doc_id, length(text) + 80 AS w, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents),
    c AS (SELECT source, doc_id, n, w AS size, 1::BIGINT AS chunk FROM d WHERE n = 1
      UNION ALL SELECT d.source, d.doc_id, d.n, CASE WHEN c.size + d.w > 14000 THEN d.w ELSE c.size + d.w END,
        CASE WHEN c.size + d.w > 14000 THEN c.chunk + 1 ELSE c.chunk END FROM c JOIN d ON d.source = c.source AND d.n = c.n + 1)
    SELECT source, doc_id, chunk FROM c"""
)
def greedy_chunks(spark, folder):
    """Size-bounded packing of each source's documents in order."""
    docs = table(spark, folder, "documents", "source", "doc_id", "text")
    # The lengths are written once; the passes of the packing then never touch the text.
    sized = materialize(docs.select("source", "doc_id", F.length("text").cast("long").alias("chars")))
    return batches.pack(sized, ["source"], id_bucket("doc_id"), ["doc_id"], F.col("chars")).select("source", "doc_id", "chunk")


@query("SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) // 8)::BIGINT AS batch FROM documents")
def fixed_batches(spark, folder):
    """Calls of eight fragments over the whole corpus."""
    docs = table(spark, folder, "documents", "doc_id")
    return batches.fixed_batches(docs, [], id_bucket("doc_id"), ["doc_id"], batches.FRAGMENTS_PER_CALL)


@query("SELECT doc_id, sha1('v1' || chr(31) || 'model-a' || chr(31) || doc_id || chr(31) || text) AS cache_key FROM documents")
def cache_key(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return docs.select("doc_id", batches.cache_key(F.lit("v1"), F.lit("model-a"), F.col("doc_id"), F.col("text")).alias("cache_key"))


def _cache(spark, folder):
    """A cache the labels stand for: their documents are answered, toxic ones emptily; a low
    quality answer belongs to an older text."""
    docs = table(spark, folder, "documents", "doc_id", "text").withColumn("input_hash", batches.cache_key(F.lit("v1"), F.col("text")))
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    requests = docs.select("doc_id", "input_hash")
    stored = requests.join(labels, "doc_id").select(
        "doc_id",
        F.when(F.col("quality") == 1, F.col("input_hash")).otherwise(F.lit("stale")).alias("input_hash"),
        F.when(F.col("toxic") == 1, F.lit("")).otherwise(F.concat(F.lit("answer "), F.col("doc_id").cast("string"))).alias("answer"),
    )
    return requests, stored


@query("SELECT doc_id, sha1('v1' || chr(31) || text) AS input_hash FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)")
def cache_anti(spark, folder):
    """Requests without a usable cached answer: stale and empty answers do not count."""
    requests, stored = _cache(spark, folder)
    return batches.split_cached(requests, stored, ["doc_id", "input_hash"], "answer")[1]


@query("SELECT doc_id, 'answer ' || doc_id AS answer FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)")
def cache_hits(spark, folder):
    requests, stored = _cache(spark, folder)
    return batches.split_cached(requests, stored, ["doc_id", "input_hash"], "answer")[0].select("doc_id", "answer")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN 'batch' WHEN doc_id % 21 <> 0 THEN 'single' ELSE 'strict' END AS stage,
       CASE WHEN doc_id % 105 = 0 THEN NULL ELSE 'tr:' || length(text) END AS answer,
       CASE WHEN doc_id % 105 = 0 THEN 'missing answer' END AS error FROM documents"""
)
def retry_cascade(spark, folder):
    """Batch, single, strict: each stage sees only what is still missing.  The stages are
    deterministic stand-ins for a service that loses every 7th, 21st and 105th document."""
    docs = table(spark, folder, "documents", "doc_id", "text").select("doc_id", F.length("text").alias("chars"))

    def stage(drops: int):
        def run(pending):
            lost = F.col("doc_id") % drops == 0
            return pending.select(
                "doc_id",
                F.when(~lost, F.concat(F.lit("tr:"), F.col("chars").cast("string"))).alias("answer"),
                F.when(lost, F.lit("missing answer")).alias("error"),
            )

        return run

    return batches.cascade(docs, "doc_id", [("batch", stage(7)), ("single", stage(21)), ("strict", stage(105))])


class _Stub:
    """Offline client: answers with the length, and loses every eleventh id in a batch."""

    def answer(self, ids, texts):
        return {i: f"tr:{len(t)}" for i, t in zip(ids, texts) if len(ids) == 1 or int(i) % 11}


@query(
    """SELECT conv_id * 1000 + turn AS unit_id, 'tr:' || length(text) AS answer,
       CASE WHEN (conv_id * 1000 + turn) % 11 <> 0 OR n = 1 THEN 'batch' ELSE 'single' END AS stage
       FROM (SELECT *, count(*) OVER (PARTITION BY (rn - 1) // 8) AS n FROM (SELECT *, row_number() OVER (ORDER BY conv_id, turn) AS rn FROM conversations))"""
)
def client_cascade(spark, folder):
    """The same cascade through the client interface: calls of eight, then one by one."""
    turns = table(spark, folder, "conversations", "conv_id", "turn", "text")
    turns = turns.withColumn("unit_id", F.col("conv_id") * 1000 + F.col("turn"))
    batched = batches.fixed_batches(turns, [], id_bucket("conv_id", 10_000), ["conv_id", "turn"], batches.FRAGMENTS_PER_CALL)
    done = batches.cascade(
        batched,
        "unit_id",
        [
            ("batch", lambda p: batches.call_batches(p, "unit_id", "text", ["batch"], _Stub)),
            ("single", lambda p: batches.call_singles(p, "unit_id", "text", _Stub)),
        ],
    )
    return done.select("unit_id", "answer", "stage")


@query(
    """SELECT doc_id, arg_max(answer, seq) AS answer FROM (
       SELECT doc_id, 'quality ' || quality AS answer, 1 AS seq FROM labels UNION ALL SELECT doc_id, 'toxic ' || toxic, 2 FROM labels WHERE toxic = 1
       UNION ALL SELECT doc_id, 'source ' || source, 0 FROM documents) GROUP BY doc_id"""
)
def merged_results(spark, folder):
    """Partial results merged; the latest sequence wins where ids repeat."""
    labels = table(spark, folder, "labels")
    def part(rows, label, column, seq):
        return rows.select("doc_id", F.concat(F.lit(label), F.col(column).cast("string")).alias("answer"), F.lit(seq).alias("seq"))

    parts = [
        part(labels, "quality ", "quality", 1),
        part(labels.filter("toxic = 1"), "toxic ", "toxic", 2),
        part(table(spark, folder, "documents", "doc_id", "source"), "source ", "source", 0),
    ]
    return batches.merge_results(parts, "doc_id", "answer", "seq")


@query(
    """SELECT count(*)::BIGINT AS tasks_total, count(*) FILTER (o_orderstatus = 'O')::BIGINT AS tasks_o, count(*) FILTER (o_orderstatus = 'F')::BIGINT AS tasks_f,
       count(*) FILTER (o_orderstatus = 'P')::BIGINT AS tasks_p FROM orders"""
)
def task_progress(spark, folder):
    return batches.progress(table(spark, folder, "orders", "o_orderstatus"), "o_orderstatus", ["O", "F", "P"])


@query(
    """WITH e AS (SELECT *, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, hour(ts) AS run, event_type IN ('view', 'click') AS asked FROM events),
    l AS (SELECT user_id, day, count(*) FILTER (asked) AS asks, max(run) FILTER (asked) AS last, bool_or(event_type = 'purchase') AS answered FROM e GROUP BY ALL)
    SELECT user_id, day, asks, CASE WHEN answered THEN 'answered' WHEN asks = 0 THEN 'new' WHEN asks >= 3 THEN 'given up'
      WHEN 24 - last >= pow(2, asks - 1) THEN 'due' ELSE 'waiting' END AS state
    FROM l WHERE (user_id, day) IN (SELECT (user_id, day) FROM e WHERE event_type = 'signup')"""
)
def attempt_states(spark, folder):
    """What is to be asked again at the end of a day: signups of a user as requests, views and clicks as asks by the
    hour, purchases as answers."""
    events = table(spark, folder, "events", "user_id", "ts", "event_type")
    kind = F.col("event_type")
    outcome = F.when(kind.isin("view", "click"), ledger.ASKED).when(kind == "purchase", ledger.ANSWERED).otherwise(ledger.FAILED)
    placed = events.select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.hour("ts").cast("long").alias("run"), "event_type", outcome.alias("outcome"))
    requests = placed.filter(kind == "signup").select("user_id", "day").distinct()
    return ledger.request_states(requests, placed, ["user_id", "day"], F.lit(24), 3)
