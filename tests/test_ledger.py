"""The ledger of asks: at most so many, waits between them, lost outcomes counted."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quirework.streaming import ledger


def test_states(spark):
    rows = [("a", 1, "asked"), ("a", 1, "failed"), ("b", 1, "asked"), ("b", 1, "answered"), ("c", 1, "asked"), ("c", 2, "asked"), ("d", 1, "asked"), ("d", 2, "asked"),
            ("d", 4, "asked"), (None, 3, "asked"), ("z", 1, "asked")]
    held = spark.createDataFrame(rows, "k string, run long, outcome string")
    asked = spark.createDataFrame([(k,) for k in ("a", "b", "c", "d", "e", None)], "k string")

    def states(run):
        return {r.k: (r.asks, r.state) for r in ledger.request_states(asked, held, ["k"], F.lit(run), 3).collect()}

    assert states(3) == {"a": (1, "due"), "b": (1, "answered"), "c": (2, "waiting"), "d": (3, "given up"), "e": (0, "new"), None: (1, "waiting")}
    later = states(4)
    assert later["c"] == (2, "due") and later[None] == (1, "due")
    assert ledger.request_states(asked, held.limit(0), ["k"], F.lit(1), 3).filter("state <> 'new'").count() == 0


def test_resumed_runs_never_ask_a_third_time(spark, tmp_path):
    source, store, calls = tmp_path / "in", str(tmp_path / "store"), str(tmp_path / "calls")
    source.mkdir()

    def run(enrich):
        return ledger.run_available(spark, str(source), store, enrich, "v1", 2, str(tmp_path / "checkpoint"))

    def answers(good):
        def enrich(rows):
            rows.select("page").write.mode("append").json(calls)
            answer = F.when(F.col("page").isin(*good), F.concat(F.lit("tr "), "text"))
            return rows.filter("page <> 'silent'").select("page", "input_hash", answer.alias("answer"), F.lit(None).cast("string").alias("error"))

        return enrich

    def breaks(rows):
        rows.select("page").write.mode("append").json(calls)
        raise RuntimeError("gone")

    texts = [{"page": p, "text": p * 2} for p in ("good", "bad", "late", "silent")]
    (source / "1.json").write_text("\n".join(json.dumps(r) for r in [*texts, texts[0]]), encoding="utf-8")
    assert run(answers(["good"])) == 1
    (source / "2.json").write_text(json.dumps({"page": "new", "text": "n"}), encoding="utf-8")
    with pytest.raises(RuntimeError):
        run(breaks)
    for _ in range(4):
        run(answers(["late", "new"]))
    asked = Counter(r.page for r in spark.read.json(calls).collect())
    # The run that broke had asked all but the answered one; "new" was asked again after its wait.
    assert asked == {"good": 1, "bad": 2, "late": 2, "silent": 2, "new": 2}
    held = spark.read.parquet(f"{store}/ledger")
    assert {(r.page, r.answer) for r in held.filter("outcome = 'answered'").collect()} == {("good", "tr goodgood"), ("new", "tr n")}
    assert {r.error for r in held.filter("outcome = 'failed'").collect()} == {"missing answer"}
