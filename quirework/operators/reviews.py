"""Typed reading of review answers: every field is checked on its own, and the answers of a page fold to one verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.functions import code as cx
from quirework.functions import text as tx

# --- fixed values: the fields of an answer --------------------------------------------
SCORE, PUBLISHABLE, ISSUES, FIXES, ACTIONS = "score_0_to_100", "publishable", "critical_issues", "representative_fixes", "next_actions"
FIX = "array<struct<source:string,rewrite:string,reason:string>>"
# ----------------------------------------------------------------------------------
PUBLISH, REVISE, UNREVIEWED = "publish", "revise", "unreviewed"


def _typed(answer: Column, field: str, kind: str, shape: str) -> Column:
    """The value of a field if its JSON type is the one asked for: a quoted number is no number."""
    raw = F.try_variant_get(answer, f"$.{field}", "variant")
    return F.when(F.schema_of_variant(raw).startswith(shape), F.try_variant_get(answer, f"$.{field}", kind))


def typed_answer(content: Column) -> Column:
    """``(readable, score, publishable, issues, fixes, actions, rejects)`` of an answer; null fields are in ``rejects``, in the
    order of the contract, and so is FIXES if a fix without source or rewrite was left out of it."""
    def checked(answer: Column) -> Column:
        number = _typed(answer, SCORE, "bigint", "BIGINT")
        score = F.when(number.between(0, 100), number.cast("int"))
        publishable = _typed(answer, PUBLISHABLE, "boolean", "BOOLEAN")
        issues, actions = (F.filter(_typed(answer, f, "array<string>", "ARRAY"), lambda x: F.trim(x) != "") for f in (ISSUES, ACTIONS))
        told = _typed(answer, FIXES, FIX, "ARRAY")
        fixes = F.filter(told, lambda x: (F.coalesce(F.trim(x["source"]), F.lit("")) != "") & (F.coalesce(F.trim(x["rewrite"]), F.lit("")) != ""))
        faults = [(SCORE, score.isNull()), (PUBLISHABLE, publishable.isNull()), (ISSUES, issues.isNull()), (FIXES, told.isNull() | (F.size(fixes) < F.size(told))), (ACTIONS, actions.isNull())]
        rejects = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in faults]), lambda x: x.isNotNull())
        readable = F.coalesce(F.schema_of_variant(answer).startswith("OBJECT"), F.lit(False))
        return F.struct(
            readable.alias("readable"), score.alias("score"), publishable.alias("publishable"), issues.alias("issues"),
            fixes.alias("fixes"), actions.alias("actions"), F.when(readable, rejects).alias("rejects"),
        )

    return tx.bind(cx.parse_answer(content), checked)


def page_verdicts(answers: DataFrame, page: str, sequence: str, content: str) -> DataFrame:
    """``<page>, answers, unreadable, rejected, score, issues, fixes, verdict``, one row per page.

    The last readable answer by ``sequence`` counts; its score, its number of issues and of usable fixes.  A page is to be published
    if that answer has a score, says so, and names no issue; without a readable answer it is unreviewed.  ``rejected`` counts
    the fields rejected in all readable answers.  Counts only travel, not the answers; a null page is one more page.
    """
    read = answers.select(page, F.col(sequence).alias("__at"), typed_answer(F.col(content)).alias("a"))
    facts = F.struct("a.score", "a.publishable", F.size("a.issues").alias("issues"), F.size("a.fixes").alias("fixes"))
    last = F.max_by(facts, F.when(F.col("a.readable"), F.col("__at")))
    folded = read.groupBy(page).agg(
        F.count("*").alias("answers"), F.count_if(~F.col("a.readable")).alias("unreadable"),
        F.coalesce(F.sum(F.when(F.col("a.readable"), F.size("a.rejects"))), F.lit(0)).alias("rejected"),
        F.when(F.max("a.readable"), last).alias("l"),
    )
    fit = F.col("l.score").isNotNull() & F.coalesce(F.col("l.publishable"), F.lit(False)) & (F.col("l.issues") == 0)
    verdict = F.when(F.col("l").isNull(), UNREVIEWED).when(F.coalesce(fit, F.lit(False)), PUBLISH).otherwise(REVISE)
    return folded.select(page, "answers", "unreadable", "rejected", "l.score", "l.issues", "l.fixes", verdict.alias("verdict"))
