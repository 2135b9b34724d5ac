"""Review answers: fields of a wrong type are rejected on their own, the last readable answer decides."""

from pyspark.sql import functions as F

from quirework.operators import reviews

GOOD = '{"score_0_to_100": 91, "publishable": true, "critical_issues": [], "representative_fixes": [{"source": "a", "rewrite": "b", "reason": "c"}], "next_actions": ["go"]}'


def typed(spark, *answers):
    frame = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "n int, answer string")
    return [r.a for r in frame.select("n", reviews.typed_answer(F.col("answer")).alias("a")).orderBy("n").collect()]


def test_fields_are_checked_one_by_one(spark):
    good, quoted, range_, partly, fenced, list_, none = typed(
        spark, GOOD, GOOD.replace("91", '"91"').replace("true", '"true"'), GOOD.replace("91", "101").replace('["go"]', '"go"'),
        GOOD.replace('"rewrite": "b"', '"rewrite": " "').replace("[]", '[" ", "bad"]'), f"```json\n{GOOD}\n```", f"[{GOOD}]", None,
    )
    assert (good.score, good.publishable, good.issues, good.actions, good.rejects) == (91, True, [], ["go"], []) and good.fixes[0].rewrite == "b"
    assert quoted.rejects == ["score_0_to_100", "publishable"] and quoted.score is None and quoted.actions == ["go"]
    assert range_.rejects == ["score_0_to_100", "next_actions"]
    assert partly.rejects == ["representative_fixes"] and partly.fixes == [] and partly.issues == ["bad"]
    assert fenced == good and not none.readable and none.rejects is None and not list_.readable
    (empty,) = typed(spark, "{}")
    assert empty.readable and len(empty.rejects) == 5


def test_verdict_of_a_page(spark):
    rows = [
        (1, 1, GOOD.replace("[]", '["bad"]')), (1, 2, GOOD), (1, 3, "broken {"), (2, 1, GOOD), (2, 2, GOOD.replace("true", "false")),
        (3, 1, "none"), (None, 1, GOOD.replace("91", "-1")), (4, 1, GOOD.replace("[]", "7")),
    ]
    frame = spark.createDataFrame(rows, "page long, n long, answer string")
    got = {r.page: (r.answers, r.unreadable, r.rejected, r.score, r.verdict) for r in reviews.page_verdicts(frame, "page", "n", "answer").collect()}
    assert got == {1: (3, 1, 0, 91, "publish"), 2: (2, 0, 0, 91, "revise"), 3: (1, 1, 0, None, "unreviewed"), None: (1, 0, 1, None, "revise"), 4: (1, 0, 1, 91, "revise")}
