"""Quality by Bradley-Terry ranking.

Each pair of a good and a bad labelled document is a preference; the scores are linear in features of the
text and fitted by logistic loss on feature differences.  The sample teaches the level of the quantile to cut at: the
share of bad rows, moved to where it separates them best.  The cut is that quantile of the scores of all documents,
found in Spark by counting; the distance to it, scaled to the labels, gives a score that is 0.7 at the cut.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table, text_digest
from quirework.llm.learning import calibrated, held_out, logistic, sample

FOLDS, FOLD, THRESHOLD = 4, 2, 0.7
#: Labelled rows in the sample and preference pairs drawn from them.
SAMPLE, PAIRS, SEED = 12_000, 40_000, 17
_UPPER = re.compile(r"[^A-ZÀ-ÖØ-Þ]+")
_SIGNS = re.compile(r"[\w\s.,;:!?'\"()-]+")
_DIGITS = re.compile(r"\D+")
_SENTENCE = re.compile(r"[.!?]+(?:\s|$)")


def features(text: str) -> list[float]:
    """Numbers that describe the form of a text, all bounded or logarithmic."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    counts = Counter(words)
    lines = text.split("\n")
    signs = _SIGNS.sub("", text)
    repeats = sum(1 for a, b in zip(words, words[1:]) if a == b)
    distinct = len(counts)
    pairs = len(set(zip(words, words[1:]))) or 1
    trios = len(set(zip(words, words[1:], words[2:]))) or 1
    shares = [
        len(_UPPER.sub("", text)) / size,
        len(signs) / size,
        len(_DIGITS.sub("", text)) / size,
        text.count("!") / n,
        text.count("|") / n,
        repeats / n,
        1 - distinct / n,
        1 - pairs / max(1, n - 1),
        1 - trios / max(1, n - 2),
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / len(lines),
        min(1.0, len(_SENTENCE.findall(text)) / n),
        min(1.0, len(lines) / n),
        sum(1 for w in words if not w[0].isalnum()) / n,
        sum(1 for w in words if not w[-1].isalnum()) / n,
    ]
    return [*shares, *(x**0.5 for x in shares), np.log1p(len(words)) / 10, 1 / (1 + len(words)), min(5.0, size / n / 5), 1.0 if not words else 0.0]


WIDTH = len(features(""))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py() or "") for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("label")], ["x", "label"])


class Ranking:
    """Means, scales, weights, and the line from a Bradley-Terry score to the final one."""

    def __init__(self, x: np.ndarray, label: np.ndarray, pairs: int = PAIRS, seed: int = SEED) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = (x - self.mean) / self.scale
        good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        draw = np.random.default_rng(seed)
        differences = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
        self.weights = logistic(differences, np.ones(pairs), np.ones(pairs), 5.0)
        raw = np.sort(z @ self.weights)
        order = np.argsort(z @ self.weights, kind="stable")
        wrong = np.r_[0, np.cumsum(np.where(label[order] == 1, 1, -1))]  # good rows below the cut, less bad ones
        near = np.arange(len(raw) + 1)
        level = int(min(near, key=lambda i: (wrong[i], abs(i - len(bad)))))
        self.quantile = level / len(raw)
        self.cut = 0.0
        self.slope = max(calibrated(z @ self.weights, label)[0], 1e-6)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights


def quantile_cut(rows: DataFrame, column: str, level: float, steps: int = 3, ways: int = 4096) -> float:
    """Cut with the share ``level`` of the values below it, between the values next to it as far as ``steps`` rounds tell them apart.

    A round counts the values in ``ways`` equal stretches of the range that holds the quantile, and goes on in the one it falls into;
    ``ways`` counts reach the driver.  The cut's error is the first range over ``ways ** steps``, far below the rounding of a score.
    """
    span = rows.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count(column).alias("n")).first()
    if not span["n"]:
        return 0.0
    low, high, before, wanted = span["low"], span["high"], 0, int(round(level * span["n"]))
    if wanted <= 0:
        return low - 1.0
    if wanted >= span["n"]:
        return high + 1.0
    for _ in range(steps):
        width = (high - low) / ways
        if not width > 0 or low + width == low:
            break
        inside = rows.filter((F.col(column) >= low) & (F.col(column) <= high))
        at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(ways - 1))
        counts = {r["at"]: r["n"] for r in inside.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect()}
        for k in sorted(counts):  # the stretch with the first value that is not below the cut
            if before + counts[k] > wanted:
                break
            before += counts[k]
        low, high = low + k * width, low + (k + 1) * width
        if before == wanted:  # the values below are all the wanted ones: the cut lies in the gap before this stretch or in it
            break
    return low


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, score, predicted``.

    A null text is an empty one and scored like it.  Without labelled rows of both classes every score is 0.
    Labels, language, source and doc_id are no input of a score; held-out rows teach nothing.
    """
    known = sample(labels.select("doc_id", F.col("quality").alias("quality")), "quality", FOLDS, FOLD, SAMPLE)
    few = F.broadcast(docs.sparkSession.createDataFrame([tuple(r) for r in known.collect()], "doc_id long, label int"))
    taught = docs.select("doc_id", "text").join(few, "doc_id").select("doc_id", text_digest().alias("digest"), "text", "label")
    # Repeated ids may make the sample longer than the list of labels: ordered, so that the same rows teach in every run.
    rows = taught.orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(2 * SAMPLE).select("text", "label")
    rows = rows.mapInArrow(_measure, "x array<double>, label int").collect()
    label = np.array([r["label"] for r in rows])
    ranking = Ranking(np.array([r["x"] for r in rows]), label) if len(set(label.tolist())) == 2 else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py() or "") for t in batch.column("text")]).reshape(-1, WIDTH)
            scores = ranking.raw(x) if ranking else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "raw"])

    if ranking is None:
        return docs.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    scored = stored(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, raw double"))
    cut = quantile_cut(scored, "raw", ranking.quantile)
    margin = F.least(F.greatest(F.lit(ranking.slope) * (F.col("raw") - F.lit(cut)), F.lit(-40.0)), F.lit(40.0))
    score = F.lit(1.0) / (F.lit(1.0) + F.lit((1 - THRESHOLD) / THRESHOLD) * F.exp(-margin))
    # The side of the cut decides; rounding must not put a score on its other side.
    good = F.col("raw") >= F.lit(cut)
    exact = F.when(good, F.greatest(score, F.lit(THRESHOLD))).otherwise(F.least(score, F.lit(float(np.nextafter(THRESHOLD, 0)))))
    return scored.select("doc_id", exact.alias("score"), good.cast("int").alias("predicted"))


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_quality(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score", "predicted")
