"""Toxicity by weak supervision.

Terms (words and word beginnings) that mark toxic rows of a labelled sample are dealt to many lexicon
voters; pattern voters look at the form of the text.  The votes of all documents are counted per pattern in
Spark.  A generative label model, fitted by expectation maximisation on those counts, estimates
how often each voter fires in either class and how the voters hang together within a class; voters that fire
together share their weight.  Its posterior labels train a linear classifier on terms and
patterns, whose margin is scaled to the labels of the sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm.common import query, stored, table, text_digest
from quirework.llm.learning import calibrated, held_out, logistic, sample, sigmoid

FOLDS, FOLD, THRESHOLD = 3, 1, 0.7
#: Labelled rows in the sample, terms in the lexicon, least toxic rows and least share of toxic rows of a term.
SAMPLE, TERMS, LEAST_ROWS, LEAST_SHARE = 12_000, 400, 4, 0.9
LEXICONS, ROUNDS = 24, 20
#: Lengths of the word beginnings.
STEMS = (4, 5, 6, 7)
_WORD = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[^A-ZÀ-ÖØ-Þ]+")
_MEMO_WORDS = 1_000_000


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) >= n)]


def patterns_of(text: str, n_words: int, n_terms: int) -> list[bool]:
    """Votes of the pattern voters."""
    upper = len(_UPPER.sub("", text)) / max(1, len(text))
    return [
        n_terms == 0,
        n_terms >= 2,
        n_terms >= 4,
        n_terms > 0 and n_terms * 100 >= n_words,
        upper > 0.3,
        "!!" in text,
        text.count("?") * 50 > n_words,
        n_words < 20,
    ]


PATTERNS = 8


def _mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Toxic and other rows per term, one row per term and task."""
    tally: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist()):
            found = {t for w in set(_WORD.findall((text.as_py() or "").lower())) for t in terms_of(w)}
            for term in found:
                tally.setdefault(term, [0, 0])[1 if label else 0] += 1
    for at in range(0, len(tally), 50_000):
        part = list(tally.items())[at : at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in part]), pa.array([c[1] for _, c in part]), pa.array([c[0] for _, c in part])], ["term", "toxic", "other"]
        )


def lexicon(texts: DataFrame, terms: int = TERMS) -> list[str]:
    """Terms by falling number of toxic rows of ``texts(text, label)``."""
    tally = texts.mapInArrow(_mine, "term string, toxic long, other long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    good = tally.filter((F.col("toxic") >= LEAST_ROWS) & (F.col("toxic") >= LEAST_SHARE * (F.col("toxic") + F.col("other"))))
    return [r["term"] for r in good.orderBy(F.desc("toxic"), "term").limit(terms).collect()]


def _features(known: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            terms, votes = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                words = _WORD.findall(text.lower())
                found: set[int] = set()
                hit: set[str] = set()  # of this text; the memo may be cleared in its middle
                for word in set(words):
                    ids = memo.get(word)
                    if ids is None:
                        if len(memo) > _MEMO_WORDS:
                            memo.clear()
                        ids = memo[word] = tuple(known[t] for t in terms_of(word) if t in known)
                    if ids:
                        found.update(ids)
                        hit.add(word)
                hits = sum(1 for w in words if w in hit) if hit else 0
                bits = 0
                for i in found:
                    bits |= 1 << (i % LEXICONS)
                for i, fires in enumerate(patterns_of(text, len(words), hits)):
                    bits |= int(fires) << (LEXICONS + i)
                terms.append(sorted(found))
                votes.append(bits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), pa.array(terms, pa.list_(pa.int32())), pa.array(votes, pa.int64())],
                ["doc_id", "digest", "terms", "votes"],
            )

    return run


def _bits(votes: np.ndarray) -> np.ndarray:
    return ((votes[:, None] >> np.arange(LEXICONS + PATTERNS)) & 1).astype(float)


class LabelModel:
    """Firing rates of the voters in either class, and the share of weight each keeps."""

    def __init__(self) -> None:
        n = LEXICONS + PATTERNS
        self.prior = 0.1
        self.fires = np.array([np.full(n, 0.05), np.full(n, 0.5)])
        self.fires[:, LEXICONS:] = 0.3
        self.fires[:, LEXICONS] = (0.8, 0.3)
        self.keep = np.full(n, 1.0 / LEXICONS)
        self.keep[LEXICONS:] = 0.2

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        """Probability of the toxic class."""
        on = np.log(self.fires[1] / self.fires[0])
        off = np.log((1 - self.fires[1]) / (1 - self.fires[0]))
        return sigmoid(np.log(self.prior / (1 - self.prior)) + bits @ (self.keep * (on - off)) + float(self.keep @ off))

    def fit(self, counts: DataFrame, rounds: int = ROUNDS) -> LabelModel:
        """``counts(votes, n)`` covers all documents; a round sums the moments of each class in Spark."""
        for _ in range(rounds):
            total = _moments(counts, self)
            if total is None:
                break
            before = self.fires.copy()
            for c in (0, 1):
                pairs, size = total[c], total[c][-1, -1]
                rate = (pairs[:-1, -1] + 0.5) / (size + 1)
                self.fires[c] = np.clip(rate, 1e-4, 1 - 1e-4)
            sizes = [total[c][-1, -1] for c in (0, 1)]
            self.prior = float(np.clip(sizes[1] / max(1e-9, sum(sizes)), 0.005, 0.5))
            self.keep = _kept(total[1])
            if np.abs(before - self.fires).max() < 1e-4:
                break
        return self


def _kept(pairs: np.ndarray) -> np.ndarray:
    """Voters that correlate within the toxic class count as that many fewer."""
    size = max(1e-9, pairs[-1, -1])
    mean = pairs[:-1, -1] / size
    cov = pairs[:-1, :-1] / size - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    return 1 / np.maximum(1, np.maximum(cov / np.outer(spread, spread), 0).sum(axis=1))


def _moments(counts: DataFrame, model: LabelModel) -> list[np.ndarray] | None:
    """Posterior-weighted sums of votes and of pairs of votes, by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = LEXICONS + PATTERNS + 1
        total = np.zeros((2, side, side))
        for batch in batches:
            bits = np.hstack([_bits(batch.column("votes").to_numpy()), np.ones((batch.num_rows, 1))])
            n = batch.column("n").to_numpy().astype(float)
            toxic = model.posterior(bits[:, :-1])
            for c, share in enumerate((1 - toxic, toxic)):
                total[c] += bits.T @ (bits * (n * share)[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], ["sums"])

    parts = counts.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "value"))
    rows = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()
    side = LEXICONS + PATTERNS + 1
    if not rows:
        return None
    flat = np.zeros(2 * side * side)
    for r in rows:
        flat[r["at"]] = r["value"]
    return list(flat.reshape(2, side, side)) if flat[side * side - 1] + flat[-1] > 0 else None


def _dense(terms: list, votes: np.ndarray, n_terms: int) -> np.ndarray:
    """Terms, pattern votes and a constant, one row per document."""
    x = np.zeros((len(votes), n_terms + PATTERNS + 1))
    for i, ids in enumerate(terms):
        x[i, ids] = 1
    x[:, n_terms:-1] = _bits(votes)[:, LEXICONS:]
    x[:, -1] = 1
    return x


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, score, predicted`` and ``digest`` (SHA-256 of the text), as rows may repeat an id or have none.

    A null text is an empty one and scored like it.  Without any labelled row of either class every score is 0.
    Labels, language, source and doc_id are no input of a score; held-out rows teach nothing.
    """
    known = sample(labels.select("doc_id", F.col("toxic").alias("toxic")), "toxic", FOLDS, FOLD, SAMPLE)
    ids = known.collect()
    spark = docs.sparkSession
    few = F.broadcast(spark.createDataFrame([tuple(r) for r in ids], "doc_id long, label int"))
    found = lexicon(docs.select("doc_id", "text").join(few, "doc_id").select("text", "label"))
    numbers = {t: i for i, t in enumerate(found)}
    rows = stored(docs.select("doc_id", text_digest().alias("digest"), "text").mapInArrow(_features(numbers), "doc_id long, digest string, terms array<int>, votes long"))
    model = LabelModel().fit(stored(rows.groupBy("votes").agg(F.count("*").alias("n"))))
    taught = rows.join(few, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "digest").select("terms", "votes", "label").limit(2 * SAMPLE).collect()
    votes = np.array([r["votes"] for r in taught], np.int64)
    truth = np.array([r["label"] for r in taught], np.int64)
    weights, slope, shift = np.zeros(len(found) + PATTERNS + 1), 0.0, -40.0
    if len(set(truth.tolist())) == 2:
        x = _dense([r["terms"] for r in taught], votes, len(found))
        weights = logistic(x, model.posterior(_bits(votes)), np.ones(len(x)), 1.0)
        slope, shift = calibrated(x @ weights, truth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margin = _dense(batch.column("terms").to_pylist(), batch.column("votes").to_numpy(), len(found)) @ weights
            columns = [batch.column("doc_id"), batch.column("digest"), pa.array(sigmoid(slope * margin + shift))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "score"])

    scored = rows.mapInArrow(run, "doc_id long, digest string, score double")
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "digest")


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score", "predicted")
