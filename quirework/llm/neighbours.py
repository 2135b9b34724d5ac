"""Approximate nearest neighbours over low-dimensional stable projections.

Vectors are lifted so that the largest inner product is the smallest distance, and projected to a few numbers by a
Gaussian (2-stable) matrix: the squared distance of two projections, over the squared distance of the vectors,
follows a chi-square law.  A kd-tree holds the projections.  A query takes its projected neighbours in growing
distance and verifies them on the whole vectors; it stops as soon as a vector closer than its k-th best so
far would, with the probability asked for, have come up already.

In Spark the top of the tree is fitted on a bounded sample and cuts all rows into cells; a cell with many rows, such as
copies of one vector, is sliced.  The first pass searches the cell of each query and gives it a k-th distance.  The
second takes blocks of queries to the cells that the stopping test cannot rule out, where each goes on with that distance
in hand.  So every vector inside the final radius is verified, and the order of the cells does not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirework.llm.common import hashed_share, query, stored, table

NEAREST, EVERY = 20, 20
#: Projected numbers, and the probability of the stopping test.
PROJECTED, SURE = 8, 0.97
#: Rows of a cell's slice, of a leaf of its tree, and of the sample that the top of the tree is fitted on; its depth at most.
CELL, LEAF, SAMPLE, DEEPEST = 4096, 32, 20_000, 10
#: Queries handled together, and leaves of the first step of a search; each step doubles.
BLOCK, FIRST = 128, 4
SEED = 29


def chi_square(x: np.ndarray, freedom: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, float) / 2, 700.0)
    term, total = np.ones_like(half), np.ones_like(half)
    for k in range(1, freedom // 2):
        term = term * half / k
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_point(sure: float, freedom: int) -> float:
    """Where the distribution function reaches ``sure``."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < sure else (low, middle)
    return high


class Space:
    """The lift and the projection: longest vector, scale, matrix."""

    def __init__(self, width: int, longest: float, projected: int) -> None:
        self.longest = longest
        self.matrix = np.random.default_rng(SEED).standard_normal((width + 1, projected))

    def rows(self, x: np.ndarray) -> np.ndarray:
        scaled = x / self.longest
        rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
        return np.concatenate([scaled, rest[:, None]], axis=1) @ self.matrix

    def queries(self, x: np.ndarray) -> np.ndarray:
        """Queries are taken at length 1, which keeps the order of their inner products."""
        return (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]) @ self.matrix[:-1]

    def distance(self, score: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Squared distance of the lifted vectors with this inner product, and a little for rounding."""
        return np.maximum(0.0, 2 - 2 * score / (length * self.longest)) + 1e-9


class Top:
    """The top of the kd-tree: medians of the sample's widest number, as a complete binary tree."""

    def __init__(self, sample: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.axis, self.value = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        parts = {1: sample}
        for node in range(1, 1 << depth):
            part = parts.pop(node)
            if len(part):
                axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                self.axis[node], self.value[node] = axis, np.median(part[:, axis])
            below = part[:, self.axis[node]] < self.value[node]
            parts[2 * node], parts[2 * node + 1] = part[below], part[~below]

    def cells(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] >= self.value[node])
        return node - (1 << self.depth)


def outside(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    total = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        x = points[:, k, None]
        total += np.maximum(0.0, np.maximum(low[None, :, k] - x, x - high[None, :, k])) ** 2
    return total


class Tree:
    """A kd-tree over one cell's rows, as leaves that are ranges of the reordered rows, each with its box."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray) -> None:
        order, ends, stack = np.arange(len(points)), [], [(0, len(points))]
        while stack:
            a, b = stack.pop()
            if b - a <= LEAF:
                ends.append((a, b))
                continue
            part = points[order[a:b]]
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], middle)]
            stack += [(a, a + middle), (a + middle, b)]
        self.keys, self.ids, self.vectors, self.points = keys[order], ids[order], vectors[order], points[order]
        self.leaves = np.array(sorted(ends)).reshape(-1, 2)
        self.low = np.array([self.points[a:b].min(axis=0) for a, b in self.leaves])
        self.high = np.array([self.points[a:b].max(axis=0) for a, b in self.leaves])

    def search(self, space: Space, keys, vectors, points, least, k: int, reach: float) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the rows and scores of its k best here that may beat ``least``, its k-th best score so far."""
        n, length = len(keys), np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        away = outside(points, self.low, self.high)
        order = np.argsort(away, axis=1, kind="stable")
        away = np.take_along_axis(away, order, axis=1)
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in range(n)]
        least, at, step, active = least.copy(), 0, FIRST, np.arange(n)
        sizes = self.leaves[:, 1] - self.leaves[:, 0]
        while at < order.shape[1] and len(active):
            radius = np.where(np.isfinite(least), reach * space.distance(least, length), np.inf)
            active = active[away[active, at] <= radius[active]]
            for q in active:
                taken = order[q, at : at + step][away[q, at : at + step] <= radius[q]]
                rows = np.repeat(self.leaves[taken, 0] - np.r_[0, np.cumsum(sizes[taken])[:-1]], sizes[taken]) + np.arange(sizes[taken].sum())
                apart = self.points[rows] - points[q]
                near = np.einsum("ij,ij->i", apart, apart)
                rows = rows[(near <= radius[q]) & (self.keys[rows] != keys[q])]
                scores = (self.vectors[rows] * vectors[q]).sum(axis=1)  # the same for equal vectors, wherever they lie
                held = scores >= least[q]
                rows, scores = np.r_[best[q][0], rows[held]], np.r_[best[q][1], scores[held]]
                if len(rows) > k:
                    first = np.lexsort((self.ids[rows], -scores))[:k]
                    rows, scores = rows[first], scores[first]
                if len(rows) == k:
                    least[q] = max(least[q], scores.min())
                best[q] = rows, scores
            at += step
            step *= 2
        return best


NO_ID = np.iinfo(np.int64).max
PACKED = "bin long, kind int, n long, keys binary, ids binary, vectors binary, points binary, least binary"
FOUND = "query_key long, query_id long, ids array<long>, scores array<double>"


def _usable(vector: list) -> bool:
    return vector is not None and None not in vector and any(vector) and bool(np.isfinite(vector).all())


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as the bytes of their doubles, with length and width; those that take no part are gone."""
    for batch in batches:
        rows = [(i, np.array(v, "<f8")) for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()) if _usable(v)]
        columns = [
            pa.array([i for i, _ in rows], pa.int64()), pa.array([v.tobytes() for _, v in rows], pa.binary()),
            pa.array([len(v) for _, v in rows], pa.int32()), pa.array([float(np.linalg.norm(v)) for _, v in rows], pa.float64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "width", "length"])


def _doubles(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, width)


def _unpacked(row: dict, width: int, projected: int) -> tuple:
    of = lambda name, kind, shape: np.frombuffer(row[name], kind).reshape(shape)
    return of("keys", "<i8", -1), of("ids", "<i8", -1), of("vectors", "<f8", (-1, width)), of("points", "<f8", (-1, projected)), of("least", "<f8", -1)


def nearest(vectors: DataFrame, every: int = EVERY, k: int = NEAREST, sure: float = SURE, projected: int = PROJECTED, cell: int = CELL) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors(vec_id, vector)`` whose id is divisible by ``every`` its k best.

    Vectors that are null, all zero or hold null or non-finite numbers take no part, nor do those whose width is not the most
    frequent one (of equally frequent ones the larger).  A row is left out of its own result, rows with an equal
    vector or the same vec_id are not; of rows that repeat a vec_id each is a query, with ranks of its own.  A row without vec_id is no
    query; as a result it comes after others with its score.  Scores are inner products of the vectors as they are, in double precision.
    ``projected`` is even.
    """
    spark = vectors.sparkSession
    kept = stored(vectors.select("vec_id", "vector").mapInArrow(_vectors, "vec_id long, vector binary, width int, length double"))
    # Keys are given on the stored table, whose files and their order stay as they are.
    shape = kept.groupBy("width").agg(F.count("*").alias("n"), F.max("length").alias("longest"))
    shape = shape.orderBy(F.desc("n"), F.desc("width")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if shape is None:
        return empty
    width, n = shape["width"], shape["n"]
    space = Space(width, shape["longest"], projected)
    kept = kept.filter(F.col("width") == width)
    depth = min(DEEPEST, max(0, int(np.ceil(np.log2(n / cell)))) if n > cell else 0)
    few = hashed_share(kept.select("vector"), SAMPLE, "vector").toArrow().column("vector")
    top = Top(space.rows(_doubles(few, width)), depth)
    names = [f"p{j}" for j in range(projected)]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = space.rows(_doubles(batch.column("vector"), width))
            columns = [*batch.columns, pa.array(top.cells(points)), *[pa.array(points[:, j]) for j in range(projected)]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "cell", *names])

    doubles = ", ".join(f"{x} double" for x in names)
    keyed = kept.select(F.monotonically_increasing_id().alias("key"), "vec_id", "vector")
    placed = stored(keyed.mapInArrow(place, f"key long, vec_id long, vector binary, cell long, {doubles}"))
    boxes = placed.groupBy("cell").agg(F.count("*").alias("n"), *[f(x).alias(f"{f.__name__}_{x}") for f in (F.min, F.max) for x in names])
    boxes = sorted(boxes.collect(), key=lambda r: r["cell"])  # 2 ** DEEPEST rows at most
    slices = {r["cell"]: -(-r["n"] // cell) for r in boxes}
    first_bin, total = {}, 0
    for c, m in slices.items():
        first_bin[c] = total
        total += m
    low, high = (np.array([[r[f"{f}_{x}"] for x in names] for r in boxes]) for f in ("min", "max"))
    cells = np.array([r["cell"] for r in boxes])
    reach = chi_square_point(sure, projected)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, keys = batch.column("cell").to_numpy(), batch.column("key").to_numpy()
            start = np.array([first_bin[c] for c in of.tolist()], np.int64)
            many = np.array([slices[c] for c in of.tolist()], np.int64)
            mixed = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            bins = start + (mixed.astype(np.int64) % many if len(keys) else many)
            columns = [pa.array(bins), *[batch.column(x) for x in ("key", "vec_id", "vector", *names)]]
            yield pa.RecordBatch.from_arrays(columns, ["bin", "key", "vec_id", "vector", *names])

    binned = stored(placed.mapInArrow(to_bins, f"bin long, key long, vec_id long, vector binary, {doubles}"))

    def pack(bin_: int, kind: int, keys, ids, x, points, least) -> tuple:
        return (bin_, kind, len(keys), *(np.ascontiguousarray(v).astype(t).tobytes() for v, t in zip((keys, ids, x, points, least), ("<i8", "<i8", "<f8", "<f8", "<f8"))))

    def packed(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 8
        kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in PACKED.split(", ")])

    def columns_of(batch: pa.RecordBatch) -> tuple:
        ids = batch.column("vec_id").fill_null(NO_ID).to_numpy()
        x = _doubles(batch.column("vector"), width)
        return batch.column("bin").to_numpy(), batch.column("key").to_numpy(), ids, x, np.stack([batch.column(p).to_numpy() for p in names], axis=1)

    def answers(tree: Tree, keys, ids, x, points, least) -> list[tuple]:
        out = []
        for at in range(0, len(keys), BLOCK):
            some = slice(at, at + BLOCK)
            found = tree.search(space, keys[some], x[some], points[some], least[some], k, reach)
            for key, id_, (rows, scores) in zip(keys[some].tolist(), ids[some].tolist(), found):
                if len(rows):
                    out.append((key, id_, tree.ids[rows].tolist(), scores.tolist()))
        return out

    def answered(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [x.split()[0] for x in FOUND.split(", ")])

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by bin: a bin's rows are its tree, and its queries search it."""
        def solve(held: list[tuple]) -> pa.RecordBatch:
            _, keys, ids, x, points = (np.concatenate(c) for c in zip(*held))
            asks = np.flatnonzero((ids != NO_ID) & (ids % every == 0))
            home = space.queries(x[asks]) if len(asks) else points[:0]
            return answered(answers(Tree(keys, ids, x, points), keys[asks], ids[asks], x[asks], home, np.full(len(asks), -np.inf)))

        held, now = [], None
        for batch in batches:
            columns = columns_of(batch)
            bins = columns[0]
            for b in np.unique(bins).tolist():
                if now is not None and b != now:
                    yield solve(held)
                    held = []
                held.append(tuple(c[bins == b] for c in columns))
                now = b
        if held:
            yield solve(held)

    def ask_elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries for every bin but their own that the stopping test cannot rule out."""
        for batch in batches:
            home, keys, ids, x, _ = columns_of(batch)
            if not len(keys):
                continue
            points = space.queries(x)
            least = batch.column("least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
            length = np.sqrt(np.einsum("ij,ij->i", x, x))
            radius = np.where(np.isfinite(least), reach * space.distance(least, length), np.inf)
            meets = outside(points, low, high) <= radius[:, None]
            out = []
            for j, c in enumerate(cells.tolist()):
                for b in range(first_bin[c], first_bin[c] + slices[c]):
                    who = np.flatnonzero(meets[:, j] & (home != b))
                    if len(who):
                        out.append(pack(b, 1, keys[who], ids[who], x[who], points[who], least[who]))
                        if len(out) == 16:
                            yield packed(out)
                            out = []
            yield packed(out)

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, keys, ids, x, points = columns_of(batch)
            out = [pack(b, 0, *(v[bins == b] for v in (keys, ids, x, points)), np.zeros(0)) for b in np.unique(bins).tolist()]
            yield packed(out)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by bin and kind: the rows of a bin, then one block of queries after another."""
        rows, tree, now = [], None, None
        for batch in batches:
            for row in batch.to_pylist():
                parts_ = _unpacked(row, width, projected)
                if row["bin"] != now:
                    rows, tree, now = [], None, row["bin"]
                if row["kind"] == 0:
                    rows.append(parts_[:4])
                    continue
                if tree is None and not rows:
                    continue  # a slice that no row fell into
                if tree is None:
                    tree, rows = Tree(*(np.concatenate(c) for c in zip(*rows))), []
                yield answered(answers(tree, *parts_))

    home = stored(binned.repartition(parts, "bin").sortWithinPartitions("bin").mapInArrow(at_home, FOUND))
    kth = F.when(F.size("scores") >= k, F.array_min("scores")).alias("least")
    asking = binned.filter(F.col("vec_id") % every == 0).join(home.select(F.col("query_key").alias("key"), kth), "key", "left")
    blocks = asking.mapInArrow(ask_elsewhere, PACKED)
    met = binned.mapInArrow(trees, PACKED).unionByName(blocks).repartition(parts, "bin").sortWithinPartitions("bin", "kind")
    found = home.unionByName(met.mapInArrow(meet, FOUND))
    pairs = found.select("query_key", "query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    pairs = pairs.select("query_key", "query_id", F.col("x.ids").alias("id"), F.col("x.scores").alias("score"))
    place_ = Window.partitionBy("query_key").orderBy(F.desc("score"), "id")
    ranked = pairs.withColumn("rank", F.row_number().over(place_)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(F.col("id") != F.lit(int(NO_ID)), F.col("id")).alias("vec_id"), "score")


@query()
def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector")))
