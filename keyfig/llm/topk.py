"""Exact top-k search by inner product: pivot-table elimination.

Vectors are integers.  A few hundred sampled vectors give the pivots, each the furthest from the
span of those before it; the pivots decide the speed, never the result.  For every vector the
distances to all pivots are computed once and stored with it.  From these alone the least distance
that a query and a candidate can have is known: the distances fix both vectors' places in the
pivots' span and how far they are off it, and off it they are nearest if they point the same way.
A least distance is a greatest inner product, ``place . place + off * off``, so the bounds of many
pairs are one matrix product.  Candidates are evaluated in the order of that bound, until the next
bound is below the k-th best score: the exact stopping rule.

Equal vectors are one candidate that carries its least ids, as many as can be in any result; so a
vector that a third of all rows hold is compared once.  A first pass searches each query among the
vectors of its own batch (the table is stored by nearest pivot), whose k-th score is a floor for the
second pass, in which blocks of queries of bounded size meet all vectors, a batch at a time.  A task
returns at most k candidates a query, and only those that reach the floor; merging keeps the k best.

Defined results: rows whose vector is null or holds a null or non-finite component take no part; a
query row without a valid vector returns nothing.  Vectors of different lengths are compared as if
the shorter ended in zeros; two empty ones score 0.  Ties go to the smaller id, rows without an id
come last (the greatest 64-bit number stands for them).  Repeated rows are candidates of their own;
of a query's own row only one copy is left out.  Scores beyond 64 bits are cut to the nearest.  An
empty table has no results.  Only id and vector are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from keyfig.llm.common import lookup, shuffle_parts, stored

#: Pivots, vectors that they are chosen from, and bytes of queries that travel at once.
PIVOTS, SAMPLE, BLOCK_BYTES = 48, 2_000, 8 << 20
#: Vectors of a batch that are compared at once, and queries whose bounds are computed at once.
BATCH, GROUP = 8_192, 64
_LAST = 2**63 - 1


# -------------------------------------------------------------------------------- arithmetic

def padded(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list<double> column as a matrix, shorter ones filled with zeros."""
    n = np.asarray(column.value_lengths())
    out = np.zeros((len(n), dims))
    out[np.arange(dims) < n[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def products(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products of integer rows with one integer vector, as int64."""
    if most < 2**52:
        return (a @ b).astype(np.int64)
    exact = a.astype(object) @ np.array([int(x) for x in b], object) if a.shape[1] else np.zeros(len(a), object)
    return np.array([max(-2**63, min(_LAST, int(x))) for x in exact], np.int64)


class Pivots:
    """Chosen vectors, distances to them, and what the distances tell."""

    def __init__(self, sample: np.ndarray, count: int):
        rest, chosen = sample.astype(float), []
        least = 1e-6 * (rest * rest).sum(1).max(initial=0)
        while len(chosen) < min(count, len(sample)):
            off = (rest * rest).sum(1)
            if not off.max() > least:
                break
            chosen.append(int(off.argmax()))
            axis = rest[chosen[-1]] / np.sqrt(off.max())
            rest = rest - np.outer(rest @ axis, axis)
        self.vectors = sample[chosen]
        self.square = (self.vectors * self.vectors).sum(1)
        self.turn = np.linalg.inv(np.linalg.cholesky(self.vectors @ self.vectors.T)).T if chosen else np.zeros((0, 0))

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        return np.stack([np.linalg.norm(vectors - p, axis=1) for p in self.vectors], 1) if len(self.vectors) else np.zeros((len(vectors), 0))

    def places(self, distances: np.ndarray, square: np.ndarray) -> np.ndarray:
        """Places in the pivots' span and, last, distances off it; their products bound inner products."""
        inner = (square[:, None] + self.square - distances * distances) / 2
        place = inner @ self.turn
        off = np.sqrt(np.maximum(square - (place * place).sum(1), 0) + 1e-9 * square)
        return np.column_stack([place, off])


class Best:
    """The k best (score, id) of one query; ``floor`` is a score that the k-th reaches anyway."""

    def __init__(self, k: int, floor: int = -2**63):
        self.k, self.floor, self.found = k, floor, []

    def add(self, scores: np.ndarray, ids: list[list[int]]) -> None:
        for at in np.flatnonzero(scores >= self.floor).tolist():
            self.found += [(-int(scores[at]), i) for i in ids[at]]
        if len(self.found) >= self.k:
            self.found = sorted(self.found)[:self.k]
            self.floor = max(self.floor, -self.found[-1][0])


def search(queries: np.ndarray, query_places: np.ndarray, best: list[Best], vectors: np.ndarray, places: np.ndarray, ids: list[list[int]]) -> int:
    """Puts the k best of a batch of vectors into ``best``; returns how many were evaluated."""
    if not len(vectors) or not len(queries):
        return 0
    long, own = np.sqrt((vectors * vectors).sum(1)), np.sqrt((queries * queries).sum(1))
    most = long.max()
    evaluated = 0
    for a in range(0, len(queries), GROUP):
        some = slice(a, min(a + GROUP, len(queries)))
        bounds = query_places[some] @ places.T
        bounds += 1e-6 * most * own[some, None] + 1e-6  # what rounding may take
        for j, row in enumerate(bounds):
            q, result = a + j, best[a + j]
            alive = np.flatnonzero(row >= result.floor)
            alive = alive[np.argsort(-row[alive], kind="stable")]
            limits, at, step = row[alive], 0, 64
            while at < len(alive) and limits[at] >= result.floor:
                part = alive[at:at + step]
                result.add(products(vectors[part], queries[q], float(own[q] * most)), [ids[i] for i in part.tolist()])
                evaluated += len(part)
                at, step = at + step, min(step * 4, 4096)
    return evaluated


# ------------------------------------------------------------------------------------- Spark

def whole_numbers(column: str, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null unless all components are finite numbers."""
    c = F.col(f"`{column}`")
    odd = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = lambda y: F.when(F.abs(y) < 2.0**62, F.floor(y).cast("double")).otherwise(y)
    return F.when(~odd, F.transform(c, lambda x: whole(x.cast("double") * scale)))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """vector, its ``k`` least ids, its rows and queries, and a key; stored."""
    # row_number <= k is limited in each task before the shuffle, so no vector gathers its rows
    first = rows.withColumn("n", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("n") <= k)
    ids = first.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    asked = rows.where("asked").groupBy("vector").agg(F.count("*").alias("weight"))
    return stored(ids.join(asked, "vector", "left").withColumn("key", F.monotonically_increasing_id()), "vectors")


def _matrix(batch: pa.RecordBatch, name: str, dims: int) -> np.ndarray:
    return padded(batch.column(batch.schema.get_field_index(name)), dims)


def _table(spark: SparkSession, vectors: DataFrame, pivots: int, sample: int) -> tuple[DataFrame, int, Broadcast]:
    """The vectors with their distances to the pivots, near ones together; stored.  The most
    components, and the pivots."""
    dims = vectors.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 0
    some = vectors.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).collect()
    chosen = spark.sparkContext.broadcast(Pivots(padded(pa.array([r["vector"] for r in some], pa.list_(pa.float64())), dims), pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = chosen.value.distances(_matrix(batch, "vector", dims))
            near = far.argmin(1).astype(np.int32) if far.shape[1] else np.zeros(len(far), np.int32)
            least = far.min(1, initial=np.inf)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1]), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(near), pa.array(least)], names=[*batch.schema.names, "far", "near", "least"])

    made = vectors.mapInArrow(run, "vector array<double>, ids array<bigint>, weight bigint, key bigint, far array<double>, near int, least double")
    made = stored(made, "distances")
    return stored(made.repartitionByRange(shuffle_parts(spark), "near", "least", "key").sortWithinPartitions("near", "least"), "pivot-table"), dims, chosen


_FOUND = "key bigint, score bigint, id bigint, evaluated bigint"


def _floors(table: DataFrame, dims: int, chosen: Broadcast, k: int) -> DataFrame:
    """The queries with a floor of their k-th score, from the vectors that are stored beside them; stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, BATCH):
                batch = whole.slice(a, BATCH)
                column = lambda name, b=batch: b.column(b.schema.get_field_index(name))
                asked = np.flatnonzero(~column("weight").is_null().to_numpy(zero_copy_only=False))
                if not len(asked):
                    continue
                vectors, far = _matrix(batch, "vector", dims), np.stack(column("far").to_numpy(zero_copy_only=False))
                best = [Best(k) for _ in asked]
                places = chosen.value.places(far, (vectors * vectors).sum(1))
                search(vectors[asked], places[asked], best, vectors, places, column("ids").to_pylist())
                rows = pa.array(asked)
                most = float((vectors[asked] ** 2).sum(1).max())
                own = np.concatenate([products(vectors[i:i + 1], vectors[i], most) for i in asked.tolist()])
                yield pa.RecordBatch.from_arrays([*(column(c).take(rows) for c in ("key", "vector", "far", "weight")), pa.array([b.floor for b in best], pa.int64()), pa.array(own)],
                                                 names=["key", "vector", "far", "weight", "floor", "square"])

    return stored(table.mapInArrow(run, "key bigint, vector array<double>, far array<double>, weight bigint, floor bigint, square bigint"), "queries")


def _search_all(shared: Broadcast, dims: int, chosen: Broadcast, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task of the second pass: all its vectors against one block of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, queries, query_far, floors = shared.value
        best, evaluated = [Best(k, f) for f in floors.tolist()], 0
        query_places = chosen.value.places(query_far, (queries * queries).sum(1))
        for whole in batches:
            for a in range(0, whole.num_rows, BATCH):
                batch = whole.slice(a, BATCH)
                far = np.stack(batch.column(2).to_numpy(zero_copy_only=False))
                vectors = padded(batch.column(0), dims)
                evaluated += search(queries, query_places, best, vectors, chosen.value.places(far, (vectors * vectors).sum(1)), batch.column(1).to_pylist())
        counts = np.array([len(b.found) for b in best])
        flat = [x for b in best for x in b.found]
        if flat:
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, counts)), pa.array([-s for s, _ in flat], pa.int64()), pa.array([i for _, i in flat], pa.int64()),
                                              pa.array([evaluated, *[0] * (len(flat) - 1)], pa.int64())], names=["key", "score", "id", "evaluated"])
    return run


def top_k(rows: DataFrame, asked: Column, k: int, vec_id: str = "vec_id", vector: Column | None = None, embedding: str = "embedding",
          pivots: int = PIVOTS, sample: int = SAMPLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best other rows for each row that ``asked`` picks."""
    spark = rows.sparkSession
    numbers = whole_numbers(embedding) if vector is None else vector
    valid = stored(rows.select(F.coalesce(F.col(f"`{vec_id}`").cast("long"), F.lit(_LAST)).alias("id"), numbers.alias("vector"),
                               F.coalesce(asked, F.lit(False)).alias("asked")).where("vector is not null"), "valid")
    table, dims, chosen = _table(spark, _distinct(valid, k + 1), pivots, sample)
    queries = _floors(table, dims, chosen, k + 1)
    n = queries.count()
    blocks = -(-n * 8 * (dims + pivots + 2) // block_bytes) or 1
    found = None
    for b in range(blocks):  # one block of bounded size at a time on the driver and in a task
        block = (queries.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b) if blocks > 1 else queries).toArrow()
        lists = lambda name, t=block: t.column(name).combine_chunks()
        far = np.stack(lists("far").to_numpy(zero_copy_only=False)) if block.num_rows else np.zeros((0, 0))
        shared = spark.sparkContext.broadcast((block.column("key").to_numpy(), padded(lists("vector"), dims), far, block.column("floor").to_numpy()))
        part = table.select("vector", "ids", "far").mapInArrow(_search_all(shared, dims, chosen, k + 1), _FOUND)
        part = stored(part, "found")
        shared.unpersist()
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    best = (found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
            .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("n", "score", "id"))).alias("best")))
    answers = stored(queries.select("key", "vector", "weight", "square").join(best, "key").drop("key"), "answers")
    out = lookup(valid.where("asked").drop("asked"), answers, ["vector"], "weight")
    # a query's own row: its id with the square of its own vector
    own = F.array_position(F.transform("best", lambda x: (x["id"] == F.col("id")) & (x["score"] == F.col("square"))), True)
    others = F.slice(F.filter("best", lambda x, i: i + 1 != own), 1, k)
    return (out.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.when(F.col("hit.id") != _LAST, F.col("hit.id")).alias("vec_id"), F.col("hit.score").alias("score")))
