"""Centroid clustering with heap-ordered bounds.

Vectors are whole numbers, so sums, distances and centroids are exact. Vectors lie in blocks; a block
keeps one heap per cluster. The key of a vector is the gap between the distances of its second-nearest
and its nearest centroid, plus what its cluster had drifted when the vector was scanned. A centroid and
its rivals can use up no more of the gap than the drift gathered since, so the vectors of a cluster
whose key lies above its drift need no look: the heap is popped until its smallest key does, and only
popped vectors are scanned again.

Blocks and their heaps are two tables bucketed by block, so that a round joins them without moving a
vector and writes the heaps alone. A round sends one row of sum changes per block into the aggregate;
centroids and drifts, ``k`` rows, pass the driver.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.text import discard, stored, unused
from millrace.session import scratch_path

BLOCK = 8192  # vectors of one block: 2 MB at 64 components
BUCKET = 64  # blocks of one bucket, and so of one task
LARGEST = 1 << 26  # whole components up to this keep 64 squared differences within 63 bits
STATE = "block long, near binary, keys array<double>, at array<int>, ends array<int>, sums array<bigint>"


def whole(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component; one too large for exact distances is an error."""
    def one(x: Column) -> Column:
        made = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.when(F.abs(x.cast("double")) * scale <= LARGEST, made).otherwise(
            F.raise_error(F.lit("a vector component is too large for exact whole-number distances")).cast("long")
        )

    return F.transform(vector, one)


def finite(vector: Column) -> Column:
    """True for a vector without NULL, NaN or infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


# -- tables bucketed by block ---------------------------------------------------------------


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` as a table in the shared folder, bucketed by ``block``: tables alike join in place."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "blocks")
    name = f"millrace_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", path).bucketBy(buckets, "block").sortBy("block").saveAsTable(name)
    found = spark.table(name)
    found._stored_at, found._name = path, name
    return found


def _drop(*tables: DataFrame) -> None:
    for df in tables:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {df._name}")
        discard(df)


def _packed(dim: int, key: pa.DataType):
    schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(key)), ("vectors", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        waiting: list[pa.RecordBatch] = []
        rows = 0

        def out(part: pa.Table):
            ids = part["key"].combine_chunks()
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            values = part["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("<i4")
            return pa.RecordBatch.from_arrays([pa.array([block]), ids, pa.array([values.tobytes()])], schema=schema)

        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            while rows >= BLOCK:
                held = pa.Table.from_batches(waiting)
                yield out(held.slice(0, BLOCK))
                block, rows = block + 1, rows - BLOCK
                waiting = held.slice(BLOCK).to_batches()
        if rows:
            yield out(pa.Table.from_batches(waiting))

    return pack


# -- one round over one block ---------------------------------------------------------------


class Block:
    """The vectors of a block and one heap per cluster."""

    def __init__(self, vectors: np.ndarray, k: int):
        self.vectors, self.k = vectors, k
        self.near = np.full(len(vectors), -1, np.int32)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]
        self.scanned = 0

    @classmethod
    def read(cls, vectors: bytes, dim: int, k: int, state: dict | None) -> Block:
        block = cls(np.frombuffer(vectors, "<i4").reshape(-1, dim), k)
        if state:
            block.near = np.frombuffer(state["near"], "<i4").copy()
            ends = state["ends"]
            block.heaps = [
                list(zip(state["keys"][a:b], state["at"][a:b], strict=True))
                for a, b in zip([0, *ends[:-1]], ends, strict=True)
            ]
        return block

    def expired(self, drift: np.ndarray) -> list[int]:
        """Pop all vectors whose gap the drift of their cluster may have used up."""
        if self.near[0] < 0:
            return list(range(len(self.vectors)))
        found = []
        for heap, used in zip(self.heaps, drift.tolist(), strict=True):
            while heap and heap[0][0] <= used:
                found.append(heappop(heap)[1])
        return found

    def assign(self, centroids: np.ndarray, drift: np.ndarray) -> np.ndarray:
        """Scan the expired vectors; the change of each cluster's sums, the last column being rows."""
        rows = np.array(self.expired(drift), np.int64)
        self.scanned = len(rows)
        change = np.zeros((self.k, self.vectors.shape[1] + 1), np.int64)
        if not len(rows):
            return change
        squares = distances(self.vectors[rows], centroids)
        near = squares.argmin(1)
        at = np.arange(len(rows))
        first = np.sqrt(squares[at, near].astype(np.float64))
        if self.k > 1:
            squares[at, near] = np.iinfo(np.int64).max
            second = np.sqrt(squares.min(1).astype(np.float64))
        else:
            second = np.full(len(rows), math.inf)
        # Lowered by far more than rounding can raise it, so a bound never hides a nearer centroid.
        keys = second - first + drift[near] - 1e-9 * (first + drift[near] + 1) - 1e-9 * second
        keys = np.where(np.isnan(keys), math.inf, keys)
        before = self.near[rows]
        self.near[rows] = near
        for c in np.unique(near).tolist():
            mine = np.flatnonzero(near == c)
            fresh = list(zip(keys[mine].tolist(), rows[mine].tolist(), strict=True))
            heap = self.heaps[c]
            if len(fresh) > len(heap):
                heap.extend(fresh)
                heapify(heap)
            else:
                for entry in fresh:
                    heappush(heap, entry)
        moved = near != before
        own = np.column_stack([self.vectors[rows[moved]], np.ones(moved.sum(), np.int64)]).astype(np.int64)
        np.add.at(change, near[moved], own)
        came = before[moved] >= 0
        np.subtract.at(change, before[moved][came], own[came])
        return change

    def state(self, block: int, change: np.ndarray) -> dict:
        entries = [entry for heap in self.heaps for entry in heap]
        return {
            "block": block,
            "near": self.near.astype("<i4").tobytes(),
            "keys": [key for key, _ in entries],
            "at": [at for _, at in entries],
            "ends": np.cumsum([len(heap) for heap in self.heaps]).tolist(),
            "sums": change.ravel().tolist(),
        }


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one column per centroid."""
    found = np.empty((len(vectors), len(centroids)), np.int64)
    for c, centroid in enumerate(centroids):
        apart = vectors - centroid
        found[:, c] = np.einsum("ij,ij->i", apart, apart)
    return found


_STATE_SCHEMA = pa.schema(
    [("block", pa.int64()), ("near", pa.binary()), ("keys", pa.list_(pa.float64())), ("at", pa.list_(pa.int32())),
     ("ends", pa.list_(pa.int32())), ("sums", pa.list_(pa.int64()))]
)


def _round(centroids: np.ndarray, drift: np.ndarray):
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                block = Block.read(row["vectors"], dim, k, row if "near" in row else None)
                change = block.assign(centroids, drift)
                yield pa.RecordBatch.from_pylist([block.state(row["block"], change)], schema=_STATE_SCHEMA)

    return run


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(batch.num_rows):
        yield {name: batch.column(name)[at].as_py() for name in batch.schema.names}


def _assigned(centroids: np.ndarray, drift: np.ndarray, key: pa.DataType):
    k, dim = centroids.shape
    schema = pa.schema([("key", key), ("cluster", pa.int32()), ("distance", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, row in enumerate(_rows(batch.drop_columns(["ids"]))):
                block = Block.read(row["vectors"], dim, k, row if "near" in row else None)
                block.assign(centroids, drift)
                apart = block.vectors - centroids[block.near]
                squares = np.einsum("ij,ij->i", apart, apart)
                ids = batch.column("ids")[at].values
                yield pa.RecordBatch.from_arrays([ids, pa.array(block.near), pa.array(squares)], schema=schema)

    return run


# -- the operator ---------------------------------------------------------------------------


def cluster(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 8,
    rounds: int = 10,
    dim: int = 64,
    scale: int = 1024,
    seed: int = 3,
) -> DataFrame:
    """Per kept row: ``key``, ``cluster``, ``distance`` (squared, to the final centroid),
    ``cluster_inertia``, ``inertia`` and ``centroid_sha256``.

    Kept are rows whose vector has exactly ``dim`` components, none NULL, NaN or infinite; rows are
    judged one by one, so repeated rows and keys all count. The start is the ``k`` kept vectors (all, if
    fewer) with the smallest SHA-256 of ``seed:key``; equal hashes go by the vector, rows with a NULL
    key start last. Each round assigns all vectors (ties: smaller number) and floors the mean of every
    cluster that is not empty. Other columns are dropped; no kept row gives an empty result; a component
    beyond ``LARGEST / scale`` is an error.
    """
    spark = df.sparkSession
    if k < 1 or rounds < 0 or dim < 1:
        raise ValueError("k and dim must be positive, rounds not negative")
    fits = (F.size(vector) == dim) & finite(F.col(vector))
    rows = df.filter(fits).select(F.col(key).alias("key"), whole(F.col(vector), scale).alias("v"))
    token = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    start = rows.orderBy(token.asc_nulls_last(), "v").limit(k).select("v").collect()
    names = unused(df.select(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    if not start:
        return _named(_empty(spark, rows.schema["key"].dataType), key, names, [], [], 0)
    centroids = np.array([r["v"] for r in start], np.int64)
    key_type = pa.list_(_arrow_type(rows)).value_type
    blocks, buckets = _blocks(rows, dim, key_type)
    drift = np.zeros(len(centroids))
    totals = np.zeros((len(centroids), dim + 1), object)
    state: DataFrame | None = None
    for _ in range(rounds):
        joined = blocks.select("block", "vectors")
        joined = joined if state is None else joined.join(state.drop("sums"), "block")
        fresh = _bucketed(joined.mapInArrow(_round(centroids, drift), STATE), buckets)
        if state is not None:
            _drop(state)
        state = fresh
        changes = state.select(F.posexplode("sums").alias("i", "x")).filter("x <> 0").groupBy("i")
        for i, x in changes.agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).toLocalIterator():
            totals[divmod(i, dim + 1)] += int(x)
        moved = np.array(
            [[int(x) // int(row[-1]) for x in row[:-1]] if row[-1] else old for row, old in zip(totals, centroids.tolist(), strict=True)],
            np.int64,
        )
        step = np.sqrt(((moved - centroids) ** 2).sum(1).astype(np.float64)) * (1 + 1e-12)
        rivals = [max([*step[:c], *step[c + 1 :], 0.0]) for c in range(len(step))]
        centroids, drift = moved, (drift + step + np.array(rivals)) * (1 + 1e-12)
        if not step.any():  # nothing moved: further rounds change nothing
            break
    joined = blocks if state is None else blocks.join(state.drop("sums"), "block")
    key_sql = rows.schema["key"].dataType.simpleString()
    found = stored(joined.mapInArrow(_assigned(centroids, drift, key_type), f"key {key_sql}, cluster int, distance bigint"))
    _drop(blocks, *([] if state is None else [state]))
    inertia = {c: int(x) for c, x in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return _named(found, key, names, [inertia.get(c, 0) for c in range(len(centroids))], digests, sum(inertia.values()))


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["key"].dataType)


def _blocks(rows: DataFrame, dim: int, key: pa.DataType) -> tuple[DataFrame, int]:
    """The rows packed into blocks, bucketed; one shuffle of the packed vectors, the only one."""
    key_sql = rows.schema["key"].dataType.simpleString()
    packed = stored(rows.mapInArrow(_packed(dim, key), f"block long, ids array<{key_sql}>, vectors binary"))
    buckets = max(1, math.ceil(packed.count() / BUCKET), rows.sparkSession.sparkContext.defaultParallelism)
    blocks = _bucketed(packed.repartition(buckets, "block"), buckets)
    discard(packed)
    return blocks, buckets


def _empty(spark: SparkSession, key_type) -> DataFrame:
    return spark.createDataFrame([], f"key {key_type.simpleString()}, cluster int, distance bigint")


def _named(found: DataFrame, key: str, names: list[str], inertias: list[int], digests: list[str], total: int) -> DataFrame:
    at = F.col("cluster") + 1
    sums = F.element_at(F.array(*[F.lit(x).cast("long") for x in inertias] or [F.lit(0).cast("long")]), at)
    texts = F.element_at(F.array(*[F.lit(x) for x in digests] or [F.lit("")]), at)
    cluster_name, distance, cluster_inertia, inertia, digest = names
    return found.select(
        F.col("key").alias(key),
        F.col("cluster").alias(cluster_name),
        F.col("distance").alias(distance),
        sums.alias(cluster_inertia),
        F.lit(total).cast("long").alias(inertia),
        texts.alias(digest),
    )
