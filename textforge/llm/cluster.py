"""Exact k-means (Lloyd) over integer vectors whose dimensions are sharded.

Vectors are laid down as chunks of rows by blocks of columns, in a table that is bucketed by (block,
chunk) once and stays in place. A round is one job:

1. A column-block task computes, for its columns only, the exact partial squared distances of a chunk
   to every centroid; of the centroids it needs its block's slice, one row.
2. Partial distances are added by chunk, and the least gives the cluster; ties go to the smaller number.
3. The clusters, two bytes a vector, go back to the blocks, whose buckets are joined where they lie. Each
   task adds up its columns by cluster, the sums are added by block in two steps, and each block floors
   its own slice of the new centroids.

What is shuffled per round grows with vectors x (blocks x k + 1) numbers, and never holds the vectors.
Slices are written after each round, so a lost executor repeats one round's share. Chunks are cut by
position, so a hot vector or label makes no larger task.

All arithmetic is on integers. Numbers are kept in 16, 32 or 64 bits where they fit; beyond what a
64-bit distance can hold, Python's integers take over, so no sum ever wraps.

Defined cases: a null vector, one of another length, or with a null, NaN or infinite component is left
out; repeated rows are vectors of their own; rows with a null id are assigned, but start no centroid
while enough others are there; with fewer vectors than ``k`` there are as many centroids as vectors; an
empty table gives an empty result; other columns are ignored. A distance or sum that no long holds is null.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.llm.frames import checked_broadcast, table, tidy
from textforge.session import materialize, scratch_path

DIMS, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Rows of a chunk, columns of a block, and bytes of a bucket (as 64-bit numbers).
CHUNK, BLOCK, BUCKET_BYTES = 2048, 16, 64 << 20
#: Sums of a block are first added in so many groups.
FAN_IN = 64

_KINDS = {b"2": "<i2", b"4": "<i4", b"8": "<i8"}


def pack(numbers: np.ndarray) -> bytes:
    """Integers in the fewest bytes that hold them all; those beyond 64 bits as decimals."""
    if numbers.size == 0:
        return b"2"
    least, most = int(numbers.min()), int(numbers.max())
    for mark, kind in _KINDS.items():
        if np.iinfo(kind).min <= least and most <= np.iinfo(kind).max:
            return mark + np.ascontiguousarray(numbers).astype(kind).tobytes()
    return b"w" + ",".join(map(str, numbers.ravel().tolist())).encode()


def unpack(data: bytes, width: int) -> np.ndarray:
    """Rows of ``width`` numbers: 64-bit, or Python's where those are too small."""
    if data[:1] in _KINDS:
        return np.frombuffer(data, _KINDS[data[:1]], offset=1).astype(np.int64).reshape(-1, width)
    return np.array([int(x) for x in data[1:].split(b",")], object).reshape(-1, width)


def _most(numbers: np.ndarray) -> int:
    return max(abs(int(numbers.min())), abs(int(numbers.max()))) if numbers.size else 0


def _wide(numbers: np.ndarray) -> np.ndarray:
    return numbers if numbers.dtype == object else np.array(numbers.tolist(), object).reshape(numbers.shape)


def _plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a + b if _most(a) + _most(b) < 1 << 63 else _wide(a) + _wide(b)


def quantized(components: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, exactly also where the product is beyond a double's integers."""
    if components.size == 0 or np.abs(components).max() < 2.0**50 / scale:
        return np.floor(components * scale).astype(np.int64)
    exact = [math.floor(x * scale) if abs(x) < 2.0**50 / scale else _times(x, scale) for x in components.ravel().tolist()]
    return np.array(exact, object).reshape(components.shape)


def _times(x: float, scale: int) -> int:
    top, bottom = x.as_integer_ratio()
    return top * scale // bottom


def partial_distances(rows: np.ndarray, centroids: np.ndarray, dims: int) -> np.ndarray:
    """Squared distances over these columns; 64-bit if those over all ``dims`` columns fit as well."""
    if 4 * max(_most(rows), _most(centroids)) ** 2 * dims >= 1 << 63:
        rows, centroids = _wide(rows), _wide(centroids)
    return np.stack([((rows - c) ** 2).sum(1) for c in centroids], axis=1)


def _chunks(dims: int, scale: int, block: int, id_type: pa.DataType):
    """Chunks of rows as one row per block of columns, and one row (block -1) with the ids."""
    schema = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("data", pa.binary()), ("ids", pa.list_(id_type))])

    @tidy
    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            for at in range(0, len(batch), CHUNK):
                some = vectors.slice(at, CHUNK)
                numbers = quantized(some.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims), scale)
                own = pa.array([ids.slice(at, CHUNK).to_pylist()], pa.list_(id_type))
                yield pa.record_batch([pa.array([chunk]), pa.array([-1], pa.int32()), pa.array([None], pa.binary()), own], schema=schema)
                parts = [pack(numbers[:, lo : lo + block]) for lo in range(0, dims, block)]
                n = len(parts)
                nothing = pa.nulls(n, pa.list_(id_type))
                yield pa.record_batch([pa.array([chunk] * n), pa.array(range(n), pa.int32()), pa.array(parts, pa.binary()), nothing], schema=schema)
                chunk += 1

    return run


def _widths(dims: int, block: int) -> list[int]:
    return [min(block, dims - lo) for lo in range(0, dims, block)]


def _measure(widths: list[int]):
    """``chunk, block, data, slice`` to the chunk's partial distances."""
    dims = sum(widths)

    @tidy
    def run(batches):
        for batch in batches:
            chunks, blocks, data, slices = (batch.column(i).to_pylist() for i in range(4))
            found = [
                pack(partial_distances(unpack(d, widths[b]), unpack(s, widths[b]), dims))
                for b, d, s in zip(blocks, data, slices)
            ]
            yield pa.record_batch([pa.array(chunks, pa.int64()), pa.array(found, pa.binary())], names=["chunk", "part"])

    return run


def _nearest(k: int):
    """Adds a chunk's partial distances and takes the least: clusters and distances of its rows."""

    def run(group: pa.Table) -> pa.Table:
        total = reduce(_plus, (unpack(p, k) for p in group["part"].to_pylist()))
        cluster = total.argmin(1)
        best = np.take_along_axis(total, cluster[:, None], 1)
        return pa.table({"chunk": group["chunk"][:1].cast(pa.int64()), "clusters": pa.array([pack(cluster)], pa.binary()), "distances": pa.array([pack(best)], pa.binary())})

    return run


def _by_cluster(rows: np.ndarray, clusters: np.ndarray, k: int) -> np.ndarray:
    """Sums of the rows of each cluster; the last column counts them."""
    if _most(rows) * max(1, len(rows)) >= 1 << 63:
        rows = _wide(rows)
    out = np.zeros((k, rows.shape[1] + 1), rows.dtype)
    np.add.at(out[:, :-1], clusters, rows)
    out[:, -1] = np.bincount(clusters, minlength=k)
    return out


def _add_up(widths: list[int], k: int):
    """``block, data, clusters`` to one sum per block that the task has seen."""

    @tidy
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data, clusters in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = _by_cluster(unpack(data, widths[block]), unpack(clusters, 1)[:, 0], k)
                sums[block] = _plus(sums[block], own) if block in sums else own
        salt = TaskContext.get().partitionId() % FAN_IN
        rows = [pa.array([*sums], pa.int32()), pa.array([salt] * len(sums), pa.int32()), pa.array([pack(s) for s in sums.values()], pa.binary())]
        yield pa.record_batch(rows, names=["block", "salt", "sums"])

    return run


def _sum_of(widths: list[int]):
    def run(group: pa.Table) -> pa.Table:
        block = group["block"][0].as_py()
        total = reduce(_plus, (unpack(s, widths[block] + 1) for s in group["sums"].to_pylist()))
        return pa.table({"block": pa.array([block], pa.int32()), "sums": pa.array([pack(total)], pa.binary())})

    return run


def _new_slice(widths: list[int]):
    """A block's slice of the centroids: its sums over the counts; an empty cluster keeps its own."""

    def run(new: pa.Table, old: pa.Table) -> pa.Table:
        block = old["block"][0].as_py()
        before = unpack(old["slice"][0].as_py(), widths[block])
        after = before
        if len(new):
            total = reduce(_plus, (unpack(s, widths[block] + 1) for s in new["sums"].to_pylist()))
            sums, counts = total[:, :-1], total[:, -1:]
            after = _wide(before)
            some = np.flatnonzero(counts[:, 0] > 0)
            after[some] = _wide(sums)[some] // _wide(counts)[some]
        return pa.table({"block": pa.array([block], pa.int32()), "slice": pa.array([pack(after)], pa.binary())})

    return run


def _numbers_as_text(widths: list[int]):
    """Each centroid's components of one block, as text."""

    def run(batches):
        for batch in batches:
            blocks, clusters, texts = [], [], []
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for cluster, row in enumerate(unpack(data, widths[block]).tolist()):
                    blocks.append(block)
                    clusters.append(cluster)
                    texts.append(",".join(map(str, row)))
            yield pa.record_batch([pa.array(clusters, pa.int32()), pa.array(blocks, pa.int32()), pa.array(texts, pa.string())], names=["cluster", "block", "text"])

    return run


def _rows_of(id_type: pa.DataType):
    """``ids, clusters, distances`` of chunks to one row per vector."""

    def run(batches):
        for batch in batches:
            for ids, clusters, distances in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                far = [d if d < 1 << 63 else None for d in unpack(distances, 1)[:, 0].tolist()]
                columns = [ids.values, pa.array(unpack(clusters, 1)[:, 0].astype(np.int32)), pa.array(far, pa.int64())]
                yield pa.record_batch(columns, names=["id", "cluster", "distance"])

    return run


def usable(vectors: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, none of them null or not finite."""
    finite = F.forall(vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vectors) == dims) & finite, F.lit(False))


def _first_slices(kept: DataFrame, k: int, seed: int, dims: int, scale: int, block: int) -> tuple[DataFrame, int]:
    """The vectors with the smallest hashes as slices by block, and their number."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.select(order.alias("h"), "vector").orderBy(F.col("h").asc_nulls_last(), "vector").limit(k).collect()
    start = quantized(np.array([r["vector"] for r in first], float).reshape(-1, dims), scale)
    rows = [(b, bytearray(pack(start[:, lo : lo + block]))) for b, lo in enumerate(range(0, dims, block))]
    return kept.sparkSession.createDataFrame(rows, "block int, slice binary"), len(first)


def cluster_vectors(
    df: DataFrame,
    k: int = K,
    rounds: int = ROUNDS,
    *,
    id_col: str = "id",
    vec_col: str = "vector",
    dims: int = DIMS,
    scale: int = SCALE,
    seed: int = SEED,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """``<id_col>, cluster, distance`` of every usable vector, and ``cluster, components`` of the final
    centroids as decimal numbers joined by commas."""
    spark = df.sparkSession
    kept = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").alias("vector")).where(usable(F.col("vector"), dims))
    id_type = kept.schema["id"].dataType
    arrow_id = pa.schema(spark.createDataFrame([], T.StructType([T.StructField("id", id_type)])).toArrow().schema).field(0).type
    widths = _widths(dims, block)
    slices, k = _first_slices(kept, k, seed, dims, scale, block)
    if k == 0:
        none = spark.createDataFrame([], T.StructType([T.StructField(id_col, id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())]))
        return none, spark.createDataFrame([], "cluster int, components string")

    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(kept.count() * dims * 8 / BUCKET_BYTES))
    laid = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("block", T.IntegerType()), T.StructField("data", T.BinaryType()), T.StructField("ids", T.ArrayType(id_type))])
    path = scratch_path(spark, "vector-blocks")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    chunks = kept.mapInArrow(_chunks(dims, scale, block, arrow_id), laid)
    chunks.repartition(buckets, "block", "chunk").write.bucketBy(buckets, "block", "chunk").option("path", path).saveAsTable(name)
    blocks = spark.table(name).where("block >= 0").select("chunk", "block", "data")
    ids = spark.table(name).where("block = -1").select("chunk", "ids")
    each = F.explode(F.sequence(F.lit(0), F.lit(len(widths) - 1)))

    def assigned(slices: DataFrame) -> DataFrame:
        parts = (
            blocks.join(checked_broadcast(slices, 8 * k * block + 16), "block")
            .select("chunk", "block", "data", "slice")
            .mapInArrow(_measure(widths), "chunk long, part binary")
        )
        return parts.groupBy("chunk").applyInArrow(_nearest(k), "chunk long, clusters binary, distances binary")

    for _ in range(rounds):
        slices = materialize(slices, "centroid-slices")
        sent = assigned(slices).select(each.alias("block"), "chunk", "clusters")
        sums = (
            blocks.join(sent.hint("shuffle_hash"), ["block", "chunk"])
            .select("block", "data", "clusters")
            .mapInArrow(_add_up(widths, k), "block int, salt int, sums binary")
            .groupBy("block", "salt")
            .applyInArrow(_sum_of(widths), "block int, sums binary")
        )
        slices = sums.groupBy("block").cogroup(slices.groupBy("block")).applyInArrow(_new_slice(widths), "block int, slice binary")
    slices = materialize(slices, "centroid-slices")
    rows = T.StructType([T.StructField("id", id_type), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    found = ids.join(assigned(slices), "chunk").select("ids", "clusters", "distances").mapInArrow(_rows_of(arrow_id), rows)
    found = materialize(found, "clusters").withColumnRenamed("id", id_col)
    spark.sql(f"DROP TABLE {name}")  # the files stay in the shared folder
    texts = slices.mapInArrow(_numbers_as_text(widths), "cluster int, block int, text string")
    in_order = F.array_sort(F.collect_list(F.struct("block", "text")))
    components = F.array_join(F.transform(in_order, lambda s: s["text"]), ",")
    return found, texts.groupBy("cluster").agg(components.alias("components"))


def op11_centroid_clustering(spark, sf_dir: str) -> DataFrame:
    """Vectors of ``embeddings`` with their cluster, distance, both inertias and their centroid's digest."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found, centroids = cluster_vectors(vectors, id_col="vec_id", vec_col="embedding")
    digests = centroids.select("cluster", F.sha2("components", 256).alias("centroid_sha256"))
    sums = materialize(found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("gaps")), "inertia")
    all_s, all_gaps = (sums.agg(F.sum(c)).scalar() for c in ("s", "gaps"))
    clusters = sums.join(digests, "cluster").select(
        "cluster",
        F.when(F.col("gaps") == 0, F.col("s").try_cast("bigint")).alias("cluster_inertia"),
        F.when(all_gaps == 0, all_s.try_cast("bigint")).alias("inertia"),
        "centroid_sha256",
    )
    return found.join(checked_broadcast(materialize(clusters, "cluster-sums"), 100), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
