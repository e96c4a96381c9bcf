"""Exact k-nearest-neighbour join over dense or sparse vectors, by a cell index.

``build_index`` puts every base row in the cell of its nearest pivot (pivots are base rows, the first in
hash order) and notes per cell the least and greatest distance to the pivot, the least and greatest
norm and, for sparse vectors, the greatest weight of each term. A crowded cell is cut into units by key
hash, so a hot region or class is no larger task.

``NeighborIndex.search`` visits units in two rounds. First the most promising ones, until they hold k
rows: that gives an upper bound for the distance of the k-th neighbour. Then every other unit whose
lower bound does not exceed it. A unit's lower bound is the greatest of

- the triangle inequality, from the query's distance to the pivot and the cell's least and greatest one;
- the bisecting plane of the cell's pivot and the query's nearest pivot: base rows lie on the pivot's side;
- the norms, and for sparse vectors the sum over the query's terms of its weight times the cell's greatest.

So queries are sent to the units that can hold a neighbour, and not to all. Within a unit, dense vectors are
compared in pieces of bounded size. Sparse ones go by the unit's postings: a query adds up its terms, those
that say least per posting left out as long as what they can add stays below a share of what the bound needs;
only rows whose upper bound on the dot product still reaches it are measured exactly. All bounds have a
margin for rounding, and distances are sums of squares without cancellation.

Copies of one base vector beyond the first k + 1 (by key) cannot be among anyone's k nearest, so
they are left out. An index is built once for many searches. Queries of one unit are cut as well when many.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.operators.ranks import hash_order
from textforge.session import materialize

TILE_CELLS = 1 << 22  # numbers per dense piece of a task, and of a unit
CELL_NUMBERS = 1 << 17  # stored numbers per cell that the number of pivots aims at
DENSE_CELLS = 32  # of dense vectors: cells grow beyond that, up to a unit, as every cell may get a copy of every query
MAX_PIVOTS = 4096
PIVOT_NUMBERS = 1 << 23  # of pivots x dimensions, in memory at once
MAX_UNITS = 1 << 14
QUERY_ROWS = 1 << 14  # queries of a unit in one task
DEPTH = 0.3  # the share of the needed dot product that left-out terms may reach
ALL = "*"


def _is_vector(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, VectorUDT)


def _parts(df: DataFrame, vec: str) -> tuple[Column, Column]:
    """Index list (null if dense) and value list of a vector column."""
    if _is_vector(df, vec):
        parts = F.unwrap_udt(F.col(vec))
        whole = F.when(F.size(parts["values"]) > 0, F.sequence(F.lit(0), F.size(parts["values"]) - 1))
        idx = F.coalesce(parts["indices"], whole, F.array().cast("array<int>"))
        return F.when(parts["values"].isNotNull(), idx), parts["values"]
    return F.lit(None).cast("array<int>"), F.col(vec).cast("array<double>")


def _rows(df: DataFrame, key: str, vec: str, within: str | None) -> DataFrame:
    idx, val = _parts(df, vec)
    part = F.lit(ALL) if within is None else F.col(within).cast("string")
    return df.select(
        part.alias("part"), F.col(key).alias("id"), idx.alias("idx"), val.alias("val")
    )


def first_rows(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """At most ``n`` rows, the first in hash order; all of them if ``n`` is None."""
    return df if n is None else df.orderBy(hash_order(key, 7), key).limit(n)


def _first_copies(base: DataFrame, k: int) -> DataFrame:
    """At most k + 1 rows per identical vector, smallest keys first.

    The rank filter is applied before the shuffle as well, so a vector shared by a
    third of the rows sends only k + 1 rows per task.
    """
    copies = Window.partitionBy("part", "h", "idx", "val").orderBy("id")
    return (
        base.withColumn("h", F.xxhash64("idx", "val"))
        .withColumn("copy", F.row_number().over(copies))
        .filter(F.col("copy") <= k + 1)
        .drop("h", "copy")
    )


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    if all(len(val) == width for val in values):
        return np.concatenate(values.tolist()).astype(float).reshape(len(values), width)
    out = np.zeros((len(values), width))
    for i, val in enumerate(values):
        out[i, : len(val)] = val
    return out


def _nearest(qid, a: np.ndarray, limit: np.ndarray, sid, b: np.ndarray, k: int, exclude_self: bool) -> pd.DataFrame:
    """The k nearest rows of ``b``, whose ids rise, for every row of ``a``, as far as within its limit."""
    own, other = (a * a).sum(1), (b * b).sum(1)
    rough = a @ b.T
    rough *= -2.0
    rough += other  # squared distances less the query's own square
    # Everything within rounding of the k-th distance is measured again exactly.
    slack = 1e-9 * (1.0 + float(own.max()) + float(other.max()))
    if len(sid) > k:
        limit = limit - own + slack
        free = np.flatnonzero(np.isposinf(limit))
        if len(free):
            some = rough[free]
            if exclude_self:
                some[qid[free][:, None] == sid[None, :]] = np.inf
            limit[free] = np.partition(some, k - 1, axis=1)[:, k - 1] + slack
        row, col = np.nonzero(rough <= limit[:, None])
    else:
        row, col = np.nonzero(np.isfinite(rough))
    if exclude_self:
        others = qid[row] != sid[col]
        row, col = row[others], col[others]
    exact = ((b[col] - a[row]) ** 2).sum(1)
    order = np.lexsort((col, exact, row))
    row, col, exact = row[order], col[order], exact[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return pd.DataFrame({"id": qid[row[best]], "neighbor": sid[col[best]], "d2": exact[best]})


def _tiles(q: pd.DataFrame, s: pd.DataFrame, k: int, exclude_self: bool) -> tuple[pd.DataFrame, int]:
    """Dense rows: all pairs of a unit, piece by piece; also how many pairs that were."""
    width = max(map(len, [*q["val"], *s["val"]]))
    rows = max(1, min(math.isqrt(TILE_CELLS), TILE_CELLS // max(1, width)))
    sid, base = s["id"].to_numpy(), _matrix(s["val"], width)
    found = []
    for at in range(0, len(q), rows):
        part = q.iloc[at : at + rows]
        a, near = _matrix(part["val"], width), []
        for begin in range(0, len(s), rows):
            piece = slice(begin, begin + rows)
            near.append(_nearest(part["id"].to_numpy(), a, part["limit"].to_numpy(), sid[piece], base[piece], k, exclude_self))
        near = pd.concat(near).sort_values(["id", "d2", "neighbor"], ignore_index=True)
        found.append(near[near.groupby("id", sort=False).cumcount() < k])
    return pd.concat(found, ignore_index=True), len(q) * len(s)


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)


class Postings:
    """The inverted lists of a unit's sparse rows, which are in key order."""

    def __init__(self, s: pd.DataFrame):
        self.ids = s["id"].to_numpy()
        self.sizes = np.array([len(x) for x in s["idx"]], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.idx = np.concatenate([*s["idx"], np.empty(0, np.int32)]).astype(np.int64)
        self.val = np.concatenate([*s["val"], np.empty(0)])
        row = np.repeat(np.arange(len(s)), self.sizes)
        order = np.argsort(self.idx, kind="stable")
        self.terms, self.starts, self.counts = np.unique(self.idx[order], return_index=True, return_counts=True)
        self.rows, self.weights = row[order], self.val[order]
        self.square = np.bincount(row, self.val**2, len(s))

    def _exact(self, at: np.ndarray, idx: np.ndarray, val: np.ndarray) -> np.ndarray:
        """Squared distances of the rows ``at`` to a query."""
        out = np.empty(len(at))
        step = max(1, TILE_CELLS // max(1, len(idx)))
        for lo in range(0, len(at), step):
            some = at[lo : lo + step]
            own = _ranges(self.begins[some], self.sizes[some])
            row = np.repeat(np.arange(len(some)), self.sizes[some])
            column = np.searchsorted(idx, self.idx[own])
            shared = idx[np.minimum(column, len(idx) - 1)] == self.idx[own] if len(idx) else np.zeros(len(own), bool)
            there = np.zeros((len(some), len(idx)))
            there[row[shared], column[shared]] = self.val[own][shared]
            rest = np.bincount(row[~shared], self.val[own][~shared] ** 2, len(some))
            out[lo : lo + step] = ((there - val) ** 2).sum(1) + rest
        return out

    def nearest(self, key, idx, val, limit: float, k: int, exclude_self: bool) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and distances of the k nearest, as far as within ``limit``; also how many were measured."""
        idx = np.asarray(idx, np.int64)
        square, slack = val @ val, 1e-9 * (1.0 + val @ val + self.square.max())
        at = np.searchsorted(self.terms, idx)
        known = self.terms[np.minimum(at, len(self.terms) - 1)] == idx if len(self.terms) else np.zeros(len(idx), bool)
        at, w = at[known], val[known]
        order = np.argsort(w * w / self.counts[at])
        at, w = at[order], w[order]
        reach = np.sqrt(np.cumsum(w * w))  # what terms up to here add to a row of norm 1 at most
        needed = (square + self.square.min() - limit) / 2 if math.isfinite(limit) else 0.0
        left = int(np.searchsorted(reach, DEPTH * max(needed, 0.0) / math.sqrt(max(self.square.max(), 1e-300))))
        own = _ranges(self.starts[at[left:]], self.counts[at[left:]])
        row, weight = self.rows[own], self.weights[own]
        dot = np.bincount(row, np.repeat(w[left:], self.counts[at[left:]]) * weight, len(self.ids))
        open_ = np.maximum(self.square - np.bincount(row, weight * weight, len(self.ids)), 0.0)
        most = dot + (reach[left - 1] * np.sqrt(open_) if left else 0.0)
        least = square + self.square - 2.0 * most - slack
        if exclude_self:
            least[self.ids == key] = np.inf
        measured, d2 = np.empty(0, np.int64), np.empty(0)
        if not math.isfinite(limit):  # the rows that look nearest give a limit
            first = np.argsort(least, kind="stable")[:k]
            measured = first[np.isfinite(least[first])]
            d2 = self._exact(measured, idx, val)
            limit = d2.max() if len(measured) == k else np.inf
        more = np.setdiff1d(np.flatnonzero((least <= limit) & np.isfinite(least)), measured)
        measured, d2 = np.concatenate((measured, more)), np.concatenate((d2, self._exact(more, idx, val)))
        best = np.lexsort((measured, d2))[:k]
        return measured[best], d2[best], len(measured)


def _by_postings(q: pd.DataFrame, s: pd.DataFrame, k: int, exclude_self: bool) -> tuple[pd.DataFrame, int]:
    postings, pairs, found = Postings(s), 0, []
    for key, idx, val, limit in zip(q["id"].to_numpy(), q["idx"], q["val"], q["limit"]):
        rows, d2, n = postings.nearest(key, idx, val, limit, k, exclude_self)
        pairs += n
        found.append(pd.DataFrame({"id": [key] * len(rows), "neighbor": postings.ids[rows], "d2": d2}))
    return pd.concat(found, ignore_index=True), pairs


def _in_unit(k: int, exclude_self: bool, sparse: bool, pairs):
    """The k nearest base rows of every query that visits a unit."""

    def tables(q: pa.Table, s: pa.Table) -> pa.Table:
        if len(q) and len(s):
            rows = s.to_pandas().sort_values("id", ignore_index=True)  # position order is then key order
            found, n = (_by_postings if sparse else _tiles)(q.to_pandas(), rows, k, exclude_self)
            pairs.add(n)
        else:
            found = pd.DataFrame({"id": [], "neighbor": [], "d2": []})
        types = (q.schema.field("id").type, s.schema.field("id").type, pa.float64())
        columns = [pa.array(found[c].tolist(), t) for c, t in zip(("id", "neighbor", "d2"), types)]
        return pa.Table.from_arrays(columns, names=["id", "neighbor", "d2"])

    return tables


class Pivots:
    """Pivot vectors as a matrix over the dimensions that they use."""

    def __init__(self, rows: list[tuple]):
        self.sparse = rows[0][0] is not None
        if self.sparse:
            self.dims = np.unique(np.concatenate([np.asarray(i, np.int64) for i, _ in rows]))
            self.matrix = np.zeros((len(self.dims), len(rows)))
            for c, (idx, val) in enumerate(rows):
                self.matrix[np.searchsorted(self.dims, idx), c] = val
        else:
            width = max(len(v) for _, v in rows)
            self.matrix = np.array([[*v] + [0.0] * (width - len(v)) for _, v in rows]).T.reshape(width, len(rows))
        self.square = (self.matrix**2).sum(0)
        apart = self.square[:, None] + self.square[None, :] - 2.0 * (self.matrix.T @ self.matrix)
        self.apart = np.sqrt(np.maximum(apart, 0.0))

    def distances(self, idx: list, val: list) -> np.ndarray:
        """Distance of every row to every pivot."""
        dots = np.zeros((len(val), self.matrix.shape[1]))
        for r, (i, v) in enumerate(zip(idx, val)):
            if self.sparse:
                i = np.asarray(i, np.int64)
                at = np.searchsorted(self.dims, i)
                known = self.dims[np.minimum(at, len(self.dims) - 1)] == i if len(self.dims) else np.zeros(len(i), bool)
                dots[r] = v[known] @ self.matrix[at[known]]
            else:
                n = min(len(v), len(self.matrix))
                dots[r] = v[:n] @ self.matrix[:n]
        square = np.array([v @ v for v in val])
        return np.sqrt(np.maximum(square[:, None] + self.square[None, :] - 2.0 * dots, 0.0))


def _assign(sent):
    """Adds each row's cell, its distance to the pivot, and its norm."""

    def run(batches):
        for batch in batches:
            idx, val = (batch.column(c).to_pandas().tolist() for c in (2, 3))
            far = sent.value.distances(idx, val)
            cell = far.argmin(1)
            norm = np.sqrt([v @ v for v in val])
            columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(cell)), cell]), pa.array(norm)]
            yield pa.record_batch(columns, names=["part", "id", "idx", "val", "cell", "far", "norm"])

    return run


@dataclass
class Units:
    """What queries need to choose units: one entry per unit."""

    pivots: Pivots
    part: np.ndarray
    cell: np.ndarray
    rows: np.ndarray
    least: np.ndarray  # distance to the pivot
    most: np.ndarray
    low: np.ndarray  # norm
    high: np.ndarray
    terms: np.ndarray | None = None  # sparse: terms, and the greatest weight of each in every cell
    weights: np.ndarray | None = None
    row_of: np.ndarray | None = None  # a unit's row of the weights

    def bounds(self, idx: list, val: list) -> np.ndarray:
        """Lower bounds of the squared distances of every row to the base rows of every unit."""
        far = self.pivots.distances(idx, val)
        norm = np.sqrt([v @ v for v in val])
        own = far[:, self.cell]
        margin = 1e-7 * (1.0 + norm[:, None] + self.high[None, :])
        low = np.maximum(own - self.most, self.least - own)
        low = np.maximum(low, np.maximum(self.low - norm[:, None], norm[:, None] - self.high))
        near = far.argmin(1)
        apart = self.pivots.apart[near][:, self.cell]
        square_gap = own**2 - far[np.arange(len(near)), near][:, None] ** 2
        plane = np.divide(square_gap, 2.0 * apart, out=np.zeros_like(own), where=apart > 1e-6)
        low = np.maximum(np.maximum(low, plane) - margin, 0.0) ** 2
        if self.terms is not None:
            for r, (i, v) in enumerate(zip(idx, val)):
                i = np.asarray(i, np.int64)
                at = np.searchsorted(self.terms, i)
                known = self.terms[np.minimum(at, len(self.terms) - 1)] == i if len(self.terms) else np.zeros(len(i), bool)
                dot = (self.weights[:, at[known]] @ np.abs(v[known]))[self.row_of]
                low[r] = np.maximum(low[r], norm[r] ** 2 + self.low**2 - 2.0 * dot - margin[r])
        return low


def _route(sent, k: int, first: bool):
    """Copies of each query for the units that it visits. The first round takes the units with the least
    bounds until they hold k rows besides the query's own; the second all others within the limit."""

    def run(batches):
        for batch in batches:
            units: Units = sent.value
            part = np.array(batch.column(0).to_pylist(), object)
            idx, val = (batch.column(c).to_pandas().tolist() for c in (2, 3))
            limit = batch.column(4).to_numpy(zero_copy_only=False)
            rows, chosen = [], []
            for label in set(part.tolist()):
                own = np.flatnonzero(units.part == label)
                mine = np.flatnonzero(part == label)
                if not len(own):
                    continue
                bounds = units.bounds([idx[r] for r in mine], [val[r] for r in mine])[:, own]
                order = np.argsort(bounds, axis=1, kind="stable")
                held = np.cumsum(units.rows[own][order], axis=1)
                early = np.zeros(bounds.shape, bool)
                np.put_along_axis(early, order, held - units.rows[own][order] < k + 1, 1)
                take = early if first else ~early & (bounds <= limit[mine][:, None])
                r, c = np.nonzero(take)
                rows.append(mine[r])
                chosen.append(own[c])
            if rows:
                rows, chosen = np.concatenate(rows), np.concatenate(chosen)
                for lo in range(0, len(rows), len(batch)):
                    some = rows[lo : lo + len(batch)]
                    copies = batch.take(pa.array(some))
                    yield pa.record_batch([*copies.columns[1:], pa.array(chosen[lo : lo + len(batch)].astype(np.int32))], names=["id", "idx", "val", "limit", "unit"])

    return run


@dataclass
class NeighborIndex:
    """Base rows by unit, and what is known of the units. ``pairs`` counts measured pairs, ``visits`` the
    copies of queries that were sent (both for tests and tuning)."""

    rows: DataFrame  # unit, id, idx, val
    units: Units | None
    key: str
    vec: str
    within: str | None
    k: int
    id_type: T.DataType
    sparse: bool

    def __post_init__(self):
        context = self.rows.sparkSession.sparkContext
        self.sent = context.broadcast(self.units)
        self.pairs, self.visits = context.accumulator(0), 0

    def _visit(self, queries: DataFrame, schema: T.StructType, k: int, exclude_self: bool, first: bool) -> DataFrame:
        kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.schema if f.name != "part")
        visits = materialize(queries.mapInArrow(_route(self.sent, k, first), f"{kept}, unit int"), "knn-visits")
        crowds = visits.groupBy("unit").count().select("unit", F.ceil(F.col("count") / QUERY_ROWS).cast("int").alias("salts"), "count")
        crowds = crowds.collect()  # at most one row per unit
        self.visits += sum(r["count"] for r in crowds)
        salts = self.rows.sparkSession.createDataFrame([(r.unit, r.salts) for r in crowds], "unit int, salts int")
        salts = F.broadcast(salts)
        q = visits.join(salts, "unit").withColumn("salt", F.pmod(F.xxhash64("id", F.lit(3)), "salts").cast("int"))
        s = self.rows.join(salts, "unit").select("unit", "id", "idx", "val", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        by = ["unit", "salt"]
        return (
            q.select(*by, "id", "idx", "val", "limit").groupBy(*by)
            .cogroup(s.groupBy(*by))
            .applyInArrow(_in_unit(k, exclude_self, self.sparse, self.pairs), schema)
        )

    def search(self, queries: DataFrame, k: int | None = None, *, exclude_self: bool = False) -> DataFrame:
        """``<key>, neighbor, d2, rank`` of the k nearest base rows of every query row."""
        k = k or self.k
        if k > self.k:
            raise ValueError(f"the index was built for {self.k} neighbours")
        id_type = queries.schema[self.key].dataType
        schema = T.StructType([T.StructField("id", id_type), T.StructField("neighbor", self.id_type), T.StructField("d2", T.DoubleType())])
        order = Window.partitionBy("id").orderBy("d2", "neighbor")

        def best(near: DataFrame) -> DataFrame:
            return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

        if self.units is None:
            return best(queries.sparkSession.createDataFrame([], schema)).withColumnRenamed("id", self.key)
        q = _rows(queries, self.key, self.vec, self.within).filter("val IS NOT NULL")
        q = materialize(q.withColumn("limit", F.lit(float("inf"))), "knn-queries")
        near = materialize(best(self._visit(q, schema, k, exclude_self, True)), "knn-first")
        if len(self.units.cell) > 1:
            limits = near.filter(F.col("rank") == k).select("id", (F.col("d2") * (1 + 1e-9) + 1e-9).alias("d"))
            known = q.drop("limit").join(limits, "id", "left").select("part", "id", "idx", "val", F.coalesce("d", F.lit(float("inf"))).alias("limit"))
            more = self._visit(known, schema, k, exclude_self, False)
            near = best(near.drop("rank").unionByName(more))
        return near.withColumnRenamed("id", self.key)


def build_index(base: DataFrame, k: int = 5, *, key: str = "id", vec: str = "features", within: str | None = None, cells: int | None = None) -> NeighborIndex:
    """An index of ``base`` for searches of up to ``k`` neighbours.

    ``within`` restricts neighbours to the same value; its values and at most ``MAX_PIVOTS`` pivots are known to
    the driver. ``cells`` sets the number of pivots.
    """
    spark, sparse = base.sparkSession, _is_vector(base, vec)
    rows = _first_copies(_rows(base, key, vec, within).filter("val IS NOT NULL"), k)
    rows = materialize(rows, "knn-base")
    facts = rows.agg(F.count(F.lit(1)), F.sum(F.size("val").cast("long")), F.max(F.array_max("idx") if sparse else F.size("val"))).first()
    n, numbers, width = facts[0], facts[1] or 0, (facts[2] or 0) + 1
    made = {"key": key, "vec": vec, "within": within, "k": k, "id_type": base.schema[key].dataType, "sparse": sparse}
    if n == 0:
        return NeighborIndex(rows=rows, units=None, **made)
    aim = CELL_NUMBERS if sparse else max(CELL_NUMBERS, min(TILE_CELLS, math.ceil(numbers / DENSE_CELLS)))
    wanted = cells or math.ceil(numbers / aim)
    wanted = max(1, min(wanted, MAX_PIVOTS, PIVOT_NUMBERS // width or 1, n))
    chosen = first_rows(rows.select("id", "idx", "val"), "id", wanted).collect()
    pivots = Pivots([(None if r.idx is None else r.idx, r.val) for r in chosen])
    sent = spark.sparkContext.broadcast(pivots)
    kept = f"part string, id {base.schema[key].dataType.simpleString()}, idx array<int>, val array<double>"
    assigned = rows.select("part", "id", "idx", "val").mapInArrow(_assign(sent), f"{kept}, cell int, far double, norm double")
    assigned = materialize(assigned, "knn-cells")
    most = max(1, TILE_CELLS * n // max(1, numbers), n // MAX_UNITS)  # rows of a unit
    sizes = assigned.groupBy("part", "cell").agg(
        F.count(F.lit(1)).alias("rows"), F.min("far").alias("least"), F.max("far").alias("most"), F.min("norm").alias("low"), F.max("norm").alias("high")
    ).orderBy("part", "cell").collect()
    first, named = [], []
    for r in sizes:
        n_units = math.ceil(r.rows / most)
        first.append((r.part, r.cell, len(named), n_units))
        named += [(r, len(first) - 1)] * n_units
    terms = weights = None
    if sparse:
        entries = assigned.select("part", "cell", F.inline(F.arrays_zip(F.col("idx").alias("t"), F.col("val").alias("w"))))
        greatest = entries.groupBy("part", "cell", "t").agg(F.max(F.abs("w")).alias("w")).collect()
        place = {(p, c): i for i, (p, c, _, _) in enumerate(first)}
        terms = np.unique([r.t for r in greatest]).astype(np.int64)
        weights = np.zeros((len(first), len(terms)))
        at = np.searchsorted(terms, [r.t for r in greatest])
        weights[[place[r.part, r.cell] for r in greatest], at] = [r.w for r in greatest]
    column = lambda name: np.array([r[name] for r, _ in named])
    units = Units(
        pivots, np.array([r.part for r, _ in named], object), column("cell"),
        np.array([math.ceil(r.rows / math.ceil(r.rows / most)) for r, _ in named]),
        column("least"), column("most"), column("low"), column("high"), terms, weights, np.array([i for _, i in named]),
    )
    places = F.broadcast(spark.createDataFrame(first, "part string, cell int, unit int, units int"))
    in_units = assigned.join(places, ["part", "cell"]).select(
        (F.col("unit") + F.pmod(F.xxhash64("id", F.lit(11)), F.col("units"))).cast("int").alias("unit"), "id", "idx", "val"
    )
    return NeighborIndex(rows=in_units, units=units, **made)


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int = 5,
    *,
    key: str = "id",
    vec: str = "features",
    within: str | None = None,
    exclude_self: bool = False,
    cells: int | None = None,
) -> DataFrame:
    """``<key>, neighbor, d2, rank``: the k nearest base rows of every query row.

    Squared Euclidean distance, ties by neighbour key. ``exclude_self`` is for a table joined to
    itself: the base row with the query row's key is then not its neighbour. ``within`` restricts
    neighbours to the same value. ``cells`` sets the number of pivots of the index.
    """
    index = build_index(base, k, key=key, vec=vec, within=within, cells=cells)
    return index.search(queries, k, exclude_self=exclude_self)


def knn_votes(neighbors: DataFrame, base: DataFrame, key: str, label: str) -> DataFrame:
    """``<key>, label, votes, share`` from a neighbour table."""
    names = base.select(F.col(key).alias("neighbor"), F.col(label).alias("label"))
    voted = neighbors.join(names, "neighbor").groupBy(key, "label").agg(
        F.count(F.lit(1)).alias("votes")
    )
    total = F.sum("votes").over(Window.partitionBy(key))
    return voted.withColumn("share", F.col("votes") / total)


def knn_classify(
    queries: DataFrame,
    base: DataFrame,
    k: int = 5,
    *,
    key: str = "id",
    vec: str = "features",
    label: str = "label",
    exclude_self: bool = False,
) -> DataFrame:
    """``<key>, prediction, votes``: majority label, the smallest label wins a tie."""
    near = knn_join(queries, base, k, key=key, vec=vec, exclude_self=exclude_self)
    votes = knn_votes(near, base, key, label)
    best = F.min(F.struct((-F.col("votes")).alias("v"), F.col("label").alias("label")))
    return (
        votes.groupBy(key)
        .agg(best.alias("b"))
        .select(key, F.col("b.label").alias("prediction"), (-F.col("b.v")).alias("votes"))
    )
