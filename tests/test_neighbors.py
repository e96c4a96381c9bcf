import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.operators import neighbors as N
from textforge.operators import resample as R


def _cloud(n, dim, seed):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(6, dim)) * 8
    points = centers[rng.integers(0, 6, n)] + rng.normal(size=(n, dim))
    points[rng.random(n) < 0.33] = points[0]  # a third of the rows are one point
    return points.round(3)


def _brute(points, labels, k, within):
    out = {}
    for i in range(len(points)):
        d = ((points - points[i]) ** 2).sum(1)
        near = sorted((d[j], j) for j in range(len(points)) if j != i and (not within or labels[i] == labels[j]))
        out[i] = [j for _, j in near[:k]]
    return out


def _frame(spark, points, labels, sparse=False):
    if sparse:
        rows = [
            (i, Vectors.sparse(len(p), {j: float(x) for j, x in enumerate(p) if x}), int(c))
            for i, (p, c) in enumerate(zip(points, labels))
        ]
        kind = VectorUDT()
    else:
        rows = [(i, [float(x) for x in p], int(c)) for i, (p, c) in enumerate(zip(points, labels))]
        kind = T.ArrayType(T.DoubleType())
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("features", kind), T.StructField("label", T.IntegerType())]
    )
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("within", [None, "label"])
@pytest.mark.parametrize("cells, tile, sparse", [(None, 1 << 22, False), (7, 1 << 22, True), (20, 100, False)])
def test_exact_neighbors_with_a_hot_copy(spark, within, cells, tile, sparse, monkeypatch):
    monkeypatch.setattr(N, "TILE_CELLS", tile)
    monkeypatch.setattr(N, "QUERY_ROWS", 64)
    points = _cloud(400, 5, 1)
    labels = np.arange(400) % 3
    df = _frame(spark, points, labels, sparse)
    near = N.knn_join(df, df, 4, within=within, exclude_self=True, cells=cells)
    got = {}
    for r in near.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbor)
    assert got == _brute(points, labels, 4, within)


def test_copies_are_cut_before_the_shuffle(spark):
    rows = N._rows(_frame(spark, _cloud(50, 3, 5), np.zeros(50)), "id", "features", None)
    plan = N._first_copies(rows, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert "WindowGroupLimit" in plan


def test_far_cells_are_closed(spark):
    rng = np.random.default_rng(8)
    centers = rng.normal(size=(20, 8)) * 30
    points = centers[np.arange(2000) % 20] + rng.normal(size=(2000, 8))
    df = _frame(spark, points, np.zeros(2000))
    index = N.build_index(df, 3, cells=40)
    near = index.search(df, exclude_self=True)
    got = {r.id: r.neighbor for r in near.filter("rank = 1").collect()}
    d = ((points[:, None] - points[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    assert got == dict(enumerate(d.argmin(1).tolist()))
    assert index.visits < 2000 * 6 and index.pairs.value < 0.15 * 2000 * 2000
    again = index.search(df.filter("id < 50"), 1, exclude_self=True)  # built once, searched twice
    assert {r.id: r.neighbor for r in again.collect()} == {i: got[i] for i in range(50)}
    with pytest.raises(ValueError):
        index.search(df, 4)


def _texts(n, seed):
    """Weighted words of a Zipf vocabulary, by language; unit length, some rows empty."""
    rng = np.random.default_rng(seed)
    share = 1 / np.arange(1, 301)
    rows = []
    for i in range(n):
        words = np.unique(rng.choice(300, rng.integers(0, 60), p=share / share.sum())) + 300 * (i % 3)
        w = rng.random(len(words)) * np.log1p(words % 300)
        rows.append((i, Vectors.sparse(900, dict(zip(words.tolist(), (w / (np.linalg.norm(w) or 1)).tolist()))), 0))
    return rows


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_sparse_rows_by_postings(spark, sign):
    rows = _texts(600, 9)
    if sign < 0:  # weights of either sign, and of any length
        rows = [(i, Vectors.sparse(900, v.indices, v.values * (1 + i % 4) * np.where(v.indices % 2, 1, -1)), c) for i, v, c in rows]
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("features", VectorUDT()), T.StructField("label", T.IntegerType())])
    df = spark.createDataFrame(rows, schema)
    index = N.build_index(df, 5, cells=9)
    got = {}
    for r in index.search(df, exclude_self=True).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(round(r.d2, 9))
    points = np.array([v.toArray() for _, v, _ in rows])
    d = ((points[:, None] - points[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    empty = [i for i, v, _ in rows if not len(v.indices)]
    want = np.sort(d, axis=1)[:, :5].round(9)
    assert len(got) == 600 and len(empty) > 5
    for i in range(600):
        assert got[i] == pytest.approx(want[i].tolist(), abs=2e-9), i
    assert index.pairs.value < 0.25 * 600 * 600


def test_empty_sides(spark):
    df = _frame(spark, np.array([[0.0], [1.0]]), [0, 0])
    assert N.knn_join(df.limit(0), df, 2).count() == 0 and N.knn_join(df, df.limit(0), 2).count() == 0
    nothing = df.withColumn("features", F.lit(None).cast("array<double>"))
    assert N.knn_join(nothing, df, 2).count() == 0 and N.knn_join(df, nothing, 2).count() == 0


def test_keys_of_another_table_are_not_excluded(spark):
    base = _frame(spark, np.array([[0.0], [100.0]]), [0, 1]).withColumn("id", F.col("id") + 1)
    query = _frame(spark, np.array([[0.0]]), [0]).withColumn("id", F.lit(1).cast("bigint"))
    assert N.knn_join(query, base, 1).first().neighbor == 1
    assert N.knn_classify(query, base, 1).first().prediction == 0
    assert N.knn_join(query, base, 1, exclude_self=True).first().neighbor == 2


def test_bound_on_fitted_rows(spark):
    df = _frame(spark, _cloud(50, 3, 6), [0] * 40 + [1] * 10)
    assert N.first_rows(df, "id", 12).count() == 12 and N.first_rows(df, "id", None).count() == 50
    bounded = R.balanced(df, "smote", "id", "features", "label", max_fit_rows=30)
    assert bounded.filter("NOT key LIKE '%#%'").count() == 30


def test_sparse_equals_dense(spark):
    points = np.where(np.random.default_rng(3).random((60, 12)) < 0.3, 1.5, 0.0)
    labels = np.arange(60) % 2
    dense, sparse = _frame(spark, points, labels), _frame(spark, points, labels, sparse=True)
    a = N.knn_join(dense, dense, 3, exclude_self=True).orderBy("id", "rank").collect()
    b = N.knn_join(sparse, sparse, 3, exclude_self=True).orderBy("id", "rank").collect()
    assert a == b


def test_fewer_rows_than_neighbors(spark):
    df = _frame(spark, np.array([[0.0], [1.0], [5.0]]), [0, 0, 1])
    assert N.knn_join(df, df, 5, exclude_self=True).groupBy("id").count().filter("count <> 2").count() == 0
    inside = N.knn_join(df, df, 5, within="label", exclude_self=True).collect()
    assert sorted((r.id, r.neighbor) for r in inside) == [(0, 1), (1, 0)]


def test_votes_take_the_smallest_label_on_a_tie(spark):
    train = _frame(spark, np.array([[0.0], [2.0], [9.0]]), [2, 1, 0])
    query = _frame(spark, np.array([[1.0]]), [0]).withColumn("id", F.lit(99).cast("bigint"))
    row = N.knn_classify(query, train, 2).first()
    assert (row.prediction, row.votes) == (1, 1)


@pytest.mark.parametrize("sparse", [False, True])
def test_smote_rows_lie_between_a_row_and_its_neighbor(spark, sparse, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 3)  # copies of one row come from several tasks
    rng = np.random.default_rng(4)
    points = np.where(rng.random((60, 8)) < 0.5, rng.random((60, 8)), 0.0)
    labels = [0] * 52 + [1] * 8
    df = _frame(spark, points, labels, sparse)
    out = R.smote(df, "id", "features", "label", k=3).collect()
    made = [r for r in out if r.synthetic]
    assert sum(r.label == 1 for r in out) == 52 and len(out) == 104
    assert len({r.key for r in out}) == 104
    near = _brute(points[52:], [1] * 8, 3, False)
    for r in made:
        assert r.neighbor - 52 in near[r.base - 52]
        x = r.features.toArray() if sparse else np.array(r.features)
        want = points[r.base] + r.u * (points[r.neighbor] - points[r.base])
        assert x == pytest.approx(want)
        assert 0 <= r.u < 1


def test_synthetic_vectors_are_made_in_the_jvm(spark):
    points = np.where(np.random.default_rng(4).random((20, 8)) < 0.5, 1.0, 0.0)
    df = _frame(spark, points, [0] * 15 + [1] * 5, sparse=True)
    lines = R._between(df.select(F.col("features").alias("a"), F.col("features").alias("b"), F.lit(0.5).alias("u")), "a", "b", "u", "out")
    assert "Python" not in lines._jdf.queryExecution().executedPlan().toString()


def test_smote_leaves_a_single_row_class(spark):
    df = _frame(spark, np.array([[0.0], [1.0], [2.0]]), [0, 0, 1])
    assert R.smote(df, "id", "features", "label").count() == 3


def test_adasyn_prefers_rows_near_other_classes(spark):
    points = np.array([[float(i)] for i in range(20)] + [[19.4], [50.0], [51.0], [52.0], [53.0], [54.0], [55.0]])
    labels = [0] * 20 + [1] * 7
    df = _frame(spark, points, labels)
    weights = {r.id: r for r in R.adasyn_weights(df, "id", "features", "label").collect()}
    minority = {i: weights[i].copies for i in range(20, 27)}
    assert minority[20] == 13 and sum(minority.values()) == 13
    assert R.adasyn(df, "id", "features", "label").filter("synthetic").count() == 13


def test_editing_drops_rows_among_others(spark):
    points = np.array([[0.0], [0.1], [0.2], [0.3], [9.0], [9.1], [9.2], [9.3], [0.15]])
    labels = [0, 0, 0, 0, 1, 1, 1, 1, 1]
    df = _frame(spark, points, labels)
    kept = {r.id for r in R.edited_neighbors(df, "id", "features", "label").collect()}
    assert kept == {4, 5, 6, 7}


def test_balanced_names(spark):
    df = _frame(spark, np.array([[0.0], [1.0], [2.0], [7.0], [8.0]]), [0, 0, 0, 1, 1])
    assert R.balanced(df, "none", "id", "features", "label").count() == 5
    assert R.balanced(df, "undersample", "id", "features", "label").count() == 4
    assert R.balanced(df, "smote", "id", "features", "label").count() == 6
    with pytest.raises(ValueError):
        R.balanced(df, "other", "id", "features", "label")


def test_dense_cells_do_not_grow_in_number_with_the_table(spark, monkeypatch):
    """Every cell may get a copy of every query: 375 cells for these rows before."""
    monkeypatch.setattr(N, "CELL_NUMBERS", 64)
    points = np.random.default_rng(12).normal(size=(3000, 8))
    df = _frame(spark, points, np.zeros(3000))
    index = N.build_index(df, 3)
    got = {}
    for r in index.search(df, exclude_self=True).orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append(r.neighbor)
    assert len(index.units.cell) <= N.DENSE_CELLS and index.visits <= 3000 * N.DENSE_CELLS
    assert got == _brute(points, np.zeros(3000), 3, None)
