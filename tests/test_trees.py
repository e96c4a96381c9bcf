"""Trees against plain Python: every split is looked for among all features and midpoints."""

import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textforge.operators import models as M
from textforge.operators import trees as T


def _soft(g, l1):
    return math.copysign(max(abs(g) - l1, 0.0), g)


def _brute_value(rows, stats, rule):
    s = [sum(stats[r][c] for r in rows) for c in range(len(stats[0]))]
    if rule.newton:
        return _soft(s[0], rule.l1) ** 2 / (s[1] + rule.l2), [-_soft(s[0], rule.l1) / (s[1] + rule.l2)]
    return sum(x * x for x in s) / sum(s), [x / sum(s) for x in s]


def _brute_split(x, rows, stats, rule):
    best = None
    for f in range(len(x[0])):
        values = sorted({x[r][f] for r in rows})
        for a, b in zip(values, values[1:]):
            low = [r for r in rows if x[r][f] <= (a + b) / 2]
            high = [r for r in rows if x[r][f] > (a + b) / 2]
            if min(len(low), len(high)) < rule.min_leaf:
                continue
            if rule.newton and min(sum(stats[r][1] for r in p) for p in (low, high)) < rule.min_hessian:
                continue
            gain = _brute_value(low, stats, rule)[0] + _brute_value(high, stats, rule)[0] - _brute_value(rows, stats, rule)[0]
            if (best is None or gain > best[0] + 1e-12) and (not rule.newton or gain > 1e-10):
                best = gain, low, high
    return best


def _brute_tree(x, stats, rule):
    """The value of every row's leaf."""
    leaves = [(list(range(len(x))), 0)]

    def split(rows, depth):
        pure = not rule.newton and sum(any(stats[r][c] for r in rows) for c in range(len(stats[0]))) < 2
        if pure or len(rows) < max(rule.min_split, 2 * rule.min_leaf) or rule.max_depth is not None and depth >= rule.max_depth:
            return None
        return _brute_split(x, rows, stats, rule)

    found = [split(*leaves[0])]
    while any(found) and (rule.leaves is None or len(leaves) < rule.leaves):
        i = max((i for i, f in enumerate(found) if f), key=lambda i: found[i][0])
        _, depth = leaves.pop(i)
        _, low, high = found.pop(i)
        for part in (low, high):
            leaves.append((part, depth + 1))
            found.append(split(part, depth + 1))
    out = [None] * len(x)
    for rows, _ in leaves:
        value = _brute_value(rows, stats, rule)[1]
        for r in rows:
            out[r] = value
    return np.array(out)


def _cells(n, width, seed):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((n, width)) < 0.5, rng.integers(-3, 9, (n, width)), 0).astype(float)
    y = ((x[:, 0] > 2).astype(int) + (x[:, 1] + x[:, 2] > 4)) % 3
    y = np.where(rng.random(n) < 0.15, rng.integers(0, 3, n), y)
    return x, y


def _sparse(x):
    return T.Sparse([np.flatnonzero(r) for r in x], [r[r != 0] for r in x])


RULES = [
    T.Rule(),
    T.Rule(max_depth=3, min_split=9, min_leaf=4),
    T.Rule(newton=True, max_depth=4, min_hessian=1.0, l2=1.0),
    T.Rule(newton=True, leaves=7, min_leaf=5, l1=0.1, max_depth=20),
    T.Rule(newton=True, leaves=31, min_leaf=2, l1=0.7, l2=0.5),
]


@pytest.mark.parametrize("rule", RULES, ids=str)
def test_grower_equals_brute_force(rule):
    for seed in range(3):
        x, y = _cells(200, 6, seed)
        rng = np.random.default_rng(seed)
        if rule.newton:
            stats = np.stack([rng.normal(size=200) + (y - 1), rng.random(200) + 0.05], 1)
        else:
            stats = (y[:, None] == np.arange(3)) * (rng.integers(1, 50, 200) / 8 + rng.random(200))[:, None]
        tree, leaf = T.grow(_sparse(x), np.arange(200), stats, rule, rng)
        got = np.array(tree.value)[leaf]
        assert got == pytest.approx(_brute_tree(x.tolist(), stats.tolist(), rule), abs=1e-9)
        assert (tree.leaves_of(_sparse(x)) == leaf).all()
        if rule.leaves:
            assert sum(f < 0 for f in tree.feature) <= rule.leaves


def _frame(spark, x, y):
    rows = [(f"k{i}", float(c), Vectors.sparse(x.shape[1], {int(j): float(v[j]) for j in np.flatnonzero(v)})) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["key", "label", "features"])


def _shares(model, df):
    return {r.key: list(r.probability) for r in model.score(df).collect()}


def _brute_boost(x, y, k, rounds, rule, rate, curvature):
    margins = np.zeros((len(x), k))
    for _ in range(rounds):
        e = np.exp(margins)
        p = e / e.sum(1, keepdims=True)
        for c in range(k):
            stats = np.stack([p[:, c] - (y == c), np.maximum(curvature * p[:, c] * (1 - p[:, c]), 1e-16)], 1)
            margins[:, c] += rate * _brute_tree(x.tolist(), stats.tolist(), rule)[:, 0]
    e = np.exp(margins)
    return e / e.sum(1, keepdims=True)


def test_boosting_of_all_classes_equals_brute_force(spark):
    x, y = _cells(80, 4, 5)
    spec = M.ModelSpec("b", "boosted_trees", {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.3})
    df = _frame(spark, x, y)
    model = M.fit_model(df, spec, 3)
    got = _shares(model, df)
    want = _brute_boost(x, y, 3, 3, T.Rule(newton=True, max_depth=2, min_hessian=1.0, l2=1.0), 0.3, 2.0)
    assert np.array([got[f"k{i}"] for i in range(80)]) == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("params", [
    {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3},
    {"n_estimators": 2, "max_depth": 20, "num_leaves": 40, "min_child_samples": 3, "reg_alpha": 0.1, "class_weight": "balanced"},
])
def test_boosting_over_the_cluster_equals_one_task(spark, params, monkeypatch):
    x, y = _cells(300, 4, 6)
    df = _frame(spark, x, y).repartition(3)
    spec = M.ModelSpec("b", "boosted_trees", params)
    whole = _shares(M.fit_model(df, spec, 3), df)
    monkeypatch.setattr(T, "LOCAL_ROWS", 40)
    apart = _shares(M.fit_model(df, spec, 3), df)
    if "num_leaves" not in params:  # leaves are dealt to the small nodes, so best-first order may differ
        for key in whole:
            assert apart[key] == pytest.approx(whole[key], abs=1e-6)
    right = [np.argmax(apart[f"k{i}"]) == y[i] for i in range(300)]
    assert np.mean(right) > 0.55


def test_forest_over_the_cluster(spark, monkeypatch):
    x, y = _cells(300, 4, 7)
    df = _frame(spark, x, y).repartition(3)
    every = T.Rule(max_depth=6, min_split=5)  # all features: nothing is drawn but rows
    job = lambda: T.Job(df.withColumn("weight", F.lit(1.0)), "random_forest", 3, 4, every)
    whole = _shares(T.fit_trees([job()])[0], df)
    monkeypatch.setattr(T, "LOCAL_ROWS", 50)
    monkeypatch.setattr(T, "OPEN_BYTES", 1 << 12)
    apart = _shares(T.fit_trees([job()])[0], df)
    for key in whole:
        assert apart[key] == pytest.approx(whole[key], abs=1e-6)
    forest = M.fit_model(df, M.ModelSpec("f", "random_forest", {"n_estimators": 20, "max_depth": 8}), 3)
    shares = _shares(forest, df)
    assert np.mean([np.argmax(shares[f"k{i}"]) == y[i] for i in range(300)]) > 0.6


def test_deep_trees_and_exact_minimum_split(spark):
    n = 120  # each half of the axis has to be peeled off point by point
    x = np.arange(1, n + 1, dtype=float)[:, None]
    y = np.arange(n) % 2
    stats = (y[:, None] == np.arange(2)) * (1.0 + np.arange(n)[:, None] ** 3.0)
    tree, leaf = T.grow(_sparse(x), np.arange(n), stats, T.Rule(), np.random.default_rng(0))
    assert (np.array(tree.value)[leaf].argmax(1) == y).all()

    def depth(node):
        return 0 if tree.feature[node] < 0 else 1 + max(depth(tree.left[node]), depth(tree.right[node]))

    assert depth(0) > 30
    sizes = np.bincount(T.grow(_sparse(x), np.arange(n), stats, T.Rule(min_split=5), np.random.default_rng(0))[1])
    assert sizes.max() <= 4
    spec = M.ModelSpec("deep", "random_forest", {"n_estimators": 3, "max_depth": 50, "min_samples_split": 2})
    df = _frame(spark, x, y)
    assert len(_shares(M.fit_model(df, spec, 2), df)) == n


def test_nodes_draw_features_until_one_splits():
    x = np.zeros((40, 500))
    x[:20, 3] = 1.0
    y = np.arange(40) < 20
    stats = (y[:, None] == np.arange(2)) * 1.0
    for seed in range(5):
        tree, leaf = T.grow(_sparse(x), np.arange(40), stats, T.Rule(features=5, width=500), np.random.default_rng(seed))
        assert tree.feature[0] == 3 and (np.array(tree.value)[leaf].argmax(1) == y).all()


def test_draws_are_poisson_and_repeatable():
    hashes = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 200_000)
    a = T.draws(hashes, 3, 42)
    assert (a == T.draws(hashes, 3, 42)).all() and (a != T.draws(hashes, 4, 42)).any()
    assert abs(a.mean() - 1) < 0.02 and abs(a.var() - 1) < 0.03 and abs((a == 0).mean() - math.exp(-1)) < 0.01


def test_many_jobs_share_a_shuffle(spark):
    x, y = _cells(60, 4, 8)
    df = _frame(spark, x, y)
    specs = [M.ModelSpec(f"f{d}", "random_forest", {"n_estimators": 3, "max_depth": d}) for d in (1, 4)]
    specs.append(M.ModelSpec("b", "boosted_trees", {"n_estimators": 2}))
    together = M.fit_many([(df, s) for s in specs], 3)
    for model, spec in zip(together, specs):
        assert _shares(model, df) == _shares(M.fit_model(df, spec, 3), df)
    dense = df.select("key", "label", F.udf(lambda v: Vectors.dense(v.toArray()), df.schema["features"].dataType)("features").alias("features"))
    assert _shares(M.fit_model(dense, specs[1], 3), df) == _shares(together[1], df)


@pytest.mark.parametrize("rule", RULES, ids=str)
def test_positive_numbers_equal_brute_force(rule, monkeypatch):
    """Numbers above 0 take a shorter way to the best split, piece by piece."""
    monkeypatch.setattr(T, "PIECE", 64)
    x, y = _cells(200, 6, 4)
    x, rng = np.abs(x), np.random.default_rng(2)
    g = [rng.normal(size=200) + (y - 1), rng.random(200) + 0.05]
    stats = np.stack(g, 1) if rule.newton else (y[:, None] == np.arange(3)) * (rng.random(200) + 0.1)[:, None]
    rows = _sparse(x)
    tree, leaf = T.grow(rows, np.arange(200), stats, rule, rng)
    assert rows.positive and len(rows.pieces(rows.entries(np.arange(200)))) > 2
    assert np.array(tree.value)[leaf] == pytest.approx(_brute_tree(x.tolist(), stats.tolist(), rule), abs=1e-9)


def test_forest_nodes_read_their_own_features_only(monkeypatch):
    rng = np.random.default_rng(3)
    idx = [np.sort(rng.choice(2000, 30, replace=False)) for _ in range(1500)]
    rows, y = T.Sparse(idx, [rng.random(30) + 0.1 for _ in idx]), rng.integers(0, 2, 1500)
    read, split = [], T.choose_positive
    monkeypatch.setattr(T, "choose_positive", lambda f, *a: read.append(len(f)) or split(f, *a))
    T.grow(rows, np.arange(1500), (y[:, None] == np.arange(2)) * 1.0, T.Rule(max_depth=8, features=44, width=2000), rng)
    assert len(read) > 5 and max(read) < 0.1 * 1500 * 30


def test_large_forests_pass_over_drawn_features(spark, monkeypatch):
    """Many nodes share a pass, as only their random features are summed: one node a pass before."""
    rng = np.random.default_rng(13)
    x = np.where(rng.random((300, 400)) < 0.05, rng.integers(1, 9, (300, 400)), 0).astype(float)
    x[:, 7] = np.arange(300) % 2
    x[:, 8:30] = 0
    df = _frame(spark, x, np.arange(300) % 2).repartition(3)
    monkeypatch.setattr(T, "LOCAL_ROWS", 100)
    monkeypatch.setattr(T, "OPEN_BYTES", 1 << 17)
    calls, sums = [], T._node_split
    monkeypatch.setattr(T, "_node_split", lambda *a: calls.append(1) or sums(*a))
    shares = _shares(M.fit_model(df, M.ModelSpec("f", "random_forest", {"n_estimators": 6, "max_depth": 8}), 2), df)
    assert len(shares) == 300 and len(calls) < 12
    monkeypatch.setattr(T, "_drawn_sums", T._sums)  # sums over all features give the same trees
    assert shares == _shares(M.fit_model(df, M.ModelSpec("f", "random_forest", {"n_estimators": 6, "max_depth": 8}), 2), df)


def _not_over_cluster(*_):
    raise AssertionError("grown by passes over all rows for every level of a tree")


def test_large_boosting_goes_by_columns(spark, monkeypatch):
    """One job a level whatever the number of trees; before, each level shuffled its sums and each round wrote all rows."""
    for seed, sign in ((6, 1), (9, -1)):  # numbers of both signs, more of them above 0 or below
        x, y = _cells(300, 7, seed)
        df = _frame(spark, sign * x, y).repartition(3)
        weighted = df.withColumn("weight", 0.5 + F.abs(F.xxhash64("key")) % 1000 / 1000)  # no two splits are worth the same
        job = T.Job(weighted, "boosted_trees", 3, 3, T.Rule(newton=True, max_depth=4, min_hessian=1.0, l2=1.0), 0.3, 2.0)
        whole = _shares(T.fit_trees([job])[0], df)
        with monkeypatch.context() as m:
            m.setattr(T, "LOCAL_ROWS", 40)
            m.setattr(T, "COLUMN_NUMBERS", 1 << 9)  # several groups of features
            m.setattr(T, "_grow_over_cluster", _not_over_cluster)
            apart = _shares(T.fit_trees([job])[0], df)
        for key in whole:
            assert apart[key] == pytest.approx(whole[key], abs=1e-6)


@pytest.mark.parametrize("rule", [r for r in RULES if r.newton] + [T.Rule(newton=True), T.Rule(newton=True, min_leaf=9, min_hessian=2.0, l1=0.3)], ids=str)
def test_columns_split_each_node_as_one_task_does(rule, monkeypatch):
    for sign, at_once in ((1, 1 << 20), (-1, 30), (0, 60)):
        x, y = _cells(300, 6, 11)
        x, rng = np.abs(x) if sign == 0 else sign * x, np.random.default_rng(5)
        rows, node = _sparse(x), rng.integers(-1, 5, 300).astype(np.int16)
        stats = np.stack([rng.normal(size=300) + y - 1, rng.random(300) + 0.05])
        totals = np.array([[*stats[:, node == k].sum(1), (node == k).sum()] for k in range(5)])
        monkeypatch.setattr(T, "HISTOGRAM", at_once)
        own = T.Features.of_entries(rows.idx.astype(np.int32), rows.val, rows.row.astype(np.int32))
        found = {k: (gain, cut) for k, gain, cut in own.splits(node, stats, totals, rule)}
        right = own.right(node, [(k, *v) for k, v in found.items()], 5)
        rows.rank(6)
        counted = np.append(stats, np.ones((1, 300)), 0).T
        for k in range(5):
            at = rows.entries(np.flatnonzero(node == k))
            split = T.choose(rows.f[at], rows.v[at], counted[rows.r[at]], totals[k], rule)
            assert (split is None) == (k not in found)
            if split:
                assert found[k][0] == pytest.approx(split[0], abs=1e-9) and own.feature[found[k][1]] == split[1]
                high = x[:, split[1]] > split[2]
                assert (right[node == k] == high[node == k]).all()
                assert (right[node == k] == (x[:, split[1]] > own.threshold[found[k][1]])[node == k]).all()


def test_bins_hold_neighbouring_numbers_of_one_sign():
    rng = np.random.default_rng(4)
    f = rng.integers(0, 3, 2000)
    v = np.where(f == 0, rng.integers(1, 5, 2000), rng.normal(size=2000))
    r = rng.integers(0, 500, 2000)
    own = T.Features.of_entries(f.astype(np.int32), v, r.astype(np.int32))
    assert (np.bincount(own.feature, minlength=3) <= [4, 2 * T.BINS, 2 * T.BINS]).all()
    assert ((own.least > 0) == (own.most > 0)).all() and (own.least <= own.most).all()
    back = T.Features.of_row({n: c.as_py() for n, c in zip(("group", "bin", "row", "feature", "least", "most"), (c[0] for c in own.as_row(1).columns))})
    assert (back.bin == own.bin).all() and (back.threshold == own.threshold).all()
    order = np.argsort(r, kind="stable")
    assert (np.sort(v) == np.sort(v[order])).all() and (own.row[1:] >= own.row[:-1]).all()
    for k in range(len(own.feature)):  # a cut parts its bin from what is nearer to 0
        assert own.threshold[k] < own.least[k] if own.positive[k] else own.threshold[k] >= own.most[k]


def test_larger_jobs_over_the_cluster_as_before(spark, monkeypatch):
    """Jobs beyond what reads whole tables or columns."""
    monkeypatch.setattr(T, "TABLE_ROWS", 0)
    monkeypatch.setattr(T, "COLUMN_CELLS", 0)
    with monkeypatch.context() as m:
        test_forest_over_the_cluster(spark, m)
    with monkeypatch.context() as m:
        test_large_forests_pass_over_drawn_features(spark, m)
    with monkeypatch.context() as m:
        test_boosting_over_the_cluster_equals_one_task(spark, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3}, m)


def test_forests_of_many_rows_read_the_table(spark, monkeypatch):
    """Every task reads all rows, none are sent to it; before, each tree's rows were shuffled to its nodes."""
    x, y = _cells(300, 6, 12)
    df = _frame(spark, x, y).repartition(3)
    spec = M.ModelSpec("f", "random_forest", {"n_estimators": 12, "max_depth": 8})
    whole = _shares(M.fit_model(df, spec, 3), df)
    monkeypatch.setattr(T, "LOCAL_ROWS", 40)
    monkeypatch.setattr(T, "_grow_over_cluster", _not_over_cluster)
    shuffled, real = [], type(df).repartitionById
    monkeypatch.setattr(type(df), "repartitionById", lambda *a: shuffled.append(a) or real(*a))
    grown = T._grown_units

    def one_each(jobs, units, packed):
        assert packed and len(units) == 3
        run = grown(jobs, units, packed)

        def checked(batches):
            batches = list(batches)
            assert len({u for b in batches for u in b["unit"].to_pylist()}) < 2  # tasks side by side
            yield from run(batches)

        return checked

    monkeypatch.setattr(T, "_grown_units", one_each)
    assert _shares(M.fit_model(df, spec, 3), df) == whole and not shuffled


def test_small_jobs_have_a_task_each(spark, monkeypatch):
    """They met in tasks by the hashes of their numbers before, and waited for each other."""
    x, y = _cells(60, 4, 8)
    df = _frame(spark, x, y)
    specs = [M.ModelSpec(f"b{i}", "boosted_trees", {"n_estimators": 1}) for i in range(9)]
    specs.append(M.ModelSpec("f", "random_forest", {"n_estimators": 60, "max_depth": 2}))
    grown = T._grown_units

    def one_each(jobs, units):
        run = grown(jobs, units)

        def checked(batches):
            batches = list(batches)
            assert len({u for b in batches for u in b["unit"].to_pylist()}) == 1
            yield from run(batches)

        return checked

    monkeypatch.setattr(T, "_grown_units", one_each)
    models = M.fit_many([(df, s) for s in specs], 3)
    assert [len(m.model.trees) for m in models] == [3] * 9 + [60]


def test_driver_holds_no_trees_of_small_jobs(spark):
    """A sweep's forests were all kept on the driver before, an object per node and number."""
    x, y = _cells(200, 6, 14)
    df = _frame(spark, x, y)
    model = M.fit_model(df, M.ModelSpec("f", "random_forest", {"n_estimators": 4, "max_depth": 6}), 3).model
    assert not isinstance(model._trees, list)
    for tree in model.trees:
        n = len(tree.feature)
        sizes = [a.nbytes for a in (tree.feature, tree.threshold, tree.left, tree.right, tree.value)]
        assert n > 10 and sizes == [4 * n, 8 * n, 4 * n, 4 * n, 24 * n]
    held = model.held()
    assert _shares(held, df) == _shares(model, df) and isinstance(held._trees, list)
