"""Best-first boosted trees against a brute-force grower that splits one leaf at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudspark.operators import boosting as bo
from fraudspark.sources import tables as tb

from .conftest import SMALL


def grow_by_hand(x, y, w, raw, b):
    """One tree as {path: (feature, threshold)} and {path: value}; paths are strings of L and R."""
    p = 1 / (1 + np.exp(-raw))
    g, h = w * (p - y), w * p * (1 - p)

    def best(rows, depth):
        if b.max_depth is not None and depth >= b.max_depth:
            return None
        found = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for a, c in zip(values, values[1:]):
                t = a + (c - a) / 2
                left = rows[x[rows, f] <= t]
                right = rows[x[rows, f] > t]
                if min(len(left), len(right)) < max(b.min_rows, 1) or min(h[left].sum(), h[right].sum()) < b.min_hessian:
                    continue
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + b.l2) for s in (left, right)) - g[rows].sum() ** 2 / (h[rows].sum() + b.l2)
                if gain > 1e-12 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, f, t, left, right)
        return found

    leaves = {"": (np.flatnonzero(w > 0), best(np.flatnonzero(w > 0), 0))}
    splits = {}
    while len(leaves) < (b.max_leaves or 1 << 30):
        open_ = {k: v for k, v in leaves.items() if v[1]}
        if not open_:
            break
        k = max(open_, key=lambda k: open_[k][1][0])
        gain, f, t, left, right = leaves.pop(k)[1]
        splits[k] = (f, t)
        leaves[k + "L"] = (left, best(left, len(k) + 1))
        leaves[k + "R"] = (right, best(right, len(k) + 1))
    return splits, {k: -b.learning_rate * g[r].sum() / (h[r].sum() + b.l2) for k, (r, _) in leaves.items()}, {k: r for k, (r, _) in leaves.items()}


def paths(tree):
    splits, values, todo = {}, {}, [(0, "")]
    while todo:
        n, k = todo.pop()
        if tree.left[n] < 0:
            values[k] = tree.value[n]
        else:
            splits[k] = (int(tree.feature[n]), float(tree.threshold[n]))
            todo += [(tree.left[n], k + "L"), (tree.right[n], k + "R")]
    return splits, values


def table(n=700, seed=1):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.integers(0, 40, n), np.round(r.normal(0, 1, n), 1), r.integers(0, 3, n), np.full(n, 7)]).astype(float)
    y = (r.random(n) < 1 / (1 + np.exp(-(x[:, 1] * 1.5 + (x[:, 0] > 25) * (x[:, 2] - 1) * 2)))).astype(float)
    return x, y, np.round(r.random(n) + 0.5, 3), (r.random(n) < 0.7).astype(float)


SPECS = [bo.Booster("leafwise", "w", 4, learning_rate=0.3, max_leaves=9, min_rows=20),
         bo.Booster("some_rows", "part", 3, learning_rate=0.2, max_leaves=30, min_rows=5, start=0.0),
         bo.Booster("levels", "w", 2, learning_rate=0.5, max_leaves=None, max_depth=3, min_rows=1, min_hessian=1.0, l2=1.0, start=0.0)]


@pytest.fixture(scope="module", params=[0, 150, 100_000], ids=["summed", "mixed", "in one task"])
def fitted(spark, request):
    x, y, w, part = table()
    df = spark.createDataFrame([(*map(float, a), float(b), float(c), float(d)) for a, b, c, d in zip(x, y, w, part)],
                               "f0 double, f1 double, f2 double, f3 double, y double, w double, part double").repartition(5)
    return df, bo.fit_boosters(df, ["f0", "f1", "f2", "f3"], "y", SPECS, write_every=2, local_rows=request.param)


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_trees_equal_brute_force(fitted, spec):
    x, y, w, part = table()
    weight = w if spec.weight == "w" else part
    got = fitted[1][spec.name]
    mean = (weight * y).sum() / weight.sum()
    raw = np.full(len(x), spec.start if spec.start is not None else np.log(mean / (1 - mean)))
    assert np.isclose(got.start, raw[0]) and len(got.trees) == spec.trees
    for tree in got.trees:
        splits, values, _ = grow_by_hand(x, y, weight, raw, spec)
        mine, leaves = paths(tree)
        assert {k: f for k, (f, _) in mine.items()} == {k: f for k, (f, _) in splits.items()}
        assert all(np.isclose(mine[k][1], t) for k, (_, t) in splits.items())
        assert leaves.keys() == values.keys() and all(np.isclose(leaves[k], v) for k, v in values.items())
        raw = raw + tree.value[tree.leaves(x, tree.threshold)]


def test_scores_saved_and_loaded(spark, fitted, tmp_path):
    df, models = fitted
    m = models["leafwise"]
    m.save(str(tmp_path / "m"), spark)
    again = bo.TreeEnsemble.load(spark, str(tmp_path / "m"))
    both = again.transform(m.transform(df, "own"), "loaded").select("own", "loaded", "f0", "f1", "f2", "f3").toPandas()
    assert (both["own"] == both["loaded"]).all()
    x = both[["f0", "f1", "f2", "f3"]].to_numpy()
    assert np.allclose(both["own"], 1 / (1 + np.exp(-m.raw(x))))
    counts = {r["feature"]: (r["splits"], r["gain"]) for r in bo.importance(spark.read.parquet(str(tmp_path / "m" / "nodes"))).collect()}
    walked = {}
    for t in m.trees:
        for n in np.flatnonzero(t.left >= 0):
            c = walked.setdefault(f"f{t.feature[n]}", [0, 0.0])
            c[0] += 1
            c[1] += t.gain[n]
    assert counts.keys() == walked.keys() and all(counts[k][0] == v[0] and np.isclose(counts[k][1], v[1]) for k, v in walked.items())


def test_many_values_missing_values_and_no_rows(spark):
    r = np.random.default_rng(2)
    rows = [(None if i % 10 == 0 else float("nan") if i % 11 == 0 else float(v), float(v > 0) if i % 13 else None) for i, v in enumerate(r.normal(0, 1, 4000))]
    df = spark.createDataFrame(rows, "a double, y double").withColumn("w", F.lit(1.0))
    spec = bo.Booster("m", "w", 3, learning_rate=0.5, max_leaves=4, min_rows=20)
    cuts = bo.bin_cuts(df, ["a"], 64)[0]
    assert len(cuts) <= 63 and np.all(np.diff(cuts) > 0)
    m = bo.fit_boosters(df, ["a"], "y", [spec], bins=64)["m"]
    got = {r["a"]: r["fraud_probability"] for r in m.transform(spark.createDataFrame([(-2.0,), (2.0,), (None,)], "a double")).collect()}
    assert got[2.0] > 0.8 > 0.2 > got[-2.0] and 0 < got[None] < 1
    none = bo.fit_boosters(df.where("false"), ["a"], "y", [spec])["m"]
    assert none.start == 0.0 and all(len(t.left) == 1 and t.value[0] == 0 for t in none.trees)
    one = bo.fit_boosters(df.where("y = 1"), ["a"], "y", [spec])["m"]
    assert one.transform(df.limit(5)).where("fraud_probability < 0.99").count() == 0


def test_fixture_is_learnt_better_than_chance(spark):
    t = tb.txn(spark, SMALL).select("isFraud", "V1", "V3", "C1", (F.col("p") + 0.3 * F.col("isFraud")).alias("hint")).withColumn("w", F.lit(1.0))
    m = bo.fit_boosters(t, ["V1", "V3", "C1", "hint"], "isFraud", [bo.Booster("m", "w", 5, learning_rate=0.3, max_leaves=8)])["m"]
    s = m.transform(t).groupBy("isFraud").agg(F.avg("fraud_probability").alias("p")).collect()
    by = {r["isFraud"]: r["p"] for r in s}
    assert by[1] > by[0] + 0.05


def test_long_chains_of_small_splits_take_one_pass_a_tree(spark, monkeypatch):
    """Labels without a pattern grow chains that cut off few rows at a time (a pass for each split before)."""
    df = spark.range(70_000).select((F.xxhash64("id", F.lit(7)) % 5 == 0).cast("double").alias("y"), F.lit(1.0).alias("w"),
                                    *[(F.xxhash64("id", F.lit(c)) % 1000).alias(f"f{c}") for c in range(3)])
    passes, one_pass = [], bo._pass
    monkeypatch.setattr(bo, "_pass", lambda *a: (passes.append(1), one_pass(*a))[1])
    m = bo.fit_boosters(df, ["f0", "f1", "f2"], "y", [bo.Booster("m", "w", 2)])["m"]
    assert len(passes) == 2 and all((t.left < 0).sum() == 63 for t in m.trees)


def test_trees_of_a_root_in_one_task_share_passes(spark, monkeypatch):
    """Eight trees take two passes (the first tree, then seven; eight before) and are those grown a pass each."""
    df = spark.range(3_000).select((F.xxhash64("id", F.lit(7)) % 5 == 0).cast("double").alias("y"), F.lit(1.0).alias("w"),
                                   *[(F.xxhash64("id", F.lit(c)) % 90).alias(f"f{c}") for c in range(3)]).coalesce(1)
    passes, one_pass = [], bo._pass
    monkeypatch.setattr(bo, "_pass", lambda *a: (passes.append(1), one_pass(*a))[1])
    spec = bo.Booster("m", "w", 8, max_leaves=12)
    together = bo.fit_boosters(df, ["f0", "f1", "f2"], "y", [spec])["m"]
    assert len(passes) == 2 and len(together.trees) == 8
    monkeypatch.setattr(bo, "LOCAL_TREES", 1)
    apart = bo.fit_boosters(df, ["f0", "f1", "f2"], "y", [spec])["m"]
    assert len(passes) == 10
    for a, b in zip(together.trees, apart.trees, strict=True):
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and np.allclose(a.value, b.value)


def test_path_of_a_node_holds_the_rows_that_reach_it(spark):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 9, (400, 3)).astype(np.uint8)
    g = rng.normal(size=400)
    nodes = bo.grow_rows(bins, g, np.ones(400), bo.Booster("m", "w", 1, max_leaves=20, min_rows=3), 0, 9)
    c = nodes.T
    tree = bo.Tree(np.maximum(c[0], 0).astype(int), c[1].astype(int), np.zeros(0), c[2].astype(int), c[3].astype(int), np.zeros(0), c[4], c[7])
    at = tree.leaves(bins, tree.bin)
    for k in np.flatnonzero(tree.left < 0):
        inside = np.ones(400, dtype=bool)
        for f, low, high in tree.path(int(k)):
            inside &= (bins[:, f] > low) & (bins[:, f] <= high)
        assert (inside == (at == k)).all() and inside.sum() == nodes[k][7]


def test_cuts_sketch_only_features_of_many_values(spark, monkeypatch):
    df = spark.range(3_000).selectExpr("cast(id as double) AS a", "cast(id % 5 as double) AS b")
    asked, sketch = [], F.percentile_approx
    monkeypatch.setattr(bo.F, "percentile_approx", lambda *a: (asked.append(a), sketch(*a))[1])
    cuts = bo.bin_cuts(df, ["b", "a"], 64)
    assert len(asked) == 1 and cuts[0].tolist() == [0.5, 1.5, 2.5, 3.5] and len(cuts[1]) == 63


def test_last_children_are_summed_in_one_feature(monkeypatch):
    """Nodes that are not split any more need their totals only (all features were summed before)."""
    rng = np.random.default_rng(3)
    bins, g, h = rng.integers(0, 9, (300, 3)).astype(np.uint8), rng.normal(size=300), rng.random(300)
    whole = bo.histogram(bins, g, h, 9)
    for f in range(3):
        for part, weights in enumerate((g, h, None)):
            assert (whole[part, 0, f] == np.bincount(bins[:, f], weights=weights, minlength=9)).all()
    monkeypatch.setattr(bo, "HISTOGRAM_CELLS", 1)       # a feature at a time
    assert (bo.histogram(bins, g, h, 9) == whole).all()
    seen, summed = [], bo.histogram
    monkeypatch.setattr(bo, "histogram", lambda x, *a: (seen.append(x.shape[1]), summed(x, *a))[1])
    for b, want in ((bo.Booster("m", "w", 1, max_leaves=None, max_depth=2, min_rows=1), [3, 3, 1, 1]),
                    (bo.Booster("m", "w", 1, max_leaves=4, min_rows=1), [3, 3, 3, 1])):
        seen.clear()
        nodes = bo.grow_rows(bins, g, h, b, 0, 9)
        assert seen == want and nodes[nodes[:, 2] < 0, 7].sum() == 300
