"""Distributed primitives against brute force, and invariants of the rows-only operators."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from fraudspark.operators import neighbours as nb
from fraudspark.operators import ordering as od
from fraudspark.operators import prune
from fraudspark.operators import resample as rs
from fraudspark.sources import tables as tb

from .conftest import MEDIUM, SMALL


def test_row_index_matches_row_number(spark):
    o = tb.read_table(spark, MEDIUM, "orders").select("o_orderkey", "o_orderdate")
    idx, n = od.with_row_index(o, ["o_orderdate", "o_orderkey"], partitions=7)
    got = idx.toPandas().sort_values("rn")
    ref = o.toPandas().sort_values(["o_orderdate", "o_orderkey"]).reset_index(drop=True)
    assert n == len(ref)
    assert list(got["o_orderkey"]) == list(ref["o_orderkey"])
    assert list(got["rn"]) == list(range(1, n + 1))


def test_prefix_sums_match_cumsum(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("double").alias("v"))
    out = od.prefix_sums(df, ["id"], ["v"], partitions=5).toPandas().sort_values("id")
    assert np.allclose(out["v_cum"], out["v"].cumsum())


def test_exact_quantiles_match_numpy(spark):
    t = tb.txn(spark, SMALL).select("isFraud", "TransactionAmt")
    q = od.exact_quantiles(t, "TransactionAmt", [0.25, 0.5, 0.95], ["isFraud"]).toPandas()
    pdf = t.toPandas()
    for _, r in q.iterrows():
        ref = pdf[pdf.isFraud == r["isFraud"]].TransactionAmt.quantile(r["q"])
        assert abs(ref - r["quantile"]) < 1e-9


def test_exact_quantiles_of_a_hot_value_and_a_null_group(spark):
    rows = [(None if i % 4 == 0 else i % 4, 0.5 if i % 5 else float(i)) for i in range(2000)]
    rows += [(9, None), (8, float("inf")), (8, float("inf"))]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {(r["g"], r["q"]): r["quantile"] for r in od.exact_quantiles(df, "v", [0.0, 0.3, 0.95, 1.0], ["g"]).collect()}
    assert {g for g, _ in got} == {None, 1, 2, 3, 8}            # a group without values has no row
    for (g, q), v in got.items():
        assert np.isclose(v, np.inf if g == 8 else np.quantile([b for a, b in rows if a == g], q))
    counted = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    again = {(r["g"], r["q"]): r["quantile"]
             for r in od.exact_quantiles(counted, "v", [0.0, 0.3, 0.95, 1.0], ["g"], weight="n").collect()}
    assert again == got
    assert od.exact_quantiles(df.where("false"), "v", [0.5]).count() == 0


def test_description_keeps_the_null_class(spark):
    from fraudspark.operators import explore as ex
    from fraudspark.operators import monitor as mo
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "isFraud int, TransactionAmt double")
    got = {r["isFraud"]: r for r in ex.describe_by_class(df).collect()}
    assert got[None]["p50"] == 2.0 and got[1]["p50"] == 5.0
    log = spark.createDataFrame([(None, 0.2, "APPROVE", 0), ("a", 0.8, "DECLINE", 1)],
                                "grp string, fraud_probability double, decision string, isFraud int")
    m = {r["grp"]: r["score_p95"] for r in mo.monitor_metrics(log, group_cols=["grp"]).collect()}
    assert m == {None: 0.2, "a": 0.8}


def test_split_and_folds_by_cut_keys(spark):
    from fraudspark.operators import split as sp
    df = spark.createDataFrame([(None if i == 3 else i // 3, 100 - i, "x" * i) for i in range(25)],
                               "TransactionDT long, TransactionID long, wide string")
    order = sorted(df.collect(), key=lambda r: (r["TransactionDT"] is not None, r["TransactionDT"] or 0, r["TransactionID"]))
    s, n = sp.time_split(df, folds=5)
    got = {r["TransactionID"]: (r["split"], r["fold"]) for r in s.collect()}
    assert n == 25
    for rn, r in enumerate(order, 1):
        want = "train" if rn <= 17 else "val" if rn <= 21 else "test"
        # 17 rows in five folds: 4, 4, 3, 3, 3
        fold = None if rn > 17 else 0 if rn <= 4 else 1 if rn <= 8 else 2 + (rn - 9) // 3
        assert got[r["TransactionID"]] == (want, fold)
    tail, start = sp.test_tail_positions(df)
    assert start == 21 and {r["TransactionID"]: r["rn"] for r in tail.collect()} == {
        r["TransactionID"]: i for i, r in enumerate(order, 1) if i > 21}
    few, _ = sp.time_split(df.limit(3), folds=5)               # folds may be empty
    assert few.where("split = 'train'").count() == 2
    assert sp.time_split(df.where("false"), folds=5)[0].count() == 0


def test_gram_correlation_matches_pandas(spark):
    t = tb.txn(spark, MEDIUM).select(*tb.V_COLUMNS)
    _same_correlations(t, tb.V_COLUMNS)


def test_gram_correlation_of_more_than_fifty_columns(spark):
    t = tb.txn(spark, SMALL)
    wide = t.select(*[(F.col(tb.V_COLUMNS[i % 6]) * (i + 1) + F.pmod(F.xxhash64("TransactionID", F.lit(i)), F.lit(97)))
                      .alias(f"V{i}") if i % 10 else F.when(F.col("TransactionID") % 3 > 0, F.col("V3")).alias(f"V{i}")
                      for i in range(60)])
    _same_correlations(wide, wide.columns)


def _same_correlations(t, cols):
    g = prune.corr_pairs(t, cols).toPandas()
    ref = t.toPandas().corr()
    assert len(g) == len(cols) * (len(cols) - 1) // 2
    for _, r in g.iterrows():
        expect = ref.loc[r["col_i"], r["col_j"]]
        if np.isnan(expect):
            assert r["r"] is None or np.isnan(r["r"])
        else:
            assert abs(expect - r["r"]) < 1e-9


def _knn_by_hand(ids, x, k):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    return {vid: [b for _, b in sorted((d[i, j], ids[j]) for j in range(len(ids)) if j != i)[:k]]
            for i, vid in enumerate(ids)}


def _same_neighbours(df, key, vec, k):
    got = rs.knn(df, key, vec, k).toPandas().sort_values([key, "rank"])
    pdf = df.toPandas()
    x = np.stack(pdf[vec].map(lambda v: np.asarray(v, dtype="float64")))
    want = _knn_by_hand(pdf[key].tolist(), x, k)
    mine = got.groupby(key)["neighbour"].apply(list).to_dict()
    assert mine == {i: w for i, w in want.items() if w}


def test_knn_exact_against_brute_force(spark):
    e = tb.read_table(spark, MEDIUM, "embeddings").where("label = 3").select("vec_id", "embedding")
    _same_neighbours(e, "vec_id", "embedding", 5)


def test_knn_of_uneven_and_equal_points(spark):
    rng = np.random.default_rng(5)
    schema = "i long, v array<double>"
    close = [(i, [i / 2 ** 23, 1.0]) for i in range(60)]                  # far below the others' spacing
    far = [(100 + i, [float(x) for x in rng.integers(-2 ** 20, 2 ** 20, 2)]) for i in range(39)]
    _same_neighbours(spark.createDataFrame(close + far, schema), "i", "v", 5)
    copies = [(i, [3.0, 4.0]) for i in range(50)] + [(50 + i, [3.0, 4.0 + i]) for i in range(8)]
    _same_neighbours(spark.createDataFrame(copies, schema), "i", "v", 5)
    equal = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(40)], schema)
    _same_neighbours(equal, "i", "v", 5)
    few = spark.createDataFrame([(1, [0.0, 0.0]), (2, [9.0, 1.0]), (3, [9.0, 1000.0])], schema)
    _same_neighbours(few, "i", "v", 5)
    _same_neighbours(few.limit(1), "i", "v", 5)
    assert rs.knn(few.where("false"), "i", "v").count() == 0


def test_knn_chunks_hold_what_their_vectors_fill(spark, monkeypatch):
    """600 queries of 4 numbers are one chunk (pivots counted as bytes of each query before: several)."""
    rng = np.random.default_rng(11)
    df = spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(600)], "i long, v array<double>")
    scans, scan = [], nb._scan
    monkeypatch.setattr(nb, "_scan", lambda *a: (scans.append(1), scan(*a))[1])
    knn = rs.knn(df, "i", "v", 5, 600 * 8 * (4 + 8)).collect()
    assert len(knn) == 3000 and len(scans) == 2
    _same_neighbours(df, "i", "v", 5)


def test_smote_balances_and_stays_on_segments(spark):
    rows = [(i, int(i % 5 == 0), float(i % 13), float((i * 7) % 11)) for i in range(200)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, a double, b double")
    out = rs.smote(df, ["a", "b"], "isFraud", "TransactionID", k=3).toPandas()
    counts = out.isFraud.value_counts()
    assert counts[0] == counts[1]
    syn = out[out.TransactionID < 0]
    mino = out[(out.TransactionID >= 0) & (out.isFraud == 1)][["a", "b"]].to_numpy()
    # every synthetic point lies on the segment from a minority row to one of its three neighbours
    near = _knn_by_hand(list(range(len(mino))), mino, 3)
    ends = np.array([(mino[i], mino[j]) for i, js in near.items() for j in js])
    base, step = ends[:, 0], ends[:, 1] - ends[:, 0]
    for p in syn[["a", "b"]].to_numpy():
        long = (step * step).sum(axis=1)
        t = np.clip(np.where(long > 0, ((p - base) * step).sum(axis=1) / np.where(long > 0, long, 1), 0), 0, 1)
        assert np.abs(base + t[:, None] * step - p).max(axis=1).min() < 1e-9
    assert len(pd.unique(syn.TransactionID)) == len(syn)
    marked = rs.smote(df, ["a", "b"], "isFraud", "TransactionID", k=3, marker="made").where("made <> (TransactionID < 0)")
    assert marked.count() == 0


def test_knn_of_a_dense_cluster_and_far_points_in_200_dimensions(spark, monkeypatch):
    from fraudspark.operators import neighbours as nb
    rng = np.random.default_rng(11)
    x = np.vstack([100 + rng.normal(0, 1e-3, (300, 200)), rng.normal(0, 50, (80, 200)), np.round(rng.normal(0, 1, (60, 200)))])
    x[5] = x[6]
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in enumerate(x)], "i long, v array<double>")
    _same_neighbours(df, "i", "v", 5)
    nodes = df.where("i <> 6").select(F.col("i").alias("_node"), F.col("v").alias("_x"))
    whole = {(r["_node"], r["_other"]): r["_dd"] for r in nb.node_neighbours(nodes, 4).collect()}
    monkeypatch.setattr(nb, "TILE", 3000)
    small = {(r["_node"], r["_other"]): r["_dd"] for r in nb.node_neighbours(nodes, 4, chunk_bytes=400_000, max_pivots=7).collect()}
    assert whole == small and len(whole) == 4 * 439


def _velocity_by_hand(pdf, seconds):
    counts, spend = [], []
    for r in pdf.itertuples():
        if pd.isna(r.card1) or pd.isna(r.TransactionDT):
            counts.append(None)
            spend.append(None)
            continue
        past = pdf[(pdf.card1 == r.card1) & (pdf.TransactionDT >= r.TransactionDT - seconds)
                   & (pdf.TransactionDT < r.TransactionDT)]
        counts.append(len(past))
        amounts = [0.0 if a is None else a for a in past.amt]
        spend.append(float(sum(amounts)))
    return counts, spend


def test_velocity_against_brute_force(spark):
    """Repeated and null ids, null and NaN amounts, null cards and times, a third of the rows in one
    (card, hour), negative times, and ranges that begin on a bucket border."""
    from fraudspark.operators import features as fe
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        hot = i % 3 == 0
        card = 1 if hot else (None if i % 17 == 0 else int(rng.integers(2, 6)))
        dt = int(rng.integers(7200, 10800)) if hot else int(rng.integers(-8000, 20000))
        amt = None if i % 13 == 0 else (float("nan") if i == 100 else float(i % 7) + 0.25)
        rows.append((None if i % 5 == 0 else i // 2, card, None if i % 41 == 0 else dt, amt))
    rows += [(9, 7, 0, 1.0), (9, 7, 3600, 2.0), (9, 7, 7200, 4.0), (9, 7, 7201, 8.0), (9, 7, 7201, 16.0)]
    schema = "TransactionID long, card1 long, TransactionDT long, TransactionAmt double, extra string"
    df = spark.createDataFrame([(*r, str(n)) for n, r in enumerate(rows)], schema)
    pdf = pd.DataFrame({"card1": [r[1] for r in rows], "TransactionDT": [r[2] for r in rows]}, dtype="Int64")
    pdf["amt"] = pd.Series([r[3] for r in rows], dtype=object)
    pdf = pdf.assign(card1=pdf.card1.astype("float64"), TransactionDT=pdf.TransactionDT.astype("float64"))
    for seconds in (3600, 86400):
        got = {int(r["extra"]): r for r in fe.add_point_in_time_velocity(df, seconds, "w").collect()}
        counts, spend = _velocity_by_hand(pdf, seconds)
        assert len(got) == len(rows)
        for i, (c, s) in enumerate(zip(counts, spend)):
            assert got[i]["card_count_w"] == c
            if s is None:
                assert got[i]["card_spend_w"] is None
            else:
                assert np.isclose(got[i]["card_spend_w"], s, equal_nan=True)


def test_velocity_refuses_fractional_times(spark):
    import pytest
    from fraudspark.operators import features as fe
    df = spark.createDataFrame([(1, 0.5, 1.0)], "card1 long, TransactionDT double, TransactionAmt double")
    with pytest.raises(TypeError):
        fe.add_point_in_time_velocity(df, 3600, "1h")


def test_grouped_prefix_sums_with_hot_key(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.col("id") % 11)
                                  .alias("k"), (F.col("id") % 5).cast("double").alias("v"))
    out = od.prefix_sums(df, ["id"], ["v"], partition_by=["k"], partitions=7).toPandas().sort_values(["k", "id"])
    assert np.allclose(out["v_cum"], out.groupby("k")["v"].cumsum())
