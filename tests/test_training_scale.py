"""What the training job and the scored stream hold or cut as their tables grow."""

from __future__ import annotations

import threading
from types import SimpleNamespace

import numpy as np
import pytest

from fraudspark.operators import models as mdl
from fraudspark.operators import neighbours as nb
from fraudspark.plans import queries_models as qm
from fraudspark.plans.feature_model import FeaturePipeline
from fraudspark.plans.train import Prepared
from fraudspark.session import together
from fraudspark.sources import tables as tb
from fraudspark.streaming import jobs as sj

from .conftest import SMALL


def test_fitting_keeps_one_full_width_copy(spark, monkeypatch):
    t = tb.txn(spark, SMALL).drop("p").limit(500)
    kept, persist = [], type(t).persist
    monkeypatch.setattr(type(t), "persist", lambda self, *a: (kept.append(len(self.columns)), persist(self, *a))[1])
    model, x = FeaturePipeline(min_v_cols=5).fit_transform(t)
    assert len(kept) == 1
    assert model.dropped_v == ["V2", "V5"] and x.count() == 500


def test_scored_stream_files_follow_the_rows(spark, monkeypatch):
    asked, stream = [], sj.transaction_stream
    monkeypatch.setattr(sj, "transaction_stream", lambda s, src, schema, files, **k: (asked.append(files), stream(s, src, schema, files, **k))[1])
    monkeypatch.setattr(qm, "STREAM_FILE_ROWS", 200)
    n = tb.txn(spark, SMALL).count()
    assert qm.q_stream_score_model(spark, SMALL).count() == n
    assert asked == [2 * -(-n // 1200)]


def test_independent_fits_run_side_by_side(spark, monkeypatch):
    both = threading.Barrier(2, timeout=60)     # broken unless both fits are under way at once
    monkeypatch.setattr(mdl, "_fit_boosted", lambda *a: (both.wait(), {"gbt_a": "trees"})[1])
    monkeypatch.setattr(mdl, "_fit_pipeline", lambda *a: (both.wait(), "line")[1])
    rows = spark.createDataFrame([(1, 0.5)], "isFraud int, x double")
    found = mdl.fit_models(["logreg", "gbt_a"], rows, ["x"])
    assert list(found) == ["logreg", "gbt_a"] and found["logreg"].model == "line" and found["gbt_a"].model == "trees"
    assert together([lambda: 1, spark.range(3).count, lambda: 2]) == [1, 3, 2]


def test_a_chunk_of_queries_reads_few_cells(spark, monkeypatch):
    # 40 groups far from each other: a chunk's queries have neighbours in their own groups only
    r = np.random.default_rng(5)
    x = np.repeat(np.arange(40) * 1000.0, 100)[:, None] + r.normal(size=(4_000, 2))
    nodes = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x[r.permutation(4_000)])], "_node long, _x array<double>")
    read, scan = [], nb._scan

    def counted(points, *a):
        read.append(points.count())
        return scan(points, *a)

    monkeypatch.setattr(nb, "_scan", counted)
    got = {(k["_node"], k["_other"]): k["_dd"] for k in nb.node_neighbours(nodes, 3, chunk_bytes=8 * 10 * 400).collect()}
    assert len(got) == 12_000 and max(read) < 1_200 and max(got.values()) < 100


def test_model_queries_train_the_published_number_of_trees(spark, monkeypatch):
    """Every booster of the session's training job gets all of its trees (50 of 500 before)."""
    class Asked(Exception):
        pass

    def asked(rows, columns, label, boosters, **k):
        raise Asked({b.name: b.trees for b in boosters})

    rows = spark.createDataFrame([(i, int(i % 3 == 0), float(i)) for i in range(60)], "TransactionID long, isFraud int, x double")
    names = SimpleNamespace(feature_columns=["x"], label="isFraud", key="TransactionID")
    monkeypatch.setattr(qm, "_prepared", lambda *a: Prepared(names, rows, rows, rows))
    monkeypatch.setattr(qm, "_CACHE", {})
    monkeypatch.setattr(mdl, "fit_boosters", asked)
    monkeypatch.setattr(mdl, "_fit_pipeline", lambda *a: None)
    with pytest.raises(Asked) as found:
        qm.q_gbt_a(spark, SMALL)
    assert found.value.args[0] == dict.fromkeys(["gbt_a", "gbt_b", "fold_0", "fold_1", "fold_2"], 500)


def test_chunks_of_queries_are_answered_side_by_side(spark, monkeypatch):
    both, write = threading.Barrier(2, timeout=60), nb.materialize      # broken unless both chunks are under way at once
    monkeypatch.setattr(nb, "materialize", lambda df, name: (both.wait() if name == "knn_found" else 0, write(df, name))[1])
    x = np.random.default_rng(6).normal(size=(400, 2))
    nodes = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "_node long, _x array<double>")
    got = {(r["_node"], r["_other"]): r["_dd"] for r in nb.node_neighbours(nodes, 3, chunk_bytes=8 * 10 * 200).collect()}
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)) + np.diag(np.full(400, np.inf))
    want = {(i, int(j)): far[i, j] for i in range(400) for j in np.argsort(far[i])[:3]}
    assert got.keys() == want.keys() and all(np.isclose(got[k], d) for k, d in want.items())
