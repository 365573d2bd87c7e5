import duckdb
import numpy as np
import pytest

from gleanmill.llm import embedding_whitening as ew
from gleanmill.session import table
from tests.conftest import DATA

NAN, INF = float("nan"), float("inf")


def by_hand(x, k=4):
    """Values by a full eigendecomposition of the different rows of x; whole-number sums in Python."""
    once = np.array(sorted({tuple(map(int, r)) for r in x.tolist()}), float)
    centre = once.mean(0)
    values, vectors = np.linalg.eigh((once - centre).T @ (once - centre) / len(once))
    values, vectors = values[::-1], vectors[:, ::-1]
    sums = [int(v) for v in once.sum(0)]
    deviations = [sum((len(once) * int(a) - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    return len(once), deviations, (x - centre) @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def against(frame, ids, x, k=4):
    found = frame.toPandas().sort_values(["vec_id", "component"])
    n, deviations, whitened, explained = by_hand(x, k)
    assert found.vec_id.tolist() == np.repeat(ids, k).tolist() and found.component.tolist() == list(range(1, k + 1)) * len(ids)
    assert set(found.n) == {n} and found.deviation.tolist()[::k] == deviations
    got = found.whitened.to_numpy().reshape(-1, k)
    assert np.abs(got * np.sign((got * whitened).sum(0)) - whitened).max() < 1e-8
    assert np.abs(found.explained.to_numpy()[:k] - explained).max() < 1e-12 and found.identity_error.max() < 1e-10


def test_whole_table(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{DATA}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.floor(256 * np.array([r[1] for r in rows], float))
    against(ew.op13_embedding_whitening(spark, DATA), [r[0] for r in rows], x)
    assert ew.op13_embedding_whitening(spark, DATA).count() == 4 * table(spark, DATA, "embeddings").count()


def test_dropped_rows_repeats_and_other_columns(spark):
    r = np.random.default_rng(3)
    good = [[float(v) for v in row] for row in r.normal(size=(40, 6)).astype(np.float32)]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)] + [(100 + i, good[0], None, 2) for i in range(60)]  # one vector is most of the table
    bad = [None, [], [1.0] * 5 + [None], [1.0] * 5 + [NAN], [1.0] * 5 + [INF], [1.0] * 5, [1.0] * 7, [1e30] * 6]
    rows += [(200 + i, v, "y", 3) for i, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, n int").repartition(5)
    kept = [q for q in rows if q[0] < 200]
    against(ew.whitened(frame), [q[0] for q in kept], np.floor(256 * np.array([q[1] for q in kept])))
    nameless = spark.createDataFrame([(None, v) for v in good], "vec_id long, embedding array<float>")
    assert {q.vec_id for q in ew.whitened(nameless).collect()} == {None}


@pytest.mark.parametrize("rows, k", [([], 0), ([None, [NAN]], 0), ([[1.0, 2.0]] * 3, 2), ([[1.0, 2.0], [3.0, 5.0]], 2), ([[0.0] * 5], 4)])
def test_small_tables(spark, rows, k):
    found = ew.whitened(spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")).collect()
    assert len(found) == len(rows) * k if k else not found
    for r in found:
        rank = len({tuple(v) for v in rows}) - 1
        assert (r.whitened != 0) == (r.explained > 0) == (r.component <= rank) and r.identity_error < 1e-12


def test_deviations_beyond_64_bits(spark):
    rows = [(0, [1e9, 0.0]), (1, [-1e9, 5.0]), (2, [4.0, 1e15]), (3, [4.0, 2.0])]
    found = {(r.vec_id, r.component): r for r in ew.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(object)
    for i in range(4):
        exact = sum(int(4 * a - s) ** 2 for a, s in zip(x[i], x.sum(0), strict=True))
        assert found[i, 1].deviation == (exact if exact < 1 << 63 else None)
    assert np.isfinite([r.whitened for r in found.values()]).all()


@pytest.mark.parametrize("d, spectrum", [(64, "flat"), (300, "flat"), (300, "steep"), (300, "tied"), (7, "flat")])
def test_subspace_of_any_spectrum(d, spectrum):
    turn = np.linalg.qr(np.random.default_rng(5).normal(size=(d, d)))[0]
    values = {"flat": np.linspace(1.2, 1.0, d), "steep": 0.5 ** np.arange(d), "tied": np.r_[[3.0, 3.0, 2.0, 2.0], np.ones(d - 4)]}[spectrum]
    v = (turn * values) @ turn.T
    calls = []
    found = ew.subspace(lambda q: calls.append(q.shape[1]) or v @ q, d, 4, blocks=4)
    assert np.allclose(found.values, values[:4], rtol=1e-12) and max(calls) <= ew.BLOCK
    assert np.abs(v @ found.vectors - found.vectors * found.values).max() < 1e-10 and np.abs(found.vectors.T @ found.vectors - np.eye(4)).max() < 1e-12
    if spectrum != "tied":
        assert np.abs(np.abs((found.vectors * turn[:, :4]).sum(0)) - 1).max() < 1e-10
