"""Whitening against numpy on the exact grid."""

import numpy as np

from lawtrace.llm import queries, whitening


def brute(rows, k):
    """rows: (id, vector). Of those that take part: (id, grid vector); the fit list; n, sums, eigenvalues, eigenvectors, trace."""
    ok = [(i, tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in ok}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    y = np.array([[float(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    return ok, n, sums, values[::-1][:k], vectors[:, ::-1][:, :k], np.trace(y.T @ y / n)


def close(found, rows, k):
    ok, n, sums, values, vectors, trace = brute(rows, k)
    got = [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in found.collect()]
    assert sorted((str(g[0]), g[1]) for g in got) == sorted((str(i), c) for i, _ in ok for c in range(1, len(values) + 1))
    of = {i: np.array([n * a - s for a, s in zip(x, sums)], dtype=object) for i, x in ok}
    signs = {}
    for i, c, n_found, deviation, whitened, explained, error in got:
        off = of[i]
        assert n_found == n and deviation == int((off * off).sum()) and error < 1e-9
        assert abs(explained * trace / values[c - 1] - 1) < 1e-9
        want = float(off.astype(float) / n @ vectors[:, c - 1]) / values[c - 1] ** 0.5
        assert abs(abs(whitened) - abs(want)) < 1e-8
        if abs(want) > 1e-3:
            signs.setdefault(c, set()).add(whitened * want > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_whole_table(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()
    close(queries.op12_whitening(spark, small), [tuple(r) for r in rows], 16)


def test_odd_rows_copies_and_clashing_columns(spark, tmp_path):
    random = np.random.default_rng(3)
    good = [(i, [float(np.float32(x)) for x in random.normal(size=5) * [1, 2, 3, 4, 5]]) for i in range(400)]
    rows = good + [(1000 + i, good[0][1]) for i in range(300)] + [(5, good[5][1]), (None, good[8][1])]  # a third are copies of one
    odd = [(2000, None), (2001, []), (2002, [1.0, None, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 5), (2004, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (2005, [1.0, 2.0]), (2006, [1e30, 0.0, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows + odd], "vec_id long, embedding array<double>, idx int, x int, whitened double")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op12_whitening(spark, str(tmp_path))
    close(found, rows, 5)
    both = {r["vec_id"]: r["whitened"] for r in found.where("vec_id in (0, 1000, 1299) and component = 1").collect()}
    assert both[0] == both[1000] == both[1299]


def test_flat_single_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    flat = [(i, [float(i % 4), float(i % 4), 1.0]) for i in range(20)]
    found, model = whitening.whiten(spark.createDataFrame(flat, schema), k=16)
    assert model.n == 4 and all(len(r["whitened"]) == 1 for r in found.collect()) and model.error < 1e-9
    found, model = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema))
    assert model.n == 1 and sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in found.collect()) == [(1, 0, []), (2, 0, [])]
    found, model = whitening.whiten(spark.createDataFrame([], schema))
    assert model is None and found.collect() == []
    found, model = whitening.whiten(spark.createDataFrame([(i, [float(x) * 2**33 * (-1) ** i for x in (0.1, 0.9)]) for i in range(9)], schema))
    assert [r["deviation"] for r in found.collect()] == [None] * 9  # no long holds it


def test_blocks_do_not_change_the_result(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet")
    one, a = whitening.whiten(rows, k=3)
    two, b = whitening.whiten(rows, k=3, rows_per_block=64, cols_per_block=16)
    assert a.sums == b.sums and np.allclose(a.values, b.values, rtol=1e-12)
    x, y = ({r["vec_id"]: r["whitened"] for r in f.collect()} for f in (one, two))
    assert x.keys() == y.keys() and all(np.allclose(x[i], y[i], atol=1e-9) for i in x)
