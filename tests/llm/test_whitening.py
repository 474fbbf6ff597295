import math

import numpy as np
import pytest

from parcelwise.llm import whitening
from parcelwise.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, count=32):
    """Per vector: deviation, projections; the shares; all with numpy's own decomposition."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(sum((n * c - t) ** 2 for c, t in zip(row, s))) for row in x]
    centred = np.array([[(n * c - t) / n for c, t in zip(row, s)] for row in x], float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:count]
    return deviation, centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def check(got, ids, vectors, close=1e-7):
    """Rows against numpy; components are compared up to their sign."""
    deviation, whitened, shares = plain(vectors)
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == whitened.size
    out = np.array([[table[i, k + 1].whitened for k in range(whitened.shape[1])] for i in ids])
    signs = np.sign((out * whitened).sum(axis=0))
    assert np.abs(out * signs - whitened).max() < close
    for at, i in enumerate(ids):
        for k in range(whitened.shape[1]):
            r = table[i, k + 1]
            assert r.n == len(ids) and r.deviation == deviation[at]
            assert abs(r.explained - shares[k]) <= 1e-10 * shares[k]
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    df = QUERIES["op11_spectral_whitening"](spark, folder)
    assert dict(df.dtypes) == {
        "vec_id": "bigint",
        "component": "int",
        "n": "bigint",
        "deviation": "bigint",
        "whitened": "double",
        "explained": "double",
        "identity_error": "double",
    }
    check(df.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def random_matrix(kind, size=40):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.standard_normal((size, size)))
    values = {
        "spread": np.sort(rng.random(size)) + 0.1,
        "graded": 10.0 ** -np.arange(0, 12, 12 / size),
        "equal": np.repeat([3.0, 1.0], size // 2),
        "one": np.append(np.ones(size - 1), 1e6),
        "low rank": np.append(np.zeros(size - 3), [1, 2, 3]),
        "identity": np.ones(size),
        "close": 1 + 1e-7 * np.arange(size),
    }[kind]
    return (q * values) @ q.T, np.sort(values)[::-1]


@pytest.mark.parametrize("kind", ["spread", "graded", "equal", "one", "low rank", "identity", "close"])
def test_components(kind):
    matrix, values = random_matrix(kind)
    found, vectors = whitening.components((matrix + matrix.T) / 2)
    scale = np.abs(values).max()
    assert np.abs(found - values).max() < 2e-14 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-14
    assert np.abs(matrix @ vectors - vectors * found).max() < 2e-13 * scale


def test_diagonal_and_tiny_matrices():
    assert whitening.components(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert whitening.components(np.array([[4.0]]))[0].tolist() == [4]
    assert whitening.components(np.diag([1.0, 3, 2]))[0].tolist() == [3, 2, 1]


def test_odd_rows(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(60)] + [(None, [0.1, 2.0, 3.0, 4.0, 5.0])]
    good += [(7, good[7][1])] * 3
    bad = [
        (101, None),
        (102, [1.0, None, 2.0, 3.0, 4.0]),
        (103, [float("nan")] * 5),
        (104, [float("inf")] * 5),
        (105, [-float("inf")] * 5),
        (106, [1.0, 2.0]),
        (107, []),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in good + bad], SCHEMA + ", component string, n int").repartition(4)
    got = whitening.whitened_rows(df).collect()
    assert len(got) == 5 * len(good)
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == list(range(60))
    known = [r for r in got if r.vec_id == 3]
    deviation, whitened, _ = plain([np.float32(v) for _, v in good])
    assert {r.deviation for r in known} == {deviation[3]}
    assert np.allclose([abs(r.whitened) for r in sorted(known, key=lambda r: r.component)], np.abs(whitened[3]), atol=1e-9)
    for few in (df.limit(0), df.where("vec_id = 7"), df.where("vec_id = 5"), df.where("vec_id > 100 and vec_id < 106")):
        assert whitening.whitened_rows(few).count() == 0


def test_a_constant_direction_is_no_component(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(i, [*rng.standard_normal(3).tolist(), 0.5]) for i in range(40)], SCHEMA)
    got = whitening.whitened_rows(df).collect()
    assert len(got) == 3 * 40 and got[0].identity_error < 1e-9


def test_too_large_entries_are_refused(spark):
    df = spark.createDataFrame([(1, [1e20, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    with pytest.raises(Exception, match="too large for an exact integer"):
        whitening.whitened_rows(df)
