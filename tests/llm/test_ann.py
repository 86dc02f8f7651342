import math

import numpy as np
import pyarrow as pa
import pytest

from nearkin.llm import ann, queries

SCHEMA = "vec_id bigint, embedding array<double>, rank int, k1 string"


def brute_force(rows, asked, k):
    """rows: (id, vector); the k best of each asked (id, vector) with scores."""
    out = {}
    for q, a in asked:
        scored = sorted((-math.fsum(x * y for x, y in zip(a, b)), v) for v, b in rows if v != q and len(a) == len(b))
        out[q] = [(v, -s) for s, v in scored[:k]]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(found, expected):
    """Share of the true neighbours found; found ones must have true scores in the right order."""
    hits = [len({v for v, _ in found[q]} & {v for v, _ in best}) / len(best) for q, best in expected.items() if best]
    return sum(hits) / len(hits)


def check_order(found, rows):
    vectors = {}
    for v, b in rows:
        vectors.setdefault(v, []).append(b)
    for q, best in found.items():
        assert all(v != q for v, _ in best) and best == sorted(best, key=lambda x: (-x[1], x[0]))
        for v, score in best:
            assert any(score == pytest.approx(sum(x * y for x, y in zip(a, b)), rel=1e-12, abs=1e-12) for a in vectors[q] for b in vectors[v])


def normal(n, dim, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dim))
    return (centres[rng.integers(0, 10, n)] + rng.normal(size=(n, dim)) * 1.5)


def table(spark, rows, parts=4):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("dim, depth", [(64, None), (24, 3)])
def test_recall_on_unit_vectors(spark, dim, depth):
    x = normal(1500, dim, dim)
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = table(spark, rows)
    found = answers(ann.nearest(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding", depth=depth))
    assert recall(found, brute_force(rows, rows[::20], 20)) >= 0.9 and all(len(v) == 20 for v in found.values())
    check_order(found, rows)


def test_lengths_that_differ_count(spark):
    """The largest inner product, not the smallest angle."""
    x = normal(800, 16, 5) * np.exp(np.random.default_rng(6).normal(size=(800, 1)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = table(spark, rows)
    found = answers(ann.nearest(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding"))
    assert recall(found, brute_force(rows, rows[::20], 20)) >= 0.9
    check_order(found, rows)


def test_copies_in_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "SLICE_ROWS", 50)  # many slices
    x = normal(300, 8, 9)
    rows = [(i, (x[0] if i % 3 == 0 else x[1] + 1e-9 * i if i % 3 == 1 else x[i]).tolist()) for i in range(300)] + [(3, x[0].tolist())]
    df = table(spark, rows)
    found = answers(ann.nearest(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding"))
    expected = brute_force(rows[:300], rows[:300:20], 20)
    assert recall(found, expected) >= 0.9
    check_order(found, rows)
    assert [v for v, _ in found[60]] == [v for v, _ in expected[60]]  # copies of one vector: the smallest ids


def test_few_rows_are_all_found_and_unsound_ones_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.5, -1.0]), (7, [3.0, 0.0]), (1, None), (2, [1.0, None]), (40, [float("nan"), 0.0]), (3, [float("inf"), 0.0]),
            (None, [1.0, 1.0]), (60, [0.0, 0.0]), (80, []), (4, [-0.0, 1.0]), (5, [0.0, 1.0]), (100, [1.0, 2.0, 3.0]), (6, [1e200, 1e-200]), (8, [5e-324, 0.0])]
    df = table(spark, rows, 2)
    found = answers(ann.nearest(df, df.where("vec_id % 20 = 0"), "vec_id", "embedding"))
    sound = [(i, v) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    assert found == {q: best for q, best in brute_force(sound, [r for r in sound if r[0] % 20 == 0], 20).items() if best}
    assert set(found) == {0, 20}
    assert ann.nearest(df, df.where("false"), "vec_id", "embedding").count() == 0
    assert ann.nearest(df.where("false"), df, "vec_id", "embedding").count() == 0


def test_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0])]
    df = table(spark, rows, 2)
    found = answers(ann.nearest(df, df.where("vec_id = 0"), "vec_id", "embedding"))
    assert found == {0: [(1, 2.0), (1, 1.0), (2, 0.0)]}


def test_rotations_keep_angles_and_lengths():
    x = normal(40, 24, 1)
    turned = ann.rotated(x, ann.signs_of(24, 0, 2, 3)[1])
    assert turned.shape == (40, 32) and np.allclose(turned @ turned.T, x @ x.T)
    dense = np.array([[1.0]])
    while len(dense) < 32:
        dense = np.block([[dense, dense], [dense, -dense]])
    by_matrix = np.hstack([x, np.zeros((40, 8))])
    for sign in ann.signs_of(24, 0, 2, 3)[1]:
        by_matrix = (by_matrix * sign) @ dense / np.sqrt(32)
    assert np.allclose(turned, by_matrix)


def test_bucket_is_the_nearest_signed_axis():
    unit, _ = ann.unit_rows(normal(50, 16, 2))
    along = ann.Hashing(2, 2, 1).coordinates(unit)
    axes = np.vstack([np.eye(16), -np.eye(16)])
    for t in range(2):
        for j in range(2):
            turned = along[t, j][:, :16]
            distance = ((turned[:, None] - axes) ** 2).sum(axis=2)
            assert (along[t, j].argmax(axis=1) == distance.argmin(axis=1)).all()


def test_sparse_and_dense_scoring_agree(monkeypatch):
    rng = np.random.default_rng(8)
    queries_, rows = rng.integers(-3, 4, (20, 6)).astype(float), rng.integers(-3, 4, (90, 6)).astype(float)
    probed, ids = rng.random((20, 90)) < 0.3, rng.permutation(90)
    dense = ann.best_pairs(queries_, rows, probed, ids, 5)
    monkeypatch.setattr(ann, "DENSE", 2.0)
    sparse = ann.best_pairs(queries_, rows, probed, ids, 5)
    assert all((a == b).all() for a, b in zip(dense, sparse))
    for q in range(20):
        expected = sorted((-float(queries_[q] @ rows[r]), ids[r]) for r in np.flatnonzero(probed[q]))[:5]
        mine = dense[0] == q
        assert [(-s, ids[r]) for r, s in zip(dense[1][mine], dense[2][mine])] == expected


def test_query_on_given_vectors(spark, data):
    found = answers(queries.op11_cross_polytope(spark, data))
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    expected = brute_force(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert set(found) == set(expected) and all(len(v) == 20 for v in found.values()) and recall(found, expected) >= 0.9
    check_order(found, rows)


def test_lists_by_dimension():
    column = pa.array([[1.0, 2.0], [3.0], [4.0, 5.0]])
    assert [(m.tolist(), v.tolist()) for m, v in ann.by_dimension(column)] == [([1], [[3.0]]), ([0, 2], [[1.0, 2.0], [4.0, 5.0]])]
