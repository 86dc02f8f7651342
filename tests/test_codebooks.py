import numpy as np
import pytest

from nearkin.functions import kernels
from nearkin.operators import pq


def table(spark, rows, parts=3):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "doc_id bigint, vector array<double>")
    return df.repartition(parts)


def blobs(n=400, dim=8, centres=12, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(centres, dim))[rng.integers(0, centres, n)] * 3 + rng.normal(size=(n, dim)) * 0.2


def inertia_of(rows, books):
    m = len(books)
    parts = rows.reshape(len(rows), m, -1)
    return np.array([((parts[:, i, None] - books[i][None]) ** 2).sum(axis=2).min(axis=1).sum() for i in range(m)])


def books_of(df):
    return pq.codebook_array(df)


def test_of_several_starts_the_least_inertia_stays(spark):
    rows = blobs()
    df = table(spark, rows)
    several = books_of(pq.train_codebooks(df, 2, 12, 4, starts=3))
    each = []
    for seeds in pq.seeds_in_order(df, 2, 12, 3):
        centres = list(seeds)
        for _ in range(4):
            for part in range(2):
                own = rows[:, part * 4:(part + 1) * 4]
                code = ((own[:, None] - centres[part][None]) ** 2).sum(axis=2).argmin(axis=1)
                centres[part] = np.array([own[code == c].mean(axis=0) if (code == c).any() else centres[part][c] for c in range(12)])
        each.append(np.stack(centres))
    cost = np.array([inertia_of(rows, b) for b in each])
    assert len({tuple(c) for c in cost.round(6).tolist()}) == 3  # the starts do differ
    for part in range(2):
        assert several[part] == pytest.approx(each[cost[:, part].argmin()][part])
    found = {r.m: r.inertia for r in pq.codebook_inertia(df, pq.codebook_table(df, several)).collect()}
    assert [found[0], found[1]] == pytest.approx(cost.min(axis=0))


def test_seeds_by_distance_are_better_and_do_not_depend_on_partitions(spark):
    rows = blobs(600, centres=20, seed=4)
    plain = inertia_of(rows, books_of(pq.train_codebooks(table(spark, rows), 2, 20, 3)))
    spread = [books_of(pq.train_codebooks(table(spark, rows, parts), 2, 20, 3, seeding="distance")) for parts in (1, 5)]
    assert spread[0] == pytest.approx(spread[1])
    assert (inertia_of(rows, spread[0]) < 0.7 * plain).all()


def test_copies_and_few_different_vectors(spark):
    """Fewer different vectors than centres: no centre is made up of nothing, and all vectors are met."""
    rows = np.repeat(np.arange(12.0).reshape(3, 4), 40, axis=0)
    books = books_of(pq.train_codebooks(table(spark, rows), 2, 8, 3, seeding="distance", reseed=True))
    assert books.shape == (2, 8, 2) and np.isfinite(books).all()
    assert inertia_of(rows, books) == pytest.approx([0, 0], abs=1e-12)


def test_a_centre_without_rows_goes_to_the_farthest(spark):
    rows = np.concatenate([np.zeros((30, 2)), np.full((30, 2), 0.1), [[50.0, 50.0], [51.0, 51.0]]])
    sets = pq.Sets(1, [np.array([[0.0, 0.0], [0.1, 0.1], [99.0, -99.0]])])
    df = table(spark, rows)
    sums, inertia = pq._tallied(df, sets)
    assert sums[0][:, 0].tolist() == [30, 32, 0]
    assert inertia[0] == pytest.approx(inertia_of(rows, np.array([sets.sets[0]]))[0])
    assert pq._moved(df, sets, sums, False).sets[0][2].tolist() == [99.0, -99.0]
    assert pq._moved(df, sets, sums, True).sets[0][2].tolist() == [51.0, 51.0]


def test_training_ends_when_nothing_is_gained(spark, monkeypatch):
    passes, tallied = [], pq._tallied
    monkeypatch.setattr(pq, "_tallied", lambda *a: passes.append(1) or tallied(*a))
    df = table(spark, blobs(200, centres=3, seed=2))
    pq.train_codebooks(df, 2, 3, 30, tolerance=0.0)
    assert 2 <= len(passes) < 15
    with pytest.raises(ValueError, match="unknown seeding"):
        pq.train_codebooks(df, 2, 3, seeding="none")
    with pytest.raises(ValueError, match="at least as many vectors"):
        pq.train_codebooks(df, 2, 201, starts=2)


def test_nearest_centre_counts_ties_as_before():
    rows = np.array([[0.5, 0.0], [0.0, 0.0], [1e6, 1e6]])
    centres = np.array([[1.0, 0.0], [0.0, 0.0], [1.0, 0.0], [1e6, 1e6 + 1e-4]])
    code, apart = kernels.nearest_with_distance(rows, centres)
    assert code.tolist() == [0, 1, 3] and apart[:2] == pytest.approx([0.25, 0.0])
    assert kernels.nearest_centre(np.array([[1e6, 1e6]]), np.array([[1e6, 1e6 + 1e-4], [1e6, 1e6]])).tolist() == [0]


def test_sums_by_code_and_uniform_numbers():
    rng = np.random.default_rng(0)
    rows, code = rng.normal(size=(50, 3)), rng.integers(0, 7, 50)
    total = kernels.sums_by_code(rows, code, 9)
    for c in range(9):
        assert total[c] == pytest.approx([(code == c).sum(), *rows[code == c].sum(axis=0)])
    assert not kernels.sums_by_code(rows[:0], code[:0], 2).any()
    u = kernels.uniform(np.arange(20_000), 3, 1)
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and (u != kernels.uniform(np.arange(20_000), 3, 2)).all()


def test_nearest_centres_by_parts(monkeypatch):
    """No matrix of distances is larger than the bound, and the parts give what the whole gives."""
    rng = np.random.default_rng(6)
    rows, centres = rng.normal(size=(500, 5)), rng.normal(size=(30, 5))
    centres[7] = centres[3]
    apart = ((rows[:, None] - centres) ** 2).sum(axis=2)
    for cells in (1, 100, 1 << 16):
        monkeypatch.setattr(kernels, "CACHED_CELLS", cells)
        code, least = kernels.nearest_with_distance(rows, centres)
        assert np.array_equal(code, apart.argmin(axis=1)) and np.allclose(least, apart.min(axis=1)) and 7 not in code
