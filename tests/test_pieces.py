"""Tasks work on bounded pieces of a batch, with the results of the whole one."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from nearkin.functions import kernels
from nearkin.operators import lsh, search, terms


def big_batch(rows=4_000, seed=5):
    """Lists of 0 to 400 words, and one of more than a piece holds."""
    rng = np.random.default_rng(seed)
    lists = [[f"w{x}" for x in rng.integers(0, 900, n)] for n in rng.integers(0, 400, rows)]
    lists[17], lists[18] = [f"v{x}" for x in range(kernels.PIECE_ITEMS + 5)], []
    return pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int64()), pa.array(lists)], names=["doc_id", "tokens"]), lists


@pytest.fixture
def task(spark, monkeypatch):
    """The function that an operator hands to the tasks."""
    df = spark.createDataFrame([(1, ["a"])], "doc_id bigint, tokens array<string>")
    held = []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: held.append(run) or self)
    return df, held


def test_pieces_are_bounded_and_whole():
    batch, lists = big_batch()
    parts = list(kernels.pieces(batch, "tokens"))
    sizes = [sum(map(len, p.column("tokens").to_pylist())) for p in parts]
    assert len(parts) > 3 and all(s <= kernels.PIECE_ITEMS or p.num_rows == 1 for s, p in zip(sizes, parts))
    assert pa.Table.from_batches(parts).to_pydict() == {"doc_id": list(range(len(lists))), "tokens": lists}
    assert max(p.num_rows for p in kernels.pieces(batch, 1, 100)) == 100
    nulls = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([None, ["a"], None], pa.list_(pa.string()))], names=["doc_id", "tokens"])
    assert [p.num_rows for p in kernels.pieces(nulls, "tokens")] == [3] and not list(kernels.pieces(nulls.slice(0, 0), "tokens"))


def test_term_counts_in_pieces(task):
    (df, held), (batch, lists) = task, big_batch()
    terms.term_counts(df)
    out = list(held[0](iter([batch])))
    assert all(b.num_rows <= kernels.PIECE_ITEMS + 5 for b in out) and len(out) > 3
    found = {(d, t): n for b in out for d, t, n in zip(*b.to_pydict().values())}
    assert found == {(i, t): n for i, words in enumerate(lists) for t, n in Counter(words).items()}


def test_weights_in_pieces(task):
    (df, held), (batch, lists) = task, big_batch()
    listed = pa.table({"term": [f"w{i}" for i in range(900)], "idf": np.linspace(1, 2, 900)})
    terms._weights(df, listed, lambda ids, row, term, weight, _: pa.RecordBatch.from_arrays(
        [ids.take(pa.array(row)), pa.array(weight)], names=["doc_id", "w"]), "doc_id bigint, w double")
    out = list(held[0](iter([batch])))
    assert len(out) > 3 and max(b.num_rows for b in out) <= kernels.PIECE_ITEMS
    squares = pa.Table.from_batches(out).to_pandas().assign(w=lambda t: t.w**2).groupby("doc_id").w.sum()
    assert np.allclose(squares, 1) and set(squares.index) == {i for i, w in enumerate(lists) if w and i != 17}


def test_signatures_in_pieces(task):
    (df, held), (batch, _) = task, big_batch(1_500)
    lsh.minhash_signatures(df, 16, 3)
    out = list(held[0](iter([batch])))
    single = [b for at in range(0, 1_500, 500) for b in held[0](iter([batch.slice(at, 500)]))]
    assert len(out) > 2 and pa.Table.from_batches(out).column("signature").to_pylist() == pa.Table.from_batches(single).column("signature").to_pylist()


def test_exact_jaccard_in_pieces(task, monkeypatch):
    (df, held), (batch, lists) = task, big_batch(1_500)
    asked = pa.table({"qid": [3, 5], "item": [sorted(set(lists[3])), sorted(set(lists[5]))]})
    sets = pa.RecordBatch.from_arrays([batch.column(0), pa.array([sorted(set(x)) for x in lists[:1_500]])], names=["doc_id", "item"])
    seen, scorer = [], kernels.JaccardScorer
    monkeypatch.setattr(scorer, "__call__", lambda self, items, f=scorer.__call__: seen.append(len(items.flatten())) or f(self, items))
    search._scan(df, asked, scorer, 5, True)
    out = pa.Table.from_batches(list(held[0](iter([sets]))))
    assert len(seen) > 2 and sorted(seen)[-2] <= kernels.PIECE_ITEMS
    own = [set(x) for x in lists[:1_500]]
    for q in (3, 5):
        score = [(-len(own[q] & s) / len(own[q] | s), i) for i, s in enumerate(own) if i != q and own[q] | s]
        found = sorted((-s, d) for a, d, s in zip(*out.to_pydict().values()) if a == q)
        assert found == sorted(score)[:5]
