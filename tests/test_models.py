import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nearkin.operators import lsi, terms, words
from nearkin.plans import scale
from nearkin.plans.features import tokens_of


def small_matrix(spark, docs):
    counts = terms.term_counts(tokens_of(docs))
    vocab = terms.vocabulary(counts, 400)
    rows, names = terms.tfidf_rows(tokens_of(docs), vocab, docs.count())
    ids = sorted(r["doc_id"] for r in docs.collect())
    dense = np.zeros((len(ids), len(names)))
    for r in rows.collect():
        dense[ids.index(r["doc_id"]), r["idx"]] = r["val"]
    return rows, names, ids, dense


def test_lsi_matches_the_svd(spark, documents):
    rows, names, ids, dense = small_matrix(spark, documents)
    embedded, model = lsi.lsi_embed(rows, names, documents, 8, power_steps=12)
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    assert model.singular_values == pytest.approx(s[:8], rel=1e-4)
    got = {r["doc_id"]: r["embedding"] for r in embedded.collect()}
    assert sorted(got) == ids
    found = np.array([got[d] for d in ids])[:, :4]  # the range finder is sharpest for the largest
    signs = np.where(vt[:4][np.arange(4), np.abs(vt[:4]).argmax(axis=1)] < 0, -1, 1)
    assert np.abs(found - u[:, :4] * s[:4] * signs).max() < 1e-3


def test_lsi_gives_empty_documents_zeros(spark):
    docs = spark.createDataFrame(
        [(1, "cat dog"), (2, "dog bird fish"), (3, "of the"), (4, "cat fish")], "doc_id bigint, text string"
    )
    rows, names, _, _ = small_matrix(spark, docs)
    embedded, _ = lsi.lsi_embed(rows, names, docs, 2)
    got = {r["doc_id"]: r["embedding"] for r in embedded.collect()}
    assert got[3] == [0.0, 0.0] and len(got) == 4


def test_lsi_does_not_depend_on_partitions(spark, documents):
    rows, names, _, _ = small_matrix(spark, documents)
    rows = lsi.written(rows)
    one = lsi.fit_lsi(rows.coalesce(1), names, 4)
    many = lsi.fit_lsi(rows.repartition(6), names, 4)
    assert one.singular_values == pytest.approx(many.singular_values, rel=1e-9)


def test_lsi_does_not_depend_on_the_limits(spark, documents, monkeypatch):
    """Many small blocks and trees of several levels give the same vectors."""
    rows, names, _, _ = small_matrix(spark, documents)
    rows = lsi.written(rows)
    plain = lsi.fit_lsi(rows, names, 4, power_steps=12, exact_steps=6)
    for name, value in {"BLOCK_ENTRIES": 300, "PART_ENTRIES": 50, "FAN_IN": 2}.items():
        monkeypatch.setattr(lsi, name, value)
    other = lsi.fit_lsi(rows, names, 4, power_steps=12, exact_steps=6)
    assert plain.singular_values == pytest.approx(other.singular_values, rel=1e-9)
    got = np.array([r["direction"] for r in lsi.direction_rows(other).orderBy("at").collect()])
    monkeypatch.undo()
    expected = np.array([r["direction"] for r in lsi.direction_rows(plain).orderBy("at").collect()])
    assert got.shape == (len(names), 4) and np.abs(got - expected).max() < 1e-6
    assert np.abs(got.T @ got - np.eye(4)).max() < 1e-9


@pytest.mark.parametrize("factor", [0, 1000])
def test_sparse_products_small_and_entry_by_entry(monkeypatch, factor):
    monkeypatch.setattr(lsi, "DENSE_FACTOR", factor)
    rng = np.random.default_rng(1)
    dense = np.where(rng.random((40, 12)) < 0.1, rng.normal(size=(40, 12)), 0.0)
    (row, column), other = np.nonzero(dense), rng.normal(size=(12, 5))
    order = rng.permutation(len(row))
    rows, product = lsi._sparse_times(row[order], column[order], dense[row, column][order], other)
    assert rows.tolist() == sorted(set(row.tolist())) and np.allclose(product, (dense @ other)[rows])


def test_lsi_of_lower_rank_than_asked(spark):
    docs = spark.createDataFrame([(1, "cat dog"), (2, "cat dog"), (3, "bird fish snake"), (4, "")], "doc_id bigint, text string")
    rows, names, _, dense = small_matrix(spark, docs)
    embedded, model = lsi.lsi_embed(rows, names, docs, 4)
    size = np.linalg.svd(dense, compute_uv=False)
    assert model.singular_values == pytest.approx([size[0], size[1], 0, 0], abs=1e-9)
    got = np.array([r["embedding"] for r in embedded.orderBy("doc_id").collect()])
    assert got.shape == (4, 4) and got @ got.T == pytest.approx(np.vstack([dense @ dense.T]), abs=1e-9)


def test_lsi_without_terms(spark):
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id bigint, text string")
    rows, names, _, _ = small_matrix(spark, docs)
    embedded, model = lsi.lsi_embed(rows, names, docs, 3)
    assert names == [] and [r["embedding"] for r in embedded.collect()] == [[0.0] * 3] * 2 and not model.singular_values.any()


def test_orthonormal_columns_of_a_table(spark):
    """Nearly dependent columns: measured twice, and what is dependent is dropped."""
    rng = np.random.default_rng(3)
    dense = rng.normal(size=(300, 5)) @ np.diag([1, 1, 1e-7, 1, 1])
    dense[:, 4] = dense[:, 0] + dense[:, 1]

    def blocks(batches):
        yield from lsi._with_triangles(((b, dense[b * 128: (b + 1) * 128]) for batch in batches for b in batch.column(0).to_pylist()), 5)

    sums = lsi.written(spark.range(3, numPartitions=2).selectExpr("cast(id as int) as block").mapInArrow(blocks, lsi.SUMS))
    basis = lsi._orthonormal(sums, 5)
    rows = {r.block: np.frombuffer(r.v).reshape(-1, 4) for r in lsi._turned(basis, np.eye(basis.width)).collect()}
    whole = np.concatenate([rows[b] for b in range(3)])
    assert basis.width == 4 and np.abs(whole.T @ whole - np.eye(4)).max() < 1e-12


def pooled(spark, rows, pool):
    tokens = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vector array<double>")
    return {r["doc_id"]: list(r["embedding"]) for r in pool(tokens, vectors).collect()}


@pytest.mark.parametrize("pool", [words.mean_pool, words.pool_by_join])
def test_mean_pool_counts_known_tokens_only(spark, pool):
    rows = [(1, ["a", "a", "b", "unk"]), (2, ["unk"]), (3, []), (4, ["b"])]
    got = pooled(spark, rows, pool)
    assert got[1] == pytest.approx([2 / 3, 1 / 3])
    assert got[2] == got[3] == [0.0, 0.0]
    assert got[4] == [0.0, 1.0]


def test_mean_pool_over_many_documents(spark):
    rng = np.random.RandomState(5)
    rows = [(i, rng.choice(["a", "b", "zz"], rng.randint(0, 6)).tolist()) for i in range(700)]
    assert pooled(spark, rows, words.mean_pool) == {
        d: pytest.approx(v) for d, v in pooled(spark, rows, words.pool_by_join).items()
    }


def test_word2vec_knows_frequent_words(spark, documents):
    tokens = tokens_of(documents)
    model = words.train_word2vec(tokens, size=8, epochs=1)
    vectors = words.word_vectors(model)
    counts = terms.term_counts(tokens).groupBy("term").sum("tf").filter("`sum(tf)` >= 2")
    assert vectors.count() == counts.count()
    assert all(len(r["vector"]) == 8 for r in vectors.limit(5).collect())


def test_texts_outside_the_corpus(spark, documents, tmp_path):
    tokens = tokens_of(documents.limit(60)).cache()
    vocab, n = terms.vocabulary(terms.term_counts(tokens), 200).cache(), tokens.count()
    rows, names = terms.tfidf_rows(tokens, vocab, n)
    known, model = lsi.lsi_embed(rows, names, tokens, 8, power_steps=2)
    lsi.save_model(spark, model, str(tmp_path))
    again = lsi.embed_texts(tokens, vocab, n, lsi.load_model(spark, str(tmp_path)))
    expected = {r["doc_id"]: r["embedding"] for r in known.collect()}
    for r in again.collect():
        assert np.allclose(r["embedding"], expected[r["doc_id"]])
    strange = spark.createDataFrame([(1, ["nowhere"]), (2, [])], "doc_id bigint, tokens array<string>")
    assert all(set(r["embedding"]) == {0.0} for r in lsi.embed_texts(strange, vocab, n, model).collect())


def test_sums_of_gathered_rows(monkeypatch):
    """Rows of many lengths, empty ones and pieces of any size give the sums of the sparse matrix."""
    rng = np.random.default_rng(2)
    length = np.array([0, 3, 1, 3, 0, 70, 1, 2, 3, 0])
    bounds = np.append(0, np.cumsum(length))
    column, value, other = rng.integers(0, 9, bounds[-1]), rng.normal(size=bounds[-1]), rng.normal(size=(9, 4))
    dense = np.zeros((len(length), 9))
    np.add.at(dense, (np.repeat(np.arange(len(length)), length), column), value)
    for size in (1, 5, 1000):
        monkeypatch.setattr(lsi, "GATHERED", size)
        assert np.allclose(lsi._sums(bounds, column, value, other), dense @ other)
    assert lsi._sums(np.zeros(1, int), column[:0], value[:0], other).shape == (0, 4)


def test_small_dense_matrix_is_bounded(monkeypatch):
    """Entries so many that the factor alone would allow a matrix of any size."""
    monkeypatch.setattr(lsi, "DENSE_FACTOR", 10**9)
    monkeypatch.setattr(lsi, "DENSE_CELLS", 100)
    made, zeros = [], np.zeros
    monkeypatch.setattr(lsi.np, "zeros", lambda shape, *kind: made.append(np.prod(shape)) or zeros(shape, *kind))
    rows, product = lsi._sparse_times(np.arange(60), np.arange(60) % 7, np.ones(60), np.eye(7))
    assert max(made) == 60 * 7 and len(made) == 1 and np.array_equal(product, np.eye(7)[np.arange(60) % 7])


def test_lsi_by_a_shared_basis_and_by_document_blocks(spark, documents, monkeypatch):
    """A basis that fits goes to every task and documents stay where they are; a larger one goes out by blocks."""
    rows, names, ids, _ = small_matrix(spark, documents)
    rows = scale.written(rows)
    plan = lsi.documents_of(rows, len(names), 14).read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    found = []
    for limit in (lsi.SHARED_BYTES, 0):
        monkeypatch.setattr(lsi, "SHARED_BYTES", limit)
        assert isinstance(lsi.documents_of(rows, len(names), 14), (lsi.DocumentRows, lsi.DocumentBlocks)[limit == 0])
        table, model = lsi.lsi_embed(rows, names, documents, 4, power_steps=12, exact_steps=6)
        found.append(({r.doc_id: r.embedding for r in table.collect()}, model.singular_values))
    assert found[0][0].keys() == found[1][0].keys() and sorted(found[0][0]) == ids
    assert np.allclose(found[0][1], found[1][1])
    assert all(np.allclose(found[0][0][d], found[1][0][d], atol=1e-6) for d in found[0][0])


def test_written_tables_send_bounded_batches(spark):
    """Wide rows filled batches of 64 MB, which a task holds outside the heap and in its worker."""
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    wide = spark.range(0, 24, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text")).mapInArrow(sizes, "n bigint")
    assert scale.written(wide).agg(F.max("n")).first()[0] <= scale.BATCH_BYTES + (2 << 20)
    assert spark.conf.get(scale.BATCH_SIZE, None) is None


def test_pooling_by_parts_gives_the_same_means(spark, monkeypatch):
    """A large table of word vectors was joined to a row for every word of every document."""
    rows = [(1, ["a", "b", "b"]), (2, ["c", None, "zz"]), (3, []), (4, ["zz"]), (4, ["d", "a"]), (None, ["e", "e"]), (6, None)]
    corpus = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    table = spark.createDataFrame([(w, [float(i), 1.0]) for i, w in enumerate("abcde")], "word string, vector array<double>")
    whole = sorted(map(str, words.mean_pool(corpus, table).collect()))
    monkeypatch.setattr(words, "POOL_BYTES", 40)
    monkeypatch.setattr(words, "pool_by_join", None)
    assert sorted(map(str, words.mean_pool(corpus, table).collect())) == whole
