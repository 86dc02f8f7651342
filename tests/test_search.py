import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.functions import vectors as V
from nearkin.operators import hyperplane, ivf, pq, search
from nearkin.operators.ranking import as_queries, query_sample, rows_of
from nearkin.plans.features import tokens_of, words_of


def answers(df):
    found = {}
    for r in df.orderBy("qid", "rank").collect():
        found.setdefault(r["qid"], []).append(r["doc_id"])
    return found


def asked(df, n=25):
    return rows_of(df, query_sample(df, n)).withColumnRenamed("doc_id", "qid")


def brute_cosine(vectors, qids, k):
    rows = {r["doc_id"]: np.array(r["vector"], float) for r in vectors.collect()}
    out = {}
    for q in qids:
        def score(d):
            length = np.linalg.norm(rows[q]) * np.linalg.norm(rows[d])
            return round(float(rows[q] @ rows[d] / length), 9) if length else 0.0
        out[q] = sorted((d for d in rows if d != q), key=lambda d: (-score(d), d))[:k]
    return out


def test_cosine_topk_is_exact(spark, vectors):
    queries = asked(vectors)
    found = answers(search.cosine_topk(vectors.repartition(5), queries))
    assert found == brute_cosine(vectors, list(found), 10)
    assert len(found) == 25


def test_blocks_give_the_same_answer(spark, vectors, monkeypatch):
    queries = asked(vectors)
    assert answers(search.cosine_topk(vectors, queries, max_queries=4)) == answers(search.cosine_topk(vectors, queries))


def test_large_queries_are_never_collected(spark, vectors):
    from nearkin.plans.scale import collect_bounded

    queries = asked(vectors)
    assert collect_bounded(queries, 25).num_rows == 25
    assert collect_bounded(queries, 24) is None
    assert collect_bounded(queries, 25, 1_000) is None
    assert answers(search.cosine_topk(vectors, queries, max_query_bytes=1_000)) == answers(
        search.cosine_topk(vectors, queries)
    )


def test_zero_vector_ties_and_self(spark):
    rows = [(5, [1.0, 0.0]), (2, [1.0, 0.0]), (9, [2.0, 0.0]), (1, [0.0, 0.0]), (3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "doc_id bigint, vector array<double>")
    queries = df.filter("doc_id in (5, 1)").withColumnRenamed("doc_id", "qid")
    found = answers(search.cosine_topk(df, queries, 4))
    assert found == {5: [2, 9, 1, 3], 1: [2, 3, 5, 9]}
    kept = answers(search.cosine_topk(df, queries, 2, exclude_self=False))
    assert kept[5] == [2, 5]


def test_a_third_of_copies_still_gives_k_rows(spark):
    rng = np.random.RandomState(0)
    rows = [(i, rng.randn(8).tolist() if i % 3 else [1.0] * 8) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, vector array<double>").repartition(6)
    queries = df.filter("doc_id = 3").withColumnRenamed("doc_id", "qid")
    assert answers(search.cosine_topk(df, queries))[3] == [0, *range(6, 33, 3)]


def test_flat_index_has_recall_one(spark, vectors):
    unit = vectors.select("doc_id", V.l2_normalize(F.col("vector")).alias("vector"))
    queries = asked(vectors)
    unit_queries = queries.select("qid", V.l2_normalize(F.col("vector")).alias("vector"))
    assert answers(search.inner_product_topk(unit, unit_queries)) == answers(search.cosine_topk(vectors, queries))


def test_vectors_of_different_length_are_refused(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "doc_id bigint, vector array<double>").coalesce(1)
    with pytest.raises(Exception, match="different length"):
        search.cosine_topk(df, df.withColumnRenamed("doc_id", "qid")).collect()


def brute_jaccard(sets, qids, k):
    def score(a, b):
        return len(a & b) / len(a | b) if a | b else 0.0
    return {q: sorted((d for d in sets if d != q), key=lambda d: (-score(sets[q], sets[d]), d))[:k] for q in qids}


def test_jaccard_topk_is_exact(spark, documents):
    words = words_of(tokens_of(documents))
    found = answers(search.jaccard_topk(words, asked(words)))
    sets = {r["doc_id"]: set(r["words"]) for r in words.collect()}
    assert found == brute_jaccard(sets, list(found), 10)


def test_jaccard_in_many_small_pieces(spark, documents, monkeypatch):
    import pyarrow as pa

    from nearkin.functions import kernels

    words = words_of(tokens_of(documents))
    lists = pa.array([r["words"] for r in words.collect()], pa.list_(pa.string()))
    whole = kernels.JaccardScorer(lists.slice(3, 20))(lists.slice(50, 100))
    monkeypatch.setattr(kernels, "UNROLLED", 100)
    assert np.array_equal(whole, kernels.JaccardScorer(lists.slice(3, 20))(lists.slice(50, 100)))


def test_jaccard_fills_up_with_zero_scores(spark):
    rows = [(1, ["a", "b"]), (2, ["b", "c"]), (3, []), (4, []), (5, ["z"])]
    df = spark.createDataFrame(rows, "doc_id bigint, words array<string>")
    got = search.jaccard_topk(df, df.withColumnRenamed("doc_id", "qid"), 3).orderBy("qid", "rank").collect()
    assert [(r["doc_id"], r["score"]) for r in got if r["qid"] == 1] == [(2, 1 / 3), (3, 0.0), (4, 0.0)]
    assert [(r["doc_id"], r["score"]) for r in got if r["qid"] == 3] == [(1, 0.0), (2, 0.0), (4, 0.0)]


def test_jaccard_blocks(spark, documents, monkeypatch):
    words = words_of(tokens_of(documents))
    queries = asked(words)
    assert answers(search.jaccard_topk(words, queries, max_queries=6)) == answers(search.jaccard_topk(words, queries))


# ------------------------------------------------------------------ hyperplanes

def test_hyperplane_signature(spark):
    rows = [(1, [0.0, 0.0, 0.0]), (2, [1.0, -2.0, 0.5]), (3, [2.0, -4.0, 1.0])]
    df = spark.createDataFrame(rows, "doc_id bigint, vector array<double>")
    keys = {r["doc_id"]: r["bucket"] for r in hyperplane.hyperplane_signatures(df, 32).collect()}
    assert keys[1] == "0" * 32
    assert keys[2] == keys[3] and set(keys[2]) == {"0", "1"}


def test_hyperplane_bucket_search(spark, vectors, monkeypatch):
    signed = hyperplane.hyperplane_signatures(vectors, 4)
    queries = as_queries(rows_of(signed, query_sample(vectors, 10)))
    table = {r["doc_id"]: r["bucket"] for r in signed.collect()}
    pairs = {(r["qid"], r["doc_id"]) for r in hyperplane.hyperplane_candidates(signed, queries).collect()}
    qids = {r["qid"] for r in queries.collect()}
    assert pairs == {(q, d) for q in qids for d in table if table[q] == table[d]}
    found = answers(hyperplane.hyperplane_topk(signed, queries))
    exact = brute_cosine(vectors, list(found), 500)
    assert found == {q: [d for d in exact[q] if table[d] == table[q]][:10] for q in found}
    # the same through the join for query sets that are too large to broadcast
    from nearkin.plans import scale
    monkeypatch.setattr(scale, "MAX_BROADCAST_ROWS", 1)
    assert answers(hyperplane.hyperplane_topk(signed, queries)) == found


# ------------------------------------------------------------------ product quantization

def test_dimension_must_divide(spark):
    df = spark.createDataFrame([(i, [float(i)] * 10) for i in range(4)], "doc_id bigint, vector array<double>")
    with pytest.raises(ValueError, match="not divisible"):
        pq.train_codebooks(df, 8, 2)
    with pytest.raises(ValueError, match="not divisible"):
        V.subvectors(F.col("vector"), 8, 10)
    with pytest.raises(ValueError, match="at least as many"):
        pq.train_codebooks(df, 5, 9)


def test_training_lowers_the_error(spark, vectors):
    rows = np.array([r["vector"] for r in vectors.orderBy("doc_id").collect()], float)

    def error(rounds):
        books = pq.train_codebooks(vectors, 8, 16, rounds)
        centres = pq.codebook_array(books)
        codes = np.array([r["codes"] for r in pq.encode(vectors, books).orderBy("doc_id").collect()])
        decoded = np.concatenate([centres[m][codes[:, m]] for m in range(8)], axis=1)
        return ((rows - decoded) ** 2).sum()

    first, later = error(0), error(4)
    assert later < first


def test_codes_are_the_nearest_centres(spark, vectors):
    books = pq.train_codebooks(vectors, 8, 16, 2)
    centres = pq.codebook_array(books)
    for r in vectors.join(pq.encode(vectors, books), "doc_id").limit(50).collect():
        parts = np.array(r["vector"], float).reshape(8, 1, 8)
        assert (((centres - parts) ** 2).sum(axis=2).argmin(axis=1) == r["codes"]).all()


def test_pq_topk(spark, vectors):
    books = pq.train_codebooks(vectors, 8, 16, 2)
    centres = pq.codebook_array(books)
    codes = pq.encode(vectors, books)
    queries = asked(vectors, 5)
    code = {r["doc_id"]: r["codes"] for r in codes.collect()}
    for q in queries.collect():
        table = ((centres - np.array(q["vector"], float).reshape(8, 1, 8)) ** 2).sum(axis=2)
        far = {d: table[range(8), c].sum() for d, c in code.items() if d != q["qid"]}
        best = sorted(far, key=lambda d: (round(far[d], 9), d))[:10]
        mine = [r for r in pq.pq_topk(codes, books, queries).orderBy("rank").collect() if r["qid"] == q["qid"]]
        assert [r["doc_id"] for r in mine] == best
        assert [r["score"] for r in mine] == pytest.approx([far[d] for d in best])


def test_own_centres_have_distance_zero(spark):
    df = spark.createDataFrame([(i, [float(i), float(i * i)]) for i in range(6)], "doc_id bigint, vector array<double>")
    books = pq.train_codebooks(df, 2, 6, 1)
    found = pq.pq_topk(pq.encode(df, books), books, df.withColumnRenamed("doc_id", "qid"), 1, exclude_self=False)
    assert all(r["qid"] == r["doc_id"] and r["score"] == 0 for r in found.collect())


# ------------------------------------------------------------------ inverted file

def test_probing_all_cells_is_exact(spark, vectors):
    centres = ivf.train_cells(vectors, 8, 3)
    placed = ivf.assign_cells(vectors, centres)
    queries = asked(vectors)
    assert answers(ivf.ivf_topk(placed, centres, queries, nprobe=8)) == answers(search.cosine_topk(vectors, queries))


def test_more_probes_never_lower_recall(spark, vectors, monkeypatch):
    centres = ivf.train_cells(vectors, 8, 3)
    placed = ivf.assign_cells(vectors, centres)
    queries = asked(vectors)
    exact = answers(search.cosine_topk(vectors, queries))
    hits = []
    for nprobe in (1, 3, 6):
        found = answers(ivf.ivf_topk(placed, centres, queries, nprobe=nprobe))
        hits.append(sum(len(set(exact[q]) & set(found.get(q, []))) for q in exact))
    assert hits == sorted(hits)
    few = answers(ivf.ivf_topk(placed, centres, queries, nprobe=3))
    monkeypatch.setattr(ivf, "MAX_PROBES", 32)  # the way for more probes than fit
    assert answers(ivf.ivf_topk(placed, centres, queries, nprobe=3)) == few


def test_l2_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [list(r[0]) for r in df.select(V.l2_normalize(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


# ------------------------------------------------------------------ size of the numbers

def scaled(vectors, factor):
    return vectors.select("doc_id", F.transform("vector", lambda x: x.cast("double") * factor).alias("vector"))


@pytest.mark.parametrize("factor", [2.0 ** -20, 2.0 ** 20])
def test_answers_and_codes_do_not_depend_on_scale(spark, vectors, factor):
    def results(table):
        queries = asked(table)
        books = pq.train_codebooks(table, 4, 16, 2)
        codes = {r["doc_id"]: list(r["codes"]) for r in pq.encode(table, books).collect()}
        return ids(search.inner_product_topk(table, queries)), codes, ids(pq.pq_topk(pq.encode(table, books), books, queries))

    def ids(found):
        return sorted((r["qid"], r["rank"], r["doc_id"]) for r in found.collect())

    assert results(scaled(vectors, 1.0)) == results(scaled(vectors, factor))


def test_what_is_not_a_number_takes_no_place(spark):
    rows = [(i, [float(i), 1.0]) for i in range(8)] + [(100 + i, [float("nan"), 1.0]) for i in range(5)] + [(200, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, vector array<double>").coalesce(1)
    queries = spark.createDataFrame([(1000, [1.0, 0.0])], "qid bigint, vector array<double>")
    found = search.inner_product_topk(df, queries, 5).orderBy("rank").collect()
    assert [r["doc_id"] for r in found] == [7, 6, 5, 4, 3]
    assert hyperplane.hyperplane_signatures(df, 8).count() == 13


@pytest.mark.parametrize("gain, words_", [(0, 0), (1, 3), (10**9, 2_048)])
def test_shared_words_by_product_and_by_lists_are_the_same(monkeypatch, gain, words_):
    import pyarrow as pa

    from nearkin.functions import kernels

    monkeypatch.setattr(kernels, "DENSE_GAIN", gain)
    monkeypatch.setattr(kernels, "DENSE_WORDS", words_)
    rng = np.random.default_rng(5)
    sets = [sorted({f"w{int(x)}" for x in rng.zipf(1.4, rng.integers(0, 40)) if x < 60}) for _ in range(70)]
    asked, corpus = pa.array(sets[:30], pa.list_(pa.string())), pa.array(sets[20:], pa.list_(pa.string()))
    scores = kernels.JaccardScorer(asked)(corpus)
    for i, a in enumerate(sets[:30]):
        for j, b in enumerate(sets[20:]):
            union = len(set(a) | set(b))
            assert scores[i, j] == (len(set(a) & set(b)) / union if union else 0.0)
