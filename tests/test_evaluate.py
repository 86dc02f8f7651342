import pytest
from pyspark.sql import functions as F

from nearkin.operators import pairs, search
from nearkin.operators.ranking import query_sample, rows_of
from nearkin.plans import evaluate, pipeline, sweep
from nearkin.plans.features import tokens_of, words_of
from nearkin.plans.pipeline import PipelineConfig, evaluate_indices, run_pipeline
from nearkin.sources.text import write_tokens


def neighbors(spark, rows):
    return spark.createDataFrame(
        [(q, d, 0.0, i + 1) for q, ids in rows.items() for i, d in enumerate(ids)],
        "qid bigint, doc_id bigint, score double, rank int",
    )


def queries(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "qid bigint")


def test_recall_divides_by_k(spark):
    truth = neighbors(spark, {1: range(10, 20), 2: range(20, 30)})
    found = neighbors(spark, {1: [10, 11, 12, 90, 91]})
    recall = evaluate.recall_per_query(queries(spark, 1, 2), truth, found)
    assert {r["qid"]: r["recall"] for r in recall.collect()} == {1: pytest.approx(0.3), 2: 0.0}
    table = evaluate.method_recall({"x": recall}).first()
    assert (table["method"], table["n_queries"]) == ("x", 2) and table["recall"] == pytest.approx(0.15)


def test_report(spark):
    truth = neighbors(spark, {1: [9, 8, 7, 6, 5, 4]})
    found = neighbors(spark, {1: [9]})
    candidates = spark.createDataFrame([(1, 1), (1, 9), (2, 2)], "qid bigint, doc_id bigint")
    rows = {r["qid"]: r for r in evaluate.query_report(queries(spark, 1, 2), truth, found, candidates).collect()}
    assert (rows[1]["truth"], rows[1]["retrieved"], rows[1]["n_candidates"]) == ([9, 8, 7, 6, 5], [9], 1)
    assert (rows[2]["truth"], rows[2]["retrieved"], rows[2]["n_candidates"]) == ([], [], 0)


def test_percentiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,)], "jaccard double")
    got = {r["percent"]: r["value"] for r in pairs.percentiles(df, percents=(10, 50)).collect()}
    assert got == {10: pytest.approx(1.2), 50: 2.0}


def test_jaccard_sample(spark, documents):
    words = words_of(tokens_of(documents))
    drawn = pairs.jaccard_sample(words, 300).collect()
    assert 250 < len(drawn) <= 300
    assert all(r["a_id"] != r["b_id"] and 0 <= r["jaccard"] <= 1 for r in drawn)
    sets = {r["doc_id"]: set(r["words"]) for r in words.collect()}
    for r in drawn[:50]:
        a, b = sets[r["a_id"]], sets[r["b_id"]]
        assert r["jaccard"] == (len(a & b) / len(a | b) if a | b else 0.0)
    again = pairs.jaccard_sample(words.repartition(9), 300).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, drawn))


def test_one_document_gives_no_pairs(spark):
    one = spark.createDataFrame([(1, ["a"])], "doc_id bigint, words array<string>")
    assert pairs.jaccard_sample(one, 20).count() == 0


def test_sweep_matches_single_settings(spark, documents):
    from nearkin.operators import lsh
    from nearkin.operators.ranking import as_queries
    from nearkin.plans.features import lsh_features

    tokens = tokens_of(documents)
    sample = query_sample(documents, 20)
    asked = words_of(rows_of(tokens, sample)).withColumnRenamed("doc_id", "qid")
    truth = search.jaccard_topk(words_of(tokens), asked)
    settings = [(32, 0.45), (64, 0.3)]
    table = sweep.lsh_sweep(tokens, sample, truth, settings=settings)
    got = {(r["num_perm"], r["threshold"]): r["recall"] for r in table.collect()}
    for n, t in settings:
        def keyed(df):
            return lsh_features(df, n, t, 3)
        found = lsh.lsh_topk(keyed(tokens), as_queries(keyed(rows_of(tokens, sample))))
        recall = evaluate.method_recall({"lsh": evaluate.recall_per_query(sample, truth, found)}).first()["recall"]
        assert got[n, t] == pytest.approx(recall)
    times = sweep.sweep_times(tokens, sample, settings=settings).collect()
    assert {(r["num_perm"], r["threshold"]) for r in times} == set(settings)
    assert all(r["lookup_time"] > 0 and r["avg_time"] > 0 for r in times)
    fixed = spark.createDataFrame([("flat", 1.0)], "method string, recall double")
    both = sweep.with_fixed_methods(table, fixed, settings)
    assert both.count() == 4
    series = {(r["method"], r["num_perm"]): r for r in sweep.sweep_series(both, (0.3, 0.45)).collect()}
    assert series["flat", 32]["recall_45"] == 1.0 and series["flat", 32]["recall_30"] is None


def test_pipeline(spark, documents, tmp_path):
    config = PipelineConfig(lsi_dims=16, pq_ks=16, pq_rounds=2, num_perm=32, n_queries=20, max_docs=120, power_steps=2, pq_normalize=True)
    metrics = {r["method"]: r for r in run_pipeline(spark, documents, config, str(tmp_path)).collect()}
    assert set(metrics) == {"pq", "lsh", "flat"}
    assert metrics["flat"]["recall"] == 1.0
    assert all(0 <= r["recall"] <= 1 and r["avg_time"] > 0 and r["n_queries"] == 20 for r in metrics.values())
    saved = spark.read.json(f"{tmp_path}/metrics")
    assert saved.count() == 3
    assert spark.read.parquet(f"{tmp_path}/tokens").count() == 120
    assert spark.read.parquet(f"{tmp_path}/bands").select(F.countDistinct("doc_id")).first()[0] == 120


def test_saved_indices_are_measured_again(spark, documents, tmp_path):
    config = PipelineConfig(lsi_dims=16, pq_ks=16, pq_rounds=1, num_perm=32, n_queries=20, max_docs=80, power_steps=1)
    first = {r["method"]: r["recall"] for r in run_pipeline(spark, documents, config, str(tmp_path)).collect()}
    again = evaluate_indices(spark, str(tmp_path), ("flat", "lsh"), n_queries=20).collect()
    assert {r["method"]: r["recall"] for r in again} == {m: first[m] for m in ("flat", "lsh")}
    assert evaluate_indices(spark, str(tmp_path), ("flat",), k=3, n_queries=7).first()["n_queries"] == 7
    with pytest.raises(ValueError, match="unknown"):
        evaluate_indices(spark, str(tmp_path), ("graph",))
    with pytest.raises(ValueError, match="multiple"):
        run_pipeline(spark, documents, PipelineConfig(lsi_dims=15, pq_ks=16, max_docs=80), f"{tmp_path}/odd")


def test_run_with_all_methods_and_one_of_our_own(spark, documents, tmp_path):
    from nearkin.operators.ranking import rank_topk
    from nearkin.plans.methods import METHODS, Method

    config = PipelineConfig(lsi_dims=16, pq_ks=16, pq_rounds=2, num_perm=32, n_queries=15, max_docs=90, power_steps=1, n_bits=3, cells=4, nprobe=4,
                            methods=("pq", "lsh", "flat", "hyperplane", "ivf", "cells"), basis="shingle", threshold=0.3)
    metrics = {r["method"]: r for r in run_pipeline(spark, documents, config, str(tmp_path)).collect()}
    assert set(metrics) == set(METHODS)
    assert metrics["flat"]["recall"] == metrics["ivf"]["recall"] == metrics["cells"]["recall"] == 1.0  # all cells are probed
    assert 0 < metrics["cells"]["n_candidates"] <= 15 * 89
    assert metrics["flat"]["n_candidates"] == metrics["pq"]["n_candidates"] == metrics["ivf"]["n_candidates"] == 15 * 89
    assert 0 < metrics["hyperplane"]["n_candidates"] < 15 * 89 and 0 < metrics["hyperplane"]["recall"] < 1
    assert all(0 < r["lookup_time"] <= r["avg_time"] for r in metrics.values())
    assert all(metrics[m]["lookup_time"] < metrics[m]["avg_time"] for m in ("lsh", "hyperplane"))

    def ids_in_order(saved, sample, k):
        pairs = sample.crossJoin(saved.table("embeddings").select("doc_id")).filter("qid <> doc_id")
        return rank_topk(pairs.withColumn("score", -F.col("doc_id").cast("double")), k)

    own = evaluate_indices(spark, str(tmp_path), {"first": Method("cosine", ids_in_order)}, n_queries=15).collect()
    assert [(r["method"], r["n_queries"], r["n_candidates"]) for r in own] == [("first", 15, None)] and 0 < own[0]["recall"] < 1


def test_run_on_word_vectors(spark, documents, tmp_path):
    config = PipelineConfig(embedding="w2v", lsi_dims=8, n_queries=10, max_docs=60, methods=("flat",), w2v_epochs=1, num_perm=16)
    assert run_pipeline(spark, documents, config, str(tmp_path)).first()["recall"] == 1.0
    assert spark.read.parquet(f"{tmp_path}/embeddings").selectExpr("size(embedding) as n").distinct().collect() == [(8,)]
    for odd in ({"embedding": "x"}, {"basis": "x"}, {"methods": ("x",)}):
        with pytest.raises(ValueError, match="unknown"):
            run_pipeline(spark, documents, PipelineConfig(**odd), f"{tmp_path}/odd")


def test_timed_settings_read_their_own_keys_and_words_once(spark, monkeypatch):
    """The timed table has a row for each document, with the keys that the settings have as rows of their own."""
    df = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["b"]), (3, [])], "doc_id bigint, tokens array<string>")
    settings, made = sweep.grid((16, 32), (0.45, 0.65)), []
    monkeypatch.setattr(sweep, "written", lambda t, write=sweep.written: made.append(t.columns) or write(t))
    wide = {r.doc_id: r for r in sweep._side_by_side(df, settings, 3).collect()}
    rows = sweep.sweep_features(df, settings, 3).collect()
    assert len(wide) == 3 and len(rows) == 12
    assert all(wide[r.doc_id][f"keys_{r.setting}"] == r["keys"] and wide[r.doc_id].words == r.words for r in rows)
    sample = spark.createDataFrame([(1,), (2,)], "qid bigint")
    times = sweep.sweep_times(df, sample, 2, settings, 3).collect()
    assert [(t.num_perm, t.threshold) for t in times] == settings and all("setting" not in columns for columns in made)


@pytest.mark.parametrize("basis", ["token", "shingle"])
def test_features_shuffle_the_smaller_sets(spark, basis):
    """Shingles repeat every token, so they were the most that a run put on disk."""
    config = pipeline.PipelineConfig(basis=basis, shingle_n=2)
    tokens = spark.createDataFrame([(1, ["a", "b", "a", "b"]), (2, []), (3, ["c"])], "doc_id bigint, tokens array<string>")
    keyed = spark.createDataFrame([(1, [7]), (2, [8]), (3, [9])], "doc_id bigint, keys array<bigint>")
    found = pipeline._features(keyed, tokens, config)
    assert set(found.columns) == {"doc_id", "words", "keys"}
    sets = {r.doc_id: sorted(r.words) for r in found.collect()}
    assert sets == {1: ["a", "b"] if basis == "token" else ["a b", "b a"], 2: [], 3: ["c"]}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.index("array_distinct") < plan.index("Join")) == (basis == "shingle")


def test_a_run_packs_its_lists_of_words(spark, documents, tmp_path):
    write_tokens(tokens_of(documents), str(tmp_path / "tokens"))
    assert list((tmp_path / "tokens").glob("*.zstd.parquet"))
