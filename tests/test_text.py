import pytest
from pyspark.sql import functions as F

from nearkin.functions import text as T
from nearkin.operators import terms
from nearkin.operators.ranking import first_n, ids_at_places, query_sample, rows_of
from nearkin.plans.features import tokens_of


def one(spark, value, schema, *columns):
    return spark.createDataFrame([(value,)], schema).select(*columns).first()


@pytest.mark.parametrize("text, tokens", [
    (None, []),
    ("", []),
    ("a I x", []),
    ("Café-Bar 42!", ["caf", "bar", "42"]),
    ("The cat", ["cat"]),
    ("  Don't stop\tme now ", ["stop"]),
    ("x9 x9\nX9", ["x9", "x9", "x9"]),
])
def test_tokenize(spark, text, tokens):
    assert one(spark, text, "text string", T.tokenize(F.col("text")))[0] == tokens


def test_tokenize_with_other_stop_words(spark):
    assert one(spark, "the cat", "text string", T.tokenize(F.col("text"), ["cat"]))[0] == ["the"]
    assert one(spark, "the cat", "text string", T.tokenize(F.col("text"), []))[0] == ["the", "cat"]


@pytest.mark.parametrize("tokens, expected", [
    ([], []),
    (["x", "y"], ["x y"]),
    (["x", "y", "z"], ["x y z"]),
    (["x", "y", "z", "w"], ["x y z", "y z w"]),
    (["x", "x", "x", "x"], ["x x x", "x x x"]),
])
def test_shingles(spark, tokens, expected):
    assert one(spark, tokens, "tokens array<string>", T.shingles(F.col("tokens"), 3))[0] == expected


def test_jaccard_of_arrays(spark):
    rows = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], []), ([], ["a"])], "l array<string>, r array<string>")
    assert [r[0] for r in rows.select(T.jaccard(F.col("l"), F.col("r"))).collect()] == [1 / 3, 0.0, 0.0]


def test_first_n(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1)], "doc_id bigint").repartition(3)
    assert sorted(r[0] for r in first_n(df, 3).collect()) == [1, 3, 5]
    assert first_n(df, 0).count() == first_n(df, None).count() == 4


def test_query_sample_does_not_depend_on_partitions(spark, documents):
    drawn = [r[0] for r in query_sample(documents, 20).collect()]
    assert len(set(drawn)) == 20
    assert drawn == [r[0] for r in query_sample(documents.repartition(7), 20).collect()]
    assert query_sample(documents, 10_000).count() == documents.count()


def test_rows_of(spark, documents):
    sample = query_sample(documents, 5)
    assert {r["doc_id"] for r in rows_of(documents, sample).collect()} == {r["qid"] for r in sample.collect()}


def test_ids_at_places_names_every_id_once(spark, documents):
    n = documents.count()
    places = spark.range(n).withColumnRenamed("id", "place")
    found = ids_at_places(documents, places).collect()
    assert sorted(r["_id"] for r in found) == sorted(r["doc_id"] for r in documents.collect())
    assert sorted(r["place"] for r in found) == list(range(n))


def test_tfidf_matches_the_formula(spark):
    import math

    docs = spark.createDataFrame([(1, "cat dog cat"), (2, "dog bird"), (3, "")], "doc_id bigint, text string")
    counts = terms.term_counts(tokens_of(docs))
    vocab = terms.vocabulary(counts)
    assert [r["term"] for r in vocab.collect()] == ["cat", "dog", "bird"]
    found = {(r["doc_id"], r["term"]): r["tfidf"] for r in terms.tfidf(tokens_of(docs), vocab, 3).collect()}
    idf = {"cat": math.log(4 / 2) + 1, "dog": math.log(4 / 3) + 1, "bird": math.log(4 / 2) + 1}
    length = math.hypot(2 * idf["cat"], idf["dog"])
    assert found[1, "cat"] == pytest.approx(2 * idf["cat"] / length)
    assert found[1, "dog"] == pytest.approx(idf["dog"] / length)
    assert sum(v * v for (d, _), v in found.items() if d == 2) == pytest.approx(1)
    rows, names = terms.tfidf_rows(tokens_of(docs), vocab, 3)
    sparse = {(r["doc_id"], names[i]): v for r in rows.collect() for i, v in zip(r["idx"], r["val"])}
    assert sparse == pytest.approx(found)


def test_vocabulary_cut_drops_rare_terms(spark):
    docs = spark.createDataFrame([(1, "cat dog cat"), (2, "dog bird")], "doc_id bigint, text string")
    counts = terms.term_counts(tokens_of(docs))
    vocab = terms.vocabulary(counts, 2)
    assert {r["term"] for r in terms.tfidf(tokens_of(docs), vocab, 2).collect()} == {"cat", "dog"}
