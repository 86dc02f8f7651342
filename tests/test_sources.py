import pytest

from nearkin.operators.lsh import band_table, minhash_signatures
from nearkin.plans.features import tokens_of
from nearkin.sources import metrics, tables, text
from nearkin.streaming.ingest import lsh_rows, start_ingest


def test_merge_csv(spark, tmp_path):
    (tmp_path / "a_movies.csv").write_text('a,b\n1,"x, ""y""\nnext line"\nNA,z\n')
    (tmp_path / "b_movies.csv").write_text("a,c\n2,w\n")
    (tmp_path / "all_movies.csv").write_text("a,c\n9,old\n")
    merged = text.merge_csv(spark, f"{tmp_path}/*movies*.csv", f"{tmp_path}/all_movies.csv")
    assert merged.columns == ["a", "b", "c"]
    rows = sorted(map(tuple, merged.collect()), key=repr)
    assert rows == sorted([("1", 'x, "y"\nnext line', None), (None, "z", None), ("2", None, "w")], key=repr)
    text.write_csv(merged, f"{tmp_path}/out")
    assert sorted(map(tuple, text.read_csv(spark, f"{tmp_path}/out").collect()), key=repr) == rows
    with pytest.raises(FileNotFoundError):
        text.merge_csv(spark, f"{tmp_path}/all_movies*.csv", f"{tmp_path}/all_movies.csv")
    with pytest.raises(ValueError):
        text.union_by_name([])


def test_merge_leaves_out_the_target_alone(spark, tmp_path):
    for name in ("a_movies.csv", "b_movies.csv", "movies.csv", "c+d e.csv"):
        (tmp_path / name).write_text(f"x\n{name}\n")
    for target in ("movies.csv", f"{tmp_path}/movies.csv", f"file://{tmp_path}/movies.csv"):
        names = sorted(r["x"] for r in text.merge_csv(spark, f"{tmp_path}/*.csv", target).collect())
        assert names == ["a_movies.csv", "b_movies.csv", "c+d e.csv"]


def test_many_files_make_few_branches(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.csv").write_text(f"{'a,b' if i % 2 else 'a'}\n{'1,2' if i % 2 else '1'}\n")
    merged = text.merge_csv(spark, f"{tmp_path}/*.csv")
    assert merged.columns == ["a", "b"] and (merged.count(), merged.filter("b is null").count()) == (300, 150)
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_headers_are_parsed_as_csv(spark, tmp_path):
    """Names that hold line breaks, commas and quotes, a mark in front, empty files, and the same header in two spellings."""
    (tmp_path / "1.csv").write_text('"x\ny",p\n1,2\n')
    (tmp_path / "2.csv").write_text('"x\nz",p\n3,4\n')
    (tmp_path / "3.csv").write_text('"a, ""b""",p\n5,6\n"q\nr",7\n')
    (tmp_path / "4.csv").write_bytes('\ufeff"x\ny","p"\n8,9\n'.encode())
    (tmp_path / "5.csv").write_text("")
    merged = text.merge_csv(spark, f"{tmp_path}/*.csv")
    assert merged.columns == ["x\ny", "p", "x\nz", 'a, "b"']
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted([
        ("1", "2", None, None), ("8", "9", None, None), (None, "4", "3", None), (None, "6", None, "5"), (None, "7", None, "q\nr")], key=repr)
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Relation") <= 4


def test_headers_in_a_store_that_only_spark_reads(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    (tmp_path / "1.csv").write_text('"x\ny",p\n1,2\n')
    (tmp_path / "2.csv").write_text('"x\nz",p\n3,4\n')
    monkeypatch.setattr(text, "headers_of", lambda files: files.select("path", F.lit(None).cast("array<string>").alias("header")))
    merged = text.merge_csv(spark, f"{tmp_path}/*.csv")
    assert merged.columns == ["x\ny", "p", "x\nz"] and merged.count() == 2


def test_text_column_is_required(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,body\n7,hello\n")
    with pytest.raises(ValueError, match="plot.*available.*body"):
        text.read_documents(spark, f"{tmp_path}/x.csv", "plot", "id", "csv")
    rows = text.read_documents(spark, f"{tmp_path}/x.csv", "body", "id", "csv").collect()
    assert [tuple(r) for r in rows] == [(7, "hello")]
    (tmp_path / "y.csv").write_text("body\n" + "hello\nhello\n,\nother\n")
    once = text.read_documents(spark, f"{tmp_path}/y.csv", "body", None, "csv").collect()
    again = text.read_documents(spark, f"{tmp_path}/y.csv", "body", None, "csv").collect()
    assert len({r["doc_id"] for r in once}) == len(once) == 4 and sorted(map(repr, once)) == sorted(map(repr, again))


def test_tokens_round_trip(spark, documents, tmp_path):
    tokens = tokens_of(documents)
    text.write_tokens(tokens, f"{tmp_path}/tokens")
    back = text.read_tokens(spark, f"{tmp_path}/tokens")
    assert back.columns == ["doc_id", "tokens", "joined"]
    assert sorted(map(repr, back.select("doc_id", "tokens").collect())) == sorted(map(repr, tokens.collect()))


def test_tables_check_their_shape(spark, documents, tmp_path):
    signed = minhash_signatures(tokens_of(documents), 16)
    path = tables.signature_path(str(tmp_path), 16, 5)
    tables.write_table(signed, "signatures", path)
    assert tables.read_signatures(spark, path, 16).count() == documents.count()
    with pytest.raises(ValueError, match="do not have 32"):
        tables.read_signatures(spark, path, 32)
    with pytest.raises(ValueError, match="not found"):
        tables.read_table(spark, "codes", path)
    bands = band_table(signed, 4, 4)
    tables.write_table(bands, "bands", f"{tmp_path}/bands")
    one = tables.read_table(spark, "bands", f"{tmp_path}/bands").filter("band = 2")
    assert one.count() == documents.count()
    assert "PartitionFilters: [isnotnull(band" in one._jdf.queryExecution().toString()


def test_metrics(spark, tmp_path):
    metrics.save_metrics(spark, {"method": "pq", "recall": 0.5}, f"{tmp_path}/one")
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/one", header=True).collect()] == [("pq", "0.5")]
    metrics.save_metrics(spark, [{"a": 1}, {"a": 2, "b": 3}], f"{tmp_path}/two")
    rows = sorted(tuple(r) for r in spark.read.csv(f"{tmp_path}/two", header=True).fillna("-").collect())
    assert rows == [("1", "-"), ("2", "3")]
    metrics.write_json(spark.createDataFrame([("pq", 0.5)], "method string, recall double"), f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").first().asDict() == {"method": "pq", "recall": 0.5}


def test_stream_gives_the_batch_rows(spark, documents, tmp_path):
    documents.filter("doc_id < 100").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(documents.schema).parquet(f"{tmp_path}/in")
    settings = dict(num_perm=32, threshold=0.5, shingle_n=2)
    start_ingest(stream, f"{tmp_path}/out", f"{tmp_path}/state", **settings).awaitTermination()
    documents.filter("doc_id >= 100").write.mode("append").parquet(f"{tmp_path}/in")
    start_ingest(stream, f"{tmp_path}/out", f"{tmp_path}/state", **settings).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, lsh_rows(documents, **settings).collect()))
