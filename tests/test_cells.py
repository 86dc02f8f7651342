import numpy as np
import pytest
from pyspark.sql import functions as F

from nearkin.operators import cells, pq, search
from nearkin.plans.scale import written
from nearkin.sources.tables import write_table


def clustered(spark, n=900, dim=16, centres=12, seed=3):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(centres, dim))[rng.integers(0, centres, n)] * 2 + rng.normal(size=(n, dim)) * 0.35
    rows[0] = 0  # a zero vector
    rows[5:9] = rows[4]  # copies
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(5000, None)]
    return spark.createDataFrame(data, "doc_id bigint, vector array<double>").repartition(4)


def answers(df):
    return [(r.qid, r["rank"], r.doc_id, pytest.approx(r.score, abs=1e-9)) for r in df.orderBy("qid", "rank").collect()]


def test_cells_that_cannot_matter_are_left_out(spark):
    df = clustered(spark)
    asked = df.filter("doc_id % 30 in (0, 5)").withColumnRenamed("doc_id", "qid")
    index = cells.build(df, 12, 4)
    found, looked = cells.exact_topk(index, asked, 10)
    assert answers(found) == answers(search.cosine_topk(df, asked, 10))
    compared = {r.qid: r.n_rows for r in cells.rows_compared(index, looked).collect()}
    assert compared[0] == 899  # nothing is far from a zero vector
    others = [n for q, n in compared.items() if q != 0]
    assert len(compared) == asked.count() and np.mean(others) < 0.4 * 900


def test_fewer_rows_than_k_and_single_cell(spark):
    df = clustered(spark, n=7, centres=2)
    asked = df.filter("vector is not null").withColumnRenamed("doc_id", "qid")
    for size in (1, 3):
        found, _ = cells.exact_topk(cells.build(df, size, 2), asked, 10)
        assert answers(found) == answers(search.cosine_topk(df, asked, 10))


def test_codes_of_residuals_and_files_of_probed_cells(spark, tmp_path):
    df = clustered(spark)
    index = cells.build(df, 12, 4)
    books = written(pq.train_codebooks(cells.residuals(index), 8, 32, 4))
    path = f"{tmp_path}/cells"
    cells.with_codes(index, books).write.partitionBy("cell").parquet(path)
    coded = spark.read.parquet(path)
    asked = df.filter("doc_id % 30 = 5").withColumnRenamed("doc_id", "qid")
    truth = {(r.qid, r.doc_id) for r in search.cosine_topk(df, asked, 10).collect()}
    shares = []
    for nprobe in (1, 3, 12):
        best = cells.reranked_topk(coded, index.centres, books, asked, 10, nprobe, refine=8).collect()
        shares.append(len({(r.qid, r.doc_id) for r in best} & truth) / len(truth))
    assert shares[0] <= shares[1] + 0.02 and shares[1] >= 0.9 and shares[2] >= 0.9
    # every score is exact: the last step ranks by vectors
    plain = {r.doc_id: np.array(r.vector) for r in df.filter("vector is not null").collect()}
    for r in best:
        a, b = plain[r.qid], plain[r.doc_id]
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    one = cells.coded_topk(coded, index.centres, books, written(cells.ivf.probes(asked.limit(1), index.centres, 2)), 10)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan and "ReadSchema: struct<doc_id:bigint,codes:array<int>>" in plan


def test_saved_cells_give_the_same_index(spark, tmp_path):
    df = clustered(spark, n=200)
    index = cells.build(df, 4, 2)
    write_table(index.placed, "cells", f"{tmp_path}/placed")
    again = cells.index_of(spark.read.parquet(f"{tmp_path}/placed").select("doc_id", "vector", F.col("cell").cast("int")), index.centres)
    assert sorted(map(tuple, again.widths.collect())) == [pytest.approx(x) for x in sorted(map(tuple, index.widths.collect()))]
