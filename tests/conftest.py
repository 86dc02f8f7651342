import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from nearkin.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, "tests")


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").repartition(4)


@pytest.fixture(scope="session")
def vectors(spark):
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    return table.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("vector"))
