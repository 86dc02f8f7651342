"""Every operator with extra columns named like all names it uses inside: none may crash or be lost."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from nearkin.llm import jaccard, mixing, quality, resample, sharding, substring

INNER = sorted({name for module in (jaccard, mixing, quality, resample, sharding, substring)
                for name in re.findall(r"""["']([a-z_]\w{0,14})["']""", Path(module.__file__).read_text())
                if name not in ("doc_id", "text", "source", "bigint", "int", "string", "double", "date", "left", "right", "inner", "shard", "slot")})


@pytest.fixture(scope="module")
def wide(spark):
    df = spark.createDataFrame([(i, "some words that are here again and again " * 4 + f"w{i}", "s") for i in range(12)], "doc_id bigint, text string, source string")
    return df.select("*", *[F.lit(f"own {name}").alias(name) for name in INNER])


OPERATORS = {
    "jaccard": lambda df: jaccard.jaccard_components(df),
    "substring": lambda df: substring.remove_repeats(df),
    "mixing": lambda df: mixing.temperature_mix(df, "source", F.lit(10), repetition_limit=2.0).rows,
    "quality": lambda df: quality.quality_filter(df),
    "sharding": lambda df: sharding.shuffled_shards(df, sharding.size_of(F.col("text")), shards=3),
    "resample": lambda df: resample.importance_resample(df, df.select("text")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_extra_columns_of_any_name_stay(wide, name):
    assert len(INNER) > 60
    found = OPERATORS[name](wide)
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    rows = found.collect()
    assert len(rows) == (12 if name != "quality" else len(rows)) and rows or name == "quality"
    for r in rows:
        assert all(r[n] == f"own {n}" for n in INNER)
