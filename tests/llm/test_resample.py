import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import LOWER, frame, odd_rows
from pyspark.sql import functions as F

from nearkin.llm import cutting, resample


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features(text, n):
    w = words(text)
    return [" ".join(w[i: i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute_force(rows, target, percent=25, n=2, buckets=10_000, min_words=20, seed=7):
    """rows: (id, text); gives (id, n_features, weight, score, rank)."""
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for text in texts for f in features(text, n))

    s, t = counts(x for _, x in rows), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(all_s + buckets) / (float(s[b] + 1) * float(all_t + buckets)))) for b in range(buckets)]
    scored = []
    for i, text in rows:
        own = [gain[zlib.crc32(f.encode()) % buckets] for f in features(text, n)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    able = sorted((x for x in scored if x[4] >= min_words), key=lambda x: (-x[3], -1 if x[0] is None else x[0]))
    drawn = percent * len(able) // 100
    out = [(*x[:4], i + 1 if i < drawn else None) for i, x in enumerate(able)]
    return sorted(out + [(*x[:4], None) for x in scored if x[4] < min_words], key=str)


def outcome(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


TARGET = ["w1 w2 w3\nw4", None, "", "w1 w2 again Again AGAIN", "É ß changed", "w1 w2 " * 40]


@pytest.mark.parametrize("n, buckets", [(1, 50), (2, 10_000), (3, 97)])
def test_like_brute_force(spark, n, buckets):
    rows = odd_rows()
    rows += [(5000 + i, "w1 w2\n\n  \nw3\n" * 9 + "w4" * 90 + "\n" + "w5" * 70 + " w6\r\nw7", "en", None, None, None, None, None) for i in range(3)]
    target = spark.createDataFrame([(x,) for x in TARGET], "text string")
    found = resample.importance_resample(frame(spark, rows), target, n=n, buckets=buckets)
    assert outcome(found) == brute_force([(r[0], r[1]) for r in rows], TARGET, n=n, buckets=buckets)


def test_extra_and_clashing_columns_stay(spark):
    rows = [(i, "a b c " * 10, 1.5, 2, "x") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, weight double, rank int, _row string")
    found = resample.importance_resample(df, df.where("false"), percent=50)
    assert found.columns == ["doc_id", "weight", "rank", "_row", "n_features", "_weight", "score", "_rank"]
    assert {(r.weight, r.rank, r._row) for r in found.collect()} == {(1.5, 2, "x")}
    assert sorted(r["_rank"] for r in found.where("_rank is not null").collect()) == [1, 2, 3, 4]


def test_empty_tables_and_no_eligible_document(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert resample.importance_resample(df.where("false"), df).count() == 0
    assert outcome(resample.importance_resample(df, df.where("false"))) == brute_force([(1, "a b"), (2, None)], [])


def test_one_line_and_one_id_in_a_third_of_all_rows(spark):
    rng = random.Random(4)
    rows = [(7 if i % 3 == 0 else i, "the same line of all\n" * 4 + " ".join(rng.choice("abcdefgh") for _ in range(15))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    target = spark.createDataFrame([("a b a b same line",)], "text string")
    found = resample.importance_resample(df, target, percent=60).select("doc_id", "score", "rank").collect()
    expected = brute_force(rows, ["a b a b same line"], percent=60)
    assert sorted((r.doc_id, r.score) for r in found) == sorted((x[0], x[3]) for x in expected)
    places = sorted((r.rank, r.score) for r in found if r.rank)
    assert [p for p, _ in places] == list(range(1, 181)) and [-s for _, s in places] == sorted(-s for _, s in places)


def test_checksums_of_joined_words():
    texts = ["a", "abc def", "x" * 64 + " " + "y" * 65, "z" * 1000 + " ß " + "q" * 63]
    spans = cutting.cut(pa.array(texts), resample.SEPARATORS)
    own = resample.word_checksums(spans)
    plain = [w for t in texts for w in words(t)]
    assert own.tolist() == [zlib.crc32(w.encode()) for w in plain]
    front, at = own[:-1], np.arange(1, len(own))
    assert resample.joined(front, spans, own, at).tolist() == [zlib.crc32(f"{a} {b}".encode()) for a, b in zip(plain, plain[1:])]


def test_distinct_lines_are_counted_once(spark):
    """The number of lines that reach the feature step is the number of distinct ones."""
    df = spark.createDataFrame([("p q\nr s",), ("p q\nr s",), ("r s\np q",)], "text string").repartition(3)
    got = resample.bucket_counts(df, "text", 2, 10_000)
    expected = Counter(zlib.crc32(f.encode()) % 10_000 for t in ["p q r s", "p q r s", "r s p q"] for f in features(t, 2))
    assert {int(b): int(got[b]) for b in np.flatnonzero(got)} == expected
    assert df.select(F.explode(F.split("text", "\n"))).distinct().count() == 2
