import math
import os
import re
import string
from collections import Counter, defaultdict

import numpy as np
import pytest

from nearkin.llm import lm, queries
from nearkin.plans.scale import SHUFFLE_CLEANUP

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TEXTS = [
    "the cat sat on the mat", "The cat sat", "a dog sat on a mat and the cat sat on the dog", None, "", "  \t\n",
    "one one one one two two three", "the mat\x1cx the", "x " * 300, "the cat sat on the mat", "dog cat dog cat mouse",
    "a b c d e f g h i j k", "a b a c a d a e", "É é E e",
]


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def brute_force(train, texts, order):
    """Modified Kneser-Ney by dictionaries, straight from the definition."""
    grams = {order: Counter()}
    for text in train:
        row = ["<s>"] * (order - 1) + tokens(text)
        for i in range(order - 1, len(row)):
            grams[order][tuple(row[i - order + 1: i + 1])] += 1
    for j in range(order - 1, 0, -1):
        grams[j] = Counter()
        for g, c in grams[j + 1].items():
            grams[j][g[1:]] += c if g[1] == "<s>" else 1
    words = Counter(t for text in train for t in tokens(text))
    d, followers = {}, {j: defaultdict(list) for j in grams}
    for j, counts in grams.items():
        d[j] = lm.discounts({f"n{i}": sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)})
        for gram, c in counts.items():
            followers[j][gram[:-1]].append(c)

    sums = {j: {c: (sum(x), sum(d[j][min(i, 3)] for i in x)) for c, x in rows.items()} for j, rows in followers.items()}

    def p(context, word, j):
        if j == 0:
            return 1 / (len(words) + 1)
        below = p(context[1:], word, j - 1)
        if context[len(context) - j + 1:] not in sums[j]:
            return below
        total, taken = sums[j][context[len(context) - j + 1:]]
        c = grams[j][(*context[len(context) - j + 1:], word)]
        return (max(c - d[j][min(c, 3)], 0) + taken * below) / total

    n, out = sum(words.values()), []
    for text in texts:
        own = tokens(text)
        row = ["<s>"] * (order - 1) + own
        total = sum(math.log10(p(tuple(row[i: i + order - 1]), row[i + order - 1], order)) for i in range(len(own)))
        base = sum(math.log10((words[t] + 1) / (n + len(words) + 1)) for t in own)
        out.append((len(own), sum(words[t] > 0 for t in own), base, total))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_follow_the_definition(spark, order):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(3)
    model = lm.train(df.where("doc_id % 4 <> 3"), order=order)
    found = {r.doc_id: r for r in lm.score(df, model, keep=("doc_id",)).collect()}
    expected = brute_force([t for i, t, _ in rows if i % 4 != 3], [t for _, t, _ in rows], order)
    for i, (n, known, base, total) in enumerate(expected):
        assert (found[i].n_tokens, found[i].n_known) == (n, known)
        assert found[i].base_score == pytest.approx(base, rel=1e-9)
        assert found[i].score == pytest.approx(total, rel=1e-9)


def test_frequent_contexts_are_spread_without_a_change(spark, documents):
    """On real texts contexts such as `the` pass the limit for one shard."""
    df = documents.limit(120)
    texts = [(r.doc_id, r.text) for r in df.collect()]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    model = lm.train(df, order=2)
    found = {r.doc_id: r.score for r in lm.score(df, model, keep=("doc_id",)).collect()}
    for (i, _), (_, _, _, total) in zip(texts, brute_force([t for _, t in texts], [t for _, t in texts], 2)):
        assert found[i] == pytest.approx(total, rel=1e-9)


def test_empty_training_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    model = lm.train(df.where("false"), order=2)
    assert [(r.n_tokens, r.n_known, r.score) for r in lm.score(df, model).collect()] == [(3, 0, 0.0)]
    assert lm.score(df.where("false"), model).count() == 0


def test_held_out_by_id(spark):
    import zlib

    ids = [*range(50), None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", lm.held_out("doc_id").alias("h"))
    assert {r.doc_id: r.h for r in df.collect()} == {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in ids}


def test_query_scores_by_more_than_one_word_of_context(spark, data, monkeypatch):
    made, train = [], lm.train

    def watched(*args, **options):
        made.append(train(*args, **options))
        return made[-1]

    monkeypatch.setattr(lm, "train", watched)
    queries.op5_lm_scoring(spark, data)
    assert made[0].order == 3


def test_kept_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b", 0.5, 7)], "doc_id bigint, text string, score double, n_tokens int")
    found = lm.score(df, lm.train(df, order=2), keep=("doc_id", "score", "n_tokens"))
    assert found.columns == ["doc_id", "score", "n_tokens", "_n_tokens", "n_known", "base_score", "_score", "perplexity"]
    row = found.first()
    assert (row.score, row.n_tokens, row["_n_tokens"], row.n_known) == (0.5, 7, 3, 3)


@pytest.mark.parametrize("size", [0, 1, 5, 5000])
def test_keys_without_their_first_bits_are_found(tmp_path, monkeypatch, size):
    monkeypatch.setattr(lm, "INDEXED", 1)
    rng = np.random.default_rng(size)
    keys = np.unique(np.concatenate([rng.integers(0, 2**64, size, np.uint64), np.arange(size // 5, dtype=np.uint64) + np.uint64(7 << 48),
                                     np.arange(size // 5, dtype=np.uint64) * np.uint64(1 << 14)]))
    counts = rng.integers(1, 1000, len(keys)).astype(np.uint64)
    lm.save_keys(str(tmp_path), "gram3-0", keys)
    lm.save_counts(str(tmp_path), "gram3-0-count", counts)
    asked = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 2**64, 100, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    (found,) = lm.Arrays(str(tmp_path)).find("gram3", np.zeros(len(asked), np.uint64), asked, ("count",))
    known = dict(zip(keys.tolist(), counts.tolist()))
    assert found.tolist() == [known.get(k, 0) for k in asked.tolist()]


@pytest.mark.parametrize("words", [3, 250, 70_000])
def test_packed_grams_come_back(words):
    rng = np.random.default_rng(words)
    width = (words + 1).bit_length() + 7 >> 3
    made = []
    for _ in range(3):  # rows of several tasks are joined
        ids = [rng.integers(0, words + 2, 400).astype(np.uint32) for _ in range(3)]
        made.append((rng.integers(0, 4, 400).astype(np.uint64), ids, rng.integers(1, 9, 400)))
    rows = [row for shard, ids, count in made for row in lm.packed_grams(shard, ids, count, width).to_pylist()]
    for number in range(4):
        parts = [b"".join(row[f"c{i}"] for row in rows if row["shard"] == number) for i in range(5)]
        ids, count = lm.unpacked_grams(parts, 3, width)
        expected = sorted(g for shard, own, n in made for *g, at in zip(*own, n, shard) if at == number)
        assert sorted(zip(*ids, count)) == [tuple(g) for g in expected]


def test_model_takes_little_disk(spark, documents, monkeypatch):
    """Contexts with one occurrence are grams of the order below and are not stored again; shuffles go with their queries."""
    folders = []
    made = lm.model_folder
    monkeypatch.setattr(lm, "model_folder", lambda spark: folders.append(made(spark)) or folders[-1])
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    lm.train(documents, order=3)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    files = {f: np.load(os.path.join(folders[0], f)) for f in os.listdir(folders[0])}
    grams = sum(len(v) for f, v in files.items() if re.fullmatch(r"gram[12]-\d+-key.npy", f))
    totals = [v for f, v in files.items() if re.fullmatch(r"context\d-\d+-total.npy", f)]
    assert all((v > 1).all() for v in totals) and sum(map(len, totals)) < grams / 2
    assert all(v.dtype == np.uint8 for f, v in files.items() if re.search(r"-(count|total|k\d).npy", f))
