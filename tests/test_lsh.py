import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearkin.functions import kernels
from nearkin.functions.banding import best_bands
from nearkin.operators import lsh
from nearkin.operators.ranking import as_queries, query_sample, rows_of
from nearkin.plans.features import lsh_features, tokens_of

WORDS = [f"w{i}" for i in range(40)]


@pytest.mark.parametrize("num_perm, pairs", [
    (128, [(25, 5), (21, 6), (18, 7), (16, 8), (9, 13)]),
    (256, [(47, 5), (36, 7), (32, 8), (28, 9), (17, 15)]),
    (512, [(85, 6), (64, 8), (56, 9), (51, 10), (28, 18)]),
])
def test_best_bands(num_perm, pairs):
    assert [best_bands(t, num_perm) for t in (0.45, 0.55, 0.60, 0.65, 0.80)] == pairs


def plain_signature(tokens, n, a, b):
    p = kernels.MERSENNE_31
    number = {w: int(kernels.word_numbers(pa.array([w]))[0]) for w in set(tokens)}
    runs = [tokens] if 0 < len(tokens) < n else [tokens[i:i + n] for i in range(len(tokens) - n + 1)]
    folded = []
    for run in runs:
        h = 1
        for w in run:
            h = (h * kernels.SHINGLE_BASE + number[w]) % p
        folded.append(h)
    return [min(((x * y + z) % p for x in folded), default=p) for y, z in zip(a, b)]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=12), min_size=1, max_size=8), st.integers(1, 5))
def test_signature_kernel(docs, n):
    a, b = kernels.minhash_constants(7)
    lists = pa.array(docs, pa.list_(pa.string()))
    lengths = np.array([len(d) for d in docs], np.int64)
    numbers, row = kernels.shingle_numbers(kernels.word_numbers(lists.flatten()), lengths, n)
    got = kernels.minhash(numbers, row, len(docs), np.array(a, np.uint64), np.array(b, np.uint64))
    assert got.tolist() == [plain_signature(d, n, a, b) for d in docs]


def sign(spark, docs, **options):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, tokens array<string>")
    return [r["signature"] for r in lsh.minhash_signatures(df, **options).orderBy("doc_id").collect()]


def test_signature_rules(spark):
    words = "one two three four five six seven".split()
    same, copy, empty, doubled = sign(spark, [words, words, [], words * 2], num_perm=16, shingle_n=1)
    assert same == copy == doubled
    assert empty == [2147483647] * 16


def test_longer_signature_starts_with_the_shorter(spark):
    docs = [WORDS[i:i + 9] for i in range(10)]
    assert [s[:32] for s in sign(spark, docs, num_perm=64)] == sign(spark, docs, num_perm=32)


def test_signature_estimates_jaccard(spark):
    rng = np.random.RandomState(1)
    docs = [rng.permutation(WORDS)[:25].tolist() for _ in range(30)]
    signatures = np.array(sign(spark, docs, num_perm=256, shingle_n=1))
    off = []
    for i in range(29):
        a, b = set(docs[i]), set(docs[i + 1])
        off.append(abs((signatures[i] == signatures[i + 1]).mean() - len(a & b) / len(a | b)))
    assert max(off) < 4 / np.sqrt(256) and np.mean(off) < 1.5 / np.sqrt(256)


def three_docs(spark):
    words = "alpha beta gamma delta epsilon zeta eta".split()
    rows = [(1, words), (2, words), (3, [w[::-1] for w in words])]
    return lsh_features(spark.createDataFrame(rows, "doc_id bigint, tokens array<string>"))


def test_copies_find_each_other(spark):
    keyed = three_docs(spark)
    pairs = {(r["qid"], r["doc_id"]) for r in lsh.lsh_candidates(keyed, as_queries(keyed)).collect()}
    assert pairs == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 3)}
    best = lsh.lsh_topk(keyed, as_queries(keyed)).orderBy("qid").collect()
    assert [(r["qid"], r["doc_id"], r["score"], r["rank"]) for r in best] == [(1, 2, 1.0, 1), (2, 1, 1.0, 1)]


def test_stats_of_three_documents(spark):
    stats = lsh.candidate_stats(lsh.candidate_counts(three_docs(spark))).first().asDict()
    assert stats["mean_candidates"] == pytest.approx(5 / 3)
    assert (stats["median_candidates"], stats["min_candidates"], stats["max_candidates"]) == (2, 1, 2)
    assert stats["share_none"] == 0 and stats["share_self_only"] == pytest.approx(1 / 3)


def brute_counts(keys):
    return {d: sum(any(x == y for x, y in zip(k, other)) for other in keys.values()) for d, k in keys.items()}


@pytest.mark.parametrize("heavy, hot_bands", [(1, 12), (3, 12), (10, 12), (1000, 12), (3, 0)])
def test_counts_with_hot_buckets(spark, heavy, hot_bands, monkeypatch):
    """A third of all rows shares buckets, partly as copies and partly as near copies. Sets are counted by inclusion and
    exclusion, or compared in blocks where that would be too many choices of bands."""
    monkeypatch.setattr(lsh, "SET_BLOCK", 16)
    monkeypatch.setattr(lsh, "MAX_HOT_BANDS", hot_bands)
    rng = np.random.RandomState(3)
    keys = {}
    for d in range(240):
        if d % 3 == 0:
            base = np.arange(5)
            changed = rng.rand(5) < 0.3
            keys[d] = np.where(changed, rng.randint(100, 130, 5), base).tolist()
        elif d % 3 == 1:
            keys[d] = [7, 7, 7, 7, 7] if d % 2 else rng.randint(0, 40, 5).tolist()
        else:
            keys[d] = rng.randint(0, 60, 5).tolist()
    df = spark.createDataFrame(list(keys.items()), "doc_id bigint, keys array<bigint>").repartition(4)
    counts = lsh.candidate_counts(df, heavy)
    expected = brute_counts(keys)
    assert sum(r["weight"] for r in counts.collect()) == len(keys)
    by_keys = {tuple(keys[r["gid"]]): r["n_candidates"] for r in counts.collect()}
    assert {d: by_keys[tuple(k)] for d, k in keys.items()} == expected
    stats = lsh.candidate_stats(counts).first()
    values = np.array(list(expected.values()))
    assert stats["mean_candidates"] == pytest.approx(values.mean())
    assert stats["median_candidates"] == np.median(values)
    assert (stats["min_candidates"], stats["max_candidates"]) == (values.min(), values.max())


def test_candidates_in_place_and_by_joins(spark, documents, monkeypatch):
    from nearkin.plans import scale

    tokens = tokens_of(documents)
    keyed = lsh_features(tokens, threshold=0.45, shingle_n=1)
    queries = as_queries(lsh_features(rows_of(tokens, query_sample(documents, 30)), threshold=0.45, shingle_n=1))
    pairs = sorted(map(tuple, lsh.lsh_candidates(keyed, queries).collect()))
    keys = {r["doc_id"]: r["keys"] for r in keyed.collect()}
    qids = [r["qid"] for r in queries.collect()]
    assert pairs == sorted((q, d) for q in qids for d in keys if any(x == y for x, y in zip(keys[q], keys[d])))
    best = lsh.lsh_topk(keyed, queries).orderBy("qid", "rank").collect()
    monkeypatch.setattr(lsh, "PAIRS_AT_ONCE", 100)
    assert sorted(map(tuple, lsh.lsh_candidates(keyed, queries).collect())) == pairs
    assert lsh.lsh_topk(keyed, queries).orderBy("qid", "rank").collect() == best
    monkeypatch.setattr(lsh, "MAX_BAND_QUERIES", 1)  # too many to send: joined on the buckets
    assert sorted(map(tuple, lsh.lsh_candidates(keyed, queries).collect())) == pairs
    monkeypatch.setattr(scale, "MAX_BROADCAST_ROWS", 1)
    monkeypatch.setattr(scale, "HEAVY_ROWS", 3)  # nearly all keys are heavy
    assert sorted(map(tuple, lsh.lsh_candidates(keyed, queries).collect())) == pairs
    assert lsh.lsh_topk(keyed, queries).orderBy("qid", "rank").collect() == best


def test_heavy_keys_are_sliced_and_others_are_not(spark, monkeypatch):
    from nearkin.plans import scale

    monkeypatch.setattr(scale, "HEAVY_ROWS", 50)
    left = spark.createDataFrame([("hot" if i % 3 else f"k{i}", i) for i in range(900)] + [(None, -1)], "key string, at int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k3", 3), ("none", 4), (None, 5)], "key string, v int")
    plain = sorted(map(tuple, left.join(right, ["key"]).collect()))
    assert sorted(map(tuple, scale.skew_join(left, right, ["key"], "at").collect())) == plain and len(plain) == 1201
    monkeypatch.setattr(scale, "HEAVY_ROWS", 10_000)
    assert sorted(map(tuple, scale.skew_join(left, right, ["key"], "at").collect())) == plain


def test_pairs_of_shared_bands_and_their_similarity():
    rng = np.random.default_rng(2)
    asked, keys = rng.integers(0, 6, (15, 4)), rng.integers(0, 6, (40, 4))
    query, row = kernels.BandIndex(asked).pairs(keys)
    assert list(zip(query.tolist(), row.tolist())) == [(q, r) for q in range(15) for r in range(40) if (asked[q] == keys[r]).any()]
    sets = [sorted({f"w{x}" for x in rng.integers(0, 12, rng.integers(0, 9))}) for _ in range(55)]
    scores = kernels.PairJaccard(pa.array(sets[:15], pa.list_(pa.string())))(query, row, pa.array(sets[15:], pa.list_(pa.string())))
    for q, r, score in zip(query, row, scores):
        a, b = set(sets[q]), set(sets[15 + r])
        assert score == (len(a & b) / len(a | b) if a | b else 0.0)
    assert len(kernels.BandIndex(asked).pairs(keys[:0])[0]) == 0


def test_band_hashes_tell_bands_apart():
    signatures = np.array([[1, 2, 3, 4, 9], [1, 2, 4, 3, 9], [2, 1, 3, 4, 8]])
    keys = kernels.band_hashes(signatures, 2, 2)
    assert keys.shape == (3, 2) and keys[0, 0] == keys[1, 0] != keys[2, 0] and keys[0, 1] == keys[2, 1] != keys[1, 1]


def test_shingle_basis_ranks_on_shingles(spark):
    rows = [(1, list("abcd")), (2, list("abcd")), (3, list("dcba"))]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")
    words = {r["doc_id"]: r["words"] for r in lsh_features(df, shingle_n=2, basis="shingle").collect()}
    assert words[1] == ["a b", "b c", "c d"]
    with pytest.raises(ValueError, match="basis"):
        lsh_features(df, basis="letters")


def test_examples_list_the_smallest_candidates(spark):
    rows = [(i, ["same", "old", "words"]) for i in range(30)]
    keyed = lsh_features(spark.createDataFrame(rows, "doc_id bigint, tokens array<string>"))
    shown = lsh.candidate_examples(keyed).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in shown] == list(range(20))
    assert all(r["candidates"] == list(range(10)) for r in shown)


def test_band_table(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 5])], "doc_id bigint, signature array<int>")
    assert [tuple(r) for r in lsh.band_table(df, 2, 2).collect()] == [(1, 0, "1-2"), (1, 1, "3-4")]


def test_minhash_at_the_edges_of_the_prime():
    """Numbers whose products fold to the prime itself, or to one less than twice the prime."""
    p = kernels.MERSENNE_31
    x = [0, 1, 2, (1 << 30) - 1, 1 << 30, p - 2, p - 1]
    pairs = [(1, 0), (1, p - 1), (p - 1, p - 1), (p - 1, 1), (2, 1)]
    a, b = (np.array(part, np.uint64) for part in zip(*pairs))
    got = kernels.minhash(np.array(x, np.uint64), np.arange(len(x)), len(x) + 1, a, b)
    assert got.dtype == np.int32 and got.tolist() == [[(v * f + s) % p for f, s in pairs] for v in x] + [[p] * len(pairs)]
