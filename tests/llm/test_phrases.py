import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import LOWER, frame, odd_rows

from nearkin.llm import phrases


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute_force(rows, max_words=4, min_count=30, best=2000, percent=80, scale=2_000_000):
    """rows: (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) >= 2 and a >= min_count}
        kept = []
        for p, a in candidates.items():
            longer = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= percent * a for b in longer):
                continue
            score, k = min((scale * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, n=200):
    rng = random.Random(seed)
    vocabulary = ["new", "york", "city", "Hall", "the", "of", "É", "a-b", "x\x1cy", "ß"] + [f"w{i}" for i in range(30)]
    fixed = ["New York City Hall", "new york", "the the the the the", "of the", "city\tof", "É ß É ß"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))]
        out.append(("".join(p + rng.choice([" ", " ", " ", ". ", ",", "\n", "\t", "  "]) for p in parts), rng.choice(["en", "de", None, "e\nn"])))
    return out


@pytest.mark.parametrize("max_words, min_count, best", [(4, 30, 2000), (2, 5, 7), (3, 12, 25), (5, 3, 2000)])
def test_like_brute_force(spark, max_words, min_count, best, monkeypatch):
    monkeypatch.setattr(phrases, "RANGE_WORDS", 100)  # many ranges
    monkeypatch.setattr(phrases, "MAX_SHARDS", 3)  # several ranges a shard
    rows = texts(max_words)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    found = phrases.collocations(df, max_words=max_words, min_count=min_count, best=best)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = brute_force(rows, max_words, min_count, best)
    assert sorted(tuple(r) for r in found.collect()) == expected and len(expected) > 20


def test_odd_rows_with_small_filters(spark, monkeypatch):
    rows = odd_rows()
    monkeypatch.setattr(phrases, "SHARD_WORDS", 10)  # words over several files
    found = phrases.collocations(frame(spark, rows), min_count=20)
    assert sorted(tuple(r) for r in found.collect()) == brute_force([(r[1], r[2]) for r in rows], min_count=20)


def test_empty_tables_and_nothing_frequent(spark):
    df = spark.createDataFrame([("a b a b", "en"), (None, None), ("", "de")], "text string, lang string")
    assert phrases.collocations(df).count() == 0 and phrases.collocations(df.where("false")).count() == 0
    assert [tuple(r) for r in phrases.collocations(df, min_count=2).collect()] == [("en", 1, "a b", 2, 2, 2, 4, 1_000_000)]


def test_a_third_of_all_texts_are_one(spark):
    rows = [("one hot passage stands here. " * 5, "en") if i % 3 == 0 else (f"free text {i % 7} of {i % 5} words", "en") for i in range(600)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    assert sorted(tuple(r) for r in phrases.collocations(df).collect()) == brute_force(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 64), st.data())
def test_permutation_and_filters_lose_nothing(bits, data):
    top = (1 << bits) - 1
    keys = data.draw(st.lists(st.integers(0, top), min_size=1, max_size=50, unique=True))
    counts = data.draw(st.lists(st.one_of(st.integers(1, 300), st.integers(1, 2**63)), min_size=len(keys), max_size=len(keys)))
    mix = phrases.Permutation(bits)
    there = mix.apply(np.array(keys, np.uint64))
    assert mix.invert(there).tolist() == keys and int(there.max()) <= top and len(set(there.tolist())) == len(keys)
    key, count = phrases.added_up(there, np.array(counts, np.uint64))
    filter_ = phrases.filter_bytes(key, count, bits, data.draw(st.integers(0, min(bits, 12))))
    read = phrases.filter_entries(filter_)
    assert read[0].tolist() == key.tolist() and read[1].tolist() == count.tolist()
    assert dict(zip(mix.invert(read[0]).tolist(), read[1].tolist())) == dict(zip(keys, counts))


def test_filters_merge_and_are_compact():
    rng = np.random.default_rng(1)
    mix = phrases.Permutation(40)
    parts = [np.unique(mix.apply(rng.integers(0, 1 << 40, 50_000, dtype=np.uint64)), return_counts=True) for _ in range(3)]
    data = [phrases.filter_bytes(k, c.astype(np.uint64), 40, 15) for k, c in parts]
    assert max(len(d) for d in data) < 6 * 50_000  # a key and its count take 16 bytes as they are
    key, count = phrases.merged([*data, data[0]])
    plain = Counter()
    for k, c in [*parts, parts[0]]:
        plain.update(dict(zip(k.tolist(), c.tolist())))
    assert dict(zip(key.tolist(), count.tolist())) == plain and (np.diff(key.astype(object)) > 0).all()
    numbers = phrases.range_of(key, 40, 7)
    assert (np.diff(numbers) >= 0).all() and set(numbers.tolist()) == set(range(7))


def test_shares_are_exact_beyond_64_bits():
    rng = random.Random(2)
    for size in (10, 1 << 30, 1 << 45, 1 << 61):
        a = [rng.randrange(1, size) for _ in range(200)]
        whole = [x + rng.randrange(size) for x in a]
        found = phrases.exact_share(np.array(a, np.uint64), np.array(whole, np.uint64), 2_000_000)
        assert found.tolist() == [2_000_000 * x // y for x, y in zip(a, whole)]


def test_pieces_and_languages_keep_grams_apart():
    """A break or another row ends a piece; a key reads back to its words."""
    column, langs = pa.array(["a b, a b", "A b", None]), pa.array(["en", "en", "de"])
    words = phrases.cut(column, phrases.SEPARATORS)
    assert phrases.word_strings(words, np.arange(6)).to_pylist() == ["a", "b"] * 3
    assert len(set(phrases.word_keys(words, langs).tolist())) == 2
    assert phrases.word_keys(phrases.cut(pa.array(["a"]), phrases.SEPARATORS), pa.array(["de"]))[0] not in phrases.word_keys(words, langs)
