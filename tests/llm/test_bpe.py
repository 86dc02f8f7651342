import random

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from llm_helpers import frame, odd_rows, sha
from nearkin.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_ids_digests_and_round_trip(spark):
    rows = odd_rows()
    df = frame(spark, rows)
    own = reference()
    found = bpe.encode(df, PATH, PATTERN, keep=("doc_id", "text"), digests=True)
    for r in found.collect():
        ids = own.encode_ordinary(r.text or "")
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.ids_sha256 == sha(" ".join(map(str, ids))) and r.decoded_sha256 == sha(r.text or "")
    back = bpe.decode(found.select("ids", F.col("text").alias("before")), PATH, PATTERN, keep=("before",))
    assert all(r.text == (r.before or "") for r in back.collect())
    assert bpe.encode(df.where("false"), PATH, PATTERN).count() == 0


def test_random_strings_like_the_reference_encoder():
    rng, own, code = random.Random(7), reference(), bpe.codec(PATH, PATTERN)
    letters = [*"abehtTHE.,!? 0123\n\t'", " the", "  ", "é", "中", "\U0001f600", "<|endoftext|>", "'ll", "\x85", "\xa0", "\x1c", "\u0301"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(3000)]
    assert [ids.tolist() for ids in code.encode(texts)] == [own.encode_ordinary(t) for t in texts]


def test_offsets_span_split_characters(spark):
    text = "a 中\U0001f600é b"
    (r,) = bpe.encode(spark.createDataFrame([(text,)], "text string"), PATH, PATTERN, offsets=True).collect()
    code = bpe.codec(PATH, PATTERN)
    at = 0
    for token, start, end in zip(r.ids, r.starts, r.ends):
        piece = code.token[token]
        place = len(text.encode()[:at].decode("utf-8", "ignore"))
        assert start == place and text[start:end].encode().find(piece) >= 0
        at += len(piece)
    assert r.ends[-1] == len(text)


def test_cut_characters_and_null_ids(spark):
    ids = reference().encode_ordinary("\U0001f600")
    assert len(ids) > 1
    df = spark.createDataFrame([(ids[:1],), (None,), ([],)], "ids array<int>")
    assert {r.text for r in bpe.decode(df, PATH, PATTERN).collect()} == {"\ufffd", None, ""}
