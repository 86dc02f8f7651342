"""Byte-level BPE with the tokenizers library, whole Arrow batches at a time.

The vocabulary comes as a rank file (one base64 token and its rank a line); its path is a parameter. Ranks
order the merges: of all neighbouring pairs whose joined bytes are a token, the lowest rank is joined first.
Every way to cut a token in two tokens is therefore a merge.

Defined results: null and empty texts have no tokens; rows that repeat are encoded again; text that looks like a
special token is ordinary text; unknown ids in decoding raise.
"""

from __future__ import annotations

import base64
import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from nearkin.llm.arrays import slices, text_bytes, tidy

#: Bytes that stand for themselves as characters: the printable ones of Latin-1.
PRINTABLE = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))


#: Encoded pieces a worker remembers; beyond this it starts anew, which changes nothing but speed.
KNOWN_PIECES = 300_000


def byte_characters() -> list[str]:
    """The character for each byte: itself where printable, else the next free one from U+0100 on."""
    free = iter(range(0x100, 0x200))
    return [chr(b) if b in PRINTABLE else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Codec:
    """Encoder and decoder of one rank file, with tables by id."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer, models, pre_tokenizers

        ranks = read_ranks(path)
        to_char = byte_characters()
        shown = {token: "".join(map(to_char.__getitem__, token)) for token in ranks}
        merges = [
            (shown[token[:i]], shown[token[i:]])
            for token in sorted(ranks, key=ranks.get)
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        model = models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, cache_capacity=0)
        self.tokenizer = Tokenizer(model)
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pieces = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        from_char = {c: b for b, c in enumerate(to_char)}
        self.token = {rank: bytes(map(from_char.__getitem__, shown[t])) for t, rank in ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.token}
        self.length = np.zeros(max(self.token) + 1, np.int64)
        self.length[list(self.token)] = [len(t) for t in self.token.values()]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts. Each piece that the pattern cuts out is encoded by itself, and once while it is known."""
        cut = [self.pieces(t) for t in texts]
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        new = list({p for row in cut for p in row}.difference(self.known))
        for at in range(0, len(new), 20_000):
            some = new[at: at + 20_000]
            found = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.known.update(zip(some, (array("i", e.ids).tobytes() for e in found)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, row)), np.int32) for row in cut]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the tokens; a character may be split over several tokens, so only the whole is text."""
        return b"".join(map(self.token.__getitem__, ids))

    def offsets(self, ids: list[int], text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-last character of each token; a token that holds part of a character spans all of it."""
        last = np.cumsum(self.length[ids])
        character = np.cumsum((text & 0xC0) != 0x80)  # of each byte, from 1
        return character[last - self.length[ids]] - 1, character[last - 1]


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = (),
    offsets: bool = False, ids: bool = True, digests: bool = False,
) -> DataFrame:
    """One row per row of df: the columns `keep`, n_tokens, and as asked for
    ids (with `offsets` also starts and ends, in characters), or the digests ids_sha256 and decoded_sha256,
    for which the ids are decoded again.
    """
    kept = df.select(text_col, *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:]] + ["n_tokens bigint"]
    fields += ["ids array<int>"] * ids + ["starts array<int>", "ends array<int>"] * offsets
    fields += ["ids_sha256 string", "decoded_sha256 string"] * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        code.known.clear()
        for batch in batches:
            for piece in slices(batch, 0, 1 << 20):
                rows = code.encode([t or "" for t in piece.column(0).to_pylist()])
                columns = [*piece.columns[1:], pa.array(map(len, rows), pa.int64())]
                if ids:
                    bound = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
                    columns.append(pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(np.concatenate(rows))))
                if offsets:
                    data, bound = text_bytes(piece.column(0))
                    spans = [code.offsets(r, data[bound[i]: bound[i + 1]]) for i, r in enumerate(rows)]
                    columns += [pa.array([s[k] for s in spans], pa.list_(pa.int32())) for k in (0, 1)]
                if digests:
                    rows = [r.tolist() for r in rows]
                    columns.append(pa.array([
                        hashlib.sha256(" ".join(map(code.decimal.__getitem__, r)).encode()).hexdigest() for r in rows
                    ], pa.string()))
                    columns.append(pa.array([hashlib.sha256(code.decode(r)).hexdigest() for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0].strip("`") for f in fields])
        code.known.clear()

    return kept.mapInArrow(tidy(run), ", ".join(fields))


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of df: the columns `keep`, and `text`: the ids' bytes read as UTF-8.

    What is cut off inside a character becomes U+FFFD. Null ids give null.
    """
    kept = df.select(ids_col, *keep)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:]] + ["text string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        for batch in batches:
            texts = [None if r is None else code.decode(r).decode("utf-8", "replace") for r in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string())], names=[f.split()[0].strip("`") for f in fields]
            )

    return kept.mapInArrow(run, ", ".join(fields))
