"""Small tables with every odd case, and brute-force results in plain Python."""

import hashlib
import random
import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _words string, shard int, text_len double"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def odd_rows(seed=3, n=60):
    """Texts with copies, near copies, shared passages, nulls, emptiness, odd spaces, one very long text; rows that repeat;
    columns named like those that operators use inside."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "A", "a\x1cb", "#", "ß"]

    def prose(k):
        return " ".join(rng.choice(vocabulary) for _ in range(k))

    passage, base = prose(60), prose(120).split()
    texts = [None, "", " \t\n\r\x0b\x0c", "one", "two words", "a b c d", "A B c D", "x y z v w", prose(19), prose(20)]
    texts += ["again " * 90, "line one here\n" * 6, "a b c a b c a b c", prose(30000), "p q " * 25]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2:
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
        elif kind < 0.4:
            texts.append(prose(rng.randrange(40)) + " " + passage + "\n" + prose(rng.randrange(40)))
        elif kind < 0.5:
            texts.append(rng.choice(texts))
        else:
            texts.append(prose(rng.randrange(150)))
    rows = [(i * 7 % 997, t, rng.choice(["en", None]), rng.choice(["s1", "s2", "s2", None]), None, "x", 1, None) for i, t in enumerate(texts)]
    rows.append((None, base and " ".join(base), "en", "s1", 3, None, None, None))
    rows.append((None, None, None, None, None, None, None, None))
    rows += [rows[20], rows[30], rows[30]]
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
