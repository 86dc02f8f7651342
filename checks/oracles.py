"""The registered queries as SQL over the same tables, put together from named parts."""

from __future__ import annotations

from checks import settings as S
from nearkin.functions.banding import best_bands
from nearkin.functions.kernels import MERSENNE_31 as P
from nearkin.functions.kernels import SHINGLE_BASE as BASE
from nearkin.functions.kernels import hyperplanes
from nearkin.functions.text import ENGLISH_STOP_WORDS
from nearkin.operators.pairs import PERCENTS
from nearkin.operators.skipgram import EPS, FACTOR, FOLD, PRIME, START
from nearkin.plans.sweep import THRESHOLDS, grid


def md5_number(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def md5_order(column: str) -> str:
    return f"md5({column}::VARCHAR), {column}"


def round_list(column: str) -> str:
    return f"list_transform({column}, lambda y: round(y, 6) + 0.0)"  # no negative zeros


def significant(score: str) -> str:
    """A score cut to nine significant digits."""
    power = f"pow(10.0::DOUBLE, floor(log10(abs({score}))))"
    return f"(CASE WHEN {score} = 0 THEN {score} ELSE round({score} / {power}, 8) * {power} END)"


def select(parts: list[str], body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


# ------------------------------------------------------------------ text

STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)
CLEAN = "trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g'))"
TOK = f"""tok AS (SELECT doc_id,
  list_filter(string_split({CLEAN}, ' '), lambda w: length(w) >= 2 AND w NOT IN ({STOP})) AS tokens
  FROM documents)"""
WORDS = "words AS (SELECT doc_id, list_sort(list_distinct(tokens)) AS words FROM tok)"
TERMS = "terms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM tok) GROUP BY ALL)"
VOCAB = f"""vocab AS (SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM terms GROUP BY term
  ORDER BY total DESC, term LIMIT {S.MAX_FEATURES})"""
TFIDF = """weighted AS (SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
  FROM terms JOIN vocab USING (term)),
lengths AS (SELECT doc_id, sqrt(sum(w * w)) AS length FROM weighted GROUP BY doc_id)"""


def sample(name: str, table: str, column: str, n: int) -> str:
    return f"{name} AS (SELECT {column} AS qid FROM {table} ORDER BY {md5_order(column)} LIMIT {n})"


DOC_SAMPLE = sample("doc_sample", "documents", "doc_id", S.N_QUERIES)
VEC_SAMPLE = sample("vec_sample", "embeddings", "vec_id", S.N_QUERIES)


# ------------------------------------------------------------------ LSI

LSI_ROUNDS = 700


def power_iteration(number: int, matrix: str) -> list[str]:
    """u<n>: the leading eigenvector of a symmetric matrix given as rows (r, row), and the matrix without it."""
    return [
        f"""it{number}(i, v) AS (SELECT 0, list(1.0::DOUBLE + r % 7 ORDER BY r) FROM {matrix} UNION ALL
  SELECT i + 1, list_transform(y, lambda e: e / size) FROM (SELECT i, y, sqrt(list_dot_product(y, y)) AS size FROM (
  SELECT i, list(list_dot_product(row, v) ORDER BY r) AS y FROM it{number}, {matrix} WHERE i < {LSI_ROUNDS} GROUP BY i)))""",
        f"u{number} AS MATERIALIZED (SELECT v FROM it{number} WHERE i = {LSI_ROUNDS})",
        f"""l{number} AS MATERIALIZED (SELECT list_dot_product(v, list(list_dot_product(row, v) ORDER BY r)) AS value FROM {matrix}, u{number} GROUP BY v)""",
        f"""g{number + 1} AS MATERIALIZED (SELECT r, list_transform(list_zip(row, v), lambda x: x[1] - value * v[r] * x[2]) AS row
  FROM {matrix}, u{number}, l{number})""",
        f"""d{number} AS (SELECT doc_id, v[r] * sqrt(value) * (SELECT CASE WHEN arg_max(x, abs(x)) < 0 THEN -1 ELSE 1 END FROM (
  SELECT sum(w * v[r]) AS x FROM unit_weights JOIN places USING (doc_id), u{number} GROUP BY term)) AS x FROM places, u{number}, l{number})""",
    ]


LSI = [TOK, TERMS, VOCAB, TFIDF,
       "unit_weights AS MATERIALIZED (SELECT doc_id, term, w / length AS w FROM weighted JOIN lengths USING (doc_id))",
       "places AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM (SELECT DISTINCT doc_id FROM unit_weights))",
       "near AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.w * b.w) AS g FROM unit_weights a JOIN unit_weights b USING (term) GROUP BY ALL)",
       """g1 AS MATERIALIZED (SELECT x.r, list(coalesce(g, 0) ORDER BY y.r) AS row FROM places x CROSS JOIN places y
  LEFT JOIN near ON a = x.doc_id AND b = y.doc_id GROUP BY x.r)""",
       *power_iteration(1, "g1"), *power_iteration(2, "g2"), *power_iteration(3, "g3")]

# ------------------------------------------------------------------ MinHash

def signature_parts(num_perm: int, n: int) -> list[str]:
    fold = "1"
    for step in range(n):
        fold = f"(({fold}) * {BASE} + t[i + {step}]) % {P}"
    return [
        f"""numbers AS (SELECT doc_id,
  list_transform(tokens, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {P}) AS t FROM tok)""",
        f"""shingled AS (SELECT doc_id, unnest(CASE WHEN len(t) = 0 THEN []::BIGINT[]
  WHEN len(t) < {n} THEN [list_reduce(list_prepend(1::BIGINT, t), lambda h, y: (h * {BASE} + y) % {P})]
  ELSE list_transform(range(1, len(t) - {n} + 2), lambda i: {fold}) END) AS x FROM numbers)""",
        f"""perms AS (SELECT i, 1 + {md5_number("'1:a:' || i")} % ({P} - 1) AS a,
  {md5_number("'1:b:' || i")} % {P} AS b FROM range({num_perm}) r(i))""",
        f"""minima AS (SELECT doc_id, i, min((a * x + b) % {P}) AS h FROM shingled, perms GROUP BY doc_id, i)""",
        f"""hashes AS (SELECT d.doc_id, p.i, coalesce(m.h, {P}) AS h
  FROM documents d CROSS JOIN perms p LEFT JOIN minima m ON m.doc_id = d.doc_id AND m.i = p.i)""",
    ]


BANDS, ROWS = best_bands(S.THRESHOLD, S.NUM_PERM)
SIGNATURE = [TOK, *signature_parts(S.NUM_PERM, S.SHINGLE_N)]
BAND_TABLE = [*SIGNATURE, f"""bands AS (SELECT doc_id, (i // {ROWS})::INTEGER AS band,
  string_agg(h::VARCHAR, '-' ORDER BY i) AS bucket FROM hashes WHERE i < {BANDS * ROWS} GROUP BY ALL)"""]
CANDIDATES = [*BAND_TABLE, DOC_SAMPLE, """cand AS (SELECT DISTINCT q.doc_id AS qid, c.doc_id
  FROM bands q JOIN bands c USING (band, bucket) WHERE q.doc_id IN (SELECT qid FROM doc_sample))"""]
JACCARD = """coalesce(len(list_intersect(a.words, b.words))::DOUBLE
  / nullif(len(a.words) + len(b.words) - len(list_intersect(a.words, b.words)), 0), 0)"""
LSH_TOPK = [*CANDIDATES, WORDS, f"""lsh_scored AS (SELECT qid, c.doc_id, {JACCARD} AS score
  FROM cand c JOIN words a ON a.doc_id = qid JOIN words b ON b.doc_id = c.doc_id WHERE qid <> c.doc_id)""",
    f"""lsh_found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INTEGER
  AS rank FROM lsh_scored) WHERE rank <= {S.K})"""]


def jaccard_parts(name: str, samples: str) -> list[str]:
    return [
        "listed AS (SELECT doc_id, len(words) AS size, unnest(words) AS word FROM words)",
        f"""shared AS (SELECT q.doc_id AS qid, c.doc_id, count(*) AS n FROM listed q JOIN listed c USING (word)
  WHERE q.doc_id IN (SELECT qid FROM {samples}) GROUP BY ALL)""",
        f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id)::INTEGER
  AS rank FROM (SELECT s.qid, b.doc_id,
  coalesce(coalesce(n, 0)::DOUBLE / nullif(len(a.words) + len(b.words) - coalesce(n, 0), 0), 0) AS score
  FROM {samples} s JOIN words a ON a.doc_id = s.qid CROSS JOIN words b
  LEFT JOIN shared h ON h.qid = s.qid AND h.doc_id = b.doc_id WHERE s.qid <> b.doc_id)) WHERE rank <= {S.K})""",
    ]


# ------------------------------------------------------------------ skip-gram

def skipgram_parts() -> list[str]:
    """Two epochs on one block: u<e>, v<e> (pos, v, g) after e of them."""
    axes = range(S.SG_SIZE)
    number = [md5_number(f"'{S.SEED}:' || word || ':{i}'") for i in axes]
    start = ", ".join(f"({x} % {START} / ({START} / 2.0::DOUBLE) - 1.0::DOUBLE) / {2 * S.SG_SIZE}" for x in number)
    zeros = ", ".join("0.0::DOUBLE" for _ in axes)
    parts = [
        TOK,
        f"""sg_words AS MATERIALIZED (SELECT word, n AS total, row_number() OVER (ORDER BY word) - 1 AS pos FROM (
  SELECT word, count(*) AS n FROM (SELECT unnest(tokens) AS word FROM tok) GROUP BY word HAVING count(*) >= {S.SG_MIN_COUNT}))""",
        "sg_at AS MATERIALIZED (SELECT doc_id, unnest(tokens) AS word, unnest(range(len(tokens))) AS i FROM tok)",
        f"""sg_near AS (SELECT p.word AS pw, q.word AS qw FROM (SELECT *, unnest([j for j in range(-{S.SG_WINDOW}, {S.SG_WINDOW + 1}) if j <> 0]) AS j FROM sg_at) p
  JOIN sg_at q ON p.doc_id = q.doc_id AND q.i = p.i + p.j)""",
        """sg_pairs AS MATERIALIZED (SELECT a.pos AS c, b.pos AS x, count(*)::DOUBLE AS n FROM sg_near
  JOIN sg_words a ON a.word = pw JOIN sg_words b ON b.word = qw GROUP BY ALL)""",
        "sg_upto AS MATERIALIZED (SELECT pos, sum(pow(total, 0.75)) OVER (ORDER BY pos) AS upto FROM sg_words)",
        f"u0 AS MATERIALIZED (SELECT pos, [{start}] AS v, 0.0::DOUBLE AS g FROM sg_words)",
        f"v0 AS MATERIALIZED (SELECT pos, [{zeros}] AS v, 0.0::DOUBLE AS g FROM sg_words)",
    ]
    for e in (0, 1):
        draws = []
        for draw in range(1, S.SG_DRAWS + 1):
            h = f"((c * {FOLD} + x) % {PRIME})"
            for salt in (e, draw, S.SEED):
                h = f"(({h} * {FACTOR} + {salt + 1}) % {PRIME})"
            draws.append(f"SELECT c, n, 0 AS hit, ({h} * {FACTOR}) % {PRIME} / {PRIME}.0::DOUBLE * (SELECT max(upto) FROM sg_upto) AS share FROM sg_pairs")
        parts += [
            f"""sg_met{e} AS MATERIALIZED (SELECT c, x AS o, n, 1 AS hit FROM sg_pairs UNION ALL SELECT c, t.pos, n, hit FROM (
  {' UNION ALL '.join(draws)}) d ASOF JOIN sg_upto t ON d.share < t.upto)""",
            f"""sg_pull{e} AS MATERIALIZED (SELECT c, o, n * (hit - 1 / (1 + exp(-list_dot_product(a.v, b.v)))) AS pull, a.v AS av, b.v AS bv
  FROM sg_met{e} JOIN u{e} a ON a.pos = c JOIN v{e} b ON b.pos = o)""",
        ]
        for side, key, other in (("u", "c", "bv"), ("v", "o", "av")):
            sums = ", ".join(f"sum(pull * {other}[{i + 1}])" for i in axes)
            parts += [
                f"{side}_slope{e} AS (SELECT {key} AS pos, [{sums}] AS s FROM sg_pull{e} GROUP BY {key})",
                f"""{side}{e + 1} AS MATERIALIZED (SELECT pos, list_transform(list_zip(v, s), lambda y: y[1] + {S.SG_RATE}::DOUBLE * y[2] / sqrt(g + {EPS!r}::DOUBLE)) AS v, g
  FROM (SELECT o.pos, v, coalesce(s, [{zeros}]) AS s, g + coalesce(list_dot_product(s, s) / {S.SG_SIZE}, 0) AS g
  FROM {side}{e} o LEFT JOIN {side}_slope{e} USING (pos)))""",
            ]
    return parts


# ------------------------------------------------------------------ vectors

VEC = "vec AS (SELECT vec_id AS doc_id, embedding::DOUBLE[] AS v FROM embeddings)"
SMALL_VEC = f"""vec AS (SELECT vec_id AS doc_id, list_transform(embedding, lambda y: y::DOUBLE * {S.SMALL!r}::DOUBLE) AS v
  FROM embeddings)"""
LENGTH = "sqrt(list_dot_product(v, v))"
UNIT = f"""unit AS (SELECT doc_id, CASE WHEN {LENGTH} > 0 THEN list_transform(v, lambda y: y / {LENGTH}) ELSE v END AS v
  FROM (SELECT doc_id, v FROM vec))"""


def vector_topk(name: str, table: str, score: str) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY qid ORDER BY {significant('score')} DESC, doc_id)::INTEGER AS rank
  FROM (SELECT s.qid, b.doc_id, {score} AS score FROM vec_sample s JOIN {table} a ON a.doc_id = s.qid
  CROSS JOIN {table} b WHERE s.qid <> b.doc_id)) WHERE rank <= {S.K})"""


COSINE = """coalesce(list_dot_product(a.v, b.v)
  / nullif(sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v)), 0), 0)"""
COSINE_TOPK = [VEC, VEC_SAMPLE, vector_topk("cosine_found", "vec", COSINE)]
FLAT_TOPK = [UNIT, vector_topk("flat_found", "unit", "list_dot_product(a.v, b.v)")]


def plane_table(n_bits: int) -> str:
    rows = ", ".join(
        f"({bit}, [{', '.join(repr(float(x)) for x in plane)}]::DOUBLE[])"
        for bit, plane in enumerate(hyperplanes(n_bits, S.DIM, S.SEED))
    )
    return f"planes(bit, p) AS (VALUES {rows})"


SIGNED = """signed AS (SELECT doc_id,
  string_agg(CASE WHEN list_dot_product(p, v) > 0 THEN '1' ELSE '0' END, '' ORDER BY bit) AS bucket
  FROM vec, planes GROUP BY doc_id)"""


def signed(n_bits: int) -> list[str]:
    return [VEC, plane_table(n_bits), SIGNED]


def plane_pairs(n_bits: int = S.N_BITS) -> list[str]:
    return [*signed(n_bits), VEC_SAMPLE, """pairs AS (SELECT q.doc_id AS qid, c.doc_id
  FROM signed q JOIN signed c USING (bucket) WHERE q.doc_id IN (SELECT qid FROM vec_sample))"""]


# ------------------------------------------------------------------ k-means

def nearest(name: str, sub: str, centres: str) -> str:
    return f"""{name} AS (SELECT doc_id, m, min(code)::INTEGER AS code FROM (SELECT *, min(d) OVER (PARTITION BY doc_id, m) AS low
  FROM (SELECT s.doc_id, s.m, c.code, list_distance(s.x, c.c) ** 2 AS d, list_dot_product(s.x, s.x) + list_dot_product(c.c, c.c) AS size
  FROM {sub} s JOIN {centres} c USING (m))) WHERE d <= low + 1e-9 * size GROUP BY doc_id, m)"""


def kmeans(prefix: str, table: str, m: int, ks: int, rounds: int, start: int = 0) -> list[str]:
    """Parts up to <prefix>_c (m, code, c) and <prefix>_sub (doc_id, m, x). Every start has its own order of ids."""
    first = md5_order("doc_id") if start == 0 else f"md5('{start}:' || doc_id), doc_id"
    width = S.DIM // m
    sub = f"{prefix}_sub"
    parts = [
        f"{sub} AS (SELECT doc_id, m::INTEGER AS m, v[m * {width} + 1:(m + 1) * {width}] AS x FROM {table}, range({m}) r(m))",
        f"""{prefix}_c0 AS (SELECT m, code, x AS c FROM {sub} JOIN (SELECT doc_id,
  (row_number() OVER (ORDER BY {first}) - 1)::INTEGER AS code FROM {table}) USING (doc_id) WHERE code < {ks})""",
    ]
    for i in range(rounds):
        old, new = f"{prefix}_c{i}", f"{prefix}_c{i + 1}" if i + 1 < rounds else f"{prefix}_c"
        parts += [
            nearest(f"{prefix}_a{i}", sub, old),
            f"""{prefix}_m{i} AS (SELECT m, code, list(mean ORDER BY pos) AS c FROM (SELECT a.m, a.code, pos, avg(x[pos]) AS mean
  FROM {prefix}_a{i} a JOIN {sub} USING (doc_id, m), range(1, {width + 1}) r(pos) GROUP BY ALL) GROUP BY m, code)""",
            f"""{new} AS (SELECT o.m, o.code, coalesce(n.c, o.c) AS c FROM {old} o LEFT JOIN {prefix}_m{i} n USING (m, code))""",
        ]
    return parts


PQ_BOOKS = [VEC, *kmeans("pq", "vec", S.PQ_M, S.PQ_KS, S.ROUNDS)]


def inertia(name: str, sub: str, centres: str) -> str:
    return f"""{name} AS (SELECT m, sum(d) AS inertia FROM (SELECT s.doc_id, s.m, min(list_distance(s.x, c.c) ** 2) AS d
  FROM {sub} s JOIN {centres} c USING (m) GROUP BY s.doc_id, s.m) GROUP BY m)"""


STARTS = range(S.PQ_STARTS)
PQ_BEST = [
    VEC, *[part for i in STARTS for part in kmeans(f"pq{i}", "vec", S.PQ_M, S.PQ_KS, S.ROUNDS, i)],
    *[inertia(f"pq{i}_far", f"pq{i}_sub", f"pq{i}_c") for i in STARTS],
    "pq_starts AS (" + " UNION ALL ".join(f"SELECT {i} AS start, * FROM pq{i}_far" for i in STARTS) + ")",
    "pq_least AS (SELECT * FROM pq_starts QUALIFY row_number() OVER (PARTITION BY m ORDER BY inertia, start) = 1)",
    "pq_best AS (" + " UNION ALL ".join(f"SELECT c.* FROM pq{i}_c c JOIN pq_least USING (m) WHERE start = {i}" for i in STARTS) + ")",
]
PQ_CODES = [*PQ_BOOKS, nearest("pq_code", "pq_sub", "pq_c")]
PQ_TABLE = [VEC_SAMPLE, """pq_far AS (SELECT s.doc_id AS qid, m, code, list_distance(x, c) ** 2 AS d
  FROM pq_sub s JOIN pq_c USING (m) WHERE s.doc_id IN (SELECT qid FROM vec_sample))"""]
PQ_TOPK = [*PQ_CODES, *PQ_TABLE, f"""pq_found AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY qid ORDER BY {significant('score')}, doc_id)::INTEGER AS rank FROM (
  SELECT qid, doc_id, sum(d) AS score FROM pq_code JOIN pq_far USING (m, code) WHERE qid <> doc_id GROUP BY qid, doc_id))
  WHERE rank <= {S.K})"""]
IVF = [VEC, VEC_SAMPLE, UNIT, *kmeans("cell", "unit", 1, S.CELLS, S.ROUNDS), nearest("placed", "cell_sub", "cell_c"),
       f"""probes AS (SELECT qid, code FROM (SELECT s.doc_id AS qid, code, row_number() OVER (PARTITION BY s.doc_id
  ORDER BY {significant('(list_distance(x, c) ** 2)')}, code) AS place FROM cell_sub s CROSS JOIN cell_c
  WHERE s.doc_id IN (SELECT qid FROM vec_sample)) WHERE place <= {S.NPROBE})""",
       f"""ivf_found AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY qid ORDER BY {significant('score')} DESC, doc_id)::INTEGER AS rank FROM (
  SELECT p.qid, b.doc_id, list_dot_product(a.v, b.v) AS score FROM probes p JOIN placed USING (code)
  JOIN unit b ON b.doc_id = placed.doc_id JOIN unit a ON a.doc_id = p.qid WHERE p.qid <> b.doc_id)) WHERE rank <= {S.K})"""]

# the angle of each cell, the k-th score among the nearest cell's rows, and the cells whose bound reaches it
CELL_BOUNDS = [
    *[part.replace(f"place <= {S.NPROBE}", "place <= 1") for part in IVF],
    "cell_u AS (SELECT code, list_transform(c, lambda y: y / sqrt(list_dot_product(c, c))) AS u FROM cell_c)",
    """cell_w AS (SELECT code, count(*) AS n, acos(greatest(least(min(list_dot_product(v, u)), 1.0), -1.0)) AS width
  FROM placed JOIN cell_u USING (code) JOIN unit USING (doc_id) GROUP BY code)""",
    f"kth AS (SELECT qid, score AS least FROM ivf_found WHERE rank = {S.K})",
    """looked AS (SELECT s.qid, code FROM vec_sample s JOIN unit a ON a.doc_id = s.qid CROSS JOIN cell_u JOIN cell_w USING (code)
  LEFT JOIN kth USING (qid) LEFT JOIN probes p USING (qid, code) WHERE p.qid IS NOT NULL OR least IS NULL
  OR cos(greatest(acos(greatest(least(list_dot_product(a.v, u), 1.0), -1.0)) - width, 0)) >= least - 1e-8 * (1 + abs(least)))""",
]
RESIDUAL_CODES = [
    *IVF, """res AS (SELECT doc_id, list_transform(list_zip(unit.v, c), lambda x: x[1] - x[2]) AS v
  FROM placed JOIN unit USING (doc_id) JOIN cell_c USING (code))""",
    *kmeans("res", "res", S.PQ_M, S.RESIDUAL_KS, S.ROUNDS), nearest("res_code", "res_sub", "res_c"),
    f"""res_ip AS (SELECT s.qid, r.m, r.code, list_dot_product(a.v[r.m * {S.DIM // S.PQ_M} + 1:(r.m + 1) * {S.DIM // S.PQ_M}], r.c) AS ip
  FROM vec_sample s JOIN unit a ON a.doc_id = s.qid CROSS JOIN res_c r)""",
    f"""short AS (SELECT qid, doc_id FROM (SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY {significant('score')} DESC, doc_id) AS place
  FROM (SELECT p.qid, placed.doc_id, any_value(list_dot_product(a.v, c.c)) + sum(ip) AS score FROM probes p JOIN placed USING (code)
  JOIN cell_c c ON c.code = placed.code JOIN unit a ON a.doc_id = p.qid JOIN res_code rc ON rc.doc_id = placed.doc_id
  JOIN res_ip t ON t.qid = p.qid AND t.m = rc.m AND t.code = rc.code WHERE p.qid <> placed.doc_id GROUP BY p.qid, placed.doc_id))
  WHERE place <= {S.REFINE * S.K})""",
    f"""short_found AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY qid ORDER BY {significant('score')} DESC, doc_id)::INTEGER AS rank FROM (
  SELECT s.qid, s.doc_id, list_dot_product(a.v, b.v) AS score FROM short s JOIN unit a ON a.doc_id = s.qid JOIN unit b ON b.doc_id = s.doc_id))
  WHERE rank <= {S.K})"""]

# ------------------------------------------------------------------ evaluation


def recall(method: str, samples: str, truth: str, found: str) -> str:
    return f"""SELECT '{method}' AS method, s.qid, count(f.doc_id) / {float(S.K)} AS recall
  FROM {samples} s LEFT JOIN {truth} t ON t.qid = s.qid
  LEFT JOIN {found} f ON f.qid = t.qid AND f.doc_id = t.doc_id GROUP BY s.qid"""


VECTOR_METHODS = [*PQ_TOPK, vector_topk("cosine_found", "vec", COSINE), *FLAT_TOPK]
ALL_METHODS = [*VECTOR_METHODS, *LSH_TOPK, *jaccard_parts("jaccard_found", "doc_sample")]
RECALLS = [*ALL_METHODS, "recalls AS (" + " UNION ALL ".join([
    recall("pq", "vec_sample", "cosine_found", "pq_found"),
    recall("lsh", "doc_sample", "jaccard_found", "lsh_found"),
    recall("flat", "vec_sample", "cosine_found", "flat_found"),
]) + ")"]


SHINGLE_WORDS = f"""words AS (SELECT doc_id, list_distinct(CASE WHEN len(tokens) = 0 THEN []
  WHEN len(tokens) < {S.SHINGLE_N} THEN [array_to_string(tokens, ' ')]
  ELSE list_transform(range(1, len(tokens) - {S.SHINGLE_N} + 2),
  lambda i: array_to_string(tokens[i:i + {S.SHINGLE_N} - 1], ' ')) END) AS words FROM tok)"""
SHINGLE_RUN = [
    *[SHINGLE_WORDS if part is WORDS else part for part in LSH_TOPK], *jaccard_parts("jaccard_found", "doc_sample"),
    f"recalls AS ({recall('lsh', 'doc_sample', 'jaccard_found', 'lsh_found')})"]


def report(method: str, samples: str, truth: str, found: str, count: str) -> str:
    def top(table: str) -> str:
        return f"coalesce((SELECT list(doc_id ORDER BY rank) FROM {table} x WHERE x.qid = s.qid AND rank <= 5), [])"

    return f"""SELECT '{method}' AS method, qid, {top(truth)} AS truth, {top(found)} AS retrieved,
  {count} AS n_candidates FROM {samples} s"""


DRAWS = [TOK, WORDS, f"""places AS (SELECT doc_id, row_number() OVER (
  ORDER BY substr(md5(doc_id::VARCHAR), 1, 4), doc_id) - 1 AS place FROM documents)""",
         f"""draws AS (SELECT draw, {md5_number(f"'{S.SEED}:' || draw || ':a'")} % (SELECT count(*) FROM documents) AS pa,
  {md5_number(f"'{S.SEED}:' || draw || ':b'")} % (SELECT count(*) FROM documents) AS pb FROM range({S.N_SAMPLES}) r(draw))""",
         f"""drawn AS (SELECT draw, a.doc_id AS a_id, b.doc_id AS b_id, {JACCARD} AS jaccard FROM draws
  JOIN places x ON x.place = pa JOIN places y ON y.place = pb
  JOIN words a ON a.doc_id = x.doc_id JOIN words b ON b.doc_id = y.doc_id WHERE a.doc_id <> b.doc_id)"""]

SETTINGS = ", ".join(
    f"({i}, {n}, {t}::DOUBLE, {best_bands(t, n)[0]}, {best_bands(t, n)[1]})" for i, (n, t) in enumerate(grid())
)
SWEEP = [
    TOK, WORDS, sample("sweep_sample", "documents", "doc_id", S.SWEEP_QUERIES),
    *signature_parts(max(n for n, _ in grid()), S.SWEEP_SHINGLE_N),
    f"settings(setting, num_perm, threshold, bands, per_band) AS (VALUES {SETTINGS})",
    """buckets AS (SELECT setting, doc_id, i // per_band AS band, string_agg(h::VARCHAR, '-' ORDER BY i) AS bucket
  FROM hashes JOIN settings ON i < bands * per_band GROUP BY ALL)""",
    """met AS (SELECT DISTINCT setting, q.doc_id AS qid, c.doc_id FROM buckets q JOIN buckets c USING (setting, band, bucket)
  WHERE q.doc_id IN (SELECT qid FROM sweep_sample) AND q.doc_id <> c.doc_id)""",
    f"""met_scored AS (SELECT setting, qid, c.doc_id, {JACCARD} AS score FROM met c
  JOIN words a ON a.doc_id = qid JOIN words b ON b.doc_id = c.doc_id)""",
    f"""met_found AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY setting, qid ORDER BY score DESC, doc_id) AS rank
  FROM met_scored) WHERE rank <= {S.K})""",
    *jaccard_parts("sweep_truth", "sweep_sample"),
    f"""lsh_part AS (SELECT setting, sum(hits) / {float(S.K)} / (SELECT count(*) FROM sweep_sample) AS recall FROM (
  SELECT g.setting, s.qid, count(f.doc_id) AS hits FROM settings g CROSS JOIN sweep_sample s
  LEFT JOIN sweep_truth t ON t.qid = s.qid
  LEFT JOIN met_found f ON f.setting = g.setting AND f.qid = t.qid AND f.doc_id = t.doc_id GROUP BY ALL) GROUP BY setting)""",
    # the vector methods as elsewhere, for as many queries as the sweep asks
    *[sample("vec_sample", "embeddings", "vec_id", S.SWEEP_QUERIES) if part is VEC_SAMPLE else part for part in VECTOR_METHODS],
    "fixed AS (SELECT method, avg(recall) AS recall FROM (" + " UNION ALL ".join([
        recall("pq", "vec_sample", "cosine_found", "pq_found"),
        recall("flat", "vec_sample", "cosine_found", "flat_found"),
    ]) + ") GROUP BY method)",
    """swept AS (SELECT 'lsh' AS method, num_perm, threshold, round(recall, 6) AS recall FROM settings JOIN lsh_part USING (setting)
  UNION ALL SELECT method, num_perm, threshold, round(recall, 6) FROM fixed CROSS JOIN settings)""",
]


def oracles() -> dict[str, str]:
    found = "SELECT qid, doc_id, round(score, 6) AS score, rank FROM"
    pool = ", ".join(
        f"({md5_number(f'''term || ':{i}' ''')} % 2000006) / 1000003.0::DOUBLE - 1.0::DOUBLE AS v{i}" for i in range(S.POOL_DIM)
    )
    means = ", ".join(f"round(coalesce(sum(tf * v{i}) / sum(tf), 0), 6)" for i in range(S.POOL_DIM))
    points = " UNION ALL ".join(
        f"SELECT {p}::INTEGER AS percent, round(quantile_cont(jaccard, {p / 100}), 6) AS value FROM drawn" for p in PERCENTS
    )
    plane_found = f"""{found} (SELECT *,
  row_number() OVER (PARTITION BY qid ORDER BY {significant('score')} DESC, doc_id)::INTEGER AS rank FROM (
  SELECT qid, p.doc_id, {COSINE} AS score FROM pairs p JOIN vec a ON a.doc_id = qid JOIN vec b ON b.doc_id = p.doc_id
  WHERE qid <> p.doc_id)) WHERE rank <= {S.K}"""
    series = ", ".join(f"max(CASE WHEN threshold = {t} THEN recall END) AS recall_{round(t * 100)}" for t in THRESHOLDS)
    return {
        "union_by_name": """SELECT doc_id, text, lang, NULL::BIGINT AS item_id, NULL::BIGINT AS page_id, NULL::VARCHAR AS url FROM documents
  UNION ALL SELECT NULL, text, NULL, item_id, NULL, NULL FROM benchmark
  UNION ALL SELECT NULL, html, NULL, NULL, page_id, url FROM pages""",
        "merge_csv": """SELECT item_id::VARCHAR AS item_id, text, NULL::VARCHAR AS doc_id, NULL::VARCHAR AS quality, NULL::VARCHAR AS toxic
  FROM benchmark UNION ALL SELECT NULL, NULL, doc_id::VARCHAR, quality::VARCHAR, toxic::VARCHAR FROM labels""",
        "merge_csv_quoted": """SELECT item_id::VARCHAR AS item_id, text, NULL::VARCHAR AS doc_id, NULL::VARCHAR AS quality, NULL::VARCHAR AS page_id,
  NULL::VARCHAR AS url FROM benchmark UNION ALL SELECT NULL, NULL, doc_id::VARCHAR, quality::VARCHAR, NULL, NULL FROM labels
  UNION ALL SELECT NULL, NULL, NULL, NULL, page_id::VARCHAR, url FROM pages""",
        "tokenize": select([TOK], "SELECT * FROM tok"),
        "joined_text": select([TOK], "SELECT doc_id, array_to_string(tokens, ' ') AS joined FROM tok"),
        "first_n_docs": select([TOK], f"SELECT * FROM tok ORDER BY doc_id LIMIT {S.MAX_DOCS}"),
        "token_sets": select([TOK, WORDS], "SELECT * FROM words"),
        "shingles": select([TOK], f"""SELECT doc_id, CASE WHEN len(tokens) = 0 THEN []
  WHEN len(tokens) < {S.SHINGLE_N} THEN [array_to_string(tokens, ' ')]
  ELSE list_transform(range(1, len(tokens) - {S.SHINGLE_N} + 2),
  lambda i: array_to_string(tokens[i:i + {S.SHINGLE_N} - 1], ' ')) END AS shingles FROM tok"""),
        "term_counts": select([TOK, TERMS], "SELECT * FROM terms"),
        "vocabulary": select([TOK, TERMS, VOCAB], "SELECT * FROM vocab"),
        "tfidf": select([TOK, TERMS, VOCAB, TFIDF],
                        "SELECT doc_id, term, round(w / length, 6) AS tfidf FROM weighted JOIN lengths USING (doc_id)"),
        "lsi_leading": select(LSI, f"""SELECT doc_id, {', '.join(f'round(coalesce(d{i}.x, 0), 4) + 0.0 AS direction_{i}' for i in (1, 2, 3))}
  FROM documents {' '.join(f'LEFT JOIN d{i} USING (doc_id)' for i in (1, 2, 3))}""").replace("WITH ", "WITH RECURSIVE ", 1),
        "mean_pool": select([TOK, TERMS, f"""known AS (SELECT term, {pool} FROM terms GROUP BY term
  HAVING sum(tf) >= {S.W2V_MIN_COUNT})"""],
                            f"""SELECT d.doc_id, [{means}] AS embedding FROM documents d
  LEFT JOIN (terms JOIN known USING (term)) t ON t.doc_id = d.doc_id GROUP BY d.doc_id"""),
        "minhash_signature": select(SIGNATURE, "SELECT doc_id, list(h::INTEGER ORDER BY i) AS signature FROM hashes GROUP BY doc_id"),
        "lsh_bands": select(BAND_TABLE, "SELECT doc_id, band, bucket FROM bands"),
        "lsh_candidates": select(CANDIDATES, "SELECT * FROM cand"),
        "lsh_topk": select(LSH_TOPK, "SELECT qid, doc_id, score, rank FROM lsh_found"),
        "lsh_candidate_stats": select([*BAND_TABLE, """sizes AS (SELECT q.doc_id, count(DISTINCT c.doc_id) AS n
  FROM bands q JOIN bands c USING (band, bucket) GROUP BY q.doc_id)"""],
                                      """SELECT count(*) AS n_docs, round(avg(n), 6) AS mean_candidates,
  quantile_cont(n::DOUBLE, 0.5) AS median_candidates, min(n) AS min_candidates, max(n) AS max_candidates,
  round(avg(CASE WHEN n = 0 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_none,
  round(avg(CASE WHEN n = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS share_self_only FROM sizes"""),
        "lsh_candidate_examples": select([*BAND_TABLE, """few AS (SELECT doc_id AS qid FROM documents ORDER BY doc_id LIMIT 20),
near AS (SELECT DISTINCT q.doc_id AS qid, c.doc_id FROM bands q JOIN bands c USING (band, bucket)
  WHERE q.doc_id IN (SELECT qid FROM few))"""],
                                         """SELECT qid AS doc_id, list(doc_id ORDER BY doc_id) AS candidates
  FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY doc_id) AS place FROM near) WHERE place <= 10 GROUP BY qid"""),
        "l2_normalize": select([VEC, UNIT], f"SELECT doc_id, {round_list('v')} AS vector FROM unit"),
        "hyperplane_signature": select(signed(S.SIGNATURE_BITS), "SELECT doc_id, bucket FROM signed"),
        "hyperplane_buckets": select(signed(S.N_BITS), "SELECT bucket, doc_id FROM signed"),
        "hyperplane_bucket_sizes": select(signed(S.N_BITS), "SELECT bucket, count(*) AS n_docs FROM signed GROUP BY bucket"),
        "hyperplane_candidates": select(plane_pairs(), "SELECT * FROM pairs"),
        "hyperplane_topk": select(plane_pairs(), plane_found),
        "hyperplane_topk_wide": select(plane_pairs(S.WIDE_BITS), plane_found),
        "pq_subvectors": select([VEC], f"""SELECT doc_id, m::INTEGER AS m, {round_list(f'v[m * {S.DIM // S.PQ_M} + 1:(m + 1) * {S.DIM // S.PQ_M}]')} AS part
  FROM vec, range({S.PQ_M}) r(m)"""),
        "pq_train": select(PQ_BOOKS, f"SELECT m, code, {round_list('c')} AS centroid FROM pq_c"),
        "pq_train_best": select(PQ_BEST, f"SELECT m, code, {round_list('c')} AS centroid FROM pq_best"),
        "pq_inertia": select(PQ_BEST, f"""SELECT m, round(inertia, 6) AS inertia, 1::INTEGER AS starts FROM pq0_far
  UNION ALL SELECT m, round(inertia, 6), {S.PQ_STARTS}::INTEGER FROM pq_least"""),
        "pq_encode": select(PQ_CODES, "SELECT doc_id, list(code ORDER BY m) AS codes FROM pq_code GROUP BY doc_id"),
        "pq_encode_small": select([SMALL_VEC, *PQ_CODES[1:]], "SELECT doc_id, list(code ORDER BY m) AS codes FROM pq_code GROUP BY doc_id"),
        "inner_product_topk_raw": select([SMALL_VEC, VEC_SAMPLE, vector_topk("raw_found", "vec", "list_dot_product(a.v, b.v)")],
                                         "SELECT qid, doc_id, rank FROM raw_found"),
        "pq_distance_table": select([*PQ_CODES, *PQ_TABLE],
                                    "SELECT qid, m, list(round(d, 6) ORDER BY code) AS distances FROM pq_far GROUP BY qid, m"),
        "pq_topk": select(PQ_TOPK, f"{found} pq_found"),
        "ivf_topk": select(IVF, f"{found} ivf_found"),
        "cosine_topk": select(COSINE_TOPK, f"{found} cosine_found"),
        "cosine_topk_cells": select(COSINE_TOPK, f"{found} cosine_found"),
        "cells_compared": select(CELL_BOUNDS, """SELECT qid, (sum(n) - count(o.doc_id))::BIGINT AS n_rows FROM looked JOIN cell_w USING (code)
  LEFT JOIN placed o ON o.doc_id = qid AND o.code = looked.code GROUP BY qid"""),
        "ivf_codes_topk": select(RESIDUAL_CODES, f"{found} short_found"),
        "inner_product_topk": select([VEC, VEC_SAMPLE, *FLAT_TOPK], f"{found} flat_found"),
        "jaccard_topk": select([TOK, WORDS, DOC_SAMPLE, *jaccard_parts("jaccard_found", "doc_sample")],
                               "SELECT qid, doc_id, score, rank FROM jaccard_found"),
        "pipeline_recall": select(RECALLS, """SELECT 'lsh' AS method, count(*) AS n_queries, round(avg(recall), 6) AS recall
  FROM recalls WHERE method = 'lsh' UNION ALL SELECT 'flat', count(*), 1.0::DOUBLE FROM doc_sample
  UNION ALL SELECT 'pq', count(*), NULL FROM doc_sample"""),
        "pipeline_shingles": select(SHINGLE_RUN, """SELECT 'lsh' AS method, count(*) AS n_queries,
  (SELECT count(*) FROM cand WHERE qid <> doc_id) AS n_candidates, round(avg(recall), 6) AS recall FROM recalls
  UNION ALL SELECT 'flat', count(*), count(*) * ((SELECT count(*) FROM documents) - 1), 1.0::DOUBLE FROM doc_sample"""),
        "saved_documents": "SELECT doc_id, text FROM documents",
        "saved_tokens": select([TOK], "SELECT doc_id, array_to_string(tokens, ' ') AS joined FROM tok"),
        "saved_embeddings": select([VEC], f"SELECT doc_id, {round_list('v')} AS embedding FROM vec"),
        "saved_signatures": select(SIGNATURE, "SELECT doc_id, list(h::INTEGER ORDER BY i) AS signature FROM hashes GROUP BY doc_id"),
        "saved_bands": select(BAND_TABLE, "SELECT doc_id, band, bucket FROM bands"),
        "saved_pq_index": select(PQ_CODES, "SELECT doc_id, list(code ORDER BY m) AS codes FROM pq_code GROUP BY doc_id"),
        "saved_metrics_json": select(RECALLS, """SELECT method, count(*) AS n_queries, round(avg(recall), 6) AS recall
  FROM recalls GROUP BY method"""),
        "saved_metrics_csv": """SELECT 'documents' AS "table", count(*) AS n_rows FROM documents
  UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'benchmark', count(*) FROM benchmark""",
        "saved_jaccard_sample": select(DRAWS, "SELECT draw, a_id, b_id, jaccard FROM drawn"),
        "word2vec_vocabulary": select([TOK, TERMS], f"""SELECT term AS word, {S.W2V_SIZE}::INTEGER AS dim
  FROM terms GROUP BY term HAVING sum(tf) >= {S.W2V_MIN_COUNT}"""),
        "skipgram_two_rounds": select(skipgram_parts(), f"SELECT word, {round_list('v')} AS vector FROM u2 JOIN sg_words USING (pos)"),
        "query_sample": select([DOC_SAMPLE], "SELECT qid FROM doc_sample"),
        "recall_per_query": select(RECALLS, "SELECT method, qid, round(recall, 6) AS recall FROM recalls"),
        "method_recall": select(RECALLS, """SELECT method, count(*) AS n_queries, round(avg(recall), 6) AS recall
  FROM recalls GROUP BY method"""),
        "query_report": select(ALL_METHODS, " UNION ALL ".join([
            report("pq", "vec_sample", "cosine_found", "pq_found", "NULL::BIGINT"),
            report("lsh", "doc_sample", "jaccard_found", "lsh_found",
                   "(SELECT count(*) FROM cand c WHERE c.qid = s.qid AND c.doc_id <> s.qid)"),
            report("flat", "vec_sample", "cosine_found", "flat_found", "NULL::BIGINT"),
        ])),
        "jaccard_sample": select(DRAWS, "SELECT draw, a_id, b_id, jaccard FROM drawn"),
        "jaccard_percentiles": select(DRAWS, points),
        "lsh_sweep": select(SWEEP, "SELECT * FROM swept"),
        "sweep_pivot": select(SWEEP, f"SELECT method, num_perm, {series} FROM swept GROUP BY method, num_perm"),
    }
