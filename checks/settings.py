"""Parameters shared by the queries and their SQL."""

K = 10
N_QUERIES = 200
SWEEP_QUERIES = 500
MAX_DOCS = 500
MAX_FEATURES = 50_000
LSI_DIMS = 200
LEADING_STEPS = 10
W2V_SIZE = 200
W2V_MIN_COUNT = 2
POOL_DIM = 8
SG_SIZE = 4
SG_WINDOW = 2
SG_MIN_COUNT = 20
SG_DRAWS = 2
SG_RATE = 0.05
NUM_PERM = 128
THRESHOLD = 0.8
SHINGLE_N = 5
SWEEP_SHINGLE_N = 3
DIM = 64
SIGNATURE_BITS = 128
N_BITS = 16
WIDE_BITS = 5
PQ_M = 8
PQ_KS = 256
PQ_STARTS = 3
CELLS = 16
NPROBE = 4
RESIDUAL_KS = 32
REFINE = 2
ROUNDS = 5
N_SAMPLES = 2_000
SEED = 42
SMALL = 0.00001
