"""Default hyperparameters.

Fixed values (they must equal the reference's command-line defaults):
N = 1, m = 400, num_iter = 100, threshold = 0.5, alpha = 0.002, delta = 0.05.
"""

N = 1
M = 400
NUM_ITER = 100
THRESHOLD = 0.5
ALPHA = 0.002
DELTA = 0.05

# Largest vocabulary / model that is shipped to tasks as a constant lookup
# table, by keys and by the bytes of their text. Above either, featurization and
# scoring take the join form, which gives the same results.
MAX_LOOKUP_KEYS = 200_000
MAX_LOOKUP_BYTES = 16 * 1024 * 1024
