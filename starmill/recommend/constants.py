"""Fixed values of the rating model and the ranking."""

NUMERIC_COLUMNS = ["anodelancamento", "duracaomin"]
CATEGORICAL_COLUMNS = ["generonome", "estado"]
FEATURE_COLUMNS = NUMERIC_COLUMNS + CATEGORICAL_COLUMNS
TARGET = "nota"
COUNT = "n_equal"
TOP_K_PER_STATE = 25
CANDIDATE_LIMIT = 400

NUM_TREES = 300
MAX_DEPTH = 12
SEED = 42

EXTRACT_MIN_RATING = 6.2
EXTRACT_MIN_VOTES = 500
CANDIDATE_MIN_RATING = 6.0
CANDIDATE_MIN_VOTES = 1000
CANDIDATE_AFTER_YEAR = 1900
