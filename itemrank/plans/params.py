"""Fixed parameters of the registered queries (shared by Spark and the oracle SQL)."""

TITLE_QUERY = "widget red 1978!"
TITLE_LIMIT = 10
ADVANCED_TITLE_LIMIT = 50
ADVANCED_GENRE = "economy"
ADVANCED_YEARS = (1960, 1990)
SEARCH_GENRE = "promo"
SEARCH_YEAR = 1978
SEARCH_YEAR_RANGE = (1960, 1965)
GENRE_LIST = ["PROMO", "Brand7"]
GENRE_N = 5
TOP_N = 10
NEIGHBORS = 5
REC_N = 5
SEEDS = 3
FALLBACK_N = 10
MIN_RATINGS = 10
EVAL_K = 10
EVAL_FOLDS = 5
FOLD_SALT = "42"
SLICE_USERS = [0, 1, 2, 4, 5]
RATING_MIN, RATING_MAX = 0.5, 5.0
CACHE_TTL_SECONDS = 30 * 60
MATRIX_BLOCK = 256
STREAM_FILES = 4
# Fixed clock for the cache query: 2024-06-01T00:00:00Z.
CACHE_NOW = 1717200000
