"""Fixed values.

These values must equal the ones of the configs and results this package
reproduces; changing them changes results or breaks reading existing specs.
"""

# --- fixed values: hashing -------------------------------------------------
DEFAULT_HASH_SEED = 1024          # seed of the 32-bit xxHash buckets
NULL_TOKEN = "nan"                # text hashed / crossed for a missing value
DEFAULT_FILL_VALUE = "UNKNOWN"    # default fill for text columns

# --- fixed values: config vocabulary (processor dialect) --------------------
FN_HASH = "HashTransform"
FN_TIME = "TimeFeatureExtractTransform"
FN_BOOL = "BooleanTransform"
FN_LOG = "LogTransform"
FN_LABEL = "LabelEncodeTransform"
FN_MULTI = "MultiValueTransform"
CLEANER_EXTRA_COLUMNS = ("datetime", "timestamp_s")

# --- fixed values: generated column names ------------------------------------
SUFFIX_ENCODED = "_encoded"
SUFFIX_BIN = "_bin"
SUFFIX_LOG = "_log"
SUFFIX_CROSS = "_cross"

# --- fixed values: route merge ------------------------------------------------
ROUTE_SCORE_SCALE = 10.0          # merged score = (1 - pos / route_len) * 10
