"""They have to be exactly these for results to be right."""

# --- fixed values: geometry and defaults ---
EARTH_RADIUS_KM = 6371.0
DEFAULT_AVERAGE = 70.0
DAYS_PER_YEAR = 365.25

# --- fixed values: columns ---
ORDINAL = "Unnamed: 0"
KEY = "trans_num"
LABEL = "is_fraud"
NUMERIC_FEATURES = [
    "amt", "city_pop", "age", "hour", "month", "day_of_week", "distance", "amt_vs_category_avg",
]
CATEGORICAL_FEATURES = ["merchant", "category", "gender", "job"]
COERCED_NUMERIC = ["amt", "lat", "long", "merch_lat", "merch_long", "city_pop", "unix_time"]
DISTRIBUTION_ATTRIBUTES = ["category", "merchant"]
DESCRIBED = ["amt", "hour", "age", "distance_km", "amt_vs_category_avg"]
METRICS = ["auc_roc", "auc_pr", "precision", "recall", "f1"]

# --- fixed values: display titles ---
DISPLAY_TITLES = {
    "trans_num": "Transaction Number",
    "trans_date_trans_time": "Time",
    "cc_num": "Credit Card Number",
    "amt": "Amount",
    "merchant": "Merchant",
    "category": "Category",
    "fraud_probability": "Fraud Probability (%)",
    "status": "Status",
}

# --- fixed values: day names, 0 = Sunday ---
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# --- fixed values: amount buckets, left-closed (upper bound, label) and the rest ---
SERVING_BUCKETS = [(100.0, "Less than $100"), (500.0, "$100-$500"), (1000.0, "$500-$1000")]
SERVING_BUCKET_REST = "Over $1000"

# --- fixed values: amount buckets, right-closed (lower bound, upper bound, label) ---
EXPLORATION_BUCKETS = [
    (0.0, 10.0, "0-10"),
    (10.0, 50.0, "10-50"),
    (50.0, 100.0, "50-100"),
    (100.0, 200.0, "100-200"),
    (200.0, 500.0, "200-500"),
    (500.0, 1000.0, "500-1000"),
    (1000.0, None, "1000+"),
]

# --- fixed values: search bounds and page sizes ---
SEARCH_MIN = 0.0
SEARCH_MAX = 1_000_000.0
SEARCH_LIMIT = 100
LATEST_LIMIT = 1000
TOP_CATEGORIES = 15
TOP_MERCHANTS = 10
TOP_RISK = 12
PROFILE_ROWS = 15
DRIFT_ROWS = 10

# --- fixed values: training ---
SEED = 42
TRAIN_SHARE = 0.8
NEGATIVE_SHARE = 0.08
MAX_BINS = 1024
FIT_PARALLELISM = 2
FOREST_GRID_FAST = {"numTrees": [50], "maxDepth": [8]}
FOREST_GRID_FULL = {"numTrees": [50, 100], "maxDepth": [8, 12]}
BOOSTED_GRID_FAST = {"maxIter": [20], "maxDepth": [3]}
BOOSTED_GRID_FULL = {"maxIter": [20, 40], "maxDepth": [3, 5]}
FOREST_NAME = "Random Forest"
BOOSTED_NAME = "GBT"
ENSEMBLE_NAME = "Ensemble"

# --- fixed values: streaming ---
TOPIC = "transaction_data"
TRIGGER = "10 seconds"
