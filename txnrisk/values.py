"""Names, texts, cut-offs and model settings that decide results."""

# Fixed values. Transaction types, in the order of their codes 1 to 5.
TRANSACTION_TYPES = ("PAYMENT", "TRANSFER", "CASH_OUT", "DEBIT", "CASH_IN")
RISKY_TYPES = ("TRANSFER", "CASH_OUT")

# Fixed values. A row is identified by these four columns; reports join on the first three.
TRANSACTION_KEY = ("step", "nameOrig", "amount", "nameDest")
REPORT_KEY = ("nameOrig", "step", "amount")

# Fixed values. Load and split limits.
MAX_FRAUD_PCT = 10
LARGE_AMOUNT_QUANTILE = 0.95
DEFAULT_SPLIT_STEP = 600
JOB_SPLIT_STEP = 100
SCORE_AFTER_STEP = 600

# Fixed values. Validation checks and the action text logged for each.
VALIDATION_ACTIONS = {
    "null_amount_records": "Removed nulls",
    "negative_amount_records": "Removed negatives",
    "duplicate_records": "Removed duplicates",
    "impossible_balance": "Removed impossible balances",
}
FEATURE_CHECKS = ("negative_ratio", "invalid_type", "hour_range")

# Fixed values. Risk levels by lower probability bound.
HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"
HIGH_FROM, MEDIUM_FROM = 0.7, 0.4

# Fixed values. Alert texts, first match wins.
REASON_DRAINED = "Account drained to zero"
REASON_DEST_UNCHANGED = "Destination balance unchanged"
REASON_LARGE = "Large transaction amount"
REASON_RISKY_TYPE = "High-risk transaction type"
REASON_OTHER = "Multiple fraud signals detected"
NEW_ALERT_STATUS = "PENDING_REVIEW"
RUN_STATUS = "SUCCESS"

# Fixed values. Upper bounds and labels of the score histogram; the last bucket is open.
SCORE_BUCKETS = (
    (0.2, "0.0 – 0.2"),
    (0.4, "0.2 – 0.4"),
    (0.6, "0.4 – 0.6"),
    (0.8, "0.6 – 0.8"),
)
LAST_SCORE_BUCKET = "0.8 – 1.0"

# Fixed values. Hour ranges of the heatmap; every other hour is the last label.
DAYPARTS = (
    (0, 5, "Night (0–5)"),
    (6, 11, "Morning (6–11)"),
    (12, 17, "Afternoon (12–17)"),
)
LAST_DAYPART = "Evening (18–23)"

# Fixed values. Model names and the columns each model reads.
LOGISTIC = "fraud_logistic_regression"
BOOSTED_TREE = "fraud_boosted_tree"
RANDOM_FOREST = "fraud_random_forest"
KMEANS = "fraud_kmeans_anomaly"
LOGGED_MODELS = (LOGISTIC, BOOSTED_TREE, KMEANS)
LABEL = "isFraud"
CLASSIFIER_FEATURES = (
    "balance_diff_orig",
    "balance_diff_dest",
    "orig_balance_zero_after",
    "dest_balance_unchanged",
    "amount_to_balance_ratio",
    "is_large_transaction",
    "hour_of_step",
    "type_encoded",
    "is_transfer_or_cashout",
    "net_orig_change",
    "net_dest_change",
)
CLUSTER_FEATURES = (
    "balance_diff_orig",
    "balance_diff_dest",
    "amount_to_balance_ratio",
    "orig_balance_zero_after",
    "dest_balance_unchanged",
    "is_large_transaction",
    "is_transfer_or_cashout",
)
CLASS_WEIGHTS = {0: 1.0, 1: 10.0}
DECISION_THRESHOLD = 0.5
