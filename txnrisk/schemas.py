"""Declared schemas of the eleven tables, by namespace-qualified name."""

from pyspark.sql import types as T

L, D, S, TS = T.LongType(), T.DoubleType(), T.StringType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Column names, order and types of each table.
TRANSACTIONS = _schema(
    step=L,
    type=S,
    amount=D,
    nameOrig=S,
    oldbalanceOrg=D,
    newbalanceOrig=D,
    nameDest=S,
    oldbalanceDest=D,
    newbalanceDest=D,
    isFraud=L,
    isFlaggedFraud=L,
)

TRANSACTION_FEATURES = T.StructType(
    TRANSACTIONS.fields
    + _schema(
        balance_diff_orig=D,
        balance_diff_dest=D,
        orig_balance_zero_after=L,
        dest_balance_unchanged=L,
        amount_to_balance_ratio=D,
        is_large_transaction=L,
        hour_of_step=L,
        type_encoded=L,
        is_transfer_or_cashout=L,
        net_orig_change=D,
        net_dest_change=D,
    ).fields
)

INGESTION_LOG = _schema(run_date=TS, table_name=S, status=S, row_count=L)

VALIDATION_LOG = _schema(run_date=TS, check_name=S, records_found=L, action_taken=S)

FEATURE_LOG = _schema(
    run_date=TS,
    total_records=L,
    fraud_records=L,
    avg_amount=D,
    large_txn_count=L,
    zero_balance_count=L,
)

MODEL_EVALUATION_LOG = _schema(
    run_date=TS,
    model_name=S,
    precision=D,
    recall=D,
    f1_score=D,
    roc_auc=D,
    log_loss=D,
    status=S,
)

TRAINING_LOG = _schema(
    run_date=TS,
    model_name=S,
    training_rows=L,
    eval_rows=L,
    threshold_used=D,
    status=S,
)

FRAUD_PREDICTIONS = _schema(
    prediction_date=TS,
    step=L,
    type=S,
    amount=D,
    nameOrig=S,
    nameDest=S,
    oldbalanceOrg=D,
    newbalanceOrig=D,
    oldbalanceDest=D,
    newbalanceDest=D,
    predicted_isFraud=L,
    fraud_probability=D,
    risk_level=S,
    isFraud=L,
)

HIGH_RISK_ALERTS = _schema(
    alert_date=TS,
    step=L,
    type=S,
    amount=D,
    nameOrig=S,
    nameDest=S,
    fraud_probability=D,
    risk_level=S,
    alert_status=S,
    top_reason=S,
)

DAILY_SUMMARY = _schema(
    summary_date=TS,
    total_transactions=L,
    flagged_count=L,
    high_risk_count=L,
    medium_risk_count=L,
    low_risk_count=L,
    total_amount_at_risk=D,
    avg_fraud_probability=D,
    model_used=S,
)

TABLES = {
    "raw.transactions": TRANSACTIONS,
    "raw.ingestion_log": INGESTION_LOG,
    "staging.transactions_clean": TRANSACTIONS,
    "staging.validation_log": VALIDATION_LOG,
    "features.transaction_features": TRANSACTION_FEATURES,
    "features.feature_log": FEATURE_LOG,
    "ml_models.model_evaluation_log": MODEL_EVALUATION_LOG,
    "ml_models.training_log": TRAINING_LOG,
    "reports.fraud_predictions": FRAUD_PREDICTIONS,
    "reports.high_risk_alerts": HIGH_RISK_ALERTS,
    "reports.daily_summary": DAILY_SUMMARY,
}

# Tables written once per run date are stored by the day of their run timestamp,
# so a rerun replaces its own day and a date filter reads one day's files.
RUN_DAY = "run_day"
RUN_TIMESTAMP = {
    "reports.fraud_predictions": "prediction_date",
    "reports.high_risk_alerts": "alert_date",
    "reports.daily_summary": "summary_date",
}
