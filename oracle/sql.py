"""The expected results as DuckDB SQL over the same Parquet tables.

Every statement starts with the same chain of common table expressions, from the ``events``
table to the report tables. Money is worked out in whole cents; literals in formulas are
doubles; counts are cast to BIGINT and dates to DATE.
"""

from __future__ import annotations

# Means of values with few decimal places, in whole units and rounded half up.
MEAN = "(2 * sum(CAST(round({x} * {f}) AS HUGEINT)) + count({x})) // (2 * count({x})) / {f}::DOUBLE"
MEAN_SCORE = MEAN.format(x="fraud_probability", f=10000)
MEAN_AMOUNT = MEAN.format(x="amount", f=100)
# Predicates that the checks and the log rows share.
NOT_POSITIVE = "amount <= 0"
IMPOSSIBLE = "type IN ('TRANSFER', 'CASH_OUT') AND amount > oldbalanceOrg + 1 AND oldbalanceOrg > 0"

TABLES = f"""
WITH numbered AS (
    SELECT event_id AS k, user_id,
           CAST((day(ts) - 1) * 24 + hour(ts) + 1 AS BIGINT) AS step,
           CAST(round(value * 100) AS BIGINT) AS c,
           CASE event_type WHEN 'view' THEN 'PAYMENT' WHEN 'purchase' THEN 'TRANSFER'
                           WHEN 'click' THEN 'CASH_OUT' WHEN 'error' THEN 'DEBIT'
                           ELSE 'CASH_IN' END AS t,
           CAST(CASE WHEN event_id % 7 = 0 THEN 0 ELSE (event_id * 7919) % 20000 END AS BIGINT) AS ob,
           CAST((event_id * 10473) % 300000 AS BIGINT) AS od
    FROM events
), moved AS (
    SELECT *, CASE WHEN t = 'CASH_IN' THEN ob + c ELSE greatest(ob - c, 0) END AS nb,
              CASE WHEN k % 3 = 0 THEN od ELSE od + c END AS nd
    FROM numbered
), base AS (
    SELECT k, step,
           CASE WHEN k % 181 = 0 THEN 'UNKNOWN' WHEN k % 227 = 0 THEN NULL ELSE t END AS type,
           CASE WHEN k % 211 = 0 THEN NULL WHEN k % 197 = 0 THEN -c / 100::DOUBLE
                ELSE c / 100::DOUBLE END AS amount,
           CASE WHEN k % 223 = 0 THEN NULL ELSE 'C' || CAST(user_id AS VARCHAR) END AS nameOrig,
           ob / 100::DOUBLE AS oldbalanceOrg, nb / 100::DOUBLE AS newbalanceOrig,
           CASE WHEN k % 229 = 0 THEN NULL ELSE 'M' || CAST(k % 97 AS VARCHAR) END AS nameDest,
           od / 100::DOUBLE AS oldbalanceDest, nd / 100::DOUBLE AS newbalanceDest,
           CAST(CASE WHEN (t IN ('TRANSFER', 'CASH_OUT') AND nb = 0 AND ob > 0 AND k % 4 <> 0)
                       OR k % 389 = 0 THEN 1 ELSE 0 END AS BIGINT) AS isFraud,
           CAST(CASE WHEN t = 'TRANSFER' AND c > 20000 THEN 1 ELSE 0 END AS BIGINT) AS isFlaggedFraud
    FROM moved
), raw AS (
    SELECT * EXCLUDE (k) FROM base
    UNION ALL SELECT * EXCLUDE (k) FROM base WHERE k % 101 = 0
    UNION ALL SELECT * EXCLUDE (k) REPLACE ('BAD_TYPE' AS type) FROM base WHERE k % 103 = 0
    UNION ALL SELECT * EXCLUDE (k) REPLACE (nameDest || 'x' AS nameDest) FROM base WHERE k % 107 = 0
), deduped AS (
    SELECT * FROM raw
    QUALIFY row_number() OVER (
        PARTITION BY step, nameOrig, amount, nameDest
        ORDER BY type NULLS FIRST, oldbalanceOrg NULLS FIRST, newbalanceOrig NULLS FIRST,
                 oldbalanceDest NULLS FIRST, newbalanceDest NULLS FIRST,
                 isFraud NULLS FIRST, isFlaggedFraud NULLS FIRST) = 1
), clean AS (
    SELECT * FROM deduped
    WHERE nameOrig IS NOT NULL AND nameDest IS NOT NULL AND amount > 0
      AND type IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'DEBIT', 'CASH_IN')
), cutoff AS (
    SELECT quantile_disc(amount, 0.95) AS threshold FROM clean
), features AS (
    SELECT clean.*,
           oldbalanceOrg - newbalanceOrig - amount AS balance_diff_orig,
           newbalanceDest - oldbalanceDest - amount AS balance_diff_dest,
           CAST(coalesce(newbalanceOrig = 0 AND oldbalanceOrg > 0, false) AS BIGINT) AS orig_balance_zero_after,
           CAST(coalesce(newbalanceDest = oldbalanceDest AND amount > 0, false) AS BIGINT) AS dest_balance_unchanged,
           amount / nullif(oldbalanceOrg + 1, 0) AS amount_to_balance_ratio,
           CAST(amount > (SELECT threshold FROM cutoff) AS BIGINT) AS is_large_transaction,
           CAST(step % 24 AS BIGINT) AS hour_of_step,
           CAST(coalesce(list_position(['PAYMENT', 'TRANSFER', 'CASH_OUT', 'DEBIT', 'CASH_IN'], type), 0)
                AS BIGINT) AS type_encoded,
           CAST(type IN ('TRANSFER', 'CASH_OUT') AS BIGINT) AS is_transfer_or_cashout,
           oldbalanceOrg - newbalanceOrig AS net_orig_change,
           newbalanceDest - oldbalanceDest AS net_dest_change
    FROM clean
), odds AS (
    SELECT *,
           -4::DOUBLE + 2.5::DOUBLE * orig_balance_zero_after + 1::DOUBLE * dest_balance_unchanged
             + 1.5::DOUBLE * is_transfer_or_cashout + 1.2::DOUBLE * is_large_transaction
             + 0.05::DOUBLE * amount_to_balance_ratio + (-0.002)::DOUBLE * balance_diff_orig
             + 0.01::DOUBLE * hour_of_step AS za,
           -3::DOUBLE + 3::DOUBLE * orig_balance_zero_after + 2::DOUBLE * is_transfer_or_cashout
             + (-0.5)::DOUBLE * dest_balance_unchanged + 0.1::DOUBLE * type_encoded AS zb
    FROM features WHERE step > 600
), scored AS (
    SELECT * EXCLUDE (za, zb), 1 / (1 + exp(-za)) AS pa, 1 / (1 + exp(-zb)) AS pb,
           CAST(1 / (1 + exp(-za)) > 0.5 AS BIGINT) AS predicted_isFraud,
           DATE '2024-01-01' + CAST((step - 1) // 24 AS INTEGER) AS run_date,
           CAST((step - 1) % 24 AS BIGINT) AS run_hour
    FROM odds
), reported AS (
    SELECT *, round(pa, 4) AS fraud_probability,
           CASE WHEN pa >= 0.7 THEN 'HIGH' WHEN pa >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
           CASE WHEN orig_balance_zero_after = 1 THEN 'Account drained to zero'
                WHEN dest_balance_unchanged = 1 THEN 'Destination balance unchanged'
                WHEN is_large_transaction = 1 THEN 'Large transaction amount'
                WHEN is_transfer_or_cashout = 1 THEN 'High-risk transaction type'
                ELSE 'Multiple fraud signals detected' END AS top_reason
    FROM scored
), alerts AS (
    SELECT *, 'PENDING_REVIEW' AS alert_status FROM reported WHERE risk_level = 'HIGH'
), summaries AS (
    SELECT run_date AS summary_date, count(*) AS total_transactions,
           count(*) FILTER (WHERE predicted_isFraud = 1) AS flagged_count,
           count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count,
           count(*) FILTER (WHERE risk_level = 'MEDIUM') AS medium_risk_count,
           count(*) FILTER (WHERE risk_level = 'LOW') AS low_risk_count,
           round(sum(amount) FILTER (WHERE risk_level <> 'LOW'), 2) AS total_amount_at_risk,
           {MEAN_SCORE} AS avg_fraud_probability
    FROM reported GROUP BY run_date
), both_models AS (
    SELECT run_date, isFraud, 'fraud_logistic_regression' AS model_name, pa AS p FROM scored
    UNION ALL
    SELECT run_date, isFraud, 'fraud_boosted_tree', pb FROM scored
), ranked AS (
    SELECT *, rank() OVER by_score + (count(*) OVER same_score - 1) / 2::DOUBLE AS mid_rank
    FROM both_models
    WINDOW by_score AS (PARTITION BY run_date, model_name ORDER BY p),
           same_score AS (PARTITION BY run_date, model_name, p)
), counted AS (
    SELECT run_date, model_name, sum(isFraud)::DOUBLE AS pos, sum(1 - isFraud)::DOUBLE AS neg,
           (count(*) FILTER (WHERE p > 0.5 AND isFraud = 1))::DOUBLE AS hit,
           (count(*) FILTER (WHERE p > 0.5))::DOUBLE AS flagged,
           sum(mid_rank) FILTER (WHERE isFraud = 1) AS rank_sum,
           avg(-CASE WHEN isFraud = 1 THEN ln(least(greatest(p, 0.0001), 0.9999))
                     ELSE ln(1 - least(greatest(p, 0.0001), 0.9999)) END) AS loss
    FROM ranked GROUP BY run_date, model_name
), evaluations AS (
    SELECT run_date, model_name, round(hit / nullif(flagged, 0), 4) AS precision,
           round(hit / nullif(pos, 0), 4) AS recall,
           round(2 * hit / nullif(flagged + pos, 0), 4) AS f1_score,
           round((rank_sum - pos * (pos + 1) / 2) / nullif(pos * neg, 0), 4) AS roc_auc,
           round(loss, 4) AS log_loss, 'SUCCESS' AS status
    FROM counted
), names AS (
    SELECT unnest(['fraud_logistic_regression', 'fraud_boosted_tree', 'fraud_kmeans_anomaly']) AS model_name
)
"""

KEY = "step, nameOrig, amount, nameDest"
RUN = "DATE '2024-01-30'"
AS_OF = f"summary_date = {RUN}"
PREDICTION_COLUMNS = (
    "step, type, amount, nameOrig, nameDest, oldbalanceOrg, newbalanceOrig, oldbalanceDest, "
    "newbalanceDest, predicted_isFraud, fraud_probability, risk_level, isFraud"
)
ALERT_COLUMNS = (
    "step, type, amount, nameOrig, nameDest, fraud_probability, risk_level, alert_status, top_reason"
)
BY_SCORE = "fraud_probability DESC, step, nameOrig, amount, nameDest, type"
RATES = "round(count(*) FILTER (WHERE isFraud = 1) * 100::DOUBLE / count(*), {digits})"
AT_RISK = "round(coalesce(sum(amount) FILTER (WHERE risk_level <> 'LOW'), 0), 2)"

# Distance to each fixed centroid, the same numbers in the same order as the Spark query.
CENTROIDS = [
    [0.0, 0.0, 0.5, 0, 0, 0, 0],
    [0.0, 0.0, 0.5, 0, 0, 0, 1],
    [0.0, -50.0, 1.0, 0, 1, 0, 0],
    [0.0, -50.0, 1.0, 0, 1, 0, 1],
    [-50.0, 0.0, 20.0, 0, 0, 0, 0],
    [-20.0, 0.0, 5.0, 1, 0, 0, 1],
    [-200.0, 0.0, 10.0, 1, 0, 1, 1],
    [-200.0, -200.0, 100.0, 0, 1, 1, 0],
]
CLUSTER_COLUMNS = [
    "balance_diff_orig",
    "balance_diff_dest",
    "amount_to_balance_ratio",
    "orig_balance_zero_after",
    "dest_balance_unchanged",
    "is_large_transaction",
    "is_transfer_or_cashout",
]
DISTANCES = ", ".join(
    " + ".join(
        f"({c} - ({v})::DOUBLE) * ({c} - ({v})::DOUBLE)" for c, v in zip(CLUSTER_COLUMNS, centroid)
    )
    for centroid in CENTROIDS
)

SOURCES = {"read_transactions_csv": "SELECT * FROM raw"}

CHECKS = {
    "ingestion_log_row": f"""SELECT {RUN} AS run_date, 'raw.transactions' AS table_name,
        'SUCCESS' AS status, count(*) AS row_count FROM raw""",
    "load_stats": """SELECT count(*) AS total_rows, sum(isFraud)::BIGINT AS fraud_rows,
        round(sum(isFraud)::DOUBLE / count(*) * 100, 4) AS fraud_pct FROM raw""",
    "dq_null_keys": """SELECT count(*) AS records_found FROM raw
        WHERE amount IS NULL OR nameOrig IS NULL OR nameDest IS NULL OR type IS NULL""",
    "dq_non_positive_amount": f"SELECT count(*) AS records_found FROM raw WHERE {NOT_POSITIVE}",
    "dq_duplicates": f"""SELECT (SELECT count(*) FROM raw) - count(*) AS records_found
        FROM (SELECT DISTINCT {KEY} FROM raw
              WHERE step IS NOT NULL AND nameOrig IS NOT NULL
                AND amount IS NOT NULL AND nameDest IS NOT NULL)""",
    "dq_impossible_balance": f"SELECT count(*) AS records_found FROM raw WHERE {IMPOSSIBLE}",
    "validation_log_rows": f"""
        SELECT {RUN} AS run_date, 'null_amount_records' AS check_name, count(*) AS records_found,
               'Removed nulls' AS action_taken
        FROM raw WHERE amount IS NULL OR nameOrig IS NULL OR nameDest IS NULL OR type IS NULL
        UNION ALL
        SELECT {RUN}, 'negative_amount_records', count(*), 'Removed negatives'
        FROM raw WHERE {NOT_POSITIVE}
        UNION ALL
        SELECT {RUN}, 'duplicate_records', (SELECT count(*) FROM raw) - count(*), 'Removed duplicates'
        FROM (SELECT DISTINCT {KEY} FROM raw
              WHERE nameOrig IS NOT NULL AND amount IS NOT NULL AND nameDest IS NOT NULL)
        UNION ALL
        SELECT {RUN}, 'impossible_balance', count(*), 'Removed impossible balances'
        FROM raw WHERE {IMPOSSIBLE}""",
    "staging_check": """SELECT count(*) AS clean_rows,
        count(*) FILTER (WHERE isFraud = 1) AS fraud_rows,
        count(*) FILTER (WHERE amount <= 0) AS bad_amount_rows FROM clean""",
    "feature_checks": """
        SELECT 'negative_ratio' AS check_name, count(*) AS records_found
        FROM features WHERE amount_to_balance_ratio < 0
        UNION ALL SELECT 'invalid_type', count(*) FROM features WHERE type_encoded = 0
        UNION ALL SELECT 'hour_range', count(*) FROM features WHERE hour_of_step NOT BETWEEN 0 AND 23""",
}

CLEANING = {
    "dedup_transactions": "SELECT * FROM deduped",
    "filter_valid": """SELECT * FROM raw
        WHERE nameOrig IS NOT NULL AND nameDest IS NOT NULL AND amount > 0
          AND type IN ('PAYMENT', 'TRANSFER', 'CASH_OUT', 'DEBIT', 'CASH_IN')""",
    "clean_transactions": "SELECT * FROM clean",
}

FEATURES = {
    "large_amount_threshold": "SELECT threshold FROM cutoff",
    "build_features": "SELECT * FROM features",
    "feature_verify": f"""SELECT count(*) AS total_records, sum(isFraud)::BIGINT AS fraud_count,
        sum(orig_balance_zero_after)::BIGINT AS zero_balance_orig_count,
        sum(dest_balance_unchanged)::BIGINT AS unchanged_dest_count,
        sum(is_large_transaction)::BIGINT AS large_txn_count,
        round(avg(CAST(amount_to_balance_ratio AS DECIMAL(38,10))), 4) AS avg_amount_ratio FROM features""",
    "feature_log_row": f"""SELECT {RUN} AS run_date, count(*) AS total_records,
        sum(isFraud)::BIGINT AS fraud_records, {MEAN_AMOUNT} AS avg_amount,
        sum(is_large_transaction)::BIGINT AS large_txn_count,
        sum(orig_balance_zero_after)::BIGINT AS zero_balance_count FROM features""",
    "latest_feature_log": f"""SELECT count(*) AS total_records, sum(isFraud)::BIGINT AS fraud_records,
        {MEAN_AMOUNT} AS avg_amount, sum(is_large_transaction)::BIGINT AS large_txn_count,
        sum(orig_balance_zero_after)::BIGINT AS zero_balance_count
        FROM features WHERE (step - 1) // 24 = (SELECT max((step - 1) // 24) FROM features)""",
    **{
        f"f_{name}": f"SELECT {KEY}, {name} FROM features"
        for name in (
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
    },
}

METRICS_OF_RUN = """(
        SELECT sum(isFraud)::DOUBLE AS pos, sum(1 - isFraud)::DOUBLE AS neg,
               (count(*) FILTER (WHERE predicted_isFraud = 1 AND isFraud = 1))::DOUBLE AS hit,
               (count(*) FILTER (WHERE predicted_isFraud = 1))::DOUBLE AS flagged,
               sum(mid_rank) FILTER (WHERE isFraud = 1) AS rank_sum,
               avg(-CASE WHEN isFraud = 1 THEN ln(least(greatest(pa, 0.0001), 0.9999))
                         ELSE ln(1 - least(greatest(pa, 0.0001), 0.9999)) END) AS loss
        FROM (SELECT *, rank() OVER (ORDER BY pa)
                        + (count(*) OVER (PARTITION BY pa) - 1) / 2::DOUBLE AS mid_rank
              FROM scored))"""
METRIC_COLUMNS = """round(hit / nullif(flagged, 0), 4) AS precision,
        round(hit / nullif(pos, 0), 4) AS recall,
        round(2 * hit / nullif(flagged + pos, 0), 4) AS f1_score,
        round((rank_sum - pos * (pos + 1) / 2) / nullif(pos * neg, 0), 4) AS roc_auc,
        round(loss, 4) AS log_loss"""

# The given ensembles of trees, a CASE for each tree.
FOREST = """((CASE WHEN orig_balance_zero_after <= 0.5
                THEN CASE WHEN balance_diff_orig <= -100 THEN 0.125 ELSE 0.03125 END
                ELSE CASE WHEN is_transfer_or_cashout <= 0.5 THEN 0.25 ELSE 0.875 END END
         + CASE WHEN type_encoded <= 1.5 THEN 0.0625 WHEN type_encoded > 3.5 THEN 0.1875
                WHEN amount_to_balance_ratio <= 0.95::DOUBLE THEN 0.3125 ELSE 0.9375 END
         + CASE WHEN hour_of_step <= 11 THEN 0.375 WHEN net_dest_change <= 0 THEN 0.4375 ELSE 0.5 END)::DOUBLE / 3)"""
BOOSTED = """1 / (1 + exp(-2 * (
           CASE WHEN orig_balance_zero_after <= 0.5 THEN CASE WHEN net_orig_change <= 60 THEN -0.9375 ELSE -0.75 END
                ELSE CASE WHEN is_transfer_or_cashout <= 0.5 THEN -0.5 ELSE 0.6875 END END
         + CASE WHEN dest_balance_unchanged <= 0.5 THEN -0.0625 WHEN is_large_transaction <= 0.5 THEN 0.09375
                ELSE 0.21875 END
         + CASE WHEN balance_diff_dest <= -50 THEN 0.03125 ELSE -0.015625 END)::DOUBLE))"""
LINEAR = """1 / (1 + exp(-(-4::DOUBLE + 2.5::DOUBLE * orig_balance_zero_after + 1::DOUBLE * dest_balance_unchanged
             + 1.5::DOUBLE * is_transfer_or_cashout + 1.2::DOUBLE * is_large_transaction
             + 0.05::DOUBLE * amount_to_balance_ratio + (-0.002)::DOUBLE * balance_diff_orig
             + 0.01::DOUBLE * hour_of_step)))"""
FEATURE_NAMES = [
    "balance_diff_orig", "balance_diff_dest", "orig_balance_zero_after", "dest_balance_unchanged",
    "amount_to_balance_ratio", "is_large_transaction", "hour_of_step", "type_encoded",
    "is_transfer_or_cashout", "net_orig_change", "net_dest_change",
]
MOVED = ", ".join(f"CASE WHEN v.feature = '{f}' THEN b.{f} ELSE a.{f} END AS {f}" for f in FEATURE_NAMES)
# Each feature's values move along a random order of the rows by a number of places of its own.
ATTRIBUTIONS = """
    , in_order AS (
        SELECT *, row_number() OVER (ORDER BY md5('42:' || step || '|' || nameOrig || '|'
                    || CAST(round(amount * 100) AS BIGINT) || '|' || nameDest)) - 1 AS place, count(*) OVER () AS n
        FROM features WHERE step > 600
    ), variants AS (
        SELECT feature, 1 + ('0x' || substr(md5('42:' || feature), 1, 7))::BIGINT % (SELECT count(*) - 1 FROM in_order) AS places
        FROM (SELECT unnest({names}) AS feature)
        UNION ALL SELECT '', 0
    ), with_moved AS (
        SELECT v.feature, a.isFraud, {moved}
        FROM in_order a CROSS JOIN variants v JOIN in_order b ON b.place = (a.place + v.places) % a.n
    ), losses AS (
        SELECT feature, avg(-CASE WHEN isFraud = 1 THEN ln(least(greatest(p, 0.0001), 0.9999))
                                  ELSE ln(1 - least(greatest(p, 0.0001), 0.9999)) END) AS loss
        FROM (SELECT feature, isFraud, {model} AS p FROM with_moved) GROUP BY feature
    )
    SELECT feature, round(loss - (SELECT loss FROM losses WHERE feature = ''), 6) AS attribution
    FROM losses WHERE feature <> '' ORDER BY attribution DESC, feature"""

MODELS = {
    "train_logistic": f"""SELECT unnest({["__INTERCEPT__", *FEATURE_NAMES]}) AS feature,
        (SELECT count(*) FROM features WHERE step <= 600) AS rows, true AS optimal""",
    "train_boosted_tree": """SELECT 'fraud_boosted_tree' AS model_name, count(*) AS rows, true AS settled
        FROM features WHERE step <= 600""",
    "train_kmeans": """SELECT 'fraud_kmeans_anomaly' AS model_name, 8::BIGINT AS clusters, count(*) AS rows,
        true AS settled FROM features WHERE step <= 600""",
    "predict": "\nUNION ALL\n".join(
        f"""SELECT {KEY}, '{name}' AS model_name, CAST({model} > 0.5 AS BIGINT) AS predicted_isFraud,
        round({model}, 4) AS probability FROM features WHERE step > 600"""
        for name, model in (
            ("fraud_logistic_regression", LINEAR),
            ("fraud_random_forest", FOREST),
            ("fraud_boosted_tree", BOOSTED),
        )
    ),
    "model_weights": """SELECT feature, weight FROM (VALUES ('__INTERCEPT__', -4::DOUBLE),
            ('orig_balance_zero_after', 2.5::DOUBLE), ('dest_balance_unchanged', 1::DOUBLE),
            ('is_transfer_or_cashout', 1.5::DOUBLE), ('is_large_transaction', 1.2::DOUBLE),
            ('amount_to_balance_ratio', 0.05::DOUBLE), ('balance_diff_orig', -0.002::DOUBLE),
            ('hour_of_step', 0.01::DOUBLE)) AS w(feature, weight) ORDER BY abs(weight) DESC, feature LIMIT 5""",
    "global_explain": ATTRIBUTIONS.format(names=FEATURE_NAMES, moved=MOVED, model=LINEAR),
    "global_explain_boosted": ATTRIBUTIONS.format(names=FEATURE_NAMES, moved=MOVED, model=BOOSTED),
    "split_by_step": f"""SELECT {KEY}, CASE WHEN step > 600 THEN 'eval' ELSE 'train' END AS split
        FROM clean""",
    "split_by_step_100": f"""SELECT {KEY}, CASE WHEN step > 100 THEN 'eval' ELSE 'train' END AS split
        FROM clean""",
    "class_weights": f"""SELECT {KEY}, isFraud,
        CASE isFraud WHEN 1 THEN 10::DOUBLE WHEN 0 THEN 1::DOUBLE END AS explicit_weight,
        round(count(*) OVER () / (2::DOUBLE * count(*) OVER (PARTITION BY isFraud)), 6) AS auto_weight
        FROM clean WHERE step <= 600""",
    "kmeans_assign": f"""SELECT {KEY}, CAST(list_position(d, list_min(d)) AS BIGINT) AS centroid_id,
        round(sqrt(list_min(d)), 4) AS centroid_distance
        FROM (SELECT {KEY}, [{DISTANCES}] AS d FROM features)""",
    "evaluate_classifier": f"SELECT {METRIC_COLUMNS} FROM {METRICS_OF_RUN}",
    "score_linear": f"""SELECT {KEY}, predicted_isFraud, round(pa, 4) AS probability FROM scored""",
    "evaluation_log_row": f"""SELECT {RUN} AS run_date, 'fraud_logistic_regression' AS model_name,
        {METRIC_COLUMNS}, 'SUCCESS' AS status FROM {METRICS_OF_RUN}""",
    "training_log_rows": f"""SELECT {RUN} AS run_date, model_name,
        (SELECT count(*) FROM clean WHERE step <= 600) AS training_rows,
        (SELECT count(*) FROM clean WHERE step > 600) AS eval_rows,
        0.5::DOUBLE AS threshold_used, 'SUCCESS' AS status FROM names""",
    "compare_models": """SELECT model_name, precision, recall, f1_score, roc_auc FROM evaluations
        ORDER BY f1_score DESC NULLS LAST, model_name""",
}

REJOINED_PREDICTIONS = f"""(
        SELECT f.step, f.type, f.amount, f.nameOrig, f.nameDest, f.oldbalanceOrg, f.newbalanceOrig,
               f.oldbalanceDest, f.newbalanceDest, p.predicted_isFraud, p.fraud_probability,
               p.risk_level, f.isFraud
        FROM reported p JOIN features f
          ON f.nameOrig = p.nameOrig AND f.step = p.step AND f.amount = p.amount)"""

SCORING = {
    "score_window": f"SELECT {KEY} FROM features WHERE step > 600",
    "fraud_probability": f"SELECT {KEY}, fraud_probability FROM reported",
    "risk_level": f"SELECT {KEY}, risk_level FROM reported",
    "fraud_predictions": f"SELECT {RUN} AS prediction_date, {PREDICTION_COLUMNS} FROM reported",
    "fraud_predictions_rejoined": f"""SELECT {RUN} AS prediction_date, {PREDICTION_COLUMNS}
        FROM {REJOINED_PREDICTIONS}""",
    "rejoin_on_key": """SELECT p.fraud_probability, p.risk_level, f.*
        FROM reported p JOIN features f
          ON f.nameOrig = p.nameOrig AND f.step = p.step AND f.amount = p.amount""",
    "top_reason": f"SELECT {KEY}, top_reason FROM reported",
    "high_risk_alerts": f"SELECT {RUN} AS alert_date, {ALERT_COLUMNS} FROM alerts",
    "high_risk_alerts_rejoined": f"""SELECT {RUN} AS alert_date, p.step, p.type, p.amount, p.nameOrig,
        p.nameDest, p.fraud_probability, p.risk_level, p.alert_status,
        CASE WHEN f.orig_balance_zero_after = 1 THEN 'Account drained to zero'
             WHEN f.dest_balance_unchanged = 1 THEN 'Destination balance unchanged'
             WHEN f.is_large_transaction = 1 THEN 'Large transaction amount'
             WHEN f.is_transfer_or_cashout = 1 THEN 'High-risk transaction type'
             ELSE 'Multiple fraud signals detected' END AS top_reason
        FROM alerts p JOIN features f
          ON f.nameOrig = p.nameOrig AND f.step = p.step AND f.amount = p.amount""",
    "daily_summary": f"""SELECT {RUN} AS summary_date, count(*) AS total_transactions,
        count(*) FILTER (WHERE predicted_isFraud = 1) AS flagged_count,
        count(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk_count,
        count(*) FILTER (WHERE risk_level = 'MEDIUM') AS medium_risk_count,
        count(*) FILTER (WHERE risk_level = 'LOW') AS low_risk_count,
        {AT_RISK} AS total_amount_at_risk,
        {MEAN_SCORE} AS avg_fraud_probability,
        'fraud_logistic_regression' AS model_used FROM reported""",
    "daily_summary_history": "SELECT *, 'fraud_logistic_regression' AS model_used FROM summaries",
    "risk_level_hit_rate": f"""SELECT risk_level, count(*) AS total,
        sum(isFraud)::BIGINT AS actual_fraud, {RATES.format(digits=2)} AS hit_rate_pct,
        {MEAN_SCORE} AS avg_score
        FROM reported GROUP BY risk_level ORDER BY hit_rate_pct DESC, risk_level""",
    "top_risk_transactions": f"""SELECT type, amount, nameOrig, nameDest, fraud_probability,
        risk_level, isFraud FROM reported ORDER BY {BY_SCORE} LIMIT 20""",
    "prediction_count": "SELECT count(*) AS prediction_count FROM reported",
    "alert_totals": """SELECT count(*) AS high_risk,
        coalesce(round(sum(amount), 2), 0) AS total_amount FROM alerts""",
}

DASHBOARDS = {
    "kpi_total_transactions": f"""SELECT sum(total_transactions)::BIGINT AS total_transactions
        FROM summaries WHERE {AS_OF}""",
    "kpi_high_risk": f"""SELECT sum(high_risk_count)::BIGINT AS high_risk_count
        FROM summaries WHERE {AS_OF}""",
    "kpi_amount_at_risk": f"""SELECT round(sum(total_amount_at_risk), 2) AS total_amount_at_risk
        FROM summaries WHERE {AS_OF}""",
    "kpi_avg_score": f"""SELECT {MEAN.format(x="avg_fraud_probability", f=10000)} AS avg_fraud_probability
        FROM summaries WHERE {AS_OF}""",
    "daily_risk_trend": """SELECT summary_date, high_risk_count, medium_risk_count, low_risk_count
        FROM summaries ORDER BY summary_date DESC""",
    "risk_distribution": """SELECT risk_level, count(*) AS transaction_count,
        round(count(*) * 100::DOUBLE / (SELECT count(*) FROM reported), 2) AS pct_of_total
        FROM reported GROUP BY risk_level ORDER BY transaction_count DESC, risk_level""",
    "fraud_by_type": f"""SELECT type, count(*) AS total_transactions,
        sum(isFraud)::BIGINT AS actual_fraud_count,
        sum(predicted_isFraud)::BIGINT AS predicted_fraud_count,
        {RATES.format(digits=2)} AS fraud_rate_pct
        FROM reported GROUP BY type ORDER BY actual_fraud_count DESC, type""",
    "alert_queue": f"""SELECT alert_date, type, round(amount, 2) AS amount, nameOrig, nameDest,
        fraud_probability, risk_level, top_reason, alert_status
        FROM (SELECT run_date AS alert_date, * FROM alerts) ORDER BY {BY_SCORE}""",
    "alerts_by_status": """SELECT alert_status, count(*) AS alert_count FROM alerts
        GROUP BY alert_status ORDER BY alert_count DESC""",
    "top_alert_reasons": """SELECT top_reason, count(*) AS occurrence_count,
        round(count(*) * 100::DOUBLE / (SELECT count(*) FROM alerts), 2) AS pct_of_alerts
        FROM alerts GROUP BY top_reason ORDER BY occurrence_count DESC, top_reason LIMIT 10""",
    "alerts_by_type": f"""SELECT type, count(*) AS alert_count,
        round(sum(amount), 2) AS total_amount_at_risk, {MEAN_AMOUNT} AS avg_alert_amount,
        {MEAN_SCORE} AS avg_fraud_score
        FROM alerts GROUP BY type ORDER BY total_amount_at_risk DESC, type""",
    "alerts_by_hour": f"""SELECT run_hour AS alert_hour, count(*) AS alert_count,
        {MEAN_SCORE} AS avg_fraud_probability,
        round(sum(amount), 2) AS total_amount
        FROM alerts GROUP BY run_hour ORDER BY run_hour""",
    "top_risk_accounts": """SELECT nameOrig, count(*) AS alert_count,
        round(sum(amount), 2) AS total_amount_flagged,
        max(fraud_probability) AS max_fraud_score,
        string_agg(DISTINCT type, ',' ORDER BY type) AS transaction_types
        FROM alerts GROUP BY nameOrig HAVING count(*) > 1
        ORDER BY alert_count DESC, nameOrig LIMIT 20""",
    "latest_model_metrics": """SELECT model_name, f1_score, precision, recall, roc_auc
        FROM evaluations ORDER BY run_date DESC, model_name LIMIT 1""",
    "model_history": """SELECT run_date, model_name, f1_score, precision, recall, roc_auc, log_loss
        FROM evaluations ORDER BY run_date DESC, model_name""",
    "model_comparison": """SELECT model_name, run_date, f1_score, precision, recall, roc_auc, log_loss,
        status FROM evaluations ORDER BY run_date DESC, f1_score DESC NULLS LAST, model_name""",
    "training_volume": """SELECT model_name, run_date,
        (SELECT count(*) FROM clean WHERE step <= 600) AS training_rows, eval_rows,
        0.5::DOUBLE AS threshold_used
        FROM names, (SELECT run_date, count(*) AS eval_rows FROM scored GROUP BY run_date)
        ORDER BY run_date DESC, model_name""",
    "score_histogram": f"""SELECT
        CASE WHEN fraud_probability < 0.2 THEN '0.0 – 0.2' WHEN fraud_probability < 0.4 THEN '0.2 – 0.4'
             WHEN fraud_probability < 0.6 THEN '0.4 – 0.6' WHEN fraud_probability < 0.8 THEN '0.6 – 0.8'
             ELSE '0.8 – 1.0' END AS prob_bucket,
        count(*) AS transaction_count, sum(isFraud)::BIGINT AS actual_fraud_count,
        {RATES.format(digits=2)} AS fraud_hit_rate_pct
        FROM reported GROUP BY prob_bucket ORDER BY prob_bucket""",
    "fraud_rate_heatmap": f"""SELECT type,
        CASE (step % 24) // 6 WHEN 0 THEN 'Night (0–5)' WHEN 1 THEN 'Morning (6–11)'
             WHEN 2 THEN 'Afternoon (12–17)' ELSE 'Evening (18–23)' END AS time_of_day,
        count(*) AS transaction_count, sum(isFraud)::BIGINT AS fraud_count,
        {RATES.format(digits=4)} AS fraud_rate_pct
        FROM clean GROUP BY type, time_of_day ORDER BY fraud_rate_pct DESC, type, time_of_day""",
    "amount_vs_score": f"""SELECT type, round(amount, 2) AS amount, fraud_probability, risk_level,
        isFraud AS actual_fraud_label FROM reported WHERE fraud_probability > 0.1
        ORDER BY {BY_SCORE} LIMIT 5000""",
    "filter_date_range": f"""SELECT type, count(*) AS alert_count,
        round(sum(amount), 2) AS total_amount_at_risk, {MEAN_AMOUNT} AS avg_alert_amount,
        {MEAN_SCORE} AS avg_fraud_score
        FROM alerts WHERE run_date BETWEEN DATE '2024-01-27' AND DATE '2024-01-29'
        GROUP BY type ORDER BY total_amount_at_risk DESC, type""",
    "filter_date_range_summary": """SELECT summary_date, high_risk_count, medium_risk_count,
        low_risk_count FROM summaries
        WHERE summary_date BETWEEN DATE '2024-01-27' AND DATE '2024-01-29'
        ORDER BY summary_date DESC""",
    "filter_dropdown": """SELECT alert_status, count(*) AS alert_count FROM alerts
        WHERE risk_level IN ('HIGH') AND type IN ('TRANSFER', 'CASH_OUT')
        GROUP BY alert_status ORDER BY alert_count DESC""",
}

TRIALS = {
    "write_replace": "SELECT * FROM raw WHERE step <= 100",
    "ensure_tables": "SELECT * FROM clean",
    "write_append": "SELECT *, 'fraud_logistic_regression' AS model_used FROM summaries",
    "append_log_row": f"""SELECT {RUN} AS run_date, 'raw.transactions' AS table_name,
        'SUCCESS' AS status, count(*) AS row_count FROM raw""",
    "gate_load": """SELECT rows_checked, count(k) > 0 AND coalesce(sum(f) * 100::DOUBLE / count(k), 0) <= 10 AS passes
        FROM (VALUES ('all'), ('none'), ('fraud'), ('PAYMENT'), ('TRANSFER'), ('CASH_OUT'), ('DEBIT'), ('CASH_IN')) c(rows_checked)
        LEFT JOIN (SELECT type, isFraud AS f, 1 AS k FROM raw) r
          ON rows_checked = 'all' OR (rows_checked = 'fraud' AND f = 1) OR rows_checked = type
        GROUP BY rows_checked""",
    "gate_non_empty": """SELECT 'hour ' || h AS rows_checked, EXISTS (SELECT 1 FROM raw WHERE step % 24 = h) AS passes
        FROM (VALUES (0), (5), (23)) c(h)
        UNION ALL SELECT 'later', EXISTS (SELECT 1 FROM raw WHERE step > 100000)""",
    "gate_features": """SELECT 'all' AS rows_checked, NOT EXISTS (SELECT 1 FROM features WHERE amount_to_balance_ratio < 0
            OR type_encoded = 0 OR hour_of_step NOT BETWEEN 0 AND 23) AS passes
        UNION ALL SELECT 'debts', NOT EXISTS (SELECT 1 FROM features WHERE orig_balance_zero_after = 1 AND amount > 0)""",
}

ORACLE = {
    name: TABLES + select
    for group in (SOURCES, CHECKS, CLEANING, FEATURES, MODELS, SCORING, DASHBOARDS, TRIALS)
    for name, select in group.items()
}
