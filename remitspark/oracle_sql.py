"""The registered queries once more, as plain SQL over the driver's tables."""

from __future__ import annotations

TRANSACTIONS = """
transactions AS (
    SELECT
        'T' || o_orderkey AS transaction_id,
        o_orderdate + to_seconds((o_orderkey * 37) % 86400) AS transaction_ts,
        'M' || ((o_orderkey * 7) % 53) AS merchant_id,
        CASE WHEN o_orderkey % 23 <> 0 THEN 'C' || o_custkey END AS customer_id,
        'PM' || substr(o_orderpriority, 1, 1) AS payment_method_id,
        CAST(o_totalprice AS DECIMAL(18, 2)) AS amount,
        CASE WHEN o_orderkey % 3 = 0 THEN 'USD' ELSE 'INR' END AS currency,
        CASE o_orderkey % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'DECLINED' WHEN 2 THEN 'REFUNDED'
             WHEN 3 THEN 'PENDING' ELSE 'SUCCESS' END AS status,
        o_orderkey % 37 = 0 AS is_fraud_flag,
        CASE o_orderkey % 7 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'WEB' WHEN 3 THEN 'WEB'
             WHEN 4 THEN 'POS' WHEN 5 THEN 'TABLET' END AS device_type,
        r_name AS region,
        o_orderkey AS k
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""

RAW = """
raw AS (
    SELECT
        'batch_' || ((k // 524288) * 8 + k % 8) || '.csv' AS source_file,
        k AS row_pos,
        CASE WHEN k % 97 = 0 THEN ''
             WHEN k % 97 IN (1, 17) AND k >= 9 THEN 'T' || (k - 8)
             ELSE transaction_id END AS transaction_id,
        CASE k % 97 WHEN 2 THEN '' WHEN 3 THEN '   ' WHEN 4 THEN '2026-13-45T00:00:00'
             ELSE CASE k % 4 WHEN 0 THEN strftime(transaction_ts, '%Y-%m-%dT%H:%M:%S')
                  WHEN 1 THEN strftime(transaction_ts, '%d-%m-%Y %H:%M')
                  WHEN 2 THEN strftime(transaction_ts, '%m/%d/%Y %I:%M %p')
                  ELSE strftime(transaction_ts, '%Y/%m/%d') END
             END AS transaction_ts,
        CASE WHEN k % 97 = 11 THEN '' ELSE merchant_id END AS merchant_id,
        customer_id,
        CASE WHEN k % 97 <> 12 THEN payment_method_id END AS payment_method_id,
        CASE k % 97 WHEN 5 THEN '' WHEN 6 THEN 'abc' WHEN 7 THEN '0.001' WHEN 8 THEN '10000000.01'
             ELSE CAST(amount AS VARCHAR) END AS amount,
        CASE WHEN k % 97 IN (9, 14) THEN 'EUR' WHEN k % 97 = 15 THEN ' ' || lower(currency) || ' '
             ELSE currency END AS currency,
        CASE k % 97 WHEN 10 THEN 'UNKNOWN' WHEN 15 THEN lower(status) ELSE status END AS status,
        CASE WHEN is_fraud_flag THEN '1' ELSE '0' END AS is_fraud_flag,
        device_type,
        CASE k % 97 WHEN 13 THEN ' ' WHEN 14 THEN '' ELSE region END AS region
    FROM transactions
)"""

ANNOTATED = """
parsed AS (
    SELECT *,
        trim(coalesce(transaction_id, '')) AS id,
        CASE
            WHEN regexp_full_match(trim(transaction_ts), '\\d{4}-\\d{1,2}-\\d{1,2}T\\d{1,2}:\\d{1,2}:\\d{1,2}')
                THEN try_strptime(trim(transaction_ts), '%Y-%m-%dT%H:%M:%S')
            WHEN regexp_full_match(trim(transaction_ts), '\\d{1,2}-\\d{1,2}-\\d{4} \\d{1,2}:\\d{1,2}')
                THEN try_strptime(trim(transaction_ts), '%d-%m-%Y %H:%M')
            WHEN regexp_full_match(trim(transaction_ts), '\\d{1,2}/\\d{1,2}/\\d{4} \\d{1,2}:\\d{1,2} [AP]M')
                THEN try_strptime(trim(transaction_ts), '%m/%d/%Y %I:%M %p')
            WHEN regexp_full_match(trim(transaction_ts), '\\d{4}/\\d{1,2}/\\d{1,2}')
                THEN try_strptime(trim(transaction_ts), '%Y/%m/%d')
        END AS ts,
        CASE WHEN regexp_full_match(trim(amount), '[+-]?\\d+(\\.\\d*)?')
             THEN TRY_CAST(trim(amount) AS DECIMAL(38, 10)) END AS number
    FROM raw
),
checked AS (
    SELECT *,
        CASE
            WHEN id = '' THEN 'MISSING_TRANSACTION_ID'
            WHEN coalesce(transaction_ts, '') = '' THEN 'EMPTY_TIMESTAMP'
            WHEN ts IS NULL THEN 'INVALID_TIMESTAMP'
            WHEN trim(coalesce(amount, '')) = '' THEN 'EMPTY_AMOUNT'
            WHEN number IS NULL THEN 'INVALID_AMOUNT'
            WHEN number < 0.01 OR number > 10000000.00 THEN 'AMOUNT_OUT_OF_RANGE'
            WHEN upper(trim(coalesce(currency, ''))) NOT IN ('INR', 'USD') THEN 'INVALID_CURRENCY'
            WHEN upper(trim(coalesce(status, '')))
                 NOT IN ('SUCCESS', 'FAILED', 'DECLINED', 'REFUNDED', 'PENDING') THEN 'INVALID_STATUS'
            WHEN trim(coalesce(merchant_id, '')) = '' THEN 'MISSING_MERCHANT_ID'
            WHEN trim(coalesce(payment_method_id, '')) = '' THEN 'MISSING_PAYMENT_METHOD_ID'
            WHEN trim(coalesce(region, '')) = '' THEN 'MISSING_REGION'
        END AS fault
    FROM parsed
),
annotated AS (
    SELECT *,
        CASE WHEN id <> '' AND row_pos > min(CASE WHEN fault IS NULL THEN row_pos END)
                  OVER (PARTITION BY source_file, id) THEN 'DUPLICATE_TRANSACTION_ID'
             ELSE fault END AS rejection_reason
    FROM checked
),
valid AS (
    SELECT source_file, row_pos, id AS transaction_id, ts AS transaction_ts,
        trim(merchant_id) AS merchant_id,
        nullif(trim(coalesce(customer_id, '')), '') AS customer_id,
        trim(payment_method_id) AS payment_method_id,
        CAST(number AS DECIMAL(18, 2)) AS amount,
        upper(trim(currency)) AS currency,
        upper(trim(status)) AS status,
        trim(coalesce(is_fraud_flag, '')) = '1' AS is_fraud_flag,
        nullif(trim(coalesce(device_type, '')), '') AS device_type,
        trim(region) AS region
    FROM annotated
    WHERE rejection_reason IS NULL
)"""

FILES = """
per_file AS (
    SELECT source_file,
        count(*) FILTER (WHERE rejection_reason IS NULL) AS total_valid_records,
        count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS total_rejected_records,
        arg_min(ts, row_pos) FILTER (WHERE rejection_reason IS NULL) AS first_ts
    FROM annotated
    GROUP BY source_file
)"""

CLEAN = "WITH" + TRANSACTIONS
DIRTY = ",".join([CLEAN, RAW, ANNOTATED, FILES])

COLUMNS = (
    "transaction_id, transaction_ts, merchant_id, customer_id, payment_method_id, amount, "
    "currency, status, is_fraud_flag, device_type, region"
)
SUM = "CAST(sum(amount) AS DECIMAL(38, 2))"
AVG = "CAST(sum(amount) AS DOUBLE) / nullif(count(amount), 0)"
PERCENTAGE = "CAST(count(*) FILTER (WHERE {}) AS DOUBLE) * 100 / nullif(count(*), 0)"
SUCCESS_RATE = PERCENTAGE.format("status = 'SUCCESS'")


def _amount_by(key: str, total: str = "total_amount", average: str | None = "average_amount") -> str:
    average = f", {AVG} AS {average}" if average else ""
    return (
        f"SELECT {key}, count(*) AS transaction_count, {SUM} AS {total}{average} "
        f"FROM transactions GROUP BY {key}"
    )


# Names of results and literals of filters.
_ANALYTICS = {
    "total_transactions": "SELECT count(*) AS total_transactions FROM transactions",
    "total_amount": f"SELECT {SUM} AS total_transaction_amount FROM transactions",
    "average_amount": f"SELECT {AVG} AS average_transaction_amount FROM transactions",
    "min_max_amount": "SELECT min(amount) AS minimum_transaction_amount, "
    "max(amount) AS maximum_transaction_amount FROM transactions",
    "count_by_status": "SELECT status, count(*) AS transaction_count FROM transactions GROUP BY status "
    "ORDER BY transaction_count DESC, status",
    "amount_by_status": _amount_by("status") + " ORDER BY total_amount DESC, status",
    "amount_by_currency": _amount_by("currency") + " ORDER BY total_amount DESC, currency",
    "merchant_performance": _amount_by("merchant_id", "total_transaction_amount", "average_transaction_amount")
    + " ORDER BY total_transaction_amount DESC, merchant_id",
    "top_merchants": _amount_by("merchant_id", "total_transaction_amount", None)
    + " ORDER BY total_transaction_amount DESC, merchant_id LIMIT 10",
    "amount_by_region": _amount_by("region") + " ORDER BY total_amount DESC, region",
    "amount_by_device": _amount_by("device_type", average=None) + " ORDER BY transaction_count DESC, device_type",
    "amount_by_payment_method": _amount_by("payment_method_id", average=None)
    + " ORDER BY total_amount DESC, payment_method_id",
    "fraud_count": "SELECT count(*) AS fraud_transaction_count FROM transactions WHERE is_fraud_flag = TRUE",
    "fraud_amount": f"SELECT {SUM} AS fraud_transaction_amount FROM transactions WHERE is_fraud_flag = TRUE",
    "fraud_by_region": f"SELECT region, count(*) AS fraud_transaction_count, {SUM} AS fraud_amount "
    "FROM transactions WHERE is_fraud_flag = TRUE GROUP BY region ORDER BY fraud_amount DESC, region",
    "fraud_rate": f"SELECT {PERCENTAGE.format('is_fraud_flag')} AS fraud_rate_percentage FROM transactions",
    "daily_volume": "SELECT CAST(transaction_ts AS DATE) AS transaction_date, count(*) AS transaction_count, "
    f"{SUM} AS total_amount FROM transactions GROUP BY 1 ORDER BY 1",
    "daily_success_amount": "SELECT CAST(transaction_ts AS DATE) AS transaction_date, "
    f"count(*) AS successful_transactions, {SUM} AS successful_transaction_amount "
    "FROM transactions WHERE status = 'SUCCESS' GROUP BY 1 ORDER BY 1",
    "failed_declined": f"SELECT status, count(*) AS transaction_count, {SUM} AS total_amount FROM transactions "
    "WHERE status IN ('FAILED', 'DECLINED') GROUP BY status ORDER BY transaction_count DESC, status",
    "success_rate": f"SELECT {SUCCESS_RATE} AS success_rate_percentage FROM transactions",
    "merchant_success_rate": "SELECT merchant_id, count(*) AS total_transactions, "
    "count(*) FILTER (WHERE status = 'SUCCESS') AS successful_transactions, "
    f"{SUCCESS_RATE} AS success_rate_percentage FROM transactions GROUP BY merchant_id "
    "ORDER BY success_rate_percentage DESC, merchant_id",
    "high_value": "SELECT transaction_id, transaction_ts, merchant_id, customer_id, amount, currency, status, "
    "is_fraud_flag, region FROM transactions WHERE amount > 100000 ORDER BY amount DESC, transaction_id",
    "high_value_fraud": "SELECT transaction_id, transaction_ts, merchant_id, customer_id, amount, currency, "
    "status, region FROM transactions WHERE is_fraud_flag = TRUE AND amount > 100000 "
    "ORDER BY amount DESC, transaction_id",
    "monthly_volume": "SELECT CAST(date_trunc('month', transaction_ts) AS TIMESTAMP) AS transaction_month, "
    f"count(*) AS transaction_count, {SUM} AS total_amount FROM transactions GROUP BY 1 ORDER BY 1",
    "top_customers": f"SELECT customer_id, count(*) AS transaction_count, {SUM} AS total_amount, "
    f"{AVG} AS average_transaction_amount FROM transactions WHERE customer_id IS NOT NULL "
    "GROUP BY customer_id ORDER BY total_amount DESC, customer_id LIMIT 20",
    "loaded_count": "SELECT count(*) AS total_loaded_records FROM transactions",
    "preview": f"SELECT {COLUMNS} FROM transactions ORDER BY transaction_id LIMIT 10",
    "date_range": "SELECT min(transaction_ts) AS earliest_transaction, "
    "max(transaction_ts) AS latest_transaction FROM transactions",
    "status_distribution": "SELECT status, count(*) AS transaction_count FROM transactions GROUP BY status "
    "ORDER BY transaction_count DESC, status",
}

_PROCESSED_DIR = "'processed/year=' || year(first_ts) || strftime(first_ts, '/month=%m/day=%d/')"

#: What becomes of the odd files.
_ODD_FILES = ", ".join(
    f"('{name}', {valid}, {rejected}, {error})"
    for name, valid, rejected, error in [
        ("odd/empty.csv", 0, 0, f"'MISSING_REQUIRED_COLUMNS: {COLUMNS}'"),
        ("odd/_under.csv", 0, 0, "'HIDDEN_NAME'"),
        ("_odd/in_hidden_folder.csv", 0, 0, "'HIDDEN_NAME'"),
        ("odd/.dot.csv", 0, 0, "'HIDDEN_NAME'"),
        ("odd/lacks_region.csv", 0, 0, "'MISSING_REQUIRED_COLUMNS: region'"),
        ("odd/bytes.csv", 0, 0, "'INVALID_ENCODING'"),
        ("odd/swapped.csv", 1, 0, "NULL"),
        ("odd/lines.csv", 1, 1, "NULL"),
        ("odd/shapes.csv", 2, 0, "NULL"),
        ("odd/open.csv", 0, 0, "'FIELD_TOO_LARGE'"),
    ]
)

_CORRECTED = """, sent AS (
    SELECT 'batch_' || ((k // 524288) * 8 + k % 8) || '.csv' AS source_file,
        transaction_ts + INTERVAL 31 DAY AS transaction_ts, amount
    FROM transactions WHERE k % 8 = 3
), now AS (
    SELECT source_file, transaction_ts, amount FROM sent
    UNION ALL SELECT source_file, transaction_ts, amount FROM valid
    WHERE source_file NOT IN (SELECT source_file FROM sent)
)
SELECT source_file, count(*) AS valid_rows, CAST(sum(amount) AS DECIMAL(38, 2)) AS valid_amount,
    min(transaction_ts) AS first_ts, max(transaction_ts) AS last_ts,
    max(CASE WHEN source_file IN (SELECT source_file FROM sent) THEN 0 ELSE total_rejected_records END) AS rejected_rows
FROM now JOIN per_file USING (source_file) GROUP BY source_file"""

_DIRTY = {
    "validate_reasons": "SELECT source_file, row_pos, rejection_reason FROM annotated",
    "valid_rows": f"SELECT source_file, row_pos, {COLUMNS} FROM valid",
    "rejected_rows": "SELECT source_file, row_pos, transaction_id, transaction_ts, merchant_id, customer_id, "
    "payment_method_id, amount, currency, status, is_fraud_flag, device_type, region, rejection_reason "
    "FROM annotated WHERE rejection_reason IS NOT NULL",
    "rejects_by_reason": "SELECT rejection_reason, count(*) AS row_count FROM annotated "
    "WHERE rejection_reason IS NOT NULL GROUP BY rejection_reason",
    "audit_by_file": "SELECT source_file, total_valid_records, total_rejected_records, "
    f"CASE WHEN total_valid_records > 0 THEN {_PROCESSED_DIR} || replace(source_file, '.csv', '.parquet') "
    "END AS processed_key, "
    "CASE WHEN total_rejected_records > 0 THEN 'rejected/' || replace(source_file, '.csv', '_rejected.csv') "
    "END AS rejected_key FROM per_file",
    "partition_dates": "SELECT source_file, CAST(first_ts AS DATE) AS partition_date FROM per_file "
    "WHERE first_ts IS NOT NULL",
    "csv_round_trip": f"SELECT source_file, {COLUMNS} FROM valid",
    "loaded_high_value": _ANALYTICS["high_value"].replace("FROM transactions", "FROM valid"),
    "loaded_failed_declined": _ANALYTICS["failed_declined"].replace("FROM transactions", "FROM valid"),
    "rejected_round_trip": "SELECT source_file, "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in COLUMNS.split(", "))
    + ", rejection_reason FROM annotated WHERE rejection_reason IS NOT NULL",
    "ingest_audit": "SELECT source_file, total_valid_records, total_rejected_records, "
    f"CAST(NULL AS VARCHAR) AS file_error FROM per_file UNION ALL (VALUES {_ODD_FILES})",
    "reingest_corrected_files": _CORRECTED,
    "stream_reupload": _CORRECTED,
    "ingest_announced": "SELECT source_file, total_valid_records, total_rejected_records, "
    "CAST(NULL AS VARCHAR) AS file_error FROM per_file "
    "WHERE CAST(regexp_extract(source_file, 'batch_([0-9]+)', 1) AS BIGINT) % 4 <> 2",
    "announced_stream": "SELECT source_file, total_valid_records, total_rejected_records, "
    "CAST(NULL AS VARCHAR) AS file_error FROM per_file "
    "WHERE CAST(regexp_extract(source_file, 'batch_([0-9]+)', 1) AS BIGINT) % 4 <> 2",
    "stream_ingest": "SELECT source_file, total_valid_records, total_rejected_records, "
    f"CASE WHEN total_valid_records > 0 THEN {_PROCESSED_DIR} END AS processed_dir, "
    "CASE WHEN total_rejected_records > 0 THEN 'rejected/' END AS rejected_dir, "
    "CAST(NULL AS VARCHAR) AS file_error FROM per_file",
}

_NOTIFICATIONS = """
WITH keys AS (
    SELECT o_orderkey AS k,
        CASE WHEN o_orderkey % 11 = 0 THEN 'archive' ELSE 'landing' END AS bucket,
        CASE WHEN o_orderkey % 7 = 0 THEN 'other/' ELSE 'raw/' END || 'day ' || o_orderkey
            || CASE o_orderkey % 5 WHEN 0 THEN '.CSV' WHEN 1 THEN '.txt' ELSE '.csv' END AS key,
        CASE WHEN o_orderkey % 13 = 0 THEN 'other' WHEN o_orderkey % 13 = 1 THEN 'text'
             WHEN o_orderkey % 2 = 0 THEN 'bus' ELSE 'direct' END AS shape
    FROM orders
),
objects AS (
    SELECT k, bucket, key, shape FROM keys WHERE shape IN ('bus', 'direct')
    UNION ALL SELECT k, bucket, key || '.csv', shape FROM keys WHERE shape = 'direct'
    UNION ALL SELECT k, NULL, NULL, shape FROM keys WHERE shape IN ('other', 'text')
)
SELECT k AS message_id, bucket, key,
    CASE WHEN key IS NULL THEN 'INVALID_S3_EVENT'
         WHEN shape = 'bus' AND (bucket <> 'landing' OR key NOT LIKE 'raw/%') THEN 'NOT_MATCHED'
         WHEN lower(key) NOT LIKE '%.csv' THEN 'IGNORED_NON_CSV'
         ELSE 'ACCEPTED' END AS status,
    CASE WHEN key IS NULL THEN 'UNSUPPORTED_EVENT_FORMAT' END AS error
FROM objects"""

ORACLE_SQL: dict[str, str] = {
    **{name: f"{CLEAN} {sql}" for name, sql in _ANALYTICS.items()},
    **{name: f"{DIRTY} {sql}" for name, sql in _DIRTY.items()},
    "route_notifications": _NOTIFICATIONS,
}
