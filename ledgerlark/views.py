"""Transaction views over the test tables.

Each view is written once as SQL text that Spark and other engines read alike; Spark runs it on the
parquet tables, the oracles inline it. The joined sides are grouped by their key: knowing them unique, the
optimiser drops the joins from every query that needs neither city nor state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TXN_SQL = """
SELECT e.event_id AS record_id,
  concat('t', CAST(e.event_id AS STRING)) AS transaction_id,
  CAST(e.user_id AS STRING) AS card_number,
  CAST(e.ts AS TIMESTAMP) AS transaction_time,
  CASE e.event_id % 97 WHEN 1 THEN 'QuickCash' WHEN 2 THEN 'GlobalDigital' WHEN 3 THEN 'FastMoneyX'
    ELSE CASE WHEN e.event_id % 499 = 7 THEN concat('rare_', CAST(e.event_id AS STRING))
              ELSE concat('merchant_', CAST((e.event_id * 31 % 1009) % 97 AS STRING)) END END AS merchant,
  CASE WHEN e.event_id % 23 = 0 THEN concat(' ', upper(e.event_type), ' ') ELSE e.event_type END AS category,
  e.value AS amount,
  CASE WHEN e.event_id % 41 = 0 THEN NULL WHEN e.user_id % 4 = 0 THEN 'female' WHEN e.user_id % 4 = 1 THEN 'M'
       WHEN e.user_id % 4 = 2 THEN ' f' ELSE 'MALE' END AS gender,
  c.c_mktsegment AS city,
  CASE WHEN e.event_id % 29 = 0 THEN 'xyz' WHEN e.event_id % 43 = 0 THEN NULL
       ELSE concat(chr(97 + n.n_nationkey), chr(97 + (n.n_nationkey * 7) % 26)) END AS state,
  CAST(10000 + e.user_id AS DOUBLE) AS zip,
  CASE WHEN e.event_id % 53 = 0 THEN NULL ELSE CAST((e.user_id * 37) % 120 - 60 AS DOUBLE) END AS lat,
  CAST((e.user_id * 73) % 300 - 150 AS DOUBLE) AS long,
  CASE WHEN e.event_id % 61 = 0 THEN NULL ELSE CAST((e.user_id * 7919) % 100000 AS DOUBLE) END AS city_pop,
  CAST((e.user_id * 37) % 120 - 60 AS DOUBLE) + CAST(e.event_id % 21 - 10 AS DOUBLE) / 8 AS merchant_lat,
  CAST((e.user_id * 73) % 300 - 150 AS DOUBLE) + CAST(e.event_id % 17 - 8 AS DOUBLE) / 8 AS merchant_long,
  CASE WHEN (e.event_type = 'error' AND e.value > 100)
         OR (e.event_id % 97 IN (1, 2, 3) AND e.value > 40) THEN 1 ELSE 0 END AS is_fraud
FROM {events} e
LEFT JOIN (SELECT c_custkey, min(c_mktsegment) AS c_mktsegment, min(c_nationkey) AS c_nationkey
           FROM {customer} GROUP BY c_custkey) c ON c.c_custkey = e.user_id
LEFT JOIN (SELECT DISTINCT n_nationkey FROM {nation}) n ON n.n_nationkey = c.c_nationkey
"""

TXN_RAW_SQL = """
SELECT CAST(record_id AS STRING) AS idx,
  CASE WHEN record_id % 211 = 0 THEN 'not a date' WHEN record_id % 223 = 0 THEN NULL
       ELSE CAST(date_trunc('second', transaction_time) AS STRING) END AS trans_date_trans_time,
  card_number AS cc_num, merchant, category,
  CASE WHEN record_id % 101 = 0 THEN 'n/a' WHEN record_id % 103 = 0 THEN ''
       WHEN record_id % 107 = 0 THEN concat('-', CAST(amount AS STRING)) ELSE CAST(amount AS STRING) END AS amt,
  gender, city, state, CAST(zip AS STRING) AS zip, CAST(lat AS STRING) AS lat, CAST(long AS STRING) AS long,
  CAST(city_pop AS STRING) AS city_pop,
  CASE WHEN record_id % 997 = 0 THEN '' ELSE transaction_id END AS trans_num,
  CASE WHEN record_id % 211 = 0 THEN '1704067200' ELSE NULL END AS unix_time,
  CAST(merchant_lat AS STRING) AS merch_lat, CAST(merchant_long AS STRING) AS merch_long,
  CAST(is_fraud AS STRING) AS is_fraud
FROM {txn}
UNION ALL
SELECT CAST(record_id + 100000000 AS STRING), CAST(date_trunc('second', transaction_time) AS STRING),
  card_number, merchant, category, '1.0', gender, city, state, CAST(zip AS STRING), CAST(lat AS STRING),
  CAST(long AS STRING), CAST(city_pop AS STRING), transaction_id, NULL, CAST(merchant_lat AS STRING),
  CAST(merchant_long AS STRING), CAST(is_fraud AS STRING)
FROM {txn} WHERE record_id % 50 = 0
"""

# The older event payload that the constraint rules describe, with some rows breaking each rule.
EVENT_SQL = """
SELECT CASE WHEN event_id % 89 = 0 THEN NULL ELSE concat('e', CAST(event_id AS STRING)) END AS transaction_id,
  event_id AS record_id,
  CAST(CASE WHEN event_id % 83 = 0 THEN 999 ELSE 1000 + user_id * 5 END AS DOUBLE) AS user_id,
  CASE WHEN event_id % 79 = 0 THEN 0.0 WHEN event_id % 71 = 0 THEN NULL ELSE value * 20 END AS amount,
  CASE WHEN event_id % 73 = 0 THEN 'usd' ELSE 'USD' END AS currency,
  CASE event_id % 97 WHEN 1 THEN 'QuickCash' WHEN 2 THEN 'GlobalDigital' WHEN 3 THEN 'FastMoneyX'
       ELSE event_type END AS merchant,
  CASE WHEN event_id % 67 = 0 THEN 'soon' ELSE CAST(date_trunc('second', CAST(ts AS TIMESTAMP)) AS STRING) END
    AS timestamp,
  CASE WHEN event_id % 59 = 0 THEN 'usa' WHEN event_id % 47 = 0 THEN NULL ELSE 'US' END AS location,
  CASE WHEN event_id % 113 = 0 THEN 2 WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_fraud
FROM {events}
"""

# A score with many ties, and a threshold-free label, for the metric operators.
SCORE_SQL = """
SELECT transaction_id, record_id, is_fraud AS label, CAST(record_id % 5 AS INT) AS fold,
  round(1 / (1 + exp(-(-4 + 0.02 * amount
    + 2 * CASE WHEN merchant IN ('QuickCash', 'GlobalDigital', 'FastMoneyX') THEN 1 ELSE 0 END))), 3) AS score
FROM {txn}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.sql(TXN_SQL, events=table(spark, sf_dir, "events"),
                     customer=table(spark, sf_dir, "customer"), nation=table(spark, sf_dir, "nation"))


def txn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TXN_RAW_SQL, txn=txn(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.sql(EVENT_SQL, events=table(spark, sf_dir, "events"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SCORE_SQL, txn=txn(spark, sf_dir))


def _duck(sql: str, **names: str) -> str:
    return sql.format(**names).strip()


def with_views(*names: str) -> str:
    """``WITH ...`` text that defines the views for an engine that holds the base tables."""
    known = {
        "txn": _duck(TXN_SQL, events="events", customer="customer", nation="nation"),
        "txn_raw": _duck(TXN_RAW_SQL, txn="txn"),
        "event": _duck(EVENT_SQL, events="events"),
        "scored": _duck(SCORE_SQL, txn="txn"),
    }
    needs = {"txn_raw": ["txn"], "scored": ["txn"]}
    order = []
    for name in names:
        order += [n for n in needs.get(name, []) + [name] if n not in order]
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order)
