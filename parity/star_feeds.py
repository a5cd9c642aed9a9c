"""The two raw feeds projected from the star-schema test tables.

The text runs unchanged on Spark and on the SQL engine that checks the results,
so both start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-07-01"

_RESTAURANT_COLUMNS = """
SELECT
  CAST(o_custkey AS STRING) AS camis,
  CONCAT(c_name, CASE WHEN l_suppkey % 40 = 0 THEN ' Annex' ELSE '' END) AS dba,
  r_name AS boro,
  CAST(c_custkey % 50 AS STRING) AS building,
  CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE CONCAT(n_name, ' ', c_mktsegment) END AS street,
  CASE WHEN c_custkey % 103 = 0 THEN NULL ELSE CAST(10000 + c_nationkey AS STRING) END AS zipcode,
  CAST(2120000000 + c_custkey AS STRING) AS phone,
  CASE WHEN o_orderkey % 97 = 0 THEN '1900-01-01T00:00:00.000'
       WHEN o_orderkey % 211 = 0 THEN NULL
       ELSE CONCAT(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T00:00:00.000') END AS inspection_date,
  CASE WHEN l_returnflag = 'R' THEN 'Critical' ELSE 'Not Critical' END AS critical_flag,
  CONCAT(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T00:00:00.000') AS record_date,
  CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE CAST(c_custkey % 150 AS STRING) END AS bin,
  CAST(1000000000 + c_custkey AS STRING) AS bbl,
  CONCAT('NTA', CAST(c_nationkey AS STRING)) AS nta,
  c_mktsegment AS cuisine_description,
  o_orderpriority AS action,
  CASE WHEN l_partkey % 53 = 0 THEN NULL
       ELSE CONCAT('0', CAST(2 + l_partkey % 5 AS STRING), CHR(CAST(65 + l_suppkey % 16 AS INT))) END AS violation_code,
  CONCAT('violation ', CAST(l_partkey AS STRING)) AS violation_description,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS score,
  CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE NULL END AS grade,
  CASE WHEN o_orderstatus = 'F' THEN CONCAT(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T00:00:00.000') END AS grade_date,
  CASE WHEN c_custkey % 107 = 0 THEN NULL ELSE CONCAT('40.', CAST(500 + c_custkey % 150 AS STRING)) END AS latitude,
  CASE WHEN c_custkey % 107 = 0 THEN NULL ELSE CONCAT('-73.', CAST(500 + c_custkey % 150 AS STRING)) END AS longitude,
  'Cycle Inspection' AS inspection_type
FROM {lineitem}
"""

RAW_RESTAURANT_SQL = _RESTAURANT_COLUMNS + """\
JOIN {orders}   ON l_orderkey = o_orderkey
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation}   ON c_nationkey = n_nationkey
JOIN {region}   ON n_regionkey = r_regionkey
"""

# The same joins for Spark, which takes them in the order written: the customers join the orders, one row a visit, and not every line.
_DESCRIBED_ORDERS = """
SELECT * FROM {orders}
JOIN {customer} ON o_custkey = c_custkey
JOIN {nation}   ON c_nationkey = n_nationkey
JOIN {region}   ON n_regionkey = r_regionkey
"""
_JOINED_TO_ORDERS = "JOIN {described} ON l_orderkey = o_orderkey"

RAW_RAT_SQL = """
SELECT
  CASE event_id % 4 WHEN 0 THEN 'Initial' WHEN 1 THEN 'Bait' WHEN 2 THEN 'Compliance' ELSE 'Stoppage' END AS inspection_type,
  CAST(CAST(FLOOR(event_id / 2) AS BIGINT) AS STRING) AS job_ticket_or_work_order_id,
  CONCAT('PC', CAST(event_id AS STRING)) AS job_id,
  CAST(event_id % 5 AS STRING) AS job_progress,
  CAST(1000000000 + user_id AS STRING) AS bbl,
  CAST(1 + user_id % 5 AS STRING) AS boro_code,
  CAST(user_id % 20 AS STRING) AS block,
  CAST(event_id % 2 AS STRING) AS lot,
  CAST(user_id AS STRING) AS house_number,
  CASE WHEN user_id % 37 = 0 THEN NULL ELSE CONCAT('STREET ', CAST(user_id % 30 AS STRING)) END AS street_name,
  CAST(10000 + user_id % 25 AS STRING) AS zip_code,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE CONCAT('40.', CAST(500 + user_id % 150 AS STRING)) END AS latitude,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE CONCAT('-73.', CAST(500 + user_id % 150 AS STRING)) END AS longitude,
  CASE user_id % 5 WHEN 0 THEN 'Bronx' WHEN 1 THEN 'Brooklyn' WHEN 2 THEN 'Manhattan' WHEN 3 THEN 'Queens' ELSE 'Staten Island' END AS borough,
  CONCAT(CAST(DATE '2000-09-01' + CAST(event_id % 320 AS INT) AS STRING), 'T00:00:00.000') AS inspection_date,
  CASE event_type WHEN 'signup' THEN 'Passed' WHEN 'error' THEN 'Rat Activity' WHEN 'click' THEN 'Failed'
                  WHEN 'view' THEN 'Failed for Other R' ELSE 'Bait applied' END AS result,
  CASE WHEN event_id % 13 = 0 THEN NULL
       ELSE CONCAT(CAST(DATE '2000-09-03' + CAST(event_id % 320 AS INT) AS STRING), 'T00:00:00.000') END AS approved_date,
  CASE WHEN user_id % 41 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS bin,
  CONCAT('NTA', CAST(user_id % 25 AS STRING)) AS nta
FROM {events}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_restaurant(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region")}
    lines = table(spark, sf_dir, "lineitem").repartition("l_orderkey")  # the order join's own partitioning
    described = spark.sql(_DESCRIBED_ORDERS, **tables)
    return spark.sql(_RESTAURANT_COLUMNS + _JOINED_TO_ORDERS, lineitem=lines, described=described)


def raw_rat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_RAT_SQL, events=table(spark, sf_dir, "events"))
