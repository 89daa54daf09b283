"""Explicit schemas of the twelve tables of the shop model.

Fixed values: names and order of the columns are the interchange format of the CSV files.
Dirty columns (mixed date spellings) stay text until they are cleaned.
"""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "customers": "customer_id bigint, name string, gender string, age int, prefecture string,"
    " registration_date date, acquisition_channel string",
    "products": "product_id bigint, product_name string, category string, price int, cost int",
    "orders": "order_id bigint, customer_id bigint, order_date date, status string,"
    " payment_method string",
    "order_items": "order_item_id bigint, order_id bigint, product_id bigint, quantity int,"
    " unit_price int",
    "customers_raw": "customer_id bigint, name string, gender string, age double, prefecture string,"
    " registration_date string, channel string",
    "ab_test": "user_id bigint, group string, converted int, session_seconds double",
    "web_traffic_daily": "date date, sessions double, users double, pageviews double,"
    " bounce_rate double, conversions double, revenue double",
    "ad_campaigns": "date date, channel string, impressions bigint, clicks bigint, cost bigint,"
    " conversions bigint, revenue bigint",
    "customer_survey": "respondent_id bigint, age_group string, gender string, region string,"
    " membership string, satisfaction int, q_quality int, q_price double, q_support double,"
    " recommend_score double, heard_from string, free_comment string",
    "employees": "employee_id bigint, department string, job_level int, age int, tenure_years int,"
    " education string, gender string, work_location string, monthly_salary bigint,"
    " overtime_hours int, engagement_score double, attrition int",
    "sensor_readings": "timestamp timestamp, machine_id string, temperature double,"
    " vibration double, pressure double, rpm double, defect int",
    "stock_prices": "date date, ticker string, close double",
}

# Columns of the Parquet star schema and its event and text tables.
_STAR_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}

NAMES = tuple(_DDL)
STAR_NAMES = tuple(_STAR_DDL)


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[table])


def star_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(_STAR_DDL[table])
