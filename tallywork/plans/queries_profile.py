"""Registered profiling and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import double, parse_date, recode, trim_all
from ..functions.stats import adjusted_skewness
from ..operators import clean, profile, sketches
from ..operators.ordered import quantiles
from ..session import materialise
from ..sources.activity import events, readings
from ..sources.files import inline, read_parquet
from ..sources.shop import from_star
from . import sales
from .catalog import AMOUNTS, EVENTS, query, tidy


def _audit_sql(table: str, columns: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{name}' AS "column", count(*) AS rows, count(*) - count(v) AS nulls, count(DISTINCT v) AS distinct_values,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM (SELECT {expr} AS v FROM {table}) WHERE v IS NOT NULL GROUP BY v)) AS top_count
FROM (SELECT {expr} AS v FROM {table})"""
        for name, expr in columns.items()
    ]
    return " UNION ALL ".join(parts)


@query(
    _audit_sql(
        "events",
        {
            "event_id": "event_id",
            "ts": "ts",
            "user_id": "user_id",
            "event_type": "event_type",
            "value": "CASE WHEN event_type <> 'error' THEN value END",
            "props": "props",
        },
    )
)
def profile_audit(spark, sf):
    raw = read_parquet(spark, sf, "events")
    holed = raw.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return profile.audit(holed)


@query(
    _audit_sql(
        "documents", {c: c for c in ("doc_id", "text", "lang", "source", "n_chars")}
    )
)
def profile_documents(spark, sf):
    """Whole texts, compared by their SHA-256."""
    return profile.audit(read_parquet(spark, sf, "documents"), digest=["text"])


@query("""SELECT 'orders' AS "table", count(*) AS rows, 6 AS columns, count(o_orderdate) AS dated FROM orders
UNION ALL SELECT 'customer', count(*), 5, NULL FROM customer""")
def table_shapes(spark, sf):
    o, c = read_parquet(spark, sf, "orders"), read_parquet(spark, sf, "customer")
    types = profile.types(o).where(F.col("column") == "o_orderdate").select("non_null").scalar()
    return tidy(
        profile.shape(o)
        .select(F.lit("orders").alias("table"), "rows", "columns", types.alias("dated"))
        .unionByName(
            profile.shape(c).select(
                F.lit("customer").alias("table"), "rows", "columns", F.lit(None).cast("bigint").alias("dated")
            )
        )
    )


@query("""SELECT 'o_orderkey' AS "column", 'bigint' AS dtype, count(o_orderkey) AS non_null, count(*) - count(o_orderkey) AS nulls FROM orders
UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey), count(*) - count(o_custkey) FROM orders
UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus), count(*) - count(o_orderstatus) FROM orders
UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice), count(*) - count(o_totalprice) FROM orders
UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate), count(*) - count(o_orderdate) FROM orders
UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority), count(*) - count(o_orderpriority) FROM orders""")
def column_types(spark, sf):
    return profile.types(read_parquet(spark, sf, "orders"))


_ADJUSTED = """count(*) AS n, round(sum(x::DECIMAL(18,2))::DOUBLE / count(*), 4) AS mean, round(stddev_samp(x), 2) AS sd,
  round(var_samp(x) / 1e6, 4) AS variance_m, min(x) AS minimum, max(x) AS maximum,
  round(skewness(x), 6) AS skew, round(kurtosis(x), 6) AS kurtosis,
  round(quantile_cont(x, 0.25), 6) AS q1, round(quantile_cont(x, 0.5), 6) AS median,
  round(quantile_cont(x, 0.75), 6) AS q3, round(max(x) - min(x), 6) AS value_range"""


@query(f"""WITH {AMOUNTS}, v AS (SELECT c.c_mktsegment AS acquisition_channel, CAST(amount AS DOUBLE) AS x
  FROM oa JOIN customer c ON c.c_custkey = customer_id)
SELECT acquisition_channel, {_ADJUSTED} FROM v GROUP BY 1""")
def describe_adjusted(spark, sf):
    shop = from_star(spark, sf)
    rows = sales.order_amounts(shop).join(
        shop.customers.select("customer_id", "acquisition_channel"), "customer_id"
    )
    d = profile.describe(rows.select("acquisition_channel", "amount"), "amount", ["acquisition_channel"])
    return tidy(
        d.withColumn("variance_m", F.col("variance") / 1e6).drop("variance"), mean=4, sd=2, variance_m=4
    )


@query(f"""WITH {AMOUNTS}, v AS (SELECT CAST(amount AS DOUBLE) AS x FROM oa) SELECT {_ADJUSTED} FROM v""")
def describe_orders(spark, sf):
    d = profile.describe(sales.order_amounts(from_star(spark, sf)), "amount")
    return tidy(
        d.withColumn("variance_m", F.col("variance") / 1e6).drop("variance"), mean=4, sd=2, variance_m=4
    )


@query(f"""WITH {AMOUNTS} SELECT c.c_mktsegment AS acquisition_channel,
  round(avg(CAST(amount AS DOUBLE)) - median(CAST(amount AS DOUBLE)), 3) AS mean_minus_median,
  round(skewness(CAST(amount AS DOUBLE)), 6) AS skew
FROM oa JOIN customer c ON c.c_custkey = customer_id GROUP BY 1""")
def mean_median_gap(spark, sf):
    shop = from_star(spark, sf)
    rows = sales.order_amounts(shop).join(
        shop.customers.select("customer_id", "acquisition_channel"), "customer_id"
    ).select("acquisition_channel", "amount")
    key = ["acquisition_channel"]
    means = rows.groupBy(*key).agg(
        F.avg(double("amount")).alias("mean"), adjusted_skewness("amount").alias("skew")
    )
    joined = means.join(quantiles(rows, "amount", {"median": 0.5}, key), key)
    return tidy(
        joined.select(*key, (F.col("mean") - F.col("median")).alias("mean_minus_median"), "skew"),
        mean_minus_median=3,
    )


@query("""WITH c AS (SELECT l_returnflag AS return_flag, l_discount AS discount, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT return_flag, discount, n FROM c QUALIFY rank() OVER (PARTITION BY return_flag ORDER BY n DESC) = 1""")
def mode_ties(spark, sf):
    return profile.modes(from_star(spark, sf).order_items, "discount", ["return_flag"])


@query("""WITH c AS (SELECT p_size AS size, count(*) AS n FROM part GROUP BY 1)
SELECT CAST(size AS BIGINT) AS size, n FROM c QUALIFY rank() OVER (ORDER BY n DESC) = 1""")
def overall_mode(spark, sf):
    return tidy(profile.modes(from_star(spark, sf).products, "size"))


@query("""WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events),
  k AS (SELECT kind, count(*) AS n FROM e GROUP BY 1)
SELECT 'kept' AS nulls, kind, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share FROM k
UNION ALL SELECT 'dropped', kind, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) FROM k WHERE kind IS NOT NULL""")
def value_counts_nulls(spark, sf):
    e = events(spark, sf).select(F.when(F.col("kind") != "error", F.col("kind")).alias("kind"))
    kept = profile.value_counts(e, "kind", dropna=False).withColumn("nulls", F.lit("kept"))
    return tidy(kept.unionByName(profile.value_counts(e, "kind").withColumn("nulls", F.lit("dropped"))))


@query("""SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS distinct_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents)) AS surplus FROM documents""")
def duplicate_documents(spark, sf):
    d = read_parquet(spark, sf, "documents").select("text", "lang", "source")
    return profile.duplicate_rows(d, digest=["text"])


@query("""SELECT 'rows' AS what, lang, count(*) AS n FROM (SELECT DISTINCT text, lang, source FROM documents) GROUP BY 2
UNION ALL SELECT 'texts', lang, count(*) FROM (SELECT lang, text FROM documents
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1) GROUP BY 2""")
def dedup_rows(spark, sf):
    d = read_parquet(spark, sf, "documents")
    # texts are compared by digest, so that none is shuffled whole
    rows = clean.drop_duplicate_rows(d.select(F.sha2("text", 256).alias("digest"), "lang", "source"))
    slim = d.select(F.sha2("text", 256).alias("digest"), "lang", "doc_id")
    texts = clean.keep_first(slim, ["digest"], ["doc_id"])
    count = lambda df, what: df.groupBy("lang").agg(F.count("*").alias("n")).withColumn("what", F.lit(what))
    return count(rows, "rows").unionByName(count(texts, "texts"))


@query("""SELECT md5(text) AS digest, count(*) AS rows, count(DISTINCT (lang, source)) AS distinct_rows
FROM documents GROUP BY text HAVING count(*) > 1""")
def key_duplicates(spark, sf):
    d = read_parquet(spark, sf, "documents").select(F.md5("text").alias("digest"), "lang", "source")
    return clean.key_duplicates(d, ["digest"])


# A dirty customer table made from the real one by rule, so that every customer has a spoiled
# twin row: padded name, padded channel, other date spelling, coded segment.
_DIRTY_SQL = """dirty AS (
  SELECT c_custkey AS customer_id, c_name AS name, substr(c_mktsegment, 1, 1) AS gender, c_acctbal / 100 AS age,
         n_name AS prefecture, strftime(DATE '2024-01-01' + CAST(c_nationkey AS INTEGER), '%Y-%m-%d') AS registration_date
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION ALL
  SELECT c_custkey, c_name || chr(12288), CASE substr(c_mktsegment, 1, 1) WHEN 'M' THEN '男性' WHEN 'F' THEN '女性' ELSE 'x' END,
         c_acctbal / 100, ' ' || n_name || ' ', strftime(DATE '2024-01-01' + CAST(c_nationkey AS INTEGER), '%Y/%m/%d')
  FROM customer JOIN nation ON n_nationkey = c_nationkey
  UNION ALL
  SELECT c_custkey, c_name, NULL, NULL, n_name, 'unknown' FROM customer JOIN nation ON n_nationkey = c_nationkey
  WHERE c_mktsegment = 'BUILDING')"""


def _dirty(spark, sf):
    from ..sources.shop import areas

    c = from_star(spark, sf).customers.join(areas(spark, sf), "area_id")
    first = F.substring("acquisition_channel", 1, 1)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("area_id"))
    age = (F.col("balance") / 100).alias("age")
    tidy_row = c.select(
        "customer_id", "name", first.alias("gender"), age, "prefecture",
        F.date_format(day, "yyyy-MM-dd").alias("registration_date"),
    )
    spoiled = c.select(
        "customer_id",
        F.concat("name", F.lit("　")).alias("name"),
        recode(first, {"M": "男性", "F": "女性"}, "x").alias("gender"),
        age,
        F.concat(F.lit(" "), "prefecture", F.lit(" ")).alias("prefecture"),
        F.date_format(day, "yyyy/MM/dd").alias("registration_date"),
    )
    empty = c.where(F.col("acquisition_channel") == "BUILDING").select(
        "customer_id", "name", F.lit(None).cast("string").alias("gender"), F.lit(None).cast("double").alias("age"),
        "prefecture", F.lit("unknown").alias("registration_date"),
    )
    return tidy_row.unionByName(spoiled).unionByName(empty)


_TRIM = "replace(regexp_replace({0}, '^[\\s　]+|[\\s　]+$', '', 'g'), '　', '')"
_CLEAN_SQL = f"""{_DIRTY_SQL}, once AS (SELECT DISTINCT * FROM dirty),
tidy AS (SELECT customer_id, {_TRIM.format('name')} AS name,
  CASE WHEN {_TRIM.format('gender')} IN ('女性', 'F') THEN '女性' WHEN {_TRIM.format('gender')} IN ('男性', 'M') THEN '男性' ELSE '回答なし' END AS gender,
  CASE WHEN age >= 0 AND age <= 120 THEN age END AS age, {_TRIM.format('prefecture')} AS prefecture,
  CAST(coalesce(try_strptime(registration_date, '%Y-%m-%d'), try_strptime(registration_date, '%Y/%m/%d')) AS DATE) AS registration_date FROM once),
cleaned AS (SELECT DISTINCT customer_id, name, gender, coalesce(age, (SELECT median(age) FROM tidy)) AS age, prefecture, registration_date FROM tidy)"""


@query(f"""WITH {_CLEAN_SQL} SELECT customer_id, name, gender, round(age, 6) AS age, prefecture,
  strftime(registration_date, '%Y-%m-%d') AS registration_date FROM cleaned""")
def cleaned_customers(spark, sf):
    return tidy(clean.clean_customers(_dirty(spark, sf)))


@query(f"""WITH {_DIRTY_SQL}
SELECT 'trim name' AS rule, count(*) FILTER (name IS DISTINCT FROM {_TRIM.format('name')}) AS rows_changed FROM dirty
UNION ALL SELECT 'trim prefecture', count(*) FILTER (prefecture IS DISTINCT FROM {_TRIM.format('prefecture')}) FROM dirty
UNION ALL SELECT 'recode gender', count(*) FILTER (gender IS NULL OR gender NOT IN ('女性', '男性', '回答なし')) FROM dirty
UNION ALL SELECT 'age out of range', count(*) FILTER (age < 0 OR age > 120) FROM dirty
UNION ALL SELECT 'date spelling', count(*) FILTER (try_strptime(registration_date, '%Y-%m-%d') IS NULL) FROM dirty""")
def cleaning_change_log(spark, sf):
    """Counted while the cleaned table is written."""
    changes = clean.clean_customers_observed(_dirty(spark, sf)).changes
    return inline(spark, changes.items(), "rule string, rows_changed bigint")


@query(f"""WITH {_CLEAN_SQL}, r AS (SELECT count(*) AS n FROM dirty)
SELECT (SELECT n FROM r) AS rows_before, (SELECT count(*) FROM once) AS rows_unique, count(*) AS rows_after,
  count(*) - count(registration_date) AS undated, count(*) - count(age) AS ageless,
  round(min(age), 6) AS youngest, round(max(age), 6) AS oldest,
  count(*) FILTER (gender NOT IN ('女性', '男性', '回答なし')) AS odd_genders FROM cleaned""")
def cleaning_check(spark, sf):
    """Counted while the cleaned table is written."""
    counts = clean.clean_customers_observed(_dirty(spark, sf)).counts
    kinds = {"youngest": "double", "oldest": "double"}
    schema = ", ".join(f"{name} {kinds.get(name, 'bigint')}" for name in counts)
    return tidy(inline(spark, [tuple(counts.values())], schema))


@query(f"""WITH {_DIRTY_SQL}, s AS (SELECT prefecture AS raw, count(*) AS n FROM dirty GROUP BY 1)
SELECT {_TRIM.format('raw')} AS canonical, count(*) AS spellings, CAST(sum(n) AS BIGINT) AS rows FROM s GROUP BY 1""")
def spelling_variants(spark, sf):
    return profile.spelling_groups(_dirty(spark, sf), "prefecture", trim_all("raw"))


@query(f"""WITH {EVENTS}, m AS (SELECT avg(reading) AS mean, median(reading) AS mid FROM ev)
SELECT round(avg(reading), 6) AS mean_dropped, round(avg(coalesce(reading, mean)), 6) AS mean_filled,
  round(avg(coalesce(reading, mid)), 6) AS mean_median_filled,
  round(var_samp(reading), 4) AS variance_dropped, round(var_samp(coalesce(reading, mean)), 4) AS variance_filled FROM ev, m""")
def impute_compare(spark, sf):
    r = readings(events(spark, sf)).select("reading")
    mean = r.agg(F.avg("reading")).scalar()
    mid = quantiles(r, "reading", {"m": 0.5}).select("m").scalar()
    filled = F.coalesce("reading", mean)
    return tidy(
        r.agg(
            F.avg("reading").alias("mean_dropped"),
            F.avg(filled).alias("mean_filled"),
            F.avg(F.coalesce("reading", mid)).alias("mean_median_filled"),
            F.var_samp("reading").alias("variance_dropped"),
            F.var_samp(filled).alias("variance_filled"),
        ),
        variance_dropped=4,
        variance_filled=4,
    )


@query("""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'bad date' ELSE strftime(o_orderdate, '%Y/%m/%d') END AS w FROM orders)
SELECT count(*) AS rows, count(*) FILTER (try_strptime(w, '%Y/%m/%d') IS NULL) AS failed,
  strftime(min(try_strptime(w, '%Y/%m/%d')), '%Y-%m-%d') AS first, strftime(max(try_strptime(w, '%Y/%m/%d')), '%Y-%m-%d') AS last FROM t""")
def date_failures(spark, sf):
    o = from_star(spark, sf).orders
    w = F.when(F.col("status") == "F", "bad date").otherwise(F.date_format("order_date", "yyyy/MM/dd"))
    d = o.select(parse_date(w).alias("d"))
    return tidy(
        d.agg(
            F.count("*").alias("rows"), F.count_if(F.col("d").isNull()).alias("failed"),
            F.min("d").alias("first"), F.max("d").alias("last"),
        )
    )


@query("""SELECT strftime(ts, '%Y-%m') AS month, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS events,
  CAST(1 AS BIGINT) AS users_within, CAST(1 AS BIGINT) AS events_within FROM events GROUP BY 1""")
def distinct_from_daily_sketches(spark, sf):
    """Monthly distinct counts, exact, and whether those merged from stored daily sketches keep their bound."""
    ev = events(spark, sf).select("day", "user_id", "event_id")
    columns = ["user_id", "event_id"]
    daily = materialise(sketches.distinct_sketches(ev, columns, ["day"]), "daily-sketches")
    month = F.date_format("day", "yyyy-MM").alias("month")
    near = sketches.merged_distinct(daily, columns, [month])
    exact = ev.groupBy(month).agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_id").alias("events"))
    within = lambda a, b: F.abs(F.col(a) - F.col(b)) <= sketches.distinct_error() * F.col(b)
    both = exact.join(near, "month")
    return tidy(both.select("month", "users", "events", within("user_id", "users").alias("users_within"), within("event_id", "events").alias("events_within")))


@query("""SELECT event_type AS kind, count(value) AS n, CAST(1 AS BIGINT) AS median_within, CAST(1 AS BIGINT) AS p90_within
  FROM events GROUP BY 1""")
def quantiles_from_daily_sketches(spark, sf):
    """Whether the median and 90 % values per kind, merged from stored daily sketches, have ranks within their bound."""
    ev = events(spark, sf).select("day", "kind", "value")
    daily = materialise(sketches.quantile_sketches(ev, "value", ["day", "kind"]), "daily-sketches")
    near = sketches.merged_quantiles(daily, {"median": 0.5, "p90": 0.9}, ["kind"])
    x, eps = F.col("value"), sketches.rank_error()
    marked = ev.where(x.isNotNull()).join(near.drop("n"), "kind")
    ranks = marked.groupBy("kind").agg(
        F.count("*").alias("n"),
        *[f(F.when(c, 1.0).otherwise(0.0)).alias(f"{q}_{end}") for q in ("median", "p90") for f, c, end in ((F.avg, x < F.col(q), "low"), (F.avg, x <= F.col(q), "high"))],
    )
    # the ranks that a value takes up run from the rows below it to the rows up to it
    within = lambda q, p: (F.col(f"{q}_low") <= p + eps) & (F.col(f"{q}_high") >= p - eps)
    return tidy(ranks.select("kind", "n", within("median", 0.5).alias("median_within"), within("p90", 0.9).alias("p90_within")))


@query("""SELECT 'user_id' AS "column", CAST(1 AS BIGINT) AS within FROM events UNION SELECT 'event_type', CAST(1 AS BIGINT) FROM events
  UNION SELECT 'ts', CAST(1 AS BIGINT) FROM events UNION SELECT 'value', CAST(1 AS BIGINT) FROM events""")
def approximate_profile(spark, sf):
    """Distinct counts of an audit in approximate mode, beside the exact ones: is each within the bound?"""
    ev, columns = read_parquet(spark, sf, "events"), ["user_id", "event_type", "ts", "value"]
    near = profile.distinct_counts(ev, columns, approx=True).withColumnRenamed("distinct_values", "near")
    both = profile.distinct_counts(ev, columns).join(near, "column")
    off = F.abs(F.col("near") - F.col("distinct_values")) <= sketches.distinct_error() * F.col("distinct_values")
    return tidy(both.select("column", off.alias("within")))
