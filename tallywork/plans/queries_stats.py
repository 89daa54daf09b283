"""Registered outlier, inference, regression, survey and chart queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import double, ratio, year_month
from ..functions.stats import adjusted_skewness
from ..operators import charts, inference, outliers, regression, tables
from ..sources.activity import arms, events, readings
from ..sources.files import read_parquet
from ..sources.shop import from_star
from . import sales
from .catalog import AMOUNTS, BUYERS, EVENTS, LINES, query, sql_normal_p, sql_student_p, tidy

VISITS, ORDER_VALUE = 100_000, 4_000  # fixed values: the volume an effect is translated to


# --- outliers -------------------------------------------------------------------------------


@query(f"""WITH {AMOUNTS}, q AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3 FROM oa),
  f AS (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q)
SELECT round(max(q1), 4) AS q1, round(max(q3), 4) AS q3, round(max(lower), 4) AS lower, round(max(upper), 4) AS upper, count(*) AS n,
  count(*) FILTER (amount > upper) AS n_high, count(*) FILTER (amount < lower) AS n_low, CAST(max(amount) AS DOUBLE) AS largest,
  round(count(*) FILTER (amount > upper) / count(*)::DOUBLE, 6) AS high_share FROM oa, f""")
def iqr_outliers(spark, sf):
    summary = outliers.fence_summary(sales.order_amounts(from_star(spark, sf)), "amount")
    return tidy(summary, q1=4, q3=4, lower=4, upper=4)


@query(f"""WITH {AMOUNTS}, q AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3 FROM oa)
SELECT order_id, customer_id, CAST(amount AS DOUBLE) AS amount FROM oa, q
WHERE amount > q3 + 1.5 * (q3 - q1) OR amount < q1 - 1.5 * (q3 - q1)""")
def iqr_outlier_rows(spark, sf):
    rows = outliers.fence_outliers(sales.order_amounts(from_star(spark, sf)), "amount")
    return tidy(rows.select("order_id", "customer_id", "amount"))


# --- survey shapes --------------------------------------------------------------------------


def _survey(spark, sf):
    """Line discounts read as 0-10 scores, missing where the tax is zero."""
    raw = read_parquet(spark, sf, "lineitem")
    score = F.round(F.col("l_discount") * 100).cast("int")
    return raw.select(
        F.col("l_returnflag").alias("segment"),
        F.col("l_linestatus").alias("membership"),
        F.when(F.col("l_tax") != 0, score).alias("score"),
        F.col("l_quantity").alias("satisfaction"),
        F.col("l_tax").alias("q_price"),
        F.col("l_discount").alias("q_quality"),
    )


_SURVEY = """sv AS (SELECT l_returnflag AS segment, l_linestatus AS membership,
  CASE WHEN l_tax <> 0 THEN CAST(round(l_discount * 100) AS INTEGER) END AS score, l_quantity AS satisfaction,
  l_tax AS q_price, l_discount AS q_quality FROM lineitem)"""
_NPS = """count(score) AS n, round(avg(CASE WHEN score >= 9 THEN 1.0 WHEN score < 9 THEN 0.0 END), 6) AS promoters,
  round(avg(CASE WHEN score <= 6 THEN 1.0 WHEN score > 6 THEN 0.0 END), 6) AS detractors,
  round((avg(CASE WHEN score >= 9 THEN 1.0 WHEN score < 9 THEN 0.0 END) - avg(CASE WHEN score <= 6 THEN 1.0 WHEN score > 6 THEN 0.0 END)) * 100, 6) AS nps"""


@query(f"""WITH {_SURVEY} SELECT 'all' AS segment, {_NPS} FROM sv UNION ALL SELECT segment, {_NPS} FROM sv GROUP BY 1""")
def nps_by_segment(spark, sf):
    return tidy(inference.nps(_survey(spark, sf), "score", "segment", total="all"))


@query(f"""WITH {_SURVEY} SELECT segment, round(avg(satisfaction) FILTER (membership = 'F'), 6) AS f,
  round(avg(satisfaction) FILTER (membership = 'O'), 6) AS o FROM sv GROUP BY 1""")
def segment_score_pivot(spark, sf):
    """One column per membership that the data has."""
    answers = _survey(spark, sf)
    names = {level: level.lower() for level in tables.levels(answers, "membership", 20)}
    return tidy(tables.wide(answers, ["segment"], "membership", names, "avg", value="satisfaction"))


@query(f"""WITH {_SURVEY} SELECT 'q_price' AS driver, round(corr(satisfaction, q_price), 6) AS r FROM sv
UNION ALL SELECT 'q_quality', round(corr(satisfaction, q_quality), 6) FROM sv
UNION ALL SELECT 'score', round(corr(satisfaction, score), 6) FROM sv""")
def driver_ranking(spark, sf):
    return tidy(regression.drivers(_survey(spark, sf), "satisfaction", ["q_price", "q_quality", "score"]))


# --- A/B tests ------------------------------------------------------------------------------

_AB = """SELECT {0} count(*) FILTER (arm = 'A') AS n_a, coalesce(sum(converted) FILTER (arm = 'A'), 0)::BIGINT AS x_a,
  count(*) FILTER (arm = 'B') AS n_b, coalesce(sum(converted) FILTER (arm = 'B'), 0)::BIGINT AS x_b FROM ev {1}"""
_CHI = """n_all * pow(abs((n_a - x_a) * x_b - x_a * (n_b - x_b)::DOUBLE) {0}, 2) / ((n_a::DOUBLE * n_b) * (x_a + x_b) * (n_all - x_a - x_b))"""


def _chi(correct: bool) -> str:
    gap = "abs((n_a - x_a) * x_b - x_a * (n_b - x_b)::DOUBLE)"
    return _CHI.format(f"- least((n_a + n_b) / 2.0::DOUBLE, {gap})" if correct else "").replace("n_all", "(n_a + n_b)")


@query(f"""WITH {EVENTS}, a AS (SELECT arm, count(*) AS n, CAST(sum(converted) AS BIGINT) AS conversions, avg(converted) AS p FROM ev GROUP BY 1)
SELECT arm, n, conversions, round(p, 6) AS rate, round(p - 1.96 * sqrt(p * (1 - p) / n), 6) AS low, round(p + 1.96 * sqrt(p * (1 - p) / n), 6) AS high FROM a""")
def ab_summary(spark, sf):
    return tidy(inference.arm_table(arms(events(spark, sf)), "arm", "converted"))


@query(f"""WITH {EVENTS}, c AS ({_AB.format('', '')}), r AS (SELECT *, x_a::DOUBLE / n_a AS ra, x_b::DOUBLE / n_b AS rb FROM c)
SELECT n_a, x_a, n_b, x_b, round(ra, 6) AS rate_a, round(rb, 6) AS rate_b, round(rb - ra, 6) AS difference, round((rb - ra) / ra, 6) AS lift,
  round((rb - ra) * 100000, 3) AS extra_conversions, round((rb - ra) * 100000 * 4000, 0) AS extra_revenue FROM r""")
def ab_lift(spark, sf):
    out = inference.lift(arms(events(spark, sf)), "arm", "converted", "A", "B", VISITS, ORDER_VALUE)
    return tidy(out, extra_conversions=3, extra_revenue=0)


@query(f"""WITH {EVENTS}, s AS (SELECT arm, count(value) AS n, avg(value) AS m, stddev_samp(value) AS sd FROM ev GROUP BY 1)
SELECT arm, n, round(m, 6) AS mean, round(sd, 6) AS sd, round(sd / sqrt(n), 6) AS se, round(m - 1.96 * sd / sqrt(n), 6) AS low,
  round(m + 1.96 * sd / sqrt(n), 6) AS high FROM s""")
def mean_interval_by_arm(spark, sf):
    return tidy(inference.mean_interval(arms(events(spark, sf)), "value", ["arm"]))


def _welch_sql(source: str, flag: str, a: str, b: str, value: str) -> str:
    return f"""s AS (SELECT count({value}) FILTER ({flag} = {a}) AS n_a, avg({value}) FILTER ({flag} = {a}) AS mean_a, var_samp({value}) FILTER ({flag} = {a}) AS var_a,
    count({value}) FILTER ({flag} = {b}) AS n_b, avg({value}) FILTER ({flag} = {b}) AS mean_b, var_samp({value}) FILTER ({flag} = {b}) AS var_b FROM {source}),
  w AS (SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
    pow(var_a / n_a + var_b / n_b, 2) / (pow(var_a / n_a, 2) / (n_a - 1) + pow(var_b / n_b, 2) / (n_b - 1)) AS df FROM s),
  z AS (SELECT *, {sql_student_p('t', 'df')} AS p FROM w)
SELECT n_a, round(mean_a, 6) AS mean_a, round(var_a, 4) AS var_a, n_b, round(mean_b, 6) AS mean_b, round(var_b, 4) AS var_b,
  round(t, 6) AS t, round(df, 3) AS df, round(p, 6) AS p, CAST(CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS BIGINT) AS significant FROM z"""


@query(f"WITH {EVENTS}, {_welch_sql('ev', 'arm', chr(39) + 'A' + chr(39), chr(39) + 'B' + chr(39), 'value')}")
def ab_ttest(spark, sf):
    test = inference.welch_test(arms(events(spark, sf)), "arm", "value", "A", "B")
    return tidy(test, var_a=4, var_b=4, df=3)


@query(f"WITH {EVENTS}, {_welch_sql('ev', 'defect', '1', '0', 'value')}")
def flag_compare(spark, sf):
    """Faulty against sound readings: means by flag with a test."""
    r = readings(events(spark, sf))
    return tidy(inference.welch_test(r, "defect", "raw_reading", 1, 0), var_a=4, var_b=4, df=3)


@query("""SELECT p_type AS category, p_brand AS brand, round(avg(p_size), 6) AS mean_size, round(avg(p_retailprice), 6) AS mean_price, count(*) AS n FROM part GROUP BY 1, 2""")
def group_means(spark, sf):
    p = from_star(spark, sf).products
    return tidy(
        p.groupBy("category", "brand").agg(
            F.avg("size").alias("mean_size"), F.avg(double("price")).alias("mean_price"), F.count("*").alias("n")
        )
    )


@query(f"""WITH {EVENTS}, c AS ({_AB.format('', '')}), k AS (SELECT *, {_chi(False)} AS plain, {_chi(True)} AS yates FROM c),
  p AS (SELECT *, {sql_normal_p('sqrt(yates)')} AS p FROM k)
SELECT n_a, x_a, n_b, x_b, round(plain, 6) AS chi2_plain, round(yates, 6) AS chi2, 1::BIGINT AS dof, round(p, 6) AS p,
  CAST(CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS BIGINT) AS significant FROM p""")
def ab_chi2(spark, sf):
    return tidy(inference.arm_chi2(arms(events(spark, sf)), "arm", "converted", "A", "B"))


@query(f"""WITH {EVENTS}, c AS ({_AB.format('', '')}), k AS (SELECT *, (x_b::DOUBLE / n_b - x_a::DOUBLE / n_a)
    / sqrt((x_a + x_b)::DOUBLE / (n_a + n_b) * (1 - (x_a + x_b)::DOUBLE / (n_a + n_b)) * (1.0::DOUBLE / n_a + 1.0::DOUBLE / n_b)) AS z FROM c),
  p AS (SELECT *, {sql_normal_p('z')} AS p FROM k)
SELECT n_a, x_a, n_b, x_b, round(z, 6) AS z, round(p, 6) AS p, CAST(CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS BIGINT) AS significant FROM p""")
def ab_ztest(spark, sf):
    return tidy(inference.two_proportion_test(arms(events(spark, sf)), "arm", "converted", "A", "B"))


_CELLS = """c AS (SELECT {0} AS a, {1} AS b, count(*)::DOUBLE AS o FROM {2} GROUP BY 1, 2),
  e AS (SELECT a, b, o, sum(o) OVER (PARTITION BY a) AS r, sum(o) OVER (PARTITION BY b) AS k, sum(o) OVER () AS n FROM c)"""


@query(f"""WITH {_CELLS.format('quality', 'toxic', 'labels')},
  s AS (SELECT count(DISTINCT a) AS row_levels, count(DISTINCT b) AS column_levels, max(n)::BIGINT AS n,
    sum(pow(o - r * k / n, 2) / (r * k / n)) AS plain, sum(pow(greatest(abs(o - r * k / n) - 0.5, 0), 2) / (r * k / n)) AS yates FROM e),
  p AS (SELECT *, {sql_normal_p('sqrt(yates)')} AS p FROM s)
SELECT row_levels, column_levels, n, round(plain, 6) AS chi2_plain, round(yates, 6) AS chi2, 1::BIGINT AS dof, round(p, 6) AS p,
  CAST(CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS BIGINT) AS significant FROM p""")
def chi2_labels(spark, sf):
    return tidy(inference.chi2_test(read_parquet(spark, sf, "labels"), "quality", "toxic"))


@query(f"""WITH {_CELLS.format('o_orderpriority', 'o_orderstatus', 'orders')},
  s AS (SELECT count(DISTINCT a) AS row_levels, count(DISTINCT b) AS column_levels, max(n)::BIGINT AS n, sum(pow(o - r * k / n, 2) / (r * k / n)) AS x FROM e),
  p AS (SELECT *, exp(-x / 2) * (1 + x / 2 + pow(x / 2, 2) / 2 + pow(x / 2, 3) / 6) AS p FROM s)
SELECT row_levels, column_levels, n, round(x, 6) AS chi2_plain, round(x, 6) AS chi2, (row_levels - 1) * (column_levels - 1) AS dof,
  round(p, 6) AS p, CAST(CASE WHEN p < 0.05 THEN 1 ELSE 0 END AS BIGINT) AS significant FROM p""")
def chi2_priority_status(spark, sf):
    return tidy(inference.chi2_test(read_parquet(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"))


@query(f"""WITH {_CELLS.format('o_orderpriority', 'o_orderstatus', 'orders')}
SELECT a AS payment_method, b AS status, o::BIGINT AS observed, round(r * k / n, 6) AS expected FROM e""")
def expected_counts(spark, sf):
    cells = inference.contingency(from_star(spark, sf).orders, "payment_method", "status")
    return tidy(cells.select("payment_method", "status", "observed", "expected"))


_BY_WEEKDAY = _AB.format("strftime(day, '%w') AS segment,", "GROUP BY 1")


@query(f"""WITH {EVENTS}, c AS ({_BY_WEEKDAY}), k AS (SELECT *, {_chi(False)} AS plain, {_chi(True)} AS yates FROM c),
  p AS (SELECT *, {sql_normal_p('sqrt(yates)')} AS p, 0.05::DOUBLE / (SELECT count(*) FROM c) AS lim FROM k)
SELECT segment, n_a, x_a, n_b, x_b, round(plain, 6) AS chi2_plain, round(yates, 6) AS chi2, 1::BIGINT AS dof, round(p, 6) AS p,
  round(lim, 6) AS "limit", CAST(CASE WHEN p < lim THEN 1 ELSE 0 END AS BIGINT) AS significant FROM p""")
def segment_bonferroni(spark, sf):
    """Arm test per weekday."""
    ev = arms(events(spark, sf)).withColumn("segment", (F.dayofweek("day") - 1).cast("string"))
    return tidy(inference.bonferroni(ev, "segment", "arm", "converted", "A", "B"))


@query(f"""WITH {EVENTS}, d AS ({_AB.format('day,', 'GROUP BY 1')}),
  c AS (SELECT day, sum(n_a) OVER w AS n_a, sum(x_a) OVER w AS x_a, sum(n_b) OVER w AS n_b, sum(x_b) OVER w AS x_b FROM d
    WINDOW w AS (ORDER BY day)),
  k AS (SELECT day, n_a::BIGINT AS n_a, x_a::BIGINT AS x_a, n_b::BIGINT AS n_b, x_b::BIGINT AS x_b FROM c),
  t AS (SELECT *, {_chi(True)} AS chi2 FROM k)
SELECT strftime(day, '%Y-%m-%d') AS day, n_a, x_a, n_b, x_b, round(chi2, 6) AS chi2, CAST(CASE WHEN chi2 > 3.841 THEN 1 ELSE 0 END AS BIGINT) AS crossed,
  CAST(CASE WHEN day = (SELECT min(day) FROM t WHERE chi2 > 3.841) THEN 1 ELSE 0 END AS BIGINT) AS first_crossing FROM t""")
def sequential_looks(spark, sf):
    return tidy(inference.sequential_looks(arms(events(spark, sf)), "day", "arm", "converted", "A", "B"))


@query("""WITH p AS (SELECT value, (row_number() OVER (ORDER BY ts, event_id) - 1) // 30 AS chunk FROM events),
  m AS (SELECT chunk, avg(value) AS m FROM p GROUP BY 1 HAVING count(*) = 30)
SELECT count(*) AS chunks, round(avg(m), 6) AS mean_of_means, round(stddev_samp(m), 6) AS sd_of_means,
  round((SELECT stddev_samp(value) FROM events) / sqrt(30), 6) AS theory, round(stddev_samp(m) / ((SELECT stddev_samp(value) FROM events) / sqrt(30)), 6) AS ratio FROM m""")
def chunk_means(spark, sf):
    return tidy(inference.chunk_means(events(spark, sf), ["ts", "event_id"], "value", 30))


@query(f"""WITH {EVENTS}, o AS (SELECT avg(value) FILTER (arm = 'B') - avg(value) FILTER (arm = 'A') AS g FROM ev),
  s AS (SELECT kind, avg(value) FILTER (arm = 'B') - avg(value) FILTER (arm = 'A') AS gap FROM ev GROUP BY 1)
SELECT kind, round(gap, 6) AS gap, round(g, 6) AS overall_gap, CAST(CASE WHEN gap * g < 0 THEN 1 ELSE 0 END AS BIGINT) AS reversed FROM s, o""")
def stratified_gap(spark, sf):
    return tidy(inference.stratified_gap(arms(events(spark, sf)), "kind", "arm", "value", "A", "B"))


# --- regression -----------------------------------------------------------------------------

_FEATURES = f"""{BUYERS}, f AS (SELECT customer_id, CAST(total_spend AS DOUBLE) AS total_spend, n_orders::DOUBLE AS n_orders,
    CAST(total_spend AS DOUBLE) / n_orders AS avg_order, c.c_acctbal AS balance, c.c_mktsegment AS seg
  FROM pc JOIN customer c ON c.c_custkey = customer_id)"""
_NUMERIC = ["balance", "total_spend", "n_orders", "avg_order"]


def _pair_sql(a: str, b: str) -> str:
    return f"SELECT '{a}' AS a, '{b}' AS b, round({'1.0::DOUBLE' if a == b else f'corr({a}, {b})'}, 6) AS r FROM f"


@query(f"WITH {_FEATURES} " + " UNION ALL ".join(f"SELECT * FROM ({_pair_sql(a, b)} {'LIMIT 1' if a == b else ''})" for a in _NUMERIC for b in _NUMERIC))
def corr_matrix(spark, sf):
    return tidy(regression.correlations(sales.buyer_features(from_star(spark, sf), "balance"), _NUMERIC))


@query(f"WITH {_FEATURES}, m AS (" + " UNION ALL ".join(_pair_sql(a, b) for a in _NUMERIC for b in _NUMERIC if a < b) + ") SELECT * FROM m QUALIFY row_number() OVER (ORDER BY abs(r) DESC, a, b) = 1")
def strongest_pair(spark, sf):
    return tidy(regression.strongest_pair(sales.buyer_features(from_star(spark, sf), "balance"), _NUMERIC))


def _simple_sql(x: str, y: str) -> str:
    return f"""m AS (SELECT regr_count({y}, {x}) AS n, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept, corr({y}, {x}) AS r,
    regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy FROM f),
  s AS (SELECT *, sqrt((1 - r * r) * syy / sxx / (n - 2)) AS se, (n - 2)::DOUBLE AS dof FROM m),
  z AS (SELECT *, slope / se AS t FROM s), p AS (SELECT *, {sql_student_p('least(abs(t), 60)', 'dof')} AS p FROM z)
SELECT n::BIGINT AS n, round(slope, 4) AS slope, round(intercept, 3) AS intercept, round(r, 6) AS r, round(r * r, 6) AS r2, round(se, 4) AS stderr,
  round(t, 5) AS t, round(p, 6) AS p FROM p"""


@query(f"WITH {_FEATURES}, {_simple_sql('n_orders', 'total_spend')}")
def simple_regression(spark, sf):
    fit = regression.simple_fit(sales.buyer_features(from_star(spark, sf)), "n_orders", "total_spend")
    return tidy(fit, slope=4, intercept=3, stderr=4, t=5)


@query(f"WITH {_FEATURES}, {_simple_sql('balance', 'avg_order')}")
def weak_regression(spark, sf):
    fit = regression.simple_fit(sales.buyer_features(from_star(spark, sf), "balance"), "balance", "avg_order")
    return tidy(fit, slope=4, intercept=3, stderr=4, t=5)


@query(f"""WITH {_FEATURES}, l AS (SELECT regr_slope(total_spend, n_orders) AS b, regr_intercept(total_spend, n_orders) AS a FROM f)
SELECT customer_id, round(a + b * n_orders, 3) AS fitted, round(total_spend - (a + b * n_orders), 3) AS residual FROM f, l""")
def residuals(spark, sf):
    rows = regression.with_residuals(sales.buyer_features(from_star(spark, sf)), "n_orders", "total_spend")
    return tidy(rows.select("customer_id", "fitted", "residual"), 3)


@query(f"""WITH {_FEATURES}, l AS (SELECT regr_slope(total_spend, balance) AS b, regr_intercept(total_spend, balance) AS a FROM f),
  r AS (SELECT a + b * balance AS fitted, total_spend - (a + b * balance) AS residual FROM f, l),
  q AS (SELECT quantile_cont(fitted, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM r)
SELECT len(list_filter(e, lambda x: x < fitted - 1e-7))::BIGINT + 1 AS band, count(*) AS n, round(avg(fitted), 2) AS mean_fitted, round(stddev_samp(residual), 2) AS sd FROM r, q GROUP BY 1""")
def residual_spread(spark, sf):
    """Residual spread along the fitted values (spend on balance)."""
    rows = regression.with_residuals(sales.buyer_features(from_star(spark, sf), "balance"), "balance", "total_spend")
    return tidy(regression.residual_spread(rows, "fitted", "residual"), 2)


_OLS2 = """m AS (SELECT count(*)::DOUBLE AS n, avg({y}) AS my, avg({u}) AS mu, avg({v}) AS mv, var_samp({u}) AS suu, var_samp({v}) AS svv,
    covar_samp({u}, {v}) AS suv, covar_samp({y}, {u}) AS syu, covar_samp({y}, {v}) AS syv, var_samp({y}) AS syy FROM {t}),
  b AS (SELECT *, suu * svv - suv * suv AS det, (svv * syu - suv * syv) / (suu * svv - suv * suv) AS bu, (suu * syv - suv * syu) / (suu * svv - suv * suv) AS bv FROM m)"""


@query(f"""WITH {_FEATURES}, {_OLS2.format(y='total_spend', u='balance', v='n_orders', t='f')},
  s AS (SELECT *, my - bu * mu - bv * mv AS b0, (bu * syu + bv * syv) / syy AS r2, (syy - bu * syu - bv * syv) * (n - 1) / (n - 3) AS noise FROM b),
  e AS (SELECT *, sqrt(noise * svv / det / (n - 1)) AS seu, sqrt(noise * suu / det / (n - 1)) AS sev,
    sqrt(noise * (1 / n + (mu * mu * svv - 2 * mu * mv * suv + mv * mv * suu) / det / (n - 1))) AS se0, n - 3 AS dof FROM s),
  r AS (SELECT 'intercept' AS term, b0 AS coef, se0 AS stderr, r2, n, dof FROM e UNION ALL SELECT 'balance', bu, seu, r2, n, dof FROM e UNION ALL SELECT 'n_orders', bv, sev, r2, n, dof FROM e),
  p AS (SELECT *, {sql_student_p('least(abs(coef / stderr), 60)', 'dof')} AS p FROM r)
SELECT 'spend' AS model, term, round(coef, 4) AS coef, round(stderr, 4) AS stderr, round(coef / stderr, 5) AS t, round(p, 6) AS p, round(r2, 6) AS r2, n::BIGINT AS n FROM p""")
def ols_two(spark, sf):
    data = sales.buyer_features(from_star(spark, sf), "balance")
    fit = regression.ols(data, "total_spend", {"spend": ["balance", "n_orders"]})
    return tidy(fit, coef=4, stderr=4, t=5)


# Dummies through within-segment centring: slopes from centred columns, levels from segment means.
@query(f"""WITH {_FEATURES}, g AS (SELECT *, total_spend - avg(total_spend) OVER (PARTITION BY seg) AS wy, balance - avg(balance) OVER (PARTITION BY seg) AS wu,
    n_orders - avg(n_orders) OVER (PARTITION BY seg) AS wv FROM f), {_OLS2.format(y='wy', u='wu', v='wv', t='g')},
  lv AS (SELECT seg, avg(total_spend) - max(bu) * avg(balance) - max(bv) * avg(n_orders) AS lvl FROM f, b GROUP BY 1),
  r AS (SELECT 1 - (SELECT (syy - bu * syu - bv * syv) FROM b) / (SELECT var_samp(total_spend) FROM f) AS r2),
  {_OLS2.format(y='total_spend', u='balance', v='n_orders', t='f').replace('m AS', 'm0 AS', 1).replace('b AS', 'b0 AS', 1).replace('FROM m)', 'FROM m0)')},
  x AS (SELECT 'with segment' AS model, 'intercept' AS term, lvl AS coef, (SELECT r2 FROM r) AS r2 FROM lv WHERE seg = (SELECT min(seg) FROM lv)
    UNION ALL SELECT 'with segment', 'balance', bu, (SELECT r2 FROM r) FROM b UNION ALL SELECT 'with segment', 'n_orders', bv, (SELECT r2 FROM r) FROM b
    UNION ALL SELECT 'with segment', 'seg_' || seg, lvl - (SELECT lvl FROM lv WHERE seg = (SELECT min(seg) FROM lv)), (SELECT r2 FROM r) FROM lv WHERE seg <> (SELECT min(seg) FROM lv)
    UNION ALL SELECT 'base', 'intercept', my - bu * mu - bv * mv, (bu * syu + bv * syv) / syy FROM b0
    UNION ALL SELECT 'base', 'balance', bu, (bu * syu + bv * syv) / syy FROM b0 UNION ALL SELECT 'base', 'n_orders', bv, (bu * syu + bv * syv) / syy FROM b0)
SELECT model, term, round(coef, 3) AS coef, round(r2, 6) AS r2, (SELECT count(*) FROM f) AS n FROM x""")
def ols_dummies(spark, sf):
    """Fit with and without segment dummies, from the same single pass."""
    shop = from_star(spark, sf)
    data = sales.buyer_features(shop, "balance", "acquisition_channel")
    levels = tables.levels(shop.customers, "acquisition_channel", 50)
    dummies = regression.dummy_columns("acquisition_channel", levels, "seg")
    base = ["balance", "n_orders"]
    fit = regression.ols(
        data.withColumns(dummies), "total_spend", {"base": base, "with segment": [*base, *dummies]}
    )
    return tidy(fit.select("model", "term", "coef", "r2", "n"), coef=3)


# --- charts ---------------------------------------------------------------------------------


@query(f"""WITH {AMOUNTS}, v AS (SELECT CAST(amount AS DOUBLE) AS x FROM oa), e AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
  h AS (SELECT least(floor((x - lo) / ((hi - lo) / 40))::BIGINT + 1, 40) AS bin, count(*) AS n FROM v, e GROUP BY 1)
SELECT b AS bin, round(lo + (b - 1) * (hi - lo) / 40, 6) AS left_edge, round(lo + b * (hi - lo) / 40, 6) AS right_edge, coalesce(n, 0) AS n
FROM range(1, 41) r(b) LEFT JOIN h ON bin = b, e""")
def hist_bins(spark, sf):
    return tidy(charts.histogram(sales.order_amounts(from_star(spark, sf)), "amount", 40))


@query(f"""WITH {LINES}, v AS (SELECT p.p_type AS category, order_id, CAST(sum(amount) AS DOUBLE) AS x FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1, 2),
  q AS (SELECT category, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v GROUP BY 1),
  j AS (SELECT v.*, q1, q3, x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM v JOIN q USING (category))
SELECT category, round(max(q1), 4) AS q1, round(max(q3), 4) AS q3, min(x) FILTER (inside) AS whisker_low, max(x) FILTER (inside) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers, count(*) AS n FROM j GROUP BY 1""")
def box_stats(spark, sf):
    shop = from_star(spark, sf)
    # summed before any join, so that a crowded order is reduced on the map side
    sums = shop.order_items.groupBy("order_id", "product_id").agg(F.sum("amount").alias("amount"))
    cells = (
        sums.join(shop.completed_orders().select("order_id"), "order_id")
        .join(shop.products.select("product_id", "category"), "product_id")
        .groupBy("category", "order_id")
        .agg(F.sum("amount").alias("amount"))
    )
    return tidy(charts.box_stats(cells, "amount", ["category"]), 4)


@query(f"""WITH {AMOUNTS}, s AS (SELECT c.c_mktsegment AS acquisition_channel, count(*) AS n, avg(CAST(amount AS DOUBLE)) AS m, stddev_samp(CAST(amount AS DOUBLE)) AS sd
  FROM oa JOIN customer c ON c.c_custkey = customer_id GROUP BY 1)
SELECT acquisition_channel, n, round(m, 3) AS mean, round(sd, 3) AS sd, round(sd / sqrt(n), 3) AS se, round(m - 1.96 * sd / sqrt(n), 3) AS low,
  round(m + 1.96 * sd / sqrt(n), 3) AS high FROM s""")
def mean_ci_bars(spark, sf):
    shop = from_star(spark, sf)
    rows = sales.order_amounts(shop).join(
        shop.customers.select("customer_id", "acquisition_channel"), "customer_id"
    )
    return tidy(inference.mean_interval(rows, "amount", ["acquisition_channel"]), 3)


@query(f"""WITH {LINES}, s AS (SELECT c.c_mktsegment AS acquisition_channel, p.p_type AS category, sum(amount) AS amount
  FROM lines JOIN part p ON p.p_partkey = product_id JOIN customer c ON c.c_custkey = customer_id GROUP BY 1, 2)
SELECT acquisition_channel, category, CAST(amount AS DOUBLE) AS amount, CAST(sum(amount) OVER (PARTITION BY acquisition_channel) AS DOUBLE) AS row_total FROM s""")
def stacked_mix(spark, sf):
    shop = from_star(spark, sf)
    named = sales.sales_lines(shop, "customer_id").groupBy("customer_id", "product_id").agg(F.sum("amount").alias("a"))
    cells = named.join(shop.products.select("product_id", "category"), "product_id").groupBy(
        "customer_id", "category"
    ).agg(F.sum("a").alias("a"))
    rows = cells.join(shop.customers.select("customer_id", "acquisition_channel"), "customer_id")
    return tidy(charts.mix(rows, "acquisition_channel", "category", F.sum("a")))


@query(f"""WITH {_FEATURES}, e AS (SELECT min(balance) AS xl, max(balance) AS xh, min(total_spend) AS yl, max(total_spend) AS yh FROM f)
SELECT least(floor((balance - xl) / ((xh - xl) / 20))::BIGINT + 1, 20) AS x_bin, least(floor((total_spend - yl) / ((yh - yl) / 20))::BIGINT + 1, 20) AS y_bin,
  count(*) AS n FROM f, e GROUP BY 1, 2""")
def scatter_grid(spark, sf):
    return charts.grid_counts(sales.buyer_features(from_star(spark, sf), "balance"), "balance", "total_spend", 20)


@query(f"""WITH {LINES}, s AS (SELECT p.p_type AS category, strftime(order_date, '%Y') AS year, sum(amount) AS r, count(*) AS k
  FROM lines JOIN part p ON p.p_partkey = product_id GROUP BY 1, 2)
SELECT category, year, round(CAST(r AS DOUBLE) / k, 6) AS mean_line,
  round(CAST(r AS DOUBLE) / CAST(sum(r) OVER (PARTITION BY category) AS DOUBLE), 6) AS share FROM s""")
def heatmap_long(spark, sf):
    shop = from_star(spark, sf)
    cells = (
        sales.product_totals(shop, F.date_format("order_date", "yyyy"))
        .join(shop.products.select("product_id", "category"), "product_id")
        .groupBy("category", F.col("period").alias("year"))
        .agg(F.sum("revenue").alias("r"), F.sum("lines").alias("k"))
    )
    shared = tables.share_within(cells, ["category"], "r")
    return tidy(shared.select("category", "year", ratio("r", "k").alias("mean_line"), "share"))


@query(f"""WITH {BUYERS}, x AS (SELECT min(total_spend) AS lo, max(total_spend) AS hi FROM pc)
SELECT 'trend' AS panel, strftime(order_date, '%Y-%m') AS item, CAST(sum(amount) AS DOUBLE) AS amount FROM oa GROUP BY 2
UNION ALL SELECT 'ranking', p_type, CAST(sum(amount) AS DOUBLE) FROM lines JOIN part ON p_partkey = product_id GROUP BY 2
UNION ALL SELECT 'distribution', CAST(n_orders AS VARCHAR), count(*)::DOUBLE FROM pc GROUP BY 2
UNION ALL SELECT 'relation', 'orders and spend', round(corr(total_spend::DOUBLE, n_orders), 6) FROM pc""")
def dashboard(spark, sf):
    """Four panels in one frame, three of them from one customer-by-month base whose shuffle they share."""
    shop = from_star(spark, sf)
    base = (
        sales.order_amounts(shop)
        .groupBy("customer_id", year_month("order_date").alias("ym"))
        .agg(F.sum("amount").alias("amount"), F.count("*").alias("orders"))
    )
    buyers = base.groupBy("customer_id").agg(
        F.sum("amount").alias("spend"), F.sum("orders").alias("n_orders")
    )
    panels = {
        "trend": base.groupBy(F.col("ym").alias("item")).agg(F.sum("amount").alias("v")),
        "ranking": sales.by_product(shop, "category").select(F.col("category").alias("item"), F.col("revenue").alias("v")),
        "distribution": buyers.groupBy(F.col("n_orders").cast("string").alias("item")).agg(F.count("*").alias("v")),
        "relation": buyers.agg(
            F.lit("orders and spend").alias("item"),
            F.round(F.corr(double("spend"), double("n_orders")), 6).alias("v"),
        ),
    }
    frames = [
        df.select(F.lit(name).alias("panel"), "item", double("v").alias("amount")) for name, df in panels.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query(f"""WITH {AMOUNTS}, v AS (SELECT CAST(amount AS DOUBLE) AS x FROM oa), q AS (SELECT quantile_cont(x, 0.99) AS cap FROM v)
SELECT round(max(cap), 4) AS cap, count(*) FILTER (x > cap) AS clipped, round(sum(least(x, cap)::DECIMAL(18,4))::DOUBLE, 2) AS clipped_sum,
  round(skewness(x), 6) AS skew, round(skewness(least(x, cap)), 5) AS clipped_skew FROM v, q""")
def clip_quantile(spark, sf):
    from ..operators.ordered import quantiles
    from ..operators.profile import with_scalars

    v = sales.order_amounts(from_star(spark, sf)).select(double("amount").alias("x"))
    marked = with_scalars(v, quantiles(v, "x", {"cap": 0.99}).select("cap"))
    low = marked.withColumn("clipped", F.least("x", "cap"))
    return tidy(
        low.agg(
            F.max("cap").alias("cap"),
            F.count_if(F.col("x") > F.col("cap")).alias("clipped"),
            F.sum(F.col("clipped").cast("decimal(18,4)")).alias("clipped_sum"),
            adjusted_skewness("x").alias("skew"),
            adjusted_skewness("clipped").alias("clipped_skew"),
        ),
        cap=4, clipped_sum=2, clipped_skew=5,
    )
