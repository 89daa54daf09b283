import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywork.functions import stats, tails
from tallywork.operators import inference, regression


@pytest.fixture(scope="module")
def ab(spark):
    """6,200 users with 274 conversions against 6,150 with 368."""
    cells = [("A", 1, 274), ("A", 0, 6200 - 274), ("B", 1, 368), ("B", 0, 6150 - 368)]
    rows = spark.createDataFrame(cells, "arm string, converted int, k int")
    return rows.select("arm", "converted", F.explode(F.sequence(F.lit(1), "k")).alias("i")).cache()


def test_rates_and_intervals(ab):
    rows = {r.arm: r for r in inference.arm_table(ab, "arm", "converted").collect()}
    assert (rows["A"].n, rows["A"].conversions, rows["B"].n, rows["B"].conversions) == (6200, 274, 6150, 368)
    assert [round(rows[a].rate * 100, 2) for a in "AB"] == [4.42, 5.98]
    assert [round(x * 100, 1) for a in "AB" for x in (rows[a].low, rows[a].high)] == [3.9, 4.9, 5.4, 6.6]


def test_lift(ab):
    r = inference.lift(ab, "arm", "converted", "A", "B", 100_000, 4_000).first()
    assert round(r.difference * 100, 2) == 1.56 and round(r.lift * 100) == 35
    assert r.extra_revenue == pytest.approx(r.extra_conversions * 4_000)


def test_chi2_and_z(ab):
    c = inference.arm_chi2(ab, "arm", "converted", "A", "B").first()
    z = inference.two_proportion_test(ab, "arm", "converted", "A", "B").first()
    assert c.chi2_plain == pytest.approx(15.332, abs=5e-4)
    assert c.chi2 == pytest.approx(15.016, abs=5e-4)
    assert c.p == pytest.approx(1.066e-4, rel=1e-3) and c.significant == 1
    assert z.z == pytest.approx(3.9156, abs=5e-5)
    assert z.z**2 == pytest.approx(c.chi2_plain)
    general = inference.chi2_test(ab, "arm", "converted").first()
    assert (general.chi2_plain, general.chi2, general.dof) == pytest.approx((c.chi2_plain, c.chi2, 1))


def test_correction_never_passes_zero(spark):
    df = spark.createDataFrame([("A", 1), ("A", 0), ("B", 1), ("B", 0), ("B", 0)], "a string, b int")
    assert inference.chi2_test(df, "a", "b").first().chi2 == 0


def test_empty_margin_has_no_test(spark):
    df = spark.createDataFrame([("A", 0), ("B", 0)], "arm string, converted int")
    assert inference.arm_chi2(df, "arm", "converted", "A", "B").first().chi2 is None


def test_welch(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(95, 40, 500), rng.normal(101, 30, 400)
    rows = [("A", float(x)) for x in a] + [("B", float(x)) for x in b] + [("A", None)]
    r = inference.welch_test(spark.createDataFrame(rows, "g string, x double"), "g", "x", "A", "B").first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    assert r.n_a == 500
    assert r.t == pytest.approx((a.mean() - b.mean()) / math.sqrt(va + vb))
    assert r.df == pytest.approx((va + vb) ** 2 / (va**2 / 499 + vb**2 / 399))


@pytest.mark.parametrize("x", [0.0, 0.1, 1.0, 3.841, 15.016, 60.0, 400.0])
def test_chi2_tail_closed_forms(x):
    assert tails.chi2_upper(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
    assert tails.chi2_upper(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-10)
    assert tails.chi2_upper(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-10)


@pytest.mark.parametrize("t", [0.0, 0.3, 1.0, 2.5, 7.8, 40.0])
def test_student_tail_closed_forms(t):
    assert tails.student_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-8, abs=1e-14)
    assert tails.student_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), rel=1e-8, abs=1e-14)
    if t < 6:
        assert tails.student_two_sided(t, 1e7) == pytest.approx(tails.normal_two_sided(t), rel=1e-4)


def test_tails_pass_nulls(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0)], "t double, df double")
    assert [r.p is None for r in df.select(tails.student_p("t", "df").alias("p")).collect()] == [False, True]


def test_adjusted_shape(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 4, 7, 20)], "x double")
    r = df.agg(stats.adjusted_skewness("x").alias("s"), stats.adjusted_kurtosis("x").alias("k")).first()
    assert (r.s, r.k) == pytest.approx((1.78157718, 3.25235895))
    few = df.limit(2).agg(stats.adjusted_skewness("x").alias("s"), stats.adjusted_kurtosis("x").alias("k")).first()
    assert few.s is None and few.k is None


def test_nps_leaves_out_missing(spark):
    df = spark.createDataFrame([(10,), (9,), (8,), (7,), (6,), (0,), (0,), (None,)], "s int")
    r = inference.nps(df, "s").first()
    assert r.n == 7 and r.nps == pytest.approx((2 / 7 - 3 / 7) * 100)


def test_reversed_gap(spark):
    rows = [("x", "a", 9.0)] * 1 + [("x", "b", 10.0)] * 9 + [("y", "a", 90.0)] * 9 + [("y", "b", 91.0)]
    out = inference.stratified_gap(spark.createDataFrame(rows, "s string, g string, v double"), "s", "g", "v", "a", "b")
    assert all(r.gap > 0 > r.overall_gap and r.reversed == 1 for r in out.collect())


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(3)
    n = 400
    level, tenure = rng.integers(1, 6, n), rng.integers(0, 30, n)
    school = rng.choice(["a", "b", "c"], n)
    pay = 200 + 40 * level + 3 * tenure + np.select([school == "b", school == "c"], [15, 30]) + rng.normal(0, 10, n)
    rows = [(int(l), int(t), str(s), float(p)) for l, t, s, p in zip(level, tenure, school, pay)]
    return rows, spark.createDataFrame(rows, "lvl int, ten int, edu string, pay double")


@pytest.mark.parametrize("df", [1e5, 1.1e5, 1e6, 1e8, 1e10, 1e12])
def test_tails_at_large_degrees_of_freedom(df):
    """Against the normal tail with its first correction in 1 / df, and the median of chi-square."""
    for t in (0.5, 1.0, 2.5):
        first = t * (t * t + 1) / (4 * df) * 2 * math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        assert tails.student_two_sided(t, df) == pytest.approx(math.erfc(t / math.sqrt(2)) + first, abs=1e-9)
    z = lambda x: ((x / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df))
    for x in (df, df + math.sqrt(2 * df), df - 2 * math.sqrt(2 * df)):
        assert tails.chi2_upper(x, df) == pytest.approx(0.5 * math.erfc(z(x) / math.sqrt(2)), abs=2e-5)


def test_tails_on_both_sides_of_the_large_form(monkeypatch):
    small = [tails.student_two_sided(1.7, 3e5), tails.chi2_upper(2.003e5, 2e5)]
    monkeypatch.setattr(tails, "_LARGE", 1e9)
    assert [tails.student_two_sided(1.7, 3e5), tails.chi2_upper(2.003e5, 2e5)] == pytest.approx(small, abs=1e-8)


def test_ols_against_lstsq(people):
    rows, df = people
    dummies = regression.dummy_columns("edu", ["c", "b", "a"], "edu")
    assert list(dummies) == ["edu_b", "edu_c"]
    full = ["lvl", "ten", *dummies]
    out = regression.ols(df.withColumns(dummies), "pay", {"base": ["lvl", "ten"], "full": full}).collect()
    x = np.array([[1, l, t, s == "b", s == "c"] for l, t, s, _ in rows], float)
    y = np.array([r[3] for r in rows])
    r2 = {}
    for model, cols in (("base", x[:, :3]), ("full", x)):
        beta, *_ = np.linalg.lstsq(cols, y, rcond=None)
        noise = ((y - cols @ beta) ** 2).sum()
        se = np.sqrt(np.diag(np.linalg.inv(cols.T @ cols)) * noise / (len(y) - cols.shape[1]))
        got = {r.term: r for r in out if r.model == model}
        names = ["intercept", "lvl", "ten", "edu_b", "edu_c"][: cols.shape[1]]
        assert [got[k].coef for k in names] == pytest.approx(list(beta))
        assert [got[k].stderr for k in names] == pytest.approx(list(se))
        r2[model] = got["lvl"].r2
        assert r2[model] == pytest.approx(1 - noise / ((y - y.mean()) ** 2).sum())
    assert r2["full"] > r2["base"]


def test_ols_survives_a_constant_and_a_copy(people):
    _, df = people
    out = regression.ols(
        df.withColumns({"one": F.lit(1.0), "twin": F.col("lvl") * 2.0}), "pay", {"m": ["lvl", "twin", "one"]}
    ).collect()
    plain = {r.term: r.coef for r in regression.ols(df, "pay", {"m": ["lvl"]}).collect()}
    got = {r.term: r.coef for r in out}
    # of all coefficients that fit equally well, those of least norm: the constant takes half of the intercept
    assert got["one"] == pytest.approx(got["intercept"]) == pytest.approx(plain["intercept"] / 2)
    assert got["twin"] == pytest.approx(2 * got["lvl"])
    assert got["lvl"] + 2 * got["twin"] == pytest.approx(plain["lvl"])


def test_simple_fit_r2_is_r_squared(people):
    _, df = people
    r = regression.simple_fit(df, "lvl", "pay").first()
    o = {x.term: x for x in regression.ols(df, "pay", {"m": ["lvl"]}).collect()}
    assert r.r2 == pytest.approx(r.r**2) == pytest.approx(o["lvl"].r2)
    assert (r.slope, r.intercept, r.stderr, r.p) == pytest.approx(
        (o["lvl"].coef, o["intercept"].coef, o["lvl"].stderr, o["lvl"].p)
    )


def test_residuals_sum_to_zero(people):
    _, df = people
    out = regression.with_residuals(df, "lvl", "pay").agg(F.sum("residual"), F.corr("fitted", "residual")).first()
    assert out[0] == pytest.approx(0, abs=1e-6) and out[1] == pytest.approx(0, abs=1e-9)


def test_correlation_skips_nulls_in_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 5.0), (3.0, 6.0, 4.0), (4.0, None, 3.0)], "a double, b double, c double")
    got = {(r.a, r.b): r.r for r in regression.correlations(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1) and got[("c", "a")] == pytest.approx(-1) and got[("a", "a")] == 1
    assert len(got) == 9


# --- least squares and correlation of awkward tables --------------------------------------------


def design(seed=3, n=60):
    rng = np.random.default_rng(seed)
    x, z = rng.normal(5, 2, n), rng.normal(-3, 1, n)
    return {"x": x, "x3": 3 * x, "z": z, "c": np.full(n, 4.0), "big": 1e9 + 1e-3 * rng.normal(size=n), "y": 2 + 0.5 * x - z + rng.normal(0, 0.3, n)}


@pytest.mark.parametrize("xs", [["x"], ["x", "x3"], ["x", "c"], ["x", "x3", "z", "c"], ["c"], ["z", "x"]])
def test_fits_of_dependent_and_constant_columns(spark, xs):
    data = design()
    n = len(data["y"])
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], list(data)).repartition(5)
    got = {r.term: r for r in regression.ols(df, "y", {"m": xs}).collect()}
    a = np.column_stack([np.ones(n), *[data[x] for x in xs]])
    want, _, rank, _ = np.linalg.lstsq(a, data["y"], rcond=None)
    noise = ((data["y"] - a @ want) ** 2).sum() / (n - rank)
    errors = np.sqrt(noise * np.diag(np.linalg.pinv(a.T @ a, rcond=1e-12)))
    for term, coef, error in zip(["intercept", *xs], want, errors):
        assert got[term].coef == pytest.approx(coef, rel=1e-8, abs=1e-9), term
        assert got[term].stderr == pytest.approx(error, rel=1e-6), term
        if error:
            assert got[term].p == pytest.approx(student(abs(got[term].t), n - rank), abs=1e-9)


def student(t, dof):
    """Two-sided tail of Student's t by Simpson's rule."""
    if t > 60:
        return 0.0
    u = np.linspace(0, t, 200_001)
    f = np.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi) * (1 + u * u / dof) ** (-(dof + 1) / 2)
    return max(0.0, 1 - 2 * (u[1] - u[0]) / 3 * (f[0] + f[-1] + 4 * f[1:-1:2].sum() + 2 * f[2:-1:2].sum()))


def test_a_small_spread_on_a_large_level_counts(spark):
    data = design()
    data["y"] = 3 + 1e3 * (data["big"] - 1e9) + 0.5 * data["x"]
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], list(data))
    got = {r.term: r.coef for r in regression.ols(df, "y", {"m": ["big", "x"]}).collect()}
    assert got["big"] == pytest.approx(1e3, rel=1e-4) and got["x"] == pytest.approx(0.5, rel=1e-4)


def test_correlations_of_a_wide_table_take_one_pass_of_products(spark):
    rng = np.random.default_rng(4)
    n, k = 400, 300
    base = rng.normal(size=(n, 12))
    x = base[:, rng.integers(0, 12, k)] * rng.normal(1, 1, k) + rng.normal(size=(n, k)) + rng.normal(0, 1e4, k)
    x[rng.random((n, k)) < 0.1] = np.nan
    x[:, 7], x[:, 8] = 3.0, np.nan
    names = [f"c{i}" for i in range(k)]
    rows = [[None if math.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame([(r,) for r in rows], "x array<double>").select(*[F.get("x", i).alias(c) for i, c in enumerate(names)]).repartition(4)
    got = {(r.a, r.b): r.r for r in regression.correlations(df, names).collect()}
    assert len(got) == k * k
    import pandas as pd

    want = pd.DataFrame(x, columns=names).corr().to_numpy()
    for i in range(k):
        for j in range(k):
            r = got[names[i], names[j]]
            if i == j:
                assert r == 1.0
            elif i in (7, 8) or j in (7, 8):
                assert r is None
            else:
                assert r == pytest.approx(want[i, j], abs=1e-9)


def test_wide_and_narrow_correlations_agree(spark):
    data = design()
    df = spark.createDataFrame([(float(a), None if i % 7 == 0 else float(b), float(c)) for i, (a, b, c) in enumerate(zip(data["x"], data["z"], data["y"]))], "a double, b double, c double")
    narrow = {(r.a, r.b): r.r for r in regression.correlations(df, ["a", "b", "c"]).collect()}
    wide = {(r.a, r.b): r.r for r in regression._wide_correlations(df, ["a", "b", "c"]).collect()}
    assert narrow.keys() == wide.keys() and all(narrow[k] == pytest.approx(wide[k], abs=1e-12) for k in narrow)
    assert {r.r for r in regression._wide_correlations(df.limit(0), ["a", "b"]).collect() if r.a != r.b} <= {None}
