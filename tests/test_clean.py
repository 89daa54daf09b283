import datetime as dt

from pyspark.sql import functions as F

from tallywork.operators import clean, outliers, profile

RAW = "customer_id bigint, name string, gender string, age double, prefecture string, registration_date string"


def raw(spark):
    rows = [
        (1, "山本 悠人", "女性", 33.0, " 東京都 ", "2023-12-24"),
        (1, "山本 悠人　", "F", 33.0, "東京都", "2023/12/24"),  # equal only after cleaning
        (2, "吉田 莉子", "M", -1.0, "千葉県", "2024-03-25"),
        (2, "吉田 莉子", "M", -1.0, "千葉県", "2024-03-25"),  # an exact copy
        (3, "田中 陽斗", None, None, "千葉県", "2024/06/04"),
        (4, "高橋 陽菜", "", 0.0, "東京都", "oops"),
        (5, "佐藤 結衣", "回答なし", 999.0, "　東京都", "2024-01-31"),
        (6, "伊藤 蓮", "男性", 47.0, "大阪府", "2024-02-29"),
    ]
    return spark.createDataFrame(rows, RAW)


def test_customers_become_one_clean_row_each(spark):
    rows = {r.customer_id: r for r in clean.clean_customers(raw(spark)).collect()}
    assert len(rows) == 6
    # ages left after the first de-duplication and the range rule: 33, 33, 0, 47
    assert {k: r.age for k, r in rows.items()} == {1: 33.0, 2: 33.0, 3: 33.0, 4: 0.0, 5: 33.0, 6: 47.0}
    assert {k: r.gender for k, r in rows.items()} == {
        1: "女性", 2: "男性", 3: "回答なし", 4: "回答なし", 5: "回答なし", 6: "男性",
    }
    assert rows[1].prefecture == rows[5].prefecture == "東京都" and rows[1].name == "山本 悠人"
    assert rows[4].registration_date is None and rows[3].registration_date == dt.date(2024, 6, 4)
    assert clean.outside_domain(clean.clean_customers(raw(spark)), "gender", ["女性", "男性", "回答なし"]).count() == 0


def test_change_log(spark):
    log = {r.rule: r.rows_changed for r in clean.customer_change_log(raw(spark)).collect()}
    assert log == {
        "trim name": 1, "trim prefecture": 2, "recode gender": 5, "age out of range": 3, "date spelling": 3,
    }


def test_keep_first_is_by_order_not_by_luck(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("k", 2, None), ("j", 9, None)], "k string, t int, v string")
    assert {(r.k, r.t, r.v) for r in clean.keep_first(df, ["k"], ["t"]).collect()} == {("k", 1, "a"), ("j", 9, None)}
    last = clean.keep_first(df, ["k"], [-F.col("t")])
    assert {(r.k, r.t) for r in last.collect()} == {("k", 3), ("j", 9)}


def test_key_duplicates_tell_copies_from_conflicts(spark):
    got = {r.customer_id: (r.rows, r.distinct_rows) for r in clean.key_duplicates(raw(spark), ["customer_id"]).collect()}
    assert got == {1: (2, 2), 2: (2, 1)}


def test_drop_null_report(spark):
    r = clean.drop_null_report(raw(spark), ["age", "gender"]).first()
    assert (r.rows_before, r.rows_after, r.rows_dropped) == (8, 7, 1)
    assert clean.drop_null_rows(raw(spark), ["age", "gender"]).count() == 7


def test_mean_fill_keeps_the_mean(spark):
    filled = clean.fill_mean(raw(spark), "age").agg(F.avg("age"), F.count("age")).first()
    assert filled[1] == 8 and abs(filled[0] - raw(spark).agg(F.avg("age")).first()[0]) < 1e-9


def test_audit_and_duplicates(spark):
    rows = {r.column: r for r in profile.audit(raw(spark)).collect()}
    assert (rows["gender"].rows, rows["gender"].nulls, rows["gender"].distinct_values, rows["gender"].top_count) == (8, 1, 6, 2)
    assert rows["customer_id"].distinct_values == 6
    assert tuple(profile.duplicate_rows(raw(spark)).first()) == (8, 7, 1)
    assert tuple(profile.duplicate_rows(raw(spark), digest=["name"]).first()) == (8, 7, 1)


def test_value_counts_with_and_without_null(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert {(r.x, r.n, r.share) for r in profile.value_counts(df, "x", dropna=False).collect()} == {
        ("a", 2, 0.5), ("b", 1, 0.25), (None, 1, 0.25),
    }
    assert {(r.x, r.n) for r in profile.value_counts(df, "x").collect()} == {("a", 2), ("b", 1)}


def test_modes_return_all_ties(spark):
    df = spark.createDataFrame([("g", 1), ("g", 1), ("g", 2), ("g", 2), ("g", 3), ("h", 5), ("h", None)], "g string, x int")
    assert {(r.g, r.x, r.n) for r in profile.modes(df, "x", ["g"]).collect()} == {("g", 1, 2), ("g", 2, 2), ("h", 5, 1)}
    assert {r.x for r in profile.modes(df, "x").collect()} == {1, 2}


def test_describe_toy(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 4, 7, 20)], "x double")
    r = profile.describe(df, "x").first()
    assert (r.n, r.minimum, r.median, r.maximum, r.value_range) == (5, 1, 4, 20, 19)
    assert (r.q1, r.q3) == (2, 7) and abs(r.sd - 7.72657751) < 1e-7


def test_head_and_tail(spark):
    df = spark.range(10)
    assert [r.id for r in profile.head_rows(df, 2, "id").collect()] == [0, 1]
    assert [r.id for r in profile.tail_rows(df, 3, ["id"]).collect()] == [7, 8, 9]


def test_types(spark):
    rows = {r.column: r for r in profile.types(raw(spark)).collect()}
    assert (rows["age"].dtype, rows["age"].non_null, rows["age"].nulls) == ("double", 7, 1)


def test_fences(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)], "x double")
    r = outliers.fence_summary(df, "x").first()
    assert (r.q1, r.q3, r.lower, r.upper, r.n_high, r.n_low, r.largest) == (2, 4, -1, 7, 1, 0, 100)
    assert [x.x for x in outliers.fence_outliers(df, "x").collect()] == [100.0]


def test_sigma_flags_have_no_nulls(spark):
    rows = [("m", 1.0)] * 50 + [("m", 1000.0), ("m", None), ("solo", 5.0)]
    out = outliers.sigma_flags(spark.createDataFrame(rows, "g string, x double"), "x", ["g"]).collect()
    assert [r.x for r in out if r.is_outlier] == [1000.0] and all(r.is_outlier is not None for r in out)


def test_threshold_rule(spark):
    rows = [(1, 10.0, 5.0), (1, 20.0, 6.0), (1, 30.0, 7.0), (0, 25.0, 8.0), (0, 1.0, 1.0), (0, None, 9.0)]
    r = outliers.threshold_rule(spark.createDataFrame(rows, "f int, a double, b double"), "f", ["a", "b"]).first()
    assert (r.cut_a, r.cut_b, r.hits, r.true_hits, r.positives) == (20.0, 6.0, 2, 1, 3)
    assert (r.precision, round(r.recall, 4)) == (0.5, 0.3333)


def test_reports_of_the_pass_that_writes(spark):
    done = clean.clean_customers_observed(raw(spark))
    assert sorted(map(str, done.rows.collect())) == sorted(map(str, clean.clean_customers(raw(spark)).collect()))
    assert done.changes == {r.rule: r.rows_changed for r in clean.customer_change_log(raw(spark)).collect()}
    assert done.counts == {
        "rows_before": 8, "rows_unique": 7, "rows_after": 6, "undated": 1, "ageless": 0, "youngest": 0.0, "oldest": 47.0, "odd_genders": 0,
    }
    empty = clean.clean_customers_observed(raw(spark).limit(0))
    assert empty.counts["rows_before"] == 0 and set(empty.changes.values()) == {0} and empty.rows.count() == 0


def test_the_raw_table_is_read_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark).write.parquet(path)
    source = spark.read.schema(RAW).parquet(path)
    seen = []
    from tallywork.operators import clean as module

    plain = module.materialise

    def spy(df, purpose):
        seen.append(df._jdf.queryExecution().executedPlan().toString().count(f"[file:{path}]"))
        return plain(df, purpose)

    module.materialise, kept = spy, plain
    try:
        clean.clean_customers_observed(source)
    finally:
        module.materialise = kept
    assert seen == [1, 0]


def test_typed_value_groups(spark):
    schema = "b boolean, i int, d date, t timestamp_ntz, z timestamp, f float, m decimal(9,2), x binary, a array<int>, s string"
    moment = dt.datetime(2024, 1, 1, 5)
    row = (True, 1, dt.date(2024, 1, 1), moment, moment, 0.5, None, b"x", [1], "1")
    other = (False, 1, None, moment + dt.timedelta(microseconds=1), moment, -0.0, None, b"y", [1, 2], "")
    df = spark.createDataFrame([row, row, other, (None,) * 10], schema)
    got = {r.column: (r.rows, r.nulls, r.distinct_values, r.top_count) for r in profile.audit(df, digest=["s"]).collect()}
    assert got == {
        "b": (4, 1, 2, 2), "i": (4, 1, 1, 3), "d": (4, 2, 1, 2), "t": (4, 1, 2, 2), "z": (4, 1, 1, 3),
        "f": (4, 1, 2, 2), "m": (4, 4, 0, None), "x": (4, 1, 2, 2), "a": (4, 1, 2, 2), "s": (4, 1, 2, 2),
    }
    exact = {r.column: r.distinct_values for r in profile.distinct_counts(df, df.columns).collect()}
    near = {r.column: r.distinct_values for r in profile.distinct_counts(df, df.columns, approx=True).collect()}
    assert exact == near == {k: v[2] for k, v in got.items()}
