import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywork.plans import sales
from tallywork.sources import files, schemas, shop


def put(folder, name, text, bom=True):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.csv"), "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


@pytest.fixture(scope="module")
def csv_shop(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("shop"))
    put(d, "customers", "customer_id,name,gender,age,prefecture,registration_date,acquisition_channel\n"
        "1,山本,女性,33,東京都,2023-12-24,検索広告\n2,吉田,男性,,千葉県,2024-03-25,友人紹介\n3,田中,男性,51,東京都,2024-04-01,検索広告\n")
    put(d, "products", "product_id,product_name,category,price,cost\n1,キッチン商品001,キッチン,2200,1170\n2,食品001,食品,500,300\n3,美容001,美容,6000,3000\n")
    put(d, "orders", "order_id,customer_id,order_date,status,payment_method\n"
        "10,1,2024-01-05,completed,card\n11,1,2024-02-05,completed,card\n12,2,2024-02-06,cancelled,cash\n13,3,2023-12-31,completed,card\n14,3,2024-01-01,returned,card\n")
    put(d, "order_items", "order_item_id,order_id,product_id,quantity,unit_price\n"
        "1,10,1,2,2200\n2,10,2,1,500\n3,11,2,3,400\n4,12,3,9,6000\n5,13,1,1,2000\n6,14,3,1,6000\n")
    return d


def test_bom_and_types(spark, csv_shop):
    c = files.read_csv(spark, f"{csv_shop}/customers.csv", schemas.schema("customers"))
    assert c.columns[0] == "customer_id" and c.where("customer_id = 1").count() == 1
    assert dict(c.dtypes)["registration_date"] == "date"
    assert c.where(F.col("age").isNull()).count() == 1


def test_minute_timestamps(spark, tmp_path):
    put(tmp_path, "sensor_readings", "timestamp,machine_id,temperature,vibration,pressure,rpm,defect\n2024-01-01 05:00,M-01,60.5,,1.2,900,0\n")
    r = files.read_csv(spark, f"{tmp_path}/sensor_readings.csv", schemas.schema("sensor_readings")).first()
    assert r.timestamp.hour == 5 and r.vibration is None and r.temperature == 60.5


def test_every_schema_parses():
    assert len(schemas.NAMES) == 12 and all(len(schemas.schema(n).fields) >= 3 for n in schemas.NAMES)


def test_only_completed_orders_are_sales(spark, csv_shop):
    s = shop.from_csv(spark, csv_shop)
    by = {r.category: (int(r.revenue), r.lines) for r in sales.by_product(s, "category").collect()}
    assert by == {"キッチン": (6400, 2), "食品": (1700, 2)}
    k = sales.kpis(s).first()
    assert (int(k.gmv), k.orders, k.buyers, k.aov, k.frequency, k.repeat_rate) == (8100, 3, 2, 2700.0, 1.5, 0.5)
    # order value is the mean of the order amounts
    assert sales.order_amounts(s).agg(F.avg("amount")).first()[0] == 2700


def test_shop_metrics_on_csv(spark, csv_shop):
    s = shop.from_csv(spark, csv_shop)
    split = {(r.year, r.buyer_type): int(r.revenue) for r in sales.new_vs_repeat(s).collect()}
    assert split == {(2023, "new"): 2000, (2023, "repeat"): 0, (2024, "new"): 4900, (2024, "repeat"): 1200}
    months = [(r.ym, int(r.running_revenue), r.is_peak) for r in sales.monthly_running(s).collect()]
    assert months == [("2023-12", 2000, 0), ("2024-01", 6900, 1), ("2024-02", 8100, 0)]
    top = sales.top_customers(s, 1, ("name", "prefecture", "age")).first()
    assert (top.customer_id, int(top.total_spend), top.prefecture) == (1, 6100, "東京都")
    bands = {r.band: r.products for r in sales.price_bands(s).collect()}
    assert bands == {"low": 1, "mid": 1, "high": 1}
    unsold = {r.product_id: int(r.revenue) for r in sales.unsold_products(s, sales.sales_lines(s)).collect()}
    assert unsold == {1: 6400, 2: 1700, 3: 0}
    assert sales.wide_lines(s).count() == 4
    by_channel = {r.acquisition_channel: int(r.revenue) for r in sales.by_customer(s, "acquisition_channel").collect()}
    assert by_channel == {"検索広告": 8100}


def test_csv_round_trip(spark, csv_shop, tmp_path):
    c = files.read_csv(spark, f"{csv_shop}/customers.csv", schemas.schema("customers"))
    files.write_csv(c, f"{tmp_path}/out")
    back = files.read_csv(spark, f"{tmp_path}/out", schemas.schema("customers"))
    assert back.exceptAll(c).isEmpty() and c.exceptAll(back).isEmpty()


def test_parquet_and_tables(spark, csv_shop, tmp_path):
    s = shop.from_csv(spark, csv_shop)
    files.write_parquet(s.orders, f"{tmp_path}/orders.parquet", partition_by=["status"])
    pruned = spark.read.parquet(f"{tmp_path}/orders.parquet").where("status = 'completed'")
    assert pruned.count() == 3 and "PartitionFilters: [isnotnull(status" in pruned._jdf.queryExecution().executedPlan().toString()
    files.write_table(s.orders, "t_orders", bucket_by=["order_id"], buckets=4)
    files.write_table(s.order_items, "t_items", bucket_by=["order_id"], buckets=4)
    names = [r.tableName for r in files.table_names(spark).collect()]
    assert {"t_orders", "t_items"} <= set(names) and names == sorted(names)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("t_items").join(spark.table("t_orders"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sql_over_named_frames(spark):
    df = files.inline(spark, [(1, "a"), (2, "b")], "k int, v string")
    assert files.run_sql(spark, "SELECT v FROM {t} WHERE k = 2", {"t": df}).first().v == "b"
    files.register({"seen": df})
    assert files.run_sql(spark, "SELECT count(*) AS n FROM seen").first().n == 2
    files.register_folder(spark, "/root/testdata/sf0.001", ["nation", "region"])
    assert files.run_sql(spark, "SELECT count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey").first().n == 25


# --- CSV that does not fit ---------------------------------------------------------------------

PEOPLE = "id bigint, name string, born date, score double"


def test_columns_are_found_by_header_name(spark, tmp_path):
    put(tmp_path, "people", "name,extra,id,score,born\nAnn,x,1,2.5,2024-01-02\nBob,,2,,\n")
    got = [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/people.csv", PEOPLE).collect()]
    assert [(r[0], r[1], str(r[2]), r[3]) for r in got] == [(1, "Ann", "2024-01-02", 2.5), (2, "Bob", "None", None)]


def test_a_missing_column_is_an_error(spark, tmp_path):
    put(tmp_path, "people", "id,title\n1,x\n")
    with pytest.raises(ValueError, match="no column name, born, score"):
        files.read_csv(spark, f"{tmp_path}/people.csv", PEOPLE)


def test_files_of_one_folder_must_agree(spark, tmp_path):
    put(tmp_path / "people", "a", "id,name,born,score\n1,Ann,,\n")
    put(tmp_path / "people", "b", "name,id,born,score\nBob,2,,\n")
    with pytest.raises((PySparkException, Py4JJavaError)):  # Spark passes some read errors on as they are
        files.read_csv(spark, f"{tmp_path}/people", PEOPLE).collect()


def test_bad_lines_end_the_query_or_are_set_apart(spark, tmp_path):
    lines = ["1,Ann,2024-01-02,1.5", "2,Bob,02.01.2024,1", "x,Cid,,", "4,Dee", "5,Eve,,,,6", "6,Flo,,2"]
    put(tmp_path, "people", "id,name,born,score\n" + "\n".join(lines) + "\n")
    path = f"{tmp_path}/people.csv"
    with pytest.raises((PySparkException, Py4JJavaError)):
        files.read_csv(spark, path, PEOPLE).select("name").collect()
    good, rejects, counts = files.split_csv(spark, path, PEOPLE)
    assert good.columns == ["id", "name", "born", "score"]
    assert [r.id for r in good.collect()] == [1, 6] and good.count() == 2
    assert sorted(r.line for r in rejects.collect()) == sorted(lines[1:5]) and rejects.count() == 4
    assert [r.name for r in good.select("name").collect()] == ["Ann", "Flo"]
    report = counts.first()
    assert (report.lines, report.rejected) == (6, 4) and report.file.endswith("people.csv")
