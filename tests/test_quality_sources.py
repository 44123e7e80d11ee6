"""Quality checks, cleaning, pricing, CSV/JSON sources, loads and sinks."""

import json
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from saleslens.operators.cleaning import assign_ids, clean_products, price_sales
from saleslens.operators.quality import (
    check_domain, check_foreign_key, check_not_null, check_primary_key, fill_defaults, row_counts,
)
from saleslens.schemas import CUSTOMERS, PRODUCTS, SALES, TABLE_RULES
from saleslens.sources.files import read_csv_table, read_product_pages, rejected_pages, write_csv
from saleslens.sources.tables import ensure_tables, key_conflicts, load_star, load_table, read_table
from tests import fixtures as fx


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d")], "k int, v string")
    out = sorted((r.k, r.row_count, r.problem) for r in check_primary_key(df, ["k"]).collect()
                 if r.k is not None)
    assert out == [(1, 2, "duplicate key")]
    assert check_primary_key(df, ["k"]).where("k is null").first().problem == "null key"
    parent = spark.createDataFrame([(2,)], "k int")
    fk = sorted((r.k, r.row_count) for r in check_foreign_key(df, parent, ["k"]).collect())
    assert fk == [(1, 2)]   # NULL child keys are not orphans


def test_not_null_domain_defaults(spark):
    df = spark.createDataFrame([("x" * 301, D("123456789.00"), None), ("ok", D("1.00"), True)],
                               "product_name string, unit_price decimal(12,2), is_organic boolean")
    nn = {r.column_name: r.null_count for r in check_not_null(df, ["product_name", "is_organic"]).collect()}
    assert nn == {"product_name": 0, "is_organic": 1}
    dom = {(r.column_name, r.rule): r.violations for r in
           check_domain(df, {"product_name": 300}, {"unit_price": (10, 2)}).collect()}
    assert dom == {("product_name", "max_length 300"): 1, ("unit_price", "decimal(10,2)"): 1}
    filled = fill_defaults(df, TABLE_RULES["products"]["defaults"])
    assert [r.is_organic for r in filled.collect()] == [False, True]
    counts = {r.table_name: r.row_count for r in row_counts({"a": df, "b": df.limit(1)}).collect()}
    assert counts == {"a": 2, "b": 1}


def test_clean_products_and_ids(spark):
    raw = spark.createDataFrame([
        ("  Padded name  ", "Brand A, Brand B", "235.04", 1, 0),
        ("ab", "X", "100", 1, 1),                       # too short: dropped, no id used
        ("Empty brand", "", "0", 1, 2),                 # 0 calories -> NULL, brand Unknown
        ("No brand", None, None, 2, 0),
        ("L" * 120, "  Spaced  ", "12.25", 2, 1),
    ], "product_name string, brands string, energy_kcal string, page long, position long")
    out = assign_ids(clean_products(raw), ["page", "position"]).orderBy("product_id").collect()
    assert [(r.product_id, r.product_name[:11], r.brand, r.calories_per_100g) for r in out] == [
        (1, "Padded name", "Brand A", D("235.00")),
        (2, "Empty brand", "Unknown", None),
        (3, "No brand", "Unknown", None),
        (4, "L" * 11, "Spaced", D("12.30")),
    ]
    assert len(out[3].product_name) == 120  # whole text
    text_ids = assign_ids(raw.where("brands is not null"), ["brands", "product_name"], "n", start=10)
    assert [r.n for r in text_ids.orderBy("brands", "product_name").collect()] == [10, 11, 12, 13]


def test_price_sales_half_up(spark):
    s = fx.sales(spark, [(1, 1, 1, "2024-01-01", 3, 0, 15, 0)])
    p = fx.products(spark, [(1, "P", "B", "C", False, 1.67)])
    r = price_sales(s, p).first()
    # 1.67 * 3 = 5.01; 15% = 0.7515 -> 0.75; total 4.26
    assert (r.unit_price, r.discount_amount, r.total_amount) == (D("1.67"), D("0.75"), D("4.26"))
    unknown = price_sales(s, p.where("product_id = 99")).collect()
    assert [(r.sale_id, r.unit_price, r.total_amount) for r in unknown] == [(1, None, None)]


def test_csv_reader_bad_values(spark, tmp_dir):
    path = os.path.join(tmp_dir, "customers.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("customer_id,customer_name,customer_type,region,country,registration_date,is_active\n")
        f.write('1,"Rossi, Bianchi e figli",Shop,Nord Italia,Italia,2021-04-22,True\n')
        f.write("2,Café Zürich,Bar,Sud,Suisse,2024-13-45,False\n")
        f.write("x,Bad id,Bar,Sud,Suisse,,True\n")
    rows = read_csv_table(spark, path, CUSTOMERS).orderBy("customer_name").collect()
    by = {r.customer_name: r for r in rows}
    assert by["Rossi, Bianchi e figli"].is_active is True
    assert by["Café Zürich"].registration_date is None and by["Café Zürich"]._corrupt_record
    assert by["Bad id"].customer_id is None


def test_product_pages(spark, tmp_dir):
    pages = [
        {"page": 1, "products": [{"product_name": "Jben", "brands": "Jaouda",
                                  "nutriments": {"energy-kcal_100g": 235}},
                                 {"product_name": "Milk"}]},
        {"page": 2},
        {"page": "3", "products": [{"product_name": "Text page"}]},
        {"page": "x", "products": [{"product_name": "No number"}]},
    ]
    for i, p in enumerate(pages):
        with open(os.path.join(tmp_dir, f"page{i}.json"), "w") as f:
            json.dump(p, f)
    with open(os.path.join(tmp_dir, "page9.json"), "w") as f:
        f.write("{not json")
    rows = read_product_pages(spark, tmp_dir).orderBy("page", "position").collect()
    assert [(r.page, r.position, r.product_name, r.energy_kcal) for r in rows] == [
        (None, 0, "No number", None), (1, 0, "Jben", "235"), (1, 1, "Milk", None), (3, 0, "Text page", None)]
    rejects = rejected_pages(spark, tmp_dir).collect()
    assert [(os.path.basename(r.source), r.raw.strip()) for r in rejects] == [("page9.json", "{not json")]


def test_load_table_conflicts_and_csv_sink(spark, tmp_dir):
    target = os.path.join(tmp_dir, "products_tbl")
    p = fx.products(spark, [(1, "A", "B", "C", True, 1.0), (2, "B", "B", "C", False, 2.0)])
    assert load_table(p, target, PRODUCTS, key=["product_id"]) == 2
    with pytest.raises(ValueError):
        load_table(p, target, PRODUCTS, key=["product_id"])
    more = fx.products(spark, [(2, "B", "B", "C", False, 2.0), (3, "C", "B", "C", False, 3.0)])
    nulls = more.withColumn("product_id", F.lit(None).cast("bigint"))
    with pytest.raises(ValueError):
        load_table(nulls, target, PRODUCTS, key=["product_id"])
    problems = key_conflicts(more.unionByName(nulls).unionByName(more.where("product_id = 3")), ["product_id"], read_table(spark, target))
    assert sorted((r.product_id or 0, r.problem) for r in problems.collect()) == [
        (0, "null key"), (0, "null key"), (2, "key already present"), (3, "repeated key"), (3, "repeated key")]
    assert load_table(more, target, PRODUCTS, key=["product_id"], on_conflict="skip") == 1
    assert load_table(more, target, PRODUCTS, key=["product_id"], on_conflict="skip") == 0
    assert sorted(r.product_id for r in read_table(spark, target).collect()) == [1, 2, 3]
    out = os.path.join(tmp_dir, "csv_out")
    write_csv(read_table(spark, target), out)
    assert spark.read.option("header", True).csv(out).count() == 3


def test_ensure_tables(spark, tmp_dir):
    created = ensure_tables(spark, "retail_t", os.path.join(tmp_dir, "db"))
    assert "retail_t.sales" in created
    cols = [c.name for c in spark.catalog.listColumns("retail_t.sales")]
    assert cols == [f.name for f in SALES.fields]
    spark.sql("INSERT INTO retail_t.products (product_id, product_name, unit_price) VALUES (1, 'x', 1.5)")
    assert spark.table("retail_t.products").first().is_organic is False


def test_stream_load_csv_counts_each_file_once(spark, tmp_dir):
    from saleslens.streaming import stream_load_csv
    src, target, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "landed", "ckpt"))
    os.makedirs(src)
    header = ",".join(f.name for f in SALES.fields)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write(header + "\n1,1,1,2024-01-01,2,1.50,0,0,3.00\nx,1,1,2024-01-02,1,1.50,0,0,1.50\n")
    for session in (spark, spark.newSession()):  # the second finds nothing new
        stream_load_csv(session, src, SALES, target, ckpt).awaitTermination(120)
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write(header + "\n3,1,1,2024-01-03,1,1.50,0,0,1.50\n")
    stream_load_csv(spark.newSession(), src, SALES, target, ckpt).awaitTermination(120)
    rows = spark.read.parquet(target).collect()
    assert sorted((r.sale_id or 0, r._corrupt_record is not None) for r in rows) == [(0, True), (1, False), (3, False)]


def test_load_star_parents_first(spark, tmp_dir):
    products = fx.products(spark, [(1, "A", "B", "C", None, 1.0)])
    customers = spark.createDataFrame([(7, "Shop")], "customer_id long, customer_name string")
    sales = fx.sales(spark, [(1, 1, 7, "2024-01-01", 3, 0, 15, 0)]).withColumn("unit_price", F.lit(1))
    targets = {n: os.path.join(tmp_dir, n) for n in ("products", "customers", "sales")}
    tables = {"sales": sales, "customers": customers, "products": products}
    assert list(load_star(tables, targets).items()) == [("products", 1), ("customers", 1), ("sales", 1)]
    assert read_table(spark, targets["customers"]).first().is_active is True
    for broken in (sales.withColumn("product_id", F.lit(2)), sales.withColumn("quantity", F.lit(None).cast("int"))):
        with pytest.raises(ValueError):
            load_star({"sales": broken.withColumn("sale_id", F.lit(9))}, targets)


def test_csv_round_trip_of_a_whole_table(spark, tmp_dir):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    out = os.path.join(tmp_dir, "part_csv")
    write_csv(part, out)
    back = read_csv_table(spark, out, part.schema, keep_corrupt=False)
    assert back.count() == part.count() and back.exceptAll(part).isEmpty()


def test_coerce_dates_bad_text_is_null(spark):
    from saleslens.functions.dates import coerce_dates
    df = spark.createDataFrame([("2024-01-31",), ("2024-13-45",), ("",), (None,)], "d string")
    out = [r.d for r in coerce_dates(df, ["d"]).collect()]
    assert [x.isoformat() if x else None for x in out] == ["2024-01-31", None, None, None]
    alt = spark.createDataFrame([("31/01/2024",)], "d string")
    assert coerce_dates(alt, ["d"], "dd/MM/yyyy").first().d.isoformat() == "2024-01-31"
