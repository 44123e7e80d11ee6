"""Written tables: the monthly layout, checked loads, the star store, cube, sketches, state
and folded text, against SQL twins, direct queries and their plans."""

import datetime as dt
import os
from decimal import Decimal as D

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from saleslens import plans as P
from saleslens.catalog_stored import STORED_QUERIES
from saleslens.catalog_stored_sql import STORED_SQL
from saleslens.operators.collation import fold_spellings
from saleslens.operators.joins import by_calendar
from saleslens.operators.periods import where_period
from saleslens.operators.quality import check_domain, check_foreign_key, check_not_null
from saleslens.plans import rollup as U
from saleslens.plans import state as S
from saleslens.plans.kpi import filter_year
from saleslens.schemas import SALES, TABLE_RULES
from saleslens.session import materialize
from saleslens.sources.adapter import star_from_tpch
from saleslens.sources.layout import months_present, read_by_month, write_by_month
from saleslens.sources.staging import PROBLEMS, key_problems, orphan_keys, rule_counts, stage, validated
from saleslens.sources.store import LoadRefused, StarStore
from saleslens.sources.tables import key_conflicts
from tests import fixtures as fx
from tests.conftest import SF_SMALL
from tests.test_catalog import TABLES, _norm


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_stored_query_has_a_twin():
    assert set(STORED_QUERIES) == set(STORED_SQL) and set(STORED_QUERIES) <= set(E.queries()) & set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(STORED_QUERIES))
def test_stored_query_matches_sql_twin(spark, duck, name):
    df = STORED_QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(STORED_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert _norm(got) == _norm([tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()])


# --- monthly layout -----------------------------------------------------------------------

def _files_read(df):
    """Files that the scans of an executed plan have opened."""
    total = 0

    def walk(plan):
        nonlocal total
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(plan.executedPlan())
        if "QueryStage" in name:
            return walk(plan.plan())
        if name.startswith("Scan parquet") and plan.metrics().contains("numFiles"):
            total += plan.metrics().apply("numFiles").value()
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    df.collect()
    walk(df._jdf.queryExecution().executedPlan())
    return total


@pytest.fixture(scope="module")
def monthly(spark, tmp_path_factory):
    star, path = star_from_tpch(spark, SF_SMALL), str(tmp_path_factory.mktemp("layout") / "sales")
    undated = star.sales.limit(3).withColumn("sale_date", F.lit(None).cast("date"))
    write_by_month(star.sales.unionByName(undated), path)
    return star, read_by_month(spark, path, star.sales.schema), path


def test_layout_keeps_every_row(spark, monthly):
    star, sales, path = monthly
    assert sales.count() == star.sales.count() + 3 and sales.where("sale_date IS NULL").count() == 3
    found = {tuple(r) for r in months_present(spark, path).collect()}
    assert found == {tuple(r) for r in star.sales.select(F.year("sale_date"), F.month("sale_date")).distinct().collect()}


def test_period_opens_only_its_months(monthly):
    star, sales, path = monthly
    in_two_years = sum(len([f for f in files if f.endswith(".parquet")]) for folder, _, files in os.walk(path)
                       if "sale_year=1999" in folder or "sale_year=2000" in folder)
    trend = P.monthly_trend(sales, star.calendar, 1999, 2000)
    assert "PartitionFilters: [isnotnull(sale_year" in trend._jdf.queryExecution().executedPlan().toString()
    yoy = P.revenue_yoy_quarter(sales, star.calendar, 1999, 2000, star.sales.select(
        F.year("sale_date").alias("year"), F.month("sale_date").alias("month")).distinct().limit(0))
    assert 0 < _files_read(trend.select("month")) <= in_two_years and 0 < _files_read(yoy.select("quarter")) <= in_two_years
    one = where_period(sales, dt.date(1997, 12, 15), dt.date(1998, 1, 1))
    assert _files_read(one) < in_two_years / 12
    assert sorted(one.drop("sale_year", "sale_month").collect()) == sorted(where_period(star.sales, dt.date(1997, 12, 15), dt.date(1998, 1, 1)).collect())
    assert filter_year(sales, 1999).count() == filter_year(star.sales, 1999).count()


def test_filtered_calendar_prunes_while_running(monthly):
    star, sales, path = monthly
    mays = star.calendar.where("month_name = 'May' AND day_of_week = 1")
    df = by_calendar(sales, mays, ["year"]).select("sale_id", "year")
    assert "dynamicpruningexpression" in df._jdf.queryExecution().executedPlan().toString()
    assert _files_read(df) <= sum(len([f for f in files if f.endswith(".parquet")]) for folder, _, files in os.walk(path) if "sale_month=5" in folder)
    assert sorted(df.collect()) == sorted(by_calendar(star.sales, mays, ["year"]).select("sale_id", "year").collect())


def test_yoy_shows_quarters_of_other_years(spark):
    star = fx.star(spark, [(1, "A", "B", "C", True, 1)], [(1, "C1", "Shop", "N")],
                   [(1, 1, 1, "2023-01-10", 1, 80), (2, 1, 1, "2024-05-10", 1, 40), (3, 1, 1, "2022-11-10", 1, 60)],
                   ("2022-01-01", "2024-12-31"))
    months = spark.createDataFrame([(2023, 1), (2024, 5), (2022, 11)], "year int, month int")
    plain = P.revenue_yoy_quarter(star.sales, star.calendar, 2023, 2024).collect()
    assert plain == P.revenue_yoy_quarter(star.sales, star.calendar, 2023, 2024, months).collect() and len(plain) == 3


# --- one-pass validation --------------------------------------------------------------------

RAW = "a string, b string, c string, d double, e string"
SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.DateType()),
                       T.StructField("d", T.DecimalType(4, 1)), T.StructField("e", T.BooleanType()), T.StructField("f", T.IntegerType())])
RULES = {"key": ["a"], "not_null": ["a", "b", "e"], "max_length": {"b": 3}, "decimal": {"d": (4, 1)}, "defaults": {"e": True, "f": 7}}
ROWS = [("1", "abc", "2024-02-30", 1.04, "false"), ("x", "abcd", "2024-01-01", 12345.6, None), (None, None, None, None, "maybe"),
        ("2", "éé€", None, -999.9, "true"), ("2", "a" * 5000, "", 0.0, "true")]


def test_every_rule_is_seen_on_every_row(spark):
    got = validated(spark.createDataFrame(ROWS, RAW), SCHEMA, RULES).collect()
    found = [[(p.column_name, p.rule) for p in r[PROBLEMS]] for r in got]
    assert found == [[("c", "type date")], [("a", "type bigint"), ("b", "max_length 3"), ("d", "decimal(4,1)")],
                     [("a", "null key"), ("b", "not null"), ("e", "type boolean")], [],
                     [("b", "max_length 3"), ("c", "type date")]]
    assert [(r.e, r.f) for r in got] == [(False, 7), (True, 7), (None, 7), (True, 7), (True, 7)]
    assert got[4].b == "a" * 5000 and got[0].d == D("1.0")


def test_stage_reads_its_source_once(spark, tmp_dir):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        read.add(1)
        return x

    source = spark.createDataFrame(ROWS * 20, RAW).withColumn("b", counted.asNondeterministic()("b"))
    staged = stage(source, "t", os.path.join(tmp_dir, "t"), SCHEMA, RULES)
    assert (read.value, staged.total) == (100, 100)
    assert staged.accepted.count() == 20 and staged.rejects.count() == 80 and staged.accepted.columns == SCHEMA.names
    assert sum(staged.counts.values()) == sum(r["n"] for r in staged.rejects.select(F.size(PROBLEMS).alias("n")).collect())
    empty = stage(source.limit(0), "t", os.path.join(tmp_dir, "u"), SCHEMA, RULES)
    assert (empty.total, sum(empty.counts.values()), empty.accepted.count()) == (0, 0, 0)


def test_counts_equal_the_separate_checks(spark, tmp_dir):
    rules = {"key": [], "not_null": ["doc_id", "lang", "text"], "max_length": {"text": 2000, "source": 3}, "decimal": {"n_chars": (3, 0)}, "defaults": {}}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("lang", F.when(F.col("doc_id") % 7 > 0, F.col("lang")))
    counts = {(r.column_name, r.rule): r.violations for r in rule_counts([stage(docs, "d", os.path.join(tmp_dir, "d"), docs.schema, rules)]).collect()}
    for r in check_not_null(docs, rules["not_null"]).collect():
        assert counts[r.column_name, "not null"] == r.null_count
    for r in check_domain(docs, rules["max_length"], rules["decimal"]).collect():
        assert counts[r.column_name, r.rule] == r.violations
    assert counts["lang", "not null"] > 0 and counts["text", "max_length 2000"] > 0


# --- the star store --------------------------------------------------------------------------

@pytest.fixture()
def store(spark, tmp_dir):
    made = StarStore(spark, f"store_{os.path.basename(tmp_dir).replace('-', '_')}", os.path.join(tmp_dir, "store"), buckets=4)
    yield made
    spark.sql(f"DROP DATABASE {made.database} CASCADE")


def _tables(spark):
    star = fx.star(spark, [(1, "A", "B", "C", None, 1.0), (2, "Z", "B", "C", True, 2.0)], [(7, "C7", "Shop", "N")],
                   [(1, 1, 7, "2024-01-01", 3, 9), (2, 2, 7, "2024-02-01", 1, 5)])
    return {"products": star.products, "customers": star.customers, "calendar": star.calendar, "sales": star.sales}


def _published(store):
    return {n: store.read(n).count() for n in ("products", "customers", "calendar", "sales")}


def test_a_bad_sale_publishes_nothing(spark, store):
    tables = _tables(spark)
    for bad in (fx.sales(spark, [(1, 1, 7, "2024-01-01", 3, 9), (2, 3, 7, "2024-02-01", 1, 5)]),
                tables["sales"].withColumn("quantity", F.when(F.col("sale_id") == 1, F.col("quantity"))),
                tables["sales"].unionByName(tables["sales"].limit(1))):
        with pytest.raises(LoadRefused) as refused:
            store.load(tables | {"sales": bad}, "first")
        assert list(refused.value.problems) == ["sales"] and sum(refused.value.problems["sales"].values()) >= 1
        assert set(_published(store).values()) == {0} and store.loads() == []
    store.load(tables, "first")
    assert _published(store) == {"products": 2, "customers": 1, "calendar": 731, "sales": 2}
    assert store.read("products").where("product_id = 1").first().is_organic is False


def test_a_failed_publication_is_invisible_and_repeated_once(spark, store, monkeypatch):
    tables = _tables(spark)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(StarStore, "_publish", fail)
        with pytest.raises(OSError):
            store.load(tables, "first")
    assert set(_published(store).values()) == {0}
    first = store.load(tables, "first")
    assert store.load(tables, "first") == first and store.load({}, "first") == first
    assert _published(store) == {"products": 2, "customers": 1, "calendar": 731, "sales": 2}


def test_rejects_are_whole_and_name_every_problem(spark, store):
    tables = _tables(spark)
    store.load(tables, "first")
    more = fx.sales(spark, [(2, 2, 7, "2024-02-01", 1, 5), (3, 9, 8, "2030-01-01", 1, 5), (4, 1, 7, "2024-03-01", 1, 5),
                            (5, 1, 7, "2024-03-01", 1, 5), (5, 1, 7, "2024-03-02", 1, 5)])
    counts = store.load({"sales": more, "products": tables["products"].limit(0)}, "second", on_problem="reject")
    assert counts == {"products": {"accepted": 0, "refused": 0}, "sales": {"accepted": 1, "refused": 4}}
    got = sorted((r.sale_id, str(r.sale_date), [(p.column_name, p.rule) for p in r[PROBLEMS]], r.load_id) for r in store.rejects("sales").collect())
    assert got == [(2, "2024-02-01", [("sale_id", "key already present")], "second"),
                   (3, "2030-01-01", [("product_id", "unknown parent"), ("customer_id", "unknown parent"), ("sale_date", "unknown parent")], "second"),
                   (5, "2024-03-01", [("sale_id", "repeated key")], "second"), (5, "2024-03-02", [("sale_id", "repeated key")], "second")]
    assert sorted(r.sale_id for r in store.read("sales").collect()) == [1, 2, 4]
    again = StarStore(spark, store.database + "_again", store.location, buckets=4)
    assert _published(again) == _published(store)
    spark.sql(f"DROP DATABASE {again.database} CASCADE")


def test_key_checks_do_not_move_the_target(spark, store):
    tables = _tables(spark)
    store.load(tables, "first")
    target = store.read("sales")
    new = fx.sales(spark, [(2, 2, 7, "2024-02-01", 1, 5), (3, 1, 8, "2024-02-01", 1, 5), (3, 1, 8, "2024-02-01", 1, 5), (4, 1, 8, "2024-02-01", 1, 5)])
    problems = key_problems(new, ["sale_id"], target)
    plan = problems._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("store_")  # the target's scan
    above = plan[:scan].splitlines()
    joined = max(i for i, line in enumerate(above) if "ShuffledHashJoin" in line)
    assert not any("Exchange" in line or "Sort " in line for line in above[joined:]) and "Bucketed: true" in plan
    want = {(r.sale_id, r.problem) for r in key_conflicts(new, ["sale_id"], target).collect()}
    assert {(r.sale_id, r.problem) for r in problems.collect()} == want == {(2, "key already present"), (3, "repeated key")}
    orphans = orphan_keys(new, "customer_id", [(store.read("customers"), "customer_id")])
    assert {r[0] for r in orphans.collect()} == {r[0] for r in check_foreign_key(new, store.read("customers"), ["customer_id"]).collect()} == {8}


def test_key_checks_do_not_move_the_target_under_any_number_of_partitions(spark, store):
    store.load(_tables(spark), "first")
    new = fx.sales(spark, [(2, 2, 7, "2024-02-01", 1, 5), (3, 1, 8, "2024-02-01", 1, 5), (3, 1, 8, "2024-02-01", 1, 5)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        problems = key_problems(new, ["sale_id"], store.read("sales"), 4)
        plan = problems._jdf.queryExecution().executedPlan().toString()
        above = plan[:plan.index("store_")].splitlines()
        joined = max(i for i, line in enumerate(above) if "ShuffledHashJoin" in line)
        assert not any("Exchange" in line or "Sort " in line for line in above[joined:]) and "Bucketed: true" in plan
        assert {(r.sale_id, r.problem) for r in problems.collect()} == {(2, "key already present"), (3, "repeated key")}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_whole_rows_are_written_once_after_staging(spark, store, monkeypatch):
    kept = []

    def watched(df, *args):
        kept.append(df.columns)
        return materialize(df, *args)

    monkeypatch.setattr("saleslens.sources.store.materialize", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        many = fx.sales(spark, [(i, 1, 7, "2024-01-01", 3, 9) for i in range(200)])
        store.load(_tables(spark) | {"sales": many}, "first")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert kept and all("total_amount" not in columns for columns in kept)
    files = [f for _, _, names in os.walk(os.path.join(store.location, "sales")) for f in names if f.endswith(".parquet")]
    assert len(files) == 4 and store.read("sales").count() == 200
    assert [t.name for t in spark.catalog.listTables(store.database) if t.name not in TABLE_RULES] == []


@pytest.mark.parametrize("most", [0, 100])
def test_rows_meet_lost_parents_whether_few_or_many(spark, store, monkeypatch, most):
    monkeypatch.setattr("saleslens.sources.store.BROADCAST_KEYS", most)
    sales = fx.sales(spark, [(i, 1 + i % 3, 7 + i % 2, "2024-01-01", 3, 9) for i in range(60)]).unionByName(
        fx.sales(spark, [(5, 1, 7, "2024-01-01", 3, 9)]).withColumn("quantity", F.lit(None).cast("int")))
    counts = store.load(_tables(spark) | {"sales": sales}, "first", on_problem="reject")
    assert counts["sales"] == {"accepted": 20, "refused": 41}
    assert sorted(r.sale_id for r in store.read("sales").collect()) == [i for i in range(60) if i % 3 < 2 and i % 2 == 0]
    got = {(r.sale_id, r.quantity): [(p.column_name, p.rule) for p in r[PROBLEMS]] for r in store.rejects("sales").collect()}
    assert len(got) == 41 and got[5, None] == [("quantity", "not null")] and got[3, 3] == [("customer_id", "unknown parent")]
    assert got[5, 3] == [("product_id", "unknown parent"), ("customer_id", "unknown parent")]


def test_a_refused_load_leaves_no_files(spark, store):
    tables = _tables(spark)
    with pytest.raises(LoadRefused):
        store.load(tables | {"sales": tables["sales"].unionByName(tables["sales"])}, "first")
    assert not [f for _, _, names in os.walk(store.location) for f in names if f.endswith(".parquet")]
    store.load(tables, "first")
    assert store.rejects("sales").count() == 0 and store.read("sales").count() == 2


def test_rules_name_only_columns_of_their_table():
    for name, rules in TABLE_RULES.items():
        assert set(rules["key"]) <= set(rules["not_null"]), name


# --- cube, sketches, state, text ---------------------------------------------------------------

def test_cards_under_any_filter(spark):
    star = star_from_tpch(spark, SF_SMALL)
    cube = U.sales_cube(star.sales, star.products, star.customers).cache()
    facts = star.sales.join(star.products.select("product_id", "category"), "product_id").join(
        star.customers.select("customer_id", "region"), "customer_id")
    region, category = facts.select("region", "category").orderBy("sale_id").first()
    for filters in ({}, {"year": 1999}, {"region": region}, {"category": category, "year": 1998}, {"region": region, "category": category, "year": 2000}):
        chosen = facts
        for c, v in filters.items():
            chosen = chosen.where((F.year("sale_date") if c == "year" else F.col(c)) == v)
        assert U.cards_of(cube, **filters).collect() == P.kpi_cards(chosen).collect(), filters
    with pytest.raises(ValueError):
        U.cards_of(cube, colour="red")
    cube.unpersist()


def test_cube_tells_totals_from_missing_attributes(spark):
    star = fx.star(spark, [(1, "A", "B", None, True, 1)], [(1, "C1", "Shop", None), (2, "C2", "Shop", "N")],
                   [(1, 1, 1, "2023-01-10", 1, 80), (2, 1, 2, "2023-05-10", 1, 40), (3, 9, 3, "2024-05-10", 1, 5)])
    cube = U.sales_cube(star.sales, star.products, star.customers)
    assert U.cards_of(cube, region=None).first().revenue == 85.0 and U.cards_of(cube).first().revenue == 125.0
    assert U.cards_of(cube, region=None, year=2023).first().active_customers == 1 and U.cards_of(cube).first().active_customers == 3
    assert U.sales_cube(star.sales.limit(0), star.products, star.customers).where("revenue IS NOT NULL").count() == 0


def test_sketches_answer_without_facts(spark, tmp_dir):
    star = star_from_tpch(spark, SF_SMALL)
    U.buyer_sketches(star.sales, star.customers).write.parquet(os.path.join(tmp_dir, "sketches"))
    sketches = spark.read.parquet(os.path.join(tmp_dir, "sketches"))
    for start, end in (("1996-01-01", "1996-01-09"), ("1995-06-01", "2000-01-01"), (None, None)):
        got = U.buyers_between(sketches, start, end)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "lineitem" not in plan
        exact = where_period(star.sales, start, end).select("customer_id").distinct().count()
        assert abs(got.first().buyers - exact) <= 0.03 * exact
    by_year = {r.year: r.buyers for r in U.buyers_between(sketches, by=("year",)).collect()}
    assert set(by_year) == {r[0] for r in star.sales.select(F.year("sale_date")).distinct().collect()}


def test_state_over_parts_equals_one_run(spark, tmp_dir):
    star = star_from_tpch(spark, SF_SMALL)
    days = ("1996-05-01", "1999-01-01")
    parts = [star.sales.where(F.col("sale_date") < days[0]), star.sales.where((F.col("sale_date") >= days[0]) & (F.col("sale_date") < days[1])),
             star.sales.where(F.col("sale_date") >= days[1])]
    spark.sql("DROP TABLE IF EXISTS state_0")
    S.write_state(S.customer_state(parts[0]), "state_0", os.path.join(tmp_dir, "s0"), 4)
    for i, part in enumerate(parts[1:]):
        spark.sql(f"DROP TABLE IF EXISTS state_{i + 1}")
        S.advance_state(spark, f"state_{i}", f"state_{i + 1}", os.path.join(tmp_dir, f"s{i + 1}"), part, 4)
    state = spark.table("state_2")
    assert [(f.name, f.dataType) for f in state.schema] == [(f.name, f.dataType) for f in S.customer_state(star.sales).schema]
    assert sorted(state.collect()) == sorted(S.customer_state(star.sales).collect())
    plan = S.merge_state(state, S.customer_state(parts[0]).hint("merge"))._jdf.queryExecution().executedPlan().toString()
    scan = plan[:plan.index("state_2")].splitlines()
    joined = max(i for i, line in enumerate(scan) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in scan[joined:]) and "Bucketed: true" in plan
    segments = P.segment_distribution(S.state_sales(state), star.customers, "2001-12-31").collect()
    assert segments == P.segment_distribution(star.sales, star.customers, "2001-12-31").collect()
    for i in range(3):
        spark.sql(f"DROP TABLE state_{i}")


def test_state_of_nulls_and_nothing(spark):
    rows = fx.sales(spark, [(1, 1, 1, "2023-01-10", 1, 80), (2, 1, 2, "2023-05-10", 1, 40)])
    batch = rows.withColumn("customer_id", F.when(F.col("sale_id") == 1, 1)).withColumn("total_amount", F.lit(None).cast("decimal(10,2)"))
    merged = S.merge_state(S.customer_state(rows), S.customer_state(batch)).orderBy("customer_id").collect()
    assert [(r.customer_id, r.frequency, r.monetary) for r in merged] == [(1, 2, D("80.00")), (2, 1, D("40.00"))]
    assert S.merge_state(S.customer_state(rows.limit(0)), S.customer_state(rows)).count() == 2


def test_fold_spellings(spark):
    rows = [(1, "Bread", "x"), (2, "BREAD", None), (3, "bread", "X"), (4, None, "y"), (5, "Été", "Y"), (6, "ÉTÉ", ""), (7, "BREAD", "x")]
    got = fold_spellings(spark.createDataFrame(rows, "id int, name string, tag string"), ["name", "tag"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "BREAD", "X"), (2, "BREAD", None), (3, "BREAD", "X"), (4, None, "Y"), (5, "ÉTÉ", "Y"), (6, "ÉTÉ", ""),
                                       (7, "BREAD", "X")]
