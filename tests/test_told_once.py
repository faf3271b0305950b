"""What a load tells once of a row, and what it keeps out of shuffles and off the disk."""

from pyspark.sql import functions as F

from tillstar import session
from tillstar.functions import dates
from tillstar.operators import facts, lookup, membership
from tillstar.plans.load import load_batch
from tillstar.schemas import REJECTS, UNFIT
from tillstar_checks import registry

DEAR = {"InvoiceNo": "2", "UnitPrice": 2e8}
MANY = {"InvoiceNo": "3", "UnitPrice": 9e6, "Quantity": 100}
REASONS = ["TotalSalesAmount does not fit", "UnitPrice does not fit"]


def test_a_load_turns_prices_into_decimals_once_to_tell_what_fits(lines, warehouse, monkeypatch):
    told = []
    reason = facts.unfit_reason
    monkeypatch.setattr(facts, "unfit_reason", lambda *a: told.append(1) or reason(*a))
    for _ in range(2):
        load_batch(lines({}, DEAR, MANY), warehouse, use_mark=False)
    assert len(told) == 2
    assert sorted(r.Reason for r in warehouse.read("rejects").collect()) == REASONS
    assert warehouse.read("fact_sales").count() == 1


def test_a_batch_of_rows_that_do_not_fit_comes_twice(lines, warehouse):
    added = [load_batch(lines(DEAR, MANY), warehouse, use_mark=False) for _ in range(2)]
    assert [(r.added["fact_sales"], r.rejected) for r in added] == [(0, 2), (0, 0)]
    removed = {r.step: r.removed for r in warehouse.read("load_audit").filter("step = 'set_aside_unfit'").collect()}
    assert removed == {"set_aside_unfit": 2}


def test_doubles_tell_the_same_as_decimals(spark):
    prices = [None, 0.004, 1e7, 89_999_999.999, 9e7, 99_999_999.99, 99_999_999.994, 99_999_999.995, 99_999_999.999, 1e8,
              1.1e8, 1.2e8, 1e12, 1e300, float("inf"), float("nan"), -1e8, -5.0, 0.046566128]
    rows = spark.createDataFrame([(p,) for p in prices], "UnitPrice double").crossJoin(
        spark.createDataFrame([(1,), (2,), (100,), (2**31 - 1,), (None,)], "Quantity int")
    )
    from tillstar.operators import cleaning

    rows = cleaning.add_amount(rows).withColumns({"InvoiceNo": F.lit("1"), "Country": F.lit("France")})
    told = facts.with_unfit(rows).withColumn("exact", facts.unfit_reason())
    amount = F.when(facts._price().isNull(), "UnitPrice does not fit").when(facts._amount().isNull(), REASONS[0])
    wrong = told.withColumn("decimals", amount).filter(~F.col(UNFIT).eqNullSafe(F.col("decimals")) | ~F.col("exact").eqNullSafe(F.col("decimals")))
    assert wrong.collect() == []


def test_a_date_is_the_same_in_any_zone(spark):
    texts = ["3/14/2010 2:30", "12/1/2010 08:26", "1/5/0001 0:0", "13/1/2010 8:26", "2/30/2010 8:26", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    found = []
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            found.append([r[0] for r in rows.select(dates.date_or_null(F.col("text"), spark).cast("string")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == ["2010-03-14 02:30:00", "2010-12-01 08:26:00", "0001-01-05 00:00:00", None, None, None, None]


def test_only_keys_of_full_buckets_are_counted(spark, monkeypatch):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 200))
    rows = spark.range(9000).select(key.alias("code"))
    hot = lookup.hot_keys(rows, "code", 8)
    assert [(r.code, r._salts) for r in hot.collect()] == [("hot", 3)]
    # Nulls are many, but no key; without a hot key nothing is counted by key.
    cold = lookup.hot_keys(rows.filter("code IS NULL OR code <> 'hot'"), "code", 8)
    assert cold.isEmpty() and cold.schema.fieldNames() == ["code", "_salts"]
    even = lookup.hot_keys(spark.range(9000).select(F.concat(F.lit("k"), "id").alias("code")), "code", 8)
    assert even.inputFiles() == [] and "Aggregate" not in even._jdf.queryExecution().optimizedPlan().toString()
    assert even.isEmpty()


def _unshuffled(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_a_batch_that_comes_again_stays_where_it_is(spark, lines, warehouse, tmp_path):
    load_batch(lines(*[{"InvoiceNo": str(i)} for i in range(6)]), warehouse)
    fact = warehouse.read("fact_sales")
    again = fact.drop("SalesMonth").unionByName(fact.drop("SalesMonth").limit(1).withColumn("RowHash", F.lit(7).cast("bigint")))
    rows = warehouse.write_working("rows", again)
    possible = warehouse.write_working("possible", fact.select("SalesMonth", "RowHash"))
    confs = {lookup.BROADCAST_ROWS_SETTING: "3", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for name, value in confs.items():
            spark.conf.set(name, value)
        new = membership.not_loaded(rows, fact, possible)
        assert [r.RowHash for r in new.collect()] == [7]
        assert _unshuffled(new)
        known = rows.limit(0).select([F.lit(None).cast(f.dataType).alias(f.name) for f in REJECTS])
        wide = spark.range(4).select([F.lit("a" if f.name in ("TargetTable", "Reason") else None).cast(f.dataType).alias(f.name) for f in REJECTS])
        left = facts.new_rejects(wide, known)
        assert left.count() == 4 and _unshuffled(left)
        assert facts.new_rejects(wide, wide.limit(1)).count() == 0
    finally:
        spark.conf.unset(lookup.BROADCAST_ROWS_SETTING)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_shuffle_files_go_with_their_query(spark, lines, warehouse, monkeypatch):
    before, seen = spark.conf.get(session.RELEASE), []
    write = warehouse.write_working
    monkeypatch.setattr(warehouse, "write_working", lambda *a: seen.append(spark.conf.get(session.RELEASE)) or write(*a))
    load_batch(lines({}), warehouse)
    assert set(seen) == {"true"}
    assert spark.conf.get(session.RELEASE) == before


def test_lines_are_derived_once_and_looked_up_without_prices(spark, lines, monkeypatch):
    derived, written = [], []
    raw = lines({"UnitPrice": 300.0}, {"InvoiceNo": "2", "UnitPrice": 2.5})
    monkeypatch.setattr(registry, "raw_sales", lambda *a: derived.append(1) or raw)
    monkeypatch.setattr(facts, "written_once", lambda rows: written.append(rows.columns) or lookup.written_once(rows))
    monkeypatch.setattr(registry, "_loaded", {})
    spark.conf.set(lookup.BROADCAST_ROWS_SETTING, "0")
    try:
        found = registry.rejects(spark, "nowhere").collect()
    finally:
        spark.conf.unset(lookup.BROADCAST_ROWS_SETTING)
    assert [(r.InvoiceNo, r.Reason) for r in found] == [("536365", "UnitPrice does not fit")]
    assert len(derived) == 1
    assert written == [["InvoiceNo", "StockCode", "Quantity", "CustomerID", UNFIT]]
