"""The index of facts: what it may hold, what it cannot miss, and what it spares."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_load import facts_of
from tillstar.operators import membership
from tillstar.plans import load
from tillstar.plans.load import load_batch
from tillstar.sources.warehouse import INDEXED

JANUARY, MAY = 20110100, 20110500


def hashed(spark, first, last, key=JANUARY):
    ids = spark.range(first, last)
    return ids.select((F.lit(key + 1) + F.col("id") % 28).cast("int").alias("DateKey"), F.xxhash64("id").alias("RowHash"))


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_no_row_is_missed_and_few_others_are_taken(spark, monkeypatch, bound):
    monkeypatch.setattr(membership, "broadcast_rows", lambda spark: bound)
    # Two loads of unlike size, so two scales for a month, and a month with a load of a single row.
    index = membership.words_of(hashed(spark, 0, 6_000)).unionByName(membership.words_of(hashed(spark, 6_000, 6_100)))
    index = index.unionByName(membership.words_of(hashed(spark, 0, 1, MAY)))
    asked = hashed(spark, 0, 12_000).unionByName(hashed(spark, 0, 2, MAY))
    found = membership.possible_copies(asked, index, [201101, 201105], 12_002)
    per_month = {r.SalesMonth: r["count"] for r in found.groupBy("SalesMonth").count().collect()}
    held = hashed(spark, 0, 6_100).join(found.filter("SalesMonth = 201101"), "RowHash", "left_anti")
    assert held.isEmpty()
    assert 6_100 <= per_month[201101] <= 6_100 + 5_900 * 0.03
    assert per_month[201105] == 1


def test_a_month_has_a_row_of_the_index_for_a_few_of_its_rows(spark):
    rows = hashed(spark, 0, 4_000).unionByName(hashed(spark, 0, 40, MAY))
    words = {r.SalesMonth: r["count"] for r in membership.words_of(rows).groupBy("SalesMonth").count().collect()}
    assert words[201101] <= 1_024 and words[201105] <= 16
    assert membership.words_of(rows.limit(0)).isEmpty()
    nulls = rows.limit(3).withColumn("RowHash", F.lit(None).cast("bigint"))
    assert membership.words_of(nulls).isEmpty()


def invoices(*dated):
    return [{"InvoiceNo": number, "InvoiceDate": f"{day} 8:26"} for number, day in dated]


FIRST = [("1", "1/5/2010"), ("2", "6/5/2010"), ("3", "1/5/2011"), ("4", "12/5/2011")]


def test_a_batch_without_copies_reads_no_fact(lines, warehouse, monkeypatch):
    load_batch(lines(*invoices(*FIRST)), warehouse)
    compared = []

    def spied(rows, fact, possible):
        result = membership_not_loaded(rows, fact, possible)
        # The whole comparison has a join; without possible copies the rows stay as they are.
        compared.append(None if result is rows else {name.split("SalesMonth=")[1][:6] for name in possible_months(possible)})
        return result

    def possible_months(possible):
        return [f"SalesMonth={r.SalesMonth}" for r in possible.select("SalesMonth").distinct().collect()]

    membership_not_loaded = membership.not_loaded
    monkeypatch.setattr(load.membership, "not_loaded", spied)
    load_batch(lines(*invoices(("5", "1/6/2010"), ("6", "12/6/2011"))), warehouse, use_mark=False)
    load_batch(lines(*invoices(("1", "1/5/2010"), ("7", "6/9/2011"))), warehouse, use_mark=False)
    assert compared == [None, {"201001"}]
    assert len(facts_of(warehouse)) == 7


def test_an_index_that_is_not_whole_is_not_asked(lines, warehouse, monkeypatch):
    load_batch(lines(*invoices(*FIRST)), warehouse)
    state = warehouse.state()
    assert INDEXED in state.bases
    # As a warehouse without an index of its first loads has it.
    warehouse.write_nothing("fact_index", 1)
    bases = {table: base for table, base in state.bases.items() if table != INDEXED}
    warehouse.publish(replace(state, bases=bases))
    batch = lines(*invoices(*FIRST, ("5", "1/6/2010")))
    load_batch(batch, warehouse, use_mark=False)
    assert len(facts_of(warehouse)) == 5

    warehouse.compact()
    assert INDEXED in warehouse.state().bases
    index = warehouse.read("fact_index")
    found = membership.possible_copies(warehouse.read("fact_sales"), index, [201001, 201006, 201101, 201112], 5)
    assert found.count() == 5
    load_batch(batch, warehouse, use_mark=False)
    assert len(facts_of(warehouse)) == 5


def test_rows_stay_where_they_are_when_few_facts_can_be_copied(lines, warehouse):
    load_batch(lines(*invoices(*FIRST)), warehouse)
    spark, fact = warehouse.spark, warehouse.read("fact_sales")
    rows = warehouse.write_working("rows", fact.drop("SalesMonth"))
    possible = warehouse.write_working("possible", fact.limit(1).select("SalesMonth", "RowHash"))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = membership.not_loaded(rows, fact, possible)
        assert new.count() == 3
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_asked_rows_are_shuffled_by_their_hash_alone(spark, monkeypatch):
    monkeypatch.setattr(membership, "broadcast_rows", lambda spark: 0)
    index = membership.words_of(hashed(spark, 0, 100))
    found = membership.possible_copies(hashed(spark, 0, 200), index, [201101], 200)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # Neither word nor bits of the rows are columns that a shuffle would carry.
    assert "Asked" not in plan


def test_an_update_sums_up_its_customers_once(lines, warehouse, monkeypatch):
    summed = []
    values = load.dimensions.customer_values
    monkeypatch.setattr(load.dimensions, "customer_values", lambda rows: summed.append(1) or values(rows))
    load_batch(lines(*invoices(*FIRST)), warehouse, customers="update")
    assert len(summed) == 1
