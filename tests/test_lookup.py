from pyspark.sql import functions as F

from tillstar.operators import lookup


def hot_rows(spark):
    """One key holds a third of all rows; some keys have no entry."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 200))
    return spark.range(9000).select("id", key.alias("code"))


def entries(spark):
    some = spark.range(150).select(F.concat(F.lit("k"), "id").alias("code"), F.col("id").alias("Key"))
    return some.unionAll(spark.sql("SELECT 'hot', 1000L"))


def expected(spark):
    known = {r.code: r.Key for r in entries(spark).collect()}
    return sorted((r.id, known.get(r.code)) for r in hot_rows(spark).collect())


def found(df):
    return sorted((r.id, r.Key) for r in df.collect())


def key_order(rows):
    return [(i, -1 if k is None else k) for i, k in rows]


def test_both_ways_find_the_same_keys(spark):
    want = key_order(expected(spark))
    small = lookup.attach_key(hot_rows(spark), entries(spark), "code", "Key")
    assert key_order(found(small)) == want
    big = lookup.salted_lookup(hot_rows(spark), entries(spark), "code")
    assert key_order(found(big)) == want


def test_a_side_beyond_the_bound_is_not_broadcast(spark):
    spark.conf.set(lookup.BROADCAST_ROWS_SETTING, "10")
    try:
        assert not lookup.is_small(entries(spark))
        big = lookup.attach_key(hot_rows(spark), entries(spark), "code", "Key")
        assert "_salt" in big._jdf.queryExecution().optimizedPlan().toString()
        assert key_order(found(big)) == key_order(expected(spark))
    finally:
        spark.conf.unset(lookup.BROADCAST_ROWS_SETTING)


def test_the_hot_key_is_spread(spark):
    rows = lookup.salted_lookup(hot_rows(spark), entries(spark), "code", partitions=8)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in plan and "rand(" not in plan


def test_missing_lookup_values_stay_missing(spark):
    rows = spark.createDataFrame([(1, None), (2, "k1")], "id long, code string")
    for joined in (
        lookup.attach_key(rows, entries(spark), "code", "Key"),
        lookup.salted_lookup(rows, entries(spark), "code"),
    ):
        assert {r.id: r.Key for r in joined.collect()} == {1: None, 2: 1}
