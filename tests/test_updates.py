from datetime import date

from tillstar.operators import updates
from tillstar.schemas import DIM_CUSTOMER

ROLLUP = "CustomerID long, Country string, FirstPurchaseDate date, LastPurchaseDate date"
D = [date(2010, 12, d) for d in range(1, 10)]


def test_type_1(spark):
    existing = spark.createDataFrame(
        [(1, 10, "France", D[2], D[3]), (2, 20, "Spain", D[2], D[3])], DIM_CUSTOMER
    )
    rollup = spark.createDataFrame(
        [(10, None, D[1], D[5]), (30, "Italy", D[4], D[4])], ROLLUP
    )
    rows = updates.update_in_place(existing, rollup, 2).orderBy("CustomerKey").collect()
    assert [tuple(r) for r in rows] == [
        (1, 10, "France", D[1], D[5]),
        (2, 20, "Spain", D[2], D[3]),
        (3, 30, "Italy", D[4], D[4]),
    ]


def test_type_2(spark):
    old = spark.createDataFrame(
        [(10, "France", D[0], D[1]), (20, "Spain", D[0], D[1]), (40, None, D[0], D[1])], ROLLUP
    )
    new = spark.createDataFrame(
        [(10, "France", D[0], D[5]), (30, "Italy", D[4], D[4]), (40, None, D[0], D[1])], ROLLUP
    )
    history = updates.update_history(
        updates.start_history(old, D[1]), new, "CustomerID", D[6]
    )
    rows = sorted(tuple(r) for r in history.collect())
    assert [(r[0], r[3], r[4], r[5], r[6]) for r in rows] == [
        (10, D[1], D[1], D[6], False),
        (10, D[5], D[6], None, True),
        (20, D[1], D[1], None, True),
        (30, D[4], D[6], None, True),
        (40, D[1], D[1], None, True),
    ]
    again = updates.update_history(history, new, "CustomerID", D[7])
    assert sorted(map(str, again.collect())) == sorted(map(str, history.collect()))
