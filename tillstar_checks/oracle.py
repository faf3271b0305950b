"""The registered queries once more, as plain SQL over the test tables.

Business keys stand in for surrogate keys: each is unique in its dimension, so groups and
distinct counts are the same.
"""

FULL_SEED = "1900-01-01 00:00:00"
# The bounds of the increment queries; see tillstar_checks/registry.py.
LATE_SEED = "2001-01-01 00:00:00"
EARLY_CUT = "1995-04-01 00:00:00"

# The characters str.strip() takes as whitespace, as a DuckDB expression.
_SPACES = (
    "(SELECT string_agg(chr(c), '' ORDER BY c) FROM (VALUES (9),(10),(11),(12),(13),(28),(29),"
    "(30),(31),(32),(133),(160),(5760),(8192),(8193),(8194),(8195),(8196),(8197),(8198),(8199),"
    "(8200),(8201),(8202),(8232),(8233),(8239),(8287),(12288)) AS codes(c))"
)


def _stripped(column):
    return f"trim({column}, (SELECT chars FROM spaces))"


RAW = """
lines AS (
  SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, o_custkey, o_orderdate,
         p_name, n_name, (l_returnflag = 'R' AND l_orderkey % 16 = 0) AS canc
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
),
one_copy AS (
  SELECT CASE WHEN canc THEN 'C' ELSE '' END || CAST(500000 + l_orderkey AS VARCHAR) AS InvoiceNo,
         CAST(10000 + l_partkey AS VARCHAR) || CASE WHEN l_partkey % 10 = 0 THEN 'A' ELSE '' END
           AS StockCode,
         CASE WHEN l_partkey % 97 = 0 THEN NULL
              WHEN l_partkey % 5 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS Description,
         CAST(CASE WHEN canc THEN -l_quantity WHEN l_partkey % 1009 = 5 THEN 0
              ELSE l_quantity END AS INTEGER) AS Quantity,
         strftime(o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER))
                  + to_minutes(CAST(l_orderkey % 60 AS INTEGER)), '%m/%d/%Y %H:%M') AS InvoiceDate,
         CASE WHEN l_partkey % 1013 = 7 THEN 0.0 ELSE l_extendedprice / 1000 END::DOUBLE
           AS UnitPrice,
         CASE WHEN l_orderkey % 4 = 3 THEN NULL ELSE CAST(12000 + o_custkey AS DOUBLE) END
           AS CustomerID,
         n_name || CASE WHEN l_orderkey % 7 = 0 THEN ' ' ELSE '' END AS Country,
         (l_linenumber = 1 AND l_orderkey % 20 = 0) AS twice
  FROM lines
),
raw AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
  FROM one_copy
  UNION ALL
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
  FROM one_copy WHERE twice
)"""

KEYED = """
keyed AS (
  SELECT * FROM raw
  WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND CustomerID IS NOT NULL
)"""
DEDUPED = "deduped AS (SELECT DISTINCT * FROM keyed)"
PARSED = """
parsed AS (
  SELECT * REPLACE (strptime(InvoiceDate, '%m/%d/%Y %H:%M') AS InvoiceDate) FROM deduped
)"""
NOT_CANCELLED = "not_cancelled AS (SELECT * FROM parsed WHERE NOT starts_with(InvoiceNo, 'C'))"
POSITIVE = "positive AS (SELECT * FROM not_cancelled WHERE Quantity > 0 AND UnitPrice > 0)"
AMOUNT = """
amount AS (
  SELECT *, CAST(Quantity * CAST(UnitPrice AS DECIMAL(18,6)) AS DECIMAL(29,6)) AS TotalSalesAmount
  FROM positive
)"""
STRIPPED = f"""
spaces AS (SELECT {_SPACES} AS chars),
stripped AS (
  SELECT * REPLACE ({_stripped('InvoiceNo')} AS InvoiceNo, {_stripped('StockCode')} AS StockCode,
                    {_stripped('Description')} AS Description, {_stripped('Country')} AS Country)
  FROM amount
)"""
TYPED = "typed AS (SELECT * REPLACE (CAST(CustomerID AS BIGINT) AS CustomerID) FROM stripped)"
DATED = """
dated AS (
  SELECT *, CAST(year(InvoiceDate) AS INTEGER) AS InvoiceYear,
         CAST(month(InvoiceDate) AS INTEGER) AS InvoiceMonth,
         CAST(day(InvoiceDate) AS INTEGER) AS InvoiceDay
  FROM typed
)"""
CLEAN = """
clean AS (
  SELECT *, CAST(strftime(InvoiceDate, '%Y%m%d') AS INTEGER) AS DateKey FROM dated
)"""

STEPS = [
    RAW, KEYED, DEDUPED, PARSED, NOT_CANCELLED, POSITIVE, AMOUNT, STRIPPED, TYPED, DATED, CLEAN
]


def upto(last, query, *more):
    """A query over the first steps, up to and including the given one."""
    steps = STEPS[: STEPS.index(last) + 1]
    return "WITH " + ",".join([*steps, *more]) + "\n" + query


DIM_DATE = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate,
         CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month,
         monthname(d) AS MonthName, CAST(quarter(d) AS INTEGER) AS Quarter,
         CAST(day(d) AS INTEGER) AS Day, dayname(d) AS DayOfWeek, isodow(d) >= 6 AS IsWeekend
  FROM (SELECT DISTINCT CAST(InvoiceDate AS DATE) AS d FROM clean)
)"""
DIM_PRODUCT = """
dim_product AS (
  SELECT StockCode, Description FROM (
    SELECT StockCode, Description, row_number() OVER (
      PARTITION BY StockCode ORDER BY InvoiceDate, Description NULLS LAST) AS rn
    FROM clean) WHERE rn = 1
)"""
DIM_CUSTOMER = """
dim_customer AS (
  SELECT CustomerID, Country, FirstPurchaseDate, LastPurchaseDate FROM (
    SELECT CAST(CustomerID AS INTEGER) AS CustomerID,
           CAST(MIN(InvoiceDate) AS DATE) AS FirstPurchaseDate,
           CAST(MAX(InvoiceDate) AS DATE) AS LastPurchaseDate
    FROM clean GROUP BY CustomerID)
  LEFT JOIN (
    SELECT CAST(CustomerID AS INTEGER) AS CustomerID, Country, row_number() OVER (
      PARTITION BY CustomerID ORDER BY InvoiceDate, Country) AS rn
    FROM clean WHERE Country IS NOT NULL) AS named USING (CustomerID)
  WHERE rn = 1 OR rn IS NULL
)"""


def _fact(seed):
    return f"""
fact_sales AS (
  SELECT InvoiceNo, DateKey, StockCode, CAST(CustomerID AS INTEGER) AS CustomerID, Quantity,
         CAST(ROUND(CAST(UnitPrice AS DECIMAL(18,6)), 2) AS DECIMAL(10,2)) AS UnitPrice,
         CAST(ROUND(TotalSalesAmount, 2) AS DECIMAL(10,2)) AS TotalSalesAmount, Country
  FROM clean WHERE InvoiceDate > TIMESTAMP '{seed}'
)"""


def star(query, seed=FULL_SEED):
    return upto(CLEAN, query, DIM_DATE, DIM_PRODUCT, DIM_CUSTOMER, _fact(seed))


def _avg(total, count):
    return f"ROUND(CAST({total} AS DOUBLE) / NULLIF({count}, 0), 6)"


def _revenue(column="TotalSalesAmount"):
    return f"CAST(SUM({column}) AS DECIMAL(20,2))"


def _count(expression):
    return f"CAST({expression} AS BIGINT)"


def _labelled(rows, *names):
    """UNION ALL of (labels..., count subquery) rows."""
    selects = []
    for *labels, count in rows:
        shown = [label if isinstance(label, int) else f"'{label}'" for label in labels]
        columns = ", ".join(f"{v} AS {n}" for v, n in zip([*shown, count], names, strict=True))
        selects.append(f"SELECT {columns}")
    return "\nUNION ALL\n".join(selects)


# The early star: the rows up to a cut date, as an earlier load would have seen them.
EARLY_KEYS = f"""
early AS (SELECT * FROM clean WHERE InvoiceDate <= TIMESTAMP '{EARLY_CUT}')"""

_RAW_NAMES = [
    "InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID",
    "Country",
]

_NOT_NULL = {
    "dim_date": ["DateKey", "FullDate", "Year", "Month", "MonthName", "Quarter", "Day",
                 "DayOfWeek", "IsWeekend"],
    "dim_product": ["ProductKey", "StockCode"],
    "dim_customer": ["CustomerKey", "CustomerID"],
    "fact_sales": ["SalesKey", "InvoiceNo", "DateKey", "ProductKey", "CustomerKey", "Quantity",
                   "UnitPrice", "TotalSalesAmount"],
    "watermark": ["TableName", "LastLoadedDate"],
}
_BUSINESS = {"ProductKey": "StockCode", "CustomerKey": "CustomerID"}


def _null_counts():
    rows = []
    for table, columns in _NOT_NULL.items():
        for column in columns:
            if table == "watermark":
                count = (
                    "(SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT MAX(InvoiceDate) AS m FROM clean)"
                    " WHERE m IS NULL)"
                )
            else:
                name = _BUSINESS.get(column, column)
                name = "InvoiceNo" if name == "SalesKey" else name
                count = f"(SELECT CAST(COUNT(*) AS BIGINT) FROM {table} WHERE {name} IS NULL)"
            rows.append((table, column, count))
    return rows


def _duplicates(table, column):
    return (
        f"(SELECT CAST(COUNT(*) AS BIGINT) FROM (SELECT {column} FROM {table} GROUP BY {column}"
        " HAVING COUNT(*) > 1))"
    )


def _where(table, condition="TRUE"):
    return f"(SELECT CAST(COUNT(*) AS BIGINT) FROM {table} WHERE {condition})"


def _fact_select(extra=""):
    return (
        "SELECT InvoiceNo, DateKey, StockCode, CustomerID, Quantity, UnitPrice, TotalSalesAmount, "
        f"Country {extra} FROM fact_sales"
    )


def oracle_sql():
    sql = {}

    # Source and cleaning steps.
    sql["s1_csv_scan"] = upto(RAW, "SELECT * FROM raw")
    sql["s2_source_profile"] = upto(
        RAW,
        "SELECT COUNT(*) AS row_count, CAST(8 AS INTEGER) AS column_count, "
        f"'{','.join(_RAW_NAMES)}' AS column_names FROM raw",
    )
    sql["t1_null_profile"] = upto(
        RAW,
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
            "COUNT(*) AS row_count FROM raw"
            for c in _RAW_NAMES
        ),
    )
    for key, step, name in [
        ("t2_drop_nulls", KEYED, "keyed"),
        ("t3_dedup", DEDUPED, "deduped"),
        ("t4_parse_date", PARSED, "parsed"),
        ("t6_drop_cancelled", NOT_CANCELLED, "not_cancelled"),
        ("t7_positive", POSITIVE, "positive"),
        ("t8_amount", AMOUNT, "amount"),
        ("t9_strip", STRIPPED, "stripped"),
        ("t10_customer_int", TYPED, "typed"),
        ("t11_date_parts", DATED, "dated"),
        ("t12_datekey", CLEAN, "clean"),
    ]:
        sql[key] = upto(step, f"SELECT * FROM {name}")
    sql["t5_date_range"] = upto(
        PARSED, "SELECT MIN(InvoiceDate) AS min_date, MAX(InvoiceDate) AS max_date FROM parsed"
    )
    names = ["raw", "keyed", "deduped", "not_cancelled", "positive"]
    labels = ["drop_null_keys", "drop_duplicates", "drop_cancelled", "keep_positive"]
    sql["t13_audit"] = upto(
        POSITIVE,
        "\nUNION ALL\n".join(
            f"SELECT '{label}' AS step, i.n AS rows_in, o.n AS rows_out, i.n - o.n AS removed "
            f"FROM (SELECT COUNT(*) AS n FROM {a}) i, (SELECT COUNT(*) AS n FROM {b}) o"
            for label, a, b in zip(labels, names, names[1:], strict=False)
        ),
    )

    # Dimensions and load.
    sql["d1_dim_date"] = star("SELECT * FROM dim_date")
    sql["l1_new_dates"] = upto(
        CLEAN,
        "SELECT * FROM dim_date WHERE DateKey NOT IN (SELECT DateKey FROM early)",
        EARLY_KEYS, DIM_DATE,
    )
    sql["l2_first_product"] = star("SELECT * FROM dim_product")
    sql["l3_new_products"] = upto(
        CLEAN,
        "SELECT * FROM dim_product WHERE StockCode NOT IN (SELECT StockCode FROM early)",
        EARLY_KEYS, DIM_PRODUCT,
    )
    customers = (
        "SELECT CAST(CustomerID AS BIGINT) AS CustomerID, Country, FirstPurchaseDate, "
        "LastPurchaseDate FROM dim_customer"
    )
    sql["l4_customer_rollup"] = star(customers)
    sql["l5_new_customers"] = upto(
        CLEAN,
        customers + " WHERE CustomerID NOT IN (SELECT CustomerID FROM early)",
        EARLY_KEYS, DIM_CUSTOMER,
    )
    sql["l6_surrogate_keys"] = star(
        "SELECT 'dim_product' AS table_name, row_number() OVER (ORDER BY StockCode) AS key_value, "
        "StockCode AS business_key FROM dim_product UNION ALL "
        "SELECT 'dim_customer', row_number() OVER (ORDER BY CustomerID), "
        "CAST(CustomerID AS VARCHAR) FROM dim_customer"
    )
    sql["l7_watermark"] = upto(
        CLEAN,
        "SELECT 'fact_sales' AS TableName, MAX(InvoiceDate) AS LastLoadedDate FROM clean",
    )
    sql["l8_increment"] = upto(
        CLEAN, f"SELECT * FROM clean WHERE InvoiceDate > TIMESTAMP '{LATE_SEED}'"
    )
    lookups = (
        "SELECT c.InvoiceNo, c.StockCode, c.CustomerID, c.InvoiceDate, "
        "CASE WHEN p.StockCode IS NULL THEN 'missing product key' "
        "WHEN k.CustomerID IS NULL THEN 'missing customer key' END AS Reason FROM clean c "
        "LEFT JOIN (SELECT DISTINCT StockCode FROM early) p ON c.StockCode = p.StockCode "
        "LEFT JOIN (SELECT DISTINCT CustomerID FROM early) k ON c.CustomerID = k.CustomerID"
    )
    sql["l12_missing_keys"] = upto(
        CLEAN, f"SELECT * FROM ({lookups}) WHERE Reason IS NOT NULL", EARLY_KEYS
    )
    keyed_lookup = (
        "SELECT c.InvoiceNo, c.StockCode, c.CustomerID, c.InvoiceDate, c.Quantity, "
        "p.ProductKey, k.CustomerKey FROM clean c "
        "JOIN (SELECT StockCode, row_number() OVER (ORDER BY StockCode) AS ProductKey "
        "FROM dim_product) p ON c.StockCode = p.StockCode "
        "JOIN (SELECT CustomerID, row_number() OVER (ORDER BY CustomerID) AS CustomerKey "
        "FROM dim_customer) k ON c.CustomerID = k.CustomerID"
    )
    sql["l10_l11_lookups"] = star(keyed_lookup)
    sql["l10_l11_salted_lookups"] = star(keyed_lookup)
    sql["l13_fact_sales"] = star(_fact_select())
    price = "CAST(UnitPrice * 1000000 AS DECIMAL(18,6))"
    sql["l14_rejects"] = upto(
        CLEAN,
        "SELECT 'fact_sales' AS TargetTable, Reason, InvoiceNo, StockCode, Quantity, CustomerID "
        "FROM (SELECT *, CASE "
        f"WHEN TRY_CAST(ROUND({price}, 2) AS DECIMAL(10,2)) IS NULL THEN 'UnitPrice does not fit' "
        f"WHEN TRY_CAST(ROUND(Quantity * {price}, 2) AS DECIMAL(10,2)) IS NULL "
        "THEN 'TotalSalesAmount does not fit' END AS Reason FROM clean) WHERE Reason IS NOT NULL",
    )
    sql["l15_new_mark"] = upto(CLEAN, "SELECT MAX(InvoiceDate) AS LastLoadedDate FROM clean")
    sql["l18_rerun_adds_nothing"] = star(
        "\nUNION ALL\n".join(
            f"SELECT '{t}' AS table_name, (SELECT COUNT(*) FROM {t}) AS rows_before, "
            f"CAST(0 AS BIGINT) AS rows_added"
            for t in ["dim_date", "dim_product", "dim_customer", "fact_sales"]
        ),
        LATE_SEED,
    )

    # Quality.
    unique = [
        ("dim_date", "DateKey", _duplicates("dim_date", "DateKey")),
        ("dim_product", "ProductKey", _duplicates("dim_product", "StockCode")),
        ("dim_product", "StockCode", _duplicates("dim_product", "StockCode")),
        ("dim_customer", "CustomerKey", _duplicates("dim_customer", "CustomerID")),
        ("dim_customer", "CustomerID", _duplicates("dim_customer", "CustomerID")),
        ("fact_sales", "SalesKey", "(SELECT CAST(COUNT(*) - COUNT(DISTINCT rn) AS BIGINT) FROM "
         "(SELECT row_number() OVER () AS rn FROM fact_sales))"),
        ("watermark", "TableName", "CAST(0 AS BIGINT)"),
    ]
    sql["c1_unique_keys"] = star(
        _labelled(unique, "table_name", "key_column", "duplicated")
    )
    sql["c2_not_null"] = star(
        _labelled(_null_counts(), "table_name", "column_name", "null_count")
    )
    sql["c3_value_rules"] = star(
        _labelled(
            [("Quantity <= 0", _where("fact_sales", "Quantity <= 0")),
             ("UnitPrice <= 0", _where("fact_sales", "UnitPrice <= 0")),
             ("TotalSalesAmount < 0", _where("fact_sales", "TotalSalesAmount < 0"))],
            "rule", "violations",
        )
    )
    sql["c4_references"] = star(
        _labelled(
            [(key, _where("fact_sales", f"{column} NOT IN (SELECT {column} FROM {dim})"))
             for key, column, dim in [("DateKey", "DateKey", "dim_date"),
                                      ("ProductKey", "StockCode", "dim_product"),
                                      ("CustomerKey", "CustomerID", "dim_customer")]],
            "foreign_key", "orphans",
        )
    )
    sql["c4_orphans_of_early_dims"] = upto(
        CLEAN,
        "SELECT StockCode, COUNT(*) AS fact_rows FROM fact_sales "
        "WHERE StockCode NOT IN (SELECT StockCode FROM early) GROUP BY StockCode",
        EARLY_KEYS, _fact(FULL_SEED),
    )
    limits = [
        ("dim_date", "MonthName", 20), ("dim_date", "DayOfWeek", 20),
        ("dim_product", "StockCode", 50), ("dim_product", "Description", 255),
        ("dim_customer", "Country", 100), ("fact_sales", "InvoiceNo", 20),
        ("fact_sales", "Country", 100),
    ]
    sql["c5_length_limits"] = star(
        _labelled(
            [(t, c, n, _where(t, f"length({c}) > {n}")) for t, c, n in limits]
            + [("watermark", "TableName", 100, "CAST(0 AS BIGINT)")],
            "table_name", "column_name", "length_limit", "too_long",
        )
    )
    fits = "TRY_CAST(ROUND({}, 2) AS DECIMAL(10,2)) IS NULL"
    sql["c5_precision"] = upto(
        CLEAN,
        _labelled(
            [("UnitPrice", _where("clean", fits.format("CAST(UnitPrice AS DECIMAL(18,6))"))),
             ("TotalSalesAmount", _where("clean", fits.format("TotalSalesAmount")))],
            "column_name", "does_not_fit",
        ),
    )
    sql["c6_rejected_rows"] = upto(
        RAW,
        "SELECT * FROM (SELECT *, CASE "
        "WHEN InvoiceNo IS NULL OR StockCode IS NULL OR CustomerID IS NULL "
        "THEN 'missing key column' "
        "WHEN starts_with(InvoiceNo, 'C') THEN 'cancelled invoice' "
        "WHEN NOT coalesce(Quantity > 0 AND UnitPrice > 0, FALSE) "
        "THEN 'quantity or price not positive' END AS Reason FROM raw) WHERE Reason IS NOT NULL",
    )
    sql["c7_date_range"] = star(
        "SELECT MIN(FullDate) AS min_date, MAX(FullDate) AS max_date, "
        f"{_where('fact_sales', 'DateKey < 19960101 OR DateKey > 20001231')} AS out_of_range "
        "FROM fact_sales JOIN dim_date USING (DateKey)"
    )

    # Analysis.
    sql["q1_overall_metrics"] = star(
        "SELECT COUNT(DISTINCT InvoiceNo) AS TotalTransactions, "
        "COUNT(DISTINCT CustomerID) AS UniqueCustomers, "
        f"COUNT(DISTINCT StockCode) AS UniqueProducts, {_revenue()} AS TotalRevenue, "
        f"{_avg('SUM(TotalSalesAmount)', 'COUNT(*)')} AS AvgTransactionValue, "
        "MIN(FullDate) AS EarliestDate, MAX(FullDate) AS LatestDate "
        "FROM fact_sales JOIN dim_date USING (DateKey)"
    )
    lifespan = "date_diff('day', FirstPurchaseDate, LastPurchaseDate)"
    lifespan = f"CAST({lifespan} AS INTEGER) AS CustomerLifespanDays"
    sql["q2_top_customers"] = star(
        "SELECT c.CustomerID, c.Country, c.FirstPurchaseDate, c.LastPurchaseDate, "
        f"{lifespan}, {_revenue()} AS TotalSpent, "
        f"{_avg('SUM(TotalSalesAmount)', 'COUNT(*)')} AS AvgOrderValue, "
        "COUNT(DISTINCT InvoiceNo) AS NumberOfOrders "
        "FROM dim_customer c JOIN fact_sales f ON c.CustomerID = f.CustomerID "
        "GROUP BY c.CustomerID, c.Country, c.FirstPurchaseDate, c.LastPurchaseDate "
        "ORDER BY TotalSpent DESC, c.CustomerID LIMIT 20"
    )
    short_customers = (
        f"SELECT c.CustomerID, c.Country, {_revenue()} AS TotalSpent "
        "FROM dim_customer c JOIN fact_sales f ON c.CustomerID = f.CustomerID "
        "GROUP BY c.CustomerID, c.Country ORDER BY TotalSpent DESC, c.CustomerID LIMIT 20"
    )
    sql["r1_top_customers_short"] = star(short_customers)
    sql["q3_customer_segments"] = star(
        "SELECT CASE WHEN TotalSpent > 5000 THEN 'High Value' WHEN TotalSpent > 1000 "
        "THEN 'Medium Value' ELSE 'Low Value' END AS CustomerSegment, "
        "COUNT(*) AS NumberOfCustomers, "
        f"{_avg('SUM(TotalSpent)', 'COUNT(*)')} AS AvgSpentPerSegment, "
        "MIN(TotalSpent) AS MinSpent, MAX(TotalSpent) AS MaxSpent FROM "
        f"(SELECT c.CustomerID, {_revenue()} AS TotalSpent FROM dim_customer c "
        "JOIN fact_sales f ON c.CustomerID = f.CustomerID GROUP BY c.CustomerID) GROUP BY 1"
    )
    sql["q4_top_products"] = star(
        "SELECT p.StockCode, p.Description, COUNT(DISTINCT InvoiceNo) AS TimesPurchased, "
        "CAST(SUM(Quantity) AS BIGINT) AS TotalQuantitySold, "
        f"{_avg('SUM(UnitPrice)', 'COUNT(*)')} AS AvgPrice, {_revenue()} AS TotalRevenue, "
        f"{_avg('SUM(TotalSalesAmount)', 'COUNT(DISTINCT InvoiceNo)')} AS RevenuePerTransaction "
        "FROM dim_product p JOIN fact_sales f ON p.StockCode = f.StockCode "
        "GROUP BY p.StockCode, p.Description ORDER BY TotalRevenue DESC, p.StockCode LIMIT 20"
    )
    sql["q5_price_dispersion"] = star(
        "SELECT p.StockCode, p.Description, MIN(UnitPrice) AS MinPrice, MAX(UnitPrice) AS MaxPrice, "
        f"{_avg('SUM(UnitPrice)', 'COUNT(*)')} AS AvgPrice, "
        "ROUND(stddev_samp(CAST(UnitPrice AS DOUBLE)), 6) AS PriceStdDev, "
        "COUNT(*) AS TransactionCount "
        "FROM dim_product p JOIN fact_sales f ON p.StockCode = f.StockCode "
        "GROUP BY p.StockCode, p.Description HAVING COUNT(*) > 5 "
        "ORDER BY PriceStdDev DESC NULLS LAST, p.StockCode LIMIT 30"
    )
    sql["q6_revenue_by_country"] = star(
        "SELECT Country, COUNT(DISTINCT CustomerID) AS UniqueCustomers, "
        "COUNT(DISTINCT InvoiceNo) AS NumberOfOrders, COUNT(*) AS LineItems, "
        f"{_revenue()} AS TotalRevenue, {_avg('SUM(TotalSalesAmount)', 'COUNT(*)')} AS AvgOrderValue, "
        "CAST(SUM(Quantity) AS BIGINT) AS TotalUnits FROM fact_sales "
        "GROUP BY Country ORDER BY TotalRevenue DESC, Country LIMIT 15"
    )
    sql["q7_monthly_trend"] = star(
        "SELECT Year, Month, MonthName, COUNT(DISTINCT InvoiceNo) AS Orders, "
        f"COUNT(DISTINCT CustomerID) AS UniqueCustomers, {_revenue()} AS TotalRevenue, "
        f"{_avg('SUM(TotalSalesAmount)', 'COUNT(*)')} AS AvgOrderValue "
        "FROM fact_sales JOIN dim_date USING (DateKey) GROUP BY Year, Month, MonthName"
    )
    sql["r2_monthly_trend_short"] = star(
        "SELECT Year, Month, MonthName, COUNT(DISTINCT InvoiceNo) AS Orders, "
        f"{_revenue()} AS Revenue "
        "FROM fact_sales JOIN dim_date USING (DateKey) GROUP BY Year, Month, MonthName"
    )
    sql["q8_weekday_pattern"] = star(
        f"SELECT DayOfWeek, COUNT(DISTINCT InvoiceNo) AS Orders, {_revenue()} AS TotalRevenue, "
        f"{_avg('SUM(TotalSalesAmount)', 'COUNT(*)')} AS AvgOrderValue "
        "FROM fact_sales JOIN dim_date USING (DateKey) GROUP BY DayOfWeek"
    )
    summary = [
        ("Total fact_sales records", _where("fact_sales")),
        ("Unique dates (dim_date)", _where("dim_date")),
        ("Unique products (dim_product)", _where("dim_product")),
        ("Unique customers (dim_customer)", _where("dim_customer")),
        ("Orphaned facts (missing product)", _where("fact_sales", "StockCode IS NULL")),
        ("Orphaned facts (missing customer)", _where("fact_sales", "CustomerID IS NULL")),
        ("Orphaned facts (missing date)", _where("fact_sales", "DateKey IS NULL")),
        ("Invalid quantities (<=0)", _where("fact_sales", "Quantity <= 0")),
        ("Invalid prices (<=0)", _where("fact_sales", "UnitPrice <= 0")),
        ("Negative sales amounts", _where("fact_sales", "TotalSalesAmount < 0")),
    ]
    sql["q9_quality_summary"] = star(_labelled(summary, "QualityCheck", "RecordCount"))
    daily = (
        "SELECT FullDate, DayOfWeek, Country, COUNT(DISTINCT InvoiceNo) AS DailyOrders, "
        "COUNT(DISTINCT CustomerID) AS DailyUniqueCustomers, "
        f"CAST(SUM(Quantity) AS BIGINT) AS DailyQuantity, {_revenue()} AS DailyRevenue, "
        f"{_avg('SUM(TotalSalesAmount)', 'COUNT(*)')} AS AvgDailyOrderValue "
        "FROM fact_sales JOIN dim_date USING (DateKey) GROUP BY FullDate, DayOfWeek, Country"
    )
    sql["v1_daily_sales"] = star(daily)
    performance = (
        "SELECT p.StockCode, p.Description, CAST(SUM(Quantity) AS BIGINT) AS TotalQuantitySold, "
        f"{_revenue()} AS TotalRevenue, COUNT(DISTINCT InvoiceNo) AS TimesPurchased, "
        f"{_avg('SUM(UnitPrice)', 'COUNT(UnitPrice)')} AS AvgUnitPrice, "
        "COUNT(DISTINCT CustomerID) AS UniqueCustomersBought "
        "FROM dim_product p LEFT JOIN fact_sales f ON p.StockCode = f.StockCode "
        "GROUP BY p.StockCode, p.Description"
    )
    sql["v2_product_performance"] = star(performance)
    sql["v2_product_performance_unsold"] = star(performance, LATE_SEED)
    per_customer = (
        "SELECT c.CustomerID, c.Country, c.FirstPurchaseDate, c.LastPurchaseDate, "
        f"{lifespan}, COUNT(DISTINCT InvoiceNo) AS TotalOrders, "
        f"CAST(SUM(Quantity) AS BIGINT) AS TotalItemsPurchased, {_revenue()} AS TotalSpent, "
        f"{_avg('SUM(TotalSalesAmount)', 'COUNT(TotalSalesAmount)')} AS AvgOrderValue "
        "FROM dim_customer c LEFT JOIN fact_sales f ON c.CustomerID = f.CustomerID "
        "GROUP BY c.CustomerID, c.Country, c.FirstPurchaseDate, c.LastPurchaseDate"
    )
    sql["v3_customer_summary"] = star(per_customer)
    sql["v3_customer_summary_unsold"] = star(per_customer, LATE_SEED)
    sql["s9_view_by_sql"] = star(
        "SELECT Country, COUNT(*) AS days, CAST(SUM(DailyRevenue) AS DECIMAL(30,2)) AS revenue "
        f"FROM ({daily}) WHERE FullDate >= DATE '2000-01-01' GROUP BY Country"
    )

    # Flat model.
    sql["a1_flat_top_customers"] = star(
        short_customers.replace("SELECT c.CustomerID,", "SELECT CAST(c.CustomerID AS BIGINT) AS CustomerID,", 1)
    )
    sql["a2_flat_top_countries"] = star(
        f"SELECT Country, COUNT(DISTINCT CustomerID) AS UniqueCustomers, {_revenue()} AS TotalRevenue "
        "FROM fact_sales GROUP BY Country ORDER BY TotalRevenue DESC, Country LIMIT 15"
    )
    sql["a3_flat_top_products"] = star(
        "SELECT p.StockCode, p.Description, COUNT(DISTINCT InvoiceNo) AS TimesPurchased, "
        f"{_revenue()} AS TotalRevenue "
        "FROM dim_product p JOIN fact_sales f ON p.StockCode = f.StockCode "
        "GROUP BY p.StockCode, p.Description ORDER BY TotalRevenue DESC, p.StockCode LIMIT 20"
    )

    # Extensions.
    sql["x1_stream_load"] = star(_fact_select())
    sql["x2_dim_update"] = star("SELECT * FROM dim_customer")
    history_early = DIM_CUSTOMER.replace("FROM clean", "FROM early").replace(
        "dim_customer AS", "early_customer AS"
    )
    sql["x2_dim_history"] = upto(
        CLEAN,
        f"""
SELECT e.CustomerID, e.Country, e.FirstPurchaseDate, e.LastPurchaseDate,
       DATE '1995-04-01' AS ValidFrom,
       CASE WHEN changed THEN DATE '2001-08-01' END AS ValidTo, NOT changed AS IsCurrent
FROM (SELECT e.*, (e.Country IS DISTINCT FROM n.Country
        OR e.FirstPurchaseDate IS DISTINCT FROM n.FirstPurchaseDate
        OR e.LastPurchaseDate IS DISTINCT FROM n.LastPurchaseDate) AS changed
      FROM early_customer e JOIN dim_customer n USING (CustomerID)) e
UNION ALL
SELECT n.CustomerID, n.Country, n.FirstPurchaseDate, n.LastPurchaseDate,
       DATE '2001-08-01', NULL, TRUE
FROM dim_customer n LEFT JOIN early_customer e USING (CustomerID)
WHERE e.CustomerID IS NULL OR e.Country IS DISTINCT FROM n.Country
   OR e.FirstPurchaseDate IS DISTINCT FROM n.FirstPurchaseDate
   OR e.LastPurchaseDate IS DISTINCT FROM n.LastPurchaseDate""",
        EARLY_KEYS, DIM_CUSTOMER, history_early,
    )
    sql["x2_load_updates_customers"] = star("SELECT * FROM dim_customer")
    _varied(sql)
    _broken(sql)
    sql["s1_bad_lines"] = upto(
        RAW,
        f"SELECT InvoiceNo, COUNT(*) AS lines, COUNT(StockCode) AS with_stock_code FROM raw "
        f"WHERE {NUMBER} % 50 = 1 GROUP BY InvoiceNo",
    )
    sql["c6_load_rejects"] = sql["l14_rejects"]
    delivered = f"""
delivered AS (
  SELECT *, {NUMBER} % 4 AS slice FROM raw
  UNION ALL SELECT *, 3 FROM raw WHERE {NUMBER} % 20 = 0
),
whole AS (SELECT * FROM delivered WHERE CustomerID IS NOT NULL),
batches AS (SELECT DISTINCT * FROM whole)"""
    sql["x1_stream_audit"] = upto(
        RAW,
        _labelled(
            [("drop_null_keys", _where("delivered", "CustomerID IS NULL")),
             ("drop_cancelled", _where("batches", "starts_with(InvoiceNo, 'C')")),
             ("keep_positive", _where("batches", f"NOT starts_with(InvoiceNo, 'C') AND NOT {_SOLD}")),
             ("copies", f"({_where('whole')} - {_where('batches')} + {_where('batches', _KEPT)} - "
              f"(SELECT COUNT(*) FROM (SELECT DISTINCT * EXCLUDE (slice) FROM batches WHERE {_KEPT})))")],
            "step", "removed",
        ),
        delivered,
    )
    sql["x1_membership_index"] = upto(
        CLEAN,
        f"SELECT DateKey // 100 AS SalesMonth, COUNT(*) AS rows, "
        f"COUNT(*) FILTER ({NUMBER} % 3 = 0) AS loaded, CAST(0 AS BIGINT) AS missed FROM clean GROUP BY 1",
    )
    return sql


NUMBER = "CAST(replace(InvoiceNo, 'C', '') AS INTEGER)"
_SOLD = "(Quantity > 0 AND UnitPrice > 0)"
_KEPT = f"NOT starts_with(InvoiceNo, 'C') AND {_SOLD}"


def _varied(sql):
    """The rollups over lines whose description and country differ from line to line."""
    raw = RAW.replace(
        "CASE WHEN l_partkey % 97 = 0 THEN NULL\n"
        "              WHEN l_partkey % 5 = 0 THEN '  ' || p_name || ' ' ELSE p_name END AS Description",
        "CASE WHEN l_orderkey % 11 <> 0 THEN p_name || ' v' || CAST(l_linenumber % 3 AS VARCHAR) END "
        "AS Description",
    ).replace(
        "n_name || CASE WHEN l_orderkey % 7 = 0 THEN ' ' ELSE '' END AS Country",
        "CASE WHEN l_orderkey % 9 <> 0 THEN CASE WHEN l_orderkey % 5 = 0 THEN 'Elsewhere' ELSE n_name "
        "END END AS Country",
    )
    for plain in ("l2_first_product", "l4_customer_rollup"):
        sql[f"{plain}_varied"] = sql[plain].replace(RAW, raw)
    in_folder = """
named AS (
  SELECT *, row_number() OVER (PARTITION BY StockCode ORDER BY
    CASE WHEN number % 10 < 1 THEN 1 WHEN number % 10 < 8 THEN 2 ELSE 3 END, number, Description NULLS FIRST) AS place
  FROM (SELECT *, CAST(InvoiceNo AS INTEGER) AS number FROM clean)
)"""
    sql["l2_first_product_folder"] = upto(
        CLEAN, "SELECT StockCode, Description FROM named WHERE place = 1", in_folder
    ).replace(RAW, raw)
    # The latest known country of each customer.
    latest = DIM_CUSTOMER.replace("ORDER BY InvoiceDate, Country", "ORDER BY InvoiceDate DESC, Country DESC")
    sql["x2_load_updates_customers_varied"] = upto(CLEAN, "SELECT * FROM dim_customer", latest).replace(RAW, raw)
    versions = """
named AS (
  SELECT CustomerID, CAST(InvoiceDate AS DATE) AS day, Country, row_number() OVER (
    PARTITION BY CustomerID, CAST(InvoiceDate AS DATE) ORDER BY InvoiceDate, Country) AS rn
  FROM clean WHERE Country IS NOT NULL
),
known AS (
  SELECT *, lag(Country) OVER (PARTITION BY CustomerID ORDER BY day) AS before FROM named WHERE rn = 1
),
starts AS (
  SELECT CustomerID, Country, day, lead(day) OVER (PARTITION BY CustomerID ORDER BY day) AS until,
         row_number() OVER (PARTITION BY CustomerID ORDER BY day) AS n
  FROM known WHERE before IS NULL OR before <> Country
),
versions AS (
  SELECT CustomerID, Country, CASE WHEN n > 1 THEN day END AS ValidFrom, until AS ValidTo FROM starts
  UNION ALL
  SELECT DISTINCT CustomerID, NULL, NULL, NULL FROM clean WHERE CustomerID NOT IN (SELECT CustomerID FROM known)
)"""
    history = upto(
        CLEAN,
        """
SELECT CAST(v.CustomerID AS INTEGER) AS CustomerID, v.Country, ValidFrom, ValidTo, ValidTo IS NULL AS IsCurrent,
       CAST(COUNT(c.InvoiceNo) AS BIGINT) AS facts
FROM versions v LEFT JOIN clean c ON c.CustomerID = v.CustomerID
  AND (ValidFrom IS NULL OR CAST(c.InvoiceDate AS DATE) >= ValidFrom)
  AND (ValidTo IS NULL OR CAST(c.InvoiceDate AS DATE) < ValidTo)
GROUP BY ALL""",
        versions,
    ).replace(RAW, raw)
    # Whatever the order and the cut of the loads.
    for name in ("x2_load_keeps_history", "x2_history_any_order", "x2_history_stream"):
        sql[name] = history


def _broken(sql):
    """The checks over a star with every rule broken somewhere."""
    number = "CAST(InvoiceNo AS INTEGER) % 100"
    planted = f"""
sold AS (
  SELECT * FROM good_fact UNION ALL SELECT * FROM good_fact WHERE {number} = 0
),
fact_sales AS (
  SELECT CASE {number} WHEN 8 THEN repeat('9', 21) WHEN 9 THEN NULL ELSE InvoiceNo END AS InvoiceNo,
         CASE {number} WHEN 4 THEN 19000101 ELSE DateKey END AS DateKey,
         CASE {number} WHEN 1 THEN NULL WHEN 2 THEN 'none' ELSE StockCode END AS StockCode,
         CASE {number} WHEN 3 THEN -1 ELSE CustomerID END AS CustomerID,
         CASE {number} WHEN 5 THEN 0 ELSE Quantity END AS Quantity,
         CASE {number} WHEN 6 THEN 0 ELSE UnitPrice END AS UnitPrice,
         CASE {number} WHEN 7 THEN -1 ELSE TotalSalesAmount END AS TotalSalesAmount,
         CASE {number} WHEN 10 THEN repeat('x', 101) ELSE Country END AS Country
  FROM sold
),
dim_product AS (
  SELECT StockCode, CASE WHEN ends_with(StockCode, '77') THEN repeat('d', 256) ELSE Description END
           AS Description
  FROM (SELECT * FROM good_product UNION ALL
        SELECT * FROM good_product WHERE ends_with(StockCode, '55'))
),
dim_customer AS (
  SELECT * FROM good_customer UNION ALL SELECT * FROM good_customer WHERE CustomerID % 100 = 0
),
dim_date AS (
  SELECT * REPLACE (CASE WHEN Day <> 30 THEN MonthName END AS MonthName)
  FROM (SELECT * FROM good_date UNION ALL SELECT * FROM good_date WHERE Day = 31)
)"""
    good = [
        part.replace(f"{name} AS (", f"good_{short} AS (", 1)
        for part, name, short in [
            (DIM_DATE, "dim_date", "date"), (DIM_PRODUCT, "dim_product", "product"),
            (DIM_CUSTOMER, "dim_customer", "customer"), (_fact(FULL_SEED), "fact_sales", "fact"),
        ]
    ]

    def broken(rows, *names):
        return upto(CLEAN, _labelled(rows, *names), *good, planted)

    keys = [
        ("dim_date", "DateKey", "DateKey"), ("dim_product", "ProductKey", "StockCode"),
        ("dim_product", "StockCode", "StockCode"), ("dim_customer", "CustomerKey", "CustomerID"),
        ("dim_customer", "CustomerID", "CustomerID"),
    ]
    twice = [(t, k, _duplicates(t, c)) for t, k, c in keys]
    twice.append(("fact_sales", "SalesKey", _where("good_fact", f"{number} = 0")))
    sql["c1_unique_keys_broken"] = broken(twice, "table_name", "key_column", "duplicated")
    nulls = [(t, c, n) for t, c, n in _null_counts() if t != "watermark" and c != "SalesKey"]
    nulls.append(("fact_sales", "SalesKey", "CAST(0 AS BIGINT)"))
    sql["c2_not_null_broken"] = broken(nulls, "table_name", "column_name", "null_count")
    rules = ["Quantity <= 0", "UnitPrice <= 0", "TotalSalesAmount < 0"]
    sql["c3_value_rules_broken"] = broken(
        [(rule, _where("fact_sales", rule)) for rule in rules], "rule", "violations"
    )
    references = [
        ("DateKey", "DateKey", "dim_date"), ("ProductKey", "StockCode", "dim_product"),
        ("CustomerKey", "CustomerID", "dim_customer"),
    ]
    sql["c4_references_broken"] = broken(
        [(key, _where("fact_sales f", f"NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{c} = f.{c})"))
         for key, c, dim in references],
        "foreign_key", "orphans",
    )
    limits = [
        ("dim_date", "MonthName", 20), ("dim_date", "DayOfWeek", 20),
        ("dim_product", "StockCode", 50), ("dim_product", "Description", 255),
        ("dim_customer", "Country", 100), ("fact_sales", "InvoiceNo", 20),
        ("fact_sales", "Country", 100),
    ]
    sql["c5_length_limits_broken"] = broken(
        [(t, c, n, _where(t, f"length({c}) > {n}")) for t, c, n in limits],
        "table_name", "column_name", "length_limit", "too_long",
    )
    price = "CAST(UnitPrice * 1000000 AS DECIMAL(18,6))"
    sql["c5_precision_broken"] = upto(
        CLEAN,
        _labelled(
            [("UnitPrice", _where("clean", f"TRY_CAST(ROUND({price}, 2) AS DECIMAL(10,2)) IS NULL")),
             ("TotalSalesAmount", _where("clean", f"TRY_CAST(ROUND(Quantity * {price}, 2) AS "
                                         "DECIMAL(10,2)) IS NULL"))],
            "column_name", "does_not_fit",
        ),
    )
