"""DuckDB SQL for every registered query, over the same parquet tables.

Written independently of the Spark code: plain window functions, GROUP BY and
joins, so a mismatch points at a semantic difference. NULL ordering is spelled
out (DuckDB sorts NULLs last by default, Spark first).
"""

from __future__ import annotations

_ORDER = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, "
          "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus")

CTES = {
    "li": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_shipdate,
        l_orderkey * 7 + l_linenumber * 13 + l_partkey * 3 + l_suppkey AS seed,
        row_number() OVER (ORDER BY {_ORDER}) AS rid FROM lineitem""",
    "wh": """SELECT s.s_suppkey, n.n_name AS WarehouseLocation
        FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "snap": """SELECT CAST(li.rid AS BIGINT) AS SnapshotInvID, li.l_partkey AS ProductID,
        p.p_name AS ProductName, wh.WarehouseLocation,
        CAST(greatest(0.0, li.l_quantity - (li.l_orderkey % 51)) AS DOUBLE) AS unitsAvailable,
        CAST(li.l_quantity AS DOUBLE) AS unitsDemanded,
        CAST(date_trunc('month', li.l_shipdate) AS DATE) AS SnapshotDate, li.seed
        FROM li LEFT JOIN part p ON li.l_partkey = p.p_partkey
        LEFT JOIN wh ON li.l_suppkey = wh.s_suppkey""",
    "raw": """SELECT SnapshotInvID, ProductID, ProductName, WarehouseLocation,
        CASE WHEN seed % 20 = 7 THEN NULL
             WHEN seed % 97 = 5 THEN -unitsAvailable - 1
             WHEN seed % 50 = 13 THEN unitsAvailable * 50
             ELSE unitsAvailable END AS unitsAvailable,
        CASE WHEN seed % 20 = 3 THEN NULL
             WHEN seed % 50 = 11 THEN unitsDemanded * 100
             ELSE unitsDemanded END AS unitsDemanded,
        SnapshotDate FROM snap""",
    "products": """SELECT p.p_partkey AS ProductID, p.p_name AS ProductName, p.p_type AS Category,
        p.p_brand AS Supplier, round(p.p_retailprice / 1.25, 2) AS CostPrice,
        p.p_retailprice AS UnitPrice, n.n_name AS WarehouseLocation
        FROM part p LEFT JOIN nation n ON n.n_nationkey = CAST(p.p_partkey % (SELECT count(*) FROM nation) AS INTEGER)""",
    "means": """SELECT ProductID, CAST(sum(CAST(unitsDemanded AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS avg_demand,
        CAST(sum(CAST(unitsAvailable AS DECIMAL(28,10))) AS DOUBLE) / count(*) AS avg_availability FROM raw
        WHERE unitsDemanded IS NOT NULL AND unitsAvailable IS NOT NULL GROUP BY ProductID""",
    "imputed": """SELECT r.SnapshotInvID, r.ProductID, r.ProductName, r.WarehouseLocation,
        coalesce(r.unitsAvailable, m.avg_availability) AS unitsAvailable,
        coalesce(r.unitsDemanded, m.avg_demand) AS unitsDemanded, r.SnapshotDate
        FROM raw r LEFT JOIN means m ON r.ProductID = m.ProductID""",
    "numbered": """SELECT *, row_number() OVER (PARTITION BY ProductID, WarehouseLocation, SnapshotDate
        ORDER BY SnapshotInvID) AS rn FROM imputed""",
    "dedup": """SELECT SnapshotInvID, ProductID, ProductName, WarehouseLocation, unitsAvailable,
        unitsDemanded, SnapshotDate FROM numbered WHERE rn = 1""",
    "pcts": """SELECT percentile_cont(0.99) WITHIN GROUP (ORDER BY unitsDemanded) AS p_d,
        percentile_cont(0.99) WITHIN GROUP (ORDER BY unitsAvailable) AS p_a FROM dedup""",
    "caps": """SELECT CAST(CAST(CAST(p_d AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS DOUBLE) AS cap_d,
        CAST(CAST(CAST(p_a AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS DOUBLE) AS cap_a, p_d, p_a FROM pcts""",
    "capped": """SELECT SnapshotInvID, ProductID, ProductName, WarehouseLocation,
        CASE WHEN unitsAvailable > cap_a THEN cap_a ELSE unitsAvailable END AS unitsAvailable,
        CASE WHEN unitsDemanded > cap_d THEN cap_d ELSE unitsDemanded END AS unitsDemanded,
        SnapshotDate FROM dedup, caps""",
    "clean": """SELECT SnapshotInvID, ProductID, ProductName, WarehouseLocation, SnapshotDate,
        unitsDemanded,
        CASE WHEN unitsAvailable < 0 THEN 0
             WHEN unitsAvailable > unitsDemanded THEN unitsDemanded
             ELSE unitsAvailable END AS unitsAvailable FROM capped""",
    "dim_product": """SELECT CAST(row_number() OVER (ORDER BY ProductID NULLS FIRST,
            ProductName NULLS FIRST, Category NULLS FIRST, Supplier NULLS FIRST,
            UnitPrice NULLS FIRST, CostPrice NULLS FIRST) AS INTEGER) AS ProductKey,
        ProductID, ProductName, Category, Supplier,
        CAST(CAST(UnitPrice AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS UnitPrice, CAST(CAST(CostPrice AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS CostPrice
        FROM (SELECT DISTINCT ProductID, ProductName, Category, Supplier, UnitPrice, CostPrice
              FROM products)""",
    "dim_warehouse": """SELECT CAST(row_number() OVER (ORDER BY WarehouseLocation NULLS FIRST)
        AS INTEGER) AS WarehouseKey, WarehouseLocation
        FROM (SELECT DISTINCT WarehouseLocation FROM clean)""",
    "bounds": """SELECT make_date(CAST(year(min(SnapshotDate)) AS INTEGER), 1, 1) AS lo,
        make_date(CAST(year(max(SnapshotDate)) AS INTEGER), 12, 31) AS hi FROM raw""",
    "days": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds""",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, d AS FullDate,
        CAST(year(d) AS INTEGER) AS Year, CAST(month(d) AS INTEGER) AS Month,
        CAST(day(d) AS INTEGER) AS DayOfMonth, monthname(d) AS MonthName,
        dayname(d) AS DayOfWeekName FROM days""",
    "fact": """SELECT d.DateKey, p.ProductKey, w.WarehouseKey,
        CAST(CAST(c.unitsDemanded AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS unitsDemanded,
        CAST(CAST(c.unitsAvailable AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS unitsAvailable
        FROM clean c JOIN dim_date d ON c.SnapshotDate = d.FullDate
        JOIN dim_product p ON c.ProductID = p.ProductID
        JOIN dim_warehouse w ON c.WarehouseLocation = w.WarehouseLocation""",
}
_CTE_ORDER = list(CTES)


def _needed(body: str) -> list:
    """CTEs the statement refers to, with their own dependencies, in order."""
    need = set()
    frontier = [body]
    while frontier:
        text = frontier.pop()
        for name in _CTE_ORDER:
            if name not in need and _mentions(text, name):
                need.add(name)
                frontier.append(CTES[name])
    return [n for n in _CTE_ORDER if n in need]


def _mentions(text: str, name: str) -> bool:
    import re
    return re.search(rf"(?<![\w.]){name}(?![\w(])", text) is not None


def with_ctes(body: str, extra: dict | None = None) -> str:
    extra = extra or {}
    scan = body + " ".join(extra.values())
    names = _needed(scan)
    parts = [f"{n} AS ({CTES[n]})" for n in names] + [f"{k} AS ({v})" for k, v in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


M6 = "round(unitsAvailable, 6) AS unitsAvailable, round(unitsDemanded, 6) AS unitsDemanded"
INV = "SnapshotInvID, ProductID, ProductName, WarehouseLocation"

BAD_PRED = """SnapshotInvID IS NULL OR SnapshotInvID = 0 OR ProductID IS NULL OR ProductID = 0
    OR ProductName IS NULL OR trim(ProductName) = '' OR WarehouseLocation IS NULL
    OR trim(WarehouseLocation) = '' OR unitsAvailable IS NULL OR unitsDemanded IS NULL
    OR SnapshotDate IS NULL"""

EVENTS_NUMBERED = """SELECT *, CAST(ts AS DATE) AS event_date,
    row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                       ORDER BY event_id) AS rn FROM events"""

ORACLE = {
    "dedup_events": with_ctes(
        "SELECT event_id, ts, user_id, event_type, value, props FROM ev WHERE rn = 1",
        {"ev": EVENTS_NUMBERED}),
    "dup_detect_events": with_ctes(
        """SELECT event_id, user_id, event_type, event_date,
           'This is a duplicate row' AS Status FROM ev WHERE rn > 1""",
        {"ev": EVENTS_NUMBERED}),
    "row_counts": with_ctes(
        """SELECT 'products_table' AS TableName, count(*) AS Total_Records FROM products
           UNION ALL SELECT 'inventory_with_issues', count(*) FROM raw"""),
    "sample_rows": with_ctes("SELECT * FROM raw ORDER BY SnapshotInvID LIMIT 10"),
    "schema_profile": with_ctes(
        """SELECT 'inventory_with_issues' AS TABLE_NAME, c.* FROM (
           SELECT 'SnapshotInvID' AS COLUMN_NAME, 1 AS ORDINAL_POSITION, 'bigint' AS DATA_TYPE,
                  'NO' AS IS_NULLABLE, count(*) - count(SnapshotInvID) AS NULL_COUNT FROM raw
           UNION ALL SELECT 'ProductID', 2, 'bigint', 'YES', count(*) - count(ProductID) FROM raw
           UNION ALL SELECT 'ProductName', 3, 'string', 'YES', count(*) - count(ProductName) FROM raw
           UNION ALL SELECT 'WarehouseLocation', 4, 'string', 'YES',
                  count(*) - count(WarehouseLocation) FROM raw
           UNION ALL SELECT 'unitsAvailable', 5, 'double', 'YES',
                  count(*) - count(unitsAvailable) FROM raw
           UNION ALL SELECT 'unitsDemanded', 6, 'double', 'YES',
                  count(*) - count(unitsDemanded) FROM raw
           UNION ALL SELECT 'SnapshotDate', 7, 'date', 'YES', count(*) - count(SnapshotDate) FROM raw
           ) c"""),
    "dq_bad_rows": with_ctes(f"SELECT * FROM raw WHERE {BAD_PRED}"),
    "dq_bad_rows_products": with_ctes(
        """SELECT * FROM products WHERE ProductID IS NULL OR ProductID = 0
           OR CostPrice IS NULL OR CostPrice = 0 OR UnitPrice IS NULL OR UnitPrice = 0
           OR ProductName IS NULL OR trim(ProductName) = '' OR Category IS NULL
           OR trim(Category) = '' OR Supplier IS NULL OR trim(Supplier) = ''
           OR WarehouseLocation IS NULL OR trim(WarehouseLocation) = ''"""),
    "dq_bad_counts": with_ctes(
        """SELECT
           CAST(SUM(CASE WHEN SnapshotInvID IS NULL OR SnapshotInvID = 0 THEN 1 ELSE 0 END) AS BIGINT) AS Bad_SnapshotInvID,
           CAST(SUM(CASE WHEN ProductID IS NULL OR ProductID = 0 THEN 1 ELSE 0 END) AS BIGINT) AS Bad_ProductID,
           CAST(SUM(CASE WHEN ProductName IS NULL OR trim(ProductName) = '' THEN 1 ELSE 0 END) AS BIGINT) AS Bad_ProductName,
           CAST(SUM(CASE WHEN WarehouseLocation IS NULL OR trim(WarehouseLocation) = '' THEN 1 ELSE 0 END) AS BIGINT) AS Bad_WarehouseLocation,
           CAST(SUM(CASE WHEN unitsAvailable IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS Bad_Availability,
           CAST(SUM(CASE WHEN unitsDemanded IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS Bad_Demand,
           CAST(SUM(CASE WHEN SnapshotDate IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS Bad_SnapshotDate
           FROM raw"""),
    "perturb_nulls": with_ctes(
        f"""SELECT {INV}, unitsAvailable,
           CASE WHEN SnapshotInvID % 20 = 3 THEN NULL ELSE unitsDemanded END AS unitsDemanded,
           SnapshotDate FROM snap"""),
    "perturb_outliers": with_ctes(
        f"""SELECT {INV},
           CASE WHEN SnapshotInvID % 50 = 13 THEN unitsAvailable * 50 ELSE unitsAvailable END
             AS unitsAvailable, unitsDemanded, SnapshotDate FROM snap"""),
    "append_dups": with_ctes(
        """SELECT CAST(row_number() OVER (ORDER BY SnapshotInvID NULLS FIRST, ProductID NULLS FIRST,
             ProductName NULLS FIRST, WarehouseLocation NULLS FIRST, unitsAvailable NULLS FIRST,
             unitsDemanded NULLS FIRST, SnapshotDate NULLS FIRST) AS BIGINT) AS SnapshotInvID,
           ProductID, ProductName, WarehouseLocation, unitsAvailable, unitsDemanded, SnapshotDate
           FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw WHERE SnapshotInvID % 50 = 0)"""),
    "rekey": with_ctes(
        """SELECT CAST(row_number() OVER (ORDER BY ProductID NULLS FIRST,
             WarehouseLocation NULLS FIRST, SnapshotDate NULLS FIRST, SnapshotInvID NULLS FIRST)
             AS BIGINT) AS SnapshotInvID,
           ProductID, ProductName, WarehouseLocation, unitsAvailable, unitsDemanded, SnapshotDate
           FROM raw"""),
    "group_avg_complete_case": with_ctes(
        """SELECT ProductID, round(avg_demand, 6) AS avg_demand,
           round(avg_availability, 6) AS avg_availability FROM means"""),
    "impute_mean_by_group": with_ctes(f"SELECT {INV}, {M6}, SnapshotDate FROM imputed"),
    "null_recheck": with_ctes(
        """SELECT count(*) AS NullCount, 'unitsDemanded' AS ColumnName FROM imputed
             WHERE unitsDemanded IS NULL
           UNION ALL SELECT count(*), 'unitsAvailable' FROM imputed WHERE unitsAvailable IS NULL
           UNION ALL SELECT count(*), 'SnapshotDate' FROM imputed WHERE SnapshotDate IS NULL"""),
    "dup_detect": with_ctes(
        """SELECT SnapshotInvID, ProductID, WarehouseLocation, SnapshotDate,
           'This is a duplicate row' AS Status FROM numbered WHERE rn > 1"""),
    "dedup_keep_first": with_ctes(f"SELECT {INV}, {M6}, SnapshotDate FROM dedup"),
    "dedup_check": with_ctes(
        """SELECT ProductID, WarehouseLocation, SnapshotDate, count(*) AS DuplicateCount
           FROM dedup GROUP BY ProductID, WarehouseLocation, SnapshotDate HAVING count(*) > 1"""),
    "duplicate_keys_raw": with_ctes(
        """SELECT ProductID, WarehouseLocation, SnapshotDate, count(*) AS DuplicateCount
           FROM raw GROUP BY ProductID, WarehouseLocation, SnapshotDate HAVING count(*) > 1"""),
    "percentile_caps": with_ctes(
        """SELECT 'unitsDemanded' AS column_name, round(p_d, 4) AS percentile, cap_d AS cap FROM caps
           UNION ALL SELECT 'unitsAvailable', round(p_a, 4), cap_a FROM caps"""),
    "threshold_messages": with_ctes(
        """SELECT 'Capping Demand at: ' || CAST(CAST(CAST(p_d AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS VARCHAR) AS Status FROM caps
           UNION ALL
           SELECT 'Capping Availability at: ' || CAST(CAST(CAST(p_a AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS VARCHAR) FROM caps"""),
    "cap_outliers": with_ctes(f"SELECT {INV}, {M6}, SnapshotDate FROM capped"),
    "metric_profile": with_ctes(
        """SELECT 'unitsDemanded After Capping' AS Metric, round(min(unitsDemanded), 4) AS MinValue,
             round(max(unitsDemanded), 4) AS MaxValue, round(avg(unitsDemanded), 4) AS AvgValue
           FROM capped
           UNION ALL
           SELECT 'unitsAvailable After Capping', round(min(unitsAvailable), 4),
             round(max(unitsAvailable), 4), round(avg(unitsAvailable), 4) FROM capped"""),
    "rule_violations": with_ctes(
        """SELECT 'Availability > Demand' AS IssueType, count(*) AS IssueCount FROM capped
             WHERE unitsAvailable > unitsDemanded
           UNION ALL
           SELECT 'Negative Availability', count(*) FROM capped WHERE unitsAvailable < 0"""),
    "rule_enforce": with_ctes(
        """SELECT SnapshotInvID, ProductID, ProductName, WarehouseLocation, SnapshotDate,
           round(unitsDemanded, 6) AS unitsDemanded, round(unitsAvailable, 6) AS unitsAvailable
           FROM clean"""),
    "rule_violations_post": with_ctes(
        """SELECT 'Availability > Demand' AS IssueType, count(*) AS IssueCount FROM clean
             WHERE unitsAvailable > unitsDemanded
           UNION ALL
           SELECT 'Negative Availability', count(*) FROM clean WHERE unitsAvailable < 0"""),
    "union_checks": with_ctes(
        """SELECT 'nulls' AS Report, 'unitsDemanded' AS Item, count(*) AS IssueCount FROM clean
             WHERE unitsDemanded IS NULL
           UNION ALL SELECT 'nulls', 'unitsAvailable', count(*) FROM clean WHERE unitsAvailable IS NULL
           UNION ALL SELECT 'nulls', 'SnapshotDate', count(*) FROM clean WHERE SnapshotDate IS NULL
           UNION ALL SELECT 'rules', 'Availability > Demand', count(*) FROM clean
             WHERE unitsAvailable > unitsDemanded
           UNION ALL SELECT 'rules', 'Negative Availability', count(*) FROM clean
             WHERE unitsAvailable < 0
           UNION ALL SELECT 'duplicates', 'business key', count(*) FROM (
             SELECT 1 FROM clean GROUP BY ProductID, WarehouseLocation, SnapshotDate
             HAVING count(*) > 1)"""),
    "dim_product": with_ctes(
        """SELECT ProductKey, ProductID, ProductName, Category, Supplier,
           CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(CostPrice AS DOUBLE) AS CostPrice
           FROM dim_product"""),
    "dim_warehouse": with_ctes("SELECT * FROM dim_warehouse"),
    "dim_date": with_ctes("SELECT * FROM dim_date"),
    "fact_build": with_ctes(
        """SELECT DateKey, ProductKey, WarehouseKey, CAST(unitsDemanded AS DOUBLE) AS unitsDemanded,
           CAST(unitsAvailable AS DOUBLE) AS unitsAvailable FROM fact"""),
    "fact_orphans": with_ctes(
        """SELECT SnapshotInvID, ProductID, WarehouseLocation, SnapshotDate,
             SnapshotDate IS NULL OR SnapshotDate NOT IN (SELECT d FROM odays) AS MissingDate,
             ProductID IS NULL OR ProductID NOT IN (SELECT ProductID FROM dim_product) AS MissingProduct,
             WarehouseLocation IS NULL OR WarehouseLocation NOT IN (SELECT WarehouseLocation FROM dim_warehouse)
               AS MissingWarehouse
           FROM clean
           WHERE (SnapshotDate IS NULL OR SnapshotDate NOT IN (SELECT d FROM odays))
              OR ProductID IS NULL OR ProductID NOT IN (SELECT ProductID FROM dim_product)
              OR WarehouseLocation IS NULL OR WarehouseLocation NOT IN (SELECT WarehouseLocation FROM dim_warehouse)""",
        {"odays": """SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE),
                        CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
                      FROM orders"""}),
    "fact_pk_check": with_ctes(
        """SELECT 'null key' AS "Check", count(*) AS ViolationCount FROM fact
             WHERE DateKey IS NULL OR ProductKey IS NULL OR WarehouseKey IS NULL
           UNION ALL
           SELECT 'duplicate key', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (
             SELECT count(*) AS n FROM fact GROUP BY DateKey, ProductKey, WarehouseKey
             HAVING count(*) > 1)"""),
    "surrogate_key": with_ctes(
        """SELECT CAST(row_number() OVER (ORDER BY ProductID NULLS FIRST,
             WarehouseLocation NULLS FIRST) AS BIGINT) AS SeriesKey, ProductID, WarehouseLocation
           FROM (SELECT DISTINCT ProductID, WarehouseLocation FROM raw)"""),
    "distinct_products": with_ctes("SELECT DISTINCT ProductID, ProductName FROM raw"),
    "distinct_values": with_ctes("SELECT DISTINCT WarehouseLocation FROM raw"),
    "distinct_count": with_ctes(
        """SELECT count(DISTINCT ProductID) AS ProductID_distinct,
           count(DISTINCT WarehouseLocation) AS WarehouseLocation_distinct,
           count(DISTINCT SnapshotDate) AS SnapshotDate_distinct FROM raw"""),
    "enrich_lookup": with_ctes(
        """SELECT r.SnapshotInvID, r.ProductID, r.ProductName, p.Category, p.Supplier, p.UnitPrice,
           r.WarehouseLocation, r.SnapshotDate, r.unitsDemanded
           FROM raw r JOIN products p ON r.ProductID = p.ProductID"""),
    "month_spine": with_ctes(
        """SELECT CAST(unnest(generate_series(min(SnapshotDate), max(SnapshotDate),
             INTERVAL 1 MONTH)) AS DATE) AS Month FROM raw"""),
    "scaffold_gaps": with_ctes(
        """SELECT s.ProductID, s.WarehouseLocation, s.MissingMonth FROM scaf s
           WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.ProductID IS NOT DISTINCT FROM s.ProductID
             AND o.WarehouseLocation IS NOT DISTINCT FROM s.WarehouseLocation
             AND o.m = s.MissingMonth)""",
        {"obs": """SELECT DISTINCT ProductID, WarehouseLocation, SnapshotDate AS m FROM raw
                   WHERE SnapshotDate IS NOT NULL""",
         "spans": """SELECT ProductID, WarehouseLocation, min(m) AS lo, max(m) AS hi FROM obs
                     GROUP BY ProductID, WarehouseLocation""",
         "scaf": """SELECT ProductID, WarehouseLocation,
                      CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS MissingMonth
                    FROM spans"""}),
    "sample_n": with_ctes(
        """SELECT SnapshotInvID, ProductID, ProductName, WarehouseLocation, unitsAvailable,
           unitsDemanded, SnapshotDate FROM raw
           ORDER BY md5('42|' || CAST(SnapshotInvID AS VARCHAR)), SnapshotInvID LIMIT 1000"""),
    "scalar_numeric_date": with_ctes(
        """SELECT SnapshotInvID, CAST(SnapshotDate + INTERVAL 1 DAY AS DATE) AS NextDay,
           CAST(date_diff('day', SnapshotDate, CAST(SnapshotDate + INTERVAL 1 MONTH AS DATE)) AS INTEGER)
             AS DaysInMonth,
           CAST(date_diff('day', DATE '1995-01-01', SnapshotDate) AS INTEGER) AS DaysSinceStart,
           round(unitsDemanded * 1.07, 2) AS DemandWithTax,
           CAST(CAST(CAST(unitsDemanded AS DECIMAL(28,10)) AS DECIMAL(10,2)) AS DOUBLE) AS DemandDecimal,
           CASE WHEN unitsDemanded - unitsAvailable > 0 THEN unitsDemanded - unitsAvailable
                ELSE 0.0 END AS Shortage,
           'P' || CAST(ProductID AS VARCHAR) || '@' || WarehouseLocation AS SeriesLabel
           FROM raw"""),
    "step_audit": with_ctes(
        """SELECT StepNo, Step, lag(RowsOut) OVER (ORDER BY StepNo) AS RowsIn, RowsOut, Message
           FROM (
             SELECT 1 AS StepNo, 'raw' AS Step, count(*) AS RowsOut,
                    'Raw snapshots loaded.' AS Message FROM raw
             UNION ALL SELECT 2, 'imputed', count(*),
                    'NULL demand/availability replaced with per-product means.' FROM imputed
             UNION ALL SELECT 3, 'dedup', count(*), 'Deduplication complete.' FROM dedup
             UNION ALL SELECT 4, 'capped', count(*), 'Outliers capped at the upper percentile.'
                    FROM capped
             UNION ALL SELECT 5, 'clean', count(*), 'Business logic applied.' FROM clean
             UNION ALL SELECT 6, 'dim_product', count(*), 'DimProduct created.' FROM dim_product
             UNION ALL SELECT 7, 'dim_warehouse', count(*), 'DimWarehouse created.'
                    FROM dim_warehouse
             UNION ALL SELECT 8, 'dim_date', count(*), 'DimDate created.' FROM dim_date
             UNION ALL SELECT 9, 'fact', count(*), 'Star schema created.' FROM fact)"""),
    "inventory_end_to_end": with_ctes(
        """SELECT DateKey, ProductKey, WarehouseKey, CAST(unitsDemanded AS DOUBLE) AS unitsDemanded,
           CAST(unitsAvailable AS DOUBLE) AS unitsAvailable FROM fact"""),
    "mart_products_by_category": with_ctes(
        "SELECT Category, count(*) AS ProductCount FROM dim_product GROUP BY Category"),
    "mart_margin": with_ctes(
        """SELECT Category,
           round(avg(CAST(UnitPrice AS DOUBLE) - CAST(CostPrice AS DOUBLE)), 6) AS AvgMargin,
           round(avg((CAST(UnitPrice AS DOUBLE) - CAST(CostPrice AS DOUBLE))
                     / CAST(UnitPrice AS DOUBLE)), 6) AS AvgMarginRate
           FROM dim_product GROUP BY Category"""),
    "mart_supplier": with_ctes(
        """SELECT Supplier, round(CAST(sum(f.unitsDemanded) AS DOUBLE), 4) AS TotalDemand,
           round(CAST(sum(f.unitsAvailable) AS DOUBLE), 4) AS TotalAvailable,
           round(CASE WHEN sum(f.unitsDemanded) <> 0
                 THEN CAST(sum(f.unitsAvailable) AS DOUBLE) / CAST(sum(f.unitsDemanded) AS DOUBLE)
                 END, 4) AS FillRate
           FROM fact f JOIN dim_product p ON f.ProductKey = p.ProductKey GROUP BY Supplier"""),
    "mart_warehouse_month": with_ctes(
        """SELECT w.WarehouseLocation, d.Year, d.Month,
           round(CAST(sum(f.unitsDemanded) AS DOUBLE), 4) AS TotalDemand,
           round(CAST(sum(f.unitsAvailable) AS DOUBLE), 4) AS TotalAvailable
           FROM fact f JOIN dim_warehouse w ON f.WarehouseKey = w.WarehouseKey
           JOIN dim_date d ON f.DateKey = d.DateKey
           GROUP BY w.WarehouseLocation, d.Year, d.Month"""),
    "csv_roundtrip": with_ctes("SELECT * FROM products"),
}

# --- loads into standing tables ---------------------------------------------

ARRIVED = {
    "arrived": f"""SELECT li.l_partkey AS ProductID, p.p_name AS ProductName, wh.WarehouseLocation,
        CASE WHEN seed % 20 = 7 THEN NULL WHEN seed % 97 = 5 THEN -a - 1 WHEN seed % 50 = 13 THEN a * 50 ELSE a END AS unitsAvailable,
        CASE WHEN seed % 20 = 3 THEN NULL WHEN seed % 50 = 11 THEN q * 100 ELSE q END AS unitsDemanded,
        CAST(date_trunc('month', l_shipdate) AS DATE) AS SnapshotDate,
        CAST(CASE WHEN year(l_shipdate) <= 1996 THEN 1 WHEN year(l_shipdate) <= 1998 THEN 2 WHEN year(l_shipdate) <= 2000 THEN 3 ELSE 4 END
          + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS INTEGER) AS Delivery,
        CAST(strftime(date_trunc('month', l_shipdate), '%Y%m%d') AS INTEGER) AS DateKey, l_linestatus = 'O' AS is_open, rid
        FROM (SELECT *, l_orderkey * 7 + l_linenumber * 13 + l_partkey * 3 + l_suppkey AS seed, CAST(l_quantity AS DOUBLE) AS q,
              CAST(greatest(0.0, l_quantity - (l_orderkey % 51)) AS DOUBLE) AS a, row_number() OVER (ORDER BY {_ORDER}) AS rid FROM lineitem) li
        LEFT JOIN part p ON li.l_partkey = p.p_partkey LEFT JOIN wh ON li.l_suppkey = wh.s_suppkey""",
}
SNAPSHOT_COLUMNS = "ProductID, ProductName, WarehouseLocation, unitsAvailable, unitsDemanded, SnapshotDate, Delivery, DateKey"
_FIRST = "row_number() OVER (PARTITION BY ProductID, WarehouseLocation, SnapshotDate ORDER BY {} rid) AS rn"

ORACLE.update({
    "stable_keys": with_ctes(
        """SELECT CAST(row_number() OVER (ORDER BY y, ProductID, WarehouseLocation NULLS FIRST) AS BIGINT) AS SeriesKey,
             ProductID, WarehouseLocation, dense_rank() OVER (ORDER BY y) AS FirstLoad
           FROM (SELECT ProductID, WarehouseLocation, min(load) AS y FROM (
             SELECT l_partkey AS ProductID, WarehouseLocation, dense_rank() OVER (ORDER BY year(o_orderdate) NULLS LAST) AS load
             FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN wh ON l_suppkey = s_suppkey)
             GROUP BY ProductID, WarehouseLocation)"""),
    "incremental_load": with_ctes(
        f"SELECT {SNAPSHOT_COLUMNS} FROM (SELECT *, {_FIRST.format('Delivery,')} FROM arrived) WHERE rn = 1", ARRIVED),
    "merge_snapshots": with_ctes(
        """SELECT coalesce(o.ProductID, n.ProductID) AS ProductID, CASE WHEN o.rn IS NULL THEN n.ProductName ELSE o.ProductName END AS ProductName,
             CASE WHEN o.rn IS NULL THEN n.WarehouseLocation ELSE o.WarehouseLocation END AS WarehouseLocation,
             CASE WHEN n.rn IS NULL THEN o.unitsAvailable ELSE n.unitsAvailable END AS unitsAvailable,
             CASE WHEN n.rn IS NULL THEN o.unitsDemanded ELSE n.unitsDemanded END AS unitsDemanded,
             coalesce(o.SnapshotDate, n.SnapshotDate) AS SnapshotDate,
             CASE WHEN n.rn IS NULL THEN o.Delivery ELSE n.Delivery END AS Delivery, coalesce(o.DateKey, n.DateKey) AS DateKey
           FROM (SELECT * FROM firsts WHERE NOT is_open) o FULL JOIN (SELECT * FROM firsts WHERE is_open) n
             ON o.ProductID = n.ProductID AND o.WarehouseLocation IS NOT DISTINCT FROM n.WarehouseLocation AND o.SnapshotDate = n.SnapshotDate
           WHERE NOT coalesce(n.unitsDemanded >= 45, false) AND CASE WHEN n.rn IS NULL THEN o.unitsDemanded ELSE n.unitsDemanded END IS NOT NULL""",
        {**ARRIVED, "firsts": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY is_open, ProductID, WarehouseLocation, SnapshotDate ORDER BY rid) AS rn FROM arrived) WHERE rn = 1"}),
})

# --- analytics ----------------------------------------------------------------

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_SHIPPED = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
LOCATED = {"located": f"SELECT {_ORDER}, WarehouseLocation FROM lineitem LEFT JOIN wh ON l_suppkey = s_suppkey"}
SALES = {**LOCATED, "sales": """SELECT p_type AS Category, WarehouseLocation, CAST(year(l_shipdate) AS INTEGER) AS Year, l_quantity, l_extendedprice
  FROM located LEFT JOIN part ON l_partkey = p_partkey"""}


def _measure(alias: str, column: str) -> str:
    total = f"CAST(sum(CAST({column} AS DECIMAL(28,10))) AS DOUBLE)"
    return (f"{total} AS {alias}_sum, count({column}) AS {alias}_count, min({column}) AS {alias}_min, max({column}) AS {alias}_max, "
            f"{total} / nullif(count({column}), 0) AS {alias}_avg")


ORACLE.update({
    "asof_returns": with_ctes(
        f"""SELECT {_ORDER}, WarehouseLocation, m.l_shipdate AS matched_at, m.l_orderkey AS return_order, m.l_linenumber AS return_line, m.l_quantity AS return_quantity
            FROM (SELECT *, CASE WHEN WarehouseLocation IS NULL OR l_shipdate IS NULL THEN NULL ELSE
                    last_value(r IGNORE NULLS) OVER (PARTITION BY WarehouseLocation ORDER BY l_shipdate, side, {_ORDER}) END AS m
                  FROM (SELECT located.*, 1 AS side, NULL AS r FROM located
                        UNION ALL SELECT located.*, 0, struct_pack(l_shipdate := l_shipdate, l_orderkey := l_orderkey, l_linenumber := l_linenumber, l_quantity := l_quantity)
                        FROM located WHERE l_returnflag = 'R' AND WarehouseLocation IS NOT NULL AND l_shipdate IS NOT NULL)) WHERE side = 1""", LOCATED),
    "asof_errors": """SELECT event_id, ts, user_id, event_type, CASE WHEN ts - m.ts < INTERVAL 1 DAY THEN m.ts END AS matched_at,
          CASE WHEN ts - m.ts < INTERVAL 1 DAY THEN m.event_id END AS error_id
        FROM (SELECT *, last_value(r IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, side, event_id) AS m
              FROM (SELECT event_id, ts, user_id, event_type, 0 AS side, NULL AS r FROM events
                    UNION ALL SELECT event_id, ts, user_id, event_type, 1, struct_pack(ts := ts, event_id := event_id) FROM events WHERE event_type = 'error')) WHERE side = 0""",
    "order_overlaps": """WITH p AS (SELECT o_custkey AS cust, o_orderkey AS o, CAST(o_orderdate AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi
          FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
        SELECT a.cust, a.o AS order_a, b.o AS order_b, CAST(least(a.hi, b.hi) - greatest(a.lo, b.lo) + 1 AS BIGINT) AS days
        FROM p a JOIN p b ON a.cust = b.cust AND a.o < b.o AND a.lo <= b.hi AND b.lo <= a.hi WHERE a.lo <= a.hi AND b.lo <= b.hi""",
    "running_totals": f"""SELECT {_LINE}, l_returnflag, row_number() OVER w AS position, CAST(sum(CAST(l_quantity AS DECIMAL(28,10))) OVER w AS DOUBLE) AS units,
          CAST(sum(CAST(l_extendedprice AS DECIMAL(28,10))) OVER w AS DOUBLE) AS sales
        FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY {_SHIPPED} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "moving_frames": f"""SELECT {_LINE}, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY {_SHIPPED}) AS position,
          CAST(sum(CAST(l_quantity AS DECIMAL(28,10))) OVER w AS DOUBLE) / nullif(count(l_quantity) OVER w, 0) AS units_mean,
          min(l_extendedprice) OVER w AS price_min, max(l_extendedprice) OVER w AS price_max
        FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY {_SHIPPED} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "global_ranks": f"""SELECT {_LINE}, l_quantity, row_number() OVER (ORDER BY l_quantity, {_ORDER}) AS row_number, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank,
          percent_rank() OVER w AS percent_rank, ntile(100) OVER (ORDER BY l_quantity, {_ORDER}) AS ntile FROM lineitem WINDOW w AS (ORDER BY l_quantity)""",
    "sales_cube": with_ctes(
        f"""SELECT Category, WarehouseLocation, Year, CAST(GROUPING_ID(Category, WarehouseLocation, Year) AS INTEGER) AS grouping_id, count(*) AS n_rows,
            {_measure('units', 'l_quantity')}, {_measure('sales', 'l_extendedprice')} FROM sales GROUP BY CUBE (Category, WarehouseLocation, Year)""", SALES),
    "sales_rollup": with_ctes(
        f"""SELECT Year, WarehouseLocation, Category, CAST(GROUPING_ID(Year, WarehouseLocation, Category) AS INTEGER) AS grouping_id, count(*) AS n_rows,
            {_measure('sales', 'l_extendedprice')} FROM sales GROUP BY ROLLUP (Year, WarehouseLocation, Category)""", SALES),
    "distinct_by_group": """SELECT l_returnflag, count(DISTINCT l_partkey) AS n_products, count(DISTINCT l_suppkey) AS n_suppliers, count(DISTINCT l_orderkey) AS n_orders,
          count(DISTINCT l_shipdate) AS n_ship_days FROM lineitem GROUP BY l_returnflag""",
    "sketch_accuracy": with_ctes(
        """SELECT WarehouseLocation, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_products, TRUE AS products_close, TRUE AS median_close, TRUE AS q90_close
           FROM located GROUP BY WarehouseLocation""", LOCATED),
    "props_typed": """SELECT event_id, event_type, CAST(nullif(regexp_extract(props, '"k": *(-?[0-9]+)', 1), '') AS BIGINT) AS k FROM events""",
    "props_drift": """SELECT 'k' AS key, 'bigint' AS declared, count(*) FILTER (WHERE props LIKE '%"k":%') AS n_rows, CAST(0 AS BIGINT) AS n_misfits FROM events""",
})

ORACLE.update({
    "catalog_load": """SELECT p_partkey::VARCHAR AS ProductID, p_name AS ProductName, p_type AS Category,
          CASE WHEN p_size > 45 THEN round(p_retailprice / 1.25, 2)::VARCHAR ELSE CAST(round(p_retailprice / 1.25, 2) AS DECIMAL(10,2))::VARCHAR END AS CostPrice,
          CASE WHEN p_size > 45 THEN 'size ' || p_size ELSE p_size::VARCHAR END AS Size, CASE WHEN p_size > 45 THEN 'rejected' ELSE 'loaded' END AS Status FROM part
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, 'SourceMissing'""",
    "stream_dedup": """SELECT event_id, ts, user_id, event_type, value, props, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS DateKey
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS rn FROM events) WHERE rn = 1""",
})
