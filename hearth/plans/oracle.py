"""DuckDB oracle: an independent SQL formulation of every catalogue query.

The SQL starts from the driver tables directly (e.g. prices from
``CAST(l_extendedprice AS DECIMAL(18,2))``, not from the formatted text), so
the Spark string-cleaning path is really tested.  Averages of decimals are
computed exactly with integer arithmetic (DuckDB's decimal AVG is DOUBLE)
and rounded HALF_UP like Spark.
"""

from __future__ import annotations

from hearth.plans import catalog as cat
from hearth.sources import standins as st


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def avg6(c: str) -> str:
    """Exact AVG of a non-negative decimal(18,2), HALF_UP at 6 decimals."""
    return (f"CAST(CAST((2 * CAST(SUM({c}) * 100 AS HUGEINT) * 10000 + COUNT({c})) "
            f"// (2 * COUNT({c})) AS DECIMAL(38,0)) * CAST(0.000001 AS DECIMAL(7,6)) "
            f"AS DECIMAL(22,6))")


def avg2(c: str) -> str:
    """Exact AVG of a non-negative decimal(18,2), HALF_UP at 2 decimals."""
    return (f"CAST(CAST((2 * CAST(SUM({c}) * 100 AS HUGEINT) + COUNT({c})) "
            f"// (2 * COUNT({c})) AS DECIMAL(38,0)) * CAST(0.01 AS DECIMAL(3,2)) "
            f"AS DECIMAL(20,2))")


RUN_TS = f"TIMESTAMP '{st.RUN_TS}'"
RUN_DATE = f"DATE '{st.RUN_DATE}'"

# ---------------------------------------------------------------------------------------------
# sales
# ---------------------------------------------------------------------------------------------
SILVER_SALES = f"""
silver_sales AS (
  SELECT * EXCLUDE (language), {RUN_TS} AS LoadTimestamp, 'PPR' AS SourceSystem FROM (
    SELECT DISTINCT
      v.copy = 2 AND l.l_orderkey % 100 = 0 AND p.p_type = 'PROMO' AS language,
      CASE WHEN l.l_orderkey % 83 <> 0
           THEN CAST(o.o_orderdate + INTERVAL 15 YEAR AS DATE) END AS SaleDate,
      c.c_name AS Address,
      n.n_name AS County,
      p.p_brand AS Eircode,
      CASE WHEN l.l_orderkey % 97 <> 0
           THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS SalePrice,
      CASE WHEN l.l_returnflag = 'R' THEN 'No' ELSE 'Yes' END AS IsFullMarketPrice,
      CASE WHEN l.l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS IsVATExclusive,
      CASE WHEN p.p_type = 'PROMO' THEN 'Second-Hand Dwelling house /Apartment'
           WHEN p.p_type = 'SMALL' THEN 'New Dwelling house /Apartment'
           ELSE p.p_type END AS PropertyType,
      CASE WHEN p.p_size < 10 THEN {_q(st.SIZE_SMALL)}
           WHEN p.p_size < 30 THEN {_q(st.SIZE_MEDIUM)}
           ELSE {_q(st.SIZE_LARGE)} END AS PropertySizeCategory
    FROM lineitem l
    JOIN (VALUES (1), (2)) v(copy) ON v.copy = 1 OR l.l_orderkey % 50 = 0
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
    LEFT JOIN part p ON l.l_partkey = p.p_partkey
  ) d
)"""

GOLD_SALES = SILVER_SALES + """,
gold_sales AS (
  SELECT SaleDate, County, PropertyType, PropertySizeCategory,
         CASE WHEN IsVATExclusive = 'Yes' THEN 'VAT Exclusive' ELSE 'VAT Inclusive' END AS SaleType,
         SalePrice, IsFullMarketPrice, Eircode, Address, LoadTimestamp, SourceSystem
  FROM silver_sales
)"""

DIM_DATE = """
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS DateKey, CAST(d AS DATE) AS FullDate,
         CAST(year(d) AS INTEGER) AS Year, CAST(quarter(d) AS INTEGER) AS Quarter,
         CAST(month(d) AS INTEGER) AS Month, strftime(d, '%B') AS MonthName
  FROM generate_series(DATE '2010-01-01', DATE '2030-12-31', INTERVAL 1 DAY) t(d)
)"""


def _value_dim(key: str, name: str, src: str) -> str:
    return f"""
SELECT 0 AS {key}, 'Not recorded' AS {name}
UNION ALL
SELECT CAST(row_number() OVER (ORDER BY v) AS INTEGER), v
FROM (SELECT DISTINCT {src} AS v FROM gold_sales WHERE {src} IS NOT NULL) x"""


STAR_SALES = GOLD_SALES + "," + DIM_DATE + f""",
dim_county AS ({_value_dim('CountyKey', 'CountyName', 'County')}),
dim_property_type AS ({_value_dim('PropertyTypeKey', 'PropertyType', 'PropertyType')}),
dim_sale_type AS ({_value_dim('SaleTypeKey', 'SaleType', 'SaleType')}),
fact_sales AS (
  SELECT COALESCE(d.DateKey, 0) AS DateKey, COALESCE(c.CountyKey, 0) AS CountyKey,
         COALESCE(t.PropertyTypeKey, 0) AS PropertyTypeKey,
         COALESCE(s.SaleTypeKey, 0) AS SaleTypeKey,
         g.Address, g.Eircode, g.SalePrice, g.IsFullMarketPrice, g.LoadTimestamp,
         g.SaleDate, g.County, g.PropertyType, g.SaleType, g.PropertySizeCategory
  FROM gold_sales g
  LEFT JOIN dim_date d ON g.SaleDate = d.FullDate
  LEFT JOIN dim_county c ON g.County = c.CountyName
  LEFT JOIN dim_property_type t ON g.PropertyType = t.PropertyType
  LEFT JOIN dim_sale_type s ON g.SaleType = s.SaleType
)"""


def _metrics(by: str, sel: str, avg: str, count_name: str = "SalesCount",
             src: str = "gold_sales") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{sel}, " if sel else ""
    return f"""WITH {GOLD_SALES}
SELECT {lead}COUNT(*) AS {count_name}, {avg} AS AverageSalePrice,
       MIN(SalePrice) AS MinimumSalePrice, MAX(SalePrice) AS MaximumSalePrice
FROM {src} {group}"""


SQL: dict[str, str] = {}

SQL["silver_sales_clean"] = f"WITH {SILVER_SALES} SELECT * FROM silver_sales"
SQL["gold_sales"] = f"WITH {GOLD_SALES} SELECT * FROM gold_sales"
SQL["metrics_county"] = _metrics("County", "County", avg2("SalePrice"))
SQL["metrics_year"] = _metrics("year(SaleDate)", "CAST(year(SaleDate) AS INTEGER) AS SaleYear",
                               avg6("SalePrice"))
SQL["metrics_county_year"] = _metrics(
    "County, year(SaleDate)", "County, CAST(year(SaleDate) AS INTEGER) AS SaleYear",
    avg6("SalePrice"))
SQL["metrics_type"] = _metrics("PropertyType", "PropertyType", avg6("SalePrice"))
SQL["market_summary"] = _metrics("", "", avg6("SalePrice"), count_name="TotalSales")
SQL["count_by_flag"] = f"""WITH {SILVER_SALES}
SELECT IsFullMarketPrice, COUNT(*) AS RowCount FROM silver_sales GROUP BY IsFullMarketPrice"""
SQL["distinct_values"] = f"""WITH {GOLD_SALES}
SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT County FROM gold_sales)) AS Counties,
       (SELECT COUNT(*) FROM (SELECT DISTINCT PropertyType FROM gold_sales)) AS PropertyTypes"""
SQL["table_totals"] = f"""WITH {STAR_SALES}
SELECT 'silver_sales' AS TableName, COUNT(*) AS RowCount, MIN(LoadTimestamp) AS MinLoadTimestamp,
       MAX(LoadTimestamp) AS MaxLoadTimestamp FROM silver_sales
UNION ALL SELECT 'gold_sales', COUNT(*), MIN(LoadTimestamp), MAX(LoadTimestamp) FROM gold_sales
UNION ALL SELECT 'fact_property_sales', COUNT(*), MIN(LoadTimestamp), MAX(LoadTimestamp)
FROM fact_sales"""
SQL["dim_county"] = f"WITH {STAR_SALES} SELECT * FROM dim_county"
SQL["dim_property_type"] = f"WITH {STAR_SALES} SELECT * FROM dim_property_type"
SQL["dim_sale_type"] = f"WITH {STAR_SALES} SELECT * FROM dim_sale_type"
SQL["dim_date"] = f"""WITH {GOLD_SALES}, {DIM_DATE},
per_day AS (SELECT SaleDate, COUNT(*) AS SalesCount FROM gold_sales GROUP BY SaleDate)
SELECT d.*, COALESCE(p.SalesCount, 0) AS SalesCount
FROM dim_date d LEFT JOIN per_day p ON d.FullDate = p.SaleDate"""
SQL["fact_sales"] = f"""WITH {STAR_SALES}
SELECT CAST(row_number() OVER (PARTITION BY SaleDate, Address, County, Eircode, SalePrice,
                               IsFullMarketPrice, PropertyType, PropertySizeCategory, SaleType)
            AS INTEGER) AS PropertySaleOrdinal,
       DateKey, CountyKey, PropertyTypeKey, SaleTypeKey, Address, Eircode, SalePrice,
       IsFullMarketPrice, LoadTimestamp FROM fact_sales"""
SQL["fact_market_metrics"] = f"""WITH {STAR_SALES}
SELECT DateKey, CountyKey, COUNT(*) AS SalesCount,
       CAST({avg2('SalePrice')} AS DECIMAL(18,2)) AS AverageSalePrice,
       MIN(SalePrice) AS MinimumSalePrice, MAX(SalePrice) AS MaximumSalePrice
FROM fact_sales GROUP BY DateKey, CountyKey"""
SQL["star_sales_by_county_year"] = f"""WITH {STAR_SALES}
SELECT c.CountyName, d.Year, COUNT(*) AS SalesCount, SUM(f.SalePrice) AS TotalSales
FROM fact_sales f LEFT JOIN dim_county c ON f.CountyKey = c.CountyKey
LEFT JOIN dim_date d ON f.DateKey = d.DateKey GROUP BY c.CountyName, d.Year"""
SQL["kpi_sales"] = f"""WITH {STAR_SALES}
SELECT SUM(SalePrice) AS TotalSales, COUNT(*) AS SalesCount,
       {avg6('SalePrice')} AS AverageSalePrice,
       median(CAST(SalePrice AS DOUBLE)) AS MedianSalePrice,
       MAX(LoadTimestamp) AS DataLastUpdated FROM fact_sales"""
SQL["price_by_county"] = f"""WITH {STAR_SALES}
SELECT c.CountyName, {avg2('f.SalePrice')} AS AverageSalePrice
FROM fact_sales f LEFT JOIN dim_county c ON f.CountyKey = c.CountyKey GROUP BY c.CountyName"""
SQL["price_by_year"] = f"""WITH {STAR_SALES}
SELECT d.Year, {avg2('f.SalePrice')} AS AverageSalePrice
FROM fact_sales f LEFT JOIN dim_date d ON f.DateKey = d.DateKey GROUP BY d.Year"""
SQL["slicer_values"] = f"""WITH {GOLD_SALES}
SELECT DISTINCT 'County' AS Slicer, County AS Value FROM gold_sales WHERE County IS NOT NULL
UNION ALL
SELECT DISTINCT 'IsFullMarketPrice', IsFullMarketPrice FROM gold_sales
WHERE IsFullMarketPrice IS NOT NULL"""
SQL["ordered_months"] = f"""WITH {GOLD_SALES}
SELECT CAST(month(SaleDate) AS INTEGER) AS Month, strftime(SaleDate, '%B') AS MonthName,
       COUNT(*) AS SalesCount FROM gold_sales GROUP BY 1, 2"""
SQL["business_rules"] = f"""WITH {SILVER_SALES}, r AS (
  SELECT COUNT(*) AS RowCount, COUNT(*) FILTER (WHERE SaleDate IS NULL) AS MissingSaleDate,
         COUNT(*) FILTER (WHERE SalePrice IS NULL) AS MissingSalePrice,
         COUNT(*) FILTER (WHERE SalePrice <= 0) AS NonPositivePrice FROM silver_sales)
SELECT 'RowCount' AS Rule, RowCount AS Rows FROM r
UNION ALL SELECT 'MissingSaleDate', MissingSaleDate FROM r
UNION ALL SELECT 'MissingSalePrice', MissingSalePrice FROM r
UNION ALL SELECT 'NonPositivePrice', NonPositivePrice FROM r"""
SQL["null_counts"] = f"""WITH {SILVER_SALES}
SELECT 'SaleDate' AS ColumnName, COUNT(*) FILTER (WHERE SaleDate IS NULL) AS NullCount FROM silver_sales
UNION ALL SELECT 'SalePrice', COUNT(*) FILTER (WHERE SalePrice IS NULL) FROM silver_sales
UNION ALL SELECT 'County', COUNT(*) FILTER (WHERE County IS NULL) FROM silver_sales
UNION ALL SELECT 'Address', COUNT(*) FILTER (WHERE Address IS NULL) FROM silver_sales
UNION ALL SELECT 'Eircode', COUNT(*) FILTER (WHERE Eircode IS NULL) FROM silver_sales"""
SQL["duplicate_keys"] = f"""WITH {GOLD_SALES}
SELECT Address, SaleDate, COUNT(*) AS DuplicateCount FROM gold_sales
GROUP BY Address, SaleDate HAVING COUNT(*) > 1"""

# ---------------------------------------------------------------------------------------------
# vacancy
# ---------------------------------------------------------------------------------------------
CUBE_LONG = """
agg AS (
  SELECT CAST(year(o.o_orderdate) * 10 + quarter(o.o_orderdate) AS VARCHAR) AS QuarterCode,
         CAST(year(o.o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o.o_orderdate) AS VARCHAR) AS Quarter,
         CAST(n.n_nationkey AS VARCHAR) AS LocalAuthorityCode, n.n_name AS LocalAuthority,
         n.n_regionkey AS RegionKey,
         COUNT(*) FILTER (WHERE o.o_orderstatus = 'F') AS vacant, COUNT(*) AS stock
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY ALL
),
stats(StatisticCode, Statistic, Unit) AS (
  VALUES ('VAC14C01', 'Vacant dwellings', 'Number'), ('VAC14C02', 'Dwelling stock', 'Number'),
         ('VAC14C03', 'Vacancy rate', '%')
),
quarters AS (SELECT DISTINCT RegionKey, QuarterCode, Quarter FROM agg),
authorities AS (SELECT DISTINCT RegionKey, LocalAuthorityCode, LocalAuthority FROM agg),
silver_vacancy AS (
  SELECT s.StatisticCode, s.Statistic, q.QuarterCode, q.Quarter, a.LocalAuthorityCode,
         a.LocalAuthority, s.Unit,
         CASE s.StatisticCode WHEN 'VAC14C01' THEN CAST(g.vacant AS DOUBLE)
                              WHEN 'VAC14C02' THEN CAST(g.stock AS DOUBLE)
                              ELSE round(g.vacant * 100.0 / g.stock, 1) END AS Value,
         TIMESTAMP '2024-06-30 00:00:00' AS SourceUpdatedTimestamp,
         """ + RUN_DATE + """ AS LoadDate, """ + RUN_TS + """ AS IngestedTimestamp,
         q.RegionKey
  FROM quarters q JOIN authorities a ON q.RegionKey = a.RegionKey
  CROSS JOIN stats s
  LEFT JOIN agg g ON g.QuarterCode = q.QuarterCode AND g.LocalAuthorityCode = a.LocalAuthorityCode
)"""

VAC_MEASURES = CUBE_LONG + """,
la AS (
  SELECT QuarterCode, Quarter, LocalAuthorityCode, LocalAuthority, SourceUpdatedTimestamp, LoadDate,
         CAST(MAX(Value) FILTER (WHERE StatisticCode = 'VAC14C01') AS BIGINT) AS VacantDwellings,
         CAST(MAX(Value) FILTER (WHERE StatisticCode = 'VAC14C02') AS BIGINT) AS DwellingStock,
         MAX(Value) FILTER (WHERE StatisticCode = 'VAC14C03') AS ReportedVacancyRate
  FROM silver_vacancy GROUP BY ALL
),
county_map AS (
  SELECT n.n_name AS LocalAuthority, f.County FROM nation n
  LEFT JOIN (SELECT n_regionkey, arg_min(n_name, n_nationkey) AS County FROM nation
             GROUP BY n_regionkey) f ON n.n_regionkey = f.n_regionkey
),
gold_vacancy AS (
  SELECT QuarterCode, Quarter,
         make_date(CAST(substr(Quarter, 1, 4) AS INTEGER),
                   (CAST(substr(Quarter, 6, 1) AS INTEGER) - 1) * 3 + 1, 1) AS QuarterStartDate,
         CAST(substr(Quarter, 1, 4) AS INTEGER) AS Year,
         CAST(substr(Quarter, 6, 1) AS INTEGER) AS QuarterNumber,
         County, VacantDwellings, DwellingStock,
         round(VacantDwellings * 100.0 / NULLIF(DwellingStock, 0), 1) AS VacancyRate,
         SourceUpdatedTimestamp, LoadDate, """ + RUN_TS + """ AS GoldLoadTimestamp
  FROM (
    SELECT l.QuarterCode, l.Quarter,
           COALESCE(m.County, regexp_replace(l.LocalAuthority, ' County Council$', '')) AS County,
           SUM(l.VacantDwellings) AS VacantDwellings, SUM(l.DwellingStock) AS DwellingStock,
           MAX(l.SourceUpdatedTimestamp) AS SourceUpdatedTimestamp, MAX(l.LoadDate) AS LoadDate
    FROM la l LEFT JOIN county_map m ON l.LocalAuthority = m.LocalAuthority
    GROUP BY 1, 2, 3
  ) r
),
dim_quarter AS (
  SELECT DISTINCT CAST(QuarterCode AS INTEGER) AS QuarterKey, Quarter, QuarterStartDate, Year,
         QuarterNumber FROM gold_vacancy
)"""

FACT_VACANCY = """fact_vacancy AS (
  SELECT CAST(CAST(g.QuarterCode AS INTEGER) AS BIGINT) * 100 + c.CountyKey AS HousingVacancyKey,
         CAST(g.QuarterCode AS INTEGER) AS QuarterKey, c.CountyKey,
         g.VacantDwellings, g.DwellingStock, CAST(g.VacancyRate AS DECIMAL(5,1)) AS VacancyRate,
         g.SourceUpdatedTimestamp, g.LoadDate, g.GoldLoadTimestamp AS LoadTimestamp
  FROM gold_vacancy g LEFT JOIN dim_county c ON g.County = c.CountyName
)"""

VAC_STAR = VAC_MEASURES + """,
dim_county AS (
  SELECT 0 AS CountyKey, 'Not recorded' AS CountyName
  UNION ALL
  SELECT CAST(row_number() OVER (ORDER BY County) AS INTEGER), County
  FROM (SELECT DISTINCT County FROM gold_vacancy WHERE County IS NOT NULL) x
),
""" + FACT_VACANCY + """,
vstar AS (
  SELECT f.*, q.Quarter, q.Year, c.CountyName FROM fact_vacancy f
  LEFT JOIN dim_quarter q ON f.QuarterKey = q.QuarterKey
  LEFT JOIN dim_county c ON f.CountyKey = c.CountyKey
)"""

SEL_Q = ", ".join(_q(q) for q in cat.SELECTED_QUARTERS)
RATE = "CAST(SUM(VacantDwellings) AS DOUBLE) / NULLIF(CAST(SUM(DwellingStock) AS DOUBLE), 0)"

SQL["cube_flatten"] = f"""WITH {CUBE_LONG}
SELECT StatisticCode, Statistic, QuarterCode, Quarter, LocalAuthorityCode, LocalAuthority, Unit,
       Value, SourceUpdatedTimestamp, LoadDate, IngestedTimestamp FROM silver_vacancy"""
SQL["cube_validate"] = f"""WITH {CUBE_LONG}, cells AS (
  SELECT RegionKey, CAST(3 * COUNT(DISTINCT QuarterCode) * COUNT(DISTINCT LocalAuthorityCode) AS BIGINT)
         AS ExpectedCells, CAST(COUNT(*) * 3 AS BIGINT) AS ValueCount
  FROM (SELECT DISTINCT RegionKey, QuarterCode, LocalAuthorityCode FROM silver_vacancy) x
  GROUP BY RegionKey)
SELECT RegionKey, ExpectedCells, ValueCount, TRUE AS IsValid FROM cells
UNION ALL
SELECT RegionKey + 100, ExpectedCells, ValueCount - 1, FALSE FROM cells WHERE RegionKey = 0"""


def _cubes() -> str:
    """Cells of the cubes by 2, 3 and 4 dimensions, straight from the orders."""
    ids = ("STATUS", "TLIST(A1)", "PRIORITY", "SEGMENT")
    fine = """fine AS (
  SELECT n.n_regionkey AS region, o.o_orderstatus AS c0, 'Status ' || o.o_orderstatus AS l0,
         CAST(year(o.o_orderdate) AS VARCHAR) AS c1, 'Year ' || CAST(year(o.o_orderdate) AS VARCHAR) AS l1,
         substr(o.o_orderpriority, 1, 1) AS c2, o.o_orderpriority AS l2,
         c.c_mktsegment AS c3, lower(c.c_mktsegment) AS l3
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""
    axes = [f"""axis{i} AS (
  SELECT region, c{i}, l{i}, row_number() OVER (PARTITION BY region ORDER BY c{i}) - 1 AS at{i},
         COUNT(*) OVER (PARTITION BY region) AS size{i}
  FROM (SELECT DISTINCT region, c{i}, l{i} FROM fine) x)""" for i in range(4)]
    parts = []
    for k in (2, 3, 4):
        join = " ".join(f"JOIN axis{i} USING (region)" for i in range(1, k))
        on = " AND ".join(f"a.c{i} = v.c{i}" for i in range(k))
        codes = " || '|' || ".join(f"'{ids[i]}=' || a.c{i}" for i in range(k))
        labels = " || '|' || ".join(f"'{ids[i]}: ' || a.l{i}" for i in range(k))
        place = " + ".join(" * ".join([f"at{i}", *[f"size{j}" for j in range(i + 1, k)]])
                           for i in range(k))
        columns = ", ".join(f"a.c{i} AS c{i}, a.l{i} AS l{i}" if i < k else
                            f"NULL AS c{i}, NULL AS l{i}" for i in range(4))
        group = ", ".join(f"c{i}" for i in range(k))
        size = " * ".join(f"size{i}" for i in range(k))
        parts.append(f"""SELECT '{k}-' || CAST(a.region AS VARCHAR) AS Document,
         CAST({place} AS BIGINT) AS Position, {codes} AS Codes, {labels} AS Labels,
         CAST(v.n AS DOUBLE) AS Value, {columns}, CAST({size} AS BIGINT) AS cells,
         (a.region + {k}) % 2 = 0 AS sparse, a.size0
  FROM (SELECT * FROM axis0 {join}) a
  LEFT JOIN (SELECT region, {group}, COUNT(*) AS n FROM fine GROUP BY ALL) v
       ON a.region = v.region AND {on}""")
    return ",\n".join([fine, *axes, "cubes AS (\n  " + "\n  UNION ALL ".join(parts) + ")"])


SQL["cube_any_dimensions"] = f"""WITH {_cubes()}
SELECT Document, '2024-06-30T00:00:00.000Z' AS Updated, Position, Codes, Labels, 'Orders' AS Unit, Value
FROM cubes"""
SQL["cube_present_cells"] = f"""WITH {_cubes()}
SELECT Document, c0 AS StatusCode, l0 AS Status, c1 AS YearCode, l1 AS Year, c2 AS PriorityCode,
       l2 AS Priority, c3 AS SegmentCode, l3 AS Segment, 'Orders' AS Unit, Value
FROM cubes WHERE Value IS NOT NULL"""
SQL["cube_problems"] = f"""WITH {_cubes()},
documents AS (
  SELECT Document, any_value(cells) AS cells, any_value(size0) AS size0, any_value(cells) // any_value(size0) AS others,
         CASE WHEN any_value(sparse) THEN COUNT(Value) ELSE COUNT(*) END AS held
  FROM cubes GROUP BY Document)
SELECT Document, cells AS ExpectedCells, held AS ValueCount, NULL AS Problem FROM documents
UNION ALL
SELECT 'bad-' || Document, CASE Document[1] WHEN '2' THEN size0
         WHEN '3' THEN CAST('9' || size0 AS BIGINT) * others ELSE cells END,
       CASE WHEN Document[1] <> '4' THEN held END,
       CASE Document[1] WHEN '4' THEN 'no values' ELSE 'a dimension of another size' END
FROM documents"""
SQL["cube_metadata"] = f"""WITH {CUBE_LONG}
SELECT RegionKey, 'Vacant dwellings by local authority and quarter' AS Label,
       'Statistics office' AS Source, '2024-06-30T00:00:00.000Z' AS Updated,
       '3x' || CAST(COUNT(DISTINCT QuarterCode) AS VARCHAR) || 'x'
            || CAST(COUNT(DISTINCT LocalAuthorityCode) AS VARCHAR) AS Sizes,
       CAST(3 * COUNT(DISTINCT QuarterCode) * COUNT(DISTINCT LocalAuthorityCode) AS BIGINT) AS Cells
FROM agg GROUP BY RegionKey"""
SQL["cube_pivot"] = f"WITH {VAC_MEASURES} SELECT * FROM la"
SQL["county_rollup"] = f"WITH {VAC_MEASURES} SELECT * FROM gold_vacancy"
SQL["fact_vacancy"] = f"WITH {STAR_SALES}, {VAC_MEASURES}, {FACT_VACANCY} SELECT * FROM fact_vacancy"
SQL["dim_quarter"] = f"WITH {VAC_MEASURES} SELECT * FROM dim_quarter"
SQL["kpi_vacancy"] = f"""WITH {VAC_STAR}
SELECT SUM(VacantDwellings) AS TotalVacantDwellings, SUM(DwellingStock) AS TotalDwellingStock,
       {RATE} AS VacancyRate,
       (SELECT MAX(ts) FROM (SELECT {RUN_TS} AS ts FROM lineitem) s) AS DataLastUpdated
FROM vstar WHERE Quarter IN ({SEL_Q})"""
SQL["vacant_by_county"] = f"""WITH {VAC_STAR}
SELECT CountyName, SUM(VacantDwellings) AS TotalVacantDwellings FROM vstar
WHERE Quarter IN ({SEL_Q}) GROUP BY CountyName"""
SQL["rate_by_county"] = f"""WITH {VAC_STAR}
SELECT CountyName, {RATE} AS VacancyRate FROM vstar WHERE Quarter IN ({SEL_Q}) GROUP BY CountyName"""
SQL["rate_by_year"] = f"""WITH {VAC_STAR}
SELECT Year, {RATE} AS VacancyRate FROM vstar GROUP BY Year"""
SQL["vacancy_map"] = f"""WITH {VAC_STAR}
SELECT CountyName, SUM(VacantDwellings) AS TotalVacantDwellings, {RATE} AS VacancyRate,
       SUM(DwellingStock) AS TotalDwellingStock, MIN(Quarter) AS FirstQuarter
FROM vstar GROUP BY CountyName"""
SQL["scaled_measure"] = f"""WITH {VAC_STAR}, g AS (
  SELECT CountyName, SUM(VacantDwellings) AS TotalVacantDwellings FROM vstar
  WHERE Quarter IN ({SEL_Q}) GROUP BY CountyName)
SELECT CountyName, TotalVacantDwellings,
       (COALESCE(CAST(TotalVacantDwellings AS DOUBLE), 0.0)
        - MIN(COALESCE(CAST(TotalVacantDwellings AS DOUBLE), 0.0)) OVER ())
       / NULLIF(MAX(COALESCE(CAST(TotalVacantDwellings AS DOUBLE), 0.0)) OVER ()
                - MIN(COALESCE(CAST(TotalVacantDwellings AS DOUBLE), 0.0)) OVER (), 0) AS ScaledVacant
FROM g"""
SQL["fact_checks"] = f"""WITH {VAC_STAR}, loaded AS (
  SELECT QuarterKey, CASE WHEN CountyKey <> 1 THEN CountyKey END AS CountyKey,
         CASE WHEN CountyKey <> 1 THEN HousingVacancyKey END AS HousingVacancyKey FROM fact_vacancy),
twice AS (SELECT * FROM loaded UNION ALL SELECT * FROM loaded WHERE QuarterKey % 10 = 1)
SELECT COUNT(*) AS RowCount, COUNT(*) FILTER (WHERE CountyKey IS NULL) AS MissingCountyKeys,
       (SELECT COUNT(*) FROM (SELECT HousingVacancyKey FROM twice GROUP BY 1
        HAVING COUNT(*) > 1)) AS DuplicateFactKeys
FROM twice"""

# ---------------------------------------------------------------------------------------------
# planning
# ---------------------------------------------------------------------------------------------
DECISION_VALUES = ", ".join(f"({i}, {_q(t)})" for i, t in st.DECISION_TEXTS)


def _planning_ctes(shift_years: int = 0) -> str:
    recv = (f"(o.o_orderdate + INTERVAL {shift_years} YEAR)" if shift_years
            else "o.o_orderdate")
    # fixed values, written out here so that the code's own list is checked
    outcome = """CASE WHEN DecisionType IS NULL OR DecisionType IN ('Not recorded', 'N/A')
              THEN 'No decision recorded'
         WHEN contains(upper(DecisionType), 'INVA') THEN 'Invalid'
         WHEN contains(upper(DecisionType), 'WITHDRAW') THEN 'Withdrawn'
         WHEN contains(upper(DecisionType), 'SPLIT') THEN 'Split decision'
         WHEN contains(upper(DecisionType), 'REFUS') THEN 'Refused'
         WHEN contains(upper(DecisionType), 'GRANT') OR contains(upper(DecisionType), 'CONDITIONAL')
              OR contains(upper(DecisionType), 'APPROV') THEN 'Granted'
         WHEN contains(upper(DecisionType), 'EXEMPT') THEN 'Exempt'
         WHEN contains(upper(DecisionType), 'ADDITIONAL INFORMATION')
              OR contains(upper(DecisionType), 'FURTHER INFORMATION')
              OR contains(upper(DecisionType), 'REQUEST AI') OR contains(upper(DecisionType), 'REQ AI')
              THEN 'Further information'
         ELSE 'Other' END"""
    return f"""
segments AS (
  SELECT c_mktsegment, CAST(row_number() OVER (ORDER BY c_mktsegment) AS INTEGER) AS LandUseTypeID
  FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL) s
),
app AS (
  SELECT o.o_orderkey AS SourceObjectID,
         ' PL/' || CAST(o.o_orderkey AS VARCHAR) || ' ' AS ApplicationNumber,
         c.c_nationkey AS PlanningAuthorityID,
         CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS ApplicationTypeID,
         CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS INTEGER) AS ApplicationStatusID,
         CAST(CASE WHEN o.o_orderkey % 12 <> 0 THEN o.o_orderkey % 12 END AS INTEGER) AS DecisionTypeID,
         CAST(CASE WHEN c.c_mktsegment <> {_q(st.NULL_LAND_USE_SEGMENT)} THEN sg.LandUseTypeID END
              AS INTEGER) AS LandUseTypeID,
         ' ' || o.o_orderpriority || ' works for ' || c.c_name || ' ' AS DevelopmentDescription,
         c.c_name AS DevelopmentAddress, c.c_mktsegment AS DevelopmentPostcode,
         CAST(o.o_custkey AS DOUBLE) * 10.0 AS ITMEasting, CAST(o.o_orderkey AS DOUBLE) AS ITMNorthing,
         CASE WHEN o.o_custkey % 13 <> 12
              THEN CAST(50.5 + CAST(o.o_custkey % 13 AS DOUBLE) * 0.5 AS DECIMAL(9,6)) END AS Latitude,
         CAST(-11.5 + CAST(o.o_orderkey % 14 AS DOUBLE) * 0.5 AS DECIMAL(9,6)) AS Longitude,
         CAST(o.o_totalprice AS DECIMAL(18,4)) AS AreaOfSite,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS FloorArea,
         CAST(o.o_custkey % 5 AS INTEGER) AS NumResidentialUnits,
         CASE o.o_orderkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS OneOffHouse,
         {recv} AS ReceivedDate,
         {recv} + INTERVAL 56 DAY AS DecisionDate,
         CASE WHEN o.o_orderstatus = 'F' THEN {recv} + INTERVAL 84 DAY END AS GrantDate,
         {recv} + INTERVAL 5 YEAR AS ExpiryDate,
         'app/' || CAST(o.o_orderkey AS VARCHAR) AS LinkAppDetails,
         o.o_orderdate AS SourceETLDate, o.o_orderdate AS InsertedAt,
         o.o_orderdate AS RecordLastUpdatedAt
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN segments sg ON c.c_mktsegment = sg.c_mktsegment
),
lk_authority AS (SELECT n_nationkey AS PlanningAuthorityID, n_name AS PlanningAuthorityName FROM nation),
lk_type AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS ApplicationTypeID,
         substr(o_orderpriority, 3) AS ApplicationTypeName FROM orders
),
lk_status AS (
  SELECT DISTINCT CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS INTEGER) AS ApplicationStatusID,
         'Status ' || o_orderstatus AS ApplicationStatusName
  FROM orders WHERE o_orderstatus IN ('F', 'O')
),
lk_decision(DecisionTypeID, DecisionTypeName) AS (VALUES {DECISION_VALUES}),
lk_land_use AS (SELECT LandUseTypeID, c_mktsegment AS LandUseTypeName FROM segments
                WHERE c_mktsegment <> 'MACHINERY'),
joined AS (
  SELECT a.LandUseTypeID, a.DecisionTypeID, a.ApplicationStatusID, a.ApplicationTypeID,
         a.PlanningAuthorityID, a.SourceObjectID, a.ApplicationNumber, a.DevelopmentDescription,
         a.DevelopmentAddress, a.DevelopmentPostcode, a.ITMEasting, a.ITMNorthing, a.Latitude,
         a.Longitude, a.AreaOfSite, a.FloorArea, a.NumResidentialUnits, a.OneOffHouse,
         a.ReceivedDate, a.DecisionDate, a.GrantDate, a.ExpiryDate, a.LinkAppDetails,
         a.SourceETLDate, a.InsertedAt, a.RecordLastUpdatedAt,
         pa.PlanningAuthorityName, t.ApplicationTypeName, s.ApplicationStatusName,
         d.DecisionTypeName, l.LandUseTypeName
  FROM app a
  LEFT JOIN lk_authority pa ON a.PlanningAuthorityID = pa.PlanningAuthorityID
  LEFT JOIN lk_type t ON a.ApplicationTypeID = t.ApplicationTypeID
  LEFT JOIN lk_status s ON a.ApplicationStatusID = s.ApplicationStatusID
  LEFT JOIN lk_decision d ON a.DecisionTypeID = d.DecisionTypeID
  LEFT JOIN lk_land_use l ON a.LandUseTypeID = l.LandUseTypeID
),
silver_planning AS (
  SELECT SourceObjectID, trim(ApplicationNumber) AS ApplicationNumber, PlanningAuthorityID,
         trim(PlanningAuthorityName) AS PlanningAuthority, ApplicationTypeID,
         trim(ApplicationTypeName) AS ApplicationType, ApplicationStatusID,
         COALESCE(trim(ApplicationStatusName), 'Not recorded') AS ApplicationStatus,
         DecisionTypeID, COALESCE(trim(DecisionTypeName), 'Not recorded') AS DecisionType,
         LandUseTypeID, COALESCE(trim(LandUseTypeName), 'Not recorded') AS LandUseType,
         trim(DevelopmentDescription) AS DevelopmentDescription,
         trim(DevelopmentAddress) AS DevelopmentAddress,
         trim(DevelopmentPostcode) AS DevelopmentPostcode,
         ITMEasting, ITMNorthing, Latitude, Longitude, AreaOfSite, NumResidentialUnits, OneOffHouse,
         FloorArea, CAST(ReceivedDate AS DATE) AS ReceivedDate,
         CAST(DecisionDate AS DATE) AS DecisionDate, CAST(GrantDate AS DATE) AS GrantDate,
         CAST(ExpiryDate AS DATE) AS ExpiryDate, trim(LinkAppDetails) AS ApplicationDetailsURL,
         SourceETLDate, InsertedAt AS SQLInsertedAt, RecordLastUpdatedAt AS SQLRecordLastUpdatedAt,
         {RUN_DATE} AS LoadDate, {RUN_TS} AS SilverLoadTimestamp,
         'Irish Planning Applications' AS SourceSystem
  FROM joined
),
gold0 AS (
  SELECT *, CAST(year(ReceivedDate) AS INTEGER) AS ApplicationYear,
         CAST(month(ReceivedDate) AS INTEGER) AS ApplicationMonth,
         strftime(ReceivedDate, '%Y-%m') AS ApplicationYearMonth,
         CASE WHEN OneOffHouse THEN 'Yes' WHEN NOT OneOffHouse THEN 'No' ELSE 'Not recorded' END
           AS OneOffHouseCategory,
         {outcome} AS DecisionOutcome
  FROM silver_planning
),
gold_planning AS (
  SELECT *, CASE WHEN DecisionOutcome = 'No decision recorded' THEN 0 ELSE 1 END AS DecisionRecorded,
         {RUN_TS} AS GoldLoadTimestamp FROM gold0
),
fact_planning AS (
  SELECT CAST(SourceObjectID AS BIGINT) AS PlanningApplicationKey, ApplicationNumber,
         CAST(PlanningAuthorityID AS INTEGER) AS PlanningAuthorityKey,
         CAST(ApplicationTypeID AS INTEGER) AS ApplicationTypeKey,
         COALESCE(ApplicationStatusID, 0) AS ApplicationStatusKey,
         COALESCE(DecisionTypeID, 0) AS DecisionTypeKey,
         COALESCE(LandUseTypeID, 0) AS LandUseTypeKey,
         CAST(strftime(ReceivedDate, '%Y%m%d') AS INTEGER) AS DateKey,
         ReceivedDate, DecisionDate, GrantDate, ExpiryDate, 1 AS ApplicationCount,
         DecisionRecorded, CAST(OneOffHouse AS INTEGER) AS OneOffHouseFlag, NumResidentialUnits,
         AreaOfSite, FloorArea, Latitude, Longitude, ITMEasting, ITMNorthing,
         substr(DevelopmentDescription, 1, 4000) AS DevelopmentDescription, DevelopmentAddress,
         DevelopmentPostcode, ApplicationDetailsURL, SourceETLDate, LoadDate, GoldLoadTimestamp
  FROM gold_planning
),
dim_authority AS (
  SELECT CAST(PlanningAuthorityID AS INTEGER) AS PlanningAuthorityKey,
         MIN(PlanningAuthority) AS PlanningAuthorityName
  FROM gold_planning WHERE PlanningAuthorityID IS NOT NULL GROUP BY 1
),
dim_app_type AS (
  SELECT CAST(ApplicationTypeID AS INTEGER) AS ApplicationTypeKey,
         MIN(ApplicationType) AS ApplicationTypeName
  FROM gold_planning WHERE ApplicationTypeID IS NOT NULL GROUP BY 1
),
dim_status AS (
  SELECT 0 AS ApplicationStatusKey, 'Not recorded' AS ApplicationStatusName
  UNION ALL
  SELECT CAST(ApplicationStatusID AS INTEGER), MIN(ApplicationStatus)
  FROM gold_planning WHERE ApplicationStatusID IS NOT NULL GROUP BY 1
),
dim_decision AS (
  SELECT 0 AS DecisionTypeKey, 'Not recorded' AS DecisionTypeName,
         'No decision recorded' AS DecisionOutcome
  UNION ALL
  SELECT k, m.DecisionTypeName, m.DecisionOutcome FROM (
    SELECT CAST(DecisionTypeID AS INTEGER) AS k,
           MIN({{'DecisionTypeName': DecisionType, 'DecisionOutcome': DecisionOutcome}}) AS m
    FROM gold_planning WHERE DecisionTypeID IS NOT NULL GROUP BY 1) x
),
dim_land_use AS (
  SELECT 0 AS LandUseTypeKey, 'Not recorded' AS LandUseTypeName
  UNION ALL
  SELECT CAST(LandUseTypeID AS INTEGER), MIN(LandUseType)
  FROM gold_planning WHERE LandUseTypeID IS NOT NULL GROUP BY 1
)"""


PLAN = _planning_ctes(0)
PLAN_STAR = _planning_ctes(15)

SQL["planning_denormalised"] = f"WITH {PLAN} SELECT * FROM joined"
SQL["planning_silver"] = f"WITH {PLAN} SELECT * FROM silver_planning"
SQL["planning_gold"] = f"WITH {PLAN} SELECT * FROM gold_planning"
SQL["fact_planning"] = f"WITH {PLAN} SELECT * FROM fact_planning"
SQL["decision_outcomes"] = f"""WITH {PLAN}
SELECT DecisionOutcome, COUNT(*) AS ApplicationCount FROM gold_planning GROUP BY 1"""
SQL["one_off_house"] = f"""WITH {PLAN}
SELECT OneOffHouseCategory, COUNT(*) AS ApplicationCount FROM gold_planning GROUP BY 1"""
SQL["dim_decision_type"] = f"WITH {PLAN} SELECT * FROM dim_decision"
SQL["dim_status"] = f"WITH {PLAN} SELECT * FROM dim_status"
SQL["dim_authority"] = f"WITH {PLAN} SELECT * FROM dim_authority"
SQL["dim_app_type"] = f"WITH {PLAN} SELECT * FROM dim_app_type"
SQL["dim_land_use"] = f"WITH {PLAN} SELECT * FROM dim_land_use"


def _missing(name: str, dim: str, fk: str, dk: str) -> str:
    return f"""SELECT {_q(name)} AS Dimension, COUNT(*) AS MissingKeys FROM (
  SELECT DISTINCT {fk} AS k FROM fact_planning) f
  WHERE f.k IS NULL OR NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dk} = f.k)"""


SQL["missing_keys"] = f"WITH {PLAN_STAR}, {DIM_DATE}\n" + "\nUNION ALL\n".join([
    _missing("dim_planning_authority",
             "(SELECT * FROM dim_authority WHERE PlanningAuthorityKey <> 3)", "PlanningAuthorityKey", "PlanningAuthorityKey"),
    _missing("dim_application_type", "dim_app_type", "ApplicationTypeKey", "ApplicationTypeKey"),
    _missing("dim_application_status", "dim_status", "ApplicationStatusKey", "ApplicationStatusKey"),
    _missing("dim_decision_type", "(SELECT * FROM dim_decision WHERE DecisionTypeKey <> 0)", "DecisionTypeKey", "DecisionTypeKey"),
    _missing("dim_land_use_type", "dim_land_use", "LandUseTypeKey", "LandUseTypeKey"),
    _missing("dim_date", "(SELECT * FROM dim_date WHERE Year >= 2012)", "DateKey", "DateKey"),
])
SQL["missing_dates"] = f"""WITH {PLAN_STAR}, {DIM_DATE}
SELECT DISTINCT DateKey, ReceivedDate FROM fact_planning f
WHERE NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.DateKey = f.DateKey AND d.Year >= 2012)"""
SQL["lookup_quality"] = f"""WITH {PLAN}
SELECT 'ApplicationStatus' AS Lookup,
       COUNT(*) FILTER (WHERE ApplicationStatusID IS NULL) AS NullSourceIds,
       COUNT(*) FILTER (WHERE ApplicationStatusID IS NOT NULL AND ApplicationStatusName IS NULL) AS UnmatchedIds
FROM joined
UNION ALL SELECT 'DecisionType', COUNT(*) FILTER (WHERE DecisionTypeID IS NULL),
       COUNT(*) FILTER (WHERE DecisionTypeID IS NOT NULL AND DecisionTypeName IS NULL) FROM joined
UNION ALL SELECT 'LandUseType', COUNT(*) FILTER (WHERE LandUseTypeID IS NULL),
       COUNT(*) FILTER (WHERE LandUseTypeID IS NOT NULL AND LandUseTypeName IS NULL) FROM joined
UNION ALL SELECT 'PlanningAuthority', COUNT(*) FILTER (WHERE PlanningAuthorityID IS NULL),
       COUNT(*) FILTER (WHERE PlanningAuthorityID IS NOT NULL AND PlanningAuthorityName IS NULL)
FROM joined"""
SQL["invalid_coordinates"] = f"""WITH {PLAN}
SELECT COUNT(*) AS RowCount,
       COUNT(*) FILTER (WHERE Latitude IS NULL OR Longitude IS NULL
                        OR NOT (Latitude BETWEEN 51.0 AND 56.0)
                        OR NOT (Longitude BETWEEN -11.0 AND -5.0)) AS InvalidCoordinates
FROM silver_planning"""
SQL["rowcount_preserved"] = f"""WITH {PLAN}
SELECT (SELECT COUNT(*) FROM app) AS SourceRows, (SELECT COUNT(*) FROM joined) AS JoinedRows,
       (SELECT COUNT(*) FROM joined) - (SELECT COUNT(*) FROM app) AS Difference"""
SQL["profile"] = f"""WITH {PLAN}, twice AS (
  SELECT * FROM silver_planning UNION ALL SELECT * FROM silver_planning WHERE SourceObjectID % 40 = 0)
SELECT 'RowCount' AS Metric, COUNT(*) AS Value FROM twice
UNION ALL SELECT 'Null ApplicationNumber', COUNT(*) FILTER (WHERE ApplicationNumber IS NULL) FROM twice
UNION ALL SELECT 'Null ReceivedDate', COUNT(*) FILTER (WHERE ReceivedDate IS NULL) FROM twice
UNION ALL SELECT 'Null PlanningAuthority', COUNT(*) FILTER (WHERE PlanningAuthority IS NULL) FROM twice
UNION ALL SELECT 'Null ApplicationStatusID', COUNT(*) FILTER (WHERE ApplicationStatusID IS NULL) FROM twice
UNION ALL SELECT 'Null DecisionTypeID', COUNT(*) FILTER (WHERE DecisionTypeID IS NULL) FROM twice
UNION ALL SELECT 'DuplicateKeys', COUNT(*) FROM (SELECT SourceObjectID FROM twice
                                                 GROUP BY 1 HAVING COUNT(*) > 1)"""

PSTAR = f"WITH {STAR_SALES}, {PLAN_STAR}"
SQL["kpi_planning"] = f"""{PSTAR}, s AS (
  SELECT f.ApplicationCount, d.DecisionOutcome FROM fact_planning f
  LEFT JOIN dim_decision d ON f.DecisionTypeKey = d.DecisionTypeKey)
SELECT SUM(ApplicationCount) AS TotalPlanningApplications,
       SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Granted') AS GrantedApplications,
       CAST(SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Granted') AS DOUBLE)
         / NULLIF(CAST(COALESCE(SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Granted'), 0)
                     + COALESCE(SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Refused'), 0)
                  AS DOUBLE), 0) AS PlanningGrantRate,
       (SELECT MAX(LoadTimestamp) FROM fact_sales) AS DataLastUpdated
FROM s"""
SQL["applications_by_year"] = f"""WITH {PLAN_STAR}, {DIM_DATE}
SELECT d.Year, SUM(f.ApplicationCount) AS TotalPlanningApplications
FROM fact_planning f LEFT JOIN dim_date d ON f.DateKey = d.DateKey GROUP BY d.Year"""
SQL["application_points"] = f"""WITH {PLAN_STAR}
SELECT f.Longitude, f.Latitude, d.DecisionOutcome,
       MIN(f.ApplicationNumber) AS FirstApplicationNumber,
       MIN(a.PlanningAuthorityName) AS FirstPlanningAuthority,
       MIN(f.ReceivedDate) AS FirstReceivedDate,
       MIN(f.DevelopmentAddress) AS FirstDevelopmentAddress,
       SUM(f.ApplicationCount) AS TotalPlanningApplications
FROM fact_planning f
LEFT JOIN dim_decision d ON f.DecisionTypeKey = d.DecisionTypeKey
LEFT JOIN dim_authority a ON f.PlanningAuthorityKey = a.PlanningAuthorityKey
GROUP BY 1, 2, 3"""
SQL["year_choices"] = f"""WITH {PLAN_STAR}, {DIM_DATE}
SELECT DISTINCT d.Year FROM fact_planning f LEFT JOIN dim_date d ON f.DateKey = d.DateKey
WHERE d.Year BETWEEN {cat.YEAR_CHOICES[0]} AND {cat.YEAR_CHOICES[1]}"""
SQL["implicit_measures"] = f"""WITH {PLAN_STAR}
SELECT SUM(ApplicationCount) AS SumApplicationCount, SUM(NumResidentialUnits) AS SumNumResidentialUnits,
       SUM(AreaOfSite) AS SumAreaOfSite, SUM(FloorArea) AS SumFloorArea,
       COUNT(PlanningApplicationKey) AS CountPlanningApplicationKey
FROM fact_planning"""

# ---------------------------------------------------------------------------------------------
# operations
# ---------------------------------------------------------------------------------------------
RUN_LOG = """
run_log AS (
  SELECT CAST(event_id AS VARCHAR) AS LogID, CAST(user_id AS VARCHAR) AS ParentRunID,
         CAST(event_id AS INTEGER) AS PipelineConfigID, event_type AS DatasetName,
         'pl_' || event_type AS ChildPipelineName, 1 AS ExecutionOrder,
         CASE event_type WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Running'
              ELSE 'Succeeded' END AS RunStatus,
         ts AS StartTime,
         CASE WHEN event_type <> 'signup' THEN ts + to_seconds(CAST(trunc(value) AS BIGINT)) END
           AS EndTime,
         CASE WHEN event_type <> 'signup' THEN CAST(trunc(value) AS INTEGER) END AS DurationSeconds,
         CAST(ts AS DATE) AS LoadDate,
         CASE WHEN event_type = 'error' THEN 'error in run ' || CAST(event_id AS VARCHAR) END
           AS ErrorMessage
  FROM events
)"""

SQL["run_summary"] = f"""WITH {RUN_LOG}
SELECT ParentRunID, MIN(StartTime) AS RunStartTime, MAX(EndTime) AS RunEndTime,
       date_diff('second', MIN(StartTime), MAX(EndTime)) AS TotalDurationSeconds,
       CAST(date_diff('second', MIN(StartTime), MAX(EndTime)) / 60.0 AS DECIMAL(10,2))
         AS TotalDurationMinutes,
       COUNT(*) AS ChildPipelineCount,
       COUNT(*) FILTER (WHERE RunStatus = 'Succeeded') AS SuccessfulChildCount,
       COUNT(*) FILTER (WHERE RunStatus = 'Failed') AS FailedChildCount,
       CASE WHEN COUNT(*) FILTER (WHERE RunStatus = 'Failed') > 0 THEN 'Failed'
            WHEN COUNT(*) FILTER (WHERE RunStatus = 'Running') > 0 THEN 'Running'
            ELSE 'Succeeded' END AS OverallRunStatus,
       MAX(LoadDate) AS LoadDate
FROM run_log GROUP BY ParentRunID"""
SQL["run_log_transitions"] = f"WITH {RUN_LOG} SELECT * FROM run_log"
CONFIG = """
config AS (
  SELECT CAST(MIN(event_id) AS INTEGER) AS PipelineConfigID, event_type AS DatasetName,
         'pl_' || event_type AS ChildPipelineName, CAST(MIN(event_id) AS INTEGER) AS ExecutionOrder,
         event_type <> 'error' AS IsActive
  FROM events GROUP BY event_type
)"""
SQL["active_pipelines"] = f"WITH {CONFIG} SELECT * FROM config WHERE IsActive"
SQL["config_upsert"] = f"""WITH {CONFIG}, changes AS (
  SELECT PipelineConfigID, DatasetName, ChildPipelineName, ExecutionOrder, TRUE AS IsActive
  FROM config WHERE DatasetName = 'error'
  UNION ALL
  SELECT PipelineConfigID + 100000, 'view_backfill', ChildPipelineName, ExecutionOrder, IsActive
  FROM config WHERE DatasetName = 'view')
SELECT * FROM config c WHERE NOT EXISTS (SELECT 1 FROM changes s
                                         WHERE s.PipelineConfigID = c.PipelineConfigID)
UNION ALL SELECT * FROM changes"""
SQL["kpi_operations"] = f"""WITH {STAR_SALES}, {RUN_LOG},
latest AS (SELECT ParentRunID AS rid FROM run_log WHERE StartTime IS NOT NULL
           ORDER BY StartTime DESC, ParentRunID DESC LIMIT 1)
SELECT COUNT(DISTINCT ParentRunID) AS TotalPipelineRuns,
       COUNT(*) FILTER (WHERE RunStatus = 'Succeeded') AS SuccessfulChildExecutions,
       COUNT(*) FILTER (WHERE RunStatus = 'Failed') AS FailedChildExecutions,
       (SELECT date_diff('second', MIN(StartTime), MAX(EndTime)) / 60.0
        FROM run_log WHERE ParentRunID = (SELECT rid FROM latest)) AS LatestRunDurationMinutes,
       (SELECT MAX(LoadTimestamp) FROM fact_sales) AS DataLastUpdated
FROM run_log"""
SQL["run_log_detail"] = f"""WITH {RUN_LOG}
SELECT ParentRunID, DatasetName, ChildPipelineName, ExecutionOrder, RunStatus, StartTime, EndTime,
       DurationSeconds, LoadDate, ErrorMessage, LogID FROM run_log"""

# ---------------------------------------------------------------------------------------------
# merge / watermark / stream
# ---------------------------------------------------------------------------------------------
MERGE = f"""
o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
             o_orderdate AS UpdatedAt FROM orders),
target AS (SELECT * FROM o WHERE o_orderdate < TIMESTAMP '{cat.MERGE_CUT}'),
changed AS (SELECT * FROM target WHERE o_orderpriority = {_q(cat.CHANGED_PRIORITY)}),
source AS (
  SELECT * FROM o WHERE o_orderdate >= TIMESTAMP '{cat.MERGE_CUT}'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate,
                   o_orderpriority, UpdatedAt + INTERVAL 1 DAY FROM changed
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, o_orderdate,
                   o_orderpriority, UpdatedAt + INTERVAL 2 DAY FROM changed
),
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY UpdatedAt DESC) AS rn
    FROM source) x WHERE rn = 1
)"""
SQL["merge_upsert"] = f"""WITH {MERGE}
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM latest s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT * FROM latest"""
SQL["stream_upsert"] = SQL["merge_upsert"]
SQL["incremental_window"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate > TIMESTAMP '{cat.WINDOW_LAST}'
  AND o_orderdate <= (SELECT MAX(o_orderdate) FROM orders)"""
SQL["advance_watermark"] = f"""WITH wm(WatermarkConfigID, DatasetName, SourceTable, WatermarkColumn,
                                    LastWatermarkValue, IsActive) AS (
  VALUES (1, 'orders', 'orders', 'o_orderdate', TIMESTAMP '1997-01-01 00:00:00', TRUE),
         (2, 'lineitem', 'lineitem', 'l_shipdate', TIMESTAMP '2100-01-01 00:00:00', TRUE),
         (3, 'events', 'events', 'ts', TIMESTAMP '2024-01-15 00:00:00', TRUE)),
probes AS (
  SELECT 'orders' AS DatasetName, MAX(o_orderdate) AS cw FROM orders
  UNION ALL SELECT 'lineitem', MAX(l_shipdate) FROM lineitem
  UNION ALL SELECT 'events', MAX(ts) FROM events)
SELECT w.WatermarkConfigID, w.DatasetName, w.SourceTable, w.WatermarkColumn,
       CASE WHEN p.cw > w.LastWatermarkValue THEN p.cw ELSE w.LastWatermarkValue END
         AS LastWatermarkValue, w.IsActive,
       CASE WHEN p.cw > w.LastWatermarkValue THEN {RUN_TS} END AS UpdatedAt
FROM wm w LEFT JOIN probes p ON w.DatasetName = p.DatasetName"""

# ---------------------------------------------------------------------------------------------
# sources / sinks: the frame read back equals the frame written
# ---------------------------------------------------------------------------------------------
SQL["layer_roundtrip"] = SQL["gold_sales"]
SQL["staging_load"] = f"""WITH {STAR_SALES}
SELECT DateKey, CountyKey, PropertyTypeKey, SaleTypeKey, Address, Eircode, SalePrice,
       IsFullMarketPrice, LoadTimestamp FROM fact_sales WHERE SalePrice >= 2000"""
SQL["rejected_rows"] = f"""WITH {STAR_SALES}, numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY SaleDate, Address, County, Eircode, SalePrice,
         IsFullMarketPrice, PropertyType, PropertySizeCategory, SaleType) AS INTEGER) AS PropertySaleOrdinal
  FROM fact_sales)
SELECT PropertySaleOrdinal, DateKey, CountyKey, PropertyTypeKey, SaleTypeKey, Address, Eircode, SalePrice,
       IsFullMarketPrice, LoadTimestamp,
       CASE WHEN SalePrice IS NULL THEN 'SalePrice is NULL' ELSE 'SalePrice is too low' END AS Reasons
FROM numbered WHERE SalePrice IS NULL OR SalePrice < 2000"""
SQL["load_counts"] = f"""WITH {STAR_SALES}, f AS (
  SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE SalePrice IS NULL) AS missing,
         COUNT(*) FILTER (WHERE SalePrice < 2000) AS cheap FROM fact_sales)
SELECT Name, Counted, Counted AS Stored FROM (
  SELECT 'rows' AS Name, n AS Counted FROM f
  UNION ALL SELECT 'rejected', missing + cheap FROM f
  UNION ALL SELECT 'SalePrice is NULL', missing FROM f
  UNION ALL SELECT 'SalePrice is too low', cheap FROM f
  UNION ALL SELECT unnest(['PropertySaleKey is NULL', 'PropertySaleKey is no bigint', 'DateKey is NULL',
    'DateKey is no int', 'CountyKey is NULL', 'CountyKey is no int', 'PropertyTypeKey is NULL',
    'PropertyTypeKey is no int', 'SaleTypeKey is NULL', 'SaleTypeKey is no int', 'Address is no string',
    'Address is longer than 500', 'Eircode is no string', 'Eircode is longer than 10',
    'SalePrice is no decimal(18,2)', 'IsFullMarketPrice is no string',
    'IsFullMarketPrice is longer than 3', 'LoadTimestamp is no timestamp_ntz']), 0) x"""
SQL["csv_good_rows"] = """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer
WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 13 <> 0 AND c_custkey % 17 <> 0"""
SQL["csv_damaged_lines"] = """
SELECT CASE WHEN c_custkey % 7 = 0 THEN concat_ws(',', c_custkey, c_name, c_nationkey)
            WHEN c_custkey % 11 = 0 THEN concat_ws(',', c_custkey, c_name, c_nationkey, c_mktsegment, 'more')
            WHEN c_custkey % 13 = 0 THEN concat_ws(',', c_custkey, '"' || c_name, c_nationkey, c_mktsegment)
            ELSE concat_ws(',', 'none', c_name, c_nationkey, c_mktsegment) END AS Line,
       TRUE AS HasFile, 'fields don''t fit' AS Reasons
FROM customer
WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0 OR c_custkey % 13 = 0 OR c_custkey % 17 = 0"""
SQL["extract_roundtrip"] = f"""
SELECT CASE WHEN l.l_orderkey % 83 <> 0 THEN strftime(o.o_orderdate + INTERVAL 15 YEAR, '%d/%m/%Y') END
       AS "Date of Sale (dd/mm/yyyy)",
       c.c_name AS Address, n.n_name AS County, p.p_brand AS Eircode,
       CASE WHEN l.l_orderkey % 97 <> 0
            THEN '€' || format('{{:,.2f}}', CAST(l.l_extendedprice AS DECIMAL(18,2))) END AS "Price (€)",
       CASE WHEN l.l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS "Not Full Market Price",
       CASE WHEN l.l_linestatus = 'O' THEN 'Yes' ELSE 'No' END AS "VAT Exclusive",
       CASE WHEN p.p_type = 'PROMO' AND l.copy = 2 AND l.l_orderkey % 100 = 0
            THEN 'Second-Hand Dwelling house /Apartment'
            WHEN p.p_type = 'PROMO' THEN {_q(st.SECOND_HAND_IRISH)}
            WHEN p.p_type = 'SMALL' THEN {_q(st.NEW_IRISH)}
            ELSE p.p_type END AS "Description of Property",
       CASE WHEN p.p_size < 10 THEN {_q(st.SIZE_SMALL)}
            WHEN p.p_size < 30 THEN {_q(st.SIZE_MEDIUM)}
            ELSE {_q(st.SIZE_LARGE)} END AS "Property Size Description"
FROM (SELECT *, 1 AS copy FROM lineitem
      UNION ALL SELECT *, 2 FROM lineitem WHERE l_orderkey % 50 = 0) l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey"""

# ---------------------------------------------------------------------------------------------
# sources, control and measure queries added for full coverage
# ---------------------------------------------------------------------------------------------
SQL["cube_from_files"] = SQL["cube_flatten"]
SQL["planning_from_extracts"] = SQL["planning_silver"]
SQL["staging_table_roundtrip"] = SQL["dim_county"]
SQL["staging_tables"] = f"""WITH {PLAN}, tables(TableName, TableRows) AS (
  SELECT 'stg_dim_planning_authority', COUNT(*) FROM dim_authority
  UNION ALL SELECT 'stg_dim_application_type', COUNT(*) FROM dim_app_type
  UNION ALL SELECT 'stg_dim_application_status', COUNT(*) FROM dim_status
  UNION ALL SELECT 'stg_dim_decision_type', COUNT(*) FROM dim_decision
  UNION ALL SELECT 'stg_dim_land_use_type', COUNT(*) FROM dim_land_use),
columns(TableName, Position, ColumnName, DataType) AS (VALUES
  ('stg_dim_planning_authority', 1, 'PlanningAuthorityKey', 'int'),
  ('stg_dim_planning_authority', 2, 'PlanningAuthorityName', 'string'),
  ('stg_dim_application_type', 1, 'ApplicationTypeKey', 'int'),
  ('stg_dim_application_type', 2, 'ApplicationTypeName', 'string'),
  ('stg_dim_application_status', 1, 'ApplicationStatusKey', 'int'),
  ('stg_dim_application_status', 2, 'ApplicationStatusName', 'string'),
  ('stg_dim_decision_type', 1, 'DecisionTypeKey', 'int'),
  ('stg_dim_decision_type', 2, 'DecisionTypeName', 'string'),
  ('stg_dim_decision_type', 3, 'DecisionOutcome', 'string'),
  ('stg_dim_land_use_type', 1, 'LandUseTypeKey', 'int'),
  ('stg_dim_land_use_type', 2, 'LandUseTypeName', 'string'))
SELECT TableName, Position, ColumnName, DataType, TableRows FROM columns JOIN tables USING (TableName)"""
SQL["latest_run"] = f"""WITH {RUN_LOG}
SELECT * FROM run_log ORDER BY StartTime DESC NULLS LAST, LogID DESC LIMIT 1"""
SQL["unmatched_reference"] = f"""WITH {PLAN}
SELECT 'PlanningAuthorityName' AS ColumnName, COUNT(*) FILTER (WHERE PlanningAuthorityName IS NULL) AS NullCount FROM joined
UNION ALL SELECT 'ApplicationTypeName', COUNT(*) FILTER (WHERE ApplicationTypeName IS NULL) FROM joined
UNION ALL SELECT 'ApplicationStatusName', COUNT(*) FILTER (WHERE ApplicationStatusName IS NULL) FROM joined
UNION ALL SELECT 'DecisionTypeName', COUNT(*) FILTER (WHERE DecisionTypeName IS NULL) FROM joined
UNION ALL SELECT 'LandUseTypeName', COUNT(*) FILTER (WHERE LandUseTypeName IS NULL) FROM joined"""
SQL["sales_measures"] = f"""WITH {STAR_SALES}
SELECT c.CountyName, SUM(f.SalePrice) AS TotalSales, COUNT(*) AS SalesCount,
       {avg6('f.SalePrice')} AS AverageSalePrice, MAX(f.SalePrice) AS HighestSalePrice,
       MIN(f.SalePrice) AS LowestSalePrice
FROM fact_sales f LEFT JOIN dim_county c ON f.CountyKey = c.CountyKey GROUP BY c.CountyName"""
SQL["planning_measures"] = f"""WITH {PLAN_STAR}, {DIM_DATE}, s AS (
  SELECT f.*, d.DecisionOutcome, dd.Year FROM fact_planning f
  LEFT JOIN dim_decision d ON f.DecisionTypeKey = d.DecisionTypeKey
  LEFT JOIN dim_date dd ON f.DateKey = dd.DateKey)
SELECT Year, SUM(ApplicationCount) AS TotalPlanningApplications,
       SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Granted') AS GrantedApplications,
       SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Refused') AS RefusedApplications,
       CAST(SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Granted') AS DOUBLE)
         / NULLIF(CAST(COALESCE(SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Granted'), 0)
                     + COALESCE(SUM(ApplicationCount) FILTER (WHERE DecisionOutcome = 'Refused'), 0)
                  AS DOUBLE), 0) AS PlanningGrantRate,
       SUM(ApplicationCount) FILTER (WHERE OneOffHouseFlag = 1) AS OneOffHouseApplications,
       SUM(NumResidentialUnits) AS TotalResidentialUnits,
       MAX(LoadDate) AS PlanningDataLastUpdated
FROM s GROUP BY Year"""
SQL["audit_columns"] = f"""WITH {PLAN}
SELECT SourceObjectID, {RUN_TS} AS LoadTimestamp, 'Irish Planning Applications' AS SourceSystem,
       {RUN_DATE} AS LoadDate, 1 AS ApplicationCount,
       substr(CASE WHEN SourceObjectID % 50 = 0 THEN repeat(DevelopmentDescription, 200)
                   ELSE DevelopmentDescription END, 1, 4000) AS DevelopmentDescription
FROM app"""
SQL["median_by_county"] = f"""WITH {STAR_SALES}
SELECT c.CountyName, median(CAST(f.SalePrice AS DOUBLE)) AS MedianSalePrice
FROM fact_sales f LEFT JOIN dim_county c ON f.CountyKey = c.CountyKey GROUP BY c.CountyName"""

# ---------------------------------------------------------------------------------------------
# row identity, stable keys, outcome override, warehouse tables
# ---------------------------------------------------------------------------------------------
SQL["sale_row_key"] = f"""WITH {GOLD_SALES}
SELECT COUNT(*) AS RowCount, COUNT(*) AS DistinctKeys,
       COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM gold_sales)) AS RepeatedSales
FROM gold_sales"""
SQL["stable_county_keys"] = f"""WITH {GOLD_SALES},
counties AS (SELECT DISTINCT County AS v FROM gold_sales WHERE County IS NOT NULL),
known AS (SELECT row_number() OVER (ORDER BY v) AS k, v FROM counties WHERE length(v) % 2 = 0)
SELECT 0 AS CountyKey, 'Not recorded' AS CountyName
UNION ALL SELECT CAST(k AS INTEGER), v FROM known
UNION ALL SELECT CAST((SELECT MAX(k) FROM known) + row_number() OVER (ORDER BY v) AS INTEGER), v
FROM counties WHERE length(v) % 2 = 1"""
SQL["largest_sales"] = f"""WITH {GOLD_SALES}
SELECT SalePrice, Address, SaleDate, Eircode, PropertyType, PropertySizeCategory, SaleType,
       IsFullMarketPrice
FROM gold_sales
ORDER BY SalePrice DESC NULLS LAST, Address NULLS FIRST, SaleDate NULLS FIRST, Eircode NULLS FIRST,
         PropertyType NULLS FIRST, PropertySizeCategory NULLS FIRST, SaleType NULLS FIRST,
         IsFullMarketPrice NULLS FIRST
LIMIT 20"""
SQL["county_from_default_map"] = """
WITH named(k, name, county) AS (VALUES
  (0, 'Dublin City Council', 'Dublin'), (1, 'Dún Laoghaire Rathdown County Council', 'Dublin'),
  (2, 'Fingal County Council', 'Dublin'), (3, 'South Dublin County Council', 'Dublin'),
  (4, 'Cork City Council', 'Cork'), (5, 'Cork County Council', 'Cork'),
  (6, 'Galway City Council', 'Galway'), (7, 'Galway County Council', 'Galway'),
  (8, 'Limerick City & County Council', 'Limerick'),
  (9, 'Waterford City & County Council', 'Waterford'))
SELECT COALESCE(m.name, n.n_name || ' County Council') AS LocalAuthority, COUNT(*) AS Dwellings,
       COALESCE(m.county, n.n_name) AS County
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN named m ON n.n_nationkey = m.k
GROUP BY 1, 3"""
SQL["snapshot_merge"] = f"""SELECT *, 3 AS Version, COUNT(*) OVER () AS RowsWritten
FROM ({SQL['merge_upsert']}) x"""
SQL["bucketed_merge"] = SQL["merge_upsert"]
SQL["extract_window"] = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS load_date, o.*
FROM (SELECT ORDER_COLUMNS FROM orders) o
WHERE date_trunc('month', o_orderdate) > DATE '1996-12-31'
  AND date_trunc('month', o_orderdate) <= DATE '1997-06-30'""".replace(
    "ORDER_COLUMNS", ", ".join(cat.ORDER_COLS))
SQL["county_registry"] = f"""WITH {GOLD_SALES},{VAC_MEASURES},
first_load AS (SELECT DISTINCT County AS c FROM gold_vacancy WHERE County IS NOT NULL),
members AS (
  SELECT 0 AS CountyKey, 'Not recorded' AS CountyName, 0 AS LoadNumber
  UNION ALL SELECT row_number() OVER (ORDER BY c), c, 1 FROM first_load
  UNION ALL SELECT (SELECT COUNT(*) FROM first_load) + row_number() OVER (ORDER BY c), c, 2
  FROM (SELECT DISTINCT County AS c FROM gold_sales
        WHERE County IS NOT NULL AND County NOT IN (SELECT c FROM first_load)) x)
SELECT CountyKey, CountyName, LoadNumber,
       (SELECT COUNT(*) FROM gold_vacancy g WHERE g.County = CountyName) AS VacancyRows,
       (SELECT COUNT(*) FROM gold_sales g WHERE COALESCE(g.County, 'Not recorded') = CountyName) AS SalesRows
FROM members"""
SQL["granted_by_outcome"] = f"""WITH {PLAN_STAR}, {DIM_DATE}, per AS (
  SELECT dd.Year, d.DecisionOutcome, SUM(f.ApplicationCount) AS n FROM fact_planning f
  LEFT JOIN dim_decision d ON f.DecisionTypeKey = d.DecisionTypeKey
  LEFT JOIN dim_date dd ON f.DateKey = dd.DateKey GROUP BY 1, 2),
overall AS (
  SELECT Year, SUM(n) FILTER (WHERE DecisionOutcome = 'Granted') AS g,
         SUM(n) FILTER (WHERE DecisionOutcome = 'Refused') AS r FROM per GROUP BY Year)
SELECT p.Year, p.DecisionOutcome, p.n AS TotalPlanningApplications, o.g AS GrantedApplications,
       o.r AS RefusedApplications,
       CAST(o.g AS DOUBLE) / NULLIF(CAST(COALESCE(o.g, 0) + COALESCE(o.r, 0) AS DOUBLE), 0)
         AS PlanningGrantRate
FROM per p JOIN overall o ON p.Year IS NOT DISTINCT FROM o.Year"""
SQL["incremental_planning"] = f"""WITH {PLAN}
SELECT SourceObjectID, AreaOfSite, SQLRecordLastUpdatedAt,
       CASE WHEN SQLRecordLastUpdatedAt <= TIMESTAMP '{cat.WINDOW_LAST}' THEN DATE '2024-06-29'
            ELSE {RUN_DATE} END AS LoadDate,
       (SELECT MAX(o_orderdate) FROM orders) AS Watermark
FROM silver_planning"""
SQL["warehouse_dim_county"] = SQL["dim_county"]
SQL["warehouse_dim_property_type"] = SQL["dim_property_type"]
SQL["warehouse_dim_sale_type"] = SQL["dim_sale_type"]
SQL["warehouse_dim_date"] = f"""WITH {GOLD_SALES}, {DIM_DATE}
SELECT * FROM dim_date WHERE FullDate IN (SELECT SaleDate FROM gold_sales)"""
SQL["warehouse_dim_quarter"] = SQL["dim_quarter"]
SQL["warehouse_fact_vacancy"] = SQL["fact_vacancy"]
