"""DuckDB SQL oracles for :mod:`panelkit.plans.catalog` (same column names).

Built from shared CTE fragments; the stand-in inputs are re-derived from the
Parquet tables in SQL, so the oracle never sees Spark output."""

from __future__ import annotations

from panelkit.plans import standins as S
from panelkit.sources.readers import HISTORY_MISSING, REGISTER_COLUMNS

MAIN_10 = ("PID", "legalType", "zoneName", "zoneCat", "postalCode", "curVal", "curImpVal", "taxAssess",
           "preVal", "preImpVal")
HIST_6 = ("PID", "legalType", "postalCode", "curVal", "curImpVal", "taxAssess")
PANEL = "PID, legalType, zoneCat, curVal, curImpVal, year, preVal, preImpVal, FSA, fsaText"


def _in(years):
    return ", ".join(f"'{y}'" for y in years)


def _onehot(i, n):
    return f"repeat('0', CAST({i} AS BIGINT)) || '1' || repeat('0', CAST(({n}) - ({i}) - 1 AS BIGINT))"


def _legal(c):
    hot = ["100", "010", "001"]
    return "CASE " + " ".join(f"WHEN {c} = '{v}' THEN '{h}'" for v, h in zip(S.STANDIN_LEGAL, hot)) + f" ELSE {c} END"


def _zone_map(c):
    n = len(S.STANDIN_ZONE_CODES)
    hot = ["0" * i + "1" + "0" * (n - i - 1) for i in range(n)]
    pairs = list(zip(S.STANDIN_ZONE_NAMES, hot)) + list(zip(S.STANDIN_ZONE_CODES, hot))
    return "CASE " + " ".join(f"WHEN {c} = '{v}' THEN '{h}'" for v, h in pairs) + f" ELSE {c} END"


def _t02(c, missing="'CD'"):
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN instr({c}, '-') > 0 THEN split_part({c}, '-', 1) ELSE {missing} END"


def _t01(c):
    t = f"TRIM({c})"
    return f"CASE WHEN {t} IS NULL THEN NULL WHEN instr({t}, ' ') > 0 THEN split_part({t}, ' ', 1) END"


def _mean_half_up(x, p=4, s=2):
    """Exact mean of values with at most ``s`` decimals, rounded half-up."""
    k = 10 ** s
    t = f"CAST(SUM({x}) * {k} AS HUGEINT)"
    n = f"COUNT({x})"
    return (f"TRY_CAST(CAST(((2 * {t} + {n}) // (2 * {n})) AS DECIMAL(18,0)) "
            f"* CAST({1 / k} AS DECIMAL(3,{s})) AS DECIMAL({p},{s}))")


_GIVEN = {
    "PID": "CAST(o.o_custkey AS VARCHAR)",
    "legalType": "o.o_orderstatus",
    "folio": "CAST(o.o_orderkey AS VARCHAR)",
    "zoneName": "CASE WHEN o.o_orderkey % 17 = 0 THEN '' ELSE o.o_orderpriority END",
    "zoneCat": "CASE WHEN o.o_orderkey % 26 = 0 THEN '2-HIGH' WHEN o.o_orderkey % 13 = 0 THEN '3' END",
    "postalCode": f"CASE WHEN o.o_orderkey % 20 = 0 THEN o.pname ELSE rpad(o.pname, {S.STANDIN_POSTAL_LEN}, '.') END",
    "curVal": "CAST(s.cur AS VARCHAR)",
    "curImpVal": "CAST(s.imp AS VARCHAR)",
    "taxAssess": "CAST(o.yr AS VARCHAR)",
    "preVal": "CAST(p.cur AS VARCHAR)",
    "preImpVal": "CAST(p.imp AS VARCHAR)",
}

BASE = """
per_order AS (
  SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS ext,
         first(p_name ORDER BY l_linenumber, p_name NULLS FIRST) AS pname
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey),
o AS (
  SELECT orders.*, CAST(year(o_orderdate) AS INTEGER) AS yr, per_order.ext, per_order.pname
  FROM orders LEFT JOIN per_order ON o_orderkey = l_orderkey),
sums AS (
  SELECT o_custkey, yr, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS cur, SUM(ext) AS imp
  FROM o GROUP BY o_custkey, yr),
cy AS (
  SELECT CAST(o_custkey AS VARCHAR) AS PID, yr AS year, CAST(cur AS DOUBLE) AS curVal, CAST(imp AS DOUBLE) AS curImpVal
  FROM sums)"""

REGISTER = BASE + """,
register AS (
  SELECT """ + ",\n         ".join(f"COALESCE({_GIVEN.get(c, 'NULL')}, '') AS {c}" for c in REGISTER_COLUMNS) + """
  FROM o JOIN sums s ON o.o_custkey = s.o_custkey AND o.yr = s.yr
  LEFT JOIN sums p ON o.o_custkey = p.o_custkey AND o.yr = p.yr + 1)"""


def _valid(name, years, cols, require_zone, zone_exempt=()):
    order = ", ".join(c for c in cols if c not in ("PID", "taxAssess"))
    cond = f"COALESCE(TRIM(PID), '') <> '' AND length(TRIM(postalCode)) = {S.STANDIN_POSTAL_LEN}"
    if require_zone:
        exempt = f" OR taxAssess IN ({_in(zone_exempt)})" if zone_exempt else ""
        cond += f" AND (COALESCE(TRIM(zoneName), '') <> ''{exempt})"
    return f""",
{name} AS (
  SELECT {', '.join(cols)}, {_t01('postalCode')} AS FSA FROM (
    SELECT {', '.join(cols)}, row_number() OVER (PARTITION BY PID, taxAssess ORDER BY {order}) AS rn
    FROM register WHERE taxAssess IN ({_in(years)}) AND {cond}) WHERE rn = 1)"""


PANEL_SQL = REGISTER + _valid("main_valid", S.MAIN_YEARS, MAIN_10, True, [S.REFERENCE_YEAR]) + """,
ref_valid AS (SELECT * FROM main_valid WHERE taxAssess = '""" + str(S.REFERENCE_YEAR) + """'),
dict AS (
  SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS idx, COUNT(*) OVER () AS n
  FROM (SELECT DISTINCT FSA AS value FROM ref_valid WHERE FSA IS NOT NULL)),
dict_code AS (SELECT value, idx, """ + _onehot("idx", "n") + """ AS code FROM dict),
main AS (
  SELECT v.PID, """ + _legal("v.legalType") + """ AS legalType, """ + _zone_map("v.zc") + """ AS zoneCat,
         TRY_CAST(v.curVal AS DOUBLE) AS curVal, TRY_CAST(v.curImpVal AS DOUBLE) AS curImpVal,
         TRY_CAST(v.taxAssess AS INTEGER) AS year, TRY_CAST(v.preVal AS DOUBLE) AS preVal,
         TRY_CAST(v.preImpVal AS DOUBLE) AS preImpVal, d.code AS FSA, v.FSA AS fsaText
  FROM (SELECT *, CASE WHEN COALESCE(TRIM(zoneCat), '') = '' THEN """ + _t02("zoneName") + """ ELSE zoneCat END AS zc
        FROM main_valid) v LEFT JOIN dict_code d ON v.FSA = d.value)""" \
    + _valid("hist_valid", [S.BASE_YEAR, *S.HISTORY_YEARS], HIST_6, False) + """,
hist_rows AS (
  SELECT v.PID, """ + _legal("v.legalType") + """ AS legalType, TRY_CAST(v.curVal AS DOUBLE) AS curVal,
         TRY_CAST(v.curImpVal AS DOUBLE) AS curImpVal, TRY_CAST(v.taxAssess AS INTEGER) AS year, d.code AS FSA, v.FSA AS fsaText
  FROM hist_valid v LEFT JOIN dict_code d ON v.FSA = d.value),
zone_donor AS (
  SELECT PID, zoneCat FROM (
    SELECT PID, zoneCat, row_number() OVER (PARTITION BY PID ORDER BY year DESC, zoneCat DESC) AS rn FROM main)
  WHERE rn = 1),
base AS (
  SELECT h.PID, h.legalType, z.zoneCat, h.curVal, h.curImpVal, h.year,
         h.curVal * CAST(0.99 AS DOUBLE) AS preVal, h.curImpVal * CAST(0.99 AS DOUBLE) AS preImpVal, h.FSA, h.fsaText
  FROM hist_rows h JOIN zone_donor z ON h.PID = z.PID WHERE h.year = """ + str(S.BASE_YEAR) + """),
history AS (
  SELECT h.PID, h.legalType, z.zoneCat, h.curVal, h.curImpVal, h.year, h.pv AS preVal, h.piv AS preImpVal, h.FSA, h.fsaText
  FROM (SELECT *, lag(year) OVER w AS py, lag(curVal) OVER w AS pv, lag(curImpVal) OVER w AS piv
        FROM hist_rows WINDOW w AS (PARTITION BY PID ORDER BY year)) h
  JOIN zone_donor z ON h.PID = z.PID
  WHERE h.py = h.year - 1 AND h.year IN (""" + ", ".join(str(y) for y in S.HISTORY_YEARS) + """)),
panel AS (
  SELECT """ + PANEL + """ FROM main UNION ALL SELECT """ + PANEL + """ FROM base
  UNION ALL SELECT """ + PANEL + """ FROM history)"""

SERIES = """
conv_src AS (
  SELECT l_shipdate, CAST(CAST(l_tax AS DECIMAL(4,2)) * 10 + 1 AS DECIMAL(6,2)) AS rate
  FROM lineitem WHERE l_returnflag <> 'R'),
conv_month AS (
  SELECT strftime(l_shipdate, '%Y/%m') AS month, """ + _mean_half_up("rate") + """ AS conversionrate
  FROM conv_src GROUP BY 1),
conv_year AS (
  SELECT CAST(split_part(month, '/', 1) AS INTEGER) AS year, """ + _mean_half_up("conversionrate") + """ AS conversionrate
  FROM conv_month GROUP BY 1),
oil_src AS (
  SELECT l_shipdate, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL ELSE l_quantity END AS price
  FROM lineitem),
oil_year AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, AVG(price) AS oilprice
  FROM oil_src WHERE price IS NOT NULL GROUP BY 1),
int_src AS (
  SELECT l_shipdate, CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(4,2)) AS r FROM lineitem),
int_year AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, """ + _mean_half_up("r") + """ AS interestrates
  FROM int_src WHERE l_shipdate >= DATE '1995-01-01' GROUP BY 1),
yearly AS (
  SELECT year, interestrates, ROUND(oilprice, 6) AS oilprice, conversionrate
  FROM int_year JOIN oil_year USING (year) JOIN conv_year USING (year))"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().lstrip(",") for c in ctes)


def _split(key_sql, fractions, names=("training", "testing")):
    edge = int(round(fractions[0] / sum(fractions) * 10000))
    b = f"(('0x' || substr(md5(concat_ws('|', {key_sql})), 1, 8))::BIGINT % 10000)"
    return f"CASE WHEN {b} < {edge} THEN '{names[0]}' ELSE '{names[1]}' END"


def _band(c):
    bounds = (300000, 700000, 1000000, 1400000, 1600000)
    arms = " ".join(f"WHEN {c} >= {b} THEN '{k + 2}'" for k, b in reversed(list(enumerate(bounds))))
    return f"CASE WHEN {c} IS NULL THEN NULL {arms} ELSE '1' END"


LI_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
# Queries whose rate columns are decimal(4,2); the check presents them as DOUBLE.
DECIMAL_OUTPUT = {
    "a01_mean_by_month": ("conversionrate",),
    "a02_resample_month_to_year": ("conversionrate",),
    "a04_mean_by_year": ("interestrates",),
    "c05_yearly_indicators": ("interestrates", "conversionrate"),
    "c06_monthly_indicators": ("conversionrate",),
    "c07_write_model_sets": ("interestrates", "conversionrate"),
    "j03_join_indicators": ("interestrates",),
    "j04_join_indicators": ("interestrates", "conversionrate"),
    "j05_model_table": ("interestrates", "conversionrate"),
    "t06_split_bucket": ("conversionrate",),
}
CONV_TEXT = ("strftime(l_shipdate, '%-m/%-d/%Y')",
             "CASE WHEN l_returnflag = 'R' THEN 'Bank holiday' ELSE "
             "CAST(CAST(CAST(l_tax AS DECIMAL(4,2)) * 10 + 1 AS DECIMAL(6,2)) AS VARCHAR) END")
OIL_PRICE_TEXT = ("CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN '.' "
                  "ELSE CAST(CAST(l_quantity AS DECIMAL(10,2)) AS VARCHAR) END")
INT_TEXT = "CAST(CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(6,2)) AS VARCHAR)"
ONE_FEATURE = w(BASE, """
b AS (SELECT *, CAST(""" + _band("curVal") + """ AS INTEGER) - CAST(1 AS DOUBLE) AS class FROM cy),
coef AS (SELECT class, regr_intercept(curVal, curImpVal) AS b0, regr_slope(curVal, curImpVal) AS b1 FROM b GROUP BY class),
pred AS (SELECT b.*, coef.b0 + coef.b1 * b.curImpVal AS prediction FROM b JOIN coef USING (class))""")

# Bands by the most frequent one of the legal type in tr; te2 has te's rows with the predicted band and
# the part of the split inside it; scored has the second part with its band's regression.
TWO_STAGE = """
pb AS (SELECT legalType, arg_max(band, c) AS predicted_band FROM (SELECT legalType, band, COUNT(*) AS c FROM tr GROUP BY ALL) GROUP BY legalType),
te2 AS (SELECT te.*, predicted_band, """ + _split("CAST(CAST(predicted_band AS INTEGER) AS VARCHAR), PID, CAST(year AS VARCHAR)",
                                                    (0.7, 0.3), ("fit", "score")) + """ AS part FROM te JOIN pb USING (legalType)),
co AS (SELECT predicted_band, regr_intercept(curVal, curImpVal) AS b0, regr_slope(curVal, curImpVal) AS b1
       FROM te2 WHERE part = 'fit' GROUP BY predicted_band),
scored AS (SELECT te2.*, b0 + b1 * curImpVal AS predicted_value FROM te2 LEFT JOIN co USING (predicted_band) WHERE part = 'score')"""


def oracles() -> dict[str, str]:
    reg_cols = ", ".join(REGISTER_COLUMNS)
    hist_cols = ", ".join(f"NULL::VARCHAR AS {c}" if c in HISTORY_MISSING else c for c in REGISTER_COLUMNS)
    q = {}
    q["s01_scan_register"] = w(REGISTER) + f" SELECT {reg_cols} FROM register"
    q["s02_scan_register_hist"] = w(REGISTER) + f" SELECT {hist_cols} FROM register"
    q["s03_scan_years"] = w(REGISTER) + f" SELECT {reg_cols} FROM register WHERE taxAssess IN ({_in(S.MAIN_YEARS)})"
    q["s04_scan_rates"] = (f"SELECT {CONV_TEXT[0]} AS date, CAST(l_quantity AS VARCHAR) AS USD, {CONV_TEXT[1]} AS rate, "
                           "NULL::VARCHAR AS reciprate FROM lineitem")
    q["s05_scan_header_only"] = (f"SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, {INT_TEXT} AS \"5y-fixed-posted\", "
                                 "CAST(CAST(CAST(l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(6,2)) AS VARCHAR) "
                                 "AS \"1y-fixed-posted\" FROM lineitem")
    q["s06_scan_whitespace"] = f"SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, {OIL_PRICE_TEXT} AS oilprice FROM lineitem"
    q["s08_scan_parquet"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem"
    q["s09_write_parquet"] = w(BASE) + " SELECT PID, year, curVal, curImpVal FROM cy"
    q["s10_write_delimited"] = w(REGISTER) + " SELECT concat_ws(' ', PID, taxAssess, legalType, curVal) AS value FROM register"
    q["s11_as_view"] = w(REGISTER) + (" SELECT PID, legalType, zoneName, curVal, taxAssess FROM register "
                                      "WHERE NOT (PID = '') AND length(trim(zoneName)) = 6")
    q["s13_row_count"] = "SELECT COUNT(*) AS n FROM orders"
    q["s14_preview"] = w(BASE) + " SELECT PID, year, curVal, curImpVal FROM cy ORDER BY PID, year LIMIT 20"

    q["p01_project"] = w(REGISTER) + f" SELECT {', '.join(MAIN_10)} FROM register"
    q["p02_project_rename"] = w(REGISTER) + " SELECT PID, legalType, curVal, taxAssess AS year FROM register"
    q["p05_impute_prior"] = w(BASE) + (" SELECT PID, year, curVal, curImpVal, curVal * CAST(0.99 AS DOUBLE) AS preVal, "
                                       f"curImpVal * CAST(0.99 AS DOUBLE) AS preImpVal FROM cy WHERE year = {S.BASE_YEAR}")
    q["p06_cast_numeric"] = w(REGISTER) + (" SELECT PID, folio, " + ", ".join(
        f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ("curVal", "curImpVal", "taxAssess", "preVal", "preImpVal"))
        + " FROM register")
    q["p07_fill_from"] = w(REGISTER) + (" SELECT folio, zoneName, CASE WHEN COALESCE(TRIM(zoneCat), '') = '' THEN "
                                        + _t02("zoneName") + " ELSE zoneCat END AS zoneCat FROM register")
    q["p08_map_values"] = ("SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN '2-HIGH' "
                           "WHEN '2-HIGH' THEN '3-MEDIUM' ELSE o_orderpriority END AS o_orderpriority FROM orders")

    q["w01_has_key"] = w(REGISTER) + " SELECT folio, postalCode FROM register WHERE COALESCE(TRIM(postalCode), '') <> ''"
    q["w02_has_length"] = ("SELECT o_orderkey, o_orderpriority FROM orders "
                           "WHERE COALESCE(length(TRIM(o_orderpriority)), 0) = 6")
    q["w03_has_value"] = w(REGISTER) + " SELECT folio, zoneName FROM register WHERE COALESCE(TRIM(zoneName), '') <> ''"
    q["w04_numeric_prefix"] = (f"SELECT * FROM (SELECT {CONV_TEXT[0]} AS date, {CONV_TEXT[1]} AS rate FROM lineitem) "
                               "WHERE regexp_matches(rate, '^[0-9]+')")
    q["w05_not_null"] = (f"SELECT * FROM (SELECT {CONV_TEXT[0]} AS date, TRY_CAST({CONV_TEXT[1]} AS DOUBLE) AS rate "
                         "FROM lineitem) WHERE rate IS NOT NULL")
    q["w06_complete_cases"] = w(REGISTER) + (" SELECT * FROM (SELECT folio, " + ", ".join(
        f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ("curVal", "curImpVal", "preVal", "preImpVal"))
        + " FROM register) WHERE curVal IS NOT NULL AND curImpVal IS NOT NULL AND preVal IS NOT NULL "
          "AND preImpVal IS NOT NULL")
    q["w07_drop_sentinel"] = (f"SELECT * FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, {OIL_PRICE_TEXT} "
                              "AS oilprice FROM lineitem) WHERE oilprice <> '.'")
    q["w08_date_from"] = (f"SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, {INT_TEXT} AS \"5y-fixed-posted\" "
                          "FROM lineitem WHERE l_shipdate >= DATE '1996-01-01'")
    q["w09_date_between"] = (f"SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, {INT_TEXT} AS \"5y-fixed-posted\" "
                             "FROM lineitem WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '2001-01-01'")
    q["w09_date_between_text_bounds"] = (f"SELECT * FROM (SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, "
                                         f"{INT_TEXT} AS \"5y-fixed-posted\" FROM lineitem) "
                                         "WHERE date >= '1996-01' AND date <= '2000-12'")
    q["w10_exclude_year"] = (f"SELECT {CONV_TEXT[0]} AS date, strftime(l_shipdate, '%Y/%m') AS month, "
                             f"{CONV_TEXT[1]} AS rate FROM lineitem WHERE year(l_shipdate) <> 2001")
    q["w12_valid_vector"] = w(PANEL_SQL) + (" SELECT PID, year, zoneCat || legalType || FSA AS code, 17 AS size FROM main "
                                            "WHERE length(zoneCat || legalType || FSA) = 16")

    q["j01_backfill_attribute"] = w(REGISTER, f"""
donor AS (SELECT PID, zoneName FROM (
  SELECT PID, zoneName, row_number() OVER (PARTITION BY PID ORDER BY CAST(taxAssess AS INTEGER) DESC, zoneName DESC) AS rn
  FROM register WHERE taxAssess IN ({_in(S.MAIN_YEARS)})) WHERE rn = 1)""") + (
        f" SELECT cy.PID, cy.year, cy.curVal, cy.curImpVal, donor.zoneName FROM cy JOIN donor ON cy.PID = donor.PID "
        f"WHERE cy.year < {min(S.MAIN_YEARS)}")
    q["j01_backfill_attribute_left"] = q["j01_backfill_attribute"].replace(
        "FROM cy JOIN donor ON cy.PID = donor.PID", "FROM cy LEFT JOIN donor ON cy.PID = donor.PID")
    q["j02_prior_value"] = w(BASE) + """ SELECT PID, year, curVal, curImpVal, pv AS preVal, piv AS preImpVal FROM (
  SELECT *, lag(year) OVER w AS py, lag(curVal) OVER w AS pv, lag(curImpVal) OVER w AS piv
  FROM cy WINDOW w AS (PARTITION BY PID ORDER BY year)) WHERE py = year - 1"""
    q["j02_prior_value_base_year"] = w(BASE) + f""" SELECT c.PID, c.year, c.curVal, c.curImpVal,
  b.curVal AS preVal, b.curImpVal AS preImpVal FROM cy c JOIN cy b ON c.PID = b.PID AND b.year = {S.BASE_YEAR}
  WHERE c.year <> {S.BASE_YEAR}"""
    q["j03_join_indicators"] = w(SERIES) + (" SELECT year, interestrates, ROUND(oilprice, 6) AS oilprice "
                                            "FROM int_year JOIN oil_year USING (year)")
    q["j04_join_indicators"] = w(SERIES) + " SELECT * FROM yearly"
    q["j05_model_table"] = w(BASE, SERIES) + " SELECT * FROM cy JOIN yearly USING (year)"

    q["d01_dedup_by_key"] = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey, o_orderstatus,
      o_totalprice, o_orderpriority) AS rn FROM orders) WHERE rn = 1"""
    q["d02_distinct_values"] = f"SELECT DISTINCT {_t01('p_name')} AS FSA FROM part"
    q["a01_mean_by_month"] = w(SERIES) + " SELECT month, conversionrate FROM conv_month"
    q["a02_resample_month_to_year"] = w(SERIES) + " SELECT year, conversionrate FROM conv_year"
    q["a03_mean_by_year"] = w(SERIES) + " SELECT year, ROUND(oilprice, 6) AS oilprice FROM oil_year"
    q["a04_mean_by_year"] = w(SERIES) + " SELECT year, interestrates FROM int_year"
    q["a05_mean_by_month"] = w(SERIES) + (" SELECT strftime(l_shipdate, '%Y/%m') AS month, "
                                          "ROUND(AVG(CAST(r AS DOUBLE)), 6) AS interestrates FROM int_src GROUP BY 1")
    q["a06_quality_report"] = w(REGISTER) + " SELECT COUNT(*) AS rows, " + ", ".join(
        f"count_if({c} IS NULL OR TRIM(CAST({c} AS VARCHAR)) = '') AS empty_{c}" for c in REGISTER_COLUMNS) \
        + " FROM register"
    stats = []
    for name, f in (("count", "CAST(COUNT({c}) AS DOUBLE)"), ("mean", "AVG({c})"), ("stddev", "STDDEV_SAMP({c})"),
                    ("min", "MIN({c})"), ("max", "MAX({c})")):
        cols = ", ".join(f"ROUND(CAST({f.format(c=c)} AS DOUBLE), 6) AS {c}" for c in ("curVal", "curImpVal", "year"))
        stats.append(f"SELECT '{name}' AS statistic, {cols} FROM cy")
    q["a07_describe_numeric"] = w(BASE) + " " + " UNION ALL ".join(stats)
    q["a08_correlate_with"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column, ROUND(covar_samp(l_extendedprice, {c}) / "
        f"(stddev_samp(l_extendedprice) * stddev_samp({c})), 6) AS correlation FROM lineitem" for c in LI_NUM)

    q["u01_stack_years"] = w(PANEL_SQL) + f" SELECT {PANEL} FROM main UNION ALL SELECT {PANEL} FROM base"
    q["u02_stack_years"] = w(REGISTER) + (
        f" SELECT PID, taxAssess, TRY_CAST(preVal AS DOUBLE) AS preVal FROM register WHERE taxAssess <> '{S.BASE_YEAR}'"
        f" UNION ALL SELECT PID, taxAssess, TRY_CAST(curVal AS DOUBLE) * CAST(0.99 AS DOUBLE) AS preVal FROM register "
        f"WHERE taxAssess = '{S.BASE_YEAR}'")

    q["t01_prefix_before"] = f"SELECT p_partkey, {_t01('p_name')} AS FSA FROM part"
    q["t02_prefix_before"] = w(REGISTER) + f" SELECT folio, {_t02('zoneName')} AS zoneCat FROM register"
    q["t03_onehot_text"] = f"SELECT p_partkey, {_onehot('p_size - 1', 50)} AS code FROM part"
    q["t04_onehot_text"] = f"SELECT n_nationkey, {_onehot('n_nationkey', '(SELECT COUNT(*) FROM nation)')} AS code FROM nation"
    q["t05_month_bucket"] = f"SELECT {CONV_TEXT[0]} AS date, strftime(l_shipdate, '%Y/%m') AS month FROM lineitem"
    q["t06_split_bucket"] = w(SERIES) + (" SELECT CAST(split_part(month, '/', 1) AS INTEGER) AS year, "
                                         "CAST(split_part(month, '/', 2) AS INTEGER) AS month, conversionrate FROM conv_month")
    q["t07_split_bucket"] = ("SELECT strftime(l_shipdate, '%Y/%m') AS bucket, CAST(year(l_shipdate) AS INTEGER) AS year, "
                             "CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem")
    q["t08_year_bucket"] = "SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem"
    q["t09_month_bucket"] = "SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y/%m') AS month FROM lineitem"
    q["t11_concat_codes"] = w(PANEL_SQL) + " SELECT PID, year, zoneCat || legalType || FSA AS LegalZoneFSA FROM main"
    q["t12_concat_codes"] = w(PANEL_SQL) + " SELECT concat_ws(',', PID, CAST(year AS VARCHAR), zoneCat, legalType, FSA) AS line FROM main"
    q["t13_code_to_array"] = w(PANEL_SQL) + """ SELECT PID, year, CASE WHEN length(code) = 16 THEN
  list_concat(list_transform(range(1, length(code) + 1), lambda i: TRY_CAST(substring(code, i, 1) AS DOUBLE)),
              [CAST(year AS DOUBLE)]) ELSE []::DOUBLE[] END AS vector
FROM (SELECT PID, year, zoneCat || legalType || FSA AS code FROM main)"""
    q["t14_band_value"] = w(BASE) + f" SELECT PID, year, {_band('curVal')} AS band FROM cy"

    fsa_dict = f"""
fsa AS (SELECT p_partkey, {_t01('p_name')} AS FSA FROM part),
d AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS idx, COUNT(*) OVER () AS n
      FROM (SELECT DISTINCT FSA AS value FROM fsa WHERE FSA IS NOT NULL))"""
    q["f01_fit_categories"] = w(fsa_dict) + f" SELECT value, idx, {_onehot('idx', 'n')} AS code FROM d"
    q["f01_encode_categories"] = w(fsa_dict) + f" SELECT p_partkey, {_onehot('idx', 'n')} AS FSA FROM fsa LEFT JOIN d ON FSA = value"
    q["f02_encode_zone"] = w(REGISTER) + (f" SELECT folio, {_zone_map('z')} AS zoneCat FROM (SELECT folio, CASE WHEN "
                                          f"COALESCE(TRIM(zoneCat), '') = '' THEN {_t02('zoneName')} ELSE zoneCat END AS z FROM register)")
    half = fsa_dict.replace("WHERE FSA IS NOT NULL", "WHERE FSA < 'm'")
    q["f01_encode_categories_null"] = w(half) + f" SELECT p_partkey, {_onehot('idx', 'n')} AS FSA, FSA AS fsaText FROM fsa LEFT JOIN d ON FSA = value"
    q["f01_encode_categories_keep"] = w(half) + f" SELECT p_partkey, COALESCE({_onehot('idx', 'n')}, FSA) AS FSA FROM fsa LEFT JOIN d ON FSA = value"
    q["f08_pca_project"] = ("SELECT vec_id, ROUND(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE))), 4) "
                            "AS squared_length FROM embeddings")
    scaled = [f"(({c} - avg_{c}) / sd_{c})" for c in ("preVal", "preImpVal", "oilprice", "interestrates", "conversionrate")]
    numbers = ["((curImpVal - avg_curImpVal) / sd_curImpVal)", "((year - lo) / (hi - lo + 5))", *scaled]
    stat = ", ".join(f"AVG({c}) AS avg_{c}, STDDEV_SAMP({c}) AS sd_{c}" for c in
                     ("curImpVal", "preVal", "preImpVal", "oilprice", "interestrates", "conversionrate"))
    q["f10_feature_pipeline"] = w(PANEL_SQL, SERIES, """
mt AS (SELECT PID, zoneCat, legalType, FSA, curImpVal, preVal, preImpVal, CAST(year AS DOUBLE) AS year, year AS y, oilprice,
              CAST(interestrates AS DOUBLE) AS interestrates, CAST(conversionrate AS DOUBLE) AS conversionrate
       FROM panel JOIN yearly USING (year)),
st AS (SELECT """ + stat + """, MIN(year) AS lo, MAX(year) AS hi FROM mt WHERE """ + _split("PID, CAST(y AS VARCHAR)", (0.6, 0.4)) + """ = 'training')""") + f"""
SELECT PID, y AS year, list_transform(list_concat(list_transform(range(1, length(code) + 1), lambda i: CAST(substring(code, i, 1) AS DOUBLE)),
  [{", ".join(numbers)}]), lambda x: ROUND(x, 4) + CAST(0 AS DOUBLE)) AS features
FROM (SELECT *, zoneCat || legalType || FSA AS code FROM mt, st
      WHERE regexp_matches(zoneCat, '^0*10*$') AND length(zoneCat) = {len(S.STANDIN_ZONE_CODES)}
        AND regexp_matches(legalType, '^0*10*$') AND length(legalType) = {len(S.STANDIN_LEGAL)}
        AND regexp_matches(FSA, '^0*10*$') AND length(FSA) = (SELECT MAX(n) FROM dict)
        AND curImpVal IS NOT NULL AND preVal IS NOT NULL AND preImpVal IS NOT NULL)"""
    q["f03_encode_legal"] = f"SELECT o_orderkey, {_legal('o_orderstatus')} AS o_orderstatus FROM orders"
    q["f05_standardize"] = "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"ROUND(({c} - AVG({c}) OVER ()) / STDDEV_SAMP({c}) OVER (), 6) + CAST(0 AS DOUBLE) AS {c}" for c in LI_NUM) + " FROM lineitem"
    q["f06_scale_year"] = ("SELECT l_orderkey, l_linenumber, ROUND((year(l_shipdate) - MIN(year(l_shipdate)) OVER ()) / "
                           "CAST(MAX(year(l_shipdate)) OVER () - MIN(year(l_shipdate)) OVER () + 5 AS DOUBLE), 6) AS year "
                           "FROM lineitem")
    q["f07_weight_by_correlation"] = "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"ROUND({c} * (covar_samp(l_extendedprice, {c}) OVER () / (stddev_samp(l_extendedprice) OVER () * "
        f"stddev_samp({c}) OVER ())), 6) + CAST(0 AS DOUBLE) AS {c}" for c in LI_NUM) + " FROM lineitem"
    q["f09_assemble_features"] = w(PANEL_SQL, SERIES) + """ SELECT PID, year, CASE WHEN code IS NULL THEN NULL ELSE
  list_concat(list_transform(range(1, length(code) + 1), lambda i: TRY_CAST(substring(code, i, 1) AS DOUBLE)),
              [curImpVal, CAST(year AS DOUBLE)]) END AS features
FROM (SELECT m.*, zoneCat || legalType || FSA AS code FROM main m JOIN yearly USING (year))"""

    q["r01_hash_split"] = f"SELECT o_orderkey, {_split('CAST(o_orderkey AS VARCHAR)', (0.6, 0.4))} AS split FROM orders"
    q["r02_hash_split"] = w(BASE) + (f" SELECT PID, year, band, {_split('band, PID, CAST(year AS VARCHAR)', (0.7, 0.3))}"
                                     f" AS split FROM (SELECT *, {_band('curVal')} AS band FROM cy)")

    q["r05_stage_tables"] = w(BASE) + (" SELECT year, COUNT(*) AS n, ROUND(SUM(curVal), 2) AS total, MAX(curVal) AS largest FROM cy GROUP BY year")
    q["m04_fit_per_class_regression"] = w(BASE, """
b AS (SELECT *, CAST(""" + _band("curVal") + """ AS INTEGER) - CAST(1 AS DOUBLE) AS class FROM cy)""") + (
        " SELECT class, regr_count(curVal, curImpVal) AS n, ROUND(regr_intercept(curVal, curImpVal), 6) AS intercept, "
        "ROUND(regr_slope(curVal, curImpVal), 6) AS slope FROM b GROUP BY class")
    q["m04_fit_per_class_regression_two"] = w(BASE, """
b AS (SELECT *, CAST(""" + _band("curVal") + """ AS INTEGER) - CAST(1 AS DOUBLE) AS class FROM cy WHERE curImpVal IS NOT NULL),
m AS (SELECT class, COUNT(*) AS n, AVG(curVal) AS my, AVG(curImpVal) AS m1, AVG(year) AS m2,
             covar_pop(curImpVal, curImpVal) AS c11, covar_pop(curImpVal, year) AS c12, covar_pop(year, year) AS c22,
             covar_pop(curImpVal, curVal) AS c1y, covar_pop(year, curVal) AS c2y FROM b GROUP BY class),
s AS (SELECT *, CASE WHEN c11 = 0 THEN 0 WHEN c22 = 0 THEN c1y / c11 WHEN c12 * c12 > (1 - 1e-9) * c11 * c22 THEN c1y / (2 * c11)
                     ELSE (c1y * c22 - c2y * c12) / (c11 * c22 - c12 * c12) END AS b1,
                CASE WHEN c22 = 0 THEN 0 WHEN c11 = 0 THEN c2y / c22 WHEN c12 * c12 > (1 - 1e-9) * c11 * c22 THEN c2y / (2 * c22)
                     ELSE (c2y * c11 - c1y * c12) / (c11 * c22 - c12 * c12) END AS b2 FROM m)""") + (
        " SELECT class, n, ROUND(my - b1 * m1 - b2 * m2, 3) AS intercept, ROUND(b1, 3) AS slope, ROUND(b2, 3) AS year_slope FROM s")
    legal = w(PANEL_SQL, """
f AS (SELECT PID, year, legalType, curVal, curImpVal, CAST(""" + _band("curVal") + """ AS INTEGER) - CAST(1 AS DOUBLE) AS band
      FROM panel WHERE curImpVal IS NOT NULL)""")
    q["m02_fit_band_classifier"] = legal + (" SELECT legalType, band, COUNT(*) AS n, ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY legalType) "
                                            "AS DOUBLE), 6) AS share, true AS given FROM f GROUP BY legalType, band")
    q["m03_predict_band"] = legal + (" SELECT PID, year, band, (SELECT arg_max(g.band, g.c) FROM (SELECT legalType, band, COUNT(*) AS c FROM f "
                                     "GROUP BY ALL) g WHERE g.legalType = f.legalType) AS predicted_band FROM f")
    in_set = _split("PID, CAST(year AS VARCHAR)", (0.6, 0.4))
    q["m05_two_stage_model"] = legal + f""",
tr AS (SELECT * FROM f WHERE {in_set} = 'training'), te AS (SELECT * FROM f WHERE {in_set} = 'testing'), {TWO_STAGE}
SELECT PID, year, band, predicted_band, ROUND(predicted_value, 1) AS predicted_value FROM scored"""
    complete = " AND ".join(f"{c} IS NOT NULL" for c in ("curVal", "curImpVal", "preVal", "preImpVal", "legalType"))
    q["c08_train_value_model"] = w(PANEL_SQL, SERIES, f"""
f AS (SELECT PID, year, legalType, curVal, curImpVal, CAST({_band("curVal")} AS INTEGER) - CAST(1 AS DOUBLE) AS band
      FROM panel JOIN yearly USING (year) WHERE {complete})""") + f""",
tr AS (SELECT * FROM f WHERE {in_set} = 'training'), te AS (SELECT * FROM f WHERE {in_set} = 'testing'), {TWO_STAGE}
SELECT 'accuracy' AS metric, NULL::DOUBLE AS class, COUNT(*) AS n, NULL::BIGINT AS n_unscored,
       ROUND(AVG(CAST(band = predicted_band AS DOUBLE)), 4) AS value FROM te2
UNION ALL SELECT 'rmse', predicted_band, COUNT(*), COUNT(*) - COUNT(predicted_value), ROUND(SQRT(AVG(POWER(curVal - predicted_value, 2))), 4)
FROM scored GROUP BY predicted_band
UNION ALL SELECT 'left_out', NULL::DOUBLE, 0, NULL::BIGINT, NULL::DOUBLE"""
    mapped = f"""regexp_matches(zoneCat, '^0*10*$') AND length(zoneCat) = {len(S.STANDIN_ZONE_CODES)}
        AND regexp_matches(legalType, '^0*10*$') AND length(legalType) = {len(S.STANDIN_LEGAL)}
        AND regexp_matches(FSA, '^0*10*$') AND length(FSA) = (SELECT MAX(n) FROM dict)"""
    present = " AND ".join(f"{c} IS NOT NULL" for c in ("curVal", "curImpVal", "preVal", "preImpVal", "zoneCat", "legalType", "FSA"))
    q["c08_train_value_model_full"] = w(PANEL_SQL, SERIES, f"""
f AS (SELECT {in_set} AS part, {mapped} AS mapped, CAST({_band("curVal")} AS INTEGER) - CAST(1 AS DOUBLE) AS band
      FROM panel JOIN yearly USING (year) WHERE {present})""") + """,
k AS (SELECT unnest(range(0, (SELECT CAST(MAX(band) AS INTEGER) + 1 FROM f WHERE mapped AND part = 'training'))) AS class)
SELECT 'classifier' AS equation, CAST(class AS DOUBLE) AS class, (SELECT COUNT(*) FROM f WHERE mapped AND part = 'training') AS n, 0.0::DOUBLE AS score FROM k
UNION ALL SELECT 'regression', NULL::DOUBLE, COUNT(*), 0.0::DOUBLE FROM f WHERE mapped AND part = 'testing'
UNION ALL SELECT 'left_out', NULL::DOUBLE, COUNT(*), 0.0::DOUBLE FROM f WHERE NOT mapped AND part = 'testing'"""
    q["e01_accuracy"] = w(BASE) + f""" SELECT COUNT(*) AS n, ROUND(AVG(CAST(label = prediction AS DOUBLE)), 6) AS accuracy
FROM (SELECT {_band('curVal')} AS label, {_band('pv')} AS prediction FROM (
  SELECT *, lag(year) OVER w AS py, lag(curVal) OVER w AS pv FROM cy WINDOW w AS (PARTITION BY PID ORDER BY year))
  WHERE py = year - 1)"""
    q["e02_rmse"] = ONE_FEATURE + " SELECT COUNT(*) AS n, ROUND(SQRT(AVG(POWER(curVal - prediction, 2))), 4) AS rmse FROM pred"
    q["e03_rmse_by_class"] = ONE_FEATURE + (" SELECT class, COUNT(*) AS n, COUNT(*) - COUNT(prediction) AS n_unscored, ROUND(SQRT(AVG(POWER(curVal - prediction, 2))), 4)"
                                            " AS rmse FROM pred GROUP BY class")

    q["c01_clean_main_year"] = w(PANEL_SQL) + f" SELECT {PANEL} FROM main"
    q["c02_clean_base_year"] = w(PANEL_SQL) + f" SELECT {PANEL} FROM base"
    q["c03_clean_history"] = w(PANEL_SQL) + f" SELECT {PANEL} FROM history"
    q["c04_build_panel"] = w(PANEL_SQL) + f" SELECT {PANEL} FROM panel"
    q["c03_clean_history_base_year"] = w(PANEL_SQL) + f""" SELECT h.PID, h.legalType, z.zoneCat, h.curVal,
  h.curImpVal, h.year, b.curVal AS preVal, b.curImpVal AS preImpVal, h.FSA, h.fsaText
FROM hist_rows h JOIN hist_rows b ON h.PID = b.PID AND b.year = {S.BASE_YEAR}
JOIN zone_donor z ON h.PID = z.PID
WHERE h.year IN ({", ".join(str(y) for y in S.HISTORY_YEARS)})"""
    q["c05_yearly_indicators"] = w(SERIES) + " SELECT * FROM yearly"
    q["c06_monthly_indicators"] = w(SERIES, """
int_month AS (
  SELECT strftime(l_shipdate, '%Y/%m') AS month, ROUND(AVG(CAST(r AS DOUBLE)), 6) AS interestrates FROM int_src
  WHERE l_shipdate >= DATE '1995-01-01' AND l_shipdate < DATE '2001-01-01' GROUP BY 1),
conv_month_ex AS (
  SELECT strftime(l_shipdate, '%Y/%m') AS month, """ + _mean_half_up("rate") + """ AS conversionrate
  FROM conv_src WHERE year(l_shipdate) <> 2001 GROUP BY 1),
oil_rows AS (SELECT strftime(l_shipdate, '%Y/%m') AS month, price AS oilprice FROM oil_src)""") + """
SELECT CAST(split_part(month, '/', 1) AS INTEGER) AS year, CAST(split_part(month, '/', 2) AS INTEGER) AS month,
       interestrates, oilprice, conversionrate
FROM oil_rows JOIN int_month USING (month) JOIN conv_month_ex USING (month)"""
    q["c07_write_model_sets"] = w(PANEL_SQL, SERIES) + (
        f" SELECT panel.*, interestrates, oilprice, conversionrate, "
        f"{_split('PID, CAST(panel.year AS VARCHAR)', (0.6, 0.4))} AS split FROM panel JOIN yearly USING (year)")
    return q
