"""Registered quality, drift and bias queries (J, K). Baseline = flights of
1995-1998, current = flights of 1999 on (a period split of the whole
raw table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyframe.operators import bias as BI
from skyframe.operators import quality as QY
from skyframe.plans.output import present
from skyframe.plans.q_flights import raw
from skyframe.plans.registry import query, with_flights

NUM = ["dep_delay", "arr_delay", "distance", "temp", "humid", "wind_dir", "wind_speed", "pressure"]
CAT = ["airline", "route", "origin"]
PERIODS = """
, base AS (SELECT * FROM v_flights WHERE year <= 1998),
cur AS (SELECT * REPLACE (temp + 0.5 AS temp, distance * 1.3 AS distance,
    CASE WHEN l_orderkey % 7 = 0 THEN humid - 100 ELSE humid END AS humid,
    CASE WHEN l_orderkey % 10 = 0 THEN 'ATLANTIS' ELSE origin END AS origin) FROM v_flights WHERE year >= 1999)"""


def periods(spark, sf_dir):
    """Flights up to 1998, and later ones with a shifted type (temp), scale
    (distance), sign (humid) and an origin the baseline does not know."""
    df = raw(spark, sf_dir)
    cur = df.filter(F.col("year") >= 1999).withColumns({
        "temp": F.col("temp") + 0.5, "distance": F.col("distance") * 1.3,
        "humid": F.when(F.col("l_orderkey") % 7 == 0, F.col("humid") - 100).otherwise(F.col("humid")),
        "origin": F.when(F.col("l_orderkey") % 10 == 0, "ATLANTIS").otherwise(F.col("origin"))})
    return df.filter(F.col("year") <= 1998), cur


def _profile_sql(src, cols_num, cols_cat):
    parts = []
    for c in cols_num:
        parts.append(f"""SELECT '{c}' AS feature,
  CASE WHEN count(*) FILTER (WHERE CAST({c} AS DOUBLE) <> floor(CAST({c} AS DOUBLE))) > 0 THEN 'Fractional' ELSE 'Integral' END AS inferred_type,
  count({c}) / count(*) AS completeness, avg(CAST({c} AS DOUBLE)) AS mean, min(CAST({c} AS DOUBLE)) AS min,
  max(CAST({c} AS DOUBLE)) AS max, count(DISTINCT {c}) AS n_distinct, min({c}) >= 0 AS is_non_negative FROM {src}""")
    for c in cols_cat:
        parts.append(f"""SELECT '{c}' AS feature, 'String' AS inferred_type, count({c}) / count(*) AS completeness,
  CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
  count(DISTINCT {c}) AS n_distinct, CAST(NULL AS BOOLEAN) AS is_non_negative FROM {src}""")
    return "\nUNION ALL\n".join(parts)


PROFILE_CTES = PERIODS + f"""
, bp AS ({_profile_sql('base', NUM, CAT)}),
cp AS ({_profile_sql('cur', NUM, CAT)})"""


@query("profile_baseline", with_flights(PERIODS + f"""
SELECT feature, inferred_type, round(completeness, 6) AS completeness, round(mean, 6) AS mean,
       round(min, 6) AS min, round(max, 6) AS max, n_distinct, is_non_negative
FROM ({_profile_sql('base', NUM, CAT)}) t"""))
def q_profile(spark, sf_dir):
    """J1 + J2: baseline statistics and suggested constraints."""
    base, _ = periods(spark, sf_dir)
    return present(QY.profile(base, NUM + CAT))


def _ks_sql(c):
    return f"""SELECT '{c}' AS feature, max(abs(cb / tb - cc / tc)) AS distance FROM (
  SELECT sum(nb) OVER (ORDER BY v) AS cb, sum(nc) OVER (ORDER BY v) AS cc,
         sum(nb) OVER () AS tb, sum(nc) OVER () AS tc FROM (
    SELECT v, coalesce(nb, 0) AS nb, coalesce(nc, 0) AS nc FROM
      (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS nb FROM base WHERE {c} IS NOT NULL GROUP BY 1) b
      FULL OUTER JOIN (SELECT CAST({c} AS DOUBLE) AS v, count(*) AS nc FROM cur WHERE {c} IS NOT NULL GROUP BY 1) c
      USING (v)) u) w"""


def _linf_sql(c):
    return f"""SELECT '{c}' AS feature, max(abs(nb / tb - nc / tc)) AS distance FROM (
  SELECT coalesce(nb, 0) AS nb, coalesce(nc, 0) AS nc, sum(coalesce(nb, 0)) OVER () AS tb,
         sum(coalesce(nc, 0)) OVER () AS tc FROM
    (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS nb FROM base WHERE {c} IS NOT NULL GROUP BY 1) b
    FULL OUTER JOIN (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS nc FROM cur WHERE {c} IS NOT NULL GROUP BY 1) c
    USING (v)) u"""


@query("numeric_drift", with_flights(PERIODS + "\n" + "SELECT feature, round(distance, 6) AS distance FROM ("
                                     + "\nUNION ALL\n".join(_ks_sql(c) for c in NUM) + ") t"))
def q_numeric_drift(spark, sf_dir):
    """Two-sample KS distance per numeric feature."""
    base, cur = periods(spark, sf_dir)
    return present(QY.numeric_drift(base, cur, NUM))


@query("categorical_drift", with_flights(PERIODS + "\n" + "SELECT feature, round(distance, 6) AS distance FROM ("
                                         + "\nUNION ALL\n".join(_linf_sql(c) for c in CAT) + ") t"))
def q_categorical_drift(spark, sf_dir):
    """L-infinity distance of value shares."""
    base, cur = periods(spark, sf_dir)
    return present(QY.categorical_drift(base, cur, CAT))


def _domain_sql(c):
    return f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE CAST({c} AS VARCHAR) IN
      (SELECT CAST({c} AS VARCHAR) FROM base WHERE {c} IS NOT NULL)) / count(*) AS share FROM cur WHERE {c} IS NOT NULL"""


@query("domain_check", with_flights(PERIODS + "\n" + "SELECT feature, round(share, 6) AS share, share < 1.0 AS violation FROM ("
                                    + "\nUNION ALL\n".join(_domain_sql(c) for c in CAT) + ") t"))
def q_domain(spark, sf_dir):
    """Share of current values inside the baseline domain."""
    base, cur = periods(spark, sf_dir)
    return present(QY.check_domain(base, cur, CAT))


STATUS_SQL = """
, st AS (SELECT cp.feature, abs((cp.mean - bp.mean) / bp.mean) * 100 AS drift_pct,
        coalesce(cp.min < bp.min OR cp.max > bp.max, false) AS range_violation,
        CASE WHEN bp.feature IS NULL OR bp.mean IS NULL OR bp.mean = 0 THEN 'NO_BASELINE'
             WHEN cp.min < bp.min OR cp.max > bp.max THEN 'VIOLATION'
             WHEN abs((cp.mean - bp.mean) / bp.mean) * 100 > 10.0 THEN 'DRIFT' ELSE 'OK' END AS status
  FROM cp LEFT JOIN bp ON cp.feature = bp.feature WHERE cp.inferred_type <> 'String')"""


@query("feature_status", with_flights(PROFILE_CTES + STATUS_SQL + """
SELECT feature, round(CASE WHEN status = 'NO_BASELINE' THEN NULL ELSE drift_pct END, 6) AS drift_pct,
       range_violation, status FROM st"""))
def q_feature_status(spark, sf_dir):
    """J9 + J10 + J11: mean drift, range violation and status per feature."""
    base, cur = periods(spark, sf_dir)
    return present(QY.feature_status(QY.profile(base, NUM + CAT, distinct=False),
                                     QY.profile(cur, NUM + CAT, distinct=False)))


@query("status_totals", with_flights(PROFILE_CTES + STATUS_SQL + """
SELECT status, count(*) AS features FROM st GROUP BY status"""))
def q_status_totals(spark, sf_dir):
    """J11 totals."""
    base, cur = periods(spark, sf_dir)
    return QY.status_totals(QY.feature_status(QY.profile(base, NUM + CAT, distinct=False),
                                              QY.profile(cur, NUM + CAT, distinct=False)))


REPORT_SQL = PROFILE_CTES + f"""
, dt AS (SELECT cp.feature AS feature_name, 'data_type_check' AS constraint_check_type FROM cp JOIN bp USING (feature)
         WHERE (bp.inferred_type = 'Integral' AND cp.inferred_type <> 'Integral')
            OR (bp.inferred_type <> 'String' AND cp.inferred_type = 'String')),
cm AS (SELECT cp.feature, 'completeness_check' FROM cp JOIN bp USING (feature) WHERE cp.completeness < bp.completeness),
nn AS (SELECT cp.feature, 'non_negative_check' FROM cp JOIN bp USING (feature) WHERE bp.is_non_negative AND cp.min < 0),
kd AS (SELECT feature, 'baseline_drift_check' FROM ({' UNION ALL '.join(_ks_sql(c) for c in NUM)}) t WHERE distance > 0.1),
ld AS (SELECT feature, 'baseline_drift_check' FROM ({' UNION ALL '.join(_linf_sql(c) for c in CAT)}) t WHERE distance > 0.1),
dm AS (SELECT feature, 'domain_content_check' FROM ({' UNION ALL '.join(_domain_sql(c) for c in CAT)}) t WHERE share < 1.0),
rep AS (SELECT * FROM dt UNION ALL SELECT * FROM cm UNION ALL SELECT * FROM nn UNION ALL SELECT * FROM kd
        UNION ALL SELECT * FROM ld UNION ALL SELECT * FROM dm)"""


@query("monitor_report", with_flights(REPORT_SQL + "\nSELECT feature_name, constraint_check_type FROM rep"))
def q_monitor_report(spark, sf_dir):
    """J3-J8 + J14: one long table of violations."""
    base, cur = periods(spark, sf_dir)
    return QY.monitor_report(base, cur, NUM, CAT).select("feature_name", "constraint_check_type")


@query("alert_routing", with_flights(REPORT_SQL + """
SELECT count(*) AS issues,
       count(*) FILTER (WHERE constraint_check_type LIKE '%data_type_check%' OR constraint_check_type LIKE '%null%') AS data_quality,
       count(*) FILTER (WHERE constraint_check_type LIKE '%baseline_drift_check%') AS drift,
       CASE WHEN count(*) <= 0 THEN 'CLEAR' WHEN count(*) <= 2 THEN 'INFO' WHEN count(*) <= 5 THEN 'WARNING'
            ELSE 'CRITICAL' END AS severity FROM rep"""))
def q_alert_routing(spark, sf_dir):
    """J12 + J13: issue split and alert severity."""
    base, cur = periods(spark, sf_dir)
    return QY.route_violations(QY.monitor_report(base, cur, NUM, CAT))


FACET = ["C1", "C2", "C3"]
_F = ", ".join(f"'{v}'" for v in FACET)


@query("bias_report", with_flights(f"""
, c AS (SELECT carrier IN ({_F}) AS is_d, CASE WHEN dep_delay > 0 THEN 1 ELSE 0 END AS y, origin AS g, count(*) AS n
        FROM v_flights WHERE dep_delay IS NOT NULL GROUP BY ALL),
t AS (SELECT sum(n) FILTER (WHERE NOT is_d) AS na, sum(n) FILTER (WHERE is_d) AS nd,
             sum(n) FILTER (WHERE NOT is_d AND y = 1) AS na1, sum(n) FILTER (WHERE is_d AND y = 1) AS nd1 FROM c),
p AS (SELECT na, nd, na1 / na AS pa1, nd1 / nd AS pd1, 1 - na1 / na AS pa0, 1 - nd1 / nd AS pd0 FROM t),
m AS (SELECT *, (pa1 + pd1) / 2 AS m1, (pa0 + pd0) / 2 AS m0 FROM p),
g AS (SELECT g, sum(n) AS ng, sum(n) FILTER (WHERE y = 0) AS n0, sum(n) FILTER (WHERE y = 1) AS n1,
             sum(n) FILTER (WHERE is_d AND y = 0) AS nd0, sum(n) FILTER (WHERE is_d AND y = 1) AS nd1 FROM c GROUP BY g),
cd AS (SELECT sum(ng * (coalesce(nd0 / n0, 0.0) - coalesce(nd1 / n1, 0.0))) / sum(ng) AS cddl FROM g),
v AS (SELECT (na - nd) / (na + nd) AS ci, pa1 - pd1 AS dpl,
        (CASE WHEN pa1 > 0 THEN pa1 * ln(pa1 / pd1) ELSE 0 END) + (CASE WHEN pa0 > 0 THEN pa0 * ln(pa0 / pd0) ELSE 0 END) AS kl,
        0.5 * ((CASE WHEN pa1 > 0 THEN pa1 * ln(pa1 / m1) ELSE 0 END) + (CASE WHEN pa0 > 0 THEN pa0 * ln(pa0 / m0) ELSE 0 END)
             + (CASE WHEN pd1 > 0 THEN pd1 * ln(pd1 / m1) ELSE 0 END) + (CASE WHEN pd0 > 0 THEN pd0 * ln(pd0 / m0) ELSE 0 END)) AS js,
        sqrt(pow(pa1 - pd1, 2) + pow(pa0 - pd0, 2)) AS lp, 0.5 * (abs(pa1 - pd1) + abs(pa0 - pd0)) AS tvd,
        greatest(abs(pa1 - pd1), abs(pa0 - pd0)) AS ks FROM m)
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'CDDL' AS metric, cddl AS value FROM cd UNION ALL SELECT 'CI', ci FROM v UNION ALL SELECT 'DPL', dpl FROM v
  UNION ALL SELECT 'JS', js FROM v UNION ALL SELECT 'KL', kl FROM v UNION ALL SELECT 'KS', ks FROM v
  UNION ALL SELECT 'LP', lp FROM v UNION ALL SELECT 'TVD', tvd FROM v) t"""))
def q_bias(spark, sf_dir):
    """K0-K9: label bias of the carrier facet C1,C2,C3 (CDDL by origin)."""
    return present(BI.bias_report(raw(spark, sf_dir), "carrier", FACET, "dep_delay", 0.0, group="origin"))


@query("baseline_join", with_flights(PROFILE_CTES + """
SELECT 'matched' AS kind, count(*) AS features FROM cp JOIN bp USING (feature)
UNION ALL SELECT 'no_baseline', count(*) FROM (SELECT feature FROM cp UNION ALL SELECT 'visib') c
  WHERE feature NOT IN (SELECT feature FROM bp)"""))
def q_baseline_join(spark, sf_dir):
    """Current statistics joined to the baseline by feature, with the
    features that have no baseline (the current side also profiles visib)."""
    from skyframe.operators import relational as R
    base, cur = periods(spark, sf_dir)
    matched, missing = R.join_baseline(QY.profile(cur, NUM + CAT + ["visib"], distinct=False),
                                      QY.profile(base, NUM + CAT, distinct=False))
    return (matched.agg(F.count(F.lit(1)).alias("features")).withColumn("kind", F.lit("matched"))
            .unionByName(missing.agg(F.count(F.lit(1)).alias("features")).withColumn("kind", F.lit("no_baseline"))))
