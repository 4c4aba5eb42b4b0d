"""Data quality, constraints and drift (survey J1-J14).

Profiles are one wide aggregate per frame, turned long with ``stack``;
checks compare two long profiles by an equi-join on the feature name.
The numeric drift distance needs running shares over the sorted values:
values are first reduced to counts (map-side combined), then running
sums and totals come from ``plans.ordered`` so no single task sorts all
distinct values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframe.functions.columns import alert_severity
from skyframe.plans import ordered
from skyframe.plans.combine import side_by_side
from skyframe.session import written


# J1
def distinct_sketches(df: DataFrame, cols=None, lg_k: int = 12) -> DataFrame:
    """(feature, sketch): one mergeable sketch of the distinct values per
    column, from one aggregate. Kept with a baseline, the sketches of days
    are put together by ``merged_distinct`` without their rows."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"_s{i}") for i, c in enumerate(cols)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_s{i}").alias("sketch")) for i, c in enumerate(cols)]))
    return wide.select(rows.alias("r")).select("r.*")


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """(feature, n_distinct) over all the days whose sketches are given."""
    return sketches.groupBy("feature").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


# J1 + J2
def profile(df: DataFrame, cols=None, approx_distinct: bool = False, lg_k: int = 12,
            distinct: bool = True) -> DataFrame:
    """Long profile: feature, inferred_type (Integral / Fractional /
    String), completeness, mean, min, max, n_distinct, is_non_negative.
    ``approx_distinct`` estimates distinct values with mergeable sketches in
    the same pass (``distinct_sketches``), with a relative error of about
    1.04 / sqrt(2 ** ``lg_k``); exact counts take one narrow scan a column
    instead of every row once per column.
    ``distinct=False`` leaves ``n_distinct`` null for callers that do not
    read it (the checks), so the aggregate is one plain hash aggregate."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        x = F.col(c)
        aggs.append(F.count(x).alias(f"_c{i}"))
        if not distinct:
            aggs.append(F.lit(None).cast("long").alias(f"_d{i}"))
        elif approx_distinct:
            aggs.append(F.hll_sketch_estimate(F.hll_sketch_agg(x.cast("string"), F.lit(lg_k))).alias(f"_d{i}"))
        if isinstance(df.schema[c].dataType, T.NumericType):
            xd = x.cast("double")
            aggs += [F.avg(xd).alias(f"_m{i}"), F.min(xd).alias(f"_lo{i}"), F.max(xd).alias(f"_hi{i}"),
                     F.count_if(xd != F.floor(xd)).alias(f"_f{i}")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"_m{i}"), F.lit(None).cast("double").alias(f"_lo{i}"),
                     F.lit(None).cast("double").alias(f"_hi{i}"), F.lit(None).cast("long").alias(f"_f{i}")]
    wide = df.agg(*aggs)
    if distinct and not approx_distinct:
        wide = side_by_side(wide, *[df.select(c).distinct().agg(F.count(c).alias(f"_d{i}")) for i, c in enumerate(cols)])
    rows = ", ".join(
        f"'{c}', '{'num' if isinstance(df.schema[c].dataType, T.NumericType) else 'str'}', "
        f"_c{i}, _d{i}, _m{i}, _lo{i}, _hi{i}, _f{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_rows", f"stack({len(cols)}, {rows}) as (feature, kind, n, n_distinct, mean, min, max, n_frac)")
    itype = (F.when(F.col("kind") == "str", "String").when(F.col("n_frac") > 0, "Fractional")
             .otherwise("Integral"))
    return long.select(
        "feature", itype.alias("inferred_type"),
        F.try_divide(F.col("n").cast("double"), F.col("_rows")).alias("completeness"),
        "mean", "min", "max", "n_distinct",
        F.when(F.col("kind") == "num", F.col("min") >= 0).alias("is_non_negative"))


def _checks_join(baseline: DataFrame, current: DataFrame) -> DataFrame:
    b = baseline.select(*[F.col(c).alias(f"b_{c}") for c in baseline.columns])
    return current.join(b, F.col("feature") == F.col("b_feature"), "inner")


# Each check is a (kind, violated, description) rule over the join
# of the current profile with the baseline profile; several rules are
# evaluated on one join.
def _rule_data_type(threshold: float = 1.0):
    """A baseline Integral feature must stay integral; a numeric one numeric."""
    bad = ((F.col("b_inferred_type") == "Integral") & (F.col("inferred_type") != "Integral")) | \
          ((F.col("b_inferred_type") != "String") & (F.col("inferred_type") == "String"))
    desc = F.concat(F.lit("Data type match requirement is not met. Expected data type: "),
                    F.col("b_inferred_type"), F.lit(", Observed data type: "), F.col("inferred_type"),
                    F.lit(f", threshold {threshold}"))
    return "data_type_check", bad, desc


def _rule_completeness():
    desc = F.concat(F.lit("Data completeness "), F.format_string("%.6f", F.col("completeness")),
                    F.lit(" is below the baseline "), F.format_string("%.6f", F.col("b_completeness")))
    return "completeness_check", F.col("completeness") < F.col("b_completeness"), desc


def _rule_non_negative():
    return ("non_negative_check", F.col("b_is_non_negative") & (F.col("min") < 0),
            F.lit("Negative values found for a non-negative feature"))


def _apply_rules(base_prof: DataFrame, cur_prof: DataFrame, rules) -> DataFrame:
    j = _checks_join(base_prof, cur_prof)
    found = F.array(*[F.when(bad, F.struct(F.lit(kind).alias("k"), desc.alias("d"))) for kind, bad, desc in rules])
    return (j.select(F.col("feature").alias("feature_name"),
                     F.explode(F.filter(found, lambda v: v.isNotNull())).alias("_v"))
            .select("feature_name", F.col("_v.k").alias("constraint_check_type"), F.col("_v.d").alias("description")))


# J3
def check_data_type(base_prof: DataFrame, cur_prof: DataFrame, threshold: float = 1.0) -> DataFrame:
    return _apply_rules(base_prof, cur_prof, [_rule_data_type(threshold)])


# J4
def check_completeness(base_prof: DataFrame, cur_prof: DataFrame) -> DataFrame:
    return _apply_rules(base_prof, cur_prof, [_rule_completeness()])


# J5
def check_non_negative(base_prof: DataFrame, cur_prof: DataFrame) -> DataFrame:
    return _apply_rules(base_prof, cur_prof, [_rule_non_negative()])


def profile_checks(base_prof: DataFrame, cur_prof: DataFrame, threshold: float = 1.0) -> DataFrame:
    """J3 + J4 + J5 from one join of the two profiles."""
    return _apply_rules(base_prof, cur_prof, [_rule_data_type(threshold), _rule_completeness(),
                                              _rule_non_negative()])


# J6
def _long_values(df: DataFrame, cols, cast: str) -> DataFrame:
    """(feature, v) rows for the listed columns, nulls dropped."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(cast).alias("v")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.feature", "p.v").filter(F.col("v").isNotNull())


def _both_counts(baseline: DataFrame, current: DataFrame, cols, cast: str) -> DataFrame:
    """(feature, v, nb, nc): how often each value occurs on either side. One
    aggregate over both sides (combined map-side), no join."""
    sides = (_long_values(baseline, cols, cast).select("feature", "v", F.lit(1).alias("b"), F.lit(0).alias("c"))
             .unionByName(_long_values(current, cols, cast).select("feature", "v", F.lit(0).alias("b"), F.lit(1).alias("c"))))
    return sides.groupBy("feature", "v").agg(F.sum("b").alias("nb"), F.sum("c").alias("nc"))


def numeric_drift(baseline: DataFrame, current: DataFrame, cols, num_buckets: int | None = None) -> DataFrame:
    """Largest gap between the two empirical CDFs per feature (two-sample
    Kolmogorov-Smirnov distance). All features go through one pass: value
    counts per (feature, value), one range-bucketed running sum grouped by
    feature, one aggregate."""
    both = written(_both_counts(baseline, current, cols, "double"), "value-counts")
    run = ordered.running_sums(both, "v", ["nb", "nc"], num_buckets, group=["feature"])
    gap = F.abs(F.try_divide(F.col("cum_nb"), F.col("total_nb")) - F.try_divide(F.col("cum_nc"), F.col("total_nc")))
    return run.groupBy("feature").agg(F.max(gap).alias("distance"))


# J7
def categorical_counts(baseline: DataFrame, current: DataFrame, cols) -> DataFrame:
    """(feature, v, nb, nc): value counts of both sides for all listed features."""
    return _both_counts(baseline, current, cols, "string")


def categorical_drift(baseline: DataFrame, current: DataFrame, cols, counts: DataFrame | None = None) -> DataFrame:
    """L-infinity distance between the two value-share vectors (one pass
    over all features). ``counts`` reuses a ``categorical_counts`` frame."""
    both = counts if counts is not None else categorical_counts(baseline, current, cols)
    tot = both.groupBy("feature").agg(F.sum("nb").alias("tb"), F.sum("nc").alias("tc"))
    gap = F.abs(F.try_divide(F.col("nb"), F.col("tb")) - F.try_divide(F.col("nc"), F.col("tc")))
    # one row per listed feature, so the totals are broadcast
    return both.join(F.broadcast(tot), "feature").groupBy("feature").agg(F.max(gap).alias("distance"))


def drift_violations(distances: DataFrame, threshold: float = 0.1, kind: str = "baseline_drift_check") -> DataFrame:
    return distances.filter(F.col("distance") > threshold).select(
        F.col("feature").alias("feature_name"), F.lit(kind).alias("constraint_check_type"),
        F.concat(F.lit("Baseline drift distance: "), F.format_string("%.6f", F.col("distance")),
                 F.lit(f" exceeds threshold: {threshold}")).alias("description"))


# J8
def check_domain(baseline: DataFrame, current: DataFrame, cols, threshold: float = 1.0,
                 counts: DataFrame | None = None) -> DataFrame:
    """Share of current values found in the baseline value set, for all
    features in one pass over the value counts of both sides (a value is
    in the domain when the baseline counted it): no row pairs."""
    both = counts if counts is not None else categorical_counts(baseline, current, cols)
    share = both.groupBy("feature").agg(
        F.try_divide(F.sum(F.when(F.col("nb") > 0, F.col("nc")).otherwise(0)).cast("double"),
                     F.sum("nc")).alias("share"))
    return share.withColumn("violation", F.col("share") < threshold)


# J9 + J10 + J11
def feature_status(base_prof: DataFrame, cur_prof: DataFrame, drift_limit_pct: float = 10.0) -> DataFrame:
    """Per numeric feature: drift percent of the mean, range violation
    against the baseline min/max, and status VIOLATION > DRIFT > OK;
    features without a usable baseline mean are NO_BASELINE."""
    cur = cur_prof.filter(F.col("inferred_type") != "String")
    b = base_prof.select(F.col("feature").alias("bf"), F.col("mean").alias("b_mean"),
                         F.col("min").alias("b_min"), F.col("max").alias("b_max"))
    j = cur.join(b, F.col("feature") == F.col("bf"), "left")
    drift = F.abs(F.try_divide(F.col("mean") - F.col("b_mean"), F.col("b_mean"))) * 100
    viol = (F.col("min") < F.col("b_min")) | (F.col("max") > F.col("b_max"))
    status = (F.when(F.col("bf").isNull() | drift.isNull(), "NO_BASELINE").when(viol, "VIOLATION")
              .when(drift > drift_limit_pct, "DRIFT").otherwise("OK"))
    return j.select("feature", drift.alias("drift_pct"), F.coalesce(viol, F.lit(False)).alias("range_violation"),
                    status.alias("status"))


def status_totals(status: DataFrame) -> DataFrame:
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("features"))


# J12 + J13
def route_violations(violations: DataFrame) -> DataFrame:
    """Data-quality issues (a data type or null check) and drift issues (a
    baseline drift check) of a violation list; other kinds count only in
    ``issues``, which grades the alert."""
    kind = F.col("constraint_check_type")
    counts = violations.agg(
        F.count(F.lit(1)).alias("issues"),
        F.count_if(kind.contains("data_type_check") | kind.contains("null")).alias("data_quality"),
        F.count_if(kind.contains("baseline_drift_check")).alias("drift"))
    return counts.withColumn("severity", alert_severity("issues"))


# J14
def monitor_report(baseline: DataFrame, current: DataFrame, numeric, categorical, drift_threshold=0.1) -> DataFrame:
    """All violations of J3-J8 in one long table. Each side is profiled
    once (no distinct counts: no check reads them) and the three profile
    checks share one join; the categorical value counts feed both the
    L-infinity drift and the domain check."""
    feats = numeric + categorical
    bp, cp = profile(baseline, feats, distinct=False), profile(current, feats, distinct=False)
    counts = categorical_counts(baseline, current, categorical)
    dom = check_domain(baseline, current, categorical, counts=counts).filter("violation").select(
        F.col("feature").alias("feature_name"), F.lit("domain_content_check").alias("constraint_check_type"),
        F.concat(F.lit("Share of values in the baseline domain: "), F.format_string("%.6f", F.col("share"))).alias("description"))
    parts = [profile_checks(bp, cp),
             drift_violations(numeric_drift(baseline, current, numeric), drift_threshold),
             drift_violations(categorical_drift(baseline, current, categorical, counts=counts), drift_threshold), dom]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
