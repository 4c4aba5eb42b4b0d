"""Pre-training label bias metrics (survey K0-K9).

One aggregate of row counts by (facet flag, label[, group]) is the only
pass over the data; every metric is arithmetic on that tiny table. Facet
``d`` is the listed facet values, ``a`` every other row. Published
definitions are used (the managed container that produced the reference
artefact is closed); the identities LP = sqrt(2)|DPL| and TVD = KS = |DPL|
hold for a binary label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe.functions.columns import binarise_label

METRICS = ["CDDL", "CI", "DPL", "JS", "KL", "KS", "LP", "TVD"]


def facet_label_counts(df: DataFrame, facet: str, values, label: str, threshold: float = 0.0,
                       group: str | None = None) -> DataFrame:
    d = F.col(facet).isin(list(values))
    y = binarise_label(label, threshold)
    keys = [d.alias("is_d"), y.alias("y")] + ([F.col(group).alias("g")] if group else [])
    return df.filter(F.col(label).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def bias_report(df: DataFrame, facet: str, values, label: str, threshold: float = 0.0,
                group: str | None = None) -> DataFrame:
    """K9: long table ``metric, value`` of K1-K8."""
    c = facet_label_counts(df, facet, values, label, threshold, group)
    n = F.col("n")
    t = c.agg(
        F.sum(F.when(~F.col("is_d"), n).otherwise(0)).alias("na"),
        F.sum(F.when(F.col("is_d"), n).otherwise(0)).alias("nd"),
        F.sum(F.when(~F.col("is_d") & (F.col("y") == 1), n).otherwise(0)).alias("na1"),
        F.sum(F.when(F.col("is_d") & (F.col("y") == 1), n).otherwise(0)).alias("nd1"),
    )
    pa1 = F.try_divide(F.col("na1"), F.col("na"))
    pd1 = F.try_divide(F.col("nd1"), F.col("nd"))
    pa0, pd0 = 1 - pa1, 1 - pd1

    def kl(p1, p0, q1, q0):
        def term(p, q):
            return F.when(p > 0, p * F.ln(F.try_divide(p, q))).otherwise(F.lit(0.0))
        return term(p1, q1) + term(p0, q0)

    m1, m0 = (pa1 + pd1) / 2, (pa0 + pd0) / 2
    metrics = t.select(
        F.try_divide(F.col("na") - F.col("nd"), F.col("na") + F.col("nd")).alias("CI"),
        (pa1 - pd1).alias("DPL"),
        kl(pa1, pa0, pd1, pd0).alias("KL"),
        (0.5 * (kl(pa1, pa0, m1, m0) + kl(pd1, pd0, m1, m0))).alias("JS"),
        F.sqrt(F.pow(pa1 - pd1, 2) + F.pow(pa0 - pd0, 2)).alias("LP"),
        (0.5 * (F.abs(pa1 - pd1) + F.abs(pa0 - pd0))).alias("TVD"),
        F.greatest(F.abs(pa1 - pd1), F.abs(pa0 - pd0)).alias("KS"),
    )
    cddl = _cddl(c if group else c.withColumn("g", F.lit(0)))
    from skyframe.plans.combine import side_by_side
    wide = side_by_side(metrics, cddl)
    stack = "stack({}, {}) as (metric, value)".format(
        len(METRICS), ", ".join(f"'{m}', CAST({m} AS DOUBLE)" for m in METRICS))
    return wide.selectExpr(stack)


def _cddl(c: DataFrame) -> DataFrame:
    """K8: sum over groups of n_g * DD_g / n, with
    DD_g = n_d(0)/n(0) - n_d(1)/n(1) inside the group."""
    n = F.col("n")
    per_g = c.groupBy("g").agg(
        F.sum(n).alias("ng"),
        F.sum(F.when(F.col("y") == 0, n).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("y") == 1, n).otherwise(0)).alias("n1"),
        F.sum(F.when(F.col("is_d") & (F.col("y") == 0), n).otherwise(0)).alias("nd0"),
        F.sum(F.when(F.col("is_d") & (F.col("y") == 1), n).otherwise(0)).alias("nd1"),
    )
    dd = (F.coalesce(F.try_divide(F.col("nd0"), F.col("n0")), F.lit(0.0))
          - F.coalesce(F.try_divide(F.col("nd1"), F.col("n1")), F.lit(0.0)))
    return per_g.agg(F.try_divide(F.sum(F.col("ng") * dd), F.sum("ng")).alias("CDDL"))
