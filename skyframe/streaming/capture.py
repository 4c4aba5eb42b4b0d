"""Scored-request capture records (survey A11, B24, C38)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_capture(feats: DataFrame, path: str, inputs, prediction, n_inputs=None) -> None:
    """Capture files as the scoring endpoint logs them: the input vector as
    one CSV string and the prediction as text, in year/month/day/hour
    folders of the scoring time (the columns ``day`` and ``hour`` of one
    fixed month). ``n_inputs`` gives how many of the inputs were logged."""
    csv = F.concat_ws(",", F.slice(F.array(*[F.col(c).cast("string") for c in inputs]), F.lit(1),
                                   F.lit(len(inputs)) if n_inputs is None else n_inputs))
    day, hour = F.col("day").cast("int"), F.col("hour").cast("int")
    stamp = F.make_timestamp(F.lit(2024), F.lit(1), day, hour, F.lit(0), F.lit(0))
    rec = F.struct(
        F.struct(F.struct(csv.alias("data")).alias("endpointInput"),
                 F.struct(prediction.alias("data")).alias("endpointOutput")).alias("captureData"),
        F.struct(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("inferenceTime"), F.expr("uuid()").alias("eventId"))
        .alias("eventMetadata"))
    parts = [F.date_format(stamp, f).alias(c) for c, f in (("y", "yyyy"), ("m", "MM"), ("d", "dd"), ("h", "HH"))]
    # the folders follow from day and hour: the numbers are shuffled, the texts are built behind it
    out = feats.repartition("day", "hour").select(rec.alias("r"), *parts).select("r.*", "y", "m", "d", "h")
    out.write.partitionBy("y", "m", "d", "h").option("compression", "gzip").json(path)


# B24
def parse_capture(cap: DataFrame, names) -> tuple[DataFrame, DataFrame]:
    """CSV feature string -> named doubles; records with the wrong number
    of fields or a non-numeric field / prediction are dropped. Returns
    (clean rows, one-row counts of the dropped records)."""
    names = list(names)
    parts = F.split(F.col("features"), ",")
    x = cap.select(parts.alias("_p"), F.col("prediction").try_cast("double").alias("prediction"))
    ok_len = F.size("_p") == len(names)
    vals = [F.when(ok_len, F.element_at("_p", i + 1).try_cast("double")).alias(n) for i, n in enumerate(names)]
    y = x.select(ok_len.alias("_ok_len"), F.forall("_p", lambda v: v.try_cast("double").isNotNull()).alias("_numeric"),
                 *vals, "prediction")
    # over the parts, not over the named columns: a filter on these would split the text again for each of them
    numeric = F.col("_numeric")
    good = y.filter(F.col("_ok_len") & numeric & F.col("prediction").isNotNull()).drop("_ok_len", "_numeric")
    dropped = y.agg(F.count_if(~F.col("_ok_len")).alias("wrong_length"),
                    F.count_if(F.col("_ok_len") & ~numeric).alias("non_numeric_feature"),
                    F.count_if(F.col("_ok_len") & numeric & F.col("prediction").isNull()).alias("bad_prediction"))
    return good, dropped


# C38
def prediction_range(cap: DataFrame, clean: DataFrame, n_features: int) -> DataFrame:
    a = cap.agg(F.count(F.lit(1)).alias("records_in"))
    b = clean.agg(F.count(F.lit(1)).alias("records_clean"), F.min("prediction").alias("min_prediction"),
                  F.max("prediction").alias("max_prediction"))
    from skyframe.plans.combine import side_by_side
    j = side_by_side(a, b)
    return j.select("records_in", "records_clean", F.lit(n_features).alias("feature_count"),
                    "min_prediction", "max_prediction")
