"""Sources and sinks (survey A1-A18): file formats, the partitioned lake,
the catalog, typed attribute maps and incremental file streams.

All readers take an explicit schema (no inference pass over the data) and
all writers are distributed Spark writers; the only single-file output is
the small metrics document (A18).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


# A1
def read_events(spark: SparkSession, path: str, schema: T.StructType, compression: str | None = None) -> DataFrame:
    """Recursive scan of (optionally gzip) JSON-lines files."""
    r = spark.read.schema(schema).option("recursiveFileLookup", True)
    if compression:
        r = r.option("compression", compression)
    return r.json(path)


# A2
def read_events_incremental(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str,
                            sink, max_files: int | None = None):
    """Process only files not seen before (job bookmark): a file stream run
    to completion with ``availableNow``; ``sink(batch_df, batch_id)`` gets
    each micro-batch. Returns the finished streaming query."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    q = (r.json(path).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


# A3
# One flat object: text in quotes may hold braces and escaped quotes.
_OBJECT = r'\{(?:[^{}"]++|"(?:[^"\\]++|\\.)*+")*+\}'


def split_concatenated_json(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row per flat JSON object of lines like ``{..}{..}``; what a line
    holds besides whole objects (a cut one, say) is a row of its own."""
    objects = F.regexp_extract_all(F.col(col), F.lit(_OBJECT), F.lit(0))
    rest = F.trim(F.regexp_replace(F.col(col), _OBJECT, " "))
    parts = F.concat(objects, F.when(F.length(rest) > 0, F.array(rest)).otherwise(F.array().cast("array<string>")))
    return lines.select(F.explode(parts).alias(col))


def read_concatenated_json(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(parsed objects, text that is not one) of lines holding several flat
    JSON objects back to back."""
    return quarantine(split_concatenated_json(spark.read.text(path)), schema)


# A5 / M13
def quarantine(lines: DataFrame, schema: T.StructType, col: str = "value",
               path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Parse JSON text permissively; (parsed rows, unparseable raw lines).
    With ``path`` every line is parsed once and both are outputs there, from
    which the two frames read; without it each of them parses what it reads."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    p = lines.select(F.from_json(F.col(col), with_corrupt,
                                 {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"), F.col(col))
    bad = F.col(f"r.{CORRUPT}").isNotNull() | F.col("r").isNull()
    if path:
        spark, fields = lines.sparkSession, [F.col(f"r.{f.name}").alias(f"f{i}") for i, f in enumerate(schema.fields)]
        p.select(*fields, F.when(bad, F.col(col)).alias("raw"), bad.alias("bad")).write.partitionBy("bad").parquet(path)
        kept = T.StructType([*[T.StructField(f"f{i}", f.dataType) for i, f in enumerate(schema.fields)],
                             T.StructField("raw", T.StringType()), T.StructField("bad", T.BooleanType())])
        back = spark.read.schema(kept).parquet(path)
        return (back.filter(~F.col("bad")).select(*[F.col(f"f{i}").alias(f.name) for i, f in enumerate(schema.fields)]),
                back.filter("bad").select("raw"))
    good = p.filter(~bad).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])
    return good, p.filter(bad).select(F.col(col).alias("raw"))


# A4
def write_landing(stream_df: DataFrame, path: str, checkpoint: str, ts_col: str = "ts",
                  interval: str = "60 seconds", compression: str = "gzip"):
    """Landing zone: JSON by year/month/day/hour of the event stamp."""
    out = stream_df.withColumns({
        "year": F.year(ts_col), "month": F.month(ts_col), "day": F.dayofmonth(ts_col), "hour": F.hour(ts_col)})
    return (out.writeStream.format("json").option("compression", compression)
            .option("checkpointLocation", checkpoint).partitionBy("year", "month", "day", "hour")
            .trigger(processingTime=interval).start(path))


# A6
def write_lake(df: DataFrame, path: str, by=("year", "month", "day"), mode: str = "append",
               num_tasks: int | None = None, max_records_per_file: int = 5_000_000) -> None:
    """Partitioned Parquet. Rows are range-partitioned on the partition
    columns plus a row hash, so each task writes few partition folders and
    a day holding a third of all rows is still written by many tasks."""
    n = num_tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    (df.repartitionByRange(n, *[F.col(c) for c in by], spread)
     .write.option("maxRecordsPerFile", max_records_per_file).partitionBy(*by).mode(mode).parquet(path))


# A7
def register_table(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Catalog table over the lake folder with its partitions discovered."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source=fmt)
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


# A8
def register_database(spark: SparkSession, db: str, views: dict[str, str]) -> None:
    """A database of SQL views over registered tables for SQL users."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    for view, source in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{view} AS SELECT * FROM {source}")


# A9
def read_sample_csv(spark: SparkSession, path: str, schema: T.StructType, ts_cols=(), ts_format="yyyy-MM-dd HH:mm:ss",
                    date_cols=()) -> DataFrame:
    """Header CSV with text stamps converted (``date_string`` stays text)."""
    df = spark.read.schema(schema).option("header", True).csv(path)
    conv = {c: F.try_to_timestamp(F.col(c), F.lit(ts_format)) for c in ts_cols}
    conv.update({c: F.to_date(F.col(c)) for c in date_cols})
    return df.withColumns(conv)


def _fixed_point(name: str, float_format: str) -> Column:
    """The text that ``format_string`` gives; for six decimals and all but very
    large numbers by a decimal of that scale, which takes a fraction of the time."""
    x = F.col(name)
    slow = F.format_string(float_format, x)
    if float_format != "%.6f":
        return slow
    zero = F.when(x.cast("string") == "-0.0", "-0.000000").otherwise("0.000000")
    return (F.when(x == 0, zero)
            .when((F.abs(x) < 1e11) & ((x > 0) | (x <= -5e-7)), x.cast("decimal(18,6)").cast("string"))
            .otherwise(slow))


# A10
def write_csv(df: DataFrame, path: str, float_format: str = "%.6f", mode: str = "overwrite",
              compression: str = "none") -> None:
    """Header CSV, floats as fixed-point text."""
    cols = [_fixed_point(f.name, float_format).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.option("header", True).option("compression", compression).mode(mode).csv(path)


# A11
CAPTURE_SCHEMA = T.StructType([
    T.StructField("captureData", T.StructType([
        T.StructField("endpointInput", T.StructType([T.StructField("data", T.StringType())])),
        T.StructField("endpointOutput", T.StructType([T.StructField("data", T.StringType())])),
    ])),
    T.StructField("eventMetadata", T.StructType([
        T.StructField("inferenceTime", T.StringType()), T.StructField("eventId", T.StringType())])),
])


def read_capture(spark: SparkSession, path: str) -> DataFrame:
    """Scored-request capture files (any year/month/day/hour layout)."""
    return read_events(spark, path, CAPTURE_SCHEMA).select(
        F.col("captureData.endpointInput.data").alias("features"),
        F.col("captureData.endpointOutput.data").alias("prediction"),
        F.col("eventMetadata.inferenceTime").alias("inference_time"),
        F.col("eventMetadata.eventId").alias("event_id"))


# A12
def read_predictions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Partitioned prediction JSON lines; partition columns are discovered
    from ``key=value`` folders."""
    return spark.read.schema(schema).json(path)


# A13
def open_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 10, fmt: str = "json",
                key: str | None = None) -> DataFrame:
    """Bounded micro-batches from the start of a file stream; optionally
    partitioned by a key before keyed state."""
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt).load(path)
    return df.repartition(key) if key else df


# A15
def _encoded(col: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        pairs = [F.concat(F.lit(f'"{f.name}":'), _encoded(col[f.name], f.dataType)) for f in kind.fields]
        body = F.concat(F.lit('{"M":{'), F.concat_ws(",", *pairs), F.lit("}}"))
    elif isinstance(kind, T.ArrayType):
        items = F.transform(col, lambda x: _encoded(x, kind.elementType))
        body = F.concat(F.lit('{"L":['), F.array_join(items, ","), F.lit("]}"))
    elif isinstance(kind, T.BooleanType):
        body = F.to_json(F.struct(col.alias("BOOL")))
    else:
        body = F.to_json(F.struct(col.cast("string").alias("N" if isinstance(kind, T.NumericType) else "S")))
    return F.when(col.isNull(), F.lit('{"NULL":true}')).otherwise(body)


def encode_attribute_map(df: DataFrame, cols) -> Column:
    """Row -> typed attribute map JSON: strings S, numbers N as text,
    booleans BOOL, structs M, arrays L, nulls NULL."""
    pairs = [F.concat(F.lit(f'"{c}":'), _encoded(F.col(c), df.schema[c].dataType)) for c in cols]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))


def _decoded(v: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_decoded(F.try_variant_get(v, f"$.M['{f.name}']", "variant"), f.dataType).alias(f.name)
                           for f in kind.fields])
        return F.when(F.try_variant_get(v, "$.M", "variant").isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(F.try_variant_get(v, "$.L", "array<variant>"), lambda x: _decoded(x, kind.elementType))
    if isinstance(kind, T.BooleanType):
        return F.try_variant_get(v, "$.BOOL", "boolean")
    if isinstance(kind, T.NumericType):
        return F.try_variant_get(v, "$.N", "string").try_cast(kind)
    return F.try_variant_get(v, "$.S", "string").cast(kind)


def decode_attribute_map(col, schema: T.StructType) -> Column:
    """Typed attribute map JSON -> struct of plain columns: S as text, N cast
    to the target numeric type, BOOL, nested M and L, NULL as null."""
    item = F.parse_json(col if isinstance(col, Column) else F.col(col))
    return F.struct(*[_decoded(F.try_variant_get(item, f"$['{f.name}']", "variant"), f.dataType).alias(f.name)
                      for f in schema.fields])


# A16
def _remove_files(spark: SparkSession, paths, archive_dir: str | None = None) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if archive_dir:
            dest = jvm.org.apache.hadoop.fs.Path(archive_dir)
            fs.mkdirs(dest)
            fs.rename(path, jvm.org.apache.hadoop.fs.Path(dest, path.getName()))
        else:
            fs.delete(path, True)


def _committed(spark: SparkSession, checkpoint: str) -> set[str]:
    """Batch ids that the stream's checkpoint lists as committed."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()


def _remove_committed(spark: SparkSession, checkpoint: str, consumed: str, archive_dir: str | None) -> None:
    """Remove the files of every committed batch, read from the lists that
    the batches left under ``consumed``."""
    if not path_exists(spark, consumed):
        return
    done = _committed(spark, checkpoint)
    lists = spark.read.parquet(consumed)
    for batch_id in [str(r[0]) for r in lists.select("batch_id").distinct().collect()]:
        if batch_id in done:
            names = lists.filter(F.col("batch_id") == int(batch_id)).select("file")
            _remove_files(spark, (r[0] for r in names.toLocalIterator()), archive_dir)
            _remove_files(spark, [f"{consumed}/batch_id={batch_id}"])


def consume_once(spark: SparkSession, path: str, schema: T.StructType, checkpoint: str, sink,
                 clean_source: str = "delete", archive_dir: str | None = None, fmt: str = "csv",
                 max_files: int = 1000):
    """Read each file once (the stream's checkpoint remembers it) and remove
    (or archive) it after its micro-batch is committed.

    A batch writes the list of its files next to the checkpoint before its
    sink runs. Files are removed only for batches that the checkpoint lists
    as committed, at the end of the run and at the start of the next one, so
    a crash at any point leaves files of unfinished batches for the retry.
    A batch holds at most ``max_files`` files."""
    consumed = f"{checkpoint}-consumed"
    archive = archive_dir if clean_source == "archive" else None
    if clean_source in ("delete", "archive"):
        _remove_committed(spark, checkpoint, consumed, archive)
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        r = r.option("header", True)

    def handle(batch: DataFrame, batch_id: int):
        (batch.select(F.input_file_name().alias("file")).distinct()
         .write.mode("overwrite").parquet(f"{consumed}/batch_id={batch_id}"))
        sink(batch, batch_id)

    q = (r.format(fmt).load(path).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if clean_source in ("delete", "archive"):
        _remove_committed(spark, checkpoint, consumed, archive)
    return q


# A17
def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def source_or_fallback(spark: SparkSession, primary: DataFrame, extra_path: str, reader) -> DataFrame:
    """``primary`` plus the extra data when its path exists."""
    if path_exists(spark, extra_path):
        return primary.unionByName(reader(extra_path), allowMissingColumns=True)
    return primary


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names of the files directly in a folder of any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isFile()]
    return sorted(n for n in names if n.endswith(suffix) and not n.startswith((".", "_")))


# A18
def write_metrics(df: DataFrame, path: str) -> None:
    """A small result document (one JSON object per row, one file)."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1).write.mode("overwrite").text(path)
