"""Readers for landed files and small file-system helpers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fogline.functions.geo import geojson_rings
from fogline.functions.temporal import lookback_dates, snapshot_ts_from_path
from fogline.functions.text import last_path_part, strip_bom
from fogline.operators.lookup import lookup_join
from fogline.operators.scan import ordinal as number_rows
from fogline.operators.scan import scan_in_segments
from fogline.sources.json_arrays import read_json_records

BYTES_PER_FILE_ENTRY = 400


def _as_text(kind: T.DataType) -> T.DataType:
    """The same shape with every scalar as text, which JSON parsing fills whatever its spelling."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_text(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), _as_text(kind.valueType))
    return T.StringType()


def _typed(value: Column, kind: T.DataType) -> Column:
    """Text values of ``_as_text`` in their own types; NULL where a value has another type."""
    if isinstance(kind, T.StructType):
        fields = [_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _typed(x, kind.valueType))
    if isinstance(kind, T.IntegralType):
        # 1995, 1995.0 and "1995" are the same number; 1995.5 is no whole one.
        number = value.try_cast("decimal(38,9)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return value if isinstance(kind, T.StringType) else value.try_cast(kind)


def _misfits(value: Column, kind: T.DataType) -> Column:
    """How many values inside a text-shaped one do not have their type."""
    if isinstance(kind, T.StructType):
        total = F.lit(0)
        for f in kind.fields:
            if not isinstance(f.dataType, T.StringType):
                total = total + F.coalesce(_misfits(value[f.name], f.dataType), F.lit(0))
        return total
    if isinstance(kind, T.ArrayType):
        return F.aggregate(value, F.lit(0), lambda n, x: n + F.coalesce(_misfits(x, kind.elementType), F.lit(0)))
    if isinstance(kind, T.MapType):
        return F.aggregate(F.map_values(value), F.lit(0), lambda n, x: n + F.coalesce(_misfits(x, kind.valueType), F.lit(0)))
    return F.when(value.isNotNull() & _typed(value, kind).isNull(), 1).otherwise(0)


def parse_json_array(df: DataFrame, text: str, schema: str, ordinal: str = "ordinal", rejects: str | None = None) -> DataFrame:
    """Text column holding a JSON array of records -> one row per record with its position.

    A document that is not a readable array is an error, never an empty snapshot. Numbers may be spelled 1995, 1995.0
    or "1995". A value that does not have its type stops the job, or with ``rejects`` becomes NULL and
    is counted in a column of that name.
    """
    kept = [c for c in df.columns if c != text]
    # Computed once below: the text is looked at three times.
    document = F.col("__document")
    shape = T.StructType.fromDDL(schema)
    unreadable = F.raise_error(F.concat(F.lit("unreadable JSON document: "), F.substring(document, 1, 60)))
    listed = F.when(document.rlike(r"^\s*\["), F.from_json(document, T.ArrayType(_as_text(shape))))
    parsed = F.coalesce(listed, F.when(document.isNotNull(), unreadable))
    trimmed = df.select(*kept, F.trim(strip_bom(F.col(text))).alias("__document"))
    records = trimmed.select(*kept, F.posexplode(parsed).alias(ordinal, "__record"))
    return _checked(records, shape, kept, ordinal, rejects)


def _checked(records: DataFrame, shape: T.StructType, kept: Sequence[str], ordinal: str, rejects: str | None) -> DataFrame:
    """Text-shaped ``__record`` structs as typed columns; a misfit stops the job or is counted."""
    bad = _misfits(F.col("__record"), shape)
    fields = [_typed(F.col("__record")[f.name], f.dataType).alias(f.name) for f in shape.fields]
    if rejects is not None:
        return records.select(*kept, ordinal, *fields, bad.cast("bigint").alias(rejects))
    # The position carries the check, so no projection can leave it out unseen.
    checked = F.when(
        bad > 0, F.raise_error(F.concat(F.lit("value of another type in record: "), F.substring(F.to_json("__record"), 1, 200)))
    ).otherwise(F.col(ordinal))
    return records.select(*kept, checked.cast("int").alias(ordinal), *fields)


def read_json_snapshot(spark: SparkSession, path: str, schema: str, ordinal: str = "ordinal") -> DataFrame:
    """Landed JSON-array file(s) with the record's position in its file and the file name.

    Large files are read by many tasks, whatever their line breaks. A record that cannot be parsed stops the job.
    """
    shape = T.StructType.fromDDL(schema)
    corrupt = "__corrupt"
    text = T.StructType([*_as_text(shape).fields, T.StructField(corrupt, T.StringType())])
    parsed = F.from_json("record", text, {"columnNameOfCorruptRecord": corrupt})
    unreadable = F.raise_error(F.concat(F.lit("unreadable JSON record: "), F.substring(F.col("__record")[corrupt], 1, 60)))
    records = read_json_records(spark, path).select("source_file", F.col("ordinal").alias(ordinal), parsed.alias("__record"))
    refused = F.when(F.col("__record").isNull() | F.col("__record")[corrupt].isNotNull(), unreadable.cast("bigint")).otherwise(F.col(ordinal))
    return _checked(records.withColumn(ordinal, refused), shape, ["source_file"], ordinal, None)


def read_json_lines(spark: SparkSession, path: str, schema: str, ordinal: str = "ordinal") -> DataFrame:
    """Newline-delimited records, for landings too large to be one document.

    Files are split; ``ordinal`` grows along each file, which is what keep-last needs.
    """
    return (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .json(path)
        .select("*", F.monotonically_increasing_id().alias(ordinal), F.col("_metadata.file_path").alias("source_file"))
    )


def read_day_partitions(
    spark: SparkSession, base: str, schema: str, end_date: str, days: int = 10, partition: str = "incident_date"
) -> DataFrame:
    """All days of a look-back window in one scan of ``base/<partition>=YYYY-MM-DD/``.

    The filter is on the partition column, so files of other days are not read. A record that
    does not fit the schema stops the job.
    """
    first, last = lookback_dates(end_date, days)
    reader = spark.read.schema(f"{schema}, {partition} date").option("multiLine", True).option("mode", "FAILFAST")
    frame = reader.json(base)
    return frame.where(F.col(partition).between(F.lit(first), F.lit(last)))


def read_binary_snapshots(spark: SparkSession, path: str, glob: str = "*.pb") -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def snapshot_manifest(files: DataFrame, path: str = "path") -> DataFrame:
    """Feed, agency, folder date, file-name time and position within the folder for every file.

    Positions follow the file name inside one feed, agency and day. They are computed from
    the paths alone, cut by the minute in the name; file contents are joined back to them and
    never enter that sort.
    """
    parts = F.split(path, "/")
    listed = files.select(
        F.col(path).alias("blob_name"),
        F.try_element_at(parts, F.lit(-4)).alias("feed"),
        F.try_element_at(parts, F.lit(-3)).alias("agency_id"),
        F.try_to_date(F.try_element_at(parts, F.lit(-2)), "yyyy-MM-dd").alias("source_date"),
        snapshot_ts_from_path(F.col(path)).alias("filename_snapshot_ts"),
        F.lit(1).cast("bigint").alias("__one"),
    )
    # The first 16 characters of a name are its minute; text prefixes keep the name order.
    minute = F.substring(last_path_part(F.col("blob_name")), 1, 16)
    numbered = scan_in_segments(
        listed, ["feed", "agency_id", "source_date"], ["blob_name"], minute, before=("__one", "blob_order")
    ).drop("__one")
    rest = [c for c in files.columns if c != path]
    if not rest:
        return numbered
    renamed = files.withColumnRenamed(path, "blob_name")
    return lookup_join(renamed, numbered, ["blob_name"], how="inner", dim_bytes=BYTES_PER_FILE_ENTRY * files.count())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_day_parquet(spark: SparkSession, root: str, agency: str, date: str) -> DataFrame:
    """``root/agency/date/`` if it exists, else the single file ``root/agency/date.parquet``."""
    folder = f"{root.rstrip('/')}/{agency}/{date}"
    for candidate in (folder, f"{folder}.parquet"):
        if path_exists(spark, candidate):
            return spark.read.parquet(candidate)
    raise FileNotFoundError(f"no parquet data at {folder}/ or {folder}.parquet")


def snapshot_inventory(
    records: DataFrame,
    file_name: Column,
    id_col: str,
    *,
    since: str,
    pattern: str = r"^(\d{4}-\d{2}-\d{2})_rentals_api_call$",
) -> DataFrame:
    """Records and distinct ids per dated snapshot whose name matches and is not too old."""
    dated = records.withColumn("snapshot_date", F.nullif(F.regexp_extract(file_name, pattern, 1), F.lit("")))
    return (
        dated.where(F.col("snapshot_date") >= since)
        .groupBy("snapshot_date", id_col)
        .count()
        .groupBy("snapshot_date")
        .agg(F.sum("count").alias("api_records"), F.count(id_col).alias("distinct_ids"))
    )


def file_name_column() -> Column:
    return last_path_part(F.col("source_file"))


def shard_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Name, size and modification time of the parquet files under a path."""
    return (
        spark.read.parquet(path)
        .select("_metadata.file_name", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy("file_name", "file_size", "file_modification_time")
        .agg(F.count("*").alias("n_rows"))
    )


def date_spine(spark: SparkSession, end_date: str, days: int) -> DataFrame:
    first, last = lookback_dates(end_date, days)
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))


def lookback_window(df: DataFrame, day: Column, end_date: str, days: int = 10) -> DataFrame:
    """Rows per day of the window, days without rows included."""
    first, last = lookback_dates(end_date, days)
    counts = (
        df.select(day.alias("day"))
        .where(F.col("day").between(F.lit(first), F.lit(last)))
        .groupBy("day")
        .agg(F.count("*").alias("n"))
    )
    return date_spine(df.sparkSession, end_date, days).join(counts, "day", "left").select(
        "day", F.coalesce("n", F.lit(0)).alias("n_rows")
    )


def updated_since(df: DataFrame, updated: str, as_of: dt.date, days: int = 2) -> DataFrame:
    """Incremental slice: rows changed on or after ``as_of - days`` (00:00 UTC)."""
    floor = F.to_timestamp(F.lit((as_of - dt.timedelta(days=days)).isoformat()))
    return df.where(F.col(updated) >= floor)


def polygons_from_features(
    features: DataFrame, name: Column, names: Sequence[str] | None = None, ordinal: str = "ordinal"
) -> DataFrame:
    """Feature rows (ordinal, properties, geometry) -> (id 1..n, name, geometry WKT).

    Ids follow ``ordinal``; ``names`` replaces the source names by position.
    """
    rings = geojson_rings(F.col("geometry"))
    ring_text = F.transform(
        rings,
        lambda r: F.concat(
            F.lit("("),
            F.array_join(F.transform(r, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))), ", "),
            F.lit(")"),
        ),
    )
    # Every ring becomes its own part of a multipolygon: the even-odd rule reads both the same.
    wkt = F.when(
        F.col("geometry.type") == "Polygon", F.concat(F.lit("POLYGON ("), F.array_join(ring_text, ", "), F.lit(")"))
    ).otherwise(
        F.concat(
            F.lit("MULTIPOLYGON ("),
            F.array_join(F.transform(ring_text, lambda t: F.concat(F.lit("("), t, F.lit(")"))), ", "),
            F.lit(")"),
        )
    )
    numbered = number_rows(features, [ordinal], "id")
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("id").cast("int")) if names else name
    return numbered.select("id", label.alias("name"), F.when(rings.isNotNull(), wkt).alias("geometry"))


def read_geojson(spark: SparkSession, path: str, name: str, names: Sequence[str] | None = None) -> DataFrame:
    """GeoJSON FeatureCollection -> polygon dimension in file order."""
    schema = (
        f"features array<struct<properties: map<string, string>, "
        f"geometry: struct<type: string, coordinates: string>>>"
    )
    features = spark.read.schema(schema).option("multiLine", True).json(path).select(
        F.posexplode("features").alias("ordinal", "f")
    ).select("ordinal", "f.properties", "f.geometry")
    return polygons_from_features(features, F.col("properties")[name], names)
