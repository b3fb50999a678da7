"""Joins from a large table to a dimension whose key is unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fogline.functions.text import capitalize_first, normalise_name

BROADCAST_LIMIT = 16 * 1024 * 1024
SALTS = 16
#: Joins that keep every row of the fact once, or drop it: repeating the dimension cannot change them.
FACT_SIDE_JOINS = ("inner", "left", "left_outer", "left_semi", "left_anti")


def measured_bytes(df: DataFrame) -> int:
    """Real size of a frame: lengths of its texts and binaries plus fixed widths. One job; for when a dimension is written."""
    size = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + 16 + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0))
        else:
            size = size + 8
    return int(df.agg(F.sum(size.cast("bigint"))).first()[0] or 0)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    dim_bytes: int | None = None,
    limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``fact`` to ``dim``, whose key is unique, on equal names.

    Without ``dim_bytes`` Spark plans the join from what it knows, and adaptive execution from real shuffle sizes; no job
    runs here. With ``dim_bytes``, a measured size, the dimension is broadcast up to ``limit``. Beyond it both
    sides are shuffled on the key plus a salt: the salt is the input partition number, so
    it is stable under task retries and splits one hot key, NULL keys and exact copies
    alike; the dimension is repeated once per salt.
    """
    on = list(on)
    if how not in FACT_SIDE_JOINS:
        raise ValueError(f"a lookup keeps to the fact's rows; not a {how!r} join")
    if dim_bytes is None:
        return fact.join(dim, on, how)
    if dim_bytes <= limit:
        return fact.join(F.broadcast(dim), on, how)
    salted_fact = fact.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted_dim = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_fact.join(salted_dim, on + ["__salt"], how).drop("__salt")


def name_to_id(
    df: DataFrame, names: DataFrame, label: str, out: str, rule: str = "normalised"
) -> DataFrame:
    """Add ``out``: the id whose name equals ``label``.

    ``names`` holds (id, name). Rules: ``exact``, ``capitalised`` (first letter upper, rest
    lower on the label side), ``normalised`` (case and apostrophes ignored on both sides).
    """
    left: Column = F.col(label)
    right: Column = F.col("name")
    if rule == "capitalised":
        left = capitalize_first(left)
    elif rule == "normalised":
        left, right = normalise_name(left), normalise_name(right)
    elif rule != "exact":
        raise ValueError(f"unknown name rule: {rule}")
    ids = names.where(right.isNotNull()).groupBy(right.alias("__name")).agg(F.min("id").alias(out))
    return lookup_join(df.withColumn("__name", left), ids, ["__name"]).drop("__name")


def unmatched_labels(df: DataFrame, label: str, names: DataFrame) -> DataFrame:
    """Distinct lower-cased labels, with row counts, that the dimension does not know."""
    labels = (
        df.where(F.col(label).isNotNull())
        .groupBy(F.lower(label).alias("label"))
        .agg(F.count("*").alias("n_rows"))
    )
    known = names.select(F.lower("name").alias("label")).distinct()
    return labels.join(known, "label", "left_anti")


def geocode_lookup(
    df: DataFrame, geocodes: DataFrame, address: str, needs: Column, lon: str, lat: str
) -> DataFrame:
    """Replace coordinates by those of a (address, lon, lat) table where ``needs`` holds."""
    table = geocodes.select(
        F.col("address").alias("__address"), F.col("lon").alias("__lon"), F.col("lat").alias("__lat")
    )
    usable = needs & F.col("__lon").isNotNull() & F.col("__lat").isNotNull()
    keyed = df.withColumn("__address", F.when(needs, F.col(address)))
    return (
        lookup_join(keyed, table, ["__address"])
        .withColumn("__usable", F.coalesce(usable, F.lit(False)))
        .withColumn(lon, F.when(F.col("__usable"), F.col("__lon")).otherwise(F.col(lon)))
        .withColumn(lat, F.when(F.col("__usable"), F.col("__lat")).otherwise(F.col(lat)))
        .drop("__address", "__lon", "__lat", "__usable")
    )
