"""Mixing sources to target weights with DataFrame operations only.

Method: sources get targets by weight (none above ``max_repeats`` times its size). Words are dealt in
blocks of ``BLOCK`` words. Sainte-Lague gives each source its number of blocks: quotients
target / (2 k + 1) in falling order. In the same way a source's blocks go to its shards by their
sizes. Quotients are not listed one by one: rounding with a divisor that is surely too large gives
the seats that every outcome has, one that is surely too small bounds them from above, and
only the quotients in between (about two per source or shard) are ranked.

Selection: a shard's documents lie in an order drawn by a seeded hash, and their words, end to end,
form its blocks. All blocks are taken quota div n times and, once more, a run of quota mod n blocks from a
seeded place on, past the end back to the start. So what is taken of a document follows from its place by
arithmetic: no block rows exist, and at most two documents of a shard and round are taken in part.

Scale: the text is read once, to count words. Windows are over one row per source, one per shard, or the
(id, size) rows of one shard, whose number of words ``SHARD`` bounds on average.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fogline.session import cut_lineage

#: Words in a block, words in a shard.
BLOCK, SHARD = 16, 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def draw(seed: int, *parts: Column) -> Column:
    """60 bits that depend on the seed and the parts, as text."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("~")) for p in parts))
    return F.substring(F.md5(text), 1, 15)


def number(digits: Column) -> Column:
    """Hexadecimal digits as a long."""
    return F.conv(digits, 16, 10).cast("long")


def set_targets(sources: DataFrame, weights: Sequence[float], share: float, max_repeats: int) -> DataFrame:
    """``sources`` (source, source_size) with target; weights repeat over sources by code point, NULL last.

    Targets in proportion to the weights, where those that would pass max_repeats times their size stop
    there and leave the excess to the others: sources are full in order of size over weight.
    """
    everything = Window.partitionBy()
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    named = sources.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int")))
    limit = F.col("source_size") * float(max_repeats)
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rest = F.col("wanted") - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    return (
        named.withColumn("wanted", F.least(F.sum("source_size").over(everything) * share, F.sum(limit).over(everything)))
        .withColumn("place", F.row_number().over(filled))
        # What a unit of weight gets if all sources before this one are full and the others are not.
        .withColumn("level", rest / F.sum("weight").over(after))
        .withColumn("open", F.when(F.col("level") * F.col("weight") < limit, F.struct("place", "level")))
        .withColumn("first_open", F.min("open").over(everything))
        .withColumn(
            "target",
            F.when(F.col("place") >= F.col("first_open.place"), F.least(limit, F.col("first_open.level") * F.col("weight"))).otherwise(limit),
        )
        .select("source", "source_size", "target")
    )


def apportion(claims: DataFrame, by: Sequence[str], seats: Column, votes: Column, most: Column, order: Sequence[Column]) -> DataFrame:
    """``claims`` with ``quota``: Sainte-Lague within each group ``by``; a claim gets ``most`` seats at most.

    ``seats`` is the same in all rows of a group. Ties go by ``order``.
    """
    group = Window.partitionBy(*by)
    counted = (
        claims.withColumn("__votes", votes.cast("double"))
        .withColumn("__seats", seats.cast("double"))
        .withColumn("__most", most.cast("long"))
        .withColumn("__all", F.nullif(F.sum("__votes").over(group), F.lit(0.0)))
        .withColumn("__slack", F.count("*").over(group) / 2.0)
    )
    sure = F.when(
        F.col("__seats") > F.col("__slack"),
        F.round(F.col("__votes") * (F.col("__seats") - F.col("__slack")) / F.col("__all")) - 1,
    ).otherwise(0)
    bound = F.round(F.col("__votes") * (F.col("__seats") + F.col("__slack")) / F.col("__all")) + 1
    limited = counted.withColumn("__low", F.least(F.greatest(F.coalesce(sure, F.lit(0)).cast("long"), F.lit(0)), "__most")).withColumn(
        "__high", F.least(F.coalesce(bound, F.lit(0)).cast("long"), F.col("__most"))
    )
    left = limited.withColumn("__left", F.col("__seats") - F.sum("__low").over(group))
    # One row for each seat between the bounds, and one (NULL) that keeps claims without any.
    tried = left.withColumn(
        "__k", F.explode_outer(F.when(F.col("__high") > F.col("__low"), F.sequence(F.col("__low"), F.col("__high") - 1)))
    ).withColumn("__quotient", F.col("__votes") / (2 * F.col("__k") + 1))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("__quotient").desc_nulls_last(), *order, "__k"))
    won = F.sum(F.when(F.col("__quotient").isNotNull() & (F.col("__rank") <= F.col("__left")), 1).otherwise(0))
    return (
        tried.withColumn("__rank", rank)
        .groupBy(*claims.columns)
        .agg((F.max("__low") + won).alias("quota"))
    )


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float],
    share: float = 1.5,
    max_repeats: int = 2,
    seed: int = 0,
    block: int = BLOCK,
    shard: int = SHARD,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of ``docs``.

    ``size``: words ``[^\\x20\\x09-\\x0d]+`` of the text, 0 for NULL. ``taken``: words the mix takes of the row, repeats counted,
    at most max_repeats times its size; the taken words of a source come within a few blocks per shard of its target. Rows with
    the same doc_id (or none) are rows of their own; between wholly equal rows it is left open which one is taken. Equal seeds
    give equal results for any partitioning. NULL is a source like any other. Other columns are ignored.
    """
    sized = cut_lineage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        )
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = set_targets(sources, weights, share, max_repeats).withColumn(
        "n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard)).cast("long")
    )
    quotas = cut_lineage(
        apportion(
            targets.withColumn("blocks", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")),
            [],
            F.col("blocks"),
            F.col("target"),
            max_repeats * F.ceil(F.col("source_size") / block),
            [F.col("source").asc_nulls_last()],
        ).select("source", "source_size", "target", "n_shards", F.col("quota").alias("source_quota"))
    ).withColumnRenamed("source", "__source")
    dealt = sized.join(quotas, F.col("source").eqNullSafe(F.col("__source"))).withColumn(
        "shard", F.pmod(number(draw(seed, F.col("doc_id"))), F.col("n_shards"))
    )
    key = ["__source", "shard"]
    shards = dealt.groupBy(*key, "source_quota").agg(F.sum("size").alias("shard_size")).withColumn(
        "n_blocks", F.ceil(F.col("shard_size") / block).cast("long")
    )
    won = apportion(
        shards, ["__source"], F.col("source_quota"), F.col("shard_size"), max_repeats * F.col("n_blocks"), [F.col("shard")]
    ).select(F.col("__source").alias("__s"), F.col("shard").alias("__shard"), "n_blocks", "shard_size", "quota")
    order = Window.partitionBy(*key).orderBy(draw(seed + 1, F.col("doc_id")), "doc_id", "size")
    placed = dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "start", F.col("end") - F.col("size")
    )
    whole = F.when(F.col("n_blocks") > 0, F.floor(F.col("quota") / F.col("n_blocks"))).otherwise(0)
    run = F.when(F.col("n_blocks") > 0, F.col("quota") % F.col("n_blocks")).otherwise(0)
    first = F.when(
        F.col("n_blocks") > 0, F.pmod(number(draw(seed + 2, F.col("source"), F.col("shard"))), F.col("n_blocks"))
    ).otherwise(0)

    def inside(begin: Column, stop: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("end"), stop * block) - F.greatest(F.col("start"), begin * block))

    taken = (
        F.col("whole") * F.col("size")
        + inside(F.col("first"), F.least(F.col("first") + F.col("run"), F.col("n_blocks")))
        + inside(F.lit(0), F.greatest(F.lit(0), F.col("first") + F.col("run") - F.col("n_blocks")))
    )
    return (
        placed.join(won, (F.col("__source").eqNullSafe(F.col("__s"))) & (F.col("shard") == F.col("__shard")))
        .withColumns({"whole": whole, "run": run, "first": first})
        .select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
    )
