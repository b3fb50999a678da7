"""What a session leaves on disk while it works."""

import time
from pathlib import Path

from pyspark.sql import functions as F

from fogline.session import DELETE_SHUFFLES, cut_lineage


def shuffle_files(spark):
    """Data files of all shuffles on this machine."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {p for d in folders for p in Path(d).rglob("shuffle_*.data")}


def gone(spark, new):
    """Whether the files go within 20 seconds: Spark deletes them beside its other work."""
    until = time.time() + 20
    while (left := new & shuffle_files(spark)) and time.time() < until:
        time.sleep(0.2)
    return not left


def test_cut_lineage_leaves_no_shuffle_files(spark):
    before, usual = shuffle_files(spark), spark.conf.get(DELETE_SHUFFLES)
    counts = spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count()
    pinned = cut_lineage(counts)
    assert gone(spark, shuffle_files(spark) - before)
    # Neither the frame itself nor the pinned one needs them, and frames made later keep theirs while they are used.
    assert counts.count() == pinned.count() == 7
    later = pinned.repartition(2)
    assert len(later.collect()) == len(later.collect()) == 7
    assert spark.conf.get(DELETE_SHUFFLES) == usual
