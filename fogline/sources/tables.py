"""Tables of Parquet files that change by whole commits.

``<path>/data/commit=<id>/`` holds the files a commit wrote, ``<path>/manifests/<id>/`` one row per file of a state (partition,
rows, smallest and largest key) as Parquet, and ``<path>/versions/<number>.json`` names the manifest of each state. A
commit writes files, then the manifest, and comes into force by one rename of the small version file, which
fails where that number exists. So readers see the old or the new state, whatever dies in between, and of two writers
that began from the same state one is refused.

Files hold ranges of the key. A merge looks up which files hold a staged key (ranges first, then the key columns of the files left) and
rewrites those only; all others are taken over by name. ``sweep`` deletes what no kept state names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fogline.session import cut_lineage

#: Rows of a file, ranges that staged keys are summed up in when files are looked up.
FILE_ROWS, KEY_RANGES = 1_000_000, 64
FILE, PART = "__file", "__part"


def _file_name() -> Column:
    """A row's file from the commit's folder on, as the manifest has it; Spark shows paths in URL form."""
    shown = F.regexp_extract("_metadata.file_path", r"(commit=[^/]+/.+)$", 1)
    return F.url_decode(F.replace(shown, F.lit("+"), F.lit("%2B")))


def _folder_name(value: Column) -> Column:
    """A partition's value as text that keeps '' apart from NULL."""
    return F.concat(F.lit("="), value.cast("string"))


class CommitConflict(RuntimeError):
    """Another writer has changed the table; read it again and repeat the change."""


@dataclass(frozen=True)
class State:
    """One state of a table: its number, the manifest that lists its files, its columns, and the layout its files were written in."""

    number: int
    manifest: str
    schema: T.StructType
    layout: tuple[tuple[str, ...], str | None]


class FileTable:
    """A table that is replaced, merged into or replaced by partitions, in commits.

    ``keys``: columns whose ranges are recorded per file (none: merges look at all files). ``partition``: a column whose values each
    lie in files of their own. A file holds about ``file_rows`` rows; more than one writer may try to commit, one succeeds.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = (), partition: str | None = None, file_rows: int = FILE_ROWS):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.partition, self.file_rows = tuple(keys), partition, file_rows

    # -- states ------------------------------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, fs = self._hadoop(f"{self.path}/versions")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, number: int | None = None) -> State | None:
        """The given state, by default the newest; None where the table has none."""
        known = self.versions()
        if not known:
            return None
        number = known[-1] if number is None else number
        # One small document.
        text = self.spark.read.text(f"{self.path}/versions/{number:012d}.json", wholetext=True).first()[0]
        said = json.loads(text)
        return State(number, said["manifest"], T.StructType.fromJson(said["schema"]), (tuple(said["keys"]), said["partition"]))

    def exists(self) -> bool:
        return bool(self.versions())

    def files(self, state: State) -> DataFrame:
        """(file, part, n_rows, least, greatest) of a state's files; the key range as structs."""
        return self.spark.read.schema(self._manifest_type(state)).parquet(f"{self.path}/manifests/{state.manifest}")

    @staticmethod
    def _manifest_type(state: State) -> T.StructType:
        span = T.StructType([T.StructField(k, state.schema[k].dataType) for k in state.layout[0]] or [T.StructField("none", T.StringType())])
        fields = [("file", T.StringType()), ("part", T.StringType()), ("n_rows", T.LongType()), ("least", span), ("greatest", span)]
        return T.StructType([T.StructField(n, t) for n, t in fields])

    # -- reading -----------------------------------------------------------------------------------------------------

    def read(self, number: int | None = None) -> DataFrame:
        """Rows of the newest (or given) state."""
        state = self.state(number)
        if state is None:
            raise FileNotFoundError(f"no state at {self.path}")
        return self._rows(state, self.files(state)).drop(FILE)

    def _rows(self, state: State, files: DataFrame) -> DataFrame:
        """Rows of some files with the file they come from. A reader needs the names, so they pass through the driver."""
        names = [r[0] for r in files.select("file").collect()]
        if not names:
            return self.spark.createDataFrame([], state.schema).withColumn(FILE, F.lit(None).cast("string"))
        data = f"{self.path}/data"
        frame = self.spark.read.schema(state.schema).option("basePath", data).parquet(*[f"{data}/{n}" for n in names])
        return frame.select(*state.schema.fieldNames(), _file_name().alias(FILE))

    # -- changing ----------------------------------------------------------------------------------------------------

    def replace(self, df: DataFrame) -> int:
        """The whole table becomes ``df``."""
        state = self.state()
        return self._commit(state, df, None)

    def append(self, df: DataFrame) -> int:
        """Add rows in the table's columns and types; a missing column stops the load.

        Not idempotent: a caller that may run twice replaces or merges instead.
        """
        state = self.state()
        if state is None:
            return self._commit(None, df, None)
        missing = [f.name for f in state.schema if f.name not in df.columns]
        if missing:
            raise ValueError(f"append lacks columns: {', '.join(missing)}")
        return self._commit(state, df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in state.schema]), self.files(state))

    def replace_partitions(self, df: DataFrame, values: Sequence) -> int:
        """All rows of these partitions become those of ``df``; values without rows end up empty, other partitions keep their files."""
        state = self.state()
        known = [F.lit(v) for v in values if v is not None]
        mine = F.coalesce(F.col(self.partition).isin(*known), F.lit(False)) if known else F.lit(False)
        rows = df.where(mine | F.col(self.partition).isNull() if None in values else mine)
        return self._commit(state, rows, None if state is None else self.files(state).where(~self._of_partitions(values)))

    def merge_partitions(self, changed: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int | None:
        """``merge(existing rows, changed)`` in the partitions that ``changed`` touches; None where it is empty."""
        changed = cut_lineage(changed)
        # A change covers a handful of partitions.
        values = [r[0] for r in changed.select(self.partition).distinct().collect()]
        if not values:
            return None
        state = self.state()
        if state is None:
            return self._commit(None, merge(self.spark.createDataFrame([], changed.schema), changed), None)
        hit = self._of_partitions(values)
        old = self._rows(state, self.files(state).where(hit)).drop(FILE)
        return self._commit(state, merge(old, changed), self.files(state).where(~hit))

    def merge(
        self,
        staged: DataFrame,
        merge: Callable[[DataFrame, DataFrame], DataFrame],
        also: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """``merge(rows of the files that hold a staged key, staged)`` takes the place of those files.

        A file is hit when it holds one of the staged ``keys`` (NULL equals nothing), or a row that ``also`` picks out of all rows: it gets
        the rows with their file and returns those it wants changed. Files that are not hit are neither read whole nor rewritten.
        """
        state = self.state()
        if state is None:
            raise FileNotFoundError(f"no state at {self.path}")
        files = self.files(state)
        held = self._rows(state, self._near(files, staged) if self.keys else files)
        hits = held.select(*self.keys, FILE).join(staged.select(*self.keys).dropDuplicates(), list(self.keys), "left_semi").select(FILE)
        if also is not None:
            hits = hits.unionByName(also(self._rows(state, files)).select(FILE))
        hits = cut_lineage(hits.distinct().withColumnRenamed(FILE, "file"))
        old = self._rows(state, hits).drop(FILE)
        return self._commit(state, merge(old, staged), files.join(hits, "file", "left_anti"))

    def _near(self, files: DataFrame, staged: DataFrame) -> DataFrame:
        """The files whose key range meets a range of staged keys; the ranges are KEY_RANGES at most."""
        whole = staged.select(*self.keys).dropna()
        spans = (
            whole.repartitionByRange(KEY_RANGES, *self.keys)
            .select(F.struct(*self.keys).alias("k"), F.spark_partition_id().alias("r"))
            .groupBy("r")
            .agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        )
        meets = (F.col("least") <= F.col("hi")) & (F.col("greatest") >= F.col("lo"))
        return files.join(F.broadcast(spans), meets, "left_semi")

    def _of_partitions(self, values: Sequence) -> Column:
        known = [_folder_name(F.lit(v)) for v in values if v is not None]
        hit = F.coalesce(F.col("part").isin(*known), F.lit(False)) if known else F.lit(False)
        return hit | F.col("part").isNull() if None in values else hit

    def _commit(self, state: State | None, df: DataFrame, kept: DataFrame | None) -> int:
        """Write ``df`` and a manifest of its files and the kept ones, then make them the next state."""
        commit = uuid.uuid4().hex
        schema = df.schema
        if state is not None and kept is not None and df.schema.fieldNames() != state.schema.fieldNames():
            raise ValueError(f"a change must have the table's columns {state.schema.fieldNames()}, not {schema.fieldNames()}")
        if state is not None and kept is not None and state.layout != (self.keys, self.partition):
            raise ValueError(f"the table's files are laid out by {state.layout}, not {(self.keys, self.partition)}")
        self._write(df, f"{self.path}/data/commit={commit}")
        entries = self._entries(commit, schema)
        manifest = entries if kept is None else kept.unionByName(entries)
        manifest.repartition(1 + self._count(kept) // 100_000).write.parquet(f"{self.path}/manifests/{commit}")
        said = {"manifest": commit, "schema": schema.jsonValue(), "keys": self.keys, "partition": self.partition}
        self._publish(0 if state is None else state.number + 1, said)
        return 0 if state is None else state.number + 1

    @staticmethod
    def _count(files: DataFrame | None) -> int:
        return 0 if files is None else files.count()

    def _write(self, df: DataFrame, folder: str) -> None:
        order = [*([self.partition] if self.partition else []), *self.keys]
        if self.keys:
            # Ranges of the key, cut by sampling; one range may become several files.
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        elif self.partition:
            df = df.hint("rebalance", self.partition)
        writer = df.write.option("maxRecordsPerFile", self.file_rows)
        if self.partition:
            # The column itself stays in the files, so a reader needs nothing from their names.
            writer = df.withColumn(PART, _folder_name(F.col(self.partition))).write.option("maxRecordsPerFile", self.file_rows).partitionBy(PART)
        writer.parquet(folder)

    def _entries(self, commit: str, schema: T.StructType) -> DataFrame:
        """Manifest rows of the files a commit wrote, from their key columns."""
        folder = f"{self.path}/data/commit={commit}"
        typed = T.StructType([*schema.fields, *([T.StructField(PART, T.StringType())] if self.partition else [])])
        rows = self.spark.read.schema(typed).parquet(folder)
        span = F.struct(*self.keys) if self.keys else F.struct(F.lit(None).cast("string").alias("none"))
        part = F.col(PART) if self.partition else F.lit(None).cast("string")
        return (
            rows.select(_file_name().alias("file"), part.alias("part"), span.alias("k"))
            .groupBy("file", "part")
            .agg(F.count("*").alias("n_rows"), F.min("k").alias("least"), F.max("k").alias("greatest"))
        )

    def _publish(self, number: int, said: dict) -> None:
        """Rename a finished version file into its place; refused if that number is taken."""
        pending = f"{self.path}/pending/{uuid.uuid4().hex}.json"
        path, fs = self._hadoop(pending)
        stream = fs.create(path, False)
        stream.write(bytearray(json.dumps(said).encode()))
        stream.close()
        target, _ = self._hadoop(f"{self.path}/versions/{number:012d}.json")
        fs.mkdirs(target.getParent())
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        files = hadoop.FileContext.getFileContext(fs.makeQualified(path).toUri(), self.spark._jsc.hadoopConfiguration())
        no_overwrite = self.spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        no_overwrite[0] = hadoop.Options.Rename.NONE
        try:
            files.rename(fs.makeQualified(path), fs.makeQualified(target), no_overwrite)
        except Exception as error:
            if "FileAlreadyExists" in str(error):
                fs.delete(path, False)
                raise CommitConflict(f"state {number} of {self.path} was written meanwhile") from error
            raise

    # -- clean-up ----------------------------------------------------------------------------------------------------

    def sweep(self, keep: int = 2, older_than_seconds: float = 86_400) -> int:
        """Delete all but the newest ``keep`` states and every file that these do not name; how many files went.

        What is younger than ``older_than_seconds`` stays, as a running writer may still need it.
        """
        known = self.versions()
        kept = known[-keep:] if keep else []
        states = [self.state(n) for n in kept]
        names = [self.files(s).select("file") for s in states]
        for number in known[: len(known) - len(kept)]:
            path, fs = self._hadoop(f"{self.path}/versions/{number:012d}.json")
            fs.delete(path, False)
        limit = int(self.spark._jvm.java.lang.System.currentTimeMillis() - older_than_seconds * 1000)
        folder, fs = self._hadoop(f"{self.path}/data")
        if not fs.exists(folder):
            return 0
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{self.path}/data")
        found = listed.select(F.regexp_extract("path", r"(commit=[^/]+/.+)$", 1).alias("file"), F.unix_millis("modificationTime").alias("at"))
        gone = found.where(F.col("at") <= limit)
        for named in names:
            gone = gone.join(named, "file", "left_anti")
        # Names of files that go, one at a time: deleting is a call to the file store each.
        n = 0
        for row in gone.select("file").toLocalIterator():
            path, fs = self._hadoop(f"{self.path}/data/{row['file']}")
            n += bool(fs.delete(path, False))
        manifests, fs = self._hadoop(f"{self.path}/manifests")
        for status in fs.listStatus(manifests):
            if status.getPath().getName() not in {s.manifest for s in states} and status.getModificationTime() <= limit:
                fs.delete(status.getPath(), True)
        return n
