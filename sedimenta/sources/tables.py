"""Tables on a shared file system: versioned full swap, partition manifest, run-keyed append, watermark control.

All keep their state as logs of commits that are created only if absent, so of two writers that commit at
once one is told, and a run that is repeated with the same ``run_id`` changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.session import path_exists
from sedimenta.sources.commits import MOST_TRIES, CommitLog, ConcurrentCommit

_COMMIT_SCHEMA = "number bigint, run_id string, path string"
_CONTROL_SCHEMA = "pipeline_id string, run_id string, seq bigint, last_watermark timestamp_ntz"
_RUN_SCHEMA = (
    "number bigint, pipeline_id string, run_id string, extracted bigint, loaded bigint, rejected bigint, "
    "previous_watermark string, new_watermark string, landed struct<run_id: string, path: string, schema: string>"
)


class VersionedTable:
    """A table that is replaced whole: a new directory first, then one commit.

    Readers pin the version they resolved, so a swap never changes the files under them. Writers do not
    wait for each other: of two that publish at once both versions stay, the later commit being current.
    A writer whose rows come from the table itself names the version it has read, and is refused when another
    has been committed since; ``update`` then computes them again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.log = CommitLog(spark, f"{root}/_commits")

    def history(self) -> DataFrame:
        return self.log.frame(_COMMIT_SCHEMA).select(F.col("number").alias("version"), "run_id", "path")

    def current(self) -> dict | None:
        """The newest commit, or None."""
        number, record = self.log.last()
        return None if record is None else {"version": number, "run_id": record["run_id"], "path": record["path"]}

    def exists(self) -> bool:
        return self.log.last_number() > 0

    def publish(
        self, df: DataFrame, run_id: str, partition_by: tuple[str, ...] = (), expected: int | None = None
    ) -> int:
        """Write a new version and make it current. Repeating a committed run is a no-op.

        With ``expected`` the commit is refused unless that version is still current (0: no version).
        """
        done = self._committed(run_id, 0)
        if done is not None:
            return done
        path = f"{self.root}/v-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(path)
        return self.commit(path, df.schema.json(), run_id, expected)

    def commit(self, path: str, schema: str, run_id: str, expected: int | None = None) -> int:
        """Make a written directory current."""
        seen = 0
        for _ in range(MOST_TRIES):
            last = self.log.last_number()
            done = self._committed(run_id, seen)
            if done is not None:  # the same run, repeated by two writers at once
                return done
            if expected is not None and last != expected:
                raise ConcurrentCommit(f"version {last} of {self.root} was published over version {expected}")
            if self.log.put(last + 1, {"run_id": run_id, "path": path, "schema": schema}):
                return last + 1
            seen = last
        raise ConcurrentCommit(f"no commit after {MOST_TRIES} tries in {self.root}")

    def update(self, change: Callable[[DataFrame | None], DataFrame], run_id: str, partition_by: tuple[str, ...] = ()) -> int:
        """Publish what ``change`` makes of the current version, as often as it takes until no other came between."""
        for _ in range(MOST_TRIES):
            version = self.log.last_number()
            try:
                return self.publish(change(self.read(version) if version else None), run_id, partition_by, version)
            except ConcurrentCommit:
                continue
        raise ConcurrentCommit(f"no commit after {MOST_TRIES} tries in {self.root}")

    def read(self, version: int | None = None) -> DataFrame:
        record = self.log.get(version if version is not None else self.log.last_number())
        return self.spark.read.schema(T.StructType.fromJson(json.loads(record["schema"]))).parquet(record["path"])

    def _committed(self, run_id: str, after: int) -> int | None:
        """The version a run has committed after version ``after``."""
        if after:  # only what was committed while this writer tried
            found = [n for n in range(after + 1, self.log.last_number() + 1) if self.log.get(n)["run_id"] == run_id]
            return found[0] if found else None
        record = self.log.find(_COMMIT_SCHEMA, run_id=run_id)
        return None if record is None else record["number"]


class PartitionedTable:
    """A table in partitions that are replaced one by one: a commit maps each partition to its directory.

    A commit names only the partitions it replaces or drops; every ``FULL_EVERY``-th one repeats the whole
    map, so a reader follows few files. A reader pins a version and reads its directories to the end, whatever
    is committed meanwhile. Writers of different partitions do not disturb each other; one that has read a
    partition which another has replaced since is refused.
    """

    FULL_EVERY = 20

    def __init__(self, spark: SparkSession, root: str, partition: str):
        self.spark = spark
        self.root = root
        self.partition = partition
        self.log = CommitLog(spark, f"{root}/_commits")

    def version(self) -> int:
        return self.log.last_number()

    def entries(self, version: int | None = None) -> dict[str | None, dict]:
        """Each partition's directory and number of rows, as of a version; partition values are text."""
        number = self.version() if version is None else version
        steps = []
        while number > 0:
            record = self.log.get(number)
            steps.append(record)
            if record["full"]:
                break
            number -= 1
        found: dict[str | None, dict] = {}
        for record in reversed(steps):
            for value in record["drop"]:
                found.pop(value, None)
            found |= {e["value"]: e for e in record["set"]}
        return found

    def read(self, version: int | None = None, only: list | None = None) -> DataFrame:
        """The table as of a version, or the partitions ``only``; other directories are not even listed."""
        number = self.version() if version is None else version
        found = self.entries(number)
        wanted = found if only is None else [v for v in map(_text, only) if v in found]
        schema = T.StructType.fromJson(json.loads(self.log.get(number)["schema"]))
        paths = [found[v]["path"] for v in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replace(
        self, df: DataFrame, run_id: str, touched: list | None = None, based_on: int | None = None, splits: bool = False,
        placed: bool = False,
    ) -> int:
        """Replace the partitions in ``touched``, by default those that ``df`` has rows of.

        A touched partition without rows is dropped. Rows of other partitions are refused, unless the writer
        ``splits`` the touched ones into new ones. With ``based_on`` the commit is refused when a touched
        partition was replaced after that version. Rows that are ``placed``, all of a partition in one task, are
        written as they lie. Repeating a committed run is a no-op.
        """
        done = self.log.find("number bigint, run_id string", run_id=run_id)
        if done is not None:
            return done["number"]
        base = f"{self.root}/data-{uuid.uuid4().hex}"
        # The directory column is a copy, so the files keep all columns and need no path to be read. Its first
        # letter tells null from empty text, which share a directory otherwise.
        named = F.coalesce(F.concat(F.lit("v"), F.col(self.partition).cast("string")), F.lit("n"))
        copied = df.withColumn("_p", named)
        copied = copied if placed else copied.hint("rebalance", F.col("_p"))
        copied.write.partitionBy("_p").parquet(base)
        written = self._written(base, df.schema)
        gone = [v for v in map(_text, touched or []) if v not in written]
        if touched is not None and not splits and set(written) - {_text(v) for v in touched}:
            raise ValueError("rows of partitions that are not in touched")
        changed, seen = {*written, *gone}, self.version() if based_on is None else based_on
        for _ in range(MOST_TRIES):
            last = self.version()
            for number in range(seen + 1, last + 1):
                record = self.log.get(number)
                if record["run_id"] == run_id:
                    return number
                if based_on is not None and changed & {*record["drop"], *(e["value"] for e in record["changed"])}:
                    raise ConcurrentCommit(f"version {number} of {self.root} replaced a partition read at version {based_on}")
            seen = max(seen, last)
            entries = list(written.values())
            full = (last + 1) % self.FULL_EVERY == 0 or last == 0
            whole = list(({k: e for k, e in self.entries(last).items() if k not in changed} | written).values()) if full else entries
            record = {"run_id": run_id, "full": full, "set": whole, "changed": entries, "drop": gone, "schema": df.schema.json()}
            if self.log.put(last + 1, record):
                return last + 1
        raise ConcurrentCommit(f"no commit after {MOST_TRIES} tries in {self.root}")

    def purge(self) -> int:
        """Delete every directory that the newest version does not name; how many there were.

        Older versions cannot be read afterwards, which erasure asks for. No writer may be at work meanwhile.
        """
        named = {"/".join(e["path"].rsplit("/", 2)[-2:]) for e in self.entries().values()}
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        deleted = 0
        for data in (s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("data-")):
            parts = [s.getPath() for s in fs.listStatus(data) if s.getPath().getName().startswith("_p=")]
            stale = [p for p in parts if f"{data.getName()}/{p.getName()}" not in named]
            for path in stale if len(stale) < len(parts) else [data]:
                fs.delete(path, True)
            deleted += len(stale)
        return deleted

    def _written(self, base: str, schema: T.StructType) -> dict[str | None, dict]:
        """The partitions of a new directory, with their numbers of rows."""
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("_p", T.StringType())])).parquet(base)
        folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]*$", 1)
        counted = rows.groupBy(folder.alias("path")).agg(F.count(F.lit(1)).alias("rows")).collect()
        found = {}
        for r in counted:
            name = unquote(unquote(r["path"]).rsplit("/_p=", 1)[1])
            value = name[1:] if name[0] == "v" else None
            found[value] = {"value": value, "path": unquote(r["path"]), "rows": r["rows"]}
        return found


def _text(value) -> str | None:
    return None if value is None else str(value)


class AppendTable:
    """Rows of named batches, each appended once: a batch that is committed under its name is not written again."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.log = CommitLog(spark, f"{root}/_commits")

    def append(self, df: DataFrame, name: str, expected: int | None = None) -> None:
        """Append a batch; with ``expected``, only if that is still the number of the last commit."""
        if self._committed(name):
            return
        path = f"{self.root}/data-{uuid.uuid4().hex}"
        df.write.parquet(path)
        for _ in range(MOST_TRIES):
            number = self.log.last_number() + 1 if expected is None else expected + 1
            if self.log.put(number, {"run_id": name, "path": path, "schema": df.schema.json()}) or self._committed(name):
                return
            if expected is not None:
                raise ConcurrentCommit(f"{self.root} has grown beyond commit {expected}")
        raise ConcurrentCommit(f"no commit after {MOST_TRIES} tries in {self.root}")

    def _committed(self, name: str) -> bool:
        return self.log.find(_COMMIT_SCHEMA, run_id=name) is not None

    def read(self) -> DataFrame:
        _number, newest = self.log.last()
        if newest is None:
            raise ValueError(f"nothing was appended to {self.root}")
        paths = [r["path"] for r in self.log.frame(_COMMIT_SCHEMA).select("path").collect()]
        return self.spark.read.schema(T.StructType.fromJson(json.loads(newest["schema"]))).parquet(*paths)


class LandingTable:
    """Append target of runs, each with its valid and its rejected rows.

    One scan and one write route the rows of a run; a commit then makes them visible. Of a repeated run only
    the last commit counts. ``valid`` and ``rejected`` read only their own partitions.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.log = CommitLog(spark, f"{root}/_commits")

    def stage(self, routed: DataFrame, run_id: str, *extra_metrics) -> tuple[dict, dict]:
        """Write rows that carry ``reason_code`` (NULL = valid); the counts, and what ``commit`` needs."""
        observation = Observation()
        is_valid = F.col("reason_code").isNull()
        path = f"{self.root}/run_id={quote(run_id, safe='')}/write={uuid.uuid4().hex}"
        (
            routed.withColumn("route", F.when(is_valid, "valid").otherwise("rejected"))
            .observe(
                observation,
                F.count(F.lit(1)).alias("extracted"),
                F.count(F.when(is_valid, 1)).alias("loaded"),
                F.count(F.when(~is_valid, 1)).alias("rejected"),
                *extra_metrics,
            )
            .write.partitionBy("route")
            .parquet(path)
        )
        return observation.get, {"run_id": run_id, "path": path, "schema": routed.schema.json()}

    def commit(self, staged: dict) -> None:
        """Make a staged run visible; doing it again changes nothing."""
        done = self.log.find(_COMMIT_SCHEMA, run_id=staged["run_id"])
        if done is None or done["path"] != staged["path"]:
            self.log.append(lambda _: staged)

    def write_run(self, routed: DataFrame, run_id: str, *extra_metrics) -> dict:
        """Stage and commit a run; its counts."""
        metrics, staged = self.stage(routed, run_id, *extra_metrics)
        self.commit(staged)
        return metrics

    def _route(self, route: str) -> DataFrame:
        number, newest = self.log.last()
        if newest is None:
            raise ValueError(f"no run was committed to {self.root}")
        runs = self.log.frame(_COMMIT_SCHEMA).groupBy("run_id").agg(F.max_by("path", "number").alias("path")).collect()
        # Run ids that look like numbers or dates must not be read as such; a run without rows has no files.
        schema = T.StructType(T.StructType.fromJson(json.loads(newest["schema"])).fields)
        for name in ("run_id", "write", "route"):
            schema = schema.add(name, T.StringType())
        rows = self.spark.read.schema(schema).option("basePath", self.root).parquet(*[r["path"] for r in runs])
        return rows.where(F.col("route") == route).drop("route", "write")

    def valid(self) -> DataFrame:
        return self._route("valid").drop("reason_code")

    def rejected(self, run_id: str | None = None) -> DataFrame:
        rows = self._route("rejected")
        return rows if run_id is None else rows.where(F.col("run_id") == run_id)


class WatermarkControl:
    """The runs of every load with the watermark each one left, a commit per run.

    A run names the position it has read its watermark at. If another run of the same load was committed
    since, it is refused, so no two runs load one interval.
    """

    def __init__(self, spark: SparkSession, root: str, default: str = "1900-01-01 00:00:00"):
        self.spark = spark
        self.path = f"{root}/_runs"
        self.default = default

    def runs(self, pipeline_id: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path}/{quote(pipeline_id, safe='')}")

    def position(self, pipeline_id: str) -> tuple[int, str]:
        """The number of the last run and the watermark it left."""
        number, last = self.runs(pipeline_id).last()
        return number, self.default if last is None else last["new_watermark"]

    def watermark(self, pipeline_id: str) -> str:
        return self.position(pipeline_id)[1]

    def record(self, result: dict, after: int | None = None) -> None:
        """Commit a run, as the next one after the run numbered ``after``."""
        runs = self.runs(result["pipeline_id"])
        if after is None:
            runs.append(lambda _: result)
        elif not runs.put(after + 1, result):
            raise ConcurrentCommit(f"another run of {result['pipeline_id']} was committed")

    def recorded(self, pipeline_id: str, run_id: str) -> dict | None:
        """A committed run, or None."""
        return self.runs(pipeline_id).find(_RUN_SCHEMA, run_id=run_id)

    def log(self) -> DataFrame:
        """The watermarks in the order in which each load moved them."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _CONTROL_SCHEMA)
        runs = self.spark.read.schema(_RUN_SCHEMA).json(f"{self.path}/*/[0-9]*.json")
        moved = runs.where(F.col("new_watermark") != F.col("previous_watermark"))
        seq = F.row_number().over(Window.partitionBy("pipeline_id").orderBy("number")).cast("bigint")
        return moved.select("pipeline_id", "run_id", seq.alias("seq"), F.col("new_watermark").cast("timestamp_ntz").alias("last_watermark"))
