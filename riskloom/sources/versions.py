"""Tables that change by publishing: parts are written aside, a log row makes them current, readers keep their version."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.longform import quoted
from riskloom.operators.merge import upsert
from riskloom.operators.rates import merge_partials, rate_partials

PART = "part"
PART_NAME = re.compile(r"[A-Za-z0-9_.-]{1,100}")
LOG = "version long, token string, part string, folder string, schema string"


class Conflict(RuntimeError):
    """Another writer published first."""


class VersionedTable:
    """A table of named parts below ``path``: ``data`` holds folders that never change, ``log`` says which are current.

    A publication writes its parts into a folder of its own, then appends one log
    file with a row per part; that file appears by one rename, so a reader sees
    all of a publication or nothing, and a write that fails leaves only a folder
    nobody refers to. Readers work from a version; folders of earlier ones stay.
    Of two writers that publish the same version the one whose log file is older
    (by the file system's time, then by token) holds; the other one gets a
    :class:`Conflict` and its rows never count. What comes to the driver is the
    current state, a row per part.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def log(self) -> DataFrame:
        """version, token, part, folder, schema: the publications that hold."""
        try:
            rows = self.spark.read.schema(LOG).parquet(f"{self.path}/log").select("*", F.col("_metadata.file_modification_time").alias("at"))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], f"{LOG}, at timestamp")
        first = rows.groupBy("version").agg(F.min_by("token", F.struct("at", "token")).alias("token"))
        return rows.drop("at").join(first, ["version", "token"])

    def version(self) -> int:
        """The latest version, 0 before the first publication."""
        return self.log().agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def state(self, version: int | None = None) -> dict[str, tuple[str, str]]:
        """part -> (folder, schema) as of a version."""
        log = self.log() if version is None else self.log().where(F.col("version") <= version)
        latest = log.groupBy(PART).agg(F.max_by(F.struct("folder", "schema"), "version").alias("last"))
        rows = latest.select(PART, "last.*").where("folder IS NOT NULL").collect()
        return {row[PART]: (row["folder"], row["schema"]) for row in rows}

    def read(self, version: int | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its parts; parts without a column have NULLs in it."""
        state = self.state(version)
        if parts is not None:
            state = {name: state[name] for name in parts if name in state}
        if not state:
            last = self.log().orderBy(F.desc("version"), PART).first()
            if last is None:
                raise ValueError(f"{self.path}: nothing has been published")
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(last["schema"])))
        by_schema: dict[str, list[str]] = {}
        for name in sorted(state):
            folder, schema = state[name]
            by_schema.setdefault(schema, []).append(f"{folder}/{PART}={name}")
        frames = [self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*folders) for schema, folders in by_schema.items()]
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame, allowMissingColumns=True)
        return whole

    def publish(self, rows: DataFrame, replaced: Sequence[str], based_on: int | None = None) -> int:
        """Replace the parts ``replaced`` by ``rows``, whose column ``part`` names the part of a row; the new version.

        Parts without a row become empty. ``based_on`` is the version the rows were
        made from; a later one in the table is a :class:`Conflict`.
        """
        odd = [name for name in replaced if not PART_NAME.fullmatch(name)]
        if odd:
            raise ValueError(f"unsafe part names: {odd}")
        token = uuid.uuid4().hex
        folder = f"{self.path}/data/{token}"
        body = rows.withColumn(PART, F.col(PART).cast("string"))
        schema = T.StructType([field for field in body.schema.fields if field.name != PART])
        body.write.partitionBy(PART).parquet(folder)
        written = {row[PART] for row in self.spark.read.schema(body.schema).parquet(folder).select(PART).distinct().collect()}
        strangers = sorted(str(name) for name in written - set(replaced))
        if strangers:
            raise ValueError(f"rows of parts that are not replaced: {strangers}")
        found = self.version()
        if based_on is not None and found != based_on:
            raise Conflict(f"{self.path}: version {found} was published since version {based_on}")
        entries = [(found + 1, token, name, folder if name in written else None, schema.json()) for name in sorted(set(replaced))]
        self.spark.createDataFrame(entries, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        if self.log().where((F.col("version") == found + 1) & (F.col("token") == token)).limit(1).count() == 0:
            raise Conflict(f"{self.path}: another writer published version {found + 1}")
        return found + 1


def publish_batch(table: VersionedTable, rows: DataFrame, batch: str) -> int:
    """Rows of one ingest batch; a batch that comes again replaces its own rows only."""
    return table.publish(rows.withColumn(PART, F.lit(batch)), [batch])


def publish_partials(table: VersionedTable, facts: DataFrame, batch: str, keys, flag, amount=None, scale: int | None = None) -> int:
    """Mergeable sums of one batch of facts, a row per key; only these facts are read."""
    return publish_batch(table, rate_partials(facts, keys, flag, amount, scale), batch)


def merged_partials(table: VersionedTable, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """Sums over all batches, for the rate reports with ``partials=True``; facts are not read again."""
    return merge_partials(table.read(version), keys)


def key_parts(key: str, parts: int):
    """The part of a key: one of ``parts`` ranges of its hash. Keys that are null have the part of null."""
    return F.pmod(F.xxhash64(F.col(quoted(key))), F.lit(parts)).cast("string")


def upsert_parts(table: VersionedTable, new: DataFrame, key: str, parts: int, sequence: str | None = None) -> int:
    """Upsert rows by key, rewriting only the parts of keys that occur in ``new``.

    The parts of the new keys come first, at most ``parts`` of them to the driver;
    stored rows of other parts are neither read nor written. Within a part it is
    :func:`riskloom.operators.merge.upsert`. ``parts`` must stay what it was when
    the table began.
    """
    version = table.version()
    rows = new.where(F.col(quoted(key)).isNotNull() & (F.col(quoted(key)).cast("string") != ""))
    touched = sorted(row[0] for row in rows.select(key_parts(key, parts)).distinct().collect())
    if not touched:
        return version
    there = table.read(version, touched) if version else rows.limit(0)
    merged = upsert(there.select(*rows.columns), rows, key, sequence)
    placed = merged.withColumn(PART, key_parts(key, parts)).repartition(PART)
    return table.publish(placed, touched, based_on=version)
