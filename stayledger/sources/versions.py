"""Tables in versions: every write is a folder of its own, and a record says which folders a name means.

A commit writes one small record that names the folders of all tables, so several tables
change at once or not at all. Readers keep what they opened: nothing that a record
named is removed but by ``expire``, by age. Records are numbered; a writer that finds its
number taken looks at the newer record and tries again, so commits of different tables do
not undo each other. The file system must refuse to create a file that exists, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from stayledger.session import TEXT_CODEC, remove_folder, shuffles_removed

RECORDS = "_versions"


class VersionConflict(RuntimeError):
    """The tables changed since the version that a commit builds on."""


class Versions:
    """The versioned tables under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # --- folders and records ---

    def _path(self, where: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(where)

    def _system(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[tuple[str, float]]:
        """(name, modification time) of what a folder holds."""
        system, path = self._system(), self._path(folder)
        if not system.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in system.listStatus(path)]

    def _numbers(self) -> list[int]:
        found = [name for name, _ in self._names(f"{self.root}/{RECORDS}") if name.endswith(".json")]
        return sorted((int(name[: -len(".json")]) for name in found), reverse=True)

    def _record_path(self, number: int) -> str:
        return f"{self.root}/{RECORDS}/{number:012d}.json"

    def _record(self, number: int) -> dict | None:
        """A record, or None for one that is still being written."""
        text = self.spark.read.text(self._record_path(number), wholetext=True).first()
        try:
            return json.loads(text[0]) if text else None
        except json.JSONDecodeError:
            return None

    def current(self) -> tuple[int, dict[str, dict]]:
        """The newest version and its tables; 0 and none before the first commit."""
        for number in self._numbers():
            if record := self._record(number):
                return number, record["tables"]
        return 0, {}

    def tables(self, version: int | None = None) -> dict[str, dict]:
        if version is None:
            return self.current()[1]
        if version not in self._numbers():
            raise KeyError(f"no version {version}")
        return self._record(version)["tables"]

    def log(self) -> list[tuple[int, datetime]]:
        """The versions that are kept, oldest first, with the time of their commit."""
        records = [(number, self._record(number)) for number in reversed(self._numbers())]
        return [(number, datetime.fromisoformat(r["committed_at"])) for number, r in records if r]

    # --- writing ---

    def new_folder(self, name: str) -> str:
        return f"{self.root}/{name}/{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame) -> dict:
        """Write rows and return the entry to commit; nothing reads them before that."""
        folder = self.new_folder(name)
        df.write.parquet(folder)
        return {"folders": [folder], "schema": df.schema.jsonValue()}

    def write_bucketed(self, name: str, parts: list[DataFrame], keys: list[str], buckets: int) -> dict:
        """Write parts of one table hash-distributed by ``keys``.

        A part that is distributed by the keys into as many partitions is written as it stands."""
        folder = self.new_folder(name)
        table = f"{name}__{uuid.uuid4().hex}"
        try:
            for k, part in enumerate(parts):
                writer = part.write.mode("append" if k else "error").format("parquet").option("compression", TEXT_CODEC)
                with shuffles_removed(self.spark):
                    writer.bucketBy(buckets, *keys).sortBy(*keys).option("path", folder).saveAsTable(table)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files of an external table stay
        return {"folders": [folder], "schema": parts[0].schema.jsonValue(), "keys": keys, "buckets": buckets}

    def more(self, entry: dict | None, added: dict) -> dict:
        """The entry of a table that keeps its rows and gets those of ``added``."""
        return added if entry is None else entry | {"folders": entry["folders"] + added["folders"]}

    def commit(self, changes: dict[str, dict | None], on: int | None = None) -> int:
        """Make entries current, all together; None takes a table away. Returns the version.

        ``on``: the version that the changes were computed from; any other current one is a conflict."""
        while True:
            number, tables = self.current()
            if on is not None and number != on:
                raise VersionConflict(f"version {number} came after {on}")
            tables = {name: entry for name, entry in (tables | changes).items() if entry is not None}
            number = max([number, *self._numbers()[:1]]) + 1
            said = {"committed_at": datetime.now(timezone.utc).isoformat(), "tables": tables}
            if self._create(self._record_path(number), json.dumps(said).encode()):
                return number

    def _create(self, where: str, body: bytes) -> bool:
        """Write a file unless it exists."""
        system, path = self._system(), self._path(where)
        try:
            stream = system.create(path, False)
        except Py4JJavaError:
            if system.exists(path):
                return False
            raise
        try:
            stream.write(bytearray(body))
        finally:
            stream.close()
        return True

    def restore(self, version: int) -> int:
        """Make the tables of an older version current again, as a new version."""
        old = self.tables(version)
        return self.commit({name: None for name in self.tables()} | old)

    # --- reading ---

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The rows of a table; a bucketed one is scanned as such, so that its keys need no shuffle."""
        return self.open(self.tables(version)[name])

    def open(self, entry: dict) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(entry["schema"])
        if "buckets" not in entry:
            return self.spark.read.schema(schema).parquet(*entry["folders"])
        table = f"opened__{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in entry["keys"])
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {entry['buckets']} BUCKETS LOCATION '{entry['folders'][0]}'"
        )
        try:
            return self.spark.table(table)
        finally:
            self.spark.sql(f"DROP TABLE {table}")  # the plan has its files; they stay

    # --- removing ---

    def expire(self, older_than: timedelta, now: datetime | None = None) -> list[str]:
        """Remove versions older than ``older_than`` but the newest, and folders that no version kept names.

        A folder younger than that stays, too: it may belong to a commit that is not made yet."""
        limit = (now or datetime.now(timezone.utc)) - older_than
        kept, log = [], self.log()
        for number, committed in log:
            if number == log[-1][0] or committed >= limit:
                kept.append(number)
            else:
                self._system().delete(self._path(self._record_path(number)), False)
        named = {f.rsplit("/", 1)[-1] for n in kept for e in self.tables(n).values() for f in e["folders"]}
        removed = []
        for name, _ in self._names(self.root):
            if name == RECORDS:
                continue
            for folder, changed in self._names(f"{self.root}/{name}"):
                if folder not in named and changed < limit.timestamp() and _is_ours(folder):
                    remove_folder(self.spark, f"{self.root}/{name}/{folder}")
                    removed.append(f"{name}/{folder}")
        return removed


def _is_ours(folder: str) -> bool:
    return len(folder) == 32 and all(c in "0123456789abcdef" for c in folder)
