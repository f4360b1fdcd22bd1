"""Tables in versions.

Every write goes to a folder of its own and counts from the moment its entry is
in the table's log; a run that is lost before leaves the table as it was.  An
entry names the folders that make up the version, so a refresh names one, an
append the earlier ones and its own, and a merge those it did not touch and
those it wrote anew.  Entries are written aside and renamed when whole.

Readers keep the version they opened: its folders stay until ``vacuum``, so a
table can be refreshed from a plan that reads it.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG = "_log"
#: a folder that no entry names may belong to a run at work; after these seconds it does not
GRACE_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Version:
    number: int
    #: relative to the table's path
    folders: tuple[str, ...]
    schema: T.StructType
    #: for tables dealt out by key: how many buckets there are
    buckets: int = 0
    #: what the writer wants to know of the version
    notes: tuple[str, ...] = ()


class VersionedTable:
    """A table of Parquet files at ``path`` in any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        jvm = spark._jvm
        self._jvm = jvm
        self._fs = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _names(self, *folder: str) -> list[str]:
        at = self._at(*folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        """All versions that can still be read, the newest last."""
        return sorted(int(n.removesuffix(".json")) for n in self._names(LOG) if n.endswith(".json") and not n.startswith("."))

    def exists(self) -> bool:
        return bool(self.numbers())

    def version(self, number: int | None = None) -> Version:
        known = self.numbers()
        if not known or number is not None and number not in known:
            raise FileNotFoundError(f"{self.path} has no version {'' if number is None else number}".rstrip())
        number = known[-1] if number is None else number
        stream = self._fs.open(self._at(LOG, _entry(number)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        entry = json.loads(text)
        schema = T.StructType.fromJson(entry["schema"])
        return Version(number, tuple(entry["folders"]), schema, entry["buckets"], tuple(entry["notes"]))

    def read(self, number: int | None = None) -> DataFrame:
        return self._frame(self.version(number))

    def _frame(self, version: Version) -> DataFrame:
        if not version.folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*[f"{self.path}/{f}" for f in version.folders])

    def write(self, df: DataFrame, append: bool = False) -> DataFrame:
        """Replace the rows, or add to them; returns the table as it is then."""
        return self.publish(self.prepare(df), df.schema, append)

    def prepare(self, df: DataFrame) -> str:
        """Write the rows to a new folder, which no reader sees before it is published."""
        folder = self.new_folder()
        df.write.parquet(f"{self.path}/{folder}")
        return folder

    @staticmethod
    def new_folder() -> str:
        return f"data-{uuid.uuid4().hex}"

    def publish(self, folder: str, schema: T.StructType, append: bool = False) -> DataFrame:
        def folders(now: Version | None) -> Iterable[str]:
            return [*(now.folders if append and now else ()), folder]

        return self._frame(self._commit(folders, schema))

    def replace(
        self, folder: str, schema: T.StructType, began: Version | None, notes: Sequence[str] = (), buckets: int = 0
    ) -> None:
        """Publish a folder that was made from the version ``began``; fails if there is a newer one by now."""

        def folders(now: Version | None) -> list[str]:
            if (now and now.number) != (began and began.number):
                raise RuntimeError(f"{self.path} was changed by another run")
            return [folder]

        self._commit(folders, schema, buckets, notes)

    def _commit(
        self,
        folders: Callable[[Version | None], Iterable[str]],
        schema: T.StructType,
        buckets: int = 0,
        notes: Sequence[str] = (),
    ) -> Version:
        """Enter the next version; ``folders`` makes its list from the version before."""
        while True:
            now = self.version() if self.exists() else None
            new = Version((now.number if now else 0) + 1, tuple(folders(now)), schema, buckets, tuple(notes))
            if self._enter(new):
                return new

    def _enter(self, version: Version) -> bool:
        """False if another writer entered this number first."""
        aside, entry = self._at(LOG, f".{uuid.uuid4().hex}"), self._at(LOG, _entry(version.number))
        stream = self._fs.create(aside, True)
        text = {
            "folders": version.folders, "schema": version.schema.jsonValue(), "buckets": version.buckets, "notes": version.notes,
        }
        stream.write(json.dumps(text).encode())
        stream.close()
        if not self._fs.exists(entry) and self._fs.rename(aside, entry):
            return True
        self._fs.delete(aside, False)
        return False

    # -- tables dealt out by key ----------------------------------------------

    def write_buckets(self, df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
        """Replace the rows, dealt out by the digest of ``keys``, so that ``merge_buckets`` can rewrite some of them."""
        folder, held = self._prepare_buckets(df, keys, buckets)
        return self._frame(self._commit(lambda _: [f"{folder}/{BUCKET}={b}" for b in held], df.schema, buckets))

    def read_buckets(self, numbers: Iterable[int]) -> DataFrame:
        """The rows of some buckets; the files of the others are not opened."""
        now = self.version()
        wanted = {f"{BUCKET}={n}" for n in numbers}
        return self._frame(Version(now.number, tuple(f for f in now.folders if f.rsplit("/", 1)[1] in wanted), now.schema))

    def merge_buckets(self, df: DataFrame, keys: Sequence[str], numbers: Iterable[int]) -> DataFrame:
        """Put ``df`` in the place of these buckets; the folders of all others stay as they are.

        ``df`` may read the table.  A writer that finds another version than it began with fails.
        """
        began = self.version()
        replaced = {f"{BUCKET}={n}" for n in numbers}
        folder, held = self._prepare_buckets(df, keys, began.buckets)
        if not {f"{BUCKET}={b}" for b in held} <= replaced:
            raise ValueError("rows of other buckets than those to be replaced")

        def folders(now: Version) -> list[str]:
            if now.number != began.number:
                raise RuntimeError(f"{self.path} was changed by another run")
            kept = [f for f in began.folders if f.rsplit("/", 1)[1] not in replaced]
            return kept + [f"{folder}/{BUCKET}={b}" for b in held]

        return self._frame(self._commit(folders, began.schema, began.buckets))

    def _prepare_buckets(self, df: DataFrame, keys: Sequence[str], buckets: int) -> tuple[str, list[int]]:
        folder = self.new_folder()
        number = bucket_of(keys, buckets)
        df.withColumn(BUCKET, number).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        names = [n for n in self._names(folder) if n.startswith(f"{BUCKET}=")]
        return folder, sorted(int(n.split("=")[1]) for n in names)

    # -- upkeep -----------------------------------------------------------------

    def vacuum(self, keep: int = 2, grace_seconds: float = GRACE_SECONDS) -> None:
        """Forget all but the last ``keep`` versions and delete folders that none of them names.

        A folder that no version ever named is deleted only when it is older than ``grace_seconds``.
        """
        numbers = self.numbers()
        kept, old = numbers[-max(keep, 1) :], numbers[: -max(keep, 1)]
        needed = {f for n in kept for f in self.version(n).folders}
        named = {f for n in old for f in self.version(n).folders}
        for n in old:
            self._fs.delete(self._at(LOG, _entry(n)), False)
        for f in named - needed:
            self._fs.delete(self._at(f), True)
        roots = {f.split("/", 1)[0] for f in needed}
        limit = time.time() - grace_seconds
        for name in self._names():
            if name == LOG or name in roots:
                continue
            status = self._fs.getFileStatus(self._at(name))
            if name in {f.split("/", 1)[0] for f in named} or status.getModificationTime() / 1000 < limit:
                self._fs.delete(self._at(name), True)


BUCKET = "_bucket"


def bucket_of(keys: Sequence[str], buckets: int):
    """The bucket of a row; null keys have one too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _entry(number: int) -> str:
    return f"{number:012d}.json"
