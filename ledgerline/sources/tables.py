"""Parquet tables under one root, all of them named by one manifest.

A table is a set of parts: the buckets of a key, the days of a load, or one part that is the whole. Files
are never written over. A commit writes new folders for the parts it replaces and then one new
manifest, which names the folder of every part of every table; putting that small file in
place is the only step that readers notice. So a day that changes several tables is visible in
all of them or in none, a run that breaks off leaves the last manifest as it was, and parts that a
commit does not touch stay where they are. Manifests are numbered, and a number is taken once: of two
writers the second is refused.

Folders that no kept manifest names go with ``vacuum``, by age, so a reader that began earlier
keeps its files.
"""

from __future__ import annotations

import copy
import datetime as dt
import json
import time
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from threading import RLock

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import schemas
from ledgerline.operators.merge import upsert
from ledgerline.session import delete_folder, files, folders, is_missing, place_text, read_text, several_writers

# Declared source tables: name -> schema.
CATALOG: dict[str, T.StructType] = {
    "app/merchants": schemas.MERCHANTS,
    "app/orders": schemas.ORDERS,
    "raw/orders": schemas.RAW_ORDERS,
    "raw/gateway_events": schemas.RAW_GATEWAY,
    "raw/settlements": schemas.RAW_SETTLEMENTS,
    "raw/rejected": schemas.REJECTED,
    "raw/pipeline_runs": schemas.RUN_LOG,
    "staging/merchants_snapshot": T.StructType(
        [*schemas.SNAPSHOT.fields, T.StructField("as_of", T.DateType())]
    ),
    "staging/answer_key": schemas.ANSWER_KEY,
}
# Buckets of keyed tables unless a root is made with another number, so that each is some hundred megabytes.
BUCKETS = 8
KEPT_SECONDS = 7 * 24 * 3600
# Hidden from readers of the folder by their underscore.
_MANIFESTS = "_manifests"
_PART = "part"
_WHOLE = "all"
# Kept tables are written once and read often.
_CODEC = "zstd"


class Conflict(RuntimeError):
    """Another writer has committed in between."""


class Tables:
    """Named tables below ``root``, a folder every executor can reach.

    A name without a manifest entry is a plain Parquet folder that another system writes, such as
    the application's orders.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        # The number a root was made with is kept in its manifest and holds from then on.
        self.buckets = self._latest().get("buckets", buckets)
        self._base: dict | None = None
        self._staged: dict | None = None
        self._lock = RLock()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # ---- manifests ----

    def _versions(self) -> list[int]:
        return sorted(int(f.removesuffix(".json")) for f in files(self.spark, self.path(_MANIFESTS)) if f.endswith(".json") and f[0].isdigit())

    def _manifest(self, version: int) -> dict:
        return json.loads(read_text(self.spark, self.path(f"{_MANIFESTS}/{version:012d}.json")))

    def _latest(self) -> dict:
        versions = self._versions()
        return self._manifest(versions[-1]) if versions else {"version": 0, "time": 0.0, "tables": {}}

    def _current(self, before: bool = False) -> dict:
        if self._staged is None:
            return self._latest()
        return self._base if before else self._staged

    @contextmanager
    def commit(self) -> Iterator[Tables]:
        """Everything written inside becomes visible together, at the end; nothing does if it fails.

        Reads inside see what was written inside, and with ``before`` what there was at the start.
        """
        if self._staged is not None:
            yield self
            return
        self._base = self._latest()
        self._staged = copy.deepcopy(self._base)
        try:
            yield self
            if self._staged["tables"] != self._base["tables"]:
                self._publish(self._staged | {"version": self._base["version"] + 1, "time": time.time(), "buckets": self.buckets})
        finally:
            self._base = self._staged = None

    def _publish(self, manifest: dict) -> None:
        name = f"{_MANIFESTS}/{manifest['version']:012d}.json"
        if not place_text(self.spark, self.path(name), json.dumps(manifest)):
            raise Conflict(f"version {manifest['version']} of {self.root} was written by someone else")

    def vacuum(self, older_than: float = KEPT_SECONDS) -> None:
        """Delete manifests that were replaced more than so many seconds ago, and the folders that
        only they name, or that a broken-off commit has left that long ago."""
        versions = self._versions()
        if not versions:
            return
        limit = time.time() - older_than
        manifests = [self._manifest(v) for v in versions]
        # A manifest is replaced when the next one is written.
        kept = [m for m, after in zip(manifests, [*manifests[1:], None]) if after is None or after["time"] > limit]
        for m in manifests[: len(manifests) - len(kept)]:
            delete_folder(self.spark, self.path(f"{_MANIFESTS}/{m['version']:012d}.json"))
        named = {"/".join(f.split("/")[:-1]) if f.rsplit("/", 1)[-1].startswith(f"{_PART}=") else f
                 for m in kept for t in m["tables"].values() for f in t["parts"].values()}
        for name in {n for m in manifests for n in m["tables"]}:
            for folder in folders(self.spark, self.path(name)):
                if folder.startswith("v-") and int(folder.split("-")[1]) / 1e9 < limit and f"{name}/{folder}" not in named:
                    delete_folder(self.spark, self.path(f"{name}/{folder}"))

    # ---- reading ----

    def parts(self, name: str, before: bool = False) -> dict[str, str]:
        """The folder of every part of a table."""
        entry = self._current(before)["tables"].get(name)
        return entry["parts"] if entry else {}

    def exists(self, name: str) -> bool:
        return name in self._current()["tables"]

    def read(
        self, name: str, schema: T.StructType | None = None, parts: Iterable[str] | None = None, before: bool = False
    ) -> DataFrame:
        """The table, or some of its parts; no rows if it has not been written yet and its schema is known.

        The application's orders always exist: without them the root is wrong, and a day
        must not be replaced by nothing.
        """
        entry = self._current(before)["tables"].get(name)
        if entry is None:
            return self._plain(name, schema or CATALOG.get(name))
        schema = T.StructType.fromJson(entry["schema"])
        wanted = entry["parts"] if parts is None else {p: entry["parts"][p] for p in parts if p in entry["parts"]}
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.path(f) for f in wanted.values()])

    def _plain(self, name: str, schema: T.StructType | None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        try:
            return reader.parquet(self.path(name))
        except AnalysisException as err:
            if schema is None or name == "app/orders" or not is_missing(err):
                raise
            return self.spark.createDataFrame([], schema)

    # ---- writing ----

    def put(
        self, name: str, df: DataFrame, part: Column | None = None, replaced: Iterable[str] | None = None
    ) -> DataFrame:
        """Replace the parts ``replaced`` of a table, or all of it, by ``df``, which may read the table.

        ``part`` names the part of each row. Parts of ``replaced`` that have no rows any more go.
        """
        folder = f"{name}/v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        if part is None:
            df.write.parquet(self.path(folder), compression=_CODEC)
            found = {_WHOLE: folder}
        else:
            # Rows stay in their tasks, which AQE or the scan has sized: a file per task and part costs less than
            # a shuffle of the table, and with a writer open per part nothing is sorted.
            several_writers(self.spark)
            named = df.withColumn(_PART, part.cast("string"))
            named.write.partitionBy(_PART).parquet(self.path(folder), compression=_CODEC)
            found = {urllib.parse.unquote(f.split("=", 1)[1]): f"{folder}/{f}" for f in folders(self.spark, self.path(folder)) if f.startswith(f"{_PART}=")}
        if replaced is not None and not set(found) <= set(replaced):
            raise ValueError(f"{name}: rows of parts that are not replaced: {sorted(set(found) - set(replaced))}")
        with self._lock, self.commit():
            entry = self._staged["tables"].get(name, {"parts": {}})
            kept = {} if replaced is None else {p: f for p, f in entry["parts"].items() if p not in set(replaced)}
            self._staged["tables"][name] = {"schema": df.schema.jsonValue(), "parts": kept | found}
        return self.read(name)

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Full rebuild of a table, which ``df`` may read."""
        return self.put(name, df)

    def drop(self, name: str) -> None:
        """Take a table out of the manifest."""
        with self._lock, self.commit():
            self._staged["tables"].pop(name, None)

    def append(self, name: str, df: DataFrame) -> None:
        """Add a part of its own to a table."""
        part = uuid.uuid4().hex
        self.put(name, df, F.lit(part), [part])

    def upsert(self, name: str, source: DataFrame, key: str, update_cols: list[str]) -> None:
        """Insert the new keys of ``source`` and overwrite ``update_cols`` of the known ones."""
        known = self.read(name, source.schema) if self.exists(name) else source.limit(0)
        self.overwrite(name, upsert(known, source, key, update_cols))

    def replace_partition(self, name: str, df: DataFrame, **keys) -> None:
        """Replace the rows with the values ``keys`` by ``df``, however often it is repeated."""
        part = ".".join(str(v) for v in keys.values())
        for column, value in keys.items():
            if column not in df.columns:
                df = df.withColumn(column, F.lit(value))
        self.put(name, df, F.lit(part), [part])

    def replace_day(self, name: str, df: DataFrame, run_date: dt.date) -> None:
        self.replace_partition(name, df, run_date=run_date)

    def load_days(self, name: str, df: DataFrame) -> None:
        """Make ``df`` the whole of a table that is kept by day of load."""
        self.put(name, df, F.col("run_date"))

    # ---- tables kept in buckets of a key ----

    def bucket(self, key: Column | str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("string")

    def buckets_of(self, keys: DataFrame, key: Column | str) -> list[str]:
        """The buckets that the keys are in; as many as there are buckets at most."""
        return [r[0] for r in keys.select(self.bucket(key)).distinct().collect()]
