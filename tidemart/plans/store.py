"""Landing tables as a compacted base and a tail of batches, named by a manifest.

Layout below ``<root>/<table>``::

    base/gen=<n>/month=<yyyymm>/   one version per key, tombstones kept, sorted by key
    tail/batch=<name>/             change rows as they arrived
    manifest-<n>.json              what counts: generation of each month, batches of the tail

``append`` adds a batch. ``compact`` merges the tail into the months it touches: those of its own
rows and those of the base rows with its keys (a key's date can move); they become a new
generation, and every other month keeps its files. A manifest is written whole and renamed into
place last, so readers see the old state or the new one; a crash leaves only
files that no manifest names, which ``vacuum`` deletes.

Reading merges on the fly: base rows whose key is not in the tail need no dedup.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.exprs import yyyymm
from tidemart.operators.cdc import latest_version
from tidemart.plans.landing import STORED, Landing
from tidemart.session import _fs, child_names, delete_path, path_exists
from tidemart.sources.schemas import IS_DELETED, LANDING, ts_lit

NO_MONTH = 0  # tables without a partition date have a single part


class ManifestConflict(RuntimeError):
    """Another writer has published the same manifest number first."""


def read_small(spark: SparkSession, path: str) -> str:
    """Text of a small file that this module has written, from whatever store the path is in."""
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a small file whole: under another name first, then renamed. False if the name is taken."""
    target, fs = _fs(spark, path)
    source, _ = _fs(spark, f"{path.rsplit('/', 1)[0]}/_new-{uuid.uuid4().hex}")
    out = fs.create(source, False)
    out.write(bytearray(text.encode()))
    out.close()
    if replace:
        fs.delete(target, False)
    if fs.exists(target) or not fs.rename(source, target):
        fs.delete(source, False)
        return False
    return True


class LandingStore:
    """Base plus tail of each landing table below ``root``; one writer per table at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- manifests ---------------------------------------------------------------------------

    def _numbers(self, table: str) -> list[int]:
        names = child_names(self.spark, f"{self.root}/{table}")
        return sorted(int(n[len("manifest-"):-len(".json")]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def position(self, table: str) -> int:
        """Number of the newest manifest; 0 if there is none."""
        return max(self._numbers(table), default=0)

    def manifest(self, table: str, position: int | None = None) -> dict:
        """``months``: {month: generation}, ``tail``: batches in order, ``added``: the batch this step added."""
        n = self.position(table) if position is None else position
        if n == 0:
            return {"months": {}, "tail": [], "added": None}
        return json.loads(read_small(self.spark, f"{self.root}/{table}/manifest-{n:09d}.json"))

    def _publish(self, table: str, n: int, manifest: dict) -> None:
        if not write_small(self.spark, f"{self.root}/{table}/manifest-{n:09d}.json", json.dumps(manifest | {"time": time.time()})):
            raise ManifestConflict(f"{table}: manifest {n} exists")

    # -- writing ------------------------------------------------------------------------------

    def append(self, table: str, rows: DataFrame, batch: str) -> None:
        """Add change rows as the batch ``batch``. A batch that has been added before changes nothing (a replay)."""
        n = self.position(table)
        old = self.manifest(table, n)
        if batch in old["tail"] or self._was_added(table, batch):
            return
        t = LANDING[table]
        rows = rows.select(*[f.name for f in t.schema.fields])
        rows.write.mode("overwrite").option("compression", STORED).parquet(f"{self.root}/{table}/tail/batch={batch}")
        self._publish(table, n + 1, {**old, "tail": [*old["tail"], batch], "added": batch})

    def _was_added(self, table: str, batch: str) -> bool:
        return path_exists(self.spark, f"{self.root}/{table}/tail/batch={batch}/_SUCCESS") and any(
            self.manifest(table, n)["added"] == batch for n in self._numbers(table))

    def compact(self, table: str) -> list[int]:
        """Merge the tail into the base; returns the months that were written."""
        n, t = self.position(table), LANDING[table]
        old = self.manifest(table, n)
        if not old["tail"]:
            return []
        tail, key = self._with_month(table, self._tail(table, old)), list(t.sort_key)
        base = self._base(table, old)
        months = {r[0] for r in tail.select("month").distinct().collect()}
        if base is not None and t.month_of and t.month_of not in t.sort_key:
            # the month is not part of the key: the older version of a key may lie in another month
            keys = tail.select(*key).distinct()
            months |= {r[0] for r in base.join(keys, key, "left_semi").select("month").distinct().collect()}
        rows = tail
        if base is not None:
            rows = base.where(F.col("month").isin(sorted(months))).select(*tail.columns).unionByName(tail)
        merged = latest_version(rows, t.sort_key).repartitionByRange("month", *key).sortWithinPartitions("month", *key)
        path = f"{self.root}/{table}/base/gen={n + 1}"
        merged.write.mode("overwrite").option("compression", STORED).partitionBy("month").parquet(path)
        present = {int(m.removeprefix("month=")) for m in child_names(self.spark, path) if m.startswith("month=")}
        kept = {m: g for m, g in old["months"].items() if int(m) not in months}
        self._publish(table, n + 1, {"months": kept | {str(m): n + 1 for m in sorted(present)}, "tail": [], "added": None})
        return sorted(months)

    def vacuum(self, table: str, keep: int = 2) -> int:
        """Delete files that none of the last ``keep`` manifests names, and older manifests; returns how many folders went."""
        numbers, at, gone = self._numbers(table), f"{self.root}/{table}", 0
        live = [self.manifest(table, n) for n in numbers[-keep:]]
        parts = {(int(g), int(m)) for x in live for m, g in x["months"].items()}
        batches = {b for x in live for b in x["tail"]} | {x["added"] for x in live}
        for g in child_names(self.spark, f"{at}/base"):
            generation = int(g.removeprefix("gen="))
            if generation > max(numbers, default=0):
                continue  # being written
            months = [m for m in child_names(self.spark, f"{at}/base/{g}") if m.startswith("month=")]
            dead = [m for m in months if (generation, int(m.removeprefix("month="))) not in parts]
            for m in dead:
                delete_path(self.spark, f"{at}/base/{g}/{m}")
            gone += len(dead)
            if len(dead) == len(months):
                delete_path(self.spark, f"{at}/base/{g}")
        for b in child_names(self.spark, f"{at}/tail"):
            if b.removeprefix("batch=") not in batches and self._known(table, b.removeprefix("batch="), numbers):
                delete_path(self.spark, f"{at}/tail/{b}")
                gone += 1
        for n in numbers[:-keep]:
            delete_path(self.spark, f"{at}/manifest-{n:09d}.json")
        return gone

    def _known(self, table: str, batch: str, numbers: list[int]) -> bool:
        return any(self.manifest(table, n)["added"] == batch for n in numbers)

    # -- reading ------------------------------------------------------------------------------

    def _with_month(self, table: str, df: DataFrame) -> DataFrame:
        month = LANDING[table].month_of
        return df.withColumn("month", yyyymm(month) if month else F.lit(NO_MONTH))

    def _base(self, table: str, manifest: dict) -> DataFrame | None:
        """Base rows with ``month``, a partition column (Spark opens only the months that a filter leaves)."""
        at, t = f"{self.root}/{table}/base", LANDING[table]
        folders = [f"{at}/gen={g}/month={m}" for m, g in manifest["months"].items()]
        if not folders:
            return None
        schema = T.StructType([*t.schema.fields, T.StructField("gen", T.IntegerType()), T.StructField("month", T.IntegerType())])
        return self.spark.read.schema(schema).option("basePath", at).parquet(*folders).drop("gen")

    def _batches(self, table: str, batches: list[str]) -> DataFrame:
        schema = LANDING[table].schema
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/tail/batch={b}" for b in batches])

    def _tail(self, table: str, manifest: dict) -> DataFrame:
        return self._batches(table, manifest["tail"])

    def changes(self, table: str, since: int) -> DataFrame | None:
        """Rows of the batches added after manifest ``since``; None if that manifest has been vacuumed."""
        numbers = self._numbers(table)
        if since and since not in numbers or not since and numbers[:1] not in ([], [1]):
            return None
        added = [self.manifest(table, n)["added"] for n in numbers if n > since]
        return self._batches(table, [b for b in added if b])

    def landing(self, positions: dict[str, int] | None = None) -> Landing:
        """The tables as of manifest numbers (default: the newest ones)."""
        return StoredLanding(self, positions or {})


class StoredLanding(Landing):
    """Landing over base plus tail: only keys in the tail are deduplicated when the newest version is read."""

    def __init__(self, store: LandingStore, positions: dict[str, int]):
        super().__init__(self._all)
        self._store, self._at = store, dict(positions)

    def _parts(self, name: str) -> tuple[DataFrame | None, DataFrame]:
        if name not in self._at:
            self._at[name] = self._store.position(name)  # one state for all reads of this object
        m = self._store.manifest(name, self._at[name])
        return self._store._base(name, m), self._store._with_month(name, self._store._tail(name, m))

    def _all(self, name: str) -> DataFrame:
        base, tail = self._parts(name)
        both = tail if base is None else base.select(*tail.columns).unionByName(tail)
        return both if LANDING[name].month_of else both.drop("month")

    def latest(self, name: str, key_mode: str = "sort_key", since: _dt.date | None = None) -> DataFrame:
        t = LANDING[name]
        if key_mode != "sort_key":  # the base has one version per sort key, not per primary key
            return super().latest(name, key_mode, since)
        base, tail = self._parts(name)
        if base is None:
            return super().latest(name, key_mode, since)
        key = list(t.sort_key)

        def cut(df: DataFrame) -> DataFrame:
            if since is None or t.month_of not in t.sort_key:
                return df
            return df.where((F.col("month") >= since.year * 100 + since.month) & (F.col(t.month_of) >= ts_lit(since)))
        base, tail = cut(base.select(*tail.columns)), cut(tail)
        keys = tail.select(*key).distinct()
        merged = latest_version(base.join(keys, key, "left_semi").unionByName(tail), key)
        out = base.join(keys, key, "left_anti").select(*tail.columns).unionByName(merged.select(*tail.columns))
        return out if t.month_of else out.drop("month")

    def latest_by_range(self, name: str, key_mode: str = "sort_key", since: _dt.date | None = None) -> DataFrame:
        return self.latest(name, key_mode, since)  # the base is in key order and not dealt again

    def live(self, name: str, key_mode: str = "sort_key", since: _dt.date | None = None) -> DataFrame:
        return self.latest(name, key_mode, since).where(F.col(IS_DELETED) == 0)


def refresh_from_store(spark: SparkSession, store: LandingStore, root: str, name: str, as_of: _dt.date,
                       loaded_at: _dt.datetime | None = None) -> tuple[str, int]:
    """Bring a mart up to the store's newest state from the position of its last refresh.

    The position (manifest number of each table that the mart reads, and the day) is kept
    beside the mart and written last: a refresh that failed is done again from the same
    position. Without a usable position, or for an earlier day, the mart is computed in full. Returns
    "changes" or "full", and the rows written.
    """
    from tidemart.plans import delta, refresh
    spec = delta.GROUPS[name]
    tables = sorted({p.table for p in spec.paths} | {p.to.table for p in spec.paths if isinstance(p, delta.Via)})
    at = f"{root.rstrip('/')}/_positions/{name}.json"
    now = {t: store.position(t) for t in tables}
    last = None
    if path_exists(spark, at):
        last = json.loads(read_small(spark, at))
    changed = {}
    if last and last["as_of"] <= as_of.isoformat():
        changed = {t: store.changes(t, last["tables"].get(t, 0)) for t in tables if now[t] != last["tables"].get(t, 0)}
    if last is None or last["as_of"] > as_of.isoformat() or any(df is None for df in changed.values()):
        n, _ = refresh.refresh_mart(spark, store.landing(now), name, as_of, root, loaded_at=loaded_at)
        kind = "full"
    else:
        before = store.landing({t: last["tables"].get(t, 0) for t in tables})
        _, n = delta.refresh_changed(spark, before, changed, name, as_of, root, _dt.date.fromisoformat(last["as_of"]), loaded_at)
        kind = "changes"
    # lost between the two steps of the replacement, the position is missing: the next refresh is a full one
    write_small(spark, at, json.dumps({"as_of": as_of.isoformat(), "tables": now}), replace=True)
    return kind, n


def land_batches(store: LandingStore, tables: dict[str, list[DataFrame]], compact_after: int = 1) -> None:
    """Append batches 0, 1, ... of each table and compact once after ``compact_after`` of them."""
    for table, batches in tables.items():
        for i, rows in enumerate(batches):
            store.append(table, rows, f"{i:06d}")
            if i + 1 == compact_after:
                store.compact(table)
