"""Tables kept as change files behind a manifest.

A store is a folder with one or more tables and a manifest.  A change is first *staged*: its rows
are written to a folder of their own, where no reader looks.  One manifest entry then makes the
staged folders of any number of tables visible at once.  A job that dies before that leaves nothing
visible, and its retry writes a folder of its own; whoever committed a load or a micro-batch before
finds it in the manifest and does nothing.

Rows lie in folders by partition and, for tables with keys, by a hash of the key (``_bucket``).  A
change holds only its own rows, so the bytes written follow the batch; nothing old is read or copied.
Readers merge: of the rows of one key the greatest in ``order`` counts, or the last written; a row
marked ``_gone`` takes its key away.  Only partitions with more than one change are aggregated, the
others are plain scans.  ``compact`` writes buckets whose changes have grown too many or too large
anew, and ``vacuum`` deletes what no recent entry shows.

The newest entry alone tells the whole state (folders and bytes per partition and bucket), so a read
takes one listing and one small file, however many changes there were.  A row's partition must
follow from its key.  (One writer per store is assumed; a second one that commits the same entry
fails.)
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfig.sources import sink

BUCKET, SEQ, TRY, GONE = "_bucket", "_seq", "_try", "_gone"
#: Folders up to which each is named to the scan (more would be listed by a job of their own).
FEW = 32


class Store:
    """The tables below ``base``; every entry that was committed is visible to the next call."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    # ------------------------------------------------------------------ manifest

    def versions(self) -> list[int]:
        where = f"{self.base}/_manifest"
        if not sink.path_exists(self.spark, where):
            return []
        return sorted(int(n[:-5]) for n in sink.list_dir(self.spark, where) if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int | None = None) -> dict[str, Any]:
        """version, tables, loads, batches and notes as of the newest (or the given) entry."""
        if version is None:
            version = (self.versions() or [0])[-1]
        if not version:
            return {"version": 0, "tables": {}, "folders": {}, "loads": {}, "batches": {}, "notes": {}}
        return json.loads(sink.read_text(self.spark, f"{self.base}/_manifest/{version:010d}.json"))

    def commit(self, staged: list[dict], load: str | None = None, batch: tuple[str, int] | None = None, notes: dict | None = None) -> int:
        """Makes the staged changes visible together; returns the store's version."""
        state = self.state()
        version = state["version"] + 1
        for change in staged:
            if change["version"] != version:
                raise RuntimeError(f"{self.base}: version {change['version'] - 1} that the change was made for is no longer the newest")
            parts = state["tables"].setdefault(change["table"], {})
            for part, buckets in change["parts"].items():
                held = parts.setdefault(part, {})
                for bucket, size in buckets.items():
                    before = [] if change["full"] else held.get(bucket, [])
                    held[bucket] = [*before, [version, change["try"], size]]
            state["folders"][f"{version}/{change['try']}"] = _folders(change)
        if load is not None:
            state["loads"][load] = {"rows": sum(c["rows"] for c in staged), "stats": {k: v for c in staged for k, v in c["stats"].items()},
                                    "folders": [[c["table"], c["version"], c["try"]] for c in staged]}
        if batch is not None:
            state["batches"][batch[0]] = batch[1]
        used = {f"{v}/{t}" for parts in state["tables"].values() for held in parts.values() for c in held.values() for v, t, _ in c}
        state["folders"] = {k: n for k, n in state["folders"].items() if k in used}
        state["notes"].update(notes or {})
        state["version"] = version
        sink.write_new_text(self.spark, f"{self.base}/_manifest/{version:010d}.json", json.dumps(state, ensure_ascii=False))
        return version

    def has_batch(self, query: str, number: int) -> bool:
        """Whether a micro-batch (they are numbered upwards) was committed before."""
        return self.state()["batches"].get(query, -1) >= number

    # ------------------------------------------------------------------ write

    def stage(self, df: DataFrame, table: str, column: str, keys: list[str] | None = None, buckets: int = 8, gone: DataFrame | None = None,
              stats: list[str] | None = None, full: bool = False, replaced: dict[str, list[str]] | None = None, spread: bool = True, hashed: list[str] | None = None) -> dict:
        """Writes a change where no reader sees it, and describes it for :meth:`commit`.

        ``gone`` has keys (and the partition column) whose rows go, unless ``df`` has them.  ``full``: the change is the
        whole content of the buckets it holds and of those in ``replaced``.  ``stats`` are columns
        whose least and greatest value are kept with the load.  ``spread``: rows are dealt by
        partition and bucket before they are written; a change known to be small may do without.
        ``hashed`` are the key columns that the bucket follows from, if not all.
        """
        version, attempt = (self.versions() or [0])[-1] + 1, uuid.uuid4().hex
        path = f"{self.base}/{table}/{SEQ}={version}/{TRY}={attempt}"
        seen = Observation(f"stage_{attempt}")
        stats = stats or []
        rows, by, there = df, [column], F.lit(True)
        if keys is not None:
            rows, there = rows.withColumn(GONE, F.lit(False)), ~F.col(GONE)
            if gone is not None:
                rows = rows.unionByName(gone.withColumn(GONE, F.lit(True)), allowMissingColumns=True)
            rows = rows.withColumn(BUCKET, bucket_of(hashed or keys, buckets))
            by.append(BUCKET)
        rows = rows.observe(seen, F.count_if(there).alias("rows"), *(f(c).cast("string").alias(f"{n}_{k}") for k, c in enumerate(stats) for n, f in (("min", F.min), ("max", F.max))))
        # REBALANCE: AQE writes few files a bucket and splits a hot one
        (rows.hint("rebalance", *by) if spread else rows).write.partitionBy(*by).parquet(path)
        parts: dict[str, dict[str, int]] = {p: {b: 0 for b in bs} for p, bs in (replaced or {}).items()}
        for name, size in sink.sizes(self.spark, path):
            part, *rest = name.split("/")[:-1]
            bucket = rest[0].partition("=")[2] if rest else "0"
            held = parts.setdefault(part, {})
            held[bucket] = held.get(bucket, 0) + size
        # rows that the optimizer knows to be none are not observed
        got = seen.get if any(size for held in parts.values() for size in held.values()) else {}
        return {"table": table, "version": version, "try": attempt, "parts": parts, "full": full, "rows": int(got.get("rows", 0)),
                "stats": {c: [got.get(f"min_{k}"), got.get(f"max_{k}")] for k, c in enumerate(stats)}}

    # ------------------------------------------------------------------ read

    def live(self, table: str, pending: dict | None = None) -> dict[str, dict[str, list]]:
        """Per partition folder and bucket: the changes [version, try, bytes] that make it up."""
        parts = self.state()["tables"].get(table, {})
        if pending is not None:
            for part, buckets in pending["parts"].items():
                held = parts.setdefault(part, {})
                for b, size in buckets.items():
                    held[b] = [*([] if pending["full"] else held.get(b, [])), [pending["version"], pending["try"], size]]
        return parts

    def read(self, table: str, schema: T.StructType, column: str, keys: list[str] | None = None, order: list[str] | None = None,
             values: list | None = None, buckets: list[int] | None = None, pending: dict | None = None, loads: list[str] | None = None) -> DataFrame:
        """The table's rows; of the partitions in ``values``, the buckets in ``buckets``, the loads in
        ``loads`` only, if given.  ``pending`` is a staged change to be read as if committed."""
        parts = self._chosen(table, column, values, buckets, pending)
        if loads is not None:
            known = self.state()["loads"]
            of = {(v, t) for name in loads for at, v, t in known[name]["folders"] if at == table}
            parts = {p: {b: [x for x in c if (x[0], x[1]) in of] for b, c in held.items()} for p, held in parts.items()}
        many = {p for p, held in parts.items() if any(len(c) > 1 for c in held.values())} if keys is not None else set()
        plain, mixed = (self._paths(table, {p: held for p, held in parts.items() if (p in many) == m}, keys is not None, pending) for m in (False, True))
        out = self._scan(table, schema, plain, keys) if plain or not mixed else None
        if out is not None and keys is not None:
            out = out.where(~F.col(GONE))
        if mixed:
            merged = _merge(self._scan(table, schema, mixed, keys), schema, keys, order)
            out = merged if out is None else out.select(*schema.fieldNames()).unionByName(merged)
        return out.select(*(F.col(f"`{n}`") for n in schema.fieldNames()))

    def _chosen(self, table: str, column: str, values: list | None, buckets: list[int] | None, pending: dict | None = None) -> dict[str, dict[str, list]]:
        parts = self.live(table, pending)
        if values is not None:
            wanted = {sink.partition_folder(self.spark, column, v) for v in values}
            parts = {p: b for p, b in parts.items() if p in wanted}
        if buckets is not None:
            parts = {p: {b: c for b, c in held.items() if int(b) in set(buckets)} for p, held in parts.items()}
        return parts

    def rows(self, table: str, schema: T.StructType, column: str, keys: list[str], values: list | None = None, buckets: list[int] | None = None) -> DataFrame:
        """The rows of all live changes, not merged, for a caller that aggregates them by key itself;
        only for tables in which no key ever goes."""
        parts = self._chosen(table, column, values, buckets)
        return self._scan(table, schema, self._paths(table, parts, True), keys).select(*schema.fieldNames())

    def _paths(self, table: str, parts: dict[str, dict[str, list]], keyed: bool, pending: dict | None = None) -> list[str]:
        """The folders of these changes: many that are the whole of a change are given as one."""
        leaves: dict[tuple[int, str], list[str]] = {}
        for p, held in parts.items():
            for b, c in held.items():
                for v, t, size in c:
                    if size:
                        leaves.setdefault((v, t), []).append(f"{SEQ}={v}/{TRY}={t}/{p}" + (f"/{BUCKET}={b}" if keyed else ""))
        if sum(map(len, leaves.values())) <= FEW:
            return sorted(x for found in leaves.values() for x in found)
        whole = self.state()["folders"] | ({f"{pending['version']}/{pending['try']}": _folders(pending)} if pending else {})
        return sorted(x for (v, t), found in leaves.items() for x in ([f"{SEQ}={v}/{TRY}={t}"] if whole.get(f"{v}/{t}") == len(found) else found))

    def staged(self, change: dict, schema: T.StructType, keys: list[str] | None = None) -> DataFrame:
        """The rows of a staged change alone."""
        path = f"{SEQ}={change['version']}/{TRY}={change['try']}"
        rows = self._scan(change["table"], schema, [path] if any(size for b in change["parts"].values() for size in b.values()) else [], keys)
        return (rows.where(~F.col(GONE)) if keys is not None else rows).select(*schema.fieldNames())

    def _scan(self, table: str, schema: T.StructType, paths: list[str], keys: list[str] | None) -> DataFrame:
        more = [T.StructField(SEQ, T.LongType()), T.StructField(TRY, T.StringType())] + [T.StructField(BUCKET, T.IntegerType()), T.StructField(GONE, T.BooleanType())] * (keys is not None)
        whole = T.StructType([*schema.fields, *more])
        if not paths:
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).option("basePath", f"{self.base}/{table}").parquet(*(f"{self.base}/{table}/{p}" for p in paths))

    # ------------------------------------------------------------------ upkeep

    def compact(self, table: str, schema: T.StructType, column: str, keys: list[str], order: list[str] | None = None, buckets: int = 8,
                changes: int = 8, share: float = 0.5, least: int = 1 << 20,
                hashed: list[str] | None = None) -> int:
        """Writes anew the buckets with over ``changes`` changes, or whose changes are over ``least``
        bytes and over ``share`` of their first file; returns how many."""
        parts = self.live(table)
        large = lambda c: (more := sum(x[2] for x in c[1:])) > least and more > share * c[0][2]
        due = {p: [b for b, c in held.items() if len(c) > changes or large(c)] for p, held in parts.items()}
        due = {p: b for p, b in due.items() if b}
        if not due:
            return 0
        paths = self._paths(table, {p: {b: parts[p][b] for b in bs} for p, bs in due.items()}, True)
        rows = _merge(self._scan(table, schema, paths, keys), schema, keys, order)
        self.commit([self.stage(rows, table, column, keys, buckets, full=True, replaced=due, hashed=hashed)])
        return sum(map(len, due.values()))

    def vacuum(self, keep: int = 2) -> int:
        """Deletes folders that none of the ``keep`` newest entries shows, and older entries; returns
        how many folders.  Only while nobody stages a change."""
        versions = self.versions()
        recent = versions[-keep:]
        used = {(table, v, t) for n in recent for table, parts in self.state(n)["tables"].items() for held in parts.values() for c in held.values() for v, t, _ in c}
        for n in versions[:-keep]:
            sink.delete_path(self.spark, f"{self.base}/_manifest/{n:010d}.json")
        gone = 0
        for table in [t for t in sink.list_dir(self.spark, self.base) if not t.startswith("_")] if versions else []:
            for seq in sink.list_dir(self.spark, f"{self.base}/{table}"):
                tries = sink.list_dir(self.spark, f"{self.base}/{table}/{seq}")
                dead = [t for t in tries if (table, int(seq.partition("=")[2]), t.partition("=")[2]) not in used]
                for t in dead:
                    sink.delete_path(self.spark, f"{self.base}/{table}/{seq}/{t}")
                if len(dead) == len(tries):
                    sink.delete_path(self.spark, f"{self.base}/{table}/{seq}")
                gone += len(dead)
        return gone


def _folders(change: dict) -> int:
    """How many folders with data a change has."""
    return sum(size > 0 for held in change["parts"].values() for size in held.values())


def bucket_of(keys: list[str], buckets: int):
    return F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(buckets)).cast("int")


def _merge(rows: DataFrame, schema: T.StructType, keys: list[str], order: list[str] | None) -> DataFrame:
    """One row a key: the greatest in ``order``, then the last written.  ``max`` of a struct keeps one
    row a key on the map side, so no key gathers its changes in a task."""
    rank = F.struct(*(F.col(f"`{o}`") for o in order or []), F.col(SEQ), ~F.col(GONE))
    rest = [n for n in schema.fieldNames() if n not in keys]
    best = rows.groupBy(*(F.col(f"`{k}`") for k in keys)).agg(F.max_by(F.struct(*(F.col(f"`{n}`") for n in [*rest, GONE])), rank).alias("_row"))
    return (best.where(~F.col(f"_row.{GONE}"))
            .select(*(F.col(f"`{n}`") if n in keys else F.col("_row").getField(n).alias(n) for n in schema.fieldNames())))


# ---------------------------------------------------------------------------- loads

def append_load(df: DataFrame, base: str, load: str, column: str, stats: list[str] | None = None, table: str = "rows") -> int:
    """One load appended as a whole, once.  A retry under the same name returns the rows that
    the first attempt committed and adds none; a load that died half-way is not seen by anyone."""
    store = Store(df.sparkSession, base)
    done = store.state()["loads"].get(load)
    if done is None:
        store.commit([store.stage(df, table, column, stats=stats)], load=load)
        done = store.state()["loads"][load]
    return done["rows"]


def read_loads(spark: SparkSession, base: str, schema: T.StructType, column: str, loads: list[str] | None = None, table: str = "rows") -> DataFrame:
    """The history of all loads, or the rows of the named ones: other loads' folders are not listed."""
    return Store(spark, base).read(table, schema, column, loads=loads)


def newest(spark: SparkSession, base: str, column: str) -> datetime | None:
    """The greatest value of a timestamp column over all loads, from the manifest: no data is read."""
    found = [x["stats"][column][1] for x in Store(spark, base).state()["loads"].values() if x["stats"].get(column, [None, None])[1]]
    return max(map(datetime.fromisoformat, found)) if found else None
