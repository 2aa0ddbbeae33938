"""Atomic publish of a partitioned Parquet table (B1-B3), its compaction and its run state.

Layout of a table folder::

    _manifest/v00000007.json             what is live: partition folders, rows, files
    _staging/<run>/order_status=x/...    a run that is being written; readers never look here
    _state/<run>/                        partial aggregates of a run (see plans/run_state.py)
    order_status=x/run-<run>/part-*.parquet

A publish takes four steps, each of which may be its last:

1. **stage**: the rows are written once, in their final layout, below ``_staging``;
2. **verify**: rows are counted per partition folder from the files' footers and must add up to
   the rows observed on the way in;
3. **move**: every partition folder is renamed to its place, a folder of its own for this run, so
   nothing that is live is touched;
4. **seal**: one new manifest names the folders that are live from now on. Manifests are numbered and created
   only if the number is free: of two publishers one wins, the other raises :class:`PublishConflict`.

Readers take the newest whole manifest, so until the seal they see the old rows and after it the new ones,
and a reader that began earlier keeps its files: folders leave with :func:`vacuum`, which
keeps the last ``keep`` manifests' folders. No row is written twice: renames move names. On object
stores without atomic renames a move copies files; the seal is still one object.

``mode``: ``static`` replaces the table, ``dynamic`` the partitions the rows hold, ``append`` adds to them.

:func:`compact` sizes files without moving the table: only files below ``small`` times the target are read,
packed into bins of about the target per partition, and written again; the others stay where they are and
the manifest lists them by name.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordwise import model
from ordwise.sources.parquet import _place
from ordwise.sources.storage import Storage

MODES = ("static", "dynamic", "append")
MANIFESTS, STAGING, STATE = "_manifest", "_staging", "_state"
BROADCAST_FILES = 200_000
TARGET_BYTES = 256 << 20
# Folders a task writes side by side. Only a task with rows for more folders sorts what is left of its rows.
OPEN_FILES = 16
SMALL = 0.75


class PublishConflict(RuntimeError):
    """Another publish sealed first; the table is as that one left it."""


class CountMismatch(RuntimeError):
    """Staged files do not hold the rows that were written; the table is untouched."""


@dataclass(frozen=True)
class Entry:
    """A live folder of one run and partition; ``files`` None means all of them."""

    partition: str
    run: str
    rows: int
    files: tuple[str, ...] | None = None

    @property
    def folder(self) -> str:
        return f"{self.partition}/run-{self.run}"

    def paths(self) -> list[str]:
        return [self.folder] if self.files is None else [f"{self.folder}/{f}" for f in self.files]


@dataclass(frozen=True)
class Manifest:
    number: int
    partition_by: str
    schema: str
    entries: tuple[Entry, ...]

    @property
    def rows(self) -> int:
        return sum(e.rows for e in self.entries)

    def text(self) -> str:
        return json.dumps({"number": self.number, "partition_by": self.partition_by, "schema": json.loads(self.schema),
                           "entries": [[e.partition, e.run, e.rows, e.files] for e in self.entries]})

    @classmethod
    def parse(cls, text: str) -> Manifest:
        d = json.loads(text)
        return cls(d["number"], d["partition_by"], json.dumps(d["schema"]),
                   tuple(Entry(p, r, n, None if f is None else tuple(f)) for p, r, n, f in d["entries"]))


@dataclass
class Staged:
    """A written run: rows per partition folder and what was observed on the way."""

    run: str
    schema: str
    partition_by: str
    rows: dict[str, int]
    observed: dict[str, int] = field(default_factory=dict)


def _decoded(pattern: str, group: int) -> Column:
    """A part of a row's file path, which is percent-encoded once more than names in a folder."""
    return F.url_decode(F.replace(F.regexp_extract("_metadata.file_path", pattern, group), F.lit("+"), F.lit("%2B")))


def _types(schema: str) -> list[tuple[str, str]]:
    """Names and types of a schema's columns; whether they may be null does not matter in files."""
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromJson(json.loads(schema)).fields]


def row_folder() -> Column:
    """The folder (partition and run, as in :attr:`Entry.folder`) that a row of a table is read from."""
    return _decoded("/([^/]*/run-[0-9a-f]+)/", 1)


def _nothing(step: str) -> None:
    pass


@contextmanager
def _unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes keep a file open per folder instead of sorting each task's rows by folder: the sort holds
    all rows of a task in memory, many times the bytes of the file they become."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    if int(before) < OPEN_FILES:
        spark.conf.set(name, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class PublishedTable:
    """``on_step`` is called before each step of a publish with its name (tests stop it there)."""

    def __init__(self, spark: SparkSession, path: str, partition_by: str = model.PARTITION_COLUMN,
                 on_step: Callable[[str], None] = _nothing):
        self.spark, self.path, self.partition_by, self.on_step = spark, path.rstrip("/"), partition_by, on_step
        self.storage = Storage(spark, self.path)

    # -- reading -------------------------------------------------------------------

    def _numbers(self) -> list[int]:
        return [int(n[1:-5]) for n in self.storage.children(MANIFESTS) if n.startswith("v") and n.endswith(".json")]

    def manifests(self, last: int | None = None) -> list[Manifest]:
        """Whole manifests, newest first. One cut short by a lost driver is no JSON and is passed over."""
        out = []
        for n in sorted(self._numbers(), reverse=True):
            try:
                out.append(Manifest.parse(self.storage.read_text(f"{MANIFESTS}/v{n:08d}.json")))
            except ValueError:
                continue
            if last and len(out) == last:
                break
        return out

    def manifest(self) -> Manifest | None:
        return next(iter(self.manifests(1)), None)

    def read(self, manifest: Manifest | None = None, runs: set[str] | None = None) -> DataFrame:
        """The live rows (of some runs only, if given); the partition column comes last."""
        m = manifest or self.manifest()
        if m is None:
            raise FileNotFoundError(f"nothing is published in {self.path}")
        paths = [f"{self.path}/{p}" for e in m.entries if runs is None or e.run in runs for p in e.paths()]
        return self._frame(T.StructType.fromJson(json.loads(m.schema)), paths, self.path)

    def _frame(self, schema: T.StructType, paths: list[str], base: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths)

    # -- publishing ----------------------------------------------------------------

    def stage(self, df: DataFrame, placement: str | int = "rebalance", observe: dict[str, Column] | None = None,
              compression: str = "snappy") -> Staged:
        """Write ``df`` below the staging folder and count what arrived. Observed right below the writer,
        where each task's result counts once however often a task is tried."""
        run, seen = uuid.uuid4().hex[:16], Observation()
        last = [f for f in df.schema.fields if f.name == self.partition_by]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in
                               [f for f in df.schema.fields if f.name != self.partition_by] + last])
        self.on_step("stage")
        placed = _place(df, self.partition_by, placement)
        metrics = {"rows": F.count(F.lit(1)), **(observe or {})}
        try:
            with _unsorted_writes(self.spark):
                (placed.observe(seen, *[c.alias(k) for k, c in metrics.items()]).write.mode("error")
                 .option("compression", compression).partitionBy(self.partition_by).parquet(self._staging(run)))
            got = seen.get
            self.on_step("verify")
            staged = Staged(run, schema.json(), self.partition_by, self._counted(run, schema), got)
            if sum(staged.rows.values()) != got["rows"]:
                raise CountMismatch(f"{got['rows']} rows were written, the files hold {sum(staged.rows.values())}")
        except Exception:
            self.discard(run)
            raise
        return staged

    def _staging(self, run: str) -> str:
        return f"{self.path}/{STAGING}/{run}"

    def _folders(self, run: str) -> list[str]:
        return [n for n in self.storage.children(f"{STAGING}/{run}") if n.startswith(f"{self.partition_by}=")]

    def _counted(self, run: str, schema: T.StructType) -> dict[str, int]:
        """Rows per staged partition folder, from the files' footers."""
        folders = self._folders(run)
        out = dict.fromkeys(folders, 0)
        if folders:
            frame = self._frame(schema, [f"{self._staging(run)}/{n}" for n in folders], self._staging(run))
            for r in frame.groupBy(_decoded(f"/{run}/([^/]*)/", 1).alias("name")).agg(F.count(F.lit(1)).alias("n")).collect():
                out[r["name"]] = r["n"]
        return out

    def discard(self, run: str) -> None:
        """Drop a staged run, and the folders it leaves empty."""
        self.storage.remove(f"{STAGING}/{run}")
        for name in (STAGING, ""):
            self.storage.remove_if_empty(name)

    def staged_rows(self, staged: Staged) -> DataFrame:
        """The rows of a staged run, before it is published."""
        return self._frame(T.StructType.fromJson(json.loads(staged.schema)),
                           [f"{self._staging(staged.run)}/{n}" for n in staged.rows], self._staging(staged.run))

    def publish(self, staged: Staged, mode: str = "static") -> Manifest:
        """Move a staged run into place and seal it."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        before = self.manifest()
        if before and mode != "static" and _types(before.schema) != _types(staged.schema):
            raise ValueError("the rows' schema differs from the table's")
        number = max(self._numbers(), default=0) + 1
        for name in staged.rows:
            self.on_step(f"move {name}")
            self.storage.move(f"{STAGING}/{staged.run}/{name}", f"{name}/run-{staged.run}")
        made = [Entry(name, staged.run, n) for name, n in staged.rows.items()]
        kept = [] if before is None or mode == "static" else [
            e for e in before.entries if mode == "append" or e.partition not in staged.rows]
        out = self._seal(Manifest(number, self.partition_by, staged.schema, tuple(kept + made)))
        self.on_step("clean")
        self.discard(staged.run)
        return out

    def _seal(self, m: Manifest) -> Manifest:
        self.on_step("seal")
        try:
            self.storage.write_new(f"{MANIFESTS}/v{m.number:08d}.json", m.text())
        except FileExistsError:
            raise PublishConflict(f"manifest {m.number} of {self.path} was sealed by another publish") from None
        return m

    def write(self, df: DataFrame, mode: str = "static", placement: str | int = "rebalance") -> Manifest:
        return self.publish(self.stage(df, placement), mode)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove run folders that the last ``keep`` manifests do not name, and staged runs. Not to be run while
        another publish is under way."""
        live = {e.folder for m in self.manifests(keep) for e in m.entries}
        gone = []
        for part in self.storage.children():
            if part.startswith(f"{self.partition_by}="):
                gone += [f"{part}/{r}" for r in self.storage.children(part) if f"{part}/{r}" not in live]
        gone += [f"{STAGING}/{r}" for r in self.storage.children(STAGING)]
        for name in gone:
            self.storage.remove(name)
        return gone

    # -- compaction ----------------------------------------------------------------

    def plan_compaction(self, target: int = TARGET_BYTES, small: float = SMALL) -> dict[str, list[list[str]]]:
        """Per partition, bins of small files (paths below the table) whose bytes add up to about ``target``: first
        fit over files by descending size. Bins of one file are left alone."""
        m, out = self.manifest(), {}
        sizes: dict[str, dict[str, int]] = {}
        for e in m.entries if m else ():
            found = self.storage.files(e.folder)
            for f in (e.files if e.files is not None else found):
                if found[f] < small * target:
                    sizes.setdefault(e.partition, {})[f"{e.folder}/{f}"] = found[f]
        for part, files in sizes.items():
            bins = pack(files, target)
            if bins := [b for b in bins if len(b) > 1]:
                out[part] = bins
        return out

    def compact(self, target: int = TARGET_BYTES, small: float = SMALL) -> Manifest | None:
        """Rewrite the planned bins, one file each, in one job; None if there is nothing to do."""
        m, plan = self.manifest(), self.plan_compaction(target, small)
        if not plan:
            return None
        bin_of = {f: k for k, b in enumerate(b for bins in plan.values() for b in bins) for f in b}
        schema = T.StructType.fromJson(json.loads(m.schema))
        old = self._frame(schema, [f"{self.path}/{f}" for f in bin_of], self.path)
        # One row a small file; each bin goes to one task, which writes one file for it.
        lookup = self.spark.createDataFrame(list(bin_of.items()), "_file string, _bin int")
        lookup = F.broadcast(lookup) if len(bin_of) <= BROADCAST_FILES else lookup
        run, seen = uuid.uuid4().hex[:16], Observation()
        self.on_step("stage")
        with _unsorted_writes(self.spark):
            (old.withColumn("_file", _decoded("/([^/]*/run-[0-9a-f]+/[^/]*)$", 1)).join(lookup, "_file").drop("_file")
             .repartition("_bin").observe(seen, F.count(F.lit(1)).alias("rows"))
             .write.mode("error").partitionBy(self.partition_by, "_bin").parquet(self._staging(run)))
        self.on_step("verify")
        for name in self._folders(run):  # the files lose their bin's folder, whose name would read as a column
            for f in self.storage.files(f"{STAGING}/{run}/{name}"):
                self.storage.move(f"{STAGING}/{run}/{name}/{f}", f"{STAGING}/{run}/{name}/{f.removeprefix('_bin=').replace('/', '-')}")
            for sub in self.storage.children(f"{STAGING}/{run}/{name}"):
                if sub.startswith("_bin="):
                    self.storage.remove(f"{STAGING}/{run}/{name}/{sub}")
        rows = self._counted(run, schema)
        packed = {(e.partition, e.run): {f.rsplit("/", 1)[-1] for f in bin_of if f.startswith(f"{e.folder}/")} for e in m.entries}
        before = {e.folder: n for e, n in zip(m.entries, self._rows_of(schema, m, bin_of))}
        if sum(rows.values()) != seen.get["rows"] or sum(rows.values()) != sum(before.values()):
            self.discard(run)
            raise CountMismatch("compacted files do not hold the rows of the small ones")
        kept = []
        for e in m.entries:
            gone = packed[e.partition, e.run]
            if not gone:
                kept.append(e)
            elif rest := [f for f in (e.files if e.files is not None else sorted(self.storage.files(e.folder))) if f not in gone]:
                kept.append(Entry(e.partition, e.run, e.rows - before[e.folder], tuple(rest)))
        for name in rows:
            self.on_step(f"move {name}")
            self.storage.move(f"{STAGING}/{run}/{name}", f"{name}/run-{run}")
        made = [Entry(name, run, n, tuple(sorted(self.storage.files(f"{name}/run-{run}")))) for name, n in rows.items()]
        out = self._seal(Manifest(max(self._numbers()) + 1, self.partition_by, m.schema, tuple(kept + made)))
        self.on_step("clean")
        self.discard(run)
        return out

    def _rows_of(self, schema: T.StructType, m: Manifest, files: dict[str, int]) -> list[int]:
        """Rows of the listed files per entry, from their footers."""
        frame = self._frame(schema, [f"{self.path}/{f}" for f in files], self.path)
        part, run = (_decoded("/([^/]*)/run-([0-9a-f]+)/", k) for k in (1, 2))
        got = {(r["p"], r["r"]): r["n"] for r in frame.groupBy(part.alias("p"), run.alias("r")).agg(F.count(F.lit(1)).alias("n")).collect()}
        return [got.get((e.partition, e.run), 0) for e in m.entries]


def pack(files: dict[str, int], target: int) -> list[list[str]]:
    """Files by descending size, each into the fullest bin it still fits."""
    import bisect

    bins: list[list[str]] = []
    room: list[tuple[int, int]] = []  # (bytes left, bin), ascending
    for f, size in sorted(files.items(), key=lambda kv: (-kv[1], kv[0])):
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            left, k = room.pop(at)
        else:
            left, k = target, len(bins)
            bins.append([])
        bins[k].append(f)
        bisect.insort(room, (left - size, k))
    return bins
