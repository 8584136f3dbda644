"""Stored tables: schema scans, DDL, and keyed tables kept as append logs on Parquet.

A keyed table is a log of row images. An upsert only appends its batch; reading merges to the
latest image per key; compaction folds the log into a snapshot now and then.

A batch is a folder named by a sequence number of the table, its writer and the writer's own batch
id. The sequence orders images across writers; the writer and batch id only recognise a replay,
so writers with equal or restarted batch ids never replace each other's rows. A snapshot names the
batches it covers; whatever it does not name is read from the log, however late it arrived.
Folders count once they have _SUCCESS. One compaction may run at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.operators.upsert import last_by_key
from tidewire.schemas import ENTITY_TABLES, STATE_TABLES, TABLE_KEYS, conform

ALL_TABLES = {**ENTITY_TABLES, **STATE_TABLES}
_BATCH = "_batch"
_NAME = re.compile(r"(\d{12})~([A-Za-z0-9_.-]+)~(\d{12})")


def scan(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A plain Parquet scan with the table's explicit schema."""
    return spark.read.schema(ALL_TABLES[name]).parquet(path)


def create_tables(spark: SparkSession, database: str) -> list[str]:
    """Create the database and any absent table; returns the table names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, schema in ALL_TABLES.items():
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
        )
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")
    return sorted(ALL_TABLES)


class Batch(NamedTuple):
    """One batch folder; tuples sort by sequence, then writer."""

    seq: int
    writer: str
    batch: int

    @property
    def name(self) -> str:
        return f"{self.seq:012d}~{self.writer}~{self.batch:012d}"

    @classmethod
    def of(cls, name: str) -> Batch | None:
        found = _NAME.fullmatch(name)
        return cls(int(found[1]), found[2], int(found[3])) if found else None


class _View(NamedTuple):
    """What a read sees: a snapshot (None: none), the batches it covers, and those of the log."""

    snapshot: int | None
    covered: frozenset[Batch]
    tail: list[Batch]


@dataclass(frozen=True)
class LogTable:
    """A keyed table under `path`. Without keys it is a plain append log."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]

    @classmethod
    def named(cls, spark: SparkSession, root: str, name: str) -> LogTable:
        return cls(spark, f"{root.rstrip('/')}/{name}", ALL_TABLES[name], tuple(TABLE_KEYS[name]))

    def append(self, rows: DataFrame, batch_id: int, order: Sequence[str] = (), writer: str = "main") -> None:
        """Write one batch, at most one row per key; the last in `order` wins.

        Writing a batch of the same writer again replaces it in its old place, so replays are
        harmless; one whose log folder is already pruned was applied for good and is left. Order
        columns that are not part of the table are dropped.
        """
        held = self._log()
        mine = [b for b in held if (b.writer, b.batch) == (writer, batch_id)]
        folded = frozenset().union(*self._snapshots().values())
        if not mine and any((b.writer, b.batch) == (writer, batch_id) for b in folded):
            return
        if mine:
            self._uncover(mine)
        place = mine[0] if mine else Batch(1 + max((b.seq for b in {*held, *folded}), default=0), writer, batch_id)
        if Batch.of(place.name) is None:
            raise ValueError(f"not a writer name: {writer!r}")
        if self.keys and order:
            rows = last_by_key(rows, self.keys, order)
        rows = conform(rows.drop(*[c for c in order if c not in self.schema.names]), self.schema)
        rows.write.mode("overwrite").parquet(self._folder(place))

    def retract(self, writer: str, since: int) -> None:
        """Remove the batches of a writer from id `since` on: what a failed attempt left behind."""
        mine = [b for b in self._log() if b.writer == writer and b.batch >= since]
        self._uncover(mine)
        for b in mine:
            self._delete(self._folder(b))

    def read(self, before: int | None = None, only: DataFrame | None = None, writer: str = "main") -> DataFrame:
        """Current rows: the latest image per key.

        `before` hides that batch of `writer` and its later ones, so a replayed batch sees the
        table without itself. `only` names the wanted keys by (some of) the key columns; all other
        images drop out before the merge, so a small batch does not shuffle the whole table.
        """
        view = self._view(lambda b: before is not None and b.writer == writer and b.batch >= before)
        return self._merged(view, only).select(*self.schema.names)

    def compact(self) -> int | None:
        """Fold everything written so far into a snapshot; returns the last sequence number held.

        The batches of the snapshot before it are pruned then, and snapshots older than that one.
        """
        view = self._view()
        if view.tail:
            snapshots, held = self._snapshots(finished=False), self._log()
            newest = {b.writer: b for b in sorted(view.covered, key=lambda b: b.batch)}
            # Pruned names are forgotten but for each writer's last one, which may be replayed.
            covered = {*view.tail, *(b for b in view.covered if b in held), *newest.values()}
            number = 1 + max(snapshots, default=0)
            self._write_names(number, covered)
            self._merged(view).write.mode("overwrite").parquet(self._snapshot(number))
            if view.snapshot is not None:
                for b in view.covered & set(held):
                    self._delete(self._folder(b))
                for old in snapshots:
                    if old < view.snapshot:
                        self._delete(self._snapshot(old))
                        self._delete(self._names(old))
        return max((b.seq for b in {*view.tail, *view.covered}), default=None)

    def _merged(self, view: _View, only: DataFrame | None = None) -> DataFrame:
        full = T.StructType([T.StructField(f.name, f.dataType, True) for f in self.schema])
        imaged = T.StructType([*full.fields, T.StructField(_BATCH, T.StringType())])

        def wanted(rows: DataFrame) -> DataFrame:
            if only is None:
                return rows
            keys = [k for k in self.keys if k in only.columns]
            return rows.join(only.select(*keys).distinct(), keys, "left_semi")

        tail = self.spark.createDataFrame([], imaged)
        if view.tail:
            # Names are partition folders of one scan; the list holds them, so no other is read.
            dirs = [self._folder(b) for b in view.tail]
            log = self.spark.read.schema(imaged).option("basePath", f"{self.path}/log").parquet(*dirs)
            tail = wanted(log.select(*imaged.names))
        if view.snapshot is None:
            return last_by_key(tail, self.keys, [_BATCH]) if self.keys else tail
        base = wanted(self.spark.read.schema(imaged).parquet(self._snapshot(view.snapshot)))
        if not view.tail:
            return base
        if not self.keys:
            return base.unionByName(tail)
        if min(view.tail).seq <= max(view.covered).seq:
            # A batch that began before a covered one came in after the snapshot: order all images.
            return last_by_key(base.unionByName(tail), self.keys, [_BATCH])
        # The snapshot has one row per key and is older than the tail: only the tail is ranked.
        changed = last_by_key(tail, self.keys, [_BATCH])
        return base.join(tail.select(*self.keys), list(self.keys), "left_anti").unionByName(changed)

    def _view(self, hidden: Callable[[Batch], bool] = lambda b: False) -> _View:
        """The newest snapshot without a hidden batch, and the finished batches it does not cover."""
        held, snapshots = self._log(), self._snapshots()
        usable = [n for n, covered in snapshots.items() if not any(map(hidden, covered))]
        number = max(usable, default=None)
        covered = snapshots[number] if usable else frozenset()
        if not usable and any(not names <= set(held) for names in snapshots.values()):
            raise ValueError(f"{self.path}: the table can no longer be read without that batch")
        tail = [b for b in held if b not in covered and not hidden(b) and self._exists(f"{self._folder(b)}/_SUCCESS")]
        return _View(number, covered, tail)

    def _uncover(self, batches: Sequence[Batch]) -> None:
        """Drop snapshots that cover batches about to change; the log still holds what they fold."""
        for number, covered in self._snapshots().items():
            if not covered.isdisjoint(batches):
                self._delete(self._snapshot(number))

    def _log(self) -> list[Batch]:
        """All batch folders, finished or not."""
        names = (n.removeprefix(f"{_BATCH}=") for n in self._children(f"{self.path}/log"))
        return sorted(b for b in map(Batch.of, names) if b is not None)

    def _snapshots(self, finished: bool = True) -> dict[int, frozenset[Batch]]:
        """Snapshot numbers and the batches they cover; there are two or three at most."""
        numbers = [int(n[2:]) for n in self._children(f"{self.path}/covers") if re.fullmatch(r"n=\d{12}", n)]
        done = (n for n in numbers if not finished or self._exists(f"{self._snapshot(n)}/_SUCCESS"))
        return {n: self._read_names(n) if finished else frozenset() for n in done}

    def _folder(self, batch: Batch) -> str:
        return f"{self.path}/log/{_BATCH}={batch.name}"

    def _snapshot(self, number: int) -> str:
        return f"{self.path}/snapshot/n={number:012d}"

    def _names(self, number: int) -> str:
        return f"{self.path}/covers/n={number:012d}"

    def _write_names(self, number: int, covered: set[Batch]) -> None:
        file = self._fs().create(self._path(self._names(number)), True)
        file.write("\n".join(b.name for b in sorted(covered)).encode())
        file.close()

    def _read_names(self, number: int) -> frozenset[Batch]:
        file = self._fs().open(self._path(self._names(number)))
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        file.close()
        return frozenset(b for b in map(Batch.of, text.split("\n")) if b is not None)

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        return self._fs().exists(self._path(path))

    def _delete(self, path: str) -> None:
        self._fs().delete(self._path(path), True)

    def _children(self, folder: str) -> list[str]:
        if not self._exists(folder):
            return []
        return [s.getPath().getName() for s in self._fs().listStatus(self._path(folder))]
