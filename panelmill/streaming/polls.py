"""Polls that change several tables together, period by period, behind a gate.

A folder holds tables cut by a period column, such as the month. One small file, the
pointer, names for each table and period the folder of its rows. A poll reads only the
periods it touches, writes them to new folders, and has them checked; then a new pointer
names them together with the untouched folders of before. So all tables change at once or
not at all, a reader sees one state, and a refused poll leaves nothing behind but its
entry. Pointers are named by batch: a batch that comes again, after a restart or a
replay, finds its own and does nothing.

Defined results: a batch without rows is published with no change; rows without a period
form a period of their own; a period that a poll leaves without rows has none; readers
keep the folders of the pointer they read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pick import stored
from .jobs import run_to_end

PART = "_part"
NO_PERIOD = "none"


@dataclass(frozen=True)
class Table:
    """Schema of a table, and the column that cuts it into periods."""

    schema: str
    period: str


class Refused(Exception):
    """A poll that must not be published, with the reason."""


class Published:
    """The tables of a folder as the newest pointer names them."""

    def __init__(self, spark: SparkSession, folder: str, tables: Mapping[str, Table]):
        self.spark, self.folder, self.tables = spark, folder.rstrip("/"), dict(tables)
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    # Small files go through the session's own file system, so any store that Spark reads will do.

    def _names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return sorted(f.getPath().getName() for f in self._files.listStatus(where)) if self._files.exists(where) else []

    def _pointer(self, batch_id: int) -> str:
        return f"{self.folder}/pointers/{batch_id:012d}.json"

    def _load(self, name: str) -> dict:
        found = self._files.open(self._path(f"{self.folder}/pointers/{name}"))
        try:
            return json.loads(bytes(found.readAllBytes()).decode())
        finally:
            found.close()

    def _save(self, batch_id: int, state: dict) -> None:
        draft = self._path(f"{self.folder}/drafts/{uuid.uuid4()}.json")
        out = self._files.create(draft)
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        out.close()
        final = self._path(self._pointer(batch_id))
        self._files.mkdirs(final.getParent())
        if not self._files.rename(draft, final):
            raise FileExistsError(f"batch {batch_id} is published already")

    def state(self) -> dict:
        """What the newest pointer says: batch, decision, and folders by table and period."""
        names = self._names(f"{self.folder}/pointers")
        return self._load(names[-1]) if names else {"batch": -1, "tables": {name: {} for name in self.tables}}

    def log(self) -> DataFrame:
        """batch, decision, reason and touched periods of every poll so far."""
        entries = [self._load(n) for n in self._names(f"{self.folder}/pointers")]
        rows = [(e["batch"], e["decision"], e["reason"], e["touched"]) for e in entries]
        return self.spark.createDataFrame(rows, "batch long, decision string, reason string, touched array<string>")

    def has(self, batch_id: int) -> bool:
        return self._files.exists(self._path(self._pointer(batch_id)))

    def read(self, name: str, periods: Iterable[str] | None = None) -> DataFrame:
        """A table, or only some of its periods; no other folders are listed or read."""
        folders = self.state()["tables"].get(name, {})
        chosen = sorted(folders) if periods is None else [p for p in periods if p in folders]
        schema = self.tables[name].schema
        paths = [f"{self.folder}/{folders[p]}" for p in chosen]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def publish(
        self,
        batch_id: int,
        touched: Iterable[str],
        changes: Mapping[str, DataFrame],
        check: Callable[[Mapping[str, DataFrame]], None] | None = None,
    ) -> str:
        """Publish the new rows of the touched periods of all given tables: published, refused or repeated.

        ``check`` sees the written rows of each table and raises ``Refused`` to have them dropped.
        """
        if self.has(batch_id):
            return "repeated"
        before, touched = self.state()["tables"], sorted(touched)
        staged = f"data/batch={batch_id}-{uuid.uuid4()}"
        tables = {name: dict(before.get(name, {})) for name in self.tables}
        written = {}
        for name, rows in changes.items():
            rows = rows.select(*self.spark.createDataFrame([], self.tables[name].schema).columns)
            # Rows of a period stay together, but a large period is written by many tasks.
            cut = rows.withColumn(PART, period_text(F.col(self.tables[name].period))).hint("rebalance", PART)
            cut.write.partitionBy(PART).parquet(f"{self.folder}/{staged}/{name}")
            made = [n for n in self._names(f"{self.folder}/{staged}/{name}") if n.startswith(f"{PART}=")]
            here = {n.removeprefix(f"{PART}="): f"{staged}/{name}/{n}" for n in made}
            if strays := sorted(here.keys() - set(touched)):
                raise ValueError(f"{name} has rows of periods that were not touched: {strays}")
            tables[name] = {p: f for p, f in tables[name].items() if p not in touched} | here
            paths = [f"{self.folder}/{f}" for f in here.values()]
            written[name] = self.spark.read.schema(self.tables[name].schema).parquet(*paths) if paths else rows.limit(0)
        decision, reason = "published", None
        try:
            if check is not None:
                check(written)
        except Refused as refusal:
            decision, reason, tables = "refused", str(refusal), before
            self._files.delete(self._path(f"{self.folder}/{staged}"), True)
        self._save(batch_id, {"batch": batch_id, "decision": decision, "reason": reason, "touched": touched, "tables": tables})
        return decision


def period_text(period: Column) -> Column:
    return F.coalesce(period.cast("string"), F.lit(NO_PERIOD))


def apply_polls(
    stream: DataFrame,
    target: Published,
    period: Column,
    apply: Callable[[DataFrame, Callable[[str], DataFrame]], Mapping[str, DataFrame]],
    checkpoint: str,
    gate: Callable[[DataFrame], None] | None = None,
    check: Callable[[Mapping[str, DataFrame]], None] | None = None,
) -> None:
    """Feed the tables from a stream of polls, to the end of its input.

    ``gate`` sees a batch before anything is done with it, ``check`` the rows it
    would publish; either raises ``Refused`` to hold the batch back. ``apply`` gets
    the batch and a reader of the touched periods of each table, and returns all
    their new rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if target.has(batch_id):
            return
        batch = stored(batch)
        try:
            if gate is not None:
                gate(batch)
        except Refused as refusal:
            state = target.state()["tables"]
            target._save(batch_id, {"batch": batch_id, "decision": "refused", "reason": str(refusal), "touched": [], "tables": state})
            return
        # As many rows as the poll touches periods.
        touched = [r[0] for r in batch.select(period_text(period)).distinct().collect()]
        target.publish(batch_id, touched, apply(batch, lambda name: target.read(name, touched)), check)

    run_to_end(stream, write, checkpoint)
