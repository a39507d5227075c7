"""A folder of tables with snapshots and transactions.

Every write is a new folder ``<table>/<snapshot>``; the small file ``_current``
says which snapshot of each table is live. A commit replaces that one file by a
single move, so readers see all tables of a transaction before it or after it,
never between, and no data are moved. Snapshots that a commit replaces stay
until the next commit, for readers that still use them. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators.merge import deduplicated, insert_ignore, upsert
from ..operators.relational import union_all
from ..sources.lines import get_text, put_text


class Store:
    """Tables of a catalogue. With ``dry_run`` nothing is written, but later reads see what would have been."""

    def __init__(self, spark: SparkSession, root: str, dry_run: bool = False):
        self.spark, self.root, self.dry_run = spark, root.rstrip("/"), dry_run
        self._pending: dict[str, str] = {}
        self._dry: dict[str, DataFrame] = {}
        self._depth = 0

    def _state(self) -> dict:
        text = get_text(self.spark, f"{self.root}/_current")
        return json.loads(text) if text else {"tables": {}, "before": []}

    def names(self) -> list[str]:
        return sorted({*self._state()["tables"], *self._pending, *self._dry})

    def read(self, name: str) -> DataFrame | None:
        """The live table, inside a transaction the one it has written; None if there is none."""
        if name in self._dry:
            return self._dry[name]
        folder = self._pending.get(name) or self._state()["tables"].get(name)
        return self.spark.read.parquet(f"{self.root}/{folder}") if folder else None

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Replaces a table once df is written whole."""
        if self.dry_run:
            self._dry[name] = df
            return df
        folder = f"{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{folder}")
        dropped = self._pending.get(name)
        self._pending[name] = folder
        if dropped:
            self._delete([dropped])
        if not self._depth:
            self._commit()
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}")

    def merge(self, name: str, new: DataFrame, keys: Sequence[str], replace: bool, ordinal: str | None = None) -> DataFrame:
        """Inserts rows of new keys and, with ``replace``, puts new rows in place of old ones. Of equal keys in new the first counts."""
        old = self.read(name)
        return self.put(name, deduplicated(new, keys, ordinal) if old is None else (upsert if replace else insert_ignore)(old, new, keys, ordinal))

    def append(self, name: str, new: DataFrame) -> DataFrame:
        """Adds rows as they are, repeated ones too."""
        old = self.read(name)
        return self.put(name, new if old is None else union_all(old, new))

    @contextmanager
    def transaction(self) -> Iterator["Store"]:
        """All tables written inside become visible at once, or none if it fails."""
        self._depth += 1
        try:
            yield self
        except BaseException:
            self._depth -= 1
            if not self._depth:
                self._delete(list(self._pending.values()))
                self._pending.clear()
                self._dry.clear()
            raise
        self._depth -= 1
        if not self._depth and self._pending:
            self._commit()

    def _commit(self) -> None:
        state = self._state()
        replaced = [state["tables"][n] for n in self._pending if n in state["tables"]]
        tables = {**state["tables"], **self._pending}
        put_text(self.spark, f"{self.root}/_current", json.dumps({"tables": tables, "before": replaced}))
        self._pending.clear()
        self._delete(state["before"])

    def _delete(self, folders: list[str]) -> None:
        for folder in folders:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{folder}")
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
