"""Where results live: versions of named tables, published together in one step.

A version is written apart from everything readers see and then published by one atomic
act, so a reader finds all of its tables or none, and a run that fails or is killed
at any point leaves the tables before it as they were. A table is read from the newest
published version that has it, so a version need not hold every table. A table may also go on
from the one before: then only its new rows are written, beside a list of earlier parts.

Under a root folder, tables are Parquet folders ``versions/<version>/<table>``, and an empty file
``published/<number>-<version>`` publishes one: creating a file is atomic on every file system,
and its name says all. In a catalog database, tables are called ``<table>__<version>``, a
property of the database lists the published versions, and views under the plain names
follow for other users of the catalog.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from dataclasses import dataclass, replace
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

_PROPERTY = "daybook.published"
#: end of the name of the list of earlier parts of a table
_PARTS = "_parts"
_STAMP = "%Y%m%d%H%M%S"


@dataclass(frozen=True)
class TableStore:
    """Versioned tables. Exactly one of ``root`` and ``database`` is set.

    Writing replaces a table, so running again over the same input leaves the same state. An
    empty frame still leaves a table with its columns and types. The ``keep`` newest
    copies of a table stay for readers that still read an older one. Versions that were
    begun and neither published nor abandoned, as after a killed run, go once they are
    ``orphan_days`` old. One process at a time may publish to a catalog database.
    """

    spark: SparkSession
    root: str | None = None
    database: str | None = None
    keep: int = 2
    orphan_days: int = 7
    #: published versions to read from, the newest first; those of the moment if not set
    pinned: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if (self.root is None) == (self.database is None):
            raise ValueError("name either a root folder or a catalog database")

    @property
    def _place(self) -> _Folder | _Catalog:
        if self.root is not None:
            return _Folder(self.spark, self.root.rstrip("/"))
        return _Catalog(self.spark, self.database)

    def begin(self) -> Version:
        """A new version, invisible until it is published."""
        return Version(self, f"{datetime.now(UTC):{_STAMP}}_{uuid.uuid4().hex[:12]}")

    def snapshot(self) -> TableStore:
        """This store as it is now: later publications do not change what it reads."""
        return replace(self, pinned=self._published())

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Replace table ``name`` with a frame, which may read the table; return the stored table."""
        with self.begin() as version:
            return version.write(df, name)

    def read(self, name: str) -> DataFrame:
        """The stored table, lazily: later filters and column choices reach the scan."""
        return _whole(self._place, name, self._holder(name))

    def exists(self, name: str) -> bool:
        return self._holder(name) is not None

    def together(self, *names: str) -> bool:
        """Whether what is read under these names was published as one version."""
        holders = {self._holder(name) for name in names}
        return len(holders) == 1 and None not in holders

    def drop(self, name: str) -> None:
        """Remove a table, with its older copies, if it is there."""
        place = self._place
        for version in self._published():
            for stored in (name, name + _PARTS):
                if place.has(version, stored):
                    place.drop(version, stored)

    def _published(self) -> tuple[str, ...]:
        return self._place.published() if self.pinned is None else self.pinned

    def _holder(self, name: str) -> str | None:
        place = self._place
        return next((v for v in self._published() if place.has(v, name)), None)

    def _clean_up(self) -> None:
        """Drop copies of tables beyond the newest few, and versions that nobody will publish."""
        place, seen = self._place, Counter()
        stored, published = place.stored(), place.published()
        parts: set[tuple[str, str]] = set()  # what newer copies go on from
        for version in published:
            names = stored.pop(version, ())
            tables = [n for n in names if not n.endswith(_PARTS)]
            seen.update(tables)
            kept = {n for n in tables if seen[n] <= self.keep}
            parts |= {(v, n) for n in kept for v in _parts(place, n, version)}
            # A list of parts goes with its table; a part that newer copies go on from needs none.
            kept = {*kept, *(n + _PARTS for n in kept), *(n for n in tables if (version, n) in parts)}
            surplus = [n for n in names if n not in kept]
            for name in surplus:
                place.drop(version, name)
            if len(surplus) == len(names):
                place.forget(version)
        oldest = f"{datetime.now(UTC) - timedelta(days=self.orphan_days):{_STAMP}}"
        for version, names in stored.items():
            if version < oldest:
                for name in names:
                    place.drop(version, name)
                place.forget(version)


class Version:
    """Tables of one run. Used as a context, it is published at the end or, on any error, removed."""

    def __init__(self, store: TableStore, name: str):
        self.store, self.name = store, name
        self.tables: list[str] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of this version and return the stored table."""
        self.tables.append(name)
        return self.store._place.write(df, self.name, name)

    def append(self, df: DataFrame, name: str) -> DataFrame:
        """Write rows that come after those that readers of the store see; return the new rows, stored.

        The rows there are stay where they are. Columns that one side lacks are null.
        """
        place, before = self.store._place, self.store._holder(name)
        earlier = [] if before is None else [*_parts(place, name, before), before]
        if earlier:
            listed = self.store.spark.createDataFrame([(v,) for v in earlier], "version string")
            self.write(listed.coalesce(1), name + _PARTS)
        return self.write(df, name)

    def read(self, name: str) -> DataFrame:
        """A table of this version, published or not."""
        return _whole(self.store._place, name, self.name)

    def drop(self, name: str) -> None:
        """Remove a table of this version."""
        for stored in (name, name + _PARTS):
            if stored in self.tables:
                self.store._place.drop(self.name, stored)
                self.tables.remove(stored)

    def publish(self) -> None:
        """Let readers see all tables of this version, in one step."""
        self.store._place.publish(self.name, self.tables)
        self.store._clean_up()

    def abandon(self) -> None:
        """Remove whatever was written."""
        for name in self.tables:
            self.store._place.drop(self.name, name)
        self.store._place.forget(self.name)

    def __enter__(self) -> Version:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.publish()
        else:
            self.abandon()


def _parts(place: _Folder | _Catalog, name: str, version: str) -> list[str]:
    """Earlier versions whose rows belong to a version's table."""
    if not place.has(version, name + _PARTS):
        return []
    return sorted(r["version"] for r in place.read(name + _PARTS, version).collect())


def _whole(place: _Folder | _Catalog, name: str, version: str | None) -> DataFrame:
    """A version's table with the parts that it goes on from."""
    table = place.read(name, version)
    if version is None:
        return table
    parts = [place.read(name, v) for v in _parts(place, name, version)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*parts, table])


class _Folder:
    """Versions below a root folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.files.listStatus(at)] if self.files.exists(at) else []

    def _table(self, version: str, name: str) -> str:
        return f"{self.root}/versions/{version}/{name}"

    def published(self) -> tuple[str, ...]:
        marks = sorted(self._names(f"{self.root}/published"), reverse=True)
        return tuple(m.split("-", 1)[1] for m in marks)

    def publish(self, version: str, names: list[str]) -> None:
        # Two runs may take one number; the version then decides which is newer.
        last = max(self._names(f"{self.root}/published"), default="0-")
        mark = f"{self.root}/published/{int(last.split('-')[0]) + 1:012d}-{version}"
        self.files.create(self.path(mark), False).close()

    def stored(self) -> dict[str, list[str]]:
        return {v: self._names(f"{self.root}/versions/{v}") for v in self._names(f"{self.root}/versions")}

    def has(self, version: str, name: str) -> bool:
        return self.files.exists(self.path(self._table(version, name)))

    def write(self, df: DataFrame, version: str, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self._table(version, name))
        return self.spark.read.schema(df.schema).parquet(self._table(version, name))

    def read(self, name: str, version: str | None) -> DataFrame:
        # Without a version there is no such table, which Spark says best.
        return self.spark.read.parquet(self._table(version, name) if version else f"{self.root}/{name}")

    def drop(self, version: str, name: str) -> None:
        self.files.delete(self.path(self._table(version, name)), True)

    def forget(self, version: str) -> None:
        for mark in self._names(f"{self.root}/published"):
            if mark.endswith(f"-{version}"):
                self.files.delete(self.path(f"{self.root}/published/{mark}"), False)
        self.files.delete(self.path(f"{self.root}/versions/{version}"), True)


class _Catalog:
    """Versions in a catalog database."""

    def __init__(self, spark: SparkSession, database: str):
        self.spark, self.database = spark, database

    def _table(self, version: str, name: str) -> str:
        return f"`{self.database}`.`{name}__{version}`"

    def published(self) -> tuple[str, ...]:
        told = self.spark.sql(f"DESCRIBE DATABASE EXTENDED `{self.database}`").collect()
        properties = " ".join(r[1] for r in told if r[0] == "Properties")
        found = re.search(rf"\({re.escape(_PROPERTY)},([^()]*)\)", properties)
        return tuple(found[1].split()) if found else ()

    def _list(self, versions: tuple[str, ...]) -> None:
        self.spark.sql(
            f"ALTER DATABASE `{self.database}` SET DBPROPERTIES ('{_PROPERTY}'='{' '.join(versions)}')"
        )

    def publish(self, version: str, names: list[str]) -> None:
        self._list((version, *self.published()))
        for name in (n for n in names if not n.endswith(_PARTS)):
            tables = [self._table(v, name) for v in (version, *_parts(self, name, version))]
            columns = {t: self.spark.table(t).columns for t in tables}
            every = dict.fromkeys(c for t in tables for c in columns[t])
            selects = [
                "SELECT " + ", ".join(f"`{c}`" if c in columns[t] else f"NULL AS `{c}`" for c in every) + f" FROM {t}"
                for t in tables
            ]
            self.spark.sql(
                f"CREATE OR REPLACE VIEW `{self.database}`.`{name}` AS {' UNION ALL '.join(selects)}"
            )

    def stored(self) -> dict[str, list[str]]:
        found: dict[str, list[str]] = {}
        for row in self.spark.sql(f"SHOW TABLES IN `{self.database}`").collect():
            if match := re.fullmatch(r"(\w+)__(\d{14}_[0-9a-f]{12})", row["tableName"]):
                found.setdefault(match[2], []).append(match[1])
        return found

    def has(self, version: str, name: str) -> bool:
        return self.spark.catalog.tableExists(self._table(version, name))

    def write(self, df: DataFrame, version: str, name: str) -> DataFrame:
        df.write.mode("overwrite").format("parquet").saveAsTable(self._table(version, name))
        return self.read(name, version)

    def read(self, name: str, version: str | None) -> DataFrame:
        return self.spark.table(self._table(version, name) if version else f"`{self.database}`.`{name}`")

    def drop(self, version: str, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version, name)}")
        if not any(self.has(v, name) for v in self.published()):
            self.spark.sql(f"DROP VIEW IF EXISTS `{self.database}`.`{name}`")

    def forget(self, version: str) -> None:
        if version in (published := self.published()):
            self._list(tuple(v for v in published if v != version))
