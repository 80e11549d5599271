"""Staging and publication of a rebuild's tables.

A run writes every table into a folder of its own and publishes them together,
after its checks: until then readers see the previous tables, whole.

* ``Versions``: a run's tables stay in ``root/_versions/<version>/<table>``; an
  empty marker file publishes the version.  Creating a file is atomic on file
  systems and object stores alike, and nothing is moved, so a run that is
  killed at any point leaves the previous version in force.
* ``Swap``: tables lie in ``root/<table>``; publication renames the staged
  folders into place, one table after the other.  For stores with cheap
  renames and readers that know plain paths only.  A run killed within the
  renames leaves some tables new and at most one missing, the old one beside
  it under ``root/_staging``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

MARKER = "_PUBLISHED"


class _Folder:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    @property
    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, path: str) -> list[str]:
        fs, p = self._fs, self._path(path)
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


class Versions(_Folder):
    """Numbered versions of all tables below ``root``."""

    def _folder(self, version: str) -> str:
        return f"{self.root}/_versions/{version}"

    def all(self) -> list[str]:
        """Every version begun, oldest first, published or not."""
        return self._children(f"{self.root}/_versions")

    def published(self) -> list[str]:
        """The published versions, oldest first."""
        return [v for v in self.all()
                if self._fs.exists(self._path(f"{self._folder(v)}/{MARKER}"))]

    def begin(self) -> None:
        """Start a version after every other one (two runs at once get two)."""
        last = max((int(v.split("-")[0]) for v in self.all()), default=0)
        self.version = f"{last + 1:08d}-{uuid.uuid4().hex[:8]}"
        self._fs.mkdirs(self._path(self._folder(self.version)))

    def staged(self, table: str) -> str:
        return f"{self._folder(self.version)}/{table}"

    def publish(self, tables: Iterable[str]) -> None:
        """Put the begun version in force."""
        self._fs.create(self._path(f"{self._folder(self.version)}/{MARKER}"), False).close()

    def location(self, table: str) -> str:
        """Path of the table in the newest published version."""
        done = self.published()
        if not done:
            raise FileNotFoundError(f"no published version under {self.root}")
        return f"{self._folder(done[-1])}/{table}"

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` published versions, and the
        unpublished ones older than the newest published one (a newer one may
        be a run under way).  Returns the deleted versions."""
        if keep < 1:
            raise ValueError("keep at least the version in force")
        done = self.published()
        kept = set(done[-keep:])
        old = [v for v in self.all() if done and v not in kept and v < done[-1]]
        for v in old:
            self._fs.delete(self._path(self._folder(v)), True)
        return old


class Swap(_Folder):
    """One version of every table, replaced by renames."""

    def begin(self) -> None:
        self.run = uuid.uuid4().hex[:8]

    def staged(self, table: str) -> str:
        return f"{self.root}/_staging/{self.run}/{table}"

    def location(self, table: str) -> str:
        return f"{self.root}/{table}"

    def publish(self, tables: Iterable[str]) -> None:
        fs = self._fs
        for table in tables:
            new, here = self._path(self.staged(table)), self._path(self.location(table))
            if fs.exists(here) and not fs.rename(here, self._path(self.staged(table) + ".old")):
                raise OSError(f"cannot move {here} aside")
            if not fs.rename(new, here):
                raise OSError(f"cannot move {new} to {here}")
        fs.delete(self._path(f"{self.root}/_staging/{self.run}"), True)


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table of the newest published version under ``root``."""
    return spark.read.parquet(Versions(spark, root).location(table))
