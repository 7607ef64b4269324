"""Named, versioned datasets in a folder."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.sources.manifests import entries, newest, publish

_REGISTRY = "name string, version int, description string, n_rows bigint, folder string"


class DatasetStore:
    """Parquet data below ``root``/data, one manifest per version below ``root``/versions.

    Any number of writers may register versions of one name at once: rows go to a folder of their own first, then
    a manifest claims the next version. A reader sees a version with all its rows or not at all, and what it
    has opened is never written to again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def registry(self) -> DataFrame:
        found = entries(self.spark, f"{self.root}/versions/*", _REGISTRY)
        return found.select("name", "version", "description", "n_rows")

    def _manifests(self, name: str) -> str:
        return f"{self.root}/versions/name={quote(name, safe='')}"

    def latest_version(self, name: str) -> int:
        return newest(self.spark, self._manifests(name))

    def register(self, df: DataFrame, name: str, description: str = "") -> int:
        """Writes the next version of ``name`` and returns its number."""
        folder = f"{quote(name, safe='')}/{uuid.uuid4().hex}"
        path = f"{self.root}/data/{folder}"
        df.write.parquet(path)
        n_rows = self.spark.read.parquet(path).count()
        entry = {"name": name, "description": description, "n_rows": n_rows, "folder": folder}
        return publish(self.spark, self._manifests(name), entry)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The given version, or the latest; only its own folder is read."""
        wanted = version if version is not None else self.latest_version(name)
        known = entries(self.spark, self._manifests(name), _REGISTRY).filter(F.col("version") == wanted).first()
        if known is None:
            raise LookupError(f"no dataset {name!r} with version {wanted}")
        return self.spark.read.parquet(f"{self.root}/data/{known['folder']}")
