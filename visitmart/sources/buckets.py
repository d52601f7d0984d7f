"""Tables in hash buckets, changed by writing just the buckets that a run touches.

A store is a folder of tables. A table's rows lie in ``<table>/run=<id>/in_bucket=<k>``, dealt by a hash of its key. A manifest
names, for every table and bucket, the folder that holds its rows now. A run writes new folders for the buckets
it touches and then one new manifest for all tables, so readers see either all of a run's changes or none, and a run
that is repeated after a crash starts from the last manifest. Buckets that are not touched are neither listed nor read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitmart.sources.paths import PACKED, children, exists, remove

MANIFEST = "manifest"
BUCKET = "in_bucket"


def bucket_number(key: list[str], buckets: int) -> Column:
    """The bucket of a row by its key. Equal keys, nulls included, fall into one bucket."""
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def bucket_label(number: int, buckets: int) -> str:
    """Name of a bucket's folder where rows are only ever added."""
    return f"{number:05d}of{buckets:05d}"


class BucketStore:
    """The tables below ``root``, as the newest complete manifest has them."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root, keep
        versions = self._versions()
        newest = self._manifest(versions[-1]) if versions else {"tables": {}, "note": {}}
        self.tables, self.note = newest["tables"], newest["note"]

    def _versions(self) -> list[int]:
        folder = f"{self.root}/{MANIFEST}"
        names = [n for n in children(self.spark, folder) if n.startswith("version=")]
        return sorted(int(n[8:]) for n in names if exists(self.spark, f"{folder}/{n}/_SUCCESS"))

    def _manifest(self, version: int) -> dict:
        text = self.spark.read.option("wholetext", True).text(f"{self.root}/{MANIFEST}/version={version:06d}")
        return json.loads(text.first().value)

    def has(self, table: str) -> bool:
        """Whether the table is stored; one whose folder was taken away is not."""
        return table in self.tables and exists(self.spark, f"{self.root}/{table}")

    def buckets(self, table: str) -> int:
        return self.tables[table]["buckets"]

    def read(self, table: str, numbers: list[int] | None = None) -> DataFrame | None:
        """The rows of all buckets, or of those in ``numbers``; None if there is no such table."""
        if not self.has(table):
            return None
        entry = self.tables[table]
        wanted = entry["folders"] if numbers is None else {str(n): entry["folders"].get(str(n)) for n in numbers}
        schema = StructType.fromJson(entry["schema"])
        folders = [f"{self.root}/{folder}" for _, folder in sorted(wanted.items()) if folder]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def write(self, table: str, rows: DataFrame, key: list[str], buckets: int) -> dict:
        """New folders for the buckets of ``rows``. They count once ``commit`` names them."""
        run = f"{table}/run={uuid.uuid4().hex}"
        dealt = rows.withColumn(BUCKET, bucket_number(key, buckets))
        # The hint splits a large bucket over several tasks, and deals small ones together.
        dealt.hint("rebalance", BUCKET).write.options(**PACKED).partitionBy(BUCKET).parquet(f"{self.root}/{run}")
        found = [n for n in children(self.spark, f"{self.root}/{run}") if n.startswith(f"{BUCKET}=")]
        return {
            "buckets": buckets,
            "key": key,
            "schema": json.loads(rows.schema.json()),
            "folders": {n.split("=")[1]: f"{run}/{n}" for n in found},
        }

    def commit(self, written: dict[str, tuple[dict, list[int] | None]], **note) -> int:
        """Replace, in one step, the named buckets (None: all) of each table by what ``write`` returned for it.

        ``note`` is kept beside the tables, such as the number of the batch that is now part of them. The last ``keep`` manifests stay with their folders, for readers still on them.
        """
        tables = dict(self.tables)
        for table, (new, numbers) in written.items():
            folders = {} if numbers is None else dict(tables.get(table, new)["folders"])
            for n in numbers or []:
                folders.pop(str(n), None)
            tables[table] = new | {"folders": folders | new["folders"]}
        versions = self._versions()
        number = versions[-1] + 1 if versions else 1
        self.note = self.note | note
        manifest = json.dumps({"tables": tables, "note": self.note})
        text = self.spark.createDataFrame([(manifest,)], "value string").coalesce(1)
        text.write.mode("overwrite").text(f"{self.root}/{MANIFEST}/version={number:06d}")
        self.tables = tables
        self._forget([*versions, number])
        return number

    def _forget(self, versions: list[int]) -> None:
        folders = lambda m: {f for t in m["tables"].values() for f in t["folders"].values()}
        kept = set().union(*(folders(self._manifest(v)) for v in versions[-self.keep :]))
        for version in versions[: -self.keep]:
            for folder in folders(self._manifest(version)) - kept:
                remove(self.spark, f"{self.root}/{folder}")
            remove(self.spark, f"{self.root}/{MANIFEST}/version={version:06d}")


def touched_buckets(keys: DataFrame, key: list[str], buckets: int) -> list[int]:
    """The buckets, of a fixed number, that the rows of ``keys`` fall into."""
    return sorted(r[0] for r in keys.select(bucket_number(key, buckets)).distinct().collect())
