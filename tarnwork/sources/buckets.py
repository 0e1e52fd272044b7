"""Tables of which a load rewrites only what it touches, without a natural partition column.

Rows are dealt to a fixed number of buckets by a hash of their key, and each bucket lives in folders of its own. A load reads
and writes the buckets that its keys fall into; all other files stay where they are. A manifest per version, renamed into
place, says which folders make up each bucket, so a version counts as a whole or not at all, and a load that is repeated
under a number that has ended changes nothing.

    <base>/data/<version>-<token>/dl_bucket=<k>/   rows of one bucket that the version wrote
    <base>/_versions/<version>.json                manifest: folders of every bucket, schema, notes
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarnwork.session import cut
from tarnwork.sources.runs import names_in, numbered_files, read_file, write_file
from tarnwork.sources.writer import _fs, _writer

BUCKET = "dl_bucket"
BUCKETS = 64
MANIFESTS = "_versions"


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a key. Keys are hashed as text, so that a wider number type changes nothing."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


class BucketTable:
    """A table under ``base`` with rows dealt by ``keys``. The number of buckets is fixed by the first version."""

    def __init__(self, spark: SparkSession, base: str, keys: list[str] | None = None, buckets: int = BUCKETS):
        self.spark, self.base, self.keys, self.buckets = spark, base.rstrip("/"), keys, buckets

    def versions(self) -> list[int]:
        return numbered_files(self.spark, f"{self.base}/{MANIFESTS}")

    def manifest(self, below: int | None = None) -> dict | None:
        """The newest manifest, optionally of a version below a number."""
        done = [v for v in self.versions() if below is None or v < below]
        return json.loads(read_file(self.spark, f"{self.base}/{MANIFESTS}/{done[-1]}.json")) if done else None

    def read(self, below: int | None = None, only: list[int] | None = None) -> DataFrame | None:
        """The rows of the newest version (below a number), of all buckets or some. ``None`` before the first version."""
        found = self.manifest(below)
        return None if found is None else self._rows(found, only)

    def _rows(self, manifest: dict, only: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        wanted = {str(b) for b in only} if only is not None else manifest["folders"].keys()
        paths = [f"{self.base}/data/{f}/{BUCKET}={b}" for b, folders in manifest["folders"].items() if b in wanted for f in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def load(self, source: DataFrame, number: int, merge: Callable[[DataFrame | None, DataFrame], DataFrame], append: bool = False, notes: dict | None = None) -> bool:
        """Make version ``number`` of the version below it and a source. ``merge`` gets the rows of the buckets that the
        source falls into (``None`` before the first version) and the source, and returns these buckets' new rows, or
        with ``append`` the rows to add to them; it must not move a row to another key. False if the version is there
        already, as when a batch is handed over again.
        """
        if number in self.versions():
            return False
        before = self.manifest(number)
        buckets = before["buckets"] if before else self.buckets
        bucket = bucket_of(self.keys, buckets)
        rows = cut(source.withColumn(BUCKET, bucket), "load")
        hit = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())  # no more than there are buckets
        merged = merge(self._rows(before, hit) if before else None, rows.drop(BUCKET))
        folder = f"{number}-{uuid.uuid4().hex[:12]}"
        _writer(merged.withColumn(BUCKET, bucket), [BUCKET]).parquet(f"{self.base}/data/{folder}")
        wrote = {n.split("=")[1] for n in names_in(self.spark, f"{self.base}/data/{folder}") if n.startswith(f"{BUCKET}=")}
        if stray := wrote - {str(b) for b in hit}:
            raise ValueError(f"the load moved rows to buckets {sorted(stray)}")
        folders = dict(before["folders"]) if before else {}
        for b in map(str, hit):
            kept = folders.get(b, []) if append else []
            folders[b] = [*kept, folder] if b in wrote else kept
        schema = _widened(StructType.fromJson(before["schema"]) if before else None, merged.schema)
        text = json.dumps({"version": number, "buckets": buckets, "keys": self.keys, "folders": folders, "schema": json.loads(schema.json()), "notes": notes or {}})
        write_file(self.spark, f"{self.base}/{MANIFESTS}/{number}.json", text)
        return True

    def expire(self, keep: int = 2) -> None:
        """Remove what the newest ``keep`` versions do not use. A batch that may come again needs the version below it,
        so streams keep two."""
        fs, _ = _fs(self.spark, self.base)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        versions = self.versions()
        used = set()
        for v in versions[-keep:]:
            manifest = json.loads(read_file(self.spark, f"{self.base}/{MANIFESTS}/{v}.json"))
            used |= {(f, b) for b, folders in manifest["folders"].items() for f in folders}
        for v in versions[:-keep]:
            fs.delete(path(f"{self.base}/{MANIFESTS}/{v}.json"), False)
        whole = {f for f, _ in used}
        for folder in names_in(self.spark, f"{self.base}/data"):
            if folder not in whole:
                fs.delete(path(f"{self.base}/data/{folder}"), True)
                continue
            for name in names_in(self.spark, f"{self.base}/data/{folder}"):
                if name.startswith(f"{BUCKET}=") and (folder, name.split("=")[1]) not in used:
                    fs.delete(path(f"{self.base}/data/{folder}/{name}"), True)


def _widened(before: StructType | None, now: StructType) -> StructType:
    """Columns of both schemas; untouched buckets read null for columns that came later."""
    if before is None:
        return now
    for f in now.fields:
        if f.name in before.names and before[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} changes its type from {before[f.name].dataType.simpleString()} to {f.dataType.simpleString()}")
    return StructType([*before.fields, *[f for f in now.fields if f.name not in before.names]])
