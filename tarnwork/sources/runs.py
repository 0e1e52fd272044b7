"""Runs: several outputs that count together, on plain Parquet.

A run writes any number of outputs, each into a folder of its own name and a new token, and ends by one small marker file,
renamed into place. Only what a marker names exists for readers: a run that was killed between two outputs leaves files
that nobody reads, and the next run starts from the state that the last marker hands on. Two runs that start from the same
marker cannot both end: the second rename finds the name taken and fails.

    <base>/<output>/<run>-<token>/   rows that the run wrote to an output
    <base>/_runs/<run>.json          marker: folders of each output that count from then on, and the state
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from decimal import Decimal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tarnwork.session import CODEC
from tarnwork.sources.writer import _fs, _writer

MARKERS = "_runs"
# Values that a marker keeps besides what JSON knows, by the name of their type.
KINDS = {"datetime": datetime.fromisoformat, "date": date.fromisoformat, "decimal": Decimal}


def _plain(value):
    if isinstance(value, (datetime, date)):
        return {"_kind": type(value).__name__, "_value": value.isoformat()}
    if isinstance(value, Decimal):
        return {"_kind": "decimal", "_value": str(value)}
    raise TypeError(f"a marker cannot keep {type(value).__name__}")


def _typed(entry: dict):
    return KINDS[entry["_kind"]](entry["_value"]) if "_kind" in entry else entry


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all. An error if the name is taken."""
    fs, target = _fs(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(target) or not fs.rename(part, target):
        fs.delete(part, False)
        raise FileExistsError(f"{path} exists: another run has ended in the meantime")


def read_file(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def numbered_files(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the files ``<number>.json`` of a folder, ascending."""
    return sorted(int(n[:-5]) for n in names_in(spark, path) if n.endswith(".json") and n[:-5].isdigit())


class Runs:
    """The runs under one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def numbers(self) -> list[int]:
        """Numbers of the runs that ended, ascending."""
        return numbered_files(self.spark, f"{self.base}/{MARKERS}")

    def marker(self, number: int | None = None) -> dict:
        """The marker of a run, by default of the last one; before the first run an empty one."""
        done = [number] if number is not None else self.numbers()
        if not done:
            return {"run": -1, "folders": {}, "state": {}}
        return json.loads(read_file(self.spark, f"{self.base}/{MARKERS}/{done[-1]}.json"), object_hook=_typed)

    def state(self) -> dict:
        """What the last run handed on."""
        return self.marker()["state"]

    def read(self, output: str, number: int | None = None) -> DataFrame | None:
        """The rows of an output as of a run (the last one): of the version that counts, or of all appended parts.
        ``None`` if nothing was written to it. Parts may differ in their columns."""
        folders = self.marker(number)["folders"].get(output)
        if not folders:
            return None
        paths = [f"{self.base}/{output}/{f}" for f in folders]
        return self.spark.read.option("mergeSchema", str(len(paths) > 1).lower()).parquet(*paths)

    def begin(self) -> Run:
        return Run(self)

    def expire(self, keep: int = 1) -> None:
        """Remove all folders that none of the last ``keep`` markers names, also those of runs that never ended."""
        fs, _ = _fs(self.spark, self.base)
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        named = [self.marker(n)["folders"] for n in self.numbers()[-keep:]]
        for output in names_in(self.spark, self.base):
            if output == MARKERS:
                continue
            wanted = {f for folders in named for f in folders.get(output, [])}
            for folder in names_in(self.spark, f"{self.base}/{output}"):
                if folder not in wanted:
                    fs.delete(path(f"{self.base}/{output}/{folder}"), True)


class Run:
    """One run: outputs first, then ``commit``."""

    def __init__(self, runs: Runs):
        self.runs = runs
        before = runs.marker()
        self.number = before["run"] + 1
        self.folders = {k: list(v) for k, v in before["folders"].items()}
        self.state = dict(before["state"])
        self.token = f"{self.number}-{uuid.uuid4().hex[:12]}"

    def write(self, output: str, df: DataFrame, append: bool = False, parts: list[str] | None = None) -> None:
        """Write rows to an output; they replace it unless ``append``. One write to an output per run."""
        if self.token in self.folders.get(output, []):
            raise ValueError(f"the run has already written {output!r}")
        _writer(df, parts).option("compression", CODEC).parquet(f"{self.runs.base}/{output}/{self.token}")
        self.folders[output] = [*self.folders.get(output, []), self.token] if append else [self.token]

    def write_all(self, writes: list[tuple[str, DataFrame, bool, list[str] | None]]) -> None:
        """Several writes, ``(output, rows, append, parts)``, at the same time, so that small ones need not wait for large
        ones. Returns when all have ended; the first error is raised then."""
        with ThreadPoolExecutor(len(writes)) as pool:
            ends = [pool.submit(inheritable_thread_target(self.runs.spark)(self.write), *w) for w in writes]
        for end in ends:
            end.result()

    def commit(self, **state) -> int:
        """End the run: everything it wrote counts from here on, together with the state (added to the state before)."""
        text = json.dumps({"run": self.number, "folders": self.folders, "state": self.state | state}, default=_plain)
        write_file(self.runs.spark, f"{self.runs.base}/{MARKERS}/{self.number}.json", text)
        return self.number
