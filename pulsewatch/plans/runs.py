"""Runs that may break at any point and be repeated: attempts, and one commit for output and history.

A run writes all its tables into an attempt folder of its own, which nobody reads. Its last step puts a manifest into the log, by
a rename that fails if the manifest is already there. That one step makes the output, the run's entry in the run history and its
mails in the sent history visible, all or none. A run that broke off before has left an attempt folder and nothing else: it is
simply run again, and the leftovers go when the repetition commits. Of two runs of one job at a time, the second to finish is
refused.

``log/<day>/<script>-<geo>.json`` is the manifest of the run that counts; notices of runs that could not do their work (late data,
failed pull) have manifests of their own, one a day of each kind, and do not stop a later run.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.sources.warehouse import SCHEMAS

MANIFEST = "run_date date, script string, geo string, kind string, folder string, counts boolean, tables array<string>"
OUTBOX = "outbox"


@dataclass(frozen=True)
class JobFiles:
    """Where a job writes: ``out`` holds the attempts, ``log`` the manifests of all jobs."""

    out: str
    log: str


# ---- files ------------------------------------------------------------------

def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, name: str) -> bool:
    fs, path = _path(spark, name)
    return fs.exists(path)


def delete(spark: SparkSession, name: str) -> None:
    fs, path = _path(spark, name)
    fs.delete(path, True)


def publish(spark: SparkSession, name: str, text: str) -> bool:
    """Create a file with its whole content at once; False if it exists."""
    folder, _, last = name.rpartition("/")
    fs, target = _path(spark, name)
    _, draft = _path(spark, f"{folder}/_{last}.{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target):
        fs.delete(draft, False)
        return False
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    how = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never_over = gateway.new_array(how, 1)
    never_over[0] = how.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), never_over)
    except Exception:
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise
    return True


# ---- attempts ---------------------------------------------------------------

class Attempt:
    """The folder that one run writes to. As a context, what was not committed is deleted at the end, as far as that can be done."""

    def __init__(self, spark: SparkSession, files: JobFiles, script: str, geo: str, run_date: date):
        self.spark, self.files, self.script, self.geo, self.run_date = spark, files, script, geo, run_date
        self.home = f"{files.out}/{run_date.isoformat()}/{quote(script, safe='')}-{quote(geo, safe='')}"
        self.folder, self.tables, self.committed = f"{self.home}/{uuid.uuid4().hex}", [], False

    def __enter__(self) -> Attempt:
        return self

    def __exit__(self, *_) -> None:
        if not self.committed:
            delete(self.spark, self.folder)

    def write(self, df: DataFrame, name: str) -> None:
        df.write.parquet(f"{self.folder}/{name}")
        self.tables.append(name)

    def write_with(self, writer: Callable[..., str], df: DataFrame, name: str, *args) -> None:
        """A table that a sink writes (CSV, JSON)."""
        writer(df, f"{self.folder}/{name}", *args)
        self.tables.append(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def commit(self, kind: str, counts: bool = True) -> bool:
        """Make all of it visible at once; False if another run of the day already counts.

        ``counts`` enters the run history: the job does not run again today.
        """
        place = manifest_path(self.files.log, self.run_date, self.script, self.geo, None if counts else kind)
        manifest = {"run_date": self.run_date.isoformat(), "script": self.script, "geo": self.geo, "kind": kind,
                    "folder": self.folder, "counts": counts, "tables": self.tables}
        self.committed = publish(self.spark, place, json.dumps(manifest))
        if self.committed and counts:
            self._sweep()
        return self.committed

    def _sweep(self) -> None:
        """Delete what broken attempts of this job left, but for folders that a manifest of the day names."""
        named = {r["folder"].rpartition("/")[2] for r in manifests(self.spark, self.files.log, self.run_date).select("folder").collect()}
        fs, home = _path(self.spark, self.home)
        for found in fs.listStatus(home):
            if found.getPath().getName() not in named:
                fs.delete(found.getPath(), True)


# ---- the log ----------------------------------------------------------------

def manifest_path(log: str, run_date: date, script: str, geo: str, kind: str | None = None) -> str:
    name = "-".join(quote(part, safe="") for part in (script, geo, *([kind] if kind else [])))
    return f"{log}/{run_date.isoformat()}/{name}.json"


def manifests(spark: SparkSession, log: str, run_date: date) -> DataFrame:
    """All manifests of a day: at most a few for each job."""
    folder = f"{log}/{run_date.isoformat()}"
    if not exists(spark, folder):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(folder)


def committed(spark: SparkSession, log: str, run_date: date, script: str, geo: str, kind: str | None = None) -> str | None:
    """Folder of the run that counts (or of a notice of this kind); None if there is none."""
    place = manifest_path(log, run_date, script, geo, kind)
    if not exists(spark, place):
        return None
    return spark.read.schema(MANIFEST).json(place).first()["folder"]


def logged_runs(spark: SparkSession, log: str, run_date: date) -> DataFrame:
    """The day's run history: (run_date, script, geo) of the runs that count."""
    return manifests(spark, log, run_date).where("counts").select(*SCHEMAS["run_history"].names)


def sent_mails(spark: SparkSession, log: str, run_date: date) -> DataFrame:
    """The day's mails, (run_date, to, subject) and all else of the outboxes that manifests name."""
    folders = [r["folder"] for r in manifests(spark, log, run_date).where(F.array_contains("tables", OUTBOX)).select("folder").collect()]
    if not folders:
        return spark.createDataFrame([], SCHEMAS["sent_history"])
    return spark.read.parquet(*[f"{f}/{OUTBOX}" for f in folders])


def sent_history(spark: SparkSession, log: str, run_date: date) -> DataFrame:
    return sent_mails(spark, log, run_date).select(*SCHEMAS["sent_history"].names)
