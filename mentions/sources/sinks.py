"""Table-set sinks (SK-01 … SK-04).

``TableSink`` writes every present table of a set under one directory
(parquet by default, CSV on request): to a staging folder first, then all
earlier outputs are moved aside with a UTC time-stamp suffix and the new ones
take their places; tables without rows are left out. Writes go
through Spark's commit protocol, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentions.schemas import TABLES
from mentions.sources.registry import CLAIMS, IDS, SUMMARIES, Registry
from mentions.sources.tables import FORMATS, TableSet, path_exists, read_csv, table_path

STAMP = "%Y%m%d%H%M%S"  # fixed value: backup suffix format (UTC)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hpath


def move(spark: SparkSession, src: str, dst: str) -> None:
    """Rename, or raise: a target that exists is refused, and a rename that reports failure is an error."""
    fs, hsrc = _fs(spark, src)
    hdst = spark._jvm.org.apache.hadoop.fs.Path(dst)
    if fs.exists(hdst):
        raise FileExistsError(dst)
    if not fs.rename(hsrc, hdst):
        raise OSError(f"could not rename {src} to {dst}")


def backup(spark: SparkSession, root: str, names, fmt: str = "parquet", now: dt.datetime | None = None,
           moved: list[tuple[str, str]] | None = None) -> list[str]:
    """SK-03: rename existing ``<root>/<table>`` outputs to ``..._<UTC stamp>``.

    Returns the new names (file names only), in the order of ``names``. The
    registry of parquet tables that were written in batches, and their summaries, go with them. A
    backup of the same second is never overwritten or nested into: it raises
    FileExistsError before anything is moved. Renames are added to ``moved``
    as they are done.
    """
    stamp = (now or dt.datetime.now(dt.timezone.utc)).strftime(STAMP)
    there = [src for src in (table_path(root, name, fmt) for name in names) if path_exists(spark, src)]
    records = [f"{root.rstrip('/')}/{name}" for name in (IDS, CLAIMS, SUMMARIES)] if fmt == "parquet" else []
    records = [src for src in records if path_exists(spark, src)]
    for src in there + records:
        if path_exists(spark, f"{src}_{stamp}"):
            raise FileExistsError(f"{src}_{stamp}")
    for src in there + records:
        move(spark, src, f"{src}_{stamp}")
        if moved is not None:
            moved.append((src, f"{src}_{stamp}"))
    return [f"{src}_{stamp}".rsplit("/", 1)[-1] for src in there]


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        (writer.option("header", True).option("escape", '"').option("emptyValue", "")
         .csv(path))
    else:
        writer.parquet(path)


class TableSink:
    """SK-01: a directory of table outputs."""

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        if fmt not in FORMATS:
            raise ValueError(f"fmt must be one of {FORMATS}")
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self.backed_up: list[str] = []

    def write(self, tables: TableSet | dict[str, DataFrame], backup_existing: bool = True) -> list[str]:
        """Write every present table; return the names written (empty ones left out).

        The set is fresh: earlier outputs of all ten tables are moved aside,
        with their registry (without ``backup_existing`` there must be none).
        The new tables are first written whole to a staging folder below the
        target, so the input may be the target's own tables. If moving fails,
        what was moved is moved back, and the error raised.
        """
        frames = tables.tables() if isinstance(tables, TableSet) else {n: d for n, d in tables.items() if d is not None}
        staging = f"{self.path}/_staging_{uuid.uuid4().hex}"
        written, moved = [], []
        try:
            for name, df in frames.items():
                staged = table_path(staging, name, self.fmt)
                write_table(df, staged, self.fmt)
                if not self._read(staged, name).isEmpty():  # SK-04: the written files are cheap to probe
                    written.append(name)
            registry = Registry(self.spark, self.path)
            had = self.fmt == "parquet" and registry.there()
            next_id = max((c.next_id for c in registry.claimed()), default=0) if had else 0
            next_id = max(next_id, registry.records().agg(F.max("next_id")).first()[0] or 0) if had else 0
            done = registry.progress() if had else {}
            if backup_existing:
                self.backed_up = backup(self.spark, self.path, list(TABLES), self.fmt, moved=moved)
            elif had:
                raise FileExistsError(registry.ids)
            for name in written:
                source, target = table_path(staging, name, self.fmt), table_path(self.path, name, self.fmt)
                move(self.spark, source, target)
                moved.append((source, target))
            if had:
                registry.restart(next_id, done)
        except BaseException:
            for source, target in reversed(moved):
                move(self.spark, target, source)
            raise
        finally:
            fs, hpath = _fs(self.spark, staging)
            fs.delete(hpath, True)
        return written

    def append(self, analyses: DataFrame) -> int:
        """FL-15: flatten further analyses and add them; document ids go on. Returns the batch's number.

        Tables written here before stay, as the first batch. Readers see the
        batch once it is whole (see :mod:`mentions.sources.registry`).
        """
        from mentions.streaming.ingest import append_analyses

        if self.fmt != "parquet":
            raise ValueError("append needs the parquet format")
        return append_analyses(analyses, self.path)

    def _read(self, target: str, name: str) -> DataFrame:
        if self.fmt == "csv":
            return read_csv(self.spark, target, TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(target)

    def open(self) -> TableSet:
        """SC-05: the written tables as a new set."""
        return TableSet.from_path(self.spark, self.path, self.fmt)


class ViewSink:
    """SK-02: tables as session temp views (``<prefix><name>``) and in a dict."""

    def __init__(self, spark: SparkSession, prefix: str = ""):
        self.spark, self.prefix = spark, prefix
        self.frames: dict[str, DataFrame] = {}

    def write(self, tables: TableSet | dict[str, DataFrame], skip_empty: bool = True) -> list[str]:
        """Register every present table; with ``skip_empty`` (SK-04) a table
        without rows is left out (one ``LIMIT 1`` probe per table)."""
        frames = tables.tables() if isinstance(tables, TableSet) else {n: d for n, d in tables.items() if d is not None}
        written = []
        for name, df in frames.items():
            if skip_empty and df.isEmpty():
                continue
            df.createOrReplaceTempView(f"{self.prefix}{name}")
            self.frames[name] = df
            written.append(name)
        return written

    def open(self) -> TableSet:
        return TableSet(self.frames)
