"""The registry of a folder of tables: which batches there are, and whose turn is next (FL-15, SK-01, ST-01).

Every way of adding rows to a set, an append or a micro-batch of a stream,
first *claims* a batch: it creates ``_claims/<number>.json``, which only one
writer can, with the range of document ids that it will use. Ids go on from the
claim before, so writers at the same time get different numbers and ranges
and none waits for another's data. A claim also names the stream and its
micro-batch; a replayed micro-batch finds its claim and writes the same
folders with the same ids.

When its tables are written, a batch is *committed* by ``_ids/batch=<number>``.
Readers see committed batches only. A writer that dies in between leaves a gap
in the ids and files that nobody reads.

Tables that were written at once (:class:`~mentions.sources.sinks.TableSink`)
become batch 0 when something is first added to them; they stay where they
are. A rewrite moves the registry aside with the tables, and what it starts
with keeps the next id, so that no id is given twice in a folder, and how far
each stream had come, so that a replay after the rewrite adds nothing twice.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentions.schemas import TABLES
from mentions.sources.tables import children, path_exists, table_path

IDS, CLAIMS, SUMMARIES = "_ids", "_claims", "_summaries"
#: Seconds to wait for a writer that has created its claim and not filled it yet.
PATIENCE = 30.0


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its content, or return False if it exists."""
    jvm, raw = spark._jvm, bytearray(text.encode())
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(hpath.getParent())
    try:
        if fs.getScheme() == "file":  # Hadoop's own local file system looks first and creates then
            options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            options[0], options[1] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
            jvm.java.nio.file.Files.write(jvm.java.io.File(hpath.toUri().getPath()).toPath(), raw, options)
        else:
            stream = fs.create(hpath, False)
            stream.write(raw)
            stream.close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName() or path_exists(spark, path):
            return False
        raise
    return True


@dataclass(frozen=True)
class Claim:
    """A batch: its number, its ids (``first_id`` up to ``next_id``, exclusive), and the micro-batch that it holds, if any."""

    batch: int
    first_id: int
    next_id: int
    stream: str | None = None
    micro_batch: int | None = None
    #: of a set that was rewritten: the last micro-batch of each stream before
    done: dict[str, int] | None = None


class Registry:
    """The registry of the tables in ``root`` (or of their backup ``suffix``)."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ""):
        self.spark, self.root = spark, root.rstrip("/")
        self.ids, self.claims = (f"{self.root}/{name}{'_' + suffix if suffix else ''}" for name in (IDS, CLAIMS))

    def there(self) -> bool:
        return path_exists(self.spark, self.ids) or path_exists(self.spark, self.claims)

    def records(self) -> DataFrame:
        """``batch, next_id`` of the committed batches."""
        if not path_exists(self.spark, self.ids):
            return self.spark.createDataFrame([], "next_id long, batch long")
        return self.spark.read.schema("next_id long, batch long").parquet(self.ids)

    def committed(self) -> set[int]:
        return {r.batch for r in self.records().collect()}  # one number for each batch

    def claimed(self) -> list[Claim]:
        """All claims, by number."""
        limit = time.monotonic() + PATIENCE
        while True:
            numbers = {int(n.split(".")[0]) for n in children(self.spark, self.claims) if n.endswith(".json") and not n.startswith(".")}
            if not numbers:
                return []
            rows = self.spark.read.text(self.claims, wholetext=True).select("value").collect()  # one short line for each batch
            found = [Claim(**json.loads(r.value)) for r in rows if r.value.endswith("\n")]
            if numbers <= {c.batch for c in found}:
                return sorted(found, key=lambda c: c.batch)
            if time.monotonic() > limit:
                raise TimeoutError(f"claims {sorted(numbers - {c.batch for c in found})} in {self.claims} are empty: their writer has "
                                   f"stopped; remove them")
            time.sleep(0.1)

    def _create(self, claim: Claim) -> bool:
        """Create the claim's file with its content, or return False if its number is taken."""
        return create_exclusively(self.spark, f"{self.claims}/{claim.batch:09d}.json", json.dumps(claim.__dict__) + "\n")

    def adopt(self) -> None:
        """Make what was written without a registry its batch 0."""
        if children(self.spark, self.claims):
            return
        earlier = self.records().agg(F.max("batch").alias("batch"), F.max("next_id").alias("next_id")).first()
        if earlier.batch is not None:  # batches of a folder without claims
            self._create(Claim(earlier.batch, earlier.next_id, earlier.next_id))
            return
        next_id = self.least_next_id()
        if next_id:
            claim = Claim(0, 0, next_id)
            if self._create(claim):
                self.commit(claim)

    def least_next_id(self) -> int:
        """The largest document id of the tables written at once, and one."""
        found = [0]
        for name in TABLES:
            path = table_path(self.root, name, "parquet")
            if any(n.endswith(".parquet") for n in children(self.spark, path)):
                top = self.spark.read.schema("doc_id long").parquet(f"{path}/*.parquet").agg(F.max("doc_id")).first()[0]
                found.append(0 if top is None else top + 1)
        return max(found)

    def claim(self, used: int, stream: str | None = None, micro_batch: int | None = None) -> Claim:
        """The next batch, with ``used`` document ids."""
        self.adopt()
        while True:
            last = max(self.claimed(), key=lambda c: c.batch, default=None)
            first = 0 if last is None else last.next_id
            mine = Claim(0 if last is None else last.batch + 1, first, first + used, stream, micro_batch)
            if self._create(mine):
                return mine

    def of_stream(self, stream: str, micro_batch: int) -> Claim | None:
        """The claim of a micro-batch that was begun before."""
        return next((c for c in self.claimed() if c.stream == stream and c.micro_batch == micro_batch), None)

    def progress(self) -> dict[str, int]:
        """The last committed micro-batch of each stream."""
        done, committed = {}, self.committed()
        for c in self.claimed():
            for stream, last in {**(c.done or {}), **({c.stream: c.micro_batch} if c.stream and c.batch in committed else {})}.items():
                done[stream] = max(last, done.get(stream, last))
        return done

    def commit(self, claim: Claim) -> None:
        """Show the batch to readers."""
        self.spark.createDataFrame([(claim.next_id,)], "next_id long").coalesce(1).write.mode("overwrite").parquet(
            f"{self.ids}/batch={claim.batch}")

    def restart(self, next_id: int, done: dict[str, int]) -> None:
        """Begin the registry of a rewritten set."""
        claim = Claim(0, 0, max(next_id, self.least_next_id()), done=done)
        if self._create(claim):
            self.commit(claim)
