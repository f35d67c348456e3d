"""The table-set holder (SC-01 … SC-08, PF-09, PF-10).

A :class:`TableSet` is an immutable bag of up to ten lazy DataFrames with
the declared schemas. Readers build one from a directory (parquet or CSV),
from ready DataFrames, from nested analysis JSON or from a sink; filters
return a new set. The facades (``.concepts``, ``.categories``,
``.sentiments``, ``.absa``) expose the operator catalogue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentions.errors import NoRelevantData
from mentions.operators import common as C
from mentions.schemas import ANALYSIS, CALL_TABLES, TABLES, conform
from mentions.sources.records import read_quoted_csv

FORMATS = ("parquet", "csv")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """A CSV table by its header: columns are found by name, in any order.

    Values are read as text and cast to the declared types, so a value that
    doesn't fit fails the query, as does a file whose header differs from the
    first one's. ``multi_line`` allows line breaks in quoted values; files are
    read in splits then too (:mod:`mentions.sources.records`), at the price of
    one shuffle of the lines. Switch it off for files without such values.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("mode", "FAILFAST")
    names = reader.option("multiLine", multi_line).csv(path).columns  # reads the header
    wanted = [f.name for f in schema.fields]
    missing = [n for n in wanted if n not in names]
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    if multi_line:
        rows = read_quoted_csv(spark, path, names, wanted)
    else:
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        rows = reader.option("multiLine", False).option("enforceSchema", False).schema(text).csv(path)
    return rows.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of the session (any scheme)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return bool(fs.exists(hpath))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it isn't there."""
    if not path_exists(spark, path):
        return []
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [status.getPath().getName() for status in fs.listStatus(hpath)]


def read_batches(spark: SparkSession, path: str, schema: T.StructType, batches: list[int]) -> DataFrame | None:
    """The committed batches of a table: files written at once (batch 0, taken over), and folders ``batch=<n>``."""
    names, parts = children(spark, path), []
    if any(n.endswith(".parquet") for n in names):
        parts.append(spark.read.schema(schema).parquet(f"{path}/*.parquet"))
    folders = {int(n[6:]) for n in names if n.startswith("batch=")}
    if folders & set(batches):
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).option("basePath", path).parquet(
            *[f"{path}/batch={n}" for n in batches if n in folders])
        parts.append(rows.drop("batch"))
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def table_path(root: str, name: str, fmt: str, suffix: str = "") -> str:
    base = f"{root.rstrip('/')}/{name}.{'csv' if fmt == 'csv' else 'parquet'}"
    return f"{base}_{suffix}" if suffix else base


def read_analyses(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines analyses; a line that is malformed or of other types fails the query."""
    return spark.read.schema(ANALYSIS).option("mode", "FAILFAST").json(path)


def _as_type(value, kind: T.DataType):
    """A value of parsed JSON as a value of a Spark type: whole numbers become doubles where doubles are due."""
    if value is None:
        return None
    if isinstance(kind, T.StructType):
        return {f.name: _as_type(value.get(f.name), f.dataType) for f in kind.fields}
    if isinstance(kind, T.ArrayType):
        return [_as_type(v, kind.elementType) for v in value]
    if isinstance(kind, T.DoubleType) and isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


class TableSet:
    """Up to ten named annotation tables (missing ones are ``None``)."""

    def __init__(self, tables: dict[str, DataFrame | None] | None = None, **kwargs: DataFrame | None):
        """Tables by name; a value may also be a zero-argument callable that
        builds the DataFrame on first access (plans are analysed lazily)."""
        given = dict(tables or {}, **kwargs)
        unknown = set(given) - set(TABLES)
        if unknown:
            raise KeyError(f"unknown tables: {sorted(unknown)}")
        self._tables: dict[str, object] = {name: given.get(name) for name in TABLES}
        self._built: dict[str, DataFrame] = {}
        if all(v is None for v in self._tables.values()):
            raise ValueError("No data provided")

    def _resolve(self, name: str) -> DataFrame | None:
        value = self._tables[name]
        if value is None:
            return None
        if name not in self._built:
            self._built[name] = conform(value() if callable(value) else value, name)
        return self._built[name]

    def _derive(self, change) -> "TableSet":
        """A new set whose present tables are ``change(name, df)`` of ours, built lazily."""
        def builder(name):
            return lambda: change(name, self[name])
        return TableSet({n: builder(n) for n in self.names()})

    # ---------------------------------------------------------- readers --
    @classmethod
    def from_path(cls, spark: SparkSession, path: str, fmt: str = "parquet", backup_suffix: str = "",
                  multi_line: bool = True) -> "TableSet":
        """SC-01/SC-02: read every table present under ``path``.

        Table ``t`` lives at ``<path>/t.parquet`` (or ``t.csv``), optionally
        with ``_<backup_suffix>`` appended. Missing tables are ``None``; a
        directory without any raises ValueError. Of tables written batch by
        batch only committed batches are read, as of now
        (:mod:`mentions.sources.registry`). The driver tests existence and
        reads CSV headers and the numbers of batches; the scans are lazy.
        """
        if fmt not in FORMATS:
            raise ValueError(f"fmt must be one of {FORMATS}")
        from mentions.sources.registry import Registry

        registry = Registry(spark, path, backup_suffix)
        batches = sorted(registry.committed()) if fmt == "parquet" and registry.there() else None
        found: dict[str, DataFrame | None] = {}
        for name, schema in TABLES.items():
            p = table_path(path, name, fmt, backup_suffix)
            if not path_exists(spark, p):
                found[name] = None
            elif fmt == "csv":
                found[name] = read_csv(spark, p, schema, multi_line)
            elif batches is not None:
                found[name] = read_batches(spark, p, schema, batches)
            else:
                found[name] = spark.read.schema(schema).parquet(p)
        if all(v is None for v in found.values()):
            raise ValueError(f"no table files in {path}")
        return cls(found)

    @classmethod
    def from_analyses(cls, analyses) -> "TableSet":
        """SC-04: flatten a DataFrame of analyses (see :mod:`mentions.operators.flatten`).

        The analyses are checked and stored by ranges of ``seq``
        (:func:`~mentions.operators.flatten.stage_analyses`); analyses that
        are staged already are taken as they are. A table is present when its
        call occurs in some analysis.
        """
        from mentions.operators import flatten as FL

        staged = analyses if isinstance(analyses, FL.Staged) else FL.stage_analyses(analyses)
        if not staged.calls:
            raise ValueError("the analyses hold no call")
        return cls(staged.tables())

    @classmethod
    def from_json(cls, spark: SparkSession, path: str) -> "TableSet":
        """SC-04: read JSON-lines analyses (one response per line, with ``seq``).

        Lines have no order on a cluster, so each needs ``seq``, the caller's
        input order. Malformed lines, values of a wrong type, and missing,
        NULL or repeated ``seq`` fail; whole numbers are taken for doubles.
        """
        return cls.from_analyses(read_analyses(spark, path))

    @classmethod
    def from_results(cls, spark: SparkSession, results) -> "TableSet":
        """SC-04: one analysis dict, or a list of them, already held by the caller.

        ``seq`` is the list position. The input is the caller's own Python
        object (bounded by driver memory); large inputs belong in files read
        with :meth:`from_json`.
        """
        items = [results] if isinstance(results, dict) else list(results)
        rows = [_as_type(dict(item, seq=i), ANALYSIS) for i, item in enumerate(items)]
        return cls.from_analyses(spark.createDataFrame(rows, ANALYSIS))

    @classmethod
    def from_sink(cls, sink) -> "TableSet":
        """SC-05: re-open what a :class:`mentions.sources.sinks.TableSink` wrote."""
        return sink.open()

    # ----------------------------------------------------------- access --
    def __getitem__(self, name: str) -> DataFrame | None:
        """SC-06: a table by name; KeyError for unknown names, None when absent."""
        if name not in TABLES:
            raise KeyError(name)
        return self._resolve(name)

    def has(self, name: str) -> bool:
        if name not in TABLES:
            raise KeyError(name)
        return self._tables[name] is not None

    def names(self) -> list[str]:
        return [n for n, v in self._tables.items() if v is not None]

    def tables(self) -> dict[str, DataFrame]:
        return {n: self[n] for n in self.names()}

    @property
    def concepts(self):
        """SC-07: concept facade (needs ``concepts`` or ``concepts_surface_strings``)."""
        from mentions.operators.concepts import Concepts

        if not any(self.has(t) for t in CALL_TABLES["concepts"]):
            raise NoRelevantData("no concept tables")
        return Concepts(self["concepts"], self["concepts_surface_strings"])

    @property
    def categories(self):
        from mentions.operators.categories import Categories

        if not self.has("categories"):
            raise NoRelevantData("no categories table")
        return Categories(self["categories"])

    @property
    def sentiments(self):
        from mentions.operators.categories import Sentiments

        if not self.has("sentiments"):
            raise NoRelevantData("no sentiments table")
        return Sentiments(self["sentiments"])

    @property
    def absa(self):
        from mentions.operators.absa import Absa

        if not any(self.has(t) for t in CALL_TABLES["absa"]):
            raise NoRelevantData("no table of entities, relations or evaluations")
        return Absa(self["absa_entities"], self["absa_normalized_texts"], self["absa_relations"],
                    self["absa_relations_entities"], self["absa_evaluations"], self["absa_evaluations_entities"])

    # ---------------------------------------------------------- filters --
    def filter(self, document_ids) -> "TableSet":
        """PF-10: keep only the given documents in every table.

        ``document_ids`` is a Python collection (an ``IN`` filter pushed to
        the scans) or a DataFrame with a ``doc_id`` column (a left-semi join).
        """
        if isinstance(document_ids, DataFrame):
            ids = document_ids.select(F.col("doc_id").cast("long"))  # semi join: duplicates are harmless
            if not ids.take(1):
                raise ValueError("no documents to keep")
            return self._derive(lambda _name, df: df.join(ids, "doc_id", "left_semi"))
        wanted = sorted(set(int(i) for i in document_ids))
        if not wanted:
            raise ValueError("no documents to keep")
        return self._derive(lambda _name, df: df.filter(F.col("doc_id").isin(wanted)))

    def remove_concepts(self, concepts) -> "TableSet":
        """PF-09: drop the named concepts from both concept tables (NULL names stay).

        Returns a new set; the original is unchanged.
        """
        names = concepts if isinstance(concepts, DataFrame) else C.as_name_list(concepts)

        def change(name, df):
            return C.drop_names(df, "concept", names) if name in CALL_TABLES["concepts"] else df
        return self._derive(change)
