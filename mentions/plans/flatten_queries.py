"""Registered flatten queries (FL-01 … FL-16).

The driver's tables hold no analysis JSON, so the queries first nest
lineitem rows into analysis rows - one analysis per order (``seq`` =
order key), one text per group of three line numbers - and then flatten
them back with the library. Every nesting group is one order or one text,
both bounded in size by the data generator (at most 13 lines per order), so
no unbounded group is gathered. The oracle derives the expected flat rows
straight from the views, renumbering documents (dense rank of the order
key), texts (dense rank of the text number inside an order) and relations
(dense rank of the line number inside a text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.operators import flatten as FL
from mentions.plans.registry import r, register, rounded
from mentions.schemas import CALL_TABLES
from mentions.session import DROP_SHUFFLES, scratch_dir, settings
from mentions.sources.sinks import TableSink
from mentions.sources.tables import TableSet
from mentions.sources.views import Raw, stored_folder, with_views

#: Lines of a slice of the orders, about, and the slices at most: each slice reads lineitem and part again.
SLICE_LINES, MAX_SLICES = 6_000_000, 6


def _lines(raw: Raw, slice_: tuple[int, int] | None = None) -> DataFrame:
    """lineitem rows with part and nation; of a slice ``(k, n)``, those of every n-th order by a hash of its key."""
    li = raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                                "l_tax", "l_returnflag", "l_linestatus").filter("l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
    if slice_:  # not hash(), by which Spark deals rows to partitions
        li = li.filter(F.pmod(F.xxhash64("l_orderkey"), F.lit(slice_[1])) == slice_[0])
    part = raw("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    sup = raw("supplier").select("s_suppkey", "s_nationkey")
    nat = raw("nation").select("n_nationkey", "n_name")
    # one table after the other: Spark broadcasts those that are small, but takes a join of two of them for large
    lines = (li.join(sup, li.l_suppkey == sup.s_suppkey, "left").join(nat, F.col("s_nationkey") == F.col("n_nationkey"), "left")
             .join(part, li.l_partkey == part.p_partkey))
    return (lines.drop("l_partkey", "l_suppkey", "p_partkey", "s_suppkey", "s_nationkey", "n_nationkey")
            .withColumnRenamed("l_orderkey", "ok"))


def _line() -> F.Column:
    """What a line gives to its text, ready to be put into lists."""
    end = F.col("l_linenumber") + F.col("p_size")
    return F.struct(
        F.col("l_linenumber").alias("ln"), F.floor((F.col("l_linenumber") - 1) / 3).cast("int").alias("t"),
        F.struct(F.lower("p_type").alias("type"), F.col("p_brand").alias("value")).alias("part"),
        F.struct(F.col("p_brand").alias("value"), F.lower("p_type").alias("type")).alias("concept"),
        F.when(F.col("n_name").isNotNull(), F.struct(F.lit("nation").alias("type"), F.col("n_name").alias("value"))).alias("nation"),
        F.array("l_linenumber", end).alias("span"), end.alias("end"), "p_name", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")


def _in_groups(rows: F.Column, key: str, of_group) -> F.Column:
    """``of_group(value, rows)`` for each distinct value of the field ``key``, in order. A group's rows are found once, however
    often ``of_group`` names them."""
    keys = F.sort_array(F.array_distinct(rows[key]))
    groups = F.transform(keys, lambda k: F.struct(k.alias("k"), F.filter(rows, lambda x: x[key].eqNullSafe(k)).alias("rows")))
    return F.transform(groups, lambda g: of_group(g["k"], g["rows"]))


def _total(rows: F.Column, value) -> F.Column:
    """SUM over rows: of what is not NULL, NULL if nothing is."""
    return F.aggregate(rows, F.lit(None).cast("double"), lambda total, x: F.when(
        value(x).isNotNull(), F.coalesce(total, F.lit(0.0)) + value(x)).otherwise(total))


def _mean(rows: F.Column, value) -> F.Column:
    """AVG over rows."""
    return _total(rows, value) / F.size(F.filter(rows, lambda x: value(x).isNotNull()))


def _least(rows: F.Column, name: str) -> F.Column:
    return F.array_min(rows[name])


def _mentioned(n: F.Column, rows: F.Column) -> F.Column:
    """What relations and evaluations of the lines of one number have in common, and what a relation has besides."""
    rating = (F.when(_least(rows, "l_tax") == 0, F.lit(100.0))
              .otherwise(F.round(F.lit(20) * _least(rows, "l_discount") - F.lit(1), 2)).cast("double"))
    return F.struct(
        F.sort_array(rows["part"]).alias("parts"), F.sort_array(F.filter(rows["nation"], lambda x: x.isNotNull())).alias("nations"),
        _least(rows, "l_returnflag").alias("flag"), _least(rows, "l_linestatus").alias("status"), rating.alias("rating"),
        F.struct(F.array(n, _least(rows, "end")).alias("span"), _least(rows, "p_name").alias("surface_string")).alias("surface"))


def _relation(m: F.Column) -> F.Column:
    return F.struct(
        (m["flag"] == "R").alias("external_entity"),
        F.struct(F.concat(m["parts"], m["nations"]).alias("entity"), m["flag"].alias("opinion_holder"),
                 F.when(m["status"] == "O", F.lit(None)).otherwise(m["status"]).alias("restriction"),
                 m["rating"].alias("sentiment_value")).alias("semantics"),
        m["surface"].alias("surface"))


def _evaluation(m: F.Column) -> F.Column:
    return F.struct(F.struct(m["parts"].alias("entity"), m["rating"].alias("sentiment_value")).alias("semantics"),
                    m["surface"].alias("surface"))


def _categories(lines: F.Column) -> F.Column:
    keyed = F.sort_array(F.transform(lines, lambda x: F.struct(x["ln"].alias("ln"), x["part"]["type"].alias("ptype"), x["l_discount"].alias("p"))))
    return F.transform(keyed, lambda x: F.struct(x["ptype"].alias("label"), x["p"].alias("probability")))


def _concepts(lines: F.Column) -> F.Column:
    def of(key, rows):
        surf = F.sort_array(F.transform(rows, lambda x: F.struct(x["ln"].alias("ln"), x["p_name"].alias("n"), x["span"].alias("s"))))
        return F.struct(
            key["value"].alias("concept"), _total(rows, lambda x: x["l_quantity"]).cast("long").alias("freq"),
            _mean(rows, lambda x: x["l_discount"]).alias("relevance_score"), key["type"].alias("type"),
            F.transform(surf, lambda x: F.struct(x["n"].alias("surface_string"), x["s"].alias("span"))).alias("surface"))
    return _in_groups(lines, "concept", of)


def _entities(lines: F.Column) -> F.Column:
    keyed = F.sort_array(F.transform(lines, lambda x: F.struct(x["ln"].alias("k"), F.struct(
        F.array(x["part"]).alias("semantics"),
        F.struct(x["span"].alias("span"), x["p_name"].alias("surface_string")).alias("surface")).alias("v"))))
    return keyed["v"]


def nested_orders(spark, sf_dir: str, single_document: bool = True) -> DataFrame:
    """Analysis rows (schema ``ANALYSIS``) built from lineitem, one per order.

    When the views of ``sf_dir`` are materialised, the nested rows are
    read from there (``analyses.parquet``) instead of being rebuilt.
    """
    folder = stored_folder(sf_dir)
    if folder:
        stored = spark.read.parquet(f"{folder}/analyses.parquet")
        return stored.withColumn("single_document", F.lit(single_document))
    return build_nested_orders(spark, sf_dir, single_document)


def materialize_nested(spark, sf_dir: str, folder: str) -> None:
    build_nested_orders(spark, sf_dir).write.mode("overwrite").parquet(f"{folder}/analyses.parquet")
    FL.stage_analyses(spark.read.parquet(f"{folder}/analyses.parquet"), f"{folder}/staged")


def order_slices(spark, sf_dir: str, single_document: bool = True) -> list[DataFrame]:
    """:func:`nested_orders` in slices of whole orders, to be stored one after the other: the disk then holds the shuffled
    lines of one slice at a time."""
    if stored_folder(sf_dir):
        return [nested_orders(spark, sf_dir, single_document)]
    n = min(MAX_SLICES, 1 + Raw(spark, sf_dir)("lineitem").count() // SLICE_LINES)
    return [build_nested_orders(spark, sf_dir, single_document, (k, n) if n > 1 else None) for k in range(n)]


def build_nested_orders(spark, sf_dir: str, single_document: bool = True, slice_: tuple[int, int] | None = None) -> DataFrame:
    """One shuffle of the lines by order; all else is worked out inside an order."""
    orders = _lines(Raw(spark, sf_dir), slice_).repartition("ok").groupBy("ok").agg(F.collect_list(_line()).alias("lines"))
    texts = orders.select("ok", _in_groups(F.col("lines"), "t", lambda t, rows: F.struct(t.alias("t"), rows.alias("lines"))).alias("texts"))
    mentions = F.transform("texts", lambda x: F.struct(
        x["t"].alias("t"), x["lines"].alias("lines"), _in_groups(x["lines"], "ln", _mentioned).alias("mentions")))
    return texts.select(
        F.col("ok").alias("seq"), F.lit(single_document).alias("single_document"),
        F.transform("texts", lambda x: _categories(x["lines"])).alias("categories"),
        F.transform("texts", lambda x: _concepts(x["lines"])).alias("concepts"),
        F.transform("texts", lambda x: F.struct(_mean(x["lines"], lambda y: y["l_discount"]).alias("sentiment_value"))).alias("sentiment"),
        F.transform(mentions, lambda x: F.struct(
            _entities(x["lines"]).alias("entities"), F.transform(x["mentions"], _evaluation).alias("evaluations"),
            F.concat(F.lit("order "), F.col("ok").cast("string"), F.lit(" text "), x["t"].cast("string")).alias("normalized_text"),
            F.transform(x["mentions"], _relation).alias("relations"))).alias("absa"))


def seq_range(spark, sf_dir: str) -> tuple[int, int]:
    """The least and the largest ``seq`` of :func:`nested_orders`, without shuffling their lines."""
    if stored_folder(sf_dir):
        rows, seq = nested_orders(spark, sf_dir), "seq"
    else:
        rows, seq = _lines(Raw(spark, sf_dir)), "ok"
    return tuple(rows.agg(F.min(seq), F.max(seq)).first())


_BASE = """lines AS (
  SELECT l_orderkey AS ok, l_linenumber AS ln, CAST(FLOOR((l_linenumber - 1) / 3.0) AS INT) AS t,
         lower(p_type) AS ptype, l_discount
  FROM lineitem JOIN part ON l_partkey = p_partkey),
docs AS (SELECT ok, CAST(DENSE_RANK() OVER (ORDER BY ok) - 1 AS BIGINT) AS new_doc FROM (SELECT DISTINCT ok FROM lines) a),
texts AS (SELECT ok, t, CAST(DENSE_RANK() OVER (PARTITION BY ok ORDER BY t) - 1 AS INTEGER) AS new_text
          FROM (SELECT DISTINCT ok, t FROM lines) b),
rels AS (SELECT ok, t, ln, CAST(DENSE_RANK() OVER (PARTITION BY ok, t ORDER BY ln) - 1 AS INTEGER) AS new_rel
         FROM (SELECT DISTINCT ok, t, ln FROM lines) c)"""

_RENUMBER = "JOIN docs d ON v.doc_id = d.ok JOIN texts x ON v.doc_id = x.ok AND v.text_order = x.t"
_RENUMBER_REL = _RENUMBER + " JOIN rels z ON v.doc_id = z.ok AND v.text_order = z.t AND v.{id} = z.ln"


def _flat_sql(view: str, cols: str, rel_id: str | None = None) -> str:
    join = _RENUMBER_REL.format(id=rel_id) if rel_id else _RENUMBER
    return with_views(f"""
, {_BASE}
SELECT d.new_doc AS doc_id, x.new_text AS text_order, {cols} FROM {view} v {join}""", view)


def _flat(name: str):
    def run(spark, sf_dir):
        folder = stored_folder(sf_dir)  # analyses that are staged already are only flattened
        staged = FL.open_staged(spark, f"{folder}/staged") if folder else FL.stage_analyses(order_slices(spark, sf_dir))
        return rounded(TableSet.from_analyses(staged)[name])
    return run


_FLAT = {
    "categories": (None, """v.category, v.probability""", ("FL-04",)),
    "concepts": ("concepts", f"v.concept, v.freq, {r('v.relevance_score')} AS relevance_score, v.concept_type",
                 ("FL-05",)),
    "concepts_surface_strings": ("concepts_surface_strings", "v.concept, v.surface_string, v.text_span",
                                 ("FL-06", "SF-04")),
    "sentiments": (None, "", ("FL-07",)),
    "absa_entities": ("absa_entities", "v.entity_name, v.entity_type, v.surface_string, v.text_span", ("FL-08",)),
    "absa_normalized_texts": ("absa_normalized_texts", "v.normalized_text", ("FL-09",)),
    "absa_relations": ("absa_relations", "z.new_rel AS relation_id, v.opinion_holder, v.restriction, "
                       f"{r('v.sentiment_value')} AS sentiment_value, v.is_external, v.surface_string, v.text_span",
                       ("FL-10", "FL-14")),
    "absa_relations_entities": ("absa_relations_entities", "z.new_rel AS relation_id, v.entity_type, v.entity_name",
                                ("FL-11",)),
    "absa_evaluations": ("absa_evaluations", f"z.new_rel AS evaluation_id, {r('v.sentiment_value')} AS sentiment_value, "
                         "v.surface_string, v.text_span", ("FL-12",)),
    "absa_evaluations_entities": ("absa_evaluations_entities", "z.new_rel AS evaluation_id, v.entity_type, v.entity_name",
                                  ("FL-13",)),
}

for _name, (_view, _cols, _ids) in _FLAT.items():
    if _view is None:
        continue
    _rel = "relation_id" if "relation_id" in _cols else ("evaluation_id" if "evaluation_id" in _cols else None)
    register(f"flatten_{_name}", ids=_ids + ("FL-01", "FL-02", "FL-03", "FL-15", "SC-04"), oracle=_flat_sql(_view, _cols, _rel))(
        _flat(_name))


register("flatten_categories", ids=("FL-04",), oracle=with_views(f"""
, {_BASE}
SELECT d.new_doc AS doc_id, x.new_text AS text_order, l.ptype AS category, {r("l.l_discount")} AS probability
FROM lines l JOIN docs d ON l.ok = d.ok JOIN texts x ON l.ok = x.ok AND l.t = x.t"""))(_flat("categories"))

register("flatten_sentiments", ids=("FL-07",), oracle=with_views(f"""
, {_BASE}
SELECT d.new_doc AS doc_id, x.new_text AS text_order, {r("AVG(l.l_discount)")} AS sentiment_value
FROM lines l JOIN docs d ON l.ok = d.ok JOIN texts x ON l.ok = x.ok AND l.t = x.t
GROUP BY d.new_doc, x.new_text"""))(_flat("sentiments"))


@register("doc_id_assignment", ids=("FL-02", "D25", "W-01"), oracle=with_views(f"""
, {_BASE}
SELECT ok AS seq, CAST(COALESCE(SUM(n) OVER (ORDER BY ok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
  AS doc_base
FROM (SELECT ok, COUNT(DISTINCT t) AS n FROM lines GROUP BY ok) s"""))
def doc_id_assignment(spark, sf_dir):
    """Multi-document mode: every text of an order is its own document."""
    return FL.assign_doc_ids(nested_orders(spark, sf_dir, single_document=False))


@register("flatten_call_sentiments", ids=("FL-16", "FL-07", "D26"), oracle=with_views(f"""
, {_BASE}
SELECT CAST(l.ok + x.new_text AS BIGINT) AS doc_id, 0 AS text_order, {r("AVG(l.l_discount)")} AS sentiment_value
FROM lines l JOIN texts x ON l.ok = x.ok AND l.t = x.t
GROUP BY l.ok, x.new_text"""))
def flatten_call_sentiments(spark, sf_dir):
    """One call's list flattened at a caller-given id (here the order key),
    in multi-document mode: no running counter is involved."""
    analyses = nested_orders(spark, sf_dir)
    return rounded(FL.flatten_call(analyses, "sentiment", doc_base=F.col("seq"))["sentiments"])


def write_json(analyses: DataFrame, path: str, level: str = "DEFAULT_COMPRESSION") -> None:
    """JSON lines, as gzip files of at most 100,000 analyses each (a file is one task when it is read). ``level`` is Hadoop's
    name: ``BEST_SPEED`` packs in a third of the time, into files half as large again."""
    with settings(analyses.sparkSession, DROP_SHUFFLES):
        analyses.write.mode("append").options(compression="gzip", maxRecordsPerFile=100_000, **{"zlib.compress.level": level}).json(path)


def _json_orders(spark, sf_dir: str, single_document: bool = True) -> str:
    """The nested orders as JSON lines; returns their folder."""
    path = scratch_dir(spark, "json-analyses")
    for orders in order_slices(spark, sf_dir, single_document):
        write_json(orders, path)
    return path


_RELATIONS = _FLAT["absa_relations"][1]


@register("json_round_trip", ids=("SC-04", "FL-01", "FL-02", "FL-10"), oracle=_flat_sql("absa_relations", _RELATIONS, "relation_id"))
def json_round_trip(spark, sf_dir):
    """Orders written as JSON lines and read back with ``from_json`` (one scan of the JSON)."""
    return rounded(TableSet.from_json(spark, _json_orders(spark, sf_dir))["absa_relations"])


@register("json_multi_document", ids=("SC-04", "FL-02", "FL-03", "FL-05"), oracle=with_views(f"""
, {_BASE},
starts AS (SELECT ok, CAST(COALESCE(SUM(n) OVER (ORDER BY ok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
           FROM (SELECT ok, COUNT(*) AS n FROM texts GROUP BY ok) n)
SELECT s.s + x.new_text AS doc_id, 0 AS text_order, v.concept, v.freq, {r('v.relevance_score')} AS relevance_score, v.concept_type
FROM concepts v JOIN texts x ON v.doc_id = x.ok AND v.text_order = x.t JOIN starts s ON s.ok = v.doc_id""", "concepts"))
def json_multi_document(spark, sf_dir):
    """Multi-document mode: every text of an order is a document of its own."""
    return rounded(TableSet.from_json(spark, _json_orders(spark, sf_dir, False))["concepts"])


@register("flatten_call_concepts", ids=("FL-16", "FL-05"), oracle=with_views(f"""
, {_BASE}
SELECT v.doc_id, x.new_text AS text_order, v.concept, v.freq, {r('v.relevance_score')} AS relevance_score, v.concept_type
FROM concepts v JOIN texts x ON v.doc_id = x.ok AND v.text_order = x.t""", "concepts"))
def flatten_call_concepts(spark, sf_dir):
    analyses = nested_orders(spark, sf_dir)
    return rounded(FL.flatten_call(analyses, "concepts", doc_base=F.col("seq"), single_document=True)["concepts"])


@register("append_analyses", ids=("FL-15", "FL-02", "SK-01"), oracle=_flat_sql(
    "concepts", f"v.concept, v.freq, {r('v.relevance_score')} AS relevance_score, v.concept_type"))
def append_analyses(spark, sf_dir):
    """The lower half of the orders, then the upper half appended: ids go on where the first batch ended."""
    analyses = nested_orders(spark, sf_dir)
    middle = analyses.agg(F.expr("(min(seq) + max(seq)) div 2")).first()[0]
    sink = TableSink(spark, scratch_dir(spark, "append"))
    sink.append(analyses.filter(F.col("seq") <= middle))
    sink.append(analyses.filter(F.col("seq") > middle))
    return rounded(sink.open()["concepts"])


_CONCEPT_COLS = f"v.concept, v.freq, {r('v.relevance_score')} AS relevance_score, v.concept_type"


def _halves(spark, sf_dir):
    """The orders below and above the middle of their keys."""
    analyses = nested_orders(spark, sf_dir)
    middle = analyses.agg(F.expr("(min(seq) + max(seq)) div 2")).first()[0]
    return analyses.filter(F.col("seq") <= middle), analyses.filter(F.col("seq") > middle)


@register("append_after_write", ids=("FL-15", "SK-01", "SC-05"), oracle=_flat_sql("concepts", _CONCEPT_COLS))
def append_after_write(spark, sf_dir):
    """The lower half written as a set, the upper half appended to it: both are there, ids go on."""
    lower, upper = _halves(spark, sf_dir)
    sink = TableSink(spark, scratch_dir(spark, "append-after-write"))
    sink.write(TableSet.from_analyses(lower))
    sink.append(upper)
    return rounded(TableSet.from_sink(sink)["concepts"])


@register("rewrite_after_append", ids=("FL-15", "SK-01", "SK-03", "SC-05", "PF-09"), oracle=_flat_sql("concepts", _CONCEPT_COLS)
          + " WHERE v.concept NOT IN ('Brand#1', 'Brand#2')")
def rewrite_after_append(spark, sf_dir):
    """Two appended halves, loaded, changed and written back to the same folder."""
    sink = TableSink(spark, scratch_dir(spark, "rewrite-after-append"))
    for half in _halves(spark, sf_dir):
        sink.append(half)
    sink.write(sink.open().remove_concepts(["Brand#1", "Brand#2"]))
    return rounded(sink.open()["concepts"])


@register("backup_of_appended", ids=("SC-02", "SK-03", "FL-15"), oracle=_flat_sql("absa_relations", _RELATIONS, "relation_id"))
def backup_of_appended(spark, sf_dir):
    """Two appended halves, replaced by a set of another table, and read back through the backup's suffix."""
    sink = TableSink(spark, scratch_dir(spark, "backup-of-appended"))
    for half in _halves(spark, sf_dir):
        sink.append(half)
    sink.write({"sentiments": sink.open()["sentiments"]})
    if sink.open().names() != ["sentiments"]:
        raise AssertionError("a table of the earlier set is still there")
    return rounded(TableSet.from_path(spark, sink.path, backup_suffix=sink.backed_up[0].rsplit("_", 1)[-1])["absa_relations"])


@register("presence_by_call", ids=("SC-07", "SC-08", "SK-04"), oracle="""
SELECT 'absa' AS facade, FALSE AS present UNION ALL SELECT 'categories', FALSE
UNION ALL SELECT 'concepts', COUNT(*) > 0 FROM lineitem UNION ALL SELECT 'sentiments', COUNT(*) > 0 FROM lineitem""")
def presence_by_call(spark, sf_dir):
    """Which facades a JSON input of two calls has."""
    path = scratch_dir(spark, "two-calls")
    for orders in order_slices(spark, sf_dir):
        write_json(orders.select("seq", "concepts", "sentiment"), path)
    tables = TableSet.from_json(spark, path)
    there = {facade: any(tables.has(t) for t in names) for facade, names in CALL_TABLES.items()}
    return spark.createDataFrame(sorted(there.items()), "facade string, present boolean")
