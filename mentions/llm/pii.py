"""Operator 2, information-theoretic sanitisation (DataFrame functions only).

*Base* spans are personal data found by pattern: e-mail, IP, card and phone.
These are the protected entities. *Method* spans are terms that reveal them.
With documents as events,

    IC(e) = -log2 p(e)                      what knowing the entity is worth
    PMI(e; t) = log2 p(e, t) / (p(e) p(t))  what the term tells of it
    disclosure(e; t) = PMI(e; t) / IC(e)    1: the term gives the entity away

All words of a document, outside its base spans, count as occurring with its
entities. A term is removed where its disclosure of any entity is ``REMOVE`` or
more, and generalised (its kind's name stays) from ``GENERALISE`` on: wherever
it stands, in documents that don't print the entity as well. It needs
``MIN_CONTEXTS`` different texts with the entity, so copies of one text prove
nothing.

Positions come without Python: the pieces between matches (``split``) and the
matches (``regexp_extract_all``) alternate, so a running sum of their lengths
gives code-point offsets. Patterns are possessive and begin where a run
begins, so that long runs are read once.

What moves is entities, counts of (entity, term) and document frequencies, all
combined map-side. Lists of at most ``SMALL`` rows are broadcast; the texts of
documents with revealing terms move only if there are more of them.

Edge cases: a null text is empty and has no spans. Rows equal in id and text
get equal results. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import stored

# What each kind's pattern matches (possessive forms of the stated patterns; a match that starts inside
# a run is only looked for where the last match ended).
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = (EMAIL, IP, CARD, PHONE)
TERM = r"(?<![\p{L}\p{M}])[\p{L}\p{M}]{3,40}+(?![\p{L}\p{M}])"

MIN_CONTEXTS = 3
#: Rows of a list that is broadcast; longer ones are joined by a shuffle.
SMALL = 100_000
GENERALISE = 0.8
REMOVE = 0.95
SPAN = "struct<start:int,end:int,value:string>"


def matches(text: F.Column, pattern: str, quick: F.Column, keep=None) -> F.Column:
    """Array of (start, end, value) of the pattern's matches; ``quick`` is false only where there is none.

    ``keep`` tells from a match's value whether it is wanted.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(held, pair):
        start = held["at"] + F.length(pair["p"])
        end = start + F.length(pair["v"])
        more = F.concat(held["out"], F.array(F.struct(start.alias("start"), end.alias("end"), pair["v"].alias("value"))))
        return F.struct(end.alias("at"), (more if keep is None else F.when(keep(pair["v"]), more).otherwise(held["out"])).alias("out"))

    # the piece after the last match has no match of its own
    pairs = F.filter(F.arrays_zip(between.alias("p"), found.alias("v")), lambda x: x["v"].isNotNull())
    return F.when(quick, F.aggregate(pairs, begin, step, lambda held: held["out"])).otherwise(F.array().cast(f"array<{SPAN}>"))


def _luhn(digits: F.Column) -> F.Column:
    def worth(i):
        d = F.substring(digits, i, 1).cast("int")
        twice = (F.length(digits) - i) % 2 == 1
        return F.when(twice & (d > 4), 2 * d - 9).when(twice, 2 * d).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda t, i: t + worth(i)) % 10 == 0


def _is_ip(value: F.Column) -> F.Column:
    return F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255)


def _is_card(value: F.Column) -> F.Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)


def _is_phone(value: F.Column) -> F.Column:
    return F.length(F.regexp_replace(value, "[^0-9]", "")).between(10, 15)


def base_spans(text: F.Column) -> F.Column:
    """Array of (start, kind number, end, value), by start, then kind."""
    digits = text.rlike("[0-9]")
    checks = (lambda v: F.lit(True), _is_ip, _is_card, _is_phone)
    quick = (F.contains(text, F.lit("@")), digits & F.contains(text, F.lit(".")), digits, F.contains(text, F.lit("+")))
    kinds = []
    for k, (pattern, check, fast) in enumerate(zip(PATTERNS, checks, quick, strict=True)):
        kinds.append(_of_kind(matches(text, pattern, fast), k, check))
    return F.array_sort(F.concat(*kinds))


def _of_kind(found: F.Column, kind: int, check) -> F.Column:
    """The matches that pass ``check``, as spans of the kind."""
    return F.transform(F.filter(found, lambda s: check(s["value"])), lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))


def _named(kind: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(k) for k in (*KINDS, "term")]), kind + 1)


def joined(spans: F.Column) -> F.Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", _named(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(spans: F.Column, kind: int) -> F.Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def outside(text: F.Column, base: F.Column) -> F.Column:
    """The text with spaces in place of its base spans, so that positions stay."""
    def step(held, s):
        begin, end = F.greatest(held["at"], s["start"]), F.greatest(held["at"], s["end"])
        return F.struct(end.alias("at"), F.concat(held["out"], F.substring(text, held["at"] + 1, begin - held["at"]),
                                                  F.repeat(F.lit(" "), end - begin)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.when(F.size(base) == 0, text).otherwise(F.aggregate(base, start, step, lambda held: F.concat(
        held["out"], F.substring(text, held["at"] + 1, F.length(text)))))


def words(rest: F.Column) -> F.Column:
    """The different terms of a text without its base spans."""
    return F.array_distinct(F.transform(F.regexp_extract_all(rest, F.lit(TERM), F.lit(0)), F.lower))


def _listed(df: DataFrame) -> DataFrame:
    """A stored list for joins: broadcast if it is small."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def _own_entities(base: F.Column) -> F.Column:
    return F.array_distinct(F.transform(base, lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"))))


def disclosures(found: DataFrame, spans: DataFrame, least: float, min_contexts: int = MIN_CONTEXTS) -> DataFrame:
    """``kind, value, term, disclosure`` of at least ``least``, of terms in enough different texts with an entity.

    ``found`` has each row's ``version``, ``rest`` (text without base spans) and ``base``; ``spans`` is stored and has
    ``version`` and ``base``.
    """
    total = F.lit(spans.count())
    own = spans.select("version", F.explode(_own_entities(F.col("base"))).alias("e")).groupBy("e.kind", "e.value", "version").count()
    often = stored(own.groupBy("kind", "value").agg(F.sum("count").alias("entity_docs"), F.count("*").alias("texts")).where(
        F.col("texts") >= min_contexts).drop("texts"), "pii-entities")
    pair = ["kind", "value", "term"]
    told = found.where(F.size("base") > 0)
    told = told.select("version", words(F.col("rest")).alias("words"), F.explode(_own_entities(F.col("base"))).alias("e"))
    told = told.select("version", "words", "e.kind", "e.value")
    few = often.limit(SMALL + 1).count() <= SMALL
    if few:  # else too many to send around: the counts below tell
        told = told.join(F.broadcast(often.select("kind", "value")), ["kind", "value"], "left_semi")
    told = told.select("version", "kind", "value", F.explode("words").alias("term"))
    joint = told.groupBy(*pair).agg(F.count("*").alias("both")).where(F.col("both") >= min_contexts)
    terms = found.select(F.explode(words(F.col("rest"))).alias("term")).groupBy("term").agg(F.count("*").alias("term_docs"))
    rated = joint.join(_listed(often), ["kind", "value"]).join(terms.where(F.col("term_docs") >= min_contexts), "term")
    content = F.log2(total / F.col("entity_docs"))
    pmi = F.log2(F.col("both") * total / (F.col("entity_docs") * F.col("term_docs")))
    rated = rated.select(*pair, F.when(content > 0, pmi / content).otherwise(0.0).alias("disclosure"))
    rated = stored(rated.where(F.col("disclosure") >= least), "pii-rated")
    # different texts are counted for these few pairs only
    seen = told.join(_listed(rated.select(*pair)), pair, "left_semi").groupBy(*pair, "version").count().groupBy(*pair).count()
    return rated.join(seen.where(F.col("count") >= min_contexts).select(*pair), pair, "left_semi")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_contexts: int = MIN_CONTEXTS,
                  generalise: float = GENERALISE) -> DataFrame:
    """Base and method spans of every row.

    Returns one row per input row: ``doc_id``, ``version`` (hash of the text),
    ``base`` and ``spans``, arrays of (start, kind number, end); a term's span
    also says whether it is to be ``removed``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    found = rows.withColumn("base", base_spans(F.col("text")))
    spans = stored(found.select("doc_id", "version", "base"), "pii-spans")
    found = found.select("doc_id", "version", "base", outside(F.col("text"), F.col("base")).alias("rest"))
    told = disclosures(found, spans, generalise, min_contexts)
    told = stored(told.groupBy("term").agg((F.max("disclosure") >= REMOVE).alias("removed")), "pii-told")
    hits = found.select("version", F.explode(words(F.col("rest"))).alias("term")).join(_listed(told), "term")
    hits = stored(hits.groupBy("version").agg(F.collect_set(F.struct("term", "removed")).alias("own")), "pii-hits")
    # the rest again, for positions, of texts that hold such a term
    hits = found.join(_listed(hits), "version")
    place = matches(F.col("rest"), TERM, F.lit(True), lambda v: F.exists("own", lambda o: o["term"] == F.lower(v)))
    hits = hits.select("doc_id", "version", "own", F.explode(place).alias("m"))
    hits = hits.select("doc_id", "version", "m.start", "m.end", F.exists("own", lambda o: o["removed"] & (
        o["term"] == F.lower("m.value"))).alias("removed")).distinct()
    term = F.struct("start", F.lit(len(KINDS)).alias("kind"), "end", "removed")
    more = hits.groupBy("doc_id", "version").agg(F.collect_list(term).alias("terms"))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                                                  F.lit(True).alias("removed")))
    joined_ = spans.alias("l").join(more.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
                                    & (F.col("l.version") == F.col("r.version")), "left")
    every = F.array_sort(F.concat(F.col("own"), F.coalesce("terms", F.expr("slice(own, 1, 0)"))))
    return joined_.select("l.doc_id", "l.version", base.alias("own"), "r.terms").select(
        "doc_id", "version", F.col("own").alias("base"), every.alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, with all their columns, with spans replaced: personal data and generalised terms by
    their kind in brackets, revealing terms by nothing. Overlapping spans are one, of the first one's kind."""
    spans = personal_data(docs, id_col, text_col, **options).select("doc_id", "version", "spans").distinct()
    rows = docs.withColumn("__row", F.struct("*")).select("__row").select(
        "__row", F.col(f"__row.{id_col}").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"__row.{text_col}").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text"))
    found = rows.alias("l").join(spans.alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id"))
                                 & (F.col("l.version") == F.col("r.version")))

    def step(held, s):
        begin = F.greatest(held["at"], s["start"])
        name = F.when((s["kind"] == len(KINDS)) & s["removed"], "").otherwise(F.concat(F.lit("["), _named(s["kind"]), F.lit("]")))
        inside = s["end"] <= held["at"]
        text = F.concat(held["out"], F.substring(F.col("text"), held["at"] + 1, begin - held["at"]),
                        F.when(s["start"] < held["at"], "").otherwise(name))
        return F.struct(F.greatest(held["at"], s["end"]).alias("at"), F.when(inside, held["out"]).otherwise(text).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", start, step, lambda held: F.concat(
        held["out"], F.substring(F.col("text"), held["at"] + 1, F.length("text"))))
    return found.select("__row", clean.alias("__clean")).select(*[
        (F.when(F.col("__row").getField(c).isNotNull(), F.col("__clean")) if c == text_col else F.col("__row").getField(c)).alias(c)
        for c in docs.columns])
