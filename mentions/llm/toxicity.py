"""Operator 4, toxicity by a weighted finite-state pattern grammar.

Word classes. *Insults* are word stems learnt from labelled documents: prefixes
and whole words that are much more frequent in toxic text, each with its
log-odds as weight. *Threats*, *targets*, *negations* and *reported speech*
are cue words (fixed lists below).

Grammar. Five small transducers read the classes of a clause's words:

* insult: adds the stem's weight;
* threat: a threat cue opens a threat;
* target: a target cue aims the clause;
* negation: a cue negates the ``NEGATION_REACH`` class words that follow;
* reported speech: a cue marks the rest of the clause as quoted.

Their composition is one transition table over (threat, target, negation
left, reported) with, for each class, the next state. A clause ends at
punctuation, a line break or the text's end and is settled there: its insults
go to the channel that its last state names, plain, aimed, threatening, negated
or reported, so cues before and after an insult count alike (but a negation
reaches forward only). A clause with threat and target is a match of its own,
with or without an insult: a menace, negated if all of its threats are, or
quoted. So a clause is scored, not a lone word, and what a negation, a report
or a threat is worth is learnt.

Score. A document's channels (how many matches, how much weight, per word; how
many menaces of each kind) go through a logistic model fitted on the labelled
rows. Nothing but the text enters a score.

Labels. Rows are used if ``crc32`` of the id's text modulo 4 is not 2, and of
these at most ``MAX_TRAIN`` (those of smallest hash), a documented bound on rows,
however many share an id. Every document is scored, whole.

Edge cases: null or empty texts match nothing and get the score of such a
document. Labels that are null, or of ids without a document, are ignored;
repeated label rows count once, as toxic if any is; rows with equal id and text
are learnt from once. With no usable label of
both kinds every score is the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentions.llm.common import batches, id_text, row_texts, stored, whole_rows, worker_cache

THRESHOLD = 0.3
MAX_TRAIN = 20_000
HELD_OUT_FOLD, FOLDS = 2, 4
NEGATION_REACH = 3
MIN_DOCS = 4
MIN_WEIGHT = 1.5
MIN_SURPRISE = 8.0
STEM_LENGTHS = range(3, 9)
BATCH_BYTES = 4 << 20
CACHE_WORDS = 200_000
#: Stems that a task counts before it sends them on.
HELD_STEMS = 100_000

# Cue words of the four languages.
THREATS = "kill hurt destroy burn hang shoot beat crush die umbringen töten zerstören verbrennen tuer brûler frapper détruire mourir matar quemar golpear destruir morir"
TARGETS = "you your yours yourself du dich dir dein deine euch ihr tu te toi ton ta vous votre usted ustedes ti tú tus"
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie niemals ne pas jamais aucun no nunca jamás ningún"
REPORTS = "said says quoted reported wrote claimed sagte sagt schrieb zitierte dit disait écrit rapporte dijo dice escribió citó"

THREAT, TARGET, NEGATION, REPORT, INSULT = 1, 2, 3, 4, 5
CHANNELS = ("plain", "aimed", "threatening", "negated", "reported")
MENACES = ("menace", "negated menace", "quoted menace")
WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
FEATURES = 2 * len(CHANNELS) + 4 + len(MENACES)
#: (threat, target, negation words left, reported)
STATES = [(h, t, n, r) for h in (0, 1) for t in (0, 1) for n in range(NEGATION_REACH + 1) for r in (0, 1)]


def cue_classes() -> dict[str, int]:
    out: dict[str, int] = {}
    for kind, text in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS)):
        for word in text.split():
            out.setdefault(word, kind)
    return out


def compose() -> tuple[list[list[int]], list[int]]:
    """The composed transducer: ``(next state by state and class, channel of an insult by state)``."""
    number = {s: i for i, s in enumerate(STATES)}
    table, channel = [], []
    for h, t, n, r in STATES:
        less = max(0, n - 1)
        table.append([0, number[1, t, less, r], number[h, 1, n, r], number[h, t, NEGATION_REACH, r], number[h, t, n, 1],
                      number[h, t, less, r]])
        channel.append(4 if r else 3 if n else 2 if h else 1 if t else 0)
    return table, channel


class Grammar:
    """Classes of words and the composed transducer, for one worker."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.cues = cue_classes()
        self.next, self.channel = compose()
        # by the state at an insult and at the clause's end: the insult's channel
        number = {s: i for i, s in enumerate(STATES)}
        self.settled = [[self.channel[number[h, t, n, r]] for h, t, _, r in STATES] for _, _, n, _ in STATES]
        self.cache: dict[str, tuple[int, float] | None] = {"\n": (0, 0.0), **{c: (0, 0.0) for c in ".!?;:"}}
        self.fixed = dict(self.cache)

    def class_of(self, word: str) -> tuple[int, float] | None:
        """(class, weight): an insult if a stem matches, else a cue; None if the word has no class."""
        best = max([self.stems.get("^" + word[:n], 0.0) for n in STEM_LENGTHS if n <= len(word)]
                   + [self.stems.get("^" + word + "$", 0.0)])
        if best > 0:
            return INSULT, best
        kind = self.cues.get(word)
        return None if kind is None else (kind, 0.0)

    def features(self, text: str) -> list[float]:
        """Matches and weight by channel, the heaviest clause, weight per word, the length, and menaces by kind."""
        words = WORDS.findall(text.lower())
        cache = self.cache
        new = [w for w in set(words) if w not in cache]
        if new:
            if len(cache) + len(new) > CACHE_WORDS:
                cache.clear()
                cache.update(self.fixed)
                new = set(words) - cache.keys()
            cache.update((w, self.class_of(w)) for w in new)
        hits, weight, menaces = [0.0] * len(CHANNELS), [0.0] * len(CHANNELS), [0.0] * len(MENACES)
        state, insults, meant, top = 0, [], False, 0.0
        for kind, w in chain(filter(None, map(cache.get, words)), ((0, 0.0),)):
            if kind == 0:
                threat, target, _, reported = STATES[state]
                if threat and target:
                    menaces[2 if reported else 0 if meant else 1] += 1
                if insults:
                    for at, x in insults:
                        c = self.settled[at][state]
                        hits[c] += 1
                        weight[c] += x
                    top = max(top, sum(x for _, x in insults))
                    insults = []
                state, meant = 0, False
                continue
            if kind == INSULT:
                insults.append((state, w))
            elif kind == THREAT and not STATES[state][2]:
                meant = True
            state = self.next[state][kind]
        n = len(words)
        total = sum(weight)
        return [np.log1p(x) for x in hits] + [np.log1p(x) for x in weight] + [
            top / 10, 100 * total / (n + 20), 10 * sum(hits) / (n + 20) ** 0.5, np.log1p(n) / 10] + [np.log1p(x) for x in menaces]


def held_out(id_col: F.Column) -> F.Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``text, toxic`` of at most ``max_train`` labelled rows outside the held-out fold.

    Ids are chosen by hash first, so that few rows are stored, then rows; equal rows count once.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    marks = marks.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(texts.join(F.broadcast(ids), "doc_id").withColumn("key", F.md5(F.col("text").cast("binary"))), "toxic-labelled")
    keys = rows.select("doc_id", "key").distinct()
    some = keys.orderBy(F.xxhash64("doc_id", "key"), "doc_id", "key").limit(max_train)  # the documented bound
    return rows.join(F.broadcast(some), ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]).select("text", "toxic")


def stem_counts(train: DataFrame) -> DataFrame:
    """``stem, bad, good, bad_docs, good_docs``: tokens and documents of each prefix and whole word by label."""
    def run(source):
        tokens, docs = (Counter(), Counter()), (Counter(), Counter())

        def rows():
            keys = list(tokens[0].keys() | tokens[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string())] + [pa.array([c.get(k, 0) for k in keys], pa.int64())
                                                 for c in (tokens[1], tokens[0], docs[1], docs[0])],
                names=["stem", "bad", "good", "bad_docs", "good_docs"])
            for c in (*tokens, *docs):
                c.clear()
            return out

        for batch in batches(source, BATCH_BYTES):
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                own = Counter(w for w in WORDS.findall((text or "").lower()) if w[0].isalpha())
                stems: Counter = Counter()
                for w, c in own.items():
                    stems["^" + w + "$"] += c
                    for n in STEM_LENGTHS:
                        if n < len(w):
                            stems["^" + w[:n]] += c
                side = int(toxic > 0)
                tokens[side].update(stems)
                docs[side].update(stems.keys())
                if len(tokens[0]) + len(tokens[1]) > HELD_STEMS:
                    yield rows()
        yield rows()

    sums = [F.sum(c).alias(c) for c in ("bad", "good", "bad_docs", "good_docs")]
    return train.mapInArrow(run, "stem string, bad long, good long, bad_docs long, good_docs long").groupBy("stem").agg(*sums)


def learn_stems(train: DataFrame, max_stems: int | None = None) -> dict[str, float]:
    """All stems that tell enough, with their log-odds weights (with ``max_stems``, those that tell most)."""
    counts = stored(stem_counts(train), "stems")
    whole = counts.where(F.col("stem").endswith("$")).agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).first()
    share = train.agg(F.avg((F.col("toxic") > 0).cast("double")).alias("s")).first().s
    if not whole.bad or not whole.good:
        return {}
    odds = F.log((F.col("bad") + 0.5) / F.lit(whole.bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(whole.good + 1.0))
    # how surprising so many toxic documents are, if the stem had nothing to do with the label (a Poisson tail bound);
    # documents rather than tokens, so that one long document doesn't make a stem
    expected = (F.col("bad_docs") + F.col("good_docs")) * F.lit(share)
    surprise = F.col("bad_docs") * F.log(F.col("bad_docs") / expected) - F.col("bad_docs") + expected
    rated = counts.where(F.col("bad_docs") >= MIN_DOCS).select("stem", odds.alias("weight"), surprise.alias("surprise"),
                                                               (F.col("bad_docs") > expected).alias("more"))
    rated = rated.where(F.col("more") & (F.col("weight") > MIN_WEIGHT) & (F.col("surprise") > MIN_SURPRISE))
    rated = rated if max_stems is None else rated.orderBy(F.desc("surprise"), "stem").limit(max_stems)
    return {r.stem: float(r.weight) for r in rated.collect()}  # bounded by the training rows


def _grammar(stems: dict[str, float]) -> Grammar:
    name = f"grammar {hash(tuple(sorted(stems.items())))}"
    return worker_cache(name, lambda: Grammar(stems))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(mean, scale, coefficients)`` of a ridge logistic regression by Newton steps (the last one is the intercept)."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    keep = np.full(z.shape[1], ridge)
    keep[-1] = 1e-6
    beta = np.zeros(z.shape[1])

    def loss(b):
        m = z @ b
        return np.logaddexp(0, m).sum() - y @ m + 0.5 * (keep * b * b).sum()

    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (p - y) + keep * beta
        move = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(keep), gradient)
        size, now = 1.0, loss(beta)
        while size > 1e-4 and loss(beta - size * move) > now:
            size /= 2
        beta = beta - size * move
        if np.abs(size * move).max() < 1e-6:
            break
    return mean, scale, beta


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_stems: int | None = None) -> dict:
    """The model: stems and logistic coefficients. ``docs`` has ``doc_id`` and ``text``."""
    train = stored(training_rows(docs, labels, max_train), "toxic-train")
    stems = learn_stems(train, max_stems)

    def run(source):
        grammar = _grammar(stems)
        for batch in batches(source, BATCH_BYTES):
            rows = [grammar.features(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch["toxic"]], names=["x", "toxic"])

    rows = train.mapInArrow(run, "x array<double>, toxic int").collect()  # max_train short rows
    x, y = np.array([r.x for r in rows]).reshape(-1, FEATURES), np.array([float(r.toxic > 0) for r in rows])
    if len(set(y)) < 2:
        share = float(y.mean()) if len(y) else 0.0
        return {"stems": {}, "mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "beta": None, "share": share}
    # rows are collected in any order; sort them so that sums are the same each time
    order = np.lexsort(np.column_stack([x, y]).T)
    mean, scale, beta = fit_logistic(x[order], y[order])
    # features beyond those of the training rows count as the nearest of them
    return {"stems": stems, "mean": mean, "scale": scale, "beta": beta, "share": float(y.mean()), "low": x.min(axis=0), "high": x.max(axis=0)}


def score_rows(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, score`` for every input row (map-only)."""
    base = whole_rows(docs, id_col)
    schema = base.select("doc_id", "row", F.lit(0.0).alias("score")).schema

    def run(source):
        grammar = _grammar(model["stems"])
        for batch in batches(source, BATCH_BYTES):
            if model["beta"] is None:
                scores = list(repeat(model["share"], batch.num_rows))
            else:
                x = np.array([grammar.features(t or "") for t in row_texts(batch, text_col).to_pylist()])
                x = np.clip(x, model["low"], model["high"])
                z = np.hstack([(x - model["mean"]) / model["scale"], np.ones((len(x), 1))]) @ model["beta"]
                scores = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], pa.array(scores, pa.float64())],
                                             names=["doc_id", "row", "score"])

    return base.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
             **options) -> DataFrame:
    """Fit on the labels and score every row: ``doc_id, row, held_out, score, predicted``."""
    model = fit(id_text(docs, id_col, text_col), labels, **options)
    found = score_rows(docs, model, id_col, text_col)
    return found.select("doc_id", "row", held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
               **options) -> DataFrame:
    """The documents, with all their columns, that are not predicted toxic."""
    return toxicity(docs, labels, threshold, id_col, text_col, **options).where("predicted = 0").select("row.*")
