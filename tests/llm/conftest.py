import random

import pytest

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, row string, kept string, key long, `a.b` int, __id int"


def prose(rng, n, words=400, punctuation=True):
    out = []
    for i in range(n):
        w = "w" + str(int(rng.random() ** 2 * words))
        out.append(w.upper() if punctuation and rng.random() < 0.1 else w)
    text = " ".join(out)
    return text.replace(" w1 ", ". w1 ").replace(" w2 ", ",\nw2 ") if punctuation else text


@pytest.fixture(scope="session")
def corpus():
    """Small documents with copies, near copies, shared passages, repeated lines, nulls, empty and one long text."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(5, 160)) for _ in range(60)]
    passage = prose(rng, 40, punctuation=False)
    line = "A common line that MANY documents hold"
    texts += [texts[3]] * 4 + [texts[7].upper()]
    for i in range(8):
        words = texts[10].split(" ")
        words[rng.randrange(len(words))] = f"changed{i}"
        texts.append(" ".join(words))
    texts += [f"{prose(rng, 30)}\n{line}\n{passage} {prose(rng, 20)}" for _ in range(12)]
    texts += [f"  {line.lower()}\t\n{line}\nshort\nshort", "\n\n\n", "", " ", "one", "one two three", "one two three", None, None,
              "a " * 60, "a " * 61, "é ü 安 全 😀 " * 8, "\x00\x0b\x0c a\tb", prose(rng, 6000) + passage, "x" * 5000, "1.2.3.4 " * 20]
    return list(enumerate(texts))


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with more columns, some with names that the operators use inside."""
    def make(rows):
        full = [(d, t, "en", "s", None if t is None else len(t), f"row{i}", None, i, i, i) for i, (d, t) in enumerate(rows)]
        return spark.createDataFrame(full, EXTRA).repartition(3)

    return make


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
