"""Plain Python versions of the operators, for tests: direct readings of what each result means."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD1 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD7 = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def op1(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        ws = WORD1.findall((text or "").translate(UPPER))
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            windows[tuple(ws[i:i + n])].add("null" if item is None else str(item))
    sizes = sorted({len(w) for w in windows})
    out = []
    for doc, text in docs:
        ws = WORD1.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                w = tuple(ws[i:i + n])
                if w in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        out.append((doc, len(ws), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


PII = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
       ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def op2(docs):
    out = []
    for doc, text in docs:
        spans = []
        for k, (kind, pattern) in enumerate(PII):
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m.group())
                ok = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                      "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
                if ok:
                    spans.append((m.start(), k, m.end(), kind))
        spans.sort()
        n = Counter(s[3] for s in spans)
        base = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        out.append((doc, n["email"], n["ip"], n["card"], n["phone"], sha(base), base))
    return out


def op3(docs, tokenizer, end=1):
    out, start = [], 0
    for doc, text in sorted(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out


def groups(nodes, links):
    up = {x: x for x in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in nodes}


def op7(docs, window=13):
    """docs: (id, text), ids distinct and not null."""
    words = {d: WORD7.findall(t or "") for d, t in docs}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][i:i + window]), d)
    out = []
    for d, ws in words.items():
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(ws), len(gone), sha(" ".join(w for i, w in enumerate(ws) if i not in gone))))
    return out


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)


def op8(docs, least=10):
    """docs: (id, text); a null id is the largest."""
    big = float("inf")
    owner = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            k = line_key(line)
            if len(k) >= least:
                owner[k] = min(owner.get(k, big), big if d is None else d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if owner.get(line_key(x), big) >= (big if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def shingles(text, k=5):
    ws = WORD1.findall((text or "").translate(UPPER))
    if not ws:
        return Counter()
    return Counter(tuple(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1)))


def jp(x, y):
    """Probability Jaccard similarity of two weighted sets."""
    keys = set(x) | set(y)
    total = 0.0
    for i in x:
        if i in y:
            total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys)
    return total


def op6(docs, similarity=0.8):
    """docs: (id, text), ids distinct: (id, smallest id of equal words, component, kept)."""
    sets = {d: shingles(t) for d, t in docs}
    words = {d: tuple(WORD1.findall((t or "").translate(UPPER))) for d, t in docs}
    same = {}
    for d in sorted(words):
        if words[d]:
            same.setdefault(words[d], d)
    holders = defaultdict(list)
    for d in sorted(set(same.values())):
        for s in sets[d]:
            holders[s].append(d)
    shared = Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), n in shared.items()
             if n >= 0.5 * min(len(sets[a]), len(sets[b])) and jp(sets[a], sets[b]) >= similarity]
    reps = {d: same.get(words[d], d) for d in sets}
    comp = groups(set(reps.values()), links)
    return [(d, reps[d], comp[reps[d]], comp[reps[d]] == d) for d in sets]


def op10(docs, limit):
    """docs: (id, text): (id, shard) by extendible hashing, row by row splits."""
    def bits(d, t):
        body = "\n".join(x for x in (None if d is None else str(d), t) if x is not None)
        return format(int(hashlib.md5(body.encode()).hexdigest()[:15], 16), "060b")

    rows = [(d, t, bits(d, t)) for d, t in docs]

    def split(rows, depth):
        size = sum(len((t or "").encode()) for _, t, _ in rows)
        if size <= limit or len({b for *_, b in rows}) == 1:
            return [(d, b[:depth] or "*", size > limit) for d, _, b in rows]
        return [x for bit in "01" for x in split([r for r in rows if r[2][depth] == bit], depth + 1)]

    return split(rows, 0) if rows else []
