"""Plain single-process versions of the corpus operators, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def shingles(text):
    w = words((text or "").translate(_LOWER))
    if len(w) >= 5:
        return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def jaccard_components(rows):
    """{doc_id: (set size, least id reachable by links of 0.8 or more)}"""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeated_bytes(texts, size):
    """For each text its bytes and which of them lie in a string of ``size`` bytes that starts elsewhere too."""
    raw = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for b in raw:
        for p in range(len(b) - size + 1):
            seen[b[p : p + size]] += 1
    out = []
    for b in raw:
        drop = np.zeros(len(b), bool)
        for p in range(len(b) - size + 1):
            if seen[b[p : p + size]] > 1:
                drop[p : p + size] = True
        out.append((b, drop))
    return out


def byte_report(rows, size):
    out = []
    for (i, _), (b, drop) in zip(rows, repeated_bytes([t for _, t in rows], size)):
        runs = int((np.diff(np.r_[0, drop.astype(int)]) == 1).sum())
        out.append((i, len(b), int(drop.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~drop].tobytes()).hexdigest()))
    return out


def window_report(rows, size):
    """Words left after those in a window that also starts in a document with a smaller id are gone (null: largest)."""
    rank = lambda i: (1 << 62) if i is None else i
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            first[key] = min(first.get(key, 1 << 62), rank(i))
    out = []
    for i, t in rows:
        w = words(t)
        drop = np.zeros(len(w), bool)
        for p in range(len(w) - size + 1):
            if first[tuple(w[p : p + size])] < rank(i):
                drop[p : p + size] = True
        kept = " ".join(x for x, d in zip(w, drop) if not d)
        out.append((i, len(w), int(drop.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return out


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c) * (k % 2 + 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal_data(text):
    def valid(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            return 16 <= len(digits) <= 19 and luhn(digits)
        return kind != "phone" or 8 <= len(digits) <= 15

    return [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if valid(k, m[0])] for k, p in PII]


def edited(text, following):
    n = len(text)
    return text[: n - n // 2] + following[: n // 2]


def divergence(rows, min_df, top):
    """Rows (lang, source, part, item, value, rank) from (text, lang, source) rows."""
    rows = [tuple(x or "" for x in r) for r in rows]
    found = lambda text: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(_LOWER))
    out = []
    for lang in {r[1] for r in rows}:
        own = [(found(t), s) for t, at, s in rows if at == lang]
        in_docs, by_source = defaultdict(int), defaultdict(lambda: defaultdict(int))
        for words_, s in own:
            by_source[s]  # noqa: B018
            for w in set(words_):
                in_docs[w] += 1
            for w in words_:
                by_source[s][w] += 1
        kept = [w for w, n in in_docs.items() if n >= min_df]

        def rates(n):
            total = sum(n.get(w, 0) for w in kept)
            return {w: 1 + 10**9 * (n.get(w, 0) + 5) // (total + 5 * len(kept)) for w in kept}

        q = rates({w: sum(n.get(w, 0) for n in by_source.values()) for w in kept})
        p = {s: rates(n) for s, n in by_source.items()}
        for s in by_source:
            pairs = sorted((-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode(), o) for o in by_source if o != s)
            above = sorted((q[w] - p[s][w], w.encode(), w) for w in kept if by_source[s].get(w, 0) and p[s][w] > q[w])[:top]
            for part, listed in (("pair", pairs), ("term", above)):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item) in enumerate(listed)]
    return out


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def spelling(rows):
    """{word: (form, root, n, n_near, form_n)} from (doc_id, text) rows."""
    n = defaultdict(int)
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run if h % 199 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def rule_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    seen = defaultdict(list)
    for k in range(len(w) - 4):
        seen[tuple(w[k : k + 5])].append(k)
    repeated = {k + j for places in seen.values() if len(places) > 1 for k in places for j in range(5)}
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed
