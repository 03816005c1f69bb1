"""The operators once more in plain Python over small lists, without any of their methods."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    ws, text = words(text), text or ""
    seen = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    covered = {p for i in range(len(ws) - 2) if seen[tuple(ws[i:i + 3])] > 1
               for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def removed(rows):
    """{position in rows: set of removed word positions} of (doc_id, text) rows."""
    first = {}
    big = float("inf")
    each = [(big if d is None else d, words(t)) for d, t in rows]
    for d, ws in each:
        for i in range(len(ws) - 12):
            g = tuple(ws[i:i + 13])
            first[g] = min(first.get(g, big), d)
    return [{p for i in range(len(ws) - 12) if first[tuple(ws[i:i + 13])] < d
             for p in range(i, i + 13)} for d, ws in each]


def shingles(text):
    ws = words((text or "").translate(LOWER))
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def components(rows):
    """[(n_shingles, component_id)] of (doc_id, text) rows; None for rows without id."""
    sets = [shingles(t) for _, t in rows]
    at = defaultdict(list)
    for k, s in enumerate(sets):
        if rows[k][0] is not None:
            for g in s:
                at[g].append(k)
    shared = Counter((a, b) for ks in at.values() for i, b in enumerate(ks) for a in ks[:i])
    parent = list(range(len(rows)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            parent[top(a)] = top(b)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[top(k)] = min(least.get(top(k), d), d)
    return [(len(sets[k]), least.get(top(k)) if d is not None else None)
            for k, (d, _) in enumerate(rows)]


SECRETS = [
    ("assign", re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                          r"([A-Za-z0-9+/_.=-]+)"), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def _joined(found):
    text = ",".join(f"{n}:{s}:{e}" for s, _, n, e in sorted(found))
    return text, hashlib.sha256(text.encode()).hexdigest()


def secrets(text):
    """base spans as text, and its SHA-256"""
    return _joined([(m.start(), k, n, m.end()) for k, (n, p, g, least) in enumerate(SECRETS)
                    for m in p.finditer(text or "") if len(m.group(g)) >= least])


PERSONAL = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def _passes(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def personal(text):
    return _joined([(m.start(), k, n, m.end()) for k, (n, p) in enumerate(PERSONAL)
                    for m in p.finditer(text or "") if _passes(n, m.group())])


def targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    """{source: target} by sharing again and again what sources above their cap leave over."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total = share * sum(sizes.values())
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(epochs * sizes[s] for s in capped)
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > epochs * sizes[s]]
        if not over:
            return {s: epochs * sizes[s] if s in capped else level * weight[s] for s in order}
        capped.update(over)


def overlaps(text, item, window=13, least=11):
    """Whether some window of both texts, on any diagonal, has so many equal words."""
    a, b = ([w for w in re.split(r"[\W_]+", (t or "").lower()) if w] for t in (text, item))
    return any(sum(a[i + k] == b[j + k] for k in range(window)) >= least
               for i in range(len(a) - window + 1) for j in range(len(b) - window + 1))
