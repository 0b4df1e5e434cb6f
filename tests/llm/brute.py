"""Plain-Python versions of the operators, for small tables."""

import hashlib
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
LETTERED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
TOP = 1 << 63


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def substring_dedup(rows, k=13):
    """rows: (id, text); a null id ranks above all others."""
    docs = [(TOP if i is None else i, SPACED.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        for a in range(len(w) - k + 1):
            key = tuple(w[a:a + k])
            first[key] = min(first.get(key, i), i)
    out = []
    for (i, w), (orig, _) in zip(docs, rows, strict=True):
        gone = set()
        for a in range(len(w) - k + 1):
            if first[tuple(w[a:a + k])] < i:
                gone.update(range(a, a + k))
        out.append((orig, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))))
    return out


def ngram_join(rows, words=5, percent=80):
    sets = []
    for i, t in rows:
        w = SPACED.findall((t or "").translate(LOWER))
        n = min(words, len(w))
        sets.append((TOP if i is None else i, {tuple(w[a:a + n]) for a in range(len(w) - n + 1)} if w else set()))
    least = [i for i, _ in sets]
    changed = True
    while changed:
        changed = False
        for a, (_, x) in enumerate(sets):
            for b, (_, y) in enumerate(sets):
                if a < b and x and y and 100 * len(x & y) >= percent * len(x | y) and least[a] != least[b]:
                    least[a] = least[b] = min(least[a], least[b])
                    changed = True
    return [(o, len(s), None if c == TOP else c) for (o, _), (_, s), c in zip(rows, sets, least, strict=True)]


def decontaminate(docs, items, window=10):
    windows = {}
    for item, t in items:
        w = LETTERED.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for i, t in docs:
        w = LETTERED.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[a:a + n])):
                    hit.update(range(a, a + n))
                    found |= owners
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def viterbi(unit, pieces, byte_base, unknown):
    """Cheapest path over one unit; on ties the later piece is the longer one."""
    esc = unit.replace("▁", "\uffff").replace(" ", "▁")
    table = {p: (i, c) for i, p, c in pieces}
    longest = max(map(len, table))
    best = [(0, None, [])]
    for e in range(1, len(esc) + 1):
        top = None
        for s in range(max(e - longest, 0), e):
            if esc[s:e] in table:
                i, cost = table[esc[s:e]]
                option = (best[s][0] + cost, s, [i])
            elif s == e - 1:
                option = (best[s][0] + unknown, s, [byte_base + b for b in unit[s:e].encode()])
            else:
                continue
            if top is None or option[0] < top[0]:
                top = option
        best.append(top)
    out, e = [], len(esc)
    while e:
        out[:0] = best[e][2]
        e = best[e][1]
    return out
