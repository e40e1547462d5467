"""The contracts in plain Python, one document or all pairs at a time."""

import re
from hashlib import sha256
from math import comb

NO_ID = 2**63 - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(_UPPER, _UPPER.lower())


def hexed(x):
    return sha256(x.encode()).hexdigest()


def key(doc_id):
    return NO_ID if doc_id is None else doc_id


def repeats(docs, size=13):
    """(doc_id, n_words, n_removed, kept_sha256)"""
    words = [WORD.findall(t or "") for _, t in docs]
    first = {}
    for (d, _), w in zip(docs, words):
        for i in range(len(w) - size + 1):
            k = tuple(w[i : i + size])
            first[k] = min(first.get(k, NO_ID), key(d))
    out = []
    for (d, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < key(d):
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), hexed(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


SECRETS = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def secrets(text):
    """(kind, start, end, value) by start, then kind"""
    found = []
    for kind, p in SECRETS.items():
        for m in p.finditer(text or ""):
            value = m[2] if kind == "assign" else m[0]
            if len(value) >= LEAST[kind]:
                found.append((kind, m.start(), m.end(), value))
    return sorted(found, key=lambda x: (x[1], list(SECRETS).index(x[0])))


def benchmark(docs, items, size=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)"""
    windows = {}
    for item, text in items:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for d, text in docs:
        w = ITEM_WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (of := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= of
        found = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), len(hit), len(found), hexed(",".join(found)), bool(hit)))
    return out


def fingerprint(text):
    from xxhash import xxh64_intdigest

    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxh64_intdigest(" ".join(w[i : i + 3]), seed=42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, linked):
    """The smallest node that each reaches."""
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def near_duplicates(docs, radius=2):
    """(doc_id, fingerprint, component_id)"""
    prints = [fingerprint(t) for _, t in docs]
    least = {}
    for (d, _), p in zip(docs, prints):
        least[p] = min(least.get(p, NO_ID), key(d))
    distinct = sorted(least)
    of = {p: i for i, p in enumerate(distinct)}
    parts = roots(range(len(distinct)), ((i, j) for i, a in enumerate(distinct) for j in range(i) if (a ^ distinct[j]).bit_count() <= radius))
    first = {}
    for p, i in of.items():
        first[parts[i]] = min(first.get(parts[i], NO_ID), least[p])
    back = lambda x: None if x == NO_ID else x
    return [(d, f"{p:016x}", back(first[parts[of[p]]])) for (d, _), p in zip(docs, prints)]


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and lines with a word"""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = {}
    for i in range(len(w) - 4):
        at.setdefault(tuple(w[i : i + 5]), []).append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines)


def base_failed(m):
    return m[0] < 10 or 100 * m[4] > 20 * m[0]


def scores(m):
    over = lambda a, b: a / b if b else 0.0
    return {"symbols": over(m[2], m[0]), "characters": over(m[1], m[0]), "lines": over(m[3], m[5]), "repeats": over(m[4], m[0])}


def at_most(n, k, p):
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def quality(docs, labels, grid, risk, doubt):
    """docs: (doc_id, text, stratum); (doc_id, five measures, base_failed, kept)"""
    said = {}
    for d, q in labels:
        if d is not None and q is not None:
            said[d] = min(said.get(d, 1), q)
    held = {}
    for d, text, s in docs:
        if said.get(d) == 1 and not base_failed(m := measures(text)):
            held.setdefault(s, []).append(scores(m))
    tests = len(held) * sum(map(len, grid.values()))
    cut = {}
    for s, of in held.items():
        for name, xs in grid.items():
            for x in sorted(xs, reverse=True):
                k = sum(o[name] > x for o in of)
                if k < len(of) * risk and at_most(len(of), k, risk) <= doubt / tests:
                    cut[s, name] = x
    out = []
    for d, text, s in docs:
        m = measures(text)
        failed = base_failed(m)
        out.append((d, *m[:5], failed, not failed and not any((s, n) in cut and v > cut[s, n] for n, v in scores(m).items())))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    n = [int(x) for x in digits[::-1]]
    return (sum(n[::2]) + sum(sum(divmod(2 * x, 10)) for x in n[1::2])) % 10 == 0


def personal(text):
    """(kind, start, end) of the base kinds, by kind, then start"""
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def similarity(a, b, size=5):
    a, b = ({x[i : i + size] for i in range(len(x) - size + 1)} for x in (a, b))
    return len(a & b) / len(a | b) if a or b else 0.0
