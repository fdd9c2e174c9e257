"""Plain Python versions of the operators, for small fixtures."""

import re
import zlib
from collections import defaultdict

WHITE_WORD = re.compile("[^\x20\x09-\x0d]+")
LETTER_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())


def words(text, pattern=WHITE_WORD):
    return pattern.findall((text or "").translate(LOWER))


def components(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def shingles(text):
    w = words(text)
    if len(w) < 4:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(zip(w, w[1:], w[2:], w[3:], strict=False))


def near_copies(texts):
    sets = {k: shingles(t) for k, t in texts.items()}
    holders = defaultdict(list)
    links = set()
    for k, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for other in holders[x]:
                common[other] += 1
            holders[x].append(k)
        for other, n in common.items():
            if 100 * n >= 85 * (len(s) + len(sets[other]) - n):
                links.add((other, k))
    return {k: len(s) for k, s in sets.items()}, components(texts, links)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    found = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append(f"{kind}:{m.start()}:{m.end()}")
    return found


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n
