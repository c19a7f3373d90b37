"""Plain-Python versions of the contracts, one row at a time."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard(docs):
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    links = []
    for i, s in sets.items():
        for j, k in Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                links.append((i, j))
    named = components(sets, links)
    return {i: (len(s), named[i]) for i, s in sets.items()}


def statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {p for k, w in enumerate(windows) if counts[w] > 1 for p in (k, k + 1, k + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii(text):
    text = text or ""
    out = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]}
    out["ip"] = [
        m.span()
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m.group().split("."))
    ]
    out["card"] = []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"[ -]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    out["phone"] = [
        m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15
    ]
    return out
