"""Plain Python versions of what the text operators compute, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def quality_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = Counter(grams)
    covered = {k for i, g in enumerate(grams) if times[g] > 1 for k in range(i, i + 5)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": len(w) < 10 or 100 * len(covered) > 20 * len(w),
    }


def repeated_windows(docs, width=35):
    """{doc index: kept words}, by the windows that start more than once anywhere."""
    split = [words(t) for t in docs]
    starts = defaultdict(list)
    for d, w in enumerate(split):
        for i in range(len(w) - width + 1):
            starts[tuple(w[i : i + width])].append((d, i))
    gone = defaultdict(set)
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + width))
    return [[x for i, x in enumerate(w) if i not in gone[d]] for d, w in enumerate(split)]


def shingles(text):
    w = words(low(text))
    if not w:
        return frozenset()
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)])


def components(ids, texts):
    sets = [shingles(t) for t in texts]
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = top(ids[a]), top(ids[b])
                up[max(x, y)] = min(x, y)
    return [top(i) for i in ids], [len(s) for s in sets]


SECRETS = {
    "assign": (re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}


def secret_base(text):
    found = []
    for no, (kind, (pattern, group, least)) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), no, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pii_base(text):
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, f"email:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, f"ip:{m.start()}:{m.end()}"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            found.append((m.start(), 2, f"card:{m.start()}:{m.end()}"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, f"phone:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def overlap(text, items, width=13):
    """(words, hit words, items) of a text against {item: text}."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    w = word.findall(low(text))
    hit, met = set(), set()
    for item, body in items.items():
        v = word.findall(low(body))
        if not v:
            continue
        n = min(width, len(v))
        windows = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i : i + n]) in windows:
                hit.update(range(i, i + n))
                met.add(str(item))
    return len(w), len(hit), sorted(met)
