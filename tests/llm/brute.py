"""Plain row-at-a-time versions of what the operators must return."""

import hashlib
import itertools
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), failed


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def digest(found, key):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(found, key=key))


def personal(text):
    text = text or ""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    found = [(k, m.start(), m.end()) for k, (p, holds) in kinds.items() for m in re.finditer(p, text) if holds(m[0])]
    order = list(kinds)
    return [sum(f[0] == k for f in found) for k in order], found, sha(digest(found, lambda f: (order.index(f[0]), f[1])))


def secrets(text):
    text = text or ""
    kinds = {
        "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    }
    found = [(k, m.start(), m.end()) for k, (p, holds) in kinds.items() for m in re.finditer(p, text) if holds(m)]
    order = list(kinds)
    return [sum(f[0] == k for f in found) for k in order], found, sha(digest(found, lambda f: (f[1], order.index(f[0]))))


def shingles(text, width=4):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()


def near(rows, width=4, percent=80):
    """rows: (doc_id, text); doc_id -> (shingles, component)."""
    sets = {d: shingles(t, width) for d, t in rows}
    above = {d: d for d in sets}

    def top(d):
        while above[d] != d:
            d = above[d]
        return d

    by = {}
    for d, own in sets.items():
        for s in own:
            by.setdefault(s, []).append(d)
    pairs = {p for ds in by.values() for p in itertools.combinations(sorted(ds), 2)}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = top(a), top(b)
            above[max(x, y)] = min(x, y)
    return {d: (len(own), top(d)) for d, own in sets.items()}


def repeats(rows, size=100):
    """rows: (doc_id, text); doc_id -> (bytes, removed, spans, sha of what is left)."""
    seen, out = set(), {}
    for d, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1):
            window = raw[i : i + size]
            if window in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(window)
        runs = [k for k, _ in itertools.groupby(gone)]
        out[d] = len(raw), sum(gone), sum(runs), sha(bytes(b for b, g in zip(raw, gone) if not g))
    return out
