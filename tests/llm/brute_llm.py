"""Plain versions of the operators, a text or pair at a time."""

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
            "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def words(text):
    return WORD.findall(text or "")


def _ok(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def base_pii(text):
    found = {k: [m.span() for m in re.finditer(p, text or "") if _ok(k, m[0])] for k, p in PATTERNS.items()}
    joined = ",".join(f"{k}:{s}:{e}" for k in PATTERNS for s, e in found[k])
    return [len(found[k]) for k in PATTERNS], hashlib.sha256(joined.encode()).hexdigest()


def base_quality(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(w) - 4):
        places.setdefault(tuple(w[i:i + 5]), []).append(i)
    repeated = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated), failed


def fingerprint(text):
    import xxhash

    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, radius=2):
    """prints: list of (key, fp); smallest key reachable per row."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(prints):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [least.get(find(i)) for i in range(len(prints))]


def drop_repeated(docs, n=50):
    first = {}
    for k, t in docs:
        w = words(t)
        for i in range(len(w) - n + 1):
            x = tuple(w[i:i + n])
            key = float("inf") if k is None else k
            first[x] = min(key, first.get(x, key))
    out = []
    for k, t in docs:
        w = words(t)
        gone = {j for i in range(len(w) - n + 1) if first[tuple(w[i:i + n])] < (float("inf") if k is None else k) for j in range(i, i + n)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight of all sizes; the excess over the caps is shared again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, total = {}, sum(sizes.values())
    while True:
        rest = [s for s in order if s not in out]
        left = total - sum(out.values())
        if not rest:
            return out
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return {**out, **share}
        out |= {s: most * sizes[s] for s in over}
