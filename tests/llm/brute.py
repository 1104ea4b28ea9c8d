"""Plain Python versions of the operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def contamination(docs, items):
    windows = []
    for item_id, text in items:
        w = words(text)
        windows += [(item_id, tuple(w[i : i + 13])) for i in range(max(1, len(w) - 12))] if w else []
    out = {}
    for doc_id, text in docs:
        w = words(text)
        places = defaultdict(list)
        for n in {len(x) for _, x in windows}:
            for i in range(len(w) - n + 1):
                places[tuple(w[i : i + n])].append(i)
        hit, met = set(), set()
        for item_id, x in windows:
            for i in places.get(x, ()):
                hit.update(range(i, i + len(x)))
                met.add("" if item_id is None else str(item_id))
        out[doc_id] = (len(w), len(hit), len(met), sha(",".join(sorted(met))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def base_quality(text):
    text = text or ""
    w = BLANK_WORD.findall(text)
    lines = [x for x in text.split("\n") if BLANK_WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    inside = {j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + 5)}
    failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed


def cut_repeats(docs, least):
    """Text and removed (start, stop, kept id, kept start) per document, from sentences."""
    units, first = defaultdict(list), {}
    for doc_id, text in sorted(docs, key=lambda r: (r[0], r[1] or "")):
        start = 0
        for piece in re.findall(r"[^\n.!?。！？]*[\n.!?。！？]+[ \t\r\n\f\v]*|[^\n.!?。！？]+", text or ""):
            w = tuple(x for x in re.split(r"[ \t\r\n\f\v]+", piece.translate(ASCII_LOWER)) if x)
            if w:
                units[doc_id].append((start, start + len(piece), w))
                first.setdefault(w, (doc_id, start))
            start += len(piece)
    out = {}
    for doc_id, text in docs:
        runs, run = [], []
        for a, b, w in [*units[doc_id], (-1, -1, None)]:
            if w is not None and first[w] != (doc_id, a):
                run.append((a, b, w))
            else:
                if sum(len(x[2]) for x in run) >= least:
                    runs.append((run[0][0], run[-1][1], *first[run[0][2]]))
                run = []
        edges = [0, *(x for r in runs for x in r[:2]), len(text or "")]
        cut = "".join((text or "")[a:b] for a, b in zip(edges[::2], edges[1::2]))
        out[doc_id] = (cut if runs else text, runs)
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def spans_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def license_places(text):
    w = words(text)
    found = [(i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def conversation(rows):
    """Turn digest, loss text of (turn, role, text) rows."""
    rows = sorted((t, r or "", x or "") for t, r, x in rows)
    text = "".join(f"{r}\n{x}\n" for _, r, x in rows)
    loss = "".join(x for _, r, x in rows if r == "assistant")
    return len(rows), sha(text), len(loss), sha(loss)


def fingerprint(text):
    w = BLANK_WORD.findall((text or "").translate(ASCII_LOWER))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(prints, bits=4):
    """Smallest id reachable, per id, from (id, fingerprint) rows."""
    distinct = list({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for i, p in prints:
        r = find(p)
        least[r] = min(least.get(r, i), i)
    return {(i, p): least[find(p)] for i, p in prints}


def crc32(data: bytes) -> int:
    return zlib.crc32(data)
