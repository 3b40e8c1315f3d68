"""Plain Python versions of the operators' results."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text):
    t = text or ""
    ws = WORD.findall(t)
    tri = collections.Counter(zip(ws, ws[1:], ws[2:]))
    covered = {p for k in range(len(ws) - 2) if tri[tuple(ws[k:k + 3])] > 1 for p in (k, k + 1, k + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            len(ws) < 50 or 100 * len(covered) > 50 * len(ws))


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{e}" for k, a, e in spans).encode()).hexdigest()


SECRETS = {
    "assign": (r"(?:password|passwd|secret|token|api_?key)", r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
    "access": ("", r"(AKIA[A-Z0-9]+)", 16),
    "hex": ("", r"([0-9a-f]+)", 32),
}


def secrets(text):
    """(kind, start, end) by start, then kind."""
    out = []
    for k, (kind, (head, tail, least)) in enumerate(SECRETS.items()):
        for m in re.finditer(f"(?i:{head}){tail}" if head else tail, text or ""):
            if len(m.group(1)) >= least:
                out.append((m.start(), k, kind, m.end()))
    return [(kind, s, e) for s, _, kind, e in sorted(out)]


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pii(text):
    """(kind, start, end) by kind, then start."""
    out = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group(0))
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group(0).split(".")),
                    "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def components(ids, links):
    """id -> smallest id of its component."""
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    return {i: top(i) for i in ids}
