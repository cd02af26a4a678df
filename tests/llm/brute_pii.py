"""Personal data by Python's re and plain loops."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 8 <= len(digits) <= 15,
    }[kind]()


def base(text: str) -> list[tuple[str, int, int]]:
    found = []
    for kind, pattern in PATTERNS.items():
        found += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if valid(kind, m.group())]
    return found


def disclosing(texts: list[str], z: float, threshold: float) -> list[list[tuple[int, int]]]:
    """Per text the spans of terms that reveal an entity of it."""
    word = re.compile(r"[^\W\d_]+")
    places = defaultdict(set)  # (entity, term): documents
    entities, documents = defaultdict(set), defaultdict(set)
    spots = []
    for i, text in enumerate(texts):
        for w in {w.lower() for w in word.findall(text)}:
            documents[w].add(i)
        spans, here = base(text), []
        touched = [any(s < b and a < e for _, s, e in spans) for a, b in (m.span() for m in word.finditer(text))]
        for m, inside in zip(word.finditer(text), touched, strict=True):
            for kind, start, end in spans:
                entity = (kind, text[start:end])
                entities[entity].add(i)
                if not inside:
                    places[entity, m.group().lower()].add(i)
                    here.append((entity, m.group().lower(), *m.span()))
        spots.append(here)
    n = len(texts)

    def share(entity, term):
        n_e, n_t, n_et = len(entities[entity]), len(documents[term]), len(places[entity, term])
        if n_e == n:
            return 0.0
        p = n_et / n_t
        low = (p + z * z / (2 * n_t) - z * math.sqrt(p * (1 - p) / n_t + z * z / (4 * n_t * n_t))) / (1 + z * z / n_t)
        return math.log(low * n / n_e) / math.log(n / n_e)

    return [sorted({(a, b) for e, t, a, b in here if share(e, t) >= threshold}) for here in spots]


def digest(spans) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
