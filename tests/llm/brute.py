"""Brute-force answers that several tests share."""

import re

from eigenpool.llm import secret_scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_spans(text):
    found = []
    for place, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), place, rule.kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def brute_components(texts, percent=85):
    sets = []
    for t in texts:
        words = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        words = WORD.findall(words)
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return [len(s) for s in sets], root
