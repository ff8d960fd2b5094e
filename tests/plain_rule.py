"""The scoring rule in plain Python, one text at a time: what the Spark plans are compared with."""

import re

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|!")


def clean(text):
    text = re.sub(r"http\S+|www\S+", "", text)
    text = re.sub(r"[@#]\w+", "", text)
    return " ".join(text.split())


def brute_score(text, words):
    """(polarity, subjectivity) of a text for lexicon rows (word, kind, p, s, k)."""
    if text is None:
        return 0.0, 0.0
    terms = {w: (p, s) for w, kind, p, s, _ in words if kind == "term"}
    modifiers = {w: k for w, kind, _, _, k in words if kind == "modifier"}
    negators = {w for w, kind, *_ in words if kind == "negator"}
    t = TOKEN.findall(clean(text).lower().replace("\u2019", "'"))
    found = []
    for i, word in enumerate(t):
        if word not in terms:
            continue
        prev = t[i - 1] if i > 0 else None
        prev2 = t[i - 2] if i > 1 else None
        p, s = terms[word]
        k = modifiers.get(prev, 1.0)
        boost = 1.25 if t[i + 1 : i + 2] == ["!"] else 1.0
        no = prev in negators or (prev in modifiers and prev2 in negators)
        found.append(
            (max(-1, min(1, p * k * boost)) * (-0.5 if no else 1), max(0, min(1, s * k)))
        )
    if not found:
        return 0.0, 0.0
    return sum(p for p, _ in found) / len(found), sum(s for _, s in found) / len(found)
