"""Plain-Python definitions the distributed operators are compared with."""

import re
import unicodedata


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for c in a:
        new = [0]
        for j, d in enumerate(b):
            new.append(row[j] + 1 if c == d else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def percent(distance, total):
    return 100.0 - 100.0 * distance / total if total else 100.0


def ratio(a, b):
    return percent(len(a) + len(b) - 2 * lcs(a, b), len(a) + len(b))


def token_set(a, b):
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    both = ta & tb
    if both and (ta <= tb or tb <= ta):
        return 100.0
    rest_a, rest_b = " ".join(sorted(ta - tb)), " ".join(sorted(tb - ta))
    s = len(" ".join(both))
    gap = 1 if s else 0
    total = 2 * (s + gap) + len(rest_a) + len(rest_b)
    scores = [percent(len(rest_a) + len(rest_b) - 2 * lcs(rest_a, rest_b), total)]
    if s:
        for rest in (rest_a, rest_b):
            scores.append(percent(1 + len(rest), 2 * s + 1 + len(rest)))
    return max(scores)


def best_keyword(text, keywords, cutoff=80):
    best = None
    for keyword in keywords:
        score = token_set(text, keyword)
        if score >= cutoff and (best is None or score > best[1]):
            best = (keyword, score)
    for token in re.findall(r"\w+", text.lower()):
        for keyword in keywords:
            score = ratio(token, keyword)
            if keyword and score >= cutoff and (best is None or score > best[1]):
                best = (keyword, score)
    return best


def best_name(text, keywords, cutoff=80):
    hits = [(k, token_set(text, k), at) for at, k in enumerate(keywords)]
    hits = sorted((-s, -len(k), at, k) for k, s, at in hits if s >= cutoff)
    return (hits[0][3], -hits[0][0]) if hits else None


def strip_marks(text):
    text = text.replace("ł", "l").replace("Ł", "L")
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
