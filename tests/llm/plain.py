"""The operators' rules in plain Python, a row at a time, to hold results against."""

import hashlib
import math
from collections import Counter

from minewright.llm import language_id, toxicity
from minewright.llm.words import letter_words

M = 2**64


def feature(letters, kind):
    h = sum((ord(c) + 0x51ED2701) ** 2 * pow(toxicity._BASE, i, M) for i, c in enumerate(letters)) % M
    h = (h ^ kind) * 0xD6E8FEB86659FD93 % M
    h ^= h >> 32
    return (h * 0xD6E8FEB86659FD93 % M) >> 33


def toxic_score(text, model):
    found = set()
    for w in set(letter_words(text)):
        found |= {feature(w, 0)} | {feature(w[:n], n) for n in toxicity.PREFIXES if len(w) >= n}
    z = model.intercept + sum(model.weights[f] for f in sorted(found) if f in model.weights)
    return 1 / (1 + math.exp(-min(max(z, -30), 30)))


def language(text, coder, unsure):
    """Language, score and ambiguity by the loss over every codeword."""
    grams = Counter()
    for w in letter_words(text):
        marked = f"<{w}>"
        for n in language_id.ORDERS:
            for i in range(len(marked) - n + 1):
                h = n
                for c in marked[i : i + n]:
                    h = (h ^ ord(c)) * 0x100000001B3 % M
                    h ^= h >> 29
                grams[h % language_id.BUCKETS] += 1
    if not grams:
        return "und", 0.0, True
    total = sum(grams.values())
    bits = [language_id.SCALE * sum(k * float(coder.weights[b, j]) for b, k in grams.items()) / total + float(coder.bias[j]) for j in range(len(coder.bias))]
    loss = [sum(float(t) * math.log1p(math.exp(-min(max(x * c, -30), 30))) for x, c, t in zip(bits, word, coder.trust, strict=True)) for word in coder.code.tolist()]
    odds = [math.exp(min(loss) - v) for v in loss]
    share = sorted((o / sum(odds) for o in odds), reverse=True)
    return coder.langs[loss.index(min(loss))], share[0], len(share) > 1 and share[0] - share[1] < unsure


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_groups(rows):
    """Groups of row numbers of ``(doc_id, text)`` that are near copies."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return list(groups.values())


def without_repeats(texts, length):
    """Each text's bytes without those that lie in a string of ``length`` that also starts elsewhere."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        out.append(bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


def digest(raw):
    return hashlib.sha256(raw).hexdigest()
