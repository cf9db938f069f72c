"""Plain Python versions of the contracts, text by text, and rows that every operator has to stand."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Null, empty and blank texts, odd blanks, letters beyond ASCII, a long text, and copies.
TEXTS = [None, "", " \t\n ", "one", "Ünïcode\xa0stays one word", "a\x0bb\x0cc\rd", "x " * 3000, "x " * 3000, "*** ### $$$\n*** ### $$$"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


def sha(parts):
    return hashlib.sha256(" ".join(parts).encode()).hexdigest()


def held(doc_id, remainder):
    return zlib.crc32(str(doc_id).encode()) % 5 == remainder


def repeated(texts, window=35):
    """(n_words, n_removed, kept_sha256) by text."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((len(w), len(gone), sha([x for j, x in enumerate(w) if j not in gone])))
    return out


def contamination(text, items, window=13):
    """(n_words, hit words, items)"""
    said = ITEM_WORD.findall(lower(text))
    hit, found = set(), set()
    for item, item_text in items:
        own = ITEM_WORD.findall(lower(item_text))
        for k in range(max(1, len(own) - window + 1) if own else 0):
            part = own[k : k + window]
            for i in range(len(said) - len(part) + 1):
                if said[i : i + len(part)] == part:
                    hit.update(range(i, i + len(part)))
                    found.add(item)
    return len(said), hit, found


def quality_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words"""
    own = words(text)
    triples = Counter(zip(own, own[1:], own[2:], strict=False))
    again = {j for i in range(len(own) - 2) if triples[tuple(own[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def unigram(rows, learn):
    """By id: n_tokens, n_known, train_tokens, base_score."""
    tokens = {d: [*words(lower(t)), ""] for d, t in rows}
    seen = Counter(w for d, own in tokens.items() if learn(d) for w in own)
    total, distinct = sum(seen.values()), len(seen)
    return {
        d: (len(own), sum(seen[w] > 0 for w in own), total, sum(math.log10((seen[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own))
        for d, own in tokens.items()
    }
