"""What several test modules of the corpus operators use."""

import re

import numpy as np


def brute_substrings(docs):
    """docs: sorted (id, text)."""
    seen, out = set(), {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            w = tuple(words[s:s + 20])
            if w in seen:
                gone[s:s + 20] = [True] * 20
            seen.add(w)
        out[i] = [w for w, g in zip(words, gone, strict=True) if not g]
    return out


def unlearnt_texts(n):
    """Texts of a language that no document is labelled with."""
    rng = np.random.default_rng(11)
    parts = ["zq", "xv", "kj", "wz", "qx", "vj", "uu", "y"]
    return [" ".join("".join(rng.choice(parts, rng.integers(2, 5))) for _ in range(80)) for _ in range(n)]


def brute_near_duplicates(docs):
    """docs: (id, text); the smallest id of each class of texts linked at a Jaccard
    similarity of 0.8 on five-word shingles (fewer words: one shingle, none: no link)."""
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets[i] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    ids, of = sorted(sets), {i: i for i in sets}
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both) and of[i] != of[j]:
                low, high = sorted((of[i], of[j]))
                of = {k: low if v == high else v for k, v in of.items()}
    return {i for i in ids if of[i] == i}
