"""Small document tables with awkward rows, and plain re-implementations."""

from __future__ import annotations

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key long, value long, word string, score double, n long, root long, mark string"
)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def documents(spark, rows):
    """(doc_id, text[, lang[, source]]) with more columns whose names operators use inside."""
    full = []
    for row in rows:
        doc_id, text, lang, source = (*row, None, None, None)[:4]
        n = len(text) if text is not None else None
        full.append((doc_id, text, lang, source, n, 1, 2, "w", 0.5, 3, 4, "m"))
    return spark.createDataFrame(full, SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def shingle_set(text, width):
    own = words(text)
    if not own:
        return frozenset()
    if len(own) < width:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + width]) for i in range(len(own) - width + 1))


def components_by_hand(rows, width=4, percent=80):
    """(doc_id, n_shingles, component_id, kept) with every pair compared."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if i is None or j is None or not s or not t:
                continue
            both = len(s & t)
            if both and 100 * both >= percent * (len(s) + len(t) - both):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [
        (i, len(s), least.get(find(k)), least.get(find(k)) == i) for k, (i, s) in enumerate(sets)
    ]
