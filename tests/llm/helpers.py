"""Small tables and brute-force helpers of the llm tests."""

import re
from itertools import combinations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, langs=None):
    rows = [(i, t, (langs or {}).get(i, "en"), "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def components(ids, links):
    """Least id reachable from each id."""
    of = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(of[a], of[b])
            if of[a] != low or of[b] != low:
                of[a] = of[b] = low
                changed = True
    return of


def ascii_lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def shingles(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def jaccard_links(texts):
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    return [(a, b) for a, b in combinations(sets, 2)
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
