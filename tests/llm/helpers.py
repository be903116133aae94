"""Brute-force counterparts and small tables."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, size):
    words = WORD.findall(lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard_components(rows, size, percent):
    """{doc_id: (set size, smallest reachable doc_id)}"""
    sets = [(i, shingles(t, size)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets}


def copies(seed, groups=25, vocabulary=200):
    """(doc_id, text): families of near copies of very different sizes, exact
    copies, empty and missing texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    out = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 6, 12, 13, 25, 60, 200, 500]))]
        for _ in range(rng.choice([1, 2, 4, 12])):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 20))):
                at = rng.randrange(len(text)) if text else 0
                kind = rng.random()
                if kind < 0.5 and text:
                    text[at] = rng.choice(words)
                elif kind < 0.7 and len(text) > 1:
                    del text[at]
                else:
                    text.insert(at, rng.choice(words))
            joined = rng.choice([" ", "\n", "\t "]).join(text)
            out.append(joined.upper() if rng.random() < 0.1 else joined)
    out += ["", None, " \n", "same text here", "Same  text here"]
    rng.shuffle(out)
    return [(7 * i + 3, t) for i, t in enumerate(out)]


def documents(spark, rows, parts=4):
    """A documents table with more columns than needed, some of names that
    operators use themselves."""
    full = [(i, t, "en", "s", 5, 9, "x", 1.5, [1]) for i, t in rows]
    schema = ("doc_id long, text string, lang string, source string, n long, rep long, key string, score double, keys array<int>")
    return spark.createDataFrame(full, schema).repartition(parts)
