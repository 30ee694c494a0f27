"""Brute-force versions and odd rows shared by the tests."""

import re

LOWER = {c: c + 32 for c in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text, pattern=SPACED):
    return pattern.findall((text or "").translate(LOWER))


def shingles(text, width):
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def smallest(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def odd_documents(spark, rows, extra=("key", "sig", "node", "text_a", "row", "doc", "cuts", "run", "ids", "score")):
    """(doc_id, text) rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, *[f"x{n}"] * len(extra)) for n, (i, t) in enumerate(rows)],
                                 "doc_id long, text string, " + ", ".join(f"{e} string" for e in extra))


ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a b c d e f"), (4, "one"), (4, "one"), (5, "\x00 \x0b é"), (6, "w " * 20000), (7, "w " * 20000),
       (8, "!!! ???"), (9, "日本語 テキスト 😀 á"), (10, "x" * 50000)]
