from itertools import permutations

import numpy as np
from helpers import ODD, SPACED, odd_documents

from quarry.llm import filteraudit as audit


def brute(docs, labels):
    """The five filters applied one after another, for every order; docs: (doc_id, text, part)."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    fails = []
    for i, text, _ in docs:
        text = text or ""
        w = SPACED.findall(text)
        fails.append({f for f, no in (
            ("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)), ("C", 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)),
            ("D", any(c in "#$%&*|" for c in text)),
            ("E", i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs))) if no})
    out = {}
    for part in {p or "" for _, _, p in docs}:
        own = [k for k, d in enumerate(docs) if (d[2] or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                before = len([k for k in own if f in fails[k]]) - len(gone)
                left = [k for k in left if f not in fails[k]]
                out[part, "".join(order), step] = [len(left), len(gone), before, len([k for k in own if fails[k] == {f}]),
                                                   len([k for k in gone if docs[k][0] in good]), len([k for k in gone if docs[k][0] in toxic])]
    total = {}
    for (part, order, step), row in out.items():
        total[part, order[step - 1]] = total.get((part, order[step - 1]), 0) + row[1]
    return {k: (*row, total[k[0], k[1][k[2] - 1]]) for k, row in out.items()}


def told(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in audit.COUNTS) for r in df.collect()}


def test_against_filters_one_after_another(spark):
    long = " ".join(f"w{i}" for i in range(120))
    docs = [(1, long, "a"), (2, long, "a"), (3, long, None), (3, long, "a"), (2, long, "a"), (4, long + " #", "b"), (5, long.upper(), "b"), (6, "w " * 150, "b"),
            (7, "w " * 150, ""), (None, long, "a"), (None, long, "a"), (8, None, "a"), (9, "", "a"), (10, "A B $", "c"), (-1, "ok", "c"), (11, "ok", "c")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, 1), (None, 1, 1), (9, 1, 0), (10, 1, 1), (77, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    expected = brute(docs, labels)
    assert told(audit.audit(audit.cells(df, said, audit.text_filters(), "E"), "ABCDE")) == expected
    assert len(expected) == 4 * 600


def test_odd_rows_and_clashing_names(spark):
    docs = odd_documents(spark, ODD, ("lang", "words", "part", "mask", "digest", "good", "toxic", "n", "first", "named"))
    said = spark.createDataFrame([(4, 1, 1, "x", "y"), (None, 1, 1, "x", "y")], "doc_id long, quality int, toxic int, part string, n string")
    parts = [r.lang for r in docs.select("doc_id", "lang").collect()]
    assert told(audit.audit(audit.cells(docs, said, audit.text_filters(), "E"), "ABCDE")) == brute([(i, t, p) for (i, t), p in zip(ODD, parts)], [(4, 1, 1)])
    assert audit.audit(audit.cells(docs.limit(0), said, audit.text_filters(), "E"), "ABCDE").count() == 0
    assert audit.audit(audit.cells(docs, said.limit(0), audit.text_filters(), "E"), "ABCDE").count() == 600 * len(set(parts))


def test_other_numbers_of_filters(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "# a"), (3, "a b")], "doc_id long, text string").selectExpr("*", "cast(null as string) as lang")
    said = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    two = {k: v for k, v in audit.text_filters().items() if k in "AD"}
    rows = told(audit.audit(audit.cells(docs, said, two), "AD"))
    assert rows["", "DA", 1][:4] == (2, 1, 0, 0) and rows["", "DA", 2][:4] == (0, 2, 1, 2) and rows["", "AD", 2][:4] == (0, 0, 1, 0)


def test_contraction_is_the_count_of_cells():
    rng = np.random.default_rng(1)
    tensor = rng.integers(0, 9, (3, 2, 2, 2, 2))
    kept, removed, redundant, unique, good, toxic, _ = audit.contracted(tensor, [(2, 0, 1)])[:, 1, 0]
    t = tensor[0, 1]
    assert kept.tolist() == [t[:, :, 0].sum(), t[0, :, 0].sum(), t[0, 0, 0]]
    assert removed.tolist() == [t[:, :, 1].sum(), t[1, :, 0].sum(), t[0, 1, 0]]
    assert redundant.tolist() == [0, t[1, :, 1].sum(), t[:, 1].sum() - t[0, 1, 0]]
    assert unique.tolist() == [t[0, 0, 1], t[1, 0, 0], t[0, 1, 0]]
    assert good.tolist() == [tensor[1, 1][:, :, 1].sum(), tensor[1, 1][1, :, 0].sum(), tensor[1, 1][0, 1, 0]]
