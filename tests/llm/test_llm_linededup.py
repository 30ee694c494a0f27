import random

from helpers import ODD, odd_documents

from quarry.llm import linededup as L


def brute(docs, least=L.MIN_WORDS):
    """Lines in a block that an earlier document holds too, with ``least`` words at least."""
    out = {}
    named = sorted(((i, t, *L.line_hashes(t)) for i, t in docs), key=lambda x: x[0])
    for k, (i, text, h, w) in enumerate(named):
        gone = [False] * len(h)
        for _, _, a, _ in named[:k]:
            for x in range(len(h)):
                for y in range(len(a)):
                    n = 0
                    while x + n < len(h) and y + n < len(a) and h[x + n] == a[y + n]:
                        n += 1
                    if n and sum(w[x:x + n]) >= least:
                        gone[x:x + n] = [True] * n
        out[i] = "\n".join(s for s, g in zip(text.split("\n"), gone) if not g)
    return out


def corpus():
    rng = random.Random(11)
    line = lambda n: " ".join(f"v{rng.randrange(5000)}" for _ in range(n))
    passages = [[line(35)], [line(60)], [line(12), line(14), line(15)], [line(31), "", line(40)]]
    docs = []
    for i in range(60):
        body = []
        for _ in range(rng.randint(1, 6)):
            body += rng.choice([[line(rng.randint(1, 40))], rng.choice(passages)])
        docs.append((i, "\n".join(body)))
    docs += [(100 + i, docs[i][1]) for i in range(10)]  # exact copies
    docs += [(200, "\n".join(passages[1] + passages[0])), (201, "\n".join(passages[0] + passages[1] + passages[0]))]  # moved, repeated
    return docs


def left(spark, docs):
    return {r.doc_id: r.text for r in L.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}


def test_lines_left(spark, monkeypatch):
    monkeypatch.setattr(L, "SALT", 3)  # small: the earliest holder of a passage is sent to many groups
    docs = corpus()
    assert left(spark, docs) == brute(docs)


def test_short_lines_beside_a_passage(spark):
    """A short line goes with the passage if the earliest holder has it there too; another holder isn't aligned."""
    run = " ".join(f"p{i}" for i in range(40))
    docs = [(1, f"x\n{run}"), (2, f"{run}\nshort line"), (3, f"{run}\nshort line\nend"), (4, f"x\n{run}\nend")]
    assert left(spark, docs) == {1: docs[0][1], 2: "short line", 3: "short line\nend", 4: "end"}


def test_clean_documents_stay(spark):
    docs = [(i, f"short shared line\nAll rights reserved.\n{i} " + " ".join(f"u{i}x{j}" for j in range(50))) for i in range(20)]
    assert left(spark, docs) == dict(docs)


def test_alignment_keeps_order():
    a, b = L.line_hashes("a a\nb b\nc c\nd d"), L.line_hashes("a a\nx x\nb b\nc c\nd d\nq q")
    assert L.Earlier(*a, 4).common(*b) == [(2, 5)]
    assert L.Earlier(*a, 2).common(*b) == [(0, 1), (2, 5)]


def test_odd_rows(spark):
    docs = odd_documents(spark, ODD)
    done = L.dedup(docs)
    assert done.columns == [*docs.columns, "line_dedup"]
    got = sorted(((r.doc_id, r.text, r["row"]) for r in done.collect()), key=str)
    emptied = {7: ""}  # the long text that document 6 holds already
    assert got == sorted(((i, emptied.get(i, t), f"x{n}") for n, (i, t) in enumerate(ODD)), key=str)
    assert L.dedup(docs.limit(0)).count() == 0


def test_rows_of_one_id_are_not_later_than_each_other(spark):
    text = " ".join(f"k{i}" for i in range(40))
    got = sorted(r.text for r in L.dedup(spark.createDataFrame([(1, text), (1, text), (1, text + "\nmore"), (2, text + "\nend")], "doc_id long, text string")).collect())
    assert got == sorted([text, text, text + "\nmore", "end"])
