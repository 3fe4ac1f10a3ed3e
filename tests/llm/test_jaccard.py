import random
import re

import numpy as np
import pytest

from lanemesh.llm import jaccard

DDL = "doc_id long, text string, n string"


def brute(docs, percent=90, n=3):
    sets = {}
    for i, t, *_ in docs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    ids = sorted(i for i in sets if i is not None)
    comp = {i: i for i in ids}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for a, i in enumerate(ids):
        for j in ids[a + 1 :]:
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    x, y = sorted((root(i), root(j)))
                    comp[y] = x
    return {i: (len(s), root(i) if i is not None else None) for i, s in sets.items()}


def corpus(rng):
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4)))
    text = lambda k: [word() for _ in range(k)]
    docs, base = [], text(90)
    for i in range(80):  # a large group around one text, with one to seven edits each
        w = list(base)
        for _ in range(rng.randint(1, 7)):
            w[rng.randrange(len(w))] = word()
        docs.append((i, " ".join(w), None))
    passage = text(40)
    for i in range(100, 150):  # a passage in different texts, most of it or little
        docs.append((i, " ".join(passage + text(rng.choice((1, 2, 4, 60)))), None))
    for i in range(200, 260):
        w = text(rng.randint(1, 50))
        docs.append((i, " ".join(w), None))
        docs.append((i + 500, " ".join(w + text(rng.randint(0, 3))), None))
    docs += [(1000 + i, docs[0][1].upper().replace(" ", "\n"), "x") for i in range(60)]
    docs += [(2000, None, None), (2001, "", None), (2002, " \t", None), (2003, "one two", None), (2004, "One\ttwo ", None), (2005, "two one", None), (None, docs[3][1], None), docs[5], docs[5]]
    return docs


@pytest.mark.parametrize(("small", "rounds", "longest"), [(8, 4, 64), (3, 4, 64), (3, 0, 4), (3, 1, 4), (0, 2, 64)])
def test_equals_brute_force(spark, monkeypatch, small, rounds, longest):
    """Also where most lists get pivots, and where pairs are left after the last round."""
    for name, value in (("SMALL", small), ("PIVOT_ROUNDS", rounds), ("LONGEST", longest)):
        monkeypatch.setattr(jaccard, name, value)
    docs = corpus(random.Random(1))
    got = jaccard.joined(spark.createDataFrame(docs, DDL).repartition(3)).collect()
    assert len(got) == len(docs)
    want = brute(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_empty_table(spark):
    assert jaccard.joined(spark.createDataFrame([], DDL)).count() == 0


def test_frequent_cells_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "frequent", lambda level: 12)  # from three occurrences
    docs = corpus(random.Random(2))
    got = jaccard.joined(spark.createDataFrame(docs, DDL).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)


def test_small_difference_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL", 1)
    monkeypatch.setattr(jaccard.derived, "__defaults__", (5,))
    docs = corpus(random.Random(7))
    got = jaccard.joined(spark.createDataFrame(docs, DDL).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)


def test_five_words_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5000)
    rng = random.Random(3)
    long_ = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(30000)]
    docs = corpus(rng) + [(9000, " ".join(long_), None), (9001, " ".join(long_[:500] + ["x"] + long_[500:]), None), (9002, " ".join(long_[:20000]), None)]
    got = jaccard.joined(spark.createDataFrame(docs, DDL).repartition(3), n=5, percent=80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 80, 5)


def test_blocks_skip_no_link():
    """All pairs of a list whose sizes and places leave a link possible at their first common token, and no others."""
    rng = np.random.default_rng(5)
    for percent in (80, 90):
        e = np.zeros(400, jaccard.ENTRY)
        e["t"], e["n"], e["s"] = rng.integers(0, 25, 400), rng.integers(1, 80, 400), np.arange(400)
        e["p"] = [rng.integers(0, n - -(-percent * n // 100) + 1) for n in e["n"].tolist()]
        e = e[np.lexsort((e["s"], e["n"], e["t"]))]
        want = set()
        for i in range(400):
            for j in range(i + 1, 400):
                a, b = (tuple(int(x) for x in e[k]) for k in (i, j))
                need = -(-percent * (a[2] + b[2]) // (100 + percent))
                if a[0] == b[0] and need <= min(a[2] - a[3], b[2] - b[3]):
                    want.add((i, j))
        got = list(zip(*(x.tolist() for x in jaccard.list_pairs(e, percent))))
        assert len(got) == len(set(got)) and set(got) == want
