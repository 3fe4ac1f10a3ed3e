import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from lanemesh.llm import language

from .test_jaccard import brute as jaccard_brute
from .test_line_dedup import brute as line_brute
from .test_mixing import brute as mixing_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows, over a small table, written and read between stages."""
    folder, docs, out = tmp_path_factory.mktemp("p"), spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (name, f) in enumerate(cp.STAGES):
        f(spark, docs, SF).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out.append((name, docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_columns(stages):
    assert all(tuple(c) == cp.COLUMNS for _, _, _, c in stages[:-1])


def test_language_keeps_what_has_letters(stages):
    _, before, after, _ = stages[0]
    assert {r.doc_id for r in after} == {r.doc_id for r in before if r.text and re.search("[^\\W\\d_]", r.text)}
    assert all(r.lang != language.UNKNOWN for r in after)


def test_lines(stages):
    _, before, after, _ = stages[1]
    want = line_brute([(r.doc_id, r.text) for r in before])
    lost = {r.doc_id for r in before if not want[r.doc_id] and r.text and r.text.count("\n") >= 2}
    assert {r.doc_id: r.text for r in after} == {i: t for i, t in want.items() if i not in lost}


def test_near_copies_by_five_words(stages):
    _, before, after, _ = stages[2]
    want = jaccard_brute([(r.doc_id, r.text) for r in before], percent=80, n=5)
    assert {r.doc_id for r in after} == {i for i, (_, c) in want.items() if c == i}


def test_near_copies_missed_by_three_words(spark):
    """With one of 50 words changed, 0.80 of the shingles of five words are common and 0.88 of those of three; with two, too few of either."""
    words = [f"w{k}" for k in range(50)]
    once, twice = [*words[:25], "x", *words[26:]], [*words[:15], "y", *words[16:35], "z", *words[36:]]
    docs = [(i, " ".join(w), "en", "s", 1) for i, w in ((1, words), (2, once), (3, twice))]
    got = cp.join_near_copies(spark, spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), SF)
    assert sorted(r.doc_id for r in got.collect()) == [1, 3]


def test_mix(stages):
    _, before, after, _ = stages[3]
    want = {i: taken // size for i, size, _, _, taken in mixing_brute([(r.doc_id, r.text, r.source) for r in before]) if taken}
    assert Counter(r.doc_id for r in after) == want


def test_tokens_decode_to_the_texts(stages, spark):
    import hashlib

    _, before, after, _ = stages[4]
    assert Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in before) == Counter((r.doc_id, r.decoded_sha256) for r in after)
    assert all(len(r.ids) == r.n_tokens for r in after)


WIDE = "target string, doc_id long, text string, lang string, source string, n_chars long, runs string, h long"


def odd_docs():
    words = [f"mot{k % 37}" for k in range(400)]
    line = "une ligne de texte\nune autre ligne\net la derniere"
    docs = [(i, f"{' '.join(words[i:i + 60])} {i}", "fr", "s1") for i in range(40)] + [(100 + i, " ".join(f"word{(k * (i + 3)) % 53}" for k in range(60)), "en", None) for i in range(40)]
    docs += [(200, line + "\nun", "fr", "s1"), (201, line + "\ndeux trois quatre", "fr", "s1"), (202, line, "fr", "s2"), (202, line, "fr", "s2"), (203, docs[3][1], "fr", "s1"), (203, docs[50][1], "en", "s1")]
    docs += [(None, docs[0][1], "fr", "s1"), (None, docs[1][1], "fr", "s1"), (300, None, "en", "s1"), (301, "", None, None), (302, " \n1 2 3", "en", "s1"), (303, " ".join(f"word{k % 53}{k % 11}" for k in range(40_000)), "en", "s1")]
    return [("t", i, t, lang, s, len(t or ""), "r", 7) for i, t, lang, s in docs]


@pytest.mark.parametrize("k", range(5))
def test_a_stage_with_odd_rows(spark, k):
    """Nulls, repeated rows and ids, a long text, clashing columns; and the same without rows."""
    df = spark.createDataFrame(odd_docs(), WIDE).repartition(3)
    name, f = cp.STAGES[k]
    if k in (2, 3):  # these see no null text or id in the pipeline
        df = df.where("doc_id is not null and text is not null")
    out = f(spark, df, SF)
    got, columns = Counter((r.doc_id, r.text if "text" in out.columns else r.decoded_sha256) for r in out.collect()), out.columns
    docs = [(r[1], r[2], r[4]) for r in odd_docs()]
    assert f(spark, df.limit(0), SF).count() == 0
    if k < 4:
        assert tuple(columns) == cp.COLUMNS
    if k == 0:
        assert got == Counter((i, t) for i, t, _ in docs if i is not None and t and re.search("[^\\W\\d_]", t))
    elif k == 1:
        assert got[201, "deux trois quatre"] == 1 and not any(i == 202 for i, _ in got) and got[None, docs[0][1]] == 1 and got[300, None] == 1
    elif k == 2:
        rows = [(i, t) for i, t, _ in docs if i is not None and t is not None and i != 203]
        want = jaccard_brute(rows, percent=80, n=5)
        assert Counter({x: n for x, n in got.items() if x[0] != 203}) == Counter((i, t) for i, t in rows if want[i][1] == i)
    elif k == 3:
        assert all(docs.count((i, t, s)) for i, t in got for s in {d[2] for d in docs if d[0] == i and d[1] == t}) and not any(i == 301 for i, _ in got)
    else:
        import hashlib

        assert got == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in docs)


def test_run_gives_the_last_stage(stages, spark):
    assert cp.run(spark, SF).count() == len(stages[-1][2])
