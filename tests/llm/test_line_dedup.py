import random
import re

from lanemesh.llm import line_dedup

DDL = "doc_id long, text string, pos string, first string, __x long"


def brute(docs):
    lines = {i: t.split("\n") for i, t, *_ in docs if i is not None and t is not None}
    seen, gone = set(), {i: set() for i in lines}
    for i in sorted(lines):
        for p in range(len(lines[i]) - 2):
            w = tuple(lines[i][p : p + 3])
            if not any(re.search(r"[^\x20\x09-\x0D]", x) for x in w):
                continue
            if w in seen:
                gone[i] |= {p, p + 1, p + 2}
            seen.add(w)
    return {i: "\n".join(x for p, x in enumerate(lines[i]) if p not in gone[i]) for i in lines}


def corpus():
    rng = random.Random(2)
    pool = [f"line {k}" for k in range(40)] + ["", " "]
    docs = [(i, "\n".join(rng.choice(pool[: 6 + i % 36]) for _ in range(rng.randint(0, 30))), "a", "b", 1) for i in range(150)]
    return docs + [(500, None, None, None, None), (501, "", None, None, None), (502, "\n\n\n\n", None, None, None), (503, docs[9][1], None, None, None), (504, "x\n" * 4000, None, None, None)]


def test_equals_brute_force(spark):
    docs = corpus()
    out = line_dedup.line_deduped(spark.createDataFrame(docs, DDL).repartition(4))
    assert out.columns == ["doc_id", "text", "pos", "first", "__x"]
    want = brute(docs)
    assert {r.doc_id: r.text for r in out.collect()} == {i: want.get(i) for i, *_ in docs}


def test_repeated_rows_and_null_ids(spark):
    text = "a\nb\nc\nd"
    docs = [(1, text, None, None, 0), (1, text, None, None, 0), (None, text, None, None, 0), (2, text + "\ne", None, None, 0)]
    rows = line_dedup.line_deduped(spark.createDataFrame(docs, DDL), drop_emptied=True).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == [("1", text), ("1", text), ("2", "e"), ("None", text)]


def test_texts_of_one_id_are_told_apart(spark):
    docs = [(1, "a\nb\nc"), (1, "x\ny\nz\nw"), (1, "x\ny\nz\nw"), (2, "a\nb\nc\nd"), (2, "p\nq\nr\ns")]
    rows = line_dedup.line_deduped(spark.createDataFrame([(*d, None, None, 0) for d in docs], DDL)).collect()
    assert sorted((r.doc_id, r.text) for r in rows) == [(1, "a\nb\nc"), (1, "x\ny\nz\nw"), (1, "x\ny\nz\nw"), (2, "d"), (2, "p\nq\nr\ns")]


def test_columns_of_any_name(spark):
    names = ["run_doc", "runs", "doc_id", "lines", "kept", "text", "d0", "n", "__runs", "__run_doc", "h1"]
    docs = [(10, 11, i, 12, 13, "a\nb\nc", 14, 15, 16, 17, 18) for i in (1, 2)]
    out = line_dedup.line_deduped(spark.createDataFrame(docs, names))
    assert out.columns == names and sorted(map(tuple, out.collect())) == [docs[0], (10, 11, 2, 12, 13, "", *docs[1][6:])]


def test_very_long_text_and_a_frequent_window(spark):
    long_ = "\n".join(f"l{k}" for k in range(60_000))
    docs = [(0, long_)] + [(i, f"a{i}\nu\nv\nw\nb{i}") for i in range(1, 300)] + [(999, "z\n" + long_ + "\ny")]
    got = {r.doc_id: r.text for r in line_dedup.line_deduped(spark.createDataFrame([(*d, None, None, 0) for d in docs], DDL).repartition(3)).collect()}
    assert got == {0: long_, 1: docs[1][1], 999: "z\ny"} | {i: f"a{i}\nb{i}" for i in range(2, 300)}


def test_emptied_documents_go_on_request(spark):
    docs = [(1, "a\nb\nc", None, None, 0), (2, "a\nb\nc", None, None, 0)]
    df = spark.createDataFrame(docs, DDL)
    assert [r.text for r in line_dedup.line_deduped(df).orderBy("doc_id").collect()] == ["a\nb\nc", ""]
    assert [r.doc_id for r in line_dedup.line_deduped(df, drop_emptied=True).collect()] == [1]
    assert line_dedup.line_deduped(df.limit(0)).count() == 0
