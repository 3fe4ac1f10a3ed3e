import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lanemesh.llm import suffixes

DDL = "doc_id long, text string, source string"


def brute(docs, length):
    """Straight from the definition, over every window of every text."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    place = lambda i, b: (-1 - int(sha(b)[:15], 16) if i is None else i, sha(b))
    seen, out = set(), {}
    for doc, text in sorted({(i, (t or "").encode()) for i, t, *_ in docs}, key=lambda x: place(*x)):
        gone = bytearray(len(text))
        for s in range(len(text) - length + 1):
            window = text[s : s + length]
            if window in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc, text] = (doc, len(text), sum(gone), spans, sha(kept))
    return Counter(map(repr, (out[i, (t or "").encode()] for i, t, *_ in docs)))


def found(df):
    """How often each row comes out; a row for each input row."""
    return Counter(repr((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in df.collect())


def corpus(rng, n):
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 8)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(rng.randint(12, 60)) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = [text(rng.randint(1, 60)) for _ in range(rng.randint(1, 3))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            cut = rng.randint(0, 20)
            parts.insert(rng.randint(0, len(parts)), p[cut : len(p) - rng.randint(0, 20)])
        docs.append((i * 3, "".join(parts), "s"))
    docs.append((5000, "ab" * 300 + "x" + "ab" * 200, "s"))
    docs.append((5001, "a" * 350, None))
    docs += [(6000 + i, docs[3][1], "s") for i in range(5)] + [(7000 + i, docs[4][1][:200] + str(i) + docs[4][1][200:], "s") for i in range(30)]
    docs += [(None, docs[7][1], None), (8000, None, None), (8001, "", None), (8002, "short", None), docs[5], docs[5]]
    return docs


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 700)
    docs = corpus(random.Random(4), 120)
    df = spark.createDataFrame(docs, DDL).repartition(3)
    assert found(suffixes.deduplicated(df)) == brute(docs, 100)


def test_splitting_frequent_anchors_changes_nothing(spark):
    docs = corpus(random.Random(5), 60)
    df = spark.createDataFrame(docs, DDL).repartition(3)
    assert found(suffixes.deduplicated(df, hot_rows=3)) == brute(docs, 100)


def test_shared_and_null_ids(spark):
    """Texts of one id, or of none, are told apart; copies of them too."""
    rng = random.Random(8)
    a, b, c, d = ("".join(rng.choice("abcdefgh ") for _ in range(259)) for _ in range(4))
    docs = [(None, a + a), (None, c + d), (None, a), (None, a), (None, ""), (None, None), (1, b + b), (1, c + "x" + d), (1, b), (1, b), (2, d + a), (2, d), (3, d), (-4, c), (-4, c + c)]
    df = spark.createDataFrame([(*x, None) for x in docs], DDL).repartition(3)
    assert found(suffixes.deduplicated(df)) == brute(docs, 100)


def test_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SEGMENT", 4096)
    rng = random.Random(9)
    long_ = "".join(rng.choice("abcdefgh ") for _ in range(120_000))
    docs = [(1, long_, None), (2, "x" + long_[50_000:90_000] + "y" + long_[:300], None), (3, long_ + long_[:5000], None)]
    assert found(suffixes.deduplicated(spark.createDataFrame(docs, DDL))) == brute(docs, 100)


def test_collisions_hide_nothing(monkeypatch):
    """Hashes that leave out a window's last byte make A B A' one class, in which the bytes decide."""
    plain = suffixes.Suffixes.equal
    monkeypatch.setattr(suffixes.Suffixes, "equal", lambda self, i, j, n: plain(self, i, j, np.where(np.asarray(n) == self.length, self.length - 1, n)))
    length, body = 40, b"0123456789" * 3 + b"abcdefghi"
    data = [body + x for x in (b"A", b"B", b"A", b"C", b"B")]
    one = np.ones(5, np.int64)
    d, s = suffixes.repeated_starts(one, np.arange(5), np.zeros(5, np.int64), one, one * 3, data, length)
    assert sorted(d.tolist()) == [2, 4] and not s.any()


def test_empty_table(spark):
    assert suffixes.deduplicated(spark.createDataFrame([], DDL)).count() == 0


def test_sort_agrees_with_plain_sorting():
    rng = random.Random(6)
    data = bytes(rng.choice(b"ab") for _ in range(3000)) + bytes(60)
    s = suffixes.Suffixes(np.frombuffer(data, np.uint8), 50)
    at = np.array(rng.sample(range(2900), 900))
    group = np.sort(np.array([rng.randint(0, 40) for _ in at]))
    got = s.sort(at, group)
    for g in set(group):
        mine, plain = got[group == g], sorted(at[group == g].tolist(), key=lambda i: data[i : i + 50])
        assert [data[i : i + 50] for i in mine] == [data[i : i + 50] for i in plain]


class Functions:
    """Stands for a table; keeps the functions that are to run over it."""

    def __init__(self):
        self.found = []

    def mapInArrow(self, function, schema):  # noqa: N802
        self.found.append(function)
        return self

    def repartition(self, *args):
        return self


def test_a_task_with_several_buckets_unpacks_one_at_a_time():
    docs, buckets, n = Functions(), 12, 100_000
    _, meet = suffixes.shared_anchors(docs, 100, buckets).found
    rows = []
    for b in range(buckets):
        x = np.zeros(n, suffixes.SINGLE)
        x["h"] = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(buckets) + np.uint64(b)
        x["d"], x["p"] = np.arange(n) // 50, np.arange(n) % 50 * 33
        x["h"][-2:] = b  # the only hash that occurs twice
        rows.append((b, 0, n, suffixes._packed(x)))
    told = np.array([(2 * buckets + 3,)], [("h", "<u8")])  # another block has this one twice
    rows.append((3, 1, 1, suffixes._packed(told)))
    names = ["bucket", "kind", "n", "data"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    batches = [pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(r, types)], names=names) for r in rows]
    tracemalloc.start()
    try:
        out = list(meet(iter(batches)))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    got = np.concatenate([suffixes._unpacked(d, k, suffixes.SINGLE) for batch in out for k, d in zip(batch.column("n").to_pylist(), batch.column("data").to_pylist())])
    assert sorted(got["h"].tolist()) == sorted([b for b in range(buckets) for _ in range(2)] + [2 * buckets + 3])
    assert most < 20e6


def test_counting_cells_holds_one_count_a_cell():
    shared = Functions()
    shared.select = lambda *names: shared
    with pytest.raises(AttributeError):  # there is no table behind it
        suffixes.hot_cells(shared, 3)
    (count,) = shared.found
    x = np.zeros(5, suffixes.SINGLE)
    x["h"] = [7, 7, suffixes.CELLS + 7, 9, 9]
    batch = pa.RecordBatch.from_arrays([pa.array([5, 5]), pa.array([suffixes._packed(x)] * 2, pa.binary())], names=["n", "data"])
    tracemalloc.start()
    try:
        out = [r for b in count(iter([batch])) for r in zip(*(c.to_pylist() for c in b.columns))]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out == [(7, 6), (9, 4)] and most < 1.5 * 8 * suffixes.CELLS
