import math
import random
import re
from collections import Counter

import numpy as np

from lanemesh.llm import quality

DDL = "doc_id long, text string, lang string, source string, n_words string"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def corpus():
    rng = random.Random(1)
    vocab = ["".join(rng.choice("abcdefgéü") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    clean = lambda: "\n".join(" ".join(rng.choice(vocab) for _ in range(12)) for _ in range(rng.randint(2, 8)))
    docs = [(i, clean(), "en", "s" + str(i % 2), "z") for i in range(500)]
    docs += [(600 + i, " ".join(w + "###" for w in clean().split()), "en", "s0", "z") for i in range(20)]
    docs += [(700 + i, "buy it now please today " * 9 + clean(), "en", "s1", "z") for i in range(10)]
    return docs + [(800, None, None, None, None), (801, "", "en", "s0", None), (802, " \n\t", "xx", None, None), (803, "a b c d e a b c d e a", "de", "q", None), docs[1], docs[1], (804, "word " * 30000, "en", "s0", None), (None, clean(), "en", "s0", None)]


def test_measures_equal_brute_force(spark):
    docs = corpus()
    rows = quality.judged(spark.createDataFrame(docs, DDL).repartition(3)).collect()
    assert len(rows) == len(docs)
    text = {i: t for i, t, *_ in docs}
    for r in rows:
        n, chars, symbols, dup, repeat = brute(text[r.doc_id]) if r.doc_id != 804 else (30000, 120000, 0, 0, 30000)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 10 or 100 * repeat > 20 * n)
        assert not (r.base_failed and r.kept)


def test_limits_tell_junk_from_clean(spark):
    kept = {r.doc_id: r.kept for r in quality.judged(spark.createDataFrame(corpus(), DDL)).collect()}
    assert all(kept[i] for i in range(500)) and not any(kept[i] for i in [*range(600, 620), *range(700, 710)])


def test_sketches_merge_exactly(spark):
    found = quality.measured(spark.createDataFrame(corpus(), DDL)).cache()
    whole = {tuple(r) for r in quality.limits(quality.sketches(found), [], 8.0).collect()}
    halves = quality.sketches(found.where("doc_id % 2 = 0")).unionByName(quality.sketches(found.where("doc_id % 2 = 1 or doc_id is null")))
    assert {tuple(r) for r in quality.limits(halves, [], 8.0).collect()} == whole


def brute_kept(docs, reach=8.0, prior=20.0):
    """Quartiles of bucket middles from sorted lists, drawn towards the larger groups."""
    floors = (0.3, 0.02, 0.05, 0.03)

    def ratios(text):
        n, chars, symbols, dup, repeat = brute(text)
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))
        return n, repeat, (chars / n, symbols / n, dup / lines, repeat / n) if n else None

    def middle(x):
        return 2 * 1.02 ** math.ceil(math.log(x) / math.log(1.02)) / 2.02 if x > 0 else 0.0

    def limits(values):
        out = []
        for k, floor in enumerate(floors):
            v = sorted(middle(x[k]) for x in values)
            q1, q3 = (v[math.ceil(len(v) * q) - 1] for q in (0.25, 0.75))
            out.append((q1 - reach * max(q3 - q1, floor), q3 + reach * max(q3 - q1, floor)))
        return np.array(out)

    found = [(lang, source, *ratios(t)) for _, t, lang, source, *_ in docs]
    used = [f for f in found if f[4]]
    drawn = lambda part, to: (len(part) * limits([f[4] for f in part]) + prior * to) / (len(part) + prior)
    kept, cache = [], {}
    for lang, source, n, repeat, x in found:
        if n < 10 or 100 * repeat > 20 * n:
            kept.append(False)
            continue
        if (lang, source) not in cache:
            mine = [f for f in used if f[0] == lang]
            cache[lang, source] = drawn([f for f in mine if f[1] == source], drawn(mine, limits([f[4] for f in used])))
        low, high = cache[lang, source].T
        kept.append(all(x <= high) and x[0] >= low[0])
    return kept


def test_kept_equals_brute_force(spark):
    """Groups of any size have limits of their own: two languages of few documents, one of many."""
    rng = random.Random(3)
    docs = [d for d in corpus() if d[0] != 804]
    docs += [(900 + i, " ".join("x" * rng.randint(2, 30) for _ in range(14)), "xx", f"q{i % 5}", None) for i in range(40)]
    docs += [(950 + i, " ".join("y" * rng.randint(1, 3 + 4 * (i % 7)) + "$" * (i % 3) for _ in range(14)), None, None, None) for i in range(9)]
    docs += [(970, "\n".join(["the same line of five words"] * 2 + [f"a{k} b{k} c{k}" for k in range(30)]), "fr", None, None)]
    got = Counter((r.doc_id, r.kept) for r in quality.judged(spark.createDataFrame(docs, DDL).repartition(3)).collect())
    assert got == Counter((d[0], bool(k)) for d, k in zip(docs, brute_kept(docs)))
    assert len({k for _, k in got}) == 2


def test_empty_table(spark):
    assert quality.judged(spark.createDataFrame([], DDL)).count() == 0
