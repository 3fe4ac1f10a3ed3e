import hashlib
import re
from collections import defaultdict
from fractions import Fraction

from lanemesh.llm import mixing

DDL = "doc_id long, text string, source string, size string, h string"


def brute(docs, weights=(5, 2, 1), most=3):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    h = lambda i: int(hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()[:15], 16)
    total = defaultdict(int)
    for _, t, s, *_ in docs:
        total[s] += size(t)
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [None] * (None in total)
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, target, open_ = Fraction(sum(total.values())), {}, list(order)
    while open_:  # share, cut, share what is over again
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * total[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = Fraction(most * total[s])
            left -= target[s]
            open_.remove(s)
    out = []
    threshold = {}
    for s in order:
        times = int(target[s] / total[s]) if total[s] else 0
        budget, through, limit = target[s] - times * total[s], 0, 0
        sums = defaultdict(int)
        for i, t, x, *_ in docs:
            if x == s:
                sums[h(i)] += size(t)
        for v in sorted(sums):
            after = through + sums[v]
            if budget > 0 and (after <= budget or (through <= budget and after - budget <= budget - through)):
                limit = v + 1
            if after > budget:
                break
            through = after
        threshold[s] = (times, limit)
    for i, t, s, *_ in docs:
        times, limit = threshold[s]
        out.append((i, size(t), total[s], round(float(target[s]), 6), size(t) * (times + (h(i) < limit))))
    return sorted(out, key=str)


def corpus():
    docs = [(i, "w " * (i % 37 + 1), "abcdefgh"[i % 8 if i % 3 else 0], "x", "y") for i in range(900)]
    return docs + [(2000, None, "a", None, None), (2001, "", "zz", None, None), (2002, "one two", None, None, None), (None, "a b c", None, None, None), docs[5], docs[5], (3000, "long " * 20000, "b", None, None)]


def got(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in mixing.mixed(df).collect()), key=str)


def test_equals_brute_force_and_reruns_agree(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, DDL)
    first = got(df.repartition(5))
    assert first == brute(docs)
    assert got(df.repartition(2)) == first


def test_takes_come_near_targets_and_stay_under_three_times(spark):
    docs = [(i, "word " * 10, "src" + str(i % 5), "", "") for i in range(4000)]
    rows = mixing.mixed(spark.createDataFrame(docs, DDL)).collect()
    target, taken = {}, defaultdict(int)
    for r in rows:
        assert r.taken <= 3 * r.size
        target[r.doc_id % 5] = r.target
        taken[r.doc_id % 5] += r.taken
    assert all(abs(taken[k] - target[k]) <= 10 for k in target)


def test_smaller_budgets_take_subsets(spark):
    sizes = mixing.sized(spark.createDataFrame(corpus(), DDL)).where("source = 'a'")
    budgets = spark.createDataFrame([("a", k, float(b)) for k, b in enumerate((50, 500, 3000))], "source string, budget_id int, budget double")
    t = {r.budget_id: r.threshold for r in mixing.thresholds(sizes, budgets).collect()}
    assert t[0] < t[1] < t[2]


def test_empty_and_wordless_tables(spark):
    assert mixing.mixed(spark.createDataFrame([], DDL)).count() == 0
    rows = mixing.mixed(spark.createDataFrame([(1, None, None, None, None), (2, " ", "a", None, None)], DDL)).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2
