"""Decontamination, ranked search and hard negatives against brute force, and on awkward rows."""

import math
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import decontamination, lexical, negatives

NAN, INF = float("nan"), float("inf")
CLASHING = ("found", "other", "doc", "name", "part", "size", "shard", "item", "query", "n", "terms", "tfs", "score", "rank", "label_", "id",
            "vec", "dim", "region", "salt", "block", "window", "low", "high", "text_", "starts", "ends", "items", "n_words")


def clashing(df):
    for name in CLASHING:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("clash"))
    return df


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def draw_text(seed, n, of=6):
    draw = random.Random(seed)
    return " ".join(draw.choice("ab cd ef gh ij kl mn op qr st".split()[:of]) for _ in range(n))


ITEMS = [(1, draw_text(1, 30)), (2, draw_text(2, 12)), (2, draw_text(3, 25)), (3, "AB cd"), (4, "zz"), (5, None), (6, " ,.; "), (None, draw_text(4, 14)),
         (7, draw_text(1, 30)), (8, "é-ß " + draw_text(5, 9)), (10, draw_text(6, 300, 10)), (3, "AB cd")]
TEXTS = [(1, None), (2, ""), (3, " ,;\n"), (4, draw_text(1, 30) + " x y " + draw_text(2, 12)), (5, draw_text(9, 400)), (6, "Ab, CD! zz"),
         (7, "pre " + draw_text(4, 14).upper() + " post"), (7, "pre " + draw_text(4, 14).upper() + " post"), (None, draw_text(3, 25)),
         (8, "é ß " + draw_text(5, 9)), (9, draw_text(6, 300, 10)), (11, draw_text(10, 3000)), (12, "nothing here at all")]


def covered(text, items, window):
    """Brute force: positions covered, and names of items whose windows occur."""
    mine, hit, names = words(text), set(), set()
    for name, item in items:
        theirs = words(item)
        size = min(window, len(theirs))
        for k in range(len(theirs) - size + 1 if size else 0):
            for at in range(len(mine) - size + 1):
                if mine[at:at + size] == theirs[k:k + size]:
                    hit |= set(range(at, at + size))
                    names |= {name}
    return hit, sorted(str(n) for n in names if n is not None)


@pytest.fixture(scope="module")
def items(spark):
    return clashing(spark.createDataFrame(ITEMS, "item_id long, text string")).cache()


@pytest.fixture(scope="module")
def texts(spark):
    return clashing(spark.createDataFrame(TEXTS, "doc_id long, text string")).repartition(3).cache()


@pytest.mark.parametrize("shard", [100_000, 120])  # one automaton, and several that each find a part
def test_overlaps(texts, items, shard):
    expected = Counter()
    for doc, text in TEXTS:
        hit, names = covered(text, ITEMS, 10)
        expected[doc, len(words(text)), tuple(sorted(hit)), tuple(names)] += 1
    assert sum(len(k[2]) > 0 for k in expected) > 5
    found = decontamination.overlaps(texts, items, "leaks", shard=shard).collect()
    assert Counter((r["doc_id"], r["leaks"]["n_words"], tuple(p for s, e in zip(r["leaks"]["starts"], r["leaks"]["ends"]) for p in range(s, e)),
                    tuple(r["leaks"]["items"])) for r in found) == expected
    for r in found:
        assert all(e < s for e, s in zip(r["leaks"]["ends"], r["leaks"]["starts"][1:]))


def test_automaton_on_random_words():
    for seed in range(60):
        draw = random.Random(seed)
        some = [(str(i), " ".join(draw.choice("abc") for _ in range(draw.randint(1, 14)))) for i in range(6)]
        made = decontamination.Automaton([(n, t.encode().split()) for n, t in some], 4)
        text = " ".join(draw.choice("abcd") for _ in range(60))
        longest, starts, ends, names = made.match(text.encode().split())
        hit, expected = covered(text, some, 4)
        assert (sorted(p for s, e in zip(starts, ends) for p in range(s, e)), sorted(names)) == (sorted(hit), expected)
        joined = [" ".join(text.split()[a:b]) for a in range(60) for b in range(a + 1, 61) if b - a > 3]
        runs = [len(j.split()) for j in joined if any(re.search(rf"\b{j}\b", t) for _, t in some)]
        assert max(runs, default=0) == (longest if longest >= 4 else 0)


def test_decontaminate(spark, texts, items):
    found = decontamination.decontaminate(texts, items, coverage=0.6)
    assert found.columns == texts.columns
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    assert got[1] is None and got[2] == "" and got[3] == " ,;\n" and got[12] == "nothing here at all"
    assert 9 not in got and 7 not in got and None not in got  # covered beyond the limit
    longer = draw_text(77, 80, 10)
    some = clashing(spark.createDataFrame([(1, f"{longer}. {draw_text(2, 12)}? End.")], "doc_id long, text string"))
    one = spark.createDataFrame([(2, draw_text(2, 12))], "item_id long, text string")
    assert decontamination.decontaminate(some, one).first()["text"] == f"{longer}. ? End."
    with pytest.raises(ValueError):
        decontamination.overlaps(texts, items, "found")


def test_decontamination_of_and_by_nothing(spark, texts, items):
    nothing = texts.limit(0)
    assert decontamination.overlaps(nothing, items, "leaks").count() == 0
    for empty in (items.limit(0), items.filter("item_id in (5, 6)")):
        found = decontamination.overlaps(texts, empty, "leaks").select("doc_id", "leaks.*").collect()
        assert Counter((r["doc_id"], r["n_words"]) for r in found) == Counter((d, len(words(t))) for d, t in TEXTS)
        assert not any(r["starts"] or r["items"] for r in found)
        assert decontamination.decontaminate(texts, empty).count() == len(TEXTS)


def test_long_text_with_many_matches(spark):
    one = spark.createDataFrame([(2, draw_text(2, 12))], "item_id long, text string")
    text = " x ".join([draw_text(2, 12)] * 50_000)
    start = time.time()
    found = decontamination.decontaminate(spark.createDataFrame([(1, text)], "doc_id long, text string"), one, coverage=1.0).first()
    assert set(found["text"].split()) == {"x"} and time.time() - start < 30


def terms(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k):
    docs = [(d, terms(t)) for d, t in docs if d is not None]
    docs = [(d, t, Counter(t)) for d, t in docs if t]
    total, length = len(docs), sum(len(t) for _, t, _ in docs)
    df = Counter(t for _, _, c in docs for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = {}
    for i, some in asked.items():
        scores = []
        for d, t, c in docs:
            m = 50 + 50 * len(t) * total // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 20 * m))
                        for w in some if c[w])
            if score > 0:
                scores.append((-score, d))
        out[i] = [(d, -s) for s, d in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("k", [3, 50])
def test_search(texts, items, k):
    expected = {(i, n + 1, d, s) for i, found in ranked(TEXTS, ITEMS, k).items() for n, (d, s) in enumerate(found)}
    found = [tuple(r) for r in lexical.search(texts, items, k=k).collect()]
    assert len(found) == len(expected) > 15 and set(found) == expected


def test_search_for_and_in_nothing(texts, items):
    assert lexical.search(texts.limit(0), items).count() == 0
    assert lexical.search(texts.filter("doc_id < 4"), items).count() == 0
    assert lexical.search(texts, items.limit(0)).count() == 0
    assert lexical.search(texts, items.filter("item_id in (5, 6)")).count() == 0


def test_blocks_of_items(texts, items, monkeypatch):
    whole = sorted(map(tuple, lexical.search(texts, items).collect()))
    monkeypatch.setattr(lexical, "BLOCK", 5)
    assert sorted(map(tuple, lexical.search(texts, items).collect())) == whole


def test_segments_keep_the_best_and_skip_the_rest():
    draw = np.random.default_rng(5)
    skipped = 0
    for trial in range(40):
        n, k = 200, 5
        held = [(d, t, int(draw.integers(1, 30) * 4 ** (6 - t // 2))) for d in range(n) for t in range(12) if draw.random() < 0.1 + 0.07 * t]
        docs, of, impacts = (np.array(x) for x in zip(*held))
        pairs = [(a, b) for a in range(6, 12) for b in range(a + 1, 12)]
        segment = lexical.Segment(np.arange(n) * 3, docs, of, impacts, np.array(pairs), k)
        asked = sorted(set(draw.integers(0, 12, 8).tolist()))
        total = np.zeros(n, np.int64)
        for d, t, i in held:
            total[d] += i * (t in asked)
        order = sorted((-int(s), d * 3) for d, s in enumerate(total) if s)[:k]
        for floor in (0, -order[-1][0]):
            ids, scores = lexical.best(*segment.search(asked, pairs, floor), k)
            assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == order
        skipped += len(segment.search(asked, pairs, -order[-1][0])[0]) < (total > 0).sum()
    assert skipped > 30


def test_pair_bounds_are_below_the_sum_and_hold():
    docs, of = np.array([0, 0, 1, 2, 3]), np.array([0, 1, 0, 1, 1])
    impacts = np.array([2, 2, 9, 8, 1])
    segment = lexical.Segment(np.arange(4), docs, of, impacts, np.array([[0, 1]]), 1)
    assert segment.pairs[0, 1][0].tolist() == [0] and segment.joint[0, 1] == 4
    assert segment._bounds([0, 1], [(0, 1)])[0] == [9, 8, 0]  # 17 without the pair list


def vectors(spark, rows):
    return clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).repartition(3)


def mined(rows, asked, positives=5, negatives=3):
    good = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not np.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        good[i] = min(good.get(i, row), row)
    out = set()
    for a, (label, x) in good.items():
        if not asked(a):
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y)), i, their) for i, (their, y) in good.items() if i != a and len(y) == len(x))
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            fit = [s for s in scores if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            out |= {(a, i, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(fit)}
    return out


def cloud(seed, n, dim=8):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((9, dim))
    points = centres[draw.integers(0, 9, n)] + draw.standard_normal((n, dim)) * 0.4
    points[:n // 3] = points[0]  # a third are copies
    return [(int(i), [float(x) for x in np.float32(p)], int(i % 4)) for i, p in enumerate(points)]


ODD = [(9001, None, 1), (9002, [0.0] * 8, 1), (9003, [NAN] + [1.0] * 7, 1), (9004, [INF] + [1.0] * 7, 1), (9005, [None] + [1.0] * 7, 1),
       (9006, [], 1), (9015, [], 2), (None, [1.0] * 8, 1), (9007, [1.0] * 5, 1), (9014, [1.1] * 5, 1), (9008, [0.9] * 5, 2), (9010, [1.0] * 8, None),
       (7, [1.0] * 8, 0), (7, [1.0] * 8, 0)]


def test_hard_negatives(spark):
    rows = cloud(1, 700) + ODD
    expected = mined(rows, lambda i: i % 7 == 0)
    found = [tuple(r) for r in negatives.hard_negatives(vectors(spark, rows), "id % 7 = 0").collect()]
    assert len(found) == len(expected) > 300 and set(found) == expected
    assert {r[0] for r in expected} & {9002, 9007, 9014}


def test_hard_negatives_over_many_regions(spark, monkeypatch):
    for name, value in (("CHUNK", 60), ("ANCHORS", 10), ("FAN", 2)):
        monkeypatch.setattr(negatives, name, value)
    rows = cloud(2, 900)
    found = [tuple(r) for r in negatives.hard_negatives(vectors(spark, rows), "id % 10 = 0").collect()]
    expected = mined(rows, lambda i: i % 10 == 0)
    assert len(found) == len(expected) > 200 and set(found) == expected


def test_hard_negatives_of_nothing(spark):
    for rows in ([], ODD[:1]):
        assert negatives.hard_negatives(vectors(spark, rows), "id % 7 = 0").count() == 0
    assert negatives.hard_negatives(vectors(spark, cloud(1, 30)), "id < 0").count() == 0


def test_siblings_are_passed_over_only_if_their_ranges_miss_the_window():
    draw = np.random.default_rng(8)
    centres = draw.standard_normal((6, 12)) * 300
    matrix = np.floor(centres[draw.integers(0, 6, 3000)] + draw.standard_normal((3000, 12)) * 20).astype(np.int64)
    ids, labels = draw.permutation(3000).astype(np.int64), draw.integers(0, 3, 3000)
    tree, anchors = negatives.Tree(ids, labels, matrix), matrix[:50]
    best = np.sort(negatives.scores_of(anchors, matrix), axis=1)
    looked = 0
    for low, high in ((best[:, -20], best[:, -3]), (best[:, 1500], best[:, 1510]), (best[:, 0] * 0 - 2 ** 62, best[:, 0])):
        asked = negatives.Asked(ids[:50], labels[:50], anchors, np.arange(50), low, high, 3, False)
        compare = asked.compare
        asked.compare = lambda active, some, *rest: (seen.append(len(active) * len(some)), compare(active, some, *rest))
        seen = []
        tree.search(asked, np.arange(50))
        looked += sum(seen)
        for a in range(50):
            scores = matrix @ anchors[a]
            fit = sorted((-int(s), int(i)) for s, i, l in zip(scores, ids, labels) if l != labels[a] and low[a] <= s <= high[a])[:3]
            got = [(-s, i) for s, i in zip(asked.scores[a].tolist(), asked.found[a].tolist()) if s > np.iinfo(np.int64).min]
            assert got == fit
    assert looked < 0.7 * 3 * 50 * 3000
