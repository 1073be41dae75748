"""BagMinHash near-duplicates against exact similarities of all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from quern.llm import near_dup
from quern.llm.components import components
from quern.llm.words import U64, mix
from word_model import words_of  # noqa: F401


def shingle_set(text):
    w = words_of(text)
    c = Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else {}
    return frozenset((s, k) for s, n in c.items() for k in range(n))


def brute(rows):
    """Class of each id by exact similarity of every pair."""
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            if a < b and sets[a] and sets[b] and find(a) != find(b):
                common = len(sets[a] & sets[b])
                if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                    root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in sets}


def test_signature_is_unbiased():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        n = int(rng.integers(4, 60))
        a, b = rng.integers(0, 9, n), rng.integers(0, 9, n)
        b = np.where(rng.random(n) < 0.7, a, b)
        a[0] = b[0] = 1
        el = mix(rng.integers(0, 2**62, n).astype(U64))
        row, e, w = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)], np.r_[el[a > 0], el[b > 0]], np.r_[a[a > 0], b[b > 0]]
        sig = near_dup.bag_min_hash(row, e, w, 2, 512)
        errors.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randint(*edits)):
            w[rng.randrange(len(w))] = rng.choice("abcdefgh") * rng.randint(2, 9)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)]
    texts = []
    for _ in range(12):
        base = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 160)))
        texts += [base, base.upper()] + family(rng, base, 14, (0, 7))
    texts += [" ".join(["hot"] * k) for k in (3, 5, 40, 41, 60)] + ["a b c", "a b c", "a b d", "", None]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == brute(rows)


def test_hot_groups(spark):
    rng = random.Random(9)
    base = " ".join("b%d" % rng.randrange(10**6) for _ in range(120))
    texts = [base] * 300 + family(rng, base, 300, (1, 8)) + [" ".join("r%d" % rng.randrange(10**6) for _ in range(50)) for _ in range(200)]
    rows = list(enumerate(texts))
    found = {r.doc_id: r.class_id for r in near_dup.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == brute(rows)


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    near = defaultdict(set)
    for a, b in links:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for s in sorted(near):
        todo = [s] if s not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = s
                todo += near[x]
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_messy_rows(messy, nothing):
    rows = [(r.doc_id, r.class_id, r.node is None) for r in near_dup.classes(messy).collect()]
    assert len(rows) == messy.count()
    assert sorted(r for r in rows if r[0] in (1, 2)) == [(1, 1, False), (1, 1, False), (2, 1, False)]
    assert all(c == i and none for i, c, none in rows if i in (3, 4, 5, 9)) and (None, None, False) in rows
    kept = near_dup.drop_near_duplicates(messy)
    assert kept.columns == messy.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and {3, 4, 5, 9, 6, 7, None} <= set(ids)
    assert near_dup.classes(nothing).count() == 0 and near_dup.drop_near_duplicates(nothing).count() == 0


def test_rows_of_a_repeated_id_are_judged_by_their_own_texts(spark):
    a, b, c = ("%s says a thing of more than five words, and then another %s" % (x, x) for x in ("one", "two", "three"))
    rows = [(1, a), (2, a), (2, b), (2, None), (2, " "), (3, b), (4, c), (4, c), (4, a + " more"), (5, "x"), (5, c + " and more"), (5, "y"), (None, a), (None, a)]
    kept = near_dup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    want = {r: 1 for r in rows if r[1] in (a, b, c, "x", "y", " ", None) and r not in ((2, a), (3, b))}
    classes = brute(list(enumerate(t for _, t in rows)))
    for i, t in ((8, a + " more"), (10, c + " and more")):
        want |= {rows[i]: 1} if classes[i] == i else {}
    assert Counter(map(tuple, kept)) == want | {(None, a): 2}
