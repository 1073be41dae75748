"""Vantage-point search against brute force, and the pipeline stage by stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import decontaminate, near_dup, vptree
from quern.llm.tables import table

SF = "/root/testdata/sf0.001"


def brute(ids, x, asks, k):
    out = {}
    for q in asks:
        i = list(ids).index(q)
        s = np.cumsum(x * x[i], axis=1)[:, -1]  # component by component, as the operator and SQL add
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[int(q)] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, dim)) * spread).astype(np.float32)
    x[n // 2 : n // 2 + n // 3] = x[0]  # a third of all rows are equal
    return np.arange(n), x.astype(float)


def frame(spark, ids, x):
    return spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)], "vec_id bigint, embedding array<float>")


@pytest.mark.parametrize("dim, shard", [(3, 64), (16, 100), (8, 8192)])
def test_factor_one_is_exact(spark, dim, shard):
    ids, x = vectors(600, dim, dim)
    got = found(vptree.nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0, 20, factor=1.0, shard=shard))
    assert got == brute(ids, x, ids[ids % 20 == 0], 20)


def test_recall_of_the_default_factor(spark):
    e = table(spark, SF, "embeddings")
    rows = e.orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = brute(ids, x, ids[ids % 20 == 0], 20)
    got = found(vptree.nearest(e, F.col("vec_id") % 20 == 0))
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.9


def unequal(kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 64))
    if kind == "clustered":
        x = rng.standard_normal((60, 64))[rng.integers(0, 60, 3000)] + 0.1 * x
    if kind == "lognormal":
        x *= np.exp(rng.standard_normal((3000, 1)))
    if kind in ("1e3", "1e20"):
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        x[7] *= float(kind)
    return np.arange(3000), x


@pytest.mark.parametrize("kind", ["gauss", "clustered", "lognormal", "1e3", "1e20"])
def test_recall_on_vectors_of_unequal_length(spark, kind):
    ids, x = unequal(kind)
    want = brute(ids, x, ids[ids % 20 == 0], 20)
    got = found(vptree.nearest(frame(spark, ids, x), F.col("vec_id") % 20 == 0, shard=500, sample=1000))
    assert np.mean([len({a for a, _ in got[q]} & {a for a, _ in want[q]}) / 20 for q in want]) >= 0.95


def test_far_cells_and_branches_are_passed_over():
    ids, x = unequal("clustered")
    tree = vptree.Tree(x, ids)
    looked = tree.search(vptree.directions(x[:200])[0], ids[:200], 20, 6.0, np.full(200, -np.inf)) > -np.inf
    assert looked.mean() < 0.5
    cells = vptree.Cells(vptree.directions(x)[0], 8)
    assert cells.n == 8 and len(np.unique(cells.place(vptree.directions(x)[0]))) == 8
    u = vptree.directions(x)[0]
    assert all((cells.gaps(u)[:, c] <= np.sqrt(((u[:, None] - u[None, cells.place(u) == c]) ** 2).sum(2)).min(1) + 1e-9).all() for c in range(8))


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (100, [None, 1.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (None, [1.0, 1.0]), (2, [1.0, 1.0, 1.0]), (120, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id bigint, embedding array<float>, id int, score int")
    assert found(vptree.nearest(df, F.col("vec_id") % 20 == 0)) == {0: [(1, 2.0), (120, 0.0)], 120: [(0, 0.0), (1, 0.0)]}
    assert vptree.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    kept = {0: docs}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        out = stage(spark, kept[k - 1], SF)
        kept[k] = spark.createDataFrame(out.collect(), out.schema)
    assert all(kept[k].columns == docs.columns for k in range(1, 5))
    ids = {k: {r.doc_id for r in kept[k].select("doc_id").collect()} for k in kept}
    assert ids[2] == ids[1] and ids[3] <= ids[2] and ids[4] <= ids[3] and ids[5] == ids[4]
    classes = {r.doc_id: r.class_id for r in near_dup.classes(kept[2]).collect()}
    assert ids[3] == set(classes.values())
    bad = {r.doc_id for r in decontaminate.judged(decontaminate.overlaps(kept[3], table(spark, SF, "benchmark"))).filter("contaminated").collect()}
    assert ids[4] == ids[3] - bad
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    judged = [(i in ids[1]) == bool(labels[i]) for i in ids[0] if i in labels]
    assert np.mean(judged) > 0.9
    assert corpus_pipeline.run(spark, SF).count() == len(ids[5])


def test_pipeline_stages_messy(spark, messy, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0
        assert stage(spark, messy, SF).count() > 0
