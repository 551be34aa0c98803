import hashlib
import math

import numpy as np
import pytest
from llm_fixtures import SF
from pyspark.sql import functions as F
from sprout.llm import vector_codes as V
from sprout.llm.vector_codes import vector_codes


def plain(rows, parts=4, entries=256, rounds=4):
    """The definition in Python integers: (vec_id, code, error, label_error, sha256) of every kept row."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=1) // parts) * parts
    whole = [[math.floor(1024 * x) for x in v] + [0] * (width - len(v)) for _, v, _ in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, list(kept[k][1])))[:entries]
    step = width // parts
    cut = [[v[p * step:(p + 1) * step] for v in whole] for p in range(parts)]
    books = [[list(c[k]) for k in first] for c in cut]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            own = [nearest(x, book)[1] for x in cut[p]]
            for k in set(own):
                of = [x for x, o in zip(cut[p], own) if o == k]
                book[k] = [sum(c) // len(of) for c in zip(*of)]
    best = [[nearest(x, book) for x in cut[p]] for p, book in enumerate(books)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = [(i, "".join(f"{best[p][k][1]:02x}" for p in range(parts)), sum(best[p][k][0] for p in range(parts)), lab)
           for k, (i, _, lab) in enumerate(kept)]
    total = {}
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    return sorted((str(i), c, e, total[lab], sha) for i, c, e, lab in out)


def result(df, **kw):
    out = vector_codes(df, **kw)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows],
                                 "vec_id long, embedding array<double>, label int, code string")


def test_table(spark):
    d = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in d.collect()][:150]
    kept = d.where(F.col("vec_id").isin([r[0] for r in rows]))
    assert result(kept, entries=20) == plain(rows, entries=20)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)], int(i % 3) if i % 4 else None) for i in range(40)]
    same = [0.25] * 8
    rows += [(100 + i, same, 1) for i in range(60)]  # a hot vector: balls of radius 0
    rows += [(200, None, 1), (201, [1.0, None] * 4, 1), (202, [float("nan")] * 8, 0), (203, [float("inf")] * 8, 0)]
    rows += [(None, same, None), (None, [0.5] * 8, 2), (7, same, 0), (7, [9.0] * 8, 0)]  # ids repeat or are NULL
    rows += [(300, [], 1), (301, [1.0, -2.0], 1), (302, [0.1] * 7, None)]  # short ones
    d = frame(spark, rows).repartition(3)
    for entries in (4, 256):
        assert result(d, entries=entries) == plain(rows, entries=entries)
    assert result(d.where("false")) == []
    assert result(d.where("vec_id = 200")) == []


@pytest.mark.parametrize("size", [1e4, 1e7, 1e13])
def test_large_components_stay_exact(spark, size):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(scale=size, size=8)], 0) for i in range(80)]
    want = plain(rows, entries=6)
    most = (1 << 63) - 1
    assert result(frame(spark, rows), entries=6) == [(i, c, min(e, most), min(t, most) if e <= most else most, s)
                                                      for i, c, e, t, s in want]


def test_beyond_all_bounds(spark):
    d = frame(spark, [(1, [1e300, -1e300, 0.0, 1.0], 0), (2, [0.0] * 4, 0)])
    assert [r[2] for r in result(d, entries=1, rounds=1)] == [V.TOP, V.TOP]


@pytest.mark.parametrize("kind", ["spread", "clusters", "ties", "equal"])
def test_tree_assigns_like_brute_force(kind):
    rng = np.random.default_rng(4)
    values = {"spread": rng.integers(-500, 500, (900, 4)), "equal": np.full((50, 4), 3),
              "clusters": rng.integers(-9, 9, (900, 4)) + 400 * rng.integers(0, 6, (900, 1)),
              "ties": 2 * rng.integers(0, 4, (900, 4))}[kind].astype(np.int64)
    entries = {"ties": np.array([[x, 1, 3, 3] for x in (1, 3, 5, 1)])}.get(kind, values[rng.integers(0, len(values), 30)])
    tree = V.Tree.load(V.build(values).dump())
    assert sorted(tree.order) == list(range(len(values)))
    own, owned = np.full(len(values), -1), 0
    for entry, k, each in V.assign(tree, entries):
        place = tree.order[tree.lo[k]:tree.hi[k]]
        assert (own[place] == -1).all()
        own[place] = entry if each is None else each
        owned += len(place) if each is None else 0
        if each is None:
            assert (V.ball_sums(tree, k) == values[place].sum(0)).all()
    want = [min((int(((x - e) ** 2).sum()), k) for k, e in enumerate(entries))[1] for x in values]
    assert own.tolist() == want
    if kind in ("clusters", "equal"):
        assert owned > 0  # sums of whole balls were used


def test_balls_hold_their_points():
    values = np.random.default_rng(5).integers(-300, 300, (1000, 3))
    tree = V.build(values)
    assert tree.parent[0] == -1 and tree.lo[0] == 0 and tree.hi[0] == 1000
    for k in range(len(tree.lo)):
        points = tree.points[tree.lo[k]:tree.hi[k]].astype(float)
        assert (np.sqrt(((points - points.mean(0)) ** 2).sum(1)) <= tree.radius[k] + 1e-6).all()
        if k:
            up = tree.parent[k]
            assert up < k and tree.lo[up] <= tree.lo[k] and tree.hi[k] <= tree.hi[up]
        if tree.leaf[k]:
            assert tree.hi[k] - tree.lo[k] <= V.LEAF
