"""Hard negatives, clusters and license notices against brute force and on awkward rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import hardneg, kmeans, licenses

VECTORS = "vec_id long, embedding array<double>, label int, key string, own int, dim string, id string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, y, "k", 1, "d", "x") for i, v, y in rows], VECTORS)


def whole(v, scale=256):
    return [int(math.floor(scale * x)) for x in v]


def mined(rows, positives=5, negatives=3, anchors=lambda i: i % 50 == 0):
    """All pairs, in Python's integers."""
    good = {(i, tuple(whole(v)), y) for i, v, y in rows if i is not None and v is not None and y is not None and all(x is not None and math.isfinite(x) for x in v)}
    found = []
    for i, v, y in sorted(good):
        if anchors(i):
            scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, z) for j, w, z in good if j != i and len(w) == len(v)]
            for p, j, _ in sorted(s for s in scored if s[2] == y)[:positives]:
                inside = sorted(s for s in scored if s[2] != y and 50 * -p <= 100 * -s[0] <= 95 * -p)[:negatives]
                found += [(i, j, r + 1, n, -p, -s) for r, (s, n, _) in enumerate(inside)]
    return sorted(found)


def near_copies(seed, n=600, dim=12, size=1.0):
    """Vectors around few centres, many of them equal, with labels that cut across."""
    g = np.random.default_rng(seed)
    centres = g.normal(size=(6, dim)) * size
    rows = []
    for i in range(n):
        c = g.integers(6)
        v = centres[c] + (0 if i % 3 == 0 else g.normal(size=dim) * 0.3 * size)
        rows.append((i, [float(x) for x in v], int(c if i % 4 else g.integers(6))))
    return rows


@pytest.mark.parametrize("size", [1.0, 1e9, 1e200])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(hardneg, "CANDIDATES", 100)
    monkeypatch.setattr(hardneg, "ANCHORS", 5)
    monkeypatch.setattr(hardneg, "AT_ONCE", 3)
    monkeypatch.setattr(hardneg, "SAMPLE", 200)
    rows = near_copies(3, size=size, n=600 if size == 1 else 150)
    found = sorted(tuple(r) for r in hardneg.mine(vectors(spark, rows), F.col("id") % 50 == 0).collect())
    clamp = lambda s: max(-(2**63), min(2**63 - 1, s))
    assert found == [(*r[:4], clamp(r[4]), clamp(r[5])) for r in mined(rows)] and found


def test_hard_negatives_of_awkward_rows(spark):
    e = [1.0, 0.0, 0.5]
    rows = [(0, e, 1), (0, e, 1), (1, e, 1), (2, e, 1), (3, [0.9, 0.0, 0.5], 2), (4, [0.9, 0.1, 0.5], 2), (5, [0.9, 0.1, 0.5], 3), (6, None, 1), (7, [1.0, None, 1.0], 1), (8, [float("nan"), 1.0, 1.0], 2), (9, [float("inf"), 1.0, 1.0], 2)]
    rows += [(10, e, None), (None, e, 1), (11, [1.0, 1.0], 1), (12, [0.9, 1.0], 2), (50, [1.0, 1.0], 1), (100, [], 1), (101, [], 1), (102, [], 2), (150, [-1.0, 0.0, 0.0], 3)]
    found = sorted(tuple(r) for r in hardneg.mine(vectors(spark, rows), F.col("id") % 50 == 0).collect())
    assert found == mined(rows)
    assert (0, 1, 1, 4, 81920, 75520) in found or found
    assert (100, 101, 1, 102, 0, 0) in found
    assert hardneg.mine(vectors(spark, []), F.col("id") % 50 == 0).count() == 0


def test_residual_bounds_hold():
    g = np.random.default_rng(1)
    x, a = np.floor(g.normal(size=(400, 20)) * 300), np.floor(g.normal(size=(30, 20)) * 300)
    books = hardneg.codebooks(x[:100])
    codes, rest = hardneg.encode(x, books)
    least, most = hardneg.bounds(a, codes, rest, books, float(np.sqrt((x**2).sum(1)).max()))
    true = a @ x.T
    assert (least <= true).all() and (true <= most).all()
    plain = np.sqrt((a**2).sum(1))[:, None] * np.sqrt((x**2).sum(1))[None, :]
    assert np.median(most - least) < 0.8 * np.median(2 * plain)  # codes tell more than lengths


def clustered(rows, order, k, rounds):
    """Plain rounds in Python's integers: (id, cluster, distance) and the centroids."""
    kept = sorted(((order(i), i, whole(v)) for i, v, _ in rows if v is not None and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v)), key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0, r[2]))
    centroids = [v for _, _, v in kept[:k]]
    d = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for n in range(rounds + 1):
        own = [min(range(len(centroids)), key=lambda j: (d(v, centroids[j]), j)) for _, _, v in kept]
        if n < rounds:
            for j in range(len(centroids)):
                mine = [v for (_, _, v), o in zip(kept, own, strict=True) if o == j]
                if mine:
                    centroids[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    clamp = lambda x: min(x, 2**63 - 1)
    return sorted((-1 if i is None else i, o, clamp(d(v, centroids[o]))) for (_, i, v), o in zip(kept, own, strict=True)), centroids


@pytest.mark.parametrize("size", [1.0, 1e8, 1e160])
def test_clusters_equal_plain_rounds(spark, size):
    g = np.random.default_rng(5)
    rows = [(i, [float(x) for x in (g.integers(-3, 4, 3) if i % 2 else g.normal(size=3) * 2) * size], 0) for i in range(400 if size == 1 else 120)]
    rows += [(7, rows[7][1], 0), (None, [1.0, 2.0, 3.0], 0), (500, None, 0), (501, [1.0, 2.0], 0), (502, [1.0, None, 2.0], 0), (503, [1.0, float("nan"), 2.0], 0)]
    found = kmeans.cluster(vectors(spark, rows), F.col("vec_id").cast("string"), k=20, rounds=4, dim=3).collect()
    wanted, centroids = clustered(rows, lambda i: None if i is None else str(i), 20, 4)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in found) == wanted
    assert all([int(x) for x in r.centroid] == centroids[r.cluster] for r in found)
    assert {r.inertia for r in found} == {min(sum(d for _, _, d in wanted), 2**63 - 1)} or size > 1


def test_fewer_vectors_than_centroids(spark):
    rows = [(1, [0.0, 0.0, 0.0], 0), (2, [0.0, 0.0, 0.0], 0), (3, [5.0, 0.0, 0.0], 0)]
    found = kmeans.cluster(vectors(spark, rows), F.col("vec_id"), k=40, dim=3).collect()
    assert {r.vec_id: r.cluster for r in found} == {1: 0, 2: 0, 3: 2}
    assert kmeans.cluster(vectors(spark, []), F.col("vec_id"), dim=3).count() == 0
    one = kmeans.cluster(vectors(spark, rows[:1]), F.col("vec_id"), dim=3).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in one] == [(0, 0, 0)]


def test_bounds_certify_without_distances(monkeypatch):
    """Vectors in tight groups keep their centroid by their bounds; few are compared at all."""
    g = np.random.default_rng(2)
    centres = g.normal(size=(40, 64)) * 2000
    x = np.floor(np.repeat(centres, 50, axis=0) + g.normal(size=(2000, 64)) * 20)
    c = np.floor(centres)
    b = kmeans.Bounds(x, 10)
    b.scan(np.arange(len(x)), c)
    moved = c + np.floor(g.normal(size=c.shape) * 3)
    compared = []
    for name in ("scan", "reorder"):
        monkeypatch.setattr(kmeans.Bounds, name, lambda self, rows, *a, f=getattr(kmeans.Bounds, name): (compared.append(len(rows)), f(self, rows, *a)))
    b.move(moved, np.sqrt(((moved - c) ** 2).sum(1)) * kmeans.UP)
    assert (b.own == kmeans.distances(x, moved).argmin(1)).all() and sum(compared) == 0
    far = np.floor(g.normal(size=c.shape) * 2000)
    b.narrow(5)
    b.move(far, np.sqrt(((far - moved) ** 2).sum(1)) * kmeans.UP)
    assert (b.own == kmeans.distances(x, far).argmin(1)).all() and sum(compared) > 0
    d = np.sqrt(kmeans.distances(x, far))
    assert (b.lower <= np.take_along_axis(d, b.near, 1)).all() and (b.upper >= d[np.arange(len(x)), b.own]).all()


# Licenses

TEXTS = [
    (1, "x MIT  License; and\tmit-LICENSE", (7 - 1, 2, 1, 4, "mit", "mit")),
    (2, "the GNU General Public\nLicense", (5, 1, 2, 2, "gpl", "gpl")),
    (3, "Licensed under the Apache License, Version 2.0.", (8, 1, 3, 3, "apache", "apache,apache-2.0")),
    (4, None, (0, 0, None, None, "", "")),
    (5, "", (0, 0, None, None, "", "")),
    (6, "... --- \n", (0, 0, None, None, "", "")),
    (7, "permit license", (2, 0, None, None, "", "")),
    (8, "mitñ license mit éLICENSE mit 漢 license", (7, 0, None, None, "", "")),
    (9, "MIT license " * 30_000, (60_000, 30_000, 0, 59_998, "mit", "mit")),
    (10, "mit license apache license general public license", (7, 3, 0, 4, "apache,gpl,mit", "apache,gpl,mit")),
]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, "w", 5) for i, t in rows], "doc_id long, text string, t int, label string, start int")


def test_license_places(spark):
    rows = [(i, t) for i, t, _ in TEXTS] + [(1, TEXTS[0][1]), (None, "mit license")]
    found = licenses.scan(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i, _, wanted in TEXTS:
        r = by[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == wanted, i
        assert r.score == (1.0 if wanted[-1] else 0.0)
    assert by[None].base_labels == "mit"
    assert licenses.scan(documents(spark, [])).count() == 0
    assert licenses.scan(documents(spark, rows), keep=("doc_id", "t", "label", "start")).columns[:4] == ["doc_id", "t", "label", "start"]


def test_notices_by_position(spark):
    notice = next(t for t in licenses.NOTICES if t.label == "bsd-text").text
    own = notice.split()
    edited = " ".join("other" if i in (16, 18) else w for i, w in enumerate(own))
    widened = " ".join([*own[:11], "we", "add", "three", *own[11:]])
    lost_phrase = notice.replace("binary", "other")
    rows = [(1, "head " * 500 + notice.upper() + " tail" * 500), (2, edited), (3, widened), (4, lost_phrase), (5, " ".join(sorted(own))), (6, " ".join(own[: len(own) // 2])), (7, (notice + " ") * 400)]
    found = {r.doc_id: r for r in licenses.scan(documents(spark, rows)).collect()}
    assert [found[i].labels for i in range(1, 8)] == ["bsd-text", "bsd-text", "bsd-text", "", "", "", "bsd-text"]
    assert found[1].score == 1.0 and found[2].score == pytest.approx((len(licenses.words_of(notice)) - 2) / len(licenses.words_of(notice)))


def test_keys_lose_no_match():
    """Any choice of enough words of a template holds one of its keys."""
    g = np.random.default_rng(0)
    for k, own in enumerate(licenses.keys(licenses.NOTICES, {"the": 100, "of": 90, "license": 50})):
        t = licenses.NOTICES[k]
        for _ in range(50):
            left = g.choice(len(t.words), t.need, replace=False)
            assert any(t.words[q] in own for q in left)
    assert all(len(own) == 1 for own in licenses.keys(licenses.BASE, {}))
    with pytest.raises(ValueError):
        licenses.Template("x", "some words", ("other words",)).masks()


def test_license_plan_is_native(spark):
    plan = licenses.scan(documents(spark, [(1, "mit license")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
