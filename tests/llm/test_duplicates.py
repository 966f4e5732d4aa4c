"""SimHash groups, similar vectors and components against brute force."""

import random

import numpy as np
import pytest
import xxhash

from limnos.llm import components as stars
from limnos.llm import simhash, vectors


def union(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("n", [400, 60])
def test_components(spark, n):
    rng = random.Random(n)
    pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(n // 2)] + [(i, i + 1) for i in range(n - 40, n - 1)] + [(3, 3)]
    got = {r.node: r.root for r in stars.components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    want = union(n, pairs)
    assert all(got.get(i, i) == want[i] for i in range(n))
    assert stars.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rooted_in_a_task():
    rng = np.random.default_rng(1)
    for n in (1, 5, 300):
        left, right = rng.integers(0, n, n // 2), rng.integers(0, n, n // 2)
        assert stars.rooted(n, left, right).tolist() == union(n, zip(left.tolist(), right.tolist()))


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_groups_against_all_pairs(request, which):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (rows[i][1] ^ rows[j][1]).bit_count() <= 4]
    root = union(len(rows), pairs)
    least = {k: min((rows[i][0] for i in range(len(rows)) if root[i] == k and rows[i][0] is not None), default=None) for k in set(root)}
    key = lambda t: tuple((x is not None, x or 0) if not isinstance(x, str) else x for x in t)
    want = sorted((key((d, f"{p:016x}", least[root[i]])) for i, (d, p) in enumerate(rows)))
    got = sorted(key((r.doc_id, r.fingerprint, r.component_id)) for r in simhash.digest(simhash.duplicate_groups(docs)).collect())
    assert got == want


def test_large_postings_lose_no_link(spark, monkeypatch):
    """Chains and clusters of near fingerprints, with limits so low that all ways of dividing are taken."""
    monkeypatch.setattr(simhash, "POSTING", 16)
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(400):
        prints.append(prints[rng.randrange(len(prints))] ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))))
    centre = rng.getrandbits(64)
    prints += [centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a)]
    prints = sorted(set(p & (2**64 - 1) for p in prints))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "print bigint")).distinct().collect()
    at = {p: i for i, p in enumerate(signed)}
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert union(len(prints), [(at[r.a], at[r.b]) for r in found]) == union(len(prints), pairs)


@pytest.mark.parametrize("n", [300, 40])
def test_wide_and_narrow_postings(n):
    rng = random.Random(n)
    prints = np.array([rng.getrandbits(12) for _ in range(n)], np.uint64)
    a, b = simhash._links_of(np.zeros(n, np.int64), prints)
    values = prints.tolist()
    at = {}
    for i, v in enumerate(values):
        at.setdefault(v, i)
    pairs = [(i, j) for i in range(n) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4]
    same = [(i, at[v]) for i, v in enumerate(values)]
    assert union(n, [(at[x], at[y]) for x, y in zip(a.tolist(), b.tolist())] + same) == union(n, pairs)


def test_one_of_each(edges, nothing):
    kept = simhash.one_of_each(edges)
    assert kept.schema == edges.schema
    groups = simhash.duplicate_groups(edges).select("component_id").distinct().count()
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is not None, x or 0))
    assert len(ids) == groups and ids.count(1) == 1
    assert simhash.one_of_each(nothing).count() == 0


def vector_rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * 0.12).astype(np.float32).tolist(), i % 3) for i in range(240)]
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(30)]  # copies
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] * 16, 1), (2004, [float("inf")] * 16, 1), (2005, rows[5][1], None),
             (2006, rows[5][1][:8], rows[5][2]), (2007, [], 1), (2008, [3 * x for x in rows[5][1]], rows[5][2]), (2009, rows[5][1], 77), (None, rows[7][1], rows[7][2]), (2010, [-0.0, *[1.0] * 15], 5), (2011, [0.0, *[1.0] * 15], 5)]
    return rows


@pytest.mark.parametrize("block", [2048, 20])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    if block == 20:
        monkeypatch.setattr(vectors, "PIECE", 4)
    rows = vector_rows()
    good = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]

    def linked(i, j):
        if not (good[i] and good[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])):
            return False
        x, y = np.array(rows[i][1], float), np.array(rows[j][1], float)
        return x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98

    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if linked(i, j)]
    root, n = union(len(rows), pairs), np.bincount([k for p in pairs for k in p], minlength=len(rows))
    least = {k: min((rows[i][0] for i in range(len(rows)) if root[i] == k and rows[i][0] is not None), default=None) for k in set(root)}
    want = {rows[i][0]: (int(n[i]), least[root[i]]) for i in range(len(rows))}
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id bigint, embedding array<float>, label int, block string, node string").repartition(3)
    got = vectors.similar_vectors(df, block=block).collect()
    assert len(got) == len(rows) and {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert vectors.similar_vectors(df.where("1 = 0")).count() == 0
