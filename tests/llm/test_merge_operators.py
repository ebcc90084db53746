"""Repeated passages, source divergence and simplex clustering against brute force, and on awkward rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import bwt_merge, divergence, simplex
from tests.llm.plain import EDGES, edge_docs


def plain_cut(texts, length):
    """n_bytes, n_removed, n_spans, kept_sha256 of every text."""
    bodies, at = [(t or "").encode() for t in texts], defaultdict(list)
    for i, b in enumerate(bodies):
        for j in range(len(b) - length + 1):
            at[b[j:j + length]].append((i, j))
    gone = [bytearray(len(b)) for b in bodies]
    for places in at.values():
        for i, j in places if len(places) > 1 else ():
            gone[i][j:j + length] = b"\1" * length
    return [(len(b), sum(g), sum(x and not (i and g[i - 1]) for i, x in enumerate(g)), hashlib.sha256(bytes(c for c, x in zip(b, g) if not x)).hexdigest())
            for b, g in zip(bodies, gone)]


def passages(length, seed=3):
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abcdefgh é", k=rng.randint(length // 2, 3 * length))) for _ in range(6)]
    texts = []
    for _ in range(120):
        t = "".join(rng.choices("abcdefghij klmé", k=rng.randint(0, 2 * length)))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(shared)
            a = rng.randint(0, len(p) // 2)
            t += p[a:a + rng.randint(length // 2, len(p))] + "".join(rng.choices("xyz", k=rng.randint(0, length // 3)))
        texts.append(t)
    texts += texts[:5] + ["a" * (3 * length), "ab" * length * 2, None, "", "a" * (length - 1), "q" * length]
    for t in [t for t in texts[20:40] if t]:
        k = rng.randint(0, len(t))
        texts.append(t[:k] + "Z" + t[k:])
    return texts


@pytest.mark.parametrize(("length", "shard"), [(20, 300), (400, 3000)])
def test_cut_equals_brute_force_over_many_shards(spark, length, shard):
    texts = passages(length)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in bwt_merge.cut_repeats(docs, length, shard_bytes=shard, with_text=True).collect()}
    want = plain_cut(texts, length)
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == dict(enumerate(want))
    assert sum(w[1] for w in want) > 1000
    for i, r in got.items():
        body = (texts[i] or "").encode()
        gone = {b for s in r["spans"] for b in range(s["start"], s["end"])}
        assert bytes(r["kept"]) == bytes(c for b, c in enumerate(body) if b not in gone)


def test_cut_on_awkward_rows(spark):
    rows = [*EDGES, (9, "x" * 401), (10, EDGES[4][1][:5000])]
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in bwt_merge.cut_repeats(edge_docs(spark, rows)).collect())
    assert got == sorted(plain_cut([t for _, t in rows], 400))
    assert bwt_merge.cut_repeats(edge_docs(spark).limit(0)).count() == 0


def test_smallest_hash_runs_cover_all_strings():
    rng = np.random.default_rng(1)
    body = bytes(rng.integers(97, 100, 3000, dtype=np.uint8)) + b"z" * 900
    value, start, n, many = bwt_merge.anchors(body, 100)
    assert n.sum() == len(body) - 99 and (start == np.cumsum(n) - n).all()
    by_string = defaultdict(set)
    for v, s, m in zip(value, start, n):
        for j in range(s, s + m):
            by_string[body[j:j + 100]].add(int(v))
    assert all(len(v) == 1 for v in by_string.values())  # equal strings, equal hash
    assert many[value == value[-1]].all()


def plain_audit(rows, least, top):
    import re
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(a or "", s or "", term.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))) for a, s, t in rows]
    held, use, groups = Counter(), defaultdict(Counter), {(a, s) for a, s, _ in docs}
    for a, s, w in docs:
        held.update((a, x) for x in set(w))
        use[a, s].update(w)
    out = set()
    for a, s in groups:
        kept = [x for (b, x), n in held.items() if b == a and n >= least]
        whole = Counter()
        for (b, _), c in use.items():
            if b == a:
                whole.update(c)
        share = lambda c: {x: 1 + 10**9 * (c[x] + 5) // (sum(c[y] for y in kept) + 5 * len(kept)) for x in kept}
        p, q = share(use[a, s]), share(whole)
        pairs = [(sum(abs(p[x] - o[x]) for x in kept), t) for b, t in groups if b == a and t != s for o in [share(use[b, t])]]
        terms = [(p[x] - q[x], x) for x in kept if use[a, s][x] and p[x] > q[x]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
            out |= {(a, s, part, item, v, i) for i, (v, item) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_audit_equals_brute_force(spark, block):
    rng = random.Random(2)
    words = ["Éa", "b", "zoo", "Zoo", "ünder", "ab", "AB", "x1y", "中文", "k"] + [f"w{chr(97 + i)}" for i in range(15)]
    rows = [(rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None]), " ".join(rng.choices(words, k=rng.randint(0, 30)))) for _ in range(150)]
    rows += [("xx", "only", "rare words"), ("xx", "other", None), ("en", "none", ""), ("en", "s1", "b " * 9000)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, block int, term string").repartition(5)
    got = {tuple(r) for r in divergence.audit(docs, 5, 7, block).collect()}
    assert got == plain_audit(rows, 5, 7)
    assert divergence.audit(docs.limit(0)).count() == 0


def test_galloping_and_shares():
    rng = np.random.default_rng(3)
    for n, m in ((0, 5), (1, 1), (3, 400), (50, 60), (200, 2)):
        a, b = (np.sort(rng.choice(500, size=k, replace=False)).astype(np.int64) for k in (n, m))
        at_a, at_b = divergence.galloping(a, b)
        assert a[at_a].tolist() == b[at_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
    n, total, terms = np.array([0, 1, 10**13, 7], dtype=np.int64), 3 * 10**13, 10**6
    assert divergence.shares(n, total, terms).tolist() == [1 + 10**9 * (int(x) + 5) // (total + 5 * terms) for x in n]


def plain_cluster(rows, k, rounds):
    kept = [(i, [256 * a // b for a, b in (float(x).as_integer_ratio() for x in v)]) for i, v in rows]
    seeds = sorted(kept, key=lambda r: hashlib.sha256(f"2:{r[0]}".encode()).hexdigest())[:k]
    cent = [list(v) for _, v in seeds]
    to = lambda v: min((sum((a - b)**2 for a, b in zip(v, c)), j) for j, c in enumerate(cent))
    for _ in range(rounds):
        at = [to(v)[1] for _, v in kept]
        for j in range(len(cent)):
            mine = [v for (_, v), a in zip(kept, at) if a == j]
            if mine:
                cent[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = [(i, *to(v)) for i, v in kept]
    per, digest = Counter(), [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    for _, d, j in found:
        per[j] += d
    return sorted((i, j, d, per[j], sum(per.values()), digest[j]) for i, d, j in found)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(i, (rng.normal(size=8) + 3 * (i % 5)).round(2).tolist()) for i in range(200)]
    rows += [(500 + i, rows[0][1]) for i in range(20)] + [(600, [0.0] * 8), (601, [-0.001] * 8)]
    odd = [(700, None), (701, [1.0] * 7), (702, [None] + [1.0] * 7), (703, [float("nan")] * 8), (704, [float("inf")] * 8), (705, [])]
    table = spark.createDataFrame([(i, v, 0, 1) for i, v in rows + odd], "vec_id long, embedding array<double>, cluster int, v int").repartition(5)
    got = sorted(tuple(r) for r in simplex.cluster(table, k=12, rounds=3, dimension=8, pivots=5).collect())
    assert got == plain_cluster(rows, 12, 3)
    assert simplex.cluster(table.limit(0)).count() == 0
    few = table.where("vec_id < 3")
    assert {r["distance"] for r in simplex.cluster(few, k=12, rounds=2, dimension=8).collect()} == {0}


def test_clusters_of_huge_components_stay_exact(spark):
    rows = [(i, [float(10**12 * (i % 3) + i), 0.5]) for i in range(30)] + [(40, [1e300, -1e300])]
    got = simplex.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=4, rounds=2, dimension=2).collect()
    fits = lambda n: n if n < 1 << 63 else None
    want = [(i, j, fits(d), fits(c), fits(w), h) for i, j, d, c, w, h in plain_cluster(rows, 4, 2)]
    assert sorted((r["vec_id"], r["cluster"], r["distance"], r["centroid_sha256"]) for r in got) == sorted((i, j, d, h) for i, j, d, c, w, h in want)


def test_bounds_enclose_the_distances_and_save_work():
    rng = np.random.default_rng(9)
    centres = rng.normal(scale=400, size=(20, 64))
    v = np.floor(centres[rng.integers(0, 20, 500)] + rng.normal(scale=60, size=(500, 64))).astype(np.int64)
    cent = np.floor(centres).astype(np.int64)
    base = simplex.pivot_base(cent[:8].astype(float))
    apex, of = (simplex.simplex_apex(simplex.distances(x.astype(float), cent[:8].astype(float)[base[:, 0].astype(int)]), base[:, 1:]) for x in (v, cent))
    low, high = simplex.bounds(apex, of)
    true = ((v[:, None, :] - cent[None, :, :])**2).sum(axis=2)
    assert (low <= true * (1 + 1e-9) + 1e-3).all() and (high >= true * (1 - 1e-9) - 1e-3).all()
    to, best, compared = simplex.nearest(v, apex, cent, of)
    assert (to == true.argmin(axis=1)).all() and (best == true.min(axis=1)).all() and compared < 0.7 * true.size


def test_rules_of_the_package():
    from pathlib import Path
    import re
    for p in (Path(bwt_merge.__file__).parent).glob("*.py"):
        text = p.read_text()
        assert "localCheckpoint" not in text and "crossJoin" not in text and not re.search(r"F\.udf\(|\.rdd\b", text), p
