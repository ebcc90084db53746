"""Sharding, Jaccard join, search, tool calls, fixity audit and the pipeline against plain versions."""

import itertools
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

import corpus_pipeline
from riskframe.llm import components as cc, jaccard, packing, q_line_crf, q_spann, q_warc, quality_rules as qr, secrets, shards, shingles as sh, spann, tool_calls, warc
from tests.llm.plain import EDGES, component_ids, edge_docs, rule_counts


def near_copies(seed=4, groups=12, size=6):
    """Groups of texts, each a little further from the last, so that only neighbours link."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows = []
    for _ in range(groups):
        w = [word() for _ in range(60)]
        for _ in range(size):
            rows.append(" ".join(w))
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = word()
    passage = " ".join(word() for _ in range(25))
    rows += [passage + " " + " ".join(word() for _ in range(rng.randint(5, 40))) for _ in range(25)]
    rows += [rows[0], rows[0].upper(), "", " ", "one", "ONE", "a b c d e", "a b c d e f"]
    return list(enumerate(rows, 1))


@pytest.mark.parametrize("limits", [None, (400, 3, 3)])
def test_components_match_brute_force(spark, monkeypatch, limits):
    if limits:  # tiny tasks: every region is split into cells and blocks
        for name, v in zip(("REGION", "MEMBERS", "PIVOTS"), limits, strict=True):
            monkeypatch.setattr(jaccard, name, v)
    rows = near_copies()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.with_components(edge_docs(spark, rows).repartition(4)).collect()}
    assert got == {i: (len(sh.shingle_set(t)), c) for (i, t), c in zip(rows, component_ids(rows), strict=True)}


def test_region_join_is_exact_on_random_sets():
    rng = np.random.default_rng(6)
    for _ in range(30):
        base = rng.choice(2**40, size=60, replace=False).astype(np.uint64)
        sets = [np.unique(np.concatenate([rng.choice(base, size=rng.integers(20, 60), replace=False), rng.integers(0, 2**40, rng.integers(0, 8)).astype(np.uint64)]))
                for _ in range(25)]
        root = list(range(25))

        def find(i, root=root):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in jaccard.join_region(np.arange(25), sets, 75):
            assert sh.linked(sets[a], sets[b])
            root[find(a)] = find(b)
        for i in range(25):
            for j in range(i):
                assert not sh.linked(sets[i], sets[j]) or find(i) == find(j)


def test_prefixes_share_what_they_must():
    rng = np.random.default_rng(7)
    for _ in range(2000):
        base = np.sort(rng.choice(10_000, size=rng.integers(1, 80), replace=False)).astype(np.uint64)
        a = base[rng.random(len(base)) < 0.93]
        b = np.unique(np.concatenate([base[rng.random(len(base)) < 0.95], rng.integers(10_000, 20_000, 2).astype(np.uint64)]))
        if len(a) and len(b) and sh.linked(a, b):
            (pa, na), (pb, nb) = jaccard.needs(len(a), 75), jaccard.needs(len(b), 75)
            assert len(set(a[:pa].tolist()) & set(b[:pb].tolist())) >= max(na, nb) >= 1


def test_sets_need_one_python_worker_and_hold_every_class_asked_for(spark):
    docs = spark.createDataFrame([(f"one two three four five six{i} seven{i % 7}",) for i in range(300)] + [(None,), ("",)], "text string").repartition(5)
    keys = sorted({sh.set_key(s) for s in sh.texts_sets([r.text for r in docs.collect()])} - {0})
    wanted = keys[::3]
    got = jaccard._sets(docs, spark.createDataFrame([(k,) for k in wanted], "cid long"))
    rows = {r.cid: r for r in got.collect()}
    assert set(wanted) <= set(rows) <= set(keys) and len(rows) < len(keys)
    assert all(sh.set_key(np.frombuffer(r.shingles, dtype=np.uint64)) == k and r.n == len(r.shingles) // 8 for k, r in rows.items())
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1  # two in one task keep two workers, which took op9 over an executor's memory


def test_jaccard_edges_and_keep_one(spark):
    docs = edge_docs(spark)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.with_components(docs).collect()]
    assert Counter(g[0] for g in got) == Counter(i for i, _ in EDGES)
    assert {g for g in got if g[0] in (1, 2, 3)} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({i for i, _ in EDGES})  # the repeated row stays once
    assert jaccard.with_components(docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in cc.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def sharded(spark, keys, k, rounds=10):
    df = spark.createDataFrame(list(enumerate(keys)), "doc_id long, name string").repartition(3)
    placed = shards.balanced_shards(df, F.xxhash64("name") if keys else F.col("doc_id"), k, rounds, keep=("doc_id", "name"))
    return [(r["name"], r["shard"], r["slot"]) for r in placed.collect()]


def test_shards_are_even_and_hold_groups(spark):
    rng = random.Random(1)
    keys = ["hot"] * 200 + [f"g{rng.randrange(60)}" for _ in range(180)] + [f"s{i}" for i in range(220)]
    rows = sharded(spark, keys, 6)
    sizes, slots, held = Counter(s for _, s, _ in rows), defaultdict(list), defaultdict(set)
    for k, s, slot in rows:
        slots[s].append(slot)
        held[k].add(s)
    assert len(rows) == 600 and max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 6
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    groups = [k for k, n in Counter(keys).items() if 1 < n <= 100]
    assert sum(len(held[k]) > 1 for k in groups) <= 0.15 * len(groups)
    assert len(held["hot"]) <= 3  # 200 rows need two shards of 100


def test_shards_when_every_row_is_linked(spark):
    rows = sharded(spark, [f"g{i % 40}" for i in range(400)], 8)
    held = defaultdict(set)
    for k, s, _ in rows:
        held[k].add(s)
    assert set(Counter(s for _, s, _ in rows).values()) == {50}
    assert sum(map(len, held.values())) <= 130  # 40 groups whole would be 40, scattered ones 320


def test_shard_edges(spark):
    assert sharded(spark, [], 4) == []
    assert Counter(s for _, s, _ in sharded(spark, [None, None, "a"], 24)).most_common(1)[0][1] == 1


def test_shards_keep_columns_of_any_name(spark):
    names = ["doc_id", "rid", "free", "row", "part", "rank", "beyond", "n", "_at", "a.b", "Key", "shard"]
    df = spark.createDataFrame([(i, *[f"{c}{i}" for c in names[1:]]) for i in range(30)], "struct<" + ",".join(
        f"`{c}`:{'long' if c == 'doc_id' else 'string'}" for c in names) + ">")
    placed = shards.balanced_shards(df.withColumnRenamed("a.b", "ab"), F.col("doc_id") % 5, 3, keep=["ab" if c == "a.b" else c for c in names])
    assert placed.columns == ["doc_id", "rid", "free", "row", "part", "rank", "beyond", "n", "_at", "ab", "key", "shard", "slot"]
    for r in placed.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in ("rid", "free", "row", "part", "rank", "beyond", "n", "_at")) and r["key"] == r["doc_id"] % 5
        assert 0 <= r["shard"] < 3


def test_shard_cut_against_all_ways_to_cut(spark):
    for seed in range(4):
        rng = random.Random(seed)
        keys = [f"g{rng.randrange(5)}" for _ in range(14)]
        extra = lambda first, key: len({i in first for i, k in enumerate(keys) if k == key}) - 1
        cuts = [sum(extra(set(first), k) for k in set(keys)) for first in itertools.combinations(range(14), 7)]
        held = defaultdict(set)
        for k, s, _ in sharded(spark, keys, 2):
            held[k].add(s)
        got = sum(len(v) - 1 for v in held.values())
        assert min(cuts) <= got <= min(cuts) + 1, (seed, got, min(cuts))


def test_search_through_the_graph_finds_what_plain_routing_finds():
    rng = np.random.default_rng(4)
    c, q = rng.normal(size=(1500, 24)), rng.normal(size=(60, 24))
    graph = spann.neighbour_graph(c)
    plain = spann.ratios(q, c)
    for reach in (1.0, 1.05, 1.2):
        got, want = spann.within(q, c, graph, reach) <= reach, plain <= reach
        assert (got & want).sum() >= 0.95 * want.sum() and got.sum() <= 1.05 * want.sum()
    everything = spann.within(q, c, graph, float("1e9"))
    assert np.allclose(everything, plain)  # the graph leads everywhere
    one = spann.within(q, c[:1], spann.neighbour_graph(c[:1]), 1.0)
    assert one.shape == (60, 1) and (one == 1).all()


def test_search_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=np.float64)
    got = defaultdict(list)
    for r in q_spann.op4_balanced_lists(spark, sf).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = (x * x[i]).sum(1)
        s[i] = -np.inf
        best = np.lexsort((ids, -s))[:20]
        hits += len({int(v) for v in ids[best]} & {v for v, _ in got[ids[i]]})
        assert len(got[ids[i]]) == 20
        assert all(abs(score - float(x[i] @ x[np.flatnonzero(ids == v)[0]])) < 1e-12 for v, score in got[ids[i]])
    assert hits / (20 * sum(ids % 20 == 0)) >= 0.9


def test_search_of_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.0, 2.0]), (101, [0.0, 0.0]), (102, None), (103, [float("nan"), 1.0]), (104, [None, 1.0]),
                                                  (105, [float("inf"), 1.0]), (106, [1.0]), (None, [1.0, 0.0]), (0, [3.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("c", "v", "list", "rid")})
    got = defaultdict(list)
    for r in spann.nearest(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert got[20] == [(1, 0, 3.0), (2, 0, 1.0), (3, 1, 1.0), (4, 2, 1.0), (5, 3, 1.0)]
    assert got[100][0] == (1, 0, 0.0) and 101 not in got and len(got[100]) == 5
    assert len(got[0]) == 10  # two rows have this id
    assert spann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_search_reads_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(spann, "BLOCK", 7)
    x = np.random.default_rng(3).normal(size=(150, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for r in spann.nearest(df, F.col("vec_id") % 20 == 0, k=3).groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id"))).alias("f")).collect():
        s = x @ x[r["query_id"]]
        s[r["query_id"]] = -np.inf
        assert [f["vec_id"] for f in r["f"]] == np.argsort(-s)[:3].tolist()


def test_search_keeps_its_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(spann, "LIST_SIZE", 2)  # 2000 lists
    x = np.random.default_rng(8).normal(size=(4000, 64))
    x /= np.sqrt((x**2).sum(1))[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    read, stage = [], spann.stage
    monkeypatch.setattr(spann, "stage", lambda rows, name: (out := stage(rows, name), name == "reads" and read.append(out.count()))[0])
    got = defaultdict(set)
    for r in spann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for i in range(0, 4000, 20):
        s = x @ x[i]
        s[i] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & got[i])
    assert hits / (20 * 200) >= 0.9
    assert read[0] < 0.2 * 200 * 2000


CALLS = "conv_id long, turn long, pos int, call_id string, name string, arguments string"
RESULTS = "conv_id long, turn long, pos int, call_id string, content string"
SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", True), "note": ("string", False)}}


def test_tool_calls(spark):
    calls = spark.createDataFrame([
        (1, 5, 0, "x", "add", '{"b": 1.5, "a":2}'), (1, 6, 0, "x", "add", '{"a":1,"b":1}'), (1, 7, 0, "y", "add", '{"a":"1","extra":[1]}'),
        (1, 8, 0, None, "add", "[1]"), (1, 9, 0, "z", "other", "{}"), (2, 1, 0, "x", "add", "not json"), (2, 2, 0, "w", None, None)], CALLS)
    results = spark.createDataFrame([(1, 3, 0, "x", 'first "é"\n'), (1, 9, 1, "x", "again"), (2, 0, 0, "q", None), (1, 8, 1, "y", "")], RESULTS)
    got = [r.asDict() for r in tool_calls.link(calls.withColumn("json", F.lit(1)), results.withColumn("first", F.lit(1)), SCHEMAS).orderBy("conv_id", "position").collect()]
    one = [(r["position"], r["kind"], r["call_id"], r["status"], r["problems"]) for r in got if r["conv_id"] == 1]
    assert one == [(0, "call", "x", "answered", []), (1, "result", "x", "linked", []), (2, "call", "x", "duplicate", []),
                   (3, "call", "y", "answered", ["unknown:extra", "type:a", "missing:b"]), (4, "call", None, "pending", ["json"]),
                   (5, "result", "y", "linked", []), (6, "call", "z", "pending", ["tool"]), (7, "result", "x", "duplicate", [])]
    assert {(r["call_id"], r["status"], tuple(r["problems"])) for r in got if r["conv_id"] == 2} == {
        ("q", "orphan", ()), ("x", "pending", ("json",)), ("w", "pending", ("json",))}
    assert got[0]["json"] == '{"arguments":{"a":2,"b":1.5},"id":"x","name":"add"}'
    assert json.loads(got[1]["json"]) == {"content": 'first "é"\n', "id": "x"}
    assert all(json.dumps(v := json.loads(r["json"]), separators=(",", ":"), sort_keys=True, ensure_ascii=False) and v for r in got)
    assert tool_calls.link(calls.limit(0), results.limit(0), SCHEMAS).count() == 0


def test_repeated_rows_are_linked_once(spark):
    call, result = (1, 1, 0, "x", "add", '{"a":1,"b":1}'), (1, 2, 0, "x", "ok")
    no_talk = (None, 1, 0, "x", "add", '{"a":1,"b":1}'), (None, 2, 0, "x", "ok")
    got = tool_calls.link(spark.createDataFrame([call] * 3 + [no_talk[0]], CALLS), spark.createDataFrame([result] * 2 + [no_talk[1]], RESULTS), SCHEMAS).collect()
    counts = Counter((r["conv_id"], r["kind"], r["status"]) for r in got)
    assert counts == {(1, "call", "answered"): 1, (1, "call", "duplicate"): 2, (1, "result", "linked"): 1, (1, "result", "duplicate"): 1,
                      (None, "call", "answered"): 1, (None, "result", "linked"): 1}


def test_tool_calls_run_no_user_functions(spark, sf):
    from riskframe.llm.q_tool_calls import op7_tool_calls
    plan = op7_tool_calls(spark, sf)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Arrow"))


REPLICA = "file long, offset long, length long, digest string"


def test_audit_matches_a_plain_comparison(spark):
    rng = random.Random(5)
    first = [(i % 3, (i // 3) * 700, 700, f"d{i}") for i in range(900)] + [(None, 0, 1, "n"), (5, 0, 9, "only here")]
    second = [r for r in first if rng.random() > 0.01]
    second = [(f, o, n, d + "!" * (rng.random() < 0.02)) for f, o, n, d in second] + [(0, 10**7, 5, "new"), (9, 0, 5, "new file")]
    a, b = spark.createDataFrame(first, REPLICA), spark.createDataFrame(second, REPLICA)
    want = {}
    old, new = {(r[0], r[1]): r[2:] for r in first}, {(r[0], r[1]): r[2:] for r in second}
    for k in old.keys() | new.keys():
        if old.get(k) != new.get(k):
            want[k] = "missing" if k not in new else "extra" if k not in old else "changed"
    got = {(r["file"], r["offset"]): r["status"] for r in warc.audit(a.withColumn("node", F.lit(1)), b).collect()}
    assert got == want and len(want) > 10
    assert warc.audit(a, a).count() == 0
    assert warc.audit(a.limit(0), b.limit(0)).count() == 0
    assert {r["status"] for r in warc.audit(a, b.limit(0)).collect()} == {"missing"}


def test_pages_as_records_with_nulls(spark):
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", ""), (7, None, "é" * 100_000), (60, "v", "body")], schema)
    first, second = q_warc.replicas(pages)
    assert (first.count(), second.count()) == (5, 3)  # 7 and 60 are lost by rule
    assert {r["status"] for r in warc.audit(first, second).collect()} == {"missing"}


def test_pipeline_matches_plain_stages(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()]
    stops = set(qr.stop_forms())

    def passes(t):
        m = rule_counts(t, stops)
        return not eval(qr.BASE_FAILED.replace("OR", "or"), {}, m) and all(
            eval(r.holds().replace("OR", "or").replace("AND", "and"), {}, m) for r in qr.RULES)

    kept = [(i, t) for i, t in docs if passes(t)]
    model = q_line_crf.model_of(spark, sf)
    kept = [(i, t) for (i, t), (s, _, _) in zip(kept, model.score_texts([t for _, t in kept]), strict=True) if s >= 0.5]
    kept = [(i, t) for (i, t), c in zip(kept, component_ids(kept), strict=True) if i == c]
    frame = spark.createDataFrame(kept, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    markov = secrets.train(frame)
    bpe = packing.tokenizer(corpus_pipeline.RANKS, corpus_pipeline.public_tokenizers.PATTERN)
    want = {i: len(packing.encode(secrets.masked(t, markov), bpe)) + 1 for i, t in kept}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == want
    assert sum(r["length"] for r in rows) == sum(want.values())


def test_every_stage_takes_awkward_rows(spark, sf):
    docs = edge_docs(spark).withColumns({"n_chars": F.length("text").cast("long"), "lang": F.lit(None).cast("string")})
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, docs, sf)
        assert out.columns == docs.columns, name
        out.collect()
        step(spark, docs.limit(0), sf).collect()
    corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
