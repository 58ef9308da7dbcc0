import random

import numpy as np
import pytest
from tessaphon.llm import ann, jaccard, quality

DOCS = "doc_id long, text string"


def texts(seed, groups, copies):
    r, out = random.Random(seed), []
    for _ in range(groups):
        base = [r.choice("abcdefghijklmnop") * r.randrange(1, 4) for _ in range(r.randrange(3, 90))]
        for _ in range(copies):
            words = list(base)
            for _ in range(r.randrange(4)):
                words[r.randrange(len(words))] = r.choice("xyz")
            out.append(" ".join(words))
    return out


def test_jaccard_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    found = texts(1, 25, 8)
    docs = [*enumerate(found), (900, found[0]), (901, found[0].upper() + "!"), (902, None), (903, ""), (None, found[1]), (904, "one two"), (905, "One two")]
    known = [(k, jaccard.words(t or "")) for k, t in docs if k is not None]
    sets = {k: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for k, w in known if w}
    links = {k: set() for k, _ in known}
    for a in sets:
        for b in sets:
            if a != b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a].add(b)
    label = {k: k for k in links}
    while any(label[b] < label[a] for a in links for b in links[a]):
        for a in links:
            label[a] = min([label[a], *(label[b] for b in links[a])])
    df = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as key", "2 as links", "text as class")
    got = {x.doc_id: (x.class_id, x.n_links) for x in jaccard.join(df).collect()}
    assert got == {None: (None, 0)} | {k: (label[k], len(links[k])) for k in links}
    kept = jaccard.keep_one(df)
    assert sorted(x.doc_id for x in kept.filter("doc_id is not null").collect()) == sorted({label[k] for k in links})
    assert kept.columns == df.columns


def test_jaccard_small_tables(spark):
    assert jaccard.join(spark.createDataFrame([], DOCS)).count() == 0
    same = spark.createDataFrame([(1, "a b c d e f")] * 3, DOCS)
    assert [(x.class_id, x.n_links) for x in jaccard.join(same).collect()] == [(1, 2)] * 3
    assert jaccard.keep_one(same).count() == 1


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard.least_matches(0.8, 1e-6)
    r = np.random.default_rng(0)
    matches = r.random((20000, jaccard.COMPARED)) < 0.8
    assert all((matches[:, :n].sum(axis=1) >= m).mean() > 0.999 for n, m in least.items())
    assert all(m > 0.2 * n for n, m in least.items())


def test_nearest_against_brute_force(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal((1500, 12)) * r.random((1500, 1))
    x[200:700] = x[7]
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    bad = [(5000, None), (5001, [0.0] * 12), (5002, [None] + [1.0] * 11), (5003, [float("nan")] * 12), (5020, [1.0]), (None, [1.0] * 12), rows[20]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = {}
    for m in ann.search(df, 20, 20).collect():
        got.setdefault(m.query_id, {})[m["rank"]] = (m.vec_id, m.score)
    assert sorted(got) == list(range(0, 1500, 20))
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(1500), -s.round(12)))[:20]
        assert sorted(found) == list(range(1, 21)) and all(abs(s[v] - c) < 1e-9 for v, c in found.values())
        hits += len(set(best.tolist()) & {v for v, _ in found.values()})
    assert hits / (20 * len(got)) >= 0.93


def test_nearest_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), 20, 20).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5])], schema)
    assert [(m.query_id, m["rank"], m.vec_id) for m in ann.search(few, 20, 20).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert ann.search(few.filter("vec_id = 0"), 20, 20).count() == 0


def brute_model(texts):
    """Interpolated modified Kneser-Ney by its definition, on dictionaries."""
    from collections import Counter

    order = quality.ORDER
    counts = {order: Counter(g for t in texts for w in t.split() for g in quality._grams(w))}
    raw = dict(counts)
    for k in range(order - 1, 0, -1):
        raw[k], kinds = Counter(), Counter()
        for g, n in raw[k + 1].items():
            raw[k][g[1:]] += n
            kinds[g[1:]] += 1
        counts[k] = Counter({g: raw[k][g] if g[0] == quality.START else kinds[g] for g in kinds})

    def cuts(k):
        n = Counter(min(c, 5) for g, c in counts[k].items() if g[-1] != quality.START)
        n1, n2, n3, n4 = (max(1, n[i]) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        return [min(max(x, 0.1), top) for x, top in ((1 - 2 * y * n2 / n1, 0.9), (2 - 3 * y * n3 / n2, 1.9), (3 - 4 * y * n4 / n3, 2.9))]

    all_cuts = {k: cuts(k) for k in counts}
    kinds = sum(g != quality.START for g in counts[1])

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (kinds + 1)
        own = {x: c for x, c in counts[k].items() if x[:-1] == g[:-1] and x[-1] != quality.START}
        if not own:
            return p(g[1:])
        off = {x: min(c, all_cuts[k][min(c, 3) - 1]) for x, c in own.items()}
        total = sum(own.values())
        return (own[g] - off[g] if g in own else 0) / total + sum(off.values()) / total * p(g[1:])

    return p


def test_kneser_ney_against_definition(spark, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_ENTRIES", 40)
    train = ["the cat sat on the mat", "the dog sat at the cat", "a cat and a dog and the dot", "on and on"]
    table = quality.train(spark.createDataFrame([("en", t) for t in train], "lang string, text string"))
    model, p = quality.Model(table), brute_model(train)
    assert len(model.shards) > 2
    tests = ["the cat", "dotted zebra", "sat-on", "éa"]
    got = model.score(spark.createDataFrame([("en", t) for t in tests], "lang string, text string"), quality._lang(), quality.F.col("text"), "s").collect()
    for row in got:
        want = -sum(np.log(p(g)) for w in row.text.split() for g in quality._grams(w))
        assert row.s.nll == pytest.approx(want, rel=1e-4) and row.s.n == sum(len(w) + 1 for w in row.text.split())
    # One unknown character stands for all of them: with it, the known ones make a whole.
    known = {c for t in train for c in t if c != " "} | {quality.END}
    assert sum(p("cat" + c) for c in [*known, "z"]) == pytest.approx(1)


def test_quality_cases(spark):
    r = random.Random(2)
    word = lambda: "".join(r.choice(["the", "an", "er", "in"]) for _ in range(2))
    good = [(k, " ".join(word() for _ in range(60)), "en") for k in range(120)]
    odd = [(500, "§§x €€q ##z " * 20, "en"), (501, None, "en"), (502, "", "en"), (503, "inconnu", None), (504, "zzqq kkjj " * 9, "xx")]
    docs = spark.createDataFrame(good + odd, "doc_id long, text string, lang string").selectExpr("*", "1 as s", "2 as trusted")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(100)] + [(0, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(docs, labels)
    ids = {x.doc_id for x in kept.collect()}
    assert kept.columns == docs.columns and 500 not in ids and {501, 502, 503, 504} <= ids and len(ids) > 118
    assert quality.keep_good(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).count() == 125


def join_rows(spark, since, keys):
    """Most rows that one join on these keys has made in the executions after that number."""
    store, most = spark._jsparkSession.sharedState().statusStore(), 0
    executions = store.executionsList()
    for e in (executions.apply(k).executionId() for k in range(executions.size())):
        if e <= since:
            continue
        values, nodes = store.executionMetrics(e), store.planGraph(e).allNodes()
        for node in (nodes.apply(k) for k in range(nodes.size())):
            metrics = [node.metrics().apply(k) for k in range(node.metrics().size())]
            if "Join" in node.name() and all(f"[{k}#" in node.desc() for k in keys):
                made = [values.apply(m.accumulatorId()) for m in metrics if m.name() == "number of output rows" and values.contains(m.accumulatorId())]
                most = max([most, *(int(m.replace(",", "")) for m in made)])
    return most


def test_joins_of_a_large_group_make_no_row_for_each_tile_of_a_node(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    r, base = random.Random(4), [f"w{k}" for k in range(120)]
    docs = [(k, " ".join(f"x{k}" if r.random() < 0.03 else w for w in base)) for k in range(160)]
    store = spark._jsparkSession.sharedState().statusStore()
    executions = store.executionsList()
    since = max((executions.apply(k).executionId() for k in range(executions.size())), default=-1)
    jaccard.join(spark.createDataFrame(docs, DOCS)).collect()
    tiles = join_rows(spark, since, ["block"])
    assert 0 < tiles <= 3000  # two sides of 40 * 41 / 2 tiles or so, not four times as many
    tile = spark.createDataFrame([(5, 1, [(7, b"a"), (9, b"b")]), (5, 2, [(8, b"c")])], "tile long, side int, members array<struct<node long, sig binary>>")
    table = jaccard._unpacked(next(jaccard._by_tile(tile.toArrow().to_batches())))
    assert table.to_pydict() == {"tile": [5] * 3, "side": [1, 1, 2], "node": [7, 9, 8], "sig": [b"a", b"b", b"c"]}


def _shuffled(spark):
    """Bytes that each stage so far has written to shuffles."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    gateway = spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}


def test_jaccard_sends_sets_twice(spark):
    r = random.Random(11)
    texts = [" ".join(str(r.randrange(10**9)) for _ in range(1500)) for _ in range(60)]
    docs = [(2 * k + more, t + " again" * more) for k, t in enumerate(texts) for more in (0, 1)]
    size = 8 * 1497 * len(docs)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = _shuffled(spark)
        got = {x.doc_id: (x.class_id, x.n_links) for x in jaccard.join(spark.createDataFrame(docs, DOCS)).collect()}
        large = [v for k, v in _shuffled(spark).items() if k not in before and v > size // 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == {k: (k - k % 2, 1) for k in range(len(docs))}
    assert 1 <= len(large) <= 2
