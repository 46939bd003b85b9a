"""URL rules, source mixing, M-tree search."""

import random

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from larkspur.llm import mixing, mtree, urlrules


def brute_rule(host, path, rules):
    fits = [(len(h), len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, urlrules.DEFAULT)


def brute_parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    for c in "?#":
        path = path.split(c)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_url_rules_against_brute_force(spark):
    rng = random.Random(1)
    labels = ["a", "net", "org", "example", "b-c", "É", "", "com"]
    urls = [None, "", "no scheme", "http://", "http://net", "http://net/", "http://a.net?x=/en/", "x://A.NET/#://", "ftp://b.example.net/en/x?y"]
    for _ in range(400):
        host = ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
        urls.append(f"http://{host}{rng.choice(['', '/', '/en/', '/en/a/b', '/de', '/fr/x'])}{rng.choice(['', '?q', '#f'])}")
    rules = [*urlrules.RULES, ("allow", "a.net", "/"), ("block", "a.net", "/en/"), ("block", "", "/"), ("allow", "b-c.example.net", ""), ("block", "é.org", "/")]
    rules += [("x", f"{rng.choice(labels)}.{rng.choice(labels)}", rng.choice(["/", "", "/en/"])) for _ in range(20)]
    rules = [*{(h, p): (v, h, p) for v, h, p in sorted(rules, reverse=True)}.values()]
    pages = spark.createDataFrame([(i, u, "k") for i, u in enumerate(urls)], "page_id long, url string, key string").repartition(3)
    table = spark.createDataFrame([*rules, (None, "a", "/"), ("block", None, "/")], "verdict string, host string, path string")
    want = {}
    for i, u in enumerate(urls):
        host, path = brute_parse(u)
        want[i] = (host, path, *brute_rule(host, path, rules))
    for limit in (urlrules.MAX_BROADCAST, 3):  # swept by partitions, by ranges
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, table, max_broadcast=limit).collect()}
        assert got == want
        assert urlrules.judge(pages.limit(0), table, max_broadcast=limit).count() == 0
        assert {r.verdict for r in urlrules.judge(pages, table.limit(0), max_broadcast=limit).collect()} == {urlrules.DEFAULT}


def test_many_rules_are_swept_by_ranges(spark):
    """More rules than are broadcast, a host with a third of the pages, rules that lie open over many ranges, ids beyond 2^53 and null ones."""
    rng = random.Random(12)
    rules = {(f"h{i}.d{i % 977}.net", "/" + "x/" * (i % 3)): ("allow", "block")[i % 2] for i in range(200_000)}
    rules |= {("net", "/"): "block", ("d5.net", "/x/"): "allow", ("org", ""): "allow", ("hot.org", "/x/x/"): "block"}
    base = 1 << 60
    pages = []
    for i in range(3000):
        host = "www.hot.org" if i % 3 == 0 else f"{rng.choice(['', 'www.'])}h{(k := rng.randrange(200_500))}.d{k % 977}.net"
        pages.append((base + i, f"https://{host}/{'x/' * rng.randrange(4)}"))
    table = spark.createDataFrame([(v, h, p) for (h, p), v in rules.items()], "verdict string, host string, path string")
    got = urlrules.judge(spark.createDataFrame([*pages, (None, "https://www.hot.org/x/x/x")], "page_id long, url string"), table)
    assert "urlrules" in str(got.inputFiles())  # the form by ranges
    got = {r.page_id: (r.rule, r.verdict) for r in got.collect()}
    assert got.pop(None) == ("hot.org/x/x/", "block") and len(got) == 3000
    for i, url in pages:
        host, path = brute_parse(url)
        labels = host.split(".")
        fits = [(h, path[:n]) for j in range(len(labels)) for h in [".".join(labels[j:])] for n in range(len(path), -1, -1) if (h, path[:n]) in rules]
        assert got[i] == (("".join(fits[0]), rules[fits[0]]) if fits else (None, urlrules.DEFAULT))


def test_one_sweep_over_all_batches(spark):
    """Small Arrow batches, many nested hosts and paths: every host is pushed once a partition, and results stay right."""
    rng = random.Random(9)
    labels, steps = ["a", "b", "c"], ["x/", "y/", "xy/", ""]
    rules = {(".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4))), "/" + "".join(rng.choice(steps) for _ in range(rng.randrange(4)))) for _ in range(150)}
    rules = [(rng.choice(["allow", "block"]), h, p) for h, p in sorted(rules)]
    urls = [f"s://{'.'.join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))}/{''.join(rng.choice(steps) for _ in range(rng.randrange(5)))}" for _ in range(500)]
    urls += urls[:50]  # repeated pages each get a row
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").coalesce(2)
    equal = [("block", "z", "/"), ("allow", "z", "/")]  # of equal rules the verdict that sorts first holds
    table = spark.createDataFrame([*rules, *equal], "verdict string, host string, path string")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "7")
    try:
        got = {r.page_id: (r.rule, r.verdict) for r in urlrules.judge(pages.union(spark.createDataFrame([(-1, "s://q.z/")], pages.schema)), table).collect()}
    finally:
        spark.conf.unset(name)
    assert got == {i: brute_rule(*brute_parse(u), rules) for i, u in enumerate(urls)} | {-1: ("z/", "allow")}
    sweep = urlrules.Sweep(urlrules.by_host([(urlrules._key(h), p) for _, h, p in rules]))
    keys = sorted((urlrules._key(brute_parse(u)[0]), brute_parse(u)[1]) for u in urls)
    parts = [sweep.winners([k for k, _ in keys[i : i + 7]], [p for _, p in keys[i : i + 7]]) for i in range(0, len(keys), 7)]
    assert sweep.following <= len(sweep.hosts) and sum(map(len, parts)) == len(urls)


def test_targets(spark):
    def targets(sizes):
        df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
        return {r.source: r.target for r in mixing.source_targets(df).collect()}

    assert targets({"a": 500, "b": 200, "c": 100}) == {"a": 500.0, "b": 200.0, "c": 100.0}
    capped = targets({"a": 10, "b": 1000, "c": 1000, None: 0})
    assert capped["a"] == 30.0 and capped[None] == 0.0 and abs(capped["b"] - 1980 * 2 / 3) < 1e-9 and abs(sum(capped.values()) - 2010) < 1e-9
    assert targets({"a": 0}) == {"a": 0.0} and targets({}) == {}


def test_mix_meets_targets_and_repeats(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, rng.choice(["s1", "s1", "s1", "s2", "s3", None]), " ".join(["w"] * rng.randrange(0, 40)), i % 3) for i in range(1500)] + [(None, "s9", None, 1), (5, "s9", "a b", 1), (5, "s9", "a b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, size int")
    out = mixing.mix(df, quality=F.lit(1.0)).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert r.size == len((r.text or "").split()) and 0 <= r.taken <= 3 * r.size
        by.setdefault(r.source, []).append(r)
    for group in by.values():
        assert abs(sum(r.taken for r in group) - group[0].target) <= 0.5
        assert group[0].source_size == sum(r.size for r in group)
    monkeypatch.setattr(mixing, "MAX_BROADCAST", 0)
    again = mixing.mix(df.repartition(7), quality=F.lit(1.0)).collect()
    assert sorted((r.doc_id or -1, r.taken) for r in again) == sorted((r.doc_id or -1, r.taken) for r in out)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mix_of_rows_without_ids(spark):
    """All rows of one source share a key: they form one group of the split slice, and the budget still ends where it should."""
    df = spark.createDataFrame([(None, "s", "w w w")] * 500 + [(i, "t", "w w w") for i in range(100)] + [(None, "t", "w")] * 7, "doc_id long, source string, text string")
    out = mixing.mix(df).collect()
    for source in ("s", "t"):
        rows = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 0.5
    taken = sorted(r.taken for r in out if r.source == "s")
    assert len(out) == 607 and len(set(taken)) <= 3 and sum(0 < t % 3 for t in taken) <= 1


def test_quality_weights_draw_earlier(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", "w w w w") for i in range(4000)], "doc_id long, source string, text string")
    out = mixing.mix(df, quality=F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0)).where("source = 'b'").collect()
    good, bad = ([r.taken for r in out if (r.doc_id % 4 < 2) is x] for x in (True, False))
    assert np.mean(good) > 1.3 * np.mean(bad) > 0


def brute_top(rows, queries, k):
    out = {}
    for qi, q in queries:
        scored = sorted(((-int(np.dot(q, x)), i) for i, x in rows if i != qi))[:k]
        out[qi] = [(i, -s) for s, i in scored]
    return out


def found_by(forest, k):
    got = {}
    for r in mtree.top_k(forest, F.col("vec_id") % 20 == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return got


def test_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8)) * 3
    vectors = [(centres[i % 6] + rng.normal(size=8) * (0 if i % 7 == 0 else 1)).round(3).tolist() for i in range(900)] + [[1.0] * 8] * 400
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, v int")
    rows = [(i, np.floor(np.array(v, np.float32).astype(float) * 64).astype(int)) for i, v in enumerate(vectors)]
    want = brute_top(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert found_by(mtree.build(mtree.quantised(df), tree_rows=150), 20) == want
    assert found_by(mtree.build(mtree.quantised(df)), 3) == {q: v[:3] for q, v in want.items()}


def test_search_leaves_out_what_it_says(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (2, None), (3, [1.0, None]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, []), (7, [3.0]), (None, [1.0, 1.0]), (20, []), (40, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found_by(mtree.build(mtree.quantised(df)), 20)
    none = [(i, 0) for i in (0, 1, 6, 7, 20, 40)]
    assert got[20] == [x for x in none if x[0] != 20]
    assert got[0] == [(7, 64 * 192), (6, 0), (20, 0), (1, 64 * 32 - 128 * 64), (40, -64 * 64 - 128 * 64)]
    assert got[40] == [(1, -64 * 32 + 64 * 64), (6, 0), (20, 0), (0, -64 * 64 - 64 * 128), (7, -64 * 192)]
    assert found_by(mtree.build(mtree.quantised(df.limit(0))), 5) == {}


def test_large_finite_vectors_take_part(spark, tmp_path):
    import duckdb

    from larkspur.llm import queries

    small = [(20, [1.0, 2.0]), (2, [2e7, 1.0]), (3, [3.0, 1.0]), (40, [-1e7, 1e7]), (5, [1e7 + 0.25, 1e7]), (6, [2.0**26, -(2.0**26)])]
    spark.createDataFrame(small, "vec_id long, embedding array<double>").coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = [(i, [int(x * 64) for x in v]) for i, v in small]
    want = {q: sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)) for q, v in rows if q % 20 == 0}
    got = {}
    for r in queries.op8_mtree_topk(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert got == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    twin = con.execute(f"SELECT query_id, -score, vec_id FROM ({queries.oracle_sql()['op8_mtree_topk']}) ORDER BY query_id, rank").fetchall()
    assert twin == [(q, s, i) for q in sorted(want) for s, i in want[q]]


def test_huge_components_and_scores_beyond_a_long(spark):
    big = float(2**24 - 1)
    forest = mtree.build(mtree.quantised(spark.createDataFrame([(20, [big] * 20), (1, [big] * 20)], "vec_id long, embedding array<float>")))
    with pytest.raises(PythonException, match="does not fit 64 bits"):
        mtree.top_k(forest, F.col("vec_id") % 20 == 0).collect()
    rows = [(20, [1.0, 0.0]), (1, [1e300, 1.0]), (2, [3.0, 1e200]), (3, [-5.0, 1.0])]  # squares overflow; scores of the first query fit but for one
    tree = mtree.MTree(np.array([1, 2, 3]), np.array([r[1] for r in rows[1:]]))
    assert not tree.bounded and tree.search(20, np.array([1.0, 0.0]), 3) == [(int(1e300), 1), (3, 2), (-5, 3)]
    with pytest.raises(Exception, match="too large for scale"):
        mtree.quantised(spark.createDataFrame([(1, [1.5e308])], "vec_id long, embedding array<double>")).collect()


def test_repeated_vector_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).round(3).tolist()) for i in range(60)]
    rows += [(20, rows[20][1])] * 30 + [(40, [9.0] * 4)] * 5 + [(7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows]
    want = {}
    for q in (0, 20, 40):
        own = min(v for i, v in whole if i == q)
        want[q] = [(i, -s) for s, i in sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in whole if i != q)[:20]]
    assert found_by(mtree.build(mtree.quantised(df), tree_rows=16), 20) == want


def test_trees_are_ruled_out_before_anything_is_sent(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6)) * 20
    rows = [(i, (centres[i % 12] + rng.normal(size=6) * 0.2).tolist()) for i in range(2400)]
    forest = mtree.build(mtree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), tree_rows=100)
    n_trees = forest.trees.count()
    queries = forest.placed.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v", "tree")
    whole = [(i, np.floor(np.array(v) * 64).astype(int)) for i, v in rows]
    want = brute_top(whole, [r for r in whole if r[0] % 20 == 0], 20)
    floors = spark.createDataFrame([(q, v[-1][1]) for q, v in want.items()], "query_id long, least long")
    pairs = mtree.searched(forest, queries, floors).count()
    assert n_trees > 20 and 0 < pairs < 0.5 * n_trees * len(want)
    assert found_by(forest, 20) == want


def test_floors_and_trees_are_not_broadcast(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(400)]
    forest = mtree.build(mtree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), tree_rows=40)
    queries = forest.placed.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v", "tree")
    floors = forest.placed.groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.lit(-(10**9))).alias("least"))
    plan = mtree.searched(forest, queries, floors)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [query_id" in plan and "BroadcastHashJoin [query_id" not in plan  # files this small would be broadcast
    best = mtree.top_k(forest, F.col("vec_id") % 20 == 0, 3)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [at" in best and "Broadcast" not in best


def test_queries_are_not_broadcast_once_for_each_cell(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(400)]
    forest = mtree.build(mtree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), tree_rows=40)
    own = forest.placed.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "v", "tree")
    queries = forest.tables.written(own.coalesce(1), "queries")  # smaller files than those of the trees
    floors = forest.tables.written(queries.select("query_id", F.lit(-(10**9)).alias("least")).coalesce(1), "floors").groupBy("query_id").agg(F.min("least").alias("least"))
    found = mtree.searched(forest, queries, floors)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    monkeypatch.setattr(mtree, "ROOT_BYTES", 0)
    merged = mtree.searched(forest, queries, floors)
    assert "Broadcast" not in merged._jdf.queryExecution().executedPlan().toString()
    pairs = sorted((r.query_id, r.tree) for r in found.collect())
    assert len(pairs) == 20 * (forest.trees.count() - 1) and pairs == sorted((r.query_id, r.tree) for r in merged.collect())


@pytest.mark.parametrize("ids", [1, 3, 5000])
def test_driver_gets_few_rows_for_the_pivots(spark, monkeypatch, ids):
    monkeypatch.setattr(mtree, "PIVOTS", 16)
    frame, met = type(spark.range(0)), []
    rows = mtree.quantised(spark.range(0, 40_000, 1, 64).select((F.col("id") % ids).alias("vec_id"), F.array((F.col("id") % ids).cast("double")).alias("embedding")))

    def limited(self, n, f=frame.limit):
        met.append(n * rows.rdd.getNumPartitions())  # collected in order, a limit brings the best n of every partition
        return f(self, n)

    def collected(self, f=frame.collect):
        got = f(self)
        met.append(len(got))
        return got

    monkeypatch.setattr(frame, "limit", limited)
    monkeypatch.setattr(frame, "collect", collected)
    placed, table, radii = mtree._cells(rows, 100, mtree.Tables(spark, "few"))
    assert 1 <= len(table) <= min(ids, 16) and len(radii) == len(table) and max(met) <= 200
    assert ids < 5000 or len(table) > 8
    assert placed.count() == 40_000


def test_large_cells_are_split_by_distance(spark, monkeypatch):
    monkeypatch.setattr(mtree, "PIVOTS", 3)
    monkeypatch.setattr(mtree, "DEAL", 200)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).round(2).tolist() if i % 3 else [1.0, 1.0, 1.0]) for i in range(1500)]
    forest = mtree.build(mtree.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), tree_rows=60)
    sizes = [r["count"] for r in forest.placed.groupBy("tree").count().collect()]
    assert sum(sizes) == 1500 and max(sizes) < 250 and len(sizes) > 9
    subs = {(r.tree >> 44, r.tree >> 32 & 4095) for r in forest.placed.select("tree").distinct().collect()}
    assert len(subs) > 3
    whole = [(i, np.floor(np.array(v) * 64).astype(int)) for i, v in rows]
    assert found_by(forest, 20) == brute_top(whole, [r for r in whole if r[0] % 20 == 0], 20)


def test_bounds_save_work(monkeypatch):
    monkeypatch.setattr(mtree, "PAGE", 64)
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(3000, 4)) * 500)
    tree = mtree.MTree(np.arange(3000), x)
    assert all(tree.search(-1, q, 5) == sorted(((int(s), i) for i, s in enumerate(x @ q)), key=lambda t: (-t[0], t[1]))[:5] for q in x[:40])
    assert sum(n[0] for n in tree.nodes) > 40
    assert tree.computed < 0.5 * 40 * 3000


def test_large_components_stay_exact():
    x = np.array([[2.0**29, 2.0**29 - 1], [2.0**29, 2.0**29 - 3], [-(2.0**29), 5.0]])
    tree = mtree.MTree(np.array([1, 2, 3]), x)
    want = sorted(((int(a) * 2**29 + int(b) * (2**29 - 1), -i) for i, (a, b) in zip([1, 2, 3], x.tolist(), strict=True)), reverse=True)
    assert [s for s, _ in tree.search(0, x[0], 3)] == [s for s, _ in want]
