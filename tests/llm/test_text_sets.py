"""Near duplicates, license scans, chat snapshots."""

import random
import re

import pytest
from oracle import compare, connect

from larkspur.llm import chat, license, neardup, queries


@pytest.mark.parametrize("name", ["op2_snapshot_collapse", "op3_license_scan", "op4_circulant_minhash", "op6_url_rules", "op7_source_mix", "op8_mtree_topk"])
def test_equals_duckdb(spark, small_dir, name):
    compare(queries.queries()[name](spark, small_dir), connect(small_dir), queries.oracle_sql()[name])


def brute_components(texts, percent=75):
    """component by row number, quadratic."""
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [top(i) for i in range(len(texts))]


def variants(rng, n, words=120, edits=3):
    base = [f"{rng.choice('abcdef')}{rng.randrange(900)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture
def many_partitions(spark):
    """Small tables keep all their partitions, so that buckets are cut by partition borders."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.mark.parametrize(("small", "block"), [(8, 512), (2, 6), (1, 3)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, many_partitions, small, block):
    rng = random.Random(small)
    texts = variants(rng, 40, edits=6) + variants(rng, 10) + ["", "   ", None, "a b", "A  b", "a b c", "one two three four five"] + variants(rng, 1) * 5
    rng.shuffle(texts)
    real = neardup.node_links
    monkeypatch.setattr(neardup, "node_links", lambda *a: real(*a, small=small, block=block))
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, node string")
    got = {r.doc_id: r for r in neardup.near_duplicates(df).collect()}
    sizes, tops = brute_components(texts)
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == tops
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_sweeps_over_cut_buckets(spark, many_partitions):
    """Whatever partitions cut: members are the nodes of shared buckets, leaders tie a bucket together, and every pair of labels meets."""
    rng = random.Random(6)
    nodes = [(i, 10 + i % 3, sorted({rng.choice([1, 2, 3, rng.randrange(40), 100 + i]) for _ in range(4)})) for i in range(300)]
    df = spark.createDataFrame(nodes, "node long, size long, bands array<long>")
    tables = neardup.Tables(spark, "test")
    members = neardup._members(df, tables).collect()
    held = {}
    for i, _, buckets in nodes:
        for k in buckets:
            held.setdefault(k, set()).add(i)
    shared = {k: v for k, v in held.items() if len(v) > 1}
    assert {(r.bucket, r.node) for r in members} == {(k, i) for k, v in shared.items() for i in v}
    for k, v in shared.items():
        reach, grown = {min(v)}, True
        while grown:
            more = {x for r in members if r.bucket == k and ({r.node, r.leader} & reach) for x in (r.node, r.leader)} - reach
            reach, grown = reach | more, bool(more)
        assert reach == v
    tagged = spark.createDataFrame([(r.bucket, r.size, r.node, r.node // 50) for r in members], "bucket long, size long, node long, label long")
    left = neardup._second_sweep(tagged, 75, small=3, block=8).collect()
    pairs = {(r.a, r.b) for r in left if r.block is None}
    blocks = {}
    for r in left:
        if r.block is not None:
            blocks.setdefault((r.bucket, r.block), set()).add(r.a)
    assert all(len(v) <= 8 for v in blocks.values())
    for k, v in shared.items():
        together = set().union(*(x for (b, _), x in blocks.items() if b == k))
        for a in v:
            for b in v:
                assert a >= b or a // 50 == b // 50 or (a, b) in pairs or {a, b} <= together


def test_words_of_a_constructed_hash_collision_stay_apart(spark):
    """A Thue-Morse word and its letter swap agree in every polynomial hash modulo 2**64."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    swapped = word.translate(str.maketrans("ab", "ba"))
    out = neardup.near_duplicates(spark.createDataFrame([(1, word), (2, swapped), (3, word.upper())], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(1, 1), (2, 2), (3, 1)]


def test_deduplication_judges_rows(spark):
    a, b, c = "a b c d e f g h", "q w e r t y u i", "z x c v b n m k"
    schema = "doc_id long, text string, kept_id int, row string, doc int"

    def left(rows):
        df = spark.createDataFrame([(*r, 1, "r", 2) for r in rows], schema)
        out = neardup.deduplicated(df)
        assert out.columns == df.columns
        return sorted((r.doc_id or -1, r.text) for r in out.collect())

    assert left([(3, a), (5, a), (5, b), (7, c)]) == [(3, a), (5, b), (7, c)]
    assert left([(3, a), (None, a), (None, b)]) == [(-1, b), (3, a)]
    assert left([(None, a), (None, a), (4, c), (4, c)]) == [(-1, a), (4, c)]
    assert left([(1, ""), (1, ""), (2, " ")]) == [(1, ""), (1, ""), (2, " ")]
    assert left([]) == []


def test_null_ids_cost_no_more_than_ids(spark):
    """Sets are found by the hash of their text, so rows without an id do not meet each other."""
    rng = random.Random(1)
    texts = variants(rng, 300)
    df = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    nodes = spark.createDataFrame([], "node long, set_key binary, text_key long")
    assert neardup._node_sets(df, nodes, "text").count() == 0
    found = neardup.signatures(df).collect()
    wanted = spark.createDataFrame([(i, r.set_key, r.text_key) for i, r in enumerate(found[:40])], nodes.schema)
    sets = {r.node: len(r["items"]) // 8 for r in neardup._node_sets(df, wanted, "text").collect()}
    assert sets == {i: r.n_shingles for i, r in enumerate(found[:40])}


def test_a_very_long_text(spark):
    rng = random.Random(3)
    words = [f"w{rng.randrange(90_000)}" for _ in range(300_000)]
    other = words[:]
    for i in range(0, 300_000, 40):
        other[i] = "changed"
    out = neardup.near_duplicates(spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, "x" * 3_000_000)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(1, 1), (2, 1), (3, 3)]


def test_near_duplicate_edge_cases(spark):
    schema = "doc_id long, text string"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (None, "q"), (3, None), (None, None)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in out) == [(-1, 0, -1, True), (-1, 1, -1, True), (-1, 2, 7, False), (3, 0, 3, True), (7, 2, 7, True), (7, 2, 7, True)]


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.label) for r in neardup.components(edges).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def brute_license(text, templates):
    def shingled(t):
        w = [x for x in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", t.lower()) if x]
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]

    doc, out = shingled(text or ""), {}
    for name, t in templates:
        want = shingled(t)
        w = license.window_of(len(want))
        best = max((len(set(want) & set(doc[s : s + w])) for s in range(0, len(doc), max(1, w // 4))), default=0)
        if best * 100 >= len(set(want)) * 75:
            out[name] = best
    return out


def test_license_scan_against_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", "Released under", "RELEASED under the MIT-License!!"]
    for name, t in license.TEMPLATES:
        words = t.split()
        broken = [w if rng.random() > 0.06 else "zzz" for w in words]
        filler = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(150))]
        texts += [" ".join(filler + words + filler), " ".join(filler + broken), " ".join(words[: len(words) // 2] + filler + words[len(words) // 2 :]), t * 3]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    got = {}
    for r in license.scan(df, license.template_table(spark)).collect():
        got.setdefault(r.doc_id, {})[r.license_id] = r.matched
    want = {i: b for i, t in enumerate(texts) if (b := brute_license(t, license.TEMPLATES))}
    assert got == want
    assert license.scan(df.limit(0), license.template_table(spark)).count() == 0
    with pytest.raises(ValueError):
        license.scan(df, license.template_table(spark, [("short", "too few words")]))


def test_whole_licence_texts_in_groups(spark, monkeypatch):
    """Templates of thousands of words beside short ones, more templates than a group holds, and very long texts."""
    rng = random.Random(12)
    words = [f"w{rng.randrange(4000)}" for _ in range(9000)]
    templates = [("long-a", " ".join(words[:2500])), ("long-b", " ".join(words[3000:8200])), ("short", " ".join(words[8500:8540])), ("tiny", "one two three four five")]
    broken = [w if rng.random() > 0.03 else "zzz" for w in words[:2500]]
    filler = [f"f{rng.randrange(10**6)}" for _ in range(30_000)]
    texts = [" ".join(filler + words[:2500] + filler), " ".join(filler[:7] + broken), " ".join(words[3000:8200]), " ".join(words[3000:5000]), " ".join(words), "x one two three four five y", "x" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: b for i, t in enumerate(texts) if (b := brute_license(t, templates))}
    assert want[0] == {"long-a": want[0]["long-a"]} and {"long-a"} == set(want[1]) and set(want[4]) == {"long-a", "long-b", "short"} and 3 not in want
    for group in (1000, 2):
        monkeypatch.setattr(license, "GROUP", group)
        got = {}
        for r in license.scan(df, license.template_table(spark, templates)).collect():
            got.setdefault(r.doc_id, {})[r.license_id] = r.matched
        assert got == want
    assert license.scan(df, license.template_table(spark, templates).limit(0)).count() == 0
    with pytest.raises(ValueError, match="one name"):
        license.scan(df, license.template_table(spark, [templates[0], templates[0]]))


def test_license_plan_is_native(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = license.scan(df, license.template_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_snapshots_against_brute_force(spark):
    rng = random.Random(4)
    logs = []
    for _ in range(60):
        base = [(i, rng.choice(["user", None]), rng.choice(["hi", "", None, "so"])) for i in range(rng.randrange(1, 6))]
        logs += [base[:n] for n in range(1, len(base) + 1) if rng.random() < 0.7]
    rows = [(c, *t) for c, log in enumerate(logs) for t in log] + [(None, 0, "user", "null id")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn int, role string, text string, whole int")
    want = {}
    for c, log in enumerate(logs):
        if not any(len(o) > len(log) and o[: len(log)] == log for o in logs):
            want.setdefault(tuple(log), []).append(c)
    out = {r.conv_id: r for r in chat.collapse(df).collect()}
    assert {c: (out[c].n_turns, out[c].n_equal) for c in out if c is not None} == {min(v): (len(k), len(v)) for k, v in want.items()}
    assert out[None].rendered == "<|im_start|>user\nnull id<|im_end|>\n"
    assert chat.collapse(df.limit(0)).count() == 0


def test_long_conversations_and_marks_in_texts(spark):
    """Prefixes around the length of a run of the fold, and turns that hold the marks themselves."""
    turns = [(i, "user" if i % 2 else None, f"t{i % 7} <|im_end|>") for i in range(300)]
    lengths = [1, 63, 64, 65, 128, 129, 299, 300, 300]
    rows = [(c, *t) for c, n in enumerate(lengths) for t in turns[:n]] + [(20, *t) for t in [*turns[:150], (150, "user", "other")]]
    out = chat.collapse(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert sorted((r.conv_id, r.n_turns, r.n_equal) for r in out) == [(7, 300, 2), (20, 151, 1)]
    whole = next(r.rendered for r in out if r.conv_id == 7)
    assert whole == "".join(f"<|im_start|>{role or ''}\n{text}<|im_end|>\n" for _, role, text in turns)
