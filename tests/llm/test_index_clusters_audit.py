"""Positional index and contamination, simplex clusters, divergence audit: each against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from larkspur.llm import clusters, decontaminate, divergence
from larkspur.llm.scratch import Tables


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_hits(docs, items, width=decontaminate.WIDTH):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - width, 0) + 1 if w else 0):
            windows[tuple(w[i : i + width])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= found
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def corpus(rng, n_docs=120, n_items=25):
    vocabulary = ["the", "The", "É", "Éé", "a", "x1", "ß", "\U0001f600", *(f"w{i}" for i in range(12))]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-", "  "]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 30]))) for i in range(n_items)]
    items += [(3, "zz yy"), (None, items[5][1]), (40, None), (41, ""), (42, " .,"), (43, items[4][1]), (44, "never seen words of an item that is not anywhere in texts at all")]
    docs = [(i, text(rng.randrange(0, 60)) + (rng.choice(items)[1] or "") + text(rng.randrange(5))) for i in range(n_docs)]
    docs += [(5, docs[5][1]), (None, docs[6][1]), (None, None), (900, ""), (901, " ! "), (902, "the " * 3000), (903, items[0][1] * 40), (904, "zz YY zz yy")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_against_brute_force(spark, seed):
    docs, items = corpus(random.Random(seed))
    df = spark.createDataFrame([(*d, "k", 7) for d in docs], "doc_id long, text string, item string, row int").repartition(5)
    table = spark.createDataFrame([(*i, "k") for i in items], "item_id long, text string, words string")
    got = sorted((tuple(r) for r in decontaminate.contamination(df, table).collect()), key=repr)
    assert got == brute_hits(docs, items)
    short = sorted((tuple(r) for r in decontaminate.contamination(df, table, width=3).collect()), key=repr)
    assert short == brute_hits(docs, items, 3)


def test_contamination_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert [r.n_hit for r in decontaminate.contamination(docs, items.limit(0)).collect()] == [0]


def test_whole_index_and_proximity(spark):
    """Without a vocabulary every word is stored, and groups of words are found wherever they stand close together."""
    docs, _ = corpus(random.Random(3), n_docs=60)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    tables = Tables(spark, "test-index")
    index = decontaminate.build(tables, df)
    assert index.postings.count() == sum(len(words(t)) for _, t in docs)
    assert sorted(((r.id, r.n_words) for r in index.documents.collect()), key=repr) == sorted(((d, len(words(t))) for d, t in docs), key=repr)
    groups = [(0, ["w1", "w2", "w3"]), (1, ["the", "the", "é"]), (2, ["zz", "yy"]), (3, ["w1", "absent"]), (4, ["a"])]
    queries = spark.createDataFrame(groups, "query long, words array<string>")
    ids = {r.row: r.id for r in index.documents.collect()}
    for span in (2, 5):
        want = Counter()
        for d, t in docs:
            w = words(t)
            for q, group in groups:
                want.update((q, d, i) for i in range(len(w)) if w[i] in group and set(group) <= set(w[i : i + span]))
        got = Counter((r.query, ids[r.row], r.start) for r in decontaminate.proximity(index, queries, span).collect())
        assert got == want


def brute_clusters(rows, k, rounds):
    kept = [(i, [int(np.floor(64.0 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        for j, vs in members.items():
            centroids[j] = [sum(column) // len(vs) for column in zip(*vs)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    by = Counter()
    for _, j, d in last:
        by[j] += d
    return sorted(((i, j, d, by[j], sum(by.values()), clusters.digest(centroids[j])) for i, j, d in last), key=repr)


def vectors_of(rng, n, spread=1.0):
    heads = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(6)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.2) * spread)) for x in rng.choice(heads)]) for i in range(n)]
    odd = [(n, None), (n + 1, [1.0] * 63), (n + 2, [1.0] * 63 + [None]), (n + 3, [1.0] * 63 + [float("nan")]), (n + 4, [float("inf")] + [0.0] * 63), (n + 5, [])]
    return [*rows, *odd, rows[0], rows[0], (rows[1][0], rows[2][1]), (None, rows[3][1])]


@pytest.mark.parametrize("case", ["clustered", "equal", "large", "few", "flat"])
def test_clusters_against_brute_force(spark, case):
    rng = random.Random(case)
    rows = vectors_of(rng, 9 if case == "few" else 260, 0.0 if case == "equal" else 1.0)
    if case == "large":
        rows = [(i, v and [x and x * 3e5 if x == x else x for x in v]) for i, v in rows]
    if case == "flat":  # all vectors on one line
        rows = [(i, [float((i or 0) % 7)] + [0.5] * 63) for i, _ in rows]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, cluster int, v int").repartition(4)
    held = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted((tuple(r) for r in clusters.cluster(clusters.quantised(df)).collect()), key=repr)
    assert got == brute_clusters(held, clusters.K, clusters.ROUNDS)


def test_no_vectors_and_fewer_comparisons(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert clusters.cluster(clusters.quantised(empty)).count() == 0
    rng = random.Random(5)
    rows = [r for r in vectors_of(rng, 3000) if r[1] and len(r[1]) == 64]
    made = clusters.Clusters(clusters.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>")))
    made.step()
    assert made.step() < 0.7 * 16 * len(rows)  # bounds rule centroids out


def test_simplex_bounds_hold():
    rng = np.random.default_rng(1)
    for dim in (3, 64):
        points = rng.integers(-200, 200, (300, dim))
        simplex = clusters.Simplex([list(map(int, p)) for p in points[:20]])
        assert len(simplex.pivots) <= dim + 1
        away = np.stack([np.sqrt(((points - np.array(p)) ** 2).sum(axis=1)) for p in simplex.pivots], axis=1)
        apexes = simplex.apexes(away)
        low, high = clusters.bounds(apexes[:100], apexes[100:])
        real = np.sqrt(((points[:100, None] - points[None, 100:]) ** 2).sum(axis=2))
        assert (low <= real).all() and (real <= high).all()


def brute_audit(docs, least, top):
    every = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for text, lang, source in docs]
    share = lambda n, total, v: 1 + 10**9 * (n + 5) // (total + 5 * v)
    out = []
    for lang in {x[0] for x in every}:
        mine = [x for x in every if x[0] == lang]
        in_docs = Counter(t for x in mine for t in set(x[2]))
        kept = {t for t, n in in_docs.items() if n >= least}
        counts = {s: Counter(t for x in mine if x[1] == s for t in x[2] if t in kept) for s in {x[1] for x in mine}}
        whole = sum(counts.values(), Counter())
        p = {s: {t: share(c[t], sum(c.values()), len(kept)) for t in kept} for s, c in counts.items()}
        for s in counts:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in counts if o != s))
            terms = sorted(((share(whole[t], sum(whole.values()), len(kept)) - p[s][t], t.encode()) for t in kept if counts[s][t]))
            terms = [x for x in terms if x[0] < 0][:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(found)]
    return sorted(out)


def test_audit_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    vocabulary = ["the", "The", "É", "éa", "z", "\U0001f600", *("t" + "abcdefghij"[i % 10] * (1 + i // 10) for i in range(60))]
    docs = []
    for i in range(300):
        bias = rng.randrange(len(vocabulary))
        text = "".join(rng.choice([rng.choice(vocabulary), vocabulary[bias]]) + rng.choice([" ", "1", "_", "\n"]) for _ in range(rng.randrange(0, 40)))
        docs.append((rng.choice([text, None]) if i % 50 == 0 else text, rng.choice(["en", "en", None, "", "de"]), rng.choice(["s1", "s1", "s1", None, "é", "z", f"r{i % 30}"])))
    docs += [docs[0]] * 3 + [("a b", "xx", "s1"), (None, "xx", "s2"), ("w " * 20_000, "en", "s1")]
    df = spark.createDataFrame([(*d, "k", 1) for d in docs], "text string, lang string, source string, term string, n int").repartition(6)
    got = sorted(tuple(r) for r in divergence.audit(df, least_docs=10, top=7).collect())
    assert got == brute_audit(docs, 10, 7)
    assert divergence.audit(df.limit(0)).count() == 0
    monkeypatch.setattr(divergence, "BLOCK", 4)  # several blocks of sources
    monkeypatch.setattr(divergence, "MATRICES", 2)
    monkeypatch.setattr(divergence, "HELD", 50)
    assert sorted(tuple(r) for r in divergence.audit(df, least_docs=10, top=7).collect()) == got


def test_skyband_against_counting():
    rng = np.random.default_rng(2)
    for n in (0, 1, 50, 3000):
        mine, whole = rng.integers(0, 12, n), rng.integers(0, 12, n)
        terms = np.array([b"%06d" % i for i in rng.permutation(n)], object)
        above = np.array([((mine >= mine[i]) & (whole <= whole[i]) & (terms < terms[i])).sum() for i in range(n)])
        assert sorted(divergence.skyband(mine, whole, terms, 5).tolist()) == np.flatnonzero(above < 5).tolist()
