"""Toxicity, language identification and BPE."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larkspur.llm import bpe, langid, queries, textbytes, toxicity

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_word_spans_and_hashes():
    texts = ["One two  ONE", "", "\x0btwo\n", "é é", "x" * 5000 + " one"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    hashes, starts, ends = textbytes.words(data, offsets)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert found == ["One", "two", "ONE", "two", "é", "é", "x" * 5000, "one"]
    assert hashes[0] == hashes[2] == hashes[7] and hashes[1] == hashes[3] and hashes[4] == hashes[5]
    assert len(set(hashes.tolist())) == 4


def test_long_buffers_hash_alike(monkeypatch):
    text = " ".join(str(i * i) for i in range(3000)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    whole = textbytes.words(data, offsets)[0]
    monkeypatch.setattr(textbytes, "PIECE_BYTES", 100)
    assert (textbytes.words(data, offsets)[0] == whole).all()


def test_neighbouring_rows_do_not_share_words():
    data = np.frombuffer(b"abcd", np.uint8)
    _, starts, ends = textbytes.words(data, np.array([0, 2, 2, 4]))
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(0, 2), (2, 4)]


def toxic_table(spark, n=600):
    rng = random.Random(1)
    words = [f"w{i}x" for i in range(60)]
    words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
    rows, marks = [], []
    for i in range(n):
        bad = i % 4 == 0
        sentences = [" ".join(rng.choices(words, k=8)) for _ in range(6)]
        if bad:
            sentences[3] += " grumpf"
        rows.append((i, ". ".join(sentences) + ".", "en", f"src{i % 3}"))
        marks.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_toxicity_learns_and_locates(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.train(docs, labels)
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i].predicted == int(i % 4 == 0) for i in held]) > 0.98
    found = toxicity.locate(docs, model).collect()
    assert {r.doc_id for r in found} >= {i for i in held if i % 4 == 0}
    assert all("grumpf" in r.sentence for r in found)
    text = {r.doc_id: r.text for r in docs.collect()}
    assert all(text[r.doc_id].encode()[r.start : r.end].decode() == r.sentence for r in found)


def test_rare_endings_of_a_toxic_stem_are_learned(spark):
    docs, labels = toxic_table(spark)
    rng = random.Random(3)
    ending = {i: "".join(rng.choices("bcdfghjk", k=9)) for i in range(600)}  # no whole word occurs twice
    rows = [(r.doc_id, r.text.replace("grumpf", "grumpf" + ending[r.doc_id])) for r in docs.collect()]
    assert len(set(ending.values())) == 600
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in toxicity.score(odd, toxicity.train(odd, labels)).collect()}
    held = [i for i in out if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([out[i].predicted for i in held if i % 4 == 0]) > 0.9
    assert np.mean([out[i].predicted for i in held if i % 4]) < 0.05


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs, labels = toxic_table(spark)
    turned = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, turned)
    assert np.array_equal(a.vocabulary, b.vocabulary) and np.allclose(a.weights, b.weights) and a.bias == b.bias


def test_toxicity_edge_cases(spark):
    docs, labels = toxic_table(spark, 200)
    model = toxicity.train(docs, labels)
    odd = spark.createDataFrame([(1, None, 5.0), (2, "", 1.0), (None, "?!", 0.0), (4, "grumpf " * 50_000, 0.0), (4, "grumpf", 0.0)], "doc_id long, text string, score double")
    out = toxicity.score(odd, model).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert all(r.worst_start is None for r in out if r.n_sentences == 0) and sum(r.n_sentences == 0 for r in out) == 3
    assert toxicity.score(odd.limit(0), model).count() == 0
    none = toxicity.train(docs, labels.where("toxic = 7"))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.0}


def brute_sentences(text):
    """(byte span of first to last word, words) of each sentence of a text, by the book."""
    import re

    out, at, raw = [], 0, text.encode()
    for piece in re.split(rb"(?<=[.!?\n\r])", raw):
        found = [(m.start(), m.end()) for m in re.finditer(rb"[A-Za-z\x80-\xff]+", piece)]
        if found:
            out.append((at + found[0][0], at + found[-1][1], [piece[a:b].lower() for a, b in found]))
        at += len(piece)
    return out


def features_of(word):
    """The three hashes of a word, from the library's own hashing of that word alone (its own tests check hashing)."""
    return textbytes.words(np.frombuffer(word, np.uint8), np.array([0, len(word)]), letters_only=True, prefixes=toxicity.PREFIXES)[0][0]


def test_noisy_or_and_spans_against_plain_python(spark):
    rng = random.Random(4)
    words = ["alpha", "beta", "gammadelta", "épsilon", "zeta", "Theta"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", ". ", "! ", "?\n", ", ", "1"]) for _ in range(rng.randrange(1, 40))) for _ in range(120)] + ["", None, "?!", "alpha", "Alpha ALPHA. alpha"]
    hashes = sorted({int(h) for w in words for h in features_of(w.lower().encode())} - {0})
    weights = [rng.random() * 3 for _ in hashes]
    model = toxicity.MilModel(np.array(hashes, np.uint64), np.array(weights), -2.5, 0.03)
    table = dict(zip(hashes, weights, strict=True))
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        clean, worst = 1 - 0.03, (-np.inf, None, None)
        found = brute_sentences(text or "")
        for start, end, held in found:
            z = sum(table.get(int(h), 0.0) for w in held for h in features_of(w)) - 2.5
            clean *= 1 - 1 / (1 + np.exp(-z))
            if z > worst[0] + 1e-9:
                worst = (z, start, end)
        assert abs(got[i].score - (1 - clean)) < 1e-9 and got[i].predicted == int(1 - clean >= 0.5)
        assert (got[i].n_sentences, got[i].worst_start, got[i].worst_end) == (len(found), worst[1], worst[2])


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    documents = []
    for i in range(30):
        n = int(rng.integers(3, 20))
        documents.append((int(i % 3 == 0), rng.choice(np.arange(1, 15, dtype=np.uint64), (n, 3)), np.unique(np.append(0, rng.integers(0, n, 3)))))
    vocabulary = np.arange(1, 12, dtype=np.uint64)
    plain = [(y, [[int(h) - 1 for h in hashes[a:b].ravel() if h <= 11] for a, b in zip(first, [*first[1:], len(hashes)], strict=True)]) for y, hashes, first in documents]
    bags = toxicity.Bags([(y, *toxicity.located(hashes, first, vocabulary), len(first)) for y, hashes, first in documents], len(vocabulary))
    w = np.append(rng.random(11), [-1.5, -2.0])

    def loss(w):
        total = 0.0
        for y, sentences in plain:
            clean = 1 / (1 + np.exp(w[-1]))  # exp(-softplus(raw leak))
            for s in sentences:
                clean /= 1 + np.exp(w[-2] + sum(w[k] for k in s))
            total -= np.log(1 - clean) if y else np.log(clean)
        return total / len(plain)

    value, gradient = bags.loss_and_gradient(w)
    assert abs(value - loss(w)) < 1e-9
    for k in range(len(w)):
        step = np.zeros_like(w)
        step[k] = 1e-6
        assert abs((loss(w + step) - loss(w - step)) / 2e-6 - gradient[k]) < 1e-6


def test_vocabulary_counts_documents(spark):
    texts = ["alpha beta. alpha", "beta gamma", "alpha", None, "", "12 !"] + ["delta beta"] * 200
    got = toxicity.vocabulary_of(spark.createDataFrame([(0, t) for t in texts], "y int, text string").withColumn("text", toxicity.F.col("text").cast("binary")))
    want = {int(h) for w in (b"beta", b"delta") for h in features_of(w)} - {0}  # in three texts or more
    assert got.tolist() == sorted(want)


def test_sample_is_bounded_by_bytes(spark):
    docs, labels = toxic_table(spark, 100)
    odd = docs.unionByName(docs.withColumn("text", toxicity.F.repeat("text", toxicity.F.lit(50))))  # of two texts of an id the smaller is read
    sizes = [len(r.text) for r in toxicity.sample_texts(odd, labels).collect()]
    assert len(sizes) == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i in range(100)) and max(sizes) < 1000
    few = [len(r.text) for r in toxicity.sample_texts(odd, labels, limit_bytes=3000).collect()]
    assert 0 < sum(few) <= 3000 and len(few) < len(sizes)
    assert [len(r.text) for r in toxicity.sample_texts(odd, labels, limit=7).collect()] and len(toxicity.sample_texts(odd, labels, limit=7).collect()) == 7


def test_labels_of_other_documents_leave_the_sample_whole(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    assert toxicity.sample_texts(docs, labels, limit=60).count() == docs.where(~toxicity.held_out()).count()


def test_toxicity_query(spark, small_dir):
    out = queries.op5_toxicity_mil(spark, small_dir).collect()
    assert len(out) == spark.read.parquet(f"{small_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)


def test_language_query_and_held_out_accuracy(spark, small_dir):
    out = {r.doc_id: r for r in queries.op9_langid_bayes(spark, small_dir).collect()}
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").collect()
    assert len(out) == len(docs)
    held = [d for d in docs if out[d.doc_id].held_out]
    assert np.mean([out[d.doc_id].lang_pred == d.lang for d in held]) > 0.95


def brute_bucket(gram):
    """Bucket of one n-gram (text in lower case), with plain integers."""
    mask = (1 << 32) - 1
    codes = [ord(c) for c in gram]
    h = (codes[0] + len(gram) * 0x9E3779B1) & mask
    for c in codes[1:]:
        h = ((h ^ h >> 15) * 0x85EBCA6B + c) & mask
    return ((h ^ h >> 15) * 0xC2B2AE35 & mask) >> 17


def brute_grams(text):
    low = text.lower()
    return [low[i : i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)]


CORPUS = [("Hello there", "en"), ("Hola señor", "es"), ("hello", "en"), ("x", None), (None, "en"), ("Grüße, Jürgen! 12", "de"), ("ab", "tie_b"), ("ab", "tie_a")]


def brute_model(rows):
    """language: (documents, counts by bucket), learned as the contract says."""
    model = {}
    for i, text, lang in rows:
        if text is not None and lang is not None and zlib.crc32(str(i).encode()) % 5:
            n, counts = model.setdefault(lang, [0, {}])
            model[lang][0] = n + 1
            for g in brute_grams(text):
                counts[brute_bucket(g)] = counts.get(brute_bucket(g), 0) + 1
    return model


@pytest.mark.parametrize("block", [512, 2, 1])
def test_language_model_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(langid, "BLOCK", block)
    monkeypatch.setattr(langid, "_MANY", 2)
    rows = [(i, t, lang) for i, (t, lang) in enumerate(CORPUS * 7)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    brute = brute_model(rows)
    assert [x for b in model for x in b.languages] == sorted(brute)
    assert all(len(b.languages) <= block for b in model)
    log_prob = np.concatenate([b.log_prob for b in model])
    documents = sum(n for n, _ in brute.values())
    want = {}
    for k, lang in enumerate(sorted(brute)):
        n, counts = brute[lang]
        total = sum(counts.values())
        own = {b: np.log((counts.get(b, 0) + langid.SMOOTHING) / (total + langid.SMOOTHING * langid.BUCKETS)) for b in range(langid.BUCKETS)}
        assert np.allclose(log_prob[k], [own[b] for b in range(langid.BUCKETS)], atol=1e-5)
        want[lang] = (np.log(n / documents), own)
    texts = ["hello there", "señor hola", "123 .,", "", None, "Jürgen", "ab", "xyzzy plugh", "h"]
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, t in enumerate(texts):
        if not t or not any(c.isalpha() for c in t):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        scores = {lang: prior + sum(own[brute_bucket(g)] for g in brute_grams(t)) for lang, (prior, own) in want.items()}
        high = max(scores.values())
        posterior = {lang: np.exp(s - high) for lang, s in scores.items()}
        assert abs(got[i].score - 1 / sum(posterior.values())) < 1e-4
        assert scores[got[i].lang_pred] > high - 1e-4
    # "tie_a" and "tie_b" learned equally often from equal texts: the first by name holds
    equal = spark.createDataFrame([(i, "abc", f"tie_{'ab'[k]}") for k in range(2) for i in (1, 2, 3)], "doc_id long, text string, lang string")
    tied = langid.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), langid.train(equal)).first()
    assert tied.lang_pred == "tie_a" and abs(tied.score - 0.5) < 1e-6


def test_thousands_of_languages_in_bounded_driver_memory(spark):
    """Ten blocks: results equal brute force, and the driver holds one block."""
    import tracemalloc

    rows = [(i, f"w{i % 5000} {chr(0x4E00 + i % 5000)}{'ab' * (i % 3)}", f"l{i % 5000:04}") for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        model = langid.train(docs)
        asked = docs.where("doc_id % 97 = 0")
        got = {r.doc_id: r for r in langid.identify(asked, model).collect()}
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    brute = brute_model(rows)
    assert len(model) == -(-len(brute) // langid.BLOCK) and len(model) > 8
    assert peak < 4 * langid.BLOCK * langid.BUCKETS * 4  # of all blocks it would be more than 8 times one
    documents, sums = sum(n for n, _ in brute.values()), {k: sum(c.values()) + langid.SMOOTHING * langid.BUCKETS for k, (_, c) in brute.items()}
    for i in list(got)[::10]:
        grams = [brute_bucket(g) for g in brute_grams(rows[i][1])]
        scores = {k: np.log(n / documents) + sum(np.log((c.get(b, 0) + langid.SMOOTHING) / sums[k]) for b in grams) for k, (n, c) in brute.items()}
        high = max(scores.values())
        assert scores[got[i].lang_pred] > high - 1e-4
        assert abs(got[i].score - 1 / sum(np.exp(s - high) for s in scores.values())) < 1e-4


def test_language_pieces_sum_exactly():
    rng = np.random.default_rng(0)
    model = langid.NaiveBayes(["a", "b"], rng.normal(size=(2, langid.BUCKETS)).astype(np.float32), np.log([0.5, 0.5]))
    text = "".join(chr(97 + int(x)) for x in rng.integers(0, 26, 3000))
    whole = model._totals([langid._codes(text)])
    old, langid._PIECE = langid._PIECE, 700
    try:
        assert np.allclose(model._totals([langid._codes(text)]), whole)
        assert (langid.ngram_counts([langid._codes(text)]).sum()) == 3 * len(text) - 3
    finally:
        langid._PIECE = old
    two = model._totals([langid._codes("abc"), langid._codes("xyz")])
    assert np.allclose(two[:, 0], model._totals([langid._codes("abc")])[:, 0])


def test_language_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.train(empty)
    odd = spark.createDataFrame([(1, "words", "q"), (None, None, "q")], "doc_id long, text string, lang_pred string")
    assert [(r.lang_pred, r.score) for r in langid.identify(odd, model).collect()] == [("und", 0.0)] * 2
    assert langid.identify(empty, model).count() == 0


ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "etaoin", "'stdlmrve", "!?.,'\"-", "0123456789", "éèêëñüößçA", "ab'sAB12!", "中文字符日本語", "éà̧o", "<|startoftext|>", "αβγΣσς", "İıKﬁ", "\u200b\u00ad\u0085\u00a0\u3000\x1c", " \n\t", "абвгд", "각가나ᅡᆨᄀ", "কোৈাৌ", "ابتث"]


@pytest.fixture(scope="module")
def own_codec():
    return bpe.Codec(PATH)


@pytest.mark.parametrize("seed", range(8))
def test_tree_concatenation_equals_the_library(seed, own_codec):
    rng, tok = random.Random(seed), own_codec.tokenizer
    for _ in range(80):
        letters = "".join(rng.sample(ALPHABETS, rng.randrange(1, 4)))
        text = "".join(rng.choice(letters) for _ in range(rng.choice([300, 700, 1500])))
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "<|startoftext|>", "<|endoftext|>", "'re", "'s's", "the dog's tail ", "naïve café "]) + text[at:]
        tree = bpe.TreeEncoder(own_codec, leaf=rng.choice([32, 64, 256]))
        assert tree.encode([text])[0].tolist() == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("letters", ["etaoinshrdlu", "абвгдежзийклмно", "中文字符日本語漢字", "가나다라마바사각", "αβγδεΣσς", "ابتثجح", "the cat sat on mat "])
def test_joins_look_at_little_text(own_codec, letters):
    rng = random.Random(0)
    text = "".join(rng.choice(letters) for _ in range(30_000))
    tree = bpe.TreeEncoder(own_codec)
    assert tree.encode([text])[0].tolist() == own_codec.tokenizer.encode(text, add_special_tokens=False).ids
    assert tree.joins >= 7 and tree.rejoined < 0.5 * len(text)


def test_long_documents_go_through_the_tree(small_dir):
    import pyarrow.parquet as pq

    texts = [t.encode() for t in pq.read_table(f"{small_dir.replace('0.001', '0.01')}/documents.parquet").column("text").to_pylist() if t]
    codec = bpe.Codec(PATH)
    list(codec.encode(texts))
    assert codec.tree.joins > sum(len(t) > bpe.LONG for t in texts) > 10
    assert codec.tree.rejoined < 0.2 * sum(len(t) for t in texts if len(t) > bpe.LONG)


def test_other_kinds_of_tokenizers_are_refused():
    with pytest.raises(ValueError, match="tokenizer"):
        bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))


def test_codec_round_trip_with_edge_cases(spark):
    tok, rng = Tokenizer.from_file(PATH), random.Random(9)
    texts = [None, "", "  \n", "A b", "<|STARTOFTEXT|> a", "x<|startoftext|>y <|endoftext|>", "\u3000 a \u3000", "z" * 3000, "Don't  stop"]
    texts += ["".join(rng.choice("".join(rng.sample(ALPHABETS, 3)) + "  \n\t") for _ in range(rng.choice([5, 60, 800, 9000]))) for _ in range(150)]
    texts += ["\0" * 20_000, "ab" * 10_000, "a" * 9000 + " b" * 5000, " " * 30_000]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    full = bpe.encode(df.select(df.ids.alias("doc_id"), "text"), PATH)
    for r in full.collect():
        want = tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == want and r.n_tokens == len(want) and r.decoded == tok.decode(want, skip_special_tokens=False)
    assert bpe.encode_digest(df, PATH).count() == len(texts)
    assert bpe.encode_digest(df.limit(0), PATH).count() == 0


def test_bpe_query(spark, small_dir):
    import hashlib

    tok = Tokenizer.from_file(PATH)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    out = queries.op10_bpe_tree(spark, small_dir).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_cache_generations():
    codec = bpe.Codec(PATH)
    old, bpe.CACHE_CHUNKS = bpe.CACHE_CHUNKS, 20
    try:
        for i in range(30):
            text = " ".join(f"word{(i + j) % 37}" for j in range(7))
            assert next(iter(codec.encode([text.encode()]))) == codec.tokenizer.encode(text, add_special_tokens=False).ids
    finally:
        bpe.CACHE_CHUNKS = old
