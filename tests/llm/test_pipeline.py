"""The pipeline's stages against what they say, on the smallest tables."""

import hashlib

import corpus_pipeline as cp
import public_tokenizers
from tokenizers import Tokenizer

from larkspur.llm import langid, mixing, neardup, toxicity


def test_stages_one_by_one(spark, small_dir, tmp_path):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        before = docs
        stage(spark, docs, small_dir).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        kept[name] = (before, docs)
    before, after = kept["toxicity"]
    model = toxicity.train(before, spark.read.parquet(f"{small_dir}/labels.parquet"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in toxicity.score(before, model).where("score < 0.5").collect()}
    before, after = kept["language"]
    found = langid.identify(before, langid.train(before))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in found.where("lang_pred <> 'und' and score >= 0.5").collect()}
    before, after = kept["near_duplicates"]
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in neardup.near_duplicates(before).where("doc_id = component_id").collect())
    before, after = kept["mix"]
    quality = mixing.quality_of(spark.read.parquet(f"{small_dir}/labels.parquet"))
    weighed = before.join(quality, before.doc_id == quality.q_id, "left")
    copies = {r.doc_id: r.copies for r in mixing.mix(weighed, quality=weighed.quality_weight).collect()}
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in copies.items() if n} and max(got.values()) <= 3
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    last = cp.STAGES[-1][1](spark, docs, small_dir).collect()
    assert len(last) == docs.count()
    for r in last:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    whole = cp.run(spark, small_dir)
    assert sorted((r.doc_id, r.n_tokens) for r in whole.collect()) == sorted((r.doc_id, r.n_tokens) for r in last)


EXTRA = ["kept_id", "size", "copy", "copies", "doc", "id", "row", "tie", "toxicity_score", "lang_found", "lang_score", "words", "quality_weight", "q_id", "taken"]


def test_stages_take_odd_rows_and_empty_tables(spark, small_dir, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in EXTRA)
    more = tuple(range(len(EXTRA)))
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "the cat sat on the mat " * 9, "en", None, 1), (2, "the cat sat on the mat " * 9, "en", None, 1), (3, "un chat est sur la table", "fr", "b", 3)]
    rows += [(10 + i, f"the dog number{i} and the house{i} of the man{i}", "en", "b", 1) for i in range(12)]
    odd = spark.createDataFrame([(*r, *more) for r in rows], schema)
    for i, start in enumerate((odd, odd.limit(0))):
        docs = start
        for name, stage in cp.STAGES:
            stage(spark, docs, small_dir).write.parquet(str(tmp_path / f"{i}{name}"))
            docs = spark.read.parquet(str(tmp_path / f"{i}{name}"))
            if name != "bpe":
                assert docs.columns == odd.columns
                assert all(tuple(r)[5:] == more for r in docs.collect())
        assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert (docs.count() > 0) is (i == 0)


def test_near_duplicate_stage_judges_rows(spark):
    a, b, c = "a b c d e f g h", "q w e r t y u i", "z x c v b n m k"
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def left(rows):
        df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], schema)
        return sorted((r.doc_id or -1, r.text) for r in cp.drop_near_duplicates(spark, df, "").collect())

    assert left([(3, a), (5, a), (5, b), (7, c)]) == [(3, a), (5, b), (7, c)]
    assert left([(3, a), (None, a), (None, b)]) == [(-1, b), (3, a)]


def test_mix_draws_good_documents_earlier(spark, tmp_path):
    docs = spark.createDataFrame([(i, "w w w w", "a" if i % 2 else "b") for i in range(4000)], "doc_id long, text string, source string")
    spark.createDataFrame([(i, int(i % 4 < 2)) for i in range(4000)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = [r.doc_id for r in cp.mix_sources(spark, docs, str(tmp_path)).where("source = 'b'").collect()]
    good = sum(i % 4 < 2 for i in got)
    assert good > 1.3 * (len(got) - good) > 0
