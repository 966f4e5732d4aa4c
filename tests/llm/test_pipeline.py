"""The pipeline stage by stage, on the given documents and on edges."""

import corpus_pipeline
from limnos.llm import decontaminate, quality, secrets, simhash, tokens
from limnos.llm.queries import TOKENIZER
from limnos.llm.shared import saved
from tests.llm.conftest import SF


def test_stages_take_effect(spark, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = saved(stage(spark, docs, SF), name)
        assert after.columns == documents.columns
        kept[name] = (docs, after)
        docs = after
    before, after = kept["quality_classifier"]
    model = quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality.score(before, model).where("predicted = 1").collect()}
    before, after = kept["simhash_near_dedup"]
    groups = simhash.duplicate_groups(before).collect()
    assert sorted(r.doc_id for r in after.collect()) == sorted({r.component_id for r in groups}) and after.count() < before.count()
    before, after = kept["benchmark_decontamination"]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontaminate.contamination(before, benchmark).where("size(hit_words) > 0")
    assert found.count() > 0 and decontaminate.contamination(after, benchmark).where("size(hit_words) > 0").count() == 0
    marked = {r.doc_id for r in found.collect()}
    unchanged = {r.doc_id: r.text for r in before.collect() if r.doc_id not in marked}
    assert unchanged.items() <= {r.doc_id: r.text for r in after.collect()}.items()
    before, after = kept["secret_scans"]
    assert secrets.find_secrets(before).where("size(spans) > 0").count() > 0 == secrets.find_secrets(after).where("size(spans) > 0").count()
    packed = corpus_pipeline.packed_sequences(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in after.collect()}


def test_stages_on_edges_and_nothing(spark, edges, nothing):
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, edges, SF).count()
        assert stage(spark, nothing, SF).count() == 0, name


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and rows.count() > 0


def test_packing_remembers_fewer_pieces(monkeypatch):
    """Its workers share the executor with the memory of the stages before; ids are the same however few are remembered."""
    asked = []
    monkeypatch.setattr(corpus_pipeline.packing, "pack", lambda docs, path, **more: asked.append(more["generation"]))
    corpus_pipeline.packed_sequences(None, None, SF)
    assert asked[0] < tokens.GENERATION
    few, texts = tokens.Encoder(TOKENIZER, 3), ["some words, more words", "and\nothers by the dozen"]
    assert few.encode(texts, 0) == tokens.encoder(TOKENIZER).encode(texts, 0)
    assert len(few.after_blank) <= 3 + 5
