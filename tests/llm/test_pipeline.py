import corpus_pipeline
from venueflow.llm import mixing, pii, quality, simhash
from venueflow.session import materialize

import sentencepiece
from test_simhash import plain_components, plain_fingerprint
from llm_fixtures import empty  # noqa: F401

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = materialize(stages["quality_rules"](spark, docs, SF), "t")
    judged = {r["doc_id"] for r in quality.quality(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == judged

    single = materialize(stages["near_dedup"](spark, kept, SF), "t")
    rows = sorted((r["doc_id"], r["text"]) for r in kept.collect())
    roots = plain_components([plain_fingerprint(t) for _, t in rows])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({rows[r][0] for r in roots})

    masked = materialize(stages["mask_private_data"](spark, single, SF), "t")
    assert masked.count() == single.count() and all(not pii.base_spans(r["text"]) for r in masked.collect())

    mixed = materialize(stages["mix_sources"](spark, masked, SF), "t")
    assert mixed.count() == mixing.mix(masked).groupBy().sum("copies").first()[0] and mixed.columns == docs.columns

    out = stages["encode_pieces"](spark, mixed, SF)
    library = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    assert all(r["ids"] == library.encode(r["text"]) for r in out.collect())


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"]


def test_empty_documents(spark, empty):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
    assert docs.count() == 0
