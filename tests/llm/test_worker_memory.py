"""What Python workers keep and are handed at a time."""

import corpus_pipeline
from orderloom.llm import bpe, queries


def test_a_worker_remembers_ids_alone():
    with open(queries.WORDS_49K, "rb") as file:
        encoder = bpe.Encoder(file.read())
    packed, decoded, n = encoder.encode("Again and again, naïve words")
    assert n == len(packed) // 4 and decoded == encoder.decode(packed)
    assert encoder.remembered and all(type(ids) is bytes for ids in encoder.remembered.values())


def test_stages_hand_over_small_batches(spark):
    before = spark.conf.get(corpus_pipeline.BATCH)
    try:
        for given, kept in (("10000", "1000"), ("0", "1000"), ("300", "300")):
            spark.conf.set(corpus_pipeline.BATCH, given)
            docs = spark.createDataFrame([(1, "a word")], "doc_id long, text string")
            corpus_pipeline.as_tokens(spark, docs, "")
            assert spark.conf.get(corpus_pipeline.BATCH) == kept
    finally:
        spark.conf.set(corpus_pipeline.BATCH, before)
