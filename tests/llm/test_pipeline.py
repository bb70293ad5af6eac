"""The pipeline against plain Python, stage by stage and as a whole."""

import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from ledgerlink.llm.rules import STATISTICS, learn_quality, text_statistics
from tests.llm.conftest import SF, wide
from tests.llm.test_documents import contaminated_by_hand, groups_of


def by_hand(rows, items, rules):
    """(ids kept after each filtering stage) for rows with different ids."""
    stats = np.array([text_statistics((t or "").encode()) for _, t in rows])
    good = [r for r, s in zip(rows, rules.predict(stats, list(STATISTICS))) if s >= 0.7]
    least = {i: c for i, _, c in groups_of(good)}
    distinct = [r for r in good if least[r[0]] == r[0]]
    bad = {x[0] for x in contaminated_by_hand(distinct, items)}
    return [i for i, _ in good], [i for i, _ in distinct], [r for r in distinct if r[0] not in bad]


def test_stages_and_run(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = sorted((r.doc_id, r.text) for r in documents.collect())
    good, distinct, clean = by_hand(rows, items, learn_quality(documents, labels))
    assert len(good) > len(distinct) > len(clean) > 0

    docs, kept = documents, []
    for _, apply in corpus_pipeline.STAGES[:-1]:
        docs = apply(spark, docs, SF)
        assert docs.columns == documents.columns
        docs = spark.createDataFrame(docs.collect(), documents.schema)
        kept.append(sorted(r.doc_id for r in docs.collect()))
    assert kept == [good, distinct, [i for i, _ in clean]]

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {i: library.encode(t, add_bos=True, add_eos=True) for i, t in clean}
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want


def test_last_stage_decodes(spark, documents):
    assert corpus_pipeline.STAGES[-1] == ("SentencePiece encoding and decoding", corpus_pipeline.encode)
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    some = documents.limit(100)
    texts = {r.doc_id: r.text for r in some.collect()}
    out = corpus_pipeline.encode(spark, spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), SF)
    assert out.columns == ["doc_id", "n_tokens", "ids", "ends", "decoded"]
    want = {i: library.decode(library.encode(t, add_bos=True, add_eos=True)) for i, t in texts.items()}
    assert {r.doc_id: r.decoded for r in out.collect()} == want


def test_stages_bear_hard_rows(spark, edges, empty, edge_rows):
    for name, apply in corpus_pipeline.STAGES:
        out = apply(spark, edges, SF)
        assert 0 < out.count() <= len(edge_rows), name
        if apply is not corpus_pipeline.encode:
            assert out.columns == edges.columns and out.schema == edges.schema
        assert apply(spark, empty, SF).count() == 0
    same = wide(spark, [(i, "the same few words of text in every row") for i in range(300)])
    assert corpus_pipeline.keep_distinct(spark, same, SF).collect()[0].doc_id == 0
