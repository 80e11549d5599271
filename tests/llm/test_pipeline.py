import corpus_pipeline
from skylane.llm.packing import ChunkEncoder
from tests.llm.test_decontamination import brute as contaminated

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    """Each stage on what its predecessor kept; the pieces hold the last
    stage's documents to the token."""
    import public_tokenizers
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.shared_table(stage(spark, docs, SF), name)
        now = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and len(now) == docs.count() and set(now) <= before
        before = set(now)
        if name == "benchmark_decontamination":
            for _, n_words, n_hit, _ in contaminated(list(now.items()), bench):
                assert not (n_hit and 20 * n_hit >= n_words)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    encoder = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {i: len(encoder.text(t)) // 2 + 1 for i, t in now.items()}
    assert {p.doc_id: p.doc_tokens for p in pieces} == tokens
    assert sum(p.length for p in pieces) == sum(tokens.values())
