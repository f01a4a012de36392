import re

import cases

import corpus_pipeline
from orderlens.llm import bpe, decontam, simhash, toxicity
from orderlens.llm.common import documents, labels, stored


def test_stages_keep_what_they_should(spark, small):
    docs = documents(spark, small)
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding"]
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, small), name)
        before = {r["doc_id"]: r for r in docs.collect()}
        kept = {r["doc_id"]: r for r in after.collect()}
        assert len(kept) == after.count()
        if name == "toxicity":
            scored = toxicity.score(docs, toxicity.fit(docs, labels(spark, small)))
            want = {r["doc_id"] for r in scored.collect() if not r["toxic"]}
        elif name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]["text"]), i)
            want = set(first.values())
        elif name == "simhash_near_dedup":
            want = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
        elif name == "benchmark_decontamination":
            found = decontam.contaminated(docs, decontam.benchmark(spark, small)).collect()
            want = set(before) - {r["doc_id"] for r in found}
            items = [" ".join(r["text"].split()) for r in decontam.benchmark(spark, small).collect()]
            assert not any(t in " ".join(before[i]["text"].split()) for i in kept for t in items)
        else:
            want = set(before)
            tool = bpe.Encoder(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
            for i, r in kept.items():
                assert len(tool.encode(before[i]["text"])) == 4 * r["n_tokens"] == 4 * len(r["ids"])
        assert set(kept) == want
        if name != names[-1]:
            assert after.columns == columns and all(kept[i] == before[i] for i in kept)
        docs = after
    assert cases.plain(corpus_pipeline.run(spark, small)) == cases.plain(docs)


def test_stages_on_difficult_rows(spark, small, tmp_path):
    """Nulls, repeated rows, long texts and clashing columns pass through every stage; so does an empty table."""
    for docs in (cases.documents(spark), cases.empty(spark)):
        for name, stage in corpus_pipeline.STAGES:
            after = stored(stage(spark, docs, small), name)
            if name != "bpe_encoding":
                assert after.columns == docs.columns
            docs = after
    assert docs.count() == 0
