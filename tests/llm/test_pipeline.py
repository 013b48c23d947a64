import corpus_pipeline
from eligo.llm import decontaminate, mixing, quality, sharding, simhash
from eligo.llm.common import materialize

SF = "/root/testdata/sf0.001"


def test_stages_apply_their_operators(spark):
    """Each stage against a plain application of its operator's findings to the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    outs = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = materialize(stage(spark, docs, SF), f"stage-{k}")
        ids = sorted(r.doc_id for r in out.collect())
        before = sorted(r.doc_id for r in docs.collect())
        if k == 0:
            judged = quality.judged(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
            assert ids == sorted(r.doc_id for r in judged if r.kept)
        elif k == 1:
            found = simhash.near_duplicates(docs).collect()
            assert ids == sorted({r.component_id for r in found}) and {r.doc_id for r in found} == set(before)
        elif k == 2:
            hits = decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
            assert ids == sorted(set(before) - {r.doc_id for r in hits})
        elif k == 3:
            taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(docs)[1].collect()}
            for i in before:
                t, s = taken[i]
                assert t // s <= ids.count(i) <= -(-t // s)
        else:
            assert ids == before and {r.shard for r in out.collect()} == set(range(sharding.SHARDS))
        assert k == 4 or out.columns == docs.columns
        outs.append(out)
        docs = out
    final = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, final.select("doc_id", "shard").collect())) == sorted(map(str, outs[-1].select("doc_id", "shard").collect()))
