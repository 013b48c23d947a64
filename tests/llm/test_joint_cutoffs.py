import random

from eligo.llm import quality
from tests.llm import tables
from tests.llm.test_quality import sample


def test_few_labels_certify_all_rules_together(spark, tmp_path):
    """400 good labels a language suffice at the default rate and delta."""
    rng = random.Random(5)
    docs = tables.write(spark, [sample(rng, i, i % 10 >= 8) for i in range(1000)], tables.SCHEMA, tmp_path)
    labels = tables.write(spark, [(i, int(i % 10 < 8), 0) for i in range(1000)], "doc_id long, quality int, toxic int", tmp_path, "labels")
    assert sorted(r.doc_id for r in quality.judged(docs, labels, joint=True).collect() if r.kept) == [i for i in range(1000) if i % 10 < 8]
    kept = quality.kept_documents(docs, labels, joint=True)
    assert kept.columns == docs.columns and kept.count() == 800


def counted(spark, tmp_path, n):
    """Good documents whose words are long, so that "long words" rejects all at its strictest; no other rule does."""
    row = dict(n_words=100, n_symbols=0, n_dup_lines=0, n_repeat_words=0, n_lines=10, word_chars=1300)
    rows = [(i, "de", *[row[c] for c in quality.COUNTS]) for i in range(n)]
    table = tables.write(spark, rows, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in quality.COUNTS), tmp_path, "counted")
    return table, tables.write(spark, [(i, 1, 0) for i in range(n)], "doc_id long, quality int, toxic int", tmp_path, "labels")


def test_a_rule_that_fits_badly_does_not_hold_up_the_others(spark, tmp_path):
    few, many = [quality.joint_cutoffs(*counted(spark, tmp_path / str(n), n)).collect()[0].cutoffs for n in (300, 2500)]
    assert few == {r: c[0] for r, (_, c) in quality.RULES.items()}
    assert many == {r: c[0] if r == "long words" else c[-1] for r, (_, c) in quality.RULES.items()}


def test_no_labels_no_cutoffs(spark, docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept != r.base_failed for r in quality.judged(docs, labels, joint=True).collect())
    assert quality.judged(no_docs, labels, joint=True).count() == 0
