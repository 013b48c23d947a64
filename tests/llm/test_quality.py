import math
import random
import re
from collections import Counter

from eligo.llm import quality
from tests.llm import tables


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered)


def test_counts_and_base_rules(spark, docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = sorted(quality.judged(docs, labels).collect(), key=str)
    want = Counter((r.doc_id, *plain_counts(r.text)) for r in docs.collect())
    assert want == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed)


def test_binomial_tail_and_sequence():
    for n, k, p in ((10, 0, .1), (10, 3, .4), (200, 1, .02), (5000, 20, .01)):
        exact = sum(math.comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1)) if n <= 200 else None
        got = quality.binomial_tail(k, n, p)
        assert exact is None or abs(got - exact) < 1e-9
        assert 0 < got <= 1
    assert quality.binomial_tail(30, 100, .1) == 1.0
    assert quality.strictest_certified([0, 0, 1, 40, 0], 1000, .02, .01) == 2
    assert quality.strictest_certified([0], 0, .02, .01) == -1 and quality.strictest_certified([0], 20, .02, .01) == -1


def sample(rng, i, bad):
    words = [rng.choice(tables.SYLLABLES) + rng.choice(tables.SYLLABLES) + str(rng.randrange(10**6)) for _ in range(60)]
    if bad:
        words = [w + "###" for w in words]
    return (i, " ".join(words), "en" if i % 2 else None, "s", *["x"] * len(tables.CLASHING))


def test_certified_cutoffs_drop_junk_and_keep_good(spark, tmp_path):
    rng = random.Random(5)
    rows = [sample(rng, i, i % 10 >= 8) for i in range(2400)] + [(9000, "too short", "xx", "s", *["x"] * len(tables.CLASHING))]
    docs = tables.write(spark, rows, tables.SCHEMA, tmp_path)
    marks = [(i, int(i % 10 < 8), 0) for i in range(2000)] + [(8, None, None), (None, 1, 0), (1, 1, 1), (777777, 1, 0)]
    labels = tables.write(spark, marks, "doc_id long, quality int, toxic int", tmp_path, "labels")
    out = quality.judged(docs, labels).collect()
    # 400 good English and 400 good null-language rows: enough at the rates below, not at the defaults.
    assert all(r.kept == (not r.base_failed) for r in out)
    counted = quality.with_counts(docs.select("doc_id", quality.stratum().alias("stratum"), "text"), "c").select("doc_id", "stratum", "c.*")
    cutoffs = {r.stratum: r.cutoffs for r in quality.certified_cutoffs(counted, labels, max_false_rejection=.1).collect()}
    assert set(cutoffs) == {"en", None} and all(c["symbols per word"] == 0.05 for c in cutoffs.values())
    kept = quality.kept_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 2400


def test_promise_holds_on_fresh_documents():
    """Chance that a certified cutoff rejects more than allowed stays under delta."""
    rng, rate, delta, broken = random.Random(6), .05, .1, 0
    for _ in range(300):
        true = [.01, .03, .06, .1]  # share of good documents that each cutoff rejects
        draws = [rng.random() for _ in range(400)]
        at = quality.strictest_certified([sum(d < t for d in draws) for t in true], 400, rate, delta)
        broken += at >= 2
    assert broken <= 300 * delta


def test_empty(spark, no_docs, docs):
    labels = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.judged(no_docs, labels).count() == 0 and quality.kept_documents(no_docs, labels).count() == 0
