from collections import Counter, defaultdict

from eligo.llm import paragraphs as P
from tests.llm import tables


def plain_clusters(rows, similarity=.8):
    """{(doc_id, place): (cluster, spans, removed)} by comparing all paragraphs that share a shingle."""
    units = []
    for r in rows:
        text = (r.text or "").encode()
        for place, (s, e) in enumerate(P.paragraph_spans(text)):
            words = text[s:e].lower().split()
            if len(words) >= P.MIN_WORDS:
                units.append((r.doc_id, place, tuple(words), P.shingles(words)))
    units.sort(key=lambda u: (u[0] is None, u[0] or 0, u[1]))
    root = list(range(len(units)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = defaultdict(list)
    for n, (_, _, words, grams) in enumerate(units):
        shared = Counter(m for g in grams for m in holders[g])
        for m, k in shared.items():
            if units[m][2] == words or k >= similarity * (len(grams) + len(units[m][3]) - k) - 1e-9:
                root[find(n)] = find(m)
        for g in grams:
            holders[g].append(n)
    groups = defaultdict(list)
    for n in range(len(units)):
        groups[find(n)].append(n)
    out = []
    for members in groups.values():
        if len(members) > 1:
            spans = len({units[m][0] for m in members}) > 1
            out += [(*units[m][:2], units[members[0]][0], spans) for m in members]
    return Counter(out), sum(len(m) - 1 for m in groups.values())


def test_clusters_of_awkward_rows(docs, no_docs):
    want, removed = plain_clusters(docs.collect())
    found = P.shared_paragraphs(docs)
    rows = found.collect()
    assert Counter((r.doc_id, r.pos, r.cluster, r.spans) for r in rows) == want and sum(r.removed for r in rows) == removed
    assert P.shared_paragraphs(no_docs).count() == 0


def test_near_copies_and_removal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    want, removed = plain_clusters(rows)
    found = P.shared_paragraphs(docs)
    got = found.collect()
    missing = want - Counter((r.doc_id, r.pos, r.cluster, r.spans) for r in got)
    assert sum(missing.values()) <= .02 * sum(want.values())
    gone = defaultdict(set)
    for r in got:
        if r.removed:
            gone[r.doc_id].add(r.pos)
    for r in P.without_paragraphs(docs, found).collect():
        text = next(x.text for x in rows if x.doc_id == r.doc_id).encode()
        left = [text[s:e] for p, (s, e) in enumerate(P.paragraph_spans(text)) if p not in gone[r.doc_id]]
        assert r.text.encode().split() == b" ".join(left).split()


def test_spans_cover_all_words():
    rng_text = ("One two three. Four! " * 3 + "\n\n" + "word " * 200 + "x.y z?  \t end\r\n" + " ".join("w%d" % i for i in range(100))).encode()
    spans = P.paragraph_spans(rng_text)
    assert [w for s, e in spans for w in rng_text[s:e].split()] == rng_text.split()
    assert all(e1 <= s2 for (_, e1), (s2, _) in zip(spans, spans[1:])) and P.paragraph_spans(b" \n ") == []


def test_blocks_of_a_large_bucket(spark, tmp_path):
    """Near-copies in one bucket are joined even if the bucket is cut into many blocks."""
    words = ["w%d" % i for i in range(38)]
    texts = [" ".join([*words, "v%d" % i]) for i in range(40)]
    docs = tables.write(spark, list(enumerate(texts)), "doc_id long, text string", tmp_path)
    rows = docs.selectExpr("doc_id", "cast(text as binary) text")
    classes = P.materialize(rows.mapInArrow(P._cut, P.UNITS).repartition("d1", "d2").sortWithinPartitions("d1", "d2", "uid")
                            .mapInArrow(P._classes, P.CLASSES), "classes")
    roots = P.connected_components(P.near_links(rows, classes, block=4)).collect()
    assert len(roots) == 40 and len({r.root for r in roots}) == 1
