import random

from eligo.llm import decontaminate as D
from tests.llm import tables


def plain_distance(item, text):
    """Least word edit distance of ``item`` to a beginning of ``text``."""
    row = list(range(len(text) + 1))
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_prefix_distance():
    rng = random.Random(1)
    for _ in range(2000):
        item, text = ([rng.randrange(4) for _ in range(rng.randint(a, 14))] for a in (1, 0))
        limit = rng.randint(0, 5)
        assert D.prefix_distance(item, text, limit) == min(plain_distance(item, text), limit + 1)


def edited(rng, word, item, edits, kinds):
    copy = list(item)
    for _ in range(edits):
        at, kind = rng.randrange(len(copy)), rng.choice(kinds)
        if kind == "change":
            copy[at] = word()
        elif kind == "delete":
            del copy[at]
        else:
            copy.insert(at, word())
    return copy


def test_recall_over_all_planted_copies():
    """Every copy planted with at most k edits counts, whatever its length came to."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(tables.SYLLABLES) for _ in range(rng.randint(1, 3))).encode()
    items = [(i, [word() for _ in range(rng.randint(8, 70))]) for i in range(100)]
    index, by_id = D.build_index(items), dict(items)
    for kinds, least in ((("change", "change", "delete", "insert"), .95), (("change",), .95), (("insert",), .93), (("delete",), .9)):
        texts = []
        for i, item in items * 2:
            copy = edited(rng, word, item, D.edit_limit(len(item)), kinds)
            texts.append(b" ".join([word() for _ in range(rng.randint(0, 40))] + copy + [word() for _ in range(rng.randint(0, 40))]))
        found = D.find_items(texts, index, free_end=True)
        assert len({(t, i) for t, i, _, _ in found if i == t % 100}) >= least * len(texts)
        for t, i, start, d in found:
            assert d == plain_distance(by_id[i], texts[t].split()[start:]) <= D.edit_limit(len(by_id[i]))


def test_tables_find_shortened_and_lengthened_copies(spark, tmp_path):
    words = ["w%d" % i for i in range(50)]
    short = [w for i, w in enumerate(words) if i % 5 != 4]  # ten words less
    long = [x for i, w in enumerate(words) for x in ([w, "new%d" % i] if i % 5 == 4 else [w])]  # nine inside
    around = ["x%d" % i for i in range(60)]
    rows = [(i, " ".join(around + copy + around)) for i, copy in enumerate((words, short, long, words[:30]))]
    docs = tables.write(spark, rows, "doc_id long, text string", tmp_path)
    bench = tables.write(spark, [(1, " ".join(words))], "item_id long, text string", tmp_path, "benchmark", 1)
    assert {(r.doc_id, r.distance) for r in D.contaminated(docs, bench).collect()} == {(0, 0), (1, 10), (2, 9)}
    assert [r.doc_id for r in D.clean_documents(docs, bench).collect()] == [3]


def test_short_items_are_all_found():
    """Items under 8 words: every copy within their limit of 0 or 1 edits, and nothing else, by brute force."""
    rng = random.Random(6)
    word = lambda: rng.choice(tables.SYLLABLES).encode()  # noqa: E731  few words, so that much is nearly alike
    items = [(i, [word() for _ in range(1 + i % 7)]) for i in range(70)]
    index = D.build_index(items)
    texts = [b" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(40)]
    for i, item in items:
        copy = edited(rng, word, item, D.edit_limit(len(item)), ("change", "delete", "insert"))
        texts.append(b" ".join([b"other"] * rng.randint(0, 3) + copy + [b"words"] * rng.randint(0, 3)))
    got = {(t, i): (start, d) for t, i, start, d in D.find_items(texts, index, free_end=True)}
    want = {}
    for t, text in enumerate(texts):
        ws = text.split()
        for i, item in items:
            d, start = min(((plain_distance(item, ws[s:s + len(item) + 1]), s) for s in range(len(ws))), default=(99, 0))
            if d <= D.edit_limit(len(item)):
                want[t, i] = (start, d)
    assert got == want


def test_query_on_a_written_folder(spark, tmp_path):
    words = [f"w{i}" for i in range(40)]
    long = " ".join(f"x{i % 977}" for i in range(300_000))
    rows = [(1, " ".join(words)), (2, long + " Who wrote it " + long), (None, "who wrote it"), (2, None), (3, "who wrote"), (3, "")]
    tables.write(spark, rows, "doc_id long, text string", tmp_path)
    tables.write(spark, [(5, " ".join(words[5:30])), (6, "Who wrote it"), (7, None), (8, " ")], "item_id long, text string", tmp_path, "benchmark", 1)
    got = D.op7_query(spark, str(tmp_path))
    assert got.columns == ["doc_id", "item_id", "start_word", "distance"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, 5, 5, 0), (2, 6, 300_000, 0), (None, 6, 0, 0)]))
