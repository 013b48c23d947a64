import random
from collections import defaultdict

from eligo.llm import paragraphs as P
from tests.llm import tables


def line_pairs(rows, least, similarity=.8):
    """Pairs ((doc, line text), (doc, line text)) of different lines of ``least`` words that are similar, by comparing all that
    share a shingle."""
    units = []
    for r in rows:
        for line in (r.text or "").encode().split(b"\n"):
            words = line.lower().split()
            if len(words) >= least:
                units.append((r.doc_id, tuple(words), P.shingles(words)))
    holders, out = defaultdict(list), set()
    for n, (doc, words, grams) in enumerate(units):
        seen = defaultdict(int)
        for g in grams:
            for m in holders[g]:
                seen[m] += 1
            holders[g].append(n)
        for m, k in seen.items():
            if units[m][1] != words and k >= similarity * (len(grams) + len(units[m][2]) - k) - 1e-9:
                out.add((m, n))
    return units, out


def test_whole_lines_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    units, pairs = line_pairs(rows, 50)
    assert len(pairs) > 10
    text = {r.doc_id: (r.text or "").encode() for r in rows}
    lines = defaultdict(set)  # words of a reported line -> clusters
    for r in P.shared_passages(docs).filter("size > 1 or n_words >= 50").collect():
        spans = P.paragraph_spans(text[r.doc_id])
        words = tuple(text[r.doc_id][spans[r.pos][0]:spans[r.pos + r["size"] - 1][1]].lower().split())
        lines[words].add(r.cluster)
    missed = [p for p in pairs if not lines[units[p[0]][1]] & lines[units[p[1]][1]]]
    assert len(missed) <= .02 * len(pairs)


def test_changed_word_inside_a_line(spark, tmp_path):
    """A line of 80 words in sentences of 10, with one word changed in the middle of two of them."""
    rng = random.Random(2)
    line = [" ".join("w%d" % rng.randrange(10**6) for _ in range(10)) + "." for _ in range(8)]
    near = list(line)
    near[3] = near[3].replace(near[3].split()[5], "changed")
    rows = [(1, "Alone one.\n" + " ".join(line)), (2, " ".join(near) + "\nAlone two."), (3, " ".join("x%d" % i for i in range(60))),
            (4, "Before it all else went. " + " ".join(line[2:6]) + " After.")]
    docs = tables.write(spark, rows, "doc_id long, text string", tmp_path)
    found = P.shared_passages(docs)
    assert {(r.doc_id, r.pos, r.cluster, r.removed) for r in found.filter("size = 8").collect()} == {(1, 1, 1, False), (2, 0, 1, True)}
    left = {r.doc_id: r.text.split() for r in P.without_paragraphs(docs, found).collect()}
    assert left[1] == rows[0][1].split() and left[2] == ["Alone", "two."] and left[3] == rows[2][1].split()
    assert left[4] == "Before it all else went. After.".split()  # pasted sentences go whatever their line


def test_a_sentence_kept_in_a_removed_line_stays_elsewhere(spark, tmp_path):
    """The first copy of a sentence is in a line that goes as a near-copy and that alone has it: the next copy stays."""
    rng = random.Random(3)
    line = [" ".join("w%d" % rng.randrange(10**6) for _ in range(12)) + "." for _ in range(14)]
    own = " ".join("own%d" % i for i in range(9)) + "."
    docs = tables.write(spark, [(1, " ".join(line)), (2, " ".join([*line, own])), (3, own)], "doc_id long, text string", tmp_path)
    left = {r.doc_id: r.text for r in P.without_paragraphs(docs, P.shared_passages(docs)).collect()}
    assert left[1].split() == " ".join(line).split() and not left[2].split() and left[3] == own


def test_merged_short_paragraphs_are_cut_alike():
    rng = random.Random(7)
    short = lambda n: [[b"w%d" % rng.randrange(10**6) for _ in range(rng.randint(1, 7))] for _ in range(n)]
    passage = short(60)
    cut = [{tuple(map(tuple, words[a:b])) for a, b in P.merged(words, 0, len(words))}
           for words in (passage, [*short(9), *passage, *short(5)], [*short(3), *passage])]
    assert all(len(cut[0] & c) >= .7 * len(cut[0]) for c in cut)
    for words in (passage, [[b"same"]] * 500, passage[:2]):
        parts = P.merged(words, 0, len(words))
        assert [i for a, b in parts for i in range(a, b)] == list(range(len(words)))
        assert all(P.MIN_WORDS <= sum(map(len, words[a:b])) <= 2 * P.LAST_CUT for a, b in parts) or len(parts) == 1


def test_passages_of_short_lines_and_short_pieces(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(10**6)
    verse = [" ".join(word() for _ in range(rng.randint(2, 6))) for _ in range(40)]
    own = lambda: " ".join(word() for _ in range(12)) + "."
    talk = [own(), "Short reply here.", own()]
    rows = [(1, "\n".join([own(), *verse, own()])), (2, "\n".join([own(), *verse, own()])), (3, " ".join([own(), *talk, own()])),
            (4, " ".join([own(), *talk, own()])), (5, " ".join([own(), "Short reply here.", own()])), (6, "Yes indeed."), (7, "Yes  indeed.")]
    docs = tables.write(spark, rows, "doc_id long, text string", tmp_path)
    found = P.shared_passages(docs)
    left = {r.doc_id: r.text.split() for r in P.without_paragraphs(docs, found).collect()}
    lines = rows[1][1].split("\n")
    assert left[2] == (lines[0] + " " + lines[-1]).split()  # all of the verse goes
    assert left[4] == rows[3][1].split()[:12] + rows[3][1].split()[-12:]  # the reply goes with what stands around it
    assert all(left[i] == rows[i - 1][1].split() for i in (1, 3, 5, 6)) and left[7] == []


def _some_rows(rng, n=60):
    own = lambda k: " ".join("w%d" % rng.randrange(10**6) for _ in range(k)) + "."
    rows = [(i, "\n".join(" ".join(own(rng.randint(3, 30)) for _ in range(3)) for _ in range(4))) for i in range(n)]
    near = rows[0][1].split()
    near[len(near) // 2] = "changed"
    return [*rows, (n, rows[1][1]), (n + 1, " ".join(rows[0][1].split())), (n + 2, " ".join(near)), (n + 3, rows[2][1].split("\n")[0])]


def test_only_units_that_share_a_key_are_shuffled(spark, tmp_path, monkeypatch):
    docs = tables.write(spark, _some_rows(random.Random(11)), "doc_id long, text string", tmp_path)
    written, plain = {}, P.materialize

    def counted(df, name, *more):
        out = plain(df, name, *more)
        written[name] = out.count()
        return out

    monkeypatch.setattr(P, "materialize", counted)
    found = P.shared_passages(docs).count()
    rows = docs.selectExpr("doc_id", "cast(text as binary) text")
    units = rows.mapInArrow(lambda it: P._cut(it, True), P.UNITS).count()
    assert found > 30 and written["paragraph-classes"] < units / 3


def test_filter_of_shared_keys(spark, tmp_path):
    """It has every digest met twice and every band key of different digests, few others, and if too small only passes more."""
    docs = tables.write(spark, _some_rows(random.Random(12)), "doc_id long, text string", tmp_path)
    rows = docs.selectExpr("doc_id", "cast(text as binary) text")
    digests, holders = defaultdict(int), defaultdict(set)
    for r in rows.mapInArrow(lambda it: P._cut(it, True), P.UNITS).select("uid", "rep", "d1", "d2", "bands").collect():
        if r.d2 is None:
            digests[r.rep] += 1
        else:
            digests[r.d1 % 2**64] += 1
            digests[r.uid] = digests.get(r.uid, 0)
            for key in r.bands or []:
                holders[key % 2**64].add((r.d1, r.d2))
    lead = {r.uid: r.d1 % 2**64 for r in rows.mapInArrow(lambda it: P._cut(it, True), P.UNITS).filter("uid = rep").select("uid", "d1").collect()}
    want = {d for d, n in digests.items() if n > 1 and d not in lead} | {lead[u] for u, n in digests.items() if u in lead and n}
    want |= {k for k, h in holders.items() if len(h) > 1}
    other = [d for d in {*lead.values(), *holders} if d not in want]
    wanted = P.wanted_keys(rows, True)
    has = lambda keys, f: P.in_filter(P.np.array(list(keys), P.np.uint64), f)
    assert len(want) > 20 and len(other) > 500 and has(want, wanted).all() and has(other, wanted).mean() < .1
    small = P.wanted_keys(rows, True, bits=64)
    assert has(want, small).all()


def test_spans_end_where_they_did():
    """Sentence ends, line ends and cuts of long runs, against the definition word by word."""
    import re
    import zlib

    def plain(text):
        out, at = [], 0
        for m in [*re.finditer(rb"(?<=[.!?])[ \t\x0b\x0c\r]+|\n", text), None]:
            end = m.start() if m else len(text)
            if text[at:end].count(b" ") < P.LONG_RUN:
                out += [(at, end)] if text[at:end].strip() else []
            else:
                first, n, last = None, 0, 0
                for w in re.finditer(rb"[^\x20\x09-\x0D]+", text[at:end]):
                    first, n, last = w.start() if first is None else first, n + 1, w.end()
                    if n >= P.LAST_CUT or zlib.crc32(w.group().lower()) % P.CUT_EVERY == 0:
                        out.append((at + first, at + last))
                        first, n = None, 0
                out += [(at + first, at + last)] if first is not None else []
            at = m.end() if m else end
        return out

    rng = random.Random(5)
    for words in (5, 400):
        for _ in range(150):
            text = b"".join(rng.choice([b"W%d" % rng.randrange(words), b" ", b" ", b" w", b"\t", b". ", b".", b"!\n", b"\r\n", b"\x0b"][:rng.randint(3, 10)]) for _ in range(500))
            assert P.paragraph_spans(text) == plain(text)
