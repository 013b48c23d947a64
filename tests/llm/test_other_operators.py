import random
from collections import Counter

import public_tokenizers

from eligo.llm import decontaminate as D, preference, token_counts as C
from tests.llm import tables

VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


# ---- token counts ----------------------------------------------------------------------------------------

def greedy(word, pieces, longest):
    at = n = 0
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            if word[at:at + size] in pieces:
                break
        else:
            return 1
        at, n = at + size, n + 1
    return n


def test_automaton_is_greedy_longest_match():
    rng = random.Random(1)
    for _ in range(200):
        pieces = {bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 8))}
        automaton = C.build_automaton(pieces)
        for _ in range(40):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12)))
            assert C.count_pieces(word, automaton) == greedy(word, pieces, 5)


def test_token_counts(docs, no_docs):
    pieces = set(C.read_vocabulary(VOCABULARY))
    longest = max(map(len, pieces))
    want = Counter()
    for r in docs.collect():
        words = (r.text or "").encode().lower().split()
        seen = {w: greedy(b" " + w, pieces, longest) for w in set(words)}
        want[(r.doc_id, len(words), sum(seen[w] for w in words))] += 1
    assert Counter(map(tuple, C.token_counts(docs, VOCABULARY).collect())) == want
    assert C.token_counts(no_docs, VOCABULARY).count() == 0


# ---- decontamination -------------------------------------------------------------------------------------

def least_distance(words, item):
    """Word edit distance of ``item`` to the best window of its size."""
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
        return row[-1]
    return min((distance(words[s:s + len(item)], item) for s in range(len(words))), default=len(item))


def test_edited_items_are_found_and_clean_texts_left_alone():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(tables.SYLLABLES) for _ in range(rng.randint(1, 3))).encode()
    items = [(i, [word() for _ in range(rng.randint(8, 70))]) for i in range(60)]
    index = D.build_index(items)
    texts, want = [], set()
    for t in range(240):
        i, item = items[t % 60]
        copy = list(item)
        for _ in range(rng.randint(0, D.edit_limit(len(item)))):
            at, kind = rng.randrange(len(copy)), rng.random()
            if kind < .5:
                copy[at] = word()
            elif kind < .75:
                del copy[at]
            else:
                copy.insert(at, word())
        words = [word() for _ in range(rng.randint(0, 40))] + copy + [word() for _ in range(rng.randint(0, 40))]
        texts.append(b" \n".join(words))
        if least_distance(words, item) <= D.edit_limit(len(item)):
            want.add((t, i))
    texts += [b" ".join(word() for _ in range(300)) for _ in range(40)]
    got = D.find_items(texts, index)
    found = {(t, i) for t, i, _, _ in got}
    assert len(found & want) >= .97 * len(want)
    by_id = dict(items)
    for t, i, start, d in got:
        words, item = texts[t].split(), by_id[i]
        assert least_distance(words, item) <= d <= D.edit_limit(len(item)) and start < len(words)
    assert not {t for t, _ in found if t >= 240}


def test_decontamination_of_tables(spark, docs, no_docs, tmp_path):
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None and r.text}
    item = " ".join(rows[14].split()[:30])
    bench = tables.write(spark, [(1, item), (2, item.upper()), (3, "too short"), (4, None), (None, "a b c d e f g h i j")],
                         "item_id long, text string", tmp_path, "benchmark", 1)
    got = {(r.doc_id, r.item_id, r.distance) for r in D.contaminated(docs, bench).collect()}
    assert (14, 1, 0) in got and {g[1] for g in got} == {1, 2}  # the second differs in letters beyond A-Z
    clean = D.clean_documents(docs, bench)
    hit = {g[0] for g in got}
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r.doc_id for r in docs.collect() if r.doc_id not in hit)
    assert D.contaminated(no_docs, bench).count() == 0 and D.contaminated(docs, bench.limit(0)).count() == 0
    assert D.clean_documents(docs, bench.limit(0)).count() == docs.count()


def test_blocks_of_items(spark, tmp_path):
    bench = tables.write(spark, [(i, "w%d " % i * 10) for i in range(9)], "item_id long, text string", tmp_path, "benchmark", 2)
    blocks = list(D.item_blocks(bench, block_words=25))
    assert [len(b) for b in blocks] == [2, 2, 2, 2, 1] and [i for b in blocks for i, _ in b] == list(range(9))


# ---- preference pairs ------------------------------------------------------------------------------------

def test_preference_segments(spark, tmp_path):
    talk = {
        0: [(0, "system", "S"), (1, "user", "hi"), (2, "assistant", "yes"), (3, "user", "more")],
        1: [(0, "system", "S"), (1, "user", "hi"), (2, "assistant", "no")],
        2: [(0, "user", None), (1, "assistant", "same")], 3: [(0, "user", None), (1, "assistant", "same")],
        4: [(0, "user", "alone"), (None, "assistant", "last")],
        6: [(0, "user", "a"), (0, "user", "b"), (1, "assistant", "x")], 7: [(0, "user", "a"), (0, "user", "c"), (1, "assistant", "x")],
        None: [(0, "user", "lost")],
    }
    rows = [(c, t, r, x, "clash", "clash") for c, turns in talk.items() for t, r, x in turns]
    table = tables.write(spark, rows, "conv_id long, turn long, role string, text string, pair_id string, part string", tmp_path, "conversations")
    out = preference.preference_segments(table)
    pairs = {r.pair_id: r for r in preference.assemble(out).collect()}
    say = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    assert pairs[0].paired and pairs[0].prompt == say("system", "S") + say("user", "hi")
    assert pairs[0].chosen == say("assistant", "yes") + say("user", "more") and pairs[0].rejected == say("assistant", "no")
    assert pairs[1].prompt == say("user", "") + say("assistant", "same") and pairs[1].chosen == pairs[1].rejected == ""
    assert not pairs[2].paired and pairs[2].chosen == say("user", "alone") + say("assistant", "last") and pairs[2].prompt == ""
    assert pairs[3].prompt == say("user", "a") and pairs[3].rejected == say("user", "c") + say("assistant", "x")
    assert not pairs[None].paired and pairs[None].chosen == say("user", "lost")
    for r in out.collect():
        span = r.rendered[r.trained_from:r.trained_to]
        trained = r.part != "prompt" and r.role == "assistant"
        assert span == (r.rendered.split("|>\n", 1)[1] if trained else "")
    assert preference.preference_segments(table.limit(0)).count() == 0
