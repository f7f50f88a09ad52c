import os
import random

import pytest

from cohortloom.llm import tokens as T

PATH = os.path.join(T.TOKENIZERS, T.VOCABULARY)


@pytest.fixture(scope="module")
def automaton():
    return T.TokenAutomaton(*T.load_merges(PATH))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


PIECES = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", " ", "1", "٩", "é", "é", "<|endoftext|>", "'s", "'ll", "aaaa", "!!", "...", "遺伝子", "🧬", "​", "ZZZZZZ", "-" * 9]


def test_like_the_library(automaton, library):
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30)))
        assert automaton.encode(text) == library(text)
        assert automaton.decode(automaton.encode(text)) == text


def test_random_words(automaton, library):
    rng = random.Random(6)
    for _ in range(3000):
        word = "".join(rng.choice("aeinrstlo") for _ in range(rng.randint(1, 30)))
        assert automaton.encode(word) == library(word)


def test_long_words_take_linear_time(automaton, library):
    for text in ("a" * 20_000, "-" * 3001, "0123456789" * 500, " " * 999, "ab" * 3000):
        assert automaton.encode(text) == library(text)


def test_merges_of_equal_parts():
    ids = {bytes([b]): b for b in range(256)} | {b"aa": 300, b"aaaa": 301, b"ab": 302}
    tool = T.TokenAutomaton(ids, [(b"a", b"a"), (b"aa", b"aa"), (b"a", b"b")])
    want = {"a": [97], "aa": [300], "aaa": [300, 97], "aaaa": [301], "aaaaa": [301, 97], "aaab": [300, 302], "aab": [300, 98], "ab": [302]}
    assert {k: tool.encode(k) for k in want} == want


class Textbook:
    """The automaton with all its arcs, changed by each gadget as the construction says."""

    def __init__(self, letters):
        self.arcs = [dict.fromkeys(letters, 0)]

    def add(self, u, v):
        old = [dict(a) for a in self.arcs]
        split = {}
        for t in sorted({a[u] for a in old if u in a}):
            if v in old[t]:
                split[t] = len(self.arcs)
                self.arcs.append({y: q for y, q in old[t].items() if y != v})
        for a in self.arcs:
            t = a.get(u)
            if t in split:
                a[u], a[u + v] = split[t], old[t][v]

    def reads(self, tokens):
        state = 0
        for y in tokens:
            state = self.arcs[state].get(y)
            if state is None:
                return False
        return True


MERGE_LISTS = [
    ["a b", "ab c", "b c", "c a", "abc a", "a bc", "bc a", "ca b"],
    ["a a", "aa aa", "a b", "aa a", "b aa", "aaaa a", "b b", "bb a"],
    ["c b", "a cb", "cb a", "b a", "cb cb", "ba c", "acb ba", "c c", "cc c", "cc cc"],
]


@pytest.mark.parametrize("merges", MERGE_LISTS)
def test_states_after_each_gadget(merges):
    import itertools

    book, gadgets = Textbook([b"a", b"b", b"c"]), T.MergeGadgets()
    sizes = []
    for merge in merges:
        u, v = (x.encode() for x in merge.split(" "))
        book.add(u, v)
        gadgets.add(u, v)
        state, column, bits = gadgets.table()
        own = [b"a", b"b", b"c", *gadgets.labels[256:]]
        at = {x: gadgets.number[x] for x in own}
        allowed = lambda x, y: not bits[state[at[x]], column[at[y]] >> 3] >> (column[at[y]] & 7) & 1  # noqa: E731, B023
        for x, y in itertools.product(own, repeat=2):
            assert book.reads([x, y]) == allowed(x, y)
        rng = random.Random(len(own))
        for _ in range(200):
            path = [rng.choice(own) for _ in range(5)]
            assert book.reads(path) == all(allowed(x, y) for x, y in itertools.pairwise(path))
        sizes.append(len({tuple(bits[state[at[x]]]) for x in own}))
    assert sizes[0] > 1 and sizes[-1] > sizes[0]


def test_merges_that_never_apply_make_no_token():
    gadgets = T.MergeGadgets()
    for u, v in ((b"a", b"b"), (b"b", b"c"), (b"a", b"bc"), (b"ab", b"c"), (b"x", b"abcd")):
        gadgets.add(u, v)
    assert gadgets.labels[256:] == [b"ab", b"bc", b"abc"] and len(gadgets.merges) == 3


def test_words_start_where_the_pattern_says(automaton):
    import numpy as np
    import regex

    rng = random.Random(8)
    pieces = ["'s", "'re", "'l", "'", "'ll", "''s", " ", "  ", "\n", "\x1c", "\x85", "\u2003", "a", "re", "D", "9", "\u0669", "!", "\u00e9", "\u907a", "-"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    whole = "".join(texts)
    codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) for t in texts])
    lo = T.word_starts(codes, automaton.classes[codes], (np.cumsum(sizes) - sizes)[sizes > 0])
    assert [whole[a:b] for a, b in zip(lo, [*lo[1:], len(whole)], strict=True)] == [w for t in texts for w in regex.findall(T.SPLIT, t)]


def test_blocks_and_cuts_change_nothing(automaton, monkeypatch):
    rng = random.Random(9)
    texts = [None if rng.random() < 0.1 else "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    want = [automaton.encode(t) for t in texts]
    monkeypatch.setattr(T, "BLOCK", 40)
    monkeypatch.setattr(T, "WORDS_KEPT", 5)
    counts, flat = [], []
    for ids, n in automaton.encode_texts(texts):
        flat += ids.tolist()
        counts += n.tolist()
    assert flat == [i for w in want for i in w] and counts == [len(w) for w in want]


def test_the_compiled_tables_travel(automaton):
    import pickle

    data = pickle.dumps(automaton)
    assert len(data) < 8_000_000
    assert pickle.loads(data).encode("Hello world, it's 42") == automaton.encode("Hello world, it's 42")


def test_table(spark, library):
    docs = spark.createDataFrame([(1, "Hello world", "x"), (1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (4, " \n", "x"), (5, "b" * 50_000, None)], "doc_id long, text string, ids string")
    rows = T.encode_texts(docs)
    assert dict(rows.dtypes)["ids"] == "array<int>"
    got = sorted((r.doc_id, r.ids) for r in rows.collect())
    assert got == sorted((i, library(t) if t else []) for i, t, _ in docs.collect())
    back = {r.doc_id: r.text for r in T.decode_ids(rows).collect()}
    assert back[1] == "Hello world" and back[2] == "" and back[5] == "b" * 50_000
    assert {r.doc_id: r.n_tokens for r in T.count_tokens(docs).collect()}[3] == 0
    assert T.encode_texts(docs.limit(0)).count() == 0
