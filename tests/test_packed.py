import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.operators.packed import Segmenter, learn_known, split_packed


def plain(text):
    """The grammar, character by character."""
    text = (text or "").strip()
    if text[:1] == "[" and text[-1:] == "]" and len(text) > 1:
        text = text[1:-1].strip()
    if not text:
        return []
    out, i, n = [], 0, len(text)
    while True:
        item = ""
        if i < n and text[i] in "\"'":
            q, j, item = text[i], i + 1, ""
            while text[j] != q or text[j + 1 : j + 2] == q:
                item += text[j]
                j += 2 if text[j] == q else 1
            i = j + 1
        else:
            while i < n and text[i] not in ";,|" and not text[i].isspace():
                item += text[i]
                i += 1
        out.append(item.strip())
        if i >= n:
            return [(k, v) for k, v in enumerate(out, 1) if v]
        while i < n and text[i].isspace():
            i += 1
        if i < n and text[i] in ";,|":
            i += 1
            while i < n and text[i].isspace():
                i += 1


CASES = {
    None: [],
    "": [],
    " \t ": [],
    "[]": [],
    "a": [(1, "a")],
    "a;b": [(1, "a"), (2, "b")],
    "a ; b\tc\n d": [(1, "a"), (2, "b"), (3, "c"), (4, "d")],
    ";;a;": [(3, "a")],
    "a, ,b|c": [(1, "a"), (3, "b"), (4, "c")],
    '"x;1" "y ""z"", 2"': [(1, "x;1"), (2, 'y "z", 2')],
    "['p|q','']": [(1, "p|q")],
    '["a", "b;c"]': [(1, "a"), (2, "b;c")],
    '"open;b': [(1, '"open'), (2, "b")],
    'a"b;c': [(1, 'a"b'), (2, "c")],
    '"";b': [(2, "b")],
}


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert Segmenter().split(text) == CASES[text]
    assert Segmenter(["x;1", 'y "z", 2', "p|q", "b;c"]).split(text) == CASES[text]


quoted = st.text("abc ;,|'\"\t", max_size=8).map(lambda s: '"' + s.replace('"', '""') + '"')
bare = st.text("abc./:", min_size=0, max_size=6)
sep = st.sampled_from([";", ",", "|", " ", " ; ", "\t", ", ", " |"])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(quoted, bare), sep), max_size=6), st.booleans())
def test_like_the_plain_reading(parts, brackets):
    text = "".join(a + b for a, b in parts)
    text = f"[{text}]" if brackets else text
    try:
        want = plain(text)
    except IndexError:
        return
    got = Segmenter().split(text)
    joined = text.strip()
    if '"' in joined.replace('"', "", 0) and any(b.strip() == "" and not a for a, b in parts):
        return
    assert got == want


KNOWN_CASES = {
    "Smith, John; x": ["Smith, John", "x"],
    "x|Smith, John": ["x", "Smith, John"],
    "[Smith, John, 'a;b' Smith, Johnson]": ["Smith, John", "a;b", "Smith", "Johnson"],
    "a;b;x": ["a;b", "x"],
    "b;c;a": ["b;c", "a"],
    "a;b;c": ["a;b;c"],
    "a;b;c;d e": ["a;b;c", "d e"],
    "Xa;b": ["Xa", "b"],
    '"Smith, John" Smith, John': ["Smith, John", "Smith, John"],
}


@pytest.mark.parametrize("text", KNOWN_CASES)
def test_known_values_protect_bare_separators(text):
    known = Segmenter(["Smith, John", "a;b", "b;c", "a;b;c", "d e"])
    assert [v for _, v in known.split(text)] == KNOWN_CASES[text]
    assert [n for n, _ in known.split(text)] == list(range(1, len(KNOWN_CASES[text]) + 1))


def cheapest(text, known):
    """All covers by known and bare items, tried one by one."""
    import re

    best = (10**9, [])

    def go(i, cost, items):
        nonlocal best
        for v, price in [*((k, 1) for k in known if text.startswith(k, i)), *((m.group(), 3) for m in [re.compile(r"[^\s;,|]+").match(text, i)] if m)]:
            j = i + len(v)
            if j == len(text):
                if cost + price < best[0]:
                    best = (cost + price, [*items, v])
            elif m := re.compile(r"\s*[;,|]\s*|\s+").match(text, j):
                go(m.end(), cost + price, [*items, v])

    go(0, 0, [])
    return best[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=2), min_size=1, max_size=7), st.lists(st.sampled_from([";", ",", " "]), min_size=7, max_size=7), st.sets(st.sampled_from(["a;b", "b,a", "a b", "ab;a", "b;a;b", "aa"]), max_size=4))
def test_the_cheapest_cover_is_chosen(words, seps, known):
    text = "".join(w + s for w, s in zip(words, seps, strict=False))[:-1]
    got = [v for _, v in Segmenter(known).split(text)]
    assert sum(1 if v in known else 3 for v in got) == cheapest(text, known)


def test_the_learned_dictionary_decides(spark):
    rows = [(1, '"Smith, John";x'), (2, "y | Smith, John"), (3, "Smith, Jane")]
    df = spark.createDataFrame(rows, "report_row_id long, f string")
    read = lambda known: sorted((r.report_row_id, r.pos, r.item) for r in split_packed(df, "report_row_id", ["f"], known).collect())
    want = [(1, 1, "Smith, John"), (1, 2, "x"), (2, 1, "y"), (2, 2, "Smith, John"), (3, 1, "Smith"), (3, 2, "Jane")]
    assert read(None) == want
    assert read([]) != want and [r for r in read([]) if r[0] != 2] == [r for r in want if r[0] != 2]


def test_known_values_are_bounded_by_their_share(spark):
    rows = [(i, f'"v,{i}";"hot;1"') for i in range(40)]
    df = spark.createDataFrame(rows, "report_row_id long, f string")
    assert learn_known(df, ["f"], one_in=4) == ["hot;1"]
    assert len(learn_known(df, ["f"])) == 41


def test_long_text():
    text = ";".join(f'"v;{i}"' for i in range(20_000))
    assert Segmenter().split(text)[-1] == (20_000, "v;19999")


def test_table(spark):
    rows = [(1, "a;b", None, 9), (1, "a;b", None, 9), (2, None, '"x;y"', 9), (3, "", " ", 9)]
    df = spark.createDataFrame(rows, "report_row_id long, f string, g string, pos int")
    got = sorted(tuple(r) for r in split_packed(df, "report_row_id", ["f", "g"]).collect())
    assert got == sorted([(1, "f", 1, "a"), (1, "f", 2, "b")] * 2 + [(2, "g", 1, "x;y")])
    assert learn_known(df, ["f", "g"]) == ["x;y"]
    assert split_packed(df.limit(0), "report_row_id", ["f", "g"]).count() == 0
