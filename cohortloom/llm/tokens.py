"""Token ids of a public byte-level BPE vocabulary, by a compiled tokenization automaton.

The automaton reads tokens: the state after a token says which tokens may follow in a correct
encoding. It starts as one state that reads every byte, and each merge (u, v) -> w, in order of rank,
adds a gadget: the state that u leads to is split from a copy in which v is no longer allowed, and
wherever u was allowed, w is now allowed too and leads to where v led. So the state behind a token is
a copy of the state behind its right part at the time of its merge, and a token is allowed behind
another as its left part was at its own time.

Tokens are laid out along the two trees that this makes, of right parts and of left parts, each node
behind its parts in order of rank. What a gadget takes away is then one rectangle: the states copied
from that of u after the gadget, times the tokens that came from v after it. States and columns that no
gadget's border tells apart are one, and what is left is a flat table of bits, state times column,
that the driver compiles once and broadcasts: about 17,000 states and 11,000 columns for 50,000 merges.

Every byte string has exactly one path, so each position of a word is reached by one token only, and a
pass from left to right over the trie of arc labels finds it in linear time, each step a look into the
table. Texts are split into words by array operations over their code points; each different word of
a block is encoded once.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.session import fan_out

#: Folder of the public vocabularies, unless a path is given.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the pattern that splits a text before the merges. ``word_starts`` does the same for arrays.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Words whose encoding a task remembers, each shorter than the second; the table starts anew when full.
WORDS_KEPT, WORD_LENGTH = 400_000, 64
#: Characters that are split and encoded at a time.
BLOCK = 1 << 20
#: A place where a longer text may be cut: a white space behind something else always begins a word.
_CUT = re.compile(r"(?<=\S)[ \n]")

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def character_classes() -> np.ndarray:
    """Space, letter, number or other of each code point, by the Unicode tables of the ``regex`` package."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_SPACE, r"\p{White_Space}+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            lo, hi = m.span()
            out[ord(every[lo]) : ord(every[hi - 1]) + 1] = kind
    out[0xD800:0xE000] = _OTHER
    return out


def word_starts(codes: np.ndarray, kinds: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the words of ``SPLIT`` start in texts laid end to end, which start at ``begins``.

    ``codes`` are the code points, ``kinds`` their classes. Words are the runs of one class, but that a
    blank in front belongs to the next word, a longer run of spaces leaves its last one apart, and an
    apostrophe on its own takes an English ending with it.
    """
    n = len(codes)
    first = np.zeros(n + 1, bool)
    first[begins] = True
    first[n] = True
    start = first.copy()
    start[1:n] |= kinds[1:] != kinds[:-1]
    runs = np.flatnonzero(start)
    lo, hi = runs[:-1], runs[1:]
    kind, inner = kinds[lo], ~first[hi]
    spaces = np.flatnonzero((kind == _SPACE) & inner)
    last = hi[spaces] - 1
    start[last] = True
    blank = codes[last] == 32
    start[hi[spaces[blank]]] = False
    quotes = np.flatnonzero((hi - lo == 1) & (codes[lo] == 39) & inner & start[lo])
    quotes = quotes[kind[quotes + 1] == _LETTER] if len(quotes) else quotes
    if len(quotes):
        at, end = hi[quotes], hi[quotes + 1]
        a, b = codes[at], codes[np.minimum(at + 1, n - 1)]
        two = (at + 1 < end) & (((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108)))
        taken = np.where(np.isin(a, (100, 109, 115, 116)), 1, np.where(two, 2, 0))
        start[at[taken > 0]] = False
        rest = (taken > 0) & (at + taken < end)
        start[(at + taken)[rest]] = True
    return np.flatnonzero(start[:n])


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files, and its byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load_merges(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]]]:
    """Ids of all tokens and the merges in order of rank, as bytes, from a vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = byte_letters()
    raw = lambda s: bytes(letters[c] for c in s)
    ids = {raw(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return ids, [(raw(a), raw(b)) for a, b in merges]


class MergeGadgets:
    """The automaton as it grows by one gadget after another."""

    def __init__(self) -> None:
        self.labels: list[bytes] = [bytes([b]) for b in range(256)]
        self.number = {label: i for i, label in enumerate(self.labels)}
        self.left, self.right, self.rank = array("i", range(256)), array("i", range(256)), array("i", [-1] * 256)
        self.merges: list[tuple[int, int]] = []
        self.rank_of: dict[int, int] = {}
        # Tokens made from each token as their right part, whose states are copies of its state, and as their left part.
        self.copies: list[list[int]] = [[] for _ in range(256)]
        self.heirs: list[list[int]] = [[] for _ in range(256)]

    def allowed(self, x: int, y: int) -> bool:
        """Whether the state behind ``x`` now allows ``y``, by following both back through the gadgets."""
        rank, before, closed = self.rank, len(self.merges), False
        while True:
            at = self.rank_of.get(x << 32 | y)
            if at is not None and (at < before or closed and at == before):
                return False
            i, j = rank[x], rank[y]
            if i > j:  # the state behind x began as a copy of the one behind its right part
                before, closed, x = i, False, self.right[x]
            elif j > i:  # y was allowed where its left part was, after the split of its own gadget
                before, closed, y = j, True, self.left[y]
            elif i < 0:
                return True
            else:  # the same token twice
                before, closed, x, y = i, False, self.right[x], self.left[y]

    def add(self, u: bytes, v: bytes) -> None:
        """The gadget of the merge of ``u`` and ``v``: the token that it makes, with a copy of the state behind ``v``.

        A merge whose parts never stand together, since earlier merges always take one of them, has no
        arcs to change and makes no token.
        """
        a, b = self.number.get(u), self.number.get(v)
        if a is None or b is None or not self.allowed(a, b):
            return
        token = self.number[u + v] = len(self.labels)
        rank = len(self.merges)
        self.labels.append(u + v)
        self.left.append(a)
        self.right.append(b)
        self.rank.append(rank)
        self.copies.append([])
        self.heirs.append([])
        self.copies[b].append(token)
        self.heirs[a].append(token)
        self.merges.append((a, b))
        self.rank_of[a << 32 | b] = rank

    def _layout(self, children: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Place of each token, and the first place of its tree: children by rank, then the node."""
        place, low = np.zeros(len(children), np.int64), np.zeros(len(children), np.int64)
        n = 0
        for root in range(256):
            path = [(root, 0)]
            while path:
                node, i = path.pop()
                if i < len(children[node]):
                    child = children[node][i]
                    path += [(node, i + 1), (child, 0)]
                    low[child] = n
                else:
                    place[node] = n
                    n += 1
                    if node < 256:
                        low[node + 1 : 256] = n
        return place, low

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State behind each token, column of each token, and the bits of which column a state does not allow."""
        row, row_low = self._layout(self.copies)
        col, col_low = self._layout(self.heirs)
        cut = np.zeros((len(self.merges), 4), np.int64)
        for r, (a, b) in enumerate(self.merges):
            copies, heirs = self.copies[a], self.heirs[b]
            i = bisect_right(copies, r, key=self.rank.__getitem__)
            # Where both parts are equal, the token just made is not allowed behind its part either.
            j = (bisect_left if a == b else bisect_right)(heirs, r, key=self.rank.__getitem__)
            cut[r] = row_low[copies[i]] if i < len(copies) else row[a], row[a] + 1, col_low[heirs[j]] if j < len(heirs) else col[b], col[b] + 1
        row_borders, col_borders = np.unique(cut[:, :2]), np.unique(cut[:, 2:])
        states, columns = len(row_borders) + 1, len(col_borders) + 1
        box = np.column_stack([np.searchsorted(row_borders, cut[:, :2], "right"), np.searchsorted(col_borders, cut[:, 2:], "right")])
        bits = np.zeros((states, (columns + 7) // 8), np.uint8)
        for at in range(0, states, 1024):
            part = np.zeros((min(1024, states - at), columns), np.uint8)
            for x0, x1, y0, y1 in box[(box[:, 0] < at + 1024) & (box[:, 1] > at)].tolist():
                part[max(x0 - at, 0) : x1 - at, y0:y1] = 1
            bits[at : at + len(part)] = np.packbits(part, axis=1, bitorder="little")
        return np.searchsorted(row_borders, row, "right").astype(np.int32), np.searchsorted(col_borders, col, "right").astype(np.int32), bits


class TokenAutomaton:
    """The compiled automaton of a list of merges over the 256 bytes: flat arrays, sent to the tasks as such."""

    def __init__(self, ids: dict[bytes, int], merges: list[tuple[bytes, bytes]]) -> None:
        gadgets = MergeGadgets()
        for u, v in merges:
            gadgets.add(u, v)
        self.labels = gadgets.labels
        self.state, self.column, self.bits = gadgets.table()
        self.ids = np.array([ids[label] for label in self.labels], np.int32)
        self.label_of = {i: label for label, i in ids.items()}
        self.classes = character_classes()
        self._prepare()

    def __getstate__(self) -> tuple:
        pack = lambda x: (zlib.compress(np.ascontiguousarray(x).tobytes(), 1), x.dtype.str, x.shape)
        return self.labels, self.label_of, [pack(x) for x in (self.state, self.column, self.bits, self.ids, self.classes)]

    def __setstate__(self, kept: tuple) -> None:
        self.labels, self.label_of, packed = kept
        self.state, self.column, self.bits, self.ids, self.classes = (np.frombuffer(zlib.decompress(data), kind).reshape(shape) for data, kind, shape in packed)
        self._prepare()

    def _prepare(self) -> None:
        self._stride = self.bits.shape[1]
        self._flat = self.bits.tobytes()
        self._rows = (self.state.astype(np.int64) * self._stride).tolist()
        self._columns, self._ids = self.column.tolist(), self.ids.tolist()
        self._token = {label: i for i, label in enumerate(self.labels)}
        self._trie: list[dict[int, int]] = [{}]
        self._token_at: list[int] = [-1]
        for token, label in enumerate(self.labels):
            self._add_label(token, label)
        self._words: dict[int, array] = {}
        # A word's key is a sum of its code points' random numbers times powers of an odd number.
        self._random = np.random.default_rng(64).integers(1, 1 << 63, 0x110000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self._powers = self._inverse = np.empty(0, np.uint64)

    def _add_label(self, token: int, label: bytes) -> None:
        node = 0
        for byte in label:
            nxt = self._trie[node].get(byte)
            if nxt is None:
                nxt = self._trie[node][byte] = len(self._trie)
                self._trie.append({})
                self._token_at.append(-1)
            node = nxt
        self._token_at[node] = token

    def allows(self, x: int, y: int) -> bool:
        """Whether the state behind token ``x`` allows token ``y``."""
        c = self._columns[y]
        return not self._flat[self._rows[x] + (c >> 3)] >> (c & 7) & 1

    def encode_word(self, word: str) -> array:
        """Ids of one pre-split word."""
        data = word.encode("utf-8", "surrogatepass")
        whole = self._token.get(data)
        if whole is not None:  # the start allows every token, and there is one path only
            return array("i", [self._ids[whole]])
        n = len(data)
        behind = [-1] * (n + 1)  # the one token that ends at each position
        trie, token_at, flat, rows, columns, labels = self._trie, self._token_at, self._flat, self._rows, self._columns, self.labels
        for i in range(n):
            state = behind[i]
            if i and state < 0:
                continue
            row = rows[state] if i else -1
            node, j = 0, i
            while j < n:
                node = trie[node].get(data[j], -1)
                if node < 0:
                    break
                j += 1
                token = token_at[node]
                if token >= 0 and behind[j] < 0:
                    c = columns[token]
                    if row < 0 or not flat[row + (c >> 3)] >> (c & 7) & 1:
                        behind[j] = token
        out, j = array("i"), n
        while j:
            token = behind[j]
            out.append(self._ids[token])
            j -= len(labels[token])
        out.reverse()
        return out

    def _keys(self, codes: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """A key of 64 bits for each word, by which equal words of a task are known."""
        n = len(codes)
        if n > len(self._powers):
            odd = 0x9E3779B97F4A7C15
            size = max(n, 2 * BLOCK)
            self._powers = np.cumprod(np.full(size, odd, np.uint64))
            self._inverse = np.cumprod(np.full(size, pow(odd, -1, 1 << 64), np.uint64))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self._random[codes] * self._powers[:n], out=sums[1:])
        return (sums[np.append(lo[1:], n)] - sums[lo]) * self._inverse[lo]

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and how many each has."""
        whole = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        if not whole:
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.cumsum(sizes) - sizes
        lo = word_starts(codes, self.classes[codes], begins[sizes > 0])
        which, keys = pd.factorize(self._keys(codes, lo))
        sample = np.empty(len(keys), np.int64)
        sample[which[::-1]] = np.arange(len(which))[::-1]
        ends = np.append(lo[1:], len(codes))
        flat, lengths = array("i"), array("q")
        words = self._words
        for key, a, b in zip(keys.tolist(), lo[sample].tolist(), ends[sample].tolist(), strict=True):
            known = words.get(key)
            if known is None:
                known = self.encode_word(whole[a:b])
                if b - a < WORD_LENGTH:
                    if len(words) >= WORDS_KEPT:
                        words.clear()
                    words[key] = known
            flat.extend(known)
            lengths.append(len(known))
        pool, count = np.array(flat, np.int32), np.array(lengths, np.int64)
        offset = np.cumsum(count) - count
        n_of = count[which]
        before = np.cumsum(n_of) - n_of
        total = int(n_of.sum())
        ids = pool[np.repeat(offset[which] - before, n_of) + np.arange(total)]
        upto = np.append(before, total)
        at = np.searchsorted(lo, begins)
        return ids, upto[np.searchsorted(lo, begins + sizes)] - upto[at]

    def encode_texts(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of ids of the texts in order, and how many each of the next texts has; null and empty texts have none."""
        held: list[str] = []
        size = 0
        for text in texts:
            text = text or ""
            if size and size + len(text) > BLOCK:
                yield self.encode_block(held)
                held, size = [], 0
            if len(text) > BLOCK:
                blocks = [self.encode_block([piece])[0] for piece in _pieces(text)]
                ids = np.concatenate(blocks)
                if held:
                    yield self.encode_block(held)
                    held, size = [], 0
                yield ids, np.array([len(ids)])
            else:
                held.append(text)
                size += len(text)
        if held:
            yield self.encode_block(held)

    def encode(self, text: str | None) -> list[int]:
        return [i for ids, _ in self.encode_texts([text]) for i in ids.tolist()]

    def decode(self, ids: list[int] | None) -> str | None:
        """The text whose arc labels ``ids`` are; null for null, and an error for an unknown id."""
        if ids is None:
            return None
        return b"".join(self.label_of[i] for i in ids).decode("utf-8", "replace")


def _pieces(text: str) -> Iterator[str]:
    """A text cut where words begin, into pieces a little longer than a block."""
    at = 0
    while at < len(text):
        m = _CUT.search(text, at + BLOCK)
        end = m.start() if m else len(text)
        yield text[at:end]
        at = end


def shared_automaton(df: DataFrame, path: str | None) -> Callable[[], TokenAutomaton]:
    """A function by which tasks get the automaton that the driver compiled.

    Its size depends on the vocabulary alone, so it is broadcast; a worker process unpacks it once.
    """
    shared = df.sparkSession.sparkContext.broadcast(TokenAutomaton(*load_merges(path or os.path.join(TOKENIZERS, VOCABULARY))))
    return lambda: shared.value


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (array of int) of every row, without special tokens.

    Null and empty texts have an empty list; blank ones have the ids of their white space. The string
    of a special token in a text is ordinary text. Repeated rows each give a row; whole texts count,
    however long, in time linear in their length. Other columns are ignored. No shuffle takes place, unless
    the input has too few partitions to keep the slots busy.
    """
    automaton = shared_automaton(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = automaton()
        for batch in batches:
            at = 0
            for ids, counts in tool.encode_texts(batch.column(1).to_pylist()):
                ends = np.zeros(len(counts) + 1, np.int32)
                np.cumsum(counts, out=ends[1:])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(counts)), lists], names=[key, "ids"])
                at += len(counts)

    return fan_out(df.select(key, text)).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, ids array<int>")


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key`` and ``n_tokens`` of every row; the ids themselves are not kept."""
    automaton = shared_automaton(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = automaton()
        for batch in batches:
            sizes = [counts for _, counts in tool.encode_texts(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.empty(0, np.int64), *sizes]), pa.int64())], names=[key, "n_tokens"])

    return fan_out(df.select(key, text)).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, n_tokens long")


def decode_ids(df: DataFrame, key: str = "doc_id", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``key`` and the ``text`` that each list of ids stands for: the arc labels in order."""
    automaton = shared_automaton(df, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = automaton()
        for batch in batches:
            texts = [tool.decode(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return df.select(key, F.col(ids)).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, text string")
