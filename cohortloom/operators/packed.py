"""Several values packed in one field: one row per value, with its place in the list.

Grammar: items are separated by ``;``, ``,``, ``|`` or white space, and white space around a separator
belongs to it; an item may stand in single or double quotes, which may hold separators and doubled
quotes; the list may stand in square brackets. An empty place uses up its number and gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A value is known if it is at least one in so many of all quoted values of the fields, so there are never
#: more known ones than this, whatever the input's size; and the characters that a known value has at most.
ONE_IN, LONGEST_KNOWN = 5_000, 4_096

_SEPARATOR = re.compile(r"\s*[;,|]\s*|\s+")
_BARE = re.compile(r"[^\s;,|]+")
_QUOTED = {'"': re.compile(r'"((?:[^"]|"")*)"'), "'": re.compile(r"'((?:[^']|'')*)'")}

# Costs of the cover: a known value is the cheapest, quoted or not; a stray quote in a bare item the dearest.
_KNOWN, _IN_QUOTES, _BARE_ITEM, _STRAY = 1, 2, 3, 8

OUT = pa.schema([("field_name", pa.string()), ("pos", pa.int64()), ("item", pa.string())])


class Segmenter:
    """Splits packed fields by the cheapest cover of the text with known, quoted and bare items.

    A known value is an item wherever it stands between separators, in quotes or bare, and protects the
    separators that it holds.
    """

    def __init__(self, known: Iterable[str] = ()) -> None:
        import ahocorasick

        self._automaton = ahocorasick.Automaton()
        for value in known:
            if value:
                for written in (value, *(q + value.replace(q, q + q) + q for q in _QUOTED)):
                    self._automaton.add_word(written, (len(written), value))
        self._any = len(self._automaton) > 0
        if self._any:
            self._automaton.make_automaton()

    def _known_at(self, text: str) -> dict[int, list[tuple[int, str]]]:
        """End and value of the known values in ``text`` by their start, all found in one pass."""
        found: dict[int, list[tuple[int, str]]] = {}
        if self._any:
            for last, (length, value) in self._automaton.iter(text):
                found.setdefault(last + 1 - length, []).append((last + 1, value))
        return found

    def split(self, text: str | None) -> list[tuple[int, str]]:
        """``(place, item)`` of each non-empty item; none for null and blank texts."""
        if text is None:
            return []
        text = text.strip()
        if len(text) >= 2 and text[0] == "[" and text[-1] == "]":
            text = text[1:-1].strip()
        if not text:
            return []
        end, known = len(text), self._known_at(text)
        # best[i]: cost, previous start and content of the cheapest cover that has an item start at i.
        best: dict[int, tuple[float, int, str]] = {0: (0, -1, "")}
        # The next separator after each item end; starts are visited from left to right.
        starts, final = [0], None
        pending = {0}
        while starts:
            i = starts.pop(0)
            pending.discard(i)
            cost = best[i][0]
            for stop, price, item in self._items(text, i, end, known):
                total = cost + price
                if stop == end:
                    if final is None or total < final[0]:
                        final = (total, i, item)
                    continue
                nxt = _SEPARATOR.match(text, stop)
                if nxt is None:
                    continue
                j = nxt.end()
                if j not in best or total < best[j][0]:
                    best[j] = (total, i, item)
                    if j not in pending:
                        pending.add(j)
                        _insert(starts, j)
        items: list[str] = []
        assert final is not None  # a bare item always leads on, so some cover exists
        _, at, item = final
        while True:
            items.append(item)
            if at == 0:
                break
            _, at, item = best[at]
        items.reverse()
        return [(n, v) for n, v in enumerate(items, 1) if v]

    @staticmethod
    def _items(text: str, i: int, end: int, known: dict[int, list[tuple[int, str]]]) -> Iterator[tuple[int, float, str]]:
        """End, cost and content of each item that may start at ``i``."""
        if i == end or text[i] in ";,|":
            yield i, 0, ""
            return
        for stop, value in known.get(i, ()):
            if stop == end or _SEPARATOR.match(text, stop):
                yield stop, _KNOWN, value
        quote = _QUOTED.get(text[i])
        if quote is not None and (m := quote.match(text, i)):
            stop = m.end()
            if stop == end or _SEPARATOR.match(text, stop):
                q = text[i]
                yield stop, _IN_QUOTES, m.group(1).replace(q + q, q).strip()
        m = _BARE.match(text, i)
        if m:
            word = m.group()
            stray = '"' in word or "'" in word
            yield m.end(), _BARE_ITEM + (_STRAY if stray else 0), word


def _insert(starts: list[int], j: int) -> None:
    """Put ``j`` into the sorted list; it belongs at or near the end."""
    k = len(starts)
    while k and starts[k - 1] > j:
        k -= 1
    starts.insert(k, j)


def learn_known(df: DataFrame, fields: list[str], one_in: int = ONE_IN) -> list[str]:
    """Values that hold a separator, learned from where they stand in quotes, over all rows and fields.

    Known is what makes up at least one in ``one_in`` of all such values. They are counted in the
    cluster; by that share at most ``one_in`` strings reach the driver.
    """
    lexeme = r"""\"(?:[^\"]|\"\")*\"|'(?:[^']|'')*'|[^\s;,|\"']+"""
    parts = F.flatten(F.array(*[F.coalesce(F.regexp_extract_all(c, F.lit(lexeme), F.lit(0)), F.array().cast("array<string>")) for c in fields]))
    quoted = df.select(F.explode(parts).alias("v")).where(F.col("v").rlike(r"""^[\"'].*[\s;,|]"""))
    q = F.substring("v", 1, 1)
    inner = F.trim(F.replace(F.expr("substring(v, 2, length(v) - 2)"), F.concat(q, q), q))
    counts = quoted.select(inner.alias("v")).where(F.col("v").rlike(r"[\s;,|]") & (F.length("v") <= LONGEST_KNOWN)).groupBy("v").count()
    total = counts.agg(F.sum("count")).scalar()
    return sorted(r[0] for r in counts.where(F.col("count") * F.lit(one_in) >= total).select("v").collect())


def split_packed(df: DataFrame, row_id: str, fields: list[str], known: list[str] | None = None) -> DataFrame:
    """One row ``row_id, field_name, pos, item`` per value of the packed ``fields``.

    A multi-pattern automaton finds the known whole values of a field in one pass, then dynamic
    programming picks the cheapest cover of the text by known, quoted and bare items with separators
    between them; separators inside a chosen item are protected. ``known`` defaults to what
    ``learn_known`` finds: a value that quotes hold together elsewhere is then one item where it stands
    bare, too. Values that are not known are told apart by their quotes alone.

    Null, blank and empty lists give no rows. Repeated rows each give theirs. A quote that is never
    closed is an ordinary character. The whole text counts, however long. No shuffle takes place.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(tuple(learn_known(df, fields) if known is None else known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(shared.value)
        for batch in batches:
            at, names, places, items = [], [], [], []
            for name in fields:
                for i, text in enumerate(batch.column(name).to_pylist()):
                    for place, item in segmenter.split(text):
                        at.append(i)
                        names.append(name)
                        places.append(place)
                        items.append(item)
            ids = batch.column(row_id).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(items, pa.string())], names=[row_id, *OUT.names])

    kind = df.schema[row_id].dataType.simpleString()
    return df.select(row_id, *fields).mapInArrow(run, f"`{row_id}` {kind}, field_name string, pos long, item string")
