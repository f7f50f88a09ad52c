"""Pages made of repeated keywords, lists of links or product tags rather than of sentences or records."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.session import cut_lineage, fan_out

# Frequent function words; characters with that role in Chinese and Japanese.
FUNCTION_WORDS = {
    "en": "the of and to in is was were are be by for with that this which on at as from it its not no than but or an a had has have while when whether so if after before under into our we they their there these those each most every can could did does do will would neither nor although once only what where who his her you your still together how may might must should been being about over than then both more such",
    "fr": "le la les l un une de des du d et à au aux dans sur pour par avec sans que qui qu est sont été a ont ne pas n se s ce cette ces il elle on nous vous leur plus mais ou où si tandis lorsque après avant puis doit doivent peut peuvent avait était étaient parfois si y leurs mes tes",
    "de": "der die das den dem des ein eine einer einem einen und oder in im an auf mit von zu zur zum für aus bei nach vor ist sind war wurden wurde wird werden nicht kein keine sich es wir ihr sie als auch dass ob obwohl deshalb durch wie noch über unter zwischen muss müssen musste mussten kann können konnte konnten soll sollen hat haben hatte hatten wenn weil",
    "es": "el la los las un una unos unas de del y o a al con por para sin que se no es son fue fueron ha han lo le su sus como más pero si entre sobre después antes mientras tras puede pueden debe deben había era eran está están cada ni",
}
FUNCTION_CHARACTERS = "的了是和与及对从中为被将把其后再未没有这请否は が を に の と で も た し い か ら れ る て な".replace(" ", "")

#: A line counts as prose from this share of its language's usual function words on.
PROSE_SHARE = 0.42
#: The usual share before any document is seen, which counts as much as so many documents.
PRIOR_DOCUMENTS, USUAL_WORDS, USUAL_CHARACTERS = 20, 0.36, 0.25
#: The calibrated share is at least this part of the usual one, as where a language's lines in a script are mostly names.
FLOOR = 0.8
#: Claimed languages whose Latin words are in the lists above; ``und`` stands for none.
LISTED = frozenset({*FUNCTION_WORDS, "zh", "ja", "und"})
#: In any other language the function words are those in at least this share of its documents, and the usual
#: share is this quantile.
LEARNED_SHARE, LEARNED_QUANTILE = 0.2, 0.2
#: The languages that have most pages and no more learned words together are broadcast; texts of the others meet theirs by a shuffle.
BROADCAST_LANGUAGES, BROADCAST_WORDS = 1_000, 500_000
#: Rows of the calibration that are broadcast at most.
BROADCAST_ROWS = 100_000
#: Texts in a script without a list, whose claim is a listed language or none, are one language.
OTHER_SCRIPT = "other-script"
#: A language's own threshold is at least so many times what is usual in it.
ABOVE_USUAL = 1.75
#: Thresholds of the page, where its language does not need higher ones.
SPAM_SHARE, LEAST_WORDS = 0.5, 12
TOP_NGRAM, TOP_WORD, FEW_DISTINCT, SAME_LINES, SEPARATORS, PRICES, LINKS = 0.30, 0.14, 0.5, 0.3, 0.15, 3, 3

_WORDS = frozenset(w for words in FUNCTION_WORDS.values() for w in words.split())
_CHARACTERS = frozenset(FUNCTION_CHARACTERS)
#: By which words a line may be measured.
MEASURES = ("latin", "cjk", "learned")
_INVISIBLE = re.compile("[​‌‍⁠﻿­]")
_BREAK = re.compile(r"(?:<br\s*/?>|</?(?:div|p|li|ul|ol|tr|td|h[1-6])\b[^>]*>|[\r\n\v\f\x85  ])+", re.I)
_NEWLINE = re.compile(r"[\r\n\v\f\x85\u2028\u2029]+")
_LINK = re.compile(r"<a\b[^>]*>.*?</a>|\[url[^\]]*\].*?\[/url\]|!?\[[^\]\n]*\]\([^)\s]*\)|(?:https?|ftp)://[^\s<>\")\]]+|(?:www\.)?[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}/[^\s<>\")\]]*|www\.[^\s<>\")\]]+", re.I)
_TAG = re.compile(r"<[^<>]*>|\[/?(?:url|b|i|img)\b[^\]]*\]", re.I)
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
_CJK = re.compile("[぀-ヿ㐀-鿿]")
# Letters of the scripts that no list above covers.
_OTHER = re.compile("[\u0370-\u1dff\u1f00-\u1fff\u2c00-\u2ddf\u3130-\u318f\ua000-\ua71f\ua780-\ud7ff\ufb1d-\ufdff\ufe70-\ufefc]")
_OTHER_IN_SQL = r"[\p{L}&&[^\p{IsLatin}\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsCommon}]]{3}"
_CJK_PARTS = re.compile("[\u3040-\u30ff\u3400-\u9fff]|[^\u3040-\u30ff\u3400-\u9fff]+")
_CJK_SENTENCE = re.compile("[\u3040-\u30ff\u3400-\u9fff]{3}\u3002|[\u3040-\u30ff\u3400-\u9fff]{6}[\uff01\uff1f]|[\u3040-\u30ff\u3400-\u9fff]{9}")
_ADDRESS = re.compile(r"\]\([^)\s]*\)")
_PRICE = re.compile(r"[$€£¥]\s?[0-9]|[0-9]\s?(?:€|EUR|USD|元|円)")
_SEPARATOR = re.compile(r"[·•|›»/;,#!、，；>~*]|\s-\s")
_RECORD_HEAD = re.compile(
    r"\s*\[?[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}"  # a log line
    r"|[^\s,;_]+_[^\s,;]*(?:[,;][^,;]*){3,}$"  # a table's head
    r"|\s*[\w.\-]+\s*:?=\s*\S|\s*```|\s*[{}]|\s*\[[^\]]*\]\s*$|\s*[\[\]],?\s*$"  # code and settings
)
_CHECKSUM = re.compile(r"(?<![0-9A-Za-z_])[0-9a-f]{24,}(?![0-9A-Za-z_])")
_MONEY = re.compile("[$€£¥元円]|EUR|USD")


def _is_record(line: str) -> bool:
    """Whether the line is a row of a table, a log, settings, or has a checksum."""
    return line.count("\t") >= 2 or _RECORD_HEAD.match(line) is not None or _CHECKSUM.search(line) is not None


def _bare(line: str) -> str:
    """A line's words: anchors of links stay, addresses and tags go."""
    if "](" in line:
        line = _ADDRESS.sub("] ", line)
    if "<" in line or "[/" in line:
        line = _TAG.sub(" ", line)
    return _LINK.sub(" ", line) if _may_link(line) else line


def _may_link(line: str) -> bool:
    return "/" in line or "www." in line


def _split_words(text: str) -> list[str]:
    """Words in lower case without digits at either end; Chinese and Japanese characters are words each."""
    words = _WORD.findall(text.lower())
    if not text.isascii() and _CJK.search(text):
        return [p for w in words for p in (_CJK_PARTS.findall(w) if _CJK.search(w) else [w])]
    return words


def _function_share(words: list[str], cjk: bool) -> float:
    """Share of function words, or of function characters in a line of Chinese or Japanese."""
    if cjk:
        own = [w for w in words if _CJK.match(w)]
        return sum(w in _CHARACTERS for w in own) / max(1, len(own))
    known = sum(map(_WORDS.__contains__, words))
    if "'" in "".join(words):
        known += sum("'" in w and w not in _WORDS and w.split("'")[0] in _WORDS for w in words)
    return known / max(1, len(words))


class Page:
    """A text by lines: how much of it are links, records, bare words and sentences, and how often words recur.

    ``unlisted`` tells that the claimed language has no list; its lines, and all in a script without a
    list, are measured by the ``learned`` words.
    """

    def __init__(self, text: str | None, unlisted: bool = False, learned: frozenset[str] = frozenset()) -> None:
        clean = _INVISIBLE.sub("", text or "").replace("\u2019", "'")
        # Each line: kind, size, words, share of function words, by which words: latin, cjk or learned.
        self.lines: list[tuple[str, int, list[str], float, str]] = []
        self.links = self.prices = self.separators = 0
        for line in _BREAK.split(clean) if "<" in clean else _NEWLINE.split(clean):
            size = len(line.strip())
            if not size:
                continue
            if _is_record(line):
                self.lines.append(("record", size, [], 0.0, "latin"))
                continue
            linked = [m.end() - m.start() for m in _LINK.finditer(line)] if _may_link(line) else []
            bare = _bare(line)
            words = _split_words(bare)
            by, plain = "learned" if unlisted else "latin", bare.isascii()
            if not plain:
                letters = sum(map(len, words))
                if len(_CJK.findall(bare)) * 2 > letters:
                    by = "cjk"
                elif len(_OTHER.findall(bare)) * 2 > letters:
                    by = "learned"
            share = sum(w in learned for w in words) / max(1, len(words)) if by == "learned" else _function_share(words, by == "cjk")
            if sum(linked) * 2 >= size:
                kind = "link"
            else:
                kind = "sentence" if not plain and _CJK_SENTENCE.search(bare) else "text"
            self.lines.append((kind, size, words, share, by))
            self.links += len(linked)
            self.prices += len(_PRICE.findall(bare)) if _MONEY.search(bare) else 0
            self.separators += len(_SEPARATOR.findall(bare))
        self.size = sum(x[1] for x in self.lines)

    def share(self, by: str) -> float | None:
        """Share of function words over the lines measured ``by`` these words; null if they have few words."""
        own = [x for x in self.lines if x[0] in ("text", "sentence") and x[4] == by]
        n = sum(len(x[2]) for x in own)
        return sum(len(x[2]) * x[3] for x in own) / n if n >= LEAST_WORDS else None

    def learnable(self) -> set[str]:
        """The words by which a language is learned from this page; none if there are few."""
        words = [w for x in self.lines if x[4] == "learned" and x[0] == "text" for w in x[2]]
        return set(words) if len(words) >= LEAST_WORDS else set()

    def figures(self) -> dict:
        """The page's figures. ``lines`` has each text line's share of function words, size and script,
        to be told apart as prose or bare words once the language's usual share is known."""
        words: list[str] = []
        size_of = {"link": 0, "record": 0, "sentence": 0}
        keys: Counter = Counter()
        texts: list[dict] = []
        for kind, size, own, share, by in self.lines:
            if kind == "text":
                texts.append({"share": share, "size": size, "by": by})
            else:
                size_of[kind] += size
            if kind != "record":
                stems = [s for w in own if (s := w if w[-1] > "9" else w.rstrip("0123456789"))]
                words += stems
                keys[" ".join(stems)] += 1
        n = len(words)
        counts = Counter(words)
        tops = [0.0]
        often = {w for w, c in counts.items() if c >= 4}  # a phrase cannot recur more than its words do
        if often:
            at = [i for i, w in enumerate(words) if w in often]
            pairs = [i for i, j in zip(at, at[1:], strict=False) if j == i + 1]
            triples = [i for i, j in zip(pairs, pairs[1:], strict=False) if j == i + 1]
            for k, starts in ((2, pairs), (3, triples)):
                grams = Counter(tuple(words[i : i + k]) for i in starts)
                tops += [k * c / n for g, c in grams.items() if c >= 4 and not all(w in _WORDS for w in g)]
        lines = sum(keys.values())
        return {
            **{f"usual_{by}": self.share(by) for by in MEASURES},
            "lines": texts,
            "size": float(self.size),
            "link": size_of["link"] / max(1, self.size),
            "record": size_of["record"] / max(1, self.size),
            "sentence": size_of["sentence"] / max(1, self.size),
            "words": float(n),
            "top_word": max((c for w, c in counts.items() if w not in _WORDS), default=0) / max(1, n),
            "top_ngram": max(tops),
            "distinct": len(counts) / max(1, n),
            "same_lines": 1 - len(keys) / lines if lines else 0.0,
            "separators": self.separators / max(1, n),
            "prices": float(self.prices),
            "links": float(self.links),
        }


_LINES = pa.list_(pa.struct([("share", pa.float64()), ("size", pa.int64()), ("by", pa.string())]))


def learned_table(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``language, word, pages``: the function words of each language without a list, which are those in
    ``LEARNED_SHARE`` of its pages.

    Document frequencies are counted over all documents of such languages, each partition combining its
    own before the shuffle. Any text may be claimed as a language, and all are learned, however rare.
    """
    claimed = _language(df, lang)
    rows = df.select(claimed.alias("claimed"), text)
    unlisted = ~F.col("claimed").isin(*sorted(LISTED))
    # Letters of other scripts take two bytes or more, so a text that is mostly of them is far longer in bytes.
    wide = F.octet_length(text) >= F.length(text) * 1.2
    some = rows.where(F.col(text).isNotNull() & (unlisted | (wide & F.col(text).rlike(_OTHER_IN_SQL))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            pairs = list(seen)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string()), pa.array([seen[p] for p in pairs], pa.int64())], names=["language", "word", "n"]
            )
            seen.clear()
            return batch

        for batch in batches:
            for language, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                known = language in LISTED
                words = Page(value, not known).learnable()
                if words:
                    name = OTHER_SCRIPT if known else language
                    seen.update((name, w) for w in words)
                    seen[name, ""] += 1
                if len(seen) > 500_000:
                    yield flush()
        yield flush()

    counts = some.mapInArrow(count, "language string, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    pages = counts.where("word = ''").select("language", F.col("n").alias("pages"))
    few = pages.count() <= BROADCAST_ROWS
    return counts.where("word <> ''").join(F.broadcast(pages) if few else pages, "language").where(F.col("n") >= F.col("pages") * LEARNED_SHARE).select("language", "word", "pages")


def _collected(table: DataFrame) -> dict[str, frozenset[str]]:
    out: dict[str, set[str]] = {}
    for r in table.select("language", "word").collect():
        out.setdefault(r["language"], set()).add(r["word"])
    return {k: frozenset(v) for k, v in out.items()}


def common_languages(table: DataFrame) -> tuple[list[str], bool]:
    """The languages of a ``learned_table`` whose words are broadcast, and whether these are all it has.

    Texts in scripts without a list come first, as they may be claimed as any listed language, then those
    with most pages.
    """
    sizes = table.groupBy("language").agg(F.max("pages").alias("pages"), F.count(F.lit(1)).alias("words"))
    best = sizes.orderBy(F.col("language") != OTHER_SCRIPT, F.col("pages").desc(), "language").limit(BROADCAST_LANGUAGES + 1).collect()
    out: list[str] = []
    words = 0
    for r in best[:BROADCAST_LANGUAGES]:
        words += r["words"]
        if words > BROADCAST_WORDS and r["language"] != OTHER_SCRIPT:
            break
        out.append(r["language"])
    return out, len(out) == len(best)


def learned_words(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, frozenset[str]]:
    """The ``learned_table`` of a table with few languages, as sets of words."""
    return _collected(learned_table(df, text, lang))


def page_figures(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", learned: DataFrame | None = None) -> DataFrame:
    """``key``, the claimed language and ``Page.figures`` of every document.

    ``learned`` is a ``learned_table``. If its words are too many to be broadcast, the documents of the
    languages with fewest pages, of which none has many, are joined with theirs by a shuffle.
    """
    names = list(Page("").figures())
    common, whole = common_languages(learned) if learned is not None else ([], True)
    shared = df.sparkSession.sparkContext.broadcast(_collected(learned.where(F.col("language").isin(common))) if common else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        none: frozenset[str] = frozenset()
        last: tuple[str | None, frozenset[str]] = (None, none)
        for batch in batches:
            rows = []
            own = batch.column(3) if batch.num_columns > 3 else None
            for i, (c, t) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                if own is not None and own[i].is_valid:
                    if last[0] != c:
                        last = (c, frozenset(own[i].as_py()))
                    known = last[1]
                else:
                    known = words.get(OTHER_SCRIPT if c in LISTED else c, none)
                rows.append(Page(t, c not in LISTED, known).figures())
            columns = [pa.array([r[n] for r in rows], _LINES if n == "lines" else pa.float64()) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[key, "claimed", *names])

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, claimed string, " + ", ".join(f"{n} " + ("array<struct<share: double, size: long, by: string>>" if n == "lines" else "double") for n in names)
    rows = df.select(key, _language(df, lang).alias("claimed"), text)
    if whole:
        return fan_out(rows).mapInArrow(run, schema)
    here = F.col("claimed").isin(*sorted(LISTED | set(common)))
    own_words = learned.where(~F.col("language").isin(common)).groupBy(F.col("language").alias("claimed")).agg(F.collect_list("word").alias("own"))
    rare = rows.where(~here).join(own_words, "claimed", "left").select(key, "claimed", text, "own")
    return fan_out(rows.where(here)).mapInArrow(run, schema).unionByName(rare.mapInArrow(run, schema))


def usual_figures(figures: DataFrame) -> DataFrame:
    """A row per claimed language: the least share of function words of prose, by which words they are
    measured, and the page's thresholds, calibrated over all its documents.

    The share is the median over the documents, drawn towards the usual one as if ``PRIOR_DOCUMENTS``
    more had it, so it moves smoothly with the number of documents. Learned words speak only as far as
    nearly all documents have them: there it is a low quantile, drawn towards none.
    """

    def blend(median: Column, n: Column, prior: float) -> Column:
        return (F.coalesce(median, F.lit(prior)) * n + prior * PRIOR_DOCUMENTS) / (n + PRIOR_DOCUMENTS)

    def drawn(c: str, quantile: float, prior: float) -> Column:
        return blend(F.percentile_approx(c, quantile), F.count(c), prior)

    def raised(c: str, base: float) -> Column:
        typical = F.percentile_approx(c, 0.5)
        return F.greatest(F.lit(base), ABOVE_USUAL * blend(typical, F.count(F.lit(1)), 0.0)).alias(f"least_{c}")

    return figures.groupBy("claimed").agg(
        (PROSE_SHARE * F.greatest(drawn("usual_latin", 0.5, USUAL_WORDS), F.lit(FLOOR * USUAL_WORDS))).alias("latin"),
        (PROSE_SHARE * F.greatest(drawn("usual_cjk", 0.5, USUAL_CHARACTERS), F.lit(FLOOR / 2 * USUAL_CHARACTERS))).alias("cjk"),
        (PROSE_SHARE * drawn("usual_learned", LEARNED_QUANTILE, 0.0)).alias("learned"),
        raised("top_ngram", TOP_NGRAM), raised("top_word", TOP_WORD), raised("same_lines", SAME_LINES), raised("separators", SEPARATORS),
    )


def _language(df: DataFrame, lang: str) -> Column:
    return F.coalesce(F.lower(F.trim(F.col(lang))), F.lit("und"))


def is_spam() -> Column:
    """The decision over a page's figures and its language's thresholds."""
    c = F.col
    over = lambda name: c(name) >= c(f"least_{name}")
    recurs = over("top_ngram") | over("top_word") | (c("distinct") < FEW_DISTINCT) | over("same_lines")
    listed = over("separators") | (c("prices") >= PRICES) | (c("links") >= LINKS)
    enough = (c("words") >= LEAST_WORDS) | (c("links") >= LINKS)
    listing = (c("link") + c("bare") >= SPAM_SHARE) & (recurs | listed)
    # Sentences that are made around one phrase.
    stuffed = (c("record") < SPAM_SHARE) & over("top_ngram") & (c("prose") + c("bare") >= SPAM_SHARE)
    return enough & (listing | stuffed)


def page_features(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Figures and decision of every document: ``key``, shares and counts, and ``spam``.

    Thresholds hold for the whole page: the share of its characters in lines that are links or lack
    their language's function words, and that words, phrases or lines recur, or that separators,
    prices or links abound. Lines of tables, logs, settings and checksums are records and never count.
    How many function words a line needs, and from where on words, phrases, lines and separators abound,
    is calibrated per claimed language on all documents. Languages without a list of function words,
    and scripts without one, have those that most of their documents share (``learned_table``).

    Texts are read once, those of languages without a list twice: the figures go to the checkpoint
    folder, from which the calibration and the decision are made without Python.

    Null, empty and very short texts are no spam. Whole texts count, however long. A null language is
    ``und``. Repeated rows each give a row; other columns are ignored.
    """
    figures = cut_lineage(page_figures(df, key, text, lang, cut_lineage(learned_table(df, text, lang))))
    usual = cut_lineage(usual_figures(figures))
    few = usual.count() <= BROADCAST_ROWS  # any text may be claimed as a language; else by a shuffle
    judged = figures.join(F.broadcast(usual) if few else usual, "claimed", "left")
    limit = lambda x: F.when(x["by"] == "cjk", F.col("cjk")).when(x["by"] == "latin", F.col("latin")).otherwise(F.col("learned"))
    bare = F.aggregate(F.filter("lines", lambda x: x["share"] < limit(x)), F.lit(0).cast("long"), lambda n, x: n + x["size"])
    judged = judged.withColumn("bare", bare / F.greatest(F.lit(1.0), F.col("size")))
    judged = judged.withColumn("prose", F.greatest(F.lit(0.0), 1.0 - F.col("link") - F.col("record") - F.col("bare")))
    names = ["size", "words", "link", "record", "bare", "prose", "top_word", "top_ngram", "distinct", "same_lines", "separators", "prices", "links"]
    return judged.select(key, *names, is_spam().alias("spam"))


def spam_pages(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The keys of the documents that are spam."""
    return page_features(df, key, text, lang).where("spam").select(key)
