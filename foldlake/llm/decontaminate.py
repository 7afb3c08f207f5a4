"""Benchmark decontamination by template windows.

Words become tokens in which numbers, names, units and variables are typed placeholders, so that a question whose numbers
or names were changed has the template of the original. Number words are numbers; a unit is one of a list or made of a prefix
and a base; single letters are units after a number, else variables; and a capitalised word is a name inside a sentence, and
at its beginning unless the benchmark has it in lower case. Words that belong together are one slot: "New York", "twenty
five", "3 million", "square metres", "miles per hour"; a unit written to its number ("5km", "20%") is a slot of its own.
Windows of the documents are hash-joined to those of the benchmark items.
Windows have WINDOW tokens, in items of fewer than 20 tokens two fifths of the item, so that one changed word, wherever it
stands, leaves 60 percent of the item's tokens in windows; items of fewer than WINDOW tokens are one window. A window counts
where its slots agree: in an alignment, windows with a value of the item that stands at several values of the document are
dropped, and all windows if these are more than two fifths of them. Items are judged by the tokens that the others cover.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common
from foldlake.llm.sketch import Marks

WINDOW = 8
#: Tokens of a window that must be words of their own, or most of a shorter window's; windows of placeholders alone match
#: anything.
LITERALS = 4
#: Share of an item's tokens, of those in windows, that matching windows must cover in a document.
COVERAGE = 0.6

#: Most words of a name in one slot; the words after them begin another.
NAME_WORDS = 4

#: Code points of texts that are cut into tokens at once.
GROUP = 200_000

#: Units of measure; fixed values.
UNITS = frozenset(
    "mm cm dm m km inch inches foot feet ft yard yards yd mile miles mi acre acres hectare hectares ha mg g kg lb lbs oz"
    " ounce ounces pound pounds stone ton tons tonne tonnes ml cl dl l gallon gallons pint pints quart quarts cup cups"
    " s sec secs min mins minute minutes h hr hrs hour hours day days week weeks month months year years hz khz mhz ghz"
    " w kw mw j kj cal kcal v mv a ma k c f kb mb gb tb percent degree degrees dollar dollars cent cents euro euros usd"
    " eur mph kmh kph %".split()
)
#: Prefixes and bases of composed units; fixed values.
PREFIXES = " kilo centi milli deci hecto deca micro nano mega giga tera".split(" ")
BASES = "meter metre gram gramme liter litre second watt volt ampere hertz joule newton pascal calorie byte bit mole ohm".split()
COMPOSED = frozenset(f"{prefix}{base}{plural}" for prefix in PREFIXES for base in BASES for plural in ("", "s"))
#: Words before a unit that belong to it, and words that join two units; fixed values.
BEFORE_UNIT = frozenset("square cubic sq cu".split())
BETWEEN_UNITS = frozenset("per a an".split())
#: Number words that belong to the number before them; fixed values.
MULTIPLES = frozenset("hundred thousand million billion dozen".split())
#: Words after a letter that tell a variable from an article; fixed values.
AFTER_VARIABLE = frozenset("and or is are = + - / < > ≤ ≥ ≠".split())
#: Number words; fixed values.
NUMBERS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half"
    " twice thrice double triple first second third fourth fifth sixth seventh eighth ninth tenth".split()
)
_LISTED = UNITS | COMPOSED | BEFORE_UNIT | BETWEEN_UNITS | NUMBERS | AFTER_VARIABLE
NUMBER, NAME, UNIT, VARIABLE = 1, 2, 3, 4
_NUMBER = re.compile(r"[+-]?[$€£]?\d+(?:[.,:/]\d+)*(st|nd|rd|th|%|[a-z]{1,3})?")
_EDGES = ".,;:!?\"'()[]{}«»“”‘’…*_"
#: Bits by which hashes are shifted for the second of two bitmaps.
_SHIFT = 24
_M = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))


#: What a word may be, one bit each.
ENDS, CLOSED, EMPTY, CAPITAL, LETTER, LETTER_UNIT, ARTICLE, AFTER, BEFORE, BETWEEN, GLUED, SPELLED, MULTIPLE = (1 << i for i in range(13))


class Canonical(dict):
    """The numbers of words as they stand. By them codes has token hashes (or placeholders), marks what the words may be,
    bare the words without the marks around them, units the units written to numbers. Remembers a bounded number of words."""

    MOST = 150_000

    def __init__(self):
        super().__init__()
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.codes, self.marks, self.bare, self.units = array("Q"), array("H"), [], {}

    def __missing__(self, word: str) -> int:
        bare = word.strip(_EDGES)
        low, at = bare.lower(), len(self.bare)
        code, marks = 0, CAPITAL if bare is not low and bare[:1].isupper() and not bare.isupper() else 0
        plain = len(low) > 1 and low.isalpha()
        if len(bare) < len(word) or not plain:
            marks |= ENDS * (word[-1:] in ".!?:…" or word[-2:-1] in (".", "!", "?"))
            marks |= CLOSED * (word[-1:] in _EDGES and word[-1:] not in "*_")
        if not plain or low in _LISTED:
            code, more, unit = _placeholder(bare, low)
            marks |= more
            if unit:
                bare, self.units[at] = bare[: -len(unit)], unit
        self.codes.append(code or xxhash.xxh64_intdigest(low))
        self.marks.append(marks)
        self.bare.append(bare)
        self[word] = at
        return at


def _placeholder(bare: str, low: str) -> tuple[int, int, str]:
    """Placeholder (0: none), marks, and the unit written to a number, of a word that is listed or not of letters."""
    letter = len(low) == 1 and low.isascii() and low.isalpha()
    marks = EMPTY * (not bare) | LETTER * (letter and bare != "I") | LETTER_UNIT * (letter and low in UNITS)
    marks |= ARTICLE * (bare in ("a", "A")) | AFTER * (low in AFTER_VARIABLE)
    marks |= BEFORE * (low in BEFORE_UNIT) | BETWEEN * (low in BETWEEN_UNITS)
    number = _NUMBER.fullmatch(low)
    if number:
        unit = number[1] if number[1] in UNITS else ""
        return NUMBER, marks | GLUED * bool(unit), unit
    if all(x in NUMBERS for x in low.split("-")):
        return NUMBER, marks | SPELLED | MULTIPLE * (low in MULTIPLES), ""
    return UNIT if not letter and (low in UNITS or low in COMPOSED) else 0, marks, ""


@common.remembered
def canonical() -> Canonical:
    return Canonical()


class Spelling(Sequence):
    """The words of each token of a text, made when asked for. Token i begins at word starts[i]; units marks the tokens
    that are a unit written to the number before them."""

    def __init__(self, known: Canonical, at: np.ndarray, starts: np.ndarray, units: np.ndarray):
        self.bare, self.glued, self.at, self.starts, self.units = known.bare, known.units, at, starts, units

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, i: int) -> str:
        if i >= len(self.starts):
            raise IndexError(i)
        start = self.starts[i]
        stop = self.starts[i + 1] if i + 1 < len(self.starts) else len(self.at)
        words = [self.bare[w] for w in self.at[start : max(stop, start + 1)].tolist()]
        return " ".join([self.glued[self.at[start]], *words[1:]] if self.units[i] else words)


def plain(text: str) -> list[str]:
    """The bare words of a text, each of its own."""
    return [bare for word in text.split() for bare in (word.strip(_EDGES),) if bare]


def tokens(text: str, known: Canonical, lower: Marks | None = None) -> tuple[np.ndarray, Spelling]:
    """Token codes (placeholders up to VARIABLE) and the words of each. lower marks the words that the benchmark has in
    lower case; a capitalised word that begins a sentence is a name if it is none of them."""
    return tokens_of([text], known, lower)[:2]


def groups(texts: list[str]) -> Iterator[slice]:
    """Texts in groups of about GROUP code points, or one longer text."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > GROUP:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if texts:
        yield slice(begin, len(texts))


def tokens_of(texts: list[str], known: Canonical, lower: Marks | None = None) -> tuple[np.ndarray, Spelling, np.ndarray]:
    """tokens() of several texts, one after the other, and where the tokens of each end."""
    if len(known) > known.MOST:
        known.reset()
    parts = [text.split("\n") for text in texts]
    lines = [line.split() for part in parts for line in part]
    counts = np.array([len(line) for line in lines])
    ends = np.cumsum(counts)[np.cumsum([len(part) for part in parts]) - 1]
    at = np.fromiter(map(known.__getitem__, chain.from_iterable(lines)), np.int64, counts.sum())
    begins = np.zeros(len(at) + 1, bool)
    begins[np.cumsum(counts) - counts] = True
    marks, begins = _without_empty(np.frombuffer(known.marks, np.uint16)[at] if len(at) else np.zeros(0, np.uint16), begins[:-1])
    full = (marks & EMPTY) == 0
    at, marks, begins = at[full], marks[full], begins[full]
    ends = np.concatenate([[0], np.cumsum(full)])[ends]
    if not len(at):
        return np.zeros(0, np.uint64), Spelling(known, at, at, full[:0]), ends
    codes = np.frombuffer(known.codes, np.uint64)[at]
    first, free = begins.copy(), ~begins  # free: the word may belong to the one before it
    first[1:] |= (marks[:-1] & ENDS) > 0
    free[1:] &= (marks[:-1] & CLOSED) == 0

    own = codes > VARIABLE
    name = own & ((marks & (CAPITAL | LETTER)) == CAPITAL)
    asked = np.flatnonzero(name & first)
    name[asked] = ~lower.of(codes[asked].view(np.int64)) if lower is not None else False
    letter = own & ((marks & LETTER) > 0) & (((marks & ARTICLE) == 0) | ((marks & CLOSED) > 0))
    codes[name], codes[letter] = NAME, VARIABLE
    told = np.flatnonzero(free & ((marks & AFTER) > 0)) - 1
    codes[told[(marks[told] & ARTICLE) > 0]] = VARIABLE
    measured = np.flatnonzero(free & ((marks & LETTER_UNIT) > 0))
    counted = (codes[measured - 1] == NUMBER) & ((marks[measured - 1] & GLUED) == 0)
    codes[measured[counted | ((marks[measured - 1] & BEFORE) > 0)]] = UNIT

    follows = free & (codes == NAME)
    follows[1:] &= codes[:-1] == NAME
    place = np.arange(len(codes))
    joined = follows & ((place - np.maximum.accumulate(np.where(follows, 0, place))) % NAME_WORDS > 0)
    for i in np.flatnonzero(free & ((codes == UNIT) | ((marks & SPELLED) > 0))).tolist():
        _join(i, codes, marks, free, joined)

    starts = np.flatnonzero(~joined)
    glued = (marks[starts] & GLUED) > 0
    units = np.zeros(len(starts) + int(glued.sum()), bool)
    units[np.flatnonzero(glued) + np.arange(1, glued.sum() + 1)] = True
    starts = np.repeat(starts, glued + 1)
    return np.where(units, np.uint64(UNIT), codes[starts]), Spelling(known, at, starts, units), np.searchsorted(starts, ends)


def _without_empty(marks: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks and line beginnings, where what words of marks alone end or close is told of the words before them."""
    empty = np.flatnonzero(marks & EMPTY).tolist()
    for i in reversed(empty):
        if not begins[i]:
            marks[i - 1] |= marks[i] & (ENDS | CLOSED)
    for i in empty:
        if begins[i] and i + 1 < len(begins):
            begins[i + 1] = True
    return marks, begins


def _join(i: int, codes: np.ndarray, marks: np.ndarray, free: np.ndarray, joined: np.ndarray) -> None:
    """Joins a unit, or a number word, to the words before it that belong to it."""
    if codes[i] == NUMBER:
        number = codes[i - 1] == NUMBER and not marks[i - 1] & GLUED
        joined[i] = number and bool(marks[i] & MULTIPLE or marks[i - 1] & SPELLED)
    elif codes[i - 1] > VARIABLE and marks[i - 1] & BEFORE:
        codes[i - 1], joined[i] = UNIT, True
    elif i > 1 and free[i - 1] and codes[i - 1] > VARIABLE and marks[i - 1] & BETWEEN:
        if codes[i - 2] == UNIT or marks[i - 2] & GLUED:
            codes[i - 1], joined[i - 1], joined[i] = UNIT, True, True


def lower_words(items: DataFrame) -> Marks:
    """Marks of the hashes of the words that the items (id, text) have in lower case."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = canonical()
        for batch in batches:
            numbers = {known[w] for text in batch["text"].to_pylist() for w in text.split()}
            codes = {known.codes[i] for i in numbers if known.bare[i][:1].islower()}
            yield pa.RecordBatch.from_pydict({"h": pa.array(np.array(list(codes), np.uint64).view(np.int64), pa.int64())})

    return Marks(items.mapInArrow(found, "h long").distinct(), "h")


def window_size(n: int, size: int) -> int:
    """Tokens in a window of an item of n tokens."""
    return n if n < size else min(size, max(3, 2 * n // 5))


def window_hashes(codes: np.ndarray, sizes: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the sizes that codes are enough for, from the smallest, the hash of each window."""
    value = codes * _M[0]
    for size in range(1, min(max(sizes, default=0), len(codes)) + 1):
        if size > 1:
            value = value[:-1] ^ (value[:-1] >> np.uint64(29))
            value = (value + codes[size - 1 :]) * _M[1]
        if size in sizes:
            whole = (value ^ np.uint64(size)) * _M[0]
            yield size, (whole ^ (whole >> np.uint64(32))).view(np.int64)


def _usable(codes: np.ndarray, size: int) -> np.ndarray:
    """Which windows have enough words of their own."""
    own = np.concatenate([[0], np.cumsum(codes > VARIABLE)])
    return own[size:] - own[: len(own) - size] >= min(LITERALS, size // 2 + 1)


def _exact(words: list[str]) -> np.ndarray:
    """Token codes without placeholders."""
    return np.array([xxhash.xxh64_intdigest(w.lower()) for w in words], np.uint64) ^ _M[1]


def slots(codes: np.ndarray, words: Spelling, at: int, size: int) -> list[str]:
    """Values of a window's placeholders, in their order; of a name its last word, as a capitalised word may stand before it."""
    places = at + np.flatnonzero(codes[at : at + size] <= VARIABLE)
    return [(words[i].rpartition(" ")[2] if codes[i] == NAME else words[i]).lower() for i in places.tolist()]


_ITEMS = "id long, at int, size int, exact boolean, h long, slots array<string>, tokens int"
_WINDOWS = "id long, at int, h long, slots array<string>"


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}
    fields = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields, strict=True)], names=[name for name, _ in fields])


def _item_windows(items: DataFrame, lower: Marks, size: int) -> DataFrame:
    """id, at, size, exact, h, slots, tokens of the windows of items (id, text): the usable ones, and how many tokens are in
    those. Items of fewer than size tokens, and those without usable windows, have windows of the words as they stand."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = canonical()
        for batch in batches:
            out = []
            for key, text in zip(batch["id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                codes, words = tokens(text, known, lower)
                if not len(codes):
                    continue
                own = window_size(len(codes), size)
                places = np.flatnonzero(_usable(codes, own)).tolist()
                covered = len({i for at in places for i in range(at, at + own)})
                for _, hashes in window_hashes(codes, {own}):
                    out += [(key, at, own, False, int(hashes[at]), slots(codes, words, at, own), covered) for at in places]
                if len(codes) < size or not places:
                    bare = plain(text)
                    own = window_size(len(bare), size)
                    for _, hashes in window_hashes(_exact(bare), {own}):
                        out += [(key, at, own, True, h, [], len(bare)) for at, h in enumerate(hashes.tolist())]
            if out:
                yield _table(out, _ITEMS)

    return items.mapInArrow(cut, _ITEMS)


def _doc_windows(texts: DataFrame, lower: Marks, marks: tuple[Marks, Marks], sizes: set[int], exact: set[int]) -> DataFrame:
    """id, at, h, slots of the windows of texts (id, text), of the sizes, that marks name; exact: sizes of windows of the
    words as they stand."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = canonical()
        for batch in batches:
            out = []
            keys, texts = batch["id"].to_pylist(), batch["text"].to_pylist()
            for some in groups(texts):
                codes, words, ends = tokens_of(texts[some], known, lower)
                sides = [(sizes, codes, ends, False)]
                if exact:
                    bare = [plain(text) for text in texts[some]]
                    sides.append((exact, _exact([w for own in bare for w in own]), np.cumsum([len(own) for own in bare]), True))
                for wanted, own, stops, as_is in sides:
                    for size, hashes in window_hashes(own, wanted):
                        found = np.flatnonzero(marks[0].of(hashes))
                        found = found[marks[1].of(hashes[found] >> _SHIFT)]
                        text = np.searchsorted(stops, found, "right")
                        inside = found + size <= stops[text]
                        for at, i in zip(found[inside].tolist(), text[inside].tolist(), strict=True):
                            place = at - (int(stops[i - 1]) if i else 0)
                            out.append((keys[some][i], place, int(hashes[at]), [] if as_is else slots(codes, words, at, size)))
            if out:
                yield _table(out, _WINDOWS)

    return texts.mapInArrow(cut, _WINDOWS)


def matches(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, matched, tokens, coverage, reworded for each item that a document holds.

    matched is the number of the item's tokens that windows with consistent slots cover, of the tokens that are in
    windows; reworded tells whether any slot has another value than in the item. Null texts, texts
    without words and rows without id match nothing; rows that share a doc_id count as one document; repeated items match
    alike. Other columns are ignored. Items of fewer than size tokens match anywhere in a document, so an item of one
    common word matches every document that holds it. Empty tables give an empty result.
    """
    common.small_batches(docs.sparkSession)
    items = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("id"), common.text_or_empty().alias("text"))
    lower = lower_words(items)
    items = common.materialize(_item_windows(items, lower, size), "benchmark-windows")
    kinds = items.select("size", "exact").distinct().collect()
    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"), common.text_or_empty().alias("text"))
    hashes = items.select("h", F.shiftright("h", _SHIFT).alias("high")).distinct()
    marks = Marks(hashes, "h"), Marks(hashes, "high")
    found = _doc_windows(texts, lower, marks, {k["size"] for k in kinds if not k["exact"]}, {k["size"] for k in kinds if k["exact"]})
    found = found.select(F.col("id").alias("doc_id"), F.col("at").alias("doc_at"), "h", F.col("slots").alias("doc_slots"))
    sides = items.select(F.col("id").alias("item_id"), "at", "size", "h", "slots", "tokens")
    pairs = found.join(sides, "h").where(F.size("slots") == F.size("doc_slots"))
    pairs = pairs.withColumn("shift", F.col("doc_at") - F.col("at")).withColumn("slot", F.arrays_zip("slots", "doc_slots"))

    def covered(windows: Column) -> Column:
        return F.flatten(F.transform(windows, lambda w: F.sequence(w["at"], w["at"] + w["size"] - 1)))

    same = F.transform("slot", lambda s: F.struct(s["slots"].alias("i"), s["doc_slots"].alias("d")))
    lined = pairs.groupBy("doc_id", "item_id", "shift").agg(F.collect_set(F.struct("at", "size", same.alias("slots"))).alias("w"), F.max("tokens").alias("tokens"))
    values = lined.withColumn("v", F.array_sort(F.array_distinct(F.flatten("w.slots"))))
    again = F.filter("v", lambda s, at: (at > 0) & (F.get("v", at - 1)["i"] == s["i"]))
    torn = values.withColumn("torn", F.transform(again, lambda s: s["i"]))

    def bad(w: Column) -> Column:
        return F.exists(w["slots"], lambda s: F.array_contains("torn", s["i"]))

    kept = torn.withColumn("good", F.filter("w", lambda w: ~bad(w))).where(F.size("good") >= F.size("w") * coverage)
    whole = kept.groupBy("doc_id", "item_id").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(covered(F.col("good")))))).alias("matched"),
        F.max("tokens").alias("tokens"),
        F.max(F.exists(F.flatten("good.slots"), lambda s: s["i"] != s["d"])).alias("reworded"),
    )
    share = F.col("matched") / F.col("tokens")
    return whole.withColumn("coverage", share).where(F.col("coverage") >= coverage)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_items, item_id (the item with most coverage, the smallest of equals), coverage, reworded: a row for each
    document that holds an item."""
    found = matches(docs, benchmark)
    best = F.struct(F.col("coverage"), -F.col("item_id"), F.col("item_id"), F.col("reworded"))
    out = found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.max(best).alias("best"))
    return out.select("doc_id", "n_items", F.col("best.item_id").alias("item_id"), F.col("best.coverage").alias("coverage"), F.col("best.reworded").alias("reworded"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item, with their columns unchanged. Rows without doc_id stay."""
    leak = common.free_name(docs, "_leak")
    found = contaminated(docs, benchmark).select(F.col("doc_id").alias(leak))
    out = docs.join(found, F.col("doc_id").cast("long") == F.col(leak), "left_anti")
    return out.select(*docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_items, item_id, coverage, reworded of each document that holds an item of benchmark, over whole tables.
    Null and empty texts hold nothing; rows that share a doc_id are one document."""
    return contaminated(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
