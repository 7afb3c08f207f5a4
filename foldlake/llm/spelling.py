"""Spelling variants: near words by letter-parity bitmasks in three bands, and the frequent form that each word stands for.

The mask of a piece of a word has a bit for each letter, set if the letter occurs an odd number of times. Replacing one
letter flips two bits at most, inserting or deleting one flips one. The bits of a mask fall into three bands, so that of
the three bands of two near words one is equal at least, after an insertion two are.

Whole words would share bands with far too many others. So a word is cut into pieces, of which an edit touches one: the
masks of the other pieces are equal, and the bands are those of the piece that was edited. Words meet in an equi-join on
the length, the place and bands of the edited piece and the masks of the others; candidates whose masks differ in more
than two bits go at once, the rest is verified on the words. A pair is taken under the piece that holds the first letter
in which its words differ and the first band that is equal, and so comes once however many keys it shares.

A word has at most (2 * length + 1) * letters near words, so no group of links grows with the corpus; keys that many words
share are split by the join's skew handling. No near word is dropped, and there is no cap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlake.llm import common

#: A run of letters; the letters beyond ASCII are those of Latin-1.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BANDS, BAND_BITS = 3, 21
#: Into how many pieces a word is cut to find replaced letters, and inserted or deleted ones.
REPLACED_PIECES, INSERTED_PIECES = 3, 2

#: A run loses a letter if this divides its checksum; words have so many letters and occurrences at least; a form occurs
#: so many times as often as its word.
DELETES, LEAST_LETTERS, LEAST_COUNT, RATIO = 31, 7, 2, 10


def lower_ascii(run: Column) -> Column:
    """run with A-Z in lower case and all else as it is. lower() does that for runs without capitals beyond ASCII."""
    return F.when(run.rlike("[^\\x00-\\x7f]"), F.translate(run, UPPER, LOWER)).otherwise(F.lower(run))


def runs(docs: DataFrame, least: int = 1) -> DataFrame:
    """doc_id, run: the maximal runs of letters of each whole text that have so many letters at least, A-Z in lower case.

    Null texts have none. Only doc_id and text are read.
    """
    found = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select("doc_id", F.explode(found).alias("run")).select("doc_id", lower_ascii(F.col("run")).alias("run"))


def with_deletions(found: DataFrame, every: int = DELETES) -> DataFrame:
    """word: each run, without one of its letters where every divides the crc32 of `<doc_id>:<run>`; a null doc_id is
    written as nothing."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    rows = found.select("run", F.crc32(key.cast("binary")).alias("_h"))
    at = F.pmod("_h", F.length("run")).cast("int")
    without = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return rows.select(F.when(F.col("_h") % every == 0, without).otherwise(F.col("run")).alias("word"))


def count_words(words: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the distinct words with so many letters and occurrences at least."""
    return words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _bits() -> Column:
    """The bit of each letter of word."""

    def bit(letter: Column) -> Column:
        code = F.ascii(letter)
        place = (code % BANDS) * BAND_BITS + F.floor(code / BANDS).cast("int") % BAND_BITS
        return F.when(letter == "", F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), place))

    return F.transform(F.split("word", ""), bit)


def _mask(start: Column, end: Column) -> Column:
    """The parity mask of the letters start to end (from 0, end not included)."""
    return F.aggregate(F.slice("bits", start + 1, end - start), F.lit(0).cast("long"), lambda m, b: m.bitwiseXOR(b))


def _band(mask: Column, band: int) -> Column:
    return F.shiftrightunsigned(mask, band * BAND_BITS).bitwiseAND(F.lit((1 << BAND_BITS) - 1).cast("long"))


def keys(words: DataFrame, pieces: int, extra: int, both_bands: bool) -> DataFrame:
    """word, n, mask, at and key for each piece (and band) that an edit may have touched.

    Pieces are cut for the shorter word of a pair; extra is 1 if word is the longer one, by one letter, else 0. at tells
    piece and band; key is equal for near words with the edit in that piece that leaves that band as it is, or, with
    both_bands, all bands but that one. mask is the mask of the edited piece.
    """
    size = F.length("word") - extra
    cuts = [F.floor(size * k / pieces).cast("int") for k in range(pieces + 1)]
    cut = words.select("word", "n", size.alias("size"), _bits().alias("bits"), *[c.alias(f"cut{k}") for k, c in enumerate(cuts)])
    spans = [(F.col(f"cut{k}"), F.col(f"cut{k + 1}")) for k in range(pieces)]
    masks = {}
    for k, (a, b) in enumerate(spans):
        masks[f"before{k}"], masks[f"after{k}"], masks[f"edited{k}"] = _mask(a, b), _mask(a + extra, b + extra), _mask(a, b + extra)
    cut = cut.select("word", "n", "size", *[m.alias(name) for name, m in masks.items()])
    rows = []
    for k in range(pieces):
        rest = [F.col(f"before{j}" if j < k else f"after{j}") for j in range(pieces) if j != k]
        for band in range(BANDS):
            kept = [j for j in range(BANDS) if (j != band) == both_bands]
            at = F.lit(k * BANDS + band)
            key = F.xxhash64("size", at, *rest, *[_band(F.col(f"edited{k}"), j) for j in kept])
            rows.append(F.struct(at.alias("at"), key.alias("key"), F.col(f"edited{k}").alias("mask")))
    each = cut.select("word", "n", "size", F.explode(F.array(*rows)).alias("k"))
    return each.select("word", "n", "size", "k.at", "k.key", "k.mask")


def _first_equal_band(differ: Column) -> Column:
    return F.when(_band(differ, 0) == 0, 0).when(_band(differ, 1) == 0, 1).otherwise(2)


def _only_other_band(differ: Column) -> Column:
    """The band in which masks with one flipped bit differ; the last one if no bit is flipped."""
    return F.when(_band(differ, 0) != 0, 0).when(_band(differ, 1) != 0, 1).otherwise(2)


def _meet(left: DataFrame, right: DataFrame, pieces: int, inserted: bool) -> DataFrame:
    """a, a_n, b, b_n: the near words among rows of keys that are equal, each pair once."""
    a, b = left.alias("a"), right.alias("b")
    one, other, size = F.col("a.word"), F.col("b.word"), F.col("a.size")
    differ = F.col("a.mask").bitwiseXOR(F.col("b.mask"))
    piece, band = F.floor(F.col("a.at") / BANDS), F.col("a.at") % BANDS
    first = F.lit(0)
    for k in range(1, pieces):
        cut = F.floor(size * k / pieces).cast("int")
        first = F.when(F.substring(one, F.lit(1), cut) == F.substring(other, F.lit(1), cut), k).otherwise(first)
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.at") == F.col("b.at")) & (size == F.col("b.size"))
    near = near & (F.bit_count(differ) <= (1 if inserted else 2))
    near = near & (band == (_only_other_band(differ) if inserted else _first_equal_band(differ)))
    near = near & (F.levenshtein(one, other, 1) == 1) & (piece == first)
    near = near if inserted else near & (one < other)
    return a.join(b, near).select(one.alias("a"), F.col("a.n").alias("a_n"), other.alias("b"), F.col("b.n").alias("b_n"))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, a_n, b, b_n for each unordered pair of words (word, n; each once, not null) that one inserted, deleted or replaced letter parts."""
    same = keys(words, REPLACED_PIECES, 0, False)
    short, long = keys(words, INSERTED_PIECES, 0, True), keys(words, INSERTED_PIECES, 1, True)
    return _meet(same, same, REPLACED_PIECES, False).unionByName(_meet(short, long, INSERTED_PIECES, True))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of each word of forms (word, form): where its chain of forms ends. Chains double at each round, and as
    a form is more frequent by a factor than its word, rounds number about log log of the largest count."""
    now = common.materialize(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = common.materialize(now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-forms")
        common.drop(now)
        now = after
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of words (word, n), which have each word once.

    form is the near word of largest n, the smallest in code-point order among equals, if that n is ratio times the
    word's own at least, else null; root follows forms to the last one and is the word itself without any. An empty table
    gives an empty one.
    """
    pairs = near_pairs(words)
    sides = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("m")), F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("m"))))
    best = F.min(F.struct((-F.col("m")).alias("m"), "other"))
    near = pairs.select(sides.alias("s")).select("s.*").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    taken = -F.col("best.m") >= F.col("n") * ratio
    both = words.select("word", "n").join(near, "word", "left")
    out = common.materialize(
        both.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.m")).alias("form_n")),
        "spelling-near",
    )
    ends = roots(out.where("form IS NOT NULL"))
    return out.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of the words of all documents. Null texts have no words; a null doc_id counts as an
    empty text in the checksum; repeated rows count each; other columns are not read."""
    found = with_deletions(runs(common.table(spark, sf_dir, "documents"), LEAST_LETTERS))
    return variants(common.materialize(count_words(found), "spelling-words"))


#: The checksum's table and steps are spelled out, as DuckDB has no crc32; pairs come from words without one letter.
OP11_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{7,}}')), '{UPPER}', '{LOWER}') AS run FROM documents
), each AS (
  SELECT doc_id, run, count(*) AS n, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: CAST(unicode(x) AS BIGINT)) AS codes FROM runs GROUP BY doc_id, run
), sums AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(codes, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 | (c >> 6), 128 | (c & 63)] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM each, crc
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % {DELETES} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM sums)
  WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), less AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {RATIO} * n THEN other END AS form, CASE WHEN m >= {RATIO} * n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)
), hops(word, root, depth) AS (
  SELECT word, word, 0 FROM formed UNION ALL SELECT h.word, f.form, h.depth + 1 FROM hops h JOIN formed f ON f.word = h.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN (SELECT word, first(root ORDER BY depth DESC) AS root FROM hops GROUP BY word) r USING (word)
"""
