"""Line dedup by a log-template tree, in DataFrame functions only.

A line's words lead it to a leaf of a tree of fixed depth: first their number, then the
``DEPTH`` leading words, with ``<*>`` for every run of digits. Inside a leaf, a word is
fixed if it has no digit and ``LEAST_DOCS`` lines of documents have it at its place; any
other is a variable field. A line of whose words at least ``LEAST_FIXED`` are fixed has
the leaf's general template: its fixed words, words with digits if ``LEAST_DOCS`` lines
agree in the rest of them, and ``<*>`` elsewhere. Any line has itself, word for word, as a
template without variable fields.

A template recurs if several documents show it: two if it has no variable fields,
``LEAST_DOCS`` if it is general. A line of a recurring template is dropped, but for the
first line of the first document that shows it. So of lines that are alike one always
stays, and lines that share little, like two rows of numbers, are never one template.

Counts are aggregates per line, leaf, place and word, so a leaf, line or document may hold
any share of the rows. Lines are compared by two independent 64-bit hashes, documents by
their id and a hash.

Defined results: a null text stays null; lines without words stay; rows of one id and text
are one document, whose lines count as often as its rows for fixed words; a null id is
the smallest; a document may lose all its lines and
stays with an empty text; long texts and lines are treated whole; an empty table gives
no rows; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parityscope.llm.arrow_columns import aside
from parityscope.llm.shared import written

DEPTH = 3
#: Documents that a general template needs; lines that a fixed word needs.
LEAST_DOCS = 3
LEAST_FIXED = 0.7
#: Bits of a filter, for each key and at most: it spares most rows without a match a
#: shuffle, and the join behind it decides.
_BITS_PER_KEY, _LEAST_BITS, _MOST_BITS = 16, 1 << 16, 1 << 24

_ODD_SPACE = r"[\x09\x0B-\x0D]|\x20\x20"
_SPACES = r"[\x20\x09-\x0D]+"
_LINE = ["line", "line_2"]


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def _masked(text: Column) -> Column:
    """Runs of digits are ``<*>``; the regular expression runs only on lines of documents
    that have one."""
    return F.when(F.col("digits"), F.regexp_replace(text, "[0-9]+", "<*>")).otherwise(text)


def _lines(docs: DataFrame) -> DataFrame:
    """Every line with words, one space between words: its document, place and leaf."""
    facts = [_key().alias("key"), F.col("text").rlike("[0-9]").alias("digits"), F.col("text").rlike(_ODD_SPACE).alias("odd")]
    lines = docs.select("doc_id", "text", *facts).select(
        "doc_id", "key", "digits", "odd", F.posexplode(F.split("text", "\n")).alias("place", "raw")
    )
    spaced = F.when(F.col("odd"), F.regexp_replace("raw", _SPACES, " ")).otherwise(F.col("raw"))
    lines = lines.withColumn("text", F.trim(spaced)).drop("raw", "odd").filter("text != ''")
    words = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    leaf = F.xxhash64(words, _masked(F.substring_index("text", " ", DEPTH)))
    return lines.withColumns({"leaf": leaf, "line": F.xxhash64("text"), "line_2": F.xxhash64(F.lit(1), "text")})


def _filter_of(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test that holds for all keys of the table and for few others, so rows are tested
    where they are read. Its bits, of bounded size, are a scalar subquery: as a literal they
    would be written out in each description of a plan that the driver keeps. They are
    written once: a plan holds the subquery at every use, and the driver keeps each of its nodes."""
    size = _LEAST_BITS
    wanted = _BITS_PER_KEY * keys.count()
    while size < min(wanted, _MOST_BITS):
        size *= 2

    def word_and_bit(value: Column) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(value), F.lit(size))
        return F.floor(at / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))

    word, bit = word_and_bit(F.col(key))
    found = keys.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    every = keys.sparkSession.range(size // 64).select(F.col("id").cast("int").alias("word"))
    words = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    bits = written(every.join(found, "word", "left").agg(words.alias("words")).select("words.bits"), "filter").scalar()

    def test(value: Column) -> Column:
        word, bit = word_and_bit(value)
        return F.get(bits, word).bitwiseAND(bit) != 0

    return test


def _general(docs: DataFrame, different: DataFrame) -> DataFrame:
    """The general template (two hashes) of each different line that has one."""
    # A fixed word needs LEAST_DOCS lines in its leaf, and a general template two different ones.
    leaves = different.groupBy("leaf").agg(F.count(F.lit(1)).alias("lines"), F.sum("n").alias("n"))
    leaves = written(leaves.filter(f"lines > 1 and n >= {LEAST_DOCS}").select("leaf"), "leaves")
    lines = _lines(docs).filter(_filter_of(leaves, "leaf")(F.col("leaf")))
    texts = lines.groupBy("leaf", *_LINE).agg(F.first("text").alias("text"), F.first("digits").alias("digits"), F.count(F.lit(1)).alias("n"))
    texts = texts.join(leaves, "leaf")
    pairs = F.arrays_zip(F.split("text", " ").alias("own"), F.split(_masked(F.col("text")), " ").alias("word"))
    words = texts.select("leaf", *_LINE, "n", F.posexplode(pairs).alias("at", "w"))
    words = words.select("leaf", *_LINE, "n", "at", F.col("w.word").alias("word"), (F.col("w.own") == F.col("w.word")).alias("plain"))
    words = written(words, "line-words")
    shared = words.groupBy("leaf", "at", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_DOCS)
    marked = words.join(shared.select("leaf", "at", "word", F.lit(True).alias("shared")), ["leaf", "at", "word"], "left").select(
        "leaf", *_LINE, F.struct("at", F.when(F.col("shared"), F.col("word")).otherwise("<*>").alias("word")).alias("w"),
        (F.coalesce("shared", F.lit(False)) & F.col("plain")).alias("fixed"),
    )
    whole = F.sort_array(F.collect_list("w"))
    general = marked.groupBy("leaf", *_LINE).agg(whole.alias("words"), (F.count_if("fixed") / F.count(F.lit(1))).alias("share"))
    return general.filter(F.col("share") >= LEAST_FIXED).select(
        "leaf", *_LINE, F.xxhash64("words").alias("template"), F.xxhash64(F.lit(1), "words").alias("template_2")
    )


def dropped_lines(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``key`` of each document that loses lines, and their places in ascending order."""
    lines = written(_lines(docs).drop("text", "digits"), "lines")
    # A line that many documents share is one row, combined before the shuffle.
    different = lines.groupBy("leaf", *_LINE).agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    different = written(different, "different-lines")
    exact = written(different.filter("low != high").select(*_LINE), "recurring-lines")
    at = F.struct("doc_id", "key", "place")

    def lost(found: DataFrame, template: list[str], least: int) -> DataFrame:
        """Lines of templates that at least so many documents show, but for each first one."""
        firsts = found.groupBy(*template).agg(F.min(at).alias("first"), *([F.count_distinct("key").alias("docs")] if least > 2 else []))
        if least > 2:  # two are known already
            firsts = firsts.filter(F.col("docs") >= least)
        return found.join(firsts.select(*template, "first"), template).filter(~at.eqNullSafe(F.col("first"))).select("doc_id", "key", "place")

    own = lines.filter(_filter_of(exact, "line")(F.col("line"))).join(exact, _LINE)
    general = written(_general(docs, different), "templates")
    alike = lines.filter(_filter_of(general, "line")(F.col("line"))).join(general, ["leaf", *_LINE])
    both = lost(own, _LINE, 2).unionAll(lost(alike, ["leaf", "template", "template_2"], LEAST_DOCS))
    return both.groupBy("doc_id", "key").agg(F.array_sort(F.collect_set("place")).alias("places"))


def drop_recurring_lines(docs: DataFrame) -> DataFrame:
    """The documents without their recurring lines, with ``n_dropped_lines`` added unless
    they have such a column."""
    docs, restore = aside(docs, ("doc_id", "text"))
    lost = written(dropped_lines(docs).toDF("lost_id", "lost_key", "places"), "lost-lines")
    same = (F.col("own_key") == F.col("lost_key")) & F.col("doc_id").eqNullSafe(F.col("lost_id"))
    found = docs.withColumn("own_key", _key()).join(lost, same, "left")
    found = found.withColumn("own_lines", F.split("text", "\n"))

    def between(i: Column) -> Column:
        """The lines after one dropped line and before the next."""
        start = F.when(i == 0, 0).otherwise(F.get("places", i - 1) + 1)
        end = F.coalesce(F.get("places", i), F.size("own_lines"))
        return F.slice("own_lines", start + 1, end - start)

    left = F.flatten(F.transform(F.sequence(F.lit(0), F.size("places")), between))
    text = F.when(F.col("places").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    dropped = F.when(F.col("places").isNull(), 0).otherwise(F.size("places")).cast("long")
    return restore(found.withColumns({"text": text, "n_dropped_lines": dropped}), "n_dropped_lines")


ORACLE = r"""
WITH docs AS (SELECT doc_id, text, count(*) AS copies FROM documents GROUP BY doc_id, text),
lines AS (
    SELECT doc_id, text AS whole, copies, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS place
    FROM docs
), worded AS (
    SELECT doc_id, whole, copies, place, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS own,
        list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda w: regexp_replace(w, '[0-9]+', '<*>', 'g')) AS words
    FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), leaves AS (SELECT *, (len(words), words[1:3]) AS leaf FROM worded),
words_at AS (
    SELECT doc_id, whole, copies, place, leaf, unnest(words) AS word, unnest(own) AS own_word, generate_subscripts(words, 1) AS spot FROM leaves
), shared AS (
    SELECT leaf, spot, word FROM words_at GROUP BY leaf, spot, word HAVING sum(copies) >= 3
), marked AS (
    SELECT w.*, s.word IS NOT NULL AS shared FROM words_at w LEFT JOIN shared s ON w.leaf = s.leaf AND w.spot = s.spot AND w.word = s.word
), general AS (
    SELECT doc_id, whole, place, leaf, list(CASE WHEN shared THEN word ELSE '<*>' END ORDER BY spot) AS template
    FROM marked GROUP BY doc_id, whole, place, leaf
    HAVING count(*) FILTER (shared AND own_word = word) / count(*)::DOUBLE >= 0.7
), own_ranks AS (
    SELECT doc_id, whole, place, own, row_number() OVER (PARTITION BY own ORDER BY doc_id NULLS FIRST, place) AS nth FROM leaves
), own_lost AS (
    SELECT doc_id, whole, place FROM own_ranks WHERE nth > 1 AND own IN (SELECT own FROM leaves GROUP BY own HAVING count(DISTINCT (doc_id, whole)) >= 2)
), general_ranks AS (
    SELECT *, row_number() OVER (PARTITION BY leaf, template ORDER BY doc_id NULLS FIRST, place) AS nth FROM general
), general_lost AS (
    SELECT doc_id, whole, place FROM general_ranks JOIN (
        SELECT leaf, template FROM general GROUP BY ALL HAVING count(DISTINCT (doc_id, whole)) >= 3
    ) USING (leaf, template) WHERE nth > 1
), lost AS (
    SELECT * FROM own_lost UNION SELECT * FROM general_lost
), kept AS (
    SELECT l.doc_id, l.whole, coalesce(string_agg(l.line, chr(10) ORDER BY l.place) FILTER (x.place IS NULL), '') AS text,
        count(x.place) AS n_dropped_lines
    FROM lines l LEFT JOIN lost x ON l.doc_id = x.doc_id AND l.whole = x.whole AND l.place = x.place GROUP BY l.doc_id, l.whole
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text, d.lang, d.source, d.n_chars,
    coalesce(k.n_dropped_lines, 0) AS n_dropped_lines
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.whole
"""
