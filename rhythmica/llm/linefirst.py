"""Line-first cleaning: rules judge every line, lines that fail are removed, and a document that loses too much goes.

Words are runs of characters other than space, tab, LF, VT, FF and CR; lines are cut at LF. A line without a word is
neither judged nor kept. A line is removed when

* punctuation: none of its words ends like a sentence (closing quotes and brackets aside), or more than SYMBOL_SHARE
  percent of its words carry one of ``#*$%&|<>``, or more than SHOUT_SHARE percent of its words end in ``!``;
* navigation: it is a row of short items with separators between them (two separators or more, and fewer than
  ITEM_WORDS words for each);
* boilerplate: it holds a phrase of the fixed list, or it equals an earlier line of the document.

``kept`` is false where the base rules of the document fail (fewer than MIN_WORDS words, or more than REPEAT_SHARE
percent of them in repeated three-word windows) or where more than LOST_SHARE percent of its words are lost.

DataFrame operations only, each row by itself: nothing is shuffled, so copies, hot sources and repeated ids cost
nothing. A row needs some 250 bytes for each of its words while it is worked on. Repeated windows are found by sorting
64-bit hashes of three words with their places, in n log n steps.

Defined results: a null or empty text has no words and is not kept; every row gives one row, whatever its id; an empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS, REPEAT_SHARE = 50, 50
SYMBOL_SHARE, SHOUT_SHARE, ITEM_WORDS, LOST_SHARE = 30, 50, 4, 30

SPACE = "\\x20\\x09-\\x0D"
SYMBOL = "[#*$%&|<>]"
#: A word at the end of a sentence: its mark, then closing marks.
TERMINAL = """[.!?:;…。！？]["')\\]}»”’]*\\z"""
SEPARATOR = "^[|»›>•·/]+\\z"
#: Whatever the case of the letters A-Z.
BOILERPLATE = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie|javascript|lorem ipsum|click here|"
    "sign up|subscribe to|copyright|licensed under|powered by|skip to content"
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def line_fails(line: Column, words: Column) -> Column:
    """Whether one of the rules removes a line, given its words."""
    n = F.size(words)
    # words are looked at one by one only where the line has such a mark at all
    count = lambda marks, pattern: F.when(line.rlike(marks), F.size(F.filter(words, lambda w: w.rlike(pattern)))).otherwise(0)
    punctuation = ~F.exists(words, lambda w: w.rlike(TERMINAL)) | (100 * count(SYMBOL, SYMBOL) > SYMBOL_SHARE * n) | (100 * count("!", "!\\z") > SHOUT_SHARE * n)
    separators = count(SEPARATOR.strip("^+\\z"), SEPARATOR)
    navigation = (separators >= 2) & (n - separators < ITEM_WORDS * separators)
    return punctuation | navigation | line.rlike(f"(?i){BOILERPLATE}")


def sorted_windows(words: Column) -> Column:
    """The three-word windows of ``words`` as (hash, place), equal ones side by side; null for fewer than three words."""
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    return F.when(F.size(words) > 2, F.sort_array(windows))


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_kept_lines,
    kept_words, base_failed, kept, clean_text (the lines that passed, first occurrences only)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    count = lambda c: c.cast("bigint")
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        words_of(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"),
        count(F.when(F.col("text").rlike(SYMBOL), F.char_length("text") - F.char_length(F.regexp_replace("text", f"{SYMBOL}+", ""))).otherwise(0)).alias("n_symbols"),
    )
    judged = lambda line: (lambda words: F.struct(line.alias("line"), F.size(words).alias("n"), line_fails(line, words).alias("fails")))
    first = F.transform(F.array_distinct("lines"), lambda x: F.element_at(F.transform(F.array(words_of(x)), judged(x)), 1))
    rows = rows.select(
        "doc_id", count(F.char_length(F.array_join("words", ""))).alias("word_chars"), "n_symbols", count(F.size("words")).alias("n_words"), count(F.size("lines")).alias("n_lines"), first.alias("first"), sorted_windows(F.col("words")).alias("w")
    )
    hash_at = lambda k: F.get("w", k)["h"]
    alike = lambda k: hash_at(k).eqNullSafe(hash_at(k + 1)) | hash_at(k).eqNullSafe(hash_at(k - 1))
    twice = F.transform(F.filter(F.sequence(F.lit(0), F.size("w") - 1), alike), lambda k: F.get("w", k)["i"])
    rows = rows.select(
        "doc_id", "word_chars", "n_symbols", "n_words", "n_lines",
        count(F.col("n_lines") - F.size("first")).alias("n_dup_lines"),
        F.filter("first", lambda x: ~x["fails"]).alias("good"),
        F.sort_array(F.when(F.col("w").isNotNull(), twice)).alias("at"),
    )
    # a window reaches over three words, or up to the next repeated one
    reach = lambda sum_, k: sum_ + F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - F.get("at", k), F.lit(3)))
    covered = F.aggregate(F.sequence(F.lit(0), F.size("at") - 1), F.lit(0), reach)
    rows = rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        count(F.when(F.size("at") > 0, covered).otherwise(0)).alias("n_repeat_words"),
        "n_lines",
        count(F.size("good")).alias("n_kept_lines"),
        F.aggregate("good", F.lit(0).cast("bigint"), lambda sum_, x: sum_ + x["n"]).alias("kept_words"),
        F.array_join(F.transform("good", lambda x: x["line"]), "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    lost = 100 * (F.col("n_words") - F.col("kept_words")) > LOST_SHARE * F.col("n_words")
    judged_row = F.struct(*[c for c in rows.columns if c not in ("doc_id", "clean_text")], failed.alias("base_failed"), (~failed & ~lost).alias("kept"), "clean_text")
    # through a generator, which no filter on these columns passes: it would repeat all of the above in itself
    return rows.select("doc_id", F.inline(F.array(judged_row)))


#: The same in SQL, with the columns of the query.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(text AS VARCHAR), '') AS text FROM documents),
w AS (SELECT r, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM (SELECT r, regexp_extract_all(text, '[^{SPACE}]+') AS words FROM d)),
tri AS (SELECT r, i, w, lead(w) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM w WINDOW s AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w, w2, w3) AS n FROM tri WHERE w3 IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) s(k) GROUP BY r),
lines AS (SELECT r, line, count(*) AS copies, regexp_extract_all(line, '[^{SPACE}]+') AS words
          FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^{SPACE}]') GROUP BY r, line),
counted AS (SELECT *, len(words) AS n, len(list_filter(words, lambda x: regexp_matches(x, '{SYMBOL}'))) AS sym,
                   len(list_filter(words, lambda x: regexp_matches(x, '{TERMINAL.replace("'", "''")}'))) AS ends, len(list_filter(words, lambda x: regexp_matches(x, '!\\z'))) AS loud, len(list_filter(words, lambda x: regexp_matches(x, '{SEPARATOR}'))) AS sep FROM lines),
judged AS (SELECT *, ends = 0 OR 100 * sym > {SYMBOL_SHARE} * n OR 100 * loud > {SHOUT_SHARE} * n
                     OR (sep >= 2 AND n - sep < {ITEM_WORDS} * sep) OR regexp_matches(translate(line, '{UPPER}', '{LOWER}'), '{BOILERPLATE}') AS fails FROM counted),
per AS (SELECT r, sum(copies) AS lines, sum(copies) - count(*) AS dup, sum(n * copies) AS n_words, count_if(NOT fails) AS good, coalesce(sum(n) FILTER (NOT fails), 0) AS kept_words FROM judged GROUP BY r),
f AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[{SPACE}]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '{SYMBOL}', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(good, 0) AS BIGINT) AS n_kept_lines, CAST(coalesce(kept_words, 0) AS BIGINT) AS kept_words
      FROM d LEFT JOIN per USING (r) LEFT JOIN covered c USING (r))
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_SHARE} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_SHARE} * n_words OR 100 * (n_words - kept_words) > {LOST_SHARE} * n_words) AS kept
FROM f"""
