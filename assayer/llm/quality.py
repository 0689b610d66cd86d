"""Quality rules in Spark's own functions: line-first cleaning.

Every line is judged by itself, by rules on punctuation, navigation and
boilerplate. Lines that fail are removed; a document is rejected if that takes
too large a share of its text, or if it fails the base rules on the number of
words and on repeated words.

Defined results: a null text has no words and fails the base rules; blank lines
pass every line rule; an empty table gives no rows; equal rows give equal
results. Texts of any length are judged whole.

A count of repeated words compares windows of three words by 64-bit hashes
within one text. Hashes are only sorted where some occur twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space and symbols of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: A document may lose this share of its word characters with its bad lines.
MOST_LOST_PERCENT = 40

#: Marks that running text has few of, and how many a line may have: fewer than
#: three, or at most this share of its characters.
MARKS = SYMBOLS + "!{}=~^\\_"
MOST_MARKS_PERCENT = 8
MENU_WORDS = (
    r"(?:home|menu|log ?in|log ?out|sign in|sign up|register|search|contact(?: us)?"
    r"|about(?: us)?|next|previous|back|top|share|print|site ?map|faq|help|blog|shop|cart"
    r"|skip to content|read more|load more|go to top)\b"
)
#: Menus put one of these marks behind every few words: at least three in a line,
#: and one in this many characters.
SEPARATORS = "|»›•·"
CHARACTERS_PER_SEPARATOR = 40
BOILERPLATE = (
    r"(?i)\b(?:all rights reserved|licensed under|released under the|copyright (?:\(c\)|©|[0-9])"
    r"|terms of (?:use|service)|privacy policy|cookie policy|uses? cookies|enable javascript"
    r"|subscribe to (?:our|the)|click here|lorem ipsum|powered by \w)"
)
#: A line that does not end a sentence needs this many words.
UNENDED = r"^[\x20\x09-\x0D]*(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){0,3}[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?:;,…\"'”’»)\]][\x20\x09-\x0D]*$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _count(text: Column, characters: str) -> Column:
    """How many of the characters of a text are among these."""
    others = "[^" + "".join(f"\\x{{{ord(c):x}}}" for c in characters) + "]+"
    return F.length(F.regexp_replace(text, others, ""))


def _word_characters(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SPACE, "")).cast("long")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line of the text."""
    return let(
        lines_with_words(text),
        lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
    )


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words in windows of ``width`` words that the text has twice or more."""

    def windows(hashes: Column) -> Column:
        firsts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (width - 1), F.lit(0)))
        return F.transform(
            firsts, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, width)])
        )

    def covered(found: Column) -> Column:
        placed = F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        return let(F.sort_array(placed), lambda ordered: let(places(ordered), spread))

    def places(ordered: Column) -> Column:
        def repeats(e: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)["h"].eqNullSafe(e["h"])
            return before | F.get(ordered, i + 1)["h"].eqNullSafe(e["h"])

        return F.sort_array(F.transform(F.filter(ordered, repeats), lambda e: e["p"]))

    def spread(at: Column) -> Column:
        # Each window covers its words up to where the next one begins.
        nexts = F.slice(at, 2, F.greatest(F.size(at), F.lit(1)))
        steps = F.zip_with(
            at, nexts, lambda a, b: F.coalesce(F.least(b - a, F.lit(width)), F.lit(width))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    def count(found: Column) -> Column:
        none_twice = F.size(F.array_distinct(found)) == F.size(found)
        return F.when(none_twice, F.lit(0).cast("long")).otherwise(covered(found))

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return let(hashes, lambda each: let(windows(each), count))


def only_menu_words(line: Column) -> Column:
    """Whether a line has menu words and else no letter or digit.

    They are taken out and what is left is looked at: a pattern that repeats a group over
    the line would need the matcher's stack for each word.
    """
    rest = F.regexp_replace(line, f"(?i){MENU_WORDS}", "")
    return line.rlike(rf"(?i)^\W*+{MENU_WORDS}") & ~rest.rlike(r"\w")


def line_passes(line: Column) -> Column:
    """The line rules; blank lines pass."""
    length = F.length(line)
    marks, separators = _count(line, MARKS), _count(line, SEPARATORS)
    marked = (marks >= 3) & (marks * 100 > length * MOST_MARKS_PERCENT)
    menu = (separators >= 3) & (separators * CHARACTERS_PER_SEPARATOR >= length)
    bad = (
        ~line.rlike(r"\p{L}")
        | marked
        | menu
        | only_menu_words(line)
        | line.rlike(BOILERPLATE)
        | line.rlike(UNENDED)
    )
    return ~line.rlike(r"[^\x20\x09-\x0D]") | ~bad


def judge(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as a struct, ``document``, and its ``quality``.

    The fields of ``quality``: ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``n_lines``, ``n_bad_lines``,
    ``kept_chars``, ``clean_text`` and ``kept``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def fields(words: Column, lines: Column, good: Column) -> Column:
        n_words = F.size(words).cast("long")
        clean = F.array_join(good, "\n")
        return F.struct(
            n_words.alias("n_words"),
            _word_characters(text).alias("word_chars"),
            _count(text, SYMBOLS).cast("long").alias("n_symbols"),
            duplicate_lines(text).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(good)).cast("long").alias("n_bad_lines"),
            F.when(F.size(good) == F.size(lines), text).otherwise(clean).alias("clean_text"),
        )

    def verdict(q: Column) -> Column:
        few = q["n_words"] < LEAST_WORDS
        repeated = 100 * q["n_repeat_words"] > MOST_REPEATED_PERCENT * q["n_words"]
        kept_chars = F.when(q["n_bad_lines"] == 0, q["word_chars"]).otherwise(
            _word_characters(q["clean_text"])
        )
        lost = 100 * (q["word_chars"] - kept_chars) > MOST_LOST_PERCENT * q["word_chars"]
        names = (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_bad_lines", "clean_text",
        )
        return F.struct(
            *[q[n].alias(n) for n in names],
            kept_chars.alias("kept_chars"),
            (few | repeated).alias("base_failed"),
            (~few & ~repeated & ~lost).alias("kept"),
        )

    made = let(
        words_of(text),
        lambda words: let(
            F.split(text, "\n"),
            lambda lines: let(
                F.filter(lines, line_passes), lambda good: fields(words, lines, good)
            ),
        ),
    )
    # A filter on the verdict is not pushed below a generator, where it would be
    # worked out once more.
    judged = F.explode(F.array(let(made, verdict))).alias("quality")
    return docs.select(F.struct(*docs.columns).alias("document"), judged)
