"""Line-first quality rules, with DataFrame functions only.

Every line is judged by itself: punctuation, navigation and boilerplate.  Lines
that fail are removed; a document that loses too much of its text is rejected,
as is one that fails the base rules on its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space between words, symbols that are counted, marks that
# end a sentence, marks between menu entries.
SPACE = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?:;\"')]}”’»…。！？"
MENU_MARKS = "|»›•·>"

# Phrases of pages rather than of texts, in lower case.
BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies", "accept cookies",
    "enable javascript", "javascript is disabled", "sign in to", "log in to", "sign up for", "subscribe to our", "click here",
    "read more", "share this", "follow us on", "skip to content", "back to top", "add to cart", "powered by", "lorem ipsum",
]


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row: inside the function
    it is a lambda variable, which the optimizer cannot copy back."""
    return F.transform(F.array(value), use)[0]


def bare(text: Column) -> Column:
    """The text without white space."""
    return F.translate(text, SPACE, "")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")


def repeated_words(words: Column, width: int = 5) -> Column:
    """How many words lie in windows of ``width`` words found twice or more."""
    def covered(windows: Column) -> Column:
        def places(sorted_windows: Column) -> Column:
            last = F.size(sorted_windows) - 1
            marked = F.transform(sorted_windows, lambda x, i: F.when(
                ((i > 0) & (F.get(sorted_windows, i - 1)["v"] == x["v"])) | ((i < last) & (F.get(sorted_windows, i + 1)["v"] == x["v"])), x["at"]))
            return F.sort_array(F.filter(marked, lambda at: at.isNotNull()))

        in_order = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("v"), i.alias("at"))))
        start = F.struct(F.lit(0).alias("n"), F.lit(-width).alias("end"))
        counted = F.aggregate(
            once(in_order, places), start,
            lambda acc, at: F.struct((acc["n"] + F.least(F.lit(width), at - acc["end"])).alias("n"), at.alias("end")),
            lambda acc: acc["n"])
        # Most texts repeat no window: they stop at the count of distinct ones.
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(counted)

    def windows_of(hashes: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hashes) - width)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]))

    return F.when(F.size(words) < width, F.lit(0)).otherwise(
        once(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: once(windows_of(hashes), covered)))


def line_fails(line: Column) -> Column:
    """Whether a line with at least one word is to be removed.

    Punctuation: it is too short to be prose (under 12 words) and ends without a
    terminal mark, or over a tenth of its characters are symbols, or over a
    tenth are exclamation marks.  Navigation: three menu marks or more, at least
    one for every four words.  Boilerplate: it holds a phrase of ``BOILERPLATE``
    and has at most 30 words.
    """
    def judge(x: Column) -> Column:
        chars = F.length(bare(x["line"]))
        n_words = F.size(x["words"])
        count = lambda marks: F.length(x["line"]) - F.length(F.translate(x["line"], marks, ""))
        ends = F.rlike(x["line"], F.lit("[" + "".join("\\" + c if c in "\"')]}.!?" else c for c in TERMINAL) + r"][\x20\x09-\x0D]*\z"))
        menu = count(MENU_MARKS)
        phrases = F.rlike(F.lower(x["line"]), F.lit("|".join(BOILERPLATE)))
        return ((~ends & (n_words < 12)) | (10 * count(SYMBOLS) > chars) | (10 * count("!") > chars)
                | ((menu >= 3) & (4 * menu >= n_words)) | ((n_words <= 30) & phrases))

    return once(F.struct(line.alias("line"), words_of(line).alias("words")), judge)


def measure(docs: DataFrame, max_lost_percent: int = 50, text: str = "text", into: str = "rules") -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, lost_chars`` (long), ``base_failed``, ``kept``.

    Base rules: under 10 words, or over 20 % of the words in repeated 5-word
    windows.  The line rules reject a document when the lines they remove hold
    more than ``max_lost_percent`` of its characters in words.  Null and empty
    texts have no words and fail.  A column named ``into`` is replaced, all others
    stay.  Rows are judged in place: nothing is
    shuffled, whatever a source or group of copies holds.
    """
    def judged(x: Column) -> Column:
        lines = F.filter(F.split(x["text"], "\n"), lambda line: bare(line) != "")
        return once(F.struct(lines.alias("lines"), x["text"].alias("text"), x["words"].alias("words")), counts)

    def counts(x: Column) -> Column:
        n_words, word_chars = F.size(x["words"]).cast("long"), F.length(bare(x["text"])).cast("long")
        removed = F.filter(x["lines"], line_fails)
        return once(F.struct(
            n_words.alias("n_words"), word_chars.alias("word_chars"),
            (F.length(x["text"]) - F.length(F.translate(x["text"], SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(x["lines"]) - F.size(F.array_distinct(x["lines"]))).cast("long").alias("n_dup_lines"),
            repeated_words(x["words"]).cast("long").alias("n_repeat_words"),
            F.aggregate(removed, F.lit(0), lambda a, line: a + F.length(bare(line))).cast("long").alias("lost_chars"),
        ), verdict)

    def verdict(x: Column) -> Column:
        failed = (x["n_words"] < 10) | (100 * x["n_repeat_words"] > 20 * x["n_words"])
        lost = 100 * x["lost_chars"] > max_lost_percent * x["word_chars"]
        fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars"]
        return F.struct(*[x[f].alias(f) for f in fields], failed.alias("base_failed"), (~failed & ~lost).alias("kept"))

    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn(into, once(F.struct(whole.alias("text"), words_of(whole).alias("words")), judged))


def clean(text: Column) -> Column:
    """The text without the lines that fail; blank lines stay, null stays null."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: (bare(line) == "") | ~line_fails(line)), "\n")
