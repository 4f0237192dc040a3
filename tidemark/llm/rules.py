"""Quality rules with lines first: clean each line, then judge the document by what is left. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Characters of mark-up, tables and prices.
SYMBOLS = "#*$%&|<>"
#: ASCII white space.
BLANKS = " \t\n\x0b\f\r"
#: Words that make a short line a menu.
NAVIGATION = "home menu login logout register search sitemap next previous prev back contact about share".split()
#: Phrases of site furniture.
BOILERPLATE = (
    "all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept cookies|enable javascript"
    "|click here|subscribe to our|sign up for|lorem ipsum|read more"
)


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), then), 1)


def word_array(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def repeated_window_words(words: Column) -> Column:
    """Number of words that lie in a 3-word window found twice or more."""

    def window(w: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))

    def starts(s: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1)["h"], F.get(s, i + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        own = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
        return F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x)

    hashes = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), window)
    return _let(_let(F.array_sort(hashes), starts), covered)


def count_symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))


def line_passes(line: Column, words: Column, bare: Column, symbols: Column) -> Column:
    """Punctuation, navigation and boilerplate rules for one line with ``words`` words of ``bare`` characters.

    ``symbols`` is a bound on its symbols: where that is small enough, they are not counted again.
    """
    punctuation = (10 * symbols <= bare) | (10 * count_symbols(line) <= bare)
    ended = (words >= 3) | F.rlike(line, F.lit(r"""[.!?…:;。！？]["'”’»)\]]*\s*$"""))
    menu = (words <= 6) & F.rlike(F.lower(line), F.lit(r"^\W*(" + "|".join(NAVIGATION) + r")\b"))
    rows = F.rlike(line, F.lit("[|»›].*[|»›].*[|»›]"))
    boilerplate = (words <= 20) & F.rlike(F.lower(line), F.lit(BOILERPLATE))
    return punctuation & ended & ~menu & ~rows & ~boilerplate


def _verdict(text: Column, most_lost: float) -> Column:
    def of_line(line: Column) -> Column:
        return _let(
            word_array(line),
            lambda words: F.struct(line.alias("line"), words.alias("words"), F.length(F.array_join(words, "")).alias("bare")),
        )

    def counted(lines: Column, symbols: Column) -> Column:
        full = F.filter(lines, lambda x: x["bare"] > 0)
        stay = F.filter(
            lines, lambda x: (x["bare"] == 0) | line_passes(x["line"], F.size(x["words"]), x["bare"], symbols)
        )
        total = lambda x: F.aggregate(x["bare"], F.lit(0).cast("long"), lambda a, n: a + n)
        return F.struct(
            _let(F.flatten(lines["words"]), lambda words: F.struct(
                F.size(words).cast("long").alias("n"), repeated_window_words(words).alias("repeated")
            )).alias("words"),
            total(lines).alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            _let(full["line"], lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _let(stay, lambda x: F.struct(
                F.array_join(x["line"], "\n").alias("cleaned"), total(x).alias("left")
            )).alias("stay"),
        )

    def judged(c: Column) -> Column:
        n, repeated = c["words"]["n"], c["words"]["repeated"]
        failed = (n < 50) | (100 * repeated > 50 * n)
        return F.struct(
            n.alias("n_words"),
            *[c[x].alias(x) for x in ("word_chars", "n_symbols", "n_dup_lines")],
            repeated.alias("n_repeat_words"),
            failed.alias("base_failed"),
            c["stay"]["cleaned"].alias("cleaned"),
            (~failed & (c["stay"]["left"] >= (1 - most_lost) * c["word_chars"])).alias("kept"),
        )

    lines = F.transform(F.split(text, "\n", -1), of_line)
    counts = _let(lines, lambda x: _let(count_symbols(text), lambda symbols: counted(x, symbols)))
    return _let(counts, judged)


def quality_rules(df: DataFrame, text_col: str = "text", most_lost: float = 0.5) -> DataFrame:
    """All columns plus ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``base_failed``, ``cleaned`` (the text without failing lines) and ``kept``.

    A document fails the base rules with fewer than 50 words, or if more than half of its words lie in 3-word windows
    that occur twice or more. Otherwise its lines are judged one by one; those of mostly symbols, unfinished short
    ones, menus, table rows and site furniture go; lines without words stay. It is kept unless more than ``most_lost``
    of its word characters went with them.

    Words are separated by ASCII white space. Null text counts as empty (and fails). Rows are independent of each
    other; columns with the names above are replaced. No Python runs on the executors. The verdict is unpacked by a
    generator, so that a filter on it does not evaluate it again.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned", "kept"]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(_verdict(text, most_lost))))
