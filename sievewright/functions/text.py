"""Text cleaning expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievewright.contracts import (
    CLEANING_NULL_TOKENS,
    CLEANING_NULL_TOKENS_EXACT,
    CURRENCY_SIGNS,
    REPORT_NULL_TOKENS,
    SPECIAL_CHARACTERS,
)

# White space other than the blank, in ASCII and in all of Unicode.
OTHER_WHITE_SPACE = "\t\n\x0b\f\r"
UNICODE_WHITE_SPACE = r"[\s\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"

# Most values are numbers, dates or plain words. One look at such a value says that cleaning leaves it or only sets its case.
NUMBER_LIKE_PATTERN = r"^[0-9$,./-]+\z"
DIGITS_PATTERN = r"^[0-9.]+\z"
PLAIN_WORDS_PATTERN = r"^[A-Za-z]+[0-9]*(?: [A-Za-z]+[0-9]*| [0-9]+)*\z"
#: Patterns with groups that repeat are for short texts: the engine nests a call per repetition.
SHORT_TEXT = 100

# English number words.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7,
    "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14,
    "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20,
    "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90,
    "hundred": 100, "thousand": 1_000, "million": 1_000_000, "billion": 1_000_000_000,
}


def backticked(name: str) -> str:
    """A column name for SQL text and for ``select``; it may hold spaces or dots."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """A column by its exact name."""
    return F.col(backticked(name))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def untidy(text: Column) -> Column:
    return reduce(or_, [text.contains(w) for w in ("  ", *OTHER_WHITE_SPACE)])


def collapse_spaces(c: Column) -> Column:
    """Trim blanks and make each run of white space one blank; tidy text skips the regular expression."""
    text = F.trim(c)
    return F.when(untidy(text), F.regexp_replace(text, r"\s+", " ")).otherwise(text)


def collapse_unicode_spaces(c: Column) -> Column:
    """As :func:`collapse_spaces` with all Unicode white space, also at the edges."""
    text = F.trim(c)
    suspect = untidy(text) | (F.octet_length(text) != F.length(text))
    collapsed = F.trim(F.regexp_replace(text, UNICODE_WHITE_SPACE, " "))
    return F.when(suspect, collapsed).otherwise(text)


def null_if_cleaning_token(c: Column, cleaned: Column) -> Column:
    return F.when(~F.lower(F.trim(c)).isin(*CLEANING_NULL_TOKENS), cleaned)


def title_words(c: Column) -> Column:
    """Title case by blank-separated word; blank, null, none, nan (any case) become NULL."""
    return F.when(c.rlike(NUMBER_LIKE_PATTERN), c).otherwise(null_if_cleaning_token(c, F.initcap(collapse_spaces(c))))


def title_letters(c: Column) -> Column:
    """Title case after every non-letter (``O'Neil Mary-Jane``); tokens are matched in exact case.

    Unicode blanks are trimmed and collapsed too. Plain words take the built-in ``initcap``, numbers stay; only text
    with a letter behind a sign or digit pays for the split.
    """
    plain = (F.length(c) <= SHORT_TEXT) & c.rlike(PLAIN_WORDS_PATTERN) & ~c.isin(*CLEANING_NULL_TOKENS_EXACT)
    return F.when(c.rlike(NUMBER_LIKE_PATTERN), c).when(plain, F.initcap(c)).otherwise(_title_letters(c))


def _title_letters(c: Column) -> Column:
    tidy = collapse_unicode_spaces(c)
    pieces = F.split(F.lower(tidy), r"(?<!\p{L})(?=\p{L})")
    titled = F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), ""
    )
    cased = F.when(tidy.rlike(r"[^\p{L} ]\p{L}"), titled).otherwise(F.initcap(tidy))
    return F.when(~tidy.isin(*CLEANING_NULL_TOKENS_EXACT), cased)


def upper_id(c: Column) -> Column:
    text = c.cast("string")
    return null_if_cleaning_token(text, F.upper(collapse_spaces(text)))


def strip_currency(c: Column) -> Column:
    """Delete currency signs and thousands commas anywhere, then trim."""
    return F.trim(F.translate(c, CURRENCY_SIGNS + ",", ""))


def strip_special(c: Column) -> Column:
    """Delete the replacement character and the invisible characters."""
    return F.translate(c, SPECIAL_CHARACTERS, "")


def is_null_token(c: Column, case_sensitive: bool = False) -> Column:
    """Text that means "missing" in the null report; false for NULL itself.

    By default any letter case matches, so ``Na`` (what title case makes of ``NA``) is seen as missing.
    """
    text = F.trim(c.cast("string"))
    if case_sensitive:
        hit = text.isin(*REPORT_NULL_TOKENS)
    else:
        hit = F.lower(text).isin(*sorted({t.lower() for t in REPORT_NULL_TOKENS}))
    return F.coalesce(hit, F.lit(False))


def spelled_number(name: str) -> Column:
    """``twenty one`` -> ``21``; text without number words, or not a well-formed number, is unchanged.

    Words that are not number words are skipped, scales must fall (million before thousand), digits may
    follow ``point``. One fold over the words of texts that hold a letter; numbers never enter it.
    """
    known = ",".join(f"{word}:{number}" for word, number in {**NUMBER_WORDS, "point": -1}.items())
    return F.expr(r"""
        CASE WHEN {c} RLIKE r'\p{{L}}' THEN coalesce(aggregate(
          transform(split(translate(lower({c}), '-', ' '), r'\s+'),
                    w -> cast(try_element_at(str_to_map('{known}'), w) AS bigint)),
          named_struct('total', 0L, 'group', 0L, 'scale', 1000000000000L, 'digits', cast(NULL AS string),
                       'words', 0, 'ok', true),
          (a, n) -> CASE
            WHEN n IS NULL THEN a
            WHEN n = -1 THEN named_struct(
              'total', a.total, 'group', a.`group`, 'scale', a.scale, 'digits', '',
              'words', a.words + 1, 'ok', a.ok AND a.digits IS NULL)
            WHEN a.digits IS NOT NULL THEN named_struct(
              'total', a.total, 'group', a.`group`, 'scale', a.scale, 'digits', concat(a.digits, cast(n AS string)),
              'words', a.words + 1, 'ok', a.ok AND n < 10)
            WHEN n >= 1000 THEN named_struct(
              'total', a.total + greatest(a.`group`, 1L) * n, 'group', 0L, 'scale', n, 'digits', a.digits,
              'words', a.words + 1, 'ok', a.ok AND n < a.scale AND a.`group` < 1000)
            WHEN n = 100 THEN named_struct(
              'total', a.total, 'group', least(greatest(a.`group`, 1L), 100L) * 100, 'scale', a.scale,
              'digits', a.digits, 'words', a.words + 1, 'ok', a.ok AND a.`group` < 100)
            ELSE named_struct(
              'total', a.total, 'group', a.`group` + n, 'scale', a.scale, 'digits', a.digits,
              'words', a.words + 1, 'ok', a.ok) END,
          a -> CASE WHEN a.ok AND a.words > 0 AND coalesce(a.digits <> '', true)
                    THEN concat_ws('.', cast(a.total + a.`group` AS string), a.digits) END
        ), {c}) ELSE {c} END
    """.format(c=backticked(name), known=known))
