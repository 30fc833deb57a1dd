"""Text helpers that agree with the usual scripting-language string rules.

``trim`` and ``\\s`` in SQL engines know fewer white-space characters than the
record format does, so strip, word count and line splitting name the full set.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, functions as F

# Code points of the white space that strip and word splitting
# honour.
WHITESPACE = "".join(
    map(
        chr,
        [
            0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
            0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
            0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ],
    )
)

# The same set as a regular expression: Unicode white space and four separators.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Code points that end a line in line splitting, besides "\r\n".
LINE_ENDS = "".join(
    map(chr, [0x0A, 0x0D, 0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029])
)
LINE_END = "\r\n|[" + LINE_ENDS + "]"

FENCE = "```"

# Substrings that name an error class, first class that matches
# wins, anything else is fatal.
ERROR_CLASSES = [
    ("timeout", ["timeout", "timed out"]),
    ("auth", ["401", "unauthorized"]),
    ("rate_limit", ["429", "rate limit"]),
]
FATAL = "fatal"


def strip(text: Column) -> Column:
    """Drop leading and trailing white space (the full Unicode set)."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """White-space separated words as an array."""
    return F.array_remove(F.split(text, WHITESPACE_RUN), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def contains_any(text: Column, needles: Iterable[str]) -> Column:
    """Whether one of a few substrings occurs; byte search, no regex."""
    return reduce(
        lambda acc, needle: acc | F.contains(text, F.lit(needle)), needles, F.lit(False)
    )


def has_line_end(text: Column) -> Column:
    return contains_any(text, LINE_ENDS)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once.  Expressions inside array
    lambdas and conditional branches are otherwise evaluated per mention."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def strip_fences(raw: Column) -> Column:
    """Remove the Markdown fence around a fenced payload.

    Only a payload that *opens* with a fence is touched: its first line goes
    whole, then every trailing line that starts with a fence.
    """

    def body(lines: Column) -> Column:
        last = F.array_max(
            F.transform(
                lines,
                lambda line, pos: F.when(
                    (pos == 0) | F.startswith(strip(line), F.lit(FENCE)), F.lit(0)
                ).otherwise(pos),
            )
        )
        return strip(F.array_join(F.slice(lines, F.lit(2), last), "\n"))

    def unwrap(text: Column) -> Column:
        # the regex is slow and other line ends than a line feed are rare
        plain = F.when(
            contains_any(text, LINE_ENDS[1:]), F.regexp_replace(text, LINE_END, "\n")
        ).otherwise(text)
        return F.when(F.startswith(text, F.lit(FENCE)), let(F.split(plain, "\n"), body)).otherwise(text)

    return let(strip(raw), unwrap)


def is_yes(response: Column) -> Column:
    """A judge answer passes when it opens with YES, whatever follows."""
    return F.coalesce(F.startswith(F.upper(strip(response)), F.lit("YES")), F.lit(False))


def error_class(error: Column) -> Column:
    """Class of an error text; null for no error."""
    lowered = F.lower(error)
    out = F.when(error.isNull(), F.lit(None).cast("string"))
    for name, needles in ERROR_CLASSES:
        out = out.when(contains_any(lowered, needles), F.lit(name))
    return out.otherwise(F.lit(FATAL))


def hash_number(*parts: Column) -> Column:
    """Reproducible non-negative 60-bit number from the given parts.

    The same value on every engine that has md5, and independent of row order
    and partitioning, unlike ``rand``.
    """
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def record_id(index: Column) -> Column:
    """``rule-%06d`` of the 1-based position; wider numbers are not cut."""
    return F.format_string("rule-%06d", index + 1)
