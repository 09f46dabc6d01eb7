"""String column functions: quote-aware splitting and small text helpers.

All of them return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen. Literal arguments are plain Python strings.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed value: a separator only splits where an even number of double quotes
# follows it up to the end of the line, so quoted parts stay whole.
QUOTE_AWARE_LOOKAHEAD = '(?=(?:[^"]*"[^"]*")*[^"]*$)'

# Fixed value: Java's String.trim() strips every char <= U+0020 at both ends.
_JAVA_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+\z"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Marks the separators to split on. A NUL of the line itself is escaped first,
# so a mark can only come from a separator.
_NUL, _MARK, _ESCAPED = "\x00", "\x00\x01", "\x00\x02"
_REGEX_META = set(".$|()[]{}^?*+\\")


# A separator expression whose matches hold no quote and look at nothing outside themselves: literals,
# escaped signs, the classes for blanks, digits and word characters, plain [...] sets, groups, choices, repeats.
_PLAIN_SET = r"""\[(?![\^\]])(?:[\w ;:,/|!@#%&=~'<>.*+?(){}$-]|\\[-\]\[|.\\tsdw])+\]"""
_PLAIN_SEPARATOR = re.compile(
    r"""(?:[\w ;:,/!@#%&=~'<>-]|\\[|.$()\[\]{}^?*+\\tsdw-]|""" + _PLAIN_SET + r"""|\((?:\?:|(?!\?))|\)|\||[+*?]|\{\d+(?:,\d*)?\})+""",
    re.ASCII)


def _cuts_within_segments(separator: str) -> bool:
    """Can the separator be searched in each run between quotes on its own: its matches hold no quote, are not
    empty, and depend on nothing around them."""
    if not _PLAIN_SEPARATOR.fullmatch(separator):
        return False
    # the look-ahead follows the separator's text, so of choices outside a group only the last one has it
    bare = re.sub(r"\\.|\[[^\]]*\]", "", separator)
    while re.search(r"\([^()]*\)", bare):
        bare = re.sub(r"\([^()]*\)", "", bare)
    if "|" in bare:
        return False
    for piece in re.findall(r"\[[^\]]*\]", separator):
        for low, high in re.findall(r"(?<![\\])(.)-(.)", piece[1:-1]):
            if low <= '"' <= high:
                return False
    try:
        return re.compile(separator, re.ASCII).fullmatch("") is None
    except re.error:
        return False


def quoted_split(c: ColumnOrName, separator: str = ",") -> Column:
    """Split on ``separator`` outside double quotes, keeping quotes and trailing empties.

    A separator splits where an even number of double quotes follows it to
    the end of the text. ``separator`` is used as a regular expression, as
    the original API does.

    The split is linear: cut the text at every quote; counted from the end, a
    segment's index is the number of quotes after it, so its separators split
    exactly when that index is even. Those are marked, the segments re-joined,
    and the text split at the marks. The look-ahead regex gives the same parts
    but rescans the rest of the line at every separator -- quadratic, and
    minutes instead of a second on lines with a long quoted polygon.

    Expressions that can match a quote or the empty text, or that look around
    themselves (anchors, word boundaries, look-around, back references, negated
    sets, ``.``), depend on more than their segment; only these still use the
    look-ahead.
    """
    c = _col(c)
    if len(separator) == 1 and separator not in _REGEX_META and separator not in '"\x00\x01\x02':
        def mark(seg: Column) -> Column:
            return F.replace(seg, F.lit(separator), F.lit(_MARK))
    elif _cuts_within_segments(separator):
        def mark(seg: Column) -> Column:
            return F.regexp_replace(seg, separator, _MARK)
    else:
        return F.split(c, separator + QUOTE_AWARE_LOOKAHEAD, -1)
    # counted from the end, the index of a segment is the number of quotes
    # after it, so the lambda needs only its own index (nothing per element
    # that would re-split the line)
    from_end = F.reverse(F.split(F.replace(c, F.lit(_NUL), F.lit(_ESCAPED)), '"', -1))
    marked = F.transform(from_end, lambda seg, j: F.when((j % 2) == 0, mark(seg)).otherwise(seg))
    parts = F.split(F.array_join(F.reverse(marked), '"'), _MARK, -1)
    return F.transform(parts, lambda p: F.replace(p, F.lit(_ESCAPED), F.lit(_NUL)))


def java_trim(c: ColumnOrName) -> Column:
    """Trim every control/space char (<= U+0020) from both ends."""
    return F.regexp_replace(_col(c), _JAVA_TRIM, "")


def quoted_split_nonempty(c: ColumnOrName, separator: str = ",") -> Column:
    """:func:`quoted_split`, then trim each item and drop the empty ones."""
    parts = F.transform(quoted_split(c, separator), java_trim)
    return F.filter(parts, lambda x: x != F.lit(""))


def has_length(c: ColumnOrName) -> Column:
    """True when the value is non-null and non-empty."""
    c = _col(c)
    return F.coalesce(c.isNotNull() & (F.length(c) > 0), F.lit(False))


def trim_end(c: ColumnOrName, tail: str) -> Column:
    """Drop one trailing ``tail`` if present."""
    c = _col(c)
    n = len(tail)
    return F.when(c.endswith(tail), _substr(c, 1, F.length(c) - n)).otherwise(c)


def trim_head(c: ColumnOrName, head: str) -> Column:
    """Drop one leading ``head`` if present."""
    c = _col(c)
    n = len(head)
    return F.when(c.startswith(head), _substr(c, n + 1, F.length(c) - n)).otherwise(c)


def trim_quotechar(c: ColumnOrName, quote: str = '"') -> Column:
    """Drop ``quote`` from both ends when it is at both ends.

    A value too short to hold two quotes (e.g. a lone ``"``) is returned
    unchanged.
    """
    c = _col(c)
    n = len(quote)
    hit = c.startswith(quote) & c.endswith(quote) & (F.length(c) >= 2 * n)
    return F.when(hit, _substr(c, n + 1, F.length(c) - 2 * n)).otherwise(c)


def output_path(name: ColumnOrName, directory: str, src_ext: str = ".hdf",
                dst_ext: str = ".tif") -> Column:
    """``directory`` + name with every ``src_ext`` replaced by ``dst_ext``."""
    return F.concat(F.lit(directory), F.replace(_col(name), F.lit(src_ext), F.lit(dst_ext)))


def suffix_filter(c: ColumnOrName, suffix: str) -> Column:
    """Case-sensitive literal suffix predicate."""
    return F.coalesce(_col(c).endswith(suffix), F.lit(False))


def token_list(c: ColumnOrName, suffix: str = ".TIF") -> Column:
    """Whitespace-separated tokens of ``c`` that end with ``suffix``."""
    return F.filter(F.split(_col(c), r"\s+"), lambda t: t.endswith(suffix))


def _substr(c: Column, pos: int, length: Column) -> Column:
    return c.substr(F.lit(pos), length)
