"""Column expressions for text: titles, delimited lists, tokens, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import TOKEN_SPLIT_SPEC, TOKEN_SPLIT_STRICT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t != "", t)


def title_text(title) -> Column:
    """``"Base: Subtitle (1995)"`` -> ``"Subtitle Base"``; ``"Base (1995)"`` -> ``"Base"``.

    The part after the first colon (up to the 7-character year suffix) goes
    first.  Parts are trimmed and joined by one blank; an empty result is NULL.
    """
    t = _col(title)
    n = F.length(t)
    p = F.locate(":", t)
    sub_len = F.greatest(n - p - F.lit(7), F.lit(0))
    sub = F.when(p != 0, F.substring(t, p + 1, sub_len))
    base_len = F.greatest(F.when(p != 0, p - 1).otherwise(n - 6), F.lit(0))
    base = F.substring(t, F.lit(1), base_len)
    out = F.concat_ws(" ", _blank_to_null(sub), _blank_to_null(base))
    return F.when(out != "", out)


def title_year(title) -> Column:
    """The four characters before the last one as an int; not a number -> NULL."""
    t = _col(title)
    return F.substring(t, F.length(t) - 4, F.lit(4)).try_cast("int")


def split_list(c, sep: str = "|") -> Column:
    """Delimited text -> array; the separator is a literal, not a pattern."""
    import re
    return F.split(_col(c), re.escape(sep))


def full_name(first, last) -> Column:
    """Blank-joined name; NULL parts are skipped."""
    return F.concat_ws(" ", _col(first), _col(last))


def tokens(text, mode: str = "strict") -> Column:
    """Array of tokens.  ``strict``: the tagger's separators (punctuation only
    when a blank follows); ``spec``: whitespace and , : ! ? runs."""
    pattern = {"strict": TOKEN_SPLIT_STRICT, "spec": TOKEN_SPLIT_SPEC}[mode]
    return F.split(_col(text), pattern)


def is_number(c) -> Column:
    return _col(c).rlike(r"^\d+(\.\d+)?$")
