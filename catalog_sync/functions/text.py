"""Text expressions: cleaning, whitespace stripping, embedding input text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's str.strip() treats as whitespace (str.isspace).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col, chars: str = "") -> Column:
    """Strip leading and trailing whitespace (Unicode), plus any of ``chars``."""
    cls = r"[\s" + "".join("\\" + ch for ch in chars) + "]"
    return F.regexp_replace(_c(col), f"(?U)^{cls}+|{cls}+$", "")


def trim_ws(col, extra_left: str = "", extra_right: str = "") -> Column:
    """Python-style ``strip()`` with plain trims (no regex): whitespace, then
    ``extra_left`` / ``extra_right`` characters from that side, then whitespace."""
    c = F.trim(_c(col), F.lit(PY_WHITESPACE))
    if extra_left:
        c = F.trim(F.ltrim(c, F.lit(extra_left)), F.lit(PY_WHITESPACE))
    if extra_right:
        c = F.trim(F.rtrim(c, F.lit(extra_right)), F.lit(PY_WHITESPACE))
    return c


def clean_text(col) -> Column:
    """CRLF/CR/LF -> space, drop control chars below 32 except tab/newline/CR,
    collapse whitespace runs to one space, trim. Order of steps matters."""
    c = F.regexp_replace(_c(col), "\r\n", " ")
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    c = F.regexp_replace(c, r"(?U)\s+", " ")
    return strip_ws(c)


def build_embedding_text(description="description", brand="brand", category="category") -> Column:
    """``description | Brand: <brand> | Category: <category>``; a NULL part is skipped."""
    return F.concat_ws(
        " | ",
        _c(description),
        F.concat(F.lit("Brand: "), _c(brand)),
        F.concat(F.lit("Category: "), _c(category)),
    )
