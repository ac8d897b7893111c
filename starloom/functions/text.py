"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

# The characters Python treats as white space when stripping.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The texts a pandas CSV reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The texts the relational loader takes as missing, after stripping.
LOAD_NULL_TOKENS = ("", "nan", "NaT", "None")


def sql_text(value: object) -> str:
    """A text or number as a SQL literal. Long literal lists go to Spark as one SQL text:
    building them one Column at a time costs a call into the JVM per entry."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends.

    Plain spaces go first, which is cheap; the slower trim by character set only sees
    texts that begin or end with a control or non-ASCII character.
    """
    spaced = F.trim(c)
    first, last = F.substring(spaced, 1, 1), F.substring(spaced, -1, 1)
    special = (first <= " ") | (first >= "\x80") | (last <= " ") | (last >= "\x80")
    return F.when(special, F.btrim(spaced, F.lit(WHITESPACE))).otherwise(spaced)


_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"


def title_case(c: Column) -> Column:
    """Upper-case every cased letter that does not follow one, lower-case the rest.

    ``initcap`` alone looks at spaces only (O'neil); cutting the text after every
    character that is not a cased letter first gives O'Neil and 3Rd. A text of letters
    only needs no cutting.
    """
    pieces = F.split(c, f"(?<=[^{_CASED}])")
    cut = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(c.rlike(f"[^{_CASED}]"), cut).otherwise(F.initcap(c))


def null_token(column: str) -> Column:
    """Missing-value texts of a CSV field become NULL; the text is not stripped first."""
    tokens = ", ".join(map(sql_text, NULL_TOKENS))
    return F.expr(f"CASE WHEN `{column}` NOT IN ({tokens}) THEN `{column}` END")


def load_value(c: Column) -> Column:
    """Blank, ``nan``, ``NaT`` and ``None`` texts become NULL; other values stay as they are."""
    return F.when(~strip(c).isin(*LOAD_NULL_TOKENS), c)


def lookup(c: Column, mapping: Mapping[str, object], default: object = None) -> Column:
    """Dictionary lookup with an optional default for everything not found."""
    entries = ", ".join(sql_text(x) for pair in mapping.items() for x in pair)
    found = F.try_element_at(F.expr(f"map({entries})"), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def canonical(c: Column, mapping: Mapping[str, str]) -> Column:
    """Alias -> canonical text for a stripped text; an unknown one stays, NULL stays NULL."""
    return F.coalesce(lookup(F.lower(c), mapping), c)


def joined_name(*parts: Column) -> Column:
    """Parts joined by single spaces with missing parts empty, then stripped."""
    filled = [F.coalesce(p, F.lit("")) for p in parts]
    spaced = [x for p in filled for x in (F.lit(" "), p)][1:]
    return strip(F.concat(*spaced))


def strict_name(*parts: Column) -> Column:
    """Parts joined by single spaces; NULL when any part is NULL (SQL CONCAT)."""
    spaced = [x for p in parts for x in (F.lit(" "), p)][1:]
    return F.concat(*spaced)


def display(c: Column, numeric: bool) -> Column:
    """Report text: thousands separators for numbers, a dash for missing values."""
    pattern = F.lit("#,##0.###")
    shown = F.call_function("format_number", c, pattern) if numeric else F.when(c != "", c)
    return F.coalesce(shown, F.lit("—"))
