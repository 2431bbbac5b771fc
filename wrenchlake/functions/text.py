"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART_LIST = "array<struct<`Part No`:string,`Part Description`:string>>"
TEXT_LIST = "array<string>"


def ascii_only(c: Column) -> Column:
    """Drop every character outside 7-bit ASCII."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def before_marker(c: Column, marker: str) -> Column:
    """Text in front of the first ``marker``; the whole text if there is none."""
    return F.substring_index(c, marker, 1)


def one_line(c: Column) -> Column:
    """Line feeds become blanks, carriage returns vanish."""
    return F.translate(c, "\n\r", " ")


# A quoted run, in either quote, or text without quotes. Possessive, so long texts need no deep recursion.
_PIECES = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^'"]++"""


# What a Python literal has that JSON lacks; a text without any of it is read as it stands.
_PYTHON_WORDS = {"None": "null", "True": "true", "False": "false"}
_NOT_JSON = r"None|True|False|,\s*+[\]}]"


def parse_literal(c: Column, ddl: str, strict: bool = True) -> Column:
    """Read a list written as a Python literal into an array.

    Strings may stand in single or double quotes; ``None``, ``True``, ``False``
    and a comma before a closing bracket are understood outside of quotes, with
    any blanks around them. A text that is no such list fails the query, or is
    NULL with ``strict=False``; a blank text is NULL. The parse stands once in
    the expression; give it a column of its own before it is used twice.
    """
    line = one_line(c)

    def rewritten(piece: Column) -> Column:
        plain = piece
        for word, new in _PYTHON_WORDS.items():
            plain = F.replace(plain, F.lit(word), F.lit(new))
        plain = F.regexp_replace(plain, r",(\s*[\]}])", "$1")
        return F.when(F.substring(piece, 1, 1).isin("'", '"'), piece).otherwise(plain)

    pieces = F.transform(F.regexp_extract_all(line, F.lit(_PIECES), F.lit(0)), rewritten)
    as_json = F.when(line.rlike(_NOT_JSON), F.array_join(pieces, "")).otherwise(line)
    parsed = F.from_json(as_json, ddl, {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"})
    if not strict:
        return parsed
    return F.coalesce(parsed, F.when(F.trim(line) != "", F.raise_error(F.concat(F.lit("not a list: "), c)).cast(ddl)))


def joined_field(items: Column, field: str) -> Column:
    """One field of every struct in an array, joined with commas."""
    return F.array_join(F.transform(items, lambda item: item[field]), ",")


def relabel_if_contains(c: Column, word: str, label: str) -> Column:
    """Upper-cased text, replaced by ``label`` where it holds ``word`` in any case."""
    upper = F.upper(c)
    return F.when(upper.contains(word.upper()), F.lit(label)).otherwise(upper)
