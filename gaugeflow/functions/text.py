"""Text expressions: stripping, blanks, sentinels and delimited mode lists."""

from __future__ import annotations

from gaugeflow import contract as C
from gaugeflow.functions import name, one_of, quote

VISIBLE_ASCII = "!-~"

# Every character a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: str, unless: str | None = None) -> str:
    """Remove all Unicode whitespace on both sides (plain ``trim`` only removes spaces).

    Trimming with a list of characters is slow. ``unless`` is a condition under which the text is
    known to need none, by default that both ends are visible ASCII characters.
    """
    if unless is None:
        unless = f"ascii({c}) BETWEEN 33 AND 126 AND ascii(substring({c}, -1)) BETWEEN 33 AND 126"
    return f"if({unless}, {c}, btrim({c}, {quote(WHITESPACE)}))"


def all_match(columns: list[str], characters: str) -> str:
    """Whether all cells of a row consist of the given characters; nulls and empty cells do.

    One regular expression over the joined cells is much cheaper than one for each of them.
    """
    return f"concat_ws('', {', '.join(map(name, columns))}) RLIKE '^[{characters}]*$'"


def is_blank(c: str) -> str:
    """Null or empty; expects text that was already stripped."""
    return f"({c} IS NULL OR {c} = '')"


def null_tokens(c: str) -> str:
    """Turn the usual missing-value tokens of text files into null."""
    return f"CASE WHEN NOT {one_of(c, C.NA_TOKENS)} THEN {c} END"


def day_text(timestamp: str) -> str:
    """First ten characters of the raw timestamp text; anything shorter has no date."""
    prefix = f"substring({timestamp}, 1, 10)"
    return f"CASE WHEN length({prefix}) = 10 THEN {prefix} ELSE {quote(C.NO_DATE)} END"


def padded_id(prefix: str, number: str, width: int) -> str:
    """``prefix`` and the number, zero-padded to at least ``width`` digits."""
    digits = f"cast({number} AS string)"
    return f"{quote(prefix)} || lpad({digits}, greatest(length({digits}), {width}), '0')"


def flags_to_text(columns: list[str]) -> str:
    """Names of the columns holding '1', joined by a pipe; null when none is set."""
    named = ", ".join(f"CASE WHEN {name(c)} = '1' THEN {quote(c)} END" for c in columns)
    return f"nullif(concat_ws('|', {named}), '')"


def known_modes(c: str) -> str:
    """Pipe-separated text -> distinct known modes; the fallback mode when none is known.

    Tokens are compared as they are: no inner trim, case-sensitive.
    """
    tokens = f"split(coalesce({c}, ''), '[|]')"
    known = f"array_distinct(filter({tokens}, t -> {one_of('t', C.FAILURE_MODES)}))"
    return f"CASE WHEN size({known}) = 0 THEN array({quote(C.UNKNOWN_MODE)}) ELSE {known} END"


def listed_modes(c: str) -> str:
    """Text of mode sets ('HDF, PWF; OSF') -> distinct trimmed modes, empty parts dropped."""
    parts = f"transform(split(coalesce({c}, ''), '[;,]'), p -> {strip('p')})"
    return f"array_distinct(filter({parts}, p -> p <> ''))"


def true_false_text(c: str) -> str:
    """Boolean as ``t``/``f`` for bulk-load files."""
    return f"CASE WHEN {c} THEN 't' WHEN NOT {c} THEN 'f' END"
