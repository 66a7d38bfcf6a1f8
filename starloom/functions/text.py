"""Line-level parsing of a code dictionary (SAS ``proc format`` text).

A dictionary is a sequence of blocks::

    value <fmt>
       <code> = '<label>'
       ...
    ;

with ``/* ... */`` comments between blocks. Codes may be bare numbers or
quoted strings; labels use ``''`` for a quote. Everything here is a Column
expression evaluated per line; section membership is resolved in
:mod:`starloom.sources.labels`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER = r"(?i)^\s*value\s+(\$?\w+)"
ENTRY = r"^\s*'?([^'=]*?)'?\s*=\s*'(.*)'"
CLOSES = r";\s*$"
# Quoted text (which may hold comment marks) and comments, the last one perhaps still open at
# the end of the line; and the former two only. What a quote or comment holds is not looked at.
QUOTED = r"'[^']*(?:''[^']*)*'"
QUOTED_OR_COMMENT = rf"(?s)({QUOTED})|/\*.*?\*/|/\*.*$"
QUOTED_OR_CLOSED = rf"(?s){QUOTED}|/\*.*?\*/"
# City and state of a port label: the last two capitals at the end (after a
# comma or a blank), optionally followed by a bracketed or '#' suffix.
PORT_SPLIT = r"^(.*?)\s*(?:,\s*|\s+)([A-Z]{2})(?:\s*[(#].*)?$"


def without_comments(line: Column) -> Column:
    """The line, which begins outside comments, without comments and byte-order mark."""
    return F.regexp_replace(F.regexp_replace(line, "^\ufeff", ""), QUOTED_OR_COMMENT, "$1")


def leaves_comment_open(line: Column) -> Column:
    """True for a line, beginning outside comments, whose last comment goes on."""
    return F.contains(F.regexp_replace(line, QUOTED_OR_CLOSED, " "), F.lit("/*"))


def header_fmt(line: Column) -> Column:
    """Format name of a ``value <fmt>`` header line, else NULL."""
    return F.nullif(F.regexp_extract(without_comments(line), HEADER, 1), F.lit(""))


def closes_block(line: Column) -> Column:
    """True for a line ending a block with ``;`` (outside comments)."""
    return without_comments(line).rlike(CLOSES)


def is_entry(line: Column) -> Column:
    """True for a ``code = 'label'`` line."""
    return without_comments(line).rlike(ENTRY)


def entry_code(line: Column) -> Column:
    """Code of an entry line, quotes and surrounding blanks removed."""
    return F.trim(F.regexp_extract(without_comments(line), ENTRY, 1))


def entry_label(line: Column) -> Column:
    """Label text with ``''`` unescaped and trailing blanks removed."""
    raw = F.regexp_extract(without_comments(line), ENTRY, 2)
    return F.rtrim(F.regexp_replace(raw, "''", "'"))


def port_city_candidate(label: Column) -> Column:
    """City part of a port label if it ends in a two-capital state token."""
    return F.nullif(F.trim(F.regexp_extract(label, PORT_SPLIT, 1)), F.lit(""))


def port_state_candidate(label: Column) -> Column:
    """Trailing two-capital state token of a port label, else NULL."""
    return F.nullif(F.regexp_extract(label, PORT_SPLIT, 2), F.lit(""))
