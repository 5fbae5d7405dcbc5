"""Text cleaning and the gates on cleaned text, as expressions.

White space and line breaks are those of Python's ``str.isspace`` and ``str.splitlines``, written out, as Java's classes
differ from them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters for which str.isspace holds, without and with the line feed.
_SPACE_NO_LF = r"\t\u000b-\r\u001c- \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"\n" + _SPACE_NO_LF
#: What str.splitlines splits at.
LINE_BREAK = r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"


#: The same characters, as text.
_SPACES = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def clean(text: Column) -> Column:
    """No byte order marks, line feeds only, no trailing blanks, at most one empty line in a row, stripped; what most
    texts do not have is looked for before it is replaced."""
    bare = F.when(text.startswith("\ufeff"), F.ltrim(text, F.lit("\ufeff"))).otherwise(text)
    feeds = F.transform(F.array(bare), lambda t: F.when(t.contains("\r"), F.regexp_replace(t, r"\r\n?", "\n")).otherwise(t))
    # a run of blanks is tried at its first character only and never given back, so long runs inside a line cost their length
    trimmed = F.transform(feeds, lambda t: F.regexp_replace(t, rf"(?<![{_SPACE_NO_LF}])[{_SPACE_NO_LF}]++(?=\n|\z)", ""))
    return F.transform(trimmed, lambda t: strip(F.when(t.contains("\n\n\n"), F.regexp_replace(t, r"\n{3,}", "\n\n")).otherwise(t)))[0]


def is_binary(text: Column) -> Column:
    return F.instr(text, "\x00") > 0


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def code_lines(text: Column) -> Column:
    """The lines that have more than white space, stripped."""
    return F.transform(F.filter(lines(text), lambda x: x.rlike(rf"[^{SPACE}]")), strip)


def non_empty_lines(text: Column) -> Column:
    return F.size(F.filter(lines(text), lambda x: x.rlike(rf"[^{SPACE}]"))).cast("long")


def has_marker(text: Column, markers: tuple[str, ...], first_lines: int = 80) -> Column:
    """Whether the first lines, in lower case, have one of the (lower-case) markers."""
    head = F.lower(F.array_join(F.slice(lines(text), 1, first_lines), "\n"))
    found = F.lit(False)
    for marker in markers:
        found = found | head.contains(marker)
    return found


def repeated_ratio(stripped: Column) -> Column:
    """1 - distinct / all of an array of lines; 0 without any."""
    return F.when(F.size(stripped) == 0, F.lit(0.0)).otherwise(F.lit(1.0) - F.size(F.array_distinct(stripped)) / F.size(stripped))


def repeated_line_ratio(text: Column) -> Column:
    """``repeated_ratio`` of the stripped non-empty lines."""
    return F.transform(F.array(code_lines(text)), repeated_ratio)[0]
