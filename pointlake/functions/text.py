"""Column expressions for text: line splitting and Java-compatible tokenising.

All of these are built-in Spark SQL expressions (JVM side, no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line terminators of a Hadoop/Spark text reader.
LINE_BREAK_REGEX = r"\r\n|\n|\r"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_lines(text: Column | str) -> Column:
    r"""Split a text column into lines the way a text-file reader does.

    ``\n``, ``\r\n`` and ``\r`` end a line; blank lines are kept; a final line
    break does not start another line, so ``''`` gives no lines and ``'a\n'``
    gives ``['a']``. One regex split per text: the final terminator (anchored
    at the absolute end, ``\z``) is stripped first.
    """
    t = _col(text)
    body = F.regexp_replace(t, f"(?:{LINE_BREAK_REGEX})\\z", "")
    return F.when(t == F.lit(""), F.array().cast("array<string>")) \
            .otherwise(F.split(body, LINE_BREAK_REGEX, -1))


def java_space_split(line: Column | str) -> Column:
    """Tokens of ``line.split(" ")`` in Java.

    Java drops trailing empty tokens but keeps leading and inner ones; the empty
    string yields one empty token; a line of only blanks yields none. Case,
    punctuation and tabs stay in the tokens. ``rtrim`` removes U+0020 only.
    """
    v = _col(line)
    trimmed = F.rtrim(v)
    return (F.when(v == F.lit(""), F.array(F.lit("")))
             .when(trimmed == F.lit(""), F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, " ", -1)))


def java_comma_split(line: Column | str) -> Column:
    """Fields of ``line.split(",")`` in Java: trailing empty fields dropped."""
    v = _col(line)
    # the regex matches only lines that end with a comma or a line break
    ends = F.right(v, F.lit(1)).isin(",", "\n", "\r", "\x85", "\u2028", "\u2029")
    trimmed = F.when(ends, F.regexp_replace(v, ",+$", "")).otherwise(v)
    return (F.when(v == F.lit(""), F.array(F.lit("")))
             .when(trimmed == F.lit(""), F.array().cast("array<string>"))
             .otherwise(F.split(trimmed, ",", -1)))


def utf16_length(s: Column | str) -> Column:
    """Length in UTF-16 code units (Java ``String.length``)."""
    return (F.octet_length(F.encode(_col(s), "UTF-16BE")) / 2).cast("int")
