"""RE2 patterns on the JVM.

The warehouse dialect (RE2) and ``java.util.regex`` agree on alternation and laziness but
differ in three constructs used here:

=========  =====================================  ==================================
construct  RE2                                    Java 17
=========  =====================================  ==================================
``\\b``     boundary of ASCII word characters      accented letters are word characters
``$``      end of text                            also before a final newline
``\\s``     ``[\\t\\n\\f\\r ]``                        also vertical tab
``(?i)``   also U+017F as s and U+212A as k       ASCII letters only
=========  =====================================  ==================================

:func:`re2` rewrites these so that a pattern means the same on both.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACES = r"\t\n\f\r "
# Letters that fold to an ASCII letter under (?i).
_FOLDS = {"s": "\u017f", "k": "\u212a"}


def re2(pattern: str) -> str:
    """Java spelling of an RE2 pattern.

    Every ``\\b`` must sit beside an ASCII word character, as all of ours do.  It opens a
    word at the start of the pattern or of an alternative and closes one anywhere else.
    """
    out: list[str] = []
    in_class = False
    opening = True
    folded = pattern.startswith("(?i)")
    i = 0
    while i < len(pattern):
        token = pattern[i : i + 2] if pattern[i] == "\\" else pattern[i]
        if pattern.startswith("(?i)", i):
            out.append("(?i)")
            i += 4
            continue
        if token == r"\s":
            out.append(_SPACES if in_class else f"[{_SPACES}]")
        elif token == r"\b" and not in_class:
            out.append(r"(?<![A-Za-z0-9_])" if opening else r"(?![A-Za-z0-9_])")
        elif token == "$" and not in_class:
            out.append(r"\z")
        elif folded and token.lower() in _FOLDS:
            more = token + _FOLDS[token.lower()]
            out.append(more if in_class else f"[{more}]")
        elif folded and in_class and pattern[i : i + 3] in ("A-Z", "a-z"):
            out.append(pattern[i : i + 3] + "".join(_FOLDS.values()))
            i += 3
            continue
        else:
            out.append(token)
            in_class = (in_class or token == "[") and token != "]"
        opening = token == "|" and not in_class
        i += len(token)
    return "".join(out)


def phrases(words: tuple[str, ...]) -> str:
    """RE2 pattern for any of the given plain phrases as whole words."""
    return r"\b(" + "|".join(words) + r")\b"


def has_phrase(text: Column, words: tuple[str, ...]) -> Column:
    """True where any phrase occurs as whole words; NULL for NULL text.

    The plain substring test on UTF-8 bytes comes first: it rules out most texts for a
    fraction of the cost of the pattern, which then settles the word boundaries.
    """
    return contains_any(text, words) & text.rlike(re2(phrases(words)))


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    """True where any plain word occurs in the text; NULL for NULL text.

    Same result as a regex alternation of literals, without leaving UTF-8 bytes.
    """
    return reduce(or_, (text.contains(w) for w in words))


def fold_ascii_letters(text: Column) -> Column:
    """Lower-case text so that literals compare as under RE2's ``(?i)``."""
    return F.lower(F.replace(text, F.lit("\u017f"), F.lit("s")))


def first_group(text: Column, pattern: str) -> Column:
    """Group 1 of the first RE2 match, or ``''`` where nothing matches."""
    return F.regexp_extract(text, re2(pattern), 1)
