"""Shell-style table globs -> anchored regular expressions.

Semantics of the source tool's matcher: ``*`` is any run of characters
except ``/`` (dots included), ``?`` one such character, ``[...]`` a class
(``^`` negates, ``a-z`` ranges, ``\\`` escapes), ``\\c`` a literal ``c``.
A malformed pattern matches nothing.  The regex uses only syntax shared by
Java (``rlike``) and RE2.
"""

from __future__ import annotations

import re

NEVER = "a^"   # matches no string


def _lit(ch: str) -> str:
    return ch if ch.isalnum() or ch == "_" else "\\" + ch


def _member(pattern: str, j: int) -> tuple[str, int] | None:
    """A character of a bracket, possibly escaped, and what follows; None if malformed."""
    if j >= len(pattern) or pattern[j] in "-]":
        return None
    if pattern[j] == "\\":
        j += 1
        if j >= len(pattern):
            return None
    return pattern[j], j + 1


def _bracket(pattern: str, j: int) -> tuple[str, int] | None:
    """The regex of the bracket whose content begins at ``j``, and what follows it."""
    neg = pattern[j:j + 1] == "^"
    j += neg
    items, some = [], False
    while not (some and pattern[j:j + 1] == "]"):
        lo = hi = _member(pattern, j)
        if lo and pattern[lo[1]:lo[1] + 1] == "-":
            hi = _member(pattern, lo[1] + 1)
        if not lo or not hi:
            return None
        some, j = True, hi[1]
        if lo[0] <= hi[0]:      # a range the wrong way round holds nothing
            items.append(_lit(lo[0]) + "-" + _lit(hi[0]) if hi is not lo else _lit(lo[0]))
    if not items:
        return ("[\\s\\S]" if neg else NEVER), j + 1
    return "[" + ("^" if neg else "") + "".join(items) + "]", j + 1


def glob_to_regex(pattern: str) -> str:
    out, i = ["^"], 0
    while i < len(pattern):
        c = pattern[i]
        i += 1
        if c == "*":
            out.append("[^/]*")
        elif c == "?":
            out.append("[^/]")
        elif c == "\\":
            if i >= len(pattern):
                return NEVER
            out.append(_lit(pattern[i]))
            i += 1
        elif c == "[":
            found = _bracket(pattern, i)
            if not found or found[0] == NEVER:
                return NEVER
            out.append(found[0])
            i = found[1]
        else:
            out.append(_lit(c))
    return "".join([*out, "$"])


def is_glob(pattern: str) -> bool:
    """Exclusion lists treat a pattern as a glob only with ``*`` or ``?``."""
    return "*" in pattern or "?" in pattern


_SPECIAL = "*?[]\\"


def glob_key(pattern: str, gram: int = 8) -> tuple[str, str, str] | None:
    """``(kind, head, tail)``: literal text that a name must have to match; None if nothing matches.

    ``ends``: it begins with ``head`` and ends with ``tail`` (one may be empty), and is no shorter
    than both; ``whole``: it is ``head``; ``inside``: it has ``head`` (at most ``gram`` characters)
    somewhere; ``any``: there is no such text.
    """
    if not glob_to_regex(pattern) or glob_to_regex(pattern) == NEVER:
        return None
    places = [i for i, c in enumerate(pattern) if c in _SPECIAL]
    if not places:
        return "whole", pattern, ""
    head, tail = pattern[:places[0]], pattern[places[-1] + 1:]
    if head or tail:
        return "ends", head, tail
    pieces = re.split(r"\[(?:\\.|[^\]\\])*\]|\\.|[*?]", pattern)
    piece = max(pieces, key=len)[:gram]
    return ("inside", piece, "") if piece and not set(piece) & set(_SPECIAL) else ("any", "", "")


#: Characters that separate the words of a name, and how far a text that begins with one is looked at.
MARKS = "._-/: "
MARK_GRAM = 16


def glob_keys(pattern: str) -> list[tuple[str, str, str]]:
    """Every ``(kind, head, tail)`` that a pattern may be found by; none if nothing matches.

    Besides ``glob_key``: ``mark``: a name has ``head``, which begins with one of ``MARKS``, somewhere.
    """
    first = glob_key(pattern)
    if first is None or first[0] == "whole":
        return [first] if first else []
    pieces = [x for x in re.split(r"\[(?:\\.|[^\]\\])*\]|\\.|[*?]", pattern) if not set(x) & set(_SPECIAL)]
    marks = {x[i:i + MARK_GRAM] for x in pieces for i, c in enumerate(x) if c in MARKS}
    return [first, *(("mark", x, "") for x in sorted(marks))]
