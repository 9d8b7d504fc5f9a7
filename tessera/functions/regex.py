"""Regex dialect helpers.

Rules are written once in Python `re` syntax (see :mod:`terms`).  Spark runs
Java regexes, the DuckDB oracle runs RE2.  The differences that matter:

* Python's ``\\s`` (str patterns) is Unicode whitespace plus ``\\x1c``-``\\x1f``;
  Java's ``(?U)\\s`` lacks ``\\x1c``-``\\x1f``; RE2's ``\\s`` is ASCII without
  ``\\x0b``.  We spell the class out, identically, in both dialects.
* ``\\b``/``\\w`` are Unicode in Python; Java needs ``(?U)``; RE2 is ASCII only,
  so the oracle is only compared on ASCII text.
* Python ``.`` excludes only ``\\n``; Java's also excludes ``\\r`` and friends,
  so rules use ``[^\\n]`` where it matters.
"""

from __future__ import annotations

# Python's str.isspace() set, spelled so that Java and RE2 read it alike.
_WS_BODY = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{_WS_BODY}]"
NOT_WS = f"[^{_WS_BODY}]"


def _spell_whitespace(p: str) -> str:
    p = p.replace(r"[^\s]", NOT_WS)
    return p.replace(r"\s", WS)


def java(p: str, ignore_case: bool = False) -> str:
    """Python-syntax pattern -> Java pattern with Python's Unicode semantics."""
    flags = "(?iU)" if ignore_case else "(?U)"
    return flags + _spell_whitespace(p)


def java_repl(r: str) -> str:
    """Python replacement (``\\1``) -> Java replacement (``$1``)."""
    out, i = [], 0
    while i < len(r):
        if r[i] == "\\" and i + 1 < len(r) and r[i + 1].isdigit():
            out.append("$" + r[i + 1])
            i += 2
            continue
        if r[i] == "$":
            out.append("\\$")
        else:
            out.append(r[i])
        i += 1
    return "".join(out)


def re2(p: str) -> str:
    """Python-syntax pattern -> RE2 (DuckDB).  ASCII \\b/\\w semantics."""
    return _spell_whitespace(p)


def sql_str(s: str) -> str:
    """Quote a Python string as a standard SQL literal (no backslash escapes)."""
    return "'" + s.replace("'", "''") + "'"
