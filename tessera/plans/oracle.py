"""DuckDB SQL for the correctness oracle.

The SQL is generated from the same rule tables as the Spark code
(:mod:`tessera.functions.terms`), through the regex dialect helpers, so a
rule edited in one place changes both sides.  Only view definitions and
SQL text live here; nothing in this module runs Spark.
"""

from __future__ import annotations

import re

from ..functions import terms
from ..functions.regex import NOT_WS, WS, re2, sql_str
from ..functions.text import (HTML_C1, HTML_ENTITIES, HTML_LEGACY, HTML_STEPS, LEGACY_RE, NAMED_RE,
                              NUMERIC_RE, SLANG_PAIRS, SLANG_WORDS, WORD_RUN, WORD_WITH_APOSTROPHES)
from ..sources.tables import NOISY_TAILS

S = sql_str


def sql_list(items) -> str:
    return "[" + ", ".join(S(x) for x in items) + "]"


def sql_map(d: dict) -> str:
    return "MAP {" + ", ".join(f"{S(k)}: {S(v)}" for k, v in d.items()) + "}"


def r6(x: str) -> str:
    return f"round({x}, 6)"


# ------------------------------------------------------------ expressions

def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {S(WS + '+')}), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {S(NOT_WS + '+')})) AS INTEGER)"


def chain(x: str, rules, flags: str = "g") -> str:
    for pat, rep in rules:
        x = f"regexp_replace({x}, {S(re2(pat))}, {S(rep)}, '{flags}')"
    return x


# RE2 knows only ASCII word borders.  Rules with borders run on text in which every word
# run stands between two marks; a rule's borders, and the borders around its inner white
# space, become the marks, and the marks are taken out again after the rule.
WORD_CHARS = r"\p{L}\p{M}\p{N}_"
BEGIN, END = r"\x01", r"\x02"


def marked_pattern(pat: str) -> str:
    out = pat
    out = re.sub(r"^\\b", lambda _: BEGIN, out)
    out = re.sub(r"\\b$", lambda _: END, out)
    # patterns that end inside a word run, or in an optional one, spelled out
    out = out.replace(r"\s+\w+(?:\s+locale\s+\w+)?", rf"{END}\s+{BEGIN}\w+{END}(?:\s+{BEGIN}locale{END}\s+{BEGIN}\w+)?")
    out = out.replace(r"\s+\w{2}(?:[-_]\w{2})?", rf"{END}\s+{BEGIN}\w{{2}}(?:(?:_|{END}-{BEGIN})\w{{2}})?")
    out = out.replace(r"\s+application\s+[\w/]+\s+(?:xml)?",
                      rf"{END}\s+{BEGIN}application{END}\s+[\w/\x01\x02]+\s+(?:{BEGIN}xml)?")
    if BEGIN not in out[4:]:
        out = re.sub(r"\\s\+\\w\*$", lambda _: rf"{END}\s+(?:{BEGIN}\w+)?", out)
    if rf"{END}\s+" not in out:
        out = out.replace(r"\s+[^\s]*", rf"{END}\s+[^\s]*") if r"\s+[^\s]*" in out else out.replace(r"\s+", rf"{END}\s+{BEGIN}")
    return out.replace(r"[\w/", rf"[{WORD_CHARS}/").replace(r"\w", f"[{WORD_CHARS}]")


def bordered(x: str, rules, flags: str = "g") -> str:
    """Ordered rules with Unicode word borders."""
    for pat, rep in rules:
        marks = f"regexp_replace({x}, {S(f'([{WORD_CHARS}]+)')}, chr(1) || {S(chr(92) + '1')} || chr(2), 'g')"
        x = (f"regexp_replace(regexp_replace({marks}, {S(re2(marked_pattern(pat)))}, {S(rep)}, '{flags}'), "
             f"'[\\x01\\x02]', '', 'g')")
    return x


def map_words(x: str, pattern: str, body: str) -> str:
    """Each match ``w`` of ``pattern`` replaced by ``body``; ``x`` must be a column."""
    rx = S(pattern.replace(r"\w", f"[{WORD_CHARS}]"))
    found = f"list_transform(regexp_extract_all({x}, {rx}), lambda w: {body})"
    return (f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, {rx}), {found}), "
            f"lambda z: z[1] || coalesce(z[2], '')), '')")


def remove_urls(x: str) -> str:
    plain, last = terms.URL_PATTERNS[:2], terms.URL_PATTERNS[2:]
    return bordered(chain(x, [(p, "") for p in plain]), [(p, "") for p in last])


def remove_blocks(x: str) -> str:
    return bordered(x, [(p, " ") for p in terms.TECHNICAL_BLOCKS], "gi")


def fuse_bigrams(x: str) -> str:
    return bordered(x, terms.BIGRAMS, "gi")


def fix_apostrophes(x: str) -> str:
    return bordered(f"lower({x})", terms.APOSTROPHE_FIXES)


def slang_pairs(x: str) -> str:
    return bordered(f"lower({x})", SLANG_PAIRS)


def slang_words(x: str) -> str:
    """``x`` must be a column that holds :func:`slang_pairs`."""
    return map_words(x, WORD_RUN, f"coalesce({sql_map(SLANG_WORDS)}[w], w)")


def expand_contractions(x: str) -> str:
    """``x`` must be a column."""
    m = sql_map(terms.CONTRACTIONS)

    def cased(core: str) -> str:
        rep = f"{m}[lower({core})]"
        return (f"CASE WHEN left({core}, 1) <> lower(left({core}, 1)) "
                f"THEN upper(left({rep}, 1)) || substr({rep}, 2) ELSE {rep} END")

    bare = "substr(w, 2)"
    return map_words(x, WORD_WITH_APOSTROPHES,
                     f"coalesce({cased('w')}, CASE WHEN starts_with(w, chr(39)) THEN chr(39) || ({cased(bare)}) END, w)")


def href_token(x: str) -> str:
    return bordered(x, [(terms.HREF_TOKEN, "")], "gi")


def html_steps(x: str) -> str:
    for pat, rep in HTML_STEPS:
        x = f"regexp_replace({x}, {S(pat)}, {S(rep)}, 'g')"
    return x


def _code_point(n: str) -> str:
    old = "MAP {" + ", ".join(f"{k}: {S(v)}" for k, v in HTML_C1.items()) + "}"
    return (f"CASE WHEN {n} BETWEEN 128 AND 159 THEN coalesce({old}[CAST({n} AS INTEGER)], chr(CAST({n} AS INTEGER))) "
            f"WHEN {n} > 0 AND {n} <= 1114111 AND NOT ({n} BETWEEN 55296 AND 57343) "
            f"THEN chr(CAST({n} AS INTEGER)) ELSE chr(65533) END")


def decode_entities_from_parts(parts: str) -> str:
    """``parts`` must be a column (string_split(x, '&')) of a prior stage."""
    ref = f"regexp_extract(p, {S(NUMERIC_RE)}, 1)"
    is_hex = f"lower(left({ref}, 2)) = '#x'"
    digits = f"ltrim(CASE WHEN {is_hex} THEN substr({ref}, 3) ELSE substr({ref}, 2) END, '0')"
    number = (f"coalesce(CASE WHEN length({digits}) > 8 THEN -1 WHEN {is_hex} THEN TRY_CAST('0x' || {digits} AS BIGINT) "
              f"ELSE TRY_CAST({digits} AS BIGINT) END, 0)")
    name, old = f"regexp_extract(p, {S(NAMED_RE)}, 1)", f"regexp_extract(p, {S(LEGACY_RE)}, 1)"
    named, legacy = f"{sql_map(HTML_ENTITIES)}[{name}]", f"{sql_map(HTML_LEGACY)}[{old}]"
    piece = (f"CASE WHEN {ref} <> '' THEN {_code_point(number)} || regexp_replace(substr(p, length({ref}) + 1), '^;', '') "
             f"WHEN {named} IS NOT NULL THEN {named} || substr(p, length({name}) + 2) "
             f"WHEN {old} <> '' THEN {legacy} || substr(p, length({old}) + 1) "
             f"ELSE '&' || p END")
    return (f"CASE WHEN len({parts}) <= 1 THEN array_to_string({parts}, '&') ELSE {parts}[1] || "
            f"array_to_string(list_transform({parts}[2:], lambda p: {piece}), '') END")


def strip_word(x: str) -> str:
    chars = "".join("\\" + c if c in ".?" else c for c in terms.WORD_STRIP_CHARS)
    return f"regexp_replace(lower({x}), {S(f'^[{chars}]+|[{chars}]+$')}, '', 'g')"


# --------------------------------------------------------------- views

def views() -> str:
    """CTE list defining the derived fixture views (FIXTURES.md §4)."""
    models = sql_list(terms.FIXTURE_MODELS)

    def shift(k):
        return f"CASE WHEN vec_id % {k} = 0 THEN (label + 1) % 10 ELSE label END"

    classes = ", ".join(f"({k}, {S(v)})" for k, v in sorted(terms.CLASSES.items()))
    return f"""
classes AS (SELECT * FROM (VALUES {classes}) t(label, name)),
noisy AS (
  SELECT id, CASE WHEN tail = '' THEN text ELSE text || ' ' || tail END AS text, label
  FROM (SELECT doc_id AS id, CAST(doc_id % 6 AS INTEGER) AS label, text,
               {sql_list(NOISY_TAILS)}[doc_id % {len(NOISY_TAILS)} + 1] AS tail
        FROM documents)),
preds_base AS (
  SELECT vec_id, label, list_transform(range(0, 10), lambda k: list_sum(list_filter(x, lambda v, i: (i - 1) % 10 = k)))
           AS student,
         list_transform(range(0, 10), lambda k: list_sum(list_filter(x, lambda v, i: (i + 4) % 10 = k))) AS teacher
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)),
preds AS (
  SELECT vec_id AS id, m.model, label AS y_true,
         CAST(CASE m.model
           WHEN 'alpha-small' THEN list_position(student, list_max(student)) - 1
           WHEN 'alpha-large' THEN list_position(teacher, list_max(teacher)) - 1
           WHEN 'beta-base' THEN {shift(5)}
           WHEN 'Full' THEN {shift(11)}
           WHEN 'step0' THEN {shift(7)}
           ELSE {shift(3)} END AS INTEGER) AS y_pred,
         student, teacher
  FROM preds_base, (SELECT unnest({models}) AS model) m),
training_log AS (
  SELECT CAST(user_id AS VARCHAR) AS model,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch,
         avg(value) AS acc
  FROM events GROUP BY 1, 2),
latency AS (
  SELECT {models}[event_id % 6 + 1] AS model, value / 1000 AS sec FROM events),
curated AS (
  SELECT d.doc_id, d.text, l.quality AS label, {word_count('d.text')} AS length
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""


def with_views(body: str) -> str:
    return "WITH " + views().strip() + ",\n" + body.strip().removeprefix("WITH").strip() \
        if body.strip().upper().startswith("WITH") else "WITH " + views().strip() + "\n" + body
