"""Text-cleaning rules as native Spark column expressions.

Two shapes are offered:

* Column -> Column functions for rules whose input is referenced once
  (URL removal, metadata blocks, apostrophes, slang, contractions, repeated
  characters, word count, markup removal).
* Rules whose intermediate values are used several times (the context
  window C5-C8, entity decoding, contractions) bind each intermediate
  once with :func:`let`.  Staged projections are not enough: pushing a
  filter through them (e.g. ``filter("is_cleaned")``) substitutes every
  alias into every use, and the expression tree grows multiplicatively.

Nothing here leaves the JVM: no Python UDF is involved, every rule is a
map-only projection (no shuffle), and each row's whole text is processed.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import terms
from .regex import WS, java, java_repl

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``.

    A lambda over a one-element array binds its argument, so no optimizer
    rewrite (alias substitution, predicate pushdown) can copy ``value``.
    """
    return F.get(F.transform(F.array(value), body), 0)


# ---------------------------------------------------------------- words

def words(c: ColumnOrName) -> Column:
    """Python ``str.split()``: whitespace runs, no empty pieces."""
    return F.array_remove(F.split(_c(c), WS + "+"), "")


def word_count(c: ColumnOrName) -> Column:
    """``len(text.split())``: the number of runs of anything but white space.

    Splitting at the rare white space tests far fewer classes of characters than matching
    the words themselves does."""
    return F.array_size(words(c))


# ---------------------------------------------------------- simple rule chains

def _chain(c: Column, rules, ignore_case: bool = False) -> Column:
    for pat, rep in rules:
        c = F.regexp_replace(c, java(pat, ignore_case), java_repl(rep))
    return c


def _guarded_chain(c: Column, rules, needles, ignore_case: bool = False) -> Column:
    """Ordered regex rules, each skipped when its text cannot match.

    ``needles[i]`` lists substrings one of which every match of rule i
    contains (None: always run).  A substring test is far cheaper than a
    regex pass; each intermediate is bound once (:func:`let`).

    Case-sensitive rules test the current value.  Case-insensitive rules
    test one lower-cased copy of the chain's *input*: their replacements
    only insert spaces or join a bigram with '_', which cannot create a
    needle that was not already there.
    """
    def run(src: Column, low: Column | None) -> Column:
        v = src
        for (pat, rep), need in zip(rules, needles):
            rx, rp = java(pat, ignore_case), java_repl(rep)
            if not need:
                v = F.regexp_replace(v, rx, rp)
            elif ignore_case:
                v = let(v, _guard_step(rx, rp, need, low))
            else:
                v = let(v, _guard_step(rx, rp, need, None))
        return v

    if ignore_case:
        return let(c, lambda src: let(F.lower(src), lambda low: run(src, low)))
    return run(c, None)


def _any_contains(hay: Column, need: list[str]) -> Column:
    hit = None
    for n in need:
        t = hay.contains(n)
        hit = t if hit is None else hit | t
    return hit


def _guard_step(rx: str, rp: str, need: list[str], hay: Column | None):
    def step(v: Column) -> Column:
        h = v if hay is None else hay
        return F.when(_any_contains(h, need), F.regexp_replace(v, rx, rp)).otherwise(v)
    return step


def remove_urls(c: ColumnOrName) -> Column:
    """Three URL shapes removed in order, case-sensitive."""
    return _guarded_chain(_c(c), [(p, "") for p in terms.URL_PATTERNS],
                          [["http"], ["www."], ["http"]])


def _block_needles():
    out = []
    for p in terms.TECHNICAL_BLOCKS:
        m = re.match(r"\\b([a-z]+)", p)
        out.append([m.group(1)] if m else None)
    return out


def remove_blocks(c: ColumnOrName) -> Column:
    """Metadata blocks -> ' ', case-insensitive, in order."""
    return _guarded_chain(_c(c), [(p, " ") for p in terms.TECHNICAL_BLOCKS], _block_needles(),
                          ignore_case=True)


def fuse_bigrams(c: ColumnOrName) -> Column:
    """C4: 'a href' -> 'a_href' etc., case-insensitive."""
    return _guarded_chain(_c(c), terms.BIGRAMS, [["href"], ["rel"], ["href"]], ignore_case=True)


#: The torn-off ending that each rule of C9 needs.  No rule makes a new one.
TORN_OFF = [re.search(r"\\s\+(\w+)\\b$", p).group(1) for p, _ in terms.APOSTROPHE_FIXES]


def fix_apostrophes(c: ColumnOrName) -> Column:
    """Lower-case, then the ordered missing-apostrophe rules whose ending stands in the text."""
    def step(there: Column, rx: str, rp: str) -> Callable[[Column], Column]:
        return lambda x: F.when(there, F.regexp_replace(x, rx, rp)).otherwise(x)

    def rules(v: Column) -> Callable[[Column], Column]:
        def run(seen: Column) -> Column:
            out = v
            for (pat, rep), ending in zip(terms.APOSTROPHE_FIXES, TORN_OFF, strict=True):
                out = let(out, step(F.array_contains(seen, ending), java(no_recursion(pat)), java_repl(rep)))
            return F.when(F.size(seen) > 0, out).otherwise(v)
        return run

    found = java(rf"\s({'|'.join(TORN_OFF)})\b")
    return let(F.lower(_c(c)), lambda v: let(F.regexp_extract_all(v, F.lit(found), F.lit(1)), rules(v)))


#: A word run, and a word with inner apostrophes, with Python's Unicode word characters.
WORD_RUN = r"\w+"
WORD_WITH_APOSTROPHES = r"'?\w+(?:'\w+)*"


def no_recursion(pattern: str) -> str:
    """``pattern`` with possessive loops, for Java, whose loops over a group with alternatives
    or of several parts use a stack frame for each turn.

    Only for patterns in which giving a turn back cannot help: what follows a loop must not
    start like what the loop takes."""
    return re.sub(r"(?<=[\])\w])([*+])(?![*+?])", r"\1+", pattern)


def any_of(strings: Sequence[str]) -> str:
    """A pattern of all ``strings`` that tells them apart letter by letter."""
    by_first: dict[str, list[str]] = {}
    for x in sorted(set(strings)):
        by_first.setdefault(x[:1], []).append(x[1:])
    end = by_first.pop("", None)
    parts = [re.escape(k) + any_of(rest) for k, rest in by_first.items()]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)})" + ("?" if end else "") if len(parts) > 1 or end else parts[0]


def _map_words(c: Column, pattern: str, one: Callable[[Column], Column], keys: Sequence[str] | None = None) -> Column:
    """Replace each match of ``pattern`` by ``one(match)``; what stands between stays.

    With ``keys``, ``one`` changes only matches that are one of them in lower case, perhaps after an
    apostrophe; texts without such a match are not put together anew."""
    def body(t: Column) -> Column:
        between = F.split(t, java(pattern), -1)
        found = F.transform(F.regexp_extract_all(t, F.lit(java(pattern)), F.lit(0)), one)
        new = F.array_join(F.zip_with(between, found, lambda s, w: F.concat(s, F.coalesce(w, F.lit("")))), "")
        if keys is None:
            return new
        low = F.regexp_extract_all(F.lower(t), F.lit(java(pattern)), F.lit(0))
        held = F.split(F.lit("\x01".join([*keys, *(f"'{k}" for k in keys)])), "\x01")
        return F.when(F.arrays_overlap(low, held), new).otherwise(t)
    return let(c, body)


def _slang_words() -> dict[str, str]:
    """The slang rules whose key is one word.  No phrase contains a key as a whole
    word, so one pass over the words equals the ordered rules."""
    return {pat[2:-2]: phrase for pat, phrase in terms.SLANG if re.fullmatch(r"\\b\w+\\b", pat)}


#: Slang rules of several words, which go first (their parts are keys as well).
SLANG_PAIRS = tuple((pat, phrase) for pat, phrase in terms.SLANG if not re.fullmatch(r"\\b\w+\\b", pat))
SLANG_WORDS = _slang_words()


def normalize_slang(c: ColumnOrName) -> Column:
    """Lower-case, then the slang table: pairs first, then one pass over the words
    with a hash-set test."""
    table = _literal_map(SLANG_WORDS)
    return _map_words(_chain(F.lower(_c(c)), SLANG_PAIRS), WORD_RUN, lambda w: F.when(
        w.isin(*SLANG_WORDS), F.try_element_at(table, w)).otherwise(w), list(SLANG_WORDS))


def repeated_chars(c: ColumnOrName) -> Column:
    """Any run of >= 3 equal characters (not newline) -> 2."""
    return F.regexp_replace(_c(c), r"([^\n])\1{2,}", "$1$1")


def _literal_map(d: dict) -> Column:
    """A map of strings, or of numbers to strings, as one constant; thousands of literals take seconds to plan."""
    text = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in d.items())), F.lit("\x01"), F.lit("\x02"))
    return text if all(isinstance(k, str) for k in d) else text.cast("map<int,string>")



def expand_contractions(c: ColumnOrName, mapping: Column | None = None) -> Column:
    """C11: dictionary expansion of every word (a run of word characters with inner
    apostrophes), whatever separates the words; a capitalised word keeps its capital."""
    if mapping is None:
        m, keys = _literal_map(terms.CONTRACTIONS), list(terms.CONTRACTIONS)
    else:
        m, keys = mapping, None

    def lookup(key: Column) -> Column:
        # Hash-set test first; the map is probed only for real keys.
        found = F.try_element_at(m, key)
        return found if keys is None else F.when(key.isin(*keys), found)

    def one(word: Column) -> Column:
        def cased(core: Column) -> Callable[[Column], Column]:
            return lambda rep: F.when(core.substr(1, 1) != F.lower(core.substr(1, 1)), F.concat(
                F.upper(rep.substr(1, 1)), rep.substr(F.lit(2), F.length(rep)))).otherwise(rep)

        bare = F.substring(word, 2, 1 << 30)
        return F.coalesce(
            let(lookup(F.lower(word)), cased(word)),
            F.when(word.startswith("'"), F.concat(F.lit("'"), let(lookup(F.lower(bare)), cased(bare)))), word)

    return _map_words(_c(c), no_recursion(WORD_WITH_APOSTROPHES), one, keys)


def fix_constructions(c: ColumnOrName) -> Column:
    """Apostrophe repair then contraction expansion."""
    return expand_contractions(fix_apostrophes(c))


# ------------------------------------------------------------ markup

# Named character references of the HTML standard, from the standard library's table:
# names that end in ";", and the older ones that are also read without it.
HTML_ENTITIES = {k[:-1]: v for k, v in html5.items() if k.endswith(";")}
HTML_LEGACY = {k: v for k, v in html5.items() if not k.endswith(";")}
# Numeric references 128 to 159 stand for Windows-1252 characters.
HTML_C1 = {n: bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}

#: A tag ends at the first ">" outside quotes; where a quote stays open, at the first ">" of all.
TAG = r"</?[A-Za-z](?:(?:[^>\"']+|\"[^\"]*\"|'[^']*')*>|[^>]*>)"

# Regex chain of the markup rule, in order (pattern, replacement); written
# in a syntax Java and RE2 both accept.
HTML_STEPS = (
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", " "),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", " "),
    (r"(?is)<template\b[^>]*>.*?</template\s*>", " "),
    (r"<![^>]*>", " "),
    (r"<\?[^>]*>", " "),
    (TAG, " "),
)
#: How every match of a step ends.
HTML_ENDS = ("-->", r"</script\s*>", r"</style\s*>", r"</template\s*>", ">", ">", ">")
NUMERIC_RE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+)"
NAMED_RE = r"^([A-Za-z][A-Za-z0-9]*);"
LEGACY_RE = "^(" + "|".join(sorted(HTML_LEGACY, key=lambda k: (-len(k), k))) + ")"


def _code_point(n: Column) -> Column:
    """Integer code point -> one-character string (U+FFFD if there is none)."""
    valid = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    ch = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    old = F.try_element_at(_literal_map(HTML_C1), n.cast("int"))
    return F.when(n.between(128, 159), F.coalesce(old, ch)).when(valid, ch).otherwise(F.lit("�"))


def decode_entities(c: ColumnOrName) -> Column:
    """Decode ``&name;``, the older names without ``;``, ``&#NNN`` and ``&#xHH`` references."""
    named_map, legacy_map = _literal_map(HTML_ENTITIES), _literal_map(HTML_LEGACY)

    def after(p: Column, ref: Column) -> Column:
        """What follows a reference, without its semicolon."""
        return F.regexp_replace(F.substring(p, F.length(ref) + 1, 1 << 30), "^;", "")

    def numeric(p: Column) -> Callable[[Column], Column]:
        def of(ref: Column) -> Column:
            # more than 8 digits are no character
            digits = F.ltrim(F.when(F.lower(ref.substr(1, 2)) == "#x", F.substring(ref, 3, 1 << 30)).otherwise(
                F.substring(ref, 2, 1 << 30)), F.lit("0"))
            number = F.when(F.length(digits) > 8, F.lit(-1).cast("bigint")).when(
                F.lower(ref.substr(1, 2)) == "#x", F.conv(digits, 16, 10).try_cast("bigint")).otherwise(
                digits.try_cast("bigint"))
            return F.concat(let(F.coalesce(number, F.lit(0).cast("bigint")), _code_point), after(p, ref))
        return of

    def word(p: Column) -> Column:
        name, old = F.regexp_extract(p, NAMED_RE, 1), F.regexp_extract(p, LEGACY_RE, 1)
        return let(F.try_element_at(named_map, name), lambda v: F.when(
            v.isNotNull(), F.concat(v, after(p, name))).otherwise(let(old, lambda o: F.when(
                o != "", F.concat(F.try_element_at(legacy_map, o), F.substring(p, F.length(o) + 1, 1 << 30))
            ).otherwise(F.concat(F.lit("&"), p)))))

    def piece(p: Column) -> Column:
        return F.when(p.rlike(NUMERIC_RE), let(F.regexp_extract(p, NUMERIC_RE, 1), numeric(p))).when(
            p.rlike("^[A-Za-z]"), word(p)).otherwise(F.concat(F.lit("&"), p))

    def body(parts: Column) -> Column:
        tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
        return F.when(F.size(parts) <= 1, F.array_join(parts, "&")).otherwise(
            F.concat(F.get(parts, 0), F.array_join(F.transform(tail, piece), "")))

    return let(F.split(_c(c), "&"), body)


def html_to_text(c: ColumnOrName) -> Column:
    """Drop comments, declarations, script/style/template bodies; tags -> ' ';
    decode character references.  Text nodes end up separated by spaces.

    Texts without '<' skip the markup passes, texts without '&' the
    entity decoding (both are exact: no rule can match otherwise).  Each
    pass reads up to the last end of its construct only: what follows
    cannot match, and openers without an end would each be read on to the
    end of the text.
    """
    def step(pat: str, rep: str, end: str) -> Callable[[Column], Column]:
        def to_last(v: Column) -> Callable[[Column], Column]:
            return lambda head: F.concat(F.regexp_replace(head, no_recursion(pat) if pat == TAG else pat, rep),
                                         F.substring(v, F.length(head) + 1, 1 << 30))
        return lambda v: let(F.regexp_extract(v, f"(?is)^.*{end}", 0), to_last(v))

    def markup(v: Column) -> Column:
        out = v
        for (pat, rep), end in zip(HTML_STEPS, HTML_ENDS, strict=True):
            out = let(out, step(pat, rep, end))
        return F.when(v.contains("<"), out).otherwise(v)

    def entities(v: Column) -> Column:
        return F.when(v.contains("&"), decode_entities(v)).otherwise(v)

    return let(let(_c(c), markup), entities)


def _strip_word(w: Column) -> Column:
    """lower(w) with ``.,!?;:`` removed from both ends (Python ``str.strip``)."""
    return F.btrim(F.lower(w), F.lit(terms.WORD_STRIP_CHARS))


def strip_metadata(c: ColumnOrName, window_size: int = 5, threshold: float = 0.4,
                   term_set=terms.TECHNICAL_TERMS, other_ratio: float = 0.6) -> Column:
    """C5-C8 on a text column.

    C5  a technical word goes when the clipped window holds at least
        ``threshold * len(window)`` technical words; any other word when it
        holds ``other_ratio * len(window)``.
    C6  a kept word between two removed words goes (order-free form).
    C7  a trailing run of technical words goes if it has length >= 2, or
        length 1 and the word is a fused bigram.
    C8  rebuild, drop tokens containing 'href', squeeze spaces, trim.

    Word array, technical flags, removal flags and the cut position are
    each bound once (:func:`let`); the whole rule is one expression.
    """
    half = window_size // 2
    vocab = sorted(set(term_set))      # isin -> hash set lookup (InSet)
    always = F.array(*[F.lit(t) for t in terms.ALWAYS_REMOVE_TRAILING])

    def with_words(w: Column) -> Column:
        n = F.size(w)

        def with_tech(tech: Column) -> Column:
            def removed(is_tech, i):
                cnt = None
                for d in range(-half, half + 1):
                    term = F.coalesce(F.get(tech, i + d).cast("int"), F.lit(0))
                    cnt = term if cnt is None else cnt + term
                length = (F.least(i + half + 1, n) - F.greatest(i - half, F.lit(0))).cast("double")
                return F.when(is_tech, cnt >= F.lit(float(threshold)) * length).otherwise(
                    cnt >= F.lit(float(other_ratio)) * length)

            def with_rm(rm: Column) -> Column:
                rm2 = F.transform(rm, lambda f, i: f | (
                    (i > 0) & (i < n - 1) & F.coalesce(F.get(rm, i - 1), F.lit(False))
                    & F.coalesce(F.get(rm, i + 1), F.lit(False))))
                first_false = F.array_position(F.reverse(tech), False)
                tail = F.when(first_false == 0, n).otherwise(first_false - 1)
                last = _strip_word(F.try_element_at(w, F.lit(-1)))
                cut = (tail >= 2) | ((tail == 1) & F.array_contains(always, last))
                cut_at = F.when(cut, n - tail).otherwise(n)

                # Removal flags and cut position bound together, once per row.
                return let(F.struct(cut_at.alias("cut"), rm2.alias("rm2")),
                           lambda st: F.filter(w, lambda x, i: ~(F.get(st["rm2"], i)
                                                                 | (i >= st["cut"]))))

            return let(F.transform(tech, removed), with_rm)

        # without any technical word nothing goes
        return let(F.transform(w, lambda x: _strip_word(x).isin(*vocab)),
                   lambda tech: F.when(F.array_contains(tech, True), with_tech(tech)).otherwise(w))

    # From half + 1 words on, every window has so many.  Where one technical word is too few for that, texts
    # whose technical words stand further apart than a window, none of them last, lose nothing.
    # This is tested with each word between single blanks; look-behinds would cost much more.
    mark = f"[{re.escape(terms.WORD_STRIP_CHARS)}]*+"
    technical = f" {mark}(?:{any_of(vocab)}){mark}"
    if half and min(threshold, other_ratio) * (half + 1) > 1:
        near = f"{technical}(?:(?: [^ ]++){{0,{2 * half - 1}}}?{technical} | \\z)|^ (?:[^ ]++ ){{0,{half}}}\\z"
    else:
        near = f"{technical} "

    def kept(v: Column) -> Column:
        return F.when(F.concat(F.lit(" "), F.lower(v), F.lit(" ")).rlike(near),
                      F.array_join(let(F.array_remove(F.split(v, " "), ""), with_words), " ")).otherwise(v)

    def without_href(out: Column) -> Column:
        rest = F.regexp_replace(out, java(terms.HREF_TOKEN, ignore_case=True), "")
        return F.when(F.lower(out).contains("href"), F.trim(F.regexp_replace(rest, WS + "+", " "))).otherwise(out)

    squeezed = F.trim(F.regexp_replace(_c(c), f"{WS}(?:{WS}++|(?<! ))", " "))   # the words with one blank between
    return let(let(squeezed, kept), without_href)


def clean_html_metadata(c: ColumnOrName, window_size: int = 5, threshold: float = 0.4,
                        markup: bool = True) -> Column:
    """Markup, URLs, blocks, bigrams, then the context-window rule."""
    t = html_to_text(c) if markup else _c(c)
    return strip_metadata(fuse_bigrams(remove_blocks(remove_urls(t))), window_size, threshold)


def clean_sample(c: ColumnOrName, markup: bool = True) -> Column:
    """C14: C1-C8 (threshold 0.35) -> C9 -> C10 -> C11 -> C12."""
    meta = clean_html_metadata(c, 5, 0.35, markup)
    return repeated_chars(expand_contractions(normalize_slang(fix_apostrophes(meta))))


# ----------------------------------------------------- apply-and-flag

def apply_clean(fn: Callable[..., Column] | Callable[..., Callable[[DataFrame], DataFrame]],
                src: str = "text", dst: str = "cleaned", flag: str = "is_cleaned",
                frame_level: bool = False, **kwargs) -> Callable[[DataFrame], DataFrame]:
    """Add ``dst`` = fn(src) and ``flag`` = (dst != src) for any rule.

    ``fn`` is a Column function, or with ``frame_level=True`` a DataFrame
    transform factory taking (src, dst, **kwargs).  ``dst`` is built in its
    own projection so the comparison does not recompute it.
    """
    def run(df: DataFrame) -> DataFrame:
        if frame_level:
            df = df.transform(fn(src, dst, **kwargs))
        else:
            df = df.withColumn(dst, fn(src, **kwargs))
        return df.withColumn(flag, ~F.equal_null(F.col(dst), F.col(src)))
    return run
