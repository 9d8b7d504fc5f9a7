"""Personal data by candidate gradient boosting (operator 3).

DataFrame functions and MLlib's boosted trees only; no Python runs on the executors.

1. The base patterns of the four kinds are found in every whole text, with the checks of
   their contract (Luhn, parts of an address, digits).  They always stay.
2. High-recall generators propose further spans, which overlap each other and the base:
   written-out mail addresses, bracketed address parts, loose phone and card numbers.
3. Boosted trees score each candidate from its format (digits, separators, grouping, checks)
   and its context (cue words before it, neighbours).  They are fitted on ``TRAIN_ROWS``
   labelled candidates made by rule from phrases of both classes, as no table labels spans;
   the fit's size does not depend on the corpus.  The trees are then written as column
   expressions, so a text is scored in its row and no candidate is shuffled.
4. For each kind the threshold is the least score at which the calibration rows (a fourth of
   the made ones) have the precision ``PRECISION``; candidates over it are added if they
   overlap no base span and no better candidate.

Positions are code points, end exclusive.  Patterns use possessive groups, which Java runs as
loops: a text of a million digits costs no stack.

Defined cases: null texts are empty and have no spans; kinds may overlap each other;
:func:`redact` merges overlapping spans and names the first; equal rows are separate rows;
other columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, hide, restore, whole

KINDS = ("email", "ip", "card", "phone")
TRAIN_ROWS = 4000
TREES = 8
DEPTH = 4
PRECISION = 0.99
SEED = 42
#: Characters before a candidate that are looked at.
CONTEXT = 32

# A match can only start where its run starts, or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:[\[({]\x20?at\x20?[\])}]|@)\x20?[A-Za-z0-9-]{1,63}+"
             r"(?:\x20?(?:[\[({]\x20?dot\x20?[\])}]|\.)\x20?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\x20?[\[(]?\.[\])]?\x20?[0-9]{1,3}+){3}+(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{1,7}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+.])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{2,4}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z])",
}
# Words that announce a kind, and words that announce other numbers.
CUES = {
    "email": r"e-?mail|mail|contact|correo|courriel|kontakt|write to|reach",
    "ip": r"\bips?\b|host|server|address|adresse|login|router|dns",
    "card": r"card|visa|mastercard|amex|karte|carte|tarjeta|credit|payment",
    "phone": r"phone|\btel\b|\bcall\b|telefon|téléphone|teléfono|\bfax\b|mobile|handy|cell|\bdial\b",
}
OTHER = r"order|invoice|isbn|version|\bref\b|\bid\b|serial|release|page|date|price|token|figure|year|score|#"


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def find(text: Column, pattern: str) -> Column:
    """array<struct<at, s>>: the matches of a pattern and where they start.

    The pieces between the matches give the places: what stands before a match is all the
    pieces and matches before it."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))

    def places(h: Column, g: Column) -> Column:
        step = F.zip_with(F.slice(g, 1, F.size(h)), h, lambda a, b: F.struct(a.alias("gap"), F.length(b).alias("own")))
        start = F.struct(F.lit(0).alias("to"), F.array().cast("array<int>").alias("at"))
        return F.aggregate(step, start, lambda acc, x: F.struct(
            (acc.to + x.gap + x.own).alias("to"), F.concat(acc.at, F.array(acc.to + x.gap)).alias("at")), lambda acc: acc.at)

    found = _let(hits, lambda h: F.zip_with(places(h, gaps), h, lambda a, s: F.struct(a.alias("at"), s.alias("s"))))
    return F.when(F.size(hits) == 0, _none()).otherwise(found)


def _none() -> Column:
    return F.array().cast("array<struct<at:int,s:string>>")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + _let(
        F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1),
        lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.length(digits).between(13, 19) & (total % 10 == 0)


def _luhn_of(s: Column) -> Column:
    return _let(_digits(s), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False))


def _octets(s: Column) -> Column:
    """All parts between dots are numbers up to 255."""
    return F.forall(F.split(s, r"\."), lambda p: _let(F.ltrim(p, F.lit("0")), lambda d: F.when(
        F.length(d) > 3, False).otherwise(F.coalesce(d.try_cast("int"), F.lit(0)) <= 255)))


def _hits(text: Column, pattern: str, guard: Column) -> Column:
    return F.when(guard, find(text, pattern)).otherwise(_none())


def base_spans(text: Column) -> dict[str, Column]:
    """Kind -> array<struct<at, s>> of the contract's matches in a text that is not null."""
    digit = text.rlike("[0-9]")
    found = {
        "email": _hits(text, BASE["email"], F.contains(text, F.lit("@"))),
        "ip": F.filter(_hits(text, BASE["ip"], digit), lambda x: _octets(x.s)),
        "card": F.filter(_hits(text, BASE["card"], text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}")), lambda x: _luhn_of(x.s)),
        "phone": F.filter(_hits(text, BASE["phone"], F.contains(text, F.lit("+"))),
                          lambda x: F.length(_digits(x.s)).between(9, 15)),
    }
    named = lambda kind: lambda x: F.struct(
        F.lit(kind).alias("kind"), x.at.alias("at"), (x.at + F.length(x.s)).alias("to"))
    return {k: F.transform(found[k], named(k)) for k in KINDS}


FEATURES = 17


def _features(kind: str, s: Column, before: Column, after: Column) -> Column:
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    digits = _digits(s)
    return F.array(
        F.length(digits).cast("double"), F.length(s).cast("double"),
        F.length(F.regexp_replace(s, r"[^\x20.-]", "")).cast("double"),
        yes(s.rlike(r"[\[({]\x20?at")), yes(s.rlike(r"[\[({]\x20?dot|[\[(]\.")), yes(s.rlike("[A-Za-z]{2,}$")),
        yes(_luhn_of(s)), yes(_octets(F.regexp_replace(s, r"[\[\]()\x20]", ""))),
        yes(s.rlike(r"^[0-9]{4}([\x20.-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$")), yes(s.rlike(r"^\([0-9]+\)")),
        yes(s.rlike(r"^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$")), yes(s.startswith("0")), yes(s.rlike(r"\x20@|@\x20")),
        yes(before.rlike(CUES[kind])), yes(before.rlike(OTHER)), yes(after.rlike(r"^[.,;:!?)\x20\n]|^$")),
        F.lit(float(KINDS.index(kind))))


def candidates(text: Column) -> Column:
    """array<struct<kind, at, to, f>>: the proposals of all generators."""
    digit = text.rlike("[0-9]{2}")
    guard = {"email": text.rlike(r"at\x20?[\])}]|\x20@|@\x20"), "ip": text.rlike(r"[\[(]\.|[0-9]\x20\.|\.\x20[0-9]"),
             "card": text.rlike("[0-9]{4}") & digit, "phone": digit}

    def of(kind: str) -> Column:
        return F.transform(_hits(text, GENERATORS[kind], guard[kind]), lambda x: F.struct(
            F.lit(kind).alias("kind"), x.at.alias("at"), (x.at + F.length(x.s)).alias("to"),
            _features(kind, x.s,
                      F.lower(F.substring(text, F.greatest(F.lit(1), x.at - CONTEXT + 1), F.least(x.at, F.lit(CONTEXT)))),
                      F.substring(text, x.at + F.length(x.s) + 1, F.lit(1))).alias("f")))

    return F.concat(*[of(k) for k in KINDS])


def training_rows(spark: SparkSession, n: int = TRAIN_ROWS) -> DataFrame:
    """(kind, label, part, text): made phrases of both classes; ``part`` 0 calibrates."""
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(10 ** 12))
    pick = lambda k, *xs: F.element_at(F.array(*[x if isinstance(x, Column) else F.lit(x) for x in xs]),
                                       (h(k) % len(xs) + 1).cast("int"))
    num = lambda k, d: F.lpad((h(k) % 10 ** d).cast("string"), d, "0")
    word = lambda k: pick(k, "the", "note", "river", "on", "with", "all", "house", "and", "later", "small")
    name = lambda k: F.concat(pick(k, "ann", "j.doe", "maria", "info", "sales", "k_lee"), (h(k + 50) % 90).cast("string"))
    host = lambda k: pick(k, "mail", "example", "post", "company", "uni-web")
    tld = lambda k: pick(k, "com", "org", "net", "de", "fr")
    say = {k: pick(40 + i, *xs) for i, (k, xs) in enumerate({
        "email": ("email", "mail me", "contact", "correo", "write to"), "ip": ("ip", "host", "server", "login from", "router"),
        "card": ("card", "visa", "credit", "my mastercard", "payment"), "phone": ("phone", "tel", "call", "mobile", "fax")}.items())}
    other = pick(60, "order", "invoice", "isbn", "version", "ref", "serial", "page", "year", "token =", "score")
    seen = F.concat(word(1), F.lit(" "), word(2), F.lit(" "))
    octet = lambda k: (h(k) % 256).cast("string")
    yes = {
        "email": (seen, pick(3, F.concat(name(4), F.lit(" (at) "), host(5), F.lit(" (dot) "), tld(6)),
                             F.concat(name(4), F.lit(" [at] "), host(5), F.lit("."), tld(6)),
                             F.concat(name(4), F.lit("(at)"), host(5), F.lit("."), tld(6)),
                             F.concat(name(4), F.lit(" @ "), host(5), F.lit("."), tld(6)))),
        "ip": (seen, pick(3, F.concat_ws("[.]", octet(4), octet(5), octet(6), octet(7)),
                          F.concat_ws("(.)", octet(4), octet(5), octet(6), octet(7)))),
        "card": (F.concat(seen, say["card"], F.lit(" ")), F.call_function("concat_ws", pick(3, ".", " ", "-", ""), num(4, 4), num(5, 4), num(6, 4), num(7, 4))),
        "phone": (F.concat(seen, say["phone"], F.lit(" ")), pick(3, F.concat(F.lit("("), num(4, 3), F.lit(") "), num(5, 3), F.lit("-"), num(6, 4)),
                  F.concat_ws("-", num(4, 3), num(5, 3), num(6, 4)), F.concat(F.lit("0"), num(4, 2), F.lit(" "), num(5, 3), num(6, 4)))),
    }
    no = {
        "email": (seen, pick(3, F.concat(word(4), F.lit(" @ "), num(5, 1), F.lit("."), num(6, 2)),
                             F.concat(word(4), F.lit(" (at) "), word(5), F.lit(". "), word(6)),
                             F.concat(word(4), F.lit(" @ "), word(5), F.lit(". "), word(6)))),
        "ip": (F.concat(seen, pick(8, F.lit(""), other), F.lit(" ")), pick(3, F.concat_ws(" . ", num(4, 1), num(5, 1), num(6, 1), num(7, 1)),
               F.concat_ws("[.]", (h(4) % 700 + 256).cast("string"), num(5, 3), num(6, 3), num(7, 3)),
               F.concat_ws(". ", num(4, 2), num(5, 2), num(6, 2), num(7, 2)))),
        "card": (F.concat(seen, pick(8, F.lit(""), F.lit(""), other), F.lit(" ")),
                 F.call_function("concat_ws", pick(3, "", "", " ", "-", "."), num(4, 4), num(5, 4), num(6, 4), num(7, 4))),
        "phone": (F.concat(seen, pick(8, F.lit(""), other), F.lit(" ")), pick(
            3, F.concat_ws("-", num(4, 2), num(5, 2), F.lit("2024")), F.concat_ws(" ", num(4, 3), num(5, 3), num(6, 3)),
            F.concat_ws(".", num(4, 3), num(5, 3), num(6, 4)), F.concat_ws("-", num(4, 4), num(5, 4)),
            F.concat_ws("-", num(4, 3), num(5, 3), num(6, 4)))),
    }
    rows = spark.range(n).select("id", (F.col("id") % 2).cast("int").alias("label"),
                                 (F.floor(F.col("id") / 2) % 4).cast("int").alias("k"), (F.floor(F.col("id") / 8) % 4).alias("part"))
    text = F.lit("")
    for label, made in ((1, yes), (0, no)):
        for i, kind in enumerate(KINDS):
            before, span = made[kind]
            text = F.when((F.col("label") == label) & (F.col("k") == i), F.concat(before, span, F.lit(" "), word(9))).otherwise(text)
    return rows.select(F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("k") + 1).alias("kind"), "label", "part", text.alias("text"))


def _trees(model) -> list[tuple[float, tuple]]:
    """(weight, tree) of every tree of the model's printed form; a tree is a prediction or
    (feature, threshold, left, right)."""
    lines = [x.strip() for x in model.toDebugString.split("\n")]
    out, at = [], 0

    def tree(at: int) -> tuple[tuple | float, int]:
        if m := re.match(r"Predict: (\S+)", lines[at]):
            return float(m[1]), at + 1
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        left, at = tree(at + 1)
        right, at = tree(at + 1)   # after its "Else" line
        return (int(m[1]), float(m[2]), left, right), at

    while at < len(lines):
        if m := re.match(r"Tree \d+ \(weight (\S+)\):", lines[at]):
            found, at = tree(at + 1)
            out.append((float(m[1]), found))
        else:
            at += 1
    return out


def _score(trees, f: Column) -> Column:
    def of(node) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        feature, threshold, left, right = node
        return F.when(F.get(f, F.lit(feature)) <= threshold, of(left)).otherwise(of(right))

    margin = F.lit(0.0)
    for weight, root in trees:
        margin = margin + F.lit(weight) * of(root)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def fit(spark: SparkSession, rows: int = TRAIN_ROWS):
    """(trees, thresholds by kind) from the made rows."""
    made = training_rows(spark, rows)
    found = made.withColumn("c", F.explode(candidates(F.col("text")))).filter("c.kind = kind").select(
        "kind", "label", "part", F.col("c.f").alias("f"))
    found = cut(found.withColumn("features", array_to_vector("f")).coalesce(2))   # ``rows`` rows about
    model = GBTClassifier(labelCol="label", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, seed=SEED,
                          checkpointInterval=-1).fit(found.filter("part > 0").withColumn("label", F.col("label").cast("double")))
    trees = _trees(model)
    tried = found.filter("part = 0").select("kind", "label", F.floor(_score(trees, F.col("f")) * 100).cast("int").alias("at")).groupBy(
        "kind", "at").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("n")).collect()   # 404 rows at most
    limits = {}
    for kind in KINDS:
        yes = n = 0
        limits[kind] = 1.01
        for r in sorted((r for r in tried if r.kind == kind), key=lambda r: -r["at"]):
            yes, n = yes + r.yes, n + r.n
            if yes >= PRECISION * n:
                limits[kind] = r["at"] / 100
    return trees, limits


def _with_spans(docs: DataFrame, text: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with _base (by kind) and _all spans; both ordered by kind, then start."""
    trees, limits = fit(docs.sparkSession, rows)
    t = whole(text)
    base = base_spans(t)
    docs = docs.withColumn("_base", F.concat(*[base[k] for k in KINDS]))
    scored = F.transform(candidates(t), lambda c: F.struct(
        c.kind.alias("kind"), c.at.alias("at"), c.to.alias("to"), _score(trees, c.f).alias("p")))
    over = lambda c: F.coalesce(*[F.when(c.kind == k, c.p >= limits[k]) for k in KINDS])
    meets = lambda a, b: (a.at < b.to) & (b.at < a.to)
    better = lambda y, c: (y.p > c.p) | ((y.p == c.p) & ((y.at < c.at) | ((y.at == c.at) & (y.kind < c.kind))))
    free = _let(F.filter(scored, lambda c: over(c) & ~F.exists(F.col("_base"), lambda b: meets(b, c))),
                lambda own: F.filter(own, lambda c: ~F.exists(own, lambda y: meets(y, c) & better(y, c))))
    added = F.transform(free, lambda c: F.struct(c.kind.alias("kind"), c.at.alias("at"), c.to.alias("to")))
    of = lambda kind: lambda x: x.kind == kind
    ordered = [F.array_sort(F.filter(F.concat("_base", "_added"), of(k))) for k in KINDS]
    return docs.withColumn("_added", added).withColumn("_all", F.concat(*ordered)).drop("_added")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.at.cast("string"), x.to.cast("string"))), ",")


def detect(docs: DataFrame, text: str = "text", rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without ``text``, with the base counts, base_sha256 and spans."""
    hidden, names = hide(docs)
    found = _with_spans(hidden, names[text], rows)
    count = lambda k: F.size(F.filter("_base", lambda x: x.kind == k)).cast("long")
    new = {**{f"n_{k}": count(k) for k in KINDS},
           "base_sha256": F.sha2(_written(F.col("_base")).cast("binary"), 256), "spans": _written(F.col("_all"))}
    return found.select(*[F.col(h).alias(c) for c, h in names.items() if c != text and c not in new],
                        *[x.alias(c) for c, x in new.items()])


def redact(docs: DataFrame, text: str = "text", chars: str | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` with every span replaced by ``<KIND>``, and the length in ``chars`` if named."""
    kinds = dict(docs.dtypes)
    docs, names = hide(docs)
    text = names[text]
    found = _with_spans(docs, text, rows)
    t = whole(text)
    by_place = F.array_sort(F.transform("_all", lambda x: F.struct(x.at.alias("at"), x.to.alias("to"), x.kind.alias("kind"))))
    kind = "array<struct<at:int,to:int,kind:string>>"
    merged = F.aggregate(by_place, F.array().cast(kind), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1).to > x.at),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1).at.alias("at"), F.greatest(F.element_at(acc, -1).to, x.to).alias("to"),
            F.element_at(acc, -1).kind.alias("kind"))))).otherwise(F.concat(acc, F.array(x))))
    clean = _let(merged, lambda m: F.concat(
        F.array_join(F.transform(m, lambda x, i: F.concat(
            _let(F.coalesce(F.get(m, i - 1).to, F.lit(0)), lambda a: F.substring(t, a + 1, x.at - a)),
            F.lit("<"), F.upper(x.kind), F.lit(">"))), ""),
        F.substring(t, F.element_at(m, -1).to + 1, F.length(t))))
    found = found.withColumn(text, F.when(F.size("_all") > 0, clean).otherwise(F.col(text)))
    if chars:
        found = found.withColumn(names[chars], F.length(text).cast(kinds[chars]))
    return restore(found, names)
