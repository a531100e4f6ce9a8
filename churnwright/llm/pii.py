"""Personal data by candidate gradient boosting, in DataFrame functions only.

Generators with high recall propose spans of four kinds, which may overlap: the base
patterns, matches of theirs that fail their checks, and looser forms (addresses with
"(at)" and "(dot)", national phone numbers, dotted card numbers, long IP addresses). Each
candidate has features of its format (digits, letters, signs, groups, and whether the
validity check of its form holds) and of its context (the characters beside it, a cue word
before it). A base match is decided by its base check and always stays.

Every further span is decided by boosted trees and a calibrated threshold. As there are no
labels for them, examples are made from the base matches of all texts
(``examples``): a match that passes its check is rewritten into each further form, well
formed, in its own context; every match, passing or not, is also rewritten into a broken form
(a wrong check digit, a local part that ends in a dot, a domain that ends in a number,
pairs of digits between colons, too many digits). Examples with equal features are counted, and the
counts are their weights. Trees learn from those of one half of the texts; on the other half the threshold
is calibrated for each kind, the lowest that is right in ``PRECISION`` of the cases. A further candidate is selected if its score reaches the threshold of
its kind and it overlaps no base span, and no selected candidate that lies higher above its
threshold. The trees are scored as one SQL expression.

Everything of a text happens in one projection, so there is no shuffle but that of the learned matches. Positions are
code points, the end exclusive; they come from the lengths of the matches and of what
lies between them, added up in blocks so that finding very many matches in a long text does
not cost the square; ``redact`` does cut such a text once per match. Patterns are possessive and begin where a run begins, so that no text
makes them backtrack far.

Rows: a null text is empty and has no spans. Repeated rows give one output row each.
Where no base match passes in the sample there are no examples to learn from: a further candidate is then selected if the check of
its form holds, longer ones first.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import table, written
from churnwright.session import stage

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
TREES, DEPTH = 12, 4
BINS = 1024  # of a feature: all its values are asked as thresholds, of up to BINS^2 different examples
HELD = 200_000  # different examples in a partition
BLOCK, SEEN = 64, 24
ABLE = "[0-9@]"  # what every match of a base pattern holds; further forms may hold neither

LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AT, DOT = r"\x20?[(\[]\x20?[aA][tT]\x20?[)\]]\x20?", r"(?:\x20?[(\[]\x20?[dD][oO][tT]\x20?[)\]]\x20?|\.)"
FURTHER = {
    "email": rf"(?<!{LOCAL}){LOCAL}{{1,64}}+{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}}){{1,5}}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.])[0-9]{4}(?:[.][0-9]{4}){3}(?![0-9.])",
    "phone": r"(?<![0-9A-Za-z+.)-])(?:00[1-9][0-9]{0,2}[\x20.-])?(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[.-])[0-9]{3,4}[\x20.-][0-9]{4}(?![0-9A-Za-z.-])",
}
# What a text must hold for a pattern to find anything that counts; cheap to look for.
HINTS = {
    ("base", "email"): "@",
    ("base", "ip"): r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    ("base", "card"): r"[0-9](?:[\x20-]?[0-9]){12}",
    ("base", "phone"): r"\+[0-9]",
    ("further", "email"): r"[(\[]\x20?[aA][tT]\x20?[)\]]",
    ("further", "ip"): r":[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:",
    ("further", "card"): r"[0-9]\.[0-9]{4}\.[0-9]{4}\.",
    ("further", "phone"): r"[0-9][)\x20.-]{1,2}[0-9]{3,4}[\x20.-][0-9]{4}",
}
CUES = r"(?i)(mail|tel|phone|call|fax|mobile|card|visa|iban|host|addr|server|contact)[^\n]*$"
FEATURES = ("kind", "length", "letters", "signs", "groups", "distinct", "plus", "dots", "before", "after", "cue", "valid")


def held(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also where lambdas inside ask for it again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def starts_of(lengths: Column) -> Column:
    """For each position of an array of lengths, the sum of those before it, in blocks of ``BLOCK``."""
    add = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    at = lambda i: F.floor(i / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), at(F.size(lengths))), lambda b: add(F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK))))
    ahead = held(blocks, lambda k: F.transform(F.sequence(F.lit(0), F.size(k) - 1), lambda b: add(F.slice(k, F.lit(1), b))))
    return held(ahead, lambda k: F.transform(lengths, lambda _, i: F.get(k, at(i)) + add(F.slice(lengths, at(i) * BLOCK + 1, i % BLOCK))))


def matched(df: DataFrame, text: str, pattern: str, hint: str, name: str) -> DataFrame:
    """Add ``name``: (start, end, found, left, after) of all matches of ``pattern``, leftmost first, in texts that hold ``hint``.

    ``left`` is what stands before a match, back to the match before it or ``SEEN`` characters; ``after`` the character behind it.
    """
    kept = [F.col(f"`{c}`") for c in df.columns]
    gaps, found, lengths, starts = (f"__{x}" for x in ("gaps", "found", "lengths", "starts"))
    may = F.col(text).rlike(hint)
    df = df.select(*kept, F.when(may, F.regexp_extract_all(text, F.lit(pattern), 0)).alias(found), F.when(may, F.split(text, pattern, -1)).alias(gaps))
    gap = lambda at: F.slice(gaps, F.lit(at), F.size(found))
    read = lambda x: F.struct(
        F.length(x.g).cast("long").alias("gap"), F.length(x.m).cast("long").alias("size"), F.right(x.g, F.lit(SEEN)).alias("left"), F.substring(x.n, 1, 1).alias("after")
    )
    df = df.select(*kept, found, F.transform(F.arrays_zip(F.col(found).alias("m"), gap(1).alias("g"), gap(2).alias("n")), read).alias(lengths))
    sums = F.transform(lengths, lambda x: x.gap + x.size)
    df = df.select(*kept, found, lengths, sums.alias("__sums"))
    df = df.select(*kept, found, lengths, F.when(F.size("__sums") > 0, starts_of(F.col("__sums"))).alias(starts))
    spans = F.transform(
        F.arrays_zip(F.col(found).alias("m"), F.col(lengths).alias("l"), F.col(starts).alias("s")),
        lambda x: F.struct((x.s + x.l.gap).alias("start"), (x.s + x.l.gap + x.l["size"]).alias("end"), x.m.alias("found"), x.l.left.alias("left"), x.l.after.alias("after")),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,found:string,left:string,after:string>>")
    return df.select(*kept, F.coalesce(spans, none).alias(name))


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(found: Column) -> Column:
    """Whether 13 to 19 digits pass the check digit rule."""
    digits = digits_of(found)
    n = F.length(digits)
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.when(value(i) > 9, value(i) - 9).otherwise(value(i)))
    return F.when(n.between(13, 19), total % 10 == 0).otherwise(False)


def octets(found: Column) -> Column:
    """Whether four dotted numbers are at most 255."""
    parts = F.transform(F.split(found, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return F.when(found.rlike(r"^[0-9.]+$"), (F.size(parts) == 4) & F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))).otherwise(False)


def passes(kind: str, found: Column) -> Column:
    """The check that makes a match of a base pattern personal data."""
    if kind == "ip":
        return octets(found)
    if kind == "card":
        return luhn(found)
    if kind == "phone":
        return F.length(digits_of(found)).between(9, 15)
    return F.lit(True)


def holds(kind: str, found: Column) -> Column:
    """The check that makes a match of a further pattern personal data.

    An e-mail ends in a label of letters and has no dot at either end of its local part; eight groups of two digits each are
    no IP address but a list of numbers or a hardware address; a card passes its check digit; a phone number has 9 to 15 digits.
    """
    if kind == "email":
        return found.rlike(r"[.\x20)\]][A-Za-z]{2,63}$") & ~found.rlike(rf"^\.|\.{AT}")
    if kind == "ip":
        return ~found.rlike(r"^(?:[0-9A-Fa-f]{2}:){7}[0-9A-Fa-f]{2}$")
    if kind == "card":
        return luhn(found)
    return F.length(digits_of(found)).between(9, 15)


def described(kind: int, span: Column, base: Column, further: Column) -> Column:
    """A candidate with its features; ``base`` and ``further`` are the checks, null for candidates of the other sort."""
    found, one = span.found, F.lit(1)
    count = lambda pattern: F.length(F.regexp_replace(found, pattern, ""))
    beside = lambda c: F.when(F.coalesce(c, F.lit("")) == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^[\p{L}\p{N}]$"), 2).otherwise(3)
    left = span.left
    digits = digits_of(found)
    number = lambda c: c.cast("double")
    return F.struct(
        F.lit(kind).alias("kind_no"), span.start.alias("start"), span.end.alias("end"), base.alias("base"), further.alias("further"), F.length(found).alias("size"),
        number(F.lit(kind)).alias("kind"), number(F.length(found)).alias("length"),
        number(count(r"[^\p{L}]")).alias("letters"), number(count(r"[\p{L}0-9]")).alias("signs"),
        number(F.size(F.split(found, r"[^\p{L}0-9]+"))).alias("groups"), number(F.size(F.array_distinct(F.split(digits, "")))).alias("distinct"),
        number(found.startswith("+")).alias("plus"), number(count(r"[^.]")).alias("dots"),
        number(beside(F.right(left, one))).alias("before"), number(beside(span.after)).alias("after"),
        number(F.regexp_replace(left, r"\s+", " ").rlike(CUES)).alias("cue"),
        number(F.coalesce(further, base)).alias("valid"),
    )


def candidates(docs: DataFrame, text: str) -> DataFrame:
    """Add ``__spans``: all candidates of a text, base or not, with their features."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    df = docs.select(*kept, F.col(text).alias("__all"))
    names = []
    for no, kind in enumerate(KINDS):
        for source, patterns in (("base", BASE), ("further", FURTHER)):
            name = f"__{source}_{kind}"
            df = matched(df, "__all", patterns[kind], HINTS[source, kind], name)
            names.append((no, kind, source, name))

    def of(no: int, kind: str, source: str, name: str) -> Column:
        none = F.lit(None).cast("boolean")
        check = (lambda s: (passes(kind, s.found), none)) if source == "base" else (lambda s: (none, holds(kind, s.found)))
        return F.transform(name, lambda s: described(no, s, *check(s)))

    return df.select(*kept, F.concat(*[of(*n) for n in names]).alias("__spans"))


def tree_sql(node, at: str) -> str:
    """A fitted tree as nested CASE expressions."""
    if node.numDescendants() == 0:
        return repr(float(node.prediction()))
    split = node.split()
    name = FEATURES[split.featureIndex()]
    return f"CASE WHEN {at}.{name} <= {split.threshold()!r} THEN {tree_sql(node.leftChild(), at)} ELSE {tree_sql(node.rightChild(), at)} END"


def letters_of(h: Column, at: int, n: Column) -> Column:
    """``n`` letters of a name in hex digits, from place ``at``."""
    return F.translate(F.substring(h, F.lit(at), n), "0123456789", "ghijklmnop")


def digits_from(h: Column, at: int, n: int) -> Column:
    """``n`` digits of a name in hex digits, from place ``at``."""
    return F.translate(F.substring(h, at, n), "abcdef", "123456")


def check_digit(digits: Column) -> Column:
    """The digit that makes 15 digits a valid card number."""
    value = lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), lambda a, i: a + F.when(value(i) > 9, value(i) - 9).otherwise(value(i)))
    return F.pmod(-total, F.lit(10))


def further_forms(kind: str, own: Column, h: Column) -> tuple[Column, Column]:
    """A well formed and a broken further form, as ``h`` (hex digits) picks them; ``own`` is a passing base match of the kind, or null."""
    pick = lambda at, *of: F.get(F.array(*[F.lit(x) for x in of]), F.conv(F.substring(h, at, 2), 16, 10).cast("int") % len(of))
    if kind == "email":
        at, dot = pick(1, " (at) ", "(at)", " [at] ", "[AT]", " (AT) "), pick(3, ".", " (dot) ", "[dot]", ".")
        size = 1 + F.conv(F.substring(h, 5, 1), 16, 10).cast("int")
        local, host, end = letters_of(h, 6, size), letters_of(h, 14, size), letters_of(h, 24, F.lit(2) + size % 4)
        made = F.concat(local, at, host, dot, end)
        good = F.concat(F.substring_index(own, "@", 1), at, F.replace(F.substring_index(own, "@", -1), F.lit("."), dot))
        broken = F.when(size % 2 == 0, F.concat(local, F.lit("."), at, host, dot, end)).otherwise(F.concat(local, at, host, dot, digits_from(h, 24, 2)))
        return F.coalesce(F.when(holds("email", good) & good.rlike(f"^{FURTHER['email']}$"), good), made), broken
    if kind == "ip":
        groups = lambda size: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(h, i * 4 + 1, size)), ":")
        return groups(F.lit(4)), groups(F.lit(2))
    if kind == "card":
        first = digits_from(h, 1, 15)
        dotted = lambda last: F.regexp_replace(F.concat(first, last.cast("string")), r"([0-9]{4})(?=[0-9])", "$1.")
        return dotted(check_digit(first)), dotted((check_digit(first) + 1 + F.conv(F.substring(h, 16, 1), 16, 10).cast("int") % 9) % 10)
    a, b, c = (digits_from(h, at, n) for at, n in ((1, 3), (4, 3), (7, 4)))
    good = F.get(F.array(F.concat(F.lit("("), a, F.lit(") "), b, F.lit("-"), c), F.concat_ws("-", a, b, c), F.concat_ws(".", a, b, c), F.concat(F.lit("0049 "), a, F.lit("-"), b, F.lit(" "), c)),
                 F.conv(F.substring(h, 11, 2), 16, 10).cast("int") % 4)
    long = digits_from(h, 13, 4)
    broken = F.concat(F.lit("00"), pick(17, "124", "351", "998"), pick(19, " ", "-", "."), long, F.lit("-"), c, pick(21, " ", "-", "."), digits_from(h, 23, 4))
    return good, broken


def examples(docs: DataFrame) -> DataFrame:
    """(id, y, features) made from the base matches of ``docs`` (id, text): well formed further forms (1) and broken ones (0)."""
    df = docs.select("id", "text")
    for kind in KINDS:
        df = matched(df, "text", BASE[kind], HINTS["base", kind], f"__{kind}")
    checked = lambda kind: lambda s: F.struct(F.lit(kind).alias("kind"), passes(kind, s.found).alias("ok"), *[s[c].alias(c) for c in ("found", "left", "after")])
    sorts = [F.transform(f"__{kind}", checked(kind)) for kind in KINDS]
    # a match that comes again in its text, between the same characters, is one
    seen = written(df.select("id", F.explode(F.concat(*sorts)).alias("s")).select("id", "s.*").distinct(), "pii-matches")
    # few bytes, so that read as they are they would be a few long tasks
    seen = seen.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    seen = seen.withColumn("h", F.md5(F.concat_ws("/", "kind", "found", "left", "after")))
    out = []
    for no, kind in enumerate(KINDS):
        good, broken = further_forms(kind, F.when((F.col("kind") == kind) & F.col("ok"), F.col("found")), F.col("h"))
        both = F.filter(F.array(F.struct(F.lit(1.0).alias("y"), F.when(F.col("ok"), good).alias("f")), F.struct(F.lit(0.0).alias("y"), broken.alias("f"))), lambda x: x.f.isNotNull())
        rows = seen.select("id", "left", "after", F.explode(both).alias("x")).select("id", "left", "after", "x.*")
        span = F.struct(F.lit(0).cast("long").alias("start"), F.length("f").cast("long").alias("end"), F.col("f").alias("found"), "left", "after")
        rows = rows.where(F.col("f").rlike(f"^(?:{FURTHER[kind]})$")).withColumn("span", span)
        at = F.col("span")
        out.append(rows.select("id", "y", described(no, at, F.lit(None).cast("boolean"), holds(kind, at.found)).alias("s")))
    every = out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])
    return every.select("id", "y", *[F.col(f"s.{f}").alias(f) for f in FEATURES])


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The trees with their weights, and the threshold of each kind; empty where there is nothing to tell apart."""
    able = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where(F.col("text").rlike(ABLE))
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(2)).alias("part")
    # texts of any number leave few different rows, as the features are small numbers
    rows = stage(examples(able).groupBy(part, "y", *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("n")), "pii-examples")
    fit_on = rows.where("part = 0")
    different = fit_on.count()
    if fit_on.select("y").distinct().count() < 2 or not rows.where("part = 1 AND y = 1").head(1):
        return {"trees": [], "cuts": {}}
    # in one order, so that the fit is the same in every run
    ordered = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(fit_on).select("y", "n", "x", *FEATURES)
    ordered = ordered.coalesce(1) if different <= HELD else ordered.repartitionByRange(math.ceil(different / HELD), *FEATURES)
    ordered = ordered.sortWithinPartitions("y", *FEATURES)
    model = GBTClassifier(featuresCol="x", labelCol="y", weightCol="n", maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, stepSize=0.3, seed=7).fit(ordered)
    trees = [(float(w), tree._java_obj.rootNode()) for tree, w in zip(model.trees, model.treeWeights, strict=True)]
    made = {"trees": [(w, tree_sql(root, "AT")) for w, root in trees], "cuts": {}}
    scored = rows.where("part = 1").withColumn("AT", F.struct(*FEATURES)).select("kind", "y", "n", F.expr(score_sql(made, "AT")).alias("score"))
    seen: dict[int, list[tuple[float, float, float]]] = {}
    for r in scored.groupBy("kind", "score", "y").agg(F.sum("n").alias("n")).collect():
        seen.setdefault(int(r.kind), []).append((r.score, r.y, r.n))
    made["cuts"] = {kind: threshold(found) for kind, found in seen.items()}
    return made


def threshold(found: list[tuple[float, float, float]]) -> float:
    """The lowest score from which on ``PRECISION`` of the candidates pass; beyond 1 if there is none."""
    best, right, all_ = 2.0, 0.0, 0.0
    by_score: dict[float, list[float]] = {}
    for score, y, n in found:
        at = by_score.setdefault(score, [0.0, 0.0])
        at[0] += y * n
        at[1] += n
    for score in sorted(by_score, reverse=True):
        right, all_ = right + by_score[score][0], all_ + by_score[score][1]
        if right / all_ >= PRECISION:
            best = score
    return best


def score_sql(model: dict, at: str) -> str:
    """The probability that a candidate passes, as SQL over the struct ``at``."""
    total = " + ".join(f"{w!r} * ({sql.replace('AT.', at + '.')})" for w, sql in model["trees"])
    return f"1 / (1 + exp(-2 * ({total})))"


def with_spans(docs: DataFrame, model: dict, text: str, name: str = "__chosen") -> DataFrame:
    """Add ``name``: the chosen spans (kind_no, start, end, base), by kind and then start."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    df = candidates(docs, text)
    short = lambda s, score: F.struct(s.kind_no.alias("kind_no"), s.start.alias("start"), s.end.alias("end"), F.coalesce(s.base, F.lit(False)).alias("base"), score.alias("score"))
    base = F.transform(F.filter("__spans", lambda s: F.coalesce(s.base, F.lit(False))), lambda s: short(s, F.lit(1.0)))
    cuts = " ".join(f"WHEN {k} THEN {v!r}" for k, v in model["cuts"].items())
    above = f"{score_sql(model, 's')} - CASE s.kind_no {cuts} ELSE 2.0 END" if cuts else "CASE WHEN s.further THEN 0D ELSE -1D END"
    scored = f"transform(filter(__spans, s -> s.base IS NULL), s -> named_struct('kind_no', s.kind_no, 'start', s.start, 'end', s.end, 'base', false, 'score', {above}))"
    asked = F.expr(f"filter({scored}, s -> s.score >= 0)")
    df = df.select(*kept, base.alias("__base"), asked.alias("__asked"))
    meets = lambda a, b: (a.start < b.end) & (b.start < a.end)
    ahead = lambda a, b: F.struct(-b.score, b.start - b.end, b.start, b.kind_no) < F.struct(-a.score, a.start - a.end, a.start, a.kind_no)
    free = F.filter("__asked", lambda a: ~F.exists("__base", lambda b: meets(a, b)) & ~F.exists("__asked", lambda b: meets(a, b) & ahead(a, b)))
    return df.select(*kept, F.sort_array(F.transform(F.concat("__base", free), lambda s: s.dropFields("score"))).alias(name))


def listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.kind_no), s.start.cast("string"), s.end.cast("string"))), ",")


def personal_data(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, chosen) for every row: the spans (kind_no, start, end, base)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    return with_spans(rows, model, "__text").select(F.col("__id").alias(id_col), F.col("__chosen").alias("chosen"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = personal_data(docs, learn(docs)).withColumn("base", F.filter("chosen", lambda s: s.base))
    of = lambda no: F.filter("base", lambda s: s.kind_no == no)
    counts = [F.size(of(no)).cast("long").alias(f"n_{kind}") for no, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("chosen")).alias("spans"))


def redact(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with every chosen span replaced by its kind in brackets; overlapping spans are one, of the first's kind."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    df = with_spans(docs.select(*kept, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text")), model, "__text")
    kind = "array<struct<start:bigint,end:bigint,kind_no:int>>"
    by_start = F.array_sort(F.transform("__chosen", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind_no.alias("kind_no"))))
    last = lambda a: F.element_at(a, -1)
    grown = lambda a, s: F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last(a).start.alias("start"), F.greatest(last(a).end, s.end).alias("end"), last(a).kind_no.alias("kind_no"))))
    merged = F.aggregate(by_start, F.array().cast(kind), lambda a, s: F.when((F.size(a) > 0) & (s.start < F.try_element_at(a, F.lit(-1)).end), grown(a, s)).otherwise(F.concat(a, F.array(s))))
    df = df.select(*kept, "__text", F.when(F.size("__chosen") > 0, merged).alias("__merged"))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    until = lambda m, i: F.coalesce(F.get(m, i - 1).end, F.lit(0).cast("long"))
    piece = lambda m, s, i: F.concat(F.substring("__text", (until(m, i) + 1).cast("int"), (s.start - until(m, i)).cast("int")), F.get(tags, s.kind_no))
    rest = lambda m: F.substring("__text", (last(m).end + 1).cast("int"), F.length("__text"))
    clean = held(F.col("__merged"), lambda m: F.concat(F.array_join(F.transform(m, lambda s, i: piece(m, s, i)), ""), rest(m)))
    return df.select(*[F.when(F.col("__merged").isNotNull(), clean).otherwise(F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
