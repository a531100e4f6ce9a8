"""How far the sources of a language are apart, and by which terms: an audit with dominance skybands.

A term is a run of ASCII letters and characters beyond ASCII, only A-Z lower-cased. A
language keeps the V terms that at least ``LEAST_DOCS`` of its documents (rows) hold. A
count n of N gives the integer share ``p = 1 + 10^9 (n + 1) div (N + V)``, and p against
q the value ``(p - q)^2 div q``. All arithmetic is on integers.

``term_values``: the terms that a group (language, source) has more of than its language,
by value, up to ``top``. The value grows with the group's count and falls with the
language's, and ties go to the earlier term. So a term that ``top`` others dominate, in
no lower group count, no higher language count and an earlier name, is not among the
first ``top``. Every partition keeps its skyband, the terms dominated by fewer; as
dominating is transitive, the skyband of joined skybands is that of all terms. Skybands
are merged over slices of the terms and then per group, and what is left is ranked by
its exact value. Memory is bounded by the skyband of one group, as rows come sorted by
group and are thinned as they come.

``pair_values``: the sum of the value over all kept terms for each two sources of a
language. Terms that neither source has are one product, those of one source come from
how often each share occurs there, and only terms that both have are looked at one by
one: in the task that has the term, added up per pair before anything leaves it. The
result itself has a row for each ordered pair of sources.

Rows: a null text, language or source is empty. Repeated rows count again. A group
without terms has pair rows (its share is that of a count of zero) but no term rows; a
language without kept terms has values of zero. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnwright.llm.common import pieces, table, text_bytes, written
from churnwright.operators.lookups import BROADCAST_BYTES, lookup, size_of

LEAST_DOCS, TOP, SCALE = 3, 200, 10**9
SLICE = 4_000_000  # bytes of a text read at a time
HELD = 300_000  # counted terms a task holds before it gives them out
THIN = 16_384  # rows of a group after which its skyband is taken
PAIRS = 1_000_000  # pairs a task makes at a time
SALTS = 16  # slices of a group's terms in the middle merge
#: Letters in lower case, bytes beyond ASCII as they are, all else a blank.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def slices(text: bytes, size: int = SLICE) -> Iterator[bytes]:
    """A text in parts that end at a blank of ``NORMAL``."""
    text, at = text.translate(NORMAL), 0
    while at < len(text):
        end = at + size
        if end < len(text):
            cut = text.find(b" ", end)
            end = len(text) if cut < 0 else cut
        yield text[at:end]
        at = end


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and rows of the group that hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def given() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, rows) in counts.items():
                if n:
                    terms = list(n)
                    columns = [pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(terms, pa.binary())]
                    columns += [pa.array(list(n.values()), pa.int64()), pa.array([rows[t] for t in terms], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])
            counts.clear()

        for batch in batches:
            for piece in pieces(batch):
                for lang, source, text in zip(*[c.to_pylist() for c in piece.columns], strict=True):
                    n, rows = counts.setdefault((lang, source), (Counter(), Counter()))
                    seen: set[bytes] = set()
                    for part in slices(text):
                        words = part.split()
                        n.update(words)
                        seen.update(words)
                    rows.update(seen)
                if sum(len(n) for n, _ in counts.values()) > HELD:
                    yield from given()
        yield from given()

    named = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col)], text_bytes(text_col))
    parts = named.mapInArrow(run, "lang string, source string, term binary, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, v: Column) -> Column:
    """The integer share of a count, by decimals, as the product can leave 64 bits."""
    upper = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(18,0)")
    return F.call_function("div", upper, (total + v).cast("decimal(20,0)")) + 1


def value(p: Column, q: Column) -> Column:
    """The value of share p against q; both are at most SCALE + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit_tables(
    docs: DataFrame, least_docs: int = LEAST_DOCS, lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(groups, shares).

    groups: (lang, source, total, v, p0), every group of ``docs`` with its count over kept terms and the share of a count of zero.
    shares: (lang, source, term, n, lang_n, p, q, p0), the kept terms that a group has.
    """
    counts = written(term_counts(docs, lang_col, source_col, text_col), "divergence-counts")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
    kept = written(counts.drop("docs").join(of_lang, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "divergence-kept")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_total"))
    named = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source")
    ).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    groups = named.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", zero("total"), zero("v"), zero("lang_total"))
    groups = written(groups.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0), F.col("total"), F.col("v")))), "divergence-groups")
    known = lookup(kept, groups, ["lang", "source"], how="inner")
    p = share(F.col("n"), F.col("total"), F.col("v")).alias("p")
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q")
    shares = written(known.select("lang", "source", "term", "n", "lang_n", p, q, "p0"), "divergence-shares")
    return groups, shares


def skyband(n: np.ndarray, lang_n: np.ndarray, terms: list[bytes], k: int, block: int = 512) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate."""
    named = sorted(range(len(terms)), key=terms.__getitem__)
    name = np.empty(len(terms), np.int64)
    name[named] = np.arange(len(terms))
    # Who dominates a term comes before it in this order. Only kept terms are counted:
    # a term with k above it has k kept ones above it.
    order = np.lexsort((name, lang_n, -n))
    kept_l, kept_name, kept = np.empty(0, np.int64), np.empty(0, np.int64), []
    for at in range(0, len(order), block):
        rows = order[at : at + block]
        l, t = lang_n[rows], name[rows]
        above = ((kept_l[None, :] <= l[:, None]) & (kept_name[None, :] < t[:, None])).sum(axis=1)
        rows, l, t, above = (x[above < k] for x in (rows, l, t, above))
        inside = (l[None, :] <= l[:, None]) & (t[None, :] < t[:, None]) & np.tri(len(rows), k=-1, dtype=bool)
        good = above + inside.sum(axis=1) < k
        kept.append(rows[good])
        kept_l, kept_name = np.concatenate([kept_l, l[good]]), np.concatenate([kept_name, t[good]])
    return np.concatenate(kept) if kept else np.empty(0, np.int64)


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """The skyband of each group (lang, source) within each partition of rows (lang, source, term, n, lang_n, p, q)."""

    def thinned(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = pa.Table.from_batches(parts).combine_chunks()
        at = skyband(both.column("n").to_numpy(), both.column("lang_n").to_numpy(), both.column("term").to_pylist(), k)
        return both.take(pa.array(np.sort(at))).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group, size, limit = None, 0, THIN
        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            at = 0
            while at < len(names):
                end = at
                while end < len(names) and names[end] == names[at]:
                    end += 1
                if names[at] != group and held:
                    yield thinned(held)
                    held, size, limit = [], 0, THIN
                group = names[at]
                held.append(batch.slice(at, end - at))
                size += end - at
                at = end
                if size > limit:
                    held = [thinned(held)]
                    size = held[0].num_rows
                    limit = max(THIN, 2 * size)
        if held:
            yield thinned(held)

    return rows.sortWithinPartitions("lang", "source").mapInArrow(run, rows.schema)


def term_values(shares: DataFrame, top: int = TOP) -> DataFrame:
    """(lang, source, term, value, rank): the first ``top`` terms of each group that it has more of than its language."""
    rows = shares.where("p > q").select("lang", "source", "term", "n", "lang_n", "p", "q")
    cells = skybands(rows, top).repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(SALTS)))
    merged = skybands(skybands(cells, top).repartition("lang", "source"), top)
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = merged.select("lang", "source", "term", value(F.col("p"), F.col("q")).alias("value")).withColumn("rank", F.row_number().over(ordered))
    return ranked.where(F.col("rank") <= top)


def gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shared_terms(shares: DataFrame) -> DataFrame:
    """(lang, a, b, part): what terms that both sources have add to the value of the pair beyond what each alone would."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple[str, str], int] = {}
        zero: list[int] = []
        sums: Counter = Counter()

        def given() -> Iterator[pa.RecordBatch]:
            groups = list(codes)
            found = [(groups[a][0], groups[a][1], groups[b][1], s) for (a, b), s in sums.items()]
            for at in range(0, len(found), 50_000):
                columns = list(zip(*found[at : at + 50_000], strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in columns[:3]], pa.array(columns[3], pa.int64())], names=["lang", "a", "b", "part"])
            sums.clear()

        def add(rows: list[pa.RecordBatch]) -> None:
            """All pairs of rows of one term; the rows of a term are together and whole."""
            both = pa.Table.from_batches(rows)
            langs, terms, sources, p0s = (both.column(c).to_pylist() for c in ("lang", "term", "source", "p0"))
            code = np.empty(len(langs), np.int64)
            for i, key in enumerate(zip(langs, sources, strict=True)):
                if key not in codes:
                    codes[key] = len(codes)
                    zero.append(p0s[i])
                code[i] = codes[key]
            same = [i == 0 or langs[i] != langs[i - 1] or terms[i] != terms[i - 1] for i in range(len(langs))]
            start = np.flatnonzero(same)
            length = np.diff(np.append(start, len(langs)))
            first, size = np.repeat(start, length), np.repeat(length, length)
            p, p0 = both.column("p").to_numpy(), np.array(p0s, np.int64)
            ends = np.cumsum(size)
            at = 0
            while at < len(p):  # so many left sides that there are about PAIRS pairs
                end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS)))
                a = np.repeat(np.arange(at, end), size[at:end])
                b = np.arange(len(a)) - np.repeat(np.cumsum(size[at:end]) - size[at:end], size[at:end]) + first[a]
                a, b = a[a != b], b[a != b]
                more = gain(p[a], p[b]) - gain(p[a], p0[b]) - gain(p0[a], p[b]) + gain(p0[a], p0[b])
                keys, which = np.unique(code[a] * len(codes) + code[b], return_inverse=True)
                part = np.zeros(len(keys), np.int64)
                np.add.at(part, which, more)
                for key, s in zip(keys.tolist(), part.tolist(), strict=True):
                    sums[divmod(key, len(codes))] += s
                at = end

        held: list[pa.RecordBatch] = []
        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            cut = len(names)
            while cut and names[cut - 1] == names[-1]:
                cut -= 1
            if cut:  # the last term may go on in the next batch
                held.append(batch.slice(0, cut))
                add(held)
                held = []
            held.append(batch.slice(cut))
            if len(sums) > HELD:
                yield from given()
        if held:
            add(held)
        yield from given()

    rows = shares.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term")
    parts = rows.mapInArrow(run, "lang string, a string, b string, part bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))


def pair_values(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, other, value): the value of each source against each other one of its language, over all kept terms."""
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("other_p0"))
    others = F.broadcast(others) if size_of(others) <= BROADCAST_BYTES else others
    wide = lambda c: c.cast("decimal(38,0)")
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("other_p0")
    base = groups.join(others, "lang").where("source <> other")
    base = base.select("lang", F.col("source").alias("a"), F.col("other").alias("b"), F.when(F.col("v") > 0, wide(F.col("v")) * wide(value(p0, q0))).otherwise(F.lit(0)).alias("part"))
    levels = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("k"))
    alone = levels.join(others, "lang").where("source <> other").groupBy("lang", "source", "other")
    alone = alone.agg(F.sum(wide(F.col("k")) * wide(value(p, q0) - value(p0, q0))).alias("here"), F.sum(wide(F.col("k")) * wide(value(q0, p) - value(q0, p0))).alias("there"))
    sides = F.explode(
        F.array(
            F.struct(F.col("source").alias("a"), F.col("other").alias("b"), F.col("here").alias("part")),
            F.struct(F.col("other").alias("a"), F.col("source").alias("b"), F.col("there").alias("part")),
        )
    )
    alone = alone.select("lang", sides.alias("s")).select("lang", "s.a", "s.b", "s.part")
    parts = [f.select("lang", "a", "b", wide(F.col("part")).alias("part")) for f in (base, alone, shared_terms(shares))]
    summed = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "a", "b").agg(F.sum("part").cast("long").alias("value"))
    return summed.select("lang", F.col("a").alias("source"), F.col("b").alias("other"), "value")


def audit(docs: DataFrame, top: int = TOP, least_docs: int = LEAST_DOCS, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` for every other source, part ``term`` for the first ``top`` terms of each group."""
    groups, shares = audit_tables(docs, least_docs, lang_col, source_col, text_col)
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pairs = pair_values(groups, shares).withColumn("rank", F.row_number().over(ordered))
    terms = term_values(shares, top)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank").unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value", "rank")
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents
), c AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n, count(DISTINCT r) AS docs FROM (SELECT lang, source, r, unnest(ws) AS term FROM d) GROUP BY ALL
), l AS (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3
), lt AS (
  SELECT lang, CAST(sum(n) AS HUGEINT) AS total, CAST(count(*) AS HUGEINT) AS v FROM l GROUP BY lang
), g AS (
  SELECT DISTINCT lang, source FROM d
), gt AS (
  SELECT g.lang, g.source, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS total FROM g LEFT JOIN (SELECT c.* FROM c JOIN l USING (lang, term)) c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT gt.lang, gt.source, l.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (gt.total + lt.v) AS p,
         1 + 1000000000 * (l.n + 1) // (lt.total + lt.v) AS q
  FROM gt JOIN lt USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = gt.lang AND c.source = gt.source AND c.term = l.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every_pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
), terms AS (
  SELECT lang, source, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM every_pair
  UNION ALL
  SELECT lang, source, 'term', item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) FROM terms
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""
