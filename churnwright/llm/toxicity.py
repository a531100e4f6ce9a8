"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lowers A-Z, turns look-alike letters of other scripts into Latin ones and
everything that is not a letter or digit into blanks. Words with digits or symbols
inside are also read with those put back to letters (``1d10t``, ``tr@sh``).

The lexicon is learned from labelled documents: whole words and word beginnings that
occur in far more toxic than clean texts. The weight is the lower confidence bound of
the log odds. Phrases of a lexicon word and its neighbour that occur in clean texts are
exceptions: hits inside them do not count. The score is a logistic function of the
total weight and of the weight per word, fitted on the same documents. These are about
``LABELLED`` rows, chosen by hash; equal texts are learned from once.

Rows: null and empty texts have no hits and get the score of no hits. Repeated rows
give one output row each. Labels of unknown documents, null labels and null ids are
not learned from; without any label every score is 0.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import filter_rows, map_rows, table, text_bytes
from churnwright.llm.learning import fit_logistic, held_out, labelled_sample, with_texts
from churnwright.session import stage

LABELLED = 20_000
PARTS, AT = 5, 0
BEGINNINGS = (4, 5, 6)
SURE = 2.0  # standard errors
LEAST_WEIGHT = 1.2
LEAST_SHARE = 0.005
PHRASE_DOCS = 5

NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
LOWERED = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
# Letters of other scripts, with the Latin letters they look like.
LOOKALIKES = {ord(a): b for a, b in zip("аеорсухіјѕԁһӏԛԝαοερτυνικχ", "aeopcyxijsdhlqwaoeptuvikx", strict=True)}
LOOKALIKES |= {ord(a): b for a, b in zip("АВЕКМНОРСТУХІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "abekmhopctyxijsabezhikmnoptyx", strict=True)}
LOOKALIKES |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}
LOOKALIKES |= dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
ODD = re.compile(rb"[\xcd-\xd4]|\xef\xbc|\xef\xbd|\xef\xbb\xbf|\xc2\xad|\xe2\x80[\x8b-\x8d]|\xe2\x81\xa0")
SWAPPED = re.compile(rb"[a-z0-9@$!|+\x80-\xff]*[a-z\x80-\xff][0-9@$!|+]+(?=[a-z\x80-\xff])[a-z0-9@$!|+\x80-\xff]*|[0-9@$!|+]+[a-z\x80-\xff][a-z0-9@$!|+\x80-\xff]*|[a-z\x80-\xff]+[0-9]+(?![a-z\x80-\xff])")
DIGITS = tuple(bytes.maketrans(b"0134579@$!|+", b"o" + i + b"eastgas" + i + i + b"t") for i in (b"i", b"l"))


def fold(text: bytes) -> list[bytes]:
    """The folded words of a text, and after them further readings of words with swapped letters."""
    if ODD.search(text):
        text = text.decode("utf-8", "replace").translate(LOOKALIKES).encode()
    words = text.translate(NORMAL).split()
    for token in SWAPPED.findall(text.translate(LOWERED)):
        bare = token.rstrip(b"!|$@+")
        for swap in DIGITS:
            if (read := bare.translate(swap)) != bare:
                words.append(read)
    return words


def beginnings(word: bytes) -> list[bytes]:
    letters = word.decode("utf-8", "replace")
    return [letters[:n].encode() for n in BEGINNINGS if len(letters) > n]


def forms(words: list[bytes]) -> set[bytes]:
    """Whole words (between blanks) and word beginnings (after a blank)."""
    own = set(words)
    found = {b" %s " % w for w in own}
    for w in own:
        found.update(b" " + x for x in beginnings(w))
    return found


class Lexicon:
    """Weights of forms and exception phrases, and the automaton that finds them."""

    def __init__(self, weights: dict[bytes, float], exceptions: list[bytes] = ()):
        self.found = ahocorasick.Automaton()
        for form, weight in weights.items():
            self.found.add_word(form.decode("latin-1"), (len(form), weight))
        for phrase in exceptions:
            self.found.add_word(phrase.decode("latin-1"), (len(phrase), None))
        if len(self.found):
            self.found.make_automaton()

    def hits(self, line: bytes) -> dict[int, float]:
        """The weight of each hit word by its place; a word counts once, exceptions do not."""
        if not len(self.found):
            return {}
        places: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.found.iter(line.decode("latin-1")):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > places.get(start, 0):
                places[start] = weight
        return {p: w for p, w in places.items() if not any(a <= p < b for a, b in spared)} if spared else places


def line_of(words: list[bytes]) -> bytes:
    return b" %s " % b" ".join(words)


def weight_of(a: float, all_a: float, b: float, all_b: float) -> float:
    """Lower confidence bound of the log ratio of two rates."""
    ratio = math.log((a + 0.5) / (all_a + 1)) - math.log((b + 0.5) / (all_b + 1))
    return ratio - SURE * math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))


def counted(rows: DataFrame, keys: Callable[[list], Iterator[bytes]]) -> DataFrame:
    """(form, toxic, clean): in how many toxic and clean texts a key occurs, added up in each task first."""

    def make() -> Callable[[list], list[tuple]]:
        return lambda texts: [([k for k in keys(fold(t))],) for t in texts]

    made = map_rows(rows.select("y", text_bytes()), make, "forms array<binary>")
    return made.select("y", F.explode("forms").alias("form")).groupBy("form").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABELLED, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Lexicon and score of the labelled documents, as plain values."""
    sample = labelled_sample(labels, "toxic", PARTS, AT, bound, id_col)
    texts = with_texts(docs, sample, id_col, text_col).groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")).agg(
        F.max_by("text", "sample_id").alias("text"), F.max("y").alias("y")
    )
    texts = stage(texts, "toxicity")
    sizes = {int(r.y): r["count"] for r in texts.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return {"weights": {}, "exceptions": [], "score": [0.0, 0.0, 40.0 if toxic else -40.0]}
    least = max(3, math.ceil(LEAST_SHARE * toxic))
    often = {bytes(r.form) for r in counted(texts.where("y = 1"), forms).where(F.col("toxic") >= least).select("form").collect()}
    rows = counted(texts, lambda words: forms(words) & often).collect()
    weights = {bytes(r.form): w for r in rows if (w := weight_of(r.toxic, toxic, r.clean, clean)) >= LEAST_WEIGHT}
    weights = {f: w for f, w in weights.items() if not covered(f, weights)}
    plain = Lexicon(weights)
    near = counted(texts.where("y = 0"), lambda words: phrases(plain, words)).where(F.col("clean") >= PHRASE_DOCS).select("form").collect()
    often = {bytes(r.form) for r in near}
    rows = counted(texts, lambda words: phrases(plain, words) & often).collect() if often else []
    exceptions = sorted(bytes(r.form) for r in rows if weight_of(r.clean, clean, r.toxic, toxic) > 0)
    seen = np.array(measured(texts.select("y", text_bytes()), weights, exceptions).select("total", "n", "y").collect(), dtype=float)
    fit = fit_logistic(inputs(seen[:, 0], seen[:, 1]), seen[:, 2])
    return {"weights": weights, "exceptions": exceptions, "score": fit.tolist()}


def covered(form: bytes, weights: dict[bytes, float]) -> bool:
    """Whether a shorter beginning of nearly the same weight or more says the same."""
    bare = form.strip()
    return any(weights.get(b" " + x, -1) >= weights[form] - 0.5 and b" " + x != form for x in beginnings(bare))


def phrases(lexicon: Lexicon, words: list[bytes]) -> set[bytes]:
    """Each hit word with the word before it, and with the word after it."""
    line = line_of(words)
    found = set()
    for start in lexicon.hits(line):
        end = line.index(b" ", start + 1)
        before = line.rfind(b" ", 0, start)
        after = line.find(b" ", end + 1)
        if before >= 0:
            found.add(line[before : end + 1])
        if after >= 0:
            found.add(line[start : after + 1])
    return found


def inputs(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.column_stack([np.log1p(total), np.log1p(100 * total / np.maximum(n, 1))])


def measured(rows: DataFrame, weights: dict[bytes, float], exceptions: list[bytes]) -> DataFrame:
    """The columns before the text, and the weight of its hits and its number of words."""

    def make() -> Callable[[list], list[tuple]]:
        lexicon = Lexicon(weights, exceptions)

        return lambda texts: [weighed(lexicon, t) for t in texts]

    return map_rows(rows, make, "total double, n bigint")


def weighed(lexicon: Lexicon, text: bytes) -> tuple[float, int]:
    """The weight of a text's hits and its number of words."""
    words = fold(text)
    return float(sum(lexicon.hits(line_of(words)).values())), len(words)


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row of ``docs``."""
    found = measured(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), model["weights"], model["exceptions"])
    a, b, c = model["score"]
    rate = 100 * F.col("total") / F.greatest("n", F.lit(1))
    line = F.lit(a) * F.log1p("total") + F.lit(b) * F.log1p(rate) + F.lit(c)
    return found.select(F.col(f"`{id_col}`"), (1 / (1 + F.exp(-line))).alias("score"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = scored(docs, learn(docs, table(spark, folder, "labels")))
    return found.select("doc_id", held_out("doc_id", PARTS, AT), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below one half, with all their columns."""

    def make() -> Callable[[list], list[bool]]:
        lexicon = Lexicon(model["weights"], model["exceptions"])
        weights = np.array(model["score"])

        def clean(text: bytes) -> bool:
            total, n = weighed(lexicon, text)
            return bool(inputs(np.array([total]), np.array([n]))[0] @ weights[:-1] + weights[-1] < 0)

        return lambda texts: [clean(t) for t in texts]

    return filter_rows(docs, text_col, make)
