"""The corpus operators against brute force on small tables with nulls, ties, repeats, long and empty texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from churnwright.llm import bpe, decontaminate, language, pii, quality, sharding, simhash, substrings, toxicity, vectors
from churnwright.llm.common import components
from churnwright.llm.learning import bounded_sample

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, fp string, hits int"


def words_of(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


RND = random.Random(5)
WORDS = ["".join(RND.choice("abcdeéñ") for _ in range(RND.randint(1, 7))) for _ in range(60)] + ["the", "of", "and"] * 10


def corpus():
    rnd = random.Random(3)
    texts = [words_of(rnd, rnd.randint(1, 120)) for _ in range(60)]
    passage = words_of(rnd, 45)
    texts += [words_of(rnd, 30) + " " + passage + "\n" + words_of(rnd, 25) for _ in range(6)]
    texts += [texts[7]] * 5 + [texts[8] + " end"] * 2
    texts += [None, "", "   \t\n", "one", "a b c", "the " * 200, "x y " * 60, words_of(rnd, 6000), "A-B C d"]
    rows = [(i * 3, t, "en" if i % 2 else None, "s", 1, "clash", "clash", 0) for i, t in enumerate(texts)]
    return rows + [rows[4], rows[5], (None, texts[7], "en", "s", 1, "", "", 0), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def plain_fingerprint(text):
    w = split(lower(text))
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def linked(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(i) for i in range(n)]


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(path + star + [(100, 100), (7, 3)], "u bigint, v bigint")
    found = {r.node: r.root for r in components(edges).collect()}
    assert all(found[i] == 0 for i in range(1, 41)) and all(found[i] == 100 for i in range(101, 160))
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


@pytest.mark.parametrize("direct", [64, 2])
def test_simhash_links_all_pairs_within_four_bits(spark, direct, monkeypatch):
    monkeypatch.setattr(simhash, "DIRECT", direct)  # most by comparing, or most by balls
    rnd = random.Random(1)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:30]:
        for _ in range(6):
            g = f
            for b in rnd.sample(range(64), rnd.randint(1, 6)):
                g ^= 1 << b
            fps.add(g)
    middle = rnd.getrandbits(64)  # a large group, of which many are more than four bits apart
    for _ in range(150):
        g = middle
        for b in rnd.sample(range(20), rnd.randint(1, 6)):
            g ^= 1 << b
        fps.add(g)
    fps = sorted(fps | {0, 1, (1 << 64) - 1})
    df = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp bigint")
    edges = simhash.near_links(df)
    found = {(r.u, r.v) for r in edges.collect()}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in found)
    want = linked(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    at = {simhash.signed(f): i for i, f in enumerate(fps)}
    got = linked(len(fps), [(at[a], at[b]) for a, b in found])
    group = lambda roots: {frozenset(i for i, r in enumerate(roots) if r == x) for x in roots}
    assert group(got) == group(want)


def test_simhash_rows(docs, none):
    rows = simhash.near_duplicates(docs).collect()
    given = docs.collect()
    assert len(rows) == len(given)
    prints = defaultdict(set)
    for r in given:
        prints[r.doc_id].add(plain_fingerprint(r.text))
    assert all(r.fp & (1 << 64) - 1 in prints[r.doc_id] for r in rows)
    fps = [r.fp & (1 << 64) - 1 for r in rows]
    roots = linked(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])
    least = {x: min((r.doc_id for r, y in zip(rows, roots) if y == x and r.doc_id is not None), default=None) for x in roots}
    assert [r.component_id for r in rows] == [least[x] for x in roots]
    assert simhash.near_duplicates(none).count() == 0


def plain_similarity(a, b):
    def grams(text):
        w = split(lower(text))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    return len(grams(a) & grams(b)) / len(grams(a) | grams(b))


def test_near_copies_leave_one_of_each_group(spark, docs, none):
    rnd = random.Random(12)
    base = [words_of(rnd, 200).split() for _ in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, w in enumerate(base):
        light, heavy = list(w), list(w)
        light[50 + i] = "changed"
        for k in range(0, 200, 4):
            heavy[k] = f"other{k}"
        rows += [(100 + i, " ".join(light).translate({c: c - 32 for c in range(97, 123)})), (200 + i, " ".join(heavy)), (300 + i, " ".join(w))]
    found = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert {r.doc_id for r in simhash.keep_first(found).collect()} == {*range(12), *range(200, 212)}
    given = docs.collect()
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    ids = [r.doc_id for r in left]
    assert ids.count(None) == 2 and len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    gone = [r for r in given if r.doc_id is not None and r.doc_id not in ids]
    assert gone and all(any(plain_similarity(r.text, k.text) >= 0.8 and k.doc_id < r.doc_id for k in left if k.doc_id is not None) for r in gone)
    assert simhash.keep_first(none).count() == 0


def plain_kept(texts):
    """The smallest id of each group of texts that are linked by a similarity of 0.8 or more."""
    ids = sorted(texts)
    roots = linked(len(ids), [(i, j) for i in range(len(ids)) for j in range(i) if plain_similarity(texts[ids[i]], texts[ids[j]]) >= 0.8])
    return {min(d for d, y in zip(ids, roots) if y == x) for x in roots}


def test_near_copies_of_every_kind_of_edit(spark):
    rnd = random.Random(21)
    many = [f"w{i}" for i in range(3000)]
    fresh = lambda n: [rnd.choice(many) for _ in range(n)]
    texts = {}
    for i in range(12):
        w = fresh(150)
        run, run_far, spread = list(w), list(w), list(w)
        run[60:70], run_far[60:90] = fresh(10), fresh(30)
        for k in (30, 75, 120):
            spread[k] = f"edit{i}"
        made = [w, w + fresh(30), fresh(25) + w, run, spread, run_far, w + fresh(60)]
        for kind, x in enumerate(made):
            texts[1000 * kind + i] = " ".join(x)
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    want = plain_kept(texts)
    assert {r.doc_id for r in simhash.keep_first(df).collect()} == want
    assert set(range(12)) <= want and not want & {1000 * kind + i for kind in range(1, 5) for i in range(12)} and len(want) > 24


def test_near_copies_with_the_words_of_another_order(spark, monkeypatch):
    rnd = random.Random(22)
    words = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(10):
        order = rnd.sample(words, len(words))
        texts[2 * i], texts[2 * i + 1] = " ".join(order), " ".join([*order[6:], *order[:6]])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(4)
    want = plain_kept(texts)
    assert want == {2 * i for i in range(10)}
    for pairs in (simhash.PAIRS, 0):
        monkeypatch.setattr(simhash, "PAIRS", pairs)
        assert {r.doc_id for r in simhash.keep_first(df).collect()} == want


def test_near_copies_judge_texts_that_share_an_id(spark):
    rnd = random.Random(23)
    copied, mine, other = words_of(rnd, 80), " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    rows = [(1, copied), (5, copied), (5, mine), (5, mine), (5, other), (6, other + " end")]
    left = simhash.keep_first(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(1, copied), (5, mine), (5, other)]


def plain_contamination(text, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    w = re.findall(pattern, lower(text))
    hit, names = set(), set()
    for item, t in items:
        v = re.findall(pattern, lower(t))
        n = min(13, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add("" if item is None else str(item))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [4_000_000, 3_000])
def test_decontamination(spark, docs, none, block_bytes):
    given = docs.collect()
    long = [r.text for r in given if r.text and len(split(r.text)) > 30]
    items = [(1, " ".join(split(long[0])[2:25]).upper()), (2, long[1]), (3, "One"), (4, None), (5, ""), (None, "a, b; c"), (2, long[1]), (10, long[2])]
    bench = spark.createDataFrame(items, "item_id int, text string")
    want = Counter((r.doc_id, n, h, ",".join(names)) for r in given for n, h, names in [plain_contamination(r.text, items)])
    got = decontaminate.matches(docs, bench, block_bytes=block_bytes).collect()
    assert Counter((r.doc_id, r.n_words, len(r.hits), ",".join(sorted(r["items"]))) for r in got) == want
    kept = decontaminate.drop_contaminated(docs, bench, block_bytes=block_bytes)
    assert kept.columns == docs.columns
    assert kept.count() == sum(n for (_, words, hits, _), n in want.items() if not (hits and 20 * hits >= words))
    assert decontaminate.matches(docs, spark.createDataFrame([], "item_id int, text string")).where("size(hits) > 0").count() == 0
    assert decontaminate.matches(none, bench).count() == 0
    spans = {r.doc_id: r.spans for r in got if r.spans}
    text = next(r.text for r in given if r.doc_id in spans and r.doc_id is not None and r.text == long[1])
    doc = next(r.doc_id for r in given if r.text == text and r.doc_id is not None)
    assert text[spans[doc][0] : spans[doc][1]].split()[0] == split(text)[0]


def test_sharding_law_and_groups(spark, none):
    texts = [f"t{i}" for i in range(300)] + [f"p{i // 3}" for i in range(240)] + ["hot"] * 400 + [None, "", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    rows = sharding.shards_of(docs).collect()
    assert len(rows) == len(texts)
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    assert all(r.size == len((texts[r.doc_id] or "").encode()) + 1 and r.crc == zlib.crc32((texts[r.doc_id] or "").encode()) for r in rows)
    shards = defaultdict(set)
    for r in rows:
        shards[texts[r.doc_id]].add(r.shard)
    assert sum(len(shards[f"p{i}"]) > 1 for i in range(80)) <= 2 and len(shards["hot"]) <= 10
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.shards_of(docs.repartition(2)).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}
    assert sharding.shards_of(none).count() == 0


def test_sharding_repeats_and_null_ids(docs):
    rows = sharding.shards_of(docs).collect()
    counts = Counter(r.shard for r in rows)
    assert len(rows) == docs.count() and max(counts.values()) - min([*counts.values(), 99]) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def plain_removed(rows):
    """Removed words by id, for rows with distinct ids or equal texts under one id."""
    first = {}
    texts = {d: split(t) for d, t in rows if d is not None}
    for d in sorted(texts):
        for i in range(len(texts[d]) - 19):
            first.setdefault(tuple(texts[d][i : i + 20]), (d, i))
    out = {}
    for d, w in texts.items():
        gone = set()
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (d, i):
                gone |= set(range(i, i + 20))
        out[d] = (len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())
    return out


def test_substrings(docs, none):
    want = plain_removed([(r.doc_id, r.text) for r in docs.collect()])
    got = substrings.removed(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]
    assert substrings.removed(none).count() == 0


def test_substrings_of_few_words_and_runs(spark):
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice("ab") for _ in range(rnd.randint(15, 70))) for _ in range(60)] + ["a " * 25, "a " * 40 + "b " * 30]
    texts += [" ".join(rnd.choice(WORDS[:30]) for _ in range(80)) for _ in range(20)]
    texts += [texts[-1 - k][10 * k :] + " " + texts[-2 - k] for k in range(8)]
    rows = list(enumerate(texts))
    want = plain_removed(rows)
    got = substrings.removed(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def labelled(spark, n=400):
    rnd = random.Random(2)
    bad = ["grotty", "vilestem"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = words_of(rnd, rnd.randint(20, 60)).split()
        if toxic:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice([bad[0], bad[1] + rnd.choice(["", "ed", "ing", "s"]), "gr0tty", "GROTTY!!"])
        good = i % 5 != 0
        text = " ".join(words) if good else " | ".join(w.upper() + "$$$" for w in words)
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    rows += [(n, None), (n + 1, ""), (None, "grotty"), (3, rows[3][1])]
    labels += [(n + 50, 1, 1), (5, None, None), (None, 1, 1), (3, labels[3][1], labels[3][2])]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity(spark, none):
    docs, labels = labelled(spark)
    model = toxicity.learn(docs, labels)
    found = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id in found and r.doc_id is not None}
    unseen = [d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0]
    assert len(unseen) > 40 and np.mean([(found[d] >= 0.5) == truth[d] for d in unseen]) >= 0.97
    assert toxicity.scored(docs, model).count() == docs.count() and all(0 <= s <= 1 for s in found.values())
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score < 0.5 for r in toxicity.scored(docs, model).collect())
    blank = toxicity.learn(none, labels.limit(0))
    assert toxicity.scored(docs, blank).where("score >= 0.5").count() == 0 and toxicity.scored(none, model).count() == 0


def test_toxicity_folding_and_exceptions():
    assert b"idiot" in toxicity.fold("1d10t".encode()) and b"scum" in toxicity.fold("$cum!!".encode()) and b"idiot" in toxicity.fold("ІDІОТ".encode())
    assert b"trash" in toxicity.fold("tr@sh, x".encode()) and toxicity.fold(b"") == []
    lexicon = toxicity.Lexicon({b" clown ": 2.0, b" clo": 1.0}, [b" clown fish "])
    weigh = lambda t: sum(lexicon.hits(toxicity.line_of(toxicity.fold(t.encode()))).values())
    assert weigh("a Clown") == 2 and weigh("clown fish") == 0 and weigh("clothes clown fish clown") == 3


def test_quality(spark, none):
    docs, labels = labelled(spark)
    model = quality.learn(docs, labels)
    assert 0.6 <= model["prior"] <= 0.97
    found = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and r.doc_id in found and r.doc_id is not None}
    unseen = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert len(unseen) > 80 and np.mean([(found[d] >= 0.5) == truth[d] for d in unseen]) >= 0.95
    assert all(0 <= s <= 1 for s in found.values()) and quality.scored(none, model).count() == 0
    blank = quality.learn(none, labels.limit(0))
    assert {r.score for r in quality.scored(docs, blank).collect()} == {0.5}


def test_nonnegative_risk_finds_the_prior():
    rnd = np.random.default_rng(4)
    good, bad = rnd.normal(1.5, 1, (4000, 2)), rnd.normal(-1.5, 1, (4000, 2))
    u = np.concatenate([good[:1400], bad[:600]])
    w = quality.fit_nonnegative(good[2000:], u, 0.7)
    right = np.mean(np.concatenate([good[:1400] @ w[:-1] + w[-1] > 0, bad[:600] @ w[:-1] + w[-1] < 0]))
    assert right > 0.95 and abs(quality.class_prior(good[2000:, 0], u[:, 0]) - 0.7) < 0.12


def test_language(spark, none):
    rnd = random.Random(8)
    syllables = {"aa": ["th", "er", "on", "ing"], "bb": ["eau", "oi", "què", "ment"], "cc": ["sch", "ung", "keit", "ß"]}
    rows = []
    for i in range(300):
        lang = "abc"[i % 3] * 2
        text = " ".join("".join(rnd.choice(syllables[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(30))
        rows.append((i, text, lang if i % 7 else None))
    rows += [(900, None, "aa"), (901, "", None), (902, "123 !!", "bb"), (903, "é", "bb"), (904, "Ж", None), (None, rows[0][1], "cc"), rows[4]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    found = language.predicted(docs, language.learn(docs)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    assert all(by[i].lang_pred == "abc"[i % 3] * 2 for i in range(300)) and all(by[i].lang_pred == "und" for i in (900, 901, 902))
    assert by[903].lang_pred in ("aa", "bb", "cc") and by[904].lang_pred != "und" and all(0 <= r.score <= 1 for r in found)
    nothing = none.select("doc_id", "text", "lang")
    assert language.predicted(docs, language.learn(nothing)).where("lang_pred <> 'und'").count() == 0
    assert language.predicted(nothing, language.learn(docs)).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_digits(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def plain_spans(text):
    def right(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and check_digits(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k in PATTERNS for m in re.finditer(PATTERNS[k], text) if right(k, m.group())]


def pii_texts():
    rnd = random.Random(6)
    parts = ["a@b.c", "x.y@z", "@", ".", "..", "%", " ", "-", "é", "😀", "1.2.3.4", "999.1.1.1", "0001.2.3.255", "4111 1111 1111 1111", "4111111111111112", "+1 (212) 555-0100",
             "+", "12", "(", ")", "\n", "word", "5500-0000-0000-0004", "+49 30 123456", "378282246310005", "a+b@c-d.example.com"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14))) for _ in range(400)]
    texts += [None, "", "no data", "a@b.c.d@e.f.g@h", "1.2.3.4.5.6.7.8", "a@b.c " * 300, "9" * 5000, "a" * 20000 + "@", "+1" + "(" * 3000 + "2", "1 " * 3000]
    return texts


def test_personal_data(spark, none):
    texts = pii_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    model = pii.learn(docs)
    rows = pii.personal_data(docs, model).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = [(pii.KINDS[s.kind_no], s.start, s.end) for s in r.chosen if s.base]
        assert base == plain_spans(texts[r.doc_id] or ""), texts[r.doc_id]
        further = [s for s in r.chosen if not s.base]
        assert not any(a.start < b.end and b.start < a.end for a in further for b in r.chosen if a is not b)
    clean = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    for r in rows:
        text = texts[r.doc_id]
        if text is None or not r.chosen:
            assert clean[r.doc_id] == text
            continue
        out, at = [], 0
        for s in sorted(r.chosen, key=lambda s: (s.start, s.end, s.kind_no)):
            if s.start >= at or not out:
                out += [text[at : s.start], f"[{pii.KINDS[s.kind_no].upper()}]"]
                at = s.end
            else:
                at = max(at, s.end)
        assert clean[r.doc_id] == "".join([*out, text[at:]])
    empty = none.select("doc_id", "text")
    assert pii.learn(empty) == {"trees": [], "cuts": {}} and pii.redact(none, model).columns == none.columns and pii.personal_data(empty, model).count() == 0


def test_personal_data_finds_further_forms(spark):
    rows = [(i, t) for i, t in enumerate(pii_texts() * 3)] + [(9000, "write to jane (at) example (dot) org"), (9001, "call (212) 555-0100 now"), (9002, "see 12.5 and 3-4")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.chosen for r in pii.personal_data(docs, pii.learn(docs)).where("doc_id >= 9000").collect()}
    assert all(s.end <= len(dict(rows)[d]) for d, spans in found.items() for s in spans) and not found[9002]


def test_personal_data_without_digit_or_at_sign_is_a_candidate(spark):
    rows = [(0, "write to jane (at) example (dot) org"), (1, "host abcd:abcd:abcd:abcd:abcd:abcd:abcd:abcd up"), (2, "no data (at all)")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: [(s.kind_no, s.start, s.end) for s in r["__spans"]] for r in pii.candidates(docs, "text").collect()}
    assert found == {0: [(0, 9, 36)], 1: [(1, 5, 44)], 2: []}


def test_personal_data_decides_further_forms_by_their_own_checks(spark):
    yes = ["write to jane (at) example (dot) org", "call (212) 555-0100 now", "card 4111.1111.1111.1111 ok", "host 2001:0db8:0000:0000:0000:ff00:0042:8329 up", "host dead:beef:dead:beef:dead:beef:dead:beef up"]
    no = ["sold jane (at) version.2 now", "call 00124 1234-1234 1234 now", "card 4111.1111.1111.1112 ok", "disk 00:11:22:33:44:55:66:77 up", "jane.(at) example.org"]
    rows = [(i, t) for i, t in enumerate(pii_texts() * 3)] + [(9000 + i, t) for i, t in enumerate(yes)] + [(9100 + i, t) for i, t in enumerate(no)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for model in (pii.learn(docs), {"trees": [], "cuts": {}}):
        found = {r.doc_id: [(pii.KINDS[s.kind_no], s.start, s.end) for s in r.chosen] for r in pii.personal_data(docs, model).where("doc_id >= 9000").collect()}
        kinds = [("email", 9, 36), ("phone", 5, 19), ("card", 5, 24), ("ip", 5, 44), ("ip", 5, 44)]
        assert [found[9000 + i] for i in range(len(yes))] == [[k] for k in kinds]
        assert not any(found[9100 + i] for i in range(len(no)))


def test_personal_data_is_selected_by_trees_and_thresholds(spark):
    rows = [(i, t) for i, t in enumerate(pii_texts() * 3)] + [(9000, "call (212) 555-0100 now or write to jane (at) example (dot) org"), (9001, "a@b.c and card 4111.1111.1111.1111")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = pii.learn(docs)
    assert model["trees"] and set(model["cuts"]) == {0, 1, 2, 3} and all(0 < c <= 1 for c in model["cuts"].values())
    assert pii.learn(docs.repartition(5)) == model
    asked = docs.where("doc_id >= 9000")
    kinds = lambda m: {r.doc_id: [s.kind_no for s in r.chosen] for r in pii.personal_data(asked, m).collect()}
    assert kinds(model) == {9000: [0, 3], 9001: [0, 2]}
    assert kinds({**model, "cuts": {**model["cuts"], 2: 1.5, 3: 1.5}}) == {9000: [0], 9001: [0]}  # a threshold that no score reaches


def test_examples_of_personal_data_are_well_formed_or_broken(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(pii_texts())], "id bigint, text string")
    found = {(r.kind, r.y): (r.low, r.high, r.n) for r in pii.examples(docs).groupBy("kind", "y").agg(F.min("valid").alias("low"), F.max("valid").alias("high"), F.count("*").alias("n")).collect()}
    assert set(found) == {(float(k), y) for k in range(4) for y in (0.0, 1.0)}
    assert all(low == high == y and n > 50 for (_, y), (low, high, n) in found.items())


def test_bounded_sample(spark):
    rows = [(1, "same")] * 3000 + [(2, f"text {i}") for i in range(3000)] + [(None, f"none {i}") for i in range(1000)] + [(None, None)] * 1000
    df = spark.createDataFrame(rows, "id bigint, text string").repartition(4)
    key = lambda rows: sorted((r.id is None, r.id or 0, r.text or "") for r in rows)
    some = bounded_sample(df, 200).collect()
    assert len(some) == 200 == len({(r.id, r.text) for r in some}) and key(some) == key(bounded_sample(df.repartition(7), 200).collect())
    assert len(bounded_sample(df, 100_000).collect()) == 4002 and len(bounded_sample(df.where("id = 1"), 2000).collect()) == 1
    assert bounded_sample(df.where("false"), 10).count() == 0 and bounded_sample(df, 1).count() == 1


def test_vectors(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(12, 16))
    x = [centres[i % 12] + rnd.normal(size=16) * rnd.choice([0.02, 0.12, 0.3]) for i in range(240)]
    rows = [(i * 2, [float(np.float32(v)) for v in e], int(i % 12) % 3) for i, e in enumerate(x)]
    rows += [(1001 + i, rows[5][1], rows[5][2]) for i in range(4)]
    rows += [(2001, None, 1), (2003, [0.0] * 16, 1), (2005, [float("nan")] * 16, 1), (2007, [None] * 16, 1), (2009, rows[0][1], None), (None, rows[0][1], rows[0][2]), (2011, [], 1),
             (2013, [1.0, 0.0], 1), (2015, [2.0, 0.0], 1), (2017, [float("inf"), 1.0], 1), (2019, [1e-30, 0.0], 1), (1, [-v for v in rows[3][1]], rows[3][2])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(4)
    able = [i for i, (d, e, c) in enumerate(rows) if d is not None and c is not None and e and all(v is not None and math.isfinite(v) for v in e) and any(np.float32(v) != 0 for v in e)]
    u = {i: np.array(rows[i][1], np.float32).astype(float) for i in able}
    u = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in u.items()}
    pairs = [(i, j) for i in able for j in able if i < j and rows[i][2] == rows[j][2] and len(u[i]) == len(u[j]) and float(u[i] @ u[j]) >= 0.98]
    links, roots = Counter(i for p in pairs for i in p), linked(len(rows), pairs)
    for tile in (7, 1024):
        got = {r.vec_id: r for r in vectors.near_duplicates(df, tile=tile).collect()}
        for i, (d, _, _) in enumerate(rows):
            least = min(rows[j][0] for j in range(len(rows)) if roots[j] == roots[i] and rows[j][0] is not None) if d is not None else None
            assert (got[d].n_links, got[d].component_id, got[d].kept) == (links[i], least, d is not None and d == least)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_quantisation_bound_holds():
    x = vectors.unit(np.random.default_rng(1).normal(size=(200, 1500)))
    q, scale, error = vectors.quantised(x)
    near = vectors.product(q, q) * scale[:, None] * scale[None, :]
    bound = (1 + error[:, None]) * error[None, :] + error[:, None] + vectors.SLACK
    assert (np.abs(x @ x.T - near) <= bound).all()


@pytest.fixture(scope="module")
def coder():
    return bpe.public_ranks()


def test_tokens(spark, docs, none, coder):
    tiktoken = pytest.importorskip("tiktoken")
    ranks, pattern = coder
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    given = Counter((r.doc_id, tuple(other.encode_ordinary(r.text or "")), r.text or "") for r in docs.collect())
    packed = bpe.encoded(docs, ranks, pattern)
    texts = {r.doc_id: r.text for r in bpe.decoded(packed, ranks).collect()}
    got = Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in packed.collect())
    assert got == Counter({(d, ids): sum(n for (e, i, _), n in given.items() if (e, i) == (d, ids)) for d, ids, _ in given})
    assert all(texts[d] == t for d, _, t in given if d is not None)
    trip = bpe.round_trip(docs, ranks, pattern).collect()
    assert all(r.n_tokens * 4 == len(r.ids) and r.ids_sha256 == hashlib.sha256(r.ids).hexdigest() for r in trip)
    assert bpe.round_trip(none, ranks, pattern).count() == 0


def test_round_trip_decodes_a_stream_of_parts(spark, coder, monkeypatch):
    ranks, pattern = coder
    text = "añ 日本 😀🀄 \U0001f9ff end " * 40
    ids = np.frombuffer(bpe.Encoder(ranks, pattern).encode(text), "<u4")
    want = hashlib.sha256(text.encode()).hexdigest()
    assert all(bpe.decoded_digest(ids, bpe.token_list(ranks), part) == want for part in (1, 2, 7, bpe.PART))
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert bpe.round_trip(df, ranks, pattern).first().decoded_sha256 == want
    assert bpe.round_trip(df, ranks, pattern, max_moves=10).first() == bpe.round_trip(df, ranks, pattern).first()
    monkeypatch.setattr(bpe, "decoded_digest", lambda ids, tokens: f"{len(ids)} ids")
    assert bpe.round_trip(df, ranks, pattern).first().decoded_sha256 == f"{len(ids)} ids"


def test_transducer_with_small_stores_and_streams(coder):
    tiktoken = pytest.importorskip("tiktoken")
    ranks, pattern = coder
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(7)
    small, tiny = bpe.Encoder(ranks, pattern, max_pieces=20, max_moves=50), bpe.Encoder(ranks, pattern, max_moves=4)
    assert (tiny.machine.max_moves, tiny.machine.max_pairs, tiny.known.most) == (4, 2, 0)
    for _ in range(1500):
        text = "".join(rnd.choice(["a", "the", "é", "日本", " ", "\n", "0", "'s", "😀", "zz", chr(rnd.randint(1, 0x2FF))]) for _ in range(rnd.randint(0, 30)))
        assert np.frombuffer(small.encode(text), "<u4").tolist() == other.encode_ordinary(text)
        assert tiny.encode(text) == small.encode(text)
    machine = bpe.Transducer(ranks)
    piece = "".join(rnd.choice("abcdeé") for _ in range(5000)).encode()
    parts = list(machine.stream([piece[i : i + 7] for i in range(0, len(piece), 7)]))
    assert len(parts) > 3 and [t for p in parts for t in p] == other.encode_ordinary(piece.decode())


def test_utf8_machine():
    text = "aé日😀" * 5
    data = text.encode()
    for step in (1, 2, 3, 5):
        machine = bpe.Utf8()
        out = [machine.feed(data[i : i + step]) for i in range(0, len(data), step)]
        assert "".join(out) + machine.feed(b"", last=True) == text and "�" not in "".join(out)
    assert bpe.Utf8().feed(b"a\xe6", last=True) == "a�"
