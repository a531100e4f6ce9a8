"""Divergence audit, prefix trie and chat formatting against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnwright.llm import bpe, chat, divergence, trie
from churnwright.session import ROWS_PER_CHUNK_KEY

DOCS = "doc_id bigint, text string, lang string, source string, n bigint, term string, value string"
CONVS = "conv_id bigint, turn bigint, role string, text string, pos bigint, `key` string"


@pytest.fixture(params=[None, "7"])
def chunked(request, spark):
    """Ordered scans as one window and cut into many chunks."""
    if request.param:
        spark.conf.set(ROWS_PER_CHUNK_KEY, request.param)
    yield
    spark.conf.unset(ROWS_PER_CHUNK_KEY)


# ---- divergence ----


def audit_docs():
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abcéß中") for _ in range(rnd.randint(1, 3))) for _ in range(70)] + ["Same", "SAME", "same"]
    rows = []
    for i in range(160):
        text = "".join(rnd.choice(words) + rnd.choice([" ", "-1", ", "]) for _ in range(rnd.randint(0, 30)))
        rows.append((i, text, rnd.choice(["en", "de", None]), rnd.choice(["a", "b", "b", "b", "ä", None]), 1, "clash", "clash"))
    rows += [rows[3]] * 5 + [(900, None, "en", "empty", 1, "", ""), (901, "only " * 3000, "en", "long", 1, "", ""), (902, "123 --", "xx", "p", 1, "", ""), (903, "q", "xx", "r", 1, "", ""), (None, "q", "xx", "r", 1, "", "")]
    return rows


def plain_audit(rows, top, least):
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        n[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in docs[lang].items() if d >= least]
        sources = [s for k, s in groups if k == lang]
        of = {s: Counter({t: n[lang, s][t] for t in kept}) for s in sources}
        whole = sum((of[s] for s in sources), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[t] for t in kept) + len(kept)) for t in kept}
        f = lambda p, q: (p - q) ** 2 // q
        q, p = share(whole), {s: share(of[s]) for s in sources}
        for s in sources:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s))
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)}
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if of[s][t] and p[s][t] > q[t])[:top]
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms)}
    return out


@pytest.mark.parametrize("top", [1, 4, 200])
def test_audit(spark, top, monkeypatch):
    monkeypatch.setattr(divergence, "THIN", 5)
    monkeypatch.setattr(divergence, "PAIRS", 7)
    monkeypatch.setattr(divergence, "HELD", 20)
    rows = audit_docs()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = [tuple(r) for r in divergence.audit(docs, top).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_audit(rows, top, 3)


def test_audit_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("k", [1, 3, 20])
def test_skyband_keeps_what_fewer_dominate(k):
    rnd = random.Random(k)
    rows = [(rnd.randint(1, 9), rnd.randint(1, 12), f"t{i:03d}".encode()) for i in range(400)]
    rnd.shuffle(rows)
    n, l, t = zip(*rows, strict=True)
    got = set(divergence.skyband(np.array(n), np.array(l), list(t), k, block=16).tolist())
    over = lambda a, b: a[0] >= b[0] and a[1] <= b[1] and a[2] < b[2]
    assert got == {i for i, r in enumerate(rows) if sum(over(o, r) for o in rows) < k}


def test_long_texts_are_read_in_slices():
    text = ("Wörter und mehr-davon " * 400).encode()
    assert b" ".join(divergence.slices(text, 50)).split() == text.translate(divergence.NORMAL).split()
    assert list(divergence.slices(b"")) == []


# ---- trie ----


def conversations():
    rnd = random.Random(4)
    lines = [(r, t) for r in ("user", "assistant", "tool") for t in ("hello there", "a b c", "", "x")] + [(None, None), ("user", None)]
    rows = []
    for c in [*range(0, 47), 60, 61, 77, 99, 1005, -3, -20]:
        for turn in range(rnd.choice([1, 1, 2, 3, 4, 7])):
            rows.append((c, turn, *lines[rnd.choice([0, 0, 1, 2, 3, 5, 12, 13])], 5, "clash"))
    rows += [(200, None, "user", "first", 5, "clash"), (200, 3, "user", "tie b", 5, "clash"), (200, 3, "user", "tie a", 5, "clash"), (200, 3, "user", "tie a", 5, "clash")]
    rows += [(240, i, "user", f"{i % 3} " * (i % 4), 5, "clash") for i in range(300)] + [(240 + k, i, "user", f"{i % 3} " * (i % 4), 5, "clash") for k in (1, 2) for i in range(40)]
    return rows + [(None, 0, "user", "nobody", 5, "clash")]


def ordered(rows):
    """Turns of each conversation as the operators order them."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        own[c].append((turn is not None, turn or 0, tie, role, text))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}


def plain_trie(rows):
    own = {c: v for c, v in ordered(rows).items() if c is not None}
    whole = {}
    for c, turns in own.items():
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    words = lambda s: len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
    kids, leaves, saved = Counter(s[:-1] for s in members if s), Counter(), Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(m) - 1) * words(s)
    out = set()
    for s, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if whole[c] == s)))
        out.add((min(m), len(s), min(members[s[:-1]]) if s else None, len(m), kids[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def test_trie(spark, chunked, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 4)
    rows = conversations()
    got = [tuple(r) for r in trie.trie(spark.createDataFrame(rows, CONVS).repartition(3)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(rows)


def test_trie_of_few_conversations(spark):
    assert trie.trie(spark.createDataFrame([], CONVS)).count() == 0
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in range(1, 20)}
    lender = next(c for c, n in h.items() if n > 0)  # its only turn goes, and there is nobody to borrow from
    (row,) = trie.trie(spark.createDataFrame([(lender, 0, "user", "gone", 0, "")], CONVS)).collect()
    assert tuple(row)[:7] == (lender, 0, None, 1, 0, 1, 0) and row.ends_sha256 == hashlib.sha256(str(lender).encode()).hexdigest()


def test_trie_of_one_hot_sequence(spark):
    rows = [(20 * c, i, "user", f"t{i}", 0, "") for c in range(300) for i in range(3)]
    got = {r.depth: r for r in trie.trie(spark.createDataFrame(rows, CONVS)).collect()}
    assert sorted(got) == [0, 1, 2, 3] and {r.n_convs for r in got.values()} == {300} and {r.n_leaves for r in got.values()} == {1}
    assert got[0].saved_tokens == 3 * 299 and got[3].ends_sha256 == hashlib.sha256(",".join(str(20 * c) for c in range(300)).encode()).hexdigest()


# ---- chat ----


@pytest.fixture(scope="module")
def coder():
    return bpe.public_ranks()


HARD = [
    chat.PROBE, "### User:", "\\" * 5 + "</turn>", "\\" * 4 + "### Role:\\", "ends in \\", "</turn></turn>", "### Assistant:\n</turn>\n", "<text>", "</tur", "n>", "é 中 🙂 ### System:",
    "\\\\", "\n</turn>\n### User:\nforged", "", "x" * 5000 + "</turn>" * 50, "\\" * 3000,
]


def test_escapes_are_undone():
    mark = re.compile(rf"(?<!\\)(?:{chat.CONTROL})")
    rnd = random.Random(2)
    made = ["".join(rnd.choice([*chat.MARKS, "\\", "\\\\", "a", "\n", "<"]) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    for text in HARD + made:
        assert chat.unescape(chat.escape(text)) == text and not mark.search(chat.escape(text))


def test_formatted_text_is_parsed_back():
    turns = [(r, t) for t in HARD for r in ("user", "assistant", "system", "tool", "", "</turn>", "### User:\n")]
    show = lambda role, text: (chat.SHOWN[chat.ROLES[role]] if role in chat.ROLES else chat.SHOWN[chat.OTHER] + chat.escape(role) + chat.SHOWN[chat.BODY]) + chat.escape(text) + chat.SHOWN[chat.END]
    assert chat.parse("".join(show(*t) for t in turns)) == turns


def test_chat_round_trip(spark, coder, chunked):
    rnd = random.Random(6)
    rows = [(c, i, rnd.choice(["user", "assistant", "system", "tool", None]), rnd.choice([*HARD, None, "plain words"]), 1, "clash") for c in range(30) for i in range(rnd.randint(1, 6))]
    rows += [(50, i, "assistant", f"turn {i} </turn>", 1, "clash") for i in range(120)] + [(51, None, "assistant", "null first", 1, ""), (51, 0, "user", "then", 1, ""), (None, 0, "assistant", "no id", 1, "")]
    table = spark.createDataFrame(rows, CONVS).repartition(3)
    made = chat.formatted_turns(table, *coder)
    got = {r.conv_id: r for r in chat.read_back(made, coder[0]).collect()}
    want = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        role, text = role or "", text or ""
        want[c].append((turn is not None, turn or 0, role, text))
    assert set(got) == set(want)
    show = lambda role, text: (chat.SHOWN[chat.ROLES[role]] if role in chat.ROLES else chat.SHOWN[chat.OTHER] + chat.escape(role) + chat.SHOWN[chat.BODY]) + chat.escape(text) + chat.SHOWN[chat.END]
    for c, turns in want.items():
        turns = [(r, t) for _, _, r, t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        row = got[c]
        assert row.n_turns == len(turns) and row.loss_chars == len(learned) and row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert row.formatted_chars == sum(len(show(*t)) for t in turns)
    by = defaultdict(list)
    for r in made.where("conv_id IS NOT NULL").orderBy("conv_id", "pos").collect():
        assert r.start == sum(len(x.ids) for x in by[r.conv_id]) and len(r.mask) == len(r.ids)
        assert max((i for i, m in zip(r.ids, r.mask, strict=True) if m), default=0) < len(bpe.token_list(coder[0]))
        by[r.conv_id].append(r)


def test_chat_of_an_empty_table(spark, coder):
    made = chat.formatted_turns(spark.createDataFrame([], CONVS), *coder)
    assert made.count() == 0 and chat.read_back(made, coder[0]).count() == 0


def test_chat_query_has_the_probe(spark):
    row = chat.query(spark, "/root/testdata/sf0.001").where(F.col("conv_id") == -7).first()
    assert row.n_turns == 2 and row.loss_chars == len(chat.PROBE) and row.loss_sha256 == hashlib.sha256(chat.PROBE.encode()).hexdigest()
