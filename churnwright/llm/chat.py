r"""Chat formatting by token-level assembly.

Every turn becomes a row of token ids. Its role and its text are encoded as segments of
their own, and ids beyond the vocabulary are spliced between them for the marks of the
template, so that no content can ever be taken for a mark:

    ### Assistant:          the marks of system, user and assistant
    the text
    </turn>

    ### Role:               any other role is content, too
    the role
    <text>
    the text
    </turn>

Control strings that occur in a role or text are escaped, so that the formatted text can
be read back as well: n backslashes before a control string become 2n + 1. A control
string is a mark only where no backslash stands before it, which holds for marks, as
each follows a line end.

Where learning starts and ends is kept as places in the turn's tokens; the mask is the
running sum of starts less ends, over the whole conversation: an ordered scan carries
the sum, and the place of the turn's first token, from turn to turn. So no conversation,
of whatever length, needs to be in one task to be formatted. ``read_back`` streams the
turns of a conversation in order and keeps two hash states.

Rows: a null role or text is empty; a null turn comes first; turns of the same number go
by their content. Repeated rows are repeated turns. Rows without a conversation id are
one conversation of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.bpe import public_ranks, token_list, worker_encoder
from churnwright.llm.common import pieces, table, text_bytes, written
from churnwright.operators.ordered import ordered_scan

#: The marks, in the order of their ids.
MARKS = ["### System:", "### User:", "### Assistant:", "### Role:", "<text>", "</turn>"]
SYSTEM, USER, ASSISTANT, OTHER, BODY, END = range(len(MARKS))
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
#: What a mark looks like in the formatted text.
SHOWN = ["### System:\n", "### User:\n", "### Assistant:\n", "### Role:\n", "\n<text>\n", "\n</turn>\n"]
CONTROL = "|".join(map(re.escape, MARKS))
# A run of backslashes is only tried from its start, so that long runs cost no more than their length.
BARE = re.compile(rf"(?<!\\)(\\*)({CONTROL})")
ESCAPED = re.compile(rf"(?<!\\)(\\+)({CONTROL})")
TAUGHT = "assistant"


def escape(text: str) -> str:
    return BARE.sub(lambda m: m[1] * 2 + "\\" + m[2], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1][: (len(m[1]) - 1) // 2] + m[2], text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    names = {mark: role for role, mark in ROLES.items()}
    out, at = [], 0
    # a mark that begins with a line end may follow a backslash; the others follow a line end
    mark = re.compile("|".join(("" if s[0] == "\n" else r"(?<!\\)") + re.escape(s) for s in SHOWN))
    while at < len(formatted):
        head = mark.match(formatted, at)
        kind, at = SHOWN.index(head[0]), head.end()
        if kind == OTHER:
            body = mark.search(formatted, at)
            role, at = unescape(formatted[at : body.start()]), body.end()
        else:
            role = names[kind]
        end = mark.search(formatted, at)
        out.append((role, unescape(formatted[at : end.start()])))
        at = end.end()
    return out


def assembled(role: str, text: str, encode: Callable[[str], bytes], first: int) -> tuple[np.ndarray, list[int], list[int]]:
    """The ids of a turn, marks from ``first`` on, and where learning starts and ends in them."""
    segment = lambda s: np.frombuffer(encode(escape(s)), "<u4").astype(np.int32)
    mark = lambda *kinds: np.array([first + k for k in kinds], np.int32)
    head = mark(ROLES[role]) if role in ROLES else np.concatenate([mark(OTHER), segment(role), mark(BODY)])
    body = segment(text)
    taught = role == TAUGHT
    return np.concatenate([head, body, mark(END)]), [len(head)] * taught, [len(head) + len(body)] * taught


def formatted_turns(
    conversations: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, pos, start, ids, mask) for every turn: its place, that of its first token in the conversation, its ids and the loss mask (0 or 1 per id)."""
    held = conversations.sparkSession.sparkContext.broadcast((ranks, pattern, {}))
    first = len(token_list(ranks))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(*held.value).encode
        for batch in batches:
            for piece in pieces(batch):
                made = [
                    assembled(role.decode("utf-8", "replace"), text.decode("utf-8", "replace"), encode, first)
                    for role, text in zip(piece.column("role").to_pylist(), piece.column("text").to_pylist(), strict=True)
                ]
                ids, opens, closes = zip(*made, strict=True)
                lists = [pa.array(c, pa.list_(pa.int32())) for c in (ids, opens, closes)]
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in ("conv_id", "turn", "tie")], *lists], names=["conv_id", "turn", "tie", "ids", "opens", "closes"])

    rows = conversations.select(
        F.col(f"`{id_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.sha2(F.concat(text_bytes(role_col), F.lit("\n").cast("binary"), text_bytes(text_col)), 256)).alias("tie"),
        text_bytes(role_col).alias("role"),
        text_bytes(text_col).alias("text"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = f"conv_id {kinds['conv_id']}, turn {kinds['turn']}, tie binary, ids array<int>, opens array<int>, closes array<int>"
    tokens = written(rows.mapInArrow(encoded, schema), "chat-tokens")
    sums = {"start": F.size("ids").cast("long"), "open": (F.size("opens") - F.size("closes")).cast("long")}
    placed = ordered_scan(tokens, ["turn", "tie"], ["conv_id"], position="pos", before=sums)
    return masked(placed.select("conv_id", "pos", "start", "ids", "opens", "closes", "open"))


def masked(placed: DataFrame) -> DataFrame:
    """The loss mask of every turn by the running sum of starts less ends, from what earlier turns left open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                masks = []
                lists = [piece.column(c).to_pylist() for c in ("opens", "closes", "open")]
                sizes = pa.compute.list_value_length(piece.column("ids")).to_pylist()
                for size, opens, closes, before in zip(sizes, *lists, strict=True):
                    step = np.zeros(size + 1, np.int32)
                    step[0] = before
                    np.add.at(step, opens, 1)
                    np.subtract.at(step, closes, 1)
                    masks.append((np.cumsum(step[:-1]) > 0).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*[piece.column(c) for c in ("conv_id", "pos", "start", "ids")], pa.array(masks, pa.list_(pa.int32()))], names=["conv_id", "pos", "start", "ids", "mask"])

    kinds = {f.name: f.dataType.simpleString() for f in placed.schema.fields}
    return placed.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in ("conv_id", "pos", "start", "ids")), "mask array<int>"]))


class Reader:
    """What one conversation's tokens say, taken in turn by turn."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def feed(self, ids: np.ndarray, mask: np.ndarray, tokens: list[bytes]) -> None:
        first = len(tokens)
        marks = np.flatnonzero(ids >= first).tolist()
        text = lambda part: b"".join(map(tokens.__getitem__, part.tolist())).decode("utf-8", "replace")
        kinds = [int(ids[m]) - first for m in marks]
        segments = [text(ids[a + 1 : b]) for a, b in zip(marks, marks[1:], strict=False)]
        role = unescape(segments[0]) if kinds[0] == OTHER else next(r for r, k in ROLES.items() if k == kinds[0])
        self.turns.update(f"{role}\n{unescape(segments[-1])}\n".encode())
        self.n_turns += 1
        self.formatted_chars += sum(len(SHOWN[k]) for k in kinds) + sum(map(len, segments))
        learned = unescape(text(ids[mask.astype(bool)]))
        self.loss.update(learned.encode())
        self.loss_chars += len(learned)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def read_back(formatted: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation, from its tokens and masks alone."""
    held = formatted.sparkSession.sparkContext.broadcast(token_list(ranks))
    kind = formatted.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader, conv_type = None, None, None

        def given(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(columns[0], conv_type), *[pa.array(c, t) for c, t in zip(columns[1:], types, strict=True)]], names=names)

        for batch in batches:
            conv_type = batch.schema.field(0).type
            done = []
            for piece in pieces(batch):
                convs, ids, masks = piece.column("conv_id").to_pylist(), piece.column("ids"), piece.column("mask")
                for i, conv in enumerate(convs):
                    if reader is None or conv != now:
                        if reader is not None:
                            done.append((now, *reader.row()))
                        now, reader = conv, Reader()
                    reader.feed(ids[i].values.to_numpy(), masks[i].values.to_numpy(), held.value)
            if done:
                yield given(done)
        if reader is not None:
            yield given([(now, *reader.row())])

    rows = formatted.select("conv_id", "pos", "ids", "mask").repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    return rows.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


#: The contract's extra conversation.
PROBE = r"\### Assistant: </turn> ok"


def query(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_ranks()
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    return read_back(formatted_turns(rows.unionByName(probe), ranks, pattern), ranks)


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(regexp_replace(text, '(\\*)(### (?:System|User|Assistant|Role):|<text>|</turn>)', '\1\1\\\2', 'g')) AS body,
         CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15
              ELSE 10 + 8 + length(regexp_replace(role, '(\\*)(### (?:System|User|Assistant|Role):|<text>|</turn>)', '\1\1\\\2', 'g')) END AS head
  FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(body + head + 9) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
