"""Byte-level BPE as a lazily determinised transducer, and decoding by an incremental UTF-8 machine.

The text is cut into pieces by the pattern; each piece is encoded by itself. For a
piece read byte by byte, the encoding of every prefix ends in exactly one token that
fits its predecessor: ``fits(u, t)`` says that the merges turn the bytes of u and t
into u, t. A state of the transducer is the list of open starts: places from which
some token can still go on, each with its place in the trie of tokens and the token
before it. A move gives the token that the prefix ends in; what all open starts
share is certain and given out, a bounded stretch behind the reading place. States
and moves are made when first needed and kept; equal states are one state.

The whole piece being a token is that token. Pieces already met are looked up. At the
last byte of a piece only the token it ends in is asked for, so no state is made that
nothing goes on from. All stores are kept by a Python worker over its tasks and are
bounded. States, moves and pairs are emptied at a fixed size; of the pieces, those not
asked for during as many new ones are dropped, so that common ones stay. None of this
changes a result.

The ranks are read by the driver and sent to the tasks; a vocabulary has a fixed,
known size. Rows: a null text is empty and has no tokens. Repeated rows give one
output row each.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnwright.llm.common import map_rows, table, text_bytes

MAX_MOVES = 400_000  # moves kept by a worker, about 130 MB with all that goes with them; results do not depend on it
MOVES_PER_PIECE, MOVES_PER_PAIR = 5, 2  # new pieces after which those not asked for meanwhile go, and pairs kept, as parts of the moves
PART = 4096  # ids decoded at a time
# An open start is its place in the trie and the token before it, a move the next state and a token: each pair in one number.
LOW_BITS = 24
LOW = (1 << LOW_BITS) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Encodes one piece at a time by the given ranks."""

    def __init__(self, ranks: dict[bytes, int], max_moves: int = MAX_MOVES):
        self.ranks, self.max_moves, self.max_pairs = ranks, max_moves, max_moves // MOVES_PER_PAIR
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.child: dict[int, int] = {}  # trie: node * 256 + byte
        self.token: list[int] = [-1]  # token that ends in a node
        self.depth: list[int] = [0]
        self.inner: list[bool] = [False]  # whether a node has children
        for token, rank in ranks.items():
            node = 0
            for b in token:
                self.inner[node] = True
                at = node << 8 | b
                if (nxt := self.child.get(at)) is None:
                    nxt = self.child[at] = len(self.token)
                    self.token.append(-1)
                    self.depth.append(self.depth[node] + 1)
                    self.inner.append(False)
                node = nxt
            self.token[node] = rank
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        """Forget all states and moves."""
        start = (LOW,)
        self.number = {start: 0}
        self.states = [start]
        self.moves: dict[int, int] = {}
        self.pairs.clear()

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``: itself twice for a byte, None if merges never make it."""
        if token not in self.halves:
            text = self.bytes_of[token]
            parts = [text[i : i + 1] for i in range(len(text))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == 1 << 60:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            made = [self.ranks[p] for p in parts]
            self.halves[token] = (made[0], made[-1]) if len(made) <= 2 else None
        return self.halves[token]

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` can follow ``before`` (LOW: nothing) in an encoding.

        It can unless a merge across the border comes before one that hides it:
        the merges inside the two tokens are undone from the last one backwards,
        and the parts that then face each other must not merge earlier.
        """
        if self.split(token) is None:
            return False
        if before == LOW:
            return True
        if (known := self.pairs.get(before << LOW_BITS | token)) is None:
            if len(self.pairs) >= self.max_pairs:
                self.pairs.clear()
            known = self.pairs[before << LOW_BITS | token] = self.apart(before, token)
        return known

    def apart(self, left: int, right: int) -> bool:
        limit = 1 << 60
        while True:
            if self.ranks.get(self.bytes_of[left] + self.bytes_of[right], limit) < limit:
                return False
            whole_left, whole_right = len(self.bytes_of[left]) == 1, len(self.bytes_of[right]) == 1
            if whole_left and whole_right:
                return True
            if whole_right or (left > right and not whole_left):
                limit, left = left, self.split(left)[1]
            else:
                limit, right = right + 1, self.split(right)[0]

    def move(self, state: int, byte: int) -> int:
        """The next state, and the token in which the encoding of what has been read ends; made once."""
        opened, ended = [], None
        for start in self.states[state]:
            node, before = start >> LOW_BITS, start & LOW
            nxt = self.child.get(node << 8 | byte)
            if nxt is None:
                continue
            if ended is None and (token := self.token[nxt]) >= 0 and self.fits(before, token):
                ended = token
            if self.inner[nxt]:
                opened.append(nxt << LOW_BITS | before)
        if ended is None:
            raise ValueError("every single byte must be a token")
        key = (*opened, ended)
        if (to := self.number.get(key)) is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        self.moves[state << 8 | byte] = made = to << LOW_BITS | ended
        return made

    def ending(self, state: int, byte: int) -> int:
        """The token in which the encoding ends if this byte is the last one."""
        if (made := self.moves.get(state << 8 | byte)) is not None:
            return made & LOW
        for start in self.states[state]:
            nxt = self.child.get(start >> LOW_BITS << 8 | byte)
            if nxt is not None and (token := self.token[nxt]) >= 0 and self.fits(start & LOW, token):
                return token
        raise ValueError("every single byte must be a token")

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one piece."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        if len(piece) > 8 * self.longest:
            return [token for part in self.stream([piece]) for token in part]
        if len(self.moves) >= self.max_moves:
            self.reset()
        state, last, moves = 0, [], self.moves
        for byte in piece[:-1]:
            made = moves.get(state << 8 | byte)
            if made is None:
                made = self.move(state, byte)
            state = made >> LOW_BITS
            last.append(made & LOW)
        if piece:
            last.append(self.ending(state, piece[-1]))
        return self.back(last, len(last))

    def stream(self, parts: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of one piece that comes in parts, given out as soon as they are certain."""
        state, last, moves = 0, [], self.moves
        wait = 8 * self.longest
        for part in parts:
            for byte in part:
                made = moves.get(state << 8 | byte)
                if made is None:
                    if len(moves) >= self.max_moves:
                        state = self.forget(state)
                    made = self.move(state, byte)
                    moves = self.moves
                state = made >> LOW_BITS
                last.append(made & LOW)
                if len(last) >= wait:
                    sure = self.certain(state, last)
                    if sure:
                        yield self.back(last, sure)
                        del last[:sure]
                    wait = len(last) + 8 * self.longest
        yield self.back(last, len(last))

    def forget(self, state: int) -> int:
        """Empty the store of states and moves, but for this state."""
        key = self.states[state]
        self.reset()
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
        return self.number[key]

    def certain(self, state: int, last: list[int]) -> int:
        """How much of what has been read is cut alike whatever follows: where all open starts lead back to."""
        places = {len(last) - self.depth[start >> LOW_BITS] for start in self.states[state]}
        while len(places) > 1:
            latest = max(places)
            places.remove(latest)
            places.add(max(0, latest - len(self.bytes_of[last[latest - 1]])))
        return max(0, places.pop())

    def back(self, last: list[int], at: int) -> list[int]:
        """The tokens of the first ``at`` bytes, read back from the end."""
        out = []
        while at > 0:
            out.append(last[at - 1])
            at -= len(self.bytes_of[last[at - 1]])
        return out[::-1]


def ascii_form(pattern: str) -> str | None:
    """The pattern as it reads on ASCII text, for the plain matcher; None if it names more than letters, numbers and white space."""
    inside = False
    out = []
    for part in re.findall(r"\\p\{[^}]*\}|\\.|.", pattern, re.DOTALL):
        if part in ("[", "]"):
            inside = part == "["
        if part.startswith("\\p"):
            if part not in ASCII_KINDS:
                return None
            part = ASCII_KINDS[part] if inside else f"[{ASCII_KINDS[part]}]"
        out.append(part)
    return "".join(out)


ASCII_KINDS = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}


class Encoder:
    """Encodes texts to packed ids: little-endian unsigned 32-bit numbers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_pieces: int | None = None, max_moves: int = MAX_MOVES):
        self.machine, self.tokens = Transducer(ranks, max_moves), token_list(ranks)
        self.cut = self.cut_ascii = regex.compile(pattern).findall
        if (plain := ascii_form(pattern)) is not None:
            self.cut_ascii = re.compile(plain, re.ASCII).findall
        self.known = Known(self.machine, max_moves // MOVES_PER_PIECE if max_pieces is None else max_pieces)

    def encode(self, text: str) -> bytes:
        cut = self.cut_ascii if text.isascii() else self.cut
        out = b"".join(map(self.known.__getitem__, cut(text)))
        self.known.age()
        return out


class Known(dict):
    """Packed ids by piece, encoded when first asked for.

    Two generations: when the young one is full it becomes the old one, and what
    was old and has not been asked for since goes.
    """

    def __init__(self, machine: Transducer, most: int):
        super().__init__()
        self.machine, self.most = machine, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", self.machine.encode(piece.encode()))
            if sys.byteorder == "big":
                ids.byteswap()
            ids = ids.tobytes()
        if len(piece) <= 64:
            self[piece] = ids
            if len(self) >= 2 * self.most:  # within one very long text
                self.age()
        return ids

    def age(self) -> None:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()


class Utf8:
    """Bytes in, complete characters out; an unfinished character waits for its rest."""

    def __init__(self) -> None:
        self.rest = b""

    def feed(self, part: bytes, last: bool = False) -> str:
        data = self.rest + part
        open_at = len(data)
        if not last:
            for back in range(1, min(3, len(data)) + 1):
                byte = data[-back]
                if byte & 0xC0 == 0x80:  # goes on
                    continue
                need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
                if need > back:
                    open_at = len(data) - back
                break
        self.rest = data[open_at:]
        return data[:open_at].decode("utf-8", "replace")


def decode_stream(parts: Iterable[Iterable[int]], tokens: list[bytes]) -> Iterator[str]:
    """Text of a stream of ids as soon as its characters are complete."""
    machine = Utf8()
    for part in parts:
        yield machine.feed(b"".join(tokens[i] for i in part))
    yield machine.feed(b"", last=True)


def in_parts(ids: np.ndarray, part: int = PART) -> Iterator[list[int]]:
    return (ids[at : at + part].tolist() for at in range(0, len(ids), part))


def decoded_digest(ids: np.ndarray, tokens: list[bytes], part: int = PART) -> str:
    """SHA-256 of the text of ``ids``, decoded as a stream of ``part`` ids at a time."""
    digest = hashlib.sha256()
    for text in decode_stream(in_parts(ids, part), tokens):
        digest.update(text.encode("utf-8"))
    return digest.hexdigest()


def worker_encoder(ranks: dict[bytes, int], pattern: str, kept: dict, max_moves: int = MAX_MOVES) -> Encoder:
    """The worker's encoder: a broadcast value stays in a Python worker from task to task."""
    if "encoder" not in kept:
        kept["encoder"] = Encoder(ranks, pattern, max_moves=max_moves)
    return kept["encoder"]


def token_list(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def encoded(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row: packed ids."""
    held = docs.sparkSession.sparkContext.broadcast((ranks, pattern, {}))

    def make() -> Callable[[list], list[tuple]]:
        coder = worker_encoder(*held.value)
        return lambda texts: [(coder.encode(t.decode("utf-8", "replace")),) for t in texts]

    return map_rows(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), make, "ids binary")


def decoded(rows: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) for rows of packed ids; a null ids is the empty text."""
    held = rows.sparkSession.sparkContext.broadcast(token_list(ranks))

    def make() -> Callable[[list], list[tuple]]:
        return lambda packed: [("".join(decode_stream(in_parts(np.frombuffer(p, "<u4")), held.value)),) for p in packed]

    return map_rows(rows.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{ids_col}`"), F.lit(b""))), make, "text string")


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, max_moves: int = MAX_MOVES) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, ids) for every row: encoded, and decoded again from the ids; without ``ids`` if not wanted.

    ``max_moves`` sets what each worker keeps; fewer moves take less memory and more time.
    """
    held = docs.sparkSession.sparkContext.broadcast((ranks, pattern, {}))

    def make() -> Callable[[list], list[tuple]]:
        coder = worker_encoder(*held.value, max_moves)

        def one(text: bytes) -> tuple:
            packed = coder.encode(text.decode("utf-8", "replace"))
            back = decoded_digest(np.frombuffer(packed, "<u4"), coder.tokens)
            found = len(packed) // 4, hashlib.sha256(packed).hexdigest(), back
            return (*found, packed) if with_ids else found

        return lambda texts: [one(t) for t in texts]

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return map_rows(docs.select(F.col(f"`{id_col}`"), text_bytes(text_col)), make, schema)


def public_ranks() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def query(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"), *public_ranks(), with_ids=False)
