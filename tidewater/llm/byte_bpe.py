"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

Every prefix of a piece of text has one encoding, and it ends in one token;
the token that ends a longer prefix is the one suffix token that may stand
after the token that ends the prefix before it. So the encoder reads bytes
from left to right and keeps the live positions: those from which some token
may still go on, each with the tokens that lead to it. Tokens that lead to
all of them are settled and emitted. A position is dead at the latest when
the longest token is passed, so lookahead and state are bounded. States and
transitions are made when first needed and then looked up.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column_named, pieces

#: What a worker remembers at most: pieces (half of them are dropped at a time), states (up to
#: twice as many within one very long piece), pairs of tokens, parts of tokens, decoder moves.
#: With 50,000 tokens that is about 300 MB.
MAX_PIECES, MAX_STATES, MAX_FITS, MAX_SPINES, MAX_MOVES = 500_000, 300_000, 300_000, 20_000, 100_000
NO_TOKEN = -1


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 bytes and rank."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


class Transducer:
    """Encodes one piece of bytes at a time; shared by all pieces of a worker."""

    def __init__(self, ranks: dict[bytes, int], share: float = 1.0):
        self.share = share  # of the bounds above
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        # the prefixes of all tokens as nodes (0: no bytes), by 256 * node + byte, and the token that a node is
        self._after: dict[int, int] = {}
        self._token: list[int] = [NO_TOKEN]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                to = self._after.get(node << 8 | byte)
                if to is None:
                    to = self._after[node << 8 | byte] = len(self._token)
                    self._token.append(NO_TOKEN)
                node = to
            self._token[node] = rank
        self._spines: dict[tuple[int, bool], list[tuple[bytes, float]]] = {}
        self._fits: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self._number: dict[tuple, int] = {}
        self._states: list[tuple] = []
        self._paths: dict[tuple[int, ...], tuple[int, ...]] = {}
        self._next: dict[int, int] = {}  # by 256 * state + byte; ~state if tokens are emitted on the way
        self._emits: dict[int, tuple[int, ...]] = {}
        self._add((NO_TOKEN, 0, ()))

    # -- which token may follow which ------------------------------------
    def _last_merge(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts that the token's own last merge joins."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(((self.ranks.get(parts[i] + parts[i + 1], np.inf), i) for i in range(len(parts) - 1)))
            if best[0] == np.inf:
                raise ValueError(f"no merges lead to the token {token!r}")
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts[0], parts[1]

    def _spine(self, token: int, right: bool) -> list[tuple[bytes, float]]:
        """Parts at the right (left) edge while the token grows: each with the
        rank at which the next larger one replaces it."""
        have = self._spines.get((token, right))
        if have is None:
            part, have, until = self.bytes_of[token], [], np.inf
            while True:
                have.append((part, until))
                if len(part) == 1:
                    break
                until = self.ranks[part]
                part = self._last_merge(part)[right]
            have.reverse()
            if len(self._spines) >= self.share * MAX_SPINES:
                self._spines.clear()
            self._spines[(token, right)] = have
        return have

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left``: no merge crosses the boundary
        before both are complete (equal ranks merge from the left)."""
        have = self._fits.get(left << 32 | right)
        if have is None:
            a, b, i, j = self._spine(left, True), self._spine(right, False), 0, 0
            while True:
                cross = self.ranks.get(a[i][0] + b[j][0], np.inf)
                if cross < a[i][1] and cross <= b[j][1]:
                    have = cross == np.inf
                    break
                if a[i][1] == np.inf and b[j][1] == np.inf:
                    have = True
                    break
                if a[i][1] <= b[j][1]:
                    i += 1
                else:
                    j += 1
            if len(self._fits) >= self.share * MAX_FITS:
                self._fits.clear()
            self._fits[left << 32 | right] = have
        return have

    # -- states ----------------------------------------------------------
    # A state is (before, node, path, node, path, ...): the live positions in
    # ascending order, each as the node of the bytes since and the tokens
    # between the last emitted one and the position. Before is the last
    # emitted token, kept only while a position has no token of its own.
    def _add(self, state: tuple) -> int:
        number = self._number.get(state)
        if number is None:
            number = self._number[state] = len(self._states)
            self._states.append(state)
        return number

    def _step(self, number: int, byte: int) -> int:
        state, after, tokens = self._states[number], self._after, self._token
        before, live, end = state[0], [], None
        for k in range(1, len(state), 2):
            node = after.get(state[k] << 8 | byte)
            if node is None:
                continue
            path = state[k + 1]
            live += (node, path)
            if end is None and tokens[node] != NO_TOKEN:
                token = tokens[node]
                left = path[-1] if path else before
                if left == NO_TOKEN or self.fits(left, token):
                    end = path + (token,)
        if end is None:
            raise ValueError("these ranks do not encode every prefix")
        live += (0, end)
        paths = live[1::2]
        same, emitted = 0, ()
        if all(paths):
            low, high = min(paths), max(paths)
            most = min(len(low), len(high))
            while same < most and low[same] == high[same]:
                same += 1
            if same:
                emitted = low[:same]
                before = emitted[-1]
                paths = [p[same:] for p in paths]
        if all(paths):
            before = NO_TOKEN
        known = self._paths
        live[1::2] = [known.setdefault(p, p) for p in paths]
        to = self._add((before, *live))
        if emitted:
            to = ~to
            self._emits[number << 8 | byte] = known.setdefault(emitted, emitted)
        self._next[number << 8 | byte] = to
        return to

    def encode(self, piece: bytes) -> array:
        if len(self._states) > self.share * MAX_STATES:
            self._reset()
        state, out, after, emits = 0, array("i"), self._next, self._emits
        for byte in piece:
            to = after.get(state << 8 | byte)
            if to is None:
                if len(self._states) > 2 * self.share * MAX_STATES:  # one very long piece
                    here = self._states[state]
                    self._reset()
                    state = self._add(here)
                    after, emits = self._next, self._emits
                to = self._step(state, byte)
            if to < 0:
                out.extend(emits[state << 8 | byte])
                to = ~to
            state = to
        out.extend(self._states[state][-1])
        return out


class PieceEncoder(dict):
    """Text piece to the bytes of its ids (32 bits each); common pieces are encoded once in a worker."""

    def __init__(self, transducer: Transducer, pattern: str):
        import regex
        super().__init__()
        self.transducer, self.split, self.older = transducer, regex.compile(pattern).findall, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.transducer.encode(piece.encode()).tobytes()
        if len(piece) <= 64:
            if len(self) >= self.transducer.share * MAX_PIECES / 2:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, self.split(text))), np.int32)


# -- decoding ------------------------------------------------------------
#: UTF-8 lead bytes, the bytes that follow, and the range of the first of them (Unicode, table 3-7).
UTF8 = [(0x00, 0x7F, 0, 0, 0), (0xC2, 0xDF, 1, 0x80, 0xBF), (0xE0, 0xE0, 2, 0xA0, 0xBF), (0xE1, 0xEC, 2, 0x80, 0xBF),
        (0xED, 0xED, 2, 0x80, 0x9F), (0xEE, 0xEF, 2, 0x80, 0xBF), (0xF0, 0xF0, 3, 0x90, 0xBF),
        (0xF1, 0xF3, 3, 0x80, 0xBF), (0xF4, 0xF4, 3, 0x80, 0x8F)]
_LEAD = {b: (more, lo, hi) for first, end, more, lo, hi in UTF8 for b in range(first, end + 1)}


def utf8_advance(pending: bytes, chunk: bytes) -> tuple[str, bytes]:
    """Text that is complete after ``chunk``, and the open bytes of the last character.

    Each longest broken sequence becomes one U+FFFD, as Unicode advises.
    """
    out, data, i = [], pending + chunk, 0
    while i < len(data):
        more, lo, hi = _LEAD.get(data[i], (-1, 0, 0))
        k = 1
        while k <= more and i + k < len(data) and lo <= data[i + k] <= hi:
            lo, hi, k = 0x80, 0xBF, k + 1
        if k > more >= 0:
            out.append(data[i:i + k].decode())
        elif more > 0 and i + k == len(data):
            break
        else:
            out.append("�")
        i += k
    return "".join(out), data[i:]


class StreamDecoder:
    """Tokens to text, one at a time; the moves of the state machine are remembered."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.moves: dict[bytes, dict[int, tuple[str, bytes]]] = {}
        self.known = 0

    def decode(self, ids: Iterable[int]) -> str:
        if self.known >= MAX_MOVES:
            self.moves.clear()
            self.known = 0
        out, pending = [], b""
        moves = self.moves.setdefault(pending, {})
        for i in ids:
            move = moves.get(i)
            if move is None:
                move = moves[i] = utf8_advance(pending, self.bytes_of[i])
                self.known += 1
            out.append(move[0])
            if move[1] is not pending and move[1] != pending:
                pending = move[1]
                moves = self.moves.setdefault(pending, {})
        if pending:
            out.append("�")
        return "".join(out)


_workers: dict[tuple, tuple[PieceEncoder, StreamDecoder]] = {}


def _worker(content: bytes, pattern: str, share: float) -> tuple[PieceEncoder, StreamDecoder]:
    """One encoder and decoder for a Python worker, whatever number of tasks it runs."""
    key = (hash(content), len(content), pattern, share)
    if key not in _workers:
        transducer = Transducer(read_ranks(content), share)
        _workers[key] = PieceEncoder(transducer, pattern), StreamDecoder(transducer.bytes_of)
    return _workers[key]


def digest_columns(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts and digests of a batch of ``bpe_encode``, in place of the text."""
    ids, sizes, digests = batch.column(1), [], []
    flat, at = ids.values.to_numpy(), ids.offsets.to_numpy()
    for a, b in zip(at[:-1], at[1:]):
        sizes.append(int(b - a))
        digests.append(hashlib.sha256(" ".join(map(str, flat[a:b].tolist())).encode()).hexdigest())
    decoded = [hashlib.sha256(t.as_py().encode()).hexdigest() for t in batch.column(2)]
    return pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                                       pa.array(decoded, pa.string())],
                                      [batch.schema.names[0], "ids", "n_tokens", "ids_sha256", "decoded_sha256"])


#: Columns of ``digest_columns`` behind the id.
DIGESTS = "ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
               then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None,
               columns: str = "ids array<int>, decoded string", take: tuple[str, ...] | None = None,
               share: float = 1.0) -> DataFrame:
    """Per document: the id, ``ids`` array<int> and ``decoded``, the text decoded from them.

    ``ranks`` is the path of a rank file on the driver (under 2 MB for 50,000
    tokens; sent to the workers once as a broadcast), ``pattern`` splits a
    text into pieces that are encoded one by one. ``then`` maps each batch of
    that result to another one, whose columns behind the id are ``columns``,
    while it is still with the worker; ``take`` names those that go on. ``share``
    of the bounds above is what a worker remembers: less takes less memory and
    more time. Null text is encoded like an empty one: no ids, decoded to the empty text. Rows
    are independent: repeated rows give repeated results, other columns are
    not read. A very long text is one row of one task; its tokens are the
    memory it takes.
    """
    with open(ranks, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encoder, decoder = _worker(content.value, pattern, share)
        collects = gc.isenabled()
        gc.disable()  # states and pieces hold no cycles, and there are many
        try:
            for batch, data, starts in pieces(batches, [id_col], text_col):
                raw = data.tobytes()
                ids = [encoder.encode(raw[a:b].decode()) for a, b in zip(starts[:-1], starts[1:])]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                out = pa.RecordBatch.from_arrays([
                    batch.column(batch.schema.get_field_index(id_col)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))),
                    pa.array([decoder.decode(x.tolist()) for x in ids], pa.string()),
                ], [id_col, "ids", "decoded"])
                if then:
                    out = then(out)
                yield out.select([id_col, *take]) if take else out
        finally:
            if collects:
                gc.enable()

    docs = column_named(docs, id_col, text_col)
    kinds = [c.strip() for c in re.split(r",\s*(?![^<]*>)", columns)]
    kinds = ", ".join(k for k in kinds if not take or k.split()[0] in take)
    return docs.mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, {kinds}")
