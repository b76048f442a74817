"""Cheapest repair of conversations by Four-Russians block tables.

The repaired roles must read ``(s?(ua)+)?``. Going backward over the rows, a
vector holds the least cost of the rest from each of the four states of that
pattern. Inserts bound the differences within a vector, so there are few
vectors once the smallest cost is taken out. For every vector and every block
of ``BLOCK`` row symbols a table holds the vector before the block and the cost
added; rows are then processed a block at a time by lookup. A block is expanded
backward only to trace the edits through it, so that of all cheapest edits
those whose initials come first in ASCII order are found.

A symbol is one byte. Conversations are read in ranges of (conversation, turn),
so a long one is spread over tasks and only its symbols, fewer bytes than its
audit, come together; its texts are read in order, and never held, where their
digest is made.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

#: Costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Rows in a block; the tables hold 9 ** BLOCK entries a vector.
BLOCK = 4
#: States: nothing yet, after s, after u, after a; the state after an insert or a rerole; those that may end.
START, SYSTEM, USER, ASSISTANT = range(4)
INSERTED = (USER, USER, ASSISTANT, USER)
ENDS = (0, 2 * INSERT, INSERT, 0)
#: A row's code is 4 * role (s, u, a, other) + fault (none, truncated, blank, duplicate); codes to symbols.
ROLES, FAULTS = "sua", ("none", "truncated", "blank", "duplicate")
DROP = 8  # the symbol of a row that has to be deleted
SYMBOL = np.array([2 * (c // 4) + c % 4 if c % 4 < 2 else DROP for c in range(16)], np.uint8)


def _closed(w: list[int]) -> tuple[int, ...]:
    """Costs from each state when rows may be inserted first."""
    u, a = min(w[USER], INSERT + w[ASSISTANT]), min(w[ASSISTANT], INSERT + w[USER])
    return min(w[START], INSERT + u), min(w[SYSTEM], INSERT + u), u, a


def _kept(state: int, symbol: int) -> int | None:
    """The state after a row is kept, None if its role does not go there."""
    role = symbol // 2
    if role == 0:
        return SYSTEM if state == START else None
    if role == 1:
        return USER if state != USER else None
    return ASSISTANT if role == 2 and state == USER else None


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """The vector before a row, given the one after it."""
    out = []
    for q in range(4):
        best = DELETE + after[q]
        if symbol != DROP:
            extra = TRUNCATED * (symbol % 2)
            best = min(best, REROLE + extra + after[INSERTED[q]])
            to = _kept(q, symbol)
            if to is not None:
                best = min(best, extra + after[to])
        out.append(best)
    return _closed(out)


class Tables:
    """Vectors less their smallest cost, and the tables of blocks of up to ``BLOCK`` rows."""

    def __init__(self):
        first = ENDS
        self.vectors, number = [first], {first: 0}
        to, cost, k = [], [], 0
        while k < len(self.vectors):
            row = []
            for symbol in range(DROP + 1):
                v = _before(self.vectors[k], symbol)
                least = min(v)
                v = tuple(x - least for x in v)
                if v not in number:
                    number[v] = len(self.vectors)
                    self.vectors.append(v)
                row.append((number[v], least))
            to.append([x for x, _ in row])
            cost.append([x for _, x in row])
            k += 1
        one, paid = np.array(to, np.int32), np.array(cost, np.int32)
        self.to, self.cost, base = [None, one], [None, paid], DROP + 1
        for size in range(2, BLOCK + 1):  # a symbol before a block of size - 1: code = symbol * base ** (size - 1) + code
            rest, spent = self.to[-1], self.cost[-1]
            self.to.append(np.stack([one[rest, s] for s in range(base)], axis=1).reshape(len(one), -1))
            self.cost.append(np.stack([spent + paid[rest, s] for s in range(base)], axis=1).reshape(len(one), -1))
        self.jump = self.to[BLOCK].tolist()
        self.spent = self.cost[BLOCK].tolist()
        self.step, self.paid = one.tolist(), paid.tolist()
        self.weights = base ** np.arange(BLOCK - 1, -1, -1)
        self.expand = lru_cache(maxsize=200_000)(self._expand)

    def _expand(self, after: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Initials of the edits of a block, and the state after it, given the vector after it."""
        vectors = [self.vectors[after]]
        for symbol in reversed(symbols):
            vectors.append(_before(vectors[-1], symbol))
        vectors.reverse()
        out, i = [], 0
        while i < len(symbols):
            now, then, symbol = vectors[i][state], vectors[i + 1], symbols[i]
            extra, to = TRUNCATED * (symbol % 2), _kept(state, symbol) if symbol != DROP else None
            if now == DELETE + then[state]:
                out.append("D")
            elif now == INSERT + vectors[i][INSERTED[state]]:
                out.append("I")
                state = INSERTED[state]
                continue
            elif to is not None and now == extra + then[to]:
                out.append("K")
                state = to
            else:
                out.append("R")
                state = INSERTED[state]
            i += 1
        return "".join(out), state

    def repair(self, symbols: np.ndarray) -> tuple[int, str]:
        """Least cost, and the initials of the cheapest edits, the least of them in ASCII order."""
        head = len(symbols) % BLOCK
        blocks = symbols[head:].reshape(-1, BLOCK)
        codes = (blocks @ self.weights).tolist()
        vector, cost, after = 0, 0, np.empty(len(codes), np.int32)
        jump, spent = self.jump, self.spent
        for k in range(len(codes) - 1, -1, -1):
            after[k] = vector
            code = codes[k]
            cost += spent[vector][code]
            vector = jump[vector][code]
        ahead = vector
        for symbol in symbols[:head][::-1].tolist():
            cost += self.paid[vector][symbol]
            vector = self.step[vector][symbol]
        audit, state = [], START
        if head:
            text, state = self.expand(ahead, symbols[:head].tobytes(), state)
            audit.append(text)
        raw = blocks.tobytes()
        for k in range(len(codes)):
            text, state = self.expand(int(after[k]), raw[BLOCK * k:BLOCK * (k + 1)], state)
            audit.append(text)
        audit.append("I" * (ENDS[state] // INSERT))
        return cost + self.vectors[vector][START], "".join(audit)


_tables: list[Tables] = []


def tables() -> Tables:
    """The tables of this process, made once."""
    if not _tables:
        _tables.append(Tables())
    return _tables[0]


#: Adjacent roles that are in order.
IN_ORDER = {(0, 1), (1, 2), (2, 1)}
_LEGAL = np.array([[(a, b) in IN_ORDER for b in range(4)] for a in range(4)])


def _chunks(batches):
    """Runs of rows of one conversation, in order: one row of codes for each run of a batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, code = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("key", "code"))
        part = batch.column(batch.schema.get_field_index("part")).to_numpy(zero_copy_only=False)
        place = batch.column(batch.schema.get_field_index("place")).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        end = np.concatenate((first[1:], [len(conv)]))
        raw = code.astype(np.uint8).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv[first]), pa.array(part[first]), pa.array(place[first]),
             pa.array([raw[a:b] for a, b in zip(first.tolist(), end.tolist())], pa.binary())], ["key", "part", "place", "codes"])


def _repairs(batches):
    """Per conversation from its runs of codes: cost, illegal neighbours and audit."""
    t = tables()
    for batch in batches:
        cost, illegal, audit = [], [], []
        for runs in batch.column(batch.schema.get_field_index("runs")).to_pylist():
            codes = np.frombuffer(b"".join(r["codes"] for r in runs), np.uint8)
            role = codes >> 2
            illegal.append(int((~_LEGAL[role[:-1], role[1:]]).sum()))
            c, a = t.repair(SYMBOL[codes])
            cost.append(c)
            audit.append(a)
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("key")), pa.array(cost, pa.int64()), pa.array(illegal, pa.int64()),
             pa.array(audit, pa.string())], ["key", "cost", "illegal", "audit"])


class _Repaired:
    """Digest of a conversation's repaired rows, fed row by row."""

    def __init__(self, key, audit: str):
        self.key, self.audit, self.at, self.state = key, audit, 0, START
        self.digest, self.some = hashlib.sha256(), False

    def _add(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) * self.some}{role}:{text}".encode())
        self.some = True

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.state = INSERTED[self.state]
            self._add("user" if self.state == USER else "assistant", "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = 1 + ROLES.index(role[0])
            self._add(role, text)
        elif edit == "R":
            self.state = INSERTED[self.state]
            self._add("user" if self.state == USER else "assistant", text)

    def end(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


def _digests(batches):
    """Rows in order of conversation, the audit before the texts: the digest of each."""
    now = None
    for batch in batches:
        keys, out = [], []
        cols = [batch.column(batch.schema.get_field_index(c)) for c in ("key", "audit", "role", "text")]
        for key, audit, role, text in zip(*[(x.as_py() for x in c) for c in cols]):
            if audit is not None:
                if now:
                    keys.append(now.key)
                    out.append(now.end())
                now = _Repaired(key, audit)
            elif now and now.key == key:
                now.row(role, text)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(out, pa.string())], ["key", "repaired_sha256"])
    if now:
        yield pa.RecordBatch.from_arrays([pa.array([now.key], pa.string()), pa.array([now.end()], pa.string())],
                                         ["key", "repaired_sha256"])


_WORD = "[^ \\\\x09-\\\\x0D]"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows by ``crc32('conv_id:turn') % 20``: 0 is marked ``dropped``, 1 gets an empty
    text, 2 loses its sentence ends, 3 comes twice (``copy`` 0 and 1), 4 becomes
    the user's. Nulls of role and text, and in the key, count as one blank.
    """
    rows = conversations.selectExpr(
        "conv_id", "turn", "coalesce(cast(role AS string), ' ') AS role", "coalesce(cast(text AS string), ' ') AS text",
        "crc32(concat(coalesce(cast(conv_id AS string), ' '), ':', coalesce(cast(turn AS string), ' '))) % 20 AS h")
    return rows.selectExpr(
        "conv_id", "turn", "IF(h = 4, 'user', role) AS role",
        "CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END AS text", "h = 0 AS dropped",
        "explode(IF(h = 3, array(0, 1), array(0))) AS copy")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``,
    ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and, if wanted,
    ``dropped`` (rows that are not there, though their conversation is) and
    ``copy``. Rows stand in order of turn (nulls first), role, a hash of the
    text and copy. Of each row the first fault counts: blank, duplicate (role and
    text of an earlier row), truncated. Roles go by their first letter. A null
    conv_id is a conversation, null role and text count as one blank, and a
    conversation without rows has no edits, costs nothing and has the digest of
    the empty text. Repeated rows are duplicates.
    """
    more = {"dropped": "false", "copy": "0"}
    rows = rows.selectExpr(
        "conv_id", "cast(conv_id AS string) AS key", "cast(turn AS bigint) AS turn", "coalesce(cast(role AS string), ' ') AS role",
        "coalesce(cast(text AS string), ' ') AS text", *[n if n in rows.columns else f"{v} AS {n}" for n, v in more.items()])
    rows = rows.selectExpr("*", "coalesce(key, '') AS k", "key IS NULL AS nokey", "xxhash64(text) AS th")
    order = "turn ASC NULLS FIRST, copy"
    last = "right(rtrim(' \\t\\n\\u000B\\f\\r', text), 1)"
    made = rows.where("NOT dropped").selectExpr(
        "*", f"row_number() OVER (PARTITION BY nokey, k, role, text ORDER BY {order}) AS seen", f"{last} AS last")
    made = keep(made.selectExpr(
        "conv_id", "nokey", "k", "turn", "role", "th", "copy", "text",
        f"CASE WHEN NOT text RLIKE '{_WORD}' THEN 2 WHEN seen > 1 THEN 3 WHEN last NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault",
        "CASE left(role, 1) WHEN 's' THEN 0 WHEN 'u' THEN 1 WHEN 'a' THEN 2 ELSE 3 END AS initial"), "repair-rows")
    counts = made.groupBy("nokey", "k").agg(
        F.expr("coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)").alias("gaps"),
        F.expr("count_if(fault = 2)").alias("blank"), F.expr("count_if(fault = 3)").alias("duplicate"),
        F.expr("count_if(fault = 1)").alias("truncated"))
    along = ["nokey", "k", F.col("turn").asc_nulls_first(), "role", "th", "copy"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = "concat(IF(nokey, '-', '+'), k) AS key"
    codes = made.select("nokey", "k", "turn", "role", "th", "copy", F.expr("4 * initial + fault AS code"))
    codes = codes.repartitionByRange(parts, *along).sortWithinPartitions(*along).select(
        F.expr(key), "code", F.spark_partition_id().cast("long").alias("part"), F.monotonically_increasing_id().alias("place"))
    runs = codes.mapInArrow(_chunks, "key string, part long, place long, codes binary").groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("part", "place", "codes"))).alias("runs"))
    repaired = keep(runs.mapInArrow(_repairs, "key string, cost long, illegal long, audit string"), "repair-audits")

    texts = made.select(F.expr(key), F.lit(None).cast("string").alias("audit"), "turn", "role", "th", "copy", "text", F.lit(1).alias("kind"))
    heads = repaired.selectExpr("key", "audit", "cast(NULL AS bigint) AS turn", "'' AS role", "0L AS th", "0 AS copy", "'' AS text", "0 AS kind")
    digests = heads.unionByName(texts).repartition(parts, "key").sortWithinPartitions(
        "key", "kind", F.col("turn").asc_nulls_first(), "role", "th", "copy").select("key", "audit", "role", "text").mapInArrow(
        _digests, "key string, repaired_sha256 string")
    every = rows.select("conv_id", "nokey", "k").distinct().join(counts, ["nokey", "k"], "left").withColumn("key", F.expr(key[:-len(" AS key")]))
    out = every.join(repaired, "key", "left").join(digests, "key", "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.selectExpr(
        "conv_id", *[f"coalesce({c}, 0L) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        "coalesce(audit, '') AS audit", f"coalesce(repaired_sha256, '{empty}') AS repaired_sha256")
