"""Repeated passages by suffix arrays in shards.

Which ``length``-byte strings also start earlier (smaller doc_id, or same
document and earlier start)? Every such string (window) has an anchor, the
leftmost smallest hash among its k-byte pieces, so equal windows have equal
anchors at equal offsets. The windows of one anchor occurrence lie next to
each other; the bytes that they span are its context.

1. Anchor occurrences are dealt out by anchor hash. A context identical to an
   earlier one repeats all its windows. Of anchors with several different
   contexts, the first occurrence of each goes on.
2. Those contexts are dealt into shards by anchor. A shard's suffix array is
   built by Larsson-Sadakane refinement (doubling of sorted prefixes, only
   groups that are not yet single are sorted again), its common prefixes by
   Kasai's rule, and windows in one run of common prefixes of ``length`` bytes
   or more are equal: all but the first repeat.
3. An anchor found in a large share of documents is dealt over many shards
   (a sample of documents tells which; it only routes). The sorted windows
   kept of such anchors, and of shards too large for one suffix array, are
   merged by binary search, bucket by bucket.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_named, keep, mix64, pieces
from .shingles import _power_tables

LENGTH, PIECE = 100, 25
#: Bytes of contexts in a shard on average, and at most in one suffix array.
SHARD_BYTES, BLOCK_BYTES = 600_000, 1_200_000
#: One document in so many is sampled to find anchors to deal over several shards,
#: those in at least this share of sampled documents; parts for each.
SAMPLE, HOT_SHARE, PARTS = 64, 0.01, 48
_ODD1, _ODD2 = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def _prefix_hash(data: np.ndarray):
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=total[1:])
    return lambda a, b: (total[b] - total[a]) * inverse[a]


def anchors(data: np.ndarray, starts: np.ndarray, length: int, piece: int):
    """Anchor occurrences: text number, anchor hash, context hash, first window
    (place in the text) and number of further windows."""
    n, w = len(data), length - piece + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    span = _prefix_hash(data)
    at = np.arange(n - piece + 1)
    h = mix64(span(at, at + piece))
    bits = np.uint64(max(22, n.bit_length()))
    low = (h >> bits << bits) | at.astype(np.uint64)
    size = 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[:len(low) - (w - size)], low[w - size:])
    window = np.arange(len(low))
    doc = np.searchsorted(starts, window, "right") - 1
    whole = window + length <= starts[doc + 1]
    window, doc = window[whole], doc[whole]
    if not len(window):
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    place = (low[whole] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]))))
    more = np.diff(np.concatenate((first, [len(window)]))) - 1
    lo, place, doc = window[first], place[first], doc[first]
    context = mix64(mix64(span(lo, lo + more + length)) + more.astype(np.uint64) * _ODD1
                    + (place - lo).astype(np.uint64) * _ODD2)
    return doc, h[place], context, lo - starts[doc], more


def _anchor_rows(length: int, piece: int):
    def run(batches):
        for batch, data, starts in pieces(batches, ["doc"], "text"):
            doc, h, x, lo, more = anchors(data, starts, length, piece)
            ids = batch.column(batch.schema.get_field_index("doc"))
            base = batch.column(batch.schema.get_field_index("base")).to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array(h.view(np.int64)), pa.array(x.view(np.int64)), ids.take(pa.array(doc)),
                pa.array(lo + base[doc]), pa.array(more.astype(np.int16))], ["h", "x", "doc", "lo", "more"])

    return run


def _sort_contexts(batches):
    """Rows in order of anchor, part, context, document and place: marks what
    repeats an identical context and what has to be compared (``compare``).
    Looks back one row only, so a common anchor takes no memory."""
    last = held = None  # (h, part, x, doc, lo, at the first place) of the row before; first row of an anchor with one context so far
    names = ["h", "part", "doc", "lo", "more", "hot"]
    for batch in batches:
        if not batch.num_rows:
            continue
        col = {c: batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in [*names, "x"]}
        h, part, x = col["h"], col["part"], col["x"]
        same = np.concatenate(([last is not None and (h[0], part[0]) == last[:2]],
                               (h[1:] == h[:-1]) & (part[1:] == part[:-1])))
        equal = same & np.concatenate(([last is not None and x[0] == last[2]], x[1:] == x[:-1]))
        # rows of the first place of a context (a repeated row of the table) repeat nothing
        doc, lo = col["doc"], col["lo"]
        moved = equal & ~np.concatenate(([last is not None and (doc[0], lo[0]) == last[3:5]], (doc[1:] == doc[:-1]) & (lo[1:] == lo[:-1])))
        moves, run = np.cumsum(moved), np.cumsum(~equal)
        before = np.concatenate(([0 if last is None or last[5] else -1], moves[~equal]))
        at_first = equal & (moves == before[run])
        group = np.cumsum(~same)  # 0: goes on from the batch before
        fresh = ~equal
        contexts = np.bincount(group[fresh], minlength=group[-1] + 1)
        if group[0] == 0:
            contexts[0] += 1 if held is not None else 2
        compare = fresh & ((contexts[group] > 1) | col["hot"])
        out = {c: v for c, v in col.items() if c != "x"}
        rows = [pd.DataFrame(out).assign(compare=compare)[(equal & ~at_first) | compare]]
        if held is not None and group[0] == 0 and contexts[0] > 1:
            rows.insert(0, held)
        if group[-1] > 0 or held is None or contexts[0] > 1:
            held = None
        if group[-1] > 0 and contexts[-1] == 1 and not col["hot"][-1]:
            k = int(np.searchsorted(group, group[-1]))
            held = pd.DataFrame({c: v[k:k + 1] for c, v in out.items()}).assign(compare=True)
        last = (h[-1], part[-1], x[-1], doc[-1], lo[-1], bool(at_first[-1] or fresh[-1]))
        yield pa.RecordBatch.from_pandas(pd.concat(rows), preserve_index=False)


def suffix_array(data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted suffixes of strings laid back to back, and the first bytes of each
    place as a number. ``end[p]`` is the end of the string that ``p`` is in.

    Larsson-Sadakane: after a sort by the first 7 bytes, only groups of equal
    prefixes are sorted again, by the group of the suffix that starts behind
    the known prefix, whose length doubles. Equal suffixes stand in order of place.
    """
    n = len(data)
    key, place = np.zeros(n, np.uint64), np.arange(n, dtype=np.int32)
    left = np.minimum(end - place, 7).astype(np.uint8)
    for k in range(7):
        here = np.zeros(n, np.uint8)
        here[:max(n - k, 0)] = data[k:]
        here[k >= left] = 0
        key <<= np.uint64(8)
        key |= here
    key <<= np.uint64(8)
    key |= left
    sa = np.argsort(key, kind="stable").astype(np.int32)
    sorted_key = key[sa]
    starts = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    del sorted_key, here, left
    rank = np.empty(n, np.int32)
    rank[sa] = np.maximum.accumulate(np.where(starts, place, 0))
    known = 7
    active = np.flatnonzero(~(starts & np.concatenate((starts[1:], [True])))).astype(np.int32)
    while len(active):
        p = sa[active]
        ended = p + known >= end[p]
        pair = rank[p].astype(np.int64) * (n + 1) + np.where(ended, 0, rank[np.minimum(p + known, n - 1)] + 1)
        order = np.argsort(pair, kind="stable")
        p, pair, ended = p[order], pair[order], ended[order]
        sa[active] = p
        new = np.concatenate(([True], (pair[1:] != pair[:-1]) | ended[1:]))
        rank[p] = np.maximum.accumulate(np.where(new, active, 0))
        single = new & np.concatenate((new[1:], [True]))
        active = active[~single]
        known *= 2
    return sa, key


def common_prefixes(data: np.ndarray, end: np.ndarray, sa: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each sorted suffix and the one before it.

    Kasai: where the byte before a suffix equals the byte before its
    neighbour, the common prefix is one shorter than that of the place before;
    only the other places are compared, 7 bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n, dtype=np.int32)
    first = np.zeros(n, bool)
    first[0] = True
    first[1:] = end[1:] != end[:-1]
    own = first | (before <= 0)
    own |= first[np.maximum(before, 0)]
    own[1:] |= data[:-1] != data[np.maximum(before[1:], 1) - 1]
    p = np.flatnonzero(own)
    q = before[p]
    got = np.zeros(len(p), np.int32)
    on = np.flatnonzero(q >= 0)
    seven = (key & np.uint64(255)) == 7
    while len(on):
        a, b = p[on] + got[on], q[on] + got[on]
        inside = (a < end[p[on]]) & (b < end[q[on]])
        on, a, b = on[inside], a[inside], b[inside]
        full = seven[a] & seven[b] & (key[a] == key[b])
        rest, ra, rb = on[~full], a[~full], b[~full]
        for k in range(7):
            ok = (ra + k < end[p[rest]]) & (rb + k < end[q[rest]])
            ok[ok] = data[ra[ok] + k] == data[rb[ok] + k]
            rest, ra, rb = rest[ok], ra[ok], rb[ok]
            got[rest] += 1
        got[on[full]] += 7
        on = on[full]
    common = np.zeros(n, np.int32)
    common[p] = got
    base = np.maximum.accumulate(np.where(own, place, 0))
    common = common[base] - (place - base)
    return common[sa]


def _repeats(data: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Marks the places whose first ``length`` bytes also start at a smaller place."""
    sa, key = suffix_array(data, end)
    chained = common_prefixes(data, end, sa, key) >= length
    heads = np.flatnonzero(~chained)
    least = np.minimum.reduceat(sa, heads)
    out = np.zeros(len(data), bool)
    out[sa] = sa != np.repeat(least, np.diff(np.concatenate((heads, [len(sa)]))))
    return out


_OUT = "doc long, lo long, more int, bucket int, keys binary, docs binary, places binary"


def _shard_search(length: int, buckets: int):
    def block(rows: list, split: bool) -> pa.RecordBatch:
        """rows: (doc, lo, hot, bytes) in order of document and place."""
        doc = np.array([r[0] for r in rows])
        lo = np.array([r[1] for r in rows])
        hot = np.array([r[2] for r in rows]) | split
        sizes = np.array([len(r[3]) for r in rows])
        data = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        stop = np.cumsum(sizes).astype(np.int32)  # a block has few bytes
        of = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        end = stop[of]
        place = np.arange(len(data), dtype=np.int32)
        window = place + length <= end
        again = _repeats(data, end, length) & window
        where = lo[of] + place - (stop - sizes)[of]
        run = np.flatnonzero(again & ~np.concatenate(([False], again[:-1] & (of[1:] == of[:-1]))))
        last = np.flatnonzero(again & ~np.concatenate((again[1:] & (of[1:] == of[:-1]), [False])))
        kept = np.flatnonzero(window & ~again & hot[of])
        found = {"doc": list(doc[of[run]]), "lo": list(where[run]), "more": list(last - run), "bucket": [None] * len(run),
                 "keys": [None] * len(run), "docs": [None] * len(run), "places": [None] * len(run)}
        if len(kept):
            span = _prefix_hash(data)
            keys = mix64(span(kept, kept + length))
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((keys, bucket))
            kept, keys, bucket = kept[order], keys[order], bucket[order]
            cuts = np.concatenate((np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), [len(kept)]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                for c, v in (("doc", None), ("lo", None), ("more", None), ("bucket", int(bucket[a])),
                             ("keys", keys[a:b].tobytes()), ("docs", doc[of[kept[a:b]]].astype(np.int64).tobytes()),
                             ("places", where[kept[a:b]].astype(np.int64).tobytes())):
                    found[c].append(v)
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(found[c], t) for c, t in zip(found, types)], list(found))

    def run(batches):
        shard, rows, size, split = None, [], 0, False
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("shard", "doc", "lo", "hot", "data")]
            for s, *row in zip(*[c.to_pylist() for c in cols]):
                if rows and (s != shard or size + len(row[3]) > BLOCK_BYTES):
                    split |= s == shard
                    yield block(rows, split)
                    split &= s == shard
                    rows, size = [], 0
                shard = s
                rows.append(row)
                size += len(row[3])
        if rows:
            yield block(rows, split)

    return run


def _merge(a: tuple, b: tuple, lost: list) -> tuple:
    """Merge two sorted runs (key, doc, place) by binary search; of equal keys the
    earlier place stays and the other is lost."""
    at = np.searchsorted(a[0], b[0])
    found = at < len(a[0])
    found[found] = a[0][at[found]] == b[0][found]
    i, j = at[found], np.flatnonzero(found)
    earlier = (b[1][j] < a[1][i]) | ((b[1][j] == a[1][i]) & (b[2][j] < a[2][i]))
    same = (b[1][j] == a[1][i]) & (b[2][j] == a[2][i])
    gone = ~earlier & ~same
    lost.append((np.where(earlier, a[1][i], b[1][j])[earlier | gone], np.where(earlier, a[2][i], b[2][j])[earlier | gone]))
    for k in (1, 2):
        a[k][i[earlier]] = b[k][j[earlier]]
    new = ~found
    return tuple(np.insert(x, at[new], y[new]) for x, y in zip(a, b))


def _merge_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    runs = [(np.frombuffer(k, np.uint64), np.frombuffer(d, np.int64).copy(), np.frombuffer(p, np.int64).copy())
            for k, d, p in zip(pdf["keys"], pdf["docs"], pdf["places"])]
    lost: list = []
    while len(runs) > 1:
        runs = [_merge(runs[i], runs[i + 1], lost) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    doc = np.concatenate([x for x, _ in lost]) if lost else np.zeros(0, np.int64)
    lo = np.concatenate([x for _, x in lost]) if lost else np.zeros(0, np.int64)
    return pd.DataFrame({"doc": doc, "lo": lo, "more": np.zeros(len(lo), np.int32)})


def _based(rows: DataFrame) -> DataFrame:
    """Adds ``base``, where a text starts among the texts of its ``doc``: 0 unless an id has several.

    The different texts of one id count as one document, in order of a hash,
    though no string reaches from one into the next. Equal ones share their place.
    """
    texts = rows.selectExpr("doc", "xxhash64(text) AS th", "cast(octet_length(text) AS bigint) AS n").where("doc IS NOT NULL AND n > 0").distinct()
    several = texts.groupBy("doc").agg(F.count("*").alias("texts")).where("texts > 1").select("doc")
    several = keep(texts.join(several, "doc", "left_semi").selectExpr(
        "doc", "th", "sum(n) OVER (PARTITION BY doc ORDER BY th ROWS UNBOUNDED PRECEDING) - n AS base"), "suffix-several")
    if several.isEmpty():
        return rows.withColumn("base", F.lit(0).cast("long"))
    return rows.withColumn("th", F.xxhash64("text")).join(several, ["doc", "th"], "left").withColumn(
        "base", F.coalesce("base", F.lit(0).cast("long"))).drop("th")


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     length: int = LENGTH, piece: int = PIECE) -> DataFrame:
    """Runs of repeated windows: ``doc``, first place ``lo`` and number of further windows ``more``."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    return _windows(_based(docs), length, piece)


def _windows(docs: DataFrame, length: int, piece: int) -> DataFrame:
    docs = docs.select("doc", "text", "base").where(f"doc IS NOT NULL AND octet_length(text) >= {length}")
    row = "h long, x long, doc long, lo long, more short"
    rows = docs.mapInArrow(_anchor_rows(length, piece), row)
    sampled = docs.where(f"pmod(xxhash64(doc), {SAMPLE}) = 0")
    common = sampled.mapInArrow(_anchor_rows(length, piece), row).groupBy("h").agg(F.count("*").alias("n"))
    least = max(20, int(HOT_SHARE * sampled.count()))
    # every sampled document adds its anchors once, so at most (anchors per document) / HOT_SHARE rows
    hot = keep(common.where(f"n >= {least}").select("h", F.lit(True).alias("hot")), "suffix-common")
    rows = rows.join(F.broadcast(hot), "h", "left").withColumn("hot", F.coalesce("hot", F.lit(False))).withColumn(
        "part", F.expr(f"IF(hot, pmod(xxhash64(doc), {PARTS}), 0)"))
    order = ["h", "part", "x", "doc", "lo"]
    marked = keep(rows.repartition("h", "part").sortWithinPartitions(*order).mapInArrow(
        _sort_contexts, "h long, part long, doc long, lo long, more short, hot boolean, compare boolean"), "suffix-marked")

    ask = marked.where("compare")
    span = F.col("more") + length
    shards = max(1, (ask.agg(F.sum(span)).first()[0] or 0) // SHARD_BYTES)
    shard = f"pmod(xxhash64(h, part), {shards})"
    # a shard over BLOCK_BYTES sends all its windows to the merge, any other those of hot anchors
    merge_bytes = ask.groupBy(F.expr(shard)).agg(F.sum(span).alias("n"), F.sum(F.when(F.col("hot"), span)).alias("hot")).agg(
        F.sum(F.when(F.col("n") > BLOCK_BYTES, F.col("n")).otherwise(F.col("hot")))).first()[0]
    buckets = max(1, (merge_bytes or 0) // (SHARD_BYTES // 2))
    places = ask.groupBy("doc").agg(F.collect_list(F.struct(
        "lo", "more", "hot", F.expr(shard).alias("shard"))).alias("at"))

    def cut_out(batches):
        for batch, data, starts in pieces(batches, ["doc", "at"], "text"):
            at = batch.column(batch.schema.get_field_index("at"))
            flat = at.flatten()
            lo, more = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "more"))
            row = np.repeat(np.arange(batch.num_rows), pc.list_value_length(at).to_numpy(zero_copy_only=False))
            base = batch.column(batch.schema.get_field_index("base")).to_numpy()[row]
            own = (lo >= base) & (lo < base + np.diff(starts)[row])  # not those of another text of the id
            mine, row = pa.array(own), row[own]
            raw, first = data.tobytes(), starts[row] + (lo - base)[own]
            yield pa.RecordBatch.from_arrays([
                flat.field("shard").filter(mine), batch.column(batch.schema.get_field_index("doc")).take(pa.array(row)),
                flat.field("lo").filter(mine), flat.field("hot").filter(mine),
                pa.array([raw[a:a + m] for a, m in zip(first.tolist(), (more[own] + length).tolist())], pa.binary())],
                ["shard", "doc", "lo", "hot", "data"])

    contexts = docs.join(places, "doc").select("doc", "text", "base", "at").mapInArrow(
        cut_out, "shard long, doc long, lo long, hot boolean, data binary")
    found = keep(contexts.repartition(shards, "shard").sortWithinPartitions("shard", "doc", "lo").mapInArrow(
        _shard_search(length, buckets), _OUT), "suffix-found")
    merged = found.where("bucket IS NOT NULL").select("bucket", "keys", "docs", "places").groupBy("bucket").applyInPandas(
        _merge_bucket, "doc long, lo long, more int")
    out = marked.where("NOT compare").selectExpr("doc", "lo", "cast(more AS int) AS more")
    return out.unionByName(found.where("bucket IS NULL").select("doc", "lo", "more")).unionByName(merged)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                   length: int = LENGTH, piece: int = PIECE, as_text: bool = False) -> DataFrame:
    """Per document: the id, ``n_bytes``, ``n_removed``, ``n_spans`` (runs of
    removed bytes), ``kept`` (the other bytes; ``as_text``: as a string, without
    the halves of characters cut in two, null for a null text) and the columns in ``carry``.

    Every byte of a string of ``length`` bytes that also starts earlier goes;
    strings are judged on the input. A null text has no bytes. Texts shorter
    than ``length`` stay whole, and so do rows without an id. Ids are whole
    numbers. Of an id's rows, equal texts count as one (each row is returned, cut
    alike); different texts stand one after the other, in order of a hash.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"),
                       *[F.col(f"`{c}`").alias(f"__carried_{k}") for k, c in enumerate(carry)])
    rows = _based(rows)
    runs = _windows(rows, length, piece).groupBy("doc").agg(F.collect_list(F.struct("lo", "more")).alias("runs"))
    joined = rows.join(runs, "doc", "left").selectExpr(
        "doc AS __id", "text AS __text", "base AS __base", "runs AS __runs", *[f"__carried_{k}" for k in range(len(carry))])

    def cut(batches):
        for batch, data, starts in pieces(batches, [], "__text"):
            runs = batch.column(batch.schema.get_field_index("__runs"))
            flat = runs.flatten()
            row = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False))
            lo, more = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "more"))
            lo -= batch.column(batch.schema.get_field_index("__base")).to_numpy()[row]
            own = (lo >= 0) & (lo < np.diff(starts)[row])  # not those of another text of the id
            row, lo, more = row[own], lo[own], more[own]
            edge = np.zeros(len(data) + 1, np.int64)
            np.add.at(edge, np.minimum(starts[row] + lo, starts[row + 1]), 1)
            np.add.at(edge, np.minimum(starts[row] + lo + more + length, starts[row + 1]), -1)
            gone = np.cumsum(edge[:-1]) > 0
            count = np.concatenate(([0], np.cumsum(gone)))
            removed = count[starts[1:]] - count[starts[:-1]]
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            inner = starts[:-1][starts[:-1] < len(data)]
            first[inner] = gone[inner]
            spans = np.concatenate(([0], np.cumsum(first)))
            sizes = np.diff(starts) - removed
            kept = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32).tobytes()),
                pa.py_buffer(data[~gone].tobytes())])
            if as_text:
                null = batch.column(batch.schema.get_field_index("__text")).is_null().to_pylist()
                kept = pa.array([None if no else k.decode("utf-8", "ignore") for no, k in zip(null, kept.to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("__id")), pa.array(np.diff(starts)), pa.array(removed),
                 pa.array(spans[starts[1:]] - spans[starts[:-1]]), kept,
                 *[batch.column(batch.schema.get_field_index(f"__carried_{k}")) for k in range(len(carry))]],
                [id_col, "n_bytes", "n_removed", "n_spans", "kept", *carry])

    kinds = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return joined.mapInArrow(cut, f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}{kinds}")
