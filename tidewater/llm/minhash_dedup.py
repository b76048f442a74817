"""MinHash near-duplicates by fast similarity sketching.

Sketch (Dahlgaard, Knudsen and Thorup, 2017): in round ``i`` every shingle is
hashed to one bin and a value; a bin keeps the smallest value of the first
round that reaches it. Rounds ``t .. 2t-1`` put every shingle into bin
``i - t``, so all ``t`` coordinates are filled, and the share of equal
coordinates of two sketches is concentrated around the Jaccard similarity.
Sketches are banded; candidates are confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_named, keep, mix64, pieces, sieve
from .components import components
from .shingles import shingle_sets

BANDS, ROWS = 32, 5
#: Coordinates of the longer sketch by which loose members are screened, a byte each.
SCREEN = 1024
#: A pair at the threshold falls below the screen with this many standard deviations' luck.
SCREEN_SIGMAS = 5.0
#: Buckets up to this size are compared by a join, larger ones in blocks of at most so many rows a side.
JOIN_SIZE, BLOCK = 48, 1024
#: Pairs of one document confirmed in one task.
VERIFY = 1000
_STEP = np.uint64(0xD1342543DE82EF95)


def similarity_sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """``len(sets) x t`` coordinates; rows of empty sets stay at the largest value."""
    docs = len(sets)
    sketch = np.full(docs * t, np.iinfo(np.uint64).max, np.uint64)
    filled = np.zeros((docs, t), bool)
    flat = filled.reshape(-1)
    size = np.array([len(s) for s in sets], np.int64)
    h = np.concatenate(sets) if docs else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(docs), size)
    for i in range(2 * t):
        if not len(h):
            break
        v = mix64(h + np.uint64(int(_STEP) * (i + 1) % 2**64))
        at = row * t + (((v >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32)).astype(np.int64) if i < t else row * t + (i - t)
        v = (v << np.uint64(32)) | (v >> np.uint64(32))
        free = ~flat[at]
        at, v = at[free], v[free]
        np.minimum.at(sketch, at, v)
        flat[at] = True
        more = ~filled.all(axis=1)[row]
        if not more.all():
            h, row = h[more], row[more]
    return sketch.reshape(docs, t)


def _sketcher(id_col: str, text_col: str, size: int, bands: int, rows: int):
    t = bands * rows
    weights = mix64(np.arange(1, rows + 1, dtype=np.uint64) * _STEP) | np.uint64(1)
    lane = mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def run(batches):
        for batch, data, starts in pieces(batches, [id_col], text_col):
            sets = shingle_sets(data, starts, size)
            sk = similarity_sketch(sets, t)
            keys = mix64((mix64(sk).reshape(-1, bands, rows) * weights).sum(axis=2, dtype=np.uint64) + lane)
            some = np.array([len(s) > 0 for s in sets])
            offsets = np.concatenate(([0], np.cumsum(np.where(some, bands, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index(id_col)).cast(pa.int64()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                         pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].reshape(-1).view(np.int64))),
            ], ["id", "n", "digest", "bands"])

    return run


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int,
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: ``id``, ``n`` distinct shingles, ``digest`` of the set, ``bands`` keys."""
    return column_named(docs, id_col, text_col).mapInArrow(
        _sketcher(id_col, text_col, size, bands, rows), "id long, n long, digest binary, bands array<long>")


def _verifier(size: int, percent: int):
    """Rows in order of ``a``, part and side: the text of ``a`` (side 0; an id may have
    several), then the texts compared with it."""
    def close(x, y):
        if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
            return False
        both = len(x) + len(y) - len(np.union1d(x, y))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches):
        now, heads = None, {}
        for batch in batches:
            for part, data, starts in pieces([batch], [], "text"):
                side, a, b, no = (part.column(part.schema.get_field_index(c)).to_numpy() for c in ("side", "a", "b", "part"))
                ok = np.zeros(part.num_rows, bool)
                for k, s in enumerate(shingle_sets(data, starts, size)):
                    if side[k] == 0:
                        if now != (a[k], no[k]):
                            now, heads = (a[k], no[k]), {}
                        heads[s.tobytes()] = s
                    else:
                        ok[k] = any(close(h, s) for h in heads.values())
                yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])

    return run


def _confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full shingle sets are similar enough.

    The text of ``a`` travels once for ``VERIFY`` pairs, not with each of them,
    and texts that are in no pair do not travel.
    """
    many = pairs.groupBy("a").agg(F.expr(f"ceil(count(*) / {VERIFY})").alias("parts"))
    pairs = keep(pairs.join(many, "a").selectExpr("a", "b", "pmod(xxhash64(b), parts) AS part"), "minhash-pairs")
    rows = pairs.select("a", "part").distinct().selectExpr("a", "part", "0 AS side", "a AS id").unionByName(
        pairs.selectExpr("a", "part", "1 AS side", "b AS id"))
    text = sieve(rows.select("id"), "minhash-text")(docs.select("id", "text"), "id")
    rows = rows.join(text, "id").selectExpr("a", "part", "side", "id AS b", "text")
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "side", "b").mapInArrow(
        _verifier(size, percent), "a long, b long").distinct()


def _screens(docs: DataFrame, size: int) -> DataFrame:
    """Per document a sketch of ``SCREEN`` coordinates, the low byte of each."""
    def run(batches):
        for batch, data, starts in pieces(batches, ["id"], "text"):
            sk = similarity_sketch(shingle_sets(data, starts, size), SCREEN)
            low = np.ascontiguousarray(mix64(sk).astype(np.uint8))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("id")), pa.array([r.tobytes() for r in low], pa.binary())],
                ["id", "screen"])

    return docs.mapInArrow(run, "id long, screen binary")


def _least_equal(percent: int) -> int:
    """Equal coordinates below which a pair at the threshold falls with a chance under one in a million."""
    p = percent / 100
    p += (1 - p) / 256
    return int(SCREEN * p - SCREEN_SIGMAS * (SCREEN * p * (1 - p)) ** 0.5)


def _apart(here: DataFrame, screen: DataFrame, bands: DataFrame, near: str, percent: int) -> DataFrame:
    """Distinct pairs of a loose and another member of one bucket, in two
    components, of sizes that can match and with sketches that are near."""
    least = _least_equal(percent)

    def screened(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(batch.schema.get_field_index(c)).to_pylist()), np.uint8)
                    .reshape(-1, SCREEN) for c in ("sa", "sb"))
            ok = pa.array((x == y).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)).filter(ok) for c in ("a", "b")], ["a", "b"])

    def block(pdf):
        x, y = pdf[pdf.side == 0], pdf[pdf.side == 1]
        sx, sy = (np.frombuffer(b"".join(z.screen), np.uint8).reshape(-1, SCREEN).T.copy() for z in (x, y))
        equal = np.zeros((len(x), len(y)), np.uint16)
        for k in range(SCREEN):
            equal += sx[k][:, None] == sy[k][None, :]
        n, m = x.n.to_numpy()[:, None], y.n.to_numpy()[None, :]
        ok = ((equal >= least) & (x.comp.to_numpy()[:, None] != y.comp.to_numpy()[None, :])
              & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
        p, q = x.id.to_numpy()[:, None], y.id.to_numpy()[None, :]
        ok &= ~y.loose.to_numpy()[None, :] | (p < q)  # two loose members meet twice
        i, j = np.nonzero(ok)
        # a pair that shares several buckets is this bucket's only if it is the first of them
        bx, by = np.stack(x.bands.to_numpy())[i], np.stack(y.bands.to_numpy())[j]
        first = (bx == by).argmax(axis=1)
        own = bx[np.arange(len(i)), first] == x.key.to_numpy()[i]
        i, j = i[own], j[own]
        p, q = x.id.to_numpy()[i], y.id.to_numpy()[j]
        return pd.DataFrame({"a": np.minimum(p, q), "b": np.maximum(p, q)})

    few = here.where(f"c <= {JOIN_SIZE}")
    other = few.selectExpr("key", "id AS other", "n AS m", "comp AS other_comp", "loose AS other_loose")
    joined = few.where("loose").join(other, "key").where(
        f"comp <> other_comp AND (id < other OR NOT other_loose) AND {near}").selectExpr(
        "least(id, other) AS a", "greatest(id, other) AS b").distinct()
    joined = (joined.join(screen.selectExpr("id AS a", "screen AS sa"), "a")
              .join(screen.selectExpr("id AS b", "screen AS sb"), "b").select("a", "b", "sa", "sb")
              .mapInArrow(screened, "a long, b long"))
    many = here.where(f"c > {JOIN_SIZE}").withColumn("ls", F.expr(f"ceil(l / {BLOCK})")).withColumn(
        "cs", F.expr(f"ceil(c / {BLOCK})")).join(screen, "id")
    many = many.join(bands, "id")
    rows = many.where("loose").withColumn("i", F.expr("pmod(xxhash64(id), ls)")).withColumn(
        "j", F.explode(F.expr("sequence(0L, cs - 1)"))).withColumn("side", F.lit(0)).unionByName(
        many.withColumn("i", F.explode(F.expr("sequence(0L, ls - 1)"))).withColumn(
            "j", F.expr("pmod(xxhash64(id), cs)")).withColumn("side", F.lit(1)))
    blocks = rows.select("key", "i", "j", "side", "id", "n", "comp", "loose", "screen", "bands").groupBy("key", "i", "j").applyInPandas(
        block, "a long, b long")
    return joined.unionByName(blocks).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: ``id``, ``n_shingles``, ``component`` and ``kept``.

    Documents are linked when 100 * common shingles >= ``percent`` * all
    shingles of the two; ``component`` is the smallest id that links reach.

    Documents with the same shingle set are one class. Classes that share a
    band bucket are candidates. A bucket is first compared with its smallest
    id only (linear work), which links most of a large bucket. A member that
    is not in that id's component then is loose, and every loose member is
    compared with all members of its bucket outside its own component: in
    small buckets by a join, in larger ones in blocks of sketches inside
    tasks, so that pairs far below the threshold never become rows. Every
    pair of one bucket and two components is compared.

    Ids are whole numbers. Null or empty text: no shingles, linked with nothing, kept. Null id:
    linked with nothing, ``component`` null, kept. Repeated rows: one result
    row. One id with several texts: linked if any of the texts is.
    """
    sk = keep(sketches(docs, id_col, text_col, size, bands, rows), "minhash-sketch")
    classes = keep(sk.where("digest IS NOT NULL AND id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("rep"), F.min(F.struct("id", "n", "bands")).alias("s"))
        .select("digest", "rep", "s.n", "s.bands"), "minhash-class")
    entry = classes.select(F.explode("bands").alias("key"), F.col("rep").alias("id"), "n")
    shared = entry.groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("pivot")).where("c > 1")
    entry = keep(entry.join(shared, "key"), "minhash-bucket")
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    near = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    head = entry.where("id = pivot").selectExpr("key", "n AS m")
    pairs = entry.where("id > pivot").join(head, "key").where(near).selectExpr("pivot AS a", "id AS b").distinct()
    links = keep(_confirmed(pairs, text, size, percent), "minhash-link")
    comp = components(links, "a", "b", "minhash-cc")
    here = entry.join(comp.withColumnRenamed("node", "id"), "id", "left").selectExpr(
        "key", "id", "n", "pivot", "coalesce(component, id) AS comp")
    main = here.where("id = pivot").selectExpr("key", "comp AS main")
    here = keep(here.join(main, "key").withColumn("loose", F.expr("id > pivot AND comp <> main")), "minhash-comp")
    count = here.groupBy("key").agg(F.count("*").alias("c"), F.expr("count_if(loose)").alias("l")).where("l > 0")
    here = keep(here.where("id > pivot").join(count.where("c > 2"), "key"), "minhash-open")
    if not here.isEmpty():
        ids = here.select("id").distinct()
        open_only = sieve(ids, "minhash-open-ids")
        screen = keep(_screens(open_only(text, "id").join(ids, "id", "left_semi"), size), "minhash-screen")
        pairs = _apart(here, screen, open_only(classes.selectExpr("rep AS id", "bands"), "id"), near, percent)
        links = keep(links.unionByName(_confirmed(pairs, text, size, percent)), "minhash-link")
        comp = components(links, "a", "b", "minhash-cc")
    found = classes.select("digest", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").selectExpr(
        "digest", "coalesce(component, rep) AS found")
    return sk.select("id", "n", "digest").distinct().join(found, "digest", "left").selectExpr(
        "id", "n AS n_shingles", "IF(id IS NULL, NULL, coalesce(found, id)) AS component",
        "id IS NULL OR id = coalesce(found, id) AS kept")
