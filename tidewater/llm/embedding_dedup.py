"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected at random to eight dimensions, scaled, and decoded
to the nearest point of the lattice E8; the point is the vector's cell in one
of several tables. A vector is compared with its own cell and with the
neighbouring cells that lie nearest to it, and the cosine of each candidate
pair is computed in double precision.
"""

from __future__ import annotations

import hashlib
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep, mix64
from .components import components

#: Tables, neighbouring cells probed in each, and the width of a cell in units
#: of the distance of two unit vectors (a pair at cosine 0.98 is 0.2 apart).
TABLES, PROBES, WIDTH = 12, 6, 1.0
#: Vectors of one cell held in memory at a time; larger cells are split.
CHUNK = 512


def lattice_roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 to each row: the better of D8 and D8 + 1/2.

    In D8 (integers of even sum) the nearest point is the rounded one, with
    the worst coordinate rounded the other way if the sum is odd.
    """
    best = None
    for shift in (0.0, 0.5):
        y = x - shift
        point = np.rint(y)
        odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
        off = y[odd] - point[odd]
        worst = np.abs(off).argmax(axis=1)
        point[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
        point += shift
        far = ((x - point) ** 2).sum(axis=1)
        if best is None:
            best, distance = point, far
        else:
            nearer = far < distance
            best[nearer] = point[nearer]
    return best


def cells(unit: np.ndarray, salt: np.ndarray, tables: int, probes: int, width: float) -> np.ndarray:
    """Cell keys, ``len(unit) x tables x (1 + probes)``: own cell first, then
    the neighbours by distance. ``salt`` keeps blocks of vectors apart."""
    roots, n = lattice_roots(), len(unit)
    out = np.empty((n, tables, 1 + probes), np.uint64)
    for t in range(tables):
        random = np.random.default_rng((20240229, unit.shape[1], t))
        x = unit @ random.standard_normal((unit.shape[1], 8)) / width + random.uniform(-4, 4, 8)
        own = decode(x)
        near = np.argpartition(-((x - own) @ roots.T), probes, axis=1)[:, :probes] if probes else np.zeros((n, 0), int)
        for k in range(1 + probes):
            point = np.rint(2 * (own if k == 0 else own + roots[near[:, k - 1]])).astype(np.int64).astype(np.uint64)
            key = mix64(salt + np.uint64(t + 1))
            for c in range(8):
                key = mix64(key ^ (point[:, c] + np.uint64(0x632BE59BD9B4E019)))
            out[:, t, k] = key
    return out


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components, their row numbers and lengths of a list column; null lists are empty."""
    col = batch.column(batch.schema.get_field_index("v"))
    sizes = np.array([0 if s is None else s for s in pa.compute.list_value_length(col).to_pylist()], np.int64)
    return col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes), sizes


def _vectors(batches):
    """Vectors that can be compared: id, label, digest of label and components, unit vector."""
    for batch in batches:
        flat, row, sizes = _rows(batch)
        # less a power of two, which is exact, so that no square is too large or too small
        largest = np.zeros(batch.num_rows)
        np.maximum.at(largest, row, np.abs(flat))
        flat = np.ldexp(flat, -np.frexp(np.where(np.isfinite(largest), largest, 1.0))[1][row])
        norm = np.sqrt(np.bincount(row, flat * flat, batch.num_rows))
        label = batch.column(batch.schema.get_field_index("label"))
        ids = batch.column(batch.schema.get_field_index("id"))
        ok = np.isfinite(norm) & (norm > 0) & ~np.array(label.is_null()) & ~np.array(ids.is_null())
        starts = np.concatenate(([0], np.cumsum(sizes)))
        units, digests = [], []
        for i in np.flatnonzero(ok):
            v = flat[starts[i]:starts[i + 1]]
            units.append((v / norm[i]).tobytes())
            digests.append(hashlib.blake2b(v.tobytes() + str(label[i]).encode(), digest_size=16).digest())
        mask = pa.array(ok)
        yield pa.RecordBatch.from_arrays(
            [ids.filter(mask), label.cast(pa.string()).filter(mask), pa.array(digests, pa.binary()),
             pa.array(units, pa.binary())], ["id", "label", "digest", "unit"])


def _cell_rows(tables: int, probes: int, width: float):
    def run(batches):
        for pdf in batches:
            size = pdf["unit"].str.len()
            for _, part in pdf.groupby(size):
                unit = np.frombuffer(b"".join(part["unit"]), np.float64).reshape(len(part), -1)
                salt = np.array([int.from_bytes(hashlib.blake2b(f"{x} {unit.shape[1]}".encode(), digest_size=8).digest(), "little")
                                 for x in part["label"]], np.uint64)
                keys = cells(unit, salt, tables, probes, width).view(np.int64).reshape(len(part), -1)
                yield pd.DataFrame({
                    "id": np.repeat(part["id"].to_numpy(), keys.shape[1]), "key": keys.reshape(-1),
                    "home": np.tile(np.arange(keys.shape[1]) % (1 + probes) == 0, len(part))})

    return run


def _compare(least: float):
    def run(batches):
        """Rows by cell and chunk, its own vectors (home) before those that probe it."""
        cell, ids, units = None, [], None
        held: list = []
        for batch in batches:
            key, chunk, home, vid = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                                     for c in ("key", "chunk", "home", "id"))
            raw = batch.column(batch.schema.get_field_index("unit")).to_pylist()
            if not len(key):
                continue
            cut = np.flatnonzero((key[1:] != key[:-1]) | (chunk[1:] != chunk[:-1]) | (home[1:] != home[:-1])) + 1
            a, b = [], []
            for lo, hi in zip(np.concatenate(([0], cut)), np.concatenate((cut, [len(key)]))):
                at = (key[lo], chunk[lo])
                if at != cell:
                    cell, ids, held, units = at, [], [], None
                if home[lo]:
                    ids.extend(vid[lo:hi])
                    held.extend(raw[lo:hi])
                    units = None
                elif held:
                    if units is None:
                        units = np.frombuffer(b"".join(held), np.float64).reshape(len(held), -1)
                        mine = np.array(ids)
                    for k in range(lo, hi, CHUNK):
                        some = raw[k:min(hi, k + CHUNK)]
                        x = np.frombuffer(b"".join(some), np.float64).reshape(len(some), -1)
                        i, j = np.nonzero(x @ units.T >= least)
                        p, q = vid[k:k + len(some)][i], mine[j]
                        a.append(np.minimum(p, q)[p != q])
                        b.append(np.maximum(p, q)[p != q])
            pairs = np.unique(np.stack((np.concatenate(a), np.concatenate(b)), axis=1), axis=0) if a else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])

    return run


def near_duplicate_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                           label_col: str = "label", cosine: float = 0.98, tables: int = TABLES,
                           probes: int = PROBES, width: float = WIDTH) -> DataFrame:
    """Per vector: ``id``, ``n_links``, ``component`` and ``kept``.

    Vectors of equal label and length are linked at ``cosine`` or more.
    Vectors that are null, empty, zero, not finite or hold nulls, and those
    without label or id, are linked with nothing (``component`` is their id).
    Equal vectors of one label form a class: links are searched between the
    smallest ids of classes and counted for all members, so copies are never
    paired. Repeated rows with one id and vector are one vector.

    A vector meets the vectors of its own cell and of ``probes`` cells
    around it. Cells that only one vector uses are dropped before vectors are
    moved; cells of more than ``CHUNK`` vectors are split, each chunk in a
    task of its own. Every vector is indexed.
    """
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
                        F.col(f"`{vector_col}`").cast("array<double>").alias("v")).distinct()
    # a null component makes the whole vector incomparable
    able = rows.withColumn("v", F.expr("IF(exists(v, x -> x IS NULL), NULL, v)"))
    able = keep(able.mapInArrow(_vectors, "id long, label string, digest binary, unit binary"), "vector-unit")
    classes = keep(able.groupBy("digest").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("size")), "vector-class")
    vectors = keep(able.join(classes.selectExpr("digest", "rep AS id"), ["digest", "id"]).select("id", "label", "unit"), "vector-rep")
    at = keep(vectors.mapInPandas(_cell_rows(tables, probes, width), "id long, key long, home boolean"), "vector-cell")
    used = at.groupBy("key").agg(F.expr("count_if(home)").alias("homes"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    used = used.where("homes > 0 AND lo <> hi").select("key", F.expr(f"ceil(homes / {CHUNK})").alias("chunks"))
    at = keep(at.join(used, "key"), "vector-used")
    homes = at.where("home").selectExpr("id", "key", "pmod(xxhash64(id), chunks) AS chunk", "true AS home")
    asks = at.selectExpr("id", "key", "explode(sequence(0L, chunks - 1)) AS chunk", "false AS home")
    both = homes.unionByName(asks).join(vectors.select("id", "unit"), "id")
    both = both.repartition("key", "chunk").sortWithinPartitions("key", "chunk", F.col("home").desc())
    links = keep(both.select("key", "chunk", "home", "id", "unit").mapInArrow(
        _compare(cosine), "a long, b long").distinct(), "vector-link")
    comp = components(links, "a", "b", "vector-cc").withColumnRenamed("node", "rep")
    sizes = classes.groupBy("rep").agg(F.sum("size").alias("size"))
    linked = links.unionByName(links.selectExpr("b AS a", "a AS b")).join(
        sizes.withColumnRenamed("rep", "b"), "b").groupBy("a").agg(F.sum("size").alias("others"))
    per_class = classes.join(linked.withColumnRenamed("a", "rep"), "rep", "left").join(comp, "rep", "left").selectExpr(
        "digest", "size - 1 + coalesce(others, 0) AS n", "coalesce(component, rep) AS c")
    found = able.select("id", "digest").distinct().join(per_class, "digest").groupBy("id").agg(
        F.sum("n").alias("n"), F.min("c").alias("c"))
    return rows.select("id").distinct().join(found, "id", "left").selectExpr(
        "id", "coalesce(n, 0L) AS n_links", "coalesce(c, id) AS component", "id IS NULL OR id = coalesce(c, id) AS kept")
