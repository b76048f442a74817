"""Benchmark decontamination by size-partitioned MinHash containment search.

A benchmark item of ``q`` shingles is contained in a document when at least
``percent`` % of them occur there, however long the document is. Items are
partitioned by size (powers of two). The MinHash sketch of an item is its
``k`` smallest shingle hashes, and ``k`` is set by the partition: at most
``q - ceil(q * percent / 100)`` of an item's shingles can be missing from a
document that contains it, so of one more than that many, at least one is
there. Documents are probed with all their shingles, hence no containing
document is missed; the number of sketch hits prunes further, and the
candidates are verified on the shingles themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep

WORDS, PERCENT = 5, 80


def _words(text: str) -> str:
    """SQL: the words of a text column, lower-cased; blanks and 0x09-0x0D part words."""
    return f"filter(split(lower({text}), '[ \\\\x09-\\\\x0D]+'), w -> w <> '')"


def _shingles(size: int, form: str) -> str:
    """SQL: each run of ``size`` entries of ``ws`` put through ``form``; fewer words make one run."""
    whole = form.format(", ".join(f"ws[i + {k}]" for k in range(size)))
    short = form.format(", ".join(f"coalesce(get(ws, {k}), '')" for k in range(size)))
    return (f"CASE WHEN size(ws) >= {size} THEN transform(sequence(0, size(ws) - {size}), i -> {whole}) "
            f"WHEN size(ws) > 0 THEN array({short}) ELSE array() END")


def contained_items(docs: DataFrame, items: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Pairs of a document and an item that it contains: ``doc_id``, ``item_id``,
    ``shared`` and ``item_shingles`` (distinct shingles) and ``containment``.

    A shingle is ``size`` successive words; a text of fewer words has its
    whole sequence as one. Null or wordless texts contain nothing and are
    contained in nothing; rows without an id are left out. Repeated rows do
    not repeat pairs; an id with several texts counts all their shingles. No
    size limits: sketches and candidates are joined as Spark finds best from
    their written size, by broadcast only below its threshold.
    """
    docs = docs.selectExpr("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    items = items.selectExpr("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    hashed, spelled = _shingles(size, "xxhash64({})"), _shingles(size, "concat_ws(' ', {})")
    wanted = items.selectExpr("item_id", f"{_words('text')} AS ws").selectExpr(
        "item_id", f"explode({spelled}) AS shingle").distinct()
    wanted = wanted.groupBy("item_id").agg(F.collect_set("shingle").alias("shingles")).selectExpr(
        "item_id", "shingles", "size(shingles) AS q")
    # hashes of an item's shingles, from its words like those of the documents
    small = items.selectExpr("item_id", f"{_words('text')} AS ws").selectExpr(
        "item_id", f"explode({hashed}) AS h").distinct().groupBy("item_id").agg(F.sort_array(F.collect_set("h")).alias("hs"))
    wanted = keep(wanted.join(small, "item_id").selectExpr(
        "item_id", "shingles", "hs", "q", "pow(2, ceil(log2(q))) AS class")
        # missing at most by an item of the class: its largest size decides
        .selectExpr("*", f"least(q, class - ceil(class * {percent} / 100) + 1) AS k"), "leak-items")
    sketch = keep(wanted.selectExpr("item_id", "q", "k", "explode(slice(hs, 1, cast(k AS int))) AS h"), "leak-sketch")

    probe = docs.selectExpr("doc_id", f"{_words('text')} AS ws").selectExpr(
        "doc_id", "size(ws) AS n", f"explode({hashed}) AS h")
    # an id with several rows has the shingles of all of them, so none of its rows is too short by itself
    several = docs.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id", F.lit(True).alias("several"))
    hits = probe.join(sketch, "h").join(several, "doc_id", "left").where(
        f"coalesce(several, false) OR greatest(n - {size - 1}, 1) * 100 >= q * {percent}")
    candidates = keep(hits.groupBy("doc_id", "item_id").agg(
        F.countDistinct("h").alias("hits"), F.first("q").alias("q"), F.first("k").alias("k"))
        .where(f"hits >= k - (q - ceil(q * {percent} / 100))").select("doc_id", "item_id"), "leak-candidates")

    asked = candidates.join(wanted.selectExpr("item_id", "explode(shingles) AS shingle"), "item_id")
    there = docs.join(candidates.select("doc_id").distinct(), "doc_id", "left_semi").selectExpr(
        "doc_id", f"{_words('text')} AS ws").selectExpr("doc_id", f"explode({spelled}) AS shingle").distinct()
    shared = asked.join(there, ["doc_id", "shingle"]).groupBy("doc_id", "item_id").agg(F.count("*").alias("shared"))
    return shared.join(wanted.select("item_id", "q"), "item_id").where(f"shared * 100 >= q * {percent}").selectExpr(
        "doc_id", "item_id", "shared", "cast(q AS bigint) AS item_shingles", "shared / q AS containment")


#: The same pairs by brute force.
ORACLE = f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[ \\x09-\\x0D]+'), lambda w: w <> '') AS ws
           FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
i AS (SELECT item_id, list_filter(string_split_regex(lower(text), '[ \\x09-\\x0D]+'), lambda w: w <> '') AS ws
      FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= {WORDS}
         THEN list_transform(range(1, len(ws) - {WORDS - 2}), lambda k: array_to_string(ws[k:k + {WORDS - 1}], ' '))
         WHEN len(ws) > 0 THEN [rpad_ws] ELSE [] END) AS s
       FROM (SELECT *, array_to_string(ws, ' ') || repeat(' ', {WORDS} - len(ws)) AS rpad_ws FROM d)),
si AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(ws) >= {WORDS}
         THEN list_transform(range(1, len(ws) - {WORDS - 2}), lambda k: array_to_string(ws[k:k + {WORDS - 1}], ' '))
         WHEN len(ws) > 0 THEN [rpad_ws] ELSE [] END) AS s
       FROM (SELECT *, array_to_string(ws, ' ') || repeat(' ', {WORDS} - len(ws)) AS rpad_ws FROM i)),
q AS (SELECT item_id, count(*) AS q FROM si GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS shared FROM ds JOIN si USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, q AS item_shingles, round(shared / q, 6) AS containment
FROM c JOIN q USING (item_id) WHERE shared * 100 >= q * {PERCENT}
"""
