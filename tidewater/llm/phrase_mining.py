"""Collocations by Rabin-Karp fingerprints.

Words are hashed by prefix polynomials over the bytes, phrases by prefix
polynomials over the word hashes, so that every run of words of a text costs
one subtraction and one multiplication. A shuffle adds up, for each fingerprint,
the occurrences, the bounds of a second fingerprint to another modulus, and a
pointer to a text that has it. A fingerprint whose occurrences do not agree in
the second one stands for several phrases, and is counted again by its words.
Only phrases that are frequent are ever spelled out, from the texts pointed at.

A phrase is frequent only if the phrases inside it are, so two words are
counted first, then those three whose two pairs are frequent, then longer ones.
What is frequent travels as a bitmap of fixed size: a false positive only
costs a row more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, mix64, pieces
from .shingles import _power_tables, span_hasher, spans

#: Least number of occurrences, most words, and phrases returned for a language.
LEAST, MOST_WORDS, TOP = 100, 5, 2000
#: Bytes of text hashed at a time, and bits of a map of frequent phrases (4 MB).
PIECE_BYTES, MAP_BITS = 300_000, 1 << 25
_PRIME = (1 << 31) - 1
_BASE_CHECK = 1_103_515_245
_PER_SIZE = mix64(np.arange(1, MOST_WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[ord(c) for c in ".,;:!?"] + list(range(10, 14))] = True
BLANKS = np.zeros(256, bool)
BLANKS[[32, 9]] = True

_prime_powers: list[np.ndarray] = []


def _check_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the second base and of its inverse modulo the prime."""
    if not _prime_powers or len(_prime_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        out = []
        for base in (_BASE_CHECK, pow(_BASE_CHECK, -1, _PRIME)):
            p = np.ones(1, np.uint64)
            step = base
            while len(p) < size:  # p[k + len] = p[k] * base ** len
                p = np.concatenate((p, p * np.uint64(step) % np.uint64(_PRIME)))
                step = step * step % _PRIME
            out.append(p)
        if size > 1 << 22:  # for one very long text only
            return out[0], out[1]
        _prime_powers[:] = out
    return _prime_powers[0], _prime_powers[1]


def _prefix(values: np.ndarray) -> np.ndarray:
    """Prefix polynomial modulo the prime of values below it."""
    terms = values * _check_powers(len(values) + 1)[0][:len(values)] % np.uint64(_PRIME)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(terms, out=total[1:])  # under 2 ** 64 for 2 ** 33 values
    return total % np.uint64(_PRIME)


def _span_checks(prefix: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = _check_powers(len(prefix))[1]
    return (prefix[end] + np.uint64(_PRIME) - prefix[first]) % np.uint64(_PRIME) * inverse[first] % np.uint64(_PRIME)


class Words:
    """The words of a piece of texts: fingerprints of all their runs by size."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, lang: np.ndarray, bits: int = 64):
        self.data, self.bits = data, bits
        ws, we = spans(starts, ~(SEPARATORS[data] | BLANKS[data]))
        self.first, self.end = ws, we
        self.text = np.searchsorted(starts, ws, "right") - 1
        cut = np.cumsum(SEPARATORS[data])[ws] if len(ws) else np.zeros(0, np.int64)
        new = np.concatenate(([True], (self.text[1:] != self.text[:-1]) | (cut[1:] != cut[:-1]))) if len(ws) else np.zeros(0, bool)
        self.run = np.cumsum(new)
        self.lang = lang[self.text].view(np.uint64)
        hashed = span_hasher(data)(ws, we)
        power, self._inverse = _power_tables(len(ws) + 1)
        self._total = np.zeros(len(ws) + 1, np.uint64)
        np.cumsum(hashed * power[:len(ws)], out=self._total[1:])
        low = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
        second = _span_checks(_prefix(low.astype(np.uint64) + np.uint64(1)), ws, we)
        # lengths tell a word from one with other letters at its end
        self._checks = _prefix((second * np.uint64(131) + (we - ws).astype(np.uint64)) % np.uint64(_PRIME))

    def runs(self, size: int) -> np.ndarray:
        """First words of the runs of ``size`` words within a piece of text."""
        n = len(self.run) - size + 1
        return np.flatnonzero(self.run[size - 1:] == self.run[:n]) if n > 0 else np.zeros(0, np.int64)

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        """Fingerprints of the runs of ``size`` words from ``at``, with their languages."""
        h = (self._total[at + size] - self._total[at]) * self._inverse[at]
        h = mix64(mix64(h + _PER_SIZE[size - 1]) + self.lang[at])
        return h if self.bits == 64 else h >> np.uint64(64 - self.bits)

    def checks(self, at: np.ndarray, size: int) -> np.ndarray:
        return _span_checks(self._checks, at, at + size).astype(np.int32)

    def spell(self, raw: bytes, at: int, size: int) -> str:
        out = b" ".join(raw[self.first[k]:self.end[k]] for k in range(at, at + size))
        return out.translate(_LOWER).decode()


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _holds(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the map has the keys (rarely: has not, and says so all the same)."""
    mask = np.uint64(len(bitmap) * 8 - 1)
    out = np.ones(len(keys), bool)
    for k in (keys, keys >> np.uint64(32)):
        bit = (k & mask) if k is keys else mix64(k) & mask
        out &= (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def _bitmap(spark, keys: DataFrame, bits: int):
    """A map of ``key`` as a broadcast: at most ``bits`` bits reach the driver, however many keys."""
    def run(batches):
        seen = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            k = batch.column(0).to_numpy().view(np.uint64)
            mask = np.uint64(bits - 1)
            for bit in (k & mask, mix64(k >> np.uint64(32)) & mask):
                np.bitwise_or.at(seen, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        at = np.flatnonzero(seen)
        for lo in range(0, len(at), 50_000):
            some = at[lo:lo + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[some].view(np.int64))], ["at", "word"])

    rows = keys.select("key").mapInArrow(run, "at int, word long").groupBy("at").agg(F.expr("bit_or(word)").alias("word")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[rows["at"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(out.view(np.uint8))


def _counted(docs: DataFrame, sizes: tuple[int, ...], known, bits: int) -> DataFrame:
    """Fingerprints of the runs of the sizes: ``size``, ``key``, ``n``, bounds of the
    check (``low``, ``high``) and the pointer ``text_hash``.

    ``known`` maps the frequent runs of one word less than the least size; a run
    counts only if all runs of that size inside it are there. Without it, a row
    of size 0 has the number of words of each language (by ``lang_hash``) too.
    """
    names = ["size", "key", "n", "low", "high", "text_hash"]

    def rows(size, key, n, low, high, text):
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(key), size, np.int32)), pa.array(key.view(np.int64)), pa.array(n.astype(np.int64)),
            pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(text.astype(np.int64))], names)

    def run(batches):
        for batch, data, starts in pieces(batches, ["text_hash", "lang_hash"], "text", PIECE_BYTES):
            lang, pointer = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("lang_hash", "text_hash"))
            w = Words(data, starts, lang, bits)
            if known is None:
                key, n = np.unique(w.lang, return_counts=True)
                none = np.zeros(len(key), np.int32)
                yield rows(0, key, n, none, none, none)
            else:
                inner = min(sizes) - 1
                ok, at = np.zeros(len(w.run) + 1, bool), w.runs(inner)
                ok[at[_holds(known.value, w.keys(at, inner))]] = True
            for size in sizes:
                at = w.runs(size)
                if known is not None:
                    for k in range(size - inner + 1):
                        at = at[ok[at + k]]
                if not len(at):
                    continue
                key, check, text = w.keys(at, size), w.checks(at, size), pointer[w.text[at]]
                order = np.argsort(key)
                key, check, text = key[order], check[order], text[order]
                first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                yield rows(size, key[first], np.diff(np.concatenate((first, [len(key)]))), np.minimum.reduceat(check, first),
                           np.maximum.reduceat(check, first), np.minimum.reduceat(text, first))

    return docs.select("text", "text_hash", "lang_hash").mapInArrow(
        run, "size int, key long, n long, low int, high int, text_hash long").groupBy("size", "key").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("text_hash").alias("text_hash"))


def _spelled(docs: DataFrame, marked, by_text: bool, bits: int) -> DataFrame:
    """Phrases in words: ``size``, ``key``, ``text_hash``, ``lang``, ``phrase``, ``n``.

    Of the runs whose key is in the map ``marked``, with their number in a piece;
    ``by_text``: whose key and text together are there, once for each text.
    """
    names = ["size", "key", "text_hash", "lang", "phrase", "n"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches):
        for batch, data, starts in pieces(batches, ["text_hash", "lang_hash", "lang"], "text", PIECE_BYTES):
            lang, pointer = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("lang_hash", "text_hash"))
            w = Words(data, starts, lang, bits)
            raw, name, count = data.tobytes(), batch.column(batch.schema.get_field_index("lang")).to_pylist(), {}
            for size in range(1, MOST_WORDS + 1):
                at = w.runs(size)
                key, text = w.keys(at, size), w.text[at]
                got = np.flatnonzero(_holds(marked.value, _with_text(key, pointer[text]) if by_text else key))
                if by_text and len(got):  # the first place of each
                    order = np.lexsort((key[got], text[got]))
                    k, t = key[got][order], text[got][order]
                    got = got[order[np.concatenate(([True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])))]]
                for j in got.tolist():
                    entry = (size, int(key[j].view(np.int64)), int(pointer[text[j]]) if by_text else 0, name[text[j]],
                             w.spell(raw, at[j], size))
                    count[entry] = count.get(entry, 0) + 1
            cols = list(zip(*[(*e, n) for e, n in count.items()])) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    return docs.select("text", "text_hash", "lang_hash", "lang").mapInArrow(
        run, "size int, key long, text_hash long, lang string, phrase string, n long")


def _with_text(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mix64(key ^ mix64(text.view(np.uint64)))


def _pair_marks(batches):
    for batch in batches:
        key, text = (batch.column(k).to_numpy() for k in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(_with_text(key.view(np.uint64), text).view(np.int64))], ["key"])


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST,
                     bits: int = 64, map_bits: int = MAP_BITS) -> tuple[DataFrame, DataFrame]:
    """Runs of 1 to 5 words with at least ``least`` occurrences in a language (``lang``,
    ``phrase``, ``size``, ``n``), and all words of each language (``lang``, ``total``).

    ``bits`` of the first fingerprint are used (fewer only to test collisions).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{text_col}`").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    langs = docs.select("lang").distinct().selectExpr("lang", "xxhash64(lang) AS key")
    docs = docs.where("octet_length(text) > 0").selectExpr("text", "lang", "xxhash64(text, lang) AS text_hash", "xxhash64(lang) AS lang_hash")
    least = int(least)
    found, known, totals = None, None, None
    for sizes in ((1, 2), (3,), tuple(range(4, MOST_WORDS + 1))):
        counted = keep(_counted(docs, sizes, known, bits).where(f"n >= {least} OR size = 0"), f"phrase-{sizes[-1]}")
        if totals is None:
            totals = keep(counted.where("size = 0").selectExpr("key", "n AS total").join(langs, "key").select("lang", "total"), "phrase-totals")
            counted = counted.where("size > 0")
        known = _bitmap(spark, counted.where(f"size = {sizes[-1]}"), map_bits)
        found = counted if found is None else found.unionByName(counted)
    one, several = found.where("low = high"), found.where("low <> high").select("size", "key")
    pointed = _bitmap(spark, one.select("key", "text_hash").mapInArrow(_pair_marks, "key long"), map_bits)
    spelled = _spelled(docs, pointed, True, bits).select("size", "key", "text_hash", "lang", "phrase").distinct()
    plain = one.join(spelled, ["size", "key", "text_hash"]).select("lang", "phrase", "size", "n")
    if not several.isEmpty():  # counted again, by their words
        again = _bitmap(spark, several, map_bits)
        by_words = _spelled(docs, again, False, bits).join(several, ["size", "key"], "left_semi").groupBy(
            "lang", "phrase", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
        plain = plain.unionByName(by_words)
    return keep(plain, "phrase-frequent"), totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                 bits: int = 64, map_bits: int = MAP_BITS) -> DataFrame:
    """The best phrases of 2 to 5 words of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line
    ends, pieces into words at blanks and tabs. ``a`` counts the phrase, ``l``
    and ``r`` the two parts at the cut that scores least, ``n`` all words; the
    score is floor(1000 a n / (l r)), exact. A phrase goes if a longer frequent
    one that holds it is as frequent. Order: score and ``a`` from the highest,
    then the phrase by its bytes. Null and empty texts have no words, a null
    language is ``und``, repeated rows count each time, an empty table gives
    no rows. ``top`` is the length of the report.
    """
    frequent, totals = frequent_phrases(docs, text_col, lang_col, least, bits, map_bits)
    phrases = frequent.where("size > 1").selectExpr("lang", "phrase", "size", "n AS a", "split(phrase, ' ') AS ws")
    cuts = phrases.selectExpr("lang", "phrase", "a", "ws", "size", "explode(sequence(1, size - 1)) AS k").selectExpr(
        "lang", "phrase", "a", "k", "array_join(slice(ws, 1, k), ' ') AS left_part", "array_join(slice(ws, k + 1, size - k), ' ') AS right_part")
    count = frequent.select("lang", "phrase", "n")
    cuts = cuts.join(count.selectExpr("lang", "phrase AS left_part", "n AS l"), ["lang", "left_part"])
    cuts = cuts.join(count.selectExpr("lang", "phrase AS right_part", "n AS r"), ["lang", "right_part"])
    # at most 38 digits: a and n are counts of words, below 10 ** 17
    wide = "cast({} AS decimal(18, 0))"
    cuts = cuts.join(totals, "lang").selectExpr(
        "lang", "phrase", "a", "k", "l", "r", "total AS n",
        f"(1000 * {wide.format('a')} * {wide.format('total')}) div ({wide.format('l')} * {wide.format('r')}) AS score")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select(
        "lang", "phrase", "a", "n", "c.score", "c.l", "c.r")
    inner = phrases.where("size > 2").selectExpr("lang", "a", "ws", "size", "explode(sequence(2, size - 1)) AS m").selectExpr(
        "lang", "a", "ws", "m", "explode(sequence(1, size - m + 1)) AS i").selectExpr("lang", "a", "array_join(slice(ws, i, m), ' ') AS phrase")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = best.join(inner, ["lang", "phrase"], "left").where("longer IS NULL OR 100 * longer < 100 * a")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", place.cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same report by counting every run of words as text.
ORACLE = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, {MOST_WORDS + 1})) AS m)),
f AS (SELECT lang, phrase, m, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS total FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, m, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE m > 1 AND n >= {LEAST}),
k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
s AS (SELECT k.lang, k.phrase, k.a, k.k, x.n AS l, y.n AS r, t.total AS n,
    CAST((1000::HUGEINT * k.a * t.total) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.m = k.k AND x.phrase = array_to_string(k.ws[1:k.k], ' ')
  JOIN f y ON y.lang = k.lang AND y.m = k.m - k.k AND y.phrase = array_to_string(k.ws[k.k + 1:k.m], ' ') JOIN t ON t.lang = k.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
z AS (SELECT lang, array_to_string(ws[i:i + j - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS j FROM c)) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM b LEFT JOIN z ON z.lang = b.lang AND z.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= {TOP}
"""
