"""Language identification in two steps.

First the language family (one linear machine for each family, the largest
margin wins), then one-versus-one linear support vector machines between the
languages of that family, each giving a vote. Inputs are hashed counts of
byte pairs and triples inside words, so script, accents and endings count.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_named, mix64, pieces

#: Training documents for each language, about (a share of the language's rows by hash of doc_id).
PER_LANGUAGE = 1000
DIMENSIONS = 4096
ROUNDS, PENALTY = 200, 1e-4

# ISO 639-1 codes by language family. Codes not listed are a family of their own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr uz",
    "semitic": "ar he mt",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "sinitic": "yue zh",
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def vectors(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One unit vector of root counts for each text of a piece."""
    docs, n = len(starts) - 1, len(data)
    low = data + (((data >= 65) & (data <= 90)) * np.uint8(32))
    # digits, signs and blanks all become one mark for the edge of a word
    low = np.where((low >= 97) & (low <= 122) | (low >= 128), low, np.uint8(32)).astype(np.uint64)
    doc = np.repeat(np.arange(docs), np.diff(starts))
    out = np.zeros(docs * DIMENSIONS, np.float32)
    for size in (2, 3):
        if n < size:
            continue
        code = np.zeros(n - size + 1, np.uint64)
        for k in range(size):
            code = code * np.uint64(257) + low[k:n - size + 1 + k]
        inner = (low[1:n - size + 2] if size == 3 else low[:n - size + 1] + low[1:]) != (32 if size == 3 else 64)
        ok = inner & (doc[:n - size + 1] == doc[size - 1:])
        at = (mix64(code[ok] + np.uint64(size << 40)) >> np.uint64(52)).astype(np.int64)
        out += np.bincount(doc[:n - size + 1][ok] * DIMENSIONS + at, minlength=docs * DIMENSIONS).astype(np.float32)
    out = np.sqrt(out.reshape(docs, DIMENSIONS))
    return out / np.maximum(np.sqrt((out * out).sum(axis=1, keepdims=True)), 1e-9)


def _svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (last: bias) of a linear machine with squared hinge loss, by
    accelerated gradient descent; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weigh = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    y, weigh = y.astype(x.dtype), weigh.astype(x.dtype)
    w = v = np.zeros(x.shape[1], x.dtype)
    step = x.dtype.type(1 / (2 * 2 + PENALTY))
    for k in range(ROUNDS):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v + step * (x.T @ (x.dtype.type(2) * weigh * slack * y) - x.dtype.type(PENALTY) * v)
        v = new + x.dtype.type(k / (k + 3)) * (new - w)
        w = new
    return w


@dataclass
class Model:
    families: list[str] = field(default_factory=list)
    family_weights: np.ndarray | None = None  # one row for each family
    languages: dict[str, list[str]] = field(default_factory=dict)
    duels: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and a score from 0 to 1 for each row."""
        n = len(x)
        lang, score = np.full(n, "und", object), np.zeros(n)
        if not self.families or not n:
            return lang, score
        x = np.hstack([x, np.ones((n, 1), x.dtype)])
        margin = x @ self.family_weights.T
        best = margin.argmax(axis=1)
        sure = 1 / (1 + np.exp(-2 * margin[np.arange(n), best]))
        for f, name in enumerate(self.families):
            rows, codes = np.flatnonzero(best == f), self.languages[name]
            votes, total = np.zeros((len(rows), len(codes))), np.zeros((len(rows), len(codes)))
            for i, j in combinations(range(len(codes)), 2):
                m = np.tanh(x[rows] @ self.duels[codes[i], codes[j]])
                for k, sign in ((i, 1), (j, -1)):
                    votes[:, k] += sign * m > 0
                    total[:, k] += sign * m
            if len(rows):
                pick = (votes + total / (2 * len(codes))).argmax(axis=1)
                lang[rows] = np.array(codes, object)[pick]
                inner = total[np.arange(len(rows)), pick] / max(1, len(codes) - 1)
                score[rows] = sure[rows] * (1 if len(codes) == 1 else 1 / (1 + np.exp(-4 * inner)))
        return lang, score


def fit(x: np.ndarray, lang: np.ndarray) -> Model:
    model = Model()
    family = np.array([FAMILY_OF.get(c, c) for c in lang], object)
    model.families = sorted(set(family))
    if not model.families:
        return model
    model.family_weights = np.array([
        _svm(x, np.where(family == f, 1.0, -1.0)) if len(model.families) > 1 else np.zeros(x.shape[1] + 1)
        for f in model.families])
    for f in model.families:
        codes = model.languages[f] = sorted(set(lang[family == f]))
        for a, b in combinations(codes, 2):
            rows = (lang == a) | (lang == b)
            model.duels[a, b] = _svm(x[rows], np.where(lang[rows] == a, 1.0, -1.0))
    return model


def training_sample(docs: DataFrame, allowed: str = "true") -> tuple[np.ndarray, np.ndarray]:
    """Vectors and languages of about ``PER_LANGUAGE`` documents for each language.

    A document is taken if the hash of its id falls below the share that the
    language needs, so no language is ordered or gathered. Ids are drawn, and
    one row (of the smallest text) stands for each; a text without an id is
    its own.
    """
    known = docs.select("doc_id", "lang", "text").where(f"lang IS NOT NULL AND text IS NOT NULL AND ({allowed})")
    known = known.withColumn("doc_id", F.expr("coalesce(cast(doc_id AS long), xxhash64(text))"))
    count = known.select("lang", "doc_id").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    # one row for each language
    rows = known.join(F.broadcast(count), "lang").where(f"pmod(xxhash64(doc_id), 1000000) < 1e6 * {PER_LANGUAGE} / n")
    rows = rows.groupBy("lang", "doc_id").agg(F.min("text").alias("text"))

    def run(batches):
        for batch, data, starts in pieces(batches, [], "text"):
            x = vectors(data, starts)
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")).cast(pa.int64()),
                batch.column(batch.schema.get_field_index("lang")).cast(pa.string()),
                pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary())], ["doc_id", "lang", "x"])

    got = rows.mapInArrow(run, "doc_id long, lang string, x binary").toPandas().sort_values(["doc_id", "lang"])
    x = np.frombuffer(b"".join(got["x"]), np.float16).reshape(-1, DIMENSIONS).astype(np.float32)
    return x, got["lang"].to_numpy(object)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: ``doc_id``, ``lang_pred`` and ``score`` (0 to 1).

    Texts that are null or hold no letter are ``und`` with score 0, and so is
    every text if nothing was learned. Only the text is read; rows are
    independent, so repeated rows repeat their results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch, data, starts in pieces(batches, ["doc_id"], "text"):
            lang, score = m.predict(vectors(data, starts))
            ascii_letter = (data | 32) - 97 < 26
            letters = np.concatenate(([0], np.cumsum(ascii_letter)))
            for i in np.flatnonzero(letters[starts[1:]] == letters[starts[:-1]]):
                if not any(c.isalpha() for c in data[starts[i]:starts[i + 1]].tobytes().decode()):
                    lang[i], score[i] = "und", 0.0
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")), pa.array(lang, pa.string()), pa.array(score)],
                ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return column_named(docs, "doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
