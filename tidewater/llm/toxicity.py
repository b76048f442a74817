"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score over its
words and their stems (first bytes); the document's score is the noisy-or
of its sentences, ``1 - prod(1 - p)``. Weights are learned from document
labels through the noisy-or, so that the blame falls on the sentences that
explain a label, and these scores then locate the offending sentences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column_named, keep, mix64, pieces
from .shingles import span_hasher, spans

#: Labelled documents used for training, at most: toxic and clean (the lowest hashes of doc_id).
MAX_TOXIC, MAX_CLEAN = 2000, 4000
#: Documents of the sample in which a feature must occur.
MIN_DOCS = 4
#: Features kept: those that differ by so much between the labels (chi squared; chance gives it to one in a hundred).
LEAST_DIFFER = 6.63
#: Bytes of a word that count as its stems.
STEMS = (4, 5, 6)
ROUNDS, RATE, DECAY = 200, 1.0, 1e-6


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float


def sentences(data: np.ndarray, starts: np.ndarray):
    """Features of a piece of texts: ``(hash, sentence)`` and, per sentence,
    the text number and the first and last byte's place in the piece.

    Words are runs of letters, digits and bytes of other scripts; sentences
    end at ``.``, ``!``, ``?`` and line ends.
    """
    inside = ((data >= 48) & (data <= 57)) | ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)
    ws, we = spans(starts, inside)
    if not len(ws):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    doc = np.searchsorted(starts, ws, "right") - 1
    ends = np.cumsum((data == 46) | (data == 33) | (data == 63) | (data == 10))[ws]
    new = np.concatenate(([True], (doc[1:] != doc[:-1]) | (ends[1:] != ends[:-1])))
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(ws)])) - 1
    hashed = span_hasher(data)
    h, of = [hashed(ws, we)], [sentence]
    for size in STEMS:
        long = we - ws > size
        h.append(mix64(hashed(ws[long], ws[long] + size) + np.uint64(size)))
        of.append(sentence[long])
    return np.concatenate(h), np.concatenate(of), doc[first], ws[first], we[last]


def _sentence_scores(model: Model, h: np.ndarray, sentence: np.ndarray, count: int) -> np.ndarray:
    at = np.searchsorted(model.features, h)
    at[at == len(model.features)] = 0
    known = model.features[at] == h if len(model.features) else np.zeros(len(h), bool)
    once = np.unique(sentence[known] * np.int64(len(model.features) + 1) + at[known])  # a repeated word counts once
    sentence, at = np.divmod(once, len(model.features) + 1)
    z = model.bias + np.bincount(sentence, model.weights[at], count)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _texts_of(texts) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))


def _doc_counts(data: np.ndarray, starts: np.ndarray, labels: np.ndarray):
    """Features of a piece of labelled texts: in how many texts, and toxic texts, each is."""
    h, sentence, doc, _, _ = sentences(data, starts)
    feature, index = np.unique(h, return_inverse=True)
    once = np.unique(index * np.int64(len(labels) + 1) + doc[sentence])
    return feature, *(np.bincount(once // (len(labels) + 1), w, len(feature)).astype(np.int64)
                      for w in (None, labels[once % (len(labels) + 1)]))


def _bags(data: np.ndarray, starts: np.ndarray, features: np.ndarray):
    """What training needs of a piece of texts: feature and sentence of each entry, text of each
    sentence that has a feature, and number of the other sentences of each text."""
    h, sentence, doc, _, _ = sentences(data, starts)
    at = np.searchsorted(features, h)
    known = at < len(features)
    known[known] = features[at[known]] == h[known]
    of, at = np.divmod(np.unique(sentence[known] * np.int64(len(features) + 1) + at[known]), len(features) + 1)
    there = np.zeros(len(doc), bool)
    there[of] = True
    empty = np.bincount(doc[~there], minlength=len(starts) - 1)
    return at, (np.cumsum(there) - 1)[of], doc[there], empty


def _descend(features: np.ndarray, labels: np.ndarray, j: np.ndarray, s: np.ndarray, doc: np.ndarray, empty: np.ndarray) -> Model:
    """Maximum likelihood of the labels under the noisy-or, by full-batch AdaGrad. Sentences
    without a feature are all alike, so they enter by their number."""
    docs = len(labels)
    w, b, n = np.zeros(len(features)), -5.0, len(doc)
    gw, gb = np.full(len(features), 1e-8), 1e-8
    toxic = labels.astype(bool)
    positive = toxic[doc]
    for _ in range(ROUNDS):
        p = np.clip(1 / (1 + np.exp(-np.clip(b + np.bincount(s, w[j], n), -30, 30))), 1e-9, 1 - 1e-9)
        p0 = min(max(1 / (1 + np.exp(-min(max(b, -30), 30))), 1e-9), 1 - 1e-9)
        clean = np.exp(np.bincount(doc, np.log1p(-p), docs) + empty * np.log1p(-p0))
        blame = clean / np.maximum(1 - clean, 1e-9)
        d = np.where(positive, p * blame[doc], -p)
        dw = np.bincount(j, d[s], len(features)) / docs - DECAY * w
        db = (d.sum() + (empty * np.where(toxic, p0 * blame, -p0)).sum()) / docs
        gw += dw * dw
        gb += db * db
        w += RATE * dw / np.sqrt(gw)
        b += RATE * db / np.sqrt(gb)
    used = np.abs(w) > 0.01
    return Model(features[used], w[used], float(b))


def _constant(labels: np.ndarray) -> Model | None:
    """The model of labels that are all alike."""
    if len(labels) and labels.min() != labels.max():
        return None
    return Model(np.zeros(0, np.uint64), np.zeros(0), 30.0 if len(labels) and labels.min() else -30.0)


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """The model of labelled texts that are at hand (see ``learn`` for a table of them)."""
    model = _constant(labels)
    if model:
        return model
    feature, docs, toxic = _doc_counts(*_texts_of(texts), labels)
    share = labels.mean()
    differ = (toxic - docs * share) ** 2 / np.maximum(docs * share * (1 - share), 1e-9)
    features = feature[(differ >= LEAST_DIFFER) & (docs >= MIN_DOCS)]
    return _descend(features, labels, *_bags(*_texts_of(texts), features))


def training_sample(docs: DataFrame, labels: DataFrame, allowed: str = "true") -> DataFrame:
    """Rows ``order``, ``doc_id``, ``toxic``, ``text``: the ``MAX_TOXIC`` toxic and ``MAX_CLEAN``
    clean labelled documents of lowest hash among those that ``allowed`` admits, one row (of
    the smallest text) for each, so at most ``MAX_TOXIC + MAX_CLEAN`` in all."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(allowed).withColumn("order", F.xxhash64("doc_id"))
    picked = None
    for value, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        part = known.where(F.col("toxic") == value).orderBy("order", "doc_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    # at most MAX_TOXIC + MAX_CLEAN rows of two numbers are broadcast
    rows = column_named(docs, "doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("order", "doc_id", "toxic").agg(F.min("text").alias("text"))


def learn(docs: DataFrame, labels: DataFrame, allowed: str = "true") -> Model:
    """The model of a sample of the labelled documents.

    Texts stay on the executors: there features are counted, and those kept are
    looked up. The driver gets the kept features and, for each document of
    the sample, which of its sentences hold which of them.
    """
    rows = keep(training_sample(docs, labels, allowed).selectExpr("order", "doc_id", "cast(toxic AS bigint) AS toxic", "text"), "toxic-sample")
    total, toxic = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not total or toxic in (0, total):
        return _constant(np.array([int(bool(toxic))] * min(total, 1)))

    def count(batches):
        for batch, data, starts in pieces(batches, [], "text"):
            of = batch.column(batch.schema.get_field_index("toxic")).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (lambda f, d, t: (f.view(np.int64), d, t))(*_doc_counts(data, starts, of))],
                                             ["feature", "docs", "toxic"])

    share = toxic / total
    counted = rows.mapInArrow(count, "feature long, docs long, toxic long").groupBy("feature").agg(
        F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
    kept = counted.where(f"docs >= {MIN_DOCS} AND pow(toxic - docs * {share!r}D, 2) / greatest(docs * {share * (1 - share)!r}D, 1e-9D) >= {LEAST_DIFFER}D")
    features = np.sort(kept.select("feature").toArrow().column(0).to_numpy().view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(features)

    def look_up(batches):
        names = ["order", "doc_id", "toxic", "empty", "features", "sizes"]
        for batch, data, starts in pieces(batches, [], "text"):
            j, s, doc, empty = _bags(data, starts, shared.value)
            size = np.bincount(s, minlength=len(doc))  # entries of each sentence
            entries = np.concatenate(([0], np.cumsum(np.bincount(doc, size, len(starts) - 1)))).astype(np.int32)
            held = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(starts) - 1)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(c)) for c in ("order", "doc_id", "toxic")], pa.array(empty.astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(entries), pa.array(j.astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(held), pa.array(size.astype(np.int32)))], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    bags = rows.mapInArrow(look_up, f"order long, doc_id {kind}, toxic long, empty long, features array<int>, sizes array<int>")
    found = bags.toArrow().sort_by([("order", "ascending"), ("doc_id", "ascending")]).combine_chunks()
    sizes = found.column("sizes").combine_chunks()
    doc = np.repeat(np.arange(found.num_rows), np.diff(sizes.offsets.to_numpy()))
    per = sizes.flatten().to_numpy()
    return _descend(features, found.column("toxic").to_numpy(), found.column("features").combine_chunks().flatten().to_numpy(),
                    np.repeat(np.arange(len(per)), per), doc, found.column("empty").to_numpy())


def scorer(spark: SparkSession, model: Model):
    """A function of a text column that gives its score; the rows stay with Spark, only texts go to Python."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = [np.zeros(0)]
        for _, data, starts in pieces([pa.RecordBatch.from_arrays([texts], ["t"])], [], "t"):
            h, sentence, doc, _, _ = sentences(data, starts)
            p = _sentence_scores(shared.value, h, sentence, len(doc))
            found.append(_noisy_or(p, doc, len(starts) - 1))
        return pa.array(np.concatenate(found))

    return score


def _noisy_or(p: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    return 1 - np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-15)), docs))


def toxicity(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: ``doc_id``, ``score``, ``predicted``, ``sentences`` and the columns in ``carry``.

    ``sentences`` lists the offending ones (score 0.5 or more) by first and
    end byte and score. Null and empty texts, and texts without words, have no
    sentences and score 0. Rows are independent; repeated rows repeat their
    results. The model is small (one weight for each feature of the sample).
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch, data, starts in pieces(batches, ["doc_id"], "text"):
            h, sentence, doc, first, end = sentences(data, starts)
            p = _sentence_scores(m, h, sentence, len(doc))
            score = _noisy_or(p, doc, len(starts) - 1)
            hot = np.flatnonzero(p >= 0.5)
            offsets = np.concatenate(([0], np.cumsum(np.bincount(doc[hot], minlength=len(starts) - 1)))).astype(np.int32)
            spans = pa.StructArray.from_arrays(
                [pa.array(first[hot] - starts[doc[hot]]), pa.array(end[hot] - starts[doc[hot]]), pa.array(p[hot])],
                ["start", "end", "score"])
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("doc_id")), pa.array(score),
                pa.array((score >= 0.5).astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), spans),
                *[batch.column(batch.schema.get_field_index(c)) for c in carry],
            ], ["doc_id", "score", "predicted", "sentences", *carry])

    kind = docs.schema["doc_id"].dataType.simpleString()
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return column_named(docs, *dict.fromkeys(("doc_id", "text", *carry))).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, sentences array<struct<start: long, end: long, score: double>>{more}")
