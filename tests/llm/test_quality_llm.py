"""Quality rules against plain Python, and verdicts on labelled documents."""

import math
import random
import re
from collections import Counter, defaultdict

from tidewater.llm import quality_rules as qr

DOCS = "doc_id long, text string, lang string, ws string, classes int, common string, n_words int"  # clashing names on purpose
PATTERNS = [re.compile(c) for c in qr.CLASSES]


def base(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = defaultdict(list)
    for i in range(len(ws) - 4):
        grams[tuple(ws[i:i + 5])].append(i)
    covered = {p for at in grams.values() if len(at) > 1 for i in at for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def classes(text):
    out = []
    for p in PATTERNS:
        out.append(len(p.findall(text)))
        text = p.sub("", text)
    return out + [len(text)]


def distance(p, q):
    half = lambda a, b: a * math.log2(2 * a / (a + b)) / 2 if a > 0 else 0
    return math.sqrt(max(0, sum(half(a, b) + half(b, a) for a, b in zip(p, q))))


def plain(rows):
    per = defaultdict(list)
    for _, text, lang in rows:
        per["und" if lang is None else lang].append(text or "")
    refs = {}
    for lang, texts in per.items():
        c = [sum(x) for x in zip(*map(classes, texts))]
        words = Counter(w.lower() for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t))
        top = sorted(words, key=lambda w: (-words[w], w.encode()))[:qr.COMMON]
        n = sum(words.values())
        refs[lang] = ([x / max(sum(c), 1) for x in c], top, [words[w] / n for w in top])
    out = []
    for i, text, lang in rows:
        text = text or ""
        b = base(text)
        failed = b[0] < 10 or 100 * b[4] > 20 * b[0]
        share, top, q = refs["und" if lang is None else lang]
        far = False
        chars = words = None
        if len(text) >= qr.LEAST_CHARS:
            chars = distance([x / len(text) for x in classes(text)], share)
            far |= chars > qr.CHAR_DISTANCE + math.sqrt(len(qr.CLASSES) / len(text))
        if b[0] >= qr.LEAST_COMMON_WORDS:
            c = Counter(w.lower() for w in re.findall(r"[^\x20\x09-\x0D]+", text))
            p = [c[w] / b[0] for w in top]
            words = distance([*p, 1 - sum(p)], [*q, max(0, 1 - sum(q))])
            far |= words > qr.WORD_DISTANCE + math.sqrt(qr.COMMON / (8 * b[0]))
        out.append((i, *b, failed, not failed and not far, chars, words))
    return out


def corpus(seed):
    rng = random.Random(seed)
    common = ["the", "The", "of", "and", "río", "in", "日本"]
    rows = []
    for i in range(60):
        ws = [rng.choice(common) if rng.random() < 0.6 else f"w{rng.randrange(900)}" for _ in range(rng.choice([3, 9, 12, 60, 300]))]
        rows.append((i, "".join(w + rng.choice([" ", " ", "  ", "\n", ". ", "\t"]) for w in ws), rng.choice(["en", "fr", None])))
    rows += [(100, None, "en"), (101, "", None), (102, " \n\t", "en"), (103, "the of " * 200, "en"), (104, "### $$$ |||\n" * 40, "en"),
             (105, "THE! OF! " * 40, "fr"), (106, "x" * 50_000, "en"), (107, "a b c d e a b c d e a b c d e\n" * 30, "fr"), (108, "\r\n".join(["one line"] * 9), "xx")]
    return rows + rows[:5]


def test_against_plain_python(spark):
    rows = corpus(1)
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DOCS)
    got = qr.quality(frame, carry=("doc_id", "ws")).collect()
    assert got[0].asDict().keys() >= {"doc_id", "ws", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"}
    cut = lambda x: None if x is None else round(x, 9)
    found = sorted((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"],
                    r["kept"], str(cut(r["char_distance"])), str(cut(r["word_distance"]))) for r in got)
    assert found == sorted((*r[:8], str(cut(r[8])), str(cut(r[9]))) for r in plain(rows))
    assert {r[7] for r in found} == {True, False}
    assert qr.quality(frame.limit(0)).count() == 0


def test_given_references_and_unknown_languages(spark):
    rows = [(i, "the cat and the dog of the house " * 12, "en") for i in range(3)]
    frame = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], DOCS)
    refs = qr.language_references(frame)
    other = frame.withColumn("lang", qr.F.lit("zz"))
    got = qr.quality(other, references=refs).collect()
    assert [(r["char_distance"], r["word_distance"]) for r in got] == [(None, None)] * 3


def test_labelled_documents(spark):
    """Junk goes and no clean document is lost beyond the base rules."""
    sf = "/root/testdata/sf0.01"
    out = qr.quality(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    clean = [r for r in out if r["quality"] == 1 and not r["base_failed"]]
    junk = [r for r in out if r["quality"] == 0 and r["n_words"] >= qr.LEAST_COMMON_WORDS]
    assert len(clean) > 200 and all(r["kept"] for r in clean)
    assert len(junk) > 30 and sum(not r["kept"] for r in junk) >= 0.95 * len(junk)
