"""Phrase collocations against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidewater.llm import phrase_mining as pm

DOCS = "doc_id long, text string, lang string, key string, n string, size string"  # clashing names on purpose


def plain(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, 6):
                for i in range(len(ws) - m + 1):
                    f[lang][tuple(ws[i:i + m])] += 1
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    q = p[i:i + m]
                    inside[q] = max(inside[q], a)
        rows = []
        for p, a in candidates.items():
            if p in inside and 100 * inside[p] >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (count[p[:k]] * count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                        for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed, docs):
    rng = random.Random(seed)
    common = ["The", "of", "and", "río", "日本", "a", "\t", "x|y", "b", "c"]
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(common) + rng.choice([" ", " ", " ", "  ", ". ", ",", "\n", "\r\n", "\x0b", " \t "]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice([text, text + "New York city hall is big.", "new york City Hall, is BIG"]), rng.choice(["en", "en", "fr", None, "und"])))
    return rows + [("", "en"), (None, "en"), (" . ", None), ("word " * 3000, "fr"), *rows[:20]]


def run(spark, rows, least, top, **more):
    frame = spark.createDataFrame([(i, *r, "k", "n", "s") for i, r in enumerate(rows)], DOCS).repartition(3)
    got = pm.collocations(frame, least=least, top=top, **more)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("least,top", [(5, 2000), (12, 7)])
def test_against_plain_python(spark, least, top):
    rows = corpus(1, 150)
    want = plain(rows, least, top)
    assert len(want) >= 20
    assert run(spark, rows, least, top) == want


def test_collisions_are_counted_again_by_their_words(spark):
    rows = corpus(2, 60)
    want = plain(rows, 4, 2000)
    assert run(spark, rows, 4, 2000, bits=9, map_bits=1 << 9) == want
    assert run(spark, rows, 4, 2000, bits=2, map_bits=64) == want


def test_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(10 ** 12, 10 ** 15, 10 ** 13, 3 * 10 ** 12)], "a long, total long, l long, r long")
    row.createOrReplaceTempView("wide")
    got = spark.sql("SELECT (1000 * cast(a AS decimal(18, 0)) * cast(total AS decimal(18, 0))) div "
                    "(cast(l AS decimal(18, 0)) * cast(r AS decimal(18, 0))) AS s FROM wide").first()["s"]
    assert got == 1000 * 10 ** 27 // (3 * 10 ** 25)


def test_whole_table(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()]
    got = sorted(tuple(r) for r in E.queries()["op11_phrase_collocations"](spark, sf).collect())
    assert got == plain(rows, 100, 2000) and len(got) > 50


def test_no_texts(spark):
    assert run(spark, [], 2, 10) == [] and run(spark, [(None, None), ("", "en")], 1, 10) == []
