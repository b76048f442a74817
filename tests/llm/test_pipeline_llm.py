"""The corpus pipeline on a small corpus with planted cases, against plain Python."""

import hashlib
import random

import corpus_pipeline
import public_tokenizers as vocabulary
import tiktoken

from tidewater.llm.byte_bpe import read_ranks

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score double"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


def corpus():
    rng = random.Random(8)
    rows = {i: words(rng, 120) + "." for i in range(60)}
    for i in range(60, 90):
        rows[i] = words(rng, 50) + ". You foul rat. " + words(rng, 50)
    rows[100] = rows[5]                                               # exact copy
    rows[101] = " ".join("changed" if k == 60 else w for k, w in enumerate(rows[6].split()))  # near copy
    passage = words(rng, 60)
    rows[102], rows[103] = words(rng, 40) + " " + passage, words(rng, 50) + " " + passage     # repeated passage
    item = words(rng, 40)
    rows[104] = words(rng, 200) + " " + item + " " + words(rng, 30)   # benchmark leak
    rows[105], rows[106] = "", None
    return rows, passage, item


def test_pipeline_against_plain_python(spark, tmp_path):
    rows, passage, item = corpus()
    sf = str(tmp_path)
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 1.0) for i, t in rows.items()], DOCS)
    frame.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(60 <= i < 90)) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(
        f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")

    texts = {i: t for i, t in rows.items() if not 60 <= i < 90 and i not in (100, 101)}
    seen = set()
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        if any(gone):
            texts[i] = bytes(c for c, g in zip(b, gone) if not g).decode()
    assert passage in texts[102] and passage not in texts[103]
    del texts[104]
    with open(vocabulary.path("byte_bpe_50k.tiktoken"), "rb") as f:
        public = tiktoken.Encoding("t", pat_str=vocabulary.PATTERN, mergeable_ranks=read_ranks(f.read()), special_tokens={})
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert sorted(got) == sorted(texts)
    for i, t in texts.items():
        assert list(got[i]["ids"]) == public.encode_ordinary(t or ""), i
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()

    docs = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.dtypes == frame.dtypes, name


def test_leaks_without_an_id_go(spark, tmp_path):
    rng = random.Random(3)
    item, other = words(rng, 30), words(rng, 30)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"{other} {item}", 1), (None, other, 2), (None, None, 3), (4, f"{item} {other}", 4), (5, other, 5), (6, None, 6),
            (None, "", 7), (None, other, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __key long")
    left = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path))
    assert left.dtypes == docs.dtypes
    assert sorted(r["__key"] for r in left.collect()) == [2, 3, 5, 6, 7, 8]


def test_pipeline_on_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], DOCS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0
