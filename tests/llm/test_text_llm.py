"""BPE, language, toxicity, extraction, chat, URL and leak operators on small inputs."""

import hashlib
import random

import numpy as np
import public_tokenizers as vocabulary
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import byte_bpe, chat_format, decontaminate, html_extract, language_id, queries, toxicity, url_filter
from tidewater.llm.byte_bpe import (PieceEncoder, StreamDecoder, Transducer, DIGESTS, bpe_encode, digest_columns, read_ranks,
                                    utf8_advance)

RANKS = vocabulary.path("byte_bpe_50k.tiktoken")
with open(RANKS, "rb") as _f:
    _RANKS = read_ranks(_f.read())
_PUBLIC = tiktoken.Encoding("t", pat_str=vocabulary.PATTERN, mergeable_ranks=_RANKS, special_tokens={})
_TRANSDUCER = Transducer(_RANKS)
_ENCODER, _DECODER = PieceEncoder(_TRANSDUCER, vocabulary.PATTERN), StreamDecoder(_TRANSDUCER.bytes_of)
DOCS = "doc_id long, text string, lang string, ids string, decoded string, score string, held_out int"


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "x", "y", "z", 1) for i, t in enumerate(texts)], DOCS)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_is_that_of_the_public_library(text):
    ids = _ENCODER.encode(text).tolist()
    assert ids == _PUBLIC.encode_ordinary(text)
    assert _DECODER.decode(ids) == text


@pytest.mark.parametrize("text", ["aaab" * 5000, "ab" * 9000, " " * 3000, "日本語" * 2000, "thethethe" * 900])
def test_bpe_long_pieces(text):
    assert _ENCODER.encode(text).tolist() == _PUBLIC.encode_ordinary(text)


@given(st.binary(max_size=12), st.integers(0, 12))
def test_decoder_mends_broken_bytes(raw, cut):
    a, open_bytes = utf8_advance(b"", raw[:cut])
    b, open_bytes = utf8_advance(open_bytes, raw[cut:])
    assert a + b + ("�" if open_bytes else "") == raw.decode("utf-8", "replace")


def test_bpe_rows(spark):
    texts = [None, "", "Hello  world\n\n", "é\u0000ü", "x" * 50_000, "Hello  world\n\n"]
    made = bpe_encode(docs_of(spark, texts), RANKS, vocabulary.PATTERN, then=digest_columns, columns=DIGESTS)
    got = {r["doc_id"]: r for r in made.collect()}
    plain = {r["doc_id"]: r for r in bpe_encode(docs_of(spark, texts), RANKS, vocabulary.PATTERN).collect()}
    for i, t in enumerate(texts):
        ids = _PUBLIC.encode_ordinary(t or "")
        assert list(got[i]["ids"]) == list(plain[i]["ids"]) == ids and plain[i]["decoded"] == (t or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe_encode(docs_of(spark, texts).limit(0), RANKS, vocabulary.PATTERN).count() == 0


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op6_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 150 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edges(spark):
    docs = docs_of(spark, ["the cat and the dog", "der Hund und die Katze", None, "", "123 !?", "日本"] * 3)
    docs = docs.selectExpr("doc_id", "text", "IF(doc_id % 6 = 1, 'de', IF(doc_id % 6 = 0, 'en', NULL)) AS lang", "ids")
    model = language_id.fit(*language_id.training_sample(docs))
    got = [r["lang_pred"] for r in language_id.identify(docs, model).orderBy("doc_id").collect()]
    assert got[:5] == ["en", "de", "und", "und", "und"]
    nothing = language_id.fit(*language_id.training_sample(docs.limit(0)))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels, "crc32(cast(doc_id AS string)) % 5 <> 0")
    rows = toxicity.toxicity(docs, model).join(labels, "doc_id").where("crc32(cast(doc_id AS string)) % 5 = 0").collect()
    bad = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert len(bad) > 30 and sum(r["predicted"] for r in bad) >= 0.8 * len(bad)
    assert sum(r["predicted"] for r in clean) <= 0.03 * len(clean)


def test_toxicity_learned_on_executors_is_the_model_of_the_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.training_sample(docs, labels).orderBy("order", "doc_id").collect()
    one, other = toxicity.fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows])), toxicity.learn(docs.repartition(5), labels)
    assert len(one.features) > 20 and list(one.features) == list(other.features)
    assert np.allclose(one.weights, other.weights, atol=1e-6) and abs(one.bias - other.bias) < 1e-6


def test_toxicity_finds_the_sentence(spark):
    clean = [f"A quiet day number {i}. The river is calm." for i in range(40)]
    rude = [f"A quiet day number {i}. You foul rat. The river is calm." for i in range(40)]
    docs = docs_of(spark, clean + rude + [None, "", "..."])
    labels = spark.createDataFrame([(i, int(i >= 40), 5) for i in range(80)] + [(None, 1, 5), (1, None, 5)],
                                   "doc_id long, toxic int, text int")
    model = toxicity.learn(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, model).collect()}
    assert all(got[i]["predicted"] == int(i >= 40) for i in range(80))
    text = rude[0].encode()
    assert [text[s["start"]:s["end"]].decode() for s in got[40]["sentences"]] == ["You foul rat"]
    assert [got[i]["score"] for i in (80, 81, 82)] == [0.0] * 3
    one = toxicity.learn(docs, labels.where("toxic = 0"))
    assert {r["predicted"] for r in toxicity.toxicity(docs, one).collect()} == {0}
    assert toxicity.learn(docs, labels.limit(0)).bias < 0
    assert toxicity.toxicity(docs.limit(0), model).count() == 0


def test_toxicity_keeps_every_feature_that_differs():
    """Features are kept by how much they differ, however many there are."""
    words = [f"w{k:04d}{'abcdefgh'[k % 8]}" for k in range(2400)]
    groups = [" ".join(words[8 * g:8 * g + 8]) for g in range(300)]
    toxic = [t for g, t in enumerate(groups) for _ in range(12 if g < 200 else 8)]
    model = toxicity.fit(toxic + [f"plain text {d}" for d in range(len(toxic))], np.repeat([1, 0], len(toxic)))
    assert len(model.features) >= 4800  # words, and their stems of five bytes


def test_training_samples_take_an_id_once(spark):
    docs = docs_of(spark, ["a b", "c d", "e f"])
    docs = docs.unionByName(docs.where("doc_id = 1").withColumn("text", F.lit("c e"))).unionByName(docs).unionByName(docs)
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 0)], "doc_id long, toxic int")
    sample = toxicity.training_sample(docs, labels).collect()
    assert sorted((r["text"], r["toxic"]) for r in sample) == [("a b", 0), ("c d", 1), ("e f", 0)]
    x, lang = language_id.training_sample(docs.unionByName(docs.withColumn("doc_id", F.expr("cast(null AS long)"))))
    assert len(x) == len(lang) == 3 + 4  # three ids, and four texts without one


def test_html_extraction(spark):
    pages = {
        1: ('<body><nav><a href=1>Home</a></nav><div class="sidebar"><p>Other things to read in our paper today and tomorrow.</p></div>'
            '<article><h1>A &amp; B</h1><p>First\n  line &eacute;.<br>Second<p>Third <b>bold</b> &am</article>'
            '<section class="comments"><p>I do not agree with what the writer says about A and B here.</p></section>'
            '<footer>&copy; us</footer></body>', "A & B\nFirst line é. Second\nThird bold &am"),
        2: ('<html><head><title>No</title><style>p{}</style></head><body><script>x("<p>")</script><div class="cookie-notice">We use '
            'cookies on this site, do you agree?</div><main><p>Text of the page, long enough to be kept by all.</p><form><p>Mail</p>'
            '<button>Go</button></form></main></body>', "Text of the page, long enough to be kept by all."),
        3: (None, ""), 4: ("", ""), 5: ("<p", ""), 6: ("<article><p>" + "word " * 30_000 + "</article>", "word " * 29_999 + "word"),
    }
    df = spark.createDataFrame([(i, "u", h, "clash") for i, (h, _) in pages.items()], "page_id long, url string, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_extract.extract(df).collect()}
    assert got == {i: (t, len(t)) for i, (_, t) in pages.items()}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_html_open_heads_and_icons():
    text = "Text of the page, long enough to be kept by all who read it."
    article = f"<article><p>{text}</p></article>"
    model = html_extract.fit()
    for html in (
            f"<html><head><title>No</title><meta charset=u><body>{article}</body></html>",  # end tag of head left out
            f"<head><title>No</title><noscript><link href=x><body>{article}", f"<head><head><title>No</title>{article}",
            f"<head><title>No</title></head><body>{article}", f"<head><script>x</script><img src=1>{article}",
            f"<body><article><svg viewBox='0 0 1 1'/><p>{text}</p></article>", f"<body><article><p><math/>{text}</p></article>",
            f"<body><article><svg><path d=M0 /><use href=x /><title>No</title></svg><p>{text}</p></article>",
            f"<body><article><svg><g><path d=M0></g><p>{text}</p></article>",  # never closed: a paragraph ends it
            f"<body><article><svg><foreignObject><div/><p>No</p></foreignObject></svg><p>{text}</p></article>"):
        assert html_extract.main_text(model, html) == text, html
    open_head = html_extract.parse(f"<head><title>No</title>{text}")
    assert [open_head.tag[n] for n, _, t, _ in open_head.pieces] == ["title", "root"]
    assert html_extract.main_text(model, f"<body><article><div/><p>{text}</p></article>") == text  # HTML ignores the slash


def test_messages_are_exact_marginals():
    """Sum-product agrees with summing over all labellings of a small tree."""
    import itertools
    import math
    page = html_extract.parse("<body><div class=ad><p>x</p></div><article><p>yes it is</p></article></body>")
    model = html_extract.fit(rounds=30)
    feats = html_extract.node_features(page)
    n, total, on = len(page.parent), 0.0, [0.0] * len(page.parent)
    for labels in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(sum(model.unary.get(x, 0) for x in f) * v for f, v in zip(feats, labels))
                     + sum(model.pair[labels[page.parent[k]]][labels[k]] for k in range(1, n)))
        total += w
        on = [o + w * v for o, v in zip(on, labels)]
    assert html_extract.marginals(model, page, feats)[0] == pytest.approx([o / total for o in on])


CONVERSATIONS = "conv_id long, turn long, role string, text string, window string, n long, body string"


def test_chat_windows(spark):
    long = [(1, k, "user" if k % 2 else "assistant", f"turn {k} " + "word " * 150) for k in range(1, 40)]
    rows = [(1, 0, "system", "be kind")] + long + [
        (2, 0, "user", "</s>[INST] <user>&lt; &amp;lt; & [/INST]"), (2, 1, "assistant", None), (3, 0, None, ""),
        (None, 0, "assistant", "x"), (4, 1, "assistant", "a"), (4, 1, "assistant", "a"), (5, 0, "user", "y" * 9000),
        (5, 1, "assistant", "</s>"), (6, None, "system", "s")]
    df = spark.createDataFrame([(*r, "w", 1, "b") for r in rows], CONVERSATIONS)
    windows = chat_format.format_conversations(df)
    mine = [r for r in windows.orderBy("window").collect() if r["conv_id"] == 1]
    assert len(mine) > 5 and all(r["n_tokens"] <= chat_format.BUDGET for r in mine)
    assert all(r["text"].startswith("<system>be kind</s>") for r in mine) and all(r["copies"] >= 2 for r in mine[1:])
    targets = [r["text"][s["start"]:s["end"]] for r in mine for s in r["loss"]]
    assert targets == [t for _, _, role, t in sorted(long, key=lambda r: r[1]) if role == "assistant"]
    got = {r["conv_id"]: r for r in chat_format.read_back(windows).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted([r for r in rows if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        assert (got[conv]["n_turns"], got[conv]["turns_sha256"]) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat_format.format_conversations(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op5_chat_format", "op10_decontaminate"])
def test_query_matches_sql(spark, name):
    from oracle_harness import compare
    r = compare(spark, name, "/root/testdata/sf0.01")
    assert r["types_match"] and r["values_match"], r


def test_url_rules_and_trees(spark):
    urls = ["https://A.Example.com/en/1", "http://www.example.com/en/x?y", "http://shop.com", "http://shop.com/", "http://b.net/es/1",
            "http://b.net/fr/", "http://b.net/de/", None, "", "no scheme", "x://", "http://h.org/p?q=1&r=2#f", "http://netcom/x",
            "http://a.com?x=/en/", "http://b.net/es/1"]
    df = spark.createDataFrame([(i, u, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, host string, suffix string")
    rows = url_filter.judge_urls(df, queries.URL_RULES, trees=2, depth=2).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2][:3] == ("shop.com", "", None) and got[3][2:] == ("com/", "allow")
    assert got[4][2:] == got[14][2:] == ("net/es/", "block") and got[5][2:] == ("net/fr/", "block") and got[6][2] is None
    assert all(got[i][:3] == ("", "", None) for i in (7, 8, 9, 10))
    assert got[11][:3] == ("h.org", "/p", None) and got[12][2] is None and got[13][:3] == ("a.com", "", None)
    assert all(v[3] in ("allow", "block") for v in got.values())
    assert {r["verdict"] for r in url_filter.judge_urls(df.where("page_id = 6"), queries.URL_RULES).collect()} == {"allow"}
    assert {r["verdict"] for r in url_filter.judge_urls(df.where("page_id IN (4, 6)"), queries.URL_RULES).collect()} == {"block"}
    assert url_filter.judge_urls(df.limit(0), queries.URL_RULES).count() == 0


def test_url_statistics_count_all_labelled_rows(spark, monkeypatch):
    """One URL repeated more often than the sample is large fills no sample, and suffixes are counted over all rows."""
    monkeypatch.setattr(url_filter, "MAX_LABELLED", 200)
    low = spark.range(4000).selectExpr("concat('http://b.net/es/', id) AS url").selectExpr("min_by(url, xxhash64(url)) AS url").first()["url"]
    urls = [low] * 300 + [f"http://shop{k}.com/a" for k in range(300)] + ["http://x.org/es/1", "http://shop.org/a"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(4)
    seen, build = [], url_filter.VectorAssembler

    class Seen(build):
        def transform(self, rows, params=None):
            seen.append(rows)
            return super().transform(rows)
    monkeypatch.setattr(url_filter, "VectorAssembler", Seen)
    got = url_filter.judge_urls(df, queries.URL_RULES, trees=2, depth=2)
    assert got.count() == len(urls) and len(seen) == 2  # the sample has both verdicts, so trees are trained
    trained = seen[0].groupBy("label").count().collect()
    assert sum(r["count"] for r in trained) == 200 and min(r["count"] for r in trained) > 60
    shares = {r["suffix"]: r["suffix_blocked"] for r in seen[0].select("suffix", "suffix_blocked").distinct().collect()}
    assert shares == pytest.approx({"net": (300 + 10) / 320, "com": 10 / 320})


def test_leaks_are_found_inside_long_documents(spark):
    item = " ".join(f"Q{i}" for i in range(30))
    words = item.split()
    changed = " ".join("zz" if i in (3, 12) else w for i, w in enumerate(words))
    filler = " ".join(f"f{i}" for i in range(20_000))
    docs = spark.createDataFrame(
        [(1, f"{filler} {item.lower()}\n{filler}", 0), (2, changed, 0), (3, " ".join(words[:20]), 0), (4, None, 0), (5, "", 0),
         (6, "a b", 0), (7, "x a b", 0), (1, f"{filler} {item.lower()}\n{filler}", 0), (None, item, 0)],
        "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(10, item, 1), (11, None, 1), (12, "", 1), (13, "A  b", 1), (10, item, 1)],
                                  "item_id long, text string, doc_id long")
    got = sorted((r["doc_id"], r["item_id"], r["shared"], r["item_shingles"]) for r in decontaminate.contained_items(docs, items).collect())
    near = len({tuple(words[i:i + 5]) for i in range(26)} & {tuple(changed.split()[i:i + 5]) for i in range(26)})
    assert got == [(1, 10, 26, 26), (6, 13, 1, 1)] and near < 0.8 * 26
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0


def test_bpe_small_caches_change_nothing(monkeypatch):
    for name in ("MAX_PIECES", "MAX_STATES", "MAX_FITS", "MAX_SPINES", "MAX_MOVES"):
        monkeypatch.setattr(byte_bpe, name, 40)
    with open(RANKS, "rb") as f:
        transducer = byte_bpe.Transducer(byte_bpe.read_ranks(f.read()))
    encoder, decoder = byte_bpe.PieceEncoder(transducer, vocabulary.PATTERN), byte_bpe.StreamDecoder(transducer.bytes_of)
    rng = random.Random(5)
    for _ in range(60):
        text = " ".join("".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 9))) for _ in range(30)) + "ab" * 300
        ids = encoder.encode(text).tolist()
        assert ids == _PUBLIC.encode_ordinary(text) and decoder.decode(ids) == text
        assert len(encoder) <= 20 and len(encoder.older) <= 20 and len(transducer._fits) <= 40


def test_chat_windows_keep_the_budget(spark):
    """No window is over the budget unless one turn, or the system turn, is too long by itself."""
    rng = random.Random(8)
    rows = [(c, t, "system" if t == 0 and c % 2 else "user", "x" * rng.choice([1, 20, 200, 700, 1500, 2600 if c > 9 else 9]))
            for c in range(20) for t in range(60)]
    rows += [(100, t, "user", "x" * (4 * n - 16)) for t, n in enumerate([5, 765] + [50] * 15)]
    df = spark.createDataFrame([(*r, "w", 1, "b") for r in rows], CONVERSATIONS)
    got = chat_format.format_conversations(df).collect()
    longest = {c: max(len(r[3]) for r in rows if r[0] == c) // 4 + 5 for c in {r[0] for r in rows}}
    for r in got:
        assert r["n_tokens"] <= chat_format.BUDGET or longest[r["conv_id"]] > 256
    assert all(r["n_tokens"] <= chat_format.BUDGET for r in got if r["conv_id"] < 10)


def test_leaks_of_an_id_with_several_rows(spark):
    ws = [f"w{k}" for k in range(40)]
    docs = [(1, " ".join(ws[:14])), (1, " ".join(ws[10:24])), (2, " ".join(ws[:14])), (3, " ".join(ws[:24]))]
    found = decontaminate.contained_items(spark.createDataFrame(docs, "doc_id long, text string"),
                                          spark.createDataFrame([(7, " ".join(ws[:24]))], "item_id long, text string"))
    assert sorted((r["doc_id"], r["containment"]) for r in found.collect()) == [(1, 1.0), (3, 1.0)]


ODD_PAGES = ["<![ endif]>", "<![foo[", "<![CDATA[x]]>", "<!", "<!-", "<!DOCTYPE", "<!doctype [<!ENTITY x>]>", "<!ELEMENT", "<?php x", "</", "<", "<a",
             "</>", "&#xfffffff;", "&#0;", "<p <b", "<svg><![CDATA[a>b]]></svg>", "<!--", "<!-->", "--!>", "<textarea><p>", "<plaintext>x"]


def test_no_page_stops_extraction():
    model, rng = html_extract.fit(), random.Random(4)
    article = "<article><h1>Rivers</h1><p>The water rose in March and stayed high for a whole week.</p></article>"
    for odd in ODD_PAGES[:2]:
        assert "The water rose" in html_extract.main_text(model, f"<body>{odd}{article}</body>")
    for odd in ODD_PAGES:
        html_extract.main_text(model, odd)
        html_extract.main_text(model, f"<body>{odd}{article}")
    parts = [*ODD_PAGES, "<div>", "</div>", "<p>", "text ", "<form>", "</form>", "<a href=x>", "</a>", "<head>", "<body>", "\x00", "é", "<td>", "<li>", "]]>"]
    for _ in range(1500):
        html_extract.main_text(model, "".join(rng.choice(parts) for _ in range(rng.randrange(12))))


def test_forms_and_bare_text_hold_articles():
    model = html_extract.fit()
    text = "The water rose in March and stayed high for a whole week, and farmers moved their herds to the hills."
    page = f"<body><form id=aspnetForm><nav><a href=1>Home</a></nav><article><h1>Rivers</h1><p>{text}</p></article></form></body>"
    assert html_extract.main_text(model, page) == f"Rivers\n{text}"
    assert html_extract.main_text(model, text + "  " + text) == f"{text} {text}"
    assert text in html_extract.main_text(model, f'<body><div class="response-body"><p>{text}</p><p>{text}</p></div></body>')
    assert html_extract.main_text(model, "") == ""


def test_extraction_is_linear_in_depth():
    import time
    model, took = html_extract.fit(), []
    for n in (4000, 16000):
        start = time.perf_counter()
        html_extract.main_text(model, "<div>x" * n + "</i>" * n + "</div>" * n)
        took.append(time.perf_counter() - start)
    assert took[1] < 9 * took[0]
