"""MinHash, suffix-array and embedding deduplication against brute force on small tables."""

import contextlib
import io
import random
import re

import numpy as np
import pytest

from tidewater.llm import common, embedding_dedup, minhash_dedup, suffix_dedup
from tidewater.llm.shingles import shingle_sets

DOCS = "doc_id long, text string, id long, n long, `kept` boolean, h string"  # clashing names on purpose


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 7, 7, False, "x") for i, t in rows], DOCS)


def components(nodes, links):
    label = {n: n for n in nodes}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute_minhash(rows, size, percent):
    sets = {i: shingle_set(t, size) for i, t in rows if i is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return sets, components(ids, links)


def near_copies(rng, groups, copies, words=60):
    rows, i = [], 0
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randrange(0, 6)):
                t[rng.randrange(words)] = f"x{rng.randrange(10 ** 6)}"
            rows.append((i, " ".join(t)))
            i += 1
    return rows


def check_minhash(spark, rows, size=4, percent=80):
    got = {r["id"]: r for r in minhash_dedup.near_duplicates(frame(spark, rows), size=size, percent=percent).collect()}
    sets, comp = brute_minhash(rows, size, percent)
    assert {i: (len(sets[i]), comp[i], comp[i] == i) for i in sets} == {
        i: (r["n_shingles"], r["component"], r["kept"]) for i, r in got.items() if i is not None}
    return got


def test_shingles_are_those_of_the_words():
    texts = ["A b  c\td e", "a B c d\x0be", "a b", "", " \n", "x", "é É a b c d"]
    raw = [t.encode() for t in texts]
    starts = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
    sets = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), starts, 4)
    assert [len(s) for s in sets] == [len(shingle_set(t, 4)) for t in texts]
    assert (sets[0] == sets[1]).all()


def test_sketch_estimates_similarity_and_fills():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(1, 2 ** 62, 500).astype(np.uint64))
    sets = [a, a[:400], a[250:], a[:1]]
    s = minhash_dedup.similarity_sketch(sets, 160)
    assert (s != np.iinfo(np.uint64).max).all()
    for k, j in ((1, 0.8), (2, 0.5)):
        assert abs((s[0] == s[k]).mean() - j) < 0.13


def test_minhash_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one two"), (5, "ONE  two"), (5, "ONE  two"), (None, "one two"),
            (6, "a b c d e f " * 3000), (7, "a b c d e f " * 3000 + "g"), (8, "alone in the world of words")]
    got = check_minhash(spark, rows)
    assert (got[None]["component"], got[None]["kept"]) == (None, True)
    assert minhash_dedup.near_duplicates(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("join_size", [48, 2])
def test_minhash_matches_brute_force(spark, monkeypatch, join_size):
    """With a small join size, large buckets take the block path."""
    monkeypatch.setattr(minhash_dedup, "JOIN_SIZE", join_size)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    rows = near_copies(random.Random(5), 4, 40)
    check_minhash(spark, rows)


def brute_suffix(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone]) if len(b) else b""
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), kept)
    return out


def check_suffix(spark, rows, length=12, piece=5):
    got = suffix_dedup.remove_repeats(frame(spark, rows), carry=("id", "h"), length=length, piece=piece).collect()
    want = brute_suffix([r for r in rows if r[0] is not None], length)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got
            if r["doc_id"] is not None} == want
    return got


def test_suffix_array_and_common_prefixes():
    rng = random.Random(2)
    for _ in range(60):
        parts = [bytes(rng.choice(b"ab\x00") for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        parts.append(parts[0])
        data = np.frombuffer(b"".join(parts), np.uint8)
        end = np.repeat(np.cumsum([len(p) for p in parts]), [len(p) for p in parts])
        sa, key = suffix_dedup.suffix_array(data, end)
        tails = [bytes(data[p:end[p]]) for p in range(len(data))]
        assert list(sa) == sorted(range(len(data)), key=lambda p: (tails[p], p))
        common = suffix_dedup.common_prefixes(data, end, sa, key)
        for k in range(1, len(sa)):
            a, b = tails[sa[k - 1]], tails[sa[k]]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == n


def test_suffix_matches_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abcé\n") for _ in range(rng.choice([0, 5, 11, 12, 40, 90])))) for i in range(80)]
    passage = "".join(rng.choice("uvwxyz") for _ in range(40))
    rows += [(100 + i, f"{rng.random()} {passage} {rng.random()}") for i in range(20)]
    rows += [(200, None), (201, ""), (202, "z" * 5000), (203, "ab" * 3000), (204, rows[3][1]), (205, passage), (None, passage)]
    got = check_suffix(spark, rows)
    assert [bytes(r["kept"]) for r in got if r["doc_id"] is None] == [passage.encode()]
    again = suffix_dedup.remove_repeats(frame(spark, [(1, passage), (1, passage)]), length=12, piece=5).collect()
    assert [r["n_removed"] for r in again] == [0, 0]
    assert suffix_dedup.remove_repeats(frame(spark, rows).limit(0)).count() == 0


def test_suffix_hot_anchors_are_merged_across_shards(spark, monkeypatch):
    """A passage in all documents is dealt over many parts; the parts are merged by binary search."""
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "PARTS", 5)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 500)
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh") for _ in range(60))
    rows = [(i, "".join(rng.choice("ijklmnop") for _ in range(20)) + passage + "".join(rng.choice("qrstuv") for _ in range(20)))
            for i in range(60)]
    check_suffix(spark, rows)


def test_suffix_split_shard_without_hot_anchor(spark, monkeypatch):
    """Contexts of one anchor that outgrow a suffix array go to the merge, hot or not, in buckets of bounded size."""
    seen = []
    search = suffix_dedup._shard_search
    monkeypatch.setattr(suffix_dedup, "_shard_search", lambda length, buckets: seen.append(buckets) or search(length, buckets))
    merge = suffix_dedup._merge_bucket
    made = spark.sparkContext.accumulator(0)

    def counted(pdf):
        made.add(1)
        return merge(pdf)
    monkeypatch.setattr(suffix_dedup, "_merge_bucket", counted)
    rng = random.Random(12)
    noise = np.array([rng.randrange(97, 123) for _ in range(400_000)], np.uint8)
    at = np.arange(len(noise) - suffix_dedup.PIECE)
    k = int(np.argmin(suffix_dedup.mix64(suffix_dedup._prefix_hash(noise)(at, at + suffix_dedup.PIECE))))
    anchor = noise[k:k + suffix_dedup.PIECE].tobytes().decode()  # with so low a hash it anchors nearly all windows around it
    text = "".join("".join(rng.choices("0123456789", k=75)) + anchor for _ in range(8000))
    cut = [text[a:a + 150] for a in (10 * 100 + 20, 4000 * 100 + 20, 7990 * 100 + 20)]
    ids = [r[0] for r in spark.range(1, 60).where(f"pmod(xxhash64(id), {suffix_dedup.SAMPLE}) <> 0").limit(4).collect()]
    rows = [(ids[0], text), *((i, f"<{n}>{c}<{n}>") for n, (i, c) in enumerate(zip(ids[1:], cut)))]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(frame(spark, rows)).collect()}
    assert got[ids[0]]["n_removed"] == 0
    assert [(got[i]["n_removed"], bytes(got[i]["kept"])) for i in ids[1:]] == [(150, f"<{n}><{n}>".encode()) for n in range(3)]
    assert len(seen) == 1 and seen[0] >= 4 and made.value == seen[0]


def test_suffix_as_text_keeps_whole_characters(spark):
    rows = [(1, "x" + "é" * 60), (2, "y" + "é" * 60), (3, None)]
    got = {r["doc_id"]: r["kept"] for r in suffix_dedup.remove_repeats(
        frame(spark, rows), length=12, piece=5, as_text=True).collect()}
    assert got[3] is None and got[2].startswith("y") and "�" not in got[2]


VECTORS = "vec_id long, embedding array<float>, label int, id long, unit string, key long"


def brute_vectors(rows, least):
    use = {i: (np.array(v, float), lab) for i, v, lab in rows
           if v and lab is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    links = set()
    for a, (x, la) in use.items():
        for b, (y, lb) in use.items():
            if a < b and la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                links.add((a, b))
    return links


def test_lattice_decoding_is_nearest():
    rng = np.random.default_rng(0)
    x = rng.uniform(-2, 2, (300, 8))
    own, roots = embedding_dedup.decode(x), embedding_dedup.lattice_roots()
    assert roots.shape == (240, 8) and np.allclose((roots ** 2).sum(axis=1), 2)
    far = ((x - own) ** 2).sum(axis=1)
    for r in roots:
        assert (((x - own - r) ** 2).sum(axis=1) >= far - 1e-9).all()


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CHUNK", 16)
    rng = np.random.default_rng(3)
    rows, i = [], 0
    for g in range(12):
        base = rng.standard_normal(64)
        for _ in range(25 if g == 0 else 4):
            v = base + rng.standard_normal(64) * 0.1
            rows.append((i, [float(np.float32(x)) for x in v], g % 3))
            i += 1
    rows += [(i + 1, rows[0][1], 0), (i + 2, rows[0][1], 1), (i + 3, rows[0][1], None), (i + 4, None, 0), (i + 5, [0.0] * 64, 0),
             (i + 6, [float("nan")] + [1.0] * 63, 0), (i + 7, [None] + [1.0] * 63, 0), (i + 8, [], 0), (i + 9, [1.0, 2.0], 0),
             (i + 10, [2.0, 4.0], 0)]
    table = spark.createDataFrame([(a, v, lab, 1, "u", 2) for a, v, lab in rows], VECTORS)
    got = {r["id"]: r for r in embedding_dedup.near_duplicate_vectors(table).collect()}
    links = brute_vectors(rows, 0.98)
    ids = [r[0] for r in rows]
    comp = components(ids, links)
    found = sum(r["n_links"] for r in got.values())
    assert found >= 0.99 * 2 * len(links)
    assert all(got[k]["n_links"] <= sum(k in p for p in links) for k in ids)
    if found == 2 * len(links):
        assert {k: got[k]["component"] for k in ids} == comp
    assert [got[i + k]["n_links"] for k in (3, 4, 5, 6, 7, 8)] == [0] * 6
    assert got[i + 10]["component"] == i + 9
    assert embedding_dedup.near_duplicate_vectors(table.limit(0)).count() == 0


def test_suffix_an_id_with_several_texts_loses_nothing(spark):
    rng = random.Random(21)
    a, b, c = ("".join(rng.choice("abcdefgh") for _ in range(400)) for _ in range(3))
    rows = [(1, a), (1, b), (2, a), (3, b), (1, "short"), (1, a), (4, b[:200] + c), (4, c[50:300]), (4, None)]
    got = suffix_dedup.remove_repeats(frame(spark, rows), carry=("text",), as_text=True).collect()
    kept = sorted(((r["doc_id"], r["text"], r["kept"]) for r in got if r["doc_id"] != 4), key=str)
    assert kept == sorted([(1, a, a), (1, a, a), (1, b, b), (1, "short", "short"), (2, a, ""), (3, b, "")], key=str)
    four = {r["text"]: r["kept"] for r in got if r["doc_id"] == 4}
    assert four[None] is None
    assert {four[b[:200] + c], four[c[50:300]]} in ({c, ""}, {c[:50] + c[300:], c[50:300]})


def test_minhash_a_hub_is_confirmed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "VERIFY", 3)
    rng = random.Random(31)
    check_minhash(spark, near_copies(rng, 3, 14))


@pytest.fixture
def no_broadcast(spark):
    """Tables as if they were too large to be broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, usual)


def test_minhash_only_texts_of_pairs_are_shuffled(spark, no_broadcast):
    rng = random.Random(41)
    text = {i: " ".join(f"w{rng.randrange(4000)}" for _ in range(20)) for i in range(3000)}
    text[7], text[2001] = text[5], text[5] + " more"
    docs = spark.createDataFrame(list(text.items()), "id long, text string")
    pairs = spark.createDataFrame([(5, 7), (5, 2001), (5, 9)], "a long, b long")
    found = minhash_dedup._confirmed(pairs, docs, 4, 80)
    assert sorted(map(tuple, found.collect())) == [(5, 7), (5, 2001)]
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        found.explain("formatted")
    shuffled = [float(n) for n in re.findall(r"ShuffleQueryStage.*rowCount=([\d.E+]+)", plan.getvalue())]
    assert shuffled and max(shuffled) < 500


@pytest.mark.parametrize("join_size", [48, 2])
def test_minhash_matches_brute_force_without_broadcasts(spark, monkeypatch, no_broadcast, join_size):
    monkeypatch.setattr(minhash_dedup, "JOIN_SIZE", join_size)
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    rows = near_copies(random.Random(6), 3, 30)
    check_minhash(spark, rows + [(90, rows[3][1]), (None, rows[1][1]), (1000, None), (1001, " ")])


@pytest.mark.parametrize("most", [1 << 28, 1 << 15])
def test_a_sieve_loses_nothing_wanted(spark, monkeypatch, most):
    monkeypatch.setattr(common, "SIEVE_MOST", most)
    ids = [(k * 7919 - 10 ** 6,) for k in range(6000)] + [(-2 ** 63,), (2 ** 63 - 1,), (0,)]
    wanted = ids[::3] + [(0,), (0,), (None,)]
    rows = spark.createDataFrame([(i, str(i)) for (i,) in ids + [(None,), (0,)]], "id long, text string")
    left = common.sieve(spark.createDataFrame(wanted, "q long"), "test")(rows, "id")
    assert left.columns == ["id", "text"]
    got = [r["id"] for r in left.collect()]
    assert {i for (i,) in wanted} <= set(got) and got.count(0) == 2
    assert len(got) < len(wanted) + 0.1 * len(ids)
    none = common.sieve(spark.createDataFrame([], "q long"), "test")(rows, "id")
    assert none.count() == 0


def test_vectors_of_extreme_size(spark):
    rows = [(k, [x * scale for x in (1.0, 2.0, -3.0, 0.5)], 1) for k, scale in enumerate([1e200, 1e200, 1e-200, 1e-200, 1.0, 5e-324])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["id"]: (r["n_links"], r["component"]) for r in embedding_dedup.near_duplicate_vectors(frame).collect()}
    assert [got[k] for k in range(6)] == [(5, 0)] * 6
