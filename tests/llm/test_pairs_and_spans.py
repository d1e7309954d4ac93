import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.llm import flat, identity, longspans, nearcopies
from lamella.llm.leakage import leaks, sketch_size, words
from lamella.llm.longspans import SpanIndex, common_stretch, shared_share, shared_span_pairs, sliding_min_places


def text(r, n, alphabet="abcdefghijklmnopqrstuvwxyz"):
    return " ".join("".join(r.choice(alphabet) for _ in range(r.randrange(2, 8))) for _ in range(n))


def records():
    """Copies, edits, Unicode, ties, short, empty and null texts, null keys, repeated rows."""
    r = random.Random(1)
    base = [text(r, 60) for _ in range(4)] + [text(r, 60, "कखगघचछ"), text(r, 30, "😀äß")]
    rows = [("null", None), (None, base[0]), ("empty", ""), ("short", "one two three"), ("short2", "one two three"), ("long", text(r, 4000))]
    for i in range(40):
        w = r.choice(base).split()
        for _ in range(r.randrange(3)):
            w[r.randrange(len(w))] = text(r, 1)
        if r.random() < 0.3:
            w.insert(r.randrange(len(w)), "new")
        rows.append((f"k{i:02}", (" " if i % 7 == 0 else " ").join(w)))
    rows += [("copy", base[0]), ("Copy", base[0].upper()), ("k00", rows[6][1])]
    return rows


def test_pairs_equal_brute_force(spark):
    rows = records()
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "chunk_id string, text string, ka int")
    sets = {}
    for k, t in rows:
        if k and t:
            w = t.lower().split()
            sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.75}
    got = [(x.chunk_id_a, x.chunk_id_b) for x in nearcopies.near_copy_pairs(df, "chunk_id", "text", 0.75).collect()]
    assert set(got) == want and len(got) == len(set(got)) and len(want) > 5


def test_no_rows(spark):
    df = spark.createDataFrame([], "chunk_id string, text string")
    assert nearcopies.near_copy_pairs(df, "chunk_id", "text").count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string, added_at timestamp")
    assert shared_span_pairs(docs, "doc_id", "text", "added_at").count() == 0
    assert leaks(docs, "doc_id", "text", docs.withColumnRenamed("doc_id", "item_id"), "item_id", "text").count() == 0


def test_darts_agree_as_often_as_sets_are_alike():
    r = np.random.default_rng(2)
    for share in (0.5, 0.8):
        n, same = 200, int(200 * 2 * share / (1 + share))
        a = r.integers(0, 1 << 62, n, dtype=np.uint64)
        b = np.concatenate([a[:same], r.integers(0, 1 << 62, n - same, dtype=np.uint64)])
        sig = nearcopies.darts(np.concatenate([a, b]), np.ones(2 * n), np.repeat([0, 1], n), 2, 2000)
        assert abs((sig[0] == sig[1]).mean() - share) < 0.05


def test_darts_see_weights():
    e = np.arange(1, 41, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    w1, w2 = np.full(40, 2.0), np.concatenate([np.full(20, 2.0), np.full(20, 0.5)])
    sig = nearcopies.darts(np.concatenate([e, e]), np.concatenate([w1, w2]), np.repeat([0, 1], 40), 2, 2000)
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.06


def test_darts_of_an_empty_set():
    sig = nearcopies.darts(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0, np.int64), 1, 8)
    assert (sig == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


@pytest.mark.parametrize("w", [1, 3, 7])
def test_sliding_minimum(w):
    for seed in range(20):
        h = np.random.default_rng(seed).integers(0, 9, 40).astype(np.uint64)
        got = set(sliding_min_places(h, w).tolist())
        for i in range(len(h) - w + 1):
            assert any(h[j] == h[i : i + w].min() for j in got if i <= j < i + w)


def test_grams_are_hashes_of_what_they_cover():
    cps = np.frombuffer("abcXabcYabc".encode("utf-32-le"), np.uint32)
    sums = flat.prefix(cps)
    h = flat.gram(sums, np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert len(set(h.tolist())) == 1 and flat.gram(sums, np.array([0]), np.array([4]))[0] != h[0]


def span_rows():
    r = random.Random(4)
    stretch, boiler = text(r, 120)[:460], text(r, 120)[:420]
    rows = [(1, f"{text(r, 30)} {stretch} {text(r, 20)}"), (2, f"{text(r, 70)} {stretch}"), (3, f"{stretch[:399]}!{text(r, 80)}"), (4, None), (5, ""), (6, f"{text(r, 50)}{stretch[30:430]}{text(r, 50)}")]
    rows += [(10 + i, f"{text(r, 12)} {boiler} {text(r, 40)}") for i in range(12)]
    rows += [(30, rows[0][1]), (31, "".join(r.choice("अआइ😀") for _ in range(900)))]
    rows += [(32, rows[-1][1][200:700]), (33, "x" * 1000), (34, "x" * 500), (1, rows[0][1])]
    return rows


def brute(rows, least):
    texts = {k: t for k, t in rows if t}
    grams = {k: {t[i : i + least] for i in range(len(t) - least + 1)} for k, t in texts.items()}
    return {(a, b) for a, b in itertools.combinations(sorted(texts), 2) if grams[a] & grams[b]}


@pytest.mark.parametrize(("batches", "hot"), [(1, 64), (3, 3)])
def test_spans_equal_brute_force(spark, batches, hot):
    rows = span_rows()
    df = spark.createDataFrame([(k, t, f"2025-01-{1 + i:02}" if i % 5 else None, 1) for i, (k, t) in enumerate(rows)], "doc_id long, text string, at string, hash int").selectExpr("doc_id", "text", "cast(at as timestamp) added_at", "hash")
    got = [(x.doc_id_a, x.doc_id_b) for x in shared_span_pairs(df, "doc_id", "text", "added_at", batches=batches, hot=hot).collect()]
    assert set(got) == brute(rows, 400) and len(got) == len(set(got))


def test_shared_share(spark):
    rows = span_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x for x in shared_share(df, "doc_id", "text", least=400, batches=1).collect()}
    texts = {k: t for k, t in rows if t and len(t) >= 400}
    for k, t in texts.items():
        cover = set()
        for j, u in texts.items():
            if j != k:
                for i in range(len(t) - 399):
                    if t[i : i + 400] in u:
                        cover.update(range(i, i + 400))
        assert got[k].shared_chars == len(cover), k


def fingerprints_of(t):
    cps = np.frombuffer(t.encode("utf-32-le"), np.uint32)
    _, at, h = longspans.fingerprints(cps, np.array([0, len(cps)]), 20, 40)
    return list(zip(flat.signed(h).tolist(), at.tolist()))


def test_index_compacts_and_opens_again(spark, tmp_path):
    r = random.Random(5)
    own = [text(r, 60) for _ in range(5)]
    path = str(tmp_path / "index")
    index = SpanIndex.create(spark, path, width=20, least=40, fan=2, buckets=3)
    for i, t in enumerate(own):
        (run,) = index.load(spark.createDataFrame([(i, t, 0)], "text_id bigint, text string, batch int"))
        index.append(run)
    assert sorted(level for level, _ in index.runs) == [0, 2]
    # another session knows nothing but the path; compaction lost no posting, and a new batch meets old ones
    other = SpanIndex.open(spark.newSession(), path)
    other.spark.sql(f"drop table {other.name}")
    other = SpanIndex.open(spark.newSession(), path)
    assert (other.runs, other.width, other.made) == (index.runs, 20, index.made)
    runs = [n for _, n in other.runs]
    want = [(h, i, p) for i, t in enumerate(own) for h, p in fingerprints_of(t)]
    assert sorted(map(tuple, other.read(*runs).collect())) == sorted(want)
    (run,) = other.load(other.spark.createDataFrame([(9, own[2][50:200], 0)], "text_id bigint, text string, batch int"))
    with other.sorted_scans():
        met = other.matches(run)
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert {(x.text_id, x.fresh) for x in met.collect()} == {(9, True), (2, False)}
    # runs are read in their buckets: what moves are hashes that met, never a run
    assert "Bucketed: true" in plan and "SelectedBucketsCount" in plan
    assert all("FileScan" not in line for line in plan.splitlines() if "Exchange" in line)
    assert common_stretch("abcdef", "xbcdey", 2, 2, 2) == (1, 4)


def test_registered_batches_reach_compaction(spark, tmp_path):
    rows = [(k, t, f"2025-01-{1 + i:02}") for i, (k, t) in enumerate(span_rows())]
    df = spark.createDataFrame(rows, "doc_id long, text string, at string").selectExpr("doc_id", "text", "cast(at as timestamp) as added_at")
    path = str(tmp_path / "index")
    got = {(x.doc_id_a, x.doc_id_b) for x in shared_span_pairs(df, "doc_id", "text", "added_at", path=path).collect()}
    assert got == brute(span_rows(), 400)
    assert max(level for level, _ in SpanIndex.open(spark, path).runs) > 0


def test_texts_with_one_hash_are_told_apart(spark, monkeypatch):
    real = F.xxhash64

    class Weak:
        """Functions in which the plain hash of a text is always 7."""

        def __getattr__(self, name):
            return (lambda *c: real(*c) if len(c) > 1 else real(F.lit(7))) if name == "xxhash64" else getattr(F, name)

    monkeypatch.setattr(identity, "F", Weak())
    df = spark.createDataFrame([(1, "a" * 50), (2, "b" * 50), (3, "a" * 50), (4, "short")], "doc_id long, text string")
    ids = {x.key: x.text_id for x in identity.identified(df, "doc_id", "text").collect()}
    assert ids[1] == ids[3] != ids[2] and len(set(ids.values())) == 3


def test_leaks_equal_brute_force(spark):
    r = random.Random(6)
    items = [(i, text(r, 10 + i)) for i in range(12)] + [(90, None), (91, "few words")]
    docs = []
    for d in range(20):
        i, t = r.choice(items[:12])
        w = t.split()
        a = r.randrange(len(w))
        piece = w[a : a + r.randrange(8, 16)]
        docs.append((d, f"{text(r, 40)} {r.choice([' ', ' — ', chr(10)]).join(piece).upper()}! {text(r, 900 if d == 3 else 30)}"))
    docs += [(50, None), (51, ""), (0, docs[0][1])]

    def runs(t):
        w = words(t)
        return {tuple(w[j : j + 12]) for j in range(len(w) - 11)}

    want = {(d, i) for d, t in docs for i, u in items if runs(t) & runs(u)}
    own = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = leaks(own[0], "doc_id", "text", own[1], "item_id", "text").collect()
    assert {(x.doc_id, x.item_id) for x in got} == want and len(got) == len(want) > 3
    some = leaks(own[0], "doc_id", "text", own[1], "item_id", "text", containment=0.5, most_chars=200)
    both = {(d, i) for d, t in docs for i, u in items if runs(u) and len(runs(t) & runs(u)) / len(runs(u)) >= 0.5}
    assert {(x.doc_id, x.item_id) for x in some.collect()} == both


def test_sketches_of_short_items_are_whole():
    assert sketch_size(32, 1 / 32) == 32 and sketch_size(32, 1.0) == 1 and sketch_size(10, 0.5) == 6
