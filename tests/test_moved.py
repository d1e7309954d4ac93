"""What is moved between tasks is small beside what is read; results are those of a plain computation."""

import random

from pyspark.sql import functions as F
from test_operators import brute_held_out

from lamella.operators import dedup, search
from lamella.plans import queries


def moved(spark, run) -> int:
    """Bytes of shuffles that run() writes."""
    sc = spark.sparkContext._jsc.sc()

    def total() -> int:
        sc.listenerBus().waitUntilEmpty(30_000)
        stages = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before = total()
    run()
    return total() - before


def labelled(r, n, labels="xyz", size=80, words=1500):
    return [(f"f{i:03}", labels[i % len(labels)], " ".join(f"word{r.randrange(words)}" for _ in range(size))) for i in range(n)]


def test_held_out_moves_less_than_it_reads(spark):
    rows = labelled(random.Random(1), 300, "abcdefghij")
    docs = spark.createDataFrame(rows, "source_file string, label string, text string").coalesce(1)
    bytes_moved = moved(spark, lambda: search.held_out(docs, "source_file", "label").collect())
    assert bytes_moved < 2 * sum(len(t) for *_, t in rows)


def test_held_out_with_few_terms_sent(spark):
    rows = [*labelled(random.Random(2), 21, size=30, words=40), ("only", "w", "unheard words"), ("empty", "x", "")]
    docs = spark.createDataFrame(rows, "source_file string, label string, text string")
    family = {k: "pair" if k in ("f000", "f001", "f003") else k for k, *_ in rows}
    group = F.when(F.col("source_file").isin("f000", "f001", "f003"), "pair").otherwise(F.col("source_file"))
    got = search.held_out(docs, "source_file", "label", group, entries=60).collect()
    want = brute_held_out([x for x in rows if x[2]], family)
    # a document without terms counts as one
    assert len(got) == len(rows) and {r.source_file for r in got if not r.scored} == {"only"}
    full = {r.source_file: tuple(r) for r in search.held_out(docs, "source_file", "label", group).collect()}
    assert {r.source_file: tuple(r) for r in got} == full
    nonempty = docs.where("text <> ''")
    assert {r.source_file: r.predicted for r in search.held_out(nonempty, "source_file", "label", group, entries=60).collect()} == {k: v[0] for k, v in want.items()}


def test_near_copies_move_less_than_they_read(spark):
    r = random.Random(3)
    rows = []
    for i in range(300):
        text = [f"word{r.randrange(300)}" for _ in range(r.choice([1, 3, 6, 60, 150]))]
        rows.append((f"c{i:03}", " ".join(text)))
        if i % 5 == 0:
            text[len(text) // 2] = "changed"
            rows += [(f"d{i:03}", " ".join(text)), (f"e{i:03}", "  ".join(text).upper())]
    rows += [("copy", rows[0][1]), ("blank", " "), ("tabs", "\t"), ("none", None)]

    def runs(text):
        w = text.lower().split()
        return {" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, 1))}

    first = {}
    for k, t in sorted((k, t) for k, t in rows if t is not None):
        first.setdefault(t, k)
    sets = sorted((k, runs(t)) for t, k in first.items())
    want = {(a, b, round(len(x & y) / len(x | y), 6)) for n, (a, x) in enumerate(sets) for b, y in sets[n + 1 :] if len(x & y) >= 0.8 * len(x | y)}
    chunks = spark.createDataFrame(rows, "chunk_id string, text string").coalesce(1)
    got = []
    bytes_moved = moved(spark, lambda: got.extend(map(tuple, dedup.jaccard_pairs(chunks).collect())))
    assert len(got) == len(want) and set(got) == want and ("blank", "tabs", 1.0) in want
    assert bytes_moved < 2.5 * sum(len(t or "") for _, t in rows)
    assert set(map(tuple, dedup.jaccard_pairs(chunks, common=5).collect())) == want


def test_labelled_files_are_moved_once(spark, tmp_path):
    r = random.Random(4)
    text = {k: t for k, _, t in labelled(r, 200)}
    rows = [(k, f"{k}.pdf", t) for k, t in text.items()]
    # sent again, several records of one file, no name in one of two rows, no text
    rows += [rows[0], ("f001", "f001.pdf", "a " + text["f001"]), ("other", "f002.pdf", "a " + text["f002"]), ("f003", None, text["f003"]), ("f004", "f004.pdf", None), ("nameless", None, "words")]
    spark.createDataFrame(rows, "doc_id string, source_file string, text string").coalesce(1).write.parquet(f"{tmp_path}/cleaned_docs.parquet")
    labels = [(f"{k}.pdf", " ABC"[1 + i % 3] + " ", "p") for i, k in enumerate(text) if k != "f005"]
    spark.createDataFrame([*labels, ("f006.pdf", None, None), ("f007.pdf", "a", "o")], "source_file string, label string, source string").write.parquet(f"{tmp_path}/doc_labels.parquet")
    got = {x.source_file: x for x in queries._labelled(spark, str(tmp_path)).collect()}
    assert set(got) == {f"{k}.pdf" for k in text if k != "f005"}
    assert {k: x.text for k, x in got.items()} == {f"{k}.pdf": ("a " if k in ("f001", "f002") else "") + t for k, t in text.items() if k != "f005"}
    assert got["f007.pdf"].label == "a" and got["f007.pdf"].source == "o" and got["f000.pdf"].label == "a"
    bytes_moved = moved(spark, lambda: queries.doctype_held_out(spark, str(tmp_path)).collect())
    assert bytes_moved < 2.5 * sum(map(len, text.values()))
