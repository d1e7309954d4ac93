import random

from lamella.llm import pieces, queries


def words_of(r, n):
    return " ".join(r.choice(["the", "बैंक", "ledger", "é" * 3, "😀"]) + r.choice([".", ",", "", "\n", ""]) for _ in range(n))


def spied(monkeypatch, name):
    made, own = [], getattr(pieces, name)

    def spy(*args, **more):
        made.append((args, own(*args, **more)))
        return made[-1][1]

    monkeypatch.setattr(pieces, name, spy)
    return made


def test_records_are_found_by_the_pieces_they_come_out_as(spark, tmp_path, monkeypatch):
    r = random.Random(5)
    texts = {"at": "x" * 8000, "over": "x" * 8001, "astral": "😀" * 8001, "astral at": "😀" * 8000, "long": words_of(r, 60_000), "a\0b": "é " * 5000, "": "é " * 4001, "empty": "", "none": None, None: words_of(r, 3000)}
    rows = [*texts.items(), ("long", texts["long"]), ("at", "y" * 9000), (None, "short")]
    spark.createDataFrame(rows, "doc_id string, text string").write.parquet(f"{tmp_path}/cleaned_docs.parquet")
    ranges, sums = (spied(monkeypatch, x) for x in ("ranges", "prefix_sums"))
    got = [x.doc_id for x in queries.p2_found(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted({k for k, t in rows if t and len(t) > 8000}, key=str)
    assert ranges and all(args[2] > 0 for args, _ in ranges) and len(sums) == 1
    # the boundary tables of the longest, which has several ranges, are stitched where the ranges begin
    raw, stitched = texts["long"].encode(), [x for x in sums[0][1].collect() if x.key.startswith("long\0")]
    starts = [len(raw[: i * 65_536].decode("utf-8", "ignore")) for i in range(len(stitched))]
    assert len(starts) > 4 and all(0 <= x.before - starts[x.part] <= 1 for x in stitched)


def test_texts_are_cut_range_by_range(spark, monkeypatch):
    r = random.Random(6)
    texts = {1: words_of(r, 9000), 2: "x" * 30_000, 3: "मि" * 4000, 4: "short", None: "y" * 3000}
    limit, overlap, size = 1000, 60, 2000
    made = spied(monkeypatch, "ranges")
    df = spark.createDataFrame([*texts.items(), (1, texts[1])], "doc_id bigint, text string")
    got = {}
    for p in pieces.split(df, "doc_id", "text", limit, overlap, size, 256).collect():
        got.setdefault(p.doc_id, []).append(p)
    assert set(got) == {1, 2, 3, 4} and len(made) == 2  # for boundary tables, then for the pieces
    for _, parts in made:
        assert parts.selectExpr("max(octet_length(data)) n").first().n <= size + 4 * limit + 4 * (overlap + pieces.SLACK) + 4 < len(texts[2])
    for k, own in got.items():
        own.sort(key=lambda p: p.piece_no)
        assert [p.piece_no for p in own] == list(range(len(own))) and own[0].start == 0 and own[-1].start + own[-1].n_chars == len(texts[k])
        assert all(p.text == texts[k][p.start : p.start + p.n_chars] and len(p.text) <= limit for p in own)
        assert all(overlap <= a.start + a.n_chars - b.start < overlap + pieces.SLACK for a, b in zip(own, own[1:]))


def test_overlap_that_begins_a_line_takes_nothing_of_the_line_before(spark, tmp_path):
    path, text = tmp_path / "lines", "abcde\n" * 1000
    path.write_text(text)
    found = pieces.split_files(spark, [str(path)], 1000, 60, 700, 256).collect()
    assert len(found) > 6 and all(p.text == text[p.start : p.start + p.n_chars] for p in found)
