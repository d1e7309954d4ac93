import random

from lamella.llm import pieces


def words_of(r, n):
    return " ".join(r.choice(["the", "बैंक", "ledger", "é" * 3, "😀"]) + r.choice([".", ",", "", "", ""]) for _ in range(n))


def test_pieces_of_files_are_those_of_texts(spark, tmp_path):
    r = random.Random(9)
    texts = {"long": words_of(r, 3000), "lines": "\n\n".join(words_of(r, 60) for _ in range(20)), "one": "x" * 5000, "short": "short", "empty": ""}
    paths = {}
    for name, text in texts.items():
        paths[str(tmp_path / name)] = text
        (tmp_path / name).write_text(text, encoding="utf-8")
    limit, overlap, size, halo = 1000, 60, 700, 256
    got = {}
    for p in pieces.split_files(spark, list(paths), limit, overlap, size, halo).collect():
        got.setdefault(p.file, []).append(tuple(p)[1:])
    df = spark.createDataFrame(list(paths.items()), "doc_id string, text string")
    want = {}
    for p in pieces.split(df, "doc_id", "text", limit, overlap, size, halo).collect():
        want.setdefault(p.doc_id, []).append(tuple(p)[1:])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for k, own in got.items():
        assert all(t == paths[k][start : start + n] and n <= limit for _, start, n, t in own)


def test_a_file_is_never_held_whole(spark, tmp_path, monkeypatch):
    """40 MB are cut while no read is over a few ranges; a worker that read the file whole would be seen here."""
    path = tmp_path / "giant.txt"
    line = "one line of a very long file that nobody ever reads as a whole.\n"
    with open(path, "w") as f:
        for _ in range(40):
            f.write(line * (1_000_000 // len(line)))
    found = pieces.split_files(spark, [str(path)], limit=100_000, overlap=200, range_bytes=1 << 20)
    rows = found.select("piece_no", "start", "n_chars").orderBy("piece_no").collect()
    size = path.stat().st_size
    assert rows[0].start == 0 and rows[-1].start + rows[-1].n_chars == size and max(r.n_chars for r in rows) <= 100_000
    assert all(200 <= a.start + a.n_chars - b.start < 200 + pieces.SLACK for a, b in zip(rows, rows[1:]))
    parts = pieces.file_ranges(spark, [str(path)], 1 << 20, 4096).selectExpr("octet_length(data) as n").agg({"n": "max"}).first()[0]
    assert parts <= (1 << 20) + 2 * 4096
