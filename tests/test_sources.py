import json
import os

import pytest

from lamella import cli
from lamella.operators import clean, dedup, quality, redact, tokens
from lamella.sources import files
from lamella.streaming.curation import curated_stream, write_stream


def test_pdfs_by_a_given_parser(spark, tmp_path):
    for name, data in (("a.pdf", b"one|two"), ("B.PDF", b"|"), ("bad.pdf", b"!"), ("note.txt", b"x")):
        (tmp_path / name).write_bytes(data)

    def parse(data):
        if data == b"!":
            raise ValueError("broken")
        return data.decode().split("|")

    got = {r.doc_id: r for r in files.extracted(files.pdfs(spark, str(tmp_path)), parse).collect()}
    assert got["a"].text == "one\ntwo" and got["a"].error is None
    assert got["B"].error == "empty extraction" and got["bad"].error == "ValueError: broken" and "note" not in got
    seen = {r.doc_id: r for r in files.extracted(files.pdfs(spark, str(tmp_path)), parse, lambda data, page: f"page {page}").collect()}
    assert seen["B"].ocr_pages == 2 and seen["a"].ocr_pages == 0
    assert files.extracted(files.pdfs(spark, str(tmp_path)), None).where("error is null").count() == 0
    m = files.manifest(files.pdfs(spark, str(tmp_path)), [], {"ocr": False}, "r1")
    assert [x["name"] for x in m["inputs"]] == ["B.PDF", "a.pdf", "bad.pdf"] and m["inputs"][1]["sha256"] == files.file_hash(str(tmp_path / "a.pdf"))


def test_documents_and_strict_lines(spark, tmp_path):
    (tmp_path / "_stage.json").write_text('{"doc_id": "no", "text": "x"}')
    (tmp_path / "d.json").write_text('{"doc_id": "d",\n "text": "x", "more": 1}')
    (tmp_path / "e.json").write_text('{"doc_id": "e"}')
    assert [r.doc_id for r in files.documents(spark, str(tmp_path)).collect()] == ["d"]
    good = tmp_path / "c.jsonl"
    good.write_text('{"text": "a b", "metadata": {"source_file": "f"}}\n\n{"text": "c", "metadata": {"source_file": "f"}}\n')
    stats = tokens.token_stats(files.curated_strict(spark, str(good))).collect()
    assert [(r.source_file, r.chunks, r.tokens) for r in stats] == [("f", 2, 3)]
    for bad in ("{", "[]", '{"text": "a"}', '{"text": "a", "metadata": {}}'):
        good.write_text('{"text": "a b", "metadata": {"source_file": "f"}}\n\n' + bad + "\n")
        with pytest.raises(ValueError, match="line 3"):
            files.curated_strict(spark, str(good))


def test_chunk_file(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"chunk_id": "1", "text": "a"}\n{"text": "b", "metadata": {"chunk_id": "2"}}\n{"text": "c"}\n')
    got = sorted(r.chunk_id for r in files.chunk_file(spark, str(p)).collect())
    assert got[:2] == ["1", "2"] and got[2].startswith("row-")
    for bad in ("", '{"chunk_id": "1"}\n', '{"chunk_id": "1", "text": "a"}\n{"chunk_id": "1", "text": "b"}\n'):
        p.write_text(bad)
        with pytest.raises(ValueError):
            files.chunk_file(spark, str(p))


def test_curated_lines(spark, tmp_path):
    chunks = spark.createDataFrame([("d__0", "d", "f", "é text", None, True)], "chunk_id string, doc_id string, source_file string, text string, page_start int, pii_redacted boolean")
    files.write_curated(files.curated(chunks), str(tmp_path / "out"), single=True)
    line = next(p for p in (tmp_path / "out").iterdir() if p.name.endswith(".json")).read_text()
    record = json.loads(line)
    assert record["text"] == "é text" and record["metadata"]["page_start"] is None and len(record["metadata"]) == 10 and "é" in line


def test_atomic_audit_paths_publish(spark, tmp_path):
    p = tmp_path / "x.txt"
    p.write_text("old")
    files.write_atomically(str(p), "new")
    assert p.read_text() == "new" and len(os.listdir(tmp_path)) == 1
    with pytest.raises(TypeError):
        files.write_atomically(str(p), None)
    assert p.read_text() == "new" and len(os.listdir(tmp_path)) == 1
    files.audit(str(tmp_path / "audit"), "started", "r", docs_in=1)
    files.audit(str(tmp_path / "audit"), "finished", "r")
    assert [json.loads(x)["event"] for x in (tmp_path / "audit").read_text().splitlines()] == ["started", "finished"]
    assert files.without_paths({"a": ["/home/x/in.pdf", "rel/a"], "b": "C:\\x\\y.pdf"}) == {"a": ["in.pdf", "rel/a"], "b": "y.pdf"}
    leaks = spark.createDataFrame([("d", "EMAIL")], "doc_id string, entity_type string")
    out = tmp_path / "pub"
    out.mkdir()
    with pytest.raises(ValueError, match="EMAIL"):
        files.publish({"a.json": "1"}, str(out), leaks)
    assert os.listdir(out) == []
    files.publish({"a.json": "1", "b.json": "2"}, str(out), leaks.limit(0))
    assert sorted(os.listdir(out)) == ["a.json", "b.json"]


def test_cli(spark, tmp_path, capsys):
    text = "The bank keeps a record of every customer and of every transaction that it makes in its books for years. " * 3
    spark.createDataFrame([(1, text, "en", "s.pdf")], "doc_id long, text string, lang string, source_file string").write.parquet(str(tmp_path / "d.parquet"))
    assert cli.main(["run", "--input", str(tmp_path / "d.parquet"), "--output", str(tmp_path / "o")]) == 0
    assert "dedup" in capsys.readouterr().out
    (tmp_path / "c.jsonl").write_text("")
    assert cli.main(["filters", "--input", str(tmp_path / "c.jsonl"), "--output", str(tmp_path / "f")]) == 1
    with pytest.raises(SystemExit) as e:
        cli.main(["nothing"])
    assert e.value.code == 2


def test_stream_equals_batch_for_stateless_stages(spark, tmp_path):
    r = "Every branch reviews the accounts of its customers once a year and writes down what it found there for the auditor. "
    rows = [(str(i), f"{i}.pdf", (r + f"unit number {i}, unit{i}@site.org ") * 3, "en", f"2025-01-0{i + 1} 00:00:00") for i in range(4)] + [("9", "9.pdf", (r + "unit number 0, unit0@site.org ") * 3, "en", "2025-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "doc_id string, source_file string, text string, lang string, at string").selectExpr("doc_id", "source_file", "text", "lang", "cast(at as timestamp) arrived")
    df.write.parquet(str(tmp_path / "in"))
    stream = curated_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "arrived")
    write_stream(stream.select("chunk_id", "doc_id", "text"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema("chunk_id string, doc_id string, text string").parquet(str(tmp_path / "out"))
    good = dedup.exact(clean.chunked(clean.cleaned(df.drop("arrived")).where("reason is null"))).where("kept")
    batch = redact.redacted(quality.tagged(good.where(quality.quality_reason("text").isNull()))).select("chunk_id", "doc_id", "text")
    streamed, whole = ({r.chunk_id: r.text for r in x.collect()} for x in (got, batch))
    assert sorted(streamed.values()) == sorted(whole.values()) and len(streamed) == 4 and all("[REDACTED_EMAIL]" in t for t in streamed.values())
    # of the two copies either may be the first to come
    assert {k: v for k, v in streamed.items() if k[0] not in "09"} == {k: v for k, v in whole.items() if k[0] not in "09"}
