import base64

import pytest
from pyspark.sql import functions as F

from lamella import control
from lamella.functions import show
from lamella.functions.joins import prefix_sums
from lamella.operators import evaluate, quality, redact
from lamella.plans import pipeline
from lamella.sources import files


def test_one_run_at_a_time():
    with control.exclusive():
        with pytest.raises(control.Busy):
            with control.exclusive():
                pass
    with control.exclusive():
        pass


def test_device(monkeypatch):
    assert control.device() == "cpu" and control.device("cuda", True) == "cuda" and control.device("odd", True) == "cpu"
    monkeypatch.setenv("LAMELLA_DEVICE", "cpu")
    assert control.device(None, True) == "cpu"
    with pytest.raises(RuntimeError):
        control.require_device("cuda", False)


def test_uploads():
    pdf = base64.b64encode(b"%PDF-1.7 x").decode()
    assert control.upload([{"name": "C:\\a\\One.PDF", "data": pdf}]) == {"One.PDF": b"%PDF-1.7 x"}
    bad = [[], [{"name": f"{i}.pdf", "data": pdf} for i in range(11)], [{"name": "a.txt", "data": pdf}], [{"name": "a.pdf", "data": "?"}], [{"name": "a.pdf", "data": base64.b64encode(b"x").decode()}], [{"name": "a.pdf", "data": pdf}, {"name": "A.pdf", "data": pdf}], [{"name": "..", "data": pdf}]]
    for files_ in bad:
        with pytest.raises(control.Refused):
            control.upload(files_)
    assert control.views({"stages": [1], "files": [], "tokens": 3, "before": 1}) == ["stages", "tokens"]


def test_numbers_as_people_read_them(spark):
    assert (show.thousands(1234567), show.thousands(None), show.ratio(1, 3), show.ratio(1, 0), show.clock(258), show.clock(None)) == ("1,234,567", "–", "33%", "n/a", "4:18", "–")
    row = spark.createDataFrame([(12345, 0), (1, 4)], "a int, b int").select(show.thousands_column(F.col("a")), show.percent_column(F.lit(1), F.col("b"))).collect()
    assert [tuple(r) for r in row] == [("12,345", "n/a"), ("1", "25%")]


def test_prefix_sums_on_two_levels(spark):
    rows = [("a" if i % 3 else "b", i, i * i % 7) for i in range(50)] + [("c", 0, 5)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    for block in (4, 4096):
        got = {(r.k, r.i): r.before for r in prefix_sums(df, ["k"], "i", "v", block).collect()}
        assert got == {(k, i): sum(w for q, j, w in rows if q == k and j < i) for k, i, _ in rows}


def test_extraction_pads_pages_and_reports(spark, tmp_path):
    for name, content in (("a.pdf", b"one|"), ("b.PDF", b"|"), ("c.pdf", b"!"), ("d.txt", b"x")):
        (tmp_path / name).write_bytes(content)

    def parse(data):
        if data == b"!":
            raise ValueError("broken\nfile")
        return data.decode().split("|")[:-1]

    found = files.extracted(files.pdfs(spark, str(tmp_path)), parse, lambda data, page: "seen" if data == b"one|" else "", lambda data: 3)
    docs, failures = files.split_extracted(found)
    got = {r.doc_id: (r.pages, r.ocr_pages) for r in docs.collect()}
    assert got == {"a": (["one", "seen", "seen"], 2)}
    assert {r.source_file: r.error for r in failures.collect()} == {"b.PDF": "empty extraction", "c.pdf": "ValueError: broken"}
    with pytest.raises(files.NothingExtracted):
        files.split_extracted(found.where("doc_id = 'c'"))
    assert files.ocr_reason(None) and files.ocr_reason(lambda d, p: "") is None


def test_places_of_lines_without_ids(spark, tmp_path):
    path = tmp_path / "chunks.jsonl"
    path.write_text('{"text": "same"}\n\n{"chunk_id": "x", "text": "t"}\n{"text": "same"}\n{"text": "u", "metadata": {"chunk_id": "m"}}\n')
    assert {r.chunk_id for r in files.chunk_file(spark, str(path)).collect()} == {"row-0", "x", "row-2", "m"}
    assert files.count_lines(str(path)) == 4


def test_publishing_puts_back_what_was_there(spark, tmp_path, monkeypatch):
    none = spark.createDataFrame([], "doc_id string, entity_type string")
    (tmp_path / "a.json").write_text("old")
    real = files.os.replace
    calls = []

    def fails(src, dst):
        calls.append(dst)
        if len(calls) == 2:
            raise OSError("no space")
        real(src, dst)

    monkeypatch.setattr(files.os, "replace", fails)
    with pytest.raises(OSError):
        files.publish({"a.json": "new", "b.json": "new"}, str(tmp_path), none)
    assert (tmp_path / "a.json").read_text() == "old" and sorted(x.name for x in tmp_path.iterdir()) == ["a.json"]


def test_an_empty_stage_stops_the_run(spark):
    docs = spark.createDataFrame([("1", "f", "short", "en")], "doc_id string, source_file string, text string, lang string")
    with pytest.raises(pipeline.EmptyStage, match="clean_langid"):
        pipeline.curate(docs, stop=True)


def test_zero_shot_engine():
    text = "word, " * 200 + "Mr. Asha Rao called asha@x.org"
    seen = []

    def engine(part, labels, least):
        seen.append(len(redact._TOKEN.findall(part)))
        out = [(part.find(w), part.find(w) + len(w), kind, score) for w, kind, score in (("Asha Rao", "person", 0.9), ("asha@x.org", "email address", 0.8), ("called", "person", 0.95), ("word", "odd", 0.9), ("Rao", "phone number", 0.2)) if w in part]
        return out

    got = redact.redact(text, engine=engine)
    assert got["text"].endswith("Mr. [REDACTED_PERSON_NAME] [REDACTED_EMAIL]") is False
    assert got["text"].endswith("Mr. [REDACTED_PERSON_NAME] called [REDACTED_EMAIL]") and got["entities"] == {"PERSON_NAME": 1, "EMAIL": 1}
    assert len(seen) > 1 and max(seen) <= 300
    assert [s[3] for s in redact.zero_shot_spans(text, engine, types={"EMAIL"})] == ["EMAIL"]


def test_contexts_of_examples_are_redacted(spark):
    own = redact.redacted(spark.createDataFrame([("c", "a@b.org and ABCDE1234F")], "chunk_id string, text string"))
    got = redact.publishable_examples(redact.first_examples(own, "chunk_id")).where("entity_type = 'PAN'").first()
    assert got.before == "AB********" and got.context_before == "[REDACTED_EMAIL] and "


def test_signal_modes_and_hard_filter(spark):
    chunks = spark.createDataFrame([("1", "a")], "chunk_id string, text string")

    def fails(texts):
        raise OSError("no weights")

    own, reason = quality.signal(chunks, "model", None, fails)
    assert own.first().quality_classifier_label is None and reason == "OSError: no weights"
    with pytest.raises(quality.ModelFailed):
        quality.signal(chunks, "model", None, fails, strict=True)
    low, _ = quality.signal(chunks, "model", None, lambda t: ["Low"] * len(t))
    assert low.select(quality.classifier_reason().alias("r")).first().r == "low_quality_classifier"


def test_overlapping_keywords_are_taken_longest_first(spark):
    own = spark.createDataFrame([("A high risk category, high risk", ), ("suspicious transaction report",), ("x-kyc re-kyc kyc_1",)], "text string")
    got = [r.regulatory_keywords_found for r in quality.tagged(own).collect()]
    assert got == [["high risk", "risk category"], ["suspicious transaction report"], ["kyc", "re-kyc"]]


def test_report_of_the_labelled_set(spark, tmp_path):
    gold = spark.createDataFrame([("1", "positive", "a@b.org", [("EMAIL", "a@b.org")]), ("2", "public", "x@y.org", []), ("3", "negative", "t", [("ODD", "t")])], "id string, kind string, text string, pii array<struct<type:string,value:string>>")
    found = evaluate.summary(evaluate.scores(gold), evaluate.public_hits(gold), gold)
    assert found["recall"] == 0.5 and found["precision"] == 1.0 and found["public_items_hit"] == 1
    text = evaluate.report(found)
    at = tmp_path / "r.md"
    assert evaluate.stale(text, str(at))
    at.write_text(text)
    assert not evaluate.stale(text, str(at)) and "| EMAIL | 1 | 1 | 0 | 0 |" in text
    assert {(r.id, r.problem) for r in evaluate.invalid(gold).collect()} == {("3", "unknown type")}


def test_language_by_trigrams(spark):
    from lamella.operators import langid

    en, fr = "the bank keeps a record of the account", "la banque garde une copie du dossier"
    known = spark.createDataFrame([(en, "en"), (fr, "fr"), (None, "en"), (en, None)], "text string, lang string")
    texts = spark.createDataFrame([(1, "The record of the bank."), (2, "Une copie de la banque"), (3, None), (4, "12"), (5, "漢字漢字")], "k int, text string")
    got = {r.k: r.lang for r in langid.detected(texts, "k", "text", langid.profiles(known)).collect()}
    assert got == {1: "en", 2: "fr", 3: "unknown", 4: "unknown", 5: "unknown"}
