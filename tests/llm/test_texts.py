import random

import pyarrow as pa
import pytest

from lamella.llm import language, personal, pieces, prose, scanned
from lamella.llm.budget import budget, disagreeing
from lamella.llm.encoding import decoded, encoded, encoder, vocabulary_file

ODD = ["", None, " ", "Hello  world, it's 2025!", "a b c\n\n  d ", "नमस्ते दुनिया १२३", "x" * 3000, "😀 é \x00 \x1c", "don't  'tis\t\r\n<|endoftext|>", "Hello  world, it's 2025!"]


def test_ids_equal_the_tokenizer_and_come_back(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary_file("byte_bpe_50k").replace(".tiktoken", ".json"))
    whole.encode_special_tokens = True
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(ODD)] + [(None, "null key", "z")], "doc_id long, text string, word string")
    for head in (50_000, 3, 0):
        ids = encoded(df, "doc_id", "text", head=head)
        got = {r.doc_id: r.ids for r in ids.collect()}
        assert got == {**{i: whole.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(ODD)}, None: whole.encode("null key", add_special_tokens=False).ids}
    back = {r.doc_id: r.text for r in decoded(ids, "doc_id").collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(ODD))
    assert encoded(df.limit(0), "doc_id", "text").count() == 0
    assert encoder(vocabulary_file("byte_bpe_50k"))("") == []


def test_budget(spark):
    docs = spark.createDataFrame([("s", "en", None, "f", "one two"), ("s", "en", None, "f", "one two"), ("s", "en", "d", "f", None), (None, None, None, None, "")], "source string, lang string, domain string, source_file string, text string")
    labels = spark.createDataFrame([("f", " D "), ("f", "z"), (None, "q")], "source_file string, label string")
    got = {(r.source, r.domain): (r.docs, r.texts, r.tokens, r.distinct_tokens) for r in budget(docs, labels).collect()}
    assert got == {("s", "d"): (3, 2, 4, 2), (None, None): (1, 1, 0, 0)}


def test_wrong_statistics(spark):
    chunks = spark.createDataFrame([("r", "f", "c1", "a b"), ("r", "f", "c1", "a b"), ("r", "f", "c2", None), ("r", None, "c3", "x y")], "run_id string, source_file string, chunk_id string, text string")
    stats = spark.createDataFrame([("r", "f", 2, 2), ("r", "f", 3, 2), ("r", None, 1, 2), ("r", "g", 1, 1), ("r", "h", None, 0), ("r", "g", 0, 0)], "run_id string, source_file string, chunks long, tokens long")
    assert {(r.run_id, r.source_file) for r in disagreeing(stats, chunks).collect()} == {("r", "f"), ("r", "g"), ("r", "h")}


def prose_text(r, n):
    return " ".join(r.choice(["the", "बैंक", "ledger", "é" * 3, "word"]) + (r.choice([".", ",", "", "", ""])) for _ in range(n))


def test_pieces_are_slices_with_overlap(spark, tmp_path):
    r = random.Random(3)
    texts = {"a": prose_text(r, 900), "b": "\n\n".join(prose_text(r, 60) for _ in range(20)), "c": "x" * 5000, "d": "short", "e": "", "g": "😀" * 3000, "h": "é" * 2500, "n": None}
    rows = [*texts.items(), ("a", texts["a"]), (None, "t")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    limit, overlap = 1000, 60
    got = pieces.split(df, "doc_id", "text", limit, overlap, range_bytes=700, halo=256).collect()
    by = {}
    for p in got:
        by.setdefault(p.doc_id, []).append(p)
    assert set(by) == set(texts) - {"n"}
    for k, own in by.items():
        own.sort(key=lambda p: p.piece_no)
        t, end = texts[k], None
        for p in own:
            assert p.text == t[p.start : p.start + p.n_chars] and len(p.text) <= limit
            if end is not None:
                assert overlap <= end - p.start < overlap + pieces.SLACK
                assert end - p.start == overlap or t[p.start - 1].isspace()
            end = p.start + p.n_chars
        assert end == len(t)
    assert {p.doc_id for p in pieces.oversized(df, "doc_id", "text", limit, range_bytes=700).collect()} == {k for k, t in texts.items() if t and len(t) > limit}
    file = tmp_path / "big.txt"
    file.write_text(texts["b"])
    parts = pieces.file_ranges(spark, [str(file)], 700, 256)
    assert pieces.lengths(parts).first().n == len(texts["b"])
    table = pieces.cuts(parts, 700, 256, limit, overlap).first()
    assert all(texts["b"].encode()[: c.byte].decode() == texts["b"][: c.cp] for c in table.cuts)


def test_kinds_of_text():
    rows = {
        "prose": "The bank keeps a record of every account that it opens. It is for the officer to decide whether the form is needed, and the client is told of this.",
        "numbered": "1. The bank keeps a record of every account that it opens.\n2. It is for the officer to decide whether the form is needed.\n3. The client is told of this by the branch.",
        "list": "Documents:\n- proof of address\n- the board resolution\n- a recent photograph\n- the partnership deed\n- the utility bill\n- the trust deed",
        "table": "Year,Total,Share\n2019,1200,5%\n2020,1300,7%\n2021,90,8%\n2022,1500,12%",
        "junk": "x9$k {]~ Qz@@ 7#h! ;;&^ bb%d ((=+ zz|q `~` 8*8* [}{] Jx%x qq~q $$#a",
    }
    _, kinds = prose.stats_of(pa.array([*rows.values(), "", None, "  "]))
    assert kinds == ["prose", "prose", "list", "table", "junk", "empty", "empty", "empty"]
    stats, _ = prose.stats_of(pa.array(["Two words. Now four", ""]))
    assert stats["n_words"].tolist() == [4, 0] and stats["n_chars"].tolist() == [19, 0]


def test_not_prose_edges(spark):
    df = spark.createDataFrame([("a", None), (None, "1,2,3"), ("b", "1,2\n3,4\n5,6\n7,8"), ("b", "1,2\n3,4\n5,6\n7,8"), ("c", "x" * 10_000)], "chunk_id string, text string")
    assert {(r.chunk_id, r.kind) for r in prose.not_prose(df, "chunk_id", "text").collect()} == {("b", "table"), ("c", "junk")}


def test_language_scores_sum_all_cuts():
    m = language.Models([{"a": 0.5, "b": 0.3, "ab": 0.2}, {"a": 0.1, "b": 0.1}])
    got = m.score("ab")
    import math

    scale = 2 * math.log(language._SCALE)
    assert abs(got[0] - scale - math.log(0.5 * 0.3 + 0.2)) < 1e-9
    assert abs(got[1] - scale - math.log(0.1 * 0.1 + 1e-8)) < 1e-9
    assert len(m.score("zzz" * 40)) == 2
    table = language.fit({"ab": 5, "a": 1}, frozenset({"ab"}))
    assert abs(sum(table.values()) - 1) < 1e-6 and table["ab"] > table["b"]


def test_languages(spark):
    en, fr = "the bank keeps a record of the account and of the client", "la banque doit garder une copie du dossier et de la lettre"
    train = spark.createDataFrame([(en, "English"), (en + " again", "en"), (fr, "fr"), (fr + " encore", "FR"), (None, "en"), ("x", None)], "text string, lang string")
    models = language.train(spark, train, "text", "lang")
    rows = [("a", f"{en}\n\n{en}\n \n{fr}", "en-IN"), ("b", fr, "en"), ("c", fr, None), ("d", None, "en"), ("e", "123 456", "en"), ("b", fr, "en"), (None, en, "fr"), ("f", en, "es"), ("g", en, " ENG ")]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    got = language.mislabelled(df, "doc_id", "text", "lang", models).collect()
    assert {(r.doc_id, r.para_no, r.lang) for r in got} == {("a", 2, "fr"), ("b", -1, "fr"), ("c", -1, "fr"), ("f", -1, "en")} and len(got) == 4
    notes = ["EN", "hin", "en-IN", "German", "", " ", None, "und", "xx", "हिंदी", "pt_BR"]
    column = spark.createDataFrame([(n,) for n in notes], "l string").select(language.code_column("l").alias("c"))
    assert [r.c for r in column.collect()] == [language.code_of(n) for n in notes] == ["en", "hi", "en", "de", "", "", "", "", "xx", "hi", "pt_br"]


def scan(r):
    body = ["the officer keeps the record of every financial account", "the branch verifies the document of the client before", "approval is given by the manager of the regional office"]
    return [r.choice(body) for _ in range(15)]


def test_size_of_the_head_does_not_change_scanned_noise(spark):
    filler = " ".join(f"{w} " * 40 for w in "bank that rule form with from".split())
    known = " ".join(f"{w} " * n for w, n in [("risk", 4), ("based", 4), ("well", 5), ("informed", 5), ("informed-consent", 6), ("over", 4), ("under", 4), ("overunder", 12), ("over-under", 7), ("account", 21), ("acc", 1), ("ount", 1), ("ledger", 30), ("counterpart", 9), ("counter", 2), ("part", 1), ("longterm", 5), ("term", 4)])
    rows = [
        ("known", f"{filler}\n{known}"),
        ("hyphen", "the rule is risk-\nbased and it is well-in-\nformed or so\nof a non-counter-\npart and odd xyz-\nqrs or long-\nterm too"),
        ("split", "here over under there\nthe acc ount of a bank\nthe counter part rule acc ount l1dger\nled ger or 1edger counterp4rt ledg3r\nhere o'er counter part ount"),
    ]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    all_of = lambda head: sorted(map(tuple, scanned.noise(df, "doc_id", "text", head=head).collect()))
    want = all_of(200_000)
    assert {("split", "acc ount"), ("split", "counter part"), ("char", "1edger"), ("hyphen", "long-")} & {(r[2], r[3]) for r in want}
    assert not any(r[3] == "risk-" for r in want)
    for head in (3, 8, 12, 20):
        assert all_of(head) == want


def test_noise_of_scanned_pages(spark):
    r = random.Random(7)
    clean = "\n".join(x for _ in range(30) for x in scan(r))
    pages = []
    for p in range(1, 5):
        pages += [f"Manual on accounts {p}" if p % 2 else "Manua1 on accounts", *scan(r), f"- {p} -"]
    pages[3] = "the officer keeps the rec0rd of every finan cial account"
    pages[5] = "the branch verifies the docu-"
    pages[6] = "ment of the client before day-"
    pages[7] = "to-day approval is given by the rnanager of"
    noisy = "\n".join(pages)
    df = spark.createDataFrame([("clean", clean + "\nwith day-to-day work"), ("noisy", noisy), ("noisy", noisy), ("null", None), ("empty", ""), (None, "x")], "doc_id string, text string")
    want = {(3, "char"), (3, "split"), (5, "hyphen"), (7, "char")} | {(i, "page_number") for i, x in enumerate(pages) if x.startswith("- ")} | {(i, "header") for i, x in enumerate(pages) if x.startswith("Manua")}
    for head in (200_000, 12):
        got = scanned.noise(df, "doc_id", "text", head=head).collect()
        assert {(x.line_no, x.noise) for x in got} == want and {x.doc_id for x in got} == {"noisy"}
    text = scanned.repaired(df, "doc_id", "text").where("doc_id = 'noisy'").first().text
    assert "the record of every financial account" in text and "the document of the client before day-to-day approval is given by the manager" in text and "- 2 -" not in text and "accounts" not in text


@pytest.mark.parametrize(("form", "word", "held"), [("until", "uritil", True), ("document", "clocument", True), ("internal", "intemal", True), ("the", "file", False), ("person", "pers0n", True), ("again", "agаin", True), ("opening", "opcning", True), ("cat", "dog", False)])
def test_confused_glyphs(form, word, held):
    assert scanned.confused(form, word, 1) is held
    if held:
        assert scanned.skeleton(form) == scanned.skeleton(word)


def test_skeletons_agree(spark):
    words = ["until", "cl0seό", "rnilk", "опен", "wave", "vvave", "a-b"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(scanned.skeleton_column("w").alias("s"))
    assert [r.s for r in got.collect()] == [scanned.skeleton(w) for w in words]


def test_personal_items(spark):
    gold = [("Date of birth: 02-07-1973.", [("DATE", "02-07-1973")]), ("Born, date of birth: 1 May 1980.", [("DATE", "1 May 1980")]), ("Account number: 123456789012345", [("ACCOUNT_NUMBER", "123456789012345")]), ("The circular dated 26-02-2023 stands.", []), ("Reference no. 845849466180 was allotted.", [])]
    gold = spark.createDataFrame(gold, "text string, pii array<struct<type:string,value:string>>")
    rows = [
        ("mail", "write to some.one (at) site.org now"), ("phone", "call +91 98765 43210 at night"), ("tax", "card abcde 1234 f seen"), ("birth", "Date of birth: 3 June 1971."), ("acct", "Account number: 987654321098765"),
        ("name", "We met Shri R. K. Sharma today"), ("home", "R/o Flat 7C, Lake Towers, 6th Cross, Pune - 411001."), ("sample", "like XXXXX9999X"), ("date", "The circular dated 26-02-2021 stands."), ("toll", "call 1800-732-8065"),
        ("null", None), ("empty", ""), (None, "call +91 98765 43210"), ("mail", "write to some.one (at) site.org now"), ("long", "word " * 20_000),
    ]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "chunk_id string, text string, shape string")
    got = {(r.chunk_id, r.entity_type) for r in personal.found_types(df, "chunk_id", "text", gold).collect()}
    assert got == {("mail", "EMAIL"), ("phone", "PHONE"), ("tax", "PAN"), ("birth", "DATE"), ("acct", "ACCOUNT_NUMBER"), ("name", "PERSON_NAME"), ("home", "ADDRESS")}
    out = {r.chunk_id: r.text for r in personal.redacted(df, "chunk_id", "text", gold).collect()}
    assert out["mail"] == "write to [REDACTED_EMAIL] now" and out["null"] is None and out["date"] == rows[8][1] and out["phone"] == "call [REDACTED_PHONE] at night"
    assert personal.found_types(df.limit(0), "chunk_id", "text", gold).count() == 0
    assert personal.check_digit_holds("2363") and not personal.check_digit_holds("2364")
