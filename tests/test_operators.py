import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lamella.operators import clean, dedup, evaluate, filters, heal, pages, quality, redact, search, tokens, versions
from lamella.plans import pipeline, queries


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_clean_reasons_in_order(spark):
    docs = spark.createDataFrame([("1", "a", "short", "fr"), ("2", "b", words(1, 60), "fr"), ("3", "c", words(2, 60), "en"), ("4", "d", words(3, 60), None)], "doc_id string, source_file string, text string, lang string")
    got = {r.doc_id: r.reason for r in clean.cleaned(docs).collect()}
    assert got == {"1": "too_short", "2": "non_english", "3": None, "4": "non_english"}
    record = clean.stage_record("clean", clean.cleaned(docs), known=("too_short", "non_english", "never")).first()
    assert (record.docs_in, record.docs_out, record.removed) == (4, 1, 3)
    assert record.reason_counts == {"too_short": 1, "non_english": 2, "never": 0}


def test_empty_stage(spark):
    docs = spark.createDataFrame([], "doc_id string, source_file string, text string, lang string")
    record = clean.stage_record("clean", clean.cleaned(docs)).first()
    assert (record.docs_in, record.docs_out, record.removed, record.reason_counts) == (0, 0, 0, {})


def test_newest_copy_survives(spark):
    block = words(5, 180)
    docs = spark.createDataFrame([("old_2021", "a", f"{block} {words(6, 180)}"), ("new_2025", "b", f"{block} {words(7, 180)}")], "doc_id string, source_file string, text string")
    for order in (docs, docs.orderBy(F.desc("doc_id"))):
        got = {r.chunk_id: r.reason for r in dedup.deduplicated(clean.chunked(order)).collect()}
        assert got == {"new_2025__0": None, "new_2025__1": None, "old_2021__0": "exact_duplicate", "old_2021__1": None}


def test_near_copies_are_labelled_by_document(spark):
    base = words(8, 180).split()
    near = [*base[:-1], "changed"]
    docs = spark.createDataFrame([("x_2025", "a", " ".join(base + near)), ("y_2020", "b", " ".join([*base[:-2], "other", "end"]))], "doc_id string, source_file string, text string")
    got = {r.chunk_id: r.reason for r in dedup.deduplicated(clean.chunked(docs)).collect()}
    assert got == {"x_2025__0": None, "x_2025__1": "intra_doc_near_duplicate", "y_2020__0": "cross_doc_boilerplate"}


def test_greedy_is_the_sequential_rule(spark):
    for seed in range(6):
        r = random.Random(seed)
        rows = sorted({(i, r.randrange(12)) for i in range(24) for _ in range(3)})
        kept, seen, of = [], {}, {}
        for i in range(24):
            hits = [seen[b] for x, b in rows if x == i and b in seen]
            if hits:
                of[i] = min(hits)
            else:
                kept.append(i)
                for x, b in rows:
                    if x == i:
                        seen.setdefault(b, i)
        df = spark.createDataFrame([((0, "d", i), b) for i, b in rows], "rank struct<older:int,doc:string,idx:int>, band bigint")
        got = dedup.greedy(df).collect()
        assert sorted(g["rank"].idx for g in got if g.kept) == kept
        assert {g["rank"].idx: g["of"].idx for g in got if not g.kept} == of


def test_jaccard_pairs_equal_brute_force(spark):
    r = random.Random(3)
    base = [words(i, 40).split() for i in range(3)]
    rows = []
    for i in range(40):
        w = list(r.choice(base))
        for _ in range(r.randrange(6)):
            w[r.randrange(len(w))] = f"x{r.randrange(50)}"
        rows.append((f"c{i:02}", " ".join(w)))
    sets = {k: {" ".join(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for k, t in rows}
    texts = dict(rows)
    firsts = {t: min(k for k in texts if texts[k] == t) for t in set(texts.values())}
    keys = sorted(firsts.values())
    want = {(a, b) for a in keys for b in keys if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    got = {(x.chunk_id_a, x.chunk_id_b) for x in dedup.jaccard_pairs(spark.createDataFrame(rows, "chunk_id string, text string")).collect()}
    assert got == want and want


def test_furniture(spark):
    page = [[words(100 * p + i, 8) for i in range(30)] + [f"Policy of the bank, page {p}"] for p in range(12)]
    text = "\n".join(x for p in page for x in p)
    docs = spark.createDataFrame([("d", "f", text), ("e", "g", "\n".join(words(i, 5) for i in range(50)))], "doc_id string, source_file string, text string")
    found = heal.furniture(docs)
    assert [(r.doc_id, r.sig, r.occurrences) for r in found.collect()] == [("d", "policy of the bank, page #", 12)]
    got = {r.doc_id: r.text for r in heal.without_furniture(docs, found).collect()}
    assert got["d"] == "\n".join(x for p in page for x in p[:-1]) and got["e"] == docs.where("doc_id = 'e'").first().text


def test_purity_counts_near_copies(spark):
    base = words(31, 180).split()
    texts = [" ".join(base), " ".join(base), " ".join([*base[:-1], "changed"]), words(32, 180)]
    docs = spark.createDataFrame([(f"d{i}_20{30 - i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    got = heal.purity(docs).first()
    assert (got.chunks, got.duplicate_chunks) == (4, 2)
    change = {r.side: r.duplicate_chunks for r in pipeline.purity_change(docs, docs.limit(0)).collect()}
    assert change == {"before": 2, "after": 0}


def test_splits_are_joined(spark):
    docs = spark.createDataFrame([("a", "f", "financial risk financial market financial year"), ("b", "g", "the f inancial risk and in form")], "doc_id string, source_file string, text string")
    got = {r.doc_id: (r.text, r.repairs) for r in heal.repaired(docs).collect()}
    assert got["b"] == ("the financial risk and in form", ["f inancial -> financial"]) and got["a"][1] == []


def test_quality_rules(spark):
    rows = [("few", "too short"), ("alpha", "1234 5678 " * 20), ("symbols", "ab! " * 3 + "wordedd$$$$$ " * 20), ("loop", "again and " * 40), ("good", words(9, 60))]
    df = spark.createDataFrame(rows, "k string, text string")
    got = {r.k: r.x for r in df.select("k", quality.quality_reason("text").alias("x")).collect()}
    assert got == {"few": "too_few_words", "alpha": "low_alpha_ratio", "symbols": "high_symbol_ratio", "loop": "low_lexical_diversity", "good": None}


def test_keywords(spark):
    rows = [("AML/CFT and enhanced customer due diligence",), ("kycs and strong words",), ("KYC, kyc; PMLA",), (None,)]
    got = quality.tagged(spark.createDataFrame(rows, "text string")).collect()
    assert got[0].regulatory_keywords_found == ["aml/cft", "customer due diligence"] and got[0].regulatory_tagged
    assert got[1].regulatory_keywords_found == [] and not got[1].regulatory_tagged
    assert got[2].regulatory_keywords_found == ["kyc", "pmla"] and got[2].regulatory_density_score == 1.0


def test_signal_modes(spark):
    chunks = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "b")], "chunk_id string, text string")
    cache = spark.createDataFrame([("a",)], "t string").select(F.sha2("t", 256).alias("hash"), F.lit("High").alias("label"))
    label = lambda df: {r.chunk_id: r.quality_classifier_label for r in df.collect()}
    assert label(quality.with_signal(chunks, None)) == {"1": None, "2": None, "3": None}
    assert label(quality.with_signal(chunks, cache)) == {"1": "High", "2": None, "3": None}
    assert label(quality.with_signal(chunks, cache, lambda texts: ["Low"] * len(texts))) == {"1": "High", "2": "Low", "3": "Low"}


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("PAN ABCDE1234F here", ["PAN"]),
        ("write to someone@site.org or 9876543210", ["EMAIL", "PHONE"]),
        ("circular dated 23-10-2018", []),
        ("born 23-10-1978", ["DATE"]),
        ("born\n23-10-1978", []),
        ("born 23-10/1978", []),
        ("Mumbai-400001", ["PINCODE"]),
        ("amount 150000", []),
        ("PIN code: 100001", []),
        ("number 2363 4567 8901", []),
        ("fax 0223456789012", []),
        ("a/c 12345678901", ["ACCOUNT_NUMBER"]),
        ("0000000000", []),
        ("SWIFT Code ABCDINBB", ["SWIFT_BIC"]),
        ("ANNEXURE is no code", []),
        ("L12345AB2001ABC123456", ["CIN"]),
        ("Shri R. K. Sharma", ["PERSON_NAME"]),
        ("MR. SURESH KUMAR said", ["PERSON_NAME"]),
        ("Mr. Managing Director", []),
        ("DR. NOTE THAT", []),
    ],
)
def test_redaction_rules(text, kinds):
    got = redact.redact(text)
    assert sorted(got["entities"]) == sorted(kinds)
    assert all(f"[REDACTED_{k}]" in got["text"] for k in kinds)


def test_redacted_finds_each_shape_alone(spark):
    alone = {
        "PAN": "no PBTPK7239C",
        "AADHAAR": "no 2345 6789 0124",
        "EMAIL": "a@b.org",
        "PHONE": "no 9876543210",
        "DATE": "born 23-10-1978",
        "PINCODE": "pin 400001",
        "CIN": "no L12345AB2001ABC123456",
        "SWIFT_BIC": "SWIFT ABCDEF12",
        "ACCOUNT_NUMBER": "a/c 123456789",
        "PERSON_NAME": "Smt. A. RAO",
    }
    rows = [(k, k, v) for k, v in alone.items()]
    # the digits that the rules take in any script, in those of Devanagari and of a script that older engines don't know
    for zero in (0x966, 0x11F50):
        rows += [(f"ACCOUNT_NUMBER-{zero}", "ACCOUNT_NUMBER", "a/c " + "".join(chr(zero + int(c)) for c in "123456789"))]
        rows += [(f"PHONE-{zero}", "PHONE", "no 9" + "".join(chr(zero + int(c)) for c in "876543210")), (f"DATE-{zero}", "DATE", f"born 2{chr(zero + 3)}-10-19{chr(zero + 7)}{chr(zero + 8)}")]
    df = spark.createDataFrame(rows, "chunk_id string, kind string, text string")
    assert all(redact.redact(r[2])["entities"] for r in rows)
    got = {r.chunk_id: (r.pii_redacted, r.kind in r.entities) for r in redact.redacted(df).collect()}
    assert got == {r[0]: (True, True) for r in rows}


def test_redaction_review_and_interaction():
    assert redact.redact("number 12345678901 here")["review"]
    # the phone's own placeholder is a telephone word near the account number
    assert redact.redact("9876543210 then 12345678901")["verdicts"]["account_suppressed"] == 1
    assert redact.check_digit_holds("2363")
    assert not redact.check_digit_holds("2364")
    assert redact.redact("")["text"] == ""


def test_spans_and_windows():
    assert redact.resolve([(0, 5, 0.5, "a"), (3, 9, 0.9, "b"), (9, 12, 0.1, "c"), (3, 9, 0.9, "d")]) == [(3, 9, 0.9, "b"), (9, 12, 0.1, "c")]
    text = words(1, 700)
    parts = redact.token_windows(text)
    assert all(text[o : o + len(p)] == p for o, p in parts) and {w for _, p in parts for w in p.split()} == set(text.split())
    assert redact.token_windows("") == []


def test_report_and_examples(spark):
    rows = [(f"d__{i}", "d", "f", f"mail user{i}@site.org and ABCDE123{i % 10}F") for i in range(9)] + [("e__0", "e", None, None)]
    own = redact.redacted(spark.createDataFrame(rows, "chunk_id string, doc_id string, source_file string, text string"))
    report = redact.validation_report(own).collect()
    assert report[0].doc_id == "d" and report[0].pii_entities == 18 and report[0].entity_types == {"EMAIL": 9, "PAN": 9}
    assert report[1].entity_types == {} and report[1].chunks == 1
    got = redact.first_examples(own.drop("doc_id"), "chunk_id").where("entity_type = 'EMAIL'").orderBy("nr").collect()
    assert [r.doc_id for r in got] == [f"d__{i}" for i in range(6)]


def test_drilldown_counts_the_stages(spark, tmp_path):
    plain = [words(40 + i, 60) for i in range(4)]
    cut = [
        ("a__0", "a", "fa", f"{plain[0]} PBTPK7239C"),
        ("a__1", "a", "fa", f"{plain[1]} @ noon"),
        ("a__2", "a", "fa", "few words and me@site.org"),
        ("b__0", "b", "fb", plain[1] + " @ noon"),
        ("b__1", "b", "fb", plain[2]),
        ("c_2030__0", "c_2030", "fc", plain[2]),
    ]
    spark.createDataFrame([(d, f, "text") for d, f in (("a", "fa"), ("b", "fb"), ("c_2030", "fc"), ("d", "fd"))], "doc_id string, source_file string, text string").write.parquet(f"{tmp_path}/cleaned_docs.parquet")
    spark.createDataFrame(cut, "chunk_id string, doc_id string, source_file string, text string").write.parquet(f"{tmp_path}/chunks.parquet")
    got = {r.doc_id: (r.chunks, r.kept_chunks, r.pii_chunks) for r in queries.doc_drilldown(spark, str(tmp_path)).collect()}
    assert got == {"a": (3, 2, 1), "b": (0, 0, 0), "c_2030": (1, 1, 0), "d": (0, 0, 0)}


def test_gold(spark):
    gold = spark.createDataFrame([("1", "positive", "a@b.org x@y.org", [("EMAIL", "a@b.org"), ("EMAIL", "x@y.org")]), ("2", "negative", "born 01-01-1980", []), ("2", "odd", "text", [("PAN", "nope")])], "id string, kind string, text string, pii array<struct<type:string,value:string>>")
    got = {r.entity_type: (r.expected, r.hit, r.leaked, r.false_alarms) for r in evaluate.scores(gold).collect()}
    assert got == {"EMAIL": (2, 2, 0, 0), "DATE": (0, 0, 0, 1), "PAN": (1, 0, 0, 0)}
    assert {r.problem for r in evaluate.invalid(gold).collect()} == {"repeated id", "unknown kind", "value not in text"}


def test_pages(spark):
    body = words(4, 400).split()
    book = [" ".join(body[:150]), " ".join(body[150:300]), " ".join(body[300:])]
    texts = [" ".join(body[:100]), " ".join(body[100:250]), "XX, " + " ".join(body[310:380]).upper(), "too short", words(99, 30), None, " ".join(body[380:]) + " and so on to the end"]
    chunks = spark.createDataFrame([(f"{d}__{i}", d, i, t) for d in ("d", "e") for i, t in enumerate(texts)], "chunk_id string, doc_id string, idx int, text string")
    kept = spark.createDataFrame([("d", book), ("f", book), ("g", None)], "doc_id string, pages array<string>")
    want = [(1, 1), (1, 2), (3, 3), (None, None), (None, None), (None, None), (3, 3)]
    for block in (512, 2, 1):
        got = {r.chunk_id: (r.page_start, r.page_end) for r in pages.located(chunks, kept, block).collect()}
        assert got == {**{f"d__{i}": x for i, x in enumerate(want)}, **{f"e__{i}": (None, None) for i in range(len(texts))}}
    assert pages.located(chunks.limit(0), kept).count() == 0


def test_places_that_come_again_follow_the_cursor(spark):
    same = words(5, 20)
    book = [f"{words(6, 30)} {same} {words(7, 200)}", f"{same} {words(8, 300)}", f"{words(9, 400)} {same}"]
    texts = [words(6, 30), same, words(7, 200), same, words(8, 300), words(9, 400), same, same]
    chunks = spark.createDataFrame([(f"d__{i}", "d", i, t) for i, t in enumerate(texts)], "chunk_id string, doc_id string, idx int, text string")
    kept = spark.createDataFrame([("d", book)], "doc_id string, pages array<string>")
    results = []
    for block in (512, 3, 1):
        results.append([(r.page_start, r.page_end) for r in pages.located(chunks, kept, block).orderBy("idx").collect()])
    assert results[0] == results[1] == results[2]
    assert [a for a, _ in results[0]] == [1, 1, 1, 2, 2, 3, 3, 3]


def test_edit_kinds():
    assert versions.edit_kind("The 'bank' may.", "The bank may") == "typography"
    assert versions.edit_kind("Section one 12", "Section one 13") == "pagination"
    long = "the quick brown fox jumps over the lazy dog near page {} and also page {} of it"
    assert versions.edit_kind(long.format(3, 9), long.format(4, 10)) == "pagination"
    assert versions.edit_kind(long.format(3, 9), long.format(4, 99)) == "numeric"
    assert versions.edit_kind("Banks may do so", "Banks shall do so") == "wording"


def test_moved_and_edited_clause():
    old = "Alpha clause stays here. Beta clause is about the limit of cash. Gamma goes away now."
    new = "Alpha clause stays here. Delta is quite new text. Beta clause is about the limit of money."
    got = versions.compare(old, new)
    assert got["unchanged"] == 1 and got["counts"] == {"wording": 1, "removed": 1, "added": 1}


def test_families_and_changelog(spark):
    base = words(11, 300)
    rows = [("v_2020", f"In 2020. {base}"), ("v_2022", f"In 2022. {base} {words(12, 40)}"), ("piece", " ".join(base.split()[:40])), ("other", words(13, 300))]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    fam = versions.families(docs)
    assert {r.doc_id for r in fam.collect()} == {"v_2020", "v_2022"}
    log = versions.changelog(docs, fam).collect()
    assert [(r.from_id, r.to_id) for r in log] == [("v_2020", "v_2022")]


def test_components_of_chains(spark):
    pairs = spark.createDataFrame([(f"n{i:02}", f"n{i + 1:02}") for i in range(20)] + [("x", "y")], "a string, b string")
    got = {r.doc_id: r.family for r in versions.components(pairs).collect()}
    assert set(got.values()) == {"n00", "x"} and len(got) == 23


def test_search(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "alpha beta"), (3, "delta"), (4, None)], "doc_id long, text string")
    q = spark.createDataFrame([(9, "Alpha, BETA gamma!"), (8, "unknown words")], "item_id long, text string")
    got = search.search(q, docs, "item_id", "doc_id").orderBy("place").collect()
    assert [(r.item_id, r.doc_id) for r in got] == [(9, 1), (9, 2)] and abs(got[0].score - 1) < 1e-9 and got[0].similarity.startswith("High")


def test_doctype(spark):
    rows = [("a", "x", "cash ledger teller", "f1"), ("b", "x", "cash ledger vault", "f1"), ("c", "y", "visa passport border", "f2"), ("d", "y", "visa passport customs", "f3"), ("e", "x", "cash teller money", "f4"), ("f", "z", "crop soil rain", "f5")]
    docs = spark.createDataFrame(rows, "source_file string, label string, text string, fam string")
    cent, idf = search.centroids(docs, "source_file", "label")
    got = {r.source_file: r.predicted for r in search.classified(docs, "source_file", cent, idf, docs, "label").collect()}
    assert got == {r[0]: r[1] for r in rows}
    held = {r.source_file: (r.predicted, r.scored) for r in search.held_out(docs, "source_file", "label", F.col("fam")).collect()}
    assert held["c"] == ("y", True) and held["a"] == ("x", True) and not held["f"][1]
    acc = search.accuracy(search.held_out(docs, "source_file", "label", F.col("fam")), "label").first()
    assert acc.n_documents == 6 and acc.n_scored == 5 and acc.accuracy == 1.0


def brute_held_out(rows, group):
    """(predicted, score) of each row by a model built anew from the rows of other groups."""
    out = {}
    for key, _, text, *_ in rows:
        rest = [(r[1], Counter(r[2].split())) for r in rows if group[r[0]] != group[key]]
        df = Counter(t for _, c in rest for t in c)
        idf = lambda t: math.log((len(rest) + 1) / (df[t] + 1)) + 1
        cents = defaultdict(Counter)
        for label, c in rest:
            for t, n in c.items():
                if df[t] / len(rest) <= 0.5:
                    cents[label][t] += n / c.total()
        own = Counter(t for t in text.split() if df[t] / len(rest) <= 0.5)
        v = {t: n / own.total() * idf(t) for t, n in own.items()}
        best = []
        for label in {x for x, _ in rest}:
            c = {t: w * idf(t) for t, w in cents[label].items()}
            norm = math.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in c.values()))
            best.append((-round(sum(x * c.get(t, 0) for t, x in v.items()) / norm, 9) if norm else 0.0, label))
        out[key] = (min(best)[1], round(-min(best)[0], 6))
    return out


def test_held_out_equals_models_built_anew(spark):
    r = random.Random(7)
    common = [f"com{i}" for i in range(4)]
    rows = []
    for i in range(24):
        label = "xyz"[i % 3]
        own = [f"{label}word{r.randrange(6)}" for _ in range(8)] + [f"any{r.randrange(12)}" for _ in range(6)] + r.sample(common, 2)
        rows.append((f"f{i:02}", label, " ".join(own)))
    rows.append(("only", "w", "unheard words"))
    docs = spark.createDataFrame(rows, "source_file string, label string, text string")
    family = {k: "pair" if k in ("f00", "f03", "f01") else k for k, *_ in rows}
    for group, column in (({k: k for k in family}, None), (family, F.when(F.col("source_file").isin("f00", "f03", "f01"), "pair").otherwise(F.col("source_file")))):
        got = search.held_out(docs, "source_file", "label", column).collect()
        assert {r.source_file: r.predicted for r in got} == {k: v[0] for k, v in brute_held_out(rows, group).items()}
        assert all(abs(r.score - brute_held_out(rows, group)[r.source_file][1]) < 2e-6 for r in got)
        assert [r.source_file for r in got if not r.scored] == ["only"]


def test_held_out_by_document_and_by_family(spark, tmp_path):
    alike = words(50, 60)
    texts = {"a": f"{alike} one", "b": f"{alike} two", "c": words(51, 60), "d": words(51, 60) + " cash"}
    labels = {"a": "x", "b": "x", "c": "y", "d": "z"}
    spark.createDataFrame([(k, k, t) for k, t in texts.items()], "doc_id string, source_file string, text string").write.parquet(f"{tmp_path}/cleaned_docs.parquet")
    spark.createDataFrame([(k, v, "one publisher") for k, v in labels.items()], "source_file string, label string, source string").write.parquet(f"{tmp_path}/doc_labels.parquet")
    alone = {r.source_file: (r.predicted, r.scored) for r in queries.doctype_held_out(spark, str(tmp_path)).collect()}
    assert alone["a"] == alone["b"] == ("x", True) and not alone["c"][1] and alone["c"][0] == "z"
    family = {r.source_file: r.scored for r in queries.doctype_held_out_family(spark, str(tmp_path)).collect()}
    assert family == dict.fromkeys("abcd", False)
    assert {"doctype_held_out_family", "doctype_accuracy_family"} <= set(queries.queries())
    got = queries.doctype_accuracy(spark, str(tmp_path)).first()
    assert (got.n_scored, got.accuracy, got.accuracy_of_all) == (2, 1.0, 0.5)


def test_filters(spark):
    rows = [("ok", " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(60))), ("short", "few words"), ("numbers", "1234 5678 " * 30), ("none", None)]
    got = {r.k: r.f for r in spark.createDataFrame(rows, "k string, text string").select("k", filters.failed_filters("text").alias("f")).collect()}
    assert got["ok"] == [] and "word_count" in got["short"]
    assert {"numbers", "words_without_alphabets", "top_2grams", "dup_5grams"} <= set(got["numbers"])


def test_tokens(spark):
    df = spark.createDataFrame([("a", "one two"), ("a", None), ("b", "")], "source_file string, text string")
    assert [(r.source_file, r.chunks, r.tokens) for r in tokens.token_stats(df).collect()] == [("a", 2, 2), ("b", 1, 0)]


def test_whole_plan(spark):
    good = "The bank keeps a record of every customer and of every transaction that it makes. "
    rows = [("1", "a.pdf", good + words(21, 200) + " write to me@site.org", "en"), ("2", "b.pdf", good, "en"), ("3", "c.pdf", words(22, 200), "fr"), ("4", "d.pdf", "", None)]
    docs = spark.createDataFrame(rows, "doc_id string, source_file string, text string, lang string")
    out = pipeline.curate(docs, compare=True)
    summary = out.summary()
    assert [s["stage"] for s in summary] == ["clean_langid", "dedup", "quality_filter", "pii_redact"]
    assert all(s["docs_in"] - s["removed"] == s["docs_out"] for s in summary)
    assert summary[1]["docs_out"] == summary[2]["docs_in"] and summary[2]["docs_out"] == summary[3]["docs_in"]
    texts = [r.text for r in out.records.collect()]
    assert texts and not any("me@site.org" in t for t in texts) and any("[REDACTED_EMAIL]" in t for t in texts)
    assert pipeline.residual(out.records).count() == 0
    again = sorted(r.text for r in pipeline.curate(docs).records.collect())
    assert again == sorted(texts)
