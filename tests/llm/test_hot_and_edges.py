import itertools
import random

from lamella.llm import nearcopies, personal
from lamella.llm.budget import with_counts
from lamella.llm.encoding import decoded, encoded
from lamella.llm.leakage import sketches


def form(r, fill):
    """A form of 60 words with 12 of them filled in."""
    w = [f"form{i}" for i in range(60)]
    for i in range(0, 60, 5):
        w[i] = f"{fill}x{r.randrange(3)}"
    return w


def test_crowded_bands_give_the_same_pairs(spark):
    r = random.Random(8)
    rows = []
    for i in range(30):
        w = form(r, i // 3)
        rows += [(f"k{i:02}", " ".join(w)), (f"l{i:02}", " ".join([*w[:-1], "end"]))]
    df = spark.createDataFrame(rows + [("copy", rows[0][1])], "chunk_id string, text string")
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in ((k, t.split()) for k, t in [*rows, ("copy", rows[0][1])])}
    want = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.75}
    for hot in (1, 4, 1000):
        got = {(x.chunk_id_a, x.chunk_id_b) for x in nearcopies.near_copy_pairs(df, "chunk_id", "text", 0.75, hot=hot).collect()}
        assert got == want and len(want) > 10
    # groups: the same links, without a pair for each
    groups = {x.chunk_id: (x.group, x.links) for x in nearcopies.near_copy_groups(df, "chunk_id", "text", 0.75).collect()}
    assert set(groups) == set(sets)
    for k in sets:
        mine = {b if a == k else a for a, b in want if k in (a, b)}
        assert groups[k][1] == len(mine)
        assert all(groups[k][0] == groups[j][0] for j in mine) and groups[k][0] <= k


def test_groups_of_no_rows_and_of_copies(spark):
    empty = spark.createDataFrame([], "chunk_id string, text string")
    assert nearcopies.near_copy_groups(empty, "chunk_id", "text").count() == 0
    few = spark.createDataFrame([("a", "one two"), ("b", "one two"), ("c", None), (None, "one two"), ("d", "")], "chunk_id string, text string")
    assert {(x.chunk_id, x.group, x.links) for x in nearcopies.near_copy_groups(few, "chunk_id", "text").collect()} == {("a", "a", 0), ("b", "a", 0), ("d", "d", 0)}


def test_a_third_of_equal_texts_is_encoded(spark):
    texts = ["the hot  text", None, "", *(f"rare{i} words {i}" for i in range(40))]
    rows = [(i, texts[0] if i % 3 == 0 else texts[i % len(texts)]) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    back = {x.doc_id: x.text for x in decoded(encoded(df, "doc_id", "text", head=2), "doc_id").collect()}
    assert back == {i: t or "" for i, t in rows}
    counted = {x.doc_id: x.tokens for x in with_counts(df, "text", "doc_id", "words").collect()}
    assert counted == {i: len((t or "").split()) for i, t in rows}


def kinds(text):
    return [(c[0], text[c[1] : c[2]]) for c in personal.candidates(text)]


def test_one_letter_hides_no_address():
    for tail in ("", " İ", " İİstanbul"):
        assert ("EMAIL", "some.one@site.org") in kinds("write to Some.One@Site.org now".lower() + tail)
    low = personal.folded("AİBß")
    assert low == "aİbß" and len(low) == 4
    cues = (["spoke to"], [])
    assert [c for c in personal.candidates("she spoke to ramesh kumar İ", cues=cues) if c[0] == "PERSON_NAME"]


def test_numbers_side_by_side():
    assert [k for k in kinds("call 9876543210 9123456780 today") if k[0] == "PHONE"] == [("PHONE", "9876543210"), ("PHONE", "9123456780")]
    assert ("PHONE", "9876543210") in kinds("1. call 9876543210. 2 times")
    assert not [k for k in kinds("ref 1234-5678-9012-3456-7890") if k[0] in ("PHONE", "AADHAAR")]


def test_capitals_are_judged_where_they_stand():
    head = "GENERAL NOTICE ABOUT EVERY ACCOUNT THAT THIS BANK KEEPS FOR CLIENTS WITHIN INDIA " * 2
    tail = "and then the long body of the notice goes on in ordinary letters for quite some while " * 2
    assert any(v == "RAMESH KUMAR" for _, v in kinds(f"{head}{tail} the form of RAMESH KUMAR was seen"))
    assert not any(v == "ACCOUNT THAT" for _, v in kinds(head))


def test_items_of_all_sizes_have_a_least_number_of_values():
    items = [(i, " ".join(f"w{i}x{j}" for j in range(n))) for i, n in enumerate((3, 12, 20, 200))]
    s = sketches(items, 12, None)
    assert s["shingles"].tolist() == s["size"].tolist() == [0, 1, 9, 189] and s["fewest"].tolist() == [1, 1, 1, 1]
    t = sketches(items, 12, 0.8)
    assert t["size"].tolist() == [0, 1, 4, 52] and t["fewest"].tolist() == [1, 1, 3, 15]


def test_letters_of_all_planes_are_letters():
    import numpy as np
    import pyarrow as pa

    from lamella.llm import language, prose

    assert prose._KINDS_OF(np.array([0x11013, 0x11038, 0x11066, 0x1F600, 32])).tolist() == [1, 2, 3, 0, 4]
    assert language._LETTERS(np.array([0x11013, 0x1F600])).tolist() == [1, 0]
    stats, _ = prose.stats_of(pa.array(["\U00011013\U00011015 \U00011066"]))
    assert stats["symbol_ratio"][0] == 0 and round(float(stats["digit_ratio"][0]), 6) == 0.333333


def test_hindi_in_latin_letters_begins_with_what_no_other_language_explains():
    from collections import Counter

    import numpy as np

    from lamella.llm import language

    en, hi = Counter({"bank": 9, "record": 9}), Counter({"khata": 9, "nideshak": 9})
    rows, others = [("hi-Latn", hi), ("hi-Latn", en)], [*[("en", en)] * 9, ("en", hi), ("bn", Counter({"ব্যাংক": 9}))]
    good, bad = [2.0] + [0.0] * 8, [-2.0] + [-3.0] * 8
    letters = {id(en): 90, id(hi): 117}
    scores = np.array([np.array(bad if bag is hi else good) * letters.get(id(bag), 50) for _, bag in rows + others])
    got = language.begun(rows, others, scores)
    assert [k for k, bag in got if bag is hi] == ["hi-Latn", "hi-Latn"] and [k for k, bag in got if bag is en] == ["en"] * 9
