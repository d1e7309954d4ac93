import random

from lamella.llm import flat, scanned


def test_no_length_of_text_line_or_word_is_left_out(spark):
    r = random.Random(3)
    long = "".join(r.choice("abcdefghij") for _ in range(70))
    filler = " ".join(f"{w} " * 40 for w in "bank that rule form with from".split())
    broken = f"{long[:35]}-\n{long[35:]} of it"
    head = "Quarterly Manual of the Accounts and Records that Every Branch and Every Office of the Undertaking Keeps for Seven Years or More"
    body = [f"line {i} of the body that runs on and" for i in range(30)]
    pages = "\n".join(x for p in range(3) for x in (head, *body[10 * p : 10 * p + 10]))
    mark = "page" + " " * 30 + "12"
    rows = [("count", f"{filler}\n" + f"{long} " * 9), ("broken", broken), ("parted", f"so {long[:34]} {long[34:]} it is"), ("short", "ru1e"), ("three", f"one line\n- 3 -\nanother"), ("pages", pages), ("mark", f"one\n{mark}\ntwo")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    got = {}
    for size in (200_000, 4):
        got[size] = {(x.doc_id, x.line_no, x.noise) for x in scanned.noise(df, "doc_id", "text", head=size).collect()}
    want = {("broken", 0, "hyphen"), ("parted", 0, "split"), ("short", 0, "char"), ("three", 1, "page_number"), ("mark", 1, "page_number")} | {("pages", 11 * p, "header") for p in range(3)}
    assert got[200_000] == got[4] == want


def test_letters_of_all_planes_are_counted(spark):
    word = "\U00011013\U00011015\U00011017"
    table = scanned.word_table(spark.createDataFrame([(f"{word} {word} \U0001f600",)], "text string")).collect()
    assert [(x.word, x.n) for x in table] == [(word, 2)]
    import numpy as np

    kinds = flat.Classes(str.isalpha)
    assert kinds(np.array([0x11013, 0x1F600, 65, 65])).tolist() == [1, 0, 1, 1]


def test_bounds_of_the_head_ask_only_what_is_open():
    head = scanned.Head([("known", 9, None, None), ("word", 5, None, None)], 25, False)
    assert head.beyond("other") and head.most("other") == 5 and head.most("x" * 61) == float("inf")
    whole = scanned.Head([("known", 9, None, None)], 25, True)
    assert not whole.beyond("other") and whole.beyond("x" * 61) and whole.most("other") == 0
    assert scanned._asked_at_end("wo", "rd", head) == [] and scanned._asked_at_end("un", "seen", whole) == []
