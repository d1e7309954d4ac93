"""Personal information inside free text.

Information-theoretic sanitisation. Every place whose shape could be a protected value (a mail address, a run of digits, a
tax number, a date, a house address, a name) is a candidate, and the words around it are its terms. Over the whole corpus
it is counted how often a term stands at a candidate of a shape, and how often that candidate is certainly protected:
by an example of a labelled table, or by its own form (an international phone number, a valid check digit, a title
before a name). From these co-occurrences a term's disclosure is estimated, the bits by which it raises the odds that
the value is a protected entity. Candidates whose terms disclose more than a threshold are replaced by typed placeholders; where other terms
speak against it (a committee, a reference, an amount), they stay.

Counts are combined a block at a time before they are shuffled; terms and candidates meet in a join that Spark may
broadcast only if the term table is small.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.functions.joins import spread_join
from lamella.session import written

TYPES = ["EMAIL", "PHONE", "PAN", "AADHAAR", "ACCOUNT_NUMBER", "DATE", "ADDRESS", "PERSON_NAME"]

# The dihedral tables of the Verhoeff check digit.
_D = [[0, 1, 2, 3, 4, 5, 6, 7, 8, 9], [1, 2, 3, 4, 0, 6, 7, 8, 9, 5], [2, 3, 4, 0, 1, 7, 8, 9, 5, 6], [3, 4, 0, 1, 2, 8, 9, 5, 6, 7], [4, 0, 1, 2, 3, 9, 5, 6, 7, 8], [5, 9, 8, 7, 6, 0, 4, 3, 2, 1], [6, 5, 9, 8, 7, 1, 0, 4, 3, 2], [7, 6, 5, 9, 8, 2, 1, 0, 4, 3], [8, 7, 6, 5, 9, 3, 2, 1, 0, 4], [9, 8, 7, 6, 5, 4, 3, 2, 1, 0]]
_P = [[0, 1, 2, 3, 4, 5, 6, 7, 8, 9], [1, 5, 7, 6, 2, 8, 3, 0, 9, 4], [5, 8, 0, 3, 7, 9, 6, 1, 4, 2], [8, 9, 1, 6, 0, 4, 3, 5, 2, 7], [9, 4, 5, 3, 1, 2, 6, 8, 7, 0], [4, 2, 8, 6, 5, 7, 3, 9, 0, 1], [2, 7, 9, 3, 8, 0, 6, 4, 1, 5], [7, 0, 4, 6, 9, 1, 3, 2, 5, 8]]


def check_digit_holds(digits: str) -> bool:
    """Verhoeff's check over all digits, the check digit last."""
    c = 0
    for i, d in enumerate(reversed(digits)):
        c = _D[c][_P[i % 8][int(d)]]
    return c == 0


_ZEROS = (0x0966, 0x09E6, 0x0AE6, 0x0BE6, 0xFF10, 0x0660)
_ASCII = {z + i: str(i) for z in _ZEROS for i in range(10)}
_DIG = "0-9" + "".join(f"{chr(z)}-{chr(z + 9)}" for z in _ZEROS)

_EMAIL = re.compile(r"[a-z0-9][a-z0-9._+-]*(?: ?@ ?| ?[(\[] ?at ?[)\]] ?)[a-z0-9-]+(?:(?:\.| ?[(\[] ?dot ?[)\]] ?| dot )[a-z0-9-]*[a-z]{2,})+")
_SPOKEN = re.compile(r"[a-z0-9][a-z0-9._+-]* at [a-z0-9-]+(?:(?: dot | ?[(\[] ?dot ?[)\]] ?)[a-z]{2,})+")
_RUN = re.compile(rf"[{_DIG}]+")
_GAP = re.compile(r"[ .()\[\]/-]{1,2}")
_PAN_LEFT, _PAN_RIGHT = re.compile(r"(?<![A-Za-z0-9])([A-Za-z]{5})[ -]?$"), re.compile(r"[ -]?([A-Za-z])(?![A-Za-z0-9])")
_MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_DATE_LEFT = re.compile(rf"(?:[{_DIG}]{{1,2}}(?:st|nd|rd|th)?(?: of)? {_MONTH}\.?,? |{_MONTH}\.? [{_DIG}]{{1,2}}(?:st|nd|rd|th)?,? )$", re.I)
_DATE = re.compile(rf"(?:[{_DIG}]{{1,2}}([./-])[{_DIG}]{{1,2}}\1[{_DIG}]{{4}}|[{_DIG}]{{4}}([./-])[{_DIG}]{{1,2}}\2[{_DIG}]{{1,2}})")
_PIN = rf"[{_DIG}]{{3}} ?[{_DIG}]{{3}}(?![{_DIG}])"
# a house, by its own word or by a number before a name; then the place, a PIN code at the end where there is one
_HOUSE_WORD = re.compile(r"(?<![A-Za-z])(?:flat|plot|house|h\. ?no|door|d\. ?no|qr|c/o|village)(?=[ .:]|no)", re.I)
_PLACE = r"[,\n] ?[A-Za-z0-9][\w'/-]*(?: [\w'/-]+){0,5}"
_HOUSE_OPEN = r"(?:(?:flat|plot|house|h\.|door|d\.|qr\.?)[ .]{0,2}(?:no\.?)?[ .:-]{0,2}[0-9][\w/-]*|c/o [^,.;\n]{2,40}|village [A-Za-z]+)"
_HOUSE = re.compile(rf"{_HOUSE_OPEN}(?:{_PLACE}){{0,4}}?(?:[ -]{{1,3}}|, ?(?:pin )?){_PIN}|{_HOUSE_OPEN}(?:, ?[\w'/-]+(?: [\w'/-]+){{0,5}}){{0,3}}, ?[\w'-]+(?: [A-Z][\w'-]+)?", re.I)
_NUMBERED = re.compile(rf"[0-9]{{1,4}}(?:[/-][0-9A-Za-z]{{1,3}}){{0,3}}, [A-Za-z][\w.' -]{{2,40}}, ?[A-Za-z][\w.' -]{{2,30}}[ -]{{1,3}}{_PIN}")
# Titles before names.
_TITLE = r"(?:shri|smt|kum|mr|mrs|ms|dr|sri|prof|m/s|श्रीमती|श्री|सुश्री|कुमारी)"
_CAPITAL = r"(?:[A-Z][a-z]{2,}|[A-Z]{3,})(?![^\W_])"
_TITLED = re.compile(rf"(?<![\w@./+-])(?:(?i:{_TITLE}))\.? (?:proprietor )?((?:[A-Z]\. ?){{0,3}}{_CAPITAL}(?:,? (?:[A-Z]\. ?)?{_CAPITAL}){{0,3}})(?![\w@+-])")
_PAIR = re.compile(r"[A-Z](?:[a-z]{3,}|\.)(?:,? [A-Z]\.)?,? [A-Z][a-z]{3,}(?: [A-Z][a-z]{3,})?(?![\w@+-])|(?:[A-Z]{4,}|[A-Z]\.)(?:,? [A-Z]\.)?,? [A-Z]{4,}(?: [A-Z]{4,})?(?![\w@+-])")
_SHOUT = re.compile(r"[A-Z]{4,}")
# Words before and behind which names are looked for in lower case, besides those of the labelled texts.
CUES_BEFORE = ["spoke to", "applicant:", "applicant", "\u0906\u0935\u0947\u0926\u0915", "shri", "smt.", "kum.", "mr.", "mrs.", "ms", "dr", "proprietor"]
CUES_BEHIND = [" s/o", " d/o", " w/o", " \u0928\u0947 \u092a\u094d\u0930\u0924\u093f"]
_WORD = re.compile(r"[^\W_]+(?:[./'’-][^\W_]+)*\.?|[:;]")
_SENTENCE = re.compile(r"[.!?।;/] +(?=[^\W\d_])|\n| / ")
_STOP = re.compile(r"[.!?।;](?: |$)|\n| / ")


def digits_of(value: str) -> str:
    return re.sub(r"\D", "", value.translate(_ASCII))


def left_terms(text: str, start: int) -> list[str]:
    """Of the words before a candidate in its sentence: the last three, the last two, the last one."""
    before = text[max(0, start - 40) : start]
    words = _WORD.findall(_SENTENCE.split(before)[-1])
    if start > 40 and len(words) > 3:
        words = words[1:]
    words = ["#" if w[0].isdigit() else w.lower() for w in words[-3:]]
    return ["<" + " ".join(words[i:]) for i in range(len(words)) if i < len(words) - 1 or words[-1] not in ":;#"]


def right_terms(text: str, end: int) -> list[str]:
    """Of the words behind it in its sentence: the first two, the first one."""
    after = text[end : end + 26]
    words = _WORD.findall(_STOP.split(after)[0])[:2]
    words = ["#" if w[0].isdigit() else w.lower() for w in words]
    return [">" + " ".join(words[:i]) for i in range(len(words), 0, -1)]


#: shape, start, end, what its own form says (1 protected, 0 open), terms from the most to the least specific
Candidate = tuple[str, int, int, int, list[str]]


def _phone_form(raw: str, d: str) -> bool:
    """A number written as nothing but a phone number: with the country's prefix, or an area code in parentheses."""
    return bool(re.match(r"\+ ?91|0091", raw) and len(d) in (12, 14) or re.match(r"\(0\d{2,4}\)", raw) and 10 <= len(d) <= 12)


def _number(text: str, a: int, b: int) -> list[Candidate]:
    """What a number of 9 to 18 digits from a to b can be."""
    out: list[Candidate] = []
    if not 9 <= sum(c.isdigit() for c in text[a:b]) <= 18:
        return out
    before, after = text[a - 1 : a], text[b : b + 1]
    far = text[max(0, a - 2) : a]
    if not (before.isalpha() or before in ",.₹@_/" and before or after.isalpha() or after in "%_" and after or after in ",." and text[b + 1 : b + 2].isdigit()):
        if far[-1:] == "(":
            a -= 1
            far = text[max(0, a - 2) : a]
        if far[-1:] == "+" or far == "+ ":
            a -= 1 if far[-1:] == "+" else 2
        raw = text[a:b].translate(_ASCII)
        d = re.sub(r"\D", "", raw)
        if len(set(d)) > 1 and not d.startswith(("1800", "1860")):
            terms = left_terms(text, a) + right_terms(text, b)
            groups = [len(g) for g in re.findall(r"\d+", raw)]
            if len(d) == 12 and d[0] in "23456789" and raw[0] not in "+(" and groups in ([12], [4, 4, 4]):
                out.append(("AADHAAR", a, b, int(check_digit_holds(d) and not (terms and re.match(r"<(?:# )*#$", terms[0]))), terms))
            if _phone_form(raw, d) or len(d) == 10 and d[0] in "6789" and raw[0] not in "+(" and groups in ([10], [5, 5], [3, 3, 4]) or len(d) == 11 and d[0] == "0" and groups == [11]:
                out.append(("PHONE", a, b, int(_phone_form(raw, d)), terms))
            if raw[0] not in "+(":
                out.append(("ACCOUNT_NUMBER", a, b, 0, terms))
    return out


def _numbers(text: str, runs: list[tuple[int, int]], old: int, out: list[Candidate]) -> None:
    """Candidates that are made of digits: numbers, tax numbers and dates."""
    i, n = 0, len(runs)
    while i < n:
        a, b = runs[i]
        j, size = i, b - a
        while j + 1 < n and runs[j + 1][0] - b <= 2 and size < 19 and _GAP.fullmatch(text, b, runs[j + 1][0]):
            j += 1
            size += runs[j][1] - runs[j][0]
            b = runs[j][1]
        if b - a == 4 and i == j or size in (8, 7, 6) and j - i == 2:
            if j - i == 2:
                m = _DATE.fullmatch(text, a, b)
                if m:
                    year = int(max(re.split(r"[./-]", text[a:b].translate(_ASCII)), key=len))
                    out.append(("DATE", a, b, int(1900 < year <= old), left_terms(text, a) + right_terms(text, b)))
            else:
                m = _PAN_LEFT.search(text, max(0, a - 7), a)
                r = _PAN_RIGHT.match(text, b)
                if m and r:
                    letters = m.group(1) + r.group(1)
                    if (letters.isupper() or letters.islower()) and len(set(letters[:5])) > 1:
                        out.append(("PAN", m.start(1), r.end(1), 1, left_terms(text, m.start(1))))
                else:
                    year = int(text[a:b].translate(_ASCII))
                    m = _DATE_LEFT.search(text, max(0, a - 24), a) if 1900 < year < 2100 else None
                    if m:
                        out.append(("DATE", m.start(), b, int(year <= old), left_terms(text, m.start()) + right_terms(text, b)))
        elif size >= 9:
            got = _number(text, a, b) if size <= 18 else []
            if j > i and not any(c[0] in ("PHONE", "AADHAAR") for c in got):
                # several numbers side by side: each run that white space parts from the others
                for k in range(i, j + 1):
                    x, y = runs[k]
                    alone = (k == i or " " in text[runs[k - 1][1] : x]) and (k == j or " " in text[y : runs[k + 1][0]])
                    if alone:
                        got += [c for c in _number(text, x, y) if size > 18 or c[0] != "ACCOUNT_NUMBER"]
            out += got
        i = j + 1


def folded(text: str) -> str:
    """In lower case, each code point for itself: places in it are places in the text."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def candidates(text: str, old: int = 1995, cues: tuple[list[str], list[str]] = ([], [])) -> list[Candidate]:
    """All places whose shape could be protected. Dates of the year `old` or before speak for a birth by themselves.

    cues: words before and behind which names are looked for in lower case, where nothing else shows them.
    """
    out: list[Candidate] = []
    low = folded(text)
    mail: list[tuple[int, int]] = []
    if "@" in low or "(at)" in low or "[at]" in low or " at " in low and " dot " in low:
        for m in _EMAIL.finditer(low):
            mail.append(m.span())
        if " dot " in low or "dot]" in low or "dot)" in low:
            mail += [m.span() for m in _SPOKEN.finditer(low) if not any(a < m.end() and m.start() < b for a, b in mail)]
        for a, b in mail:
            local = re.split(r" ?@ ?| ?[(\[] ?at ?[)\]] ?| at ", low[a:b], maxsplit=1)[0]
            out.append(("EMAIL", a, b, 1, left_terms(text, a) + ["=" + w for w in re.findall(r"[a-z]{3,}", local)]))
    runs = [m.span() for m in _RUN.finditer(text)]
    if runs:
        if mail:
            runs = [r for r in runs if not any(a <= r[0] < b for a, b in mail)]
        _numbers(text, runs, old, out)
        for a, b in runs:
            if b - a <= 4 and text[b : b + 1] in ",/-" and text[b : b + 1]:
                m = _NUMBERED.match(text, a)
                if m:
                    out.append(("ADDRESS", a, m.end(), 1, left_terms(text, a)))
    if "flat" in low or "plot" in low or "c/o" in low or "village" in low or "no. " in low or "house" in low or "door" in low:
        last = -1
        for w in _HOUSE_WORD.finditer(text):
            m = _HOUSE.match(text, w.start())
            if m and m.start() >= last:
                last = m.end()
                out.append(("ADDRESS", m.start(), m.end(), int(re.search(_PIN + "$", m.group()) is not None), left_terms(text, m.start())))
    titled: list[tuple[int, int]] = []
    for m in _TITLED.finditer(text):
        a, b = m.span(1)
        parts = _parts(m.group(1))
        if not parts:
            continue
        titled.append((a, b))
        out.append(("PERSON_NAME", a, b, 1, left_terms(text, m.start()) + right_terms(text, b) + ["=" + p.lower() for p in parts]))
    # capitals say nothing of names where more than eight words around are in capitals too
    shouts = [m.start() for m in _SHOUT.finditer(text)]
    for m in _PAIR.finditer(text):
        a, b = m.span()
        value = m.group()
        if value.isupper() and bisect_left(shouts, b + 100) - bisect_left(shouts, a - 100) > 8 or any(x <= a < y for x, y in titled) or text[a - 1 : a].isalnum() or text[a - 1 : a] in "@._+" and a:
            continue
        left = left_terms(text, a)
        # one initial at the beginning of a sentence is a question's or an item's mark
        if not left and value[1] == "." and value.count(".") == 1:
            continue
        out.append(("PERSON_NAME", a, b, 0, left + right_terms(text, b) + ["=" + p.lower() for p in _parts(value)]))
        titled.append((a, b))
    found: dict[int, int] = {}
    for cue in cues[0]:
        at = low.find(cue)
        while at >= 0:
            m = _LOWER_NAME.match(text, at + len(cue))
            if m and not any(x <= m.start() < y for x, y in titled):
                found[m.start(1)] = m.end(1)
            at = low.find(cue, at + 1)
    for cue in cues[1]:
        at = low.find(cue)
        while at >= 0:
            m = _LOWER_BEFORE.search(text, max(0, at - 48), at)
            if m and not any(x < m.end(1) <= y for x, y in titled) and m.end(1) not in found.values():
                found[m.start(1)] = m.end(1)
            at = low.find(cue, at + 1)
    for a, b in found.items():
        parts = _parts(text[a:b])
        if parts:
            out.append(("PERSON_NAME", a, b, 0, left_terms(text, a) + right_terms(text, b) + ["=" + p.lower() for p in parts]))
    return out


_LOWER_NAME = re.compile(r"[ :,]{0,2}((?:[a-z]\.,? ?){0,2}[a-z]{4,}(?:(?:,? (?:[a-z]\. )?)[a-z]{4,}){0,2})(?![a-z])")
_LOWER_BEFORE = re.compile(r"(?:^|[.!?।;/] +|\n| and |, )((?:[a-z]\.,? ?){0,2}[a-z]{4,}(?:(?:,? (?:[a-z]\. )?)[a-z]{4,}){0,2}),? ?$")


def _parts(value: str) -> list[str]:
    """The written-out names of a name, initials left out."""
    return [p for p in re.split(r"[, ]+", value) if len(p.strip(".")) > 2]


CANDIDATE = "shape string, start int, `end` int, own int, terms array<string>"


def _extract(old: int, cues: tuple[list[str], list[str]]):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.string())]
        for batch in batches:
            rows, owner = [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                own = candidates(t, old, cues)
                rows += own
                owner += [i] * len(own)
            cols = list(zip(*rows)) if rows else [[]] * 5
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["key", "text_id", "shape", "start", "end", "own", "terms"])

    return go


def labelled_rows(labelled: DataFrame, most: int) -> list[tuple[str, list[tuple[str, str]]]]:
    """At most `most` labelled texts, those with the least hashes, with their protected (type, value)."""
    rows = labelled.where(F.col("text").isNotNull()).orderBy(F.xxhash64("text"), "text").limit(most).collect()
    return [(r.text, [(x["type"], x["value"]) for x in r.pii or []]) for r in rows]


def cues_of(labelled: list[tuple[str, list[tuple[str, str]]]]) -> tuple[list[str], list[str]]:
    """The two words before and behind the names of labelled texts, where they come at least twice."""
    left, right = Counter(), Counter()
    for text, known in labelled:
        for kind, value in known:
            at = text.find(value)
            if kind != "PERSON_NAME" or at < 0:
                continue
            m = re.search(r"([^\W\d_]+ [^\W\d_]+[:,]?) (?:\w+\.? )?$", text[max(0, at - 30) : at])
            before = re.search(r"([^\W\d_]+,? (?:[^\W\d_]+)[,:]?) $", text[max(0, at - 30) : at])
            if before and not re.search(_TITLE + r"$", before.group(1), re.I):
                left[before.group(1).lower()] += 1
            elif m:
                left[m.group(1).lower()] += 1
            b = re.match(r",? [\w/]+ \w+", text[at + len(value) :])
            if b:
                right[b.group().lower()] += 1
    return sorted({*CUES_BEFORE, *(w for w, n in left.items() if n >= 2)}), sorted({*CUES_BEHIND, *(w for w, n in right.items() if n >= 2)})


def _label_counts(labelled: list[tuple[str, list[tuple[str, str]]]], old: int, cues: tuple[list[str], list[str]]) -> list[tuple[str, str, int, int]]:
    """(shape, term, protected places, other places) of the labelled texts."""
    yes, no = Counter(), Counter()
    for text, known in labelled:
        for shape, a, b, _, terms in candidates(text, old, cues):
            value = text[a:b].strip(" .,")
            hit = any(t == shape and (v in value or value in v) for t, v in known)
            for t in set(terms):
                (yes if hit else no)[shape, t] += 1
    return [(s, t, yes[s, t], no[s, t]) for s, t in sorted({*yes, *no})]


def disclosures(places: DataFrame, labels: DataFrame, support: int = 3) -> DataFrame:
    """(shape, term, n, rate, bits, lp, ln): how strongly a term says that a value of the shape is protected.

    rate is the share of protected places among those the term stands at: of the labelled ones where there are any, else of
    the corpus's, where a place is protected for certain by its own form; terms at fewer than `support` places and no
    labelled one say nothing, nor do terms without a labelled one where no place of the shape is ever certain. bits is log2 of the rate against the shape's in the whole corpus.
    """
    once = places.select("shape", "own", F.explode(F.array_distinct("terms")).alias("term"))
    counted = once.groupBy("shape", "term").agg(F.count("*").alias("n"), F.sum("own").alias("s"))
    # one row a shape, of which there are eight
    base = places.groupBy("shape").agg(((F.sum("own") + 1) / (F.count("*") + 2)).alias("base"), F.sum("own").alias("certain"))
    both = counted.join(labels, ["shape", "term"], "full").fillna(0, ["n", "s", "lp", "ln"]).join(F.broadcast(base), "shape", "left")
    seen = F.col("lp") + F.col("ln")
    rate = F.when(seen > 0, (F.col("lp") + 0.25) / (seen + 0.5)).when(F.col("certain") > 0, F.try_divide("s", "n"))
    # a term that labelled texts have at other places only, but that certain places of the corpus have as well, is open
    rate = F.when((seen > 0) & (F.col("lp") == 0) & (F.col("s") * 5 >= F.col("n")) & ~F.col("term").startswith("="), F.try_divide("s", "n")).otherwise(rate)
    # where certain places are many, a term that hardly ever stands at one is no sign, whatever a few labelled texts say
    rate = F.when((F.col("certain") > 0) & (F.col("n") >= 20) & (F.try_divide("s", "n") < 0.02), F.try_divide("s", "n")).otherwise(rate)
    # a name's own words are in few labelled texts: the corpus says how often they come as names
    word = F.greatest(F.coalesce(F.try_divide("s", "n"), F.lit(0.0)), F.when(F.col("lp") > 0, F.col("lp") / (seen + 0.5)).otherwise(0.0))
    rate = F.when(F.col("term").startswith("="), word).otherwise(rate)
    told = both.where((F.col("n") >= support) | (seen > 0)).withColumn("rate", rate)
    return told.select("shape", "term", "n", "rate", F.log2((F.col("rate") + 0.001) / F.coalesce("base", F.lit(0.5))).alias("bits"), "lp", "ln")


def protected_places(records: DataFrame, key: str, text: str, labelled: DataFrame, old: int = 1995, most_labelled: int = 1000) -> DataFrame:
    """(key, text_id, shape, start, end, rate): the places that must be replaced, of all texts.

    labelled: (text, pii array<struct<type, value>>), of which at most most_labelled rows are used. Null keys and texts give
    nothing; rows that come again give their places once.
    """
    spark = records.sparkSession
    known = labelled_rows(labelled, most_labelled)
    cues = cues_of(known)
    labels = spark.createDataFrame(_label_counts(known, old, cues) or [("", "", 0, 0)], "shape string, term string, lp int, ln int")
    rows = records.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.xxhash64(text).alias("text_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("key", records.schema[key].dataType), T.StructField("text_id", T.LongType()), *T._parse_datatype_string(CANDIDATE).fields])
    places = written(rows.mapInArrow(_extract(old, cues), schema), "places")
    told = written(disclosures(places, labels), "disclosures")
    terms = places.select("key", "text_id", "shape", "start", "end", "own", F.posexplode("terms").alias("pos", "term"))
    # common words stand at a large share of all places; there are fewer than 1,000 with over a thousandth of them
    hot = told.crossJoin(F.broadcast(told.agg(F.sum("n").alias("all")))).where(F.col("n") * 1000 > F.col("all")).select("shape", "term", F.lit(True).alias("_hot"))
    met = spread_join(terms, told, ["shape", "term"], "left", F.struct("text_id", "start"), hot)

    def side(mark: str) -> F.Column:
        return F.min_by("rate", F.when(F.col("term").startswith(mark) & F.col("rate").isNotNull(), F.col("pos")))

    def tokens(c: F.Column) -> F.Column:
        return F.when(F.col("term").startswith("="), c)

    seen = met.groupBy("key", "text_id", "shape", "start", "end", "own").agg(
        side("<").alias("l"),
        side(">").alias("r"),
        F.avg(tokens(F.col("rate"))).alias("t"),
        F.max(tokens(((F.col("ln") >= 4) & (F.col("lp") == 0)).cast("int"))).alias("t_no"),
        F.min_by(((F.col("ln") >= 4) & (F.col("lp") == 0)).cast("int"), tokens(F.col("pos"))).alias("t_first"),
        F.count(tokens(F.lit(1))).alias("t_n"),
    )
    left, right = F.col("l"), F.col("r")
    ctx = F.coalesce(left, right)
    given = F.coalesce(ctx, F.lit(0.0))
    strong = F.greatest(F.coalesce(left, F.lit(0.0)), F.coalesce(right, F.lit(0.0)))
    own, no_token = F.col("own") == 1, F.coalesce("t_no", F.lit(0)) == 0
    known_token = F.coalesce("t", F.when(strong >= 0.3, 0.1).otherwise(0.0))
    behind = F.coalesce(right, F.lit(1.0)) >= 0.02
    rule = (
        F.when(F.col("shape") == "EMAIL", no_token & (F.coalesce(left, F.lit(1.0)) >= 0.3))
        .when(F.col("shape") == "PAN", F.coalesce(left, F.lit(1.0)) >= 0.1)
        .when(F.col("shape") == "AADHAAR", F.when(own, F.coalesce(left, F.lit(1.0)) >= 0.15).otherwise(given >= 0.3))
        .when(F.col("shape") == "PHONE", F.when(own, F.lit(True)).otherwise(given >= 0.1))
        .when(F.col("shape") == "ACCOUNT_NUMBER", given >= 0.5)
        .when(F.col("shape") == "DATE", given >= 0.25)
        .when(F.col("shape") == "ADDRESS", F.when(own, F.coalesce(left, F.lit(1.0)) >= 0.1).otherwise(F.coalesce(left, F.lit(0.0)) >= 0.1))
        .when(own, F.coalesce("t_first", F.lit(0)) == 0)
        .otherwise(no_token & (behind & ((strong >= 0.1) & (known_token >= 0.08) | (known_token >= 0.2) & (F.col("t_n") >= 2)) | (F.coalesce(left, F.lit(0.0)) >= 0.3) & (F.coalesce("t", F.lit(0.1)) >= 0.08)))
    )
    held = seen.where(rule).withColumn("rate", F.when((F.col("shape") == "PHONE") & own, 1.0).otherwise(F.coalesce(ctx, F.lit(0.5))))
    # digits that could be several things are the one their words tell most of
    best = Window.partitionBy("key", "text_id", "start", F.col("shape").isin("PHONE", "AADHAAR", "ACCOUNT_NUMBER")).orderBy(F.desc("rate"), "shape")
    held = held.withColumn("rank", F.row_number().over(best)).where("rank = 1")
    return held.select("key", "text_id", "shape", "start", "end", "rate").withColumnRenamed("key", key)


def found_types(records: DataFrame, key: str, text: str, labelled: DataFrame) -> DataFrame:
    """(key, entity_type): the types of protected entities in each text, each once."""
    return protected_places(records, key, text, labelled).select(key, F.col("shape").alias("entity_type")).distinct()


def _replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, n = [], []
        for text, spots in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            done = len(text or "")
            count = 0
            # from the end, the longer of two that overlap
            for a, b, shape in sorted(((s["start"], s["end"], s["shape"]) for s in spots or []), key=lambda x: (-x[1], x[0])):
                if b <= done:
                    text = f"{text[:a]}[REDACTED_{shape}]{text[b:]}"
                    done = a
                    count += 1
            out.append(text)
            n.append(count)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string()), pa.array(n, pa.int32())], ["key", "text", "replaced"])


def redacted(records: DataFrame, key: str, text: str, labelled: DataFrame) -> DataFrame:
    """(key, text, replaced): every row with typed placeholders in place of protected values, the rest unchanged, and their number.

    A null text stays null; one row for each row of records.
    """
    spots = protected_places(records, key, text, labelled).withColumnRenamed(key, "key").groupBy("key", "text_id").agg(F.collect_set(F.struct("start", "end", "shape")).alias("spots"))
    rows = records.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField("key", records.schema[key].dataType), T.StructField("text", T.StringType()), T.StructField("replaced", T.IntegerType())])
    return rows.join(spots, ["key", "text_id"], "left").select("key", "text", "spots").mapInArrow(_replace, schema).withColumnRenamed("key", key)
