"""Noise in text from scanned pages: words broken at line ends, misread characters, stray spaces, running headers, page marks.

Words are counted over the whole corpus and grouped by a skeleton in which glyphs that scanners confuse are the same
strokes; a rare form whose group has a far more frequent one is a misreading of it. Headers are lines that come again in a
document, at a distance, once digits are masked and glyphs reduced to strokes. Broken and parted words are those whose
joined form the corpus knows far better than the parts. What remains is reflowed into paragraphs by SQL windows.

The `head` most frequent words, a table of proven size, go to all workers with their counts and corrections; a line that
needs a word beyond them leaves as an open case with these words' names and is looked at again, by the same rules, once
joins with the whole word table have told them.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import ChainMap
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm import flat
from lamella.session import written

HYPHENS = "-‐‑¬\xad"
# Glyphs that scanners take for a plain letter, then letters that look like two strokes.
SINGLES = {
    "0": "o", "1": "l", "5": "s", "6": "b", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i",
    "í": "i", "ì": "i", "î": "i", "ï": "i", "ι": "i", "і": "i", "ο": "o", "о": "o", "а": "a", "α": "a", "е": "e", "с": "c", "р": "p", "х": "x", "у": "y", "ν": "v",
    "é": "e", "è": "e", "ê": "e", "ë": "e", "á": "a", "à": "a", "â": "a", "ä": "a", "ã": "a", "å": "a", "ó": "o", "ò": "o", "ô": "o", "ö": "o", "õ": "o", "ú": "u", "ù": "u", "û": "u", "ü": "u", "ñ": "n", "ç": "c",
}
MERGED = {"e": "c", "l": "i", "f": "t"}
STROKES = [("m", "rri"), ("n", "ri"), ("d", "ci"), ("w", "vv"), ("u", "ii"), ("h", "ii")]


def skeleton(word: str) -> str:
    """Of a word in lower case: strokes in place of glyphs."""
    out = word.translate(_SINGLE)
    out = out.translate(_MERGED)
    for a, b in STROKES:
        out = out.replace(a, b)
    return out


_SINGLE, _MERGED = str.maketrans(SINGLES), str.maketrans(MERGED)
# rn is m's strokes once n is two of them; l and i are one glyph, so cl, li and ii come out as d, h and u do


def skeleton_column(word: str) -> F.Column:
    """skeleton() as a column."""
    out = F.col(word)
    for table in (SINGLES, MERGED):
        out = F.translate(out, "".join(table), "".join(table.values()))
    for a, b in STROKES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


_STRIP = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum()) + "“”‘’«»।॥…–—•₹©®~\xad¬‐"
_KEEP = _STRIP.replace("@", "")


def bare(token: str) -> str:
    """A token's word: in lower case, without punctuation around it."""
    return token.strip(_KEEP).lower()


#: 2 letters, 1 marks, figures and @, 0 all others.
_KINDS = flat.Classes(lambda c: 2 if unicodedata.category(c)[0] == "L" else unicodedata.category(c)[0] in "MN" or c == "@")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (word, n): partial counts of a block's words; words at a line end with a hyphen, and the next ones, are left out."""
    for batch in batches:
        for lo, hi, cps, bounds in flat.blocks(pa.array([(t or "").lower() for t in batch.column(0).to_pylist()], pa.string())):
            kinds = _KINDS(cps)
            solid = kinds > 0
            ts, te = flat.spans(~flat.white(cps), bounds)
            at = np.flatnonzero(solid)
            i, j = np.searchsorted(at, ts), np.searchsorted(at, te)
            ok = j > i
            if not ok.any():
                continue
            ws, we, ends = at[i[ok]], at[j[ok] - 1] + 1, te[ok]
            # a hyphen at the end of a token that a line break follows
            last = cps[ends - 1]
            hyphen = np.isin(last, [ord(c) for c in HYPHENS])
            newline = np.cumsum(cps == 10)
            nl = np.concatenate([[0], newline])
            breaks = np.zeros(len(ws), bool)
            breaks[:-1] = nl[ws[1:]] > nl[ends[:-1]]
            broken = hyphen & breaks
            after = np.zeros(len(ws), bool)
            after[1:] = broken[:-1]
            letter = np.concatenate([[0], np.cumsum(kinds == 2)])
            use = ~broken & ~after & (letter[we] > letter[ws])
            ws, we = ws[use], we[use]
            if not len(ws):
                continue
            h = flat.gram(flat.prefix(cps), ws, we)
            _, first, n = np.unique(h, return_index=True, return_counts=True)
            joined = cps.tobytes().decode("utf-32-le")
            yield pa.RecordBatch.from_arrays([pa.array([joined[ws[k] : we[k]] for k in first.tolist()]), pa.array(n)], ["word", "n"])


def word_table(texts: DataFrame) -> DataFrame:
    """(word, n, skeleton, form, form_n): every word of (text), its count, and the most frequent word of its skeleton."""
    counted = written(texts.select("text").mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "counts")
    keyed = counted.withColumn("skeleton", skeleton_column("word"))
    forms = keyed.where(F.col("word").rlike(r"^[a-z'’\-]+$")).groupBy("skeleton").agg(F.max(F.struct("n", "word")).alias("top"))
    return keyed.join(forms, "skeleton", "left").select("word", "n", F.col("top.word").alias("form"), F.col("top.n").alias("form_n"))


def misread(word: str, n: int, form: str | None, form_n: int | None, ratio: int) -> bool:
    """Whether the corpus supports form in place of word.

    A letter of another script, or a digit or sign inside a Latin word, needs a form that is as frequent; other letters one
    that is `ratio` times as frequent.
    """
    if not form or form == word or len(word) < 3:
        return False
    odd = odd_glyphs(word)
    if not confused(form, word, 2 if odd else 1):
        return False
    return form_n >= max(2, n) if odd else form_n >= ratio * n


# What scanners take for what; either may stand for the other.
CONFUSIONS = [
    ("e", "c"), ("i", "l"), ("i", "1"), ("l", "1"), ("l", "|"), ("t", "f"), ("n", "ri"), ("d", "cl"), ("u", "ii"), ("h", "li"), ("m", "rn"), ("w", "vv"),
    ("o", "0"), ("s", "5"), ("s", "$"), ("g", "9"), ("b", "6"), ("b", "8"), ("a", "@"), ("a", "а"), ("a", "α"), ("o", "ο"), ("o", "о"), ("e", "е"), ("c", "с"), ("p", "р"), ("x", "х"), ("y", "у"), ("v", "ν"),
    ("i", "ι"), ("i", "і"), ("i", "í"), ("a", "á"), ("e", "é"), ("o", "ó"), ("u", "ú"),
]
_BOTH = sorted({p for a, b in CONFUSIONS for p in ((a, b), (b, a))})


def confused(form: str, word: str, most: int) -> bool:
    """Whether word is form with at most `most` glyphs taken for others."""
    i, n = 0, min(len(form), len(word))
    while i < n and form[i] == word[i]:
        i += 1
    if i == len(form) and i == len(word):
        return True
    if most == 0 or abs(len(form) - len(word)) > most:
        return False
    # the difference may begin inside a pair of strokes that the two share the first of
    for at in (i, i - 1):
        if at >= 0:
            for a, b in _BOTH:
                if form.startswith(a, at) and word.startswith(b, at) and confused(form[at + len(a) :], word[at + len(b) :], most - 1):
                    return True
    return False


_ODD = re.compile(r"[a-z]")


def odd_glyphs(word: str) -> bool:
    """A Latin word with digits or @ among its letters, or with Greek or Cyrillic letters."""
    if not _ODD.search(word):
        return False
    letters = sum("a" <= c <= "z" for c in word)
    strange = sum(c in "01569@8$|" or "Ͱ" <= c <= "ӿ" for c in word)
    return 0 < strange <= letters


# Forms of page marks. The first ones are plain enough to stand alone.
PAGE_MARK = re.compile(r"(?:[-–—]+ ?\d{1,4} ?[-–—]+|p ?a ?g ?e ?\.? *:? *\d{1,4}(?: *(?:of|/) *\d{1,4})?|pg?\. *\d{1,4}|\[ ?\d{1,4} ?\]|\d{1,4} ?(?:/|of) ?\d{1,4}|\( ?\d{1,4} ?\)|seite \d{1,4}(?: von \d{1,4})?|पृष्ठ \d{1,4})", re.I)
BARE_MARK = re.compile(r"\d{1,4}|[ivxlc]{1,7}", re.I)
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def number_of(mark: str) -> int:
    m = re.search(r"\d+", mark)
    if m:
        return int(m.group())
    total, low = 0, mark.lower().strip()
    for a, b in zip(low, low[1:] + " "):
        v = _ROMAN.get(a, 0)
        total += -v if v < _ROMAN.get(b, 0) else v
    return total


def header_key(line: str) -> str:
    """A line without its numbers and case, in strokes; lines of one running header share it."""
    low = re.sub(r"\s+", " ", line.strip().lower())
    low = re.sub(r"^\d{1,4} ?\| ?|(?: ?\|| {2,}|\s) ?\d{1,4}$", "", re.sub(r"^\s*\d{1,4}\s*\|\s*|\s{2,}\d{1,4}\s*$|\s*\|\s*\d{1,4}\s*$", "", line.strip().lower()))
    low = re.sub(r"\s+", " ", low).strip()
    # a digit inside a word is a misread letter, others are numbers
    return skeleton(re.sub(r"(?<![a-z@])\d+(?![a-z@])", "#", low))


_NO_DIGITS = {ord(c): None for c in "0123456789| "}


def page_lines(lines: list[str]) -> dict[int, str]:
    """Line numbers of running headers and page marks.

    A mark stands for a page by its form; a bare number or numeral does where such lines count upwards down the text. A
    header is a line of at least two words that comes again some lines apart, runs into no sentence, and stands at a page
    mark or where the lines around it run on.
    """
    out: dict[int, str] = {}
    stripped = [x.strip() for x in lines]
    bare_at = []
    for i, s in enumerate(stripped):
        if not s:
            continue
        if PAGE_MARK.fullmatch(s):
            out[i] = "page_number"
        elif BARE_MARK.fullmatch(s):
            bare_at.append(i)
    for styles in ([i for i in bare_at if stripped[i].isdigit()], [i for i in bare_at if not stripped[i].isdigit()]):
        values = [number_of(stripped[i]) for i in styles]
        # the longest run that counts upwards by small steps, some lines apart
        chain: list[int] = []
        for i, v in zip(styles, values):
            last_one = i == styles[-1] and chain and i - chain[-1] >= 2
            if not chain or ((i - chain[-1] >= 5 or last_one) and 0 < v - number_of(stripped[chain[-1]]) <= 6):
                chain.append(i)
        if len(chain) >= 2:
            for i in chain:
                out[i] = "page_number"
    keys: dict[str, list[int]] = {}
    plain: dict[str, list[int]] = {}
    for i, s in enumerate(stripped):
        if i not in out and s and s[-1] not in ".;:?!।,":
            plain.setdefault(s.translate(_NO_DIGITS), []).append(i)
    # only lines about as long as one that comes again can belong to a running header
    sizes = {len(k) + d for k, v in plain.items() if len(v) > 1 for d in range(-3, 4)}
    for k, at in plain.items():
        if len(k) in sizes:
            for i in at:
                if len(re.findall(r"[^\W\d_]{3,}|[^\W\d_][^\W_]{2,}", stripped[i])) >= 2:
                    keys.setdefault(header_key(stripped[i]), []).append(i)
    marks = set(out)
    for at in map(sorted, keys.values()):
        if len(at) < 2:
            continue
        gaps = [b - a for a, b in zip(at, at[1:])]
        # the last page may be short
        if min(gaps[:-1], default=5) < 5 or gaps[-1] < 2:
            continue
        # neighbours that are page marks, or lines on either side that are one sentence
        near = sum(i - 1 in marks or i + 1 in marks for i in at)
        alone = sum((i == 0 or not stripped[i - 1]) and (i + 1 >= len(lines) or not stripped[i + 1]) for i in at)
        into = 0
        for i in at:
            prev = next((stripped[j] for j in range(i - 1, -1, -1) if j not in marks and j not in at), "")
            nxt = next((stripped[j] for j in range(i + 1, len(lines)) if j not in marks and j not in at), "")
            if prev and nxt and prev[-1] not in ".?!।:" or nxt[:1].islower():
                into += 1
        if alone * 2 > len(at):
            continue
        if near * 2 >= len(at) or into * 2 >= len(at) or (at[0] == 0 and into):
            for i in at:
                out[i] = "header"
    return out


#: Longer words stay out of the head, which so has a bounded size; they are looked up by joins.
LONG = 60


class Head:
    """The most frequent words: counts, and corrections of those that are misread. whole: no word of up to LONG code points is beyond it."""

    def __init__(self, rows: list[tuple[str, int, str | None, int | None]], ratio: int, whole: bool):
        self.count = {w: n for w, n, _, _ in rows}
        self.form = {w: f for w, n, f, m in rows if misread(w, n, f, m, ratio)}
        self.least = 0 if whole else min(self.count.values(), default=0)
        self.whole, self.ratio = whole, ratio

    def beyond(self, word: str) -> bool:
        """Whether only the word table can tell of the word."""
        return word not in self.count and (not self.whole or len(word) > LONG)

    def most(self, word: str) -> float:
        """An upper bound of the word's count."""
        n = self.count.get(word)
        return n if n is not None else math.inf if len(word) > LONG else self.least


def _alpha(w: str) -> bool:
    return bool(w) and all(unicodedata.category(c)[0] in "LM" or c in "'’@" or c in "01569" for c in w)


def noise_of(text: str, head: Head, fine: dict[str, tuple[str, int, bool]]) -> list[tuple[int, str, str, str, str, str]]:
    """(line_no, noise, state, from, to, other) of a text; state is 'sure', or what is open: 'joined', with the parts at a line end, or 'line', with the line and the bounds of its tokens; other names the words that the word table must tell."""
    lines = text.split("\n")
    out: list[tuple[int, str, str, str, str, str]] = []
    pages = page_lines(lines)
    for i, kind in pages.items():
        out.append((i, kind, "sure", "", "", ""))
    body = [i for i, x in enumerate(lines) if i not in pages and x.strip()]
    follows = dict(zip(body, body[1:]))
    skip_first: set[int] = set()
    for i in body:
        toks = lines[i].split()
        last = toks[-1]
        end = len(toks)
        if last[-1] in HYPHENS and len(last) > 1 and i in follows and last[-2] not in HYPHENS:
            nxt = lines[follows[i]].split()[0]
            # a blank line between would part paragraphs, but not where a page ended
            gap = any(not lines[j].strip() for j in range(i + 1, follows[i])) and not any(j in pages for j in range(i + 1, follows[i]))
            a, b = bare(last[:-1]), bare(nxt)
            if a and b and not gap and a[-1].isalpha() | (unicodedata.category(a[-1])[0] == "M") and (b[0].isalpha()):
                end -= 1
                skip_first.add(follows[i])
                asked = [] if last[-1] in "¬\xad" else _asked_at_end(a, b, head)
                if asked:
                    out.append((i, "hyphen", "joined", last, nxt, " ".join(asked)))
                elif last[-1] in "¬\xad" or _broken(a, b, head.count):
                    out.append((i, "hyphen", "sure", last, nxt, ""))
        begin = 1 if i in skip_first else 0
        # of a head without a gap, two words of half the length can't join to one beyond it
        asked = [] if head.whole and max(map(len, toks)) * 2 <= LONG else _asked_within(toks, begin, end, lines[i], head, fine)
        if asked:
            out.append((i, "", "line", lines[i], f"{begin} {end}", " ".join(asked)))
        else:
            out += [(i, noise, "sure", x, y, "") for noise, x, y in _within(toks, begin, end, lines[i], head.count, head.form, fine)]
    return out


def _joins(a: str, b: str) -> list[str]:
    """What parts at a line end may be once the hyphen goes: one word, or a compound's middle one."""
    return [a + b, *[a.split("-")[-1] + b.split("-")[0]] * ("-" in a or "-" in b)]


def _broken(a: str, b: str, count: Mapping[str, int]) -> bool:
    """Whether the hyphen between a and b is the line end's only."""
    n, m = max(count.get(x, 0) for x in _joins(a, b)), count.get(f"{a}-{b}", 0)
    return n >= m and (n > 0 or not compound_parts(a, b, count))


def _asked_at_end(a: str, b: str, head: Head) -> list[str]:
    """The words beyond the head that _broken depends on, if what the head knows of their counts leaves it open."""
    joins, dashed, count = _joins(a, b), f"{a}-{b}", head.count
    known, dash = max(count.get(x, 0) for x in joins), count.get(dashed, 0)
    if known and known >= head.most(dashed) or dash > max(head.most(x) for x in joins):
        return []
    return sorted({x for x in (*joins, dashed, a, b) if head.beyond(x)})


def _within(toks: list[str], begin: int, end: int, line: str, count: Mapping[str, int], form: Mapping[str, str], fine: dict[str, tuple[str, int, bool]]) -> list[tuple[str, str, str]]:
    """(noise, from, to) of a line's tokens from begin to end."""
    out, before, strange = [], None, []
    for k in range(begin, end):
        token = toks[k]
        word, kind, _ = fine.get(token) or _known(token, count, form, fine)
        if kind == NOTHING:
            before = None
            continue
        if before is not None and kind != MIXED and before + word in count and _may_part(toks[k - 1], token, line):
            if _outweighs(count[before + word], min(count.get(before, 0), count.get(word, 0)), count.get(f"{before}-{word}", 0)):
                out.append(("split", f"{toks[k - 1]} {token}", toks[k - 1] + token))
                if strange and strange[-1] == k - 1:
                    strange.pop()
                before = None
                continue
        if kind in (ODD, MIXED):
            strange.append(k)
        before = word if kind != MIXED else None
    return out + [("char", toks[k], form[bare(toks[k])]) for k in strange]


def _asked_within(toks: list[str], begin: int, end: int, line: str, head: Head, fine: dict[str, tuple[str, int, bool]]) -> list[str]:
    """The words beyond the head that _within depends on: those that may be misread, and of pairs that may be one word, unless the head's bounds decide."""
    count, asked, before = head.count, set(), None
    for k in range(begin, end):
        word, kind, unknown = fine.get(toks[k]) or _known(toks[k], count, head.form, fine)
        if unknown and head.beyond(word):
            asked.add(word)
        if before is not None and kind in (PLAIN, ODD):
            joined, dashed = before + word, f"{before}-{word}"
            n, dash = count.get(joined, 0), count.get(dashed, 0)
            part = min(count.get(before, 0), count.get(word, 0))
            may = _outweighs(head.most(joined), part, dash)
            if may and not _outweighs(n, min(head.most(before), head.most(word)), head.most(dashed)) and _may_part(toks[k - 1], toks[k], line):
                asked |= {z for z in (joined, before, word, dashed) if head.beyond(z)}
        before = word if kind in (PLAIN, ODD) else None
    return sorted(asked)


def compound_parts(a: str, b: str, count: Mapping[str, int]) -> bool:
    """Whether two known words stand on either side of a hyphen, whose joined form nobody knows: a compound."""
    return count.get(a, 0) >= 3 and count.get(b, 0) >= 3 and len(a) > 2 and len(b) > 2


NOTHING, PLAIN, ODD, MIXED = range(4)


def _known(token: str, count: Mapping[str, int], form: Mapping[str, str], memo: dict[str, tuple[str, int, bool]]) -> tuple[str, int, bool]:
    """A token's word, what it is (no word, a plain one, one that is misread, or a misread one that is no part of a parted word), and whether the counts don't have it, so that its form is open."""
    w = bare(token)
    unknown = False
    if not w or not any(unicodedata.category(c)[0] == "L" for c in w):
        kind = NOTHING
    else:
        unknown = len(w) >= 3 and "/" not in w and w not in count
        kind = (ODD if w in form else PLAIN) if _alpha(w) else (MIXED if w in form else NOTHING)
    if len(memo) > 500_000:
        memo.clear()
    memo[token] = (w, kind, unknown)
    return w, kind, unknown


def _may_part(a: str, b: str, line: str) -> bool:
    """Whether tokens a and b look as if one word had a stray space."""
    if a.rstrip(_KEEP) != a or b.lstrip(_KEEP) != b or f"{a} {b}" not in line:
        return False
    return b[0].islower() or a.isupper() and b.isupper() or unicodedata.category(b[0]) in ("Lo", "Mc", "Mn")


def _outweighs(n: float, part: float, dashed: float) -> bool:
    """Whether a joined form's count tells against its rarer part and its form with a hyphen."""
    return n >= max(3, 5 * part) and n > 2 * dashed


NOISE = "line_no int, noise string, state string, `from` string, `to` string, other string"


def _find(sent: object):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, fine = sent.value, {}
        names = ["line_no", "noise", "state", "from", "to", "other"]
        kinds = [pa.int32(), *[pa.string()] * 5]
        for batch in batches:
            rows, owner = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                own = noise_of(t, head, fine)
                rows += own
                owner += [i] * len(own)
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["key", *names])

    return go


def noise(records: DataFrame, key: str, text: str, head: int = 200_000, ratio: int = 25) -> DataFrame:
    """(key, line_no, noise, from, to): every noise of every line, and what it should read; each once.

    Null keys and null texts give nothing. A record that comes again gives its lines once.
    """
    spark = records.sparkSession
    rows = records.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"))
    table = written(word_table(rows), "words")
    size = F.length("word")
    top = table.where(size <= LONG).orderBy(F.desc("n"), "word").limit(head + 1).toArrow().to_pylist()
    long = not table.where(size > LONG).isEmpty()
    whole = len(top) <= head
    sent = spark.sparkContext.broadcast(Head([(r["word"], r["n"], r["form"], r["form_n"]) for r in top[:head]], ratio, whole))
    schema = T.StructType([T.StructField("key", records.schema[key].dataType), *T._parse_datatype_string(NOISE).fields])
    found = rows.mapInArrow(_find(sent), schema)
    if long or not whole:
        found = settled(written(found, "noise"), table, sent)
    else:
        found = found.drop("other", "state")
    return found.distinct().withColumnRenamed("key", key)


def _decide(sent: object):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = sent.value
        for batch in batches:
            rows = []
            for case, state, x, y, told in zip(*(batch.column(i).to_pylist() for i in range(5))):
                told = told or []
                count = ChainMap({r["word"]: r["n"] for r in told}, head.count)
                if state == "joined":
                    if _broken(bare(x[:-1]), bare(y), count):
                        rows.append((case, "hyphen", x, y))
                    continue
                form = ChainMap({r["word"]: r["form"] for r in told if misread(r["word"], r["n"], r["form"], r["form_n"], head.ratio)}, head.form)
                begin, end = map(int, y.split())
                rows += [(case, *found) for found in _within(x.split(), begin, end, x, count, form, {})]
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["case", "noise", "from", "to"])

    return go


def settled(found: DataFrame, table: DataFrame, sent: object) -> DataFrame:
    """Open cases decided by the rules of noise_of: the words that they name, rare ones, are joined to them; equal cases are one."""
    sure = found.where("state = 'sure'").drop("state", "other")
    left = found.where("state <> 'sure'").withColumn("case", F.sha2(F.concat_ws("\n", "state", "from", "to"), 256))
    cases = left.groupBy("case").agg(*[F.any_value(c).alias(c) for c in ("state", "from", "to", "other")])
    named = cases.select("case", F.explode(F.split("other", " ")).alias("word")).join(table, "word")
    told = named.groupBy("case").agg(F.collect_list(F.struct("word", "n", "form", "form_n")).alias("told"))
    decided = cases.join(told, "case", "left").select("case", "state", "from", "to", "told").mapInArrow(_decide(sent), "case string, noise string, `from` string, `to` string")
    return sure.unionByName(left.select("key", "line_no", "case").join(decided, "case").drop("case"))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for line, fixes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            for f in fixes or []:
                a, b = f["from"], f["to"]
                if f["noise"] == "char":
                    w = bare(a)
                    core = a[a.lower().find(w) : a.lower().find(w) + len(w)]
                    b = a.replace(core, b.upper() if core.isupper() and len(core) > 1 else b.capitalize() if core[:1].isupper() else b, 1)
                line = line.replace(a, b, 1)
            out.append(line)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), batch.column(4)], ["key", "line_no", "line", "hyphen"])


def repaired(records: DataFrame, key: str, text: str, head: int = 200_000, ratio: int = 25) -> DataFrame:
    """(key, paragraph_no, text): continuous paragraphs without headers, page marks and the other noise.

    Lines are numbered and joined by SQL windows: a line that ends in a broken word, or in a compound's own hyphen, is joined to the next one
    without a space. Blank lines part paragraphs, unless they stand at a page's end in the middle of a sentence. A record with several texts keeps the longest.
    """
    own = noise(records, key, text, head, ratio).withColumnRenamed(key, "key")
    rows = records.where(F.col(key).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max_by(F.col(text), F.struct(F.length(text), F.col(text))).alias("text"))
    lines = rows.select("key", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    by_line = own.groupBy("key", "line_no").agg(
        F.max(F.col("noise").isin("header", "page_number")).alias("drop"),
        F.max(F.col("noise") == "hyphen").alias("hyphen"),
        F.array_sort(F.collect_list(F.when(F.col("noise").isin("char", "split"), F.struct("from", "noise", "to")))).alias("fixes"),
    )
    joined = lines.join(by_line, ["key", "line_no"], "left").where(~F.coalesce("drop", F.lit(False)))
    schema = T.StructType([T.StructField("key", records.schema[key].dataType), T.StructField("line_no", T.IntegerType()), T.StructField("line", T.StringType()), T.StructField("hyphen", T.BooleanType())])
    fixed = joined.select("key", "line_no", "line", "fixes", F.coalesce("hyphen", F.lit(False)).alias("hyphen")).mapInArrow(_apply, schema)
    order = Window.partitionBy("key").orderBy("line_no")
    blank = F.trim("line") == ""
    flow = fixed.withColumn("paragraph", F.sum(F.when(blank, 1).otherwise(0)).over(order)).where(~blank)
    flow = flow.withColumn("paragraph_no", (F.dense_rank().over(Window.partitionBy("key").orderBy("paragraph")) - 1).cast("int"))
    piece = F.when(F.col("hyphen"), F.regexp_replace(F.rtrim("line"), f"[{HYPHENS}]$", "")).when(F.rtrim("line").rlike(r"\p{L}[-\x{2010}\x{2011}]$"), F.trim("line")).otherwise(F.concat(F.trim("line"), F.lit(" ")))
    out = flow.groupBy("key", "paragraph_no").agg(F.array_sort(F.collect_list(F.struct("line_no", piece.alias("piece")))).alias("p"))
    return out.select(F.col("key").alias(key), "paragraph_no", F.trim(F.array_join(F.transform("p", lambda x: x["piece"]), "")).alias("text"))
