"""Per-document text quality statistics, and the kind of text they point to.

Each text becomes one distribution over classes of tokens: function words of each language, other words, words that end a
sentence or a clause, figures, list marks, garbled or repeated tokens, and breaks between fragments (a line or an item that
ends without ending a sentence while the next one starts anew). The Jensen-Shannon divergence to the profiles below says
which structure it is nearest to: the prose of one of the languages, a list, a table or junk. Basic counts come with it.

Everything is counted on flat arrays of code points; Python looks only at the distinct tokens of a block.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm import flat

# Frequent function words of each language.
FUNCTION_WORDS = {
    "en": "the of and to in is for that on by with as it be are was at from this or an which must may not has have a if than when before after under should its will who were been only does shall",
    "hi": "को का की के है में से पर और हो ने तो भी यदि लिए होगा चाहिए करना ki ke ko mein hai ka se par aur hona chahiye karna hoga ho",
    "mr": "आणि च्या ला ने आहे पाहिजे करून द्यावे नंतर प्रमाणे करणे यांनी हे जर केले करावे",
    "bn": "ও এবং করতে হবে থেকে জন্য এর না হয় করা উচিত দিতে পরে সময় আগে",
    "ta": "மற்றும் வேண்டும் ஒரு என்று செய்ய பிறகு போது மேலும் இருந்தால் முன்",
    "gu": "અને છે માટે ને ની નો જોઈએ કરવું પછી પહેલાં જરૂરી આપવું થી",
    "fr": "le la les de des du et un une en dans pour que qui doit est à au par ne pas sans après avant si sur l' d'",
    "de": "der die das und den dem des ein eine einer ist nach bei von zu muss im in mit wenn vor für nicht auf ohne während",
}
LANGS = list(FUNCTION_WORDS)
CLASSES = [f"f_{x}" for x in LANGS] + ["word", "end", "clause", "figure", "mark", "garbled", "break"]
_F = {w: i for i, x in enumerate(LANGS) for w in FUNCTION_WORDS[x].split()}
WORD, END, CLAUSE, FIGURE, MARK, GARBLED, BREAK = range(len(LANGS), len(LANGS) + 7)

_FIGURE = re.compile(r"[(\[]?[₹$€£]?[+-]?\d[\d.,:/-]*%?[)\]]?|[-–—]+|\d+(?:st|nd|rd|th)")
_MARK = re.compile(r"[-*•‣◦▪–·●○■□☐☑✓►➢]|\(?(?:\d{1,3}|[A-Za-z]|[ivxlc]{1,8})[.)]|\[[ xX]?\]|[xX]\]|\[|\]")
_WORD = re.compile(r"[\"'“”‘’(\[<]*[^\W\d_]+(?:[-'’./&][^\W\d_]+)*['’]?[\])\"'“”’>]*")
_MARKUP = re.compile(r"[<>{}\\^~`|=]|&#?\w|\ufffd|[\u25a0\u25a1]{2}|^/\w+$")
_MAIL = re.compile(r"^<?[^<>{}]+@[^<>{}]+>?[.,;]?$")
_SHORT = {"mr", "ms", "dr", "st", "rs", "sl", "ph", "nr", "km", "kg", "cl", "vs"}
_END = re.compile(r"[.!?।॥][\"'”’)\]]*$")
_ABBREVIATION = {"rs.", "no.", "sl.", "mr.", "mrs.", "ms.", "dr.", "smt.", "shri.", "kum.", "dept.", "art.", "sec.", "para.", "cl.", "vs.", "e.g.", "i.e.", "p.a.", "ph.", "d.o.b.", "acct.", "m/s."}


def token_class(token: str) -> int:
    """Of a token without white space."""
    low = token.lower()
    if low in _F:
        return _F[low]
    if _MARKUP.search(token) and not _MAIL.search(token):
        return GARBLED
    if _MARK.fullmatch(token):
        return MARK
    if _FIGURE.fullmatch(token):
        return FIGURE
    bare = token.strip("\"'“”‘’()[]<>.,;:!?।॥")
    if not bare:
        return CLAUSE if token.strip(".") else GARBLED
    letters = sum(unicodedata.category(c)[0] in "LM" for c in bare)
    inner = _WORD.fullmatch(bare) or (letters == len(bare) and len(bare) < 30)
    if not inner and letters and len(bare) < 40:
        parts = re.split(r"[-'’./@&+_–]", bare)
        # dates, codes, mail addresses: parts that are words or figures each
        inner = len(parts) <= 5 and all(p == "" or p.isdigit() or sum(unicodedata.category(c)[0] in "LM" for c in p) == len(p) or re.fullmatch(r"[A-Za-z]{1,12}\d{1,6}|\d{1,4}[A-Za-z]{1,2}|₹\d+", p) for p in parts) and (letters * 2 >= len(bare) or not re.search(r"[^\w./-]", bare))
    if not inner:
        if not letters and sum(c.isdigit() for c in bare) * 2 >= len(bare):
            return FIGURE
        return GARBLED
    # mixed case inside, or a Latin word without vowels: not a word that is read
    if bare.isascii() and bare.isalpha() and len(bare) > 3:
        if (not bare.islower() and not bare.isupper() and not bare[1:].islower()) or not re.search(r"[aeiouyAEIOUY]", bare) and not bare.isupper():
            return GARBLED
    if len(bare) > 40 or len(bare) == 1 and letters and token == bare and low not in "aiyàoएওઆஓ":
        return GARBLED
    if len(bare) == 2 and bare.isascii() and bare[0].isupper() and bare[1].islower() and not re.search(r"[aeiouyAEIOUY]", bare) and low not in _SHORT:
        return GARBLED
    if _END.search(token) and low not in _ABBREVIATION:
        return END
    stem = low.strip("\"'“”‘’()[]<>.,;:!?।॥")
    if stem in _F:
        return _F[stem]
    return CLAUSE if token[-1] in ",;:" else WORD


def _profile(**share: float) -> np.ndarray:
    p = np.array([share.get(c, 0.0) for c in CLASSES])
    return p / p.sum()


# The structural profiles, as shares of the classes; prose has one for each language.
_PROSE = dict(end=0.065, clause=0.05, figure=0.045, mark=0.005, garbled=0.004, **{"break": 0.004})
PROFILES: list[tuple[str, np.ndarray]] = [
    ("prose", _profile(f_en=0.36, word=0.46, **_PROSE)),
    ("prose", _profile(f_hi=0.34, word=0.48, **_PROSE)),
    ("prose", _profile(f_mr=0.10, word=0.70, **_PROSE)),
    ("prose", _profile(f_bn=0.14, word=0.66, **_PROSE)),
    ("prose", _profile(f_ta=0.16, word=0.64, **_PROSE)),
    ("prose", _profile(f_gu=0.12, word=0.68, **_PROSE)),
    ("prose", _profile(f_fr=0.38, word=0.46, **_PROSE)),
    ("prose", _profile(f_de=0.32, word=0.52, **_PROSE)),
    ("list", _profile(f_en=0.24, word=0.46, end=0.004, clause=0.03, figure=0.03, mark=0.12, **{"break": 0.17})),
    ("list", _profile(f_en=0.24, word=0.50, end=0.004, clause=0.02, figure=0.03, mark=0.01, **{"break": 0.22})),
    ("list", _profile(f_en=0.24, word=0.38, end=0.004, clause=0.17, figure=0.03, mark=0.15, **{"break": 0.03})),
    ("list", _profile(f_hi=0.10, word=0.60, end=0.004, clause=0.03, figure=0.03, mark=0.12, **{"break": 0.17})),
    ("table", _profile(word=0.22, figure=0.62, mark=0.03, clause=0.02, **{"break": 0.10})),
    ("table", _profile(f_en=0.10, word=0.25, figure=0.52, mark=0.02, clause=0.02, **{"break": 0.08})),
    ("table", _profile(word=0.14, figure=0.80, mark=0.02, clause=0.02)),
    ("junk", _profile(garbled=0.9, word=0.08, figure=0.02)),
    ("junk", _profile(garbled=0.55, word=0.2, figure=0.15, mark=0.05, clause=0.05)),
    ("junk", _profile(garbled=0.55, word=0.08, figure=0.25, **{"break": 0.12})),
]
_KINDS = [k for k, _ in PROFILES]
_Q = np.stack([q for _, q in PROFILES])


def divergence(p: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits of distributions (rows of p) to every profile."""
    out = np.zeros((len(p), len(_Q)))

    def entropy(x: np.ndarray) -> np.ndarray:
        return -(x * np.log2(np.where(x > 0, x, 1.0))).sum(axis=-1)

    hp, hq = entropy(p), entropy(_Q)
    for j in range(len(_Q)):
        out[:, j] = entropy((p + _Q[j]) / 2) - (hp + hq[j]) / 2
    return out


_CACHE: dict[int, int] = {}


def _kind(c: str) -> int:
    """1 letter, 2 mark, 3 digit, 4 white, 5 sentence end, 0 other."""
    if c in flat.WHITE:
        return 4
    if c in ".!?।॥":
        return 5
    g = unicodedata.category(c)
    return 1 if g[0] == "L" else 2 if g[0] == "M" else 3 if g == "Nd" else 0


_KINDS_OF = flat.Classes(_kind)
#: Signs that a new line or item begins with: capitals, letters without case, digits, brackets and bullets.
_STARTS = flat.Classes(lambda c: unicodedata.category(c) in ("Lu", "Lt", "Nd", "Lo") or c in "([*-•<|")


#: The columns of stats_of(), one row a text.
STATS = ["n_chars", "n_words", "mean_word_length", "symbol_ratio", "digit_ratio", "n_lines", "terminated_lines", "common_words", "distinct_words", "divergence"]


def stats_of(texts: pa.Array) -> tuple[dict[str, np.ndarray], list[str]]:
    """Statistics and the nearest profile's kind of every text (null and blank texts have kind 'empty')."""
    parts: list[dict[str, np.ndarray]] = []
    names: list[str] = []
    for lo, hi, cps, bounds in flat.blocks(texts):
        n = hi - lo
        kind = _KINDS_OF(cps)
        row_of = np.repeat(np.arange(n), np.diff(bounds))

        def per_row(mask: np.ndarray) -> np.ndarray:
            return np.bincount(row_of[mask], minlength=n)

        size = np.diff(bounds)
        space = kind == 4
        letters, digits = per_row((kind == 1) | (kind == 2)), per_row(kind == 3)
        others = per_row((kind == 0) | (kind == 5))
        solid = size - per_row(space)
        # words: stretches without white space
        ws, we = flat.spans(~space, bounds)
        wrow = np.searchsorted(bounds, ws, "right") - 1
        n_words = np.bincount(wrow, minlength=n)
        # tokens: also cut at separators of tables
        cut = space | (cps == ord("|")) | (cps == ord(";")) | (cps == ord("\t"))
        comma = np.flatnonzero(cps == ord(","))
        if len(comma):
            nxt = kind[np.minimum(comma + 1, len(kind) - 1)]
            cut = cut.copy()
            cut[comma[(nxt != 4) & (comma + 1 < len(cps))]] = True
        ts, te = flat.spans(~cut, bounds)
        trow = np.searchsorted(bounds, ts, "right") - 1
        sums = flat.prefix(cps)
        h = flat.gram(sums, ts, te)
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        cls = np.zeros(len(uniq), np.int64)
        if len(_CACHE) > 2_000_000:
            _CACHE.clear()
        joined = None
        for i, x in enumerate(uniq.tolist()):
            c = _CACHE.get(x)
            if c is None:
                if joined is None:
                    joined = cps.tobytes().decode("utf-32-le")
                c = _CACHE[x] = token_class(joined[ts[first[i]] : te[first[i]]])
            cls[i] = c
        tc = cls[inverse] if len(uniq) else np.zeros(0, np.int64)
        # a word that also came among the four before it says nothing: repetition
        again = np.zeros(len(h), bool)
        for back in (1, 2, 3, 4):
            if len(h) > back:
                again[back:] |= (h[back:] == h[:-back]) & (trow[back:] == trow[:-back])
        tc = np.where(again & (tc == WORD), GARBLED, tc)
        # lines: ends of non-blank lines, and whether the line ends a sentence and the next one starts anew
        ls, le = flat.spans(cps != 10, bounds)
        lrow = np.searchsorted(bounds, ls, "right") - 1
        where_solid = np.flatnonzero(~space)
        i0, i1 = np.searchsorted(where_solid, ls), np.searchsorted(where_solid, le)
        some = i1 > i0
        lrow, first_at, last_at = lrow[some], where_solid[i0[some]], where_solid[i1[some] - 1]
        closing = np.isin(cps[last_at], [ord(c) for c in "\"'”’)]"])
        before = np.maximum(last_at - 1, 0)
        ends = (kind[last_at] == 5) | (closing & (kind[before] == 5)) | (cps[last_at] == ord(":"))
        n_lines = np.bincount(lrow, minlength=n)
        terminated = np.bincount(lrow[ends], minlength=n)
        fresh = np.zeros(len(lrow), bool)
        if len(lrow) > 1:
            start_new = _STARTS(cps[first_at[1:]]) > 0
            short = (last_at[:-1] - first_at[:-1]) < 60
            # a wrapped line ends near the margin of its text: the longest line within a fifth
            width = np.zeros(n, np.int64)
            np.maximum.at(width, lrow, last_at - first_at + 1)
            full = (last_at[:-1] - first_at[:-1] + 1) >= 0.8 * width[lrow[:-1]]
            caps = kind[first_at[1:]] != 1
            fresh[:-1] = (lrow[1:] == lrow[:-1]) & ~ends[:-1] & start_new & (short | ~full | caps) & ~(full & ~caps & (width[lrow[:-1]] >= 40))
        breaks = np.bincount(lrow[fresh], minlength=n)
        counts = np.bincount(trow * len(CLASSES) + tc, minlength=n * len(CLASSES)).reshape(n, len(CLASSES)).astype(float)
        counts[:, BREAK] += breaks
        total = counts.sum(axis=1)
        p = counts / np.maximum(total, 1)[:, None]
        d = divergence(p)
        near = np.argmin(d, axis=1)
        distinct = np.zeros(n, np.int64)
        if len(h):
            _, one = np.unique(h + trow.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)
            distinct = np.bincount(trow[one], minlength=n)
        parts.append(
            {
                "n_chars": size,
                "n_words": n_words,
                "mean_word_length": solid / np.maximum(n_words, 1),
                "symbol_ratio": others / np.maximum(solid, 1),
                "digit_ratio": digits / np.maximum(solid, 1),
                "n_lines": n_lines,
                "terminated_lines": terminated / np.maximum(n_lines, 1),
                "common_words": counts[:, : len(LANGS)].sum(axis=1) / np.maximum(total, 1),
                "distinct_words": distinct / np.maximum(np.bincount(trow, minlength=n), 1),
                "divergence": d[np.arange(n), near],
                "shares": p,
            }
        )
        names += [_KINDS[j] if t else "empty" for j, t in zip(near, total)]
    keys = [*STATS, "shares"]
    return {k: np.concatenate([x[k] for x in parts]) if parts else np.zeros(0) for k in keys}, names


def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got, kinds = stats_of(batch.column(1))
        whole = {"n_chars", "n_words", "n_lines"}
        columns = [pa.array(got[k].astype(np.int64) if k in whole else np.round(got[k].astype(np.float64), 6)) for k in STATS]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(kinds, pa.string())], ["key", *STATS, "kind"])


def text_stats(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, statistics, kind) of every row; a null or blank text has zeros and the kind 'empty'."""
    from pyspark.sql import types as T

    whole = {"n_chars", "n_words", "n_lines"}
    fields = [T.StructField("key", records.schema[key].dataType)] + [T.StructField(k, T.LongType() if k in whole else T.DoubleType()) for k in STATS]
    schema = T.StructType([*fields, T.StructField("kind", T.StringType())])
    return records.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(_map, schema).withColumnRenamed("key", key)


def not_prose(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, kind) of the texts that are lists, tables or junk, each once; null keys and null or blank texts give nothing."""
    rows = records.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    return text_stats(rows, key, text).where(F.col("kind").isin("list", "table", "junk")).select(key, "kind").distinct()
