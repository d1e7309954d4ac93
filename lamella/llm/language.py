"""Languages of documents and of the paragraphs in them.

Segmentation-marginalised unigrams: the pieces of a fixed public vocabulary have a probability under each language, and a
word's probability is the sum, by a forward pass, over all ways of cutting it into pieces. Pieces don't cross words, so
a paragraph's log-probability is the sum of its words', and each distinct word is scored once a worker.

The piece probabilities are fitted by expectation maximisation on a bounded sample of labelled rows (at most
`rows_per_label` of each label, in order of a hash of their text, texts of fewer than `longest` code points, and at most
`words_per_label` distinct words, the most frequent). Labels may be wrong: they only begin the fit, and `rounds` times each
row goes to the language that explains it best before all are fitted again.

Hindi is fitted twice, in Devanagari and in Latin letters; both are "hi". Rows in Latin letters that are labelled Hindi may be
English ones with a wrong label, and the other way round, so the model of Hindi in Latin letters begins with the rows that
the models of the other languages in Latin letters explain far worse, by the letter, than they do the rows of these languages.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm import flat
from lamella.llm.encoding import TOKENIZERS, ranks, vocabulary_file

LANGS = ["en", "hi", "mr", "bn", "ta", "gu", "fr", "de"]
# Codes and names of the languages.
NOTATIONS = {
    "en": "en eng english", "hi": "hi hin hindi हिन्दी हिंदी", "mr": "mr mar marathi मराठी", "bn": "bn ben bengali bangla বাংলা",
    "ta": "ta tam tamil தமிழ்", "gu": "gu guj gujarati ગુજરાતી", "fr": "fr fra fre french français", "de": "de deu ger german deutsch",
}
_CODE = {n: k for k, v in NOTATIONS.items() for n in v.split()}
#: Labels that name no language at all.
NONE = {"", "unknown", "und", "n/a", "na", "none", "null", "undetermined", "zxx", "mul", "mis", "other", "?", "-"}

MODELS = [*LANGS, "hi"]  # the last one is Hindi in Latin letters
ROMAN = len(LANGS)
_BLANK = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_SCALE = 40.0


def code_of(label: str | None) -> str | None:
    """Of a label in any notation: its language's code, '' where it names none, the label itself where it names another one."""
    low = (label or "").strip().lower()
    if low in NONE:
        return ""
    return _CODE.get(low) or _CODE.get(re.split(r"[-_ (]", low)[0]) or low


def code_column(label: str) -> F.Column:
    """code_of() as a column."""
    low = F.lower(F.trim(F.coalesce(F.col(label), F.lit(""))))
    head = F.element_at(F.split(low, r"[-_ (]"), 1)
    names = F.create_map(*[F.lit(x) for kv in sorted(_CODE.items()) for x in kv])
    return F.when(low.isin(*sorted(NONE)), "").otherwise(F.coalesce(F.try_element_at(names, low), F.try_element_at(names, head), low))


_LETTERS = flat.Classes(lambda c: unicodedata.category(c)[0] in "LM" or c in "'’‌‍")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> frozenset[str]:
    """The pieces of a public byte-level vocabulary that are whole characters of letters, without their leading space, in lower case."""
    out = set()
    for piece in ranks(path):
        try:
            text = piece.decode("utf-8").strip().lower()
        except UnicodeDecodeError:
            continue
        if text and len(text) <= 16 and all(unicodedata.category(c)[0] in "LM" for c in text):
            out.add(text)
    return frozenset(out)


def words_of(text: str) -> list[str]:
    """Runs of letters and their marks, in lower case."""
    return re.findall(r"[^\W\d_](?:[^\W\d_]|[̀-ͯऀ-෿‌‍'’])*", text.lower())


def cuts(word: str, pieces: frozenset[str], longest: int = 16) -> list[tuple[int, int, str]]:
    """All (start, end, piece) of a word; single characters are always pieces."""
    n = len(word)
    return [(i, j, word[i:j]) for i in range(n) for j in range(i + 1, min(n, i + longest) + 1) if j == i + 1 or word[i:j] in pieces]


def fit(words: Counter, pieces: frozenset[str], rounds: int = 3) -> dict[str, float]:
    """Piece probabilities of one language by expectation maximisation over all segmentations of its words."""
    lattice = [(n, len(w), cuts(w, pieces)) for w, n in words.items() if 0 < len(w) <= 40]
    # to begin with, a piece counts by how often it stands in a word, longer ones more
    start: Counter = Counter()
    for n, _, arcs in lattice:
        for i, j, p in arcs:
            start[p] += n * (j - i) ** 2
    total = sum(start.values()) or 1
    prob = {p: c / total for p, c in start.items()}
    for _ in range(rounds):
        count: Counter = Counter()
        for n, size, arcs in lattice:
            alpha, beta = [0.0] * (size + 1), [0.0] * (size + 1)
            alpha[0] = beta[size] = 1.0
            for i, j, p in arcs:  # by start: alpha[i] is done when its arcs come
                alpha[j] += alpha[i] * prob[p]
            for i, j, p in reversed(arcs):
                beta[i] += prob[p] * beta[j]
            whole = alpha[size]
            if whole <= 0:
                continue
            for i, j, p in arcs:
                count[p] += n * alpha[i] * prob[p] * beta[j] / whole
        total = sum(count.values()) or 1
        prob = {p: c / total for p, c in count.items() if c / total > 1e-9}
        for p in start:
            if len(p) == 1:
                prob.setdefault(p, 1e-9)
        for _, _, arcs in lattice:
            for _, _, p in arcs:
                prob.setdefault(p, 0.0)
    return {p: c for p, c in prob.items() if c > 0}


class Models:
    """Piece probabilities of all languages, as rows of one matrix; picklable."""

    def __init__(self, tables: list[dict[str, float]]):
        names = sorted({p for t in tables for p in t})
        self.index = {p: i for i, p in enumerate(names)}
        floor = 1e-8
        self.matrix = np.full((len(names) + 1, len(tables)), floor)
        for k, t in enumerate(tables):
            for p, c in t.items():
                self.matrix[self.index[p], k] = max(c, floor)
        self.longest = max((len(p) for p in names), default=1)

    def score(self, word: str) -> np.ndarray:
        """Log-probability of a word under each model (up to the same constant): a forward pass over all segmentations.

        An unknown character has the floor's probability, a piece unknown to one model the floor's in that one. Each
        step is scaled by the same factor a character, which shifts all models alike, and long words are rescaled.
        """
        n = len(word)
        alpha = [None] * (n + 1)
        alpha[0] = np.ones(self.matrix.shape[1])
        shift = 0.0
        last = len(self.matrix) - 1
        for j in range(1, n + 1):
            total = np.zeros(self.matrix.shape[1])
            for i in range(max(0, j - self.longest), j):
                k = self.index.get(word[i:j], last if j == i + 1 else -1)
                if k >= 0:
                    total = total + alpha[i] * self.matrix[k] * _SCALE ** (j - i)
            alpha[j] = total
            if j % 16 == 0:
                m = total.max()
                for i in range(max(0, j - self.longest), j + 1):
                    alpha[i] = alpha[i] / m
                shift += math.log(m)
        return np.log(np.maximum(alpha[n], 1e-300)) + shift


def latin(words: Counter) -> bool:
    return sum(n for w, n in words.items() if w[0] < "ɐ") * 2 > sum(words.values())


def train(spark: SparkSession, labelled: DataFrame, text: str, label: str, tokenizer: str = "byte_bpe_multi_50k", tokenizers: str = TOKENIZERS, rows_per_label: int = 300, words_per_label: int = 2000, longest: int = 4000, rounds: int = 2) -> Models:
    """Models fitted on a bounded sample of labelled rows: at most rows_per_label of each of the labels' codes, of texts of fewer than `longest` code points."""
    pieces = vocabulary(vocabulary_file(tokenizer, tokenizers))
    from pyspark.sql import Window

    rows = labelled.where(F.col(text).isNotNull() & (F.length(text) < longest)).select(F.col(text).alias("text"), code_column(label).alias("code")).where(F.col("code").isin(*LANGS))
    roman = F.length(F.regexp_replace("text", r"[^A-Za-z]", "")) > F.length("text") / 2
    rows = rows.withColumn("kind", F.when((F.col("code") == "hi") & roman, "hi-Latn").otherwise(F.col("code"))).withColumn("h", F.xxhash64("text"))
    first = rows.withColumn("r", F.row_number().over(Window.partitionBy("kind").orderBy("h", "text"))).where(F.col("r") <= rows_per_label)
    sample = first.select("kind", "text").collect()
    bags = [(r.kind, Counter(w for w in words_of(r.text) if len(w) <= 40)) for r in sample]
    kinds = [*LANGS, "hi-Latn"]

    def fitted(own: list[tuple[str, Counter]]) -> Models:
        tables = []
        for k in kinds:
            total: Counter = Counter()
            for kind, bag in own:
                if kind == k:
                    total.update(bag)
            top = Counter(dict(sorted(total.items(), key=lambda x: (-x[1], x[0]))[:words_per_label]))
            tables.append(fit(top, pieces))
        return Models(tables)

    def scores(models: Models, own: list[tuple[str, Counter]]) -> np.ndarray:
        """By row and model."""
        cache: dict[str, np.ndarray] = {}
        out = np.zeros((len(own), len(kinds)))
        for i, (_, bag) in enumerate(own):
            for w, n in bag.items():
                if w not in cache:
                    cache[w] = models.score(w)
                out[i] += n * cache[w]
        return out

    roman_rows, others = [b for b in bags if b[0] == "hi-Latn"], [b for b in bags if b[0] != "hi-Latn"]
    own = begun(roman_rows, others, scores(fitted(others), roman_rows + others))
    for _ in range(rounds):
        best = np.argmax(scores(fitted(own), own), axis=1)
        own = [(kinds[k], bag) for k, (_, bag) in zip(best, own) if bag]
    return fitted(own)


LATIN = [LANGS.index(x) for x in ("en", "fr", "de")]


def begun(rows: list[tuple[str, Counter]], others: list[tuple[str, Counter]], scores: np.ndarray) -> list[tuple[str, Counter]]:
    """The others, and the rows, of Hindi in Latin letters, with the kinds that fitting begins with.

    Whatever its label, a text in Latin letters that no model of the languages written so explains as it does most of their rows
    begins Hindi in Latin letters: where more is lost by the letter than in the middle of those rows by six times the spread of
    their better half. Other rows that are labelled Hindi begin nothing. scores has the rows first.
    """
    every = rows + others
    letters = np.array([max(sum(len(w) * n for w, n in bag.items()), 1) for _, bag in every])
    worth = scores[:, LATIN].max(axis=1) / letters
    plain = np.array([kind in ("en", "fr", "de") and latin(bag) for kind, bag in every], bool)
    known = np.sort(worth[plain])
    if not len(known):
        return every
    middle = np.median(known)
    odd = worth < middle - 6 * (known[int(0.84 * (len(known) - 1))] - middle)
    out = []
    for i, (kind, bag) in enumerate(every):
        if odd[i] and (plain[i] or kind == "hi-Latn"):
            out.append(("hi-Latn", bag))
        elif kind != "hi-Latn":
            out.append((kind, bag))
    return out


def paragraphs(text: str) -> list[str]:
    """Parted by one or more blank lines; blank lines at the ends part nothing."""
    return [p for p in _BLANK.split(text.strip("\n") if text.strip() else "") if p.strip()]


_CACHE: dict[int, np.ndarray] = {}


def scored(models: Models, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scores, words, letters) of each text: log-probabilities under each model, counts of words and of letters."""
    scores, counts, letters = [], [], []
    low = pa.array([(t or "").lower() for t in texts.to_pylist()], pa.string())
    for lo, hi, cps, bounds in flat.blocks(low):
        n = hi - lo
        mask = _LETTERS(cps) > 0
        ws, we = flat.spans(mask, bounds)
        row = np.searchsorted(bounds, ws, "right") - 1
        h = flat.gram(flat.prefix(cps), ws, we)
        uniq, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        out = np.zeros((len(uniq), len(MODELS)))
        if len(_CACHE) > 1_000_000:
            _CACHE.clear()
        joined = None
        for i, x in enumerate(uniq.tolist()):
            v = _CACHE.get(x)
            if v is None:
                if joined is None:
                    joined = cps.tobytes().decode("utf-32-le")
                v = _CACHE[x] = models.score(joined[ws[first[i]] : we[first[i]]].strip("'’"))
            out[i] = v
        per = out[inverse] if len(uniq) else np.zeros((0, len(MODELS)))
        scores.append(np.stack([np.bincount(row, weights=per[:, k], minlength=n) for k in range(len(MODELS))], axis=1))
        counts.append(np.bincount(row, minlength=n))
        letters.append(np.bincount(row, weights=(we - ws), minlength=n))
    if not scores:
        return np.zeros((0, len(MODELS))), np.zeros(0), np.zeros(0)
    return np.concatenate(scores), np.concatenate(counts), np.concatenate(letters)


def by_language(scores: np.ndarray) -> np.ndarray:
    """Log-probabilities by language: of Hindi's two models the better one."""
    out = scores[:, : len(LANGS)].copy()
    if len(out):
        out[:, 1] = np.maximum(out[:, 1], scores[:, ROMAN])
    return out


def decide(scores: np.ndarray, words: np.ndarray, letters: np.ndarray, margin: float) -> tuple[int, list[int | None], list[float]]:
    """Main language of a text's paragraphs, and for each its language (None: can't be told) and confidence.

    A paragraph counts by its letters towards the language it is in; one whose best language is less than 6, or than
    `margin` a letter, above the main one counts as the main one.
    """
    own = by_language(scores)
    at = np.arange(len(own))
    best = np.argmax(own, axis=1)
    weight = np.bincount(best[words >= 1], weights=letters[words >= 1], minlength=len(LANGS))
    if weight.sum() == 0:
        return -1, [None] * len(own), [0.0] * len(own)
    main = int(np.argmax(weight))
    gap = own[at, best] - own[at, main]
    confidence = 1 / (1 + np.exp(-np.minimum(gap_to_next(scores, best), 50)))
    sure = (words >= 1) & ((best == main) | (gap >= 6) & (gap >= margin * letters))
    return main, [int(b) if s else None for b, s in zip(best, sure)], confidence.tolist()


def gap_to_next(scores: np.ndarray, best: np.ndarray) -> np.ndarray:
    """How far the best language's log-probability is above the next one's."""
    own = by_language(scores)
    at = np.arange(len(own))
    top = own[at, best].copy()
    own[at, best] = -np.inf
    return top - own.max(axis=1)


def _detect(sent: object, margin: float, fewest: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = sent.value
        for batch in batches:
            parts, owner = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                own = paragraphs(t or "")
                parts += own
                owner += [i] * len(own)
            scores, words, letters = scored(models, pa.array(parts, pa.string()))
            owner = np.array(owner, np.int64)
            edges = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            row, para, lang, conf = [], [], [], []
            for i in range(batch.num_rows):
                a, b = edges[i], edges[i + 1]
                if a == b:
                    continue
                main, own, sure = decide(scores[a:b], words[a:b], letters[a:b], margin)
                if main < 0:
                    continue
                whole = by_language(scores[a:b][[k is None or k == main for k in own]].sum(axis=0, keepdims=True))[0]
                rest = np.delete(whole, main)
                row.append(i)
                para.append(-1)
                lang.append(LANGS[main])
                conf.append(float(1 / (1 + np.exp(-np.clip((whole[main] - rest.max()) / max(1.0, math.sqrt(words[a:b].sum())), -50, 50)))))
                for j in range(b - a):
                    if own[j] is not None and own[j] != main and words[a + j] >= fewest:
                        row.append(i)
                        para.append(j)
                        lang.append(LANGS[own[j]])
                        conf.append(sure[j])
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(2).take(take), pa.array(para, pa.int32()), pa.array(lang, pa.string()), pa.array(np.round(np.array(conf, float), 6))], ["key", "label", "para_no", "lang", "confidence"]
            )

    return go


def detected(records: DataFrame, key: str, text: str, label: str, models: Models, margin: float = 0.02, fewest: int = 2) -> DataFrame:
    """(key, label, para_no, lang, confidence): para_no -1 is the record's main language, others its paragraphs in another one.

    Null keys, null texts and texts without a letter give nothing.
    """
    sent = records.sparkSession.sparkContext.broadcast(models)
    rows = records.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).alias("label"))
    schema = T.StructType([T.StructField("key", records.schema[key].dataType), T.StructField("label", T.StringType()), T.StructField("para_no", T.IntegerType()), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType())])
    return rows.mapInArrow(_detect(sent, margin, fewest), schema).withColumnRenamed("key", key)


def mislabelled(records: DataFrame, key: str, text: str, label: str, models: Models) -> DataFrame:
    """(key, para_no, lang): records whose label names no language or another one than the text's main one (-1), and foreign paragraphs; each once."""
    found = detected(records, key, text, label, models)
    return found.where((F.col("para_no") >= 0) | (code_column("label") != F.col("lang"))).select(key, "para_no", "lang").distinct()
