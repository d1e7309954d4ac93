"""Near-duplicate records with small edits.

DartMinHash (Christiani 2020): hashed darts are thrown into the weighted regions of a set's elements and the earliest
dart of each of k coordinates is kept. Two sets agree on a coordinate with the probability of their (weighted) Jaccard
similarity. Runs of coordinates are bands; records that agree on a band are candidates, and each candidate pair is
verified on its texts.

The elements of a text are its distinct runs of `run` words; words are stretches without white space, lower-cased.

Hot groups: texts that are equal are one class before anything is compared and a task signs a class once, so a group of
copies costs a row or so a task however large it is; the product is pairs of classes (class_pairs) and their members (classes),
and pairs of records are made of them only where a result asks for these. Bands with one class only are dropped by an
aggregation of two longs a band, combined before the shuffle, before any join. The classes of a band with more than `hot`,
such as a form filled in many ways, aren't all paired: only those are that have one of their rarest runs in common, which
two such sets must have (prefix filter).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.llm import flat
from lamella.llm.identity import identified, one_text_each
from lamella.session import written

_U = np.uint64


def darts(elements: np.ndarray, weights: np.ndarray, row: np.ndarray, n_rows: int, k: int) -> np.ndarray:
    """Signatures (n_rows x k, uint64) of weighted sets given as parallel arrays; row is the set of each element.

    The regions of an element are its units of weight, [0, 1), [1, 2), ...: in each, darts arrive by rank as a Poisson
    process with intensity t, at a place inside the unit; a dart counts where its place is below the weight. Only ranks
    below theta / total weight are thrown, which leaves about t * theta darts a set; where a coordinate got none, the
    set is thrown again with a larger theta. A set without elements keeps the largest value everywhere.
    """
    t = k * (np.log(k) + 2)
    none = _U(0xFFFFFFFFFFFFFFFF)
    out = np.full(n_rows * k, none)
    total = np.bincount(row, weights=weights, minlength=n_rows)
    theta = np.where(total > 0, 1.0, 0.0)
    todo = total > 0
    units = np.maximum(np.ceil(weights).astype(np.int64), 0)
    if len(units) and units.max() > 1:
        which = np.repeat(np.arange(len(units)), units)
        unit = np.arange(len(which)) - np.repeat(np.cumsum(units) - units, units)
    else:
        which, unit = np.flatnonzero(units > 0), np.zeros(int((units > 0).sum()), np.int64)
    seed = flat.mix(elements[which] + unit.astype(np.uint64) * _U(0xA24BAED4963EE407))
    part = weights[which] - unit
    while todo.any():
        limit = theta / np.maximum(total, 1e-300)
        own = np.flatnonzero(todo[row[which]])
        s, r, p = seed[own], row[which][own], part[own]
        rank = np.zeros(len(own))
        most = limit[r]
        for a in range(1, 10_000):
            h = flat.mix(s + _U(a * 0x9FB21C651E98DF25 & 0xFFFFFFFFFFFFFFFF))
            rank = rank - np.log(((h >> _U(11)).astype(np.float64) + 1.0) * 2.0**-53) / t
            keep = rank < most
            if not keep.any():
                break
            s, r, p, rank, most, h = s[keep], r[keep], p[keep], rank[keep], most[keep], h[keep]
            g = flat.mix(h + _U(0x632BE59BD9B4E019))
            at = ((g >> _U(32)) % _U(k)).astype(np.int64)
            value = (rank.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)) | (g & _U(0xFFFFFFFF))
            if (p < 1).any():
                inside = ((h & _U(0x7FF)).astype(np.float64) / 2048) < p
                at, value, rr = at[inside], value[inside], r[inside]
            else:
                rr = r
            np.minimum.at(out, rr * k + at, value)
        todo = todo & (out.reshape(n_rows, k) == none).any(axis=1)
        theta = np.where(todo, theta + 0.75, theta)
        out.reshape(n_rows, k)[todo] = none
    return out.reshape(n_rows, k)


def _words(cps: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = flat.spans(~flat.white(cps), bounds)
    return flat.gram(flat.prefix(cps), starts, ends), np.searchsorted(bounds, starts, "right") - 1


def band_rows(run: int, rows: int, bands: int):
    """An Arrow mapper: (class_id, text) to (band, class_id), `bands` rows for each text with a run of words; a class once a task."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            ids, first_at = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
            new = np.array([i not in seen for i in ids.tolist()], bool)
            ids, first_at = ids[new], first_at[new]
            seen.update(ids.tolist())
            texts = batch.column(1).take(pa.array(first_at)).to_pylist()
            for lo, hi, cps, bounds in flat.blocks(pa.array([(t or "").lower() for t in texts], pa.string())):
                words, row = _words(cps, bounds)
                grams, first = flat.runs_of_words(words, row, run)
                of = row[first]
                some, of = np.unique(of, return_inverse=True)
                if not len(some):
                    continue
                sig = darts(*_distinct(grams, of), len(some), rows * bands)
                key = np.zeros((len(some), bands), np.uint64)
                for j in range(rows):
                    key = flat.mix(key * _U(0xD1342543DE82EF95) + sig[:, j::rows])
                key = flat.mix(key + np.arange(bands, dtype=np.uint64)[None, :] * _U(0xA0761D6478BD642F))
                yield pa.RecordBatch.from_arrays([pa.array(flat.signed(key.reshape(-1))), pa.array(np.repeat(ids[lo:hi][some], bands))], ["band", "class_id"])

    return go


def _distinct(grams: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elements with weight 1, each once a row (rows stand together and in order)."""
    order = np.lexsort((grams, of))
    g, r = grams[order], of[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    g, r = g[first], r[first]
    return g, np.ones(len(g)), r


def jaccard(a: str, b: str, run: int) -> float:
    """Distinct runs of words in both by those in either; 0 where neither has one."""
    x, y = a.lower().split(), b.lower().split()
    s, t = ({tuple(w[i : i + run]) for i in range(len(w) - run + 1)} for w in (x, y))
    both = len(s & t)
    either = len(s) + len(t) - both
    return both / either if either else 0.0


def _verify(run: int, least: float):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            j = np.array([jaccard(x, y, run) for x, y in zip(a, b)])
            keep = pa.array(j >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(j[j >= least])], ["class_a", "class_b", "similarity"])

    return go


def classes(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id, text): records whose texts are equal share a class_id."""
    return identified(records, key, text).withColumnRenamed("text_id", "class_id")


def _texts(own: DataFrame, asked: DataFrame) -> DataFrame:
    """asked, (class_id, ...) each once, with the class's text."""
    return one_text_each(own.withColumnRenamed("class_id", "text_id"), asked.withColumnRenamed("class_id", "text_id")).withColumnRenamed("text_id", "class_id")


def _grams(run: int):
    """(class_id, text) to (class_id, gram, n): the distinct runs of words, by their hash, and their number."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, cps, bounds in flat.blocks(pa.array([t.lower() for t in batch.column(1).to_pylist()], pa.string())):
                words, row = _words(cps, bounds)
                grams, first = flat.runs_of_words(words, row, run)
                g, _, r = _distinct(grams, row[first])
                n = np.bincount(r, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo).take(pa.array(r)), pa.array(flat.signed(g)), pa.array(n[r].astype(np.int32))], ["class_id", "gram", "n"])

    return go


def hot_candidates(many: DataFrame, own: DataFrame, least: float, run: int) -> DataFrame:
    """(class_a, class_b) that can be alike, of the classes of the bands in `many` (band, class_id).

    Of two sets of n runs with a similarity of `least`, the first n - ceil(least * n) + 1 of either, rarest first, hold a
    shared one; and neither is smaller than `least` times the other.
    """
    texts = _texts(own, many.select("class_id").distinct()).select("class_id", "text")
    grams = written(texts.mapInArrow(_grams(run), "class_id bigint, gram bigint, n int"), "grams")
    common = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    own_order = Window.partitionBy("class_id").orderBy("df", "gram")
    # runs that no other class has are the rarest of all: they come off the prefix first
    shared = grams.join(common, "gram")
    alone = grams.groupBy("class_id").agg(F.first("n").alias("all")).join(shared.groupBy("class_id").agg(F.count("*").alias("kept")), "class_id").select("class_id", (F.col("all") - F.col("kept")).alias("alone"))
    rare = shared.join(alone, "class_id").withColumn("r", F.row_number().over(own_order) + F.col("alone")).where(F.col("r") <= F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1)
    a, b = (rare.select("gram", F.col("class_id").alias(f"class_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    close = F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b") - 1e-9
    return a.join(b, "gram").where((F.col("class_a") < F.col("class_b")) & close).select("class_a", "class_b").distinct()


def signed_bands(own: DataFrame, run: int = 5, rows: int = 4, bands: int = 24) -> DataFrame:
    """(band, class_id) of each class with a run of words; written once: the texts are signed once, and a lost executor costs no signature."""
    return written(own.select("class_id", "text").mapInArrow(band_rows(run, rows, bands), "band bigint, class_id bigint"), "bands")


def class_pairs(own: DataFrame, least: float = 0.8, run: int = 5, rows: int = 4, bands: int = 24, hot: int = 64) -> DataFrame:
    """(class_a, class_b, similarity): pairs of classes of different texts with a similarity of at least `least`.

    A pair exactly at 0.75 agrees on no band with probability (1 - 0.75**4)**24 = 1e-4; at 0.8 it is 3e-6.
    """
    banded = signed_bands(own, run, rows, bands)
    shared = banded.groupBy("band").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo < hi").select("band")
    few = written(banded.join(shared, "band", "left_semi").distinct(), "shared-bands")
    many = few.groupBy("band").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("band")
    crowded = not many.isEmpty()
    usual = few.join(many, "band", "left_anti") if crowded else few
    a, b = usual.select("band", F.col("class_id").alias("class_a")), usual.select("band", F.col("class_id").alias("class_b"))
    pairs = a.join(b, "band").where("class_a < class_b").select("class_a", "class_b").distinct()
    if crowded:
        pairs = pairs.unionByName(hot_candidates(few.join(many, "band", "left_semi"), own, least, run)).distinct()
    return verified(pairs, own, least, run)


def verified(pairs: DataFrame, own: DataFrame, least: float, run: int) -> DataFrame:
    """The pairs of classes that hold on the texts themselves; a text is fetched only where its class is in a pair."""
    texts = _texts(own, pairs.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).distinct())
    return (
        pairs.join(texts.select(F.col("class_id").alias("class_a"), F.col("text").alias("text_a")), "class_a")
        .join(texts.select(F.col("class_id").alias("class_b"), F.col("text").alias("text_b")), "class_b")
        .select("class_a", "class_b", "text_a", "text_b")
        .mapInArrow(_verify(run, least), "class_a bigint, class_b bigint, similarity double")
    )


def _with_run(run: int):
    """(class_id, text) to the class_ids whose text has a run of words; Python, so that Spark doesn't look at other texts first."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [len(t.split(maxsplit=run - 1)) >= run for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], ["class_id"])

    return go


def near_copies(records: DataFrame, key: str, text: str, least: float = 0.8, run: int = 5, rows: int = 4, bands: int = 24, hot: int = 64) -> tuple[DataFrame, DataFrame]:
    """(members, links): (key, class_id) of all records with a text, and (class_a, class_b) of the classes that are alike.

    A class of several keys whose text has a run of words is linked to itself.
    """
    own = classes(records, key, text)
    found = class_pairs(own, least, run, rows, bands, hot).select("class_a", "class_b")
    members = own.select("key", "class_id").distinct()
    several = members.groupBy("class_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("class_id")
    equal = _texts(own, several).select("class_id", "text").mapInArrow(_with_run(run), "class_id bigint")
    return members, written(found.unionByName(equal.select(F.col("class_id").alias("class_a"), F.col("class_id").alias("class_b"))), "near-copies")


def near_copy_pairs(records: DataFrame, key: str, text: str, least: float = 0.8, run: int = 5, rows: int = 4, bands: int = 24, hot: int = 64) -> DataFrame:
    """(key_a, key_b): all pairs of different keys whose texts have a similarity of at least `least`; the smaller key first.

    Null keys and null texts give nothing, nor do texts with fewer words than a run. A row that comes again gives its
    pairs once. A key with several texts has a pair where any of its texts has.
    """
    members, links = near_copies(records, key, text, least, run, rows, bands, hot)
    a = members.select(F.col("key").alias("ka"), F.col("class_id").alias("class_a"))
    b = members.select(F.col("key").alias("kb"), F.col("class_id").alias("class_b"))
    both = links.join(a, "class_a").join(b, "class_b").where("ka <> kb")
    return both.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b")).distinct()


def near_copy_groups(records: DataFrame, key: str, text: str, least: float = 0.8, run: int = 5, rows: int = 4, bands: int = 24, hot: int = 64) -> DataFrame:
    """(key, group, links): each key with a text, the least key of the records it is linked to over any number of links, and to how many other keys its texts are alike.

    Copies aren't paired: a key's links are the other members of its classes and the members of the classes linked to these.
    """
    from lamella.operators.versions import components

    members, links = near_copies(records, key, text, least, run, rows, bands, hot)
    size = members.groupBy("class_id").agg(F.count("*").alias("size"), F.min("key").alias("least"))
    ways = links.where("class_a <> class_b").select(F.col("class_a").alias("class_id"), F.col("class_b").alias("other"))
    ways = ways.unionByName(ways.select(F.col("other").alias("class_id"), F.col("class_id").alias("other")))
    others = ways.join(size.select(F.col("class_id").alias("other"), "size"), "other").groupBy("class_id").agg(F.sum("size").alias("others"))
    alike = links.where("class_a = class_b").select(F.col("class_a").alias("class_id"), F.lit(1).alias("alike"))
    joined = size.join(others, "class_id", "left").join(alike, "class_id", "left").fillna(0, ["others", "alike"])
    joined = joined.select("class_id", "least", (F.col("others") + F.col("alike") * (F.col("size") - 1)).alias("n"))
    whole = components(links.where("class_a <> class_b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))).select(F.col("doc_id").alias("class_id"), "family")
    named = joined.join(whole, "class_id", "left").withColumn("family", F.coalesce("family", "class_id"))
    names = named.groupBy("family").agg(F.min("least").alias("group"))
    # a key with several texts is in the group of the least name, and has the links of all of them
    own = members.join(named.join(names, "family").select("class_id", "group", "n"), "class_id")
    return own.groupBy(F.col("key").alias(key)).agg(F.min("group").alias("group"), F.sum("n").alias("links"))
