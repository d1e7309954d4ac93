"""Duplicates of chunks, newest document first: exact copies, then near copies by banded MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import text as X
from lamella.functions.joins import few_join
from lamella.operators.clean import rank
from lamella.session import written

#: The hash functions are (a * x + b) mod PRIME of 32 bits of a shingle's MD5, so that any engine can compute them.
PRIME = 4294967291
COEFFICIENTS = [((2654435761 * (2 * j + 1)) % PRIME, (40503 * (j + 7) ** 3) % PRIME) for j in range(256)]


def exact(chunks: DataFrame) -> DataFrame:
    """chunks with `rank`, their text's `hash`, and whether they are its first copy (`kept`).

    The first copy is found by an aggregation that is combined before the shuffle; the join back has hash and rank as its
    keys, so a text that is a third of all chunks is spread over all partitions.
    """
    # written, as both the aggregation and the join read it: texts are cut into chunks and hashed once
    own = written(chunks.withColumn("rank", rank()).withColumn("hash", F.sha2("text", 256)), "hashed")
    firsts = own.groupBy("hash").agg(F.min("rank").alias("rank")).withColumn("kept", F.lit(True))
    return own.join(firsts, ["hash", "rank"], "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


def _bands(bands: int, rows: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (np.array(x, np.uint64) for x in zip(*COEFFICIENTS[: bands * rows]))
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0] : offsets[-1]]
            offsets = offsets - offsets[0]
            sig = np.empty((len(lists), bands * rows), np.uint64)
            for j in range(bands * rows):
                sig[:, j] = np.minimum.reduceat((values * a[j] + b[j]) % np.uint64(PRIME), offsets[:-1]) if len(values) else 0
            keys = np.zeros((len(lists), bands), np.uint64)
            for r in range(rows):
                # band k has the values k * rows to k * rows + rows - 1
                keys = (keys ^ sig[:, r::rows]) * np.uint64(0x9E3779B97F4A7C15)
                keys ^= keys >> np.uint64(31)
            keys = keys + np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0xD1342543DE82EF95)
            take = pa.array(np.repeat(np.arange(len(lists)), bands))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array(keys.reshape(-1).view(np.int64))], ["rank", "band"])

    return go


def banded(chunks: DataFrame, bands: int = 5, rows: int = 11) -> DataFrame:
    """(rank, band): the bands of each chunk's signature over its distinct runs of five words.

    5 bands of 11 minimise the false positives and negatives of a threshold of 0.8 with 64 hash functions.
    """
    hashes = F.transform(X.shingles(X.words(F.lower("text"))), lambda s: F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint"))
    # every chunk has at least one shingle, so no list is empty
    return chunks.select("rank", hashes.alias("h")).mapInArrow(_bands(bands, rows), "rank struct<older:int,doc:string,idx:int>, band bigint")


def greedy(members: DataFrame) -> DataFrame:
    """(rank, kept, of): chunks visited in order of rank, each kept unless an earlier kept one shares a band; `of` is the earliest such one.

    Work is linear in (rank, band) rows, and only those of chunks that share a band with another one go into rounds. A
    round looks at each band's earliest kept and earliest undecided chunk: a chunk is removed once a band has an earlier
    kept one, and kept once it is the earliest undecided one of all its bands and none has an earlier kept one. What is decided
    leaves the state, but for the earliest kept chunk of each band. In each round the earliest undecided chunk of all is
    decided, so rounds end; they follow chains of dependence. Each is written, so lineage stays short.
    """
    crowd = members.groupBy("band").agg(F.count("*").alias("n"))
    many = written(members.join(crowd.where("n > 1"), "band").select("rank", "band"), "greedy-shared")
    state = many.withColumn("k", F.lit(None).cast(many.schema["rank"].dataType))
    done = []
    while True:
        tops = state.groupBy("band").agg(F.min("rank").alias("u"))
        seen = state.join(tops, "band").groupBy("rank").agg(F.min(F.when(F.col("k") < F.col("rank"), F.col("k"))).alias("of"), F.min((F.col("u") >= F.col("rank")).cast("int")).alias("first"))
        now = seen.select("rank", F.when(F.col("of").isNotNull(), False).when(F.col("first") == 1, True).alias("kept"))
        now = written(now, "greedy-now")
        done.append(now.where("kept is not null"))
        left = now.where("kept is null").select("rank")
        if left.isEmpty():
            break
        # a band's earliest kept chunk is all that later ones need to know of it
        news = many.join(now.where("kept").select("rank"), "rank").groupBy("band").agg(F.min("rank").alias("new"))
        state = written(state.join(left, "rank", "left_semi").join(news, "band", "left").select("rank", "band", F.least("k", "new").alias("k")), "greedy")
    decided = done[0]
    for d in done[1:]:
        decided = decided.unionByName(d)
    decided = written(decided, "greedy-decided")
    # a removed chunk's `of` is the earliest kept chunk of all its bands
    final = many.join(decided, "rank")
    top = final.groupBy("band").agg(F.min(F.when(F.col("kept"), F.col("rank"))).alias("k"))
    of = final.where(~F.col("kept")).join(top, "band").groupBy("rank").agg(F.min("k").alias("of"))
    every = members.select("rank").distinct().join(decided, "rank", "left").withColumn("kept", F.coalesce("kept", F.lit(True)))
    return every.join(of, "rank", "left")


def deduplicated(chunks: DataFrame) -> DataFrame:
    """chunks with `reason`: null where kept, else exact_duplicate, cross_doc_boilerplate or intra_doc_near_duplicate."""
    own = exact(chunks)
    near = greedy(banded(own.where("kept").select("rank", "text")))
    label = F.when(F.col("of.doc") == F.col("doc_id"), "intra_doc_near_duplicate").otherwise("cross_doc_boilerplate")
    out = own.withColumnRenamed("kept", "single").join(near, "rank", "left")
    return out.withColumn("reason", F.when(~F.col("single"), "exact_duplicate").when(~F.col("kept"), label)).drop("single", "kept", "of", "hash")


#: A run of words is known by so many bits of a hash where sets are compared before they are fetched.
BITS = 49


def runs(lists: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the runs of `size` words, given as lists of the words' hashes: one run, of all words, where there are fewer."""
    values, ends = lists.values.to_numpy(zero_copy_only=False).view(np.uint64), lists.offsets.to_numpy().astype(np.int64)
    n = np.maximum(np.diff(ends) - size + 1, 1)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + ends[:-1][row]
    values = np.append(values, np.uint64(0))
    out = np.zeros(len(row), np.uint64)
    for k in range(size):
        there = at + k < ends[1:][row]
        word = np.where(there, values[np.minimum(at + k, len(values) - 1)], np.uint64(0x9E3779B97F4A7C15))
        out = (out ^ word) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    return row, (out ^ (out >> np.uint64(32))) >> np.uint64(64 - BITS)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of so few rows that a row's number and a run fit into 64 bits."""
    for b in batches:
        for start in range(0, len(b), 1 << 14):
            yield b.slice(start, 1 << 14)


def _often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(x, c): runs that come more than once in a batch."""
    for b in _rows(batches):
        row, x = runs(b.column("w"))
        own = np.unique((row.astype(np.uint64) << np.uint64(BITS)) | x) & np.uint64((1 << BITS) - 1)
        x, c = np.unique(own, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(x[c > 1].astype(np.int64)), pa.array(c[c > 1])], ["x", "c"])


def _prefixes(common: np.ndarray, least: float):
    """(x, id, n, i, b0, b1): of each set its first runs in one order of all runs, `common` ones (in order of rarity) last; n is the set's size, i the place, b0 and b1 128 parities of the set."""
    by_hash = np.argsort(common)
    sorted_common = common[by_hash].astype(np.uint64)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _rows(batches):
            # copies in a batch are one
            b = b.take(pa.array(np.unique(b.column("id").to_numpy(), return_index=True)[1]))
            row, x = runs(b.column("w"))
            if len(sorted_common):
                at = np.minimum(np.searchsorted(sorted_common, x), len(sorted_common) - 1)
                x = np.where(sorted_common[at] == x, np.uint64(1 << BITS) + by_hash[at].astype(np.uint64), x)
            own = np.unique((row.astype(np.uint64) << np.uint64(BITS + 1)) | x)
            row, x = (own >> np.uint64(BITS + 1)).astype(np.int64), own & np.uint64((1 << (BITS + 1)) - 1)
            n = np.bincount(row, minlength=len(b))
            i = np.arange(len(row)) - (np.cumsum(n) - n)[row] + 1
            bit = ((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(57)).astype(np.int64)
            odd = np.bincount(row * 128 + bit, minlength=len(b) * 128).reshape(-1, 128) & 1
            parity = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
            keep = i <= n[row] - np.ceil(least * n[row] - 1e-9) + 1
            row = row[keep]
            ids = b.column("id").to_numpy()
            columns = x[keep].astype(np.int64), ids[row], n[row].astype(np.int32), i[keep].astype(np.int32), parity[row, 0], parity[row, 1]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["x", "id", "n", "i", "b0", "b1"])

    return go


def jaccard_pairs(chunks: DataFrame, key: str = "chunk_id", least: float = 0.8, common: int = 1 << 18) -> DataFrame:
    """(key_a, key_b, similarity) of pairs of different texts whose runs of five words are at least `least` alike, exactly.

    Prefix filter: with runs in one order, two such sets share one of the first n - ceil(least * n) + 1 of either. Only
    those are moved, as numbers. The order decides how many sets meet, not which pairs are found: the `common` runs that
    come most often in the same batches are its end, so frequent ones rarely meet. Pairs that meet are judged by what the
    place of the first run they share leaves, and by 128 parities of each set (the sets differ in at least as many runs
    as their parities do); only the texts of those that remain are fetched and compared.
    """
    words = F.transform(X.words(F.lower("text")), lambda w: F.xxhash64(w))
    own = chunks.where("text is not null").select(key, "text", F.xxhash64("text").alias("id"))
    hashed = own.select("id", words.alias("w"))
    often = written(hashed.select("w").mapInArrow(_often, "x bigint, c bigint").groupBy("x").agg(F.sum("c").alias("c")), "runs-often")
    # at most `common` of them are sent to all: those that come at least `most` times
    taken, most = 0, None
    for c, n in often.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).toLocalIterator():
        taken += n
        if taken > common:
            break
        most = c
    last = often.where(F.col("c") >= most).orderBy("c", "x").select("x").toArrow()["x"].to_numpy() if most else np.zeros(0, np.int64)
    sets = hashed.mapInArrow(_prefixes(last, least), "x bigint, id bigint, n int, i int, b0 bigint, b1 bigint").repartition("x").distinct()
    names = ["id", "n", "i", "b0", "b1"]
    a, b = (sets.select("x", *(F.col(c).alias(f"{c}_{s}") for c in names)) for s in "ab")
    total = F.col("n_a") + F.col("n_b")
    close = F.least("n_a", "n_b") >= least * F.greatest("n_a", "n_b")
    reach = 1 + F.least(F.col("n_a") - F.col("i_a"), F.col("n_b") - F.col("i_b")) >= least / (1 + least) * total - 1e-6
    apart = F.bit_count(F.col("b0_a").bitwiseXOR(F.col("b0_b"))) + F.bit_count(F.col("b1_a").bitwiseXOR(F.col("b1_b"))) <= (1 - least) / (1 + least) * total + 1e-6
    cand = written(a.join(b, "x").where((F.col("id_a") < F.col("id_b")) & close & reach & apart).select("id_a", "id_b").distinct(), "runs-met")
    met = cand.select(F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    texts = few_join(own, met, "id").groupBy("id", F.sha2("text", 256).alias("h")).agg(F.min(key).alias(key), F.first("text").alias("text"))
    full = written(texts.select("id", key, F.transform(X.shingles(X.words(F.lower("text"))), lambda s: F.xxhash64(s)).alias("s")), "runs-full")
    pairs = cand
    for side in "ab":
        pairs = pairs.join(full.select(F.col("id").alias(f"id_{side}"), F.col(key).alias(f"k_{side}"), F.col("s").alias(f"s_{side}")), f"id_{side}")
    both = F.size(F.array_intersect("s_a", "s_b"))
    j = both / (F.size("s_a") + F.size("s_b") - both)
    return pairs.withColumn("similarity", j).where(F.col("similarity") >= least).select(F.least("k_a", "k_b").alias(f"{key}_a"), F.greatest("k_a", "k_b").alias(f"{key}_b"), F.round("similarity", 6).alias("similarity"))
