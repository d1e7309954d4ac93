"""Evaluation texts leaking into training text.

Containment search with MinHash sketches, partitioned by size (after Zhu, Nargesian, Pu, Miller 2016): test items are
short and documents long, so similarity says nothing and containment must be searched. An item's shingles are its runs
of `run` consecutive words. Items of similar size form a partition; the sketch of a partition keeps the s smallest
hash values of each item, s chosen from the partition's upper size u and the least containment asked for, t: all of the
smallest values if t is one shingle in u (then no case is lost), fewer where t is larger. Documents, however long, are
streamed against the sketches; a document is a candidate of an item where the share of the item's sketch found in it
reaches the least share of the partition. Candidates are verified on the shingles themselves, word for word.

Words are runs of letters or digits, case ignored, whatever stands between them.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.llm import flat

WORD = re.compile(r"[^\W_]+")
_TABLES: dict[str, np.ndarray] = {}


def words(text: str | None) -> list[str]:
    """Of a text, in lower case."""
    return WORD.findall((text or "").lower())


def _alnum(cps: np.ndarray) -> np.ndarray:
    if "alnum" not in _TABLES:
        _TABLES["alnum"] = np.array([chr(i).isalnum() for i in range(sys.maxunicode + 1)])
    return _TABLES["alnum"][cps]


def hashed(texts: pa.Array, run: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row behind the last, row of each shingle, hash of each shingle), block by block; texts in lower case."""
    for lo, hi, cps, bounds in flat.blocks(texts):
        starts, ends = flat.spans(_alnum(cps), bounds)
        row = np.searchsorted(bounds, starts, "right") - 1
        grams, first = flat.runs_of_words(flat.gram(flat.prefix(cps), starts, ends), row, run)
        yield lo, hi, row[first], grams


def sketch_size(upper: int, containment: float) -> int:
    """Smallest hash values to keep of an item of at most `upper` shingles so that a document with that containment can't miss them all.

    A document that lacks fewer than (1 - t) * u of the shingles has one of any floor((1 - t) * u) + 1 of them.
    """
    return min(upper, math.floor((1 - containment) * upper + 1e-9) + 1)


def sketches(items: list[tuple[object, str]], run: int, containment: float | None) -> dict[str, np.ndarray]:
    """Sketches of all items: sorted hash values, the item of each, and by item the sketch size, its shingles, and how many values a document must have to be a candidate.

    Partitions are by powers of two of the number of shingles. containment None means one shingle of the item.
    """
    texts = pa.array([t.lower() for _, t in items], pa.string())
    of, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo, _, row, grams in hashed(texts, run):
        of.append(row + lo)
        values.append(grams)
    of, values = np.concatenate(of), np.concatenate(values)
    pairs = np.unique(np.stack([of.astype(np.uint64), values]), axis=1) if len(of) else np.zeros((2, 0), np.uint64)
    of, values = pairs[0].astype(np.int64), pairs[1]
    count = np.bincount(of, minlength=len(items))
    upper = 2 ** np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64)
    keep = np.array([sketch_size(int(u), containment if containment is not None else 1.0 / u) for u in upper] or [0], np.int64)
    order = np.lexsort((values, of))
    of, values = of[order], values[order]
    rank = np.arange(len(of)) - np.searchsorted(of, of, "left")
    some = rank < keep[of] if len(of) else np.zeros(0, bool)
    of, values = of[some], values[some]
    order = np.argsort(values, kind="stable")
    size = np.bincount(of, minlength=len(items))
    # a document with that containment lacks at most (1 - t) of the shingles, so at most as many of the sketch
    least = containment if containment is not None else 1.0 / np.maximum(count, 1)
    fewest = np.maximum(size - np.floor((1 - least) * count + 1e-9).astype(np.int64), 1)
    return {"value": values[order], "item": of[order], "size": size, "shingles": count, "fewest": fewest}


def _search(sent: object, run: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, sketch, containment, kind = sent.value
        sets = [None] * len(ids)
        value, item = sketch["value"], sketch["item"]
        for batch in batches:
            docs, low = batch.column(0), batch.column(1)
            out_doc, out_item, out_share = [], [], []
            for lo, hi, row, grams in hashed(low, run):
                first, n = np.searchsorted(value, grams, "left"), np.searchsorted(value, grams, "right")
                n = n - first
                hit = np.flatnonzero(n)
                if not len(hit):
                    continue
                # all items of each value that is met, then each value of a document and item once
                at = np.repeat(first[hit] - np.cumsum(n[hit]) + n[hit], n[hit]) + np.arange(n[hit].sum())
                doc = np.repeat(row[hit], n[hit]) + lo
                order = np.lexsort((at, item[at], doc))
                at, doc = at[order], doc[order]
                new = np.ones(len(at), bool)
                new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
                at, doc = at[new], doc[new]
                edge = np.ones(len(at), bool)
                edge[1:] = (item[at[1:]] != item[at[:-1]]) | (doc[1:] != doc[:-1])
                begin = np.flatnonzero(edge)
                found = np.diff(np.append(begin, len(at)))
                cases = np.stack([doc[begin], item[at[begin]]])
                cases = cases[:, found >= sketch["fewest"][cases[1]]]
                seen: dict[int, set] = {}
                for r, q in cases.T.tolist():
                    if sets[q] is None:
                        w = words(texts[q])
                        sets[q] = {tuple(w[j : j + run]) for j in range(len(w) - run + 1)}
                    if r not in seen:
                        w = words(low[r].as_py())
                        seen[r] = {tuple(w[j : j + run]) for j in range(len(w) - run + 1)}
                    share = len(sets[q] & seen[r]) / len(sets[q])
                    if share > 0 and (containment is None or share >= containment - 1e-12):
                        out_doc.append(r)
                        out_item.append(q)
                        out_share.append(share)
            yield pa.RecordBatch.from_arrays(
                [docs.take(pa.array(out_doc, pa.int64())), pa.array([ids[q] for q in out_item], kind), pa.array(out_share, pa.float64())], ["doc", "item", "containment"]
            )

    return go


def leaks(docs: DataFrame, doc_key: str, doc_text: str, items: DataFrame, item_key: str, item_text: str, run: int = 12, containment: float | None = None, most_chars: int = 64_000_000) -> DataFrame:
    """(doc_key, item_key, containment): documents that hold at least the share `containment` of an item's shingles, by default one.

    The items are a stated query set: they are brought to the driver and sent to all workers as sketches, in as many
    blocks of about `most_chars` code points as they need, each of which the documents are streamed against. The driver
    holds one block at a time. Null
    keys and texts, and items shorter than a shingle, give nothing; rows that come again give their cases once.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    own = items.where(F.col(item_key).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_key).alias("k"), F.col(item_text).alias("t")).distinct()
    sizes = own.select(F.length("t").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    parts = max(1, math.ceil(sizes / most_chars))
    base = docs.where(F.col(doc_key).isNotNull() & F.col(doc_text).isNotNull()).select(F.col(doc_key).alias("doc"), F.lower(F.col(doc_text)).alias("low"))
    kind, item_kind = docs.schema[doc_key].dataType, items.schema[item_key].dataType
    schema = T.StructType([T.StructField("doc", kind), T.StructField("item", item_kind), T.StructField("containment", T.DoubleType())])
    out = None
    for i in range(parts):
        rows = own.where(F.pmod(F.xxhash64("k", "t"), F.lit(parts)) == i).collect()
        pairs = sorted(((r.k, r.t) for r in rows), key=lambda x: (str(x[0]), x[1]))
        sent = spark.sparkContext.broadcast(([k for k, _ in pairs], [t for _, t in pairs], sketches(pairs, run, containment), containment, to_arrow_type(item_kind)))
        part = base.mapInArrow(_search(sent, run), schema)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("doc", "item").agg(F.max("containment").alias("containment")).withColumnsRenamed({"doc": doc_key, "item": item_key})
