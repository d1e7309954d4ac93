"""Encoding a whole corpus with a public tokenizer through a table of distinct words.

Spark splits each text into the tokenizer's words, once, counts the distinct ones, and has each encoded once. Ids come back
by position. The words of a corpus follow Zipf's law: the `head` most frequent ones of at most `head_bytes` bytes, a
table of proven size, are sent to all workers and serve nearly all positions; the rest, each of which is rare, is joined
by a shuffle on the word, so that no word is a hot key.

An empty text and a null text both give the empty list. Decoding joins ids with the pieces of the vocabulary.
"""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.functions.joins import hot_keys, spread_join
from lamella.session import written

#: Where the public tokenizers' files are; a parameter of every function here.
TOKENIZERS = os.environ.get("LAMELLA_TOKENIZERS", "/opt/tokenizers")

_WS = r"\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The published word pattern of the byte-level vocabularies, with white space spelled out for Java.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+"


@functools.lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines `base64 rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.lru_cache(maxsize=4)
def encoder(path: str):
    """Of a word's bytes to its ids; the word is merged as one piece, never split again."""
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks(path), special_tokens={})
    return lambda word: enc.encode_ordinary(word)


def vocabulary_file(name: str, tokenizers: str = TOKENIZERS) -> str:
    return os.path.join(tokenizers, f"{name}.tiktoken")


def words_of(text: str) -> F.Column:
    return F.regexp_extract_all(F.col(text), F.lit(WORDS), F.lit(0))


def _encode(path: str):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([code(w) for w in batch.column(0).to_pylist()], pa.list_(pa.int32()))], ["word", "n", "ids"])

    return go


def _slices(text: pa.StringArray, sizes: pa.ListArray) -> tuple[pa.StringArray, np.ndarray]:
    """The words of all texts, which are cut into pieces of so many bytes, and where each text's begin; the last one is the end.

    Texts stand one behind the other in one buffer, so the words are slices of it: nothing is copied.
    """
    offsets = sizes.offsets.to_numpy().astype(np.int64)
    flat = sizes.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False)
    _, places, data = text.buffers()
    first = np.frombuffer(places, np.int32)[text.offset] if len(text) else 0
    edges = (np.concatenate([[0], np.cumsum(flat)]) + first).astype(np.int32)
    return pa.StringArray.from_buffers(len(flat), pa.py_buffer(edges.tobytes()), data if data is not None else pa.py_buffer(b"")), offsets - offsets[0]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, sizes) to (word, n), once a batch."""
    for batch in batches:
        words, _ = _slices(batch.column(0), batch.column(1))
        got = pc.value_counts(words)
        yield pa.RecordBatch.from_arrays([got.field("values"), got.field("counts")], ["word", "n"])


def word_table(cut: DataFrame, path: str) -> DataFrame:
    """(word, n, ids): every distinct word of (text, sizes), how often it comes, and its ids; each is encoded once."""
    counted = cut.select("text", "sizes").mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.mapInArrow(_encode(path), "word string, n bigint, ids array<int>")


def _open(sent: object):
    """(t1, t2, text, sizes) to (t1, t2, pos, word): the words beyond the head, with their places."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value[0], pa.string())
        for batch in batches:
            words, offsets = _slices(batch.column(2), batch.column(3))
            at = np.flatnonzero(pc.index_in(words, value_set=known).is_null().to_numpy(zero_copy_only=False))
            row = np.searchsorted(offsets, at, "right") - 1
            own = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), batch.column(1).take(own), pa.array((at - offsets[row]).astype(np.int32)), words.take(pa.array(at))], ["t1", "t2", "pos", "word"])

    return go


def _fill(head_words: object):
    """(doc, text, sizes, rest) to (doc, ids): the words are the text cut into pieces of so many bytes; ids of the head by lookup, others from rest, which has them by position."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, lists = head_words.value
        known = pa.array(words, pa.string())
        known_size = np.array([len(x) for x in lists] + [0], np.int64)
        known_flat = np.fromiter((i for x in lists for i in x), np.int32)
        known_at = np.concatenate([[0], np.cumsum(known_size[:-1])]).astype(np.int64)
        for batch in batches:
            rest = batch.column(3)
            own, offsets = _slices(batch.column(1), batch.column(2))
            coded = pc.dictionary_encode(own)
            place = pc.fill_null(pc.index_in(coded.dictionary, value_set=known), -1).to_numpy(zero_copy_only=False)
            at = place[coded.indices.to_numpy(zero_copy_only=False)].astype(np.int64) if len(own) else np.zeros(0, np.int64)
            size = known_size[at]
            late = np.flatnonzero(at < 0)
            row = np.searchsorted(offsets, late, "right") - 1
            # rest comes in the order of positions, row by row, as do the places that the head left open
            outer = rest.offsets.to_numpy().astype(np.int64)
            lists_of = rest.values.slice(outer[0], outer[-1] - outer[0])
            got = lists_of.field("ids") if len(lists_of) else None
            if len(late):
                pos = lists_of.field("pos").to_numpy(zero_copy_only=False)
                if len(pos) != len(late) or (pos != late - offsets[row]).any():
                    raise ValueError("the words that were joined back are not those that are open")
                inner = got.offsets.to_numpy().astype(np.int64)
                late_flat = got.values.slice(inner[0], inner[-1] - inner[0]).to_numpy(zero_copy_only=False)
                late_size = np.diff(inner)
                size[late] = late_size
            stop = np.cumsum(size)
            start = stop - size
            total = int(stop[-1]) if len(stop) else 0
            out = np.empty(total, np.int32)
            is_late = np.repeat(at < 0, size)
            within = np.arange(total) - np.repeat(start, size)
            early = ~is_late
            out[early] = known_flat[(np.repeat(known_at[np.maximum(at, 0)], size) + within)[early]] if len(known_flat) else 0
            if len(late):
                out[is_late] = late_flat
            ends = np.concatenate([[0], stop])[offsets] if len(stop) else np.zeros(len(offsets), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out))], ["doc", "ids"])

    return go


def encoded(texts: DataFrame, key: str, text: str, tokenizer: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS, head: int = 50_000, head_bytes: int = 64) -> DataFrame:
    """(key, ids): one row for each row of texts, in whatever order; a null key stays null, extra columns are dropped."""
    spark = texts.sparkSession
    path = vocabulary_file(tokenizer, tokenizers)
    base = texts.select(F.col(key).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # a list of words is several times its text: what is kept and moved is the text, with the sizes of its words in bytes
    sizes = F.transform(words_of("text"), lambda w: F.octet_length(w))
    cut = written(base.select("doc", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), "text", sizes.alias("sizes")), "cut")
    table = written(word_table(cut, path), "words")
    # most frequent first, ties by word: at most `head` rows of at most `head_bytes` bytes
    top = table.where(F.octet_length("word") <= head_bytes).orderBy(F.desc("n"), "word").limit(head).select("word", "ids").toArrow()
    top_words = top.column("word").to_pylist()
    sent = spark.sparkContext.broadcast((top_words, top.column("ids").to_pylist()))
    first = spark.createDataFrame(top.select(["word"])) if top_words else spark.createDataFrame([], "word string")
    # equal texts have the same places, which are one before anything moves
    places = cut.select("t1", "t2", "text", "sizes").mapInArrow(_open(sent), "t1 bigint, t2 bigint, pos int, word string").distinct()
    rare = table.join(F.broadcast(first), "word", "left_anti").select("word", "ids")
    found = places.join(rare, "word").groupBy("t1", "t2").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("rest"))
    empty = F.array().cast("array<struct<pos:int,ids:array<int>>>")
    whole = spread_join(cut, found, ["t1", "t2"], "left", F.col("doc"), hot_keys(cut, ["t1", "t2"])).select("doc", "text", "sizes", F.coalesce("rest", empty).alias("rest"))
    kind = texts.schema[key].dataType
    schema = T.StructType([T.StructField("doc", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return whole.mapInArrow(_fill(sent), schema).withColumnRenamed("doc", key)


def pieces(spark: SparkSession, tokenizer: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(id, piece): the vocabulary's bytes, a table of fixed size."""
    table = ranks(vocabulary_file(tokenizer, tokenizers))
    return spark.createDataFrame(pa.table({"id": pa.array(list(table.values()), pa.int32()), "piece": pa.array(list(table), pa.binary())}))


def decoded(ids: DataFrame, key: str, tokenizer: str = "byte_bpe_50k", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(key, text): the texts again, through a join of ids with pieces; bytes that are no UTF-8 come out as U+FFFD.

    Rows are told apart by key and ids, so rows that come again come back as often.
    """
    spark = ids.sparkSession
    base = ids.select(F.col(key), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    one = base.withColumn("of", F.xxhash64("ids")).withColumn("of2", F.hash("ids"))
    flat = one.dropDuplicates(["of", "of2"]).select("of", "of2", F.posexplode("ids").alias("pos", "id"))
    joined = flat.join(F.broadcast(pieces(spark, tokenizer, tokenizers)), "id")
    text = joined.groupBy("of", "of2").agg(F.array_sort(F.collect_list(F.struct("pos", F.hex("piece").alias("h")))).alias("p"))
    text = text.select("of", "of2", F.decode(F.unhex(F.array_join(F.transform("p", lambda x: x["h"]), "")), "UTF-8").alias("text"))
    return one.join(text, ["of", "of2"], "left").select(key, F.coalesce("text", F.lit("")).alias("text"))
