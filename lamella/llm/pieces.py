"""Splitting oversized items at natural boundaries.

A giant item is never looked at as a whole. Workers take ranges of its bytes, each with a halo on either side, and note
the code points that begin in the range and, for every stripe of at most STRIPE code points, the best place to cut. The tables of
the ranges are stitched: prefix sums over the ranges' lengths, on two levels, turn local places into places in the item. Cuts lie in
windows of a fixed grid (the best boundary of the window, the latest of equals), so each is found without the one before
it, and pieces are emitted by byte offset: of a file by a seek, of a text in a row from the range that the piece begins in.

A piece k goes from `overlap` code points before cut k to cut k + 1 and has at most `limit` code points. The start is moved
back to the beginning of the word it falls into, or, where that is over SLACK code points away, stays. Boundaries, best
first: blank line, end of a sentence, end of a line, white space, any place that doesn't part a letter from its marks.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lamella.functions.joins import prefix_sums
from lamella.session import written

SLACK, STRIPE, WINDOW = 64, 200, 1000
_CUT = re.compile(r"(?P<p4>\n[ \t\r]*\n\s*)|(?P<p3>[.!?।॥。][\"')\]”’»]*\s+)|(?P<p2>[ \t\r]*\n\s*)|(?P<p1>\s+)")
RANGE = "key string, part bigint, n bigint, size bigint, places array<struct<cp:bigint,byte:bigint,rank:int>>"


def grid(limit: int, overlap: int) -> tuple[int, int]:
    """(step of the grid, window): a piece is at most step + window + overlap + SLACK long, which is limit."""
    window = min(WINDOW, max(1, (limit - overlap) // 4))
    step = limit - overlap - window - SLACK
    if step <= window:
        raise ValueError("limit is too small for that overlap")
    return step, window


def places(data: bytes, lo: int, hi: int, size: int = STRIPE) -> tuple[int, list[tuple[int, int, int]]]:
    """Of bytes lo to hi of a fragment with halos: code points that begin there, and (place, byte, rank) of the best cut of each stripe.

    Places count from the first code point of the range; bytes from lo. Bytes that are no UTF-8 count as one code point each.
    """
    raw = np.frombuffer(data, np.uint8)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    text = data.decode("utf-8", "surrogateescape")
    if len(text) != len(lead):  # a halo begins or ends inside a character, or the bytes are no UTF-8
        sizes = [1 if 0xDC80 <= ord(c) <= 0xDCFF else len(c.encode("utf-8")) for c in text]
        lead_all = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if sizes else np.zeros(0, np.int64)
        keep = (lead_all < lo) | (lead_all >= hi) | ((raw[lead_all] & 0xC0) != 0x80)
        starts = lead_all
        inside = np.flatnonzero((starts >= lo) & (starts < hi) & keep)
    else:
        starts = lead
        inside = np.flatnonzero((starts >= lo) & (starts < hi))
    if not len(inside):
        return 0, []
    first, n = int(inside[0]), len(inside)
    best: dict[int, tuple[int, int]] = {}
    for m in _CUT.finditer(text):
        at = m.end()
        if first <= at < first + n:
            stripe = (at - first) // size
            best[stripe] = max(best.get(stripe, (0, 0)), (int(m.lastgroup[1]), at))
    out = []
    for stripe in range((n + size - 1) // size):
        rank, at = best.get(stripe, (0, 0))
        if not rank:
            at = first + min(n, (stripe + 1) * size) - 1
            while at > first + stripe * size and unicodedata.category(text[at])[0] == "M":
                at -= 1
        out.append((at - first, int(starts[at]) - lo, rank))
    return n, out


def _detect(size: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("cp", pa.int64()), ("byte", pa.int64()), ("rank", pa.int32())]))
        for batch in batches:
            n, found = [], []
            for data, before, length in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                a, b = places(data, before, before + length, size)
                n.append(a)
                found.append([{"cp": c, "byte": y, "rank": r} for c, y, r in b])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), batch.column(4).cast(pa.int64()), pa.array(found, kind)], ["key", "part", "n", "size", "places"])

    return go


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = []
        for data, before, size in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist()):
            n.append(int(((np.frombuffer(data, np.uint8)[before : before + size] & 0xC0) != 0x80).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["key", "part", "n"])


def ranges(items: DataFrame, range_bytes: int, halo: int, after: int | None = None) -> DataFrame:
    """(key, part, data, before, size, and the items' other columns): the byte ranges of (key, blob), an item of any size in parts of range_bytes.

    Each has `halo` bytes of what is before it, and `after`, by default as many, of what comes after.
    """
    after = halo if after is None else after
    rest = [c for c in items.columns if c not in ("key", "blob")]
    parts = items.select("key", *rest, F.posexplode(F.expr(f"transform(sequence(0, cast(greatest(octet_length(blob) - 1, 0) div {range_bytes} as int)), i -> struct(i as part, substring(blob, greatest(i * {range_bytes} - {halo}, 0) + 1, {range_bytes} + {after} + least(i * {range_bytes}, {halo})) as data, least(i * {range_bytes}, {halo}) as before, least({range_bytes}, octet_length(blob) - i * {range_bytes}) as size))")).alias("i", "r"))
    return parts.select("key", F.col("r.part").cast("long").alias("part"), "r.data", "r.before", "r.size", *rest)


def file_ranges(spark: SparkSession, paths: list[str], range_bytes: int = 1 << 26, halo: int = 4096) -> DataFrame:
    """(key, part, data, before, size) of files that every worker can open; each worker seeks to its range and reads no more."""
    rows = [(p, i, os.path.getsize(p)) for p in paths for i in range(max(1, -(-os.path.getsize(p) // range_bytes)))]
    tasks = spark.createDataFrame(rows, "key string, part bigint, total bigint").repartition(max(1, len(rows)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, part, total in zip(*(c.to_pylist() for c in batch.columns)):
                lo, hi = part * range_bytes, min(total, (part + 1) * range_bytes)
                begin = max(0, lo - halo)
                with open(key, "rb") as f:
                    f.seek(begin)
                    data = f.read(min(total, hi + halo) - begin)
                yield pa.RecordBatch.from_pylist([{"key": key, "part": part, "data": data, "before": lo - begin, "size": hi - lo}], schema=pa.schema([("key", pa.string()), ("part", pa.int64()), ("data", pa.binary()), ("before", pa.int32()), ("size", pa.int32())]))

    return tasks.mapInArrow(read, "key string, part bigint, data binary, before int, size int")


def lengths(parts: DataFrame) -> DataFrame:
    """(key, n): code points of each item, summed over its ranges; a range that comes again counts once."""
    once = parts.mapInArrow(_lengths, "key string, part bigint, n bigint").groupBy("key", "part").agg(F.max("n").alias("n"))
    return once.groupBy("key").agg(F.sum("n").alias("n"))


def boundaries(parts: DataFrame, limit: int, overlap: int) -> DataFrame:
    """(key, part, n, size, places): the boundary table of each range, written; a range that comes again counts once."""
    window = grid(limit, overlap)[1]
    # stripes so small that a window of the grid holds a whole one wherever it lies
    found = parts.mapInArrow(_detect(max(1, min(STRIPE, window // 3))), RANGE)
    return written(found.groupBy("key", "part").agg(F.max("n").alias("n"), F.max("size").alias("size"), F.first("places").alias("places")), "boundaries")


def cut_places(found: DataFrame, range_bytes: int, limit: int, overlap: int) -> DataFrame:
    """(key, k, cp, byte, total): cut k of each item over the limit, counted from 1, in code points and bytes from its beginning.

    found: as boundaries() gives. Local places become places in the item by sums over the ranges before, made on two levels;
    an item's table, however long, is never one row or one task.
    """
    step, window = grid(limit, overlap)
    totals = found.groupBy("key").agg(F.sum("n").alias("total")).where(F.col("total") > limit)
    placed = prefix_sums(found.join(totals, "key"), ["key"], "part", "n")
    every = placed.select("key", "total", F.explode("places").alias("p"), "before", "part").select("key", "total", (F.col("before") + F.col("p.cp")).alias("cp"), (F.col("part") * range_bytes + F.col("p.byte")).alias("byte"), "p.rank")
    every = every.withColumn("k", F.ceil(F.col("cp") / step))
    good = every.where((F.col("k") >= 1) & (F.col("cp") > F.col("k") * step - window) & (F.col("k") <= F.ceil(F.col("total") / step) - 1))
    best = good.groupBy("key", "k", "total").agg(F.max(F.struct("rank", "cp", "byte")).alias("b"))
    return best.select("key", "k", F.col("b.cp").alias("cp"), F.col("b.byte").alias("byte"), "total")


def offsets(found: DataFrame, range_bytes: int, limit: int, overlap: int) -> DataFrame:
    """(key, k, cp, byte, stop): piece k of every item without its overlap, from where to which byte; found: as boundaries() gives."""
    places = cut_places(found, range_bytes, limit, overlap)
    whole = found.groupBy("key").agg(F.sum("size").alias("bytes"))
    zero = F.lit(0).cast("bigint")
    begins = written(whole.select("key", zero.alias("k"), zero.alias("cp"), zero.alias("byte")).unionByName(places.select("key", "k", "cp", "byte")), "cuts")
    # a cut's stop is the next one's byte: cuts are numbered without a gap, so the next one is a join away
    after = begins.select("key", (F.col("k") - 1).alias("k"), F.col("byte").alias("stop"))
    return begins.join(after, ["key", "k"], "left").join(whole, "key").select("key", "k", "cp", "byte", F.coalesce("stop", "bytes").alias("stop"))


def cuts(parts: DataFrame, range_bytes: int, halo: int, limit: int, overlap: int) -> DataFrame:
    """(key, n, cuts array<struct<cp, byte>>): where each item is cut, as one row; none where it is within the limit."""
    found = boundaries(parts, limit, overlap)
    lists = cut_places(found, range_bytes, limit, overlap).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("cp", "byte"))).alias("cuts"))
    sizes = found.groupBy("key").agg(F.sum("n").alias("n"))
    return sizes.join(lists, "key", "left").select("key", "n", F.coalesce("cuts", F.array().cast("array<struct<cp:bigint,byte:bigint>>")).alias("cuts"))


def _emit(overlap: int):
    """(file, piece_no, cp, byte, stop) to pieces: each is read at its offset, with the bytes before it that hold the overlap, and no more."""
    back = 4 * (overlap + SLACK) + 4  # 4 bytes at most a code point

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, number, cp, byte, stop in zip(*(c.to_pylist() for c in batch.columns)):
                begin = max(0, byte - back)
                with open(path, "rb") as f:
                    f.seek(begin)
                    data = f.read(stop - begin)
                lead, body = piece(data, byte - begin, overlap, begin == 0)
                rows.append((path, number, cp - len(lead), len(lead) + len(body), lead + body))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["file", "piece_no", "start", "n_chars", "text"])

    return go


def _emit_ranges(overlap: int):
    """(of, part, data, before, pieces) to the pieces that begin in the range, from its bytes and halos; their bytes count from the range's first."""
    back = 4 * (overlap + SLACK) + 4

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, rows = [], []
            for i in range(batch.num_rows):
                part, data, before, own = (batch.column(c)[i].as_py() for c in range(1, 5))
                for p in own:
                    at = before + p["byte"]
                    begin = max(0, at - back)
                    lead, body = piece(data[begin : before + p["stop"]], at - begin, overlap, part == 0 and begin == 0)
                    of.append(i)
                    rows.append((p["k"], p["cp"] - len(lead), len(lead) + len(body), lead + body))
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string()]
            made = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), *made], ["of", "piece_no", "start", "n_chars", "text"])

    return go


def piece(data: bytes, at: int, overlap: int, first: bool) -> tuple[str, str]:
    """(overlap, rest) of the piece that begins at byte `at` of data; first: data begin where the item does, else the first character may be cut."""
    before = data[:at]
    while before and not first and (before[0] & 0xC0) == 0x80:
        before = before[1:]
    return lead_in(before.decode("utf-8", "replace"), overlap), data[at:].decode("utf-8", "replace")


def lead_in(before: str, overlap: int) -> str:
    """What a piece repeats of the text before it: `overlap` code points, and the rest of the word they begin in if that is short."""
    if len(before) <= overlap:
        return before
    far, near = before[: len(before) - overlap], before[len(before) - overlap :]
    word = re.search(r"\S*\Z", far).group() if near and not near[0].isspace() else ""
    return word + near if len(word) < SLACK else near


def split_files(spark: SparkSession, paths: list[str], limit: int = 8000, overlap: int = 200, range_bytes: int = 1 << 26, halo: int = 4096) -> DataFrame:
    """(file, piece_no, start, n_chars, text): the pieces of files that every worker can open, as split() gives them of texts.

    No worker ever holds a file: boundaries are found range by range, and each piece is read at its own offset. A file within
    the limit is one piece, an empty one an empty piece; bytes that are no UTF-8 come out as U+FFFD.
    """
    found = boundaries(file_ranges(spark, paths, range_bytes, halo), limit, overlap)
    rows = offsets(found, range_bytes, limit, overlap).select(F.col("key").alias("file"), F.col("k").alias("piece_no"), "cp", "byte", "stop")
    return rows.repartition("file", "piece_no").mapInArrow(_emit(overlap), "file string, piece_no bigint, start bigint, n_chars bigint, text string")


def _keyed(records: DataFrame, key: str, text: str) -> DataFrame:
    """(key, of, blob): a key of each record and text, the record's own key, which may be null, and the text's bytes."""
    rows = records.where(F.col(text).isNotNull())
    return rows.select(F.concat_ws("\x00", F.col(key).cast("string"), F.xxhash64(text).cast("string")).alias("key"), F.col(key).alias("of"), F.encode(F.col(text), "UTF-8").alias("blob"))


def pieces_of_long(rows: DataFrame, limit: int, overlap: int, range_bytes: int, halo: int) -> DataFrame:
    """(of, piece_no, start, n_chars, text) of (key, of, blob) with more bytes than the limit; a row that comes again comes out once.

    A text leaves its row in ranges. Their boundary tables give the offsets of all pieces, and each range, with halos that hold
    the overlap before and a piece after it, gives the pieces that begin in it.
    """
    long = rows.where(F.octet_length("blob") > limit)
    found = boundaries(ranges(long.select("key", "blob"), range_bytes, halo), limit, overlap)
    spans = offsets(found, range_bytes, limit, overlap).withColumn("part", F.expr(f"byte div {range_bytes}"))
    local = F.struct("k", "cp", (F.col("byte") - F.col("part") * range_bytes).alias("byte"), (F.col("stop") - F.col("part") * range_bytes).alias("stop"))
    begun = spans.groupBy("key", "part").agg(F.collect_list(local).alias("pieces"))
    parts = ranges(long, range_bytes, 4 * (overlap + SLACK) + 4, 4 * limit).dropDuplicates(["key", "part"])
    kind = StructType([StructField("of", rows.schema["of"].dataType), *StructType.fromDDL("piece_no int, start bigint, n_chars int, text string")])
    return parts.join(begun, ["key", "part"]).select("of", "part", "data", "before", "pieces").mapInArrow(_emit_ranges(overlap), kind)


def oversized(records: DataFrame, key: str, text: str, limit: int = 8000, overlap: int = 200, range_bytes: int = 1 << 16, halo: int = 1024) -> DataFrame:
    """(key): records whose text has more than `limit` code points, each once: those that come out as more than one piece.

    Null texts give nothing; a null key is a key, as in SQL.
    """
    found = pieces_of_long(_keyed(records, key, text), limit, overlap, range_bytes, halo)
    return found.where(F.col("piece_no") > 0).select(F.col("of").alias(key)).distinct()


def split(records: DataFrame, key: str, text: str, limit: int = 8000, overlap: int = 200, range_bytes: int = 1 << 16, halo: int = 1024) -> DataFrame:
    """(key, piece_no, start, n_chars, text): the pieces of every text, in code points; a text within the limit is one piece.

    Null keys and null texts give nothing; an empty text is one empty piece; a record that comes again comes out once.
    """
    rows = _keyed(records, key, text).where(F.col("of").isNotNull())
    short = rows.where(F.octet_length("blob") <= limit).dropDuplicates(["key"]).withColumn("text", F.col("blob").cast("string"))
    one = short.select("of", F.lit(0).alias("piece_no"), F.lit(0).cast("bigint").alias("start"), F.length("text").alias("n_chars"), "text")
    return one.unionByName(pieces_of_long(rows, limit, overlap, range_bytes, halo)).withColumnRenamed("of", key)
