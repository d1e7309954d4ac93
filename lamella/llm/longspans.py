"""Long exact spans shared between records.

Fingerprints are winnowed hashes of windows of `width` code points (Schleimer, Wilkerson, Aiken 2003): any stretch of
`least` code points that two texts have in common holds a window that is a fingerprint of both. They are kept in a
log-structured index: immutable runs, each laid out in buckets by hash and sorted, are the partitions of one bucketed table.
A batch of texts is looked up in the runs of all earlier batches by merge joins, for which the runs are neither moved nor
sorted again, then it is a run itself; runs of one level are compacted into one of the next when there are `fan` of them.
A manifest names the runs that count, so that any later session opens the index and goes on.

Every candidate is verified on the texts: of each posting whose hash another text has too, the surroundings (the window with
`least - width` code points more on either side) are cut out and named by a digest of 128 bits. Postings with equal hash and
equal surroundings are one class: a passage repeated in a third of all records is one class (or a few, where records
begin or end) and is compared once, not once a pair. Where a hash still has more than `hot` classes, its classes are not
paired: every window of `least` code points around it gets its digest, and texts are joined on those, which gives
only stretches that are long enough.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.llm import flat
from lamella.llm.identity import identified, one_text_each
from lamella.session import names, put, remove, scratch, settings, written

_U = np.uint64
POSTING = "hash bigint, text_id bigint, pos int, run int"


def sliding_min_places(h: np.ndarray, w: int) -> np.ndarray:
    """Places that are the (last) minimum of some w consecutive values."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.int64)
    if n <= w:
        return np.array([n - 1 - int(np.argmin(h[::-1]))])
    # van Herk: the minimum of any window is that of a block's tail and the next block's head
    pad = (-n) % w
    x = np.concatenate([h, np.full(pad, _U(0xFFFFFFFFFFFFFFFF))]).reshape(-1, w)
    head = np.minimum.accumulate(x, axis=1).reshape(-1)
    tail = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(tail[: n - w + 1], head[w - 1 : n])
    # a place is chosen where its value is the minimum of a window that holds it
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    chosen = []
    stops = np.concatenate([change[1:], [len(least)]])
    values = least[change]
    order = np.argsort(h, kind="stable")
    sorted_h = h[order]
    left, right = np.searchsorted(sorted_h, values, "left"), np.searchsorted(sorted_h, values, "right")
    single = right - left == 1
    chosen.append(order[left[single]])
    for a, z, lo, hi in zip(change[~single], stops[~single], left[~single], right[~single]):
        # equal values: all places that a window of this run holds; more than needed does no harm
        at = order[lo:hi]
        chosen.append(at[(at >= a) & (at < z - 1 + w)])
    return np.unique(np.concatenate(chosen))


def fingerprints(cps: np.ndarray, bounds: np.ndarray, width: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the row and hash. A text shorter than `least` has none; equal windows of one text are all kept."""
    n = len(cps)
    size = np.diff(bounds)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.arange(n - width + 1)
    h = flat.gram(flat.prefix(cps), starts, starts + width)
    row = np.repeat(np.arange(len(size)), size)
    inside = (row[: n - width + 1] == row[width - 1 :]) & (size[row[: n - width + 1]] >= least)
    h[~inside] = _U(0xFFFFFFFFFFFFFFFF)
    at = sliding_min_places(h, least - width + 1)
    at = at[inside[at]]
    r = row[at]
    return r, at - bounds[r], h[at]


def _postings(width: int, least: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # of equal texts a task reads one
        for batch in batches:
            ids, first = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
            new = np.array([i not in seen for i in ids.tolist()], bool)
            ids, first = ids[new], first[new]
            seen.update(ids.tolist())
            runs = batch.column(2).to_numpy(zero_copy_only=False)[first]
            for lo, hi, cps, bounds in flat.blocks(batch.column(1).take(pa.array(first))):
                r, at, h = fingerprints(cps, bounds, width, least)
                yield pa.RecordBatch.from_arrays([pa.array(flat.signed(h)), pa.array(ids[lo:hi][r]), pa.array(at.astype(np.int32)), pa.array(runs[lo:hi][r].astype(np.int32))], ["hash", "text_id", "pos", "run"])

    return go


class SpanIndex:
    """The log-structured fingerprint index: a table of runs at `path`, and a manifest in versions beside it.

    A run is a partition of the table, bucketed and sorted by hash, one file a bucket, and never changed. The manifest of
    the highest number holds; it is written before anything that an older one names is deleted.
    """

    def __init__(self, spark: SparkSession, path: str, width: int, least: int, fan: int, buckets: int, runs: list[tuple[int, int]], made: int, version: int):
        if not 0 < width <= least:
            raise ValueError("width must be between 1 and least")
        self.spark, self.path, self.width, self.least, self.fan, self.buckets = spark, path, width, least, fan, buckets
        #: (level, number) of the runs that count, and how many numbers have been given
        self.runs, self.made, self.version = runs, made, version
        self.name = "lamella_spans_" + hashlib.blake2b(path.encode(), digest_size=8).hexdigest()
        if not spark.catalog.tableExists(self.name):
            spark.sql(f"create table {self.name} (`hash` bigint, text_id bigint, pos int, run int) using parquet partitioned by (run) clustered by (`hash`) sorted by (`hash`) into {buckets} buckets location '{path}/runs'")
            if made:
                spark.sql(f"alter table {self.name} recover partitions")

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, width: int = 200, least: int = 400, fan: int = 4, buckets: int | None = None) -> SpanIndex:
        """An empty index; buckets are as many as the session's shuffle partitions unless given."""
        return cls(spark, path or scratch(spark, "spans"), width, least, fan, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), [], 0, 0)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SpanIndex:
        """The index at a path, as its newest manifest describes it."""
        last = max(x for x in names(spark, path) if x.startswith("manifest-"))
        m = json.loads(spark.read.text(f"{path}/{last}", wholetext=True).first()[0])
        return cls(spark, path, m["width"], m["least"], m["fan"], m["buckets"], [tuple(r) for r in m["runs"]], m["made"], m["version"])

    def save(self) -> None:
        self.version += 1
        state = {k: getattr(self, k) for k in ("width", "least", "fan", "buckets", "runs", "made", "version")}
        put(self.spark, f"{self.path}/manifest-{self.version:08d}", json.dumps(state))

    def load(self, texts: DataFrame, count: int = 1) -> list[int]:
        """New runs of (text_id bigint, text string, batch int), one for each of the batches 0 to count - 1, in one pass over the texts; their numbers. They aren't part of the index yet."""
        first, self.made = self.made, self.made + count
        rows = texts.select("text_id", "text", (F.col("batch") + first).alias("run")).mapInArrow(_postings(self.width, self.least), POSTING)
        rows.repartition(self.buckets, "hash").write.insertInto(self.name)
        return list(range(first, first + count))

    def sorted_scans(self):
        """Buckets are read as what they are: laid out by hash, and sorted where they are one file."""
        return settings(self.spark, spark__sql__legacy__bucketedTableScan__outputOrdering="true", spark__sql__sources__bucketing__autoBucketedScan__enabled="false")

    def read(self, *runs: int) -> DataFrame:
        return self.spark.table(self.name).where(F.col("run").isin(*runs)).drop("run")

    def append(self, run: int) -> None:
        """The run joins the index; then runs are compacted as far as needed."""
        self.runs.append((0, run))
        level, gone = 0, []
        while len(same := [n for at, n in self.runs if at == level]) >= self.fan:
            number, self.made = self.made, self.made + 1
            with self.sorted_scans():  # each bucket of the new run is its old buckets' rows: nothing is moved
                self.read(*same).withColumn("run", F.lit(number)).write.insertInto(self.name)
            self.runs = [(at, n) for at, n in self.runs if at != level] + [(level + 1, number)]
            gone += same
            level += 1
        self.save()
        for n in gone:
            self.spark.sql(f"alter table {self.name} drop if exists partition (run = {n})")
            remove(self.spark, f"{self.path}/runs/run={n}")

    def matches(self, run: int) -> DataFrame:
        """Postings of a new run (fresh) and of the runs of the index (not fresh) whose hash the other side, or another new text, has.

        One merge join a run, on the hash; only hashes that met are moved. To be executed within sorted_scans().
        """
        new = self.read(run)
        own = new.groupBy("hash").agg(F.min("text_id").alias("lo"), F.max("text_id").alias("hi"))
        known = [self.read(n).join(own.select("hash").hint("merge"), "hash", "left_semi") for _, n in self.runs]
        hashes = own.where("lo < hi").select("hash")
        for k in known:
            hashes = hashes.unionByName(k.select("hash").distinct())
        out = new.join(hashes.distinct().hint("merge"), "hash", "left_semi").withColumn("fresh", F.lit(True))
        for k in known:
            out = out.unionByName(k.withColumn("fresh", F.lit(False)))
        return out


def common_stretch(x: str, y: str, p: int, q: int, width: int) -> tuple[int, int]:
    """(code points before the window, length) of the stretch that x at p and y at q have in common; (0, 0) if not even the window."""
    if x[p : p + width] != y[q : q + width]:
        return 0, 0
    back = 0
    while back < min(p, q) and x[p - back - 1] == y[q - back - 1]:
        back += 1
    a, b, on = p + width, q + width, 0
    while a + on < len(x) and b + on < len(y) and x[a + on] == y[b + on]:
        on += 1
    return back, back + width + on


def _extend(least: int, width: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("part_a", "part_b", "at_a", "at_b")]
            got = [common_stretch(x, y, p, q, width) for x, y, p, q in zip(*cols)]
            keep = pa.array([g[1] >= least for g in got], pa.bool_())
            own = [batch.column(batch.schema.get_field_index(c)).filter(keep) for c in ("batch", "hash", "around_a", "around_b")]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array([g[i] for g in got], pa.int32()).filter(keep) for i in (0, 1))], ["batch", "hash", "around_a", "around_b", "before", "size"])

    return go


def _digest(part: str) -> bytes:
    return hashlib.blake2b(part.encode("utf-8", "surrogatepass"), digest_size=16).digest()


AROUND = "batch int, fresh boolean, hash bigint, text_id bigint, pos int, around binary, back int, wide int"


def _around(more: int, width: int):
    """(text_id, text, spots) to AROUND: the digest of each posting's surroundings and of the window's place in them, the code points before the window, and all of theirs."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_id, text, spots in zip(*(c.to_pylist() for c in batch.columns)):
                for s in spots:
                    lo, hi = max(s["pos"] - more, 0), min(s["pos"] + width + more, len(text))
                    rows.append((s["batch"], s["fresh"], s["hash"], text_id, s["pos"], _digest(f"{s['pos'] - lo} {text[lo:hi]}"), s["pos"] - lo, hi - lo))
            kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)], ["batch", "fresh", "hash", "text_id", "pos", "around", "back", "wide"])

    return go


def _cut(more: int, width: int):
    """(text_id, text, places) to (text_id, pos, part): the surroundings themselves."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, p, t[max(p - more, 0) : p + width + more]) for i, t, places in zip(*(c.to_pylist() for c in batch.columns)) for p in places]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 3, [pa.int64(), pa.int32(), pa.string()])], ["text_id", "pos", "part"])

    return go


def _windows(least: int):
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for b, h, around, part, at in zip(*(c.to_pylist() for c in batch.columns)):
                rows += [(b, h, around, _digest(part[i : i + least]), at - i) for i in range(len(part) - least + 1)]
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], ["batch", "hash", "around", "window", "before"])

    return go


def class_links(met: DataFrame, texts: DataFrame, least: int, width: int, hot: int = 64) -> tuple[DataFrame, DataFrame]:
    """(links, windows). links: (batch, hash, around_a, around_b, before, size), classes of postings with a stretch of `least` code points in common.

    met: AROUND of all batches. texts: (text_id, text), each text once. A class is linked to itself where its surroundings
    are long enough (around_a = around_b); other classes once (around_a < around_b), after the texts around one posting of
    either have been compared. Hashes with more than `hot` classes aren't in links but in windows, (batch, hash, around,
    window, before): every stretch of `least` code points around their postings, by its digest.
    """
    more = least - width
    classes = met.groupBy("batch", "hash", "around").agg(F.min(F.struct("text_id", "pos")).alias("low"), F.max("fresh").alias("fresh"), F.first("back").alias("back"), F.first("wide").alias("wide"))
    classes = classes.select("batch", "hash", "around", "fresh", "back", "wide", F.col("low.text_id").alias("text_id"), F.col("low.pos").alias("pos"))
    number = classes.groupBy("batch", "hash").agg(F.count("*").alias("n"))
    classes = classes.join(number, ["batch", "hash"])
    own = classes.where((F.col("wide") >= least) & F.col("fresh") & (F.col("n") <= hot)).select("batch", "hash", F.col("around").alias("around_a"), F.col("around").alias("around_b"), F.col("back").alias("before"), F.col("wide").alias("size"))
    classes = classes.where("n > 1")
    places = classes.groupBy("text_id").agg(F.collect_set("pos").alias("places"))
    cut = texts.join(places, "text_id").select("text_id", "text", "places").mapInArrow(_cut(more, width), "text_id bigint, pos int, part string").withColumn("at", F.least("pos", F.lit(more)))

    def side(df: DataFrame, s: str, on: list[str]) -> DataFrame:
        return df.select(*on, *(F.col(c).alias(f"{c}_{s}") for c in ("around", "text_id", "pos", "fresh")))

    usual, many = classes.where(F.col("n") <= hot), classes.where(F.col("n") > hot)
    on = ["batch", "hash"]
    cold = side(usual, "a", on).join(side(usual, "b", on), on)
    windows = many.join(cut, ["text_id", "pos"]).select("batch", "hash", "around", "part", "at").mapInArrow(_windows(least), "batch int, hash bigint, around binary, window binary, before int").distinct()
    pairs = cold.where("around_a < around_b and (fresh_a or fresh_b)").distinct()
    one, two = (cut.select(*(F.col(c).alias(f"{c}_{s}") for c in cut.columns)) for s in "ab")
    held = pairs.join(one, ["text_id_a", "pos_a"]).join(two, ["text_id_b", "pos_b"])
    held = held.select("batch", "hash", "around_a", "around_b", "part_a", "part_b", "at_a", "at_b").mapInArrow(_extend(least, width), "batch int, hash bigint, around_a binary, around_b binary, before int, size int")
    return own.unionByName(held), windows


def one_of_each_set(have: DataFrame, by: list[str]) -> DataFrame:
    """Of the groups `by` of (by, text_id, fresh) that more than one text is in, one for each set of texts (by count and 128 bits of hash).

    Neighbouring windows are mostly had by the same texts, so this divides the work of pairing by their number.
    """
    sets = have.groupBy(*by).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("text_id", "fresh")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "text_id", "fresh")).alias("y"), F.max("fresh").alias("some")).where("n > 1 and some")
    one = sets.groupBy(by[0], "n", "x", "y").agg(F.min(F.struct(*by)).alias("g")).select("g.*")
    return have.join(one, by, "left_semi")


def hot_texts(met: DataFrame, windows: DataFrame) -> DataFrame:
    """(batch, hash, window, text_id, fresh): texts that have a window another text has too."""
    post = met.groupBy("batch", "hash", "around", "text_id").agg(F.max("fresh").alias("fresh"))
    have = windows.select("batch", "hash", "around", "window").distinct().join(post, ["batch", "hash", "around"]).groupBy("batch", "hash", "window", "text_id").agg(F.max("fresh").alias("fresh"))
    return one_of_each_set(have, ["batch", "hash", "window"])


def _pairs(have: DataFrame, by: list[str]) -> DataFrame:
    """(x, y): texts of one group, one of them fresh."""
    a, b = (have.select(*by, F.col("text_id").alias(t), F.col("fresh").alias(f)) for t, f in (("x", "fa"), ("y", "fb")))
    return a.join(b, by).where("x < y and (fa or fb)").select("x", "y")


def spans_index(records: DataFrame, key: str, text: str, arrived: str | None, least: int, width: int, batches: int, fan: int, hot: int, path: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(members, met, links, windows): the keys of each text, the met postings of all batches as AROUND, the links of their classes, and hot windows.

    path: where the index is made, and stays with all records in it.
    """
    spark = records.sparkSession
    when = F.unix_seconds(F.col(arrived).cast("timestamp")) if arrived else F.lit(None).cast("long")
    base = identified(records.where(F.length(text) >= least), key, text, when.alias("arrived"))
    members = base.groupBy("key", "text_id").agg(F.first(F.length("text")).alias("n"))
    cuts = base.agg(F.percentile_approx("arrived", [1 - 0.5 ** (i + 1) for i in range(batches - 1)], 1000)).first()[0] if arrived and batches > 1 else None
    number = F.lit(0)
    for c in cuts or []:
        number = number + F.when(F.col("arrived").isNull() | (F.col("arrived") > c), 1).otherwise(0)
    index = SpanIndex.create(spark, path, width, least, fan)
    parts = []
    for i, run in enumerate(index.load(base.select("text_id", "text", number.alias("batch")), len(cuts or []) + 1)):
        with index.sorted_scans():
            parts.append(written(index.matches(run).withColumn("batch", F.lit(i)), "met"))
        index.append(run)
    met = parts[0]
    for p in parts[1:]:
        met = met.unionByName(p)
    spots = met.groupBy("text_id").agg(F.collect_set(F.struct("batch", "fresh", "hash", "pos")).alias("spots"))
    texts = one_text_each(base, spots).select("text_id", "text", "spots")
    texts = written(texts, "span-texts")
    near = written(texts.mapInArrow(_around(least - width, width), AROUND), "around")
    links, windows = class_links(near, texts.select("text_id", "text"), least, width, hot)
    return members, near, links, windows


def shared_span_pairs(records: DataFrame, key: str, text: str, arrived: str | None = None, least: int = 400, width: int = 200, batches: int = 3, fan: int = 2, hot: int = 64, path: str | None = None) -> DataFrame:
    """(key_a, key_b): all pairs of different keys whose texts have a stretch of at least `least` code points in common.

    The records come in `batches` batches in order of `arrived` (nulls last): the older half first, then half of what
    remains, and so on, as an index meets them that is kept up by daily arrivals; the result doesn't depend on it.
    Null keys and null texts give nothing; rows that come again give their pairs once.
    """
    members, met, links, windows = spans_index(records, key, text, arrived, least, width, batches, fan, hot, path)
    links = written(links, "links")
    # a text that repeats itself has many postings in a class, and is in it once
    by = ["batch", "hash", "around"]
    post = met.groupBy(*by, "text_id").agg(F.max("fresh").alias("fresh"))
    same = post.join(links.where("around_a = around_b").select("batch", "hash", F.col("around_a").alias("around")), by, "left_semi")
    pairs = _pairs(one_of_each_set(same, by), by)
    a = post.select("batch", "hash", F.col("around").alias("around_a"), F.col("text_id").alias("x"), F.col("fresh").alias("fa"))
    b = post.select("batch", "hash", F.col("around").alias("around_b"), F.col("text_id").alias("y"), F.col("fresh").alias("fb"))
    wide = links.where("around_a < around_b").select("batch", "hash", "around_a", "around_b").join(a, ["batch", "hash", "around_a"]).join(b, ["batch", "hash", "around_b"])
    pairs = pairs.unionByName(wide.where("x <> y and (fa or fb)").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
    pairs = pairs.unionByName(_pairs(hot_texts(met, windows), ["batch", "hash", "window"])).distinct()
    equal = members.groupBy("text_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select(F.col("text_id").alias("x"), F.col("text_id").alias("y"))
    both = pairs.unionByName(equal)
    one, two = members.select(F.col("text_id").alias("x"), F.col("key").alias("ka")), members.select(F.col("text_id").alias("y"), F.col("key").alias("kb"))
    both = both.join(one, "x").join(two, "y").where("ka <> kb")
    return both.select(F.least("ka", "kb").alias(f"{key}_a"), F.greatest("ka", "kb").alias(f"{key}_b")).distinct()


def shared_share(records: DataFrame, key: str, text: str, arrived: str | None = None, least: int = 400, width: int = 200, batches: int = 3, fan: int = 2, hot: int = 64) -> DataFrame:
    """(key, n_chars, spans, shared_chars, shared): of each record with a text of at least `least` code points, how much of it stands in another one.

    spans counts the separate stretches. A text that is another record's whole text is shared whole.
    """
    members, met, links, windows = spans_index(records, key, text, arrived, least, width, batches, fan, hot)
    links, windows = written(links, "links"), written(windows, "windows")
    ends = met.groupBy("batch", "hash", "around").agg(F.min("text_id").alias("lo"), F.max("text_id").alias("hi"))
    ways = links.select("batch", "hash", F.col("around_a").alias("around"), F.col("around_b").alias("other"), "before", "size").unionByName(links.where("around_a < around_b").select("batch", "hash", F.col("around_b").alias("around"), F.col("around_a").alias("other"), "before", "size"))
    ways = ways.join(ends.withColumnRenamed("around", "other"), ["batch", "hash", "other"])
    seen = met.select("batch", "hash", "around", "text_id", "pos").join(ways, ["batch", "hash", "around"]).where("lo <> text_id or hi <> text_id")
    parts = seen.select("text_id", (F.col("pos") - F.col("before")).alias("start"), (F.col("pos") - F.col("before") + F.col("size")).alias("stop")).distinct()
    held = windows.join(met.select("batch", "hash", "around", "text_id").distinct(), ["batch", "hash", "around"]).groupBy("batch", "hash", "window").agg(F.min("text_id").alias("lo"), F.max("text_id").alias("hi")).where("lo < hi")
    hot_at = windows.join(held.select("batch", "hash", "window"), ["batch", "hash", "window"], "left_semi").select("batch", "hash", "around", "before").distinct()
    start = F.col("pos") - F.col("before")
    parts = parts.unionByName(met.join(hot_at, ["batch", "hash", "around"]).select("text_id", start.alias("start"), (start + least).alias("stop"))).distinct()
    copies = members.groupBy("text_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.max("n").alias("n")).where("lo < hi")
    parts = parts.unionByName(copies.select("text_id", F.lit(0).alias("start"), F.col("n").alias("stop")))
    before = Window.partitionBy("text_id").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    reach = parts.withColumn("reach", F.coalesce(F.max("stop").over(before), F.lit(-1)))
    text_sum = reach.groupBy("text_id").agg(
        F.sum(F.when(F.col("start") > F.col("reach"), 1).otherwise(0)).alias("spans"),
        F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "reach"))).alias("shared_chars"),
    )
    out = members.join(text_sum, "text_id", "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_chars"), F.coalesce("spans", F.lit(0)).alias("spans"), F.coalesce("shared_chars", F.lit(0)).alias("shared_chars"), F.round(F.coalesce("shared_chars", F.lit(0)) / F.col("n"), 6).alias("shared"))
