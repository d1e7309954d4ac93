"""Pages of chunks: where in a document's pages a chunk's words stand.

Words of pages and chunks are cut into runs of six by built-in expressions, and the runs of a chunk's beginning and end meet
those of its document's pages in a join on their hash. What is left to walk in order are a few places a chunk: a chunk is
looked for from where the one before it was found. The walk is cut into blocks of chunks; each block begins where the one
before it is thought to end, and all are walked again until that is so, which is mostly the second time.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions import text as X
from lamella.session import written

#: Words of a run, words from one try to the next, tries at either end, and words of slack.
RUN, STEP, TRIES, SLACK = 6, 3, 6, 60


def words(text: str | Column) -> Column:
    """Runs of letters a to z and digits, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(X.col(text), F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))


def _runs(w: Column, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, RUN), " ")))


def page_runs(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doc_id, run, at), (doc_id, ends)): every run of a document's words with its place, and how many words there are up to the end of each page."""
    own = pages.select("doc_id", F.transform("pages", lambda p: words(p)).alias("by_page"))
    sizes = F.transform("by_page", lambda w: F.size(w))
    ends = F.transform(F.sequence(F.lit(1), F.size("by_page")), lambda i: F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda n, x: n + x))
    flat = own.where(F.size("by_page") > 0).select("doc_id", F.flatten("by_page").alias("w"), ends.alias("ends"))
    last = F.size("w") - RUN
    starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return flat.select("doc_id", F.posexplode(_runs(F.col("w"), starts)).alias("at", "run")), flat.select("doc_id", "ends")


def _tries(n: Column, side: str) -> Column:
    """Places of the runs that are tried, from the beginning or from the end."""
    count = F.least(F.floor((n - RUN) / STEP) + 1, F.lit(TRIES)).cast("int")
    k = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda t: t * STEP)
    return F.when(n >= RUN, k if side == "front" else F.transform(k, lambda x: n - RUN - x)).otherwise(F.array().cast("array<int>"))


def candidates(chunks: DataFrame, runs: DataFrame) -> DataFrame:
    """(chunk_id, doc_id, idx, n, front, back): of each chunk its number of words and, for each try at either end, the places of its run, in order."""
    own = chunks.select("chunk_id", "doc_id", "idx", words("text").alias("w")).withColumn("n", F.size("w"))
    places = F.sequence(F.lit(0), F.lit(TRIES - 1))

    def tried_from(side: str) -> Column:
        runs_of = F.arrays_zip(places.alias("t"), _runs(F.col("w"), _tries(F.col("n"), side)).alias("run"))
        return F.transform(runs_of, lambda x: F.struct(F.lit(side).alias("side"), x["t"].alias("t"), x["run"].alias("run")))

    tried = own.select("chunk_id", "doc_id", F.explode(F.concat(tried_from("front"), tried_from("back"))).alias("x")).select("chunk_id", "doc_id", "x.*").where("run is not null")
    # only runs that are asked for, each once, and all their places
    places = runs.join(tried.select("doc_id", "run").distinct(), ["doc_id", "run"]).groupBy("doc_id", "run").agg(F.array_sort(F.collect_list("at")).alias("places"))
    met = tried.join(places, ["doc_id", "run"]).groupBy("chunk_id").agg(*[F.map_from_entries(F.collect_list(F.when(F.col("side") == s, F.struct("t", "places")))).alias(s) for s in ("front", "back")])
    none = F.create_map().cast("map<int,array<int>>")
    return own.select("chunk_id", "doc_id", "idx", "n").join(met, "chunk_id", "left").withColumns({s: F.coalesce(s, none) for s in ("front", "back")})


def locate(n: int, front: dict[int, list[int]], back: dict[int, list[int]], cursor: int) -> tuple[int, int] | None:
    """First and last word of a chunk of n words, given the places of its runs; None where none is there.

    The beginning is sought from the cursor on as far as four times the chunk and some words; then anywhere, the first place
    from the cursor on before the first of all. The end is sought within twice the chunk, or else is n words on.
    """
    tries = sorted(front)
    near = ((at, t) for t in tries for at in front[t] if cursor <= at <= cursor + 4 * n + SLACK)
    far = ((next((at for at in front[t] if at >= cursor), front[t][0]), t) for t in tries)
    at, t = next(near, None) or next(far, (None, 0))
    if at is None:
        return None
    start = max(0, at - t * STEP)
    ends = (at + RUN - 1 + t * STEP for t in sorted(back) for at in back[t] if start <= at <= start + 2 * n + SLACK)
    return start, next(ends, start + n - 1)


def _walk(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    cursor, rows = int(block["cursor"].iloc[0]), []
    for r in block.sort_values("idx").itertuples():
        got = locate(r.n, dict(r.front), dict(r.back), cursor)
        if got:
            cursor = got[0]
        rows.append((r.chunk_id, *(got or (None, None))))
    out = pd.DataFrame(rows, columns=["chunk_id", "start", "end"]).astype({"start": "Int32", "end": "Int32"})
    return out.assign(doc_id=key[0], block=key[1], last=cursor)[["doc_id", "block", "chunk_id", "start", "end", "last"]]


def walked(found: DataFrame, block: int) -> DataFrame:
    """(doc_id, block, chunk_id, start, end, last): every chunk's words; `last` is where the next block begins."""
    own = written(found.withColumn("block", F.floor(F.col("idx") / block)), "places")
    begin = own.groupBy("doc_id", "block").agg(F.lit(0).alias("cursor"))
    order = Window.partitionBy("doc_id").orderBy("block")
    while True:
        # a block's beginning is right once all before it are; the first ones are from the start, so this ends
        out = own.join(begin, ["doc_id", "block"]).groupBy("doc_id", "block").applyInPandas(_walk, "doc_id string, block bigint, chunk_id string, start int, end int, last int")
        out = written(out, "walk")
        after = out.groupBy("doc_id", "block").agg(F.first("last").alias("last"))
        now = after.select("doc_id", "block", F.coalesce(F.lag("last").over(order), F.lit(0)).alias("cursor"))
        now = written(now, "cursors")
        if now.join(begin.withColumnRenamed("cursor", "before"), ["doc_id", "block"]).where("cursor <> before").isEmpty():
            return out
        begin = now


def located(chunks: DataFrame, pages: DataFrame, block: int = 512) -> DataFrame:
    """chunks (chunk_id, doc_id, idx, text) with page_start and page_end; null where a document's pages weren't kept or a chunk isn't found."""
    runs, ends = page_runs(pages)
    found = walked(candidates(chunks, runs), block).where("start is not null").join(ends, "doc_id")

    def page(word: Column) -> Column:
        """The page whose words the place is among; a place behind the last word is its page."""
        at = F.least(word, F.element_at("ends", -1) - 1)
        return F.size(F.filter("ends", lambda e: e <= at)) + 1

    first = page(F.col("start"))
    own = found.select("chunk_id", first.alias("page_start"), F.greatest(first, page(F.col("end"))).alias("page_end"))
    return chunks.drop("page_start", "page_end").join(own, "chunk_id", "left")
