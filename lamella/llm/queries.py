"""The queries of the training-data problems; __spark_entry__.py adds them where this subpackage can be imported."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.llm.budget import budget, disagreeing
from lamella.llm.encoding import decoded, encoded
from lamella.llm.language import Models, detected, mislabelled, train
from lamella.llm.leakage import leaks
from lamella.llm.longspans import shared_share, shared_span_pairs
from lamella.llm.nearcopies import near_copy_groups, near_copy_pairs
from lamella.llm.personal import found_types, redacted
from lamella.llm.pieces import oversized, split
from lamella.llm.prose import not_prose, text_stats
from lamella.llm.scanned import noise, repaired
from lamella.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return found_types(table(spark, folder, "chunks").select("chunk_id", "text"), "chunk_id", "text", table(spark, folder, "pii_gold"))


def p1_redacted(spark: SparkSession, folder: str) -> DataFrame:
    return redacted(table(spark, folder, "chunks").select("chunk_id", "text").distinct(), "chunk_id", "text", table(spark, folder, "pii_gold"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return oversized(table(spark, folder, "cleaned_docs").select("doc_id", "text"), "doc_id", "text")


def p2_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split(table(spark, folder, "cleaned_docs").select("doc_id", "text"), "doc_id", "text")


def p2_joined(spark: SparkSession, folder: str) -> DataFrame:
    """The texts again, made of their pieces: each up to where the next one begins."""
    pieces = p2_pieces(spark, folder)
    after = F.lead("start").over(Window.partitionBy("doc_id").orderBy("piece_no"))
    cut = pieces.withColumn("after", after).select("doc_id", "piece_no", F.when(F.col("after").isNull(), F.col("text")).otherwise(F.expr("left(text, cast(after - start as int))")).alias("t"), F.length("text").alias("n"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "t"))), lambda x: x["t"]), "")
    return cut.groupBy("doc_id").agg(whole.alias("text"), (F.max("n") <= 8000).alias("fits"))


def p4_counts(spark: SparkSession, folder: str) -> DataFrame:
    return p4_stats(spark, folder).select("chunk_id", "n_chars", "n_words", F.round(F.col("mean_word_length") * F.col("n_words")).cast("bigint").alias("n_solid"))


def p6_words(spark: SparkSession, folder: str) -> DataFrame:
    return budget(table(spark, folder, "documents"), table(spark, folder, "doc_labels"), "words")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    found = noise(table(spark, folder, "cleaned_docs").select("doc_id", "text"), "doc_id", "text")
    return found.select("doc_id", "line_no", "noise").distinct()


def p3_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return repaired(table(spark, folder, "cleaned_docs").select("doc_id", "text"), "doc_id", "text")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return not_prose(table(spark, folder, "chunks").select("chunk_id", "text"), "chunk_id", "text")


def p4_stats(spark: SparkSession, folder: str) -> DataFrame:
    return text_stats(table(spark, folder, "chunks").select("chunk_id", "text"), "chunk_id", "text").distinct()


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return near_copy_pairs(table(spark, folder, "chunks").select("chunk_id", "text"), "chunk_id", "text", least=0.75)


def p5_groups(spark: SparkSession, folder: str) -> DataFrame:
    return near_copy_groups(table(spark, folder, "chunks").select("chunk_id", "text"), "chunk_id", "text", least=0.75)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return disagreeing(table(spark, folder, "token_stats"), table(spark, folder, "chunks"))


def p6_budget(spark: SparkSession, folder: str) -> DataFrame:
    return budget(table(spark, folder, "documents"), table(spark, folder, "doc_labels"))


def _models(spark: SparkSession, folder: str) -> Models:
    """Fitted on the labelled rows of documents: 300 a label at most."""
    return train(spark, table(spark, folder, "documents").select("text", "lang"), "text", "lang")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return mislabelled(table(spark, folder, "cleaned_docs").select("doc_id", "text", "lang"), "doc_id", "text", "lang", _models(spark, folder))


def p7_languages(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "cleaned_docs").select("doc_id", "text", "lang")
    return detected(rows, "doc_id", "text", "lang", _models(spark, folder)).distinct()


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"), "doc_id", "text")


def p8_decoded(spark: SparkSession, folder: str) -> DataFrame:
    return decoded(p8_ids(spark, folder), "doc_id")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    found = leaks(table(spark, folder, "documents"), "doc_id", "text", table(spark, folder, "eval_items"), "item_id", "text")
    return found.select("doc_id", "item_id")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return shared_span_pairs(table(spark, folder, "documents").select("doc_id", "text", "added_at"), "doc_id", "text", "added_at")


def p10_shared(spark: SparkSession, folder: str) -> DataFrame:
    return shared_share(table(spark, folder, "documents").select("doc_id", "text", "added_at"), "doc_id", "text", "added_at")


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k.startswith("p") and k[1].isdigit()}


_S = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_WORDS = f"list_filter(regexp_split_to_array(%s, '{_S}+'), lambda w: w <> '')"
_RUN12 = r"""(select distinct %s id, unnest(case when len(w) >= 12 then list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i : i + 11], ' ')) else [] end) g from (select %s, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') w from %s where text is not null))"""


def oracle_sql() -> dict[str, str]:
    """Exact searches, for the queries that SQL can express over whole tables."""
    return {
        "p2_joined": "select distinct doc_id, text, true fits from cleaned_docs where text is not null and doc_id is not null",
        "p4_counts": f"select distinct chunk_id, length(coalesce(text, '')) n_chars, len({_WORDS % "coalesce(text, '')"}) n_words, length(regexp_replace(coalesce(text, ''), '{_S}', '', 'g')) n_solid from chunks",
        "p5_groups": f"""with recursive c as (select distinct chunk_id, {_WORDS % 'lower(text)'} w from chunks where text is not null),
 s as (select distinct chunk_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [] end) g from c), n as (select chunk_id, count(*) n from s group by 1),
 p as (select a.chunk_id a, b.chunk_id b, count(*) k from s a join s b on a.g = b.g and a.chunk_id < b.chunk_id group by 1, 2), e as (select a, b from p join n x on x.chunk_id = a join n y on y.chunk_id = b where k / (x.n + y.n - k) >= 0.75),
 l as (select a, b from e union all select b, a from e), same as (select min(chunk_id) over (partition by text) a, chunk_id b from (select distinct chunk_id, text from chunks where text is not null)), q as (select a, b from l union select a, b from same union select b, a from same),
 r(chunk_id, other) as (select a, a from q union select r.chunk_id, q.b from r join q on q.a = r.other), g as (select chunk_id, min(other) "group" from r group by 1) select chunk_id, "group", count(b) links from g left join l on l.a = chunk_id group by 1, 2""",
        "p6_words": f"""with lab as (select source_file, min(lower(trim(label))) label from doc_labels where source_file is not null group by 1), d as (select source, lang, coalesce(domain, label) as domain, text, len({_WORDS % "coalesce(text, '')"}) n from documents left join lab using (source_file)),
 o as (select source, lang, domain, count(*) docs, count(text) texts, sum(n) tokens, max(n) one from d group by source, lang, domain, text) select source, lang, domain, cast(sum(docs) as bigint) docs, cast(sum(texts) as bigint) texts, cast(sum(tokens) as bigint) tokens, cast(sum(one) as bigint) distinct_tokens from o group by 1, 2, 3""",
        "p10_shared": """with t as (select distinct doc_id, text from documents where length(text) >= 400), w as (select doc_id, i, md5_number(substr(text, i, 400)) h from (select doc_id, text, unnest(range(1, length(text) - 398)) i from t)),
 many as (select h from w group by h having count(distinct doc_id) > 1), hit as (select doc_id, i from w semi join many using (h)), gaps as (select doc_id, i, lag(i) over (partition by doc_id order by i) p from hit),
 sums as (select doc_id, count(*) filter (where p is null or i - p > 400) spans, cast(sum(case when p is null then 400 else least(i - p, 400) end) as bigint) shared from gaps group by 1)
 select doc_id, length(text) n_chars, coalesce(spans, 0) spans, coalesce(sums.shared, 0) shared_chars, round(coalesce(sums.shared, 0) / length(text), 6) shared from t left join sums using (doc_id)""",
        "p2_found": "select distinct doc_id from cleaned_docs where length(text) > 8000",
        "p5_found": f"""with c as (select distinct chunk_id, {_WORDS % 'lower(text)'} w from chunks where text is not null),
 s as (select distinct chunk_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [] end) g from c), n as (select chunk_id, count(*) n from s group by 1),
 p as (select a.chunk_id a, b.chunk_id b, count(*) k from s a join s b on a.g = b.g and a.chunk_id < b.chunk_id group by 1, 2)
 select a chunk_id_a, b chunk_id_b from p join n x on x.chunk_id = a join n y on y.chunk_id = b where k / (x.n + y.n - k) >= 0.75""",
        "p6_found": f"""with c as (select run_id, source_file, chunk_id, max(len({_WORDS % "coalesce(text, '')"})) k from chunks group by 1, 2, 3), r as (select run_id, source_file, count(chunk_id) n, sum(k) k from c group by 1, 2)
 select distinct s.run_id, s.source_file from token_stats s left join r on s.run_id is not distinct from r.run_id and s.source_file is not distinct from r.source_file
 where s.chunks is null or s.tokens is null or s.chunks <> coalesce(r.n, 0) or s.tokens <> coalesce(r.k, 0)""",
        "p8_decoded": "select doc_id, coalesce(text, '') as text from documents",
        "p9_found": f"with d as {_RUN12 % ('doc_id', 'doc_id', 'documents')}, i as {_RUN12 % ('item_id', 'item_id', 'eval_items')} select distinct d.id doc_id, i.id item_id from d join i using (g)",
        "p10_found": """with w as (select distinct doc_id, md5_number(substr(text, i, 400)) h from (select doc_id, text, unnest(range(1, length(text) - 398)) i from documents where length(text) >= 400))
 select distinct a.doc_id doc_id_a, b.doc_id doc_id_b from w a join w b on a.h = b.h and a.doc_id < b.doc_id""",
    }
