"""The engine's own queries, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions import text as X
from lamella.operators import clean, dedup, evaluate, filters, heal, langid, quality, redact, search, tokens, versions
from lamella.operators.pages import located
from lamella.plans import pipeline
from lamella.session import written
from lamella.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
#: Furniture thresholds at which the test tables' scanned files have any (their pages are about 15 lines long).
SHORT_PAGES = {"repeats": 5, "span": 0.5, "cv": 0.5, "least_gap": 5, "most_gap": 150}
SINGLE_WORDS = ["kyc", "aml", "str", "pep", "sanctions", "onboarding", "reporting", "screening", "monitoring"]


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return clean.adapted(table(spark, sf, "documents"))


def _files(spark: SparkSession, sf: str) -> DataFrame:
    """cleaned_docs, each record once."""
    own = table(spark, sf, "cleaned_docs").where("text is not null")
    return own.groupBy("doc_id").agg(F.min("source_file").alias("source_file"), F.min("text").alias("text"))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    """chunks with a text, each id once."""
    own = table(spark, sf, "chunks").where("text is not null").select("chunk_id", "doc_id", "source_file", "text")
    return own.distinct().withColumn("idx", F.element_at(F.split("chunk_id", "__"), -1).cast("int"))


def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", X.normalize("text").alias("text"))


def clean_filter(spark: SparkSession, sf: str) -> DataFrame:
    return clean.cleaned(_docs(spark, sf)).select("doc_id", "char_count", "reason")


def detect_language(spark: SparkSession, sf: str) -> DataFrame:
    """Each document's language by profiles of the labelled ones."""
    docs = table(spark, sf, "documents")
    return langid.detected(docs, "doc_id", "text", written(langid.profiles(docs.select("text", "lang")), "profiles"))


def clean_reasons(spark: SparkSession, sf: str) -> DataFrame:
    record = clean.stage_record("clean_langid", clean.cleaned(_docs(spark, sf)), known=("too_short", "non_english"))
    return record.select("docs_in", "docs_out", "removed", F.explode("reason_counts").alias("reason", "n"))


def chunk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return clean.chunked(_docs(spark, sf)).select("chunk_id", "doc_id", "idx", "text")


def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.exact(clean.chunked(_docs(spark, sf))).where("kept").select("chunk_id", "hash")


def near_dup_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.jaccard_pairs(clean.chunked(_docs(spark, sf)))


def near_dup_chunks(spark: SparkSession, sf: str) -> DataFrame:
    # rows that are sent again change nothing: texts are compared, each under its least id
    return dedup.jaccard_pairs(table(spark, sf, "chunks").select("chunk_id", "text"))


def minhash_lsh_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.deduplicated(clean.chunked(_docs(spark, sf))).select("chunk_id", "doc_id", "reason")


def heal_line_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = heal.line_stats(_files(spark, sf))
    return s.select("doc_id", "sig", "occurrences", F.round("mean_gap", 6).alias("mean_gap"), F.round("gap_cv", 6).alias("gap_cv"), F.round("span", 6).alias("span"))


def heal_furniture(spark: SparkSession, sf: str) -> DataFrame:
    return heal.furniture(_files(spark, sf), **SHORT_PAGES).select("doc_id", "sig", "occurrences")


def heal_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = written(_files(spark, sf), "files")
    return heal.healed(docs, **SHORT_PAGES).select("doc_id", "char_count", F.size("repairs").alias("repairs"))


def heal_purity(spark: SparkSession, sf: str) -> DataFrame:
    return heal.purity(_files(spark, sf))


def vocab_counts(spark: SparkSession, sf: str) -> DataFrame:
    return heal.vocabulary(_files(spark, sf))


def quality_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).select("chunk_id", quality.quality_reason("text").alias("reason"))


def quality_counts(spark: SparkSession, sf: str) -> DataFrame:
    judged = _chunks(spark, sf).select(quality.quality_reason("text").alias("reason"))
    return judged.groupBy("reason").agg(F.count("*").alias("n"))


def keyword_tags(spark: SparkSession, sf: str) -> DataFrame:
    own = quality.tagged(_chunks(spark, sf))
    return own.select("chunk_id", "regulatory_tagged", F.array_join("regulatory_keywords_found", ",").alias("found"), "regulatory_density_score")


def keyword_tags_words(spark: SparkSession, sf: str) -> DataFrame:
    own = quality.tagged(_chunks(spark, sf), SINGLE_WORDS)
    return own.select("chunk_id", "regulatory_tagged", F.array_join("regulatory_keywords_found", ",").alias("found"), "regulatory_density_score")


def tag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.tag_counts(quality.tagged(_chunks(spark, sf), SINGLE_WORDS))


def quality_signal_cache(spark: SparkSession, sf: str) -> DataFrame:
    chunks = _chunks(spark, sf)
    labels = table(spark, sf, "doc_labels").where("label is not null").groupBy("source_file").agg(F.min("label").alias("label"))
    cache = chunks.join(labels, "source_file").select(F.sha2("text", 256).alias("hash"), "label")
    return quality.with_signal(chunks, cache).select("chunk_id", "quality_classifier_label")


def entity_shapes(spark: SparkSession, sf: str) -> DataFrame:
    mail, tax, digits = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[A-Z]{5}[0-9]{4}[A-Z]", "[0-9]{9,}"
    counts = [F.regexp_count("text", F.lit(p)).alias(n) for n, p in (("mail", mail), ("tax", tax), ("digits", digits))]
    return _chunks(spark, sf).select("chunk_id", *counts).where("mail + tax + digits > 0")


def pii_redact(spark: SparkSession, sf: str) -> DataFrame:
    own = redact.redacted(_chunks(spark, sf))
    return own.select("chunk_id", "text", "validation_flag", "pii_redacted")


def pii_entity_totals(spark: SparkSession, sf: str) -> DataFrame:
    return redact.entity_totals(redact.redacted(_chunks(spark, sf)))


def pii_validation_report(spark: SparkSession, sf: str) -> DataFrame:
    report = redact.validation_report(redact.redacted(_chunks(spark, sf)))
    types = F.array_join(F.transform(F.array_sort(F.map_entries("entity_types")), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",")
    return report.withColumn("entity_types", types)


def pii_examples(spark: SparkSession, sf: str) -> DataFrame:
    found = redact.first_examples(redact.redacted(_chunks(spark, sf)).drop("doc_id"), "chunk_id")
    return found.select("entity_type", "nr", "doc_id", X.masked("entity_type", "before").alias("masked"))


def pii_examples_published(spark: SparkSession, sf: str) -> DataFrame:
    """The examples as they may be shown: values masked, contexts redacted."""
    return redact.publishable_examples(redact.first_examples(redact.redacted(_chunks(spark, sf)).drop("doc_id"), "chunk_id"))


def pii_stage_counters(spark: SparkSession, sf: str) -> DataFrame:
    return redact.stage_counters(redact.redacted(_chunks(spark, sf)))


def pii_eval(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.scores(table(spark, sf, "pii_gold"))


def pii_eval_public(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.public_hits(table(spark, sf, "pii_gold"))


def gold_problems(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.invalid(table(spark, sf, "pii_gold"))


def doc_drilldown(spark: SparkSession, sf: str) -> DataFrame:
    """Files with their chunks after deduplication, those of them the quality filter keeps, and those of these that redaction changed."""
    files, chunks = _files(spark, sf), _chunks(spark, sf)
    years = files.select("doc_id", X.document_year("doc_id", "text").alias("year"))
    # of a chunk whose record has no text the name alone tells the year
    dated = chunks.join(years, "doc_id", "left").withColumn("year", F.coalesce("year", X.year_in_name("doc_id")))
    single = written(dedup.deduplicated(dated).where("reason is null"), "single").drop("reason")
    kept = single.where(quality.quality_reason("text").isNull())
    return pipeline.drilldown(files, single, kept, redact.redacted(kept))


def token_stats_words(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_stats(_chunks(spark, sf))


def token_total(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.total(tokens.token_stats(_chunks(spark, sf)))


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).select("chunk_id", "doc_id", filters.failed_filters("text").alias("failed_filters"), quality.quality_reason("text").alias("reason"))


def compare_filters(spark: SparkSession, sf: str) -> DataFrame:
    return filters.per_filter(_judged(spark, sf))


def compare_simple_filters(spark: SparkSession, sf: str) -> DataFrame:
    simple = ["word_count", "non_alpha_numeric", "symbols_to_words", "numbers", "words_without_alphabets", "mean_word_length", "dup_5grams"]
    own = _judged(spark, sf).select("chunk_id", F.filter("failed_filters", lambda x: x.isin(*simple)).alias("f"))
    return own.where(F.size("f") > 0).select("chunk_id", F.array_join("f", ",").alias("failed"))


def compare_overlap(spark: SparkSession, sf: str) -> DataFrame:
    return filters.overlap(_judged(spark, sf))


def compare_by_doc(spark: SparkSession, sf: str) -> DataFrame:
    return filters.by_document(_judged(spark, sf))


def version_order(spark: SparkSession, sf: str) -> DataFrame:
    return versions.newest_first(_files(spark, sf)).select("doc_id", "year")


def sentence_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, sf).select("doc_id", F.size(X.sentences("text")).alias("sentences"))


def doc_families(spark: SparkSession, sf: str) -> DataFrame:
    return versions.families(_docs(spark, sf))


def version_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Each version of a family with the one after it, none after the last."""
    docs = _docs(spark, sf)
    return versions.next_versions(docs, versions.families(docs))


def changelog_pairs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf)
    return versions.changelog(docs, versions.families(docs)).select("family", "from_id", "to_id", "unchanged", "substantive", "cosmetic")


def tfidf_search(spark: SparkSession, sf: str) -> DataFrame:
    queries = table(spark, sf, "eval_items").select("item_id", "text")
    docs = table(spark, sf, "documents").where("text is not null").select("doc_id", "text")
    return search.search(queries, docs, "item_id", "doc_id").select("item_id", "place", "doc_id", "overlap", F.round("score", 4).alias("score"))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """(source_file, text, label, source): each file's text with its one label, written alike."""
    labels = table(spark, sf, "doc_labels").where("source_file is not null and label is not null").groupBy("source_file").agg(F.min(F.lower(F.trim("label"))).alias("label"), F.min("source").alias("source"))
    own = table(spark, sf, "cleaned_docs").where("text is not null")
    # what is known of a record goes to its texts, so that these are moved once; again only where several records are one file's
    names = own.groupBy("doc_id").agg(F.min("source_file").alias("source_file"))
    shared = names.groupBy("source_file").agg((F.count("*") > 1).alias("shared"))
    told = names.join(labels, "source_file").join(shared, "source_file")
    texts = own.select("doc_id", "text").unionByName(told, allowMissingColumns=True).groupBy("doc_id").agg(F.min("text").alias("text"), *(F.max(c).alias(c) for c in ("source_file", "label", "source", "shared"))).where("label is not null")
    several = texts.where("shared").groupBy("source_file").agg(F.min("text").alias("text"), F.max("label").alias("label"), F.max("source").alias("source"))
    columns = ["source_file", "text", "label", "source"]
    return texts.where("not shared").select(columns).unionByName(several.select(columns))


def doctype_centroid(spark: SparkSession, sf: str) -> DataFrame:
    cent, _ = search.centroids(_labelled(spark, sf), "source_file", "label")
    return cent.select("label", "term", F.round("weight", 9).alias("weight"))


def doctype_classify(spark: SparkSession, sf: str) -> DataFrame:
    docs = written(_labelled(spark, sf), "labelled")
    cent, idf = search.centroids(docs, "source_file", "label")
    out = search.classified(docs, "source_file", cent, idf, docs, "label")
    return out.select("source_file", "predicted", F.round("score", 6).alias("score"), F.round("margin", 6).alias("margin"), F.array_join("top", ",").alias("top"), "low_confidence")


def doctype_held_out(spark: SparkSession, sf: str) -> DataFrame:
    """Each file classified without itself; its near copies stay in training."""
    return search.held_out(_labelled(spark, sf), "source_file", "label")


def doctype_held_out_family(spark: SparkSession, sf: str) -> DataFrame:
    """Each file classified without its family of near copies."""
    docs = written(_labelled(spark, sf), "labelled")
    families = versions.families(docs.select(F.col("source_file").alias("doc_id"), "text")).withColumnRenamed("doc_id", "source_file")
    own = written(docs.join(families, "source_file", "left"), "labelled")
    return search.held_out(own, "source_file", "label", F.coalesce("family", "source_file"))


def doctype_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return search.accuracy(doctype_held_out(spark, sf), "label")


def doctype_accuracy_family(spark: SparkSession, sf: str) -> DataFrame:
    return search.accuracy(doctype_held_out_family(spark, sf), "label")


def label_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Files on one side only: labelled without a text, or with a text and no label."""
    a = table(spark, sf, "doc_labels").where("source_file is not null").select("source_file").distinct()
    b = table(spark, sf, "cleaned_docs").where("source_file is not null").select("source_file").distinct()
    return a.join(b, "source_file", "left_anti").withColumn("missing", F.lit("text")).unionByName(b.join(a, "source_file", "left_anti").withColumn("missing", F.lit("label")))


def page_location(spark: SparkSession, sf: str) -> DataFrame:
    docs = _files(spark, sf)
    pages = docs.select("doc_id", F.split("text", "\n\n", -1).alias("pages"))
    return located(clean.chunked(docs), pages).select("chunk_id", "page_start", "page_end")


def curated_output(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan over documents."""
    return pipeline.curate(_docs(spark, sf)).records


def curated_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The whole plan's chunks with what it says of each, as flat rows."""
    own = pipeline.curate(_docs(spark, sf)).chunks
    return own.select("chunk_id", "doc_id", "source_file", "text", "regulatory_tagged", F.array_join("regulatory_keywords_found", ",").alias("found"), "regulatory_density_score", "validation_flag", "pii_redacted")


def curated_stages(spark: SparkSession, sf: str) -> DataFrame:
    stages = pipeline.curate(_docs(spark, sf)).stages
    out = stages[0]
    for s in stages[1:]:
        out = out.unionByName(s)
    reasons = F.array_join(F.transform(F.array_sort(F.filter(F.map_entries("reason_counts"), lambda e: e["value"] > 0)), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",")
    return pipeline.kept_share(out).withColumn("reason_counts", reasons).withColumn("kept_share", F.round("kept_share", 9))


def curated_documents(spark: SparkSession, sf: str) -> DataFrame:
    joined = pipeline.joined_documents(pipeline.curate(_docs(spark, sf)).records)
    # a space stands between parts as well
    return joined.groupBy("source_file").agg((F.sum(F.length("text")) + F.count("*") - 1).cast("int").alias("n_chars"))


def residual_entities(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.residual(pipeline.curate(_docs(spark, sf)).records)


def queries() -> dict[str, Query]:
    """All of them, in the order of the plan."""
    return {k: v for k, v in globals().items() if callable(v) and getattr(v, "__module__", "") == __name__ and not k.startswith("_") and k not in ("queries",)}
