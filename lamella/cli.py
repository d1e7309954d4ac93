"""Command line: run, filters, tokens."""

from __future__ import annotations

import argparse
import json
import sys

from lamella import __version__


def refresh(spark, source: str, target: str) -> None:
    """Totals and masked examples of a curated folder, published together or, where redaction would still find anything, not at all."""
    from pyspark.sql import functions as F

    from lamella.operators import redact
    from lamella.plans.pipeline import residual
    from lamella.schemas import CURATED
    from lamella.sources import files

    records = spark.read.schema(CURATED).json(source)
    found = records.select(F.explode(F.regexp_extract_all("text", F.lit(redact.PLACEHOLDER), F.lit(1))).alias("entity_type")).groupBy("entity_type").agg(F.count("*").alias("n"))
    by_file = records.groupBy(F.col("metadata.source_file").alias("source_file")).agg(F.count("*").alias("chunks"), F.sum(F.length("text")).alias("chars")).orderBy("source_file")
    totals = {"entity_totals": [r.asDict() for r in found.orderBy(F.desc("n"), "entity_type").collect()], "files": [r.asDict() for r in by_file.toLocalIterator()]}
    files.publish({"summary.json": json.dumps(files.without_paths(totals), ensure_ascii=False, indent=2)}, target, residual(records))


def main(argv: list[str] | None = None) -> int:
    """0 done, 1 stopped with a reason, 2 wrong use."""
    p = argparse.ArgumentParser(prog="lamella")
    p.add_argument("--version", action="version", version=__version__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="curate a parquet table or JSON folder of documents")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--language", default="en")
    run.add_argument("--compare", action="store_true")
    flt = sub.add_parser("filters", help="comparison filters over a file of chunks")
    flt.add_argument("--input", required=True)
    flt.add_argument("--output", required=True)
    tok = sub.add_parser("tokens", help="token statistics of a curated file")
    tok.add_argument("input", nargs="?")
    tok.add_argument("-i", dest="named_input")
    tok.add_argument("-o", "--output")
    tok.add_argument("--tokenizer", default="words", help="words, or a file of a public byte-level vocabulary (.tiktoken)")
    new = sub.add_parser("refresh", help="publish what views need, masked, from a curated folder")
    new.add_argument("--input-dir", required=True)
    new.add_argument("--output-dir", required=True)
    args = p.parse_args(argv)
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from lamella.operators import clean, filters, tokens
    from lamella.plans.pipeline import curate
    from lamella.sources import files

    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("lamella").getOrCreate()
    try:
        if args.command == "run":
            docs = clean.adapted(spark.read.parquet(args.input)) if args.input.endswith(".parquet") else files.documents(spark, args.input)
            out = curate(docs, args.language, compare=args.compare, stop=True)
            done = files.write_curated(out.records, args.output)
            print(f"{done['records']} records, {done['chars']} characters")
            for s in out.summary():
                print(f"{s['stage']:16} in {s['docs_in']:>9} out {s['docs_out']:>9} removed {s['removed']:>9}")
        elif args.command == "filters":
            rows = files.chunk_file(spark, args.input).withColumn("failed_filters", filters.failed_filters("text"))
            rows.where(F.size("failed_filters") == 0).select(F.col("record").alias("value")).write.mode("overwrite").text(args.output)
            for r in filters.per_filter(rows.withColumn("reason", F.lit(None).cast("string"))).collect():
                print(f"{r['filter']:26} {r['removed']}")
        elif args.command == "refresh":
            refresh(spark, args.input_dir, args.output_dir)
        else:
            path = args.input or args.named_input
            if not path:
                p.error("an input is needed")
            count, name = tokens.tokenizer(args.tokenizer)
            stats = tokens.token_stats(files.curated_strict(spark, path), count, name)
            rows = [r.asDict() for r in stats.orderBy("source_file").toLocalIterator()]
            text = json.dumps({"files": rows, "tokens": sum(r["tokens"] for r in rows)}, ensure_ascii=False, indent=2)
            files.write_atomically(args.output, text) if args.output else print(text)
    except (ValueError, RuntimeError) as e:
        print(f"stopped: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
