"""How well redaction does on a labelled set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions.show import percent
from lamella.operators.redact import PLACEHOLDER, redacted


#: Kinds of labelled items, and the types of their values.
KINDS = ("positive", "negative", "public")
TYPES = ("PAN", "AADHAAR", "EMAIL", "PHONE", "DATE", "PINCODE", "CIN", "SWIFT_BIC", "ACCOUNT_NUMBER", "PERSON_NAME", "ADDRESS")


def invalid(gold: DataFrame, kinds: tuple[str, ...] = KINDS, types: tuple[str, ...] = TYPES) -> DataFrame:
    """(id, problem): repeated ids, unknown kinds or types, values that aren't in the text."""
    again = gold.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit("repeated id").alias("problem"))
    unknown = gold.where(~F.col("kind").isin(*kinds) | F.col("kind").isNull()).select("id", F.lit("unknown kind").alias("problem"))
    missing = gold.select("id", "text", F.explode("pii").alias("p")).where(~F.contains(F.col("text"), F.col("p.value"))).select("id", F.lit("value not in text").alias("problem"))
    odd = gold.select("id", F.explode("pii").alias("p")).where(~F.coalesce(F.col("p.type").isin(*types), F.lit(False))).select("id", F.lit("unknown type").alias("problem"))
    return again.unionByName(unknown).unionByName(odd).unionByName(missing)


def scores(gold: DataFrame, people=None) -> DataFrame:
    """(entity_type, expected, hit, leaked, false_alarms): hits are placeholders up to those expected, surplus ones false alarms; a value that still stands verbatim has leaked. Public items are apart."""
    own = redacted(gold.where("kind <> 'public'").select("id", "text", "pii"), people).select("id", "text", "pii")
    exp = own.select("id", F.explode("pii").alias("p")).groupBy("id", F.col("p.type").alias("entity_type")).agg(F.count("*").alias("expected"))
    got = own.select("id", F.explode(F.regexp_extract_all("text", F.lit(PLACEHOLDER), F.lit(1))).alias("entity_type")).groupBy("id", "entity_type").agg(F.count("*").alias("found"))
    leak = own.select("id", "text", F.explode("pii").alias("p")).where(F.contains(F.col("text"), F.col("p.value"))).groupBy("id", F.col("p.type").alias("entity_type")).agg(F.count("*").alias("leaked"))
    both = exp.join(got, ["id", "entity_type"], "full").join(leak, ["id", "entity_type"], "left").fillna(0, ["expected", "found", "leaked"])
    return both.groupBy("entity_type").agg(
        F.sum("expected").alias("expected"),
        F.sum(F.least("expected", "found")).alias("hit"),
        F.sum("leaked").alias("leaked"),
        F.sum(F.greatest(F.col("found") - F.col("expected"), F.lit(0))).alias("false_alarms"),
    )


def public_hits(gold: DataFrame, people=None) -> DataFrame:
    """(id, entity_type, found): placeholders in public items, whose contact details should stay."""
    own = redacted(gold.where("kind = 'public'").select("id", "text"), people)
    return own.select("id", F.explode(F.regexp_extract_all("text", F.lit(PLACEHOLDER), F.lit(1))).alias("entity_type")).groupBy("id", "entity_type").agg(F.count("*").alias("found"))


def summary(result: DataFrame, public: DataFrame, gold: DataFrame) -> dict:
    """scores() and public_hits() as one small dict with totals; shares are null where nothing was expected."""
    rows = [r.asDict() for r in result.orderBy("entity_type").collect()]  # a row a type
    total = {k: sum(r[k] for r in rows) for k in ("expected", "hit", "leaked", "false_alarms")}
    kinds = {r["kind"]: r["count"] for r in gold.groupBy("kind").count().collect()}
    share = {"recall": total["hit"] / total["expected"] if total["expected"] else None, "precision": total["hit"] / (total["hit"] + total["false_alarms"]) if total["hit"] + total["false_alarms"] else None}
    return {"items": kinds, "per_type": rows, "totals": total, **share, "public_items_hit": public.select("id").distinct().count()}


def report(found: dict) -> str:
    """The summary as a document."""
    total = found["totals"]
    lines = ["# How well redaction does on the labelled set", "", f"Items: {', '.join(f'{n} {k}' for k, n in sorted(found['items'].items()))}.", ""]
    lines.append(f"Of {total['expected']} values {total['hit']} have the right placeholder ({percent(found['recall'])}), {total['leaked']} are still visible; {total['false_alarms']} false alarms (precision {percent(found['precision'])}).")
    lines += [f"Public items redacted: {found['public_items_hit']}.", "", "| Type | Values | Hit | Leaked | False alarms |", "|---|---|---|---|---|"]
    return "\n".join([*lines, *(f"| {r['entity_type']} | {r['expected']} | {r['hit']} | {r['leaked']} | {r['false_alarms']} |" for r in found["per_type"])]) + "\n"


def stale(text: str, path: str) -> bool:
    """Whether the document at a path isn't this one."""
    try:
        with open(path, encoding="utf-8") as f:
            return f.read() != text
    except FileNotFoundError:
        return True
