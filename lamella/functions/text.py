"""Column builders for text. All are built-in expressions, so they stay inside the JVM and its generated code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word character of Unicode, spelled out so that every engine agrees.
WORD = r"[\p{L}\p{N}_]"
#: White space as str.split() sees it, and its complement.
SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_SPACE = "[^" + SPACE[1:]


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once a row, however often body uses it, inside its own functions as well."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: str | Column) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(col(text), f"^{SPACE}+|{SPACE}+$", "")


def normalize(text: str | Column) -> Column:
    """Control characters and lines of one to four digits dropped, spaces and blank lines collapsed, ends stripped; null stays null."""
    clean = F.regexp_replace(col(text), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    lines = F.filter(F.split(clean, "\n", -1), lambda x: ~x.rlike(rf"^{SPACE}*\p{{Nd}}{{1,4}}{SPACE}*$"))
    joined = F.regexp_replace(F.array_join(lines, "\n"), "[ \t]+", " ")
    return strip(F.regexp_replace(joined, "\n{3,}", "\n\n"))


def words(text: str | Column) -> Column:
    """Stretches without white space."""
    return F.filter(F.split(col(text), f"{SPACE}+", -1), lambda w: w != "")


def word_tokens(text: str | Column) -> Column:
    """Runs of word characters, in lower case."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(f"{WORD}+"), F.lit(0))


def windows(items: Column, size: int, step: int = 1, sep: str = " ") -> Column:
    """Runs of `size` consecutive items joined; one, of all items, where there are fewer."""

    def cut(own: Column) -> Column:
        last = F.greatest(F.size(own) - size, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last, F.lit(step)), lambda i: F.array_join(F.slice(own, i + 1, size), sep))

    return let(items, cut)


def shingles(items: Column, size: int = 5) -> Column:
    """Distinct runs of `size` words."""
    return F.array_distinct(windows(items, size))


def chunks(text: str | Column, size: int = 180, least: int = 120) -> Column:
    """Consecutive windows of `size` words of at least `least` code points."""

    def cut(own: Column) -> Column:
        n = F.ceil(F.size(own) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.array_join(F.slice(own, i * size + 1, size), " "))

    return F.filter(let(words(text), cut), lambda x: F.length(x) >= least)


def signature(line: str | Column) -> Column:
    """A line in lower case, spaces collapsed, digit runs masked."""
    flat = strip(F.regexp_replace(col(line), f"{SPACE}+", " "))
    return F.lower(F.regexp_replace(flat, r"\p{Nd}+", "#"))


def year_in_text(text: str | Column) -> Column:
    """The latest of the years 2000 to 2039 that stand alone in a text, else 0."""
    found = F.regexp_extract_all(col(text), F.lit(rf"(?<!{WORD})20[0-3]\p{{Nd}}(?!{WORD})"), F.lit(0))
    return F.coalesce(F.array_max(F.transform(found, lambda y: y.cast("int"))), F.lit(0))


def year_in_name(name: str | Column) -> Column:
    """The latest year of a file name, else 0: a pair like 2024_25 is its second year if that follows the first, else the first one."""
    pair = r"(?<![0-9])(20[0-9]{2})_([0-9]{2})(?![0-9])"
    starts = F.regexp_extract_all(col(name), F.lit(pair), F.lit(1))
    ends = F.regexp_extract_all(col(name), F.lit(pair), F.lit(2))
    pairs = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.when((p["a"].cast("int") + 1) % 100 == p["b"].cast("int"), p["a"].cast("int") + 1).otherwise(p["a"].cast("int")))
    rest = F.regexp_replace(col(name), pair, " ")
    plain = F.transform(F.regexp_extract_all(rest, F.lit(r"(?<![0-9])20[0-3][0-9](?![0-9])"), F.lit(0)), lambda y: y.cast("int"))
    return F.coalesce(F.array_max(F.concat(pairs, plain)), F.lit(0))


def document_year(name: str | Column, text: str | Column) -> Column:
    """The name's year, or else the text's."""
    own = year_in_name(name)
    return F.when(own > 0, own).otherwise(year_in_text(text))


def sentences(text: str | Column) -> Column:
    """Cut behind . ; : where a capital, a digit or a bracket follows."""
    flat = strip(F.regexp_replace(col(text), f"{SPACE}+", " "))
    return F.filter(F.split(flat, r"(?<=[.;:]) (?=[A-Z(\p{Nd}])", -1), lambda s: s != "")


def search_tokens(text: str | Column) -> Column:
    """Words of letters a to z and digits, longer than two."""
    flat = F.regexp_replace(F.lower(col(text)), r"[^a-z0-9]+", " ")
    return F.filter(F.split(flat, " +", -1), lambda w: F.length(w) > 2)


def masked(kind: str | Column, value: str | Column) -> Column:
    """A value with all but its first letters or digits (two at most, and at most a third) starred; a mail address keeps its domain."""
    kind, value = col(kind), col(value)

    def stars(v: Column) -> Column:
        seen = F.least(F.lit(2), F.floor(F.length(F.regexp_replace(v, r"[^\p{L}\p{N}]", "")) / 3).cast("int"))
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("n"))

        def step(acc: Column, c: Column) -> Column:
            solid = c.rlike(r"^[\p{L}\p{N}]$")
            shown = F.when(solid & (acc["n"] >= seen), "*").otherwise(c)
            return F.struct(F.concat(acc["out"], shown).alias("out"), (acc["n"] + solid.cast("int")).alias("n"))

        return F.aggregate(F.split(v, "", -1), start, step, lambda acc: acc["out"])

    at = F.instr(value, "@")
    mail = F.concat(stars(F.substring_index(value, "@", 1)), F.lit("@"), F.substr(value, at + 1))
    return F.when((kind == "EMAIL") & (at > 0), mail).otherwise(stars(value))


def band(score: str | Column, high: float = 0.7, moderate: float = 0.4) -> Column:
    """High, Moderate or Low similarity."""
    return F.when(col(score) >= high, "High similarity").when(col(score) >= moderate, "Moderate similarity").otherwise("Low similarity")
