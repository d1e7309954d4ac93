"""Redaction as SQL, for DuckDB: one step a pass, each over the text that the one before left.

A text is cut at the places of a shape; what stands between them gives each place its surroundings, a gate gives its verdict, and the
text is put together again. Patterns have no look-around there, so runs of digits are marked first where a shape needs it, and
a separator that must come twice is spelled out.
"""

from __future__ import annotations

from lamella.functions.checkdigit import PERMUTATIONS, PRODUCTS
from lamella.operators import redact


def _q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_DAY, _MONTH, _YEAR = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|1[0-2])", "(?:19|20)[0-9]{2}"
_DATE = rf"\b(?:{_DAY}/{_MONTH}/{_YEAR}|{_DAY}\.{_MONTH}\.{_YEAR}|{_DAY}-{_MONTH}-{_YEAR})\b"
_SHAPES = {k: v.replace(r"\d", "[0-9]") for k, v in redact.SHAPES.items()} | {"DATE": _DATE}

_BARE = r"[\p{Nd}.,/-]*\p{Nd}[\p{Nd}.,/-]*"
_NEAR = "len(list_filter(regexp_split_to_array(right(bef, 80) || chr(10) || left(aft, 80), '\\s+'), lambda t: regexp_full_match(t, '" + _BARE + "')))"
_DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
_ONE_DIGIT = r"len(list_distinct(string_split(regexp_replace(hit, '[^\p{Nd}]', '', 'g'), ''))) = 1"
_TABLE = f"({_ONE_DIGIT} or {_NEAR} >= 3)"
_D = "[" + ", ".join(str(x) for row in PRODUCTS for x in row) + "]"
_P = "[" + ", ".join(str(x) for row in PERMUTATIONS for x in row) + "]"
# each digit with its place, the last one first: place * 10 + digit
_PLACED = f"list_transform(range(0, length({_DIGITS})), lambda i: cast(i * 10 + cast(substr(reverse({_DIGITS}), cast(i + 1 as int), 1) as int) as bigint))"
_CHECKED = f"list_reduce(list_prepend(cast(0 as bigint), {_PLACED}), lambda c, x: cast({_D}[cast(c * 10 + {_P}[cast((x // 10) % 8 * 10 + x % 10 + 1 as int)] + 1 as int)] as bigint)) = 0"


def _has(where: str, pattern: str, flags: str = "i") -> str:
    return f"regexp_matches({where}, {_q(pattern)}, '{flags}')"


def _window(size: int) -> str:
    return f"right(bef, {size}) || hit || left(aft, {size})"


_GATES = {
    "AADHAAR": f"""case when not {_has(_window(60), redact.AADHAAR_LABEL.pattern)} and {_TABLE} then 'aadhaar_rejected'
  when {_CHECKED} then 'take' when {_has(_window(60), redact.AADHAAR_LABEL.pattern)} then 'aadhaar_needs_review' else 'aadhaar_rejected' end""",
    "DATE": f"case when {_has('list_extract(string_split(right(bef, 30), chr(10)), -1)', redact.BIRTH.pattern)} then 'take' else 'date_no_cue' end",
    "PINCODE": f"""case when cast(left(hit, 2) as int) < 11 or {_has('right(bef, 25)', redact.PIN_MONEY.pattern)} then 'pincode_other'
  when {_has('right(bef, 25)', redact.PIN_LABEL.pattern)} or {_has('right(bef, 25)', redact.PIN_PLACE.pattern, 'c')} then 'take' else 'pincode_no_cue' end""",
    "SWIFT_BIC": f"case when {_has('right(bef, 60)', redact.SWIFT.pattern, 'c')} then 'take' else 'swift_no_cue' end",
    "ACCOUNT_NUMBER": f"""case when {_has(_window(90), redact.TELECOM.pattern)} then 'account_suppressed' when {_has(_window(90), redact.BANK.pattern)} then 'take'
  when {_TABLE} then 'account_rejected' else 'account_needs_review' end""",
}

_A, _B = r"\x01", r"\x02"
_MARKED = {
    "PHONE": (r"\p{Nd}+", rf"\+?{_A}91{_B}[-\s]{_A}[6-9]\p{{Nd}}{{9}}{_B}|\+?{_A}91[6-9]\p{{Nd}}{{9}}{_B}|{_A}[6-9]\p{{Nd}}{{9}}{_B}"),
    "ACCOUNT_NUMBER": (r"[\p{L}\p{N}_]+", rf"{_A}\p{{Nd}}{{9,18}}{_B}"),
}
_PLAIN = "replace(replace(%s, chr(1), ''), chr(2), '')"
_PART = r"(?:[A-Z]\.|[A-Z]{2,}|[A-Z][a-z]+)"
_NAMED = rf"{redact.TITLE}({_PART}(?:[ \t]+{_PART}){{0,4}})(?:\.?[,;:]?)(?:\s|$)"


def chain(source: str) -> str:
    """Steps of a with-clause over `source` (k, text, each k once) up to `red` (k, text, review, shaped, named), `ent` (k, kind, pass, place, value) and `verd` (k, verdict)."""
    out, before, ents, verdicts = [], source, [], []
    for i, (kind, shape) in enumerate(_SHAPES.items()):
        own = kind.lower()
        marked = kind in _MARKED
        if marked:
            # a run of digits, or of word characters, stands between two marks: where it begins and ends is part of the pattern
            run, shape = _MARKED[kind]
            out.append(f"{own}_m as (select k, regexp_replace(text, '({run})', chr(1) || '\\1' || chr(2), 'g') text from {before})")
            before = f"{own}_m"
        pattern = _q(shape)
        gate = _GATES.get(kind, "'take'")
        out.append(f"{own}_c as (select k, text, regexp_split_to_array(text, {pattern}) parts, regexp_extract_all(text, {pattern}) hits from {before})")
        out.append(f"{own}_u as (select k, parts, hits, unnest(range(1, len(hits) + 1)) i from {own}_c where len(hits) > 0)")
        out.append(
            f"{own}_w as (select k, i, hits[i] hit, array_to_string(list_transform(range(1, i), lambda j: parts[j] || hits[j]), '') || parts[i] bef,"
            f" parts[i + 1] || array_to_string(list_transform(range(i + 1, len(hits) + 1), lambda j: hits[j] || parts[j + 1]), '') aft from {own}_u)"
        )
        if marked:
            out.append(f"{own}_x as (select k, i, {_PLAIN % 'hit'} hit, {_PLAIN % 'bef'} bef, {_PLAIN % 'aft'} aft from {own}_w)")
        out.append(f"{own}_v as (select k, i, hit, {gate} verdict from {own}_{'x' if marked else 'w'})")
        out.append(f"{own}_l as (select k, list(case when verdict in ('take', 'account_needs_review', 'aadhaar_needs_review') then '[REDACTED_{kind}]' else hit end order by i) reps from {own}_v group by k)")
        text = f"case when reps is null then text else array_to_string(list_transform(range(1, len(reps) + 1), lambda j: parts[j] || reps[j]), '') || parts[len(reps) + 1] end"
        if marked:
            text = _PLAIN % text
        out.append(f"{own}_t as (select c.k, {text} text from {own}_c c left join {own}_l l on l.k = c.k)")
        ents.append(f"select k, '{kind}' kind, {i} pass, i place, hit val from {own}_v where verdict in ('take', 'account_needs_review', 'aadhaar_needs_review')")
        verdicts.append(f"select k, verdict from {own}_v where verdict <> 'take'")
        before = f"{own}_t"
    blocked = ", ".join(_q(w) for w in sorted(redact.NOT_NAMES))
    # names: cut at a title with its name, and what may stand behind it; the name's own place inside is found again
    full, n = _q(_NAMED), len(_SHAPES)
    words = r"list_transform(regexp_split_to_array(name, '[ \t]+'), lambda w: lower(rtrim(w, '.')))"
    caps = r"regexp_full_match(name, '[A-Z]{2,}(?:[ \t]+[A-Z]{2,})+')"
    initial = rf"(regexp_matches(name, '\b[A-Z]\.') and regexp_matches(name, '\b[A-Z][A-Za-z]'))"
    out.append(f"name_c as (select k, text, regexp_split_to_array(text, {full}) parts, regexp_extract_all(text, {full}) hits, regexp_extract_all(text, {full}, 1) names from {before})")
    out.append("name_u as (select k, hits, names, unnest(range(1, len(hits) + 1)) i from name_c where len(hits) > 0)")
    out.append(f"name_v as (select k, i, hits[i] hit, names[i] as name, ({caps} or {initial}) and len(list_intersect({words}, [{blocked}])) = 0 good from (select k, i, hits, names, names[i] as name from name_u))")
    out.append(f"name_l as (select k, list(case when good then regexp_extract(hit, {_q('^' + redact.TITLE)}) || '[REDACTED_PERSON_NAME]' || substr(hit, length(regexp_extract(hit, {_q('^' + redact.TITLE)})) + length(name) + 1) else hit end order by i) reps from name_v group by k)")
    out.append("name_t as (select c.k, case when reps is null then text else array_to_string(list_transform(range(1, len(reps) + 1), lambda j: parts[j] || reps[j]), '') || parts[len(reps) + 1] end text, contains(text, '[REDACTED_') shaped from name_c c left join name_l l on l.k = c.k)")
    ents.append(f"select k, 'PERSON_NAME' kind, {n} pass, -i place, name val from name_v where good")
    out.append("ent as (" + " union all ".join(ents) + ")")
    out.append("verd as (" + " union all ".join(verdicts) + ")")
    out.append(
        "red as (select t.k, t.text, coalesce(v.review, false) review, shaped, coalesce(p.named, false) named from name_t t left join (select k, bool_or(verdict in ('account_needs_review', 'aadhaar_needs_review')) review from verd group by k) v on v.k = t.k"
        " left join (select distinct k, true named from ent where kind = 'PERSON_NAME') p on p.k = t.k)"
    )
    return ",\n ".join(out)
