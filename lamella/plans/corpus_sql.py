"""Longer steps of the plan as SQL, for DuckDB: healing, banded deduplication, keywords. Each is a list of steps of a with-clause over named inputs."""

from __future__ import annotations

from lamella.operators.dedup import COEFFICIENTS, PRIME
from lamella.plans.sql_parts import SIGNATURE, SPACE, words


def healed(docs: str, repeats: int = 8, span: float = 0.5, cv: float = 0.5, least_gap: float = 10, most_gap: float = 150) -> str:
    """Over docs (doc_id, source_file, text), each id once: `well` (doc_id, source_file, text, repairs)."""
    return f"""h_ls as (select doc_id, string_split(text, chr(10)) l from {docs}), h_flat as (select doc_id, len(l) n_lines, unnest(l) line, unnest(range(len(l))) pos from h_ls),
 h_sig as (select doc_id, n_lines, pos, line, {SIGNATURE} sig from h_flat), h_gaps as (select *, pos - lag(pos) over (partition by doc_id, sig order by pos) gap from h_sig where length(replace(sig, ' ', '')) >= 8),
 h_stats as (select doc_id, sig, count(*) occurrences, avg(gap) mean_gap, stddev_pop(gap) / avg(gap) gap_cv, (max(pos) - min(pos)) / max(n_lines) span from h_gaps group by doc_id, sig having count(*) > 1),
 h_found as (select doc_id, sig from h_stats where occurrences >= {repeats} and span >= {span} and gap_cv <= {cv} and mean_gap between {least_gap} and {most_gap}),
 h_kept as (select doc_id, string_agg(line, chr(10) order by pos) text from h_sig anti join h_found using (doc_id, sig) group by doc_id),
 h_bare as (select d.doc_id, source_file, case when f.doc_id is null then d.text else coalesce(k.text, '') end as text from {docs} d left join (select distinct doc_id from h_found) f on f.doc_id = d.doc_id left join h_kept k on k.doc_id = d.doc_id),
 h_vocab as (select word, count(*) n from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) word from h_bare) group by word),
 h_cut as (select doc_id, source_file, text, regexp_extract_all(text, '[A-Za-z]+') t, regexp_split_to_array(text, '[A-Za-z]+') g from h_bare),
 h_pairs as (select doc_id, i, lower(t[i]) a, lower(t[i + 1]) b from (select doc_id, t, g, unnest(range(1, len(t))) i from h_cut) where g[i + 1] = ' '),
 h_good as (select p.doc_id, p.i from h_pairs p join h_vocab v on v.word = p.a || p.b and v.n >= 3 left join h_vocab x on x.word = p.a left join h_vocab y on y.word = p.b where least(coalesce(x.n, 0), coalesce(y.n, 0)) <= 2),
 h_runs as (select doc_id, i, i - row_number() over (partition by doc_id order by i) run from h_good), h_odd as (select doc_id, i, row_number() over (partition by doc_id, run order by i) k from h_runs),
 h_take as (select doc_id, list(i) taken from h_odd where k % 2 = 1 group by doc_id),
 well as (select c.doc_id, source_file, cast(coalesce(len(taken), 0) as int) repairs, case when taken is null then text else g[1] || array_to_string(list_transform(range(1, len(t) + 1), lambda i: t[i] || case when list_contains(taken, i) then '' else g[i + 1] end), '') end as text from h_cut c left join h_take on h_take.doc_id = c.doc_id)"""


def deduplicated(chunks: str, bands: int = 5, rows: int = 11, rounds: int = 8) -> str:
    """Over chunks (chunk_id, doc_id, idx, text, yr): `dd` (chunk_id, doc_id, text, reason). Chains of dependence of up to `rounds` near copies are followed."""
    mins = ", ".join(f"min((x * {a}::ubigint + {b}::ubigint) % {PRIME}::ubigint) m{j}" for j, (a, b) in enumerate(COEFFICIENTS[: bands * rows]))
    keys = ", ".join("'" + str(k) + ":' || " + " || ',' || ".join(f"m{k * rows + r}" for r in range(rows)) for k in range(bands))
    states = ["d_s0 as (select distinct ord, 0 st from d_bands)"]
    for r in range(rounds):
        states.append(
            f"d_s{r + 1} as materialized (select n.ord, case when n.st <> 0 then n.st when max(case when m.st = 1 then 1 else 0 end) = 1 then 2 when max(case when m.st = 0 then 1 else 0 end) = 0 then 1 else 0 end st"
            f" from d_s{r} n left join d_edges e on e.late = n.ord left join d_s{r} m on m.ord = e.early group by n.ord, n.st)"
        )
    return f"""d_all as (select *, row_number() over (order by -yr, doc_id, idx) ord, row_number() over (partition by text order by -yr, doc_id, idx) copy from {chunks}),
 d_w as (select ord, list_filter(regexp_split_to_array(lower(text), '{SPACE}+'), lambda w: w <> '') w from d_all where copy = 1),
 d_g as (select distinct ord, unnest(case when len(w) > 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [array_to_string(w, ' ')] end) g from d_w),
 d_x as (select ord, cast('0x' || substr(md5(g), 1, 8) as ubigint) x from d_g), d_m as (select ord, {mins} from d_x group by ord), d_bands as (select ord, unnest([{keys}]) band from d_m),
 d_edges as materialized (select distinct a.ord late, b.ord early from d_bands a join d_bands b on a.band = b.band and b.ord < a.ord),
 {", ".join(states)},
 d_of as (select late ord, min(early) early from d_edges e join d_s{rounds} m on m.ord = e.early and m.st = 1 group by late),
 dd as (select a.chunk_id, a.doc_id, a.text, case when a.copy > 1 then 'exact_duplicate' when s.st = 0 then 'undecided' when s.st = 2 then case when o.doc_id = a.doc_id then 'intra_doc_near_duplicate' else 'cross_doc_boilerplate' end end reason
  from d_all a left join d_s{rounds} s on s.ord = a.ord left join d_of f on f.ord = a.ord left join d_all o on o.ord = f.early)"""


def keywords(chunks: str, phrases: list[str]) -> str:
    """Over chunks (chunk_id, text), each id once: `kw` (chunk_id, regulatory_tagged, found, regulatory_density_score).

    Every place of every phrase is found; of one place the longest counts; then the longest phrase, the earlier of equals, pushes out what it overlaps, in
    five rounds, which is more than phrases overlap one another in a chain.
    """
    listed = ", ".join("'" + p.replace("'", "''") + "'" for p in phrases)
    inside = r"[\p{L}\p{N}_]"
    better = "b.chunk_id = c.chunk_id and b.s < c.s + c.n and c.s < b.s + b.n and (b.n > c.n or b.n = c.n and b.s < c.s)"
    rounds = ["k0 as (select *, 0 st from k_c)"]
    for r in range(5):
        rounds.append(
            f"k{r + 1} as materialized (select c.chunk_id, c.s, c.n, c.kw, case when c.st <> 0 then c.st when max(case when b.st = 1 then 1 else 0 end) = 1 then 2 when max(case when b.st = 0 then 1 else 0 end) = 0 then 1 else 0 end st"
            f" from k{r} c left join k{r} b on {better} group by c.chunk_id, c.s, c.n, c.kw, c.st)"
        )
    return f"""k_t as (select chunk_id, lower(text) x, greatest(len({words('text')}), 1) n_words from {chunks}), k_k as (select unnest([{listed}]) kw),
 k_o as (select chunk_id, x, kw, string_split(x, kw) p from k_t, k_k where contains(x, kw)),
 k_p as (select chunk_id, x, kw, length(kw) n, cast(list_sum(list_transform(p[1:i], lambda y: length(y))) + (i - 1) * length(kw) as int) s from (select *, unnest(range(1, len(p))) i from k_o)),
 k_b as (select chunk_id, kw, n, s from k_p where (s = 0 or not regexp_matches(substr(x, s, 1), '{inside}')) and not regexp_matches(substr(x, s + n + 1, 1), '{inside}')),
 k_c as (select chunk_id, s, max(n) n, arg_max(kw, n) kw from k_b group by chunk_id, s),
 {", ".join(rounds)},
 k_f as (select chunk_id, list_sort(list(distinct kw)) found, sum(len(string_split(kw, ' '))) words from k5 where st = 1 group by chunk_id),
 kw as (select t.chunk_id, coalesce(len(found), 0) >= 2 regulatory_tagged, coalesce(array_to_string(found, ','), '') as found, round(least(1.0, coalesce(words, 0) / n_words), 4) regulatory_density_score from k_t t left join k_f f on f.chunk_id = t.chunk_id)"""
