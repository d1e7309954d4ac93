"""SQL for the engine's own queries, for DuckDB over the same tables. Character classes are spelled out alike on both sides."""

from __future__ import annotations

from lamella.operators import filters, quality, redact
from lamella.plans import corpus_sql, redaction_sql
from lamella.plans.sql_parts import SPACE, words

_S = SPACE
_NS = "[^" + _S[1:]
_W = r"[\p{L}\p{N}_]"
_WORDS = rf"list_filter(regexp_split_to_array(text, '{_S}+'), lambda w: w <> '')"
_STRIP = rf"regexp_replace(%s, '^{_S}+|{_S}+$', '', 'g')"
_LINES = rf"array_to_string(list_filter(string_split(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), chr(10)), lambda x: not regexp_matches(x, '^{_S}*\p{{Nd}}{{1,4}}{_S}*$')), chr(10))"
_NORMAL = _STRIP % rf"regexp_replace(regexp_replace({_LINES}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"

_DOCS = "docs as (select cast(doc_id as varchar) doc_id, coalesce(source_file, 'doc_' || doc_id || '.pdf') source_file, coalesce(text, '') text, lang from documents)"
_CLEAN = f"{_DOCS}, clean as (select doc_id, lang, {_NORMAL} as text from docs), judged as (select doc_id, text, length(text) char_count, case when length(text) < 200 then 'too_short' when coalesce(lang, 'unknown') <> 'en' then 'non_english' end reason from clean)"
_YEAR_TEXT = rf"coalesce(list_max(list_transform(regexp_extract_all(text, '(?:^|[^\p{{L}}\p{{N}}_])(20[0-3]\p{{Nd}})(?:[^\p{{L}}\p{{N}}_]|$)', 1), lambda y: cast(y as int))), 0)"
_CUT = f"{_DOCS}, own as (select doc_id, source_file, {_WORDS} w from docs), wins as (select doc_id, source_file, unnest(range(0, greatest(len(w), 1), 180)) s, w from own), pieces as (select doc_id, source_file, s, array_to_string(w[s + 1 : s + 180], ' ') text from wins), cut as (select doc_id, source_file, text, cast(row_number() over (partition by doc_id order by s) - 1 as int) idx from pieces where length(text) >= 120)"
_CHUNKS = "own as (select distinct chunk_id, doc_id, source_file, text from chunks where text is not null)"
_FILES = "files as (select doc_id, min(source_file) source_file, min(text) text from cleaned_docs where text is not null group by doc_id)"
_TOKENS = rf"regexp_extract_all(lower(text), '{_W}+')"
_REASON = rf"""case when len(tok) < 15 then 'too_few_words'
  when length(regexp_replace(text, '[^A-Za-z]', '', 'g')) / greatest(length(text), 1) < 0.5 then 'low_alpha_ratio'
  when length(regexp_replace(text, '[\p{{L}}\p{{N}}]|{_S}', '', 'g')) / greatest(length(text), 1) > 0.3 then 'high_symbol_ratio'
  when len(list_distinct(tok)) / len(tok) < 0.2 then 'low_lexical_diversity' end"""
_JUDGED = f"{_CHUNKS}, t as (select *, {_TOKENS} tok from own), judged as (select chunk_id, doc_id, text, {_REASON} reason from t)"
_SEARCH = "list_filter(string_split(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: length(w) > 2)"
_SIG = rf"lower(regexp_replace({_STRIP % (f'''regexp_replace(line, '{_S}+', ' ', 'g')''')}, '\p{{Nd}}+', '#', 'g'))"
_STATS = rf"""{_FILES}, ls as (select doc_id, string_split(text, chr(10)) l from files), flat as (select doc_id, len(l) n_lines, unnest(l) line, unnest(range(len(l))) pos from ls),
 sig as (select doc_id, n_lines, pos, {_SIG} sig from flat), gaps as (select *, pos - lag(pos) over (partition by doc_id, sig order by pos) gap from sig where length(replace(sig, ' ', '')) >= 8),
 stats as (select doc_id, sig, count(*) occurrences, avg(gap) mean_gap, stddev_pop(gap) / avg(gap) gap_cv, (max(pos) - min(pos)) / max(n_lines) span from gaps group by doc_id, sig having count(*) > 1)"""
_SINGLE = "['kyc','aml','str','pep','sanctions','onboarding','reporting','screening','monitoring']"
_TAGGED = rf"""{_CHUNKS}, t as (select chunk_id, list_filter({_TOKENS}, lambda x: list_contains({_SINGLE}, x)) hits, greatest(len({_WORDS}), 1) n from own),
 tagged as (select chunk_id, len(list_distinct(hits)) >= 2 regulatory_tagged, array_to_string(list_sort(list_distinct(hits)), ',') found, round(least(1.0, len(hits) / n), 4) regulatory_density_score from t)"""
_LABELLED = f"""{_FILES}, lab as (select source_file, min(lower(trim(label))) label from doc_labels where source_file is not null and label is not null group by 1),
 txt as (select source_file, min(text) text from files where source_file is not null group by 1), docs as (select source_file, text, label from txt join lab using (source_file))"""


_RED = f"own as materialized (select distinct chunk_id, doc_id, source_file, text from chunks where text is not null), src as (select chunk_id || chr(0) || md5(text) k, text from own group by 1, 2), {redaction_sql.chain('src')}"
_PLACES = "unnest(regexp_extract_all(text, '\\[REDACTED_([A-Z_]+)\\]', 1))"
_GOLD = f"gold as (select id || chr(0) || md5(text) k, id, kind, text, pii from pii_gold), src as (select distinct k, text from gold), {redaction_sql.chain('src')}"
_VISIBLE = "least(2, length(regexp_replace(%s, '[^\\p{L}\\p{N}]', '', 'g')) // 3)"
# a mail address keeps its domain; of the rest, letters and digits after the visible ones are starred
_LOCAL = "case when kind = 'EMAIL' and contains(val, '@') then split_part(val, '@', 1) else val end"
_MASK = (
    f"array_to_string(list_transform(range(1, length({_LOCAL}) + 1), lambda i: case when regexp_matches(substr({_LOCAL}, cast(i as int), 1), '[\\p{{L}}\\p{{N}}]') and length(regexp_replace(left({_LOCAL}, cast(i as int)), '[^\\p{{L}}\\p{{N}}]', '', 'g')) > {_VISIBLE % _LOCAL} then '*' else substr({_LOCAL}, cast(i as int), 1) end), '')"
    " || case when kind = 'EMAIL' and contains(val, '@') then substr(val, instr(val, '@')) else '' end"
)


# of doc_id and text: a name's year, else the text's
_YEARS = rf"""yp as (select doc_id, text, regexp_extract(doc_id, '(^|[^0-9])(20[0-9][0-9])_([0-9][0-9])($|[^0-9])', 2) a, regexp_extract(doc_id, '(^|[^0-9])(20[0-9][0-9])_([0-9][0-9])($|[^0-9])', 3) b from %s),
 yq as (select doc_id, text, case when a <> '' then case when (cast(a as int) + 1) %% 100 = cast(b as int) then cast(a as int) + 1 else cast(a as int) end else coalesce(list_max(list_transform(regexp_extract_all(doc_id, '(?:^|[^0-9])(20[0-3][0-9])(?:$|[^0-9])', 1), lambda y: cast(y as int))), 0) end name_year from yp),
 years as (select doc_id, case when name_year > 0 then name_year else {_YEAR_TEXT} end as year from yq)"""
_DATED = f"{_CUT}, y as (select d.doc_id, {_YEAR_TEXT} yr from docs d), dated as (select doc_id || '__' || idx as chunk_id, doc_id, idx, text, yr from cut join y using (doc_id))"
_CUT_FILES = f"{_FILES}, own as (select doc_id, {_WORDS} w from files), wins as (select doc_id, unnest(range(0, greatest(len(w), 1), 180)) s, w from own), pieces as (select doc_id, s, array_to_string(w[s + 1 : s + 180], ' ') text from wins), dated as (select doc_id || '__' || idx chunk_id, * from (select doc_id, text, cast(row_number() over (partition by doc_id order by s) - 1 as int) idx, 0 yr from pieces where length(text) >= 120))"
_PAIRS_OF = """w as (select chunk_id, list_filter(regexp_split_to_array(lower(text), '{S}+'), lambda w: w <> '') w from c),
 s as (select distinct chunk_id, unnest(case when len(w) > 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [array_to_string(w, ' ')] end) g from w), n as (select chunk_id, count(*) n from s group by 1),
 p as (select a.chunk_id a, b.chunk_id b, count(*) k from s a join s b on a.g = b.g and a.chunk_id < b.chunk_id group by 1, 2)
 select a chunk_id_a, b chunk_id_b, round(k / (x.n + y.n - k), 6) similarity from p join n x on x.chunk_id = a join n y on y.chunk_id = b where k / (x.n + y.n - k) >= 0.8""".replace("{S}", SPACE)
# families: containment of runs of five words, then everything that can be reached
_FAMILIES = f"""{_DOCS}, fw as (select doc_id, {_TOKENS} w from docs), fs as (select distinct doc_id, unnest(case when len(w) > 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [array_to_string(w, ' ')] end) g from fw),
 fn as (select doc_id, count(*) n from fs group by 1), fp as (select a.doc_id a, b.doc_id b, count(*) k from fs a join fs b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
 fe as (select a, b from fp join fn x on x.doc_id = a join fn y on y.doc_id = b where k >= 0.7 * least(x.n, y.n) and least(x.n, y.n) >= 0.4 * greatest(x.n, y.n)),
 fb as (select a, b from fe union all select b, a from fe), fr(doc_id, other) as (select a, a from fb union select fr.doc_id, fb.b from fr join fb on fb.a = fr.other), fam as (select doc_id, min(other) family from fr group by 1)"""
# the eleven filters: as the simple ones, and the most frequent runs of 2, 3 and 4 words
_TOPS = " ".join(
    f", t{n} as (select chunk_id, max(c) * max(case when c = m then z end) share from (select *, max(c) over (partition by chunk_id) m from (select chunk_id, g, count(*) c, max(z) z from (select chunk_id, array_to_string(w[i : i + {n - 1}], chr(0)) g, length(array_to_string(w[i : i + {n - 1}], '')) z from (select chunk_id, w, unnest(range(1, len(w) - {n - 2})) i from a where len(w) >= {n})) group by 1, 2)) where m > 1 group by 1)"
    for n in (2, 3, 4)
)
_FAILED = rf"""{_CHUNKS}, a as (select chunk_id, doc_id, text, {_WORDS} w, {_TOKENS} tok, length(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g')) an, length(regexp_replace(text, '{_NS}', '', 'g')) sp, length(regexp_replace(text, '[^\p{{Nd}}]', '', 'g')) dg, len(regexp_extract_all(text, '#|\.\.\.|…')) sy, greatest(length(text), 1) sz from own){_TOPS},
 b as (select a.*, greatest(cast(list_sum(list_transform(w, lambda x: length(x))) as bigint), 1) chars, coalesce(t2.share, 0) s2, coalesce(t3.share, 0) s3, coalesce(t4.share, 0) s4, case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [] end g from a left join t2 using (chunk_id) left join t3 using (chunk_id) left join t4 using (chunk_id)),
 f as (select chunk_id, doc_id, {_REASON} reason, list_filter([case when not (len(w) between 50 and 100000) then 'word_count' end, case when (length(text) - an - sp) / sz > 0.25 then 'non_alpha_numeric' end, case when sy / greatest(len(w), 1) > 0.1 then 'symbols_to_words' end, case when dg / sz > 0.15 then 'numbers' end,
 case when len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) / greatest(len(w), 1) < 0.8 then 'words_without_alphabets' end, case when not ((length(text) - sp) / greatest(len(w), 1) between 3 and 10) then 'mean_word_length' end,
 case when s2 / coalesce(chars, 1) > 0.2 then 'top_2grams' end, case when s3 / coalesce(chars, 1) > 0.18 then 'top_3grams' end, case when s4 / coalesce(chars, 1) > 0.16 then 'top_4grams' end,
 case when len(g) > 0 and 1 - len(list_distinct(g)) / len(g) > 0.15 then 'dup_5grams' end, case when regexp_matches(lower(text), '{"|".join(filters.BOILERPLATE)}') then 'boilerplate' end], lambda x: x is not null) fl from b)"""
_CURATED = f"""{_CLEAN}, kept as (select j.doc_id, d.source_file, j.text from judged j join docs d on d.doc_id = j.doc_id where reason is null), {corpus_sql.healed('kept')},
 c_own as (select doc_id, source_file, {_WORDS} w from well), c_wins as (select doc_id, source_file, unnest(range(0, greatest(len(w), 1), 180)) s, w from c_own), c_pieces as (select doc_id, source_file, s, array_to_string(w[s + 1 : s + 180], ' ') text from c_wins),
 c_cut as (select doc_id, source_file, text, cast(row_number() over (partition by doc_id order by s) - 1 as int) idx from c_pieces where length(text) >= 120), c_y as (select doc_id, {_YEAR_TEXT} yr from well),
 c_dated as (select doc_id || '__' || idx as chunk_id, doc_id, idx, text, yr from c_cut join c_y using (doc_id)), {corpus_sql.deduplicated('c_dated')},
 c_single as (select chunk_id, doc_id, text, {_TOKENS} tok from dd where reason is null), c_judged as (select chunk_id, doc_id, text, {_REASON} reason from c_single), c_good as (select chunk_id, doc_id, text from c_judged where reason is null),
 {corpus_sql.keywords('c_good', quality.KEYWORDS)}, src as (select chunk_id k, text from c_good), {redaction_sql.chain('src')}"""
# each text's cosine to the mean of each label; norms over all terms of either side
_CLASSIFY = f"""{_LABELLED}, tk as (select source_file, label, {_SEARCH} t from docs), tf as (select source_file, label, term, count(*) f, max(total) total from (select source_file, label, len(t) total, unnest(t) term from tk) group by 1, 2, 3),
 nd as (select count(*) n from docs), df as (select term, count(*) df, ln((max(n) + 1) / (count(*) + 1)) + 1 idf, count(*) / max(n) > 0.5 common from tf, nd group by term), sizes as (select label, count(*) n from docs group by 1),
 cent as (select tf.label, tf.term, sum(f / total) / max(sizes.n) * max(idf) c from tf join df using (term) join sizes using (label) where not common group by 1, 2), cn as (select label, sqrt(sum(c * c)) cn from cent group by 1),
 q as (select source_file, term, f, idf from tf join df using (term) where not common), qk as (select source_file, sum(f) kept from q group by 1), v as (select source_file, term, f / kept * idf v from q join qk using (source_file)), vn as (select source_file, sqrt(sum(v * v)) vn from v group by 1),
 dots as (select source_file, label, sum(v * c) dot from v join cent using (term) group by 1, 2), every as (select source_file, l.label from docs, (select distinct label from docs) l),
 sc as (select every.source_file, every.label, coalesce(dot / (vn * cn), 0) score from every left join dots using (source_file, label) left join vn using (source_file) left join cn using (label)),
 rk as (select *, row_number() over (partition by source_file order by score desc, label) r, lead(score) over (partition by source_file order by score desc, label) runner_up from sc)"""


# every file classified by the others: what it adds to sums and document frequencies is taken off, term by term and label by label
_HELD = f"""{_LABELLED}, tk as (select source_file, label, {_SEARCH} t from docs), tf as (select source_file, label, term, count(*) f, max(total) total from (select source_file, label, len(t) total, unnest(t) term from tk) group by 1, 2, 3),
 nn as (select count(*) - 1 n from docs), df as (select term, count(*) df from tf group by term), sums as (select label, term, sum(f / total) s from tf group by 1, 2),
 grid as (select d.source_file g, s.label, s.term, s.s - case when d.label = s.label then coalesce(o.f / o.total, 0) else 0 end s, df.df - case when o.term is null then 0 else 1 end df from docs d cross join sums s join df on df.term = s.term left join tf o on o.source_file = d.source_file and o.term = s.term),
 cent as (select g, label, term, case when df > 0 and df <= 0.5 * n and s > 1e-15 then s * (ln((n + 1) / (df + 1)) + 1) else 0 end c from grid, nn), cn as (select g, label, sqrt(sum(c * c)) cn from cent group by 1, 2),
 q as (select source_file g, term, f, ln((n + 1) / (df - 1 + 1)) + 1 idf from tf join df using (term), nn where df - 1 <= 0.5 * n), qk as (select g, sum(f) kept from q group by 1), v as (select g, term, f / kept * idf v from q join qk using (g)), vn as (select g, sqrt(sum(v * v)) vn from v group by 1),
 dots as (select g, label, sum(v * c) dot from v join cent using (g, term) group by 1, 2), sizes as (select label, count(*) size from docs group by 1), every as (select d.source_file g, d.label truth, s.label from docs d, sizes s where size - case when d.label = s.label then 1 else 0 end > 0),
 sc as (select every.g, truth, every.label, coalesce(case when vn * cn > 0 then dot / (vn * cn) end, 0) score from every left join dots using (g, label) left join vn using (g) left join cn using (g, label)),
 rk as (select *, row_number() over (partition by g order by round(score, 9) desc, label) r, lead(score) over (partition by g order by round(score, 9) desc, label) runner_up, bool_or(label = truth) over (partition by g) able from sc),
 held as (select g source_file, truth as label, label predicted, round(score, 6) score, score - coalesce(runner_up, 0) < 0.05 low_confidence, able scored from rk where r = 1)"""


def oracle_sql() -> dict[str, str]:
    return {
        "doctype_held_out": f"with {_HELD} select * from held",
        "doctype_accuracy": f"""with {_HELD}, big as (select max(n) largest from (select count(*) n from held where scored group by label))
 select count(*) n_documents, count(*) filter (where scored) n_scored, avg(case when predicted = label then 1.0 else 0.0 end) filter (where scored) accuracy, avg(case when scored and predicted = label then 1.0 else 0.0 end) accuracy_of_all, avg(case when predicted = label then 1.0 else 0.0 end) filter (where scored and not low_confidence) confident_accuracy,
 avg(case when predicted = label then 1.0 else 0.0 end) filter (where scored and low_confidence) flagged_accuracy, max(largest) / count(*) filter (where scored) majority_baseline from held, big""",
        "keyword_tags": f"with {_CHUNKS}, {corpus_sql.keywords('own', quality.KEYWORDS)} select * from kw",
        "heal_documents": f"with {_FILES}, {corpus_sql.healed('files', 5, 0.5, 0.5, 5, 150)} select doc_id, length(text) char_count, repairs from well",
        "near_dup_chunks": f"with {_CHUNKS}, c as (select min(chunk_id) chunk_id, text from own group by text), {_PAIRS_OF}",
        "minhash_lsh_dedup": f"with {_DATED}, {corpus_sql.deduplicated('dated')} select chunk_id, doc_id, reason from dd",
        "heal_purity": rf"""with {_CUT_FILES}, {corpus_sql.deduplicated('dated')} select count(*) chunks, count(*) filter (where regexp_matches(text, '[\x{{900}}-\x{{97F}}]')) chunks_with_devanagari, count(*) filter (where regexp_matches(text, '\bP ?age\s*(\|\s*)?[0-9]+(\s+of\s+[0-9]+)?', 'i')) chunks_with_page_marker,
 cast(sum(len(list_filter(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'), lambda x: regexp_full_match(x, '[1-9][0-9]{{5}}')))) as bigint) pincode_spans, count(*) filter (where reason is not null) duplicate_chunks, (select cast(sum(length(text)) as bigint) from files) total_chars from dd""",
        "doc_families": f"with recursive {_FAMILIES} select doc_id, family from fam",
        "version_pairs": f"with recursive {_FAMILIES}, fy as (select doc_id, family, {_YEAR_TEXT} as year from fam join docs using (doc_id)) select family, doc_id, year, lead(doc_id) over (partition by family order by year, doc_id) next_id from fy",
        "compare_filters": f"with {_FAILED}, x as (select unnest(fl) flt, reason from f), names as (select unnest([{', '.join(repr(k) for k in filters.FILTERS)}]) flt) select names.flt as \"filter\", count(x.flt) removed, count(x.reason) also_removed_by_ours from names left join x using (flt) group by 1",
        "compare_overlap": f"with {_FAILED} select count(*) chunks, count(*) filter (where len(fl) > 0 and reason is not null) as both, count(*) filter (where len(fl) > 0 and reason is null) only_filters, count(*) filter (where len(fl) = 0 and reason is not null) only_own from f",
        "compare_by_doc": f"with {_FAILED} select doc_id, count(*) filter (where len(fl) > 0) filters, count(*) filter (where reason is not null) own from f group by 1 having filters > 0 or own > 0",
        "doctype_classify": f"""with {_CLASSIFY}, tops as (select source_file, string_agg(label, ',' order by r) top from rk where r <= 3 group by 1)
 select source_file, label predicted, round(score, 6) score, round(score - coalesce(runner_up, 0), 6) margin, top, score - coalesce(runner_up, 0) < 0.05 low_confidence from rk join tops using (source_file) where r = 1""",
        "curated_rows": f"""with {_CURATED} select g.chunk_id, g.doc_id, w.source_file, red.text as text, kw.regulatory_tagged, kw.found, kw.regulatory_density_score, case when review then 'needs_review' else 'confident' end validation_flag, shaped or named pii_redacted
 from c_good g join well w on w.doc_id = g.doc_id join kw on kw.chunk_id = g.chunk_id join red on red.k = g.chunk_id""",
        "curated_documents": f"""with {_CURATED} select w.source_file, cast(sum(length(red.text)) + count(*) - 1 as int) n_chars from c_good g join well w on w.doc_id = g.doc_id join red on red.k = g.chunk_id group by 1""",
        "curated_stages": f"""with {_CURATED}, st as (select 'clean_langid' stage, reason from judged union all select 'dedup', reason from dd union all select 'quality_filter', reason from c_judged union all select 'pii_redact', null from red),
 rc as (select stage, string_agg(reason || ':' || n, ',' order by reason) reason_counts from (select stage, reason, count(*) n from st where reason is not null group by 1, 2) group by 1)
 select st.stage, count(*) docs_in, count(*) filter (where reason is null) docs_out, count(*) filter (where reason is not null) removed, coalesce(max(reason_counts), '') reason_counts, round(count(*) filter (where reason is null) / count(*), 9) kept_share from st left join rc using (stage) group by 1""",
        "pii_redact": f"with {_RED} select chunk_id, red.text as text, case when review then 'needs_review' else 'confident' end validation_flag, shaped or named pii_redacted from own join red on red.k = chunk_id || chr(0) || md5(own.text)",
        "pii_entity_totals": f"with {_RED} select kind entity_type, count(*) n from ent join own on ent.k = chunk_id || chr(0) || md5(own.text) group by kind",
        "pii_validation_report": rf"""with {_RED}, out as (select chunk_id, doc_id, source_file, red.text as text, review, shaped or named hit from own join red on red.k = chunk_id || chr(0) || md5(own.text)),
 docs as (select doc_id, min(source_file) source_file, count(*) chunks, count(*) filter (where hit) chunks_with_pii, count(*) filter (where review) chunks_flagged_for_review, cast(sum(len(regexp_extract_all(text, '\[REDACTED_([A-Z_]+)\]', 1))) as bigint) pii_entities from out group by doc_id),
 types as (select doc_id, t, count(*) n from (select doc_id, {_PLACES} t from out) group by 1, 2), maps as (select doc_id, string_agg(t || ':' || n, ',' order by t) entity_types, cast(count(*) as int) distinct_entity_types from types group by 1)
 select docs.*, coalesce(entity_types, '') entity_types, coalesce(distinct_entity_types, 0) distinct_entity_types from docs left join maps using (doc_id)""",
        "pii_stage_counters": f"""with {_RED}, v as (select verdict from verd join own on verd.k = chunk_id || chr(0) || md5(own.text)), out as (select doc_id, review, shaped or named hit from own join red on red.k = chunk_id || chr(0) || md5(own.text))
 select (select count(*) from ent join own on ent.k = chunk_id || chr(0) || md5(own.text)) pii_entities_redacted, (select count(*) from out where hit) chunks_with_pii, (select count(distinct doc_id) from out where hit) documents_with_pii, (select count(*) from out where review) chunks_needing_review,
 {', '.join(f"(select count(*) from v where verdict = '{v}') {n}" for n, v in redact.COUNTERS.items())}, 'rules' pii_engine, false name_detection_available, 'no name model is given; names are found behind titles only' name_detection_error""",
        "pii_examples": f"""with {_RED}, every as (select kind, pass, place, val, k from ent union all select 'ACCOUNT_NUMBER_SUPPRESSED', 8, i, hit, k from account_number_v where verdict = 'account_suppressed'), e as (select kind, chunk_id, val, row_number() over (partition by kind order by chunk_id, pass, place) nr from every join own on every.k = chunk_id || chr(0) || md5(own.text))
 select kind entity_type, cast(nr as int) nr, chunk_id doc_id, {_MASK} masked from e where nr <= 6""",
        "pii_eval": f"""with {_GOLD}, own as (select gold.id, red.text as text, pii from gold join red using (k) where gold.kind <> 'public'), vals as (select id, text, unnest(pii) p from own), expd as (select id, p.type t, count(*) expected, count(*) filter (where contains(text, p.value)) leaked from vals group by 1, 2),
 got as (select id, t, count(*) found from (select id, {_PLACES} t from own) group by 1, 2), sides as (select t, coalesce(expected, 0) expected, coalesce(found, 0) found, coalesce(leaked, 0) leaked from expd full join got using (id, t))
 select t entity_type, cast(sum(expected) as bigint) expected, cast(sum(least(expected, found)) as bigint) hit, cast(sum(leaked) as bigint) leaked, cast(sum(greatest(found - expected, 0)) as bigint) false_alarms from sides group by t""",
        "pii_eval_public": f"with {_GOLD} select id, t entity_type, count(*) found from (select gold.id, {_PLACES.replace('(text', '(red.text')} t from gold join red using (k) where gold.kind = 'public') group by 1, 2",
        "normalize_text": f"with {_DOCS} select doc_id, {_NORMAL} as text from docs",
        "clean_filter": f"with {_CLEAN} select doc_id, cast(char_count as int) char_count, reason from judged",
        "detect_language": r"""with c as (select doc_id, lang, text, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{M}]+', ' ', 'g'), ''), lambda x: x <> '') a, list_filter(string_split(regexp_replace(lower(substr(coalesce(text, ''), 1, 3000)), '[^\p{L}\p{M}]+', ' ', 'g'), ''), lambda x: x <> '') b from documents),
 tr as (select lang, unnest(list_transform(range(1, len(a) - 1), lambda i: array_to_string(a[i : i + 2], ''))) g from c where lang is not null and text is not null and len(a) >= 3), n as (select lang, g, count(*) n from tr group by 1, 2), tot as (select lang, sum(n) total from n group by 1),
 prof as (select lang, g, ln(n + 1.0) weight from (select *, row_number() over (partition by lang order by n desc, g) r from n) where r <= 1000),
 own as (select doc_id, g, count(*) n from (select doc_id, unnest(list_transform(range(1, len(b) - 1), lambda i: array_to_string(b[i : i + 2], ''))) g from c where len(b) >= 3) group by 1, 2), sz as (select doc_id, sum(n) al from own group by 1),
 sc as (select doc_id, lang, round(sum(own.n * weight) + max(al) * -ln(max(total) + 1000.0), 6) score from own join prof using (g) join sz using (doc_id) join tot using (lang) group by 1, 2), best as (select doc_id, lang from (select *, row_number() over (partition by doc_id order by score desc, lang) r from sc) where r = 1)
 select documents.doc_id, coalesce(best.lang, 'unknown') lang from documents left join best on best.doc_id = documents.doc_id""",
        "clean_reasons": f"with {_CLEAN}, k as (select unnest(['too_short', 'non_english']) reason) select (select count(*) from judged) docs_in, (select count(*) from judged where reason is null) docs_out, (select count(*) from judged where reason is not null) removed, k.reason, (select count(*) from judged j where j.reason = k.reason) n from k",
        "chunk_documents": f"with {_CUT} select doc_id || '__' || idx as chunk_id, doc_id, idx, text from cut",
        "exact_dedup": f"with {_CUT}, y as (select d.doc_id, {_YEAR_TEXT} yr from docs d), r as (select cut.*, sha256(text) hash, row_number() over (partition by text order by -yr, cut.doc_id, idx) rn from cut join y using (doc_id)) select doc_id || '__' || idx as chunk_id, hash from r where rn = 1",
        "near_dup_pairs": f"""with {_CUT}, c as (select min(doc_id || '__' || idx) chunk_id, text from cut group by text), w as (select chunk_id, list_filter(regexp_split_to_array(lower(text), '{_S}+'), lambda w: w <> '') w from c),
 s as (select distinct chunk_id, unnest(case when len(w) > 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [array_to_string(w, ' ')] end) g from w), n as (select chunk_id, count(*) n from s group by 1),
 p as (select a.chunk_id a, b.chunk_id b, count(*) k from s a join s b on a.g = b.g and a.chunk_id < b.chunk_id group by 1, 2)
 select a chunk_id_a, b chunk_id_b, round(k / (x.n + y.n - k), 6) similarity from p join n x on x.chunk_id = a join n y on y.chunk_id = b where k / (x.n + y.n - k) >= 0.8""",
        "heal_line_stats": f"with {_STATS} select doc_id, sig, occurrences, round(mean_gap, 6) mean_gap, round(gap_cv, 6) gap_cv, round(span, 6) span from stats",
        "heal_furniture": f"with {_STATS} select doc_id, sig, occurrences from stats where occurrences >= 5 and span >= 0.5 and gap_cv <= 0.5 and mean_gap between 5 and 150",
        "vocab_counts": f"with {_FILES} select word, count(*) n from (select unnest(regexp_extract_all(lower(text), '[a-z]+')) word from files) group by word",
        "quality_reasons": f"with {_JUDGED} select chunk_id, reason from judged",
        "quality_counts": f"with {_JUDGED} select reason, count(*) n from judged group by reason",
        "keyword_tags_words": f"with {_TAGGED} select * from tagged",
        "tag_counts": f"with {_TAGGED} select count(*) filter (where regulatory_tagged) tagged, count(*) filter (where not regulatory_tagged) untagged, count(*) filter (where regulatory_density_score >= 0.05) high_density from tagged",
        "quality_signal_cache": f"with {_CHUNKS}, lab as (select source_file, min(label) label from doc_labels where label is not null group by 1), cache as (select text, min(label) label from own join lab using (source_file) group by text) select chunk_id, label quality_classifier_label from own left join cache using (text)",
        "entity_shapes": rf"with {_CHUNKS}, c as (select chunk_id, cast(len(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}')) as int) mail, cast(len(regexp_extract_all(text, '[A-Z]{{5}}[0-9]{{4}}[A-Z]')) as int) tax, cast(len(regexp_extract_all(text, '[0-9]{{9,}}')) as int) digits from own) select * from c where mail + tax + digits > 0",
        "gold_problems": "with g as (select id, text, kind, unnest(pii) p from pii_gold) select id, 'repeated id' problem from pii_gold group by id having count(*) > 1 union all select id, 'unknown kind' from pii_gold where kind is null or kind not in ('positive', 'negative', 'public') union all select id, 'value not in text' from g where not contains(text, p.value)",
        "doc_drilldown": f"""with {_FILES}, {_CHUNKS}, yd as (select doc_id, coalesce(files.text, '') text from (select distinct doc_id from own) left join files using (doc_id)), {_YEARS % 'yd'},
 dated as (select chunk_id, doc_id, cast(list_extract(string_split(chunk_id, '__'), -1) as int) idx, text, year yr from own join years using (doc_id)), {corpus_sql.deduplicated('dated')}, dt as (select chunk_id, doc_id, text, {_TOKENS} tok from dd where reason is null), dq as (select chunk_id, doc_id, text, {_REASON} reason from dt),
 src as (select chunk_id k, text from dq where reason is null), {redaction_sql.chain('src')}, n as (select doc_id, count(*) chunks, count(*) filter (where reason is null) kept_chunks, count(*) filter (where shaped or named) pii_chunks from dq left join red on red.k = chunk_id group by 1)
 select doc_id, source_file, coalesce(chunks, 0) chunks, coalesce(kept_chunks, 0) kept_chunks, coalesce(pii_chunks, 0) pii_chunks from files left join n using (doc_id)""",
        "token_stats_words": f"with {_CHUNKS} select source_file, count(*) chunks, cast(sum(len({_WORDS})) as bigint) tokens, 'words' tokenizer from own group by source_file",
        "token_total": f"with {_CHUNKS}, s as (select source_file, count(*) chunks, sum(len({_WORDS})) tokens from own group by source_file) select count(*) files, cast(sum(chunks) as bigint) chunks, cast(sum(tokens) as bigint) tokens from s",
        "compare_simple_filters": rf"""with {_CHUNKS}, a as (select chunk_id, text, {_WORDS} w, length(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g')) an, length(regexp_replace(text, '{_NS}', '', 'g')) sp, length(regexp_replace(text, '[^\p{{Nd}}]', '', 'g')) dg, len(regexp_extract_all(text, '#|\.\.\.|…')) sy, greatest(length(text), 1) sz from own),
 b as (select *, case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) else [] end g from a),
 f as (select chunk_id, list_filter([case when not (len(w) between 50 and 100000) then 'word_count' end, case when (length(text) - an - sp) / sz > 0.25 then 'non_alpha_numeric' end, case when sy / greatest(len(w), 1) > 0.1 then 'symbols_to_words' end, case when dg / sz > 0.15 then 'numbers' end,
 case when len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) / greatest(len(w), 1) < 0.8 then 'words_without_alphabets' end, case when not ((length(text) - sp) / greatest(len(w), 1) between 3 and 10) then 'mean_word_length' end,
 case when len(g) > 0 and 1 - len(list_distinct(g)) / len(g) > 0.15 then 'dup_5grams' end], lambda x: x is not null) fl from b)
 select chunk_id, array_to_string(fl, ',') failed from f where len(fl) > 0""",
        "version_order": f"with {_FILES}, {_YEARS % 'files'} select doc_id, year from years",
        "sentence_counts": rf"with {_FILES} select doc_id, cast(len(list_filter(string_split(regexp_replace({_STRIP % (f'''regexp_replace(text, '{_S}+', ' ', 'g')''')}, '([.;:]) ([A-Z(\p{{Nd}}])', '\1' || chr(10) || '\2', 'g'), chr(10)), lambda s: s <> '')) as int) sentences from files",
        "doctype_centroid": f"""with {_LABELLED}, tk as (select source_file, label, {_SEARCH} t from docs), tf as (select source_file, label, term, count(*) / max(total) f from (select source_file, label, len(t) total, unnest(t) term from tk) group by 1, 2, 3),
 df as (select term, count(*) df from tf group by 1), sizes as (select label, count(*) n from docs group by 1)
 select tf.label, tf.term, round(sum(f) / max(n), 9) weight from tf join df using (term) join sizes using (label) where df / (select count(*) from docs) <= 0.5 group by 1, 2""",
        "label_gate": "with a as (select distinct source_file from doc_labels where source_file is not null), b as (select distinct source_file from cleaned_docs where source_file is not null) select source_file, 'text' missing from a anti join b using (source_file) union all select source_file, 'label' from b anti join a using (source_file)",
        "tfidf_search": f"""with d as (select doc_id, {_SEARCH} t from documents where text is not null), q as (select item_id, {_SEARCH} t from eval_items),
 dt as (select doc_id, total, term, count(*) tf from (select doc_id, len(t) total, unnest(t) term from d) group by 1, 2, 3), qt as (select item_id, total, term, count(*) tf from (select item_id, len(t) total, unnest(t) term from q) group by 1, 2, 3),
 n as (select count(*) n from d), df as (select term, ln((max(n) + 1) / (count(*) + 1)) + 1 idf from dt, n group by term),
 qw as (select item_id, qt.term, tf / total * coalesce(idf, ln((select n from n) + 1) + 1) w, idf from qt left join df using (term)), qn as (select item_id, sqrt(sum(w * w)) qn from qw group by 1),
 dw as (select doc_id, dt.term, tf / total * idf v from dt join df using (term)), dn as (select doc_id, sqrt(sum(v * v)) dn from dw group by 1),
 dots as (select item_id, doc_id, count(*) overlap, sum(w * v) dot from qw join dw using (term) group by 1, 2), cand as (select *, row_number() over (partition by item_id order by overlap desc, doc_id) r from dots),
 sc as (select item_id, doc_id, overlap, dot / (qn * dn) score from cand join qn using (item_id) join dn using (doc_id) where r <= 60),
 best as (select *, row_number() over (partition by item_id order by score desc, overlap desc, doc_id) place from sc where score > 0) select item_id, cast(place as int) place, doc_id, overlap, round(score, 4) score from best where place <= 5""",
    }
