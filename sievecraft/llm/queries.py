"""The registered queries of this subpackage, and SQL for those that SQL can express.

Fingerprints by XXH64 (op1), sampled models (op2), graph searches (op3), tokens (op4, op8, op9) and the template tree (op10)
have none; tests hold them against brute force.
"""

from __future__ import annotations

from . import ann, bpe, lines, packing, pitman_yor, quality, secrets, simhash, urls
from .common import UPPER, table

QUERIES = {
    "op1_simhash": lambda spark, d: simhash.query(table(spark, d, "documents")),
    "op2_pitman_yor": lambda spark, d: pitman_yor.query(table(spark, d, "documents")),
    "op3_nearest_neighbours": lambda spark, d: ann.query(table(spark, d, "embeddings")),
    "op4_best_fit_packing": lambda spark, d: packing.query_best_fit(table(spark, d, "documents")),
    "op5_secret_scans": lambda spark, d: secrets.query(table(spark, d, "documents")),
    "op6_line_dedup": lambda spark, d: lines.query(table(spark, d, "documents")),
    "op7_quality_rules": lambda spark, d: quality.query(table(spark, d, "documents")),
    "op8_bpe": lambda spark, d: bpe.query(table(spark, d, "documents")),
    "op9_token_output": lambda spark, d: packing.query_matrices(table(spark, d, "documents")),
    "op10_url_filters": lambda spark, d: urls.query(table(spark, d, "pages"), table(spark, d, "labels")),
}

_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_WORD_CHARS = r"length(regexp_replace({0}, '[\x20\x09-\x0D]', '', 'g'))"
_SYMBOLS = "length(regexp_replace({0}, '[^#*$%&|<>]', '', 'g'))"
_HAS_WORD = r"regexp_matches({0}, '[^\x20\x09-\x0D]')"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _line_fails(x: str, rules: quality.Rules) -> str:
    n, separators = f"len({_WORDS.format(x)})", f"length(regexp_replace({x}, '[^|»›•]', '', 'g'))"
    phrases = " or ".join(f"contains(lower({x}), {_quoted(p)})" for p in rules.boilerplate)
    return f"""({_HAS_WORD.format(x)} and ({_SYMBOLS.format(x)} * 100 > {_WORD_CHARS.format(x)} * {rules.max_symbol_percent} or ({separators} >= {rules.nav_separators} and {n} <= ({separators} + 1) * {rules.nav_words})
  or len(regexp_extract_all({x}, '[!?]{{2}}')) * 100 > {n} * {rules.max_bang_percent} or (({phrases}) and {n} <= {rules.boilerplate_words})))"""


def _quality(rules: quality.Rules = quality.Rules()) -> str:
    return f"""with d as (select doc_id, coalesce(text, '') as t from documents),
w as (select doc_id, t, {_WORDS.format('t')} as ws, string_split(t, chr(10)) as ls from d),
f as (select *, list_filter(ls, lambda x: {_HAS_WORD.format('x')}) as lw, list_filter(ls, lambda x: {_line_fails('x', rules)}) as bad from w),
i as (select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 1))) as i from w where len(ws) > 2),
win as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as x from i),
twice as (select doc_id, i from win qualify count(*) over (partition by doc_id, x) > 1),
rep as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by doc_id),
c as (select doc_id, len(ws)::bigint as n_words, {_WORD_CHARS.format('t')}::bigint as word_chars, {_SYMBOLS.format('t')}::bigint as n_symbols, (len(lw) - len(list_distinct(lw)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
  coalesce(list_sum(list_transform(bad, lambda x: {_WORD_CHARS.format('x')})), 0)::bigint as lost_chars, len(bad)::bigint as lines_failed from f left join rep using (doc_id)),
b as (select *, n_words < {rules.min_words} or 100 * n_repeat_words > {rules.max_repeat_percent} * n_words as base_failed from c)
select *, not base_failed and 100 * lost_chars <= {rules.max_lost_percent} * word_chars as kept from b"""


_LINES = f"""with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, translate(trim(line, {_BLANK}), '{UPPER}', '{UPPER.lower()}') as key from l),
shared as (select key, max(doc_id) as keeper from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
j as (select k.*, coalesce(doc_id <> keeper, false) as gone from k left join shared using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256 from j group by doc_id"""


def _secrets(own: secrets.Ownership = secrets.Ownership()) -> str:
    found = []
    for rank, (kind, pattern, group, least) in enumerate(secrets.BASE + secrets.WIDER):
        p = _quoted(pattern)
        found.append(
            f"select doc_id, source, {rank} as rank, '{kind}' as kind, gap, a, v, i, length(v) >= {least} as good from (select doc_id, source, unnest(string_split_regex(t, {p})) as gap, unnest(list_concat(regexp_extract_all(t, {p}), [null])) as a, "
            f"unnest(list_concat(regexp_extract_all(t, {p}, {group}), [null])) as v, generate_subscripts(string_split_regex(t, {p}), 1) as i from d where regexp_matches(t, {p}))"
        )
    base = len(secrets.BASE)
    return f"""with d as (select doc_id, source, coalesce(text, '') as t from documents),
m as ({' union all '.join(found)}),
placed as (select *, sum(length(gap)) over w + coalesce(sum(length(a)) over (partition by doc_id, rank order by i rows between unbounded preceding and 1 preceding), 0) as s from m window w as (partition by doc_id, rank order by i rows unbounded preceding)),
spans as (select doc_id, source, rank, kind, s::bigint as s, (s + length(a))::bigint as e, v from placed where good),
b as (select * from spans where rank < {base}),
x as (select * from spans c where rank >= {base} and (kind <> 'random' or (regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]'))) and length(regexp_replace(v, '[^0-9]', '', 'g')) >= {own.min_digits}
  and len(list_distinct(string_split(v, ''))) >= {own.min_distinct_chars} and not exists (select 1 from b where b.doc_id = c.doc_id and b.s < c.e and c.s < b.e)),
o as (select v, count(distinct coalesce(source, chr(0))) as repositories, count(distinct coalesce(split_part(source, '{own.owner_separator}', 1), chr(0))) as owners from (select v, source from b union all select v, source from x) group by v),
xl as (select x.*, owners <= {own.max_owners} and repositories <= {own.max_repositories} as live from x join o using (v)),
every as (select doc_id, rank, kind, s, e, true as live from b union all select doc_id, rank, kind, s, e, live from xl),
g as (select doc_id, {', '.join(f"count(*) filter (kind = '{k}') as n_{k}" for k, *_ in secrets.BASE)}, string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < {base}) as based,
  string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (live) as spans, count(*) filter (not live) as n_example from every group by doc_id)
select d.doc_id, {', '.join(f"coalesce(n_{k}, 0)::bigint as n_{k}" for k, *_ in secrets.BASE)}, sha256(coalesce(based, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_example, 0)::bigint as n_example from d left join g using (doc_id)"""


ORACLES: dict[str, str] = {"op5_secret_scans": _secrets(), "op6_line_dedup": _LINES, "op7_quality_rules": _quality()}
