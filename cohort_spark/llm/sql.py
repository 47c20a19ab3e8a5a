"""The SQL that registered queries must agree with."""

from cohort_spark.llm.quality import FINE, LEAST_TEXTS, LEAST_WORDS, MEASURES, MOST_REPEATED
from cohort_spark.llm.secrets import ACCESS, ALPHABET, ASSIGN, ASSIGN_LEAST, HEX, ORDINARY, RANDOM_TOKEN, RATIO

WORDS = r"'[^\x20\x09-\x0D]+'"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SUBSTRINGS = f"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) as words from documents),
windows as (
  select doc_id, i, array_to_string(words[i:i + 49], ' ') as w
  from texts, unnest(range(1, len(words) - 48)) as t(i) where len(words) >= 50),
firsts as (select w, min(doc_id) as first_doc from windows group by w),
gone as (
  select doc_id, list_sort(list_distinct(flatten(list(range(i, i + 50))))) as places
  from windows join firsts using (w) where first_doc < doc_id group by doc_id)
select t.doc_id, len(words)::bigint as n_words, coalesce(len(places), 0)::bigint as n_removed,
  sha256(case when places is null then array_to_string(words, ' ') else coalesce(array_to_string(
    [words[i] for i in range(1, len(words) + 1) if not list_contains(places, i)], ' '), '') end) as kept_sha256
from texts t left join gone g on t.doc_id = g.doc_id"""

NEAR_DUPLICATES = f"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORDS}) as words from documents),
sets as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct([array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)]) end as s from texts),
items as (select doc_id, len(s) as n, unnest(s) as item from sets),
links as (
  select a.doc_id as x, b.doc_id as y from items a join items b on a.item = b.item and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x),
least as (select x, min(y) as y from reach group by x)
select s.doc_id, len(s.s)::bigint as n_shingles, least(s.doc_id, coalesce(l.y, s.doc_id)) as component_id,
  s.doc_id <= coalesce(l.y, s.doc_id) as kept
from sets s left join least l on s.doc_id = l.x"""

NGRAM_JOIN = f"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {WORDS}) as words from documents),
sets as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 4 then [array_to_string(words, ' ')]
    else list_distinct([array_to_string(words[i:i + 3], ' ') for i in range(1, len(words) - 2)]) end as s from texts),
items as (select doc_id, len(s) as n, unnest(s) as item from sets),
links as (
  select a.doc_id as x, b.doc_id as y from items a join items b on a.item = b.item and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach as (select x, y from links union select r.x, l.y from reach r join links l on r.y = l.x),
least as (select x, min(y) as y from reach group by x)
select s.doc_id, len(s.s)::bigint as n_shingles, least(s.doc_id, coalesce(l.y, s.doc_id)) as component_id
from sets s left join least l on s.doc_id = l.x"""

TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

LEXICAL_SEARCH = f"""
with texts as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {TERMS}) as w from documents),
asked as (
  select item_id, term, count(*) as times
  from (select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), {TERMS})) as term from benchmark) group by all),
counts as (select doc_id, n, term, count(*) as tf from (select doc_id, len(w) as n, unnest(w) as term from texts) group by all),
corpus as (select count(*)::bigint as documents, sum(len(w))::bigint as terms from texts where len(w) > 0),
weights as (
  select term, floor(1000 * ln((2 * documents + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
  from counts cross join corpus group by term, documents),
scored as (
  select item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * documents) // terms)))))::bigint as score
  from asked join counts using (term) join weights using (term) cross join corpus where doc_id is not null group by item_id, doc_id)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 10"""

TOP_K = """
with ints as (
  select vec_id, [floor(1024 * v::double)::bigint for v in embedding] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
    and vec_id is not null),
scores as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from ints q join ints c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scores qualify rank <= 10"""



def _level(name: str, keys: str) -> str:
    """Cutoffs of the sketches merged over everything but ``keys``."""
    by = f"{keys}, measure" if keys else "measure"
    return f"""merged_{name} as (select {by}, bucket, sum(n) as n from sketch group by {by}, bucket),
running_{name} as (select {by}, bucket, sum(n) over (partition by {by} order by bucket) as upto, sum(n) over (partition by {by}) as texts
  from merged_{name}),
edges_{name} as (select {by}, max(texts) as texts, min(bucket) filter (where upto >= 0.5::double * texts) as median,
  min(bucket) filter (where upto >= quantile * texts) as edge
  from running_{name} join rules using (measure) group by {by}),
{name} as (select {by}, texts, edge + case when above then 1 else -1 end * greatest(reach * abs(edge - median), slack) as cutoff
  from edges_{name} join rules using (measure))"""


_RULES = ", ".join(f"('{m.name}', {m.quantile}::double, {m.reach}, {m.slack}, {str(m.upper).lower()})" for m in MEASURES)
_LONG = " union all ".join(
    f"select lang, source, '{m.name}' as measure, ({m.value.replace(' div ', ' // ')})::bigint as v from measured where n_words > 0" for m in MEASURES
)
_CUTS = ", ".join(f"max(cutoff) filter (where measure = '{m.name}')::bigint as {m.name}_cut" for m in MEASURES)
_WITHIN = " and ".join(f"({m.value.replace(' div ', ' // ')}) {'<=' if m.upper else '>='} {m.name}_cut" for m in MEASURES)

QUALITY = f"""
with texts as (
  select doc_id, lang, source, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), {WORDS}) as w from documents),
windows as (select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c from texts, unnest(range(1, len(w) - 1)) as r(i)),
found as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from windows),
covered as (select doc_id, count(distinct place) as n from (select doc_id, unnest([i, i + 1, i + 2]) as place from found where n > 1) group by doc_id),
lined as (select doc_id, [x for x in string_split(t, chr(10)) if regexp_matches(x, {WORDS})] as lines from texts),
measured as (
  select t.doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
  from texts t join lined l on t.doc_id = l.doc_id left join covered c on t.doc_id = c.doc_id),
rules(measure, quantile, reach, slack, above) as (values {_RULES}),
sketch as (
  select lang, source, measure, (v >> greatest(length(bin(v)) - {FINE + 1}, 0)) << greatest(length(bin(v)) - {FINE + 1}, 0) as bucket, count(*) as n
  from ({_LONG}) group by all),
{_level("own", "lang, source")},
{_level("language", "lang")},
{_level("everything", "")},
cuts as (select o.lang, o.source, {_CUTS} from (
  select o.lang, o.source, o.measure,
    case when o.texts >= {LEAST_TEXTS} then o.cutoff when l.texts >= {LEAST_TEXTS} then l.cutoff else e.cutoff end as cutoff
  from own o join language l on o.lang is not distinct from l.lang and o.measure = l.measure join everything e on o.measure = e.measure) o
  group by o.lang, o.source),
judged as (
  select m.*, c.* exclude (lang, source), n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed
  from measured m left join cuts c on m.lang is not distinct from c.lang and m.source is not distinct from c.source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce({_WITHIN}, false) as kept, {", ".join(f"{m.name}_cut" for m in MEASURES)}
from judged"""


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _spans(kind: int, source: str, pattern: str, keep: str = "true", value: str = "m") -> str:
    """Places of all matches: the texts between matches and the matches alternate."""
    return f"""select doc_id, (list_sum([length(x) for x in parts[1:i]]) + coalesce(list_sum([length(x) for x in found[1:i - 1]]), 0))::bigint as start,
      {kind} as kind, length(found[i]) as m, found[i] as body, length(vals[i]) as v
    from (select doc_id, regexp_extract_all(t, {_text(pattern)}) as found, string_split_regex(t, {_text(pattern)}) as parts,
      regexp_extract_all(t, {_text(pattern)}, {value}) as vals from {source}) s, unnest(range(1, len(found) + 1)) as r(i)"""


_LETTERS = f"(select unnest(string_split('{ALPHABET}', '')) as c)"

# The models are fitted on all labelled strings, as in the operator.
SECRETS = f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
assigned as ({_spans(0, "texts", ASSIGN, value="1")}),
fixed as (
  select doc_id, start, kind, start + m as stop from assigned where v >= {ASSIGN_LEAST}
  union all select doc_id, start, kind, start + m from ({_spans(1, "texts", ACCESS, value="0")})
  union all select doc_id, start, kind, start + m from ({_spans(2, "texts", HEX, value="0")})),
stripped as (select doc_id, regexp_replace(regexp_replace(regexp_replace(t, {_text(ASSIGN)}, ' ', 'g'), {_text(ACCESS)}, ' ', 'g'), {_text(HEX)}, ' ', 'g') as t from texts),
strings as (
  select false as random, unnest(regexp_extract_all(t, {_text(ORDINARY)})) as s from stripped
  union all select true, unnest(list_distinct(list_concat(
    [x for x in regexp_extract_all(t, {_text(ASSIGN)}, 1) if length(x) >= {ASSIGN_LEAST}], regexp_extract_all(t, {_text(ACCESS)}), regexp_extract_all(t, {_text(HEX)})))) from texts),
pairs as (select random, s[i] as a, s[i + 1] as b, count(*) as n from strings, unnest(range(1, length(s))) as r(i) group by all),
grid as (
  select x.c as a, y.c as b, coalesce(p.n, 0) as seen, coalesce(q.n, 0) as other from {_LETTERS} x cross join {_LETTERS} y
  left join pairs p on p.random and p.a = x.c and p.b = y.c left join pairs q on not q.random and q.a = x.c and q.b = y.c),
model as (
  select a, b, round(1000 * ln((0.5::double / {len(ALPHABET)} + 0.5::double * case when sum(seen) over (partition by a) > 0
    then seen / sum(seen) over (partition by a) else 1.0::double / {len(ALPHABET)} end)
    / ((other + 1) / (sum(other) over (partition by a) + {len(ALPHABET)}))))::bigint as score from grid),
candidates as (
  select c.doc_id, c.start, c.start + c.m as stop, c.body from ({_spans(3, "texts", RANDOM_TOKEN, value="0")}) c
  where not exists (select 1 from fixed f where f.doc_id = c.doc_id and f.start < c.start + c.m and c.start < f.stop)),
added as (
  select doc_id, start, 3 as kind, stop from candidates c, unnest(range(1, length(body))) as r(i)
  join model on model.a = c.body[i] and model.b = c.body[i + 1]
  group by doc_id, start, stop having sum(score) >= {RATIO} * (stop - start - 1)),
every as (select * from fixed union all select * from added),
said as (select *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start || ':' || stop as words from every),
listed as (
  select doc_id, {", ".join(f"count(*) filter (where kind = {k}) as n{k}" for k in range(4))},
    string_agg(words, ',' order by start, kind) filter (where kind < 3) as base, string_agg(words, ',' order by start, kind) as spans
  from said group by doc_id)
select doc_id, {", ".join(f"coalesce(n{k}, 0)::bigint as n_{name}" for k, name in enumerate(("assign", "access", "hex", "random")))},
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from texts left join listed using (doc_id)"""
