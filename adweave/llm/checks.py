"""DuckDB SQL that computes what the queries return, in another way."""

QUALITY = r"""
with t as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (
  select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws, string_split(text, chr(10)) as ls
  from t),
m as (
  select rid, doc_id, len(ws) as n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
         list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as full_lines
  from w),
g as (
  select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g
  from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from w) u),
twice as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) as n from g) c where n > 1),
covered as (
  select rid, count(distinct p) as n
  from (select rid, unnest([i, i + 1, i + 2]) as p from twice) u group by rid),
r as (
  select m.*, len(full_lines)::bigint as n_lines,
         (len(full_lines) - len(list_distinct(full_lines)))::bigint as n_dup_lines,
         coalesce(c.n, 0) as n_repeat_words
  from m left join covered c using (rid)),
b as (
  select *, case when n_words < 50 then 1 else 0 end::bigint
         + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
         + case when 100 * n_symbols > 10 * n_words then 4 else 0 end
         + case when 100 * n_dup_lines > 40 * n_lines then 8 else 0 end
         + case when word_chars < 3 * n_words then 16 else 0 end
         + case when word_chars > 12 * n_words then 32 else 0 end as failed_bits
  from r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits % 4 <> 0 as base_failed, failed_bits = 0 as kept, failed_bits
from b
"""


def _pii_kind(name: str, order: int, pattern: str, keeps: str) -> str:
    """Spans of one kind: RE2 finds matches and gaps, window sums give positions."""
    return f"""
select rid, doc_id, {order} as ord, '{name}' as kind, s as start, s + length(m) as stop
from (
  select *, sum(length(gap) + length(m)) over (partition by rid order by i) - length(m) as s
  from (
    select rid, doc_id, unnest(range(1, len(ms) + 1)) as i, unnest(ms) as m,
           unnest(gaps[1:len(ms)]) as gap
    from (select rid, doc_id, regexp_extract_all(text, '{pattern}') as ms,
                 string_split_regex(text, '{pattern}') as gaps from t) x) y) z
where {keeps}"""


_LUHN = """len(d) between 14 and 19 and list_sum(list_transform(range(1, len(d) + 1), lambda i:
  case when (len(d) - i) % 2 = 0 then d[i]::int
       else (2 * d[i]::int) // 10 + (2 * d[i]::int) % 10 end)) % 10 = 0"""
_IBAN = """list_reduce(list_transform(string_split(replace(m, ' ', '')[5:] || replace(m, ' ', '')[:4], ''),
  lambda c: case when c between '0' and '9' then ascii(c) - 48 else ascii(c) - 55 end),
  lambda a, c: case when c < 10 then (a * 10 + c) % 97 else (a * 100 + c) % 97 end) = 1"""
_NO_LETTER = "[^0-9]"
PII = f"""
with t as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
f as (
{_pii_kind("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true")}
union all
{_pii_kind("ip", 1, r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
           "list_max(list_transform(string_split(m, '.'), lambda p: p::hugeint)) <= 255")}
union all
{_pii_kind("card", 2, r"[0-9](?:[\x20-]?[0-9])+",
           _LUHN.replace("d[i]", "regexp_replace(m, '[^0-9]', '', 'g')[i]")
           .replace("len(d)", "len(regexp_replace(m, '[^0-9]', '', 'g'))"))}
union all
{_pii_kind("phone", 3, r"\+[0-9][\x20().0-9-]+[0-9]",
           "length(regexp_replace(m, '[^0-9]', '', 'g')) between 10 and 15")}
union all
{_pii_kind("iban", 4, r"\b[A-Z][A-Z][0-9][0-9](?: ?[A-Z0-9]){11,30}\b", _IBAN)}
union all
select s.rid, doc_id, ord, kind, start, stop
from ({_pii_kind("ssn", 5, r"\b[0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9][0-9][0-9]\b",
                 "m[1:3] not in ('000', '666') and m[1:1] <> '9' and m[5:6] <> '00' "
                 "and m[8:] <> '0000'")}) s join (select rid, text from t) x on s.rid = x.rid
where text[start:start] <> '-' and text[stop + 1:stop + 1] <> '-'
  and regexp_matches(lower(text[greatest(1, start - 39):start]), '(^|[^a-z])(ssn|social|security)'))
select t.doc_id, count(*) filter (kind = 'email') as n_email,
       count(*) filter (kind = 'ip') as n_ip, count(*) filter (kind = 'card') as n_card,
       count(*) filter (kind = 'phone') as n_phone, count(*) filter (kind = 'iban') as n_iban,
       count(*) filter (kind = 'ssn') as n_ssn,
       sha256(coalesce(string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ','
              order by start, ord) filter (ord < 4), '')) as base_sha256,
       coalesce(string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ','
                order by start, ord), '') as spans
from t left join f using (rid) group by t.rid, t.doc_id
"""

_WORDS2 = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
DECONTAM = f"""
with i as (select item_id, {_WORDS2} as ws from benchmark),
w as (
  select distinct item_id, least(10, len(ws)) as n,
         array_to_string(ws[s:s + least(10, len(ws)) - 1], ' ') as win
  from (select *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as s from i where len(ws) > 0) u),
d as (select row_number() over () as rid, doc_id, {_WORDS2} as ws from documents),
lens as (select distinct n from w),
p as (
  select rid, s, n, array_to_string(ws[s:s + n - 1], ' ') as win
  from (select rid, ws, n, unnest(range(1, len(ws) - n + 2)) as s from d, lens) u),
o as (select rid, s, p.n, item_id from p join w on p.win = w.win and p.n = w.n),
c as (
  select rid, count(distinct x) as n_hit
  from (select rid, unnest(range(s, s + n)) as x from o) u group by rid),
t as (
  select rid, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct rid, item_id::varchar as item from o) u group by rid)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join c using (rid) left join t using (rid)
"""

_HEAD = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?"""
SECRETS = f"""
with t as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
f as (
{_pii_kind("assign", 0, _HEAD + "[A-Za-z0-9+/_.=-]+",
           "length(m) - length(regexp_extract(m, '^" + _HEAD + "')) >= 8")}
union all
{_pii_kind("access", 1, "AKIA[A-Z0-9]+", "length(m) >= 16")}
union all
{_pii_kind("hex", 2, "[0-9a-f]+", "length(m) >= 32")}
union all
{_pii_kind("github", 3, "gh[opsu]_[A-Za-z0-9]+", "length(m) >= 40")}
union all
{_pii_kind("slack", 4, "xox[abprs]-[A-Za-z0-9-]+", "length(m) >= 15")}
union all
{_pii_kind("google", 5, "AIza[A-Za-z0-9_-]+", "length(m) >= 39")}
union all
{_pii_kind("jwt", 6, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "length(m) >= 30")}
union all
{_pii_kind("pem", 7, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true")})
select t.doc_id, count(*) filter (kind = 'assign') as n_assign,
       count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
       sha256(coalesce(string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ','
              order by start, ord) filter (ord < 3), '')) as base_sha256,
       coalesce(string_agg(kind || ':' || start::bigint || ':' || stop::bigint, ','
                order by start, ord), '') as spans
from t left join f using (rid) group by t.rid, t.doc_id
"""

_FAILS = {"A": "len(ws) < 100", "B": "100 * len(list_distinct(ws)) < 80 * len(ws)",
          "C": "100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)",
          "D": "regexp_matches(text, '[#$%&*|]')",
          "E": "coalesce(min(doc_id) over (partition by text) < doc_id, false)"}
# Every document meets every order; the filter that removes it is the first failing one.
FILTER_AUDIT = f"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
m as (
  select doc_id, part, {" || ".join(f"case when {c} then '{f}' else '' end" for f, c in _FAILS.items())} as failing
  from d),
l as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id),
c as (
  select part, failing, count(*) as n, count(*) filter (quality = 1) as good,
         count(*) filter (toxic = 1) as toxic
  from m left join l using (doc_id) group by part, failing),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (
  select a.f || b.f || c.f || d.f || e.f as filter_order
  from x a, x b, x c, x d, x e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s as (
  select c.*, filter_order, coalesce(list_min(list_filter(range(1, 6),
         lambda i: contains(failing, filter_order[i]))), 6) as gone
  from c, o),
r as (
  select part, filter_order, step::int as step, filter_order[step] as f,
         sum(case when gone > step then n else 0 end)::bigint as kept,
         sum(case when gone = step then n else 0 end)::bigint as removed,
         sum(case when gone < step and contains(failing, filter_order[step]) then n else 0 end)::bigint as redundant,
         sum(case when failing = filter_order[step] then n else 0 end)::bigint as unique_fails,
         sum(case when gone = step then good else 0 end)::bigint as good_lost,
         sum(case when gone = step then toxic else 0 end)::bigint as toxic_lost
  from s, (select unnest(range(1, 6)) as step) group by part, filter_order, step)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, f))::bigint as shapley
from r
"""
