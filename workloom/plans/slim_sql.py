"""The text rules and the snapshot stated a second time, as DuckDB SQL, for the oracle.

DuckDB's regular expressions know neither look-around nor Cyrillic word edges. Texts are therefore
lower-cased, their blanks made ordinary, and their Cyrillic letters written as capital Latin ones
before the pay patterns are applied; letters of no pattern share one capital.
"""

from __future__ import annotations

from workloom.functions import extract, regions, rules
from workloom.operators import slim as slim_op

_USED = "абвгдезиклмнопрстухчыьяфц"
_FROM = "абвгдеёжзийклмнопрстуфхцчшщъыьэюя"
_CAPITALS = dict(zip(_USED, "ABCDEFGHIJKLMNOPQRSTUVWXY"))
_TO = "".join(_CAPITALS.get(c, "Z") for c in _FROM)
_BLANKS = "               　  \u0085"
_WIDE_DIGITS = "".join(map(chr, range(0xFF10, 0xFF1A)))


def _caps(pattern: str) -> str:
    return pattern.translate(str.maketrans(_FROM, _TO)).replace("'", "''")


def plain(text: str) -> str:
    """Lower case, no links, ordinary blanks and digits, Cyrillic as capitals."""
    spaced = f"translate(lower({text}), '{_BLANKS}{_WIDE_DIGITS}', '{' ' * len(_BLANKS)}0123456789')"
    return f"translate(regexp_replace({spaced}, 'https?://\\S+', ' ', 'g'), '{_FROM}', '{_TO}')"


_N = r"\d{1,3}(?:\s\d{3})+|\d+"
_X = r"к|k|тыс\.?|т\.?\s*р(?:\.\B|\b)|тр\b|тыр\b|тысяч[аиу]?|млн\.?|миллион[аов]*"
_ROUBLE = r"руб(?:\.\B|л(?:ь|я|ей)\b|\b)"
_M = rf"(?:[$€₽]|\busd\b|\bdollars?\b|\beur\b|\beuros?\b|\brur\b|\brub\b|{_ROUBLE}|р(?:\.\B|\b))"
_AMOUNT = rf"(?:{_M}\s*)?({_N})\s*({_X})?(?:\s*{_M})?"
_BOTH = rf"(?:от|from)\s*{_AMOUNT}\s*(?:[-—–]\s*)?(?:до|to)\s*{_AMOUNT}"
_DASH = rf"{_AMOUNT}\s*(?:[-—–]\s*(?:(?:up\s+)?to|до)?|\b(?:to|до)\b)\s*{_AMOUNT}"
_ONE = rf"({_N})\s*({_X})?"
_RUR = rf"₽|{_ROUBLE}|\brur\b|\brub\b|\d\s*(?:к|k|тыс|млн)\b|\d\s*т\.?\s*р\.?|\d\s*тр\b|\d\s*тыр\b|\d\s*р(?:\.\B|\b)"
_ABOUT = r"зарплат|заработн|зп\b|оклад|доход|компенсац|вилка|salary|compensation|gross|(?:^|[^.])\bnet\b|на\s+руки|до\s+вычета|после\s+вычета"
_HOUR = r"/\s*(?:час|hour|hr)\b|per\s+hour|почасов\w*|\bв\s+час\b|за\s+час\b|руб\.?\s*/\s*час|₽\s*/\s*час"
_YEAR = r"/\s*(?:year|yr)\b|per\s+year|annually|годов(?:ая|ой|ых|ого|ому|ое|ую)\b|\bв\s+год\b"


def _has(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{_caps(pattern)}')"


def _around(start: str, end: str, before: int, after: int | None = None) -> str:
    """The characters around [start, end) of s, positions from 1."""
    return f"substr(s, greatest(1, {start} - {before}), {end} + {before if after is None else after} - greatest(1, {start} - {before}))"


def _number(digits: str, times: str) -> str:
    return f"(case when length(regexp_replace({digits}, '\\D', '', 'g')) > 15 then 999999999999999 else cast(regexp_replace({digits}, '\\D', '', 'g') as bigint) end * case when {_has(times, '^(?:млн|миллион)')} then 1000000 when {times} <> '' then 1000 else 1 end)"


def pay_ctes(texts: str) -> str:
    """CTEs that end in pay(id, lo, hi, cur, disclosed) for a relation texts(id, t)."""
    limits = "v between case when cur in ('USD', 'EUR') then 500 else 10000 end and case when cur in ('USD', 'EUR') then 200000 else 10000000 end"
    unpaid = lambda a, b: f"((cur is null and not {_has(_around(a, b, 60), _ABOUT)}) or {_has(_around(a, b, 40), _HOUR)})"
    share = lambda a, b: f"case when {_has(_around(a, b, 40), _YEAR)} then 12 else 1 end"

    def ranged(name: str, pattern: str) -> str:
        p = _caps(pattern)
        part = lambda k: f"regexp_extract(s, '{p}', {k})"
        return f"""{name}0 as (select id, s, cur, {part(0)} as m, strpos(s, {part(0)}) as a, {part(1)} as n1, {part(2)} as m1, {part(3)} as n2, {part(4)} as m2 from pay_s where {_has('s', pattern)}),
{name}1 as (select id, cur, {unpaid('a', 'a + length(m)')} as unpaid, {share('a', 'a + length(m)')} as share, {_number('n1', "case when m1 <> '' then m1 else m2 end")} as x, {_number('n2', "case when m2 <> '' then m2 else m1 end")} as y from {name}0),
{name} as (select id, cur, unpaid, least(x // share, y // share) as lo, greatest(x // share, y // share) as hi, {limits.replace('v ', '(x // share) ')} and {limits.replace('v ', '(y // share) ')} as fits from {name}1)"""

    one = _caps(_ONE)
    return f"""pay_t as (select id, {plain('t')} as s from {texts} where t is not null and t <> ''),
pay_s as (select id, s, case when {_has('s', r'[$]|\busd\b|\bdollars?\b|долл')} then 'USD' when {_has('s', r'€|\beur\b|\beuros?\b|евро')} then 'EUR' when {_has('s', _RUR)} then 'RUR' end as cur from pay_t),
{ranged('pay_both', _BOTH)},
{ranged('pay_dash', _DASH)},
pay_m as (select id, s, cur, regexp_extract_all(s, '{one}', 0) as ms, regexp_extract_all(s, '{one}', 1) as ns, regexp_extract_all(s, '{one}', 2) as xs from pay_s),
pay_at as (select id, s, cur, ms, ns, xs, 1 as k, strpos(s, ms[1]) as a from pay_m where len(ms) > 0
  union all select id, s, cur, ms, ns, xs, k + 1, strpos(substr(s, a + length(ms[k])), ms[k + 1]) + a + length(ms[k]) - 1 from pay_at where k < len(ms)),
pay_v as (select id, k, cur, {unpaid('a', 'a + length(ms[k])')} as unpaid, {_number('ns[k]', 'xs[k]')} // {share('a', 'a + length(ms[k])')} as v, substr(s, a + length(ms[k])) as rest, substr(s, greatest(1, a - 20), a - greatest(1, a - 20)) as before from pay_at),
pay_ok as (select id, k, v, {_has('before', r'\bдо\s|\bup\s+to\s')} and not {_has('before', r'\bот\s|\bfrom\s')} as most from pay_v
  where not unpaid and {limits} and not ({_has('rest', r'^\s*руб\w')} and not {_has('rest', r'^\s*рубл(?:ь|я|ей)\b')})),
pay_one as (select id, arg_min(v, k) as v, arg_min(most, k) as most from pay_ok group by id),
pay as (select p.id, p.cur,
    case when b.unpaid then null when b.fits then b.lo when d.unpaid then null when d.fits then d.lo when not o.most then o.v end as lo,
    case when b.unpaid then null when b.fits then b.hi when d.unpaid then null when d.fits then d.hi when o.most then o.v end as hi,
    case when b.unpaid then false when b.fits then true when d.unpaid then false when d.fits then true else o.v is not null end as disclosed
  from pay_s p left join pay_both b using (id) left join pay_dash d using (id) left join pay_one o using (id))"""


def years_ctes(texts: str) -> str:
    """CTEs that end in years(id, years) for a relation texts(id, t)."""
    unit = "(?:лет|года|year)"
    each = rf"(?i)(?:от|более|свыше)\s*(\d{{1,2}})\s*{unit}|(\d{{1,2}})\s*\+\s*{unit}"
    named = rf"(?i)опыт[а]?\s+(?:работы\s+)?(?:от\s+)?(\d{{1,2}})\s*{unit}"
    about = r"(?i)опыт|стаж|experience|requirement|требу|лет\s+работ|years\s+work|years\s+of"
    return f"""years_m as (select id, t, regexp_extract_all(t, '{each}', 0) as ms, list_transform(range(1, len(regexp_extract_all(t, '{each}', 0)) + 1), lambda i: coalesce(nullif(regexp_extract_all(t, '{each}', 1)[i], ''), regexp_extract_all(t, '{each}', 2)[i])) as ns,
  regexp_extract_all(t, '{named}', 1) as sure from {texts} where t is not null),
years_at as (select id, t, ms, ns, 1 as k, strpos(t, ms[1]) as a from years_m where len(ms) > 0
  union all select id, t, ms, ns, k + 1, strpos(substr(t, a + length(ms[k])), ms[k + 1]) + a + length(ms[k]) - 1 from years_at where k < len(ms)),
years_n as (select id, cast(ns[k] as int) as n from years_at where regexp_matches(substr(t, greatest(1, a - 70), a + length(ms[k]) + 50 - greatest(1, a - 70)), '{about}')
  union all select id, cast(unnest(sure) as int) from years_m),
years as (select id, max(n) as years from years_n where n between 1 and 20 group by id)"""


def skills_of(text: str) -> str:
    """The sorted default skills that a text names."""
    word = r"[^\p{L}\p{N}_]"
    clean = f"regexp_replace(lower({text}), 'https?://\\S+', ' ', 'g')"
    names = sorted(name for name, _, _ in extract.DEFAULT_SKILLS)
    return "list_filter([" + ", ".join(f"case when regexp_matches({clean}, '(?:^|{word}){n.lower()}(?:$|{word})') then '{n}' end" for n in names) + "], lambda x: x is not null)"


def cleaned(text: str) -> str:
    """clean_title."""
    out = f"coalesce({text}, '')"
    steps = [("[​﻿]", ""), (r"\[([^\]]+)\]\([^)]*\)", r"\1"), (r"\]\([^)\s]*\)?", ""), (r"https?://\S+", ""), (r"[*_`>#\[\]]+", ""), (slim_op._PICTURES, ""), (r"\s+", " "), ("^" + slim_op._EDGE, ""), (slim_op._EDGE + "$", "")]
    for pattern, to in steps:
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    return out


def _map(table: dict[str, str], code: str) -> str:
    return f"case {code} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items()) + " end"


def _values(districts: dict[str, str]) -> str:
    return ", ".join(f"('{name}', '{d}')" for d, names in districts.items() for name in names.split("|"))


_KIND = r"\s+(?:область|край|республика|автономн\S+\s+(?:область|округ)|ао|округ|г\.?)$"
#: How the region of a place is looked up: the table's names, then its aliases, then the fixed districts.
REGIONS = f"""
place_names as (select lower(trim(city)) as name, region, 0 as rank, city_id from city_reference where city is not null and region is not null
  union all select lower(trim(a)), region, 1, city_id from (select unnest(aliases) as a, region, city_id from city_reference where city is not null and region is not null) where a <> ''
  union all select name, district, 2, 0 from (values {_values(regions.CITIES)}) as v(name, district)),
places as (select name, arg_min(region, (rank, city_id)) as region from place_names group by name),
subject_names as (select trim(regexp_replace(regexp_replace(lower(trim(region)), '{_KIND}', ''), '^республика\\s+', '')) as name, region, 0 as rank, city_id from city_reference where city is not null and region is not null
  union all select name, district, 1, 0 from (values {_values(regions.SUBJECTS)}) as v(name, district)),
subjects as (select name, arg_min(region, (rank, city_id)) as region from subject_names group by name)"""


def snapshot_sql(source: str | None = None, since: str | None = None) -> str:
    """CTEs that end in snap, with the columns of SLIM, as slim.build makes them from the test tables."""
    j = lambda path: f"json_extract_string(j, '$.{path}')"
    levels = lambda e: f"{rules.duckdb_case(e, rules.LEVELS)}"
    where = " and ".join(["true", *([f"source = '{source}'"] if source else [])])
    return f"""
rates as (select upper(trim(char_code)) as code, arg_max(value / nominal, (date, value)) as rate from cbr_rates where nominal > 0 and value is not null and upper(trim(char_code)) not in ('RUB', 'RUR') group by 1
  union all select * from (values ('RUB', 1.0), ('RUR', 1.0))),
{REGIONS},
texts0 as (select vacancy_id, arg_max(text, (first_seen_at, text)) as fts from vacancies where text is not null group by 1),
snap_details as (select vacancy_id, fts, case when length(fts) > 500 then regexp_replace(left(fts, 500), '(?s)^(.+) [^ ]*$', '\\1') else fts end as teaser from texts0),
snap_rec as (select vacancy_id, min(fetched_at) as first_seen_at, max(fetched_at) as last_seen_at,
  arg_max(struct_pack(source := source, emp := employer_id, j := raw_json, posted_at := posted_at, scope := market_scope, role := professional_role_id), (fetched_at, ingest_seq)) as r from raw_lake where {where} group by 1),
snap_base as (select vacancy_id, first_seen_at, last_seen_at, r.source as source, r.emp as emp, r.j as j, r.posted_at as posted_at, r.scope as market_scope, r.role as professional_role_id, r.source = 'telegram' as chat, teaser as board_teaser, fts as board_fts
  from snap_rec left join snap_details using (vacancy_id) {f"where last_seen_at >= '{since}+00'" if since else ''}),
snap_said as (select *, case when chat then coalesce({j('text')}, '') end as said, nullif(concat_ws(' ', nullif(board_teaser, ''), nullif(board_fts, '')), '') as body from snap_base),
snap_named as (select *, case when chat then coalesce(left(list_filter(list_transform(string_split(said, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1], 200), '(untitled)') else coalesce({j('name')}, '') end as title from snap_said),
pay_texts as (select vacancy_id as id, said as t from snap_named where chat),
{pay_ctes('pay_texts')},
years_texts as (select vacancy_id as id, coalesce(said, body) as t from snap_named),
{years_ctes('years_texts')},
snap_priced as (select n.*, years, pay.disclosed as told, case when chat then pay.lo else cast(coalesce({j('compensation.from')}, {j('salary.from')}) as bigint) end as lo, case when chat then pay.hi else cast(coalesce({j('compensation.to')}, {j('salary.to')}) as bigint) end as hi,
  case when chat then pay.cur else coalesce({j('compensation.currencyCode')}, {j('salary.currency')}) end as currency,
  case when chat then said else title end as seen, case when chat then said else concat_ws(' ', nullif(title, ''), board_teaser) end as around_, case when chat then said else concat_ws(' ', nullif(title, ''), body) end as words,
  case when chat then {rules.duckdb_case('said', rules.CITIES)} else coalesce({j('address.city')}, {j('area.name')}) end as city
  from snap_named n left join pay on pay.id = n.vacancy_id left join years on years.id = n.vacancy_id),
snap_rub as (select *, cast(round_even(lo * rate, 0) as bigint) as a, cast(round_even(hi * rate, 0) as bigint) as b,
  regexp_replace(trim(lower(city)), '^(?:городской\\s+округ|город|г\\.)\\s+', '') as place from snap_priced left join rates on upper(currency) = code),
snap_kept as (select *, case when a between 10000 and 5000000 then a end as smin, case when b between 10000 and 5000000 then b end as smax, trim(regexp_replace(place, '\\([^)]*\\)', '', 'g')) as bare,
  trim(regexp_replace(regexp_replace(trim(regexp_extract(place, '\\(([^)]*)\\)', 1)), '{_KIND}', ''), '^республика\\s+', '')) as subject from snap_rub),
snap as (select vacancy_id, title, case when not chat then source || ':' || nullif(emp, '') end as employer_id, coalesce({j('company.visibleName')}, {j('company.name')}, {j('employer.name')}) as employer_name,
  smin as salary_rub_min, smax as salary_rub_max, currency as salary_currency, (case when chat then coalesce(told, false) else coalesce(lo, 0) <> 0 or coalesce(hi, 0) <> 0 end) and (smin is not null or smax is not null) as salary_disclosed,
  city, coalesce(x.region, y.region, z.region) as region,
  coalesce({_map(rules.WORK_FORMAT, "list_filter(coalesce(try_cast(json_extract(j, '$.workFormats[*].workFormatsElement[*]') as varchar[]), []), lambda w: replace(w, chr(34), '') in (" + ", ".join(f"'{k}'" for k in rules.WORK_FORMAT) + "))[1].replace(chr(34), '')")}, {_map(rules.SCHEDULE, j('schedule.id'))}, {rules.duckdb_case('around_', rules.WORKPLACES, 'unknown')}) as remote_type,
  coalesce({rules.duckdb_case('seen', rules.LEVELS_IN_TITLE)}, {levels('seen')}, case when not chat then {levels('body')} end, case when years >= 7 then 'lead' when years >= 4 then 'senior' when years >= 2 then 'middle' end, {_map(rules.EXPERIENCE_LEVEL, f"coalesce({j('workExperience')}, {j('experience.id')})")}, 'unknown') as seniority,
  case when chat then left(said, 500) else board_teaser end as description_teaser, {skills_of('words')} as skills, source, market_scope, professional_role_id,
  coalesce(case when chat then 'https://t.me/' || {j('channel')} || '/' || {j('message_id')} end, {j('links.desktop')}, {j('links.mobile')}, {j('alternate_url')}) as source_url, first_seen_at, last_seen_at, posted_at
  from snap_kept left join places x on x.name = place left join places y on y.name = bare left join subjects z on z.name = subject)"""


SNAP_COLUMNS = ", ".join(f.name for f in slim_op.SLIM.fields)
