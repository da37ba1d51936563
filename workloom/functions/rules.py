"""Ordered rule tables as CASE chains: role, seniority, city and workplace of a posting.

A rule is (label, pattern); the first rule that matches decides. Patterns are written once, in Java's
dialect with Unicode classes, and evaluated inside code generation; `duckdb_case` gives the same
chain to the oracle, whose regular expressions know neither look-around nor Unicode word edges.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = tuple[tuple[str, str], ...]

# Canonical roles and the words of a title that name them, in order of precedence.
ROLES: Rules = (
    ("data_scientist", r"\b(data\s*scientist|дата\s*сайентист)\b"),
    ("data_analyst", r"\b(data\s*analyst|дата\s*аналитик|аналитик\s*данных)\b"),
    ("data_engineer", r"\b(data\s*engineer|инженер\s*данных|дата\s*инженер)\b"),
    ("ml_engineer", r"\b(ml\s*engineer|machine\s*learning|мл\s*инженер|ml-?разраб)\b"),
    ("devops", r"\b(devops|сре|sre|platform\s*engineer)\b"),
    ("qa_engineer", r"\b(qa|тестировщик|test\s*engineer|sdet)\b"),
    ("frontend_engineer", r"\b(frontend|фронт[- ]?енд|front[- ]?end|фронтенд)\b"),
    ("backend_engineer", r"\b(backend|бэк[- ]?енд|back[- ]?end|бэкенд|серверн)\b"),
    ("fullstack_engineer", r"\b(fullstack|full[- ]?stack|фулл[- ]?стек)\b"),
    ("mobile_engineer", r"\b(mobile|ios|android|мобильн)\b"),
    ("product_manager", r"\b(product\s*manager|продукт\s*менеджер|product\s*owner|пм)\b"),
    ("project_manager", r"\b(project\s*manager|руководитель\s*проект)\b"),
    ("designer", r"\b(designer|дизайнер|ux|ui)\b"),
    ("analyst", r"\b(analyst|аналитик)\b"),
    ("engineer", r"\b(developer|разработчик|программист|engineer)\b"),
)

# Places named in chat posts.
CITIES: Rules = (
    ("Москва", r"\b(?:москв|moscow)"),
    ("Санкт-Петербург", r"\b(?:санкт[\s\-]?петербург|спб|питер)"),
    ("Новосибирск", r"\bновосибирск"),
    ("Екатеринбург", r"\bекатеринбург"),
    ("Казань", r"\bказан"),
    ("Нижний Новгород", r"\bнижн[еёийя][^\s]*[\s\-]+новгород"),
    ("Краснодар", r"\bкраснодар"),
    ("Самара", r"\bсамар"),
    ("Уфа", r"\bуф[аы]"),
    ("Пермь", r"\bперм[ьи]"),
    ("Волгоград", r"\bволгоград"),
    ("Воронеж", r"\bворонеж"),
    ("Ростов-на-Дону", r"\bростов[\s\-]?на[\s\-]?дону"),
)

# Where the work is done; hybrid before remote before office.
WORKPLACES: Rules = (
    ("hybrid", r"\bгибрид|hybrid"),
    ("remote", r"\bудал[её]н|\bremote|\bдистанц"),
    ("office", r"\bофис(?!н)|\boffice|\bна\s+месте"),
)

_STAFF = r"\b(?:principal|стафф|staff(?!\s*(?:member|of|количество))|engineering\s+manager|инженерный\s+менеджер)\b"
# Markers of a level that count in a title only, in order of precedence.
LEVELS_IN_TITLE: Rules = (
    ("middle", r"(?:^|[\s/(])(?:ведущ\w+|главн\w+)\s+(?:специалист|менеджер|координатор|инспектор|консультант|бухгалтер|экономист|юрист|документовед)\b"),
    ("lead", r"(?:^|[\s/(])(?:ведущ(?:ий|ая|его|ему)|главн(?:ый|ая|ого|ому))\b"),
    ("lead", r"(?:^|[\s/(])(?:руководител[ьяюие]|нач(?:альник|альница|альник[ау])|head\s+of|зам(?:еститель)?\s+руковод)"),
    ("junior", r"(?:^|[\s/(])(?:помощник|ассистент|assistant)\b"),
    ("lead", r"(?:^|[\s/(])(?:лидер(?:а|у|ом|е)?)\b"),
    ("principal", _STAFF),
    ("lead", r"(?:^|[\s/(\-])директор\w*|\bdirector\b"),
    ("lead", r"(?:^|[\s/(\-])(?:архитектор|architect)\w*"),
    ("lead", r"(?:^|[\s/(\-])(?:lead|лид(?:а|у|ом|е))\b"),
    ("lead", r"\b(?:cto|cio|cdo|cpo|ceo|coo|chief\s+\S+\s+officer|chief\s+engineer|chief\s+product\s+owner)\b"),
    ("junior", r"\bначинающ(?:ий|ая|его|ему|их|ие)\b"),
    ("senior", r"\b(?:эксперт(?:а|у|ом|е)?|expert)\b"),
)
# Markers of a level that count anywhere.
LEVELS: Rules = (
    ("lead", r"\b(?:tech\s*lead|техлид\w*)\b"),
    ("lead", r"\b(?:team\s*lead|тимлид\w*|\bтл\b)"),
    ("principal", _STAFF),
    ("lead", r"\bлид\b"),
    ("senior", r"\b(?:senior|сеньор\w*|старш(?:ий|ая|его|ему)|sr\.?)\b"),
    ("middle", r"\b(?:middle|миддл\w*|мидл\w*|mid[- ]?level)\b"),
    ("junior", r"\b(?:junior|джун\w*|младш(?:ий|ая|его|ему)|jr\.?)\b"),
    ("intern", r"\b(?:intern\w*|стаж[её]р\w*|стажир\w*|стажировк\w*)\b"),
    ("junior", r"\bбез\s+опыт"),
    ("junior", r"\b(?:выпускник\w*|студент\w*|graduate)\b"),
    ("lead", r"#lead\b"),
)

# Codes of the board's payloads.
EXPERIENCE_LEVEL = {"noExperience": "junior", "between1And3": "middle", "between3And6": "senior", "moreThan6": "lead"}
WORK_FORMAT = {"REMOTE": "remote", "HYBRID": "hybrid", "MIXED": "hybrid", "ON_SITE": "office", "FIELD_WORK": "office", "OFFICE": "office"}
SCHEDULE = {"remote": "remote", "fullDay": "office", "shift": "office", "flyInFlyOut": "office", "flexible": "office"}


def first_match(text: Column, rules: Rules, default: str | None = None) -> Column:
    """The label of the first rule that the text matches, in any letter case; the default for none
    and for a null text."""
    chain = F.lit(default).cast("string")
    for label, pattern in reversed(rules):
        chain = F.when(text.rlike("(?iU)" + pattern), F.lit(label)).otherwise(chain)
    return chain


def lookup(code: Column, table: dict[str, str], default: str | None = None) -> Column:
    """The value of a code in a small fixed table."""
    return reduce(lambda rest, kv: F.when(code == kv[0], kv[1]).otherwise(rest), table.items(), F.lit(default))


def role(title: Column) -> Column:
    return first_match(title, ROLES, "other")


def city(text: Column) -> Column:
    return first_match(text, CITIES)


def workplace(text: Column) -> Column:
    return first_match(text, WORKPLACES, "unknown")


def stated_level(title: Column, body: Column | None = None) -> Column:
    """The level that words state: title markers and general markers in the title, then general
    markers in the body; null if none."""
    chain = F.coalesce(first_match(title, LEVELS_IN_TITLE), first_match(title, LEVELS))
    return chain if body is None else F.coalesce(chain, first_match(body, LEVELS))


def duckdb_case(expr: str, rules: Rules, default: str | None = None) -> str:
    """The same chain as a DuckDB CASE over lower(expr)."""
    text = f"regexp_replace(lower({expr}), 'staff\\s*(member|of|количество)', ' ', 'g')"
    return "case " + " ".join(f"when regexp_matches({text}, '{_re2(p)}') then '{label}'" for label, p in rules) + f" else {'null' if default is None else repr(default)} end"


def _re2(pattern: str) -> str:
    pattern = re.sub(r"\(\?!\\s\*\([^()]*\)\)", "", pattern).replace(r"(?!н)", r"(?:[^н]|$)")
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith(r"\b", i):
            left = i == 0 or pattern[i - 1] in "|("
            left = left or pattern.endswith("(?:", 0, i)
            out += r"(?:^|[^\p{L}\p{N}_])" if left else r"(?:$|[^\p{L}\p{N}_])"
            i += 2
        elif pattern.startswith(r"\w", i):
            out += r"[\p{L}\p{N}_]"
            i += 2
        else:
            out += pattern[i]
            i += 1
    return out
