"""Personal data as spans, with Spark SQL functions only.

Regular expressions propose spans, validators confirm them (IPv4 parts, Luhn, digit counts,
IBAN mod-97), and words shortly before a span raise its score. Kinds whose form alone proves
little (``SCORED``) are reported only if their score reaches ``THRESHOLD``; confirmed ones
are always reported. Positions count code points, ends are exclusive.

A kind's matches and the text between them come from one pattern (extract and split), so a
start is the length of all that precedes it; no pattern can backtrack over a long run.
Null and empty texts have no spans. Rows are judged alone, so repeated rows, ties and an
empty table need no care; columns of the input stay, those with an output's name are
replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.6
CONTEXT = 40  # code points before a span that are searched for context words
BLOCK = 64  # lengths are summed in blocks, so many matches in a text stay affordable

DIGITS = "regexp_replace(m, '[^0-9]', '')"
LUHN = (f"aggregate(sequence(1, length({DIGITS})), 0, (a, i) -> a + "
        f"if(i % 2 = 1, cast(substr(reverse({DIGITS}), i, 1) as int), "
        f"cast(substr('0246813579', 1 + cast(substr(reverse({DIGITS}), i, 1) as int), 1) as int)))"
        " % 10 = 0")
IBAN = "replace(m, ' ', '')"
# Letters count as two digits (A = 10 ... Z = 35); the first four characters go to the end.
MOD97 = (f"aggregate(split(concat(substr({IBAN}, 5), substr({IBAN}, 1, 4)), ''), 0, (a, c) -> "
         "case when c = '' then a when c between '0' and '9' then (a * 10 + ascii(c) - 48) % 97 "
         "else (a * 100 + ascii(c) - 55) % 97 end) = 1")
# Characters of an IBAN by country, as registered.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
IBAN_SIZED = "(?:" + "|".join(
    f"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}"
    for n, c in IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])"
# Other countries and lengths: up to the last border of a word, or where a sized one starts.
IBAN_OTHER = (r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]| (?!" + IBAN_SIZED
              + r")[A-Z0-9]){11,30}(?![A-Za-z0-9])")


@dataclass(frozen=True)
class Kind:
    """What proposes spans, a cheap test that a text may hold any, what confirms one."""

    name: str
    pattern: str
    needs: str
    confirms: str
    context: str
    base: bool = True
    sure: float = 0.8


# In the order in which spans of one start are listed.
KINDS = [
    Kind("email",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         "contains(text, '@')", "true", "mail|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"text rlike '[0-9][.][0-9]'",
         r"not exists(split(m, '[.]'), p -> length(ltrim('0', p)) > 3 "
         r"or cast(substr(p, -3) as int) > 255)", "ip|host|server|address|login"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
         r"text rlike '[0-9][ -]?[0-9]'", LUHN, "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"contains(text, '+')",
         f"length({DIGITS}) between 10 and 15", "phone|call|tel|mobil|fax"),
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{IBAN_SIZED}|{IBAN_OTHER})",
         r"text rlike '[A-Z]{2}[0-9]{2} ?[A-Z0-9]'", MOD97, "iban|account|konto|compte|cuenta",
         base=False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         r"text rlike '[0-9]-[0-9]{2}-[0-9]'",
         "not substr(m, 1, 3) in ('000', '666') and substr(m, 1, 1) <> '9' "
         "and substr(m, 5, 2) <> '00' and substr(m, 8) <> '0000'",
         "ssn|social|security", base=False, sure=0.4),
]
ORDER = {k.name: i for i, k in enumerate(KINDS)}


def _quote(pattern: str) -> str:
    return "r'" + pattern + "'"


def _proposed(k: Kind) -> str:
    """Matches of a kind, and the pieces of text around them."""
    p = _quote(k.pattern)
    return (f"if({k.needs}, named_struct('m', regexp_extract_all(text, {p}, 0), "
            f"'gap', split(text, {p}, -1)), null)")


def _spans(k: Kind) -> str:
    """Confirmed spans of a kind from its matches and gaps."""
    v = f"p_{k.name}"
    steps = f"transform({v}.m, (m, i) -> length({v}.gap[i]) + length(m))"
    # Sums of whole blocks, then of the rest of a block.
    blocks = (f"transform(sequence(0, (size({v}.m) - 1) div {BLOCK}), b -> "
              f"aggregate(slice(w, b * {BLOCK} + 1, {BLOCK}), 0, (a, x) -> a + x))")
    start = (f"aggregate(slice(bs, 1, i div {BLOCK}), 0, (a, x) -> a + x) + "
             f"aggregate(slice(w, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), 0, (a, x) -> a + x) "
             f"+ length({v}.gap[i])")
    before = f"lower(right({v}.gap[i], {CONTEXT}))"
    near = f"{before} rlike '(^|[^a-z])({k.context})'"
    row = (f"named_struct('start', {start}, 'ord', {ORDER[k.name]}, 'kind', '{k.name}', "
           f"'end', {start} + length(m), 'ok', {k.confirms}, "
           f"'score', cast({k.sure} + if({near}, 0.2, 0.0) as double))")
    inner = f"transform({v}.m, (m, i) -> {row})"
    # bind w and bs by one-element arrays: SQL lambdas have no let
    bound = (f"transform(array({steps}), w -> transform(array({blocks}), bs -> {inner}))[0][0]")
    none = ("cast(array() as array<struct<start:int,ord:int,kind:string,end:int,ok:boolean,"
            "score:double>>)")
    return (f"if({v} is null or size({v}.m) = 0, {none}, "
            f"filter({bound}, s -> s.ok and s.score >= {THRESHOLD}))")


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns and ``spans``: array of (start, kind order, kind, end, score) by start."""
    own = [c for c in docs.columns if c.lower() != "spans"]
    src = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in own],
                      F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    src = src.withColumns({f"p_{k.name}": F.expr(_proposed(k)) for k in KINDS})
    every = ", ".join(_spans(k) for k in KINDS)
    return src.select(*[F.col(f"`in_{c}`").alias(c) for c in own], F.expr(
        f"array_sort(transform(concat({every}), s -> "
        "struct(s.start, s.ord, s.kind, s.end, s.score)))").alias("spans"))


def listed(only_base: bool) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    base = ", ".join(f"'{k.name}'" for k in KINDS if k.base)
    which = f"filter(spans, s -> s.kind in ({base}))" if only_base else "spans"
    return F.expr(f"array_join(transform({which}, "
                  "s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def redacted(text: str = "text") -> Column:
    """The text with every reported span replaced by its kind in brackets.

    Of overlapping spans the first stands for what it shares with the next.
    """
    return F.expr(f"""concat(
      aggregate(spans, named_struct('at', 0, 'parts', cast(array() as array<string>)),
        (a, s) -> if(s.end <= a.at, a, named_struct('at', s.end, 'parts',
          array_append(a.parts, concat(
            substr(`{text}`, a.at + 1, greatest(s.start - a.at, 0)), '[', upper(s.kind), ']')))),
        a -> array_join(a.parts, '')),
      substr(`{text}`, 1 + coalesce(array_max(transform(spans, s -> s.end)), 0)))""")
