"""Personal data: regular expressions propose spans, checksums confirm them,
words nearby adjust the score. Column functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm.common import blank, read_table

NAME = "op10_pii"

# The kinds in report order with the patterns of the contract,
# written with possessive repeats and look-behinds so that a long run of
# letters or digits is read once. A look-behind or \G (the end of the match
# before) stands where a match can begin; the matches are the same.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")

# The score of a confirmed span, and the words that raise it by
# CONTEXT_GAIN when one of them stands in the CONTEXT characters before it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT_WORDS = {
    "email": "mail|contact|write|@",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|master|credit|payment|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fax|contact",
    "iban": "iban|account|bank|konto|cuenta|compte",
    "ssn": "ssn|social security",
}
CONTEXT, CONTEXT_GAIN, KEEP = 40, 0.1, 0.35
#: Matches of a text that are worked through at a time; so many hold more than
#: ``CONTEXT`` characters.
GROUP = 128


def _let(value: Column, function) -> Column:
    """``function(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), function)[0]


def _matches(text: Column, pattern: str) -> Column:
    """array<struct<start,end,value,near>> of all matches, in code points: the
    lengths of the matches and of the pieces between them are summed up. ``near``
    are the ``CONTEXT`` characters before a match. Pieces are worked through in
    groups of ``GROUP``, as appending to one array would take time by the
    square of its length."""
    nothing = F.expr("cast(array() as array<struct<start:int,end:int,value:string,near:string>>)")
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
    )

    def add(acc: Column, piece: Column) -> Column:
        start = acc["at"] + F.char_length(piece["gap"])
        end = start + F.char_length(F.coalesce(piece["value"], F.lit("")))
        near = F.right(F.concat(acc["tail"], piece["gap"]), F.lit(CONTEXT))
        found = F.struct(start.alias("start"), end.alias("end"), piece["value"].alias("value"), near.alias("near"))
        return F.struct(
            end.alias("at"),
            F.when(piece["value"].isNull(), F.lit("")).otherwise(F.right(F.concat(near, piece["value"]), F.lit(CONTEXT))).alias("tail"),
            F.when(piece["value"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], F.array(found))).alias("found"),
        )

    def of_group(group: Column, before: Column) -> Column:
        begin = F.struct(before["at"].alias("at"), before["tail"].alias("tail"), nothing.alias("found"))
        return F.aggregate(group, begin, add, lambda acc: acc["found"])

    def groups(all_: Column) -> Column:
        last = F.floor((F.size(all_) - 1) / GROUP).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_, i * GROUP + 1, F.lit(GROUP)))

    def befores(all_: Column) -> Column:
        """Where each group begins, and the end of the text before it."""
        none = F.expr("cast(array() as array<struct<at:int,tail:string>>)")

        def text_of(group: Column) -> Column:
            return F.array_join(F.flatten(F.transform(group, lambda p: F.array(p["gap"], p["value"]))), "")

        def step(acc: Column, own: Column) -> Column:
            return F.struct(
                (acc["at"] + F.char_length(own)).alias("at"), F.right(own, F.lit(CONTEXT)).alias("tail"),
                F.concat(acc["all"], F.array(F.struct(acc["at"].alias("at"), acc["tail"].alias("tail")))).alias("all"))

        begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), none.alias("all"))
        return F.aggregate(F.transform(all_, text_of), begin, step, lambda acc: acc["all"])

    found = _let(_let(pieces, groups), lambda all_: F.flatten(F.zip_with(all_, befores(all_), of_group)))
    return F.when(text.rlike(pattern), found).otherwise(nothing)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right Luhn checksum."""
    n = F.char_length(digits)

    def add(acc: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return acc + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether a string of capital letters and digits is 1 modulo 97 when its
    first four characters are moved to the end and letters count from 10."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.char_length(plain)), F.substring(plain, 1, 4))

    def add(acc: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, (acc * 100 + code - 55) % 97).otherwise((acc * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _small_parts(value: Column) -> Column:
    part = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return _small_parts(value)
    if kind == "card":
        digits = _digits(value)
        return F.char_length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.char_length(_digits(value)).between(8, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _kind(text: Column, kind: str, pattern: str, needs: Column) -> Column:
    """Confirmed and scored spans of one kind; ``needs`` is a cheap test that
    every text with a match passes."""

    def scored(span: Column) -> Column:
        near = F.lower(span["near"])
        score = F.lit(SCORES[kind]) + F.when(near.rlike(CONTEXT_WORDS[kind]), CONTEXT_GAIN).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), span["start"].alias("start"), span["end"].alias("end"),
            span["value"].alias("value"), F.round(score, 2).alias("score"),
        )

    found = F.filter(_matches(text, pattern), lambda s: _confirmed(kind, s["value"]))
    spans = F.filter(F.transform(found, scored), lambda s: s["score"] >= KEEP)
    empty = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,value:string,score:double>>)")
    return F.when(needs, spans).otherwise(empty)


def find_pii(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with a column ``pii``: array of (kind, start, end, value,
    score), start and end in code points, by kind (email, ip, card, phone,
    iban, ssn) and start.

    Null and empty texts have no spans; repeated rows are told apart by
    nothing and treated alike; an empty table gives an empty table; a column
    named ``pii`` is replaced, all others are carried through. Rows stay where
    they are: no shuffle, and no state that grows with a text but its spans.
    """
    words = blank(F.col(f"`{text}`"))
    rules = {
        "email": (EMAIL, words.contains("@")),
        "ip": (IP, words.rlike(r"[0-9]\.[0-9]")),
        "card": (CARD, words.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]")),
        "phone": (PHONE, words.contains("+")),
        "iban": (IBAN, words.rlike(r"[A-Z]{2}[0-9]{2}")),
        "ssn": (SSN, words.rlike(r"[0-9]-[0-9]")),
    }
    return documents.withColumn(
        "pii", F.concat(*[_kind(words, kind, *rules[kind]) for kind in BASE + ADDED])
    )


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = found.select("doc_id", "pii")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"),
    )


def _sql() -> str:
    """The same spans in DuckDB SQL, with the contract's own patterns."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
        "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    }
    luhn_sum = (
        "list_sum(list_transform(range(1, length(d) + 1), lambda i: case when i % 2 = 0 then "
        "(2 * d[length(d) - i + 1]::int) // 10 + (2 * d[length(d) - i + 1]::int) % 10 "
        "else d[length(d) - i + 1]::int end))"
    )
    rest = (
        "list_reduce(list_prepend(0::bigint, list_transform(string_split(substring(replace(v, ' ', ''), 5) || "
        "substring(replace(v, ' ', ''), 1, 4), ''), lambda c: case when ascii(c) >= 65 then ascii(c) + 45 "
        "else ascii(c) - 48 end::bigint)), lambda a, b: case when b >= 100 then (a * 100 + b - 100) % 97 "
        "else (a * 10 + b) % 97 end)"
    )
    tests = {
        "email": "true",
        "ip": "list_bool_and(list_transform(string_split(v, '.'), lambda p: coalesce(try_cast(p as integer), 999) <= 255))",
        "card": f"length(d) between 16 and 19 and {luhn_sum} % 10 = 0",
        "phone": "length(d) between 8 and 15",
        "iban": f"{rest} = 1",
        "ssn": "regexp_matches(lower(substring(text, greatest(s - 40, 0) + 1, s - greatest(s - 40, 0))), 'ssn|social security')",
    }
    parts = []
    for k, (kind, pattern) in enumerate(patterns.items()):
        parts.append(
            f"""select doc_id, {k} k, '{kind}' kind, s, s + length(v) e from (
  select doc_id, text, v, regexp_replace(v, '[^0-9]', '', 'g') d,
    (sum(length(g)) over w + sum(length(v)) over w - length(v))::bigint s
  from (select doc_id, text, unnest(string_split_regex(text, '{pattern}')) g,
          unnest(regexp_extract_all(text, '{pattern}')) v, unnest(range(length(text) + 2)) i
        from docs where regexp_matches(text, '{pattern}'))
  where v is not null window w as (partition by doc_id order by i rows unbounded preceding)
) where {tests[kind]}"""
        )
    counts = ", ".join(f"count(*) filter (kind = '{kind}') n_{kind}" for kind in BASE)
    return f"""with docs as (select doc_id, coalesce(text, '') as text from documents),
spans as ({' union all '.join(parts)})
select d.doc_id, {counts},
  sha256(coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by k, s) filter (k < 4), '')) base_sha256,
  coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by k, s), '') spans
from docs d left join spans using (doc_id) group by d.doc_id"""


SQL = _sql()
