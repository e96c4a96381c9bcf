"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Kinds of the base: email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits).
Kinds that the method adds: iban (of the country's
length, mod-97; what follows it doesn't matter), ssn (only with a context word). A span's score starts at
the trust in its pattern, rises with a checksum and with a context word among the ``CONTEXT_CHARS``
characters before it; added kinds must reach ``MIN_SCORE``, base kinds always stay.

DataFrame functions only, one narrow pass. Possessive quantifiers keep the matcher from going back, so
a very long run costs time in proportion and no stack; they change no match, because what follows
each of them can't begin with what it takes.

Defined cases: a null text is empty and has no spans; repeated rows each get their own result; an
empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.llm.frames import fresh, table
from textforge.llm.spans import SPAN, joined, matches, number_of

_LOCAL = "[A-Za-z0-9._%+-]"
#: Within a run of local characters only its begin (or the end of the last match) can begin a match.
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IBAN_END = r"(?![A-Za-z0-9_])"
_IBAN_RUN = rf"(?:\x20?[A-Z0-9]){{11,30}}{_IBAN_END}"
#: Where an account number may begin; what follows it is looked at, not taken.
IBAN = rf"(?<![A-Za-z0-9_])[A-Z]{{2}}[0-9]{{2}}(?={_IBAN_RUN})"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Letters and digits of the longest account number, a space before each, and the character after it.
IBAN_CHARS = 4 + 2 * 30 + 1
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")
#: Trust in the pattern, what a checksum adds, what a context word adds.
WEIGHTS = {
    "email": (0.8, 0.0, 0.1),
    "ip": (0.5, 0.1, 0.2),
    "card": (0.3, 0.4, 0.2),
    "phone": (0.4, 0.0, 0.3),
    "iban": (0.3, 0.4, 0.2),
    "ssn": (0.3, 0.0, 0.4),
}
CONTEXT = {
    "email": "mail|contact|correo|courriel",
    "ip": r"\bip\b|server|host|address|adresse",
    "card": "card|credit|visa|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|ruf",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|sozial|seguridad",
}
CONTEXT_CHARS = 48
MIN_SCORE = 0.6


def _digits(value: Column) -> Column:
    return F.translate(value, " ().+-", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    places = F.split(F.reverse(digits), "")

    def add(total: Column, x: Column) -> Column:
        d = x["d"].cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(x["odd"], twice).otherwise(d)

    numbered = F.transform(places, lambda d, i: F.struct(d.alias("d"), (i % 2 == 1).alias("odd")))
    return F.aggregate(numbered, F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number, its first four characters last, is 1 modulo 97."""
    plain = F.translate(value, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code > 57, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), add) == 1


def _ibans(text: Column, heads: Column) -> Column:
    """Account numbers at the heads: of the country's length, else the longest run, if mod-97 holds; none overlap."""
    kinds = "|".join(
        rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}{_IBAN_END}" for n, names in IBAN_LENGTHS.items()
    )

    def step(done: Column, head: Column) -> Column:
        piece = F.substring(text, (head["start"] + 1).cast("int"), F.lit(IBAN_CHARS))
        own = F.regexp_extract(piece, f"^(?:{kinds})", 0)
        run = F.regexp_extract(piece, f"^[A-Z]{{2}}[0-9]{{2}}{_IBAN_RUN}", 0)
        value = F.when(mod97(own), own).when(mod97(run), run).otherwise(F.lit(""))
        span = F.struct(head["start"].alias("start"), (head["start"] + F.length(value)).alias("stop"), value.alias("value"))
        free = F.element_at(done, -1)["stop"] <= head["start"]
        good = (value != "") & ((F.size(done) == 0) | free)
        return F.when(good, F.concat(done, F.array(span).cast(SPAN))).otherwise(done)

    return F.aggregate(heads, F.array().cast(SPAN), step)


def _ip_holds(value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _card_holds(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(16, 19) & luhn(digits)


def _phone_holds(value: Column) -> Column:
    return F.length(_digits(value)).between(8, 15)


def find_spans(text: Column) -> dict[str, Column]:
    """Kind to spans, base kinds and proposals of the method."""
    return {
        "email": matches(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": matches(text, IP, text.rlike(r"[0-9]\.[0-9]++\.[0-9]"), _ip_holds),
        "card": matches(text, CARD, text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), _card_holds),
        "phone": matches(text, PHONE, F.contains(text, F.lit("+")), _phone_holds),
        "iban": _ibans(text, matches(text, IBAN, text.rlike("[A-Z]{2}[0-9]{2}"))),
        "ssn": matches(text, SSN, text.rlike("[0-9]{3}-[0-9]{2}-[0-9]{4}")),
    }


def _scored(kind: str, rank: int, spans: Column, text: Column) -> Column:
    trust, checksum, context = WEIGHTS[kind]

    def score(s: Column) -> Column:
        first = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0))
        before = F.lower(F.substring(text, (first + 1).cast("int"), (s["start"] - first).cast("int")))
        near = before.rlike(CONTEXT[kind])
        return F.lit(trust + checksum) + F.when(near, F.lit(context)).otherwise(F.lit(0.0))

    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(rank).alias("rank"),
            s["start"].alias("start"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
            score(s).alias("score"),
        ),
    )


def add_pii(docs: DataFrame, result: str, text_col: str = "text") -> DataFrame:
    """``docs`` with an array column of spans: rank, start, stop, kind, value, score, by kind and start."""
    whole = fresh(docs, "whole")
    kept = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.withColumn(whole, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    names = {}
    found = find_spans(F.col(whole))
    for kind in found:
        names[kind] = fresh(rows, f"found_{kind}")
    rows = rows.withColumns({names[kind]: spans for kind, spans in found.items()})
    each = []
    for rank, kind in enumerate((*BASE, *ADDED)):
        spans = _scored(kind, rank, F.col(names[kind]), F.col(whole))
        each.append(spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= MIN_SCORE - 1e-9))
    return rows.select(*kept, F.concat(*each).alias(result))


def op2_pii(spark, sf_dir: str) -> DataFrame:
    found = add_pii(table(spark, sf_dir, "documents").select("doc_id", "text"), "found")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return found.select("doc_id", "found", joined(base).alias("base"), joined(F.col("found")).alias("spans")).select(
        "doc_id",
        *[number_of(F.col("found"), kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2("base", 256).alias("base_sha256"),
        "spans",
    )
