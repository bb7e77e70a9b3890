"""Personal data in texts: patterns propose spans, checks confirm them, and words nearby raise or lower their score.

Everything is built from column expressions. A pattern's matches and the gaps between them come from one split and one
extraction; positions are their running sum, and the text around a match is put together from the pieces beside it, so no
match is looked up from the start of the text. Patterns are written so that the engine never goes back over a long run of
characters: possessive repeats, and a look-behind that lets a match start only where a run starts or where the last match
ended. That changes no match of the plain patterns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.tables import table, whole_text

SPAN = "struct<start:int,end:int,value:string,before:string,n:int>"
#: Matches whose positions are summed at once; keeps the cost of very many matches in one text near linear.
BLOCK = 128


@dataclass(frozen=True)
class Kind:
    """``hint`` is a text that every match holds. ``score`` is what a confirmed match has by itself; context words around it
    add to it. With ``takes`` the value is the pattern's first group, and a match uses up only so many of its characters:
    the next one may start within the rest, should this one fail its check."""
    name: str
    pattern: str
    score: float
    context: str
    hint: str | None = None
    takes: int | None = None


# Characters of an IBAN by country: the ISO 13616 registry, and countries outside it that issue such numbers. Others have none.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}


def _iban_pattern() -> str:
    """Country, check digits, and groups of four up to exactly the country's length."""
    def rest(n: int) -> str:
        return rf"(?:\x20?[A-Z0-9]{{4}}){{{n // 4}}}" + (rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")

    shapes = "|".join(f"(?:{'|'.join(who.split())})[0-9]{{2}}{rest(n - 4)}" for n, who in IBAN_LENGTHS.items())
    return rf"(?<![A-Za-z0-9])(?=((?:{shapes})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}"


# The base patterns, and words that announce such data (English, German, French, Spanish).
EMAIL = Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.9,
             r"e-?mail|mail|contact|kontakt|correo|courriel", "@")
IP = Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.7, r"\bip\b|address|host|server|adresse|dirección", ".")
CARD = Kind("card", r"[0-9](?:[\x20-]?[0-9])++", 0.8, r"card|visa|master|amex|credit|karte|carte|tarjeta")
PHONE = Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7,
             r"phone|\btel|call|mobile|cell|handy|téléphone|teléfono|móvil|fax", "+")
IBAN = Kind("iban", _iban_pattern(), 0.9, r"iban|konto|account|compte|cuenta|bank", takes=4)
SHORT_CARD = Kind("short_card", r"(?<![0-9.+-])[0-9](?:[\x20-]?[0-9]){12,14}(?![0-9.-])", 0.4, CARD.context)
SSN = Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.4, r"\bssn\b|social security|sozialvers", "-")

BASE = (EMAIL, IP, CARD, PHONE)   # in the order in which they are listed
ADDED = (IBAN, SHORT_CARD, SSN)
CONTEXT_CHARS, CONTEXT_SCORE, ACCEPT = 40, 0.4, 0.6
#: Characters after what a match uses up that hold its own rest (an IBAN with its spaces has 42) and its context.
REACH = CONTEXT_CHARS + 40


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _folded(pieces: Column, start: Column, kind: Kind) -> Column:
    """State after the last of the (gap, hit) pieces: position, number of hits, text before; and the pieces' spans."""
    zero = F.struct(start["at"].alias("at"), start["n"].alias("n"), start["tail"].alias("tail"),
                    F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        begin, hit = acc["at"] + F.length(piece["gap"]), piece["hit"]
        used = F.left(hit, F.lit(kind.takes)) if kind.takes else hit
        before = F.right(F.concat(acc["tail"], piece["gap"]), F.lit(CONTEXT_CHARS))
        span = F.struct(begin.alias("start"), (begin + F.length(hit)).alias("end"), hit.alias("value"),
                        before.alias("before"), acc["n"].alias("n"))
        return F.struct((begin + F.length(used)).alias("at"), (acc["n"] + 1).alias("n"),
                        F.right(F.concat(before, used), F.lit(CONTEXT_CHARS)).alias("tail"),
                        F.concat(acc["out"], F.array(span.cast(SPAN))).alias("out"))

    return F.aggregate(pieces, zero, step)


def pieces_of(text: Column, kind: Kind) -> Column:
    """Gap before each match and the match, leftmost ones first; the last gap comes with a null. Null without matches."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(1 if kind.takes else 0))
    gaps = F.split(text, kind.pattern, -1)
    found = let(hits, lambda some: F.when(F.size(some) > 0, F.zip_with(
        gaps, some, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))))
    return F.when(F.contains(text, F.lit(kind.hint)), found) if kind.hint else found


def matches(pieces: Column, kind: Kind) -> Column:
    """All matches of a pattern as spans in code points, with the text before each and its number from 0."""
    empty = F.array().cast(f"array<{SPAN}>")
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit("").alias("tail"), empty.alias("out"))
    n_hits = F.size(pieces) - 1

    def block(acc: Column, n: Column) -> Column:
        size = F.least(F.lit(BLOCK), n_hits - n * BLOCK)
        return let(_folded(F.slice(pieces, n * BLOCK + 1, size), acc, kind), lambda some: F.struct(
            some["at"].alias("at"), some["n"].alias("n"), some["tail"].alias("tail"),
            F.concat(acc["out"], some["out"]).alias("out")))

    blocks = F.sequence(F.lit(0), F.floor((n_hits - 1) / BLOCK).cast("int"))
    return F.when(n_hits > 0, F.aggregate(blocks, zero, block)["out"]).otherwise(empty)


def text_after(pieces: Column, span: Column, kind: Kind) -> Column:
    """The text after a match. A gap and a match together have two characters or more, so few pieces are enough."""
    def head(piece: Column) -> Column:
        hit = F.left(piece["hit"], F.lit(kind.takes)) if kind.takes else piece["hit"]
        return F.concat(F.left(piece["gap"], F.lit(REACH)), F.coalesce(F.left(hit, F.lit(REACH)), F.lit("")))

    # A piece that is cut at REACH has enough characters itself, so what would follow it doesn't count.
    near = F.array_join(F.transform(F.slice(pieces, span["n"] + 2, REACH // 2), lambda p: F.left(head(p), F.lit(REACH))), "")
    rest = F.length(span["value"]) - kind.takes + 1 if kind.takes else F.lit(1)
    return F.substring(near, rest, F.lit(CONTEXT_CHARS))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The checksum of card numbers: every second digit from the right doubled, digit sums added, divisible by ten."""
    n = F.length(number)
    places = F.sequence(F.lit(1), n)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(number, i, F.lit(1)).cast("int") * (1 + (n - i) % 2)
        return total + F.when(digit > 9, digit - 9).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """The checksum of IBANs: first four characters last, letters as 10 to 35, remainder 1."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, character: Column) -> Column:
        code = F.ascii(character)
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), add) == 1


def confirmed(kind: Kind, value: Column) -> Column:
    """Whether a proposed span passes its kind's check."""
    if kind is IP:
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind is CARD:
        return let(digits(value), lambda d: F.length(d).between(16, 19) & luhn(d))
    if kind is PHONE:
        return F.length(digits(value)).between(8, 15)
    if kind is IBAN:
        return mod97(value)
    if kind is SHORT_CARD:
        return let(digits(value), luhn)
    if kind is SSN:
        return ~value.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def spans_of(text: Column, kind: Kind) -> Column:
    """Confirmed and scored spans of one kind: array of ``start, end, value, score``."""
    def scored(pieces: Column, s: Column) -> Column:
        word = f"(?i)(?u)(?:{kind.context})"
        near = s["before"].rlike(word) | text_after(pieces, s, kind).rlike(word)
        return F.struct(s["start"], s["end"], s["value"], F.least(
            F.lit(1.0), kind.score + F.when(near, CONTEXT_SCORE).otherwise(0.0)).alias("score"))

    out = let(pieces_of(text, kind), lambda pieces: F.transform(
        F.filter(matches(pieces, kind), lambda s: confirmed(kind, s["value"])), lambda s: scored(pieces, s)))
    return out if kind in BASE else F.filter(out, lambda s: s["score"] >= ACCEPT)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with one array column per kind (``email``, ``ip``, ``card``, ``phone``, ``iban``, ``short_card``,
    ``ssn``) of spans ``start, end, value, score`` in code points, end exclusive.

    The base kinds keep every confirmed match whatever its score; the added kinds only those that reach ``ACCEPT``, short
    cards and social security numbers thus only with a context word within 40 characters before or after them. A short
    card or ssn within a base span is dropped. Null counts as empty and has no spans. Rows are neither dropped nor merged; columns of these names are
    replaced.
    """
    text = whole_text("text")
    out = docs.withColumns({k.name: spans_of(text, k) for k in (*BASE, *ADDED)})
    base = F.concat(*[F.col(k.name) for k in BASE])
    alone = {k.name: F.filter(F.col(k.name), lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
             for k in (SHORT_CARD, SSN)}
    return out.withColumns(alone)


def joined(kinds: tuple[Kind, ...]) -> Column:
    """``kind:start:end`` of the kinds' spans, comma-joined."""
    return F.array_join(F.concat(*[F.transform(F.col(k.name), lambda s: F.concat(
        F.lit(f"{k.name}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))) for k in kinds]), ",")


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every base match and IBAN in ``text`` replaced by its kind in angle brackets; the rest is unchanged.

    Works on ``find_personal_data``'s output: spans of all kinds in order of their start, of overlapping ones the first.
    """
    kinds = (*BASE, *ADDED)
    spans = F.array_sort(F.concat(*[F.transform(F.col(k.name), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(k.name).alias("kind"))) for k in kinds]))
    text = whole_text("text")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        out = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(F.when(apart, s["end"]).otherwise(acc["at"]).alias("at"),
                        F.when(apart, out).otherwise(acc["out"]).alias("out"))

    whole = F.aggregate(spans, zero, step)
    return docs.withColumn("text", F.when(F.size(spans) > 0, F.concat(
        whole["out"], F.substring(text, whole["at"] + 1, F.length(text)))).otherwise(F.col("text")))


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in BASE],
                        F.sha2(joined(BASE), 256).alias("base_sha256"), joined((*BASE, *ADDED)).alias("spans"))
