"""Personal data in text: patterns propose spans, checksums confirm them, nearby words adjust the score.

Strong kinds count wherever their pattern and their validator agree: e-mail, IP address, payment card
(Luhn), telephone number with a country code, bank account (IBAN length of the country and mod-97).
Weak kinds, numbers that may as well be something else (social security number, national telephone
number), also need a word nearby that speaks for them. A weak span that overlaps a strong one goes.

DataFrame functions only, all inside one row: no shuffle at any size. A pattern splits the text into
the pieces between its matches; places are running sums over the lengths of pieces and matches, and the
words nearby are the ends of the adjoining pieces, so the work is linear in the text and nearly so in
the matches. The patterns take no step back: unbounded repetitions are possessive and start only where
a run of their characters starts, so that a text of a million equal signs costs a single pass.

Defined results: null text counts as empty and has no span; a null id stays; one output row per input
row; repeated rows repeat. Places are code points, the end is exclusive. Kinds may overlap each other.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaystats.llm.text import let, pick

# IBAN lengths by country, without blanks.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
_IBAN = "|".join(f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())

# The patterns of the kinds, in the order in which kinds of one place are listed.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": rf"(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "tel": r"\(?[0-9]{3,5}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}",
}
KINDS = tuple(PATTERNS)
BASE = KINDS[:4]
WEAK = ("ssn", "tel")

# Score of a confirmed span, words that raise it and words that lower it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "tel": 0.3}
FOR = {
    "email": ("mail", "contact", "write", "send", "reply"),
    "ip": ("ip", "address", "host", "server", "client", "login"),
    "card": ("card", "credit", "debit", "visa", "mastercard", "amex", "payment"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "cell", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "tel": ("phone", "tel", "telephone", "call", "mobile", "fax", "cell", "whatsapp", "telefon", "téléphone", "teléfono"),
}
AGAINST = ("version", "release", "build", "isbn", "order", "invoice", "serial", "sku", "ticket", "section")
RAISE, LOWER, ENOUGH = 0.3, 0.3, 0.6
BEFORE, AFTER = 40, 20

_BLOCK = 64


def scan(values: Column, zero: int, combine: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """Running results of ``combine`` over an array of ints. Short arrays directly; longer ones in blocks,
    whose totals are scanned in the same way, so that no array is copied once per element."""

    def direct(a: Column) -> Column:
        empty = F.array().cast("array<int>")
        last = lambda done: F.coalesce(F.get(done, F.size(done) - 1), F.lit(zero))
        return F.aggregate(a, empty, lambda done, x: F.concat(done, F.array(combine(last(done), x))))

    def by_block(a: Column) -> Column:
        count = F.ceil(F.size(a) / _BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: direct(F.slice(a, b * _BLOCK + 1, _BLOCK)))

        def joined(inside: Column) -> Column:
            totals = F.transform(inside, lambda b: F.get(b, F.size(b) - 1))
            before = lambda t, i: F.coalesce(F.get(t, i - 1), F.lit(zero))
            return let(
                scan(totals, zero, combine, levels - 1),
                lambda t: F.flatten(F.transform(inside, lambda b, i: F.transform(b, lambda x: combine(before(t, i), x)))),
            )

        return let(blocks, joined)

    if levels == 0:
        return direct(values)
    return let(values, lambda a: F.when(F.size(a) <= _BLOCK, direct(a)).otherwise(by_block(a)))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""

    def added(total: Column, place: Column) -> Column:
        digit = F.ascii(F.substr(digits, F.length(digits) - place, F.lit(1))) - 48
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), added) % 10 == 0


def mod_97(iban: Column) -> Column:
    """Whether an account number without blanks leaves 1 modulo 97, letters counted as 10 to 35."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def added(rest: Column, place: Column) -> Column:
        sign = F.ascii(F.substr(turned, place, F.lit(1)))
        return F.when(sign < 65, rest * 10 + (sign - 48)).otherwise(rest * 100 + (sign - 55)) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(iban)), F.lit(0), added) == 1


def _valid(kind: str, found: Column) -> Column:
    """The validator of a kind over the matched text."""
    if kind == "ip":
        shown = lambda p: F.ltrim(p, F.lit("0"))
        small = lambda p: (F.length(shown(p)) <= 3) & (F.lpad(shown(p), 3, "0") <= "255")
        return F.forall(F.split(found, r"\."), small)
    if kind == "card":
        return let(_digits(found), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    if kind == "iban":
        return mod_97(F.translate(found, " ", ""))
    if kind == "ssn":
        return ~found.rlike("^(?:000|666|9)") & ~found.rlike("-00-|-0000$")
    return F.lit(True)


def _apart(kind: str, before: Column, after: Column, first: Column, last: Column) -> Column:
    """Kinds with a fixed length must not be cut out of something longer."""
    if kind in BASE:
        return F.lit(True)
    signs = "[A-Za-z0-9]" if kind == "iban" else "[0-9+-]"
    left = F.when(before == "", first).otherwise(~before.rlike(f"{signs}\\z"))
    return left & F.when(after == "", last).otherwise(~after.rlike(f"^{signs}"))


def _has_word(near: Column, words: tuple[str, ...]) -> Column:
    return F.arrays_overlap(F.split(F.lower(near), r"[^\p{L}]+"), F.array(*map(F.lit, words)))


def spans_of(kind: str, text: Column) -> Column:
    """The confirmed spans of one kind: array of (start, rank, end, kind, score, text)."""
    pattern, rank = PATTERNS[kind], KINDS.index(kind)

    def located(m: Column) -> Column:
        found, pieces = m["found"], m["pieces"]
        steps = F.zip_with(found, F.slice(pieces, 1, F.size(found)), lambda x, p: F.length(x) + F.length(p))

        def span(ends: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                before, after = F.get(pieces, i), F.get(pieces, i + 1)
                near = F.concat_ws(" ", F.right(before, F.lit(BEFORE)), F.left(after, F.lit(AFTER)))
                good = _valid(kind, x) & _apart(kind, before, after, i == 0, i == F.size(found) - 1)
                score = (
                    F.lit(SCORES[kind])
                    + F.when(_has_word(near, FOR[kind]), RAISE).otherwise(0.0)
                    - F.when(_has_word(near, AGAINST), LOWER).otherwise(0.0)
                )
                made = F.struct(
                    (F.get(ends, i) - F.length(x)).alias("start"),
                    F.lit(rank).alias("rank"),
                    F.get(ends, i).alias("end"),
                    F.lit(kind).alias("kind"),
                    F.round(F.least(score, F.lit(1.0)), 2).alias("score"),
                    x.alias("text"),
                )
                return F.when(good, made)

            kept = F.filter(F.transform(found, one), lambda s: s.isNotNull())
            return F.filter(kept, lambda s: s["score"] >= ENOUGH) if kind in WEAK else kept

        return let(scan(steps, 0, lambda a, b: a + b), span)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(found.alias("found"), F.split(text, pattern, -1).alias("pieces"))
    return F.when(text.rlike(pattern), let(both, located)).otherwise(F.array().cast(SPANS))


SPANS = "array<struct<start:int,rank:int,end:int,kind:string,score:double,text:string>>"


def _free(strong: Column, weak: Column) -> Column:
    """Strong spans, and the weak ones that overlap none of them, by place."""
    big = (1 << 31) - 1

    def merged(spans: Column) -> Column:
        is_strong = lambda s: ~s["kind"].isin(*WEAK)
        ends = F.transform(spans, lambda s: F.when(is_strong(s), s["end"]).otherwise(0))
        starts = F.reverse(F.transform(spans, lambda s: F.when(is_strong(s), s["start"]).otherwise(big)))
        reach = F.struct(
            scan(ends, 0, F.greatest).alias("left"), F.reverse(scan(starts, big, F.least)).alias("right")
        )
        clear = lambda r, s, i: (F.get(r["left"], i) <= s["start"]) & (F.get(r["right"], i) >= s["end"])
        return let(reach, lambda r: F.filter(spans, lambda s, i: is_strong(s) | clear(r, s, i)))

    return let(
        F.struct(strong.alias("strong"), weak.alias("weak")),
        lambda s: F.when(F.size(s["weak"]) == 0, s["strong"]).otherwise(
            let(F.sort_array(F.concat(s["strong"], s["weak"])), merged)
        ),
    )


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) per input row: spans by place, each (start, rank, end, kind, score, text)."""
    docs = pick(docs, id_col, text_col).toDF("id", "raw")
    docs = docs.select("id", F.coalesce("raw", F.lit("")).alias("t"))
    text = F.col("t")
    strong = F.concat(*(spans_of(k, text) for k in KINDS if k not in WEAK))
    weak = F.concat(*(spans_of(k, text) for k in WEAK))
    return docs.select(F.col("id").alias(id_col), F.sort_array(_free(strong, weak)).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the digest of their places, and all places."""
    of = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    return found.select(
        id_col,
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
