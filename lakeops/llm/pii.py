"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Only DataFrame expressions and no shuffle. Places are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.native import PAGE, let, pages_of, part, running_starts, scan, unused

# The base kinds and their patterns. Look-behinds and possessive repeats only
# spare the regular expression engine work; what matches is the plain pattern beside each.
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+
#   phone  \+[0-9][\x20().0-9-]+[0-9]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Added kinds.
# Signs of an account number by country. What follows a number can look like more
# of it ("... 00 Please"), so only its length says where it ends.
IBAN_SIGNS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LISTED = "|".join(
    f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])" for n, codes in IBAN_SIGNS.items()
)
# Codes not listed: as much as a number can hold and the sign after it; the check finds the end.
IBAN_OTHER = f"(?!{'|'.join(' '.join(IBAN_SIGNS.values()).split())})[A-Z]{{2}}[0-9]{{2}}(?:\\x20?[A-Z0-9]){{11,30}}[A-Za-z0-9]?"
# Nothing is consumed: a number that begins inside a failing match is found too.
IBAN = rf"(?<![A-Za-z0-9])(?=({IBAN_LISTED}|{IBAN_OTHER}))"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SECRET = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{32,}+"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

CONTEXT_CHARS = 40


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits ends in its Luhn check digit."""
    value = F.reverse(F.split(digits, "(?<=.)(?=.)"))

    def weighed(x: Column, i: Column) -> Column:
        n = F.when(i % 2 == 1, x.cast("int") * 2).otherwise(x.cast("int"))
        return F.when(n > 9, n - 9).otherwise(n)

    return F.aggregate(F.transform(value, weighed), F.lit(0), lambda a, n: a + n) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number leaves 1 by 97: first four signs last, letters as 10 to 35."""
    compact = F.replace(code, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, F.lit(5), F.char_length(compact)), F.substring(compact, 1, 4))

    def fold(rest: Column, sign: Column) -> Column:
        number = F.ascii(sign)
        return F.when(number < 58, (rest * 10 + number - 48) % 97).otherwise((rest * 100 + number - 55) % 97)

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), fold) == 1


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.char_length(digits).between(12, 19), luhn(digits)).otherwise(False)


def _phone(value: Column) -> Column:
    return F.char_length(_digits(value)).between(9, 15)


def _iban(value: Column) -> Column:
    """The longest beginning of a candidate that is an account number of 15 to 34 signs, else null."""
    listed = value.rlike(f"^(?:{IBAN_LISTED})$")
    sizes = F.array(*[F.lit(rf"^[A-Z0-9](?:\x20?[A-Z0-9]){{{n - 1}}}(?![A-Za-z0-9])") for n in range(34, 14, -1)])
    cut = F.transform(sizes, lambda p: F.call_function("regexp_extract", value, p, F.lit(0)))
    whole = F.when(listed, F.array(value)).otherwise(F.filter(cut, lambda c: c != ""))
    return F.get(F.filter(whole, mod97), F.lit(0))


@dataclass(frozen=True)
class Kind:
    """A pattern, what a text must hold to be searched, the check of a match, and its scores.

    With ``ahead`` the pattern is empty but for its first group, which holds a candidate that may
    overlap others; ``valid`` then gives the part of it that is the match, or null.

    Base spans stay whatever their score. Others need ``least``: ``score`` alone, or with
    ``boost`` where one of ``words`` stands within :data:`CONTEXT_CHARS` before or after.
    """

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column] | None
    score: float
    words: Sequence[str]
    base: bool = False
    boost: float = 0.4
    least: float = 0.6
    ahead: bool = False


KINDS = (
    Kind("email", EMAIL, "@", None, 0.9, ("mail", "contact", "write"), base=True),
    Kind("ip", IP, r"[0-9]\.[0-9]", lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), 0.6, ("ip", "address", "host", "server"), base=True),
    Kind("card", CARD, "[0-9][0-9 -]", _card, 0.7, ("card", "visa", "credit", "payment"), base=True),
    Kind("phone", PHONE, r"\+[0-9]", _phone, 0.6, ("phone", "call", "tel", "mobile", "fax"), base=True),
    Kind("iban", IBAN, "[A-Z][0-9]", _iban, 0.9, ("iban", "account", "bank"), ahead=True),
    Kind("ssn", SSN, "[0-9]-[0-9]", lambda v: ~v.rlike("^(?:000|666|9)|-00-|0000$"), 0.3, ("ssn", "social", "security")),
    Kind("secret", SECRET, "[0-9]", lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]"), 0.3, ("token", "secret", "password", "api key", "apikey")),
)


def _cut(span: Column, value: Column) -> Column:
    """A candidate found one sign late, with the part of it that is the match."""
    return let(
        value,
        lambda v: F.struct((span["start"] - 1).alias("start"), (span["start"] - 1 + F.char_length(v)).alias("end"), v.alias("value")),
    )


def _apart(spans: Column) -> Column:
    """Spans with a value, in order; one that begins inside another is left out."""

    def add(end: Column, s: Column) -> Column:
        free = s["start"] >= end
        kept = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
        return F.struct(
            F.when(free, s["end"]).otherwise(end).alias("state"), F.when(free, kept).otherwise(F.slice(kept, 1, 0)).alias("added")
        )

    valid = F.filter(spans, lambda s: s["value"].isNotNull())
    return scan(valid, F.lit(-1).cast("long"), add, "array<struct<start: long, end: long, value: string>>")


def _found(text: Column, kind: Kind) -> Column:
    """Valid matches of one kind: array of start, end, value, kind and score.

    The pieces between matches and the matches themselves give the places. A failing match is
    dropped and its text not searched again, but for kinds that look ahead.
    """
    # An empty match at the very start would give no piece, so one sign stands before the text.
    searched = F.concat(F.lit(" "), text) if kind.ahead else text
    matched = F.struct(
        F.split(searched, kind.pattern, -1).alias("gaps"),
        F.regexp_extract_all(searched, F.lit(kind.pattern), F.lit(int(kind.ahead))).alias("values"),
    )

    def place(m: Column) -> Column:
        gaps, values = m["gaps"], m["values"]
        pairs = F.zip_with(
            F.slice(gaps, 1, F.size(values)),
            values,
            lambda g, v: F.struct(
                F.char_length(g).alias("gap"), (F.lit(0) if kind.ahead else F.char_length(v)).alias("size"), v.alias("value")
            ),
        )
        return let(
            pairs,
            lambda p: F.zip_with(
                p,
                running_starts(p, lambda x: x["gap"] + x["size"]),
                lambda x, s: F.struct(
                    (s + x["gap"]).alias("start"),
                    (s + x["gap"] + x["size"]).alias("end"),
                    x["value"].alias("value"),
                ),
            ),
        )

    spans = let(matched, lambda m: F.when(F.size(m["values"]) > 0, place(m)).otherwise(F.filter(place(m), lambda _: F.lit(False))))
    if kind.ahead:
        spans = _apart(F.transform(spans, lambda s: _cut(s, kind.valid(s["value"]))))
    elif kind.valid:
        spans = F.filter(spans, lambda s: kind.valid(s["value"]))
    listed = "(?i)(?<![a-z])(?:" + "|".join(kind.words) + ")"

    def scored(s: Column, pages: Column) -> Column:
        start, end = F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["end"] + CONTEXT_CHARS
        around = F.when(F.size(pages) > 0, part(pages, start, end)).otherwise(
            F.substring(text, (start + 1).cast("int"), (end - start).cast("int"))
        )
        score = F.when(around.rlike(listed), F.least(F.lit(1.0), F.lit(kind.score + kind.boost))).otherwise(F.lit(kind.score))
        return F.struct(
            s["start"].alias("start"),
            F.lit([k.name for k in KINDS].index(kind.name)).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind.name).alias("kind"),
            s["value"].alias("value"),
            score.alias("score"),
        )

    # A text of few characters is cut as it is.
    pages = F.when(F.char_length(text) > 4 * PAGE, pages_of(text)).otherwise(F.array().cast("array<string>"))
    out = let(F.struct(spans.alias("spans"), pages.alias("pages")), lambda m: F.transform(m["spans"], lambda s: scored(s, m["pages"])))
    if not kind.base:
        out = F.filter(out, lambda s: s["score"] >= kind.least)
    return F.when(text.rlike(kind.hint), out).otherwise(F.array())


def personal_spans(text: Column) -> Column:
    """Spans of a text in order of start, then kind as listed.

    A span has ``start``, ``rank``, ``end``, ``kind``, ``value`` and ``score``. Matches of one kind
    do not overlap, those of different kinds may.
    """
    return F.array_sort(F.concat(*[_found(text, kind) for kind in KINDS]))


def masked_text(text: Column, found: Column, mask: str = "[{}]") -> Column:
    """Text with each span replaced by its kind; of overlapping spans the first stands and covers
    the others."""
    before, after = (F.lit(side) for side in mask.split("{}"))

    def step(end: Column, s: Column) -> Column:
        """The text between spans by its ends, and what stands for a span that no earlier one covers."""
        fresh = F.array(F.struct(end.alias("a"), s["start"].alias("b"), s["kind"].alias("kind")))
        return F.struct(
            F.greatest(end, s["end"]).alias("state"),
            F.when(s["start"] >= end, fresh).otherwise(F.slice(fresh, 1, 0)).alias("added"),
        )

    pieces = scan(found, F.lit(0).cast("long"), step, "array<struct<a: long, b: long, kind: string>>")
    last = F.array_max(F.transform(found, lambda s: s["end"]))

    def filled(m: Column) -> Column:
        listed = F.transform(m["pieces"], lambda p: F.concat(part(m["pages"], p["a"], p["b"]), before, F.upper(p["kind"]), after))
        return F.concat(F.array_join(listed, ""), F.substring(text, (last + 1).cast("int"), F.char_length(text)))

    masked = let(F.struct(pieces.alias("pieces"), pages_of(text).alias("pages")), filled)
    return F.when(F.size(found) > 0, masked).otherwise(text)


def find_personal_data(documents: DataFrame, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and ``found``: the spans of every text (see :func:`personal_spans`).

    One row per input row, repeated ids included; a null text is empty and has no spans; a null id
    stays null. Texts of any length are searched whole. An empty table gives an empty result;
    further columns are ignored.
    """
    read = documents.select(
        F.col(f"`{id_name}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )
    # A generator keeps the search from being copied into every later use of its result.
    return read.select("doc_id", "text", F.explode(F.array(personal_spans(F.col("text")))).alias("found"))


def mask_personal_data(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows, with all their columns, and their personal data masked.

    One row per input row, repeated ones included; a null text stays null and an empty one empty.
    Overlapping finds: see :func:`masked_text`. Texts of any length are masked whole. An empty
    table gives an empty result; columns may have any names.
    """
    name, spans_name = f"`{text}`", unused(documents.columns, "__found")
    spans = F.explode(F.array(personal_spans(F.coalesce(F.col(name).cast("string"), F.lit("")))))
    found = documents.select("*", spans.alias(spans_name))
    return found.withColumn(text, masked_text(F.col(name), F.col(spans_name))).drop(spans_name)
