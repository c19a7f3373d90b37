"""Personal data: expressions propose spans, checks confirm them, context words adjust the score.

All of it is DataFrame functions. A kind's expression is matched leftmost and
without overlap over the whole text; the text between the matches gives their
places in code points. A match then gets the kind's own score, more if its
checksum or format check holds, and more again if one of the kind's context words
stands shortly before it. What reaches ``THRESHOLD`` is a span.

The expressions are written so that no position of a long text is scanned twice:
possessive quantifiers, and a start only where a run of the leading class starts or
the last match ended, which finds the same matches.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import with_own, with_settled

THRESHOLD = 0.5
#: Code points before a match in which context words count.
CONTEXT = 40

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(match: Column, separators: str) -> Column:
    return F.translate(match, separators, "")


def passes_luhn(digits: Column) -> Column:
    """Whether a string of decimal digits ends in its Luhn check digit."""

    def place(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), place)
    return (F.length(digits) > 0) & (total % 10 == 0)


def passes_mod97(code: Column) -> Column:
    """Whether letters and digits, first four moved to the end, leave 1 when divided by 97."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def place(rest: Column, i: Column) -> Column:
        one = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(one >= 65, (rest * 100 + one - 55) % 97).otherwise((rest * 10 + one - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), place) == 1


def _between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


@dataclass(frozen=True)
class Kind:
    """How one kind of span is proposed, confirmed and scored.

    ``present`` is a cheap test that every text with a match passes. ``needs_check``
    drops a match that fails ``check``; else the check only adds to the score.
    """

    name: str
    pattern: str
    present: Callable[[Column], Column]
    check: Callable[[Column], Column]
    score: float
    checked: float = 0.0
    needs_check: bool = True
    words: tuple[str, ...] = ()
    context: float = 0.0


#: Fixed expressions of the base kinds, in their fixed order.
BASE_KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda text: F.contains(text, F.lit("@")),
        lambda match: F.lit(True),
        score=0.9,
        words=("mail", "contact"),
        context=0.1,
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
        lambda text: F.rlike(text, F.lit(r"[0-9]\.[0-9]")),
        lambda match: F.rlike(match, F.lit(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")),
        score=0.3,
        checked=0.3,
        words=("ip", "address", "host"),
        context=0.2,
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda text: F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")),
        lambda match: _between(F.length(_digits(match, " -")), 16, 19) & passes_luhn(_digits(match, " -")),
        score=0.3,
        checked=0.5,
        words=("card", "visa", "mastercard", "payment"),
        context=0.2,
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda text: F.contains(text, F.lit("+")),
        lambda match: _between(F.length(_digits(match, "+ ().-")), 8, 15),
        score=0.3,
        checked=0.4,
        words=("phone", "call", "tel", "mobile"),
        context=0.2,
    ),
)

# The length of an international account number by its country.
IBAN_LENGTHS = """
AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29
ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20
LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25
QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20
"""


def _iban_forms() -> str:
    """An alternative for each length: its countries, two digits, and the rest in groups of four.

    The length ends the span, so a word or number that follows is not taken along.
    """
    countries: dict[int, list[str]] = {}
    for entry in IBAN_LENGTHS.split():
        countries.setdefault(int(entry[2:]), []).append(entry[:2])
    forms = []
    for length, codes in sorted(countries.items()):
        groups, rest = divmod(length - 4, 4)
        tail = rf"\x20?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{'|'.join(codes)})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    return "|".join(forms)


#: Kinds that the checksums and the context words add.
ADDED_KINDS = (
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?:{_iban_forms()})(?![A-Za-z0-9])",
        lambda text: F.rlike(text, F.lit(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}")),
        lambda match: _between(F.length(_digits(match, " ")), 15, 34) & passes_mod97(_digits(match, " ")),
        score=0.2,
        checked=0.6,
        words=("iban", "account", "bank"),
        context=0.2,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda text: F.rlike(text, F.lit(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")),
        lambda match: ~F.rlike(match, F.lit("^(?:000|666|9)|-00-|-0000$")),
        score=0.1,
        checked=0.2,
        words=("ssn", "social security"),
        context=0.4,
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,64}(?![A-Za-z0-9])",
        lambda text: F.rlike(text, F.lit(r"[A-Fa-f0-9]{32}")),
        lambda match: F.rlike(match, F.lit("[A-Fa-f]")) & F.rlike(match, F.lit("[0-9]")),
        score=0.1,
        checked=0.2,
        words=("token", "secret", "api key", "api_key", "password"),
        context=0.4,
    ),
)

SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _spans(text: str, matches: str, pieces: str, kind: Kind) -> Column:
    """The confirmed spans of one kind from its matches and the text between them."""

    def score(match: Column, start: Column) -> Column:
        total = F.lit(kind.score) + F.when(kind.check(match), F.lit(kind.checked)).otherwise(F.lit(0.0))
        if kind.words:
            before = F.lower(F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT))))
            near = F.rlike(before, F.lit(r"(?<![a-z])(?:" + "|".join(kind.words) + ")"))
            total = total + F.when(near, F.lit(kind.context)).otherwise(F.lit(0.0))
        return total

    def step(state: Column, i: Column) -> Column:
        match = F.get(matches, i)
        start = state["at"] + F.char_length(F.get(pieces, i))
        end = start + F.char_length(match)
        span = F.struct(
            F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score(match, start).alias("score")
        ).cast(SPAN)
        accepted = kind.check(match) if kind.needs_check else F.lit(True)
        return F.struct(
            end.alias("at"), F.when(accepted, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans")
        )

    found = F.aggregate(
        F.sequence(F.lit(0), F.size(matches) - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans")),
        step,
        lambda state: state["spans"],
    )
    confirmed = F.filter(found, lambda span: span["score"] >= THRESHOLD)
    return F.when(F.size(matches) > 0, confirmed).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_pii(
    df: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = BASE_KINDS + ADDED_KINDS
) -> DataFrame:
    """``df`` with ``pii``: all spans by kind as listed, then start; ends are exclusive.

    A null text counts as empty and has none. Spans of different kinds may overlap. A
    column of the name ``pii`` is replaced.
    """
    base = with_own(df, {"_pii_text": F.coalesce(F.col(f"`{text}`"), F.lit(""))})
    whole = F.col("_pii_text")
    empty = F.array().cast("array<string>")
    base = base.withColumns(
        {
            f"_pii_m_{k.name}": F.when(k.present(whole), F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0))).otherwise(empty)
            for k in kinds
        }
    )
    base = base.withColumns(
        {
            f"_pii_p_{k.name}": F.when(F.size(f"_pii_m_{k.name}") > 0, F.split(whole, k.pattern, -1)).otherwise(empty)
            for k in kinds
        }
    )
    parts = [_spans("_pii_text", f"_pii_m_{k.name}", f"_pii_p_{k.name}", k) for k in kinds]
    own = [c for c in base.columns if c.startswith("_pii_")]
    return with_settled(base, {"pii": F.concat(*parts)}).drop(*own)


def span_list(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined in their order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """``df`` with every span of its text replaced by ``[KIND]``.

    Spans that overlap are replaced as one, under the kind of the first. A text
    without spans, a null one included, stays as it is.
    """
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    base = with_own(df, {"_pii_sorted": ordered})

    def merge(done: Column, span: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"), last["kind"].alias("kind"))
        overlaps = F.coalesce(span["start"] < last["end"], F.lit(False))
        return F.when(overlaps, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(
            F.concat(done, F.array(F.struct(span["start"].alias("start"), span["end"].alias("end"), span["kind"].alias("kind"))))
        )

    merged = F.aggregate(F.slice("_pii_sorted", 2, F.size("_pii_sorted")), F.slice("_pii_sorted", 1, 1), merge)
    base = base.withColumn("_pii_merged", F.when(F.size("_pii_sorted") > 0, merged))
    whole = F.col(f"`{text}`")

    def piece(span: Column, i: Column) -> Column:
        at = F.coalesce(F.get("_pii_merged", i - 1)["end"], F.lit(0))
        return F.concat(F.substring(whole, at + 1, span["start"] - at), F.lit("["), F.upper(span["kind"]), F.lit("]"))

    end = F.get("_pii_merged", F.size("_pii_merged") - 1)["end"]
    rest = F.substring(whole, end + 1, F.char_length(whole))
    clean = F.concat(F.array_join(F.transform("_pii_merged", piece), ""), rest)
    order = df.columns
    changed = with_own(base, {text: F.when(F.size("_pii_sorted") > 0, clean).otherwise(whole)})
    return changed.select(*(F.col(f"`{c}`") for c in order))
