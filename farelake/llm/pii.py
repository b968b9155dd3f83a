"""Personal data: regular expressions propose, checksums confirm, context words adjust the score.

Everything is a column expression, so the scan is one pass without a shuffle.

Cases: null text is empty; empty text has no spans; repeated rows give repeated results; a null or
repeated doc_id is passed on; an empty table gives an empty table; other columns are ignored by
`find_pii` and passed on by `redact`. Texts of any length are scanned whole: the patterns are
possessive or of fixed length, so long runs of digits or letters cost linear time and no stack. What
stands around a match is cut from blocks of the text (`cut`), not from its start, and lists of spans grow
in chunks (`walked`), so a long text with many matches takes as long as many short ones.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import let

SPAN = "array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right Luhn check digit."""

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substr(number, F.length(number) - i + 1, F.lit(1))) - 48
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add)
    return (F.length(number) > 0) & (total % 10 == 0)


def mod97(account: Column) -> Column:
    """Whether an account number (letters and digits, country first) leaves 1 by ISO 7064 mod 97-10."""

    def add(rest: Column, i: Column) -> Column:
        # The four leading characters are read last.
        code = F.ascii(F.substr(account, (i + 3) % F.length(account) + 1, F.lit(1)))
        letter = code > 57
        shift = F.when(letter, 100).otherwise(10)
        value = F.when(letter, code - 55).otherwise(code - 48)
        return (rest * shift + value) % 97

    rest = F.aggregate(F.sequence(F.lit(1), F.length(account)), F.lit(0), add)
    return (F.length(account) > 4) & (rest == 1)


def between(length: Column, low: int, high: int) -> Column:
    return (length >= low) & (length <= high)


def ip_parts(value: Column) -> Column:
    """Whether every part is at most 255; leading zeros do not count."""
    return F.forall(
        F.split(value, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) < 3) | ((F.length(q) == 3) & (q <= "255")))
    )


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    `cue` is a cheap pattern without which no match exists; `pattern` proposes; `valid` confirms;
    `score` holds without context; each context word pattern found within `near` characters adds
    `bonus`. A span stays if its score reaches `THRESHOLD`.

    With a `head`, a match takes that many characters only and its value is group 1, which looks ahead:
    a value that is not confirmed then hides none that starts inside it.
    """

    name: str
    cue: str
    pattern: str
    valid: Callable[[Column], Column]
    score: float
    context: str
    bonus: float = 0.3
    near: int = 40
    head: int | None = None


THRESHOLD = 0.5

#: The base kinds reach the threshold without context, so a confirmed span always stays.
BASE = (
    Kind(
        "email",
        "@",
        # A match starts where the last one ended or where a run of name characters starts.
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda v: F.lit(True),
        0.7,
        r"e-?mail|correo|courriel|contact|kontakt",
    ),
    Kind(
        "ip",
        r"[0-9]\.[0-9]",
        r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ip_parts,
        0.6,
        r"\bip\b|address|server|host",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9]){15}",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda v: let(digits(v), lambda d: between(F.length(d), 16, 19) & luhn(d)),
        0.7,
        r"card|visa|credit|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9]",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda v: between(F.length(digits(v)), 8, 15),
        0.6,
        r"phone|\btel|call|mobile|handy|fax",
    ),
)

#: Lengths of account numbers by country (ISO 13616: the register, and countries that use the form unregistered).
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FK FI FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HN HR LI LV",
    22: "BG BH DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CM CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST",
    26: "DZ IR IS TR",
    27: "BI CF CG DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
COUNTRIES = "|".join(
    rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{length - 4}}}" for length, names in IBAN_LENGTHS.items()
)

#: Kinds beyond the base; the weak ones need context.
ADDED = (
    Kind(
        "iban",
        r"[A-Z]{2}[0-9]{2}",
        rf"(?<![A-Za-z0-9])(?=((?:{COUNTRIES})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}",
        lambda v: let(F.replace(v, F.lit(" "), F.lit("")), mod97),
        0.6,
        r"iban|account|bank|konto|compte|cuenta",
        head=4,
    ),
    Kind(
        "short_card",
        r"[0-9](?:[\x20-]?[0-9]){12}",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda v: let(digits(v), lambda d: between(F.length(d), 13, 15) & luhn(d)),
        0.3,
        r"card|visa|credit|karte|carte|tarjeta",
    ),
    Kind(
        "ssn",
        r"[0-9]-[0-9]",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda v: F.lit(True),
        0.3,
        r"\bssn\b|social security",
    ),
)


#: Characters of a block of a text, and members of a chunk of a list.
BLOCK, CHUNK = 2_000, 256


def blocks(text: Column) -> Column:
    """The text in blocks of `BLOCK` characters."""
    return F.when(F.length(text) <= BLOCK, F.array(text)).otherwise(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    )


def cut(held: Column, start: Column, end: Column) -> Column:
    """Characters from `start` on and before `end` of a text in blocks."""

    def block(number: Column) -> Column:
        return F.coalesce(F.get(held, number), F.lit(""))

    def between_blocks(b: Column) -> Column:
        first, last, at, upto = b["first"], b["last"], b["at"], b["upto"]
        inner = F.substr(block(first), at + 1, upto - at)
        middle = F.array_join(F.slice(held, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        outer = F.concat(F.substr(block(first), at + 1, F.lit(BLOCK)), middle, F.substr(block(last), F.lit(1), upto))
        return F.when(first == last, inner).otherwise(outer)

    places = F.struct(
        F.floor(start / BLOCK).cast("int").alias("first"),
        F.floor(end / BLOCK).cast("int").alias("last"),
        (start % BLOCK).cast("int").alias("at"),
        (end % BLOCK).cast("int").alias("upto"),
    )
    return let(places, between_blocks)


def walked(
    items: Column, carry: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]
) -> Column:
    """Walk a list with something carried along: (carry, found), the last of that and what was found, in order.

    `step` of what is carried and a member gives what is carried on, and what is found there: an array of
    type `kind`. An array that grew member by member would be copied as often as it has members.
    """
    none = F.array().cast(kind)

    def inner(state: Column, item: Column) -> Column:
        on, found = step(state["carry"], item)
        return F.struct(on.alias("carry"), F.concat(state["found"], found).alias("found"))

    def outer(state: Column, chunk: Column) -> Column:
        start = F.struct(state["carry"].alias("carry"), none.alias("found"))
        done = F.aggregate(chunk, start, inner)

        def grown(d: Column) -> Column:
            return F.struct(d["carry"].alias("carry"), F.concat(state["found"], F.array(d["found"])).alias("found"))

        return let(done, grown)

    def chunks(held: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(held) - 1, F.lit(0)) / CHUNK).cast("int"))
        return F.transform(numbers, lambda n: F.slice(held, n * CHUNK + 1, CHUNK))

    start = F.struct(carry.alias("carry"), F.array().cast(f"array<{kind}>").alias("found"))
    # The list is made once; so is what is read of the end.
    end = F.aggregate(let(items, chunks), start, outer)
    return let(end, lambda e: F.struct(e["carry"].alias("carry"), F.flatten(e["found"]).alias("found")))


def spans(text: Column, kind: Kind, held: Column) -> Column:
    """Confirmed matches of a kind, leftmost first and not overlapping, with code point positions.

    `held` is the text in blocks.
    """
    pieces = F.split(text, kind.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0 if kind.head is None else 1))
    none = F.array().cast(SPAN)

    def step(carry: Column, pair: Column) -> tuple[Column, Column]:
        value = pair["matches"]
        start = carry["at"] + F.length(pair["pieces"])
        taken = F.length(value) if kind.head is None else F.when(value.isNotNull(), kind.head)
        end = start + F.coalesce(taken, F.lit(0))

        def found(at: Column) -> Column:
            near = F.lower(cut(held, F.greatest(at - kind.near, F.lit(0)), at + F.length(value) + kind.near))
            score = F.lit(kind.score) + F.when(near.rlike(kind.context), kind.bonus).otherwise(0.0)
            span = F.struct(
                F.lit(kind.name).alias("kind"),
                at.alias("start"),
                (at + F.length(value)).alias("end"),
                value.alias("value"),
                score.alias("score"),
            )
            return F.when(score >= THRESHOLD, F.array(span).cast(SPAN)).otherwise(none)

        fresh = F.lit(True) if kind.head is None else start >= carry["last"]
        confirmed = F.when(value.isNotNull() & fresh & kind.valid(value), let(start, found)).otherwise(none)
        # Where the last span that was found ends.
        last = carry["last"]
        if kind.head is not None:
            last = F.when(F.size(confirmed) > 0, start + F.length(value)).otherwise(last)
        return F.struct(end.cast("bigint").alias("at"), last.cast("bigint").alias("last")), confirmed

    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("last"))
    done = walked(F.arrays_zip(pieces.alias("pieces"), matches.alias("matches")), start, SPAN, step)
    return F.when(text.rlike(kind.cue), done["found"]).otherwise(none)


def all_spans(text: Column) -> Column:
    """Spans of every kind, in the order of the kinds, then by start."""
    whole = F.coalesce(text, F.lit(""))
    any_cue = whole.rlike("|".join(f"(?:{kind.cue})" for kind in BASE + ADDED))
    found = let(blocks(whole), lambda held: F.concat(*[spans(whole, kind, held) for kind in BASE + ADDED]))
    return F.when(any_cue, found).otherwise(F.array().cast(SPAN))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, text and `pii`: the spans found, with kind, place, value and score."""
    return docs.select("doc_id", "text", all_spans(F.col("text")).alias("pii"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind, as `[EMAIL]`; n_chars follows the text.

    Overlapping spans become one tag, that of the span that starts first (the longer one at a tie).
    """
    marked = docs.select(F.struct(*docs.columns).alias("doc"), all_spans(F.col("text")).alias("pii"))
    text = F.col("doc.text")
    ordered = F.array_sort(
        F.transform("pii", lambda s: F.struct(s["start"], (-s["end"]).alias("back"), s["kind"]))
    )

    def replaced(held: Column) -> Column:
        def step(at: Column, span: Column) -> tuple[Column, Column]:
            end = -span["back"]
            parts = F.array(cut(held, at, span["start"]), F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
            fresh = span["start"] >= at
            return F.greatest(at, end).cast("bigint"), F.when(fresh, parts).otherwise(F.array().cast("array<string>"))

        done = walked(ordered, F.lit(0).cast("bigint"), "array<string>", step)

        def whole(d: Column) -> Column:
            return F.concat(F.array_join(d["found"], ""), cut(held, d["carry"], F.length(text).cast("bigint")))

        return let(done, whole)

    cleaned = let(blocks(text), replaced)
    changed = marked.select("doc", F.when(F.size("pii") > 0, cleaned).alias("cleaned"))
    columns = []
    for field in docs.schema:
        value = F.col(f"doc.`{field.name}`")
        if field.name == "text":
            value = F.coalesce("cleaned", value)
        elif field.name == "n_chars":
            value = F.coalesce(F.length("cleaned").cast(field.dataType), value)
        columns.append(value.alias(field.name))
    return changed.select(*columns)


def listed(found: Column) -> Column:
    """Spans as comma-joined kind:start:end."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and span lists per document, from the rows of `find_pii`."""
    base = [k.name for k in BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(listed(F.filter("pii", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("pii")).alias("spans"),
    )
