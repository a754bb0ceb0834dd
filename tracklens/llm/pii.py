"""Personal data in texts (operator 2), with DataFrame functions only.

Regular expressions propose spans, checksums confirm them (Luhn for card
numbers, mod 97 for account numbers) and words near a span adjust its score.
Base kinds (email, ip, card, phone) are reported whenever their own rule holds;
further kinds (iban, ssn) need a score of at least ``MIN_SCORE``.

The patterns match what their plain forms match, leftmost and non-overlapping,
but possessively and only from the start of a run (or from the end of the last
match), so that long runs of word characters or digits cost linear time and no
stack.

Defined results
    null or empty text   no spans
    very long text       scanned whole
    ties                 spans of several kinds at one place are all reported,
                         ordered by start, then by kind as listed
    repeated rows        one output row per input row
    empty table          an empty result
    extra columns        kept; only one named like the added column (``spans``, or
                         the name given) is replaced
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

_LOCAL = "[A-Za-z0-9._%+-]"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    valid: object  # Column of the match -> boolean Column, or None
    score: float
    context: str  # words that raise the score when near
    needs: str = ""  # a character without which nothing can match
    base: bool = True


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """Whether the account number, its first four characters moved to the end, is 1 modulo 97."""
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    step = lambda acc, c: F.pmod(F.when(c.rlike("[0-9]"), acc * 10 + c.try_cast("int")).otherwise(acc * 100 + F.ascii(c) - 55), F.lit(97)).cast("int")
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, 0.9, "mail|email|contact|kontakt|correo|courriel", needs="@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), 0.6, "ip|host|server|address|login|from", needs="."),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?+[0-9]){13,}+", lambda m: F.length(_digits(m)).between(14, 19) & F.call_function("luhn_check", _digits(m)), 0.8, "card|visa|credit|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(10, 15), 0.6, "phone|tel|call|mobile|fax|telefon|tel.fono", needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", _mod97, 0.8, "iban|account|bank|konto|cuenta|compte", base=False),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", None, 0.35, "ssn|social|security|sozial|seguro", needs="-", base=False),
)
ORDER = {k.name: i for i, k in enumerate(KINDS)}
#: Added to a span's score when a context word stands within ``NEAR`` code points before or after it.
CONTEXT_GAIN, NEAR = 0.25, 40
MIN_SCORE = 0.5

SPAN = "struct<start:int,kind_no:int,end:int,kind:string,score:double,base:boolean>"
_BLOCK = 64


def _starts(lengths: Column) -> Column:
    """Exclusive running sums of an array, in blocks so that long arrays stay cheap."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda acc, x: acc + x)

    def inner(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / _BLOCK).cast("int")), lambda b: total(F.slice(own, b * _BLOCK + 1, _BLOCK)))
        return let(blocks, lambda sums: let(F.transform(F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, F.lit(1), b))), lambda before: F.transform(own, lambda x, i: before[F.floor(i / _BLOCK).cast("int")] + total(F.slice(own, i - i % _BLOCK + 1, i % _BLOCK)))))

    return let(lengths, inner)


def _found(text: Column, kind: Kind) -> Column:
    """The valid spans of one kind as an array of ``SPAN``."""
    pattern = F.lit(kind.pattern)
    near = rf"(?i)(?<!\p{{L}})(?:{kind.context})(?!\p{{L}})"

    def spans(both: Column) -> Column:
        matches, gaps = both["m"], both["g"]
        steps = F.transform(matches, lambda m, i: F.length(gaps[i]) + F.length(m))

        def one(m: Column, i: Column, begins: Column) -> Column:
            start = begins[i] + F.length(gaps[i])
            close = F.right(gaps[i], F.lit(NEAR)).rlike(near) | F.left(gaps[i + 1], F.lit(NEAR)).rlike(near)
            ok = kind.valid(m) if kind.valid else F.lit(True)
            score = F.lit(kind.score) + F.when(close, CONTEXT_GAIN).otherwise(0.0)
            span = F.struct(start.alias("start"), F.lit(ORDER[kind.name]).alias("kind_no"), (start + F.length(m)).alias("end"), F.lit(kind.name).alias("kind"), F.least(score, F.lit(1.0)).alias("score"), F.lit(kind.base).alias("base"))
            return F.when(ok & (F.lit(kind.base) | (score >= MIN_SCORE)), span)

        return F.filter(let(_starts(steps), lambda begins: F.transform(matches, lambda m, i: one(m, i, begins))), lambda s: s.isNotNull())

    none = F.array().cast(f"array<{SPAN}>")
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    some = let(matches, lambda m: F.when(F.size(m) > 0, let(F.struct(m.alias("m"), F.split(text, kind.pattern, -1).alias("g")), spans)).otherwise(none))
    return F.when(text.contains(kind.needs), some).otherwise(none) if kind.needs else some


def with_spans(docs: DataFrame, text_col: str = "text", out_col: str = "spans") -> DataFrame:
    """``docs`` plus an array of ``SPAN`` in code points (end exclusive), ordered by start and kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(out_col, F.array_sort(F.concat(*[_found(text, k) for k in KINDS])))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; an overlap joins the span before it."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))))
