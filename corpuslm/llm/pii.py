"""Personal data (operator 9), with DataFrame functions only.

Regular expressions propose spans, checksums (Luhn, mod 97) and number rules
confirm them, and context words near a span raise its score.  A span's score is
its kind's ``base`` plus ``confirmed`` if its check holds plus ``context`` if a
context word stands within ``NEAR`` characters; it is taken from ``ACCEPT`` on.
The four basic kinds (email, ip, card, phone) are always taken once their check
holds.

Positions are code points.  Spark gives matches without positions, so a text is
split by the same expression: the lengths of the parts between matches and of
the matches add up to the positions.  All expressions use possessive loops and
start only where a run starts, so a long run of one kind of character costs
linear time and no stack.

No rows are shuffled.  Defined results: a null text is an empty one, with no
spans.  Repeated rows each get a row.  Spans of one start are ordered by kind.
Spans of different kinds may overlap; ``redact`` merges them.  An empty table
gives no rows.  Other columns are ignored by ``report`` and carried unchanged
by ``redact``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEAR = 40
ACCEPT = 0.6
_CHUNK = 256  # matches whose positions are added up together


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """The digits of a string pass Luhn's check."""
    d = _digits(m)
    n = F.length(d)

    def term(i: Column) -> Column:  # i-th digit from the right, every second one doubled
        x = F.substring(d, n - i + 1, F.lit(1)).cast("int")
        twice = x * 2
        return F.when(i % 2 == 1, x).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), term), F.lit(0), lambda a, x: a + x)
    return (n > 0) & (total % 10 == 0)


def mod97(m: Column) -> Column:
    """The account number's check: first four characters to the end, letters
    as 10 to 35, remainder 1 modulo 97."""
    s = F.upper(F.regexp_replace(m, " ", ""))
    turned = F.concat(F.substring(s, F.lit(5), F.length(s)), F.substring(s, 1, 4))

    def step(a: Column, c: Column) -> Column:
        v = F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return (a * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _ip_parts(m: Column) -> Column:
    part = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    return F.rlike(m, F.lit(rf"^{part}(?:\.{part}){{3}}$"))


def _between(lo: int, hi: int) -> Callable[[Column], Column]:
    return lambda m: F.length(_digits(m)).between(lo, hi)


def _card(m: Column) -> Column:
    return F.when(_between(14, 19)(m), luhn(m)).otherwise(F.lit(False))


def _true(m: Column) -> Column:
    return F.lit(True)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without a match of this has no span of the kind
    check: Callable[[Column], Column]
    basic: bool
    base: float = 0.0
    confirmed: float = 0.0
    context: float = 0.0
    words: str = ""


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", _true,
         True, 0.7, 0.2, 0.1, "mail|contact|write"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", r"[0-9]\.[0-9]", _ip_parts, True,
         0.3, 0.4, 0.2, "ip|host|server|address"),
    Kind("card", r"[0-9]++(?:[\x20-][0-9]++)*+", "[0-9]", _card, True, 0.2, 0.5, 0.3, "card|visa|credit|karte|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _between(10, 15), True,
         0.4, 0.3, 0.3, "phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
         "[A-Z]{2}[0-9]{2}", mod97, False, 0.2, 0.5, 0.2, "iban|account|bank|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}",
         lambda m: ~F.rlike(m, F.lit("^(?:000|666|9)|-00-|-0000$")), False, 0.1, 0.2, 0.4, "ssn|social|security"),
    Kind("local_phone", r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9.-])",
         "[0-9]{3}[-. ][0-9]{4}", _true, False, 0.1, 0.2, 0.4, "phone|tel|call|mobile|fax"),
)
_SPAN = "struct<start:bigint,end:bigint,no:int,score:double>"
_STEP = f"struct<at:bigint,out:array<{_SPAN}>>"


def _empty() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _proposed(text: Column, no: int, k: Kind) -> Column:
    """All matches of one kind, with positions; the score is null where the
    kind's check fails or the score is too low."""
    match = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
    parts = F.split(text, k.pattern, -1)

    def item(m: Column, i: Column, rest: Column) -> Column:
        """(gap before the match, its length, score)"""
        near = F.concat(F.right(F.element_at(rest, i + 1), F.lit(NEAR)), F.lit(" "),
                        F.left(F.element_at(rest, i + 2), F.lit(NEAR)))
        ok = k.check(m)
        score = (F.lit(k.base) + F.when(ok, k.confirmed).otherwise(0.0)
                 + F.when(F.rlike(F.lower(near), F.lit(rf"\b(?:{k.words})")), k.context).otherwise(0.0))
        taken = ok if k.basic else ok & (F.round(score, 6) >= ACCEPT)
        return F.struct(F.length(F.element_at(rest, i + 1)).cast("long").alias("gap"),
                        F.length(m).cast("long").alias("n"), F.when(taken, F.round(score, 2)).alias("score"))

    def place(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["n"]).alias("end"), F.lit(no).alias("no"),
                        x["score"].alias("score"))
        out = F.when(x["score"].isNotNull(), F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct((start + x["n"]).alias("at"), out.alias("out")).cast(_STEP)

    def chunk(acc: Column, xs: Column) -> Column:
        zero = F.struct(acc["at"].alias("at"), _empty().alias("out")).cast(_STEP)
        got = F.aggregate(xs, zero, place)
        return F.struct(got["at"].alias("at"), F.concat(acc["out"], F.array(got["out"])).alias("out")).cast(
            f"struct<at:bigint,out:array<array<{_SPAN}>>>")

    def spans(items: Column) -> Column:
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _CHUNK).cast("int")),
                             lambda c: F.slice(items, c * _CHUNK + 1, F.lit(_CHUNK)))
        zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
        return F.flatten(F.aggregate(chunks, zero, chunk)["out"])

    # bound once each: the matches and parts, then the measured items
    bound = F.transform(F.array(F.struct(match.alias("m"), parts.alias("p"))),
                        lambda x: F.transform(x["m"], lambda m, i: item(m, i, x["p"])))
    found = F.flatten(F.transform(bound, lambda items: F.when(F.size(items) > 0, spans(items)).otherwise(_empty())))
    return F.when(F.rlike(text, F.lit(k.needs)), found).otherwise(_empty())


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__spans``: (start, end, no of the kind, score), by start
    and kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("*", *[_proposed(text, no, k).alias(f"__spans{no}") for no, k in enumerate(KINDS)])
    by = F.array_sort(F.transform(F.concat(*[f"__spans{no}" for no in range(len(KINDS))]), lambda s: F.struct(
        s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), s["score"].alias("score"))))
    return d.select(*docs.columns, by.alias("__spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["no"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per document row: the counts of the basic kinds, the SHA-256 of
    the basic spans, all spans, and their least score."""
    d = find(docs.select("doc_id", "text"))
    basic = [no for no, k in enumerate(KINDS) if k.basic]

    def of(no: int) -> Callable[[Column], Column]:
        return lambda s: s["no"] == no
    count = [F.size(F.filter("__spans", of(no))).cast("long").alias(f"n_{KINDS[no].name}") for no in basic]
    own = F.filter("__spans", lambda s: s["no"] <= basic[-1])
    return d.select("doc_id", *count, F.sha2(_joined(own), 256).alias("base_sha256"),
                    _joined(F.col("__spans")).alias("spans"),
                    F.array_min(F.transform("__spans", lambda s: s["score"])).alias("min_score"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets;
    overlapping spans become one, named after the first."""
    d = find(docs)
    names = F.array(*[F.lit(f"[{k.name}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        before = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(fresh, F.concat(acc["out"], before, F.element_at(names, s["no"] + 1))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate("__spans", zero, step)
    tail = lambda x: F.concat(x["out"], F.substring(F.col("text"), (x["at"] + 1).cast("int"), F.length("text")))
    new = F.when(F.size("__spans") > 0, F.element_at(F.transform(F.array(done), tail), 1)).otherwise(F.col("text"))
    return d.select(*[new.alias("text") if c == "text" else F.col(c) for c in docs.columns])
