"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Everything is column expressions, without a shuffle. The costly walk over a
text runs only where a cheap pattern shows that a kind can occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolag.llm.common import match_spans, spans_text

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban"]
# What each kind scores by itself, and what a context word near it adds.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT_GAIN = 0.1
WINDOW = 40  # characters looked at before a span
CONTEXT = {
    "email": r"(?i)mail|contact|write|schreib|correo|courriel",
    "ip": r"(?i)\bip\b|address|host|server|login",
    "card": r"(?i)card|visa|master|credit|karte|carte|tarjeta|payment",
    "phone": r"(?i)phone|call|tel|mobile|fax|anruf",
    "iban": r"(?i)iban|bank|account|konto|compte|cuenta",
}
SPAN = "struct<start:int,end:int,kind:string,hit:string,part:string,before:string>"
# Repeated groups are possessive: a run is taken whole and never given back, so
# its length needs no stack, and a failed run is not tried again from its middle.
# An address starts at the first of its characters, or where the last match ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
# Runs of fewer than 14 digits never pass; a run is always taken whole.
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the Luhn sum (false without digits)."""
    digits = F.split(F.reverse(_digits(text)), "")
    # Two digits at a time: the right one counts once, the left one doubled.
    def step(s: Column, d: Column) -> Column:
        n = F.coalesce(F.try_to_number(d, F.lit("9")).cast("int"), F.lit(0))
        twice = F.when(n > 4, n * 2 - 9).otherwise(n * 2)
        return F.struct((s["sum"] + F.when(s["odd"], twice).otherwise(n)).alias("sum"), (~s["odd"]).alias("odd"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(False).alias("odd"))
    return F.aggregate(digits, start, step, lambda s: (s["sum"] % 10 == 0)) & (F.length(_digits(text)) > 0)


def mod97(text: Column) -> Column:
    """Whether an account number passes the mod-97 check: the rest must be 1."""
    plain = F.regexp_replace(text, r"\x20", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(c == "", rest).when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _kind(text: Column, hint: str, pattern: str, kind: str, holds=None) -> Column:
    found = match_spans(text, pattern, kind, window=WINDOW)
    if holds is not None:
        found = F.filter(found, lambda s: holds(s["hit"]))
    return F.when(text.rlike(hint), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def spans(text: Column) -> Column:
    """All confirmed spans of a text that is not null, kind by kind."""
    return F.concat(
        _kind(text, "@", EMAIL, "email"),
        _kind(text, r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", IP, "ip", lambda h: h.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
        _kind(text, r"[0-9](?:[\x20-]?[0-9]){13}", CARD, "card",
              lambda h: F.length(_digits(h)).between(14, 19) & luhn(h)),
        _kind(text, r"\+[0-9]", PHONE, "phone", lambda h: F.length(_digits(h)).between(10, 15)),
        _kind(text, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[\x20A-Z0-9]{9}", IBAN, "iban",
              lambda h: F.length(F.regexp_replace(h, r"\x20", "")).between(15, 34) & mod97(h)),
    )


def score(span: Column) -> Column:
    """How sure a span is personal data, 0 to 1: its kind's prior, more with a context word before it."""
    before = span["before"]
    prior, near = F.lit(0.0), F.lit(False)
    for kind in KINDS:
        prior = F.when(span["kind"] == kind, F.lit(PRIOR[kind])).otherwise(prior)
        near = near | ((span["kind"] == kind) & before.rlike(CONTEXT[kind]))
    return F.round(prior + F.when(near, F.lit(CONTEXT_GAIN)).otherwise(F.lit(0.0)), 3)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, found) of every row: array of (start, end, kind, hit, score), empty where nothing is found.

    Null text counts as empty. Repeated rows are kept; every row is judged alone.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("spans", spans(F.col("text")))
    scored = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["hit"].alias("hit"),
        score(s).alias("score")))
    return rows.select("id", scored.alias("found"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and joined spans of the base kinds, all spans, and the highest score."""
    def of(kinds: list[str]) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(kinds))

    return found.select(
        F.col("id").alias(id_col),
        *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(spans_text(of(BASE), KINDS), 256).alias("base_sha256"),
        spans_text(F.col("found"), KINDS).alias("spans"),
        F.array_max(F.transform("found", lambda s: s["score"])).alias("top_score"),
    )
