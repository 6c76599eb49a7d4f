"""Personal data: regular expressions propose, checksums confirm, context words adjust the score.

Built-in functions only: a projection without a shuffle, so a hot source or a group
of copies costs what any other rows cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofind.llm.spans import bound, counted, joined, matches

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("iban", "local_phone", "ssn")
# A local part is tried only where a run begins or the last match ended: every other start inside a run fails or
# succeeds with it. Repeated groups are possessive because nothing can follow them, so Java walks them in a loop.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
LOCAL_PHONE = r"(?<![0-9A-Za-z+().-])(?<![0-9+)]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])"
SSN = r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])"
BYTE_PARTS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
#: Words that speak for a kind when they stand shortly before a span.
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|correo|courriel)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|adresse)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|karte|tarjeta|carte)\b",
    "phone": r"(?i)\b(?:phone|tel|call|fax|mobile|telefon|téléphone|teléfono)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto|cuenta|compte)\b",
    "local_phone": r"(?i)\b(?:phone|tel|call|fax|mobile|telefon|téléphone|teléfono)\b",
    "ssn": r"(?i)\b(?:ssn|social|security)\b",
}
#: Score without and with a context word.
SCORES = {"email": (0.9, 1.0), "ip": (0.6, 0.9), "card": (0.8, 1.0), "phone": (0.7, 1.0), "iban": (0.9, 1.0), "local_phone": (0.3, 0.8), "ssn": (0.4, 0.9)}


def _digits(value: Column) -> Column:
    return F.translate(value, " -().+", "")


def _card(value: Column) -> Column:
    # The length is tested first: whatever passes is a plain string of 16 to 19 digits.
    return bound(_digits(value), lambda d: F.when(F.length(d).between(16, 19), F.call_function("luhn_check", d)).otherwise(False))


def _iban(value: Column) -> Column:
    """Remainder 1 modulo 97, the country and check digits moved to the end and letters read as 10 to 35."""

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    plain = F.translate(value, " ", "")
    return bound(F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4)), lambda v: F.aggregate(F.filter(F.split(v, ""), lambda c: c != ""), F.lit(0), step) == 1)


def _scored(kind: str):
    low, high = SCORES[kind]
    return lambda value, before: F.when(before.rlike(CONTEXT[kind]), high).otherwise(low)


VALID = {
    "ip": lambda v: v.rlike(BYTE_PARTS),
    "card": _card,
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
    "iban": _iban,
}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "local_phone": LOCAL_PHONE, "ssn": SSN}


def pii_spans(text: Column, kinds: tuple[str, ...] = BASE_KINDS + MORE_KINDS, least_score: float = 0.5) -> Column:
    """Spans by kind, then start. Base kinds are kept whatever they score, the others from ``least_score`` on."""
    found = []
    for kind in kinds:
        spans = matches(text, kind, PATTERNS[kind], VALID.get(kind), _scored(kind))
        found.append(spans if kind in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= least_score))
    return F.concat(*found)


def find_pii(docs: DataFrame, text: str = "text", least_score: float = 0.5) -> DataFrame:
    """``docs`` with ``pii``, an array of (kind, start, end, value, score).

    A null or empty text has no spans. Rows are taken one by one, so repeated rows
    repeat their result and an empty table stays empty. A column ``pii`` is replaced.
    """
    return docs.withColumn("pii", pii_spans(F.coalesce(F.col(text), F.lit("")), least_score=least_score))


def digest(found: DataFrame) -> DataFrame:
    """Counts, base digest and all spans of ``find_pii``'s rows, in the form of the registered query."""
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = {f"n_{k}": counted(F.col("pii"), k) for k in BASE_KINDS}
    return found.withColumns(counts).withColumns({"base_sha256": F.sha2(joined(base), 256), "spans": joined(F.col("pii"))}).drop("pii")
