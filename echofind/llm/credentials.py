"""Secrets in texts, with multipart credentials linked from their parts.

Strong patterns are reported alone. A weak candidate (a long random-looking string,
an assigned value) says little by itself: it is reported only where an
identifier and an endpoint lie in its scope, the interval of ``scope`` code points
around it. Built-in functions only; the interval join runs inside each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofind.llm.spans import SPAN, bound, by_start, counted, joined, masked, matches

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("private_key", "jwt", "provider", "linked_secret", "linked_id", "linked_endpoint")
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9+/_.=-]++)"
# Runs shorter than the least length can only fail, wherever inside them a match begins.
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
# From BEGIN to the END line of the same label; where that is missing, over the header and key-like lines that follow.
_GAP = r"(?:[\s>#*\"'|]|\\[rnt])"
_HEADER = rf"(?:{_GAP}*+(?:Proc-Type|DEK-Info|Version|Comment|Charset|Hash|MessageID):[^\r\n\\]*+)*+"
_LINES = rf"(?:{_GAP}++[A-Za-z0-9+/]{{16,}}+={{0,2}}+)*+(?:{_GAP}++=?[A-Za-z0-9+/]++={{0,2}}+(?=[\x20\t\"']*+(?:[\r\n]|\\[rn]|\z)))?"
PRIVATE_KEY = rf"-----BEGIN ([A-Z0-9 ]{{0,30}}PRIVATE KEY(?: BLOCK)?)-----(?:(?:[^-]++|-(?!----(?:BEGIN|END)\x20))*+-----END \1-----|{_HEADER}{_LINES})"
JWT = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"
PROVIDER = r"(?<![A-Za-z0-9_-])(?:gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|sk_live_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35})"
IDENTIFIER = r"(?i)(?<![A-Za-z0-9])(?:client_?id|access_?key_?id|(?:shared_?)?access_?key_?name|account(?:_?name)?|login|uid|user(?:_?name|[_\x20]?id)?)[\"']?\x20*+[:=]\x20*+[\"']?([A-Za-z0-9@._-]{3,}+)"
ENDPOINT = r"(?i)(?:(?:https?|ftp|jdbc:[a-z]{2,12}|postgres(?:ql)?|mysql|redis|amqp|sb)://[^\s\"'<>]{3,}+|(?<![A-Za-z0-9])(?:host(?:_?name)?|endpoint(?:_?suffix)?|server|data\x20source)[\"']?\x20*+[:=]\x20*+[\"']?[A-Za-z0-9.-]{3,}+)"
# Each lookahead passes over the other characters of the run, so a run is read once for each of them, however long it is.
WEAK_STRING = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/]*+[0-9])(?=[a-z0-9+/]*+[A-Z])(?=[A-Z0-9+/]*+[a-z])[A-Za-z0-9+/]{20,}+={0,2}+(?![A-Za-z0-9+/=_-])"
WEAK_NAME = r"(?i:password|passwd|pwd|secret|token|(?:api|access|account|secret|private|shared)_?key)|(?<![A-Za-z0-9])(?i:pass|key)|(?<=[a-z0-9])(?:Pass|Key)"
# A quoted value runs to its closing quote, any other to a space or separator.
WEAK_ASSIGN = rf"(?:{WEAK_NAME})[\"']?\x20*+[:=]\x20*+[\"']?((?<=\")[^\"\r\n]{{6,}}+(?=\")|(?<=')[^'\r\n]{{6,}}+(?=')|[^\s\"',;]{{6,}}+)"
#: What a match of the patterns has to hold: most texts are searched for none of it.
ASSIGNED = (":", "=")
HOLDING = {
    "access": ("AKIA",), "private_key": ("-----BEGIN ",), "jwt": ("eyJ",),
    "provider": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "sk_live_", "AIza"),
}


def _near(parts: Column, scope: int, span: Column) -> Column:
    return F.exists(parts, lambda p: (p["end"] > span["start"] - scope) & (p["start"] < span["end"] + scope))


def _outside(spans: Column, others: Column) -> Column:
    """The spans that no single one of ``others`` covers."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] <= s["start"]) & (o["end"] >= s["end"])))


def secret_spans(text: Column, scope: int = 400) -> Column:
    """Spans by start, then kind. Base spans stay as they are; linked parts are added beside them."""

    def candidates(p: Column) -> Column:
        strings, assigned = (F.filter(p[k], lambda s: _near(p["ids"], scope, s) & _near(p["ends"], scope, s)) for k in ("strings", "assigned"))
        # What a strong pattern reports whole is no candidate by its name again; a string inside a named value is part of it.
        return bound(_outside(assigned, p["sure"]), lambda a: F.concat(_outside(strings, a), a))

    def link(p: Column) -> Column:
        def reported(w: Column) -> Column:
            ids = F.filter(p["named"], lambda s: _near(w, scope, s))
            ends = F.filter(p["ends"], lambda s: _near(w, scope, s))
            return by_start(F.concat(p["sure"], w, ids, ends), KINDS)

        # Without a weak candidate in scope no part is reported.
        return bound(candidates(p), reported)

    def strong(kind: str, pattern: str) -> Column:
        return matches(text, kind, pattern, holding=HOLDING.get(kind, ()))

    def only(asked: Column, spans: Column) -> Column:
        """The spans, searched for only where they are asked for."""
        return F.when(asked, spans).otherwise(F.array().cast(SPAN))

    def with_endpoints(p: Column) -> Column:
        ids = F.concat(p["access"], p["named"])
        ends = only(F.size(ids) > 0, matches(text, "linked_endpoint", ENDPOINT, score=0.5, holding=ASSIGNED))
        return F.struct(F.concat(p["assign"], p["access"], p["others"]).alias("sure"), ids.alias("ids"), p["named"].alias("named"), ends.alias("ends"))

    def with_weak(p: Column) -> Column:
        # A weak candidate needs an identifier and an endpoint, and endpoints are there only beside identifiers.
        asked = F.size(p["ends"]) > 0
        strings = only(asked, matches(text, "linked_secret", WEAK_STRING, score=0.5))
        assigned = only(asked, matches(text, "linked_secret", WEAK_ASSIGN, score=0.5, group=1, holding=ASSIGNED))
        return F.struct(*[p[c].alias(c) for c in ("sure", "ids", "named", "ends")], strings.alias("strings"), assigned.alias("assigned"))

    others = [strong(k, pattern) for k, pattern in (("hex", HEX), ("private_key", PRIVATE_KEY), ("jwt", JWT), ("provider", PROVIDER))]
    parts = F.struct(
        matches(text, "assign", ASSIGN, lambda v: F.length(v) >= 12, group=2, holding=ASSIGNED).alias("assign"),
        strong("access", ACCESS).alias("access"), F.concat(*others).alias("others"),
        matches(text, "linked_id", IDENTIFIER, score=0.5, holding=ASSIGNED).alias("named"),
    )
    return bound(bound(bound(parts, with_endpoints), with_weak), link)


def find_secrets(docs: DataFrame, text: str = "text", scope: int = 400) -> DataFrame:
    """``docs`` with ``secrets``, an array of (kind, start, end, value, score).

    A null or empty text has none. Rows are taken one by one, so repeated rows repeat
    their result and an empty table stays empty. A column ``secrets`` is replaced.
    """
    return docs.withColumn("secrets", secret_spans(F.coalesce(F.col(text), F.lit("")), scope))


def digest(found: DataFrame) -> DataFrame:
    """Counts, base digest and all spans of ``find_secrets``'s rows, in the form of the registered query."""
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = {f"n_{k}": counted(F.col("secrets"), k) for k in BASE_KINDS}
    return found.withColumns(counts).withColumns({"base_sha256": F.sha2(joined(base), 256), "spans": joined(F.col("secrets"))}).drop("secrets")


def redact(docs: DataFrame, text: str = "text", scope: int = 400) -> DataFrame:
    """``docs`` with every secret in the text replaced by its kind in brackets; null texts stay null."""
    found = find_secrets(docs, text, scope)
    return found.withColumn(text, F.when(F.size("secrets") > 0, masked(F.col(text), F.col("secrets"))).otherwise(F.col(text))).drop("secrets")
