"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds (email, ip, card, phone) are reported whenever their own test holds; the score ranks
them. Further kinds are reported when their test holds and the score reaches ``LEAST``: ``iban``
(modulo 97) and ``local_phone`` (a number without +, only beside words that speak of telephones).

All work is built-in expressions within a row. Null texts count as empty and give no spans; other
columns and repeated rows do not matter. Spans of different kinds may overlap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimsmith.llm import spans as S
from dimsmith.llm.common import narrowed, once, unused, whole

#: Reported further kinds have at least this score.
LEAST = 0.5


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    may: str  # a cheap pattern that every text with a match contains
    base: bool
    score: float
    words: str  # context words that raise the score
    against: str = r"(?i)\b(version|order|invoice|page|isbn|serial|build)\b"

    def holds(self, value: Column) -> Column:
        """The kind's own test of a match."""
        if self.name == "ip":
            return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^([0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
        count = F.length(S.digits(value))
        if self.name == "card":
            return F.when(count.between(13, 19), S.luhn(value)).otherwise(False)
        if self.name in ("phone", "local_phone"):
            return count.between(9, 15)
        if self.name == "iban":
            size = F.length(F.regexp_replace(value, " ", ""))
            return F.when(size.between(15, 34), S.mod97(value)).otherwise(False)
        return F.lit(True)


# Guards keep matching linear: a run is entered at its start, or where the match before ended.
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True, 0.9, r"(?i)\b(e-?mail|mail|contact|write|correo|courriel|kontakt)\b"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", True, 0.6, r"(?i)\b(ip|host|server|address|client|adresse|servidor)\b"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9][ -]?[0-9]", True, 0.8, r"(?i)\b(card|credit|visa|payment|karte|carte|tarjeta)\b"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", True, 0.7, r"(?i)\b(tel|phone|call|fax|mobile|telefon|tel[eé]fono|t[eé]l[eé]phone)\b"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}", False, 0.7, r"(?i)\b(iban|bank|account|konto|cuenta|compte)\b"),
    Kind("local_phone", r"(?<![0-9+().-])(?<!\+[0-9]{1,3} )\(?[0-9]{2,5}[)/ -]{1,2}[0-9]{3,4}[ -][0-9]{3,5}(?![0-9])", r"[0-9]{2}[)/ -]", False, 0.3, r"(?i)\b(tel|phone|call|fax|mobile|telefon|tel[eé]fono|t[eé]l[eé]phone)\b"),
)
BASE = tuple(k for k in KINDS if k.base)


def score(kind: Kind, near: Column) -> Column:
    change = F.when(near.rlike(kind.words), 0.25).otherwise(0.0) - F.when(near.rlike(kind.against), 0.15).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), kind.score + change)), 2)


def found(text: Column, kind: Kind, rank: int) -> Column:
    """Spans of a kind with their scores."""
    own = S.spans(text, kind.name, rank, kind.pattern, kind.holds, F.contains(text, F.lit(kind.may)) if kind.may == "@" else text.rlike(kind.may))
    scored = F.transform(own, lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "rank", "start", "end", "value")], score(kind, s["near"]).alias("score")))
    return scored if kind.base else F.filter(scored, lambda s: s["score"] >= LEAST)


def scan(df: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """``df`` with a struct that has an array of scored spans for each kind."""
    return once(df, into, F.struct(*[found(whole(f"`{text}`"), k, rank).alias(k.name) for rank, k in enumerate(KINDS)]))


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the spans of its texts that ``scan`` reports, of all kinds, replaced by their kind in brackets; null stays null.

    Spans that overlap are replaced as one, by the first of their kinds.
    """
    others = [c for c in df.columns if c != text]
    own, into = F.col(f"`{text}`"), unused(df, "spans")
    each = F.concat(*[found(whole(f"`{text}`"), k, rank) for rank, k in enumerate(KINDS)])
    rows = once(df, into, F.array_sort(F.transform(each, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["rank"].alias("rank")))))

    names = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])
    rows = once(rows, into, merged(F.col(into)))
    rows = once(rows, text, F.when(F.size(into) > 0, replaced(own, F.col(into), names)).otherwise(own))
    return rows.select(*[F.col(f"`{c}`") for c in others], own)


def merged(found: Column) -> Column:
    """Spans (start, end, rank), sorted, with those that overlap joined into one of the least rank."""

    def joined(reach: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda i: F.get(found, i)["start"] >= F.get(reach, i))

        def one(at: Column, i: Column, k: Column) -> Column:
            own = F.slice(found, i + 1, F.coalesce(F.get(at, k + 1), F.size(found)) - i)
            end, rank = F.array_max(F.transform(own, lambda s: s["end"])), F.array_min(F.transform(own, lambda s: s["rank"]))
            return F.struct(F.get(found, i)["start"].alias("start"), end.alias("end"), rank.alias("rank"))

        return S.let(firsts, lambda at: F.transform(at, lambda i, k: one(at, i, k)))

    ends = F.transform(found, lambda s: s["end"])
    return F.when(F.size(found) > 0, S.let(S.scan(ends, F.greatest), joined)).otherwise(found)


def replaced(text: Column, found: Column, names: Column) -> Column:
    """The text with its spans (none overlap) replaced by names. Blocks of spans cut their part of the text once, and that part for each span."""
    cut = lambda t, start, end: F.substring(t, (start + 1).cast("int"), (end - start).cast("int"))

    def block(own: Column, base: Column) -> Column:
        before = lambda k: F.coalesce(F.get(own, k - 1)["end"], base) - base
        inside = lambda part: F.transform(own, lambda s, k: F.concat(cut(part, before(k), s["start"] - base), F.get(names, s["rank"])))
        return F.array_join(S.let(cut(text, base, F.element_at(own, -1)["end"]), inside), "")

    size = S.blocks(F.size(found))
    each = F.transform(
        F.sequence(F.lit(0), F.size(found) - 1, size),
        lambda s: S.let(F.coalesce(F.get(found, s - 1)["end"], F.lit(0).cast("long")), lambda base: S.let(F.slice(found, s + 1, size), lambda own: block(own, base))),
    )
    return F.concat(F.array_join(each, ""), cut(text, F.element_at(found, -1)["end"], F.length(text)))


def digests(documents: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""
    rows = scan(narrowed(documents, "doc_id", "text")).drop("text")
    base = F.concat(*[F.col(f"pii.{k.name}") for k in BASE])
    all_spans = F.concat(*[F.col(f"pii.{k.name}") for k in KINDS])
    return rows.select(
        "doc_id",
        *[F.size(f"pii.{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE],
        F.sha2(S.listed(base, "rank", "start"), 256).alias("base_sha256"),
        S.listed(all_spans, "rank", "start").alias("spans"),
        F.coalesce(F.array_max(F.transform(all_spans, lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
