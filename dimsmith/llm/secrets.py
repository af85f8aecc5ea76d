"""Secrets, and credentials whose parts are linked by an interval join.

Strong spans stand alone: ``assign`` (a named value), ``access`` (an access identifier), ``hex``
(a long hexadecimal run). Weak parts say little alone: ``token`` (a long mixed run of letters and
digits), ``user`` (a named account), ``endpoint`` (an address of a service). The parts of a text
are joined on scopes, the ``REACH`` code points around each part: a token is reported if an
identifier (access or user) lies in its scope, a user if a secret (assign, hex or token) does, an
endpoint if both do. Parts of a kind do not overlap and have a least length, so a scope holds a
bounded number of them and the join grows with the text, whatever the text repeats.

Only built-in expressions and joins are used. Null texts count as empty. Parts are joined once for
each distinct text, so copies and repeated rows cost nothing more and each row gets its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimsmith.llm import spans as S
from dimsmith.llm.common import narrowed, once, whole

REACH = 300
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
VALUE = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""
BASE = ("assign", "access", "hex")
WEAK = ("token", "user", "endpoint")
PATTERNS = {
    "access": r"AKIA[A-Z0-9]{16,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}+",
    "token": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{32})[A-Za-z0-9+/_-]++={0,2}",
    "user": r"""(?i:(?<![a-z])(?:user|username|user_name|login|account))["']?\x20{0,8}[:=]\x20{0,8}["']?[A-Za-z0-9._@-]{3,}+""",
    "endpoint": r"""(?<![A-Za-z0-9+.-])(?i:https?|s3|ftp|jdbc:[a-z]{1,20}|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{4,}+""",
}
MAY = {
    "assign": r"(?i)(password|passwd|secret|token|api_?key)",
    "access": "AKIA",
    "hex": r"[0-9a-f]{24}",
    "token": r"[A-Za-z0-9+/_-]{32}",
    "user": r"(?i)(user|login|account)",
    "endpoint": "://",
}


def parts(text, kind: str):
    """Spans of one kind of part."""
    holds = {
        "assign": lambda v: F.length(F.regexp_replace(v, VALUE, "")) >= 6,
        "token": lambda v: v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]"),
    }.get(kind)
    may = F.contains(text, F.lit(MAY[kind])) if kind in ("access", "endpoint") else text.rlike(MAY[kind])
    rank = (BASE + WEAK).index(kind)
    found = S.spans(text, kind, rank, ASSIGN if kind == "assign" else PATTERNS[kind], holds, may)
    return F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["rank"].alias("rank"), s["start"].alias("start"), s["end"].alias("end")))


def scan(df: DataFrame, text: str = "text", into: str = "found") -> DataFrame:
    """``df`` with a struct: ``strong`` and ``weak`` spans of its texts; weak ones inside strong ones are left out."""
    column = whole(f"`{text}`")
    strong = F.concat(*[parts(column, k) for k in BASE])
    weak = F.concat(*[parts(column, k) for k in WEAK])
    rows = once(df, into, F.struct(strong.alias("strong"), weak.alias("weak")))
    free = F.filter(f"{into}.weak", lambda w: ~F.exists(f"{into}.strong", lambda s: (s["start"] < w["end"]) & (w["start"] < s["end"])))
    return once(rows, into, F.struct(F.col(f"{into}.strong").alias("strong"), free.alias("weak")))


def linked(rows: DataFrame, key: str, found: str = "found", reach: int = REACH) -> DataFrame:
    """The interval join: (key, linked) with the weak spans of each key that have their complement in scope.

    ``key`` must name the text: rows of one key have the same spans, and one of them is joined.
    """
    distinct = rows.where(F.size(f"{found}.weak") > 0).select(key, found).dropDuplicates([key])
    each = distinct.select(key, F.explode(F.concat(f"{found}.strong", f"{found}.weak")).alias("p")).select(key, "p.*")
    # intervals meet exactly if they share a block of the text: scopes on one side, parts on the other
    blocks = lambda start, end: F.explode(F.sequence(F.floor(start / reach), F.floor((end - 1) / reach)))
    start, end = F.col("start"), F.col("end")
    weak = each.where(F.col("kind").isin(*WEAK)).withColumn("block", blocks(start - reach, end + reach))
    other = each.where(F.col("kind") != "endpoint").select(F.col(key).alias("other_key"), F.col("kind").alias("with"), start.alias("from"), end.alias("to"), blocks(start, end).alias("its_block"))
    near = weak.join(other, (F.col(key) == F.col("other_key")) & (F.col("block") == F.col("its_block")) & (F.col("from") < end + reach) & (F.col("to") > start - reach))
    identifier = F.max(F.col("with").isin("access", "user"))
    secret = F.max(F.col("with").isin("assign", "hex", "token"))
    told = near.groupBy(key, "kind", "rank", "start", "end").agg(identifier.alias("identifier"), secret.alias("secret"))
    held = F.when(F.col("kind") == "token", F.col("identifier")).when(F.col("kind") == "user", F.col("secret")).otherwise(F.col("identifier") & F.col("secret"))
    return told.where(held).groupBy(key).agg(F.collect_list(F.struct("kind", "rank", "start", "end")).alias("linked"))


def credentials(documents: DataFrame, settle) -> DataFrame:
    """Strong and linked spans of each document. ``settle`` writes the spans found (not the texts) once."""
    rows = settle(scan(narrowed(documents, "doc_id", "text")).select("doc_id", "found", F.when(F.size("found.weak") > 0, F.sha2(F.col("text"), 256)).alias("text_key")))
    none = F.array().cast("array<struct<kind:string,rank:int,start:long,end:long>>")
    joined = rows.where(F.col("text_key").isNotNull()).join(linked(rows, "text_key").withColumnRenamed("text_key", "its"), F.col("text_key") == F.col("its"), "left")
    plain = rows.where(F.col("text_key").isNull()).select("doc_id", "found", none.alias("linked"))
    return joined.select("doc_id", "found", F.coalesce("linked", none).alias("linked")).unionByName(plain)


def digests(documents: DataFrame, settle) -> DataFrame:
    rows = credentials(documents, settle)
    count = lambda kind: F.size(F.filter("found.strong", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(S.listed(F.col("found.strong"), "start", "rank"), 256).alias("base_sha256"),
        S.listed(F.concat("found.strong", "linked"), "start", "rank").alias("spans"),
        F.size("linked").cast("long").alias("n_linked"),
    )
