"""Secrets, and parts of credentials that only count together, with DataFrame expressions only.

Method.  Base spans (assignments, access keys, long hexadecimal runs) are always reported.
Weak candidates are parts of a credential that say little alone: identifiers (user names, client
and key ids), opaque values of mixed characters, and endpoints.  A document's parts meet in
an interval join: each complementary part reaches ``SCOPE`` characters to both sides, its reach
is cut into scopes of that size, and parts of the same scope are compared.  An identifier
or an endpoint is reported if a secret is near, an opaque value if an identifier or an
endpoint is near; base spans are complements too (an access key is an identifier, the
others are secrets).

Spans are written once with a row number, so the join meets the same rows however often it
runs, and only weak parts and their neighbours are shuffled, never texts.

Defined results: a null text is empty; texts without spans give zeros, the digest of nothing and an
empty list; rows with null or repeated ids each give their row; other columns pass through
``mask_secrets`` and not ``secrets``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quaymark.llm.spans import as_text, clear_of, count_kind, in_order, locate, mask
from quaymark.session import materialize

BASE_KINDS = ["assign", "access", "hex"]
WEAK_KINDS = ["identifier", "opaque", "endpoint"]
SCOPE = 300

#: The base patterns; a key word's letters count in either case.
BASE = {
    "assign": r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}",
}
VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
#: The weak patterns.
WEAK = {
    "identifier": r"""(?i:client_?id|key_?id|user_?name|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}+""",
    "opaque": r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]{20})[A-Za-z0-9+/_=-]++",
    "endpoint": r"""(?<![A-Za-z0-9])(?i:https?|ftp|jdbc:[a-z]{2,12}|amqp|postgres|mysql)://[^\x20\x09-\x0D"'<>]++""",
}
#: What each kind of part is completed by.
COMPLEMENTS = {"identifier": ["assign", "hex", "opaque"], "opaque": ["access", "identifier", "endpoint"], "endpoint": ["assign", "hex", "opaque"]}

VALID = {
    "assign": lambda m: F.length(F.regexp_extract(m, VALUE, 1)) >= 6,
    "access": lambda m: F.length(m) >= 20,
    "hex": None,
    "identifier": None,
    "opaque": lambda m: F.regexp_like(m, F.lit("[0-9]")) & F.regexp_like(m, F.lit("[a-z]")) & F.regexp_like(m, F.lit("[A-Z]")),
    "endpoint": None,
}


def find(docs: DataFrame, kept: list[str]) -> DataFrame:
    """``(row, doc, base, weak)``, written: ``doc`` has the columns ``kept`` of a row of ``docs``.

    Weak parts that touch a base span are left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(*[locate(text, k, BASE[k], VALID[k]) for k in BASE_KINDS])
    weak = F.concat(*[locate(text, k, WEAK[k], VALID[k]) for k in WEAK_KINDS])
    rows = docs.select(F.struct(*kept).alias("doc"), base.alias("base"), weak.alias("weak"))
    free = clear_of(F.col("weak"), F.col("base"))

    def parts(spans):
        return F.transform(spans, lambda s: s.dropFields("found"))

    rows = rows.select("doc", parts("base").alias("base"), parts(free).alias("weak"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()), "secret_parts")


def link(found: DataFrame) -> DataFrame:
    """``(row, added)``: the weak parts of each row that has a complementary part near them."""
    some = found.where(F.size("weak") > 0)
    part = some.select("row", F.explode("weak").alias("w")).select("row", "w.*")
    wanted = F.create_map(*[x for k, v in COMPLEMENTS.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))])
    near = part.select("row", "kind", "start", "end", F.explode(wanted[F.col("kind")]).alias("other"), F.explode(_scopes(F.col("start"), F.col("end"))).alias("scope"))
    other = some.select("row", F.explode(F.concat("base", "weak")).alias("o")).select("row", F.col("o.kind").alias("other"), F.col("o.start").alias("low"), F.col("o.end").alias("high"))
    other = other.withColumn("scope", F.explode(_scopes(F.col("low") - SCOPE, F.col("high") + SCOPE)))
    reached = (F.col("low") - SCOPE < F.col("end")) & (F.col("start") < F.col("high") + SCOPE)
    apart = (F.col("low") >= F.col("end")) | (F.col("start") >= F.col("high"))
    linked = near.join(other, ["row", "other", "scope"]).where(reached & apart)
    spans = linked.select("row", F.struct("kind", "start", "end").alias("s")).distinct()
    return spans.groupBy("row").agg(F.collect_list("s").alias("added"))


def _scopes(low: Column, high: Column) -> Column:
    """Numbers of the scopes that an interval touches."""
    return F.sequence(F.floor(F.greatest(low, F.lit(0)) / SCOPE), F.floor(F.greatest(high - 1, F.lit(0)) / SCOPE))


def _with_links(docs: DataFrame, kept: list[str]) -> DataFrame:
    """``(doc, base, added)`` of every row."""
    found = find(docs, kept)
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    plain = found.where(F.size("weak") == 0).select("doc", "base", none.alias("added"))
    rest = found.where(F.size("weak") > 0).join(link(found), "row", "left")
    return plain.union(rest.select("doc", "base", F.coalesce("added", none).alias("added")))


def secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, added)`` of each row of ``docs (doc_id, text)``, spans as structs."""
    return _with_links(docs, ["doc_id"]).select("doc.doc_id", "base", "added")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``secrets``."""
    kinds = BASE_KINDS + WEAK_KINDS
    counts = [count_kind("base", k).alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(as_text(in_order(F.col("base"), kinds)), 256).alias("base_sha256"), as_text(in_order(F.concat("base", "added"), kinds)).alias("spans"))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``[kind]``; all rows and columns stay."""
    ordered = in_order(F.concat("base", "added"), BASE_KINDS + WEAK_KINDS)
    masked = mask(F.col("doc.text"), ordered, lambda s: F.concat(F.lit("["), s["kind"], F.lit("]")))
    own = [masked.alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return _with_links(docs, docs.columns).select(*own)
