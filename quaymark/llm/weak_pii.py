"""Personal data by weak supervision, with DataFrame expressions only.

Method.  Spans that fit a kind's base pattern are found, and wider candidates besides (mail
addresses spelt out, telephone numbers without a country code, card numbers that fail
their checksum, addresses of the longer internet protocol).  Labelers vote on each: the base
pattern itself, a shape check, a gazetteer (top-level domains, calling codes, card
issuers), words near it that speak for the kind, and words or characters that speak against
it; each says yes, no or nothing.  The votes are counted by kind and pattern, at most
``3^5`` for each kind, and expectation-maximisation over these counts estimates how reliable
each labeler is and how likely each pattern is personal data.  These posteriors train the
final classifier, naive Bayes over the votes and the span's length, first character and
neighbour, again from bounded counts.  A candidate is reported if the classifier gives it
at least ``THRESHOLD`` and it overlaps no base span; base spans are always reported.

Documents are read once and their spans written, so the counts, and then the decisions,
use the written spans.  Only counts of vote patterns and features reach the driver.

Defined results: a null text is empty; texts without spans give zeros, the digest of nothing and an
empty list; rows with null or repeated ids each give their row; other columns do not pass
through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from quaymark.llm.spans import as_text, clear_of, count_kind, cut, in_order, let, locate, pieces_of
from quaymark.session import materialize

KINDS = ["email", "ip", "card", "phone"]
THRESHOLD = 0.9
AROUND = 40
ROUNDS = 50

#: The base patterns, with possessive repeats and look-behinds (see spans.py).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns of the same kinds.
WIDER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[(\[]dot[)\]])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{2,5}\)|0[0-9]{2,4})[\x20./-]{1,2}[0-9]{3,4}(?:[\x20-]?[0-9]{2,4}){1,2}(?![0-9])",
}
#: Words near a span that speak for its kind, and against any.
CUES = {
    "email": ["mail", "contact", "write to", "kontakt", "correo", "courriel"],
    "ip": ["ip", "host", "server", "address", "adresse", "login"],
    "card": ["card", "visa", "credit", "debit", "karte", "carte", "tarjeta"],
    "phone": ["phone", "tel", "call", "fax", "mobil", "whatsapp"],
}
AGAINST = ["isbn", "invoice", "order no", "version", "serial", "doi", "example of"]
#: Gazetteers.
DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "co", "de", "fr", "es", "it", "nl", "uk", "eu", "ch", "at", "mx", "ar"]
CALLING_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91"]
ISSUERS = ["4", "34", "37", "51", "52", "53", "54", "55", "2", "6011", "65", "35", "36", "38"]
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
LABELERS = 5


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


VALID = {
    "email": None,
    "ip": lambda m: F.regexp_like(m, F.lit(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$")),
    "card": lambda m: F.length(digits(m)).between(12, 19) & F.call_function("luhn_check", digits(m)),
    "phone": lambda m: F.length(digits(m)).between(9, 15),
}


def _any_of(text: Column, words: list[str]) -> Column:
    return F.array_contains(F.transform(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w)), True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "1").when(no, "0").otherwise("x")


def _votes(kind: str, span: Column, pieces: Column, base: bool) -> Column:
    """One character for each labeler: 1 for yes, 0 for no, x for no vote."""
    found, number = span["found"], digits(span["found"])
    before = F.least(span["start"], F.lit(AROUND))
    near = F.lower(F.concat(cut(pieces, span["start"] - before, before), F.lit("|"), cut(pieces, span["end"], F.lit(AROUND))))
    none = F.lit(False)
    shape = {
        "email": F.regexp_like(found, F.lit(r"[A-Za-z]{2,}$")),
        "ip": F.regexp_like(found, F.lit(r"^(?!0)[0-9.]+$|:.*[0-9]")),
        "card": F.call_function("luhn_check", number) & F.length(number).between(13, 19),
        "phone": F.length(number).between(9, 13),
    }[kind]
    known = {
        "email": F.lower(F.regexp_extract(found, r"([A-Za-z]+)$", 1)).isin(DOMAINS),
        "ip": ~F.regexp_like(found, F.lit(r"^(?:0|127|255)\.")),
        "card": F.array_contains(F.transform(F.array(*[F.lit(i) for i in ISSUERS]), lambda i: F.startswith(number, i)), True),
        "phone": F.array_contains(F.transform(F.array(*[F.lit(c) for c in CALLING_CODES]), lambda c: F.startswith(number, c)), True) if base else F.startswith(found, F.lit("0")) | F.startswith(found, F.lit("(")),
    }[kind]
    joined = F.regexp_like(near, F.lit(r"[\p{L}0-9_]\||\|[\p{L}0-9_]"))
    return F.concat(
        F.lit("1" if base else "0"),
        _vote(shape, ~shape),
        _vote(known, ~known),
        _vote(_any_of(near, CUES[kind]), none),
        _vote(none, joined | _any_of(near, AGAINST)),
    )


def _features(span: Column) -> Column:
    found = span["found"]
    first = F.when(F.regexp_like(found, F.lit("^[0-9]")), "9").when(F.regexp_like(found, F.lit(r"^[A-Za-z]")), "a").otherwise("+")
    return F.concat(F.least(F.floor(F.length(found) / 4), F.lit(15)).cast("string"), F.lit("|"), first)


def find(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, wider)`` of each row: located spans with votes and features."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))

    def judged(kind: str, pattern: str, valid, base: bool) -> Column:
        def vote(s: Column, pieces: Column) -> Column:
            return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), _votes(kind, s, pieces, base).alias("votes"), _features(s).alias("features"))

        def all_of(spans: Column) -> Column:
            votes = let(pieces_of(F.col("text")), lambda pieces: F.transform(spans, lambda s: vote(s, pieces)))
            return F.when(F.size(spans) > 0, votes).otherwise(F.array())

        return let(locate(F.col("text"), kind, pattern, valid), all_of)

    base = F.concat(*[judged(k, BASE[k], VALID[k], True) for k in KINDS])
    wider = F.concat(*[judged(k, WIDER[k], None, False) for k in KINDS])
    found = rows.select("doc_id", base.alias("base"), wider.alias("wider"))
    free = clear_of(F.col("wider"), F.col("base"))
    return found.select("doc_id", "base", free.alias("wider"))


def reliabilities(counts: dict[str, float]) -> tuple[dict[str, float], list[list[float]]]:
    """The probability of each vote pattern, and of a yes and a no of each labeler on true and on false spans."""
    told = {v: n for v, n in counts.items() if n}
    prior = 0.8
    # [labeler][true or false][vote]: a yes speaks for a span and a no against it, to begin with.
    rate = [[[0.1, 0.7, 0.2], [0.7, 0.1, 0.2]] for _ in range(LABELERS)]
    at = {"0": 0, "1": 1, "x": 2}
    belief = {}
    for _ in range(ROUNDS):
        for votes in told:
            logs = [math.log(p) + sum(math.log(rate[i][side][at[c]]) for i, c in enumerate(votes)) for side, p in ((0, prior), (1, 1 - prior))]
            belief[votes] = 1 / (1 + math.exp(min(logs[1] - logs[0], 700)))
        total = sum(told.values())
        prior = (1 + sum(n * belief[v] for v, n in told.items())) / (2 + total)
        for i in range(LABELERS):
            for side in (0, 1):
                # A few imagined votes keep the sides from changing places and rates from reaching 0.
                sums = [1.0, 7.0, 2.0] if side == 0 else [7.0, 1.0, 2.0]
                for v, n in told.items():
                    sums[at[v[i]]] += n * (belief[v] if side == 0 else 1 - belief[v])
                rate[i][side] = [s / sum(sums) for s in sums]
    return belief, [[side[1] for side in sides] for sides in rate]


def train(spans: DataFrame) -> dict[str, float]:
    """Log odds of ``kind|votes`` and ``kind|features``, and of a kind by itself, from written spans."""
    each = spans.select(F.explode(F.concat("base", "wider")).alias("s")).select("s.kind", "s.votes", "s.features")
    rows = each.groupBy("kind", "votes", "features").agg(F.count("*").alias("n")).collect()
    odds: dict[str, float] = {}
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        counts: dict[str, float] = {}
        for r in own:
            counts[r["votes"]] = counts.get(r["votes"], 0) + r["n"]
        belief, _ = reliabilities(counts)
        sums: dict[str, list[float]] = {}
        total = [1.0, 1.0]
        for r in own:
            p = belief[r["votes"]]
            for side, share in enumerate((p, 1 - p)):
                total[side] += r["n"] * share
                sums.setdefault(f"{kind}|f|{r['features']}", [1.0, 1.0])[side] += r["n"] * share
        for votes, p in belief.items():
            p = min(max(p, 1e-9), 1 - 1e-9)
            odds[f"{kind}|v|{votes}"] = math.log(p / (1 - p))
        for key, (yes, no) in sums.items():
            odds[key] = math.log(yes / total[0]) - math.log(no / total[1])
    return odds


def classify(spans: DataFrame, odds: dict[str, float]) -> DataFrame:
    """``(doc_id, base, added)``: the wider candidates that the classifier accepts."""
    table = F.create_map(*[x for k, v in sorted(odds.items()) for x in (F.lit(k), F.lit(v))]) if odds else F.create_map().cast("map<string,double>")

    def weight(s: Column) -> Column:
        votes = F.concat_ws("|", s["kind"], F.lit("v"), s["votes"])
        features = F.concat_ws("|", s["kind"], F.lit("f"), s["features"])
        return F.coalesce(F.try_element_at(table, votes), F.lit(-50.0)) + F.coalesce(F.try_element_at(table, features), F.lit(0.0))

    least = math.log(THRESHOLD / (1 - THRESHOLD))
    return spans.select("doc_id", "base", F.filter("wider", lambda s: weight(s) >= least).alias("added"))


def personal_data(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, added)`` of each row of ``docs (doc_id, text)``, spans as structs."""
    spans = materialize(find(docs), "pii_spans")
    return classify(spans, train(spans))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of ``personal_data``."""
    base = in_order(F.col("base"), KINDS)
    counts = [count_kind("base", k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(in_order(F.concat("base", "added"), KINDS)).alias("spans"))
