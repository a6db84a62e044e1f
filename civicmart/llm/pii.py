"""Personal data by weak supervision, with column expressions only.

Candidates are the contract's spans and wider forms of each kind. Labelers (pattern, shape, gazetteer,
context, counter-context) vote on every candidate. Expectation-maximisation over the counts of vote
patterns estimates each labeler's reliability per kind, and a logistic span classifier is trained on the
resulting probabilities. Base spans always stay; wider ones are added if the classifier accepts them.
Vote patterns are a bounded table (kinds x 2^labelers), counted over all candidates.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicmart.llm import spans as S
from civicmart.session import cut

KINDS = ["email", "ip", "card", "phone"]
ROUNDS, STEPS = 50, 400
ACCEPT = 0.5
CONTEXT = 40

# The base patterns, possessive and anchored where the plain form would scan a long run again and again; same matches.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}|\.[A-Za-z0-9-]{1,63}){1,4}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,14}+(?![\x20-]?[0-9])",
    "phone": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: What a text must hold for a pattern to be tried.
HOLDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
HOLDS_WIDER = {"email": r"(?i)[\[({]\x20?at\x20?[\])}]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"[0-9]{3}[\x20.-][0-9]{4}"}

# fixed values: top-level domains, issuer prefixes, reserved first octets, calling codes
DOMAINS = "com org net edu gov info io co de fr es it uk us eu ch at nl pl ru cn jp in br au ca mx".split()
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|65|35)"
RESERVED = [0, 10, 127, *range(224, 256)]
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": r"mail|contact|write|reach|send", "ip": r"\bip\b|host|server|address|client|from", "card": r"card|visa|master|amex|credit|debit|pay",
    "phone": r"phone|tel|call|mobile|cell|fax|dial",
}
COUNTER = r"version|release|build|isbn|order|invoice|serial|part no|section|chapter"
LABELERS = ["pattern", "shape", "gazetteer", "context", "no_counter"]


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _octets(s: Column) -> Column:
    return F.transform(F.split(s, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))


def is_base(kind: str, s: Column) -> Column:
    """Whether a match of the base pattern passes its kind's test."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(_octets(s), lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    n = F.length(_digits(s))
    if kind == "phone":
        return n.between(8, 15)
    return F.when(n.between(16, 19), S.luhn(_digits(s))).otherwise(False)


def votes(kind: str, base: Column, s: Column, context: Column) -> list[Column]:
    """One vote per labeler on a candidate."""
    n = F.length(_digits(s))
    plain = F.lower(F.regexp_replace(F.regexp_replace(s, r"(?i)\x20?[\[({]\x20?dot\x20?[\])}]\x20?", "."), r"(?i)\x20?[\[({]\x20?at\x20?[\])}]\x20?", "@"))
    first = F.coalesce(F.element_at(_octets(s), 1), F.lit(""))
    shape = {
        "email": plain.rlike(r"^[a-z0-9_%+-][a-z0-9._%+-]*@(?:[a-z0-9-]+\.)+[a-z]{2,}$") & ~F.contains(plain, F.lit("..")),
        "ip": F.when(F.contains(s, F.lit(":")), ~s.rlike("^(?:0+:){7}")).otherwise(~s.rlike(r"(?:^|\.)0[0-9]")),
        "card": F.when(n.between(13, 19), S.luhn(_digits(s))).otherwise(False), "phone": n.between(10, 13),
    }[kind]
    known = {
        "email": F.substring_index(plain, ".", -1).isin(DOMAINS),
        "ip": F.contains(s, F.lit(":")) | (first.rlike("^[0-9]{1,3}$") & ~first.isin([str(r) for r in RESERVED])),
        "card": _digits(s).rlike(ISSUERS), "phone": s.rlike(CALLING) | s.rlike(r"^\(?[2-9]"),
    }[kind]
    return [base, shape, known, context.rlike(CUES[kind]), ~context.rlike(COUNTER)]


def candidates(rows: DataFrame) -> DataFrame:
    """`doc_id` and `found`: all candidates of a text with kind, place, whether base, and votes, in order."""
    text = F.col("text")
    patterns = {f"b_{k}": (text.rlike(HOLDS[k]), BASE[k]) for k in KINDS} | {f"w_{k}": (text.rlike(HOLDS_WIDER[k]), WIDER[k]) for k in KINDS}
    placed = S.with_matches(rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), patterns)

    def made(k: int, base: bool) -> Column:
        kind = KINDS[k]
        own = F.filter(F.col(f"{'b' if base else 'w'}_{kind}"), lambda m: is_base(kind, m["text"])) if base else F.col(f"w_{kind}")
        return F.transform(own, lambda m: F.struct(
            F.lit(k).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(base).alias("base"),
            *[v.alias(name) for name, v in zip(LABELERS, votes(kind, F.lit(base), m["text"], S.before(text, m["start"], CONTEXT)), strict=True)],
        ))

    based = placed.select("doc_id", F.concat(*[made(k, True) for k in range(4)]).alias("base"), F.concat(*[made(k, False) for k in range(4)]).alias("wider"))
    free = F.filter("wider", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return based.select("doc_id", F.array_sort(F.concat("base", free)).alias("found"))


def reliabilities(patterns: dict[tuple, int], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Probability that a candidate is personal data, per vote pattern, by expectation-maximisation per kind.

    Two classes, labelers independent given the class; starts from the share of votes.
    """
    out: dict[tuple, float] = {}
    for kind in {p[0] for p in patterns}:
        rows = [(p[1:], n) for p, n in patterns.items() if p[0] == kind]
        post = {v: (sum(v) + 0.5) / (len(v) + 1) for v, _ in rows}
        for _ in range(rounds):
            yes = sum(post[v] * n for v, n in rows) + 1
            no = sum((1 - post[v]) * n for v, n in rows) + 1
            # one candidate's worth of prior belief that labelers are right four times in five
            right = [(sum(post[v] * n for v, n in rows if v[j]) + 0.8 * 2) / (yes + 1) for j in range(len(LABELERS))]
            wrong = [(sum((1 - post[v]) * n for v, n in rows if v[j]) + 0.2 * 2) / (no + 1) for j in range(len(LABELERS))]
            clip = lambda x: min(max(x, 0.01), 0.99)
            for v, _n in rows:
                odds = math.log(yes / no) + sum(
                    math.log(clip(r) / clip(w)) if x else math.log((1 - clip(r)) / (1 - clip(w))) for x, r, w in zip(v, right, wrong, strict=True)
                )
                post[v] = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
        out |= {(kind, *v): post[v] for v, _ in rows}
    return out


def train_classifier(patterns: dict[tuple, int], truth: dict[tuple, float], steps: int = STEPS) -> dict[int, list[float]]:
    """Per kind a constant and a weight per vote, fitted to the probabilities by gradient descent on the logistic loss.

    Kinds without candidates take the plain majority of the votes.
    """
    majority = [-len(LABELERS) + 0.5, *[2.0] * len(LABELERS)]
    out = {}
    for kind in range(len(KINDS)):
        rows = [(p[1:], n, truth[p]) for p, n in patterns.items() if p[0] == kind]
        w = list(majority)
        total = sum(n for _, n, _ in rows)
        for _ in range(steps if total else 0):
            grad = [0.01 * (a - b) for a, b in zip(w, majority, strict=True)]  # unseen votes keep the majority's weight
            for v, n, y in rows:
                z = w[0] + sum(a for a, x in zip(w[1:], v, strict=True) if x)
                d = (1 / (1 + math.exp(-min(max(z, -30), 30))) - y) * n / total
                grad[0] += d
                for j, x in enumerate(v):
                    if x:
                        grad[1 + j] += d
            w = [a - 0.5 * g for a, g in zip(w, grad, strict=True)]
        out[kind] = w
    return out


def accepted(c: Column, weights: dict[int, list[float]]) -> Column:
    """Whether the span classifier accepts a candidate."""
    def odds(w: list[float]) -> Column:
        return reduce(lambda a, b: a + b, [F.when(c[name], x).otherwise(0.0) for name, x in zip(LABELERS, w[1:], strict=True)], F.lit(w[0]))

    z = reduce(lambda acc, k: acc.when(c["kind"] == k, odds(weights[k])), range(1, len(KINDS)), F.when(c["kind"] == 0, odds(weights[0])))
    return z >= math.log(ACCEPT / (1 - ACCEPT))


def _joined(found: Column) -> Column:
    name = lambda c: F.element_at(F.array(*[F.lit(k) for k in KINDS]), c["kind"] + 1)
    return F.array_join(F.transform(found, lambda c: F.concat(name(c), F.lit(":"), c["start"].cast("string"), F.lit(":"), c["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all), n_added, one row per row of `docs`.

    Null and empty texts hold nothing; rows that repeat are judged each for itself; other columns are
    not looked at; an empty table gives an empty one. Candidates (places and votes, no texts) are written
    once to the shared work folder.
    """
    found = cut(candidates(docs.select("doc_id", "text")), "pii-candidates")
    votes_of = found.select(F.explode("found").alias("c")).groupBy("c.kind", *[F.col(f"c.{n}").alias(n) for n in LABELERS]).count()
    patterns = {(r[0], *map(bool, r[1:-1])): r[-1] for r in votes_of.collect()}  # at most 4 * 2^5 rows
    weights = train_classifier(patterns, reliabilities(patterns))
    of_kind = lambda k: F.filter("base", lambda c: c["kind"] == k)
    base = found.select("doc_id", "found", F.filter("found", lambda c: c["base"]).alias("base"))
    kept = F.filter("found", lambda c: c["base"] | accepted(c, weights))
    return base.select(
        "doc_id",
        *[F.size(of_kind(k)).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(kept).alias("spans"),
        (F.size(kept) - F.size("base")).cast("bigint").alias("n_added"),
    )
