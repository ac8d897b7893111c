"""Personal data by weak supervision.

Base spans come from fixed patterns with checks (Luhn, octets, digit counts) and always stay.
Further candidates come from looser patterns: national phone numbers, social security numbers,
account numbers, titled names, street addresses, and base matches that failed their check.
Four labelers vote on every candidate (yes, no, abstain): the strict pattern, a gazetteer, the
words before it, and its shape. Expectation-maximisation estimates the labelers' reliabilities
from the table of vote patterns, without labels. Its posteriors then train the final classifier
(naive Bayes over the span's form and neighbourhood), which decides on the added spans.

Texts are read once: each document's spans and candidates are written. What is learned is read
from aggregates with a fixed number of rows (kinds x 3^labelers, kinds x feature values), so the
driver holds the same amount for any corpus. Everything is DataFrame built-ins; patterns
never backtrack over a run of characters. Matches are gathered in blocks and what stands before one is cut
from a piece of the text, so that neither the length of a text nor its matches cost more than in proportion;
only candidates against base spans of one text meet block by block.

Nulls, empties and ties: a null or empty text has no span; spans that start together are
ordered by kind; an added span never overlaps a base span or an earlier added one; repeated rows
are searched each.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import whole
from starloom.session import stage

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "ssn", "iban", "name", "address")
LABELERS = 4
ROUNDS = 50
NEAR = 48  # characters before a candidate that the context labeler reads
BLOCK, PIECE = 256, 1024  # matches and code points handled together; they change the work, not the result

# Possessive forms of the base patterns. A look-behind (or the end of the match before) keeps
# the engine from trying every place of a long run: a run that fails once fails from all places.
_EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"  # a run of fewer digits fails the count anyway
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|)"
_LOOSE = {
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\)[\x20]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}+(?:[\x20]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\.?[\x20]\p{Lu}\p{Ll}++(?:[\x20]\p{Lu}\p{Ll}++)?",
    "address": r"(?<![0-9])[0-9]{1,5}[\x20]\p{Lu}\p{Ll}++(?:[\x20]\p{Lu}\p{Ll}++)?[\x20](?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd)(?![A-Za-z])",
}
# Gazetteers and cue words.
_TLDS = "com|org|net|edu|gov|info|io|co|de|fr|es|it|uk|us|eu|ch|at|nl|be|pl|ru|cn|jp|br|in|mx|ca|au"
_NAMES = "Anna|Anne|Carlos|Claude|David|Elena|Emma|Hans|James|Jean|John|Jose|Juan|Julia|Karl|Laura|Lena|Luis|Maria|Marie|Mary|Michael|Paul|Peter|Pierre|Robert|Sarah|Sophie|Susan|Thomas"
_CUES = {
    "email": "e-?mail|mail|contact|write|courriel|correo|kontakt", "ip": r"\bip\b|server|host|address|adresse|login",
    "card": "card|visa|master|credit|karte|carte|tarjeta|paid", "phone": "phone|tel|call|fax|mobile|telefon|anruf|llam",
    "ssn": "ssn|social|security", "iban": "iban|account|bank|konto|compte|cuenta", "name": "name|signed|dear|contact|regards",
    "address": "address|live|street|home|wohn|adresse",
}
_AGAINST = r"version|isbn|order|invoice|serial|part no|ticket|build|release|\bv\.?\s*$"


def in_blocks(items: Column) -> Column:
    """The array cut into arrays of ``BLOCK``, so that no array grows element by element to its full length."""
    starts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(items, i, BLOCK))


def gather(items: Column, kept: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What an ordered pass keeps: ``step`` takes the last place and an item and returns the next place and 0 or 1 kept elements."""
    none = F.array().cast(f"array<{kept}>")

    def one(done: Column, item: Column) -> Column:
        at, more = step(done["at"], item)
        return F.struct(at.alias("at"), F.concat(done["all"], more).alias("all"))

    def block(done: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(done["at"].alias("at"), none.alias("all")), one)
        bound = F.transform(F.array(inner), lambda x: F.struct(x["at"].alias("at"), F.concat(done["all"], F.array(x["all"])).alias("all")))
        return F.get(bound, 0)

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{kept}>>").alias("all"))
    return F.aggregate(in_blocks(items), start, block, lambda d: F.flatten(d["all"]))


def matches(text: Column, pattern: str, kind: str, when: Column, base: bool = True) -> Column:
    """Array of (kind, base, s, e, m): all matches with their code-point offsets, empty unless ``when``.

    The text between matches comes from a split and the matches from an extraction; their lengths
    in turn give the offsets.
    """
    span = "struct<kind:string,base:boolean,s:int,e:int,m:string>"
    none = F.array().cast(f"array<{span}>")
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        begin = at + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        one = F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), begin.alias("s"), end.alias("e"), pair["hit"].alias("m"))
        return F.coalesce(end, begin), F.when(pair["hit"].isNull(), none).otherwise(F.array(one))

    # An array of one element binds the pairs, so that the patterns run once and not once a block.
    bound = F.get(F.transform(F.array(pairs), lambda p: gather(p, span, step)), 0)
    return F.when(when, bound).otherwise(none)


def pieces(text: Column) -> Column:
    """The text cut every ``PIECE`` code points, for :func:`cut`."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(parts: Column, start: Column, n: Column | int) -> Column:
    """``n`` code points, ``PIECE`` at most, from ``start``: only two pieces are read, however far into the text."""
    at = F.floor(start / PIECE).cast("int")
    both = F.concat(F.coalesce(F.get(parts, at), F.lit("")), F.coalesce(F.get(parts, at + 1), F.lit("")))
    return F.substring(both, start - at * PIECE + 1, F.lit(n) if isinstance(n, int) else n)


def apart(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others``; both are ordered by place, so most blocks are passed over."""
    held = F.transform(in_blocks(others), lambda b: F.struct(
        F.array_min(F.transform(b, lambda x: x["s"])).alias("s"), F.array_max(F.transform(b, lambda x: x["e"])).alias("e"), b.alias("of"),
    ))
    meets = lambda x, y: (x["s"] < y["e"]) & (y["s"] < x["e"])
    free = lambda h: F.filter(spans, lambda x: ~F.exists(h, lambda b: meets(x, b) & F.exists(b["of"], lambda y: meets(x, y))))
    return F.get(F.transform(F.array(held), free), 0)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether up to 19 digits pass Luhn's check, with every second one doubled by table."""
    full = F.lpad(digits, 20, "0")
    plain = F.translate(full, "", "")
    doubled = F.translate(full, "0123456789", "0246813579")
    total = F.lit(0)
    for i in range(20):
        source = doubled if i % 2 == 0 else plain
        total = total + F.substring(source, i + 1, 1).cast("int")
    return total % 10 == 0


def valid(span: Column) -> Column:
    """Whether a match of a base pattern passes its check; false for the looser patterns."""
    kind, m = span["kind"], span["m"]
    n = F.length(_digits(m))
    octets = m.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    return (
        F.when(~span["base"], F.lit(False)).when(kind == "email", F.lit(True)).when(kind == "ip", octets)
        .when(kind == "card", n.between(12, 19) & luhn(_digits(m))).when(kind == "phone", n.between(9, 15))
        .otherwise(F.lit(False))
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _cue(kind: Column, before: Column) -> Column:
    out = F.lit(False)
    for k, words in _CUES.items():
        out = F.when(kind == k, before.rlike(f"(?i)(?:{words})")).otherwise(out)
    return out


def described(parts: Column, span: Column) -> Column:
    """A candidate with its votes and the values of the classifier's features; ``parts`` are the text's :func:`pieces`."""
    kind, m = span["kind"], span["m"]
    digits = _digits(m)
    before = cut(parts, F.greatest(span["s"] - NEAR, F.lit(0)), F.least(span["s"], F.lit(NEAR)))
    strict = valid(span)
    base = span["base"]
    gazetteer = (
        F.when(kind == "email", _vote(m.rlike(rf"(?i)\.(?:{_TLDS})$"), F.lit(False)))
        .when(kind == "ip", _vote(~m.rlike(r"^(?:0|10|127|255|192\.168|169\.254)\."), F.lit(True)))
        .when(kind == "card", _vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), F.lit(True)))
        .when(kind == "phone", _vote(digits.rlike("^(?:1|3[0-9]|4[0-9]|5[0-9]|[2-9][0-9]{2}[2-9])"), F.lit(True)))
        .when(kind == "ssn", _vote(~m.rlike("^(?:000|666|9)|-00-|-0000$"), F.lit(True)))
        .when(kind == "iban", _vote(m.rlike("^(?:DE|FR|ES|IT|GB|NL|BE|AT|CH|PT|PL|SE|DK|FI|NO|IE)"), F.lit(True)))
        .when(kind == "name", _vote(m.rlike(rf"\b(?:{_NAMES})\b"), F.lit(False))).otherwise(F.lit(0))
    )
    cue, against = _cue(kind, before), before.rlike(f"(?i)(?:{_AGAINST})")
    plain = F.size(F.array_distinct(F.split(digits, ""))) <= 3
    shape = _vote(F.when(kind.isin("email", "name", "address"), F.length(m) <= 80).otherwise(~plain), plain)
    side = F.when(span["s"] == 0, "start").otherwise(
        F.when(before.rlike(r"[\s(<\[\"':,;]$"), "open").when(before.rlike(r"[A-Za-z0-9]$"), "word").otherwise("sign")
    )
    return F.struct(
        kind.alias("kind"), span["s"].alias("s"), span["e"].alias("e"), strict.alias("base"),
        F.concat_ws(",", _vote(strict, base), gazetteer, _vote(cue & ~against, against), shape).alias("votes"),
        F.array(
            F.concat(F.lit("length:"), F.least(F.floor(F.length(m) / 4), F.lit(10))),
            F.concat(F.lit("digits:"), F.floor(4 * F.length(digits) / F.length(m))),
            F.concat(F.lit("side:"), side), F.concat(F.lit("cue:"), cue), F.concat(F.lit("against:"), against),
            F.concat(F.lit("strict:"), strict), F.concat(F.lit("plain:"), plain),
        ).alias("features"),
    )


def candidates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``found``, the described candidates of each whole text, in order."""
    t = F.col("_text")
    digit = t.rlike("[0-9]")
    found = [
        matches(t, _EMAIL, "email", t.contains("@")), matches(t, _IP, "ip", digit & t.rlike(r"[0-9]\.[0-9]")),
        matches(t, _CARD, "card", digit & t.rlike(_CARD)), matches(t, _PHONE, "phone", t.contains("+")),
        matches(t, _LOOSE["phone"], "phone", digit & t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), False),
        matches(t, _LOOSE["ssn"], "ssn", digit & t.rlike(r"-[0-9]{2}-"), False),
        matches(t, _LOOSE["iban"], "iban", digit & t.rlike(r"[A-Z]{2}[0-9]{2}"), False),
        matches(t, _LOOSE["name"], "name", t.rlike(r"(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?)\.?[\x20]\p{Lu}"), False),
        matches(t, _LOOSE["address"], "address", digit & t.rlike(r"[0-9][\x20]\p{Lu}\p{Ll}"), False),
    ]
    rows = docs.select(F.col(doc_id), whole(text).alias("_text")).withColumn("_all", F.concat(*found))
    rows = rows.withColumn("_parts", F.when(F.size("_all") > 0, pieces(t)))
    return rows.select(doc_id, F.transform("_all", lambda span: described(F.col("_parts"), span)).alias("found"))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]]) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior that a candidate is personal data, per kind and vote pattern (with its count).

    Expectation-maximisation of a two-class model with independent labelers, per kind; the start is
    labelers that are right four times in five. Pseudo-counts keep rare kinds near the start.
    """
    posterior = {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = [(v, n) for k, v, n in patterns if k == kind]
        prior = 0.5
        rate = [{1: {1: 0.6, 0: 0.25, -1: 0.15}, 0: {1: 0.15, 0: 0.25, -1: 0.6}} for _ in range(LABELERS)]
        begin = [{y: dict(table[y]) for y in table} for table in rate]
        for _ in range(ROUNDS):
            belief = {}
            for votes, _ in rows:
                odds = math.log(prior / (1 - prior)) + sum(math.log(rate[j][1][v] / rate[j][0][v]) for j, v in enumerate(votes))
                belief[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            mass = {1: sum(n * belief[v] for v, n in rows), 0: sum(n * (1 - belief[v]) for v, n in rows)}
            prior = min(0.99, max(0.01, (mass[1] + 5) / (mass[1] + mass[0] + 10)))
            for j in range(LABELERS):
                for y in (0, 1):
                    for value in (1, 0, -1):
                        seen = sum(n * (belief[v] if y else 1 - belief[v]) for v, n in rows if v[j] == value)
                        rate[j][y][value] = (seen + 10 * begin[j][y][value]) / (mass[y] + 10)
        posterior.update({(kind, v): belief[v] for v, _ in rows})
    return posterior


def _literal_map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for item in sorted(values.items()) for x in item]) if values else F.create_map().cast("map<string,double>")


def _look_up(values: dict[str, float], key: Column, default: float) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(values), key), F.lit(default)) if values else F.lit(default)


def train(found: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Log odds per kind and per kind and feature value, from the posteriors of all candidates."""
    each = found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.features")
    counted = each.groupBy("kind", "votes").count().collect()  # kinds x 3^labelers rows at most
    belief = reliabilities([(r["kind"], tuple(map(int, r["votes"].split(","))), r["count"]) for r in counted])
    flat = {f"{k}|{','.join(map(str, v))}": p for (k, v), p in belief.items()}
    weight = _look_up(flat, F.concat_ws("|", "kind", "votes"), 0.5)
    sums = each.select("kind", weight.alias("w"), F.explode("features").alias("f")).groupBy("kind", "f").agg(
        F.sum("w").alias("yes"), F.sum(1 - F.col("w")).alias("no")
    ).collect()  # kinds x feature values rows at most
    total: dict[str, list[float]] = {}
    for r in sums:
        if r["f"].startswith("strict:"):
            both = total.setdefault(r["kind"], [0.0, 0.0])
            both[0] += r["yes"]
            both[1] += r["no"]
    start = {k: math.log((a + 1) / (b + 1)) for k, (a, b) in total.items()}
    parts = {
        f"{r['kind']}|{r['f']}": math.log((r["yes"] + 1) / (total[r["kind"]][0] + 2)) - math.log((r["no"] + 1) / (total[r["kind"]][1] + 2))
        for r in sums
    }
    return start, parts


def _joined(spans: Column) -> Column:
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["s"].alias("s"), rank[c["kind"]].alias("r"), c["e"].alias("e"), c["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id``, ``base`` and ``added`` (arrays of described spans) for every row of ``docs``."""
    found = stage(candidates(docs, text, doc_id), "pii_candidates")
    start, parts = train(found)
    base = F.filter("found", lambda c: c["base"])
    rest = found.withColumn("base", base).withColumn("rest", F.array_sort(F.transform(
        F.filter("found", lambda c: ~c["base"]),
        lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"), c["features"].alias("features")),
    )))

    def score(c: Column) -> Column:
        key = lambda f: F.concat_ws("|", c["kind"], f)
        return F.aggregate(c["features"], _look_up(start, c["kind"], 0.0), lambda s, f: s + _look_up(parts, key(f), 0.0))

    def step(at: Column, c: Column) -> tuple[Column, Column]:  # leftmost first, none overlapping the one before
        one = F.array(F.struct(c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind")))
        late = c["s"] >= at
        return F.when(late, c["e"]).otherwise(at), F.when(late, one).otherwise(F.slice(one, 1, 0))

    rest = rest.withColumn("rest", F.filter("rest", lambda c: score(c) > 0))
    ordered = F.array_sort(F.transform("base", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"))))
    rest = rest.withColumn("free", apart(F.col("rest"), ordered))
    kept = gather(F.col("free"), "struct<s:int,e:int,kind:string>", step)
    return rest.select(doc_id, "base", kept.alias("added"))


def report(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts of the base spans, the digest of their list, and the list of all spans."""
    plain = lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"))
    kinds = F.transform("base", lambda c: c["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    both = F.concat(F.transform("base", plain), "added")
    return found.select(
        doc_id, *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(both).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
