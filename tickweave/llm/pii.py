"""Personal data: patterns propose, checksums confirm, nearby words adjust a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import carried, whole
from tickweave.llm.spans import Rule, bound, digest, in_chunks, propose

# A run of characters is tried once, at its start or where the last match ended,
# and never given back; so the time stays linear in a text of any shape.
LOCAL = r"[A-Za-z0-9._%+-]"
RULES = [
    Rule("email", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    Rule("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    Rule("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    Rule("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)", base=False),
    Rule("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", base=False),
]
# Score of a confirmed span without context, and the words that raise it.
SCORES = {
    "email": (0.8, "mail|contact|write"),
    "ip": (0.6, "ip|address|host|server"),
    "card": (0.8, "card|visa|credit|pay|karte|carte|tarjeta"),
    "phone": (0.7, "phone|call|tel|fax|mobile"),
    "iban": (0.8, "iban|bank|account|konto|compte|cuenta"),
    "ssn": (0.3, "ssn|social security|tax id"),
}
NEAR = 40  # code points before a span that count as its context
RAISE = 0.3
BLOCK = 2048  # code points of the blocks that a masked text is put together from
LEAST = 0.5  # what the rules beyond the base ones must reach


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (ISO 13616), blanks removed, has remainder 1."""
    turned = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))
    numbers = F.transform(
        F.split(turned, ""),
        lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55),
    )
    rest = F.aggregate(
        numbers, F.lit(0), lambda r, v: (r * F.when(v > 9, F.lit(100)).otherwise(F.lit(10)) + v) % 97
    )
    return rest == 1


def _confirmed(span: Column) -> Column:
    value, kind = span["value"], span["kind"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    account = F.replace(value, F.lit(" "), F.lit(""))
    # A part counts by its digits, leading zeros aside, as it may be of any length.
    small = F.forall(
        F.split(value, r"\."),
        lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255),
    )
    return (
        F.when(kind == "ip", small)
        .when(kind == "card", luhn(digits))
        .when(kind == "phone", F.length(digits).between(10, 15))
        .when(kind == "iban", F.length(account).between(15, 34) & mod97(account))
        .otherwise(F.lit(True))
    )


def _score(span: Column) -> Column:
    before = F.lower(span["before"])
    score = F.lit(0.0)
    for kind, (plain, words) in SCORES.items():
        raised = F.when(before.rlike(rf"(?:^|[^a-z])(?:{words})"), F.lit(min(1.0, plain + RAISE))).otherwise(F.lit(plain))
        score = F.when(span["kind"] == kind, raised).otherwise(score)
    return score


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` as ``row`` (a struct of all its columns), the whole text, and ``pii``:
    confirmed spans with start, end (code points, end exclusive), kind, value, score.

    Base kinds stay once their own check holds; the context only moves their score.
    ``iban`` and ``ssn`` need a score of 0.5 as well. Null and empty texts have no
    spans. Repeated rows and null ids are kept as they are.
    """
    rows = propose(carried(docs, whole(text).alias("text")), "text", RULES, "proposed", NEAR)
    confirmed = rows.withColumn("proposed", F.filter("proposed", _confirmed))
    scored = F.transform("proposed", lambda s: s.withField("score", _score(s)).dropFields("before"))
    n_base = sum(r.base for r in RULES)
    return confirmed.select(
        "row",
        "text",
        F.filter(scored, lambda s: (s["rank"] < n_base) | (s["score"] >= LEAST)).alias("pii"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind; overlapping spans become one.

    What stands between two spans is taken from blocks of the text, so that no step
    walks through the text from its beginning.
    """

    def step(held: Column, span: Column) -> Column:
        part = F.struct(held["at"].alias("first"), span["start"].alias("upto"), span["kind"].alias("kind"))
        parts = F.when(span["start"] >= held["at"], F.array_append(held["parts"], part)).otherwise(held["parts"])
        return F.struct(F.greatest(span["end"], held["at"]).alias("at"), parts.alias("parts"))

    none = F.array().cast("array<struct<first:int,upto:int,kind:string>>")
    parts = in_chunks(
        F.array_sort(spans),
        F.lit(0),
        lambda chunk, at: F.aggregate(chunk, F.struct(at.alias("at"), none.alias("parts")), step, lambda h: h["parts"]),
        lambda at, chunk: F.aggregate(chunk, at, lambda a, span: F.greatest(a, span["end"])),
    )

    def between(blocks: Column, first: Column, upto: Column) -> Column:
        low, high = (F.call_function("div", at, F.lit(BLOCK)).cast("int") for at in (first, upto))
        held = F.when(low == high, F.get(blocks, low)).otherwise(F.array_join(F.slice(blocks, low + 1, high - low + 1), ""))
        return F.coalesce(F.substring(held, first - low * BLOCK + 1, upto - first), F.lit(""))

    def told(blocks: Column) -> Column:
        tagged = F.transform(
            parts, lambda p: F.concat(between(blocks, p["first"], p["upto"]), F.lit("["), F.upper(p["kind"]), F.lit("]"))
        )
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(tagged, ""), between(blocks, end, F.length(text)))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, bound(blocks, told)).otherwise(text)


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` counted anew.
    A null text stays null."""
    found = find_pii(docs).withColumn("masked", masked(F.col("text"), F.col("pii")))
    kept = F.when(F.col("row.text").isNotNull(), F.col("masked"))
    new = {"text": kept, "n_chars": F.length(kept).cast("long")}
    return found.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def pii_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts and places of personal data."""
    found = find_pii(docs.select("doc_id", "text")).select("row.doc_id", "pii")
    return digest(found, "doc_id", "pii", RULES)
