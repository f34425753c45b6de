"""Personal data in texts: patterns propose spans, checksums confirm them, nearby words adjust the score.

All is DataFrame expressions. A pattern's matches and the pieces between them give every match's place: the sum of the
lengths before it. Only texts that can match are searched, and only their matches leave the text's row.

Patterns are written so that Java's matcher neither recurses nor tries a run of characters from each of its places:
possessive repeats, and starts only where a run begins or the last match ended.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL = r"A-Za-z0-9._%+\-"
#: Account numbers' characters by country, those of the registry.
_IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban() -> str:
    """A number of its country's length; else any of a fitting length, up to where one of a known country begins."""
    known = "|".join(
        rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(size - 4) // 4}}}"
        + (rf"\x20?[A-Z0-9]{{{size % 4}}}" if size % 4 else "") for size, countries in _IBAN_COUNTRIES.items())
    known = rf"(?:{known})(?![A-Za-z0-9])"
    other = (rf"[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20{known})\x20?[A-Z0-9]{{4}}){{2,7}}"
             r"(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
    return rf"(?<![A-Za-z0-9])(?:{known}|{other})"


@dataclass(frozen=True)
class Kind:
    """``base`` spans are always kept once confirmed; others need a score of ``NEEDED``."""

    name: str
    pattern: str
    quick: str
    score: float
    words: str
    base: bool


NEEDED = 0.5
CONTEXT_GAIN = 0.4
CONTEXT_CHARS = 48
KINDS = (
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++", "@", 0.8,
         "mail|contact|write", True),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, "ip|host|server|address", True),
    Kind("card", r"(?:\G|(?<![0-9]))[0-9](?:[\x20\-]?[0-9])++", "[0-9](?:[ -]?[0-9]){12}", 0.8,
         "card|visa|credit|karte|carte|tarjeta", True),
    Kind("phone", r"\+[0-9][\x20().0-9\-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|fax|mobile|anruf", True),
    Kind("iban", _iban(),
         "[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}", 0.8, "iban|account|konto|compte|cuenta", False),
    Kind("ssn", r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3,
         "ssn|social security|social", False),
)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda d, i: (d.cast("int") * (1 + i % 2)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account number passes the check of ISO 7064: country and check digits last, letters as 10 to 35."""
    plain = F.regexp_replace(code, " ", "")
    turned = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")
    left = F.aggregate(turned, F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return left == 1


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _confirmed(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
    return (F.when(kind == "ip", F.forall(parts, lambda p: (F.length(p) <= 3) & (F.lpad(p, 3, "0") <= "255")))
            .when(kind == "card", F.length(digits).between(13, 19) & luhn(digits))
            .when(kind == "phone", F.length(digits).between(9, 15))
            .when(kind == "iban", mod97(match))
            .when(kind == "ssn", ~F.substring(match, 1, 3).isin("000", "666") & (F.substring(match, 1, 1) != "9")
                  & (F.substring(match, 5, 2) != "00") & (F.substring(match, 8, 4) != "0000"))
            .otherwise(True))


def _proposed(text: Column, number: int, kind: Kind) -> Column:
    """The matches of one kind: their order, the length of the text between, the match and its surroundings."""
    pattern = F.lit(kind.pattern)
    quick = F.contains(text, F.lit(kind.quick)) if len(kind.quick) == 1 else text.rlike(kind.quick)
    matches, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, kind.pattern, -1)
    # Each array is made once; inside a lambda it would be made again for every element.
    before = F.transform(F.slice(between, F.lit(1), F.size(matches)), lambda p: F.struct(
        F.length(p).alias("gap"), F.right(p, F.lit(CONTEXT_CHARS)).alias("tail")))
    after = F.transform(F.slice(between, F.lit(2), F.size(matches)), lambda p: F.left(p, F.lit(CONTEXT_CHARS)))
    both = F.zip_with(F.zip_with(matches, before, lambda m, p: F.struct(m.alias("match"), p.alias("before"))), after,
                      lambda x, p: F.struct(x["match"].alias("match"), x["before"]["gap"].alias("gap"),
                                            F.concat(x["before"]["tail"], F.lit(" "), p).alias("near")))
    entry = F.transform(both, lambda x, i: F.struct(
        F.lit(number).alias("kind"), i.alias("place"), x["gap"].alias("gap"), x["match"].alias("match"),
        x["near"].alias("near")))
    none = F.array().cast("array<struct<kind: int, place: int, gap: int, match: string, near: string>>")
    return F.when(quick, entry).otherwise(none)


def spans(docs: DataFrame) -> DataFrame:
    """(row_id, kind, start, end, score, base): the confirmed spans of all texts, in characters, end exclusive.

    row_id is a hash of doc_id and text; rows that repeat both share their spans.
    """
    texts = docs.where("text <> ''").select(F.xxhash64("doc_id", "text").alias("row_id"), "text")
    found = texts.select("row_id", F.explode(F.concat(*[_proposed(F.col("text"), k, kind) for k, kind in enumerate(KINDS)])
                                             ).alias("s")).select("row_id", "s.*").distinct()
    upto = F.sum(F.col("gap") + F.length("match")).over(Window.partitionBy("row_id", "kind").orderBy("place"))
    placed = found.withColumn("end", upto).withColumn("start", F.col("end") - F.length("match"))

    def by_kind(values: list) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), F.col("kind") + 1)

    named = placed.withColumn("number", F.col("kind")).withColumn("name", by_kind([k.name for k in KINDS]))
    near = F.lower("near").rlike(r"^\s*$")
    for number, kind in enumerate(KINDS):
        near = F.when(F.col("kind") == number, F.lower("near").rlike(rf"(?<![a-z])(?:{kind.words})")).otherwise(near)
    score = F.least(F.lit(1.0), by_kind([k.score for k in KINDS]) + F.when(near, CONTEXT_GAIN).otherwise(0.0))
    scored = named.where(_confirmed(F.col("name"), F.col("match"))).select(
        "row_id", "number", F.col("name").alias("kind"), "start", "end", score.alias("score"),
        by_kind([k.base for k in KINDS]).alias("base"))
    return scored.where(F.col("base") | (F.col("score") >= NEEDED))


def _joined(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, n_iban, n_ssn, base_sha256, spans,
    scores.

    Spans are ordered by kind as listed, then start; scores follow the spans. A text that is NULL or empty has none: its
    counts are 0, its spans an empty string. Repeated rows are reported each; ids may be NULL. Other columns are not used.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = F.struct("number", "start", "end", "kind", "score", "base")
    gathered = spans(rows).groupBy("row_id").agg(F.array_sort(F.collect_list(order)).alias("all"))
    result = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row_id")).join(gathered, "row_id", "left")
    every = F.coalesce("all", F.array().cast(gathered.schema["all"].dataType))
    result = result.select("doc_id", every.alias("all"))

    def count(name: str) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    counts = [count(kind.name) for kind in KINDS]
    return result.select(
        "doc_id", *counts, F.sha2(_joined(F.filter("all", lambda s: s["base"])), 256).alias("base_sha256"),
        _joined(F.col("all")).alias("spans"), F.transform("all", lambda s: s["score"]).alias("scores"))
