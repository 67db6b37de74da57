"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Column expressions only. A pattern splits a text into the parts between its matches; positions are running
sums of part and match lengths, made by doubling: a dozen passes over the array of a text with thousands of matches, never a growing
array that is copied for each. Patterns are possessive and start only where a run of their characters
starts (or where the last match ended), so they stay linear on long runs and need no deep recursion.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import table, with_columns


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``needs`` is a cheap test that a text can hold the kind at all, ``base`` kinds are
    kept whenever they are confirmed; others need ``LEAST`` points. Whole words of ``context`` just before or just behind add to the score,
    also to those of the numbers that follow, or go before, in a list. No score is above 1."""

    name: str
    pattern: str
    needs: str
    score: float
    context: str
    base: bool = True


_OCTET = r"0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
#: Characters of an account number by country, after the country and two check digits.
_IBAN = {
    11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH HR LI LV",
    18: "BG BH CR DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM SO TL", 20: "AD CZ ES MD PK RO SA SE SK TN VG", 21: "LY PT ST",
    22: "IS TR", 23: "BI DJ FR GR IT MC MR SM", 24: "AL AZ BY CY DO GT HN HU LB NI PL SV", 25: "BR EG PS QA UA",
    26: "JO KW MU YE", 27: "MT SC", 28: "LC", 29: "RU",
}
_KNOWN_IBAN = "(?i:" + "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n}}}" for n, c in _IBAN.items()) + ")(?![A-Za-z0-9])"
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8,
         "e-?mails?|mail|mailto|contact|write|reach"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.5, "ips?|ipv4|hosts?|servers?|address(?:es)?"),
    # whole runs only, so a run of another length is no proposal
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", "", 0.7,
         "cards?|visa|mastercard|amex|credit|debit|pay(?:ments?)?|paid"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, "(?:tele)?phones?|tel|call(?:s|ed)?|mobile|cell|fax"),
    # as long as its country has it, in either case; else the whole run up to the next such number
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{_KNOWN_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?:(?!\x20{_KNOWN_IBAN})\x20?[A-Z0-9]){{11,30}}+(?![A-Za-z0-9]))", "", 0.9,
         "ibans?|bank|accounts?|konto", False),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssns?|social|security", False),
    # a long run of letters and digits mixed: a secret where the text calls it one, or where its form is a known one
    Kind("secret", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+", "", 0.4,
         "(?:[a-z0-9]+_)*(?:tokens?|keys?|secrets?|pass(?:word|wd|phrase)|pwd|credentials?|auth(?:orization)?)|api|bearer", False),
)
LEAST, CONTEXT_POINTS, CONTEXT_BEFORE, CONTEXT_BEHIND = 0.5, 0.2, 40, 24
#: A secret of a known form: issuer and length fixed, or with a checksum of its own.
FORM_POINTS = 0.5
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"^(?:[\s,;/|&+]++|and|or)*+$"  # what parts the numbers of a list
_SHORTEST = 5  # characters of the shortest match of any kind


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array: each pass adds to a value the total that stands so many places before it, and that
    distance doubles from pass to pass."""
    distances = F.filter(F.array(*(F.lit(1 << k) for k in range(30))), lambda d: d < F.size(values))
    return F.aggregate(distances, values, lambda totals, d: F.transform(totals, lambda x, i: F.coalesce(add(x, F.get(totals, i - d)), x)))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def mod97(hit: Column) -> Column:
    """Remainder of an account number: first four characters to the end, letters as 10 to 35."""
    plain = F.regexp_replace(hit, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    number = F.array_join(F.transform(F.split(turned, ""), lambda c: F.conv(c, 36, 10)), "")
    return F.aggregate(F.split(number, ""), F.lit(0), lambda rest, c: (rest * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)


def confirmed(kind: Kind, hit: Column) -> Column:
    if kind.name == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind.name == "card":
        return F.call_function("luhn_check", _digits(hit))
    if kind.name == "phone":
        return F.length(_digits(hit)).between(9, 15)
    if kind.name == "iban":
        return mod97(hit) == 1
    if kind.name == "secret":
        return hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(hit, ""))) >= 9)
    return F.lit(True)


def _possible(kind: Kind, text: Column) -> Column:
    return text.contains(kind.needs) if kind.needs else text.rlike("[0-9]")


def _proposals(kind: Kind, text: Column) -> tuple[Column, Column]:
    """Parts between matches, and the matches, one fewer."""
    pattern = F.lit(kind.pattern)
    return F.split(text, kind.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))


def known_form(hit: Column) -> Column:
    """Access key ids of fixed prefix and length, and tokens whose last six characters are the CRC-32 of the others in base 62."""
    number = F.aggregate(F.split(F.right(hit, F.lit(6)), ""), F.lit(0).cast("long"), lambda n, c: n * 62 + F.greatest(F.instr(F.lit(_BASE62), c) - 1, F.lit(0)))
    body = F.substring(hit, 5, 30).cast("binary")
    return hit.rlike("^(?:AKIA|ASIA)[A-Z0-9]{16}$") | (hit.rlike("^gh[pousr]_[A-Za-z0-9]{36}$") & (F.crc32(body) == number))


def _any_near(own: Column, linked: Column) -> Column:
    """For each place, whether it or an earlier one that an unbroken row of links joins it to is True."""
    none = F.lit(-1)
    last = _running(F.transform(own, lambda x, i: F.when(x, i).otherwise(none)), F.greatest)
    begin = _running(F.transform(linked, lambda x, i: F.when(x, none).otherwise(i)), F.greatest)
    return F.zip_with(last, begin, lambda a, b: (a >= 0) & (a >= b))


def _context(kind: Kind, parts: Column, hits: Column) -> Column:
    """For each match, whether words of context stand near it, or near a match of the list it is in."""
    n = F.size(hits)
    before, behind = CONTEXT_BEFORE + 1, CONTEXT_BEHIND + 1  # and a character more, to see where words begin and end
    reach = -(-before // _SHORTEST)
    tails = F.transform(parts, lambda p, i: F.concat(F.when(i == 0, " ").otherwise(""), F.right(p, F.lit(before))))
    heads = F.transform(parts, lambda p, i: F.concat(F.left(p, F.lit(behind)), F.when(i == n, " ").otherwise("")))
    # a match with the part before it, and with the part behind
    after_tail = F.zip_with(F.slice(tails, 1, n), hits, lambda p, h: F.concat(p, F.right(h, F.lit(before))))
    into_head = F.zip_with(hits, F.slice(heads, 2, n), lambda h, p: F.concat(F.left(h, F.lit(behind)), p))

    def seen_before(own: Column) -> Column:
        def one(tail: Column, i: Column) -> Column:
            earlier = F.slice(own["a"], F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)))
            window = F.right(F.concat(F.array_join(earlier, ""), tail), F.lit(before))
            return F.lower(window).rlike(rf"(?<=[^a-z0-9])(?:{kind.context})(?![a-z0-9])")

        return F.transform(F.slice(own["t"], 1, n), one)

    def seen_behind(own: Column) -> Column:
        def one(head: Column, i: Column) -> Column:
            later = F.slice(own["a"], i + 2, F.lit(reach))
            window = F.left(F.concat(head, F.array_join(later, "")), F.lit(behind))
            return F.lower(window).rlike(rf"(?<![a-z0-9])(?:{kind.context})(?=[^a-z0-9])")

        return F.transform(F.slice(own["t"], 2, n), one)

    ahead = _with(F.struct(after_tail.alias("a"), tails.alias("t")), seen_before)
    back = _with(F.struct(into_head.alias("a"), heads.alias("t")), seen_behind)
    linked = F.transform(F.slice(parts, 1, n), lambda p, i: (i > 0) & p.rlike(_BETWEEN))  # to the match before
    # to the match behind, from the last one on
    backward = F.concat(F.array(F.lit(False)), F.reverse(F.slice(linked, 2, n)))
    return F.zip_with(
        _with(F.struct(ahead.alias("own"), linked.alias("linked")), lambda x: _any_near(x["own"], x["linked"])),
        F.reverse(_with(F.struct(F.reverse(back).alias("own"), backward.alias("linked")), lambda x: _any_near(x["own"], x["linked"]))),
        lambda a, b: a | b,
    )


def _rated(kind: Kind, parts: Column, hits: Column) -> Column:
    """(good, score) of each match."""
    def rate(hit: Column, near: Column) -> Column:
        points = F.lit(kind.score) + F.when(near, CONTEXT_POINTS).otherwise(0.0)
        if kind.name == "secret":
            points = points + F.when(known_form(hit), FORM_POINTS).otherwise(0.0)
        score = F.least(points, F.lit(1.0))
        good = confirmed(kind, hit) if kind.base else confirmed(kind, hit) & (score >= LEAST)
        return F.struct(good.alias("good"), score.alias("score"))

    return F.zip_with(hits, _context(kind, parts, hits), rate)


def spans(kind: Kind, text: Column) -> Column:
    """Array of (start, end, score) in code points, end exclusive; empty for a text without any."""
    empty = F.array().cast("array<struct<s:bigint,e:bigint,score:double>>")
    parts, hits = _proposals(kind, text)

    def placed(x: Column) -> Column:
        sizes = F.zip_with(F.slice(x["parts"], 1, F.size(x["hits"])), x["hits"], lambda part, hit: (F.length(part) + F.length(hit)).cast("long"))
        ends = _with(sizes, lambda own: _running(own, lambda a, b: a + b))
        rated = F.zip_with(ends, F.zip_with(x["hits"], _rated(kind, x["parts"], x["hits"]), lambda hit, r: F.struct(F.length(hit).alias("n"), r.alias("r"))),
                           lambda end, own: F.struct(end.alias("end"), own["n"].alias("n"), own["r"].alias("r")))
        return F.transform(
            F.filter(rated, lambda y: y["r"]["good"]),
            lambda y: F.struct((y["end"] - y["n"]).alias("s"), y["end"].alias("e"), y["r"]["score"].alias("score")),
        )

    found = _with(F.struct(parts.alias("parts"), hits.alias("hits")), lambda x: F.when(F.size(x["hits"]) > 0, placed(x)).otherwise(empty))
    return F.when(_possible(kind, text), found).otherwise(empty)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a column for each kind, named as it: its spans. A null text counts as empty."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return with_columns(docs, {kind.name: spans(kind, body) for kind in KINDS})


def _masked(kind: Kind, text: Column) -> Column:
    """``text`` with each accepted span as the kind's name in brackets."""
    parts, hits = _proposals(kind, text)

    def masked(x: Column) -> Column:
        good = F.transform(x["hits"], lambda hit: confirmed(kind, hit)) if kind.base else F.transform(
            _rated(kind, x["parts"], x["hits"]), lambda r: r["good"])
        shown = F.zip_with(x["hits"], good, lambda hit, ok: F.when(ok, F.lit(f"[{kind.name.upper()}]")).otherwise(hit))
        return F.array_join(F.zip_with(x["parts"], shown, lambda part, hit: F.concat(part, F.coalesce(hit, F.lit("")))), "")

    whole = _with(F.struct(parts.alias("parts"), hits.alias("hits")), lambda x: F.when(F.size(x["hits"]) > 0, masked(x)).otherwise(text))
    return F.when(_possible(kind, text), whole).otherwise(text)


def mask(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with accepted spans masked, kind after kind. A null text stays null. Other columns stay."""
    for kind in KINDS:  # a projection each: the next kind reads the masked text once
        docs = docs.withColumn(text, _masked(kind, F.col(f"`{text}`")))
    return docs


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document: counts of the base kinds, their digest, all spans and their scores."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def listed(kind: Kind) -> Column:
        return F.transform(kind.name, lambda x: F.concat_ws(":", F.lit(kind.name), x["s"].cast("string"), x["e"].cast("string")))

    base = [kind for kind in KINDS if kind.base]
    return found.select(
        "doc_id",
        *(F.size(kind.name).cast("long").alias(f"n_{kind.name}") for kind in base),
        F.sha2(F.array_join(F.concat(*map(listed, base)), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*map(listed, KINDS)), ",").alias("spans"),
        F.array_join(F.concat(*(F.transform(k.name, lambda x: F.format_number(x["score"], 1)) for k in KINDS)), ",").alias("scores"),
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data masked, ``n_chars`` brought up to date."""
    masked = mask(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)
