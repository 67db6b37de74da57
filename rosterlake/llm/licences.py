"""Licence recognition by sentences and rules.

Sentences of a text are normalised, and what they hold of known licence sentences is looked up in a map from phrase to
identifier; the sequence of identifiers is then matched against ordered licence rules, each taking what it matches. Notices may be
wrapped and stand in comments. Column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm.common import table


def _versions(name: str, *versions: str) -> tuple[str, ...]:
    """How a licence with a number is named in a sentence."""
    return tuple(f"{name} {lead}{v}" for v in versions for lead in ("version ", "v ", "v", ""))


def _published(name: str, version: str) -> tuple[str, ...]:
    by = f"{name} as published by the free software foundation"
    return tuple(f"{by} {lead}version {version}" for lead in ("either ", ""))


_GPL, _LGPL, _AGPL = "gnu general public license", "gnu lesser general public license", "gnu affero general public license"

#: Known licence sentences, or what marks one: identifier, and normalised phrases (lower case, single spaces, letters and
#: digits only, "license" with an s). Of phrases that begin at the same place the longest counts.
SENTENCES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (*_versions("apache license", "2 0", "2"), *_versions("apache software license", "2 0"), "apache 2 0 license"),
    "apache-use": tuple(f"you may not use this {x} except in compliance with the license" for x in ("file", "work", "software")),
    "apache-copy": ("you may obtain a copy of the license at",),
    "apache-as-is": ("software distributed under the license is distributed on an as is basis",),
    "mit": ("mit license", "expat license"),
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software",),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies",),
    "as-is": ("the software is provided as is", "this software is provided as is",
              *(f"this software is provided by the {x} as is" for x in ("copyright holders and contributors", "regents and contributors", "author", "authors"))),
    "bsd-redistribute": ("redistribution and use in source and binary forms with or without modification are permitted",),
    "bsd-source": ("redistributions of source code must retain the above copyright notice",),
    "bsd-binary": ("redistributions in binary form must reproduce the above copyright notice",),
    "bsd-endorse": ("may be used to endorse or promote products derived from this software",),
    "bsd-3": ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause"),
    "bsd-2": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause"),
    "bsd": ("bsd license", "bsd style license"),
    "isc": ("isc license",),
    "isc-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "gpl-3": (*_versions(_GPL, "3 0", "3"), *_versions("gnu gpl", "3 0", "3"), *_published(_GPL, "3")),
    "gpl-2": (*_versions(_GPL, "2 0", "2"), *_versions("gnu gpl", "2 0", "2"), *_published(_GPL, "2")),
    "gpl-any": (_GPL, "gnu gpl"),
    "lgpl-3": (*_versions(_LGPL, "3 0", "3"), *_published(_LGPL, "3")),
    "lgpl-2.1": (*_versions(_LGPL, "2 1"), *_published(_LGPL, "2 1")),
    "lgpl": (_LGPL, "gnu library general public license"),
    "agpl-3": (*_versions(_AGPL, "3 0", "3"), *_published(_AGPL, "3"), _AGPL),
    "or-later": ("or at your option any later version", "or any later version"),
    "mpl-2.0": _versions("mozilla public license", "2 0"),
    "epl-2.0": _versions("eclipse public license", "2 0"),
    "cc-by-nc-sa-4.0": ("cc by nc sa 4 0", "creative commons attribution noncommercial sharealike 4 0"),
    "cc-by-nc-4.0": ("cc by nc 4 0", "creative commons attribution noncommercial 4 0"),
    "cc-by-sa-4.0": ("cc by sa 4 0", "creative commons attribution sharealike 4 0"),
    "cc-by-4.0": ("cc by 4 0", "creative commons attribution 4 0"),
    "cc0": ("cc0 1 0", "dedicated to the public domain"),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "all-rights": ("all rights reserved",),
    "copyright": tuple(f"copyright {c}{century}" for c in ("", "c ") for century in ("19", "20")),  # and the rest of a year
}

#: Short names of SPDX, normalised, and the licence: read after "SPDX-License-Identifier", and where two are joined by OR, AND or WITH.
SPDX: dict[str, str] = {
    "apache 2 0": "Apache-2.0", "mit": "MIT", "bsd 3 clause": "BSD-3-Clause", "bsd 2 clause": "BSD-2-Clause", "isc": "ISC",
    "gpl 3 0 or later": "GPL-3.0-or-later", "gpl 3 0 only": "GPL-3.0", "gpl 3 0": "GPL-3.0",
    "gpl 2 0 or later": "GPL-2.0-or-later", "gpl 2 0 only": "GPL-2.0", "gpl 2 0": "GPL-2.0",
    "lgpl 3 0 or later": "LGPL-3.0", "lgpl 3 0 only": "LGPL-3.0", "lgpl 3 0": "LGPL-3.0",
    "lgpl 2 1 or later": "LGPL-2.1", "lgpl 2 1 only": "LGPL-2.1", "lgpl 2 1": "LGPL-2.1",
    "agpl 3 0 or later": "AGPL-3.0", "agpl 3 0 only": "AGPL-3.0", "agpl 3 0": "AGPL-3.0",
    "mpl 2 0": "MPL-2.0", "epl 2 0": "EPL-2.0", "cc0 1 0": "CC0-1.0", "cc by 4 0": "CC-BY-4.0", "cc by sa 4 0": "CC-BY-SA-4.0",
    "cc by nc 4 0": "CC-BY-NC-4.0", "unlicense": "Unlicense",
}

#: Rules in order: the licence, the identifiers it needs one after the other ("?" behind one that may be missing), and
#: how many unknown sentences may stand between two of them.
RULES: tuple[tuple[str, tuple[str, ...], int], ...] = (
    ("Apache-2.0", ("apache-2.0?", "copyright?", "all-rights?", "apache-2.0", "apache-use", "apache-copy?", "apache-as-is?"), 3),
    ("Apache-2.0", ("apache-use", "apache-copy", "apache-as-is?"), 3),
    ("BSD-3-Clause", ("bsd-3?", "copyright?", "all-rights?", "bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse", "as-is?"), 3),
    ("BSD-2-Clause", ("bsd-2?", "copyright?", "all-rights?", "bsd-redistribute", "bsd-source", "bsd-binary", "as-is?"), 3),
    ("MIT", ("mit?", "copyright?", "all-rights?", "mit-grant", "mit-notice?", "as-is?"), 3),
    ("ISC", ("isc?", "copyright?", "all-rights?", "isc-grant", "as-is?"), 3),
    ("Apache-2.0", ("apache-2.0",), 0),
    ("BSD-3-Clause", ("bsd-3",), 0),
    ("BSD-2-Clause", ("bsd-2",), 0),
    ("BSD", ("copyright?", "all-rights?", "bsd-redistribute", "as-is?"), 3),
    ("BSD", ("bsd",), 0),
    ("MIT", ("mit",), 0),
    ("ISC", ("isc",), 0),
    ("GPL-3.0-or-later", ("gpl-3", "or-later"), 0),
    ("GPL-3.0", ("gpl-3",), 0),
    ("GPL-2.0-or-later", ("gpl-2", "or-later"), 0),
    ("GPL-2.0", ("gpl-2",), 0),
    ("LGPL-3.0", ("lgpl-3", "or-later?"), 0),
    ("LGPL-2.1", ("lgpl-2.1", "or-later?"), 0),
    ("AGPL-3.0", ("agpl-3", "or-later?"), 0),
    ("GPL", ("gpl-any",), 0),
    ("LGPL", ("lgpl",), 0),
    ("MPL-2.0", ("mpl-2.0",), 0),
    ("EPL-2.0", ("epl-2.0",), 0),
    ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa-4.0",), 0),
    ("CC-BY-NC-4.0", ("cc-by-nc-4.0",), 0),
    ("CC-BY-SA-4.0", ("cc-by-sa-4.0",), 0),
    ("CC-BY-4.0", ("cc-by-4.0",), 0),
    ("CC0-1.0", ("cc0",), 0),
    ("Unlicense", ("unlicense",), 0),
    *((licence, (f"spdx-{licence}",), 0) for licence in dict.fromkeys(SPDX.values())),
    ("proprietary", ("copyright", "all-rights"), 0),
)

_COMMENT = r"(^|\n)[ \t]*(?:#+|//+|\*+/?|/\*+|--+|;+|%+|<!--|>+)"
_SHORT = r"\b(v|ver|inc|ltd|corp|co|no|st|e\.g|i\.e)\.([ \t\n])"  # a mark that ends no sentence
_END = r"\n[ \t]*\n|[.!?;](?:[ \t\n]|$)"
#: Every known sentence has one of these, so other texts and sentences need no look.
_SIGNS = "licen[cs]e|copyright|copies|rights reserved|permission|redistribution|as is|public domain|cc0|cc by|gnu gpl|bsd|spdx|later version|endorse"
_JOINED = r"(?:or|and|with)"
_PHRASES = {phrase: name for name, phrases in SENTENCES.items() for phrase in phrases}
_BY_LENGTH = sorted(_PHRASES, key=lambda p: (-len(p), p))
_YEAR = "[0-9][0-9]"
_PHRASE = r"\b(?:" + "|".join(p + _YEAR if _PHRASES[p] == "copyright" else p for p in _BY_LENGTH) + r")\b"
_SHORT_NAME = "(?:" + "|".join(sorted(SPDX, key=lambda p: (-len(p), p))) + ")"
#: An identifier line with its expression, or two short names joined.
_EXPRESSION = rf"\bspdx license identifier {_SHORT_NAME}\b(?: {_JOINED} {_SHORT_NAME}\b)*|\b{_SHORT_NAME}(?: {_JOINED} {_SHORT_NAME}\b)+"


def _rule_pattern(needs: tuple[str, ...], gap: int) -> str:
    """The rule over a text of identifiers in angle brackets."""
    between = rf"(?:<\?>){{0,{gap}}}" if gap else ""
    out, begun = "", False
    for name in needs:
        one = f"<{name.rstrip('?')}>".replace(".", r"\.")
        if name.endswith("?"):
            out += f"(?:{between}{one})?" if begun else f"(?:{one}{between})?"
        else:
            out += (between if begun else "") + one
            begun = True
    return out


def _lines_joined(text: Column) -> Column:
    """Lines without their comment marks, and no mark left that looks like a sentence's end."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "\r", ""), _COMMENT, "$1")
    return F.regexp_replace(plain, _SHORT, "$1 $2")


def _plain(sentence: Column) -> Column:
    return F.replace(F.trim(F.regexp_replace(sentence, "[^a-z0-9]+", " ")), F.lit("licence"), F.lit("license"))


def _identifiers(plain: Column) -> Column:
    """What a sentence holds, in order: phrases, then expressions of short names; ``?`` for none."""
    phrases = F.create_map(*(F.lit(x) for p, name in _PHRASES.items() if name != "copyright" for x in (p, name)))
    names = F.create_map(*(F.lit(x) for p, name in SPDX.items() for x in (p, f"spdx-{name}")))
    known = F.transform(
        F.regexp_extract_all(plain, F.lit(_PHRASE), F.lit(0)),
        lambda p: F.when(p.startswith("copyright "), F.lit("copyright")).otherwise(F.element_at(phrases, p)),
    )
    short = F.flatten(F.transform(
        F.regexp_extract_all(plain, F.lit(_EXPRESSION), F.lit(0)),
        lambda e: F.transform(F.regexp_extract_all(e, F.lit(rf"\b{_SHORT_NAME}\b"), F.lit(0)), lambda p: F.element_at(names, p)),
    ))
    found = F.concat(known, short)
    return F.when(plain.rlike(_SIGNS) | plain.rlike(_EXPRESSION), F.when(F.size(found) > 0, found)).otherwise(F.lit(None))


def recognise(docs: DataFrame) -> DataFrame:
    """``docs`` with the identifiers of its known licence sentences in order (``sentence_ids``), the licences whose rules
    match (``licences``), and how many identifiers no rule took (``n_left``).

    Blank lines and marks end sentences, single line ends do not. A null or empty text has none. Input columns of these names give way.
    """
    text = F.coalesce("text", F.lit(""))
    unknown = F.array(F.lit("?"))
    flat = _plain(F.lower(text))
    may = flat.rlike(_SIGNS) | flat.rlike(_EXPRESSION)
    sentences = F.filter(F.transform(F.split(_lines_joined(text), _END, -1), _plain), lambda s: s != "")
    ids = F.when(may, F.flatten(F.transform(sentences, lambda s: F.coalesce(_identifiers(s), unknown)))).otherwise(F.array().cast("array<string>"))
    rules = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(_rule_pattern(needs, gap)).alias("pattern")) for name, needs, gap in RULES))
    packed = docs.select(F.struct("*").alias("d"), ids.alias("ids"))
    start = F.struct(
        F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "").alias("rest"),
        F.array().cast("array<string>").alias("found"),
    )

    def take(state: Column, rule: Column) -> Column:
        hit = F.regexp(state["rest"], rule["pattern"])
        return F.struct(
            F.when(hit, F.regexp_replace(state["rest"], rule["pattern"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
        )

    known = F.filter("ids", lambda i: i != "?")
    matched = F.when(F.size(known) > 0, F.aggregate(rules, start, take)).otherwise(start)
    done = packed.select("d", known.alias("known"), matched.alias("m"))
    kept = [F.col(f"d.`{c}`") for c in docs.columns if c not in ("sentence_ids", "licences", "n_left")]
    return done.select(
        *kept,
        F.array_join("known", ",").alias("sentence_ids"),
        F.array_join(F.array_sort(F.array_distinct("m.found")), ",").alias("licences"),
        F.when(F.size("known") == 0, 0).otherwise(
            F.size(F.filter(F.split("m.rest", "<"), lambda p: p.contains(">") & ~p.startswith("?")))
        ).cast("long").alias("n_left"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document."""
    return recognise(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def _sql() -> str:
    """The same rules for DuckDB. It shares the lists above, so it can only hold their use; the labelled notices of the tests hold the lists."""
    plain = "replace(trim(regexp_replace({}, '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')"
    phrase = " ".join(f"WHEN p = '{p}' THEN '{name}'" for p, name in _PHRASES.items() if name != "copyright")
    short = " ".join(f"WHEN p = '{p}' THEN 'spdx-{name}'" for p, name in SPDX.items())
    known = f"list_transform(regexp_extract_all(s, '{_PHRASE}'), lambda p: CASE WHEN starts_with(p, 'copyright ') THEN 'copyright' {phrase} END)"
    names = (f"flatten(list_transform(regexp_extract_all(s, '{_EXPRESSION}'), lambda e: "
             f"list_transform(regexp_extract_all(e, '\\b{_SHORT_NAME}\\b'), lambda p: CASE {short} END)))")
    steps = "SELECT doc_id, known, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') AS rest, []::VARCHAR[] AS found FROM k"
    for name, needs, gap in RULES:
        pattern = _rule_pattern(needs, gap)
        steps = f"""SELECT doc_id, known, regexp_replace(rest, '{pattern}', '|', 'g') AS rest,
          CASE WHEN regexp_matches(rest, '{pattern}') THEN list_append(found, '{name}') ELSE found END AS found FROM ({steps})"""
    joined = f"regexp_replace(replace(lower(coalesce(text, '')), chr(13), ''), '{_COMMENT}', '\\1', 'g')"
    return f"""
WITH j AS (SELECT doc_id, regexp_replace({joined}, '{_SHORT}', '\\1 \\2', 'g') AS t FROM documents),
s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(t, '{_END}'), lambda x: {plain.format('x')}), lambda x: x <> '') AS ss FROM j),
f AS (SELECT doc_id, list_transform(ss, lambda s: CASE WHEN regexp_matches(s, '{_SIGNS}') OR regexp_matches(s, '{_EXPRESSION}')
  THEN list_concat({known}, {names}) ELSE [] END) AS each FROM s),
i AS (SELECT doc_id, flatten(list_transform(each, lambda x: CASE WHEN len(x) > 0 THEN x ELSE ['?'] END)) AS ids FROM f),
k AS (SELECT doc_id, ids, list_filter(ids, lambda x: x <> '?') AS known FROM i)
SELECT doc_id, array_to_string(known, ',') AS sentence_ids, array_to_string(list_sort(list_distinct(found)), ',') AS licences,
  len(list_filter(string_split(rest, '<'), lambda p: contains(p, '>') AND NOT starts_with(p, '?')))::BIGINT AS n_left
FROM ({steps})
"""


OP4_SQL = _sql()
