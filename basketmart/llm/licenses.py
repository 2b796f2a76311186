"""Licence scan by sentence rules.

Comment leaders go, wrapped lines are joined, and the text is cut at sentence ends and at line breaks that are left. A
break is a wrap where the line before ends in a comma or in a word that wants another one, where the line after starts in
lower case or with a parenthesis, or where both are in capitals. Each sentence is normalised; an SPDX expression counts as
one sentence for each of its licences; a sentence that says anything about licensing is mapped to the
identifier of the first known sentence it matches, else to ``unknown``. Licence rules, in their order, are sequences of
identifiers; a rule that occurs takes its identifiers out of the sequence, so longer rules come before the shorter ones they
contain. Up to GAP unknown sentences in a row inside a sequence are passed over, more separate what they stand between.
Copyright, reservation and reference sentences are known but take no part in rules.

DataFrame functions only; a row is worked on where it is read and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketmart.llm.text import read_table

# A sentence without one of these says nothing about licensing.
TRIGGERS = "licens|licenc|copyright|warrant|redistribut|spdx|public domain|permission|rights reserved|liable"
_UNDER = "(this [a-z]+ is )?(released|licensed|distributed|available|provided|made available) under (the )?(terms of the )?"
_VERSION = "( license)?( version)?( v)? ?"
# Identifier and pattern of each known sentence, tried in this order on the normalised sentence.
SENTENCES = [
    ("copyright", "^(copyright|c copyright)( |$)"),
    ("reserved", "^all rights reserved$"),
    ("cc0", f"^{_UNDER}(creative commons zero|cc0)"),
    ("ccByNcNd", f"^{_UNDER}(cc|creative commons) (by-nc-nd|attribution noncommercial noderiv)"),
    ("ccByNcSa", f"^{_UNDER}(cc|creative commons) (by-nc-sa|attribution noncommercial sharealike)"),
    ("ccByNc", f"^{_UNDER}(cc|creative commons) (by-nc|attribution noncommercial)"),
    ("ccByNd", f"^{_UNDER}(cc|creative commons) (by-nd|attribution noderiv)"),
    ("ccBySa", f"^{_UNDER}(cc|creative commons) (by-sa|attribution sharealike)"),
    ("ccBy", f"^{_UNDER}(cc|creative commons) (by|attribution)"),
    ("agpl3", f"^{_UNDER}(gnu )?(affero general public license|agpl){_VERSION}3"),
    ("lgpl3", f"^{_UNDER}(gnu )?(lesser general public license|lgpl){_VERSION}3"),
    ("lgpl21", f"^{_UNDER}(gnu )?(lesser general public license|lgpl){_VERSION}2.1"),
    ("lgpl2", f"^{_UNDER}(gnu )?(lesser|library) general public license{_VERSION}2"),
    ("gpl3", f"^{_UNDER}(gnu )?(general public license|gpl){_VERSION}3"),
    ("gpl2", f"^{_UNDER}(gnu )?(general public license|gpl){_VERSION}2"),
    ("gplAny", f"^{_UNDER}(gnu )?(general public license|gpl)"),
    ("apache2", "^(licensed to the apache software foundation .*|the asf licenses this file to you )under the apache license version 2"),
    ("apacheAgreement", "^licensed to the apache software foundation"),
    ("apache2", f"^{_UNDER}apache( software)? license( version)? ?2"),
    ("mpl2", f"^{_UNDER}mozilla public license( version)? ?2"),
    ("bsd3", f"^{_UNDER}(3-clause bsd|bsd 3-clause|new bsd|modified bsd)"),
    ("bsd2", f"^{_UNDER}(2-clause bsd|bsd 2-clause|simplified bsd)"),
    ("bsdAny", f"^{_UNDER}bsd"),
    ("isc", f"^{_UNDER}isc"),
    ("mit", f"^{_UNDER}(mit|expat)( |$)"),
    ("spdxMit", "^spdx-license-identifier mit( |$)"),
    ("spdxIsc", "^spdx-license-identifier isc( |$)"),
    ("spdxApache2", "^spdx-license-identifier apache-2.0( |$)"),
    ("spdxGpl2", "^spdx-license-identifier gpl-2.0"),
    ("spdxGpl3", "^spdx-license-identifier gpl-3.0"),
    ("spdxLgpl2", "^spdx-license-identifier lgpl-2.0"),
    ("spdxLgpl21", "^spdx-license-identifier lgpl-2.1"),
    ("spdxLgpl3", "^spdx-license-identifier lgpl-3.0"),
    ("spdxAgpl3", "^spdx-license-identifier agpl-3.0"),
    ("spdxMpl2", "^spdx-license-identifier mpl-2.0"),
    ("spdxBsd2", "^spdx-license-identifier bsd-2-clause( |$)"),
    ("spdxBsd3", "^spdx-license-identifier bsd-3-clause( |$)"),
    ("spdxCc0", "^spdx-license-identifier cc0-1.0( |$)"),
    ("mitGrant", "^permission is hereby granted free of charge to any person obtaining a copy"),
    ("mitNotice", "^the above copyright notice and this permission notice shall be included"),
    ("asIs", "^the software is provided as is without warranty"),
    ("noLiability", "^in no event shall .* be liable"),
    ("iscGrant", "^permission to use copy modify and (or )?distribute this software for any purpose"),
    ("iscAsIs", "^the software is provided as is and .* disclaims all warranties"),
    ("bsdGrant", "^redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsdSource", "^(1. )?redistributions of source code must retain"),
    ("bsdBinary", "^(2. )?redistributions in binary form must reproduce"),
    ("bsdNames", "^(3. )?neither the name of"),
    ("bsdAsIs", "^this software is provided by .* as is"),
    ("gplGrant2", "you can redistribute it and or modify it under the terms of the gnu general public license .*version 2"),
    ("gplGrant3", "you can redistribute it and or modify it under the terms of the gnu general public license .*version 3"),
    ("lgplGrant21", "you can redistribute it and or modify it under the terms of the gnu lesser general public license .*version 2.1"),
    ("lgplGrant2", "you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license .*version 2"),
    ("lgplGrant3", "you can redistribute it and or modify it under the terms of the gnu lesser general public license .*version 3"),
    ("agplGrant3", "you can redistribute it and or modify it under the terms of the gnu affero general public license .*version 3"),
    ("gplWarranty", "^this (program|library) is distributed in the hope that it will be useful"),
    ("gplCopy", "^you should have received a copy of the gnu (lesser |library |affero )?general public license"),
    ("gplSee", "^see the gnu (lesser |library |affero )?general public license for more details"),
    ("apacheUse", "^you may not use this file except in compliance with the license"),
    ("apacheCopy", "^you may obtain a copy of the license at"),
    ("apacheAsIs", "^unless required by applicable law or agreed to in writing"),
    ("apacheUrl", "^https? www.apache.org licenses license-2.0$"),
    ("apacheSee", "^see the license for the specific language"),
    ("publicDomain", "(released|placed|dedicated) (in|in to|into|to) the public domain"),
]
IGNORED = ("copyright", "reserved", "apacheAgreement", "apacheUrl", "apacheSee", "gplSee")
# Licence and its sequence of identifiers, tried in this order.
RULES = [
    ("MIT", ["mitGrant", "mitNotice", "asIs", "noLiability"]),
    ("MIT", ["mitGrant", "mitNotice", "asIs"]),
    ("MIT", ["mitGrant", "mitNotice"]),
    ("ISC", ["iscGrant", "iscAsIs", "noLiability"]),
    ("ISC", ["iscGrant", "iscAsIs"]),
    ("ISC", ["iscGrant", "asIs"]),
    ("BSD-3-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdNames", "bsdAsIs", "noLiability"]),
    ("BSD-3-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdNames"]),
    ("BSD-2-Clause", ["bsdGrant", "bsdSource", "bsdBinary", "bsdAsIs", "noLiability"]),
    ("BSD-2-Clause", ["bsdGrant", "bsdSource", "bsdBinary"]),
    ("GPL-2.0", ["gplGrant2", "gplWarranty", "gplCopy"]),
    ("GPL-2.0", ["gplGrant2", "gplWarranty"]),
    ("GPL-3.0", ["gplGrant3", "gplWarranty", "gplCopy"]),
    ("GPL-3.0", ["gplGrant3", "gplWarranty"]),
    ("LGPL-2.1", ["lgplGrant21", "gplWarranty", "gplCopy"]),
    ("LGPL-2.1", ["lgplGrant21"]),
    ("LGPL-2.0", ["lgplGrant2", "gplWarranty", "gplCopy"]),
    ("LGPL-2.0", ["lgplGrant2"]),
    ("LGPL-3.0", ["lgplGrant3", "gplWarranty", "gplCopy"]),
    ("LGPL-3.0", ["lgplGrant3"]),
    ("AGPL-3.0", ["agplGrant3", "gplWarranty", "gplCopy"]),
    ("AGPL-3.0", ["agplGrant3"]),
    ("Apache-2.0", ["apache2", "apacheCopy", "apacheAsIs"]),
    ("Apache-2.0", ["apache2", "apacheUse", "apacheCopy", "apacheAsIs"]),
    ("Apache-2.0", ["apache2", "apacheUse", "apacheCopy"]),
    ("Apache-2.0", ["apacheUse", "apacheCopy", "apacheAsIs"]),
    ("Apache-2.0", ["apache2"]),
    ("Apache-2.0", ["spdxApache2"]),
    ("MIT", ["mit"]),
    ("MIT", ["spdxMit"]),
    ("GPL-2.0", ["gpl2"]),
    ("GPL-2.0", ["spdxGpl2"]),
    ("GPL-2.0", ["gplGrant2"]),
    ("GPL-3.0", ["gpl3"]),
    ("GPL-3.0", ["spdxGpl3"]),
    ("GPL-3.0", ["gplGrant3"]),
    ("GPL", ["gplAny"]),
    ("LGPL-2.1", ["lgpl21"]),
    ("LGPL-2.1", ["spdxLgpl21"]),
    ("LGPL-2.0", ["lgpl2"]),
    ("LGPL-2.0", ["spdxLgpl2"]),
    ("LGPL-3.0", ["spdxLgpl3"]),
    ("AGPL-3.0", ["spdxAgpl3"]),
    ("MPL-2.0", ["spdxMpl2"]),
    ("BSD-2-Clause", ["spdxBsd2"]),
    ("ISC", ["spdxIsc"]),
    ("CC0-1.0", ["spdxCc0"]),
    ("LGPL-3.0", ["lgpl3"]),
    ("AGPL-3.0", ["agpl3"]),
    ("MPL-2.0", ["mpl2"]),
    ("BSD-3-Clause", ["bsd3"]),
    ("BSD-3-Clause", ["spdxBsd3"]),
    ("BSD-2-Clause", ["bsd2"]),
    ("BSD", ["bsdAny"]),
    ("ISC", ["isc"]),
    ("CC0-1.0", ["cc0"]),
    ("CC-BY-NC-ND", ["ccByNcNd"]),
    ("CC-BY-NC-SA", ["ccByNcSa"]),
    ("CC-BY-NC", ["ccByNc"]),
    ("CC-BY-ND", ["ccByNd"]),
    ("CC-BY-SA", ["ccBySa"]),
    ("CC-BY", ["ccBy"]),
    ("Public-Domain", ["publicDomain"]),
]
UNKNOWN = "unknown"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = 3  # unknown sentences in a row that a rule passes over
_SPDX = "spdx-license-identifier "
# Words that want another one, so that a line ending in them goes on.
_WANTING = (
    "the of under a an by and or to in for with from that any this all version gnu general lesser library public apache mozilla"
).split()
_WANTED = "|".join(form for word in _WANTING for form in (word, word.upper(), word.capitalize()))
_TRAILER = r"[ \t]*\*+/"
_LEADER = r"(^|\n)[ \t]*(?:/\*+|\*+|//+|#+|;+|--+|<!--)[ \t]*"
_WRAPS = [
    rf"((?:^|[^A-Za-z])(?:{_WANTED})|,)[ \t\r]*\n[ \t]*([^ \t\r\n])",
    r"([^ \t\r\n.!?:])[ \t\r]*\n[ \t]*([a-z(])",
    r"""([A-Z"'][A-Z"'])[ \t\r]*\n[ \t]*([A-Z"'][A-Z"'])""",
]
_BREAK = r"([.!?])[ \t]+"
_OTHER = r"[^a-z0-9.+-]+"
_EDGES = r"^[ .+-]+|[ .+-]+$"


def _sequence(identifiers: list[str]) -> str:
    return "".join(f"<{i}>" for i in identifiers)


def _identified(sentence: Column) -> Column:
    out = F.lit(UNKNOWN)
    for identifier, pattern in reversed(SENTENCES):
        out = F.when(sentence.rlike(pattern), F.lit(identifier)).otherwise(out)
    return out


def _expression(sentence: Column) -> Column:
    """An SPDX expression as one sentence for each licence in it, any other sentence alone."""
    names = F.split(F.regexp_replace(sentence, f"^{_SPDX}", ""), " (?:or|and) ")
    return F.when(sentence.startswith(_SPDX), F.transform(names, lambda x: F.concat(F.lit(_SPDX), x))).otherwise(
        F.array(sentence)
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``sentences`` (identifiers in the text's order, separated by spaces), ``n_unknown`` and ``licenses``.

    ``licenses`` lists each licence found once, in the order of the rules, separated by spaces; it is ``unknown`` where there
    are licensing sentences but no rule fits, and empty where there are none, as for null and empty texts. Repeated rows
    repeat their result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("lower", F.translate("text", _UPPER, _LOWER))
    joined = F.regexp_replace(F.regexp_replace("text", _TRAILER, ""), _LEADER, "$1")
    for wrap in _WRAPS:
        joined = F.regexp_replace(joined, wrap, "$1 $2")
    lines = F.split(F.regexp_replace(F.translate(joined, _UPPER, _LOWER), _BREAK, "$1\n"), "\n")
    said = F.transform(
        F.filter(lines, lambda line: line.rlike(TRIGGERS)),
        lambda line: F.regexp_replace(F.regexp_replace(line, _OTHER, " "), _EDGES, ""),
    )
    said = F.flatten(F.transform(said, _expression))
    said = F.when(F.col("lower").rlike(TRIGGERS), said).otherwise(F.array().cast("array<string>"))
    rows = rows.select("doc_id", said.alias("said"))
    rows = rows.select("doc_id", F.transform("said", _identified).alias("ids"))
    taking_part = F.filter("ids", lambda i: ~i.isin(*IGNORED))
    rows = rows.withColumn("left", F.array_join(F.transform(taking_part, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
    # each rule reads what the rules before it have left, so one row carries the rest from rule to rule
    near = F.replace(F.regexp_replace("left", f"(<{UNKNOWN}>){{{GAP + 1},}}", "<>"), F.lit(f"<{UNKNOWN}>"), F.lit(""))
    start = F.struct(near.alias("rest"), F.array().cast("array<string>").alias("found"))
    rules = F.array(*[F.struct(F.lit(_sequence(s)).alias("s"), F.lit(name).alias("name")) for name, s in RULES])

    def step(state: Column, rule: Column) -> Column:
        hit = F.instr(state["rest"], rule["s"]) > 0
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["s"], F.lit("<>"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
        )

    found = F.array_distinct(F.aggregate(rules, start, step, lambda state: state["found"]))
    found = F.when(F.col("left") == "", F.array().cast("array<string>")).otherwise(found)
    licenses = F.when((F.col("left") != "") & (F.size(found) == 0), F.lit(UNKNOWN)).otherwise(F.array_join(found, " "))
    return rows.select(
        "doc_id",
        F.array_join("ids", " ").alias("sentences"),
        F.size(F.filter("ids", lambda i: i == UNKNOWN)).cast("long").alias("n_unknown"),
        licenses.alias("licenses"),
    )


def op1_license_sentences(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(read_table(spark, folder, "documents"))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def oracle() -> str:
    """The same in DuckDB's SQL, a common table expression for each rule."""
    cases = " ".join(f"WHEN regexp_matches(s, {_text(p)}) THEN {_text(i)}" for i, p in SENTENCES)
    ignored = ", ".join(_text(i) for i in IGNORED)
    steps, last = [], "r0"
    for n, (name, sequence) in enumerate(RULES, 1):
        wanted = _text(_sequence(sequence))
        steps.append(
            f"r{n} AS (SELECT doc_id, ids, first_left, replace(rest, {wanted}, '<>') AS rest, CASE WHEN contains(rest, {wanted}) "
            f"AND NOT list_contains(found, {_text(name)}) THEN list_append(found, {_text(name)}) ELSE found END AS found FROM {last})"
        )
        last = f"r{n}"
    newline = "chr(10)"
    joined = f"regexp_replace(regexp_replace(text, {_text(_TRAILER)}, '', 'g'), {_text(_LEADER)}, '\\1', 'g')"
    for wrap in _WRAPS:
        joined = f"regexp_replace({joined}, {_text(wrap)}, '\\1 \\2', 'g')"
    return f"""
WITH t AS (SELECT doc_id, CASE WHEN regexp_matches(translate(text, '{_UPPER}', '{_LOWER}'), {_text(TRIGGERS)}) THEN text ELSE '' END AS text FROM documents),
j AS (SELECT doc_id, translate({joined}, '{_UPPER}', '{_LOWER}') AS lower FROM t),
l AS (SELECT doc_id, string_split(regexp_replace(lower, {_text(_BREAK)}, '\\1' || {newline}, 'g'), {newline}) AS lines FROM j),
e AS (SELECT doc_id, list_transform(list_filter(lines, lambda x: regexp_matches(x, {_text(TRIGGERS)})),
  lambda x: regexp_replace(regexp_replace(x, {_text(_OTHER)}, ' ', 'g'), {_text(_EDGES)}, '', 'g')) AS said FROM l),
s AS (SELECT doc_id, flatten(list_transform(said, lambda x: CASE WHEN starts_with(x, '{_SPDX}') THEN list_transform(
  regexp_split_to_array(substr(x, {len(_SPDX) + 1}), ' (?:or|and) '), lambda y: '{_SPDX}' || y) ELSE [x] END)) AS said FROM e),
i AS (SELECT doc_id, list_transform(said, lambda s: CASE {cases} ELSE {_text(UNKNOWN)} END) AS ids FROM s),
r AS (SELECT doc_id, ids, coalesce(array_to_string(list_transform(list_filter(ids, lambda x: x NOT IN ({ignored})),
  lambda x: '<' || x || '>'), ''), '') AS first_left FROM i),
r0 AS (SELECT doc_id, ids, first_left, replace(regexp_replace(first_left, '(<{UNKNOWN}>){{{GAP + 1},}}', '<>', 'g'), '<{UNKNOWN}>', '') AS rest, CAST([] AS VARCHAR[]) AS found FROM r),
{", ".join(steps)}
SELECT doc_id, coalesce(array_to_string(ids, ' '), '') AS sentences,
  CAST(len(list_filter(ids, lambda x: x = {_text(UNKNOWN)})) AS BIGINT) AS n_unknown,
  CASE WHEN first_left <> '' AND len(found) = 0 THEN {_text(UNKNOWN)} ELSE coalesce(array_to_string(found, ' '), '') END AS licenses
FROM {last}"""
