"""Licence recognition by sentence rules, in Spark SQL functions.

A text is cut into sentences; sentences that speak of licences are normalised
and mapped to the identifiers of all known licence sentences in them, by their
position (the standard GPL notice is one sentence).  The identifiers, in order of appearance, form a sequence; the ordered
licence rules are matched against it one after the other, and each takes the
identifiers it matches away from those that follow, wherever they stand; what
stood on both sides of them doesn't become neighbours by that.

Every row depends on itself only.

Defined results: null and empty texts have no sentences and no licence;
repeated rows are scanned one by one; other columns aren't read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: Fixed value: what a sentence must hold, in lower case, to be looked at.
KEYWORDS = "licen[cs]e|copyright|warrant|permission|spdx|redistribut|public domain|creative commons|cc by|cc0|\\bgnu\\b|endorse or promote|software is provided by"

#: Sentence identifiers and the patterns of normalised sentences.
SENTENCES = (
    ("SpdxApache2", "spdx license identifier apache 2[.]0"),
    ("SpdxMit", "spdx license identifier mit"),
    ("SpdxGpl3", "spdx license identifier gpl 3[.]0"),
    ("ApacheGrant", "licensed under the apache license version 2"),
    ("ApacheUse", "you may not use this (file|work) except in compliance with the license"),
    ("ApacheCopy", "you may obtain a copy of the license at"),
    ("ApacheAsIs", "distributed under the license is distributed on an as is basis"),
    ("MitName", "(released|licensed|distributed|available) under the (terms of the )?mit licen[cs]e"),
    ("MitGrant", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("MitNotice", "above copyright notice and this permission notice shall be included"),
    ("MitAsIs", "the software is provided as is without warranty of any kind"),
    ("BsdGrant", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("BsdSource", "redistributions of source code must retain the above copyright notice"),
    ("BsdBinary", "redistributions in binary form must reproduce the above copyright notice"),
    ("BsdEndorse", "neither the name of .* may be used to endorse or promote"),
    ("BsdAsIs", "this software is provided by .* as is"),
    ("LgplName", "gnu (lesser|library) general public licen[cs]e"),
    ("AgplName", "gnu affero general public licen[cs]e"),
    ("Gpl2Later", "version 2( of the license)? or .*any later version"),
    ("Gpl3Later", "version 3( of the license)? or .*any later version"),
    ("Gpl3Name", "gnu general public licen[cs]e (version|v) ?3"),
    ("Gpl2Name", "gnu general public licen[cs]e (version|v) ?2"),
    ("GplRedistribute", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("GplNoWarranty", "in the hope that it will be useful but without any warranty"),
    ("MplName", "mozilla public license (version|v) ?[.]? ?2[.]0"),
    ("CcByNcSa", "cc by nc sa 4[.]0|creative commons attribution noncommercial sharealike 4[.]0"),
    ("CcByNc", "cc by nc 4[.]0|creative commons attribution noncommercial 4[.]0"),
    ("CcBySa", "cc by sa 4[.]0|creative commons attribution sharealike 4[.]0"),
    ("CcBy", "cc by 4[.]0|creative commons attribution 4[.]0"),
    ("CcZero", "cc0 1[.]0|creative commons zero"),
    ("PublicDomain", "(placed in|dedicated to|is in) the public domain"),
)

#: Licences and the identifier sequences that stand for them, the
#: most specific first.  A sequence is a pattern over "Id;Id;...".  LGPL and AGPL
#: take their later versions before the GPL does; GPL is a notice without a version.
LICENSES = (
    ("LGPL", "LgplName;(Gpl[23]Later;)?(GplNoWarranty;)?"),
    ("AGPL", "AgplName;(Gpl[23]Later;)?(GplNoWarranty;)?"),
    ("BSD-3-Clause", "BsdGrant;BsdSource;BsdBinary;BsdEndorse;(BsdAsIs;)?"),
    ("BSD-2-Clause", "BsdGrant;BsdSource;BsdBinary;(BsdAsIs;)?"),
    ("MIT", "MitGrant;(MitNotice;)?(MitAsIs;)?"),
    ("MIT", "MitName;|SpdxMit;"),
    ("Apache-2.0", "(ApacheGrant;|SpdxApache2;)(ApacheUse;)?(ApacheCopy;)?(ApacheAsIs;)?"),
    ("GPL-2.0-or-later", "(GplRedistribute;Gpl2Name;|GplRedistribute;|Gpl2Name;)Gpl2Later;(GplNoWarranty;)?"),
    ("GPL-3.0-or-later", "(GplRedistribute;Gpl3Name;|GplRedistribute;|Gpl3Name;)Gpl3Later;(GplNoWarranty;)?"),
    ("GPL-2.0-only", "(GplRedistribute;)?Gpl2Name;(GplNoWarranty;)?"),
    ("GPL-3.0-only", "((GplRedistribute;)?Gpl3Name;|SpdxGpl3;)(GplNoWarranty;)?"),
    ("MPL-2.0", "MplName;"),
    ("CC-BY-NC-SA-4.0", "CcByNcSa;"),
    ("CC-BY-NC-4.0", "CcByNc;"),
    ("CC-BY-SA-4.0", "CcBySa;"),
    ("CC-BY-4.0", "CcBy;"),
    ("CC0-1.0", "CcZero;"),
    ("Public-Domain", "PublicDomain;"),
    ("GPL", "GplRedistribute;(GplNoWarranty;)?"),
)
#: The identifier of a sentence of licences that no rule knows.
UNKNOWN = "Unknown"


#: Stands where a rule has taken identifiers, so that those on both sides of it
#: don't become neighbours.
TAKEN = "|"


def _wrapped(pattern: str) -> str:
    """A pattern over "Id;Id;..." as one over "<Id><Id>...", where every
    identifier bears its own bounds."""
    return re.sub(r"([A-Za-z0-9\[\]]+);", r"<\1>", pattern)


def sentences(text: Column) -> Column:
    """Normalised sentences that hold one of KEYWORDS: a sentence ends after a stop
    and white space, or with an empty line; comment marks are no words."""
    low = F.lower(F.coalesce(text, F.lit("")))
    ended = F.regexp_replace(F.regexp_replace(low, "\\r", ""), "([.!?])[ \\t\\n]+|\\n[ \\t]*\\n", "$1\u001e")
    plain = F.transform(F.split(ended, "\u001e"), lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9.+]+", " ")))
    raw = KEYWORDS.replace("\\b", "").replace(" ", "[^a-z0-9.+]+")  # whole texts are told first, by no less
    return F.filter(F.when(low.rlike(raw), plain).otherwise(F.array().cast("array<string>")), lambda s: s.rlike(KEYWORDS))


def _identify(sentence: Column) -> Column:
    """The identifiers of all patterns in a sentence, by position."""
    at = F.array(*[F.struct(F.regexp_instr(sentence, F.lit(pattern)).alias("at"), F.lit(k).alias("k"), F.lit(name).alias("name")) for k, (name, pattern) in enumerate(SENTENCES)])
    found = F.transform(F.array_sort(F.filter(at, lambda x: x["at"] > 0)), lambda x: x["name"])
    return F.transform(F.array(found), lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(F.lit(UNKNOWN))))[0]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences, sentence_ids (array, in order), licenses (array, sorted) and
    unknown, the identifiers that no licence rule took (array, in order)."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.transform(sentences(F.col(text_col)), _identify).alias("_ids"))
    rows = rows.select("doc_id", F.size("_ids").cast("long").alias("n_sentences"), F.flatten("_ids").alias("sentence_ids"))
    rows = rows.withColumn("_left", F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
    found = []
    for k, (name, pattern) in enumerate(LICENSES):
        whole = _wrapped(pattern)
        rows = rows.withColumn(f"_found{k}", F.when(F.col("_left").rlike(whole), name))
        rows = rows.withColumn("_left", F.when(F.col(f"_found{k}").isNotNull(), F.regexp_replace("_left", whole, TAKEN)).otherwise(F.col("_left")))
        found.append(F.col(f"_found{k}"))
    licenses = F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))
    return rows.select("doc_id", "n_sentences", "sentence_ids", licenses.alias("licenses"), F.regexp_extract_all("_left", F.lit("<([^>]+)>"), F.lit(1)).alias("unknown"))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    got = scan(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_sentences", F.array_join("sentence_ids", ";").alias("sentence_ids"), F.array_join("licenses", " AND ").alias("licenses"), F.size("unknown").cast("long").alias("n_unknown"))


def oracle() -> str:
    """The same as DuckDB SQL, from the same tables of rules.  A pattern's first match
    stands where its text is first found, since an earlier place would match too."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    names = ", ".join(quote(n) for n, _ in SENTENCES)
    places = ", ".join(f"CASE WHEN regexp_matches(s, {quote(p)}) THEN strpos(s, regexp_extract(s, {quote(p)})) ELSE 0 END" for _, p in SENTENCES)
    steps, last = [], "c0"
    for k, (name, pattern) in enumerate(LICENSES):
        whole = quote(_wrapped(pattern))
        steps.append(f"c{k + 1} AS MATERIALIZED (SELECT doc_id, n, ids, CASE WHEN regexp_matches(rest, {whole}) THEN list_append(found, {quote(name)}) ELSE found END AS found, regexp_replace(rest, {whole}, '{TAKEN}', 'g') AS rest FROM c{k})")
        last = f"c{k + 1}"
    return f"""
WITH low AS (SELECT doc_id, replace(lower(coalesce(text, '')), chr(13), '') AS t FROM documents),
cut AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(t, '([.!?])[ \\t\\n]+|\\n[ \\t]*\\n', '\\1' || chr(30), 'g'), chr(30)),
        lambda s: trim(regexp_replace(s, '[^a-z0-9.+]+', ' ', 'g'))), lambda s: regexp_matches(s, {quote(KEYWORDS)})) AS ss FROM low),
placed AS (SELECT doc_id, list_transform(ss, lambda s: [{places}]) AS places FROM cut),
ordered AS (SELECT doc_id, list_transform(places, lambda a: list_sort(list_filter(list_transform(range(1, len(a) + 1), lambda k: {{'place': a[k], 'k': k}}), lambda x: x['place'] > 0))) AS found FROM placed),
named AS (SELECT doc_id, len(found) AS n, flatten(list_transform(found, lambda f: CASE WHEN len(f) = 0 THEN [{quote(UNKNOWN)}] ELSE list_transform(f, lambda x: ([{names}])[x['k']]) END)) AS ids FROM ordered),
c0 AS (SELECT doc_id, n, ids, []::VARCHAR[] AS found, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') AS rest FROM named),
{", ".join(steps)}
SELECT doc_id, n::BIGINT AS n_sentences, array_to_string(ids, ';') AS sentence_ids,
       array_to_string(list_sort(list_distinct(found)), ' AND ') AS licenses,
       (length(rest) - length(replace(rest, '<', '')))::BIGINT AS n_unknown
FROM {last}"""
