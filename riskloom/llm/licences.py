"""Licence scans by sentence rules.

Texts are cut at stops and line ends; the cuts of a sentence wrapped over lines are joined as long as
they begin a known licence sentence, and what then equals one gets its identifier. A document's identifiers in page
order form its sequence. Ordered rules, longest evidence first, look for their sequence of
identifiers in that; what a rule has matched is used up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import map_arrow, table

# Known licence sentences in normal form ("#" for a version) and their identifiers.
SENTENCES = {
    "mit license": "MitTitle",
    "the mit license": "MitTitle",
    "licensed under the mit license": "MitGrant",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitPermission",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "AsIs",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscPermission",
    "licensed under the isc license": "IscGrant",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "licensed under the bsd license": "BsdName",
    "licensed under the apache license version #": "ApacheGrant",
    "licensed under the apache license version # the license": "ApacheGrant",
    "apache license version #": "ApacheTitle",
    "apache license": "ApacheTitle",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at": "ApacheCopy",
    "licensed under the gnu general public license version #": "GplGrant",
    "gnu general public license": "GplTitle",
    "gnu general public license version #": "GplTitle",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version # of the license or at your option any later version": "GplOrLater",
    "licensed under the gnu lesser general public license version #": "LgplGrant",
    "licensed under the gnu affero general public license version #": "AgplGrant",
    "this source code form is subject to the terms of the mozilla public license v #": "MplGrant",
    "licensed under the mozilla public license version #": "MplGrant",
    "licensed under the eclipse public license version #": "EplGrant",
    "licensed under cc by #": "CcByGrant",
    "licensed under cc by-sa #": "CcBySaGrant",
    "licensed under cc by-nc #": "CcByNcGrant",
    "licensed under cc by-nd #": "CcByNdGrant",
    "licensed under cc by-nc-sa #": "CcByNcSaGrant",
    "licensed under cc by-nc-nd #": "CcByNcNdGrant",
    "licensed under a creative commons attribution # international license": "CcByGrant",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "AllRights",
}

# Licences and the identifiers that show them, tried in this order.
RULES = (
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary")),
    ("MIT", ("MitPermission", "MitNotice", "AsIs")),
    ("MIT", ("MitPermission", "MitNotice")),
    ("Apache", ("ApacheGrant", "ApacheComply", "ApacheCopy")),
    ("Apache", ("ApacheGrant", "ApacheComply")),
    ("GPL-or-later", ("GplOrLater",)),
    ("MIT", ("MitTitle",)),
    ("MIT", ("MitGrant",)),
    ("ISC", ("IscPermission",)),
    ("ISC", ("IscGrant",)),
    ("BSD", ("BsdName",)),
    ("Apache", ("ApacheGrant",)),
    ("Apache", ("ApacheTitle",)),
    ("GPL", ("GplGrant",)),
    ("GPL", ("GplTitle",)),
    ("LGPL", ("LgplGrant",)),
    ("AGPL", ("AgplGrant",)),
    ("MPL", ("MplGrant",)),
    ("EPL", ("EplGrant",)),
    ("CC-BY-NC-SA", ("CcByNcSaGrant",)),
    ("CC-BY-NC-ND", ("CcByNcNdGrant",)),
    ("CC-BY-NC", ("CcByNcGrant",)),
    ("CC-BY-SA", ("CcBySaGrant",)),
    ("CC-BY-ND", ("CcByNdGrant",)),
    ("CC-BY", ("CcByGrant",)),
    ("Unlicense", ("Unlicense",)),
    ("All-Rights-Reserved", ("AllRights",)),
)

#: Every known sentence holds one of these, so other sentences need not be looked up.
LEGAL = "licens|copyright|permi[ts]|redistribut|warrant|public domain|rights reserved|endorse"
_VERSION = r"[0-9]+(\.[0-9]+)*"
_OPENING = "^(this [a-z]+ is )?(licensed|released|distributed|published|available) under "
_STOPS = r"([.!?])[ \t\r]+"


#: What begins or ends a line of a comment or a list, and how many words an unfinished opening has at most.
_LEADER = re.compile(r"^\s*(?:(?:#+|//+|/?\*+|--+|-(?=\s)|;+|%+|>+|<!--|dnl\b|rem\b|\(?[0-9a-z]\))\s*)*|(?:\s*(?:\*+/?|#+|-->))*\s*$", re.IGNORECASE)
_OPENING_WORDS = 5
_CUT, _NUMBER, _OTHER, _BEGINS = (re.compile(x, re.ASCII) for x in (r"(?<=[.!?])[ \t\r]+", _VERSION, "[^a-z#-]+", _OPENING))
#: The beginnings of known sentences, in whole words.
_PREFIXES = frozenset(" ".join(k.split()[:n]) for k in SENTENCES for n in range(1, len(k.split())))


def cuts(text: str) -> list[str]:
    """A text's lines without what makes them a comment, cut further after a stop that white space follows."""
    return [part for line in text.split("\n") for part in _CUT.split(_LEADER.sub("", line))]


def normal(sentence: str) -> str:
    """Lower case, versions as "#", letters, "#" and hyphens kept, all else single spaces, one way to begin a grant."""
    plain = _OTHER.sub(" ", _NUMBER.sub("#", sentence.lower())).strip(" ")
    return _BEGINS.sub("licensed under ", plain, count=1)


def known_sentences(text: str) -> list[tuple[int, str, str]]:
    """(place, identifier, version) of the known sentences of a text, the longest at each place.

    A sentence begins and ends at a cut. It goes on over a line end, but not over an empty line, nor
    over a stop unless a number follows.
    """
    parts, found, i = cuts(text), [], 0
    while i < len(parts):
        sentence, j, best = parts[i], i + 1, None
        while True:
            key = normal(sentence)
            if key in SENTENCES:
                best = (j, SENTENCES[key], sentence)
            open_ = key in _PREFIXES or 0 < len(key.split()) <= _OPENING_WORDS
            if not open_ or j == len(parts) or not parts[j].strip():
                break
            if sentence.rstrip()[-1:] in (".", "!", "?") and not parts[j][:1].isdigit():
                break
            sentence += " " + parts[j]
            j += 1
        if best:
            version = _NUMBER.search(best[2])
            found.append((i, best[1], version[0] if version else ""))
        i = best[0] if best else i + 1
    return found


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, sequence, versions, licences) of documents with a known sentence.

    ``sequence`` holds the identifiers in page order, ``versions`` the version each names ("" if none),
    ``licences`` the licences found, by rule order, each once with the first version it names.
    Null and empty texts have none. Rows that share an id are one document; rows without an id are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(k, *x) for k, text in enumerate(batch.column(1).to_pylist()) for x in known_sentences(text)]
            owner, at, identifier, version = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(at, pa.int64()), pa.array(identifier, pa.string()), pa.array(version, pa.string())],
                ["doc_id", "at", "identifier", "version"],
            )

    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.expr("doc_id is not null") & F.lower("text").rlike(LEGAL.replace(" ", "[^a-z]+")))
    met = map_arrow(named, run, f"doc_id {named.schema['doc_id'].dataType.simpleString()}, at long, identifier string, version string")
    found = met.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "identifier", "version"))).alias("met"))
    rows = found.select("doc_id", F.col("met.identifier").alias("sequence"), F.col("met.version").alias("versions"))
    return rows.withColumn("licences", licences(F.col("sequence"), F.col("versions")))


def licences(sequence: Column, versions: Column) -> Column:
    """Rules applied in order to a sequence of identifiers; a match takes its identifiers out."""
    left = F.concat(F.lit(","), F.array_join(sequence, ","), F.lit(","))
    found = []
    for name, parts in RULES:
        needle = "," + ",".join(parts) + ","
        version = F.get(versions, F.array_position(sequence, parts[0]).cast("int") - 1)
        full = F.when(F.coalesce(version, F.lit("")) == "", F.lit(name)).otherwise(F.concat(F.lit(name + "-"), version))
        found.append(F.when(F.contains(left, F.lit(needle)), full))
        left = F.replace(left, F.lit(needle), F.lit(",,"))
    return F.array_distinct(F.array_compact(F.array(*found)))


def query(spark, sf_dir: str) -> DataFrame:
    """All documents; those without a known sentence have no licences."""
    docs = table(spark, sf_dir, "documents")
    hits = scan(docs).select(F.col("doc_id").alias("_hit"), "sequence", "licences")
    joined = docs.select("doc_id").join(hits, F.col("doc_id") == F.col("_hit"), "left")
    return joined.select(
        "doc_id",
        F.coalesce(F.array_join("sequence", ","), F.lit("")).alias("sequence"),
        F.coalesce(F.array_join("licences", ","), F.lit("")).alias("licences"),
        F.coalesce(F.size("sequence"), F.lit(0)).cast("long").alias("n_sentences"),
    )


def sql() -> str:
    """The query in DuckDB SQL."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in SENTENCES.items())
    steps, names, left = [], [], "seq0"
    for i, (name, parts) in enumerate(RULES):
        needle = quoted("," + ",".join(parts) + ",")
        version = f"versions[list_position(ids, {quoted(parts[0])})]"
        full = f"CASE WHEN coalesce({version}, '') = '' THEN {quoted(name)} ELSE {quoted(name + '-')} || {version} END"
        steps.append(f"r{i} AS (SELECT *, CASE WHEN contains({left}, {needle}) THEN {full} END AS l{i}, replace({left}, {needle}, ',,') AS seq{i + 1} FROM {'r' + str(i - 1) if i else 'met'})")
        names.append(f"l{i}")
        left = f"seq{i + 1}"
    return f"""
WITH known(key, identifier) AS (VALUES {known}),
cut AS (
  SELECT doc_id, unnest(s) AS sentence, unnest(range(len(s))) AS place
  FROM (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '{_STOPS}', '\\1' || chr(10), 'g'), chr(10)) AS s FROM documents)
),
keyed AS (
  SELECT doc_id, place, regexp_extract(sentence, '{_VERSION}') AS version,
    regexp_replace(trim(regexp_replace(regexp_replace(lower(sentence), '{_VERSION}', '#', 'g'), '[^a-z#-]+', ' ', 'g')), '{_OPENING}', 'licensed under ') AS key
  FROM cut WHERE regexp_matches(lower(sentence), '{LEGAL}')
),
met AS (
  SELECT doc_id, list(identifier ORDER BY place) AS ids, list(version ORDER BY place) AS versions,
    ',' || string_agg(identifier, ',' ORDER BY place) || ',' AS seq0
  FROM keyed JOIN known USING (key) GROUP BY doc_id
),
{", ".join(steps)},
named AS (
  SELECT doc_id, ids, list_filter([{", ".join(names)}], lambda x: x IS NOT NULL) AS found FROM r{len(RULES) - 1}
)
SELECT d.doc_id, coalesce(array_to_string(n.ids, ','), '') AS sequence,
  coalesce(array_to_string(list_filter(n.found, lambda x, i: list_position(n.found, x) = i), ','), '') AS licences,
  coalesce(len(n.ids), 0)::BIGINT AS n_sentences
FROM documents d LEFT JOIN named n USING (doc_id)
"""
