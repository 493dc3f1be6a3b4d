"""Licence scan by canonical digests.

Texts are made canonical: lower case, without lines that state a copyright,
with equivalent spellings unified and everything but letters and digits as one
space. The digest of the whole result is looked up among the digests of known
licences (known_texts) by a hash join. Units are the whole document, each paragraph (between
empty lines) and each line, since licences mostly stand within documents.

Only DataFrame functions; the table of known digests is broadcast while it has
at most BROADCAST_LICENSES rows and joined by shuffle beyond.

Cases: null, empty and blank texts have no digest and no licence; several
licences of a document are listed once each, in alphabetical order; rows are
kept as they are, repeated ones and null ids included; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_LICENSES = 200_000

#: Notices and texts of public licences by their common ids.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")"),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "This project is licensed under the MIT License"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Released under CC0 1.0"),
    ("proprietary", "All rights reserved."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
)
_OR_LATER = "as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_OF = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
_OLD = "This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by "
_OLD += "the Free Software Foundation; either version {} of the License, or (at your option) any later version."
#: What heads source files.
HEADERS = (
    ("GPL-2.0-or-later", _OLD.format("program", "General Public License", "2")),
    ("GPL-2.0-or-later", (_OF + _OR_LATER).format("General Public License", "2")),
    ("GPL-3.0-or-later", (_OF + _OR_LATER).format("General Public License", "3")),
    ("LGPL-2.1-or-later", _OLD.format("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0-or-later", (_OF + _OR_LATER).format("Lesser General Public License", "3")),
    ("AGPL-3.0-or-later", (_OF + _OR_LATER).format("Affero General Public License", "3")),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
)
#: Titles that are given above a text or left out.
TITLES = {"MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"), "ISC": ("ISC License", "ISC License (ISC)"), "Zlib": ("zlib License",)} | {
    f"BSD-{n}-Clause": (f"BSD {n}-Clause License",) for n in (2, 3)
}
_ENDS = "END OF TERMS AND CONDITIONS"


@cache
def known_texts() -> tuple[tuple[str, str], ...]:
    """KNOWN, HEADERS and the whole texts of the folder licenses (name of the
    file, up to ~), with their titles and without instructions for use."""
    out = [*KNOWN, *HEADERS]
    for path in sorted((Path(__file__).parent / "licenses").glob("*.txt")):
        name, text = path.stem.split("~")[0], path.read_text("utf-8")
        body, end, _ = text.partition(_ENDS)
        out += [(name, text), *([(name, body), (name, body + end)] if end else [])]
        titles = TITLES.get(name, ())
        first, _, rest = text.partition("\n\n")
        body = rest if first.strip() in titles else text
        rights = ("", "All rights reserved.\n\n") if name.startswith("BSD") else ("",)
        out += [(name, f"{t}\n\n{r}{body}") for t in ("", *titles) for r in rights]
    return tuple(out)


#: Spellings that count as equal, after lower-casing.
SPELLINGS = (
    ("licence", "license"), ("licencing", "licensing"), ("sub-license", "sublicense"), ("sub license", "sublicense"),
    ("non-commercial", "noncommercial"), ("creative commons attribution", "cc by"), ("http://", "https://"),
    ("copyright owner", "copyright holder"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"),
    ("favour", "favor"), ("per cent", "percent"), ("v2.0", "version 2.0"), ("v3", "version 3"), ("(c)", "©"),
)
_COPYRIGHT = r"(?m)^[^\n]*(?:copyright|©)[^\n]*[0-9]{4}[^\n]*$"


def canonical_lines(text: Column) -> Column:
    """Canonical text whose lines are still apart."""
    text = F.lower(text)
    for spelling, usual in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(usual))
    about = F.contains(text, F.lit("copyright")) | F.contains(text, F.lit("©"))
    text = F.when(about, F.regexp_replace(text, _COPYRIGHT, "")).otherwise(text)
    return F.regexp_replace(text, r"[^a-z0-9\n]+", " ")


def _digest(lines: Column) -> Column:
    plain = F.trim(F.regexp_replace(lines, r"[ \n]+", " "))
    return F.when(plain != "", F.sha2(plain, 256))


def known_digests(spark: SparkSession, known=None) -> DataFrame:
    """(digest, license) of known texts, one row a digest."""
    texts = spark.createDataFrame(list(known or known_texts()), "license string, text string")
    return texts.select(_digest(canonical_lines(F.col("text"))).alias("digest"), "license").groupBy("digest").agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """One row a document: doc_id, digest of the whole text, license of the
    whole text (null if unknown), the licenses of its units (joined by commas)
    and n_units, the number of different units that are known."""
    table = F.broadcast(known) if known.count() <= BROADCAST_LICENSES else known
    rows = docs.select("doc_id", F.explode(F.array(canonical_lines(F.coalesce("text", F.lit(""))))).alias("lines"))
    units = F.concat(F.array("lines"), F.split("lines", "\n"), F.split("lines", r"\n ?(?:\n ?)+"))
    plain = F.array_distinct(F.transform(units, lambda x: F.trim(F.regexp_replace(x, r"[ \n]+", " "))))
    rows = rows.select("doc_id", F.explode(F.array(plain)).alias("units"))
    whole = F.when(F.col("units")[0] != "", F.sha2(F.col("units")[0], 256))
    rows = rows.select("doc_id", whole.alias("digest"), F.posexplode("units").alias("place", "unit"))
    rows = rows.select("doc_id", "digest", "place", F.sha2("unit", 256).alias("unit_digest"))
    table = table.withColumnsRenamed({"digest": "unit_digest", "license": "found"})
    hits = F.when(F.col("found").isNotNull(), F.col("unit_digest"))
    # rows equal in id and digest have equal units: they are counted, and come back as often
    out = rows.join(table, "unit_digest", "left").groupBy("doc_id", "digest").agg(
        F.array_join(F.sort_array(F.collect_set("found")), ",").alias("licenses"),
        F.size(F.collect_set(hits)).cast("long").alias("n_units"),
        F.min(F.when(F.col("place") == 0, F.col("found"))).alias("license"),
        F.count(F.when(F.col("place") == 0, True)).cast("int").alias("times"),
    )
    again = out.withColumn("time", F.explode(F.sequence(F.lit(1), "times")))
    return again.select("doc_id", "digest", "license", "licenses", "n_units")


def oracle() -> str:
    """The same over `documents` in DuckDB."""

    def canonical(text: str) -> str:
        text = f"lower({text})"
        for spelling, usual in SPELLINGS:
            text = f"replace({text}, '{spelling}', '{usual}')"
        return f"regexp_replace(regexp_replace({text}, '{_COPYRIGHT}', '', 'g'), '[^a-z0-9\n]+', ' ', 'g')"

    def plain(text: str) -> str:
        return f"trim(regexp_replace({text}, '[ \n]+', ' ', 'g'))"

    quoted = (tuple(x.replace("'", "''") for x in row) for row in known_texts())
    rows = ", ".join(f"('{name}', '{text}')" for name, text in quoted)
    return f"""
WITH known AS (
    SELECT sha256({plain("c")}) AS digest, min(license) AS license
    FROM (SELECT license, {canonical("text")} AS c FROM (VALUES {rows}) AS k(license, text)) GROUP BY 1
), c AS MATERIALIZED (
    SELECT doc_id, lines, CASE WHEN {plain("lines")} <> '' THEN sha256({plain("lines")}) END AS digest
    FROM (SELECT doc_id, {canonical("coalesce(text, '')")} AS lines FROM documents)
), u AS (
    SELECT DISTINCT doc_id, digest, {plain("unit")} AS unit
    FROM (SELECT doc_id, digest, unnest(list_concat(list_concat(string_split(lines, chr(10)),
          string_split_regex(lines, '\n ?(?:\n ?)+')), [lines])) AS unit FROM c)
), f AS (
    SELECT doc_id, u.digest, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
           count(DISTINCT sha256(unit)) AS n_units, min(license) FILTER (sha256(unit) = u.digest) AS license
    FROM u JOIN known k ON sha256(unit) = k.digest WHERE unit <> '' GROUP BY 1, 2
)
SELECT c.doc_id, c.digest, f.license, coalesce(f.licenses, '') AS licenses, coalesce(f.n_units, 0) AS n_units
FROM c LEFT JOIN f ON c.doc_id IS NOT DISTINCT FROM f.doc_id AND c.digest = f.digest
"""
