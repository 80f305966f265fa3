"""Operator 10 [native]: licence scan by sentence rules, with DataFrame functions alone.

Known licence sentences are searched between sentence or line ends, word by word, so wrapped lines and marks inside a
sentence do not matter; each found one gives its identifier. A document's identifiers, in order, form a sequence; ordered rules are matched against it. A rule asks
for sentences in an order, each next to or after the one before; the first rule of a licence family that matches
names the licence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences (normalised: lower case, letters, digits and single spaces) by identifier.
SENTENCES = {
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-name": "the mit license",
    "mit-released": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "isc-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-permission": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-licensed": "licensed under the bsd license",
    "apache-licensed": "licensed under the apache license",
    "apache-full": "licensed under the apache license version 2 0 the license",
    "apache-version": "licensed under the apache license version 2",
    "apache-version-dotted": "licensed under the apache license version 2 0",
    "apache-use": "you may not use this file except in compliance with the license",
    "gpl-v3": "this work is licensed under the gnu general public license version 3",
    "gpl-v2": "this work is licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-v3": "this library is licensed under the gnu lesser general public license version 3",
    "mpl-2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl-2-short": "this source code form is subject to the terms of the mozilla public license v 2",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by-nc": "licensed under cc by nc 4",
    "cc-by-nc-dotted": "licensed under cc by nc 4 0",
    "cc-by-sa": "licensed under cc by sa 4",
    "cc-by-sa-dotted": "licensed under cc by sa 4 0",
    "cc-by": "licensed under cc by 4",
    "cc-by-dotted": "licensed under cc by 4 0",
    "cc0": "licensed under cc0 1",
    "mit-project": "this project is licensed under the mit license",
    "mit-software": "this software is licensed under the mit license",
    "mit-terms": "this project is licensed under the terms of the mit license",
    "mit-spdx": "spdx license identifier mit",
    "isc-title": "isc license",
    "isc-permission-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-spdx": "spdx license identifier isc",
    "0bsd-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "0bsd-spdx": "spdx license identifier 0bsd",
    "bsd-names-author": "neither the name of the author nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-3-title": "bsd 3 clause license",
    "bsd-3-spdx": "spdx license identifier bsd 3 clause",
    "bsd-2-title": "bsd 2 clause license",
    "bsd-2-spdx": "spdx license identifier bsd 2 clause",
    "apache-project": "this project is licensed under the apache license 2 0",
    "apache-title": "apache license version 2 0 january 2004",
    "apache-spdx": "spdx license identifier apache 2 0",
    "gpl-3-title": "gnu general public license version 3 29 june 2007",
    "gpl-3-spdx-only": "spdx license identifier gpl 3 0 only",
    "gpl-3-spdx-later": "spdx license identifier gpl 3 0 or later",
    "gpl-3-spdx": "spdx license identifier gpl 3 0",
    "gpl-2-title": "gnu general public license version 2 june 1991",
    "gpl-2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "gpl-2-spdx-only": "spdx license identifier gpl 2 0 only",
    "gpl-2-spdx-later": "spdx license identifier gpl 2 0 or later",
    "gpl-2-spdx": "spdx license identifier gpl 2 0",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-title": "gnu affero general public license version 3 19 november 2007",
    "agpl-spdx-only": "spdx license identifier agpl 3 0 only",
    "agpl-spdx-later": "spdx license identifier agpl 3 0 or later",
    "lgpl-free-3": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl-3-spdx-only": "spdx license identifier lgpl 3 0 only",
    "lgpl-3-spdx-later": "spdx license identifier lgpl 3 0 or later",
    "lgpl-free-2-1": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl-2-1-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl-2-1-spdx-only": "spdx license identifier lgpl 2 1 only",
    "lgpl-2-1-spdx-later": "spdx license identifier lgpl 2 1 or later",
    "mpl-2-title": "mozilla public license version 2 0",
    "mpl-2-spdx": "spdx license identifier mpl 2 0",
    "epl-2-terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "epl-2-title": "eclipse public license v 2 0",
    "epl-2-spdx": "spdx license identifier epl 2 0",
    "unlicense-title": "the unlicense",
    "unlicense-spdx": "spdx license identifier unlicense",
    "zlib-permission": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-spdx": "spdx license identifier zlib",
    "bsl-distributed": "distributed under the boost software license version 1 0",
    "bsl-title": "boost software license version 1 0 august 17th 2003",
    "bsl-spdx": "spdx license identifier bsl 1 0",
    "wtfpl-copies": "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed",
    "artistic-2-title": "the artistic license 2 0",
    "artistic-2-spdx": "spdx license identifier artistic 2 0",
    "eupl-licensed": "licensed under the eupl",
    "eupl-title": "european union public licence v 1 2",
    "eupl-spdx": "spdx license identifier eupl 1 2",
    "cc-by-nc-work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-sa-work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-spdx": "spdx license identifier cc by 4 0",
    "cc-by-sa-spdx": "spdx license identifier cc by sa 4 0",
    "cc0-title": "cc0 1 0 universal",
    "cc0-spdx": "spdx license identifier cc0 1 0",
}

# Rules in order; each licence with the identifiers that must follow one another in the sequence.
RULES = (
    ("MIT", ("mit-permission", "mit-notice", "as-is")),
    ("MIT", ("mit-permission", "mit-notice")),
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("ISC", ("isc-permission",)),
    ("BSD-3-Clause", ("bsd-permission", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-permission", "bsd-source", "bsd-binary")),
    ("BSD", ("bsd-licensed",)),
    ("Apache-2.0", ("apache-full", "apache-use")),
    ("Apache-2.0", ("apache-full",)),
    ("Apache-2.0", ("apache-version-dotted",)),
    ("Apache-2.0", ("apache-version",)),
    ("Apache", ("apache-licensed",)),
    ("GPL-3.0", ("gpl-free", "gpl-hope")),
    ("GPL-3.0", ("gpl-v3",)),
    ("GPL-3.0", ("gpl-free",)),
    ("GPL-2.0", ("gpl-free-2", "gpl-hope")),
    ("GPL-2.0", ("gpl-v2",)),
    ("GPL-2.0", ("gpl-free-2",)),
    ("LGPL-3.0", ("lgpl-v3",)),
    ("MPL-2.0", ("mpl-2",)),
    ("MPL-2.0", ("mpl-2-short",)),
    ("Unlicense", ("unlicense",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-dotted",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-dotted",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-4.0", ("cc-by-dotted",)),
    ("CC0-1.0", ("cc0",)),
    ("MIT", ("mit-project",)),
    ("MIT", ("mit-software",)),
    ("MIT", ("mit-terms",)),
    ("MIT", ("mit-spdx",)),
    ("ISC", ("isc-title",)),
    ("ISC", ("isc-permission-and",)),
    ("ISC", ("isc-spdx",)),
    ("0BSD", ("0bsd-permission",)),
    ("0BSD", ("0bsd-spdx",)),
    ("BSD-3-Clause", ("bsd-permission", "bsd-source", "bsd-binary", "bsd-names-author")),
    ("BSD-3-Clause", ("bsd-3-title",)),
    ("BSD-3-Clause", ("bsd-3-spdx",)),
    ("BSD-2-Clause", ("bsd-2-title",)),
    ("BSD-2-Clause", ("bsd-2-spdx",)),
    ("Apache-2.0", ("apache-project",)),
    ("Apache-2.0", ("apache-title",)),
    ("Apache-2.0", ("apache-spdx",)),
    ("GPL-3.0", ("gpl-3-title",)),
    ("GPL-3.0", ("gpl-3-spdx-only",)),
    ("GPL-3.0", ("gpl-3-spdx-later",)),
    ("GPL-3.0", ("gpl-3-spdx",)),
    ("GPL-2.0", ("gpl-2-title",)),
    ("GPL-2.0", ("gpl-2-only",)),
    ("GPL-2.0", ("gpl-2-spdx-only",)),
    ("GPL-2.0", ("gpl-2-spdx-later",)),
    ("GPL-2.0", ("gpl-2-spdx",)),
    ("AGPL-3.0", ("agpl-free",)),
    ("AGPL-3.0", ("agpl-title",)),
    ("AGPL-3.0", ("agpl-spdx-only",)),
    ("AGPL-3.0", ("agpl-spdx-later",)),
    ("LGPL-3.0", ("lgpl-free-3",)),
    ("LGPL-3.0", ("lgpl-3-title",)),
    ("LGPL-3.0", ("lgpl-3-spdx-only",)),
    ("LGPL-3.0", ("lgpl-3-spdx-later",)),
    ("LGPL-2.1", ("lgpl-free-2-1",)),
    ("LGPL-2.1", ("lgpl-2-1-title",)),
    ("LGPL-2.1", ("lgpl-2-1-spdx-only",)),
    ("LGPL-2.1", ("lgpl-2-1-spdx-later",)),
    ("MPL-2.0", ("mpl-2-title",)),
    ("MPL-2.0", ("mpl-2-spdx",)),
    ("EPL-2.0", ("epl-2-terms",)),
    ("EPL-2.0", ("epl-2-title",)),
    ("EPL-2.0", ("epl-2-spdx",)),
    ("Unlicense", ("unlicense-title",)),
    ("Unlicense", ("unlicense-spdx",)),
    ("Zlib", ("zlib-as-is", "zlib-permission")),
    ("Zlib", ("zlib-permission",)),
    ("Zlib", ("zlib-spdx",)),
    ("BSL-1.0", ("bsl-distributed",)),
    ("BSL-1.0", ("bsl-title",)),
    ("BSL-1.0", ("bsl-spdx",)),
    ("WTFPL", ("wtfpl-copies",)),
    ("Artistic-2.0", ("artistic-2-title",)),
    ("Artistic-2.0", ("artistic-2-spdx",)),
    ("EUPL-1.2", ("eupl-licensed",)),
    ("EUPL-1.2", ("eupl-title",)),
    ("EUPL-1.2", ("eupl-spdx",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-work",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-spdx",)),
    ("CC-BY-4.0", ("cc-by-work",)),
    ("CC-BY-4.0", ("cc-by-spdx",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC0-1.0", ("cc0-spdx",)),
)

# A sentence ends at a stop and white space, at a line end, or at one of ; : ! ?
SENTENCE_END = r"\.[ \t\r\n]+|\.$|[\n;:!?]"
NOT_WORD = "[^a-z0-9]+"


def rule_pattern(parts: tuple[str, ...]) -> str:
    """Regular expression, for the SQL, over the sequence ',id,id,': the parts in order, others between them allowed."""
    return "(,[a-z0-9-]+)*,".join(("," if i == 0 else "") + p for i, p in enumerate(parts)) + ","


def holds(sequence: Column, parts: tuple[str, ...]) -> Column:
    """Whether the sequence ',id,id,' has the parts in order: each is sought from the place of the one before, so time is linear."""
    at = F.lit(1)
    for part in parts:
        found = F.call_function("locate", F.lit(f",{part},"), sequence, at)
        at = F.when(at > 0, F.when(found > 0, found + len(part) + 1).otherwise(0)).otherwise(0)
    return at > 0


# Where a known sentence may start and end, and what may stand between its words. Line ends and marks inside a
# sentence are passed over, blank lines are not. Nothing here can be matched in two ways, so a search takes linear time.
GAP = r"(?![a-z0-9])[^a-z0-9\n]*+(?:\n[^a-z0-9\n]*+)?+"
START = r"(?:\A[^a-z0-9]*+|(?:[\n;:!?]|\.[ \t\r])[^a-z0-9\n;:!?.]*+\.?[^a-z0-9\n;:!?.]*+)"
END = r"(?![a-z0-9])(?=[^a-z0-9]*(?:[\n;:!?]|\.[ \t\r]|\z))"


def sentence_pattern() -> str:
    """Any known sentence, the longest first, as group 1."""
    longest = sorted(SENTENCES.values(), key=len, reverse=True)
    return START + "(" + "|".join(GAP.join(s.split()) for s in longest) + ")" + END


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order; a sentence may be wrapped over lines and hold marks."""
    known = F.create_map(*[F.lit(x) for i, s in SENTENCES.items() for x in (s, i)])
    found = F.regexp_extract_all(F.lower(text), F.lit(sentence_pattern()), 1)
    return F.transform(found, lambda s: F.try_element_at(known, F.regexp_replace(s, NOT_WORD, " ")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_sentences, sentence_ids (comma-joined, in order), licenses (comma-joined, in rule order), license.

    license is the first rule's, null without any. Null and empty texts have no sentences. Whole texts are read;
    repeated rows give a row each; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # A text without any of the words that every known sentence has one of can hold none.
    ids = F.when(F.lower(text).rlike(NEEDED), sentence_ids(text)).otherwise(F.array().cast("array<string>"))
    out = docs.select(F.col(id_col).alias("doc_id"), ids.alias("ids"))
    out = out.withColumn("sequence", F.concat(F.lit(","), F.array_join("ids", ","), F.lit(",")))
    hits = F.array(*[F.when(holds(F.col("sequence"), parts), F.lit(name)) for name, parts in RULES])
    names = F.array_distinct(F.array_compact(hits))
    found = F.when(F.size("ids") > 0, names).otherwise(F.array().cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"), F.array_join(found, ",").alias("licenses"), F.get(found, 0).alias("license"))


# Every known sentence has one of these.
NEEDED = r"licen[sc]|permi|redistribut|warrant|eupl|cc0|public[^a-z0-9]+domain"


def oracle() -> str:
    """DuckDB SQL, sentence by sentence: the same rows for texts in which no known sentence goes over a line end or a mark."""
    values = ", ".join(f"('{s}', '{i}')" for i, s in SENTENCES.items())
    rules = ", ".join(f"({n}, '{name}', '{rule_pattern(parts)}')" for n, (name, parts) in enumerate(RULES))
    return f"""
        WITH known(sentence, id) AS (VALUES {values}), rules(n, name, pattern) AS (VALUES {rules}),
        parts AS (SELECT doc_id, unnest(regexp_split_to_array(lower(coalesce(text, '')), '{SENTENCE_END}')) AS s, generate_subscripts(regexp_split_to_array(lower(coalesce(text, '')), '{SENTENCE_END}'), 1) AS k FROM documents),
        hits AS (SELECT doc_id, k, id FROM (SELECT doc_id, k, trim(regexp_replace(s, '{NOT_WORD}', ' ', 'g')) AS s FROM parts) JOIN known ON s = sentence),
        seqs AS (SELECT doc_id, count(*) AS n_sentences, string_agg(id, ',' ORDER BY k) AS sentence_ids FROM hits GROUP BY doc_id),
        named AS (SELECT doc_id, name, min(n) AS n FROM seqs JOIN rules ON regexp_matches(',' || sentence_ids || ',', pattern) GROUP BY doc_id, name),
        listed AS (SELECT doc_id, string_agg(name, ',' ORDER BY n) AS licenses, arg_min(name, n) AS license FROM named GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(sentence_ids, '') AS sentence_ids, coalesce(licenses, '') AS licenses, license
        FROM documents d LEFT JOIN seqs s ON d.doc_id = s.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id"""
