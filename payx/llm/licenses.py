"""License scans by recognising sentences.

A text is normalised and cut into sentences, which are looked up among known license sentences; the identifiers found,
in order, are matched against ordered license rules, the first rule that matches naming the license. A sentence may be
wrapped over lines, with comment marks before each. Only DataFrame functions are used.

Known are characteristic sentences of license texts and headers, written out below, and sentences that name a license,
made by rule: a verb and a name, a tag and a short name, or a name as a title. A reservation of rights is known, but
names no license.

Null text has no sentences. A text without a known sentence has no license (null). Repeated rows each have a row;
other columns than doc_id and text are ignored; texts are scanned whole, in one pass, whatever their length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences in normal form (lower case, letters, digits and single blanks), by identifier.
SENTENCES = {
    "mit-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",),
    "mit-notice": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "mit-warranty": ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",),
    "mit-0-grant": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",),
    "isc-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    "0bsd-grant": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "apache-grant": ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",),
    "apache-copy": ("you may obtain a copy of the license at http www apache org licenses license 2 0",),
    "apache-title": ("apache license version 2 0 january 2004 http www apache org licenses",),
    "apache-terms": ("subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works of publicly display publicly perform sublicense and distribute the work and such derivative works in source or object form",),
    "bsd-grant": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "bsd-source": ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",),
    "bsd-binary": ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",),
    "bsd-advertising": ("all advertising materials mentioning features or use of this software must display the following acknowledgement",),
    "bsd-endorse": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "neither the name of the copyright holder nor the names of the contributors may be used to endorse or promote products derived from this software without specific prior written permission", "neither the name of the university nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    "gpl-grant-2": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",),
    "gpl-only-2": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",),
    "gpl-grant-3": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",),
    "gpl-title-2": ("gnu general public license version 2 june 1991",),
    "gpl-title-3": ("gnu general public license version 3 29 june 2007",),
    "gpl-preamble-2": ("the licenses for most software are designed to take away your freedom to share and change it",),
    "gpl-preamble-3": ("the gnu general public license is a free copyleft license for software and other kinds of works",),
    "lgpl-grant-2": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",),
    "lgpl-grant-3": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    "lgpl-title-2": ("gnu lesser general public license version 2 1 february 1999",),
    "lgpl-title-3": ("gnu lesser general public license version 3 29 june 2007",),
    "agpl-grant": ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation version 3 of the license"),
    "agpl-title": ("gnu affero general public license version 3 19 november 2007",),
    "mpl-grant": ("this source code form is subject to the terms of the mozilla public license v", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    "mpl-title": ("mozilla public license version 2 0",),
    "epl-grant": ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at http www eclipse org legal epl 2 0", "this program and the accompanying materials are made available under the terms of the eclipse public license v2 0"),
    "epl-title": ("eclipse public license v 2 0", "eclipse public license version 2 0"),
    "artistic-title": ("the artistic license 2 0 copyright c 2000 2006 the perl foundation",),
    "artistic-grant": ("everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed",),
    "boost-grant": ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following",),
    "boost-title": ("boost software license version 1 0 august 17th 2003",),
    "zlib-warranty": ("this software is provided as is without any express or implied warranty",),
    "zlib-grant": ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "unlicense-grant": ("anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",),
    "bsl-title": ("business source license 1 1",),
    "bsl-grant": ("the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work",),
    "cc0-title": ("creative commons legal code cc0 1 0 universal", "cc0 1 0 universal"),
    "reserved": ("all rights reserved",),
}

# Names of licenses after a verb, and short names after a tag, by license.
NAMES = {
    "MIT": ("the mit license", "mit license", "mit"),
    "ISC": ("the isc license", "isc"),
    "Apache-2.0": ("the apache license version 2 0", "the apache license 2 0", "apache license 2 0", "apache 2 0"),
    "BSD-3-Clause": ("the bsd 3 clause license", "the 3 clause bsd license", "a bsd 3 clause license", "bsd 3 clause"),
    "BSD-2-Clause": ("the bsd 2 clause license", "the 2 clause bsd license", "bsd 2 clause"),
    "AGPL-3.0": ("the gnu affero general public license version 3", "the gnu affero general public license v3 0", "the agpl v3", "agpl 3 0"),
    "LGPL-3.0": ("the gnu lesser general public license version 3", "the lgpl v3", "lgpl 3 0"),
    "LGPL-2.1": ("the gnu lesser general public license version 2 1", "the lgpl v2 1", "lgpl 2 1"),
    "GPL-3.0": ("the gnu general public license version 3", "the gnu general public license v3 0", "the gnu gpl v3", "the gpl v3", "gpl 3 0"),
    "GPL-2.0": ("the gnu general public license version 2", "the gnu general public license v2 0", "the gnu gpl v2", "the gpl v2", "gpl 2 0"),
    "MPL-2.0": ("the mozilla public license version 2 0", "the mozilla public license 2 0", "mpl 2 0"),
    "EPL-2.0": ("the eclipse public license version 2 0", "the eclipse public license 2 0", "epl 2 0"),
    "Artistic-2.0": ("the artistic license 2 0", "artistic 2 0"),
    "BSL-1.0": ("the boost software license version 1 0", "bsl 1 0"),
    "BUSL-1.1": ("the business source license 1 1", "busl 1 1"),
    "Zlib": ("the zlib license", "zlib"),
    "CC-BY-NC-4.0": ("cc by nc 4 0", "a creative commons attribution noncommercial 4 0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4 0", "a creative commons attribution sharealike 4 0 international license"),
    "CC-BY-ND-4.0": ("cc by nd 4 0", "a creative commons attribution noderivatives 4 0 international license"),
    "CC-BY-4.0": ("cc by 4 0", "a creative commons attribution 4 0 international license"),
    "CC0-1.0": ("cc0 1 0",),
    "Unlicense": ("the unlicense", "unlicense"),
}
VERBS = ("licensed", "released", "distributed", "available", "published")
TAGS = ("spdx license identifier", "license")
#: What an identifier of the GNU licenses may end with.
ENDINGS = ("only", "or later")

# Rules over the identifiers of a text, each closed by a blank; the first that matches counts. `.*` in
# a rule stands for any identifiers between. Rules for license texts come first, then those for names.
RULES = (
    ("MIT", "mit-grant (.* )?mit-notice "),
    ("BSL-1.0", "(boost-grant|boost-title) "),
    ("ISC", "isc-grant "),
    ("Apache-2.0", "apache-grant (.* )?apache-copy "),
    ("Apache-2.0", "(apache-grant|apache-title|apache-terms) "),
    ("BSD-4-Clause", "bsd-grant (.* )?bsd-advertising "),
    ("BSD-3-Clause", "bsd-grant (.* )?bsd-endorse "),
    ("BSD-2-Clause", "bsd-grant "),
    ("AGPL-3.0", "(agpl-grant|agpl-title) "),
    ("LGPL-3.0", "(lgpl-grant-3|lgpl-title-3) "),
    ("LGPL-2.1", "(lgpl-grant-2|lgpl-title-2) "),
    ("GPL-3.0", "(gpl-grant-3|gpl-title-3|gpl-preamble-3) "),
    ("GPL-2.0", "(gpl-grant-2|gpl-only-2|gpl-title-2) "),
    ("MPL-2.0", "(mpl-grant|mpl-title) "),
    ("EPL-2.0", "(epl-grant|epl-title) "),
    ("Artistic-2.0", "artistic-title "),
    ("BUSL-1.1", "(bsl-title (.* )?)?bsl-grant "),
    ("Zlib", "zlib-warranty (.* )?zlib-grant "),
    ("Unlicense", "(unlicense|unlicense-grant) "),
    ("CC0-1.0", "cc0-title "),
    ("0BSD", "0bsd-grant "),
    ("MIT-0", "mit-0-grant "),
    *((name, f"named:{name} ") for name in NAMES),
)
#: Rules share sentences: where one of the licenses before matches, it has taken those of this one.
TAKEN_BY = {"BSD-3-Clause": ("BSD-4-Clause",), "BSD-2-Clause": ("BSD-4-Clause", "BSD-3-Clause")}
KNOWN = {s: k for k, group in SENTENCES.items() for s in group}
KNOWN |= {f"{verb} under {name}": f"named:{license}" for license, names in NAMES.items() for name in names for verb in VERBS}
_SHORT = {name: license for license, names in NAMES.items() for name in names if not name.startswith(("the ", "a "))}
KNOWN |= {f"{tag} {name}": f"named:{license}" for tag in TAGS for name, license in _SHORT.items()}
KNOWN |= {f"{tag} {name} {end}": f"named:{license}" for tag in TAGS for name, license in _SHORT.items() if "gpl" in name for end in ENDINGS}
KNOWN |= {title: f"named:{license}" for license, names in NAMES.items() for name in names if "license" in name for title in (name, name.removeprefix("the ").removeprefix("a "))}

# A line break after at least WRAP characters (with blanks and comment marks) may be inside a sentence.
WRAP = 20
# What may stand around a sentence: a subject before a grant by name, and a pointer or a defined name behind any. A
# subject with one of NEGATIONS in it denies what follows.
SUBJECT = "(?:this|the)(?: [a-z0-9]+){1,4} (?:is|are) "
BEHIND = r"(?: see [^\n]*?| the license)?"
NEGATIONS = " (not|never|no|neither|nor) "

#: Steps from a text in lower case, between line feeds, to its normal form: (pattern, replacement), each of all places;
#: in a replacement `<1>` is the first group. Both Java's and RE2's regular expressions read them alike.
STEPS = (
    (rf"([^\n]{{{WRAP}}})\n", "<1>W"),
    (r"[.!?]+([ \t\r\nW])", "\n<1>"),
    (r"[^a-z0-9\nW]+", " "),
    (r"[ W]*(?:\n|W ?W)[ \nW]*", "\n"),
    (r" ?W ?", "W"),
    (r"([\nW])", "<1><1>"),
)


def cut(text: Column) -> Column:
    """The text in normal form (lower case, letters, digits, single blanks), its sentences between ends.

    A line feed is an end: one or more of a full stop, question or exclamation mark before a blank, a blank line, or a
    break after a short line. W is a break after a full line, where a sentence may end or go on. No two ends meet, and
    the first and last characters are ends. Each end is written twice, as it ends one sentence and begins another.
    """
    out = F.lower(F.concat(F.lit("\n"), F.coalesce(text, F.lit("")), F.lit(" \n")))
    for find, put in STEPS:
        out = F.regexp_replace(out, find, put.replace("<1>", "$1"))
    return out


def alternatives(sentences: list[tuple[str, ...]]) -> str:
    """Word sequences as one pattern, common beginnings once and longer ones first."""
    by: dict[str, list[tuple[str, ...]]] = {}
    for s in sentences:
        if s:
            by.setdefault(s[0], []).append(s[1:])
    parts = []
    for word, rest in sorted(by.items()):
        more = alternatives([r for r in rest if r])
        parts.append(word + (f"(?: {more})?" if more and () in rest else f" {more}" if more else ""))
    return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")" if parts else ""


def pattern() -> str:
    """A known sentence between two ends; groups: what stands before it, the sentence."""
    known = alternatives([tuple(s.split(" ")) for s in KNOWN])
    whole = f"({SUBJECT})?({known}){BEHIND}".replace(" ", "(?: |WW)")
    whole = whole.replace("at(?: |WW)http(?: |WW)", r"at(?: |WW|\n\n)https?(?: |WW)")  # a blank line stands before the URL
    return rf"[\nW]{whole}[\nW]"


#: From a sentence as it is found to the one that is known.
PLAIN = (("WW|\n\n", " "), (" at https ", " at http "))


def recognised(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, sentence_ids (array, in order) of every row.

    n_sentences counts what lies between two ends, breaks of full lines among them.
    """
    known = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), cut(F.col("text").cast("string")).alias("s"))
    found = F.regexp_extract_all("s", F.lit(pattern()), F.lit(0))
    part = lambda x, i: F.regexp_extract(x, pattern(), i)

    def plain(x: Column) -> Column:
        for find, put in PLAIN:
            x = F.regexp_replace(x, find, put)
        return x

    meant = F.filter(found, lambda x: ~plain(part(x, 1)).rlike(NEGATIONS))
    ends = F.regexp_count("s", F.lit(r"\n\n|WW"))
    return rows.select("doc_id", (ends - 1).cast("long").alias("n_sentences"), F.transform(meant, lambda x: F.element_at(known, plain(part(x, 2)))).alias("sentence_ids"))


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences, n_known, sentence_ids (joined by blanks), license, n_licenses (rules' licenses found)."""
    rows = recognised(docs).withColumn("seq", F.array_join(F.transform("sentence_ids", lambda x: F.concat(x, F.lit(" "))), ""))
    match = lambda rule: F.col("seq").rlike("(^| )" + rule)
    name = F.coalesce(*[F.when(match(rule), license) for license, rule in RULES])
    groups: dict[str, Column] = {}
    for license, rule in RULES:
        groups[license] = groups[license] | match(rule) if license in groups else match(rule)
    some = F.col("seq") != ""
    own = {license: reduce(lambda a, b: a & ~groups[b], TAKEN_BY.get(license, ()), m) | match(f"named:{license} ") for license, m in groups.items()}
    number = sum((m.cast("long") for m in own.values()), F.lit(0).cast("long"))
    return rows.select("doc_id", "n_sentences", F.size("sentence_ids").cast("long").alias("n_known"), F.btrim("seq").alias("sentence_ids"), F.when(some, name).alias("license"), F.when(some, number).otherwise(0).alias("n_licenses"))


def oracle() -> str:
    """The same in DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def text(s: str) -> str:
        return " || chr(10) || ".join(quote(p) for p in s.split("\n"))

    out = "chr(10) || coalesce(text, '') || ' ' || chr(10)"
    out = f"lower({out})"
    for find, put in STEPS:
        out = f"regexp_replace({out}, {quote(find)}, {text(put.replace('<1>', chr(92) + '1'))}, 'g')"

    def plain(x: str) -> str:
        for find, put in PLAIN:
            x = f"regexp_replace({x}, {quote(find)}, {quote(put)}, 'g')".replace("\n\n", r"\n\n")
        return x

    pairs = ", ".join(f"({quote(s)}, {quote(k)})" for s, k in KNOWN.items())
    match = lambda rule: f"regexp_matches(seq, {quote('(^| )' + rule)})"
    groups: dict[str, list[str]] = {}
    for license, rule in RULES:
        groups.setdefault(license, []).append(match(rule))
    name = " ".join(f"WHEN {match(rule)} THEN {quote(license)}" for license, rule in RULES)
    whole = {license: "(" + " OR ".join(m) + ")" for license, m in groups.items()}
    number = " + ".join("(" + " AND NOT ".join([m, *[whole[b] for b in TAKEN_BY.get(license, ())]]) + " OR " + match(f"named:{license} ") + ")::BIGINT" for license, m in whole.items())
    return rf"""
    WITH known(s, k) AS (VALUES {pairs}),
    cut AS (SELECT row_number() OVER () AS row, doc_id, {out} AS s FROM documents),
    found AS (SELECT row, u.i, u.x FROM cut, unnest(regexp_extract_all(s, {quote(pattern())})) WITH ORDINALITY AS u(x, i)),
    parts AS (SELECT row, i, {plain(f"regexp_extract(x, {quote(pattern())}, 1)")} AS subject, {plain(f"regexp_extract(x, {quote(pattern())}, 2)")} AS sentence FROM found),
    said AS (SELECT row, i, known.k FROM parts JOIN known ON known.s = sentence WHERE NOT regexp_matches(subject, {quote(NEGATIONS)})),
    ids AS (SELECT row, string_agg(k || ' ', '' ORDER BY i) AS seq, count(*) AS n FROM said GROUP BY row),
    all_rows AS (SELECT cut.doc_id, len(regexp_extract_all(s, '\n\n|WW'))::BIGINT - 1 AS n_sentences, coalesce(n, 0)::BIGINT AS n_known, coalesce(seq, '') AS seq FROM cut LEFT JOIN ids USING (row))
    SELECT doc_id, n_sentences, n_known, trim(seq) AS sentence_ids, CASE {name} END AS license, CASE WHEN seq = '' THEN 0 ELSE {number} END AS n_licenses FROM all_rows
    """
