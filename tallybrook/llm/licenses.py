"""License scans by sentence rules.

Texts are cut into sentences, a normalised sentence is looked up in a table of known
licence sentences, and the sequence of identifiers of a text is matched against ordered
rules: a licence is recognised where all sentences of its rule follow each other among the
known sentences of the text. A sentence may run over several lines of its paragraph. Only
DataFrame functions run, one row at a time.
"""

import re

from pyspark.sql import functions as F

# Known licence sentences, normalised (lower case, words of letters and
# digits, one space between), with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache-short",
    "released under the mit license": "mit-short",
    "this work is licensed under the gnu general public license version 3": "gpl3-short",
    "licensed under cc by nc 4 0": "cc-by-nc-short",
    "permission is hereby granted free of charge to any person obtaining a copy of this"
    " software and associated documentation files the software to deal in the software"
    " without restriction": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind": "as-is",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "redistributions of source code must retain the above copyright notice this list of"
    " conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of"
    " conditions and the following disclaimer": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to"
    " endorse or promote products derived from this software without specific prior written"
    " permission": "bsd-name",
}

# Licence and its ordered sentence identifiers; the first rules are the longest.
RULES = (
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-name")),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-short", "apache-comply")),
    ("Apache-2.0", ("apache-short",)),
    ("MIT", ("mit-short",)),
    ("GPL-3.0", ("gpl3-short",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-short",)),
)

# The sentences of whole licence texts with their usual variants. Two identifiers
# stand for a sentence that holds two. LICENSE_SQL knows the short list above only.
FULL_SENTENCES = {
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files the software to deal in the software without restriction"
        " including without limitation the rights to use copy modify merge publish distribute"
        " sublicense and or sell copies of the software and to permit persons to whom the software is"
        " furnished to do so subject to the following conditions",
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice including the next paragraph shall be"
        " included in all copies or substantial portions of the software",
    ),
    "as-is": tuple(
        "the software is provided as is without warranty of any kind express or implied including but"
        f" not limited to the warranties of merchantability fitness for a particular purpose {x}"
        for x in (
            "and noninfringement",
            "and non infringement",
            "or noninfringement",
            "title and non infringement",
        )
    ),
    "apache-short": (
        "licensed under the apache license version 2 0 the license",
        "this file is licensed under the apache license version 2 0 the license",
        "the asf licenses this file to you under the apache license version 2 0 the license",
        "apache license version 2 0 january 2004",
        "apache license version 2 0 january 2004 http www apache org licenses",
        "apache license version 2 0 january 2004 https www apache org licenses",
    ),
    "apache-comply": (
        "you may not use this file except in compliance with the license you may obtain a copy of the"
        " license at",
        "you may not use this work except in compliance with the license",
    ),
    "apache-copy": tuple(
        f"you may obtain a copy of the license at {x} www apache org licenses license 2 0{y}"
        for x in ("http", "https")
        for y in ("", " html", " txt")
    ),
    "apache-as-is": (
        "unless required by applicable law or agreed to in writing software distributed under the"
        " license is distributed on an as is basis without warranties or conditions of any kind either"
        " express or implied",
    ),
    "bsd-intro": (
        "redistribution and use in source and binary forms with or without modification are permitted"
        " provided that the following conditions are met",
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions"
        " and the following disclaimer and",
    ),
    "bsd-binary": tuple(
        "redistributions in binary form must reproduce the above copyright notice this list of conditions"
        f" and the following disclaimer in the documentation and or other materials provided with {x}"
        for x in ("the distribution", "the distribution and")
    ),
    "bsd-name": (
        # the end of a sentence cut behind the "Inc." of a name
        "nor the names of its contributors may be used to endorse or promote products derived from this"
        " software without specific prior written permission",
        "the name of the author may not be used to endorse or promote products derived from this"
        " software without specific prior written permission",
    ),
    "bsd-as-is": (
        "this software is provided by the copyright holders and contributors as is and any express or"
        " implied warranties including but not limited to the implied warranties of merchantability and"
        " fitness for a particular purpose are disclaimed",
    ),
    "isc-grant": tuple(
        f"permission to use copy modify and {x}distribute this software for any purpose with or without"
        " fee is hereby granted provided that the above copyright notice and this permission notice"
        " appear in all copies"
        for x in ("", "or ")
    ),
    "0bsd-grant": (
        "permission to use copy modify and or distribute this software for any purpose with or without"
        " fee is hereby granted",
    ),
    "mpl-terms": ("this source code form is subject to the terms of the mozilla public license v",),
    "mpl-copy": tuple(
        "if a copy of the mpl was not distributed with this file you can obtain one at"
        f" {x} mozilla org mpl 2 0"
        for x in ("http", "https")
    ),
    "mpl2-title": ("mozilla public license version 2 0",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "zlib-as-is": ("this software is provided as is without any express or implied warranty",),
    "zlib-grant": (
        "permission is granted to anyone to use this software for any purpose including commercial"
        " applications and to alter it and redistribute it freely subject to the following restrictions",
    ),
}
# Identifier, licence and its name in the GNU texts; version, and date of its text.
GNU = (
    ("gpl", "GPL", "general public license"),
    ("lgpl", "LGPL", "lesser general public license"),
    ("agpl", "AGPL", "affero general public license"),
)
GNU_VERSIONS = (
    ("2", "2.0", {"gpl": "june 1991"}),
    ("2 1", "2.1", {"lgpl": "february 1999"}),
    ("3", "3.0", {"gpl": "29 june 2007", "lgpl": "29 june 2007", "agpl": "19 november 2007"}),
)
# Names of Creative Commons licences and their signs.
CC = {
    "attribution": "BY",
    "attribution sharealike": "BY-SA",
    "attribution noderivatives": "BY-ND",
    "attribution noncommercial": "BY-NC",
    "attribution noncommercial sharealike": "BY-NC-SA",
    "attribution noncommercial noderivatives": "BY-NC-ND",
}


def _all():
    """All known sentences with their identifiers, and all rules, longest first."""
    known = {s: i for i, texts in FULL_SENTENCES.items() for s in texts}
    grant, notice = FULL_SENTENCES["mit-grant"][0], next(s for s, i in SENTENCES.items() if i == "mit-notice")
    known[f"{grant} {notice}"] = "mit-grant mit-notice"
    comply = FULL_SENTENCES["apache-comply"][0]
    known[comply] = "apache-comply apache-copy"
    rules = [
        ("ISC", ("isc-grant",)),
        ("0BSD", ("0bsd-grant",)),
        ("MPL-2.0", ("mpl-terms", "mpl-copy")),
        ("MPL-2.0", ("mpl2-title",)),
        ("Unlicense", ("unlicense",)),
        ("Zlib", ("zlib-as-is", "zlib-grant")),
    ]
    for sign, short, name in GNU:
        terms = (
            f"you can redistribute it and or modify it under the terms of the gnu {name} as published by"
            " the free software foundation"
        )
        known[terms] = known[f"this program is free software {terms}"] = f"{sign}-terms"
        for number, version, dates in GNU_VERSIONS:
            for way, end in (("or-later", " or at your option any later version"), ("only", "")):
                either = f"either version {number} of the license{end}" if end else f"version {number} of the license"
                known[either] = f"gnu-{version}-{way}"
                one = f"{sign}-{version}-{way}"
                known[f"{terms} {either}"] = known[f"this program is free software {terms} {either}"] = one
                rules.append((f"{short}-{version}-{way}", (one,)))
                rules.append((f"{short}-{version}-{way}", (f"{sign}-terms", f"gnu-{version}-{way}")))
            if sign in dates:
                known[f"gnu {name} version {number} {dates[sign]}"] = f"{sign}-{version}-title"
                rules.append((f"{short}-{version}", (f"{sign}-{version}-title",)))
    for name, sign in CC.items():
        for number, version, kind in (("4 0", "4.0", "international"), ("3 0", "3.0", "unported")):
            one = f"cc-{sign.lower()}-{version}"
            for a in ("a creative commons", "the creative commons"):
                known[f"this work is licensed under {a} {name} {number} {kind} license"] = one
            known[f"creative commons {name} {number} {kind} public license"] = one
            rules.append((f"CC-{sign}-{version}", (one,)))
    rules = [*RULES, *rules]
    return known | SENTENCES, tuple(sorted(rules, key=lambda r: -len(r[1])))


ALL_SENTENCES, ALL_RULES = _all()
# A sentence ends at . ! ? ; before white space or the end, and at a line without letters and
# digits, which ends its paragraph. Line ends inside a paragraph do not end it, but a line that
# is a known sentence by itself counts.
END = r"\n[^\p{L}\p{N}\n]*\n|[.!?;](?=[\x20\x09-\x0D]|$)"
# The places of a known sentence that hold a name.
BSD_HOLDER = r"^neither the names? of .+ nor the names of (?:its|their|the|any) contributors"
GNU_HOLDER = r"^.* is free software "
LIST_MARK = r"^[^\p{L}\p{N}]*\(?[0-9a-z]{1,2}\)(?=[^\p{L}\p{N}]*(?:redistributions|neither|the name) )"


def normalised(sentence):
    bare = F.regexp_replace(F.lower(sentence), LIST_MARK, "")
    bare = F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))
    bare = F.regexp_replace(
        bare, BSD_HOLDER, "neither the name of the copyright holder nor the names of its contributors"
    )
    return F.regexp_replace(bare, GNU_HOLDER, "this program is free software ")


def scan_licenses(docs, row_id="doc_id", text="text", sentences=ALL_SENTENCES, rules=ALL_RULES):
    """One row per row of `docs`: `row_id`, `n_sentences` known sentences, their identifiers in
    order (`sequence`, joined by a space) and the licences recognised (`licenses`, distinct,
    in code-point order, joined by a comma; empty if none).

    The whole text is scanned; null and empty texts have no sentences. Only sentences that
    hold a known one count. A longer rule hides the shorter rules it contains: where it
    matches, its identifiers are taken out before shorter rules are tried. Repeated rows
    get equal results; other columns are ignored. `sentences` and `rules` are lists given
    by the caller and do not follow the data.
    """
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    gap = r"[^\p{L}\p{N}]+"
    begins = "|".join(sorted({gap.join(map(re.escape, s.split(" ")[:2])) for s in sentences}))
    # only sentences that begin like a known one, or hold a name, are normalised and looked up
    likely = (
        rf"(?im)^[^\p{{L}}\p{{N}}\n]*(?:\(?[0-9a-z]{{1,2}}\)[^\p{{L}}\p{{N}}\n]*)?(?:{begins}|neither{gap}the)"
        rf"|is{gap}free{gap}software"
    )

    def looked_up(s):
        return F.when(s.rlike(likely), F.split(F.try_element_at(known, normalised(s)), " "))

    def by_line(s):
        return F.flatten(F.array_compact(F.transform(F.split(s, "\n"), looked_up)))

    parts = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), END), lambda s: s.rlike(likely))
    ids = F.flatten(F.transform(parts, lambda s: F.coalesce(looked_up(s), by_line(s))))
    d = docs.select(row_id, ids.alias("__ids"))
    d = d.withColumn("sequence", F.array_join("__ids", " "))
    left = F.concat(F.lit(" "), F.array_join("__ids", "  "), F.lit(" "))
    steps = [F.struct(F.lit(name).alias("name"), F.lit(f" {'  '.join(r)} ").alias("wanted")) for name, r in rules]
    tried = F.aggregate(
        F.array(*steps),
        F.struct(left.alias("left"), F.array().cast("array<string>").alias("found")),
        lambda s, r: F.when(
            F.contains(s["left"], r["wanted"]),
            F.struct(
                F.replace(s["left"], r["wanted"], F.lit(" | ")).alias("left"),
                F.array_append(s["found"], r["name"]).alias("found"),
            ),
        ).otherwise(s),
        lambda s: s["found"],
    )
    # most texts hold no known sentence
    names = F.when(F.size("__ids") > 0, F.array_sort(F.array_distinct(tried)))
    return d.select(
        row_id,
        F.size("__ids").cast("bigint").alias("n_sentences"),
        "sequence",
        F.coalesce(F.array_join(names, ","), F.lit("")).alias("licenses"),
    )


def _sql():
    listed = ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items())
    steps, names = [], []
    before = "SELECT *, ' ' || array_to_string(ids, '  ') || ' ' AS l0 FROM known"
    for i, (name, ids) in enumerate(RULES):
        wanted = " " + "  ".join(ids) + " "
        steps.append(
            f"r{i} AS (SELECT *, CASE WHEN instr(l{i}, '{wanted}') > 0 THEN '{name}' END AS f{i}, "
            f"replace(l{i}, '{wanted}', ' | ') AS l{i + 1} FROM {f'r{i - 1}' if i else 'start'})"
        )
        names.append(f"f{i}")
    return rf"""
WITH cut AS (
  SELECT doc_id, regexp_split_to_array(
    regexp_replace(coalesce(text, ''), '[.!?;]([\x20\x09-\x0D]|$)', chr(10) || '\1', 'g'), '\n') AS parts
  FROM documents
), known AS (
  SELECT doc_id, list_filter(list_transform(parts, lambda s: MAP {{{listed}}}[
    trim(regexp_replace(lower(s), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))]), lambda x: x IS NOT NULL) AS ids FROM cut
), start AS ({before}), {", ".join(steps)}
SELECT doc_id, len(ids)::BIGINT AS n_sentences, array_to_string(ids, ' ') AS sequence,
       coalesce(array_to_string(list_sort(list_distinct(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL))), ','), '') AS licenses
FROM r{len(RULES) - 1}
"""


LICENSE_SQL = _sql()
