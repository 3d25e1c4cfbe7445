"""Licence statements by sentence rules (built-in functions only).

A text is cut into sentences (a sentence may go on over line ends, a blank line
ends it); each is normalised (A-Z lowered, everything but letters and digits as
one space, so comment signs vanish) and searched for known licence sentences,
which may stand inside a longer one; of two that overlap the first counts, of
two that begin together the longer.  What is left of a text is the short
sequence of identifiers it holds, in order.  Ordered rules then name licences: a rule matches where its identifiers
follow each other, and takes them out of the sequence, so a longer rule goes
before the shorter ones it contains.  Identifiers that no rule took are given
as they are: a known sentence without its licence.

Everything happens inside a row: no shuffle, and neither the sentence table
nor the rules depend on the data.

Defined cases: a null or empty text has no sentences and no licences; a
licence named twice is given once; repeated rows give equal results; an empty
table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.frames import apart

# Normalised sentences of public licence notices (the SQL
# formulation reads these too).
SENTENCES = {
    "licensed under the apache license version 2 0": "ApacheShort",
    "licensed under the apache license version 2 0 the license": "ApacheNotice",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at": "ApacheCopy",
    "released under the mit license": "MitShort",
    "licensed under the mit license": "MitShort",
    "the mit license": "MitTitle",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind": "MitWarranty",
    "this work is licensed under the gnu general public license version 3": "Gpl3Work",
    "this work is licensed under the gnu general public license version 2": "Gpl2Work",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu "
    "general public license as published by the free software foundation": "GplFree",
    "either version 3 of the license or at your option any later version": "LaterThan3",
    "either version 2 of the license or at your option any later version": "LaterThan2",
    "version 3 of the license": "Only3",
    "version 2 of the license": "Only2",
    "licensed under cc by 4 0": "CcBy",
    "licensed under cc by sa 4 0": "CcBySa",
    "licensed under cc by nc 4 0": "CcByNc",
    "licensed under cc by nd 4 0": "CcByNd",
    "licensed under cc by nc sa 4 0": "CcByNcSa",
    "licensed under cc by nc nd 4 0": "CcByNcNd",
    "released under cc0 1 0": "Cc0",
    "this work is licensed under a creative commons attribution 4 0 international license": "CcBy",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and "
    "the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the "
    "distribution": "BsdBinary",
    "all rights reserved": "AllRights",
}
# Identifier sequences in the order in which they are tried.
RULES = [
    ("GPL-3.0-or-later", ["GplFree", "LaterThan3"]),
    ("GPL-2.0-or-later", ["GplFree", "LaterThan2"]),
    ("GPL-3.0-only", ["GplFree", "Only3"]),
    ("GPL-2.0-only", ["GplFree", "Only2"]),
    ("GPL-3.0-only", ["Gpl3Work"]),
    ("GPL-2.0-only", ["Gpl2Work"]),
    ("Apache-2.0", ["ApacheNotice", "ApacheComply", "ApacheCopy"]),
    ("Apache-2.0", ["ApacheNotice"]),
    ("Apache-2.0", ["ApacheShort"]),
    ("MIT", ["MitTitle", "MitGrant", "MitNotice", "MitWarranty"]),
    ("MIT", ["MitGrant", "MitNotice", "MitWarranty"]),
    ("MIT", ["MitGrant", "MitNotice"]),
    ("MIT", ["MitShort"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("CC-BY-4.0", ["CcBy"]),
    ("CC-BY-SA-4.0", ["CcBySa"]),
    ("CC-BY-NC-4.0", ["CcByNc"]),
    ("CC-BY-ND-4.0", ["CcByNd"]),
    ("CC-BY-NC-SA-4.0", ["CcByNcSa"]),
    ("CC-BY-NC-ND-4.0", ["CcByNcNd"]),
    ("CC0-1.0", ["Cc0"]),
]
GPL_WORK = "this work is licensed under the gnu general public license version"
GPL_TERMS = ("this program is free software you can redistribute it and or modify it under the terms of the "
             "gnu general public license")
LATER = ("or at your option any later version", "or any later version", "or later")
CC_KINDS = {"sharealike": "CcBySa", "noncommercial": "CcByNc", "noderivatives": "CcByNd",
            "noncommercial sharealike": "CcByNcSa", "noncommercial noderivatives": "CcByNcNd"}
# What else the full notices say, and the forms that change a licence.
NOTICES = {
    "mit license": "MitTitle",
    **{f"{GPL_WORK} {v} {later}": f"Gpl{v}LaterWork" for v in (2, 3) for later in LATER},
    **{f"{either}version {v} of the license {later}": f"LaterThan{v}"
       for v in (2, 3) for later in LATER for either in ("", "either ")},
    **{f"{GPL_TERMS} version {v} as published by the free software foundation": f"Gpl{v}Free" for v in (2, 3)},
    **{f"this work is licensed under a creative commons attribution {kind} 4 0 international license": name
       for kind, name in CC_KINDS.items()},
    "has waived all copyright and related or neighboring rights to": "Cc0",
    "all advertising materials mentioning features or use of this software must display the following "
    "acknowledgement": "BsdAdvert",
    "may be used to endorse or promote products derived from this software without specific prior written "
    "permission": "BsdEndorse",
}
# Tried before the rules above, as these contain some of them.
NOTICE_RULES = [
    ("GPL-3.0-or-later", ["Gpl3LaterWork"]),
    ("GPL-2.0-or-later", ["Gpl2LaterWork"]),
    ("GPL-3.0-only", ["Gpl3Free"]),
    ("GPL-2.0-only", ["Gpl2Free"]),
    ("BSD-4-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdAdvert", "BsdEndorse"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
]
# The other GNU licences; their notices differ in a word and a version.
GNU = {"Lgpl": "lesser", "LibGpl": "library", "Agpl": "affero"}
GNU_TERMS = "is free software you can redistribute it and or modify it under the terms of the gnu {} general public license"
FAMILIES = {
    **{f"this {what} {GNU_TERMS.format(kind)} as published by the free software foundation": f"{name}Free"
       for name, kind in GNU.items() for what in ("program", "library", "file", "software")},
    **{f"this {what} {GNU_TERMS.format('').replace('  ', ' ')} as published by the free software foundation": "GplFree"
       for what in ("library", "file", "software")},
    **{f"{either}version 2 1 of the license {later}": "LaterThan21" for later in LATER for either in ("", "either ")},
    "version 2 1 of the license": "Only21",
    # "v. 2.0" ends the sentence before its number; older versions have another notice
    "this source code form is subject to the terms of the mozilla public license": "Mpl2",
    **{f"permission to use copy modify {word} distribute this software for any purpose with or without fee is "
       f"hereby granted{terms}": name for word in ("and or", "and")
       for terms, name in (("", "ZeroBsdGrant"), (" provided that the above copyright notice and this permission "
                                                  "notice appear in all copies", "IscGrant"))},
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to "
    "alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "boost software license version 1 0": "Boost1",
    **{f"eclipse public license {v}{n} 0": f"Epl{n}" for v in ("", "v", "v ", "version ") for n in (1, 2)},
}
# Names of licences as SPDX lists them, for lines "SPDX-License-Identifier: name".
SPDX = ("0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause "
        "BSD-4-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 "
        "CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CECILL-2.1 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3-only "
        "GFDL-1.3-or-later GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only "
        "LGPL-2.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 "
        "MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA OFL-1.1 OSL-3.0 PostgreSQL Python-2.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 "
        "Zlib ZPL-2.1").split()
# Names that SPDX has given up for the "-only" and "-or-later" ones.
SPDX_OLD = {f"{name}{plus}": f"{name}-{'or-later' if plus else 'only'}" for plus in ("", "+") for name in
            ("AGPL-3.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0")}


def spdx_sentence(name: str) -> str:
    return "spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower()).strip()


# "GPL-2.0" and "GPL-2.0+" are one sentence; the sign is kept apart by ``sentences``
SPDX_LINES = {spdx_sentence(n): f"Spdx {n}" for n in SPDX} | {
    spdx_sentence(old) + (" plussign" if old.endswith("+") else ""): f"Spdx {new}" for old, new in SPDX_OLD.items()}
# Creative Commons before 4.0: version, and the word that ends its name.
CC_OLD = {"3.0": "unported", "2.5": "generic", "2.0": "generic", "1.0": "generic"}
CC_SHORT = {"": "BY", **{k: "BY-" + v for k, v in {
    "sharealike": "SA", "noncommercial": "NC", "noderivatives": "ND", "noncommercial sharealike": "NC-SA",
    "noncommercial noderivatives": "NC-ND"}.items()}}
CC_LINES = {}
for _kind, _short in CC_SHORT.items():
    for _version, _word in CC_OLD.items():
        _name, _v = f"Cc {_short} {_version}", _version.replace(".", " ")
        CC_LINES[f"licensed under cc {_short.lower().replace('-', ' ')} {_v}"] = _name
        for _end in (_word, "international"):
            CC_LINES[re.sub(" +", " ", f"this work is licensed under a creative commons attribution {_kind} {_v} "
                            f"{_end} license")] = _name
# Sequences of the families, tried before the rules above.
FAMILY_RULES = [
    *[(f"{name}-{version}-{end}", [f"{free}Free", f"{words}{v}"])
      for end, words in (("or-later", "LaterThan"), ("only", "Only"))
      for name, free, version, v in (("LGPL", "Lgpl", "3.0", "3"), ("LGPL", "Lgpl", "2.1", "21"),
                                     ("LGPL", "LibGpl", "2.0", "2"), ("AGPL", "Agpl", "3.0", "3"))],
    ("MPL-2.0", ["Mpl2"]), ("ISC", ["IscGrant"]), ("0BSD", ["ZeroBsdGrant"]), ("Unlicense", ["Unlicense"]),
    ("Zlib", ["ZlibGrant"]), ("BSL-1.0", ["Boost1"]), ("EPL-2.0", ["Epl2"]), ("EPL-1.0", ["Epl1"]),
    *[(name, [f"Spdx {name}"]) for name in SPDX],
    *[(f"CC-{short}-{version}", [f"Cc {short} {version}"]) for short in CC_SHORT.values() for version in CC_OLD],
]
#: . ! or ? before white space, or a line without letters and digits
SENTENCE_END = "[.!?][\\x20\\x09-\\x0D]|\\n[^a-z0-9\\n]*+\\n"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sentences(text: Column) -> Column:
    """The normalised sentences as one text, a Z (no other capital is left) between them."""
    small = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    # the one sign that tells two licence names apart
    signed = F.regexp_replace(small, "(spdx-license-identifier:[\\x20\\x09]*(?:[al]?gpl)-[0-9.]+)\\+", "$1 plussign ")
    lined = F.regexp_replace(signed, SENTENCE_END, " Z ")
    return F.regexp_replace(F.concat(F.lit(" "), lined, F.lit(" ")), "[^a-z0-9Z]+", " ")


def pattern(known: dict[str, str]) -> str:
    """Any known sentence as whole words, by first word, the longest of each first."""
    by_first: dict[str, list[str]] = {}
    for s in sorted(known, key=len, reverse=True):
        first = s.split(" ", 1)[0]
        by_first.setdefault(first, []).append(re.escape(s[len(first):]))
    return " (" + "|".join(f"{re.escape(w)}(?:{'|'.join(rest)})" for w, rest in by_first.items()) + ")(?= )"


def identifiers(text: Column, known: dict[str, str]) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    hits = F.regexp_extract_all(sentences(text), F.lit(pattern(known)), F.lit(1))
    return F.transform(hits, lambda s: F.element_at(table, s))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  known: dict[str, str] | None = None,
                  rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Per row: identifier, ``sentence_ids`` (array of the known sentences' names, in
    order), ``licenses`` (array of names, in the rules' order) and ``unmatched``
    (the sentence names that no rule took)."""
    known = known or SENTENCES | NOTICES | FAMILIES | SPDX_LINES | CC_LINES
    rules = rules or NOTICE_RULES + FAMILY_RULES + RULES
    marked = apart(docs, id_col, text_col)[0].select(
        id_col, identifiers(F.col(text_col), known).alias("sentence_ids"))

    def tokens(names: list[str]) -> str:
        return "".join(f"<{n}>" for n in names)

    # (sequence left, licences found): each rule takes its identifiers out
    start = F.struct(F.concat(F.lit("<"), F.array_join("sentence_ids", "><"), F.lit(">")).alias("left"),
                     F.array().cast("array<string>").alias("found"))

    def apply(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["ids"])
        return F.when(hit, F.struct(
            F.replace(state["left"], rule["ids"], F.lit("")).alias("left"),
            F.array_append(state["found"], rule["name"]).alias("found"))).otherwise(state)

    listed = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(tokens(ids)).alias("ids"))
                       for name, ids in rules])
    ended = marked.withColumn("_end", F.when(
        F.size("sentence_ids") > 0, F.aggregate(listed, start, apply)))
    left = F.regexp_extract_all(F.col("_end.left"), F.lit("<([^>]+)>"), F.lit(1))
    none = F.array().cast("array<string>")
    return ended.select(id_col, "sentence_ids",
                        F.coalesce(F.array_distinct("_end.found"), none).alias("licenses"),
                        F.coalesce(left, none).alias("unmatched"))
