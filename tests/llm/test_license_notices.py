"""Every licence rule on the official words of its notice: as printed, unwrapped, and behind comment signs."""

import re
import textwrap

import pytest

from hearth.llm import license_scan

GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:"""
NOTICE = """The above copyright notice and this permission notice shall be included in all copies or substantial portions
of the Software."""
WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} {2}"""
GPL_VERSION = """This program is free software; you can redistribute it and/or modify it under the terms of the
GNU General Public License version {} as published by the Free Software Foundation."""
LATER = "either version {} of the License, or\n(at your option) any later version."
BSD = """Copyright (c) 2020, A. Writer
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
   disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
   disclaimer in the documentation and/or other materials provided with the distribution."""
ADVERT = """
3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
   This product includes software developed by the organization."""
ENDORSE = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
   products derived from this software without specific prior written permission."""
CC = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."

# rule by rule: (name, identifiers) -> official text
OFFICIAL = [
    ("MIT", f"The MIT License (MIT)\n\nCopyright (c) 2020 A. Writer\n\n{GRANT}\n\n{NOTICE}\n\n{WARRANTY}",
     ["MitTitle", "MitGrant", "MitNotice", "MitWarranty"]),
    ("MIT", f"{GRANT}\n\n{NOTICE}\n\n{WARRANTY}", ["MitGrant", "MitNotice", "MitWarranty"]),
    ("MIT", f"{GRANT}\n\n{NOTICE}", ["MitGrant", "MitNotice"]),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file.", ["MitShort"]),
    ("Apache-2.0", APACHE, ["ApacheNotice", "ApacheComply", "ApacheCopy"]),
    ("Apache-2.0", APACHE.split("\n")[0], ["ApacheNotice"]),
    ("Apache-2.0", "Foo is licensed under the Apache License, Version 2.0, as are its parts.", ["ApacheShort"]),
    ("GPL-3.0-or-later", GPL.format(":", ",", LATER.format(3)), ["GplFree", "LaterThan3"]),
    ("GPL-2.0-or-later", GPL.format(";", ";", LATER.format(2)), ["GplFree", "LaterThan2"]),
    ("GPL-2.0-or-later", GPL.format(";", ",", LATER.format(2).replace("either ", "")), ["GplFree", "LaterThan2"]),
    ("GPL-3.0-only", GPL.format(":", ",", "version 3 of the License."), ["GplFree", "Only3"]),
    ("GPL-2.0-only", GPL.format(";", ";", "version 2 of the License."), ["GplFree", "Only2"]),
    ("GPL-3.0-only", GPL_VERSION.format(3), ["Gpl3Free"]),
    ("GPL-2.0-only", GPL_VERSION.format(2), ["Gpl2Free"]),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3.", ["Gpl3Work"]),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2.", ["Gpl2Work"]),
    ("GPL-3.0-or-later", "This work is licensed under the GNU General Public License, version 3 or later.",
     ["Gpl3LaterWork"]),
    ("GPL-2.0-or-later", "This work is licensed under the GNU General Public License, version 2, or (at your "
     "option) any later version.", ["Gpl2LaterWork"]),
    ("BSD-2-Clause", BSD, ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("BSD-3-Clause", BSD + ENDORSE, ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-4-Clause", BSD + ADVERT + ENDORSE.replace("3.", "4."),
     ["BsdGrant", "BsdSource", "BsdBinary", "BsdAdvert", "BsdEndorse"]),
    ("CC-BY-4.0", CC.format(""), ["CcBy"]),
    ("CC-BY-SA-4.0", CC.format("-ShareAlike"), ["CcBySa"]),
    ("CC-BY-NC-4.0", CC.format("-NonCommercial"), ["CcByNc"]),
    ("CC-BY-ND-4.0", CC.format("-NoDerivatives"), ["CcByNd"]),
    ("CC-BY-NC-SA-4.0", CC.format("-NonCommercial-ShareAlike"), ["CcByNcSa"]),
    ("CC-BY-NC-ND-4.0", CC.format("-NonCommercial-NoDerivatives"), ["CcByNcNd"]),
    ("CC0-1.0", "To the extent possible under law, A. Writer has waived all copyright and related or neighboring "
     "rights to this work.", ["Cc0"]),
]


def unwrapped(text):
    return "\n\n".join(" ".join(p.split()) for p in text.split("\n\n"))


def wrapped(text):
    return "\n\n".join(textwrap.fill(p, 38) for p in unwrapped(text).split("\n\n"))


def behind(sign, text):
    return re.sub("(?m)^", sign, wrapped(text))


FORMS = [lambda t: t, unwrapped, wrapped, lambda t: behind(" * ", t), lambda t: behind("# ", t),
         lambda t: behind("// ", t), lambda t: wrapped(t).replace("\n", "\r\n"),
         lambda t: f"#!/bin/sh\nsome words before\n{t}\nand words after."]


def test_every_rule_on_its_official_text(spark):
    cases = [(k, f, name, ids) for k, (name, _, ids) in enumerate(OFFICIAL) for f in range(len(FORMS))]
    rows = [(100 * k + f, FORMS[f](OFFICIAL[k][1])) for k, f, _, _ in cases]
    found = {r["doc_id"]: r for r in license_scan.scan_licenses(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, f, name, ids in cases:
        r = found[100 * k + f]
        assert (r["licenses"], [i for i in r["sentence_ids"] if i != "AllRights"]) == ([name], ids), (name, f)
        assert set(r["unmatched"]) <= {"AllRights"}


def test_every_rule_has_an_official_text():
    tested = {(name, *ids) for name, _, ids in OFFICIAL}
    assert {(name, *ids) for name, ids in license_scan.NOTICE_RULES + license_scan.RULES} <= tested


@pytest.mark.parametrize("text", [
    "Released under the MIT Licenses.", "Licensed under the MIT. License", "Licensed under the\n\nMIT License? no",
    "unlicensed under CC BY 4.0", "Licensed under CC BY 4.01"])
def test_parts_of_words_and_sentences_do_not_match(spark, text):
    row = license_scan.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["licenses"] == []
