"""Licence families on their official words, SPDX lines, and the SQL's own tables against the code."""

import duckdb
import pytest

from hearth.llm import license_scan, queries
from tests.llm.test_license_notices import FORMS, OFFICIAL

GNU = """This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} General Public
License as published by the Free Software Foundation; {}"""
LATER = "either version {} of the License, or (at your option) any later version."
ONLY = "version {} of the License."
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted"""
CC = "This work is licensed under a Creative Commons Attribution{} {} {} License."
CASES = [
    *[(f"{name}-{shown}-{end}", GNU.format(what, kind, form.format(version)))
      for end, form in (("or-later", LATER), ("only", ONLY))
      for name, shown, what, kind, version in (
          ("LGPL", "3.0", "library", "Lesser", "3"), ("LGPL", "2.1", "library", "Lesser", "2.1"),
          ("LGPL", "2.0", "library", "Library", "2"), ("AGPL", "3.0", "program", "Affero", "3"),
          ("LGPL", "3.0", "program", "Lesser", "3"))],
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the "
     "MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("ISC", ISC + ", provided that the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", ISC + "."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose,\nincluding commercial applications, "
     "and to alter it and redistribute it\nfreely, subject to the following restrictions:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0. (See accompanying file)"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
     "License 2.0 which is available at"),
    ("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0 which accompanies this"),
    ("CC-BY-3.0", CC.format("", "3.0", "Unported")), ("CC-BY-SA-3.0", CC.format("-ShareAlike", "3.0", "Unported")),
    ("CC-BY-NC-ND-2.5", CC.format("-NonCommercial-NoDerivatives", "2.5", "Generic")),
    ("CC-BY-SA-2.0", "Text licensed under CC BY-SA 2.0, pictures not."),
]
SPDX_CASES = [(n, f"// SPDX-License-Identifier: {n}\nint x;") for n in license_scan.SPDX] + [
    ("GPL-2.0-only", "/* SPDX-License-Identifier: GPL-2.0 */"), ("GPL-2.0-or-later", "# SPDX-License-Identifier: GPL-2.0+"),
    ("LGPL-2.1-or-later", "SPDX-License-Identifier: LGPL-2.1+\nmore"), ("AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0")]


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in license_scan.scan_licenses(df).collect()}


def test_every_family_on_its_official_text(spark):
    cases = [(name, form(text)) for name, text in CASES for form in FORMS]
    found = scan(spark, [t for _, t in cases])
    for k, (name, text) in enumerate(cases):
        assert (found[k]["licenses"], found[k]["unmatched"]) == ([name], []), text


def test_spdx_lines(spark):
    found = scan(spark, [t for _, t in SPDX_CASES])
    assert [found[k]["licenses"] for k in range(len(SPDX_CASES))] == [[n] for n, _ in SPDX_CASES]


def test_every_family_rule_is_tested():
    tested = {n for n, _ in CASES} | {n for n, _ in SPDX_CASES}
    assert {n for n, ids in license_scan.FAMILY_RULES if not ids[0].startswith("Cc ")} <= tested


@pytest.mark.parametrize("more", ["", " The MIT License.", "\nlicensed under CC BY 4.0"])
def test_the_sql_agrees_on_every_text(spark, more):
    texts = [form(text) + more for _, text, *_ in [*OFFICIAL, *CASES] for form in FORMS] + [t for _, t in SPDX_CASES]
    texts += [None, "", "...", "\n\n", "MIT License\n\nMIT License. The MIT License", "All rights reserved! all rights reserved",
              "\n\n\n".join(t for _, t, *_ in OFFICIAL), " ".join(t for _, t in CASES)]
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    expected = {r[0]: r[1:] for r in con.execute(queries.ORACLE_SQL["op1_license_scan"]).fetchall()}
    for k, r in scan(spark, texts).items():
        assert tuple(",".join(r[c]) for c in ("sentence_ids", "licenses", "unmatched")) == expected[k], texts[k]
