"""Licences however their text is wrapped, and in comments."""

import re

import pytest

from cadastre.llm import license_digest

SIGNS = ["Copyright (c) 2020 A. Person", "Copyright 2019-2021 The Authors", "Copyright: Jane Doe <j@x.org>",
         "© 2020 A. Person", "(C) 2001 Some Body. All rights reserved.", "All rights reserved."]


def _wrapped_before(text):
    """The text with each line broken before a word that the statements begin with."""
    return re.sub(r" (?=copyright\b|\(c\)|all rights)", "\n", text, flags=re.I)


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "-- ", "; "])
def test_wrapped_and_commented_licences(spark, mark):
    rows, want = [], {}
    for i, (name, text) in enumerate(license_digest.TEXTS):
        lines = [SIGNS[i % len(SIGNS)], "", *_wrapped_before(text).split("\n")]
        rows.append((i, "\n".join(mark + x for x in lines)))
        want[i] = name
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["license"] for r in license_digest.scan(docs).collect()} == want


def test_common_licences_and_general_notices(spark):
    texts = license_digest.common_texts()
    assert {n for n, _ in texts} >= {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0",
                                     "CC0-1.0", "Unlicense", "ISC"}
    lines = {"This program is licensed under the GNU GPL v2 or later.": "GPL-2.0-or-later",
             "// SPDX-License-Identifier: MPL-2.0": "MPL-2.0", "Released under the terms of the ISC licence": "ISC",
             "This software is distributed under the BSD 3-Clause License.": "BSD-3-Clause",
             "Available under CC BY-SA 4.0": "CC-BY-SA-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "License: Own": "Own", "They were licensed under duress.": "", "All rights reserved. License: MIT": "MIT"}
    whole = len(texts)
    rows = [(i, text) for i, (_, text) in enumerate(texts)] + [(whole + i, x) for i, x in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_digest.scan(
        docs, licenses=[("Own-Text", "License: Own")], notices=[("Own", "License: Own")]).collect()}
    assert [got[i]["license"] for i in range(whole)] == [n for n, _ in texts]
    assert [got[whole + i]["notices"] for i in range(len(lines))] == list(lines.values())
    assert got[whole + 6]["license"] == "Own-Text"
