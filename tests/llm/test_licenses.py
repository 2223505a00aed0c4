import re

import pytest

from lendlens.llm.licenses import TEMPLATES, Scanner, license_scan, op2_license_scan

from . import cases
from ..conftest import SF_CHECK

LINES = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
         "Apache-2.0": "Licensed under the Apache License, Version 2.0", "MIT": "Released under the MIT License", "all-rights-reserved": "All rights reserved"}


@pytest.mark.parametrize("name,text", TEMPLATES)
def test_every_template_is_found_in_a_text(name, text):
    found = Scanner().scan(f"Before it. {text}\nAfter it")
    assert [f[0] for f in found] == [name] and found[0][1] == 11 and not found[0][4]


def test_wording_differences():
    mit = TEMPLATES[2][1]
    changed = mit.replace("free of charge", "without charge").replace("substantial", "major")
    (name, *_, differ), = Scanner().scan(changed)
    assert name == "MIT" and "substantial>major" in differ
    assert not Scanner().scan("Licensed under CC BY-XX 4.0.") and not Scanner().scan("a driving license and rights")


def test_query_against_literal_search(spark):
    texts = {r["doc_id"]: r["text"] for r in cases.documents(spark, SF_CHECK).collect()}
    rows = op2_license_scan(spark, SF_CHECK).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = sorted((m.start(), m.end(), k) for k, v in LINES.items() for m in re.finditer(re.escape(v), texts[r["doc_id"]] or ""))
        assert r["licenses"] == ",".join(f"{k}:{a}:{b}" for a, b, k in spans) and r["n_licenses"] == len(spans)


def test_awkward_rows(spark):
    df = cases.clashing(cases.awkward(spark), "licenses", "found")
    rows = license_scan(df).collect()
    assert len(rows) == df.count() and all(r["licenses"] == "own licenses" and not r["licenses_"] for r in rows)
    assert license_scan(cases.empty(spark)).count() == 0


GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free " \
      "Software Foundation, either version {} of the License, or (at your option) any later version. This program is distributed in the hope"


@pytest.mark.parametrize("family,version,names", [
    ("General Public License", "3", ["GPL-3.0-or-later"]), ("Affero General Public License", "3", ["AGPL-3.0-or-later"]),
    ("Lesser General Public License", "3", ["LGPL-3.0-or-later"]), ("Lesser General Public License", "2.1", ["LGPL-2.1-or-later"]),
    ("Affero General Public License", "4", []), ("General Public License", "4", [])])
def test_family_and_version_decide(family, version, names):
    found = Scanner().scan(GPL.format(family, version))
    assert [f[0] for f in found] == names


def test_whole_texts_are_one_license():
    text = {name: t for name, t in TEMPLATES}  # the last of a name is its whole text
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"):
        (found, start, end, *_), = Scanner().scan(f"Copyright 2020 Someone. {text[name]} import os")
        assert found == name and text[name].rstrip(".").endswith(f"Copyright 2020 Someone. {text[name]}"[end - 20 : end])
    bulleted = text["BSD-3-Clause"].replace("1.", "*").replace("2.", "*").replace("3.", "*").replace("copyright holder nor", "Foo Inc nor")
    assert [f[0] for f in Scanner().scan(bulleted)] == ["BSD-3-Clause"]


def test_added_words_decide_and_move_the_end():
    gpl = GPL.format("General Public License", "3").replace("free software:", "truly free software, friends:")
    (name, _, end, *_), = Scanner().scan(gpl)
    assert name == "GPL-3.0-or-later" and gpl[:end].endswith("any later version")
    assert not Scanner().scan(TEMPLATES[2][1].replace("without restriction", "not without restriction"))
