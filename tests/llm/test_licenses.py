from callcredit.llm import licenses
from llm_helpers import docs_of, rng, words  # noqa: F401


def test_scan(spark, docs_of, rng):
    known = licenses.known_table(spark)
    rows = [(1, "released under the mit licence"), (2, "Copyright (c) 2020 Someone\n\n  Released -- under the MIT License!\n"),
            (3, words(rng, 50) + "\nLicensed under the Apache License, Version 2.0.\nmore"), (4, None), (5, ""), (6, "© 2020\nAll rights reserved."),
            (7, "Released under the MIT License. And more"), (8, words(rng, 20000)), (1, "released under the mit licence"), (None, "MIT")]
    got = [(r.doc_id, r.license, r.line_licenses, r.digest is None) for r in licenses.scan(docs_of(rows), known).collect()]
    want = [(1, "MIT", "MIT", False), (1, "MIT", "MIT", False), (2, "MIT", "MIT", False), (3, None, "Apache-2.0", False), (4, None, "", True),
            (5, None, "", True), (6, None, "", True), (7, None, "", False), (8, None, "", False), (None, None, "", False)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.scan(docs_of([]), known).count() == 0


def test_copyright_lines_inside_sentences_stay(spark, docs_of):
    mine = spark.createDataFrame([("X", "The above copyright notice shall be kept by every organisation."), ("Y", "")], "license string, text string")
    got = licenses.scan(docs_of([(1, "the above COPYRIGHT notice shall be kept by every organization"), (2, "")]), mine).collect()
    assert {r.doc_id: r.license for r in got} == {1: "X", 2: None}


def found(spark, docs_of, texts):
    got = licenses.scan(docs_of(list(enumerate(texts))), licenses.known_table(spark)).collect()
    return [(r.license, r.line_licenses) for r in sorted(got, key=lambda r: r.doc_id)]


def test_notices_of_restrictive_licences(spark, docs_of):
    texts = ["x\nLicensed under CC BY-NC 4.0.\ny", "This work is licensed under the Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
             "// SPDX-License-Identifier: AGPL-3.0-only", "Licensed under the GNU Affero General Public License v3.0", "Licensed under nothing"]
    assert [b for _, b in found(spark, docs_of, texts)] == ["CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "AGPL-3.0", "AGPL-3.0", ""]


def rewrapped(text, prefix=""):
    """Every paragraph in lines of other widths; short paragraphs and copyright lines as they are."""
    import textwrap
    return "\n\n".join("\n".join(textwrap.wrap(" ".join(p.split()), 50, initial_indent=prefix, subsequent_indent=prefix))
                       if len(p) > 200 and "Copyright (C)" not in p else p for p in text.split("\n\n"))


def test_full_texts(spark, docs_of):
    """Every text as it is, under a copyright line, rewrapped and as a comment."""
    names = sorted(f.stem for f in licenses.TEXTS.glob("*.txt"))
    assert {"MIT", "ISC", "BSD-3-Clause", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0"} <= set(names)
    whole = {n: (licenses.TEXTS / f"{n}.txt").read_text() for n in names}
    texts, want = [], []
    for n in names:
        texts += [whole[n], f"Copyright (c) 2020-2024 Some One <a@b.org>. All rights reserved.\n\n{whole[n]}", rewrapped(whole[n]), rewrapped(whole[n], " * ")]
        want += [n] * 4
    three = whole["BSD-3-Clause"]
    two = three[:three.index("3. Neither")] + three[three.index("\nTHIS"):]
    texts += [f"MIT License\n\nCopyright (c) 2020 X\n\n{whole['MIT']}", two, whole["Apache-2.0"][:whole["Apache-2.0"].index("APPENDIX")],
              three.replace("the University", "Foo Inc., Bar").replace("REGENTS", "COPYRIGHT HOLDERS"), whole["MIT"] + "\nAnd more."]
    want += ["MIT", "BSD-2-Clause", "Apache-2.0", "BSD-3-Clause", None]
    got = [a for a, _ in found(spark, docs_of, texts)]
    assert [(i, w, g) for i, (w, g) in enumerate(zip(want, got)) if w != g] == []


def test_rest_of_a_copyright_line_stays(spark, docs_of):
    texts = ["Copyright 2020 X. Released under the MIT License.", "© 2021 Foo Inc. and Bar, Ltd. All rights reserved. Licensed under CC BY-NC 4.0.",
             "(c) 2020 X, licensed under the MIT License", "Copyright 2019 Foo Inc. All rights reserved.", "Copyright 2020 The Open License Project",
             "Copyright 2009 The Go Authors. All rights reserved. Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
             "copyright 2020 " + "x. y " * 50000]
    assert [b for _, b in found(spark, docs_of, texts)] == ["MIT", "CC-BY-NC-4.0", "MIT", "", "", "BSD-style", ""]
