"""License scans by canonical digest lookup, in Spark expressions only.

A text is brought into a canonical form (lower case, punctuation and
copyright statements out, equivalent spellings made one, named parties of the
BSD clauses out) and hashed; the digest is joined with those of known
licences.  A copyright statement takes the rest of its line, except a sentence
that grants or names a licence.  The whole text is looked up, and so is
every line, as notices often stand as a line of their own in other text.

Defined results: null texts count as empty; a text whose canonical form is
empty has no digest and matches nothing; of known licences with one canonical
form the one of smallest name answers; repeated rows each get a result; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callcredit.session import materialize

# Spellings that licence matching treats as one word.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("favour", "favor"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labour", "labor"),
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("sublicence", "sublicense"),
    ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)
# Known notices by identifier; known_table() adds the standard notices, which
# the DuckDB SQL shares, and the full texts.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International License."),
    ("BSD-style", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
)
TEXTS = Path(__file__).with_name("license_texts")  # full texts, <identifier>.txt
# Titles that stand before a text whose file has none.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
    "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003", "Boost Software License 1.0"),
}
# Names that notices give a licence.
NAMED = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0 License"),
    "MIT": ("MIT License",),
    "ISC": ("ISC License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"),
    "EPL-1.0": ("Eclipse Public License, Version 1.0", "Eclipse Public License 1.0"),
    "EPL-2.0": ("Eclipse Public License, Version 2.0", "Eclipse Public License 2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "Unlicense": ("Unlicense",),
    "Zlib": ("zlib License",),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD License"),
    "SSPL-1.0": ("Server Side Public License, version 1", "Server Side Public License"),
    "BUSL-1.1": ("Business Source License 1.1",),
} | {f"{short}-{v}": tuple(f"{long}{x}" for x in (f", version {v.removesuffix('.0')}", f" version {v.removesuffix('.0')}", f" v{v.removesuffix('.0')}",
                                                   f", version {v}", f" v{v}"))
     for short, long, versions in (("GPL", "GNU General Public License", ("2.0", "3.0")), ("AGPL", "GNU Affero General Public License", ("3.0",)),
                                   ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")))
     for v in versions}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
for _k, _long in _CC.items():
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _port = {"3.0": " Unported", "4.0": " International"}.get(_v, "")
        NAMED[f"CC-{_k}-{_v}"] = (f"CC {_k} {_v}", f"CC {_k} {_v} License", f"Creative Commons {_long} {_v}{_port} License",
                                  f"Creative Commons {_long} {_v} License", f"Creative Commons {_long} {_v}{_port}")
NAMED["CC0-1.0"] = ("CC0 1.0", "Creative Commons Zero v1.0 Universal", "CC0 1.0 Universal")
# What stands before the name in a notice.
PHRASES = ("Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under", "This project is licensed under",
           "This software is licensed under", "This file is licensed under", "This content is licensed under")

# What follows "copyright" where the word belongs to a sentence.
_IN_SENTENCE = (r"(?![^\p{L}\p{N}]+(?:notices?|lines?|patents?|trademarks?|holders?|owners?|laws?|licen[sc]es?|act|statements?|interests?|disclaimers?|protection|ownership|permission|rights?|"
                r"treat(?:y|ies)|status|infringement|and|or|in|is|of|to|for|if|with|as|on|under|resulting|therein|permissions?|does|may|shall|can|applies)\b)")
# "(c)" may also number a clause: a year or a holder's "by" tells.
_MARK = r"\(c\)(?=[^\n]{0,80}?\b(?:19|20)\d\d\b|[ \t]+copyright\b|[ \t]+by\b|[^\n]{0,80}?\ball rights reserved\b)"
# Where a copyright statement ends before its line does: at a sentence that
# speaks of a licence, or at words that begin a grant.
_REST = (r"[.;|][ \t]+(?=[^\n.;|]*\b(?:licen[sc](?:e[ds]?|ing)|permission|permitted|redistribut(?:ed|ion|ions)|released|distributed|public domain|spdx)\b)"
         r"|[ \t](?=(?:(?:re)?licen[sc]ed|released|(?:re)?distributed|available)[ \t]+(?:under|in|into|by|with)\b"
         r"|permission[ \t]+(?:is|to)\b|redistribution[ \t]+and[ \t]+use\b|spdx\b|under[ \t]+(?:the|an?)\b[^\n.;|]{0,80}\blicen[sc]e\b)")
_COPYRIGHT = (rf"(?m)^[^\p{{L}}\p{{N}}\n©]*(?:©|{_MARK}|copyright\b{_IN_SENTENCE}|all rights reserved\b)[^\n]*?(?={_REST}|\n|\z)")
# Named parties of the BSD clauses and the disclaimers.
_PARTIES = (r"\b(neither\s+the\s+names?\s+of|software\s+is\s+provided\s+by|in\s+no\s+event\s+shall)\s[\p{L}\p{N}\s]{1,200}?"
            r"\b(nor\s+the\s+names?\s+of|as\s+is|be\s+liable)\b")


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line breaks: words joined by one space."""
    t = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _COPYRIGHT, "")
    t = F.regexp_replace(F.regexp_replace(t, r"[^\p{L}\p{N}\n]+", " "), _PARTIES, "$1 $2")
    spellings = r"\b(?:" + "|".join(a for a, _ in EQUIVALENT) + r")\b"
    spelled = t
    for a, b in EQUIVALENT:
        spelled = F.regexp_replace(spelled, rf"\b{a}\b", b)
    # most texts hold none of the spellings: one pattern tells
    return F.when(t.rlike(spellings), spelled).otherwise(t)


def _digest(canonical: Column) -> Column:
    words = F.trim(F.regexp_replace(canonical, r"[ \n]+", " "))
    return F.when(words != "", F.sha2(words, 256))


def known_digests(licenses: DataFrame, name: str = "license", text: str = "text") -> DataFrame:
    """``digest`` and ``license`` of a table of licence texts."""
    return licenses.select(F.col(name).alias("license"), _digest(canonical_lines(F.col(text))).alias("digest")).where(
        "digest is not null").groupBy("digest").agg(F.min("license").alias("license"))


def _full_texts() -> list[tuple[str, str]]:
    """Every full text with the forms it is found in."""
    read = {f.stem: f.read_text(encoding="utf-8") for f in sorted(TEXTS.glob("*.txt"))}
    three = read["BSD-3-Clause"]
    read["BSD-2-Clause"] = three[:three.index("3. Neither")] + three[three.index("\nTHIS SOFTWARE"):]
    out = []
    for name, text in read.items():
        forms = {text}
        if name in ("BSD-2-Clause", "BSD-3-Clause"):  # listed by numbers or by bullets
            forms.add(text.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "))
        for old, new in (("and/or distribute", "and distribute"), ("AUTHOR DISCLAIMS", "AUTHORS DISCLAIM"), ("http://", "https://"), ("https://", "http://")):
            forms |= {f.replace(old, new) for f in forms}
        end = "END OF TERMS AND CONDITIONS"  # what follows says how to apply it
        forms |= {f[:f.index(end) + len(end)] for f in forms if end in f} | {f[:f.index(end)] for f in forms if end in f}
        for f in sorted(forms):
            out += [(name, f), *((name, f"{title}\n\n{f}") for title in TITLES.get(name, ()))]
    return out


def standard_notices() -> list[tuple[str, str]]:
    """The standard notices of the named licences, and their SPDX lines."""
    out = [(name, f"{phrase} {the}{called}") for name, names in NAMED.items() for called in names for phrase in PHRASES
           for the in ("the ", "")]
    return out + [(name, f"SPDX-License-Identifier: {name}{more}") for name in NAMED
                  for more in (("", "-only", "-or-later", "+") if "GPL" in name else ("",))]


def known_table(spark: SparkSession) -> DataFrame:
    """``license`` and ``text``: the shared notices, the standard notices and
    the full texts."""
    # one literal: no Python process starts on the executors
    rows = F.lit("\x1e".join(f"{n}\x1f{t}" for n, t in (*KNOWN, *standard_notices(), *_full_texts())))
    each = spark.range(1).select(F.explode(F.split(rows, "\x1e")).alias("r"))
    return each.select(F.substring_index("r", "\x1f", 1).alias("license"), F.substring_index("r", "\x1f", -1).alias("text"))


def scan(docs: DataFrame, licenses: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "license",
         license_text: str = "text") -> DataFrame:
    """``doc_id``, ``digest`` of the canonical text, ``license`` (null when
    the whole text is none that is known) and ``line_licenses`` (names found
    as whole lines, sorted, comma-joined), one row per document."""
    known = materialize(known_digests(licenses, name, license_text), "license-digests")
    canonical = docs.select(F.col(doc_id).alias("doc_id"), canonical_lines(F.col(text)).alias("c"))
    digests = canonical.select("doc_id", _digest(F.col("c")).alias("digest"), F.array_distinct(F.array_compact(F.transform(
        F.split("c", "\n"), _digest))).alias("lines"))
    # a number per row keeps repeated rows apart and never leaves this table
    digests = materialize(digests.withColumn("row", F.monotonically_increasing_id()), "license-docs")
    found = digests.select("row", F.explode("lines").alias("digest")).join(known, "digest")
    by_row = materialize(found.groupBy("row").agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("line_licenses")),
                         "license-lines")
    whole = digests.select("row", "doc_id", "digest").join(known, "digest", "left")
    return whole.join(by_row, "row", "left").select("doc_id", "digest", "license", F.coalesce("line_licenses", F.lit("")).alias("line_licenses"))
