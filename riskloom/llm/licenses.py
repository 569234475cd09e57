"""Operator 3: licences by recognised sentences and ordered rules, in SQL functions only.

A text is split into sentences at line ends and full stops (a line that goes on in lower
case belongs to the line before, but for SPDX tags). Sentences are lower-cased, everything but letters,
digits and dots becomes a blank, and each that equals a known licence sentence becomes
that sentence's identifier. Rules are tried in order on the identifiers: a rule that
finds its identifiers one after the other names its licence and uses them up. What no
rule used is reported.

Null and empty texts, and texts without a known sentence, have verdict ``none``; known
sentences that no rule uses make ``unknown``; otherwise ``licensed``. Every input row
gives one row; a repeated licence is named once.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.rules import let

# Identifiers and wording of public licence sentences.
SENTENCES = {
    "gpl3_work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2_work": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3_later": "This program is free software: you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "gpl2_later": "This program is free software; you can redistribute it and/or modify it under the terms of the "
                  "GNU General Public License as published by the Free Software Foundation; either version 2 of the "
                  "License, or (at your option) any later version.",
    "lgpl21_later": "This library is free software; you can redistribute it and/or modify it under the terms of the "
                    "GNU Lesser General Public License as published by the Free Software Foundation; either version "
                    "2.1 of the License, or (at your option) any later version.",
    "gnu_hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
                "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gnu_details": "See the GNU General Public License for more details.",
    "apache2_short": "Licensed under the Apache License, Version 2.0.",
    "apache2_use": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License.",
    "apache2_copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2_basis": "Unless required by applicable law or agreed to in writing, software distributed under the "
                     "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
                     "either express or implied.",
    "apache2_see": "See the License for the specific language governing permissions and limitations under the License.",
    "mit_grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                 "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                 "furnished to do so, subject to the following conditions:",
    "mit_notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "bsd_use": "Redistribution and use in source and binary forms, with or without modification, are permitted "
               "provided that the following conditions are met:",
    "bsd_source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer.",
    "bsd_binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                  "and the following disclaimer in the documentation and/or other materials provided with the "
                  "distribution.",
    "bsd_names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                 "or promote products derived from this software without specific prior written permission.",
    "isc_grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                 "in all copies.",
    "mpl_subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved.",
}
_SHORT = {"MIT": "MIT", "ISC": "ISC", "BSD-2-Clause": "BSD 2-Clause", "BSD-3-Clause": "BSD 3-Clause", "Zlib": "zlib"}
_CC = ["BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"]
_SPDX = ["MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-only", "GPL-2.0-or-later",
         "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-or-later", "MPL-2.0", "Unlicense", "CC0-1.0"]


def _identifier(prefix: str, name: str) -> str:
    return prefix + re.sub(r"[^a-z0-9]", "", name.lower())


def dictionary() -> dict[str, str]:
    """Identifier -> sentence, with the short forms that follow from licence names."""
    out = dict(SENTENCES)
    for spdx, name in _SHORT.items():
        out[_identifier("released_", spdx)] = f"Released under the {name} License."
        out[_identifier("licensed_", spdx)] = f"Licensed under the {name} License."
    for kind in _CC:
        out[_identifier("cc_", kind)] = f"Licensed under CC {kind} 4.0."
        out[_identifier("ccwork_", kind)] = f"This work is licensed under CC {kind} 4.0."
    for spdx in _SPDX:
        out[_identifier("spdx_", spdx)] = f"SPDX-License-Identifier: {spdx}"
    return out


def rules() -> list[tuple[str, list[str]]]:
    """(licence, identifiers in a row), the most specific first."""
    out = [
        ("Apache-2.0", ["apache2_use", "apache2_copy", "apache2_basis", "apache2_see"]),
        ("Apache-2.0", ["apache2_use", "apache2_copy"]), ("Apache-2.0", ["apache2_use"]),
        ("BSD-3-Clause", ["bsd_use", "bsd_source", "bsd_binary", "bsd_names"]),
        ("BSD-2-Clause", ["bsd_use", "bsd_source", "bsd_binary"]),
        ("GPL-3.0-or-later", ["gpl3_later", "gnu_hope", "gnu_details"]), ("GPL-3.0-or-later", ["gpl3_later"]),
        ("GPL-2.0-or-later", ["gpl2_later", "gnu_hope", "gnu_details"]), ("GPL-2.0-or-later", ["gpl2_later"]),
        ("LGPL-2.1-or-later", ["lgpl21_later"]), ("MIT", ["mit_grant", "mit_notice"]), ("ISC", ["isc_grant"]),
        ("MPL-2.0", ["mpl_subject"]), ("Unlicense", ["unlicense"]), ("Apache-2.0", ["apache2_short"]),
        ("GPL-3.0-only", ["gpl3_work"]), ("GPL-2.0-only", ["gpl2_work"]),
    ]
    for spdx in _SHORT:
        out += [(spdx, [_identifier("released_", spdx)]), (spdx, [_identifier("licensed_", spdx)])]
    for kind in _CC:
        out += [(f"CC-{kind}-4.0", [_identifier("cc_", kind)]), (f"CC-{kind}-4.0", [_identifier("ccwork_", kind)])]
    return out + [(spdx, [_identifier("spdx_", spdx)]) for spdx in _SPDX]


TAG_LINE = r"(SPDX-License-Identifier:[^\n]*)\n"
CONTINUED = r"\n[ \t*#/;-]*([a-z(])"
OTHER = r"[^a-z0-9.\n]+"
ENDS = r"\.? *\n[ .\n]*|\. +"
#: stands where a rule took its sentences, so that their neighbours do not become neighbours
USED = "|"
#: a named holder, in sentences as ``normal`` leaves them
HOLDER = r"^neither the name of .+ nor the names of"
ANY_HOLDER = "neither the name of the copyright holder nor the names of"


def normal(sentence: str) -> str:
    return re.sub(HOLDER, ANY_HOLDER, re.sub(OTHER, " ", sentence.lower()).strip(" ."))


def _sentences(text: Column) -> Column:
    tagged = F.regexp_replace(F.coalesce(text, F.lit("")), TAG_LINE, "$1.\n")
    joined = F.regexp_replace(tagged, CONTINUED, " $1")
    clean = F.regexp_replace(F.translate(joined, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), OTHER, " ")
    trimmed = F.transform(F.split(clean, ENDS), lambda s: F.btrim(s, F.lit(" .")))
    return F.transform(trimmed, lambda s: F.when(s.startswith("neither the name of "), F.regexp_replace(
        s, HOLDER, ANY_HOLDER)).otherwise(s))


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, licenses and unmatched (comma-separated), n_sentences (known ones) and the
    verdict of every row."""
    names = {normal(s): k for k, s in dictionary().items()}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = let(_sentences(F.col("text")), lambda s: F.transform(
        F.filter(s, lambda x: x.isin(list(names))), lambda x: F.element_at(known, x)))
    steps = F.array(*[F.struct(F.lit(name).alias("name"), F.lit("," + ",,".join(ids) + ",").alias("ids"))
                      for name, ids in rules()])
    rows = docs.select(F.col("doc_id"), found.alias("found"))
    rows = rows.select("doc_id", F.size("found").cast("long").alias("n_sentences"), F.aggregate(
        steps, F.struct(F.concat_ws("", F.transform("found", lambda x: F.concat(F.lit(","), x, F.lit(",")))).alias("left"),
                        F.array().cast("array<string>").alias("names")),
        lambda acc, r: F.when(F.contains(acc["left"], r["ids"]), F.struct(
            F.replace(acc["left"], r["ids"], F.lit(USED)).alias("left"),
            F.array_union(acc["names"], F.array(r["name"])).alias("names"))).otherwise(acc)).alias("m"))
    left = F.btrim(F.regexp_replace("m.left", "[,|]+", ","), F.lit(","))
    return rows.select(
        "doc_id", F.array_join("m.names", ",").alias("licenses"), left.alias("unmatched"), "n_sentences",
        F.when(F.size("m.names") > 0, "licensed").when(F.col("n_sentences") > 0, "unknown").otherwise("none").alias("verdict"))
