"""License scans by sentence-rule recognition.

A text is cut into sentences; each, normalised, is looked up among the known sentences of licences; the identifiers
found, in order, are matched against ordered rules, each a sequence of identifiers that stands for a licence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Creative Commons licences by their short names.
CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = ("4.0", "3.0")
#: Ways to write a short notice; {0} is a name such as CC BY-NC 4.0.
CC_NOTICES = [
    start + name
    for start in ("Licensed under ", "This work is licensed under ", "Released under ")
    for name in ("{0}", "the {0} License", "a {0} License", "{0} International")
]
#: Fixed values: (SPDX identifier, licence); an identifier counts only after SPDX_TAG.
SPDX_TAG = "SPDX-License-Identifier"
SPDX = (
    *[(x, x) for x in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "MPL-2.0", "Unlicense", "CC0-1.0")],
    *[(x + end, x) for x in ("GPL-2.0", "GPL-3.0", "LGPL-3.0", "AGPL-3.0") for end in ("", "-only", "-or-later")],
    *[(f"CC-{k}-{v}", f"CC-{k}-{v}") for k in CC for v in CC_VERSIONS],
)

#: Sentences of public licence texts and of the notices that name them, by identifier.
SENTENCES = {
    "mit-notice": "Released under the MIT License",
    "mit-notice-2": "Licensed under the MIT License",
    "mit-notice-3": "This project is licensed under the MIT License",
    "mit-title": "The MIT License (MIT)",
    "mit-title-2": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
    "conditions:",
    "mit-condition": "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liable": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "isc-liable": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
    "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-title": "ISC License",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
    "and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission.",
    "bsd-endorse-rest": "nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission.",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE "
    "ARE DISCLAIMED.",
    "bsd-liable": "OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "bsd-title-2": "BSD 2-Clause License",
    "bsd-title-3": "BSD 3-Clause License",
    "apache-notice": "Licensed under the Apache License, Version 2.0",
    "apache-notice-2": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-title": "Apache License, Version 2.0",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License "
    "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "apache-grant": "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
    "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works "
    "of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object "
    "form.",
    "gpl3-kind": "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "gpl2-kind": "The licenses for most software are designed to take away your freedom to share and change it.",
    "agpl-kind": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, "
    "specifically designed to ensure cooperation with the community in the case of network server software.",
    "lgpl-kind": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of "
    "the GNU General Public License, supplemented by the additional permissions listed below.",
    "mpl-grant": "Each Contributor hereby grants You a world-wide, royalty-free, non-exclusive license:",
    "gpl-copy": "You should have received a copy of the GNU General Public License along with this program.",
    **{
        f"{key}-free": f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
        for key, what, name in (("lgpl", "library", "Lesser"), ("lgpl-program", "program", "Lesser"), ("agpl", "program", "Affero"))
    },
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl2-notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
    "your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
    "your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "gpl3-title": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "gpl2-title": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "lgpl-notice": "This work is licensed under the GNU Lesser General Public License, version 3",
    "agpl-notice": "This work is licensed under the GNU Affero General Public License, version 3",
    "mpl-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at "
    "http://mozilla.org/MPL/2.0/.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-any": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either "
    "in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring "
    "rights to this software to the public domain worldwide.",
    **{
        f"cc-{k.lower()}": f"This work is licensed under a Creative Commons {name} 4.0 International License."
        for k, name in CC.items()
        if k not in ("BY", "BY-SA", "BY-NC")
    },
    **{
        f"cc-{k.lower()}-{v}-notice-{n}": notice.format(f"CC {k} {v}")
        for k in CC
        for v in CC_VERSIONS
        for n, notice in enumerate(CC_NOTICES, 1)
    },
    **{f"cc0-notice-{n}": notice.format("CC0 1.0") for n, notice in enumerate(CC_NOTICES, 1)},
    "spdx": SPDX_TAG,
    **{f"spdx-{key.lower()}": key for key, _ in SPDX},
}

#: Fixed values: (licence, identifiers in order); a longer rule counts before a shorter one that it contains.
RULES = (
    ("MIT", ("mit-grant", "mit-condition", "as-is")),
    ("MIT", ("mit-grant", "mit-condition")),
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-notice-3",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-title-2",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-title",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse-rest")),
    ("BSD-3-Clause", ("bsd-title-3",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-title-2",)),
    ("Apache-2.0", ("apache-notice-2", "apache-comply", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-notice-2",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-title",)),
    ("Apache-2.0", ("apache-grant",)),
    ("GPL-3.0", ("gpl3-kind",)),
    ("GPL-2.0", ("gpl2-kind",)),
    ("AGPL-3.0", ("agpl-kind",)),
    ("LGPL-3.0", ("lgpl-kind",)),
    ("MPL-2.0", ("mpl-grant",)),
    ("LGPL-3.0", ("lgpl-free",)),
    ("LGPL-3.0", ("lgpl-program-free",)),
    ("AGPL-3.0", ("agpl-free",)),
    ("GPL-3.0", ("gpl-free", "gpl-hope", "gpl-details")),
    ("GPL-3.0", ("gpl-free",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0", ("gpl3-title",)),
    ("GPL-2.0", ("gpl2-free", "gpl-hope", "gpl-details")),
    ("GPL-2.0", ("gpl2-free",)),
    ("GPL-2.0", ("gpl2-notice",)),
    ("GPL-2.0", ("gpl2-title",)),
    ("LGPL-3.0", ("lgpl-notice",)),
    ("AGPL-3.0", ("agpl-notice",)),
    ("MPL-2.0", ("mpl-notice", "mpl-copy")),
    ("MPL-2.0", ("mpl-notice",)),
    ("Unlicense", ("unlicense-free", "unlicense-any")),
    ("Unlicense", ("unlicense-free",)),
    ("CC-BY-4.0", ("cc-by",)),
    ("CC-BY-SA-4.0", ("cc-by-sa",)),
    ("CC-BY-NC-4.0", ("cc-by-nc",)),
    ("CC0-1.0", ("cc0",)),
    *[(f"CC-{k}-4.0", (f"cc-{k.lower()}",)) for k in CC if k not in ("BY", "BY-SA", "BY-NC")],
    *[(f"CC-{k}-{v}", (f"cc-{k.lower()}-{v}-notice-{n}",)) for k in CC for v in CC_VERSIONS for n in range(1, len(CC_NOTICES) + 1)],
    *[("CC0-1.0", (f"cc0-notice-{n}",)) for n in range(1, len(CC_NOTICES) + 1)],
    *[(name, ("spdx", f"spdx-{key.lower()}")) for key, name in SPDX],
)

#: Sentences in a row that tell a licence's whole text.
BODY_RUN = 5
#: Licences whose texts contain each other's rules; only the longest of them counts.
CONTAINING = {"BSD-2-Clause": "BSD", "BSD-3-Clause": "BSD"}

#: A sentence ends at a mark before white space or the end, at a semicolon or colon so placed, or at an empty line.
END = r"[.!?;:]+(?:[ \t\n\r]+|$)|\n[ \t\r]*\n[ \t\r\n]*"
#: Every known sentence has one of these; a bare SPDX identifier only as a whole text, since its tag has "licen".
ANCHOR = (
    r"(?i)licen|permi|copyright|redistribut|software|warrant|mozilla|\bcc[ -]by|\bcc0"
    r"|^(?:mit|isc|bsd [23] clause|apache 2 0|mpl 2 0|[al]?gpl [23] 0(?: only| or later)?)$"
)
LINE_END = r"[.!?;:]+(?:[ \t\n\r]+|$)|\n[ \t\r\n]*"


#: The holder that a sentence names, whoever it is, is written as in SENTENCES.
HOLDER = r"^neither the names? of .*? nor the names of (?:its|their|the) contributors "
HOLDER_FORM = "neither the name of the copyright holder nor the names of its contributors "


def normal_text(text: str) -> str:
    """The same as ``normal`` for the known sentences."""
    plain = re.sub(r"[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)).strip(" ")
    return re.sub(HOLDER, HOLDER_FORM, plain)


def normal(text: Column) -> Column:
    """ASCII lower case; every run of other characters than a-z and 0-9 is one space; none at the ends; any holder alike."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.trim(F.regexp_replace(lower, "[^a-z0-9]+", " "))
    return F.when(F.startswith(plain, F.lit("neither the name")), F.regexp_replace(plain, HOLDER, HOLDER_FORM)).otherwise(plain)


def segments(text: str, body: bool = False) -> list[str]:
    """The normalised sentences of a known text that have a telling word; of a whole licence's text those of four words."""
    parts = [normal_text(part) for part in re.split(END, text)]
    return [p for p in parts if (p.count(" ") >= 3 if body else p and re.search(ANCHOR, p))]


def known_table(bodies: dict[str, str] | None = None) -> dict[str, str]:
    """Normalised sentence -> identifier, numbered where a known text has several."""
    out: dict[str, str] = {}
    texts = [(key, segments(text)) for key, text in SENTENCES.items()]
    texts += [(f"body-{name.lower()}", segments(text, body=True)) for name, text in (bodies or {}).items()]
    for key, parts in texts:
        for k, part in enumerate(parts):
            out.setdefault(part, f"{key}.{k + 1}" if len(parts) > 1 else key)
    return out


def expanded_rules(bodies: dict[str, str] | None = None) -> list[tuple[str, str]]:
    """(licence, identifiers of the rule's sentences in order, space-joined).

    A licence's whole text stands for it by any BODY_RUN sentences in a row, taken every BODY_RUN sentences, of those
    that no other known text has.
    """
    known = known_table(bodies)
    out = [(name, " ".join(known[p] for key in rule for p in segments(SENTENCES[key]))) for name, rule in RULES]
    for name, text in (bodies or {}).items():
        own = [known[p] for p in segments(text, body=True)]
        runs = [own[i : i + BODY_RUN] for i in range(0, max(1, len(own) - BODY_RUN + 1), BODY_RUN)]
        mine = f"body-{name.lower()}"
        out += [(name, " ".join(run)) for run in runs if any(x == mine or x.startswith(mine + ".") for x in run)]
    return out


def sentence_ids(text: Column, ends: str, known: Column) -> Column:
    """Identifiers of the known sentences, in order."""
    looked = F.transform(F.split(text, ends), lambda s: F.try_element_at(known, normal(s)))
    return F.filter(looked, lambda x: x.isNotNull())


def scan_licenses(docs: DataFrame, bodies: dict[str, str] | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): licenses, sentence_ids, rules, n_known.

    ``bodies`` adds whole licence texts by licence name to the sentences and rules of this module, which has the
    notices, grants and disclaimers of the common licences but not their full texts.

    ``sentence_ids`` has the known sentences in order, space-joined. Text is read both ways that notices are set:
    wrapped (a single line break is a space) and line by line; the way that recognises more sentences counts, at a
    tie the wrapped one. A rule holds where its identifiers follow each other among those found, whatever unknown
    sentences stand between; ``licenses`` and ``rules`` list each licence and rule that holds, sorted, comma-joined,
    less the rules within a longer one that holds. Without any the columns are empty, n_known 0. Null and
    empty texts have none; whole texts are read; repeated rows and null doc_ids are scanned each; further columns
    are ignored; an empty table gives an empty result.

    DataFrame functions only, one projection without a shuffle. Each known sentence has one of the words of
    ``ANCHOR``, so only texts with one are cut into sentences; the others can hold none.
    """
    known = F.create_map([F.lit(x) for pair in known_table(bodies).items() for x in pair])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    may = F.lit(True) if bodies else text.rlike(ANCHOR)
    none = F.array().cast("array<string>")
    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.when(may, sentence_ids(text, END, known)).otherwise(none).alias("wrapped"),
        F.when(may, sentence_ids(text, LINE_END, known)).otherwise(none).alias("lined"),
    )
    ids = F.when(F.size("lined") > F.size("wrapped"), F.col("lined")).otherwise(F.col("wrapped"))
    row = F.concat(F.lit(" "), F.concat_ws(" ", "ids"), F.lit(" "))
    rules, held, licences = expanded_rules(bodies), [], []
    for name, rule in rules:
        holds = F.contains(row, F.lit(f" {rule} "))
        for longer in [r for n, r in rules if r != rule and f" {rule} " in f" {r} " and CONTAINING.get(n, n) == CONTAINING.get(name, name)]:
            holds &= ~F.contains(row, F.lit(f" {longer} "))
        held.append(F.when(holds, F.lit(rule.replace(" ", "+"))))
        licences.append(F.when(holds, F.lit(name)))
    found = lambda xs: F.concat_ws(",", F.array_sort(F.array_distinct(F.array_compact(F.array(*xs)))))
    some = F.size("ids") > 0
    return read.select("doc_id", ids.alias("ids")).select(
        "doc_id",
        F.when(some, found(licences)).otherwise("").alias("licenses"),
        F.concat_ws(" ", "ids").alias("sentence_ids"),
        F.when(some, found(held)).otherwise("").alias("rules"),
        F.size("ids").cast("bigint").alias("n_known"),
    )
