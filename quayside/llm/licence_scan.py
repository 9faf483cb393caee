"""Licence recognition by sentence rules.

A text is cut into sentences, each is normalised, and the known ones become
sentence identifiers.  Sequences of identifiers are then matched against ordered
rules; at each place the longest rule wins.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepare

# Sentences of public licence texts and notices, in plain wording.
SENTENCES = {
    "ApacheRef": ["Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
                  "This work is licensed under the Apache License, Version 2.0", "Licensed under the Apache License 2.0"],
    "ApacheMay": ["you may not use this file except in compliance with the License",
                  "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"],
    "ApacheObtain": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                     "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "ApacheAsIs": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                   "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "ApacheSee": ["See the License for the specific language governing permissions and limitations under the License"],
    "MITRef": ["Released under the MIT License", "Licensed under the MIT License", "This work is licensed under the MIT License", "The MIT License", "MIT License"],
    "MITGrant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
                 "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
                 "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
                 "subject to the following conditions:"],
    "MITNotice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "MITLiability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
                     "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "MITAsIs": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
                "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "ISCGrant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
                 "above copyright notice and this permission notice appear in all copies"],
    "ISCAsIs": ["THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
                "MERCHANTABILITY AND FITNESS"],
    "ISCLiability": ["IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
                     "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
                     "THE USE OR PERFORMANCE OF THIS SOFTWARE"],
    "ISCRef": ["ISC License", "The ISC License", "Licensed under the ISC License", "Released under the ISC License"],
    "BSDTitle": ["BSD 2-Clause License", "BSD 3-Clause License", "The 2-Clause BSD License", "The 3-Clause BSD License"],
    "BSDAsIs": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
                "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"],
    "BSDLiability": [f"IN NO EVENT SHALL THE COPYRIGHT {who} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
                     "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
                     "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN "
                     "ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE" for who in ("HOLDER", "OWNER", "HOLDERS")],
    "BSDRef": ["Licensed under the BSD License", "Released under the BSD License"],
    "BSDGrant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "BSDSource": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "BSDBinary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                  "documentation and/or other materials provided with the distribution"],
    "BSDEndorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
                   "software without specific prior written permission"],
    "GPL3Ref": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
                "Licensed under the GNU General Public License version 3", "Released under the GNU General Public License, version 3"],
    "GPL2Ref": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2"],
    "GPL3Later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                  "the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "GPL2Later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                  "the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "GPLNoWarranty": [f"This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                      "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE" for what in ("program", "library")],
    "GPLSee": [f"See the GNU {which}General Public License for more details" for which in ("", "Lesser ", "Affero ")],
    "GPLReceived": [f"You should have received a copy of the GNU {which}General Public License along with this {what}"
                    for which in ("", "Lesser ", "Affero ") for what in ("program", "library")],
    "GPLWrite": ["If not, see https://www.gnu.org/licenses/", "If not, see http://www.gnu.org/licenses/",
                 "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
                 "if not, write to the Free Software Foundation, Inc., 59 Temple Place, Suite 330, Boston, MA 02111-1307 USA"],
    "GPLReceivedWrite": [f"You should have received a copy of the GNU {which}General Public License along with this {what}; if not, write to the Free Software "
                         f"Foundation, Inc., {place} USA" for which in ("", "Lesser ") for what in ("program", "library")
                         for place in ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301", "59 Temple Place, Suite 330, Boston, MA 02111-1307")],
    "LGPL21Later": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                    "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "LGPL3Later": [f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
                   "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version" for what in ("library", "program")],
    "AGPL3Later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
                   "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "MPLObtain": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/",
                  "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"],
    "ApacheTitle": ["Apache License Version 2.0, January 2004"],
    "GPL3Title": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GPL2Title": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL3Title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL21Title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "AGPL3Title": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "MPLTitle": ["Mozilla Public License Version 2.0"],
    "HowTo": ["APPENDIX: How to apply the Apache License to your work", "How to Apply These Terms to Your New Programs",
              "How to Apply These Terms to Your New Libraries"],
    "EndOfTerms": ["END OF TERMS AND CONDITIONS"],
    "MPLEnd": ["This Source Code Form is \"Incompatible With Secondary Licenses\", as defined by the Mozilla Public License, v. 2.0"],
    "LGPLRef": ["Licensed under the GNU Lesser General Public License, version 3"],
    "AGPLRef": ["Licensed under the GNU Affero General Public License, version 3"],
    "MPL2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, Version 2.0"],
    "CCBYRef": ["Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CCBYSARef": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CCBYNCRef": ["Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0",
                  "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CCBYNDRef": ["Licensed under CC BY-ND 4.0"],
    "CC0Ref": ["Released under CC0 1.0", "This work is dedicated to the public domain under CC0 1.0"],
    "PublicDomain": ["This work is in the public domain", "This is free and unencumbered software released into the public domain"],
    "AllRights": ["All rights reserved"],
}

# Ordered rules, each a licence, its kind and a sequence of sentence identifiers.
RULES = [
    ("Apache-2.0", "permissive", ["ApacheMay", "ApacheObtain", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", "permissive", ["ApacheMay"]),
    ("Apache-2.0", "permissive", ["ApacheRef"]),
    ("MIT", "permissive", ["MITRef", "MITGrant", "MITNotice", "MITAsIs"]),
    ("MIT", "permissive", ["MITGrant", "MITNotice", "MITAsIs"]),
    ("MIT", "permissive", ["MITGrant"]),
    ("MIT", "permissive", ["MITRef"]),
    ("ISC", "permissive", ["ISCGrant"]),
    ("ISC", "permissive", ["ISCRef", "ISCGrant"]),
    ("ISC", "permissive", ["ISCRef"]),
    ("BSD-3-Clause", "permissive", ["BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", "permissive", ["BSDGrant", "BSDSource", "BSDBinary"]),
    ("BSD", "permissive", ["BSDRef"]),
    ("GPL-3.0-or-later", "copyleft", ["GPL3Later", "GPLNoWarranty", "GPLSee"]),
    ("GPL-3.0-or-later", "copyleft", ["GPL3Later"]),
    ("GPL-3.0-only", "copyleft", ["GPL3Ref"]),
    ("GPL-2.0-or-later", "copyleft", ["GPL2Later", "GPLNoWarranty", "GPLSee"]),
    ("GPL-2.0-or-later", "copyleft", ["GPL2Later"]),
    ("GPL-2.0-only", "copyleft", ["GPL2Ref"]),
    ("LGPL-2.1-or-later", "copyleft", ["LGPL21Later"]),
    ("LGPL-3.0-or-later", "copyleft", ["LGPL3Later"]),
    ("AGPL-3.0-or-later", "copyleft", ["AGPL3Later"]),
    ("LGPL-3.0-only", "copyleft", ["LGPLRef"]),
    ("AGPL-3.0-only", "copyleft", ["AGPLRef"]),
    ("MPL-2.0", "copyleft", ["MPL2"]),
    ("CC-BY-4.0", "permissive", ["CCBYRef"]),
    ("CC-BY-SA-4.0", "copyleft", ["CCBYSARef"]),
    ("CC-BY-NC-4.0", "restricted", ["CCBYNCRef"]),
    ("CC-BY-ND-4.0", "restricted", ["CCBYNDRef"]),
    ("CC0-1.0", "permissive", ["CC0Ref"]),
    ("public-domain", "permissive", ["PublicDomain"]),
    ("all-rights-reserved", "restricted", ["AllRights"]),
]

# Whole licence texts: the title, the licence, its kind, and the sentence the text ends with.
TEXTS = [
    ("ApacheTitle", "Apache-2.0", "permissive", "EndOfTerms"),
    ("GPL3Title", "GPL-3.0-only", "copyleft", "EndOfTerms"),
    ("GPL2Title", "GPL-2.0-only", "copyleft", "EndOfTerms"),
    ("LGPL3Title", "LGPL-3.0-only", "copyleft", None),
    ("LGPL21Title", "LGPL-2.1-only", "copyleft", "EndOfTerms"),
    ("AGPL3Title", "AGPL-3.0-only", "copyleft", "EndOfTerms"),
    ("MPLTitle", "MPL-2.0", "copyleft", "MPLEnd"),
]

# What a whole text's instructions for its own use may hold after its end, beside sentences that are not known.
HOW_TO = {"HowTo", "ApacheMay", "ApacheObtain", "ApacheAsIs", "ApacheSee", "GPL3Later", "GPL2Later", "LGPL21Later", "LGPL3Later", "AGPL3Later",
          "GPLNoWarranty", "GPLSee", "GPLReceived", "GPLWrite", "GPLReceivedWrite", "?"}

# Kinds from the most to the least binding; a text with several takes the first.
KINDS = ["restricted", "copyleft", "unknown", "permissive"]

# Stems of what reads like a licence (_LEGAL) or names one (_SPDX); single words, as a line may end between two.
_STEMS = r"licen[cs]|copyright|permi|warrant|redistribut|spdx"
_LEGAL = re.compile(r"\blicen[sc]ed? (?:under|at|for)\b|\blicense\b|\bcopyright\b|\bpermission is\b|\bwithout warranty\b|\bredistributions?\b", re.I)
_COPYRIGHT = re.compile(r"^(?:copyright|c)\b.*\b(?:19|20)\d\d\b|^copyright (?:c )?(?:by )?\w")
_SPDX = re.compile(r"spdx-license-identifier\s*:\s*([A-Za-z0-9.+-]+)", re.I)
_LINE_MARKS = re.compile(r"^[\s*#/;%>|-]+")
_SENTENCE_END = re.compile(r"(?<=[.!?])[\s\"')]+")
_OTHER = re.compile(r"[^a-z0-9.+]+")


def normalise(sentence: str) -> str:
    """Lower-case words and numbers in single spaces; spelling of licence unified."""
    words = _OTHER.sub(" ", sentence.lower().replace("licence", "license")).split()
    return " ".join(w for w in (x.strip(".") for x in words) if w)


class SentenceRules:
    """Recognises licences by ``SENTENCES`` and ``RULES`` or the caller's own."""

    def __init__(self, sentences: dict[str, list[str]] = SENTENCES, rules: list[tuple[str, str, list[str]]] = RULES, texts=TEXTS):
        self.known = {normalise(s): name for name, forms in sentences.items() for s in forms}
        self.openings = {" ".join(words[:k]) for words in (s.split() for s in self.known) for k in range(1, len(words))}
        # A word of each known sentence that holds none of the stems: without any, no sentence can be found.
        words = (max(s.split(), key=lambda w: (not w.isalpha() and not w[0].isdigit(), len(w))) for s in self.known if s and not re.search(_STEMS, s))
        self.worth_reading = re.compile("|".join([_STEMS, *map(re.escape, sorted(set(words)))]), re.I)
        # "All rights reserved" between a copyright line and a grant takes nothing of the grant.
        given = [(x, kind, ["AllRights", *ids]) for x, kind, ids in rules if kind != "restricted"]
        self.rules = sorted([*rules, *given], key=lambda r: -len(r[2]))  # stable: among equal lengths the earlier rule
        self.texts = {t[0]: t[1:] for t in texts}

    def identifiers(self, text: str) -> list[str]:
        """Sentence identifiers in order: a known name, ``SPDX:x``, or ``?`` for
        a sentence that reads like a licence but is not known.

        A known sentence may run over several lines or sentence marks: parts are
        joined as long as they open a known sentence, and the longest one counts.
        """
        out: list[str] = []

        def close(held: str) -> None:
            if held in self.known:
                out.append(self.known[held])
            elif held and not _COPYRIGHT.match(held) and _LEGAL.search(held):
                out.append("?")

        held = ""
        for line in text.split("\n"):
            spdx = _SPDX.search(line)
            if spdx:
                close(held)
                held = ""
                out.append("SPDX:" + spdx.group(1))
                continue
            for part in _SENTENCE_END.split(_LINE_MARKS.sub("", line)):
                part = normalise(part)
                if not part:
                    continue
                joined = f"{held} {part}" if held else part
                if joined not in self.known and joined not in self.openings and held:
                    close(held)
                    joined = part
                if joined in self.openings:
                    held = joined
                else:
                    close(joined)
                    held = ""
        close(held)
        return out

    def match(self, identifiers: list[str]) -> list[tuple[str, str]]:
        """Licences with their kinds, in order of the text.

        A title opens a whole licence text: what follows, known or not, belongs to
        it up to the sentence it ends with, or to the end of the document, and so do
        the instructions for its use behind that sentence."""
        out, i = [], 0
        while i < len(identifiers):
            name = identifiers[i]
            if name in self.texts:
                licence, kind, end = self.texts[name]
                out.append((licence, kind))
                i = identifiers.index(end, i) + 1 if end in identifiers[i:] else len(identifiers)
                if identifiers[i:i + 1] == ["HowTo"]:
                    while i < len(identifiers) and identifiers[i] in HOW_TO:
                        i += 1
                continue
            if name == "?":
                out.append(("unknown", "unknown"))
                i += 1
                continue
            if name.startswith("SPDX:"):
                kind = next((r[1] for r in self.rules if r[0].lower() == name[5:].lower()), "unknown")
                out.append((name[5:], kind))
                i += 1
                continue
            rule = next((r for r in self.rules if identifiers[i:i + len(r[2])] == r[2]), None)
            if rule:
                out.append((rule[0], rule[1]))
                i += len(rule[2])
            else:
                i += 1  # a sentence that says nothing alone
        return out

    def scan(self, text: str | None) -> tuple[list[str], list[str], str]:
        """``(identifiers, licences, kind)`` of a whole text."""
        if not text or not self.worth_reading.search(text.lower()):
            return [], [], "none"
        found = self.identifiers(text)
        licences = self.match(found)
        kind = next((k for k in KINDS if any(x[1] == k for x in licences)), "none")
        return found, list(dict.fromkeys(x[0] for x in licences)), kind


def scan_licences(docs: DataFrame, rules: SentenceRules | None = None, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Licences of every whole text: ``id, sentence_ids array<string>, licences
    array<string> (first occurrences in order), licence_kind``.

    Texts are read whole, however long, in one pass; of rules that match at one
    place the longest counts, of equal ones the first.  ``licence_kind`` is the most binding kind found (restricted, copyleft,
    unknown, permissive) or ``none``; null and empty texts give ``none``.  One
    row per input row, repeated rows included; nothing is shuffled.
    """
    prepare(docs.sparkSession)
    rules = rules or SentenceRules()

    def scan(batches):
        for batch in batches:
            rows = [rules.scan(t) for t in batch.iloc[:, 1]]
            yield pd.DataFrame({id: batch.iloc[:, 0].values, "sentence_ids": [r[0] for r in rows],
                                "licences": [r[1] for r in rows], "licence_kind": [r[2] for r in rows]})

    plain = docs.select(F.col(id), F.col(text).alias("__text"))
    kind = plain.schema[id].dataType.simpleString()
    return plain.mapInPandas(scan, f"`{id}` {kind}, sentence_ids array<string>, licences array<string>, licence_kind string")
