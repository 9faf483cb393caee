"""Odd pages, whole licences, binding limits: the cases that earlier versions got wrong."""

import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quayside.llm import html_main, licence_scan, mixture_shards, vector_packing

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

# --------------------------------------------------------------------------- pages

ODD = {
    "open tags": "<a " * 70_000, "open end tags": "</a " * 50_000, "stray ends": "<span>" * 30_000 + "</p>" * 30_000, "quotes": '<a "' * 50_000,
    "quotes with an end": '<a "' * 50_000 + ">", "blocks in spans": "<span>" * 10_000 + "<div></div>" * 10_000, "open script": "<script " * 30_000,
    "inline over a block": "<b><div>" + "<i>" * 20_000 + "</b>" * 20_000, "comments": "<!-- " * 50_000, "silent": "<button>" * 10_000 + "</select>" * 10_000,
}


@pytest.mark.parametrize("name", sorted(ODD))
def test_odd_markup_takes_no_more_than_its_length(name):
    page = ODD[name]
    began = time.process_time()
    html_main.lines_of(page)
    once = time.process_time() - began
    assert once < 1.0
    began = time.process_time()
    html_main.lines_of(page * 4)
    assert time.process_time() - began < 12 * once + 0.3


@pytest.mark.parametrize("name", ["comment-list", "user-comments", "post-comments", "related-posts", "cookie-notice", "ad-slot", "newsletter-box", "ad", "comments"])
@pytest.mark.parametrize("shared", [None, []])
def test_comments_adverts_and_notices_go(name, shared):
    text = "This is what the page says, in a sentence or two."
    inside = f'<article><h1>Title</h1><p>{text}</p><div class="{name}">A reader or a shop said this.</div></article>'
    outside = f'<div><p>{text}</p></div><div class="x {name}"><p>A reader or a shop.</p></div>'
    assert html_main.main_text(*html_main.lines_of(inside), shared) == "Title\n" + text
    assert html_main.main_text(*html_main.lines_of(outside), shared) == text


def test_names_that_take_no_page():
    text = "This is what the page says, in a sentence or two."
    for name in ("layout no-sidebar", "page-with-comments", "top-story", "without-ads"):
        assert html_main.main_text(*html_main.lines_of(f'<div class="{name}"><p>{text}</p></div>'), []) == text
    assert html_main.main_text(*html_main.lines_of(f'<div class="page-comments"><article><p>{text}</p></article></div>'), []) == text
    assert html_main.main_text(*html_main.lines_of('<div class="ad">Buy this now, it is good.</div>'), []) == ""


def test_the_comparison_alone_decides(spark):
    """Pages of divs without names: what neighbours share goes, in one host only."""
    def page(n, site):
        return f"<div>{site} home</div><div>About {site}</div><div>Text number {n} of the page, {site}.</div><div>Write to {site}</div>"

    rows = [(k, f"https://h{k % 2}.org/a/{k:03d}", page(k, f"site {k % 2}")) for k in range(40)] + [(99, "https://alone.org/x", page(99, "alone"))]
    got = {r.page_id: r for r in html_main.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for k in range(40):
        assert got[k].text == f"Text number {k} of the page, site {k % 2}." and got[k].n_shared == 3
    assert got[99].text.count("\n") == 3


# --------------------------------------------------------------------------- packing


def test_very_long_white_space(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    encoder = vector_packing.IdBytes(open(BYTE_BPE, "rb").read())
    for text in ("\n" * 1_000_000, " " * 300_000 + "x", "a" + "\t" * 200_000):
        want = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.of(text) == want
    df = spark.createDataFrame([(1, "\n" * 1_000_000), (2, None)], "doc_id long, text string")
    rows = vector_packing.pack_documents(df, BYTE_BPE, 1024, 64, 1020).collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == len(library.encode("\n" * 1_000_000, add_special_tokens=False).ids) + 1


def test_the_loss_limit_binds(spark):
    df = spark.createDataFrame([(k, "word and more " * (k * 7)) for k in range(60)], "doc_id long, text string")
    rows = vector_packing.pack_documents(df, BYTE_BPE, 128, 64, 120).collect()
    loss, tokens = {}, {}
    for r in rows:
        loss[r.sequence_id] = loss.get(r.sequence_id, 0) + r.loss_tokens
        tokens[r.sequence_id] = tokens.get(r.sequence_id, 0) + r.length
    assert max(loss.values()) == 120 and max(tokens.values()) <= 128
    assert sum(v == 120 for v in loss.values()) > len(loss) // 2


def plain_place(tokens, loss, limits):
    """The heuristic item by item."""
    size = [(t, l, 1) for t, l in zip(tokens, loss)]
    limit = (limits[0], limits[2], limits[1])
    left_items, out, number = list(range(len(tokens))), {}, -1
    while left_items:
        number, left, at = number + 1, list(limit), 0
        while True:
            fits = [k for k in left_items if all(s <= r for s, r in zip(size[k], left))]
            if not fits:
                break
            worth = lambda k: float(np.array(size[k]) / np.array(limit) @ (np.array(left) / np.array(limit)))
            best = max(fits, key=lambda k: (round(worth(k), 12), size[k][0], size[k][1], -k))
            out[best] = (number, at)
            at += size[best][0]
            left = [r - s for r, s in zip(left, size[best])]
            left_items.remove(best)
    return [out[k] for k in range(len(tokens))]


def test_placing_equals_the_heuristic_item_by_item():
    rng = np.random.default_rng(2)
    for limits in ((64, 5, 40), (100, 50, 97), (30, 2, 30)):
        tokens = rng.integers(1, 30, 120)
        loss = np.minimum(tokens, rng.integers(0, 30, 120))
        sequence, offset = vector_packing.place(tokens, loss, *limits)
        assert list(zip(sequence.tolist(), offset.tolist())) == plain_place(tokens.tolist(), loss.tolist(), limits)


# --------------------------------------------------------------------------- the pipeline


def test_pipeline_takes_nulls_empty_texts_repeated_rows_and_any_columns(spark, tmp_path):
    import corpus_pipeline as P
    from quayside.llm import boosted_quality, line_rules

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    extra = [(9001, None, "en", "s", 0), (9002, "", None, None, None), (9003, " \n\t", "en", "s", 3), (None, None, None, None, None)]
    df = spark.createDataFrame([(*r, k, k, k) for k, r in enumerate(rows + rows[:25] + extra)],
                               "doc_id long, text string, lang string, source string, n_chars long, __rid int, rules int, __score int").repartition(3)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    docs, sf_dir = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)
    model = boosted_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    good = boosted_quality.score(docs, model, name="s").filter("s >= 0.7").drop("s")
    first = P.quality_classifier(spark, docs, sf_dir)
    assert first.columns == docs.columns and sorted(map(str, first.collect())) == sorted(map(str, good.collect()))
    ruled = line_rules.measure(good, into="r").filter("r.kept").drop("r")
    second = P.quality_rules(spark, first, sf_dir)
    assert second.columns == docs.columns and sorted(map(str, second.collect())) == sorted(map(str, ruled.collect()))
    third = P.ngram_jaccard_join(spark, second, sf_dir)
    kept = third.collect()
    assert third.columns == docs.columns and {str(r) for r in kept} <= {str(r) for r in second.collect()}
    assert len({r.doc_id for r in kept}) == len(kept) > 10  # of repeated rows one stays
    pieces = P.run(spark, sf_dir).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in kept}


# --------------------------------------------------------------------------- shards


def test_shards_do_not_depend_on_partitions(spark):
    rows = [(k % 300, f"text {k % 280}", f"s{k % 3 if k % 5 else 0}", 1) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, slot int")
    one, many = ({(r.doc_id, r.text_crc32, r.shard, r.slot) for r in mixture_shards.interleave(df.repartition(n), 7).collect()} for n in (1, 9))
    assert one == many and len(one) == 600


# --------------------------------------------------------------------------- licences

MIT = """MIT License

Copyright (c) 2020 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD3 = """BSD 3-Clause License

Copyright (c) 2019, Jane Roe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
ISC = """ISC License

Copyright (c) 2021, Jane Roe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.
"""
GPL3 = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""
LGPL = """ * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 *
 * This library is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
 * Lesser General Public License for more details.
 *
 * You should have received a copy of the GNU Lesser General Public
 * License along with this library; if not, write to the Free Software
 * Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301  USA
"""
MPL = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""
APACHE = """# Copyright 2020 Jane Roe
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
"""
APACHE_TEXT = """                                 Apache License
                           Version 2.0, January 2004
                        http://www.apache.org/licenses/

   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION

   1. Definitions.

      "License" shall mean the terms and conditions for use, reproduction,
      and distribution as defined by Sections 1 through 9 of this document.

   2. Grant of Copyright License. Subject to the terms and conditions of
      this License, each Contributor hereby grants to You a perpetual,
      worldwide, non-exclusive, no-charge, royalty-free, irrevocable
      copyright license to reproduce, prepare Derivative Works of,
      publicly display, publicly perform, sublicense, and distribute the
      Work and such Derivative Works in Source or Object form.

   END OF TERMS AND CONDITIONS

   APPENDIX: How to apply the Apache License to your work.
""" + APACHE.replace("#", "  ")
GPL_TEXT = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

  "This License" refers to version 3 of the GNU General Public License.

                     END OF TERMS AND CONDITIONS
"""


@pytest.mark.parametrize("text, licence, kind", [
    (MIT, "MIT", "permissive"), (BSD3, "BSD-3-Clause", "permissive"), (ISC, "ISC", "permissive"), (GPL3, "GPL-3.0-or-later", "copyleft"),
    (GPL3.replace("software: you", "software; you").replace("Foundation, either version 3", "Foundation; either version 2"), "GPL-2.0-or-later", "copyleft"),
    (GPL3.replace("GNU General", "GNU Affero General"), "AGPL-3.0-or-later", "copyleft"), (LGPL, "LGPL-2.1-or-later", "copyleft"),
    (MPL, "MPL-2.0", "copyleft"), (APACHE, "Apache-2.0", "permissive"), (APACHE_TEXT, "Apache-2.0", "permissive"), (GPL_TEXT, "GPL-3.0-only", "copyleft"),
    (BSD3[:BSD3.index("3. Neither")] + BSD3[BSD3.index("THIS SOFTWARE"):], "BSD-2-Clause", "permissive")])
def test_known_licences_add_nothing_unknown(text, licence, kind):
    rules = licence_scan.SentenceRules()
    assert rules.scan(text)[1:] == ([licence], kind)
    assert rules.scan("Some words before.\n\n" + text + "\nSome words behind.")[1:] == ([licence], kind)


def test_what_stands_beside_a_licence_still_counts():
    rules = licence_scan.SentenceRules()
    assert rules.scan("Copyright 2020 X. All rights reserved.")[1:] == (["all-rights-reserved"], "restricted")
    assert rules.scan(APACHE_TEXT + MIT)[1:] == (["Apache-2.0", "MIT"], "permissive")
    assert rules.scan(MIT + "You may use this only under the license of my cat.")[1:] == (["MIT", "unknown"], "unknown")
