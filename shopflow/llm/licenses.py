"""License scans: Dice coefficient over word bigrams against licence templates.

Lines, paragraphs and the whole text are normalised to words (A-Z lower-cased, all but
a-z, 0-9 cut) and become sets of word bigrams. Dice(A, B) = 2|A & B| / (|A| + |B|) cannot
reach t unless |A| lies between t/(2-t) and (2-t)/t times |B|, so a segment is compared
only with templates of such a size. It also needs t/(2-t) of |B| to be shared, so one of any
larger rest of B's bigrams: a segment that holds none of the marked bigrams of any template
is not compared at all.

Notices often stand right above other text. Texts with a marked bigram are also read by
windows, runs of neighbouring lines within a paragraph; of these the best one per licence
counts, and only where it is better than every other segment found for that licence.
"""

import json
import math

from pyspark.sql import DataFrame, functions as F

SIMILARITY = 0.8

# Notices and texts of public licences.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
        "agreed to in writing, software distributed under the License is distributed on an "
        "AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
        "SPDX-License-Identifier: MIT",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the "
        "terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-only",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "BSD-2-Clause": [
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose "
        "with or without fee is hereby granted, provided that the above copyright notice and "
        "this permission notice appear in all copies.",
    ],
    "CC0-1.0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or "
        "neighboring rights to this work.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
    "Proprietary": [
        "All rights reserved.",
    ],
}


def _add(name, *texts):
    """Texts of a licence that are not listed yet."""
    known = TEMPLATES.setdefault(name, [])
    known += [text for text in texts if text not in known]


# GNU licences differ by a word or a number only, so each needs every wording.
for _name, _title, _version in [
    ("GPL-3.0", "General Public License", "3"),
    ("GPL-2.0", "General Public License", "2"),
    ("LGPL-3.0", "Lesser General Public License", "3"),
    ("LGPL-2.1", "Lesser General Public License", "2.1"),
    ("AGPL-3.0", "Affero General Public License", "3"),
]:
    _add(
        _name,
        f"This work is licensed under the GNU {_title}, version {_version}.",
        f"Licensed under the GNU {_title}, version {_version}.",
        *[f"SPDX-License-Identifier: {_name}{end}" for end in ("-only", "-or-later", "")])
    for _thing in ("program", "library"):
        _header = (f"This {_thing} is free software: you can redistribute it and/or modify it under the "
                   f"terms of the GNU {_title} ")
        _add(
            _name,
            _header + "as published by the Free Software Foundation, either version "
            f"{_version} of the License, or (at your option) any later version.",
            _header + f"version {_version} as published by the Free Software Foundation.")

# Creative Commons licences differ by version and by the area they were written for.
for _short, _title in [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
                       ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives")]:
    for _version, _area in [("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")]:
        _add(
            f"CC-{_short}-{_version}",
            f"Licensed under CC {_short} {_version}.",
            f"This work is licensed under a Creative Commons {_title} {_version} {_area} License.",
            f"This work is licensed under a Creative Commons {_title} {_version} License.",
            f"Licensed under Creative Commons {_title} {_version}.",
            f"SPDX-License-Identifier: CC-{_short}-{_version}")

for _name in ["MPL-2.0", "ISC", "CC0-1.0", "Unlicense"]:
    _add(_name, f"SPDX-License-Identifier: {_name}")
for _name, _title in [
    ("Apache-2.0", "Apache License, Version 2.0"), ("MIT", "MIT License"), ("ISC", "ISC License"),
    ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-2-Clause", "BSD 2-Clause License"),
    ("MPL-2.0", "Mozilla Public License, version 2.0"),
]:
    _add(_name, *[f"{verb} under the {_title}." for verb in ("Released", "Licensed", "This work is licensed")])

# The parts of the MIT, ISC and BSD licences.
_NOTICE = ("The above copyright notice and this permission notice shall be included in all copies or "
           "substantial portions of the Software.")
_MIT_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_TERMS = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met:")
_BSD_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with "
    "the distribution.")
_BSD_THIRD = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
              "or promote products derived from this software without specific prior written permission.")
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")

# Parts that several licences share name none of them; whole texts and clauses of their own do.
_add("MIT", f"MIT License {TEMPLATES['MIT'][2]} {_NOTICE} {_MIT_WARRANTY}")
_add("ISC", f"ISC License {TEMPLATES['ISC'][0]} {_ISC_WARRANTY}")
_add("BSD-3-Clause", _BSD_THIRD, f"{_BSD_TERMS} {_BSD_CLAUSES} 3. {_BSD_THIRD}",
     f"{_BSD_TERMS} {_BSD_CLAUSES} 3. {_BSD_THIRD} {_BSD_WARRANTY}")
_add("BSD-2-Clause", f"{_BSD_TERMS} {_BSD_CLAUSES} {_BSD_WARRANTY}")
_add("BSD", _BSD_TERMS, f"{_BSD_TERMS} {_BSD_CLAUSES}")

WINDOW_LINES = 14  # of a window, at most; longer notices are whole paragraphs or texts
BITMAP_BITS = 1 << 16


_SIGNS = "".join(c for c in map(chr, range(1, 128)) if not c.isalnum() and c not in " \n")
_FROM = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _SIGNS
_TO = "abcdefghijklmnopqrstuvwxyz" + " " * len(_SIGNS)


def _lines_of_words(text):
    """An array of lines, each an array of words, of a text column."""
    # Signs of ASCII are mapped one by one; an expression would find a match at every blank.
    flat = F.regexp_replace(F.translate(text, _FROM, _TO), "[^\\x01-\\x7f]+", " ")
    return F.transform(F.split(flat, "\n", -1), lambda line: F.filter(
        F.split(line, " ", -1), lambda word: word != ""))


_NO_GRAMS = "array<bigint>"


def _empty(kind):
    return F.expr("array()").cast(kind)


def _let(value, body):
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pairs(words):
    """The bigrams of an array of words, as hashes, in order."""
    n = F.size(words)
    pairs = F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1),
                       lambda a, b: F.xxhash64(a, b))
    return F.when(n >= 2, pairs).otherwise(_empty(_NO_GRAMS))


def _bigrams(words):
    """The distinct bigrams of an array of words, as hashes."""
    return F.array_distinct(_pairs(words))


def _bitmap(grams):
    """A literal set of hashes: never misses one, lets a small share of others pass."""
    words = [0] * (BITMAP_BITS // 64)
    for gram in grams:
        spot = gram % BITMAP_BITS
        words[spot // 64] |= 1 << (spot % 64)
    signed = [w - (1 << 64) if w >> 63 else w for w in words]
    return F.from_json(F.lit(json.dumps(signed)), _NO_GRAMS)


def _holds(bitmap, gram):
    spot = F.pmod(gram, F.lit(BITMAP_BITS)).cast("int")
    return F.getbit(F.get(bitmap, F.shiftright(spot, 6)), F.pmod(spot, F.lit(64))) == 1


def _hashed(spark, templates, similarity):
    """Templates as an array literal (name, number in the list, size, bigrams), their sizes,
    and literal bitmaps of their marked bigrams and of all bigrams."""
    rows = [(name, i, text) for i, (name, text) in enumerate(
        (name, text) for name, texts in templates.items() for text in texts)]
    words = F.flatten(_lines_of_words(F.col("text")))
    found = [r.asDict() for r in spark.createDataFrame(rows, "name string, number int, text string").select(
        "name", "number", words.alias("words"), _bigrams(words).alias("grams")).collect() if r.grams]
    found.sort(key=lambda r: r["number"])
    marked = set()
    for r in found:
        pairs = list(dict.fromkeys(zip(r["words"], r.pop("words")[1:])))  # in the order of the bigrams
        shared = math.ceil(similarity / (2 - similarity) * len(pairs) - 1e-9)
        # Long words are rare ones: any len - shared + 1 bigrams would do.
        rare = sorted(zip(pairs, r["grams"]), key=lambda x: (-sum(map(len, x[0])), x[0]))
        marked.update(gram for _, gram in rare[:len(pairs) - shared + 1])
        r["size"] = len(pairs)
    schema = "array<struct<name:string,number:int,size:int,grams:array<bigint>>>"
    return (F.from_json(F.lit(json.dumps(found)), schema), [r["size"] for r in found],
            _bitmap(marked), _bitmap({gram for r in found for gram in r["grams"]}))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict = None, similarity: float = SIMILARITY) -> DataFrame:
    """``id_col`` and ``matches``: array of (segment, position, name, number, dice, shared).

    ``segment`` is ``line``, ``paragraph`` (of two lines or more, between blank lines),
    ``text`` (of two paragraphs or more) or ``window`` (2 to WINDOW_LINES lines of a
    paragraph); ``position`` counts from 0, of a window in lines. ``shared`` is the number of
    common bigrams. A segment gives its
    best template of ``similarity`` or more; ties go to the template listed first
    (``number``). ``templates`` maps names to lists of texts, a list fit for a literal.

    One row per row of ``docs``, repeated rows and null ids included; a null or empty
    text, or one without a segment of two words, has no match; other columns are ignored.
    No shuffle: every text is judged where it is read.
    """
    known, sizes, marked, every = _hashed(docs.sparkSession, templates or TEMPLATES, similarity)
    low, high = similarity / (2 - similarity), (2 - similarity) / similarity
    least, most = min(sizes) * low, max(sizes) * high

    def best(segment):
        size = F.size(segment["grams"])
        fitting = F.filter(known, lambda t: (size >= t["size"] * low) & (size <= t["size"] * high))
        scored = F.transform(fitting, lambda t: F.struct(
            F.size(F.array_intersect(segment["grams"], t["grams"])).alias("shared"),
            t["size"].alias("n"), t["number"].alias("number"), t["name"].alias("name")))
        return F.array_max(F.transform(scored, lambda x: F.struct(
            (F.lit(2.0) * x["shared"] / (size + x["n"])).alias("dice"),
            (-x["number"]).alias("first"), x["name"].alias("name"), x["shared"].alias("shared"))))

    def fits(segment):
        size = F.size(segment["grams"])
        return (size >= least) & (size <= most)

    segment_type = "array<struct<segment:string,position:int,grams:array<bigint>>>"
    split = docs.select(F.col(id_col), _lines_of_words(
        F.coalesce(F.col(text_col), F.lit(""))).alias("lines"))

    def next_line(i):
        """The next line with words; texts seldom have many blank lines in a row."""
        def found(rest, otherwise):
            return _let(F.filter(rest, lambda line: F.size(line) > 0),
                        lambda x: F.when(F.size(x) > 0, F.get(x, F.lit(0))).otherwise(otherwise))

        near = F.get("lines", i + 1)
        far = found(F.slice("lines", i + 3, F.size("lines")), F.lit(None).cast("array<string>"))
        return F.when(F.size(near) != 0, near).otherwise(found(F.slice("lines", i + 3, 8), far))

    # Flags of a line: a marked bigram in it or across its end, whether any bigram of a
    # template lies across its end, how many lie in it, and how many different ones in it
    # belong to no template.
    def flags(line, i):
        after = next_line(i)
        across = F.when((F.size(line) > 0) & (F.size(after) > 0), F.xxhash64(F.element_at(line, -1), F.get(after, F.lit(0))))
        return _let(F.struct(_pairs(line).alias("grams"), across.alias("across")), lambda x: _let(
            F.filter(x["grams"], lambda g: _holds(every, g)), lambda inside: F.struct(
                (F.size(line) == 0).alias("blank"),
                F.exists(inside, lambda g: _holds(marked, g)).alias("marked"),
                F.coalesce(_holds(marked, x["across"]), F.lit(False)).alias("marked_across"),
                F.coalesce(_holds(every, x["across"]), F.lit(False)).alias("across"),
                F.size(inside).alias("known"),
                F.when(F.size(inside) > 0, F.size(F.array_distinct(F.filter(x["grams"], lambda g: ~_holds(every, g)))))
                .otherwise(F.size(F.array_distinct(x["grams"]))).alias("other"))))

    # Only texts with a marked bigram are compared with templates at all.
    flagged = split.select(id_col, "lines", F.transform("lines", flags).alias("flags"))
    size = F.size("lines")
    spent = 2 * (1 - similarity) / similarity  # other bigrams per shared one, at most

    def may_fit(known, other):
        """Whether lines could be similar to a template: ``known`` bigrams of templates they
        hold at most, ``other`` different ones at least."""
        return other <= known * spent + 1e-9

    def segment(kind, position, words):
        return F.struct(F.lit(kind).alias("segment"), position.cast("int").alias("position"), _bigrams(words).alias("grams"))

    def window_fits(i, k):
        own = F.slice("flags", i + 1, k)
        known = F.aggregate(own, F.lit(0), lambda n, f: n + f["known"] + 1)
        return may_fit(known, F.array_max(F.transform(own, lambda f: f["other"])))

    def windows_from(i):
        longest = F.least(F.lit(WINDOW_LINES), size - i)
        sizes = F.when(longest >= 2, F.sequence(F.lit(2), longest)).otherwise(_empty("array<int>"))
        # A line at either end that shares nothing would only lower the coefficient.
        sizes = F.filter(sizes, lambda k: (
            (F.get("flags", i + k - 1)["known"] > 0) | F.get("flags", i + k - 2)["across"]) & window_fits(i, k))
        runs = F.transform(sizes, lambda k: F.slice("lines", i + 1, k))
        runs = F.filter(runs, lambda run: ~F.exists(run, lambda line: F.size(line) == 0))
        return F.transform(runs, lambda run: _let(F.flatten(run), lambda words: segment("window", i, words)))

    starts = F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), lambda i: (
        (F.get("flags", i)["known"] > 0) | F.get("flags", i)["across"]) & F.exists(
        F.slice("flags", i + 1, WINDOW_LINES), lambda f: f["marked"] | f["marked_across"]))

    # Paragraphs: fold lines into (first line, number of lines) of those that may fit.
    def closed(acc):
        fit = (acc["n"] >= 2) & may_fit(acc["known"], acc["other"])
        own = F.struct((acc["at"] - acc["n"]).alias("at"), acc["n"].alias("n"), acc["nr"].alias("nr"))
        return F.when(fit, F.concat(acc["done"], F.array(own))).otherwise(acc["done"])

    def state(done, at, n, nr, known, other):
        return F.struct(done.alias("done"), at.alias("at"), n.alias("n"), nr.alias("nr"),
                        known.alias("known"), other.alias("other"))

    def step(acc, f):
        return F.when(f["blank"], state(
            closed(acc), acc["at"] + 1, F.lit(0), acc["nr"] + F.when(acc["n"] >= 2, 1).otherwise(0), F.lit(0), F.lit(0))
        ).otherwise(state(acc["done"], acc["at"] + 1, acc["n"] + 1, acc["nr"], acc["known"] + f["known"] + 1,
                          F.greatest(acc["other"], f["other"])))

    zero = F.lit(0)
    begin = state(_empty("array<struct<at:int,n:int,nr:int>>"), zero, zero, zero, zero, zero)
    paragraphs = F.transform(F.aggregate("flags", begin, step, closed), lambda x: _let(
        F.flatten(F.slice("lines", x["at"] + 1, x["n"])), lambda words: segment("paragraph", x["nr"], words)))
    whole = F.when(
        F.exists("flags", lambda f: f["blank"]) & may_fit(
            F.aggregate("flags", F.lit(0), lambda n, f: n + f["known"] + 1), F.array_max(F.transform("flags", lambda f: f["other"]))),
        F.array(segment("text", F.lit(0), F.flatten("lines")))).otherwise(_empty(segment_type))
    single = F.transform(
        F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), lambda i: F.get("flags", i)["marked"] & may_fit(
            F.get("flags", i)["known"], F.get("flags", i)["other"])),
        lambda i: segment("line", i, F.get("lines", i)))
    cut = flagged.select(id_col, F.when(
        F.exists("flags", lambda f: f["marked"] | f["marked_across"]), F.struct(
            F.filter(F.concat(*[x.cast(segment_type) for x in (single, paragraphs, whole)]), fits).alias("segments"),
            F.filter(F.flatten(F.transform(starts, windows_from)).cast(segment_type), fits).alias("windows"))).alias("found"))

    def judged(found):
        """Segments with their best template, where it is similar enough."""
        scored = F.transform(found, lambda s: F.struct(
            s["segment"].alias("segment"), s["position"].alias("position"), best(s).alias("best")))
        return F.transform(F.filter(scored, lambda s: s["best"]["dice"] >= similarity), lambda s: F.struct(
            s["segment"].alias("segment"), s["position"].alias("position"), s["best"]["name"].alias("name"),
            (-s["best"]["first"]).alias("number"), s["best"]["dice"].alias("dice"), s["best"]["shared"].alias("shared")))

    nothing = _empty(segment_type)
    scored = cut.select(id_col, judged(F.coalesce("found.segments", nothing)).alias("plain"),
                        judged(F.coalesce("found.windows", nothing)).alias("windows"))

    def better(w):
        """Better than all other segments of the licence, and the first of equally good windows."""
        return ~F.exists("plain", lambda s: (s["name"] == w["name"]) & (s["dice"] >= w["dice"])) & ~F.exists(
            "windows", lambda v: (v["name"] == w["name"]) & (F.struct(-v["dice"], v["position"], v["shared"], v["number"])
                                                            < F.struct(-w["dice"], w["position"], w["shared"], w["number"])))

    return scored.select(id_col, F.concat("plain", F.array_distinct(F.filter("windows", better))).alias("matches"))


def summary(docs: DataFrame) -> DataFrame:
    """The licence with most evidence in every document, its Dice coefficient, all names found.

    Most evidence is the match that shares most bigrams with its template, then the most
    similar one, then the template listed first: a whole licence tells more than a sentence.
    """
    top = F.array_max(F.transform("matches", lambda m: F.struct(
        m["shared"].alias("shared"), m["dice"].alias("dice"), (-m["number"]).alias("first"), m["name"].alias("name"))))
    names = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["name"])))
    return scan(docs).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        top["name"].alias("license"), top["dice"].alias("dice"),
        F.array_join(names, ",").alias("licenses"))
