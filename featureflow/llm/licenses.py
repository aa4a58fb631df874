"""License scans: normalised text compared with license templates by the Dice coefficient over word bigrams, by lines,
whole texts and sliding word windows. DataFrame functions only; every document is judged where it stands, without a shuffle."""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from featureflow.llm.common import LiteralMap, c, fresh, let, text_of

AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
BSD_START = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
             "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
             "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
             "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
BSD_END = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
           "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
           "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
           "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
           "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
           "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
           "POSSIBILITY OF SUCH DAMAGE.")

# Public license notices (fixed values), by SPDX name.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions:"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                     "following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                "version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    # Full texts of the short licenses; of the long ones the opening passage.
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
            "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
            "shall be included in all copies or substantial portions of the Software. " + AS_IS + "FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
            "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS "
            "IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
            "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
            "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
            "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-3-Clause", BSD_START + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission. " + BSD_END),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, "
                   "AND DISTRIBUTION 1. Definitions."),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. Everyone is "
                "permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. \"Contributor\" means each individual or legal entity that "
                "creates, contributes to the creation of, or owns Covered Software."),
]

GAP = r"[^\p{L}\p{N}]+"


def bigrams(text: str) -> list[str]:
    """Distinct word bigrams of a normalised template."""
    w = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def _least_common(size: int, threshold: float) -> int:
    """Distinct template bigrams that any unit of at least ``threshold`` has: it has a or more distinct bigrams of its own."""
    return max(1, math.ceil(size * threshold / (2 - threshold) - 1e-6))


def _anchors(grams: list[list[str]], threshold: float) -> list[str]:
    """Words of which every text that matches a template holds one: so many of a template's bigrams hold such a word that
    the others are fewer than a match needs. Long words first taken, as they are rare."""
    open_ = [(set(g), len(g) - _least_common(len(g), threshold) + 1) for g in grams]
    out = []
    while open_ := [(g, n) for g, n in open_ if n > 0]:
        gain = Counter()
        for g, n in open_:
            for w, k in Counter(w for x in g for w in set(x.split(" "))).items():
                gain[w] += min(k, n) / n
        word = max(gain, key=lambda w: (gain[w] * (len(w) > 4 or w == "mit" or w == "cc"), gain[w], w))
        out.append(word)
        open_ = [({x for x in g if word not in x.split(" ")}, n - sum(word in x.split(" ") for x in g)) for g, n in open_]
    return sorted(out)


def find_licenses(docs: DataFrame, text_col: str = "text", out: str = "licenses", threshold: float = 0.8, templates=None) -> DataFrame:
    """``docs`` with an array ``out`` of structs name, dice, line: every license with a match of at least ``threshold``,
    by its best match, the best license first. Line is where the match begins (from 0; -1: the whole text).

    Besides the units of ``scan_licenses`` sliding word windows are compared, across line breaks: from each template
    bigram in the text to a later one, where the window has enough template bigrams for the threshold in at most
    (2 - t) / t times the template's words. Of one start's windows the one whose counts with repeats promise most is
    compared by its distinct bigrams. A window goes where a better one of another license overlaps it (the notices
    of one family are alike); the best unit stays. Texts without a word that every match must hold are left out before. Ties
    go to the whole text, then the first line, then the name's order. Null and empty texts have an empty array.
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    known = [(n, bigrams(t), len([x for x in re.split(r"[\W_]+", t) if x]) - 1) for n, t in templates or TEMPLATES]
    known = [k for k in known if k[1]]
    where: dict = {}
    for no, (_, g, _) in enumerate(known):
        for x in g:
            where.setdefault(x, []).append(no)
    lookup = LiteralMap(where, "array<int>")
    tables = [{"no": no, "name": n, "size": len(g), "need": _least_common(len(g), threshold),
               "length": length, "reach": int((2 - threshold) / threshold * length + 1e-6),
               "grams": g} for no, (n, g, length) in enumerate(known)]
    table = F.from_json(F.lit(json.dumps(tables)), "array<struct<no:int,name:string,size:int,need:int,length:int,reach:int,grams:array<string>>>")
    unit, w, g, hit = fresh(docs, "unit_", "words_", "grams_", "hits_")
    d = scan_licenses(docs, text_col, unit, threshold, templates)
    t = text_of(c(text_col))
    rx = r"(?<![\p{L}\p{N}])(?:" + "|".join(re.escape(x) for x in _anchors([k[1] for k in known], threshold)) + r")(?![\p{L}\p{N}])"
    norm = lambda x: F.filter(F.split(F.regexp_replace(F.lower(x), GAP, " "), " "), lambda y: y != "")
    lines = F.transform(F.split(t, "\n"), lambda x, i: F.transform(norm(x), lambda y: F.struct(i.alias("line"), y.alias("w"))))
    none = F.array().cast("array<struct<line:int,w:string>>")
    d = d.withColumn(w, F.when(F.lower(t).rlike(rx), F.flatten(lines)).otherwise(none))
    pair = lambda i: F.concat(F.get(c(w), i)["w"], F.lit(" "), F.get(c(w), i + 1)["w"])
    grams = F.transform(F.sequence(F.lit(0), F.size(c(w)) - 2), pair)
    d = d.withColumn(g, F.when(F.size(c(w)) > 1, grams).otherwise(F.array().cast("array<string>")))
    at = lambda tab: F.transform(c(g), lambda x, i: F.struct(i.alias("i"), lookup.get(tab, x).alias("ks")))
    d = d.withColumn(hit, F.when(F.size(c(g)) > 0, F.filter(let(lookup.table, at), lambda x: x["ks"].isNotNull())))

    spot = "array<struct<dice:double,back:int,name:string,p:int,q:int>>"

    def windows(k):
        def starts(ps):
            def best(p, j):
                ends = F.filter(F.slice(ps, j + k["need"], k["reach"]), lambda q: q - p < k["reach"])
                score = F.transform(ends, lambda q, m: F.struct((F.least(m + k["need"], k["length"]) / (q - p + 1 + k["length"])).alias("s"), (-q).alias("q")))
                return F.struct(p.alias("p"), (-F.array_max(score)["q"]).alias("q"))
            near = F.filter(F.transform(ps, best), lambda x: x["q"].isNotNull())

            def match(x):
                dice = let(F.array_distinct(F.slice(c(g), x["p"] + 1, x["q"] - x["p"] + 1)), lambda y: _dice(y, k))
                return F.struct(dice.alias("dice"), (-F.get(c(w), x["p"])["line"]).alias("back"), k["name"].alias("name"),
                                x["p"].alias("p"), x["q"].alias("q"))
            return F.transform(near, match)
        ps = F.transform(F.filter(c(hit), lambda x: F.array_contains(x["ks"], k["no"])), lambda x: x["i"])
        return F.when(F.size(ps) >= k["need"], let(ps, starts)).otherwise(F.array().cast(spot))
    found = F.when(F.size(c(hit)) > 0, F.filter(let(table, lambda ts: F.flatten(F.transform(ts, windows))), lambda m: m["dice"] >= threshold))
    d = d.withColumn(hit, F.coalesce(found, F.array().cast(spot)))
    better = lambda m, o: (o["name"] != m["name"]) & (o["dice"] > m["dice"]) & (o["p"] <= m["q"]) & (m["p"] <= o["q"])
    alone = F.filter(c(hit), lambda m: ~F.exists(c(hit), lambda o: better(m, o)))
    plain = F.transform(alone, lambda m: F.struct(m["dice"].alias("dice"), m["back"].alias("back"), m["name"].alias("name")))
    one = F.when(c(unit).isNotNull(), F.array(F.struct(c(unit)["dice"].alias("dice"), (-c(unit)["line"]).alias("back"), c(unit)["name"].alias("name"))))
    d = d.withColumn(hit, F.concat(plain, F.coalesce(one, F.array().cast("array<struct<dice:double,back:int,name:string>>"))))
    names = F.array_distinct(F.transform(c(hit), lambda m: m["name"]))
    top = F.transform(names, lambda n: F.array_max(F.filter(c(hit), lambda m: m["name"] == n)))
    ranked = F.reverse(F.array_sort(top))
    res = F.transform(ranked, lambda m: F.struct(m["name"].alias("name"), m["dice"].alias("dice"), (-m["back"]).alias("line")))
    return d.withColumn(out, res).drop(unit, w, g, hit)


def scan_licenses(docs: DataFrame, text_col: str = "text", out: str = "license", threshold: float = 0.8, templates=None) -> DataFrame:
    """``docs`` with a struct ``out``: name, dice and line (from 0; -1: the whole text) of the best template match
    of at least ``threshold``, or null without one.

    Units are the lines of a text and the text as a whole, normalised to lower-case words. Size bounds prune: with
    a and b distinct bigrams, Dice is at most 2 min(a, b) / (a + b), so only templates of t / (2 - t) to (2 - t) / t
    times a unit's size are compared; a unit with more distinct words than any template could bear is dropped
    before its bigrams are made. Ties go to the first line, then the name's order. Null and empty texts match
    nothing; ids, repeated rows and extra columns don't matter; an empty table gives an empty result.
    Notices wrapped or inside longer lines are no units: ``find_licenses`` finds them as well.
    """
    if out.lower() in (n.lower() for n in docs.columns):
        raise ValueError(f"column {out} exists")
    known = [{"name": n, "size": len(g), "grams": g} for n, g in ((n, bigrams(t)) for n, t in templates or TEMPLATES) if g]
    table = F.from_json(F.lit(json.dumps(known)), "array<struct<name:string,size:int,grams:array<string>>>")
    small = threshold / (2 - threshold) * min(k["size"] for k in known) - 1e-6
    large = (2 - threshold) / threshold * max(k["size"] for k in known) + 1e-6
    u, g = fresh(docs, "units_", "grams_")
    t = text_of(c(text_col))
    norm = lambda x: F.split(F.btrim(F.regexp_replace(F.lower(x), GAP, " ")), " ")
    line = F.transform(F.split(t, "\n"), lambda x, i: F.struct(i.alias("line"), norm(x).alias("w")))
    whole = F.when(F.instr(t, "\n") > 0, F.array(F.struct(F.lit(-1).alias("line"), norm(t).alias("w"))))
    fits = lambda x: (F.size(x["w"]) - 1 >= small) & (F.size(F.array_distinct(x["w"])) - 1 <= large)
    units = F.filter(F.concat(line, F.coalesce(whole, F.array().cast("array<struct<line:int,w:array<string>>>"))), fits)

    def grams(x):
        pairs = F.transform(F.sequence(F.lit(0), F.size(x["w"]) - 2), lambda i: F.concat(F.get(x["w"], i), F.lit(" "), F.get(x["w"], i + 1)))
        return F.struct(x["line"].alias("line"), F.array_distinct(pairs).alias("g"))

    def matches(ts):
        def per_unit(x):
            most = lambda k: F.lit(2.0) * F.least(k["size"], F.size(x["g"])) / (F.size(x["g"]) + k["size"])
            near = F.filter(ts, lambda k: most(k) >= threshold)
            return F.transform(near, lambda k: F.struct(_dice(x["g"], k).alias("dice"), (-x["line"]).alias("back"), k["name"].alias("name")))
        return F.flatten(F.transform(c(g), per_unit))
    d = docs.withColumn(u, units).withColumn(g, F.filter(F.transform(c(u), grams), lambda x: F.size(x["g"]) >= small))
    best = F.array_max(F.filter(let(table, matches), lambda m: m["dice"] >= threshold))
    d = d.withColumn(g, best)
    res = F.when(c(g).isNotNull(), F.struct(c(g)["name"].alias("name"), c(g)["dice"].alias("dice"), (-c(g)["back"]).alias("line")))
    return d.withColumn(out, res).drop(u, g)


def _dice(grams: Column, template: Column) -> Column:
    return F.lit(2.0) * F.size(F.array_intersect(grams, template["grams"])) / (F.size(grams) + template["size"])
