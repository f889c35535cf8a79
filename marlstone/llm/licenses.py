"""Licence families of paragraphs, by a trained classifier and a comparison with templates, in DataFrame operations only.

A sparse multinomial logistic regression on word unigrams and bigrams is fitted on the driver from the constant notices
below, cut into pieces, against an unknown class of ordinary and licence-like sentences and licences without a family
here; a temperature and the unknown class's offset are calibrated on other notices (HELD), none of which is fitted on. Its
weights are a literal of bounded size, in buckets by the n-gram's checksum. Looked at are all lines, and all paragraphs
(lines up to a blank one) of several lines, joined, so that wrapped notices count. Either counts as family f if f is the
likeliest class, with probability LEAST or more, and the templates say so in both directions: it holds SHARE or more of
the words of one of f's notices (all, of notices under WHOLE words), and of its own words that mark few families (FEW or less have them) no other family
accounts for more than f does. A paragraph only counts if none of its own lines has family f, and a line that holds no
notice in full gives way to a paragraph of another family. Texts and lines without
anchor or any word of _needed() are passed over: whatever holds SHARE of a notice's words holds one of them.

Every document is one row, without any shuffle. Rows: null and empty texts have no families; ids may be null or repeated;
repeated lines count each time; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 0.5
SHARE = 0.6
WHOLE = 5  #: notices of fewer words count only in full
FEW = 3  #: families that a marking word may have
BUCKETS = 1024  #: of the weights
ANCHORS = ("licen", "copyright", "warrant", "permission", "redistribut")

#: Notices as licences word them.
NOTICES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "GNU General Public License",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "GNU Lesser General Public License",
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ),
    "agpl": (
        "GNU Affero General Public License",
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "bsd": (
        "BSD License",
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ),
    "isc": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "SPDX-License-Identifier: ISC",
    ),
    "boost": (
        "Boost Software License",
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ),
    "mpl": (
        "Mozilla Public License",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "epl": (
        "Eclipse Public License",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0",
    ),
    "cc-by-nc": (
        "Creative Commons Attribution-NonCommercial License",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-sa": (
        "Creative Commons Attribution-ShareAlike License",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nd": (
        "Creative Commons Attribution-NoDerivatives License",
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc-by": (
        "Creative Commons Attribution License",
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "proprietary": (
        "Copyright. All rights reserved. No part of this document may be reproduced without written permission.",
        "Proprietary and confidential. Unauthorised copying of this file is prohibited without the permission of the copyright holder.",
        "All rights reserved.",
    ),
}
#: The unknown class.
OTHERS = (
    "The driver lost his licence after the third offence.", "She asked for permission to leave the room.", "The warranty covers parts and labour for two years.",
    "A new version of the programme was shown in public last week.", "The general spoke about freedom and the work of the foundation.", "You can use this path if you want to get a copy of the book.",
    "Copyright law was debated in parliament.", "The terms of the agreement were published by the office.", "He was granted a fishing licence free of charge.", "Wealth can be redistributed through taxes.",
    "Software is written by people and distributed in many forms.", "The following conditions were met without any change.", "International attribution of the painting is in doubt.", "No rights were reserved for later use.",
    "The source of the river is in the hills, and the code of the town is old.", "Any person may attend, with or without a guest.",
    "Licensed under the European Union Public Licence, version 1.2.", "This software is provided as is, without any express or implied warranty; in no event will the authors be held liable for any damages.",
    "This is free and unencumbered software released into the public domain.", "Licensed under the Artistic License 2.0.", "Licensed under the Open Software License version 3.0.",
)
#: Other wordings, for calibration alone.
HELD = {
    "apache-2.0": ("This project is licensed under the terms of the Apache License 2.0.", "Apache License Version 2.0, January 2004"),
    "mit": ("The code is available under the MIT License, see the file LICENSE.", "MIT licensed"),
    "gpl": ("This software is distributed under the terms of the GNU General Public License version 2 or later.", "Released under the GNU GPL, the General Public License."),
    "lgpl": ("The library is distributed under the GNU Lesser General Public License, either version 3 or any later version.",),
    "agpl": ("The server is free software under the terms of the GNU Affero General Public License.",),
    "bsd": ("This project uses the BSD 2-Clause License.", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation."),
    "isc": ("The package is licensed under the ISC License.",),
    "boost": ("Use of this library is subject to the Boost Software License.",),
    "mpl": ("The file is covered by the Mozilla Public License Version 2.0.",),
    "epl": ("The plugin is distributed under the terms of the Eclipse Public License version 1.0.",),
    "cc-by-nc": ("The text is available under the Creative Commons Attribution-NonCommercial License.",),
    "cc-by-sa": ("The text is available under the Creative Commons Attribution-ShareAlike License.",),
    "cc-by-nd": ("The text is available under the Creative Commons Attribution-NoDerivatives License.",),
    "cc-by": ("The text is available under the Creative Commons Attribution License, version 4.0.",),
    "proprietary": ("This file is confidential. All rights are reserved by the holder of the copyright.",),
    "unknown": (
        "Permission to film in the park was granted by the city.", "The licence of the bar ends at midnight.", "Public libraries are free, and any person can use them.", "The code of conduct is available under this link.",
        "Licensed under the Common Public Attribution terms of the vendor.", "You may do what you want with this work; no conditions are attached.", "The author disclaims all warranties with regard to the parts.",
        "Distributed under the Academic Free terms, version 3.0.", "Version 2.0 of the game was released under a new name.", "The foundation published a general report on software.",
        "The eclipse was seen in all parts of the country.", "They reserved all the tables.", "A boost for the economy was granted.", "The lesser known works were copied by hand.",
    ),
}

_WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


def _tokens(s: str) -> list[str]:
    return re.findall(_WORD, s.lower())


def _grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


@functools.cache
def trained() -> tuple[tuple[str, ...], dict[str, list[float]], list[float]]:
    """Class names (unknown last), weights per n-gram and biases, temperature and calibration included."""
    names = (*NOTICES, "unknown")
    rows: list[tuple[set[str], int]] = []
    for k, name in enumerate(names):
        for s in NOTICES.get(name, OTHERS):
            w = _tokens(s)
            cuts = {(0, len(w))} | {(a, a + max(4, len(w) * 2 // 3)) for a in range(0, max(1, len(w) // 3), 2)}
            for a, b in sorted(cuts):
                rows.append((_grams(w[a:b]), k))
                rows.append((_grams(["this", "file", "is", *w[a:b], "see", "below"]), k))
    at = {g: i for i, g in enumerate(sorted(set().union(*(g for g, _ in rows))))}

    def matrix(rows: list[tuple[set[str], int]]) -> tuple[np.ndarray, np.ndarray]:
        x, y = np.zeros((len(rows), len(at) + 1)), np.zeros((len(rows), len(names)))
        for i, (g, k) in enumerate(rows):
            x[i, [at[v] for v in g if v in at]] = 1
            x[i, -1], y[i, k] = 1, 1
        return x, y

    x, y = matrix(rows)
    soft = lambda z: (e := np.exp(z - z.max(1, keepdims=True))) / e.sum(1, keepdims=True)
    w = np.zeros((x.shape[1], len(names)))
    balance = 1 / y.sum(0)[y.argmax(1)]
    for _ in range(400):
        w += 1.0 * (x.T @ ((y - soft(x @ w)) * balance[:, None]) - 2e-3 * w)
    x, y = matrix([(_grams(_tokens(s)), k) for k, name in enumerate(names) for s in HELD[name]])
    best = (np.inf, 1.0, 0.0)
    for heat in np.linspace(0.4, 3, 14):
        for offset in np.linspace(-1, 4, 21):
            z = x @ w / heat
            z[:, -1] += offset
            best = min(best, (-float((y * np.log(soft(z) + 1e-12)).sum()), float(heat), float(offset)))
    w = np.round(w / best[1], 6)
    bias = w[-1].copy()
    bias[-1] += best[2]
    return names, {g: w[i].tolist() for g, i in at.items()}, bias.tolist()


@functools.cache
def marking() -> dict[str, list[str]]:
    """Per family, the words of its notices that at most FEW families have."""
    own = {n: {w for s in notices for w in _tokens(s)} for n, notices in NOTICES.items()}
    return {n: sorted(w for w in words if sum(w in o for o in own.values()) <= FEW) for n, words in own.items()}


def _let(value: Column, f) -> Column:
    """f(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _numbers(v: list[float]) -> str:
    return f"array({', '.join(f'{x!r}D' for x in v)})"


def _literal(words: list[str]) -> str:
    return f"array({', '.join(repr(w) for w in words)})"


def _classified(paragraph: Column, always: Column) -> Column:
    """Struct (family, probability, share) of one lower-cased paragraph; null where it is not to be classified always and holds SHARE of no notice."""
    names, weights, bias = trained()
    buckets: list[list[str]] = [[] for _ in range(BUCKETS)]
    for g in weights:
        buckets[zlib.crc32(g.encode()) % BUCKETS].append(g)
    table = F.expr(f"array({', '.join('map_from_arrays(' + _literal(b or ['']) + ', array(' + ', '.join(_numbers(weights.get(g, bias)) for g in b or ['']) + '))' for b in buckets)})")
    marks = F.expr(f"array({', '.join(_literal(m) for m in marking().values())}, array('\\u0001'))")
    notices = F.expr(f"array({', '.join('array(' + ', '.join(_literal(sorted(set(_tokens(s)))) for s in NOTICES[n]) + ')' for n in names[:-1])}, array(array('\\u0001')))")

    def grams(words: Column) -> Column:
        pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))).otherwise(F.array().cast("array<string>"))
        return F.array_distinct(F.concat(words, pairs))

    def logits(words: Column) -> Column:
        return F.aggregate(grams(words), F.expr(_numbers(bias)), lambda acc, g: _let(F.try_element_at(F.get(table, (F.crc32(F.encode(g, "utf-8")) % BUCKETS).cast("int")), g), lambda w: F.when(w.isNull(), acc).otherwise(F.zip_with(acc, w, lambda a, b: a + b))))

    def held(t: Column, words: Column) -> Column:
        return _let(F.size(F.array_intersect(t, words)), lambda n: F.when((F.size(t) < WHOLE) & (n < F.size(t)), 0.0).otherwise(n / F.size(t)))

    def verdict(words: Column) -> Column:
        def chosen(z: Column) -> Column:
            best = F.array_max(z)
            total = F.aggregate(z, F.lit(0.0), lambda s, v: s + F.exp(v - best))
            k = F.array_position(z, best).cast("int")
            share = F.array_max(F.transform(F.element_at(notices, k), lambda t: held(t, words)))
            name = F.element_at(F.expr(_literal(list(names))), k)
            known = (1 / total >= LEAST) & (share >= SHARE) & (name != "unknown")
            # the other direction: words of the paragraph that mark few families are the family's own as much as any other's
            known &= _let(F.transform(marks, lambda t: F.size(F.array_intersect(t, words))), lambda n: F.element_at(n, k) >= F.array_max(n))
            return F.struct(F.when(known, name).otherwise(F.lit("unknown")).alias("family"), F.round(1 / total, 6).alias("probability"), F.round(share, 6).alias("share"))

        near = lambda own: F.exists(F.flatten(notices), lambda t: held(t, own) >= SHARE)
        return F.when(always | _let(F.array_intersect(words, F.array_distinct(F.flatten(F.flatten(notices)))), near), _let(logits(words), chosen))

    return _let(F.regexp_extract_all(paragraph, F.lit(f"({_WORD})"), 1), verdict)


@functools.cache
def _needed() -> tuple[str, ...]:
    """Beginnings of words, one of which is in every lower-cased text that holds SHARE of the words of some notice: of each notice, so many of its longest words that those left are fewer than SHARE."""
    some: set[str] = set()
    for notice in (s for n in NOTICES.values() for s in n):
        words = sorted(set(_tokens(notice)), key=lambda w: (-len(w), w))
        least = len(words) if len(words) < WHOLE else next(k for k in range(len(words) + 1) if k / len(words) >= SHARE)
        some |= set(words[: len(words) - least + 1])
    return tuple(sorted(w for w in some if not any(v != w and w.startswith(v) for v in some)))


def _anchored(low: Column) -> Column:
    return functools.reduce(lambda a, b: a | b, (F.contains(low, F.lit(a)) for a in ANCHORS))


def _worth(low: Column) -> Column:
    """Whether a lower-cased text has an anchor or a needed word; what stands before a word is never a letter."""
    by: dict[str, list[str]] = {}
    for w in _needed():
        if not any(a in w for a in ANCHORS):
            by.setdefault(w[0], []).append(re.escape(w[1:]))
    return _anchored(low) | F.rlike(low, F.lit("(?:^|[^a-z])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by.items()) + ")"))


def _paragraphs(lines: Column) -> Column:
    """Structs (line, text, parts) of the paragraphs of two lines or more: the first line's number, all lines joined, how many they are."""
    blank = lambda i: F.trim(F.translate(F.coalesce(F.get(lines, i), F.lit("")), "\t\r", "  ")) == ""
    every = F.sequence(F.lit(0), F.size(lines) - 1)
    starts = F.filter(every, lambda i: ~blank(i) & blank(i - 1))
    ends = F.filter(every, lambda i: ~blank(i) & blank(i + 1))
    spans = F.filter(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: x["b"] > x["a"])
    return F.transform(spans, lambda x: F.struct(x["a"].alias("line"), F.array_join(F.slice(lines, x["a"] + 1, x["b"] - x["a"] + 1), " ").alias("text"), (x["b"] - x["a"] + 1).alias("parts")))


def license_families(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, families, paragraphs): paragraphs holds (line, family, probability, share) of every line that has an anchor word or a family, and of paragraphs that have a family their lines lack."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    empty = F.expr("filter(array(named_struct('line', 0, 'family', '', 'probability', 0D, 'share', 0D, 'last', 0)), x -> false)")
    row = lambda p, always: _let(_classified(p["text"], always), lambda v: F.struct(p["line"].alias("line"), v["family"].alias("family"), v["probability"].alias("probability"), v["share"].alias("share"), (p["line"] + p["parts"] - 1).alias("last")))
    worth = lambda p: _worth(p["text"])

    def judged(lines: Column) -> Column:
        numbered = F.transform(lines, lambda p, i: F.struct(i.alias("line"), p.alias("text"), F.lit(1).alias("parts")))
        seen = F.transform(F.filter(numbered, worth), lambda p: _let(_anchored(p["text"]), lambda a: F.struct(a.alias("anchored"), row(p, a).alias("v"))))
        single = F.transform(F.filter(seen, lambda x: x["anchored"] | (x["v"]["family"] != "unknown")), lambda x: x["v"])

        def with_joined(lone: Column) -> Column:
            return _let(F.filter(F.transform(F.filter(_paragraphs(lines), worth), lambda p: row(p, F.lit(False))), lambda j: j["family"] != "unknown"), lambda joined: joined_to(lone, joined))

        def joined_to(lone: Column, joined: Column) -> Column:
            # a line with a part of a notice gives way to its paragraph
            other = lambda o: F.exists(joined, lambda j: (j["line"] <= o["line"]) & (o["line"] <= j["last"]) & (j["family"] != o["family"]))
            kept = F.transform(lone, lambda o: F.when((o["family"] != "unknown") & (o["share"] < 1) & other(o), F.struct(*(F.lit("unknown").alias(c) if c == "family" else o[c].alias(c) for c in ("line", "family", "probability", "share", "last")))).otherwise(o))
            return _let(kept, lambda own: with_fresh(own, joined))

        def with_fresh(own: Column, joined: Column) -> Column:
            fresh = lambda j: (j["family"] != "unknown") & ~F.exists(own, lambda o: (o["family"] == j["family"]) & (o["line"] >= j["line"]) & (o["line"] <= j["last"]))
            return F.concat(own, F.filter(joined, fresh))

        return _let(single, with_joined)

    found = _let(F.lower(text), lambda low: F.when(_worth(low), _let(F.split(low, "\n"), judged)))
    flat = F.transform(F.coalesce(found, empty), lambda v: F.struct(*(v[c].alias(c) for c in ("line", "family", "probability", "share"))))
    df = docs.select(F.col(id_col).alias(id_col), flat.alias("paragraphs"))
    families = F.array_sort(F.array_distinct(F.transform(F.filter("paragraphs", lambda p: p["family"] != "unknown"), lambda p: p["family"])))
    return df.select(id_col, families.alias("families"), "paragraphs")


def op5_licenses(spark, sf_dir: str) -> DataFrame:
    from .common import table

    out = license_families(table(spark, sf_dir, "documents"))
    named = F.filter("paragraphs", lambda p: p["family"] != "unknown")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_join("families", ",").alias("families"), F.size(named).cast("long").alias("n_licence_lines"), F.size("paragraphs").cast("long").alias("n_candidate_lines"), F.array_max(F.transform(named, lambda p: p["probability"])).alias("best_probability"))
