"""Licence scans: normalised text against licence templates by the Dice coefficient of word bigrams.

A text is scanned as its paragraphs, its lines, and its whole, each brought to lower-case words of letters
and digits without copyright lines. Dice = 2 * common / (all of both), over bigrams with repetitions. As
at most the smaller side is common, a template whose size is outside of size * t / (2 - t) ... size * (2 - t) / t
cannot reach the threshold t; templates are sorted by size and only those between are compared. Texts
and lines without any of the words that every match must have are passed over. One pass, no shuffle;
the templates are a parameter and travel with the job.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

THRESHOLD = 0.8
MIN_BIGRAMS = 2

# Short notices by which texts name their licence, and the openings of full licences.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "BSD-3-Clause": [
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0."],
    "proprietary": ["All rights reserved."],
}

_COMMON = set("all and by following in including is of or that the this to under with without".split())
_WORD = re.compile(r"[^\W_]+")
_COPYRIGHT = re.compile(r"^\W*(?:copyright\b|\(c\)|©).*$", re.I | re.M)
_PARAGRAPH = re.compile(r"\n\s*\n")


def bigrams(text: str) -> Counter:
    words = _WORD.findall(_COPYRIGHT.sub(" ", text).lower())
    return Counter(zip(words, words[1:]))


class Templates:
    """Templates by size."""

    def __init__(self, texts: Mapping[str, list[str]], threshold: float):
        made = sorted(
            ((sum(grams.values()), name, grams) for name, every in texts.items() for grams in map(bigrams, every)),
            key=lambda x: x[:2],
        )
        self.made = [x for x in made if x[0] >= MIN_BIGRAMS]
        self.sizes = [x[0] for x in self.made]
        self.threshold = threshold
        # Every match has one of these words, so that a text or line without any need not be compared.
        self.telling = sorted({word for size, _, grams in self.made for word in self._needed(size, grams)})
        self.pattern = "|".join(self.telling)
        self._seen = re.compile(self.pattern, re.I)

    def _needed(self, size: int, grams: Counter) -> Iterator[str]:
        """A match has at least `common` of the bigrams, so it has one of any size - common + 1. Of those with
        the longest words, but for common ones, that word each."""
        t = self.threshold
        common = math.ceil(t * (size + math.ceil(size * t / (2 - t) - 1e-9)) / 2 - 1e-9)
        telling = lambda word: 0 if word in _COMMON else len(word)
        every = sorted(grams.elements(), key=lambda pair: (-max(map(telling, pair)), pair))
        for pair in every[: size - common + 1]:
            yield max(pair, key=telling)

    def may_match(self, unit: str) -> bool:
        return self._seen.search(unit) is not None

    def best(self, text: str) -> tuple[float, str] | None:
        """The highest coefficient that reaches the threshold, and its licence."""
        grams = bigrams(text)
        size, t = sum(grams.values()), self.threshold
        low = bisect_left(self.sizes, size * t / (2 - t) - 1e-9)
        high = bisect_right(self.sizes, size * (2 - t) / t + 1e-9)
        found = None
        for other, name, template in self.made[low:high]:
            common = sum(min(n, grams[pair]) for pair, n in template.items() if pair in grams)
            dice = 2 * common / (size + other)
            if dice >= t and (found is None or (dice, name) > found):
                found = dice, name
        return found

    def longest(self) -> int:
        return max(self.sizes, default=0)


def scan(text: str, templates: Templates) -> tuple[str, str, float, int]:
    """The licences a text names (sorted, joined by commas), the best one with its coefficient, and how many
    passages name one."""
    named, best, passages = set(), (0.0, ""), 0
    units = text.split("\n")
    if "\n" in text:
        units += [part for part in _PARAGRAPH.split(text) if "\n" in part]
        units.append(text)
    # Beyond this many characters between blanks no unit can be as short as the largest template.
    most = templates.longest() * (2 - templates.threshold) / templates.threshold + 1
    for unit in dict.fromkeys(units):
        if not templates.may_match(unit):
            continue
        if unit.count(" ") > most * 4 and len(_WORD.findall(unit)) > most:
            continue
        found = templates.best(unit)
        if found:
            passages += 1
            named.add(found[1])
            best = max(best, found)
    return ",".join(sorted(named)), best[1], best[0], passages


def scanned(
    docs: DataFrame, templates: Mapping[str, list[str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """doc_id, licences, licence (the best), dice and n_passages of every document, one row for each row of `docs`.

    Reads `doc_id` and `text`; other columns may bear any name. Null and empty texts name no licence (empty
    names, coefficient 0). Rows that repeat get the same answer. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, none = Templates(templates, threshold), ("", "", 0.0, 0)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            likely = pc.match_substring_regex(texts, made.pattern, ignore_case=True).to_pylist()
            found = [scan(x.as_py(), made) if some else none for x, some in zip(texts, likely)]
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "licences", "licence", "dice", "n_passages"]
            )

    kinds = [pa.string(), pa.string(), pa.float64(), pa.int64()]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, licences string, licence string, dice double, n_passages long"
    )
