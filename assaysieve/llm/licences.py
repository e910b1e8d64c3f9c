"""Licence scans: texts are streamed through a generalised suffix automaton of licence wordings.

Matching statistics give the long matches of a text with the wordings; matches of one wording that follow each other in both are chained into
a span, and the wording is reported when the chain covers enough of it.
"""

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.llm.automaton import Scanner
from assaysieve.llm.text import folded_words, per_text

# Parts of the wordings below, as the licences have them.
BSD_FIRST = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source "
             "code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
             "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
             "written permission. ")
BSD_WARRANTY = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES "
                "OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
                "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
                "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
# Label and wording. Several wordings may share a label.
WORDINGS = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                   "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("bsd-2-clause", BSD_FIRST + BSD_WARRANTY),
    ("bsd-3-clause", BSD_FIRST + BSD_NAMES + BSD_WARRANTY),
    ("boost", "Boost Software License, Version 1.0. Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
              "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of "
              "the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("cc0", "Licensed under CC0 1.0 Universal"),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
            "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
            "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
            "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE."),
    ("agpl", "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("lgpl", "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
                  "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this "
             "software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to "
             "the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in "
             "a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must "
             "not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
            "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
            "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This work is dedicated to the public domain"),
    ("reserved", "All rights reserved"),
]
# Phrases that are counted wherever their words stand consecutively, and their labels.
PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

SEED = 3  # words of the shortest match that takes part in a chain
GAP = 12  # words that may lie between two matches of a chain
COVERED = 0.6  # share of a wording that a chain must cover
SCHEMA = ("n_words bigint, places array<struct<label:string,at:bigint>>, "
          "spans array<struct<label:string,first:bigint,last:bigint,covered:double>>")


class Wordings:
    def __init__(self, wordings: list[tuple[str, str]], phrases: list[tuple[str, str]], seed: int, gap: int, covered: float) -> None:
        self.labels = [label for label, _ in wordings]
        self.phrases = [(label, folded_words(phrase)) for phrase, label in phrases]
        self.seed, self.gap, self.covered = seed, gap, covered
        words = [folded_words(text) for _, text in wordings]
        self.sizes = [len(w) for w in words]
        shortest = min([seed, *(len(w) for _, w in self.phrases)])
        self.scanner = Scanner(words + [w for _, w in self.phrases], shortest)
        automaton = self.scanner.automaton
        # Where the sequences of a state end in the wordings, also those of the states that link to it.
        self.ends: dict[int, set[tuple[int, int]]] = {}
        for n, item in enumerate(self.scanner.items[:len(words)]):
            for end, (state, _) in enumerate(automaton.stream(item), 1):
                while state:
                    self.ends.setdefault(state, set()).add((n, end))
                    state = automaton.link[state]
        self.phrase_ids = [(label, self.scanner.items[len(words) + i]) for i, (label, _) in enumerate(self.phrases)]

    def scan(self, texts: list[str | None]) -> list[tuple]:
        sizes, found = self.scanner.runs(texts, folded_words)
        return [(size, *self._one(found.get(n, []))) for n, size in enumerate(sizes)]

    def _one(self, runs: list[tuple[int, list[int]]]) -> tuple[list[dict], list[dict]]:
        places, matches = [], {}
        for begin, words in runs:
            for label, phrase in self.phrase_ids:
                places += [{"label": label, "at": begin + i} for i in range(len(words) - len(phrase) + 1) if words[i:i + len(phrase)] == phrase]
            path = list(self.scanner.automaton.stream(words))
            for i, (state, n) in enumerate(path):
                # A match ends where the next word does not lengthen it.
                if n >= self.seed and (i + 1 == len(path) or path[i + 1][1] <= n):
                    for wording, end in self.ends.get(state, ()):
                        matches.setdefault(wording, []).append((begin + i + 1 - n, end - n, n))
        spans = []
        for wording, own in sorted(matches.items()):
            spans += self._chains(wording, sorted(own))
        return sorted(places, key=lambda p: (p["at"], p["label"])), [{k: v for k, v in s.items() if k != "words"} for s in _strongest(spans)]

    def _chains(self, wording: int, matches: list[tuple[int, int, int]]) -> list[dict]:
        """Chains of matches that follow each other in text and wording, each with the words of the wording it covers."""
        best: list[tuple[int, int]] = []  # covered words, number of the first match
        reach = self.gap + self.sizes[wording]  # no match is longer than its wording, so none that begins further back can be in reach
        for i, (at, of, n) in enumerate(matches):
            score, first = n, i
            for j in range(i - 1, -1, -1):
                a, o, m = matches[j]
                if at - a > reach:
                    break
                # Overlapping words count once; both sequences must go on.
                over = max(a + m - at, o + m - of, 0)
                if a < at and o < of and n > over and at - (a + m) <= self.gap and best[j][0] + n - over > score:
                    score, first = best[j][0] + n - over, best[j][1]
            best.append((score, first))
        spans: list[dict] = []
        begins: list[int] = []
        for i in sorted(range(len(matches)), key=lambda i: (-best[i][0], i)):
            if best[i][0] < self.covered * self.sizes[wording]:
                break
            begin, end = matches[best[i][1]][0], matches[i][0] + matches[i][2]
            place = bisect_right(begins, begin)
            if (place and spans[place - 1]["last"] > begin) or (place < len(spans) and spans[place]["first"] < end):
                continue
            begins.insert(place, begin)
            spans.insert(place, {"label": self.labels[wording], "first": begin, "last": end, "covered": best[i][0] / self.sizes[wording], "words": best[i][0]})
        return spans


def _strongest(spans: list[dict]) -> list[dict]:
    """Spans of which none lies by more than half in one of another label that stays and matches more words, or as many and covers more of its wording. In page order."""
    width = max((s["last"] - s["first"] for s in spans), default=1)
    stays: dict[int, list[dict]] = {}  # by stretches of the text as wide as the longest span: what overlaps a span begins in its stretch or next to it
    for s in sorted(spans, key=lambda s: (-s["words"], -s["covered"], s["first"], s["label"])):
        place = s["first"] // width
        near = [o for k in (place - 1, place, place + 1) for o in stays.get(k, ())]
        if not any(o["label"] != s["label"] and 2 * (min(o["last"], s["last"]) - max(o["first"], s["first"])) > s["last"] - s["first"] for o in near):
            stays.setdefault(place, []).append(s)
    return sorted((s for own in stays.values() for s in own), key=lambda s: (s["first"], s["last"], s["label"]))


def scan(documents: DataFrame, text: str = "text", wordings: list[tuple[str, str]] = WORDINGS, phrases: list[tuple[str, str]] = PHRASES,
         seed: int = SEED, gap: int = GAP, covered: float = COVERED, out: str = "licences") -> DataFrame:
    """The documents with a struct column `out`: n_words, places of phrases, and spans of wordings with the share covered.

    Null and empty texts have no words, places or spans. A column called `out` is replaced, all others stay.
    """
    return documents.withColumn(out, per_text(lambda: Wordings(wordings, phrases, seed, gap, covered).scan, SCHEMA)(F.col(text)))


def digest(documents: DataFrame) -> DataFrame:
    """Per document: the phrases found, the labels of phrases and wordings, and the largest share of a wording covered."""
    found = scan(documents.select("doc_id", "text"))
    starts, base = F.col("licences.places.at"), F.col("licences.places.label")
    return found.select(
        "doc_id", F.col("licences.n_words").alias("n_words"), F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("licences.spans.label"))), ",").alias("labels"),
        F.coalesce(F.array_max("licences.spans.covered"), F.lit(0.0)).alias("score"),
    )
