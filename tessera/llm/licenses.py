"""License scan: matching statistics against a generalised suffix automaton.

The words of all license templates (and of the base phrases) form one automaton.
A text's words are streamed through it; after each word the state and length
say what the longest template stretch ending there is. A stretch ends for a
template where that template does not go on, whether or not a longer one does.
Stretches that end are chained: a chain is a run of stretches in the order of a template with few
words between; a template whose words are covered enough by one chain gives a
labelled span. Base phrases are read off the state reached at each word.

Edge cases: null and empty texts have no words; repeated rows stay; an empty
table gives an empty result; further columns are not carried by ``scan`` but
for those named in ``carry``.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common

# Base phrases and labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License notices by SPDX name.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4.0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4.0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("bsd-2-clause", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd-2-clause", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0"),
    ("gfdl-1.3", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1.3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
)

#: A stretch counts for a chain from so many words, a chain from such a share of its template, over gaps of so many words.
MIN_STRETCH, MIN_COVER, MAX_GAP = 3, 0.8, 5

# Bytes that are no part of a word (all of ASCII but letters and digits) become spaces, A-Z lower case.
SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(SPLIT).split()


class Automaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for k, seq in enumerate(sequences):
            last = 0
            for at, word in enumerate(seq):
                last = self._extend(last, word)
                self.ends[last].add((k, at + 1))
        for v in sorted(range(1, len(self.next)), key=lambda v: -self.length[v]):
            self.ends[self.link[v]] |= self.ends[v]
        self.ends[0] = set()

    def _state(self, length: int, nxt: dict[bytes, int], link: int) -> int:
        self.next.append(nxt)
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: bytes) -> int:
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if (q := self.next[last].get(word)) is not None:
            return self._split(last, q, word)
        new = self._state(self.length[last] + 1, {}, 0)
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][word], word)
        return new

    def state_of(self, seq: list[bytes]) -> int:
        v = 0
        for w in seq:
            v = self.next[v][w]
        return v


class Scanner:
    def __init__(self):
        self.base = [(p.encode().split(), label) for p, label in PHRASES]
        self.templates = [(label, words_of(t.encode())) for label, t in TEMPLATES]
        self.automaton = a = Automaton([t for _, t in self.templates] + [p for p, _ in self.base])
        at = {a.state_of(p): (len(p), label) for p, label in self.base}
        # Base phrases that end in what a state stands for: those of its ancestors by suffix link.
        self.phrases: list[list[tuple[int, str]]] = []
        for v in range(len(a.next)):
            found, u = [], v
            while u > 0:
                if u in at:
                    found.append(at[u])
                u = a.link[u]
            self.phrases.append(found)
        self.known = set(a.next[0])
        # By state and next word: ends in templates of the state that do not go on with the word.
        self.lost: list[dict[bytes, list[tuple[int, int]]]] = []
        for v, follow in enumerate(a.next):
            gone = {w: sorted(e for e in a.ends[v] if e[0] not in {k for k, _ in a.ends[u]}) for w, u in follow.items()}
            self.lost.append({w: e for w, e in gone.items() if e})

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[str, int, int, float]]]:
        """Base places (first word, label) and template spans (label, first word, end, covered share)."""
        a = self.automaton
        nxt, link, length, known, phrases, lost = a.next, a.link, a.length, self.known, self.phrases, self.lost
        places: list[tuple[int, str]] = []
        chains: dict[int, list[int]] = {}
        best: list[tuple[str, int, int, float]] = []
        v = size = 0

        def close(k: int) -> None:
            first, end, _, covered = chains.pop(k)
            label, template = self.templates[k]
            if covered >= MIN_COVER * len(template):
                best.append((label, first, end, covered / len(template)))

        def stretch(end: int, ends: list[tuple[int, int]]) -> None:
            """The stretch of ``size`` words before ``end`` can't go on in the templates of ``ends``: add it to their chains."""
            for k, stop in ends:
                if k >= len(self.templates):
                    continue
                start = stop - size
                if (c := chains.get(k)) is not None:
                    if start >= c[2] and end - size - c[1] <= MAX_GAP:
                        c[1], c[2], c[3] = end, stop, c[3] + size
                        continue
                    if end - size < c[1] and size <= c[3]:
                        continue
                    close(k)
                chains[k] = [end - size, end, stop, size]

        for i, w in enumerate(words):
            if w not in known:
                if size:
                    if size >= MIN_STRETCH:
                        stretch(i, sorted(a.ends[v]))
                    v = size = 0
                continue
            if w not in nxt[v]:
                if size >= MIN_STRETCH:
                    stretch(i, sorted(a.ends[v]))
                while w not in nxt[v]:
                    v = link[v]
                size = length[v]
            if size >= MIN_STRETCH and w in lost[v]:
                stretch(i, lost[v][w])
            v = nxt[v][w]
            size += 1
            for n, label in phrases[v]:
                if n <= size:
                    places.append((i + 1 - n, label))
        if size >= MIN_STRETCH:
            stretch(len(words), sorted(a.ends[v]))
        for k in list(chains):
            close(k)
        return places, sorted(set(best), key=lambda s: (s[1], s[2], s[0]))


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, places, spans) of every row: base places (word, label), template spans (label, first, end, covered)."""
    place = pa.struct([("word", pa.int64()), ("label", pa.string())])
    span = pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())])

    def run(batches):
        own = scanner()
        for b in common.rows_of(batches):
            sizes, places, spans = [], [], []
            for t in b.column(1).to_pylist():
                words = words_of(t)
                found, chained = own.scan(words)
                sizes.append(len(words))
                places.append([{"word": w, "label": x} for w, x in sorted(found)])
                spans.append([dict(zip(("label", "first", "end", "covered"), s, strict=True)) for s in chained])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(place)), pa.array(spans, pa.list_(span))], ["doc_id", "n_words", "places", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, places array<struct<word:long,label:string>>, spans array<struct<label:string,first:long,end:long,covered:double>>")


def digest(found: DataFrame) -> DataFrame:
    """The flat columns of the scan: counts, first and last base place, labels and score."""
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    labels = F.array_sort(F.array_distinct(F.concat(F.col("places.label"), F.col("spans.label"))))
    covered = F.coalesce(F.array_max(F.col("spans.covered")), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(covered).alias("score"),
    )
