"""License scans by a positional rare-token index.

The words of the licence templates are counted over all documents (document
frequencies; one row a template word reaches the driver).  The index holds,
for each template's rarest words, their postings (template, position).  A
file is scanned for indexed words; all of those it has are looked up
and each posting votes for the template at the relative position file place -
template place.  A template with enough agreeing votes (places may drift by a
few words) is a candidate, and is found when one of its mandatory key phrases
stands in the file and not only as a part of a longer key phrase: "creative
commons attribution noncommercial" is no place of "creative commons
attribution".  Base phrases are found by their words too and always stay.

``score`` is the largest share of a found template's rarity that the file's
agreeing words hold; a base phrase alone gives 0.5, no label 0.

Defined cases: null text = empty text, without words and labels; repeated
rows are documents of their own; a null identifier stays null; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import documents, text_or_empty
from marquee.llm.words import ALNUM, blocks, tokenised

# Fixed base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Fixed licence notices: label, text in words, key phrases of which one must stand.
TEMPLATES = (
    ("mit", "released under the mit license", ("under the mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
            " documentation files the software to deal in the software without restriction including without limitation"
            " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
     ("permission is hereby granted free of charge",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
               " with the license you may obtain a copy of the license at", ("apache license version 2 0",)),
    ("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
            " public license as published by the free software foundation", ("gnu general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that"
            " the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
            " granted", ("permission to use copy modify and or distribute",)),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the"
            " following disclaimer", ("must retain the above copyright notice this list of conditions",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held"
             " liable for any damages arising from the use of this software",
     ("provided as is without any express or implied warranty",)),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published"
             " by the free software foundation", ("lesser general public license",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published"
             " by the free software foundation", ("affero general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("affero general public license",)),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license",
     ("eclipse public license",)),
    ("boost", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software released into the public domain",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this"
            " work", ("waived all copyright and related or neighboring rights",)),
    ("cc0", "cc0 1 0 universal", ("cc0 1 0",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)
# Fixed names of identifiers in file headers, in words, and their labels.
SPDX = (("mit", "mit"), ("apache 2 0", "apache"), ("bsd 2 clause", "bsd"), ("bsd 3 clause", "bsd"), ("gpl 2 0", "gpl"),
        ("gpl 3 0", "gpl"), ("lgpl 2 1", "lgpl"), ("lgpl 3 0", "lgpl"), ("agpl 3 0", "agpl"), ("mpl 2 0", "mpl"),
        ("epl 2 0", "epl"), ("isc", "isc"), ("zlib", "zlib"), ("bsl 1 0", "boost"), ("unlicense", "unlicense"),
        ("cc0 1 0", "cc0"))
# Fixed elements of Creative Commons licences and their spellings in words.
CC_ELEMENTS = {"nc": ("noncommercial", "non commercial"), "sa": ("sharealike", "share alike"),
               "nd": ("noderivatives", "noderivs", "no derivatives")}
CC_KINDS = ((), ("nc",), ("sa",), ("nd",), ("nc", "sa"), ("nc", "nd"))
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


def _named_notices():
    """Templates of file header identifiers and of all Creative Commons licences."""
    for name, label in SPDX:
        yield label, f"spdx license identifier {name}", (f"spdx license identifier {name}",)
    for kind in CC_KINDS:
        label = "-".join(("cc", "by", *kind))
        short = label.replace("-", " ")
        # "cc by" alone is ordinary writing, so its key has a version
        yield label, f"{short} 4 0", (short,) if kind else tuple(f"{short} {v}" for v in CC_VERSIONS)
        for spelled in product(*(CC_ELEMENTS[e] for e in kind)):
            name = " ".join(("creative commons attribution", *spelled))
            yield label, f"{name} 4 0 international license", (name,)


TEMPLATES += tuple(_named_notices())
#: Indexed words of a template; drift in words; share of the votes needed.
RARE, DRIFT, AGREE = 8, 2, 0.5


def _vocabulary() -> list[str]:
    words = {w for _, t, keys in TEMPLATES for w in t.split() + " ".join(keys).split()}
    return sorted(words | {w for p, _ in BASE for w in p.split()})


def _hash_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    b = tokenised([w.encode() for w in words], ALNUM)
    h = b.hashes()
    order = np.argsort(h)
    return h[order], order


def _hits(batch: pa.RecordBatch, keys: np.ndarray, which: np.ndarray):
    """Per document: number of words, and (word number, vocabulary number) of its vocabulary words."""
    for begin, texts in blocks(batch, lower=True):
        b = tokenised(texts, ALNUM)
        h = b.hashes()
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        found = np.flatnonzero(keys[at] == h)
        vocab = which[at[found]]
        cut = np.searchsorted(found, b.first)
        for d in range(len(texts)):
            lo, hi = cut[d], cut[d + 1]
            yield begin + d, int(b.first[d + 1] - b.first[d]), found[lo:hi] - b.first[d], vocab[lo:hi]


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[dict[str, int], int]:
    """Documents that have each template word, and the number of documents."""
    words = _vocabulary()

    def count(batches):
        keys, which = _hash_table(words)
        n, seen = 0, np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for _, _, _, vocab in _hits(batch, keys, which):
                n += 1
                seen[np.unique(vocab)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([*range(len(words)), -1], pa.int32()),
                                          pa.array([*seen.tolist(), n], pa.int64())], names=["w", "n"])
    got = (docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "w int, n long")
           .groupBy("w").agg(F.sum("n").alias("n")).collect())
    counts = {r["w"]: r["n"] for r in got}
    return {w: counts.get(i, 0) for i, w in enumerate(words)}, counts.get(-1, 0)


class Index:
    """Postings of the templates' rarest words under given frequencies."""

    def __init__(self, df: dict[str, int], n_docs: int):
        self.words = _vocabulary()
        number = {w: i for i, w in enumerate(self.words)}
        # a word of no document is as rare as a word of one
        self.idf = [math.log((n_docs + 1) / (max(df.get(w, 0), 1) + 1)) + 1e-3 for w in self.words]
        self.keys, self.which = _hash_table(self.words)
        self.postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.weight = []
        for t, (_, text, _) in enumerate(TEMPLATES):
            ws = [number[w] for w in text.split()]
            rare = sorted(set(ws), key=lambda w: (-self.idf[w], w))[:RARE]
            self.weight.append(sum(self.idf[w] for w in rare))
            for pos, w in enumerate(ws):
                if w in rare:
                    self.postings[w].append((t, pos))
        # phrases by their first word: (words, base label or None, templates it is a key of)
        phrases: dict[tuple, tuple] = {}
        for phrase, label in BASE:
            phrases[tuple(number[w] for w in phrase.split())] = (label, [])
        for t, (_, _, keys) in enumerate(TEMPLATES):
            for k in keys:
                phrases.setdefault(tuple(number[w] for w in k.split()), (None, []))[1].append(t)
        self.phrases: dict[int, list[tuple]] = defaultdict(list)
        for words, (label, of) in phrases.items():
            self.phrases[words[0]].append((words, label, of))

    def places(self, at: dict[int, int]) -> Iterator[tuple]:
        """Where phrases' words stand consecutively: (place, length, base label, templates)."""
        for p, w in at.items():
            for words, label, of in self.phrases.get(w, ()):
                if all(at.get(p + j) == x for j, x in enumerate(words)):
                    yield p, len(words), label, of

    def scan(self, pos: np.ndarray, vocab: np.ndarray) -> tuple[int, int | None, int | None, str, str, float]:
        at = dict(zip(pos.tolist(), vocab.tolist()))
        found = sorted(self.places(at), key=lambda f: (f[0], -f[1]))
        starts = [p for p, _, label, _ in found if label]
        base = {label for _, _, label, _ in found if label}
        # a key phrase inside a longer one does not count
        keyed: set[int] = set()
        reach = 0
        for p, n, _, of in found:
            if of and p + n > reach:
                keyed.update(of)
                reach = p + n
        labels, score = set(base), 0.5 if base else 0.0
        # votes: relative position -> words that agree, by template
        votes: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for p, w in at.items():
            for t, q in self.postings.get(w, ()):
                votes[t][p - q].add(w)
        for t, by_place in votes.items():
            if t not in keyed:
                continue
            best = 0.0
            for place in by_place:
                near = set().union(*(by_place.get(place + j, ()) for j in range(-DRIFT, DRIFT + 1)))
                best = max(best, sum(self.idf[w] for w in near))
            share = min(1.0, best / self.weight[t])
            if share >= AGREE:
                labels.add(TEMPLATES[t][0])
                score = max(score, share)
        return (len(starts), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9))


DDL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, "
       "base_labels string, labels string, score double")
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                     ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                     ("labels", pa.string()), ("score", pa.float64())])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, base places, labels and score."""
    df, n = document_frequencies(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(df, n)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[i], n_words, *index.scan(pos, vocab))
                    for i, n_words, pos, vocab in _hits(batch, index.keys, index.which)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_SCHEMA)],
                                             schema=_SCHEMA)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return d.mapInArrow(run, DDL)


def op3_licenses(spark, sf_dir):
    return scan(documents(spark, sf_dir))
