"""License scans by a positional rare-token index.

The index holds, for every licence template, the positions of its words that are rare among the templates. All of a file's
words that the index knows are looked up, so no licence depends on what else the file holds; the postings they meet are
intersected by relative position (file position less template position, within ``SLACK``); a template with enough agreeing
rare words is a candidate, and it is reported only if its mandatory key phrases stand in the aligned stretch of the file.
Its score is the share of the template's rare words found at agreeing places. Beside the templates, a few phrases label a
file by themselves wherever their words stand consecutively.

Words are runs of ASCII letters and digits and non-ASCII characters, after lower-casing A-Z. Null and empty texts hold no
words: counts 0, places null, labels empty, score 0. Very long texts are scanned whole. Every row is scanned by itself, so
repeated rows and null ids are rows like others; of equally good places of a template the first counts. An empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxalith.llm.common import arrow_schema, columns, table, text_of

#: Phrases that label a file by themselves.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: Opening or notice passages of public licences, and the phrases that must stand in a match. Fixed values.
TEMPLATES = {
    "mit": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", ("permission is hereby granted free of charge", "without restriction")),
    "isc": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", ("with or without fee", "appear in all copies")),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer", ("redistribution and use in source and binary forms", "are permitted provided")),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("apache license", "version 2 0")),
    "gpl-notice": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", ("gnu general public license", "free software foundation")),
    "lgpl-notice": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version", ("lesser general public license",)),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/", ("mozilla public license",)),
    "cc-notice": ("This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/", ("creative commons", "attribution")),
    "cc0": ("To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work", ("cc0", "waived all copyright")),
    "unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", ("free and unencumbered software", "public domain")),
    "copyright-notice": ("Copyright (c) the authors. All rights reserved.", ("copyright", "all rights reserved")),
}
#: One-line notices that name a licence, and the phrases that must stand in a match. Fixed values. What stands before the
#: stroke is the label, which a notice may share with the licence's own text.
NOTICES = {
    "mit/line": ("Released under the MIT License.", ("mit license",)),
    "apache-2.0/line": ("Licensed under the Apache License, Version 2.0.", ("apache license version 2 0",)),
    "gpl-3.0/line": ("This work is licensed under the GNU General Public License, version 3.", ("gnu general public license version 3",)),
    "gpl-2.0/line": ("This work is licensed under the GNU General Public License, version 2.", ("gnu general public license version 2",)),
    "lgpl-notice/line": ("Distributed under the GNU Lesser General Public License.", ("gnu lesser general public license",)),
    "bsd/line": ("Distributed under the BSD License.", ("bsd license",)),
    "mpl-2.0/line": ("Licensed under the Mozilla Public License, version 2.0.", ("mozilla public license",)),
    "cc-by-nc/line": ("Licensed under CC BY-NC 4.0.", ("cc by nc",)),
    "cc-by-sa/line": ("Licensed under CC BY-SA 4.0.", ("cc by sa",)),
    "cc-by-nd/line": ("Licensed under CC BY-ND 4.0.", ("cc by nd",)),
}
RAREST, SLACK, LEAST_SHARE = 24, 3, 0.6

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Index(NamedTuple):
    """postings: word to its (template, position) places; rare: by template, the positions that count."""

    postings: dict[bytes, list[tuple[str, int]]]
    rare: dict[str, list[int]]
    size: dict[str, int]
    keys: dict[str, list[list[bytes]]]
    phrases: list[tuple[list[bytes], str]]


def build(templates=TEMPLATES | NOTICES, phrases=BASE) -> Index:
    """Words that stand in over a third of the templates are left out of the postings: they tell nothing."""
    words = {name: words_of(text) for name, (text, _) in templates.items()}
    spread = Counter(w for ws in words.values() for w in set(ws))
    postings, rare = defaultdict(list), defaultdict(list)
    for name, ws in words.items():
        for i, w in enumerate(ws):
            if spread[w] <= max(1, len(words) // 3):
                postings[w].append((name, i))
                rare[name].append(i)
    keys = {name: [words_of(k) for k in ks] for name, (_, ks) in templates.items()}
    return Index(dict(postings), dict(rare), {n: len(ws) for n, ws in words.items()}, keys, [(words_of(p), label) for p, label in phrases])


def places(words: list[bytes], phrase: list[bytes], begin: int = 0, end: int | None = None) -> list[int]:
    """Starts of a phrase's consecutive words within words[begin:end]."""
    end, out, at = len(words) if end is None else min(end, len(words)), [], begin
    head, n = phrase[0], len(phrase)
    while True:
        try:
            at = words.index(head, at, end)
        except ValueError:
            return out
        if words[at : at + n] == phrase and at + n <= end:
            out.append(at)
        at += 1


class Found(NamedTuple):
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: list[str]
    labels: list[str]
    score: float
    matches: list[tuple[str, int, int, float]]


def scan(text: str | None, index: Index) -> Found:
    """Base phrases and licence templates of one text; matches: (template, first word, word behind the last, score)."""
    words = words_of(text)
    have = set(words)
    starts, base = [], set()
    for phrase, label in index.phrases:
        if have.issuperset(phrase) and (got := places(words, phrase)):
            starts += got
            base.add(label)
    matches = []
    known = have & index.postings.keys()
    if known:
        votes: dict[tuple[str, int], set[int]] = defaultdict(set)
        for at, w in enumerate(words):
            if w in known:
                for name, i in index.postings[w]:
                    votes[name, (at - i) // SLACK].add(i)
        best: dict[str, tuple[float, int]] = {}
        for (name, shift), got in votes.items():
            if len(got) * 4 >= min(len(index.rare[name]), RAREST):
                begin = shift * SLACK
                fit = sum(1 for i in index.rare[name] if any(w in index.postings and (name, i) in index.postings[w] for w in words[max(0, begin + i - SLACK) : begin + i + 2 * SLACK]))
                share = fit / len(index.rare[name])
                if share >= LEAST_SHARE and (share, -begin) > best.get(name, (0.0, 0)):
                    span = max(0, begin - SLACK), begin + index.size[name] + 2 * SLACK
                    if all(places(words, key, *span) for key in index.keys[name]):
                        best[name] = share, -begin
        matches = sorted((name, max(0, -at), min(len(words), -at + index.size[name]), share) for name, (share, at) in best.items())
    labels = sorted(base | {m[0].split("/")[0] for m in matches})
    score = max([0.5 * bool(base), *(m[3] for m in matches)])
    return Found(len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(base), labels, float(score), matches)


SCANS = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<license: string, first: long, behind: long, score: double>>"


def license_scan(df: DataFrame, text: str = "text", key: str = "doc_id", templates=TEMPLATES | NOTICES, phrases=BASE) -> DataFrame:
    """One row per input row with its labels, score and the aligned stretches."""

    def rows(batches):
        index = build(templates, phrases)
        for ids, texts in columns(batches, "doc_id", "text"):
            got = [scan(t, index) for t in texts]
            out = {"doc_id": ids} | {n: [getattr(g, n) for g in got] for n in ("n_words", "n_base", "first_word", "last_word", "score")}
            out |= {n: [",".join(getattr(g, n)) for g in got] for n in ("base_labels", "labels")}
            out["matches"] = [[dict(zip(("license", "first", "behind", "score"), m)) for m in g.matches] for g in got]
            schema = arrow_schema(SCANS)
            yield pa.RecordBatch.from_pydict({n: out[n] for n in schema.names}, schema=schema)

    return df.select(F.col(key).cast("long").alias("doc_id"), text_of(df, text).alias("text")).mapInArrow(rows, SCANS)


def document_licenses(spark, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("matches")
