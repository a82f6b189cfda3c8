"""License scan: exact set-similarity join of text blocks with license templates.

A block matches a template if it holds at least ``threshold`` of the
template's different words.  Blocks are the lines (long ones in windows) and,
since notices are wrapped over lines, half-overlapping windows over the words
of the whole text.  A template of up to s words (s a power of two) is held
against windows of 2 s words that start every s, so any stretch of its length
lies whole in one and no window is much wider than the notice.  Words are put in
one global order, rarest in the corpus first.  Of a template that needs o of
its t words, any matching block must hold one of the first t - o + 1 (prefix
filter) and at least o words of the templates' vocabulary (length filter);
and behind the first common word, at their places i and j in the global
order, both sides must have enough words left: min(t - i, b - j) >= o
(positional filter).  What passes is counted exactly, so every block that
meets the threshold is found.

The templates are a parameter of bounded size; only they are broadcast.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text, plain_words, spool

# Notices that licenses ask to be attached, by label.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# A line of more words is taken in windows of so many, each starting half a window on.
BLOCK_WORDS = 128


def blocks_of(text: str) -> Iterator[tuple[int, list[bytes]]]:
    """(first word, words) of every block of a text."""
    at = 0
    for line in text.split("\n"):
        words = plain_words(line)
        for lo in range(0, max(1, len(words) - BLOCK_WORDS // 2), BLOCK_WORDS // 2):
            if words:
                yield at + lo, words[lo : lo + BLOCK_WORDS]
        at += len(words)


def span_of(words: list[bytes]) -> int:
    """Step of the windows that a template of these words is held against."""
    return max(8, 1 << (len(words) - 1).bit_length())


def windows_of(words: list[bytes], place: dict[bytes, int], spans: list[int]) -> Iterator[tuple[int, int, set[int]]]:
    """(span, first word, places of the vocabulary words) of every window of a text that holds any."""
    hits = [(i, place[w]) for i, w in enumerate(words) if w in place]
    for span in spans:
        cells: dict[int, set[int]] = {}
        for i, p in hits:
            cells.setdefault(i // span, set()).add(p)
        last = max(0, -(-len(words) // span) - 2)  # the window that reaches the end
        for c in sorted({max(0, min(c, last)) for k in cells for c in (k - 1, k)}):
            yield span, c * span, cells.get(c, set()) | cells.get(c + 1, set())


def suppressed(found: list[dict]) -> list[bool]:
    """Which matches of one text, given by first word, say no more than a
    better match that holds all their common words as well: one in the same
    block (larger containment, then the longer template, then the first), or
    one of larger containment in an overlapping block."""
    widest = max((m["n_words"] for m in found), default=0)
    firsts = [m["first_word"] for m in found]
    out = []
    for m in found:
        lo, hi = m["first_word"], m["first_word"] + m["n_words"]
        rank, own = (m["containment"], m["size"], -m["template"]), set(m["common"])
        near = found[bisect_left(firsts, lo - widest) : bisect_left(firsts, hi)]
        out.append(any(
            own.issubset(b["common"])
            and (
                (b["first_word"], b["n_words"], b["span"]) == (lo, m["n_words"], m["span"]) and (b["containment"], b["size"], -b["template"]) > rank
                or b["containment"] > m["containment"] and b["first_word"] + b["n_words"] > lo
            )
            for b in near
        ))
    return out


def phrase_places(words: list[bytes], phrases: list[tuple[list[bytes], str]]) -> list[tuple[int, str]]:
    """(start, label) of every place where a phrase's words stand consecutively."""
    ends = {p[-1] for p, _ in phrases}
    return [
        (i - len(p) + 1, label)
        for i, w in enumerate(words)
        if w in ends
        for p, label in phrases
        if w == p[-1] and i >= len(p) - 1 and words[i - len(p) + 1 : i + 1] == p
    ]


def word_counts(docs: DataFrame, vocabulary: set[bytes]) -> dict[str, int]:
    """Documents that hold each word of the templates' vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total.update(vocabulary.intersection(plain_words(text)))
        words = [w.decode() for w in total]
        yield pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(total.values(), pa.int64())})

    counted = docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in counted.collect()}


def license_scan(
    docs: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    phrases: tuple[tuple[str, str], ...] = PHRASES,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Licenses that whole texts name, by phrase and by template.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased.  Returns one row per input row: doc_id, n_words, n_base (all
    places where a phrase stands), first_word and last_word (their smallest
    and largest start, or null), base_labels, labels (the phrases' and the
    templates', distinct, sorted, comma-joined), matches (first_word,
    n_words, template, label, containment of every block and template that
    reach the threshold; ``suppressed`` marks those whose common words a
    better match in the block holds too, as cc-by beside cc-by-sa, or a fuller
    one in an overlapping block: they give no label and no score) and score
    (the largest containment; a phrase counts as 1).

    Defined cases: a null, empty or wordless text has 0 words, empty labels,
    no matches and score 0; long lines are taken in half-overlapping windows,
    all of them; a notice may run over any number of lines; repeated rows and null ids are answered row by row; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    sets = [frozenset(plain_words(text)) for _, text in templates]
    vocabulary = set().union(*sets)
    counts = word_counts(rows, vocabulary)
    place = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w.decode(), 0), w)))}
    step = [span_of(plain_words(text)) for _, text in templates]
    need = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    ordered = [sorted(place[w] for w in s) for s in sets]
    prefix = [(t, o, len(ws), step[t], ws[i], i) for t, (ws, o) in enumerate(zip(ordered, need, strict=True)) for i in range(len(ws) - o + 1)]
    in_prefix = {w for w, i in place.items() if any(i == p for *_, p, _ in prefix)}
    ahead = {place[w] for w in in_prefix}
    spans = sorted(set(step))
    fewest = {span: min(o for o, s in zip(need, step, strict=True) if s == span) for span in spans}
    spelled = [(plain_words(p), label) for p, label in phrases]
    least = min(need)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = plain_words(text)
                found = phrase_places(words, spelled)
                starts = [at for at, _ in found]
                blocks = []
                if not in_prefix.isdisjoint(words):
                    for first, block in blocks_of(text):
                        own = sorted(place[w] for w in vocabulary.intersection(block))
                        if len(own) >= least and not in_prefix.isdisjoint(block):
                            blocks.append({"first_word": first, "n_words": len(block), "span": 0, "words": own})
                    for span, first, own in windows_of(words, place, spans):
                        if len(own) >= fewest[span] and not ahead.isdisjoint(own):
                            blocks.append({"first_word": first, "n_words": min(2 * span, len(words) - first), "span": span, "words": sorted(own)})
                labels = sorted({label for _, label in found})
                out.append({"doc_id": doc_id, "n_words": len(words), "n_base": len(found), "first_word": min(starts, default=None), "last_word": max(starts, default=None), "base": labels, "blocks": blocks})
            yield pa.RecordBatch.from_pylist(out, schema=SCANNED_ARROW)

    scanned = spool(rows.mapInArrow(scan, SCANNED).withColumn("row", F.monotonically_increasing_id()), "license-blocks")
    blocks = scanned.select("row", F.explode("blocks").alias("b")).select("row", "b.*", F.posexplode("b.words").alias("j", "word"))
    prefixes = spark.createDataFrame(prefix, "template int, need int, size int, step int, word int, i int")
    candidates = (
        blocks.join(F.broadcast(prefixes), "word")
        .where("span = 0 or span = step")
        .groupBy("row", "first_word", "n_words", "span", "template", "need", "size")
        .agg(F.min(F.struct("i", "j")).alias("at"), F.first("words").alias("words"))
        .where(F.least(F.col("size") - F.col("at.i"), F.size("words") - F.col("at.j")) >= F.col("need"))
    )
    wanted = spark.createDataFrame([(t, label, ws) for t, ((label, _), ws) in enumerate(zip(templates, ordered, strict=True))], "template int, label string, own array<int>")
    verified = (
        candidates.join(F.broadcast(wanted), "template")
        .withColumn("common", F.array_intersect("words", "own"))
        .where(F.size("common") >= F.col("need"))
        .withColumn("containment", F.size("common") / F.col("size"))
    )

    def suppress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = sorted(found, key=lambda m: m["first_word"])
                shown = [{k: m[k] for k in MATCH} | {"suppressed": x} for m, x in zip(found, suppressed(found), strict=True)]
                out.append({"row": row, "matches": sorted(shown, key=lambda m: tuple(m.values()))})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("row", pa.int64()), ("matches", pa.list_(MATCHES_ARROW))]))

    of_row = F.collect_list(F.struct("first_word", "n_words", "span", "template", "label", "size", "containment", "common"))
    matches = verified.groupBy("row").agg(of_row.alias("found")).mapInArrow(suppress, f"row long, matches {MATCHES}")
    empty = F.array().cast(MATCHES)
    telling = F.filter("matches", lambda m: ~m["suppressed"])
    return (
        scanned.join(matches, "row", "left")
        .withColumn("matches", F.coalesce("matches", empty))
        .select(
            "doc_id",
            "n_words",
            "n_base",
            "first_word",
            "last_word",
            F.array_join("base", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("base", F.transform(telling, lambda m: m["label"]))), ",").alias("labels"),
            "matches",
            F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform(telling, lambda m: m["containment"])), F.lit(0.0))).alias("score"),
        )
    )


MATCHES = "array<struct<first_word:bigint,n_words:bigint,template:int,label:string,containment:double,suppressed:boolean>>"
MATCH = ("first_word", "n_words", "template", "label", "containment")
MATCHES_ARROW = pa.struct(list(zip((*MATCH, "suppressed"), (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.bool_()), strict=True)))
SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, blocks array<struct<first_word:bigint,n_words:bigint,span:int,words:array<int>>>"
SCANNED_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base", pa.list_(pa.string())), ("blocks", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("span", pa.int32()), ("words", pa.list_(pa.int32()))]))),
    ]
)
