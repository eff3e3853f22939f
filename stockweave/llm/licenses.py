"""Licence scans: Dice coefficient over word bigrams against licence templates.

A unit of text (the whole text, and every line of it) is normalised to words; its bigrams are
compared, with their multiplicities, to those of templates. For a coefficient of t the numbers of
bigrams a and b must satisfy t/(2-t) <= a/b <= (2-t)/t, so the number of words alone rules out most
templates, and most units are never compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import by_value, map_batches, record_batch, utf8
from stockweave.llm.decontaminate import words_of

by_value(__name__)

# Licence notices by name.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "all-rights-reserved": "All rights reserved.",
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:"
    ),
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "mit": "Released under the MIT License.",
    "mit-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
}


@dataclass(frozen=True)
class LicenseParams:
    """``threshold``: least Dice coefficient; ``template_bytes``: bound of the templates' text,
    which is sent to every task."""

    threshold: float = 0.8
    template_bytes: int = 16 << 20


def bigrams(words: list[bytes]):
    from collections import Counter

    return Counter(zip(words, words[1:]))


def template_index(templates: dict[str, str], threshold: float):
    """Templates by every number of bigrams that a unit within the bounds can have."""
    by_size: dict[int, list] = {}
    for name in sorted(templates):
        words = words_of(templates[name].encode())
        b = len(words) - 1
        if b < 1:
            continue
        low, high = b * threshold / (2 - threshold), b * (2 - threshold) / threshold
        for a in range(max(1, int(low)), int(high) + 2):
            if 2 * min(a, b) >= threshold * (a + b):
                by_size.setdefault(a, []).append((name, b, bigrams(words)))
    return by_size


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, params: LicenseParams = LicenseParams()
) -> DataFrame:
    """Licences that every whole text, or a line of it, states.

    One row per row of ``docs``: doc_id, n_units (lines with a match, and one if the whole text of
    several lines has one), licenses (names matched, sorted, comma-joined), best_license and
    best_dice (largest coefficient, ties to the smaller name; null without a match). A line ends at a
    line feed; A-Z are lower-cased and ASCII other than letters and digits parts words. Null and
    empty texts and units of fewer than two words match nothing; repeated rows are scanned each.
    """
    chosen = TEMPLATES if templates is None else templates
    if sum(len(t.encode()) for t in chosen.values()) > params.template_bytes:
        raise ValueError("the templates exceed template_bytes; scan with one part of them after another")
    by_size = template_index(chosen, params.threshold)

    def matches(words):
        candidates = by_size.get(len(words) - 1)
        if not candidates:
            return []
        own, a = bigrams(words), len(words) - 1
        scored = [(2 * (own & other).total() / (a + b), name) for name, b, other in candidates]
        return [(dice, name) for dice, name in scored if dice >= params.threshold]

    def scan(batch):
        units, names, best, top = [], [], [], []
        for data in batch.column(1).to_pylist():
            found = []
            count = 0
            # A text of one line is that line.
            lines = [words_of(line) for line in data.split(b"\n")] if data else []
            for words in [*lines, [w for line in lines for w in line]] if len(lines) > 1 else lines:
                hits = matches(words)
                count += bool(hits)
                found += hits
            units.append(count)
            names.append(",".join(sorted({n for _, n in found})))
            dice, name = min(found, key=lambda x: (-x[0], x[1]), default=(None, None))
            best.append(name)
            top.append(dice)
        return record_batch(
            doc_id=(batch.column(0), None), n_units=(units, "int64"), licenses=(names, "string"),
            best_license=(best, "string"), best_dice=(top, "float64"),
        )

    rows = docs.select("doc_id", utf8("text").alias("data"))
    kind = dict(rows.dtypes)["doc_id"]
    return map_batches(
        rows, scan, f"doc_id {kind}, n_units long, licenses string, best_license string, best_dice double"
    )
