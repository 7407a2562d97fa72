"""License scans: MinHash bands over overlapping windows retrieve notices, exact shingle containment verifies them.

Texts and templates are cut into words without case and outer punctuation and into shingles of five words.  For a
template of n shingles, windows of n shingles slide over the text, a quarter of n apart.  A window is retrieved if
one of its bands (one MinHash value each) equals the template's.  A window that holds at least 80 % of the template
has a Jaccard similarity of at least 2/3 when aligned and at least 1/2 when a quarter off by half, so that with eight bands it is
missed with probability (1/2)^8 at most, and (1/3)^8 when aligned.  A retrieved window, widened by half its length on
both sides, is verified by the share of the template's shingles in it.

Texts without any of the words in `ANCHORS` are skipped before all this.  That loses nothing: more than a fifth of the
shingles of every template hold such a word (`Template` checks it), so a text with 80 % of them has one.

All work is SQL functions in one pass; no shuffle, no Python.

Edge cases: a null or empty text, or one with fewer than five words, has no shingle and no license; a key occurs once per
license found in it and not at all if none is; repeated rows give repeated rows; of several places with equal
containment the first counts; an empty table gives an empty table; other columns are ignored whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.texts import let, whole, words

SHINGLE = 5
BANDS = 8
#: Words of license notices, as they are looked for in whole texts.
ANCHORS = r"(?i)licen[cs]|copyright|permission|redistribut|warrant|public domain|software|hereby"

#: Notices as their licenses or license stewards publish them (fixed values).
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "MIT-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": (
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "LGPL": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "AGPL": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "BSD": (
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer."
    ),
    "BSD-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer"
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def plain_words(text: str) -> list[str]:
    """Words of a template, as `shingle_hashes` sees those of a text."""
    found = (re.sub(r"^[\W_]+|[\W_]+$", "", word).lower() for word in text.split())
    return [word for word in found if word]


@dataclass(frozen=True)
class Template:
    name: str
    text: str

    def __post_init__(self) -> None:
        anchored = sum(re.search(ANCHORS, shingle) is not None for shingle in self.shingles)
        if anchored * 5 <= len(self.shingles):
            raise ValueError(f"{self.name}: too few shingles hold one of the anchor words")

    @property
    def shingles(self) -> list[str]:
        found = plain_words(self.text)
        return list(dict.fromkeys(" ".join(found[i : i + SHINGLE]) for i in range(len(found) - SHINGLE + 1)))

    def hashes(self) -> list[int]:
        return [signed_hash(shingle) for shingle in self.shingles]


def signed_hash(text: str) -> int:
    """The number that Spark's xxhash64 gives a string."""
    from xxhash import xxh64_intdigest

    number = xxh64_intdigest(text.encode(), 42)
    return number - (1 << 64) if number >> 63 else number


def band_hash(shingle: int, band: int) -> int:
    """The number that Spark's xxhash64 gives a long (shingle) and an int (band)."""
    from xxhash import xxh64_intdigest

    number = xxh64_intdigest((shingle & (1 << 64) - 1).to_bytes(8, "little"), _fold(band))
    return number - (1 << 64) if number >> 63 else number


def _fold(band: int) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(band.to_bytes(8, "little"), 42)


def shingle_hashes(text: Column) -> Column:
    """64-bit hashes of a text's shingles in order."""
    inner = r"(?s)[\p{L}\p{N}](?:.*[\p{L}\p{N}])?"
    plain = F.array_remove(F.transform(words(text), lambda word: F.lower(F.regexp_extract(word, inner, 0))), "")

    def shingles(found: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(found) - SHINGLE)
        joined = F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(found, i + 1, SHINGLE), " ")))
        return F.when(F.size(found) >= SHINGLE, joined).otherwise(F.array().cast("array<bigint>"))

    return let(plain, shingles)


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(value).cast("long") for value in values])


def matches(hashes: Column, bands: Column, template: Template) -> Column:
    """The best window for a template: struct of its containment and start, null without a retrieved window."""
    own = template.hashes()
    n = len(own)
    signature = [min(band_hash(value, band) for value in own) for band in range(BANDS)]
    starts = F.sequence(F.lit(0), F.greatest(F.size(hashes) - n, F.lit(0)), F.lit(max(1, n // 4)))
    # The last window ends with the text.
    starts = F.array_union(starts, F.array(F.greatest(F.size(hashes) - n, F.lit(0))))

    def retrieved(start: Column) -> Column:
        equal = [F.array_min(F.slice(bands[band], start + 1, n)) == F.lit(signature[band]) for band in range(BANDS)]
        return reduce(lambda a, b: a | b, equal)

    def verified(start: Column) -> Column:
        first = F.greatest(start - n // 2, F.lit(0))
        region = F.slice(hashes, first + 1, start - first + n + (n + 1) // 2)
        held = F.array_intersect(F.array_distinct(_longs(own)), region)
        return F.struct((F.size(held) / n).alias("containment"), (-start).alias("place"))

    return F.array_max(F.transform(F.filter(starts, retrieved), verified))


def _named(name: str) -> Callable[[Column], Column]:
    return lambda match: F.struct(
        F.lit(name).alias("license"),
        match["containment"].alias("containment"),
        (-match["place"]).cast("long").alias("word_at"),
    )


def licenses(text: Column, templates: list[Template], containment: float) -> Column:
    """Licenses of a text: array of structs of name, containment and the window's first word."""

    def found(hashes: Column) -> Column:
        def best(bands: Column) -> Column:
            named = [let(matches(hashes, bands, template), _named(template.name)) for template in templates]
            return F.filter(F.array(*named), lambda x: x["containment"] >= containment)

        seeds = F.array(*[F.lit(band).cast("long") for band in range(BANDS)])
        bands = F.transform(seeds, lambda band: F.transform(hashes, lambda value: F.xxhash64(band, value)))
        return F.when(F.size(hashes) > 0, let(bands, best))

    return F.when(text.rlike(ANCHORS), let(shingle_hashes(text), found))


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    notices: dict[str, str] | None = None,
    containment: float = 0.8,
) -> DataFrame:
    """`key`, `license`, `containment` and `word_at` of every license found."""
    templates = [Template(name, notice) for name, notice in (notices or NOTICES).items()]
    texts = docs.select(F.col(key).alias("key"), whole(text).alias("text"))
    # With explode() the optimiser would add a filter that computes the whole expression once more.
    found = texts.select("key", F.explode_outer(licenses(F.col("text"), templates, containment)).alias("found"))
    return found.where(F.col("found").isNotNull()).select(F.col("key").alias(key), "found.*")
