"""License scans: MinHash bands over overlapping windows retrieve templates, exact containment verifies.

Texts become five-word shingles.  Windows of ``2 * BLOCK`` shingles overlap by
half; each has ``BANDS`` minimum hashes, every one a band.  A window that lies
best over a template at ``CONTAINMENT`` agrees with one of the template's own
windows in at least ``least_similarity()`` of their shingles, so a band collides
with ``collision_probability()`` or more.  Templates of fewer than ``BLOCK``
shingles are looked for with windows of one shingle and a single band, which
collides for certain when a shingle is shared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm.common import land
from answerloom.operators.filters import key_filter, maybe_in

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
BLOCK = 16
BANDS = 12

# Identifiers of the SPDX list, and notices, opening paragraphs and whole texts of public licenses.
SPDX_IDENTIFIERS = (
    "0BSD", "AFL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "Artistic-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSD-4-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-NC-ND-4.0", "CC-BY-NC-SA-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "CDDL-1.0", "ECL-2.0", "EPL-1.0", "EPL-2.0", "EUPL-1.2", "GFDL-1.3-or-later", "GPL-2.0-only", "GPL-2.0-or-later",
    "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "MIT", "MIT-0", "MPL-2.0", "MS-PL", "NCSA", "ODbL-1.0", "OFL-1.1", "OSL-3.0", "PostgreSQL", "Python-2.0", "Ruby", "Unlicense",
    "UPL-1.0", "Vim", "W3C", "WTFPL", "Zlib",
)
_NO_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE"
    " WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR"
    " COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
    " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
    " Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_CONDITION = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)
_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
    " the following conditions are met:"
)
_BSD_TWO = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
    " Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
    " disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products"
    " derived from this software without specific prior written permission."
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES,"
    " INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE"
    " DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,"
    " SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR"
    " SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE"
    " OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
    " granted, provided that the above copyright notice and this permission notice appear in all copies."
)
TEMPLATES = (
    ("mit-notice", "Released under the MIT License."),
    ("mit-notice-licensed", "Licensed under the MIT License."),
    ("bsd-notice", "Licensed under the BSD License."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("gpl-2.0-notice", "This work is licensed under the GNU General Public License, version 2."),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl-3.0-notice", "Licensed under the GNU Lesser General Public License, version 3."),
    ("agpl-3.0-notice", "Licensed under the GNU Affero General Public License, version 3."),
    ("mpl-2.0-notice", "Licensed under the Mozilla Public License, version 2.0."),
    ("cc-by-4.0-notice", "Licensed under CC BY 4.0."),
    ("cc-by-sa-4.0-notice", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd-4.0-notice", "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-sa-4.0-notice", "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-4.0-notice-long", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0-notice-long", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0-1.0-notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense-notice", "This is free and unencumbered software released into the public domain."),
    ("mit", _MIT_GRANT),
    ("mit-full", f"{_MIT_GRANT} {_MIT_CONDITION} {_NO_WARRANTY}"),
    ("isc", _ISC_GRANT),
    (
        "isc-full",
        f"{_ISC_GRANT} THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"
        " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY"
        " SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR"
        " PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH"
        " THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("bsd", _BSD_OPENING),
    ("bsd-2-clause-full", f"{_BSD_OPENING} {_BSD_TWO} {_BSD_WARRANTY}"),
    ("bsd-3-clause-full", f"{_BSD_OPENING} {_BSD_TWO} {_BSD_THIRD} {_BSD_WARRANTY}"),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held"
        " liable for any damages arising from the use of this software. Permission is granted to anyone to use this software"
        " for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the"
        " following restrictions:",
    ),
    (
        "unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form"
        " or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "bsl-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and"
        " accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute,"
        " execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to"
        " whom the Software is furnished to do so, all subject to the following:",
    ),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at",
    ),
    (
        "apache-2.0-disclaimer",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        " an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the"
        " specific language governing permissions and limitations under the License.",
    ),
    (
        "gpl-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation; either version 2 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "gpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version.",
    ),
    (
        "lgpl-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)"
        " any later version.",
    ),
    (
        "agpl-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)"
        " any later version.",
    ),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at",
    ),
    (
        "epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"
        " which is available at",
    ),
    (
        "gfdl-1.3",
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation"
        " License, Version 1.3 or any later version published by the Free Software Foundation;",
    ),
    (
        "ofl-1.1",
        "This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is also"
        " available with a FAQ at",
    ),
    (
        "wtfpl",
        "This program is free software. It comes without any warranty, to the extent permitted by applicable law. You can"
        " redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2",
    ),
    *((f"spdx-{name}", f"SPDX-License-Identifier: {name}") for name in SPDX_IDENTIFIERS),
)


def least_similarity(block: int = BLOCK, containment: float = CONTAINMENT) -> float:
    """Similarity of the two windows that lie best over each other, for the template that has it worst.

    Two full windows lie at most half a block apart.  A template of a single
    block is its only window, and lies within one of twice its size.
    """
    pairs = ((containment * 1.5 * block, 4 * block), (containment * block, 3 * block))
    return min(shared / (together - shared) for shared, together in pairs)


def collision_probability(bands: int = BANDS) -> float:
    return 1 - (1 - least_similarity()) ** bands


def masks(bands: int = BANDS) -> list[int]:
    """Fixed pseudo-random 63-bit numbers: XORing hashes with one of them reorders them for one minimum."""
    state, out = 0x9E3779B97F4A7C15, []
    for _ in range(bands):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append((state ^ (state >> 29)) % 2**63)
    return out


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(text: Column) -> Column:
    """XXH64 of every five words in a row, case and signs aside; one of all words if there are fewer, none without."""
    cleaned = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return F.when(cleaned == "", F.array().cast("array<long>")).otherwise(
        _let(
            F.split(cleaned, r"[^\p{L}\p{N}]+"),
            lambda w: F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(w) - SHINGLE_WORDS, F.lit(0))),
                lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(SHINGLE_WORDS))),
            ),
        )
    )


def bands(hashes: Column) -> Column:
    """Band values of the overlapping windows, ``BANDS`` for each; one window for up to ``BLOCK`` shingles."""
    order = F.array(*map(F.lit, masks()))
    highest = F.lit(2**63 - 1)
    blocks = F.transform(
        F.sequence(F.lit(0), ((F.size(hashes) - 1) / BLOCK).cast("int")),
        lambda c: _let(
            # Not slice(): inside a lambda that copies the whole array each time.  Missing ends are NULL, which least() skips.
            F.array(*(F.get(hashes, c * BLOCK + k) for k in range(BLOCK))),
            lambda part: F.transform(
                order, lambda m: F.aggregate(part, highest, lambda a, x: F.least(a, x.bitwiseXOR(m)))
            ),
        ),
    )

    def windows(b: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(b) - 2, F.lit(0)))
        least = F.transform(
            starts,
            lambda c: F.zip_with(F.get(b, c), F.coalesce(F.get(b, c + 1), F.get(b, c)), lambda x, y: F.least(x, y)),
        )
        return F.flatten(F.transform(least, lambda w: F.transform(w, lambda v, k: F.xxhash64(v, k))))

    return F.when(F.size(hashes) == 0, F.array().cast("array<long>")).otherwise(_let(blocks, windows))


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES), "license_id string, text string")


def short_keys(text: Column, lengths: list[int], first_words: list[str]) -> Column:
    """(at, key) of every run of so many words that begins with one of ``first_words``; lengths below ``SHINGLE_WORDS``."""
    if not lengths:
        return F.array().cast("array<struct<at:int,key:bigint>>")
    cleaned = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"^[^\p{L}\p{N}]+", "")

    def runs(w: Column) -> Column:
        def at(word: Column, i: Column) -> Column:
            keys = [
                F.struct(
                    i.alias("at"),
                    F.when(i + n <= F.size(w), F.xxhash64(F.lit(n), *(F.get(w, i + k) for k in range(n)))).alias("key"),
                )
                for n in lengths
            ]
            return F.when(word.isin(first_words), F.array(*keys))

        return F.filter(F.flatten(F.filter(F.transform(w, at), lambda x: x.isNotNull())), lambda x: x["key"].isNotNull())

    # Most texts have none of these words at all.
    some = reduce(lambda a, b: a | b, (F.contains(cleaned, F.lit(f)) for f in first_words))
    return F.when(some, _let(F.split(cleaned, r"[^\p{L}\p{N}]+"), runs)).otherwise(F.array().cast("array<struct<at:int,key:bigint>>"))


def _short_templates(templates: DataFrame) -> DataFrame:
    """license_id, n, first, key of the templates with fewer words than a shingle."""
    cleaned = F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    w = templates.select("license_id", F.split(cleaned, r"[^\p{L}\p{N}]+").alias("w"), cleaned.alias("cleaned"))
    short = w.filter((F.col("cleaned") != "") & (F.size("w") < SHINGLE_WORDS))
    key = F.coalesce(*(F.when(F.size("w") == n, F.xxhash64(F.lit(n), *(F.get("w", F.lit(k)) for k in range(n)))) for n in range(1, SHINGLE_WORDS)))
    return short.select("license_id", F.size("w").alias("n"), F.get("w", F.lit(0)).alias("first"), key.alias("_key")).distinct()


def scan(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """``templates`` (license_id, text) found in ``docs`` (doc_id, text).

    One row for each row of ``docs`` and template that it holds: doc_id,
    license_id, ``containment`` (share of the template's distinct shingles near
    the best place, at least ``containment``), ``start`` (its word) and
    ``n_places`` (windows that retrieved it).  Templates of fewer words than a
    shingle are held where their words stand side by side.  NULL and empty texts and
    templates hold nothing; long texts are searched whole.  Repeated rows are
    each reported; ties go to the earliest place.  Other columns are not read;
    an empty table has no rows.
    """
    # Templates are a list that the caller keeps; what is learned from them for the texts' expressions is one row for
    # each short template.  Written, so that their sizes are known: few are broadcast, many are joined by key.
    numbered = land(templates.select("license_id", "text").distinct().withColumn("_template", F.xxhash64("license_id", "text")), "license-set")
    short = land(_short_templates(numbered), "license-short")
    openings = short.select("n", "first").distinct().collect()
    lengths, first_words = sorted({r.n for r in openings}), sorted({r["first"] for r in openings})

    word_count = F.size(F.split(F.regexp_replace(F.lower("text"), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""), r"[^\p{L}\p{N}]+"))
    known = numbered.filter(word_count >= SHINGLE_WORDS).select("license_id", "_template", shingles(F.col("text")).alias("template"))
    known = land(known.withColumn("template", F.array_distinct("template")), "license-templates")
    keys = F.when(F.size("template") < BLOCK, F.col("template")).otherwise(bands(F.col("template")))
    wanted = known.select("_template", F.explode(F.array_distinct(keys)).alias("_key")).unionAll(
        short.select(F.xxhash64("license_id", "_key").alias("_template"), "_key")
    )
    wanted = land(wanted, "license-keys")

    named = docs.select("doc_id", "text", F.xxhash64("text").alias("_text_hash"))
    keyed = named.select(
        "doc_id", "_text_hash", shingles(F.col("text")).alias("_h"), short_keys(F.col("text"), lengths, first_words).alias("_s")
    ).select(
        "doc_id", "_text_hash", F.size("_h").alias("_n"), F.size("_s").alias("_m"), F.col("_s.at").alias("_short_at"),
        F.concat(F.col("_s.key"), F.col("_h"), bands(F.col("_h"))).alias("_keys"),
    )
    # The outer form: for the inner one Spark would filter on the array first, and make it anew for that.
    every = keyed.select("doc_id", "_text_hash", "_n", "_m", "_short_at", F.posexplode_outer("_keys").alias("_at", "_key"))
    # Short runs come first, then single shingles, then the windows with BANDS values each.
    behind = F.col("_at") - F.col("_m")
    place = (
        F.when(behind < 0, F.get("_short_at", F.col("_at"))).when(behind < F.col("_n"), behind)
        .otherwise((F.floor((behind - F.col("_n")) / BANDS) * BLOCK).cast("int"))
    )
    candidates = land(
        every.join(wanted, "_key")
        .select("doc_id", "_text_hash", "_template", place.alias("_place"))
        .groupBy("doc_id", "_text_hash", "_template")
        .agg(F.collect_set("_place").alias("_places")),
        "license-candidates",
    )
    # A short template is its key, so a candidate for it is a find: nothing of it is left to verify.
    every_template = known.select("_template", "license_id", "template").unionAll(
        short.select(F.xxhash64("license_id", "_key").alias("_template"), "license_id", F.array().cast("array<bigint>").alias("template"))
    )
    found = candidates.join(every_template, "_template").select(
        F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash"), "license_id", "template", "_places"
    )
    size = F.size("template")

    def share(hashes: Column, place: Column) -> Column:
        start = F.greatest(place - size, F.lit(0))
        end = F.least(place + size + 2 * BLOCK, F.size(hashes)) - 1
        near = F.transform(F.sequence(start, end), lambda i: F.get(hashes, i))
        held = F.size(F.array_intersect(F.col("template"), near)) / size
        return F.struct((-held).alias("missing"), place.alias("place"))

    best = _let(shingles(F.col("text")), lambda h: F.array_min(F.transform("_places", lambda p: share(h, p))))
    certain = F.struct(F.lit(-1.0).alias("missing"), F.array_min("_places").alias("place"))
    texts = _candidates_only(named, found)
    same = texts["doc_id"].eqNullSafe(found["_id"]) & (texts["_text_hash"] == found["_hash"])
    verified = texts.join(found, same).select(
        "doc_id", "license_id", F.size("_places").cast("long").alias("n_places"), F.when(size == 0, certain).otherwise(best).alias("best")
    )
    return verified.select(
        "doc_id", "license_id", (-F.col("best.missing")).alias("containment"), F.col("best.place").alias("start"), "n_places"
    ).filter(F.col("containment") >= containment)


def _candidates_only(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The ``rows`` (doc_id, _text_hash, ...) that ``found`` (_id, _hash) may name, by a filter of bounded size; nothing is shuffled."""
    key = lambda doc_id, text_hash: F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), doc_id.isNull(), text_hash)
    marked = key_filter(found.select(key(F.col("_id"), F.col("_hash")).alias("key")))
    return maybe_in(rows.withColumn("key", key(F.col("doc_id"), F.col("_text_hash"))), marked).drop("key")


