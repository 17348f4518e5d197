"""License scans: windows of normalised text compared to licence texts by the Dice coefficient of word bigrams.

A window begins and ends with a bigram of the template, and is no longer than a window that can
still reach the threshold. A template is looked at only where enough of its bigrams come together.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
THRESHOLD_PERCENT = 80

# Parts that several licence texts share.
_WARRANTY = (
    "This software is provided by the copyright holders and contributors \"as is\" and any express or implied"
    " warranties, including, but not limited to, the implied warranties of merchantability and fitness for a"
    " particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable for any"
    " direct, indirect, incidental, special, exemplary, or consequential damages (including, but not limited to,"
    " procurement of substitute goods or services; loss of use, data, or profits; or business interruption) however"
    " caused and on any theory of liability, whether in contract, strict liability, or tort (including negligence or"
    " otherwise) arising in any way out of the use of this software, even if advised of the possibility of such damage."
)
_TWO_CLAUSES = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this"
    " list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above"
    " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution."
)
_GPL = (
    "This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU {2}General"
    " Public License as published by the Free Software Foundation{1} This program is distributed in the hope that it"
    " will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
    " PARTICULAR PURPOSE. See the GNU {2}General Public License for more details."
)

#: Notices by which licences are named in texts, and the texts of licences themselves.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        " software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS"
        " OF ANY KIND, either express or implied. See the License for the specific language governing permissions and"
        " limitations under the License.",
    ),
    "bsd-2-clause": (f"{_TWO_CLAUSES} {_WARRANTY}",),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met",
        f"{_TWO_CLAUSES} 3. Neither the name of the copyright holder nor the names of its contributors may be used to"
        f" endorse or promote products derived from this software without specific prior written permission. {_WARRANTY}",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0.",),
    "cc-by-nc-4.0": ("Licensed under CC BY-NC 4.0.",),
    "cc-by-sa-4.0": ("Licensed under CC BY-SA 4.0.",),
    "gpl-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        _GPL.format(";", "; either version 2 of the License, or (at your option) any later version.", ""),
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        _GPL.format(":", ", either version 3 of the License, or (at your option) any later version.", ""),
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
        " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"
        " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR"
        " ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,"
        " DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "lgpl-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        _GPL.format(";", "; either version 2.1 of the License, or (at your option) any later version.", "Lesser "),
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the"
        " Software, and to permit persons to whom the Software is furnished to do so, subject to the following"
        " conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND,"
        " EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
        " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,"
        " DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN"
        " CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,"
        " publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,"
        " for any purpose, commercial or non-commercial, and by any means.",
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be"
        " held liable for any damages arising from the use of this software. Permission is granted to anyone to use"
        " this software for any purpose, including commercial applications, and to alter it and redistribute it freely,"
        " subject to the following restrictions",
    ),
}


def bigrams(words: Sequence[bytes]) -> list[tuple[bytes, bytes]]:
    return list(zip(words, words[1:], strict=False))


class Scanner:
    """Templates under their bigrams, so that a text meets only those it shares enough with."""

    def __init__(self, templates: Mapping[str, Sequence[str]], percent: int):
        self.percent = percent
        self.names: list[str] = []
        self.sizes: list[int] = []
        self.owners: dict[tuple[bytes, bytes], list[int]] = {}
        for name, texts in templates.items():
            for text in texts:
                found = set(bigrams(WORD.findall(text.encode().lower())))
                if not found:
                    continue
                for pair in found:
                    self.owners.setdefault(pair, []).append(len(self.names))
                self.names.append(name)
                self.sizes.append(len(found))
        self.firsts = {a for a, _ in self.owners}

    def windows(self, words: list[bytes]) -> Iterator[tuple[float, str, int, int]]:
        """Dice, licence, first and last bigram of all windows that reach the threshold."""
        p, places = self.percent, {}
        for i, word in enumerate(words[:-1]):
            if word in self.firsts:
                for t in self.owners.get((word, words[i + 1]), ()):
                    places.setdefault(t, []).append(i)
        for t, at in places.items():
            size = self.sizes[t]
            # Dice is at most 2 min / (a + b): so many bigrams in common, and no longer a window.
            least, longest = -(-p * size // (200 - p)), (200 - p) * size // p
            if len(at) < least or len({(words[i], words[i + 1]) for i in at}) < least:
                continue
            for k, first in enumerate(at):
                beyond = bisect_right(at, first + longest - 1)
                if beyond - k < least:
                    continue
                seen, common, upto = set(), 0, first
                for last in at[k:beyond]:
                    fresh = (words[last], words[last + 1]) not in seen
                    seen.update((words[i], words[i + 1]) for i in range(upto, last + 1))
                    common, upto = common + fresh, last + 1
                    if 200 * common >= p * (size + len(seen)):
                        yield 2 * common / (size + len(seen)), self.names[t], first, last

    def scan(self, text: bytes | None) -> tuple[str | None, float, int]:
        """Best licence and its coefficient (ties: the first by name), number of places."""
        found = list(self.windows(WORD.findall((text or b"").lower())))
        if not found:
            return None, 0.0, 0
        dice, name, _, _ = min(found, key=lambda w: (-w[0], w[1]))
        count, reach = 0, -1
        for _, _, first, last in sorted(found, key=lambda w: w[2]):
            count += first > reach
            reach = max(reach, last)
        return name, dice, count


def _scan(scanner: Scanner) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scanner.scan(t.as_py()) for t in batch.column("data")]
            names, dice, counts = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "license": pa.array(names, pa.string()),
                    "dice": pa.array(dice, pa.float64()),
                    "n_matches": pa.array(counts, pa.int64()),
                }
            )

    return run


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, percent: int = THRESHOLD_PERCENT
) -> DataFrame:
    """``doc_id, license, dice, n_matches`` of every row.

    Words are lower-cased runs of letters, digits and characters beyond ASCII. Every window of a
    text that begins and ends with a bigram of a template and is at most ``(200 - percent) /
    percent`` times as long is compared with it, wherever it stands in lines and paragraphs.
    Windows that reach ``percent`` of Dice over distinct bigrams name a licence, the best of all
    the document's; of equally good ones the first by name. ``n_matches`` counts the places:
    windows that overlap are one. Null, empty and unlicensed texts have no licence, 0.0 and 0.
    Repeated rows each get a row. Texts are read whole.
    """
    kind = docs.select("doc_id").dtypes[0][1]
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("data"))
    return rows.mapInArrow(_scan(Scanner(templates, percent)), f"doc_id {kind}, license string, dice double, n_matches long")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """The licences of all documents."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_VALUES = ", ".join(
    "('{}', '{}')".format(n, t.replace("'", "''")) for n, texts in TEMPLATES.items() for t in texts
)
_PAIRS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"

OP1_SQL = rf"""
WITH t AS (
    SELECT *, row_number() OVER () AS t, len(g) AS size, -(-80 * len(g) // 120) AS least, 120 * len(g) // 80 AS longest
    FROM (SELECT name, list_distinct({_PAIRS}) AS g
          FROM (SELECT name, {_WORDS.format('notice')} AS w FROM (VALUES {_VALUES}) AS v(name, notice)))
), d AS (
    SELECT doc_id, {_PAIRS} AS b FROM (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents) WHERE len(w) > 1
), h AS (
    SELECT doc_id, t, p FROM (SELECT doc_id, unnest(b) AS pair, unnest(range(1, len(b) + 1)) AS p FROM d)
    JOIN (SELECT t, unnest(g) AS pair FROM t) USING (pair)
), n AS (
    SELECT doc_id, t FROM h JOIN t USING (t) GROUP BY doc_id, t, least HAVING count(*) >= least
), s AS (
    SELECT x.doc_id, x.t, x.p AS first, y.p AS last FROM n JOIN h x USING (doc_id, t) JOIN t USING (t)
    JOIN h y ON y.doc_id = x.doc_id AND y.t = x.t AND y.p BETWEEN x.p + least - 1 AND x.p + longest - 1
), c AS (
    SELECT s.*, name, size + len(list_distinct(b[first:last])) AS both_sizes, len(list_intersect(g, b[first:last])) AS common
    FROM s JOIN t USING (t) JOIN d USING (doc_id)
), m AS (
    SELECT *, 2 * common / both_sizes AS dice FROM c WHERE 200 * common >= 80 * both_sizes
), o AS (
    SELECT doc_id, count(*) FILTER (reach IS NULL OR first > reach) AS n_matches FROM (
        SELECT doc_id, first, max(last) OVER (PARTITION BY doc_id ORDER BY first, last
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM m)
    GROUP BY doc_id
), r AS (
    SELECT doc_id, first(name ORDER BY dice DESC, name) AS license, max(dice) AS dice FROM m GROUP BY doc_id
)
SELECT doc_id, license, coalesce(dice, 0.0) AS dice, coalesce(n_matches, 0) AS n_matches
FROM documents LEFT JOIN r USING (doc_id) LEFT JOIN o USING (doc_id)
"""
