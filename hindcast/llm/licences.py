"""License scans: normalised text units compared with licence templates by the Dice coefficient over word bigrams.

Units are the lines of a text, its paragraphs where blank lines part it, and the whole text where it has several lines.
Normalising lowers the text and turns everything but letters and digits into single blanks. A unit and a template are
compared as sets of bigrams. A Dice coefficient of at least t needs sizes within a factor (2 - t) / t of each other, so
each template is listed under the sizes it admits and a unit meets only the templates under its own size.

Defined results: null, empty and one-word texts match nothing; repeated rows are scanned each on their own; equal
coefficients go to the first licence by name; an empty table gives no rows; other columns are ignored. DataFrame
functions only; the template table is broadcast and has at most ``len(TEMPLATES)`` entries per admitted size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0.8
MARKS = r"[^\p{L}\p{N}]+"

# Wording of public licence notices.
TEMPLATES = {
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License."
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "bsd-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
        "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
        "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "mit-notice": "Released under the MIT License.",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
}


def words_of(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), MARKS, " ")), " ")


def bigrams_of(words: Column) -> Column:
    """The set of word pairs, as hashes; ``words`` has two words or more."""
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
        lambda a, b: F.xxhash64(a, b))
    return F.array_distinct(pairs)


def admitted(spark: SparkSession, templates: dict[str, str], least: float) -> DataFrame:
    """size, templates: which templates a unit with so many bigrams can still match."""
    listed = spark.createDataFrame(sorted(templates.items()), "licence string, text string")
    sized = listed.select("licence", bigrams_of(words_of(F.col("text"))).alias("grams")).withColumn("n", F.size("grams"))
    reach = F.sequence(F.ceil(F.col("n") * (least / (2 - least)) - 1e-9), F.floor(F.col("n") * ((2 - least) / least) + 1e-9))
    return (
        sized.withColumn("size", F.explode(reach))
        .groupBy("size").agg(F.array_sort(F.collect_list(F.struct("licence", "n", "grams"))).alias("templates"))
    )


def units_of(text: Column) -> Column:
    """(unit, unit_no, text) of lines, paragraphs and the whole, numbered from 1."""
    def numbered(kind: str, parts: Column) -> Column:
        return F.transform(parts, lambda x, i: F.struct(
            F.lit(kind).alias("unit"), (i + 1).alias("unit_no"), x.alias("text")))

    none = F.slice(F.split(text, "\n"), 1, 0)
    return F.concat(
        numbered("line", F.split(text, "\n")),
        numbered("paragraph", F.when(F.contains(text, F.lit("\n\n")), F.split(text, "\n\n+")).otherwise(none)),
        numbered("text", F.when(F.contains(text, F.lit("\n")), F.array(text)).otherwise(none)),
    )


def scan_licences(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """doc_id, unit, unit_no, licence, dice: the best template of every unit that reaches ``least``."""
    templates = TEMPLATES if templates is None else templates
    table = admitted(docs.sparkSession, templates, least)
    shortest = min((len(bigram_set(t)) for t in templates.values()), default=0) * least / (2 - least)
    units = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.explode(units_of(F.col("text"))).alias("u"))
        .select("doc_id", "u.unit", "u.unit_no", words_of(F.col("u.text")).alias("words"))
        .where((F.size("words") > 1) & (F.size("words") - 1 >= shortest))
        .select("doc_id", "unit", "unit_no", bigrams_of(F.col("words")).alias("grams"))
    )
    met = units.join(F.broadcast(table), F.size("grams") == F.col("size"))
    scored = F.transform("templates", lambda t: F.struct(
        (-2.0 * F.size(F.array_intersect("grams", t.grams)) / (F.col("size") + t.n)).alias("less"),
        t.licence.alias("licence")))
    best = met.select("doc_id", "unit", "unit_no", F.array_min(scored).alias("best"))
    return best.select(
        "doc_id", "unit", "unit_no", "best.licence", (-F.col("best.less")).alias("dice")
    ).where(F.col("dice") >= least)


def bigram_set(text: str) -> set[tuple[str, str]]:
    """The same bigrams in plain Python, for bounds and tests."""
    import regex

    words = regex.sub(MARKS, " ", text.lower()).strip(" ").split(" ")
    return set(zip(words, words[1:]))
