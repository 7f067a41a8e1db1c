"""License scans: TF-IDF cosine of headers and licence files to templates, then inheritance along directories.

A file's header is its lines that speak of a licence; of a licence file (by base name) the whole text counts. Equal
notices are scored once. Their sparse TF-IDF vectors meet the templates' in a join on the term; document counts
come from all files. A licence has several templates (whole text, standard notices, short form, SPDX line); the best one
of at least ``threshold`` is the file's own licence. A file without one
inherits from the nearest directory upwards that has a licence file, found by a join on the directory path.

Null or empty texts have no notice. Null paths have no directory and inherit nothing. Of several licence files in a
directory the best match counts, then the smallest path and licence; ties of templates go to the smaller name. Repeated rows are
scanned each. Extra columns pass through; columns named like an output are replaced.
"""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import OWN, broadcast_under, shielded, stored

THRESHOLD = 0.55
#: Long texts share their everyday words: a template of so many words counts from a higher cosine on. The whole text of the
#: Mozilla licence has 0.78 to that of GPL-3.0, a whole MIT text with its own names 0.87 to 0.99 to MIT.
WHOLE_WORDS, WHOLE_THRESHOLD = 150, 0.85
#: Short forms of public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the License)",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0 Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MIT": "Released under the MIT License",
}
#: Standard notices that name a licence without its text.
NOTICES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License"],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file", "Licensed under the BSD 3-Clause License"],
    "CC-BY-4.0": ["This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/"],
    "CC-BY-NC-4.0": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/"],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with "
        "this program. If not, see https://www.gnu.org/licenses/",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 "
        "of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with "
        "this program. If not, see https://www.gnu.org/licenses/",
    ],
    "MIT": ["Licensed under the MIT License. See LICENSE in the project root for license information"],
}
TEXTS = Path(__file__).with_name("licence_texts")
#: An SPDX line names its licence exactly; -only, -or-later and + are the same licence here.
SPDX = r"(?i)SPDX-License-Identifier:[\x20\t(]*([A-Za-z0-9.-]+?)(?:-only|-or-later)?[+]?(?![A-Za-z0-9.+-])"
NOTICE = r"(?i)licen[cs]ed? |licen[cs]e\b|redistribution and use|all rights reserved|copying permission"
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"


def all_templates() -> dict[str, list[str]]:
    """Per licence: short form, standard notices and, where the folder has it, the whole text."""
    texts = {p.stem: p.read_text(encoding="utf-8") for p in sorted(TEXTS.glob("*.txt"))}
    return {k: [d[k] for d in (TEMPLATES, texts) if k in d] + NOTICES.get(k, []) for k in sorted({*TEMPLATES, *NOTICES, *texts})}


def _terms(text: str) -> Column:
    return F.expr(f"array_remove(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), '')")


def notice_of(path: str = "path", text: str = "text") -> Column:
    lines = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
    marked = F.array_join(F.filter(lines, lambda line: line.rlike(NOTICE)), "\n")
    base = F.regexp_extract(F.col(path), "[^/]*$", 0)
    return F.when(base.rlike(LICENCE_FILE), F.coalesce(F.col(text).cast("string"), F.lit(""))).otherwise(marked)


def _fixed(spark: SparkSession, columns: dict[str, tuple[pa.DataType, list]]) -> DataFrame:
    """A table of constants in the plan itself: no Python worker deals it out. In one partition, so that grouping it takes no shuffle."""
    return spark.createDataFrame(pa.table({name: pa.array(values, kind) for name, (kind, values) in columns.items()})).coalesce(1)


def _scores(notices: DataFrame, templates: dict[str, str | list[str]], threshold: float) -> DataFrame:
    """``_notice`` (digest), ``own_license``, ``own_score`` of the notices (digest, text, files) that match a template."""
    spark = notices.sparkSession
    tag = F.lower(F.regexp_extract("body", SPDX, 1))
    notices = notices.select("*", tag.alias("tag"))
    terms = notices.select("_notice", "files", (F.col("tag") != "").alias("tagged"), F.explode(_terms("body")).alias("term"))
    terms = stored(terms.groupBy("_notice", "files", "tagged", "term").agg(F.count("*").alias("tf")))
    files = notices.agg(F.sum("files")).first()[0] or 0
    df = terms.groupBy("term").agg(F.sum("files").alias("df"))
    idf = F.log((F.lit(float(files)) + 1) / (F.coalesce(F.col("df"), F.lit(0)) + 1)) + 1
    forms = [(k, i, body, max(threshold, WHOLE_THRESHOLD) if len(body.split()) >= WHOLE_WORDS else threshold) for k, listed in templates.items() for i, body in enumerate([listed] if isinstance(listed, str) else listed)]
    kinds = {"license": pa.string(), "form": pa.int32(), "body": pa.string(), "least": pa.float64()}
    known = _fixed(spark, {name: (kind, [f[i] for f in forms]) for i, (name, kind) in enumerate(kinds.items())})
    form = ["license", "form", "least"]
    # of the counts of all terms, those of the templates' own terms come to the one partition of the templates
    ours = df.join(F.broadcast(known.select(F.explode(_terms("body")).alias("term")).distinct()), "term", "left_semi")
    wanted = known.select(*form, F.explode(_terms("body")).alias("term")).groupBy(*form, "term").agg(F.count("*").alias("ttf"))
    wanted = wanted.join(F.broadcast(ours), "term", "left").select(*form, "term", (F.col("ttf") * idf).alias("tw"))
    wanted = wanted.withColumn("tnorm", F.sqrt(F.sum(F.col("tw") ** 2).over(Window.partitionBy("license", "form"))))
    weighed = terms.where(~F.col("tagged")).join(df, "term").select("_notice", "term", (F.col("tf") * idf).alias("w"))
    # a term meets itself, for the norm, and the forms that hold it: what a long notice deals out are the sums of its parts, a row a form
    meets = wanted.groupBy("term").agg(F.collect_list(F.struct(*form, "tnorm", "tw")).alias("forms"))
    itself = F.array(F.struct(F.lit(None).cast("string").alias("license"), F.lit(-1).alias("form"), F.lit(0.0).alias("least"), F.lit(1.0).alias("tnorm"), F.col("w").alias("tw")))
    met = weighed.join(F.broadcast(meets), "term", "left").select("_notice", "w", F.inline(F.when(F.col("forms").isNull(), itself).otherwise(F.concat(itself, "forms"))))
    dots = met.groupBy("_notice", *form, "tnorm").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    dots = dots.withColumn("norm", F.max(F.when(F.col("form") < 0, F.sqrt("dot"))).over(Window.partitionBy("_notice"))).where(F.col("form") >= 0)
    cosine = dots.withColumn("own_score", F.round(F.col("dot") / F.col("norm") / F.col("tnorm"), 6)).where(F.col("own_score") >= F.col("least"))
    best = cosine.groupBy("_notice").agg(F.min(F.struct((-F.col("own_score")).alias("s"), F.col("license").alias("l"))).alias("b"))
    best = best.select("_notice", F.col("b.l").alias("own_license"), (-F.col("b.s")).alias("own_score"))
    # the SPDX line of a template's licence is a template of its own; as close as that, but for the identifier, are other licences' lines
    named = {k.lower(): k for k in sorted(templates, reverse=True)}  # of names that differ by case only, the smaller one
    names = _fixed(spark, {"tag": (pa.string(), [*named]), "own_license": (pa.string(), [*named.values()])})
    tags = notices.where(F.col("tag") != "").join(F.broadcast(names), "tag").select("_notice", "own_license", F.lit(1.0).alias("own_score"))
    return best.unionByName(tags)


def scan_licenses(files: DataFrame, path: str = "path", text: str = "text", templates: dict[str, str | list[str]] | None = None, threshold: float = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all by default) with ``own_license, own_score, license, inherited_from`` (path of the licence file), ``distance`` (directories up, null without inheritance)."""
    templates = all_templates() if templates is None else templates
    outputs = ["own_license", "own_score", "license", "inherited_from", "distance"]
    return shielded(files, [path, text], outputs, keep, lambda own: _scanned(own, path, text, templates, threshold))


def _scanned(files: DataFrame, path: str, text: str, templates: dict[str, str | list[str]], threshold: float) -> DataFrame:
    carried = [F.col(OWN)]
    notice = F.col("_body")
    rows = files.select(*carried, F.col(path).alias("_path"), notice_of(path, text).alias("_body"))
    digest = F.when(notice != "", F.sha2(notice.cast("binary"), 256))
    rooted = F.when(F.col("_path").rlike("^[.]{0,2}/"), F.col("_path")).otherwise(F.concat(F.lit("./"), "_path"))  # the top of relative paths is "."
    rows = stored(rows.select("*", digest.alias("_notice"), F.regexp_extract(rooted, "^(.*)/[^/]*$", 1).alias("_dir")))
    notices = rows.where(F.col("_notice").isNotNull()).groupBy("_notice").agg(F.any_value("_body").alias("body"), F.count("*").alias("files"))
    found = stored(_scores(stored(notices), templates, threshold))
    licence_file = F.regexp_extract("_path", "[^/]*$", 0).rlike(LICENCE_FILE)
    in_dir = rows.where(licence_file).join(found, "_notice").groupBy("_dir").agg(F.min(F.struct((-F.col("own_score")).alias("s"), F.col("_path").alias("p"), F.col("own_license").alias("l"))).alias("d"))
    directories = rows.where(F.col("_path").isNotNull()).select("_dir").distinct()
    up = F.expr("transform(sequence(0, size(split(_dir, '/')) - 1), u -> struct(u as distance, array_join(slice(split(_dir, '/'), 1, size(split(_dir, '/')) - u), '/') as above))")
    ancestors = directories.select("_dir", F.explode(up).alias("a")).select("_dir", "a.distance", "a.above")
    nearest = ancestors.join(in_dir.withColumnRenamed("_dir", "above"), "above").groupBy("_dir").agg(F.min(F.struct("distance", "d")).alias("n"))
    # one short row a directory that inherits: unless they are very many, the files of a full directory need not meet in one task
    nearest = broadcast_under(stored(nearest), 200_000)
    own = F.col("own_license").isNotNull()
    out = rows.join(found, "_notice", "left").join(nearest, "_dir", "left")
    return out.select(
        *carried,
        "own_license",
        "own_score",
        F.when(own, F.col("own_license")).otherwise(F.col("n.d.l")).alias("license"),
        F.when(~own, F.col("n.d.p")).alias("inherited_from"),
        F.when(~own, F.col("n.distance")).alias("distance"),
    )
