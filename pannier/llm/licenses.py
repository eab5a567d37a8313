"""License scans: TF-IDF cosine of statements to templates, inherited from ancestor directories."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch

# Fixed values. Notices are the short forms by which works declare a license; where they differ only in
# the version or in CC's conditions they are written once.
GNU = {"GPL": "GNU General Public License", "LGPL": "GNU Lesser General Public License", "AGPL": "GNU Affero General Public License"}
GNU_VERSIONS = {"GPL": ("1", "2", "3"), "LGPL": ("2", "2.1", "3"), "AGPL": ("1", "3")}
CC_CONDITIONS = ("", "-SA", "-ND", "-NC", "-NC-SA", "-NC-ND")
CC_WORDS = {"SA": "ShareAlike", "ND": "NoDerivatives", "NC": "NonCommercial"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
PLAIN = {
    "Apache-1.1": ("Apache License", "1.1"), "Apache-2.0": ("Apache License", "2.0"), "Apache": ("Apache License", ""),
    "MPL-1.1": ("Mozilla Public License", "1.1"), "MPL-2.0": ("Mozilla Public License", "2.0"), "MPL": ("Mozilla Public License", ""),
    "MIT": ("MIT License", ""), "ISC": ("ISC License", ""), "Unlicense": ("Unlicense", ""), "BSD": ("BSD License", ""),
    "BSD-2-Clause": ("BSD 2-Clause License", ""), "BSD-3-Clause": ("BSD 3-Clause License", ""), "BSD-4-Clause": ("BSD 4-Clause License", ""),
    "CC0-1.0": ("CC0 1.0 Universal", ""),
}
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies."
)
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted"
BSD_PARTS = (
    BSD_GRANT + " provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
    "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.",
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the organization.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, '
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
    "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
)
# Texts are compared from their first grant on, before any notice.
TEXTS = {
    "MIT": MIT_GRANT + " The above copyright notice and this permission notice shall be included in all copies or substantial "
    'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC": ISC_GRANT + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION "
    "OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": f"{BSD_PARTS[0]} {BSD_PARTS[3]}",
    "BSD-3-Clause": f"{BSD_PARTS[0]} {BSD_PARTS[2]} {BSD_PARTS[3]}",
    "BSD-4-Clause": " ".join(BSD_PARTS),
}


def _notices() -> dict[str, list[str]]:
    """Notices of each license."""
    out: dict[str, list[str]] = {}
    ways = ("{}", "License: {}", "Licensed under {}", "Released under {}", "This work is licensed under {}", "Distributed under {}")
    ways += ("Licensed under the terms of {}", "This software is released under {}", "This project is licensed under {}")
    ways += ("Available under {}", "Text is available under {}", "Content is available under {}", "Published under {}")

    def add(name: str, title: str, version: str, more: tuple[str, ...] = ()) -> None:
        full = f"{title} version {version}" if version else title
        out[name] = [*(way.format(full) for way in ways), *more]

    for family, title in GNU.items():
        for version in ("", *GNU_VERSIONS[family]):
            name = f"{family}-{version}.0" if version and "." not in version else f"{family}-{version}" if version else family
            stated = f"either version {version} of the License, or (at your option) any later version" if version else ""
            grant = (
                f"This program is free software: you can redistribute it and/or modify it under the terms of the {title} "
                f"as published by the Free Software Foundation"
            )
            more = (f"{grant}, {stated}", f"{grant}, version {version}", f"{title} version {version} or later", f"{title} version {version} only")
            day = {"GPL2": "June 1991", "GPL3": "29 June 2007", "LGPL2.1": "February 1999", "LGPL3": "29 June 2007", "AGPL3": "19 November 2007"}
            more += (f"{title} Version {version}, {day.get(family + version, '')}",)
            add(name, title, version, more if version else (grant,))
    for conditions in CC_CONDITIONS:
        words = "-".join(["Attribution", *(CC_WORDS[c] for c in conditions.split("-")[1:])])
        for version in ("", *CC_VERSIONS):
            title, tail = f"Creative Commons {words}", f"{version} International License"
            tails = (tail, f"{version} Unported License", f"{version} License")
            more = tuple(way.format(f"a {title} {t}") for way in ways for t in tails)
            add(f"CC-BY{conditions}" + f"-{version}" * bool(version), f"CC BY{conditions}", version, more)
    for name, (title, version) in PLAIN.items():
        add(name, title, version)
    out["Apache-2.0"] += ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"]
    out["Apache-2.0"] += ['Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.']
    for name in ("MPL-1.1", "MPL-2.0"):
        of = "This Source Code Form is subject to the terms of the Mozilla Public License, version " + name[4:]
        gives = f"{of}. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/{name[4:]}/"
        out[name] += [of, gives]
    out["MIT"] += [MIT_GRANT, "This code is free under the MIT license"]
    out["ISC"] += [ISC_GRANT]
    out["BSD-3-Clause"] += [BSD_GRANT, BSD_GRANT + " provided that the following conditions are met"]
    out["Unlicense"] += ["This is free and unencumbered software released into the public domain"]
    out["CC0-1.0"] += ["CC0", "Licensed under CC0 1.0", "Released under CC0", "Creative Commons CC0 1.0 Universal Public Domain Dedication"]
    out["CC0-1.0"] += ["Licensed under the Creative Commons Zero v1.0 Universal license"]
    return out


TEMPLATES = _notices()
# Function words and words for a version, which say nothing about a license.
STOP = "a an and are as at be but by for from in into is it of on or that the this to under use v version with without you your".split()
MARKUP = r"(?s)<script\b.*?</script>|<style\b.*?</style>|<[^>]*>"
SENTENCE = r"([.!?])\s+([A-Z])"
PARAGRAPH = r"\n[^A-Za-z0-9\n]*(?:\n[^A-Za-z0-9\n]*)+"
WORD = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"
# What every statement of a license holds, as plain strings; short names and "Creative Commons" are looked at closely.
CUES = ("licens", "licenc", "gpl", "mpl", "apache", "permission", "redistribution", "unencumbered")
SHORT_CUES, SHORT = ("cc", "mit", "bsd", "isc", "commons"), r"(?<![a-z])(?:cc|mit|bsd|isc)(?![a-z])|creative[^a-z]+commons"
GRANT = r"(?:permission is hereby granted|permission to use copy modify|redistribution and use in source and binary forms)"
GRANT_CUE = r"(?i)permission[^a-z0-9]+(?:is|to)[^a-z0-9]|redistribution[^a-z0-9]+and[^a-z0-9]"
# One name for what is written in several ways, and a mark after phrases that tell licenses apart.
NAMED = (
    (r"[^a-z0-9.]+|\.(?![0-9])|(?<![0-9])\.", " "),
    ("licenc", "licens"),
    (r"(?<![0-9.])([0-9])\.0(?![0-9.])", "$1"),
    (r"\b(?:gnu )?(?:lesser|library) (?:general public license|gpl)\b(?: lgpl\b)?|\blgpl(?:v(?=[0-9]))?(?![a-z])", " lgpl "),
    (r"\b(?:gnu )?affero (?:general public license|gpl)\b(?: agpl\b)?|\bagpl(?:v(?=[0-9]))?(?![a-z])", " agpl "),
    (r"\b(?:gnu )?general public license\b(?: gpl\b)?|\b(?:gnu )?gpl(?:v(?=[0-9]))?(?![a-z])", " gpl "),
    (r"\bmozilla public license\b(?: mpl\b)?|\bmpl(?:v(?=[0-9]))?(?![a-z])", " mpl "),
    (r"\b(?:creative commons )?(?:creative commons zero|cc zero|cc ?0)(?![a-z0-9])", " cczero "),
    (r"\bcreative commons\b(?: cc\b)?", " cc "),
    (r"\bnon ?commercial\b", " nc "),
    (r"\bshare ?alike\b", " sa "),
    (r"\bno ?deriv(?:ative)?s?\b(?: works?\b)?", " nd "),
    (r"\battribution\b", " by "),
    (r"\b(?:2|two) clause\b|\bsimplified(?= bsd\b)", " twoclause "),
    (r"\b(?:3|three) clause\b|\b(?:new|modified|revised)(?= bsd\b)", " threeclause "),
    (r"\b(?:4|four) clause\b|\boriginal(?= bsd\b)", " fourclause "),
    # Words that also mean something else are names only beside "license", "under" or what follows such a name.
    (r"\bcc(?= +by\b)", " cc ccname "),
    (r"\b(mit|isc|bsd|apache)(?= +(?:software )?license\b| +(?:two|three|four)clause\b)", "$1 $1name "),
    (r"\b((?:license|licensed|under)(?: +(?:is|under|the|terms|of))* +(mit|isc|bsd|apache))\b(?! +[a-z]+name)", "$1 $2name "),
    (r"\b(apache)(?= +(?:v|version )?[0-9])", "$1 apachename "),
    (r"\b(permission is hereby granted)\b", "$1 mitgrant "),
    (r"\b(permission to use copy modify)\b", "$1 iscgrant "),
    (r"\b(redistribution and use in source and binary forms)\b", "$1 bsdgrant "),
    (r"\b(neither the names?)\b", "$1 noendorse "),
    (r"\b(all advertising materials)\b", "$1 advertclause "),
    (r"\b(free and unencumbered software)\b", "$1 unlicense "),
)
GRANT_MARKS = ["mitgrant", "iscgrant", "bsdgrant", "noendorse", "advertclause"]
VERSIONED = ["gpl", "lgpl", "agpl", "mpl", "apachename", "ccname"]
MARKS = [*GRANT_MARKS, *VERSIONED, *"cczero mitname bsdname iscname unlicense twoclause threeclause fourclause".split()]
CONDITIONS = ["nc", "sa", "nd"]


def named(text: str) -> str:
    """The text in lower case with the names of ``NAMED``, as ``named_column`` gives it."""
    text = text.lower()
    for pattern, name in NAMED:
        text = re.sub(pattern, re.sub(r"\$(\d)", r"\\g<\1>", name), text)
    return re.sub(" +", " ", text)


def cued(lower: Column) -> Column:
    """Whether a text in lower case may state a license; strings are found far faster than patterns."""
    plain = reduce(or_, (lower.contains(c) for c in CUES))
    return plain | (reduce(or_, (lower.contains(c) for c in SHORT_CUES)) & lower.rlike(SHORT))


def with_cues(rows: DataFrame, name: str) -> DataFrame:
    return once(rows, "_lower", F.lower(name)).filter(cued(F.col("_lower"))).drop("_lower")


def named_column(text: Column) -> Column:
    text = F.lower(text)
    for pattern, name in NAMED:
        text = F.regexp_replace(text, pattern, name)
    return F.regexp_replace(text, " +", " ")


def marks(words: Sequence[str], whole: bool) -> str:
    """The words that tell licenses apart: names, conditions, versions of licenses that have them, and grants."""
    versioned = any(w in VERSIONED for w in words)

    def tells(w: str) -> bool:
        if whole:
            return w in GRANT_MARKS
        return w in MARKS or "ccname" in words and w in CONDITIONS or versioned and re.fullmatch(r"[0-9](\.[0-9])?", w) is not None

    return " ".join(sorted({w for w in words if tells(w)}))


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """The rows with a column that is evaluated once a row, wherever it is used later."""
    return rows.select(*(c for c in rows.columns if c != name), F.explode(F.array(value)).alias(name))


def with_marks(rows: DataFrame, whole: bool) -> DataFrame:
    """The rows with the marks of their ``words``."""
    if whole:
        return once(rows, "marks", F.array_join(F.array_sort(F.array_distinct(F.filter("words", lambda w: w.isin(GRANT_MARKS)))), " "))
    words = F.array_distinct("words")
    told = F.filter(words, lambda w: w.isin([*MARKS, *CONDITIONS]) | w.rlike(r"^[0-9](\.[0-9])?$"))
    rows = once(rows, "told", F.array_sort(told))
    rows = once(rows, "cc", F.array_contains("told", "ccname"))
    rows = once(rows, "versioned", F.arrays_overlap("told", F.array(*map(F.lit, VERSIONED))))
    kept = F.filter("told", lambda w: w.isin(MARKS) | F.when(w.isin(CONDITIONS), F.col("cc")).otherwise(F.col("versioned")))
    return once(rows, "marks", F.array_join(kept, " ")).drop("told", "cc", "versioned")


def template_tokens(forms: Sequence[tuple[str, str]]) -> tuple[list[dict[str, float]], dict[str, float], float]:
    """Token weights of each (license, text), of length 1 together; the rarity of tokens; and that of any other token.

    A token's rarity counts the licenses whose texts hold it.
    """
    counts: list[dict[str, int]] = []
    holders: dict[str, set[str]] = {}
    for name, text in forms:
        words = [w for w in re.findall(WORD, named(text)) if w not in STOP]
        counts.append({w: words.count(w) for w in words})
        for w in words:
            holders.setdefault(w, set()).add(name)
    n = len({name for name, _ in forms})
    idf = {w: math.log((1 + n) / (1 + len(held))) + 1 for w, held in holders.items()}
    weights = []
    for words in counts:
        length = math.sqrt(sum((c * idf[w]) ** 2 for w, c in words.items()))
        weights.append({w: c * idf[w] / length for w, c in words.items()})
    return weights, idf, math.log(1 + n) + 1


def scan(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    least: float = 0.6,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    texts: Mapping[str, str] = TEXTS,
) -> DataFrame:
    """(path, license, cosine) of files with a text or notice whose cosine to a license's is ``least`` or more.

    Markup is left out. A file's lines, sentences and paragraphs are held against the notices,
    and against the texts what follows each of its grants before the next one, cut where each of
    the texts would end; a text goes before any notice. Both sides must hold the same marks (see ``marks``), so a license is never taken for
    one of another version, condition or family; what has no license's marks is dropped before
    anything is shuffled. Tokens outside the templates weigh as the rarest, so a long sentence
    that mentions a license is far from a statement of it. A notice that says less than another
    of the file, such as the first line of a header without the version, does not count. A file
    has the license of its nearest text or notice; ties go to the first name. Only templates
    are broadcast.
    """
    spark = files.sparkSession
    forms = [(name, t, False) for name, ts in templates.items() for t in ts] + [(name, t, True) for name, t in texts.items()]
    weights, idf, rarest = template_tokens([(name, t) for name, t, _ in forms])
    found = [re.findall(WORD, named(t)) for _, t, _ in forms]
    parts = [
        (n, name, whole, marks(words, whole), w, part)
        for n, ((name, _, whole), words, own) in enumerate(zip(forms, found, weights))
        for w, part in own.items()
    ]
    table = spark.createDataFrame(parts, "form int, license string, whole boolean, marks string, token string, part double")
    rarity = spark.createDataFrame(sorted(idf.items()), "token string, idf double")
    told = {whole: sorted({p[3] for p in parts if p[2] == whole}) for whole in (False, True)}

    lengths = sorted({len(words) for (_, _, whole), words in zip(forms, found) if whole}) or [0]

    raw = files.select(F.col(path).alias("path"), F.col(text).alias("plain")).filter(F.col("path").isNotNull() & F.col("plain").isNotNull())
    read = with_cues(once(with_cues(raw, "plain"), "plain", F.regexp_replace("plain", MARKUP, "\n")), "plain")
    lines = F.split(F.regexp_replace("plain", SENTENCE, "$1\n$2"), "\n+")
    said = read.select("path", F.explode(F.array_distinct(F.concat(lines, F.split("plain", PARAGRAPH)))).alias("said"))
    said = with_cues(said, "said").withColumn("whole", F.lit(False))
    said = once(said, "said", named_column(F.col("said")))
    granted = read.filter(F.col("plain").rlike(GRANT_CUE)).select("path", F.lit(True).alias("whole"), F.col("plain").alias("said"))
    granted = once(granted, "said", named_column(F.col("said")))
    every = F.split(F.regexp_replace("said", f"({GRANT})", "\n$1"), "\n")  # named texts have no line breaks
    granted = granted.select("path", "whole", F.explode(F.slice(every, F.lit(2), F.size(every))).alias("said"))

    def tokens(units: DataFrame, whole: bool) -> DataFrame:
        words = F.regexp_extract_all("said", F.lit(f"({WORD})"))
        units = once(units, "words", words).drop("said")
        if whole:
            units = units.withColumn("words", F.explode(F.array_distinct(F.array(*(F.slice("words", 1, n) for n in lengths)))))
        units = with_marks(units, whole).filter(F.col("marks").isin(told[whole]))
        return units.select("path", "whole", "marks", F.filter("words", lambda w: ~w.isin(STOP)).alias("words"))

    units = tokens(said, False).unionByName(tokens(granted, True)).distinct()
    counted = units.select("*", F.explode("words").alias("token")).groupBy("path", "whole", "marks", "words", "token").count()
    weighed = counted.join(F.broadcast(rarity), "token", "left").withColumn("weight", F.col("count") * F.coalesce("idf", F.lit(rarest)))
    unit = ["path", "whole", "marks", "words"]
    held = weighed.groupBy(*unit).agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("length"), F.collect_list(F.struct("token", "weight")).alias("held")
    )
    apart = held.select("path", "whole", "marks", "length", F.xxhash64("words").alias("unit"), F.explode("held").alias("held"))
    apart = apart.select("path", "whole", "marks", "length", "unit", "held.token", "held.weight")
    met = apart.join(F.broadcast(table), ["whole", "marks", "token"])
    sums = met.groupBy("path", "whole", "marks", "unit", "form", "license", "length").agg(F.sum(F.col("weight") * F.col("part")).alias("sum"))
    cosine = F.round(F.col("sum") / F.col("length"), 6)
    best = F.min(F.struct((-cosine).alias("far"), "license")).alias("best")
    found = sums.filter(cosine >= least).groupBy("path", "whole", "marks").agg(best)  # at most a row per set of marks
    one = F.struct((~F.col("whole")).alias("notice"), "best.far", "best.license", F.split("marks", " ").alias("marks"))
    found = found.groupBy("path").agg(F.collect_list(one).alias("found"))

    def says_less(x: Column) -> Column:
        return F.exists("found", lambda y: (F.size(y["marks"]) > F.size(x["marks"])) & (F.size(F.array_except(x["marks"], y["marks"])) == 0))

    near = found.select("path", F.array_min(F.filter("found", lambda x: ~says_less(x))).alias("nearest"))
    return near.select("path", "nearest.license", (-F.col("nearest.far")).alias("cosine"))


def directory(path: Column) -> Column:
    """The path without its last name; a path that ends with a slash is a directory itself."""
    return F.when(path.endswith("/"), F.regexp_replace(path, "/+$", "")).otherwise(F.regexp_replace(path, r"/*[^/]*$", ""))


def ancestors(path: Column) -> Column:
    """The directory and all above it, nearest first."""
    names = F.split(path, "/")
    return F.transform(F.sequence(F.size(names), F.lit(1)), lambda n: F.array_join(F.slice(names, F.lit(1), n), "/"))


def scan_with_inheritance(
    files: DataFrame,
    is_license_file: Column,
    keep: Sequence[str],
    path: str = "path",
    text: str = "text",
    least: float = 0.6,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    texts: Mapping[str, str] = TEXTS,
) -> DataFrame:
    """Per row: ``keep``, license, cosine, and the directory it is inherited from, if it is.

    A file has the license it states. Otherwise it has the license that a licence file states
    in the nearest directory at or above its own, where a directory's own page, whose path ends
    with a slash, lies in that directory, and the first name of a path, such as a host, is the
    highest. If several do there, the nearest statement counts, then the first name. Directories are looked up once each, not once a file.

    NULL texts state nothing, NULL paths and files without an own or inherited license have
    NULLs. Repeated paths are one file with all their statements. Columns of other names are
    ignored; an empty table gives an empty result.
    """
    own = Scratch.of(files.sparkSession).keep(scan(files, path, text, least, templates, texts), "licenses")
    rows = files.select(*keep, F.col(path).alias("_path"), is_license_file.alias("_licence_file"))
    rows = rows.withColumn("_directory", directory(F.col("_path")))
    licence_paths = rows.filter("_licence_file").select(F.col("_path").alias("path"), F.col("_directory").alias("ancestor")).distinct()
    best = F.min(F.struct((-F.col("cosine")).alias("far"), "license")).alias("best")
    declared = own.join(licence_paths, "path").groupBy("ancestor").agg(best)
    tree = rows.filter(F.col("_path").isNotNull()).select("_directory").distinct()
    above = tree.select("_directory", F.posexplode(ancestors(F.col("_directory"))).alias("up", "ancestor"))
    nearest = above.join(declared, "ancestor").groupBy("_directory").agg(F.min(F.struct("up", "ancestor", "best")).alias("from"))
    stated = own.select(F.col("path").alias("_path"), F.col("license").alias("_own"), F.col("cosine").alias("_cosine"))
    found = rows.join(stated, "_path", "left").join(nearest, "_directory", "left")
    states = F.col("_own").isNotNull()
    return found.select(
        *keep,
        F.coalesce("_own", "from.best.license").alias("license"),
        F.coalesce("_cosine", -F.col("from.best.far")).alias("cosine"),
        F.when(~states, F.col("from.ancestor")).alias("inherited_from"),
    )
