"""Licence scan by sentence rules: known sentences first, then ordered rules over their sequence.

Method. The text is cut at stops and at line ends behind stops; other line ends, with the comment marks of the next line, only
part the lines of a sentence. Lines are normalised (lower case, one spelling, no marks, single blanks). A run of lines of one
sentence that is a known sentence gets its identifier; before it may stand a lead-in (LEAD: a copyright line, "this file is" and
the like) without a negation, and the line before must not end in one. Of the known sentences that end on a line the longest
counts, of two that overlap the one that ends later. The identifiers of a document, in the order of the text, are matched
against the rules: sequences of identifiers, longer ones first, each replaced by its licence.
Identifiers that no rule takes are reported as unmatched.

Scale. Everything happens within a row, in JVM expressions, in one pass without a shuffle. A document
without any of the words of which every known sentence has one (TRIGGER) skips the work, a line that does not end in the last word
of a known sentence ends none. The knowledge is fixed lists and rules over them; when the module loads, every known sentence must
find itself by the same steps. Work grows with the length of a text, whatever its lines: a known sentence may be spread over
at most MOST_LINES lines.

Defined results. Null and empty texts have no licences. Repeated rows give the same result each. A licence that
occurs twice is listed once, where it came first; sentence_ids and unmatched keep repeats. Other columns are handed on; incoming
ones named licences, sentence_ids or unmatched give way. An empty table stays empty. Very long texts are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIGGER = "licen|cc0|copyright|permission|warrant|redistribut|domain|reserved|liable|spdx"  # single words: no line end can part them

# Sentences of public licences, normalised, with an identifier for each.
_VERSIONED = {
    "gpl-{v}-short": "licensed under the gnu general public license version {v}",
    "lgpl-{v}-short": "licensed under the gnu lesser general public license version {v}",
    "agpl-{v}-short": "licensed under the gnu affero general public license version {v}",
    "mpl-{v}-short": "licensed under the mozilla public license version {v}",
    "apache-{v}-short": "licensed under the apache license version {v}",
    "epl-{v}-short": "licensed under the eclipse public license version {v}",
    **{f"cc-{kind}-{{v}}": f"licensed under cc {kind.replace('-', ' ')} {{v}}" for kind in
       ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")},
}
_VERSIONS = ("1.0", "1.1", "2.0", "2.1", "2.5", "3.0", "4.0", "2", "3")
_PLAIN = {
    "mit-short": "licensed under the mit license",
    "bsd-short": "licensed under the bsd license",
    "bsd-2-short": "licensed under the bsd 2 clause license",
    "bsd-2-short ": "licensed under the 2 clause bsd license",
    "bsd-3-short": "licensed under the bsd 3 clause license",
    "bsd-3-short ": "licensed under the 3 clause bsd license",
    "isc-short": "licensed under the isc license",
    "cc0-short": "released under cc0",
    "public-domain": "released into the public domain",
    "rights-reserved": "all rights reserved copyright",
    "rights-reserved ": "all rights reserved",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights "
    "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom "
    "the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to "
    "the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability "
    "whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
    "other dealings in the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is "
    "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl-no-warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "mpl-2.0-header": "this source code form is subject to the terms of the mozilla public license version 2.0",
}
# The notices of the GPL family: its versions end a sentence of their own where a semicolon stands before "either".
_FAMILY = {"gpl": "general", "lgpl": "lesser general", "lgpl ": "library general", "agpl": "affero general"}
_TERMS = "you can redistribute it and or modify it under the terms of the gnu {} public license"
_PUBLISHED = "as published by the free software foundation"
_LATER = "either version {} of the license or at your option any later version"
_NOTICES = [
    *((f"{_TERMS.format(kind)} {_PUBLISHED} {_LATER.format(v)}", f"{name.strip()}-{v}-later") for name, kind in _FAMILY.items() for v in ("2", "2.1", "3")),
    *((f"{_TERMS.format(kind)} version {v} {_PUBLISHED}", f"{name.strip()}-{v}-only") for name, kind in _FAMILY.items() for v in ("2", "2.1", "3")),
    *((f"{_TERMS.format(kind)} {_PUBLISHED}", f"{name.strip()}-terms") for name, kind in _FAMILY.items()),
    *((_LATER.format(v), f"later-{v}") for v in ("2", "2.1", "3")),
]
# Identifiers of SPDX, and other names of a "License:" line for some of them.
_SPDX = """MIT MIT-0 ISC Zlib Unlicense 0BSD BSD-2-Clause BSD-3-Clause BSL-1.0 Apache-1.1 Apache-2.0 MPL-1.1 MPL-2.0 EPL-1.0 EPL-2.0
GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later
LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later
CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-NC-ND-4.0""".split()
_NAMES = {
    "MIT": ("mit license", "the mit license"),
    "ISC": ("isc license",),
    "BSD-2-Clause": ("bsd 2 clause license",),
    "BSD-3-Clause": ("bsd 3 clause license",),
    "Apache-2.0": ("apache license 2.0", "apache license version 2.0"),
    "MPL-2.0": ("mozilla public license 2.0",),
    "CC0-1.0": ("cc0",),
}

#: Applied in order to a lower-case text, in both engines: pattern and replacement. A tab then parts the lines of a sentence.
# An expression of identifiers becomes one line each, up to four. The stop of "v. 2.0" and the colon of an SPDX line would cut a
# sentence; the end of their line ends it.
_EXPRESSION = (r"spdx-licen[cs]e-identifier:[ ]*[(]?([a-z0-9.+-]+)[)]?[ ]+(?:or|and)[ ]+[(]?", "spdx license identifier $1.\nspdx-license-identifier: ")
UNFOLD = [
    ("\r", ""),
    ("\t", " "),
    (r"[(]see [^()\n]{1,60}[)]", ""),
    _EXPRESSION,
    _EXPRESSION,
    _EXPRESSION,
    (r"spdx-licen[cs]e-identifier:[ ]*[(]?([a-z0-9.+-]+)[ ]*[^a-z0-9(\n]*(\n|$)", "spdx license identifier $1.$2"),
    (r"\blicen[cs]e:[ ]*([a-z0-9][a-z0-9.+ -]{0,40})(\n|$)", "license named $1.$2"),
    (r"\b(v|ver)\.[ ]*(?:\n[ ]*[*#/;>|-]*[ ]*)?([0-9][0-9.]*)[ ]*\n", "$1 $2.\n"),
    (r"\b(v|ver)\.[ ]*(?:\n[ ]*[*#/;>|-]*[ ]*)?([0-9])", "$1 $2"),
    (r"([^.;:!?\n])[ ]*\n[ ]*[*#/;>|-]*[ ]*([^ \n*#/;>|-])", "$1\t$2"),
]
CUT = "[.;:!?]+[ \t]+|[.;:!?]*[ \t]*\n|[;:!?]"
NORMALISE = [
    ("licence", "license"),
    ("[^a-z0-9.]+", " "),
    (r"\b(v|ver)\.? ?([0-9])", "version $2"),
    (r"\.+( |$)", "$1"),
    (r"\b(released|distributed|made available|available|provided|published) under ", "licensed under "),
    (r"\blicense version ([0-9])", "license $1"),
    ("^ +| +$", ""),
]
#: What may stand before a known sentence, and what must not stand in it, or end the line before.
LEAD = (
    r"^(copyright( [a-z0-9.]+)*|[a-z0-9]|license|notice|note|([a-z0-9.]+ ){0,12}(is|are|was|were|been|be)( (hereby|also|now|both|dual|made))*"
    r"|(the|this|these|all|my|our|its|their)( [a-z0-9.]+){1,4}|(and|or|also|dual|portions|parts))$"
)
NEGATION = "not|never|no|nor|neither|none|nothing|cannot|nobody|isn|aren|wasn|weren|rather than"
MOST_LINES = 16


def _steps(text: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        text = re.sub(pattern, to.replace("$", "\\"), text)
    return text


def _known() -> list[tuple[str, str]]:
    """(normalised sentence, identifier), longer ones first; identifiers hold no blanks, so the blank of a second spelling goes."""
    out = [(text, name.strip()) for name, text in _PLAIN.items()] + _NOTICES
    for name, text in _VERSIONED.items():
        out += [(text.format(v=v), name.format(v=v)) for v in _VERSIONS]
    out += [(f"licensed under the apache license version {v} the license", f"apache-{v}-short") for v in _VERSIONS]
    out += [(f"spdx license identifier {x.lower()}", f"spdx-{x.lower()}") for x in _SPDX]
    out += [(f"license named {name}", f"named-{x.lower()}") for x in _SPDX for name in (x.lower(), *_NAMES.get(x, ()))]
    found = {_steps(text, NORMALISE): name for text, name in out}
    return sorted(found.items(), key=lambda known: (-len(known[0]), known[0]))


SENTENCES = _known()
#: The last words of known sentences: other lines end none.
LAST = r"(^| )(" + "|".join(sorted({re.escape(text.split()[-1]) for text, _ in SENTENCES})) + ")$"
#: Sequences of identifiers and their licence, in the order in which they are tried.
RULES = [
    (f"{ids}{more}", f"{name.upper()}-{v if '.' in v else v + '.0'}-{kind}")
    for name in ("gpl", "lgpl", "agpl") for v in ("2", "2.1", "3") for more in (" gpl-no-warranty", "")
    for ids, kind in ((f"{name}-terms later-{v}", "or-later"), (f"{name}-{v}-later", "or-later"), (f"{name}-{v}-only", "only"))
] + [
    ("rights-reserved bsd-grant bsd-source bsd-binary bsd-endorse", "BSD-3-Clause"),
    ("rights-reserved bsd-grant bsd-source bsd-binary", "BSD-2-Clause"),
    ("bsd-grant bsd-source bsd-binary bsd-endorse", "BSD-3-Clause"),
    ("mit-grant mit-notice mit-as-is mit-liability", "MIT"),
    ("mit-grant mit-notice mit-as-is", "MIT"),
    ("apache-2.0-short apache-use apache-as-is", "Apache-2.0"),
    ("apache-2.0-short apache-use", "Apache-2.0"),
    ("bsd-grant bsd-source bsd-binary", "BSD-2-Clause"),
    ("isc-grant mit-as-is", "ISC"),
    ("mit-short", "MIT"),
    ("bsd-short", "BSD"),
    ("isc-grant", "ISC"),
    ("cc0-short", "CC0-1.0"),
    ("public-domain", "Public-Domain"),
    ("mpl-2.0-header", "MPL-2.0"),
    ("bsd-2-short", "BSD-2-Clause"),
    ("bsd-3-short", "BSD-3-Clause"),
    ("isc-short", "ISC"),
    ("rights-reserved", "All-Rights-Reserved"),
] + [(f"{form}-{x.lower()}", x) for x in _SPDX for form in ("spdx", "named")] + [
    (f"{name}-{v}-short", f"{name.upper() if name != 'apache' else 'Apache'}-{v if '.' in v else v + '.0'}")
    for name in ("gpl", "lgpl", "agpl", "mpl", "apache", "epl") for v in _VERSIONS
] + [
    (f"{name.format(v=v)}", f"{name.format(v=v)}".upper()) for name in _VERSIONED if name.startswith("cc-") for v in _VERSIONS
]

_dead = [text for text, _ in SENTENCES if [_steps(part, NORMALISE) for part in re.split(CUT, text + ".\n")] != [text, ""]]
if _dead:
    raise ValueError(f"known sentences that cannot match: {_dead}")


def _replaced(s: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, to in steps:
        s = F.regexp_replace(s, pattern, to)
    return s


def _bound(value: Column, body) -> Column:
    """*body* of a value that is worked out once, not wherever it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sentence_names(lines: Column) -> Column:
    """The identifiers of a sentence, from its normalised lines."""
    known = F.expr("array(" + ", ".join(f"named_struct('text', '{text}', 'name', '{name}')" for text, name in SENTENCES) + ")")
    nothing = F.lit(None).cast("struct<text:string,name:string>")

    def led(lead: Column) -> Column:
        return (lead == "") | (F.regexp_like(lead, F.lit(LEAD)) & ~F.regexp_like(lead, F.lit(rf"\b({NEGATION})\b")))

    def best(run: Column) -> Column:
        ending = F.filter(known, lambda k: F.endswith(F.concat(F.lit(" "), run), F.concat(F.lit(" "), k["text"])))
        return F.get(F.filter(ending, lambda k: led(F.rtrim(F.left(run, F.length(run) - F.length(k["text"]))))), F.lit(0))

    def from_line(first: Column, last: Column) -> Column:
        before = F.when(first > 1, F.element_at(lines, first - 1)).otherwise("")
        return F.when(F.regexp_like(before, F.lit(rf"\b({NEGATION})( [a-z0-9.]+)?$")), nothing).otherwise(
            _bound(F.array_join(F.slice(lines, first, last - first + 1), " "), best)
        )

    def on_line(last: Column) -> Column:
        starts = F.sequence(F.greatest(F.lit(1), last - (MOST_LINES - 1)), last)
        hits = F.filter(F.transform(starts, lambda first: from_line(first, last)), lambda k: k.isNotNull())
        longest = F.reduce(hits, nothing, lambda a, k: F.when(a.isNull() | (F.length(k["text"]) > F.length(a["text"])), k).otherwise(a))
        end = F.length(F.array_join(F.slice(lines, F.lit(1), last), " "))
        return _bound(longest, lambda k: F.struct(k["name"].alias("name"), (end - F.length(k["text"])).alias("start"), end.alias("end")))

    lasts = F.filter(F.sequence(F.lit(1), F.size(lines)), lambda at: F.regexp_like(F.element_at(lines, at), F.lit(LAST)))
    hits = F.filter(F.transform(lasts, on_line), lambda hit: hit["name"].isNotNull())
    kept = _bound(hits, lambda all_: F.filter(all_, lambda hit: ~F.exists(all_, lambda other: (other["end"] > hit["end"]) & (other["start"] < hit["end"]))))
    return F.transform(kept, lambda hit: hit["name"])


def scan_licences(docs: DataFrame) -> DataFrame:
    """*docs* with licences and unmatched (arrays) and sentence_ids (the sequence, joined by blanks)."""
    text = F.lower("text")
    parts = F.filter(F.split(_replaced(text, UNFOLD), CUT), lambda part: F.regexp_like(part, F.lit(TRIGGER)))
    lines = F.transform(parts, lambda part: F.filter(F.transform(F.split(part, "\t"), lambda line: _replaced(line, NORMALISE)), lambda line: line != ""))
    names = F.flatten(F.transform(F.filter(lines, lambda each: F.size(each) > 0), _sentence_names))
    ids = F.when(F.regexp_like(text, F.lit(TRIGGER)), F.array_join(names, " ")).otherwise("")
    # Every identifier has two blanks of its own, so that neighbours can be replaced alike.
    rules = F.expr("array(" + ", ".join(f"named_struct('ids', ' {ids.replace(' ', '  ')} ', 'licence', ' ={licence} ')" for ids, licence in RULES) + ")")
    whole = F.concat(F.lit(" "), F.replace("sentence_ids", F.lit(" "), F.lit("  ")), F.lit(" "))
    matched = F.when(
        F.col("sentence_ids") != "", F.aggregate(rules, whole, lambda left, rule: F.replace(left, rule["ids"], rule["licence"]))
    ).otherwise("")
    parts = F.split(F.trim(matched), " +")
    return (
        docs.withColumn("sentence_ids", F.coalesce(ids, F.lit("")))
        .withColumn("unmatched", parts)
        .withColumn("licences", F.array_distinct(F.transform(F.filter("unmatched", lambda x: x.startswith("=")), lambda x: F.substring(x, 2, 100))))
        .withColumn("unmatched", F.filter("unmatched", lambda x: (x != "") & ~x.startswith("=")))
    )
