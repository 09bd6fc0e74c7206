"""License scans by sentence rules, in DataFrame functions only.

A text is cut into fragments (at line ends and after ``.``, ``!`` or ``?`` before
white space), each is normalised to lower-case letters and digits with single
blanks, and known licence sentences become identifiers of one character. A
known sentence is a fragment or a run of lines without a sentence end between
them, so it is found hard-wrapped at any width and behind comment marks; it may
follow a list number (``1.``, ``(a)``), and two that share one sentence
("...; you may not use this file ...") both count. The identifiers, in the order
of the text, form a string in which ordered rules (sequences of identifiers) are
matched from the left, the longest rule first, so a full notice is reported once
and not as its parts. Any other fragment stands as a blank, which no rule crosses.

Defined results: a null or empty text has no sentence and no licence; a licence
found several times counts each time and is listed once; an empty table gives
no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, UPPER

#: Identifier and normalised text of the known sentences.
SENTENCES = [
    ("a", "released under the mit license"),
    ("a", "licensed under the mit license"),
    ("a", "this project is licensed under the mit license"),
    ("b", "permission is hereby granted free of charge to any person obtaining a copy of this "
          "software and associated documentation files the software to deal in the software "
          "without restriction including without limitation the rights to use copy modify merge "
          "publish distribute sublicense and or sell copies of the software and to permit persons "
          "to whom the software is furnished to do so subject to the following conditions"),
    ("c", "the above copyright notice and this permission notice shall be included in all copies "
          "or substantial portions of the software"),
    ("d", "licensed under the apache license version 2 0"),
    ("d", "licensed under the apache license version 2 0 the license"),
    ("e", "you may not use this file except in compliance with the license"),
    ("f", "you may obtain a copy of the license at"),
    ("g", "http www apache org licenses license 2 0"),
    ("h", "this work is licensed under the gnu general public license version 3"),
    ("h", "licensed under the gnu general public license version 3"),
    ("i", "this work is licensed under the gnu general public license version 2"),
    ("i", "licensed under the gnu general public license version 2"),
    ("j", "licensed under cc by 4 0"),
    ("k", "licensed under cc by sa 4 0"),
    ("l", "licensed under cc by nc 4 0"),
    ("m", "licensed under cc by nc sa 4 0"),
    ("n", "licensed under cc by nd 4 0"),
    ("o", "this work is dedicated to the public domain under cc0 1 0"),
    ("p", "redistribution and use in source and binary forms with or without modification are "
          "permitted provided that the following conditions are met"),
    ("q", "redistributions of source code must retain the above copyright notice this list of "
          "conditions and the following disclaimer"),
    ("r", "redistributions in binary form must reproduce the above copyright notice this list of "
          "conditions and the following disclaimer in the documentation and or other materials "
          "provided with the distribution"),
    ("s", "neither the name of the copyright holder nor the names of its contributors may be used "
          "to endorse or promote products derived from this software without specific prior "
          "written permission"),
    ("t", "all rights reserved"),
    ("u", "licensed under the mozilla public license version 2 0"),
    ("v", "this work is licensed under the gnu lesser general public license version 3"),
    ("w", "spdx license identifier mit"),
    ("x", "spdx license identifier apache 2 0"),
    ("y", "spdx license identifier gpl 3 0 only"),
]

#: Ordered identifiers and the licence they stand for.
RULES = [
    ("bc", "MIT"), ("b", "MIT"), ("abc", "MIT"), ("a", "MIT"), ("w", "MIT"),
    ("defg", "Apache-2.0"), ("def", "Apache-2.0"), ("de", "Apache-2.0"), ("d", "Apache-2.0"),
    ("x", "Apache-2.0"), ("h", "GPL-3.0"), ("y", "GPL-3.0"), ("i", "GPL-2.0"), ("v", "LGPL-3.0"),
    ("j", "CC-BY-4.0"), ("k", "CC-BY-SA-4.0"), ("l", "CC-BY-NC-4.0"), ("m", "CC-BY-NC-SA-4.0"),
    ("n", "CC-BY-ND-4.0"), ("o", "CC0-1.0"), ("pqrs", "BSD-3-Clause"), ("pqr", "BSD-2-Clause"),
    ("u", "MPL-2.0"), ("t", "all-rights-reserved"),
]

# Further notices, by name: those that differ in a few words only are made from a rule.
# The wording of the notices.
_GRANT = SENTENCES[3][1].removesuffix(" subject to the following conditions")
_GNU = {"general": ("gpl", ("2", "3")), "lesser general": ("lgpl", ("2 1", "3")),
        "affero general": ("agpl", ("3",))}
NOTICES = {
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but "
                    "not limited to the warranties of merchantability fitness for a particular purpose and "
                    "noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other "
                     "liability whether in an action of contract tort or otherwise arising from out of or in "
                     "connection with the software or the use or other dealings in the software",
    "mit-0": _GRANT,
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license "
                    "is distributed on an as is basis without warranties or conditions of any kind either express or "
                    "implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "apache-url": "https www apache org licenses license 2 0",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is and any express or "
                    "implied warranties including but not limited to the implied warranties of merchantability and "
                    "fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall the copyright holder or contributors be liable for any direct indirect "
                     "incidental special exemplary or consequential damages including but not limited to procurement "
                     "of substitute goods or services loss of use data or profits or business interruption however "
                     "caused and on any theory of liability whether in contract strict liability or tort including "
                     "negligence or otherwise arising in any way out of the use of this software even if advised of "
                     "the possibility of such damage",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
           "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-and": "permission to use copy modify and distribute this software for any purpose with or without fee is "
               "hereby granted provided that the above copyright notice and this permission notice appear in all "
               "copies",
    "0bsd": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in "
                        "source code form or as a compiled binary for any purpose commercial or non commercial and by "
                        "any means",
    "zlib": "permission is granted to anyone to use this software for any purpose including commercial applications "
            "and to alter it and redistribute it freely subject to the following restrictions",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "boost": "distributed under the boost software license version 1 0",
    "boost-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy of the "
                   "software and accompanying documentation covered by this license the software to use reproduce "
                   "display distribute execute and transmit the software and to prepare derivative works of the "
                   "software and to permit third parties to whom the software is furnished to do so all subject to "
                   "the following",
    "mpl": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "epl-2": "this program and the accompanying materials are made available under the terms of the eclipse public "
             "license 2 0",
    "gnu-warranty": "this program is distributed in the hope that it will be useful but without any warranty without "
                    "even the implied warranty of merchantability or fitness for a particular purpose",
    **{f"gnu-{short}-see": f"see the gnu {family} public license for more details"
       for family, (short, _) in _GNU.items()},
    **{f"gnu-{short}-copy": f"you should have received a copy of the gnu {family} public license along with this program"
       for family, (short, _) in _GNU.items()},
    **{f"{short}-{version}-{subject}": f"this {subject} is free software you can redistribute it and or modify it under "
       f"the terms of the gnu {family} public license as published by the free software foundation either version "
       f"{version} of the license or at your option any later version"
       for family, (short, versions) in _GNU.items() for version in versions for subject in ("program", "library")},
}
#: Licences by the names that follow "licensed under the" and the like.
NAMED = {"bsd 2 clause license": "BSD-2-Clause", "bsd 3 clause license": "BSD-3-Clause", "isc license": "ISC",
         "zlib license": "Zlib", "unlicense": "Unlicense", "boost software license 1 0": "BSL-1.0",
         "mozilla public license 2 0": "MPL-2.0", "eclipse public license 2 0": "EPL-2.0",
         "gnu affero general public license version 3": "AGPL-3.0",
         "gnu lesser general public license version 2 1": "LGPL-2.1"}
#: Tags "SPDX-License-Identifier: <tag>" beside those above; "-only" and "-or-later" name the same licence.
TAGS = ["0BSD", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        "EPL-1.0", "EPL-2.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT-0", "MPL-2.0", "Unlicense",
        "Zlib"]


def _further() -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Sentences and rules of the notices, names and tags; identifiers are numbered characters."""
    number: dict[str, str] = {}
    known, rules = [], []

    def key(name: str) -> str:
        return number.setdefault(name, chr(0x4E00 + len(number)))

    known += [(key(name), text) for name, text in NOTICES.items()]
    for name, licence in NAMED.items():
        known += [(key(name), f"{verb} under the {name}") for verb in (
            "licensed", "released", "distributed", "this project is licensed", "this work is licensed")]
        rules.append((key(name), licence))
    for tag in TAGS:
        for end in ("", *(("-only", "-or-later") if "GPL" in tag else ())):
            words = "".join(c if c.isalnum() else " " for c in (tag + end).lower())
            if (text := f"spdx license identifier {words}") not in {t for _, t in SENTENCES}:
                known.append((key(f"spdx {tag}"), text))
        rules.append((key(f"spdx {tag}"), tag))

    def rule(licence: str, *names: str) -> None:
        """``names`` of notices in order; after ``=`` come identifiers of the list above."""
        rules.append(("".join(n[1:] if n[0] == "=" else key(n) for n in names), licence))

    for first in ("=bc", "=abc"):
        rule("MIT", first, "mit-warranty", "mit-liability")
    rule("MIT-0", "mit-0")
    rule("MIT-0", "mit-0", "mit-warranty", "mit-liability")
    for url in ("=g", "apache-url"):
        rule("Apache-2.0", "=def", url)
        rule("Apache-2.0", "=def", url, "apache-basis", "apache-see")
    for first, licence in (("=pqrs", "BSD-3-Clause"), ("=pqr", "BSD-2-Clause")):
        rule(licence, first, "bsd-warranty", "bsd-liability")
    for name in ("isc", "isc-and"):
        rule("ISC", name)
    rule("0BSD", "0bsd")
    rule("Unlicense", "unlicense")
    rule("Unlicense", "unlicense", "unlicense-anyone")
    rule("Zlib", "zlib")
    rule("BSL-1.0", "boost")
    rule("BSL-1.0", "boost-grant")
    rule("MPL-2.0", "mpl")
    rule("MPL-2.0", "mpl-copy")
    rule("EPL-2.0", "epl-2")
    for short, versions in _GNU.values():
        for version in versions:
            licence = f"{short.upper()}-{version.replace(' ', '.')}" + (".0" if " " not in version else "")
            for subject in ("program", "library"):
                notice = f"{short}-{version}-{subject}"
                rule(licence, notice)
                rule(licence, notice, "gnu-warranty", f"gnu-{short}-see")
                rule(licence, notice, "gnu-warranty", f"gnu-{short}-see", f"gnu-{short}-copy")
    known_rules = {r for r, _ in RULES}
    return known, [r for r in dict.fromkeys(rules) if r[0] not in known_rules]


SENTENCES, RULES = [x + y for x, y in zip((SENTENCES, RULES), _further(), strict=True)]

#: A list number, cut from its sentence.
NUMBER = "(?:[0-9]{1,2}|[a-z])"


def fragments(text: Column) -> Column:
    """The text normalised: ``S`` stands for a sentence end, a line feed for any other line end."""
    t = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)  # no capitals: they can be marks
    t = F.regexp_replace(t, r"(?<![^\n])([^a-z0-9\n]*" + NUMBER + r")\)[\x20\x09-\x0D]+", "$1S")
    t = F.regexp_replace(t, r"([.!?])[\x20\x09-\x0D]+", "$1S")
    t = F.regexp_replace(t, r"[^a-z0-9\nS]+", " ")
    t = F.regexp_replace(t, r"[ \n]*\n[ \n]*", "\n")
    return F.trim(F.regexp_replace(t, r"[ \n]?S[ \nS]*", "S"))


def sentence_pattern(known: list[tuple[str, str]]) -> str:
    """A known sentence over any number of lines, the longest first, or else one fragment."""
    texts = "|".join(s.replace(" ", r"[ \n]") for s in sorted(
        {s for _, s in known}, key=lambda s: (-len(s), s)))
    one = f"(?:{NUMBER}S)?(?:{texts})"
    end = r"(?![^\nS])"
    return f" ?{one}(?:{end}|(?= {one}{end}))" + r"|[^\nS]+"


def sentences(text: Column, known: list[tuple[str, str]] = SENTENCES) -> Column:
    """The normalised sentences of a text: known ones whole, others by line."""
    return F.transform(
        F.regexp_extract_all(fragments(text), F.lit(sentence_pattern(known)), F.lit(0)),
        lambda s: F.trim(F.regexp_replace(F.translate(s, "\n", " "), "^.*S", "")))


def markers(known: list[tuple[str, str]]) -> list[str]:
    """Words of which every known sentence has one: the word most sentences have that have none yet."""
    left, out = {s for _, s in known}, []
    while left:
        seen: dict[str, int] = {}
        for s in left:
            for w in {w for w in s.split() if len(w) > 6} or {max(s.split(), key=len)}:
                seen[w] = seen.get(w, 0) + 1
        out.append(min(seen, key=lambda w: (-seen[w], w)))
        left = {s for s in left if out[-1] not in s.split()}
    return out


def identifiers(text: Column, known: list[tuple[str, str]] = SENTENCES) -> Column:
    """The text's sentences as a string of identifiers, a blank for an unknown one; empty for a text
    that holds no marker word, and so no known sentence."""
    table = F.create_map(*[F.lit(x) for i, s in known for x in (s, i)])
    texts = [s for _, s in known]
    ids = F.array_join(F.transform(sentences(text, known), lambda s: F.when(
        s.isin(texts), F.element_at(table, s)).otherwise(F.lit(" "))), "")
    marked = text.rlike("(?i)" + "|".join(markers(known)))
    return F.when(F.coalesce(marked, F.lit(False)), ids).otherwise(F.lit(""))


def pattern(rules: list[tuple[str, str]] = RULES) -> str:
    """Alternatives of all rules, the longest first."""
    return "(" + "|".join(sorted({r for r, _ in rules}, key=lambda r: (-len(r), r))) + ")"


def scan(docs: DataFrame, text: str = "text", known: list[tuple[str, str]] = SENTENCES,
         rules: list[tuple[str, str]] = RULES, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``__ids`` (the identifiers), ``__matches`` (rules
    matched, in the text's order) and ``__licenses`` (sorted, each once)."""
    carry = docs.columns if carry is None else carry
    names = F.create_map(*[F.lit(x) for x in sum(rules, ())])
    found = docs.select(*carry, identifiers(F.col(text), known).alias("__ids")).withColumn(
        "__matches", F.regexp_extract_all("__ids", F.lit(pattern(rules)), F.lit(1)))
    return found.withColumn("__licenses", F.array_sort(F.array_distinct(
        F.transform("__matches", lambda m: F.element_at(names, m)))))
