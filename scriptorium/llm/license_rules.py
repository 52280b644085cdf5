"""Licence signature rules, built from hand-written families, versions and notice sentences.

A rule is a regular expression over the canonical text: lower-case words with one space between
and around them.  Versions such as "2.0" are two words there.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

#: The phrases of the base labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Rule:
    """``label`` where ``pattern`` matches, if all ``needs`` words occur; a higher priority wins."""

    label: str
    pattern: str
    needs: tuple[str, ...]
    priority: int
    weight: float


L = "licen[cs]e"
#: (SPDX stem, name pattern, short-form pattern, words that must occur, versions)
FAMILIES = [
    ("gpl", rf"gnu (?:general public|gpl) {L}|gnu gpl", "gpl", ("gpl|gnu",), ("1.0", "2.0", "3.0")),
    ("lgpl", rf"gnu (?:lesser|library) general public {L}|gnu lgpl", "lgpl", ("lgpl|gnu",), ("2.0", "2.1", "3.0")),
    ("agpl", rf"(?:gnu )?affero general public {L}|gnu agpl", "agpl", ("agpl|affero",), ("1.0", "3.0")),
    ("gfdl", rf"gnu free documentation {L}", "gfdl", ("gfdl|documentation",), ("1.1", "1.2", "1.3")),
    ("apache", rf"apache(?: software)? {L}", "apache", ("apache",), ("1.0", "1.1", "2.0")),
    ("mpl", rf"mozilla public {L}", "mpl", ("mpl|mozilla",), ("1.0", "1.1", "2.0")),
    ("epl", rf"eclipse public {L}", "epl", ("epl|eclipse",), ("1.0", "2.0")),
    ("cddl", rf"common development and distribution {L}", "cddl", ("cddl|distribution",), ("1.0", "1.1")),
    ("cpl", rf"common public {L}", "cpl", ("cpl|common",), ("1.0",)),
    ("eupl", rf"european union public {L}", "eupl", ("eupl|european",), ("1.0", "1.1", "1.2")),
    ("osl", rf"open software {L}", "osl", ("osl|open",), ("1.0", "2.0", "2.1", "3.0")),
    ("afl", rf"academic free {L}", "afl", ("afl|academic",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("artistic", rf"artistic {L}", "artistic", ("artistic",), ("1.0", "2.0")),
    ("bsl", rf"boost software {L}", "bsl", ("bsl|boost",), ("1.0",)),
    ("ofl", rf"(?:sil )?open font {L}", "ofl", ("ofl|font",), ("1.0", "1.1")),
    ("lppl", rf"latex project public {L}", "lppl", ("lppl|latex",), ("1.0", "1.1", "1.2", "1.3")),
    ("odbl", rf"open database {L}", "odbl", ("odbl|database",), ("1.0",)),
    ("cecill", rf"cecill(?: free software)? {L}", "cecill", ("cecill",), ("1.0", "2.0", "2.1")),
    ("php", rf"php {L}", "php", ("php",), ("3.0", "3.01")),
    ("psf", rf"python(?: software foundation)? {L}", "psf", ("psf|python",), ("2.0",)),
    ("zpl", rf"zope public {L}", "zpl", ("zpl|zope",), ("1.1", "2.0", "2.1")),
    ("apsl", rf"apple public source {L}", "apsl", ("apsl|apple",), ("1.0", "1.1", "1.2", "2.0")),
    ("ms-pl", rf"microsoft public {L}", "ms pl", ("pl|microsoft",), ("1.0",)),
    ("ms-rl", rf"microsoft reciprocal {L}", "ms rl", ("rl|microsoft",), ("1.0",)),
    ("upl", rf"universal permissive {L}", "upl", ("upl|universal",), ("1.0",)),
    ("ecl", rf"educational community {L}", "ecl", ("ecl|educational",), ("1.0", "2.0")),
    ("ncsa", rf"university of illinois ncsa open source {L}", "ncsa", ("ncsa",), ()),
    ("isc", rf"isc {L}", "isc", ("isc",), ()),
    ("zlib", rf"zlib(?: libpng)? {L}", "zlib", ("zlib",), ()),
    ("unlicense", r"the unlicense|unlicense org", "unlicense", ("unlicense",), ()),
    ("wtfpl", r"do what the fuck you want to public license", "wtfpl", ("wtfpl|fuck",), ()),
    ("beerware", rf"beer ?ware {L}", "beerware", ("beerware|beer",), ()),
]
#: Creative Commons: elements after "by", and versions.
CC_ELEMENTS = {"": "", "-sa": " sa", "-nc": " nc", "-nd": " nd", "-nc-sa": " nc sa", "-nc-nd": " nc nd"}
CC_WORDS = {"sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
#: (label, sentence, words that must occur)
NOTICES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", ("hereby", "granted")),
    ("mit", r"(?:under the |the )?mit licen[cs]e(?: mit)?", ("mit", "license|licence")),
    ("mit", r"opensource org licenses mit", ("opensource", "mit")),
    ("mit", r"spdx license identifier mit", ("spdx", "mit")),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee", ("permission", "fee")),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", ("redistribution", "binary")),
    ("bsd-3-clause", r"neither the name of (?:\S+ ){1,12}?nor the names of its contributors may be used", ("neither", "contributors")),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", ("advertising", "materials")),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors", ("warranty", "authors")),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", ("redistribute", "gnu")),
    ("lgpl", r"this library is free software you can redistribute it and or modify it", ("library", "redistribute")),
    ("apache-2.0", r"licensed under the apache license version 2 0(?: the license)?", ("licensed", "apache")),
    ("apache-2.0", r"(?:www )?apache org licenses license 2 0", ("apache", "licenses")),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla", "subject")),
    ("boost", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software", ("hereby", "organization")),
    ("unlicense", r"this is free and unencumbered software released into the public domain", ("unencumbered",)),
    ("public-domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain", ("public", "domain")),
    ("cc0-1.0", r"cc0 1 0(?: universal)?|creative commons zero(?: 1 0)?|creativecommons org publicdomain zero 1 0", ("cc0|zero",)),
    ("cc0", r"cc0", ("cc0",)),
    ("proprietary", r"all rights reserved", ("rights", "reserved")),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", ("proprietary", "confidential")),
    ("gpl", r"the gnu general public license is a free copyleft license for software and other kinds of works", ("copyleft", "gnu")),
    ("gpl", r"the licenses for most software (?:and other practical works )?are designed to take away your freedom to share and change (?:it|the works)", ("freedom", "designed")),
    ("gpl", r"you should have received a copy of the gnu general public license along with this program", ("received", "gnu")),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public license along with this library", ("received", "library")),
    ("lgpl", r"this license the (?:lesser|library) general public license applies to (?:some|certain) specially designated", ("specially", "designated")),
    ("agpl", r"your modified version must prominently offer all users interacting with it remotely through a computer network", ("remotely", "prominently")),
    ("gfdl", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", ("document", "gnu")),
    ("apache-2.0", r"terms and conditions for use reproduction and distribution 1 definitions", ("reproduction", "definitions")),
    ("apache-2.0", r"grant of (?:copyright|patent) license subject to the terms and conditions of this license each contributor hereby grants to you a perpetual worldwide", ("contributor", "perpetual")),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", ("unless", "agreed")),
    ("apache-1.1", r"the end user documentation included with the redistribution if any must include the following acknowledgment", ("acknowledgment", "redistribution")),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", ("substantial", "portions")),
    ("mit", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", ("warranty", "merchantability")),
    ("x11", r"except as contained in this notice the name of (?:\S+ ){1,8}?shall not be used in advertising or otherwise to promote the sale", ("contained", "promote")),
    ("bsd", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", ("redistributions", "retain")),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice this list of conditions", ("redistributions", "reproduce")),
    ("bsd", r"this software is provided by (?:\S+ ){1,10}?as is and any express or implied warranties including", ("warranties", "express")),
    ("bsd-4-clause", r"this product includes software developed by the university of california", ("university", "developed")),
    ("openssl", r"this product includes software developed by the openssl project", ("openssl",)),
    ("zlib", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", ("misrepresented", "origin")),
    ("zlib", r"altered source versions must be plainly marked as such", ("altered", "plainly")),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file you can obtain one at", ("mpl", "obtain")),
    ("mpl-2.0", r"covered software is provided under this license on an as is basis", ("covered", "basis")),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1", ("contents", "mozilla")),
    ("epl", r"the accompanying program is provided under the terms of this eclipse public license", ("accompanying", "eclipse")),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v |version )?2 0", ("accompanying", "eclipse")),
    ("cddl", r"the contents of this file are subject to the terms of the common development and distribution license", ("contents", "distribution")),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied", ("intent", "package")),
    ("artistic", r"this package is free software you can redistribute it and or modify it under the same terms as perl", ("perl", "package")),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", ("verbatim", "changing")),
    ("unlicense", r"anyone is free to copy modify publish use compile sell or distribute this software", ("anyone", "compile")),
    ("cc0-1.0", r"to the extent possible under law (?:\S+ ){1,12}?has waived all copyright and related or neighboring rights", ("waived", "neighboring")),
    ("ofl", r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects", ("ofl", "stimulate")),
    ("ofl", r"this font software is licensed under the sil open font license", ("font", "sil")),
    ("psf-2.0", r"this license agreement is between the python software foundation psf and the individual or organization", ("psf", "agreement")),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", ("fee", "agreement")),
    ("isc", r"the software is provided as is and the author disclaims all warranties with regard to this software", ("disclaims", "warranties")),
    ("boost", r"boost software license version 1 0 august 17th 2003", ("boost",)),
    ("ms-pl", r"this license governs use of the accompanying software if you use the software you accept this license", ("governs", "accompanying")),
    ("beerware", r"as long as you retain this notice you can do whatever you want with this stuff", ("retain", "whatever")),
    ("odbl-1.0", r"this (?:\S+ ){1,6}?is made available under the open database license", ("open", "database")),
    ("eupl", r"licensed under the eupl", ("eupl", "licensed")),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", ("hosted", "managed")),
    ("sspl-1.0", r"server side public license", ("server", "side")),
    ("busl-1.1", r"business source license 1 1", ("business", "source")),
    ("json", r"the software shall be used for good not evil", ("evil", "good")),
    ("proprietary", r"(?:unauthorized|unauthorised) copying of this file via any medium is strictly prohibited", ("copying", "strictly")),
    ("proprietary", r"this (?:software|material|document) is the (?:confidential and )?proprietary (?:information|property) of", ("proprietary",)),
    ("public-domain", r"this (?:work|file|software) is (?:hereby )?in the public domain", ("public", "domain")),
    ("no-redistribution", r"(?:may|must) not be (?:copied|reproduced|redistributed)(?: \S+){0,6}? without (?:\S+ ){0,3}?permission", ("without", "permission")),
]


def _version(v: str) -> str:
    major, minor = v.split(".")
    tail = " 0" if minor == "0" else f" {minor}"
    return rf"(?:version |v(?:er)? ?)?{major}(?:{tail})" + ("?" if minor == "0" else "")


def build_rules() -> list[Rule]:
    """All rules, in order of priority."""
    rules = []
    for stem, name, short, needs, versions in FAMILIES:
        head = rf"(?:{name}|{short}(?: {L})?)"
        rules.append(Rule(stem, rf"(?:{name})", needs, 40, 0.7))
        rules.append(Rule(stem, rf"(?:spdx license identifier|license|licen[cs]ed under(?: the)?) {short}", (*needs, "license|licensed|licenced"), 45, 0.7))
        for v in versions:
            number = _version(v)
            rules.append(Rule(f"{stem}-{v}", rf"{head} {number}", needs, 60, 0.9))
            if stem.endswith("gpl"):
                rules.append(Rule(f"{stem}-{v}-or-later", rf"{head} {number} or (?:at your option )?(?:any )?later(?: version)?", (*needs, "later"), 70, 0.95))
                rules.append(Rule(f"{stem}-{v}-only", rf"{head} {number} only", (*needs, "only"), 70, 0.95))
                rules.append(Rule(f"{stem}-{v}", rf"gnu org licenses (?:old licenses )?{stem} {v.replace('.', ' ')}", (*needs, "licenses"), 65, 0.95))
            else:
                rules.append(Rule(f"{stem}-{v}", rf"opensource org licenses {short} {v.replace('.', ' ')}", (*needs, "opensource"), 65, 0.95))
                rules.append(Rule(f"{stem}-{v}", rf"spdx license identifier {short} {v.replace('.', ' ')}", (*needs, "spdx"), 65, 0.95))
    for n, extra in (("0", ""), ("1", ""), ("2", "|simplified|freebsd"), ("3", "|new|revised|modified"), ("4", "|original|old")):
        word = {"0": "zero", "1": "one", "2": "two", "3": "three", "4": "four"}[n]
        rules.append(Rule(f"bsd-{n}-clause", rf"(?:(?:{n}|{word}) clause{extra}) bsd(?: {L})?|bsd {n} clause(?: {L})?", ("bsd",), 60, 0.9))
    rules.append(Rule("bsd", rf"bsd(?: style)? {L}", ("bsd",), 40, 0.7))
    for code, words in CC_ELEMENTS.items():
        long = "".join(rf"(?: and)? {CC_WORDS[w]}" for w in words.split())
        label = f"cc-by{code}"
        rules.append(Rule(label, rf"cc by{words}", ("cc", "by"), 40 + 3 * len(words.split()), 0.7))
        rules.append(Rule(label, rf"creative commons attribution{long}(?: {L})?", ("creative", "attribution"), 40 + 3 * len(words.split()), 0.7))
        for v in CC_VERSIONS:
            rank, number = 60 + 3 * len(words.split()), v.replace(".", " ")
            rules.append(Rule(f"{label}-{v}", rf"cc by{words} (?:v ?)?{number}(?: international| unported)?", ("cc", "by"), rank, 0.95))
            rules.append(Rule(f"{label}-{v}", rf"creative commons attribution{long}(?: {L})? (?:version )?{number}(?: international| unported| generic)?(?: {L})?", ("creative", "attribution"), rank, 0.95))
            rules.append(Rule(f"{label}-{v}", rf"creativecommons org licenses by{words} {number}", ("creativecommons",), rank, 0.95))
    rules += [Rule(label, sentence, needs, 50 + min(30, sentence.count(" ") * 2), 0.9 if label != "proprietary" else 0.4) for label, sentence, needs in NOTICES]
    return sorted(rules, key=lambda r: (-r.priority, r.label, r.pattern))


class Scanner:
    """Rules gated by the words they need; detections resolved by containment and priority."""

    def __init__(self, rules: list[Rule] | None = None):
        self.rules = build_rules() if rules is None else rules
        self.compiled = [re.compile(f" (?:{r.pattern})(?= )".encode()) for r in self.rules]
        self.gates = [[frozenset(x.encode() for x in need.split("|")) for need in r.needs] for r in self.rules]
        self.keywords = frozenset(k for gate in self.gates for need in gate for k in need)
        #: Rules by the words of one of their needs, the one with the longest words.
        self.of_word: dict[bytes, list[int]] = {}
        for r, gate in enumerate(self.gates):
            for k in max(gate, key=lambda need: min(map(len, need))):
                self.of_word.setdefault(k, []).append(r)
        self.base = [(f" {phrase} ".encode(), label, phrase.count(" ") + 1) for phrase, label in BASE.items()]

    def base_places(self, canonical: bytes) -> list[tuple[int, int, str]]:
        """(first word, one past the last, label) of every place of a base phrase."""
        out = []
        for phrase, label, n in self.base:
            at, word, last = canonical.find(phrase), 0, 0
            while at >= 0:
                word, last = word + canonical.count(b" ", last, at), at
                out.append((word, word + n, label))
                at = canonical.find(phrase, at + 1)
        return sorted(out)

    def detect(self, canonical: bytes, words: list[bytes] | None = None) -> list[tuple[int, int, str, int, float]]:
        """Resolved detections (first word, one past the last, label, priority, weight).

        In order of priority, then length: a detection inside one already taken is suppressed; one
        that only overlaps stays.
        """
        present = self.keywords.intersection(canonical.split() if words is None else words)
        found = []
        for r in sorted({r for k in present for r in self.of_word.get(k, ())}):
            if all(not need.isdisjoint(present) for need in self.gates[r]):
                rule, word, last = self.rules[r], 0, 0
                for m in self.compiled[r].finditer(canonical):
                    word, last = word + canonical.count(b" ", last, m.start()), m.start()
                    found.append((word, word + m[0].count(b" "), rule.label, rule.priority, rule.weight))
        if not found:
            return []
        kept: list[tuple[int, int, str, int, float]] = []
        starts = sorted({d[0] for d in found})
        furthest = [0] * (len(starts) + 1)  # Fenwick tree: the largest end among kept detections by start
        for d in sorted(found, key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
            at = i = bisect_right(starts, d[0])
            most = 0
            while i:
                most, i = max(most, furthest[i]), i & (i - 1)
            if most < d[1]:
                kept.append(d)
                while at <= len(starts):
                    furthest[at], at = max(furthest[at], d[1]), at + (at & -at)
        return sorted(kept)
