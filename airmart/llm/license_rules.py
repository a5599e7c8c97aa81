"""Ordered signature rules of licence texts.

A rule is a regular expression over a text's normalised words (lower case, joined by one space) with keywords that
must occur before it is tried. Written by hand are the licence families and the wordings in which they are named;
the rules are their product, and the signatures of licence bodies beside them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# The phrases that a scan always reports, with their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Licence families: label, identifier words, names in prose, and keywords one of which every name holds.
FAMILIES = (
    ("mit", "mit", "mit|expat|x11 mit|mit x11|mit expat", ("mit", "expat")),
    ("mit-0", "mit 0", "mit no attribution|mit zero", ("mit",)),
    ("x11", "x11", "x11|x consortium", ("x11", "consortium")),
    ("isc", "isc", "isc|internet systems consortium", ("isc", "consortium")),
    ("bsd-0-clause", "0bsd", "0bsd|bsd zero clause|zero clause bsd", ("0bsd", "bsd")),
    ("bsd-1-clause", "bsd 1 clause", "bsd 1 clause|1 clause bsd|one clause bsd", ("bsd",)),
    ("bsd-2-clause", "bsd 2 clause", "bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd", ("bsd", "freebsd")),
    ("bsd-3-clause", "bsd 3 clause", "bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd", ("bsd",)),
    ("bsd-4-clause", "bsd 4 clause", "bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd", ("bsd",)),
    ("bsd", "bsd", "bsd|bsd style|berkeley", ("bsd", "berkeley")),
    ("apache-1.1", "apache 1 1", "apache(?: software)?(?: licen[cs]e)?(?: version)? 1 1", ("apache",)),
    ("apache-2.0", "apache 2 0", "apache(?: software)?(?: licen[cs]e)?(?: version)? 2(?: 0)?|asl 2(?: 0)?|al2", ("apache", "asl", "al2")),
    ("apache", "apache", "apache|apache software", ("apache",)),
    ("mpl-1.0", "mpl 1 0", "mozilla public licen[cs]e(?: version)? 1 0|mpl 1 0", ("mozilla", "mpl")),
    ("mpl-1.1", "mpl 1 1", "mozilla public licen[cs]e(?: version)? 1 1|mpl 1 1", ("mozilla", "mpl")),
    ("mpl-2.0", "mpl 2 0", "mozilla public licen[cs]e(?: version)? 2(?: 0)?|mpl 2(?: 0)?", ("mozilla", "mpl")),
    ("mpl", "mpl", "mozilla public|mpl", ("mozilla", "mpl")),
    ("epl-1.0", "epl 1 0", "eclipse public licen[cs]e(?: version)? 1 0|epl 1 0", ("eclipse", "epl")),
    ("epl-2.0", "epl 2 0", "eclipse public licen[cs]e(?: version)? 2(?: 0)?|epl 2(?: 0)?", ("eclipse", "epl")),
    ("cddl-1.0", "cddl 1 0", "common development and distribution licen[cs]e|cddl", ("distribution", "cddl")),
    ("cpl-1.0", "cpl 1 0", "common public licen[cs]e|cpl 1 0", ("common", "cpl")),
    ("ipl-1.0", "ipl 1 0", "ibm public licen[cs]e", ("ibm",)),
    ("eupl-1.1", "eupl 1 1", "european union public licen[cs]e(?: version)? 1 1|eupl 1 1", ("european", "eupl")),
    ("eupl-1.2", "eupl 1 2", "european union public licen[cs]e(?: version)?(?: 1 2)?|eupl(?: 1 2)?", ("european", "eupl")),
    ("cecill-2.1", "cecill 2 1", "cecill(?: 2 1)?", ("cecill",)),
    ("cecill-b", "cecill b", "cecill b", ("cecill",)),
    ("cecill-c", "cecill c", "cecill c", ("cecill",)),
    ("artistic-1.0", "artistic 1 0", "artistic licen[cs]e(?: version)? 1(?: 0)?", ("artistic",)),
    ("artistic-2.0", "artistic 2 0", "artistic licen[cs]e(?: version)? 2(?: 0)?", ("artistic",)),
    ("artistic", "artistic", "artistic|same terms as perl itself", ("artistic", "perl")),
    ("zlib", "zlib", "zlib|zlib libpng", ("zlib",)),
    ("libpng", "libpng", "libpng", ("libpng",)),
    ("bsl-1.0", "bsl 1 0", "boost(?: software)?", ("boost",)),
    ("busl-1.1", "busl 1 1", "business source", ("business",)),
    ("elastic-2.0", "elastic 2 0", "elastic licen[cs]e(?: version)?(?: 2(?: 0)?)?", ("elastic",)),
    ("sspl-1.0", "sspl 1 0", "server side public|sspl", ("server", "sspl")),
    ("unlicense", "unlicense", "unlicense", ("unlicense",)),
    ("wtfpl", "wtfpl", "wtfpl|do what the fuck you want to public", ("wtfpl", "what")),
    ("ms-pl", "ms pl", "microsoft public|ms pl", ("microsoft", "ms")),
    ("ms-rl", "ms rl", "microsoft reciprocal|ms rl", ("microsoft", "ms")),
    ("ofl-1.1", "ofl 1 1", "sil open font|open font|ofl(?: 1 1)?", ("font", "ofl")),
    ("psf-2.0", "psf 2 0", "python software foundation|psf", ("python", "psf")),
    ("python-2.0", "python 2 0", "python", ("python",)),
    ("php-3.01", "php 3 01", "php", ("php",)),
    ("ruby", "ruby", "ruby", ("ruby",)),
    ("openssl", "openssl", "openssl|openssl ssleay", ("openssl",)),
    ("curl", "curl", "curl", ("curl",)),
    ("vim", "vim", "vim", ("vim",)),
    ("postgresql", "postgresql", "postgresql|postgres", ("postgresql", "postgres")),
    ("ncsa", "ncsa", "university of illinois ncsa(?: open source)?|ncsa", ("ncsa",)),
    ("upl-1.0", "upl 1 0", "universal permissive|upl", ("permissive", "upl")),
    ("osl-3.0", "osl 3 0", "open software licen[cs]e(?: version)? 3(?: 0)?|osl 3 0", ("open", "osl")),
    ("afl-3.0", "afl 3 0", "academic free", ("academic",)),
    ("json", "json", "json", ("json",)),
    ("beerware", "beerware", "beer ?ware", ("beerware", "beer")),
    ("w3c", "w3c", "w3c software(?: notice and)?|w3c", ("w3c",)),
    ("unicode", "unicode dfs 2016", "unicode", ("unicode",)),
    ("odbl-1.0", "odbl 1 0", "open database|odbl", ("database", "odbl")),
    ("odc-by-1.0", "odc by 1 0", "open data commons attribution|odc by", ("commons", "odc")),
    ("pddl-1.0", "pddl 1 0", "public domain dedication and|pddl", ("dedication", "pddl")),
    ("cdla-permissive-2.0", "cdla permissive 2 0", "community data licen[cs]e agreement permissive(?: version)? 2(?: 0)?", ("community",)),
    ("cdla-sharing-1.0", "cdla sharing 1 0", "community data licen[cs]e agreement sharing", ("community",)),
    ("cc0-1.0", "cc0(?: 1 0)?", "cc0|cc zero|creative commons zero|creative commons public domain", ("cc0", "cc", "creative")),
    ("ogl-uk-3.0", "ogl uk 3 0", "open government", ("government",)),
    ("hippocratic-2.1", "hippocratic 2 1", "hippocratic", ("hippocratic",)),
    ("openrail", "openrail", "openrail(?: m)?|responsible ai|bigscience(?: bloom)? rail|creativeml open rail m", ("openrail", "responsible", "rail")),
    ("mulan-psl-2.0", "mulanpsl 2 0", "mulan permissive software", ("mulan",)),
    ("blueoak-1.0.0", "blueoak 1 0 0", "blue oak model", ("oak",)),
)
# Families with versions: label stem, identifier stem, names, keywords, versions.
GNU = (("agpl", "gnu affero general public|affero general public|agpl", ("affero", "agpl"), ("1 0", "3 0")),
       ("lgpl", "gnu lesser general public|gnu library general public|lesser general public|library general public|lgpl", ("lesser", "library", "lgpl"), ("2 0", "2 1", "3 0")),
       ("gpl", "gnu general public|gnu gpl|general public|gpl", ("gnu", "general", "gpl"), ("1 0", "2 0", "3 0")),
       ("gfdl", "gnu free documentation|gfdl", ("documentation", "gfdl"), ("1 1", "1 2", "1 3")))
CC = (("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?deriv(?:atives|s)"),
      ("by nc", "attribution non ?commercial"), ("by nc sa", "attribution non ?commercial share ?alike"),
      ("by nc nd", "attribution non ?commercial no ?deriv(?:atives|s)"))
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Wordings around a name: priority (1 is strongest), relevance, expression and a keyword beside the name's.
FORMS = (
    ("tag", 1, 1.0, "spdx licen[cs]e identifier (?:{id})", "identifier"),
    ("url", 2, 0.95, "(?:opensource org licen[cs]es?|spdx org licen[cs]es|choosealicense com licen[cs]es) (?:{id})(?: html| php| txt)?", "opensource|spdx|choosealicense"),
    ("notice", 3, 0.9, "(?:licen[cs]ed|released|distributed|available|published|provided|covered|licen[cs]e)(?: [^ ]+){{0,4}}? under (?:the )?"
                       "(?:terms (?:and conditions )?of )?(?:the )?(?:{name})(?: licen[cs]e)?(?: agreement)?{tail}", "under"),
    ("title", 4, 0.8, "(?:the )?(?:{name}){end}(?: agreement)?{tail}", "license|licence"),
)

# Signatures of licence bodies and other notices: label, relevance, expression, keyword.
BODIES = (
    ("mit", 0.95, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby"),
    ("mit", 0.9, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial"),
    ("isc", 0.95, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("x11", 0.9, "except as contained in this notice the names? of .{1,80}? shall not be used in advertising", "advertising"),
    ("bsd", 0.9, "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd-3-clause", 0.95, "neither the names? of .{1,120}? may be used to endorse or promote products derived from this software", "endorse"),
    ("bsd-4-clause", 0.95, "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising"),
    ("bsd", 0.8, "redistributions of source code must retain the above copyright notice this list of conditions", "redistributions"),
    ("apache-2.0", 0.95, "terms and conditions for use reproduction and distribution", "reproduction"),
    ("apache-2.0", 0.9, "you may not use this file except in compliance with the license", "compliance"),
    ("apache-2.0", 0.9, "apache org licenses license 2 0", "apache"),
    ("gpl", 0.9, "you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", "redistribute"),
    ("gpl-2.0-or-later", 0.95, "gnu general public licen[cs]e as published by the free software foundation either version 2 of the licen[cs]e or at your option any later version", "foundation"),
    ("gpl-3.0-or-later", 0.95, "gnu general public licen[cs]e as published by the free software foundation either version 3 of the licen[cs]e or at your option any later version", "foundation"),
    ("lgpl", 0.9, "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e", "redistribute"),
    ("agpl", 0.9, "you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e", "redistribute"),
    ("gpl", 0.7, "without even the implied warranty of merchantability or fitness for a particular purpose", "merchantability"),
    ("gpl", 0.8, "gnu org (?:licen[cs]es|copyleft) gpl", "gnu"),
    ("lgpl", 0.8, "gnu org (?:licen[cs]es|copyleft) (?:lgpl|lesser)", "gnu"),
    ("agpl", 0.8, "gnu org (?:licen[cs]es|copyleft) agpl", "gnu"),
    ("gfdl", 0.9, "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e", "document"),
    ("mpl-1.1", 0.95, "the contents of this file are subject to the mozilla public licen[cs]e version 1 1", "mozilla"),
    ("mpl-2.0", 0.95, "this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? 2 0", "mozilla"),
    ("epl-1.0", 0.9, "accompanying materials are made available under the terms of the eclipse public licen[cs]e v(?:ersion)? ?1 0", "eclipse"),
    ("epl-2.0", 0.9, "accompanying materials are made available under the terms of the eclipse public licen[cs]e v(?:ersion)? ?2 0", "eclipse"),
    ("zlib", 0.95, "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "liable"),
    ("zlib", 0.9, "the origin of this software must not be misrepresented", "misrepresented"),
    ("bsl-1.0", 0.95, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "hereby"),
    ("unlicense", 0.95, "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", 0.95, "you just do what the fuck you want to", "what"),
    ("ofl-1.1", 0.9, "this font software is licensed under the sil open font licen[cs]e", "font"),
    ("beerware", 0.95, "you can buy me a beer in return", "beer"),
    ("json", 0.95, "the software shall be used for good not evil", "evil"),
    ("artistic", 0.8, "free software you can redistribute it and or modify it under the same terms as perl itself", "perl"),
    ("psf-2.0", 0.9, "psf is making python available to licensee on an as is basis", "psf"),
    ("openssl", 0.9, "this product includes software developed by the openssl project", "openssl"),
    ("public-domain", 0.8, "(?:released|placed|dedicated) (?:in|into|to) the public domain", "domain"),
    ("public-domain", 0.7, "this (?:work|file|software|document) is in the public domain", "domain"),
    ("cc0-1.0", 0.95, "has waived all copyright and related or neighboring rights", "waived"),
    ("proprietary", 0.6, "all rights reserved", "reserved"),
    ("proprietary", 0.7, "(?:confidential and proprietary|proprietary and confidential)", "proprietary"),
    ("proprietary", 0.8, "unauthori[sz]ed copying of this file (?:via|by) any medium is strictly prohibited", "prohibited"),
    ("proprietary", 0.7, "no part of this (?:publication|book|document|work) may be reproduced", "reproduced"),
    ("proprietary", 0.6, "for (?:personal and )?non ?commercial use only", "only"),
    ("commercial", 0.7, "(?:end user licen[cs]e agreement|commercial licen[cs]e agreement)", "agreement"),
    ("freeware", 0.6, "this (?:program|software) is freeware", "freeware"),
)
BODY_PRIORITY, BASE_PRIORITY, BASE_RELEVANCE = 2, 0, 0.9


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds places; ``gates`` are sets of keywords, of each of which one must occur. A rule of smaller
    ``priority`` is stronger; base rules are those of ``BASE``."""

    label: str
    kind: str
    priority: int
    relevance: float
    pattern: re.Pattern
    gates: tuple[frozenset[str], ...]
    base: bool = False


def _pattern(expression: str) -> re.Pattern:
    return re.compile(f"(?<![^ ])(?:{expression})(?![^ ])".encode())


def _named(label: str, ident: str, names: str, keywords: tuple[str, ...], tail: str = "") -> list[Rule]:
    """The rules of one licence: every wording around its names."""
    end = "(?: licen[cs]e)?" if "licen[cs]e" in names else " licen[cs]e"
    out = []
    for kind, priority, relevance, form, extra in FORMS:
        words = set(ident.replace("(?:", " ").split()[:1]) if kind in ("tag", "url") else keywords
        out.append(Rule(label, kind, priority, relevance, _pattern(form.format(id=ident, name=names, tail=tail, end=end)),
                        (frozenset(words), frozenset(extra.split("|")))))
    return out


def build_rules() -> list[Rule]:
    """All rules in their order: base phrases, families, families with versions, bodies."""
    rules = [Rule(label, "base", BASE_PRIORITY, BASE_RELEVANCE, _pattern(phrase), tuple(frozenset((w,)) for w in phrase.split()), True)
             for phrase, label in BASE]
    for family in FAMILIES:
        rules += _named(*family)
    for stem, names, keywords, versions in GNU:
        for v in versions:
            number = v.removesuffix(" 0")
            version = f"(?: v| version| ver|,)? ?v?{v}|(?: v| version)? ?v?{number}"
            spelled = f"(?:{names})(?: licen[cs]e)?(?:{version})"
            rules += _named(f"{stem}-{v.replace(' ', '.')}-or-later", f"{stem} {v} or later", spelled, keywords, " (?:or|and)(?: at your option)? (?:any )?(?:later|newer)(?: versions?)?")
            rules += _named(f"{stem}-{v.replace(' ', '.')}", f"{stem} {v}(?: only)?", spelled, keywords)
        rules += _named(stem, stem, names, keywords)
    for ident, names in CC:
        label = "cc-" + ident.replace(" ", "-")
        spelled = f"creative commons(?: by)? {names}|cc {ident}"
        for v in CC_VERSIONS:
            rules += _named(f"{label}-{v.replace(' ', '.')}", f"cc {ident} {v}", f"(?:{spelled})(?: licen[cs]e)?(?: {v}|{' ' + v.removesuffix(' 0') if v.endswith(' 0') else ' ' + v})", ("creative", "cc"))
            rules.append(Rule(f"{label}-{v.replace(' ', '.')}", "url", 2, 0.95, _pattern(f"creativecommons org licenses {ident} {v}"), (frozenset(("creativecommons",)),)))
        rules += _named(label, f"cc {ident}", spelled, ("creative", "cc"))
    rules += [Rule(label, "body", BODY_PRIORITY, relevance, _pattern(expression), (frozenset((keyword,)),))
              for label, relevance, expression, keyword in BODIES]
    return rules
