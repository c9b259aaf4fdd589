"""Signature rules of licenses, highest priority first.

A rule is a keyword that a text must hold before its pattern runs, a pattern over lower-case words joined by
single blanks (a blank on either side of the text), a label, and a priority. Patterns are written per license
family below; families with versions get one rule per version and form of naming it.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    keyword: str
    pattern: str
    label: str
    priority: int


# Label stem, ways to name the license, versions. Words only: marks count as blanks, so
# "version 2.0" reads "version 2 0" and "CC BY-NC" reads "cc by nc".
FAMILIES = [
    ("agpl", ["gnu affero general public licen[sc]e", "affero general public licen[sc]e", "gnu agpl"], ["1", "3"]),
    ("lgpl", ["gnu lesser general public licen[sc]e", "lesser general public licen[sc]e", "gnu library general public licen[sc]e", "gnu lgpl"], ["2", "2.1", "3"]),
    ("gpl", ["gnu general public licen[sc]e", "gnu gpl"], ["1", "2", "3"]),
    ("gfdl", ["gnu free documentation licen[sc]e", "gnu fdl"], ["1.1", "1.2", "1.3"]),
    ("apache", ["apache licen[sc]e", "apache software licen[sc]e"], ["1.0", "1.1", "2.0"]),
    ("mpl", ["mozilla public licen[sc]e"], ["1.0", "1.1", "2.0"]),
    ("epl", ["eclipse public licen[sc]e"], ["1.0", "2.0"]),
    ("cddl", ["common development and distribution licen[sc]e"], ["1.0", "1.1"]),
    ("cpl", ["common public licen[sc]e"], ["0.5", "1.0"]),
    ("eupl", ["european union public licen[sc]e"], ["1.0", "1.1", "1.2"]),
    ("osl", ["open software licen[sc]e"], ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", ["academic free licen[sc]e"], ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("artistic", ["artistic licen[sc]e"], ["1.0", "2.0"]),
    ("bsl", ["boost software licen[sc]e"], ["1.0"]),
    ("php", ["php licen[sc]e"], ["3.0", "3.01"]),
    ("psf", ["python software foundation licen[sc]e", "psf licen[sc]e"], ["2"]),
    ("zpl", ["zope public licen[sc]e"], ["1.1", "2.0", "2.1"]),
    ("lppl", ["latex project public licen[sc]e"], ["1.0", "1.1", "1.2", "1.3"]),
    ("ms-pl", ["microsoft public licen[sc]e"], []),
    ("ms-rl", ["microsoft reciprocal licen[sc]e"], []),
    ("qpl", ["q public licen[sc]e"], ["1.0"]),
    ("upl", ["universal permissive licen[sc]e"], ["1.0"]),
    ("ofl", ["sil open font licen[sc]e", "open font licen[sc]e"], ["1.0", "1.1"]),
    ("odbl", ["open database licen[sc]e", "open data commons open database licen[sc]e"], ["1.0"]),
    ("odc-by", ["open data commons attribution licen[sc]e"], ["1.0"]),
    ("ogl", ["open government licen[sc]e"], ["1.0", "2.0", "3.0"]),
    ("cecill", ["cecill", "cecill free software licen[sc]e agreement"], ["1.0", "1.1", "2.0", "2.1"]),
    ("bsd-4-clause", ["bsd 4 clause(?: original)?(?: licen[sc]e)?", "original bsd licen[sc]e"], []),
    ("bsd-3-clause", ["bsd 3 clause(?: licen[sc]e)?", "(?:new|modified|revised) bsd licen[sc]e", "3 clause bsd(?: licen[sc]e)?"], []),
    ("bsd-2-clause", ["bsd 2 clause(?: licen[sc]e)?", "simplified bsd licen[sc]e", "freebsd licen[sc]e", "2 clause bsd(?: licen[sc]e)?"], []),
    ("bsd", ["bsd style licen[sc]e", "bsd licen[sc]e"], []),
    ("mit", ["the mit licen[sc]e", "mit licen[sc]e", "expat licen[sc]e", "licensed under mit"], []),
    ("x11", ["x11 licen[sc]e", "mit x11 licen[sc]e"], []),
    ("isc", ["isc licen[sc]e", "internet systems consortium licen[sc]e"], []),
    ("zlib", ["zlib licen[sc]e", "zlib libpng licen[sc]e"], []),
    ("libpng", ["libpng licen[sc]e"], []),
    ("unlicense", ["the unlicense", "unlicense org"], []),
    ("wtfpl", ["do what the fuck you want to public licen[sc]e", "wtfpl"], ["1", "2"]),
    ("json", ["json licen[sc]e", "shall be used for good not evil"], []),
    ("postgresql", ["postgresql licen[sc]e"], []),
    ("openssl", ["openssl licen[sc]e"], []),
    ("ncsa", ["university of illinois ncsa open source licen[sc]e", "ncsa licen[sc]e"], []),
    ("sleepycat", ["sleepycat licen[sc]e"], []),
    ("vim", ["vim licen[sc]e"], []),
    ("ruby", ["ruby licen[sc]e", "same terms as ruby"], []),
    ("perl", ["same terms as perl itself", "same terms as perl"], []),
    ("sspl", ["server side public licen[sc]e"], ["1"]),
    ("busl", ["business source licen[sc]e"], ["1.1"]),
    ("elastic", ["elastic licen[sc]e"], ["1.0", "2.0"]),
    ("commons-clause", ["commons clause"], []),
    ("polyform", ["polyform (?:noncommercial|small business|strict|shield) licen[sc]e"], ["1.0.0"]),
    ("openrail", ["(?:big ?science|creative ?ml) open ?rail(?: m)? licen[sc]e", "open rail m licen[sc]e"], []),
    ("llama", ["llama [23] community licen[sc]e"], []),
    ("public-domain", ["(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain dedication", "is in the public domain"], []),
]

# Creative Commons elements by name and by code, versions.
CC_ELEMENTS = [
    ("cc-by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?", "by nc nd"),
    ("cc-by-nc-sa", "attribution non ?commercial share ?alike", "by nc sa"),
    ("cc-by-nc", "attribution non ?commercial", "by nc"),
    ("cc-by-nd", "attribution no ?deriv(?:ative)?s?", "by nd"),
    ("cc-by-sa", "attribution share ?alike", "by sa"),
    ("cc-by", "attribution", "by"),
]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# Sentences of license texts and notices without a license name: keyword, pattern, label, priority.
SENTENCES = [
    ("permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", "mit", 70),
    ("without restriction", "to deal in the software without restriction including without limitation", "mit", 70),
    ("above copyright notice", "the above copyright notice and this permission notice shall be included", "mit", 70),
    ("redistribution", "redistribution and use in source and binary forms with or without modification are permitted", "bsd", 70),
    ("neither the name", "neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors", "bsd-3-clause", 72),
    ("advertising materials", "all advertising materials mentioning features or use of this software", "bsd-4-clause", 72),
    ("with or without fee", "permission to use copy modify and or distribute this software for any purpose with or without fee", "isc", 72),
    ("altered source", "altered source versions must be plainly marked as such", "zlib", 72),
    ("misrepresented", "the origin of this software must not be misrepresented", "zlib", 72),
    ("free software foundation", "as published by the free software foundation", "gnu", 60),
    ("later version", "(?:either )?version [0-9](?: [0-9])? (?:of the licen[sc]e )?or at your option any later version", "or-later", 55),
    ("only version", "only version [0-9](?: [0-9])? of the licen[sc]e", "only", 55),
    ("warranty", "without warranty of any kind(?: express or implied)?", "no-warranty", 40),
    ("as is", "(?:is )?provided as is", "no-warranty", 40),
    ("merchantability", "warranties of merchantability", "no-warranty", 40),
    ("compliance with the licen", "you may not use this file except in compliance with the licen[sc]e", "apache-2.0", 75),
    ("licenses license", "www apache org licenses license 2 0", "apache-2.0", 85),
    ("gnu org licenses", "www gnu org licenses(?: (?:gpl|lgpl|agpl)(?: [0-9](?: [0-9])?)?)?", "gnu", 62),
    ("opensource org", "opensource org licenses [a-z0-9]+", "osi", 50),
    ("creativecommons org", "creativecommons org licenses (?:by|nc|nd|sa)(?: (?:nc|nd|sa))*", "cc", 52),
    ("publicdomain", "creativecommons org publicdomain zero 1 0", "cc0-1.0", 85),
    ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0-1.0", 84),
    ("creative commons", "creative commons(?: licen[sc]e)?", "cc", 30),
    ("spdx", "spdx licen[sc]e identifier [^ ]+", "spdx", 45),
    ("licensed under", "(?:is |are )?licensed under the terms of", "licensed", 20),
    ("proprietary", "proprietary and confidential", "proprietary", 66),
    ("unauthorized", "unauthorized (?:copying|reproduction|distribution|use)(?: [^ ]+){0,6} (?:is )?(?:strictly )?prohibited", "proprietary", 66),
    ("prior written", "without (?:the )?(?:express )?prior written (?:permission|consent)", "proprietary", 58),
    ("copyright", "copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})*", "copyright", 25),
    ("copyright", "copyright c", "copyright", 24),
    ("trademark", "(?:is a |are )?(?:registered )?trademarks? of", "trademark", 22),
    ("all rights reserved", "all rights reserved", "reserved", 35),
    ("some rights reserved", "some rights reserved", "cc", 33),
    ("no rights reserved", "no rights reserved", "public-domain", 36),
    ("general public license", "general public license", "gpl", 48),
    ("cc by", "cc by", "cc-by", 47),
]


def _keyword(name: str) -> str:
    """The longest plain run of a pattern, cut at its words."""
    runs, run = [], ""
    depth = 0
    for i, c in enumerate(name):
        depth += (c in "([") - (c in ")]")
        plain = depth == 0 and c not in ")]?" and name[i + 1:i + 2] not in ("?", "*", "{", "+")
        run = run + c if plain else (runs.append(run) or "")
    return max([*runs, run], key=len).strip()


def _spelled(version: str) -> str:
    return version.replace(".", " ")


def build_rules() -> list[Rule]:
    """All rules, by falling priority, then in the order written."""
    rules = []
    for stem, names, versions in FAMILIES:
        for n, name in enumerate(names):
            rules.append(Rule(_keyword(name), name, stem, 60 - n))
            for version in versions:
                said = _spelled(version)
                if said.endswith(" 0"):
                    said = f"{said[:-2]}(?: 0)?"
                rules.append(Rule(_keyword(name), f"{name} (?:version |v ?)?{said}(?! [0-9])", f"{stem}-{version}", 80 - n))
                rules.append(Rule(_keyword(name), f"version {said} of the {name}", f"{stem}-{version}", 80 - n))
        for version in versions:
            code = _spelled(stem).replace("-", " ")
            rules.append(Rule(code, f"{code} ?v?{_spelled(version)}(?: only| or later)?(?! [0-9])", f"{stem}-{version}", 78))
    for label, named, code in CC_ELEMENTS:
        tail = "(?! (?:nc|nd|sa|non|no|share))"
        rules.append(Rule("creative commons", f"creative commons {named}(?: licen[sc]e)?{tail}", label, 64))
        rules.append(Rule("cc by", f"cc {code}{tail}", label, 63))
        for version in CC_VERSIONS:
            said = _spelled(version)
            rules.append(Rule("creative commons", f"creative commons {named} {said}(?: (?:international|unported|generic))?(?: licen[sc]e)?", f"{label}-{version}", 82))
            rules.append(Rule("cc by", f"cc {code} {said}", f"{label}-{version}", 82))
    rules += [Rule(*x) for x in SENTENCES]
    rules = [r._replace(keyword=" " + r.keyword) if r.pattern.startswith(r.keyword) else r for r in rules]
    return sorted(rules, key=lambda r: -r.priority)
