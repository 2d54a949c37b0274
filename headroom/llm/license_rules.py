"""Signature rules of the license scan: a table of licenses, and the forms in which texts name them.

Patterns match *word texts*: lower-case words, each followed by one space. The rules are ordered; the
``tier`` of a form says how much it states, and earlier rules come before later ones of the same tier.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    keyword: str
    tier: int
    pattern: str


#: Label, keyword that every text with the license has, names, and words of its identifier.
LICENSES = (
    ("apache-2.0", "apache", r"apache (?:software )?licen[sc]e (?:version |v )?v?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e (?:version |v )?v?1 1", "apache 1 1"),
    ("apache", "apache", r"apache (?:software )?licen[sc]e", "apache"),
    ("mit", "mit", r"(?:mit|expat|x11) licen[sc]e", "mit"),
    ("mit-0", "mit", r"mit (?:no attribution|0) licen[sc]e", "mit 0"),
    ("isc", "isc", r"isc licen[sc]e", "isc"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd)(?: licen[sc]e)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd)(?: licen[sc]e)?", "bsd 4 clause"),
    ("0bsd", "0bsd", r"0bsd licen[sc]e", "0bsd"),
    ("bsd", "bsd", r"bsd (?:style )?licen[sc]e", "bsd"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?3(?: 0)?", "agpl 3 0"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", "agpl"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?2 1", "lgpl 2 1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?3(?: 0)?", "lgpl 3 0"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public licen[sc]e(?: version 2)?", "lgpl 2 0"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e", "lgpl"),
    ("gpl-1.0", "public", r"(?:gnu )?general public licen[sc]e (?:either )?(?:version |v )?v?1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "public", r"(?:gnu )?general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "public", r"(?:gnu )?general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v )?v?3(?: 0)?", "gpl 3 0"),
    ("gpl", "public", r"(?:gnu )?general public licen[sc]e", "gpl"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[sc]e(?: version 1 [123])?", "gfdl"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e (?:version |v )?v?2(?: 0)?", "mpl 2 0"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e (?:version |v )?v?1 1", "mpl 1 1"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "mpl"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e (?:version |v )?v?2(?: 0)?", "epl 2 0"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e (?:version |v )?v?1(?: 0)?", "epl 1 0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "epl"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[sc]e(?: (?:version |v )?v?1(?: 0)?)?", "edl 1 0"),
    ("cddl-1.0", "cddl", r"common development and distribution licen[sc]e(?: cddl)?(?: version 1(?: 0)?)?", "cddl 1 0"),
    ("cpl-1.0", "common", r"common public licen[sc]e(?: version 1(?: 0)?)?", "cpl 1 0"),
    ("eupl-1.2", "european", r"european union public licen[sc]e (?:version |v )?v?1 2", "eupl 1 2"),
    ("eupl", "european", r"european union public licen[sc]e", "eupl"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e (?:version |v )?v?2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", r"artistic licen[sc]e", "artistic"),
    ("boost-1.0", "boost", r"boost software licen[sc]e(?: (?:version |v )?1(?: 0)?)?", "bsl 1 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", "zlib"),
    ("libpng", "libpng", r"libpng licen[sc]e", "libpng"),
    ("unlicense", "unlicense", r"(?:the )?unlicen[sc]e", "unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl(?: licen[sc]e)?", "wtfpl"),
    ("openssl", "openssl", r"openssl licen[sc]e", "openssl"),
    ("python-2.0", "python", r"python software foundation licen[sc]e(?: version 2)?", "python 2 0"),
    ("php-3.01", "php", r"php licen[sc]e(?: version 3 01)?", "php 3 01"),
    ("ruby", "ruby", r"ruby licen[sc]e", "ruby"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", "postgresql"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa (?:open source )?licen[sc]e", "ncsa"),
    ("ofl-1.1", "ofl", r"(?:sil )?open font licen[sc]e(?: ofl)?(?: version 1 1)?", "ofl 1 1"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "ms rl"),
    ("osl-3.0", "open", r"open software licen[sc]e(?: version 3(?: 0)?)?", "osl 3 0"),
    ("afl-3.0", "academic", r"academic free licen[sc]e(?: version 3(?: 0)?)?", "afl 3 0"),
    ("ecl-2.0", "educational", r"educational community licen[sc]e(?: version 2(?: 0)?)?", "ecl 2 0"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database licen[sc]e(?: odbl)?", "odbl 1 0"),
    ("odc-by-1.0", "attribution", r"open data commons attribution licen[sc]e", "odc by 1 0"),
    ("pddl-1.0", "dedication", r"(?:open data commons )?public domain dedication and licen[sc]e", "pddl 1 0"),
    ("busl-1.1", "business", r"business source licen[sc]e(?: 1 1)?", "busl 1 1"),
    ("sspl-1.0", "sspl", r"server side public licen[sc]e(?: sspl)?", "sspl 1 0"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?: 2 0)?", "elastic 2 0"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e", "upl 1 0"),
    ("vim", "vim", r"vim licen[sc]e", "vim"),
    ("w3c", "w3c", r"w3c software (?:notice and )?licen[sc]e", "w3c"),
    ("blueoak-1.0.0", "blue", r"blue oak model licen[sc]e", "blueoak 1 0 0"),
    ("mulan-psl-2.0", "mulan", r"mulan (?:permissive software|psl) licen[sc]e", "mulanpsl 2 0"),
)
#: The parts of a Creative Commons name and their label.
CC_PARTS = (
    ("cc-by-nc-nd", r"(?:by nc nd|attribution non ?commercial no ?deriv(?:ative|s|ative works)?)"),
    ("cc-by-nc-sa", r"(?:by nc sa|attribution non ?commercial share ?alike)"),
    ("cc-by-nc", r"(?:by nc|attribution non ?commercial)"),
    ("cc-by-nd", r"(?:by nd|attribution no ?deriv(?:ative|s|ative works)?)"),
    ("cc-by-sa", r"(?:by sa|attribution share ?alike)"),
    ("cc-by", r"(?:by|attribution)"),
)
CC_VERSIONS = ("4 0", "3 0", "2 5", "2 0", "1 0")
GRANT = r"(?:licen[sc]ed|released|distributed|available|provided|published|redistributed|shared|made available) (?:to you )?(?:under|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
#: Wordings that state rights without naming a license.
NOTICES = (
    ("public-domain", "domain", r"(?:placed in|dedicated to|released into|is in) the public domain"),
    ("public-domain", "domain", r"public domain"),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?"),
    ("copyright", "copyright", r"copyright (?:holders?|owners?|notice)"),
    ("reserved", "rights", r"some rights reserved"),
    ("reserved", "rights", r"all rights reserved"),
    ("proprietary", "proprietary", r"proprietary and confidential"),
    ("proprietary", "reproduction", r"unauthori[sz]ed (?:copying|reproduction|distribution)(?: or (?:copying|reproduction|distribution))?"),
    ("proprietary", "prohibited", r"(?:copying|reproduction|redistribution) (?:is )?(?:strictly )?prohibited"),
    ("permissive", "permission", r"permission is hereby granted free of charge"),
    ("permissive", "permission", r"permission to use copy modify and(?: or)? distribute this software"),
    ("permissive", "redistribution", r"redistribution and use in source and binary forms"),
    ("no-warranty", "warranty", r"without warranty of any kind"),
    ("no-warranty", "warranty", r"without any warranty"),
    ("no-warranty", "warranties", r"without warranties or conditions of any kind"),
    ("unknown-license", "license", r"(?:licen[sc]ed|released|distributed) under (?:the )?(?:terms of )?(?:the |this |a )?licen[sc]e"),
    ("unknown-license", "license", r"see (?:the )?(?:accompanying )?licen[sc]e(?: file)?(?: for (?:more )?(?:details|information))?"),
    ("unknown-license", "licence", r"see (?:the )?(?:accompanying )?licen[sc]e(?: file)?"),
)
#: Every match of a rule holds one of these strings.
CUES = (
    "licen", "spdx ", "under ", "subject to ", "cc ", "cc0 ", "creative commons ", "public domain ", "copyright ", "rights reserved ", "proprietary ",
    "unauthori", "prohibited ", "permission ", "redistribution ", "warrant", "bsd", "wtfpl ",
)
#: How much a surviving detection of a tier says: an identifier, a grant by name, a name, a notice.
TIER_WEIGHTS = (0.95, 0.9, 0.7, 0.3)


def rules() -> list[Rule]:
    """All signature rules in order: identifiers, grants that name a license, names, notices."""
    out = [Rule(label, "spdx", 0, rf"spdx licen[sc]e identifier {words}(?: only| or later)?") for label, _, _, words in LICENSES]
    out += [Rule(label, words.split()[0], 1, GRANT + rf"{words}(?: only| or later)?") for label, _, _, words in LICENSES if words.split()[0] not in ("open", "public")]
    out += [Rule(label, keyword, 1, GRANT + names) for label, keyword, names, _ in LICENSES]
    out += [Rule(label, keyword, 2, names) for label, keyword, names, _ in LICENSES]
    for label, parts in CC_PARTS:
        for version in CC_VERSIONS:
            name = f"{label}-{version.replace(' ', '.')}"
            out.append(Rule(name, "spdx", 0, rf"spdx licen[sc]e identifier cc {label[3:].replace('-', ' ')} {version}"))
            for keyword, lead in (("cc", "cc"), ("creative", "creative commons")):
                out.append(Rule(name, keyword, 1, rf"{GRANT}(?:an? )?{lead} {parts} (?:licen[sc]e )?(?:international |unported )?(?:version |v )?{version}"))
                out.append(Rule(name, keyword, 2, rf"{lead} {parts} (?:licen[sc]e )?(?:version |v )?{version}"))
        out += [Rule(label, keyword, 2, rf"{lead} {parts}(?: licen[sc]e)?") for keyword, lead in (("cc", "cc"), ("creative", "creative commons"))]
    out += [Rule("cc0-1.0", "cc0", tier, pattern) for tier, pattern in ((1, GRANT + r"cc0(?: 1 0)?"), (2, r"cc0(?: 1 0)?"))]
    out += [Rule(label, keyword, 3, pattern) for label, keyword, pattern in NOTICES]
    return sorted(out, key=lambda r: r.tier)
