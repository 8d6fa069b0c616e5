"""Signature rules of the license scan, in order of precedence.

A pattern is a regular expression over words: lower-cased words that one
space separates (so "Version 2.0" is ``version 2 0``).  It stands under a
keyword, the start of words that every match of it contains; `` ?`` stands
for words that are also written as one.  Only syntax that Java and RE2 share
is used, without look-around, and repeats have upper bounds.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Levels: 0 a tag or address that names one license, 1 its full name with what
#: tells versions apart, 2 its name alone or its wording, 3 a hint without a name.
CONFIDENCE = (1.0, 0.9, 0.6, 0.3)


LEAD = "(?:(?:is |are )?(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of the )?)?"


@dataclass(frozen=True)
class Signature:
    label: str
    level: int
    keyword: str
    pattern: str
    #: A base phrase stays, whatever contains it.
    base: bool = False

    def regex(self) -> str:
        """For words that have a space of their own on either side; a named rule takes what leads to the name along."""
        lead = LEAD if self.level in (1, 2) and not self.base else ""
        return " " + (f"{lead}(?:{self.pattern})").replace(" ?", "(?: )?").replace(" ", "  ") + " "


#: Identifiers that tags and addresses use; their words are the identifier's letters and digits.
IDENTIFIERS = """
0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 APSL-2.0 Artistic-1.0 Artistic-2.0
BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-ND-4.0 CC-BY-NC-4.0
CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 CC-BY-3.0 CC-BY-SA-3.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPL-1.0 ECL-2.0
EFL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0
GPL-3.0-only GPL-3.0-or-later HPND ISC LGPL-2.0 LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only
LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 ODC-By-1.0
OFL-1.1 OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SISSL SSPL-1.0 Unlicense
UPL-1.0 Vim W3C WTFPL X11 Xnet Zlib ZPL-2.1
""".split()

#: keyword: (label, level, pattern)
NAMED: dict[str, list[tuple[str, int, str]]] = {
    "general public licen": [
        ("agpl-3.0", 1, "gnu affero general public licen[cs]e(?: agpl)?(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?(?:3|v3)(?: 0)?(?: of the license)?(?: or(?: at your option)? any later version)?"),
        ("lgpl-2.0", 1, "gnu library general public licen[cs]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:2|v2)(?: 0)?(?: of the license)?(?: or(?: at your option)? any later version)?"),
        ("lgpl-2.1", 1, "(?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:2 1|v2 1)(?: of the license)?(?: or(?: at your option)? any later version)?"),
        ("lgpl-3.0", 1, "(?:gnu )?lesser general public licen[cs]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:3|v3)(?: 0)?(?: of the license)?(?: or(?: at your option)? any later version)?"),
        ("gpl-1.0", 1, "(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:1|v1)(?: 0)?(?: of the license)?(?: or(?: at your option)? any later version)?"),
        ("gpl-2.0", 1, "(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:2|v2)(?: 0)?(?: of the license)?(?: only)?"),
        ("gpl-2.0-or-later", 1, "(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:2|v2)(?: 0)?(?: of the license)? or(?: at your option)? any later version"),
        ("gpl-3.0", 1, "(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:3|v3)(?: 0)?(?: of the license)?(?: only)?"),
        ("gpl-3.0-or-later", 1, "(?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version)? (?:3|v3)(?: 0)?(?: of the license)? or(?: at your option)? any later version"),
        ("agpl", 2, "(?:gnu )?affero general public licen[cs]e"),
        ("lgpl", 2, "(?:gnu )?(?:lesser|library) general public licen[cs]e"),
        ("gpl", 2, "gnu general public licen[cs]e"),
        ("sspl-1.0", 2, "server side general public licen[cs]e"),
        ("general-public", 3, "general public licen[cs]e"),
    ],
    "server side public licen": [("sspl-1.0", 2, "server side public licen[cs]e(?: version 1| v1)?")],
    "agpl": [("agpl-3.0", 1, "(?:gnu )?agpl(?:v3| v3| 3| version 3)(?: 0)?"), ("agpl", 2, "gnu agpl|agpl licen[cs]ed?")],
    "lgpl": [
        ("lgpl-2.1", 1, "(?:gnu )?lgpl(?:v2| v2| 2| version 2) 1"),
        ("lgpl-3.0", 1, "(?:gnu )?lgpl(?:v3| v3| 3| version 3)(?: 0)?"),
        ("lgpl-2.0", 1, "(?:gnu )?lgpl(?:v2| v2| 2| version 2)(?: 0)?"),
        ("lgpl", 2, "gnu lgpl|lgpl licen[cs]ed?|under (?:the )?(?:terms of the )?lgpl"),
    ],
    "gpl": [
        ("gpl-2.0", 1, "(?:gnu )?gpl(?:v2| v2| 2| version 2)(?: 0)?"),
        ("gpl-3.0", 1, "(?:gnu )?gpl(?:v3| v3| 3| version 3)(?: 0)?"),
        ("gpl", 2, "gnu gpl|gpl licen[cs]ed?|under (?:the )?(?:terms of the )?gpl"),
    ],
    "free documentation licen": [
        ("gfdl-1.1", 1, "(?:gnu )?free documentation licen[cs]e(?: version)? 1 1"),
        ("gfdl-1.2", 1, "(?:gnu )?free documentation licen[cs]e(?: version)? 1 2"),
        ("gfdl-1.3", 1, "(?:gnu )?free documentation licen[cs]e(?: version)? 1 3"),
        ("gfdl", 2, "(?:gnu )?free documentation licen[cs]e"),
    ],
    "mit licen": [
        ("mit", 1, "under(?: the)?(?: terms of the)? mit licen[cs]e"),
        ("mit", 2, "mit licen[cs]ed?"),
        ("mit-0", 1, "mit licen[cs]e no attribution"),
    ],
    "mit no attribution": [("mit-0", 1, "mit no attribution licen[cs]e")],
    "expat licen": [("mit", 2, "(?:the )?expat licen[cs]e")],
    "permission is hereby granted free of charge": [
        ("mit", 1, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        ("mit", 2, "permission is hereby granted free of charge to any person obtaining a copy"),
    ],
    "x11 licen": [("x11", 2, "x11 licen[cs]e")],
    "apache": [
        ("apache-1.0", 1, "apache(?: software)? licen[cs]e(?: version| v)? 1 0"),
        ("apache-1.1", 1, "apache(?: software)? licen[cs]e(?: version| v)? 1 1"),
        ("apache-2.0", 1, "apache(?: software)? licen[cs]e(?: version)? (?:2|v2)(?: 0)?"),
        ("apache-2.0", 1, "apache 2 0 licen[cs]ed?|apache licen[cs]e 2 0|apache 2 licen[cs]ed?|apache v2"),
        ("apache-2.0", 2, "apache 2 0"),
        ("apache", 2, "apache(?: software)? licen[cs]ed?"),
    ],
    "bsd": [
        ("bsd-0", 1, "(?:zero|0) clause bsd(?: licen[cs]e)?|bsd (?:zero|0) clause(?: licen[cs]e)?"),
        ("bsd-1", 1, "(?:one|1) clause bsd(?: licen[cs]e)?|bsd (?:one|1) clause(?: licen[cs]e)?"),
        ("bsd-2", 1, "(?:two|2) clause bsd(?: licen[cs]e)?|bsd (?:two|2) clause(?: licen[cs]e)?|simplified bsd(?: licen[cs]e)?|freebsd licen[cs]e"),
        ("bsd-3", 1, "(?:three|3) clause bsd(?: licen[cs]e)?|bsd (?:three|3) clause(?: licen[cs]e)?|(?:new|modified|revised) bsd licen[cs]e"),
        ("bsd-4", 1, "(?:four|4) clause bsd(?: licen[cs]e)?|bsd (?:four|4) clause(?: licen[cs]e)?|(?:original|old) bsd licen[cs]e"),
        ("bsd", 2, "bsd(?: style)? licen[cs]ed?"),
        ("bsd", 2, "under(?: the)?(?: terms of the)? bsd"),
    ],
    "redistribution and use": [
        ("bsd", 2, "redistribution and use in source and binary forms with or without modification are permitted"),
        ("bsd", 2, "redistribution and use permitted provided that"),
    ],
    "neither the name of": [("bsd-3", 2, "neither the name of(?: [^ ]+){1,12} nor the names of(?: its)? contributors may be used to endorse")],
    "advertising materials mentioning": [("bsd-4", 2, "all advertising materials mentioning features or use of this software must display")],
    "isc licen": [("isc", 2, "isc licen[cs]ed?")],
    "permission to use copy modify": [
        ("isc", 2, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        ("hpnd", 2, "permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted"),
    ],
    "mozilla public licen": [
        ("mpl-1.0", 1, "mozilla public licen[cs]e(?: mpl)?(?: version| v)? 1 0"),
        ("mpl-1.1", 1, "mozilla public licen[cs]e(?: mpl)?(?: version| v)? 1 1"),
        ("mpl-2.0", 1, "mozilla public licen[cs]e(?: mpl)?(?: version| v)? 2(?: 0)?"),
        ("mpl", 2, "mozilla public licen[cs]e"),
    ],
    "mpl": [("mpl-1.1", 1, "mpl(?: version| v)? 1 1"), ("mpl-2.0", 1, "mpl(?: version| v)? 2 0")],
    "eclipse public licen": [
        ("epl-1.0", 1, "eclipse public licen[cs]e(?: epl)?(?: version| v)? (?:1|v1)(?: 0)?"),
        ("epl-2.0", 1, "eclipse public licen[cs]e(?: epl)?(?: version| v)? (?:2|v2)(?: 0)?"),
        ("epl", 2, "eclipse public licen[cs]e"),
    ],
    "eclipse distribution licen": [("bsd-3", 1, "eclipse distribution licen[cs]e(?: version| v)? (?:1|v1)(?: 0)?")],
    "common public licen": [("cpl-1.0", 1, "common public licen[cs]e(?: version| v)? 1(?: 0)?"), ("cpl", 2, "common public licen[cs]e")],
    "ibm public licen": [("ipl-1.0", 2, "ibm public licen[cs]e(?: version 1 0)?")],
    "common development and distribution licen": [
        ("cddl-1.0", 1, "common development and distribution licen[cs]e(?: cddl)?(?: version| v)? 1 0"),
        ("cddl-1.1", 1, "common development and distribution licen[cs]e(?: cddl)?(?: version| v)? 1 1"),
        ("cddl", 2, "common development and distribution licen[cs]e"),
    ],
    "european union public licen": [
        ("eupl-1.1", 1, "european union public licen[cs]e(?: eupl)?(?: version| v)? 1 1"),
        ("eupl-1.2", 1, "european union public licen[cs]e(?: eupl)?(?: version| v)? (?:1 2|v1 2)"),
        ("eupl", 2, "european union public licen[cs]e"),
    ],
    "artistic licen": [
        ("artistic-1.0", 1, "artistic licen[cs]e(?: version| v)? 1(?: 0)?"),
        ("artistic-2.0", 1, "artistic licen[cs]e(?: version| v)? 2(?: 0)?"),
        ("artistic", 2, "(?:perl )?artistic licen[cs]e"),
    ],
    "same terms as perl": [("perl", 2, "under the same terms as perl(?: itself| 5)?")],
    "academic free licen": [("afl-3.0", 1, "academic free licen[cs]e(?: afl)?(?: version| v)? 3 0"), ("afl", 2, "academic free licen[cs]e")],
    "open software licen": [("osl-3.0", 1, "open software licen[cs]e(?: osl)?(?: version| v)? 3 0"), ("osl", 2, "open software licen[cs]e")],
    "boost software licen": [("bsl-1.0", 1, "boost software licen[cs]e(?: version| v)? 1 0"), ("bsl", 2, "boost software licen[cs]e")],
    "business source licen": [("busl-1.1", 1, "business source licen[cs]e(?: version| v)? 1 1"), ("busl", 2, "business source licen[cs]e")],
    "elastic licen": [("elastic-2.0", 1, "elastic licen[cs]e(?: version| v)? ?(?:2|v2)(?: 0)?"), ("elastic", 2, "elastic licen[cs]e")],
    "zlib": [("zlib", 2, "zlib(?: libpng)? licen[cs]ed?|zlib libpng")],
    "this software is provided as is without any express": [("zlib", 2, "this software is provided as is without any express or implied warranty in no event will the authors be held liable")],
    "python software foundation licen": [("psf-2.0", 1, "python software foundation licen[cs]e(?: version| v)? 2(?: 0)?"), ("psf", 2, "python software foundation licen[cs]e")],
    "php licen": [("php-3.0", 1, "php licen[cs]e(?: version| v)? 3 0"), ("php-3.01", 1, "php licen[cs]e(?: version| v)? 3 01"), ("php", 2, "php licen[cs]e")],
    "postgresql licen": [("postgresql", 2, "postgresql licen[cs]e")],
    "openssl licen": [("openssl", 2, "openssl(?: ssleay)? licen[cs]e")],
    "ruby licen": [("ruby", 2, "ruby licen[cs]e")],
    "vim licen": [("vim", 2, "vim licen[cs]e")],
    "w3c software": [("w3c", 2, "w3c software(?: notice and| and document)? licen[cs]e")],
    "university of illinois": [("ncsa", 2, "university of illinois(?: ncsa)? open source licen[cs]e")],
    "educational community licen": [("ecl-2.0", 1, "educational community licen[cs]e(?: version| v)? 2 0"), ("ecl", 2, "educational community licen[cs]e")],
    "universal permissive licen": [("upl-1.0", 2, "universal permissive licen[cs]e(?: version| v)?(?: 1 0)?")],
    "microsoft public licen": [("ms-pl", 2, "microsoft public licen[cs]e(?: ms pl)?")],
    "microsoft reciprocal licen": [("ms-rl", 2, "microsoft reciprocal licen[cs]e(?: ms rl)?")],
    "mulan": [("mulanpsl-2.0", 1, "mulan(?: permissive software licen[cs]e| psl) ?(?:v2|2|version 2)"), ("mulanpsl", 2, "mulan permissive software licen[cs]e")],
    "cecill": [("cecill-2.1", 1, "cecill(?: free software)?(?: licen[cs]e)?(?: version| v)? 2 1"), ("cecill", 2, "cecill(?: [bc])?(?: free software)?(?: licen[cs]e(?: agreement)?)?")],
    "open font licen": [("ofl-1.0", 1, "(?:sil )?open font licen[cs]e(?: version| v)? 1 0"), ("ofl-1.1", 1, "(?:sil )?open font licen[cs]e(?: version| v)? 1 1"), ("ofl", 2, "(?:sil )?open font licen[cs]e")],
    "project public licen": [("lppl-1.3", 1, "latex project public licen[cs]e(?: version| v)? 1 3(?:c)?"), ("lppl", 2, "latex project public licen[cs]e")],
    "q public licen": [("qpl-1.0", 2, "q public licen[cs]e(?: version 1 0)?")],
    "zope public licen": [("zpl-2.1", 1, "zope public licen[cs]e(?: version| v)? 2 1"), ("zpl", 2, "zope public licen[cs]e")],
    "sun industry standards": [("sissl", 2, "sun industry standards source licen[cs]e")],
    "apple public source licen": [("apsl-2.0", 1, "apple public source licen[cs]e(?: version| v)? 2 0"), ("apsl", 2, "apple public source licen[cs]e")],
    "fuck you want to": [("wtfpl", 1, "do what the fuck you want to public licen[cs]e")],
    "wtfpl": [("wtfpl", 2, "wtfpl(?: licen[cs]e)?")],
    "beerware": [("beerware", 2, "beerware licen[cs]ed?|beerware")],
    "unlicense": [("unlicense", 2, "(?:the|under|by) unlicense")],
    "released into the public domain": [("unlicense", 1, "this is free and unencumbered software released into the public domain"), ("public-domain", 2, "released into the public domain")],
    "public domain": [
        ("cc0-1.0", 1, "creative commons(?: cc0)?(?: 1 0)?(?: universal)? public domain dedication"),
        ("pddl-1.0", 1, "open data commons public domain dedication(?: and| &)? licen[cs]e|public domain dedication and licen[cs]e"),
        ("public-domain-mark", 1, "public domain mark(?: 1 0)?"),
        ("public-domain", 2, "(?:is|are|placed|dedicated|donated)(?: [^ ]+){0,2} (?:in|into|to) the public domain"),
        ("public-domain", 3, "public domain"),
    ],
    "cc0": [("cc0-1.0", 1, "cc0 1 0(?: universal)?(?: public domain dedication)?"), ("cc0", 2, "cc0(?: licen[cs]ed?| waiver| dedication)?")],
    "cc by": [
        ("cc-by-nc-nd-4.0", 1, "cc by nc nd(?: v)? 4 0"), ("cc-by-nc-nd-3.0", 1, "cc by nc nd(?: v)? 3 0"), ("cc-by-nc-nd-2.0", 1, "cc by nc nd(?: v)? 2 [05]"),
        ("cc-by-nc-sa-4.0", 1, "cc by nc sa(?: v)? 4 0"), ("cc-by-nc-sa-3.0", 1, "cc by nc sa(?: v)? 3 0"), ("cc-by-nc-sa-2.0", 1, "cc by nc sa(?: v)? 2 [05]"),
        ("cc-by-nc-4.0", 1, "cc by nc(?: v)? 4 0"), ("cc-by-nc-3.0", 1, "cc by nc(?: v)? 3 0"), ("cc-by-nc-2.0", 1, "cc by nc(?: v)? 2 [05]"),
        ("cc-by-nd-4.0", 1, "cc by nd(?: v)? 4 0"), ("cc-by-nd-3.0", 1, "cc by nd(?: v)? 3 0"),
        ("cc-by-sa-4.0", 1, "cc by sa(?: v)? 4 0"), ("cc-by-sa-3.0", 1, "cc by sa(?: v)? 3 0"), ("cc-by-sa-2.0", 1, "cc by sa(?: v)? 2 [05]"),
        ("cc-by-4.0", 1, "cc by(?: v)? 4 0"), ("cc-by-3.0", 1, "cc by(?: v)? 3 0"), ("cc-by-2.0", 1, "cc by(?: v)? 2 [05]"),
        ("cc-by-nc-nd", 2, "cc by nc nd"), ("cc-by-nc-sa", 2, "cc by nc sa"), ("cc-by-nd", 2, "cc by nd"), ("cc-by-sa", 2, "cc by sa"), ("cc-by", 3, "cc by"),
    ],
    "creative commons": [
        ("cc-by-nc-nd-4.0", 1, "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)? 4 0"),
        ("cc-by-nc-sa-4.0", 1, "creative commons attribution non ?commercial share ?alike 4 0"),
        ("cc-by-nc-sa-3.0", 1, "creative commons attribution non ?commercial share ?alike 3 0"),
        ("cc-by-nc-4.0", 1, "creative commons attribution non ?commercial 4 0"),
        ("cc-by-nc-3.0", 1, "creative commons attribution non ?commercial 3 0"),
        ("cc-by-nd-4.0", 1, "creative commons attribution no ?deriv(?:ative)?s?(?: works)? 4 0"),
        ("cc-by-sa-4.0", 1, "creative commons attribution share ?alike 4 0"),
        ("cc-by-sa-3.0", 1, "creative commons attribution share ?alike 3 0"),
        ("cc-by-4.0", 1, "creative commons attribution(?: licen[cs]e)?(?: version)? 4 0"),
        ("cc-by-3.0", 1, "creative commons attribution(?: licen[cs]e)?(?: version)? 3 0"),
        ("cc-by-nc-nd", 2, "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
        ("cc-by-nc-sa", 2, "creative commons attribution non ?commercial share ?alike"),
        ("cc-by-nc", 2, "creative commons attribution non ?commercial"),
        ("cc-by-nd", 2, "creative commons attribution no ?deriv(?:ative)?s?(?: works)?"),
        ("cc-by-sa", 2, "creative commons attribution share ?alike"),
        ("cc-by", 2, "creative commons attribution"),
        ("creative-commons", 3, "creative commons(?: licen[cs]ed?)?"),
    ],
    "creativecommons org": [
        ("cc0-1.0", 0, "creativecommons org publicdomain zero 1 0"),
        ("public-domain-mark", 0, "creativecommons org publicdomain mark 1 0"),
        *((f"cc-{kind.replace(' ', '-')}-{v}", 0, f"creativecommons org licenses {kind} {v.replace('.', ' ')}") for kind in ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd") for v in ("2.0", "2.5", "3.0", "4.0")),
    ],
    "gnu org licenses": [
        ("gpl-2.0", 0, "gnu org licenses(?: old licenses)? gpl 2 0"), ("gpl-3.0", 0, "gnu org licenses gpl 3 0"), ("gpl", 1, "gnu org licenses gpl"),
        ("lgpl-2.1", 0, "gnu org licenses(?: old licenses)? lgpl 2 1"), ("lgpl-3.0", 0, "gnu org licenses lgpl 3 0"), ("lgpl", 1, "gnu org licenses lgpl"),
        ("agpl-3.0", 0, "gnu org licenses agpl 3 0"), ("agpl", 1, "gnu org licenses agpl"), ("gfdl", 1, "gnu org licenses fdl(?: 1 [123])?"),
    ],
    "apache org licenses": [("apache-2.0", 0, "apache org licenses license 2 0"), ("apache-1.1", 0, "apache org licenses license 1 1"), ("apache", 1, "apache org licenses")],
    "mozilla org": [("mpl-2.0", 0, "mozilla org(?: en us)? mpl 2 0"), ("mpl-1.1", 0, "mozilla org(?: en us)? mpl 1 1"), ("mpl", 1, "mozilla org mpl")],
    "open database licen": [("odbl-1.0", 1, "open(?: data commons open)? database licen[cs]e(?: odbl)?(?: version| v)? ?1(?: 0)?"), ("odbl", 2, "open database licen[cs]e")],
    "open data commons attribution": [("odc-by-1.0", 2, "open data commons attribution licen[cs]e(?: version| v)?(?: 1 0)?")],
    "open government licen": [("ogl-3.0", 1, "open government licen[cs]e(?: version| v)? ?(?:3|v3)(?: 0)?"), ("ogl-2.0", 1, "open government licen[cs]e(?: version| v)? ?(?:2|v2)(?: 0)?"), ("ogl", 2, "open government licen[cs]e")],
    "all rights reserved": [("all-rights-reserved", 2, "copyright(?: c)?(?: [0-9]{4}){0,3}(?: [^ ]+){0,6} all rights reserved"), ("all-rights-reserved", 3, "all rights reserved")],
    "proprietary and confidential": [("proprietary", 2, "proprietary and confidential")],
    "non commercial use only": [("non-commercial", 3, "(?:for )?non commercial use only")],
    "see the license": [("unnamed", 3, "see the license(?: file)?(?: for(?: more)? details| for the specific language)")],
    "see license": [("unnamed", 3, "see license(?: [^ ]+){0,3} (?:for details|for more information)")],
    "licensed under": [("unnamed", 3, "(?:is |are )?licensed under")],
}


def signatures() -> list[Signature]:
    """All rules: tags and addresses of the identifiers, then the named ones."""
    found = []
    for name in IDENTIFIERS:
        words = " ".join("".join(c if c.isalnum() else " " for c in name.lower()).split())
        found.append(Signature(name.lower(), 0, "spdx license identifier", f"spdx license identifier {words}"))
        found.append(Signature(name.lower(), 0, "spdx org licenses", f"spdx org licenses {words}"))
        found.append(Signature(name.lower(), 0, "opensource org licen", f"opensource org licen[cs]es? {words}"))
    for keyword, rules in NAMED.items():
        found += [Signature(label, level, keyword, pattern) for label, level, pattern in rules]
    return sorted(found, key=lambda s: s.level)


def phrases(given: dict[str, str]) -> list[Signature]:
    """Base rules from {phrase of plain words: label}; their detections always stay."""
    out = []
    for phrase, label in given.items():
        words = phrase.split()
        if not words or any(not w.isalnum() or w != w.lower() for w in words):
            raise ValueError(f"not a phrase of plain lower-case words: {phrase!r}")
        if any(words[:k] == words[-k:] for k in range(1, len(words))):
            raise ValueError(f"a phrase that can overlap itself: {phrase!r}")
        out.append(Signature(label, 1, phrase, " ".join(words), base=True))
    return out
