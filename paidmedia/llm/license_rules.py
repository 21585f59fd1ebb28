"""Signature rules for license texts, in the order of their priority.

Fixed values: names of public licenses, their SPDX identifiers, the words of their usual
notices, their addresses and their short forms.  Each license gives a name signature by
hand; identifier, operand and grant signatures follow from it by rule.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    rule: int
    label: str
    #: 0 binds most: identifier, grant, notice, name, address, mention.
    priority: int
    confidence: float
    #: Lower-case texts of which one has to be there before the signature is tried.
    keywords: tuple[str, ...]
    signature: str


#: Any characters up to the sentence's end.  A period ends it unless it is within a word, a
#: small letter follows or an initial or a company's form precedes; 50 such are passed, as
#: the engine's stack grows with them.
GAP = (
    r"[^.]*?(?:(?:\.(?=[^\s.]|[\s*#/;-]+(?-i:[a-z]))|(?:(?<=\b[a-z])|(?<=\bco)|(?<=\binc)|(?<=\bltd)|(?<=\bcorp))\.)"
    r"[^.]*?){0,50}?"
)
V = r"[,;]?\s+(?:version\s+|v\.?\s*|v)?"
#: (SPDX identifier, keywords, signature of the name)
NAMES = [
    ("AFL-3.0", "academic", rf"academic\s+free\s+licen[sc]e{V}3(?:\.0)?"),
    ("AGPL-1.0", "affero", rf"affero\s+(?:gnu\s+)?general\s+public\s+licen[sc]e{V}1(?:\.0)?"),
    ("AGPL-3.0", "affero", rf"(?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e{V}3(?:\.0)?"),
    ("Apache-1.0", "apache", rf"apache\s+(?:software\s+)?licen[sc]e{V}1\.0"),
    ("Apache-1.1", "apache", rf"apache\s+(?:software\s+)?licen[sc]e{V}1\.1"),
    ("Apache-2.0", "apache", rf"apache\s+(?:software\s+)?licen[sc]e{V}2(?:\.0)?"),
    ("APSL-2.0", "apple", rf"apple\s+public\s+source\s+licen[sc]e{V}2(?:\.0)?"),
    ("Artistic-1.0", "artistic", rf"artistic\s+licen[sc]e{V}1(?:\.0)?"),
    ("Artistic-2.0", "artistic", rf"artistic\s+licen[sc]e{V}2(?:\.0)?"),
    ("0BSD", "bsd", r"(?:zero[- ]clause\s+bsd|bsd\s+zero[- ]clause|0[- ]?bsd)(?:\s+licen[sc]e)?"),
    ("BSD-1-Clause", "bsd", r"(?:1|one)[- ]clause\s+bsd\s+licen[sc]e"),
    ("BSD-2-Clause", "bsd", r"(?:(?:2|two)[- ]clause|simplified|freebsd)\s+bsd\s+licen[sc]e"),
    ("BSD-3-Clause", "bsd", r"(?:(?:3|three)[- ]clause|new|revised|modified)\s+bsd\s+licen[sc]e"),
    ("BSD-4-Clause", "bsd", r"(?:(?:4|four)[- ]clause|original|old)\s+bsd\s+licen[sc]e"),
    ("BSL-1.0", "boost", rf"boost\s+software\s+licen[sc]e(?:{V}1(?:\.0)?)?"),
    ("BUSL-1.1", "business", rf"business\s+source\s+licen[sc]e(?:{V}1\.1)?"),
    ("CAL-1.0", "cryptographic", rf"cryptographic\s+autonomy\s+licen[sc]e(?:{V}1(?:\.0)?)?"),
    ("CC0-1.0", "cc0|cc 0|cc-0|creative commons zero", r"(?:creative\s+commons\s+zero|cc[- ]?0)(?:\s+(?:v\s*)?1\.0)?(?:\s+universal)?"),
    ("CC-BY-1.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by|creative\s+commons\s+attribution)[- ](?:v\s*)?1\.0"),
    ("CC-BY-2.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by|creative\s+commons\s+attribution)[- ](?:v\s*)?2\.0"),
    ("CC-BY-2.5", "cc by|cc-by|creative commons", r"(?:cc[- ]by|creative\s+commons\s+attribution)[- ](?:v\s*)?2\.5"),
    ("CC-BY-3.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by|creative\s+commons\s+attribution)[- ](?:v\s*)?3\.0"),
    ("CC-BY-4.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by|creative\s+commons\s+attribution)[- ](?:v\s*)?4\.0"),
    ("CC-BY-SA-2.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]sa|creative\s+commons\s+attribution[- ]share[- ]?alike)[- ](?:v\s*)?2\.0"),
    ("CC-BY-SA-2.5", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]sa|creative\s+commons\s+attribution[- ]share[- ]?alike)[- ](?:v\s*)?2\.5"),
    ("CC-BY-SA-3.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]sa|creative\s+commons\s+attribution[- ]share[- ]?alike)[- ](?:v\s*)?3\.0"),
    ("CC-BY-SA-4.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]sa|creative\s+commons\s+attribution[- ]share[- ]?alike)[- ](?:v\s*)?4\.0"),
    ("CC-BY-ND-3.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nd|creative\s+commons\s+attribution[- ]no[- ]?derivatives)[- ](?:v\s*)?3\.0"),
    ("CC-BY-ND-4.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nd|creative\s+commons\s+attribution[- ]no[- ]?derivatives)[- ](?:v\s*)?4\.0"),
    ("CC-BY-NC-2.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nc|creative\s+commons\s+attribution[- ]non[- ]?commercial)[- ](?:v\s*)?2\.0"),
    ("CC-BY-NC-3.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nc|creative\s+commons\s+attribution[- ]non[- ]?commercial)[- ](?:v\s*)?3\.0"),
    ("CC-BY-NC-4.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nc|creative\s+commons\s+attribution[- ]non[- ]?commercial)[- ](?:v\s*)?4\.0"),
    ("CC-BY-NC-SA-3.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nc[- ]sa|creative\s+commons\s+attribution[- ]non[- ]?commercial[- ]share[- ]?alike)[- ](?:v\s*)?3\.0"),
    ("CC-BY-NC-SA-4.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nc[- ]sa|creative\s+commons\s+attribution[- ]non[- ]?commercial[- ]share[- ]?alike)[- ](?:v\s*)?4\.0"),
    ("CC-BY-NC-ND-4.0", "cc by|cc-by|creative commons", r"(?:cc[- ]by[- ]nc[- ]nd|creative\s+commons\s+attribution[- ]non[- ]?commercial[- ]no[- ]?derivatives)[- ](?:v\s*)?4\.0"),
    ("CDDL-1.0", "common development", rf"common\s+development\s+and\s+distribution\s+licen[sc]e(?:{V}1\.0)?"),
    ("CDDL-1.1", "common development", rf"common\s+development\s+and\s+distribution\s+licen[sc]e{V}1\.1"),
    ("CECILL-2.1", "cecill", r"cecill(?:[- ](?:v\s*)?2\.1)?"),
    ("CPAL-1.0", "common public", r"common\s+public\s+attribution\s+licen[sc]e"),
    ("CPL-1.0", "common public", rf"common\s+public\s+licen[sc]e(?:{V}1\.0)?"),
    ("ECL-2.0", "educational", rf"educational\s+community\s+licen[sc]e(?:{V}2\.0)?"),
    ("Elastic-2.0", "elastic", rf"elastic\s+licen[sc]e(?:{V}2\.0)?"),
    ("EPL-1.0", "eclipse", rf"eclipse\s+public\s+licen[sc]e{V}1(?:\.0)?"),
    ("EPL-2.0", "eclipse", rf"eclipse\s+public\s+licen[sc]e{V}2(?:\.0)?"),
    ("EUPL-1.1", "european", rf"european\s+union\s+public\s+licen[sc]e{V}1\.1"),
    ("EUPL-1.2", "european", rf"european\s+union\s+public\s+licen[sc]e{V}1\.2"),
    ("GFDL-1.2", "free documentation", rf"(?:gnu\s+)?free\s+documentation\s+licen[sc]e{V}1\.2"),
    ("GFDL-1.3", "free documentation", rf"(?:gnu\s+)?free\s+documentation\s+licen[sc]e{V}1\.3"),
    ("GPL-1.0", "general public", rf"(?:gnu\s+)?general\s+public\s+licen[sc]e{V}1(?:\.0)?"),
    ("GPL-2.0", "general public", rf"(?:gnu\s+)?general\s+public\s+licen[sc]e{V}2(?:\.0)?"),
    ("GPL-3.0", "general public", rf"(?:gnu\s+)?general\s+public\s+licen[sc]e{V}3(?:\.0)?"),
    ("HPND", "historical", r"historical\s+permission\s+notice\s+and\s+disclaimer"),
    ("IJG", "jpeg group", r"independent\s+jpeg\s+group\s+licen[sc]e"),
    ("IPL-1.0", "ibm", rf"ibm\s+public\s+licen[sc]e(?:{V}1\.0)?"),
    ("ISC", "isc licen", r"\bisc\s+licen[sc]e"),
    ("JSON", "json licen", r"json\s+licen[sc]e"),
    ("LGPL-2.0", "library general", rf"(?:gnu\s+)?library\s+general\s+public\s+licen[sc]e(?:{V}2(?:\.0)?)?"),
    ("LGPL-2.1", "lesser general", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e{V}2\.1"),
    ("LGPL-3.0", "lesser general", rf"(?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e{V}3(?:\.0)?"),
    ("LPPL-1.3c", "latex", rf"latex\s+project\s+public\s+licen[sc]e(?:{V}1\.3c?)?"),
    ("MIT-0", "mit no attribution", r"mit\s+no\s+attribution(?:\s+licen[sc]e)?"),
    ("MIT", "mit licen", r"\bmit\s+licen[sc]e"),
    ("MPL-1.0", "mozilla", rf"mozilla\s+public\s+licen[sc]e{V}1\.0"),
    ("MPL-1.1", "mozilla", rf"mozilla\s+public\s+licen[sc]e{V}1\.1"),
    ("MPL-2.0", "mozilla", rf"mozilla\s+public\s+licen[sc]e{V}2(?:\.0)?"),
    ("MS-PL", "microsoft", r"microsoft\s+public\s+licen[sc]e"),
    ("MS-RL", "microsoft", r"microsoft\s+reciprocal\s+licen[sc]e"),
    ("NCSA", "ncsa", r"(?:university\s+of\s+illinois/?\s*)?ncsa\s+(?:open\s+source\s+)?licen[sc]e"),
    ("ODbL-1.0", "database licen", rf"open\s+(?:data\s+commons\s+open\s+)?database\s+licen[sc]e(?:{V}1\.0)?"),
    ("ODC-By-1.0", "open data commons", r"open\s+data\s+commons\s+attribution\s+licen[sc]e"),
    ("OFL-1.1", "open font licen", rf"(?:sil\s+)?open\s+font\s+licen[sc]e(?:{V}1\.1)?"),
    ("OLDAP-2.8", "openldap", r"openldap\s+public\s+licen[sc]e"),
    ("OpenSSL", "openssl", r"openssl\s+licen[sc]e"),
    ("OSL-3.0", "open software licen", rf"open\s+software\s+licen[sc]e(?:{V}3\.0)?"),
    ("PDDL-1.0", "public domain", r"(?:open\s+data\s+commons\s+)?public\s+domain\s+dedication\s+and\s+licen[sc]e"),
    ("PHP-3.01", "php licen", rf"php\s+licen[sc]e(?:{V}3\.01)?"),
    ("PostgreSQL", "postgresql", r"postgresql\s+licen[sc]e"),
    ("PSF-2.0", "python software", rf"python\s+software\s+foundation\s+licen[sc]e(?:{V}2(?:\.0)?)?"),
    ("QPL-1.0", "q public licen", rf"\bq\s+public\s+licen[sc]e(?:{V}1\.0)?"),
    ("RPL-1.5", "reciprocal", rf"reciprocal\s+public\s+licen[sc]e(?:{V}1\.5)?"),
    ("Ruby", "ruby licen", r"ruby\s+licen[sc]e"),
    ("SSPL-1.0", "server side", rf"server\s+side\s+public\s+licen[sc]e(?:{V}1(?:\.0)?)?"),
    ("Sleepycat", "sleepycat", r"sleepycat\s+(?:public\s+)?licen[sc]e"),
    ("Unicode-3.0", "unicode", r"unicode\s+licen[sc]e(?:\s+agreement)?"),
    ("Unlicense", "unlicense|unlicence", r"\bthe\s+unlicen[sc]e"),
    ("UPL-1.0", "universal permissive", r"universal\s+permissive\s+licen[sc]e"),
    ("Vim", "vim licen", r"\bvim\s+licen[sc]e"),
    ("W3C", "w3c", r"w3c\s+(?:software\s+(?:notice\s+and\s+)?)?licen[sc]e"),
    ("WTFPL", "you want to public licen", r"do\s+what\s+the\s+f\S+\s+you\s+want\s+to\s+public\s+licen[sc]e"),
    ("X11", "x11 licen", r"\bx11\s+licen[sc]e"),
    ("Zlib", "zlib", r"zlib(?:/libpng)?\s+licen[sc]e"),
    ("ZPL-2.1", "zope", rf"zope\s+public\s+licen[sc]e(?:{V}2\.1)?"),
]

#: Between a short form and its version, and what may follow it.
S = r"(?:,\s+|\s+|-)?(?:version\s+|v\.?\s*)?"
O = r"(?:\.0)?(?:\+|-only|-or-later)?"


def short(name: str, version: str) -> str:
    """Keywords of ``name``, ``S`` and a version: one of them is in every such text."""
    return "|".join(f"{name}{between}{first}" for between in ("", " ", "-", ", ") for first in (version[0], "v"))


#: (SPDX identifier, keywords, signature): short forms, version suffixes, reversed order.
SHORT_FORMS = [
    ("AFL-3.0", short("afl", "3"), rf"\bafl{S}3{O}"),
    ("AGPL-1.0", short("agpl", "1"), rf"\bagpl{S}1{O}"),
    ("AGPL-3.0", short("agpl", "3"), rf"\bagpl{S}3{O}"),
    ("Apache-1.1", short("apache", "1"), rf"\bapache{S}1\.1(?:\s+licen[sc]ed?)?"),
    ("Apache-2.0", short("apache", "2"), rf"\bapache{S}2\.0(?:\s+licen[sc]ed?)?"),
    ("Apache-2.0", short("apache", "2"), rf"\bapache{S}2\s+licen[sc]ed?"),
    ("Apache-2.0", short("asl", "2"), rf"\basl{S}2\.0"),
    ("APSL-2.0", short("apsl", "2"), rf"\bapsl{S}2{O}"),
    ("Artistic-1.0", short("artistic", "1"), rf"\bartistic{S}1{O}"),
    ("Artistic-2.0", short("artistic", "2"), rf"\bartistic{S}2{O}"),
    ("BSD-1-Clause", "bsd", r"\bbsd[\s-]+(?:1|one)[\s-]+clause(?:\s+licen[sc]ed?)?"),
    ("BSD-2-Clause", "bsd", r"\bbsd[\s-]+(?:2|two)[\s-]+clause(?:\s+licen[sc]ed?)?"),
    ("BSD-3-Clause", "bsd", r"\bbsd[\s-]+(?:3|three)[\s-]+clause(?:\s+licen[sc]ed?)?"),
    ("BSD-4-Clause", "bsd", r"\bbsd[\s-]+(?:4|four)[\s-]+clause(?:\s+licen[sc]ed?)?"),
    ("BSD-2-Clause", "bsd", r"(?:\b2|\btwo)[\s-]+clause\s+bsd"),
    ("BSD-3-Clause", "bsd", r"(?:\b3|\bthree)[\s-]+clause\s+bsd"),
    ("BSD-4-Clause", "bsd", r"(?:\b4|\bfour)[\s-]+clause\s+bsd"),
    ("BSL-1.0", short("bsl", "1"), rf"\bbsl{S}1\.0"),
    ("BUSL-1.1", short("busl", "1"), rf"\bbusl{S}1\.1"),
    ("CDDL-1.0", short("cddl", "1"), rf"\bcddl{S}1\.0"),
    ("CDDL-1.1", short("cddl", "1"), rf"\bcddl{S}1\.1"),
    ("CPL-1.0", short("cpl", "1"), rf"\bcpl{S}1\.0"),
    ("ECL-2.0", short("ecl", "2"), rf"\becl{S}2\.0"),
    ("EPL-1.0", short("epl", "1"), rf"\bepl{S}1{O}"),
    ("EPL-2.0", short("epl", "2"), rf"\bepl{S}2{O}"),
    ("EUPL-1.1", short("eupl", "1"), rf"\beupl{S}1\.1"),
    ("EUPL-1.2", short("eupl", "1"), rf"\beupl{S}1\.2"),
    ("GFDL-1.2", short("fdl", "1"), rf"\bg?fdl{S}1\.2{O}"),
    ("GFDL-1.3", short("fdl", "1"), rf"\bg?fdl{S}1\.3{O}"),
    ("GPL-1.0", short("gpl", "1"), rf"\bgpl{S}1{O}"),
    ("GPL-2.0", short("gpl", "2"), rf"\bgpl{S}2{O}"),
    ("GPL-3.0", short("gpl", "3"), rf"\bgpl{S}3{O}"),
    ("LGPL-2.0", short("lgpl", "2"), rf"\blgpl{S}2{O}"),
    ("LGPL-2.1", short("lgpl", "2"), rf"\blgpl{S}2\.1{O}"),
    ("LGPL-3.0", short("lgpl", "3"), rf"\blgpl{S}3{O}"),
    ("LPPL-1.3c", short("lppl", "1"), rf"\blppl{S}1\.3c?"),
    ("MIT", "mit licen|mit-licen", r"\bmit[\s-]+licen[sc]ed?"),
    ("MIT", "expat licen", r"\bexpat\s+licen[sc]e"),
    ("MPL-1.0", short("mpl", "1"), rf"\bmpl{S}1\.0"),
    ("MPL-1.1", short("mpl", "1"), rf"\bmpl{S}1\.1"),
    ("MPL-2.0", short("mpl", "2"), rf"\bmpl{S}2{O}"),
    ("MS-PL", "ms-pl", r"\bms-pl"),
    ("MS-RL", "ms-rl", r"\bms-rl"),
    ("ODbL-1.0", "odbl", r"\bodbl(?:[\s-]+(?:v\s*)?1\.0)?"),
    ("OFL-1.1", short("ofl", "1"), rf"\bofl{S}1\.1"),
    ("OSL-3.0", short("osl", "3"), rf"\bosl{S}3\.0"),
    ("PSF-2.0", short("psf", "2"), rf"\bpsf{S}2\.0"),
    ("SSPL-1.0", short("sspl", "1"), rf"\bsspl{S}1{O}"),
    ("UPL-1.0", short("upl", "1"), rf"\bupl{S}1\.0"),
    ("WTFPL", "wtfpl", r"\bwtfpl"),
    ("ZPL-2.1", short("zpl", "2"), rf"\bzpl{S}2\.1"),
]

#: (label, keywords, signature): sentences of license texts and notices.
NOTICES = [
    ("mit", "permission is hereby granted", r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+obtaining\s+a\s+copy"),
    ("isc", "permission to use", r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose"),
    ("bsd-family", "redistribution and use", r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,\s+with\s+or\s+without\s+modification"),
    ("bsd-3-clause", "endorse or promote", rf"neither\s+the\s+name\s+of\s{GAP}\s+may\s+be\s+used\s+to\s+endorse\s+or\s+promote\s+products"),
    ("gpl-family", "free software foundation", r"redistribute\s+it\s+and/or\s+modify\s+it\s+under\s+the\s+terms\s+of\s+the\s+gnu\s+general\s+public\s+licen[sc]e\s+as\s+published\s+by\s+the\s+free\s+software\s+foundation"),
    ("apache-2.0", "except in compliance", r"you\s+may\s+not\s+use\s+this\s+file\s+except\s+in\s+compliance\s+with\s+the\s+licen[sc]e"),
    ("mpl-2.0", "source code form", r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public\s+licen[sc]e"),
    ("zlib", "as-is", r"this\s+software\s+is\s+provided\s+'?as-is'?,\s+without\s+any\s+express\s+or\s+implied\s+warranty"),
    ("unlicense", "unencumbered", r"this\s+is\s+free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated)\s+(?:in|into|to)\s+the\s+public\s+domain"),
    ("all-rights-reserved", "all rights reserved", r"\ball\s+rights\s+reserved"),
    ("copyright", "copyright", r"\bcopyright\s+(?:\(c\)|©)?\s*(?:19|20)\d\d"),
    ("proprietary", "proprietary", r"proprietary\s+and\s+confidential"),
    ("proprietary", "unauthorized|unauthorised", rf"unauthori[sz]ed\s+(?:copying|reproduction)\b{GAP}\s+is\s+(?:strictly\s+)?prohibited"),
]

#: (label, keywords, signature): a family named without its version.
FAMILIES = [
    ("agpl-family", "affero|agpl", r"affero\s+general\s+public\s+licen[sc]e|\bagpl(?:v?\d[\d.]*)?\b"),
    ("apache-family", "apache", r"apache\s+(?:software\s+)?licen[sc]e"),
    ("artistic-family", "artistic", r"artistic\s+licen[sc]e"),
    ("bsd-family", "bsd", r"\bbsd[- ]licen[sc]ed?"),
    ("cc-family", "creative commons", r"creative\s+commons(?:\s+licen[sc]e)?"),
    ("cc-by-family", "cc by|cc-by", r"\bcc[- ]by(?:[- ](?:nc|nd|sa))*\b"),
    ("eclipse-family", "eclipse", r"eclipse\s+public\s+licen[sc]e"),
    ("gfdl-family", "free documentation", r"free\s+documentation\s+licen[sc]e"),
    ("gpl-family", "general public|gpl", r"(?:gnu\s+)?general\s+public\s+licen[sc]e|\bgpl(?:v?\d[\d.]*)?\b"),
    ("lgpl-family", "lesser|lgpl", r"lesser\s+general\s+public\s+licen[sc]e|\blgpl(?:v?\d[\d.]*)?\b"),
    ("mpl-family", "mozilla", r"mozilla\s+public\s+licen[sc]e"),
]

#: (SPDX identifier, keywords, address as a signature)
ADDRESSES = [
    ("Apache-2.0", "apache.org", r"apache\.org/licenses/LICENSE-2\.0"),
    ("GPL-3.0", "gnu.org", r"gnu\.org/licenses/gpl-3\.0"),
    ("GPL-2.0", "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("LGPL-3.0", "gnu.org", r"gnu\.org/licenses/lgpl-3\.0"),
    ("LGPL-2.1", "gnu.org", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("AGPL-3.0", "gnu.org", r"gnu\.org/licenses/agpl-3\.0"),
    ("GFDL-1.3", "gnu.org", r"gnu\.org/licenses/fdl-1\.3"),
    ("MPL-2.0", "mozilla.org", r"mozilla\.org/MPL/2\.0"),
    ("EPL-2.0", "eclipse.org", r"eclipse\.org/legal/epl-2\.0"),
    ("CC0-1.0", "creativecommons.org", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("CC-BY-4.0", "creativecommons.org", r"creativecommons\.org/licenses/by/4\.0"),
    ("CC-BY-SA-4.0", "creativecommons.org", r"creativecommons\.org/licenses/by-sa/4\.0"),
    ("CC-BY-SA-3.0", "creativecommons.org", r"creativecommons\.org/licenses/by-sa/3\.0"),
    ("CC-BY-NC-4.0", "creativecommons.org", r"creativecommons\.org/licenses/by-nc/4\.0"),
    ("CC-BY-ND-4.0", "creativecommons.org", r"creativecommons\.org/licenses/by-nd/4\.0"),
    ("MIT", "opensource.org", r"opensource\.org/licenses?/mit"),
    ("BSD-2-Clause", "opensource.org", r"opensource\.org/licenses?/bsd-2-clause"),
    ("BSD-3-Clause", "opensource.org", r"opensource\.org/licenses?/bsd-3-clause"),
    ("Unlicense", "unlicense.org", r"unlicense\.org"),
    ("BSL-1.0", "boost.org", r"boost\.org/LICENSE_1_0"),
    ("WTFPL", "wtfpl.net", r"wtfpl\.net"),
]


#: An operand of an SPDX expression, with what stands between it and the next one.  An
#: operand's signature begins at the one before it, so that none of them contains another.
WORD_TAGS = "|".join(spdx for spdx, _, _ in NAMES if "-" not in spdx)
OPERAND = rf"(?<![\w.:+-])(?:(?:{WORD_TAGS})(?![\w.:+-])|[\w.:]+-[\w.:+-]+)[ \t)]+(?-i:OR|AND|WITH)[ \t(]+"


def rules() -> list[Rule]:
    """All signatures in this order: identifiers, operands, grants, notices, names, short forms, addresses, families."""
    out: list[tuple[str, int, float, str, str]] = []
    tags = [(spdx.lower(), spdx.replace(".", r"\.") + r"(?:-only|-or-later|\+)?(?![\w+-]|\.\w)") for spdx, _, _ in NAMES]
    out += [(label, 0, 1.0, "spdx", rf"spdx-license-identifier:[\s(]*{tag}") for label, tag in tags]
    out += [(label, 0, 1.0, "spdx-license-identifier", rf"{OPERAND}{tag}") for label, tag in tags]
    for spdx, keyword, name in NAMES:
        grant = r"(?:licen[sc]ed|released|distributed|available|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?"
        out.append((spdx.lower(), 1, 0.95, keyword, rf"{grant}(?:{name})(?![\w-])"))
    out += [(label, 2, 0.9, keyword, signature) for label, keyword, signature in NOTICES]
    out += [(spdx.lower(), 3, 0.8, keyword, rf"(?:{name})(?![\w-])") for spdx, keyword, name in NAMES]
    out += [(spdx.lower(), 3, 0.8, keyword, rf"(?:{form})(?![\w-]|\.\d)") for spdx, keyword, form in SHORT_FORMS]
    out += [(spdx.lower(), 4, 0.7, keyword, rf"(?:{address})(?![\w-])") for spdx, keyword, address in ADDRESSES]
    out += [(label, 5, 0.5, keyword, signature) for label, keyword, signature in FAMILIES]
    return [Rule(i, label, p, c, tuple(k.split("|")), f"(?i){s}") for i, (label, p, c, k, s) in enumerate(out)]
