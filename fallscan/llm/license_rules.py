"""Licence signatures as ordered rules.

A family is a label, one or two keywords of which any of its matches contains one, and a hand-written expression
for its name. Expressions are matched on *normalised* text: words in lower case, one space
between them, a space at either end ("apache license version 2 0"). Each family is tried in
several forms, which differ in priority (1 is best) and confidence.
"""

from __future__ import annotations

L = "(?:license|licence)"
V = "(?:version |ver |v )?v?"

# label | keyword or two | name. Labels are the public SPDX identifiers in lower case where one exists.
_FAMILIES = rf"""
apache-2.0 | apache | (?:the )?apache (?:software )?(?:{L} )?{V}2(?: 0)?(?: {L})?
apache-1.1 | apache | (?:the )?apache (?:software )?(?:{L} )?{V}1 1(?: {L})?
apache-1.0 | apache | (?:the )?apache (?:software )?(?:{L} )?{V}1 0(?: {L})?
mit | mit | (?:the )?(?:expat )?mit (?:open source )?{L}
mit-0 | mit | (?:the )?mit (?:0|no attribution)(?: {L})?
x11 | x11 | (?:the )?x11 {L}
bsd-2-clause | bsd | (?:the )?(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)(?: {L})?
bsd-3-clause | bsd | (?:the )?(?:modified bsd|new bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd|bsd style)(?: {L})?
bsd-4-clause | bsd | (?:the )?(?:original bsd|old bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: {L})?
bsd | bsd | (?:the )?bsd {L}
0bsd | bsd | (?:the )?(?:0bsd|bsd zero clause|zero clause bsd)(?: {L})?
isc | isc | (?:the )?isc {L}
gpl-1.0 | general public;gpl | (?:the )?(?:gnu )?(?:general public {L}|gpl) {V}1(?: 0)?(?: only| or later| or any later version)?
gpl-2.0 | general public;gpl | (?:the )?(?:gnu )?(?:general public {L}|gpl) (?:as published by the free software foundation either )?{V}2(?: 0)?(?: only)?
gpl-2.0-or-later | general public;gpl | (?:the )?(?:gnu )?(?:general public {L}|gpl) (?:as published by the free software foundation either )?{V}2(?: 0)?(?: of the {L})? or (?:at your option )?(?:any )?later(?: version)?
gpl-3.0 | general public;gpl | (?:the )?(?:gnu )?(?:general public {L}|gpl) (?:as published by the free software foundation either )?{V}3(?: 0)?(?: only)?
gpl-3.0-or-later | general public;gpl | (?:the )?(?:gnu )?(?:general public {L}|gpl) (?:as published by the free software foundation either )?{V}3(?: 0)?(?: of the {L})? or (?:at your option )?(?:any )?later(?: version)?
gpl-2.0 | gpl | gplv2
gpl-3.0 | gpl | gplv3
lgpl-2.0 | library general;lgpl | (?:the )?(?:gnu )?(?:library general public {L}|lgpl) {V}2(?: 0)?
lgpl-2.1 | lesser general;lgpl | (?:the )?(?:gnu )?(?:lesser general public {L}|lgpl) {V}2 1
lgpl-3.0 | lesser general;lgpl | (?:the )?(?:gnu )?(?:lesser general public {L}|lgpl) {V}3(?: 0)?
lgpl-3.0 | lgpl | lgplv3
agpl-1.0 | affero | (?:the )?affero general public {L} {V}1(?: 0)?
agpl-3.0 | affero;agpl | (?:the )?(?:gnu )?(?:affero general public {L}|affero gpl|agpl) {V}3(?: 0)?
agpl-3.0 | agpl | agplv3
gfdl-1.1 | free documentation | (?:the )?gnu free documentation {L} {V}1 1
gfdl-1.2 | free documentation | (?:the )?gnu free documentation {L} {V}1 2
gfdl-1.3 | free documentation | (?:the )?gnu free documentation {L} {V}1 3
gfdl | free documentation | (?:the )?gnu free documentation {L}
mpl-1.0 | mozilla;mpl | (?:the )?(?:mozilla public {L}|mpl) {V}1 0
mpl-1.1 | mozilla;mpl | (?:the )?(?:mozilla public {L}|mpl) {V}1 1
mpl-2.0 | mozilla;mpl | (?:the )?(?:mozilla public {L}|mpl) {V}2(?: 0)?
epl-1.0 | eclipse;epl | (?:the )?(?:eclipse public {L}|epl) {V}1(?: 0)?
epl-2.0 | eclipse;epl | (?:the )?(?:eclipse public {L}|epl) {V}2(?: 0)?
cpl-1.0 | common public | (?:the )?common public {L} {V}1(?: 0)?
ipl-1.0 | ibm public | (?:the )?ibm public {L} {V}1(?: 0)?
cddl-1.0 | common development;cddl | (?:the )?(?:common development and distribution {L}|cddl) {V}1 0
cddl-1.1 | common development;cddl | (?:the )?(?:common development and distribution {L}|cddl) {V}1 1
eupl-1.1 | european union;eupl | (?:the )?(?:european union public {L}|eupl) {V}1 1
eupl-1.2 | european union;eupl | (?:the )?(?:european union public {L}|eupl) {V}1 2
osl-2.1 | open software | (?:the )?open software {L} {V}2 1
osl-3.0 | open software | (?:the )?open software {L} {V}3(?: 0)?
afl-2.1 | academic free | (?:the )?academic free {L} {V}2 1
afl-3.0 | academic free | (?:the )?academic free {L} {V}3(?: 0)?
artistic-1.0 | artistic | (?:the )?artistic {L} {V}1(?: 0)?
artistic-2.0 | artistic | (?:the )?artistic {L} {V}2(?: 0)?
artistic | artistic | (?:the )?(?:perl )?artistic {L}
ms-pl | microsoft | (?:the )?microsoft public {L}
ms-rl | microsoft | (?:the )?microsoft reciprocal {L}
bsl-1.0 | boost | (?:the )?boost software {L}(?: {V}1(?: 0)?)?
busl-1.1 | business source | (?:the )?business source {L}(?: {V}1 1)?
sspl-1.0 | server side public | (?:the )?server side public {L}(?: {V}1(?: 0)?)?
elastic-2.0 | elastic | (?:the )?elastic {L}(?: {V}2(?: 0)?)?
commons-clause | commons clause | (?:the )?commons clause(?: {L})?(?: condition {V}1 0)?
polyform-noncommercial-1.0.0 | polyform | (?:the )?polyform noncommercial {L}(?: 1 0 0)?
polyform-small-business-1.0.0 | polyform | (?:the )?polyform small business {L}(?: 1 0 0)?
blueoak-1.0.0 | blue oak | (?:the )?blue oak model {L}(?: {V}1 0 0)?
upl-1.0 | universal permissive | (?:the )?universal permissive {L}(?: {V}1 0)?
zlib | zlib | (?:the )?zlib (?:libpng )?{L}
libpng | libpng | (?:the )?libpng {L}
openssl | openssl | (?:the )?openssl {L}
curl | curl | (?:the )?curl {L}
python-2.0 | python | (?:the )?(?:python software foundation|psf|python) {L}(?: {V}2(?: 0)?)?
php-3.01 | php | (?:the )?php {L}(?: {V}3 01)?
ruby | ruby | (?:the )?ruby {L}
postgresql | postgresql | (?:the )?postgresql {L}
ncsa | ncsa | (?:the )?(?:university of illinois )?ncsa (?:open source )?{L}
w3c | w3c | (?:the )?w3c (?:software )?(?:notice and )?{L}
vim | vim | (?:the )?vim {L}
tcl | tcl | (?:the )?tcl tk {L}
icu | icu | (?:the )?icu {L}
unicode-3.0 | unicode | (?:the )?unicode {L} v3
unicode-dfs-2016 | unicode | (?:the )?unicode inc {L} agreement
zpl-2.1 | zope | (?:the )?zope public {L}(?: {V}2 1)?
qpl-1.0 | q public | (?:the )?q public {L}(?: {V}1 0)?
sleepycat | sleepycat | (?:the )?sleepycat {L}
ijg | jpeg group | (?:the )?independent jpeg group {L}
hpnd | historical permission | (?:the )?historical permission notice and disclaimer
beerware | beer | (?:the )?(?:beerware|beer ware) {L}
wtfpl | do what the;wtfpl | (?:the )?(?:do what the fuck you want to public {L}|wtfpl)
unlicense | unlicen | (?:the )?unlicen[sc]e
json | json | (?:the )?json {L}
ofl-1.1 | sil open font | (?:the )?sil open font {L}(?: {V}1 1)?
odbl-1.0 | open database | (?:the )?open (?:data commons open )?database {L}(?: {V}1 0)?
odc-by-1.0 | open data commons | (?:the )?open data commons attribution {L}(?: {V}1 0)?
pddl-1.0 | public domain dedication | (?:the )?open data commons public domain dedication and {L}(?: {V}1 0)?
cecill-2.1 | cecill | (?:the )?cecill (?:free software )?{L}(?: agreement)?(?: {V}2 1)?
mulanpsl-2.0 | mulan | (?:the )?mulan (?:permissive software {L}|psl)(?: {V}2)?
cc0-1.0 | cc0 | (?:the )?(?:creative commons )?cc0(?: {V}1(?: 0)?)?(?: universal)?
cc0-1.0 | creative commons | creative commons zero(?: {V}1(?: 0)?)?(?: universal)?
cc-pddc | public domain | (?:dedicated to|placed in|released into) the public domain
gpl | gnu | (?:the )?gnu general public {L}
lgpl | gnu | (?:the )?gnu lesser general public {L}
agpl | gnu | (?:the )?gnu affero general public {L}
mit-text | hereby granted | permission is hereby granted free of charge to any person obtaining a copy
bsd-text | redistribution | redistribution and use in source and binary forms with or without modification are permitted
apache-2.0 | apache | you may not use this file except in compliance with the {L} you may obtain a copy of the {L} at http www apache org licenses {L} 2 0
isc-text | and or distribute | permission to use copy modify and or distribute this software for any purpose
no-warranty | warrant | (?:provided|supplied|distributed) as is without (?:warranty|any warranty|warranties)(?: of any kind)?
proprietary | proprietary | proprietary and confidential
proprietary | confidential | strictly confidential
proprietary | unauthori | unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: of this (?:file|work|software|document))?
reserved-notice | rights reserved | (?:all|some|no) rights reserved
no-reproduction | may be reproduced | no part of this (?:publication|book|work|document) may be reproduced
eula | end user | (?:the )?end user {L} agreement
terms-of-use | terms of use | (?:the |our )?terms of use
copyright | copyright | copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
"""

_CC_KINDS = (
    ("by", "by|attribution"),
    ("by-sa", "by sa|attribution share ?alike"),
    ("by-nc", "by nc|attribution non ?commercial"),
    ("by-nd", "by nd|attribution no ?deriv(?:s|ative|atives)?(?: works)?"),
    ("by-nc-sa", "by nc sa|attribution non ?commercial share ?alike"),
    ("by-nc-nd", "by nc nd|attribution non ?commercial no ?deriv(?:s|ative|atives)?(?: works)?"),
)
_CC = "creative commons; cc "
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

_GRANT = (
    "(?:licensed|released|distributed|available|published|provided|shared|covered) "
    "(?:under|by|with|according to) (?:the )?(?:terms of )?(?:the )?"
)


def families() -> list[tuple[str, str, str]]:
    """(label, keyword, name) of all families, in order."""
    rows = [
        tuple(cell.strip() for cell in line.split(" | "))
        for line in _FAMILIES.strip().splitlines()
    ]
    for kind, names in _CC_KINDS:
        for version in _CC_VERSIONS:
            spoken = version.replace(".", " ")
            name = f"(?:creative commons |cc )(?:{names})(?: {L})?(?: {V}| ){spoken}(?: international| unported| generic)?"
            rows.append((f"cc-{kind}-{version}", _CC, name))
        rows.append((f"cc-{kind}", _CC, f"(?:creative commons |cc )(?:{names})(?: {L})?"))
    return rows


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, label, keyword, expression, confidence), in order.

    Forms: an SPDX tag (1), a grant that names the licence (2), the name alone (3); statements
    without a version (4). The expressions are anchored at spaces and do not consume them.
    """
    found = []
    for label, keyword, name in families():
        plain = not any(c.isdigit() for c in label)
        spdx = label.replace(".", " ").replace("-", " ")
        forms = [
            (1, "spdx", f"spdx license identifier {spdx}(?: only| or later)?", 1.0),
            (2, keyword, _GRANT + name, 0.95),
            (4 if plain else 3, keyword, name, 0.7 if plain else 0.85),
        ]
        for priority, word, expression, confidence in forms:
            row = (priority, label, word, f"(?<= )(?:{expression})(?= )", confidence)
            if row not in found:
                found.append(row)
    return found
