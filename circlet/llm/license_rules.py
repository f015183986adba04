"""Signature rules of the license scan, in the order in which they are tried.

One rule a line: label, priority, keyword, expression. A rule is tried only on texts that hold its section's stem and its keyword.
Expressions run over words joined by single blanks, A-Z without case, and have to begin and end at words.
Priorities: 4 a tag or a full title with its version, 3 a title, 2 a sentence of the license's text, 1 a mention.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    stem: str
    keyword: str
    pattern: str
    base: bool = False


# Fixed phrases and labels of the contract.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

RULES_TEXT = r"""
[spdx]
mit | 4 | mit | spdx license identifier (?:\w+ (?:or|and) )?mit
mit-0 | 4 | mit 0 | spdx license identifier mit 0
apache-2.0 | 4 | apache | spdx license identifier (?:\w+ (?:or|and) )?apache 2 0
gpl-1.0 | 4 | gpl | spdx license identifier gpl 1 0(?: only| or later)?
gpl-2.0 | 4 | gpl | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 4 | or later | spdx license identifier gpl 2 0 or later
gpl-3.0 | 4 | gpl | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 4 | or later | spdx license identifier gpl 3 0 or later
lgpl-2.1 | 4 | lgpl | spdx license identifier lgpl 2 [01](?: only| or later)?
lgpl-3.0 | 4 | lgpl | spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3.0 | 4 | agpl | spdx license identifier agpl 3 0(?: only| or later)?
bsd-2-clause | 4 | bsd | spdx license identifier bsd 2 clause
bsd-3-clause | 4 | bsd | spdx license identifier bsd 3 clause
bsd-4-clause | 4 | bsd | spdx license identifier bsd 4 clause
0bsd | 4 | 0bsd | spdx license identifier 0bsd
isc | 4 | isc | spdx license identifier isc
mpl-2.0 | 4 | mpl | spdx license identifier mpl 2 0
epl-1.0 | 4 | epl | spdx license identifier epl 1 0
epl-2.0 | 4 | epl | spdx license identifier epl 2 0
cddl-1.0 | 4 | cddl | spdx license identifier cddl 1 [01]
cc0-1.0 | 4 | cc0 | spdx license identifier cc0 1 0
cc-by-4.0 | 4 | cc by | spdx license identifier cc by 4 0
cc-by-sa-4.0 | 4 | cc by sa | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | 4 | cc by nc | spdx license identifier cc by nc 4 0
unlicense | 4 | unlicense | spdx license identifier unlicense
wtfpl | 4 | wtfpl | spdx license identifier wtfpl
zlib | 4 | zlib | spdx license identifier zlib
bsl-1.0 | 4 | bsl | spdx license identifier bsl 1 0
python-2.0 | 4 | python | spdx license identifier python 2 0
artistic-2.0 | 4 | artistic | spdx license identifier artistic [12] 0
postgresql | 4 | postgresql | spdx license identifier postgresql
eupl-1.2 | 4 | eupl | spdx license identifier eupl 1 [12]
ofl-1.1 | 4 | ofl | spdx license identifier ofl 1 [01]
odbl-1.0 | 4 | odbl | spdx license identifier odbl 1 0
openssl | 4 | openssl | spdx license identifier openssl
boost | 3 | boost | spdx license identifier boost \w+
unknown-spdx | 1 | identifier | spdx license identifier \w+
spdx-mention | 1 | spdx | spdx (?:expression|header|id|tag)
[licen]
mit | 4 | mit | (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of the )?mit licen[sc]e
mit | 4 | expat | expat (?:mit )?licen[sc]e
mit | 3 | mit | (?:the )?mit licen[sc]e(?: mit)?
mit | 3 | x11 | (?:mit x11|x11 mit) (?:style )?licen[sc]e
mit | 1 | mit | mit licensed
mit | 1 | mit | mit style licen[sc]e
mit | 2 | opensource | opensource org licenses mit(?: license)?(?: php)?
mit-0 | 4 | no attribution | mit no attribution licen[sc]e
mit-licence-uk | 1 | mit licence | mit licence
x11 | 3 | x11 | x11 licen[sc]e
apache-2.0 | 4 | apache | (?:licensed |released |distributed |available )?under (?:the )?(?:terms of the )?apache licen[sc]e version 2(?: 0)?
apache-2.0 | 4 | apache | apache licen[sc]e (?:version |v)?2(?: 0)?
apache-2.0 | 3 | apache | apache 2(?: 0)? licen[sc]e
apache-2.0 | 2 | apache | apache org licenses license 2 0(?: txt| html)?
apache-1.1 | 4 | apache | apache (?:software )?licen[sc]e (?:version |v)?1 1
apache-1.0 | 4 | apache | apache (?:software )?licen[sc]e (?:version |v)?1 0
apache | 3 | apache | (?:the )?apache (?:software )?licen[sc]e
apache | 1 | apache | apache licensed
asf-contribution | 2 | apache | licensed to the apache software foundation asf(?: under one or more contributor license agreements)?
gpl-1.0 | 4 | general public | (?:gnu )?general public licen[sc]e (?:version |v)1(?: 0)?
gpl-2.0 | 4 | general public | (?:gnu )?general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v)2(?: 0)?
gpl-2.0-or-later | 4 | later version | (?:gnu )?general public licen[sc]e (?:as published by the free software foundation )?(?:either )?version 2(?: 0)? (?:of the license )?or (?:at your option )?any later version
gpl-3.0 | 4 | general public | (?:gnu )?general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v)3(?: 0)?
gpl-3.0-or-later | 4 | later version | (?:gnu )?general public licen[sc]e (?:as published by the free software foundation )?(?:either )?version 3(?: 0)? (?:of the license )?or (?:at your option )?any later version
gpl | 3 | general public | (?:licensed under the )?gnu general public licen[sc]e
gpl | 2 | general public | you should have received a copy of the gnu general public licen[sc]e along with this program
gpl | 2 | general public | under the terms of the gnu general public licen[sc]e
gpl | 1 | gpl | gpl licen[sc]ed?
gpl-2.0 | 2 | gnu org | gnu org licenses (?:old licenses )?gpl 2 0(?: html| txt)?
gpl-3.0 | 2 | gnu org | gnu org licenses gpl 3 0(?: html| txt)?
gpl | 2 | gnu org | gnu org licenses(?: gpl)?(?: html| txt)?
gpl-with-classpath | 4 | classpath | general public licen[sc]e (?:version )?2? ?with (?:the )?classpath exception
lgpl-2.0 | 4 | library general | (?:gnu )?library general public licen[sc]e(?: version 2(?: 0)?)?
lgpl-2.1 | 4 | lesser general | (?:gnu )?lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v)2 1
lgpl-3.0 | 4 | lesser general | (?:gnu )?lesser general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v)3(?: 0)?
lgpl | 3 | lesser general | (?:gnu )?lesser general public licen[sc]e
lgpl | 1 | lgpl | lgpl licen[sc]ed?
lgpl | 2 | gnu org | gnu org licenses lgpl(?: [23] [01])?(?: html| txt)?
agpl-3.0 | 4 | affero | (?:gnu )?affero general public licen[sc]e (?:as published by the free software foundation )?(?:either )?(?:version |v)3(?: 0)?
agpl-1.0 | 4 | affero | affero general public licen[sc]e (?:version |v)1(?: 0)?
agpl | 3 | affero | (?:gnu )?affero (?:general public )?licen[sc]e
agpl | 2 | agpl | gnu org licenses agpl(?: 3 0)?(?: html| txt)?
gfdl | 3 | free documentation | (?:gnu )?free documentation licen[sc]e(?: (?:version |v)?1 [123])?
gfdl | 2 | fdl | gnu org licenses fdl(?: 1 [123])?(?: html| txt)?
bsd-2-clause | 4 | bsd | (?:2|two) clause (?:freebsd )?bsd licen[sc]e
bsd-2-clause | 4 | bsd | bsd 2 clause licen[sc]e
bsd-2-clause | 3 | simplified bsd | simplified bsd licen[sc]e
bsd-2-clause | 3 | freebsd | freebsd (?:documentation )?licen[sc]e
bsd-3-clause | 4 | bsd | (?:3|three) clause bsd licen[sc]e
bsd-3-clause | 4 | bsd | bsd 3 clause licen[sc]e
bsd-3-clause | 3 | bsd | (?:new|modified|revised) bsd licen[sc]e
bsd-4-clause | 4 | bsd | (?:4|four) clause bsd licen[sc]e
bsd-4-clause | 3 | bsd | (?:original|old) bsd licen[sc]e
bsd | 3 | bsd | (?:the )?bsd (?:style )?licen[sc]e
bsd | 1 | bsd | bsd licensed
bsd | 2 | opensource | opensource org licenses bsd license(?: php)?
bsd-patent | 4 | bsd | bsd 2 clause plus patent licen[sc]e
bsd-3-clause-clear | 4 | clear bsd | clear bsd licen[sc]e
0bsd | 4 | zero clause | (?:bsd )?zero clause (?:bsd )?licen[sc]e
isc | 3 | isc | (?:the )?isc licen[sc]e
isc | 1 | openbsd | openbsd licen[sc]e
mpl-1.0 | 4 | mozilla | mozilla public licen[sc]e (?:version |v)?1 0
mpl-1.1 | 4 | mozilla | mozilla public licen[sc]e (?:version |v)?1 1
mpl-2.0 | 4 | mozilla | mozilla public licen[sc]e (?:version |v)?2 0
mpl-2.0 | 2 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl | 3 | mozilla | mozilla public licen[sc]e
npl | 3 | netscape | netscape public licen[sc]e
epl-1.0 | 4 | eclipse | eclipse public licen[sc]e (?:version |v)?1 0
epl-2.0 | 4 | eclipse | eclipse public licen[sc]e (?:version |v)?2 0
epl | 3 | eclipse | eclipse public licen[sc]e
edl-1.0 | 3 | eclipse distribution | eclipse distribution licen[sc]e(?: (?:version |v)?1 0)?
cpl-1.0 | 3 | common public | common public licen[sc]e(?: (?:version |v)?[01] [05])?
ipl-1.0 | 3 | ibm public | ibm public licen[sc]e(?: (?:version |v)?1 0)?
cddl-1.0 | 4 | common development | common development and distribution licen[sc]e (?:version |v)?1 0
cddl-1.1 | 4 | common development | common development and distribution licen[sc]e (?:version |v)?1 1
cddl | 3 | common development | common development and distribution licen[sc]e(?: cddl)?
cddl | 1 | cddl | cddl licen[sc]e
bsl-1.0 | 4 | boost | boost software licen[sc]e (?:version |v)?1 0
bsl-1.0 | 3 | boost | boost (?:software )?licen[sc]e
bsl-1.0 | 2 | boost | boost org license 1 0(?: txt)?
busl-1.1 | 4 | business source | business source licen[sc]e(?: (?:version |v)?1 [01])?
sspl-1.0 | 4 | server side | server side public licen[sc]e(?: (?:version |v)?1(?: 0)?)?
elastic-2.0 | 4 | elastic | elastic licen[sc]e (?:version |v)?2 0
elastic | 3 | elastic | elastic licen[sc]e
commons-clause | 3 | commons clause | commons clause licen[sc]e(?: condition)?
zlib | 3 | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
libpng | 3 | libpng | (?:the )?libpng licen[sc]e
unlicense | 3 | unlicense | (?:the )?unlicense
unlicense | 2 | unlicense | unlicense org
wtfpl | 3 | what the fuck | do what the fuck you want to public licen[sc]e
wtfpl | 1 | wtfpl | wtfpl licen[sc]e
artistic-1.0 | 4 | artistic | (?:perl )?artistic licen[sc]e (?:version |v)?1 0
artistic-2.0 | 4 | artistic | artistic licen[sc]e (?:version |v)?2 0
artistic | 3 | artistic | artistic licen[sc]e
python-2.0 | 3 | python | python (?:software foundation )?licen[sc]e(?: (?:version |v)?2)?
psf | 1 | psf | psf licen[sc]e
ruby | 3 | ruby | ruby(?: s)? licen[sc]e
php-3.0 | 3 | php | php licen[sc]e(?: (?:version |v)?3 0[01]?)?
zend | 3 | zend | zend (?:engine )?licen[sc]e
postgresql | 3 | postgresql | postgresql licen[sc]e
openldap | 3 | openldap | openldap public licen[sc]e(?: version 2 [0-9])?
openssl | 3 | openssl | openssl licen[sc]e
ssleay | 3 | ssleay | (?:original )?ssleay licen[sc]e
curl | 3 | curl | curl licen[sc]e
w3c | 3 | w3c | w3c (?:software )?(?:notice and )?(?:document )?licen[sc]e
icu | 3 | icu | icu licen[sc]e
unicode | 3 | unicode | unicode (?:inc )?licen[sc]e(?: agreement)?
ncsa | 3 | ncsa | (?:university of illinois )?ncsa open source licen[sc]e
ecl-2.0 | 3 | educational community | educational community licen[sc]e(?: (?:version |v)?2 0)?
afl-3.0 | 3 | academic free | academic free licen[sc]e(?: (?:version |v)?[123] [01])?
osl-3.0 | 3 | open software | open software licen[sc]e(?: (?:version |v)?[123] [01])?
ms-pl | 3 | microsoft public | microsoft public licen[sc]e(?: ms pl)?
ms-rl | 3 | microsoft reciprocal | microsoft reciprocal licen[sc]e(?: ms rl)?
ms-lpl | 3 | microsoft limited | microsoft limited public licen[sc]e
eupl-1.1 | 4 | european union | european union public licen[sc]e (?:version |v)?1 1
eupl-1.2 | 4 | european union | european union public licen[sc]e (?:version |v)?1 2
eupl | 3 | european union | european union public licen[sc]e
cecill | 3 | cecill | cecill(?: [bc])? (?:free software )?licen[sc]e(?: agreement)?
sleepycat | 3 | sleepycat | sleepycat licen[sc]e
qpl-1.0 | 3 | q public | q public licen[sc]e(?: (?:version |v)?1 0)?
rpl-1.5 | 3 | reciprocal public | reciprocal public licen[sc]e(?: (?:version |v)?1 [15])?
watcom | 3 | watcom | sybase open watcom public licen[sc]e
apsl-2.0 | 3 | apple public | apple public source licen[sc]e(?: (?:version |v)?[12] [0-2])?
intel | 3 | intel | intel (?:open source|simplified software) licen[sc]e
nokia | 3 | nokia | nokia open source licen[sc]e
vim | 3 | vim | vim licen[sc]e
beerware | 3 | beer | beer ?ware licen[sc]e
json | 3 | json | (?:the )?json licen[sc]e
ijg | 3 | independent jpeg | independent jpeg group licen[sc]e
freetype | 3 | freetype | freetype (?:project )?licen[sc]e
imagemagick | 3 | imagemagick | imagemagick licen[sc]e
tcl | 3 | tcl | tcl tk licen[sc]e
upl-1.0 | 3 | universal permissive | universal permissive licen[sc]e(?: (?:version |v)?1 0)?
mulan-2.0 | 3 | mulan | mulan permissive software licen[sc]e(?: (?:version |v)?[12])?
ofl-1.1 | 4 | open font | sil open font licen[sc]e (?:version |v)?1 1
ofl | 3 | open font | (?:sil )?open font licen[sc]e
lppl | 3 | latex | latex project public licen[sc]e(?: (?:version |v)?1 [0-3]c?)?
odbl-1.0 | 3 | open database | open (?:data commons open )?database licen[sc]e(?: odbl)?(?: (?:version |v)?1 0)?
pddl-1.0 | 3 | public domain | public domain dedication and licen[sc]e(?: pddl)?
odc-by-1.0 | 3 | attribution | open data commons attribution licen[sc]e(?: (?:version |v)?1 0)?
ogl-uk-3.0 | 3 | open government | open government licen[sc]e(?: (?:version |v)?[123] 0)?
etalab-2.0 | 3 | etalab | etalab open licen[sc]e(?: (?:version |v)?2 0)?
cdla | 3 | community data | community data licen[sc]e agreement(?: (?:permissive|sharing))?
openrail | 3 | openrail | (?:creativeml |bigscience )?openrail(?: m)? licen[sc]e
rail | 3 | responsible ai | responsible ai licen[sc]e
polyform | 3 | polyform | polyform (?:noncommercial|shield|strict|perimeter|small business|internal use) licen[sc]e(?: 1 0 0)?
cc-by | 4 | cc by | licensed under (?:a )?cc by [1-4] [0-9]
cc-by-sa | 4 | cc by sa | licensed under (?:a )?cc by sa [1-4] [0-9]
cc-by-nc | 4 | cc by nc | licensed under (?:a )?cc by nc [1-4] [0-9]
cc-by-nd | 4 | cc by nd | licensed under (?:a )?cc by nd [1-4] [0-9]
cc-by-nc-sa | 4 | cc by nc sa | licensed under (?:a )?cc by nc sa [1-4] [0-9]
cc-by-nc-nd | 4 | cc by nc nd | licensed under (?:a )?cc by nc nd [1-4] [0-9]
cc-by | 3 | creative commons | creative commons attribution(?: [1-4] [0-9])?(?: international| unported| generic)? licen[sc]e
cc-by-sa | 3 | creative commons | creative commons attribution share ?alike(?: [1-4] [0-9])?(?: international| unported| generic)? licen[sc]e
cc-by-nc | 3 | creative commons | creative commons attribution non ?commercial(?: [1-4] [0-9])?(?: international| unported| generic)? licen[sc]e
cc-by-nd | 3 | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [0-9])?(?: international| unported| generic)? licen[sc]e
cc-by-nc-sa | 3 | creative commons | creative commons attribution non ?commercial share ?alike(?: [1-4] [0-9])?(?: international| unported| generic)? licen[sc]e
cc | 1 | creative commons | creative commons licen[sc]e
cc-by | 2 | creativecommons | creativecommons org licenses by [1-4] [0-9]
cc-by-sa | 2 | creativecommons | creativecommons org licenses by sa [1-4] [0-9]
cc-by-nc | 2 | creativecommons | creativecommons org licenses by nc [1-4] [0-9]
cc-by-nd | 2 | creativecommons | creativecommons org licenses by nd [1-4] [0-9]
cc-by-nc-sa | 2 | creativecommons | creativecommons org licenses by nc sa [1-4] [0-9]
cc-by-nc-nd | 2 | creativecommons | creativecommons org licenses by nc nd [1-4] [0-9]
proprietary | 2 | end user | end user licen[sc]e agreement
proprietary | 2 | commercial | commercial licen[sc]e(?: agreement)?
proprietary | 2 | licen | (?:proprietary|closed source) licen[sc]e
permissive | 1 | permissive | permissive (?:open source )?licen[sc]e
copyleft | 1 | copyleft | copyleft licen[sc]e
dual | 1 | dual | dual licen[sc]ed?
multiple | 1 | tri | (?:triple|tri) licen[sc]ed?
open-source | 1 | open source | open source licen[sc]e
see-license-file | 1 | see | see (?:the )?(?:file )?licen[sc]e(?: file| txt| md)? for (?:more |license )?(?:details|information)
[gnu gpl]
gpl | 3 | gnu gpl | gnu gpl(?: licen[sc]e)?(?: (?:version |v)?[123])?
[mozilla org]
mpl | 2 | mpl | mozilla org mpl(?: 2 0)?
[perl itself]
perl | 2 | under the same | under the same (?:terms|license) as perl itself
[permission]
mit | 2 | free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
isc | 2 | and or distribute | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
hpnd | 2 | and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose
bsl-1.0 | 2 | person or organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
zlib | 2 | anyone to use | permission is granted to anyone to use this software for any purpose including commercial applications
bsd | 2 | endorse or promote | may be used to endorse or promote products derived from this software without (?:specific )?prior written permission
gfdl | 2 | document | permission is granted to copy distribute and or modify this document
proprietary | 2 | permission of | without the (?:express|prior) (?:written )?permission of
verbatim | 1 | verbatim | permission is granted to make and distribute verbatim copies
[redistribut]
bsd | 2 | source and binary | redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause | 1 | binary form | redistributions in binary form must reproduce the above copyright notice
bsd | 1 | source code | redistributions of source code must retain the above copyright notice
gpl | 2 | redistribute it | you can redistribute it and or modify it under the terms of the gnu general public license
lgpl | 2 | redistribute it | you can redistribute it and or modify it under the terms of the gnu lesser general public license
agpl | 2 | redistribute it | you can redistribute it and or modify it under the terms of the gnu affero general public license
freeware | 1 | redistributed | may be (?:freely )?redistributed(?: freely)?
[warrant]
no-warranty | 1 | as is | provided as is without (?:any )?(?:warranty|warranties)(?: of any kind)?
no-warranty | 1 | absolutely | comes with absolutely no warranty
apache-2.0 | 2 | conditions of any kind | distributed on an as is basis without warranties or conditions of any kind
gpl | 1 | merchantability | without even the implied warranty of merchantability or fitness for a particular purpose
[public domain]
public-domain | 2 | the public domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 2 | unencumbered | this is free and unencumbered software released into the public domain
cc0-1.0 | 3 | cc0 | cc0 1 0 (?:universal )?public domain(?: dedication)?
public-domain | 1 | public domain | in the public domain
[cc0]
cc0-1.0 | 3 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?
[rights reserved]
all-rights-reserved | 1 | all rights | all rights reserved
some-rights-reserved | 1 | some rights | some rights reserved
[copyright]
copyright-notice | 1 | copyright | copyright c? ?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
copyright-notice | 1 | inc | copyright (?:c )?\w+ inc
proprietary | 2 | confidential | confidential and proprietary copyright
"""


def parse(text: str) -> list[Rule]:
    rules, stem = [], ""
    for line in filter(None, map(str.strip, text.splitlines())):
        if line.startswith("["):
            stem = line.strip("[]")
        else:
            label, priority, keyword, pattern = (part.strip() for part in line.split(" | "))
            rules.append(Rule(label, int(priority), stem, keyword, pattern))
    return rules


def base_rules() -> list[Rule]:
    return [Rule(label, 3, "licen", phrase, phrase, True) for label, phrase in BASE]


RULES = base_rules() + parse(RULES_TEXT)
