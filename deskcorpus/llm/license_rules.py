"""Signature rules for license scans, over lower-case words parted by one space.

Each rule is written out below as ``label | priority | keyword | pattern``. A rule is tried
only in texts that have its keyword, so the keyword must be part of whatever the pattern
matches. Identifiers in tags weigh most, then names with a version, names, sentences
of license texts, and last general notices of rights."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values of the contract: phrases and labels. These are the base detections.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

SIGNATURES = r"""
mit | 95 | identifier mit | spdx license identifier mit
mit | 70 | mit license | (?:the )?mit license
mit | 70 | mit licence | (?:the )?mit licence
mit | 72 | expat license | (?:mit )?expat license
mit | 60 | license mit | license mit
mit | 60 | mit licensed | mit licensed
mit | 58 | mit style | mit style licen[cs]e
mit | 66 | massachusetts institute of technology | massachusetts institute of technology licen[cs]e
mit | 64 | opensource org licenses mit | opensource org licenses mit(?: license)?(?: php)?
mit | 62 | hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy
mit | 50 | substantial portions | the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit | 48 | without restriction including | to deal in the software without restriction including without limitation the rights to use copy modify
mit-0 | 96 | identifier mit 0 | spdx license identifier mit 0
mit-0 | 74 | no attribution | mit no attribution(?: licen[cs]e)?
x11 | 95 | identifier x11 | spdx license identifier x11
x11 | 70 | x11 license | (?:mit )?x11 license
apache-2 | 95 | identifier apache 2 | spdx license identifier apache 2 0
apache-2 | 80 | apache license version 2 | apache license version 2(?: 0)?
apache-2 | 80 | apache license 2 | apache license 2(?: 0)?
apache-2 | 80 | apache license v2 | apache license v2(?: 0)?
apache-2 | 79 | apache software license version 2 | apache software license version 2(?: 0)?
apache-2 | 79 | apache software license 2 | apache software license 2(?: 0)?
apache-2 | 78 | apache 2 0 | apache 2 0 licen[cs]ed?
apache-2 | 76 | apache2 | apache2 licen[cs]e
apache-2 | 76 | apache v2 | apache v2(?: 0)?(?: licen[cs]e)?
apache-2 | 75 | asl 2 0 | asl 2 0
apache-2 | 74 | apache org licenses license 2 | apache org licenses license 2 0
apache-2 | 55 | except in compliance with the license | you may not use this file except in compliance with the license
apache-2 | 50 | on an as is basis | software distributed under the license is distributed on an as is basis
apache-2 | 48 | perpetual worldwide non exclusive | grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license
apache-1.1 | 95 | identifier apache 1 1 | spdx license identifier apache 1 1
apache-1.1 | 79 | apache software license version 1 1 | apache software license version 1 1
apache-1.1 | 79 | apache license version 1 1 | apache license version 1 1
apache-1.1 | 52 | apache software foundation http | this product includes software developed by the apache software foundation http
apache | 60 | apache license | apache license
apache | 60 | apache software license | apache software license
apache | 58 | apache licensed | apache licensed
gpl-2 | 95 | identifier gpl 2 | spdx license identifier gpl 2 0(?: only| or later)?
gpl-2 | 82 | gnu general public license version 2 | gnu general public license version 2(?: 0)?
gpl-2 | 82 | gnu general public license v2 | gnu general public license v2(?: 0)?
gpl-2 | 82 | gnu general public license 2 | gnu general public license 2(?: 0)?
gpl-2 | 83 | free software foundation version 2 | gnu general public license as published by the free software foundation version 2
gpl-2 | 83 | either version 2 of the license | gnu general public license as published by the free software foundation either version 2 of the license
gpl-2 | 78 | gplv2 | gplv2
gpl-2 | 78 | gpl v2 | gpl v2(?: 0)?
gpl-2 | 78 | gpl 2 | gpl 2(?: 0)?
gpl-2 | 78 | gpl2 | gpl2
gpl-2 | 79 | gpl | (?:gnu )?gpl version 2(?: 0)?
gpl-2 | 74 | old licenses gpl 2 | gnu org licenses old licenses gpl 2 0(?: en)?(?: html| txt)?
gpl-3 | 95 | identifier gpl 3 | spdx license identifier gpl 3 0(?: only| or later)?
gpl-3 | 82 | gnu general public license version 3 | gnu general public license version 3(?: 0)?
gpl-3 | 82 | gnu general public license v3 | gnu general public license v3(?: 0)?
gpl-3 | 82 | gnu general public license 3 | gnu general public license 3(?: 0)?
gpl-3 | 83 | free software foundation version 3 | gnu general public license as published by the free software foundation version 3
gpl-3 | 83 | either version 3 of the license | gnu general public license as published by the free software foundation either version 3 of the license
gpl-3 | 78 | gplv3 | gplv3
gpl-3 | 78 | gpl v3 | gpl v3(?: 0)?
gpl-3 | 78 | gpl 3 | gpl 3(?: 0)?
gpl-3 | 78 | gpl3 | gpl3
gpl-3 | 79 | gpl | (?:gnu )?gpl version 3(?: 0)?
gpl-3 | 74 | licenses gpl 3 | gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
gpl-1 | 82 | gnu general public license version 1 | gnu general public license version 1(?: 0)?
gpl-1 | 95 | identifier gpl 1 | spdx license identifier gpl 1 0(?: only| or later)?
gpl | 65 | gnu general public license | gnu general public license
gpl | 60 | gnu gpl | gnu gpl
gpl | 58 | gpl licensed | gpl licensed
gpl | 58 | gpl | under the gpl
gpl | 57 | gpl license | gpl license
gpl | 45 | this program is free software | this program is free software you can redistribute it and or modify it
gpl | 42 | in the hope that it will be useful | distributed in the hope that it will be useful but without any warranty
gpl | 40 | received a copy of the gnu general | you should have received a copy of the gnu general public license
lgpl-2 | 95 | identifier lgpl 2 0 | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2 | 82 | library general public license version 2 | gnu library general public license version 2(?: 0)?
lgpl-2.1 | 95 | identifier lgpl 2 1 | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 82 | lesser general public license version 2 1 | gnu lesser general public license version 2 1
lgpl-2.1 | 82 | lesser general public license v2 1 | gnu lesser general public license v2 1
lgpl-2.1 | 78 | lgplv2 1 | lgplv2 1
lgpl-2.1 | 78 | lgpl v2 1 | lgpl v2 1
lgpl-2.1 | 78 | lgpl 2 1 | lgpl 2 1
lgpl-2.1 | 74 | licenses lgpl 2 1 | gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3 | 95 | identifier lgpl 3 | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3 | 82 | lesser general public license version 3 | gnu lesser general public license version 3(?: 0)?
lgpl-3 | 82 | lesser general public license v3 | gnu lesser general public license v3(?: 0)?
lgpl-3 | 78 | lgplv3 | lgplv3
lgpl-3 | 78 | lgpl v3 | lgpl v3(?: 0)?
lgpl-3 | 78 | lgpl 3 | lgpl 3(?: 0)?
lgpl | 66 | lesser general public license | (?:gnu )?lesser general public license
lgpl | 66 | library general public license | (?:gnu )?library general public license
lgpl | 60 | gnu lgpl | gnu lgpl
lgpl | 58 | lgpl | under the lgpl
lgpl | 57 | lgpl license | lgpl license
agpl-3 | 95 | identifier agpl 3 | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3 | 82 | affero general public license version 3 | gnu affero general public license version 3(?: 0)?
agpl-3 | 82 | affero general public license v3 | gnu affero general public license v3(?: 0)?
agpl-3 | 78 | agplv3 | agplv3
agpl-3 | 78 | agpl v3 | agpl v3(?: 0)?
agpl-3 | 78 | agpl 3 | agpl 3(?: 0)?
agpl | 66 | affero general public license | (?:gnu )?affero general public license
agpl | 60 | gnu agpl | gnu agpl
agpl | 58 | agpl | under the agpl
gfdl | 95 | identifier gfdl | spdx license identifier gfdl 1 [123](?: only| or later)?
gfdl | 80 | free documentation license version | gnu free documentation license version 1 [123]
gfdl | 70 | free documentation license | (?:gnu )?free documentation license
gfdl | 45 | copy distribute and or modify this document | permission is granted to copy distribute and or modify this document under the terms of
bsd-2 | 95 | identifier bsd 2 clause | spdx license identifier bsd 2 clause
bsd-2 | 78 | bsd 2 clause | bsd 2 clause(?: licen[cs]e)?
bsd-2 | 78 | 2 clause bsd | 2 clause bsd(?: licen[cs]e)?
bsd-2 | 78 | two clause bsd | two clause bsd(?: licen[cs]e)?
bsd-2 | 76 | simplified bsd | simplified bsd(?: licen[cs]e)?
bsd-2 | 76 | freebsd license | freebsd license
bsd-3 | 95 | identifier bsd 3 clause | spdx license identifier bsd 3 clause
bsd-3 | 78 | bsd 3 clause | bsd 3 clause(?: licen[cs]e)?
bsd-3 | 78 | 3 clause bsd | 3 clause bsd(?: licen[cs]e)?
bsd-3 | 78 | three clause bsd | three clause bsd(?: licen[cs]e)?
bsd-3 | 76 | new bsd license | new bsd license
bsd-3 | 76 | modified bsd license | modified bsd license
bsd-3 | 76 | revised bsd license | revised bsd license
bsd-3 | 56 | endorse or promote products | neither the name of .{1,80}? may be used to endorse or promote products
bsd-4 | 95 | identifier bsd 4 clause | spdx license identifier bsd 4 clause
bsd-4 | 78 | bsd 4 clause | bsd 4 clause(?: licen[cs]e)?
bsd-4 | 78 | 4 clause bsd | 4 clause bsd(?: licen[cs]e)?
bsd-4 | 76 | original bsd license | original bsd license
bsd-4 | 56 | advertising materials mentioning | all advertising materials mentioning features or use of this software must display
0bsd | 95 | identifier 0bsd | spdx license identifier 0bsd
0bsd | 76 | zero clause bsd | zero clause bsd(?: licen[cs]e)?
0bsd | 76 | bsd zero clause | bsd zero clause(?: licen[cs]e)?
bsd | 62 | bsd license | bsd license
bsd | 62 | bsd licence | bsd licence
bsd | 58 | bsd style | bsd style licen[cs]e
bsd | 58 | bsd licensed | bsd licensed
bsd | 52 | redistributions of source code must retain | redistributions of source code must retain the above copyright notice
bsd | 50 | redistributions in binary form must | redistributions in binary form must reproduce the above copyright notice
bsd | 44 | redistribution and use in source and binary | redistribution and use in source and binary forms with or without modification are permitted
isc | 95 | identifier isc | spdx license identifier isc
isc | 72 | isc license | (?:the )?isc license
isc | 72 | internet systems consortium | internet systems consortium licen[cs]e
isc | 62 | for any purpose with or without fee | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee
mpl-2 | 95 | identifier mpl 2 | spdx license identifier mpl 2 0(?: no copyleft exception)?
mpl-2 | 82 | mozilla public license version 2 | mozilla public license version 2(?: 0)?
mpl-2 | 82 | mozilla public license v 2 | mozilla public license v 2 0
mpl-2 | 82 | mozilla public license 2 | mozilla public license 2(?: 0)?
mpl-2 | 78 | mpl 2 0 | mpl 2 0
mpl-2 | 78 | mplv2 | mplv2(?: 0)?
mpl-2 | 74 | mozilla org mpl 2 0 | mozilla org mpl 2 0
mpl-2 | 60 | source code form is subject to | this source code form is subject to the terms of the mozilla public license
mpl-1.1 | 95 | identifier mpl 1 1 | spdx license identifier mpl 1 1
mpl-1.1 | 82 | mozilla public license version 1 1 | mozilla public license version 1 1
mpl-1.1 | 78 | mpl 1 1 | mpl 1 1
mpl-1.0 | 82 | mozilla public license version 1 0 | mozilla public license version 1 0
mpl | 65 | mozilla public license | mozilla public license
epl-1 | 95 | identifier epl 1 | spdx license identifier epl 1 0
epl-1 | 80 | eclipse public license v1 | eclipse public license v1(?: 0)?
epl-1 | 80 | eclipse public license version 1 | eclipse public license version 1(?: 0)?
epl-1 | 78 | epl 1 0 | epl 1 0
epl-2 | 95 | identifier epl 2 | spdx license identifier epl 2 0
epl-2 | 80 | eclipse public license v2 | eclipse public license v2(?: 0)?
epl-2 | 80 | eclipse public license 2 | eclipse public license 2(?: 0)?
epl-2 | 80 | eclipse public license version 2 | eclipse public license version 2(?: 0)?
epl-2 | 78 | epl 2 0 | epl 2 0
epl | 65 | eclipse public license | eclipse public license
edl | 70 | eclipse distribution license | eclipse distribution license(?: v ?1 0)?
cddl | 95 | identifier cddl | spdx license identifier cddl 1 [01]
cddl | 78 | common development and distribution license | common development and distribution license(?: version 1 [01])?
cddl | 72 | cddl 1 | cddl 1 [01]
cpl | 95 | identifier cpl | spdx license identifier cpl 1 0
cpl | 72 | common public license | common public license(?: version 1 0)?
ipl | 72 | ibm public license | ibm public license(?: version 1 0)?
eupl | 95 | identifier eupl | spdx license identifier eupl 1 [012]
eupl | 78 | european union public licence | european union public licence(?: v(?:ersion)? ?1 [012])?
eupl | 78 | european union public license | european union public license(?: v(?:ersion)? ?1 [012])?
eupl | 72 | eupl 1 | eupl 1 [012]
artistic-1 | 95 | identifier artistic 1 | spdx license identifier artistic 1 0(?: perl| cl8)?
artistic-2 | 95 | identifier artistic 2 | spdx license identifier artistic 2 0
artistic-2 | 78 | artistic license 2 | artistic license 2 0
artistic-2 | 78 | artistic license version 2 | artistic license version 2(?: 0)?
artistic | 66 | artistic license | (?:perl )?artistic license
perl | 60 | same terms as perl itself | under the same terms as perl itself
boost | 95 | identifier bsl 1 0 | spdx license identifier bsl 1 0
boost | 78 | boost software license | boost software license(?: version 1 0)?
busl | 95 | identifier busl | spdx license identifier busl 1 1
busl | 76 | business source license | business source license(?: 1 1)?
zlib | 95 | identifier zlib | spdx license identifier zlib
zlib | 74 | zlib license | zlib license
zlib | 74 | zlib libpng license | zlib libpng license
zlib | 56 | must not be misrepresented | the origin of this software must not be misrepresented
libpng | 95 | identifier libpng | spdx license identifier libpng(?: 2 0)?
libpng | 70 | libpng license | libpng license
unlicense | 95 | identifier unlicense | spdx license identifier unlicense
unlicense | 74 | the unlicense | (?:under )?the unlicense
unlicense | 64 | unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 60 | unlicense org | unlicense org
wtfpl | 95 | identifier wtfpl | spdx license identifier wtfpl
wtfpl | 74 | what the fuck you want to public license | do what the fuck you want to public license
wtfpl | 70 | wtfpl | wtfpl(?: license)?
psf | 95 | identifier psf | spdx license identifier psf 2 0
psf | 95 | identifier python 2 | spdx license identifier python 2 0
psf | 74 | python software foundation license | python software foundation license(?: version 2)?
psf | 70 | psf license | psf license
ofl | 95 | identifier ofl | spdx license identifier ofl 1 [01](?: r?fn| no rfn)?
ofl | 78 | sil open font license | sil open font license(?: version)?(?: 1 [01])?
ofl | 68 | open font license | open font license
odbl | 95 | identifier odbl | spdx license identifier odbl 1 0
odbl | 76 | open database license | open database license(?: odbl)?(?: v1 0| 1 0)?
odc-by | 95 | identifier odc by | spdx license identifier odc by 1 0
odc-by | 76 | open data commons attribution license | open data commons attribution license(?: v1 0)?
pddl | 95 | identifier pddl | spdx license identifier pddl 1 0
pddl | 76 | public domain dedication and license | open data commons public domain dedication and license
cdla-permissive | 95 | identifier cdla permissive | spdx license identifier cdla permissive [12] 0
cdla-permissive | 76 | data license agreement permissive | community data license agreement permissive(?: version)?(?: [12] 0)?
cdla-sharing | 95 | identifier cdla sharing | spdx license identifier cdla sharing 1 0
cdla-sharing | 76 | data license agreement sharing | community data license agreement sharing(?: version)?(?: 1 0)?
ms-pl | 95 | identifier ms pl | spdx license identifier ms pl
ms-pl | 74 | microsoft public license | microsoft public license
ms-rl | 95 | identifier ms rl | spdx license identifier ms rl
ms-rl | 74 | microsoft reciprocal license | microsoft reciprocal license
postgresql | 95 | identifier postgresql | spdx license identifier postgresql
postgresql | 74 | postgresql | postgresql licen[cs]e
ncsa | 95 | identifier ncsa | spdx license identifier ncsa
ncsa | 74 | university of illinois | university of illinois ncsa open source license
upl | 95 | identifier upl | spdx license identifier upl 1 0
upl | 74 | universal permissive license | universal permissive license(?: version 1 0)?
cecill | 95 | identifier cecill | spdx license identifier cecill (?:1 [01]|2 [01]|b|c)
cecill | 72 | cecill | (?:licence |license )?cecill(?: b| c| 2 [01])?
sspl | 95 | identifier sspl | spdx license identifier sspl 1 0
sspl | 76 | server side public license | server side public license(?: version 1| v1)?
elastic | 95 | identifier elastic | spdx license identifier elastic 2 0
elastic | 74 | elastic license | elastic license(?: 2 0)?
osl | 95 | identifier osl | spdx license identifier osl [123] [01]
osl | 74 | open software license | open software license(?: v ?(?:ersion )?[123] [01])?
afl | 95 | identifier afl | spdx license identifier afl [123] [012]
afl | 74 | academic free license | academic free license(?: v ?(?:ersion )?[123] [012])?
ecl | 95 | identifier ecl | spdx license identifier ecl 2 0
ecl | 74 | educational community license | educational community license(?: version 2 0)?
qpl | 95 | identifier qpl | spdx license identifier qpl 1 0
qpl | 74 | q public license | q public license(?: version 1 0)?
php | 95 | identifier php | spdx license identifier php 3 0(?:1)?
php | 72 | php license | php license(?: version 3 0(?:1)?)?
ruby | 95 | identifier ruby | spdx license identifier ruby
ruby | 68 | ruby license | ruby license
openssl | 95 | identifier openssl | spdx license identifier openssl
openssl | 72 | openssl license | openssl license
openssl | 54 | for use in the openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
curl | 95 | identifier curl | spdx license identifier curl
beerware | 95 | identifier beerware | spdx license identifier beerware
beerware | 70 | beer ware license | beer ware license
vim | 70 | vim license | vim license
w3c | 95 | identifier w3c | spdx license identifier w3c
w3c | 72 | w3c software | w3c software (?:notice and |and document )?license
hpnd | 95 | identifier hpnd | spdx license identifier hpnd
hpnd | 66 | historical permission notice | historical permission notice and disclaimer
sleepycat | 95 | identifier sleepycat | spdx license identifier sleepycat
sleepycat | 72 | sleepycat license | sleepycat license
unicode | 95 | identifier unicode | spdx license identifier unicode (?:dfs 201[56]|3 0|tou)
unicode | 72 | unicode license | unicode license(?: v3)?
mulan | 95 | identifier mulanpsl | spdx license identifier mulanpsl [12] 0
mulan | 72 | mulan psl | mulan psl(?: v2)?
blueoak | 95 | identifier blueoak | spdx license identifier blueoak 1 0 0
blueoak | 72 | blue oak model license | blue oak model license
openrail | 80 | bigscience openrail m | bigscience openrail m(?: license)?
openrail | 80 | bigscience rail license | bigscience rail license(?: v1 0)?
openrail | 80 | creativeml openrail m | creativeml openrail m(?: license)?
openrail | 72 | openrail license | openrail license
openrail | 72 | responsible ai license | responsible ai licenses?
llama | 80 | llama 2 community license | llama 2 community license(?: agreement)?
llama | 80 | llama 3 community license | llama 3 community license(?: agreement)?
llama | 80 | llama 3 1 community license | llama 3 1 community license(?: agreement)?
llama | 80 | llama 3 2 community license | llama 3 2 community license(?: agreement)?
gemma | 76 | gemma terms of use | gemma terms of use
cc0 | 95 | identifier cc0 | spdx license identifier cc0 1 0
cc0 | 82 | cc0 1 0 universal | cc0 1 0 universal
cc0 | 80 | creative commons zero | creative commons zero(?: v1 0 universal)?
cc0 | 74 | cc0 license | cc0 license
cc0 | 72 | cc0 1 0 | cc0 1 0
cc0 | 72 | publicdomain zero 1 0 | creativecommons org publicdomain zero 1 0
cc-by | 96 | identifier cc by | spdx license identifier cc by [1234] [05]
cc-by | 81 | creative commons attribution 4 0 | creative commons attribution 4 0(?: international)?
cc-by | 81 | creative commons attribution 3 0 | creative commons attribution 3 0(?: unported)?
cc-by | 81 | creative commons attribution 2 5 | creative commons attribution 2 5(?: generic)?
cc-by | 81 | creative commons attribution 2 0 | creative commons attribution 2 0(?: generic)?
cc-by | 66 | creative commons attribution | creative commons attribution(?: licen[cs]e)?
cc-by | 76 | cc by | cc by [1234] [05]
cc-by | 62 | cc by | cc by(?: licen[cs]e)?
cc-by | 80 | creativecommons org licenses by | creativecommons org licenses by [1234] [05]
cc-by-sa | 97 | identifier cc by sa | spdx license identifier cc by sa [1234] [05]
cc-by-sa | 84 | creative commons attribution sharealike | creative commons attribution sharealike [1234] [05](?: international| unported| generic)?
cc-by-sa | 84 | creative commons attribution share alike | creative commons attribution share alike [1234] [05](?: international| unported| generic)?
cc-by-sa | 72 | creative commons attribution sharealike | creative commons attribution sharealike(?: licen[cs]e)?
cc-by-sa | 72 | creative commons attribution share alike | creative commons attribution share alike(?: licen[cs]e)?
cc-by-sa | 78 | cc by sa | cc by sa [1234] [05]
cc-by-sa | 68 | cc by sa | cc by sa(?: licen[cs]e)?
cc-by-sa | 82 | creativecommons org licenses by sa | creativecommons org licenses by sa [1234] [05]
cc-by-nc | 97 | identifier cc by nc | spdx license identifier cc by nc [1234] [05]
cc-by-nc | 84 | creative commons attribution noncommercial | creative commons attribution noncommercial [1234] [05](?: international| unported| generic)?
cc-by-nc | 84 | creative commons attribution non commercial | creative commons attribution non commercial [1234] [05](?: international| unported| generic)?
cc-by-nc | 72 | creative commons attribution noncommercial | creative commons attribution noncommercial(?: licen[cs]e)?
cc-by-nc | 72 | creative commons attribution non commercial | creative commons attribution non commercial(?: licen[cs]e)?
cc-by-nc | 78 | cc by nc | cc by nc [1234] [05]
cc-by-nc | 68 | cc by nc | cc by nc(?: licen[cs]e)?
cc-by-nc | 82 | creativecommons org licenses by nc | creativecommons org licenses by nc [1234] [05]
cc-by-nd | 97 | identifier cc by nd | spdx license identifier cc by nd [1234] [05]
cc-by-nd | 84 | creative commons attribution noderivatives | creative commons attribution noderivatives [1234] [05](?: international)?
cc-by-nd | 84 | creative commons attribution no derivatives | creative commons attribution no derivatives [1234] [05](?: international)?
cc-by-nd | 84 | creative commons attribution noderivs | creative commons attribution noderivs [123] [05](?: unported| generic)?
cc-by-nd | 72 | creative commons attribution noderivatives | creative commons attribution noderivatives(?: licen[cs]e)?
cc-by-nd | 72 | creative commons attribution no derivatives | creative commons attribution no derivatives(?: licen[cs]e)?
cc-by-nd | 78 | cc by nd | cc by nd [1234] [05]
cc-by-nd | 68 | cc by nd | cc by nd(?: licen[cs]e)?
cc-by-nd | 82 | creativecommons org licenses by nd | creativecommons org licenses by nd [1234] [05]
cc-by-nc-sa | 98 | identifier cc by nc sa | spdx license identifier cc by nc sa [1234] [05]
cc-by-nc-sa | 86 | attribution noncommercial sharealike | creative commons attribution noncommercial sharealike [1234] [05](?: international| unported| generic)?
cc-by-nc-sa | 86 | attribution non commercial share alike | creative commons attribution non commercial share alike [1234] [05](?: international| unported| generic)?
cc-by-nc-sa | 74 | attribution noncommercial sharealike | creative commons attribution noncommercial sharealike(?: licen[cs]e)?
cc-by-nc-sa | 74 | attribution non commercial share alike | creative commons attribution non commercial share alike(?: licen[cs]e)?
cc-by-nc-sa | 80 | cc by nc sa | cc by nc sa [1234] [05]
cc-by-nc-sa | 71 | cc by nc sa | cc by nc sa(?: licen[cs]e)?
cc-by-nc-sa | 83 | creativecommons org licenses by nc sa | creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-nd | 98 | identifier cc by nc nd | spdx license identifier cc by nc nd [1234] [05]
cc-by-nc-nd | 86 | attribution noncommercial noderivatives | creative commons attribution noncommercial noderivatives [1234] [05](?: international)?
cc-by-nc-nd | 86 | attribution noncommercial noderivs | creative commons attribution noncommercial noderivs [123] [05](?: unported| generic)?
cc-by-nc-nd | 74 | attribution noncommercial noderivatives | creative commons attribution noncommercial noderivatives(?: licen[cs]e)?
cc-by-nc-nd | 74 | attribution non commercial no derivatives | creative commons attribution non commercial no derivatives(?: licen[cs]e)?
cc-by-nc-nd | 80 | cc by nc nd | cc by nc nd [1234] [05]
cc-by-nc-nd | 71 | cc by nc nd | cc by nc nd(?: licen[cs]e)?
cc-by-nc-nd | 83 | creativecommons org licenses by nc nd | creativecommons org licenses by nc nd [1234] [05]
cc | 50 | creative commons license | creative commons license
cc | 50 | creative commons licence | creative commons licence
cc | 45 | some rights reserved | some rights reserved
public-domain | 60 | public domain mark | public domain mark(?: 1 0)?
public-domain | 58 | creativecommons org publicdomain mark | creativecommons org publicdomain mark 1 0
public-domain | 44 | into the public domain | (?:released|placed|dedicated|put) into the public domain
public-domain | 44 | in the public domain | (?:is|are|lies|remains|placed) in the public domain
public-domain | 44 | to the public domain | dedicated to the public domain
public-domain | 42 | public domain dedication | public domain dedication
public-domain | 40 | waives all rights | (?:author|creator|owner) waives all rights
all-rights-reserved | 20 | all rights reserved | all rights reserved
all-rights-reserved | 20 | alle rechte vorbehalten | alle rechte vorbehalten
all-rights-reserved | 20 | tous droits | tous droits réservés
all-rights-reserved | 20 | todos los derechos reservados | todos los derechos reservados
proprietary | 32 | confidential and proprietary | confidential and proprietary
proprietary | 32 | proprietary and confidential | proprietary and confidential
proprietary | 32 | proprietary license | proprietary license
proprietary | 31 | trade secret | contains (?:trade secrets?|trade secret information)
proprietary | 30 | strictly prohibited | (?:unauthorized|unauthorised) (?:copying|reproduction|use|distribution|disclosure) .{0,60}?strictly prohibited
proprietary | 29 | is prohibited | (?:unauthorized|unauthorised) (?:copying|reproduction|use|distribution|disclosure) .{0,60}?is prohibited
proprietary | 30 | may be reproduced | no part of this (?:publication|book|work|document|website) may be reproduced
proprietary | 28 | for internal use only | for internal use only
proprietary | 28 | do not distribute | do not distribute
proprietary | 34 | end user license agreement | end user license agreement
proprietary | 30 | not for redistribution | not for redistribution
non-commercial | 36 | non commercial use only | (?:for )?non commercial use only
non-commercial | 36 | noncommercial use only | (?:for )?noncommercial use only
non-commercial | 36 | not for commercial use | not for commercial use
non-commercial | 34 | personal use only | (?:for )?personal use only
non-commercial | 34 | research purposes only | (?:for )?research purposes only
non-commercial | 34 | educational purposes only | (?:for )?educational purposes only
permission-required | 30 | written permission | without (?:the )?(?:prior |express )?written permission
permission-required | 30 | written consent | without (?:the )?(?:prior |express )?written consent
permission-required | 28 | reprinted with permission | reprinted with permission
permission-required | 28 | used with permission | used with permission
permission-required | 28 | reproduced with permission | reproduced with permission
permission-required | 26 | permission of the | permission of the (?:publisher|author|copyright holder)
warranty | 18 | without warranty of any kind | (?:provided as is )?without warranty of any kind
warranty | 18 | merchantability | merchantability (?:and|or) fitness for a particular purpose
open-source | 24 | open source licen | open source licen[cs]e
open-source | 22 | released as open source | released as open source
dual | 26 | dual licensed | dual licensed
dual | 26 | dual license | dual license
"""


@dataclass(frozen=True)
class Rule:
    """``pattern`` matches whole words; it is tried only in texts that have ``keyword``.
    Of overlapping detections, the one of higher priority wins."""

    label: str
    pattern: str
    keyword: str
    priority: int


def gates(rules: tuple[Rule, ...]) -> list[str]:
    """Words of which every text that matches a rule or a base phrase has one."""
    needed = [r.keyword for r in rules] + [p for p, _ in BASE_PHRASES]
    return sorted({max(k.split(), key=len) for k in needed})


def build() -> tuple[Rule, ...]:
    """All rules, in the order they are written; a line that is no rule is an error."""
    rules = []
    for line in SIGNATURES.strip().splitlines():
        label, priority, keyword, pattern = line.split(" | ")
        rules.append(Rule(label, pattern, keyword, int(priority)))
    return tuple(rules)
