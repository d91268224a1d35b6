"""Hand-written signature rules: sentences of license texts, notices, grants and declarations.

One rule a line: label | keyword | phrase | priority | confidence. Smaller
priorities come first. In a phrase, words follow one another with anything but
letters and digits between them; `a/b` stands for either word, `a?` for a word
that may be missing, `#` for a version number. The keyword lies within one word
that every match has.
"""

NOTICES = """
mit | permission | permission is hereby granted free of charge to any person obtaining a copy | 5 | 0.99
mit | permission | the above copyright notice and this permission notice shall be included in all copies | 6 | 0.95
mit | deal | to deal in the software without restriction including without limitation the rights | 6 | 0.96
mit | sublicense | to use copy modify merge publish distribute sublicense and or sell copies of the software | 6 | 0.96
mit | noninfringement | fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders | 9 | 0.8
mit | opensource | opensource org licenses mit | 7 | 0.97
mit | dual | dual licensed under mit | 14 | 0.85
mit | license | license mit | 35 | 0.75
mit | mit | mit licensed/license/licence | 32 | 0.8
mit-0 | attribution | mit no attribution | 8 | 0.95
x11 | consortium | except as contained in this notice the name of the x consortium shall not be used | 4 | 0.97
isc | permission | permission to use copy modify and or distribute this software for any purpose | 5 | 0.99
isc | internet | internet systems consortium license/licence | 9 | 0.9
isc | opensource | opensource org licenses isc | 7 | 0.97
0bsd | permission | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software | 4 | 0.97
0bsd | zero | zero clause bsd | 8 | 0.96
bsd | redistribution | redistribution and use in source and binary forms with or without modification are permitted | 5 | 0.99
bsd | redistributions | redistributions of source code must retain the above copyright notice | 6 | 0.95
bsd | redistributions | redistributions in binary form must reproduce the above copyright notice | 6 | 0.95
bsd | endorse | may be used to endorse or promote products derived from this software | 7 | 0.9
bsd | regents | the regents of the university of california | 12 | 0.75
bsd | bsd | bsd style license/licence | 20 | 0.85
bsd | bsd | use of this source code is governed by a bsd style license | 4 | 0.98
bsd-2-clause | clause | 2/two clause bsd | 10 | 0.95
bsd-2-clause | bsd | bsd 2/two clause | 10 | 0.95
bsd-2-clause | freebsd | freebsd license/copyright/licence | 10 | 0.9
bsd-3-clause | clause | 3/three clause bsd | 10 | 0.95
bsd-3-clause | bsd | bsd 3/three clause | 10 | 0.95
bsd-3-clause | opensource | opensource org licenses bsd 3 clause | 6 | 0.97
bsd-2-clause | opensource | opensource org licenses bsd 2 clause | 6 | 0.97
bsd-4-clause | advertising | all advertising materials mentioning features or use of this software must display | 4 | 0.98
bsd-4-clause | original | original bsd license/licence | 9 | 0.93
bsd-3-clause-clear | clear | clear bsd license/licence | 8 | 0.95
bsd-patent | patent | bsd plus patent license/licence | 8 | 0.95
apache | compliance | you may not use this file except in compliance with the license | 5 | 0.97
apache | apache | www apache org licenses license 2 0 | 6 | 0.97
apache | apache | licensed to the apache software foundation | 4 | 0.98
apache | apache | apache org licenses license 1 1 | 6 | 0.95
apache | apache | this product includes software developed by the apache software foundation | 5 | 0.95
apache | opensource | opensource org licenses apache 2 0 | 6 | 0.97
apache | apache | apache 2 0 | 33 | 0.75
apache | apache | apache v2 | 33 | 0.75
apache | distributed | unless required by applicable law or agreed to in writing software distributed under the license | 6 | 0.95
apache | contributor | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free | 7 | 0.93
apache-llvm | llvm | apache license v2 0 with llvm exceptions/exception | 3 | 0.98
gpl | redistribute | this program is free software you can redistribute it and or modify it | 5 | 0.99
gpl | gnu | you should have received a copy of the gnu general public license | 4 | 0.99
gpl | warranty | this program comes with absolutely no warranty | 9 | 0.85
gpl | warranty | but without any warranty without even the implied warranty of merchantability | 10 | 0.8
gpl | gnu | www gnu org licenses gpl | 7 | 0.95
gpl | copyleft | gnu org copyleft gpl | 7 | 0.95
gpl | version | either version # of the license or at your option any later version | 11 | 0.85
gpl | gplv | gplv# | 25 | 0.85
gpl | gpl | gpl version # | 24 | 0.88
gpl | gpl | licensed/released/distributed under the? gpl | 12 | 0.92
gpl | exception | as a special exception the copyright holders give permission to link/linking | 13 | 0.7
gpl | linking | linking this library statically or dynamically with other modules | 8 | 0.9
gpl-classpath | classpath | gpl with classpath exception | 5 | 0.97
gpl-classpath | classpath | gnu classpath exception | 6 | 0.95
gpl-gcc | runtime | gcc runtime library exception | 6 | 0.97
gpl-linux | syscall | linux syscall note | 6 | 0.95
gpl | foss | foss license exception | 15 | 0.7
lgpl | gnu | you should have received a copy of the gnu lesser general public license | 4 | 0.99
lgpl | gnu | you should have received a copy of the gnu library general public license | 4 | 0.99
lgpl | redistribute | this library is free software you can redistribute it and or modify it | 5 | 0.98
lgpl | gnu | www gnu org licenses lgpl | 7 | 0.95
lgpl | lgplv | lgplv# | 25 | 0.88
lgpl | lgpl | lgpl version # | 24 | 0.9
agpl | gnu | you should have received a copy of the gnu affero general public license | 4 | 0.99
agpl | gnu | www gnu org licenses agpl | 7 | 0.95
agpl | agplv | agplv# | 25 | 0.9
agpl | network | interacting with it remotely through a computer network | 9 | 0.85
gfdl | invariant | with no invariant sections no front cover texts and no back cover texts | 4 | 0.97
gfdl | document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license | 3 | 0.99
mpl | mozilla | this source code form is subject to the terms of the mozilla public license | 4 | 0.99
mpl | mozilla | the contents of this file are subject to the mozilla public license | 4 | 0.99
mpl | mozilla | mozilla org mpl | 7 | 0.95
mpl | incompatible | incompatible with secondary licenses | 8 | 0.9
npl | netscape | the contents of this file are subject to the netscape public license | 4 | 0.98
npl | netscape | netscape public license/licence | 20 | 0.9
epl | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license | 3 | 0.99
epl | eclipse | eclipse org legal epl | 7 | 0.96
edl | eclipse | eclipse distribution license/licence | 19 | 0.92
cpl | accompanying | the accompanying program is provided under the terms of this common public license | 4 | 0.97
ipl | ibm | ibm public license/licence | 19 | 0.93
cddl | distribution | the contents of this file are subject to the terms of the common development and distribution license | 3 | 0.99
cddl | opensolaris | opensolaris license/licence | 12 | 0.85
eupl | eupl | licensed under the eupl | 4 | 0.98
eupl | european | european union public license/licence v? # | 9 | 0.96
osl | open | licensed under the open software license version # | 5 | 0.97
osl | software | open software license/licence | 20 | 0.88
afl | academic | licensed under the academic free license version # | 5 | 0.97
afl | academic | academic free license/licence | 19 | 0.92
artistic | artistic | the clarified artistic license/licence | 8 | 0.95
artistic | perl | under the same terms as perl itself | 6 | 0.92
artistic | perl | same terms as the perl 5 programming language | 6 | 0.92
boost | boost | distributed under the boost software license | 5 | 0.97
boost | boost | www boost org license 1 0 txt | 6 | 0.97
zlib | warranty | this software is provided as is without any express or implied warranty | 8 | 0.8
zlib | misrepresented | the origin of this software must not be misrepresented | 5 | 0.97
zlib | altered | altered source versions must be plainly marked as such | 5 | 0.97
libpng | libpng | this code is released under the libpng license | 4 | 0.98
libpng | libpng | libpng license/licence | 19 | 0.9
ijg | independent | this software is based in part on the work of the independent jpeg group | 4 | 0.98
unlicense | domain | this is free and unencumbered software released into the public domain | 4 | 0.99
unlicense | unlicense | unlicense org | 8 | 0.95
unlicense | relinquishment | we intend this dedication to be an overt act of relinquishment | 4 | 0.97
wtfpl | wtfpl | www wtfpl net | 7 | 0.96
wtfpl | verbatim | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed | 4 | 0.95
beerware | beer | the beer ware license | 5 | 0.97
beerware | beer | you can buy me a beer in return | 5 | 0.95
python | python | python software foundation license version # | 4 | 0.98
python | psf | psf license agreement for python | 4 | 0.98
python | beopen | beopen com license agreement for python | 4 | 0.97
python | cnri | cnri license agreement for python | 4 | 0.97
php | php | this source file is subject to version # of the php license | 3 | 0.99
php | php | this product includes php software | 7 | 0.93
ruby | ruby | you can redistribute it and or modify it under the terms of the ruby license | 4 | 0.97
ruby | ruby | ruby s license/licence | 15 | 0.9
vim | vim | vim license/licence | 18 | 0.92
tcl | tcl | tcl tk license/licence | 15 | 0.93
curl | curl | curl license/licence | 18 | 0.85
ofl | font | this font software is licensed under the sil open font license | 3 | 0.99
ofl | reserved | with reserved font name | 8 | 0.9
ofl | scripts | scripts sil org ofl | 6 | 0.96
ubuntu-font | ubuntu | ubuntu font licence/license | 9 | 0.97
bitstream-vera | bitstream | bitstream vera is a trademark of bitstream | 5 | 0.95
odbl | database | made available under the open database license | 3 | 0.99
odbl | opendatacommons | opendatacommons org licenses odbl | 6 | 0.97
odc-by | opendatacommons | opendatacommons org licenses by | 6 | 0.97
odc-by | commons | open data commons attribution license/licence | 8 | 0.96
pddl | opendatacommons | opendatacommons org licenses pddl | 6 | 0.97
pddl | dedication | open data commons public domain dedication and license | 5 | 0.98
dbcl | database | database contents license/licence | 12 | 0.95
osm | openstreetmap | openstreetmap contributors | 28 | 0.7
ogl | government | open government licence/license v? # | 8 | 0.97
ogl | government | contains public sector information licensed under the open government licence | 3 | 0.99
etalab | etalab | licence ouverte etalab | 6 | 0.97
etalab | ouverte | licence ouverte | 20 | 0.85
dl-de | deutschland | datenlizenz deutschland | 8 | 0.96
nlod | norwegian | norwegian licence/license for open government data | 6 | 0.97
cdla-permissive | permissive | community data license agreement permissive | 5 | 0.98
cdla-sharing | sharing | community data license agreement sharing | 5 | 0.98
postgresql | postgresql | postgresql licence/license | 18 | 0.93
ncsa | illinois | university of illinois open source license | 6 | 0.97
ncsa | permission | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with | 3 | 0.9
openssl | openssl | this product includes software developed by the openssl project | 4 | 0.98
openssl | cryptographic | this product includes cryptographic software written by eric young | 4 | 0.98
cecill | cecill | licence libre cecill | 8 | 0.96
cecill | cecill | governed by the cecill license under french law | 3 | 0.99
ms-pl | microsoft | this license governs use of the accompanying software if you use the software you accept this license microsoft | 4 | 0.8
ms-pl | microsoft | microsoft public license/licence | 15 | 0.95
ms-rl | reciprocal | microsoft reciprocal license/licence | 15 | 0.95
ms-eula | microsoft | microsoft software license terms | 8 | 0.95
apsl | apple | apple public source license/licence | 9 | 0.97
apple-sample | apple | apple sample code license/licence | 9 | 0.95
sun-bcl | sun | sun microsystems inc binary code license agreement | 6 | 0.97
oracle-bcl | oracle | oracle binary code license agreement | 6 | 0.97
oracle-otn | oracle | oracle technology network license agreement | 6 | 0.96
nvidia | nvidia | nvidia software license agreement | 6 | 0.95
nvidia | nvidia | nvidia corporation and its licensors retain all intellectual property | 4 | 0.98
intel | intel | intel simplified software license/licence | 6 | 0.96
intel | intel | intel open source license/licence | 8 | 0.95
amazon | amazon | amazon software license/licence | 8 | 0.95
sspl | server | server side public license/licence | 6 | 0.98
elastic | elastic | elastic license/licence 2? 0? | 8 | 0.93
elastic | elastic | licensed under the elastic license | 4 | 0.98
busl | business | business source license/licence | 8 | 0.97
busl | change | change date change license | 9 | 0.8
commons-clause | commons | commons clause license condition | 5 | 0.98
polyform | polyform | polyform noncommercial/small/shield/strict | 6 | 0.96
confluent | confluent | confluent community license/licence | 6 | 0.97
redis | redis | redis source available license | 6 | 0.97
timescale | timescale | timescale license/licence | 8 | 0.95
prosperity | prosperity | prosperity public license/licence | 6 | 0.97
parity | parity | parity public license/licence | 6 | 0.96
hippocratic | hippocratic | hippocratic license/licence | 6 | 0.97
json | evil | the software shall be used for good not evil | 3 | 0.99
upl | universal | universal permissive license/licence | 6 | 0.97
blueoak | blue | blue oak model license/licence | 6 | 0.97
mulan | mulan | mulan psl v2 | 6 | 0.97
mulan | mulan | mulan permissive software license | 5 | 0.98
openrail | openrail | openrail m? license/licence | 8 | 0.94
openrail | responsible | responsible ai license/licence | 10 | 0.92
rail | bigscience | bigscience rail license/licence | 6 | 0.97
llama | llama | llama # community license agreement | 5 | 0.97
gemma | gemma | gemma terms of use | 10 | 0.9
nokia | nokia | nokia open source license/licence | 9 | 0.95
sleepycat | sleepycat | the sleepycat license/licence | 7 | 0.96
qpl | public | q public license/licence | 12 | 0.95
zpl | zope | zope public license/licence | 9 | 0.97
w3c | w3c | w3c software notice and license | 6 | 0.97
w3c | w3c | w3c document license/licence | 8 | 0.95
unicode | unicode | unicode license agreement data files and software | 5 | 0.98
unicode | unicode | unicode terms of use | 12 | 0.85
icu | icu | icu license/licence | 16 | 0.9
ietf | ietf | subject to bcp 78 and the ietf trust s legal provisions | 4 | 0.96
naist | nara | nara institute of science and technology | 20 | 0.6
hpnd | permission | permission to use copy modify and distribute this software and its documentation for any purpose | 6 | 0.93
hpnd | historical | historical permission notice and disclaimer | 6 | 0.95
ntp | ntp | ntp license/licence | 17 | 0.9
fsf-all | copying | copying and distribution of this file with or without modification are permitted in any medium without royalty | 4 | 0.96
cc-by | creativecommons | creativecommons org licenses by | 9 | 0.95
cc-by-sa | creativecommons | creativecommons org licenses by sa | 8 | 0.96
cc-by-nc | creativecommons | creativecommons org licenses by nc | 8 | 0.96
cc-by-nd | creativecommons | creativecommons org licenses by nd | 8 | 0.96
cc-by-nc-sa | creativecommons | creativecommons org licenses by nc sa | 7 | 0.97
cc-by-nc-nd | creativecommons | creativecommons org licenses by nc nd | 7 | 0.97
cc0 | creativecommons | creativecommons org publicdomain zero | 7 | 0.97
cc-pdm | creativecommons | creativecommons org publicdomain mark | 7 | 0.97
cc0 | waived | has waived all copyright and related or neighboring rights | 5 | 0.97
cc-by | attribution | this work is licensed under a creative commons attribution | 6 | 0.97
cc-by-sa | sharealike | text is available under the creative commons attribution sharealike license | 4 | 0.98
cc | creative | some rights reserved creative commons | 14 | 0.8
public-domain | domain | released into the public domain | 12 | 0.9
public-domain | domain | dedicated to the public domain | 12 | 0.9
public-domain | domain | this work is in the public domain | 12 | 0.9
public-domain | domain | placed in the public domain | 12 | 0.9
public-domain | reserved | no rights reserved | 13 | 0.85
public-domain | government | work of the united states government | 10 | 0.9
public-domain | gutenberg | project gutenberg license/ebook | 10 | 0.85
proprietary | reserved | all rights reserved | 40 | 0.6
proprietary | derechos | todos los derechos reservados | 40 | 0.6
proprietary | droits | tous droits réservés | 40 | 0.6
proprietary | rechte | alle rechte vorbehalten | 40 | 0.6
proprietary | proprietary | proprietary and confidential | 15 | 0.9
proprietary | confidential | confidential and proprietary | 15 | 0.9
proprietary | copied | may not be copied or distributed without written license/permission | 15 | 0.9
proprietary | reproduced | no part of this publication may be reproduced | 12 | 0.92
proprietary | permission | reproduction without permission is prohibited | 14 | 0.88
proprietary | unauthorized | unauthorized copying of this file via any medium is strictly prohibited | 8 | 0.96
proprietary | trade | contains trade secrets/secret | 18 | 0.8
proprietary | eula | end user license agreement eula | 12 | 0.9
proprietary | commercial | for non commercial use only | 18 | 0.8
proprietary | personal | for personal use only | 22 | 0.65
proprietary | evaluation | for evaluation purposes only | 18 | 0.75
proprietary | redistribute | you may not redistribute | 20 | 0.75
"""


def notices() -> list[tuple[str, str, str, float, float]]:
    """label, keyword, phrase, priority, confidence."""
    rows = (line.split(" | ") for line in NOTICES.strip().splitlines())
    return [(label, keyword, phrase, float(priority), float(confidence)) for label, keyword, phrase, priority, confidence in rows]
