"""Hand-written license signatures, in order of priority.

A line holds: label | keyword | regular expression. Expressions match normalised texts: words of
letters, digits and non-ASCII characters, lower-cased (A-Z) and joined by one space, so "GPL-3.0"
reads "gpl 3 0". They match at word boundaries and are tried only on texts that hold the keyword.
Full texts and notices come first, then identifiers, then names; earlier lines win.
"""

RULES = r"""
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0 | permission is hereby granted | permission is hereby granted free of charge .{0,400}? without restriction including without limitation .{0,300}? to permit persons to whom the software is furnished to do so the software is provided
isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
0bsd | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?! provided)
hpnd | permission to use copy modify | permission to use copy modify and distribute this software and its documentation for any purpose( and)? without fee is hereby granted
bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-3-clause | endorse or promote | neither the names? of .{1,120}? may be used to endorse or promote products derived from this software without specific prior written permission
bsd-2-clause | redistributions in binary form | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-1-clause | redistributions of source code | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer this software is provided
zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
apache-2.0 | terms and conditions for use | apache license version 2 0 january 2004 .{0,80}? terms and conditions for use reproduction and distribution
apache-2.0 | licensed under the apache | licensed under the apache license version 2( 0)? the license you may not use this file except in compliance with the license
apache-2.0 | apache | (licensed|released|distributed|available) under( the terms of)?( the)? apache( software)? license,? version 2( 0)?
apache-2.0 | apache | apache license( version)? 2( 0)?
apache-1.1 | apache | apache( software)? license( version)? 1 1
apache-1.0 | apache | apache( software)? license( version)? 1 0
apache-2.0 | apache | apache 2( 0)?( license)?
agpl-3.0-or-later | affero | gnu affero general public license as published by .{1,60}? either version 3 of the license or( at your option)? any later version
agpl-3.0-only | affero | gnu affero general public license (as published by the free software foundation )?version 3( only)?
agpl-3.0 | affero | gnu affero general public license( v| version)? ?3( 0)?
agpl-1.0 | affero | affero general public license( version)? 1( 0)?
agpl | affero | (gnu )?affero (general )?public license
lgpl-3.0-or-later | lesser | gnu lesser general public license as published by .{1,60}? either version 3 of the license or( at your option)? any later version
lgpl-2.1-or-later | lesser | gnu lesser general public license as published by .{1,60}? either version 2 1 of the license or( at your option)? any later version
lgpl-2.0-or-later | library general | gnu library general public license as published by .{1,60}? either version 2 of the license or( at your option)? any later version
lgpl-3.0 | lesser | gnu lesser general public license( v| version)? ?3( 0)?
lgpl-2.1 | lesser | gnu lesser general public license( v| version)? ?2 1
lgpl-2.0 | library general | gnu library general public license( v| version)? ?2( 0)?
lgpl | lesser | (gnu )?lesser general public license
lgpl | library general | (gnu )?library general public license
gfdl-1.3 | free documentation | gnu free documentation license( v| version)? ?1 3
gfdl-1.2 | free documentation | gnu free documentation license( v| version)? ?1 2
gfdl-1.1 | free documentation | gnu free documentation license( v| version)? ?1 1
gfdl | free documentation | (gnu )?free documentation license
gpl-3.0-or-later | general public license | gnu general public license as published by .{1,60}? either version 3 of the license or( at your option)? any later version
gpl-2.0-or-later | general public license | gnu general public license as published by .{1,60}? either version 2 of the license or( at your option)? any later version
gpl-1.0-or-later | general public license | gnu general public license as published by .{1,60}? either version 1 or( at your option)? any later version
gpl-2.0-with-classpath-exception | classpath exception | (gnu )?general public license.{0,80}? with( the)? classpath exception
gpl-3.0-with-gcc-exception | runtime library exception | (gnu )?general public license.{0,120}? gcc runtime library exception
gpl-3.0-or-later | general public license | gnu general public license( v| version)? ?3( 0)? or( any)? later
gpl-2.0-or-later | general public license | gnu general public license( v| version)? ?2( 0)? or( any)? later
gpl-3.0-only | general public license | gnu general public license( v| version)? ?3( 0)? only
gpl-2.0-only | general public license | gnu general public license( v| version)? ?2( 0)? only
gpl-3.0 | general public license | gnu general public license( v| version)? ?3( 0)?
gpl-2.0 | general public license | gnu general public license( v| version)? ?2( 0)?
gpl-1.0 | general public license | gnu general public license( v| version)? ?1( 0)?
gpl-3.0 | general public license | version 3( 0)? of the gnu general public license
gpl-2.0 | general public license | version 2( 0)? of the gnu general public license
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | mozilla | mozilla public license( v| version)? ?2( 0)?
mpl-1.1 | mozilla | mozilla public license( v| version)? ?1 1
mpl-1.0 | mozilla | mozilla public license( v| version)? ?1 0
mpl | mozilla | mozilla public license
epl-2.0 | eclipse | eclipse public license( v| version)? ?2( 0)?
epl-1.0 | eclipse | eclipse public license( v| version)? ?1( 0)?
epl | eclipse | eclipse public license
edl-1.0 | eclipse | eclipse distribution license( v| version)?( 1 0)?
cddl-1.1 | common development | common development and distribution license( cddl)?( v| version)? ?1 1
cddl-1.0 | common development | common development and distribution license( cddl)?( v| version)? ?1 0
cddl | common development | common development and distribution license
cpl-1.0 | common public license | common public license( v| version)?( 1 0)?
ipl-1.0 | ibm public | ibm public license( v| version)?( 1 0)?
eupl-1.2 | european union public | european union public licen[cs]e( v| version)? ?1 2
eupl-1.1 | european union public | european union public licen[cs]e( v| version)? ?1 1
eupl | european union public | european union public licen[cs]e
cecill-2.1 | cecill | cecill( free software license agreement)?( v| version)? ?2 1
cecill-b | cecill | cecill b( license)?
cecill-c | cecill | cecill c( license)?
cecill | cecill | cecill( license)?
artistic-2.0 | artistic | (the )?artistic license( v| version)? ?2( 0)?
artistic-1.0 | artistic | (the )?artistic license( v| version)? ?1( 0)?
artistic | artistic license | (the )?artistic license
bsl-1.0 | boost software | boost software license( v| version)?( 1 0)?
busl-1.1 | business source | business source license( v| version)?( 1 1)?
sspl-1.0 | server side public | server side public license( v| version)?( 1( 0)?)?
elastic-2.0 | elastic license | elastic license( v| version)? ?2( 0)?
elastic | elastic license | elastic license
commons-clause | commons clause | commons clause( license condition)?( v1 0)?
polyform-noncommercial-1.0.0 | polyform | polyform noncommercial license( 1 0 0)?
polyform-small-business-1.0.0 | polyform | polyform small business license( 1 0 0)?
polyform-shield-1.0.0 | polyform | polyform shield license( 1 0 0)?
unlicense | unencumbered software | this is free and unencumbered software released into the public domain
unlicense | unlicense | (the )?unlicense
wtfpl | what the fuck | do what the fuck you want to( public license)?
wtfpl | wtfpl | wtfpl
beerware | beer ware | (the )?beer ware license
postgresql | postgresql | (the )?postgresql license
python-2.0 | python software foundation | python software foundation license( v| version)?( 2)?
php-3.01 | php license | (the )?php license( v| version)? 3 01
php-3.0 | php license | (the )?php license( v| version)? 3 0
php | php license | (the )?php license
ruby | ruby license | (the )?ruby license
openssl | openssl | openssl license
ssleay | ssleay | (original )?ssleay license
openldap | openldap | openldap public license( version)?( 2 8)?
w3c | w3c software | w3c software( and document)? (notice and )?license
x11 | x11 license | (mit )?x11 license
ncsa | university of illinois | university of illinois( ncsa)? open source license
afl-3.0 | academic free | academic free license( v| version)? ?3( 0)?
afl-2.1 | academic free | academic free license( v| version)? ?2 1
afl | academic free | academic free license
osl-3.0 | open software license | open software license( v| version)? ?3( 0)?
osl | open software license | open software license
apsl-2.0 | apple public | apple public source license( v| version)?( 2( 0)?)?
ms-pl | microsoft public | microsoft public license( ms pl)?
ms-rl | microsoft reciprocal | microsoft reciprocal license( ms rl)?
ecl-2.0 | educational community | educational community license( v| version)?( 2( 0)?)?
upl-1.0 | universal permissive | universal permissive license( v| version)?( 1( 0)?)?
bsd-3-clause-clear | clear bsd | clear bsd license
mulan-psl-2.0 | mulan | mulan permissive software license( v| version)? ?2
mulan-psl | mulan | mulan permissive software license
lppl-1.3c | latex project | latex project public license( v| version)? ?1 3c?
lppl | latex project | latex project public license
ofl-1.1 | open font | (sil )?open font license( v| version)?( 1 1)?
vim | vim license | (the )?vim license
curl | curl license | (the )?curl license
libpng | libpng license | (the )?libpng license( version)?( 2)?
ijg | independent jpeg | independent jpeg group license
info-zip | info zip | info zip license
bzip2 | bzip2 license | bzip2( and libbzip2)? license
unicode-dfs-2016 | unicode license | unicode license( agreement)?( v| version)?( 3)?
sleepycat | sleepycat | sleepycat license
qpl-1.0 | q public | q public license( version)?( 1 0)?
zpl-2.1 | zope public | zope public license( v| version)? ?2 1
zpl | zope public | zope public license
sgi-b-2.0 | sgi free | sgi free software license b( version)?( 2 0)?
rpl-1.5 | reciprocal public | reciprocal public license( version)?( 1 5)?
watcom-1.0 | sybase open watcom | sybase open watcom public license
nposl-3.0 | non profit open | non profit open software license( 3 0)?
intel | intel open source | intel open source license
nokia | nokia open source | nokia open source license
ngpl | nethack | nethack general public license
cpal-1.0 | common public attribution | common public attribution license( version)?( 1 0)?
odbl-1.0 | open database | open database license( v| version)?( 1 0)?
odc-by-1.0 | open data commons attribution | open data commons attribution license( v1 0)?
pddl-1.0 | public domain dedication and license | (open data commons )?public domain dedication and license( 1 0)?
cdla-permissive-2.0 | community data license | community data license agreement permissive( version)? 2( 0)?
cdla-permissive-1.0 | community data license | community data license agreement permissive( version)?( 1 0)?
cdla-sharing-1.0 | community data license | community data license agreement sharing( version)?( 1 0)?
ogl-uk-3.0 | open government | open government licen[cs]e( v| version)? ?3( 0)?
ogl-uk | open government | open government licen[cs]e
etalab-2.0 | licence ouverte | licence ouverte( open license)?( etalab)?( 2 0)?
cc0-1.0 | cc0 | cc0 1 0( universal)?
cc0-1.0 | creative commons zero | creative commons zero( v1 0)?( universal)?
cc0-1.0 | no rights reserved | no rights reserved
cc0-1.0 | cc0 | cc0
cc-by-nc-nd-4.0 | noncommercial noderiv | creative commons attribution noncommercial noderiv(ative)?s?( works)? 4 0( international)?
cc-by-nc-nd-3.0 | noncommercial noderiv | creative commons attribution noncommercial noderiv(ative)?s?( works)? 3 0( unported)?
cc-by-nc-nd | noncommercial noderiv | creative commons attribution noncommercial noderiv(ative)?s?
cc-by-nc-sa-4.0 | noncommercial share | creative commons attribution noncommercial share ?alike 4 0( international)?
cc-by-nc-sa-3.0 | noncommercial share | creative commons attribution noncommercial share ?alike 3 0( unported)?
cc-by-nc-sa | noncommercial share | creative commons attribution noncommercial share ?alike
cc-by-nc-4.0 | attribution noncommercial | creative commons attribution noncommercial 4 0( international)?
cc-by-nc-3.0 | attribution noncommercial | creative commons attribution noncommercial 3 0( unported)?
cc-by-nc | attribution noncommercial | creative commons attribution noncommercial
cc-by-nd-4.0 | attribution noderiv | creative commons attribution noderiv(ative)?s? 4 0( international)?
cc-by-nd | attribution noderiv | creative commons attribution noderiv(ative)?s?
cc-by-sa-4.0 | attribution share | creative commons attribution share ?alike 4 0( international)?
cc-by-sa-3.0 | attribution share | creative commons attribution share ?alike 3 0( unported)?
cc-by-sa-2.5 | attribution share | creative commons attribution share ?alike 2 5( generic)?
cc-by-sa | attribution share | creative commons attribution share ?alike
cc-by-4.0 | creative commons attribution | creative commons attribution 4 0( international)?
cc-by-3.0 | creative commons attribution | creative commons attribution 3 0( unported)?
cc-by-2.0 | creative commons attribution | creative commons attribution 2 0( generic)?
cc-by | creative commons attribution | creative commons attribution
cc-by-nc-nd-4.0 | cc by | cc by nc nd 4 0
cc-by-nc-nd-3.0 | cc by | cc by nc nd 3 0
cc-by-nc-nd | cc by | cc by nc nd
cc-by-nc-sa-4.0 | cc by | cc by nc sa 4 0
cc-by-nc-sa-3.0 | cc by | cc by nc sa 3 0
cc-by-nc-sa | cc by | cc by nc sa
cc-by-nc-4.0 | cc by | cc by nc 4 0
cc-by-nc-3.0 | cc by | cc by nc 3 0
cc-by-nc | cc by | cc by nc
cc-by-nd-4.0 | cc by | cc by nd 4 0
cc-by-nd | cc by | cc by nd
cc-by-sa-4.0 | cc by | cc by sa 4 0
cc-by-sa-3.0 | cc by | cc by sa 3 0
cc-by-sa | cc by | cc by sa
cc-by-4.0 | cc by | cc by 4 0
cc-by-3.0 | cc by | cc by 3 0
public-domain | public domain | (released|dedicated|placed|donated)( in)?( to)?( into)? the public domain
public-domain | public domain | this (work|software|file|text|document) is( in)? the public domain
mit | spdx license identifier | spdx license identifier mit
apache-2.0 | spdx license identifier | spdx license identifier apache 2 0
bsd-2-clause | spdx license identifier | spdx license identifier bsd 2 clause
bsd-3-clause | spdx license identifier | spdx license identifier bsd 3 clause
isc | spdx license identifier | spdx license identifier isc
gpl-2.0-or-later | spdx license identifier | spdx license identifier gpl 2 0 or later
gpl-2.0-only | spdx license identifier | spdx license identifier gpl 2 0( only)?
gpl-3.0-or-later | spdx license identifier | spdx license identifier gpl 3 0 or later
gpl-3.0-only | spdx license identifier | spdx license identifier gpl 3 0( only)?
lgpl-2.1 | spdx license identifier | spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0 | spdx license identifier | spdx license identifier lgpl 3 0( only| or later)?
agpl-3.0 | spdx license identifier | spdx license identifier agpl 3 0( only| or later)?
mpl-2.0 | spdx license identifier | spdx license identifier mpl 2 0
epl-2.0 | spdx license identifier | spdx license identifier epl 2 0
cc-by-4.0 | spdx license identifier | spdx license identifier cc by 4 0
cc0-1.0 | spdx license identifier | spdx license identifier cc0 1 0
unlicense | spdx license identifier | spdx license identifier unlicense
zlib | spdx license identifier | spdx license identifier zlib
0bsd | spdx license identifier | spdx license identifier 0bsd
agpl-3.0 | agpl | (gnu )?agpl ?v?3( 0)?
lgpl-2.1 | lgpl | (gnu )?lgpl ?v?2 1
lgpl-3.0 | lgpl | (gnu )?lgpl ?v?3( 0)?
gpl-3.0-or-later | gpl | (gnu )?gpl ?v?3( 0)? or later
gpl-2.0-or-later | gpl | (gnu )?gpl ?v?2( 0)? or later
gpl-3.0 | gpl | (gnu )?gpl ?v?3( 0)?
gpl-2.0 | gpl | (gnu )?gpl ?v?2( 0)?
bsd-2-clause | bsd | (simplified|freebsd|two clause|2 clause) bsd license|bsd 2 clause( license)?
bsd-3-clause | bsd | (modified|revised|new|three clause|3 clause) bsd license|bsd 3 clause( license)?
bsd-4-clause | bsd | (original|old|four clause|4 clause) bsd license|bsd 4 clause( license)?
0bsd | bsd | (zero clause|0) bsd license|bsd zero clause( license)?
bsd | bsd | bsd style license|bsd license
isc | isc license | (the )?isc license
zlib | zlib | (the )?zlib( libpng)? license
mit | mit | (licensed|released|distributed|available) under( the terms of)? the mit license
mit | expat | (mit )?expat license
mit-0 | no attribution | mit no attribution
mit | mit license | (the )?mit license
gpl | general public license | gnu general public license|general public license
apache | apache | apache license
cc-by | cc by | cc by
proprietary | all rights reserved | all rights reserved
proprietary | confidential | (proprietary and confidential|confidential and proprietary)( information)?
proprietary | not sold | this software is licensed( and)? not sold
eula | end user licen | end user licen[cs]e agreement
non-commercial | non commercial | for non commercial( use)? only|non commercial use only
research-only | research purposes | for research purposes only
"""
