"""Signature rules of the license scan, strongest first.

One rule a line: label | words that must all occur | regular expression. The
expression is matched against lower-case words joined by single blanks, so
``Apache-2.0`` reads ``apache 2 0``; it must begin and end at a word. Rules of
an earlier group, and within a group earlier lines, outrank later ones.
"""

from __future__ import annotations

# identifiers stated by a machine-readable tag
TAGS = r"""
0bsd | spdx | spdx license identifier 0bsd
afl-3.0 | spdx afl | spdx license identifier afl 3 0
agpl-1.0 | spdx agpl | spdx license identifier agpl 1 0( only| or later)?
agpl-3.0 | spdx agpl | spdx license identifier agpl 3 0( only| or later)?
apache-1.1 | spdx apache | spdx license identifier apache 1 1
apache-2.0 | spdx apache | spdx license identifier apache 2 0
artistic-1.0 | spdx artistic | spdx license identifier artistic 1 0( perl| cl8)?
artistic-2.0 | spdx artistic | spdx license identifier artistic 2 0
blueoak-1.0.0 | spdx blueoak | spdx license identifier blueoak 1 0 0
bsd-1-clause | spdx bsd | spdx license identifier bsd 1 clause
bsd-2-clause | spdx bsd | spdx license identifier bsd 2 clause( patent| views)?
bsd-3-clause | spdx bsd | spdx license identifier bsd 3 clause( clear| lbnl)?
bsd-4-clause | spdx bsd | spdx license identifier bsd 4 clause( uc)?
bsl-1.0 | spdx bsl | spdx license identifier bsl 1 0
busl-1.1 | spdx busl | spdx license identifier busl 1 1
cc-by-3.0 | spdx cc | spdx license identifier cc by 3 0
cc-by-4.0 | spdx cc | spdx license identifier cc by 4 0
cc-by-nc-4.0 | spdx cc nc | spdx license identifier cc by nc 4 0
cc-by-nc-nd-4.0 | spdx cc nd | spdx license identifier cc by nc nd 4 0
cc-by-nc-sa-4.0 | spdx cc sa | spdx license identifier cc by nc sa 4 0
cc-by-nd-4.0 | spdx cc nd | spdx license identifier cc by nd 4 0
cc-by-sa-3.0 | spdx cc sa | spdx license identifier cc by sa 3 0
cc-by-sa-4.0 | spdx cc sa | spdx license identifier cc by sa 4 0
cc0-1.0 | spdx cc0 | spdx license identifier cc0 1 0
cddl-1.0 | spdx cddl | spdx license identifier cddl 1 0
cddl-1.1 | spdx cddl | spdx license identifier cddl 1 1
cecill-2.1 | spdx cecill | spdx license identifier cecill 2 1
cecill-b | spdx cecill | spdx license identifier cecill b
cecill-c | spdx cecill | spdx license identifier cecill c
cpal-1.0 | spdx cpal | spdx license identifier cpal 1 0
cpl-1.0 | spdx cpl | spdx license identifier cpl 1 0
ecl-2.0 | spdx ecl | spdx license identifier ecl 2 0
epl-1.0 | spdx epl | spdx license identifier epl 1 0
epl-2.0 | spdx epl | spdx license identifier epl 2 0
eupl-1.1 | spdx eupl | spdx license identifier eupl 1 1
eupl-1.2 | spdx eupl | spdx license identifier eupl 1 2
gfdl-1.2 | spdx gfdl | spdx license identifier gfdl 1 2( only| or later)?
gfdl-1.3 | spdx gfdl | spdx license identifier gfdl 1 3( only| or later)?
gpl-1.0 | spdx gpl | spdx license identifier gpl 1 0( only| or later)?
gpl-2.0 | spdx gpl | spdx license identifier gpl 2 0( only| or later)?( with classpath exception 2 0)?
gpl-3.0 | spdx gpl | spdx license identifier gpl 3 0( only| or later)?( with gcc exception 3 1)?
isc | spdx isc | spdx license identifier isc
lgpl-2.0 | spdx lgpl | spdx license identifier lgpl 2 0( only| or later)?
lgpl-2.1 | spdx lgpl | spdx license identifier lgpl 2 1( only| or later)?
lgpl-3.0 | spdx lgpl | spdx license identifier lgpl 3 0( only| or later)?
mit | spdx mit | spdx license identifier mit
mit-0 | spdx mit | spdx license identifier mit 0
mpl-1.1 | spdx mpl | spdx license identifier mpl 1 1
mpl-2.0 | spdx mpl | spdx license identifier mpl 2 0( no copyleft exception)?
ms-pl | spdx ms | spdx license identifier ms pl
ms-rl | spdx ms | spdx license identifier ms rl
mulanpsl-2.0 | spdx mulanpsl | spdx license identifier mulanpsl 2 0
ncsa | spdx ncsa | spdx license identifier ncsa
odbl-1.0 | spdx odbl | spdx license identifier odbl 1 0
ofl-1.1 | spdx ofl | spdx license identifier ofl 1 1
osl-3.0 | spdx osl | spdx license identifier osl 3 0
php-3.01 | spdx php | spdx license identifier php 3 01
postgresql | spdx postgresql | spdx license identifier postgresql
psf-2.0 | spdx psf | spdx license identifier psf 2 0
sspl-1.0 | spdx sspl | spdx license identifier sspl 1 0
unlicense | spdx unlicense | spdx license identifier unlicense
upl-1.0 | spdx upl | spdx license identifier upl 1 0
wtfpl | spdx wtfpl | spdx license identifier wtfpl
zlib | spdx zlib | spdx license identifier zlib
zpl-2.1 | spdx zpl | spdx license identifier zpl 2 1
"""

# passages of the license texts themselves
PASSAGES = r"""
mit | hereby granted person software | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | substantial portions | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | tort holders | (the software is provided as is without warranty of any kind express or implied.{1,400}?)?in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise
isc | fee hereby | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd | redistribution binary | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd | redistributions retain | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | endorse contributors | neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products derived from this software
bsd-4-clause | advertising acknowledgement | all advertising materials mentioning features or use of this software must display the following acknowledgement
apache-2.0 | irrevocable contributor | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (copyright|except as stated in this section patent) license
apache-2.0 | compliance file license | you may not use this file except in compliance with the license( you may obtain a copy of the license at( https?)? (www )?apache org licenses license 2 0)?
apache-2.0 | unless agreed | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1.1 | apache developed | this product includes software developed by the apache software foundation
gpl | redistribute foundation | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
gpl | merchantability fitness gnu | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu (lesser |library |affero )?general public license for more details
gpl | licenses freedom | the licenses for most software are designed to take away your freedom to share and change it
gpl-3.0 | copyleft gnu | the gnu general public license is a free copyleft license for software and other kinds of works
gpl | foundation write | if not write to the free software foundation inc (51 franklin st(reet)?|59 temple place|675 mass ave)
lgpl | library redistribute | this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license
lgpl-3.0 | incorporates lesser | this version of the gnu lesser general public license incorporates the terms and conditions of version 3
agpl-3.0 | affero network | the gnu affero general public license is a free copyleft license .{1,200}? network server software
agpl | interacting remotely | all users interacting with it remotely through a computer network
mpl-2.0 | mozilla source form | this source code form is subject to the terms of the mozilla public license v( ersion)? ?2 0( if a copy of the mpl was not distributed with this file you can obtain one at)?
mpl-1.1 | mozilla contents | the contents of this file are subject to the mozilla public license version 1 1
epl | accompanying eclipse | this program and the accompanying materials are made available under the terms of the eclipse public license
cddl | development distribution contents | the contents of this file are subject to the terms of the common development and distribution license
bsl-1.0 | hereby organization covered | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
bsl-1.0 | machine executable | works or derivative works are solely in the form of machine executable object code generated by a source language processor
zlib | express authors liable | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | altered misrepresented | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
unlicense | unencumbered domain | this is free and unencumbered software released into the public domain
unlicense | jurisdictions dedicate | in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest
wtfpl | fuck want | do what the fuck you want to( public license)?
beerware | beer ware | the beer ware license
beerware | buy beer | (if we meet some day and you think this stuff is worth it )you can buy me a beer in return
json | evil good | the software shall be used for good not evil
ofl-1.1 | font sil | this font software is licensed under the sil open font license version 1 1
ofl-1.1 | reserved font | no modified version of the font software may use the reserved font name
cc0-1.0 | waived neighboring | to the extent possible under law .{1,120}? has waived all copyright and related or neighboring rights
cc0-1.0 | affirmer overtly | affirmer hereby overtly fully permanently irrevocably and unconditionally waives
cc-by | attribution commons | this work is licensed under (a|the) creative commons attribution( [0-9] [0-9])?( international| unported)?( license)?
cc-by-sa | commons attribution sharealike | this work is licensed under (a|the) creative commons attribution sharealike( [0-9] [0-9])?( international| unported)?( license)?
cc-by-sa | commons attribution share alike | this work is licensed under (a|the) creative commons attribution share alike( [0-9] [0-9])?( international| unported)?( license)?
cc-by-nc | commons attribution licensed | this work is licensed under (a|the) creative commons attribution non ?commercial( [0-9] [0-9])?( international| unported)?( license)?
postgresql | california liable | in no event shall the university of california be liable to any party for direct indirect special incidental or consequential damages
ncsa | illinois developed | developed by .{1,120}? university of illinois
openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
php-3.01 | php freely | this product includes php software freely available from
psf-2.0 | psf python | psf is making python available to licensee on an as is basis
artistic | artistic control | the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control
artistic-2.0 | standard package | the copyright holder intends that the package .{1,120}? standard version
ms-pl | accept software | if you use the software you accept this license if you do not accept the license do not use the software
sspl-1.0 | functionality service | if you make the functionality of the program or a modified version available to third parties as a service
busl-1.1 | licensor production | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
elastic-2.0 | hosted managed | you may not provide the software to third parties as a hosted or managed service
commons-clause | commons clause | the commons clause license condition
odbl-1.0 | database available | this .{1,80}? is made available under the open database license
proprietary | proprietary confidential | (this (software|document|file) (is|contains) )?(proprietary and confidential|confidential and proprietary)( information)?
proprietary | unauthorized copying | unauthorized copying of this file via any medium is strictly prohibited
rights-reserved | rights reserved | (no part of this publication may be reproduced .{1,200}?)?all rights reserved
no-redistribution | reproduced prior | may not be reproduced .{1,80}?without (the )?prior (written )?(permission|consent)
public-domain | public domain | (placed|released|dedicated|is) (in|into|to) the public domain
"""

# named with a version, as notices do
NOTICES = r"""
gpl-3.0 | gnu gpl 3 | gnu gpl (version |v )?3( 0)?( or later)?
gpl-3.0 | gnu general 3 | gnu general public license( gpl)? (as published by the free software foundation )?(either )?(version |v )?3( 0)?( of the license)?( or (at your option )?any later version)?
gpl-2.0 | gnu general 2 | gnu general public license( gpl)? (as published by the free software foundation )?(either )?(version |v )?2( 0)?( of the license)?( or (at your option )?any later version)?
gpl-1.0 | gnu general 1 | gnu general public license( gpl)? (version |v )?1( 0)?
gpl-3.0 | gplv3 | (gnu )?gplv3( or later)?
gpl-2.0 | gplv2 | (gnu )?gplv2( or later)?
gpl-3.0 | gpl 3 | gpl (version )?3( 0)?( only| or later)?
gpl-2.0 | gpl 2 | gpl (version )?2( 0)?( only| or later)?
gpl-2.0-classpath | classpath exception | (gpl (version )?2 with (the )?)?classpath exception
lgpl-3.0 | lesser 3 | (gnu )?lesser general public license( lgpl)? (version |v )?3( 0)?( or later)?
lgpl-2.1 | lesser 1 | (gnu )?lesser general public license( lgpl)? (version |v )?2 1( or later)?
lgpl-2.0 | library 2 | (gnu )?library general public license( lgpl)? (version |v )?2( 0)?( or later)?
lgpl-3.0 | lgplv3 | lgplv3( or later)?
lgpl-2.1 | lgplv2 | lgplv2( 1)?( or later)?
lgpl-3.0 | lgpl 3 | lgpl (version )?3( 0)?( only| or later)?
lgpl-2.1 | lgpl 1 | lgpl (version )?2 1( only| or later)?
agpl-3.0 | affero 3 | (gnu )?affero general public license( agpl)? (version |v )?3( 0)?( or later)?
agpl-3.0 | agplv3 | agplv3( or later)?
agpl-3.0 | agpl 3 | agpl (version )?3( 0)?( only| or later)?
gfdl-1.3 | documentation 3 | (gnu )?free documentation license (version |v )?1 3( or (any )?later( version)?)?
gfdl-1.2 | documentation 2 | (gnu )?free documentation license (version |v )?1 2( or (any )?later( version)?)?
apache-2.0 | apache 2 | (licensed under the )?apache (software )?license( version| v)? 2( 0)?
apache-1.1 | apache 1 | apache (software )?license( version| v)? 1 1
apache-1.0 | apache 1 | apache (software )?license( version| v)? 1 0
apache-2.0 | apache2 | apache2( license)?
apache-2.0 | apache 2 | apache 2( 0)?( license)?
apache-2.0 | asl 2 | asl 2 0
mpl-2.0 | mozilla 2 | mozilla public license( mpl)?( version| v)? 2( 0)?
mpl-1.1 | mozilla 1 | mozilla public license( mpl)?( version| v)? 1 1
mpl-1.0 | mozilla 1 | mozilla public license( mpl)?( version| v)? 1 0
mpl-2.0 | mpl 2 | mpl (version |v )?2 0
epl-2.0 | eclipse 2 | eclipse public license( epl)?( version| v)? 2( 0)?
epl-1.0 | eclipse 1 | eclipse public license( epl)?( version| v)? 1( 0)?
epl-2.0 | epl 2 | epl (version |v )?2 0
edl-1.0 | eclipse distribution | eclipse distribution license( edl)?( version| v)? 1( 0)?
cddl-1.1 | cddl 1 | cddl( version| v)? 1 1
cddl-1.1 | development distribution 1 | common development and distribution license( cddl)?( version| v)? 1 1
cddl-1.0 | development distribution 1 | common development and distribution license( cddl)?( version| v)? 1( 0)?
bsd-2-clause | bsd 2 | bsd 2 clause( license)?
bsd-3-clause | bsd 3 | bsd 3 clause( license)?
bsd-4-clause | bsd 4 | bsd 4 clause( license)?
bsd-2-clause | bsd simplified | simplified bsd license
bsd-2-clause | bsd freebsd | freebsd bsd license
bsd-2-clause | bsd clause | (two|2) clause bsd license
bsd-3-clause | bsd modified | modified bsd license
bsd-3-clause | bsd revised | revised bsd license
bsd-3-clause | bsd clause | (three clause|3 clause) bsd license
bsd-3-clause | bsd new | new bsd license
bsd-4-clause | bsd original | original bsd license
bsd-4-clause | bsd clause | (four|4) clause bsd license
bsd-4-clause | bsd old | old bsd license
0bsd | bsd zero | zero clause bsd( license)?
artistic-2.0 | artistic 2 | artistic license( version| v)? 2( 0)?
artistic-1.0 | artistic 1 | artistic license( version| v)? 1( 0)?
bsl-1.0 | boost software | boost software license( version| v)?( 1 0)?
eupl-1.2 | eupl 2 | eupl( version| v)? 1 2
eupl-1.2 | european 2 | european union public licen[cs]e( eupl)?( version| v)? 1 2
eupl-1.1 | eupl 1 | eupl( version| v)? 1 1
eupl-1.1 | european 1 | european union public licen[cs]e( eupl)?( version| v)? 1 1
ofl-1.1 | sil | sil (open font license|ofl)( version| v)?( 1 1)?
osl-3.0 | open 3 | open software license( version| v)? 3 0
afl-3.0 | academic 3 | academic free license( version| v)? 3 0
cpl-1.0 | common 1 | common public license( version| v)? 1 0
ecl-2.0 | educational 2 | educational community license( version| v)? 2 0
zpl-2.1 | zope 2 | zope public license( version| v)? 2 1
upl-1.0 | universal permissive | universal permissive license( version| v)?( 1 0)?
sspl-1.0 | server side | server side public license( version| v)?( 1)?
busl-1.1 | business source | business source license( version| v)?( 1 1)?
elastic-2.0 | elastic | elastic license( version| v)?( 2( 0)?)?
polyform | polyform | polyform (noncommercial|small business|shield|perimeter|strict|free trial|internal use) license( 1 0 0)?
openrail | openrail | (creativeml |bigscience )?openrail( m| plus plus m)?( license)?
openrail | open rail | (creativeml |bigscience )?open rail( m| plus plus m)?( license)?
rail | responsible ai | responsible ai license( rail)?
llama | llama community | llama ([0-9] )*community license( agreement)?
cc-by-nc-nd-4.0 | cc nc nd 4 | cc by nc nd 4( 0)?
cc-by-nc-nd | cc nc nd | cc by nc nd( [123] [05])?
cc-by-nc-sa-4.0 | cc nc sa 4 | cc by nc sa 4( 0)?
cc-by-nc-sa | cc nc sa | cc by nc sa( [123] [05])?
cc-by-nc-4.0 | cc nc 4 | cc by nc 4( 0)?
cc-by-nc | cc nc | cc by nc( [123] [05])?
cc-by-nd-4.0 | cc nd 4 | cc by nd 4( 0)?
cc-by-nd | cc nd | cc by nd( [123] [05])?
cc-by-sa-4.0 | cc sa 4 | cc by sa 4( 0)?
cc-by-sa-3.0 | cc sa 3 | cc by sa 3( 0)?
cc-by-sa | cc sa | cc by sa( [12] [05])?
cc-by-4.0 | cc by 4 | cc by 4( 0)?
cc-by-3.0 | cc by 3 | cc by 3( 0)?
cc-by-2.5 | cc by 2 5 | cc by 2 5
cc-by-2.0 | cc by 2 | cc by 2( 0)?
cc0-1.0 | cc0 | cc0( 1 0)?( universal)?( public domain dedication)?
cc-by-nc-nd | commons attribution creative | creative commons attribution non ?commercial no ?deriv(ative)?s?( works)?( [1-4] [05])?
cc-by-nc-nd | commons noncommercial noderivatives | creative commons attribution noncommercial noderivatives( [1-4] [05])?
cc-by-nc-sa | commons attribution creative | creative commons attribution non ?commercial share ?alike( [1-4] [05])?
cc-by-nc | commons attribution creative | creative commons attribution non ?commercial( [1-4] [05])?
cc-by-sa | commons attribution alike | creative commons attribution share alike( [1-4] [05])?
cc-by-sa | commons sharealike | creative commons attribution sharealike( [1-4] [05])?
cc-by-nd | commons attribution creative | creative commons attribution no ?derivatives( [1-4] [05])?
cc-by-nd | commons noderivs | creative commons attribution noderivs( [1-4] [05])?
cc-by-4.0 | commons attribution 4 | creative commons attribution 4 0( international)?
cc-by-3.0 | commons attribution 3 | creative commons attribution 3 0( unported)?
cc-by | commons attribution | creative commons attribution( license)?
pddl-1.0 | domain dedication | (open data commons )?public domain dedication and license( pddl)?( version| v)?( 1 0)?
odbl-1.0 | database commons | open data commons open database license( odbl)?( version| v)?( 1 0)?
odc-by-1.0 | odc by | odc by( version| v)?( 1 0)?
odc-by-1.0 | commons attribution data | open data commons attribution license( odc by)?( version| v)?( 1 0)?
ogl-3.0 | government 3 | open government licen[cs]e( version| v)? 3 0
ogl-2.0 | government 2 | open government licen[cs]e( version| v)? 2 0
cdla-permissive-2.0 | cdla 2 | cdla permissive( version| v)? 2 0
cdla-permissive-2.0 | community data permissive | community data license agreement permissive( version| v)? 2 0
cdla-permissive-1.0 | cdla 1 | cdla permissive( version| v)? 1 0
cdla-permissive-1.0 | community data permissive | community data license agreement permissive( version| v)? 1 0
cdla-sharing-1.0 | cdla sharing | cdla sharing( version| v)?( 1 0)?
cdla-sharing-1.0 | community data sharing | community data license agreement sharing( version| v)?( 1 0)?
etalab-2.0 | etalab 2 | etalab 2 0
dl-de-by-2.0 | datenlizenz | datenlizenz deutschland namensnennung( version)? 2 0
"""

# addresses
ADDRESSES = r"""
apache-2.0 | apache licenses | (https? )?(www )?apache org licenses license 2 0( txt| html)?
gpl-3.0 | gnu licenses 3 | (https? )?(www )?gnu org licenses gpl 3 0( txt| html| en html)?
gpl-2.0 | gnu licenses 2 | (https? )?(www )?gnu org licenses (old licenses )?gpl 2 0( txt| html| en html)?
lgpl-3.0 | gnu licenses lgpl | (https? )?(www )?gnu org licenses lgpl 3 0( txt| html| en html)?
lgpl-2.1 | gnu licenses 1 | (https? )?(www )?gnu org licenses (old licenses )?lgpl 2 1( txt| html| en html)?
agpl-3.0 | gnu licenses agpl | (https? )?(www )?gnu org licenses agpl 3 0( txt| html| en html)?
gfdl | gnu fdl | (https? )?(www )?gnu org (licenses|copyleft) fdl( 1 [23])?( txt| html| en html)?
gpl | gnu org | (https? )?(www )?gnu org (licenses|copyleft)( gpl)?( txt| html| en html)?
mpl-2.0 | mozilla mpl 2 | (https? )?(www )?mozilla org (en us )?mpl 2 0
mpl-1.1 | mozilla mpl 1 | (https? )?(www )?mozilla org mpl (mpl )?1 1( txt| html)?
epl-2.0 | eclipse epl | (https? )?(www )?eclipse org (legal|org documents) epl (v20|2 0)( txt| html)?
epl-1.0 | eclipse legal | (https? )?(www )?eclipse org legal epl v10( txt| html)?
mit | opensource mit | (https? )?(www )?opensource org licenses mit( license)?( php)?
bsd-3-clause | opensource bsd 3 | (https? )?(www )?opensource org licenses bsd 3 clause
bsd-2-clause | opensource bsd 2 | (https? )?(www )?opensource org licenses bsd 2 clause
isc | opensource isc | (https? )?(www )?opensource org licenses isc
artistic | opensource artistic | (https? )?(www )?opensource org licenses artistic license( [12] 0)?( php)?
bsl-1.0 | boost license | (https? )?(www )?boost org license 1 0( txt)?
cc-by-nc-nd | creativecommons nc nd | (https? )?(www )?creativecommons org licenses by nc nd [1-4] [05]
cc-by-nc-sa | creativecommons nc sa | (https? )?(www )?creativecommons org licenses by nc sa [1-4] [05]
cc-by-nc | creativecommons nc | (https? )?(www )?creativecommons org licenses by nc [1-4] [05]
cc-by-nd | creativecommons nd | (https? )?(www )?creativecommons org licenses by nd [1-4] [05]
cc-by-sa | creativecommons sa | (https? )?(www )?creativecommons org licenses by sa [1-4] [05]
cc-by | creativecommons by | (https? )?(www )?creativecommons org licenses by [1-4] [05]
cc0-1.0 | creativecommons zero | (https? )?(www )?creativecommons org publicdomain zero 1 0
public-domain-mark | creativecommons mark | (https? )?(www )?creativecommons org publicdomain mark 1 0
unlicense | unlicense | (https? )?(www )?unlicense org
wtfpl | wtfpl | (https? )?(www )?wtfpl net
ofl-1.1 | scripts ofl | (https? )?scripts sil org ofl
odbl-1.0 | opendatacommons odbl | (https? )?(www )?opendatacommons org licenses odbl
pddl-1.0 | opendatacommons pddl | (https? )?(www )?opendatacommons org licenses pddl
cddl | opensource licenses | (https? )?(www )?opensource org licenses cddl( ?1 0)?( php)?
"""

# names alone, the weakest evidence; the last four are the base phrases
NAMES = r"""
agpl | affero | (gnu )?affero general public license
lgpl | lesser | (gnu )?lesser general public license
lgpl | library gnu | gnu library general public license
gfdl | documentation | (gnu )?free documentation license
apache | apache software | apache software license
asl | asl | licensed under (the )?asl
mpl | mozilla | mozilla public license
epl | eclipse | eclipse public license
cddl | development distribution | common development and distribution license
cpl | common | common public license
bsd | bsd | bsd (style )?licen[cs]e
bsd | bsd licensed | bsd licensed
mit | mit licensed | mit licensed
mit | expat | expat license
mit | x11 | (mit )?x11 license
mit | mit style | mit style license
isc | isc | isc license
zlib | zlib | zlib( libpng)? license
artistic | artistic | artistic license
perl | perl terms | (the )?same terms as perl( itself)?
python | python | python (software foundation )?license
ruby | ruby | ruby license
php | php | php license
openssl | openssl | openssl license
vim | vim | vim license
unicode | unicode | unicode (license|terms of use)
postgresql | postgresql | postgresql license
ncsa | ncsa | (university of illinois )?ncsa( open source)? license
wtfpl | wtfpl | wtfpl
unlicense | unlicense | (the )?unlicense
eupl | eupl | eupl
eupl | european | european union public licen[cs]e
cecill | cecill | cecill( [bc])?( licen[cs]e)?
ms-pl | microsoft | microsoft public license
ms-rl | microsoft reciprocal | microsoft reciprocal license
ofl | font | open font license
osl | open | open software license
afl | academic | academic free license
sspl | sspl | sspl
gpl | gpl licensed | gpl licensed
gpl | gpl | (released |licensed |distributed )?under (the )?(gnu )?gpl
creative-commons | commons | creative commons( license)?
copyleft | copyleft | copyleft( license)?
odbl | database | open database license
ogl | government | open government licen[cs]e
eula | eula | eula
eula | end user agreement | end user license agreement( eula)?
shareware | shareware | shareware
freeware | freeware | freeware
copyright-notice | copyright | (copyright c|c copyright|copyright) (19|20)[0-9][0-9]( (19|20)[0-9][0-9])*
all-rights-reserved | rights | all rights reserved
gpl | gnu general public license | gnu general public license
apache | apache license | apache license
cc-by | cc by | cc by
mit | mit license | mit license
"""

# (group, confidence of one detection)
GROUPS = [(TAGS, 0.99), (PASSAGES, 0.95), (NOTICES, 0.9), (ADDRESSES, 0.85), (NAMES, 0.6)]

# The phrases that are always counted, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
