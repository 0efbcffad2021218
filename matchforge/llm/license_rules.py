"""Signature rules of licenses, in order of rank inside each kind.

Texts are matched as lower-case words with single spaces between, so a rule is written
in such words: ``2.0`` is ``2 0``, an address is its parts. A block names a label and the
keyword without which none of its rules can match; a line may name its own keyword in
brackets. The sign says what a match is:

``!`` words of the license or of its grant, ``@`` an address, ``=`` a name, ``?`` a hint.

``<l>`` stands for license or licence, ``<v>`` for version, v or nothing, ``<o>`` for an optional
"or later". Tags (``SPDX-License-Identifier``) are made by rule from the labels.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

SIGNATURES = r"""
apache-2.0: apache
! licensed under (?:the )?apache <l> <v>2(?: 0)?
! may not use this (?:file|work|software) except in compliance with the <l> you may obtain a copy of the <l> at http www apache org
@ apache org licenses license 2 0
@ opensource org licenses? apache 2 0
= apache (?:software )?(?:foundation )?<l> <v>2(?: 0)?
= apache <v>2 0
= asl <v>2 0 [ asl ]
apache-1.1: apache
= apache (?:software )?<l> <v>1 1
@ apache org licenses license 1 1
! products derived from this software may not be called apache
apache-1.0: apache
= apache (?:software )?<l> <v>1 0
@ apache org licenses license 1 0
mit: mit
! permission is hereby granted free of charge to any person obtaining a copy of this software [ hereby granted]
! the above copyright notice and this permission notice shall be included in all copies or substantial portions [ substantial portions]
! (?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?mit <l>
@ opensource org licenses? mit(?: license php)?
= mit x11 <l>
= expat <l> [ expat ]
= mit <l>
= mit licensed
mit-0: mit
= mit no attribution(?: <l>)?
= mit 0(?: <l>)?
@ opensource org licenses? mit 0
x11: x11
= x11 <l>
! name of the x consortium shall not be used in advertising [ x consortium]
isc: isc
! permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted [ with or without fee]
@ opensource org licenses? isc(?: license(?: txt)?)?
= isc <l>
= internet (?:systems|software) consortium <l> [ consortium]
bsd-2-clause: bsd
= bsd 2 clauses?(?: <l>)?
= (?:2|two) clauses? bsd(?: <l>)?
= simplified bsd(?: <l>)?
= freebsd <l> [ freebsd ]
@ opensource org licenses? bsd 2 clause
bsd-3-clause: bsd
! neither the name of (?:the )?(?:[^ ]+ ){1,8}nor the names of (?:its|the|any)(?: other)? contributors may be used to endorse [ endorse ]
= bsd 3 clauses?(?: <l>)?
= (?:3|three) clauses? bsd(?: <l>)?
= (?:new|modified|revised) bsd(?: <l>)?
@ opensource org licenses? bsd 3 clause
bsd-4-clause: bsd
! all advertising materials mentioning features or use of this software must display [ advertising materials]
= bsd 4 clauses?(?: <l>)?
= (?:4|four) clauses? bsd(?: <l>)?
= (?:original|old) bsd(?: <l>)?
bsd: bsd
! redistribution and use in source and binary forms with or without modification are permitted [ redistribution ]
! redistributions of source code must retain the above copyright notice [ redistributions ]
@ opensource org licenses? bsd license php
= bsd(?: style)? <l>
0bsd: bsd
= bsd zero clause(?: <l>)?
= (?:0|zero) clause bsd
gpl-1.0: gpl
= gnu general public <l> <v>1(?: 0)?<o> [ general public ]
= (?:gnu )?gpl <v>1(?: 0)?<o>
gpl-2.0: gpl
! terms of the gnu general public <l> as published by the free software foundation <v>2 [ gnu ]
! either version 2 of the <l> or at your option any later version [ version 2 ]
@ gnu org licenses (?:old licenses )?gpl 2 0
@ gnu org copyleft gpl [ copyleft ]
= (?:gnu )?general public <l> <v>2(?: 0)?<o> [ general public ]
= (?:gnu )?gpl <v>2(?: 0)?<o>
= gplv2<o> [ gplv2]
gpl-3.0: gpl
! either version 3 of the <l> or at your option any later version [ version 3 ]
@ gnu org licenses gpl 3 0
= (?:gnu )?general public <l> <v>3(?: 0)?<o> [ general public ]
= (?:gnu )?gpl <v>3(?: 0)?<o>
= gplv3<o> [ gplv3]
lgpl-2.0: lgpl
= (?:gnu )?library general public <l>(?: <v>2(?: 0)?)?<o> [ library general]
= (?:gnu )?lgpl <v>2(?: 0)?<o>
@ gnu org licenses (?:old licenses )?lgpl 2 0
lgpl-2.1: lgpl
! either version 2 1 of the <l> or at your option any later version [ version 2 1 ]
@ gnu org licenses (?:old licenses )?lgpl 2 1
= (?:gnu )?lesser general public <l> <v>2 1<o> [ lesser general]
= (?:gnu )?lgpl <v>2 1<o>
= lgplv2 1<o> [ lgplv2]
lgpl-3.0: lgpl
@ gnu org licenses lgpl 3 0
= (?:gnu )?lesser general public <l> <v>3(?: 0)?<o> [ lesser general]
= (?:gnu )?lgpl <v>3(?: 0)?<o>
= lgplv3<o> [ lgplv3]
lgpl: lgpl
= (?:gnu )?lesser general public <l> [ lesser general]
= (?:gnu )?lgpl
@ gnu org licenses lgpl
agpl-3.0: affero
! either version 3 of the gnu affero general public <l>
@ gnu org licenses agpl 3 0 [ agpl ]
= (?:gnu )?affero general public <l>(?: <v>3(?: 0)?)?<o>
= (?:gnu )?agpl(?: <v>3(?: 0)?)?<o> [ agpl ]
= agplv3<o> [ agplv3]
agpl-1.0: affero
= affero (?:inc )?general public <l> <v>1(?: 0)?
gfdl: gnu
! permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation <l>
! with no invariant sections no front cover texts and no back cover texts [ invariant sections]
@ gnu org (?:licenses|copyleft) fdl
= gnu free documentation <l>(?: <v>1 [0-3])?
= (?:gnu )?gfdl(?: <v>1 [0-3])? [ gfdl ]
mpl-1.1: mozilla
! subject to the mozilla public <l> version 1 1
= mozilla public <l> <v>1 1
= mpl <v>1 1 [ mpl ]
@ mozilla org mpl 1 1
mpl-2.0: mozilla
! this source code form is subject to the terms of the mozilla public <l>
@ mozilla org mpl 2 0
= mozilla public <l>(?: <v>2(?: 0)?)?
= mpl <v>2(?: 0)? [ mpl ]
epl-1.0: eclipse
= eclipse public <l> <v>1(?: 0)?
= epl <v>1(?: 0)? [ epl ]
@ eclipse org legal epl v10
epl-2.0: eclipse
= eclipse public <l>(?: <v>2(?: 0)?)?
= epl <v>2(?: 0)? [ epl ]
@ eclipse org legal epl (?:2 0|v20)
edl-1.0: eclipse
= eclipse distribution <l>(?: <v>1(?: 0)?)?
@ eclipse org org documents edl v10
cddl-1.0: common development
= common development and distribution <l>(?: <v>1(?: 0)?)?
= cddl(?: <v>1(?: 0)?)? [ cddl ]
cddl-1.1: common development
= common development and distribution <l> <v>1 1
= cddl <v>1 1 [ cddl ]
cpl-1.0: common public
= common public <l>(?: <v>1(?: 0)?)?
= cpl <v>1(?: 0)? [ cpl ]
ipl-1.0: ibm
= ibm public <l>(?: <v>1(?: 0)?)?
eupl-1.1: european union
= european union public <l> <v>1 1
= eupl <v>1 1 [ eupl ]
eupl-1.2: european union
= european union public <l>(?: <v>1 2)?
= eupl(?: <v>1 2)? [ eupl ]
cecill-2.1: cecill
= cecill(?: free software <l>(?: agreement)?)?(?: <v>2 1)?
cecill-b: cecill
= cecill b(?: <l>)?
cecill-c: cecill
= cecill c(?: <l>)?
artistic-1.0: artistic
= (?:perl )?artistic <l> <v>1(?: 0)?
! same terms as perl itself [ perl ]
artistic-2.0: artistic
= artistic <l>(?: <v>2(?: 0)?)?
@ opensource org licenses? artistic license 2 0
bsl-1.0: boost
! boost software <l> version 1 0 august 17th 2003
@ boost org license 1 0(?: txt)?
= boost software <l>(?: <v>1(?: 0)?)?
zlib: zlib
! this software is provided as is without any express or implied warranty in no event will the authors be held liable [ held liable]
! altered source versions must be plainly marked as such [ plainly marked]
= zlib(?: libpng)? <l>
@ zlib net zlib license
libpng: libpng
= libpng <l>(?: <v>2(?: 0)?)?
unlicense: unlicense
! free and unencumbered software released into the public domain [ unencumbered ]
@ unlicense org
= the unlicense
wtfpl: public
! do what the fuck you want to [ do what the]
= wtfpl(?: <v>2)? [ wtfpl ]
= do what the f[^ ]{0,3}k you want to public <l>
cc0-1.0: cc0
! to the extent possible under law (?:[^ ]+ ){1,12}has waived all copyright [ has waived]
@ creativecommons org publicdomain zero 1 0 [ publicdomain ]
= cc0(?: 1 0)?(?: universal)?
= creative commons (?:cc0|zero) [ creative commons]
public-domain: public domain
! (?:released|placed|dedicated|is|are) (?:in|into|to|in to) the public domain
@ creativecommons org publicdomain mark [ publicdomain ]
= public domain dedication
? public domain
cc-by-1.0: creative
= creative commons attribution 1 0(?: generic)?
@ creativecommons org licenses by 1 0 [ creativecommons ]
= cc by 1 0 [ cc by ]
cc-by-2.0: creative
= creative commons attribution 2 0(?: generic)?
@ creativecommons org licenses by 2 0 [ creativecommons ]
= cc by 2 0 [ cc by ]
cc-by-2.5: creative
= creative commons attribution 2 5(?: generic)?
@ creativecommons org licenses by 2 5 [ creativecommons ]
= cc by 2 5 [ cc by ]
cc-by-3.0: creative
= creative commons attribution 3 0(?: unported)?
@ creativecommons org licenses by 3 0 [ creativecommons ]
= cc by 3 0 [ cc by ]
cc-by-4.0: creative
! (?:licensed|available|published|distributed) under (?:a |the )?(?:creative commons attribution|cc by)(?: 4 0)?(?: international)?(?: <l>)? [ under ]
= creative commons attribution 4 0(?: international)?(?: <l>)?
@ creativecommons org licenses by 4 0 [ creativecommons ]
= cc by 4 0 [ cc by ]
cc-by-sa-2.0: creative
= creative commons attribution share ?alike 2 0
@ creativecommons org licenses by sa 2 0 [ creativecommons ]
= cc by sa 2 0 [ cc by ]
cc-by-sa-2.5: creative
= creative commons attribution share ?alike 2 5
@ creativecommons org licenses by sa 2 5 [ creativecommons ]
cc-by-sa-3.0: creative
= creative commons attribution share ?alike 3 0(?: unported)?
@ creativecommons org licenses by sa 3 0 [ creativecommons ]
= cc by sa 3 0 [ cc by ]
cc-by-sa-4.0: creative
= creative commons attribution share ?alike 4 0(?: international)?
@ creativecommons org licenses by sa 4 0 [ creativecommons ]
= cc by sa 4 0 [ cc by ]
cc-by-sa: creative
= creative commons attribution share ?alike(?: <l>)?
= cc by sa [ cc by ]
cc-by-nc-3.0: creative
= creative commons attribution non ?commercial 3 0(?: unported)?
@ creativecommons org licenses by nc 3 0 [ creativecommons ]
= cc by nc 3 0 [ cc by ]
cc-by-nc-4.0: creative
= creative commons attribution non ?commercial 4 0(?: international)?
@ creativecommons org licenses by nc 4 0 [ creativecommons ]
= cc by nc 4 0 [ cc by ]
cc-by-nc: creative
= creative commons attribution non ?commercial(?: <l>)?
= cc by nc [ cc by ]
cc-by-nd-4.0: creative
= creative commons attribution no ?deriv(?:ative)?s(?: 4 0)?
@ creativecommons org licenses by nd 4 0 [ creativecommons ]
= cc by nd(?: 4 0)? [ cc by ]
cc-by-nc-sa-3.0: creative
= creative commons attribution non ?commercial share ?alike 3 0
@ creativecommons org licenses by nc sa 3 0 [ creativecommons ]
= cc by nc sa 3 0 [ cc by ]
cc-by-nc-sa-4.0: creative
= creative commons attribution non ?commercial share ?alike(?: 4 0)?(?: international)?
@ creativecommons org licenses by nc sa 4 0 [ creativecommons ]
= cc by nc sa(?: 4 0)? [ cc by ]
cc-by-nc-nd-4.0: creative
= creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: 4 0)?
@ creativecommons org licenses by nc nd 4 0 [ creativecommons ]
= cc by nc nd(?: 4 0)? [ cc by ]
creative-commons: creative
? creative commons(?: attribution)?(?: <l>)?
? creativecommons org licenses [ creativecommons ]
odbl-1.0: open d
= open (?:data commons open )?database <l>(?: <v>1(?: 0)?)?
= odbl(?: <v>1(?: 0)?)? [ odbl ]
@ opendatacommons org licenses odbl [ opendatacommons ]
odc-by-1.0: open d
= open data commons attribution <l>(?: <v>1(?: 0)?)?
= odc by(?: <v>1(?: 0)?)? [ odc ]
pddl-1.0: open d
= open data commons public domain dedication(?: and <l>)?
= pddl(?: <v>1(?: 0)?)? [ pddl ]
ogl-3.0: open government
= open government <l>(?: <v>3(?: 0)?)?
@ nationalarchives gov uk doc open government licence [ nationalarchives ]
etalab-2.0: etalab
= licence ouverte(?: open licence)?(?: <v>2(?: 0)?)? [ ouverte ]
= etalab 2 0
python-2.0: python
= python software foundation <l>(?: <v>2(?: 0)?)?
= psf <l>(?: <v>2(?: 0)?)? [ psf ]
php-3.01: php
! this product includes php software freely available from
= php <l>(?: <v>3(?: 0)?1?)?
@ php net license 3 01
ruby: ruby
= ruby s? ?<l>
! same terms as ruby itself
postgresql: postgresql
= postgresql <l>
@ opensource org licenses? postgresql
openssl: openssl
! this product includes software developed by the openssl project
= openssl(?: and ssleay)? <l>
curl: curl
= curl <l>
@ curl (?:se|haxx se) docs copyright
afl-3.0: academic free
= academic free <l>(?: <v>3(?: 0)?)?
= afl <v>3 0 [ afl ]
osl-3.0: open software
= open software <l>(?: <v>3(?: 0)?)?
= osl <v>3 0 [ osl ]
ms-pl: microsoft
= microsoft public <l>
= ms pl(?: <l>)? [ ms pl ]
ms-rl: microsoft
= microsoft reciprocal <l>
= ms rl(?: <l>)? [ ms rl ]
ncsa: ncsa
= university of illinois(?: ncsa)?(?: open source)? <l> [ illinois ]
= ncsa (?:open source )?<l>
ofl-1.1: open font
! this font software is licensed under the sil open font <l>
= (?:sil )?open font <l>(?: <v>1 1)?
@ scripts sil org ofl [ sil org]
= sil ofl(?: <v>1 1)? [ sil ofl]
qpl-1.0: public
= q public <l>(?: <v>1(?: 0)?)?
sleepycat: sleepycat
= sleepycat <l>
w3c: w3c
= w3c (?:software (?:notice and )?|document )?<l>
@ w3 org consortium legal [ w3 org]
vim: vim
= vim <l>
beerware: beer
! as long as you retain this notice you can do whatever you want with this stuff [ retain this notice]
= beer ?ware <l>
json: json
! the software shall be used for good not evil [ not evil]
= json <l>
sspl-1.0: server side
= server side public <l>(?: <v>1(?: 0)?)?
= sspl(?: <v>1(?: 0)?)? [ sspl ]
busl-1.1: business source
! additional use grant [ use grant]
= business source <l>(?: <v>1 1)?
elastic-2.0: elastic
= elastic <l>(?: <v>2(?: 0)?)?
commons-clause: commons clause
= commons clause(?: <l> condition)?(?: <v>1 0)?
polyform: polyform
= polyform (?:noncommercial|small business|shield|strict|free trial|internal use|perimeter)(?: <l>)?(?: 1 0 0)?
unicode: unicode
= unicode (?:inc )?(?:terms of use|<l> agreement|<l>)(?: data files and software)?
upl-1.0: universal permissive
= universal permissive <l>(?: <v>1(?: 0)?)?
mulanpsl-2.0: mulan
= mulan (?:psl|permissive software <l>)(?: <v>2(?: 0)?)?
openrail: open
= (?:creativeml |bigscience |bigcode )?open ?rail(?: ?\+?\+?)?(?: m)?(?: <l>)?
llama: llama
= llama [234](?: [0-9])? community <l>(?: agreement)?
proprietary: confidential
! unauthorized (?:copying|use|reproduction|distribution) of this (?:file|work|document|software) [ unauthorized ]
? proprietary and confidential
? confidential and proprietary
? strictly confidential
? commercial <l> [ commercial ]
copyright: copyright
! no part of this (?:publication|book|work|document) may be reproduced [ no part of]
? copyright (?:c )?(?:19|20)[0-9][0-9]
? c copyright(?:ed)?
? copyrighted material [ copyrighted ]
reserved: rights
? (?:all |some |no )rights (?:are )?reserved
? alle rechte vorbehalten [ rechte ]
? tous droits r[^ ]{1,3}serv[^ ]{1,3}s [ droits ]
? todos los derechos reservados [ derechos ]
noncommercial: commercial
? (?:for )?non ?commercial (?:use|purposes)(?: only)?
? not for commercial (?:use|purposes)
license-notice: licen
? licensed under (?:the )?(?:terms of )?(?:[^ ]+ ){1,4}<l>
? (?:see|read) (?:the )?<l>(?: file| txt| md)
? terms of (?:the|this) <l>
? released under (?:the )?(?:[^ ]+ ){1,4}<l>
"""

# The phrases whose places are always reported, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Kinds in order of priority with the weight of a label that rests on them.
KINDS = {"#": (0, 1.0), "!": (1, 0.95), "@": (2, 0.9), "=": (3, 0.8), "?": (4, 0.4)}
_SHORT = {"<l>": "licen[cs]e", "<v>": "(?:version |ver |v |v)?", "<o>": "(?: only| or later| or any later version| or newer)?"}


@dataclass(frozen=True)
class Rule:
    """A pattern over spaced words; ``keyword`` occurs in whatever it matches."""

    label: str
    kind: str
    keyword: str
    pattern: re.Pattern
    base: bool = False


def _rule(label: str, kind: str, keyword: str, text: str, base: bool = False) -> Rule:
    for short, long in _SHORT.items():
        text = text.replace(short, long)
    return Rule(label, kind, keyword, re.compile(f"(?<= )(?:{text})(?= )"), base)


def load_rules(signatures: str = SIGNATURES) -> list[Rule]:
    """Base phrases, then a tag for each label, then the signatures as they are written."""
    rules = [_rule(label, "=", f" {phrase} ", phrase, base=True) for phrase, label in BASE.items()]
    written, label, keyword = [], "", ""
    for line in filter(None, signatures.split("\n")):
        if line[0] not in KINDS:
            label, keyword = (part.strip() for part in line.split(":"))
            identifier = re.sub("[^a-z0-9]+", " ", label)
            rules.append(_rule(label, "#", " spdx ", f"spdx license identifier {identifier}(?: only| or later)?"))
            continue
        text, _, own = line[2:].partition(" [ ")
        written.append(_rule(label, line[0], f" {own[:-1]}" if own else f" {keyword}", text))
    return rules + written
