"""License scan by ordered signature rules, in DataFrame functions only.

Rules are regular expressions with a label, a priority (1 is best) and a confidence. Sentences of well-known licenses, notices
and texts are rules of their own; each family of licenses gives five more (tag, address, grant, name, short name with
version). A space in a rule stands for any white space and the marks that open a line of a comment, so wrapped texts and
notices in comments match like those on one line. In a tag line each operand of AND, OR and WITH is found.

The keyword prefilter is derived from the rules: words that every match of a rule holds. A few triggers, one of which each
rule has, are looked for in each text; of the rules with a trigger that occurs, those are matched whose other words occur
too. So the prefilter loses no match.

Detections are intervals of code points. Of equal intervals the one of best priority stays (then the earlier rule). One
that lies within another of the same or a better priority is suppressed, and so is one that contains another of a
strictly better priority. Both are running extremes over the detections in order, so many detections cost no pairs.

The base, places of three phrases as consecutive words, is counted apart; words are runs of ASCII letters, digits and all
characters beyond ASCII. Rules only add labels.

Null counts as the empty text: no word, label or place, score 0. Repeated rows each get their row, null ids stay. Very long
texts are scanned whole, in time that grows with their length and matches (times the logarithm of the matches). An empty
table gives an empty result. Only the named columns are read. All is decided row by row: nothing is shuffled.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import documents, running
from waymark.llm.secrets import match_spans

#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: All that isn't part of a word once A-Z are lower-cased; the upper-case letters are left in, so no lower-casing is needed.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: What a space in a rule stands for.
SPACE = r"(?:\s[\s#*/;%>!|-]*+)"

#: Families: label | tag | name as a pattern.
FAMILIES = """
mit | MIT | (?:mit|expat|x11)
mit-0 | MIT-0 | mit(?: license)? (?:no attribution|zero)
apache-1.0 | Apache-1.0 | apache(?: software)?(?: license)?,? (?:version |v\\.? ?)?1\\.0
apache-1.1 | Apache-1.1 | apache(?: software)?(?: license)?,? (?:version |v\\.? ?)?1\\.1
apache-2.0 | Apache-2.0 | apache(?: software)?(?: license)?,? (?:version |v\\.? ?)?2(?:\\.0)?
gpl-1.0 | GPL-1.0 | gnu (?:gpl|general public licen[cs]e),? (?:version |v\\.? ?)?1(?:\\.0)?
gpl-2.0 | GPL-2.0 | gnu (?:gpl|general public licen[cs]e),? (?:version |v\\.? ?)?2(?:\\.0)?
gpl-3.0 | GPL-3.0 | gnu (?:gpl|general public licen[cs]e),? (?:version |v\\.? ?)?3(?:\\.0)?
lgpl-2.0 | LGPL-2.0 | gnu (?:lgpl|library general public licen[cs]e),? (?:version |v\\.? ?)?2(?:\\.0)?
lgpl-2.1 | LGPL-2.1 | gnu (?:lgpl|lesser general public licen[cs]e),? (?:version |v\\.? ?)?2\\.1
lgpl-3.0 | LGPL-3.0 | gnu (?:lgpl|lesser general public licen[cs]e),? (?:version |v\\.? ?)?3(?:\\.0)?
agpl-1.0 | AGPL-1.0 | affero (?:gpl|general public licen[cs]e),? (?:version |v\\.? ?)?1(?:\\.0)?
agpl-3.0 | AGPL-3.0 | affero (?:gpl|general public licen[cs]e),? (?:version |v\\.? ?)?3(?:\\.0)?
fdl-1.3 | GFDL-1.3 | gnu (?:fdl|free documentation licen[cs]e),? (?:version |v\\.? ?)?1\\.3
bsd-2-clause | BSD-2-Clause | (?:bsd 2[- ]clause|2[- ]clause bsd|simplified bsd|freebsd)
bsd-3-clause | BSD-3-Clause | (?:bsd 3[- ]clause|3[- ]clause bsd|new bsd|modified bsd|revised bsd)
bsd-4-clause | BSD-4-Clause | (?:bsd 4[- ]clause|4[- ]clause bsd|original bsd)
0bsd | 0BSD | (?:zero[- ]clause bsd|bsd zero[- ]clause)
mpl-1.0 | MPL-1.0 | mozilla public(?: license)?,? (?:version |v\\.? ?)?1\\.0
mpl-1.1 | MPL-1.1 | mozilla public(?: license)?,? (?:version |v\\.? ?)?1\\.1
mpl-2.0 | MPL-2.0 | mozilla public(?: license)?,? (?:version |v\\.? ?)?2(?:\\.0)?
epl-1.0 | EPL-1.0 | eclipse public(?: license)?,? (?:version |v\\.? ?)?1(?:\\.0)?
epl-2.0 | EPL-2.0 | eclipse public(?: license)?,? (?:version |v\\.? ?)?2(?:\\.0)?
edl-1.0 | EDL-1.0 | eclipse distribution(?: license)?,? (?:version |v\\.? ?)?1(?:\\.0)?
cddl-1.0 | CDDL-1.0 | common development and distribution(?: license)?,? (?:version |v\\.? ?)?1\\.0
cddl-1.1 | CDDL-1.1 | common development and distribution(?: license)?,? (?:version |v\\.? ?)?1\\.1
cpl-1.0 | CPL-1.0 | common public(?: license)?,? (?:version |v\\.? ?)?1\\.0
eupl-1.1 | EUPL-1.1 | european union public(?: licence)?,? (?:version |v\\.? ?)?1\\.1
eupl-1.2 | EUPL-1.2 | european union public(?: licence)?,? (?:version |v\\.? ?)?1\\.2
isc | ISC | isc
zlib | Zlib | (?:zlib|zlib/libpng)
bsl-1.0 | BSL-1.0 | boost software(?: license)?,? ?(?:(?:version |v\\.? ?)?1\\.0)?
unlicense | Unlicense | (?:the )?unlicense
wtfpl | WTFPL | do what the \\w+ you want to(?: public)?
artistic-1.0 | Artistic-1.0 | artistic(?: license)?,? (?:version |v\\.? ?)?1\\.0
artistic-2.0 | Artistic-2.0 | artistic(?: license)?,? (?:version |v\\.? ?)?2\\.0
ofl-1.1 | OFL-1.1 | sil open font(?: license)?,? ?(?:(?:version |v\\.? ?)?1\\.1)?
python-2.0 | Python-2.0 | python(?: software foundation)?(?: license)?,? (?:version |v\\.? ?)?2(?:\\.0)?
ruby | Ruby | ruby
php-3.01 | PHP-3.01 | php(?: license)?,? (?:version |v\\.? ?)?3\\.01
postgresql | PostgreSQL | postgresql
openssl | OpenSSL | openssl
curl | curl | curl
ncsa | NCSA | (?:university of illinois/)?ncsa(?: open source)?
upl-1.0 | UPL-1.0 | universal permissive(?: license)?,? ?(?:(?:version |v\\.? ?)?1\\.0)?
ms-pl | MS-PL | microsoft public
ms-rl | MS-RL | microsoft reciprocal
odbl-1.0 | ODbL-1.0 | (?:open data commons )?open database(?: license)?,? ?(?:(?:version |v\\.? ?)?1\\.0)?
odc-by-1.0 | ODC-By-1.0 | open data commons attribution(?: license)?,? ?(?:(?:version |v\\.? ?)?1\\.0)?
pddl-1.0 | PDDL-1.0 | (?:open data commons )?public domain dedication and(?: license)?
cc0-1.0 | CC0-1.0 | (?:creative commons zero|cc0)(?: 1\\.0)?
cc-by-3.0 | CC-BY-3.0 | cc[ -]by[ -]3\\.0
cc-by-4.0 | CC-BY-4.0 | cc[ -]by[ -]4\\.0
cc-by-sa-3.0 | CC-BY-SA-3.0 | cc[ -]by[ -]sa[ -]3\\.0
cc-by-sa-4.0 | CC-BY-SA-4.0 | cc[ -]by[ -]sa[ -]4\\.0
cc-by-nc-3.0 | CC-BY-NC-3.0 | cc[ -]by[ -]nc[ -]3\\.0
cc-by-nc-4.0 | CC-BY-NC-4.0 | cc[ -]by[ -]nc[ -]4\\.0
cc-by-nd-4.0 | CC-BY-ND-4.0 | cc[ -]by[ -]nd[ -]4\\.0
cc-by-nc-sa-4.0 | CC-BY-NC-SA-4.0 | cc[ -]by[ -]nc[ -]sa[ -]4\\.0
cc-by-nc-nd-4.0 | CC-BY-NC-ND-4.0 | cc[ -]by[ -]nc[ -]nd[ -]4\\.0
"""
#: Sentences and other rules: label | priority | pattern.
OTHERS = """
mit | 1 | permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \\(the .{0,3}software.{0,3}\\), to deal in the software without restriction
mit | 2 | permission is hereby granted, free of charge, to any person obtaining a copy of this software
mit | 2 | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 2 | above copyright notice and this permission notice \\(including the next paragraph\\) shall be included
mit-0 | 1 | sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so\\. the software is provided .{0,3}as is
x11 | 1 | except as contained in this notice, the names? of .{1,120} shall not be used in advertising or otherwise to promote the sale
json | 1 | the software shall be used for good, not evil
ncsa | 1 | to any person obtaining a copy of this software and associated documentation files \\(the .{0,3}software.{0,3}\\), to deal with the software
bsl-1.0 | 1 | permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software
bsl-1.0 | 1 | distributed under the boost software license, version 1\\.0
isc | 1 | permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice
0bsd | 1 | permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted\\. the software is provided
isc | 3 | permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose
hpnd | 1 | permission to use, copy, modify,? and distribute this software and its documentation for any purpose and without fee is hereby granted
postgresql | 1 | permission to use, copy, modify,? and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted
bsd-2-clause | 1 | in the documentation and/or other materials provided with the distribution\\. this software is provided by
bsd | 2 | redistributions of source code must retain the above copyright notice(?:,| unmodified,) this list of conditions
bsd-3-clause | 1 | neither the names? of .{1,120} nor the names of (?:its|their|other) contributors may be used to endorse or promote
bsd-3-clause | 1 | the names? .{1,80} may not be used to endorse or promote products derived from this software without
bsd-4-clause | 1 | all advertising materials mentioning features or use of this software must display
bsd | 2 | redistribution and use in source and binary forms,? with or without modification,? are permitted
bsd | 2 | use of this source code is governed by a bsd[- ]style licen[cs]e
bsd-3-clause-clear | 1 | no express or implied licenses to any party.s patent rights are granted by this license
apache-2.0 | 1 | licensed under the apache license,? version 2\\.0 \\(the .{0,3}license.{0,3}\\);? you may not use this file except in compliance with the license
apache-2.0 | 2 | you may not use this file except in compliance with the license
apache-2.0 | 1 | apache license,? version 2\\.0, january 2004
apache-2.0 | 2 | distributed on an .{0,3}as is.{0,3} basis, without warranties or conditions of any kind, either express or implied
apache-1.1 | 1 | this product includes software developed by the apache software foundation
apache-2.0 | 1 | apache\\.org/licenses/license-2\\.0
apache-2.0 | 2 | licensed to the apache software foundation \\(asf\\) under one or more contributor license agreements
gpl-1.0-or-later | 1 | under the terms of the gnu general public licen[cs]e as published by the free software foundation[;,:]? either version 1,? or \\(at your option\\) any later version
gpl-2.0-or-later | 1 | under the terms of the gnu general public licen[cs]e as published by the free software foundation[;,:]? (?:either )?version 2 of the licen[cs]e,? or,? \\(?at your option\\)?,? any later version
gpl-3.0-or-later | 1 | under the terms of the gnu general public licen[cs]e as published by the free software foundation[;,:]? (?:either )?version 3 of the licen[cs]e,? or,? \\(?at your option\\)?,? any later version
gpl-2.0-only | 1 | under the terms of the gnu general public licen[cs]e,? version 2,? as published by the free software foundation
gpl-2.0-only | 1 | under the terms of the gnu general public licen[cs]e as published by the free software foundation[;,:]? version 2(?: of the licen[cs]e)?\\.
gpl-3.0-only | 1 | under the terms of the gnu general public licen[cs]e,? version 3,? as published by the free software foundation
gpl-3.0-only | 1 | under the terms of the gnu general public licen[cs]e as published by the free software foundation[;,:]? version 3(?: of the licen[cs]e)?\\.
lgpl-2.0-or-later | 1 | under the terms of the gnu library general public licen[cs]e as published by the free software foundation[;,:]? (?:either )?version 2 of the licen[cs]e,? or,? \\(?at your option\\)?,? any later version
lgpl-2.1-or-later | 1 | under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation[;,:]? (?:either )?version 2\\.1 of the licen[cs]e,? or,? \\(?at your option\\)?,? any later version
lgpl-3.0-or-later | 1 | under the terms of the gnu lesser general public licen[cs]e as published by the free software foundation[;,:]? (?:either )?version 3 of the licen[cs]e,? or,? \\(?at your option\\)?,? any later version
agpl-3.0-or-later | 1 | under the terms of the gnu affero general public licen[cs]e as published by the free software foundation[;,:]? (?:either )?version 3 of the licen[cs]e,? or,? \\(?at your option\\)?,? any later version
agpl-3.0-only | 1 | under the terms of the gnu affero general public licen[cs]e,? version 3,? as published by the free software foundation
fdl-1.3-or-later | 1 | under the terms of the gnu free documentation licen[cs]e,? version 1\\.3 or any later version published by the free software foundation
fdl-1.2-or-later | 1 | under the terms of the gnu free documentation licen[cs]e,? version 1\\.2 or any later version published by the free software foundation
gpl | 2 | you can redistribute it and/or modify it under the terms of the gnu general public licen[cs]e
lgpl | 2 | you can redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e
agpl | 2 | you can redistribute it and/or modify it under the terms of the gnu affero general public licen[cs]e
gpl-2.0-or-later | 2 | either version 2 of the license, or \\(at your option\\) any later version
gpl-3.0-or-later | 2 | either version 3 of the license, or \\(at your option\\) any later version
gpl-1.0 | 1 | gnu general public licen[cs]e,? version 1,? february 1989
gpl-2.0 | 1 | gnu general public licen[cs]e,? version 2,? june 1991
gpl-3.0 | 1 | gnu general public licen[cs]e,? version 3,? 29 june 2007
lgpl-2.0 | 1 | gnu library general public licen[cs]e,? version 2,? june 1991
lgpl-2.1 | 1 | gnu lesser general public licen[cs]e,? version 2\\.1,? february 1999
lgpl-3.0 | 1 | gnu lesser general public licen[cs]e,? version 3,? 29 june 2007
agpl-3.0 | 1 | gnu affero general public licen[cs]e,? version 3,? 19 november 2007
gpl-2.0 | 1 | gnu\\.org/licenses/(?:old-licenses/)?gpl-2\\.0
gpl-3.0 | 1 | gnu\\.org/licenses/gpl-3\\.0
lgpl-2.1 | 1 | gnu\\.org/licenses/(?:old-licenses/)?lgpl-2\\.1
lgpl-3.0 | 1 | gnu\\.org/licenses/lgpl-3\\.0
agpl-3.0 | 1 | gnu\\.org/licenses/agpl-3\\.0
gpl | 3 | you should have received a copy of the gnu general public licen[cs]e along with
lgpl | 3 | you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e along with
agpl | 3 | you should have received a copy of the gnu affero general public licen[cs]e along with
classpath-exception-2.0 | 1 | linking this library statically or dynamically with other modules is making a combined work based on this library
classpath-exception-2.0 | 2 | classpath[- ]exception(?:[- ]2\\.0)?
gcc-exception-3.1 | 1 | gcc runtime library exception,? version 3\\.1
llvm-exception | 2 | llvm[- ]exceptions?
bison-exception | 1 | as a special exception, you may create a larger work that contains part or all of the bison parser skeleton
linux-syscall-note | 1 | this copyright does .{0,3}not.{0,3} cover user programs that use kernel services
mpl-2.0 | 1 | this source code form is subject to the terms of the mozilla public license,? v(?:ersion|\\.)? 2\\.0
mpl-2.0 | 1 | mozilla public license version 2\\.0 1\\. definitions
mpl-1.1 | 1 | the contents of this file are subject to the mozilla public license version 1\\.1
mpl-1.0 | 1 | the contents of this file are subject to the mozilla public license version 1\\.0
mpl-2.0 | 1 | mozilla\\.org/mpl/2\\.0
npl-1.1 | 1 | the contents of this file are subject to the netscape public license
cddl-1.0 | 1 | the contents of this file are subject to the terms of the common development and distribution license
epl-1.0 | 1 | made available under the terms of the eclipse public license v(?:ersion|\\.)? ?1\\.0
epl-2.0 | 1 | made available under the terms of the eclipse public license v(?:ersion|\\.)? ?2\\.0
epl-2.0 | 1 | eclipse public license - v 2\\.0
epl-1.0 | 1 | eclipse public license - v 1\\.0
cpl-1.0 | 1 | made available under the terms of the common public license v1\\.0
eupl | 1 | licensed under the eupl
zlib | 1 | this software is provided ['"‘“]?as-is['"’”]?, without any express or implied warranty
zlib | 2 | altered source versions must be plainly marked as such, and must not be misrepresented as being the original software
unlicense | 1 | this is free and unencumbered software released into the public domain
wtfpl | 1 | you just do what the \\w+ you want to
wtfpl | 1 | do what the \\w+ you want to public license
beerware | 1 | the beer-?ware license.{0,3} \\(revision \\d+\\)
beerware | 1 | you can buy me a beer in return
artistic-2.0 | 1 | the artistic license 2\\.0 copyright
artistic-1.0 | 2 | the intent of this document is to state the conditions under which a package may be copied, such that the copyright holder maintains
ofl-1.1 | 1 | this font software is licensed under the sil open font license
ofl-1.1 | 2 | permission is hereby granted, free of charge, to any person obtaining a copy of the font software
python-2.0 | 1 | python software foundation license version 2
openssl | 1 | this product includes software developed by the openssl project
ssleay | 1 | this product includes cryptographic software written by eric young
curl | 1 | permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies\\. the software is provided .{0,3}as is.{0,3}, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement
libpng | 1 | the png reference library is supplied
ijg | 1 | this software is based in part on the work of the independent jpeg group
ms-pl | 1 | this license governs use of the accompanying software\\. if you use the software, you accept this license
w3c | 1 | w3c software notice and license
unicode | 1 | unicode,? inc\\. license agreement
vim | 1 | vim license i\\) there are no restrictions on distributing unmodified copies of vim
afl-3.0 | 1 | licensed under the academic free license version 3\\.0
osl-3.0 | 1 | licensed under the open software license version 3\\.0
upl-1.0 | 1 | the universal permissive license \\(upl\\),? version 1\\.0
bsl-1.1 | 1 | business source license 1\\.1
sspl-1.0 | 1 | server side public license,? version 1
elastic-2.0 | 1 | elastic license 2\\.0
commons-clause | 1 | .{0,3}commons clause.{0,3} license condition v1\\.0
polyform-noncommercial-1.0 | 1 | polyform noncommercial license 1\\.0
polyform-shield-1.0 | 1 | polyform shield license 1\\.0
mulan-psl-2.0 | 1 | licensed under mulan psl v2
odbl-1.0 | 1 | made available under the open database license
odc-by-1.0 | 1 | made available under the open data commons attribution license
pddl-1.0 | 1 | made available under the public domain dedication and license
cc0-1.0 | 1 | creative commons legal code cc0 1\\.0 universal
cc0-1.0 | 1 | creativecommons\\.org/publicdomain/zero/1\\.0
cc-by-4.0 | 1 | creative commons attribution 4\\.0 international
cc-by-sa-4.0 | 1 | creative commons attribution-share ?alike 4\\.0 international
cc-by-nc-4.0 | 1 | creative commons attribution-non-?commercial 4\\.0 international
cc-by-nd-4.0 | 1 | creative commons attribution-no ?derivatives 4\\.0 international
cc-by-nc-sa-4.0 | 1 | creative commons attribution-non-?commercial-share ?alike 4\\.0 international
cc-by-nc-nd-4.0 | 1 | creative commons attribution-non-?commercial-no ?derivatives 4\\.0 international
cc-by-3.0 | 1 | creative commons attribution 3\\.0 unported
cc-by-sa-3.0 | 1 | creative commons attribution-share ?alike 3\\.0 unported
cc-by-3.0 | 1 | creativecommons\\.org/licenses/by/3\\.0
cc-by-sa-3.0 | 1 | creativecommons\\.org/licenses/by-sa/3\\.0
cc-by-nc-3.0 | 1 | creativecommons\\.org/licenses/by-nc/3\\.0
cc-by-4.0 | 1 | creativecommons\\.org/licenses/by/4\\.0
cc-by-sa-4.0 | 1 | creativecommons\\.org/licenses/by-sa/4\\.0
cc-by-nc-4.0 | 1 | creativecommons\\.org/licenses/by-nc/4\\.0
cc-by-nd-4.0 | 1 | creativecommons\\.org/licenses/by-nd/4\\.0
cc-by-nc-sa-4.0 | 1 | creativecommons\\.org/licenses/by-nc-sa/4\\.0
cc-by-nc-nd-4.0 | 1 | creativecommons\\.org/licenses/by-nc-nd/4\\.0
public-domain | 1 | this (?:work|software) is a work of the united states government
public-domain | 1 | this (?:file|software|code|work) is in the public domain
public-domain | 1 | the author disclaims copyright to this source code\\. in place of a legal notice, here is a blessing
public-domain | 3 | (?:placed|released|dedicated|donated) (?:in|into|to) the public domain
proprietary | 3 | all rights reserved
proprietary | 3 | confidential and proprietary
proprietary | 2 | unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|program|document).{0,60} is strictly prohibited
proprietary | 2 | (?:contains|is) (?:the )?(?:proprietary|confidential)(?: and (?:proprietary|confidential))? information of
proprietary | 2 | unpublished[- ]+rights reserved under the copyright laws of the united states
proprietary | 2 | this is unpublished proprietary source code
proprietary | 2 | may not be (?:copied|reproduced|distributed)(?:,| or) .{0,80} without (?:the )?(?:express |prior )*written (?:permission|consent)
apache | 3 | apache(?: software)? licen[cs]e
gpl | 3 | general public licen[cs]e
lgpl | 3 | (?:lesser|library) general public licen[cs]e
agpl | 3 | affero general public licen[cs]e
mpl | 3 | mozilla public licen[cs]e
epl | 3 | eclipse public licen[cs]e
bsd | 3 | \\bbsd(?:[- ]style)? licen[cs]e
artistic | 3 | artistic licen[cs]e
creative-commons | 3 | creative commons attribution[- a-z]{0,40}
creative-commons | 4 | \\bcc[ -]by(?:[ -](?:sa|nc|nd)){0,2}\\b
unspecified | 5 | (?:licen[cs]ed|released|distributed|published) under (?:the |a |an )?\\S+
"""
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.8, 4: 0.6, 5: 0.3}


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    pattern: str
    #: The word by which the rule is tried, and further ones; every match of the pattern holds them all, in lower case.
    keyword: str = ""
    needs: tuple[str, ...] = ()


def _spaced(pattern: str) -> str:
    """The pattern with `SPACE` for each space, white space for one within brackets; a dot takes line breaks."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            c = pattern[at : at + 2]
        elif c in "[]":
            inside = c == "["
        elif c == " ":
            c = r"\s" if inside else SPACE
        out.append(c)
        at += 1 if len(c) != 2 or pattern[at] != "\\" else 2
    return "(?is)" + "".join(out)


def literals(pattern: str) -> list[str]:
    """Words that every match holds: runs of four or more letters (or else two) outside groups and brackets, none of them
    optional; the longest first. A pattern with alternatives outside groups has none in common."""
    flat, depth, at = [], 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            c, at = " ", at + 1
        elif c in "([":
            depth += 1
            c = " "
        elif c in ")]":
            depth -= 1
            c = " "
        elif c == "|" and not depth:
            return []
        elif c in "?*{" and not depth and flat:
            flat[-1] = " "
            if c == "{":
                at = pattern.index("}", at)
            c = " "
        flat.append(c if not depth else " ")
        at += 1
    text = "".join(flat)
    return sorted(set(re.findall("[a-z]{4,}", text) or re.findall("[a-z]{2,}", text)), key=lambda w: (-len(w), w))


def _drafts() -> list[tuple[Rule, list[str]]]:
    out = []
    for line in OTHERS.strip().splitlines():
        label, priority, pattern = (x.strip() for x in line.split(" | ", 2))
        out.append((Rule(label, int(priority), _spaced(pattern)), literals(pattern)))
    for line in FAMILIES.strip().splitlines():
        label, tag, name = (x.strip() for x in line.split(" | ", 2))
        safe = re.escape(tag).replace("/", "\\/")
        short = re.escape(tag).replace(r"\-", "[- ]?v?")
        parts = [p for p in tag.lower().split("-") if re.search("[a-z]", p)]
        numbered = bool(re.search(r"\d", tag))
        known = literals(name)
        ending = r"(?:-only|-or-later|\+)?"
        after = rf"(?<=(?::[ \t(]{{0,4}}|\b(?:and|or|with)[ \t(]{{1,4}}){safe}{ending})(?<=spdx-license-identifier:[\w.+() \t-]{{1,200}})"
        operand = rf"{safe}{ending}(?![\w.-]){after}"
        grant = rf"(?:licen[cs]ed|released|distributed|available|provided|published) under (?:the )?(?:terms of )?(?:the )?{name}(?![\w.]\w)"
        out += [
            (Rule(label, 1, f"(?is){operand}"), ["spdx-license-identifier:", *parts]),
            (Rule(label, 1, rf"(?is)(?:opensource|spdx)\.org/licenses/{safe}(?![\w.-])"), [".org/licenses/", *parts]),
            (Rule(label, 2, _spaced(grant)), ["under", *known]),
            (Rule(label, 3, _spaced(rf"\b{name}(?:[ -]style)? (?:public |software )?licen[cs]e")), ["licen", *known]),
            (Rule(label, 4, _spaced(rf"\b{short}(?![\w.-])")), parts) if numbered else (Rule(label, 4, _spaced(rf"licen[cs]e\W{{1,3}}{short}(?![\w.-])")), ["licen", *parts]),
        ]
    return out


@cache
def rules() -> list[Rule]:
    """All rules in order; earlier ones win among equals. Each time the word that most of the rules left have becomes a trigger."""
    drafts = _drafts()
    if none := [r for r, words in drafts if not words]:
        raise ValueError(f"rules without a word that all matches hold: {none}")
    trigger: dict[int, str] = {}
    while len(trigger) < len(drafts):
        counts = Counter(w for n, (_, words) in enumerate(drafts) if n not in trigger for w in words)
        word = min(counts, key=lambda w: (-counts[w], -len(w), w))
        trigger |= {n: word for n, (_, words) in enumerate(drafts) if n not in trigger and word in words}
    return [Rule(r.label, r.priority, r.pattern, trigger[n], tuple(w for w in words if w != trigger[n])[:3]) for n, (r, words) in enumerate(drafts)]


@cache
def _rules_json() -> str:
    return json.dumps([{"label": r.label, "priority": r.priority, "confidence": CONFIDENCE[r.priority]} for r in rules()])


def _table() -> Column:
    """The rules as a constant, which the optimizer evaluates once."""
    return F.from_json(F.lit(_rules_json()), "array<struct<label:string,priority:int,confidence:double>>")


@cache
def _keywords_json() -> str:
    """The rules by trigger, so that each trigger is looked for once."""
    found: dict[str, list[dict]] = {}
    for n, r in enumerate(rules()):
        found.setdefault(r.keyword, []).append({"n": n, "pattern": r.pattern, "needs": r.needs})
    return json.dumps([{"keyword": k, "rules": v} for k, v in found.items()])


def _detections(text: Column, lower: Column) -> Column:
    """array<struct<start, rule, end>> of all rules whose words occur."""
    by_keyword = F.from_json(F.lit(_keywords_json()), "array<struct<keyword:string,rules:array<struct<n:int,pattern:string,needs:array<string>>>>>")
    near = F.flatten(F.transform(F.filter(by_keyword, lambda k: F.contains(lower, k["keyword"])), lambda k: k["rules"]))
    gated = F.filter(near, lambda r: F.forall(r["needs"], lambda x: F.contains(lower, x)))
    return F.flatten(F.transform(gated, lambda r: match_spans(text, r["pattern"], r["n"])))


def _ordered(found: Column) -> Column:
    """Detections as (start, longer, p, rule), in the order in which they are decided: earlier ones first, then longer, better and earlier rules."""
    table = _table()
    return F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("longer"), F.get(table, s["kind"])["priority"].alias("p"), s["kind"].alias("rule"))))


_LEVELS = range(1, 6)


def _extremes(found: Column, better: bool) -> Column:
    """Of each detection its end at the levels for which it counts, else what has no effect: at level q those of priority q or better
    (better: strictly)."""
    none = 2**30 if better else -1
    return F.transform(found, lambda x: F.array(*[F.when(x["p"] < q if better else x["p"] <= q, -x["longer"]).otherwise(none) for q in _LEVELS]))


def _not_inside(found: Column) -> Column:
    """Of ordered detections those not within an earlier one of the same or a better priority: whose end is beyond the furthest
    end so far at their level."""
    reach = running(_extremes(found, better=False), lambda a, b: F.zip_with(a, b, lambda x, y: F.greatest(x, y)))
    rows = F.arrays_zip(found.alias("x"), F.concat(F.array(F.array(*[F.lit(-1)] * 5)), reach).alias("before"))
    return F.transform(F.filter(rows, lambda r: r["x"].isNotNull() & (F.get(r["before"], r["x"]["p"] - 1) < -r["x"]["longer"])), lambda r: r["x"])


def _not_around(found: Column) -> Column:
    """Of these those that hold none of a strictly better priority: whose end is before the nearest end of such later ones."""
    near = F.reverse(running(F.reverse(_extremes(found, better=True)), lambda a, b: F.zip_with(a, b, lambda x, y: F.least(x, y))))
    return F.transform(F.filter(F.arrays_zip(found.alias("x"), near.alias("near")), lambda r: F.get(r["near"], r["x"]["p"] - 1) > -r["x"]["longer"]), lambda r: r["x"])


def _places(lower: Column, phrase: str) -> Column:
    """struct(n, first, last): how often the phrase's words stand one after another, and the number of the first and last such word."""
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, GAP + "+", " ")), F.lit(" "))
    parts = F.split(words, f"(?<= ){phrase}(?= )", -1)
    before = F.transform(parts, lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))))
    n = F.size(parts) - 1
    total = F.aggregate(before, F.lit(0), lambda a, x: a + x)
    last = total - F.element_at(before, -1) + (n - 1) * phrase.count(" ") - 1
    return F.when(n > 0, F.struct(n.alias("n"), (F.element_at(before, 1) - 1).alias("first"), last.alias("last")))


def scan_licenses(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, detections, labels, score) for every row.

    detections: array<struct<start, end, label, priority>> that stay, in code points."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    has_word = F.rlike("t", F.lit(WORD))
    words = F.length(F.regexp_replace("t", f"{GAP}*+{WORD}++{GAP}*+", "w"))
    rows = rows.select(
        "id",
        "t",
        F.when(has_word, words).otherwise(0).cast("long").alias("n_words"),
        F.lower("t").alias("lower"),
    )
    rows = rows.withColumn("base", F.when(F.contains("lower", F.lit("license")), F.array(*[_places(F.col("lower"), p) for p, _ in PHRASES])))
    rows = rows.withColumn("found", _ordered(_detections(F.col("t"), F.col("lower")))).withColumn("outer", _not_inside(F.col("found"))).withColumn("kept", _not_around(F.col("outer")))
    table = _table()
    detections = F.transform(
        "kept", lambda s: F.struct(s["start"].alias("start"), (-s["longer"]).alias("end"), F.get(table, s["rule"])["label"].alias("label"), s["p"].alias("priority"))
    )
    base_names = F.array(*[F.lit(name) for _, name in PHRASES])
    base_labels = F.array_sort(F.transform(F.filter(F.arrays_zip(F.col("base").alias("place"), base_names.alias("name")), lambda x: x["place"].isNotNull()), lambda x: x["name"]))
    none = F.array().cast("array<string>")
    surest = F.array_max(F.transform("kept", lambda s: F.get(table, s["rule"])["confidence"]))
    out = rows.select(
        "id",
        "n_words",
        F.coalesce(F.aggregate("base", F.lit(0), lambda a, x: a + F.coalesce(x["n"], F.lit(0))), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda x: x["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda x: x["last"])).cast("long").alias("last_word"),
        F.coalesce(base_labels, none).alias("base_labels"),
        F.coalesce(detections, F.array().cast("array<struct<start:int,end:int,label:string,priority:int>>")).alias("detections"),
        surest.alias("surest"),
    )
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("detections", lambda d: d["label"]))))
    score = F.greatest(F.coalesce("surest", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.8).otherwise(0.0))
    return out.select("*", labels.alias("labels"), score.alias("score")).drop("surest")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: every document's words, base places and labels."""
    return scan_licenses(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
