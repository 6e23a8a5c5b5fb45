"""Signatures of licences, written by hand. On lower-cased text; a blank stands for any gap, a run of white space and comment marks.

Every row: priority, label, keywords (by |), expression. A match always holds one of the keywords,
which are parts of words, so no gap can split them. Priorities: 90 and above licence texts and full notices, 80 exact versions and
exceptions, 70 parts of notices, 60 names without a version, 50 abbreviations, 40 and below
statements that name no licence.
"""

from __future__ import annotations

#: Ids that an SPDX line may name; fixed values.
SPDX_IDS = (
    "0bsd afl-3.0 agpl-3.0 agpl-3.0-only agpl-3.0-or-later apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 "
    "cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-4.0 cc-by-nc-nd-4.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cecill-b cecill-c cpl-1.0 "
    "ecl-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 gfdl-1.2-or-later gfdl-1.3 gfdl-1.3-or-later gpl-1.0-or-later gpl-2.0 gpl-2.0+ gpl-2.0-only gpl-2.0-or-later gpl-3.0 gpl-3.0+ gpl-3.0-only gpl-3.0-or-later "
    "hpnd isc lgpl-2.0-or-later lgpl-2.1 lgpl-2.1+ lgpl-2.1-only lgpl-2.1-or-later lgpl-3.0 lgpl-3.0-only lgpl-3.0-or-later mit mit-0 mpl-1.1 mpl-2.0 ms-pl ms-rl mulanpsl-2.0 ncsa odbl-1.0 ofl-1.1 openssl "
    "osl-3.0 postgresql psf-2.0 python-2.0 ruby unicode-3.0 unlicense upl-1.0 vim w3c wtfpl x11 zlib zpl-2.1 "
    "autoconf-exception-3.0 bison-exception-2.2 classpath-exception-2.0 gcc-exception-3.1 linux-syscall-note llvm-exception openvpn-openssl-exception"
).split()

RULES: tuple[tuple[int, str, str, str], ...] = (
    # --- permissive texts
    (95, "mit", "hereby", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software"),
    (90, "mit", "hereby", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    (75, "mit", "permission", r"the above copyright notice and this permission notice shall be included in all copies"),
    (72, "mit", "furnished", r"to permit persons to whom the software is furnished to do so"),
    (70, "mit", "holders", r"in no event shall the authors or copyright holders be liable for any claim"),
    (60, "mit", "infringement", r"merchantability,? fitness for a particular purpose and non-?infringement"),
    (92, "mit-0", "furnished", r"whom the software is furnished to do so\. the software is provided"),
    (90, "x11", "consortium", r"except as contained in this notice,? the name of the x consortium shall not be used"),
    (90, "x11", "holder", r"except as contained in this notice,? the names? of the above copyright holders? shall not be used"),
    (93, "0bsd", "granted", r"for any purpose with or without fee is hereby granted\. the software is provided"),
    (90, "isc", "permission", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose with or without fee"),
    (85, "isc", "permission", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose"),
    (88, "hpnd", "documentation", r"permission to use,? copy,? modify,? (?:and )?distribute,?(?: and sell)? this software and its documentation for any purpose"),
    (70, "hpnd", "supporting", r"both that copyright notice and this permission notice appear in supporting documentation"),
    (90, "bsd", "redistribution", r"redistribution and use in source and binary forms,? with or without modification,? are permitted"),
    (85, "bsd", "redistribution", r"redistribution and use in source and binary forms,? with or without modification"),
    (75, "bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    (75, "bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    (92, "bsd-3-clause", "endorse", r"neither the names? of [^.]{1,150}? contributors may be used to endorse or promote products derived"),
    (91, "bsd-3-clause", "endorse", r"the names? of the authors? may not be used to endorse or promote products derived"),
    (93, "bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display"),
    (93, "bsd-3-clause-clear", "patent", r"no express or implied licen[sc]es to any party's patent rights are granted"),
    (70, "bsd", "provided", r"this software is provided by the (?:copyright holders and contributors|regents and contributors|author(?:s|\(s\))?) [\"'`]{0,2}as is"),
    (70, "bsd", "indirect", r"be liable for any direct,? indirect,? incidental,? special,? exemplary,? or consequential damages"),
    (90, "zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    (90, "zlib", "altered", r"altered source versions must be plainly marked as such"),
    (72, "zlib", "implied", r"this software is provided [\"'`]{0,2}as-?is[\"'`]{0,2},? without any express or implied warranty"),
    (90, "ncsa", "deal", r"to deal with the software without restriction"),
    (90, "bsl-1.0", "boost", r"boost software licen[sc]e - version 1\.0"),
    (92, "bsl-1.0", "accompanying", r"obtaining a copy of the software and accompanying documentation covered by this licen[sc]e"),
    (90, "unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    (85, "unlicense", "dedicate", r"dedicate any and all copyright interest in the software to the public domain"),
    (90, "wtfpl", "fuck", r"do what the fuck you want to(?: public licen[sc]e)?"),
    (90, "postgresql", "paragraph", r"without a written agreement is hereby granted,? provided that the above copyright notice and this paragraph"),
    (90, "python-2.0", "licensee", r"hereby grants licensee a non-?exclusive,? royalty-?free,? world-?wide licen[sc]e to reproduce"),
    (90, "openssl", "openssl", r"this product includes software developed by the openssl project"),
    (88, "ssleay", "eric", r"this product includes (?:cryptographic )?software written by eric young"),
    (88, "bsd-4-clause", "berkeley", r"this product includes software developed by the university of california,? berkeley"),
    (88, "apache-1.1", "apache", r"this product includes software developed by the apache software foundation"),
    (88, "apache-1.1", "apache", r"the names? [\"'`]{0,2}apache[\"'`]{0,2} and [\"'`]{0,2}apache software foundation[\"'`]{0,2} must not be used to endorse"),
    (90, "unicode", "unicode", r"unicode data files and any associated documentation"),
    (90, "w3c", "w3c", r"by obtaining,? using and/or copying this work,? you \(the licensee\) agree [^.]{0,80}?w3c"),
    (90, "ijg", "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    (90, "libpng", "png", r"the png reference library is supplied [\"'`]{0,2}as is"),
    (60, "curl", "curl", r"(?:the )?curl licen[sc]e"),
    (90, "beerware", "beer", r"if we meet some day,? and you think this stuff is worth it,? you can buy me a beer"),
    (88, "json", "evil", r"the software shall be used for good,? not evil"),
    (90, "mulanpsl-2.0", "mulan", r"mulan permissive software licen[sc]e,? version 2"),
    (90, "ms-pl", "microsoft", r"microsoft public licen[sc]e(?: \(ms-pl\))?"),
    (90, "ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e(?: \(ms-rl\))?"),
    (90, "upl-1.0", "universal", r"(?:the )?universal permissive licen[sc]e(?: \(upl\))?,? version 1\.0"),
    (85, "afl-3.0", "academic", r"academic free licen[sc]e,?(?: version| v\.?)? ?3\.0"),
    (60, "afl", "academic", r"academic free licen[sc]e"),
    (85, "ecl-2.0", "educational", r"educational community licen[sc]e,?(?: version)? ?2\.0"),
    (60, "ecl", "educational", r"educational community licen[sc]e"),
    (85, "zpl-2.1", "zope", r"zope public licen[sc]e(?: \(zpl\))?,?(?: version)? ?2\.1"),
    (60, "zpl", "zope", r"zope public licen[sc]e"),
    (60, "vim", "vim", r"vim licen[sc]e"),
    (60, "ruby", "ruby", r"(?:the )?ruby(?:'s)? licen[sc]e"),
    (60, "php", "php", r"(?:the )?php licen[sc]e,?(?: version)?(?: 3\.0[01]?)?"),
    (60, "fsf-all-permissive", "copying", r"copying and distribution of this file,? with or without modification,? are permitted in any medium"),
    # --- apache
    (92, "apache-2.0", "apache", r"licensed under the apache licen[sc]e,? version 2\.0 \(the [\"'`]{0,2}licen[sc]e[\"'`]{0,2}\)"),
    (88, "apache-2.0", "apache", r"(?:licen[sc]ed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?apache(?: software)? licen[sc]e,? ?(?:version|v\.?)? ?2(?:\.0)?"),
    (80, "apache-2.0", "apache", r"apache(?: software)? licen[sc]e,? ?(?:version|v\.?|ver\.?)? ?2(?:\.0)?"),
    (80, "apache-2.0", "apache", r"apache-2\.0"),
    (88, "apache-2.0", "apache.org", r"https?:[/]{2}(?:www\.)?apache\.org/licen[sc]es/licen[sc]e-2\.0(?:\.txt|\.html)?"),
    (75, "apache-2.0", "compliance", r"you may not use this file except in compliance with the licen[sc]e"),
    (70, "apache-2.0", "applicable", r"unless required by applicable law or agreed to in writing,? software distributed under the licen[sc]e"),
    (74, "apache-2.0", "contributor", r"licensed to the apache software foundation \(asf\) under one or more contributor licen[sc]e agreements"),
    (80, "apache-1.1", "apache", r"apache(?: software)? licen[sc]e,? ?(?:version|v\.?|ver\.?)? ?1\.1"),
    (80, "apache-1.0", "apache", r"apache(?: software)? licen[sc]e,? ?(?:version|v\.?|ver\.?)? ?1\.0"),
    (60, "apache", "apache", r"apache(?: software| public)? licen[sc]e"),
    # --- gnu
    (96, "gpl-2.0-or-later", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation[;,] either version 2 of the licen[sc]e,? or \(?at your option\)? any later version"),
    (96, "gpl-3.0-or-later", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu general public licen[sc]e as published by the free software foundation[;,] either version 3 of the licen[sc]e,? or \(?at your option\)? any later version"),
    (96, "gpl-2.0-only", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu general public licen[sc]e version 2 as published by the free software foundation"),
    (96, "lgpl-2.1-or-later", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation[;,] either version 2\.1 of the licen[sc]e,? or \(?at your option\)? any later version"),
    (96, "lgpl-2.0-or-later", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu library general public licen[sc]e as published by the free software foundation[;,] either version 2 of the licen[sc]e,? or \(?at your option\)? any later version"),
    (96, "lgpl-3.0-or-later", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu lesser general public licen[sc]e as published by the free software foundation[;,] either version 3 of the licen[sc]e,? or \(?at your option\)? any later version"),
    (96, "agpl-3.0-or-later", "redistribute", r"you can redistribute it and/or modify it under the terms of the gnu affero general public licen[sc]e as published by the free software foundation[;,] either version 3 of the licen[sc]e,? or \(?at your option\)? any later version"),
    (75, "gpl", "redistribute", r"free software[:;,]? you can redistribute it and/or modify"),
    (70, "gpl", "hope", r"(?:is )?distributed in the hope that it will be useful,? but without any warranty"),
    (74, "gpl", "received", r"you should have received a copy of the gnu general public licen[sc]e"),
    (76, "lgpl", "received", r"you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e"),
    (76, "agpl-3.0", "received", r"you should have received a copy of the gnu affero general public licen[sc]e"),
    (72, "gpl", "foundation", r"write to the free software foundation"),
    (90, "gpl-2.0", "freedom", r"the licen[sc]es for most software are designed to take away your freedom to share and change it"),
    (90, "gpl-3.0", "freedom", r"the licen[sc]es for most software and other practical works are designed to take away your freedom"),
    (90, "gpl-3.0", "copyleft", r"the gnu general public licen[sc]e is a free,? copyleft licen[sc]e"),
    (90, "agpl-3.0", "copyleft", r"the gnu affero general public licen[sc]e is a free,? copyleft licen[sc]e"),
    (90, "lgpl-3.0", "incorporates", r"this version of the gnu lesser general public licen[sc]e incorporates the terms and conditions of version 3"),
    (90, "lgpl-2.1", "successor", r"this is the first released version of the lesser gpl[^.]{0,40}? (?:it also counts as )?the successor of the gnu library public licen[sc]e"),
    (82, "agpl-3.0-or-later", "affero", r"(?:gnu )?affero (?:general public licen[sc]e|gpl),? ?(?:version|v\.?)? ?3(?:\.0)?,? (?:or|and) (?:\(?at your option\)?,? )?(?:any )?(?:later|newer|above)"),
    (82, "agpl-3.0-or-later", "agpl", r"agpl[ -]?(?:version |v\.? ?)?3(?:\.0)?(?:\+|-or-later|,? or (?:any )?later)"),
    (80, "agpl-3.0-only", "agpl", r"agpl-3\.0-only"),
    (80, "agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e,? ?(?:\(agpl\),? ?)?(?:version|v\.?)? ?3(?:\.0)?"),
    (80, "agpl-3.0", "agpl", r"(?:gnu )?agpl,?[ -]?(?:version |v\.? ?)?3(?:\.0)?"),
    (60, "agpl", "affero", r"(?:gnu )?affero (?:general public licen[sc]e|gpl)"),
    (50, "agpl", "agpl", r"(?:gnu )?agpl"),
    (83, "lgpl-2.1-or-later", "lesser", r"(?:gnu )?lesser general public licen[sc]e,? ?(?:\(lgpl\),? ?)?(?:version|v\.?)? ?2\.1,? (?:or|and) (?:\(?at your option\)?,? )?(?:any )?(?:later|newer)"),
    (83, "lgpl-3.0-or-later", "lesser", r"(?:gnu )?lesser general public licen[sc]e,? ?(?:\(lgpl\),? ?)?(?:version|v\.?)? ?3(?:\.0)?,? (?:or|and) (?:\(?at your option\)?,? )?(?:any )?(?:later|newer)"),
    (83, "lgpl-2.1-or-later", "lgpl", r"lgpl,?[ -]?(?:version |v\.? ?)?2\.1(?:\+|-or-later|,? or (?:any )?later)"),
    (83, "lgpl-3.0-or-later", "lgpl", r"lgpl,?[ -]?(?:version |v\.? ?)?3(?:\.0)?(?:\+|-or-later|,? or (?:any )?later)"),
    (81, "lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[sc]e,? ?(?:\(lgpl\),? ?)?(?:version|v\.?)? ?2\.1"),
    (81, "lgpl-2.0", "library", r"(?:gnu )?library general public licen[sc]e,? ?(?:\(lgpl\),? ?)?(?:version|v\.?)? ?2(?:\.0)?"),
    (81, "lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[sc]e,? ?(?:\(lgpl\),? ?)?(?:version|v\.?)? ?3(?:\.0)?"),
    (81, "lgpl-2.1", "lgpl", r"(?:gnu )?lgpl,?[ -]?(?:version |v\.? ?)?2\.1"),
    (81, "lgpl-2.0", "lgpl", r"(?:gnu )?lgpl,?[ -]?(?:version |v\.? ?)?2(?:\.0)?"),
    (81, "lgpl-3.0", "lgpl", r"(?:gnu )?lgpl,?[ -]?(?:version |v\.? ?)?3(?:\.0)?"),
    (60, "lgpl", "lesser", r"(?:gnu )?lesser general public licen[sc]e"),
    (60, "lgpl", "library", r"(?:gnu )?library general public licen[sc]e"),
    (50, "lgpl", "lgpl", r"(?:gnu )?lgpl"),
    (84, "gpl-2.0-or-later", "general", r"(?:gnu )?general public licen[sc]e,? ?(?:\(gpl\),? ?)?(?:version|v\.?)? ?2(?:\.0)?,? (?:or|and) (?:\(?at your option\)?,? )?(?:any )?(?:later|newer)"),
    (84, "gpl-3.0-or-later", "general", r"(?:gnu )?general public licen[sc]e,? ?(?:\(gpl\),? ?)?(?:version|v\.?)? ?3(?:\.0)?,? (?:or|and) (?:\(?at your option\)?,? )?(?:any )?(?:later|newer)"),
    (84, "gpl-2.0-or-later", "gpl", r"gpl,?[ -]?(?:version |v\.? ?)?2(?:\.0)?(?:\+|-or-later|,? or (?:any )?later)"),
    (84, "gpl-3.0-or-later", "gpl", r"gpl,?[ -]?(?:version |v\.? ?)?3(?:\.0)?(?:\+|-or-later|,? or (?:any )?later)"),
    (84, "gpl-2.0-only", "general", r"(?:gnu )?general public licen[sc]e,? ?(?:version|v\.?)? ?2(?:\.0)? only"),
    (84, "gpl-2.0-only", "gpl", r"gpl,?[ -]?(?:version |v\.? ?)?2(?:\.0)?[ -]only"),
    (84, "gpl-3.0-only", "gpl", r"gpl,?[ -]?(?:version |v\.? ?)?3(?:\.0)?[ -]only"),
    (82, "gpl-2.0", "general", r"version 2 of the (?:gnu )?general public licen[sc]e"),
    (82, "gpl-3.0", "general", r"version 3 of the (?:gnu )?general public licen[sc]e"),
    (80, "gpl-1.0", "general", r"(?:gnu )?general public licen[sc]e,? ?(?:\(gpl\),? ?)?(?:version|v\.?)? ?1(?:\.0)?"),
    (80, "gpl-2.0", "general", r"(?:gnu )?general public licen[sc]e,? ?(?:\(gpl\),? ?)?(?:version|v\.?)? ?2(?:\.0)?"),
    (80, "gpl-3.0", "general", r"(?:gnu )?general public licen[sc]e,? ?(?:\(gpl\),? ?)?(?:version|v\.?)? ?3(?:\.0)?"),
    (80, "gpl-1.0", "gpl", r"(?:gnu )?gpl,?[ -]?(?:version |v\.? ?)?1(?:\.0)?"),
    (80, "gpl-2.0", "gpl", r"(?:gnu )?gpl,?[ -]?(?:version |v\.? ?)?2(?:\.0)?"),
    (80, "gpl-3.0", "gpl", r"(?:gnu )?gpl,?[ -]?(?:version |v\.? ?)?3(?:\.0)?"),
    (60, "gpl", "general", r"(?:gnu )?general public licen[sc]e"),
    (60, "gpl", "gnu", r"gnu public licen[sc]e"),
    (50, "gpl", "gpl", r"(?:gnu )?gpl"),
    (50, "gpl", "copyleft", r"under (?:a )?copyleft licen[sc]e"),
    (88, "gpl-2.0", "gnu.org", r"https?:[/]{2}(?:www\.)?gnu\.org/licen[sc]es/(?:old-licen[sc]es/)?gpl-2\.0(?:\.txt|\.html|\.en\.html)?"),
    (88, "gpl-3.0", "gnu.org", r"https?:[/]{2}(?:www\.)?gnu\.org/licen[sc]es/gpl-3\.0(?:\.txt|\.html|\.en\.html)?"),
    (88, "lgpl", "gnu.org", r"https?:[/]{2}(?:www\.)?gnu\.org/licen[sc]es/lgpl(?:-[23]\.[01])?(?:\.txt|\.html|\.en\.html)?"),
    (88, "agpl-3.0", "gnu.org", r"https?:[/]{2}(?:www\.)?gnu\.org/licen[sc]es/agpl(?:-3\.0)?(?:\.txt|\.html|\.en\.html)?"),
    (85, "gpl", "gnu.org", r"https?:[/]{2}(?:www\.)?gnu\.org/licen[sc]es/gpl(?:\.txt|\.html|\.en\.html)?"),
    (92, "gfdl", "invariant", r"with no invariant sections,? (?:with )?no front-cover texts,? and (?:with )?no back-cover texts"),
    (82, "gfdl-1.3", "documentation", r"(?:gnu )?free documentation licen[sc]e,? ?(?:version|v\.?)? ?1\.3"),
    (82, "gfdl-1.2", "documentation", r"(?:gnu )?free documentation licen[sc]e,? ?(?:version|v\.?)? ?1\.2"),
    (82, "gfdl-1.1", "documentation", r"(?:gnu )?free documentation licen[sc]e,? ?(?:version|v\.?)? ?1\.1"),
    (60, "gfdl", "documentation", r"(?:gnu )?free documentation licen[sc]e"),
    (50, "gfdl", "gfdl", r"(?:gnu )?gfdl(?:[ -]1\.[123])?"),
    # --- exceptions
    (90, "classpath-exception-2.0", "independent", r"as a special exception,? the copyright holders of this library give you permission to link this library with independent modules"),
    (82, "classpath-exception-2.0", "classpath", r"(?:with )?(?:the )?(?:gnu )?classpath exception"),
    (90, "gcc-exception", "gcc", r"gcc runtime library exception(?:,? version 3\.1)?"),
    (90, "autoconf-exception", "autoconf", r"as a special exception[^.]{0,150}?configuration script generated by autoconf"),
    (90, "bison-exception", "bison", r"as a special exception,? you may create a larger work that contains part or all of the bison parser skeleton"),
    (88, "linux-syscall-note", "kernel", r"this copyright does \*?not\*? cover user programs that use kernel services by normal system calls"),
    (82, "llvm-exception", "llvm", r"apache(?: licen[sc]e,?)?(?: v\.?| version)? ?2\.0 with llvm exceptions?"),
    (70, "openssl-exception", "openssl", r"permission to link [^.]{0,80}?with the openssl (?:project's )?(?:[\"'`]openssl[\"'`] )?library"),
    (65, "gpl-exception", "exception", r"as a special exception to the gnu (?:lesser )?general public licen[sc]e"),
    # --- other copyleft
    (92, "mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[sc]e,? v\. ?2\.0"),
    (92, "mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public licen[sc]e version 1\.1"),
    (88, "mpl-2.0", "mozilla.org", r"https?:[/]{2}(?:www\.)?mozilla\.org/(?:en-us/)?mpl/2\.0/?"),
    (75, "mpl-2.0", "mpl", r"if a copy of the mpl was not distributed with this file"),
    (80, "mpl-2.0", "mozilla", r"mozilla public licen[sc]e,? ?(?:\(mpl\),? ?)?(?:version|v\.?)? ?2(?:\.0)?"),
    (80, "mpl-1.1", "mozilla", r"mozilla public licen[sc]e,? ?(?:\(mpl\),? ?)?(?:version|v\.?)? ?1\.1"),
    (80, "mpl-1.0", "mozilla", r"mozilla public licen[sc]e,? ?(?:\(mpl\),? ?)?(?:version|v\.?)? ?1\.0"),
    (60, "mpl", "mozilla", r"mozilla public licen[sc]e"),
    (55, "mpl-2.0", "mpl", r"mpl,?[ -]?(?:version |v\.? ?)?2(?:\.0)?"),
    (55, "mpl-1.1", "mpl", r"mpl,?[ -]?(?:version |v\.? ?)?1\.1"),
    (60, "npl", "netscape", r"netscape public licen[sc]e"),
    (90, "epl-2.0", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e,? ?(?:version|v\.?)? ?2\.0"),
    (90, "epl-1.0", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e,? ?(?:version|v\.?)? ?1\.0"),
    (80, "epl-2.0", "eclipse", r"eclipse public licen[sc]e,? ?(?:-|version|v\.?)? ?2(?:\.0)?"),
    (80, "epl-1.0", "eclipse", r"eclipse public licen[sc]e,? ?(?:-|version|v\.?)? ?1(?:\.0)?"),
    (60, "epl", "eclipse", r"eclipse public licen[sc]e"),
    (55, "epl-2.0", "epl", r"epl[ -](?:version |v\.? ?)?2(?:\.0)?"),
    (55, "epl-1.0", "epl", r"epl[ -](?:version |v\.? ?)?1(?:\.0)?"),
    (60, "edl", "eclipse", r"eclipse distribution licen[sc]e(?:,? ?-?(?:version|v\.?)? ?1\.0)?"),
    (80, "cddl-1.0", "development", r"common development and distribution licen[sc]e,? ?(?:\(cddl\),? ?)?(?:version|v\.?)? ?1\.0"),
    (80, "cddl-1.1", "development", r"common development and distribution licen[sc]e,? ?(?:\(cddl\),? ?)?(?:version|v\.?)? ?1\.1"),
    (60, "cddl", "development", r"common development and distribution licen[sc]e"),
    (50, "cddl", "cddl", r"cddl(?:[ -](?:v\.? ?)?1\.[01])?"),
    (60, "cpl-1.0", "licen", r"common public licen[sc]e(?:,? ?-?(?:version|v\.?)? ?1\.0)?"),
    (60, "ipl-1.0", "ibm", r"ibm public licen[sc]e(?:,? ?-?(?:version|v\.?)? ?1\.0)?"),
    (82, "eupl-1.2", "european", r"european union public licen[sc]e,? ?(?:\(eupl\),? ?)?(?:version|v\.?)? ?1\.2"),
    (82, "eupl-1.1", "european", r"european union public licen[sc]e,? ?(?:\(eupl\),? ?)?(?:version|v\.?)? ?1\.1"),
    (60, "eupl", "european", r"european union public licen[sc]e"),
    (50, "eupl", "eupl", r"eupl(?:,?[ -](?:version |v\.? ?)?1\.[012])?"),
    (82, "artistic-2.0", "artistic", r"(?:the )?artistic licen[sc]e,? ?(?:version|v\.?)? ?2\.0"),
    (82, "artistic-1.0", "artistic", r"(?:the )?artistic licen[sc]e,? ?(?:version|v\.?)? ?1\.0"),
    (85, "artistic-1.0", "perl", r"under the same terms as perl itself"),
    (60, "artistic", "artistic", r"(?:the )?(?:perl )?artistic licen[sc]e"),
    (60, "osl-3.0", "licen", r"open software licen[sc]e,? ?(?:version|v\.?)? ?3\.0"),
    (60, "cecill", "cecill", r"cecill(?:-[bc])?(?: free software)? licen[sc]e(?: agreement)?"),
    (60, "qpl-1.0", "public", r"q public licen[sc]e(?:,? (?:version )?1\.0)?"),
    (60, "sleepycat", "sleepycat", r"sleepycat (?:public )?licen[sc]e"),
    (85, "sspl-1.0", "server", r"server side public licen[sc]e(?:,? (?:version|v\.?) ?1)?"),
    (85, "busl-1.1", "business", r"business source licen[sc]e(?:,? ?(?:version|v\.?)? ?1\.1)?"),
    (85, "elastic-2.0", "elastic", r"elastic licen[sc]e(?:,? ?(?:version|v\.?)? ?2(?:\.0)?)?"),
    (85, "commons-clause", "clause", r"commons clause(?: licen[sc]e)?(?: condition)?(?: v\.? ?1\.0)?"),
    (85, "polyform", "polyform", r"polyform (?:non-?commercial|shield|small business|strict|free trial) licen[sc]e"),
    (80, "rail", "rail", r"(?:creativeml )?open ?rail(?:-m|\+\+-m)?(?: licen[sc]e)?"),
    # --- names without a text
    (62, "mit", "mit", r"(?:the )?mit(?:[ -](?:style|x11))? licen[sc]e"),
    (60, "mit", "expat", r"(?:the )?expat licen[sc]e"),
    (60, "x11", "x11", r"(?:the )?x11 licen[sc]e"),
    (66, "bsd-2-clause", "bsd", r"(?:the )?(?:simplified|2-clause|two-clause|freebsd)(?: freebsd)? bsd(?: licen[sc]e)?"),
    (66, "bsd-2-clause", "bsd", r"bsd[ -](?:2|two)[ -]?clause(?: licen[sc]e)?"),
    (66, "bsd-3-clause", "bsd", r"(?:the )?(?:new|modified|revised|3-clause|three-clause) bsd(?: licen[sc]e)?"),
    (66, "bsd-3-clause", "bsd", r"bsd[ -](?:3|three)[ -]?clause(?: licen[sc]e)?"),
    (66, "bsd-4-clause", "bsd", r"(?:the )?(?:original|old|4-clause|four-clause) bsd(?: licen[sc]e)?"),
    (66, "bsd-4-clause", "bsd", r"bsd[ -](?:4|four)[ -]?clause(?: licen[sc]e)?"),
    (60, "bsd", "bsd", r"(?:the )?bsd(?:[ -]style)? licen[sc]e"),
    (60, "isc", "isc", r"(?:the )?isc licen[sc]e"),
    (60, "zlib", "zlib", r"(?:the )?zlib(?:/libpng)? licen[sc]e"),
    (60, "bsl-1.0", "boost", r"(?:the )?boost(?: software)? licen[sc]e(?:,? (?:version )?1\.0)?"),
    (60, "unlicense", "unlicense", r"(?:the )?unlicense"),
    (55, "wtfpl", "wtfpl", r"(?:the )?wtfpl"),
    (60, "postgresql", "postgresql", r"(?:the )?postgresql licen[sc]e"),
    (60, "python-2.0", "python", r"python software foundation licen[sc]e(?:,? version 2)?"),
    (55, "python-2.0", "psf", r"psf licen[sc]e(?: agreement)?"),
    (60, "openssl", "openssl", r"(?:the )?openssl licen[sc]e"),
    (60, "ncsa", "illinois", r"university of illinois/ncsa open source licen[sc]e"),
    (60, "ofl-1.1", "font", r"(?:sil )?open font licen[sc]e(?:,? ?(?:version|v\.?)? ?1\.[01])?"),
    (92, "ofl-1.1", "font", r"this font software is licensed under the sil open font licen[sc]e,? version 1\.1"),
    (60, "odbl-1.0", "database", r"open database licen[sc]e(?: \(odbl\))?(?:,? ?v?1\.0)?"),
    (50, "odbl-1.0", "odbl", r"odbl(?:[ -]1\.0)?"),
    (60, "odc-by", "commons", r"open data commons attribution licen[sc]e(?: v?1\.0)?"),
    (60, "pddl", "commons", r"open data commons public domain dedication (?:and|&) licen[sc]e"),
    (60, "ogl", "government", r"open government licen[sc]e(?: v?[123]\.0)?"),
    (60, "cdla", "community", r"community data licen[sc]e agreement(?: - (?:permissive|sharing))?"),
    # --- creative commons
    (85, "cc0-1.0", "commons", r"creative commons (?:cc0|zero)(?: 1\.0)?(?: universal)?"),
    (80, "cc0-1.0", "cc0", r"cc0(?:[ -]1\.0)?(?: universal)?"),
    (86, "cc0-1.0", "creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0"),
    (60, "pdm", "creativecommons", r"creativecommons\.org/publicdomain/mark/1\.0"),
    (86, "cc-by-nc-nd", "creativecommons", r"creativecommons\.org/licen[sc]es/by-nc-nd/[1-4]\.[05]"),
    (86, "cc-by-nc-sa", "creativecommons", r"creativecommons\.org/licen[sc]es/by-nc-sa/[1-4]\.[05]"),
    (86, "cc-by-nc", "creativecommons", r"creativecommons\.org/licen[sc]es/by-nc/[1-4]\.[05]"),
    (86, "cc-by-nd", "creativecommons", r"creativecommons\.org/licen[sc]es/by-nd/[1-4]\.[05]"),
    (86, "cc-by-sa", "creativecommons", r"creativecommons\.org/licen[sc]es/by-sa/[1-4]\.[05]"),
    (86, "cc-by", "creativecommons", r"creativecommons\.org/licen[sc]es/by/[1-4]\.[05]"),
    (84, "cc-by-nc-nd", "commons", r"creative commons[ :-]+attribution[ -]+non-?commercial[ -]+no-?deriv(?:ative)?s?(?: works)?(?: [1-4]\.[05])?"),
    (84, "cc-by-nc-sa", "commons", r"creative commons[ :-]+attribution[ -]+non-?commercial[ -]+share-?alike(?: [1-4]\.[05])?"),
    (82, "cc-by-nc", "commons", r"creative commons[ :-]+attribution[ -]+non-?commercial(?: [1-4]\.[05])?"),
    (82, "cc-by-nd", "commons", r"creative commons[ :-]+attribution[ -]+no-?deriv(?:ative)?s?(?: works)?(?: [1-4]\.[05])?"),
    (82, "cc-by-sa", "commons", r"creative commons[ :-]+attribution[ -]+share-?alike(?: [1-4]\.[05])?"),
    (80, "cc-by", "commons", r"creative commons[ :-]+attribution(?: [1-4]\.[05])?(?: international| unported| generic)?"),
    (78, "cc-by-nc-nd", "cc", r"cc[ -]+by[ -]+nc[ -]+nd(?:[ -]+[1-4]\.[05])?"),
    (78, "cc-by-nc-sa", "cc", r"cc[ -]+by[ -]+nc[ -]+sa(?:[ -]+[1-4]\.[05])?"),
    (76, "cc-by-nc", "cc", r"cc[ -]+by[ -]+nc(?:[ -]+[1-4]\.[05])?"),
    (76, "cc-by-nd", "cc", r"cc[ -]+by[ -]+nd(?:[ -]+[1-4]\.[05])?"),
    (76, "cc-by-sa", "cc", r"cc[ -]+by[ -]+sa(?:[ -]+[1-4]\.[05])?"),
    (74, "cc-by", "cc", r"cc[ -]+by(?:[ -]+[1-4]\.[05])?"),
    (55, "cc", "commons", r"creative commons(?: public)? licen[sc]e"),
    # --- statements
    (45, "proprietary", "proprietary", r"(?:this (?:software|work|document|file) is )?(?:confidential and proprietary|proprietary and confidential)"),
    (45, "proprietary", "unauthori", r"unauthori[sz]ed copying of this (?:file|software|document)"),
    (40, "proprietary", "prohibited", r"(?:re)?distribution (?:or use )?(?:of this (?:file|work|software) )?is (?:strictly )?prohibited"),
    (40, "proprietary", "written", r"(?:without|unless with) (?:the )?(?:express |prior )*written (?:permission|consent) (?:of|from) the (?:author|owner|publisher|copyright holder)"),
    (42, "non-commercial", "commercial", r"(?:free )?for (?:personal(?: and| or|,)? )?non-?commercial (?:use|purposes)(?: only)?"),
    (42, "no-derivatives", "derivative", r"no derivative works (?:are )?(?:permitted|allowed)"),
    (40, "reserved", "reserved", r"all rights reserved"),
    (38, "reserved", "reserved", r"some rights reserved"),
    (38, "copyright-free", "copyright", r"no copyright is (?:claimed|asserted)"),
    (35, "public-domain", "domain", r"(?:placed |released |dedicated )?(?:in|in ?to|to) the public domain"),
    (35, "public-domain", "domain", r"public domain (?:work|dedication|software)"),
    (35, "attribution", "attribution", r"(?:with|requires?|provide) (?:proper |appropriate )?attribution to the (?:author|source|owner)"),
    (30, "versioned", "version", r"(?:released|licen[sc]ed|distributed) under version [1-4](?:\.[0-9])?\.? of the (?:terms|licen[sc]e)"),
    (25, "licensed", "licen", r"(?:is |are )?(?:licen[sc]ed|sublicen[sc]ed) under (?:the )?(?:terms of )?(?:the )?[a-z0-9.+-]{2,30} licen[sc]e"),
    (20, "license-file", "licen|copying|copyright", r"see (?:the )?(?:accompanying )?(?:licen[sc]e|copying|copyright)(?:\.txt|\.md)? (?:file|for (?:more )?details|for (?:the )?(?:full )?licen[sc]e)"),
    (15, "copyright", "copyright", r"copyright (?:\(c\) |© )?(?:19|20)\d\d"),
    (15, "copyright", "(c)", r"\(c\) (?:copyright )?(?:19|20)\d\d"),
    (15, "copyright", "©", r"© (?:copyright )?(?:19|20)\d\d"),
)
