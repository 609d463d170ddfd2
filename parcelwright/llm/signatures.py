"""Signatures written by hand: sentences of licence texts, notices in file headers, and words on rights that name no licence.

Each is a label, a weight and a regular expression over lower-case words with one space between them; ``{w}`` is any word.
Fixed values: the wording is that of the published licences.
"""

from __future__ import annotations

SIGNATURES: tuple[tuple[str, float, str], ...] = (
    # MIT and its relatives
    ("mit", 0.97, r"permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?"),
    ("mit", 0.95, r"to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", 0.95, r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software"),
    ("mit", 0.9, r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit", 0.9, r"whether in an action of contract tort or otherwise arising from out of or in connection with the software"),
    ("mit", 0.95, r"mit license http opensource org licenses mit"),
    ("mit", 0.95, r"(?:see|read) the (?:file )?license(?: txt| md)?(?: file)? for the (?:full )?mit license"),
    ("mit", 0.9, r"use of this source code is governed by (?:an|the) mit (?:style )?license"),
    ("mit-0", 0.95, r"to whom the software is furnished to do so the software is provided as is"),
    ("x11", 0.95, r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("x11", 0.95, r"x window system is a trademark of (?:the )?x consortium"),
    ("curl", 0.95, r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("mit-modern", 0.95, r"permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute this software"),
    ("hpnd", 0.95, r"permission to use copy modify distribute and sell this software and its documentation for any purpose is hereby granted without fee"),
    ("hpnd", 0.92, r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("hpnd", 0.9, r"no representations are made about the suitability of this software for any purpose"),
    ("ntp", 0.95, r"makes no representations about the suitability this software for any purpose"),
    ("json", 0.97, r"the software shall be used for good not evil"),
    ("beerware", 0.97, r"the beer ?ware license(?: revision [0-9]+)?"),
    ("beerware", 0.95, r"if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    # ISC, zlib, Boost, Unlicense and others that are short
    ("isc", 0.97, r"permission to use copy modify and or distribute this software for any purpose with or without fee(?: is hereby granted)?"),
    ("isc", 0.92, r"in no event shall (?:the author|isc) be liable for any special direct indirect or consequential damages"),
    ("zlib", 0.97, r"permission is granted to anyone to use this software for any purpose including commercial applications(?: and to alter it and redistribute it freely)?"),
    ("zlib", 0.95, r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 0.95, r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", 0.9, r"this notice may not be removed or altered from any source distribution"),
    ("bsl-1", 0.97, r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsl-1", 0.95, r"distributed under the boost software license version 1 0"),
    ("bsl-1", 0.92, r"unless such copies or derivative works are solely in the form of machine executable object code"),
    ("unlicense", 0.97, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 0.95, r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", 0.92, r"in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest"),
    ("wtfpl", 0.97, r"do what the fuck you want to public license"),
    ("cc0", 0.95, r"to the extent possible under law (?:{w} ){0,8}has waived all copyright and related or neighboring rights"),
    ("cc0", 0.95, r"creativecommons org publicdomain zero 1 0"),
    ("cc0", 0.9, r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", 0.9, r"creative commons zero(?: v?1 0)?(?: universal)?"),
    ("pdm", 0.92, r"creativecommons org publicdomain mark 1 0"),
    ("vim", 0.95, r"vim is charityware you can use and copy it as much as you like"),
    ("sqlite-blessing", 0.97, r"the author disclaims copyright to this source code in place of a legal notice here is a blessing"),
    ("0bsd", 0.95, r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("postgresql", 0.95, r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("unicode", 0.95, r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("ofl-1.1", 0.97, r"this font software is licensed under the sil open font license"),
    ("ofl-1.1", 0.95, r"the font software may be sold as part of a larger software package but no copy of one or more of the fonts may be sold by itself"),
    ("ofl-1.1", 0.92, r"no modified version of the font software may use the reserved font name"),
    ("bitstream-vera", 0.95, r"bitstream vera is a trademark of bitstream"),
    # BSD family
    ("bsd", 0.9, r"redistribution and use in source and binary forms(?: with or without modification)?(?: are permitted provided that the following conditions are met)?"),
    ("bsd", 0.92, r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", 0.92, r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3", 0.95, r"neither the name of (?:{w} ){1,12}nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3", 0.92, r"the names? of (?:{w} ){1,8}may not be used to endorse or promote products derived from this software without (?:specific )?prior written permission"),
    ("bsd-3-clear", 0.95, r"no express or implied licenses to any party s patent rights are granted by this license"),
    ("bsd-3-no-nuclear", 0.95, r"this software is not designed licensed or intended for use in the design construction operation or maintenance of any nuclear facility"),
    ("bsd-4", 0.95, r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-4-uc", 0.95, r"this product includes software developed by the university of california berkeley and its contributors"),
    ("bsd-2-views", 0.92, r"the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies"),
    ("bsd-2-patent", 0.95, r"each copyright holder and contributor hereby grants to those receiving rights under this license a perpetual worldwide non exclusive"),
    ("bsd", 0.9, r"use of this source code is governed by a bsd style license(?: that can be found in the license file)?"),
    ("bsd", 0.9, r"in no event shall the (?:copyright (?:owner|holder|holders)|regents|author) or contributors be liable for any direct indirect incidental special exemplary or consequential damages"),
    ("bsd-protection", 0.95, r"the bsd protection license"),
    ("bsd-source-code", 0.92, r"redistributions of source code must retain the above copyright notice this condition and the following disclaimer"),
    # Apache
    ("apache-2", 0.97, r"licensed under the apache license version 2 0 the license"),
    ("apache-2", 0.95, r"you may not use this file except in compliance with the license"),
    ("apache-2", 0.95, r"you may obtain a copy of the license at (?:https? )?(?:www )?apache org licenses license 2 0"),
    ("apache-2", 0.92, r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2", 0.92, r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2", 0.95, r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache-2", 0.92, r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated in this section patent) license"),
    ("apache-2", 0.9, r"you must cause any modified files to carry prominent notices stating that you changed the files"),
    ("apache-2", 0.95, r"apache license version 2 0 january 2004"),
    ("apache-1.1", 0.95, r"this product includes software developed by the apache software foundation"),
    ("apache-1.1", 0.92, r"products derived from this software may not be called apache nor may apache appear in their name"),
    ("apache-1.0", 0.95, r"this product includes software developed by the apache group for use in the apache http server project"),
    ("ecl-2", 0.92, r"licensed under the educational community license version 2 0"),
    # GNU
    ("gpl", 0.95, r"you can redistribute it and or modify it under the terms of the gnu general public license(?: as published by the free software foundation)?"),
    ("lgpl", 0.95, r"you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license(?: as published by the free software foundation)?"),
    ("agpl", 0.95, r"you can redistribute it and or modify it under the terms of the gnu affero general public license(?: as published by the free software foundation)?"),
    ("gpl-3-or-later", 0.95, r"as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("gpl-2-or-later", 0.95, r"as published by the free software foundation either version 2 of the license or at your option any later version"),
    ("gpl-1-or-later", 0.95, r"as published by the free software foundation either version 1 or at your option any later version"),
    ("lgpl-2.1-or-later", 0.95, r"as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("gpl-2", 0.95, r"it under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl-2", 0.95, r"gnu general public license version 2 june 1991"),
    ("gpl-3", 0.95, r"gnu general public license version 3 29 june 2007"),
    ("lgpl-2.1", 0.95, r"gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", 0.95, r"gnu lesser general public license version 3 29 june 2007"),
    ("lgpl-2", 0.95, r"gnu library general public license version 2 june 1991"),
    ("agpl-3", 0.95, r"gnu affero general public license version 3 19 november 2007"),
    ("gpl", 0.9, r"you should have received a copy of the gnu general public license along with this (?:program|library|file)"),
    ("lgpl", 0.9, r"you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:program|library|file)"),
    ("agpl", 0.9, r"you should have received a copy of the gnu affero general public license along with this (?:program|library|file)"),
    ("gpl", 0.9, r"but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("lgpl", 0.9, r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu (?:lesser|library) general public license"),
    ("gpl", 0.9, r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", 0.9, r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3", 0.9, r"your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gpl", 0.9, r"free software foundation inc (?:51 franklin (?:st|street)|59 temple place|675 mass ave)"),
    ("gpl-classpath", 0.95, r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-classpath", 0.92, r"gnu general public license (?:version 2 )?with (?:the )?classpath exception"),
    ("gpl-gcc-exception", 0.95, r"the gcc runtime library exception(?: version 3 1)?"),
    ("gpl-bison-exception", 0.95, r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-linux-syscall", 0.95, r"this copyright does not cover user programs that use kernel services by normal system calls"),
    ("gpl-autoconf-exception", 0.95, r"if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("gfdl", 0.95, r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", 0.92, r"with no invariant sections no front cover texts and no back cover texts"),
    ("gnu-all-permissive", 0.95, r"copying and distribution of this file with or without modification are permitted in any medium without royalty"),
    ("fsf-unlimited", 0.95, r"this file is free software the free software foundation gives unlimited permission to copy and or distribute it"),
    ("gpl-verbatim", 0.9, r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    # Other copyleft
    ("mpl-2", 0.97, r"this source code form is subject to the terms of the mozilla public license(?: v(?:ersion)? 2 0)?"),
    ("mpl-2", 0.95, r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", 0.95, r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.1", 0.92, r"mpl 1 1 gpl 2 0 lgpl 2 1"),
    ("npl", 0.95, r"the contents of this file are subject to the netscape public license"),
    ("epl-1", 0.95, r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2", 0.95, r"this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0"),
    ("epl", 0.9, r"the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("edl-1", 0.95, r"eclipse distribution license v ?1 0"),
    ("cddl", 0.95, r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cddl", 0.92, r"you can obtain a copy of the license at usr src opensolaris license"),
    ("cpl-1", 0.95, r"the accompanying program is provided under the terms of this common public license"),
    ("ipl-1", 0.95, r"the accompanying program is provided under the terms of this ibm public license"),
    ("eupl", 0.95, r"licensed under the eupl(?: version 1 [12])?"),
    ("cecill", 0.95, r"this software is governed by the cecill(?: [bc])? license under french law"),
    ("osl", 0.95, r"licensed under the open software license version [1-3] [0-9]"),
    ("afl", 0.95, r"licensed under the academic free license version [1-3] [0-9]"),
    ("artistic", 0.92, r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2", 0.92, r"this license establishes the terms under which a given free software package may be copied modified distributed and or redistributed"),
    ("perl", 0.92, r"this (?:program|library|module) is free software you can redistribute it and or modify it under the same terms as perl itself"),
    ("ruby", 0.92, r"you can redistribute it and or modify it under either the terms of the (?:2 clause bsdl|gpl) (?:see the file|or the conditions below)"),
    ("php-3", 0.95, r"this source file is subject to version 3 0?1?(?: 0?1)? of the php license"),
    ("php-3", 0.92, r"products derived from this software may not be called php nor may php appear in their name"),
    ("openssl", 0.95, r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", 0.95, r"this product includes cryptographic software written by eric young"),
    ("psf-2", 0.92, r"psf hereby grants licensee a nonexclusive royalty free world wide license to reproduce analyze test perform and or display publicly"),
    ("tcl", 0.95, r"the authors hereby grant permission to use copy modify distribute and license this software and its documentation for any purpose"),
    ("lppl", 0.95, r"this work may be distributed and or modified under the conditions of the latex project public license"),
    ("icu", 0.92, r"provided that the above copyright notices and this permission notice appear in all copies of the software and that both the above copyright notices"),
    ("w3c", 0.95, r"by obtaining using and or copying this work you the licensee agree that you have read understood and will comply with the following terms"),
    ("zpl", 0.92, r"this software consists of contributions made by zope corporation"),
    ("imagemagick", 0.92, r"imagemagick studio llc organization dedicated to making software imaging solutions freely available"),
    ("ms-pl", 0.92, r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("upl-1", 0.92, r"subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
    ("blueoak", 0.95, r"blue oak model license(?: 1 0 0)?"),
    ("mulan-psl-2", 0.95, r"mulan psl v2"),
    ("hippocratic", 0.92, r"hippocratic license(?: [1-3] [0-9])?"),
    ("rail", 0.92, r"(?:creativeml )?open rail(?: {w})? m license"),
    ("llama-community", 0.92, r"llama (?:[23](?: [0-9])? )?community license(?: agreement)?"),
    ("sspl-1", 0.95, r"server side public license(?: version 1)?"),
    ("elastic-2", 0.95, r"elastic license (?:v )?2 ?0?"),
    ("busl-1.1", 0.95, r"business source license(?: version)?(?: 1 1)?"),
    ("busl-1.1", 0.92, r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("commons-clause", 0.95, r"commons clause license condition(?: v1 0)?"),
    ("polyform", 0.92, r"polyform (?:noncommercial|strict|shield|small business|perimeter|internal use) license"),
    ("fsl", 0.92, r"functional source license(?: version 1 [01])?"),
    ("cal-1", 0.92, r"cryptographic autonomy license(?: version 1 0)?"),
    ("parity", 0.92, r"parity public license(?: [67] 0 0)?"),
    # documents, data and media
    ("cc", 0.92, r"this work is licensed under (?:a|the) creative commons"),
    ("cc", 0.9, r"to view a copy of this license visit (?:https? )?creativecommons org"),
    ("cc", 0.9, r"send a letter to creative commons (?:po box 1866 mountain view|171 second street|543 howard street)"),
    ("cc-by-sa", 0.92, r"text is available under the creative commons attribution share ?alike license"),
    ("cc-by", 0.9, r"this is an open access article distributed under the terms of the creative commons attribution license"),
    ("cc-by", 0.9, r"which permits unrestricted use distribution and reproduction in any medium provided the original (?:work|author and source|work is properly cited)"),
    ("cc-by-nc", 0.9, r"which permits non commercial (?:re )?use distribution and reproduction in any medium provided the original work"),
    ("odbl-1", 0.95, r"this (?:{w} ){1,6}is made available under the open database license"),
    ("odbl-1", 0.92, r"openstreetmap (?:data )?is (?:open data )?licensed under the open data commons open database license"),
    ("odbl-1", 0.9, r"opendatacommons org licenses odbl"),
    ("odc-by-1", 0.9, r"opendatacommons org licenses by"),
    ("pddl-1", 0.9, r"opendatacommons org licenses pddl"),
    ("ogl-uk", 0.92, r"contains public sector information licensed under the open government licen[cs]e(?: v ?[123] 0)?"),
    ("ogl-uk", 0.9, r"open government licen[cs]e(?: v(?:ersion)? ?[123](?: 0)?)?"),
    ("etalab-2", 0.92, r"licence ouverte (?:open licence )?(?:version 2 0|etalab)"),
    ("dl-de-by-2", 0.92, r"datenlizenz deutschland namensnennung (?:version )?2 0"),
    ("dl-de-zero-2", 0.92, r"datenlizenz deutschland zero (?:version )?2 0"),
    ("iodl-2", 0.92, r"italian open data license(?: v ?2 0)?"),
    ("cdla-permissive", 0.92, r"community data license agreement permissive(?: version)?(?: [12] 0)?"),
    ("cdla-sharing", 0.92, r"community data license agreement sharing(?: version)?(?: 1 0)?"),
    ("opl-1", 0.92, r"this material may be distributed only subject to the terms and conditions set forth in the open publication license"),
    ("gutenberg", 0.92, r"this ebook is for the use of anyone anywhere (?:in the united states and most other parts of the world )?at no cost and with almost no restrictions whatsoever"),
    ("gutenberg", 0.92, r"project gutenberg license included with this ebook"),
    ("us-government", 0.9, r"works? of the (?:united states|u s|us) government (?:is|are) (?:not subject to copyright|in the public domain)"),
    ("arxiv", 0.9, r"arxiv org (?:perpetual )?non ?exclusive (?:license to distribute|distrib)"),
    # rights without a licence
    ("public-domain", 0.8, r"(?:this (?:{w} ){1,3}is |has been |hereby )?(?:released into|dedicated to|placed in|placed into|in) the public domain"),
    ("public-domain", 0.8, r"no copyright is claimed"),
    ("public-domain", 0.7, r"copyright has expired"),
    ("all-rights-reserved", 0.6, r"copyright (?:c )?(?:[0-9]{4} )?(?:{w} ){0,6}all rights reserved"),
    ("all-rights-reserved", 0.6, r"no part of this (?:publication|book|work|document|site) may be reproduced(?: stored in a retrieval system)?(?: or transmitted)?"),
    ("all-rights-reserved", 0.6, r"without the (?:prior )?(?:express )?written permission of the (?:publisher|author|copyright (?:owner|holder))"),
    ("all-rights-reserved", 0.6, r"(?:unauthorized|unauthorised) (?:copying|reproduction|use|distribution) (?:of this (?:{w} ){1,3})?(?:is )?(?:strictly )?prohibited"),
    ("all-rights-reserved", 0.5, r"todos los derechos reservados"),
    ("all-rights-reserved", 0.5, r"tous droits (?:reserves|réservés)"),
    ("all-rights-reserved", 0.5, r"alle rechte vorbehalten"),
    ("proprietary", 0.7, r"confidential and proprietary(?: information)?"),
    ("proprietary", 0.7, r"proprietary and confidential(?: information)?"),
    ("proprietary", 0.5, r"(?:proprietary|commercial|closed source) (?:license|licence)"),
    ("proprietary", 0.7, r"end user (?:license|licence) agreement"),
    ("proprietary", 0.7, r"by installing (?:copying )?or (?:otherwise )?using (?:this|the) (?:software|product) you agree to be bound by"),
    ("proprietary", 0.7, r"you may not reverse engineer decompile or disassemble"),
    ("proprietary", 0.6, r"this software contains (?:trade secrets|confidential information)"),
    ("non-commercial", 0.6, r"for (?:personal (?:and |or ))?(?:non commercial|noncommercial) (?:use|purposes) only"),
    ("non-commercial", 0.6, r"for (?:academic|educational|research) (?:use|purposes) only and not for redistribution"),
    ("no-derivatives", 0.6, r"no derivative works(?: are)?(?: allowed| permitted)?"),
    ("evaluation", 0.6, r"for evaluation (?:use|purposes) only"),
    ("freeware", 0.5, r"this (?:software|program) is freeware"),
    ("shareware", 0.5, r"this (?:software|program) is shareware"),
    ("dual-license", 0.6, r"(?:dual|triple|multi) (?:licensed|licenced) under"),
    ("dual-license", 0.6, r"alternatively (?:this (?:{w} ){1,3}may be|you may|the contents of this file may be) (?:distributed|used|use this (?:{w} ){1,2})under the terms of"),
    ("see-license", 0.4, r"see (?:the )?(?:file )?(?:license|licence)(?: (?:txt|md|file))? for (?:details|more information|terms|licensing information)"),
    ("see-license", 0.4, r"see (?:the )?(?:file )?copying(?: (?:txt|lib|lesser))? for (?:details|more information|copying conditions)"),
    ("see-license", 0.4, r"refer to the (?:license|licence)(?: agreement)? for (?:details|terms|more information)"),
    ("warranty-disclaimer", 0.4, r"(?:this|the) (?:software|program|work|material|data) is provided (?:by the (?:copyright holders|authors|regents) and contributors )?as is(?: and any express or implied warranties)?(?: without (?:any )?warranty(?: of any kind)?)?"),
    ("warranty-disclaimer", 0.4, r"implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("warranty-disclaimer", 0.4, r"there is no warranty for the program to the extent permitted by applicable law"),
    ("warranty-disclaimer", 0.4, r"(?:no|without) (?:any )?(?:warranty|warranties) of any kind(?: either)?(?: express or implied| expressed or implied)?"),
    ("patent-grant", 0.5, r"perpetual worldwide non exclusive (?:no charge )?royalty free (?:irrevocable )?patent license"),
    ("cla", 0.5, r"contributor (?:license|licence) agreement"),
    ("dco", 0.5, r"developer certificate of origin"),
    ("trademark", 0.4, r"(?:is|are) (?:a )?(?:registered )?(?:trademark|trademarks) of (?:{w} ){0,3}(?:inc|corporation|corp|ltd|llc|foundation)"),
    # names without a version
    ("gpl", 0.6, r"(?:gnu )?general public (?:license|licence)"),
    ("lgpl", 0.6, r"(?:gnu )?(?:lesser|library) general public (?:license|licence)"),
    ("agpl", 0.6, r"(?:gnu )?affero general public (?:license|licence)"),
    ("gfdl", 0.6, r"(?:gnu )?free documentation (?:license|licence)"),
    ("bsd", 0.6, r"bsd(?: style)? (?:license|licence)"),
    ("apache", 0.6, r"apache (?:software )?(?:license|licence)"),
    ("mpl", 0.6, r"mozilla public (?:license|licence)"),
    ("epl", 0.6, r"eclipse public (?:license|licence)"),
    ("cc", 0.5, r"creative commons (?:license|licence)"),
    ("copyleft", 0.4, r"copyleft(?: licen[cs]e)?"),
    ("open-source", 0.3, r"osi approved(?: open source)? (?:license|licence)"),
)
