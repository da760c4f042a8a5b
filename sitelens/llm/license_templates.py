"""Licence templates in markup, for ``license_scan``.

``[[ ... ]]`` is optional wording, ``<<n>>`` a replaceable region of at most n
words; everything else is mandatory. Case and punctuation don't matter. A
template begins with a mandatory word.
"""

from __future__ import annotations

#: Phrases that name a licence, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: The wording of public licences and of their usual notices, as (label, template).
TEMPLATES = [
    ("mit", """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files [[(the "Software")]], to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
this permission notice [[(including the next paragraph)]] shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED [["]]AS IS[["]], WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND [[NON]] [[INFRINGEMENT]] [[NONINFRINGEMENT]].
IN NO EVENT SHALL <<20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"""),
    ("mit", "licensed under [[the terms of]] the [[Expat]] MIT License"),
    ("isc", """
Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
PROVIDED "AS IS" AND <<12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS"""),
    ("bsd-2-clause", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY <<20>> AS IS"""),
    ("bsd-3-clause", """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: [[1.]] Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. [[2.]] Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. [[3.]] Neither the name of <<20>> may be used to endorse or promote products derived from this software
without specific prior written permission"""),
    ("zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions"""),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("apache-2", """
Licensed under the Apache License, Version 2.0 [[(the "License")]]; you may not use this file except in compliance with
the License"""),
    ("apache-2", "Licensed [[to you]] under the Apache [[Software]] License, [[Version]] [[v]] 2"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("gpl-2", """
GNU General Public License [[as published by the Free Software Foundation]] [[; either]] version 2 [[of the
License]] [[, or (at your option) any later version]]"""),
    ("gpl-3", """
GNU General Public License [[as published by the Free Software Foundation]] [[; either]] version 3 [[of the
License]] [[, or (at your option) any later version]]"""),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl-3", """
GNU Affero General Public License [[as published by the Free Software Foundation]] [[; either]] version 3"""),
    ("cc0", "CC0 1.0 [[Universal]] [[Public Domain Dedication]]"),
    ("cc-by", "licensed under [[a]] [[the]] Creative Commons Attribution <<1>> [[International]] [[Unported]] License"),
    ("cc-by", "licensed under CC BY 4.0"),
    ("cc-by-sa", "licensed under [[a]] [[the]] Creative Commons Attribution-ShareAlike <<2>> [[International]] [[Unported]] License"),
    ("cc-by-sa", "CC BY-SA <<1>> 0"),
    ("cc-by-nc", "licensed under [[a]] [[the]] Creative Commons Attribution-NonCommercial <<2>> [[International]] [[Unported]] License"),
    ("cc-by-nc", "licensed under CC BY-NC <<1>> 0"),
    ("cc-by-nc-sa", "CC BY-NC-SA <<1>> 0"),
    ("cc-by-nc-nd", "CC BY-NC-ND <<1>> 0"),
    ("spdx", "SPDX License Identifier"),
    ("all-rights-reserved", "Copyright <<12>> All rights reserved"),
]
