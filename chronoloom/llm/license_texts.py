"""The notices, titles, grants and whole short texts by which public licenses are named or granted."""

from __future__ import annotations

PROGRAM = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
GNU = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}
VERSIONS = [("GPL", "2.0", "2"), ("GPL", "3.0", "3"), ("LGPL", "2.1", "2.1"), ("LGPL", "3.0", "3"), ("AGPL", "3.0", "3")]
DATES = ["June 1991", "29 June 2007", "February 1999", "29 June 2007", "19 November 2007"]
CC = [("", "Attribution"), ("-NC", "Attribution-NonCommercial"), ("-SA", "Attribution-ShareAlike"), ("-ND", "Attribution-NoDerivatives"), ("-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("-NC-ND", "Attribution-NonCommercial-NoDerivatives")]

BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_NAME = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
    "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
    "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone "
    "to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be "
    "misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
    "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
)
BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
    "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"
)
UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
    "binary, for any purpose, commercial or non-commercial, and by any means."
)
APACHE = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License."
)
WARRANTY = (
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {} for more details."
)

CC0 = "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
CC0_SOFTWARE = "the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"
EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
#: Ways of naming a license in a sentence; a name and the words around it must come to five words, so the shortest names need the longest.
SAID = ["distributed under the {} license", "released under the {} license", "licensed under the {} license", "available under the {} license", "is under the {} license", "under the terms of the {} license"]
NAMES = [("Apache-2.0", "Apache 2.0"), ("BSD-2-Clause", "BSD 2-Clause"), ("BSD-3-Clause", "BSD 3-Clause"), ("ISC", "ISC"), ("MIT", "MIT"), ("Zlib", "zlib")]
#: Identifiers of at least three words, which with the tag come to six; those of one or two words have no shingle.
SPDX = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "MPL-2.0", "EPL-2.0", *[f"{k}-{v}" for k, v, _ in VERSIONS], *[f"CC-BY{k}-4.0" for k, _ in CC]]
#: Years in which a license may have been claimed.
YEARS = range(1990, 2041)

#: (license, text): every text is looked for on its own.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", APACHE),
    ("BSD", BSD),
    ("BSD-2-Clause", BSD),
    ("BSD-3-Clause", BSD),
    ("BSD-2-Clause", f"{BSD}: 1. {BSD_SOURCE} 2. {BSD_BINARY} {BSD_DISCLAIMER}"),
    ("BSD-3-Clause", f"{BSD}: 1. {BSD_SOURCE} 2. {BSD_BINARY} 3. {BSD_NAME} {BSD_DISCLAIMER}"),
    ("BSL-1.0", BOOST),
    *[(f"CC-BY{k}-4.0", f"This work is licensed under a Creative Commons {name} 4.0 International License.") for k, name in CC],
    *[(f"CC-BY{k}-4.0", f"Licensed under CC BY{k} 4.0.") for k, _ in CC],
    *[(f"{kind}-{v}", f"This work is licensed under the GNU {GNU[kind]}, version {said}.") for kind, v, said in VERSIONS],
    *[(f"{kind}-{v}", f"GNU {GNU[kind]} Version {said}, {date}") for (kind, v, said), date in zip(VERSIONS, DATES, strict=True)],
    *[(f"{kind}-{v}", f"{PROGRAM.format(GNU[kind])}, either version {said} of the License, or (at your option) any later version") for kind, v, said in VERSIONS],
    *[(f"{kind}-{v}", f"{PROGRAM.format(GNU[kind])}, either version {said} of the License, or (at your option) any later version. {WARRANTY.format(GNU[kind])}") for kind, v, said in VERSIONS],
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("ISC", ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", MIT),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    *[(name, form.format(said)) for name, said in NAMES for form in SAID],
    *[(name, f"SPDX-License-Identifier: {name}") for name in SPDX],
    *[(f"{k}-{v}", f"SPDX-License-Identifier: {k}-{v}-{way}") for k, v, _ in VERSIONS for way in ("only", "or-later")],
    *[(f"CC-BY{k}-3.0", f"This work is licensed under a Creative Commons {name} 3.0 Unported License.") for k, name in CC],
    *[("MIT", f"MIT License Copyright (c) {year}") for year in YEARS],
    ("MIT", "The MIT License (MIT) Copyright (c)"),
    ("CC0-1.0", CC0),
    ("CC0-1.0", CC0_SOFTWARE),
    ("CC0-1.0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication"),
    ("EPL-2.0", f"{EPL} 2.0"),
    ("EPL-2.0", f"{EPL} v2.0"),
    ("Unlicense", UNLICENSE),
    ("Zlib", ZLIB),
]
