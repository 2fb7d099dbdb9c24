"""Licence statements, notices and texts that are looked for.

Fixed values: the wording is the licences' own. Short licences stand in full (without their
copyright line), long ones by the notice that source files carry and by how the file begins.
"""

from __future__ import annotations

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
    "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
    "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
    "copyright notice and this permission notice appear in all copies. "
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_APACHE_NOTICE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a '
    "copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed "
    'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
    "the specific language governing permissions and limitations under the License."
)
_APACHE_HEAD = (
    "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "
    '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.'
)
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
    "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
)
_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
    "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
    "and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim "
    "that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
    "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
    "3. This notice may not be removed or altered from any source distribution."
)
_BOOST = (
    "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or organization obtaining a copy "
    'of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit '
    "the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so"
)
_MPL_NOTICE = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
    "obtain one at https://mozilla.org/MPL/2.0/."
)
_MPL_HEAD = (
    'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, contributes to the creation '
    "of, or owns Covered Software."
)
_CC0_HEAD = (
    "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES. DISTRIBUTION OF THIS DOCUMENT DOES NOT CREATE AN "
    'ATTORNEY-CLIENT RELATIONSHIP. CREATIVE COMMONS PROVIDES THIS INFORMATION ON AN "AS-IS" BASIS.'
)


def _gnu_notice(program: str, name: str, version: str) -> str:
    """The notice of a GNU licence for source files."""
    return (
        f"This {program} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software "
        f"Foundation; either version {version} of the License, or (at your option) any later version. This {program} is distributed in the hope that it "
        "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"GNU {name} for more details."
    )


def _gnu_head(name: str, version: str, day: str, years: str, address: str = "") -> str:
    """How the file of a GNU licence begins."""
    return (
        f"GNU {name} Version {version}, {day} Copyright (C) {years} Free Software Foundation, Inc. {address} Everyone is permitted to copy and distribute verbatim "
        "copies of this license document, but changing it is not allowed."
    )


_STREET = "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA"
_GPL, _LGPL, _LIBRARY, _AGPL = "General Public License", "Lesser General Public License", "Library General Public License", "Affero General Public License"

#: SPDX identifier, text, and words that a matching window must have, as they tell it from its kin.
TEMPLATES: list[tuple[str, str, str]] = [
    ("MIT", _MIT, ""),
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License.", "mit"),
    ("ISC", _ISC, ""),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL, ""),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL, "endorse"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License.", "bsd 3"),
    ("Apache-2.0", _APACHE_NOTICE, "apache 2"),
    ("Apache-2.0", _APACHE_HEAD, "apache 2"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache 2"),
    ("GPL-2.0-or-later", _gnu_notice("program", _GPL, "2"), "2"),
    ("GPL-3.0-or-later", _gnu_notice("program", _GPL, "3"), "3"),
    ("LGPL-2.0-or-later", _gnu_notice("library", _LIBRARY, "2"), "library 2"),
    ("LGPL-2.1-or-later", _gnu_notice("library", _LGPL, "2.1"), "lesser 2 1"),
    ("LGPL-3.0-or-later", _gnu_notice("library", _LGPL, "3"), "lesser 3"),
    ("AGPL-3.0-or-later", _gnu_notice("program", _AGPL, "3"), "affero 3"),
    ("GPL-2.0-only", _gnu_head(_GPL, "2", "June 1991", "1989, 1991"), "2 1991"),
    ("GPL-2.0-only", _gnu_head(_GPL, "2", "June 1991", "1989, 1991", _STREET), "2 1991"),
    ("LGPL-2.1-only", _gnu_head(_LGPL, "2.1", "February 1999", "1991, 1999", _STREET), "lesser 2 1"),
    ("GPL-3.0-only", _gnu_head(_GPL, "3", "29 June 2007", "2007"), "general 3"),
    ("LGPL-2.1-only", _gnu_head(_LGPL, "2.1", "February 1999", "1991, 1999"), "lesser 2 1"),
    ("LGPL-3.0-only", _gnu_head(_LGPL, "3", "29 June 2007", "2007"), "lesser 3"),
    ("AGPL-3.0-only", _gnu_head(_AGPL, "3", "19 November 2007", "2007"), "affero 3"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3.", "3"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2.", "2"),
    ("LGPL-3.0-only", "This work is licensed under the GNU Lesser General Public License, version 3.", "lesser 3"),
    ("AGPL-3.0-only", "This work is licensed under the GNU Affero General Public License, version 3.", "affero 3"),
    ("MPL-2.0", _MPL_NOTICE, "2"),
    ("MPL-2.0", _MPL_HEAD, "2"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.", "mozilla 2"),
    ("Unlicense", _UNLICENSE, ""),
    ("Zlib", _ZLIB, ""),
    ("BSL-1.0", _BOOST, "boost"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0.", "boost 1"),
    ("CC0-1.0", _CC0_HEAD, "cc0"),
    ("CC0-1.0", "Released under CC0 1.0 Universal.", "cc0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", "cc by 4"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "cc by sa 4"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "cc by nc 4"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0.", "cc by nd 4"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0.", "cc by nc sa 4"),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0.", "cc by nc nd 4"),
    *(
        (name, f"SPDX-License-Identifier: {name}", f"spdx {name}")
        for name in (
            "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
            "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "Unlicense", "Zlib", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
        )
    ),
]
