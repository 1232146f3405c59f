"""Texts of common licences, their file headers and notices, by their public identifiers: fixed values.

Long licences are files in ``license_data``, as published; their text counts with and without the appendix on its use.
"""

from __future__ import annotations

from pathlib import Path

_MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""

_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""

_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""

#: (identifier, text); notices are the one-line forms.
SHORT = (
    ("MIT", "MIT License\n\n" + _MIT_BODY),
    ("MIT", _MIT_BODY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_TAIL),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC_TAIL),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("Zlib", _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
)

_DATA = Path(__file__).parent / "license_data"

#: Identifier, file, and where the appendix begins, if there is one.
_LONG = (
    ("Apache-2.0", "Apache-2.0", "APPENDIX: How to apply"),
    ("Artistic-1.0-Perl", "Artistic", None),
    ("BSD-3-Clause", "BSD", None),
    ("CC0-1.0", "CC0-1.0", None),
    ("GFDL-1.2", "GFDL-1.2", "ADDENDUM: How to use"),
    ("GFDL-1.3", "GFDL-1.3", "ADDENDUM: How to use"),
    ("GPL-1.0", "GPL-1", "Appendix: How to Apply"),
    ("GPL-2.0", "GPL-2", "How to Apply These Terms to Your New"),
    ("GPL-3.0", "GPL-3", "How to Apply These Terms to Your New"),
    ("LGPL-2.0", "LGPL-2", "How to Apply These Terms to Your New"),
    ("LGPL-2.1", "LGPL-2.1", "How to Apply These Terms to Your New"),
    ("LGPL-3.0", "LGPL-3", None),
    ("MPL-1.1", "MPL-1.1", "EXHIBIT A -"),
    ("MPL-2.0", "MPL-2.0", "Exhibit A - "),
)

#: Identifier, file, first and last words of the header for source files in it.
_HEADERS = (
    ("Apache-2.0", "Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");', "limitations under the License."),
    ("GPL-2.0-or-later", "GPL-2", "This program is free software; you can redistribute", "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    ("GPL-3.0-or-later", "GPL-3", "This program is free software: you can redistribute", "<https://www.gnu.org/licenses/>."),
    ("LGPL-2.1-or-later", "LGPL-2.1", "This library is free software; you can redistribute", "Boston, MA  02110-1301  USA"),
    ("MPL-2.0", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla", "http://mozilla.org/MPL/2.0/."),
)

_SPDX = """0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Artistic-1.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause
BSL-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0
EUPL-1.1 EUPL-1.2 GFDL-1.2-only GFDL-1.2-or-later GFDL-1.3-only GFDL-1.3-or-later GPL-1.0-only GPL-1.0-or-later GPL-2.0 GPL-2.0-only GPL-2.0-or-later
GPL-3.0 GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later
MIT-0 MPL-1.1 MPL-2.0 MS-PL NCSA OFL-1.1 OpenSSL PostgreSQL Python-2.0 Ruby Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"""


def _long_texts() -> list[tuple[str, str]]:
    out = []
    for name, file, appendix in _LONG:
        text = (_DATA / f"{file}.txt").read_text()
        out.append((name, text))
        if appendix:
            out.append((name, text[: text.index(appendix)]))
    for name, file, first, last in _HEADERS:
        text = (_DATA / f"{file}.txt").read_text()
        begin = text.rindex(first)
        out.append((name, text[begin : text.index(last, begin) + len(last)]))
    return out


LONG = tuple(_long_texts())
KNOWN = SHORT + LONG + tuple((x, f"SPDX-License-Identifier: {x}") for x in _SPDX.split())
