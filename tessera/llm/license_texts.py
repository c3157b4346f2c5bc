"""Wordings of public licenses: notices as they stand in files and pages, and short licenses in full (fixed values)."""

from __future__ import annotations

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
    documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
    rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
    persons to whom the Software is furnished to do so, subject to the following conditions:"""
_MIT_END = """The above copyright notice and this permission notice shall be included in all copies or substantial portions of
    the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
    TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
    OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
    OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
    following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
    list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
    INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
    IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
    CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
    PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
    TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
    POSSIBILITY OF SUCH DAMAGE."""
_GNU = """{what} is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the
    Free Software Foundation, either version {version} of the License, or (at your option) any later version."""
_GNU_2 = """{what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by the
    Free Software Foundation; either version {version} of the License, or (at your option) any later version."""
_CC = "This work is licensed under a Creative Commons {name} 4.0 International License."


def _gnu(name: str, version: str, text: str, what: str) -> tuple[str, ...]:
    return (
        f"This work is licensed under the {name}, version {version}.",
        f"Licensed under the {name} v{version}.",
        f"Released under the {name}, version {version} or later.",
        text.format(name=name, version=version, what=what),
    )


def _cc(short: str, name: str) -> tuple[str, ...]:
    return f"Licensed under {short} 4.0.", f"This work is licensed under {short} 4.0.", _CC.format(name=name)


TEMPLATES: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3", _GNU, "This program"),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License 2.0.",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required
        by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    "BSD": ("Released under the BSD License.", "Licensed under the BSD License."),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", "Licensed under the 2-Clause BSD License.", f"{_BSD} {_BSD_END}"),
    "BSD-3-Clause": ("Released under the BSD 3-Clause License.", "Licensed under the 3-Clause BSD License.", f"{_BSD} {_BSD_NAME} {_BSD_END}"),
    "BSL-1.0": (
        "Distributed under the Boost Software License, Version 1.0.",
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
        accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
        transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
        is furnished to do so, all subject to the following:""",
    ),
    "CC-BY-4.0": _cc("CC BY", "Attribution"),
    "CC-BY-NC-4.0": _cc("CC BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _cc("CC BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("CC BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _cc("CC BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _cc("CC BY-SA", "Attribution-ShareAlike"),
    "CC0-1.0": (
        "Released under CC0 1.0 Universal.",
        "Licensed under CC0 1.0.",
        """To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this
        work to the public domain worldwide. This work is distributed without any warranty.""",
    ),
    "GPL-2.0": _gnu("GNU General Public License", "2", _GNU_2, "This program"),
    "GPL-3.0": _gnu("GNU General Public License", "3", _GNU, "This program"),
    "ISC": (
        "Released under the ISC License.",
        "Licensed under the ISC License.",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
        DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
        TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    "LGPL-2.1": _gnu("GNU Lesser General Public License", "2.1", _GNU_2, "This library"),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3", _GNU, "This library"),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License.", _MIT, f"{_MIT} {_MIT_END}"),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License, version 2.0.",
        "Released under the Mozilla Public License 2.0.",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
    "Unlicense": (
        "Released under the Unlicense.",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,
        compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial
        or non-commercial, and by any means.""",
    ),
    "Zlib": (
        "Released under the zlib License.",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any
        purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
        restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original
        software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
        software. This notice may not be removed or altered from any source distribution.""",
    ),
}
