"""Default license templates, by identifier: whole license texts, common file headers, and short notices.

The whole texts are the files of ``license_texts`` (as distributed with Debian,
Rust and Python packages, without their copyright lines). The headers are the
ones that the licenses themselves recommend. The notices join a few verbs with
the licenses' common names; any wording around them may differ.
"""

from __future__ import annotations

from importlib import resources

TEXTS = {
    f.name.removesuffix(".txt"): f.read_text(encoding="utf-8")
    for f in sorted(resources.files(__package__).joinpath("license_texts").iterdir(), key=lambda f: f.name)
    if f.name.endswith(".txt")
}


def _gnu(name: str, version: str) -> str:
    return f"""This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as
        published by the Free Software Foundation, either version {version} of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more
        details."""


HEADERS = {
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "gpl-2.0-header": _gnu("General Public License", "2"),
    "gpl-3.0-header": _gnu("General Public License", "3"),
    "lgpl-2.1-header": _gnu("Lesser General Public License", "2.1"),
    "lgpl-3.0-header": _gnu("Lesser General Public License", "3"),
    "agpl-3.0-header": _gnu("Affero General Public License", "3"),
    "mpl-2.0-header": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "bsl-1.0-header": """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or
        copy at http://www.boost.org/LICENSE_1_0.txt)""",
    "unlicense-header": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for
        any purpose, commercial or non-commercial, and by any means.""",
}

_CC = {
    "cc-by": "Attribution",
    "cc-by-sa": "Attribution-ShareAlike",
    "cc-by-nd": "Attribution-NoDerivatives",
    "cc-by-nc": "Attribution-NonCommercial",
    "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}

#: Names that notices give the licenses.
NAMES = {
    "agpl-3.0": ["the GNU Affero General Public License, version 3"],
    "apache-2.0": ["the Apache License, Version 2.0", "the Apache 2.0 License"],
    "bsd-2-clause": ["the BSD 2-Clause License", "the Simplified BSD License"],
    "bsd-3-clause": ["the BSD 3-Clause License", "the New BSD License"],
    "cc0-1.0": ["CC0 1.0 Universal"],
    "epl-1.0": ["the Eclipse Public License, version 1.0"],
    "epl-2.0": ["the Eclipse Public License, version 2.0"],
    "gfdl-1.3": ["the GNU Free Documentation License, version 1.3"],
    "gpl-2.0": ["the GNU General Public License, version 2"],
    "gpl-3.0": ["the GNU General Public License, version 3"],
    "isc": ["the ISC License"],
    "lgpl-2.1": ["the GNU Lesser General Public License, version 2.1"],
    "lgpl-3.0": ["the GNU Lesser General Public License, version 3"],
    "mit": ["the MIT License"],
    "mpl-2.0": ["the Mozilla Public License, version 2.0"],
    "ofl-1.1": ["the SIL Open Font License, Version 1.1"],
} | {f"{k}-{v}": [f"{k.upper().replace('-', ' ', 1)} {v}", f"a Creative Commons {name} {v}"] for k, name in _CC.items() for v in ("3.0", "4.0")}

NOTICES = {
    f"{key}-notice" + f"-{n}" * (n > 1): notice
    for key, names in NAMES.items()
    for n, notice in enumerate((f"{verb} {name}" for name in names for verb in ("Licensed under", "Released under", "Distributed under")), 1)
}

TEMPLATES = {**TEXTS, **HEADERS, **NOTICES}
