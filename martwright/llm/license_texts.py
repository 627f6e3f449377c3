"""Template table of the license scan: full texts (``licenses/``), standard
headers, the usual names of licences, and SPDX tags.

A text that is not at hand word for word is taken from its sister text with the
names changed (``ADAPTED``): the sections that differ are missing, the names
tell the two apart.
"""

from __future__ import annotations

import pkgutil

FULL = ("0bsd apache-2.0 artistic-1.0 bsd-2-clause bsd-3-clause cc-by-sa-4.0 cc0-1.0 gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 "
        "gpl-3.0 isc lgpl-2.0 lgpl-2.1 lgpl-3.0 mit mpl-1.1 mpl-2.0 ncsa ofl-1.1 unicode-3.0 unlicense zlib").split()

_CC = "Attribution-ShareAlike"
ADAPTED = {
    "agpl-3.0": ("gpl-3.0", (("GNU GENERAL", "GNU AFFERO GENERAL"), ("GNU General", "GNU Affero General"))),
    **{f"cc-{code}-4.0": ("cc-by-sa-4.0", ((_CC, name), ("Attribution and ShareAlike", terms))) for code, name, terms in (
        ("by", "Attribution", "Attribution"),
        ("by-nd", "Attribution-NoDerivatives", "Attribution and NoDerivatives"),
        ("by-nc", "Attribution-NonCommercial", "Attribution and NonCommercial"),
        ("by-nc-sa", "Attribution-NonCommercial-ShareAlike", "Attribution, NonCommercial, and ShareAlike"),
        ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives", "Attribution, NonCommercial, and NoDerivatives"))},
}


def _gnu(kind: str, version: str, what: str = "program") -> list[str]:
    """The header of a GNU licence in its usual wordings."""
    head = (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as "
            f"published by the Free Software Foundation, ")
    rest = (f" This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
            f"implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details.")
    later = f"either version {version} of the License, or (at your option) any later version."
    return [head + later, head + later + rest,
            head + f"version {version} of the License.", head + f"version {version}.", head + f"version {version}." + rest]


_GPL, _LGPL, _AGPL = "General Public License", "Lesser General Public License", "Affero General Public License"
HEADERS = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE "
        "file distributed with this work for additional information regarding copyright ownership. The ASF licenses this "
        "file to You under the Apache License, Version 2.0"],
    "gpl-2.0": _gnu(_GPL, "2"),
    "gpl-3.0": _gnu(_GPL, "3"),
    "lgpl-2.0": _gnu("Library General Public License", "2", "library"),
    "lgpl-2.1": _gnu(_LGPL, "2.1", "library") + _gnu(_LGPL, "2.1"),
    "lgpl-3.0": _gnu(_LGPL, "3", "library") + _gnu(_LGPL, "3"),
    "agpl-3.0": _gnu(_AGPL, "3"),
    "mpl-1.1": [
        "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use "
        "this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.mozilla.org/MPL/"],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "epl-1.0": [
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse "
        "Public License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html"],
    "epl-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "cc0-1.0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty."],
    "unlicense": ["This is free and unencumbered software released into the public domain."],
    "bsd-3-clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "mit": ["Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."],
}

_CC_NAMES = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives",
             "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
             "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}


def _versions(name: str, version: str) -> list[str]:
    return [f"{name} {form}{version}" for form in ("", "v", "version ")]


NAMES = {
    "mit": ["MIT License", "MIT Licence", "MIT open source license"],
    "apache-2.0": [*_versions("Apache License", "2.0"), "Apache 2.0 License", "Apache-2.0 License"],
    "bsd-2-clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "bsd-3-clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "bsd": ["BSD License"],
    "isc": ["ISC License"],
    "zlib": ["zlib License", "zlib/libpng License"],
    "ofl-1.1": _versions("SIL Open Font License", "1.1"),
    "cc0-1.0": ["Creative Commons CC0 1.0 Universal", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"],
    "unlicense": ["Unlicense license"],
    **{code: [w for v in forms for w in _versions(f"GNU {name}", v) + _versions(short, v)]
       + [f"{short}v{v} license" for v in forms] for code, name, short, forms in (
           ("gpl-2.0", _GPL, "GPL", ("2", "2.0")), ("gpl-3.0", _GPL, "GPL", ("3", "3.0")),
           ("lgpl-2.1", _LGPL, "LGPL", ("2.1",)), ("lgpl-3.0", _LGPL, "LGPL", ("3", "3.0")),
           ("agpl-3.0", _AGPL, "AGPL", ("3", "3.0")))},
    **{f"mpl-{v}": _versions("Mozilla Public License", v) for v in ("1.1", "2.0")},
    **{f"epl-{v}": _versions("Eclipse Public License", v) for v in ("1.0", "2.0")},
    **{f"cc-{code}-{v}": [f"Creative Commons {name} {v}{kind} License" for kind in (
        (" International",) if v == "4.0" else (" Unported", ""))] + [f"Creative Commons {name} {v}"]
       + [f"CC {code.upper()} {v}", f"CC-{code.upper()}-{v} license"]
       for code, name in _CC_NAMES.items() for v in ("3.0", "4.0")},
}
#: Identifiers of the SPDX licence list, by the name used here
#: (the same where none is given).
SPDX = {
    **{name: [name] for name in (
        "0bsd apache-2.0 artistic-1.0 bsd-2-clause bsd-3-clause cc0-1.0 epl-1.0 epl-2.0 isc mit mpl-1.1 mpl-2.0 ncsa ofl-1.1 "
        "unicode-3.0 unlicense zlib").split()},
    **{f"cc-{code}-{v}": [f"cc-{code}-{v}"] for code in _CC_NAMES for v in ("3.0", "4.0")},
    **{name: [name, f"{name}-only", f"{name}-or-later", f"{name}+"] for name in (
        "gpl-1.0 gpl-2.0 gpl-3.0 lgpl-2.0 lgpl-2.1 lgpl-3.0 agpl-3.0 gfdl-1.2 gfdl-1.3").split()},
}


def full_text(license: str) -> str:
    source, changes = ADAPTED.get(license, (license, ()))
    text = pkgutil.get_data(__package__, f"licenses/{source}.txt").decode("utf-8")
    for old, new in changes:
        text = text.replace(old, new)
    return text


def templates() -> list[tuple[str, str]]:
    """(license, text) of every full text and header."""
    out = [(name, full_text(name)) for name in (*FULL, *ADAPTED)]
    return out + [(name, text) for name, texts in HEADERS.items() for text in texts]


def mentions() -> list[tuple[str, str]]:
    """(license, text) of every name and SPDX tag."""
    out = [(name, f"SPDX-License-Identifier: {i}") for name, ids in SPDX.items() for i in ids]
    return out + [(name, text) for name, texts in NAMES.items() for text in texts]
