"""Canonical licence texts, and the notices that name them.

A file is called by the SPDX name of its text; what follows a second name (`.regents`) tells wordings apart. Each
text also comes as it is usually handed on: with a title, without what follows the terms, with older
addresses, list marks and names of holders. A GNU text has the `-only` name: the text itself doesn't say whether
later versions may be used; notices do.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

FOLDER = Path(__file__).parent
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD License", "New BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License"),
    "Unlicense": ("The Unlicense",),
    "CC0-1.0": ("CC0 1.0 Universal",),
}
END = re.compile(r"\n[ \t]*END OF TERMS AND CONDITIONS[ \t]*\n")
ADDRESS = re.compile(r"51\s+Franklin\s+Street,\s+Fifth\s+Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA")
ADDRESSES = (
    "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA", "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA", "675 Mass Ave, Cambridge, MA 02139, USA",
)
ITEM = re.compile(r"(^|\n)[ \t]*[1-4]\. ")
HOLDERS = (
    ("COPYRIGHT OWNER OR", r"COPYRIGHT\s+HOLDER\s+OR"), ("COPYRIGHT HOLDERS OR", r"COPYRIGHT\s+HOLDER\s+OR"),
)

GNU = (("GPL", "General Public License", "program", ("2", "3")), ("LGPL", "Lesser General Public License", "library", ("2.1", "3")))
APACHE = '''Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License.'''
ASF = '''Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file
distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to
You under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License.''' + APACHE.split("the License.", 1)[1]
MPL = '''This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.'''

#: What sentences call a licence.
NAMES = {
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache License 2.0", "Apache 2.0"),
    "MIT": ("the MIT License", "the MIT license (MIT)", "MIT License", "MIT"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License"),
    "ISC": ("the ISC License",),
    "Unlicense": ("the Unlicense",),
    "Zlib": ("the zlib License",),
    "BSL-1.0": ("the Boost Software License, Version 1.0", "the Boost Software License 1.0"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "the Mozilla Public License, v. 2.0"),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "the CC0 1.0 Universal License"),
}
SENTENCES = (
    "Licensed under {}.", "Released under {}.", "Distributed under {}.",
    *(f"This {x} is licensed under {{}}." for x in ("work", "project", "software", "program", "library")),
)
PARTS = {"BY": "Attribution", "NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
PARTED = ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND")


def _bodies(name: str, text: str) -> Iterator[str]:
    yield text
    if name.startswith("BSD") or name == "Zlib":
        yield ITEM.sub(r"\1* ", text)
    if name.startswith("BSD"):
        for one, pattern in HOLDERS:
            other = re.sub(pattern, one, text)
            yield from (other, ITEM.sub(r"\1* ", other))
    end = END.search(text)
    if end:
        yield from (text[:end.end()], text[:end.start()])
    for address in ADDRESSES if ADDRESS.search(text) else ():
        other = ADDRESS.sub(address, text)
        yield other
        yield other[:END.search(other).end()] if END.search(other) else other


def texts() -> Iterator[tuple[str, str]]:
    """Whole licences: SPDX name and text."""
    for path in sorted(FOLDER.glob("*.txt")):
        name = path.name.removesuffix(".txt").removesuffix(".regents")
        for body in _bodies(name, path.read_text(encoding="utf-8")):
            for title in ("", *TITLES.get(name, ())):
                yield name, f"{title}\n\n{body}"
                if name.startswith("BSD"):
                    yield name, f"{title}\n\nAll rights reserved.\n\n{body}"


def _gnu() -> Iterator[tuple[str, str]]:
    """The headers of the GNU licences: the grant, the grant and the warranty, and both with one of the usual ends."""
    warranty = ("This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details.")
    copy = "You should have received a copy of the GNU {1} along with this {0}"
    ends = ("If not, see <https://www.gnu.org/licenses/>.", *(
        f"if not, write to the Free Software Foundation, Inc., {x}." for x in ("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA", *ADDRESSES)))
    for short, long, what, versions in GNU:
        for version in versions:
            for later, term in (("or-later", f"either version {version} of the License, or (at your option) any later version."),
                                ("only", f"version {version} of the License."), ("only", f"version {version}.")):
                for thing in (what, "program", "file"):
                    grant = (f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {long} "
                             f"as published by the Free Software Foundation, {term}")
                    full = f"{grant} {warranty.format(thing, long)}"
                    name = f"{short}-{_version(version)}-{later}"
                    yield from ((name, grant), (name, full))
                    yield from ((name, f"{full} {copy.format(thing, long)} {end}") for end in ends)


def _version(version: str) -> str:
    return version if "." in version else f"{version}.0"


def notices() -> Iterator[tuple[str, str]]:
    """Headers and sentences that name a licence: SPDX name and text. The last one reserves all rights and grants nothing."""
    yield from (("Apache-2.0", APACHE), ("Apache-2.0", ASF), ("Apache-2.0", APACHE.split(";")[0]), ("MPL-2.0", MPL))
    yield from _gnu()
    named = dict(NAMES)
    for short, long, _, versions in GNU:
        for v in versions:
            calls = (f"the GNU {long}, version {v}", f"the GNU {long} v{_version(v)}")
            named[f"{short}-{_version(v)}-only"] = calls
            named[f"{short}-{_version(v)}-or-later"] = tuple(f"{x} or later" for x in calls)
    for parts in PARTED:
        long = "-".join(PARTS[x] for x in parts.split("-"))
        for v, port in (("3.0", "Unported"), ("4.0", "International")):
            named[f"CC-{parts}-{v}"] = (f"CC {parts} {v}", *(f"{a} Creative Commons {long} {v} {port} License" for a in ("a", "the")))
    for name, ways in named.items():
        yield name, f"SPDX-License-Identifier: {name}"
        yield from ((name, sentence.format(way)) for way in ways for sentence in SENTENCES)
    for path in sorted(FOLDER.glob("*.txt")):
        yield (name := path.name.removesuffix(".txt").removesuffix(".regents")), f"SPDX-License-Identifier: {name}"
    yield "LicenseRef-All-Rights-Reserved", "All rights reserved."


def known() -> tuple[tuple[str, str], ...]:
    return tuple(dict.fromkeys([*texts(), *notices()]))
