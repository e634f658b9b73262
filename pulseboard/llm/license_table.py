"""Production templates of the license scan: whole texts, headers, titles and notices of each license and version.

Whole texts are the files of ``licenses/``, named by license. A template's naming words are
phrases (of at most five words) that must stand within the match, so that a text that
differs only in its version or name is not taken for it.
"""

from __future__ import annotations

from pathlib import Path

FOLDER = Path(__file__).parent / "licenses"

_FREE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
_LIBRARY = "This library is free software; you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"
_EITHER, _ONLY = ", either version {} of the License, or (at your option) any later version.", ", version {} of the License."
_PLAIN, _LESSER, _AFFERO, _OLD = "General Public License", "Lesser General Public License", "Affero General Public License", "Library General Public License"

#: Naming words of whole texts that others resemble.
NAMING = {
    "GPL-1.0": ("general public license", "version 1"),
    "GPL-2.0": ("gnu general public license version", "version 2"),
    "GPL-3.0": ("gnu general public license version", "license version 3"),
    "LGPL-2.0": ("library general public license",),
    "LGPL-2.1": ("lesser general public license",),
    "LGPL-3.0": ("lesser general public license", "version 3"),
    "GFDL-1.2": ("version 1 2",),
    "GFDL-1.3": ("version 1 3",),
    "BSD-3-Clause": ("neither the name",),
}

#: GNU licenses: name, kind, version.
_GNU = (
    ("GPL-1.0", _PLAIN, "1"), ("GPL-2.0", _PLAIN, "2"), ("GPL-3.0", _PLAIN, "3"), ("LGPL-2.0", _OLD, "2"), ("LGPL-2.1", _LESSER, "2.1"),
    ("LGPL-3.0", _LESSER, "3"), ("AGPL-1.0", _AFFERO, "1"), ("AGPL-3.0", _AFFERO, "3"),
)

#: Names by which notices call a license, and the naming words of each.
_CALLED = {
    "MIT": (("the MIT License", ("the mit license",)),),
    "ISC": (("the ISC License", ("the isc license",)),),
    "Zlib": (("the zlib License", ("the zlib license",)),),
    "BSL-1.0": (("the Boost Software License, Version 1.0", ("boost software license",)),),
    "Unlicense": (("the Unlicense license", ("unlicense",)), ("the terms of the Unlicense", ("unlicense",))),
    "Apache-2.0": (("the Apache License, Version 2.0", ("apache license", "version 2 0")), ("the Apache License 2.0", ("apache license 2 0",)),
                   ("the Apache 2.0 License", ("apache 2 0",))),
    "MPL-1.1": (("the Mozilla Public License, Version 1.1", ("mozilla public license", "1 1")),),
    "MPL-2.0": (("the Mozilla Public License, Version 2.0", ("mozilla public license", "2 0")), ("the Mozilla Public License, v. 2.0", ("mozilla public license", "v 2 0")),
                ("the Mozilla Public License 2.0", ("mozilla public license 2 0",))),
    "EPL-1.0": (("the Eclipse Public License, Version 1.0", ("eclipse public license", "1 0")), ("the Eclipse Public License v1.0", ("eclipse public license v1 0",))),
    "EPL-2.0": (("the Eclipse Public License, Version 2.0", ("eclipse public license", "2 0")), ("the Eclipse Public License v2.0", ("eclipse public license v2 0",))),
    "BSD-2-Clause": (("the BSD 2-Clause License", ("2 clause",)), ("the 2-Clause BSD License", ("2 clause bsd",)), ("the Simplified BSD License", ("simplified bsd",))),
    "BSD-3-Clause": (("the BSD 3-Clause License", ("3 clause",)), ("the 3-Clause BSD License", ("3 clause bsd",)), ("the New BSD License", ("new bsd license",))),
    "BSD": (("the BSD License", ("the bsd license",)),),
    "CC0-1.0": (("CC0 1.0 Universal", ("cc0 1 0 universal",)), ("the CC0 1.0 License", ("cc0 1 0",)), ("CC0 1.0", ("cc0 1 0",))),
}
_BEGIN = ("Licensed under", "Released under", "Distributed under", "Available under", "Published under", "Provided under", "is under", "under the terms of")

#: Creative Commons: name, short and long name.
_CC = (("CC-BY", "BY", "Attribution"), ("CC-BY-SA", "BY-SA", "Attribution-ShareAlike"), ("CC-BY-ND", "BY-ND", "Attribution-NoDerivatives"),
       ("CC-BY-NC", "BY-NC", "Attribution-NonCommercial"), ("CC-BY-NC-SA", "BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("CC-BY-NC-ND", "BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
_CC_AREA = {"4.0": "International", "3.0": "Unported"}

#: Notices in other words, with their naming words. "GPL" and "BSD" are notices that name no version.
_OTHER = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ()),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", ("gnu general public license",)),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that", ()),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("v 2 0",)),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", ()),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", ()),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
     "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", ("version 2 0",)),
)


def plain(text: str) -> str:
    """The words of an ASCII phrase, as the scan sees them."""
    return " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split())


def _phrase(text: str) -> tuple[str, ...]:
    """Naming words of any length, in phrases of at most five words that cover it."""
    w = plain(text).split()
    return tuple(" ".join(w[k:k + 5]) for k in range(max(1, len(w) - 4)))


def spdx_tags() -> list[tuple[str, str]]:
    """(license, tag) of the licenses of this table."""
    named = {f.stem for f in FOLDER.glob("*.txt")} | {n for n, _, _ in _GNU} | set(_CALLED) | {f"{n}-{v}" for n, _, _ in _CC for v in _CC_AREA}
    gnu = {n for n in named if n.startswith(("GPL", "LGPL", "AGPL", "GFDL"))}
    return sorted([(n, n) for n in named - {"BSD"}] + [(n, f"{n}-{end}") for n in gnu for end in ("only", "or-later")])


def license_templates() -> list[tuple[str, str, tuple[str, ...]]]:
    """(license, text, naming words) of all templates."""
    out = [(f.stem, f.read_text(encoding="utf-8"), NAMING.get(f.stem, ())) for f in sorted(FOLDER.glob("*.txt"))]
    for name, kind, version in _GNU:
        names = (*_phrase(f"GNU {kind}"), plain(f"version {version}"))
        out += [(name, begin.format(kind) + end.format(version), names) for begin in (_FREE, _LIBRARY) for end in (_EITHER, _ONLY)]
        out += [(name, f"it under the terms of the GNU {kind} version {version} as published by the Free Software Foundation", names)]
        for called in (f"GNU {kind}, version {version}", f"GNU {kind} v{version}", f"GNU {kind} {version}"):
            own = (*_phrase(f"GNU {kind}"), "license" + plain(called).split("license")[1])
            out += [(name, f"{begin} the {called}", own) for begin in (*_BEGIN, "This work is licensed under")]
    out += [("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", ("affero general public license", "version 3"))]
    for name, called in _CALLED.items():
        out += [(name, f"{begin} {c}", names) for c, names in called for begin in _BEGIN]
    for name, short, long in _CC:
        for version, area in _CC_AREA.items():
            full, brief = _phrase(f"{long} {version}"), _phrase(f"CC {short} {version}")
            license_ = f"{name}-{version}"
            for words in (f"Creative Commons {long} {version} {area}", f"Creative Commons {long} {version}"):
                own = (*_phrase(f"Commons {long}"), *full)
                out += [(license_, f"{begin} {article} {words} License", own) for begin in (*_BEGIN, "This work is licensed under") for article in ("a", "the")]
                out += [(license_, f"{words} Public License", own)]
            out += [(license_, f"{begin}{article} CC {short} {version}{end}", brief) for begin in _BEGIN for article in ("", " a", " the") for end in ("", " license")]
    out += [(name, f"SPDX-License-Identifier: {tag}", _phrase(tag)) for name, tag in spdx_tags()]
    return list(dict.fromkeys(out + list(_OTHER)))
