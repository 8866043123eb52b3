"""Standard headers and short license texts; whole longer texts lie in license_texts."""

from __future__ import annotations

from pathlib import Path

FSF = "as published by the Free Software Foundation, "
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies
or substantial portions of the Software."""
# Public notices as (license, text); several texts of one license may stand here.
HEADERS = [
    ("gpl-2.0", f"under the terms of the GNU General Public License {FSF}either version 2"),
    ("gpl-2.0", f"under the terms of the GNU General Public License version 2 {FSF}"),
    ("gpl-3.0", f"under the terms of the GNU General Public License {FSF}either version 3"),
    ("lgpl-2.0", f"under the terms of the GNU Library General Public License {FSF}either version 2"),
    ("lgpl-2.1", f"under the terms of the GNU Lesser General Public License {FSF}either version 2.1"),
    ("lgpl-3.0", f"under the terms of the GNU Lesser General Public License {FSF}either version 3"),
    ("agpl-3.0", f"under the terms of the GNU Affero General Public License {FSF}either version 3"),
    ("gfdl-1.2", "under the terms of the GNU Free Documentation License, Version 1.2 or any later version published by the Free Software Foundation"),
    ("gfdl-1.3", "under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation"),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("mit", MIT),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary"),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("cc-by-sa-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa-3.0", "licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    ("cc-by-nc-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nd-4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nc-sa-4.0", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 License"),
    ("gpl-2.0", f"under the terms of the GNU General Public License {FSF}version 2"),
    ("gpl-3.0", f"under the terms of the GNU General Public License {FSF}version 3"),
    ("lgpl-2.1", f"under the terms of the GNU Lesser General Public License {FSF}version 2.1"),
    ("lgpl-3.0", f"under the terms of the GNU Lesser General Public License {FSF}version 3"),
    ("agpl-3.0", f"under the terms of the GNU Affero General Public License {FSF}version 3"),
    ("apache-2.0", "Licensed under the Apache License 2.0"),
    ("eupl-1.2", "Licensed under the EUPL, Version 1.2"),
    ("apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "SPDX-License-Identifier: BSD-2-Clause"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("gpl-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("gpl-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("lgpl-2.1", "SPDX-License-Identifier: LGPL-2.1"),
    ("lgpl-3.0", "SPDX-License-Identifier: LGPL-3.0"),
    ("agpl-3.0", "SPDX-License-Identifier: AGPL-3.0"),
    ("mpl-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("epl-2.0", "SPDX-License-Identifier: EPL-2.0"),
    ("eupl-1.2", "SPDX-License-Identifier: EUPL-1.2"),
    ("cc-by-4.0", "SPDX-License-Identifier: CC-BY-4.0"),
    ("cc-by-sa-4.0", "SPDX-License-Identifier: CC-BY-SA-4.0"),
]
NAMES = {
    "Apache-2.0": "apache-2.0", "Artistic": "artistic-1.0", "BSD": "bsd", "CC0-1.0": "cc0-1.0", "GFDL-1.2": "gfdl-1.2",
    "GFDL-1.3": "gfdl-1.3", "GPL-1": "gpl-1.0", "GPL-2": "gpl-2.0", "GPL-3": "gpl-3.0", "LGPL-2": "lgpl-2.0",
    "LGPL-2.1": "lgpl-2.1", "LGPL-3": "lgpl-3.0", "MPL-1.1": "mpl-1.1", "MPL-2.0": "mpl-2.0",
}


def bodies() -> list[tuple[str, str]]:
    """(license, whole text) of the stored texts."""
    folder = Path(__file__).parent / "license_texts"
    return [(name, (folder / f"{file}.txt").read_text("utf-8")) for file, name in NAMES.items()]
