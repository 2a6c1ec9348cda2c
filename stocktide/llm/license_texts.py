"""Templates of public licenses: their labels and the passages by which each is known.

Covered: MIT, ISC, BSD (2 and 3 clauses), zlib, Boost 1.0, Unlicense, Apache 2.0, GPL 2.0 and 3.0, LGPL 2.1 and 3.0,
AGPL 3.0, MPL 2.0, EPL 2.0, CC0 1.0, CC BY, CC BY-SA and CC BY-NC 4.0. A license whose text is short stands here by its
whole grant and conditions, each paragraph a template of its own, so that a body without its opening words is
known as well; the long ones stand here by the notice that they prescribe and by first paragraphs of
their own. Warranty paragraphs that several licenses share stand under a label of their own.
"""

from __future__ import annotations

# License passages as published.
NOTICES: dict[str, tuple[str, ...]] = {
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "warranty-text": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mit-line": ("Released under the MIT License.",),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES",
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    "bsd-3-text": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
    ),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it "
        "and redistribute it freely, subject to the following restrictions",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    ),
    "boost-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
        "transmit the Software, and to prepare derivative works of the Software",
        "Distributed under the Boost Software License, Version 1.0.",
    ),
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
        "a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    ),
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "apache-2.0-text": (
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, "
        "non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly "
        "display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
    ),
    "apache-2.0-line": ("Licensed under the Apache License, Version 2.0.",),
    "gpl-2.0-notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ),
    "gpl-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "gpl-text": (
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General "
        "Public License is intended to guarantee your freedom to share and change free software",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    ),
    "gpl-3.0-line": ("licensed under the GNU General Public License, version 3.",),
    "lgpl-2.1-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License",
    ),
    "lgpl-3.0-notice": (
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ),
    "lgpl-3.0-text": (
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General "
        "Public License, supplemented by the additional permissions listed below.",
    ),
    "agpl-3.0-notice": (
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 "
        "of the License, or (at your option) any later version.",
    ),
    "agpl-3.0-text": (
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically "
        "designed to ensure cooperation with the community in the case of network server software.",
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at",
    ),
    "epl-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at",
    ),
    "cc0-1.0-notice": (
        "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work.",
    ),
    "cc-by-4.0-notice": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",),
    "cc-by-sa-4.0-notice": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "cc-by-sa-4.0-line": ("Licensed under CC BY-SA 4.0.",),
    "cc-by-nc-4.0-notice": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",),
    "cc-by-nc-4.0-line": ("Licensed under CC BY-NC 4.0.",),
}
