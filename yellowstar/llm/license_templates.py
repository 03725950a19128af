"""Names, notices and body sentences of public licences, by family."""

from __future__ import annotations

# How licences are named.
NAMES = {
    "AGPL": ["GNU Affero General Public License", "AGPL", "AGPLv3", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "Affero General Public License"],
    "Apache-2.0": ["Apache License", "Apache License, Version 2.0", "Apache 2.0", "Apache-2.0", "Apache License 2.0", "Apache Software License", "Apache v2"],
    "BSD": ["BSD License", "BSD-2-Clause", "BSD-3-Clause", "3-clause BSD license", "2-clause BSD license", "New BSD License", "Simplified BSD License", "BSD-style license", "Modified BSD License"],
    "CC-BY": ["Creative Commons Attribution 4.0 International", "Creative Commons Attribution 3.0", "CC BY", "CC BY 4.0", "CC BY 3.0", "CC-BY-4.0", "CC-BY-3.0", "Creative Commons Attribution License"],
    "CC-BY-NC": ["Creative Commons Attribution-NonCommercial 4.0 International", "Creative Commons Attribution-NonCommercial", "CC BY-NC", "CC BY-NC 4.0", "CC-BY-NC-4.0", "CC BY-NC-SA", "CC BY-NC-ND", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"],
    "CC-BY-SA": ["Creative Commons Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike", "CC BY-SA", "CC BY-SA 4.0", "CC BY-SA 3.0", "CC-BY-SA-4.0", "CC-BY-SA-3.0"],
    "CC0": ["CC0", "CC0 1.0", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons Zero", "CC0 license"],
    "EUPL": ["European Union Public Licence", "European Union Public Licence v1.2", "EUPL", "EUPL-1.2", "EUPL v1.2"],
    "GPL": ["GNU General Public License", "GNU GPL", "GPL", "GPLv2", "GPLv3", "GPL-2.0", "GPL-3.0", "GPL-2.0-only", "GPL-3.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later", "GPL v2", "GPL v3", "GNU General Public License version 3"],
    "ISC": ["ISC License", "ISC"],
    "LGPL": ["GNU Lesser General Public License", "GNU Library General Public License", "LGPL", "LGPLv2", "LGPLv3", "LGPL-2.1", "LGPL-3.0", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "GNU LGPL"],
    "MIT": ["MIT License", "MIT", "Expat license", "MIT/X11 license"],
    "MPL-2.0": ["Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL", "MPL 2.0", "MPL-2.0"],
    "Unlicense": ["The Unlicense", "Unlicense", "unlicense.org"],
}

# Sentences of notices and licence bodies.
SENTENCES = {
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "You are free to share and adapt the material as long as you give appropriate credit under the Creative Commons Attribution License.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "You may not use the material for commercial purposes under the Creative Commons Attribution-NonCommercial License.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under the CC0 license.",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law.",
    ],
    "EUPL": [
        "Licensed under the European Union Public Licence (EUPL), version 1.2 or, as soon they will be approved by the European Commission, subsequent versions of the EUPL (the \"Licence\"); you may not use this work except in compliance with the Licence.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see http://www.gnu.org/licenses/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced, stored in a retrieval system, or transmitted, in any form or by any means, without the prior written permission of the publisher.",
        "This material is proprietary and confidential; unauthorized copying, use or distribution is strictly prohibited.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    ],
}

# What stands around a licence's name.
CARRIERS = [
    "{}", "Licensed under the {}.", "Released under the {}.", "License: {}", "SPDX-License-Identifier: {}",
    "Distributed under the terms of the {}", "This project is licensed under the {} - see the LICENSE file for details.",
    "This file is part of a project under the {}", "The code is available under {}", "Published under {} by the authors",
    "Use of this source code is governed by a {}", "This work is licensed under a {}", "Content is shared under {} unless stated otherwise",
]

# Licence words in other surroundings.
OTHER = [
    "license plate", "driver license", "driving licence", "fishing license fee", "license number", "license agreement", "licensed plumber",
    "licensed under the", "the license", "his license was revoked by the state", "under the terms of the agreement",
    "the software is provided by the vendor", "copyright", "copyright office", "the rights of the people", "public domain",
    "she studied at MIT and moved on", "MIT researchers found", "the ISC meeting", "a creative common", "the mozilla browser",
    "apache helicopters", "the apache people", "a permission slip", "this program is broadcast at noon", "free software for everyone",
    "no part of the house was reserved", "all seats reserved", "the general public", "a public library", "by any means", "free of charge",
    "any person", "any later version of the story", "in source code", "confidential letters", "strictly prohibited to smoke",
]
