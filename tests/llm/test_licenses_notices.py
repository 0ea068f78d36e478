"""The notices that the public licences themselves recommend, and SPDX tags."""
import pytest

from tessera.llm import licenses

APACHE = """Copyright 2020 Some Company

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """MIT License

Copyright (c) 2021 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
BSD = """BSD 3-Clause License

Copyright (c) 2019, Jane Doe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD2 = BSD.replace("3-Clause", "2-Clause").replace(BSD[BSD.index("3. Neither"):BSD.index("THIS SOFTWARE IS")], "")
ISC = """ISC License

Copyright (c) 2018, Jane Doe

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES."""


def gnu(kind, what, version, mark, old):
    end = (f"along with this {what}; if not, write to the Free Software Foundation, Inc.,\n51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
           if old else f"along with this {what}.  If not, see <https://www.gnu.org/licenses/>.")
    return f"""Copyright (C) 2015 Jane Doe

This {what} is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU {kind}General Public License as published by
the Free Software Foundation{';' if old else ','} either version {version} of the License, or
(at your option) any later version.

This {what} is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {kind}General Public License for more details.

You should have received a copy of the GNU {kind}General Public License
{end}"""


MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""
NOTICES = [
    (APACHE, "Apache-2.0"), (MIT, "MIT"), (BSD, "BSD-3-Clause"), (BSD2, "BSD-2-Clause"), (ISC, "ISC"), (MPL, "MPL-2.0"),
    (gnu("", "program", 2, ";", True), "GPL-2.0-or-later"), (gnu("", "program", 3, ":", False), "GPL-3.0-or-later"),
    (gnu("Lesser ", "library", "2.1", ";", True), "LGPL-2.1-or-later"), (gnu("Lesser ", "library", 3, ":", False), "LGPL-3.0-or-later"),
    (gnu("Affero ", "program", 3, ":", False), "AGPL-3.0-or-later")]


def commented(text, mark):
    lines = [f"{mark} {x}".rstrip() for x in text.split("\n")]
    return "\n".join(["/*", *lines, " */"] if mark == " *" else lines) + "\nint main() { return 0; }\n"


@pytest.mark.parametrize("mark", [None, " *", "//", "#"])
def test_official_notices(spark, frame, mark):
    texts = [t if mark is None else commented(t, mark) for t, _ in NOTICES]
    rows = {r["doc_id"]: r for r in licenses.scan(frame(list(enumerate(texts)))).collect()}
    for i, (_, licence) in enumerate(NOTICES):
        assert (rows[i]["licenses"], rows[i]["verdict"], rows[i]["n_unknown"]) == ([licence], "one", 0), rows[i]["sentence_ids"]


@pytest.mark.parametrize("text, found", [
    ("// SPDX-License-Identifier: GPL-3.0-only\nint x;", ["GPL-3.0-only"]),
    ("SPDX-License-Identifier: Apache-2.0 OR MIT\nword and more words", ["Apache-2.0", "MIT"]),
    ("SPDX-License-Identifier: (MIT AND BSD-3-Clause) OR ISC", ["MIT", "BSD-3-Clause", "ISC"]),
    ("/* SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 */", ["GPL-2.0-only"]),
    ("# SPDX-License-Identifier: MIT\n# SPDX-License-Identifier: GPL-2.0+", ["MIT", "GPL-2.0-or-later"]),
    ("SPDX-License-Identifier: LicenseRef-Own", ["SPDX"]),
    ("SPDX-License-Identifier: MIT.\n\n" + MIT, ["MIT"]),
    ("# SPDX-License-Identifier: MIT\n# " + MIT.replace("\n", "\n# "), ["MIT"])])
def test_spdx_tags(spark, frame, text, found):
    r = licenses.scan(frame([(1, text)])).first()
    assert r["licenses"] == found and r["n_unknown"] == 0, r["sentence_ids"]


@pytest.mark.parametrize("text, verdict", [
    ("You need permission to leave. The room is as is.", "none"), ("We warrant it, and are liable.", "none"),
    ("Licensed under terms of our own.", "unknown"), ("No licence is granted here.", "unknown")])
def test_only_licence_wording_is_unknown(spark, frame, text, verdict):
    assert licenses.scan(frame([(1, text)])).first()["verdict"] == verdict


def test_sql_agrees_on_notices(spark, frame):
    import duckdb
    texts = [t for t, _ in NOTICES] + [commented(t, " *") for t, _ in NOTICES] + ["SPDX-License-Identifier: Apache-2.0 OR MIT\nx", "", None,
                                                                                "# All rights\n# reserved.", "into the public\ndomain"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    want = sorted(con.execute(f"SELECT doc_id, licenses, sentence_ids, n_unknown, n_unused, verdict FROM ({licenses.sql()})").fetchall())
    got = licenses.scan(frame(list(enumerate(texts)))).selectExpr("doc_id", "array_join(licenses, ',')", "array_join(sentence_ids, ',')",
                                                                 "n_unknown", "n_unused", "verdict").collect()
    assert sorted(map(tuple, got)) == want
