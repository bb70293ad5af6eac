"""Published licence texts: every variant is accepted, one changed mandatory word is refused.

Words in angle brackets may be replaced, words after ``~`` may be missing (that sign is no part of a word); all others are mandatory.
"""

import re

import duckdb
import pytest

from ledgerlink.llm.licenses import PHRASES, TEMPLATES, WORD_BYTES, Scanner, license_scan, license_sql
from tests.compare import differences
from tests.llm.conftest import wide

GNU = """is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License
as published by the Free Software Foundation"""
GNU_BODY = """<This program> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied
warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details.
You should have received a copy of the GNU {kind} Public License along with <this program>. """
GNU_HEADER = GNU + ", ~either version 3 of the License, or (at your option) any later version.\n" + GNU_BODY
SEE = "If not, see ~https://~www.gnu.org/licenses"
WRITE = "if not, write to the Free Software Foundation"

APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License"""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <THE AUTHORS OR COPYRIGHT HOLDERS> BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"""

ISC = """Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND <THE AUTHOR> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <THE AUTHOR> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE"""

BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

~1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
~2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
   in the documentation and/or other materials provided with the distribution.
"""
ADVERTISING = """~3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
   This product includes software developed by <the Some organization>. """
NAMES = """~{n}. Neither the name of <the copyright holder> nor the names of its contributors may be used to endorse or promote products
   derived from this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY <THE COPYRIGHT HOLDERS AND CONTRIBUTORS> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <THE
COPYRIGHT HOLDER OR CONTRIBUTORS> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"""

MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at ~https://mozilla.org/MPL/2.0"""

COMPLETE = {
    "apache-2.0-header": APACHE,
    "gpl-header": GNU_HEADER.format(kind="General") + SEE,
    "lgpl-header": GNU_HEADER.format(kind="Lesser General") + SEE,
    "agpl-header": GNU_HEADER.format(kind="Affero General") + WRITE,
    "mpl-2.0-header": MPL,
    "mit-full-text": MIT,
    "isc-full-text": ISC,
    "bsd-2-clause-full-text": BSD + BSD_END,
    "bsd-3-clause-full-text": BSD + NAMES.format(n=3) + BSD_END,
    "bsd-4-clause-full-text": BSD + ADVERTISING + NAMES.format(n="<4>") + BSD_END,
}


def curly(text):
    return re.sub(r'"([^"]*)"', "“\\1”", text)


def commented(text, sign):
    return "\n".join(f"{sign} {line}" for line in text.split("\n"))


VARIANTS = [
    *[(label, made) for label, text in COMPLETE.items() for made in (text, curly(text), commented(text, " *"), commented(text, "#"))],
    ("apache-2.0-header", APACHE.replace("http:", "https:").replace('"', "&quot;")),
    ("apache-2.0-header", "The ASF licenses this file to you " + APACHE.removeprefix("Licensed ").replace("LICENSE-2.0", "LICENSE-2.0.txt")),
    ("gpl-grant", "This program " + GNU.format(kind="General")),
    ("gpl-grant", "This program is free software; you can redistribute it and/or modify it under the terms of version 2 of the GNU General "
     "Public License as published by the Free Software Foundation."),
    ("gpl-grant", "it is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 "
     "as published by the Free Software Foundation."),
    ("gpl-header", "Foo " + GNU_HEADER.format(kind="General").replace("either version 3", "either version 2").replace("This program", "Foo") + WRITE),
    ("gpl-header", GNU.format(kind="General") + "; version 2 of the License. " + GNU_BODY.format(kind="General") + SEE),
    ("lgpl-grant", "This library " + GNU.format(kind="Library General") + "; either version 2 of the License"),
    ("lgpl-header", GNU_HEADER.format(kind="Lesser General").replace("version 3", "version 2.1").replace("program", "library") + WRITE),
    ("agpl-grant", GNU.format(kind="Affero General")),
    ("mit-full-text", MIT.replace("shall be", "(including the next paragraph) shall be")),
    ("mit-full-text", MIT.replace("<THE AUTHORS OR COPYRIGHT HOLDERS>", "THE X CONSORTIUM").replace("NONINF", "NON-INF")),
    ("isc-full-text", ISC.replace("and distribute", "and/or distribute").replace("<THE AUTHOR> DISCLAIMS", "Some Body and others disclaim")),
    ("isc-text", ISC),
    ("bsd-2-clause-full-text", (BSD + BSD_END).replace("1.", "*").replace("2.", "*")),
    ("bsd-2-clause-full-text", (BSD + BSD_END).replace("1.", "(a)").replace("2.", "(b)")),
    ("bsd-3-clause-full-text", BSD + "3. The name of the author may not be used to endorse or promote products derived from this software "
     "without specific prior written permission." + BSD_END),
    ("bsd-3-clause-full-text", BSD + NAMES.format(n="-").replace("its contributors", "other contributors") + BSD_END),
    ("bsd-text", BSD),
    ("mpl-2.0-header", MPL.replace("https:", "http:").replace("v.", "version")),
    ("cc-notice", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-notice", "licensed under the Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    ("cc-notice", "Published under Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International (CC BY-NC-ND 4.0) licence"),
    ("cc-notice", "is licensed under the terms of the Creative Commons Attribution-NonCommercial-ShareAlike 2.5 License"),
    ("cc0-notice", "To the extent possible under law, Some Body has waived all copyright and related or neighboring rights to Some Work."),
]


@pytest.fixture(scope="module")
def scanner():
    return Scanner(PHRASES, TEMPLATES)


def plain(text):
    return text.replace("<", "").replace(">", "")


def labels(scanner, text):
    return scanner.scan(text.encode())[5].split(",")


@pytest.mark.parametrize("label, text", VARIANTS)
def test_published_variants_are_accepted(scanner, label, text):
    assert label in labels(scanner, plain(text))
    assert label in labels(scanner, f"Copyright 2024 Some Body\n\n{plain(text)}.\n\nimport os\n")


@pytest.mark.parametrize("label", COMPLETE)
def test_one_changed_word_is_refused_unless_replaceable(scanner, label):
    words, replaceable, optional, inside = [], set(), set(), False
    for part in re.findall(r"[<>~]|[^<>~]+", COMPLETE[label]):
        if part == "~":
            optional.add(len(words))
        elif part in "<>":
            inside = part == "<"
        else:
            new = part.encode().translate(WORD_BYTES).decode().split()
            replaceable |= set(range(len(words), len(words) + len(new))) if inside else set()
            words += new
    assert len(words) >= 40 and label in labels(scanner, " ".join(words))
    for i in range(len(words)):
        changed = label in labels(scanner, " ".join([*words[:i], "zzz", *words[i + 1 :]]))
        assert changed == (i in replaceable), (i, words[i])
        if i not in replaceable:
            missing = label in labels(scanner, " ".join(words[:i] + words[i + 1 :]))
            assert missing == (i in optional), (i, words[i])


def test_kinds_are_told_apart(scanner):
    found = {label: set(labels(scanner, plain(text))) for label, text in COMPLETE.items()}
    for label in COMPLETE:
        assert found[label] & set(COMPLETE) == {label}


def test_variants_equal_sql(spark, tmp_path):
    texts = [plain(text) for _, text in VARIANTS]
    texts += [t.replace("software", "hardware").replace("License", "Lizenz") for t in texts] + [t + " filler" * 5000 + t for t in texts[:3]]
    rows = wide(spark, list(enumerate(texts)))
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert differences(license_scan(rows), con, license_sql()) is None
