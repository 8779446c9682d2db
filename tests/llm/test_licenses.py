from __future__ import annotations

import pytest

from logscore.llm.licenses import PHRASES, TEMPLATES, compile_template, scan_licenses
from tests.llm.helpers import ALNUM, documents, lower, rows_of


def accepts(template: str, text: str) -> bool:
    return compile_template(template).longest(text.encode().split()) > 0


def test_optional_and_replaceable_regions():
    template = (
        "grant <<beginOptional>>free <<beginOptional>>of charge<<endOptional>><<endOptional>> "
        "to <<var;name=who;match=(any )?[a-z]+;words=2>> only"
    )
    assert accepts(template, "grant to anyone only")
    assert accepts(template, "grant free to any person only and more")
    assert accepts(template, "grant free of charge to x only")
    assert not accepts(template, "grant of charge to x only")
    assert not accepts(template, "grant to only")
    assert not accepts(template, "grant to some person only")
    assert compile_template(template).most == 8


def test_mandatory_words_must_match_exactly():
    assert accepts(TEMPLATES["mit-release"], "released under the mit license")
    assert accepts(TEMPLATES["mit-release"], "released under the terms of the mit license")
    assert not accepts(TEMPLATES["mit-release"], "released under a mit license")
    assert not accepts(TEMPLATES["gpl-3.0"], "gnu general public license version 2")


@pytest.mark.parametrize("bad", ["<<var;name=x>> a", "", "a <<beginOptional>> b", "<<other>>", "a <<endOptional>>"])
def test_faulty_templates(bad):
    with pytest.raises(ValueError):
        compile_template(bad)


def test_base_against_brute_force(spark):
    texts = [
        "Released under the MIT License. mit license", "cc-by CC BY-NC 4.0; Licensed under CC BY-NC 4.0",
        "gnu GNU general public license, version 3 apache license", None, "", "mit licensed",
        "x " * 500 + "All rights reserved.", "commit license", "MIT\nLicense " * 2,
    ]
    found = scan_licenses(documents(spark, texts + texts[:1], "1 AS labels"))
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(texts) + 1 == found.count()
    for i, text in enumerate(texts):
        words, places, labels = ALNUM.findall(lower(text)), [], set()
        for phrase, label in PHRASES.items():
            p = phrase.split()
            at = [k for k in range(len(words)) if words[k : k + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        r = rows[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(r.labels.split(","))
    assert rows[0].labels == "mit,mit-release" and rows[0].score == 1
    assert rows[6].labels == "all-rights-reserved" and rows[6].n_base == 0
    assert rows[5].score == 0 and rows[8].score == 0.5 and rows[8].n_base == 2
    assert scan_licenses(documents(spark, []).where("false")).collect() == []


def test_own_templates(spark):
    docs = documents(spark, ["use it for good, not evil"])
    found = scan_licenses(docs, {}, {"json": "for good not evil"})
    assert rows_of(found, "base_labels", "labels") == [("", "json")]


_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software. {}
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with
the distribution. {} THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT,
INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY
OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_NAMES = """{}. Neither the name of ACME Inc. nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_ADVERTISING = """3. All advertising materials mentioning features or use of this software must display the following
acknowledgement: This product includes software developed by the ACME project."""


def test_whole_license_texts(spark):
    good = "The Software shall be used for Good, not Evil."
    isc = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
    hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
    disclaimer = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
    INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
    SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
    PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
    THE USE OR PERFORMANCE OF THIS SOFTWARE."""
    expected = {
        _MIT.format(""): ("mit-text", 1.0),
        _MIT.format(good): ("mit-opening", 0.75),
        _MIT.format("") + _MIT.format(good): ("mit-opening,mit-text", 1.0),
        _BSD.format(""): ("bsd-2-clause", 1.0),
        _BSD.format(_NAMES.format(3)): ("bsd-3-clause", 1.0),
        _BSD.format(_ADVERTISING + _NAMES.format(4)): ("bsd-4-clause", 1.0),
        _BSD.format("3. Send a postcard."): ("bsd-opening", 0.75),
        isc + disclaimer: ("isc", 1.0),
        isc: ("isc-opening", 0.75),
    }
    found = scan_licenses(documents(spark, list(expected)))
    rows = {r.doc_id: (r.labels, r.score) for r in found.collect()}
    assert [rows[i] for i in range(len(expected))] == list(expected.values())


def test_titles_and_notices(spark):
    gpl = """This {} is free software: you can redistribute it and/or modify it under the terms of the GNU {}General
    Public License as published by the Free Software Foundation, either version {} of the License, or (at your option)
    any later version."""
    apache = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
    compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
    Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
    on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
    the specific language governing permissions and limitations under the License."""
    mpl = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
    not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""
    expected = {
        "GNU General Public License version 3": ("gpl,gpl-3.0", 0.75),
        "Licensed under the Apache License, Version 2.0": ("apache,apache-2.0", 0.75),
        "Licensed under CC BY 4.0": ("cc-by,cc-by-4.0", 0.75),
        gpl.format("program", "", 3): ("gpl,gpl-notice", 1.0),
        gpl.format("library", "Lesser ", "2.1"): ("lgpl-notice", 1.0),
        gpl.format("library", "Library ", "2"): ("lgpl-notice", 1.0),
        gpl.format("program", "Affero ", 3): ("agpl-notice", 1.0),
        apache: ("apache,apache-notice", 1.0),
        apache.replace("WITHOUT WARRANTIES", "WITH WARRANTIES"): ("apache,apache-2.0", 0.75),
        mpl: ("mpl-notice", 1.0),
    }
    found = scan_licenses(documents(spark, list(expected)))
    rows = {r.doc_id: (r.labels, r.score) for r in found.collect()}
    assert [rows[i] for i in range(len(expected))] == list(expected.values())
