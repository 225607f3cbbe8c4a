from __future__ import annotations

import re

from conftest import SF
from helpers import LONG, ODD, frame, lower, read

from tripflow.llm import license_scan as ls

SCANNER = ls.Scanner(ls.PHRASES, ls.TEMPLATES)


def labels(text: str) -> set[str]:
    base, more = SCANNER.scan(lower(text).encode())
    return {x[2] for x in base + more}


def brute(text: str):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    places = sorted((i, label) for phrase, label in ls.PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    return (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
            ",".join(sorted({label for _, label in places})))


def check(rows, got):
    for r, (_, text, *_) in zip(got, rows, strict=True):
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(filter(None, set(r.labels.split(",")))))


def test_whole_table(spark):
    docs = read(spark, SF).orderBy("doc_id")
    got = ls.scan(docs).orderBy("doc_id").collect()
    check([(r.doc_id, r.text) for r in docs.collect()], got)
    assert any("cc-by-nc-4.0-reference" in r.labels for r in got)


def test_phrases(spark):
    cases = ["MIT-License mit_license", "the permit license", "Éapache license", "apache\nLICENSE 2", "gnu general, public; license!",
             "general public licenses", "mit mit license license", LONG + " MIT license", "", None]
    rows = list(enumerate(cases))
    check(rows, ls.scan(frame(spark, rows)).orderBy("doc_id").collect())


def test_templates():
    assert "gpl-3.0-reference" in labels("This work is licensed under the GNU General Public License, version 3.")
    assert "gpl-3.0-reference" in labels("Foo is released under the terms of the General Public License version 3 of the License")
    assert "gpl-3.0-reference" not in labels("This work is licensed under the GNU General Public Licence, version 3.")
    assert "gpl-3.0-reference" not in labels("This is licensed under the very GNU General Public License, version 3.")
    assert "apache-2.0-notice" in labels(
        "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.")
    text = " ".join(re.sub(r"[\[\]]", "", ls.TEMPLATES["mit-text"]).split())
    assert "mit-text" in labels(text) and "mit-text" not in labels(text.replace("sublicense", "sell"))
    assert labels("a license of no kind") == set()


GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so"""
CONDITION = """, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""
AS_IS = """
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def test_whole_mit_text_and_its_neighbours():
    assert labels("Copyright (c) 2024 A. Person\n\n" + GRANT + CONDITION + AS_IS) == {"mit-text"}
    assert labels(GRANT + "." + AS_IS) == {"mit-0-text"}
    assert labels(GRANT + CONDITION + "The Software shall be used for Good, not Evil." + AS_IS) == set()
    assert labels(GRANT + CONDITION) == set() and labels(GRANT) == set()


BSD = ["""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
""", """3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
This product includes software developed by the University of California, Berkeley and its contributors.
""", """4. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
""", """THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
REGENTS OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""]


def test_bsd_texts_are_told_apart_by_their_clauses():
    terms, advertising, names, disclaimer = BSD
    assert labels(terms + disclaimer) == {"bsd-2-clause-text"}
    assert labels(terms + names.replace("4.", "3.") + disclaimer) == {"bsd-3-clause-text"}
    assert labels(terms + advertising + names + disclaimer) == {"bsd-4-clause-text"}
    old = "3. The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."
    assert labels(terms + old + disclaimer) == {"bsd-3-clause-text"}
    for text in (terms, terms + names, terms + disclaimer.replace("ARE DISCLAIMED", ""), terms.replace("must retain", "may retain") + disclaimer):
        assert labels(text) == set()


def test_standard_headers():
    fsf = """# {} is free software: you can redistribute it and/or modify
        # it under the terms of the GNU General Public License as published by
        # the Free Software Foundation, either version {} of the License, or
        # (at your option) any later version.
        """
    rest = """# This program is distributed in the hope that it will be useful,
        # but WITHOUT ANY WARRANTY; without even the implied warranty of
        # MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
        # GNU General Public License for more details."""
    for version in ("2", "3"):
        for name in ("This program", "Foo Bar"):
            reference, header = f"gpl-{version}.0-reference", f"gpl-{version}.0-header"
            assert labels(fsf.format(name, version) + rest) == {"gpl", reference, header}
            assert labels(fsf.format(name, version)) == {"gpl", reference}
            assert labels(fsf.format(name, version).replace("modify", "sell") + rest) == {"gpl"}
    kernel = """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public
        License version 2 as published by the Free Software Foundation."""
    assert labels(kernel) == {"gpl", "gpl-2.0-reference"}
    apache = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
        language governing permissions and limitations under the License."""
    assert labels(apache) == {"apache", "apache-2.0-reference", "apache-2.0-notice", "apache-2.0-header"}
    assert "apache-2.0-header" not in labels(apache.replace("WITHOUT WARRANTIES", "WITH WARRANTIES"))
    asf = apache.replace("Licensed under", "The ASF licenses this file to you under")
    assert labels(asf) == {"apache", "apache-2.0-notice", "apache-2.0-header"}


def test_whole_terms():
    for name, phrase in (("apache-2.0", "Contributor"), ("gpl-2.0", "Program"), ("gpl-3.0", "Program")):
        text = ls.TEMPLATES[f"{name}-text"]
        assert f"{name}-text" in labels("A title\n" + text.replace("\n", "\n * ") + "END OF TERMS AND CONDITIONS")
        head, _, tail = text.rpartition(f" {phrase} ")
        assert f"{name}-text" not in labels(f"{head} {tail}")


def test_repeated_template_is_found_every_time():
    one = "Licensed under the Apache License, Version 2.0. "
    _, more = SCANNER.scan(lower(one * 300).encode())
    assert len(more) == 300


def test_odd_rows(spark):
    got = ls.scan(frame(spark, ODD, clash=True)).collect()
    assert len(got) == len(ODD) and {(r.n_base, r.first_word, r.labels, r.score) for r in got} == {(0, None, "", 0.0)}
    assert ls.scan(frame(spark, [])).collect() == []
