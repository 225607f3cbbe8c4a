"""License scans by template markup.

A template is a license notice in which some regions are marked: ``{name}`` stands for up to a number of words
of any wording (replaceable), ``[...]`` for wording that may be left out (optional), ``<..|..>`` for one of several
wordings. Whole texts and standard headers are templates of their own beside one-line references. A template is compiled into an
automaton over words; a text has the template's label where the automaton, started at a word, reaches
its end, that is where all mandatory words stand exactly and in order. Words are as in the contract of
``scan``: punctuation and case don't count.

Results for special rows: a NULL or empty text has no words and no labels; a NULL id is an id; repeated rows
are rows of their own; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import pkgutil
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm import common

#: phrase -> label (fixed values)
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

_BSD_TERMS = """Redistribution and use in source and binary forms with or without modification are permitted provided
    that the following conditions are met
    [1 | a | i] Redistributions of source code must retain the above copyright notice this list of conditions and the
    following disclaimer
    [2 | b | ii] Redistributions in binary form must reproduce the above copyright notice this list of conditions and the
    following disclaimer in the documentation and or other materials provided with the distribution"""
_BSD_ADVERTISING = """[3 | c | iii] All advertising materials mentioning features or use of this software must display the following
    acknowledgement This product includes software developed by {24}"""
_BSD_NAMES = """[3 | 4 | c | d | iii | iv] <Neither the <name | names> of {16} nor the names of {6} contributors may be used |
    The <name | names> of {16} may not be used> to endorse or promote products derived from this software without
    specific prior written permission"""
_BSD_DISCLAIMER = """This software is provided by {16} as is and any express or implied warranties including but not limited
    to the implied warranties of merchantability and fitness for a particular purpose are disclaimed
    In no event shall {16} be liable for any direct indirect incidental special exemplary or consequential damages
    including but not limited to procurement of substitute goods or services loss of use data or profits or business
    interruption however caused and on any theory of liability whether in contract strict liability or tort including
    negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such
    damage"""
_MIT_GRANT = """Permission is hereby granted free of charge to any person obtaining a copy of this software
    and associated documentation files [the Software] to deal in [the Software] without restriction
    including without limitation the rights to use copy modify merge publish distribute sublicense and or
    sell copies [of the Software] and to permit persons to whom the Software is furnished to do so"""
_MIT_DISCLAIMER = """The Software is provided as is without warranty of any kind express or implied including but not
    limited to the warranties of merchantability fitness for a particular purpose and noninfringement
    In no event shall {16} be liable for any claim damages or other liability whether in an action of contract tort or
    otherwise arising from out of or in connection with the Software or the use or other dealings in the Software"""
_APACHE_NOTICE = """<licensed | licenses this file to you> under the Apache License [version] 2 0 [the License]
    you may not use this file except in compliance with the License"""


def _gpl(version: str) -> dict[str, str]:
    version = f"version {version} [0]"
    free = """is free software you can redistribute it and or modify it under the terms of the GNU General Public License
        """ + f"""<as published by the Free Software Foundation [either] {version} [of the License] |
        {version} [of the License] as published by the Free Software Foundation>"""
    return {
        "reference": f"""<[this] {{4}} is [licensed | released] under the [terms of the] [GNU] General Public
            License [as published by the Free Software Foundation] [either] {version} [of the License] | [this] {{4}} {free}>""",
        "header": f"""[this] {{4}} {free} [only] [or at your option any later version]
            {{6}} is distributed in the hope that it will be useful but without any warranty without even the
            implied warranty of merchantability or fitness for a particular purpose
            See the GNU General Public License for more details""",
    }


def _whole(name: str) -> str:
    """A licence's terms and conditions word by word."""
    return pkgutil.get_data("tripflow.llm", f"licenses/{name}.txt").decode()


#: label -> template; {n} stands for up to n words of any wording, [..] may be left out, <..|..> is one of several
TEMPLATES = {
    "mit-reference": "[this work is] {4} under the [terms of the] MIT License",
    "mit-text": f"""{_MIT_GRANT} subject to the following conditions
        The above copyright notice and this permission notice [including the next paragraph] shall be included in all
        copies or substantial portions of the Software {_MIT_DISCLAIMER}""",
    "mit-0-text": f"{_MIT_GRANT} {_MIT_DISCLAIMER}",
    "apache-2.0-reference": "licensed under the Apache License [version] 2 0 [the License]",
    "apache-2.0-notice": _APACHE_NOTICE,
    "apache-2.0-header": f"""{_APACHE_NOTICE} You may obtain a copy of the License at
        [http www apache org licenses LICENSE 2 0 | https www apache org licenses LICENSE 2 0]
        Unless required by applicable law or agreed to in writing software distributed under the License is distributed on
        an as is basis without warranties or conditions of any kind either express or implied
        See the License for the specific language governing permissions and limitations under the License""",
    "apache-2.0-text": _whole("apache-2.0"),
    **{f"gpl-3.0-{kind}": markup for kind, markup in _gpl("3").items()},
    "gpl-3.0-text": _whole("gpl-3.0"),
    **{f"gpl-2.0-{kind}": markup for kind, markup in _gpl("2").items()},
    "gpl-2.0-text": _whole("gpl-2.0"),
    "cc-by-nc-4.0-reference": "{1} under [the] [Creative Commons | CC] BY NC 4 0 [License]",
    "bsd-2-clause-text": f"{_BSD_TERMS} {_BSD_DISCLAIMER}",
    "bsd-3-clause-text": f"{_BSD_TERMS} {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "bsd-4-clause-text": f"{_BSD_TERMS} {_BSD_ADVERTISING} {_BSD_NAMES} {_BSD_DISCLAIMER}",
}

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True


@dataclass(frozen=True)
class Automaton:
    """States 0..n; ``steps[s]`` are the (word, next state) pairs that read a word, word None any word;
    ``skips[s]`` the states reached without reading."""

    label: str
    steps: tuple[tuple[tuple[bytes | None, int], ...], ...]
    closure: tuple[frozenset[int], ...]
    final: int
    starts: frozenset[bytes | None]

    def ends(self, words: list[bytes], at: int) -> int:
        """Where the longest match that begins at word ``at`` ends; ``at`` if there is none."""
        states, found = self.closure[0], at
        for place in range(at, len(words)):
            word = words[place]
            states = frozenset().union(*(
                self.closure[to] for s in states for read, to in self.steps[s] if read is None or read == word))
            if not states:
                break
            if self.final in states:
                found = place + 1
        return found


def compile_template(label: str, markup: str) -> Automaton:
    """Automaton of a template. Alternatives inside [..] and <..> are separated by |; regions may nest."""
    tokens = re.findall(r"[\[\]<>|]|\{\d+\}|[^\s\[\]<>|{}]+", markup)
    steps: list[list[tuple[bytes | None, int]]] = [[]]
    skips: list[set[int]] = [set()]

    def state() -> int:
        steps.append([])
        skips.append(set())
        return len(steps) - 1

    def line(now: int, place: int) -> tuple[int, int]:
        """From state ``now``, the tokens from a place up to where the region they are in ends or goes on: state and place."""
        while place < len(tokens) and tokens[place] not in "]>|":
            token = tokens[place]
            place += 1
            if token[0] == "{":
                inner = [now]
                for _ in range(int(token[1:-1])):
                    now = state()
                    steps[inner[-1]].append((None, now))
                    inner.append(now)
                for s in inner[:-1]:
                    skips[s].add(now)
            elif token in "[<":
                begin, ends = now, [now] if token == "[" else []
                place -= 1
                while tokens[place] not in "]>":
                    # a choice has a beginning of its own: nothing may lead from one into another
                    first = state()
                    skips[begin].add(first)
                    end, place = line(first, place + 1)
                    ends.append(end)
                place += 1
                now = state()
                for s in ends:
                    skips[s].add(now)
            else:
                for word in _WORD.findall(token.lower().encode()):
                    end = state()
                    steps[now].append((word, end))
                    now = end
        return now, place

    now, _ = line(0, 0)
    closure = []
    for s in range(len(steps)):
        seen, todo = {s}, [s]
        while todo:
            for t in skips[todo.pop()] - seen:
                seen.add(t)
                todo.append(t)
        closure.append(frozenset(seen))
    firsts = frozenset(read for s in closure[0] for read, _ in steps[s])
    return Automaton(label, tuple(map(tuple, steps)), tuple(closure), now, firsts)


def mandatory(markup: str) -> list[bytes]:
    """Words that every accepted text has; of alternatives those that all of them have."""
    def shared(choice: re.Match) -> str:
        if choice[0][0] != "<":
            return " "
        first, *others = (re.findall(r"[^\W_]+", text.lower()) for text in choice[0][1:-1].split("|"))
        return f" {' '.join(w for w in first if all(w in other for other in others))} "

    markup, before = re.sub(r"\{\d+\}", " ", markup), None
    while before != markup:
        before, markup = markup, re.sub(r"\[[^\[\]<>]*\]|<[^\[\]<>]*>", shared, markup)
    return _WORD.findall(markup.lower().encode())


class Scanner:
    """Phrases and templates made ready for many texts."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        self.automata = [(compile_template(label, m), mandatory(m)) for label, m in templates.items()]
        # the longest word of each pattern: a text without any of these bytes needs no look at its words
        keys = [max(words, key=len) for words, _ in self.phrases]
        keys += [max(words, key=len) for _, words in self.automata]
        self.key = re.compile(b"|".join(re.escape(k) for k in sorted(set(keys))))

    def scan(self, text: bytes) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
        """Places of phrases and of templates in a lower-cased text: first word, word after the last, label."""
        if not self.key.search(text):
            return [], []
        words = _WORD.findall(text)
        at: dict[bytes, list[int]] = {}
        for i, w in enumerate(words):
            at.setdefault(w, []).append(i)
        base = [(i, i + len(p), label) for p, label in self.phrases
                for i in at.get(p[0], ()) if words[i:i + len(p)] == p]
        more = []
        for automaton, needed in self.automata:
            if all(w in at for w in needed):
                more += self._places(automaton, needed, words, at)
        return sorted(base), sorted(more)

    @staticmethod
    def _places(automaton: Automaton, needed: list[bytes], words, at) -> list[tuple[int, int, str]]:
        """Matches that don't overlap, from the left. A match has the template's rarest mandatory word
        at most ``reach`` words behind its start, so only starts before such a word are tried."""
        anchor = min(set(needed), key=lambda w: len(at[w]))
        reach, found, free, any_word = len(automaton.steps), [], 0, None in automaton.starts
        for place in at[anchor]:
            for start in range(max(free, place - reach), place + 1):
                if not (any_word or words[start] in automaton.starts):
                    continue
                end = automaton.ends(words, start)
                if end > start and end > place:
                    found.append((start, end, automaton.label))
                    free = end
                    break
        return found


_SCANNERS: dict[tuple, Scanner] = {}
_RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
           "labels string, score double, template_spans string")


def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    """One for each worker process."""
    key = (phrases, templates)
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(dict(phrases), dict(templates))
    return _SCANNERS[key]


def _scan(phrases: tuple, templates: tuple, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(phrases, templates)
        for batch in batches:
            for piece in common.pieces(batch, "text"):
                data, offsets = common.text_bytes(piece.column(1))
                data = common.lower(data)
                begins, _ = common.runs(_INSIDE[data], offsets)
                counts = np.diff(np.searchsorted(begins, offsets))
                out = []
                for i in range(piece.num_rows):
                    n = int(counts[i])
                    base, more = scanner.scan(data[offsets[i]:offsets[i + 1]].tobytes())
                    labels = {x[2] for x in base}
                    covered: set[int] = set()
                    for a, b, _ in base + more:
                        covered.update(range(a, b))
                    out.append((
                        n, len(base), base[0][0] if base else None, base[-1][0] if base else None,
                        ",".join(sorted(labels)), ",".join(sorted(labels | {x[2] for x in more})),
                        0.75 + 0.25 * len(covered) / n if more else 0.5 if base else 0.0,
                        ",".join(f"{label}:{a}:{b}" for a, b, label in more)))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:], strict=True))],
                    schema=schema)
    return run


def scan(docs: DataFrame, phrases: dict[str, str] | None = None,
         templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each row: doc_id, n_words, n_base (places of phrases), first_word and last_word (the
    first and last place's first word), base_labels, labels, score, template_spans (label:first word:word after the last).

    Text is lower-cased in A-Z; words are runs of digits, letters a-z and characters from U+0080 on. The score
    is 0 without a finding, 0.5 with a phrase only, and from 0.75 up to 1 with an accepted template, by
    the share of the text's words that the findings cover.
    """
    common.small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                        ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                        ("labels", pa.string()), ("score", pa.float64()), ("template_spans", pa.string())])
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    return docs.select("doc_id", F.col("text")).mapInArrow(
        _scan(tuple(phrases.items()), tuple(templates.items()), schema), _RESULT)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
