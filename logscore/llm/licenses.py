"""License scans: template markup compiled to token automata.

A template is license wording with two kinds of marks:

    <<beginOptional>> words <<endOptional>>          may be left out; may nest
    <<var;name=year;match=[0-9]{4};words=2>>         up to `words` words (8 if not given) that the
                                                     pattern matches as a whole, joined by spaces

Everything else is mandatory and must match word for word, in lower case and without punctuation.
A template is compiled to an automaton whose edges are words or replaceable regions. Candidate
places are those where one of the first (up to three) words sequences that the automaton accepts
stands; hashes find them, the automaton then reads the words themselves.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from logscore.llm.words import ALNUM, HashIndex, Words, by_run, words_of

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

_MIT = (
    "Permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files <<beginOptional>>the Software<<endOptional>> to deal in the "
    "Software without restriction"
)
_BSD = (
    "Redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met "
)
_ISC = (
    "Permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software "
    "for any purpose with or without fee is hereby granted provided that the above copyright notice "
    "and this permission notice appear in all copies "
)
#: Numbers of clauses and names of holders.
_NUMBER = "<<beginOptional>><<var;name=number;match=[0-9a-e]|i{1,3}|iv;words=1>><<endOptional>> "
_HOLDER = "<<var;name=holder;match=.+;words=20>> "
_BSD_SOURCE_AND_BINARY = (
    f"{_NUMBER} Redistributions of source code must retain the above copyright notice this list of "
    f"conditions and the following disclaimer {_NUMBER} Redistributions in binary form must "
    "reproduce the above copyright notice this list of conditions and the following disclaimer in "
    "the documentation and or other materials provided with the distribution "
)
_BSD_ADVERTISING = (
    f"{_NUMBER} All advertising materials mentioning features or use of this software must display "
    "the following acknowledgement This product includes software developed by "
    f"<<beginOptional>>the<<endOptional>> {_HOLDER}"
)
_BSD_NAMES = (
    f"{_NUMBER} Neither the name of {_HOLDER} nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission "
)
_BSD_DISCLAIMER = (
    f"This software is provided by {_HOLDER} as is and any express or implied warranties including "
    "but not limited to the implied warranties of merchantability and fitness for a particular "
    f"purpose are disclaimed In no event shall {_HOLDER} be liable for any direct indirect "
    "incidental special exemplary or consequential damages including but not limited to procurement "
    "of substitute goods or services loss of use data or profits or business interruption however "
    "caused and on any theory of liability whether in contract strict liability or tort including "
    "negligence or otherwise arising in any way out of the use of this software even if advised of "
    "the possibility of such damage"
)

_FREE_SOFTWARE = (
    "This <<beginOptional>>program<<endOptional>><<beginOptional>>library<<endOptional>> is free "
    "software you can redistribute it and or modify it under the terms of the GNU {} General Public "
    "License as published by the Free Software Foundation <<beginOptional>>either "
    "<<var;name=version;match=(version )?[0-9]( [0-9])?;words=3>> of the License or at your option "
    "any later version<<endOptional>>"
)

#: Labels of wording that only names or begins a license; given where no whole text or notice stands
#: in that place.
OPENINGS = frozenset(
    "apache-2.0 bsd-opening cc-by-4.0 cc-by-nc-4.0 gpl-2.0 gpl-3.0 isc-opening mit-opening".split()
)

#: Templates by the label they give; wording of public license notices, and whole license texts.
TEMPLATES = {
    "agpl-notice": _FREE_SOFTWARE.format("Affero"),
    "all-rights-reserved": "All rights reserved",
    "apache-2.0": (
        "Licensed under the Apache License <<beginOptional>>Version<<endOptional>> "
        "<<var;name=version;match=v?2( 0)?;words=2>>"
    ),
    "apache-notice": (
        "Licensed under the Apache License Version 2 0 <<beginOptional>>the License<<endOptional>> "
        "you may not use this <<var;name=what;match=.+;words=3>> except in compliance with the "
        "License You may obtain a copy of the License at "
        "<<var;name=scheme;match=https?;words=1>> www apache org licenses LICENSE 2 0 "
        "Unless required by applicable law or agreed to in writing software distributed under the "
        "License is distributed on an AS IS BASIS WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND "
        "either express or implied See the License for the specific language governing permissions "
        "and limitations under the License"
    ),
    "bsd-2-clause": _BSD + _BSD_SOURCE_AND_BINARY + _BSD_DISCLAIMER,
    "bsd-3-clause": _BSD + _BSD_SOURCE_AND_BINARY + _BSD_NAMES + _BSD_DISCLAIMER,
    "bsd-4-clause": (
        _BSD + _BSD_SOURCE_AND_BINARY + _BSD_ADVERTISING + _BSD_NAMES + _BSD_DISCLAIMER
    ),
    "bsd-opening": _BSD,
    "cc-by-4.0": (
        "Licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> "
        "CC BY <<var;name=version;match=4 0;words=2>>"
    ),
    "cc-by-nc-4.0": (
        "Licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> "
        "CC BY NC <<var;name=version;match=4 0;words=2>>"
    ),
    "gpl-notice": _FREE_SOFTWARE.format(""),
    "gpl-2.0": "GNU General Public License <<var;name=version;match=(version|v) 2|v2;words=2>>",
    "gpl-3.0": "GNU General Public License <<var;name=version;match=(version|v) 3|v3;words=2>>",
    "isc": (
        f"{_ISC} The software is provided as is and {_HOLDER} disclaims all warranties with regard "
        "to this software including all implied warranties of merchantability and fitness In no "
        f"event shall {_HOLDER} be liable for any special direct indirect or consequential damages "
        "or any damages whatsoever resulting from loss of use data or profits whether in an action "
        "of contract negligence or other tortious action arising out of or in connection with the "
        "use or performance of this software"
    ),
    "isc-opening": _ISC,
    "lgpl-notice": _FREE_SOFTWARE.format("<<var;name=kind;match=lesser|library;words=1>>"),
    "mit-opening": _MIT,
    "mit-release": (
        "Released under the <<beginOptional>>terms of the<<endOptional>> MIT License"
    ),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License v 2 0 If a copy "
        "of the MPL was not distributed with this file You can obtain one at "
        "<<var;name=scheme;match=https?;words=1>> <<beginOptional>>www<<endOptional>> mozilla org "
        "MPL 2 0"
    ),
    "mit-text": (
        f"{_MIT} including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the Software and to permit persons to whom the "
        "Software is furnished to do so subject to the following conditions The above copyright "
        "notice and this permission notice <<beginOptional>>including the next paragraph"
        "<<endOptional>> shall be included in all copies or substantial portions of the Software "
        "The software is provided as is without warranty of any kind express or implied including "
        "but not limited to the warranties of merchantability fitness for a particular purpose and "
        "<<var;name=non;match=non ?infringement;words=2>> In no event shall "
        f"{_HOLDER} be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or the "
        "use or other dealings in the software"
    ),
}

_MARK = re.compile(r"<<(.*?)>>", re.DOTALL)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_HEAD = 3


def _words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass
class Automaton:
    """States are numbers, 0 the first. Edges go on by one word, by a region, or by nothing."""

    by_word: list[dict[bytes, set[int]]] = field(default_factory=list)
    by_region: list[list[tuple[re.Pattern[bytes], int, int]]] = field(default_factory=list)
    by_nothing: list[set[int]] = field(default_factory=list)
    final: int = 0
    #: Words of the longest match.
    most: int = 0

    def state(self) -> int:
        self.by_word.append(defaultdict(set))
        self.by_region.append([])
        self.by_nothing.append(set())
        return len(self.by_word) - 1

    def closed(self, states: set[int]) -> set[int]:
        reached, todo = set(states), list(states)
        while todo:
            for state in self.by_nothing[todo.pop()] - reached:
                reached.add(state)
                todo.append(state)
        return reached

    def heads(self) -> set[tuple[bytes, ...]]:
        """The word sequences a match can begin with: of three words, or up to a region or the end."""
        found, todo = set(), [((), self.closed({0}))]
        while todo:
            head, states = todo.pop()
            if head and (
                len(head) == _HEAD
                or self.final in states
                or any(self.by_region[state] for state in states)
            ):
                found.add(head)
                continue
            onward = defaultdict(set)
            for state in states:
                for word, targets in self.by_word[state].items():
                    onward[word] |= targets
            todo += [((*head, word), self.closed(targets)) for word, targets in onward.items()]
        return found

    def longest(self, words: list[bytes]) -> int:
        """How many of the first words the automaton accepts, 0 if none. Regions read ahead."""
        at: dict[int, set[int]] = {0: self.closed({0})}
        best = 0
        while at:
            place = min(at)
            states = self.closed(at.pop(place))
            if self.final in states:
                best = max(best, place)
            for state in states:
                if place < len(words):
                    for target in self.by_word[state].get(words[place], ()):
                        at.setdefault(place + 1, set()).add(target)
                for pattern, most, target in self.by_region[state]:
                    for count in range(1, min(most, len(words) - place) + 1):
                        if pattern.fullmatch(b" ".join(words[place : place + count])):
                            at.setdefault(place + count, set()).add(target)
        return best


def compile_template(template: str) -> Automaton:
    """The automaton of a template. It must begin with a word."""
    made = Automaton()
    at, opened = made.state(), []
    for i, part in enumerate(_MARK.split(template)):
        if i % 2 == 0:
            for word in _words(part):
                at, before = made.state(), at
                made.by_word[before][word].add(at)
                made.most += 1
        elif part == "beginOptional":
            opened.append(at)
            at, before = made.state(), at
            made.by_nothing[before].add(at)
        elif part == "endOptional":
            if not opened:
                raise ValueError("endOptional without beginOptional")
            at, before = made.state(), at
            made.by_nothing[before].add(at)
            made.by_nothing[opened.pop()].add(at)
        elif part.startswith("var;"):
            values = dict(x.split("=", 1) for x in part.split(";")[1:] if "=" in x)
            pattern = re.compile(values.get("match", ".+").encode(), re.DOTALL)
            at, before = made.state(), at
            made.by_region[before].append((pattern, int(values.get("words", 8)), at))
            made.most += int(values.get("words", 8))
        else:
            raise ValueError(f"unknown mark {part!r}")
    if opened:
        raise ValueError("beginOptional without endOptional")
    made.final = at
    if any(made.by_region[state] for state in made.closed({0})) or made.final in made.closed({0}):
        raise ValueError("a template must begin with a word")
    return made


def _hash_of(words: tuple[bytes, ...]) -> int:
    text = pa.array([b" ".join(words).decode()])
    return int(words_of(text, ALNUM).window_hashes(len(words))[0][0])


class Scanner:
    """Phrases and templates with their hash indexes, made once in each process."""

    def __init__(self, phrases: Mapping[str, str], templates: Mapping[str, str]):
        self.phrases = {tuple(_words(phrase)): label for phrase, label in phrases.items()}
        self.templates = {label: compile_template(text) for label, text in templates.items()}
        self.heads: dict[tuple[bytes, ...], list[str]] = defaultdict(list)
        for label, automaton in self.templates.items():
            for head in automaton.heads():
                self.heads[head].append(label)
        sizes: dict[int, list[int]] = defaultdict(list)
        for words in {*self.phrases, *self.heads}:
            sizes[len(words)].append(_hash_of(words))
        self.index = {n: HashIndex(np.array(h, dtype=np.uint64)) for n, h in sizes.items()}

    def find(self, words: Words) -> tuple[list[list[int]], list[set[str]], list[set[str]]]:
        """Per text: where phrases stand, labels of phrases, labels of accepted templates."""
        texts = len(words.first) - 1
        places: list[list[int]] = [[] for _ in range(texts)]
        base: list[set[str]] = [set() for _ in range(texts)]
        more: list[set[str]] = [set() for _ in range(texts)]
        for size, index in self.index.items():
            hashes, fits = words.window_hashes(size)
            found = index.places(hashes)
            found = found[fits[found]]
            owners = np.searchsorted(words.first, found, side="right") - 1
            for place, text in zip(found.tolist(), owners.tolist(), strict=True):
                window = tuple(words.text(place, place + size).split(b" "))
                if window in self.phrases:
                    places[text].append(place - int(words.first[text]))
                    base[text].add(self.phrases[window])
                more[text] |= self._accepted(self.heads.get(window, ()), words, place, text)
        return places, base, more

    def _accepted(self, labels: Iterable[str], words: Words, place: int, text: int) -> set[str]:
        """Those labels whose templates stand at a place; openings only where no other does."""
        whole = {x for x in labels if x not in OPENINGS and self._accepts(x, words, place, text)}
        return whole or {x for x in labels if x in OPENINGS and self._accepts(x, words, place, text)}

    def _accepts(self, label: str, words: Words, place: int, text: int) -> bool:
        automaton = self.templates[label]
        end = min(int(words.first[text + 1]), place + automaton.most)
        return automaton.longest(words.text(place, end).split(b" ")) > 0


_SCHEMA = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
    "base_labels string, labels string, score double"
)

_scanners: dict[tuple, Scanner] = {}


def scan_licenses(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """Per document: words, places of phrases, labels of phrases and of accepted templates.

    `score` is 1 where a whole text or notice is accepted, 0.75 where only one of `OPENINGS` is, such as
    the title of a license, 0.5 where only a phrase stands, else 0. Reads `doc_id` and `text`; other columns are not touched. A null or empty text has no words, no places
    and empty labels; first_word and last_word are null without a place. Repeated rows are all
    returned with the same result. Very long texts are worked on one at a time. An empty table gives
    an empty result.
    """
    made = (tuple(phrases.items()), tuple(templates.items()))
    Scanner(phrases, templates)  # a faulty template fails here, not in a task

    def work(run: pa.RecordBatch) -> pa.RecordBatch:
        if made not in _scanners:
            _scanners[made] = Scanner(dict(made[0]), dict(made[1]))
        words = words_of(run.column("text"), ALNUM)
        places, base, more = _scanners[made].find(words)
        scores = [
            1.0 if m - OPENINGS else 0.75 if m else 0.5 if b else 0.0
            for b, m in zip(base, more, strict=True)
        ]
        both = [b | m for b, m in zip(base, more, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                run.column("doc_id"),
                pa.array(np.diff(words.first), pa.int64()),
                pa.array(map(len, places), pa.int64()),
                pa.array([min(x, default=None) for x in places], pa.int64()),
                pa.array([max(x, default=None) for x in places], pa.int64()),
                pa.array([",".join(sorted(x)) for x in base], pa.string()),
                pa.array([",".join(sorted(x)) for x in both], pa.string()),
                pa.array(scores, pa.float64()),
            ],
            names=[x.split()[0] for x in _SCHEMA.split(", ")],
        )

    return docs.select("doc_id", "text").mapInArrow(by_run(work), _SCHEMA)
