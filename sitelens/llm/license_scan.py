"""Licence scans by template markup compiled into token automata.

A template (``license_templates``) is mandatory wording with optional regions
(``[[ ]]``) and replaceable ones (``<<n>>``, at most n words). It is compiled
into an automaton over words: a mandatory word is a step on that word, a
replaceable region is steps on any word, optional wording can be stepped over.
A place of a text is accepted if the automaton, started there, reaches its end:
the mandatory wording stands there exactly, in order, with nothing between but
what the template allows. A plain phrase is a template without regions. The
accepted stretch is the shortest from its start.

A task turns the texts of a block into word numbers (0 for words that no
template has), finds the places of each template's leading words by numpy, and
runs automata from those places only. A run ends after at most as many words as the
template is long, so the work is bounded by the text's length, whatever repeats.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
Memory of a task: blocks of 2 MB of text, or one text if longer, and about four bytes a word of it.

Defined cases: a null text, or one without words, has no words, matches or
labels, and score 0; every accepted place counts, also overlapping ones and
repeated rows; ids may repeat or be null; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.license_templates import PHRASES, TEMPLATES
from sitelens.llm.textops import as_bytes, blocks, id_type, word_slabs

#: Lower-cases A-Z and turns every ASCII byte that belongs to no word into a blank.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_MARKUP = re.compile(r"\[\[(.*?)\]\]|<<(\d+)>>", re.DOTALL)


def words_of(text: str) -> list[str]:
    return text.encode().translate(_CLEAN).decode().split()


@dataclass
class Automaton:
    """States 0 to ``last``: ``steps[s]`` leads a word (or, under None, any word) to
    further states; reaching ``last`` accepts."""

    label: str
    phrase: bool
    steps: list[dict[str | None, set[int]]] = field(default_factory=list)

    @property
    def last(self) -> int:
        return len(self.steps) - 1

    @property
    def lead(self) -> list[str]:
        """The mandatory words, two at most, that every accepted stretch begins with."""
        (first, after), = self.steps[0].items()
        found = [first]
        if len(after) == 1 and (at := next(iter(after))) != self.last and len(self.steps[at]) == 1 and None not in self.steps[at]:
            found += self.steps[at]
        return found

    def end(self, words, start: int) -> int:
        """Where the shortest accepted stretch from ``start`` ends, -1 if there is none."""
        states, at = {0}, start
        while states and at < len(words):
            word, at = words[at], at + 1
            states = {t for s in states for key in (word, None) for t in self.steps[s].get(key, ())}
            if self.last in states:
                return at
        return -1


def compile_template(label: str, markup: str, phrase: bool = False) -> Automaton:
    items: list[tuple[str, object]] = []  # mandatory words, optional word lists, widths of replaceable regions
    at = 0
    for region in _MARKUP.finditer(markup):
        items += [("word", w) for w in words_of(markup[at:region.start()])]
        items.append(("any", int(region[2])) if region[2] else ("optional", words_of(region[1])))
        at = region.end()
    items += [("word", w) for w in words_of(markup[at:])]
    if not items or items[0][0] != "word" or items[-1][0] == "any":
        raise ValueError(f"a template begins with a mandatory word and ends with wording: {markup!r}")
    # One node for each place between words; free[x] are places reached from x without a word.
    words, free = [], {}
    for kind, value in items:
        here = len(words)
        if kind == "word":
            words.append(value)
        elif kind == "optional":
            words += value
            free.setdefault(here, set()).add(len(words))
        else:
            words += [None] * value
            for i in range(here, len(words)):
                free.setdefault(i, set()).add(len(words))

    def reached(state: int) -> set[int]:
        out, todo = {state}, [state]
        while todo:
            for t in free.get(todo.pop(), set()) - out:
                out.add(t)
                todo.append(t)
        return out

    steps: list[dict[str | None, set[int]]] = [{} for _ in range(len(words) + 1)]
    for i, word in enumerate(words):
        for s in reached(i + 1):
            steps[i].setdefault(word, set()).add(s)
    return Automaton(label, phrase, steps)


def standard() -> list[Automaton]:
    """The automata of all phrases and templates of ``license_templates``."""
    return ([compile_template(label, phrase, True) for phrase, label in PHRASES.items()]
            + [compile_template(label, markup) for label, markup in TEMPLATES])


class Scanner:
    def __init__(self, automata: list[Automaton]):
        self.automata = automata
        known = {w for a in automata for step in a.steps for w in step if w is not None}
        self.numbers = {w.encode(): i for i, w in enumerate(sorted(known), 1)}
        self.spelled = [None, *sorted(known)]
        self.by_lead: dict[int, dict[int, list[int]]] = {}  # first word -> second word (0: any) -> automata
        for i, a in enumerate(automata):
            first, *second = (self.numbers[w.encode()] for w in a.lead)
            self.by_lead.setdefault(first, {}).setdefault(second[0] if second else 0, []).append(i)
        self.is_first = np.zeros(len(self.spelled), bool)
        self.is_first[list(self.by_lead)] = True

    def numbered(self, text: bytes) -> np.ndarray:
        get = self.numbers.get
        parts = [np.array([get(w, 0) for w in words], np.int32) for words in word_slabs(text.translate(_CLEAN))]
        return np.concatenate([np.zeros(0, np.int32), *parts])

    def matches(self, numbers: np.ndarray) -> list[tuple[int, int, int]]:
        """(automaton, start, end) of every accepted place."""
        found = []
        starts = np.flatnonzero(self.is_first[numbers])
        if len(starts):
            words = _Words(numbers, self.spelled)
            for start in starts.tolist():
                second = self.by_lead[int(numbers[start])]
                after = int(numbers[start + 1]) if start + 1 < len(numbers) else -1
                for i in second.get(0, []) + (second.get(after, []) if after > 0 else []):
                    end = self.automata[i].end(words, start)
                    if end >= 0:
                        found.append((i, start, end))
        return found


class _Words:
    """A text's words by place, None for those in no template."""

    def __init__(self, numbers: np.ndarray, spelled: list[str | None]):
        self.numbers, self.spelled = numbers, spelled

    def __len__(self) -> int:
        return len(self.numbers)

    def __getitem__(self, at: int) -> str | None:
        return self.spelled[self.numbers[at]]


_MATCH = "struct<label:string,phrase:boolean,start:long,end:long>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", automata: list[Automaton] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, matches (label, phrase, start, end; by
    start, words numbered from 0, the end not included) and covered, the words in any match."""
    automata = standard() if automata is None else automata

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(automata)
        kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            every = as_bytes(batch.column(1))
            for a, b in blocks([len(t) for t in every]):
                n_words, rows, covered = [], [], []
                for text in every[a:b]:
                    numbers = scanner.numbered(text)
                    found = scanner.matches(numbers)
                    n_words.append(len(numbers))
                    rows.append([{"label": automata[i].label, "phrase": automata[i].phrase, "start": s, "end": e} for i, s, e in found])
                    covered.append(_covered(found, len(numbers)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words, pa.int64()), pa.array(rows, kind), pa.array(covered, pa.int64())],
                    ["doc_id", "n_words", "matches", "covered"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {id_type(docs, id_col)}, n_words long, matches array<{_MATCH}>, covered long")


def _covered(found: list[tuple[int, int, int]], n: int) -> int:
    if not found:
        return 0
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, [s for _, s, _ in found], 1)
    np.add.at(depth, [e for _, _, e in found], -1)
    return int((np.cumsum(depth) > 0).sum())


def labels_of(matches: Column) -> Column:
    """The distinct labels, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def transitions(automata: list[Automaton]) -> list[tuple[int, str, bool, int, str | None, int, bool]]:
    """The automata as rows: (template, label, phrase, state, word or None, next state, whether it accepts)."""
    return [(i, a.label, a.phrase, s, word, t, t == a.last) for i, a in enumerate(automata)
            for s, step in enumerate(a.steps) for word, after in step.items() for t in sorted(after)]
