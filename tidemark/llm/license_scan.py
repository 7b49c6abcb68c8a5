"""License scans by template markup.

A template is wording with two kinds of markup: ``<<optional>> ... <</optional>>`` may be left out (it may nest), and
``<<var:n>>`` stands for up to n words of any kind (names, years, addresses). It is compiled to an automaton over words:
mandatory words must all stand there exactly and in order, nothing else may stand between them. The states of an
automaton are bits of one integer, so a word moves all of them at once.

Texts are reduced to lower-cased words first, so case, punctuation and line breaks never matter. A template is run over a
text only if its longest run of mandatory words occurs there, which a substring search tells.

Base phrases (fixed word runs) are searched beside the templates; their places and labels are returned on their own.

Defined results: a null text counts as empty; a text without words has no places and no labels; a template can be
accepted from several places, and each acceptance is the longest from its place; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .words import ALNUM_LOWER, documents, map_blocks

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Wording of license notices.
TEMPLATES = {
    "mit": "<<optional>>this <<var:2>> is<</optional>> released under the <<optional>>terms of the<</optional>> mit license",
    "mit-full": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files <<optional>>the software<</optional>> to deal in the software without restriction",
    "apache-2": "licensed under the apache license version 2 <<optional>>0<</optional>> "
                "<<optional>>the license you may not use this file except in compliance with the license<</optional>>",
    "gpl-2": "licensed under the <<optional>>terms of the<</optional>> gnu general public license "
             "<<optional>>as published by the free software foundation either<</optional>> version 2 "
             "<<optional>>or at your option any later version<</optional>>",
    "gpl-3": "licensed under the <<optional>>terms of the<</optional>> gnu general public license "
             "<<optional>>as published by the free software foundation either<</optional>> version 3 "
             "<<optional>>or at your option any later version<</optional>>",
    "cc-by-nc-4": "licensed under <<optional>>a<</optional>> <<optional>>creative commons attribution noncommercial<</optional>> "
                  "cc by nc <<optional>>sa<</optional>> <<optional>>nd<</optional>> 4 0",
    "bsd": "redistribution and use in source and binary forms with or without modification are permitted provided that "
           "the following conditions are met",
    "all-rights-reserved": "copyright <<optional>>c<</optional>> <<var:6>> all rights reserved",
}

_MARK = re.compile(r"<<(/?optional|var:\d+)>>|([^\s<>]+)")


@dataclass
class Automaton:
    """States are bits; state i waits for an element, the last one accepts."""

    label: str
    words: dict[bytes, int] = field(default_factory=dict)  # word: states that it moves to the next one
    any_word: int = 0  # states that any word moves
    skips: list[int] = field(default_factory=list)  # states reached from each without a word, itself included
    needed: bytes = b""  # the longest run of mandatory words

    @property
    def accept(self) -> int:
        return 1 << (len(self.skips) - 1)

    def closed(self, states: int) -> int:
        out = 0
        while states:
            low = states & -states
            out |= self.skips[low.bit_length() - 1]
            states ^= low
        return out

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, end) of the longest acceptance from each place."""
        begin = self.closed(1)
        for start, first in enumerate(words):
            if not begin & (self.words.get(first, 0) | self.any_word):
                continue
            states, end = begin, None
            for at in range(start, len(words)):
                states &= self.words.get(words[at], 0) | self.any_word
                if not states:
                    break
                states = self.closed(states << 1)
                if states & self.accept:
                    end = at + 1
            if end is not None:
                yield start, end


def compile_template(label: str, template: str) -> Automaton:
    made = Automaton(label)
    elements, jumps, open_at, run, runs = 0, [], [], [], []

    def element(word: bytes | None) -> None:
        nonlocal elements
        if word is None:
            made.any_word |= 1 << elements
        else:
            made.words[word] = made.words.get(word, 0) | 1 << elements
        elements += 1

    for mark, word in _MARK.findall(template):
        if word:
            element(word.encode())
            run.append(word.encode())
            if not open_at:
                runs.append(list(run))
            continue
        run = []
        if mark == "optional":
            open_at.append(elements)
        elif mark == "/optional":
            jumps.append((open_at.pop(), elements))
        else:
            for _ in range(int(mark[4:])):
                jumps.append((elements, elements + 1))
                element(None)
    if open_at:
        raise ValueError(f"optional region of {label} is not closed")
    if not runs:
        raise ValueError(f"template {label} has no mandatory words")
    made.needed = b" " + b" ".join(max(runs, key=len)) + b" "
    made.skips = [1 << i for i in range(elements + 1)]
    # Skips lead forward only: from the last state backwards, each is complete when it is used.
    for i in range(elements, -1, -1):
        for a, b in jumps:
            if a == i:
                made.skips[i] |= made.skips[b]
    if made.skips[0] & made.accept:
        raise ValueError(f"template {label} accepts the empty text")
    return made


def places(joined: bytes, phrase: bytes) -> list[int]:
    """Word places of a phrase in words joined (and enclosed) by single spaces."""
    out, at = [], joined.find(phrase)
    while at >= 0:
        out.append(joined.count(b" ", 0, at + 1) - 1)
        at = joined.find(phrase, at + 1)
    return out


SCAN = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, templates array<struct<label:string,start:int,stop:int>>")


def scan_licenses(df: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base places and labels, all labels, accepted templates with places, and a score.

    score is 1 where a template accepts (its whole mandatory wording stands there), 0.5 where only a phrase does, else 0.
    """
    automata = [compile_template(label, t) for label, t in (TEMPLATES if templates is None else templates).items()]
    sought = [(f" {p} ".encode(), label) for p, label in (PHRASES if phrases is None else phrases).items()]
    # Bytes that end words become spaces.
    table = bytes(32 if b == 0 else b for b in ALNUM_LOWER.tolist())

    def work(block: pa.RecordBatch) -> dict:
        out: dict[str, list] = {name.split()[0]: [] for name in SCAN.split(", ")}
        for key, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist()):
            words = (text or "").encode().translate(table).split()
            joined = b" " + b" ".join(words) + b" "
            base, labels = [], set()
            for phrase, label in sought:
                if found := places(joined, phrase):
                    base += found
                    labels.add(label)
            accepted = [{"label": a.label, "start": s, "stop": e} for a in automata if a.needed in joined
                        for s, e in a.matches(words)]
            named = labels | {a["label"] for a in accepted}
            row = (key, len(words), len(base), min(base, default=None), max(base, default=None),
                   ",".join(sorted(labels)), ",".join(sorted(named)), 1.0 if accepted else 0.5 if base else 0.0, accepted)
            for name, value in zip(out, row):
                out[name].append(value)
        return out

    return map_blocks(documents(df, id_col, text_col), work, SCAN)
