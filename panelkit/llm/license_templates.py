"""License scans by template-markup matching.

A template is license wording with marked regions: ``<<beginOptional>>`` to
``<<endOptional>>`` may be missing, ``<<var;name="x";words="a-b">>`` stands
for any ``a`` to ``b`` words. Each template compiles to an automaton over
words; a text is accepted at a place where the mandatory wording follows
exactly, whatever stands in the marked regions. Matches of one template don't
overlap: from each start the longest is taken, and the search goes on after
it. The short base phrases are templates without marked regions, of which all
places count, overlapping ones too.

Words are what is left after lower-casing A-Z and cutting at every ASCII
character that is neither a letter nor a digit. Whole texts are scanned; an
automaton only starts where one of its first words stands, and only in texts
that hold all its mandatory words. Its variable regions are bounded, so a text
costs time in proportion to its length. Null and empty texts have no words.
Rows are independent: repeated rows, extra columns and empty tables need no
care.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Fixed values of the contract: phrase and label.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Public license wording, marked up: label and template.
TEMPLATES = [
    ("mit", """<<beginOptional>>this <<var;name="work";words="1-4">> is<<endOptional>> released under
        <<beginOptional>>the terms of<<endOptional>> the mit license"""),
    ("mit", """permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files <<beginOptional>>(the "software")<<endOptional>>, to deal in
        <<var;name="software";words="1-3">> without restriction"""),
    ("apache-2", """licensed under the apache license, version 2.0 <<beginOptional>>(the "license"); you may not use
        <<var;name="file";words="1-4">> except in compliance with the license<<endOptional>>"""),
    ("gpl-3", """<<beginOptional>>this <<var;name="work";words="1-4">> is<<endOptional>> licensed under
        <<beginOptional>>the terms of<<endOptional>> the gnu general public license <<beginOptional>>as published by
        the free software foundation<<endOptional>> <<beginOptional>>either<<endOptional>> version 3"""),
    ("cc-by-nc", """licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> cc by-nc
        <<var;name="version";words="1-2">>"""),
    ("cc-by-nc", """licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> creative commons
        attribution noncommercial <<var;name="version";words="0-2">> <<beginOptional>>international<<endOptional>> license"""),
    ("bsd-3", """redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met <<var;name="conditions";words="20-120">> neither the name of
        <<var;name="holder";words="1-12">> nor the names of its contributors may be used to endorse or promote products"""),
]
MARK = re.compile(r'<<(beginOptional|endOptional|var;name="[^"]*";words="(\d+)-(\d+)")>>')


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


def parse(markup: str) -> list:
    """Nested list of a template: words, ("any", least, most), ("optional", list)."""
    stack, at = [[]], 0
    for m in [*MARK.finditer(markup), None]:
        stack[-1] += words_of(markup[at:m.start() if m else len(markup)])
        if m is None:
            break
        at = m.end()
        if m[1] == "beginOptional":
            stack.append([])
        elif m[1] == "endOptional":
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        else:
            stack[-1].append(("any", int(m[2]), int(m[3])))
    if len(stack) != 1:
        raise ValueError("unbalanced optional region")
    return stack[0]


class Automaton:
    """States are numbers; a state reads its word (None: any word) and goes to
    the next, or skips ahead without reading."""

    def __init__(self, label: str, markup: str):
        self.label, self.reads, self.skips = label, [], {}
        tree = parse(markup)
        self.mandatory = {x for x in tree if isinstance(x, bytes)}
        self._add(tree)
        self.end = len(self.reads)
        self.start = self._closed({0})
        if any(s == self.end or self.reads[s] is None for s in self.start):
            raise ValueError("a template must begin with a word")
        self.first = {self.reads[s] for s in self.start}

    def _add(self, items: list) -> None:
        for x in items:
            if isinstance(x, bytes):
                self.reads.append(x)
            elif x[0] == "optional":
                at = len(self.reads)
                self._add(x[1])
                self.skips.setdefault(at, set()).add(len(self.reads))
            else:
                self.reads += [None] * x[1]
                for _ in range(x[2] - x[1]):
                    self.skips.setdefault(len(self.reads), set()).add(len(self.reads) + 1)
                    self.reads.append(None)

    def _closed(self, states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for s in self.skips.get(todo.pop(), ()):
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def longest(self, words: list[bytes], at: int) -> int:
        """End of the longest match that starts at ``at``; -1 if none does."""
        states, end = self.start, -1
        while states:
            if self.end in states:
                end = at
            if at >= len(words):
                break
            w = words[at]
            states = self._closed({s + 1 for s in states if s < self.end and self.reads[s] in (None, w)})
            at += 1
        return end

    def matches(self, words: list[bytes], overlapping: bool = False) -> list[tuple[int, int]]:
        out, free = [], 0
        for i, w in enumerate(words):
            if i >= free and w in self.first and (end := self.longest(words, i)) >= 0:
                out.append((i, end))
                free = i + 1 if overlapping else max(end, i + 1)
        return out


def regex_of(markup: str) -> str:
    """The template as a regular expression over words that each follow one
    space (for engines that only have these); one more space must follow."""
    def part(items):
        return "".join(f" {x.decode()}" if isinstance(x, bytes) else f"(?:{part(x[1])})?" if x[0] == "optional"
                       else f"(?: [^ ]+){{{x[1]},{x[2]}}}" for x in items)
    return part(parse(markup)) + " "


def _scanner(base, templates):
    def scan(batches):
        phrases = [Automaton(label, text) for text, label in base]
        automata = [Automaton(label, text) for label, text in templates]

        def one(text):
            words = words_of(text or "")
            known, found = None, []
            for kind, several in (("phrase", phrases), ("template", automata)):
                for a in several:
                    known = known or set(words)
                    if a.mandatory <= known:
                        found += [{"label": a.label, "kind": kind, "first": i, "end": j}
                                  for i, j in a.matches(words, kind == "phrase")]
            return len(words), found

        for b in batches:
            rows = [one(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()),
                                                                    ("first", pa.int64()), ("end", pa.int64())])))],
                names=["id", "n_words", "matches"])
    return scan


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, templates=TEMPLATES) -> DataFrame:
    """``id``, ``n_words`` and ``matches``: label, kind (phrase or template),
    first word and the word after the last one, words counted from 0."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    match = T.StructType([T.StructField("label", T.StringType()), T.StructField("kind", T.StringType()),
                          T.StructField("first", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([src.schema.fields[0], T.StructField("n_words", T.LongType()),
                           T.StructField("matches", T.ArrayType(match))])
    return src.mapInArrow(_scanner(base, templates), schema)
