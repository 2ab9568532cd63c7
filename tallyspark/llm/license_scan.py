"""Licences of texts: notice phrases, and licence expressions behind tags.

*Search.* A text is lower-cased (A-Z) and reduced to its words, runs of
letters and digits of ASCII and of anything beyond it, with one space around
each. One Aho-Corasick automaton over all phrases, spaces included, then finds
every place where the words of a notice phrase or of an identifier tag stand
consecutively, overlapping ones too, in one pass.

*Expressions.* Behind a tag the text as written is parsed, to the end of the
line: identifiers joined by ``or``, ``and`` and ``with`` (binding in that
order, loosest first) and parentheses. A shunting-yard parser turns it into
postfix form; it reads as far as the text is an expression, drops operators
without a right side and closes open parentheses. A plain ``license:`` is a
tag only if every identifier behind it is known, as such text is common. Text
inside an expression is not read again, so a text costs linear time.

*Evaluation.* Each licence has a degree of obligation. ``and`` takes the
greater, ``or`` the alternative with the lesser (ties: the left one), and a
known exception behind ``with`` lowers its licence's. ``chosen`` are the
labels of the alternatives so chosen. A text's score is the greatest
obligation among its notices and expressions, 0 if it has neither.

Labels are identifiers in lower case without ``-only``, ``-or-later``, ``+``
and a trailing ``.0``; those of Creative Commons go without version.

Row-local: nothing is shuffled. Nulls: a null text has no words, no labels and
score 0. Null or repeated ids and repeated rows give a row each; extra columns
are ignored. Very long texts are scanned whole, and so are very long
expressions. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import map_arrow, utf8

# The phrases that always count, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license version 2": "epl-2",
    "boost software license version 1": "bsl-1",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution sharealike": "cc-by-sa",
    "cc0 1 0 universal": "cc0-1",
    "released into the public domain": "public-domain",
}
# Words of the tags in front of an expression.
TAGS = ["spdx license identifier", "license expression", "license", "licence"]
PLAIN_TAGS = ("license", "licence")

# Degrees of obligation of known licences.
OBLIGATIONS = {
    0.1: ["0bsd", "cc0-1", "public-domain", "unlicense", "wtfpl"],
    0.3: ["apache-1.1", "apache-2", "artistic-2", "bsd", "bsd-2-clause", "bsd-3-clause", "bsd-4-clause", "bsl-1",
          "cc-by", "isc", "mit", "mit-0", "ncsa", "openssl", "postgresql", "psf-2", "python-2", "x11", "zlib"],
    0.5: ["cddl-1", "cddl-1.1", "epl-1", "epl-2", "lgpl", "lgpl-2", "lgpl-2.1", "lgpl-3", "mpl-1.1", "mpl-2"],
    0.7: ["agpl", "agpl-3", "cc-by-sa", "eupl-1.2", "gpl", "gpl-1", "gpl-2", "gpl-3", "odbl-1", "osl-3"],
    1.0: ["busl-1.1", "cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nd", "sspl-1"],
}
UNKNOWN = 0.9
# Known exceptions.
EXCEPTIONS = ["autoconf-exception-3", "bison-exception-2.2", "bootloader-exception", "classpath-exception-2",
              "font-exception-2", "gcc-exception-3.1", "linux-syscall-note", "llvm-exception",
              "openjdk-assembly-exception-1", "qt-gpl-exception-1", "u-boot-exception-2", "wxwindows-exception-3.1"]
_KNOWN = {label: degree for degree, labels in OBLIGATIONS.items() for label in labels}
_EXCEPTIONS = frozenset(EXCEPTIONS)

_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b > 0x7F or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
               for b in range(256))
_INSIDE = np.frombuffer(_WORDS, np.uint8) != 0x20
_BEHIND_TAG = re.compile(rb"""["']?[ \t]*[:=][ \t]*["']?""")
_TOKEN = re.compile(rb"[ \t]*([()]|[A-Za-z0-9.+:-]+)")
_STRENGTH = {"or": 1, "and": 2, "with": 3}

RESULT_SCHEMA = (
    "doc_id long, n_words long, notices array<struct<word: long, label: string, base: boolean>>, "
    "expressions array<struct<start: long, end: long, postfix: string, labels: array<string>, "
    "chosen: array<string>, obligation: double>>, score double")


def label_of(identifier: str) -> str:
    label = re.sub(r"(-only|-or-later|\+)$", "", identifier.lower())
    if label.startswith("cc-"):
        return re.sub(r"-[0-9.]+$", "", label)
    return re.sub(r"(-\d+)\.0$", r"\1", label)


def to_postfix(text: bytes, at: int) -> tuple[list[str], int]:
    """Postfix form of the longest expression in the line of text[at:], and
    where it ends. Operators are or, and, with; the rest are labels."""
    output, waiting, depth, wants_operand = [], [], 0, True
    last = at
    while (found := _TOKEN.match(text, at)) is not None:
        token = found[1].decode()
        name = token.lower()
        stop = len(token.rstrip(".:")) < len(token)
        if wants_operand:
            if token == "(" and waiting[-1:] != ["with"]:
                waiting.append("(")
                depth += 1
            elif token in "()" or name in _STRENGTH or not token.strip(".:+-"):
                break
            else:
                output.append(label_of(token.rstrip(".:")))
                wants_operand = False
                last = found.end() - (len(token) - len(token.rstrip(".:")))
                if stop:
                    break
        elif token == ")" and depth:
            while (top := waiting.pop()) != "(":
                output.append(top)
            depth -= 1
            last = found.end()
        elif name in _STRENGTH:
            while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= _STRENGTH[name]:
                output.append(waiting.pop())
            waiting.append(name)
            wants_operand = True
        else:
            break
        at = found.end()
    while wants_operand and waiting:  # what has no right side
        wants_operand = waiting.pop() == "("
    output += [op for op in reversed(waiting) if op != "("]
    return output, last


def evaluate(postfix: list[str]) -> tuple[float, list[str], list[str]]:
    """(obligation, all labels, chosen labels), both sorted."""
    nodes: list[tuple] = []  # (obligation, label or None, operands that count)
    stack: list[int] = []
    for symbol in postfix:
        if symbol not in _STRENGTH:
            nodes.append((_KNOWN.get(symbol, UNKNOWN), symbol, ()))
        else:
            right, left = stack.pop(), stack.pop()
            a, b = nodes[left][0], nodes[right][0]
            if symbol == "with":
                relaxed = max(min(a, 0.3), round(a - 0.2, 1)) if nodes[right][1] in _EXCEPTIONS else a
                nodes.append((relaxed, None, (left, right)))
            elif symbol == "and":
                nodes.append((max(a, b), None, (left, right)))
            else:
                nodes.append((min(a, b), None, (right if b < a else left,)))
        stack.append(len(nodes) - 1)
    chosen, todo = set(), [stack[-1]]
    while todo:
        _, label, operands = nodes[todo.pop()]
        chosen |= {label} - {None}
        todo += operands
    return nodes[stack[-1]][0], sorted({label for _, label, _ in nodes} - {None}), sorted(chosen)


@lru_cache(maxsize=1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, what in [*((p, ("base", x)) for p, x in BASE.items()),
                         *((p, ("notice", x)) for p, x in NOTICES.items()), *((p, ("tag", p)) for p in TAGS)]:
        found.add_word(f" {phrase} ", (phrase.count(" ") + 1, *what))
    found.make_automaton()
    return found


def scan_text(text: bytes) -> tuple[int, list[tuple], list[tuple], float]:
    """(words, notices, expressions, score) of a UTF-8 text."""
    words = text.translate(_WORDS).split()
    if not words:
        return 0, [], [], 0.0
    line = b" " + b" ".join(words) + b" "
    notices, tags, seen, spaces = [], [], 0, 0
    for at, (size, kind, what) in _automaton().iter(line.decode("latin-1")):
        spaces += line.count(b" ", seen, at)
        seen = at
        if kind == "tag":
            tags.append((spaces - 1, what))
        else:
            notices.append((spaces - size, what, kind == "base"))
    notices.sort()
    expressions = _expressions(text, tags) if tags else []
    score = max([_KNOWN[label] for _, label, _ in notices] + [x[-1] for x in expressions], default=0.0)
    return len(words), notices, expressions, score


def _expressions(text: bytes, tags: list[tuple[int, str]]) -> list[tuple]:
    letters = np.frombuffer(text, np.uint8)
    ends = np.flatnonzero(np.diff(_INSIDE[letters].view(np.int8), append=0) == -1) + 1
    found, done = [], 0
    for word, tag in tags:
        behind = _BEHIND_TAG.match(text, ends[word])
        if behind is None or ends[word] < done:
            continue
        postfix, end = to_postfix(text, behind.end())
        plain = tag in PLAIN_TAGS
        if not postfix or plain and not all(x in _KNOWN or x in _EXCEPTIONS or x in _STRENGTH for x in postfix):
            continue
        done = end
        obligation, labels, chosen = evaluate(postfix)
        found.append((behind.end(), end, " ".join(postfix), labels, chosen, obligation))
    if found:
        points = np.concatenate([[0], np.cumsum((letters & 0xC0) != 0x80)])
        found = [(int(points[start]), int(points[end]), *rest) for start, end, *rest in found]
    return found


def scan(docs: DataFrame) -> DataFrame:
    """RESULT_SCHEMA, a row per document. Notices carry the number of their
    first word (from 0), expressions their place in code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notice = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string()), ("base", pa.bool_())]))
        expression = pa.list_(pa.struct([
            ("start", pa.int64()), ("end", pa.int64()), ("postfix", pa.string()), ("labels", pa.list_(pa.string())),
            ("chosen", pa.list_(pa.string())), ("obligation", pa.float64())]))
        for batch in batches:
            found = [scan_text(x) for x in utf8(batch, "text")]
            n_words, notices, expressions, score = zip(*found, strict=True) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()),
                 pa.array([[dict(zip(("word", "label", "base"), x, strict=True)) for x in row] for row in notices],
                          notice),
                 pa.array([[dict(zip(("start", "end", "postfix", "labels", "chosen", "obligation"), x, strict=True))
                            for x in row] for row in expressions], expression),
                 pa.array(score, pa.float64())],
                ["doc_id", "n_words", "notices", "expressions", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .transform(map_arrow, run, RESULT_SCHEMA))


def joined(labels: Column) -> Column:
    """Distinct labels in code-point order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")
