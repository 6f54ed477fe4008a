r"""Licence scan: Aho-Corasick finds phrases and identifier tags, a shunting-yard parser reads expressions.

Texts are reduced to words (A-Z lower-cased, words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+); one
automaton over all phrases runs over the words joined by single spaces, so a phrase matches
only whole words in sequence. `SPDX-License-Identifier` tags are found by the same automaton;
what stands behind a tag's colon up to the end of its line, however long, is parsed to reverse Polish form.

Only known identifiers are licences: those of `KNOWN`, with `+`, `-only` or `-or-later` behind
versions, and `LicenseRef-` names; exceptions are names with the word `exception` or those of
`EXCEPTIONS`. An expression ends before the first word that is none of these, so prose behind it adds
nothing. Its licences become labels, and `evaluate` tells whether licences of `ALLOWED` satisfy it.

Defined results: a null or empty text has no words and no labels, score 0; very long texts and
expressions are read whole; a malformed expression adds the identifiers read before the fault and
is not allowed; repeated rows give repeated rows; other columns are not looked at; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import alnum_words, arrow_map, byte_list

# Phrases whose places count as base, and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Further notices that the method knows, and their labels.
NOTICE_PHRASES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "creative commons attribution": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
    "cc0 1 0 universal": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}

# SPDX identifiers of families with versions.
VERSIONS = {
    "afl": "1.1 1.2 2.0 2.1 3.0",
    "agpl": "1.0 3.0",
    "apache": "1.0 1.1 2.0",
    "apsl": "1.0 1.1 1.2 2.0",
    "artistic": "1.0 2.0",
    "bsl": "1.0",
    "cc-by": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-nc": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-nc-nd": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-nc-sa": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-nd": "1.0 2.0 2.5 3.0 4.0",
    "cc-by-sa": "1.0 2.0 2.5 3.0 4.0",
    "cc0": "1.0",
    "cddl": "1.0 1.1",
    "cecill": "1.0 1.1 2.0 2.1",
    "cpl": "1.0",
    "ecl": "1.0 2.0",
    "epl": "1.0 2.0",
    "eupl": "1.0 1.1 1.2",
    "gfdl": "1.1 1.2 1.3",
    "gpl": "1.0 2.0 3.0",
    "lgpl": "2.0 2.1 3.0",
    "lppl": "1.0 1.1 1.2 1.3a 1.3c",
    "mpl": "1.0 1.1 2.0",
    "ncsa": "",
    "odbl": "1.0",
    "ofl": "1.0 1.1",
    "osl": "1.0 1.1 2.0 2.1 3.0",
    "php": "3.0 3.01",
    "python": "2.0 2.0.1",
    "zpl": "1.1 2.0 2.1",
}
# SPDX identifiers without a version.
PLAIN = "0bsd aal abstyles adsl aml blessing bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsd-source-code bzip2-1.0.6 cc-pddc cecill-b cecill-c curl efl-2.0 ftl hpnd ijg imagemagick intel ipa isc json latex2e libpng libtiff mit mit-0 mit-modern-variant ms-pl ms-rl mulanpsl-2.0 naist-2003 ncsa ntp openssl pddl-1.0 postgresql psf-2.0 qpl-1.0 ruby sgi-b-2.0 sleepycat sissl spencer-94 ssh-openssh tcl tu-berlin-2.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zlib zlib-acknowledgement".split()
KNOWN = frozenset(PLAIN) | {f"{family}-{version}" for family, versions in VERSIONS.items() for version in versions.split()}
# Exceptions whose names lack the word `exception`.
EXCEPTIONS = frozenset("389-exception openvpn-openssl-exception linux-syscall-note u-boot-exception-2.0 i2p-gpl-java-exception".split())
# Licences that satisfy an expression unless the caller says otherwise.
ALLOWED = frozenset("0bsd apache-2.0 bsd-2-clause bsd-3-clause bsl-1.0 cc-by-4.0 cc0-1.0 isc mit mit-0 postgresql psf-2.0 unlicense zlib".split())
# Binding strength of the operators of an expression, tightest first.
STRENGTH = {"with": 3, "and": 2, "or": 1}
TAG = "spdx license identifier"
_TOKEN = re.compile(r"[()]|[A-Za-z0-9][A-Za-z0-9.+:-]*|[^\s()]")
_LINE_END = re.compile(rb"[\r\n]")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def licence(name: str) -> bool:
    """Whether a lower-cased name is a known licence."""
    if name.startswith("licenseref-") or (name.startswith("documentref-") and ":licenseref-" in name):
        return True
    return name in KNOWN or re.sub(r"(\+|-only|-or-later)$", "", name) in KNOWN


def exception(name: str) -> bool:
    return "exception" in name.split("-") or name in EXCEPTIONS


def to_rpn(expression: str) -> tuple[list[str], bool]:
    """Shunting-yard: known identifiers and operators in reverse Polish order, and whether it was well-formed.

    It ends before the first token that can be no part of an expression. `MIT and some prose` is the expression
    `MIT`; an operator in capitals asks for an operand, so `MIT AND some prose` is malformed.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next, ok = True, True
    for token in _TOKEN.findall(expression):
        low = token.lower().rstrip(".:")
        if low in STRENGTH:
            if operand_next:
                ok = False
                break
            while stack and stack[-1].lower() != "(" and STRENGTH[stack[-1].lower()] >= STRENGTH[low]:
                out.append(stack.pop().lower())
            stack.append(token)
            operand_next = True
        elif token == "(":
            if not operand_next:
                break
            stack.append("(")
        elif token == ")":
            if operand_next or "(" not in stack:
                ok = False
                break
            while stack[-1] != "(":
                out.append(stack.pop().lower())
            stack.pop()
        elif operand_next and (exception(low) if stack and stack[-1].lower() == "with" else licence(low)):
            out.append(low)
            operand_next = False
        else:  # prose
            if operand_next and stack and stack[-1].islower():
                stack.pop()
                operand_next = False
            break
    if operand_next and stack and stack[-1] != "(":
        stack.pop()  # an operator without its right side
        ok = False
    if operand_next or "(" in stack:
        ok = False
    out.extend(op.lower() for op in reversed(stack) if op != "(")
    return out, ok and bool(out)


def evaluate(rpn: list[str], allowed: frozenset[str] | set[str]) -> bool:
    """Whether the allowed licences satisfy the expression: and needs both sides, or one, with its licence."""
    stack: list[bool] = []
    for token in rpn:
        if token in STRENGTH:
            if len(stack) < 2:
                return False
            right, left = stack.pop(), stack.pop()
            stack.append(left if token == "with" else left and right if token == "and" else left or right)
        else:
            stack.append(token in allowed)
    return stack == [True]


def identifiers(rpn: list[str]) -> set[str]:
    """Licences of an expression; exceptions behind `with` are joined to theirs."""
    stack: list[set[str]] = []
    for token in rpn:
        if token in STRENGTH and len(stack) >= 2:
            right, left = stack.pop(), stack.pop()
            stack.append({f"{a}-with-{b}" for a in left for b in right} if token == "with" else left | right)
        elif token not in STRENGTH:
            stack.append({token})
    return set().union(*stack)


@dataclass(frozen=True)
class Found:
    n_words: int
    places: list[tuple[int, str, bool]]  # start in words, label, base
    tags: list[str]


class Scanner:
    """One automaton over all phrases; built once for each Python worker."""

    def __init__(self, base: dict[str, str] | None = None, notices: dict[str, str] | None = None):
        import ahocorasick

        self._find = ahocorasick.Automaton()
        for phrases, is_base in ((notices or NOTICE_PHRASES, False), (base or BASE_PHRASES, True)):
            for phrase, label in phrases.items():
                self._find.add_word(f" {phrase} ", (len(phrase) + 2, label, is_base))
        self._find.add_word(f" {TAG} ", (len(TAG) + 2, "", False))
        self._find.make_automaton()

    def __call__(self, text: bytes | None) -> Found:
        text = text or b""
        words = alnum_words(text)
        joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
        places, tagged, at, seen = [], [], 0, 0
        for end, (size, label, is_base) in self._find.iter(joined):
            start = end - size + 1
            if start >= at:
                seen, at = seen + joined.count(" ", at, start), start
                word = seen
            else:
                word = joined.count(" ", 0, start)
            if label:
                places.append((word, label, is_base))
            else:
                tagged.append(word)
        return Found(len(words), places, expressions(text, sorted(tagged)))


def expressions(text: bytes, tagged: list[int]) -> list[str]:
    """What stands behind the colon of each tag, up to the end of the line; tagged: first words of tags, ascending."""
    out, last = [], iter(tagged)
    want = next(last, None)
    for i, m in enumerate(_WORD.finditer(text) if tagged else ()):
        if i != want + 2:
            continue
        begin = m.end()
        while text[begin : begin + 1] in (b" ", b"\t"):
            begin += 1
        if text[begin : begin + 1] == b":":
            end = _LINE_END.search(text, begin)
            out.append(text[begin + 1 : end.start() if end else len(text)].decode("utf-8", "replace"))
        if (want := next(last, None)) is None:
            break
    return out


_scanner: list[Scanner] = []
SCAN_SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions string, allowed boolean"


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    if not _scanner:
        _scanner.append(Scanner())
    cols: list[list] = [[] for _ in range(9)]
    for text in byte_list(batch.column(1)):
        f = _scanner[0](text)
        base = [w for w, _, is_base in f.places if is_base]
        base_labels = {label for _, label, is_base in f.places if is_base}
        parsed = [to_rpn(t) for t in f.tags]
        labels = base_labels.union((label for _, label, _ in f.places), *(identifiers(r) for r, _ in parsed))
        evidence = len(f.places) + 3 * sum(ok for _, ok in parsed)
        row = (f.n_words, len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), 1 - 0.25**evidence, " ; ".join(" ".join(r) for r, _ in parsed), all(ok and evaluate(r, ALLOWED) for r, ok in parsed) if parsed else None)
        for col, value in zip(cols, row, strict=True):
            col.append(value)
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.string(), pa.bool_()]
    arrays = [batch.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCAN_SCHEMA.split(", ")])


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, places of base phrases, labels, score = 1 - 0.25^evidence, expressions in reverse Polish form, and whether ALLOWED satisfies all of them (null without one)."""
    return arrow_map(docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")), _scan, SCAN_SCHEMA, "text")
