"""License scan: one Aho-Corasick pass for phrases and tags, a shunting-yard parser for expressions.

The automaton runs over the text's words joined by single blanks. It finds notice phrases where
their words stand consecutively, and the word form of the identifier tag. The expression behind a
tag is read from the raw line, up to where its comment ends, the next tag stands or prose or code
follows, brought to postfix order by the shunting-yard algorithm, and evaluated: `or` leaves the choice, `and` binds to both sides, `with` softens the left side.
"""

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame

from dockflow.llm.wordgrid import ALNUM

BASE_PHRASES = {"mit license": "mit", "apache license": "apache",
                "general public license": "gpl"}  # fixed values

PHRASES = {
    "lesser general public license": "lgpl", "affero general public license": "agpl",
    "mozilla public license": "mpl", "bsd license": "bsd", "isc license": "isc",
    "eclipse public license": "epl", "boost software license": "bsl",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under cc by": "cc-by", "licensed under cc by nc": "cc-by-nc", "licensed under cc by sa": "cc-by-sa",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0",
    "released into the public domain": "public-domain", "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
TAG_LINE = re.compile(rb"spdx-license-identifier:[ \t]*(.*?)(?=spdx-license-identifier:|[\r\n]|\Z)",
                      re.IGNORECASE | re.DOTALL)
COMMENT_END = re.compile(r"\*/|--+!?>|\*\)|[#}%?]\}|[%?]>|\]\]|\"{3}|'{3}")

# How much a licence asks: 0 nothing to 4 no use. `or` takes the least, `and` the most.
DUTY = {"cc0": 0, "unlicense": 0, "0bsd": 0, "public-domain": 0, "mit": 1, "bsd": 1, "isc": 1, "apache": 1,
        "zlib": 1, "bsl": 1, "cc-by": 1, "mpl": 2, "lgpl": 2, "epl": 2, "cc-by-sa": 2, "gpl": 3, "agpl": 3,
        "cc-by-nc": 4, "proprietary": 4}
UNKNOWN_DUTY = 3
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

# Identifiers that neither have a digit nor name a family of DUTY; before prose, other words are no names.
PLAIN = frozenset((
    "aal abstyles aml ampas antlr-pd beerware blessing borceux caldera cube curl diffmark doc dotseqn dsdp "
    "dvipdfm ecos egenix entessa eurosym fair fsfap fsful fsfullr ftl giftware glide glulxe gnuplot gsoap "
    "haskellreport hpnd htmltidy ibm-pibs icu ijg imagemagick info-zip intel ipa jasper json latex2e leptonica "
    "libpng libtiff linux-openib lpl makeindex mitnfa motosoto mtll multics mup naumen ncsa net-snmp netcdf "
    "newsletr ngpl nlpl nokia noweb nrl ntp oclc ogtsl oml openssl plexus postgresql psfrag psutils qhull rdisc "
    "rscpl ruby sax-pd scea sendmail sgi-b sissl sleepycat smlnj snia spencer ssh-openssh swl tcl tcp-wrappers "
    "tmate tosl ucl upl vim w3c watcom wtfpl xerox xinetd xnet xpp xskat zed").split())

_TOKEN = re.compile(r"[()]|[A-Za-z0-9](?:[A-Za-z0-9.+:-]*[A-Za-z0-9+])?")
_lower = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_to_blank = bytes(b if ALNUM[b] else 0x20 for b in bytes(range(256)).translate(_lower))


def family(identifier: str) -> str:
    """The label of an identifier: its name without version and suffix, `Apache-2.0` -> `apache`."""
    name = identifier.lower().rstrip("+")
    name = re.sub(r"-(only|or-later)$", "", name)
    while (shorter := re.sub(r"-(v?[0-9][0-9.]*[a-z]?|clause|international|simplified|new)$", "", name)) != name:
        name = shorter
    return name


def postfix(expression: str) -> list[str] | None:
    """Identifiers and operators of an expression in postfix order; None if it is malformed."""
    output, stack, want_name = [], [], True
    for token in _TOKEN.findall(expression):
        word = token.lower()
        if word in PRECEDENCE:
            if want_name:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[word]:
                output.append(stack.pop())
            stack.append(word)
            want_name = True
        elif token == "(":
            if not want_name:
                return None
            stack.append(token)
        elif token == ")":
            if want_name:
                return None
            while stack and stack[-1] != "(":
                output.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        else:
            if not want_name:
                return None
            output.append(token)
            want_name = False
    while stack:
        if stack[-1] == "(":
            return None
        output.append(stack.pop())
    return None if want_name else output


def evaluate(expression: str) -> tuple[set[str], int] | None:
    """Labels an expression names and its duty; None if it is malformed."""
    order = postfix(expression)
    if order is None:
        return None
    values: list[tuple[set[str], int]] = []
    for token in order:
        if token not in PRECEDENCE:
            label = family(token)
            values.append(({label}, DUTY.get(label, UNKNOWN_DUTY)))
            continue
        (right, b), (left, a) = values.pop(), values.pop()
        if token == "with":
            values.append((left, max(a - 1, 1) if a else 0))  # an exception takes a duty away
        else:
            values.append((left | right, min(a, b) if token == "or" else max(a, b)))
    return values[0]


def known(word: str) -> bool:
    """Whether a word is an operator or looks like an identifier, and not like prose or code."""
    name = word.lower()
    return (name in PRECEDENCE or name in PLAIN or family(name) in DUTY or any(c.isdigit() for c in name)
            or name.startswith(("licenseref-", "documentref-")) or name.endswith(("-exception", "-note")))


def expression_of(rest: str) -> str:
    """The expression at the front of what follows a tag.

    It ends with its comment. A token that cannot continue it (a name or `(` after a name or `)`, a `)`
    that closes nothing) begins prose or code: then it is the longest well-formed part before that token
    whose names are known. Where there is no such part, and where nothing but the
    end follows, all of it is taken, so a dangling operator stays malformed.
    """
    rest = COMMENT_END.split(rest, maxsplit=1)[0]
    best, depth, want_name, recognized = 0, 0, True, True
    for match in _TOKEN.finditer(rest):
        token = match[0]
        if token.lower() in PRECEDENCE:
            ends, want_name = want_name, True
        elif token == "(":
            ends, depth = not want_name, depth + 1
        elif token == ")":
            ends, depth = want_name or not depth, depth - 1
        else:
            ends, want_name = not want_name, False
            recognized = recognized and known(token)
        if ends:
            rest = rest[:best] if best else rest
            break
        if recognized and not want_name and not depth:
            best = match.end()
    return rest.strip().rstrip("*/#->").strip()


def automaton() -> ahocorasick.Automaton:
    """All phrases and the tag, each between blanks."""
    found = ahocorasick.Automaton()
    for phrase in (*BASE_PHRASES, *PHRASES, TAG):
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan_text(raw: bytes, machine: ahocorasick.Automaton) -> tuple:
    """(n_words, spans, expressions) of one text; spans are (phrase, label, first word)."""
    words = raw.translate(_to_blank).split()
    line = f" {b' '.join(words).decode('utf-8', 'replace')} "
    spans, tagged, seen, blanks = [], False, 0, 0
    for end, phrase in machine.iter(line):
        blanks, seen = blanks + line.count(" ", seen, end), end  # a blank stands before each word so far
        if phrase == TAG:
            tagged = True
        else:
            label = BASE_PHRASES.get(phrase) or PHRASES[phrase]
            spans.append((phrase, label, blanks - phrase.count(" ") - 1))
    expressions = []
    if tagged:
        for match in TAG_LINE.finditer(raw):
            expressions.append(expression_of(match[1].decode("utf-8", "replace")))
    return len(words), spans, expressions


SCHEMA = ("doc_id {id}, n_words long, spans array<struct<phrase: string, label: string, word: bigint>>, "
          "expressions array<struct<text: string, valid: boolean, labels: array<string>, duty: int>>, "
          "n_base long, first_word long, last_word long, base_labels string, labels string, duty int, score double")


def summary(n_words: int, spans: list, expressions: list) -> tuple:
    """The columns of SCHEMA behind doc_id.

    The score is the evidence for a licence: 1 for a well-formed tag, 0.9 for a base phrase, 0.7 for
    another notice phrase, 0.4 for a tag whose expression is malformed, else 0.
    """
    base = [s for s in spans if s[0] in BASE_PHRASES]
    base_labels = sorted({s[1] for s in base})
    labels, duties, score, parsed = {s[1] for s in spans}, [DUTY[s[1]] for s in spans], 0.0, []
    if spans:
        score = 0.9 if base else 0.7
    for text in expressions:
        value = evaluate(text)
        if value:
            labels |= value[0]
            duties.append(value[1])
        score = max(score, 1.0 if value else 0.4)
        parsed.append((text, value is not None, sorted(value[0]) if value else [], value[1] if value else None))
    return (n_words, spans, parsed, len(base), min((s[2] for s in base), default=None),
            max((s[2] for s in base), default=None), ",".join(base_labels), ",".join(sorted(labels)),
            max(duties, default=None), score)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licence findings of every whole text (see SCHEMA).

    A null or empty text has no words, no labels ('') and score 0. Places are counted in
    words from 0; a phrase inside a longer one counts for both. Repeated rows are scanned each, an empty
    table gives no rows, other columns of docs are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = automaton()
        for frame in frames:
            rows = [summary(*scan_text(t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"", machine))
                    for t in frame["text"]]
            out = pd.DataFrame(rows, columns=_columns(), dtype=object)
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    narrow = docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text")
    return narrow.mapInPandas(work, SCHEMA.format(id=kind))


def _columns() -> list[str]:
    return ["n_words", "spans", "expressions", "n_base", "first_word", "last_word", "base_labels", "labels",
            "duty", "score"]
