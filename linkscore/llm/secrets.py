"""Secrets by patterns and by assignment-aware lexing.

Source and configuration text is lexed into name-literal pairs (name = "x", name: x, "name": "x",
name => x, call(name="x")), sums of literals and names included. A name bound to a constant passes
the constant's literals on, so a literal is scored by every target it reaches: the sensitivity of
the target's words times the randomness of the literal. Literals that score enough become spans of
kind `literal` beside those of the patterns.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "literal")
MIN_SCORE = 0.5

_ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

#: How much a word of a name says that its value is secret.
SENSITIVE = {
    "password": 1.0,
    "passwd": 1.0,
    "passphrase": 1.0,
    "pwd": 0.9,
    "secret": 1.0,
    "token": 0.9,
    "apikey": 1.0,
    "credential": 0.9,
    "credentials": 0.9,
    "bearer": 0.9,
    "authorization": 0.8,
    "auth": 0.6,
    "private": 0.5,
    "signing": 0.5,
    "encryption": 0.5,
    "access": 0.3,
    "api": 0.3,
    "key": 0.4,
    "salt": 0.5,
}
#: A literal with one of these is a stand-in.
STAND_INS = ("changeme", "example", "placeholder", "your", "dummy", "xxxx", "****", "${", "{{", "<")

# Texts without any of these hold neither a pattern's match nor a sensitive name; RE2, in one pass. Words of
# a name that are joined may stand apart in it.
_WORTH = "(?i)" + "|".join("[_-]*".join(x) for x in SENSITIVE) + "|AKIA|[0-9a-f]{16}"

_NAME = r"[A-Za-z_][A-Za-z0-9_]*+(?:[.\-][A-Za-z0-9_]++)*+"
_PAIR = re.compile(
    rf"""(?<![A-Za-z0-9_.\-])({_NAME})["']?\]?[ \t]*+(?:=>|:=|=(?!=)|:(?!:))[ \t]*+""", re.ASCII
)
_TERM = re.compile(
    rf"""(?:(?:[Bb]earer|[Bb]asic)[ ]+)?(?:(?P<quote>["'`])(?P<text>(?:\\.|(?!(?P=quote))[^\\\n])*+)(?P=quote)"""
    rf"""|(?P<name>{_NAME})(?=[ \t]*+(?:[+,;)\]}}\n]|$))|(?P<bare>[^\s"'`,;)\]}}+]++))""",
    re.ASCII,
)
_PLUS = re.compile(r"[ \t]*+\+[ \t]*+")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of kind, end) of the patterns' matches, each kind leftmost and apart."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def sensitivity(name: str) -> float:
    """1 minus the product of what the words of the last part of a name leave open."""
    parts = [x.lower() for x in _PART.findall(name.rsplit(".", 1)[-1])]
    both = parts + [a + b for a, b in zip(parts, parts[1:])]
    return 1 - math.prod(1 - SENSITIVE.get(x, 0.0) for x in dict.fromkeys(both))


def randomness(literal: str) -> float:
    """0 for short, plain or stand-in literals, up to 1 for long ones of high entropy."""
    if len(literal) < 8 or any(x in literal.lower() for x in STAND_INS) or any(x.isspace() for x in literal):
        return 0.0
    n = len(literal)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(any(f(x) for x in literal) for f in (str.islower, str.isupper, str.isdigit, lambda x: not x.isalnum()))
    return min(1.0, entropy / 3.5) * (0.4 if kinds == 1 else 0.8 if kinds == 2 else 1.0) * min(1.0, n / 12)


def plain_literal(word: str) -> bool:
    """Whether an unquoted word can be a literal: letters and digits mixed, and no call. Others are identifiers."""
    return "(" not in word and any(x.isdigit() for x in word) and any(x.isalpha() for x in word)


def pairs(text: str) -> list[tuple[str, list[tuple[str, int, int] | str]]]:
    """Names with the terms of their value: literals as (text, start, end), names as text."""
    found, at = [], 0
    while m := _PAIR.search(text, at):
        at, terms = m.end(), []
        while t := _TERM.match(text, at):
            at = t.end()
            if t["name"] is not None:
                # An unquoted word may be a constant's name, or a literal of a configuration file.
                terms.append(t["name"])
            part = "text" if t["quote"] else "name" if t["name"] is not None else "bare"
            if t["quote"] or plain_literal(t[part]):
                terms.append((t[part], t.start(part), t.end(part)))
            plus = _PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        # A value that begins with a name may itself be a target: token: key = "a".
        if terms and isinstance(terms[0], str):
            at = m.end()
        if terms:
            found.append((m[1], terms))
    return found


def literal_spans(text: str, min_score: float = MIN_SCORE) -> list[tuple[int, int, int]]:
    """Spans of the literals that some target name makes secret, constants followed."""
    bound: dict[str, list] = {}
    lexed = pairs(text)
    for name, terms in lexed:
        bound.setdefault(name, []).extend(terms)
    # A name is as sensitive as the most sensitive target its value flows to: from the most sensitive one on,
    # each target passes its level to the names not reached before, so every name is taken once.
    reach: dict[str, float] = {}
    levels = {name: sensitivity(name) for name in bound}
    for target in sorted(levels, key=levels.get, reverse=True):
        open_names = [target]
        while open_names:
            name = open_names.pop()
            if name not in reach:
                reach[name] = levels[target]
                open_names.extend(x for x in bound[name] if isinstance(x, str) and x in bound)
    found = set()
    for name, terms in bound.items():
        for term in terms:
            if not isinstance(term, str) and term[0] not in bound and reach[name] * randomness(term[0]) >= min_score:
                found.add((term[1], 3, term[2]))
    return sorted(found)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_FIELDS = ["n_assign", "n_access", "n_hex", "n_literal", "base_spans", "spans"]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        worth = pc.fill_null(pc.match_substring_regex(texts, _WORTH), False)
        columns: dict[str, list] = {x: [0] * len(texts) for x in _FIELDS[:4]}
        columns |= {x: [""] * len(texts) for x in _FIELDS[4:]}
        for k in pc.indices_nonzero(worth).to_pylist():
            text = texts[k].as_py()
            base, more = base_spans(text), literal_spans(text)
            for number, field in enumerate(_FIELDS[:4]):
                columns[field][k] = sum(x[1] == number for x in base + more)
            columns["base_spans"][k], columns["spans"][k] = _joined(base), _joined(sorted(base + more))
        arrays = [pa.array(v, pa.int64() if x in _FIELDS[:4] else pa.string()) for x, v in columns.items()]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", *_FIELDS])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_assign, n_access, n_hex, n_literal, base_spans, spans.

    Spans are kind:start:end in code points, end exclusive, by start and then kind, joined by
    commas. Null and empty texts have none. Each text is scanned whole, in time that grows with its
    length (its different names are sorted); rows are independent of each other, so repeated ids stay
    apart. An empty table gives an empty result; other columns are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{x} {'long' if x[:2] == 'n_' else 'string'}" for x in _FIELDS)
    return rows.mapInArrow(_scan, schema).withColumnRenamed("id", id_col)
