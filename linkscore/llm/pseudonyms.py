"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Numbers and dates are found by shape and validated (check digits, issuers, octets, calendar), so that
other digits stay. A valid value is numbered within the values of its own format, the number is
permuted by a Feistel network with a keyed round function, walking on until it falls into the format
again, and written back with the same separators. The mapping is a bijection of each format: equal
values get equal pseudonyms in all documents, different ones stay different, and check digits hold.
Letters and digits of e-mail addresses are permuted the same way.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY
_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyz"


class Permutation:
    """Keyed permutations of 0..n-1 for any n."""

    def __init__(self, key: bytes):
        self.key = key

    def apply(self, value: int, n: int, format_name: str) -> int:
        """The image of value."""
        if n < 2:
            return value
        half = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << half) - 1
        tweak = f"{format_name}/{n}/".encode()
        while True:  # cycle walking: the network permutes 4 ** half >= n values
            left, right = value >> half, value & mask
            for k in range(ROUNDS):
                data = tweak + bytes([k]) + right.to_bytes(half // 8 + 1, "big")
                digest = hashlib.blake2b(data, key=self.key, digest_size=max(8, half // 8 + 1)).digest()
                left, right = right, left ^ (int.from_bytes(digest, "big") & mask)
            value = left << half | right
            if value < n:
                return value


def luhn_digit(payload: str) -> str:
    """The last digit that makes payload and digit a valid number."""
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 - k % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _refill(shape: str, chars: str) -> str:
    """shape with its letters and digits replaced in order, upper case kept."""
    new = iter(chars)
    return "".join((lambda n: n.upper() if c.isupper() else n)(next(new)) if c.isalnum() and c.isascii() else c for c in shape)


def _plain(shape: str) -> str:
    return "".join(c for c in shape if c.isalnum())


# Issuer prefixes and lengths of payment cards (fixed values).
_ISSUERS = re.compile(
    r"4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}"
    r"|6(?:011|5\d\d)\d{12}|35(?:2[89]|[3-8]\d)\d{12}"
)


def _card(text: str, permute: Permutation) -> str | None:
    digits = _plain(text)
    if not _ISSUERS.fullmatch(digits) or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    # The issuer's first digits stay, the account number is permuted, the check digit follows.
    head = 4 if digits[0] in "26" or digits[:2] == "35" else 2 if digits[0] in "35" else 1
    body = digits[head:-1]
    new = str(permute.apply(int(body), 10 ** len(body), f"card{digits[:head]}")).zfill(len(body))
    return _refill(text, digits[:head] + new + luhn_digit(digits[:head] + new))


def _iban(text: str, permute: Permutation) -> str | None:
    chars = _plain(text)
    if not 15 <= len(chars) <= 34 or int("".join(str(int(c, 36)) for c in chars[4:] + chars[:4])) % 97 != 1:
        return None
    # Digits of the account part are permuted, letters and country stay, check digits follow.
    digits = "".join(c for c in chars[4:] if c.isdigit())
    new = iter(str(permute.apply(int(digits), 10 ** len(digits), f"iban{chars[:2]}")).zfill(len(digits))) if digits else iter("")
    body = "".join(next(new) if c.isdigit() else c for c in chars[4:])
    check = 98 - int("".join(str(int(c, 36)) for c in body + chars[:2] + "00")) % 97
    return _refill(text, f"{chars[:2]}{check:02d}{body}")


def _ssn(text: str, permute: Permutation) -> str | None:
    area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    place = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    place, serial = divmod(permute.apply(place, 898 * 99 * 9999, "ssn"), 9999)
    area, group = divmod(place, 99)
    return f"{area + 1 + (area >= 665):03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


def _ip(text: str, permute: Permutation) -> str | None:
    octets = text.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in octets):
        return None
    # The numbers of digits of the octets are the format.
    bounds = [(0, 10) if len(x) == 1 else (10, 100) if len(x) == 2 else (100, 256) for x in octets]
    place, total = 0, 1
    for x, (low, high) in zip(octets, bounds):
        place, total = place * (high - low) + int(x) - low, total * (high - low)
    place = permute.apply(place, total, "ip" + "".join(str(len(x)) for x in octets))
    out = []
    for low, high in reversed(bounds):
        place, x = divmod(place, high - low)
        out.append(str(x + low))
    return ".".join(reversed(out))


def _date(text: str, permute: Permutation) -> str | None:
    parts, mark = re.split(r"[-/.]", text), re.search(r"[-/.]", text)[0]
    # Order of year, month and day. With slashes the month comes first where that gives a date.
    orders = [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 0, 1), (2, 1, 0)] if mark == "/" else [(2, 1, 0)]
    for order in orders:
        try:
            place = datetime.date(*(int(parts[k]) for k in order)).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if 0 <= place < _DAYS:
            break
    else:
        return None
    day_first = mark == "/" and order == (2, 1, 0)  # its days are over 12, or the month would be first
    while True:
        place = permute.apply(place, _DAYS, f"date{order}{mark}")
        day = datetime.date.fromordinal(place + _FIRST_DAY)
        if not day_first or day.day > 12:
            break
    out = [""] * 3
    for k, number, width in zip(order, (day.year, day.month, day.day), (4, 2, 2)):
        out[k] = f"{number:0{width}d}"
    return mark.join(out)


def _phone(text: str, permute: Permutation) -> str | None:
    digits = _plain(text)
    if not 8 <= len(digits) <= 15 or len(set(digits)) < 2:
        return None
    head = len(re.match(r"\+?(\d{1,3})(?=\D)|", text)[1] or "") if text[0] == "+" else 0
    body = digits[head:]
    return _refill(text, digits[:head] + str(permute.apply(int(body), 10 ** len(body), f"phone{head}")).zfill(len(body)))


def _email(text: str, permute: Permutation) -> str | None:
    local, domain = text.rsplit("@", 1)
    labels = domain.split(".")
    hidden = local + "." + ".".join(labels[:-2]) if len(labels) > 2 else local
    chars = _plain(hidden).lower()
    if not chars:
        return None
    place = permute.apply(int(chars, 36), 36 ** len(chars), "email")
    new = ""
    for _ in chars:
        place, x = divmod(place, 36)
        new = _ALPHABET[x] + new
    hidden = _refill(hidden, new)
    return f"{hidden[: len(local)]}@{'.'.join([*hidden[len(local) + 1 :].split('.'), *labels[-2:]] if len(labels) > 2 else labels)}"


_DAY, _MONTH = r"(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|1[0-2])"
#: By kind: the shape, and what validates a match and makes its pseudonym. Earlier kinds come first.
_SHAPES: dict[str, tuple[str, Callable[[str, Permutation], str | None]]] = {
    "email": (
        r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@"
        r"(?:[A-Za-z0-9](?:[A-Za-z0-9\-]{0,61}[A-Za-z0-9])?\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
        _email,
    ),
    "iban": (r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    "card": (r"\d(?:[ \-]?\d){12,18}(?!\d)", _card),
    "ssn": (r"\d{3}([\- ])\d{2}\1\d{4}(?!\d)", _ssn),
    "ip": (r"\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)", _ip),
    "date": (
        rf"(?:\d{{4}}([\-/.]){_MONTH}\1{_DAY}|{_DAY}([\-/.]){_DAY}\2\d{{4}})(?![\-/.]?\d)",
        _date,
    ),
    "phone": (
        r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .\-]?\d{2,4}){1,4}(?!\d)"
        r"|\(\d{3}\)[ ]?\d{3}[ \-]\d{4}(?!\d)|\d{3}[\-.]\d{3}[\-.]\d{4}(?!\d)",
        _phone,
    ),
}
KINDS = tuple(_SHAPES)
# A match does not begin within a word, a number or an address.
_FIND = {kind: re.compile(rf"(?<![A-Za-z0-9_.@+\-])(?:{shape})", re.ASCII) for kind, (shape, _) in _SHAPES.items()}
# Written in groups, so a match may take in digits that follow a value, or follow some itself.
_GROUPED = ("iban", "card", "phone")
_GROUP_END = re.compile(r"[ \-]")
# Texts without any of these hold nothing of a known shape; RE2, in one pass.
_WORTH = r"@|[0-9][0-9 .()/+\-]{5,}[0-9]|[A-Z]{2}[0-9]{2}[ ]?[A-Z0-9]{4}"


def _valid(kind: str, text: str, start: int, end: int, permute: Permutation) -> tuple[int, str] | None:
    """End and pseudonym of the longest valid value from start on, of those that end at a group's end."""
    while end > start:
        new = _SHAPES[kind][1](text[start:end], permute)
        if new is not None:
            return end, new
        end = max(text.rfind(" ", start, end), text.rfind("-", start, end)) if kind in _GROUPED else start
    return None


def find(text: str, permute: Permutation) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the valid values, apart from each other, by start."""
    found: list[tuple[int, int, str, str]] = []
    for kind in KINDS:
        at = 0
        while m := _FIND[kind].search(text, at):
            at, valid = m.end(), None
            if not any(m.start() < b and a < m.end() for a, b, _, _ in _near(found, m.start())):
                valid = _valid(kind, text, m.start(), m.end(), permute)
            if valid:
                at = valid[0]
                bisect.insort(found, (m.start(), at, kind, valid[1]))
            elif kind in _GROUPED and (group := _GROUP_END.search(text, m.start() + 1, m.end())):
                at = group.end()  # a value may begin with the match's second group
    return found


def _near(found: list[tuple[int, int, str, str]], start: int) -> list[tuple[int, int, str, str]]:
    """The span before a place and the one after it, of spans that lie apart."""
    k = bisect.bisect(found, (start,))
    return found[max(0, k - 1) : k + 1]


def replaced(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in found:
        out += text[at:start], new
        at = end
    return "".join([*out, text[at:]])


def _scan(key: bytes) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Permutation(key)
        for batch in batches:
            texts = batch.column(1)
            counts = {kind: [0] * len(texts) for kind in KINDS}
            spans, rows, new = [""] * len(texts), [], []
            worth = pc.fill_null(pc.match_substring_regex(texts, _WORTH), False)
            for k in pc.indices_nonzero(worth).to_pylist():
                text = texts[k].as_py()
                if found := find(text, permute):
                    rows.append(k)
                    new.append(replaced(text, found))
                    spans[k] = ",".join(f"{kind}:{a}:{b}" for a, b, kind, _ in found)
                    for _, _, kind, _ in found:
                        counts[kind][k] += 1
            if rows:
                changed = np.zeros(len(texts), bool)
                changed[rows] = True
                texts = pc.replace_with_mask(texts, pa.array(changed), pa.array(new, texts.type))
            columns = [batch.column(0), texts, *(pa.array(x, pa.int64()) for x in counts.values()), pa.array(spans)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "text", *(f"n_{x}" for x in KINDS), "spans"])

    return run


def pseudonymize(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, text with pseudonyms, n_<kind> for each kind, spans.

    spans are kind:start:end in code points of the input text, joined by commas. The same key gives
    the same pseudonyms in every run. Null texts stay null, with no spans; texts without a valid value
    stay as they are. Texts are scanned whole. Rows are independent, so repeated ids stay apart. An
    empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    counts = ", ".join(f"n_{x} long" for x in KINDS)
    out = rows.mapInArrow(_scan(key), f"id {kind}, text string, {counts}, spans string")
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), *(f"n_{x}" for x in KINDS), "spans")
