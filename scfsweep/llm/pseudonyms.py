"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers and dates that pass their own checks (Luhn, mod 97, octets, calendar, numbering plan) and other
identifiers of a fixed shape are replaced by values of the same shape that pass the same checks. Each kind
permutes its own domain under the key: equal values get equal pseudonyms in every document, different ones
stay different, and the key's holder can undo it. Anything that only looks like such a value is left alone.

A domain of ``size`` values is cut into a grid of two coordinates near its square root; Feistel rounds move
one by a keyed hash of the other, and results outside the domain, or invalid ones, are permuted again
(cycle walking), which keeps the mapping one to one. Where a value's look decides its domain (lower-case hex
or not, base 32 or not, inside ``DATES`` or not), images keep that look, so no image falls into another
domain and every pseudonym can be undone. Dates are permuted by day and so stay linked across formats
(month-first ones among themselves); those of other years stay outside ``DATES``. Long secrets are permuted
in pieces of ``PIECE`` characters, so equal pieces at equal places show. IPv6 addresses keep their spelling
and are linked by it. The key is an argument, or the session's ``KEY_SETTING``.

Null texts stay null, empty ones empty; repeated rows are treated alike. A value inside a longer word or
number is not one.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import math
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from scfsweep.llm.common import extended, table
from scfsweep.llm.words import text_chunks

#: For trial runs only; a corpus needs a secret of its own.
TRIAL_KEY = b"a key for trial runs only"
KEY_SETTING = "scfsweep.pseudonym.key"
PIECE = 64
ROUNDS = 8
DATES = (datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal())


class Permutation:
    """A keyed permutation of range(size) for any size; ``kind`` makes those of other kinds independent."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.a = next(x for x in range(math.isqrt(size), math.isqrt(size) + 2) if x * x >= size)
        self.b = -(-size // self.a)
        self.state = hashlib.blake2b(f"{kind}:{size}".encode(), key=hashlib.sha256(key).digest(), digest_size=(self.a.bit_length() + 7) // 8 + 8)

    def _hash(self, k: int, value: int) -> int:
        state = self.state.copy()
        state.update(b"%d:%d" % (k, value))
        return int.from_bytes(state.digest(), "big")

    def _once(self, value: int) -> int:
        left, right = divmod(value, self.b)
        for k in range(0, ROUNDS, 2):
            left = (left + self._hash(k, right)) % self.a
            right = (right + self._hash(k + 1, left)) % self.b
        return left * self.b + right

    def _undo_once(self, value: int) -> int:
        left, right = divmod(value, self.b)
        for k in range(ROUNDS - 2, -1, -2):
            right = (right - self._hash(k + 1, left)) % self.b
            left = (left - self._hash(k, right)) % self.a
        return left * self.b + right

    def walk(self, value: int, valid: Callable[[int], bool] = lambda v: True, undo: bool = False) -> int:
        """The next valid value on the cycle of a valid one; it comes back to itself at worst."""
        step = self._undo_once if undo else self._once
        value = step(value)
        while value >= self.size or not valid(value):
            value = step(value)
        return value


def luhn_digit(payload: str) -> str:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (1 if k % 2 else 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


_HEX = "0123456789abcdef"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE36 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters and digits are replaced by ones of their own class
_CLASSES = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "".join(c for c in map(chr, range(0xC0, 0x100)) if c.islower()),
    "".join(c for c in map(chr, range(0xC0, 0x100)) if c.isupper()),
)
_CLASS_OF = {c: letters for letters in _CLASSES for c in letters}


def _all_in(letters: str) -> Callable[[str], bool]:
    return lambda text: all(c in letters for c in text)


def _fill(shape: str, digits: str) -> str:
    """shape with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


class Pseudonyms:
    """Finds values in a text and replaces them; ``undo`` turns pseudonyms back."""

    def __init__(self, key: bytes, undo: bool = False):
        self.key, self.undo = key, undo
        self.made: dict[tuple[str, int], Permutation] = {}
        self.known: dict[tuple[str, str], str | None] = {}

    def _permute(self, kind: str, size: int, value: int, valid=lambda v: True) -> int:
        if (kind, size) not in self.made:
            self.made[kind, size] = Permutation(self.key, kind, size)
        return self.made[kind, size].walk(value, valid, self.undo)

    def _number(self, kind: str, digits: str, valid: Callable[[str], bool]) -> str | None:
        n = len(digits)
        if not valid(digits):
            return None
        return f"{self._permute(kind, 10**n, int(digits), lambda v: valid(f'{v:0{n}d}')):0{n}d}"

    def _letters(self, kind: str, text: str, valid: Callable[[str], bool] | None = None) -> str:
        """Letters and digits permuted, each within its own class, everything else kept."""
        parts = [text[k : k + PIECE] for k in range(0, len(text), PIECE)]
        return "".join(self._mixed(f"{kind}:{k}" if k else kind, part, [_CLASS_OF.get(c) for c in part], valid) for k, part in enumerate(parts))

    def _mixed(self, kind: str, text: str, classes: list[str | None], valid: Callable[[str], bool] | None = None) -> str:
        """text, which is valid, with its characters permuted within the given classes; the image is valid, too."""
        value, size = 0, 1
        for c, letters in zip(text, classes):
            if letters:
                value, size = value * len(letters) + letters.index(c), size * len(letters)
        if size == 1:
            return text
        shape = "".join("." if x is None else str(len(x) % 10) for x in classes)

        def spelled(value: int) -> str:
            out = []
            for c, letters in zip(reversed(text), reversed(classes)):
                if letters:
                    value, k = divmod(value, len(letters))
                    c = letters[k]
                out.append(c)
            return "".join(reversed(out))

        # what is kept is part of the domain where it decides what is valid
        kept = "".join("." if x else c for c, x in zip(text, classes)) if valid else ""
        return spelled(self._permute(f"{kind}:{shape}:{kept}" if kept.strip(".") else f"{kind}:{shape}", size, value, (lambda v: valid(spelled(v))) if valid else lambda v: True))

    def email(self, m: re.Match) -> str:
        return self._letters(f"email:{m['domain'].lower()}", m["local"]) + "@" + m["domain"]

    def iban(self, m: re.Match) -> str | None:
        text = m.group()
        compact = text.replace(" ", "")
        check = lambda body: f"{98 - int(''.join(str(int(c, 36)) for c in body + compact[:2] + '00')) % 97:02d}"
        if not 15 <= len(compact) <= 34 or check(compact[4:]) != compact[2:4]:
            return None
        body = self._letters(f"iban:{compact[:2]}", compact[4:])
        it = iter(compact[:2] + check(body) + body)
        return "".join(c if c == " " else next(it) for c in text)

    def ip(self, m: re.Match) -> str | None:
        parts = [int(x) for x in m.group().split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m.group().split(".")):
            return None
        usual = lambda v: 0 < v >> 24 < 224 and v >> 24 != 127
        value = int.from_bytes(bytes(parts), "big")
        new = self._permute("ip", 1 << 32, value, usual if usual(value) else lambda v: not usual(v))
        return ".".join(map(str, new.to_bytes(4, "big")))

    def card(self, m: re.Match) -> str | None:
        digits = _digits(m.group())
        if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or digits[0] == "0":
            return None
        payload = self._number("card", digits[:-1], lambda d: d[0] != "0")
        return _fill(m.group(), payload + luhn_digit(payload))

    def ssn(self, m: re.Match) -> str | None:
        valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        new = self._number("ssn", _digits(m.group()), valid)
        return new and _fill(m.group(), new)

    def phone(self, m: re.Match) -> str | None:
        new = self._number("phone:1", _digits(m["national"]), lambda d: d[0] > "1" and d[3] > "1")
        return new and (m["country"] or "") + _fill(m["national"], new)

    def phone_abroad(self, m: re.Match) -> str | None:
        digits = _digits(m["number"])
        if not 6 <= len(digits) <= 12:
            return None
        new = self._number(f"phone:{m['code']}", digits, lambda d: (d[0] == "0") == (digits[0] == "0"))
        return m["code"] + _fill(m["number"], new)

    def date(self, m: re.Match) -> str | None:
        text = m.group()
        a, b, c = (int(x) for x in re.split(r"[-/.]", text))
        y, mo, d, order = (a, b, c, "ymd") if text[4] in "-/." else (c, b, a, "dmy") if b <= 12 else (c, a, b, "mdy")
        try:
            day = datetime.date(y, mo, d).toordinal()
        except ValueError:
            return None
        usual = lambda day: DATES[0] <= day < DATES[1]

        def other(day: int) -> str:
            at = datetime.date.fromordinal(day)
            parts = {"y": f"{at.year:04d}", "m": f"{at.month:02d}", "d": f"{at.day:02d}"}
            sign = re.search(r"[-/.]", text).group()
            return sign.join(parts[k] for k in order)

        # month first is only read where the day is above 12, so it stays above
        late = lambda day: order != "mdy" or datetime.date.fromordinal(day).day > 12
        kind = "date:mdy" if order == "mdy" else "date"
        if usual(day):
            return other(DATES[0] + self._permute(kind, DATES[1] - DATES[0], day - DATES[0], lambda v: late(v + DATES[0])))
        return other(1 + self._permute(f"{kind}:far", datetime.date.max.toordinal(), day - 1, lambda v: not usual(v + 1) and late(v + 1)))

    def key_id(self, m: re.Match) -> str:
        narrow = _all_in(_BASE32)
        if narrow(m["rest"]):
            return m["prefix"] + self._mixed("key", m["rest"], [_BASE32] * len(m["rest"]))
        return m["prefix"] + self._mixed("key:wide", m["rest"], [_BASE36] * len(m["rest"]), lambda t: not narrow(t))

    def secret(self, m: re.Match) -> str:
        """Pieces of lower-case hex stay hex, and others don't become it."""
        hexed = _all_in(_HEX)
        new = []
        for k in range(0, len(m["value"]), PIECE):
            part = m["value"][k : k + PIECE]
            new.append(self._mixed("hex", part, [_HEX] * len(part)) if hexed(part) else self._letters("secret", part, lambda t: not hexed(t)))
        return m["before"] + "".join(new)

    def bearer(self, m: re.Match) -> str:
        return m["before"] + self._letters("bearer", m["value"])

    def ipv6(self, m: re.Match) -> str | None:
        text = m.group()
        try:
            ipaddress.IPv6Address(text)
        except ValueError:
            return None
        classes = ["0123456789" if c.isdigit() else "abcdef" if c in "abcdef" else "ABCDEF" if c in "ABCDEF" else None for c in text]
        return self._mixed("ipv6", text, classes, lambda _: True)

    def _new(self, kind: str, m: re.Match) -> str | None:
        known = (kind, m.group())
        if known not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[known] = getattr(self, kind)(m)
        return self.known[known]

    def __call__(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with pseudonyms, and how many of each kind."""
        out, at, copied, counts = [], 0, 0, {}
        while m := ANY.search(text, at):
            for kind, pattern in PATTERNS.items():
                own = pattern.match(text, m.start())
                new = own and self._new(kind, own)
                if new:
                    out += [text[copied : own.start()], new]
                    copied = at = own.end()
                    counts[kind] = counts.get(kind, 0) + 1
                    break
            else:
                at = m.start() + 1
        return ("".join(out) + text[copied:] if out else text), counts


_PATTERNS = {
    "email": r"(?<![\w.+\x80-\U0010FFFF-])(?P<local>[A-Za-z0-9\x80-\U0010FFFF][\w.+\x80-\U0010FFFF-]*+)@(?P<domain>[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24})(?![\w-])",
    "secret": r"(?<!\w)(?P<before>(?i:token|secret|password|passwd|pwd|api_?key)\s{0,3}[=:]\s{0,3}[\"']?)(?P<value>(?:[A-Za-z0-9+/_~-]|[!#$%&*=.](?=[A-Za-z0-9+/_~-])){8,}+)(?![A-Za-z0-9+/_-])",
    "bearer": r"(?<!\w)(?P<before>(?i:bearer)\s{1,3})(?P<value>(?=[A-Za-z+/_.~-]*\d)(?:[A-Za-z0-9+/_~-]|\.(?=[A-Za-z0-9+/_~-])){8,}+)",
    "key_id": r"(?<!\w)(?P<prefix>AKIA|ASIA)(?P<rest>[0-9A-Z]{16})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "ipv6": r"(?<![\w:.])(?=[A-Fa-f:]*\d)(?=[^:\s]*:[^:\s]*:)[0-9A-Fa-f:]{3,39}(?![\w:.])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w./-])(?:\d{4}([-/.])\d{2}\1\d{2}|\d{2}([-/.])\d{2}\2\d{4})(?!(?!T\d)[\w/-]|\.\d)",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "phone": r"(?<![\w-])(?P<country>\+?1[ .-]?)?(?P<national>\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}|\d{3}(?P<sign>[ .-])\d{3}(?P=sign)\d{4}|(?<=\+1)\d{10})(?![\w-])",
    "phone_abroad": r"(?<![\w-])(?P<code>\+(?!1[ (.-])\d{1,3})(?P<number>(?:[ .-]?\(?\d{2,5}\)?){2,5})(?![\w-])",
}
PATTERNS = {kind: re.compile(p, re.ASCII) for kind, p in _PATTERNS.items()}
KINDS = tuple(PATTERNS)
#: Where any of them may begin: a digit or plus, a key's or a secret's first letters, hex before a colon, or an e-mail's local part
ANY = re.compile(r"(?<![0-9A-Za-z_])(?:[+(]?\d|(?i:token|secret|passw|pwd|api_?key|bearer)|AKIA|ASIA|[A-Z]{2}\d{2}|[A-Fa-f][0-9A-Fa-f]{0,3}:|::|(?<![.+\x80-\U0010FFFF-])[A-Za-z0-9\x80-\U0010FFFF][\w.+\x80-\U0010FFFF-]*+@)", re.ASCII)

_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"0123456789@=:")] = True


def pseudonymised(docs: DataFrame, key: bytes = TRIAL_KEY, undo: bool = False) -> DataFrame:
    """docs(doc_id, text) -> doc_id, text with pseudonyms, n_replaced, and the number of each kind as kinds."""

    def make():
        names = Pseudonyms(key, undo)

        def compute(batch):
            column = batch.column("text")
            if pa.types.is_null(column.type):
                column = column.cast(pa.string())
            changed, new, counts = np.zeros(len(column), bool), [], [{}] * len(column)
            for texts in text_chunks(column):
                sums = np.append(0, np.cumsum(_SIGNS[texts.data]))
                for row in np.flatnonzero(np.diff(sums[texts.offsets])).tolist():
                    text, found = names(texts.data[texts.offsets[row] : texts.offsets[row + 1]].tobytes().decode())
                    if found:
                        row += texts.first
                        changed[row], counts[row] = True, found
                        new.append(text)
            text = pc.replace_with_mask(column, pa.array(changed), pa.array(new, column.type))
            total = pa.array([sum(c.values()) for c in counts], pa.int64())
            return [text, total, pa.array([[(k, c[k]) for k in KINDS if k in c] for c in counts], pa.map_(pa.string(), pa.int64()))]

        return compute

    kinds = T.MapType(T.StringType(), T.LongType())
    rows = extended(docs.select("doc_id", "text"), [("new_text", T.StringType()), ("n_replaced", T.LongType()), ("kinds", kinds)], make)
    return rows.selectExpr("doc_id", "new_text as text", "n_replaced", "kinds")


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for personal data and secrets, under the session's key."""
    key = spark.conf.get(KEY_SETTING, None)
    return pseudonymised(table(spark, sf_dir, "documents"), key.encode() if key else TRIAL_KEY)
