"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A candidate is validated (check digits, calendar, octets), its value becomes an integer of a
domain of exactly the valid values, a keyed Feistel network permutes that domain, and the new
value is written in the old format. Equal values of a kind therefore get equal pseudonyms in
every document and notation, without a lookup table or a shuffle; the key's holder can invert
them. One ``mapInArrow`` pass over the scan.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import slices

KINDS = ("email", "card", "iban", "phone", "ssn", "ip", "date")
ROUNDS = 8
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()

_PATTERN = re.compile(
    r"""(?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"""
    r"""|(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w))"""
    r"""|(?P<phone>\+(?:1[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])|(?!1[^0-9])[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[\x20.-]?[0-9]{2,4}){1,4}(?![0-9])))"""
    r"""|(?P<national>(?<![\w.+-])(?:1[\x20.-])?(?:\([2-9][0-9]{2}\)[\x20.-]?[2-9][0-9]{2}[\x20.-][0-9]{4}|[2-9][0-9]{2}-[2-9][0-9]{2}-[0-9]{4}|[2-9][0-9]{2}\.[2-9][0-9]{2}\.[0-9]{4})(?!\w|[.-][0-9]))"""
    r"""|(?P<date>(?<![\w.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?!(?![Tt][0-9]{2}|Z(?!\w))[\w-]|[./][0-9]))"""
    r"""|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"""
    r"""|(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9]))"""
    r"""|(?P<card>(?<![\w.])[0-9](?:[\x20-]?[0-9]){12,18}(?![\w]))""",
    re.ASCII,
)
_NEEDS = re.compile(r"[0-9@]")
# Length of each country's IBANs.
IBAN_LENGTHS = {
    "NO": 15, "BE": 16, "DK": 18, "FO": 18, "FI": 18, "GL": 18, "NL": 18, "SD": 18, "MK": 19, "SI": 19,
    "AT": 20, "BA": 20, "EE": 20, "KZ": 20, "XK": 20, "LT": 20, "LU": 20, "HR": 21, "LV": 21, "LI": 21, "CH": 21,
    "BH": 22, "BG": 22, "CR": 22, "GE": 22, "DE": 22, "IE": 22, "ME": 22, "RS": 22, "GB": 22, "VA": 22,
    "GI": 23, "IL": 23, "IQ": 23, "TL": 23, "AE": 23, "AD": 24, "CZ": 24, "MD": 24, "PK": 24, "RO": 24, "SA": 24, "SK": 24, "ES": 24, "SE": 24, "TN": 24, "VG": 24,
    "LY": 25, "PT": 25, "ST": 25, "IS": 26, "TR": 26, "FR": 27, "GR": 27, "IT": 27, "MR": 27, "MC": 27, "SM": 27,
    "AL": 28, "AZ": 28, "BY": 28, "CY": 28, "DO": 28, "GT": 28, "HU": 28, "LB": 28, "PL": 28, "BR": 29, "EG": 29, "PS": 29, "QA": 29, "UA": 29, "JO": 30, "KW": 30, "MU": 30, "MT": 31, "SC": 31, "LC": 32,
}


class Feistel:
    """A keyed permutation of range(size): alternating modular rounds, walking on until the value is in range."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size, self.tweak, self.key = size, tweak.encode(), key
        self.a = math.isqrt(size - 1) + 1  # halves of nearly equal size
        self.b = -(-size // self.a)
        self.blocks = -(-(self.a.bit_length() + 64) // 256)

    def _round(self, i: int, half: int) -> int:
        """A keyed number of 64 bits more than a half has, so that its remainder is even to 2^-64; 32 bytes a block."""
        # long numbers are written by sixteens: their decimal form takes quadratic time
        word = (b"%s|%d|%d|%d" if self.blocks == 1 else b"%s|%x|%d|%x") % (self.tweak, self.size, i, half)
        blocks = [hashlib.blake2b(word, key=self.key, digest_size=32).digest()]
        if self.blocks > 1:  # the first block stands for the word, whatever its length
            blocks += [hashlib.blake2b(blocks[0] + k.to_bytes(8, "big"), key=self.key, digest_size=32).digest() for k in range(1, self.blocks)]
        return int.from_bytes(b"".join(blocks), "big")

    def _once(self, x: int, back: bool) -> int:
        left, right = x % self.a, x // self.a
        sign = -1 if back else 1
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if i % 2:
                right = (right + sign * self._round(i, left)) % self.b
            else:
                left = (left + sign * self._round(i, right)) % self.a
        return left + self.a * right

    def permute(self, x: int, back: bool = False) -> int:
        x = self._once(x, back)
        while x >= self.size:
            x = self._once(x, back)
        return x


def luhn(digits: str) -> int:
    """The check digit for ``digits``."""
    total = sum(d if i % 2 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _card_ends(s: str) -> list[int]:
    """Ends of a card number that ``s`` may begin with, at the ends of its digit groups; the likeliest first.

    A usual layout comes first, so a security code or date behind it changes nothing; then the longest.
    """
    sizes, ends, count = (), {}, 0
    usual = []
    for g in re.finditer("[0-9]+", s):
        count += len(g[0])
        sizes += (len(g[0]),)
        if 13 <= count <= 19:
            ends[g.end()] = count
            if sizes in ((4, 4, 4, 4), (4, 6, 5)) or (len(sizes) == 1 and count in (15, 16)):
                usual.append(g.end())
    return usual + [e for e in sorted(ends, reverse=True) if e not in usual]


def _iban_ends(s: str) -> list[int]:
    """Ends of an IBAN that ``s`` may begin with, at its spaces; the country's length first, then the longest."""
    ends = [m.start() for m in re.finditer(" |$", s)]
    length = IBAN_LENGTHS.get(s[:2])
    return sorted(ends, key=lambda e: (len(s[:e].replace(" ", "")) != length, -e))


def _refill(old: str, chars: str, kept: str = "0123456789") -> str:
    """``old`` with its characters of ``kept`` replaced in turn."""
    it = iter(chars)
    return "".join(next(it) if c in kept else c for c in old)


class Pseudonyms:
    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back
        self.nets: dict[tuple[str, int], Feistel] = {}

    def _permute(self, tweak: str, size: int, x: int) -> int:
        net = self.nets.get((tweak, size))
        if net is None:
            net = self.nets[tweak, size] = Feistel(self.key, tweak, size)
        return net.permute(x, self.back)

    def _digits(self, tweak: str, digits: str, form=None) -> str:
        """Permuted digits; with ``form``, within the values that share its result, by walking on."""
        out = digits
        while True:
            out = str(self._permute(tweak, 10 ** len(out), int(out))).zfill(len(out))
            if form is None or form(out) == form(digits):
                return out

    def _mixed(self, tweak: str, text: str) -> str:
        """Letters stay letters of their case, digits stay digits, other characters stay."""
        base = [26 if c.isalpha() and c.isascii() else 10 if c.isdigit() and c.isascii() else 1 for c in text]
        size, x = 1, 0
        for c, b in zip(text, base):
            size, x = size * b, x * b + (0 if b == 1 else int(c) if b == 10 else ord(c.lower()) - 97)
        y, out = self._permute(f"{tweak}:{''.join('a' if b == 26 else '0' if b == 10 else c for c, b in zip(text, base))}", size, x), []
        for c, b in zip(reversed(text), reversed(base)):
            y, r = divmod(y, b)
            new = c if b == 1 else str(r) if b == 10 else chr(97 + r)
            out.append(new.upper() if c.isupper() else new)
        return "".join(reversed(out))

    def email(self, s: str) -> str | None:
        local, _, domain = s.rpartition("@")
        # the notation's case links too: the permutation works on lower case
        return f"{self._mixed('email@' + domain.lower(), local)}@{domain}"

    def card(self, s: str) -> str | None:
        digits = re.sub("[ -]", "", s)
        if int(digits[-1]) != luhn(digits[:-1]) or len(set(digits)) == 1:
            return None
        # a long number whose usual beginnings are no cards stays such a number, so it is read alike again
        form = (lambda b: [b[k - 1] == str(luhn(b[: k - 1])) for k in (15, 16)]) if len(digits) > 16 else None
        body = self._digits("card", digits[:-1], form)
        return _refill(s, body + str(luhn(body)))

    def iban(self, s: str) -> str | None:
        plain = s.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_rest(plain) != 1:
            return None
        body = self._mixed("iban" + plain[:2], plain[4:])
        check = str(98 - iban_rest(plain[:2] + "00" + body)).zfill(2)
        it = iter(plain[:2] + check + body)
        return "".join(c if c == " " else next(it) for c in s)

    def phone(self, s: str) -> str | None:
        country = re.match(r"\+[0-9]{1,3}", s)[0]
        rest = s[len(country) :]
        digits = re.sub("[^0-9]", "", rest)
        if not 7 <= len(digits) <= 14:
            return None
        if country[:2] == "+1" and len(country + digits) == 12:  # one notation's split after the country code isn't another's
            digits = (country + digits)[2:]
            new = self._digits("phone+1", digits, lambda d: d[0] > "1" and d[3] > "1")
            return "+1" + _refill(s[2:], new)
        return country + _refill(rest, self._digits("phone" + country, digits))

    def national(self, s: str) -> str | None:
        """A North American number without its +: the pseudonym that it has with +1."""
        at = 1 if s[0] == "1" else 0
        return s[:at] + self.phone("+1" + s[at:])[2:]

    def ssn(self, s: str) -> str | None:
        area, group, serial = map(int, s.split("-"))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        areas = area - 1 - (area > 666)
        x = self._permute("ssn", 898 * 99 * 9999, (areas * 99 + group - 1) * 9999 + serial - 1)
        x, serial = divmod(x, 9999)
        areas, group = divmod(x, 99)
        return f"{areas + 1 + (areas >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def ip(self, s: str) -> str | None:
        parts = s.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        x = self._permute("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def date(self, s: str) -> str | None:
        mark = s[4] if s[4] in "-" else s[2]
        a, b, c = map(int, s.split(mark))
        # with slashes the month comes first unless that is no date
        orders = [(a, b, c, "ymd")] if mark == "-" else [(c, b, a, "dmy")] if mark == "." else [(c, a, b, "mdy"), (c, b, a, "dmy")]
        for y, m, d, order in orders:
            try:
                day = date(y, m, d).toordinal()
            except ValueError:
                continue
            if not FIRST_DAY <= day <= LAST_DAY:
                return None
            new = date.fromordinal(FIRST_DAY + self._permute("date", LAST_DAY - FIRST_DAY + 1, day - FIRST_DAY))
            part = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
            return mark.join(part[k] for k in order)
        return None

    def replace(self, text: str | None) -> tuple[str | None, list[tuple[str, int, int]]]:
        """(text with pseudonyms, [(kind, start, end) in the old text]); null stays null."""
        if not text or not _NEEDS.search(text):
            return text, []
        out, spans, at = [], [], 0
        for line in text.split("\n"):
            if _NEEDS.search(line):
                new, done, pos = [], 0, 0
                while m := _PATTERN.search(line, pos):
                    kind, found = m.lastgroup, m[0]
                    ends = _card_ends(found) if kind == "card" else _iban_ends(found) if kind == "iban" else [len(found)]
                    for end in ends:
                        if (value := getattr(self, kind)(found[:end])) is not None:
                            break
                    else:  # not valid: look on from the next character run
                        pos = m.start() + 1
                        continue
                    new += [line[done : m.start()], value]
                    end += m.start()
                    spans.append(("phone" if kind == "national" else kind, at + m.start(), at + end))
                    done = pos = end
                out.append("".join([*new, line[done:]]))
            else:
                out.append(line)
            at += len(line) + 1
        return "\n".join(out), spans


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """doc_id, text with pseudonyms and spans (array of kind, start, end in the input, code points) of every row.

    ``back`` inverts an earlier run with the same key. Null stays null; repeated rows repeat.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, back)
        for batch in batches:
            for b in slices(batch):
                rows = [names.replace(t.as_py()) for t in b.column(1)]
                spans = [[{"kind": k, "start": s, "end": e} for k, s, e in r[1]] for r in rows]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array(spans, pa.list_(span))], ["doc_id", "text", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, text string, spans array<struct<kind:string,start:bigint,end:bigint>>")


def digest(found: DataFrame) -> DataFrame:
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS]
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",").alias("spans")
    return found.select("doc_id", "text", *counts, spans)
