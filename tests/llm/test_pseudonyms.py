import hashlib
import math
import random
import re
from datetime import date, timedelta

import pytest

from evalyard.llm import pseudonyms as P
from evalyard.llm import queries

from .oracle import SF

KEY = b"k"


@pytest.mark.parametrize("size", [1, 2, 7, 10, 97, 1000])
def test_feistel_is_a_permutation(size):
    net = P.Feistel(KEY, "t", size)
    got = [net.permute(x) for x in range(size)]
    assert sorted(got) == list(range(size))
    assert [net.permute(y, back=True) for y in got] == list(range(size))


@pytest.mark.parametrize("size", [97, 73049, 1 << 32, 10**15])
def test_neighbours_part(size):
    net = P.Feistel(KEY, "t", size)
    assert len({(net.permute(x) - x) % size for x in range(90)}) > 40 and abs(net.a - net.b) <= 1


def test_formats_validity_and_links():
    body = "453201511283036"
    card = body + str(P.luhn(body))
    spaced = " ".join(card[i : i + 4] for i in range(0, 16, 4))
    text = f"a {card} b {spaced} c 2024-02-29, 02/29/2024 29.02.2024 2024-02-30 +1 (377) 555-0271 +1 377 555 0271 10.0.0.256 10.1.2.3 123-45-6789 000-45-6789 Bob.7@mail6.example.com GB82 WEST 1234 5698 7654 32"
    new, spans = P.Pseudonyms(KEY).replace(text)
    kinds = [k for k, _, _ in spans]
    assert kinds == ["card", "card", "date", "date", "date", "phone", "phone", "ip", "ssn", "email", "iban"]
    assert "2024-02-30" in new and "10.0.0.256" in new and "000-45-6789" in new
    new_spans = P.Pseudonyms(KEY).replace(new)[1]
    assert [k for k, _, _ in new_spans] == kinds
    assert P.Pseudonyms(KEY, back=True).replace(new)[0] == text
    got = [new[s:e] for _, s, e in new_spans]
    digits = lambda s: re.sub("[^0-9]", "", s)
    assert digits(got[0]) == digits(got[1]) and got[1].count(" ") == 3 and int(got[0][-1]) == P.luhn(got[0][:-1])
    d = date.fromisoformat(got[2])
    assert got[3] == f"{d.month:02d}/{d.day:02d}/{d.year}" and got[4] == f"{d.day:02d}.{d.month:02d}.{d.year}"
    assert digits(got[5]) == digits(got[6]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[5])
    assert re.fullmatch(r"[A-Z][a-z]{2}\.\d@mail6\.example\.com", got[9])
    assert P.iban_rest(got[10].replace(" ", "")) == 1
    for k, s, e in spans:
        assert text[s:e] not in new


def test_query_and_edges(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op8_pseudonyms"](spark, SF).collect()
    assert len(rows) == len(docs)
    found = 0
    for r in rows:
        spans = [x.split(":") for x in r.spans.split(",") if x]
        found += len(spans)
        assert sum(r[f"n_{k}"] for k in P.KINDS) == len(spans)
        if not spans:
            assert r.text == docs[r.doc_id]
        for _, s, e in spans:
            assert docs[r.doc_id][int(s) : int(e)] not in r.text
    assert found > 10
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "call +1 (377) 555-0271", "x"), (3, "1 " * 30000, "x"), (3, "1 " * 30000, "x")], "doc_id bigint, text string, spans string")
    got = P.digest(P.pseudonymise(df, KEY)).collect()
    assert len(got) == 5 and {r.doc_id: r.text for r in got}[1] is None
    assert P.pseudonymise(df.limit(0), KEY).count() == 0


def test_values_before_other_digits_and_words():
    names, back = P.Pseudonyms(KEY), P.Pseudonyms(KEY, back=True)
    digits = lambda s: re.sub("[^0-9]", "", s)
    alone = names.replace("4111 1111 1111 1111")[0]
    # every security code, as one in ten makes a longer valid number
    for tail in [f" {k:03d}" for k in range(40)] + [" 12/27", "-123", " 12"]:
        for card in ("4111 1111 1111 1111", "4111111111111111"):
            new, spans = names.replace(card + tail)
            assert spans == [("card", 0, len(card))] and digits(new[: len(card)]) == digits(alone) and new.endswith(tail)
            assert back.replace(new)[0] == card + tail
    long = [b + str(P.luhn(b)) for b in (f"62{k:016d}" for k in range(100, 160))]
    for card in long:
        grouped = " ".join(card[i : i + 4] for i in range(0, 19, 4))
        for text in (card, grouped):
            new = names.replace(text)[0]
            assert new != text and back.replace(new)[0] == text
    for iban, tail in (("BE68 5390 0754 7034", " DATE"), ("BE68 5390 0754 7034", " 2024"), ("GB82 WEST 1234 5698 7654 32", " EUR")):
        new, spans = names.replace(iban + tail)
        assert spans == [("iban", 0, len(iban))] and new[: len(iban)] == names.replace(iban)[0] and back.replace(new)[0] == iban + tail


def test_dates_with_times_and_national_phones():
    names, back = P.Pseudonyms(KEY), P.Pseudonyms(KEY, back=True)
    new, spans = names.replace("2024-05-06T10:00:00Z 2024-05-06 2024-05-06Thursday")
    assert [k for k, _, _ in spans] == ["date", "date"] and new[:10] == new[21:31] and new[10:20] == "T10:00:00Z"
    digits = lambda s: re.sub("[^0-9]", "", s)[-10:]
    want = digits(names.replace("+1 377 555 0271")[0])
    for text in ("(377) 555-0271", "377-555-0271", "377.555.0271", "1-377-555-0271", "+1 (377) 555-0271", "+13775550271"):
        new, spans = names.replace(text)
        assert spans == [("phone", 0, len(text))] and digits(new) == want and back.replace(new)[0] == text, text
    assert not names.replace("a 377-555-02711 b 077-555-0271 c 377-555-0271-9 d")[1]


# --- a slow second version: every start, kind and end, with plain loops -----------------------

ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
WORD = ALNUM + "_"
DIGITS = "0123456789"


def is_form(s, form):
    """``form``: d a digit, n a digit from 2, other characters themselves."""
    return len(s) == len(form) and all((c in DIGITS if f == "d" else c in "23456789" if f == "n" else c == f) for c, f in zip(s, form))


def cut_ok(s, at, marks):
    """Single ``marks`` between digits, digits at both ends."""
    return s[:1] in DIGITS and s[-1:] in DIGITS and all(c in DIGITS or (c in marks and s[k - 1] in DIGITS and s[k + 1] in DIGITS) for k, c in enumerate(s)) and at


def shape(kind, s, before, after):
    digits = "".join(c for c in s if c in DIGITS)
    if kind == "email":
        local, _, domain = s.partition("@")
        labels = domain.split(".")
        return bool(local) and local[0] in ALNUM and all(c in WORD + ".+-" for c in local) and len(labels) > 1 and all(x and all(c in ALNUM + "-" for c in x) for x in labels) and before not in WORD + ".+-"
    if kind == "iban":
        plain, at, ok = s.replace(" ", ""), 0, s[-1:] != " "
        for k, c in enumerate(s):
            if c == " ":
                ok = ok and at % 4 == 0 and at and s[k - 1] != " "
            else:
                at += 1
        return bool(ok) and 12 <= len(plain) <= 35 and plain[:2].isupper() and plain[2:4].isdigit() and all(c in ALNUM[:36] for c in plain) and before not in WORD and after[:1] not in WORD
    if kind == "national":
        body = s[2:] if s[0] == "1" and s[1:2] in (" ", ".", "-") else s
        forms = [f"(ndd){a}ndd{b}dddd" for a in ("", " ", ".", "-") for b in " .-"] + ["ndd-ndd-dddd", "ndd.ndd.dddd"]
        return any(is_form(body, f) for f in forms) and before not in WORD + ".+-" and after[:1] not in WORD and not (after[:1] in ".-" and after[1:2] in DIGITS and after[1:2])
    if kind == "date":
        ends = is_form(after[:3], "Tdd") or is_form(after[:3], "tdd") or (after[:1] == "Z" and after[1:2] not in WORD) or (after[:1] not in WORD + "-" and not (after[:1] in "./" and after[1:2] in DIGITS and after[1:2]))
        return any(is_form(s, f) for f in ("dddd-dd-dd", "dd/dd/dddd", "dd.dd.dddd")) and before not in WORD + ".-" and ends
    if kind == "ssn":
        return is_form(s, "ddd-dd-dddd") and before not in WORD + "-" and after[:1] not in WORD + "-"
    if kind == "ip":
        parts = s.split(".")
        return len(parts) == 4 and all(1 <= len(p) <= 3 and all(c in DIGITS for c in p) for p in parts) and before not in WORD + "." and after[:1] not in WORD and not (after[:1] == "." and after[1:2] in DIGITS and after[1:2])
    return cut_ok(s, 13 <= len(digits) <= 19, " -") and before not in WORD + "." and after[:1] not in WORD


def passes_luhn(s):
    digits = [int(c) for c in s if c in DIGITS]
    return len(set(digits)) > 1 and sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0


def valid_end(kind, s):
    """Length of the value that a longest shape begins with; 0 for none."""
    if kind == "card":
        ends = [k for k in range(1, len(s) + 1) if s[k - 1] in DIGITS and s[k : k + 1] not in DIGITS or k == len(s)]
        sizes = lambda k: tuple(map(len, s[:k].replace("-", " ").split()))
        usual = [k for k in ends if sizes(k) in ((4, 4, 4, 4), (4, 6, 5), (15,), (16,))]
        ok = [k for k in usual + ends[::-1] if 13 <= sum(sizes(k)) <= 19 and passes_luhn(s[:k])]
    elif kind == "iban":
        ends = [k for k in range(1, len(s) + 1) if s[k : k + 1] in ("", " ")]
        plain = lambda k: s[:k].replace(" ", "")
        value = lambda p: int("".join(str(ALNUM.index(c)) for c in p[4:] + p[:4]))
        ok = [k for k in sorted(ends, key=lambda k: (len(plain(k)) != P.IBAN_LENGTHS.get(s[:2]), -k)) if 15 <= len(plain(k)) <= 34 and value(plain(k)) % 97 == 1]
    elif kind == "date":
        parts = [int(x) for x in re.split("[-/.]", s)]
        orders = [parts] if s[4] == "-" else [parts[::-1]] if s[2] == "." else [[parts[2], parts[0], parts[1]], parts[::-1]]
        month = lambda y, m: [31, 29 if y % 4 == 0 and (y % 100 or y % 400 == 0) else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m - 1]
        ok = [len(s)] if any(1900 <= y < 2100 and 1 <= m <= 12 and 1 <= d <= month(y, m) for y, m, d in orders) else []
    elif kind == "ssn":
        ok = [len(s)] if s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000" else []
    elif kind == "ip":
        ok = [len(s)] if all(str(int(p)) == p and int(p) < 256 for p in s.split(".")) else []
    else:
        ok = [len(s)]
    return ok[0] if ok else 0


def slow_spans(text):
    out, pos = [], 0
    while pos < len(text):
        step = 1
        for kind in () if text[pos] not in ALNUM + "(" else ("email", "iban", "national", "date", "ssn", "ip", "card"):
            before = text[pos - 1] if pos else "\n"
            longest = next((e for e in range(min(len(text), pos + 130), pos, -1) if shape(kind, text[pos:e], before, text[e : e + 3].ljust(3, "\n"))), 0)
            if longest:
                if n := valid_end(kind, text[pos:longest]):
                    out.append(("phone" if kind == "national" else kind, pos, pos + n))
                    step = n
                break
        pos += step
    return out


def slow_permute(tweak, size, x):
    """The walk through the rounds, halves joined anew each time."""
    a = math.isqrt(size - 1) + 1
    assert (a - 1) ** 2 < size <= a * a
    b = -(-size // a)
    while True:
        for i in range(P.ROUNDS):
            left, right = x % a, x // a
            half = left if i % 2 else right
            f = hashlib.blake2b((f"{tweak}|{size}|{i}|{half}" if a < 2**192 else f"{tweak}|{size:x}|{i}|{half:x}").encode(), key=KEY, digest_size=32).digest()
            head, k = f, 0
            while 8 * len(f) < a.bit_length() + 64:
                k += 1
                f += hashlib.blake2b(head + k.to_bytes(8, "big"), key=KEY, digest_size=32).digest()
            f = int.from_bytes(f, "big")
            x = left + a * ((right + f) % b) if i % 2 else (left + f) % a + a * right
        if x < size:
            return x


def samples(n, seed):
    rnd = random.Random(seed)
    d = lambda k: "".join(rnd.choice(DIGITS) for _ in range(k))

    def card():
        body = d(rnd.choice((12, 14, 15, 15, 15, 18)))
        s = body + (str(P.luhn(body)) if rnd.random() < 0.7 else d(1))
        mark = rnd.choice(("", " ", "-"))
        return mark.join(s[k : k + 4] for k in range(0, len(s), 4))

    def iban():
        country, length = rnd.choice((("GB", 22), ("DE", 22), ("BE", 16), ("NO", 15)))
        body = d(length - 4)
        check = 98 - P.iban_rest(country + "00" + body) if rnd.random() < 0.7 else 11
        s = f"{country}{check:02d}{body}"
        return s if rnd.random() < 0.5 else " ".join(s[k : k + 4] for k in range(0, len(s), 4))

    makers = [
        card, iban, lambda: f"{rnd.choice('ab')}{d(2)}.x@m{d(1)}.org", lambda: f"{rnd.choice((1899, 1900, 2024, 2100))}-{rnd.choice(('02', '13', '11'))}-{rnd.choice(('29', '30', '31'))}", lambda: f"{rnd.choice(('02', '30'))}{rnd.choice('/.')}{rnd.choice(('11', '31'))}/2024",
        lambda: f"{rnd.choice(('02', '30'))}.11.2023", lambda: f"{rnd.choice(('000', '123', '666', '900'))}-{d(2)}-{d(4)}", lambda: ".".join(str(rnd.randrange(290)) for _ in range(4)), lambda: f"({rnd.randrange(100, 999)}) {rnd.randrange(100, 999)}-{d(4)}", lambda: f"{rnd.randrange(100, 999)}-{rnd.randrange(100, 999)}-{d(4)}",
        lambda: rnd.choice(("word", "Ab", "EUR", "x_1", d(3), d(8), "é")),
    ]
    return ["".join(rnd.choice(makers)() + rnd.choice((" ", " ", ", ", "\n", "; ", ".", "-", "x", "T10", "Z")) for _ in range(12)) for _ in range(n)]


def test_spans_against_a_slow_finder(spark):
    names = P.Pseudonyms(KEY)
    kinds = set()
    for text in samples(120, 5):
        spans = names.replace(text)[1]
        assert spans == slow_spans(text), text
        kinds |= {k for k, _, _ in spans}
    assert kinds == set(P.KINDS)


def test_values_against_slow_permutations():
    names = P.Pseudonyms(KEY)
    first = date(1900, 1, 1)
    days = [first + timedelta(k) for k in range((date(2100, 1, 1) - first).days)]
    numbers = [f"{a:03d}" for a in range(1, 900) if a != 666]
    for k in range(60):
        day = days[(k * 7919) % len(days)]
        assert names.replace(day.isoformat())[0] == days[slow_permute("date", len(days), days.index(day))].isoformat()
        ip = (k * 2654435761) % 2**32
        dotted = lambda x: ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
        assert names.replace(dotted(ip))[0] == dotted(slow_permute("ip", 2**32, ip))
        area, group, serial = numbers[(k * 97) % len(numbers)], 1 + k % 99, 1 + k * 163 % 9999
        new = slow_permute("ssn", len(numbers) * 99 * 9999, (numbers.index(area) * 99 + group - 1) * 9999 + serial - 1)
        assert names.replace(f"{area}-{group:02d}-{serial:04d}")[0] == f"{numbers[new // 9999 // 99]}-{new // 9999 % 99 + 1:02d}-{new % 9999 + 1:04d}"
        body = f"{4 * 10**14 + k * 982451653:015d}"
        moved = str(slow_permute("card", 10**15, int(body))).zfill(15)
        assert names.replace(body + str(P.luhn(body)))[0][:15] == moved and passes_luhn(names.replace(body + str(P.luhn(body)))[0])


def slow_letters(tweak, text):
    """Letters and digits of ``text`` by positional values, moved by the slow permutation."""
    form = "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in text)
    weights, size = [], 1
    for c in reversed(form):
        weights.insert(0, size)
        size *= {"a": 26, "0": 10}.get(c, 1)
    digit = lambda c: 0 if c not in DIGITS + "abcdefghijklmnopqrstuvwxyz" else int(c) if c in DIGITS else ord(c) - 97
    x = slow_permute(f"{tweak}:{form}", size, sum(w * digit(c.lower()) for w, c in zip(weights, text)))
    out = []
    for c, f, w in zip(text, form, weights):
        n = x // w % {"a": 26, "0": 10}.get(f, 1)
        out.append(c if f not in "a0" else str(n) if f == "0" else chr(97 + n).upper() if c.isupper() else chr(97 + n))
    return "".join(out)


def test_names_phones_and_ibans_against_slow_permutations():
    names, rnd = P.Pseudonyms(KEY), random.Random(9)
    for n in (1, 5, 30, 80, 90, 150, 300):
        local = "".join(rnd.choice("abcXYZ019._") for _ in range(n - 1)).strip("._") + "q"
        assert names.replace(f"{local}@Mail.org")[0] == slow_letters("email@mail.org", local) + "@Mail.org"
    for _ in range(20):
        digits = "".join(rnd.choice(DIGITS) for _ in range(9))
        moved = str(slow_permute("phone+44", 10**9, int(digits))).zfill(9)
        assert names.replace(f"+44 {digits[:3]} {digits[3:6]} {digits[6:]}")[0] == f"+44 {moved[:3]} {moved[3:6]} {moved[6:]}"
        body = "".join(rnd.choice(DIGITS) for _ in range(18))
        check = 98 - P.iban_rest("DE00" + body)
        new = slow_letters("ibanDE", body)
        assert names.replace(f"DE{check:02d}{body}")[0] == f"DE{98 - P.iban_rest('DE00' + new):02d}{new}"


def test_every_letter_of_a_long_name_moves():
    rnd = random.Random(4)
    local = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300))
    moved = set()
    for k in range(12):
        new = P.Pseudonyms(b"key %d" % k).replace(f"{local}@mail.org")[0][:300]
        share = sum(a != b for a, b in zip(local, new)) / 300
        assert share > 0.9  # all but some 1 in 26
        moved |= {i for i, (a, b) in enumerate(zip(local, new)) if a != b}
    assert moved == set(range(300))
    huge = "ab" * 10_000
    assert P.Pseudonyms(KEY, back=True).replace(P.Pseudonyms(KEY).replace(f"{huge}@mail.org")[0])[0] == f"{huge}@mail.org"
