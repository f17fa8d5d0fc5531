"""Format-preserving pseudonyms for personal numbers and dates.

Numbers and dates are found by their format and checked: payment cards by the Luhn digit,
account numbers (IBAN) by their remainder, social security numbers and telephone numbers
by their number plan, internet addresses by their octets, dates by the calendar. Each
valid value is mapped to an integer of its kind's domain and permuted by a keyed Feistel
network; results outside the domain, or not valid as the kind, are walked on until one
is (cycle walking), so every kind's map is a permutation of its valid values. The result is
written in the value's own format: length, separators, letter case and check digits.

The key and the kind alone decide the map, so equal values get equal pseudonyms in every
document and in every notation, and different values stay different. Where a longest match
fails its check, or the issuer, country or number plan has another length, its shorter
beginnings are tried at the borders of its groups ('4111 1111 1111 1111 12/25' has a card and an
expiry date); without any, the search goes on behind the match's first token. Mail addresses are
treated alike: letters and digits of the local part are permuted within their classes.

Defined results: a null text stays null with no finds; a value that fails its check is
left alone, as are 0.0.0.0, 127.0.0.1 and 255.255.255.255; repeated rows get the
same result; an empty table gives an empty result. Working columns are prefixed ``_ps_``.
"""

from __future__ import annotations

import datetime
import hashlib
import ipaddress
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROUNDS = 8
FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
DAYS = datetime.date(2100, 1, 1).toordinal() - FIRST_DAY

# The private address ranges, as (first, number).
PRIVATE = [(0x0A000000, 1 << 24), (0xAC100000, 1 << 20), (0xC0A80000, 1 << 16)]

# Addresses that name no machine of their own (any, loopback, broadcast).
SPECIAL = {0, 0x7F000001, 0xFFFFFFFF}

# Month names and their usual abbreviations in English, German, French, Spanish.
MONTHS = [
    ("en", "January February March April May June July August September October November December".split()),
    ("en", "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()),
    ("de", "Januar Februar März April Mai Juni Juli August September Oktober November Dezember".split()),
    ("de", "Jan Feb Mär Apr Mai Jun Jul Aug Sep Okt Nov Dez".split()),
    ("de", "Jänner Feber März April Mai Juni Juli August Sept Oktober November Dezember".split()),
    ("fr", "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()),
    ("fr", "janv févr mars avr mai juin juil août sept oct nov déc".split()),
    ("fr", "janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre".split()),
    ("es", "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()),
    ("es", "ene feb mar abr may jun jul ago sep oct nov dic".split()),
    ("es", "enero febrero marzo abril mayo junio julio agosto setiembre octubre noviembre diciembre".split()),
]
#: French and Spanish names are written with small letters, but also with a capital.
MONTHS += [(language, [m.capitalize() for m in names]) for language, names in MONTHS if language in ("fr", "es")]

# First digits of payment cards and the usual lengths of their numbers.
ISSUERS = [
    (r"4", (16, 19, 13)),
    (r"5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720|220[0-4]", (16,)),
    (r"3[47]", (15,)),
    (r"30[0-5]|3095|3[689]", (14, 16)),
    (r"35(?:2[89]|[3-8])", (16, 19)),
    (r"50|5[6-9]|6|81", (16, 19, 18, 17, 15, 14, 13)),
]
_ISSUERS = [(re.compile(p), n) for p, n in ISSUERS]

# Lengths of account numbers by country.
_BY_LENGTH = {
    15: "NO",
    16: "BE",
    18: "DK FI FO FK GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
IBAN_LENGTHS = {c: n for n, countries in _BY_LENGTH.items() for c in countries.split()}

# Digits, with the country's, of telephone numbers in closed plans.
PHONE_LENGTHS = {"30": 12, "31": 11, "33": 11, "34": 11, "41": 11, "45": 10, "47": 10, "48": 11, "61": 11, "65": 10, "91": 12, "351": 12, "420": 12}

_MONTH = "|".join(sorted({m for _, names in MONTHS for m in names}, key=lambda m: (-len(m), m)))
_NAMED = re.compile(
    rf"(?P<d>[0-9]{{1,2}})(?P<mark>[.]|er)? (?P<of>de )?(?P<name>{_MONTH})(?P<dot>[.]?) (?P<of2>del? )?(?P<y>[0-9]{{4}})|(?P<name2>{_MONTH})(?P<dot2>[.]?) (?P<d2>[0-9]{{1,2}}), (?P<y2>[0-9]{{4}})"
)
_PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?",
    "date": rf"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}[/.][0-9]{{1,2}}[/.][0-9]{{4}}(?![.][0-9])|(?:{_MONTH})[.]? [0-9]{{1,2}}, [0-9]{{4}}|[0-9]{{1,2}}(?:[.]|er)? (?:de )?(?:{_MONTH})[.]? (?:del? )?[0-9]{{4}}",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[2-9][0-9]{0,2}(?:[ -]?\(?[0-9]{1,4}+\)?){2,7}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
}
KINDS = tuple(_PATTERNS)
_FIND = re.compile(r"(?<![0-9A-Za-z@])(?<![0-9][.-])(?:" + "|".join(f"(?P<{k}>{p})" for k, p in _PATTERNS.items()) + r")(?:(?<=[0-9]{4}-[0-9]{2}-[0-9]{2})(?=[Tt][0-9]{2})|(?![0-9A-Za-z@]|[.-][0-9]))")
_HINT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"[^0-9A-Za-z]*[0-9A-Za-z]+")


class Feistel:
    """Keyed permutation of 0 .. size - 1."""

    def __init__(self, key: bytes, label: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.key = hashlib.blake2b(key, person=b"pseudonyms", salt=hashlib.blake2b(f"{label}|{size}".encode(), digest_size=16).digest(), digest_size=32).digest()

    def _round(self, r: int, x: int) -> int:
        data = bytes([r]) + x.to_bytes((self.half + 7) // 8, "big")
        out = hashlib.blake2b(data, key=self.key, digest_size=min(64, (self.half + 7) // 8 + 8)).digest()
        return int.from_bytes(out, "big") & self.mask

    def _step(self, x: int) -> int:
        a, b = x >> self.half, x & self.mask
        for r in range(ROUNDS):
            a, b = b, a ^ self._round(r, b)
        return a << self.half | b

    def walk(self, x: int, valid: Callable[[int], bool] = lambda _: True) -> int:
        """Image of x among the valid values; x must be one."""
        while True:
            x = self._step(x)
            if x < self.size and valid(x):
                return x


def luhn_digit(body: str) -> str:
    """Check digit of a number without it."""
    total = 0
    for k, c in enumerate(reversed(body)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _fill(form: str, chars: str) -> str:
    """``form`` with its letters and digits replaced by ``chars`` in order."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in form)


class Pseudonymiser:
    def __init__(self, key: bytes):
        self.key = key
        self.maps: dict[tuple[str, int], Feistel] = {}

    def _map(self, kind: str, size: int) -> Feistel:
        if (kind, size) not in self.maps:
            if len(self.maps) > 4096:
                self.maps.clear()
            self.maps[kind, size] = Feistel(self.key, kind, size)
        return self.maps[kind, size]

    def card(self, s: str) -> str | None:
        d = re.sub("[ -]", "", s)
        if d[0] == "0" or luhn_digit(d[:-1]) != d[-1]:
            return None
        # The first digit (kind of issuer) and the length stay.
        n = len(d) - 2
        body = d[0] + str(self._map("card" + d[0], 10**n).walk(int(d[1:-1]))).zfill(n)
        return _fill(s, body + luhn_digit(body))

    def iban(self, s: str) -> str | None:
        c = s.replace(" ", "")
        if not 15 <= len(c) <= 34:
            return None
        value = lambda t: int("".join(str(int(x, 36)) for x in t))
        if value(c[4:] + c[:4]) % 97 != 1:
            return None
        body = self._mixed("iban" + c[:2], c[4:])
        return _fill(s, c[:2] + str(98 - value(body + c[:2] + "00") % 97).zfill(2) + body)

    def ssn(self, s: str) -> str | None:
        ok = lambda x: x // 10**6 not in (0, 666) and x // 10**6 < 900 and x // 10**4 % 100 != 0 and x % 10**4 != 0
        x = int(s.replace("-", ""))
        return _fill(s, str(self._map("ssn", 10**9).walk(x, ok)).zfill(9)) if ok(x) else None

    def phone(self, s: str) -> str | None:
        d = re.sub("[^0-9]", "", s)
        plan = lambda x: x // 10**9 >= 2 and x // 10**6 % 10 >= 2 and x < 10**10
        if len(d) == 10 and s[0] != "+":
            return _fill(s, str(self._map("phone1", 10**10).walk(int(d), plan)).zfill(10)) if plan(int(d)) else None
        if not 8 <= len(d) <= 15:
            return None
        if d[0] == "1" and len(d) == 11:
            # One map for both notations; numbers outside the plan stay outside it.
            inside = plan(int(d[1:]))
            return _fill(s, "1" + str(self._map("phone1", 10**10).walk(int(d[1:]), lambda x: plan(x) == inside)).zfill(10))
        return _fill(s, d[0] + str(self._map("phone" + d[0], 10 ** (len(d) - 1)).walk(int(d[1:]))).zfill(len(d) - 1))

    def ip(self, s: str) -> str | None:
        octets = [int(x) for x in s.split(".")]
        if max(octets) > 255:
            return None
        x = int.from_bytes(bytes(octets), "big")
        if x in SPECIAL:
            return None
        # Private addresses stay private: they are numbered through their three ranges.
        at = 0
        for base, size in PRIVATE:
            if base <= x < base + size:
                new = self._map("private ip", sum(n for _, n in PRIVATE)).walk(at + x - base)
                for base_, size_ in PRIVATE:
                    if new < size_:
                        return str(ipaddress.IPv4Address(base_ + new))
                    new -= size_
            at += size
        return str(ipaddress.IPv4Address(self._map("ip", 2**32).walk(x, self._public)))

    @staticmethod
    def _public(x: int) -> bool:
        return x not in SPECIAL and not any(base <= x < base + size for base, size in PRIVATE)

    @staticmethod
    def _names(m: re.Match) -> tuple[list[str], int]:
        """Month names of a named date's language and form, and the place of its own."""
        name = m["name"] or m["name2"]
        # What several languages share is read by the date's form, else in order.
        likely = "es" if m["of"] or m["of2"] else "fr" if m["mark"] == "er" else "de" if m["mark"] == "." else "en"
        fits = [(language != likely, k) for k, (language, names) in enumerate(MONTHS) if name in names]
        names = MONTHS[min(fits)[1]][1]
        return names, names.index(name)

    def date(self, s: str) -> str | None:
        numbers = [int(x) for x in re.findall("[0-9]+", s)]
        named = _NAMED.fullmatch(s)
        day_first = True
        try:
            if named:
                names, month = self._names(named)
                value = datetime.date(int(named["y"] or named["y2"]), 1 + month, int(named["d"] or named["d2"]))
            elif s[4:5] == "-":
                value = datetime.date(*numbers)
            else:
                day_first = "." in s or numbers[0] > 12
                d, m = numbers[:2] if day_first else numbers[1::-1]
                value = datetime.date(numbers[2], m, d)
        except ValueError:
            return None
        x = value.toordinal() - FIRST_DAY
        if not 0 <= x < DAYS:
            return None
        # A slash date reads as month first where it can; so must its pseudonym. Days to the 12th
        # and later ones are therefore permuted each among themselves, in every notation alike.
        late = value.day > 12
        new = self._day(self._map("date", DAYS).walk(x, lambda y: (self._day(y).day > 12) == late))
        if named:
            word = names[new.month - 1]
            if named["d"]:
                # Only the first is an ordinal in French.
                mark = "" if named["mark"] == "er" and new.day > 1 else named["mark"] or ""
                return f"{new.day}{mark} {named['of'] or ''}{word}{named['dot']} {named['of2'] or ''}{new.year}"
            return f"{word}{named['dot2']} {new.day}, {new.year}"
        if s[4:5] == "-":
            return new.isoformat()
        sep = "." if "." in s else "/"
        wide = len(s) == 10
        parts = [new.day, new.month] if day_first else [new.month, new.day]
        return sep.join([*(f"{p:02d}" if wide else str(p) for p in parts), str(new.year)])

    @staticmethod
    def _day(x: int) -> datetime.date:
        return datetime.date.fromordinal(FIRST_DAY + x)

    def _mixed(self, kind: str, s: str) -> str:
        """Letters and digits permuted together, each within its class."""
        radix = [10 if c.isdigit() else 26 for c in s if c.isalnum()]
        x, size = 0, 1
        for c, r in zip((c for c in s if c.isalnum()), radix, strict=True):
            x, size = x * r + (int(c) if r == 10 else (ord(c.lower()) - 97)), size * r
        shape = "".join("9" if c.isdigit() else "a" if c.isalnum() else c for c in s)
        x = self._map(kind + shape, size).walk(x)
        out = []
        for r in reversed(radix):
            x, k = divmod(x, r)
            out.append(str(k) if r == 10 else chr(97 + k))
        new = iter(reversed(out))
        return "".join((n.upper() if c.isupper() else n) if c.isalnum() and (n := next(new)) else c for c in s)

    def email(self, s: str) -> str:
        local, at, domain = s.rpartition("@")
        return self._mixed("email", local) + at + domain

    @staticmethod
    def _usual(d: str) -> tuple[int, ...]:
        """Usual lengths of a card number that begins with these digits."""
        return next((n for p, n in _ISSUERS if p.match(d)), ())

    def _cards(self, s: str, again: bool) -> list[int]:
        """Lengths of the beginnings of ``s`` to be tried as a card number, best first."""
        at, n, ends = [], 0, {}
        for g in re.finditer("[0-9]+", s):
            at.append(g.start())
            n += len(g[0])
            ends[n] = g.end()

        def plain(end: int) -> bool:
            # Numbers in tables have short groups; cards have none but the last.
            return all(len(g) > 3 for g in re.split("[ -]", s[:end])[:-1])

        usual = [ends[k] for k in self._usual(re.sub("[ -]", "", s)) if k in ends and (ends[k] == len(s) and not again or plain(ends[k]))]
        if again:
            return usual
        if not any(self.card(s[:e]) for e in usual):
            # A card that begins at a later group is no part of a longer number.
            if any(self.card(s[k:][:e]) for k in at[1:] if s[k - 1] == " " for e in self._cards(s[k:], True)):
                return []
        return [*usual, len(s), *(e for k, e in sorted(ends.items(), reverse=True) if k >= 13 and e < len(s) and plain(e))]

    def _ends(self, kind: str, s: str, again: bool) -> list[int]:
        """Lengths of the beginnings of the match ``s`` to be tried, best first; ``again``: it
        begins inside a match that failed."""
        if kind == "card":
            return self._cards(s, again)
        if kind == "iban":
            ends = {len(s[: m.end()].replace(" ", "")): m.end() for m in re.finditer(r"[A-Z0-9](?= |$)", s)}
            fixed = IBAN_LENGTHS.get(s[:2])
            return [*([ends[fixed]] if fixed in ends else []), *(e for _, e in sorted(ends.items(), reverse=True))]
        if kind == "phone" and s[0] == "+":
            # No group ends inside a bracket.
            ends = {sum(c.isdigit() for c in s[: m.end()]): m.end() for m in re.finditer(r"[0-9](?=[ -]|$)|\)(?=[ -]|$)", s)}
            d = re.sub("[^0-9]", "", s)
            fixed = next((PHONE_LENGTHS[d[:k]] for k in (2, 3) if d[:k] in PHONE_LENGTHS), None)
            return [*([ends[fixed]] if fixed in ends else []), *(e for _, e in sorted(ends.items(), reverse=True))]
        return [len(s)]

    def text(self, text: str) -> tuple[str, dict[str, int]]:
        """Text with pseudonyms, and the finds by kind."""
        found: dict[str, int] = {}
        if "@" not in text and not _HINT.search(text):
            return text, found

        out, done, at, failed = [], 0, 0, 0
        while m := _FIND.search(text, at):
            check = getattr(self, m.lastgroup)
            for end in self._ends(m.lastgroup, m[0], m.start() < failed):
                if (new := check(m[0][:end])) is not None:
                    found[m.lastgroup] = found.get(m.lastgroup, 0) + 1
                    out += [text[done : m.start()], new]
                    done = at = m.start() + end
                    break
            else:
                failed = max(failed, m.end())
                at = _TOKEN.match(text, m.start()).end()
        return "".join([*out, text[done:]]), found


def _apply(key: bytes, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Pseudonymiser(key)
        for batch in batches:
            done = [(None, {}) if t is None else own.text(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array([t for t, _ in done], pa.string())
            finds = [pa.array([f.get(k, 0) for _, f in done], pa.int64()) for k in KINDS]
            yield pa.RecordBatch.from_arrays([*columns, *finds], names=[*batch.schema.names, *(f"_ps_{k}" for k in KINDS)])

    return run


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and the number of finds of each kind in
    ``_ps_<kind>``. One pass over the rows, no shuffle."""
    schema = T.StructType([*docs.schema.fields, *(T.StructField(f"_ps_{k}", T.LongType()) for k in KINDS)])
    return docs.mapInArrow(_apply(key, docs.columns.index(text)), schema)
