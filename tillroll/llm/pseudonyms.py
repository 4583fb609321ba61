"""Personal data under format-preserving pseudonyms.

Numbers and dates that pass the checks of their format are replaced by others of the same format. The replacement
is a keyed permutation of the format's values, an alternating Feistel network whose rounds are keyed hashes, walked
along its cycle until it meets a valid value again. So equal values get equal pseudonyms in every document and task,
different values get different ones, no table of values is kept, and who holds the key can turn them back.

Formats: payment card numbers (Luhn), IBAN (mod 97), social security numbers, telephone numbers of ten digits,
IPv4 addresses, calendar dates of 1900 to 2099 in ``Y-m-d``, ``d.m.Y``, ``d/m/Y`` and ``m/d/Y``, local parts of mail
addresses, and values assigned to a password, token, key or secret. Separators, case and surrounding text stay.
"""

import datetime
import re
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillroll.llm.batches import pieces

ROUNDS = 10
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "secret")

_FOUND = re.compile(
    r"""
    (?P<email> (?<![A-Za-z0-9._%+-]) [A-Za-z0-9._%+-]++ (?=@[A-Za-z0-9-]+\.[A-Za-z0-9]) )
  | (?P<secret> (?<=AKIA)[A-Z0-9]{16}(?![A-Za-z0-9])
      | (?: (?<=password=) | (?<=password\ =\ ") | (?<=token=) | (?<=token\ =\ ") | (?<=secret=) | (?<=secret\ =\ ")
          | (?<=key=) | (?<=key\ =\ ") ) [A-Za-z0-9+/_-][A-Za-z0-9+/_.-]{6,}[A-Za-z0-9+/_-] )
  | (?P<iban> (?<![A-Za-z0-9]) [A-Z]{2}[0-9]{2} (?:\ ?[A-Z0-9]{4}){2,7} (?:\ ?[A-Z0-9]{1,3})? (?![A-Za-z0-9]) )
  | (?P<ip> (?<![0-9.]) [0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3} (?!\.?[0-9]) )
  | (?P<date> (?<![0-9.-]) (?: [0-9]{4}-[0-9]{2}-[0-9]{2} | [0-9]{2}\.[0-9]{2}\.[0-9]{4} | [0-9]{2}/[0-9]{2}/[0-9]{4} )
      (?![0-9]|[.-][0-9]) )
  | (?P<ssn> (?<![0-9-]) [0-9]{3}-[0-9]{2}-[0-9]{4} (?!-?[0-9]) )
  | (?P<phone> (?<![0-9]) (?:\([0-9]{3}\)\ ?|[0-9]{3}[ .-]) [0-9]{3}[ .-][0-9]{4} (?![0-9]) )
  | (?P<card> (?<![0-9]) (?: [0-9]{13,19} | [0-9]{4}(?:[ -][0-9]{4}){3} | [0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5} ) (?![0-9]) )
    """,
    re.VERBOSE,
)
#: Digits that may be a card number in any other grouping, looked for where nothing else is.
_GROUPED = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,}(?![0-9])")
_TOKEN = re.compile(r"[^A-Za-z0-9]*[A-Za-z0-9]+")
_IBAN_LENGTHS = dict(
    (part[:2], int(part[2:]))
    for part in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29"
        " ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20"
        " LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29"
        " PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
        " YE30"
    ).split()
)
#: Longer strings are moved in parts of this length, as a round moves no more than the 512 bits of its hash.
_PART = 128
_WORTH = re.compile(r"[0-9@]|password|token|secret|key")
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2099, 12, 31).toordinal() - _FIRST_DAY + 1
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_DIGITS = "0123456789"
_HEX = _DIGITS + "abcdef"


class Pseudonyms:
    """The permutations under one key."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()
        self._cached = lru_cache(1 << 16)(self._replace)

    def _round(self, name: str, number: int, value: int, size: int) -> int:
        message = f"{name}/{number}/{value}".encode()
        return int.from_bytes(blake2b(message, key=self.key).digest(), "big") % size

    def permute(self, value: int, size: int, name: str, back: bool = False, valid=None) -> int:
        """``value`` of ``range(size)`` moved to another; within the values that
        are ``valid`` if that is given."""
        left_size = int(size**0.5) if size < 1 << 52 else 1 << (size.bit_length() // 2)
        left_size = max(1, left_size)
        right_size = -(-size // left_size)
        name = f"{name}/{size}"
        sign = -1 if back else 1
        while True:
            left, right = divmod(value, right_size)
            for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if number % 2:
                    right = (right + sign * self._round(name, number, left, right_size)) % right_size
                else:
                    left = (left + sign * self._round(name, number, right, left_size)) % left_size
            value = left * right_size + right
            if value < size and (valid is None or valid(value)):
                return value

    def characters(self, text: str, alphabets: list[str], name: str, back: bool, valid=None) -> str:
        """Each character moved within its alphabet, all of them together."""
        value, size = 0, 1
        for character, alphabet in zip(text, alphabets):
            value = value * len(alphabet) + alphabet.index(character)
            size *= len(alphabet)

        def spelt(number: int) -> str:
            out = []
            for alphabet in reversed(alphabets):
                number, place = divmod(number, len(alphabet))
                out.append(alphabet[place])
            return "".join(reversed(out))

        check = None if valid is None else lambda number: valid(spelt(number))
        return spelt(self.permute(value, size, name, back, check))

    def digits(self, text: str, name: str, back: bool, valid=None) -> str:
        return self.characters(text, [_DIGITS] * len(text), name, back, valid)

    def replace(self, kind: str, found: str, back: bool = False) -> str | None:
        """The pseudonym, or None where ``found`` is no valid value of its kind."""
        return self._cached(kind, found, back)

    def _replace(self, kind: str, found: str, back: bool) -> str | None:
        return getattr(self, f"_{kind}")(found, back)

    def _card(self, found, back):
        digits = re.sub("[ -]", "", found)
        if luhn(digits[:-1]) != digits[-1]:
            return None
        payload = self.digits(digits[:-1], "card", back)
        return refill(found, payload + luhn(payload))

    def _iban(self, found, back):
        plain = found.replace(" ", "")
        if len(plain) != _IBAN_LENGTHS.get(plain[:2], len(plain)):
            return None
        if iban_check(plain[:2], plain[4:]) != plain[2:4]:
            return None
        alphabets = [_DIGITS if c.isdigit() else _LETTERS.upper() for c in plain[4:]]
        account = self.characters(plain[4:], alphabets, f"iban {plain[:2]}", back)
        return refill(found, plain[:2] + iban_check(plain[:2], account) + account)

    def _ssn(self, found, back):
        digits = found.replace("-", "")
        return refill(found, self.digits(digits, "ssn", back, social)) if social(digits) else None

    def _phone(self, found, back):
        digits = re.sub("[^0-9]", "", found)
        # Numbers of the numbering plan stay in it, others out of it.
        kind = numbered(digits)
        return refill(found, self.digits(digits, "phone", back, lambda other: numbered(other) == kind))

    def _ip(self, found, back):
        parts = [int(part) for part in found.split(".")]
        if max(parts) > 255 or any(len(part) > 1 and part[0] == "0" for part in found.split(".")):
            return None
        value = self.permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip", back)
        return ".".join(map(str, value.to_bytes(4, "big")))

    def _date(self, found, back):
        # d/m/Y comes before m/d/Y; a day keeps its pseudonym in every format. A slashed date that reads only as
        # m/d/Y moves among those, so that it reads the same way afterwards.
        forms = {"-": ["%Y-%m-%d"], ".": ["%d.%m.%Y"], "/": ["%d/%m/%Y", "%m/%d/%Y"]}
        for number, form in enumerate(forms[re.search("[-./]", found)[0]]):
            day = calendar_day(found, form)
            if day is not None:
                only = None if not number else lambda value: datetime.date.fromordinal(_FIRST_DAY + value).day > 12
                moved = self.permute(day, _DAYS, "date", back, only)
                # "%Y" has no leading zeros to lose here: all years have four digits.
                return datetime.date.fromordinal(_FIRST_DAY + moved).strftime(form)
        return None

    def _email(self, found, back):
        return self._in_classes(found, "email", back) if re.search("[A-Za-z0-9]", found) else None

    def _secret(self, found, back):
        return self._in_classes(found, "secret", back)

    def _in_classes(self, found, name, back):
        if len(found) > _PART:
            parts = [found[i : i + _PART] for i in range(0, len(found), _PART)]
            return "".join(self._in_classes(part, name, back) or part for part in parts)
        kept = [c for c in found if c.isalnum()]
        if not kept:
            return None
        # Hexadecimal strings stay hexadecimal, others stay others.
        hexadecimal = _hexadecimal(kept)
        alphabets = [
            _HEX if hexadecimal else _DIGITS if c in _DIGITS else _LETTERS if c in _LETTERS else _LETTERS.upper()
            for c in kept
        ]
        moved = iter(
            self.characters("".join(kept), alphabets, name, back, lambda other: _hexadecimal(other) == hexadecimal)
        )
        return "".join(next(moved) if c.isalnum() else c for c in found)

    def text(self, text: str, counts: dict[str, int], back: bool = False) -> str:
        """``text`` with all values replaced; ``counts`` gains one for each."""
        if not _WORTH.search(text):
            return text

        def swapped(kind, begin, ends):
            for end in ends:
                other = self.replace(kind, text[begin:end], back)
                if other is not None:
                    counts[kind] = counts.get(kind, 0) + 1
                    return begin, end, other
            return None

        # What fails its check gives way to shorter spans, to other kinds and to what begins at its next token.
        swaps, at = [], 0
        while match := _FOUND.search(text, at):
            kind, begin = match.lastgroup, match.start()
            ends = [match.end()] if kind != "iban" else _ends(text, begin, match.end())
            if swap := swapped(kind, begin, ends):
                swaps.append(swap)
            token = _TOKEN.match(text, begin)
            at = swap[1] if swap else token.end() if token else match.end()
        gaps = zip([0, *[end for _, end, _ in swaps]], [*[begin for begin, _, _ in swaps], len(text)])
        for at, stop in list(gaps):
            while match := _GROUPED.search(text, at, stop):
                begin = match.start()
                spans = [end for end in _ends(text, begin, min(match.end(), begin + 40)) if 13 <= _size(text, begin, end) <= 19]
                if swap := swapped("card", begin, spans):
                    swaps.append(swap)
                at = swap[1] if swap else _TOKEN.match(text, begin).end()
        out, done = [], 0
        for begin, end, other in sorted(swaps):
            out += [text[done:begin], other]
            done = end
        return "".join([*out, text[done:]])


def _ends(text: str, begin: int, end: int) -> list[int]:
    """Where letters and digits end in a span, last first."""
    return [i for i in range(end, begin, -1) if text[i - 1].isalnum() and not text[i : i + 1].isalnum()]


def _size(text: str, begin: int, end: int) -> int:
    return sum(c.isalnum() for c in text[begin:end])


def luhn(payload: str) -> str:
    """Check digit of a card number without its last digit."""
    total = 0
    for place, digit in enumerate(reversed(payload)):
        doubled = int(digit) * (1 if place % 2 else 2)
        total += doubled - 9 if doubled > 9 else doubled
    return str(-total % 10)


def iban_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def social(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def numbered(digits: str) -> bool:
    return digits[0] > "1" and digits[3] > "1"


def calendar_day(found: str, form: str) -> int | None:
    try:
        day = datetime.datetime.strptime(found, form).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    return day if 0 <= day < _DAYS else None


def _hexadecimal(characters) -> bool:
    """Digits and a to f, both of them: plain digits are numbers."""
    return set(characters) <= set(_HEX) and not set(characters) <= set(_DIGITS)


def refill(found: str, characters: str) -> str:
    """``found`` with its letters and digits replaced one by one."""
    fresh = iter(characters)
    return "".join(next(fresh) if c.isalnum() else c for c in found)


def pseudonymise(documents: DataFrame, key: bytes, back: bool = False, with_counts: bool = True) -> DataFrame:
    """``documents`` with personal data in ``text`` replaced, all columns kept.

    Reads ``text``; ``back`` turns pseudonyms into the original values. With ``with_counts`` the columns
    ``n_replaced`` and ``n_<kind>`` follow (and replace columns of these names). NULL and empty texts stay as they
    are; texts without valid values are unchanged to the byte. No shuffle; rows keep their number and order.
    """
    names = ["n_replaced", *(f"n_{kind}" for kind in KINDS)] if with_counts else []
    columns = [name for name in documents.columns if name not in names]
    fields = [field for field in documents.schema.fields if field.name in columns]
    schema = T.StructType([*fields, *(T.StructField(name, T.LongType()) for name in names)])
    made = []

    def replace(batches):
        if not made:
            made.append(Pseudonyms(key))
        for piece in pieces(batches):
            texts, counts = [], []
            for text in piece.column("text").to_pylist():
                count: dict[str, int] = {}
                texts.append(text and made[0].text(text, count, back))
                counts.append(count)
            arrays = [piece.column(name) for name in columns]
            at = columns.index("text")
            arrays[at] = pa.array(texts, arrays[at].type)
            if names:
                by_kind = [pa.array([c.get(kind, 0) for c in counts], pa.int64()) for kind in KINDS]
                arrays += [pa.array([sum(c.values()) for c in counts], pa.int64()), *by_kind]
            yield pa.RecordBatch.from_arrays(arrays, names=columns + names)

    return documents.select(columns).mapInArrow(replace, schema)
