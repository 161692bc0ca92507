"""Surrogates for personal data: keyed, of the same type and format, and never shared.

Each entity is replaced through a keyed permutation of all values of its type and
format: a Feistel network over its characters puts them on one ring, on which each gives
way to the next. So the same entity always gets the same surrogate, in any document and
on any executor, two entities never get the same one, and none gets itself; no table of
entities is needed. Values that must not come up (names of the list for one that is not
in it, private addresses for a public one) are passed over, which keeps it one to one.
"""

import hashlib
import re
import unicodedata
from collections.abc import Callable, Sequence
from datetime import date, timedelta
from functools import lru_cache
from ipaddress import IPv6Address
from math import prod

import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType

from tidemark.llm.arrow import fields, map_texts

ROUNDS = 8

# Given names by gender and script, and forms of address by gender.
NAMES = {
    ("f", "latin"): (
        "Alice Anna Barbara Carla Clara Diana Elena Emma Eva Greta Hanna Ines Irene Julia Laura "
        "Lena Lucia Maria Marta Mary Nina Olivia Paula Rosa Sarah Silvia Sofia Susan Teresa Vera"
    ).split(),
    ("m", "latin"): (
        "Adam Andrew Anton Bruno Carlos Daniel David Erik Felix Frank George Hans Hugo Ivan James "
        "John Jorge Karl Louis Lukas Mark Martin Max Michael Oscar Paul Peter Robert Thomas Victor"
    ).split(),
    ("f", "cyrillic"): "Анна Вера Елена Ирина Мария Наталья Ольга Светлана Софья Татьяна".split(),
    ("m", "cyrillic"): "Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
    ("f", "greek"): "Άννα Ελένη Ειρήνη Κατερίνα Μαρία Σοφία".split(),
    ("m", "greek"): "Γιώργος Δημήτρης Κώστας Νίκος Παύλος Πέτρος".split(),
}
TITLES = (
    "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sr Sra Господин Госпожа "
    "Κύριος Κυρία"
).split()

VOWELS = ("aeiou", "аеиоуыэюя", "αειουω", "øæœ")
CONSONANTS = ("bcdfghjklmnpqrstvwxyz", "бвгджзклмнпрстфхцчшщ", "βγδζθκλμνξπρστφχψ", "łđðþħ")
LETTERS = ("abcdefghijklmnopqrstuvwxyz",)
DIGITS = ("0123456789",)
HEX_DIGITS = ("0123456789abcdef",)
FIRST_DIGITS = ("123456789", "0")

POOL = {name: names for names in NAMES.values() for name in names}

# Words that introduce a date of birth or a passport, and kinds of streets.
BORN = (
    r"born(?:\x20on)?|date\x20of\x20birth|birth\x20date|DOB|geboren(?:\x20am)?|Geburtsdatum"
    r"|née?\x20le|date\x20de\x20naissance|nacid[oa]\x20el|fecha\x20de\x20nacimiento"
)
PASSPORT = r"passport|Reisepass(?:nummer)?|passeport|pasaporte"
STREETS = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Ct|Terrace|Square"
# A name: a capital, letters of any script, and parts that a hyphen or apostrophe joins.
NAME = r"\p{Lu}(?:['’]\p{Lu})?[\p{L}\p{M}]+(?:-\p{Lu}[\p{L}\p{M}]+)*"

ENTITY = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?"
    r"@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
    r"|(?P<iban>\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b)"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d|[A-Za-z]))"
    r"|(?P<card>(?<![\w.+-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])"
    r"\d{3,4}[ .-]?\d{3,4}(?![\w-])|(?<![\w.])\+\d{8,15}(?!\w))",
    re.ASCII,
)
ADDRESS = re.compile(
    r"(?<![\w.:])(?P<ip6>(?:[0-9A-Fa-f]{1,4}:){1,7}"
    r"(?::?[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}|:))(?![\w:])",
    re.ASCII,
)
# What a word before it tells.
INTRODUCED = regex.compile(
    rf"(?i:\b(?:{BORN})\b)[:\x20]{{1,3}}(?P<birth>\d{{4}}-\d\d?-\d\d?|\d\d?[./]\d\d?[./]\d{{4}})(?!\d)"
    rf"|(?i:\b(?:{PASSPORT})\b)(?i:\x20(?:no|nr|number|num))?[.:#\x20]{{1,3}}"
    r"(?P<passport>[A-Z]{0,3}\d{5,9}[A-Z]?)\b"
)
STREET = regex.compile(
    rf"\b(?P<street>\d{{1,5}}\x20(?:{NAME}\x20){{1,3}}(?:{STREETS}))\b"
    rf"|\b(?P<strasse>{NAME}(?:straße|strasse|weg|platz|allee)\x20\d{{1,4}}[a-z]?)\b"
)
TITLED = "|".join([*TITLES, *(t.upper() for t in TITLES)])
LISTED = "|".join([*POOL, *(n.upper() for n in POOL)])
PERSON = regex.compile(
    rf"\b(?:{TITLED})\.?\x20({NAME}(?:\x20{NAME})?)|\b((?:{LISTED})\x20{NAME})"
)
# What every match of these has: texts without it need not be searched.
INTRODUCERS = (
    *("born", "birth", "dob", "gebor", "geburt", "née le", "né le", "naissance", "nacid"),
    *("nacimiento", "passport", "reisepass", "passeport", "pasaporte"),
)
NUMBERED = re.compile(r"\d\x20[^\W\d_a-z]|(?:straße|strasse|weg|platz|allee)\x20\d")
COLONS = re.compile(r":[0-9A-Fa-f]{0,4}:")
CALLED = {name for known in (TITLES, POOL) for word in known for name in (word, word.upper())}
LETTERS_OF = re.compile(r"[^\W\d_]+")
WORD = regex.compile(r"[\p{L}\p{M}]+")
KINDS = ("email", "phone", "ip", "card", "ssn", "iban", "birth", "passport", "street", "person")
# Formats of one kind that are replaced each in its own way.
FORMATS = {"ip6": "ip", "strasse": "street"}


def parted(text: str) -> list[tuple[str, str, bool]]:
    """The characters of a text as (base letter in lower case, its marks, whether upper)."""
    found = []
    for c in unicodedata.normalize("NFC", text):
        base, *marks = unicodedata.normalize("NFD", c)
        low = base.lower()
        found.append((low, "".join(marks), low != base) if len(low) == 1 else (base, "".join(marks), False))
    return found


class Cipher:
    """Keyed permutations of sequences of numbers, each below its own radix."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _number(self, tweak: str, turn: int, value: int) -> int:
        text = f"{tweak}|{turn}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=64).digest(), "big")

    def _turned(self, parts: list[int], sizes: list[int], tweak: str, back: bool) -> None:
        """An alternating Feistel network over two halves, or its inverse, in place."""
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            side = turn % 2
            shift = self._number(tweak, turn, parts[1 - side])
            parts[side] = (parts[side] + (-shift if back else shift)) % sizes[side]

    def permute(self, values: list[int], radices: list[int], tweak: str) -> list[int]:
        """The values that follow these on the ring of all, as mixed-radix numbers."""
        half = (len(values) + 1) // 2
        sizes = [prod(radices[:half]), prod(radices[half:])]
        parts = [0, 0]
        for i, (value, radix) in enumerate(zip(values, radices)):
            side = i >= half
            parts[side] = parts[side] * radix + value
        self._turned(parts, sizes, tweak, back=False)
        place = (parts[0] * sizes[1] + parts[1] + 1) % (sizes[0] * sizes[1])
        parts = list(divmod(place, sizes[1]))
        self._turned(parts, sizes, tweak, back=True)
        out = []
        for side, part in ((1, radices[half:]), (0, radices[:half])):
            for radix in reversed(part):
                parts[side], value = divmod(parts[side], radix)
                out.append(value)
        return out[::-1]

    def successor(self, value: str, pool: Sequence[str]) -> str:
        """The next of a pool in a keyed order, the first after the last."""
        ring = sorted(pool, key=lambda name: self._number("pool", 0, int.from_bytes(name.encode())))
        return ring[(ring.index(value) + 1) % len(ring)]

    def rewrite(self, text: str, alphabets: Callable[[int, str], str | None], tweak: str) -> str:
        """The text with each character moved within its alphabet; case and accents stay.

        ``alphabets`` gives the alphabet of the lower-cased base letter at a position, or
        None for one that stays. It must depend on nothing that the rewriting changes. Only
        a text without a letter that moves stays as it is.
        """
        letters = parted(text)
        at = [(i, a) for i, (c, _, _) in enumerate(letters) if (a := alphabets(i, c))]
        if not at:
            return text
        values = [a.index(letters[i][0]) for i, a in at]
        moved = self.permute(values, [len(a) for _, a in at], tweak)
        for (i, alphabet), value in zip(at, moved):
            letters[i] = (alphabet[value], *letters[i][1:])
        out = "".join((c.upper() if upper else c) + marks for c, marks, upper in letters)
        return unicodedata.normalize("NFC", out)


def within(*groups: Sequence[str]) -> Callable[[int, str], str | None]:
    """The first alphabet that holds the character."""
    alphabets = [a for group in groups for a in group]
    return lambda i, c: next((a for a in alphabets if c in a), None)


def luhn(digits: str) -> int:
    """The check digit that follows these digits."""
    doubled = [int(d) * (2 - i % 2) for i, d in enumerate(reversed(digits))]
    return -sum(d - 9 * (d > 9) for d in doubled) % 10


def iban_check(country: str, account: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in f"{account}{country}00")) % 97


def private(octets: list[int]) -> bool:
    a, b = octets[:2]
    return a in (0, 10, 127) or a >= 224 or (a, b) in ((192, 168), (169, 254)) or (
        a == 172 and 16 <= b < 32
    )


def refill(pattern: str, digits: str) -> str:
    """The pattern with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in pattern)


class Surrogates:
    """The replacement of every kind of entity, under one key."""

    def __init__(self, key: bytes):
        self.cipher = Cipher(key)
        self.of = lru_cache(100_000)(self._of)

    def _of(self, kind: str, value: str) -> str:
        return getattr(self, kind)(value)

    def numbers(self, digits: str, tweak: str) -> str:
        """Digits of the same length; a leading zero stays zero, others never become it."""
        first = next(a for a in FIRST_DIGITS if digits[0] in a)
        return self.cipher.rewrite(digits, lambda i, c: first if i == 0 else DIGITS[0], tweak)

    def email(self, value: str) -> str:
        end = value.rindex(".")
        body, top = value[:end], value[end:]
        return self.cipher.rewrite(body, within(LETTERS, DIGITS), f"email{top.lower()}") + top

    def phone(self, value: str) -> str:
        """The last ten digits at most change, so a country code stays and formats agree."""
        digits = re.sub(r"\D", "", value)
        own = digits[-10:] if len(digits) > 10 else digits
        return refill(value, digits[: len(digits) - len(own)] + self.numbers(own, "phone"))

    def ip(self, value: str) -> str:
        """Public addresses stay public; private ones keep their first two numbers."""
        octets = [int(x) for x in value.split(".")]
        if private(octets):
            return ".".join(map(str, octets[:2] + self.cipher.permute(octets[2:], [256] * 2, "ip2")))
        octets = self.cipher.permute(octets, [256] * 4, "ip")
        while private(octets):
            octets = self.cipher.permute(octets, [256] * 4, "ip")
        return ".".join(map(str, octets))

    def card(self, value: str) -> str:
        """The first digit stays; the check digit is right if it was, else as wrong as it was."""
        digits = re.sub(r"\D", "", value)
        body = digits[0] + self.cipher.rewrite(digits[1:-1], within(DIGITS), f"card{digits[0]}")
        check = (luhn(body) + int(digits[-1]) - luhn(digits[:-1])) % 10
        return refill(value, f"{body}{check}")

    def ssn(self, value: str) -> str:
        return refill(value, self.numbers(value.replace("-", ""), "ssn"))

    def iban(self, value: str) -> str:
        plain = value.replace(" ", "")
        country, check, account = plain[:2], int(plain[2:4]), plain[4:]
        new = self.cipher.rewrite(account, within(LETTERS, DIGITS), f"iban{country}")
        check = (iban_check(country, new) + check - iban_check(country, account) - 2) % 97 + 2
        letters = iter(f"{country}{check:02d}{new}")
        return "".join(c if c == " " else next(letters) for c in value)

    def ip6(self, value: str) -> str:
        """The first 32 bits, which tell the network's owner, stay."""
        address = IPv6Address(value)
        head, rest = divmod(int(address), 1 << 96)
        new = int(self.cipher.rewrite(f"{rest:024x}", within(HEX_DIGITS), f"ip6{head}"), 16)
        found = IPv6Address((head << 96) + new)
        text = found.exploded if "::" not in value else found.compressed
        return text.upper() if value != value.lower() else text

    def birth(self, value: str) -> str:
        """Another day of the same century, in the same format."""
        parts = [int(p) for p in re.split(r"[-./]", value)]
        year, month, day = parts if value[4:5] == "-" else parts[::-1]
        first = date(year // 100 * 100, 1, 1) if year >= 100 else date.min
        try:
            days = (date(year, month, day) - first).days
        except ValueError:
            return self.cipher.rewrite(value, within(DIGITS), "no date")
        size = (date(first.year + 99, 12, 31) - first).days + 1
        number = list(divmod(days, 192))
        while True:
            number = self.cipher.permute(number, [192, 192], f"birth{first.year}")
            if (days := number[0] * 192 + number[1]) < size:
                break
        new = first + timedelta(days)
        mark = value[4] if value[4:5] == "-" else re.search(r"[./]", value)[0]
        ordered = (f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}")
        return mark.join(ordered if mark == "-" else ordered[::-1])

    def passport(self, value: str) -> str:
        return self.cipher.rewrite(value, within(LETTERS, DIGITS), "passport")

    def street(self, value: str) -> str:
        """Number and name change, the kind of street stays."""
        number, *names, kind = value.split(" ")
        return " ".join([self.numbers(number, "house"), *map(self.name, names), kind])

    def strasse(self, value: str) -> str:
        name, number = value.rsplit(" ", 1)
        kind = re.search(r"(?:straße|strasse|weg|platz|allee)$", name)[0]
        digits = re.match(r"\d+", number)[0]
        house = self.numbers(digits, "house") + number[len(digits) :]
        return f"{self.name(name[: -len(kind)])}{kind} {house}"

    def name(self, value: str) -> str:
        """A name, by its words."""
        return WORD.sub(lambda m: self.person(m[0]), value)

    def person(self, value: str) -> str:
        """One word of a name.

        A name of the list becomes another of its gender and script, never itself. Others
        keep their script, length, vowels' places and last letter (which often tells the
        gender), but where that is all they have. One in capitals is the same name.
        """
        if len(value) > 1 and value.isupper():
            plain = value[0] + value[1:].lower()
            # Only where the letters' case can be put back.
            if plain.upper() == value:
                return self.person(plain).upper()
        value = unicodedata.normalize("NFC", value)
        if names := POOL.get(value):
            return self.cipher.successor(value, names)
        inside = within(VOWELS, CONSONANTS)
        last = len(value) - 1
        movable = [i for i, (c, _, _) in enumerate(parted(value)) if inside(i, c)]
        kept = last if any(i != last for i in movable) else -1
        if not movable:
            # Letters of a script without an alphabet here.
            digest = self.cipher._number("other", 0, int.from_bytes(value.encode()))
            return sorted(POOL)[digest % len(POOL)]
        new = value
        while True:
            new = self.cipher.rewrite(new, lambda i, c: None if i == kept else inside(i, c), "person")
            if new not in POOL:
                return new


def is_address(value: str) -> bool:
    """Whether a text is an IPv6 address of more than a few short words around colons."""
    try:
        address = IPv6Address(value)
    except ValueError:
        return False
    groups = [g for g in value.split(":") if g]
    return int(address) >> 64 > 0 and len(groups) > 2 and any(c.isdigit() for c in value)


def replace_entities(text: str, surrogates: Surrogates) -> tuple:
    """The text with surrogates, and how many entities of each kind it had."""
    counts = dict.fromkeys(KINDS, 0)
    given: dict[tuple[str, str], str] = {}

    def given_to(kind: str, value: str) -> str:
        counts[FORMATS.get(kind, kind)] += 1
        new = given[kind, value] = surrogates.of(kind, value)
        return new

    def swap(match: re.Match) -> str:
        kind = match.lastgroup
        if kind == "ip6" and not is_address(match[0]):
            return match[0]
        return given_to(kind, match[0])

    def swap_last(match: regex.Match) -> str:
        kind, value = match.lastgroup, match[match.lastgroup]
        before = match[0][: match.start(kind) - match.start()]
        return before + given_to(kind, value)

    new = ADDRESS.sub(swap, text) if COLONS.search(text) else text
    new = ENTITY.sub(swap, new)
    lower = new.lower()
    if any(word in lower for word in INTRODUCERS):
        new = INTRODUCED.sub(swap_last, new)
    if NUMBERED.search(new):
        new = STREET.sub(swap_last, new)
    # All words of names that are introduced anywhere change wherever they stand.
    named = () if CALLED.isdisjoint(LETTERS_OF.findall(new)) else PERSON.finditer(new)
    people = {w for m in named for w in WORD.findall(m[1] or m[2]) if len(w) > 1}
    if people:
        plain = {w[0] + w[1:].lower() if w.isupper() else w for w in people}
        listed = sorted({*plain, *(w.upper() for w in plain), *people}, key=len, reverse=True)
        found = "|".join(map(re.escape, listed))
        new = regex.sub(rf"(?<![\p{{L}}\p{{M}}])(?:{found})(?![\p{{L}}\p{{M}}])", lambda m: given_to("person", m[0]), new)
    # Two entities of one kind and format never share a surrogate.
    shared = len(given) - len({(k, v) for (k, _), v in given.items()})
    return (new, *counts.values(), shared)


def surrogate_fields(text: str):
    counts = {f"n_{kind}": LongType() for kind in KINDS}
    return fields(**{text: StringType()}, **counts, n_shared=LongType())


def replace_pii(docs: DataFrame, key: bytes, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row, its ``text`` with surrogates, and counts per kind.

    ``n_shared`` counts entities of a document that share a surrogate with another one;
    it is 0 unless the permutation is broken. A null text becomes an empty one; repeated
    rows stay and get equal surrogates; no shuffle.
    """

    def make():
        surrogates = Surrogates(key)
        return lambda text: replace_entities(text, surrogates)

    return map_texts(docs, keep, surrogate_fields("text"), make)
