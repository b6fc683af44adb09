"""Op 10, personal data: entities are replaced by surrogates.

Method: surrogate generation. Emails, phone and card numbers, IPv4 addresses, IBANs, social
security numbers and names behind a form of address are found and replaced by values of the same
type, script and format, given names by names of the gender that a list or the form of address
tells. Parts of such a name elsewhere in its text are replaced as in the name. A surrogate depends
on the key, the type, the entity and a told gender alone, so an entity has the same surrogate everywhere (coreference), however a number is
parted, on every executor and in every run. Family names keep no gender. Distinct entities get distinct surrogates by construction: the
characters of a format are permuted as one mixed-radix number by a keyed Feistel network, which is
a bijection. `collisions` checks the surrogates of all entities in the corpus, and
`replace_personal_data` raises where it finds one.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import steps, table

# --- fixed values --------------------------------------------------------------------------

# Names of each gender and script that stand for names of the same kind.
GIVEN_NAMES = {
    ("f", "latin"): "Alice Anna Clara Elena Emma Eva Helen Ida Jane Julia Laura Lena Lucia Maria Mary Nora Olivia Paula Rosa Sara".split(),
    ("m", "latin"): "Adam Albert Anton Carl David Emil Felix Frank George Hugo Jacob James John Leon Louis Martin Oscar Paul Peter Thomas".split(),
    ("f", "cyrillic"): "Анна Вера Елена Ирина Мария Нина Ольга София".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Иван Кирилл Максим Олег Павел".split(),
}

ADDRESS = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "Don": "m", "Господин": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Lady": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "Doña": "f", "Госпожа": "f",
    "Dr": "", "Prof": "", "Professor": "",
}

# Letters and digits that a character may be exchanged for: its own group.
_GROUPS = [
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "àâäáãåæçèéêëìíîïñòóôöõøùúûüýßœ",
    "ÀÂÄÁÃÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÖÕØÙÚÛÜÝŒ",
    "абвгдежзийклмнопрстуфхцчшщъыьэюяё",
    "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯЁ",
    "αβγδεζηθικλμνξοπρστυφχψω",
    "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "٠١٢٣٤٥٦٧٨٩",
]
# Calling codes of countries: one digit in two zones, two or three in the others.
CALLING_CODE = re.compile(
    r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
)

_GROUP_OF = {c: g for g in _GROUPS for c in g}


@cache
def _block(number: int, category: str) -> str:
    """Characters of a category among 256 code points side by side, which share a script."""
    return "".join(c for c in map(chr, range(256 * number, 256 * number + 256)) if unicodedata.category(c) == category)


def _group(c: str) -> str | None:
    """What a letter or digit may be exchanged for; None for other characters and for one that
    stands alone."""
    if (group := _GROUP_OF.get(c)) is not None:
        return group
    if not (c.isalpha() or c.isdecimal()):
        return None
    group = _block(ord(c) >> 8, unicodedata.category(c))
    listed = "".join(x for x in group if x not in _GROUP_OF)
    return listed if len(listed) > 1 else None

# --- detection -----------------------------------------------------------------------------

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_TITLE = "|".join(sorted(ADDRESS, key=len, reverse=True))
_NAME = r"[^\W\d_a-zа-яёα-ωà-öø-ÿ][^\W\d_]+(?:[-'][^\W\d_]+)*"

# Types in the order in which they claim text.
EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
NUMBERS = [
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("ip", re.compile(rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])")),
    ("card", re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,3})?)(?![0-9])")),
    ("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("phone", re.compile(r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,5}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])\+[0-9]{8,15}(?![0-9])")),
]
NAME = re.compile(rf"\b(?P<title>{_TITLE})\b\.? (?P<name>{_NAME}(?: {_NAME}){{0,2}})")
_DIGIT = re.compile("[0-9]")


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, gender) of all entities, none overlapping, by start."""
    found: list[tuple[int, int, str, str]] = []

    def claim(start: int, end: int, kind: str, gender: str = "") -> None:
        # Claims are in order and apart, so only the two beside a new one can meet it.
        at = bisect_left(found, (start,))
        if (at and found[at - 1][1] > start) or (at < len(found) and found[at][0] < end):
            return
        found.insert(at, (start, end, kind, gender))

    if "@" in text:
        for m in EMAIL.finditer(text):
            claim(*m.span(), "email")
    if _DIGIT.search(text):
        for kind, pattern in NUMBERS:
            for m in pattern.finditer(text):
                claim(*m.span(), kind)
    for m in NAME.finditer(text):
        claim(*m.span("name"), "name", ADDRESS[m["title"]])
    return found


# --- surrogates ----------------------------------------------------------------------------


class Surrogates:
    """Keyed bijections from entities to values of the same type and format."""

    ROUNDS = 8

    def __init__(self, key: bytes):
        self._key = key

    def _number(self, tweak: str, step: int, value: int | str, below: int) -> int:
        message = f"{tweak}\0{step}\0{value}".encode()
        return int.from_bytes(hmac.digest(self._key, message, "sha256")) % below

    def permuted(self, value: int, left: int, right: int, tweak: str) -> int:
        """A bijection of 0 .. left * right - 1 that leaves no value as it is, if there are two.

        Values are mixed, shifted by a number other than 0, and mixed back. Mixing shifts halves by
        hashes of each other."""
        size = left * right
        a, b = divmod(value, right)
        for step in range(self.ROUNDS):
            a = (a + self._number(tweak, 2 * step, b, left)) % left
            b = (b + self._number(tweak, 2 * step + 1, a, right)) % right
        shift = 1 + self._number(tweak, 2 * self.ROUNDS, "shift", max(size - 1, 1))
        a, b = divmod((a * right + b + shift) % size, right)
        for step in range(self.ROUNDS - 1, -1, -1):
            b = (b - self._number(tweak, 2 * step + 1, a, right)) % right
            a = (a - self._number(tweak, 2 * step, b, left)) % left
        return a * right + b

    def _characters(self, text: str, tweak: str) -> str:
        """Each character becomes one of its group; others stay. Texts of one format, that is
        groups and other characters, are permuted among themselves."""
        groups = [_group(c) for c in text]
        radices = [len(g) for g in groups if g]
        if not radices:
            return text
        half = len(radices) // 2
        left = right = 1
        for radix in radices[:half]:
            left *= radix
        for radix in radices[half:]:
            right *= radix
        value = 0
        for c, g in zip(text, groups):
            if g:
                value = value * len(g) + g.index(c)
        shape = "".join(g[0] if g else c for c, g in zip(text, groups))
        value = self.permuted(value, left, right, f"{tweak}\0{shape}")
        out = []
        for c, g in zip(reversed(text), reversed(groups)):
            if g:
                value, at = divmod(value, len(g))
                c = g[at]
            out.append(c)
        return "".join(reversed(out))

    def email(self, text: str) -> str:
        body, _, top = text.rpartition(".")
        return f"{self._characters(body.lower(), 'email')}.{top.lower()}"

    def ip(self, text: str) -> str:
        value = 0
        for octet in text.split("."):
            value = value * 256 + int(octet)
        value = self.permuted(value, 1 << 16, 1 << 16, "ip")
        return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))

    def card(self, text: str) -> str:
        """The last digit keeps its distance from the check digit, so valid numbers stay valid."""
        plain = normal("card", text)
        off = (int(plain[-1]) - _luhn(plain[:-1])) % 10
        body = self._characters(plain[:-1], "card")
        return _written_like(text, f"{body}{(_luhn(body) + off) % 10}")

    def iban(self, text: str) -> str:
        plain = normal("iban", text)
        off = (int(plain[2:4]) - _iban_check(plain)) % 97
        body = self._characters(plain[4:], f"iban\0{plain[:2]}")
        check = _iban_check(f"{plain[:2]}00{body}")
        return _written_like(text, f"{plain[:2]}{(check + off) % 97:02d}{body}")

    def phone(self, text: str) -> str:
        """The calling code stays, whether it stands apart or not."""
        plain = normal("phone", text)
        head = CALLING_CODE.match(plain)[0] if plain[0] == "+" else ""
        rest = self._characters(plain[len(head) :], f"phone\0{head}")
        return _written_like(text, head.removeprefix("+") + rest)

    def ssn(self, text: str) -> str:
        return self._characters(text, "ssn")

    def _name_part(self, part: str, given: list[str] | None, others: set[str], tweak: str) -> str:
        if given and part in given:
            return given[self.permuted(given.index(part), 1, len(given), f"{tweak}\0given")]
        # Walks on until it leaves the listed names, so that it meets none of their surrogates.
        while (part := self._characters(part, tweak)) in others:
            pass
        return part

    def name(self, text: str, gender: str) -> str:
        """Parts one by one, so a family name alone has the surrogate it has in the full name.
        A given name of the lists becomes one of the same gender and script. Another one, whose
        gender the form of address tells, becomes a listed name of that gender and its own
        script, joined to a surrogate that tells it from others."""
        first, *rest = text.split(" ")
        listed = next((n for n in GIVEN_NAMES.values() if rest and first in n), None)
        every = {n for names in GIVEN_NAMES.values() for n in names}
        if gender := told_gender(text, gender):
            names = GIVEN_NAMES[gender, _script(first)]
            own = self._characters(first, f"name\0{gender}")
            parts = [f"{names[self._number('given', 0, own, len(names))]}-{own}"]
        else:
            parts = [self._name_part(first, listed, every, "name")]
        return " ".join([*parts, *[self._name_part(p, None, set(), "name") for p in rest]])

    def of(self, kind: str, text: str, gender: str = "") -> str:
        return self.name(text, gender) if kind == "name" else getattr(self, kind)(text)


def _luhn(digits: str) -> int:
    """The check digit behind `digits`; separators are passed over."""
    total = 0
    for place, c in enumerate(reversed([c for c in digits if c in _GROUPS[0]])):
        double = int(c) * (2 if place % 2 == 0 else 1)
        total += double - 9 if double > 9 else double
    return -total % 10


def _iban_check(text: str) -> int:
    plain = text.replace(" ", "")
    number = int("".join(str(int(c, 36)) for c in plain[4:] + plain[:2] + "00"))
    return (98 - number % 97) % 97


def normal(kind: str, text: str) -> str:
    """The form under which mentions are the same entity: numbers without separators."""
    if kind in ("card", "iban", "phone"):
        return re.sub("[^0-9A-Z+]", "", text)
    return text.lower() if kind == "email" else text


def _written_like(text: str, plain: str) -> str:
    """`plain` with the separators of `text`, which has as many letters and digits."""
    left = iter(plain)
    return "".join(next(left) if c.isalnum() else c for c in text)


def _script(name: str) -> str:
    group = _GROUP_OF.get(name[0])
    return {_GROUPS[2]: "latin", _GROUPS[4]: "latin", _GROUPS[6]: "cyrillic"}.get(group, "")


def told_gender(name: str, gender: str) -> str:
    """`gender` if a given name needs it: one that is in no list of that gender."""
    first, *rest = name.split(" ")
    if not gender or not rest or not _script(first):
        return ""
    return "" if first in GIVEN_NAMES[gender, _script(first)] else gender


def mentions(text: str, surrogates: Surrogates) -> list[tuple[int, int, str, str, str | None]]:
    """(start, end, type, surrogate, entity) of all entities by start, and of all other places
    that have a part of a found name, whose entity is None.

    A name whose form of address tells no gender has the one that other mentions of the same name
    or family name in the text agree on.
    """
    found = entities(text)
    named = [(text[s:e], g) for s, e, kind, g in found if kind == "name"]
    genders: dict[str, set[str]] = {}
    for name, gender in named:
        if gender:
            for known in (name, name.split(" ")[-1]):
                genders.setdefault(known, set()).add(gender)
    out, parts = [], {}
    for start, end, kind, gender in found:
        value = text[start:end]
        entity = normal(kind, value)
        if kind == "name":
            told = genders.get(value) or genders.get(value.split(" ")[-1]) or set()
            if not gender and len(told) == 1:
                (gender,) = told
            # The gender is part of the entity where its surrogate depends on it.
            told_here = told_gender(value, gender)
            entity = f"{value} ({told_here})" if told_here else value
        new = surrogates.of(kind, value, gender)
        out.append((start, end, kind, new, entity))
        if kind == "name":
            for part, own in zip(value.split(" "), new.split(" ")):
                parts.setdefault(part, own)
    if parts:
        longest = sorted(parts, key=len, reverse=True)
        bare = re.compile(rf"\b(?:{'|'.join(map(re.escape, longest))})\b")
        taken = bytearray(len(text))
        for start, end, *_ in out:
            taken[start:end] = b"\1" * (end - start)
        for m in bare.finditer(text):
            if not any(taken[m.start() : m.end()]):
                out.append((*m.span(), "name", parts[m[0]], None))
    return sorted(out, key=lambda row: row[:2])


# --- Spark ---------------------------------------------------------------------------------

# Whoever knows the key can undo the surrogates, so there is no key by default. The query takes its
# key from this setting of the session, and for test tables, where it is unset, uses a public one.
KEY_SETTING = "commentscope.pii.key"
TEST_KEY = b"a public key, for test tables only"


def surrogate_table(
    documents: DataFrame, *, key: bytes, text: str = "text"
) -> DataFrame:
    """Distinct `type`, `entity`, `surrogate` of all texts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in steps(batches, "text"):
            rows = set()
            for value in batch.column("text").to_pylist():
                for _, _, kind, new, entity in mentions(value or "", surrogates):
                    if entity is not None:
                        rows.add((kind, entity, normal(kind, new)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("type", "entity", "surrogate"), row)) for row in sorted(rows)],
                pa.schema([(n, pa.string()) for n in ("type", "entity", "surrogate")]),
            )

    return (
        documents.select(F.col(text).alias("text"))
        .mapInArrow(scan, "type string, entity string, surrogate string")
        .distinct()
    )


def collisions(surrogates: DataFrame) -> DataFrame:
    """Surrogates that more than one entity got, entities that got more than one surrogate, and
    entities that stayed as they are."""
    merged = surrogates.groupBy("type", F.col("surrogate").alias("value")).agg(
        F.count("*").alias("n")
    )
    split = surrogates.groupBy("type", F.col("entity").alias("value")).agg(F.count("*").alias("n"))
    kept = surrogates.where(F.col("entity") == F.col("surrogate")).select(
        "type", F.col("entity").alias("value"), F.lit(2).cast("bigint").alias("n")
    )
    return merged.unionByName(split).where(F.col("n") > 1).unionByName(kept)


def replace_personal_data(
    documents: DataFrame,
    *,
    key: bytes,
    text: str = "text",
    check: bool = True,
) -> DataFrame:
    """`documents` with surrogates for the entities in `text`, and `entities`, an array of
    (type, start, end, surrogate) with places in the old text as code points.

    Null texts stay null and have no entities; other columns and repeated rows stay as they are,
    but for a column `entities`, which is replaced. Whole texts are read however long, in time that
    grows with them; of overlapping finds the first type in order keeps its place.
    With `check`, a job over all entities first raises if two of them share a surrogate.
    """
    if check and (clash := collisions(surrogate_table(documents, key=key, text=text)).first()):
        raise ValueError(f"surrogates are not distinct: {clash['type']}")
    documents = documents.drop("entities")
    entity = pa.list_(
        pa.struct(
            [("type", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("surrogate", pa.string())]
        )
    )

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key)
        for batch in steps(batches, text):
            texts, found = [], []
            for value in batch.column(text).to_pylist():
                rows, parts, done = [], [], 0
                for start, end, kind, new, _ in mentions(value or "", surrogates):
                    parts += [value[done:start], new]
                    done = end
                    rows.append({"type": kind, "start": start, "end": end, "surrogate": new})
                texts.append(value if not rows else "".join([*parts, value[done:]]))
                found.append(rows)
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, text, pa.array(texts, pa.string())).append_column(
                "entities", pa.array(found, entity)
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes)
    return documents.mapInArrow(
        replace,
        f"{schema}, entities array<struct<type: string, start: bigint, end: bigint, surrogate: string>>",
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    key = spark.conf.get(KEY_SETTING, None)
    return replace_personal_data(documents, key=key.encode() if key else TEST_KEY).select(
        "doc_id", "text", F.size("entities").cast("long").alias("n_entities"), "entities"
    )
