"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

A value is validated (Luhn sum, calendar date, octets, area and group numbers, number of digits, IBAN check), mapped to
a number below the size of its format, permuted among those numbers (Feistel network on the next even number of bits,
cycle walking) and written back in the same format: digits stay digits, punctuation and capitals stay, a card number
keeps a valid Luhn sum, a social security number a valid area, group and serial, a date stays a date. The number that is
permuted is the canonical value, without spelling: a phone number in three spellings, an address in capitals and a date
in four notations have linked pseudonyms. The key and the format alone determine the result, so equal values get equal
pseudonyms in every document, different values of a format different ones, the key holder can undo it, and no value
with more than one possible value is its own pseudonym (the permutation is P^-1(P(x) + 1), a single cycle).

Dates: two digits a day and month; day before month where both could be, month first where only that is a date; years
1900 to 2099 stay among themselves, other years too. Secrets have no longest length; runs of more than PIECE characters
are permuted piece by piece.

Cases: a null text stays null and an empty one empty; other columns are kept as they are; numbers that fail their
check are left alone; whole texts are read, whatever their length; rows, repeated or not, are rewritten each; a column
that has the name of `count_col` is replaced.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget_others, table

#: Session setting that holds the key; a session without one draws a random key and keeps it.
KEY_CONF = "trackloom.pii.key"
ROUNDS = 8
PIECE = 128
CACHE = 100_000
_LAST = datetime.date.max.toordinal()
_LO, _HI = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal()
#: Fixed values of E.164: country codes of one and of two digits; all others have three.
ONE_DIGIT = ("1", "7")
TWO_DIGITS = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54",
    "55", "56", "57", "58", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)

#: Each with what a text must hold for the pattern to be tried: most texts are passed over by a byte search.
_EMAIL = re.compile(r"(?P<email>[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9\-]{1,63}(?:\.[A-Za-z0-9\-]{1,63}){1,8})")
_SECRET = re.compile(
    r"""(?P<secret>(?<![A-Za-z0-9])(?:
    (?i:passw(?:or)?d|token|secret|api[_-]?key)[ ]{0,2}[=:][ ]{0,2}["']?(?=[A-Za-z0-9_\-+/.~]{8})[A-Za-z0-9_\-+/](?:[A-Za-z0-9_\-+/.~]*[A-Za-z0-9_\-+/])?={0,2}
    |AKIA[0-9A-Z]{16}(?![A-Za-z0-9])))""",
    re.X,
)
_NUMBER = re.compile(
    r"""(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:[ ][A-Z0-9]{4}){2,7}(?:[ ][A-Z0-9]{1,3})?)(?![A-Za-z0-9]))
    |(?P<ip>(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9]))
    |(?P<iso>(?<![0-9A-Za-z\-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z]))
    |(?P<day>(?<![0-9A-Za-z./])[0-9]{2}(?:\.[0-9]{2}\.|/[0-9]{2}/)[0-9]{4}(?![0-9A-Za-z]))
    |(?P<phone>(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .\-]?)?\([0-9]{2,4}\)[ ]?[0-9]{3,4}[ .\-][0-9]{3,4}(?![0-9A-Za-z])
        |(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .\-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z])
        |(?<![0-9A-Za-z+.\-])[2-9][0-9]{2}(?P<dot>[.\-])[2-9][0-9]{2}(?P=dot)[0-9]{4}(?![0-9A-Za-z\-]|\.[0-9]))
    |(?P<ssn>(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-]))
    |(?P<card>(?<![0-9A-Za-z])[0-9](?:[ \-]?[0-9]){12,18}(?![0-9A-Za-z]))""",
    re.X,
)
_KINDS = ("iban", "ip", "iso", "day", "phone", "ssn", "card")
_HINTS = re.compile("[Pp]ass|[Tt]oken|[Ss]ecret|[Aa]pi|PASS|TOKEN|SECRET|API|AKIA")
_DIGIT = re.compile("[0-9]")


def find(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, kind) that look like personal data; of overlapping ones the first, the longer at a tie."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), "email") for m in _EMAIL.finditer(text)]
    if _HINTS.search(text):
        found += [(m.start(), m.end(), "secret") for m in _SECRET.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), next(k for k in _KINDS if m[k] is not None)) for m in _NUMBER.finditer(text)]
    found.sort(key=lambda x: (x[0], -x[1]))
    out: list[tuple[int, int, str]] = []
    for x in found:
        if not out or x[0] >= out[-1][1]:
            out.append(x)
    return out


def permute(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1."""
    if size < 2:
        return x
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    n = (half + 7) // 8
    salt = tweak.encode()
    if n + 8 <= 64:
        f = lambda v, r: hashlib.blake2b(v.to_bytes(n, "big") + bytes([r]) + salt, key=key[:64], digest_size=n + 8).digest()
    else:
        f = lambda v, r: hashlib.shake_256(len(key).to_bytes(4, "big") + key + v.to_bytes(n, "big") + bytes([r]) + salt).digest(n + 8)
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    while True:
        a, b = x >> half, x & mask
        for r in order:
            if back:
                a, b = b ^ (int.from_bytes(f(a, r), "big") & mask), a
            else:
                a, b = b, a ^ (int.from_bytes(f(b, r), "big") & mask)
        x = a << half | b
        if x < size:
            return x


def move(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0..size-1 that moves every number, if there are two or more."""
    if size < 2:
        return x
    return permute((permute(x, size, key, tweak) + (-1 if back else 1)) % size, size, key, tweak, True)


def _index(text: str, classes: list[tuple[str, int]]) -> tuple[int, int]:
    x, size = 0, 1
    for c, (base, n) in zip(text, classes):
        x, size = x * n + (ord(c) - ord(base) if n > 1 else 0), size * n
    return x, size


def move_chars(text: str, key: bytes, kind: str, back: bool = False) -> str:
    """Digits, small and capital ASCII letters each among their like; everything else stays in place."""
    whole = []
    for at in range(0, len(text), PIECE):
        piece = text[at : at + PIECE]
        classes = [("0", 10) if "0" <= c <= "9" else ("a", 26) if "a" <= c <= "z" else ("A", 26) if "A" <= c <= "Z" else (c, 1) for c in piece]
        x = move(*_index(piece, classes), key, f"{kind}|{at}|" + "".join(b for b, _ in classes), back)
        out = []
        for base, n in reversed(classes):
            x, d = divmod(x, n)
            out.append(chr(ord(base) + d))
        whole += reversed(out)
    return "".join(whole)


def _refill(text: str, fill: str) -> str:
    """The letters and digits of a text replaced in turn; everything else stays."""
    it = iter(fill)
    return "".join(next(it) if c.isalnum() else c for c in text)


def _like(pattern: str, text: str) -> str:
    """text with capitals where the pattern has them."""
    return "".join(c.upper() if p.isupper() else c for p, c in zip(pattern, text))


def luhn(digits: str) -> int:
    """The check digit of the digits before it."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def _iban_check(s: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in s[4:] + s[:2] + "00")) % 97


def _date_class(n: int) -> tuple[bool, bool]:
    """Dates stay among those of this or another time, and among those whose day could be a month or could not."""
    return _LO <= n < _HI, datetime.date.fromordinal(n).day <= 12


def _move_date(n: int, key: bytes, back: bool) -> int:
    of = _date_class(n)
    while True:
        if of[0]:
            n = _LO + move(n - _LO, _HI - _LO, key, "date", back)
        else:
            x = move(n - 1 if n < _LO else n - 1 - (_HI - _LO), _LAST - (_HI - _LO), key, "far date", back)
            n = x + 1 if x + 1 < _LO else x + 1 + (_HI - _LO)
        if _date_class(n) == of:
            return n


def _national(digits: str) -> bool:
    """Whether ten digits are a number of the North American plan."""
    return len(digits) == 10 and digits[0] > "1" and digits[3] > "1"


def _move_phone(code: str, digits: str, key: bytes, back: bool) -> str:
    if code == "1" and _national(digits):
        area, office = int(digits[:3]) - 200, int(digits[3:6]) - 200
        x = move((area * 800 + office) * 10_000 + int(digits[6:]), 800 * 800 * 10_000, key, "phone|1", back)
        return f"{x // 10_000 // 800 + 200}{x // 10_000 % 800 + 200}{x % 10_000:04d}"
    while True:
        digits = move_chars(digits, key, f"phone|{code}", back)
        if not (code == "1" and _national(digits)):
            return digits


def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    """The pseudonym of a value (or the value of a pseudonym); None if the value fails its check."""
    digits = "".join(c for c in value if "0" <= c <= "9")
    if kind == "card":
        if luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        body = digits[:-1]
        while True:  # all digits alike is no card number
            body = move_chars(body, key, "card", back)
            if len(set(new := body + str(luhn(body)))) > 1:
                return _refill(value, new)
    if kind in ("iso", "day"):
        day_first = kind == "day" and not int(digits[2:4]) > 12
        y, m, d = (digits[:4], digits[4:6], digits[6:]) if kind == "iso" else (digits[4:], digits[2:4], digits[:2]) if day_first else (digits[4:], digits[:2], digits[2:4])
        if kind == "day" and not day_first and "." in value:
            return None
        try:
            n = datetime.date(int(y), int(m), int(d)).toordinal()
        except ValueError:
            return None
        t = datetime.date.fromordinal(_move_date(n, key, back))
        y, m, d = f"{t.year:04d}", f"{t.month:02d}", f"{t.day:02d}"
        return _refill(value, y + m + d if kind == "iso" else d + m + y if day_first else m + d + y)
    if kind == "ip":
        octets = [int(o) for o in value.split(".")]
        if max(octets) > 255 or value != ".".join(map(str, octets)):
            return None
        x = move(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip", back)
        return ".".join(map(str, x.to_bytes(4, "big")))
    if kind == "phone":
        if not 8 <= len(digits) <= 15:
            return None
        code = "1" if len(digits) == 10 else ""
        if value.startswith("+"):
            code = digits[:1] if digits[0] in ONE_DIGIT else digits[:2] if digits[:2] in TWO_DIGITS else digits[:3]
            return _refill(value, code + _move_phone(code, digits[len(code) :], key, back))
        return _refill(value, _move_phone(code, digits, key, back))
    if kind == "ssn":
        area, group, serial = int(digits[:3]), int(digits[3:5]), int(digits[5:])
        if area in (0, 666) or area > 899 or not group or not serial:
            return None
        x = move(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, key, "ssn", back)
        area = x // 9999 // 99 + 1
        return _refill(value, f"{area + (area >= 666):03d}{x // 9999 % 99 + 1:02d}{x % 9999 + 1:04d}")
    if kind == "iban":
        plain = value.replace(" ", "")
        if len(plain) < 15 or _iban_check(plain) != int(plain[2:4]):
            return None
        body = move_chars(plain[4:], key, "iban|" + plain[:2], back)
        return _refill(value, f"{plain[:2]}{_iban_check(plain[:2] + '00' + body):02d}{body}")
    if kind == "email":
        head, _, tld = value.rpartition(".")
        local, _, host = head.partition("@")
        return f"{_like(local, move_chars(local.lower(), key, 'local', back))}@{_like(host, move_chars(host.lower(), key, 'host', back))}.{tld}"
    if kind == "secret":
        head = re.match(r"AKIA|[^=:]*[=:][ ]*[\"']?", value)[0]
        return head + move_chars(value[len(head) :], key, "secret", back)
    raise ValueError(kind)


def session_key(spark: SparkSession) -> bytes:
    """The key in KEY_CONF. Without one the session draws a random key: values are linked within it, and no one can undo
    them afterwards."""
    found = spark.conf.get(KEY_CONF, None)
    if not found:
        found = secrets.token_hex(32)
        spark.conf.set(KEY_CONF, found)
    return found.encode()


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """docs with pseudonyms in text_col; count_col, if given, gets the number of values replaced."""
    names = docs.columns
    schema = docs.schema if count_col is None else docs.withColumn(count_col, F.lit(0).cast("long")).schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        forget_others("pii")
        cache: dict[tuple[str, str], str | None] = {}

        def rewrite(t: str) -> tuple[str, int]:
            parts, at, n = [], 0, 0
            for start, end, kind in find(t):
                item = (kind, t[start:end])
                if item not in cache:
                    if len(cache) > CACHE:
                        cache.clear()
                    cache[item] = pseudonym(*item, key)
                if cache[item] is not None:
                    parts += [t[at:start], cache[item]]
                    at, n = end, n + 1
            return ("".join([*parts, t[at:]]) if n else t), n

        for b in batches:
            texts, counts = [], []
            for t in b.column(names.index(text_col)).to_pylist():
                new, n = rewrite(t) if t else (t, 0)
                texts.append(new)
                counts.append(n)
            cols = {c: pa.array(texts, b.schema.field(i).type) if c == text_col else b.column(i) for i, c in enumerate(names)}
            if count_col is not None:
                cols[count_col] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return docs.mapInArrow(run, schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark), count_col="n_replaced")
