"""Personal data by candidate spans and gradient-boosted trees.

Base spans are those of four plain patterns with their checks (octets, Luhn,
digit counts); they always stay. Further generators with high recall propose
overlapping spans in looser formats: addresses that are spelled out, national
telephone numbers, grouped card numbers, defanged and long IP addresses, and three
kinds that have no base pattern: social security numbers, bank accounts (IBAN) and
secrets (passwords, tokens, keys). Boosted trees score each proposal from its format
and its context, the scores are calibrated on held-out examples, and each kind has
a threshold that held a precision of ``PRECISION`` there. Of overlapping proposals
the best one is taken. None may cut a base span; accounts and secrets may cover one.

The trees are trained on ``TRAINING_ROWS`` labelled examples that ``examples``
makes from a seed, so that the model depends on no corpus and is equal on every
run. It holds ``ROUNDS`` trees of depth ``DEPTH`` and is shipped with the tasks.

Defined results: a null or empty text has no spans; offsets count code points,
end exclusive; every row is handled on its own, so repeated rows repeat their
result, other columns are ignored, and the plan has no shuffle.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.arrow_text import release, slices
from gleanmill.session import table

KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "secret")
BASE_KINDS = KINDS[:4]
EMAIL, IP, CARD, PHONE, SSN, IBAN, SECRET = range(7)
TRAINING_ROWS = 20_000
ROUNDS, DEPTH, RATE, BINS = 80, 4, 0.2, 32
PRECISION = 0.97
CONTEXT = 40
#: Bytes of text handled at a time.
SLICE = 1 << 20

_SOME = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: linear for any text."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted."""
    if not _SOME.search(text):
        return []
    found = [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(found)


_WORD_AT = re.compile(r"at(?=[\s\])}>])")
_SPELLED = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[({<]\s?(?:dot|punkt|point|punto)\s?[\])}>]\s?|\s(?:dot|punkt|point|punto)\s)[A-Za-z0-9-]{1,63}){1,6}", re.I)
#: One of these is in every text that names a secret.
_SECRET_WORDS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "contraseña")
_PATTERNS = (
    (IP, re.compile(r"\[\.\]|\(\.\)"), re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.)[0-9]{1,3}){3}(?![0-9])")),
    (IP, re.compile(r":[0-9a-fA-F:]"), re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9a-fA-F]{1,4}:){2,7}(?::?[0-9a-fA-F]{1,4})(?::[0-9a-fA-F]{1,4}){0,5}(?![0-9A-Za-z:])")),
    (CARD, _DIGIT, re.compile(r"(?<![0-9])[0-9]{4}(?:[./_ -]{1,2}[0-9]{4}){2}[./_ -]{1,2}[0-9]{1,7}(?![0-9])")),
    (CARD, _DIGIT, re.compile(r"(?<![0-9])[0-9]{12,19}(?![0-9])")),
    (PHONE, _DIGIT, re.compile(r"(?<![A-Za-z0-9])\(?[0-9]{1,5}\)?(?:[\x20./-]{1,3}\(?[0-9]{2,8}\)?){1,6}(?![A-Za-z0-9])")),
    (PHONE, _DIGIT, re.compile(r"(?<![A-Za-z0-9])0[0-9]{7,14}(?![A-Za-z0-9])")),
    (SSN, _DIGIT, re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9A-Za-z-])")),
    (IBAN, _DIGIT, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])")),
    (SECRET, None, re.compile(
        r"(?:passw(?:or)?[dt]|passphrase|pwd|secret|token|key|auth\w*|bearer|credentials?|contraseña|mot de passe)(?:[_-][A-Za-z]{1,20})*[\"']?\s?(?:[:=]|is|ist|est|es)?\s?(?:[\"'])?([A-Za-z0-9+/_.=~!@#$%^&*-]{6,200})", re.I)),
    (SECRET, _DIGIT, re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_-]{20,400}={0,2}(?![A-Za-z0-9+/_-])")),
)


def _signs(text: str, low: str) -> Iterator[tuple[int, int]]:
    """Where something may stand for the sign in an address: "@", " at " or "at" in brackets, with a blank on either side."""

    def blanks(a: int, b: int) -> tuple[int, int]:
        return a - (a > 0 and text[a - 1].isspace()), b + (b < len(text) and text[b].isspace())

    at = text.find("@")
    while at >= 0:
        yield blanks(at, at + 1)
        at = text.find("@", at + 1)
    for m in _WORD_AT.finditer(low):
        a, b = blanks(m.start(), m.end())
        if a and b < len(text) and text[a - 1] in "[({<" and text[b] in "])}>":
            yield blanks(a - 1, b + 1)
        elif a < m.start() and b > m.end():
            yield a, b


def _spelled(text: str, low: str) -> Iterator[tuple[int, int]]:
    """Addresses around anything that may stand for the sign, found outwards from there."""
    for a, b in _signs(text, low):
        domain = _SPELLED.match(text, b)
        start = a
        if domain:
            while start > 0 and a - start < 64 and text[start - 1] in _LOCAL:
                start -= 1
            if start < a:
                yield start, domain.end()


def rest_of_97(account: str) -> int:
    """The check of a bank account number: 1 if it holds."""
    plain = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _account(text: str, start: int, end: int) -> int:
    """The end of the longest run of whole groups that passes the check, or the end that was given."""
    for at in range(end, start + 14, -1):
        if (at == end or text[at : at + 1] == " ") and rest_of_97(text[start:at]) == 1:
            return at
    return end


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) that the generators propose, without what cuts a base span."""
    low = text.lower()
    if len(low) != len(text):  # letters whose small form is longer: places must stay the same
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    found = {(a, EMAIL, b) for a, b in _spelled(text, low)}
    digit, secret = _DIGIT.search(text) is not None, any(w in low for w in _SECRET_WORDS)
    for kind, hint, pattern in _PATTERNS:
        if not (secret if hint is None else digit and (hint is _DIGIT or hint.search(text))):
            continue
        for m in pattern.finditer(text):
            a, b = m.span(pattern.groups)
            if kind == PHONE and not 7 <= len(_digits(text[a:b])) <= 15:
                continue
            if kind == IBAN:
                b = _account(text, a, b)
            if kind == SECRET:
                while b > a and text[b - 1] in ".,":
                    b -= 1
                if b - a < 6:
                    continue
            found.add((a, kind, b))
    if not found or not base:
        return sorted(found)
    taken = sorted((a, b) for a, _, b in base)
    upto = list(itertools.accumulate((b for _, b in taken), max))
    starts = [a for a, _ in taken]
    return sorted(x for x in found if not _cuts(x, starts, taken, upto))


def _cuts(span: tuple[int, int, int], starts: list[int], taken: list[tuple[int, int]], upto: list[int]) -> bool:
    """Whether a span meets a base span, other than by covering it as an account or a secret."""
    a, kind, b = span
    i = bisect.bisect_left(starts, b) - 1
    while i >= 0 and upto[i] > a:
        if taken[i][1] > a and (kind < IBAN or taken[i][0] < a or taken[i][1] > b or (taken[i][0], taken[i][1]) == (a, b)):
            return True
        i -= 1
    return False


_SAYS = (
    re.compile(r"tel|phone|call|mobil|fax|anruf|ruf |appel|llam|tél|ring|reach|cell|handy|whatsapp|sms", re.I),
    re.compile(r"mail|contact|write|schreib|écri|correo|reach|send", re.I),
    re.compile(r"card|visa|carte|karte|tarjeta|payment|credit|master|amex", re.I),
    re.compile(r"\bip\b|host|server|address|adress|login|ipv|ping|dns", re.I),
    re.compile(r"version|release|build|isbn|order|invoice|ref|item|part|serial|page|chapter|section|art\.|nr\.|no\.|id\b|ticket|model|issue", re.I),
    re.compile(r"price|cost|eur|usd|total|km|kg|percent|year|date|born|since|sum|amount|between|population", re.I),
    re.compile(r"ssn|social|security|sozial|sécu|tax id", re.I),
    re.compile(r"iban|account|bank|konto|compte|cuenta|transfer|sepa", re.I),
    re.compile(r"passw|pwd|passphrase|secret|token|api.?key|access.?key|private.?key|_key|auth|bearer|credential|geheim|contraseñ|mot de passe", re.I),
    re.compile(r"commit|sha-?[0-9]|md5|checksum|digest|hash|uuid|etag|revision|blob|cache|sort|primary|foreign", re.I),
)
_TLDS = frozenset("com org net edu gov io co de fr es uk eu info biz it nl ch at be us ca au jp ru pl br in mx se no dk fi pt ie dev app me tv".split())
_SAID = re.compile(r"[A-Za-z]+")


def _entropy(part: str) -> float:
    counts = Counter(part)
    return -sum(n / len(part) * math.log2(n / len(part)) for n in counts.values())


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of one candidate."""
    a, kind, b = span
    part, left, right = text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + 8]
    digits = _digits(part)
    groups = [g for g in re.split(r"[^0-9A-Za-z]+", part) if g]
    sizes = [len(g) for g in groups] or [0]
    octets = re.findall(r"[0-9]+", part)
    letters = [c for c in part if c.isalpha()]
    words = _SAID.findall(part)
    short = part if len(part) <= 400 else part[:400]
    near = left[-14:]
    return [
        float(kind), float(len(part)), float(len(digits)), float(len(groups)), float(max(sizes)), float(min(sizes)), float(sizes[0]), float(sizes[-1]),
        float(12 <= len(digits) <= 19 and luhn(digits)), float(len(set(digits))), float(part.count(".")), float(part.count("-")), float(part.count("/")), float(part.count(" ")),
        float(part.count("(")), float(part.count("[")), float(part.count(":")), float(digits[:1] == "0"), float(digits[:2] == "00"), float(bool(octets) and all(len(o) <= 3 and int(o) <= 255 for o in octets)),
        float(len(letters)), float(sum(c.isupper() for c in letters)), float(bool(left) and (left[-1].isalnum() or left[-1] in "$#.,-/€+")), float(left[-1:] in ("$", "#", "€")),
        float(right[:1].isalnum() or right[:1] in ("%", "$", "€")), float(right[:1] in (".", "-", "/", ",") and right[1:2].isdigit()), *(float(bool(p.search(left))) for p in _SAYS),
        *(float(bool(p.search(near))) for p in (_SAYS[0], _SAYS[4], _SAYS[8], _SAYS[9])), float(bool(re.search(r"[\[(]\s?(?:at|dot)\s?[\])]|@", part, re.I))), float(bool(re.search(r"\sdot\s", part, re.I))),
        float(bool(words) and words[-1].lower() in _TLDS), float(len(words[-1]) if words else 0), float(len(digits) == 8 and len(groups) == 3), float(any(len(g) == 4 and g[:2] in ("19", "20") for g in groups)),
        float(kind == IBAN and rest_of_97(part) == 1), _entropy(short), len(digits) / len(part), float(all(c in "0123456789abcdefABCDEF" for c in part)), float(left[-1:] in "\"'=" and bool(left)),
        float(left[-1:] == "/" or "://" in left[-30:].rpartition(" ")[2]), float(bool(re.fullmatch(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}", part))), float(max(map(len, words), default=0)),
        float(bool(re.search(r"[.;,:!?]\s*\S*$", near)) and near[-1:] == " "), float(bool(re.search(r"[0-9]\s?$", left))), float(bool(re.match(r"\s?[0-9]", right))),
    ]


_FILLER = (
    "the of and in to is der die und das le la de et un el que los con para it was on for are by this erth onan inth we they looked at home noon then left stayed met "
    "him her there here again a good day at work at all at once at least my our dear please soon tomorrow heute demain mañana with from about after before more".split()
)
_CUES = {
    EMAIL: ("email", "mail me at", "contact", "write to", "Mail:", "correo", "adresse", "reach me:", "send it to"), IP: ("host", "IP", "server at", "login from", "address", "ping", "dns"),
    CARD: ("card", "credit card number", "visa", "Karte", "carte", "payment with", "amex"), PHONE: ("call", "phone", "tel.", "Tel:", "mobile", "fax", "appel", "Anruf", "ring me on", "cell", "Handy", "llame al", "text me at", "number is", "erreichen unter"),
    SSN: ("SSN", "social security number", "ssn:", "social security no."), IBAN: ("IBAN", "account", "Konto", "bank account:", "transfer to", "compte"),
    SECRET: ("password:", "password is", "token =", "api_key =", "API key:", "secret:", "Authorization: Bearer", "pwd=", "aws_secret_access_key =", "Passwort ist", "private key", "auth_token:", "secret_key=", "client-secret: ", 'token = "', "key="),
}
_OTHER = ("version", "order", "invoice no.", "ref", "ISBN", "item", "page", "price", "total", "build", "section", "date", "since", "serial", "part", "commit", "sha256", "md5", "checksum", "uuid", "ticket", "revision", "between", "sum of")
_HEX, _B64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _valid_card(rng: random.Random) -> str:
    body = str(rng.choice((4, 5, 3))) + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _number(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _of(rng: random.Random, signs: str, n: int) -> str:
    return "".join(rng.choice(signs) for _ in range(n))


def _grouped(text: str, n: int = 4) -> str:
    return " ".join(text[i : i + n] for i in range(0, len(text), n))


def _iban(rng: random.Random) -> str:
    country, n = rng.choice((("DE", 18), ("FR", 23), ("ES", 20), ("GB", 18), ("NL", 14), ("BE", 12), ("AT", 16), ("IT", 23)))
    body = (_of(rng, "ABCDEFGHIKLMNOPRSTUVW", 4) + _number(rng, n - 4)) if country in ("GB", "NL") else _of(rng, "0123456789" * 4 + "ABKLMRS" * rng.randint(0, 1), n)
    check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    whole = f"{country}{check:02d}{body}"
    return whole if rng.random() < 0.4 else _grouped(whole)


def _one(rng: random.Random, kind: int, good: bool) -> str:
    """A string that a generator of this kind proposes; good ones are personal data."""
    word = lambda least=2: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(least, 8)))
    if kind == EMAIL:
        tld = rng.choice(("com", "org", "net", "de", "fr", "es", "co.uk", "io", "edu", "info"))
        if good:
            at, dot = rng.choice(((" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "."), ("@", " dot "), (" [at] ", "."), (" @ ", "."), (" at ", "."), (" [at] ", " [dot] "), ("{at}", "{dot}"), (" AT ", " DOT ")))
            name = f"{word()}{rng.choice(('', '.', '_', '-'))}{word()}{rng.choice(('', '', str(rng.randint(1, 99))))}"
            return f"{name}{at}{word(3)}{rng.choice(('', '-' + word(3)))}{dot}{tld.replace('.', dot)}"
        return rng.choice((f"{word()} at {word()}.{word(4)}", f"look at {word()} dot {word(4)}", f"{word()} at {rng.randint(1, 12)}.{rng.randint(10, 59)}", f"{word()} at {word().title()}.{word(4).title()}", f"{word()} @ {rng.randint(1, 99)}.{rng.randint(10, 99)}", f"{word()} at {word()}.{word(2)}.{word(5)}"))
    if kind == IP:
        if good:
            sep = rng.choice(("[.]", "(.)", "[.]"))
            short = ":".join(f"{rng.randint(0, 65535):x}" for _ in range(rng.randint(3, 4))) + "::" + f"{rng.randint(1, 65535):x}"
            return rng.choice((sep.join(str(rng.choice((0, 1, 10, rng.randint(0, 255)))) for _ in range(4)), ":".join(f"{rng.randint(0, 65535):x}" for _ in range(8)), f"2001:db8:{short}", f"fe80:{short}"))
        return rng.choice(("[.]".join(str(rng.randint(256, 999)) for _ in range(4)), ":".join(_number(rng, 2) for _ in range(rng.choice((3, 3, 6)))), ":".join(_of(rng, _HEX, 2) for _ in range(6))))
    if kind == CARD:
        digits = _valid_card(rng) if good else _number(rng, rng.choice((12, 13, 14, 15, 16, 16, 16, 18)))
        if not good and luhn(digits):
            digits = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        sep = rng.choice("./_") if good else rng.choice(("", "", " ", "-", ".", "/"))
        return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == SSN:
        area = rng.randint(1, 665) if good else rng.choice((0, 666, rng.randint(900, 999), rng.randint(1, 665)))
        return f"{area:03d}{rng.choice('--- ') if good else rng.choice('- ')}{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}"
    if kind == IBAN:
        if good:
            return _iban(rng)
        fake = f"{_of(rng, 'ABCDEFGHIKLMNOPRSTUVW', 2)}{_number(rng, 2)}{_of(rng, '0123456789' + 'ABCDEF' * rng.randint(0, 1), rng.randint(12, 22))}"
        return fake if rng.random() < 0.5 else _grouped(fake)
    if kind == SECRET:
        if good:
            return rng.choice((_of(rng, _HEX, rng.choice((32, 40, 64))), _of(rng, _B64, rng.randint(24, 60)), "AKIA" + _of(rng, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), _of(rng, "AKIS", 4) + _of(rng, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", rng.randint(8, 15)) + _of(rng, "234567", 1) + _of(rng, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", rng.randint(4, 8)), "ghp_" + _of(rng, _B64[:-2], 36), "sk-" + _of(rng, _B64[:-2], 40), "eyJ" + _of(rng, _B64[:-2], 60), word() + rng.choice("!#$%&*") + _number(rng, rng.randint(2, 4)), word().title() + _number(rng, 4) + rng.choice("!$#"), _of(rng, _B64[:-2], rng.randint(10, 16))))
        return rng.choice((_of(rng, _HEX, rng.choice((32, 40, 64))), f"{_of(rng, _HEX, 8)}-{_of(rng, _HEX, 4)}-{_of(rng, _HEX, 4)}-{_of(rng, _HEX, 4)}-{_of(rng, _HEX, 12)}", "/".join(word(3) for _ in range(5)) + str(rng.randint(1, 99)), "-".join(word(3) for _ in range(5)) + f"-{rng.randint(1, 2030)}", "_".join(word(3) for _ in range(5)) + str(rng.randint(1, 9)), word(6), word(6) + "s", _number(rng, 24)))
    if good:
        n = lambda k: _number(rng, k)
        return rng.choice((f"({n(3)}) 555-{n(4)}", f"{n(3)}-555-{n(4)}", f"0{n(2)} {n(3)} {n(4)}", f"0{n(3)}/{n(3)} {n(3)}", f"0{n(3)} / {n(3)} {n(2)} {n(2)}", f"00{rng.choice('1349')}{n(10)}", f"0{n(1)} " + " ".join(n(2) for _ in range(4)), f"0{n(3)} {n(7)}", f"0{n(2)} {n(8)}", f"0{n(3)}-{n(6)}", f"(0{n(2)}) {n(3)} {n(2)} {n(2)}", f"(0{n(3)}) {n(6)}", f"1-800-{n(3)}-{n(4)}", f"{n(3)}.{n(3)}.{n(4)}", f"{n(3)}-{n(4)}", f"9{n(2)} {n(3)} {n(3)}", f"0{n(2)} {n(4)} {n(4)}", f"0{n(2)} {n(4)} {n(4)}", f"0{rng.choice('67')}{n(8)}", f"00 {rng.randint(30, 49)} {n(3)} {n(7)}", f"00{rng.randint(30, 49)} {n(3)} {n(7)}", f"00{rng.randint(30, 49)} {n(2)} {n(4)} {n(3)}", f"{n(3)} {n(3)} {n(4)}"))
    return rng.choice((f"{rng.randint(10, 31)}.{rng.randint(10, 12)}.{rng.randint(1900, 2030)}", f"{rng.randint(10, 31)}/{rng.randint(10, 12)}/{rng.randint(1900, 2030)}", f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 31)}", f"{rng.randint(10, 99)}.{_number(rng, 3)}.{_number(rng, 3)}", f"{rng.randint(100, 999)} {_number(rng, 3)} {_number(rng, 3)}", f"{_number(rng, 4)} {_number(rng, 4)} {_number(rng, 3)}", f"000{_number(rng, 8)}", f"0{_number(rng, rng.randint(9, 13))}", f"978-{_number(rng, 1)}-{_number(rng, 2)}-{_number(rng, 6)}-{_number(rng, 1)}", f"{rng.randint(1900, 2030)}-{rng.randint(1900, 2030)}", f"{_number(rng, 2)} {_number(rng, 2)} {_number(rng, 4)}", f"{rng.randint(1, 9)} {_number(rng, 3)} {_number(rng, 3)}", f"{_number(rng, 5)}-{_number(rng, 4)}", f"{_number(rng, 3)}-{_number(rng, 4)}"))


def examples(rows: int = TRAINING_ROWS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of ``rows`` candidates in made-up sentences, each with one marked value.

    Every candidate that touches the marked value counts, so that the trees also
    learn which of several kinds is meant and that parts of a value are not it.
    """
    rng = random.Random(seed)
    x, y = [], []
    while len(x) < rows:
        kind, good = rng.randrange(len(KINDS)), rng.random() < 0.5
        value = _one(rng, kind, good)
        cue = rng.choice(_CUES[kind]) if rng.random() < (0.75 if good else 0.02) else rng.choice(_OTHER) if not good and rng.random() < 0.7 else ""
        if good and not cue and (kind == SECRET or (kind == PHONE and len(_digits(value)) < 9) or kind == SSN):
            cue = rng.choice(_CUES[kind])  # nothing else tells these apart
        if kind == SECRET and value.isalpha() and value.islower() and rng.random() < 0.6:
            cue = rng.choice(("secret", "token", "key", "the secret", "password", "keyboard", "authority", "the token is", "key:"))  # prose about them
        before = " ".join(rng.choice(_FILLER) for _ in range(rng.randint(2, 9)))
        quote = '"' if cue.endswith('"') else ""
        text = f"{before} {cue}{'' if quote or cue.endswith('=') else ' ' * bool(cue)}{value}{quote}{rng.choice((' ', ', ', '. ', ' %' if not good else ' '))}{rng.choice(_FILLER)}"
        start = len(before) + 1 + text[len(before) + 1 :].index(value)
        for s in candidates(text, base_spans(text)):
            if s[0] < start + len(value) and s[2] > start:
                x.append(np.array(features(text, s)))
                y.append(float(good and s[1] == kind and s[0] <= start and s[2] >= start + len(value) and s[2] - s[0] <= len(value) + 1))
    return np.array(x), np.array(y)


@dataclass(frozen=True)
class Model:
    """Trees as arrays over nodes in heap order, calibration and thresholds."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    start: float
    slope: float
    shift: float
    thresholds: tuple[float, ...]

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margin(x) + self.shift)))


def _tree(codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree from sums over bins; ``codes`` has the bin of each row and feature, shifted by BINS a feature."""
    n_features = len(cuts)
    feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
    bins, node = np.full(2**DEPTH - 1, BINS), np.zeros(len(codes), np.int64)
    for at in range(2**DEPTH - 1):
        rows = np.flatnonzero(node == at)
        if len(rows) >= 10:
            own = codes[rows].ravel()
            sums = [np.bincount(own, np.repeat(w[rows], n_features), n_features * BINS).reshape(n_features, BINS) for w in (grad, hess, np.ones(len(grad)))]
            right = [s[:, ::-1].cumsum(1)[:, ::-1][:, 1:] for s in sums]
            g, h, m = grad[rows].sum(), hess[rows].sum(), len(rows)
            gain = right[0] ** 2 / (right[1] + 1) + (g - right[0]) ** 2 / (h - right[1] + 1) - g**2 / (h + 1)
            gain[(right[2] < 5) | (right[2] > m - 5)] = 0
            best = int(gain.argmax())
            f, k = divmod(best, BINS - 1)
            if gain[f, k] > 1e-3:
                feature[at], cut[at], bins[at] = f, cuts[f][k], k
        node[rows] = 2 * at + 1 + (codes[rows, feature[at]] - feature[at] * BINS > bins[at])
    leaf = np.zeros(2**DEPTH)
    for i in range(2**DEPTH):
        rows = node == i + 2**DEPTH - 1
        leaf[i] = -RATE * grad[rows].sum() / (hess[rows].sum() + 1)
    return feature, cut, leaf


@functools.cache
def trained(rows: int = TRAINING_ROWS, seed: int = 7) -> Model:
    """Newton boosting on two thirds of the examples; calibration and thresholds on the rest."""
    x, y = examples(rows, seed)
    fit = np.arange(len(x)) % 3 != 2
    xf, yf = x[fit], y[fit]
    cuts = [np.unique(np.quantile(np.unique(col), np.linspace(0, 1, BINS + 1)[:-1], method="lower")) for col in xf.T]
    codes = np.stack([np.searchsorted(c, col) + i * BINS for i, (c, col) in enumerate(zip(cuts, xf.T, strict=True))], 1)
    cuts = [np.pad(c, (0, BINS - len(c)), constant_values=np.inf) for c in cuts]
    start = float(np.log(yf.mean() / (1 - yf.mean())))
    margin, trees = np.full(len(xf), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        trees.append(_tree(codes, p - yf, p * (1 - p), cuts))
        margin = Model(*map(np.array, zip(*trees[-1:], strict=True)), 0.0, 1, 0, ()).margin(xf) + margin
    feature, cut, leaf = map(np.array, zip(*trees, strict=True))
    raw = Model(feature, cut, leaf, start, 1.0, 0.0, ())
    m, yh = raw.margin(x[~fit]), y[~fit]
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Platt scaling by Newton steps
        p = 1 / (1 + np.exp(-(slope * m + shift)))
        w = p * (1 - p) + 1e-9
        g, h = np.array([((p - yh) * m).sum(), (p - yh).sum()]), np.array([[(w * m * m).sum(), (w * m).sum()], [(w * m).sum(), w.sum()]])
        slope, shift = np.array([slope, shift]) - np.linalg.solve(h + 1e-6 * np.eye(2), g)
    score, kinds, thresholds = 1 / (1 + np.exp(-(slope * m + shift))), x[~fit][:, 0], []
    for k in range(len(KINDS)):
        s, t = score[kinds == k], yh[kinds == k]
        order = np.argsort(-s, kind="stable")
        exact = np.cumsum(t[order]) / np.arange(1, len(s) + 1)
        good = np.flatnonzero(exact >= PRECISION)
        thresholds.append(max(0.5, float(s[order][good[-1]])) if len(good) else 2.0)
    del x, xf, codes
    release()
    return Model(feature, cut, leaf, start, float(slope), float(shift), tuple(thresholds))


def spans_of(texts: list[str], model: Model) -> list[list[tuple[int, int, int, bool, float]]]:
    """(start, kind, end, base, score) of each text, sorted by start and kind."""
    base = [base_spans(t) for t in texts]
    proposed = [candidates(t, b) for t, b in zip(texts, base, strict=True)]
    flat = [features(t, s) for t, p in zip(texts, proposed, strict=True) for s in p]
    scores = iter(model.score(np.array(flat)).tolist() if flat else [])
    out = []
    for b, p in zip(base, proposed, strict=True):
        scored = sorted(((next(scores), s) for s in p), key=lambda x: (-x[0], x[1]))
        # Chosen spans don't overlap, so sorted by their starts only two neighbours can meet a new one.
        chosen: list[tuple[int, int, int, bool, float]] = []
        for score, (start, kind, end) in scored:
            if score < model.thresholds[kind]:
                continue
            at = bisect.bisect_left(chosen, (start,))
            if (at == 0 or chosen[at - 1][2] <= start) and (at == len(chosen) or end <= chosen[at][0]):
                chosen.insert(at, (start, kind, end, False, score))
        out.append(sorted([(a, k, e, True, 1.0) for a, k, e in b] + chosen))
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())]))
_SPANS_SQL = "array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"


def find(docs: DataFrame) -> DataFrame:
    """doc_id, spans: kind, start, end, base and score of every span of the text."""
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in slices(batches, "text", SLICE):
            found = spans_of([x or "" for x in rows.column(1).to_pylist()], model)
            spans = [[{"kind": KINDS[k], "start": a, "end": e, "base": b, "score": s} for a, k, e, b, s in f] for f in found]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(spans, _SPANS)], ["doc_id", "spans"])
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id long, spans {_SPANS_SQL}")


def redacted(text: str, spans: list[tuple[int, int, int, bool, float]]) -> str:
    """The text with each stretch of personal data replaced by its kind; overlapping spans count as one."""
    out, done = [], 0
    for start, kind, end, _, _ in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all rows and columns stay, a null text stays null."""
    model, place = trained(), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in slices(batches, "text", SLICE):
            texts = rows.column(place).to_pylist()
            found = spans_of([x or "" for x in texts], model)
            clean = [t if not f else redacted(t, f) for t, f in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns[:place], pa.array(clean, pa.string()), *rows.columns[place + 1 :]], rows.schema.names)
        release()

    return docs.mapInArrow(run, docs.schema)


def op3_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document, with counts and digest of the base spans; n_spans counts all."""

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def counted(kind: str) -> Column:
        return F.size(F.filter("first", lambda s: s["kind"] == kind)).cast("long")

    found = find(table(spark, sf_dir, "documents")).withColumn("first", F.filter("spans", lambda s: s["base"]))
    return found.select(
        "doc_id",
        *[counted(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(told(F.col("first")), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )
