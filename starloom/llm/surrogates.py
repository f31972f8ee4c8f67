"""PII surrogates: keyed, type-consistent replacements.

Entities are detected by format. Each is replaced by a value of the same
type, format, script, letter case and (for names) gender that depends on a
secret key and on the entity alone, so one entity has one surrogate in the
whole corpus (coreference) without any table of entities.

The replacement is a keyed one-to-one map of all values of a format onto
themselves, so two entities never share a surrogate. Every draw is checked:
it must keep the type's rules (check digits, address class) and differ from
the original; a draw that collides with a rule moves on along the map's
single cycle, which keeps it one-to-one. ``pseudonymise_checked`` checks a
corpus as rewritten and fails if two originals share a surrogate.

Names in a list get another of the list (of their gender, for first names).
Any other name gets an invented one of syllables, whose end tells the gender
that a title before it tells.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import begin, ddl, free, keeps, write_cut

ROUNDS = 8
#: The key of the registered queries, which must give equal results in every
#: run. Anyone who publishes a corpus passes a secret one.
EXAMPLE_KEY = b"an example key, not a secret"

# Letters that a surrogate letter is drawn from, by script.
ALPHABETS = (
    "abcdefghijklmnopqrstuvwxyz",
    "àáâãäåçèéêëìíîïñòóôõöøùúûü",
    "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "αβγδεζηθικλμνξοπρστυφχψω",
)
# Common first names by script and gender.
FIRST_NAMES = {
    ("latin", "f"): "Aisha Alice Amelia Ana Anita Anna Ayşe Barbara Beatriz Carla Charlotte Christine Claire Clara Deepa Diana Elena Elizabeth Emily Emma Eva Fatima Giulia Hannah Heike Helen Ingrid Isabel Jane Jennifer Julia Karen Katarzyna Khadija Laura Linda Lucia Magdalena Margaret Maria Marie Martha Mary Michelle Monica Nancy Nkechi Olivia Patricia Paula Petra Pilar Priya Rachel Rebecca Sakura Sarah Sofia Sophie Sunita Susan Teresa Ursula Victoria Ximena Yuki Zofia".split(),
    ("latin", "m"): "Abdul Adam Ahmed Albert Alexander Andrew Antonio Benjamin Carlos Charles Chidi Daniel David Diego Edward Eric Felix Francisco Frank George Giovanni Hans Henry Hiroshi Ibrahim Jack Jacob James Jean John Jonas Jorge Joseph Juan Jürgen Kenji Klaus Krzysztof Louis Lucas Luis Manuel Marco Martin Michael Miguel Mohammed Oliver Omar Oscar Paul Pedro Peter Philip Pierre Piotr Rajesh Ravi Richard Robert Sanjay Stefan Takeshi Thomas Victor Walter Wei William Wolfgang Yusuf".split(),
    ("cyrillic", "f"): "Александра Алиса Анастасия Анна Валентина Вера Дарья Екатерина Елена Ирина Ксения Людмила Мария Надежда Наталья Ольга Светлана София Татьяна Юлия".split(),
    ("cyrillic", "m"): "Александр Алексей Андрей Антон Борис Виктор Владимир Дмитрий Иван Игорь Константин Максим Михаил Николай Олег Павел Пётр Роман Сергей Юрий".split(),
}
# Common surnames.
SURNAMES = "Adams Alvarez Andersson Bauer Becker Bernard Brown Clark Costa Davies Diaz Dubois Evans Fernandez Ferrari Fischer Garcia Gomez Gonzalez Green Hall Hansen Harris Hernandez Hoffmann Hughes Ivanov Jackson Jansen Jensen Johnson Jones Keller King Klein Koch Kowalski Kumar Larsen Laurent Leroy Lewis Lopez Martin Martinez Mendoza Meyer Miller Moore Moreau Morgan Moreno Müller Nielsen Novak Patel Perez Petit Ramirez Richter Rivera Roberts Robinson Rodriguez Romero Rossi Ruiz Sanchez Santos Schmidt Schneider Schulz Silva Singh Smith Suzuki Tanaka Taylor Thompson Torres Turner Walker Wagner Weber White Williams Wilson Wolf Wood Wright Young Zimmermann".split()
# Titles that stand before a name, and the gender they tell.
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "n", "Prof": "n", "Herr": "m", "Frau": "f", "Monsieur": "m", "Madame": "f",
    "Mme": "f", "Mlle": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f",
}
#: Letters of the syllables of an invented name, by script, and what may close it.
SYLLABLES = {"latin": ("bcdfghjklmnprstvwz", "aeiou"), "cyrillic": ("бвгдзклмнпрстфхч", "аеиоу")}
CLOSES = {"latin": ("", "n", "r", "s", "l", "k", "t", "m"), "cyrillic": ("", "н", "р", "с", "л", "к", "т", "м")}
#: How an invented first name ends, by gender.
ENDS = {"latin": {"f": "a", "m": "o", "n": "i"}, "cyrillic": {"f": "а", "m": "о", "n": "и"}}
#: Letters and digits that one permutation spans; a longer value is drawn
#: piece by piece.
SPAN = 256

_LETTER = {c: (a, a.index(c)) for a in ALPHABETS for c in a}
_NAME = {name: kind for kind, names in FIRST_NAMES.items() for name in names}

_LISTED = {*_NAME, *SURNAMES}
_EMAIL = re.compile(r"[^\W_][\w.+-]*@[\w-]+(?:\.[\w-]+)+")
_LOCAL = re.compile(r"[\w.+-]*")
_DOMAIN = re.compile(r"[\w-]+(?:\.[\w-]+)+")
# up to the closing quote, else to white space
_ASSIGNED = re.compile(r"""(?i)(?:token|secret(?:[_-]?key)?|password|passwd|pwd|api[_-]?key|access[_-]?key)\b\W{0,6}?[=:](?:[\s=>(\[{*]{0,6}[bruf]{0,2}(\\?["'`])((?:(?!\1)(?:\\.|[^\\\n])){8,}?)\1|\W{0,6}?(\w\S{7,}))""")
_HEX = re.compile(r"(?<![^\W_])(?=[0-9A-Fa-f]*\d)[0-9A-Fa-f]{32,}(?![^\W_])")
_KEY = re.compile(r"(?<!\w)(?:sk-|ghp_|gho_|AKIA|xox[bp]-)([A-Za-z0-9_-]{12,})")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_CARD = re.compile(r"(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w)")
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
# a country code, an area code in brackets or behind 0, or three groups: two
# groups alone may be years or an order's number
_PHONE = re.compile(
    r"(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{2,5}\)[ .-]?|\d{2,4}[ .-])?\d{3,4}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w.])\(\d{2,5}\)[ .-]?\d{3,4}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w.-])\d{2,4}[ .-]\d{3,4}[ .-]\d{4}(?![\w-])"
    r"|(?<![\w./-])0\d{2,4}/\d{5,8}(?![\w/])"
    r"|(?<![\w.])\+\d{7,15}(?!\w)|(?<![\w.])\+\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!\w)")
_IP6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,8}(?![\w:])")
_VERSION = re.compile(r"(?:version|release|ver\.?|v)[ =:]*\Z", re.IGNORECASE)
_SSH = re.compile(r"(?<!\w)(?:ssh-(?:rsa|dss|ed25519)|ecdsa-sha2-nistp\d{3}) (AAAA[0-9A-Za-z+/]{16,}={0,2})")
_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
_LINE = re.compile(r"[^\s:]{8,}(?=\s|\Z)")
_TITLED = re.compile(rf"(?<!\w)({'|'.join(TITLES)})\.? (?=[^\W\d_])")
_FIRST = re.compile(rf"(?<!\w)(?:{'|'.join(sorted([*_NAME, *(n.upper() for n in _NAME)], key=len, reverse=True))})(?= )")
# a part of a name, after what may stand before it in lower case
_PART = re.compile(r"(?:(?:de|da|do|dos|das|del|della|di|du|la|le|van|von|der|den|ter|zu|bin|al|el) ){0,3}([^\W\d_](?:\w|['’-](?=\w))*)")
# what stands between the words of a name, or nothing before an inner capital
_WORDS = re.compile(r"([\W\d_]+|(?<=[a-zß-öø-ÿ])(?=[A-ZÀ-ÖØ-Þ]))")
_DIGIT = re.compile(r"\d[\d.]")


@lru_cache(maxsize=100_000)
def _round(key: bytes, tweak: str, n: int, value: int, size: int) -> int:
    width = (size.bit_length() + 7) // 8 + 8
    data = f"{tweak}\x00{n}\x00{value}".encode("utf-8", "surrogatepass")
    out = b""
    while len(out) < width:
        out += hashlib.blake2b(data + bytes([len(out) // 64]), key=key).digest()
    return int.from_bytes(out[:width], "big") % size


def _cross(key: bytes, tweak: str, x: int, a: int, b: int, back: bool) -> int:
    """A Feistel permutation of [0, a * b), or its inverse."""
    left, right = divmod(x, b)
    for n in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
        sign = -1 if back else 1
        if n % 2 == 0:
            left = (left + sign * _round(key, tweak, n, right, a)) % a
        else:
            right = (right + sign * _round(key, tweak, n, left, b)) % b
    return left * b + right


def drawn(key: bytes, tweak: str, digits: Sequence[int], sizes: Sequence[int], allowed: Callable[[list[int]], bool] | None = None) -> list[int]:
    """The surrogate of a mixed-radix number among those ``allowed``: the
    next along a keyed cycle through all numbers. One-to-one on the allowed
    numbers, and never the number itself unless it is the only one."""
    half = len(sizes) // 2 or 1
    a = b = 1
    for n in sizes[:half]:
        a *= n
    for n in sizes[half:]:
        b *= n
    x = 0
    for d, n in zip(digits, sizes):
        x = x * n + d
    start = x
    while True:
        x = _cross(key, tweak, (_cross(key, tweak, x, a, b, False) + 1) % (a * b), a, b, True)
        out, rest = [], x
        for n in reversed(sizes):
            rest, d = divmod(rest, n)
            out.append(d)
        out.reverse()
        if x == start or allowed is None or allowed(out):
            return out


@lru_cache(maxsize=10_000)
def _signs(c: str) -> str:
    """What a letter or digit is drawn from: ten digits, one of ALPHABETS, or
    the letters of its script and category within 256 code points."""
    if c.isdecimal():
        zero = ord(c) - unicodedata.decimal(c)
        return "".join(map(chr, range(zero, zero + 10)))
    if c in _LETTER:
        return _LETTER[c][0]

    def kind(x: str) -> tuple:
        return unicodedata.category(x), unicodedata.name(x, "").split(" ")[0].split("-")[0], x.upper().lower() == x and len(x.upper()) == 1

    start = ord(c) & ~0xFF
    return "".join(x for x in map(chr, range(start, start + 256)) if x.isalpha() and x not in _LETTER and kind(x) == kind(c))


def respelled(key: bytes, kind: str, text: str, fixed: int = 0, allowed: Callable[[str], bool] | None = None) -> str:
    """``text`` with other digits and letters, of the same scripts, cases and
    places; the first ``fixed`` characters and other signs stay."""
    lower = "".join(c.lower() if len(c.lower()) == 1 and c.lower().upper() == c else c for c in text)
    places, digits, sizes, signs, form = [], [], [], [], []
    for k, c in enumerate(lower):
        signs_here = None
        if k >= fixed:
            if c.isdecimal() or c.isalpha():
                signs_here = _signs(c)
        if signs_here is None:
            form.append(c)
            continue
        form.append(f"\x00{signs_here[0]}")
        places.append(k)
        digits.append(signs_here.index(c))
        sizes.append(len(signs_here))
        signs.append(signs_here)
    if not places:
        return text

    def spelled(values: Sequence[int]) -> str:
        out = list(text)
        for k, v, s in zip(places, values, signs):
            out[k] = s[v].upper() if text[k] != lower[k] else s[v]
        return "".join(out)

    if len(places) > SPAN:
        mark = hashlib.blake2b("".join(form).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
        return spelled([x for k in range(0, len(places), SPAN) for x in drawn(key, f"{kind}\x02{mark}\x02{k}", digits[k : k + SPAN], sizes[k : k + SPAN])])
    check = (lambda v: allowed(spelled(v))) if allowed else None
    return spelled(drawn(key, kind + "\x01" + "".join(form), digits, sizes, check))


def luhn(text: str) -> bool:
    digits = [int(c) for c in text if c.isdigit()]
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(reversed(digits))) % 10 == 0


def iban_valid(text: str) -> bool:
    s = text.replace(" ", "")
    try:
        return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    except ValueError:
        return False


def _address(octets: Sequence[int]) -> str:
    a, b = octets[:2]
    if a in (0, 10, 127) or a >= 224 or (a, b) in ((192, 168), (169, 254)) or (a == 172 and 16 <= b < 32):
        return f"{a}.{b}"
    return "public"


def _email(key: bytes, value: str) -> str:
    local, domain = value.rsplit("@", 1)
    labels = domain.split(".")
    return respelled(key, "local", local) + "@" + ".".join([respelled(key, "domain", x) for x in labels[:-1]] + labels[-1:])


def _ip(key: bytes, value: str) -> str:
    if not value.isascii():
        return respelled(key, "ip", value, allowed=lambda v: bool(_IP.fullmatch(v)))
    octets = [int(x) for x in value.split(".")]
    kind = _address(octets)
    if kind != "public":  # the network part of a special address is its class
        return ".".join(map(str, octets[:2] + drawn(key, "ip" + kind, octets[2:], (256, 256))))
    return ".".join(map(str, drawn(key, "ip", octets, (256,) * 4, lambda o: _address(o) == "public")))


def _card(key: bytes, value: str) -> str:
    valid = luhn(value)
    return respelled(key, "card", value, fixed=1, allowed=lambda v: luhn(v) == valid)


def _iban(key: bytes, value: str) -> str:
    valid = iban_valid(value)
    return respelled(key, "iban", value, fixed=2, allowed=lambda v: iban_valid(v) == valid)


def _secret(key: bytes, value: str) -> str:
    if _is_hex(value):
        return _hex(key, value)
    return respelled(key, "secret", value, allowed=lambda v: not _is_hex(v))


def _hex(key: bytes, value: str) -> str:
    """Hex of the same case: lower (or digits alone), upper, or both."""
    signs, allowed = "0123456789abcdef", None
    if value != value.lower():
        mixed = value != value.upper()
        signs = "0123456789abcdefABCDEF" if mixed else "0123456789ABCDEF"

        def allowed(v: list[int]) -> bool:
            return any(x > 15 for x in v) and any(9 < x < 16 for x in v) if mixed else any(x > 9 for x in v)

    n = len(value)
    if n > SPAN:
        pieces = [value[k : k + SPAN] for k in range(0, n, SPAN)]
        return "".join(signs[x] for k, v in enumerate(pieces) for x in drawn(key, f"secret\x02{n}\x02{len(signs)}\x02{k}", [signs.index(c) for c in v], [len(signs)] * len(v)))
    return "".join(signs[x] for x in drawn(key, "secret\x01" + "\x000" * n, [signs.index(c) for c in value], [len(signs)] * n, allowed))


def _is_hex(text: str) -> bool:
    return all(c in "0123456789abcdefABCDEF" for c in text)


def _phone(key: bytes, value: str) -> str:
    """The country code stays."""
    code = re.match(r"\+\d{1,3}(?=[ .-])", value)
    return respelled(key, "phone", value, fixed=code.end() if code else 0)


def _ip6(key: bytes, value: str) -> str:
    """Other hex digits of the same case; the first group, which tells the
    kind of address, stays."""
    fixed = value.index(":")
    at = [k for k, c in enumerate(value) if c != ":" and k >= fixed]
    signs = "0123456789abcdef" if value == value.lower() else "0123456789ABCDEF" if value == value.upper() else "0123456789abcdefABCDEF"
    form = "".join(c if k < fixed or c == ":" else "\x00" for k, c in enumerate(value))
    out = list(value)
    for k, x in zip(at, drawn(key, f"ip6\x01{form}\x01{len(signs)}", [signs.index(value[k]) for k in at], [len(signs)] * len(at))):
        out[k] = signs[x]
    return "".join(out)


def _listed(key: bytes, value: str, names: Sequence[str], kind: str) -> str:
    plain = value if value in names else value.title()
    new = names[drawn(key, kind + names[0], [names.index(plain)], [len(names)])[0]]
    return new if plain == value else new.upper()


def _first(key: bytes, value: str) -> str:
    return _listed(key, value, FIRST_NAMES[_NAME[value if value in _NAME else value.title()]], "first")


#: What a name may be spelled with: script, letters.
_SPELLED = (("latin", ALPHABETS[0]), ("latin", ALPHABETS[0] + ALPHABETS[1]), ("cyrillic", ALPHABETS[2]))
#: Letters of the longest name that is invented anew.
LONGEST = 24


@lru_cache(maxsize=None)
def _shape(family: int, length: int) -> tuple[int, str]:
    """Syllables of an invented name for one of ``length`` letters, and what
    closes it: no other length or family of the script has the same both."""
    script = _SPELLED[family][0]
    base = len(SYLLABLES[script][0]) * len(SYLLABLES[script][1])

    def syllables(f: int, n: int) -> int:
        k, size = 1, len(_SPELLED[f][1]) ** n
        while base**k < size:
            k += 1
        return k

    need = syllables(family, length)
    alike = [(f, n) for f in range(len(_SPELLED)) if _SPELLED[f][0] == script for n in range(2, LONGEST + 1) if syllables(f, n) == need]
    return need, CLOSES[script][alike.index((family, length))]


def _invented(key: bytes, kind: str, word: str, gender: str | None) -> str:
    """A name that can be spoken, for one in no list: the word's letters as a
    number, permuted, in syllables; one-to-one, and never a listed name."""
    low = word.lower()
    family = next((k for k, (_, letters) in enumerate(_SPELLED) if all(c in letters for c in low)), None)
    titled, upper = word == low[:1].upper() + low[1:], word == low.upper()
    if family is None or not 2 <= len(low) <= LONGEST or not (titled or upper or word == low):
        return respelled(key, kind, word)
    script, letters = _SPELLED[family]
    need, close = _shape(family, len(low))
    heads, vowels = SYLLABLES[script]
    end = ENDS[script][gender] if gender else ""

    def spelled(digits: Sequence[int]) -> str:
        x, out = 0, ""
        for d in digits:
            x = x * len(letters) + d
        for _ in range(need):
            x, d = divmod(x, len(heads) * len(vowels))
            out += heads[d // len(vowels)] + vowels[d % len(vowels)]
        out += close + end
        return out[0].upper() + out[1:] if titled else out.upper() if upper else out

    digits = [letters.index(c) for c in low]
    return spelled(drawn(key, f"{kind}\x03{family}", digits, [len(letters)] * len(low), lambda v: spelled(v).title() not in _LISTED and spelled(v) != word))


def _name(key: bytes, kind: str, value: str, gender: str | None = None) -> str:
    """A name in no list: each of its words (what stands between hyphens and
    apostrophes) gets an invented one."""
    return "".join(_invented(key, kind, w, gender) if w and w[0].isalpha() else w for w in _WORDS.split(value))


def _surname(key: bytes, value: str) -> str:
    if value in SURNAMES or value.isupper() and value.title() in SURNAMES:
        return _listed(key, value, SURNAMES, "surname")
    return _name(key, "surname", value)


SURROGATE: dict[str, Callable[[bytes, str], str]] = {
    "email": _email, "secret": _secret, "ip": _ip, "iban": _iban, "card": _card,
    "ssn": lambda key, v: respelled(key, "ssn", v), "phone": _phone,
    "ip6": _ip6, "first_name": _first, "surname": _surname,
    **{f"first_name_{g}": lambda key, v, g=g: _name(key, "first" + g, v, g) for g in "fmn"},
}


def type_of(kind: str) -> str:
    """The type that is reported for a kind of surrogate."""
    return "first_name" if kind.startswith("first_name") else "ip" if kind == "ip6" else kind


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The spans that ``_EMAIL`` finds, from each @ to both sides (the pattern
    alone tries every place of a long run of letters)."""
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            before = _LOCAL.match(text[done:at][::-1]).end()
            start = at - before
            while start < at and not text[start].isalnum():
                start += 1
            if start < at:
                yield start, m.end()
        done = m.end() if m and start < at else at + 1  # no local part holds an @
        at = text.find("@", done)


def _name_parts(text: str, at: int) -> list[tuple[int, int]]:
    """The capitalised words and initials (with a point) from ``at`` on."""
    out: list[tuple[int, int]] = []
    while m := _PART.match(text, at):
        start, end = m.span(1)
        word = text[start:end]
        point = text[end : end + 1] == "."
        if not word[0].isupper() or len(word) == 1 and not point:
            break
        owner = word.endswith(("'s", "’s"))
        if word not in TITLES:
            out.append((start, end - 2 * owner))
        at = end + (point and (len(word) == 1 or word in TITLES))
        if text[at : at + 1] == " ":
            at += 1
        elif at == end:
            break
        if owner:
            break
    return out


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities of a text, in their order; where
    patterns overlap, the one named first here holds."""
    found: list[tuple[int, int, str]] = []
    taken = bytearray(len(text))

    def take(start: int, end: int, kind: str) -> None:
        if start < end and not any(taken[start:end]):
            taken[start:end] = b"\x01" * (end - start)
            found.append((start, end, kind))

    if "=" in text or ":" in text:  # first: a password may look like an e-mail
        for m in _ASSIGNED.finditer(text):
            value = m.group(2) or m.group(3).rstrip("\"'`,;:.!?)]}>\\")
            start = m.start(2 if m.group(2) else 3)
            if len(value) >= 8 and not _EMAIL.fullmatch(value):
                take(start, start + len(value), "secret")
    if "@" in text:
        for span in _emails(text):
            take(*span, "email")
    if "-----BEGIN " in text:
        for m in _BLOCK.finditer(text):
            end = text.find("-----END", m.end())
            if end < 0:
                break
            for line in _LINE.finditer(text, m.end(), end):
                take(*line.span(), "secret")
    if "AAAA" in text:
        for m in _SSH.finditer(text):
            take(*m.span(1), "secret")
    for m in _HEX.finditer(text):
        take(*m.span(), "secret")
    for m in _KEY.finditer(text):
        take(*m.span(1), "secret")
    if ":" in text:
        for m in _IP6.finditer(text):
            groups = [g for g in m.group().split(":") if g]
            colons = m.group().count(":")
            if len(groups) >= 3 and (colons == 7 and len(groups) == 8 or m.group().count("::") == 1 and ":::" not in m.group() and len(groups) <= 7) and any(c.isdigit() for c in m.group()):
                take(*m.span(), "ip6")
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if not _VERSION.search(text, max(0, m.start() - 12), m.start()):
                take(*m.span(), "ip")
        for pattern, kind in ((_IBAN, "iban"), (_CARD, "card"), (_SSN, "ssn"), (_PHONE, "phone")):
            for m in pattern.finditer(text):
                take(*m.span(), kind)
    names: dict[str, str] = {}

    def name(spans: list[tuple[int, int]], gender: str = "n") -> None:
        for k, (start, end) in enumerate(spans):
            word, kind = text[start:end], "surname"
            if k == 0 and (word in _NAME or word.isupper() and word.title() in _NAME):
                kind = "first_name"
            elif k == 0 and len(spans) > 1 and end - start > 1:
                kind = "first_name_" + gender
            take(start, end, kind)
            if end - start > 1:
                names.setdefault(text[start:end], kind)

    for m in _TITLED.finditer(text):
        name(_name_parts(text, m.end()), TITLES[m.group(1)])
    told = 0
    for m in _FIRST.finditer(text):
        if m.start() < told:  # a part of the name before
            continue
        more = _name_parts(text, m.end() + 1)
        if m.group().isupper() and m.group() not in _NAME:
            more = [(start, end) for start, end in more if text[start:end].isupper()]
        told = more[-1][1] if more else m.end()
        if any(end - start > 1 for start, end in more):
            name([m.span(), *more])
    for value, kind in names.items():  # other mentions of the same names
        start = text.find(value)
        while start >= 0:
            end = start + len(value)
            if not any(c.isalnum() or c == "_" for c in text[max(start - 1, 0) : start] + text[end : end + 1]):
                take(start, end, kind)
            start = text.find(value, end)
    return sorted(found)


@lru_cache(maxsize=100_000)
def surrogate(key: bytes, kind: str, value: str) -> str:
    return SURROGATE[kind](key, value)


def _forget() -> None:
    for memo in (_round, _signs, surrogate):
        memo.cache_clear()


keeps("surrogates", _forget)


def replaced(text: str, key: bytes) -> tuple[str, list[tuple[int, int, str, str, str]]]:
    """The text with surrogates, and for each entity its place in the new
    text, type, original and surrogate."""
    out, told, at, size = [], [], 0, 0
    for start, end, kind in entities(text):
        new = surrogate(key, kind, text[start:end])
        out += [text[at:start], new]
        size += start - at
        told.append((size, size + len(new), type_of(kind), text[start:end], new))
        size += len(new)
        at = end
    return ("".join([*out, text[at:]]) if told else text), told


_ENTITY = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("type", pa.string())]))


_TOLD = pa.list_(pa.struct([("type", pa.string()), ("original", pa.binary()), ("surrogate", pa.string())]))


def _rewritten(docs: DataFrame, key: bytes, text_col: str, told: str | None) -> DataFrame:
    """``docs`` with surrogates and ``entities``; ``told``: a column of the
    types, keyed hashes of the originals, and surrogates of the entities."""
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("surrogates")
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            done = [(None, []) if t is None else replaced(t, key) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array([[{"start": a, "end": b, "type": k} for a, b, k, _, _ in found] for _, found in done], _ENTITY)]
            columns[at] = pa.array([t for t, _ in done], pa.string())
            if told:
                columns.append(pa.array([[{"type": k, "original": _mark(key, old), "surrogate": new} for _, _, k, old, new in found] for _, found in done], _TOLD))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "entities", *([told] if told else [])])

    rows = docs.drop("entities") if "entities" in docs.columns else docs
    more = [f"`{told}` array<struct<type:string,original:binary,surrogate:string>>"] if told else []
    return rows.mapInArrow(run, ddl(rows, "entities array<struct<start:int,end:int,type:string>>", *more))


def _mark(key: bytes, value: str) -> bytes:
    return hashlib.blake2b(value.encode("utf-8", "surrogatepass"), key=key, digest_size=16).digest()


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the surrogates in ``text_col``, its other columns as
    they are, and ``entities`` (start, end, type in the new text; an existing
    column of that name is replaced). No shuffle; a text depends on itself
    and the key alone. A null text stays null without entities; repeated
    rows get equal results. Texts of any length are read whole.
    """
    return _rewritten(docs, key, text_col, None)


def pseudonymise_checked(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``pseudonymise``, after a job that fails if surrogates collide. The
    texts are rewritten once: the result is written with a keyed hash of each
    original, the hashes are compared by surrogate, and it is read again."""
    told = free("_told", docs.columns)
    done = write_cut(_rewritten(docs, key, text_col, told), "surrogates")
    each = done.select(F.inline(told)).distinct()
    _refuse(each.groupBy("type", "surrogate").agg(F.count("*").alias("originals")).where("originals > 1"))
    return done.drop(told)


def _refuse(found: DataFrame) -> None:
    some = found.limit(5).collect()
    if some:  # by type and count alone: a surrogate may be an original here
        raise ValueError(f"surrogates collide: {[(r['type'], r['originals']) for r in some]}")


def collisions(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``type, surrogate, originals``: surrogates that stand for several
    originals of ``docs``, or for themselves. No rows if all is well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("surrogates")
        for batch in batches:
            rows = {(k, old, new) for t in batch.column(0).to_pylist() if t for _, _, k, old, new in replaced(t, key)[1]}
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string()) for c in range(3)], ["type", "original", "surrogate"])

    seen = docs.select(text_col).mapInArrow(run, "type string, original string, surrogate string").distinct()
    many = seen.groupBy("type", "surrogate").agg(F.count("*").alias("originals"), F.max(F.col("original") == F.col("surrogate")).alias("same"))
    return many.where("originals > 1 or same").select("type", "surrogate", "originals")


def checked(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs``, after a job that fails if surrogates collide in them."""
    _refuse(collisions(docs, key, text_col))
    return docs
