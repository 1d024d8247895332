"""Personal data by anchor expansion: Aho-Corasick finds anchors, local parsers settle boundaries.

One automaton finds at-signs, address schemes, plus signs, digits and the cue words of accounts
and secrets, in any case, over a lower-cased copy in which each character keeps its place. Each
anchor has a parser that expands from it to both sides within the characters its kind allows and
then validates what it found:

* email: local part (at most 64 characters) and domain about an at-sign; letters and digits of
  one script, dots not doubled or at an end, two labels at least, the last one of 2 to 24 letters.
  Where the script changes between letters, as from Chinese to Latin, the address ends.
* address: an IPv4 address of four octets that no further digit or dotted octet touches, and a
  web address that names a person: user info before the host, or a path that begins with
  ~name, /user(s)/, /profile(s)/, /people/, /u/ or /in/. It ends at white space, quotes, brackets
  and at punctuation beyond ASCII, and where another scheme begins.
* phone: a plus sign and 8 to 15 digits, or a North American number with separators.
* account: a payment card number (length and leading digits of an issuer, Luhn's check), an
  IBAN (mod-97 check), a US social security number with hyphens, and, after a cue word such as
  account, passport or iban, an identifier with at least 6 digits.
* secret: after a cue word such as token, password or api_key and = or :, a value of at least 8
  characters that has a digit.

Between a cue and its value at most GAP separators may stand; a cued account has at most VALUE_SIZE
characters (longer runs are no account numbers). Digits are ASCII digits; those of other scripts,
superscripts and the like are neither digits nor letters of a number and end it.

Of overlapping finds the one that starts first stays, of equal starts the longest, of equal finds
the first of the kinds in the order of the alphabet. Positions count code points. Cases: null and
empty texts have none; texts are read whole whatever their length, in time that grows with it;
repeated rows give repeated finds; a null doc_id is kept as null; other columns are ignored. A
narrow map, no shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator


import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.llm.common import pieces

ACCOUNT_CUES = ("account", "acct", "iban", "passport", "ssn", "customer id", "member id", "tax id", "routing")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "api-key", "apikey", "access_key", "private_key")
SCHEMES = ("http://", "https://", "ftp://")
PERSON_PATHS = ("~", "user/", "users/", "profile/", "profiles/", "people/", "u/", "in/")
DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
VALUE = DIGITS | LETTERS | frozenset("_-./+")
URL_END = frozenset(" \t\r\n\f\v<>\"'`{}|\\^")
GAP, VALUE_SIZE = 24, 40

Find = tuple[int, int, str]


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    anchors = [("@", "@"), ("+", "+"), *((d, "0") for d in DIGITS)]
    anchors += [(s, "scheme") for s in SCHEMES]
    for kind, cues in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES)):
        anchors += [(c, kind) for c in cues]
    for word, kind in anchors:
        a.add_word(word, (len(word), kind))
    a.make_automaton()
    return a


#: Where the blocks of a few scripts begin that are written without spaces between words, or beside others; letters of all other blocks count as one script.
BLOCKS = ((0x3040, 0x3100, "han"), (0x3100, 0x3130, "han"), (0x31F0, 0x3200, "han"), (0x3400, 0x4DC0, "han"), (0x4E00, 0xA000, "han"), (0xAC00, 0xD7B0, "ko"), (0xF900, 0xFB00, "han"), (0x0E00, 0x0E80, "th"), (0x0E80, 0x0F00, "lo"), (0x1000, 0x10A0, "my"), (0x1780, 0x1800, "km"), (0x20000, 0x40000, "han"))


def script(c: str) -> str:
    """'' for characters that any script uses, else a name for the script of a letter."""
    if c < "\x80":
        return "latin" if c in LETTERS else ""
    if not c.isalpha():
        return ""
    n = ord(c)
    if n < 0x370 or 0x1E00 <= n < 0x1F00:
        return "latin"
    for low, high, name in BLOCKS:
        if low <= n < high:
            return name
    return unicodedata.name(c, "other").partition(" ")[0]


def of_number(c: str) -> bool:
    """Whether a character beside a number makes it part of something longer: an ASCII digit, or a letter of a script that spaces its words."""
    return c in DIGITS or c in LETTERS or (c > "\x7f" and c.isalpha() and not any(low <= ord(c) < high for low, high, _ in BLOCKS))


def name_part(c: str) -> bool:
    return c in DIGITS or c.isalpha()


def email(t: str, at: int) -> Find | None:
    a, b, n, kind = at, at + 1, len(t), ""
    while a > 0 and at - a < 65 and (name_part(t[a - 1]) or t[a - 1] in "._%+-"):
        own = script(t[a - 1])
        if own and kind and own != kind:
            break
        kind = own or kind
        a -= 1
        if t[a : a + 2] == "..":
            a += 1
            break
    while a < at and not (name_part(t[a]) or t[a] == "_"):
        a += 1
    kind = ""
    while b < n and b - at < 255 and (name_part(t[b]) or t[b] in ".-"):
        if t[b] == "." and t[b - 1] in ".@":
            break
        own = script(t[b])
        if own and kind and own != kind:
            break
        kind = "" if t[b] == "." else own or kind  # each label has a script of its own
        b += 1
    while b > at + 1 and not name_part(t[b - 1]):
        b -= 1
    if a == at or at - a > 64 or t[at - 1] in ".-" or b - at > 254:
        return None
    labels = t[at + 1 : b].split(".")
    while len(labels) > 2 and (not (2 <= len(labels[-1]) <= 24 and labels[-1].isalpha()) or (labels[-1].istitle() and labels[-2].islower())):
        b -= len(labels.pop()) + 1  # a sentence goes on after the dot
    if len(labels) < 2 or not (2 <= len(labels[-1]) <= 24 and labels[-1].isalpha()) or any(not x or x[0] == "-" or x[-1] == "-" or len(x) > 63 for x in labels):
        return None
    return a, b, "email"


def url_end(t: str, b: int) -> int:
    """The first place from b on that a web address can't hold: what URL_END lists, or white space or punctuation beyond ASCII."""
    n = len(t)
    while b < n:
        c = t[b]
        if c in URL_END or (c > "\x7f" and not c.isalnum()):
            return b
        if c == ":" and t[b : b + 3] == "://":
            for s in SCHEMES:  # another address begins here
                if t[b - len(s) + 3 : b].lower() == s[:-3]:
                    return b - len(s) + 3
        b += 1
    return n


def web_address(t: str, start: int, after: int) -> tuple[Find | None, int]:
    """The find, and how far the address goes; personal or not, no further address begins within."""
    b = end = url_end(t, after)
    while b > after and t[b - 1] in ".,;:!?)]*#$%&":
        b -= 1
    host, _, path = t[after:b].partition("/")
    user, sign, name = host.rpartition("@")
    if not (name.partition(":")[0].replace("-", "").replace(".", "").isalnum() and "." in name):
        return None, end
    path = path[:32].lower()
    personal = any(path.startswith(p) and len(path) > len(p) and path[len(p)].isalnum() for p in PERSON_PATHS)
    return ((start, b, "address") if (sign and user) or personal else None), end


def ipv4(t: str, a: int) -> Find | None:
    b, octets, n = a, 0, len(t)
    while octets < 4:
        c = b
        while c < n and c - b < 4 and t[c] in DIGITS:
            c += 1
        piece = t[b:c]
        if not piece or len(piece) > 3 or int(piece) > 255 or (len(piece) > 1 and piece[0] == "0"):
            return None
        octets, b = octets + 1, c
        if octets < 4:
            if b >= n or t[b] != ".":
                return None
            b += 1
    before = a > 0 and (of_number(t[a - 1]) or (t[a - 1] == "." and a > 1 and t[a - 2] in DIGITS))
    behind = b < n and (of_number(t[b]) or (t[b] == "." and b + 1 < n and t[b + 1] in DIGITS))
    return None if before or behind else (a, b, "address")


def number_run(t: str, a: int, separators: str, most: int) -> tuple[int, str, list[int]]:
    """The end, digits and group sizes of digits with single separators from a on."""
    b, n, digits, groups = a, len(t), [], [0]
    while b < n and len(digits) <= most:
        if t[b] in DIGITS:
            digits.append(t[b])
            groups[-1] += 1
        elif t[b] in separators and groups[-1] and b + 1 < n and t[b + 1] in DIGITS:
            groups.append(0)
        else:
            break
        b += 1
    return b, "".join(digits), groups


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def issuer(digits: str) -> bool:
    n, two, four = len(digits), int(digits[:2]), int(digits[:4])
    if digits[0] == "4":
        return n in (13, 16, 19)
    if 51 <= two <= 55 or 2221 <= four <= 2720:
        return n == 16
    if two in (34, 37):
        return n == 15
    if two in (36, 38, 39) or 3000 <= four <= 3059:
        return n == 14
    return (four == 6011 or two == 65 or 6440 <= four <= 6499 or 3528 <= four <= 3589) and 16 <= n <= 19


def card(t: str, a: int) -> Find | None:
    if a > 0 and (of_number(t[a - 1]) or t[a - 1] in "._"):
        return None
    for separators in ("", " ", "-"):
        b, digits, groups = number_run(t, a, separators, 19)
        shape = len(groups) == 1 or groups in ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4], [4, 4, 4, 4, 3])
        if 13 <= len(digits) <= 19 and shape and not (b < len(t) and of_number(t[b])) and issuer(digits) and luhn(digits):
            return a, b, "account"
    return None


def social(t: str, a: int) -> Find | None:
    b, digits, groups = number_run(t, a, "-", 9)
    if groups != [3, 2, 4] or digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000":
        return None
    clear = not (a > 0 and (of_number(t[a - 1]) or t[a - 1] == "-")) and not (b < len(t) and (of_number(t[b]) or t[b] == "-"))
    return (a, b, "account") if clear else None


def iban(t: str, a: int) -> Find | None:
    """a is the first check digit; two capitals stand before it."""
    s = a - 2
    if s < 0 or not ("A" <= t[s] <= "Z" and "A" <= t[s + 1] <= "Z") or (s > 0 and of_number(t[s - 1])):
        return None
    b, n, code = s, len(t), []
    while b < n and len(code) < 34:
        if t[b] in DIGITS or "A" <= t[b] <= "Z":
            code.append(t[b])
        elif not (t[b] == " " and len(code) % 4 == 0 and b + 1 < n and (t[b + 1] in DIGITS or "A" <= t[b + 1] <= "Z")):
            break
        b += 1
    while len(code) >= 15:
        if not (b < n and of_number(t[b])) and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return s, b, "account"
        while b > s and t[b - 1] != " ":  # a word in capitals may follow the code
            b -= 1
            code.pop()
        if b == s:
            break
        b -= 1
    return None


def digits_at(t: str, a: int, n: int) -> bool:
    own = t[a : a + n]
    return len(own) == n and all(c in DIGITS for c in own)


def american_phone(t: str, a: int) -> Find | None:
    s = a - 1 if a > 0 and t[a - 1] == "(" else a
    if (s > 0 and (of_number(t[s - 1]) or t[s - 1] in "+-.")) or not digits_at(t, a, 3):
        return None
    b = a + 3
    if s < a:
        if t[b : b + 1] != ")":
            return None
        b += 1
        b += t[b : b + 1] in (" ", "-", ".")
    elif t[b : b + 1] in ("-", ".", " "):
        b += 1
    else:
        return None
    if not (digits_at(t, b, 3) and t[b + 3 : b + 4] in ("-", ".", " ") and digits_at(t, b + 4, 4)):
        return None
    if t[b + 3 : b + 4] == " " and s == a:  # bare groups of digits are too common
        return None
    b += 8
    digits = "".join(c for c in t[s:b] if c in DIGITS)
    if (b < len(t) and of_number(t[b])) or digits[0] in "01" or digits[3] in "01":
        return None
    return s, b, "phone"


def plus_phone(t: str, at: int) -> Find | None:
    if at > 0 and of_number(t[at - 1]):
        return None
    b, n, digits, last = at + 1, len(t), 0, at
    while b < n and digits < 16:
        if t[b] in DIGITS:
            digits += 1
            last = b
        elif not (t[b] in " -.()" and b - last <= 2 and digits):
            break
        b += 1
    b = last + 1
    return (at, b, "phone") if 8 <= digits <= 15 and t[at + 1] in "123456789" and not (b < n and of_number(t[b])) else None


def cued(t: str, start: int, after: int, kind: str) -> Find | None:
    if (start > 0 and of_number(t[start - 1])) or (after < len(t) and of_number(t[after])):
        return None
    b, n, marks = after, len(t), False
    for word in (" number", " no", " nr", " id", " code"):
        if t[b : b + len(word)].lower() == word and not of_number(t[b + len(word) : b + len(word) + 1] or " "):
            b += len(word)
            break
    while b < n and b - after < GAP and t[b] in " \t.:=#\"'":
        marks |= t[b] in ":="
        b += 1
    a = b
    if kind == "secret" and not marks:
        return None
    most = n if kind == "secret" else min(n, a + VALUE_SIZE + 1)
    while b < most and t[b] in VALUE:
        b += 1
    while b > a and t[b - 1] in "./-+_":
        b -= 1
    value = t[a:b]
    digits = sum(c in DIGITS for c in value)
    if kind == "secret":
        return (a, b, "secret") if len(value) >= 8 and digits else None
    if b < n and t[b] == " " and digits:  # groups of an identifier that spaces part
        end, run, _ = number_run(t, a, " ", 34)
        if end > b and len(run) >= 6:
            return a, end, "account"
    return (a, b, "account") if digits >= 6 and b - a <= VALUE_SIZE and not (b < n and t[b] in VALUE - frozenset("./-+_")) else None


def lowered(t: str) -> str:
    """t in lower case, each character at its own place; one whose lower case is longer stays as it is."""
    low = t.lower()
    return low if len(low) == len(t) else "".join(x if len(x := c.lower()) == 1 else c for c in t)


def finds(t: str, a: ahocorasick.Automaton) -> list[Find]:
    """Finds in a text, in order and apart."""
    found, digits_to, address_to = [], -1, -1
    for last, (size, kind) in a.iter(lowered(t)):
        start = last - size + 1
        if kind == "0":
            if start < digits_to:
                continue
            digits_to = start + 1
            while digits_to < len(t) and t[digits_to] in DIGITS:
                digits_to += 1
            if digits_to - start <= 3 and start > 0 and t[start - 1] in "(-.+ " or digits_to - start >= 2 or t[digits_to : digits_to + 1] == ".":
                for parser in (ipv4, card, social, iban, american_phone):
                    hit = parser(t, start)
                    if hit:
                        found.append(hit)
            continue
        if kind == "@":
            hit = email(t, start)
        elif kind == "+":
            hit = plus_phone(t, start)
        elif kind == "scheme":
            if start < address_to:
                continue
            hit, address_to = web_address(t, start, last + 1)
        else:
            hit = cued(t, start, last + 1, kind)
        if hit:
            found.append(hit)
    found.sort(key=lambda f: (f[0], -f[1], f[2]))
    out: list[Find] = []
    for f in found:
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, start, end, value): each find; end is the position after the last character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton()
        for part in pieces(batches, "text"):
            rows, hits, texts = [], [], part.column("text").to_pylist()
            for i, t in enumerate(texts):
                for f in finds(t, a) if t else ():
                    rows.append(i)
                    hits.append((*f, t[f[0] : f[1]]))
            if hits:
                start, end, kind, value = zip(*hits)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows)), pa.array(kind), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(value)], names=["doc_id", "kind", "start", "end", "value"]
                )

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id bigint, kind string, start bigint, end bigint, value string")
