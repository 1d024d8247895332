"""Personal data: every span and every place against the validators, all digits of Unicode, long texts, ties."""

import random
import re
import sys
import time
import unicodedata

from leafmill.llm import pii

A = pii.automaton()


def kinds(text):
    return [(k, text[a:b]) for a, b, k in pii.finds(text, A)]


def everywhere(t):
    """The parsers tried at every place, without anchors or skipping; of overlapping finds the first and longest."""
    low, found, address_to = pii.lowered(t), [], -1
    for i in range(len(t)):
        if t[i] == "@":
            found.append(pii.email(t, i))
        if t[i] == "+":
            found.append(pii.plus_phone(t, i))
        if t[i] in pii.DIGITS and not (i and t[i - 1] in pii.DIGITS):
            found += [f(t, i) for f in (pii.ipv4, pii.card, pii.social, pii.iban, pii.american_phone)]
        for s in pii.SCHEMES:
            if low.startswith(s, i) and i >= address_to:
                hit, address_to = pii.web_address(t, i, i + len(s))
                found.append(hit)
        for kind, cues in (("account", pii.ACCOUNT_CUES), ("secret", pii.SECRET_CUES)):
            found += [pii.cued(t, i, i + len(c), kind) for c in cues if low.startswith(c, i)]
    out = []
    for f in sorted((f for f in found if f), key=lambda f: (f[0], -f[1], f[2])):
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


PIECES = "a B9 0 1 23 4111 1111-1111 @ . .. - + ( ) : = / // http:// https:// users/ u/ ~ x@y.com 10.0.0.1 token password= iban GB82WEST12345698765432 account: Tax ID 123-45-6789 (212)555-0187 漢字 é ² ٣ 　 ， İ ß \n".split(" ") + [" ", " "]


def test_anchors_lose_nothing():
    rng = random.Random(1)
    for _ in range(4000):
        t = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 14)))
        assert pii.finds(t, A) == everywhere(t), t


def test_numbers_against_every_span():
    """Octets and social security numbers by regular expressions over all spans of a text."""
    rng = random.Random(2)
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    address, social = re.compile(rf"{octet}(?:\.{octet}){{3}}"), re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}")
    for _ in range(3000):
        t = "".join(rng.choice(["1", "25", "255", "256", "0", "00", ".", ".", "-", "x", " ", "123-45-6789", "10.0.0.1", "666-12-3456"]) for _ in range(rng.randint(4, 12)))
        for a in range(len(t)):
            before, two = t[a - 1 : a] if a else "", t[max(0, a - 2) : a]
            for b in range(a + 7, min(len(t), a + 16) + 1):
                after, then = t[b : b + 1], t[b : b + 2]
                if address.fullmatch(t[a:b]):
                    clear = not before.isalnum() and not after.isalnum() and not re.fullmatch("[0-9][.]", two) and not re.fullmatch("[.][0-9]", then)
                    assert (pii.ipv4(t, a) == (a, b, "address")) == clear, (t, a, b)
                if social.fullmatch(t[a:b]):
                    clear = not (before.isalnum() or before == "-" or after.isalnum() or after == "-")
                    assert (pii.social(t, a) == (a, b, "account")) == clear, (t, a, b)


def test_digits_of_all_scripts():
    digits = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Nd", "No", "Nl") or chr(c).isdigit()]
    assert len(digits) > 1000
    shapes = ("2{0}{0}-555-0187", "({0}12) 555-0187", "+1 {0}12 555 01{0}7", "10.0.0.{0}", "4111 1111 1111 111{0}", "account {0}123456", "123-45-678{0}", "GB82WEST1234569876543{0}", "iban {0}", "token={0}abcdefgh1", "a{0}@b{0}.com", "http://{0}.com/u/{0}")
    for d in digits:
        for s in shapes:
            t = s.format(d)
            for a, b, _ in pii.finds(t, A):
                assert 0 <= a < b <= len(t)


def test_boundaries_between_scripts():
    assert kinds("邮箱bob@example.com谢谢") == [("email", "bob@example.com")]
    assert kinds("见http://a.com/users/bob，然后继续") == [("address", "http://a.com/users/bob")]
    assert kinds("http://a.com/users/bobhttps://b.com/u/eve x") == [("address", "http://a.com/users/bob"), ("address", "https://b.com/u/eve")]
    assert kinds("иван@почта.рф да") == [("email", "иван@почта.рф")] and kinds("x@例え.jp") == [("email", "x@例え.jp")]
    assert kinds("电话+8613812345678谢谢") == [("phone", "+8613812345678")] and kinds("卡4111 1111 1111 1111号") == [("account", "4111 1111 1111 1111")]
    assert kinds("Write bob@example.com.Then go") == [("email", "bob@example.com")]


def test_long_texts_take_linear_time():
    for unit in ("http://a.com/x漢字", "漢@漢.", "token-", "account=1", "http://", "+1", "1-", ".@", "password=a1"):
        t = (unit * 200_000)[:200_000]
        began = time.process_time()
        pii.finds(t, A)
        assert time.process_time() - began < 12, unit
    began = time.process_time()
    assert pii.finds(("汉字" * 20 + "http://a.com/users/bob，" + "汉字" * 20) * 10_000, A)
    assert time.process_time() - began < 4


def test_repeated_rows_ties_and_clashing_columns(spark):
    text = "GB82WEST12345698765432 " + "x" * 50_000 + " a@b.com"
    docs = spark.createDataFrame([(1, text, 1, "k"), (1, text, 1, "k"), (None, text, 2, None), (3, None, 3, ""), (4, "", 3, "")], "doc_id bigint, text string, start int, kind string")
    got = pii.personal_data(docs).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, [g for g in got if g.doc_id == 1][:2] * 2 + [g for g in got if g.doc_id is None])) and len(got) == 6
    assert {(g.kind, g.value) for g in got} == {("account", "GB82WEST12345698765432"), ("email", "a@b.com")}
    assert pii.personal_data(docs.limit(0)).collect() == []
