import datetime
import hashlib
import random
import re

import pytest
from helpers import documents
from pyspark.sql import functions as F

from medallion.llm.pii import FORMATS, pseudonymized

SCHEMA = "doc_id long, text string, matches string, kinds int"


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        x = int(c)
        total += x if k % 2 == 0 else sum(map(int, str(2 * x)))
    return total % 10 == 0


def iban_ok(value):
    value = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def run(spark, texts, key="k", finds="found"):
    df = spark.createDataFrame([(i, t, "m", 1) for i, t in enumerate(texts)], SCHEMA)
    found = {r.doc_id: r for r in pseudonymized(df, key, finds_column=finds).collect()}
    return [found[i] for i in range(len(texts))]


def card(rng, size):
    body = str(rng.randrange(1, 10)) + "".join(str(rng.randrange(10)) for _ in range(size - 2))
    return next(body + c for c in "0123456789" if luhn(body + c))


def iban(rng):
    country, bban = rng.choice(["DE", "FR", "GB"]), "".join(rng.choice("0123456789ABCXYZ") for _ in range(18))
    check = 98 - int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97
    return f"{country}{check:02d}{bban}"


def values(kind, n=150):
    rng = random.Random(kind)
    day = lambda: datetime.date(1800, 1, 1) + datetime.timedelta(rng.randrange(146097))
    make = {
        "card": lambda: card(rng, rng.randrange(13, 20)),
        "iban": lambda: iban(rng),
        "ipv4": lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        "ssn": lambda: f"{rng.choice([1, 665, 667, 899, 123]):03d}-{rng.randrange(1, 100):02d}-{rng.randrange(1, 10000):04d}",
        "phone": lambda: f"+1 ({rng.randrange(200, 1000)}) {rng.randrange(200, 1000)}-{rng.randrange(10000):04d}",
        "number": lambda: f"+49 {rng.randrange(10, 99)} {rng.randrange(10**6, 10**8)}",
        "date": lambda: day().strftime(rng.choice(["%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y"])).rjust(10, "0"),
        "email": lambda: "".join(rng.choice("abXY01._-") for _ in range(rng.randrange(1, 20))) + "@mail.example.com",
    }[kind]
    return list(dict.fromkeys(make() for _ in range(n)))


def valid(kind, value):
    digits = re.sub(r"\D", "", value)
    if kind == "card":
        return luhn(digits)
    if kind == "iban":
        return iban_ok(value)
    if kind == "ipv4":
        return all(str(int(x)) == x and int(x) < 256 for x in value.split("."))
    if kind == "ssn":
        a, b, c = value.split("-")
        return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"
    if kind == "phone":
        return digits[1] >= "2" and digits[4] >= "2"
    if kind == "date":
        for pattern in ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y"):
            try:
                return 1800 <= datetime.datetime.strptime(value, pattern).year < 2200
            except ValueError:
                pass
        return False
    return True


@pytest.mark.parametrize("kind", ["card", "iban", "ipv4", "ssn", "phone", "number", "date", "email"])
def test_formats(spark, kind):
    found = values(kind)
    texts = [f"<{v}> and again ({v}), end" for v in found]
    rows = run(spark, texts)
    new = []
    for v, r in zip(found, rows):
        assert r.found == [kind, kind], (v, r)
        one = re.fullmatch(r"<(.*)> and again \((.*)\), end", r.text)
        assert one[1] == one[2]  # equal values stay equal
        new.append(one[1])
    shape = lambda v: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", v)))
    if kind == "ipv4":
        assert all(valid(kind, v) for v in new)
    else:
        assert [shape(v) for v in new] == [shape(v) for v in found]
        assert all(valid(kind, v) for v in new)
    assert len(set(new)) == len(new)  # different values stay different
    assert sum(a == b for a, b in zip(found, new)) <= len(new) // 10
    other = [r.text for r in run(spark, texts[:20], key="another")]
    assert sum(a == r.text for a, r in zip(other, rows)) <= 4


def test_small_domain_is_permuted(spark):
    """All addresses of two characters: the results are the same set."""
    letters = [f"{a}{b}@x.org" for a in "abcdefghijklmnopqrstuvwxyz" for b in "0123456789"]
    assert sorted(r.text for r in run(spark, letters)) == sorted(letters)


def test_what_is_not_valid_stays(spark):
    texts = [
        "4785380592391142", "300.1.1.1", "1.2.3.4.5", "000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567",
        "1985-02-29", "30.02.2001", "13/31/2001", "1799-12-31", "token = 24be64439e3e49cf46b2d7c90f3602a3d0b907ff",
        "x4111111111111111", "4111111111111111y", "a@b", "@x.org", "2024-01-01T10:00", "DE00370400440532013000",
        "123456789012", "a" * 65 + "@x.org", "1 2 3", "",
    ]
    for text, r in zip(texts, run(spark, texts)):
        assert (r.text, r.found) == (text, []), text


def test_texts_around_values(spark):
    card_ = "4111 1111-1111 1111"
    texts = [
        f"{card_}", f"é{card_}", f"###{card_}$$$\n{card_}", None, f"{card_} " * 500 + "x" * 100_000, "a." * 60_000 + "b",
        "1.1.1.1,2.2.2.2", "mail a@b.org.", "(a@b.org)",
    ]
    rows = run(spark, texts)
    new = rows[0].text
    assert luhn(re.sub(r"\D", "", new)) and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", card_) and new != card_
    assert [rows[i].text for i in (1, 2, 3)] == [f"é{new}", f"###{new}$$$\n{new}", None]
    assert rows[3].found == []
    assert rows[4].text == f"{new} " * 500 + "x" * 100_000
    assert rows[5].text == texts[5]
    assert [rows[i].found for i in (6, 7, 8)] == [["ipv4", "ipv4"], ["email"], ["email"]]
    assert rows[7].text.endswith("@b.org.") and rows[8].text.endswith("@b.org)")


def test_values_with_more_behind_or_before(spark):
    card_, other, account, call = "4111 1111 1111 1111", "5500-0000-0000-0004", "BE68 5390 0754 7034", "+44 20 7946 0958"
    new = {v: r.text for v, r in zip((card_, other, account, call), run(spark, [card_, other, account, call]))}
    assert all(v != n for v, n in new.items())
    address = run(spark, ["10.0.0.1"])[0].text
    cases = {
        f"{card_} 12/25": (f"{new[card_]} 12/25", ["card"]), f"{card_} 123": (f"{new[card_]} 123", ["card"]),
        f"{account} OK": (f"{new[account]} OK", ["iban"]), f"paid {account} EUR 5": (f"paid {new[account]} EUR 5", ["iban"]),
        f"{call} 12": (f"{new[call]} 12", ["number"]), f"tel {call}-7.": (f"tel {new[call]}-7.", ["number"]),
        f"no 12 {card_}": (f"no 12 {new[card_]}", ["card"]), f"1234 {card_}": (f"1234 {new[card_]}", ["card"]),
        f"{card_} {other} 7": (f"{new[card_]} {new[other]} 7", ["card", "card"]),
        f"{card_} 10.0.0.1 é": (f"{new[card_]} {address} é", ["card", "ipv4"]),
        f"é {account} AB {card_} 12": (f"é {new[account]} AB {new[card_]} 12", ["iban", "card"]),
    }
    for (text, wanted), r in zip(cases.items(), run(spark, list(cases))):
        assert (r.text, r.found) == wanted, text


def test_unending_number_is_not_left(spark):
    """Nothing says where it ends; all of it is replaced."""
    for text, r in zip(texts := ["+441234567890123", "+99 12 345 678 901 23"], run(spark, texts)):
        assert r.found == ["number"] and r.text != text and len(r.text) == len(text)


def test_other_columns_and_tables(spark):
    rows = [(i, t, "m", 1) for i, t, _ in documents() if t is None or not re.search("[0-9@]", t)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = pseudonymized(df, "k")
    assert found.columns == df.columns
    assert sorted(found.collect(), key=repr) == sorted(df.collect(), key=repr)
    assert pseudonymized(df.filter(F.lit(False)), "k", finds_column="f").collect() == []


def test_no_python_on_the_executors(spark):
    df = spark.createDataFrame([(1, "a@b.org 1.2.3.4", "m", 1)], SCHEMA)
    plan = pseudonymized(df, "k", finds_column="f")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)


# -- the texts recomputed by plain Python --------------------------------------------


def digest(*parts):
    return hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()


def permuted(value, a, b, *name):
    left, right = divmod(value, b)
    for i in range(1, 9):
        if i % 2:
            left = (left + int(digest(*name, i, right)[:15], 16)) % a
        else:
            right = (right + int(digest(*name, i, left)[:15], 16)) % b
    return left * b + right


def permuted_digits(digits, *name):
    n = len(digits)
    return f"{permuted(int(digits), 10 ** (n // 2), 10 ** (n - n // 2), *name, n):0{n}d}"


def permuted_characters(value, *name):
    halves = [value[: len(value) // 2], value[len(value) // 2 :]]
    for i in range(1, 9):
        half, other = halves[(i + 1) % 2], halves[i % 2]
        new = ""
        for j, c in enumerate(half):
            by = int(digest(*name, i, j // 32, other)[2 * (j % 32) : 2 * (j % 32) + 2], 16)
            for base, size in (("a", 26), ("A", 26), ("0", 10)):
                if 0 <= ord(c) - ord(base) < size:
                    c = chr(ord(base) + (ord(c) - ord(base) + by) % size)
                    break
            new += c
        halves[(i + 1) % 2] = new
    return "".join(halves)


def refilled(match, new, kept="0-9"):
    new = iter(new)
    return re.sub(f"[{kept}]", lambda _: next(new), match)


DATES = ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y")


def pseudonym(kind, m, key):
    digits = re.sub("[^0-9]", "", m)
    if kind == "email":
        local, _, domain = m.rpartition("@")
        return permuted_characters(local, key, "email") + "@" + domain
    if kind == "iban":
        compact = m.replace(" ", "")
        x = permuted_characters(compact[4:], key, "iban")
        check = 98 - int("".join(str(int(c, 36)) for c in x + m[:2] + "00")) % 97
        return refilled(m, f"{m[:2]}{check:02d}{x}", "A-Z0-9")
    if kind == "ipv4":
        value = permuted(int.from_bytes(bytes(map(int, m.split("."))), "big"), 65536, 65536, key, "ipv4")
        return ".".join(map(str, value.to_bytes(4, "big")))
    if kind == "date":
        pattern = DATES[0 if m[4] == "-" else 1 if m[4] == "/" else 2 if m[2] == "." else 3]
        first = datetime.date(1800, 1, 1)
        day = (datetime.datetime.strptime(m, pattern).date() - first).days
        new = first + datetime.timedelta(permuted(day, 189, 773, key, "date"))
        return new.strftime(pattern)
    if kind == "ssn":
        area = int(m[:3])
        value = permuted(((area - 1 - (area > 666)) * 99 + int(m[4:6]) - 1) * 9999 + int(m[7:]) - 1, 88902, 9999, key, "ssn")
        area = value // 989901 + 1
        return f"{area + (area >= 666):03d}-{value // 9999 % 99 + 1:02d}-{value % 9999 + 1:04d}"
    if kind == "phone":
        a, b, c = int(digits[-10:-7]), int(digits[-7:-4]), int(digits[-4:])
        value = permuted((a - 200) * 8000000 + (b - 200) * 10000 + c, 80000, 80000, key, "phone")
        return refilled(m, f"{digits[:-10]}{value // 8000000 + 200}{value // 10000 % 800 + 200}{value % 10000:04d}")
    if kind == "number":
        return refilled(m, digits[:2] + permuted_digits(digits[2:], key, "number"))
    body = digits[0] + permuted_digits(digits[1:-1], key, "card")
    return refilled(m, body + next(c for c in "0123456789" if luhn(body + c)))


PLANS = {"1": 11, "7": 11, "30": 12, "33": 11, "34": 11, "351": 12, "420": 12, "44": 12, "48": 11}


def kind_of(m, formats=tuple(FORMATS)):
    """The first format that fits, if the value is valid in it."""
    digits = re.sub("[^0-9]", "", m)
    for kind in formats:
        if re.fullmatch(FORMATS[kind], m):
            fits = valid(kind, m)
            if kind == "card":
                fits = 13 <= len(digits) <= 19 and luhn(digits)
            elif kind == "iban":
                fits = 15 <= len(m.replace(" ", "")) <= 34 and iban_ok(m)
            elif kind == "ipv4":
                fits = all(int(x) < 256 for x in m.split("."))
            elif kind == "phone":
                fits = True
            elif kind == "number":
                fits = 8 <= len(digits) <= next((n for c, n in PLANS.items() if digits.startswith(c)), 15)
            return kind if fits else None
    return None


def value_at(text, at):
    """(kind, value) of what starts at a place, None if nothing does."""
    # the date's group is the first one here as well
    found = re.compile("(?:" + "|".join(FORMATS.values()) + ")(?![A-Za-z0-9])").match(text, at)
    if not found or (at and re.match("[A-Za-z0-9]", text[at - 1])):
        return None
    m = found[0]
    kind = kind_of(m)
    longer = ("iban", "number", "card")
    if kind is None and any(re.fullmatch(FORMATS[n], m) for n in longer):
        for end in range(len(m) - 1, 0, -1):
            if not re.match("[A-Za-z0-9]", m[end]) and kind_of(m[:end], longer):
                return kind_of(m[:end], longer), m[:end]
        kind = "number" if m[0] == "+" else None
    return kind and (kind, m)


def brute(text, key):
    """(text with pseudonyms, kinds), from left to right."""
    new, kinds, at = [], [], 0
    while at < len(text):
        found = value_at(text, at)
        if found:
            kinds.append(found[0])
            new.append(pseudonym(*found, key))
            at += len(found[1])
        else:
            new.append(text[at])
            at += 1
    return "".join(new), kinds


def test_texts_are_those_of_plain_python(spark):
    rng = random.Random(12)
    made = {k: values(k, 60) for k in FORMATS}
    made["junk"] = ["12", "x4111111111111111", "1985-02-29", "300.1.1.1", "OK", "é", "4785380592391142", "+44", "a@b", "EUR 5"]
    texts = [v for some in made.values() for v in some]
    for _ in range(400):
        parts = [rng.choice(made[rng.choice(list(made))]) for _ in range(rng.randrange(1, 7))]
        texts.append("".join(p + rng.choice([" ", " ", " ", ", ", "\n", "-", "/", " 7 ", ".", "(", "x "]) for p in parts))
    for text, r in zip(texts, run(spark, texts, key="a key")):
        assert (r.text, r.found) == brute(text, "a key"), text
