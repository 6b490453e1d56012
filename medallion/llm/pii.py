"""Format-preserving pseudonyms of personal numbers, dates and addresses, in SQL functions only.

Every value is replaced by one of the same format under a keyed permutation of all
valid values of that format: a Feistel network, whose rounds alternately shift one
half of the value by a keyed hash of the other half. It depends on nothing but key,
format and value, so equal values stay equal across documents, different ones stay
different, and who has the key can invert it.

Formats and what is validated and kept:

* card: 13 to 19 digits with a right check digit (Luhn); the first digit and the
  separators stay, the rest is permuted and the check digit is computed anew
* phone: North American numbers, with or without +1, area and exchange from 200 on;
  permuted among those. Other numbers with + and 8 to 15 digits keep the first two
* ipv4: four numbers up to 255, permuted as a whole
* ssn: three parts, none of those that are never given out
* date: a day of the calendar from 1800 to 2199, as yyyy-mm-dd, yyyy/mm/dd,
  dd.mm.yyyy or mm/dd/yyyy, permuted among the days of these 400 years
* iban: 15 to 34 characters with right check digits; the country stays, letters and
  digits are permuted, each within its own kind, and the check digits are computed anew
* email: letters and digits of the local part are permuted, each within its own
  kind; other characters and the domain stay

Values that fail validation stay as they are. A value is found only if no letter
or digit touches it. At every place where one may start, the longest match of the
first format that fits is tried; if it is not valid, cards, accounts and numbers with +
are tried with shorter ends as well, at the separators inside, longest first. Values
are taken from left to right, and the text goes on right behind each.
Numbers with + whose country has a longest subscriber number end there if a separator
does; the others, and those without such an end, are taken whole.

Defined results: a null text stays null and has no finds; an empty one stays empty;
repeated rows are treated alike; an empty table gives no rows. Only the text column
is replaced, all others are returned as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 8
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,10}[A-Za-z]{2,24}"
_IPV4 = r"(?<!\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])"
_NANP = r"(?:(?<!\+)\+?1[ .-]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[ .-])[2-9][0-9]{2}[ .-][0-9]{4}"
_PHONE = r"(?<!\+)\+[1-9](?:[ .-]?\(?[0-9]\)?){7,14}"
_DATE = r"(?<![-/.])(?:[0-9]{4}([-/])[0-9]{2}\1[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![-/.]?[0-9])"
_SSN = r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-)"
_CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
_IBAN = r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
FORMATS = {"email": _EMAIL, "iban": _IBAN, "ipv4": _IPV4, "date": _DATE, "ssn": _SSN, "phone": _NANP, "number": _PHONE, "card": _CARD}
#: matches nothing before each place where a value may start; group 1 is what may be one, so group 1 of a date is 2
ANY = r"(?<![A-Za-z0-9])(?=(" + "|".join(FORMATS.values()).replace("\\1", "\\2") + r")(?![A-Za-z0-9]))"
#: formats of which a match may have taken more than the value
LONGER = ("iban", "number", "card")
#: most digits of subscriber numbers, with the country, where its plan has one length for the longest
_PLANS = {"1": 11, "7": 11, "30": 12, "33": 11, "34": 11, "351": 12, "420": 12, "44": 12, "48": 11}


def _text(value: str) -> str:
    """A string literal of SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hash(key: str, *parts: str) -> str:
    return f"sha2(concat_ws('|', {_text(key)}, {', '.join(parts)}), 256)"


def _feistel(value: str, a: str, b: str, key: str, name: str) -> str:
    """A permutation of the numbers below a * b."""

    def shift(other: str) -> str:
        return f"cast(conv(substr({_hash(key, name, 'i', other)}, 1, 15), 16, 10) AS bigint)"

    return f"""aggregate(sequence(1, {ROUNDS}),
        named_struct('l', cast({value} AS bigint) div {b}, 'r', cast({value} AS bigint) % {b}),
        (s, i) -> if(i % 2 = 1,
            named_struct('l', (s.l + {shift('s.r')}) % {a}, 'r', s.r),
            named_struct('l', s.l, 'r', (s.r + {shift('s.l')}) % {b})),
        s -> s.l * {b} + s.r)"""


def _permuted_digits(digits: str, key: str, name: str) -> str:
    """Digit strings of up to 18 digits, among those of the same length."""
    half = f"cast(pow(10, length({digits}) div 2) AS bigint)"
    rest = f"cast(pow(10, length({digits}) - length({digits}) div 2) AS bigint)"
    found = _feistel(digits, half, rest, key, f"{name}, length({digits})")
    return f"lpad(cast({found} AS string), length({digits}), '0')"


_DIGITS = "regexp_replace(m, '[^0-9]', '')"


def _refilled(value: str, kept: str = "0-9") -> str:
    """The match with its characters of a class replaced, in their places."""
    return f"""array_join(transform(sequence(1, length(m)), p ->
        if(substr(m, p, 1) RLIKE '[{kept}]',
           substr({value}, length(regexp_replace(substr(m, 1, p), '[^{kept}]', '')), 1),
           substr(m, p, 1))), '')"""


def _mod97(value: str) -> str:
    """The remainder that IBANs are checked by; letters count as two digits from 10 on."""
    return f"""aggregate(transform(sequence(1, length({value})), p -> substr({value}, p, 1)), 0, (t, c) ->
        if(c BETWEEN '0' AND '9', (t * 10 + ascii(c) - 48) % 97, (t * 100 + ascii(c) - 55) % 97))"""


def _luhn(digits: str, first_doubled: int) -> str:
    """The Luhn sum; the last digit is doubled if first_doubled is 1."""
    digit = f"cast(substr({digits}, -k, 1) AS int)"
    return f"""aggregate(sequence(1, length({digits})), 0, (t, k) -> t +
        if((k + {first_doubled}) % 2 = 0, {digit} * 2 - if({digit} > 4, 9, 0), {digit}))"""


def _shape(name: str) -> str:
    return f"m RLIKE {_text('^(?:' + FORMATS[name] + ')$')}"


def _date_parts() -> list[tuple[str, str]]:
    """(condition, pattern) of the ways to write a date."""
    return [
        ("substr(m, 5, 1) = '-'", "yyyy-MM-dd"), ("substr(m, 5, 1) = '/'", "yyyy/MM/dd"),
        ("substr(m, 3, 1) = '.'", "dd.MM.yyyy"), ("substr(m, 3, 1) = '/'", "MM/dd/yyyy"),
    ]


#: the first day and the number of days of the 400 years; 146097 = 189 * 773
_FIRST_DAY, _DAYS_A, _DAYS_B = "unix_date(date'1800-01-01')", 189, 773
_DAY = "unix_date(CASE " + " ".join(f"WHEN {c} THEN to_date(try_to_timestamp(m, '{p}'))" for c, p in _date_parts()) + " END)"
_OCTETS = "transform(split(m, '[.]'), o -> cast(o AS bigint))"
_COMPACT = "replace(m, ' ', '')"
_NATIONAL = f"right({_DIGITS}, 10)"


def _validity() -> dict[str, str]:
    octets = f"forall({_OCTETS}, o -> o <= 255)"
    day = f"{_DAY} - {_FIRST_DAY} BETWEEN 0 AND {_DAYS_A * _DAYS_B - 1}"
    ssn = "substr(m, 1, 3) NOT IN ('000', '666') AND substr(m, 1, 1) <> '9' AND substr(m, 5, 2) <> '00' AND substr(m, 8, 4) <> '0000'"
    card = f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_luhn(_DIGITS, 0)} % 10 = 0"
    most = " ".join(f"WHEN startswith({_DIGITS}, '{country}') THEN {n}" for country, n in _PLANS.items())
    number = f"length({_DIGITS}) BETWEEN 8 AND CASE {most} ELSE 15 END"
    turned = f"concat(substr({_COMPACT}, 5), left({_COMPACT}, 4))"
    iban = f"length({_COMPACT}) BETWEEN 15 AND 34 AND {_mod97(turned)} = 1"
    return {"email": "true", "iban": iban, "ipv4": octets, "date": day, "ssn": ssn, "phone": "true", "number": number, "card": card}


def _pseudonyms(key: str) -> dict[str, str]:
    def given(value: str, result: str) -> str:
        """An expression over x, which stands for a value that is computed once."""
        return f"element_at(transform(array({value}), x -> {result}), 1)"

    address = _feistel(f"aggregate({_OCTETS}, 0L, (t, o) -> t * 256 + o)", "65536", "65536", key, "'ipv4'")
    ipv4 = given(address, "concat_ws('.', x div 16777216, x div 65536 % 256, x div 256 % 256, x % 256)")
    day = f"{_FIRST_DAY} + cast({_feistel(f'({_DAY} - {_FIRST_DAY})', str(_DAYS_A), str(_DAYS_B), key, _text('date'))} AS int)"
    date = "CASE " + " ".join(f"WHEN {c} THEN date_format(date_from_unix_date({day}), '{p}')" for c, p in _date_parts()) + " END"
    area = "cast(substr(m, 1, 3) AS bigint)"
    ssn_value = (
        f"(({area} - 1 - if({area} > 666, 1, 0)) * 99 + cast(substr(m, 5, 2) AS bigint) - 1) * 9999"
        " + cast(substr(m, 8, 4) AS bigint) - 1"
    )
    new_area = "x div 989901 + 1"
    ssn = given(
        _feistel(f"({ssn_value})", "88902", "9999", key, "'ssn'"),
        f"concat_ws('-', lpad(cast({new_area} + if({new_area} >= 666, 1, 0) AS string), 3, '0'),"
        " lpad(cast(x div 9999 % 99 + 1 AS string), 2, '0'), lpad(cast(x % 9999 + 1 AS string), 4, '0'))",
    )
    national = (
        f"(cast(substr({_NATIONAL}, 1, 3) AS bigint) - 200) * 8000000"
        f" + (cast(substr({_NATIONAL}, 4, 3) AS bigint) - 200) * 10000 + cast(substr({_NATIONAL}, 7, 4) AS bigint)"
    )
    phone = given(
        _feistel(f"({national})", "80000", "80000", key, "'phone'"),
        f"concat(left({_DIGITS}, length({_DIGITS}) - 10), cast(x div 8000000 + 200 AS string),"
        " cast(x div 10000 % 800 + 200 AS string), lpad(cast(x % 10000 AS string), 4, '0'))",
    )
    number = f"concat(left({_DIGITS}, 2), {_permuted_digits(f'substr({_DIGITS}, 3)', key, _text('number'))})"
    body = f"substr({_DIGITS}, 2, length({_DIGITS}) - 2)"
    permuted = f"concat(left({_DIGITS}, 1), {_permuted_digits(body, key, _text('card'))})"
    card = given(permuted, f"concat(x, cast((10 - {_luhn('x', 1)} % 10) % 10 AS string))")
    local = "substring_index(m, '@', 1)"
    iban = given(
        _permuted_characters(f"substr({_COMPACT}, 5)", key, "iban"),
        f"concat(left(m, 2), lpad(cast(98 - {_mod97("concat(x, left(m, 2), '00')")} AS string), 2, '0'), x)",
    )
    refilled = [
        f"element_at(transform(array({digits}), d -> {_refilled('d')}), 1)" for digits in (phone, number, card)
    ]
    return dict(
        email=f"concat({_permuted_characters(local, key, 'email')}, '@', substring_index(m, '@', -1))",
        iban=f"element_at(transform(array({iban}), d -> {_refilled('d', 'A-Z0-9')}), 1)", ipv4=ipv4, date=date, ssn=ssn, phone=refilled[0], number=refilled[1], card=refilled[2]
    )


def _permuted_characters(value: str, key: str, name: str) -> str:
    """Characters of one half of a text are shifted within their kind by a hash of the other half."""

    def shifted(half: str, other: str) -> str:
        block = f"(j - 1) div 32, {other}"
        by = f"cast(conv(substr({_hash(key, _text(name), 'i', block)}, 2 * ((j - 1) % 32) + 1, 2), 16, 10) AS int)"
        kinds = ((97, 26), (65, 26), (48, 10))
        cases = " ".join(
            f"WHEN ascii(c) BETWEEN {base} AND {base + size - 1} THEN chr({base} + (ascii(c) - {base} + {by}) % {size})"
            for base, size in kinds
        )
        return f"""if({half} = '', '', array_join(transform(
            transform(sequence(1, length({half})), q -> substr({half}, q, 1)),
            (c, z) -> element_at(transform(array(z + 1), j -> CASE {cases} ELSE c END), 1)), ''))"""

    return f"""aggregate(sequence(1, {ROUNDS}),
        named_struct('l', left({value}, length({value}) div 2), 'r', substr({value}, length({value}) div 2 + 1)),
        (s, i) -> if(i % 2 = 1,
            named_struct('l', {shifted('s.l', 's.r')}, 'r', s.r),
            named_struct('l', s.l, 'r', {shifted('s.r', 's.l')})),
        s -> concat(s.l, s.r))"""


def _kind(formats=FORMATS) -> str:
    """The kind of a match m, null if it is not valid."""
    valid = _validity()
    return "CASE " + " ".join(f"WHEN {_shape(n)} THEN if({valid[n]}, '{n}', null)" for n in formats) + " END"


def values(matches: str) -> Column:
    """(kind, value) of every match: all of it or, if that is not valid, its longest valid beginning."""
    ends = "filter(sequence(length(x) - 1, 1, -1), p -> substr(x, p + 1, 1) RLIKE '[^A-Za-z0-9]')"
    shorter = f"""filter(transform(transform({ends}, p -> left(x, p)), m -> named_struct('kind', {_kind(LONGER)}, 'value', m)),
        v -> v.kind IS NOT NULL)"""
    cut = "|".join(f"^(?:{FORMATS[n]})$" for n in LONGER)
    return F.expr(f"""transform(transform({matches}, m -> named_struct('kind', {_kind()}, 'value', m)), v -> CASE
        WHEN v.kind IS NULL AND v.value RLIKE {_text(cut)}
        THEN coalesce(get(element_at(transform(array(v.value), x -> {shorter}), 1), 0),
            named_struct('kind', if(left(v.value, 1) = '+', 'number', null), 'value', v.value))
        ELSE v END)""")


def pseudonymized(
    docs: DataFrame, key: str, text_column: str = "text", finds_column: str | None = None
) -> DataFrame:
    """Replace personal values in the text column; ``finds_column`` gets the kinds found, in order."""
    text = F.col(f"`{text_column}`")
    some = text.rlike("[0-9@]")  # most texts have nothing to look at
    names = {n: n for n in ("pieces", "values", "given")}
    while set(names.values()) & {c.lower() for c in docs.columns}:
        names = {n: f"_{c}" for n, c in names.items()}
    pieces, found_values, new_values = names["pieces"], names["values"], names["given"]
    # the text from each start to the next one; what precedes the first is a piece if it is not empty
    split = F.when(some, F.split(text, ANY, -1)).otherwise(F.array(text))
    starts = F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(1))).otherwise(F.array().cast("array<string>"))
    found = docs.withColumn(pieces, split).withColumn(found_values, starts).withColumn(found_values, values(f"`{found_values}`"))
    # taken: characters of a piece that belong to a value from before, which rules out its own
    found = found.withColumn(
        found_values,
        F.expr(f"""if(exists({found_values}, v -> v.kind IS NOT NULL),
            zip_with({found_values}, aggregate(
                zip_with({found_values}, slice({pieces}, size({pieces}) - size({found_values}) + 1, size({found_values})),
                    (v, p) -> named_struct('own', if(v.kind IS NULL, 0, length(v.value)), 'size', length(p))),
                named_struct('taken', 0, 'all', cast(array() AS array<int>)),
                (s, x) -> named_struct(
                    'taken', greatest(if(s.taken > 0, s.taken, x.own) - x.size, 0), 'all', concat(s.all, array(s.taken))),
                s -> s.all),
                (v, taken) -> named_struct('kind', if(taken > 0, null, v.kind), 'value', v.value, 'taken', taken)),
            cast(array() AS array<struct<kind: string, value: string, taken: int>>))"""),
    )
    new = _pseudonyms(key)
    cases = " ".join(f"WHEN k = '{n}' THEN {new[n]}" for n in FORMATS)
    given = F.expr(f"transform({found_values}, v -> element_at(transform(array(v.value), m -> element_at(transform(array(v.kind), k -> CASE {cases} END), 1)), 1))")
    found = found.withColumn(new_values, given)
    n_before = f"(size({pieces}) - size({found_values}))"
    joined = F.expr(f"""array_join(concat(slice({pieces}, 1, {n_before}),
        zip_with(zip_with({found_values}, {new_values}, (v, n) -> named_struct('v', v, 'n', n)),
            slice({pieces}, {n_before} + 1, size({found_values})),
            (x, p) -> if(x.v.kind IS NULL, substr(p, x.v.taken + 1), concat(x.n, substr(p, length(x.v.value) + 1))))), '')""")
    replaced = F.when(F.size(found_values) > 0, joined).otherwise(text)
    columns = [replaced.alias(c) if c == text_column else F.col(f"`{c}`") for c in docs.columns]
    if finds_column:
        kinds = F.transform(F.col(f"`{found_values}`"), lambda v: v["kind"])
        columns.append(F.filter(kinds, lambda k: k.isNotNull()).alias(finds_column))
    return found.select(*columns)
