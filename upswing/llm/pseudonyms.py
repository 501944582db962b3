"""Format-preserving pseudonyms for personal numbers, dates, addresses and keys.

Every match is validated (check digits, ranges, calendar), read as one or more numbers below a known
limit, sent through a keyed Feistel permutation of the numbers below that limit, and written back in
its own format. Equal values get equal pseudonyms in all documents, however they are spaced; different
values get different ones. What does not validate stays as it is. SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = "change this key"
ROUNDS = 8
CHUNK = 10  # letters and keys are permuted in pieces of so many characters
_WALK = 64  # a number that leaves its range is permuted again; one in three at most does
# First day that counts as a date, days to the end of 2099, and number ranges of a US
# social security number (areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999).
_FIRST_DAY, _DAYS = "1900-01-01", 73_049
_AREAS, _GROUPS, _SERIALS = 898, 99, 9999
# What the matches look like. Possessive runs keep the search linear.
_END = r"(?![A-Za-z0-9]|[.-]\d)"
_FORMATS = (
    r"(?:[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})"
    r"|\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}"
    r"|\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}"
    r"|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
    r"|\d{3}-\d{2}-\d{4})" + _END
)
# Card numbers as they are written: unbroken, or in groups of 4-4-4-4, 4-4-4-4-3, 4-6-4 or 4-6-5 with one
# separator throughout. Groups of four may go on: `_pieces` decides what they are. A group that starts
# another format, or that a letter or a fraction follows, is not part of a card.
_GUARD = r"(?![A-Za-z0-9]|\.\d)"
_FOUR = r"\d{4}" + _GUARD
_JOINS = ("-", rf"[ ](?!{_FORMATS})")
_GROUPED = "|".join(
    [rf"{_FOUR}(?:{j}{_FOUR}){{3,}}+(?:{j}\d{{3}}{_GUARD})?+" for j in _JOINS]
    + [rf"{_FOUR}{j}\d{{6}}{j}\d{{4,5}}{_GUARD}" for j in _JOINS]
)
# Groups with a number before and one behind them are part of a table.
_CARDS = rf"(?<!\d[ -])(?:{_GROUPED})|(?:{_GROUPED})(?![ -]\d)|\d{{13,19}}{_GUARD}"
PATTERN = (
    rf"(?<![A-Za-z0-9._%+-])(?:{_FORMATS}|{_CARDS})"
    r"|(?<=(?i:token|secret|key|password)[ ]{0,3}[=:][ ]{0,3}[\"']{0,1})"
    r"[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"
)
# First digits of card numbers by issuer, with the lengths that go with them.
_ISSUERS = (
    r"4[0-9]{12}|4[0-9]{15}|4[0-9]{18}",
    r"5[1-5][0-9]{14}",
    r"2(22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)[0-9]{12}",
    r"3[47][0-9]{13}",
    r"3(0[0-5]|[68][0-9])[0-9]{11}",
    r"35(2[89]|[3-8][0-9])[0-9]{12}",
    r"6(011|4[4-9][0-9]|5[0-9]{2})[0-9]{12,15}",
    r"62[0-9]{14,17}",
    r"(50|5[6-9]|6[0-9])[0-9]{11,17}",
)
_KEPT = "if(d LIKE '4%', 1, 4)"  # digits of a card number that tell its issuer and stay
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_BASE_26 = "0123456789abcdefghijklmnop"


def _let(name: str, value: str, body: str) -> str:
    """SQL for `body` with `name` standing for `value`, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _power(base: str, exponent: str) -> str:
    return f"aggregate(sequence(1, {exponent}), 1L, (product, step) -> product * {base})"


def permuted(number: str, limit: str, tweak: str, key: str) -> str:
    """SQL of a keyed permutation of the numbers from 0 to `limit` - 1: an alternating Feistel network
    on the coordinates of the number in a p x q grid that holds the range, walked until back in it."""
    secret = key.replace("\\", "\\\\").replace("'", "\\'")

    def digest(value: str) -> str:
        return (
            f"CAST(conv(substr(sha2(concat_ws('|', '{secret}', {tweak}, CAST({limit} AS STRING),"
            f" CAST(i AS STRING), CAST({value} AS STRING)), 256), 1, 15), 16, 10) AS BIGINT)"
        )

    network = (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('a', s.x div q, 'b', s.x % q), (r, i) -> "
        f"if(i % 2 = 1, named_struct('a', (r.a + {digest('r.b')} % p) % p, 'b', r.b), "
        f"named_struct('a', r.a, 'b', (r.b + {digest('r.a')} % q) % q)), r -> r.a * q + r.b)"
    )
    walked = _let("y", network, f"named_struct('x', y, 'done', y < {limit})")
    walk = (
        f"aggregate(sequence(1, {_WALK}), named_struct('x', {number}, 'done', false), "
        f"(s, w) -> if(s.done, s, {walked}), s -> s.x)"
    )
    grid = _let("q", f"({limit} + p - 1) div p", walk)
    return _let("p", f"CAST(ceil(sqrt(CAST({limit} AS DOUBLE))) AS BIGINT)", grid)


def _number(value: str, limit: str) -> str:
    return (
        f"named_struct('x', CAST({value} AS BIGINT), 'n', CAST({limit} AS BIGINT), 'base', 10, 'width', 20)"
    )


def _symbols(string: str, base: int) -> str:
    """Numbers of the pieces of a string of digits to `base`."""
    piece = _let(
        "t", f"substr({string}, k * {CHUNK} + 1, {CHUNK})",
        f"named_struct('x', CAST(conv(t, {base}, 10) AS BIGINT), 'n', {_power(str(base), 'length(t)')},"
        f" 'base', {base}, 'width', length(t))",
    )
    pieces = f"transform(sequence(0, (length({string}) - 1) div {CHUNK}), k -> {piece})"
    none = "filter(array(named_struct('x', 0L, 'n', 1L, 'base', 10, 'width', 1)), z -> false)"
    return f"if(length({string}) = 0, {none}, {pieces})"


def _filled(template: str, symbols: str, kind: str) -> str:
    """The template with its characters of a kind replaced by the symbols, in order."""
    return (
        f"aggregate(split({template}, ''), named_struct('i', 1, 'out', ''), (f, ch) -> "
        f"if(ch RLIKE '^{kind}$', "
        f"named_struct('i', f.i + 1, 'out', concat(f.out, substr({symbols}, f.i, 1))), "
        f"named_struct('i', f.i, 'out', concat(f.out, ch))), f -> f.out)"
    )


def _is_card(value: str) -> str:
    """SQL whether a string is a card number: its shape, its issuer's digits and length, its check digit."""
    shape = (
        "^([0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\\\\2[0-9]{4}\\\\2[0-9]{4}(\\\\2[0-9]{3})?"
        "|[0-9]{4}([ -])[0-9]{6}\\\\4[0-9]{4,5})$"
    )
    issuer = "^(" + "|".join(_ISSUERS) + ")$"
    digits = _let("t", f"regexp_replace({value}, '[ -]', '')", f"if(t RLIKE '{issuer}', luhn_check(t), false)")
    return f"if({value} RLIKE '{shape}', {digits}, false)"


def _pieces() -> str:
    """SQL from a match `m` to its pieces: itself, or of groups of four digits the card numbers and what
    is between.

    Four groups can be a card, with a last one of three digits or without it. Of five, the first four or
    else the last four can. More are a table of numbers, unless each four of them are a card."""
    first, second, tail = "left(m, 19)", "substr(m, 6, 19)", "substr(m, 6)"
    fours = f"if(n = 4, array({first}, substr(m, 20)), array(m))"
    fives = (
        f"CASE WHEN {_is_card(first)} THEN array({first}, substr(m, 20))"
        f" WHEN {_is_card(tail)} THEN array(left(m, 5), {tail})"
        f" ELSE array(left(m, 5), {second}, substr(m, 25)) END"
    )
    quads = "transform(sequence(0, n div 4 - 1), k -> substr(m, 20 * k + 1, 19))"
    every = _let(
        "q", quads,
        f"if(n % 4 = 0 AND forall(q, c -> {_is_card('c')}),"
        " flatten(transform(q, (c, k) -> array(c, substr(m, 20 * k + 20, if(k = n div 4 - 1, 4, 1))))), array(m))",
    )
    by_number = _let(
        "n", "(length(m) + 1) div 5",
        f"CASE WHEN {_is_card('m')} THEN array(m) WHEN n = 4 THEN {fours} WHEN n = 5 THEN {fives} ELSE {every} END",
    )
    return f"if(m RLIKE '^[0-9]{{4}}([ -][0-9]{{4}}){{3}}', {by_number}, array(m))"


def _pseudonym(key: str) -> str:
    """SQL from a match `m` to its kind and pseudonym; the kind is null if it does not validate."""
    local = "lower(substring_index(m, '@', 1))"
    letters = f"translate(regexp_replace({local}, '[^a-z]', ''), '{_LETTERS}', '{_BASE_26}')"
    digits = f"regexp_replace({local}, '[^0-9]', '')"
    kind = """CASE WHEN m LIKE '%@%' THEN 'email' WHEN m LIKE '+%' THEN 'phone'
        WHEN m RLIKE '^[0-9A-Fa-f]{32,}$' THEN 'key'
        WHEN m RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{2}[./][0-9]{2}[./][0-9]{4}$' THEN 'date'
        WHEN m RLIKE '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$' THEN 'ip'
        WHEN m RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' THEN 'ssn' ELSE 'card' END"""
    day_first = "try_cast(concat(substr(m, 7, 4), '-', substr(m, 4, 2), '-', substr(m, 1, 2)) AS DATE)"
    month_first = "try_cast(concat(substr(m, 7, 4), '-', substr(m, 1, 2), '-', substr(m, 4, 2)) AS DATE)"
    day = f"""CASE WHEN m LIKE '____-%' THEN try_cast(m AS DATE)
        WHEN m LIKE '__/%' THEN coalesce({day_first}, {month_first}) ELSE {day_first} END"""
    octet = "CAST(split(m, '[.]')[{}] AS BIGINT)"
    address = " + ".join(f"{octet.format(i)} * {256 ** (3 - i)}" for i in range(4))
    in_range = " AND ".join(f"{octet.format(i)} < 256" for i in range(4))
    area, group, serial = (f"CAST(substr(m, {a}, {n}) AS BIGINT)" for a, n in ((1, 3), (5, 2), (8, 4)))
    person = f"(({area} - if({area} > 666, 2, 1)) * {_GROUPS} + {group} - 1) * {_SERIALS} + {serial} - 1"
    numbers = f"""CASE kind
        WHEN 'card' THEN if({_is_card('m')}, array({_number(f"substr(d, {_KEPT} + 1, length(d) - {_KEPT} - 1)", _power("10", f"length(d) - {_KEPT} - 1"))}), NULL)
        WHEN 'phone' THEN array({_number("right(d, least(10, length(d) - 1))", _power("10", "least(10, length(d) - 1)"))})
        WHEN 'date' THEN if({day} BETWEEN DATE'{_FIRST_DAY}' AND date_add(DATE'{_FIRST_DAY}', {_DAYS - 1}),
            array({_number(f"datediff({day}, DATE'{_FIRST_DAY}')", str(_DAYS))}), NULL)
        WHEN 'ip' THEN if({in_range}, array({_number(address, str(1 << 32))}), NULL)
        WHEN 'ssn' THEN if({area} BETWEEN 1 AND 899 AND {area} <> 666 AND {group} > 0 AND {serial} > 0,
            array({_number(person, str(_AREAS * _GROUPS * _SERIALS))}), NULL)
        WHEN 'email' THEN {_let("l", letters, _let("g", digits, f"concat({_symbols('l', 26)}, {_symbols('g', 10)})"))}
        ELSE {_let("l", "lower(m)", _symbols("l", 16))} END"""
    secret = permuted("c.x", "c.n", "concat(kind, CAST(j AS STRING))", key)
    outs = f"transform(numbers, (c, j) -> lpad(lower(conv(CAST({secret} AS STRING), 10, c.base)), c.width, '0'))"
    value = "CAST(outs[0] AS BIGINT)"
    known = f"concat(left(d, {_KEPT}), right(outs[0], length(d) - {_KEPT} - 1))"
    check = "filter(array('0','1','2','3','4','5','6','7','8','9'), z -> luhn_check(concat(body, z)))[0]"
    card = _let("body", known, _let("full", f"concat(body, {check})", _filled("m", "full", "[0-9]")))
    phone = _let(
        "full", "concat(left(d, length(d) - least(10, length(d) - 1)), right(outs[0], least(10, length(d) - 1)))",
        _filled("m", "full", "[0-9]"),
    )
    date = _let(
        "v", f"date_add(DATE'{_FIRST_DAY}', CAST({value} AS INT))",
        "if(m LIKE '____-%', date_format(v, 'yyyy-MM-dd'), if(m LIKE '__/%' AND "
        f"{day_first} IS NULL, date_format(v, 'MM/dd/yyyy'), concat(date_format(v, 'dd'), substr(m, 3, 1),"
        " date_format(v, 'MM'), substr(m, 3, 1), date_format(v, 'yyyy'))))",
    )
    ip = _let(
        "v", value,
        "concat_ws('.', " + ", ".join(f"CAST(v div {256 ** (3 - i)} % 256 AS STRING)" for i in range(4)) + ")",
    )
    ssn = _let(
        "v", value,
        f"concat(lpad(CAST(v div {_GROUPS * _SERIALS} + if(v div {_GROUPS * _SERIALS} >= 665, 2, 1) AS STRING), 3, '0'),"
        f" '-', lpad(CAST(v div {_SERIALS} % {_GROUPS} + 1 AS STRING), 2, '0'),"
        f" '-', lpad(CAST(v % {_SERIALS} + 1 AS STRING), 4, '0'))",
    )
    n_letters = f"(length({letters}) + {CHUNK - 1}) div {CHUNK}"
    email = _let(
        "ls", f"translate(array_join(slice(outs, 1, {n_letters}), ''), '{_BASE_26}', '{_LETTERS}')",
        _let(
            "ds", f"array_join(slice(outs, {n_letters} + 1, size(outs)), '')",
            _let("lt", _filled(local, "ls", "[a-z]"),
                 f"concat({_filled('lt', 'ds', '[0-9]')}, substr(m, instr(m, '@')))"),
        ),
    )
    key_out = "if(m RLIKE '[A-F]', upper(array_join(outs, '')), array_join(outs, ''))"
    written = f"""CASE kind WHEN 'card' THEN {card} WHEN 'phone' THEN {phone} WHEN 'date' THEN {date}
        WHEN 'ip' THEN {ip} WHEN 'ssn' THEN {ssn} WHEN 'email' THEN {email} ELSE {key_out} END"""
    left_alone = "named_struct('kind', CAST(NULL AS STRING), 'value', m)"
    made = _let("outs", outs, f"named_struct('kind', kind, 'value', {written})")
    chosen = _let("numbers", numbers, f"if(numbers IS NULL OR size(numbers) = 0, {left_alone}, {made})")
    return _let("kind", kind, _let("d", "regexp_replace(m, '[^0-9]', '')", chosen))


def pseudonymised(
    docs: DataFrame, key: str = KEY, text: str = "text", kinds: str | None = "private_kinds"
) -> DataFrame:
    """`docs` with pseudonyms in its text column, and in a column `kinds`, if named, the kinds of what was
    replaced in order of place (`card`, `phone`, `date`, `ip`, `ssn`, `email`, `key`).

    A card number has an issuer's first digits with their length, a check digit, and a shape that cards
    are written in; its issuer's digits stay. In groups it is found if there is no number, set off by a
    blank or hyphen, on one side at least; next to other groups of four digits, if these are five with its
    own, or all of them are cards. A date
    nn/nn/nnnn is read day first, and month first if that is none; it is written as it was read.
    The text between matches, and matches that do not validate, stay character for character. A null
    text stays null, an empty one empty, and both have no kinds. Whoever knows `key` can undo the
    permutation; choose one and keep it. A column named as `kinds` says is replaced; others are left
    alone whatever their names. An empty table gives an empty table. Rows stay where they are.
    """
    kept = [c for c in docs.columns if c != kinds]
    found, made = (_free(name, docs.columns) for name in ("found", "made"))
    none = F.array().cast("array<string>")
    matches = F.regexp_extract_all(text, F.lit(PATTERN), 0)
    # Nothing without a digit or an @ can match.
    looked = docs.select(*kept, F.when(F.col(text).rlike("[0-9@]"), matches).otherwise(none).alias(found))
    pieces = f"transform(transform({found}, m -> {_pieces()}), p -> transform(p, m -> {_pseudonym(key)}))"
    written = looked.withColumn(made, F.expr(pieces))
    between = F.split(text, PATTERN, -1)
    value = F.transform(made, lambda x: F.array_join(F.transform(x, lambda y: y["value"]), ""))
    values = F.concat(value, F.array(F.lit("")))
    joined = F.array_join(F.zip_with(between, values, lambda a, b: F.concat(a, b)), "")
    all_kinds = F.filter(F.transform(F.flatten(made), lambda x: x["kind"]), lambda k: k.isNotNull())
    columns = [
        F.when(F.size(found) > 0, joined).otherwise(F.col(text)).alias(c) if c == text else F.col(c)
        for c in kept
    ]
    if kinds is not None:
        columns.append(F.coalesce(all_kinds, none).alias(kinds))
    return written.select(*columns)


def _free(name: str, taken: list[str]) -> str:
    """A column name that is not taken, in whatever case."""
    lowered = {c.lower() for c in taken}
    while name in lowered:
        name += "_"
    return name
