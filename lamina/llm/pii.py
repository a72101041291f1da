"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

One pattern finds values; each is validated by its kind (checksum, ranges, calendar) and left alone if it fails.  Valid numbers and
dates are keyed-permuted within their format: the value becomes a number in the kind's domain, which is a product of two ranges, a
Feistel network of ``ROUNDS`` rounds (modular addition of a keyed SHA-256) permutes that domain, and the result is written in the
original format.  The permutation is one-to-one and depends on key, kind and length only, so equal values stay linked across documents
and different ones stay apart, with no table and no shuffle.  A value has one pseudonym in all its formats: 212-555-1234 and
+1 (212) 555-1234 stay one number, 1990-12-31, 31/12/1990 and 12/31/1990 one day (a day that is written as mm/dd/yyyy and becomes one of
the first twelve of its month reads both ways, as such dates do).  Mail addresses have no number behind them: their parts become keyed
digests.  The key is a one-row table, looked up by a scalar subquery, so it doesn't stand in plans, the UI or event logs.

| kind | validated by | domain |
|---|---|---|
| card | 13 to 19 digits, one run or groups, Luhn | all but the check digit, which is made anew |
| phone | North American, with or without 1: exchange from 200 on; between spaces only the area, too | all areas, exchanges from 200 on |
| phone | with + and country code: 8 to 15 digits, the first not 0 | last 10 digits (at most all but the first) |
| ssn | area not 000, 666, 9xx; group not 00; serial not 0000 | the valid numbers |
| ip | four parts up to 255 | all addresses |
| date | calendar; years 1900 to 2099; yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, dd/mm/yyyy, or mm/dd/yyyy where that alone is a date | all days of these years |
| mail | its pattern | keyed digests |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamina.llm.common import adds, quoted

ROUNDS = 10
CARD = r"(?<![\d.])(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})(?![\d]|\.\d)"
PHONE = r"(?<![\d+])(?:(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]?\(?\d{2,4}\)?){2,5})(?!\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
IP = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
DATE = r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\d/-]|\.\d)"
MAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])"
KINDS = ("mail", "ip", "ssn", "date", "phone", "card")
# values other than mail start with a digit, a plus or a bracket: all other places fail at their first letter
NUMBERS = r"(?=[\d+(])(?:" + "|".join((IP, SSN, DATE, PHONE, CARD)) + ")"
# back references count over the whole pattern, and only cards, which come last, have groups
ANY = MAIL + "|" + NUMBERS


def _text(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def permuted(value: str, left: str, right: str, key: str, tag: str) -> str:
    """SQL: the image of ``value`` in 0 .. left * right - 1 under the permutation named by ``key`` and ``tag`` (SQL strings)."""
    def noise(half: str) -> str:
        return f"CAST(conv(substring(sha2(concat_ws('|', {key}, {tag}, CAST(r AS string), CAST({half} AS string)), 256), 1, 15), 16, 10) AS bigint)"

    start = f"named_struct('a', CAST(({value}) div ({right}) AS bigint), 'b', CAST(({value}) % ({right}) AS bigint))"
    step = f"""CASE WHEN r % 2 = 0 THEN named_struct('a', pmod(s.a + {noise('s.b')}, CAST({left} AS bigint)), 'b', s.b)
                    ELSE named_struct('a', s.a, 'b', pmod(s.b + {noise('s.a')}, CAST({right} AS bigint))) END"""
    return f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, r) -> {step}, s -> s.a * CAST({right} AS bigint) + s.b)"


def _power(n: str) -> str:
    return f"CAST(rpad('1', CAST(({n}) + 1 AS int), '0') AS bigint)"


def permuted_digits(digits: str, key: str, tag: str) -> str:
    """SQL: a string of up to 18 digits, permuted among those of its length."""
    n = f"length({digits})"
    number = permuted(f"CAST({digits} AS bigint)", _power(f"{n} div 2"), _power(f"{n} - {n} div 2"), key, f"concat({_text(tag)}, CAST({n} AS string))")
    return f"lpad(CAST({number} AS string), {n}, '0')"


def luhn_sum(digits: str, doubled: int) -> str:
    """SQL: Luhn sum of a digit string; counted from the right (0), digits at places of parity ``doubled`` count twice."""
    d = f"CAST(substring({digits}, length({digits}) - i, 1) AS int)"
    return f"aggregate(sequence(0, length({digits}) - 1), 0, (t, i) -> t + CASE WHEN i % 2 = {doubled} THEN 2 * {d} - CASE WHEN {d} > 4 THEN 9 ELSE 0 END ELSE {d} END)"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '\\\\D', '')"


def _refill(m: str, digits: str) -> str:
    """SQL: ``m`` with its digits replaced, in order."""
    return f"array_join(transform(split({m}, '\\\\d', -1), (g, i) -> concat(g, substring({digits}, i + 1, 1))), '')"


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` bound to ``value``, so that it is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _card(m: str, key: str) -> str:
    head = permuted_digits("h", key, "card")
    check = f"CAST(pmod(-{luhn_sum('p', 0)}, 10) AS string)"
    new = _let("substring(d, 1, length(d) - 1)", "h", _let(head, "p", _refill(m, f"concat(p, {check})")))
    return _let(_digits(m), "d", f"CASE WHEN {luhn_sum('d', 1)} % 10 = 0 THEN {new} ELSE {m} END")


def _phone(m: str, key: str) -> str:
    def part(start: int, n: int) -> str:
        return f"CAST(substring(h, {start}, {n}) AS bigint)"

    # North American: 1,000 areas, 800 exchanges, 10,000 lines, whether a 1 stands before them or not; what only spaces part may be
    # any numbers, so the area has to be one, too
    index = f"({part(1, 3)} * 800 + {part(4, 3)} - 200) * 10000 + {part(7, 4)}"
    made = _let(permuted(index, "1000 * 800", "10000", key, "'nanp'"), "v",
                "concat(lpad(CAST(v div (800 * 10000) AS string), 3, '0'), CAST((v div 10000) % 800 + 200 AS string), lpad(CAST(v % 10000 AS string), 4, '0'))")
    valid = f"substring(h, 4, 1) >= '2' AND (substring(h, 1, 1) >= '2' OR {m} NOT RLIKE '^[0-9 ]+$')"
    near = _let("right(d, 10)", "h", f"CASE WHEN {valid} THEN {_let(made, 'p', _refill(m, 'concat(left(d, length(d) - 10), p)'))} ELSE {m} END")
    tail = "least(10, length(d) - 1)"
    far = _let(f"right(d, {tail})", "h", _let(permuted_digits("h", key, "phone"), "p", _refill(m, f"concat(left(d, length(d) - {tail}), p)")))
    return _let(_digits(m), "d", f"""CASE WHEN length(d) = 10 AND {m} NOT LIKE '+%' OR length(d) = 11 AND d LIKE '1%' THEN {near}
        WHEN {m} LIKE '+%' AND length(d) BETWEEN 8 AND 15 AND d RLIKE '^[2-9]' THEN {far} ELSE {m} END""")


def _ssn(m: str, key: str) -> str:
    area, group, serial = (f"CAST(substring({m}, {a}, {n}) AS bigint)" for a, n in ((1, 3), (5, 2), (8, 4)))
    index = f"(({area} - CASE WHEN {area} > 666 THEN 2 ELSE 1 END) * 99 + {group} - 1) * 9999 + {serial} - 1"
    new = _let(permuted(index, "898 * 99", "9999", key, "'ssn'"), "v", _let("v div (99 * 9999)", "a",
          "concat(lpad(CAST(a + CASE WHEN a >= 665 THEN 2 ELSE 1 END AS string), 3, '0'), '-', lpad(CAST((v div 9999) % 99 + 1 AS string), 2, '0'), '-', lpad(CAST(v % 9999 + 1 AS string), 4, '0'))"))
    return f"CASE WHEN {area} NOT IN (0, 666) AND {area} < 900 AND {group} > 0 AND {serial} > 0 THEN {new} ELSE {m} END"


def _ip(m: str, key: str) -> str:
    number = "aggregate(p, CAST(0 AS bigint), (t, x) -> t * 256 + CAST(x AS bigint))"
    new = _let(permuted(number, "65536", "65536", key, "'ip'"), "v", "concat_ws('.', CAST(v div 16777216 AS string), CAST(v div 65536 % 256 AS string), CAST(v div 256 % 256 AS string), CAST(v % 256 AS string))")
    return _let(f"split({m}, '[.]')", "p", f"CASE WHEN forall(p, x -> CAST(x AS int) < 256) THEN {new} ELSE {m} END")


def _date(m: str, key: str) -> str:
    # 73,049 days = 17 * 4,297
    new = permuted("datediff(d, DATE'1900-01-01')", "17", "4297", key, "'date'")
    branches = [(f"{m} LIKE '____-%'", "yyyy-MM-dd"), (f"{m} LIKE '____/%'", "yyyy/MM/dd"), (f"{m} LIKE '__.%'", "dd.MM.yyyy"), (f"{m} RLIKE '^(0[1-9]|1[0-2])/(1[3-9]|[23][0-9])/'", "MM/dd/yyyy"), (f"{m} LIKE '__/%'", "dd/MM/yyyy")]
    cases = " ".join(f"WHEN {test} THEN " + _let(f"CAST(try_to_timestamp({m}, '{form}') AS date)", "d", f"CASE WHEN d BETWEEN DATE'1900-01-01' AND DATE'2099-12-31' THEN date_format(date_add(DATE'1900-01-01', CAST({new} AS int)), '{form}') ELSE {m} END") for test, form in branches)
    return f"CASE {cases} ELSE {m} END"


def _mail(m: str, key: str) -> str:
    # the domain of equal domains stays equal, too
    return f"concat('u', left(sha2(concat_ws('|', {key}, 'mail', lower({m})), 256), 16), '@d', left(sha2(concat_ws('|', {key}, 'domain', lower(substring_index({m}, '@', -1))), 256), 8), '.example')"


def pseudonym(m: str, key: str) -> str:
    """SQL: the pseudonym of one found value, or the value where it isn't valid."""
    return f"""CASE WHEN {m} LIKE '%@%' THEN {_mail(m, key)}
        WHEN {m} RLIKE '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$' THEN {_ip(m, key)}
        WHEN {m} RLIKE '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN {_ssn(m, key)}
        WHEN {m} RLIKE '^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}|[0-9]{{2}}[.][0-9]{{2}}[.][0-9]{{4}}|[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}})$' THEN {_date(m, key)}
        WHEN {m} RLIKE '^([0-9]+|[0-9]{{4}}([ -])[0-9]{{4}}\\\\2[0-9]{{4}}\\\\2[0-9]{{4}}|[0-9]{{4}}([ -])[0-9]{{6}}\\\\3[0-9]{{5}})$' THEN {_card(m, key)}
        ELSE {_phone(m, key)} END"""


def pseudonymise(df: DataFrame, key: str, text: str = "text", count: str = "n_pii") -> DataFrame:
    """``df`` with the personal data in ``text`` replaced, and the number of replaced values as int ``count``.

    A null text stays null and an empty one empty (0 values); texts without a valid value are untouched; a value that is found but not
    valid stays.  Texts of any length are worked on in whole; repeated rows get the same result.  A column named like ``count`` gives
    way.  No shuffle.
    """
    t = quoted([text])[0]
    kept = adds(df, count)
    own = F.col(t).cast("string")
    # the mail pattern is tried only where there is an at sign
    matches = F.when(F.instr(own, "@") > 0, F.regexp_extract_all(own, F.lit(ANY), F.lit(0))).when(own.rlike(NUMBERS), F.regexp_extract_all(own, F.lit(NUMBERS), F.lit(0)))
    secret = df.sparkSession.createDataFrame([(key,)], "key string")
    found = df.select(*quoted(kept), matches.alias("__m"), secret.select("key").scalar().alias("__key"))
    found = found.withColumn("__n", F.expr(f"transform(__m, m -> {pseudonym('m', '__key')})"))
    gaps = F.when(F.instr(own, "@") > 0, F.split(own, ANY, -1)).otherwise(F.split(own, NUMBERS, -1))
    new: Column = F.expr("array_join(transform(__g, (g, i) -> concat(g, coalesce(get(__n, i), ''))), '')")
    out = found.withColumn("__g", F.when(F.size("__m") > 0, gaps))
    changed = F.coalesce(F.expr("size(filter(zip_with(__m, __n, (x, y) -> x <> y), c -> c))"), F.lit(0))
    columns = [F.when(F.size("__m") > 0, new).otherwise(own).alias(c) if c.lower() == text.lower() else F.col(quoted([c])[0]) for c in kept]
    return out.select(*columns, changed.alias(count))
