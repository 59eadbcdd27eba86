"""Format-preserving pseudonyms for personal data, in DataFrame operations only.

E-mail addresses, phone numbers, card numbers, social security numbers, IPv4 addresses and dates are found by one pattern, validated,
and sent through a keyed Feistel network on the digits, letters, address bits or days that their format leaves free. The result
has the same format (separators, country code, a right check digit, a real date), and equal values get equal pseudonyms in all
documents, so links hold. What fails its validation stays.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WORD = r"[A-Za-z0-9._%+-]"
EMAIL = rf"(?<!{_WORD}){_WORD}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
PHONE = "|".join((
    r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])",
    r"(?<![0-9+])\+[0-9]{1,3}(?:[ .-][0-9]{1,4}){3,5}(?![0-9])",  # +33 6 12 34 56 78, +49 30 123 45 67
    r"(?<![0-9])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])",
    r"(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    r"(?<![0-9.])[2-9][0-9]{2}\.[2-9][0-9]{2}\.[0-9]{4}(?![0-9]|\.[0-9])",  # 415.555.2671
    r"(?<![0-9+.,-])0[1-9](?:[ .][0-9]{2}){4}(?![0-9]|[.,][0-9])",  # 06 12 34 56 78
    r"(?<![0-9+.,-])0[1-9][0-9]{1,3}[ /-][0-9]{6,8}(?![0-9]|[.,][0-9])",  # 0171 2345678
))
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])"
DATE = r"(?<![0-9])(?:(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}|[0-9]{2}\.[0-9]{2}\.(?:19|20)[0-9]{2})(?![0-9])"
KINDS = {"email": EMAIL, "phone": PHONE, "card": CARD, "ssn": SSN, "date": DATE, "ip": IP}
FOUND = "|".join(KINDS.values())

#: Where a session keeps its key; Spark's own pages hide settings with "secret" in their names.
KEY_SETTING = "spark.lexiforge.pii.secret"
#: Rounds of each Feistel network.
ROUNDS = 8
#: Days of 1900-2099 = 17 x 4297: a two-part Feistel network covers them exactly.
DAYS = (17, 4297)


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _prf(key: str, kind: str, number: str, value: str) -> str:
    """60 keyed bits."""
    return f"cast(conv(substring(sha2(concat({_sql(key + ':' + kind + ':')}, {number}, ':', {value}), 256), 1, 15), 16, 10) as bigint)"


def _feistel(key: str, kind: str, left: str, right: str, a: str, b: str) -> str:
    """struct(l, r): a permutation of [0, a) x [0, b)."""
    odd, even = _prf(key, kind, "k", "s.l"), _prf(key, kind, "k", "s.r")
    return (
        f"aggregate(sequence(1, {ROUNDS}), named_struct('l', {left}, 'r', {right}), (s, k) -> "
        f"if(k % 2 = 0, named_struct('l', (s.l + {even} % {a}) % {a}, 'r', s.r), named_struct('l', s.l, 'r', (s.r + {odd} % {b}) % {b})))"
    )


def _ten(n: str) -> str:
    return f"cast(concat('1', repeat('0', {n})) as bigint)"


def _digits(key: str, kind: str, d: str) -> str:
    """A permutation of digit strings of the length of ``d`` (2 to 30 digits)."""
    a, b = f"cast(floor(length({d}) / 2) as int)", f"cast(length({d}) - floor(length({d}) / 2) as int)"
    left, right = f"cast(substring({d}, 1, {a}) as bigint)", f"cast(substring({d}, {a} + 1) as bigint)"
    both = _feistel(key, kind, left, right, _ten(a), _ten(b))
    return f"element_at(transform(array({both}), f -> concat(lpad(f.l, {a}, '0'), lpad(f.r, {b}, '0'))), 1)"


def _filled(m: str, d: str) -> str:
    """The digits of ``d`` in the places of the digits of ``m``."""
    return (
        f"aggregate(split({m}, ''), named_struct('o', '', 'k', 1), (s, c) -> if(c between '0' and '9', "
        f"named_struct('o', concat(s.o, substring({d}, s.k, 1)), 'k', s.k + 1), named_struct('o', concat(s.o, c), 'k', s.k)), s -> s.o)"
    )


def _only_digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _luhn(d: str, skip: int) -> str:
    """Luhn sum of ``d``; ``skip`` = 1 where the check digit is still to come."""
    digit = f"cast(substring({d}, length({d}) + 1 - i, 1) as int)"
    return f"aggregate(sequence(1, length({d})), 0, (s, i) -> s + if((i + {skip}) % 2 = 0, {digit} * 2 - if({digit} > 4, 9, 0), {digit}))"


def _card(key: str, m: str) -> str:
    """All digits but the last are permuted; the last is the Luhn digit of the rest."""
    body = f"element_at(transform(array({_only_digits(m)}), d -> {_digits(key, 'card', 'substring(d, 1, length(d) - 1)')}), 1)"
    whole = f"element_at(transform(array({body}), d -> concat(d, (10 - {_luhn('d', 1)} % 10) % 10)), 1)"
    return f"if({_luhn(_only_digits(m), 0)} % 10 = 0, {_filled(m, whole)}, {m})"


def _phone(key: str, m: str) -> str:
    """The country code, or the zero of a national number, stays."""
    code = f"regexp_extract({m}, '^([+][0-9]{{1,3}}(?=[ .(-])|0)?', 0)"
    rest = f"substring({m}, length({code}) + 1)"
    return f"concat({code}, {_filled(rest, _digits(key, 'phone', _only_digits(rest)))})"


def _ssn(key: str, m: str) -> str:
    """Area 001-899 but for 666, group 01-99, serial 0001-9999: 898 x (99 x 9999) numbers."""
    d = _only_digits(m)
    area, low = f"cast(substring({d}, 1, 3) as bigint)", f"((cast(substring({d}, 4, 2) as bigint) - 1) * 9999 + cast(substring({d}, 6, 4) as bigint) - 1)"
    both = _feistel(key, "ssn", f"{area} - if({area} > 666, 2, 1)", low, "898L", "989901L")
    made = f"element_at(transform(array({both}), f -> concat(lpad(f.l + if(f.l >= 665, 2, 1), 3, '0'), lpad(f.r div 9999 + 1, 2, '0'), lpad(f.r % 9999 + 1, 4, '0'))), 1)"
    return f"if({m} rlike '^(?!000|666|9)[0-9]{{3}}-(?!00)[0-9]{{2}}-(?!0000)[0-9]{{4}}$', {_filled(m, made)}, {m})"


def _ip(key: str, m: str) -> str:
    part = lambda k: f"cast(split_part({m}, '.', {k}) as bigint)"
    both = _feistel(key, "ip", f"{part(1)} * 256 + {part(2)}", f"{part(3)} * 256 + {part(4)}", "65536L", "65536L")
    return f"element_at(transform(array({both}), f -> concat_ws('.', f.l div 256, f.l % 256, f.r div 256, f.r % 256)), 1)"


def _date(key: str, m: str) -> str:
    """Days of 1900-01-01 to 2099-12-31, in whichever of the formats; what is no day of the calendar stays.

    With slashes the day comes first if that gives a day, else the month.
    """
    year, one, two = (f"substring({m}, {at}, {n})" for at, n in ((7, 4), (1, 2), (4, 2)))
    first, turned = f"if({m} like '%-%', {m}, concat_ws('-', {year}, {two}, {one}))", f"if({m} like '%/%', concat_ws('-', {year}, {one}, {two}), null)"
    real = lambda iso: f"try_to_date({iso}, 'yyyy-MM-dd')"
    day = "datediff(d, date'1900-01-01')"
    both = _feistel(key, "date", f"cast({day} div {DAYS[1]} as bigint)", f"cast({day} % {DAYS[1]} as bigint)", f"{DAYS[0]}L", f"{DAYS[1]}L")
    made = f"element_at(transform(array({both}), f -> date_add(date'1900-01-01', cast(f.l * {DAYS[1]} + f.r as int))), 1)"
    style = f"case when {m} like '%-%' then 'yyyy-MM-dd' when {m} like '%.%' then 'dd.MM.yyyy' when {real(first)} is null then 'MM/dd/yyyy' else 'dd/MM/yyyy' end"
    return f"element_at(transform(array(coalesce({real(first)}, {real(turned)})), d -> if(d is null, {m}, date_format({made}, {style}))), 1)"


def _email(key: str, m: str) -> str:
    """Letters and digits of the local part move within their class; every second place moves by a keyed function of the others."""
    local, domain = f"substring_index({m}, '@', 1)", f"substring({m}, locate('@', {m}))"
    others = "array_join(filter(s, (c, i) -> i % 2 <> k % 2), '')"
    mask = f"sha2(concat({_sql(key + ':email:')}, k, ':', size(s), ':', {others}), 256)"
    move = lambda base, n: f"char({base} + (ascii(c) - {base} + cast(conv(substring(mask, i % 31 * 2 + 1, 2), 16, 10) as int)) % {n})"
    moved = f"case when i % 2 <> k % 2 then c when c between 'a' and 'z' then {move(97, 26)} when c between 'A' and 'Z' then {move(65, 26)} when c between '0' and '9' then {move(48, 10)} else c end"
    turn = f"element_at(transform(array({mask}), mask -> transform(s, (c, i) -> {moved})), 1)"
    return f"concat(array_join(aggregate(sequence(1, {ROUNDS}), split({local}, ''), (s, k) -> {turn}), ''), {domain})"


_MAKERS = {"email": _email, "phone": _phone, "card": _card, "ssn": _ssn, "date": _date, "ip": _ip}


def _kind_of(m: str) -> str:
    whole = lambda p: _sql(f"^(?:{p})$")
    cases = " ".join(f"when {m} rlike {whole(p)} then '{k}'" for k, p in KINDS.items())
    return f"case {cases} end"


def key_of(spark: SparkSession) -> str:
    """The key of the session's setting; where that is unset, a random one that the session keeps and nobody else knows."""
    if not spark.conf.get(KEY_SETTING, None):
        spark.conf.set(KEY_SETTING, secrets.token_hex(32))
    return spark.conf.get(KEY_SETTING)


def pseudonyms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and a last column ``pii_kinds`` (array of the kind of each value that changed).

    Without a ``key`` that of the session counts (``key_of``); set it to get the same pseudonyms in another session. The key stands
    in Spark's plans, so who may read those may invert the pseudonyms.
    Null texts stay null, with no kinds; empty texts stay empty. Repeated rows and null ids are rows like any others. An empty table
    gives an empty result. ``pii_kinds`` replaces a column of that name.
    """
    key = key or key_of(docs.sparkSession)
    cases = " ".join(f"when '{k}' then {make(key, 'm')}" for k, make in _MAKERS.items())
    taken = {c.lower() for c in docs.columns}
    prefix = "_"
    while any(c.startswith(prefix) for c in taken):
        prefix += "_"
    t, m, k, p = (prefix + x for x in "tmkp")
    found = _sql(FOUND)
    work = docs.withColumn(t, F.col(f"`{text_col}`").cast("string"))
    work = work.withColumn(m, F.expr(f"if({t} rlike '[0-9@]' and {t} rlike {found}, regexp_extract_all({t}, {found}, 0), cast(array() as array<string>))"))
    work = work.withColumn(k, F.expr(f"transform({m}, m -> named_struct('m', m, 'kind', {_kind_of('m')}))"))
    work = work.withColumn(p, F.expr(f"transform({k}, x -> named_struct('old', x.m, 'kind', x.kind, 'new', element_at(transform(array(x.m), m -> case x.kind {cases} else m end), 1)))"))
    text = f"if(size({m}) > 0, array_join(zip_with(split({t}, {found}, -1), {p}, (g, p) -> concat(g, coalesce(p.new, ''))), ''), {t})"
    kinds = f"transform(filter({p}, p -> p.new <> p.old), p -> p.kind)"
    columns = [F.expr(text).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != "pii_kinds"]
    return work.select(*columns, F.coalesce(F.expr(kinds), F.expr("cast(array() as array<string>)")).alias("pii_kinds"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None) -> DataFrame:
    """(doc_id, text, n_email, n_phone, n_card, n_ssn, n_date, n_ip): the new text, and how many values of each kind changed."""
    done = pseudonyms(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text", key)
    return done.select("doc_id", "text", *[F.expr(f"cast(size(filter(pii_kinds, k -> k = '{k}')) as long)").alias(f"n_{k}") for k in KINDS])
