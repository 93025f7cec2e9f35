"""Text columns: decoded forms, non-public hosts and the sensitive class of a value."""

from __future__ import annotations

import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import patterns as P

_NO_TEXTS = "array<string>"


@F.pandas_udf(T.StringType())
def _nfkc_if_changed(texts: pd.Series) -> pd.Series:
    """NFKC form of each text that is not in it already, else NULL. Spark has no such function."""

    def normalize(text: str | None) -> str | None:
        if text is None or unicodedata.is_normalized("NFKC", text):
            return None
        return unicodedata.normalize("NFKC", text)

    return texts.map(normalize).astype(object).where(lambda s: s.notna(), None)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfkc_each(texts: pd.Series) -> pd.Series:
    """For each array, the NFKC form of every text that is not in it already, else NULL."""

    def normalize(text: str | None) -> str | None:
        if text is None or unicodedata.is_normalized("NFKC", text):
            return None
        return unicodedata.normalize("NFKC", text)

    return texts.map(lambda values: None if values is None else [normalize(v) for v in values])


@lru_cache(maxsize=1)
def _nfkc_class() -> str:
    """An expression for all characters that a text must hold one of for NFKC to change it.

    They are those that it replaces when alone, those that it can reorder (combining ones), and those that it can join to the character
    before them: the second ones of all pairs that one character stands for, and the vowels and final consonants of Hangul. Java tries
    the ranges of a class one by one, so they are grouped, each group behind a test of its whole span.
    """
    codes = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    for code in range(0x80, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        if unicodedata.combining(c) or not unicodedata.is_normalized("NFKC", c):
            codes.add(code)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            codes.add(int(parts[1], 16))
    ranges: list[list[int]] = []
    for code in sorted(codes):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    groups = [ranges[k : k + 24] for k in range(0, len(ranges), 24)]
    span = lambda a, b: f"\\x{{{a:x}}}-\\x{{{b:x}}}"
    return "|".join(f"(?=[{span(g[0][0], g[-1][1])}])[{''.join(span(a, b) for a, b in g)}]" for g in groups)


def may_change_in_nfkc(text: Column) -> Column:
    """False only for texts that are in NFKC already; plain letters with accents do not count."""
    return text.rlike(r"[^\x00-\x7f]") & text.rlike(_nfkc_class())


def nfkc_each(texts: Column) -> Column:
    """For an array of texts, the NFKC form of each where it differs, else NULL; a NULL array costs nothing."""
    return _nfkc_each(texts)


def nfkc_changed(text: Column) -> Column:
    """NFKC form where it differs from the text, else NULL. Only text that it can change is sent to Python."""
    return _nfkc_if_changed(F.when(may_change_in_nfkc(text), text))


def percent_decoded(text: Column) -> Column:
    """Percent-decoding that keeps ``+`` and malformed escapes, and marks invalid UTF-8."""
    tokens = F.regexp_extract_all(text, F.lit(r"(?:%[0-9A-Fa-f]{2})+|[^%]+|%"), F.lit(0))
    decoded = F.transform(
        tokens,
        lambda t: F.when(
            t.rlike(r"^%[0-9A-Fa-f]{2}"), F.make_valid_utf8(F.unhex(F.replace(t, F.lit("%"), F.lit(""))).cast("string"))
        ).otherwise(t),
    )
    return F.when(text.rlike("%[0-9A-Fa-f]{2}"), F.array_join(decoded, "")).otherwise(text)


#: Characters of a text that is tried as base64, at least and at most.
BASE64_CHARACTERS = (8, 8192)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, so that expressions stay small."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _base64_body(text: Column, characters: tuple[int, int] = BASE64_CHARACTERS) -> Column:
    """The value without outer white space when it is shaped like base64, else NULL."""
    shaped = text.rlike(rf"^[{P.S}]*[A-Za-z0-9+/]+={{0,2}}[{P.S}]*\z")

    def of_fitting_size(compact: Column) -> Column:
        size = F.char_length(compact)
        return F.when(size.between(*characters) & (size % 4 == 0), compact)

    return F.when(shaped, _let(F.regexp_replace(text, rf"[{P.S}]+", ""), of_fitting_size))


def base64_decoded(text: Column, characters: tuple[int, int] = BASE64_CHARACTERS) -> Column:
    """Decoded text of a whole-value base64 string of a length in ``characters``, else NULL."""
    plain = F.try_to_binary(_base64_body(text, characters), F.lit("base64")).cast("string")
    return F.when(F.is_valid_utf8(plain), plain)


def may_have_other_forms(text: Column, nfkc: Column, characters: tuple[int, int] = BASE64_CHARACTERS) -> Column:
    """False only when the raw form is the one form of the text."""
    return nfkc.isNotNull() | (text.contains("%") & text.rlike("%[0-9A-Fa-f]{2}")) | _base64_body(text, characters).isNotNull()


def decoded_forms(text: Column, nfkc: Column, characters: tuple[int, int] = BASE64_CHARACTERS) -> Column:
    """Raw, NFKC, percent-decoded and base64-decoded forms, in that order, without repeats.

    ``nfkc`` is a column already holding :func:`nfkc_changed` of the text.
    """
    percent = percent_decoded(text)
    return F.array_distinct(F.array_compact(F.array(text, nfkc, percent, base64_decoded(text, characters))))


def _ipv4_hex(address: Column) -> Column:
    """Eight hexadecimal digits of a dotted quad."""
    return F.array_join(F.transform(F.split(address, r"\."), lambda octet: F.lpad(F.lower(F.hex(octet.try_cast("int"))), 2, "0")), "")


def _prefixes(networks: Sequence[str]) -> str:
    """Alternatives of the leading hexadecimal digits of networks."""
    found = []
    for network in map(ipaddress.ip_network, networks):
        digits = f"{int(network.network_address):0{network.max_prefixlen // 4}x}"
        whole, rest = divmod(network.prefixlen, 4)
        if rest:
            first = int(digits[whole], 16)
            found += [digits[:whole] + f"{first + i:x}" for i in range(1 << (4 - rest))]
        else:
            found.append(digits[:whole])
    return "|".join(found)


# Leading hexadecimal digits of addresses that are not globally routable; an IPv4 address inside IPv6
# follows the IPv4 list.
_V4_SPECIAL, _V4_GLOBAL = _prefixes(P.IPV4_SPECIAL), _prefixes(P.IPV4_GLOBAL_EXCEPTIONS)
_MAPPED = _prefixes([P.IPV6_MAPPED_IPV4])
_V6_SPECIAL = f"{_prefixes(P.IPV6_SPECIAL)}|{_MAPPED}(?:{_V4_SPECIAL})"
_V6_GLOBAL = f"{_prefixes(P.IPV6_GLOBAL_EXCEPTIONS)}|{_MAPPED}(?:{_V4_GLOBAL})"


def _special(digits: Column, special: str, exceptions: str) -> Column:
    return _let(digits, lambda d: d.rlike(f"^(?:{special})") & ~d.rlike(f"^(?:{exceptions})"))


def _with_dotted_tail_as_groups(address: Column) -> Column:
    """An IPv6 text whose dotted quad at the end, if any, is written as two groups."""

    def rewrite(tail: Column) -> Column:
        head = F.substring(address, F.lit(1), F.char_length(address) - F.char_length(tail))
        groups = F.regexp_replace(_ipv4_hex(tail), "^(.{4})(.{4})", "$1:$2")
        return F.when(tail == "", address).when(tail.rlike(P.IPV4), F.concat(head, groups))

    return _let(F.regexp_extract(address, r":((?:[0-9]+\.){3}[0-9]+)\z", 1), rewrite)


def _ipv6_hex(address: Column) -> Column:
    """Thirty-two hexadecimal digits of an IPv6 text, or NULL when it is not one."""

    def parts(half: Column) -> Column:
        return F.filter(F.split(half, ":", -1), lambda g: F.char_length(half) > 0)

    def fill(halves: Column) -> Column:
        sides = F.struct(
            parts(F.get(halves, F.lit(0))).alias("left"), parts(F.coalesce(F.get(halves, F.lit(1)), F.lit(""))).alias("right"),
            F.size(halves).alias("n"),
        )
        return _let(sides, complete)

    def complete(s: Column) -> Column:
        used = F.size(s["left"]) + F.size(s["right"])
        zeros = F.array_repeat(F.lit("0"), F.greatest(8 - used, F.lit(0)))
        shaped = ((s["n"] == 2) & (used <= 7)) | ((s["n"] == 1) & (used == 8))
        return F.when(shaped, F.concat(s["left"], zeros, s["right"]))

    groups = _let(F.split(_with_dotted_tail_as_groups(address), "::", -1), fill)
    text = _let(groups, lambda g: F.array_join(F.transform(g, lambda x: F.when(x.rlike(r"^[0-9a-f]{1,4}\z"), F.lpad(x, 4, "0")).otherwise("?")), ""))
    return _let(text, lambda t: F.when(t.rlike(r"^[0-9a-f]{32}\z"), t))


def is_nonpublic_host(host: Column) -> Column:
    """A local name or suffix, a metadata name, or an address that is not globally routable."""

    def test(name: Column) -> Column:
        named = name.isin(list(P.HOST_NAMES))
        for suffix in P.HOST_SUFFIXES:
            named = named | name.endswith(suffix)
        address = F.when(name.rlike(P.IPV4), _special(_ipv4_hex(name), _V4_SPECIAL, _V4_GLOBAL)).when(
            name.rlike(P.IPV6_SHAPE), _special(_ipv6_hex(name), _V6_SPECIAL, _V6_GLOBAL)
        )
        return named | F.coalesce(address, F.lit(False))

    return _let(F.rtrim(F.lower(host), F.lit(".")), test)


def _url_host(text: Column) -> Column:
    """Host of a value that is one URL, else NULL."""
    netloc = F.regexp_extract(F.regexp_replace(text, r"[\t\r\n]", ""), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    host = F.regexp_extract(F.substring_index(netloc, "@", -1), r"^(?:\[([^\]]*)|([^:\[]*))", 0)
    return F.when(text.contains("://"), F.nullif(F.lower(F.btrim(host, F.lit("[]"))), F.lit("")))


def may_hold_flagged_host(text: Column) -> Column:
    """False only when no token of the text can be a non-public host."""
    return _any([*[text.contains(literal) for literal in P.HOST_LITERALS], (text.contains(".") | text.contains(":")) & text.rlike(P.HOST_HINT)])


def host_tokens(text: Column) -> Column:
    """Distinct host-like tokens of a text, in lower case and without final dots, plus the host of a value that is one URL.

    Empty without a pass over the tokens when the text cannot hold a flagged host.
    """
    stripped = F.btrim(text, F.lit(P.HOST_STRIP))
    tokens = F.transform(F.regexp_extract_all(stripped, F.lit(P.HOST_TOKEN), F.lit(0)), lambda t: F.btrim(t, F.lit("[]")))
    plain = F.transform(F.array_compact(F.array_append(tokens, _url_host(stripped))), lambda t: F.rtrim(F.lower(t), F.lit(".")))
    all_hosts = F.array_distinct(F.array_remove(plain, ""))
    return F.when(may_hold_flagged_host(text), all_hosts).otherwise(F.array().cast(_NO_TEXTS))


def folded_case(text: Column) -> Column:
    """The text in one letter case: two texts that an expression takes for equal regardless of case are equal in it."""
    return F.lower(F.upper(text))


def guarded(text: Column, needs: Sequence[str], expression: str, caseless: Sequence[str] = (), folded: Column | None = None) -> Column:
    """``rlike``, tried only on text that holds one of the literals, and whose folded form holds one of the words of ``caseless``."""
    test = text.rlike(expression)
    if caseless:
        low = folded_case(text) if folded is None else folded
        test = _any(low.contains(word) for word in caseless) & test
    return _any(text.contains(literal) for literal in needs) & test if needs else test


def _any(tests: Iterable[Column]) -> Column:
    hit = None
    for test in tests:
        hit = test if hit is None else hit | test
    return F.lit(False) if hit is None else hit


def sensitive_class_of_form(text: Column, private_names: Sequence[str] = ()) -> Column:
    """First sensitive class of one form of a value, else NULL.

    ``private_names`` are names of private repositories that may not appear.
    """
    return _let(folded_case(text), lambda folded: _class_of(text, folded, private_names))


def _class_of(text: Column, folded: Column, private_names: Sequence[str]) -> Column:
    def tried(test: Sequence) -> Column:
        return guarded(text, *test, folded=folded)

    named = [text.rlike(P.I + re.escape(name)) for name in private_names]
    starts = [text.startswith(start) for start in P.PATH_STARTS]
    digits = text.rlike(P.NINE_DIGITS)
    personal = tried(P.EMAIL) | (digits & text.rlike(P.PHONE)) | tried(P.STRUCTURED_ID)
    control, token, locator, host, account, person, detail = P.SENSITIVE_CLASSES
    return (
        F.when(text.rlike(P.ORDINARY) & text.rlike(P.CONTROL_OR_BIDI), control)
        .when(_any(map(tried, P.SECRETS)), token)
        .when(_any([*starts, *named, *map(tried, (*P.LOCATORS, *P.PATHS))]), locator)
        .when(may_hold_flagged_host(text) & F.exists(host_tokens(text), is_nonpublic_host), host)
        .when(digits & text.rlike(P.ACCOUNT), account)
        .when(personal, person)
        .when(tried(((), P.VULNERABILITY, P.VULNERABILITY_WORDS)), detail)
    )


def is_exempt(text: Column) -> Column:
    """A value that is exactly a digest or a UTC time."""
    return _any(text.rlike(expression) for expression in P.EXEMPT)


#: What a value may begin, end or consist of where a pattern is bound to the value's ends and so may miss it among other lines.
_BOUND = ("..", ":\\", "://", *("\n" + start for start in P.PATH_STARTS))


def may_hold_sensitive_line(joined: Column) -> Column:
    """False only if no value has a sensitive class, for values each on its line of ``joined``, which begins with a line end.

    Nearly all patterns find in the whole text what they find in a line of it; those that are bound to a value's ends are
    replaced by a literal that every value they match holds. The whole is then tried once, instead of every value.
    """

    def test(text: Column) -> Column:
        bound = _any(text.contains(literal) for literal in _BOUND)
        return bound | _let(folded_case(text), lambda folded: folded.contains(".git") | _class_of(text, folded, ()).isNotNull())

    return _let(joined, test)


def decodings(text: Column) -> Column:
    """The percent-decoded and base64-decoded forms of a text that differ from it, as an array; its NFKC form is the caller's."""
    none = F.lit(None).cast("string")
    return F.when(may_have_other_forms(text, none), F.slice(decoded_forms(text, none), 2, 2)).otherwise(F.array().cast(_NO_TEXTS))
