"""Text expressions: normalisation, tokens, n-grams, phrases, masking. All JVM-side."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish stop words. Negations and intensity words (no, sin, nada, muy, poca) are kept on purpose.
STOP_WORDS = """
a al algo algunas algunos ante antes aqui asi aun cada como con contra cual
cuando de del desde donde dos e el ella ellas ellos en entre era eran es esa
esas ese eso esos esta estaba estan estas este esto estos fue fueron ha han
hasta hay he la las le les lo los me mi mis nos nuestra nuestro o os para pero
por porque que se ser si sobre su sus te tambien tengo tiene tienen todo todos
tu tus un una unas uno unos y ya yo
""".split()

# Personal data patterns and what replaces them, in the order they apply.
EMAIL = (r"[\w.+-]+@[\w-]+\.[\w.-]+", "[correo omitido]")
TAX_ID = (r"\b[A-ZÑ&]{3,4}\d{6}[A-Z0-9]{2,8}\b", "[identificador omitido]")
LONG_NUMBER = (r"(?:\d[\s-]?){8,}", "[número omitido] ")

# Verbs of water coming out, at most three words before "agua".
LEAKING_VERBS = "sale|salen|brota|brotan|tira|tiran|escurre"


# The characters that count as white space at the ends of a text.
WHITE = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip_white(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(WHITE))


def _accent_table() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base character plus marks, except ñ."""
    source, target = [], []
    for code in range(0xC0, 0x10000):
        ch = chr(code)
        if 0xD800 <= code <= 0xDFFF or ch == "ñ":
            continue
        parts = unicodedata.normalize("NFD", ch)
        if len(parts) > 1:
            base = [c for c in parts if unicodedata.category(c) != "Mn"]
            if len(base) == 1:
                source.append(ch)
                target.append(base[0])
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(text: Column) -> Column:
    """Remove accents, keep ñ (a letter of its own)."""
    return F.regexp_replace(F.translate(text, _ACCENTED, _PLAIN), r"\p{Mn}+", "")


#: Characters a normal form keeps, and the table that takes accents off and turns all other ASCII into spaces.
KEPT = frozenset("abcdefghijklmnopqrstuvwxyz0123456789ñ ")
_OTHER = "".join(c for c in map(chr, range(1, 128)) if c not in KEPT)
_FOLDED = "".join(c if c in KEPT else " " for c in _PLAIN) + " " * len(_OTHER)


def normalize_text(text: Column) -> Column:
    """Lower case, no accents, only a-z 0-9 ñ, single spaces; null, blank and 'nan' become ''.

    One table of characters does most of it; the patterns that follow look for ranges only, as a class of
    several ranges takes Java several times as long per character.
    """
    low = F.lower(text.cast("string"))
    plain = F.regexp_replace(F.translate(low, _ACCENTED + _OTHER, _FOLDED), r"\p{Mn}+", "")
    words = F.trim(F.regexp_replace(F.regexp_replace(plain, r"[^\x01-\x7Fñ]+", " "), " {2,}", " "))
    return F.when(F.coalesce(strip_white(low), F.lit("")).isin("", "nan"), F.lit("")).otherwise(words)


def tokenize(text: Column, stop_words=tuple(STOP_WORDS)) -> Column:
    """Words longer than one letter that are not stop words."""
    words = F.split(normalize_text(text), " ")
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(*stop_words))


def bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ngrams(tokens: Column, n: int = 2) -> Column:
    """All word n-grams of sizes 1..n, joined by a space."""

    def of_size(t: Column, size: int) -> Column:
        starts = F.when(F.size(t) >= size, F.sequence(F.lit(1), F.size(t) - (size - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i, size), " "))

    return bind(tokens, lambda t: F.concat(t, *[of_size(t, size) for size in range(2, n + 1)]))


def contains_phrase(normalized: Column, phrase: str) -> Column:
    return F.instr(F.concat(F.lit(" "), normalized, F.lit(" ")), f" {phrase} ") > 0


def first_phrase(normalized: Column, phrases) -> Column:
    """First phrase of the list the text contains, or null."""
    hits = [F.when(contains_phrase(normalized, p), F.lit(p)) for p in phrases]
    return F.coalesce(*hits)


def leaking_water(normalized: Column) -> Column:
    """'sale mucha agua' and the like: the matched words, or null."""
    found = F.trim(F.regexp_extract(normalized, f"(?:^| )((?:{LEAKING_VERBS})(?: [a-z0-9ñ]+){{0,3}} agua)(?= |$)", 1))
    return F.nullif(found, F.lit(""))


def mask_pii(text: Column) -> Column:
    """Mask e-mail addresses, then tax ids, then runs of 8 or more digits; trimmed."""
    out = text
    for (pattern, mask), flags in ((EMAIL, "(?U)"), (TAX_ID, "(?iU)"), (LONG_NUMBER, "(?U)")):
        out = F.regexp_replace(out, flags + pattern, mask)
    return F.regexp_replace(out, r"(?U)^\s+|\s+$", "")


def squeeze_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def truncate_ellipsis(text: Column, limit: int = 200) -> Column:
    return F.when(F.length(text) <= limit, text).otherwise(
        F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…")))


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 name-based id (SHA-1) of a string column."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4),
                       F.concat(F.lit("5"), F.substring(digest, 14, 3)),
                       F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))
