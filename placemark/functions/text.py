"""Name and title folding as column expressions.

The folds differ on purpose (how đ is written, what is decomposed first, which
script is transliterated) and are kept apart. Code points of the tables are
folded by translate() and replace(); the tables are worked out once from the
Unicode database. Code points beyond them that are neither a-z nor digits act
as separators, which is what every fold does with letters it does not know.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters without a decomposition, and Serbian Cyrillic.
LATIN_SPECIAL = {"đ": "d", "Đ": "d", "ð": "d", "Ð": "d", "ø": "o", "Ø": "o", "ł": "l", "Ł": "l", "ß": "ss", "ẞ": "ss", "æ": "ae", "Æ": "ae", "œ": "oe", "Œ": "oe"}
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "ђ": "dj", "е": "e", "ж": "z", "з": "z", "и": "i",
    "ј": "j", "к": "k", "л": "l", "љ": "lj", "м": "m", "н": "n", "њ": "nj", "о": "o", "п": "p", "р": "r",
    "с": "s", "т": "t", "ћ": "c", "у": "u", "ф": "f", "х": "h", "ц": "c", "ч": "c", "џ": "dz", "ш": "s",
}
LATIN_PROFILE = {"đ": "dj", "ø": "o", "ł": "l", "ß": "ss", "æ": "ae", "œ": "oe"}
# Words that carry no identity in names and titles.
NAME_STOPWORDS = ("the", "club", "klub", "bar")
CITY_WORDS = ("beograd", "belgrade")
TITLE_STOPWORDS = (
    "live", "uzivo", "koncert", "concert", "tour", "turneja", "in", "beograd", "belgrade", "novi", "sad", "nis", "srbija",
    "serbia", "the", "and", "i", "vs", "feat", "with", "sa", "gostima", "open", "air", "party", "show",
)

_FOLDED = [*range(0x80, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0x2100, 0x2190), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]


def _marks_off(s: str) -> str:
    return "".join(c for c in s if not 0x300 <= ord(c) <= 0x36F)


def _table(fold) -> tuple[str, str, list[tuple[str, str]]]:
    """Characters to translate, what to, and the replacements that do not keep the length."""
    one, to, many = [], [], []
    for cp in _FOLDED:
        c = chr(cp)
        t = fold(c)
        if t == c:
            continue
        if len(t) == 1:
            one.append(c)
            to.append(t)
        else:
            many.append((c, t))
    return "".join(one), "".join(to), many


def once(value: Column, then) -> Column:
    """then(value), the value worked out once however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _apply(col: Column, table: tuple[str, str, list[tuple[str, str]]]) -> Column:
    """The table's fold of a text, combining marks left out; plain ASCII is passed by."""
    one, to, many = table
    # Grouped by what they become; most texts hold none of them.
    by: dict[str, list[str]] = {}
    for c, t in many:
        by.setdefault(t, []).append(c)

    def replaced(s: Column) -> Column:
        for t, chars in by.items():
            s = F.regexp_replace(s, "[" + "".join(chars) + "]", t)
        return s

    def folded(s: Column) -> Column:
        short = F.translate(F.regexp_replace(s, MARKS, ""), one, to)
        return once(short, lambda x: F.when(x.rlike("[" + "".join(c for c, _ in many) + "]"), replaced(x)).otherwise(x))

    return once(col, lambda s: F.when(s.rlike("[^\\x00-\\x7F]"), folded(s)).otherwise(s))


def _special_first(c: str) -> str:
    s = unicodedata.normalize("NFKD", LATIN_SPECIAL.get(c, c))
    s = _marks_off(s).lower()
    return "".join(CYRILLIC.get(x, "") if 0x400 <= ord(x) <= 0x4FF else x for x in s)


def _ascii_only(fold):
    """Letters that a fold leaves outside a-z0-9 separate words, as everything else does."""
    return lambda c: "".join(x if x.isascii() else " " for x in fold(c))


_NAME = _table(_ascii_only(_special_first))
_LATIN = _table(_ascii_only(lambda c: _marks_off(unicodedata.normalize("NFKD", "".join(LATIN_PROFILE.get(x, x) for x in c.lower())))))
_CITY = _table(_ascii_only(lambda c: _marks_off(unicodedata.normalize("NFD", c.lower().replace("đ", "dj")))))
_TOKEN = _table(_ascii_only(lambda c: _marks_off(unicodedata.normalize("NFD", c.lower()).replace("đ", "dj"))))
MARKS = "[\\u0300-\\u036f]"


def _spaced(col: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(col), "[^a-z0-9]+", " "))


def latin_name(col: Column) -> Column:
    """The script-neutral profile: may be empty."""
    return _spaced(_apply(F.coalesce(col, F.lit("")), _LATIN))


def city_key(col: Column) -> Column:
    return _spaced(_apply(col, _CITY))


def tokens(col: Column) -> Column:
    """Lower-case, unaccented word list."""
    return F.filter(F.split(_spaced(_apply(F.coalesce(col, F.lit("")), _TOKEN)), " "), lambda t: t != "")


def strict_name(col: Column) -> Column:
    """The Serbian profile without its fallback: transliterated, city words off the ends, generic words out unless nothing is left."""
    s = _spaced(_apply(F.coalesce(col, F.lit("")), _NAME))
    city = "|".join(CITY_WORDS)
    s = F.regexp_replace(s, f"^(?:(?:{city}) )+(?=.)", "")
    s = F.regexp_replace(s, f"(?<=.)(?: (?:{city}))+$", "")

    def without(every: Column) -> Column:
        kept = F.filter(every, lambda t: ~t.isin(*NAME_STOPWORDS))
        return F.array_join(F.when(F.size(kept) > 0, kept).otherwise(every), " ")

    return once(F.split(s, " "), without)


def name_key(col: Column) -> Column:
    """The stored name key: the strict fold, or the lower-cased name with single spaces."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(col, F.lit(""))), "(?U)\\s+", " "))
    return once(strict_name(col), lambda strict: F.when(strict != "", strict).otherwise(plain))


def profile_name(profile: Column, col: Column) -> Column:
    return F.when(profile == "sr", name_key(col)).otherwise(latin_name(col))


def address_key(col: Column) -> Column:
    return name_key(F.regexp_replace(col, "\\d+", " "))


def title_tokens(col: Column) -> Column:
    return F.array_distinct(F.filter(tokens(col), lambda t: (F.length(t) > 1) & ~t.isin(*TITLE_STOPWORDS)))


def jaccard(a: Column, b: Column) -> Column:
    """Of two distinct lists; 0 where either is empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / (F.size(a) + F.size(b) - shared))


def shares_token(a: Column, b: Column) -> Column:
    long = lambda c: F.filter(tokens(c), lambda t: F.length(t) > 1)
    return F.arrays_overlap(long(a), long(b))


def first_listed(words: tuple[str, ...], of: Column) -> Column:
    """The first of the listed words, in the list's order, that is among the tokens; else null."""
    return F.try_element_at(F.filter(F.array(*map(F.lit, words)), lambda w: F.array_contains(of, w)), F.lit(1))


def collapsed(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, "(?U)\\s+", " "))
