"""Text standardisation as column expressions."""

from __future__ import annotations

import string
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------------------------------------------------
# White space as Unicode text handling sees it, the four ASCII separators included.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The 32 ASCII punctuation signs.
PUNCTUATION = string.punctuation
TOKEN_SEPARATOR = "##"

# Named patterns (Java dialect, Unicode digits and blanks).
POSTAL_CODE = r"(?U)\d{3,}"
DIGITS = r"(?U)\d+"
CAPITAL_RUN = r"(?U)[A-ZÀ-ú]{2,}(\s[A-ZÀ-ú]{2,})*"
ACRONYM = r"\([A-Z]+['\"]?\)"
PARTICLE_D = r"(?U)\sd[aeu]?s?\s"
PARTICLE_A = r"(?U)\sau?x?\s"
PARTICLE_L = r"(?U)\sl[ae]?[sz]?\s"
PARTICLE_L_START = r"(?U)l[ae]?[sz]?\s"

# French stop words.
STOP_WORDS = (
    "au aux avec ce ces dans de des du elle en et eux il ils je la le les leur lui ma mais me même mes moi mon ne nos "
    "notre nous on ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous c d j l à m "
    "n s t y été étée étées étés étant étante étants étantes suis es est sommes êtes sont serai seras sera serons "
    "serez seront serais serait serions seriez seraient étais était étions étiez étaient fus fut fûmes fûtes furent "
    "sois soit soyons soyez soient fusse fusses fût fussions fussiez fussent ayant ayante ayantes ayants eu eue eues "
    "eus ai as avons avez ont aurai auras aura aurons aurez auront aurais aurait aurions auriez auraient avais avait "
    "avions aviez avaient eut eûmes eûtes eurent aie aies ait ayons ayez aient eusse eusses eût eussions eussiez "
    "eussent"
).split()

# Signs whose ASCII form is not their base letter.
ASCII_FORMS = {
    "¡": "!", "¢": "C/", "£": "PS", "¥": "Y=", "¦": "|", "§": "SS", "¨": '"', "©": "(c)", "«": "<<", "¬": "!", "\xad": "",
    "®": "(r)", "¯": "-", "°": "deg", "±": "+-", "´": "'", "¶": "P", "·": "*", "¸": ",", "»": ">>", "¼": "1/4",
    "½": "1/2", "¾": "3/4", "¿": "?", "×": "x", "÷": "/", "Æ": "AE", "æ": "ae", "Ð": "D", "ð": "d", "Ø": "O", "ø": "o",
    "Þ": "Th", "þ": "th", "ß": "ss", "Đ": "D", "đ": "d", "ı": "i", "Ł": "L", "ł": "l", "Œ": "OE", "œ": "oe",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "--", "―": "--", "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"',
    "”": '"', "„": ",,", "•": "*", "…": "...", "‰": "%0", "′": "'", "″": '"', "‹": "<", "›": ">", "€": "EUR", "™": "tm",
}
# ----------------------------------------------------------------------------------------------------------------------

@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """One-to-one signs (then deletions) for ``translate``, and the signs that grow to several."""
    source, target, deleted, longer = [], [], [], []
    for sign, ascii_form in ASCII_FORMS.items():
        if len(ascii_form) == 1:
            source.append(sign)
            target.append(ascii_form)
        elif ascii_form:
            longer.append((sign, ascii_form))
        else:
            deleted.append(sign)
    for code in range(0x80, 0x2100):
        sign = chr(code)
        if sign in ASCII_FORMS:
            continue
        if unicodedata.combining(sign):
            deleted.append(sign)
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", sign) if not unicodedata.combining(c))
        if base.isascii() and len(base) == 1:
            source.append(sign)
            target.append(base)
        elif base.isascii() and len(base) > 1 and base.isalnum():
            longer.append((sign, base))
    return "".join(source + deleted), "".join(target), tuple(longer)


def null_to_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Cut white space of any kind from both ends."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def strip_quotes(c: Column) -> Column:
    return F.btrim(c, F.lit('"'))


def clean_field(c: Column) -> Column:
    """White space first, then quotes; what stands inside the quotes is kept."""
    return strip_quotes(strip(c))


def clean_fields(fields: Column) -> Column:
    return F.transform(fields, clean_field)


def lower_strip(c: Column) -> Column:
    return strip(F.lower(c))


def punctuation_to_space(c: Column) -> Column:
    return F.translate(c, PUNCTUATION, " " * len(PUNCTUATION))


def once(c: Column, then: Callable[[Column], Column]) -> Column:
    """``then(c)`` with ``c`` worked out once, however often ``then`` uses it.

    Keeps nested expressions small where the optimizer would write out each use.
    """
    return F.get(F.transform(F.array(c), then), F.lit(0))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.length(c)


def _grow(c: Column) -> Column:
    """Signs that become several, looked for only in text that is not ASCII yet."""
    longer = _fold_tables()[2]
    pairs = F.expr("array(" + ", ".join(f"struct('{sign}' AS a, '{form}' AS b)" for sign, form in longer) + ")")
    grown = F.aggregate(pairs, c, lambda text, pair: F.replace(text, pair["a"], pair["b"]))
    return F.when(is_ascii(c), c).otherwise(grown)


def fold_to_ascii(c: Column) -> Column:
    """Accented Latin letters and common typographic signs to ASCII; other scripts stay."""
    source, target, _ = _fold_tables()
    return once(F.translate(c, source, target), _grow)


def blanks(c: Column) -> Column:
    """White space of any kind as blanks."""
    return F.translate(c, WHITE_SPACE, " " * len(WHITE_SPACE))


def tokens(c: Column) -> Column:
    """White-space tokens, none of them empty."""
    return F.filter(F.split(blanks(c), " "), lambda t: t != "")


def collapse(c: Column) -> Column:
    return F.array_join(tokens(c), " ")


def _without_stop_words(words: Column) -> Column:
    stop_words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    keep = F.expr(f"t -> t <> '' AND t NOT IN ({stop_words})")
    return F.array_join(F.call_function("filter", words, keep), " ")


def remove_stop_words(c: Column) -> Column:
    return _without_stop_words(F.split(blanks(c), " "))


def standardise(c: Column) -> Column:
    """Lower case, punctuation to blanks, ASCII letters, no stop words, single blanks; missing text is ''.

    One pass over the characters turns punctuation and white space to blanks and folds letters: no sign is both.
    """
    source, target, _ = _fold_tables()
    apart = PUNCTUATION + WHITE_SPACE
    simple = F.translate(F.lower(null_to_empty(c)), apart + source, " " * len(apart) + target)
    return _without_stop_words(F.split(once(simple, _grow), " "))


def drop_single_letters(c: Column) -> Column:
    return F.array_join(F.filter(tokens(c), lambda t: F.length(t) > 1), " ")


def remove_pattern(c: Column, pattern: str) -> Column:
    """Every match in turn, replaced by a blank wherever its text occurs.

    A match that contains an earlier one can thus leave a remainder: '7 75007' leaves '500'.
    """
    matches = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    return F.aggregate(matches, c, lambda text, match: F.replace(text, match, F.lit(" ")))


def remove_leading_pattern(c: Column, pattern: str) -> Column:
    """If ``pattern`` matches at the start, its text is replaced by a blank wherever it occurs."""
    head = F.regexp_extract(c, f"^(?:{pattern})", 0)
    return F.when(head != "", F.replace(c, head, F.lit(" "))).otherwise(c)


def remove_digits(c: Column, whole_runs: bool = False) -> Column:
    return F.regexp_replace(c, DIGITS, " ") if whole_runs else remove_pattern(c, DIGITS)


def join_tokens(c: Column) -> Column:
    return F.array_join(c, TOKEN_SEPARATOR)


def split_tokens(c: Column) -> Column:
    """Back from the joined form; '' gives one empty token, as joining no tokens did."""
    return F.split(c, TOKEN_SEPARATOR)
