"""Column functions that normalise business records."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions import fixed as X

_INDIC_RUN = re.compile(f"[{chr(X.INDIC_FIRST)}-{chr(X.INDIC_LAST)}]+")


def romanise(run: str) -> str:
    """Latin form of one run of Indic letters. A consonant holds an inherent `a`
    that is written once something other than a matra or halant follows; at the
    end of the run it is silent. Unknown code points vanish without effect."""
    out: list[str] = []
    inherent = False
    for c in run:
        c = chr(X.INDIC_FIRST + (ord(c) - X.INDIC_FIRST) % X.INDIC_BLOCK)
        silent = c == X.HALANT or c in X.MATRAS
        sound = X.CONSONANTS.get(c) or X.VOWELS.get(c) or X.SIGNS.get(c) or X.MATRAS.get(c)
        if not sound and not silent:
            continue
        if inherent and not silent:
            out.append("a")
        if sound:
            out.append(sound)
        inherent = c in X.CONSONANTS
    return "".join(out)


def transliterate(text: str) -> str:
    return _INDIC_RUN.sub(lambda m: romanise(m[0]), text)


def unaccented(text: str) -> str:
    for k, v in X.LATIN_SPECIALS.items():
        text = text.replace(k, v)
    text = unicodedata.normalize("NFKD", text)
    for c in set(text):
        if not c.isascii() and unicodedata.category(c) == "Mn":
            text = text.replace(c, "")
    return text


def base_form(text: str | None) -> str:
    """NFKC, romanised, without accents; case is kept; null is empty."""
    if not text:
        return ""
    return text if text.isascii() else unaccented(transliterate(unicodedata.normalize("NFKC", text)))


@F.arrow_udf(T.StringType())
def base_normal(texts: pa.Array) -> pa.Array:
    return pa.array([base_form(t) for t in texts.to_pylist()], pa.string())


def filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def latin_specials(c: Column) -> Column:
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), X.LATIN_SPECIALS.items(), c)


def without_punctuation(c: Column) -> Column:
    """Punctuation to spaces, runs of spaces to one, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, X.PUNCTUATION, " "), X.SPACES + "+", " "))


def lower_and(c: Column) -> Column:
    return F.replace(F.lower(c), F.lit("&"), F.lit(" and "))


def clean_text(base: Column) -> Column:
    return without_punctuation(lower_and(base))


def without_domains(c: Column) -> Column:
    return F.regexp_replace(c, X.DOMAIN, "$1")


def clean_name(base: Column) -> Column:
    return without_punctuation(without_domains(lower_and(base)))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda t: t != "")


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _mapped(values: dict[str, str], key: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.element_at(pairs, key), key)


def core_tokens(clean: Column) -> Column:
    """Tokens without legal words; all of them where nothing else is left."""
    every = tokens(clean)
    core = F.filter(every, lambda t: ~F.array_contains(_strings(X.LEGAL_WORDS), t))
    return F.when(F.size(core) > 0, core).otherwise(every)


def clean_country(base: Column) -> Column:
    return _mapped(X.COUNTRY_ALIASES, clean_text(base))


def states_expanded(base: Column, country: Column) -> Column:
    """Comma segments joined by spaces; in `us` a segment that is exactly a
    state's upper-case code becomes its name."""
    trimmed = F.transform(F.split(base, ","), lambda s: F.regexp_replace(s, f"^{X.SPACES}+|{X.SPACES}+$", ""))
    named = F.transform(trimmed, lambda s: _mapped(X.US_STATES, s))
    return F.array_join(F.when(country == "us", named).otherwise(trimmed), " ")


def without_ordinals(c: Column) -> Column:
    return F.regexp_replace(c, X.ORDINAL, "$1")


def expanded(parts: Column) -> Column:
    return F.transform(parts, lambda t: _mapped(X.ABBREVIATIONS, t))


def without_noise(parts: Column) -> Column:
    return F.filter(parts, lambda t: ~F.array_contains(_strings(X.ADDRESS_NOISE), t))


def clean_address(base: Column, country: Column) -> Column:
    text = without_punctuation(without_ordinals(lower_and(states_expanded(base, country))))
    return F.array_join(without_noise(expanded(tokens(text))), " ")


def id_list(c: Column, strip: bool = False) -> Column:
    """A comma list as an array without empty entries."""
    parts = F.split(F.coalesce(c, F.lit("")), ",")
    if strip:
        parts = F.transform(parts, lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")
