"""Names and labels: slugs, titles, counts, transliteration."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoweave.functions.geom import as_col, once


def slug_of(text: str) -> str:
    return re.sub("[^a-zA-Z0-9]+", "_", text).lower().strip("_")


def slugify(c: Column | str) -> Column:
    return F.btrim(F.lower(F.regexp_replace(as_col(c), "[^a-zA-Z0-9]+", "_")), F.lit("_"))


# Words kept in lower case inside a title.
TITLE_LOWER_WORDS = ("a", "an", "and", "at", "by", "for", "in", "of", "on", "or", "the", "to")


def title_case(c: Column | str) -> Column:
    """``points_of_interest`` to ``Points of Interest``."""
    spaced = F.trim(F.regexp_replace(as_col(c), r"[_\s]+", " "))
    words = F.transform(
        F.split(spaced, " "),
        lambda w, i: F.when(
            (i > 0) & F.lower(w).isin(*TITLE_LOWER_WORDS), F.lower(w)
        ).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))),
    )
    return F.array_join(words, " ")


def title(
    template: Column | str | None, label: Column, place: Column, iso3: Column
) -> Column:
    """``{country}``, ``{category}`` and ``{iso3}`` filled into the template; without
    one, ``<label> of <place>``."""
    code = F.upper(iso3)
    place = F.coalesce(F.nullif(place, F.lit("")), code)
    plain = F.concat(label, F.lit(" of "), place)
    if template is None:
        return plain
    t = F.nullif(as_col(template) if isinstance(template, str) else template, F.lit(""))
    filled = F.replace(t, F.lit("{country}"), place)
    filled = F.replace(filled, F.lit("{category}"), label)
    filled = F.replace(filled, F.lit("{iso3}"), code)
    return F.coalesce(filled, plain)


def combined_title(template: Column | None, place: Column, iso3: Column, source: Column) -> Column:
    plain = F.concat(place, F.lit(" "), source, F.lit(" vector data"))
    if template is None:
        return plain
    filled = F.replace(
        F.replace(F.nullif(template, F.lit("")), F.lit("{country}"), place), F.lit("{iso3}"), F.upper(iso3)
    )
    return F.coalesce(filled, plain)


# How sources are called in titles, legends and labels.
SOURCE_NAMES = {"osm": "OpenStreetMap", "overture": "Overture"}
SOURCE_LABELS = {"osm": "OSM", "overture": "Overture"}


def _named(source: Column, names: dict[str, str]) -> Column:
    out = F.initcap(source)
    for key, value in names.items():
        out = F.when(source == key, F.lit(value)).otherwise(out)
    return out


def source_name(source: Column) -> Column:
    return _named(source, SOURCE_NAMES)


def source_label(source: Column) -> Column:
    return _named(source, SOURCE_LABELS)


def country_name(df: DataFrame, names: DataFrame, dataset_name: str = "dataset_name") -> DataFrame:
    """Adds ``country``: the configured name, else the common name, else the name,
    else the code. ``names`` holds (iso3, common_name, name), one row per code."""
    known = names.select(
        F.upper("iso3").alias("_iso3"), F.col("common_name").alias("_common"), F.col("name").alias("_name")
    )
    joined = df.join(known, F.upper(F.col("iso3")) == F.col("_iso3"), "left")
    given = F.nullif(F.col(dataset_name), F.lit("")) if dataset_name in df.columns else F.lit(None)
    return joined.withColumn(
        "country", F.coalesce(given, F.nullif("_common", F.lit("")), "_name", F.upper("iso3"))
    ).drop("_iso3", "_common", "_name")


def format_count(n: Column | str) -> Column:
    """1234 to ``1,234``."""
    return F.format_number(as_col(n), 0)


def short_count(n: Column | str) -> Column:
    """Legend counts: ``12k`` from a thousand up."""
    c = as_col(n)
    return F.when(c >= 1000, F.concat(F.bround(c / 1000.0, 0).cast("bigint").cast("string"), F.lit("k"))).otherwise(
        c.cast("string")
    )


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; 0 of nothing is 0."""
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, 2)).otherwise(F.lit(0.0))


# Latin letters that do not decompose into a base letter.
LATIN_EXTRA = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Ø": "O", "ø": "o", "Þ": "Th", "þ": "th", "Ð": "D", "ð": "d",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ł": "L", "ł": "l", "Œ": "OE", "œ": "oe",
    "ŋ": "ng", "Ŋ": "NG", "ə": "@",
}

# Cyrillic, lower case; capitals follow by rule.
CYRILLIC = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i",
    "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s",
    "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch",
    "ъ": '"', "ы": "y", "ь": "'", "э": "e", "ю": "iu", "я": "ia", "ё": "io", "ђ": "dj", "ѓ": "gj",
    "є": "ie", "ѕ": "dz", "і": "i", "ї": "yi", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "tsh",
    "ќ": "kj", "ў": "u", "џ": "dzh", "ґ": "g",
}

# Greek, lower case; capitals and accents follow by rule.
GREEK = {
    "α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i",
    "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "ς": "s",
    "σ": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o",
}

# Devanagari, one code point at a time.
DEVANAGARI = {
    "ँ": "N", "ं": "N", "ः": "H", "अ": "a", "आ": "aa", "इ": "i", "ई": "ii", "उ": "u", "ऊ": "uu",
    "ऋ": "R", "ऌ": "L", "ऍ": "eN", "ऎ": "e", "ए": "e", "ऐ": "ai", "ऑ": "oN", "ऒ": "o", "ओ": "o",
    "औ": "au", "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "ng", "च": "c", "छ": "ch", "ज": "j",
    "झ": "jh", "ञ": "ny", "ट": "tt", "ठ": "tth", "ड": "dd", "ढ": "ddh", "ण": "nn", "त": "t",
    "थ": "th", "द": "d", "ध": "dh", "न": "n", "ऩ": "nnn", "प": "p", "फ": "ph", "ब": "b", "भ": "bh",
    "म": "m", "य": "y", "र": "r", "ऱ": "rr", "ल": "l", "ळ": "l", "ऴ": "lll", "व": "v", "श": "sh",
    "ष": "ss", "स": "s", "ह": "h", "़": "'", "ऽ": "'", "ा": "aa", "ि": "i", "ी": "ii", "ु": "u",
    "ू": "uu", "ृ": "R", "ॄ": "RR", "ॅ": "eN", "ॆ": "e", "े": "e", "ै": "ai", "ॉ": "oN", "ॊ": "o",
    "ो": "o", "ौ": "au", "्": "", "ॐ": "AUM", "०": "0", "१": "1", "२": "2", "३": "3", "४": "4",
    "५": "5", "६": "6", "७": "7", "८": "8", "९": "9",
}


def latin_map() -> dict[str, str]:
    """The character map: the tables above, capitals of the cased scripts, and every
    accented Latin or Greek letter reduced to its base letter by decomposition."""
    out = dict(LATIN_EXTRA)
    for table in (CYRILLIC, GREEK):
        for char, latin in table.items():
            out.setdefault(char, latin)
            if char.upper() != char and len(char.upper()) == 1:
                out.setdefault(char.upper(), latin.capitalize())
    out.update(DEVANAGARI)
    for first, last in ((0xC0, 0x24F), (0x370, 0x3FF), (0x1E00, 0x1FFF)):
        for code in range(first, last + 1):
            char = chr(code)
            base = unicodedata.normalize("NFD", char)[0]
            if char not in out and base != char:
                latin = base if base.isascii() and base.isalpha() else out.get(base)
                if latin is not None:
                    out[char] = latin
    for code in range(0x300, 0x370):
        out[chr(code)] = ""
    return out


# Code point ranges whose letters may become several Latin ones, by script.
SCRIPTS = ("\u00c0-\u024f\u0259\u1e00-\u1eff", "\u0400-\u04ff", "\u0370-\u03ff\u1f00-\u1fff", "\u0900-\u097f")


def _speller(script: str, words: dict[str, str]):
    """Writes out the letters of one script, in texts that have any."""
    letters = {k: v for k, v in words.items() if re.match(f"[{script}]", k)}

    def spell(t: Column) -> Column:
        spelled = t
        for char, word in letters.items():
            spelled = F.replace(spelled, F.lit(char), F.lit(word))
        return F.when(t.rlike(f"[{script}]"), spelled).otherwise(t)

    return spell


def latin(c: Column | str) -> Column:
    """Text in Latin letters. Plain ASCII text is passed through untouched; letters
    outside the map stay as they are. A text only pays for the scripts it uses."""
    text = as_col(c)
    table = latin_map()
    single = {k: v for k, v in table.items() if len(v) == 1}
    dropped = "".join(k for k, v in table.items() if v == "")
    words = {k: v for k, v in table.items() if len(v) > 1}
    out = F.translate(text, "".join(single) + dropped, "".join(single.values()))
    for script in SCRIPTS:
        out = once(out, _speller(script, words))
    return F.when(text.rlike("[^\\x00-\\x7f]"), out).otherwise(text)


def transliterate(df: DataFrame, rules) -> DataFrame:
    """For each rule ``target = COALESCE(prefer, latin(source))``; an existing target
    is replaced, and later rules see earlier targets."""
    for rule in rules:
        if not rule.target or not rule.source:
            raise ValueError(f"transliterate rule needs both target and source: {rule!r}")
        types = dict(df.dtypes)
        for role, column in (("source", rule.source), ("prefer", rule.prefer)):
            if column is None:
                continue
            if column not in types:
                raise ValueError(f"transliterate {role} column {column!r} missing; available: {sorted(types)}")
            if types[column] != "string":
                raise ValueError(
                    f"transliterate {role} column {column!r} has type {types[column]!r}; expected string"
                )
        value = latin(rule.source)
        if rule.prefer is not None:
            value = F.coalesce(F.col(rule.prefer), value)
        keep = [c for c in df.columns if c != rule.target]
        df = df.select(*keep, value.alias(rule.target))
    return df
