"""Column functions over text in one script: words, normal forms, numbers, statistics, romanisation.

The script is a parameter: a character class as Java's regular expressions write it.  Patterns with
``(?U)`` treat white space and digits as Unicode does.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Character classes.
DEVANAGARI = "\\x{0900}-\\x{097F}"
DEVANAGARI_EXTENDED = "\\x{0900}-\\x{097F}\\x{A8E0}-\\x{A8FF}"
LATIN = "A-Za-z\\x{00C0}-\\x{00FF}"
NATIVE_DIGITS = "०१२३४५६७८९"


def strip(c: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def script_words(c: Column, chars: str = DEVANAGARI) -> Column:
    """Maximal runs of the script's characters, in order."""
    return F.regexp_extract_all(c, F.lit(f"[{chars}]+"), F.lit(0))


def script_text(c: Column, chars: str = DEVANAGARI, between: str = " ") -> Column:
    """The script's runs, joined."""
    return F.array_join(script_words(c, chars), between)


def normalised(c: Column) -> Column:
    """Without white space, zero-width characters, verse marks and native digits."""
    return F.regexp_replace(c, "(?U)[\\s\\x{200B}-\\x{200D}\\x{0964}\\x{0965}\\x{0966}-\\x{096F}]+", "")


def single_dandas(c: Column) -> Column:
    """A double verse mark as two single ones."""
    return F.replace(c, F.lit("॥"), F.lit("।।"))


def verse_number(c: Column) -> Column:
    """The number after the first double verse mark that has one; null without."""
    digits = F.regexp_extract(c, "(?U)॥\\s*([०-९\\d]+)(?:\\s*॥)?", 1)
    return F.translate(digits, NATIVE_DIGITS, "0123456789").try_cast("int")


def text_stats(c: Column, chars: str = DEVANAGARI_EXTENDED) -> Column:
    """Struct of total and distinct characters, and these in order, of the normal form."""
    text = normalised(script_text(c, chars, ""))
    letters = F.array_sort(F.array_distinct(F.filter(F.split(text, ""), lambda x: x != "")))
    return F.struct(F.length(text).cast("long").alias("total"), F.size(letters).cast("long").alias("distinct"), letters.alias("characters"))


def whitespace_only(c: Column) -> Column:
    return c.rlike("(?U)^\\s*$")


def content_text(content: Column, english_translation: Column, english: Column, scripts: tuple[str, ...] = ("devanagari", "roman", "kannada")) -> Column:
    """A passage's text: the scripts in their fixed order, then the translations, nothing between."""
    parts = [F.try_element_at(content, F.lit(s)) for s in ("devanagari", "roman", "kannada") if s in scripts]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in (*parts, english_translation, english)])


#: Harvard-Kyoto letters.
CONSONANTS = dict(zip("क ख ग घ ङ च छ ज झ ञ ट ठ ड ढ ण त थ द ध न प फ ब भ म य र ल व श ष स ह ळ".split(), "k kh g gh G c ch j jh J T Th D Dh N t th d dh n p ph b bh m y r l v z S s h L".split()))
VOWELS = dict(zip("अ आ इ ई उ ऊ ऋ ॠ ऌ ॡ ए ऐ ओ औ".split(), "a A i I u U R RR lR lRR e ai o au".split()))
SIGNS = dict(zip("ा ि ी ु ू ृ ॄ ॢ ॣ े ै ो ौ".split(), "A i I u U R RR lR lRR e ai o au".split()))
OTHERS = {"ं": "M", "ः": "H", "ँ": "~", "ऽ": "'", "।": "|", "॥": "||", "ॐ": "OM", **dict(zip(NATIVE_DIGITS, "0123456789"))}
VIRAMA = "्"
_IAST = {
    **dict(zip("ङ च छ ञ ट ठ ड ढ ण श ष ळ आ ई ऊ ऋ ॠ ऌ ॡ ा ी ू ृ ॄ ॢ ॣ ं ः ँ ॐ".split(), "ṅ c ch ñ ṭ ṭh ḍ ḍh ṇ ś ṣ ḷ ā ī ū ṛ ṝ ḷ ḹ ā ī ū ṛ ṝ ḷ ḹ ṃ ḥ m̐ oṃ".split())),
}
_ITRANS = dict(zip("ङ च छ ञ श ष ळ आ ई ऊ ऋ ॠ ऌ ॡ ा ी ू ृ ॄ ॢ ॣ ँ ऽ".split(), "~N ch Ch ~n sh Sh L A I U RRi RRI LLi LLI A I U RRi RRI LLi LLI .N .a".split()))
#: Letters that a scheme writes otherwise than Harvard-Kyoto does: fixed values.
SCHEMES = {"HK": {}, "IAST": _IAST, "ITRANS": _ITRANS}


def romanise(text: str | None, scheme: str = "HK") -> str | None:
    """One text in a scheme's letters; a consonant without a sign has its inherent vowel."""
    if text is None:
        return None
    own = SCHEMES[scheme]
    out, bare = [], False  # bare: a consonant waits for its vowel
    for ch in text:
        if bare and (ch in SIGNS or ch == VIRAMA):
            out.append(own.get(ch) or SIGNS.get(ch, ""))
            bare = False
            continue
        if bare:
            out.append("a")
        bare = ch in CONSONANTS
        out.append(own.get(ch) or CONSONANTS.get(ch) or VOWELS.get(ch) or OTHERS.get(ch) or ch)
    return "".join(out) + ("a" if bare else "")


def transliterated(texts: Column, scheme: str = "HK") -> Column:
    """For display: Devanagari in a scheme of ``SCHEMES``."""
    if scheme not in SCHEMES:
        raise ValueError(f"unknown scheme {scheme}")

    @F.pandas_udf(T.StringType())
    def run(found: pd.Series) -> pd.Series:
        return found.map(lambda t: romanise(t, scheme))

    return run(texts)
