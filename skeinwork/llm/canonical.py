"""Visually identical text with different characters: confusables skeletons.

A text is decomposed, every character is replaced by the prototype of all characters that look like it, and the result
is decomposed again. Texts look the same if their skeletons are equal. Differences that a reader sees are kept: case,
accents, punctuation, other digits, raised and circled signs, fractions and emoji, with their joiners and selectors.
"""

from __future__ import annotations

import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skeinwork.llm.joining import attach
from skeinwork.llm.pairs import pairs_within
from skeinwork.scratch import materialize

# fixed values: letters of other scripts, and the Latin letters (or digit) that they look like; what no rule below gives
LOOKALIKES = (
    # Cyrillic
    ("АВЕЅІЈКМНОРСТУХԚԜҮӀԌѴЗ", "ABESIJKMHOPCTYXQWYIGV3"),
    ("аеѕіјорсухһкԁԛԝүѵӏ", "aesijopcyxhkdqwyvl"),
    # Greek and Coptic
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ"),
    ("αινορυϲϳ", "aivopucj"),
    ("ⲀⲂⲈⲌⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥⲭ", "ABEZHIKMNOPCTYXopcx"),
    # Armenian
    ("օսոհցյզՕՏՍ", "ounhgjqOSU"),
    # Cherokee
    ("ᎪᏴᏟᎬᏀᎻᎫᏦᏞᎷᏢᏚᎢᏙᏔᏃᎠᎡᏒᎳᎽᏂᏏ", "ABCEGHJKLMPSTVWZDRRWYhb"),
    # Lisu
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    # Canadian syllabics
    ("ᗅᗷᑕᗞᖴᕼᒍᒪᑭᖇᑌᐯ᙭", "ABCDFHJLPRUVX"),
    # Latin of phonetics; hyphens as wide as the common one (a dash is longer, as a reader sees)
    ("ɑɡǃ", "ag!"),
    ("‐‑", "--"),
)
# fixed values: names in the character database that tell of a letter's shape; the letter is the last part
SHAPES = ("LATIN LETTER SMALL CAPITAL ", "LATIN SMALL LETTER DOTLESS ", "MODIFIER LETTER SMALL CAPITAL ")
# fixed values: white space that is no space separator is left alone; these have no width of their own
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋᠌᠍᠎ㅤ︀ﾠ"
SHOWN_COMPAT = {"<super>", "<sub>", "<circle>", "<square>", "<fraction>"}

# a joiner or selector after an emoji is part of it
EMOJI = r"[\p{Extended_Pictographic}\U0001F3FB-\U0001F3FF️⃣]"
_DEAD_JOINER = regex.compile(rf"(?<!{EMOJI})‍|‍(?!\p{{Extended_Pictographic}})|(?<![\p{{Extended_Pictographic}}#*0-9])️")
_HOLD = {0x200D: "‍", 0xFE0F: "️"}


@cache
def prototypes() -> dict[int, str]:
    """By code point, for ``str.translate``; built by rule from the character database and the letters above."""
    table: dict[int, str] = {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind in ("Cn", "Co", "Cs"):
            continue
        name = unicodedata.name(char, "")
        if kind == "Zs":
            table[code] = " "
        elif name.startswith(SHAPES) and len(name.rpartition(" ")[2]) == 1:
            table[code] = name[-1].lower()
        elif kind == "Cf" and not 0xE0020 <= code <= 0xE007F:
            table[code] = ""
        elif form := unicodedata.decomposition(char):
            tag = form.split()[0]
            if tag[0] == "<" and tag not in SHOWN_COMPAT and kind != "No":
                table[code] = unicodedata.normalize("NFKD", char)
    for char in INVISIBLE:
        table[ord(char)] = ""
    for source, target in LOOKALIKES:
        table |= {ord(s): t for s, t in zip(source, target, strict=True)}
    # what a plain form is made of may itself look like something else
    table = {code: "".join(table.get(ord(c), c) for c in form) for code, form in table.items()}
    return table | _HOLD


def skeleton(text: str | None) -> str | None:
    """The one form of all texts that look like ``text``; null for null. Line ends are written as ``\\n``."""
    if text is None:
        return None
    if text.isascii():
        return text.replace("\r\n", "\n")
    bare = _DEAD_JOINER.sub("", unicodedata.normalize("NFD", text)).translate(prototypes())
    return unicodedata.normalize("NFD", bare).replace("\r\n", "\n")


@F.pandas_udf(T.StringType())
def canonical(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(skeleton)


@F.pandas_udf(T.StructType([T.StructField("form", T.BinaryType()), T.StructField("chars", T.BinaryType())]))
def _digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    def digest(text: str | None) -> bytes | None:
        return None if text is None else hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    for texts in batches:
        forms = [skeleton(t) for t in texts]
        forms = [f if f and f.strip() else None for f in forms]
        yield pd.DataFrame({"form": [digest(f) for f in forms], "chars": [digest(t) for t in texts]})


def same_look(df: DataFrame, identifier: str, text: str) -> DataFrame:
    """``<identifier>_a`` < ``<identifier>_b`` for pairs of rows whose texts look the same but differ in characters.

    Null texts and texts that show nothing form no pairs, nor do exact repeats. Texts are compared by 128-bit digests of
    the whole skeleton. Identifiers are expected to be unique and not null; other columns are ignored.
    """
    rows = df.select(F.col(identifier), _digests(F.col(text)).alias("d")).select(identifier, "d.form", "d.chars").filter("form IS NOT NULL")
    rows = materialize(rows, "looks")
    mixed = rows.groupBy("form").agg(F.min("chars").alias("lo"), F.max("chars").alias("hi")).filter("lo <> hi").select("form")
    return pairs_within(rows.join(mixed, "form"), "form", identifier, differ="chars")


def look_classes(df: DataFrame, identifier: str, text: str) -> DataFrame:
    """One row per row: ``<identifier>``, ``class_id`` (the smallest identifier of those whose texts look the same) and
    ``n_forms``, the number of ways in which these texts are written. Null texts and texts that show nothing are a class by
    themselves, of no form. Identifiers are expected to be unique and not null; other columns are ignored."""
    rows = df.select(F.col(identifier), _digests(F.col(text)).alias("d")).select(identifier, "d.form", "d.chars")
    rows = materialize(rows, "looks")
    shown = rows.filter("form IS NOT NULL")
    # copies of one text are one row here
    written = shown.groupBy("form", "chars").agg(F.min(identifier).alias("_least"), F.count(F.lit(1)).alias("_n"))
    heads = materialize(written.groupBy("form").agg(F.min("_least").alias("class_id"), F.count(F.lit(1)).alias("n_forms"), F.sum("_n").alias("_n")), "heads")
    known = attach(shown, heads, ["form"], identifier, heads.count(), "_n").select(identifier, "class_id", "n_forms")
    return known.unionByName(rows.filter("form IS NULL").select(identifier, F.col(identifier).alias("class_id"), F.lit(0).cast("long").alias("n_forms")))


def unify(df: DataFrame, text: str, name: str = "canonical_text") -> DataFrame:
    """``df`` with the consistent form of ``text`` as column ``name``."""
    return df.withColumn(name, canonical(F.col(text)))
