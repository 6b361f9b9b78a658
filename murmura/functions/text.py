"""Unicode-safe text columns.

NFKC and full case folding have no SQL function, but Spark ships ICU for its collations and
Commons Lang, and ``reflect`` calls their static methods, so the text never leaves the JVM. The
calls cost far less than a regular expression that visits every blank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters deleted before whitespace is collapsed (tab, LF and CR stay).
CONTROL_CHARS = "".join(map(chr, [*range(0x00, 0x09), 0x0B, 0x0C, *range(0x0E, 0x20), 0x7F]))

# The one whitespace character left by NFKC that Java does not count as such.
NEXT_LINE = "\x85"

# Word characters: letters, numbers and underscore, but no combining marks.
WORD = r"[\p{L}\p{N}_]"


def _static(method: str, *args: Column) -> Column:
    class_name, _, name = method.rpartition(".")
    return F.reflect(F.lit(class_name), F.lit(name), *args)


def nfkc(c: Column) -> Column:
    """Compatibility composition of a text that is not null."""
    return _static("com.ibm.icu.text.Normalizer.compose", c, F.lit(True))


def fold(c: Column) -> Column:
    """Full Unicode case folding of a text that is not null: sharp s becomes ``ss``, final sigma sigma."""
    return _static("com.ibm.icu.lang.UCharacter.foldCase", c, F.lit(True))


def folded(columns: list[str]) -> dict[str, Column]:
    """What a table of clean posts derives from its text: as wide as that, so it isn't shuffled with it."""
    return {"content_norm": fold(F.col("content"))} if {"content", "content_norm"} <= set(columns) else {}


def casefold(c: Column) -> Column:
    """`fold`, null for null."""
    return F.when(c.isNotNull(), fold(c))


def normalize_text(c: Column) -> Column:
    """Null becomes empty; NFKC, control characters out, whitespace runs to one space, ends trimmed."""
    composed = nfkc(F.coalesce(c.cast("string"), F.lit("")))
    lang = "org.apache.commons.lang3.StringUtils"
    # The first character listed becomes a blank, the others have no counterpart and go.
    printable = _static(f"{lang}.replaceChars", composed, F.lit(NEXT_LINE + CONTROL_CHARS), F.lit(" "))
    return _static(f"{lang}.normalizeSpace", printable)


def strip_prefix(c: Column, char: str) -> Column:
    """Remove every leading ``char``."""
    return F.ltrim(c, F.lit(char))


def text_items(c: Column) -> Column:
    """A JSON list, a bare string or null as an array without empty items."""
    listed = F.from_json(F.when(c.startswith("["), c), "array<string>")
    items = F.coalesce(listed, F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array(c)))
    return F.filter(items, lambda x: x.isNotNull() & (x != ""))


def clean_array(items: Column, prefix: str, folded: bool = False) -> Column:
    """Normalise each item and strip its prefix; items that become empty are kept."""

    def clean(x: Column) -> Column:
        bare = strip_prefix(normalize_text(x), prefix)
        return fold(bare) if folded else bare

    return F.transform(items, clean)


def tokenize(c: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    text = F.lower(F.coalesce(c, F.lit("")))
    return F.regexp_extract_all(text, F.lit(f"{WORD}{{2,}}+"), F.lit(0))


# What parts words, but for blanks, which are left alone so that most gaps cost no match: listed one by one, since
# characters that are listed are looked up in a table.
_ASCII_GAP = "".join(f"\\x{i:02x}" for i in range(128) if not (chr(i).isalnum() or chr(i) in "_ "))
_OTHER_GAP = r"[^\x00-\x7f\p{L}\p{N}]"


def words(c: Column) -> Column:
    """The words of `tokenize` in one string, between blanks; single characters stay."""
    text = F.coalesce(c, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.regexp_replace(F.lower(text), f"[{_ASCII_GAP}]+", " ")).otherwise(
        F.regexp_replace(F.lower(text), f"[{_ASCII_GAP}{_OTHER_GAP}]+", " ")
    )
