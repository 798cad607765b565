"""Text scalars as column expressions.

All but `nfkc` are built-in functions and stay in whole-stage code. Unicode compatibility forms have no built-in, so
sources apply `nfkc` (an Arrow UDF) once where it can matter, and everything after works on normalised text.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Unicode white space, listed: flags for Unicode classes make Java's expressions slow.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
S = f"[{SPACE}]"
#: The same as characters.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c, re.ASCII))
U = "(?U)"
DASHES = "‐‑‒–—―－"
KEY_GAPS = rf"[{SPACE}\-{DASHES}_/\\.]+"
CJK = r"\x{3400}-\x{9fff}"
SENTENCE_END = r"[。！？；;]"


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition."""
    return s.map(lambda x: x if x is None or unicodedata.is_normalized("NFKC", x) else unicodedata.normalize("NFKC", x))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, which is computed once: the optimizer copies a column's expression to each use in a filter."""
    return F.element_at(F.transform(F.array(value), body), 1)


def each(df: DataFrame, array: str, pos: str, value: str) -> DataFrame:
    """df with a row for each item of column array, which goes, and its place from 0. Before a plain explode the optimizer
    puts a filter with the array's whole expression, which is so computed twice; before an outer one it does not."""
    return df.select(*[c for c in df.columns if c != array], F.posexplode_outer(array).alias(pos, value)).where(F.col(pos).isNotNull())


def strip(s: Column) -> Column:
    return F.trim(s, F.lit(BLANKS))


def squeeze(s: Column) -> Column:
    """Each run of white space one space, none at the ends."""
    return F.trim(F.regexp_replace(s, f"{S}+", " "))


def clean_text(s: Column) -> Column:
    s = F.regexp_replace(F.translate(s, "\u00a0\u3000", "  "), r"[ \t]+", " ")
    return strip(F.regexp_replace(s, r"\n{3,}", "\n\n"))


def semantic_key(s: Column) -> Column:
    """What is compared: lower case, without white space, dashes, underscores, slashes and dots. s: NFKC text."""
    return F.regexp_replace(F.lower(s), KEY_GAPS, "")


def key_of(term: str) -> str:
    """semantic_key of a literal."""
    return re.sub(KEY_GAPS, "", unicodedata.normalize("NFKC", term).lower())


def lines(s: Column) -> Column:
    return F.split(F.regexp_replace(s, "\r\n?", "\n"), "\n")


def filled_lines(s: Column) -> Column:
    """Stripped lines that aren't empty."""
    return F.filter(F.transform(lines(s), strip), lambda x: x != "")


def is_navigation(s: Column) -> Column:
    """Nothing but numbers and rules, or two lines and more of which 60 % end like a table of contents."""

    def contents(full: Column) -> Column:
        leaders = F.size(F.filter(full, lambda x: x.rlike(r"(\.{4,}|…{2,}|·{4,})\s*\d*\s*$")))
        return (F.size(full) >= 2) & (leaders >= F.size(full) * 0.6)

    several = lambda text: F.contains(text, F.lit("\n")) | F.contains(text, F.lit("\r"))
    return let(strip(s), lambda text: (text == "") | text.rlike(rf"^[\d{SPACE}\-–—_/]+$") | (several(text) & let(filled_lines(text), contents)))


def ocr_usable(s: Column, images: Column) -> Column:
    compact = F.regexp_replace(s, f"{S}+", "")
    return (F.length(compact) >= F.greatest(F.lit(4), images * 2)) & compact.rlike(f"[{CJK}A-Za-z0-9]")


def ocr_spacing(s: Column) -> Column:
    """No spaces between CJK characters, before closing or after opening punctuation."""
    s = F.regexp_replace(clean_text(s), rf"(?<=[{CJK}]){S}+(?=[{CJK}])", "")
    s = F.regexp_replace(s, rf"{S}+([，。；：！？、）】》])", "$1")
    return F.regexp_replace(s, rf"([（【《]){S}+", "$1")


def printed_page(s: Column) -> Column:
    """The first of the first eight lines that is a number of one to three digits."""
    first = F.filter(F.transform(F.slice(lines(s), 1, 8), strip), lambda x: x.rlike(r"^\d{1,3}$"))
    return F.try_element_at(first, F.lit(1)).cast("int")


def pdf_pages(s: Column) -> Column:
    return F.transform(F.regexp_extract_all(s, F.lit(r"(?i)PDF\s*(\d+)"), F.lit(1)), lambda x: x.cast("int"))


def latin_codes(s: Column) -> Column:
    """Codes: tokens with digits, and capitals of two to fifteen characters."""
    return F.regexp_extract_all(s, F.lit(r"((?<![A-Za-z0-9])(?:[A-Za-z]+[-_/])?[A-Za-z]*\d+[A-Za-z0-9+./_-]*|\b[A-Z][A-Z0-9+./_-]{1,14}\b)"), F.lit(1))


def term_present(term: str, text: Column, key: Column) -> Column:
    """Short Latin terms as words of the lower-cased text, all others in the key."""
    low = unicodedata.normalize("NFKC", term).lower()
    if re.fullmatch(r"[a-z0-9+./_-]{2,15}", low):
        word = F.lower(text).rlike(rf"(?<![a-z0-9])\Q{low}\E(?![a-z0-9])")
        return F.contains(key, F.lit(key_of(term))) & word  # the key is the cheaper test
    return F.contains(key, F.lit(key_of(term)))


def split_tokens(s: Column) -> Column:
    return F.filter(F.transform(F.split(s, "[／、,，]+"), squeeze), lambda x: x != "")


def safe_stem(name: Column, fallback: str = "document") -> Column:
    """A name that is fit for a path."""
    stem = F.regexp_replace(F.regexp_replace(name, r"^.*[/\\]", ""), r"\.[^.]*$", "")
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(stem, U + r"[^\w\-]+", "_"), F.lit("_")), F.lit("")), F.lit(fallback))


def html_escape(s: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def slug(s: Column) -> Column:
    """A stable id: the code points weighted by place, modulo 1,000,003."""
    chars = F.filter(F.split(s, ""), lambda c: c != "")
    total = F.aggregate(F.transform(chars, lambda c, i: (i + 1).cast("long") * F.ascii(c)), F.lit(0).cast("long"), lambda a, x: a + x)
    return F.concat(F.lit("sys-"), F.lpad((total % 1_000_003).cast("string"), 6, "0"))


def diagnostic_line(code: Column, message: Column, action: Column) -> Column:
    flat = [F.translate(c, "|\r\n", "/  ") for c in (code, message, action)]
    return F.concat_ws("|", F.lit("DOC_ERR"), *flat)


def parse_diagnostic(line: Column) -> Column:
    """code, message, action; null if it is no such line."""
    parts = F.split(strip(line), r"\|", 4)
    good = (F.size(parts) == 4) & (parts[0] == "DOC_ERR")
    return F.when(good, F.struct(parts[1].alias("code"), parts[2].alias("message"), parts[3].alias("action")))


# Diagnostic codes with exit numbers, and those that end a run.
EXIT_CODES = {
    "E_PLATFORM": 10, "E_ARCH": 11, "E_PERMISSION": 12, "E_DISK_SPACE": 13, "E_PATH_TOO_LONG": 14, "E_NETWORK": 15, "E_VC_RUNTIME": 20,
    "E_TORCH_RUNTIME": 21, "E_DEPENDENCY_MISSING": 22, "E_DOCLING_RUNTIME": 23, "E_MEMORY": 24, "E_PDF_INVALID": 30, "E_RUNTIME": 99,
}
FATAL = ["E_PLATFORM", "E_ARCH", "E_PERMISSION", "E_DISK_SPACE", "E_PATH_TOO_LONG", "E_NETWORK", "E_VC_RUNTIME", "E_TORCH_RUNTIME", "E_DEPENDENCY_MISSING", "E_DOCLING_RUNTIME", "E_MEMORY"]


def diagnostic_code(kind: Column, message: Column, winerror: Column, errno: Column) -> Column:
    """The class of an error, by rules of which the first that holds counts. Their numbers and words are fixed values."""
    text = F.lower(F.concat(kind, F.lit(": "), message))
    has = lambda *ws: text.rlike("|".join(rf"\Q{w}\E" for w in ws))
    rules = [
        (kind == "MemoryError", "E_MEMORY"),
        ((kind == "PermissionError") | (winerror == 5), "E_PERMISSION"),
        (kind == "ModuleNotFoundError", "E_DEPENDENCY_MISSING"),
        (winerror.isin(126, 1114) & has("torch", "c10.dll", "fbgemm", "shm.dll"), "E_TORCH_RUNTIME"),
        (winerror == 193, "E_ARCH"),
        ((winerror == 206) | has("path too long", "filename or extension is too long"), "E_PATH_TOO_LONG"),
        ((errno == 28) | has("no space left", "磁碟空間不足"), "E_DISK_SPACE"),
        (has("ssl", "certificate", "urlopen", "connection", "timed out"), "E_NETWORK"),
        (has("pdfium", "invalid pdf", "cannot open document", "password"), "E_PDF_INVALID"),
    ]
    out = F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(code)) for test, code in rules], F.lit("E_RUNTIME"))
    return out


def is_fatal(code: Column) -> Column:
    return code.isin(FATAL)


def shell(html: Column, start: str, end: str) -> Column:
    """The page with its data between the markers replaced by a constant, to compare what surrounds it."""
    return F.regexp_replace(html, rf"(?s)\Q{start}\E.*?\Q{end}\E", f"{start}__LOCKED_DATA__{end}")
