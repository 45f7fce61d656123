"""Text functions over string columns: entities, HTML stripping, code, links, readability.

All of them are built-in column expressions, so they stay in the JVM and a row
that needs no work (no ``&``, ASCII only) takes the short branch of a ``when``.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.binding import constant, let
from threadloom.functions.regex import LINE_BREAK, SPACE, WORD, count_many, count_matches, extract_all

# Code points an HTML numeric reference maps elsewhere (HTML standard,
# "numeric character reference end state"; 0x80-0x9f follow windows-1252).
_REMAPPED = {0x00: "�", 0x0D: "\r"} | {
    b: bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b)
    for b in range(0x80, 0xA0)
}

# References of which most texts have no others; "&amp;" has to be the last one.
_USUAL = [("lt;", "<"), ("gt;", ">"), ("quot;", '"'), ("amp;", "&")]
_UNUSUAL = "&(?=[#A-Za-z])(?!(?:lt|gt|quot|amp);)"
_LONGEST_NAME = max(map(len, html5))

_TAG = rf"</?(?!pre|code|a){WORD}[^>]*+>"
# "<" stands outside of the case-blind part, so that the search skips to it quickly.
_CODE_BLOCK = r"(?s)<(?iu:pre><code>)(.*?)</(?iu:code></pre>)"
_LINK = rf"<(?iu:a){SPACE}+(?iu:href=)"
_IMAGE = rf"<(?iu:img){SPACE}+(?iu:src=)"
_NON_BLANK_LINE = rf"[^\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}][^{LINE_BREAK}]*+"
_SYLLABLE = "[aeiouy]+| [^ aeiouy]++(?= )"
_NO_VOWEL = " [^ aeiouyı]+(?= )"
_ALL = 2**31 - 1
_TOO_BIG = 0x110000
_MAP = "map<string,string>"


# ---- entities -----------------------------------------------------------------

def unescape(text: Column) -> Column:
    """Decode HTML5 character references (named, decimal, hex; ``;`` optional where HTML allows).

    A text with none but the four usual references is decoded by plain replacement
    (``&amp;`` last, so nothing is decoded twice); only the others are cut at each ``&``.
    """
    plain = text
    for name, char in _USUAL:
        plain = F.replace(plain, F.lit(f"&{name}"), F.lit(char))
    pieces = F.split(text, "&")
    decoded = F.array_join(
        F.transform(pieces, lambda piece, i: F.when(i == 0, piece).otherwise(_decode(piece))), "")
    return F.when(~text.contains("&"), text).when(text.rlike(_UNUSUAL), decoded).otherwise(plain)


def _decode(piece: Column) -> Column:
    """Decode one piece of text that followed an ``&``.  Only its head is looked at."""
    head = F.substring(piece, 1, _LONGEST_NAME)
    chain = F
    for name, char in _USUAL:
        chain = chain.when(piece.startswith(name), F.concat(F.lit(char), F.substring(piece, len(name) + 1, _ALL)))
    return (chain.when(piece.startswith("#"), _decode_number(piece))
            .when(head.rlike("^[A-Za-z]"), _decode_name(piece, head))
            .otherwise(F.concat(F.lit("&"), piece)))


def _decode_name(piece: Column, head: Column) -> Column:
    closed = {k: v for k, v in html5.items() if k.endswith(";")}
    name = F.regexp_extract(head, "^[^\t\n\f <&#;]+;", 0)
    full = F.try_element_at(constant(closed, _MAP), name)
    bare = {k: html5[k] for k in sorted(html5.keys() - closed.keys(), key=lambda k: (-len(k), k))}
    prefix = F.regexp_extract(head, f"^(?:{'|'.join(bare)})", 0)
    return F.coalesce(
        F.when(name != "", F.concat(full, F.substring(piece, F.length(name) + 1, F.lit(_ALL)))),
        F.when(prefix != "", F.concat(F.try_element_at(constant(bare, _MAP), prefix),
                                      F.substring(piece, F.length(prefix) + 1, F.lit(_ALL)))),
        F.concat(F.lit("&"), piece))


def _decode_number(piece: Column) -> Column:
    ref = F.regexp_extract(piece, "^#(?:[xX][0-9a-fA-F]+|[0-9]+);?", 0)
    rest = F.substring(piece, F.length(ref) + 1, F.lit(_ALL))
    hex_digits = F.regexp_extract(ref, "^#[xX]0*([0-9a-fA-F]*)", 1)
    digits = F.regexp_extract(ref, "^#0*([0-9]*)", 1)
    value = F.when(
        ref.rlike("^#[xX]"),
        F.when(F.length(hex_digits) > 8, F.lit(_TOO_BIG)).otherwise(
            F.coalesce(F.conv(F.nullif(hex_digits, F.lit("")), 16, 10).cast("bigint"), F.lit(0)))
    ).otherwise(
        F.when(F.length(digits) > 10, F.lit(_TOO_BIG)).otherwise(
            F.coalesce(F.nullif(digits, F.lit("")).cast("bigint"), F.lit(0))))
    return F.when(ref == "", F.concat(F.lit("&"), piece)).otherwise(F.concat(_character(value), rest))


def _character(code: Column) -> Column:
    remapped = F.try_element_at(constant({str(k): v for k, v in _REMAPPED.items()}, _MAP), code.cast("string"))
    dropped = (code.between(0x1, 0x8) | (code == 0xB) | code.between(0xE, 0x1F) | code.between(0x7F, 0x9F)
               | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE))
    return (
        F.when((code == 0) | (code == 0xD) | code.between(0x80, 0x9F), remapped)
        .when(code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), F.lit("�"))
        .when(dropped, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")))


# ---- normalisation --------------------------------------------------------------

def strip(text: Column) -> Column:
    """Remove Unicode whitespace at both ends (``F.trim`` removes spaces only)."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def nfkd(text: Column) -> Column:
    """Unicode compatibility decomposition; ASCII text is returned as it is.

    Spark has no such function, but ships ICU for its collations, so the
    ``reflect`` function can call it without a trip through Python.
    """
    def decompose(t: Column) -> Column:
        return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), t, F.lit(True))

    return let(text, lambda t: F.when(t.rlike(r"[^\x00-\x7f]"), decompose(t)).otherwise(t))


def normalize_text(text: Column) -> Column:
    """Entities, NFKD, strip, lower case, whitespace runs to one space; NULL becomes ''."""
    decoded = nfkd(unescape(F.coalesce(text, F.lit(""))))
    return F.regexp_replace(F.lower(strip(decoded)), f"{SPACE}+", " ")


# ---- HTML -----------------------------------------------------------------------

def strip_tags(html: Column) -> Column:
    """Each tag to one space; tags whose name starts with pre, code or a stay."""
    return F.regexp_replace(html, _TAG, " ")


def html_to_text(raw_html: Column) -> Column:
    """Decode entities first, then strip tags: an escaped tag in prose goes as well."""
    return strip_tags(unescape(F.coalesce(raw_html, F.lit(""))))


def code_blocks(body: Column) -> Column:
    """Contents of the ``<pre><code>`` blocks of a raw body, in order."""
    return extract_all(body, _CODE_BLOCK)


def non_blank_lines(blocks: Column) -> Column:
    return count_matches(F.array_join(blocks, "\n"), _NON_BLANK_LINE)


def link_count(body: Column) -> Column:
    """Anchors whose first attribute is href, in a raw body."""
    return count_matches(body, _LINK)


def has_image(body: Column) -> Column:
    return body.rlike(_IMAGE)


# ---- words ----------------------------------------------------------------------

def tokenize(text: Column) -> Column:
    return words_of(F.lower(text))


def words_of(lowered: Column) -> Column:
    """The words of a text that is in lower case already."""
    return extract_all(lowered, f"{WORD}+", 0)


def sentence_count(text: Column) -> Column:
    return F.greatest(F.lit(1), count_many(text, "[.!?]+"))


def fold(lowered: Column) -> Column:
    """The two letters that a case-blind match still equates after lower-casing."""
    return F.when(lowered.contains("ı") | lowered.contains("ſ"), F.translate(lowered, "ıſ", "is")).otherwise(lowered)


def syllable_count(tokens: Column) -> Column:
    """Sum over words of max(1, vowel runs).

    One scan of the words between spaces: a match is a vowel run, or a whole word without a vowel.
    """
    spaced = F.concat(F.lit(" "), let(F.array_join(tokens, " "), fold), F.lit(" "))
    return count_many(spaced, _SYLLABLE)


def syllable_count_of(folded: Column, tokens: Column) -> Column:
    """The same for a lower-cased text that is folded already, and its words before that.

    Vowels are letters, so the runs are counted in the text; only words without a vowel are looked for among the words.
    Each is a pattern that begins with one class or character and repeats it greedily, which Java runs as a loop.
    """
    spaced = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    return count_many(folded, "[aeiouy]+") + count_many(spaced, _NO_VOWEL)


def flesch_reading_ease(words: Column, sentences: Column, syllables: Column) -> Column:
    score = (F.lit(206.835) - F.lit(1.015) * F.try_divide(words, sentences)
             - F.lit(84.6) * F.try_divide(syllables, words))
    return F.coalesce(score, F.lit(0.0))
