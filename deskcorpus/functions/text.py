r"""Text cleaning as Column expressions.

Everything is a built-in Spark expression except Unicode compatibility
normalisation, which Spark lacks. That one step is an Arrow function, and it is
handed ``null`` for every row whose characters cannot be affected, so ordinary
text never crosses into Python (``coalesce(python(when(odd, t)), native(t))``).

Java's ``\s`` and ``\w`` are ASCII-only, so the classes below are written out.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters that count as white space.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000"
)
# The same as the inside of a Java class. Single Latin-1 characters become a bit
# set there, and the guarded tail is only looked at from U+1680 on.
WS = (
    r"\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]]"
)
WORD = r"\p{L}\p{N}_"
# The patterns that define markup, links and kept punctuation.
TAG = "<[^>]+>"
URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"
KEPT_PUNCTUATION = r""".,!?'"%$€£@#:/()\-"""
# Entities decoded by the ascii profile, in this order.
ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
)

# Character ranges that NFKC leaves alone in any combination (no member changes,
# none is a combining mark or the second half of a composition) and whose
# category is the same in every Unicode version since 13. Tested exhaustively.
NFKC_STABLE = (
    r"\x00-\x7F"  # ASCII
    r"\u00A1-\u00A7\u00A9\u00AB\u00AC\u00AE\u00B0\u00B1\u00B6\u00B7"  # Latin
    r"\u00BB\u00BF-\u0131\u0134-\u013E\u0141-\u0148\u014A-\u017E"
    r"\u0391-\u03A1\u03A3-\u03A9\u03AC-\u03CE\u0400-\u045F\u0490\u0491"  # Greek, Cyrillic
    r"\u0621-\u063A\u0641-\u064A"  # Arabic
    r"\u2012-\u2015\u2018-\u2022\u20AC"  # dashes, quotes
    r"\u3001-\u3003\u3041-\u3094\u30A1-\u30FA\u30FC\u4E00-\u9FFC"  # East Asian
    r"\uAC00-\uD7A3"
)
_BEYOND_ASCII = r"\x{80}-\x{10FFFF}"
_CONTROLS = "".join(f"\\x{c:02X}" for c in (*range(0x20), 0x7F))
_ODD = f"[{_BEYOND_ASCII}&&[^{NFKC_STABLE}]]"


def as_text(col: Column) -> Column:
    """Null becomes the empty string, other types their string form."""
    return F.coalesce(col.cast("string"), F.lit(""))


def as_text_nan(col: Column) -> Column:
    """String form where a missing value reads ``nan``."""
    return F.coalesce(col.cast("string"), F.lit("nan"))


def strip_tags(col: Column) -> Column:
    """Markup tags to one space."""
    return F.regexp_replace(col, TAG, " ")


def strip_urls(col: Column) -> Column:
    """Links to one space."""
    return F.regexp_replace(col, URL, " ")


def drop_nonprintable(col: Column) -> Column:
    """Delete control, format, unassigned and separator characters except the
    plain space (T04). Line breaks disappear without leaving a gap."""
    return F.regexp_replace(col, r"[\p{C}\p{Z}&&[^ ]]", "")


def drop_noise(col: Column, keep_punct: bool = True) -> Column:
    """Noise characters to spaces (T05), or all punctuation too."""
    kept = KEPT_PUNCTUATION if keep_punct else ""
    return F.regexp_replace(col, f"[^{WORD}{WS}{kept}]", " ")


def strip(col: Column) -> Column:
    """Remove white space from both ends."""
    return F.btrim(col, F.lit(WS_CHARS))


def squeeze(col: Column) -> Column:
    """Collapse white space to single spaces and strip the ends."""
    return F.trim(F.regexp_replace(col, f"[{WS}]+", " "))


# --- compatibility normalisation -------------------------------------------


def _map_valid(texts: pa.Array, fn) -> pa.Array:
    """Apply ``fn`` to the non-null strings of an Arrow batch."""
    if texts.null_count == len(texts):
        return texts.cast(pa.string())
    return pa.array(
        [None if t is None else fn(t) for t in texts.to_pylist()], type=pa.string()
    )


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    # Arrow's own normalisation follows another version of Unicode than Python
    return _map_valid(texts, lambda t: unicodedata.normalize("NFKC", t))


_PY_NOISE = re.compile("[^\\w\\s" + KEPT_PUNCTUATION + "]")


@F.arrow_udf(StringType())
def _nfkc_visible(texts: pa.Array) -> pa.Array:
    def visible(t: str) -> str:
        kept = filter(str.isprintable, unicodedata.normalize("NFKC", t))
        return _PY_NOISE.sub(" ", "".join(kept))

    return _map_valid(texts, visible)


@F.arrow_udf(StringType())
def _nfkd_ascii(texts: pa.Array) -> pa.Array:
    return _map_valid(texts, _ascii_part)


def _ascii_part(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode("ascii")


def is_odd(col: Column) -> Column:
    """True when a row holds a character that normalisation might touch."""
    return col.rlike(_ODD)


def nfkc(col: Column) -> Column:
    """NFKC form (T03); only rows with unusual characters visit Python."""
    return F.coalesce(_nfkc(F.when(is_odd(col), col)), col)


@lru_cache(maxsize=1)
def _ascii_tables() -> tuple[str, str, str]:
    """Derive the ASCII fold from Unicode data: characters that fold to exactly
    one ASCII character (as a translate pair, Latin blocks only), and a regex
    class of the remaining characters that leave any ASCII behind."""
    source, target, rest = [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        folded = _ascii_part(chr(point)) if not 0xD800 <= point <= 0xDFFF else ""
        if not folded:
            continue
        if len(folded) == 1 and point < 0x1F00:
            source.append(chr(point))
            target.append(folded)
        else:
            rest.append(point)
    spans, start = [], rest[0]
    for here, nxt in zip(rest, rest[1:] + [None]):
        if nxt != here + 1:
            spans.append(f"\\x{{{start:X}}}-\\x{{{here:X}}}")
            start = nxt
    return "".join(source), "".join(target), (
        f"[{_BEYOND_ASCII}&&[^\\u00C0-\\u0131]&&[{''.join(spans)}]]"  # letters first
    )


def fold_ascii(col: Column, probe: Column | None = None) -> Column:
    """NFKD form without its non-ASCII part (T13). The fold works character by
    character, so accents are a native ``translate``; only rows with ligatures,
    fractions and the like go through Python. ``probe`` is a cheaper column with at
    least the non-ASCII characters of ``col``, to choose the way by."""
    probe = col if probe is None else probe
    source, target, rest = _ascii_tables()
    folded = F.regexp_replace(F.translate(col, source, target), r"[^\x00-\x7F]+", "")
    native = F.when(F.octet_length(probe) == F.length(probe), col).otherwise(folded)
    return F.coalesce(_nfkd_ascii(F.when(probe.rlike(rest), col)), native)


# --- composed cleaners ------------------------------------------------------


def clean_core(col: Column, lowercase: bool = False) -> Column:
    """``core`` cleaner (T08): tags, links, NFKC, non-printables, noise, spaces.

    Ordinary rows stay in the JVM, where noise removal and space collapsing are
    one pass. Rows with unusual characters take NFKC and the two character
    filters in Python, whose Unicode tables define those steps."""
    text = as_text(col)
    base = _without_links(text)
    odd = _nfkc_visible(F.when(is_odd(text), base))
    out = F.coalesce(squeeze(odd), _plain_tail(base))
    return F.lower(out) if lowercase else out


def _without_tags(text: Column) -> Column:
    return F.when(text.contains("<"), strip_tags(text)).otherwise(text)


def _without_links(text: Column) -> Column:
    """Tags then links, each only where a cheap byte search says there may be one."""
    untagged = _without_tags(text)
    linked = text.contains("http") | text.contains("www.")
    return F.when(linked, strip_urls(untagged)).otherwise(untagged)


def _plain_tail(base: Column) -> Column:
    visible = F.regexp_replace(base, f"[{_CONTROLS}]+", "")
    return F.trim(F.regexp_replace(visible, f"[^{WORD}{KEPT_PUNCTUATION}]+", " "))


def decode_markup(col: Column) -> Column:
    """Strip tags, then decode six entities in their fixed order."""
    out = _without_tags(col)
    for entity, plain in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return out


def clean_ascii(col: Column, lowercase: bool = True) -> Column:
    """``ascii`` cleaner (T14): markup and entities, ASCII fold, spaces, case."""
    text = as_text(col)
    out = squeeze(fold_ascii(decode_markup(text), probe=text))
    return F.lower(out) if lowercase else out


CLEANERS = {"core": clean_core, "ascii": clean_ascii}


# --- counts -----------------------------------------------------------------


def word_count(col: Column) -> Column:
    """Number of white-space separated words, 0 for null."""
    return F.size(split_words(col))


def split_words(col: Column) -> Column:
    """The white-space separated words themselves."""
    return F.array_remove(F.split(as_text(col), f"[{WS}]+"), "")


def at_most_words(col: Column, limit: int) -> Column:
    """``word_count(col) <= limit`` that stops reading after the first words."""
    more = f"^[{WS}]*(?:[^{WS}]+[{WS}]+){{{limit}}}[^{WS}]"
    return ~as_text(col).rlike(more)


def word_count_squeezed(col: Column) -> Column:
    """``word_count`` for text that is already squeezed, without a regex."""
    blanks = F.length(col) - F.length(F.replace(col, F.lit(" "), F.lit("")))
    return F.when(F.length(col) > 0, blanks + 1).otherwise(0)


def char_count(col: Column) -> Column:
    """Length in code points."""
    return F.length(col)


def joined(first: Column, second: Column) -> Column:
    """Two texts with one space between, missing values as ``nan``."""
    return F.concat(as_text_nan(first), F.lit(" "), as_text_nan(second))


def fill(template: Column, order_id: Column) -> Column:
    """Fill the ``{oid}`` slot of a template."""
    return F.replace(template, F.lit("{oid}"), order_id.cast("string"))
