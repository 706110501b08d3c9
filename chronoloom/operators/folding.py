"""Keys under which words of two tokenizers are compared: compatibility forms and case folded, with or without edge marks.

Spark has no compatibility normalization, so both are Arrow functions over a column: each distinct text of a batch is folded once,
ASCII by kernels, and the rest by Python's Unicode tables.
"""

from __future__ import annotations

import string
import sys
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space, ASCII punctuation, and the marks stripped from the edges of a token or word before comparison.
EDGE_MARKS = " \t\n\r\f\v" + string.punctuation + "¡¿–—‘’“”…«»"
#: All white space of Unicode, as Python's strip() takes it.
BLANKS = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


def fold(texts: pa.Array) -> pa.Array:
    """NFKC, stripped, case folded; null is empty."""
    coded = pc.fill_null(texts.cast(pa.string()), "").dictionary_encode()
    distinct = coded.dictionary
    plain = pc.string_is_ascii(distinct)
    folded = pc.utf8_trim(pc.ascii_lower(distinct), BLANKS)
    others = [unicodedata.normalize("NFKC", x).strip().casefold() for x in distinct.filter(pc.invert(plain)).to_pylist()]
    return pc.replace_with_mask(folded, pc.invert(plain), pa.array(others, pa.string())).take(coded.indices)


def raw_key(text: Column) -> Column:
    """The whole text, folded: for marks that were timed as words."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return fold(texts)

    return run(text)


def core_of(raw: Column) -> Column:
    """The word core of a folded text: without marks at its edges. Stays in the JVM."""
    return F.btrim(raw, F.lit(EDGE_MARKS))


def core_text(text: Column) -> Column:
    return core_of(raw_key(text))


def has_core(text: Column) -> Column:
    """Whether a text holds more than marks and white space."""
    return F.length(core_text(text)) > 0
