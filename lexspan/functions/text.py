"""Text functions: cleaning, search normalisation, terms, counts and paths.

Everything is a Column expression but the decomposition in `normalise`, for which Spark has no
built-in; it is an Arrow UDF meant for ingest, so that searches stay inside generated code. Positions
and lengths are in code points.
"""

from __future__ import annotations

import re
import unicodedata
from urllib.parse import quote, unquote_to_bytes

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The white space that is collapsed and trimmed.
SPACES = (
    "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def _class(chars: str) -> str:
    """A regular expression's class of the characters; those that follow one another beyond Latin are a range, which is tested at once."""
    out: list[list[int]] = []
    for c in sorted(map(ord, chars)):
        if out and c > 0xFF and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "[" + "".join(f"\\x{{{low:x}}}" + f"-\\x{{{high:x}}}" * (high > low) for low, high in out) + "]"


_SPACE_CLASS = _class(SPACES) + "+"

# Words too common in this corpus to weigh much.
GENERIC_WORDS = (
    "space", "spatial", "spatiale", "spaziale", "raumfahrt", "kosmiczny",
    "law", "laws", "legal", "legislation", "legislative", "regulation",
    "regulations", "legge", "leggi", "diritto", "loi", "lois", "droit",
    "gesetz", "recht", "prawo", "zakon", "zakona", "zakonem",
    "policy", "policies", "politica", "politique", "politik", "polityka",
    "strategy", "strategies", "strategia", "strategie", "strategii",
    "national", "nationale", "nazionale", "nationaler", "narodowa", "narodni",
    "operator", "operators", "operatore", "operatori", "operateur", "operateurs",
    "licensing", "licence", "license", "authorisation", "authorization",
    "autorizzazione", "autorizzazioni", "autorisation", "genehmigung",
    "act", "acts", "programme", "program", "programmes", "programma",
    "agency", "agencies", "agenzia", "agence", "agentur",
    "government", "ministry", "commission", "council", "parliament",
    "european", "europe", "union", "member", "state", "states",
)

#: A term is a run of letters, digits, hyphens and underscores longer than two characters.
TERM_BREAK, LEAST_TERM = r"[^\p{L}\p{N}_-]+", 2


_MARKS = re.compile("[\u0300-\u036f]+")
#: Texts that are Python strings at a time.
AT_ONCE = 256


def normalise_text(value: str | None) -> str:
    """Lower case, then compatibility decomposition, then without U+0300-U+036F; null: empty."""
    if not value:
        return ""
    if value.isascii():
        return value.lower()
    return _MARKS.sub("", unicodedata.normalize("NFKD", value.lower()))


@F.arrow_udf(StringType())
def _decomposed(texts: pa.Array) -> pa.Array:
    """`normalise_text` of a column, null for null. Besides Arrow's columns it holds AT_ONCE texts."""
    parts = [pa.array([None if t is None else normalise_text(t) for t in texts.slice(at, AT_ONCE).to_pylist()], pa.string()) for at in range(0, len(texts), AT_ONCE)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def normalise(text: str | Column) -> Column:
    """`normalise_text` of a column. Only texts that aren't ASCII are sent to Python."""
    c = F.col(text) if isinstance(text, str) else text
    ascii_ = F.length(c) == F.octet_length(c)
    return F.when(c.isNull(), "").when(ascii_, F.lower(c)).otherwise(_decomposed(F.when(~ascii_, c)))


def _is_term_char(c: str) -> bool:
    return c in "-_" or unicodedata.category(c)[0] in "LN"


def query_terms(query: str | None) -> list[str]:
    """The terms of a query in order, repeats included."""
    spaced = "".join(c if _is_term_char(c) else " " for c in normalise_text(query))
    return [t for t in spaced.split(" ") if len(t) > LEAST_TERM]


def terms_of(normalised: Column) -> Column:
    """The same of a normalised column."""
    return F.filter(F.split(normalised, TERM_BREAK), lambda t: F.length(t) > LEAST_TERM)


_GENERIC = frozenset(map(normalise_text, GENERIC_WORDS))


def is_generic_term(term: str) -> bool:
    return term in _GENERIC


def is_generic(term: Column) -> Column:
    return term.isin(sorted(_GENERIC))


def count_occurrences(text: Column, term: str | Column) -> Column:
    """Occurrences of a substring that don't overlap; an empty term has none."""
    t = F.lit(term) if isinstance(term, str) else term
    n = (F.length(text) - F.length(F.replace(text, t, F.lit("")))) / F.length(t)
    return F.when(F.length(t) > 0, n).otherwise(F.lit(0)).cast("int")


def clean_text(text: Column) -> Column:
    """White space collapsed to single spaces, none at the ends; null: empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE_CLASS, " "))


def folder_of(file: Column) -> Column:
    """Name of the folder that holds the file; '.' for a bare name's."""
    parts = F.split(file, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, -2)).otherwise(F.lit("."))


def phrase_of(query: str | None) -> str:
    """The normalised query as a phrase."""
    return re.sub(f"[{SPACES}]+", " ", normalise_text(query)).strip(SPACES)


#: A phrase counts if it is longer than that.
PHRASE_BEYOND = 6


def contains_phrase(content_norm: Column, query: str, longer_than: int = PHRASE_BEYOND) -> Column:
    """Whether the phrase, if it is longer than that, stands in the text."""
    phrase = phrase_of(query)
    return content_norm.contains(phrase) if len(phrase) > longer_than else F.lit(False)


def requested_file(file: str | None) -> str:
    """A requested path, trimmed and with forward slashes."""
    return (file or "").strip(SPACES).replace("\\", "/")


def requested_file_of(file: Column) -> Column:
    return F.replace(F.regexp_replace(F.coalesce(file, F.lit("")), f"^{_SPACE_CLASS}|{_SPACE_CLASS}$", ""), F.lit("\\"), F.lit("/"))


def percent_decode(text: str) -> str:
    """Percent-decoded text; as it is if that isn't valid."""
    if re.search(r"%(?![0-9A-Fa-f]{2})", text):
        return text
    try:
        return unquote_to_bytes(text).decode("utf-8")
    except UnicodeDecodeError:
        return text


def percent_decoded(text: Column) -> Column:
    """`percent_decode` of a column: as it is if an escape is incomplete or the bytes aren't UTF-8."""
    lost = "\ufffd"  # what the decoder puts for such bytes; one that was meant is counted on both sides
    count = lambda c, what: F.size(F.split(c, what)) - 1
    plain = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(plain.isNotNull() & (count(plain, lost) == count(text, lost) + count(F.upper(text), "%EF%BF%BD")), plain).otherwise(text)


def clamp_int(value: object, default: int, low: int, high: int) -> int:
    """The leading integer of a value within bounds; the default if there is none."""
    found = re.match(rf"[{SPACES}]*([+-]?\d+)", "" if value is None else str(value))
    return max(low, min(high, int(found[1]) if found else default))


def slice_page(text: Column, offset: int, limit: int) -> dict[str, Column]:
    """Columns of a page: offset, returned_characters, total_characters, has_more, next_offset, text."""
    total = F.length(text)
    start = F.least(F.lit(max(0, offset)), total)
    end = F.least(start + limit, total)
    return {
        "offset": start, "returned_characters": end - start, "total_characters": total, "has_more": end < total,
        "next_offset": F.when(end < total, end), "text": F.substring(text, start + 1, end - start),
    }


def url_path(path: str) -> str:
    """A path with each of its parts percent-encoded for a URL."""
    return "/".join(quote(part, safe="!~*'()") for part in path.replace("\\", "/").split("/"))


def url_path_of(path: Column) -> Column:
    """`url_path` of a column."""
    kept = {"+": "%20", "%21": "!", "%7E": "~", "%27": "'", "%28": "(", "%29": ")"}

    def encoded(part: Column) -> Column:
        out = F.url_encode(part)
        for given, wanted in kept.items():
            out = F.replace(out, F.lit(given), F.lit(wanted))
        return out

    return F.array_join(F.transform(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), encoded), "/")
