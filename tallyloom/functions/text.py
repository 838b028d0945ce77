"""Names, labels and headers as pure column expressions; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of parameters that hold credentials, in their normalised form.
SECRETS = ("apikey", "authorization", "authkey", "servicekey")
#: What may not stand in a file name, and the longest name in bytes.
FORBIDDEN = r"""[\\/:*?"<>|\x00-\x1f]+"""
MOST_BYTES = 240
SUFFIX = r"\.[A-Za-z0-9]{1,10}$"
ZIP_MAGIC = "504B0304"
#: A parameter of a header: its name, and its value, quoted or up to the next semicolon.
_PARAMETER = r'([\w-]+\*?)\s*=\s*("[^"]*"?|[^;"]*)'


def local_tag(name: Column) -> Column:
    """An element name without its namespace."""
    return F.regexp_replace(name, r"^.*\}", "")


def normalize_label(text: Column) -> Column:
    """White space collapsed, outer white space and closing colons removed."""
    flat = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.trim(F.regexp_replace(flat, r":+$", ""))


def normalized_key(key: Column) -> Column:
    """A parameter name in lower case without anything but letters and digits, to recognise secrets."""
    return F.regexp_replace(F.lower(key), r"[^\p{L}\p{N}]", "")


def safe_params(params: Column, secrets: tuple[str, ...] = SECRETS) -> Column:
    """A map of parameters without the ones whose name is a secret's."""
    return F.map_filter(params, lambda k, _: ~normalized_key(k).isin(*secrets))


def _fitting(text: Column, budget: Column) -> Column:
    """The longest start of ``text`` of at most ``budget`` bytes that ends between characters."""
    start = F.struct(F.lit(0).alias("bytes"), F.lit(0).alias("chars"), F.lit(True).alias("open"))

    def step(done: Column, char: Column) -> Column:
        size = done["bytes"] + F.octet_length(char)
        fits = done["open"] & (size <= budget)
        return F.struct(F.when(fits, size).otherwise(done["bytes"]).alias("bytes"), F.when(fits, done["chars"] + 1).otherwise(done["chars"]).alias("chars"), fits.alias("open"))

    count = F.aggregate(F.split(text, ""), start, step, lambda done: done["chars"])
    return F.substring(text, F.lit(1), count)


def fit_bytes(name: Column, most: int = MOST_BYTES) -> Column:
    """``name`` cut to ``most`` UTF-8 bytes between characters; a short suffix stays, blanks and dots before it go."""
    suffix = F.regexp_extract(name, SUFFIX, 0)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(suffix))
    cut = F.concat(F.rtrim(_fitting(stem, F.lit(most) - F.octet_length(suffix)), F.lit(" .")), suffix)
    return F.when(F.octet_length(name) <= most, name).otherwise(cut)


def clean_component(name: Column, fallback: str = "unnamed", most: int = MOST_BYTES) -> Column:
    """A name that is safe as one part of a path; an empty or null one becomes ``fallback``."""
    if most < 16:
        raise ValueError("most must be at least 16")
    cleaned = F.btrim(F.regexp_replace(name, FORBIDDEN, "_"), F.lit(" ."))
    return fit_bytes(F.coalesce(F.nullif(cleaned, F.lit("")), F.lit(fallback)), most)


def _percent_decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def disposition_name(header: Column, fallback: str = "unnamed") -> Column:
    """The file name that a Content-Disposition header announces, cleaned.

    The extended form comes first; the plain one may be percent-encoded, or UTF-8 read as Latin-1.
    """
    names = F.transform(F.regexp_extract_all(header, F.lit(_PARAMETER), 1), F.lower)
    values = F.regexp_extract_all(header, F.lit(_PARAMETER), 2)
    parameters = F.arrays_zip(names.alias("name"), values.alias("value"))
    first = lambda name: F.get(F.filter(parameters, lambda p: p["name"] == name), F.lit(0))["value"]
    coded = F.coalesce(first("filename*"), F.lit(""))
    extended = F.when(F.lower(F.substring_index(coded, "'", 1)) == "utf-8", F.regexp_replace(coded, r"^[^']*'[^']*'", "")).otherwise(F.lit(""))
    plain = F.regexp_replace(F.coalesce(first("filename"), F.lit("")), r'^"|"$', "")
    narrow = plain.rlike(r"^[\x00-\xff]*$")
    data = F.encode(F.when(narrow, plain).otherwise(F.lit("")), "ISO-8859-1")
    repaired = F.when(narrow & F.is_valid_utf8(data.cast("string")), F.decode(data, "UTF-8")).otherwise(plain)
    name = F.when(extended != "", _percent_decoded(extended)).when(plain == "", F.lit(None)).when(plain.rlike("%[0-9A-Fa-f]{2}"), _percent_decoded(plain)).otherwise(repaired)
    return clean_component(name, fallback)


def looks_like_html(content: Column, content_type: Column | None = None) -> Column:
    """Whether a text or its declared type is HTML, judged by the first 512 characters."""
    head = F.lower(F.ltrim(F.regexp_replace(F.substring(content, 1, 512), r"^\s+", "")))
    sniffed = F.coalesce(head.startswith("<!doctype html") | head.startswith("<html"), F.lit(False))
    return sniffed if content_type is None else sniffed | F.coalesce(F.contains(F.lower(content_type), F.lit("html")), F.lit(False))


def is_zip(content: Column) -> Column:
    """Whether binary content starts as a ZIP archive does."""
    return F.substring(content, 1, 4) == F.unhex(F.lit(ZIP_MAGIC))


def year_of_name(name: Column) -> Column:
    """The year that a file name starts with: four digits from 2000 on, or two digits and 년; else null."""
    full = F.regexp_extract(name, r"^(20\d{2})", 1)
    short = F.regexp_extract(name, r"^(\d{2})년", 1)
    return F.when(full != "", full.try_cast("int")).when(short != "", short.try_cast("int") + 2000)


def call_arguments(text: Column, function: str, count: int = 4) -> Column:
    """The quoted arguments of the first call of ``function`` in a text; null without such a call."""
    quoted = r"\s*,\s*".join([r"'([^']*)'"] * count)
    pattern = rf"{function}\(\s*{quoted}\s*\)"
    return F.when(text.rlike(pattern), F.array(*(F.regexp_extract(text, pattern, n + 1) for n in range(count))))


def url_problem(url: Column) -> Column:
    """Why an endpoint address is not acceptable, or null: it must be http(s) with a host, without user, query and fragment."""
    return (
        F.when(F.coalesce(url, F.lit("")) == "", "empty")
        .when(~url.rlike(r"^(?i)https?://[^/?#]+"), "not http")
        .when(url.rlike(r"^[^/]+//[^/?#]*@"), "user information")
        .when(F.contains(url, F.lit("?")), "query")
        .when(F.contains(url, F.lit("#")), "fragment")
    )


def ratio(condition: Column) -> Column:
    """Aggregate: ``n/m``, the rows that meet a condition among all."""
    return F.concat(F.count_if(condition).cast("string"), F.lit("/"), F.count("*").cast("string"))
