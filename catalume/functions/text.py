"""Scalar functions on catalog texts, URLs and formats, as Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

LEFT, RIGHT = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
# Patterns by granularity, the first that is found counts.
GRANULARITY = (
    ("comune", rf"{LEFT}comun[ei]{RIGHT}|{LEFT}municip"),
    ("provincia", rf"{LEFT}provinc"),
    ("regione", rf"{LEFT}region[ei]{RIGHT}|piemonte|lombardia|veneto|emilia|toscana|lazio|campania|puglia|sicilia|sardegna|abruzzo|umbria|marche|molise|calabria|basilicata|friuli|trentin|liguria|valle d['\s]aosta"),
    ("nazionale", rf"{LEFT}(nazional[ei]|itali[ae]|nazione|national|regional){RIGHT}"),
    ("europeo", rf"{LEFT}(europe[ao]|ue|europa|european){RIGHT}"),
)
UNKNOWN = "non_determinato"
#: Without one of these, a pattern is not found: so most texts need no pattern at all.
STEMS = {
    "comune": ("comun", "municip"),
    "provincia": ("provinc",),
    "regione": ("region", "piemonte", "lombardia", "veneto", "emilia", "toscana", "lazio", "campania", "puglia", "sicilia", "sardegna", "abruzzo", "umbria", "marche", "molise", "calabria", "basilicata", "friuli", "trentin", "liguria", "valle d"),
    "nazionale": ("nazional", "itali", "nazione", "national", "regional"),
    "europeo": ("europ", "ue"),
}
CKAN_ACTIONS = ("package_list", "package_search", "package_show", "current_package_list_with_resources")
SAFE_IN_PATH = r"[A-Za-z0-9_.~/:@!$&'()*+,;=-]"


def given(c: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(c, F.lit(""))


def first_given(*columns: Column) -> Column:
    return F.coalesce(*map(given, columns))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), where value is computed once however often f uses it."""
    return F.element_at(F.transform(F.array(value), f), 1)


def granularity(text: Column) -> Column:
    def of_lower(low: Column) -> Column:
        out = F.when(F.lit(False), None)
        for name, pattern in GRANULARITY:
            hint = reduce(lambda a, b: a | b, [low.contains(x) for x in STEMS[name]])
            out = out.when(hint & low.rlike(pattern), name)
        return out.otherwise(UNKNOWN)

    return bound(F.lower(text), of_lower)


def years(text: Column) -> Column:
    """Numbers from 1900 to 1999 and from 2000 to 2029 that touch no other digit."""
    runs = F.filter(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), lambda x: x.rlike(r"^(19\d{2}|20[012]\d)$"))
    return F.transform(runs, lambda x: x.cast("int"))


def year_min(text: Column) -> Column:
    return F.array_min(years(text))


def year_max(text: Column) -> Column:
    return F.array_max(years(text))


def strip_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def ckan_api_base(url: Column) -> Column:
    plain = strip_query(url)
    host = F.regexp_extract(plain, r"^([a-z]+://[^/]*)", 1)
    path = F.substring(plain, F.char_length(host) + 1, F.char_length(plain))
    out = F.when(given(url).isNull(), None).when(path.contains("/api/3/action/"), F.concat(host, F.substring_index(path, "/api/3/action/", 1), F.lit("/api/3/action")))
    for action in CKAN_ACTIONS:
        out = out.when(path.contains(f"/{action}"), F.concat(host, F.substring_index(path, f"/{action}", 1)))
    return out.otherwise(F.concat(host, F.regexp_replace(F.regexp_replace(path, "/+$", ""), "/[^/]*$", "")))


def ckan_endpoint(url: Column, action: str) -> Column:
    plain = F.regexp_replace(strip_query(url), "/$", "")
    moved = F.concat(F.regexp_replace(plain, "/[^/]*$", ""), F.lit(f"/{action}"))
    return F.when(plain.endswith(action), plain).when(plain.contains("/api/3/action/") | F.substring_index(plain, "/", -1).isin(*CKAN_ACTIONS), moved).otherwise(plain)


def sdmx_base(url: Column) -> Column:
    return given(F.substring_index(F.regexp_replace(F.substring_index(url, "?", 1), "/+$", ""), "/dataflow/", 1))


def sdmx_root(url: Column) -> Column:
    """The root of an SDMX service: url without its query, cut at /dataflow, be it in the middle or at the end."""
    return F.regexp_replace(sdmx_base(url), "/dataflow$", "")


def sdmx_data_url(url: Column, flow: Column) -> Column:
    """Where the last observations of a flow are."""
    return F.concat(sdmx_root(url), F.lit("/data/"), flow, F.lit("?lastNObservations=1"))


def sdmx_flow_url(url: Column, flow: Column) -> Column:
    """Where a flow's annotations are: beside the last part of a listing's url, but below it if that is the agency IT1."""
    plain = F.regexp_replace(F.substring_index(url, "?", 1), "/+$", "")
    return F.concat(F.when(plain.endswith("/IT1"), plain).otherwise(F.regexp_replace(plain, "/[^/]*$", "")), F.lit("/"), flow)


def run_ts(ts: Column) -> Column:
    """ts to the second, as runs are stamped."""
    return F.date_trunc("second", ts)


def parse_int(text: Column) -> Column:
    return text.try_cast("int")


def uri_name(uri: Column) -> Column:
    plain = F.regexp_replace(uri, "/+$", "")
    last = F.when(plain.contains("#"), F.substring_index(plain, "#", -1)).otherwise(F.substring_index(plain, "/", -1))
    return F.coalesce(given(last), uri)


def norm_format(value: Column) -> Column:
    return F.upper(F.when(value.contains(".") & (F.char_length(value) > 6), F.substring_index(value, ".", -1)).otherwise(value))


def signed(n: Column) -> Column:
    return F.concat(F.when(n > 0, "+").otherwise(""), n.cast("string"))


def quote_path(url: Column) -> Column:
    """url with the characters of its path that are not safe in one percent-encoded, as UTF-8."""
    host = F.regexp_extract(url, r"^([a-z]+://[^/?#]*)", 1)
    rest = F.substring(url, F.char_length(host) + 1, F.char_length(url))
    path, tail = F.regexp_extract(rest, r"^[^?#]*", 0), F.regexp_extract(rest, r"[?#].*$", 0)
    coded = F.transform(F.split(path, ""), lambda c: F.when(c.rlike(SAFE_IN_PATH) | (c == ""), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")))
    return F.concat(host, F.array_join(coded, ""), tail)
