"""Column functions: distances, slugs, keys, names, companies, geography, dates, parsers.

All are built-in expressions, so they stay inside whole-stage code. Vocabularies are literal maps of
a few dozen entries.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodeframe.functions import config as C

Col = Column | str


def col(c: Col) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Col) -> Column:
    return F.trim(col(c)) == ""


def filled(c: Col) -> Column:
    """Not null and not blank."""
    return col(c).isNotNull() & ~blank(c)


def look_up(c: Col, table: Mapping[str, object]) -> Column:
    """Value for a key; null if there is none."""
    return F.element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), col(c))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def first_keyword(text: Column, table: Iterable[tuple[str, Sequence[str]]]) -> Column:
    """Label of the first entry with a word contained in text; null if there is none."""
    return F.coalesce(*(F.when(contains_any(text, words), F.lit(label)) for label, words in table))


def either_contains(a: Column, b: Column) -> Column:
    return a.contains(b) | b.contains(a)


# --- distances


def haversine(lat1: Col, lon1: Col, lat2: Col, lon2: Col) -> Column:
    """Great-circle metres; null if any part is null.

    Operations stand in the order of the SQL twins (differences before radians, plain squares), so that
    both engines give the same last bit and agree on which of two like distances is less.
    """
    half = lambda a, b: F.sin(F.radians(col(b) - col(a)) / 2)
    y, x = half(lat1, lat2), half(lon1, lon2)
    h = y * y + F.cos(F.radians(col(lat1))) * F.cos(F.radians(col(lat2))) * (x * x)
    return F.lit(2 * C.EARTH_RADIUS_M) * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def planar_degrees(lat1: Col, lon1: Col, lat2: Col, lon2: Col) -> Column:
    return F.sqrt(F.pow(col(lat2) - col(lat1), F.lit(2.0)) + F.pow(col(lon2) - col(lon1), F.lit(2.0)))


# --- slugs and keys


def slug_plain(c: Col) -> Column:
    """Lower case, letters and digits only; null as empty."""
    return F.coalesce(F.regexp_replace(F.lower(col(c)), "[^a-z0-9]+", ""), F.lit(""))


def slug_hyphen(c: Col) -> Column:
    """Lower case, & as and, other signs as single hyphens."""
    s = F.replace(F.lower(F.trim(col(c))), F.lit("&"), F.lit(" and "))
    return F.coalesce(F.btrim(F.regexp_replace(s, "[^a-z0-9]+", "-"), F.lit("-")), F.lit(""))


def slug_word(c: Col) -> Column:
    """Lower case, word characters kept in any script, spaces and hyphens as single hyphens."""
    s = F.regexp_replace(F.trim(F.lower(col(c))), r"(?U)[^\w\s-]", "")
    return F.coalesce(F.btrim(F.regexp_replace(s, r"(?U)[-\s]+", "-"), F.lit("-")), F.lit(""))


def slug_upper(c: Col) -> Column:
    return F.coalesce(F.regexp_replace(F.upper(col(c)), "[^A-Z0-9]+", ""), F.lit(""))


def _number_text(x: Column, places: int) -> Column:
    return F.round(x.cast("double"), places).cast("string")


def campus_key_plain(company: Col, city: Col, name: Col, lat: Col, lon: Col) -> Column:
    """company|city|name; rounded coordinates, n for minus, where there is no name."""
    place = F.translate(F.concat(_number_text(col(lat), 3), _number_text(col(lon), 3)), "-.", "n")
    return F.concat_ws("|", slug_plain(company), slug_plain(city), F.when(col(name).isNotNull() & (col(name) != ""), slug_plain(name)).otherwise(place))


def campus_key_hyphen(company: Col, city: Col, name: Col, lat: Col, lon: Col) -> Column:
    place = slug_hyphen(F.concat(_number_text(col(lat), 4), F.lit(","), _number_text(col(lon), 4)))
    own = slug_hyphen(name)
    return F.concat_ws("|", slug_hyphen(company), slug_hyphen(city), F.when(own != "", own).when(place != "", place).otherwise("unknown"))


def campus_key_code(company: str, code: Col, region: Col) -> Column:
    named = lambda c: F.when(filled(c), slug_plain(c)).otherwise("unknown")
    return F.concat_ws("|", F.lit(company), named(region), named(code))


def parcel_campus_id(company: Col, state: Col, county: Col, number: Col) -> Column:
    part = lambda c, n: F.substring(F.coalesce(slug_upper(c), F.lit("")), 1, n)
    return F.concat_ws("_", F.lit("ACRES"), part(company, 8), part(state, 2), part(county, 8), F.lpad(col(number).cast("string"), 4, "0"))


def clean_id(c: Col, prefix: str) -> Column:
    return F.replace(F.replace(col(c), F.lit(prefix), F.lit("")), F.lit(":"), F.lit("_"))


# --- safe casts


def safe_double(c: Col, drop: str = "") -> Column:
    """Number in text, null where there is none; characters in drop are deleted first."""
    s = F.trim(F.translate(col(c).cast("string"), drop, "")) if drop else F.trim(col(c).cast("string"))
    return s.try_cast("double")


def safe_text(c: Col, length: int | None = None, nulls: Sequence[str] = ("", "nan", "None")) -> Column:
    s = F.trim(col(c).cast("string"))
    s = F.when(~s.isin(*nulls), s)
    return F.substring(s, 1, length) if length else s


def zero(c: Col) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


# --- companies


def company_code(c: Col) -> Column:
    """Short code: by name, by lower-cased name, else the first four letters or digits, UNK without any."""
    s = F.upper(F.regexp_replace(col(c), "[^A-Za-z0-9]", ""))
    lower = {k.lower(): v for k, v in reversed(C.COMPANY_CODES.items())}
    made = F.when(s != "", F.substring(s, 1, 4))
    return F.coalesce(F.when(col(c) != "", F.coalesce(look_up(c, C.COMPANY_CODES), look_up(F.lower(col(c)), lower), made)), F.lit("UNK"))


def without_company(name: Col, company: Col) -> Column:
    """Name without the company before it; a known company before a separator goes too."""
    n, co = col(name), F.lower(col(company))
    rest = F.trim(F.substring(n, F.length(co) + 1, F.length(n)))
    known = F.array(*(F.lit(k.lower()) for k in C.COMPANY_CODES))

    def cut(sep: str) -> Column:
        head, tail = F.lower(F.substring_index(n, sep, 1)), F.substring(n, F.instr(n, sep) + len(sep), F.length(n))
        return F.when((F.instr(n, sep) > 0) & ((head == co) | F.array_contains(known, head)), F.trim(tail))

    out = F.coalesce(F.when(F.lower(n).startswith(co) & (rest != ""), rest), cut(" - "), cut("-"), cut(" "), n)
    return F.when((n == "") | co.isNull() | (co == ""), n).otherwise(out)


def canonical_company(c: Col) -> Column:
    """Canonical name of the first known of |-separated companies, a name before ( counting too; else the first as it is."""
    exact = {n: k for k, names in C.COMPANY_NAMES.items() for n in names}
    lower = {n.lower(): k for n, k in exact.items()}

    def known(s: Column) -> Column:
        base = F.trim(F.substring_index(s, "(", 1))
        return F.coalesce(look_up(s, exact), look_up(F.lower(s), lower), look_up(base, exact), look_up(F.lower(base), lower))

    parts = F.transform(F.split(F.trim(col(c)), r"\|"), lambda p: F.trim(p))
    return F.when(col(c) != "", F.coalesce(F.get(F.filter(F.transform(parts, known), lambda x: x.isNotNull()), F.lit(0)), F.get(parts, F.lit(0))))


def company_filter(c: Col) -> Column:
    return F.when(col(c).isin(*C.FILTER_HYPERSCALERS), col(c)).otherwise(C.OTHER_COLO)


def hyperscaler_only(c: Col) -> Column:
    """Canonical name of a hyperscaler, else the common label."""
    return company_filter(canonical_company(c))


def filter_by_substring(c: Col, least: int = 1) -> Column:
    """Hyperscaler whose name contains, or is contained in, the company's; short names match much, so least may be raised."""
    s = F.upper(F.trim(col(c)))
    named = F.coalesce(*(F.when(either_contains(s, F.lit(h.upper())), F.lit(h)) for h in C.HYPERSCALERS))
    return F.coalesce(F.when(F.length(s) >= least, named), F.lit(C.OTHER_COLO))


def company_tier(c: Col, least: int = 1) -> Column:
    s = F.upper(F.trim(col(c)))
    hit = lambda names: F.exists(F.array(*(F.lit(n.upper()) for n in names)), lambda n: either_contains(s, n))
    return F.when((F.length(s) < least) | s.isNull() | (col(c) == ""), "other").when(hit(C.HYPERSCALERS), "hyperscaler").when(hit(C.MAJOR_COLO), "major_colo").otherwise("other")


def company_tier_contains(c: Col) -> Column:
    s = F.upper(F.trim(col(c)))
    hit = lambda names: contains_any(s, (n.upper() for n in names))
    return F.when(hit(C.HYPERSCALERS), "hyperscaler").when(hit(C.MAJOR_COLO), "major_colo").otherwise("other")


def alias_company(c: Col) -> Column:
    s = F.lower(F.trim(col(c)))
    rest = F.translate(s, ",.", "")
    for word in (" inc", " llc"):
        rest = F.replace(rest, F.lit(word), F.lit(""))
    return F.when(col(c) != "", F.coalesce(first_keyword(s, C.MATCH_ALIASES), F.trim(rest)))


def intake_company(c: Col) -> Column:
    return F.when(col(c) != "", F.coalesce(look_up(F.lower(F.trim(col(c))), C.INTAKE_NAMES), col(c)))


def same_company(a: Col, b: Col) -> Column:
    """Equal after trimming, lower-casing and the variation map; a blank side matches nothing."""
    norm = lambda c: F.coalesce(look_up(F.lower(F.trim(col(c))), C.COMPANY_VARIATIONS), F.lower(F.trim(col(c))))
    return F.coalesce((col(a) != "") & (col(b) != "") & (norm(a) == norm(b)), F.lit(False))


def parent_company(c: Col) -> Column:
    return first_keyword(F.lower(col(c)), C.PARENT_ALIASES)


def developer_company(c: Col) -> Column:
    return first_keyword(F.lower(col(c)), C.DEVELOPER_ALIASES)


def owner_filter(owner: Col, owner_type: Col) -> Column:
    return F.coalesce(first_keyword(F.lower(col(owner)), C.OWNER_KEYWORDS), look_up(owner_type, C.OWNER_TYPES), F.lit(C.OTHER_COLO))


def developer_filter(c: Col) -> Column:
    return F.coalesce(first_keyword(F.lower(col(c)), C.DEVELOPER_KEYWORDS), F.lit(C.OTHER_COLO))


def scope_company(c: Col) -> Column:
    s = F.trim(col(c))
    named = F.coalesce(*(F.when(F.exists(F.array(*(F.lit(a.lower()) for a in names)), lambda a: either_contains(F.lower(s), a)), F.lit(k)) for k, names in C.SCOPE_ALIASES))
    return F.when(col(c) != "", F.coalesce(named, s))


def entity_company(c: Col) -> Column:
    """Company of a parcel entity: contained either way, then a shared word of over three letters, else its own name in title case."""
    s = F.replace(F.upper(F.trim(col(c))), F.lit(" "), F.lit("_"))
    direct = F.coalesce(*(F.when(either_contains(s, F.lit(k)), F.lit(v)) for k, v in C.ENTITIES))
    shared = F.coalesce(*(F.when(contains_any(s, [w for w in k.split("_") if len(w) > 3]), F.lit(v)) for k, v in C.ENTITIES))
    return F.when(~(col(c) != "") | col(c).isNull(), "Unknown").otherwise(F.coalesce(direct, shared, F.initcap(F.replace(F.trim(col(c)), F.lit("_"), F.lit(" ")))))


def holding_name(c: Col) -> Column:
    """Lower case without signs and suffix words, states abbreviated; empty for null."""
    s = F.regexp_replace(F.lower(F.trim(col(c))), r"""[,.'"/\\()_-]""", " ")
    words = F.filter(F.split(F.trim(F.regexp_replace(s, r"\s+", " ")), " "), lambda w: ~w.isin(*C.HOLDING_SUFFIXES))
    s = F.array_join(words, " ")
    for name, short in C.HOLDING_STATES:
        s = F.replace(s, F.lit(name), F.lit(short))
    return F.coalesce(F.trim(s), F.lit(""))


# --- names


def _tokens(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.trim(F.lower(c)), r"\s+"), lambda w: w != ""))


def token_similarity(a: Col, b: Col) -> Column:
    """Jaccard of white-space tokens, 1 for equal texts, 0 if a side is missing."""
    x, y = F.lower(F.trim(col(a))), F.lower(F.trim(col(b)))
    t, u = _tokens(col(a)), _tokens(col(b))
    part = F.size(F.array_intersect(t, u)) / F.size(F.array_union(t, u))
    missing = col(a).isNull() | col(b).isNull() | (col(a) == "") | (col(b) == "")
    return F.when(missing, 0.0).when(x == y, 1.0).when((F.size(t) == 0) | (F.size(u) == 0), 0.0).otherwise(part)


def name_similarity(a: Col, b: Col) -> Column:
    """1 for equal site names, 0.8 if one contains the other, else Jaccard of tokens; site words and companies before it don't count."""

    def clean(c: Col) -> Column:
        s = F.trim(F.lower(col(c)))
        for word in C.SITE_SUFFIXES:
            s = F.replace(s, F.lit(word), F.lit(""))
        for word in C.SITE_PREFIXES:  # each names s once, so the expression grows by one step per prefix
            s = F.regexp_replace(s, f"^{word}", "")
        return F.trim(s)

    x, y = clean(a), clean(b)
    missing = x.isNull() | y.isNull() | (x == "") | (y == "")
    return F.when(missing, 0.0).when(x == y, 1.0).when(either_contains(x, y), 0.8).otherwise(token_similarity(x, y))


def fuzzy_score(a: Col, b: Col) -> Column:
    """0..100 over holding names: 100 if equal, at least 80 if one contains the other, else Jaccard."""
    x, y = holding_name(a), holding_name(b)
    missing = col(a).isNull() | col(b).isNull() | (col(a) == "") | (col(b) == "")
    part = token_similarity(x, y) * 100
    return F.when(missing, 0.0).when(x == y, 100.0).when((x == "") | (y == ""), 0.0).when(either_contains(x, y), F.greatest(part, F.lit(80.0))).otherwise(part)


def first_organisation(c: Col) -> Column:
    """First of |-separated organisations, three of them by keyword, without what is in parentheses."""
    first = F.trim(F.substring_index(col(c), "|", 1))
    plain = F.trim(F.regexp_replace(first, r"\s*\([^)]*\)", ""))
    named = F.coalesce(*(F.when(first.contains(k), F.lit(k)) for k in ("Meta", "Oracle", "OpenAI")))
    return F.when(col(c).isNull() | (col(c) == ""), "Unknown").otherwise(F.coalesce(named, plain))


def city_of_location(location: Col, county: Col) -> Column:
    """City in a location text: the part with a state code, else the first part, or the second after a site's name."""
    parts = F.transform(F.split(F.regexp_replace(col(location), r"\s*\([^)]*\)", ""), ","), lambda p: F.trim(p))
    parts = F.filter(parts, lambda p: ~p.isin("United States of America", "USA") & ~p.contains("County") & ~p.contains("Parish"))
    coded = F.get(F.filter(parts, lambda p: p.rlike(r"\b[A-Z]{2}\b")), F.lit(0))
    head, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    site = contains_any(F.lower(head), ("data center", "meta", "oracle"))
    of_county = F.replace(F.replace(col(county), F.lit(" County"), F.lit("")), F.lit(" Parish"), F.lit(""))
    picked = F.coalesce(coded, F.when((F.size(parts) >= 2) & site, second), head, of_county)
    return F.when(col(location).isNull() | (col(location) == ""), of_county).otherwise(picked)


def map_campus_name(name: Col) -> Column:
    n = F.trim(col(name))
    head = F.trim(F.substring_index(n, " - Building", 1))
    return F.when(n.contains(" - Building"), head).when(n.endswith(" Campus"), F.trim(F.substring(n, F.lit(1), F.length(n) - 7))).when(
        n.endswith(" Data Center"), F.trim(F.substring(n, F.lit(1), F.length(n) - 12))
    ).when(n != "", n)


def map_building(name: Col) -> Column:
    n = F.trim(col(name))
    return F.when(n.contains(" - Building"), F.concat(F.lit("Building"), F.trim(F.get(F.split(n, " - Building"), F.lit(1)))))


def cluster_parts(c: Col) -> tuple[Column, Column]:
    """(company, city) of a cluster label company-city...-number: first part, and what lies between it and the last."""
    p = F.split(col(c), "-")
    middle = F.array_join(F.slice(p, 2, F.greatest(F.size(p) - 2, F.lit(0))), "-")
    return F.get(p, F.lit(0)), F.when(F.size(p) > 2, middle)


# --- parsers


def cost_millions(c: Col) -> Column:
    s = F.replace(F.regexp_replace(col(c), r"[^\d,.]", ""), F.lit(","), F.lit(""))
    return F.when(~F.trim(col(c)).isin("", "None", "NULL"), s.try_cast("double"))


def square_feet(c: Col) -> Column:
    s = F.trim(col(c))
    million = F.regexp_replace(s, r"[^\d.]", "").try_cast("double") * 1_000_000
    return F.when(s.isin("", "None", "NULL", "0"), None).when(F.upper(s).contains("M"), million).otherwise(F.replace(s, F.lit(","), F.lit("")).try_cast("double"))


def fiber_note(c: Col) -> Column:
    """A short provider list as it is; the number of providers of a long one, or that there are several."""
    n = F.size(F.from_json(F.replace(col(c), F.lit("'"), F.lit('"')), "array<string>"))
    return F.when(F.length(col(c)) <= 100, F.concat(F.lit("Fiber: "), col(c))).when(
        n >= 0, F.concat(F.lit("Fiber: "), n.cast("string"), F.lit(" providers"))
    ).when(col(c).isNotNull(), "Fiber: Multiple providers")


def json_list_size(c: Col) -> Column:
    return F.nullif(F.size(F.from_json(F.replace(col(c), F.lit("'"), F.lit('"')), "array<string>")), F.lit(-1))


def notes(*labelled: tuple[str, Col, str], length: int | None = None) -> Column:
    """Labelled parts that are present, joined by ' | '; null if there are none. (label, value, suffix)."""
    parts = [F.when(filled(col(c).cast("string")), F.concat(F.lit(label), col(c).cast("string"), F.lit(suffix))) for label, c, suffix in labelled]
    out = F.nullif(F.concat_ws(" | ", *parts), F.lit(""))
    return F.substring(out, 1, length) if length else out


_FORMATS = {"%Y": "yyyy", "%m": "M", "%d": "d"}


def any_date(c: Col, formats: Sequence[str]) -> Column:
    """Timestamp by the first format that fits the whole text."""
    s = F.trim(col(c))
    return F.coalesce(*(F.try_to_timestamp(s, F.lit("".join(_FORMATS.get(p, p) for p in _pieces(f)))) for f in formats))


def _pieces(f: str) -> list[str]:
    return [f[i : i + 2] if f[i] == "%" else f[i] for i in range(len(f)) if i == 0 or f[i - 1] != "%"]


GRID_DATES = ("%Y-%m-%d", "%m/%d/%Y", "%Y/%m/%d", "%d/%m/%Y", "%Y")
MILESTONE_DATES = ("%m/%d/%Y", "%Y-%m-%d", "%Y/%m/%d", "%d/%m/%Y", "%m/%Y", "%Y")


def year_end(year: Col) -> Column:
    y = F.floor(safe_double(year)).cast("int")
    return F.when(y > 1900, F.make_date(y, F.lit(12), F.lit(31)).cast("timestamp"))


def quarter_year(label: Col, year: Col) -> Column:
    """Year of a label like Q116, Q42024 or pre-2013; else the year given."""
    s = F.upper(F.trim(col(label)))
    short, full, before = (F.regexp_extract(s, p, 1).try_cast("int") for p in (r"^Q\d(\d{2})$", r"^Q\d(\d{4})$", r"^PRE-(\d+)$"))
    return F.coalesce(short + 2000, full, before, col(year))


# --- geography


def state_code(state: Col) -> Column:
    s = F.trim(col(state))
    return F.when(F.length(s) == 2, F.upper(s)).otherwise(look_up(s, C.US_STATES))


def split_state(state: Col, code: Col) -> tuple[Column, Column]:
    """(name, code) from a state that may be either, and a code that may be missing."""
    s, a = F.coalesce(F.trim(col(state)), F.lit("")), F.coalesce(F.trim(col(code)), F.lit(""))
    short = (F.length(s) == 2) & (F.upper(s) == s) & (F.lower(s) != s)
    exact, titled = look_up(s, C.US_STATES), look_up(F.initcap(s), C.US_STATES)
    name = F.when(short, None).when(exact.isNotNull(), s).when(titled.isNotNull(), F.initcap(s)).when(F.length(a) == 2, F.when(F.length(s) > 2, s)).otherwise(F.nullif(F.substring(s, 1, 100), F.lit("")))
    short_name = F.when(short, s).when(exact.isNotNull(), exact).when(titled.isNotNull(), titled).when(F.length(a) == 2, F.upper(a)).otherwise(F.nullif(F.substring(a, 1, 10), F.lit("")))
    return name, short_name


def country_name(c: Col) -> Column:
    s = F.trim(col(c))
    return F.when(col(c) != "", F.coalesce(look_up(s, C.COUNTRIES), s))


def country_region(c: Col) -> Column:
    return look_up(c, C.COUNTRY_REGION)


def region_name(region: Col, country: Col) -> Column:
    return F.coalesce(look_up(F.trim(col(region)), C.REGION_NAMES), country_region(country_name(country)))


def super_region(c: Col) -> Column:
    return F.coalesce(look_up(F.trim(col(c)), C.SUPER_REGIONS), F.lit("AMER"))


def region_of_point(lat: Col, lon: Col) -> Column:
    y, x = col(lat), col(lon)
    return (
        F.when(y.isNull() | x.isNull() | F.isnan(y) | F.isnan(x) | ((y == 0) & (x == 0)), "UNKNOWN").when((F.abs(y) > 90) | (F.abs(x) > 180), "INVALID")
        .when(x.between(-180, -30), "AMER").when(x.between(-25, 65), F.when(y.between(-35, 75), "EMEA").otherwise("OTHER")).when((x > 65) & (x <= 180), "APAC").otherwise("OTHER")
    )


def repaired_geography(country: Col, region: Col, state: Col, code: Col) -> dict[str, Column]:
    """region, state, state_abbr after the four repairs, each of which sees the original values."""
    names = {v: k for k, v in C.US_STATES.items()}
    s, a, up = col(state), col(code), F.upper(col(state))
    no = lambda c: c.isNull() | (c == "")
    moved = F.when(F.length(s) <= 3, look_up(up, names))
    return {
        "region": F.when(no(col(region)), F.coalesce(country_region(country), col(region))).otherwise(col(region)),
        "state": F.coalesce(F.when(~no(s), moved), F.when(no(s), F.coalesce(look_up(a, names), s)), s),
        "state_abbr": F.when(no(a), F.coalesce(F.when(moved.isNotNull() & ~no(s), up), look_up(s, C.US_STATES), a)).otherwise(a),
    }


def valid_point(lat: Col, lon: Col, island: float = 0.1) -> Column:
    """In range and not at the origin, within island degrees."""
    y, x = col(lat), col(lon)
    return F.coalesce((F.abs(y) <= 90) & (F.abs(x) <= 180) & ~((F.abs(y) < island) & (F.abs(x) < island)), F.lit(False))


def truthy_point(lat: Col, lon: Col) -> Column:
    """Neither null nor zero."""
    return F.coalesce((col(lat) != 0) & (col(lon) != 0), F.lit(False))


# --- status and capacity


def stage_status(stage: Col, table: Iterable[tuple[str, str]] = C.STATUS_STAGE) -> Column:
    s = F.lower(F.trim(col(stage)))
    return F.coalesce(*(F.when(s.contains(k), F.lit(v)) for k, v in table), F.lit("Unknown"))


def routed(stage: Col, mw: Col) -> dict[str, Column]:
    """One capacity put under commissioned, under construction or planned, by stage; null elsewhere."""
    s = F.lower(F.coalesce(col(stage), F.lit("")))
    live, building = s.contains("operational"), s.contains("under construction")
    planned = s.contains("planned") | s.contains("land banked")
    there = F.when(col(mw) != 0, col(mw))
    return {"commissioned": F.when(live, there), "uc": F.when(~live & building, there), "planned": F.when(~live & ~building & planned, there)}


def status_of_capacity(installed: Col, building: Col, planned: Col) -> Column:
    return F.when(zero(installed) > 0, "Active").when(zero(building) > 0, "Under Construction").when(zero(planned) > 0, "Announced").otherwise("Unknown")


def status_rank(c: Col) -> Column:
    return F.coalesce(look_up(c, C.STATUS_RANK), F.lit(7))


def rank_status(c: Col) -> Column:
    return F.coalesce(look_up(col(c).cast("int"), {v: k for k, v in C.STATUS_RANK.items()}), F.lit("Unknown"))


def status_category(c: Col) -> Column:
    s = F.lower(F.trim(col(c)))
    return F.coalesce(first_keyword(s, C.STATUS_CATEGORIES), F.lit("Unknown"))


def granularity(designation: Col, level: Col) -> Column:
    def of(c: Col) -> Column:
        s = F.lower(col(c))
        return F.when(s.contains("campus"), "Campus").when(s.contains("building"), "Building").when(contains_any(s, ("suite", "unit", "cage")), "Suite")

    return F.coalesce(of(designation), of(level), F.lit("Unknown"))


def owned_leased(c: Col) -> Column:
    s = F.lower(col(c))
    return F.when(s.contains("own"), "Owned").when(s.contains("lease") | s.contains("colo"), "Leased").otherwise(col(c))


def first_mw_year(years: Sequence[int] = tuple(range(2023, 2033)), prefix: str = "mw_") -> Column:
    return F.coalesce(*(F.when(F.col(f"{prefix}{y}") > 0, F.lit(y)) for y in years))


def first_mw_date(month: int = 1, years: Sequence[int] = tuple(range(2023, 2033)), fallback: Column | None = None) -> Column:
    made = F.make_date(first_mw_year(years), F.lit(month), F.lit(1))
    return F.coalesce(made, fallback) if fallback is not None else made


def lag(start: Col, end: Col) -> dict[str, Column]:
    days = F.datediff(col(end), col(start))
    return {"days": days, "months": F.round(days / 30.44, 1), "years": F.round(days / 365.25, 2)}


def price_per_acre(amount: Col, acres: Col) -> Column:
    return F.when(col(acres) > 0, F.round(col(amount) / col(acres), 2))


def land_owner(company: Col, entity: Col, buyer: Col) -> Column:
    """hyperscaler, developer or unknown: by the entity's name, then the buyer's."""
    own = F.coalesce(look_up_array(company, C.LAND_OWNERS), F.array(F.upper(col(company))))

    def of(c: Col) -> Column:
        s = F.upper(col(c))
        return F.when(F.exists(own, lambda k: s.contains(k)), "hyperscaler").when(contains_any(s, C.LAND_DEVELOPERS), "developer")

    return F.coalesce(F.when(col(company) != "", F.coalesce(of(entity), of(buyer))), F.lit("unknown"))


def look_up_array(c: Col, table: Mapping[str, Sequence[str]]) -> Column:
    return F.element_at(F.create_map(*(x for k, v in table.items() for x in (F.lit(k), F.array(*map(F.lit, v))))), col(c))


def pue_adjusted(source: Col, field: str, value: Col, table: Mapping[str, float | None] = C.PUE_FACTORS) -> Column:
    """Value divided by the source's factor, where it has one and the field is adjusted."""
    factors = {s: f for s, f in table.items() if f}
    if field not in C.PUE_FIELDS or not factors:
        return col(value)
    return col(value) / F.coalesce(look_up(source, factors), F.lit(1.0))


def quality_flag(value: Col, threshold: float, above: bool = True) -> Column:
    """unknown, fail, warn (within 30 % of the threshold) or pass, of a value that should stay below (above=True) or over it."""
    v = col(value)
    bad, near = (v > threshold, v > threshold * 0.7) if above else (v < threshold, v < threshold * 1.3)
    return F.when(v.isNull(), "unknown").when(bad, "fail").when(near, "warn").otherwise("pass")


def heat_band(hours: Col) -> Column:
    h = col(hours)
    return F.when(h == 0, "heat-0").when(h < 1, "heat-1").when(h < 2, "heat-2").when(h < 4, "heat-3").when(h < 6, "heat-4").otherwise("heat-5")


# --- stored-row repairs


def fixed_company(c: Col) -> Column:
    return F.when(col(c) == "Mortenson", "Meta").otherwise(col(c))


def fixed_region(c: Col) -> Column:
    return F.coalesce(look_up(c, C.REGION_REPAIRS), col(c))


def backfilled(value: Col, geometry: Col) -> Column:
    return F.coalesce(col(value), col(geometry))


def direction(lat: Col, lon: Col, mid_lat: Col, mid_lon: Col) -> Column:
    """Side of a point seen from a centre, along the axis with the larger gap."""
    dy, dx = col(lat) - col(mid_lat), col(lon) - col(mid_lon)
    return F.when(F.abs(dx) > F.abs(dy), F.when(dx > 0, "EAST").otherwise("WEST")).otherwise(F.when(dy > 0, "NORTH").otherwise("SOUTH"))
