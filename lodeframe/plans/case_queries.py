"""Scalar functions over the customer table: inputs picked from short lists by key; the SQL works the result out anew, or, for a few parsers, lists it.

Each list is also a test by itself: the expected values beside the inputs must be what both engines give.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodeframe.functions import config as C
from lodeframe.functions import scalars as S
from lodeframe.functions import stats
from lodeframe.plans.queries import ORACLE, QUERIES, table


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v)


def _quoted(words) -> str:
    return ", ".join(_lit(w) for w in words)


def _any(text: str, words) -> str:
    return " OR ".join(f"contains({text}, {_lit(w)})" for w in words)


def _either(text: str, words) -> str:
    return " OR ".join(f"contains({text}, {_lit(w)}) OR contains({_lit(w)}, {text})" for w in words)


def _first(text: str, table, otherwise: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {_any(text, words)} THEN {_lit(label)}" for label, words in table) + f" ELSE {otherwise} END"


def _map(text: str, table, otherwise: str = "NULL") -> str:
    return f"CASE {text} " + " ".join(f"WHEN {_lit(k)} THEN {_lit(v)}" for k, v in table.items()) + f" ELSE {otherwise} END"


def _ladder(value: str, how: str, steps) -> str:
    return f"CASE WHEN {value} IS NULL THEN 'N/A' " + " ".join(f"WHEN {value} {how} {x} THEN '{g}'" for x, g in steps) + " ELSE 'F' END"


_U, _L, _T, _OTHER = "upper(trim(a0))", "lower(a0)", "trim(a0)", _lit(C.OTHER_COLO)
_NORM = lambda c: _map(f"lower(trim({c}))", C.COMPANY_VARIATIONS, f"lower(trim({c}))")
_UP15 = lambda c, n: f"substr(coalesce(regexp_replace(upper({c}), '[^A-Z0-9]+', '', 'g'), ''), 1, {n})"
_TOP = "greatest(coalesce(a0, 0), coalesce(a1, 0))"
_GAP = "(coalesce(a0, 0) - coalesce(a1, 0))"
_PCT = f"(CASE WHEN {_TOP} > 0 THEN abs({_GAP}) / {_TOP} * 100 ELSE 0 END)"
_CANON = {n.lower(): k for k, names in C.COMPANY_NAMES.items() for n in names}
#: The functions once more, over the inputs a0, a1, ... of a row.
SQL = {
    "scal_05_slug_hyphen": r"coalesce(trim(regexp_replace(replace(lower(trim(a0)), '&', ' and '), '[^a-z0-9]+', '-', 'g'), '-'), '')",
    "scal_06_slug_word": r"coalesce(trim(regexp_replace(regexp_replace(lower(trim(a0)), '[^\w\s-]', '', 'g'), '[-\s]+', '-', 'g'), '-'), '')",
    "scal_15_filter": f"CASE WHEN a0 IN ({_quoted(C.FILTER_HYPERSCALERS)}) THEN a0 ELSE {_OTHER} END",
    "scal_16_filter_substring": "CASE " + " ".join(f"WHEN {_either(_U, [h.upper()])} THEN {_lit(h)}" for h in C.HYPERSCALERS) + f" ELSE {_OTHER} END",
    "scal_17_tier": f"CASE WHEN coalesce(a0, '') = '' THEN 'other' WHEN {_either(_U, [h.upper() for h in C.HYPERSCALERS])} THEN 'hyperscaler' WHEN {_either(_U, [h.upper() for h in C.MAJOR_COLO])} THEN 'major_colo' ELSE 'other' END",
    "scal_18_tier_contains": f"CASE WHEN {_any(_U, [h.upper() for h in C.HYPERSCALERS])} THEN 'hyperscaler' WHEN {_any(_U, [h.upper() for h in C.MAJOR_COLO])} THEN 'major_colo' ELSE 'other' END",
    "scal_19_alias": f"CASE WHEN coalesce(a0, '') = '' THEN NULL ELSE coalesce({_first('lower(trim(a0))', C.MATCH_ALIASES)}, trim(replace(replace(translate(lower(trim(a0)), ',.', ''), ' inc', ''), ' llc', ''))) END",
    "scal_24_parent": _first(_L, C.PARENT_ALIASES), "scal_24_developer": _first(_L, C.DEVELOPER_ALIASES),
    "scal_25_status_category": _first("lower(trim(a0))", C.STATUS_CATEGORIES, "'Unknown'"),
    "scal_26_granularity": "coalesce(" + ", ".join(f"CASE WHEN contains(lower({c}), 'campus') THEN 'Campus' WHEN contains(lower({c}), 'building') THEN 'Building' WHEN {_any(f'lower({c})', ('suite', 'unit', 'cage'))} THEN 'Suite' END" for c in ("a0", "a1")) + ", 'Unknown')",
    "scal_27_company_match": f"coalesce(a0 <> '' AND a1 <> '' AND ({_NORM('a0')}) = ({_NORM('a1')}), false)",
    "scal_28_safe_double": "try_cast(trim(a0) AS DOUBLE)", "scal_29_safe_text": "CASE WHEN trim(a0) NOT IN ('', 'nan', 'None') THEN substr(trim(a0), 1, 3) END",
    "scal_30_cost": "CASE WHEN trim(a0) NOT IN ('', 'None', 'NULL') THEN try_cast(replace(regexp_replace(a0, '[^0-9,.]', '', 'g'), ',', '') AS DOUBLE) END",
    "scal_31_square_feet": "CASE WHEN trim(a0) IN ('', 'None', 'NULL', '0') THEN NULL WHEN contains(upper(a0), 'M') THEN try_cast(regexp_replace(a0, '[^0-9.]', '', 'g') AS DOUBLE) * 1000000 ELSE try_cast(replace(trim(a0), ',', '') AS DOUBLE) END",
    "scal_32_organisation": r"CASE WHEN coalesce(a0, '') = '' THEN 'Unknown' ELSE coalesce(CASE WHEN contains(split_part(a0, '|', 1), 'Meta') THEN 'Meta' WHEN contains(split_part(a0, '|', 1), 'Oracle') THEN 'Oracle' WHEN contains(split_part(a0, '|', 1), 'OpenAI') THEN 'OpenAI' END, trim(regexp_replace(trim(split_part(a0, '|', 1)), '\s*\([^)]*\)', '', 'g'))) END",
    "scal_34_map_name": "CASE WHEN contains(a0, ' - Building') THEN trim(split_part(a0, ' - Building', 1)) WHEN suffix(trim(a0), ' Campus') THEN trim(left(trim(a0), -7)) WHEN suffix(trim(a0), ' Data Center') THEN trim(left(trim(a0), -12)) WHEN trim(a0) <> '' THEN trim(a0) END",
    "scal_38_year_end": "CASE WHEN try_cast(a0 AS DOUBLE) > 1900 THEN floor(try_cast(a0 AS DOUBLE))::INT || '-12-31' END",
    "scal_39_quarter": r"coalesce(2000 + try_cast(nullif(regexp_extract(upper(trim(a0)), '^Q\d(\d{2})$', 1), '') AS INT), try_cast(nullif(regexp_extract(upper(trim(a0)), '^Q\d(\d{4})$', 1), '') AS INT), try_cast(nullif(regexp_extract(upper(trim(a0)), '^PRE-(\d+)$', 1), '') AS INT), 1999)",
    "scal_44_price_per_acre": "CASE WHEN a1 > 0 THEN round(a0 / a1, 2) END",
    "scal_46_country_region": _map("a0", C.COUNTRY_REGION), "scal_49_state_code": f"CASE WHEN length(trim(a0)) = 2 THEN upper(trim(a0)) ELSE {_map('trim(a0)', C.US_STATES)} END",
    "scal_50_region_name": f"coalesce({_map('trim(a0)', C.REGION_NAMES)}, {_map('(' + _map('trim(a1)', C.COUNTRIES, 'trim(a1)') + ')', C.COUNTRY_REGION)})",
    "scal_52_owner_filter": f"coalesce({_first(_L, C.OWNER_KEYWORDS)}, {_map('a1', C.OWNER_TYPES)}, {_OTHER})", "scal_53_developer_filter": _first(_L, C.DEVELOPER_KEYWORDS, _OTHER),
    "scal_54_clean_id": "replace(replace(a0, 'or:data_center:', ''), ':', '_')",
    "scal_56_parcel_id": f"concat_ws('_', 'ACRES', {_UP15('a0', 8)}, {_UP15('a1', 2)}, {_UP15('a2', 8)}, lpad(a3::VARCHAR, 4, '0'))",
    "scal_57_cluster_label": "concat_ws('|', split_part(a0, '-', 1), CASE WHEN len(string_split(a0, '-')) > 2 THEN array_to_string(string_split(a0, '-')[2:len(string_split(a0, '-')) - 1], '-') END)",
    "scal_59_notes": "nullif(concat_ws(' | ', CASE WHEN trim(a0) <> '' THEN 'Onsite: ' || a0 || ' MW' END, CASE WHEN trim(a1) <> '' THEN 'Precision: ' || a1 END), '')",
    "scal_61_heat": "CASE WHEN a0 = 0 THEN 'heat-0' WHEN a0 < 1 THEN 'heat-1' WHEN a0 < 2 THEN 'heat-2' WHEN a0 < 4 THEN 'heat-3' WHEN a0 < 6 THEN 'heat-4' ELSE 'heat-5' END",
    "scal_62_flag": "CASE WHEN a0 IS NULL THEN 'unknown' WHEN a0 > 10 THEN 'fail' WHEN a0 > 7 THEN 'warn' ELSE 'pass' END",
    "scal_63_owned": "CASE WHEN contains(lower(a0), 'own') THEN 'Owned' WHEN contains(lower(a0), 'lease') OR contains(lower(a0), 'colo') THEN 'Leased' ELSE a0 END",
    "scal_64_direction": "CASE WHEN abs(a1) > abs(a0) THEN CASE WHEN a1 > 0 THEN 'EAST' ELSE 'WEST' END ELSE CASE WHEN a0 > 0 THEN 'NORTH' ELSE 'SOUTH' END END",
    "scal_65_hyperscaler_only": f"CASE WHEN ({_map('lower(trim(a0))', _CANON)}) IN ({_quoted(C.FILTER_HYPERSCALERS)}) THEN ({_map('lower(trim(a0))', _CANON)}) ELSE {_OTHER} END",
    "scal_66_fixed_company": "CASE WHEN a0 = 'Mortenson' THEN 'Meta' ELSE a0 END", "scal_67_fixed_region": _map("a0", C.REGION_REPAIRS, "a0"), "scal_69_backfill": "coalesce(a0, a1)",
    "pred_05_scope_company": "CASE WHEN a0 <> '' THEN CASE " + " ".join(f"WHEN {_either('lower(trim(a0))', [a.lower() for a in names])} THEN {_lit(k)}" for k, names in C.SCOPE_ALIASES) + " ELSE trim(a0) END END",
    "stat_13_grade": _ladder("a0", "<=", stats.GRADE_ERROR), "stat_14_grade_strict": _ladder("a0", "<", stats.GRADE_ERROR_STRICT), "stat_15_grade_health": _ladder("a0", ">=", stats.GRADE_HEALTH),
    "stat_16_grade_score": _ladder("a0", ">=", stats.GRADE_SCORE), "stat_17_grade_consensus": _ladder("a0", ">=", stats.GRADE_CONSENSUS), "stat_18_grade_population": _ladder("a0", ">=", stats.GRADE_POPULATION),
    "stat_21_spatial_score": "coalesce(a0, 0) * 0.5::DOUBLE + CASE WHEN a1 > 0 THEN least(100, greatest(0, 100 - a1 / 100)) ELSE 0 END * 0.5::DOUBLE",
    "stat_25_delta": f"concat_ws('|', {_GAP}::DOUBLE::VARCHAR, {_PCT}::DOUBLE::VARCHAR, ({_PCT} >= 20 OR abs({_GAP}) >= 10)::VARCHAR)",
}
#: (name, inputs, expected, function, kinds): the lists, for tests.
LISTS: list[tuple] = []


def cases(name: str, inputs: Sequence[tuple], kinds: str, expected: Sequence, kind: str, function: Callable[..., Column]) -> None:
    """Registers a query that applies function to the inputs, one tuple per customer key modulo their number."""

    def run(spark, sf):
        kind_of = [{"s": "string", "d": "double", "i": "int"}[k] for k in kinds]
        rows = F.array(*(F.struct(*(F.lit(v).cast(t).alias(f"a{j}") for j, (v, t) in enumerate(zip(row, kind_of, strict=True)))) for row in inputs))
        df = table(spark, sf, "customer").select("c_custkey", F.get(rows, (F.col("c_custkey") % len(inputs)).cast("int")).alias("a")).select("c_custkey", "a.*")
        return df.select("c_custkey", function(*(F.col(f"a{j}") for j in range(len(kinds)))).alias("result"))

    QUERIES[name] = run
    LISTS.append((name, inputs, expected, function, kinds))
    own = SQL.get(name)
    if own is None:
        ORACLE[name] = f"SELECT c_custkey, (CASE c_custkey % {len(inputs)} " + " ".join(f"WHEN {i} THEN {_lit(e)}" for i, e in enumerate(expected)) + f" END)::{kind} AS result FROM customer"
        return
    types = {"s": "VARCHAR", "d": "DOUBLE", "i": "INTEGER"}
    rows = ", ".join("(" + ", ".join([str(i), *(f"{_lit(v)}::{types[k]}" for v, k in zip(row, kinds, strict=True))]) + ")" for i, row in enumerate(inputs))
    ORACLE[name] = f"SELECT c_custkey, ({own})::{kind} AS result FROM customer JOIN (VALUES {rows}) v(i, {', '.join(f'a{j}' for j in range(len(kinds)))}) ON c_custkey % {len(inputs)} = i"


def table_of(name: str, pairs: Sequence[tuple], function: Callable[..., Column], kinds: str = "s", kind: str = "VARCHAR") -> None:
    """cases() with (input..., expected) rows."""
    cases(name, [p[:-1] for p in pairs], kinds, [p[-1] for p in pairs], kind, function)


table_of("scal_05_slug_hyphen", [("A & B  Co.", "a-and-b-co"), (None, ""), ("--x--", "x"), ("R&D 7", "r-and-d-7")], S.slug_hyphen)
table_of("scal_06_slug_word", [("Project: X -- 7!", "project-x-7"), ("a_b c", "a_b-c"), (None, "")], S.slug_word)
table_of("scal_12_strip_company", [("AWS - Abu Dhabi", "Abu Dhabi"), ("Foo", "Foo"), ("Acme Two", "Two"), ("Acme", "Acme"), ("Google-North", "North"), (None, None)], lambda c: S.without_company(c, F.lit("Acme")))
table_of("scal_15_filter", [("AWS", "AWS"), ("Equinix", C.OTHER_COLO), (None, C.OTHER_COLO)], S.company_filter)
table_of("scal_16_filter_substring", [("Amazon AWS", "AWS"), ("g", "Google"), ("Zzz", C.OTHER_COLO), ("oracle america", "Oracle"), (None, C.OTHER_COLO)], S.filter_by_substring)
table_of("scal_17_tier", [("Google LLC", "hyperscaler"), ("Equinix, Inc.", "major_colo"), ("Acme Works", "other"), (None, "other"), ("", "other")], S.company_tier)
table_of("scal_18_tier_contains", [("Google LLC", "hyperscaler"), ("stack", "major_colo"), ("G", "other")], S.company_tier_contains)
table_of("scal_19_alias", [("Amazon Web Services", "aws"), ("Digital Realty Trust", "digital realty"), ("Acme, Inc.", "acme"), ("Foo LLC", "foo"), (None, None)], S.alias_company)
table_of("scal_21_name_similarity", [("Foo Data Center", "foo", 1.0), ("Foo North", "foo", 0.8), ("a b c", "b c d", 0.5), ("", "x", 0.0), ("AWS - Bar", "bar", 1.0)], S.name_similarity, "ss", "DOUBLE")
table_of("scal_22_holding_name", [("Acme Holdings, LLC", "acme"), ("Foo (Virginia) Properties Inc.", "foo va"), (None, ""), ("North Carolina Land Co", "nc")], S.holding_name)
table_of("scal_23_fuzzy_score", [("Acme LLC", "ACME, Inc.", 100.0), ("Acme Bar", "Acme", 80.0), ("a b c", "b c d", 50.0), (None, "x", 0.0)], S.fuzzy_score, "ss", "DOUBLE")
table_of("scal_24_parent", [("Amazon Data Services", "AWS"), ("Facebook", "META"), ("Acme", None)], S.parent_company)
table_of("scal_24_developer", [("Digital Realty Trust", "Digital Realty"), ("QTS Richmond", "Qts"), ("Acme", None)], S.developer_company)
table_of("scal_25_status_category", [("Operational now", "Active"), ("Under Construction", "Under Construction"), ("Proposed", "Planned"), ("On Hold", "Cancelled"), ("x", "Unknown"), (None, "Unknown")], S.status_category)
table_of("scal_26_granularity", [("Campus A", "Building", "Campus"), (None, "building", "Building"), ("cage 3", None, "Suite"), ("x", "y", "Unknown")], S.granularity, "ss")
table_of("scal_27_company_match", [("Amazon", "aws", True), ("Meta Platforms", "Facebook", True), ("a", "b", False), (None, "b", False)], S.same_company, "ss", "BOOLEAN")
table_of("scal_28_safe_double", [("1.5", 1.5), (" 2 ", 2.0), ("", None), ("abc", None), ("1,200", None)], S.safe_double, "s", "DOUBLE")
table_of("scal_29_safe_text", [(" abcdef ", "abc"), ("nan", None), ("", None), (None, None)], lambda c: S.safe_text(c, 3))
table_of("scal_30_cost", [("USD 800M", 800.0), ("USD 10,000M", 10000.0), ("None", None), (None, None)], S.cost_millions, "s", "DOUBLE")
table_of("scal_31_square_feet", [("715,000", 715000.0), ("4.00M", 4000000.0), ("0", None), ("x", None)], S.square_feet, "s", "DOUBLE")
table_of("scal_32_organisation", [("Meta (FKA Facebook)", "Meta"), ("Oracle | OpenAI", "Oracle"), ("Acme (FKA B) | C", "Acme"), (None, "Unknown")], S.first_organisation)
table_of("scal_33_city", [("Cheyenne, Wyoming, United States of America (city)", None, "Cheyenne"), ("Foo Data Center, Aiken County, South Carolina, USA", None, "South Carolina"), (None, "Polk County", "Polk"), ("Lebanon, IN 46052, USA", None, "IN 46052")], S.city_of_location, "ss")
table_of("scal_34_map_name", [("X - Building 3", "X"), ("X Campus", "X"), ("X Data Center", "X"), ("X", "X"), (None, None)], S.map_campus_name)
table_of("scal_35_routing", [("Operational", 5.0, "5.0||"), ("Land Banked", 5.0, "||5.0"), ("Under Construction", 2.5, "|2.5|"), ("x", 5.0, "||")], lambda s, m: F.concat_ws("|", *(F.coalesce(S.routed(s, m)[k].cast("string"), F.lit("")) for k in ("commissioned", "uc", "planned"))), "sd")
table_of("scal_38_year_end", [("2015", "2015-12-31"), ("1900", None), ("x", None)], lambda c: F.date_format(S.year_end(c), "yyyy-MM-dd"))
table_of("scal_39_quarter", [("Q116", 2016), ("Q42024", 2024), ("pre-2013", 2013), ("x", 1999), (None, 1999)], lambda c: S.quarter_year(c, F.lit(1999)), "s", "INTEGER")
table_of("scal_44_price_per_acre", [(100.0, 8.0, 12.5), (100.0, 0.0, None), (None, 3.0, None), (10.0, 3.0, 3.33)], S.price_per_acre, "dd", "DOUBLE")
table_of("scal_45_land_owner", [("AWS", "AMAZON DATA", None, "hyperscaler"), ("Google", "VANTAGE LLC", None, "developer"), ("Google", None, "Alphabet Inc", "hyperscaler"), ("Google", "x", "y", "unknown"), (None, "AWS", None, "unknown")], S.land_owner, "sss")
table_of("scal_46_country_region", [("Japan", "APAC"), ("UK", "EMEA"), ("Peru", "AMER"), ("Atlantis", None)], S.country_region)
table_of("scal_47_geography", [("USA", None, "TX", None, "AMER|Texas|TX"), ("Japan", "", None, "CA", "APAC|California|CA"), (None, None, "Texas", "", "|Texas|TX")], lambda c, r, s, a: F.concat_ws("|", *(F.coalesce(x, F.lit("")) for x in S.repaired_geography(c, r, s, a).values())), "ssss")
table_of("scal_49_state_code", [("va", "VA"), ("Texas", "TX"), ("Ontario", None), (None, None)], S.state_code)
table_of("scal_50_region_name", [("NorthAmerica", None, "AMER"), ("x", "USA", "AMER"), (None, "Japan", "APAC"), (None, None, None)], S.region_name, "ss")
table_of("scal_52_owner_filter", [("Amazon Data", "Wholesale", "AWS"), (None, "Enterprise", "Enterprise"), ("Acme", "x", C.OTHER_COLO), ("IBM Cloud", None, "IBM")], S.owner_filter, "ss")
table_of("scal_53_developer_filter", [("Tencent Ltd", "Tencent"), ("Acme", C.OTHER_COLO), (None, C.OTHER_COLO)], S.developer_filter)
table_of("scal_54_clean_id", [("or:data_center:7:a", "7_a"), ("x:y", "x_y"), (None, None)], lambda c: S.clean_id(c, "or:data_center:"))
table_of("scal_55_entity", [("AMAZON_DATA_CENTERS", "AWS"), ("Google Data Centers", "Google"), ("foo data", "AWS"), ("QQQ_ZZ", "Qqq Zz"), (None, "Unknown")], S.entity_company)
table_of("scal_56_parcel_id", [("Iron Mountain", "VA", "Loudoun Co", 7, "ACRES_IRONMOUN_VA_LOUDOUNC_0007"), ("A", None, "x", 12345, "ACRES_A__X_1234")], S.parcel_campus_id, "sssi")
table_of("scal_57_cluster_label", [("Acme-Foo-Bar-1", "Acme|Foo-Bar"), ("Acme-1", "Acme")], lambda c: F.concat_ws("|", *S.cluster_parts(c)))
table_of("scal_59_notes", [("3", None, "Onsite: 3 MW"), ("3", "x", "Onsite: 3 MW | Precision: x"), (None, None, None)], lambda a, b: S.notes(("Onsite: ", a, " MW"), ("Precision: ", b, "")), "ss")
table_of("scal_60_json_list", [("['a', 'b']", 2), ("[]", 0), ("x", None)], S.json_list_size, "s", "INTEGER")
table_of("scal_61_heat", [(0.0, "heat-0"), (0.5, "heat-1"), (1.0, "heat-2"), (3.9, "heat-3"), (4.0, "heat-4"), (6.0, "heat-5")], S.heat_band, "d")
table_of("scal_62_flag", [(None, "unknown"), (11.0, "fail"), (8.0, "warn"), (7.0, "pass")], lambda c: S.quality_flag(c, 10.0), "d")
table_of("scal_63_owned", [("Company Owned", "Owned"), ("Colo", "Leased"), ("x", "x"), (None, None)], S.owned_leased)
table_of("scal_65_hyperscaler_only", [("Amazon", "AWS"), ("DLR", C.OTHER_COLO), (None, C.OTHER_COLO)], S.hyperscaler_only)
table_of("scal_66_fixed_company", [("Mortenson", "Meta"), ("x", "x")], S.fixed_company)
table_of("scal_67_fixed_region", [("Middle East", "EMEA"), ("Pacific", "APAC"), ("x", "x"), (None, None)], S.fixed_region)
table_of("scal_69_backfill", [(1.0, 2.0, 1.0), (None, 2.0, 2.0)], S.backfilled, "dd", "DOUBLE")
table_of("scal_64_direction", [(1.0, 0.2, "NORTH"), (-1.0, 0.2, "SOUTH"), (0.1, 2.0, "EAST"), (0.1, -2.0, "WEST")], lambda a, b: S.direction(a, b, F.lit(0.0), F.lit(0.0)), "dd")
table_of("pred_05_scope_company", [("Amazon", "AWS"), ("MSFT", "Microsoft"), ("Acme", "Acme"), (None, None)], S.scope_company)
table_of("stat_13_grade", [(10.0, "A"), (20.0, "B"), (35.1, "D"), (51.0, "F"), (None, "N/A")], stats.grade_up_to, "d")
table_of("stat_14_grade_strict", [(14.9, "A"), (15.0, "B"), (40.0, "D"), (60.0, "F")], stats.grade_below, "d")
table_of("stat_15_grade_health", [(90.0, "A"), (79.0, "C"), (59.0, "F")], lambda c: stats.grade_from(c, stats.GRADE_HEALTH), "d")
table_of("stat_16_grade_score", [(80.0, "A"), (64.9, "C"), (34.0, "F")], stats.grade_from, "d")
table_of("stat_17_grade_consensus", [(75.0, "A"), (54.0, "C"), (20.0, "D")], lambda c: stats.grade_from(c, stats.GRADE_CONSENSUS), "d")
table_of("stat_18_grade_population", [(95.0, "A"), (60.0, "C"), (39.0, "F")], lambda c: stats.grade_from(c, stats.GRADE_POPULATION), "d")
table_of("stat_21_spatial_score", [(50.0, 1000.0, 70.0), (100.0, 20000.0, 50.0), (80.0, None, 40.0), (0.0, 0.0, 0.0)], stats.spatial_score, "dd", "DOUBLE")
table_of("stat_25_delta", [(100.0, 80.0, "20.0|20.0|true"), (5.0, 5.0, "0.0|0.0|false"), (None, 4.0, "-4.0|100.0|true"), (0.0, None, "0.0|0.0|false")], lambda a, b: F.concat_ws("|", *(x.cast("string") for x in stats.delta(a, b).values())), "dd")
