"""SQL for an independent engine, one statement per registered query.

Written stage by stage from the rules' definitions, with joins and windows where the Spark code uses
aggregates, so that an agreement means something.
"""

from __future__ import annotations

from sievewright.contracts import FINANCIALS, SALES
from sievewright.fixtures import FINANCIALS_RAW_SQL, SALES_RAW_SQL

# Fixed values, stated here once more: what the rules are compared with must not come from the rules.
VALID_REGIONS = ("North", "South", "East", "West", "Central")
STREAM_TYPO_DICTIONARY = {"Region": ("North", "South", "East", "West"), "Payment_Method": ("Cash", "Card", "Online")}
REPORT_NULL_TOKENS = ("", "NULL", "null", "none", "NaN", "nan", "Nan", "NA", "N/A", "n/a", "na")
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null", "none", "Nan")
CURRENCY_SIGNS = "€£$¥₱₩₦₭₮₨₹₡₢₫₲₴₵₸₺₼₾₿"
REPLACEMENT_CHARACTER = "\ufffd"
INVISIBLE_CHARACTERS = {
    "\ufeff": "BOM/zero-width no-break space", "\u200b": "zero-width space", "\u200c": "zero-width non-joiner", "\u200d": "zero-width joiner",
    "\u2060": "word joiner", "\u202e": "right-to-left override", "\u202a": "left-to-right embedding", "\u202b": "right-to-left embedding",
    "\u00a0": "non-breaking space",
}
SPECIAL_CHARACTERS = REPLACEMENT_CHARACTER + "".join(INVISIBLE_CHARACTERS)
SUSPICIOUS_PATTERN = r"[^a-zA-Z0-9\s.,;:!?()\-_/]"
DATE_PATTERN = (
    r"^(\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])|(0[1-9]|[12]\d|3[01])-(0[1-9]|1[0-2])-\d{4}|(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])-\d{4}"
    r"|\d{4}/(0[1-9]|[12]\d|3[01])/(0[1-9]|1[0-2])|(0[1-9]|[12]\d|3[01])/(0[1-9]|1[0-2])/\d{4}|(0[1-9]|1[0-2])/(0[1-9]|[12]\d|3[01])/\d{4}|\d{8})$")

RUN_TS = "2024-01-31T00:00:00"
S = SALES.fieldNames()
S_TEXT = ["Customer_Name", "Region", "Product", "Payment_Method"]
S_INT = ["Order_ID", "Quantity", "Unit_Price", "Total_Amount"]
FN = FINANCIALS.fieldNames()
F_TEXT = [f.name for f in FINANCIALS.fields if f.dataType.simpleString() == "string"]
F_INT = [f.name for f in FINANCIALS.fields if f.dataType.simpleString() == "bigint"]
F_NUM = [f.name for f in FINANCIALS.fields if f.dataType.simpleString() in ("bigint", "double")]
RAW = f"raw AS ({SALES_RAW_SQL})"
FRAW = f"raw AS ({FINANCIALS_RAW_SQL.replace('`', chr(34))})"


def q(name: str) -> str:
    return f'"{name}"'


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cols(names, fn=q) -> str:
    return ", ".join(fn(n) for n in names)


def each(names, fn) -> str:
    """``fn(column) AS column`` for all names."""
    return ", ".join(f"{fn(q(n))} AS {q(n)}" for n in names)


def tokens(values) -> str:
    return "(" + ", ".join(lit(v) for v in sorted(set(values))) + ")"


def either(conditions) -> str:
    return "(" + " OR ".join(f"coalesce({c}, false)" for c in conditions) + ")"


# --- scalar rules -------------------------------------------------------------------------------

def tidy(c: str) -> str:
    return f"regexp_replace(trim({c}, ' '), '\\s+', ' ', 'g')"


def initcap(c: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({c}), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def title(c: str) -> str:
    return f"CASE WHEN lower(trim({c}, ' ')) NOT IN ('', 'null', 'none', 'nan') THEN {initcap(tidy(c))} END"


def title_letters(c: str) -> str:
    pieces = f"regexp_extract_all(lower({tidy(c)}), '\\p{{L}}+|[^\\p{{L}}]+')"
    cased = f"array_to_string(list_transform({pieces}, lambda w: upper(w[1]) || w[2:]), '')"
    return (f"CASE WHEN {tidy(c)} NOT IN ('', 'NULL', 'null', 'none', 'NaN', 'nan', 'Nan') THEN {cased} END")


def upper_id(c: str) -> str:
    return f"CASE WHEN lower(trim({c}, ' ')) NOT IN ('', 'null', 'none', 'nan') THEN upper({tidy(c)}) END"


def blank(c: str) -> str:
    return f"CASE WHEN trim({c}, ' ') <> '' THEN {c} END"


def currency(c: str) -> str:
    return f"trim(regexp_replace({c}, '[{CURRENCY_SIGNS},]', '', 'g'), ' ')"


def null_token(c: str) -> str:
    return f"lower(trim({c}, ' ')) IN {tokens(t.lower() for t in REPORT_NULL_TOKENS)}"


def shown(c: str) -> str:
    return f"CASE WHEN NOT {null_token(c)} THEN {c} END"


def first_date(c: str, shapes) -> str:
    tries = ", ".join(
        f"CASE WHEN regexp_matches({c}, '{p}') THEN CAST(try_strptime({c}, '{f}') AS DATE) END" for p, f in shapes)
    return f"coalesce({tries})"


def parse_multi(c: str) -> str:
    return first_date(c, [
        (r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d"), (r"^\d{2}-\d{2}-\d{4}$", "%d-%m-%Y"),
        (r"^\d{2}-\d{2}-\d{4}$", "%m-%d-%Y"), (r"^\d{4}/\d{2}/\d{2}$", "%Y/%m/%d"),
        (r"^\d{2}/\d{2}/\d{4}$", "%d/%m/%Y"), (r"^\d{2}/\d{2}/\d{4}$", "%m/%d/%Y"), (r"^\d{8}$", "%Y%m%d")])


def parse_strict(c: str) -> str:
    return first_date(f"trim({c}, ' ')", [
        (r"^\d{4}-\d{1,2}-\d{1,2}$", "%Y-%m-%d"), (r"^\d{1,2}/\d{1,2}/\d{4}$", "%m/%d/%Y"),
        (r"^\d{1,2}/\d{1,2}/\d{4}$", "%d/%m/%Y"), (r"^\d{4}/\d{1,2}/\d{1,2}$", "%Y/%m/%d"),
        (r"^\d{1,2}-\d{1,2}-\d{4}$", "%d-%m-%Y"), (r"^\d{1,2}-\d{1,2}-\d{4}$", "%m-%d-%Y")])


def parse_permissive(c: str) -> str:
    dotted = first_date(f"trim({c}, ' ')", [(r"^\d{4}\.\d{1,2}\.\d{1,2}$", "%Y.%m.%d")])
    return f"coalesce({parse_strict(c)}, {dotted})"


def to_int(c: str, kind: str = "INT") -> str:
    return f"CASE WHEN regexp_matches({c}, '^[+-]?\\d+$') THEN try_cast({c} AS {kind}) END"


def to_double(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') THEN try_cast({c} AS DOUBLE) END"


def convert(name: str, c: str) -> str:
    if name in S_INT:
        return to_int(c)
    return parse_multi(c) if name == "Order_Date" else c


def type_bad(name: str, c: str) -> str:
    if name in S_INT:
        return f"NOT regexp_matches({c}, '^-?\\d+$')"
    if name == "Order_Date":
        return f"NOT regexp_matches({c}, '{DATE_PATTERN}')"
    return f"regexp_matches({c}, '^[0-9]+(\\.[0-9]+)?$')"


ERROR = {**{n: "INVALID_INTEGER" for n in S_INT}, **{n: "STRING_NUMERIC_MIX" for n in S_TEXT}, "Order_Date": "INVALID_DATE"}


def special(c: str) -> str:
    return f"regexp_matches({c}, '[{SPECIAL_CHARACTERS}]')"


def edge(c: str) -> str:
    return f"regexp_matches({c}, '^[^a-zA-Z0-9]|[^a-zA-Z0-9]$')"


def forbidden(c: str) -> str:
    return f"(NOT regexp_matches({c}, '^[a-zA-Z0-9\\s.,;:()_/-]+$') OR regexp_matches({c}, '\\s-|-\\s'))"


def char_bad(c: str) -> str:
    return f"({special(c)} OR {edge(c)} OR {forbidden(c)})"


def char_issue(name: str, c: str) -> str:
    return (f"CASE WHEN {special(c)} THEN {lit(f'Contains special char in {name}')} "
            f"WHEN {edge(c)} THEN {lit(f'Invalid leading/trailing char in {name}')} "
            f"WHEN {forbidden(c)} THEN {lit(f'Invalid characters in {name}')} END")


def row_issue(names) -> str:
    issues = "concat_ws(' | ', " + ", ".join(char_issue(n, q(n)) for n in names) + ")"
    note = ("CASE WHEN regexp_matches(Customer_Name, '[^\\x00-\\x7F]') "
            "THEN 'Non-ASCII character detected in Customer_Name' END")
    return f"concat_ws(' | ', {issues}, {note})"


def text_of(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


def row_hash(names) -> str:
    return "sha256(concat_ws('|', " + ", ".join(text_of(q(n)) for n in names) + "))"


def json_list(pairs) -> str:
    """Names whose condition holds, as JSON text."""
    items = ", ".join(f"CASE WHEN coalesce({cond}, false) THEN {lit(n)} END" for n, cond in pairs)
    return f"CAST(to_json(list_filter([{items}], lambda x: x IS NOT NULL)) AS VARCHAR)"


def once(select: str, key: str, order) -> str:
    """One row per key: the smallest by the given columns, NULL first."""
    by = ", ".join(f"{o} NULLS FIRST" for o in order)
    return f"SELECT * FROM ({select}) QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {by}) = 1"


CLEAN = f"{RAW}, c AS MATERIALIZED (SELECT {each(S, title)} FROM raw)"
META = "'sales_raw' AS source_file"
PROJECT = "'sales_etl' AS project_name"
FMETA = "'financials_raw' AS source_file"
OLD = "old AS (SELECT CAST(o_orderkey AS INT) AS id FROM orders WHERE o_orderstatus = 'F')"


# --- rules as selects from a table of text columns ----------------------------------------------

def invalid_region(src: str) -> str:
    return once(f"""SELECT 'Invalid Region Value' AS issue, 'Region' AS column_flagged, {META}, {PROJECT},
        {row_hash(S)} AS row_hash, {cols(S)} FROM {src} WHERE Region NOT IN {tokens(VALID_REGIONS)}""",
                "row_hash", [q(n) for n in S])


def nulls(src: str, names, meta: str) -> str:
    inner = f"SELECT {each(names, shown)} FROM {src}"
    found = json_list((n, f"{q(n)} IS NULL") for n in names)
    listed = "[" + ", ".join(f"CASE WHEN {q(n)} IS NULL THEN {lit(n)} END" for n in names) + "]"
    picked = once(f"""SELECT 'Null values found' AS issue, {found} AS null_columns, {meta}, {PROJECT},
        {row_hash(names)} AS row_hash, {cols(names)},
        list_filter({listed}, lambda x: x IS NOT NULL) AS ord FROM ({inner})
        WHERE {either(f'{q(n)} IS NULL' for n in names)}""", "row_hash", ["ord", *[q(n) for n in names]])
    return f"SELECT * EXCLUDE (ord) FROM ({picked})"


def nonpositive(src: str, names, numbers, op: str, meta: str) -> str:
    def bad(n):
        return f"{to_double(q(n))} {op} 0"

    return once(f"""SELECT 'Negative values found' AS issue, {json_list((n, bad(n)) for n in numbers)} AS negative_columns,
        {meta}, {PROJECT}, {row_hash(names)} AS row_hash, {cols(names)} FROM {src}
        WHERE {either(bad(n) for n in numbers)}""", "row_hash", ["negative_columns", *[q(n) for n in names]])


def special_chars(src: str) -> str:
    values = "concat_ws(' | ', " + ", ".join(f"CASE WHEN {char_bad(q(n))} THEN {q(n)} END" for n in S) + ")"
    return once(f"""SELECT * FROM (SELECT {row_issue(S)} AS issue, {values} AS bad_value, {META},
        {row_hash(S)} AS row_hash, {cols(S)} FROM {src}) WHERE issue <> ''""",
                "row_hash", ["issue", "bad_value", *[q(n) for n in S]])


def type_rows(src: str, bad=type_bad) -> str:
    def listed(fn):
        return "concat_ws(',', " + ", ".join(f"CASE WHEN {bad(n, q(n))} THEN {fn(n)} END" for n in S) + ")"

    return f"""SELECT 'Type conversion failed' AS issue, {META}, {listed(lit)} AS dirty_columns,
        {listed(q)} AS dirty_values, {cols(S)} FROM {src} WHERE {either(bad(n, q(n)) for n in S)}"""


def type_cells(src: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {lit(n)} AS dirty_columns, {q(n)} AS dirty_values, {lit(ERROR[n])} AS error_type, {META}, {cols(S)} "
        f"FROM {src} WHERE {type_bad(n, q(n))}" for n in S)
    return f"SELECT *, {row_hash(['dirty_columns', 'dirty_values', 'error_type', 'source_file', *S])} AS row_hash FROM ({parts})"


def conflicts(src: str) -> str:
    return (f"SELECT Customer_Name FROM {src} WHERE Customer_Name IS NOT NULL GROUP BY Customer_Name "
            "HAVING count(DISTINCT Region) > 1")


def region_conflicts(src: str) -> str:
    return once(f"""SELECT 'Conflicting Region for Customer' AS issue, {META}, {row_hash(S)} AS row_hash,
        {", ".join(f'{q(n)} AS {n.lower()}' for n in S)} FROM {src}
        WHERE Customer_Name IN ({conflicts(src)})""", "row_hash", [n.lower() for n in S])


def typos(src: str, flag_valid: bool) -> str:
    parts = []
    for name, values in STREAM_TYPO_DICTIONARY.items():
        known = "" if flag_valid else f" AND lower({q(name)}) NOT IN {tokens(v.lower() for v in values)}"
        for v in values:
            parts.append(f"SELECT {cols(S)}, 'Possible typo' AS dirty_reason, {lit(name)} AS column_flagged, "
                         f"{lit(v)} AS suggested_value, {META} FROM {src} "
                         f"WHERE levenshtein(lower({q(name)}), {lit(v.lower())}) <= 2 AND lower({q(name)}) <> {lit(v.lower())}{known}")
    return " UNION ".join(parts)


def bigint(src: str) -> str:
    return once(f"""SELECT {cols(S)}, 'Order_ID' AS dirty_column, Order_ID AS dirty_value,
        'INVALID_BIGINT' AS error_type, {META}, sha256(concat_ws('|', Order_ID, 'sales_raw')) AS row_hash
        FROM {src} WHERE NOT regexp_matches(Order_ID, '^[0-9]+$') OR (Order_ID IS NOT NULL AND try_cast(Order_ID AS BIGINT) IS NULL)""",
                "row_hash", [q(n) for n in S])


def changes(src: str, cells, action: str) -> str:
    parts = " UNION ".join(
        f"SELECT {cols(S)}, {lit(n)} AS column_name, {q(n)} AS original_value, {cleaned} AS cleaned_value, "
        f"{lit(action)} AS action FROM {src} WHERE {changed}" for n, cleaned, changed in cells)
    names = [*S, "column_name", "original_value", "cleaned_value", "action"]
    return f"SELECT *, {row_hash(names)} AS row_hash FROM ({parts})"


def id_changes(src: str, ids) -> str:
    return changes(src, [(n, f"upper({tidy(q(n))})", f"{q(n)} <> upper({tidy(q(n))})") for n in ids],
                   "ID_CLEAN_AND_UPPERCASE")


def string_changes(src: str) -> str:
    return changes(src, [
        (n, initcap(tidy(q(n))), f"lower(trim({q(n)}, ' ')) <> lower(trim({initcap(tidy(q(n)))}, ' '))") for n in S
    ], "TITLE_CASE_CLEAN")


# --- the sales pipeline, stage by stage ---------------------------------------------------------

def sales_stages(reject: str = "id", chars_leave: bool = True, clean: str = "") -> str:
    """CTEs c (cleaned) ... loaded; with ids rejected by anti joins as the rules are worded."""
    survive_types = ("NOT bad AND n NOT IN (SELECT n FROM s2 WHERE bad)" if reject == "row" else
                     "(Order_ID IS NULL OR Order_ID NOT IN (SELECT Order_ID FROM s2 WHERE bad AND Order_ID IS NOT NULL))")
    typed = ", ".join(f"{convert(n, q(n))} AS {q(n)}" for n in S)
    survive_chars = "true" if not chars_leave else (
        "NOT bad" if reject == "row" else "Order_ID NOT IN (SELECT Order_ID FROM s6 WHERE bad)")
    return f"""{clean or CLEAN}, {OLD},
      s0 AS MATERIALIZED (SELECT *, row_number() OVER () AS n FROM c),
      s1 AS MATERIALIZED (SELECT * FROM s0 WHERE Region IS NULL OR Region IN {tokens(VALID_REGIONS)}),
      clash AS MATERIALIZED ({conflicts('s1')}),
      s2 AS MATERIALIZED (SELECT *, {either(type_bad(n, q(n)) for n in S)} AS bad FROM s1
             WHERE Customer_Name IS NULL OR Customer_Name NOT IN (SELECT Customer_Name FROM clash)),
      s3 AS MATERIALIZED (SELECT {typed}, {cols(S, lambda n: f'{q(n)} AS "was_{n}"')} FROM s2 WHERE {survive_types}),
      s4 AS MATERIALIZED (SELECT * REPLACE ({", ".join(f'{shown(q(n))} AS {q(n)}' for n in S_TEXT)}) FROM s3),
      s5 AS MATERIALIZED (SELECT * FROM s4 WHERE {" AND ".join(f'{q(n)} IS NOT NULL' for n in S)}),
      s6 AS MATERIALIZED (SELECT *, {either(char_bad(q(n)) for n in S_TEXT)} AS bad FROM s5
             WHERE {" AND ".join(f'{q(n)} > 0' for n in S_INT)}),
      s7 AS MATERIALIZED (SELECT {cols(S)} FROM s6 WHERE {survive_chars}),
      s8 AS MATERIALIZED (SELECT * EXCLUDE (h) FROM (SELECT *, {row_hash(S)} AS h FROM s7)
             QUALIFY row_number() OVER (PARTITION BY Order_ID ORDER BY h, {cols(S)}) = 1),
      loaded AS MATERIALIZED (SELECT * FROM s8 WHERE Order_ID NOT IN (SELECT id FROM old))"""


def quarantine_part(rule: str, select: str, flagged: str, bad_value: str = "NULL") -> str:
    return (f"SELECT {lit(rule)} AS rule, issue, CAST({flagged} AS VARCHAR) AS flagged, "
            f"CAST({bad_value} AS VARCHAR) AS bad_value, CAST(NULL AS VARCHAR) AS suggested_value, {META}, {PROJECT}, "
            f"row_hash, {cols(S, lambda n: f'CAST({q(n)} AS VARCHAR) AS {q(n)}')} FROM ({select})")


def names_where(pairs) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {cond} THEN {lit(n)} END" for n, cond in pairs) + ")"


def sales_quarantine(stream: bool = False) -> str:
    """``stream``: the number rule also sees rows that leave as null rows, and typos of the surviving rows are reported."""
    lower_first = ", ".join(f"{n.lower()} AS {q(n)}" for n in S)
    late_null = once(f"""SELECT 'Null values found' AS issue, {names_where((n, f'{q(n)} IS NULL') for n in S)} AS f,
        {row_hash(S)} AS row_hash, {cols(S)} FROM s4 WHERE {either(f'{q(n)} IS NULL' for n in S)}""",
                     "row_hash", [q("f"), *[q(n) for n in S]])
    late_low = once(f"""SELECT 'Negative values found' AS issue, {names_where((n, f'{q(n)} <= 0') for n in S_INT)} AS f,
        {row_hash(S)} AS row_hash, {cols(S)} FROM {'s4' if stream else 's5'} WHERE {either(f'{q(n)} <= 0' for n in S_INT)}""",
                    "row_hash", [q("f"), *[q(n) for n in S]])
    late_chars = once(f"""SELECT {row_issue(S_TEXT)} AS issue,
        concat_ws(' | ', {", ".join(f'CASE WHEN {char_bad(q(n))} THEN {q(n)} END' for n in S_TEXT)}) AS v,
        {row_hash(S)} AS row_hash, {cols(S)} FROM s6 WHERE bad""", "row_hash", [q(n) for n in S])
    conflict = f"SELECT issue, row_hash, {lower_first} FROM ({region_conflicts('s1')})"
    types = f"SELECT *, {row_hash(S)} AS row_hash FROM ({type_rows('s2')})"
    return " UNION ALL ".join([
        quarantine_part("invalid_region", invalid_region("c"), "'Region'"),
        quarantine_part("region_conflicts", conflict, "NULL"),
        quarantine_part("type_conversion", types, "dirty_columns", "dirty_values"),
        quarantine_part("null_values", late_null, "f"),
        quarantine_part("negative_values", late_low, "f"),
        quarantine_part("unknown_chars", late_chars, "NULL", "v"),
        *([stream_typos()] if stream else []),
    ])


def stream_typos() -> str:
    hashed = row_hash([*S, "dirty_reason", "column_flagged", "suggested_value"])
    return (f"SELECT 'typos' AS rule, dirty_reason AS issue, column_flagged AS flagged, CAST(NULL AS VARCHAR) AS bad_value, "
            f"suggested_value, source_file, {PROJECT}, {hashed} AS row_hash, {cols(S, lambda n: f'CAST({q(n)} AS VARCHAR) AS {q(n)}')} "
            f"FROM ({typos('s6', False)})")


def rule_records() -> str:
    """The quarantine again, every rule in the column order of its own table, joined by ``|``."""
    front = {
        "invalid_region": "issue, flagged, source_file, project_name, row_hash",
        "region_conflicts": "issue, source_file, row_hash",
        "type_conversion": "issue, source_file, flagged, bad_value",
        "null_values": "issue, flagged, source_file, project_name, row_hash",
        "negative_values": "issue, flagged, source_file, project_name, row_hash",
        "unknown_chars": "issue, bad_value, source_file, row_hash",
    }
    return " UNION ALL ".join(
        f"SELECT rule, concat_ws('|', {names}, {cols(S)}) AS record FROM dirty WHERE rule = {lit(rule)}"
        for rule, names in front.items())


TOPIC = (("invalid_region", "dirty-region-events"), ("region_conflicts", "dirty-region-conflicts"),
         ("type_conversion", "dirty-type-events"), ("null_values", "dirty-null-values"),
         ("negative_values", "dirty-negative-values"), ("unknown_chars", "dirty-special-chars"))


def stream_clean(raw: str = RAW) -> str:
    """The stream cleans ids as well, which title case has already made tidy."""
    names = ", ".join(f"{upper_id(title(q(n))) if n == 'Order_ID' else title(q(n))} AS {q(n)}" for n in S)
    return f"{raw}, c AS MATERIALIZED (SELECT {names} FROM raw)"


ALONE = (f"every AS MATERIALIZED ({SALES_RAW_SQL}), raw AS MATERIALIZED (SELECT * FROM every WHERE Order_ID IS NULL OR Order_ID NOT IN "
         "(SELECT Order_ID FROM every WHERE Order_ID IS NOT NULL GROUP BY Order_ID HAVING count(*) > 1))")


def late_batch(k: int) -> str:
    """The rows that micro-batch ``k`` loads: those of that batch that leave the pipeline run over all batches up to it.

    No id is in two rows, so only the conflicts of customers depend on other batches.
    """
    part = "coalesce(try_cast(Order_ID AS BIGINT) % 3, 0)"
    alone = ALONE.replace("raw AS MATERIALIZED", "alone AS MATERIALIZED")
    stages = sales_stages(chars_leave=False, clean=stream_clean(f"{alone}, raw AS MATERIALIZED (SELECT * FROM alone WHERE {part} <= {k})"))
    return f"SELECT * FROM (WITH {stages} SELECT * FROM s8 WHERE Order_ID % 3 = {k})"


# --- the financials pipeline --------------------------------------------------------------------

SPELLED = {"Twenty One": "21", "One Hundred And Five": "105"}


def spelled(c: str) -> str:
    whens = " ".join(f"WHEN lower({c}) = {lit(k.lower())} THEN {lit(v)}" for k, v in SPELLED.items())
    return f"CASE {whens} ELSE {c} END"


def financial_type_bad(name: str, c: str) -> str:
    if name == "Date":
        return f"{c} IS NOT NULL AND {parse_permissive(c)} IS NULL"
    if name in F_INT:  # exact: a double holds integers up to 2**53 only
        number = f"TRY_CAST({currency(c)} AS DECIMAL(38, 10))"
        return f"{c} IS NOT NULL AND NOT coalesce({number} = floor({number}) AND abs({number}) <= 9223372036854775807, false)"
    if name in F_NUM:
        return f"{c} IS NOT NULL AND {to_double(currency(c))} IS NULL"
    return "false"


def _columns(fn) -> str:
    return ", ".join(f"{fn(q(n)) if n in F_NUM else q(n)} AS {q(n)}" for n in FN)


PREPARED = (f"{FRAW}, t AS MATERIALIZED (SELECT {each(FN, title_letters)} FROM raw), "
            f"w AS MATERIALIZED (SELECT {_columns(spelled)} FROM t), "
            f"p AS MATERIALIZED (SELECT {_columns(currency)} FROM w)")


def doubts(name: str) -> str:
    t = f"coalesce(trim({q(name)}, ' '), '')"
    return (f"concat_ws('; ', CASE WHEN length({t}) < 3 AND {t} <> '' THEN {lit(f'Too short (<3) in {lit(name)}')} END, "
            f"CASE WHEN regexp_matches({t}, '\\s{{2,}}') THEN {lit(f'Contains double spaces in {lit(name)}')} END, "
            f"CASE WHEN regexp_matches({t}, '{SUSPICIOUS_PATTERN}') THEN {lit(f'Contains suspicious characters in {lit(name)}')} END)")


def doubtful(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT {doubts(n)} AS dirty_reason, {lit(n)} AS column_flagged, {FMETA}, {cols(FN)} FROM {src}) "
        "WHERE dirty_reason <> ''" for n in F_TEXT)


def numeric_strings(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {lit(f'Numeric string in categorical column {lit(n)}')} AS dirty_reason, {FMETA}, {cols(FN)} "
        f"FROM {src} WHERE regexp_matches({q(n)}, '^\\d+$')" for n in F_TEXT)


def special_named(c: str) -> str:
    named = {REPLACEMENT_CHARACTER: "unknown replacement char", **INVISIBLE_CHARACTERS}
    return "concat_ws(', ', " + ", ".join(
        f"CASE WHEN contains({c}, {lit(ch)}) THEN {lit(t)} END" for ch, t in named.items()) + ")"


def chars_described(src: str) -> str:
    def issue(n):
        c = q(n)
        return (f"CASE WHEN {special(c)} THEN {lit(f'Contains special char(s) in {n}: ')} || {special_named(c)} "
                f"WHEN {edge(c)} THEN {lit(f'Invalid leading/trailing character in {n}')} "
                f"WHEN {forbidden(c)} THEN {lit(f'Invalid characters in {n}')} END")

    def joined(sep, fn):
        return f"concat_ws({lit(sep)}, " + ", ".join(f"CASE WHEN {char_bad(q(n))} THEN {fn(n)} END" for n in FN) + ")"

    return f"""SELECT concat_ws(' | ', {", ".join(issue(n) for n in FN)}) AS issue, {joined(', ', lit)} AS column_flagged,
        {joined(' | ', lambda n: f"{lit(n + ': ')} || {q(n)}")} AS bad_value, {FMETA}, {cols(FN)} FROM {src}
        WHERE {either(char_bad(q(n)) for n in FN)}"""


def dirty_dates(src: str) -> str:
    t = "trim(\"Date\", ' ')"
    issue = (f"CASE WHEN lower({t}) IN ('', 'none', 'nan', 'null') THEN NULL "
             f"WHEN NOT regexp_matches({t}, '\\d') THEN 'dynamic_or_partial' "
             f"WHEN {parse_strict(q('Date'))} IS NULL THEN 'unparseable' END")
    return (f"SELECT * FROM (SELECT 'Date' AS column_flagged, {t} AS bad_date_value, {issue} AS issue, {FMETA}, "
            f"{PROJECT}, {cols(FN)} FROM {src}) WHERE issue IS NOT NULL")


def type_described(src: str) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in FINANCIALS.fields}

    def joined(sep, fn):
        return f"concat_ws({lit(sep)}, " + ", ".join(
            f"CASE WHEN {financial_type_bad(n, q(n))} THEN {lit(fn(n))} END" for n in FN if n not in F_TEXT) + ")"

    return f"""SELECT {joined(', ', str)} AS column_flagged, {joined(', ', kinds.get)} AS expected_type,
        {joined('; ', lambda n: f'{n}: Type conversion failed')} AS issue, {FMETA}, {cols(FN)} FROM {src}
        WHERE {either(financial_type_bad(n, q(n)) for n in FN)}"""


FINANCIAL_STAGES = f"""{PREPARED},
  f1 AS MATERIALIZED (SELECT * REPLACE (coalesce(CAST({parse_strict(q('Date'))} AS VARCHAR), "Date") AS "Date") FROM p),
  f2 AS MATERIALIZED (SELECT * FROM f1 WHERE NOT {either([f'{q(n)} IS NULL' for n in FN] + [null_token(q(n)) for n in FN])}),
  f3 AS MATERIALIZED (SELECT * FROM f2 WHERE NOT {either(f'{to_double(q(n))} < 0' for n in F_NUM)}),
  f4 AS MATERIALIZED (SELECT * FROM f3 WHERE NOT {either(f"regexp_matches({q(n)}, '^[0-9]+$')" for n in F_TEXT)}),
  f5 AS MATERIALIZED (SELECT * FROM f4 WHERE NOT {either(char_bad(q(n)) for n in FN)}),
  f6 AS MATERIALIZED (SELECT * FROM f5 WHERE NOT {either(f"{doubts(n)} <> ''" for n in F_TEXT)}),
  f7 AS MATERIALIZED (SELECT * FROM f6 WHERE NOT {either(financial_type_bad(n, q(n)) for n in FN)})"""


def financial_typed(n: str) -> str:
    if n == "Date":
        return f"{parse_permissive(q(n))} AS {q(n)}"
    if n in F_INT:
        return f"CAST(TRY_CAST({q(n)} AS DECIMAL(38, 10)) AS BIGINT) AS {q(n)}"
    return f"{to_double(q(n))} AS {q(n)}" if n in F_NUM else q(n)


def financial_quarantine() -> str:
    h = f"{row_hash(FN)} AS row_hash"

    def part(rule, src, issue, flagged):
        return (f"SELECT {lit(rule)} AS rule, CAST({issue} AS VARCHAR) AS issue, CAST({flagged} AS VARCHAR) AS flagged, "
                f"{h} FROM ({src})")

    shown_nulls = f"SELECT {each(FN, shown)} FROM f1 WHERE {either([f'{q(n)} IS NULL' for n in FN] + [null_token(q(n)) for n in FN])}"
    lows = f"SELECT * FROM f2 WHERE {either(f'{to_double(q(n))} < 0' for n in F_NUM)}"
    return " UNION ALL ".join([
        part("dirty_dates", dirty_dates("p"), "issue", "column_flagged"),
        f"SELECT DISTINCT * FROM ({part('null_values', shown_nulls, lit('Null values found'), names_where((n, f'{q(n)} IS NULL') for n in FN))})",
        f"SELECT DISTINCT * FROM ({part('negative_values', lows, lit('Negative values found'), names_where((n, f'{to_double(q(n))} < 0') for n in F_NUM))})",
        part("numeric_strings", numeric_strings("f3"), "dirty_reason", "NULL"),
        part("unknown_chars", f"SELECT * FROM ({chars_described('f4')})", "issue", "column_flagged"),
        part("typos", doubtful("f5"), "dirty_reason", "column_flagged"),
        part("type_conversion", type_described("f6"), "issue", "column_flagged"),
    ])


def financial_records() -> str:
    """The record of each rule as its table words it: what it reports, where from, the business columns."""
    def part(rule, src, *meta):
        return f"SELECT {lit(rule)} AS rule, concat_ws('|', {', '.join([*meta, *map(q, FN)])}) AS record FROM ({src})"

    def whole(rule, src, issue, flagged):
        at = f"SELECT *, {lit(issue)} AS issue, {flagged} AS flagged, {FMETA}, {PROJECT}, {row_hash(FN)} AS row_hash FROM ({src})"
        return f"SELECT DISTINCT * FROM ({part(rule, at, 'issue', 'flagged', 'source_file', 'project_name', 'row_hash')})"

    shown_nulls = f"SELECT {each(FN, shown)} FROM f1 WHERE {either([f'{q(n)} IS NULL' for n in FN] + [null_token(q(n)) for n in FN])}"
    lows = f"SELECT {cols(FN)} FROM f2 WHERE {either(f'{to_double(q(n))} < 0' for n in F_NUM)}"
    return " UNION ALL ".join([
        part("dirty_dates", dirty_dates("p"), "column_flagged", "bad_date_value", "issue", "source_file", "project_name"),
        whole("null_values", shown_nulls, "Null values found", names_where((n, f"{q(n)} IS NULL") for n in FN)),
        whole("negative_values", lows, "Negative values found", names_where((n, f"{to_double(q(n))} < 0") for n in F_NUM)),
        part("numeric_strings", numeric_strings("f3"), "dirty_reason", "source_file"),
        part("unknown_chars", chars_described("f4"), "issue", "column_flagged", "bad_value", "source_file"),
        part("typos", doubtful("f5"), "dirty_reason", "column_flagged", "source_file"),
        part("type_conversion", type_described("f6"), "column_flagged", "expected_type", "issue", "source_file"),
    ])


# --- the statements -----------------------------------------------------------------------------

def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


def _partial(names, typed: bool) -> str:
    def one(n):
        if n == "Product":
            return "CAST(NULL AS VARCHAR) AS Product"
        if not typed:
            return q(n)
        if n in S_INT:
            return f"{to_int(q(n))} AS {q(n)}"
        # What a plain cast takes: year first, one-digit parts allowed.
        return f"{first_date(q(n), [(r'^\d{4}-\d{1,2}-\d{1,2}$', '%Y-%m-%d')])} AS {q(n)}" if n == "Order_Date" else q(n)

    return ", ".join(one(n) for n in names)


def written_dates() -> str:
    """Each way to write a date, and what it means: the date, its day and month exchanged where both readings are dates, or nothing."""
    y, m, d = "strftime(o, '%Y')", "strftime(o, '%m')", "strftime(o, '%d')"
    name, n, yy = "monthname(o)", "day(o)", "strftime(o, '%y')"
    same, none = "o", "NULL"
    # Two numbers up to twelve in the other order than the rule expects.
    turned = "CASE WHEN day(o) <= 12 THEN make_date(year(o), day(o), month(o)) ELSE o END"
    ways = [
        (f"{y} || '-' || {m} || '-' || {d}", same), (f"{d} || ' ' || {name} || ' ' || {y}", same),
        (f"{name}[1:3] || ' ' || {n} || ', ' || {y}", same), (f"dayname(o) || ', ' || upper({name}) || ' ' || {n} || 'th ' || {y}", same),
        (f"{d} || '/' || {m} || '/' || {y}", turned), (f"{m} || '-' || {d} || '-' || {y}", turned),
        (f"{y} || '.' || month(o) || '.' || {n}", same), (f"{d} || '.' || {m} || '.' || {y}", turned), (f"{y} || {m} || {d}", same),
        (f"{y} || '-' || {m} || '-' || {d} || 'T23:59:59.5Z'", same), (f"{m} || '/' || {d} || '/' || {yy}", same),
        (f"{n} || '-' || {name}[1:3] || '-' || {yy}", same), (f"{y} || '-13-45'", none), (f"{name} || ' ' || {y}", none),
        (f"'31 February ' || {y}", none), (f"{m} || '/' || {d} || '/' || {y} || ' 11:05 PM'", same),
        (f"{y} || '/' || {d} || '/' || {m}", "CASE WHEN day(o) <= 12 THEN make_date(year(o), day(o), month(o)) END"),
        (f"{y} || ' ' || {name}[1:3] || ' ' || {d}", same), (f"{y} || '-' || {m} || '-' || {d} || ' 25:10'", none),
        (f"' ' || {n} || 'th of ' || {name} || '  ' || {y}", same),
    ]
    text = " ".join(f"WHEN {k} THEN {t}" for k, (t, _) in enumerate(ways))
    means = " ".join(f"WHEN {k} THEN {v}" for k, (_, v) in enumerate(ways))
    return (f"SELECT o_orderkey, CASE o_orderkey % 20 {text} END AS text, CAST(CASE o_orderkey % 20 {means} END AS DATE) AS parsed "
            "FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o FROM orders)")


def oracle_sql() -> dict[str, str]:
    landed = f"SELECT {each(S, blank)}"
    na_free = ", ".join(
        f"CASE WHEN trim({q(n)}, ' ') <> '' AND {q(n)} NOT IN {tokens(CSV_NA_TOKENS)} THEN {q(n)} END AS {q(n)}" for n in FN)
    strip = f"regexp_replace({{}}, '[{SPECIAL_CHARACTERS}]', '', 'g')"
    hashed = f"SELECT *, {row_hash(['Customer_Name', 'Region', 'Payment_Method'])} AS row_hash FROM (SELECT Customer_Name, Region, Payment_Method FROM c)"
    light = ", ".join(
        (to_int(currency(f"trim({blank(q(n))}, ' ')")) if n in ("Unit_Price", "Total_Amount")
         else to_int(f"trim({blank(q(n))}, ' ')") if n == "Quantity" else f"trim({blank(q(n))}, ' ')")
        + (f" AS {q(n)}") for n in S)
    parse_bad = {**{n: type_bad(n, q(n)) for n in S}, "Order_Date": f"Order_Date IS NOT NULL AND {parse_multi(q('Order_Date'))} IS NULL"}
    stream_keys = " UNION ALL ".join(
        f"SELECT {lit(rule)} AS rule, row_hash AS key FROM ({select})" for rule, select in {
            "null_values": nulls("raw", S, META), "negative_values": nonpositive("raw", S, S_INT, "<=", META),
            "region_conflicts": region_conflicts("raw"), "unknown_chars": special_chars("raw"),
            "bigint_values": bigint("raw"),
            "typos": f"SELECT *, {row_hash([*S, 'dirty_reason', 'column_flagged', 'suggested_value', 'source_file'])} AS row_hash FROM ({typos('raw', False)})",
            "id_changes": id_changes("raw", ["Order_ID"]), "string_changes": string_changes("raw"),
        }.items())
    new_only = _with(f"{CLEAN}, {OLD}", "SELECT * FROM (SELECT " + ", ".join(
        f"{convert(n, q(n))} AS {q(n)}" for n in S) + " FROM c) WHERE Order_ID IS NULL OR Order_ID NOT IN (SELECT id FROM old)")
    report = _with(sales_stages(), f"SELECT 'raw' AS stage, count(*) AS rows FROM c UNION ALL SELECT rule, count(*) FROM ({sales_quarantine()}) GROUP BY rule UNION ALL SELECT 'loaded', count(*) FROM loaded")
    stream_loaded = _with(sales_stages(chars_leave=False, clean=stream_clean()), "SELECT * FROM s8")
    event = ("CASE WHEN event_type = 'error' THEN left(props, CAST(length(props) - 1 AS BIGINT)) ELSE props END")
    return {
        "src_csv_text": _with(RAW, f"{landed}, 'Test_Data_sales' AS source_file FROM raw"),
        "src_csv_financials": _with(FRAW, f"SELECT {na_free}, 'Financials' AS source_file FROM raw"),
        "src_csv_malformed": """WITH o AS (SELECT o_orderkey::VARCHAR AS k, o_custkey::VARCHAR AS c, o_orderstatus AS s, o_orderkey % 10 AS kind FROM orders)
            SELECT CASE WHEN kind NOT IN (1, 2, 3) THEN k END AS id, CASE WHEN kind = 4 THEN c || ',' WHEN kind NOT IN (1, 2, 3) THEN c END AS customer,
              CASE WHEN kind NOT IN (1, 2, 3) THEN s END AS state, 'Test_Data' AS source_file,
              CASE kind WHEN 1 THEN k || ',' || c || ',' || s || ',5' WHEN 2 THEN k || ',' || c WHEN 3 THEN k || ',"' || c || ',' || s END AS malformed_csv
            FROM o""",
        "src_union_by_name": _with(RAW, f"{landed}, CASE WHEN Region = 'North' THEN 'north' ELSE 'others' END AS source_file FROM raw"),
        "sink_raw_landing": _with(RAW, f"{landed}, '2024-01-31' AS run_date FROM raw UNION ALL {landed}, '2024-02-01' AS run_date FROM raw WHERE Region = 'South'"),
        "src_raw_reload": _with(RAW, f"{landed} FROM raw"),
        "sink_text_cast": _with(CLEAN, nonpositive("c", S, S_INT, "<=", META)),
        "sink_align_append": _with(RAW, "SELECT * FROM raw UNION ALL SELECT * FROM raw"),
        "audit_events": _with(CLEAN, "SELECT 'admin' AS username, 'INSERT' AS action, 'sales' AS table_name, "
                              f"'Loaded ' || count(*) || ' rows' AS details FROM c WHERE {' AND '.join(f'{convert(n, q(n))} IS NOT NULL' for n in S)}"),
        "schema_event": _with(CLEAN, "SELECT 'DIRTY_TYPE_SCHEMA' AS event_type, 'dirty_type_conversion' AS table_name, "
                              "CAST(to_json(list_sort(list(DISTINCT dirty_columns))) AS VARCHAR) AS columns, "
                              f"'{RUN_TS}' AS logged_at FROM ({type_cells('c')})"),
        "sink_empty_schema": _with(CLEAN, type_rows("c")),
        "kafka_envelope": _with(CLEAN, f"SELECT row_hash AS key, * FROM ({invalid_region('c')})"),
        "clean_blank_to_null": _with(RAW, f"{landed} FROM raw"),
        "clean_strings": _with(CLEAN, "SELECT * FROM c"),
        "clean_strings_title": _with(FRAW, f"SELECT {each(FN, title_letters)} FROM raw"),
        "clean_ids": _with(RAW, f"SELECT * REPLACE ({upper_id('Order_ID')} AS Order_ID, {upper_id('Customer_Name')} AS Customer_Name) FROM raw"),
        "strip_currency": _with(RAW, f"SELECT Order_ID, {currency('Unit_Price')} AS Unit_Price, {currency(chr(39) + '€ ' + chr(39) + ' || Total_Amount')} AS Total_Amount FROM raw"),
        "strip_special_chars": _with(RAW, f"SELECT {each(S, strip.format)} FROM raw"),
        "spelled_numbers": _with(FRAW, f"SELECT \"Row ID\", {spelled(q('Units Sold'))} AS \"Units Sold\", {spelled(q('Segment'))} AS \"Segment\" FROM raw"),
        "spelled_numbers_many": "SELECT p_partkey, CAST(CASE WHEN p_partkey < 1000 THEN p_partkey ELSE p_partkey * 7919 % 1000000 END AS VARCHAR) AS number FROM part",
        "normalize_headers": _with(FRAW, "SELECT " + ", ".join(f"{q(n)} AS {q(n.lower())}" for n in FN) + " FROM raw"),
        "schema_align": _with(RAW, f"SELECT {_partial(S, False)} FROM raw"),
        "schema_align_keep": _with(RAW, f"SELECT {_partial(S, False)}, 'x' AS Remark FROM raw"),
        "schema_enforce": _with(RAW, f"SELECT {_partial(S, True)} FROM raw"),
        "cast_dates_multi": _with(RAW, f"SELECT Order_ID, Order_Date, {parse_multi('Order_Date')} AS parsed FROM raw"),
        "cast_dates_permissive": written_dates(),
        "cast_numeric": _with(RAW, "SELECT Order_ID, " + ", ".join(
            f"{to_int(n)} AS {n}_int, {to_double(n)} AS {n}_double" for n in ("Quantity", "Unit_Price", "Total_Amount")) + " FROM raw"),
        "stream_light_transform": _with(RAW, f"SELECT {light} FROM raw"),
        "row_hash": _with(RAW, f"SELECT *, {row_hash(S)} AS row_hash FROM raw"),
        "dedup_row_hash": _with(CLEAN, once(hashed, "row_hash", ["Customer_Name", "Region", "Payment_Method"])),
        "dedup_primary_key": _with(CLEAN, f"SELECT * EXCLUDE (h) FROM ({once(f'SELECT *, {row_hash(S)} AS h FROM c', 'Order_ID', ['h', *[q(n) for n in S]])})"),
        "dedup_full_row": _with(CLEAN, "SELECT DISTINCT Customer_Name, Region, Product FROM c"),
        "rule_invalid_region": _with(CLEAN, invalid_region("c")),
        "rule_nulls": _with(CLEAN, nulls("c", S, META)),
        "rule_nulls_financials": _with(FRAW, nulls("raw", FN, FMETA)),
        "rule_nonpositive": _with(CLEAN, nonpositive("c", S, S_INT, "<=", META)),
        "rule_negative_strict": _with(FRAW, nonpositive("raw", FN, F_NUM, "<", FMETA)),
        "rule_special_chars": _with(CLEAN, special_chars("c")),
        "rule_special_chars_described": _with(FRAW, chars_described("raw")),
        "rule_bigint": _with(CLEAN, bigint("c")),
        "rule_type_dirty_rows": _with(CLEAN, type_rows("c")),
        "rule_type_dirty_parse": _with(CLEAN, type_rows("c", lambda n, c: parse_bad[n])),
        "rule_type_dirty_cells": _with(CLEAN, type_cells("c")),
        "rule_type_dirty_financials": _with(PREPARED, type_described("p")),
        "rule_numeric_strings": _with(FRAW, numeric_strings("raw")),
        "rule_dates_strict": _with(FRAW, dirty_dates("raw")),
        "cast_dates_strict": _with(FRAW, f"SELECT r.\"Row ID\", {parse_strict('r.' + q('Date'))} AS parsed, d.issue FROM raw r LEFT JOIN ({dirty_dates('raw')}) d ON d.\"Row ID\" = r.\"Row ID\""),
        "detect_date_columns": _with(FRAW, " UNION ALL ".join(
            f"SELECT {lit(n)} AS column_name FROM raw HAVING max(CAST(regexp_matches({q(n)}, '\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}') AS INT)) = 1" for n in FN)),
        "rule_typos_heuristic": _with(FRAW, doubtful("raw")),
        "rule_typos_levenshtein": _with(RAW, typos("raw", False)),
        "rule_typos_table": _with(RAW, typos("raw", False)),
        "rule_typos_part_names": f"""WITH d AS (SELECT p_partkey AS k, p_name || ' ' || p_partkey AS w FROM part),
            t AS (SELECT k, CASE k % 3 WHEN 0 THEN w[1:2] || w[4:] WHEN 1 THEN w || 'x' ELSE w END AS Product FROM d)
            SELECT t.k::VARCHAR AS p_partkey, Product, 'Possible typo' AS dirty_reason, 'Product' AS column_flagged, d.w AS suggested_value, {META}
            FROM t JOIN d ON abs(length(Product) - length(d.w)) <= 2 AND levenshtein(lower(Product), lower(d.w)) <= 2 AND lower(Product) <> lower(d.w)
            WHERE lower(Product) NOT IN (SELECT lower(w) FROM d)""",
        "rule_typos_parity": _with(RAW, typos("raw", True)),
        "agg_region_conflicts": _with(CLEAN, conflicts("c")),
        "rule_region_conflicts": _with(CLEAN, region_conflicts("c")),
        "drop_conflict_customers": _with(CLEAN, f"SELECT * FROM c WHERE Customer_Name IS NULL OR Customer_Name NOT IN ({conflicts('c')})"),
        "reject_by_id": _with(CLEAN, f"SELECT * FROM c WHERE Order_ID IS NULL OR Order_ID NOT IN (SELECT Order_ID FROM ({type_rows('c')}) WHERE Order_ID IS NOT NULL)"),
        "load_existing_keys": "SELECT CAST(o_orderkey AS INT) AS Order_ID FROM orders",
        "load_new_only": new_only,
        "load_new_only_clustered": new_only,
        "audit_id_changes": _with(RAW, id_changes("raw", ["Order_ID", "Customer_Name"])),
        "audit_string_changes": _with(RAW, string_changes("raw")),
        "json_decode": f"SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INT) END AS k, CASE WHEN event_type = 'error' THEN {event} END AS _corrupt_record FROM events",
        "etl_batch_clean": _with(sales_stages(), "SELECT * FROM loaded"),
        "etl_from_csv_folder": _with(sales_stages(), "SELECT * FROM s8"),
        "etl_batch_reject_rows": _with(sales_stages(reject="row"), "SELECT * FROM loaded"),
        "quarantine_all": _with(sales_stages(), sales_quarantine()),
        "quarantine_tables": _with(f"{sales_stages()}, dirty AS MATERIALIZED ({sales_quarantine()})", rule_records()),
        "kafka_topics": _with(sales_stages(), "SELECT CASE rule " + " ".join(f"WHEN {lit(r)} THEN {lit(t)}" for r, t in TOPIC)
                              + f" END AS topic, row_hash AS key, issue, Order_ID FROM ({sales_quarantine()})"),
        "kafka_events": _with(sales_stages(), f"""SELECT 'dirty-type-schema' AS topic, CAST(NULL AS VARCHAR) AS key, 'DIRTY_TYPE_SCHEMA' AS event_type,
              CAST(NULL AS VARCHAR) AS action, 'dirty_type_conversion' AS table_name,
              CAST(to_json(list_sort(list(DISTINCT f))) AS VARCHAR) AS columns, CAST(NULL AS VARCHAR) AS details
            FROM (SELECT unnest(string_split(dirty_columns, ',')) AS f FROM ({type_rows('s2')}))
            UNION ALL SELECT 'audit-events', NULL, NULL, 'INSERT', 'sales', NULL, 'Loaded ' || count(*) || ' rows' FROM loaded"""),
        "quality_report": report,
        "quality_report_one_write": report,
        "etl_financials_clean": _with(FINANCIAL_STAGES, "SELECT DISTINCT " + ", ".join(financial_typed(n) for n in FN) + " FROM f7"),
        "etl_financials_repeat": _with(FINANCIAL_STAGES, "SELECT DISTINCT " + ", ".join(financial_typed(n) for n in FN) + " FROM f7"),
        "quarantine_financials": _with(FINANCIAL_STAGES, financial_quarantine()),
        "quarantine_tables_financials": _with(FINANCIAL_STAGES, financial_records()),
        "stream_json_source": _with(RAW, "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM raw"),
        "stream_raw_sink": _with(RAW, "SELECT * FROM raw"),
        "stream_two_jobs_raw": _with(RAW, "SELECT * FROM raw"),
        "stream_two_jobs_quarantine": _with(RAW, stream_keys),
        "stream_etl_clean": stream_loaded,
        "stream_replay_idempotent": stream_loaded,
        "stream_commit_replay": stream_loaded,
        "stream_bounded_batches": _with(sales_stages(chars_leave=False, clean=stream_clean(ALONE)), "SELECT * FROM s8"),
        "stream_conflicts_across_batches": " UNION ALL ".join(late_batch(k) for k in range(3)),
        "stream_pipeline_quarantine": _with(sales_stages(chars_leave=False, clean=stream_clean()), sales_quarantine(stream=True)),
        "stream_quarantine": _with(RAW, stream_keys),
    }


