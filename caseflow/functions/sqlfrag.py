"""DuckDB SQL fragments mirroring ``expr`` — used only by the oracle texts.

Each helper takes an SQL expression string and returns an SQL expression
string.  They exist so that the oracle queries state the same rules as the
Spark operators, independently, in the other engine's dialect.
"""

from __future__ import annotations

# Fixed values, stated here for the SQL side by itself: an oracle that read them from the code under test would agree
# with any mistake in them.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
AGE_UNITS = {"DEC": "10.0", "YR": "1.0", "MON": "(1.0::DOUBLE / 12)", "WK": "(1.0::DOUBLE / 52)", "DY": "(1.0::DOUBLE / 365)", "HR": "(1.0::DOUBLE / 8760)"}
WEIGHT_UNITS = {"KG": "1.0", "KGS": "1.0", "LBS": "0.4536", "GMS": "0.001"}
NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
HASH_SCALE = 281474976710656.0  # 2 ** 48
TOKEN = "[a-z][a-z0-9]+"
FIT_GRID = "(SELECT range AS k, 0.1::DOUBLE + range * ((0.1::DOUBLE + 0.1::DOUBLE) - 0.1::DOUBLE) AS t FROM range(0, 8)) g"
FINE_GRID = "(SELECT range AS k, 0.1::DOUBLE + range * ((0.1::DOUBLE + 0.05::DOUBLE) - 0.1::DOUBLE) AS t FROM range(0, 16)) g"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_ws(e: str) -> str:
    return f"regexp_replace({e}, '^\\s+|\\s+$', '', 'g')"


def null_tokens(e: str) -> str:
    toks = ", ".join(q(t) for t in NA_TOKENS)
    return f"(CASE WHEN {e} IN ({toks}) THEN NULL ELSE {e} END)"


def norm_code(e: str) -> str:
    return f"upper({strip_ws(e)})"


def py_title(e: str) -> str:
    runs = f"regexp_extract_all(lower({e}), '(\\p{{L}}+|\\P{{L}}+)', 1)"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1:1]) || r[2:]), '')"


def num_or_null(e: str) -> str:
    s = strip_ws(f"CAST({e} AS VARCHAR)")
    return f"(CASE WHEN regexp_full_match({s}, '{NUMBER}') THEN TRY_CAST({s} AS DOUBLE) END)"


def _factor(code: str, factors: dict) -> str:
    whens = " ".join(f"WHEN {code} = {q(k)} THEN {v}::DOUBLE" for k, v in factors.items())
    return f"(CASE {whens} ELSE 1.0 END)"


def age_years(age: str, unit: str) -> str:
    return f"({num_or_null(age)} * {_factor(norm_code(unit), AGE_UNITS)})"


def weight_kg(wt: str, unit: str) -> str:
    return f"({num_or_null(wt)} * {_factor(norm_code(unit), WEIGHT_UNITS)})"


def sex_code(e: str) -> str:
    s = norm_code(e)
    return f"(CASE WHEN {s} IN ('M', 'F') THEN {s} ELSE 'U' END)"


def hash_bits(seed, *parts: str) -> str:
    key = "concat_ws(':', " + ", ".join([q(str(seed))] + [f"CAST({p} AS VARCHAR)" for p in parts]) + ")"
    return f"CAST(('0x' || substr(md5({key}), 1, 12)) AS BIGINT)"


def hash_unit(seed, *parts: str) -> str:
    return f"({hash_bits(seed, *parts)} / {HASH_SCALE!r})"


def hash_normal(seed, *parts: str) -> str:
    u1 = hash_unit(seed, *parts, "'a'")
    u2 = hash_unit(seed, *parts, "'b'")
    return f"(sqrt(-2.0 * ln(1.0 - {u1})) * cos({2 * 3.141592653589793!r} * {u2}))"


def sigmoid(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-greatest(-30.0, least(30.0, {z})))))"


def safe_div(num: str, den: str) -> str:
    return f"(CASE WHEN {den} > 0 THEN ({num}) / ({den}) ELSE 0.0 END)"


def join_sorted(arr: str) -> str:
    return f"array_to_string(list_sort({arr}), '|')"
