"""SQL snippets for the DuckDB twins."""

from __future__ import annotations


def cte(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in parts.items()) + "\n"


def blank(x: str) -> str:
    return f"({x} IS NULL OR NOT regexp_matches({x}, '\\S'))"


def time_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def day_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def month_first(x: str) -> str:
    """Month before day, ISO with T accepted."""
    return f"""coalesce(
        CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%Y-%m-%d %H:%M:%S') END,
        CASE WHEN regexp_full_match({x}, '\\d\\d-\\d\\d-\\d{{4}} \\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%d-%m-%Y %H:%M:%S') END,
        CASE WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}} \\d\\d:\\d\\d') THEN try_strptime({x}, '%m/%d/%Y %H:%M') END,
        CASE WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}} \\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%m/%d/%Y %H:%M:%S') END,
        CASE WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}}') THEN try_strptime({x}, '%m/%d/%Y') END,
        CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%Y-%m-%dT%H:%M:%S') END)"""


def day_first(x: str) -> str:
    """The other preset: for minutes-only texts the day is tried first; no ISO with T."""
    return f"""coalesce(
        CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d\\d-\\d\\d \\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%Y-%m-%d %H:%M:%S') END,
        CASE WHEN regexp_full_match({x}, '\\d\\d-\\d\\d-\\d{{4}} \\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%d-%m-%Y %H:%M:%S') END,
        CASE WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}} \\d\\d:\\d\\d') THEN
            coalesce(try_strptime({x}, '%d/%m/%Y %H:%M'), try_strptime({x}, '%m/%d/%Y %H:%M')) END,
        CASE WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}} \\d\\d:\\d\\d:\\d\\d') THEN try_strptime({x}, '%m/%d/%Y %H:%M:%S') END,
        CASE WHEN regexp_full_match({x}, '\\d\\d/\\d\\d/\\d{{4}}') THEN try_strptime({x}, '%m/%d/%Y') END)"""


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


def readable(x: str) -> str:
    """Null for texts with digit separators, which DuckDB would read as numbers."""
    return f"CASE WHEN NOT contains({x}, '_') THEN {x} END"


def amount(x: str, precision: int = 10) -> str:
    """At least 0; missing and unreadable become 0."""
    return f"greatest(coalesce(try_cast({readable(x)} AS decimal({precision},2)), 0), 0)"


def cents(x: str) -> str:
    return f"cast({x} * 100 AS hugeint)"


def ratio(top: str, bottom: str) -> str:
    """top / bottom of whole numbers >= 0 as a number with two digits, rounded half up."""
    return f"cast((2 * 100 * {top} + {bottom}) // (2 * {bottom}) AS double) / 100"


def number(x: str) -> str:
    return f"try_cast({readable(x)} AS decimal(38,10))"


def rules(source: str, key: str, checks: list[tuple[str, str, str]]) -> str:
    """One row per violated check: key, code, severity. A code in brackets is an expression."""
    parts = []
    for code, severity, condition in checks:
        text = code[1:-1] if code.startswith("[") else f"'{code}'"
        parts.append(f"SELECT {key}, {text} AS code, '{severity}' AS severity FROM {source} WHERE {condition}")
    return "\nUNION ALL\n".join(parts)


def numeric_rules(field: str, code: str) -> list[tuple[str, str, str]]:
    return [
        (f"{code}:{field}", "ERROR", f"{number(field)} < 0"),
        (f"INVALID_NUMERIC:{field}", "ERROR", f"NOT {blank(field)} AND {number(field)} IS NULL"),
    ]


ORDER_CHECKS = [
    (f"MISSING_REQUIRED_FIELD:{f}", "ERROR", blank(f)) for f in ["order_id", "customer_id", "order_date", "created_at"]
] + [c for f in ["total_amount", "subtotal", "tax_amount", "discount_amount"] for c in numeric_rules(f, "NEGATIVE_AMOUNT")]

ITEM_CHECKS = [
    (f"MISSING_REQUIRED_FIELD:{f}", "ERROR", blank(f)) for f in ["item_id", "order_id", "product_id"]
] + [c for f in ["quantity", "unit_price", "line_total"] for c in numeric_rules(f, "NEGATIVE_VALUE")]

REGISTERED = """coalesce(
    CASE WHEN regexp_full_match(registration_date, '\\d{4}-\\d{1,2}-\\d{1,2}') THEN try_strptime(registration_date, '%Y-%m-%d') END,
    CASE WHEN regexp_full_match(registration_date, '\\d{1,2}/\\d{1,2}/\\d{4}') THEN try_strptime(registration_date, '%m/%d/%Y') END,
    CASE WHEN regexp_full_match(registration_date, '\\d{1,2}-\\d{1,2}-\\d{4}') THEN try_strptime(registration_date, '%d-%m-%Y') END)"""
EMAIL = "'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}$'"

CUSTOMER_CHECKS = [
    ("MISSING_REQUIRED_FIELD:customer_id", "ERROR", blank("customer_id")),
    ("MISSING_REQUIRED_FIELD:email", "ERROR", blank("email")),
    ("INVALID_EMAIL_FORMAT:email", "ERROR", f"email <> '' AND NOT regexp_matches(email, {EMAIL})"),
    ("UNUSUAL_PHONE_FORMAT:phone", "WARNING", f"NOT {blank('phone')} AND NOT regexp_matches(phone, '^[\\d\\s\\-\\(\\)\\+]{{7,}}$')"),
    ("INVALID_DATE_FORMAT:registration_date", "ERROR", f"NOT {blank('registration_date')} AND {REGISTERED} IS NULL"),
    ("FUTURE_REGISTRATION_DATE:registration_date", "WARNING", f"{REGISTERED} > DATE '2025-01-01'"),
    *numeric_rules("lifetime_value", "NEGATIVE_VALUE"),
    ("['UNKNOWN_SEGMENT:' || customer_segment]", "WARNING",
     f"NOT {blank('customer_segment')} AND lower(customer_segment) NOT IN ('basic', 'standard', 'premium', 'vip')"),
    ("INVALID_BOOLEAN:is_active", "ERROR",
     "is_active <> '' AND lower(trim(is_active)) NOT IN ('true', 'false', '1', '0', 'y', 'n', 'yes', 'no')"),
    *[(f"POTENTIAL_TEST_DATA:{f}", "WARNING", f"contains(lower({f}), '{w}')")
      for f in ["first_name", "last_name"] for w in ["test", "example", "sample", "firstname", "lastname"]],
]


def code_list(checks: list[tuple[str, str, str]], severity: str) -> str:
    """JSON text of the codes of one severity, in rule order."""
    parts = []
    for code, level, condition in checks:
        if level == severity:
            text = code[1:-1] if code.startswith("[") else f"'{code}'"
            parts.append(f"CASE WHEN {condition} THEN {text} END")
    return f"list_filter([{', '.join(parts)}], lambda c: c IS NOT NULL)" if parts else "cast([] AS varchar[])"


def error_count(checks: list[tuple[str, str, str]]) -> str:
    return " + ".join(
        f"CASE WHEN {condition} THEN 1 ELSE 0 END" for _, level, condition in checks if level == "ERROR"
    )


def completeness(fields: list[str]) -> str:
    filled = " + ".join(f"CASE WHEN trim({f}) <> '' THEN 1 ELSE 0 END" for f in fields)
    return f"cast(cast(({filled}) / {len(fields)} * 100 AS decimal(5,2)) AS double)"
