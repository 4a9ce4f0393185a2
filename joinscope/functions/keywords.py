"""Word lists and patterns with fixed values."""

from __future__ import annotations

# --- Fixed values: these lists and their order decide the results. ---------------------

# Words that are never a table name.
SQL_KEYWORDS = (
    "WHERE", "ON", "SET", "GROUP", "ORDER", "HAVING", "LIMIT", "UNION",
    "EXCEPT", "INTERSECT", "SELECT", "WITH", "VALUES", "INNER", "LEFT",
    "RIGHT", "FULL", "OUTER", "CROSS", "NATURAL", "JOIN", "FROM", "AND",
    "OR", "NOT", "IN", "AS", "BY", "BETWEEN", "CASE", "WHEN", "THEN",
    "END", "OVER", "PARTITION", "QUALIFY", "DISTINCT", "NULL", "IS",
)

# Service-account prefixes; the first match wins.
APP_PREFIXES = ("SVP", "SVR", "SVC", "SVT", "ETL", "DBA", "OP")

# Keywords found fused to the end of a preceding word, in the order they are split off.
FUSED_KEYWORDS = (
    "SELECT", "DISTINCT", "INSERT", "UPDATE", "DELETE",
    "FROM", "WHERE", "HAVING", "UNION", "INTO", "WITH",
    "INNER", "OUTER", "CROSS", "FULL", "LEFT", "RIGHT",
    "JOIN", "GROUP", "ORDER",
    "ON", "AS", "SET", "BY",
)

# Teradata noise: (pattern, replacement), applied in this order, ignoring case.
TERADATA_RULES = (
    (r"\bFORMAT\s+'[^']*'", ""),
    (r"\bTITLE\s+'[^']*'", ""),
    (r"\bNAMED\s+\w+", ""),
    (r"\bCASEWORD\s+\w+", ""),
    (r"\bAT\s+ISOLATION\s+LEVEL\s+\w+", ""),
    (r"\bLOCKING\s+(?:ROW|TABLE|DATABASE|VIEW)\s+(?:FOR\s+)?(?:ACCESS|WRITE|READ|EXCLUSIVE)", ""),
    (r"\bLOCKING\s+\S+\s+FOR\s+(?:ACCESS|WRITE|READ|EXCLUSIVE)", ""),
    (r"\b(?:COMPRESS|NO\s+COMPRESS)\b[^,;)]*", ""),
    (r"\bNORMALIZE(?:\s+ON\s+MEETS\s+OR\s+OVERLAPS)?", ""),
    (r"\bEXPAND\s+ON\s+\w+", ""),
    (r"--[^\n]*", ""),
    (r"(?s)/\*.*?\*/", " "),
    (r"\bBTEQ\b[^\n]*", ""),
    (r";\s*$", ""),
    (r"\s+", " "),
)

# Rules that every text needs; the rest are dialect rules.
COMMON_RULES = (r"--[^\n]*", r"(?s)/\*.*?\*/", r";\s*$", r"\s+")

# Each dialect rule needs one of these words: a text without them is changed by none of the rules.
TERADATA_WORDS = (
    "FORMAT", "TITLE", "NAMED", "CASEWORD", "ISOLATION", "LOCKING", "COMPRESS", "NORMALIZE", "EXPAND", "BTEQ",
)

# A word ends here, for keywords glued to the end of another word.
WORD_END = r"(?=[^A-Za-z0-9_]|$)"

# A slash-delimited remark of three characters or more, as seen in dirty logs.
SLASH_REMARK = r"(?s)(?<!\*)(?<!/)/(?!\*)/?.{3,}?(?<!\*)/(?!\*)"

# A line that opens a new log record, and the comma + date that ends the SQL field.
RECORD_START = r"^[A-Za-z0-9]+\s*,"
DATE_AFTER_COMMA = r",\s*\d{1,2}/\d{1,2}/\d{4}(?:\s+\d{1,2}:\d{2})?"

# Business domains by substring of the table name; the first domain with a hit wins.
DOMAIN_KEYWORDS = {
    "finance": ("fin", "account", "ledger", "payment", "invoice", "revenue", "cost", "budget"),
    "customer": ("cust", "client", "member", "user", "subscriber", "contact"),
    "product": ("prod", "item", "sku", "catalog", "inventory", "stock"),
    "order": ("order", "sale", "transaction", "purchase", "cart"),
    "hr": ("emp", "staff", "payroll", "department", "position"),
    "logistics": ("ship", "deliver", "warehouse", "carrier", "freight", "dispatch"),
    "marketing": ("campaign", "promo", "lead", "segment", "channel"),
    "analytics": ("dim", "fact", "agg", "metric", "report", "kpi", "mart"),
}

# --- Our own additions -----------------------------------------------------------------

# Words that may follow a table reference and so cannot be its alias.
_FOLLOWING_WORDS = ("USING", "MINUS", "WINDOW", "LATERAL", "SAMPLE", "FETCH", "OFFSET", "SEMI", "ANTI")

NOT_A_NAME = r"(?!(?:" + "|".join(SQL_KEYWORDS + _FOLLOWING_WORDS) + r")\b)"
IDENT = r"(?:[\w$#@]+|\"[^\"]+\"|`[^`]+`)"
QUALIFIED = rf"{IDENT}(?:\s*\.\s*{IDENT})*"
# Table reference with optional alias; two capture groups.
TABLE_REF = rf"{NOT_A_NAME}({QUALIFIED})(?:\s+(?:AS\s+)?{NOT_A_NAME}({IDENT}))?"

# --- Textual patterns: the shapes are fixed values, the name guards are ours. -----------

# A JOIN and the name after it.
JOIN_TARGET = (
    r"(?i)\b(?:INNER\s+|LEFT\s+(?:OUTER\s+)?|RIGHT\s+(?:OUTER\s+)?|FULL\s+(?:OUTER\s+)?|CROSS\s+)?JOIN\s+([\w.]+)"
)
FROM_TABLE = r"(?i)\bFROM\s+([\w.]+)"
# A FROM glued to the word before it.
FUSED_FROM = r"(?i)\wFROM\b"
# Any FROM or JOIN with its table; groups: join side, glued character, word, table, alias.
TABLE_MENTION = (
    r"(?i)(?:(INNER\s+|LEFT\s+(?:OUTER\s+)?|RIGHT\s+(?:OUTER\s+)?|FULL\s+(?:OUTER\s+)?|CROSS\s+|NATURAL\s+)|(\w))?"
    rf"(FROM|JOIN)\s+{TABLE_REF}"
)
_ON_ALIAS = rf"(?:\s+AS\s+({IDENT})|\s+{NOT_A_NAME}({IDENT}))?"
# Groups: table, two forms of alias.
ON_REFERENCE = rf"(?i)(?:FROM|JOIN)\s+{NOT_A_NAME}({QUALIFIED}){_ON_ALIAS}"
# Groups: join type, table, two forms of alias, condition.
ON_CLAUSE = (
    rf"(?is)((?:LEFT|RIGHT|FULL|CROSS|INNER|OUTER)\s+(?:OUTER\s+)?)?JOIN\s+{NOT_A_NAME}({QUALIFIED}){_ON_ALIAS}"
    r"\s+ON\s+(.+?)(?=(?:LEFT|RIGHT|FULL|CROSS|INNER|OUTER)?\s*JOIN|\s+WHERE|\s+GROUP|\s+ORDER|\s+HAVING|$)"
)
ON_EQUALITY = r"[\w$.]+\s*=\s*[\w$.]+"
