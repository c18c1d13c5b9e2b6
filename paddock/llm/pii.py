"""Personal data in texts: regular expressions propose spans, checksums confirm them, nearby words weigh them.

Splitting a text at an expression gives what lies between its matches; the lengths of both, added up, give each
match's place in code points. Repeated groups are possessive and runs are entered at their beginning only, so that
matching needs no deep recursion and time in proportion to the text.

Only DataFrame functions are used; each text is looked at on its own and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paddock.llm.common import text_or_empty

# The characters of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV",
    22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HN|HU|LB|NI|PL|SV",
    29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
IBAN = "|".join(rf"(?:{c})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
# The kinds in order, a text that every match contains, and the expressions.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = (
    ("email", "@", rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", "", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("iban", "", rf"(?<![\p{{L}}\p{{N}}])(?=[A-Z]{{2}}[0-9]{{2}})(?:{IBAN})(?![\p{{L}}\p{{N}}])"),
)
BASE = ("email", "ip", "card", "phone")
# Words near a span that make its kind likelier.
CONTEXT = {
    "email": "mail|contact|write|reach",
    "ip": "ip|host|server|address|login",
    "card": "card|credit|visa|payment|debit",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|transfer",
}
NEAR = 40  # code points on either side, as far as the next match of the kind
BLOCK = 256  # matches whose steps are summed together
VALID, BY_CONTEXT = 0.7, 0.3  # score of a confirmed span, and what context adds

OCTET = "0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _luhn(digits: str) -> str:
    """SQL for the Luhn test of a string of digits: every second digit from the right is doubled."""
    return f"""aggregate(sequence(1, length({digits})), 0, (sum, k) -> sum +
        CASE WHEN k % 2 = 1 THEN CAST(substr({digits}, -k, 1) AS INT)
             ELSE CAST(substr({digits}, -k, 1) AS INT) * 2 - CASE WHEN CAST(substr({digits}, -k, 1) AS INT) > 4 THEN 9 ELSE 0 END
        END) % 10 = 0"""


def _mod97(letters: str) -> str:
    """SQL for the mod-97 test of an account number without spaces: first four characters to the end, letters as 10 to 35."""
    return f"""aggregate(split(concat(substr({letters}, 5), substr({letters}, 1, 4)), ''), 0, (rest, c) ->
        CASE WHEN c = '' THEN rest WHEN c <= '9' THEN (rest * 10 + CAST(c AS INT)) % 97
             ELSE (rest * 100 + ascii(c) - 55) % 97 END) = 1"""


def _confirmed(kind: str) -> str:
    """SQL that tells whether a match m.text is confirmed."""
    if kind == "ip":
        return f"m.text RLIKE r'^{OCTET}\\.{OCTET}\\.{OCTET}\\.{OCTET}$'"
    digits = "translate(m.text, ' -+().', '')"
    if kind == "card":
        # the cheap test of the length comes first
        return f"CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {_luhn(digits)} ELSE false END"
    if kind == "phone":
        return f"length({digits}) BETWEEN 8 AND 15"
    if kind == "iban":
        letters = "replace(m.text, ' ', '')"
        return f"CASE WHEN length({letters}) BETWEEN 15 AND 34 THEN {_mod97(letters)} ELSE false END"
    return "true"


def find_pii(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The confirmed spans of every whole text.

    One row per input row, repeated rows included: the id and spans, an array of (kind, start, end, text, score) by
    kind as listed in PATTERNS, then start; places are code points, end exclusive. Matches of a kind are leftmost and do
    not overlap; those that fail their test (octets, Luhn, digits, mod-97) are dropped without a retry. score is VALID, and
    BY_CONTEXT more if a context word begins within NEAR code points. A null text counts as empty.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text_or_empty(text_column).alias("text"))
    nothing = "CAST(array() AS ARRAY<STRING>)"
    for kind, contains, pattern in PATTERNS:
        found = F.expr(f"regexp_extract_all(text, r'{pattern}', 0)")
        if contains:
            found = F.when(F.contains("text", F.lit(contains)), found).otherwise(F.expr(nothing))
        rows = rows.withColumn(f"m_{kind}", found)
    for kind, _, pattern in PATTERNS:
        # What lies before, between and after the matches; a text without matches is not split.
        rows = rows.withColumn(f"g_{kind}", F.expr(f"CASE WHEN size(m_{kind}) > 0 THEN split(text, r'{pattern}', -1) END"))
    rows = rows.drop("text")
    parts = []
    for kind, _, _ in PATTERNS:
        m, g, s, b = (f"{x}_{kind}" for x in "mgsb")
        # Steps from each match's start to the next one's, and their sums by blocks.
        rows = rows.withColumn(s, F.expr(
            f"transform({m}, (x, i) -> length({g}[i]) + CASE WHEN i > 0 THEN length({m}[i - 1]) ELSE 0 END)"))
        rows = rows.withColumn(b, F.expr(
            f"transform(sequence(0, size({m}) div {BLOCK}), k -> aggregate(slice({s}, k * {BLOCK} + 1, {BLOCK}), 0L, (a, n) -> a + n))"))
        good = f"filter(transform({m}, (x, i) -> struct(x AS text, i)), m -> {_confirmed(kind)})"
        start = (f"aggregate(slice({b}, 1, m.i div {BLOCK}), 0L, (a, n) -> a + n) + "
                 f"aggregate(slice({s}, (m.i div {BLOCK}) * {BLOCK} + 1, m.i % {BLOCK} + 1), 0L, (a, n) -> a + n)")
        near = f"lower(concat(right({g}[m.i], {NEAR}), ' ', left({g}[m.i + 1], {NEAR})))"
        score = f"CASE WHEN {near} RLIKE r'\\b({CONTEXT[kind]})' THEN {VALID + BY_CONTEXT}D ELSE {VALID}D END"
        placed = f"transform({good}, m -> struct('{kind}' AS kind, {start} AS start, m.text, {score} AS score))"
        parts.append(f"transform({placed}, m -> struct(m.kind, m.start, m.start + length(m.text) AS end, m.text, m.score))")
    return rows.select(F.col("id").alias(id_column), F.expr(f"concat({', '.join(parts)})").alias("spans"))


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text kind:start:end, comma-joined."""
    listed = "array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    base = "filter(spans, s -> s.kind IN ({}))".format(", ".join(f"'{k}'" for k in BASE))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in BASE]
    return found.select(
        F.col(f"`{id_column}`"), *counts, F.sha2(F.expr(listed.format(spans=base)), 256).alias("base_sha256"),
        F.expr(listed.format(spans="spans")).alias("spans"))


def oracle() -> str:
    """The digest in SQL, for `doc_id` and `text` of `documents`. The engine's expressions have no look-behind and need none
    for the base kinds. Its expression for iban knows neither lengths nor borders, so it holds for texts without account numbers."""
    plain = {
        "email": rf"[{LOCAL}]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": PATTERNS[3][2],
        "iban": r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}",
    }
    digits = "regexp_replace(text, '[^0-9]', '', 'g')"
    value = "CAST(x AS INT)"
    luhn = (f"list_sum(list_transform(string_split(reverse({digits}), ''), lambda x, k: CASE WHEN k % 2 = 1 THEN {value} "
            f"WHEN {value} > 4 THEN {value} * 2 - 9 ELSE {value} * 2 END)) % 10 = 0")
    letters = "replace(text, ' ', '')"
    mod97 = (f"list_reduce(list_transform(string_split(substr({letters}, 5) || substr({letters}, 1, 4), ''), "
             "lambda c: CASE WHEN c <= '9' THEN CAST(ascii(c) - 48 AS BIGINT) ELSE CAST(ascii(c) - 55 AS BIGINT) END), "
             "lambda r, v: CASE WHEN v < 10 THEN (r * 10 + v) % 97 ELSE (r * 100 + v) % 97 END, CAST(0 AS BIGINT)) = 1")
    test = {
        "email": "true", "ip": f"regexp_matches(text, '^{OCTET}\\.{OCTET}\\.{OCTET}\\.{OCTET}$')",
        "card": f"CASE WHEN length({digits}) BETWEEN 16 AND 19 THEN {luhn} ELSE false END",
        "phone": f"length({digits}) BETWEEN 8 AND 15",
        "iban": f"CASE WHEN length({letters}) BETWEEN 15 AND 34 THEN {mod97} ELSE false END",
    }
    parts = "\nUNION ALL\n".join(f"""SELECT row, '{kind}' AS kind, {nr} AS nr, text, start FROM (
  SELECT row, text, i, sum(length(gaps[i]) + CASE WHEN i > 1 THEN length(found[i - 1]) ELSE 0 END)
    OVER (PARTITION BY row ORDER BY i) AS start
  FROM (SELECT row, found, gaps, unnest(found) AS text, generate_subscripts(found, 1) AS i FROM (
    SELECT row, regexp_extract_all(text, '{plain[kind]}') AS found, string_split_regex(text, '{plain[kind]}') AS gaps FROM d))
) WHERE {test[kind]}""" for nr, (kind, _, _) in enumerate(PATTERNS))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)
    span = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(s.text) AS BIGINT)"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({parts})
SELECT doc_id, {counts},
  sha256(coalesce(string_agg({span}, ',' ORDER BY nr, start) FILTER (WHERE nr < {len(BASE)}), '')) AS base_sha256,
  coalesce(string_agg({span}, ',' ORDER BY nr, start), '') AS spans
FROM d LEFT JOIN s USING (row) GROUP BY row, doc_id"""
