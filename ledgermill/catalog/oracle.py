"""DuckDB SQL giving the expected result of every query, written independently
of the Spark operators; only the ledger rendering is shared."""

from __future__ import annotations

from ledgermill.catalog import ledger
from ledgermill.catalog.ledger import ALIASES, CATEGORIES, PATTERNS, TRAINING
from ledgermill.catalog.queries import LOST_METHOD, LOST_PARTIES, NEGATED, NULLED, TEXT_KEYWORDS
from ledgermill.operators.rules import PAYMENT_METHODS
from ledgermill.sources.exports import BUSINESS_COLUMNS

JOINED = """joined AS (
  SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
_RAW = ", ".join(f"{body} AS {name}" for name, body in ledger.raw_columns(ledger.DUCKDB_FUNCTIONS).items())
RAW = f"{JOINED}, raw AS (SELECT o_orderkey, n_nationkey, {ledger.SOURCE_FILE} AS _source_file, {_RAW} FROM joined)"
FILES = f"""{JOINED}, raw AS (SELECT * REPLACE ({ledger.FILE_DESCRIPTION} AS description) FROM (
  SELECT o_orderkey, c_name, n_nationkey, {ledger.SOURCE_FILE} AS _source_file, {_RAW} FROM joined))"""
_FILE_SQL = ledger.file_lines()
# An unquoted empty cell is missing, a quoted one is the empty text.
_FILE_CELLS = ", ".join(c if c in ledger.QUOTED else f"nullif({c}, '') AS {c}" for c in BUSINESS_COLUMNS)
_PLAIN_FOOTER = ", ".join(
    f"'{ledger.FOOTER_TEXT}'" if c == "transaction_date" else "CAST(NULL AS VARCHAR)" for c in BUSINESS_COLUMNS
)
_MOVED = f"n_nationkey IN ({', '.join(map(str, ledger.ROTATED))})"
_FOOTER_CELLS = {
    "transaction_date": f"CASE WHEN NOT {_MOVED} THEN '{ledger.FOOTER_TEXT}' END",
    "account": f"CASE WHEN {_MOVED} THEN '{ledger.FOOTER_TEXT}' END",
}
_FOOTER = ", ".join(_FOOTER_CELLS.get(c, "CAST(NULL AS VARCHAR)") for c in BUSINESS_COLUMNS)


def quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def day(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({x}), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(try_strptime(trim({x}), '%Y-%m-%d') AS DATE) END"
    )


def exact_day(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
        f"THEN CAST(try_strptime({x}, '%Y-%m-%d') AS DATE) END"
    )


REAL_DAY = "coalesce(try_strptime(trim(transaction_date), '%Y-%m-%d') IS NOT NULL, false)"


def number(x: str, kind: str = "DECIMAL(18,2)") -> str:
    return f"TRY_CAST(nullif(replace(regexp_replace({x}, '[\\s\\x{{a0}}]', '', 'g'), ',', '.'), '') AS {kind})"


TYPED = f"""typed AS (
  SELECT o_orderkey, n_nationkey, _source_file,
    substr(sha256(concat_ws('~', CAST({day('transaction_date')} AS VARCHAR), nullif(transaction_id, ''),
      counterparty_details, transaction_amount)), 1, 32) AS transaction_sk,
    {day('transaction_date')} AS transaction_date,
    {exact_day('posting_date')} AS posting_date,
    trim(lower(counterparty_details)) AS counterparty_details,
    trim(lower(description)) AS description,
    regexp_replace(account_number, '[''\\s]', '', 'g') AS account_number,
    trim(bank_name) AS bank_name,
    trim(lower(details)) AS details,
    regexp_replace(transaction_id, '[''\\s]', '', 'g') AS transaction_id,
    {number('transaction_amount')} AS transaction_amount,
    trim(transaction_currency) AS transaction_currency,
    {number('blocked_amount')} AS blocked_amount,
    trim(blocked_currency) AS blocked_currency,
    {number('foreign_payment_amount')} AS foreign_payment_amount,
    trim(foreign_payment_currency) AS foreign_payment_currency,
    trim(account) AS account,
    {number('balance_after_transaction', 'DOUBLE')} AS balance_after_transaction
  FROM raw WHERE {day('transaction_date')} IS NOT NULL)"""

_P = {k: quote(v) for k, v in PATTERNS.items()}
CLASSED = f"""methods AS (
  SELECT *, CASE
    WHEN details LIKE '%kantor%' OR details LIKE 'przelew kurs%' THEN 'currency_exchange'
    WHEN details LIKE 'tr.kart%' THEN 'card'
    WHEN details LIKE '%blik%' THEN 'blik'
    WHEN details LIKE 'przelew sepa%' THEN 'sepa_transfer'
    WHEN details LIKE 'przelew%' THEN 'transfer'
    WHEN details IS NULL OR details = '' THEN 'pending'
    ELSE 'other' END AS payment_method FROM typed),
events_of AS (
  SELECT *, CASE
    WHEN payment_method = 'currency_exchange' THEN 'fx_swap'
    WHEN payment_method IN ('sepa_transfer', 'transfer') AND
      (counterparty_details LIKE {_P['own_name_investment_pattern']} OR account_number = {_P['investment_iban']})
      THEN 'investment_outflow'
    WHEN description = 'own transfer' OR counterparty_details LIKE '%revolut%'
      OR regexp_matches(counterparty_details, {_P['own_name_rlike']}) THEN 'internal_transfer'
    WHEN counterparty_details LIKE '%spłata zadłużenia karty kredytowej%'
      OR description LIKE '%credit card repayment%' THEN 'credit_card_repayment'
    WHEN description LIKE '%rata kredytu%' THEN 'loan_repayment'
    WHEN counterparty_details LIKE {_P['employer_name']} OR description LIKE '%wynagrodzenie%' THEN 'income_salary'
    WHEN counterparty_details LIKE {_P['consulting_client']} THEN 'income_consulting'
    WHEN regexp_matches(counterparty_details, {_P['family_member_rlike']}) AND description LIKE '%vendita%'
      THEN 'income_sale'
    WHEN counterparty_details LIKE {_P['spouse_like']} OR counterparty_details LIKE {_P['spouse_like_alt']}
      OR regexp_matches(counterparty_details, {_P['family_member_rlike']}) THEN 'transfer_family'
    WHEN description LIKE '%obc.podatek%' OR counterparty_details LIKE '%urząd skarbowy%'
      OR counterparty_details LIKE '%ministerstwo finansow%' THEN 'expense_tax'
    WHEN description LIKE '%blokada%' THEN 'expense'
    WHEN payment_method = 'pending' THEN 'pending_block'
    WHEN payment_method IN ('card', 'blik', 'transfer', 'sepa_transfer') THEN 'expense'
    ELSE 'unclassified' END AS event_type FROM methods),
silver AS (SELECT *, event_type IN ('expense', 'expense_tax') AS include_in_expense FROM events_of)"""
SILVER = f"{RAW}, {TYPED}, {CLASSED}"

# Cleaning. RE2 has no Unicode word boundary, so the neighbours are captured and
# kept; a second pass finds matches whose neighbour the first one consumed.
_IN = "[\\p{L}\\p{N}_]"
_OUT = "[^\\p{L}\\p{N}_]"


def _bounded(x: str, pattern: str, after: str | None = None) -> str:
    after = f"($|{_OUT})" if after is None else after
    for _ in range(2):
        x = f"regexp_replace({x}, '(^|{_OUT})(?:{pattern}){after}', '\\1 \\2', 'g')"
    return x


def cleaned(x: str) -> str:
    x = f"lower(coalesce({x}, ''))"
    x = f"regexp_replace({x}, '\\S+\\.(eu|pl|com|de)\\S*', ' ', 'g')"
    x = f"regexp_replace({x}, '[+\\p{{Nd}}][\\p{{Nd}}\\s]{{6,}}', ' ', 'g')"
    x = f"regexp_replace({x}, '(^|{_OUT})(?:ul\\.|al\\.?|street|str\\.|via)\\s+.*$', '\\1 ', 'g')"
    dotted = "sp\\.?\\s*z\\s*o\\.?\\s*o\\.|s\\.?a\\.|sp\\.?\\s*[jk]\\."
    x = _bounded(x, dotted, f"({_IN})")
    x = _bounded(
        x,
        "spółka z ograniczoną odpowiedzialnością|sp\\.?\\s*z\\s*o\\.?\\s*o|s\\.?a|sp\\.?\\s*[jk]|a/s|gmbh|ltd|inc|llc",
    )
    x = _bounded(x, "\\p{Nd}{2}-\\p{Nd}{3}|\\p{Nd}{5}")
    x = _bounded(
        x,
        "krak[oó]w[a]?|warsaw|warszawa|katowice|sopot|balice|pozna[ńn]|frankfurt am main|copenhagen|amsterdam|issy-les-moul",
    )
    x = f"regexp_replace({x}, '\\s+(?:pol|pl|po|fra|usa|de|n)\\s*$', ' ')"
    return f"trim(regexp_replace({stripped(x)}, '\\s+', ' ', 'g'), ' ,.-')"


def stripped(x: str) -> str:
    return f"strip_accents(replace(replace({x}, 'ł', 'l'), 'Ł', 'L'))"


# Similarity


def lcs(a: str, b: str) -> str:
    mask = (
        f"list_sum(list_transform(range(length({b})), lambda i: "
        f"CASE WHEN substr({b}, CAST(i AS INT) + 1, 1) = c THEN (1::HUGEINT << CAST(i AS INT)) ELSE 0::HUGEINT END))::HUGEINT"
    )
    full = f"((1::HUGEINT << CAST(length({b}) AS INT)) - 1)"
    state = (
        f"list_reduce(list_transform(string_split({a}, ''), lambda c: {mask}), "
        f"lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}, {full})"
    )
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({b}) - bit_count({state}) END"


def tokens(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')))"


def keyword_rows(keywords: list[str]) -> str:
    return ", ".join(f"({quote(k)}, {at})" for at, k in enumerate(keywords))


def token_set_ctes(texts: str, keywords: str) -> str:
    """whole(text, keyword, pos, score >= 80) of `texts`(text) and `keywords`(keyword, pos)."""
    return f"""txt AS (SELECT DISTINCT text FROM ({texts}) WHERE text <> ''),
ttok AS (SELECT text, {tokens('text')} AS ta FROM txt),
ktok AS (SELECT keyword, pos, {tokens('keyword')} AS tb FROM ({keywords})),
sets AS (
  SELECT text, keyword, pos, len(ta) AS na, len(tb) AS nb,
    list_filter(ta, lambda t: list_contains(tb, t)) AS shared,
    list_filter(ta, lambda t: NOT list_contains(tb, t)) AS oa,
    list_filter(tb, lambda t: NOT list_contains(ta, t)) AS ob
  FROM ttok, ktok),
joins AS (
  SELECT text, keyword, pos, na, nb, len(shared) AS nshared, length(array_to_string(shared, ' ')) AS s,
    array_to_string(oa, ' ') AS a, array_to_string(ob, ' ') AS b FROM sets),
sums AS (SELECT *, 2 * (s + (s > 0)::INT) + length(a) + length(b) AS total FROM joins),
ranked AS (
  SELECT text, keyword, pos, s, a, b, total,
    CASE WHEN na = 0 OR nb = 0 THEN 0.0 WHEN nshared > 0 AND (a = '' OR b = '') THEN 100.0
      WHEN abs(length(a) - length(b)) * 5 > total THEN 0.0 END AS known FROM sums),
chars AS (
  SELECT text, keyword, pos, s, a, b, total, known,
    CASE WHEN known IS NULL THEN 100.0::DOUBLE - 100.0::DOUBLE * (length(a) + length(b) - 2 * ({lcs('a', 'b')})) / total
      ELSE known END AS r FROM ranked),
whole AS (
  SELECT text, keyword, pos, CAST(greatest(r,
    CASE WHEN s > 0 AND coalesce(known, 1) <> 100 THEN 100.0::DOUBLE - 100.0::DOUBLE * (1 + length(a)) / (2 * s + 1 + length(a)) ELSE 0 END,
    CASE WHEN s > 0 AND coalesce(known, 1) <> 100 THEN 100.0::DOUBLE - 100.0::DOUBLE * (1 + length(b)) / (2 * s + 1 + length(b)) ELSE 0 END)
    AS DOUBLE) AS score
  FROM chars)"""


def word_ctes(texts: str, keywords: str) -> str:
    """words(text, token_at, word) and hits(word, keyword, pos, score >= 80)."""
    return f"""lists AS (SELECT DISTINCT text, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM ({texts}) WHERE text <> ''),
words AS (SELECT text, unnest(ws) AS word, generate_subscripts(ws, 1) AS token_at FROM lists),
uniq AS (SELECT DISTINCT word FROM words),
near AS (
  SELECT word, keyword, pos FROM uniq, ({keywords})
  WHERE length(keyword) > 0 AND 5 * abs(length(word) - length(keyword)) <= length(word) + length(keyword)),
ratios AS (
  SELECT word, keyword, pos,
    100.0::DOUBLE - 100.0::DOUBLE * (length(word) + length(keyword) - 2 * ({lcs('word', 'keyword')}))
      / (length(word) + length(keyword)) AS score FROM near),
hits AS (SELECT * FROM ratios WHERE score >= 80)"""


def best_keyword_ctes(texts: str, keywords: str) -> str:
    return f"""{token_set_ctes(texts, keywords)}, {word_ctes(texts, keywords)},
scored AS (
  SELECT text, keyword, pos, score, 0 AS token_at FROM whole WHERE score >= 80
  UNION ALL
  SELECT text, keyword, pos, score, token_at FROM words JOIN hits USING (word)),
best AS (
  SELECT text, keyword, pos, score FROM scored
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY score DESC, token_at, pos) = 1)"""


KEYWORD_LABELS = [
    (keyword, sub, category)
    for sub, keywords in TRAINING.items()
    for keyword in keywords
    for category, subs in CATEGORIES.items()
    if sub in subs
]
KEYWORDS = [k for k, _, _ in KEYWORD_LABELS]
KW = f"SELECT * FROM (VALUES {keyword_rows(KEYWORDS)}) t(keyword, pos)"
NAMES = f"SELECT * FROM (VALUES {keyword_rows(ALIASES + KEYWORDS)}) t(keyword, pos)"
LABELS = "SELECT * FROM (VALUES {}) t(keyword, subcategory, category)".format(
    ", ".join(f"({quote(k)}, {quote(s)}, {quote(c)})" for k, s, c in KEYWORD_LABELS)
)
_TEXTS = "SELECT counterparty_details AS text FROM silver UNION ALL SELECT description FROM silver"
CATEGORISED = f"""{best_keyword_ctes(_TEXTS, KW)},
labels AS ({LABELS}),
categorised AS (
  SELECT s.*, coalesce(l.category, 'Unclassified') AS category, coalesce(l.subcategory, 'Unclassified') AS subcategory
  FROM silver s
  LEFT JOIN best p ON p.text = s.counterparty_details
  LEFT JOIN best d ON d.text = s.description
  LEFT JOIN labels l ON l.keyword =
    CASE WHEN d.score > coalesce(p.score, -1) THEN d.keyword ELSE p.keyword END)"""
NAMED = f"""{token_set_ctes('SELECT counterparty_details AS text FROM silver', NAMES)},
named AS (
  SELECT text, keyword FROM whole WHERE score >= 80
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY score DESC, length(keyword) DESC, pos) = 1)"""


def category_sk(category: str, sub: str) -> str:
    norm = f"replace(replace(lower({sub}), ' ', '_'), '/', '_')"
    return (
        f"CASE WHEN starts_with({norm}, lower({category}) || '_') THEN {norm} "
        f"ELSE lower({category}) || '_' || {norm} END"
    )


SK = f"CASE WHEN category = 'Unclassified' THEN 'unclassified' ELSE {category_sk('category', 'subcategory')} END"


def name_sk(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 'unknown' ELSE substr(sha256({x}), 1, 16) END"


def date_sk(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INT)"


# The two matchers use the same CTE names, so each is kept in a query of its own.
STAR = f"""WITH {SILVER},
canon AS (
  WITH {NAMED}
  SELECT DISTINCT t.text, coalesce({stripped('n.keyword')}, {cleaned('t.text')}) AS name
  FROM (SELECT DISTINCT counterparty_details AS text FROM silver) t LEFT JOIN named n ON n.text = t.text),
cats AS (WITH {CATEGORISED} SELECT o_orderkey, {SK} AS category_sk FROM categorised),
enriched AS (
  SELECT s.*, coalesce(c.name, '') AS name, k.category_sk
  FROM silver s LEFT JOIN canon c ON c.text = s.counterparty_details JOIN cats k USING (o_orderkey)),
fact_expenses AS (
  SELECT transaction_sk, {date_sk('transaction_date')} AS date_sk, CAST(year(transaction_date) AS INT) AS year,
    {name_sk('name')} AS counterparty_sk, category_sk, payment_method AS payment_method_sk,
    abs(transaction_amount) AS amount, transaction_currency AS currency
  FROM enriched WHERE include_in_expense AND payment_method <> 'pending'),
fact_income AS (
  SELECT transaction_sk, {date_sk('transaction_date')} AS date_sk, CAST(year(transaction_date) AS INT) AS year,
    {name_sk('name')} AS counterparty_sk, transaction_amount AS amount, transaction_currency AS currency,
    replace(event_type, 'income_', '') AS source
  FROM enriched WHERE event_type IN ('income_salary', 'income_consulting', 'income_sale')),
parties AS (SELECT DISTINCT {name_sk('name')} AS counterparty_sk, name AS counterparty_details FROM enriched
  UNION SELECT 'unknown', '')"""

CALENDAR = """calendar AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_sk, CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year,
    CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
    CAST(week(d) AS INT) AS week_of_year, CAST(isodow(d) AS INT) AS day_of_week, dayname(d) AS day_name,
    isodow(d) >= 6 AS is_weekend
  FROM (SELECT unnest(generate_series(make_date(CAST(min(year(o_orderdate)) AS INT), 1, 1)::TIMESTAMP,
    make_date(CAST(max(year(o_orderdate)) AS INT), 12, 31)::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM orders))"""

N_CATEGORIES = sum(map(len, CATEGORIES.values())) + 1


def _placed(columns: list[str]) -> str:
    """Header names in file order after suffixing, as a list literal."""
    seen: dict[str, int] = {}
    names = []
    for c in columns:
        header = ledger.HEADER_OF_COLUMN[c]
        names.append(header if header not in seen else f"{header}_{seen[header]}")
        seen[header] = seen.get(header, 0) + 1
    return "[" + ", ".join(map(quote, names)) + "]"


_BAD = f"({ledger.WITHOUT_TITLE}, {ledger.WITHOUT_COUNT}, {ledger.QUOTED_COUNT}, {ledger.WIDE_ROWS})"
_SHORT = f"({', '.join(map(str, ledger.WITHOUT_BALANCE))})"
_CELLS = ", ".join(
    f"CASE WHEN n_nationkey IN {_SHORT} THEN NULL ELSE {c} END AS {c}"
    if c.startswith("balance")
    else f"coalesce({c}, '') AS {c}"
    if c in ledger.QUOTED
    else f"nullif({c}, '') AS {c}"
    for c in BUSINESS_COLUMNS
)
_FILES = f"{JOINED}, files AS (SELECT n_nationkey, {ledger.SOURCE_FILE} AS source_file, count(*) AS n FROM joined GROUP BY ALL)"
_DECLARED = f"""CASE WHEN n_nationkey IN ({ledger.WITHOUT_COUNT}, {ledger.QUOTED_COUNT}) THEN NULL
    WHEN n_nationkey = {ledger.HIGH_COUNT} THEN n + 1 ELSE n END"""


def check(name: str, violations: str, source: str, passed: str | None = None) -> str:
    passed = f"({violations}) = 0" if passed is None else passed
    return (
        f"SELECT {quote(name)} AS check_name, {passed} AS passed, CAST({violations} AS BIGINT) AS violations FROM {source}"
    )


_PENDING = "sum(CASE WHEN include_in_expense AND payment_method = 'pending' THEN abs(transaction_amount) END)"
_LEFT_OVER = f"""(SELECT coalesce(sum(abs(transaction_amount)), 0)
  - coalesce(sum(CASE WHEN NOT include_in_expense THEN abs(transaction_amount) END), 0) - coalesce({_PENDING}, 0) AS x FROM silver)"""


def reconciliation(where: str = "true") -> str:
    gap = f"abs((SELECT x FROM {_LEFT_OVER}) - coalesce(sum(amount), 0)) >= 0.01"
    return check("reconciliation", f"({gap})::INT", f"fact_expenses WHERE {where}")


_METHODS = "(VALUES " + ", ".join(f"({quote(m)})" for m in PAYMENT_METHODS) + ") v(m)"
_EXCLUDED = "(SELECT coalesce(sum(abs(transaction_amount)), 0) FROM silver WHERE NOT include_in_expense)"
_PAIRS = ", ".join(f"({quote(c)}, {quote(x)})" for c, subs in CATEGORIES.items() for x in subs)
_CATEGORY_ROWS = f"(VALUES {_PAIRS}, ('Unclassified', 'Unclassified')) c(category, subcategory)"
_MONTHS = f"""{STAR}, named AS (SELECT DISTINCT category, {SK} AS sk FROM {_CATEGORY_ROWS}),
months AS (SELECT CAST(date_sk // 10000 AS INT) AS year, CAST(date_sk // 100 % 100 AS INT) AS month, category, amount
           FROM fact_expenses JOIN named ON sk = category_sk)"""


_STAR_SIZES = f"""{STAR} SELECT 'fact_expenses' AS table_name, count(*) AS n FROM fact_expenses
            UNION ALL SELECT 'fact_income', count(*) FROM fact_income
            UNION ALL SELECT 'dim_category', {N_CATEGORIES}
            UNION ALL SELECT 'dim_date', date_diff('day', make_date(CAST(min(year(transaction_date)) AS INT), 1, 1),
              make_date(CAST(max(year(transaction_date)) AS INT), 12, 31)) + 1 FROM silver
            UNION ALL SELECT 'dim_counterparty', count(*) FROM parties
            UNION ALL SELECT 'dim_payment_method', 7"""
_TYPED_BY_YEAR = f"""WITH {RAW}, {TYPED} SELECT CAST(year(transaction_date) AS INT) AS year, count(*) AS n,
  CAST(sum(transaction_amount) AS DOUBLE) AS amount FROM (@rows) WHERE transaction_date IS NOT NULL GROUP BY 1"""


def _broken_gate() -> str:
    def orphans(name: str, fact: str, lost: str) -> str:
        return check(name, f"count(*) FILTER (WHERE {lost})", fact)

    keys = "date_sk, counterparty_sk, category_sk, payment_method_sk"
    other_year = "(date_sk IS NULL OR date_sk // 10000 > (SELECT min(year) FROM calendar))"
    nulled = "category_sk IS NULL"
    checks = [
        check("dim_category.category_sk unique", "count(*)", f"{_CATEGORY_ROWS} WHERE {SK} <> 'unclassified'"),
        check("dim_counterparty.counterparty_sk unique", "count(*)", f"parties WHERE NOT {LOST_PARTIES}"),
        check("dim_date.date_sk unique", "count(*)", "calendar WHERE year = (SELECT min(year) FROM calendar)"),
        check("dim_payment_method.payment_method_sk unique", "count(*)", f"{_METHODS} WHERE m <> {quote(LOST_METHOD)}"),
        orphans("fact_expenses.category_sk in dim_category", "spent", f"{nulled} OR category_sk = 'unclassified'"),
        orphans("fact_expenses.counterparty_sk in dim_counterparty", "spent", LOST_PARTIES),
        orphans("fact_expenses.date_sk in dim_date", "spent", other_year),
        orphans("fact_expenses.payment_method_sk in dim_payment_method", "spent", f"payment_method_sk = {quote(LOST_METHOD)}"),
        orphans("fact_income.counterparty_sk in dim_counterparty", "earned", LOST_PARTIES),
        orphans("fact_income.date_sk in dim_date", "earned", other_year),
        orphans(f"fact_expenses non-null ({keys})", "spent", nulled),
        orphans("fact_income non-null (date_sk, counterparty_sk)", "earned", "date_sk IS NULL"),
        orphans("fact_expenses.amount >= 0", "spent", "amount < 0"),
        check("fact_expenses dates in dim_date", "(max(date_sk) // 10000 > (SELECT min(year) FROM calendar))::INT", "spent"),
        check("fact_income dates in dim_date", "coalesce(max(date_sk) // 10000 > (SELECT min(year) FROM calendar), false)::INT", "earned"),
        reconciliation().replace("FROM fact_expenses", "FROM spent"),
    ]
    spent = f"""spent AS (SELECT * REPLACE (CASE WHEN NOT ({NULLED}) THEN category_sk END AS category_sk,
      CASE WHEN {NEGATED} THEN -amount ELSE amount END AS amount) FROM fact_expenses)"""
    earned = f"earned AS (SELECT * REPLACE (CASE WHEN NOT ({NULLED}) THEN date_sk END AS date_sk) FROM fact_income)"
    return f"{STAR}, {CALENDAR}, {spent}, {earned} " + " UNION ALL ".join(checks)


def _gate() -> str:
    def anti(fact: str, key: str, dim: str) -> str:
        known = {
            "dim_category": f"(SELECT {SK} AS k FROM {_CATEGORY_ROWS})",
            "dim_counterparty": "(SELECT counterparty_sk AS k FROM parties)",
            "dim_date": "(SELECT date_sk AS k FROM calendar)",
            "dim_payment_method": f"(SELECT m AS k FROM {_METHODS})",
        }[dim]
        return check(f"{fact}.{key} in {dim}", f"count(*) FILTER (WHERE {key} NOT IN (SELECT k FROM {known}))", fact)

    def nulls(fact: str, keys: list[str]) -> str:
        return check(
            f"{fact} non-null ({', '.join(keys)})",
            f"count(*) FILTER (WHERE {' OR '.join(k + ' IS NULL' for k in keys)})",
            fact,
        )

    expense_keys = ["date_sk", "counterparty_sk", "category_sk", "payment_method_sk"]
    checks = [
        check("dim_category.category_sk unique", f"count({SK}) - count(DISTINCT {SK})", _CATEGORY_ROWS),
        check("dim_counterparty.counterparty_sk unique", "count(*) - count(DISTINCT counterparty_sk)", "parties"),
        check("dim_date.date_sk unique", "count(*) - count(DISTINCT date_sk)", "calendar"),
        check("dim_payment_method.payment_method_sk unique", "count(*) - count(DISTINCT m)", _METHODS),
        anti("fact_expenses", "category_sk", "dim_category"),
        anti("fact_expenses", "counterparty_sk", "dim_counterparty"),
        anti("fact_expenses", "date_sk", "dim_date"),
        anti("fact_expenses", "payment_method_sk", "dim_payment_method"),
        anti("fact_income", "counterparty_sk", "dim_counterparty"),
        anti("fact_income", "date_sk", "dim_date"),
        nulls("fact_expenses", expense_keys),
        nulls("fact_income", ["date_sk", "counterparty_sk"]),
        check("fact_expenses.amount >= 0", "count(*) FILTER (WHERE amount < 0)", "fact_expenses"),
        check("fact_expenses dates in dim_date", "count(*) FILTER (WHERE date_sk NOT IN (SELECT date_sk FROM calendar))", "fact_expenses"),
        check("fact_income dates in dim_date", "count(*) FILTER (WHERE date_sk NOT IN (SELECT date_sk FROM calendar))", "fact_income"),
        reconciliation(),
    ]
    return f"{STAR}, {CALENDAR} " + " UNION ALL ".join(checks)


_LINE_KEY = "concat_ws('-', l_orderkey, l_linenumber)"
_BY_YEAR = """SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1"""
_DATES_CHECK = "(SELECT min({0}) AS lo, max({0}) AS hi FROM lineitem) f, (SELECT min(date_sk) AS dlo, max(date_sk) AS dhi FROM calendar {1}) d"


def _dates_check(name: str, where: str) -> str:
    source = _DATES_CHECK.format(date_sk("l_shipdate"), where)
    return f"""SELECT {quote(name + ' dates in dim_date')} AS check_name, dlo <= lo AND dhi >= hi AS passed,
      CAST(NOT (dlo <= lo AND dhi >= hi) AS BIGINT) AS violations,
      concat('fact=[', lo, ', ', hi, '], dim=[', dlo, ', ', dhi, ']') AS detail FROM {source}"""


def oracle() -> dict[str, str]:
    doubles = ["transaction_amount", "blocked_amount", "foreign_payment_amount"]
    as_double = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in doubles)
    text_kw = f"SELECT * FROM (VALUES {keyword_rows(TEXT_KEYWORDS)}) t(keyword, pos)"
    talk = "SELECT text FROM conversations"
    part_texts = f"{talk} UNION ALL SELECT concat_ws(' ', p_name, p_brand, p_type) AS text FROM part"
    part_kw = "SELECT p_name AS keyword, min(p_partkey) AS pos FROM part GROUP BY 1"
    return {
        "content_hash": "SELECT doc_id, sha256(text) AS hash FROM documents",
        "export_headers": f"""WITH {_FILES} SELECT source_file, CAST(2 AS BIGINT) AS header_seq,
            {_DECLARED} AS declared, 'utf-8' AS charset,
            CAST(CASE WHEN n_nationkey IN {_SHORT} THEN 15 ELSE 17 END AS INT) AS n_columns FROM files""",
        "export_header_names": f"""WITH {_FILES}, named AS (SELECT source_file, n_nationkey,
            {ledger.by_layout(_placed)} AS names FROM files)
            SELECT source_file, CAST(generate_subscripts(names, 1) - 1 AS INT) AS at,
              CASE WHEN n_nationkey = {ledger.WITHOUT_TITLE} THEN replace(unnest(names), 'Tytuł', 'Opis')
                ELSE unnest(names) END AS name FROM named""",
        "export_rows": f"""WITH {RAW} SELECT _source_file, o_orderkey, {_CELLS} FROM raw WHERE n_nationkey NOT IN {_BAD}
            UNION ALL SELECT DISTINCT _source_file, 0, {_FOOTER} FROM raw WHERE n_nationkey NOT IN {_BAD}""",
        "export_file_rows": f"""WITH {FILES} SELECT _source_file, {_FILE_CELLS} FROM raw
            UNION ALL SELECT DISTINCT _source_file, {_PLAIN_FOOTER} FROM raw""",
        "export_files": f"""WITH {FILES}, counted AS (SELECT n_nationkey, _source_file AS source_file, count(*) AS n,
              count({day('transaction_date')}) AS typed FROM raw GROUP BY ALL),
            texts AS (SELECT n_nationkey, 1 AS part, o_orderkey AS seq, {_FILE_SQL['row']} AS line FROM raw
              UNION ALL SELECT n_nationkey, 0, 0, '"Bank";' FROM counted
              UNION ALL SELECT n_nationkey, 0, 1, {_FILE_SQL['count']} FROM counted
              UNION ALL SELECT n_nationkey, 0, 2, {_FILE_SQL['header']} FROM counted
              UNION ALL SELECT n_nationkey, 2, 0, {_FILE_SQL['footer']} FROM counted),
            lines AS (SELECT n_nationkey, row_number() OVER (PARTITION BY n_nationkey ORDER BY part, seq, k) - 1 AS no, sha256(line) AS digest
              FROM (SELECT n_nationkey, part, seq, unnest(string_split(line, chr(10))) AS line,
                unnest(range(len(string_split(line, chr(10))))) AS k FROM texts)),
            groups AS (SELECT n_nationkey, no // 10000 AS g, sha256(string_agg(digest, '' ORDER BY no)) AS digest FROM lines GROUP BY ALL),
            hashes AS (SELECT n_nationkey, sha256(string_agg(digest, '' ORDER BY g)) AS hash FROM groups GROUP BY ALL)
            SELECT source_file, CASE WHEN {ledger.ONE_BYTE} THEN 'cp1250' ELSE 'utf-8' END AS charset, n AS declared,
              true AS accepted, typed, typed AS stamped, {len(BUSINESS_COLUMNS)} + CASE WHEN {ledger.MORE_CELLS} THEN 2 ELSE 0 END AS n_columns,
              CASE WHEN NOT {ledger.ONE_BYTE} THEN hash END AS hash FROM counted JOIN hashes USING (n_nationkey)""",
        "export_quarantine": f"""WITH {_FILES} SELECT source_file, CASE
            WHEN n_nationkey = {ledger.QUOTED_COUNT} THEN 'row count is not a number'
            WHEN n_nationkey = {ledger.WITHOUT_COUNT} THEN 'header or row count not found'
            WHEN n_nationkey = {ledger.WITHOUT_TITLE} THEN 'missing mandatory columns: Tytuł'
            ELSE 'a row is wider than the header' END AS reason FROM files WHERE n_nationkey IN {_BAD}""",
        "export_control_totals": f"""WITH {RAW}, kept AS (SELECT n_nationkey, _source_file, count(*) AS n,
            count({day('transaction_date')}) AS kept FROM raw WHERE n_nationkey NOT IN {_BAD} GROUP BY ALL)
            SELECT _source_file, {_DECLARED} AS declared, kept, {_DECLARED} - kept AS difference FROM kept""",
        "rows_by_sql_view": f"""WITH {RAW} SELECT _source_file, transaction_currency, count(*) AS n
            FROM raw GROUP BY ALL""",
        "batches_by_name": f"""WITH {RAW} SELECT _source_file, count(*) AS n, count(transaction_id) AS n_ids
            FROM raw GROUP BY ALL""",
        "lenient_dates": f"""WITH {RAW} SELECT o_orderkey, {day('transaction_date')} AS transaction_date,
            {REAL_DAY} AND regexp_full_match(trim(transaction_date), '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') AS is_real FROM raw""",
        "typed_rows": f"WITH {RAW}, {TYPED} SELECT * EXCLUDE (n_nationkey, {', '.join(doubles)}), {as_double} FROM typed",
        "content_keys": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
            substr(sha256(concat_ws('~', l_orderkey, l_partkey, l_suppkey, l_linenumber)), 1, 32) AS line_sk FROM lineitem""",
        "rejected_casts": f"""WITH {RAW}, c AS (SELECT
            count(*) FILTER (WHERE posting_date IS NOT NULL AND {exact_day('posting_date')} IS NULL) AS posting_date,
            count(*) FILTER (WHERE transaction_amount IS NOT NULL AND {number('transaction_amount')} IS NULL) AS transaction_amount,
            count(*) FILTER (WHERE blocked_amount IS NOT NULL AND {number('blocked_amount')} IS NULL) AS blocked_amount,
            count(*) FILTER (WHERE foreign_payment_amount IS NOT NULL AND {number('foreign_payment_amount')} IS NULL) AS foreign_payment_amount,
            count(*) FILTER (WHERE {number('balance_after_transaction', 'DOUBLE')} IS NULL) AS balance_after_transaction,
            count(*) FILTER (WHERE {exact_day('transaction_date')} IS NULL) AS transaction_date FROM raw)
            UNPIVOT c ON COLUMNS(*) INTO NAME column_name VALUE rejected""",
        "classified_rows": f"WITH {SILVER} SELECT o_orderkey, payment_method, event_type, include_in_expense FROM silver",
        "latest_events": """SELECT event_id, CAST(ts AS DATE) AS day, event_type, value FROM events
            WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) FROM events) - INTERVAL 7 DAY""",
        "lost_rows": f"""WITH {RAW} SELECT o_orderkey, transaction_date FROM raw
            WHERE {day('transaction_date')} IS NULL AND regexp_full_match(transaction_date, '[0-9]{{4}}-[0-9]+-[0-9]+')""",
        "unparsed_dates": f"""WITH {RAW} SELECT _source_file, count(*) AS n FROM raw
            WHERE {day('transaction_date')} IS NULL AND regexp_full_match(transaction_date, '[0-9]{{4}}-[0-9]+-[0-9]+') GROUP BY 1""",
        "single_lines": """SELECT substr(sha256(concat_ws('~', l_orderkey, l_linenumber)), 1, 32) AS line_sk,
            l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) = 1""",
        "clean_documents": f"SELECT doc_id, {cleaned('text')} AS cleaned FROM documents",
        "plain_documents": f"SELECT doc_id, {stripped('lower(text)')} AS stripped FROM documents",
        "clean_parties": f"WITH {RAW} SELECT o_orderkey, {cleaned('counterparty_details')} AS cleaned FROM raw",
        "canonical_names": f"""WITH {SILVER}, {NAMED} SELECT counterparty_details,
            coalesce({stripped('keyword')}, {cleaned('counterparty_details')}) AS canonical, count(*) AS n
            FROM silver LEFT JOIN named ON text = counterparty_details GROUP BY ALL""",
        "vocabulary_labels": """WITH parents AS (SELECT p_brand AS subcategory, arg_max(p_type, p_partkey) AS category
              FROM part GROUP BY 1),
            kws AS (SELECT p_name AS keyword, arg_max(p_brand, p_partkey) AS subcategory, min(p_partkey) AS pos FROM part GROUP BY 1)
            SELECT keyword, subcategory, category, pos FROM kws JOIN parents USING (subcategory)""",
        "vocabulary_repeats": """SELECT p_name AS keyword, count(DISTINCT p_brand) AS subcategories,
            arg_max(p_brand, p_partkey) AS applied FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""",
        "vocabulary_unknown": """SELECT DISTINCT c_mktsegment AS subcategory FROM customer
            WHERE c_mktsegment NOT IN (SELECT p_brand FROM part)""",
        "token_set_pairs": f"""WITH {token_set_ctes(part_texts, part_kw)}
            SELECT substr(sha256(text), 1, 32) AS text_id, keyword, score FROM whole WHERE score >= 80""",
        "word_matches": f"WITH {word_ctes(talk, text_kw)} SELECT word AS string, keyword, score FROM hits",
        "best_keywords": f"""WITH {best_keyword_ctes(talk, text_kw)}
            SELECT substr(sha256(text), 1, 32) AS text_id, keyword, score FROM best""",
        "row_categories": f"WITH {SILVER}, {CATEGORISED} SELECT o_orderkey, category, subcategory FROM categorised",
        "category_map": f"""WITH {SILVER}, {CATEGORISED} SELECT o_orderkey, {SK} AS category_sk
            FROM categorised WHERE include_in_expense""",
        "unclassified_rate": f"""{STAR} SELECT count(*) AS facts,
            count(*) FILTER (WHERE category_sk = 'unclassified') AS unclassified,
            count(*) FILTER (WHERE category_sk = 'unclassified') / count(*) AS rate FROM fact_expenses""",
        "date_keys": f"SELECT o_orderkey, {date_sk('o_orderdate')} AS date_sk FROM orders",
        "calendar": f"WITH {CALENDAR} SELECT * FROM calendar",
        "method_groups": f"""WITH {SILVER} SELECT payment_method, CASE
            WHEN payment_method IN ('card', 'blik', 'transfer') THEN 'consumer'
            WHEN payment_method IN ('sepa_transfer', 'currency_exchange') THEN 'wire'
            ELSE payment_method END AS payment_category, count(*) AS n FROM silver GROUP BY ALL""",
        "party_dimension": f"""WITH {SILVER}, n AS (SELECT DISTINCT {cleaned('counterparty_details')} AS name FROM silver
            UNION SELECT '') SELECT {name_sk('name')} AS counterparty_sk, name AS counterparty_details FROM n""",
        "category_dimension": f"""WITH c AS (SELECT DISTINCT p_type AS category, concat(p_type, ' ', p_brand) AS subcategory FROM part)
            SELECT {category_sk('category', 'subcategory')} AS category_sk, category, subcategory FROM c
            UNION ALL SELECT 'unclassified', 'Unclassified', 'Unclassified'""",
        "category_key_collisions": f"""WITH c AS (SELECT p_brand AS category, p_name AS subcategory FROM part
            UNION SELECT p_brand, replace(p_name, 'red ', 'red/') FROM part)
            SELECT {category_sk('category', 'subcategory')} AS category_sk, count(*) AS members FROM c GROUP BY 1 HAVING count(*) > 1""",
        "party_keys": f"""WITH {SILVER}, n AS (SELECT o_orderkey, {cleaned('counterparty_details')} AS name FROM silver)
            SELECT o_orderkey, {name_sk('name')} AS counterparty_sk FROM n""",
        "fact_expenses": f"{STAR} SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount FROM fact_expenses",
        "fact_income": f"{STAR} SELECT * EXCLUDE (amount), CAST(amount AS DOUBLE) AS amount FROM fact_income",
        "star_sizes": _STAR_SIZES,
        "published_star": _STAR_SIZES,
        "expense_report": f"""{STAR}, named AS (SELECT DISTINCT category, subcategory, {SK} AS sk FROM
              (SELECT category, subcategory FROM ({LABELS}) UNION SELECT 'Unclassified', 'Unclassified'))
            SELECT strftime(strptime(CAST(date_sk AS VARCHAR), '%Y%m%d'), '%d/%m/%Y') AS date, category, subcategory,
              '' AS blank, CAST(amount AS DOUBLE) AS amount, counterparty_details AS description
            FROM fact_expenses JOIN named ON sk = category_sk JOIN parties USING (counterparty_sk)""",
        "monthly_totals": f"""{_MONTHS} SELECT year, month, category, CAST(GROUPING(year, month, category) AS INT) AS level,
            count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount FROM months GROUP BY ROLLUP (year, month, category)""",
        "category_calendar": f"{_MONTHS} SELECT year, category, " + ", ".join(
            f"CAST(sum(CASE WHEN month = {m} THEN amount ELSE 0 END) AS DOUBLE) AS m{m}" for m in range(1, 13)
        ) + " FROM months GROUP BY year, category",
        "order_report": """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter,
            c_mktsegment AS segment, count(*) AS orders, count(DISTINCT c_name) AS parties,
            CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
            FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
        "check_unique_keys": " UNION ALL ".join([
            check("orders.o_orderkey unique", "count(*) - count(DISTINCT o_orderkey)", "orders"),
            check("lineitem.line_key unique", f"count(*) - count(DISTINCT {_LINE_KEY})", "lineitem"),
        ]),
        "check_foreign_keys": " UNION ALL ".join([
            check("lineitem.l_orderkey in orders", "count(*)", "lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"),
            check("customer.c_custkey in orders", "count(*)", "customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
            check("lineitem.l_partkey in part", "count(*)", "lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)"),
            check("lineitem.l_suppkey in supplier", "count(*)", "lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"),
        ]),
        "check_values": f"WITH {RAW}, {TYPED} " + " UNION ALL ".join([
            check("ledger non-null (transaction_sk, posting_date)", "count(*) FILTER (WHERE posting_date IS NULL)", "typed"),
            check("customer.c_acctbal >= 0", "count(*) FILTER (WHERE c_acctbal < 0)", "customer"),
            check("ledger.transaction_amount >= 0", "count(*) FILTER (WHERE transaction_amount < 0)", "typed"),
        ]),
        "check_date_coverage": f"WITH {CALENDAR} " + " UNION ALL ".join([
            _dates_check("lineitem", ""),
            _dates_check("lineitem first year", "WHERE year = (SELECT min(year) FROM calendar)"),
        ]),
        "check_reconciliation": f"{STAR} {reconciliation()} UNION ALL {reconciliation(chr(39).join(['payment_method_sk <> ', 'blik', '']))}",
        "quality_gate": _gate(),
        "quality_gate_broken": _broken_gate(),
        "quality_invariants": f"{STAR} " + " UNION ALL ".join([
            check("fact_expenses.transaction_sk unique", "count(*) - count(DISTINCT transaction_sk)", "fact_expenses"),
            check("income within excluded", f"(coalesce(sum(abs(amount)), 0) > {_EXCLUDED} + 0.01)::INT", "fact_income"),
            check("dim_counterparty has one unknown", "abs(count(*) FILTER (WHERE counterparty_sk = 'unknown') - 1)", "parties"),
            check("dim_category has one unclassified", f"abs(count(*) FILTER (WHERE {SK} = 'unclassified') - 1)", _CATEGORY_ROWS),
            check("unclassified below 10%", "(count(*) FILTER (WHERE category_sk = 'unclassified') >= 0.1 * count(*))::INT", "fact_expenses"),
        ]),
        "parquet_by_year": _BY_YEAR,
        "csv_by_year": _BY_YEAR,
        "single_file_tables": "SELECT p_type, count(*) AS n, CAST(1 AS INT) AS files FROM part GROUP BY 1",
        "appended_report": _BY_YEAR,
        "loaded_by_year": _TYPED_BY_YEAR.replace("@rows", "FROM typed"),
        "streamed_by_year": _TYPED_BY_YEAR.replace("@rows", "SELECT DISTINCT transaction_sk, transaction_date, transaction_amount FROM typed"),
    }
