"""Common table expressions of the oracle SQL, mirroring ``checks.views``."""

from __future__ import annotations

from pairloom.functions.fixed_values import ENCODER_FAMILIES

LINES = """
docl AS (SELECT doc_id, lang, source, string_split(text, chr(10)) AS lns FROM documents)"""

PAIRS = LINES + """,
pw AS (SELECT doc_id * 1000000 + i AS pair_id, source AS dataset, lang, doc_id,
              lns[i] AS src, lns[i + 1] AS tgt
       FROM (SELECT *, unnest(range(1, len(lns) + 1)) AS i FROM docl)),
full_pairs AS (SELECT * FROM pw WHERE src IS NOT NULL AND tgt IS NOT NULL)"""


def deduplicated(rel: str) -> str:
    """``by_tgt``: the first rows per source, then per target, of pairs that differ."""
    return f"""
ds AS (SELECT pair_id, dataset, src, tgt FROM {rel} WHERE src <> tgt),
by_src AS (SELECT pair_id, dataset, src, tgt FROM ds
           QUALIFY row_number() OVER (PARTITION BY src ORDER BY pair_id) = 1),
by_tgt AS (SELECT pair_id, dataset, src, tgt FROM by_src
           QUALIFY row_number() OVER (PARTITION BY tgt ORDER BY pair_id) = 1)"""


MERGED = PAIRS + "," + deduplicated("full_pairs")

TEST_KEYS = """
test_keys AS (SELECT DISTINCT unnest(string_split(text, chr(10))) AS k FROM benchmark)"""

LABELLED = """
labelled AS (SELECT p.*, l.quality::DOUBLE AS quality FROM full_pairs p JOIN labels l USING (doc_id))"""

MARKUP = "<.*?>|&lt;.*?&gt;|&?(amp|nbsp|quot);|\\{\\}"
BLANK = "^[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]*$"


def tokens(x: str) -> str:
    return f"(length({x}) - length(replace({x}, ' ', '')) + 1)"


def clean(x: str) -> str:
    return f"replace(regexp_replace({x}, '{MARKUP}', ' ', 'g'), '  ', ' ')"


IDENTICAL = "src = tgt"
RATIO = f"({tokens('src')} > {tokens('tgt')} * 2.0 OR {tokens('tgt')} > {tokens('src')} * 2.0)"
MAX_TOKENS = f"({tokens('src')} > 200 OR {tokens('tgt')} > 200)"
MIN_CHARS = "(length(src) <= 3 OR length(tgt) <= 3)"


def blank(a: str, b: str) -> str:
    return f"(regexp_matches({a}, '{BLANK}') OR regexp_matches({b}, '{BLANK}'))"


def ruled(scope: str = "") -> str:
    """``ruled``: what the rule filter leaves, with cleaned texts."""
    return f"""
firsts AS (SELECT * FROM full_pairs
           QUALIFY row_number() OVER (PARTITION BY {scope} src, tgt ORDER BY pair_id) = 1),
cleaned AS (SELECT pair_id, dataset, lang, doc_id, {clean('src')} AS src, {clean('tgt')} AS tgt FROM firsts
            WHERE NOT ({IDENTICAL}) AND NOT {RATIO} AND NOT {MAX_TOKENS} AND NOT {MIN_CHARS}),
ruled AS (SELECT * FROM cleaned WHERE NOT {blank('src', 'tgt')})"""


def grams(name: str, rel: str, key: str, text: str, n: int) -> str:
    """``name``(k, b): all n-gram numbers of a text column."""
    point = " + ".join(f"cp[i + {j}] * {31 ** (n - 1 - j)}" for j in range(n))
    return f"""
{name}_cp AS (SELECT {key} AS k, [unicode(c) for c in string_split(' ' || {text} || ' ', '')] AS cp FROM {rel}),
{name} AS (SELECT k, unnest([({point}) % 65536 for i in range(1, len(cp) - {n - 2})]) AS b FROM {name}_cp)"""


def profile(name: str, n: int) -> str:
    """``name``(lang, b, w): whole-number weights learned from all documents."""
    return grams(f"{name}_g", "documents", "doc_id", "text", n) + f""",
{name}_n AS (SELECT lang, b, count(*) AS n FROM {name}_g JOIN documents ON doc_id = k GROUP BY lang, b),
{name}_t AS (SELECT lang, sum(n) AS total FROM {name}_n GROUP BY lang),
{name} AS (SELECT t.lang, r.b, round(1000 * ln((coalesce(c.n, 0) + 1)::DOUBLE / (t.total + 65536)::DOUBLE))::BIGINT AS w
           FROM {name}_t t CROSS JOIN (SELECT unnest(range(65536)) AS b) r
           LEFT JOIN {name}_n c ON c.lang = t.lang AND c.b = r.b)"""


def detect(name: str, rel: str, key: str, text: str, weights: str, n: int) -> str:
    """``name``(k, code, score) for every text."""
    return grams(f"{name}_g", rel, key, text, n) + f""",
{name}_s AS (SELECT k, w.lang, sum(w)::BIGINT AS s FROM {name}_g g JOIN {weights} w ON w.b = g.b GROUP BY k, w.lang),
{name}_m AS (SELECT k, max(s) AS m FROM {name}_s GROUP BY k),
{name} AS (SELECT s.k, arg_min(lang, (m - s.s) * 1000 + ord) AS code, 1.0 / sum(exp((s.s - m) / 1000.0::DOUBLE)) AS score
           FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY lang) AS ord FROM {name}_s) s
           JOIN {name}_m USING (k) GROUP BY s.k)"""


def embed(name: str, rel: str, key: str, text: str) -> str:
    """``name``(k, d, v): non-zero entries of the folded trigram counts."""
    return grams(f"{name}_g", rel, key, text, 3) + f""",
{name} AS (SELECT k, b % 64 AS d, count(*)::DOUBLE AS v FROM {name}_g GROUP BY k, b % 64)"""


def strip(x: str) -> str:
    # The three expressions give the text without white space at either end.
    edge = "[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+"
    return f"regexp_replace(regexp_replace({x}, '^{edge}', ''), '{edge}$', '')"


def bins(rel: str, keep: str) -> str:
    """SELECT of ``keep`` plus the two feature bins of every pair in ``rel``."""
    a, b = strip("src"), strip("tgt")
    size = " + ".join(f"(greatest({tokens('a')}, {tokens('b')}) >= {2 ** i})::INT" for i in range(1, 13))
    return f"""
SELECT {keep}, CASE WHEN greatest(length(a), length(b)) = 0 THEN 0
            ELSE floor(least(length(a), length(b)) * 20 / greatest(length(a), length(b), 1)::DOUBLE) END::INT AS ratio_bin,
       ({size})::INT AS size_bin
FROM (SELECT *, {a} AS a, {b} AS b FROM {rel})"""


QUALITY_TABLE = LABELLED + f""",
binned_labels AS ({bins('labelled', 'quality')}),
quality_table AS (SELECT ratio_bin, size_bin, (sum(quality::BIGINT) + 1)::DOUBLE / (count(*) + 2)::DOUBLE AS q
                  FROM binned_labels GROUP BY ratio_bin, size_bin)"""


def encoder_case() -> str:
    whens = []
    for family, codes in ENCODER_FAMILIES.items():
        known = ", ".join(f"'{c}'" for c in codes)
        whens.append(f"WHEN src_lang IN ({known}) AND tgt_lang IN ({known}) THEN '{family}'")
    return "CASE WHEN length(src_lang) > 2 OR length(tgt_lang) > 2 THEN NULL " + " ".join(whens) + " END"
