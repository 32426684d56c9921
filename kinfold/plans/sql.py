"""DuckDB statements for the record queries, from the record rules themselves."""

from __future__ import annotations

from kinfold.functions import fixed as X
from kinfold.operators.features import COSINES
from kinfold.operators.vectors import BINARY, SPACES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


def _map(values: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in values.items()) + "}"


def specials(x: str) -> str:
    for k, v in X.LATIN_SPECIALS.items():
        x = f"replace({x}, {_q(k)}, {_q(v)})"
    return x


def base(x: str) -> str:
    return f"strip_accents({specials(x)})"


def no_punct(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, {_q(X.PUNCTUATION)}, ' ', 'g'), {_q(X.SPACES + '+')}, ' ', 'g'))"


def lower_and(x: str) -> str:
    return f"replace(lower({x}), '&', ' and ')"


def domains(x: str) -> str:
    return f"regexp_replace({x}, {_q(X.DOMAIN)}, '\\1', 'g')"


def ordinals(x: str) -> str:
    return f"regexp_replace({x}, {_q(X.ORDINAL)}, '\\1', 'g')"


def tokens(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda t: t <> '')"


def mapped(values: dict[str, str], x: str) -> str:
    return f"coalesce({_map(values)}[{x}], {x})"


def states(x: str, country: str) -> str:
    seg = f"regexp_replace(s, {_q(f'^{X.SPACES}+|{X.SPACES}+$')}, '', 'g')"
    return f"array_to_string(list_transform(string_split({x}, ','), lambda s: CASE WHEN {country} = 'us' THEN {mapped(X.US_STATES, seg)} ELSE {seg} END), ' ')"


def expand(x: str) -> str:
    return f"list_transform({x}, lambda t: {mapped(X.ABBREVIATIONS, 't')})"


def denoise(x: str) -> str:
    return f"list_filter({x}, lambda t: NOT list_contains({_list(X.ADDRESS_NOISE)}, t))"


def core(x: str) -> str:
    kept = f"list_filter({x}, lambda t: NOT list_contains({_list(X.LEGAL_WORDS)}, t))"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE {x} END"


REC0 = "rec0 AS (SELECT 'D' || doc_id AS entity_id, coalesce(substr(text, 1, 60), '') AS business_name, coalesce(substr(text, 61, 80), '') AS business_address, coalesce(lang, '') AS country, doc_id AS _row FROM documents)"
LINE = "split_part(text, chr(10), 1)"
WHOLE0 = f"rec0 AS (SELECT 'D' || doc_id AS entity_id, coalesce({LINE}, '') AS business_name, coalesce(substr(text, length({LINE}) + 2), '') AS business_address, coalesce(lang, '') AS country, doc_id AS _row FROM documents)"
RECORDS = [
    REC0,
    f"rec1 AS (SELECT *, {base('business_name')} AS nb, {base('business_address')} AS ab, {base('country')} AS cb FROM rec0)",
    f"rec2 AS (SELECT *, {mapped(X.COUNTRY_ALIASES, no_punct(lower_and('cb')))} AS country_clean, {no_punct(domains(lower_and('nb')))} AS business_name_clean FROM rec1)",
    f"rec3 AS (SELECT *, {core(tokens('business_name_clean'))} AS core, {denoise(expand(tokens(no_punct(ordinals(lower_and(states('ab', 'country_clean')))))))} AS addr FROM rec2)",
    "rec AS (SELECT entity_id, business_name, business_address, country, _row, country_clean, business_name_clean, core, array_to_string(core, ' ') AS name_core, array_to_string(list_sort(core), ' ') AS name_core_sorted, array_to_string(core, '') AS name_squashed, array_to_string(addr, ' ') AS business_address_clean, array_to_string(list_sort(addr), ' ') AS address_sorted, CASE _row % 3 WHEN 1 THEN 'S2' WHEN 2 THEN 'S3' END AS source FROM rec3)",
    "lhs AS (SELECT * FROM rec WHERE _row % 3 = 0)",
    "rhs AS (SELECT * FROM rec WHERE _row % 3 <> 0)",
]


WHOLE = [WHOLE0, *RECORDS[1:]]


def slices(source: str, sizes: tuple[int, ...]) -> str:
    """Substrings of w in source (entity_id, w)."""
    n = ", ".join(f"({x})" for x in sizes)
    return f"SELECT entity_id, substr(w, i::BIGINT, n) AS term FROM (SELECT entity_id, w, n, unnest(generate_series(1, length(w) - n + 1)) AS i FROM ({source}) CROSS JOIN (VALUES {n}) g(n) WHERE length(w) >= n)"


def terms_of(column: str, kind: str) -> str:
    if kind == "char_wb":
        return slices(f"SELECT entity_id, ' ' || unnest({tokens(column)}) || ' ' AS w FROM rec", (2, 3, 4))
    if kind == "char":
        return slices(f"SELECT entity_id, {column} AS w FROM rec", (3, 4))
    if kind == "word":
        return f"SELECT entity_id, unnest({tokens(column)}) AS term FROM rec"
    return f"SELECT entity_id, unnest(regexp_extract_all({column}, '[0-9]+')) AS term FROM rec"


def space(s: str) -> list[str]:
    return [
        f"c_{s} AS (SELECT entity_id, term, count(*) AS tf FROM ({terms_of(*SPACES[s])}) GROUP BY ALL)",
        f"d_{s} AS (SELECT term, count(*) AS df FROM c_{s} GROUP BY term)",
        f"w_{s} AS (SELECT entity_id, term, (1 + ln(tf)) * (ln((1.0 + (SELECT count(*) FROM rec)) / (1.0 + df)) + 1) AS w FROM c_{s} JOIN d_{s} USING (term))",
        f"p_{s} AS (SELECT entity_id, term, w / norm AS weight FROM w_{s} JOIN (SELECT entity_id, sqrt(sum(w * w)) AS norm FROM w_{s} GROUP BY entity_id) USING (entity_id))",
    ]


def scores(s: str) -> str:
    return f"s_{s} AS (SELECT l.entity_id AS s1_id, r.entity_id AS r_id, sum(a.weight * b.weight) AS raw FROM p_{s} a JOIN lhs l ON l.entity_id = a.entity_id JOIN p_{s} b ON a.term = b.term JOIN rhs r ON r.entity_id = b.entity_id AND r.country_clean = l.country_clean GROUP BY ALL)"


COMBINED = f"s_combined AS (SELECT coalesce(n.s1_id, a.s1_id) AS s1_id, coalesce(n.r_id, a.r_id) AS r_id, {X.NAME_SHARE} * coalesce(n.raw, 0) + {X.ADDRESS_SHARE} * coalesce(a.raw, 0) AS raw FROM s_name_char n FULL JOIN s_addr_char a ON n.s1_id = a.s1_id AND n.r_id = a.r_id)"


def best(s: str) -> str:
    return f"k_{s} AS (SELECT s1_id, r_id, score FROM (SELECT s1_id, r_id, round(raw, 9) AS score, row_number() OVER (PARTITION BY s1_id ORDER BY round(raw, 9) DESC, r_id) AS nth FROM s_{s} WHERE round(raw, 9) >= {X.MIN_SIM[s]}) WHERE nth <= {X.TOP_K[s]})"


def signal(s: str) -> list[str]:
    if s == "combined":
        return [*space("name_char"), scores("name_char"), *space("addr_char"), scores("addr_char"), COMBINED, best(s)]
    return [*space(s), scores(s), best(s)]


_SEARCHED = ("name_char", "name_word", "name_squash", "addr_char")
CANDIDATES = [x for s in _SEARCHED for x in signal(s)] + [COMBINED, best("combined")] + ["cand AS (" + " UNION ".join(f"SELECT s1_id, r_id FROM k_{s}" for s in (*_SEARCHED, "combined")) + ")"]

TRUTH = [
    "tdoc AS (SELECT doc_id, lang, text FROM documents)",
    "truth AS (SELECT DISTINCT 'D' || a.doc_id AS s1_id, 'D' || b.doc_id AS r_id FROM tdoc a JOIN tdoc b ON a.lang = b.lang AND a.text = b.text WHERE a.doc_id % 3 = 0 AND b.doc_id % 3 <> 0)",
]


def with_(ctes: list[str], tail: str) -> str:
    seen = list(dict.fromkeys(ctes))
    return "WITH " + ",\n".join(seen) + "\n" + tail


def binary_lists() -> str:
    each = []
    for name, (column, kind) in BINARY.items():
        each.append(f"list_distinct({tokens(column)}) AS {name}" if kind == "word" else f"list_distinct(regexp_extract_all({column}, '[0-9]+')) AS {name}")
    return "feat AS (SELECT *, list_distinct(core) AS core_d, coalesce(core[1], '') AS first_core, " + ", ".join(each) + " FROM rec)"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a})::DOUBLE / ({b}) END"


def prefix_ratio(a: str, b: str) -> str:
    def share(small: str, large: str) -> str:
        near = "(x = y OR (length(x) >= 3 AND length(y) >= 3 AND (starts_with(x, y) OR starts_with(y, x))))"
        return f"len(list_filter({small}, lambda x: len(list_filter({large}, lambda y: {near})) > 0))::DOUBLE / len({small})"

    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 WHEN len({a}) <= len({b}) THEN {share(a, b)} ELSE {share(b, a)} END"


def pair_cosines(pairs: str = "cand") -> list[str]:
    return [f"x_{c} AS (SELECT q.s1_id, q.r_id, round(sum(a.weight * b.weight), 9) AS v FROM {pairs} q JOIN p_{s} a ON a.entity_id = q.s1_id JOIN p_{s} b ON b.entity_id = q.r_id AND b.term = a.term GROUP BY ALL)" for c, s in COSINES.items()]


def features(pairs: str = "cand") -> list[str]:
    """CTEs up to pf: every pair's features without the list ones. Pairs have natural."""
    inter = lambda s: f"len(list_intersect(a.{s}_bin, b.{s}_bin))"
    size = lambda s, t: f"len({t}.{s}_bin)"
    union = lambda s: f"({size(s, 'a')} + {size(s, 'b')} - {inter(s)})"
    low = lambda s: f"least({size(s, 'a')}, {size(s, 'b')})"
    lens = lambda c: (f"least(length(a.{c}), length(b.{c}))", f"greatest(length(a.{c}), length(b.{c}))")
    missing = "(length(a.business_address_clean) = 0 OR length(b.business_address_clean) = 0)"
    flag = lambda c: f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END::DOUBLE"
    cols = {
        "name_word_jaccard": ratio(inter("name"), union("name")),
        "name_core_jaccard": ratio(inter("core"), union("core")),
        "name_overlap_ratio": ratio(inter("name"), low("name")),
        "name_shared_tokens": f"{inter('name')}::DOUBLE",
        **{c: f"coalesce(x_{c}.v, 0.0)" for c in ("name_char_cosine", "name_squash_cosine", "name_word_cosine")},
        "name_exact": flag("a.business_name_clean = b.business_name_clean"),
        "name_core_exact": flag(f"{inter('core')} = {size('core', 'a')} AND {inter('core')} = {size('core', 'b')} AND {inter('core')} > 0"),
        "name_length_ratio": ratio(*lens("business_name_clean")),
        "name_first_token_equal": flag("a.first_core = b.first_core AND a.first_core <> ''"),
        "name_prefix_ratio": prefix_ratio("a.core_d", "b.core_d"),
        "addr_word_jaccard": ratio(inter("addr"), union("addr")),
        "addr_overlap_ratio": ratio(inter("addr"), low("addr")),
        "addr_shared_tokens": f"{inter('addr')}::DOUBLE",
        **{c: f"coalesce(x_{c}.v, 0.0)" for c in ("addr_char_cosine", "addr_word_cosine")},
        "addr_numeric_shared": f"{inter('num')}::DOUBLE",
        "addr_numeric_jaccard": ratio(inter("num"), union("num")),
        "addr_length_ratio": ratio(*lens("business_address_clean")),
        "addr_missing": flag(missing),
        "addr_exact": flag(f"{inter('addr')} = {size('addr', 'a')} AND {inter('addr')} = {size('addr', 'b')} AND {inter('addr')} > 0"),
        "same_country": flag("a.country_clean = b.country_clean"),
        "country_mismatch": flag("a.country_clean <> b.country_clean"),
        "is_source3": flag("b.source = 'S3'"),
        "combined_score": f"round(CASE WHEN {missing} THEN coalesce(x_name_char_cosine.v, 0.0) ELSE 0.6::DOUBLE * coalesce(x_name_char_cosine.v, 0.0) + 0.4::DOUBLE * coalesce(x_addr_char_cosine.v, 0.0) END, 9)",
        "name_x_addr": "coalesce(x_name_char_cosine.v, 0.0) * coalesce(x_addr_char_cosine.v, 0.0)",
        "shared_numeric_all": f"{inter('num')}::DOUBLE",
    }
    joins = " ".join(f"LEFT JOIN x_{c} ON x_{c}.s1_id = q.s1_id AND x_{c}.r_id = q.r_id" for c in COSINES)
    body = ", ".join(f"{v} AS {k}" for k, v in cols.items())
    return [*space("addr_word"), *pair_cosines(pairs), binary_lists(), f"pf AS (SELECT q.s1_id, q.r_id, q.natural, {body} FROM {pairs} q JOIN feat a ON a.entity_id = q.s1_id JOIN feat b ON b.entity_id = q.r_id {joins})"]


NATURAL = "pool AS (SELECT s1_id, r_id, true AS natural FROM cand)"
POOL = "pool AS (SELECT s1_id, r_id, true AS natural FROM cand UNION ALL SELECT s1_id, r_id, false FROM (SELECT * FROM truth EXCEPT SELECT s1_id, r_id FROM cand))"
LISTED = "lf AS (SELECT p.*, 1 + coalesce((SELECT count(*) FROM pf o WHERE o.natural AND o.s1_id = p.s1_id AND o.combined_score > p.combined_score), 0)::DOUBLE AS cand_rank, coalesce(best, p.combined_score) AS cand_best_score, coalesce(best, p.combined_score) - p.combined_score AS cand_gap_to_best, coalesce(n, 0)::DOUBLE AS cand_count FROM pf p LEFT JOIN (SELECT s1_id, max(combined_score) AS best, count(*) AS n FROM pf WHERE pf.natural GROUP BY s1_id) USING (s1_id))"
