"""Registry of the queries over business records and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions import fixed as X
from kinfold.functions import text as N
from kinfold.operators import analytics, blocking, evaluate, features, models, records, resolve, truth, validate
from kinfold.operators.lineage import folder, written
from kinfold.operators.vectors import BINARY, SPACES, frequencies, known, posting_table, term_counts, with_binary_sets
from kinfold.plans import sql as S
from kinfold.sources import files

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, statement: str | None = None):
    def add(f):
        QUERIES[name] = f
        if statement:
            SQL[name] = statement
        return f

    return add


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# ---------------------------------------------------------------- inputs


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return records.record_view(table(spark, sf, "documents"))


def whole(spark: SparkSession, sf: str) -> DataFrame:
    return records.whole_view(table(spark, sf, "documents"))


def based(spark: SparkSession, sf: str) -> DataFrame:
    return records.with_base(whole(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return records.normalised(raw(spark, sf))


def both(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return records.sides(clean(spark, sf))


def truth_table(spark: SparkSession, sf: str) -> DataFrame:
    """Equal language and text across source 1 and the others."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    a = docs.where("pmod(doc_id, 3) = 0").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("source1_entity_id"), "lang", "text")
    b = docs.where("pmod(doc_id, 3) <> 0").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("r_id"), "lang", "text")
    return a.join(b, ["lang", "text"]).groupBy("source1_entity_id").agg(F.array_join(F.sort_array(F.collect_set("r_id")), ",").alias("matched_entity_ids"))


def natural_pairs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    left, right = both(spark, sf)
    return left, right, blocking.candidates(left, right)


def r6(c: str | Column) -> Column:
    return F.round(c, 6)


#: A difference of scores of 9 digits often lies just between two of 6: it is rounded
#: as a whole number of 1e-9, the same way in Spark and in SQL.
_GAP = "floor((round(cand_gap_to_best * 1e9) + 500) / 1000) / 1e6::DOUBLE"


def _place(c: str) -> Column:
    return F.expr(_GAP) if c == "cand_gap_to_best" else r6(F.col(c))


def _rounded(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select("s1_id", "r_id", *[_place(c).alias(c) for c in cols])


def _sql_rounded(cols: list[str]) -> str:
    return "s1_id, r_id, " + ", ".join(f"{_GAP if c == 'cand_gap_to_best' else f'round({c}, 6)'} AS {c}" for c in cols)


def entry(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate lists of every source 1 record by the name-character signal."""
    left, right = both(spark, sf)
    pairs = blocking.topk_by_join(left, right, "name_char").select("s1_id", "r_id", F.col("score").alias("probability"))
    lists = resolve.decided(left, pairs, 0.5)
    return resolve.candidate_table(lists).join(resolve.matching_table(lists).drop("_row"), "source1_entity_id").drop("_row")


# ---------------------------------------------------------------- A, B: scan and normalise

REC = S.with_([S.WHOLE0], "SELECT {} FROM rec0")


@query("a1_record_scan", REC.format("entity_id, business_name, business_address, country"))
def a1(spark, sf):
    return whole(spark, sf).select("entity_id", *[N.filled(F.col(c)).alias(c) for c in records.REQUIRED[1:]])


@query("a1_tsv_scan", REC.format("entity_id, business_name, business_address, country"))
def a1_tsv(spark, sf):
    """The records written as tab-separated text, quotes and line ends inside fields
    included, and read by the reader."""
    place, cols = folder(spark, "tsv"), ["entity_id", *records.REQUIRED[1:]]
    planted = whole(spark, sf).select("entity_id", *[N.filled(F.col(c)).alias(c) for c in cols[1:]])
    planted.write.options(sep="\t", header=True, quote='"', escape='"', quoteAll=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(place)
    return files.read_tsv(spark, place).select(*cols)


@query("a2_head_limit", S.with_([S.WHOLE0], "SELECT entity_id FROM rec0 WHERE _row < 500"))
def a2(spark, sf):
    return records.head(whole(spark, sf), 500).select("entity_id")


@query("a5_tagged_union", S.with_([S.WHOLE0], "SELECT entity_id, CASE _row % 3 WHEN 1 THEN 'S2' ELSE 'S3' END AS source FROM rec0 WHERE _row % 3 <> 0"))
def a5(spark, sf):
    return records.sides(whole(spark, sf))[1].select("entity_id", "source")


def _scalar(name: str, make, statement: str):
    query(name, S.with_(S.WHOLE[:2], f"SELECT entity_id, {statement} AS value FROM rec1"))(lambda spark, sf: based(spark, sf).select("entity_id", make().alias("value")))


_scalar("b1_null_to_empty", lambda: F.col("business_address"), "business_address")
_scalar("b6_latin_specials", lambda: N.latin_specials(F.col("business_name")), S.specials("business_name"))
_scalar("b8_base_normal", lambda: F.col("_name"), "nb")
_scalar("b9_clean_text", lambda: N.clean_text(F.col("_name")), S.no_punct(S.lower_and("nb")))
_scalar("b11_clean_name", lambda: N.clean_name(F.col("_name")), S.no_punct(S.domains(S.lower_and("nb"))))
_scalar("b12_core_tokens", lambda: F.array_join(N.core_tokens(N.clean_name(F.col("_name"))), "|"), f"array_to_string({S.core(S.tokens(S.no_punct(S.domains(S.lower_and('nb')))))}, '|')")
_scalar("b13_clean_country", lambda: N.clean_country(F.col("_ctry")), S.mapped(X.COUNTRY_ALIASES, S.no_punct(S.lower_and("cb"))))
_scalar("b14_state_codes", lambda: N.states_expanded(F.concat(F.upper(F.substring("_ctry", 1, 2)), F.lit(", "), F.col("_addr"), F.lit(" ,CA, NY")), F.lit("us")), S.states("upper(substr(cb, 1, 2)) || ', ' || ab || ' ,CA, NY'", "'us'"))
_scalar("b15_ordinals", lambda: N.without_ordinals(F.concat(F.col("_row").cast("string"), F.lit("th "), F.lower("_addr"))), S.ordinals("_row || 'th ' || lower(ab)"))
_scalar("b16_abbreviations", lambda: F.array_join(N.expanded(N.tokens(N.clean_text(F.col("_addr")))), " "), f"array_to_string({S.expand(S.tokens(S.no_punct(S.lower_and('ab'))))}, ' ')")
_scalar("b17_address_noise", lambda: F.array_join(N.without_noise(N.tokens(N.clean_text(F.col("_addr")))), " "), f"array_to_string({S.denoise(S.tokens(S.no_punct(S.lower_and('ab'))))}, ' ')")
_scalar("b21_length", lambda: F.length(N.clean_name(F.col("_name"))).cast("long"), f"length({S.no_punct(S.domains(S.lower_and('nb')))})")


@query("b10_domain_reduction", f"SELECT page_id, {S.domains('lower(url)')} AS value FROM pages")
def b10(spark, sf):
    return table(spark, sf, "pages").select("page_id", N.without_domains(F.lower("url")).alias("value"))


@query("b7_strip_accents", "SELECT doc_id, strip_accents(" + S.specials("text") + ") AS value FROM documents")
def b7(spark, sf):
    return table(spark, sf, "documents").select("doc_id", N.base_normal(F.col("text")).alias("value"))


def _planted(name: str, cases: list[tuple[str, str]]):
    """Each document gets a planted text by its number; the expected form follows by
    hand from the rules."""
    values = ", ".join(f"({k}, '{want}')" for k, (_, want) in enumerate(cases))

    @query(name, f"SELECT d.doc_id, e.value FROM documents d JOIN (VALUES {values}) e(k, value) ON d.doc_id % {len(cases)} = e.k")
    def planted(spark, sf):
        inputs = F.array(*[F.lit(x) for x, _ in cases])
        nth = F.pmod("doc_id", F.lit(len(cases))).cast("int") + 1
        return table(spark, sf, "documents").select("doc_id", N.base_normal(F.element_at(inputs, nth)).alias("value"))


_planted("b2_nfkc", [("ＡＢＣ　１２ Ltd", "ABC 12 Ltd"), ("①②", "12"), ("ﬁne ﬂow", "fine flow"), ("plain", "plain"), ("e\u0301", "e")])
_planted("b3_indic_blocks", [("कमल", "kamal"), ("કમલ Ltd", "kamal Ltd"), ("বাংলা", "banla"), ("ਕਮਲ", "kamal"), ("ಕಮಲ", "kamal")])
_planted("b4_romanise", [("प्राइवेट", "praivet"), ("लिमिटेड", "limited"), ("कं", "kan"), ("१२", ""), ("कम", "kam")])
_planted("b5_transliterate", [("प्राइवेट लिमिटेड 12", "praivet limited 12"), ("Shop कमल, A-1", "Shop kamal, A-1"), ("no run", "no run"), ("Crème कम Brûlée", "Creme kam Brulee"), ("Straße", "Strasse")])


_NORMAL = "entity_id, country_clean, business_name_clean, name_core, name_core_sorted, name_squashed, business_address_clean, address_sorted"


def _normal(cols: str):
    return lambda spark, sf: records.normalised(whole(spark, sf)).select(*[c.strip() for c in cols.split(",")])


query("b18_clean_address", S.with_(S.WHOLE[:5], "SELECT entity_id, business_address_clean FROM rec"))(_normal("entity_id, business_address_clean"))
query("b19_join_sort_squash", S.with_(S.WHOLE[:5], "SELECT entity_id, name_core_sorted, name_squashed, address_sorted FROM rec"))(_normal("entity_id, name_core_sorted, name_squashed, address_sorted"))
query("b20_preprocess", S.with_(S.WHOLE[:5], f"SELECT {_NORMAL} FROM rec"))(_normal(_NORMAL))


@query("b22_first_token", S.with_(S.WHOLE[:5], "SELECT entity_id, coalesce(core[1], '') AS first_token FROM rec"))
def b22(spark, sf):
    return records.normalised(whole(spark, sf)).select("entity_id", F.coalesce(F.try_element_at(N.tokens(F.col("name_core")), F.lit(1)), F.lit("")).alias("first_token"))


@query("b23_split_ids", S.with_(S.TRUTH, "SELECT s1_id, r_id FROM truth"))
def b23(spark, sf):
    t = truth_table(spark, sf)
    return t.select(F.col("source1_entity_id").alias("s1_id"), F.explode(N.id_list(F.concat(F.lit(" ,"), F.col("matched_entity_ids"), F.lit(" ,,")), strip=True)).alias("r_id"))


# ---------------------------------------------------------------- C: vector spaces


def _space(s: str):
    query(f"c6_tfidf_{s}", S.with_([*S.WHOLE, *S.space(s)], f"SELECT entity_id, term, round(weight, 6) AS weight FROM p_{s}"))(lambda spark, sf: posting_table(records.normalised(whole(spark, sf)), [s]).select("entity_id", "term", r6("weight").alias("weight")))
    query(f"c_terms_{s}", S.with_([*S.WHOLE, *S.space(s)[:1]], f"SELECT entity_id, term, tf FROM c_{s}"))(lambda spark, sf: term_counts(records.normalised(whole(spark, sf)), [s]).select("entity_id", "term", "tf"))


for _s in SPACES:
    _space(_s)


@query("c6_document_frequency", S.with_([*S.WHOLE, *[x for s in SPACES for x in S.space(s)[:2]]], " UNION ALL ".join(f"SELECT '{s}' AS space, term, df FROM d_{s}" for s in SPACES)))
def c6_df(spark, sf):
    return frequencies(records.normalised(whole(spark, sf)), list(SPACES)).select("space", "term", "df")


@query("c8_binary_sets", S.with_([*S.WHOLE, S.binary_lists()], "SELECT entity_id, " + ", ".join(f"array_to_string(list_sort({b}), ' ') AS {b}" for b in BINARY) + " FROM feat"))
def c8(spark, sf):
    return with_binary_sets(records.normalised(whole(spark, sf))).select("entity_id", *[F.array_join(F.array_sort(b), " ").alias(b) for b in BINARY])


@query("c9_empty_space", S.with_(S.WHOLE, "SELECT count(*) FILTER (length(name_core) = 0) AS empty_names, count(*) FILTER (length(address_sorted) = 0) AS empty_addresses, 0::BIGINT AS postings FROM rec"))
def c9(spark, sf):
    df = records.normalised(whole(spark, sf))
    none = posting_table(df.withColumn("name_core", F.lit("")), ["name_word"]).agg(F.count(F.lit(1)).alias("postings"))
    return df.agg(F.count_if(F.length("name_core") == 0).alias("empty_names"), F.count_if(F.length("address_sorted") == 0).alias("empty_addresses")).join(none)


# ---------------------------------------------------------------- D: blocking


def _signal(s: str, key: str):
    @query(key, S.with_([*S.RECORDS, *S.signal(s)], f"SELECT s1_id, r_id, round(score, 6) AS score FROM k_{s}"))
    def one(spark, sf):
        left, right = both(spark, sf)
        return blocking.signal_pairs(left, right, wanted=(s,)).select("s1_id", "r_id", r6("score").alias("score"))


for _key, _s in (("d4_topk_name_char", "name_char"), ("d5_topk_name_word", "name_word"), ("d6_topk_squash", "name_squash"), ("d7_topk_address", "addr_char"), ("d8_topk_combined", "combined")):
    _signal(_s, _key)


@query("d2_cosine_join", S.with_([*S.RECORDS, *S.space("name_word"), S.scores("name_word")], "SELECT s1_id, r_id, round(raw, 6) AS score FROM s_name_word"))
def d2(spark, sf):
    left, right = both(spark, sf)
    post = posting_table(blocking.all_records(left, right), ["name_word"])
    return blocking.cosine_scores(left, right, "name_word", post).select("s1_id", "r_id", r6("raw").alias("score"))


@query("d3_topk_by_join", SQL["d6_topk_squash"])
def d3(spark, sf):
    return blocking.topk_by_join(*both(spark, sf), "name_squash").select("s1_id", "r_id", r6("score").alias("score"))


_CAND = [*S.RECORDS, *S.CANDIDATES]


@query("d9_candidates", S.with_(_CAND, "SELECT s1_id, r_id FROM cand"))
def d9(spark, sf):
    return natural_pairs(spark, sf)[2]


@query("d10_truth_pairs", S.with_(S.TRUTH, "SELECT s1_id, r_id FROM truth"))
def d10(spark, sf):
    return truth.true_pairs(truth_table(spark, sf), *records.sides(raw(spark, sf)))


@query("d11_out_of_scope", S.with_(S.TRUTH, "SELECT count(*) AS outside FROM truth WHERE substr(r_id, 2)::BIGINT % 7 = 0"))
def d11(spark, sf):
    left, right = records.sides(raw(spark, sf))
    return truth.out_of_scope(truth_table(spark, sf), left, right.where("pmod(_row, 7) <> 0"))


@query("d12_coverage", S.with_([*_CAND, *S.TRUTH], "SELECT count(*) AS true_pairs, count(c.s1_id) AS found, round(coalesce(avg(CASE WHEN c.s1_id IS NULL THEN 0 ELSE 1 END), 0), 6) AS recall FROM truth t LEFT JOIN cand c USING (s1_id, r_id)"))
def d12(spark, sf):
    left, right, pairs = natural_pairs(spark, sf)
    return truth.coverage(truth.true_pairs(truth_table(spark, sf), left, right), pairs).withColumn("recall", r6("recall"))


@query("d13_training_pool", S.with_([*_CAND, *S.TRUTH, S.POOL], "SELECT p.s1_id, p.r_id, p.natural, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM pool p LEFT JOIN truth t USING (s1_id, r_id)"))
def d13(spark, sf):
    left, right, pairs = natural_pairs(spark, sf)
    return truth.training_pool(truth.true_pairs(truth_table(spark, sf), left, right), pairs)


@query("d15_pair_gather", S.with_(_CAND, "SELECT s1_id, r_id, a.name_core AS left_core, b.name_core AS right_core FROM cand JOIN lhs a ON a.entity_id = s1_id JOIN rhs b ON b.entity_id = r_id"))
def d15(spark, sf):
    left, right, pairs = natural_pairs(spark, sf)
    side = lambda df, key, name: df.select(F.col("entity_id").alias(key), F.col("name_core").alias(name))
    return pairs.join(side(left, "s1_id", "left_core"), "s1_id").join(side(right, "r_id", "right_core"), "r_id").select("s1_id", "r_id", "left_core", "right_core")


# ---------------------------------------------------------------- E: features


def _searched(left: DataFrame, right: DataFrame) -> tuple[dict | None, DataFrame]:
    """Known frequencies of all spaces, and the natural candidates."""
    freq = known(blocking.all_records(left, right), list(SPACES))
    return freq, written(blocking.candidate_pairs(blocking.signal_pairs(left, right, freq=freq)), "pairs")


def feature_rows(spark: SparkSession, sf: str) -> DataFrame:
    left, right = both(spark, sf)
    freq, natural = _searched(left, right)
    return features.list_features(features.features_of(natural.withColumn("natural", F.lit(True)), left, right, freq))


_FEATURES = [*_CAND, S.NATURAL, *S.features("pool")]


def _group(key: str, cols: list[str], listed: bool = False):
    ctes = [*_FEATURES, S.LISTED] if listed else _FEATURES
    query(key, S.with_(ctes, f"SELECT {_sql_rounded(cols)} FROM {'lf' if listed else 'pf'}"))(lambda spark, sf: _rounded(feature_rows(spark, sf), cols))


_group("e_name_token_features", ["name_word_jaccard", "name_core_jaccard", "name_overlap_ratio", "name_shared_tokens", "name_exact", "name_core_exact", "name_length_ratio", "name_first_token_equal"])
_group("e_name_cosines", ["name_char_cosine", "name_squash_cosine", "name_word_cosine"])
_group("e_prefix_ratio", ["name_prefix_ratio"])
_group("e_addr_features", features.ADDRESS)
_group("e_pair_features", features.PAIR)
_group("e_candidate_list", features.LIST, listed=True)
_group("e_all_features", features.FEATURES, listed=True)


@query("e_injected_rank", S.with_([*_CAND, *S.TRUTH, S.POOL, *S.features("pool"), S.LISTED], f"SELECT lf.natural, {_sql_rounded(features.LIST)} FROM lf"))
def e_injected(spark, sf):
    left, right = both(spark, sf)
    freq, natural = _searched(left, right)
    pool = truth.training_pool(truth.true_pairs(truth_table(spark, sf), left, right), natural).drop("label")
    rows = features.list_features(features.features_of(pool, left, right, freq))
    return rows.select("natural", "s1_id", "r_id", *[_place(c).alias(c) for c in features.LIST])


# ---------------------------------------------------------------- G: evaluation with the combined score


def scored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Natural pairs with the combined score as probability and their label; truth."""
    left, right = both(spark, sf)
    best = blocking.signal_pairs(left, right, wanted=("combined",)).select("s1_id", "r_id", F.col("score").alias("probability"))
    true = truth.true_pairs(truth_table(spark, sf), left, right)
    return best.join(true.withColumn("label", F.lit(1)), ["s1_id", "r_id"], "left").withColumn("label", F.coalesce("label", F.lit(0))), true


_SCORED = [*S.RECORDS, *S.signal("combined"), *S.TRUTH, "sc AS (SELECT k.s1_id, k.r_id, k.score AS probability, CASE WHEN t.s1_id IS NULL THEN 0 ELSE 1 END AS label FROM k_combined k LEFT JOIN truth t USING (s1_id, r_id))"]
_MEASURED = "round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN n > 0 THEN tp / n ELSE 0 END, 6) AS recall, round(CASE WHEN tp > 0 THEN 1.25 * (tp / (tp + fp)) * (tp / n) / (0.25 * (tp / (tp + fp)) + tp / n) ELSE 0 END, 6) AS f0_5, tp::BIGINT AS tp, fp::BIGINT AS fp, (n - tp)::BIGINT AS fn"
_SWEPT = "sw AS (SELECT t.threshold, count(*) FILTER (probability >= t.threshold AND label = 1)::DOUBLE AS tp, count(*) FILTER (probability >= t.threshold AND label = 0)::DOUBLE AS fp, (SELECT count(*) FROM truth)::DOUBLE AS n FROM (SELECT unnest([" + ", ".join(f"{t}::DOUBLE" for t in X.THRESHOLDS) + "]) AS threshold) t CROSS JOIN sc GROUP BY t.threshold)"
_BETTER = "ms AS (SELECT *, CASE WHEN tp > 0 THEN 1.25 * (tp / (tp + fp)) * (tp / n) / (0.25 * (tp / (tp + fp)) + tp / n) ELSE 0 END AS f FROM sw)"


def _six(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r6(c) for c in ("precision", "recall", "f0_5")})


@query("g2_validation_truth", S.with_(S.TRUTH, "SELECT count(*) AS total_true FROM truth WHERE substr(s1_id, 2)::BIGINT % 5 = 0"))
def g2(spark, sf):
    left, right = records.sides(raw(spark, sf))
    true = truth.true_pairs(truth_table(spark, sf), left, right)
    held = left.where("pmod(_row, 5) = 0").select(F.col("entity_id").alias("s1_id"))
    return true.join(held, "s1_id", "left_semi").agg(F.count(F.lit(1)).alias("total_true"))


@query("g4_evaluate", S.with_([*_SCORED, _SWEPT], f"SELECT threshold, {_MEASURED} FROM sw WHERE threshold = 0.5"))
def g4(spark, sf):
    got, true = scored(spark, sf)
    return _six(evaluate.evaluate(got, 0.5, true.count()))


@query("g5_threshold_sweep", S.with_([*_SCORED, _SWEPT], f"SELECT threshold, {_MEASURED} FROM sw"))
def g5(spark, sf):
    got, true = scored(spark, sf)
    return _six(evaluate.sweep(got, true.count()))


@query("g5_best_threshold", S.with_([*_SCORED, _SWEPT, _BETTER], f"SELECT threshold, {_MEASURED} FROM (SELECT *, row_number() OVER (ORDER BY threshold) AS nth, count(*) OVER () AS c FROM ms WHERE f >= (SELECT max(f) FROM ms) - 1e-9) WHERE nth = c // 2 + 1"))
def g5_best(spark, sf):
    got, true = scored(spark, sf)
    return _six(evaluate.best_threshold(evaluate.sweep(got, true.count())))


def _training_rows(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Labelled feature rows with their side of the split; true pairs."""
    left, right = both(spark, sf)
    freq, natural = _searched(left, right)
    true = written(truth.true_pairs(truth_table(spark, sf), left, right), "true")
    pool = written(truth.training_pool(true, natural), "pool")
    rows = features.list_features(features.features_of(pool.drop("label"), left, right, freq))
    return written(evaluate.entity_split(rows.join(pool.select("s1_id", "r_id", "label"), ["s1_id", "r_id"])), "training"), true


@query("g9_model_comparison")
def g9(spark, sf):
    """The three kinds with the settings of train."""
    rows, true = _training_rows(spark, sf)
    results, _ = models.compare(rows.where("not held"), rows.where("held and natural"), evaluate.entity_split(true).where("held").count())
    return spark.createDataFrame([tuple(r[c] for c in ("model", "threshold", "precision", "recall", "f0_5", "tp", "fp", "fn")) for r in results], "model string, threshold double, precision double, recall double, f0_5 double, tp long, fp long, fn long")


@query("g10_batch_scores")
def g10(spark, sf):
    rows, _ = _training_rows(spark, sf)
    model = models.fit(models.classifiers(rows.count())["LogisticRegression"], models.with_class_weights(rows.where("not held")))
    return models.score(model, rows.where("natural")).select("s1_id", "r_id", "probability")


@query("g11_feature_importance")
def g11(spark, sf):
    rows, _ = _training_rows(spark, sf)
    model = models.fit(models.classifiers(rows.count())["RandomForest"], models.with_class_weights(rows.where("not held")))
    return spark.createDataFrame(models.importances(model), "feature string, importance double")


# ---------------------------------------------------------------- H: decisions on the combined score

_RANKED = "rk AS (SELECT s1_id, r_id, probability, row_number() OVER (PARTITION BY s1_id ORDER BY probability DESC, r_id) AS nth FROM sc)"


def decided(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    left, _ = both(spark, sf)
    return resolve.decided(left, scored(spark, sf)[0], 0.6), left


@query("h1_threshold_matches", S.with_(_SCORED, "SELECT s1_id, r_id FROM sc WHERE probability >= 0.6"))
def h1(spark, sf):
    lists, _ = decided(spark, sf)
    return lists.select(F.col("entity_id").alias("s1_id"), F.explode("matches").alias("r_id"))


@query("h2_candidate_lists", S.with_([*_SCORED, _RANKED], "SELECT entity_id AS source1_entity_id, coalesce(string_agg(r_id, ',' ORDER BY nth), '') AS candidate_entity_ids FROM lhs LEFT JOIN rk ON s1_id = entity_id GROUP BY entity_id"))
def h2(spark, sf):
    return resolve.candidate_table(decided(spark, sf)[0]).drop("_row")


@query("h3_match_lists", S.with_([*_SCORED, _RANKED], "SELECT entity_id AS source1_entity_id, coalesce(string_agg(r_id, ',' ORDER BY nth) FILTER (probability >= 0.6), '') AS matched_entity_ids FROM lhs LEFT JOIN rk ON s1_id = entity_id GROUP BY entity_id"))
def h3(spark, sf):
    return resolve.matching_table(decided(spark, sf)[0]).drop("_row")


@query("h4_summary", S.with_(_SCORED, "SELECT (SELECT count(*) FROM lhs) AS total_entities, count(DISTINCT s1_id) FILTER (probability >= 0.6) AS matched_entities, count(*) AS candidate_pairs, count(*) FILTER (probability >= 0.6) AS final_matches FROM sc"))
def h4(spark, sf):
    return resolve.run_summary(decided(spark, sf)[0])


@query("h4_by_country", S.with_(_SCORED, "SELECT CASE WHEN country = '' THEN 'Unknown' ELSE country END AS country, count(*) AS total, count(*) FILTER (entity_id IN (SELECT s1_id FROM sc WHERE probability >= 0.6)) AS matched FROM lhs GROUP BY 1"))
def h4_country(spark, sf):
    lists, left = decided(spark, sf)
    return resolve.by_country(lists, left)


# ---------------------------------------------------------------- I, J: rules and analytics over planted lists

#: Outputs with planted faults, the same in both languages: record i lists the next
#: i % 60 records (every 7th lists its first twice), matches i % 4 of them, every
#: 5th matches an unknown one, every 11th row's identifier is written twice.
_N = "(SELECT max(doc_id) + 1 FROM documents)"
_PLANTED = [
    "src AS (SELECT doc_id AS i, 'D' || doc_id AS s1_id FROM documents WHERE doc_id % 3 = 0)",
    "cl AS (SELECT i, s1_id, list_concat(list_transform(range(1, i % 60 + 1), lambda k: 'D' || (i + k)), CASE WHEN i % 7 = 0 AND i % 60 > 0 THEN ['D' || (i + 1)] ELSE []::VARCHAR[] END) AS ids FROM src)",
    "ml AS (SELECT i, s1_id, list_concat(list_transform(range(1, least(i % 4, i % 60) + 1), lambda k: 'D' || (i + k)), CASE WHEN i % 5 = 0 THEN ['X' || i] ELSE []::VARCHAR[] END) AS ids FROM src)",
    "md AS (SELECT i, s1_id, ids FROM ml UNION ALL SELECT i + 1, s1_id, ids FROM ml WHERE i % 11 = 0)",
]


def planted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(matching lists, candidate lists, source identifiers): s1_id, ids, _row."""
    src = table(spark, sf, "documents").where("pmod(doc_id, 3) = 0").select(F.col("doc_id").alias("i"), F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("s1_id"))
    none = F.array().cast("array<string>")
    nexts = lambda n: F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("long"), F.greatest(n, F.lit(1).cast("long"))), lambda k: F.concat(F.lit("D"), (F.col("i") + k).cast("string")))).otherwise(none)
    n60, n4 = F.col("i") % 60, F.col("i") % 4
    cand = src.withColumn("ids", F.concat(nexts(n60), F.when((F.col("i") % 7 == 0) & (n60 > 0), F.array(F.concat(F.lit("D"), (F.col("i") + 1).cast("string")))).otherwise(none)))
    match = src.withColumn("ids", F.concat(nexts(F.least(n4, n60)), F.when(F.col("i") % 5 == 0, F.array(F.concat(F.lit("X"), F.col("i").cast("string")))).otherwise(none)))
    rows = lambda df: df.select("s1_id", "ids", F.col("i").alias("_row"))
    return rows(match), rows(cand), src


def _doubled(match: DataFrame) -> DataFrame:
    return match.unionByName(match.where("_row % 11 = 0").withColumn("_row", F.col("_row") + 1))


@query("i2_repeated_ids", S.with_(_PLANTED, "SELECT count(*) - count(DISTINCT s1_id) AS repeated FROM md"))
def i2(spark, sf):
    return validate.repeated_ids(_doubled(planted(spark, sf)[0]))


@query("i3_dups_in_rows", S.with_(_PLANTED, "SELECT count(*) FILTER (len(ids) <> len(list_distinct(ids))) AS rows_with_repeats FROM cl"))
def i3(spark, sf):
    return validate.rows_with_repeats(planted(spark, sf)[1])


@query("i4_outside_candidates", S.with_(_PLANTED, "SELECT coalesce(sum(len(list_filter(m.ids, lambda x: NOT list_contains(c.ids, x)))), 0)::BIGINT AS outside FROM ml m JOIN cl c USING (s1_id)"))
def i4(spark, sf):
    match, cand, _ = planted(spark, sf)
    return validate.outside_candidates(match, cand)


@query("i5_unknown_ids", S.with_(_PLANTED, "SELECT count(*) AS unknown FROM (SELECT unnest(ids) AS e FROM ml) WHERE e NOT IN (SELECT 'D' || doc_id FROM documents)"))
def i5(spark, sf):
    return validate.unknown_ids(planted(spark, sf)[0], raw(spark, sf))


@query("i6_different_keys", S.with_(_PLANTED, "SELECT count(*) AS different FROM src WHERE i % 13 = 0"))
def i6(spark, sf):
    match, cand, _ = planted(spark, sf)
    return validate.different_keys(match, cand.where("_row % 13 <> 0"))


@query("i7_out_of_order", S.with_(_PLANTED, "SELECT count(*) FILTER (i % 9 = 0) AS out_of_order FROM src"))
def i7(spark, sf):
    match, _, src = planted(spark, sf)
    wrong = match.withColumn("s1_id", F.when(F.col("_row") % 9 == 0, F.concat(F.col("s1_id"), F.lit("?"))).otherwise(F.col("s1_id")))
    return validate.out_of_order(wrong, src.select(F.col("s1_id").alias("entity_id"), F.col("i").alias("_row")))


@query("i8_i9_sizes", S.with_(_PLANTED, "SELECT count(*) AS n_rows, count(*) FILTER (len(ids) = 0) AS n_empty, count(*) FILTER (len(ids) > 0) AS n_filled FROM ml"))
def i8(spark, sf):
    return validate.sizes(planted(spark, sf)[0])


_LISTS = [*_PLANTED[:3], "ls AS (SELECT m.i, m.s1_id, len(m.ids)::BIGINT AS m, len(c.ids)::BIGINT AS c, m.ids FROM ml m JOIN cl c USING (s1_id))"]


def planted_lists(spark: SparkSession, sf: str) -> DataFrame:
    match, cand, _ = planted(spark, sf)
    return match.join(cand.select("s1_id", F.col("ids").alias("candidates")), "s1_id").select(F.col("s1_id").alias("entity_id"), "_row", "candidates", F.col("ids").alias("matches"))


@query("j1_dashboard", S.with_(_LISTS, "SELECT count(*) AS total, count(*) FILTER (m > 0) AS matched, count(*) FILTER (m = 0) AS unmatched, sum(c)::BIGINT AS candidate_pairs, sum(m)::BIGINT AS final_matches, round(sum(c) / count(*), 2) AS avg_candidates, round(100.0 * count(*) FILTER (m > 0) / count(*), 2) AS match_rate, round(100.0 * sum(m) / sum(c), 2) AS pair_match_rate FROM ls"))
def j1(spark, sf):
    return analytics.overview(planted_lists(spark, sf))


@query("j1_histogram", S.with_(_LISTS, "SELECT b.bucket, count(ls.i) AS n FROM (SELECT unnest(range(6)) AS bucket) b LEFT JOIN ls ON least(m, 5) = b.bucket GROUP BY b.bucket"))
def j1_hist(spark, sf):
    return analytics.match_histogram(planted_lists(spark, sf))


_ROW = "s1_id AS source1_entity_id, array_to_string(ids, ',') AS matches, m AS match_count, c AS candidate_count, CASE WHEN m > 0 THEN 'Matched' ELSE 'Unmatched' END AS status"
_HAS = "(contains(lower(s1_id), 'd1') OR len(list_filter(ids, lambda x: contains(lower(x), 'd1'))) > 0)"


def _shown(df: DataFrame) -> DataFrame:
    return df.select("source1_entity_id", F.array_join("matches", ",").alias("matches"), "match_count", "candidate_count", "status")


@query("j2_matches_page", S.with_(_LISTS, f"SELECT {_ROW} FROM ls WHERE m > 0 AND {_HAS} ORDER BY i LIMIT 25 OFFSET 25"))
def j2(spark, sf):
    return _shown(analytics.matches_page(planted_lists(spark, sf), "matched", "D1", 2, 25)[0])


@query("j3_search", S.with_(_LISTS, f"SELECT {_ROW} FROM ls WHERE {_HAS} ORDER BY i LIMIT 100"))
def j3(spark, sf):
    return _shown(analytics.search(planted_lists(spark, sf), "d1")[0])


@query("j4_candidates", S.with_(_LISTS, "SELECT count(*) AS entities, sum(c)::BIGINT AS candidate_pairs, sum(m)::BIGINT AS accepted, round(avg(c), 2) AS avg_candidates, max(c) AS max_candidates, min(c) AS min_candidates, (sum(c) - sum(m))::BIGINT AS rejected FROM ls"))
def j4(spark, sf):
    return analytics.candidate_overview(planted_lists(spark, sf))


@query("j4_bucket_distribution", S.with_(_LISTS, "SELECT b.bucket, count(ls.i) AS n FROM (SELECT unnest(['0', '1-10', '11-25', '26-50', '51+']) AS bucket) b LEFT JOIN ls ON b.bucket = CASE WHEN c = 0 THEN '0' WHEN c <= 10 THEN '1-10' WHEN c <= 25 THEN '11-25' WHEN c <= 50 THEN '26-50' ELSE '51+' END GROUP BY b.bucket"))
def j4_buckets(spark, sf):
    return analytics.candidate_buckets(planted_lists(spark, sf))


@query("j4_top_entities", S.with_(_LISTS, "SELECT s1_id AS source1_entity_id, c AS candidate_count, m AS match_count FROM ls ORDER BY c DESC, i LIMIT 10"))
def j4_top(spark, sf):
    return analytics.top_entities(planted_lists(spark, sf)).drop("_row")


@query("j9_rows", S.with_(_LISTS, f"SELECT {_ROW} FROM ls"))
def j9(spark, sf):
    return _shown(analytics.rows(planted_lists(spark, sf)))
