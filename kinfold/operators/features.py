"""The 32 pair features, in their fixed order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.functions.spaces import Known, spread
from kinfold.operators.blocking import Rows, all_records
from kinfold.operators.lineage import written
from kinfold.operators.packed import joined
from kinfold.operators.vectors import BINARY, READ, terms, vectors

NAME = ["name_word_jaccard", "name_core_jaccard", "name_overlap_ratio", "name_shared_tokens", "name_char_cosine", "name_squash_cosine", "name_word_cosine", "name_exact", "name_core_exact", "name_length_ratio", "name_first_token_equal", "name_prefix_ratio"]
ADDRESS = ["addr_word_jaccard", "addr_overlap_ratio", "addr_shared_tokens", "addr_char_cosine", "addr_word_cosine", "addr_numeric_shared", "addr_numeric_jaccard", "addr_length_ratio", "addr_missing", "addr_exact"]
PAIR = ["same_country", "country_mismatch", "is_source3", "combined_score", "name_x_addr", "shared_numeric_all"]
LIST = ["cand_rank", "cand_gap_to_best", "cand_best_score", "cand_count"]
FEATURES = NAME + ADDRESS + PAIR + LIST
COSINES = {"name_char_cosine": "name_char", "name_squash_cosine": "name_squash", "name_word_cosine": "name_word", "addr_char_cosine": "addr_char", "addr_word_cosine": "addr_word"}
DIGITS = 9


@F.arrow_udf(T.DoubleType())
def sparse_dot(at: pa.Array, aw: pa.Array, bt: pa.Array, bw: pa.Array) -> pa.Array:
    """Dot products of sparse vectors with sorted terms; a null vector gives 0."""
    out = np.zeros(len(at))
    off = [x.offsets.to_numpy() for x in (at, bt)]
    flat = [x.values.to_numpy(zero_copy_only=False) for x in (at, aw, bt, bw)]
    for k in range(len(out)):
        a, b, c, d = off[0][k], off[0][k + 1], off[1][k], off[1][k + 1]
        if a == b or c == d:
            continue
        left, right = flat[0][a:b], flat[2][c:d]
        spot = np.minimum(np.searchsorted(right, left), len(right) - 1)
        hit = right[spot] == left
        out[k] = flat[1][a:b][hit] @ flat[3][c:d][spot[hit]]
    return pa.array(out)


def cosines(freq: dict[str, Known]):
    """A function of a table of pairs (a_name_core, b_name_core, a_business_address_clean,
    b_business_address_clean) that gives its cosines: vectors of the table's distinct
    texts, made on the spot."""

    def of_texts(pairs: pa.Table) -> list[pa.Array]:
        n, out = pairs.num_rows, []
        for s in COSINES.values():
            coded = pa.concat_arrays([pairs[f"{x}_{READ[s]}"].combine_chunks() for x in "ab"]).dictionary_encode()
            rows, at = Rows(coded.dictionary, s, freq[s]), coded.indices.to_numpy()
            wide, got = max(1, len(freq[s].keys)), np.zeros(n)
            for k in range(0, n, 512):
                one, other = (x[k : min(k + 512, n)] for x in (at[:n], at[n:]))
                sides = []
                for own in (one, other):
                    size = rows.at[own + 1] - rows.at[own]
                    spot = spread(rows.at[own], size)
                    sides.append((np.repeat(np.arange(len(own)), size) * wide + rows.term[spot], rows.weight[spot]))
                (x, xw), (y, yw) = sides
                if len(x) and len(y):
                    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    hit = y[place] == x
                    got[k : k + len(one)] = np.bincount(x[hit] // wide, xw[hit] * yw[place[hit]], len(one))
            out.append(pa.array(got))
        return out

    return of_texts


def wide_vectors(vec: DataFrame) -> DataFrame:
    """One row of a record: <space>_t and <space>_w."""
    spaces = list(COSINES.values())
    got = vec.groupBy("entity_id").pivot("space", spaces).agg(F.first("terms").alias("t"), F.first("weights").alias("w"))
    empty = {"t": "array<bigint>", "w": "array<double>"}
    return got.select("entity_id", *[F.coalesce(f"{s}_{x}", F.array().cast(kind)).alias(f"{s}_{x}") for s in spaces for x, kind in empty.items()])


def record_features(records: DataFrame, vec: DataFrame | None = None) -> DataFrame:
    """What the pair features read of a record: its texts, and its vectors if vec is
    given, which small inputs can do. Sets and tokens are made at the pair: they take ten
    times the room of their texts."""
    keep = ["entity_id", "country_clean", "business_name_clean", "business_address_clean", "name_core"]
    keep += ["source"] if "source" in records.columns else []
    if vec is None:
        return records.select(*keep)
    empty = {"t": "array<bigint>", "w": "array<double>"}
    wide = records.select(*keep).join(wide_vectors(vec), "entity_id", "left")
    return wide.select(*keep, *[F.coalesce(f"{s}_{x}", F.array().cast(kind)).alias(f"{s}_{x}") for s in COSINES.values() for x, kind in empty.items()])


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _flag(c: Column) -> Column:
    return c.cast("double")


def _prefix_ratio(a: Column, b: Column) -> Column:
    """Share of the smaller token set with an equal token, or with one of which
    either is a prefix of the other (both of three characters or more)."""

    def share(small: Column, large: Column) -> Column:
        def near(x: Column, y: Column) -> Column:
            return (x == y) | ((F.length(x) >= 3) & (F.length(y) >= 3) & (F.startswith(x, y) | F.startswith(y, x)))

        return _ratio(F.size(F.filter(small, lambda x: F.exists(large, lambda y: near(x, y)))), F.size(small))

    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).when(F.size(a) <= F.size(b), share(a, b)).otherwise(share(b, a))


def features_of(pairs: DataFrame, left: DataFrame, right: DataFrame, freq: dict[str, Known] | None) -> DataFrame:
    """pair_features of pairs of normalised records; freq: their known frequencies."""
    vec = None if freq else written(vectors(all_records(left, right)), "vectors")
    return pair_features(pairs, record_features(left, vec), record_features(right, vec), freq)


def pair_features(pairs: DataFrame, left: DataFrame, right: DataFrame, freq: dict[str, Known] | None = None) -> DataFrame:
    """pairs: s1_id, r_id, natural. left and right: record_features of the sides, without
    vectors if freq is given."""
    a = left.select(*[F.col(c).alias(f"a_{c}") for c in left.columns])
    b = right.select(*[F.col(c).alias(f"b_{c}") for c in right.columns])
    # Blocks of texts are small; of vectors, which small inputs may bring, they aren't.
    j = joined(pairs, a, b, list(COSINES), cosines(freq)) if freq else pairs.join(a, F.col("s1_id") == F.col("a_entity_id")).join(b, F.col("r_id") == F.col("b_entity_id"))
    for x in "ab":
        j = j.withColumns({f"{x}_{name}": F.array_distinct(terms(F.col(f"{x}_{c}"), kind)) for name, (c, kind) in BINARY.items()})
        j = j.withColumn(f"{x}_first_core", F.substring_index(f"{x}_name_core", " ", 1))
    both = lambda s: (F.col(f"a_{s}"), F.col(f"b_{s}"))
    j = j.withColumns({f"_{s}": F.size(F.array_intersect(*both(f"{s}_bin"))) for s in ("name", "core", "addr", "num")})
    sizes = lambda s: (F.size(f"a_{s}_bin"), F.size(f"b_{s}_bin"))
    union = lambda s: sizes(s)[0] + sizes(s)[1] - F.col(f"_{s}")
    low = lambda s: F.least(*sizes(s))
    lengths = lambda c: (F.length(f"a_{c}"), F.length(f"b_{c}"))
    if freq:
        cos = {c: F.round(c, DIGITS) for c in COSINES}
    else:
        cos = {c: F.round(sparse_dot(F.col(f"a_{s}_t"), F.col(f"a_{s}_w"), F.col(f"b_{s}_t"), F.col(f"b_{s}_w")), DIGITS) for c, s in COSINES.items()}
    j = j.withColumns(cos)
    missing = (F.length("a_business_address_clean") == 0) | (F.length("b_business_address_clean") == 0)
    name, addr = F.col("name_char_cosine"), F.col("addr_char_cosine")
    j = j.withColumns(
        {
            "name_word_jaccard": _ratio(F.col("_name"), union("name")),
            "name_core_jaccard": _ratio(F.col("_core"), union("core")),
            "name_overlap_ratio": _ratio(F.col("_name"), low("name")),
            "name_shared_tokens": F.col("_name").cast("double"),
            "name_exact": _flag(F.col("a_business_name_clean") == F.col("b_business_name_clean")),
            "name_core_exact": _flag((F.col("_core") == sizes("core")[0]) & (F.col("_core") == sizes("core")[1]) & (F.col("_core") > 0)),
            "name_length_ratio": _ratio(F.least(*lengths("business_name_clean")), F.greatest(*lengths("business_name_clean"))),
            "name_first_token_equal": _flag((F.col("a_first_core") == F.col("b_first_core")) & (F.col("a_first_core") != "")),
            "name_prefix_ratio": _prefix_ratio(*both("core_bin")),
            "addr_word_jaccard": _ratio(F.col("_addr"), union("addr")),
            "addr_overlap_ratio": _ratio(F.col("_addr"), low("addr")),
            "addr_shared_tokens": F.col("_addr").cast("double"),
            "addr_numeric_shared": F.col("_num").cast("double"),
            "addr_numeric_jaccard": _ratio(F.col("_num"), union("num")),
            "addr_length_ratio": _ratio(F.least(*lengths("business_address_clean")), F.greatest(*lengths("business_address_clean"))),
            "addr_missing": _flag(missing),
            "addr_exact": _flag((F.col("_addr") == sizes("addr")[0]) & (F.col("_addr") == sizes("addr")[1]) & (F.col("_addr") > 0)),
            "same_country": _flag(F.col("a_country_clean") == F.col("b_country_clean")),
            "country_mismatch": _flag(F.col("a_country_clean") != F.col("b_country_clean")),
            "is_source3": _flag(F.col("b_source") == "S3"),
            "combined_score": F.round(F.when(missing, name).otherwise(F.lit(0.6) * name + F.lit(0.4) * addr), DIGITS),
            "name_x_addr": name * addr,
            "shared_numeric_all": F.col("_num").cast("double"),
        }
    )
    return j.select("s1_id", "r_id", "natural", *NAME, *ADDRESS, *PAIR)


def list_features(pairs: DataFrame) -> DataFrame:
    """Adds the place of each pair in its record's natural candidate list: the rank
    is one more than the natural scores strictly above it, for injected pairs too."""
    own = Window.partitionBy("s1_id")
    score, natural = F.col("combined_score"), F.col("natural").cast("long")
    upto = F.sum(natural).over(own.orderBy(F.desc("combined_score")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    peers = F.sum(natural).over(Window.partitionBy("s1_id", "combined_score"))
    best = F.coalesce(F.max(F.when(F.col("natural"), score)).over(own), score)
    got = pairs.withColumns({"cand_rank": (upto - peers + 1).cast("double"), "cand_best_score": best, "cand_count": F.sum(natural).over(own).cast("double")})
    got = got.withColumn("cand_rank", F.when(F.col("cand_count") == 0, F.lit(1.0)).otherwise(F.col("cand_rank")))
    got = got.withColumn("cand_gap_to_best", F.col("cand_best_score") - score)
    return got.select("s1_id", "r_id", "natural", *FEATURES)
