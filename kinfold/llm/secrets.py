r"""Secret scans with multipart credential linking, in DataFrame operations only.

Base spans are the leftmost non-overlapping matches of three fixed patterns.
Weak parts (identifiers, bare secret-like tokens, endpoints) are too common to
report alone: a weak secret is reported, with what completes it, only when a
complementary part (an identifier, an endpoint or an access identifier) that doesn't
overlap it is in the same scope, at any distance or, where `reach` is given, under
that many characters away. A scope is a text between blank lines. Parts of rows that
have both kinds meet by row and scope; texts are never shuffled.

A null text counts as empty (no span). A null identifier is kept. Repeated rows
are scanned one by one. Spans of one start are listed by kind. A very long text is
scanned whole, in time that follows its length and number of matches; its matches
meet in one task. Extra columns are ignored by the scan and kept by the redaction,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import settled

# The base patterns and their least lengths (ASCII letters in
# either case for the key words; access and hex take their least length inside,
# which finds the same runs because a shorter run holds no longer one).
_ANY = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
ASSIGN = "(" + "|".join(map(_ANY, ("password", "passwd", "secret", "token"))) + "|" + _ANY("api") + "_?" + _ANY("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "(?<![0-9a-f])[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
# The weak patterns. A '=' is padding at a token's end, and else stands
# between a key and its token. A token is a whole run, however long; possessive steps
# read each run a bounded number of times.
IDENT = "(?:" + "|".join(map(_ANY, ("username", "user", "login", "account"))) + "|" + _ANY("client") + "_?" + _ANY("id") + "|" + _ANY("key") + "_?" + _ANY("id") + r""")["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,64}"""
WEAK = "(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{20,}+(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
ENDPOINT = r"(?:https?|ftp|postgres|mysql|redis|amqp|s3)://[^\x20\x09-\x0D\"'<>]+"
#: Rows with linked parts are sent to all executors up to this count.
BROADCAST_ROWS = 100_000
#: Spans are gathered in blocks of so many.
BLOCK = 256
SCOPE_BREAK = r"\n[\x20\x09\r]*\n"

_SPANS = "array<struct<s:int,k:int,e:int>>"


def _spans(text: Column, pattern: str, kind: int, fits=None) -> Column:
    """All matches as structs (s, k, e) in code points: the pieces between matches
    and the matches, both in order, give every position."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m"), (fits(m) if fits else F.lit(True)).alias("ok")))
    empty = F.array().cast(_SPANS)

    def block(st: Column, at: Column, first: Column) -> Column:
        """(at, spans) after the steps of one block."""

        def add(acc: Column, i: Column) -> Column:
            x = F.get(st, i)
            start = acc["at"] + x["g"]
            end = start + x["m"]
            return F.struct(end.alias("at"), F.when(x["ok"], F.concat(acc["spans"], F.array(F.struct(start.alias("s"), F.lit(kind).alias("k"), end.alias("e"))))).otherwise(acc["spans"]).alias("spans"))

        return F.aggregate(F.sequence(first, F.least(first + BLOCK, F.size(st)) - 1), F.struct(at.alias("at"), empty.alias("spans")), add)

    def folded(st: Column) -> Column:
        # Appending copies: within a block a bounded number of spans, then whole blocks.
        return F.aggregate(
            F.transform(F.sequence(F.lit(0), F.floor((F.size(st) - 1) / BLOCK).cast("int")), lambda b: b * BLOCK),
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPANS}>").alias("spans")),
            lambda acc, first: F.get(F.transform(F.array(block(st, acc["at"], first)), lambda r: F.struct(r["at"].alias("at"), F.concat(acc["spans"], F.array(r["spans"])).alias("spans"))), F.lit(0)),
            lambda acc: F.flatten(acc["spans"]),
        )

    found = F.get(F.transform(F.array(steps), folded), F.lit(0))
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_secrets(docs: DataFrame, *, reach: int | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Row by row: row (its number here), doc_id, kept_<column> for each of keep, the
    counts, base and linked (arrays of s, k, e, sorted)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c).alias(f"kept_{c}") for c in keep], text.alias("t"))
    assign = _spans(F.col("t"), ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8)
    rows = rows.withColumn("assign", assign).withColumn("access", F.when(F.contains("t", F.lit("AKIA")), _spans(F.col("t"), ACCESS, 1)).otherwise(F.array().cast(_SPANS))).withColumn("hex", _spans(F.col("t"), HEX, 2))
    rows = rows.withColumn("ident", _spans(F.col("t"), IDENT, 3)).withColumn("endpoint", F.when(F.contains("t", F.lit("://")), _spans(F.col("t"), ENDPOINT, 5)).otherwise(F.array().cast(_SPANS)))
    any_part = (F.size("ident") + F.size("endpoint") + F.size("access")) > 0
    rows = rows.withColumn("weak", F.when(any_part, _spans(F.col("t"), WEAK, 4)).otherwise(F.array().cast(_SPANS)))
    scopes = F.when(F.size("weak") > 0, F.transform(_spans(F.col("t"), SCOPE_BREAK, 0), lambda x: x["s"])).otherwise(F.array().cast("array<int>"))
    base = F.array_sort(F.concat("assign", "access", "hex"))
    rows = rows.select("doc_id", *[f"kept_{c}" for c in keep], base.alias("base"), F.size("assign").cast("long").alias("n_assign"), F.size("access").cast("long").alias("n_access"), F.size("hex").cast("long").alias("n_hex"), "ident", "endpoint", "access", "weak", scopes.alias("scopes"))
    # The row number holds from here on, because the rows are written.
    rows = settled(rows.withColumn("row", F.monotonically_increasing_id()), "secrets")
    linked = settled(_link(rows.where("size(weak) > 0"), reach), "linked")
    few = linked.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # beyond, the join shuffles
    return rows.join(F.broadcast(linked) if few else linked, "row", "left").select("row", "doc_id", *[f"kept_{c}" for c in keep], "n_assign", "n_access", "n_hex", "base", F.coalesce("linked", F.array().cast(_SPANS)).alias("linked"))


def _link(rows: DataFrame, reach: int | None) -> DataFrame:
    """row, linked: weak secrets with a complementary part apart from them in their
    scope, and those identifiers and endpoints. Each part looks for the nearest part
    of the other side before and after it, so no pairs are made."""

    # All parts, base spans and ends of scopes as events of their row; its matches are
    # what a window holds, and no array is copied to each of them.
    role = lambda spans, name: F.transform(spans, lambda x: F.struct(x.alias("x"), F.lit(name).alias("role")))
    ends = F.transform("scopes", lambda b: F.struct(F.struct(b.alias("s"), F.lit(-1).alias("k"), b.alias("e")).alias("x"), F.lit("end").alias("role")))
    others = F.concat("ident", "endpoint", "access")
    events = rows.select("row", F.explode(F.concat(role(F.col("weak"), "weak"), role(others, "other"), role(F.col("base"), "base"), ends)).alias("v")).select("row", "v.x", "v.role")
    before = lambda c: Window.partitionBy("row").orderBy(c).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # A weak secret overlaps a base span if of those that start before its end one ends after its start.
    spot = F.when(F.col("role") == "weak", F.col("x.e") - 1).otherwise(F.col("x.s"))
    covered = F.max(F.when(F.col("role") == "base", F.col("x.e"))).over(before("spot"))
    scope = F.sum(F.when(F.col("role") == "end", 1).otherwise(0)).over(before("start"))
    events = events.withColumn("spot", spot).withColumn("start", F.col("x.s")).withColumn("covered", covered).withColumn("scope", scope)
    both = events.where((F.col("role") == "other") | ((F.col("role") == "weak") & (F.coalesce("covered", F.lit(-1)) <= F.col("start"))))
    both = both.select("row", "scope", "x", (F.col("role") == "weak").alias("weak"))
    is_weak = F.col("weak")
    # On `a` a weak secret's start meets the others' ends, on `b` its end their starts.
    both = both.withColumn("a", F.when(is_weak, F.col("x.s")).otherwise(F.col("x.e"))).withColumn("b", F.when(is_weak, F.col("x.e")).otherwise(F.col("x.s")))
    up = lambda c: Window.partitionBy("row", "scope").orderBy(c).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    down = lambda c: up(F.col(c).desc())
    of_weak = F.least(F.col("a") - F.max(F.when(~is_weak, F.col("a"))).over(up("a")), F.min(F.when(~is_weak, F.col("b"))).over(down("b")) - F.col("b"))
    of_other = F.least(F.min(F.when(is_weak, F.col("a"))).over(down("a")) - F.col("a"), F.col("b") - F.max(F.when(is_weak, F.col("b"))).over(up("b")))
    gap = F.when(is_weak, of_weak).otherwise(of_other)
    found = both.withColumn("gap", gap).where(F.col("gap").isNotNull() if reach is None else F.col("gap") < reach).where("weak or x.k <> 1")
    return found.groupBy("row").agg(F.array_sort(F.collect_list("x")).alias("linked"))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, the counts, base_sha256 and spans."""
    got = find_secrets(docs, **options)
    return got.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.encode(_listed(F.col("base")), "utf-8"), 256).alias("base_sha256"), _listed(F.array_sort(F.concat("base", "linked"))).alias("spans"))


def redact_secrets(docs: DataFrame, *, mark: str = "[SECRET]", reach: int | None = None, text_col: str = "text", **options) -> DataFrame:
    """docs with every base span and every linked weak secret replaced by mark;
    overlapping spans are replaced together. All columns are kept."""
    got = find_secrets(docs, reach=reach, text_col=text_col, keep=tuple(docs.columns), **options)
    text = F.col(f"kept_{text_col}")
    spans = F.array_sort(F.concat("base", F.filter("linked", lambda x: x["k"] == 4)))
    merged = F.aggregate(
        spans,
        F.array().cast("array<struct<s:int,e:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["e"] >= x["s"]),
            F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["s"].alias("s"), F.greatest(F.try_element_at(acc, F.lit(-1))["e"], x["e"]).alias("e")))),
        ).otherwise(F.concat(acc, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e"))))),
    )
    done = F.aggregate(
        merged,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.struct(x["e"].alias("at"), F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.lit(mark))).alias("out")),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    cleaned = F.when(F.size(spans) > 0, done).otherwise(text)
    return got.select(*[cleaned.alias(c) if c == text_col else F.col(f"kept_{c}").alias(c) for c in docs.columns])
