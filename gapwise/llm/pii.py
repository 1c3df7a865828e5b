"""Personal data: patterns, and information-theoretic sanitisation of what gives them away.

Base findings are e-mail addresses, IP addresses, card numbers and phone numbers. Beyond
them, terms may disclose an entity although they match no pattern: a name that stands only
beside one address, say. Entities are protected at three
levels: the exact value, its group (e-mail domain, the first three parts of an address, the
first six digits of a card, a phone number without its last four digits) and its kind. So a
term beside many values that occur once each counts too. For a term t and an entity e of any
level, counted over *distinct* texts of the whole corpus,

    share(t, e) = n(t and e) / n(t)                      how surely t points at e
    bits(t, e)  = log2(n(t and e) * N / (n(t) * n(e)))   pointwise mutual information
    whole(e)    = log2(N / n(e))                         all there is to know about e

where "t and e" counts texts that hold t within ``reach`` characters of e. With fewer than
``least_texts`` such texts the share is smoothed towards n(e) / N by ``prior`` texts. A term
is *generalised* to a placeholder where its share reaches ``general_share``, and *removed*
where it reaches ``remove_share`` in ``least_texts`` texts or more. Both need ``least_bits``
or, for entities too frequent to give as many, ``general_share`` of whole(e).

Everything is DataFrame functions. Positions are code points, ends exclusive. Defined results:
null and empty texts have no findings; rows and their repeats each get their own findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.scratch import Scratch

#: In the order that breaks ties. The patterns are those of the contract, written so that Java
#: scans each run of characters once: a match may start only where a run does or the last match
#: ended, and quantifiers do not give back. Runs with fewer digits than a card needs are not
#: matched at all, which drops the same findings as matching and dropping them.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9]){11,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
TERM = r"[\p{L}][\p{L}\p{N}_'-]*+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    doubled = lambda c: F.when(c > 4, 2 * c - 9).otherwise(2 * c)
    marks = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")))
    return F.aggregate(marks, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _hits(df: DataFrame, text: str, patterns: dict[str, str | Column]) -> DataFrame:
    """A column ``hit_<kind>`` of all matches, and ``gap_<kind>`` of what lies between (null without matches)."""
    may = {"email": F.contains(F.col(text), F.lit("@")), "phone": F.contains(F.col(text), F.lit("+"))}
    for kind, pattern in patterns.items():
        pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
        found = F.regexp_extract_all(F.col(text), pattern, F.lit(0))
        df = df.withColumn(f"hit_{kind}", F.when(may[kind], found) if kind in may else found)
    for kind, pattern in patterns.items():
        pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
        df = df.withColumn(f"gap_{kind}", F.when(F.size(f"hit_{kind}") > 0, F.split(F.col(text), pattern, -1)))
    return df


def _spans(kind: str) -> Column:
    """Structs (start, rank, end, value) of a kind's valid matches."""
    rank = KINDS.index(kind)
    both = F.arrays_zip(F.col(f"gap_{kind}").alias("gap"), F.col(f"hit_{kind}").alias("hit"))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")
    state = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(s, x):
        start = s["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        one = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), x["hit"].alias("value"))
        return F.when(x["hit"].isNull(), s).otherwise(F.struct(end.alias("at"), F.array_append(s["out"], one).alias("out")))

    every = F.aggregate(both, state, step, lambda s: s["out"])
    return F.coalesce(F.filter(every, lambda x: _valid(kind, x["value"])), empty)


def base_findings(docs: DataFrame, text_col: str = "text", keep: bool = False) -> DataFrame:
    """``docs`` with ``pii_<kind>`` arrays of (start, rank, end, value) for the four base kinds."""
    columns = docs.columns
    df = _hits(docs, text_col, PATTERNS)
    df = df.withColumns({f"pii_{k}": F.when(F.col(f"gap_{k}").isNotNull(), _spans(k)).otherwise(F.array().cast("array<struct<start:int,rank:int,end:int,value:string>>")) for k in PATTERNS})
    return df if keep else df.select(*columns, *[f"pii_{k}" for k in PATTERNS])


def _levels(x: Column) -> Column:
    """Keys of a finding at its levels: value, group, kind."""
    rank, lower, digits = x["rank"], F.lower(x["value"]), _digits(x["value"])
    value = F.when(rank < 2, lower).otherwise(digits)
    group = (
        F.when(rank == 0, F.substring_index(lower, "@", -1))
        .when(rank == 1, F.substring_index(lower, ".", 3))
        .when(rank == 2, F.left(digits, F.lit(6)))
        .otherwise(F.left(digits, F.length(digits) - 4))
    )
    return F.array(F.xxhash64(F.lit(0), rank, value), F.xxhash64(F.lit(1), rank, group), F.xxhash64(F.lit(2), rank))


def _with_counts(df: DataFrame, counts: DataFrame, key: str, n: str) -> DataFrame:
    """``df`` with its keys' ``counts``. Keys with a thousandth of the sum, which are few, are
    broadcast, so that no task of the join gets all rows of a frequent one."""
    hot = F.col(n) * 1000 >= F.lit(counts.agg(F.sum(n)).first()[0] or 0)
    frequent = F.broadcast(counts.filter(hot))
    rest = df.join(frequent.select(key), key, "left_anti").join(counts.filter(~hot), key)
    return df.join(frequent, key).unionByName(rest)


def disclosing_terms(
    docs: DataFrame,
    text_col: str = "text",
    reach: int = 60,
    least_texts: int = 3,
    least_bits: float = 3.0,
    general_share: float = 0.8,
    remove_share: float = 0.95,
    prior: float = 0.25,
    scratch: Scratch | None = None,
) -> DataFrame:
    """The corpus' disclosing terms: term, share, bits, action ('remove' or 'generalise')."""
    scratch = scratch or Scratch(docs.sparkSession)
    texts = docs.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"))
    found = base_findings(texts).withColumn("found", F.concat(*[f"pii_{k}" for k in PATTERNS])).filter(F.size("found") > 0)
    found, _ = scratch.write(found.select(F.xxhash64("text").alias("h"), "text", "found"))
    each = found.select("h", "text", F.explode("found").alias("x")).withColumn("entities", _levels(F.col("x")))
    before = F.substring("text", F.greatest(F.lit(1), F.col("x.start") - reach + 1), F.least(F.col("x.start"), F.lit(reach)))
    after = F.substring("text", F.col("x.end") + 1, F.lit(reach))
    # the word cut off at the far edge of the reach is left out
    before = F.when(F.col("x.start") > reach, F.regexp_replace(before, r"^[\p{L}\p{N}_'-]+", "")).otherwise(before)
    after = F.when(F.length(after) == reach, F.regexp_replace(after, r"[\p{L}\p{N}_'-]+$", "")).otherwise(after)
    terms = F.array_distinct(F.regexp_extract_all(F.lower(F.concat_ws(" | ", before, after)), F.lit(TERM), F.lit(0)))
    near = each.select("h", "entities", F.explode(terms).alias("term")).select("h", F.explode("entities").alias("entity"), "term")
    joint, _ = scratch.write(near.distinct().groupBy("entity", "term").agg(F.count("*").alias("n_te")))
    # a term stands in at least as many texts as those with findings that hold it: what falls
    # short of the share on that count alone needs no count over the corpus
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    inside = found.select("h", F.explode(words).alias("term")).distinct().groupBy("term").agg(F.count("*").alias("n_found"))
    inside, _ = scratch.write(inside)
    joint, _ = scratch.write(_with_counts(joint, inside, "term", "n_found").filter(F.col("n_te") >= general_share * F.col("n_found")).drop("n_found"))
    of_entity = each.select("h", F.explode("entities").alias("entity")).distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    of_entity, _ = scratch.write(of_entity)
    candidates, _ = scratch.write(joint.select("term").distinct())
    # equal texts count once: one row for each hash
    spread = texts.select(F.xxhash64("text").alias("h"), F.explode(words).alias("term"))
    of_term = spread.join(candidates, "term", "left_semi").distinct().groupBy("term").agg(F.count("*").alias("n_t"))
    n = float(texts.select(F.xxhash64("text").alias("h")).distinct().count())
    share = F.col("n_te") / F.col("n_t")
    smooth = (F.col("n_te") + prior * F.col("n_e") / F.lit(n)) / (F.col("n_t") + prior)
    rated = _with_counts(joint, of_entity, "entity", "n_e").join(of_term, "term").select(
        "term",
        F.when(F.col("n_te") >= least_texts, share).otherwise(F.least(share, smooth)).alias("share"),
        F.log2(F.col("n_te") * F.lit(n) / (F.col("n_t") * F.col("n_e"))).alias("bits"),
        F.log2(F.lit(n) / F.col("n_e")).alias("whole"),
        (F.col("n_te") >= least_texts).alias("enough"),
    )
    chosen = rated.filter((F.col("share") >= general_share) & (F.col("bits") >= F.least(F.lit(least_bits), general_share * F.col("whole"))))
    removed = F.col("enough") & (F.col("share") >= remove_share)
    best = chosen.groupBy("term").agg(F.max(F.struct(removed.alias("removed"), "share", "bits")).alias("b"))
    action = F.when(F.col("b.removed"), F.lit("remove")).otherwise(F.lit("generalise"))
    return scratch.write(best.select("term", "b.share", "b.bits", action.alias("action")))[0]


def with_terms(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``disclosed``: the disclosing terms each text holds (null: none), by action."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text_col), F.lit(TERM), F.lit(0)))
    held = (
        docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.explode(words).alias("term"))
        .join(terms.select("term", "action"), "term")
        .groupBy("id", "h")
        .agg(F.collect_set(F.struct("action", "term")).alias("disclosed"))
    )
    keyed = docs.withColumn("__h", F.xxhash64(text_col))
    return keyed.join(held, keyed[id_col].eqNullSafe(held["id"]) & (keyed["__h"] == held["h"]), "left").drop("id", "h", "__h")


def _any_of(terms: Column) -> Column:
    """A pattern of whole words, case ignored, for a few terms (letters, digits, _ ' - only); placeholders are no words."""
    own = r"(?!(?<=\[)(?-i:" + "|".join(k.upper() for k in KINDS) + r")\])"
    return F.concat(F.lit(rf"(?iu)(?<![\p{{L}}\p{{N}}_'-]){own}(?:"), F.array_join(terms, "|"), F.lit(r")(?![\p{L}\p{N}_'-])"))


def findings(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: id and an array ``found`` of (start, rank, end, value), sorted."""
    df = with_terms(base_findings(docs.select(id_col, text_col), text_col), terms, id_col, text_col)
    pattern = _any_of(F.transform("disclosed", lambda x: x["term"]))
    df = df.withColumn("hit_term", F.when(F.col("disclosed").isNotNull(), F.regexp_extract_all(F.col(text_col), pattern, F.lit(0))))
    df = df.withColumn("gap_term", F.when(F.size("hit_term") > 0, F.split(F.col(text_col), pattern, -1)))
    kinds = [f"pii_{k}" for k in PATTERNS]
    df = df.withColumn("pii_term", F.when(F.col("gap_term").isNotNull(), _spans("term")).otherwise(F.col(kinds[0]).cast("array<struct<start:int,rank:int,end:int,value:string>>")))
    df = df.withColumn("pii_term", F.filter("pii_term", lambda x: x["rank"] == KINDS.index("term")))
    return df.select(id_col, *kinds, F.sort_array(F.concat(*kinds)).alias("base"), F.sort_array(F.concat(*kinds, "pii_term")).alias("found"))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(name, x["rank"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _replaced(kind: str):
    return lambda v: F.when(_valid(kind, v), F.lit(f"[{kind.upper()}]")).otherwise(v)


def _has_action(action: str):
    return lambda x: x["action"] == action


def sanitised(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with findings replaced: ``[EMAIL]`` and so on; disclosing terms go or become ``[TERM]``."""
    columns = docs.columns
    df = docs
    for kind, pattern in PATTERNS.items():
        df = _hits(df, text_col, {kind: pattern})
        put = F.transform(f"hit_{kind}", _replaced(kind))
        text = F.array_join(F.flatten(F.zip_with(F.col(f"gap_{kind}"), put, lambda g, v: F.array(g, F.coalesce(v, F.lit(""))))), "")
        df = df.withColumn(text_col, F.when(F.col(f"gap_{kind}").isNotNull(), text).otherwise(F.col(text_col))).select(*columns)
    df = with_terms(df, terms, id_col, text_col)
    for action, put in (("generalise", "[TERM]"), ("remove", "")):
        own = F.transform(F.filter("disclosed", _has_action(action)), lambda x: x["term"])
        df = df.withColumn(text_col, F.when(F.size(own) > 0, F.regexp_replace(F.col(text_col), _any_of(own), F.lit(put))).otherwise(F.col(text_col)))
    return df.select(*columns)
